"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PACK_TOKENS = 2048


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .nearest import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    files = write_token_files(table(spark, sf_dir, "documents"),
                              tokenizer_path("byte_bpe_50k.json"), "keep", 2)
    return read_token_files(files)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a second copy in which about one record in 256 is corrupt and
    as many are lost, chosen by a hash of the page id."""
    from .fixity import damaged_copy, fixity_report, write_archive

    archive = write_archive(table(spark, sf_dir, "pages"))
    mark = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    return fixity_report(archive, damaged_copy(archive, mark == "00", mark == "01"))


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"),
                        tokenizer_path("word_bpe_49k.json"), "drop", PACK_TOKENS)


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    placed, _ = pack(table(spark, sf_dir, "documents"),
                     tokenizer_path("word_bpe_49k.json"), "drop", 0, PACK_TOKENS)
    return placed.drop("task", "place")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import numbered_turns, prefix_trie, shared_openings

    return prefix_trie(*shared_openings(numbered_turns(table(spark, sf_dir, "conversations"))))


def op12_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bitsliced import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_decontaminate, op3_nearest, op4_token_files, op5_toxicity,
    op6_warc_fixity, op7_pii_spans, op8_simhash_golay, op9_token_counts,
    op10_pack_sequences, op11_prefix_trie, op12_bit_sliced_top_k, op13_whitening)}

_OP2_SHINGLES = """
    SELECT DISTINCT {id}, text, unnest(CASE
        WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        END) AS s
    FROM (SELECT {id}, text, regexp_extract_all(lower(coalesce(text, '')),
                 '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM {table})"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": f"""
WITH held AS ({_OP2_SHINGLES.format(id="doc_id", table="documents")}),
wanted AS ({_OP2_SHINGLES.format(id="item_id", table="benchmark")}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM wanted GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared
           FROM held JOIN wanted USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared,
       CAST(n_shared AS DOUBLE) / n_shingles AS containment
FROM shared JOIN sizes USING (item_id)
WHERE n_shared >= 0.8 * n_shingles""",
    "op6_warc_fixity": """
WITH records AS (
    SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
        || 'WARC-Record-ID: <urn:page:' || CAST(page_id AS VARCHAR) || '>' || chr(13) || chr(10)
        || 'WARC-Date: 2000-01-01T00:00:00Z' || chr(13) || chr(10)
        || 'WARC-Target-URI: ' || replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A')
        || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
        || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
        || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
        || chr(13) || chr(10) || chr(13) || chr(10) AS record,
        left(md5(CAST(page_id AS VARCHAR)), 2) AS mark
    FROM pages),
numbered AS (SELECT *, row_number() OVER (ORDER BY page_id) - 1 AS n FROM records)
SELECT page_id, CAST(n // 1024 AS BIGINT) AS shard,
       CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY n // 1024 ORDER BY n
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
       CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS sha256,
       CASE mark WHEN '00' THEN 'corrupt' WHEN '01' THEN 'missing' ELSE 'intact' END AS status
FROM numbered""",
    "op11_prefix_trie": """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS o
    FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
           xor(4294967295, list_reduce(  -- CRC-32 of the decimal id
               [CAST(4294967295 AS BIGINT)] || list_transform(
                   range(1, len(CAST(conv_id AS VARCHAR)) + 1),
                   lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT)),
               lambda c, b: list_reduce([xor(c, b)] || range(8),
                   lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
    FROM turns GROUP BY conv_id),
sized AS (SELECT heads.*, least(heads.h, coalesce(b.n, 0)) AS b
          FROM heads LEFT JOIN (SELECT conv_id AS base, n FROM heads) b USING (base)),
rebuilt AS (
    SELECT sized.conv_id, t.o AS d, t.role, t.text
    FROM sized JOIN turns t ON t.conv_id = sized.base AND t.o <= sized.h
    UNION ALL
    SELECT conv_id, b + t.o - h, t.role, t.text FROM sized JOIN turns t USING (conv_id) WHERE t.o > h),
paths AS (
    SELECT conv_id, d, length(text) AS chars,
           sha256(string_agg(concat(length(role), ':', role, length(text), ':', text), '')
                  OVER (PARTITION BY conv_id ORDER BY d)) AS p
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
nodes AS (SELECT d, p, min(conv_id) AS c, count(*) AS n, any_value(chars) AS chars FROM paths GROUP BY d, p),
lens AS (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id),
ends AS (SELECT d, p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
         FROM paths JOIN lens USING (conv_id, d) GROUP BY d, p),
tops AS (SELECT nodes.d, nodes.p, up.p AS up_p, top.c AS up_c
         FROM nodes JOIN paths up ON up.conv_id = nodes.c AND up.d = nodes.d - 1
         JOIN nodes top ON top.d = up.d AND top.p = up.p),
families AS (SELECT d - 1 AS d, up_p AS p, count(*) AS n_children FROM tops GROUP BY d - 1, up_p),
subtrees AS (SELECT a.d, a.p, sum(CASE WHEN f.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
                    sum((u.n - 1) * u.chars) AS saved_tokens
             FROM nodes u JOIN paths a ON a.conv_id = u.c AND a.d <= u.d
             LEFT JOIN families f ON f.d = u.d AND f.p = u.p GROUP BY a.d, a.p)
SELECT nodes.c AS conv_id, CAST(nodes.d AS BIGINT) AS depth, tops.up_c AS parent_conv_id,
       CAST(nodes.n AS BIGINT) AS n_convs, CAST(coalesce(f.n_children, 0) AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes JOIN subtrees s ON s.d = nodes.d AND s.p = nodes.p
LEFT JOIN tops ON tops.d = nodes.d AND tops.p = nodes.p
LEFT JOIN families f ON f.d = nodes.d AND f.p = nodes.p
LEFT JOIN ends e ON e.d = nodes.d AND e.p = nodes.p""",
    "op12_bit_sliced_top_k": """
WITH held AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM held q JOIN held c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE r <= 5""",
}
