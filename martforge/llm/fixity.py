"""WARC archives and their Merkle fixity audit.

Pages become WARC ``resource`` records. A catalogue gives each record its
place: records are numbered by ``page_id`` (ties in stored order), every
``SHARD_RECORDS`` of them form a shard (one WARC file), and the offset is the
length of the records before it in the shard.

A replica's tree hashes its records (SHA-256), then the records that start in
each range of ``RANGE_BYTES`` of a shard, in offset order with offsets and
lengths, then ``FANOUT`` neighbouring nodes at a time up to one root. The
audit compares two replicas from the root and joins, level by level, only the
children of nodes that differ; records are compared only in ranges that differ.

All steps are DataFrame operations. Nodes gather at most ``FANOUT`` children
and ranges only the records of ``RANGE_BYTES``, and offsets only the records of
a shard, so no group grows with the data; numbering is a distributed sort.

Cases: a NULL page id sorts first and reads ``-`` in the record; NULL url or
html is empty; line ends in a url are escaped; repeated rows are records of
their own; empty tables give an empty catalogue and equal (empty) trees; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import rank_all
from .common import store

SHARD_RECORDS = 1024
RANGE_BYTES = 1 << 16
FANOUT = 16
DATE = "2000-01-01T00:00:00Z"


def warc_record(page_id: Column, url: Column, html: Column, date: str = DATE) -> Column:
    """One WARC/1.0 record as binary."""
    address = F.replace(F.replace(F.coalesce(url.cast("string"), F.lit("")), F.lit("\r"),
                                  F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    body = F.coalesce(html.cast("string"), F.lit(""))
    name = F.coalesce(page_id.cast("string"), F.lit("-"))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(">\r\nWARC-Date: " + date + "\r\nWARC-Target-URI: "), address,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
        F.lit("\r\n\r\n")).cast("binary")


def write_archive(pages: DataFrame) -> DataFrame:
    """The stored records: ``row`` (fixed once written), ``page_id``, ``record``."""
    return store(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
        warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record")), "archive")


def catalogue(archive: DataFrame) -> DataFrame:
    """``row, page_id, shard, offset, length`` of every record (stored)."""
    return _numbered(_sizes(archive))


def _sizes(records: DataFrame) -> DataFrame:
    return records.select("row", "page_id", F.octet_length("record").cast("long").alias("length"))


def _numbered(sizes: DataFrame) -> DataFrame:
    order = [F.col("page_id").asc_nulls_first(), F.col("row").asc()]
    numbered = rank_all(sizes, order, "number", rank_type="long")
    before = (Window.partitionBy("shard").orderBy("number")
              .rowsBetween(Window.unboundedPreceding, -1))
    return store(numbered.withColumn("shard", F.floor((F.col("number") - 1) / SHARD_RECORDS))
                 .select("row", "page_id", "shard",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
                         "length"), "catalogue")


def digests(replica: DataFrame, places: DataFrame) -> DataFrame:
    """``shard, offset, length, sha256`` of a replica's records (stored)."""
    hashed = replica.select("row", F.octet_length("record").cast("long").alias("length"),
                            F.sha2("record", 256).alias("sha256"))
    return store(hashed.join(places.select("row", "shard", "offset"), "row").drop("row"),
                 "digests")


def shape(places: DataFrame) -> tuple[int, int]:
    """``(ranges per shard, levels above the ranges)`` for a catalogue."""
    last = places.agg(F.max("offset"), F.max("shard")).first()
    ranges = (last[0] or 0) // RANGE_BYTES + 1
    nodes, levels = ranges * ((last[1] or 0) + 1), 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return ranges, levels


def _leaf(ranges: int) -> Column:
    return F.col("shard") * ranges + F.floor(F.col("offset") / RANGE_BYTES)


def _joined(parts: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(F.collect_list(parts))["text"], "\n").cast("binary"), 256)


def merkle_tree(records: DataFrame, form: tuple[int, int]) -> list[DataFrame]:
    """Levels ``node, hash`` from the offset ranges up to the root (stored)."""
    ranges, levels = form
    entry = F.struct(F.col("offset"), F.concat_ws(" ", "offset", "length", "sha256").alias("text"))
    level = records.groupBy(_leaf(ranges).alias("node")).agg(_joined(entry).alias("hash"))
    tree = [store(level, "tree")]
    for _ in range(levels):
        child = F.struct(F.col("node"), F.concat_ws(" ", "node", "hash").alias("text"))
        above = F.floor(F.col("node") / FANOUT)
        tree.append(store(tree[-1].groupBy(above.alias("up")).agg(_joined(child).alias("hash"))
                          .withColumnRenamed("up", "node"), "tree"))
    return tree


def audit(first: list[DataFrame], second: list[DataFrame], first_records: DataFrame,
          second_records: DataFrame, form: tuple[int, int]) -> DataFrame:
    """``shard, offset, status`` of the records of ``second`` that differ from
    ``first``: ``corrupt``, ``missing`` or ``extra``."""
    suspects = None
    for a, b in zip(reversed(first), reversed(second), strict=True):
        if suspects is not None:  # descend below differing nodes only
            near = suspects.select(F.col("node").alias("up"))
            a, b = (x.join(near, F.floor(x["node"] / FANOUT) == near["up"], "left_semi")
                    for x in (a, b))
        a, b = a.withColumnRenamed("hash", "x"), b.withColumnRenamed("hash", "y")
        # stored, as the next level reads it twice
        suspects = store(a.join(b, "node", "full").filter(~F.col("x").eqNullSafe(F.col("y")))
                         .select("node"), "suspects")
    leaf, key = _leaf(form[0]), ["shard", "offset"]

    def suspected(records: DataFrame, name: str) -> DataFrame:
        return (records.withColumn("node", leaf).join(suspects, "node", "left_semi")
                .select(*key, F.struct("length", "sha256").alias(name)))

    both = suspected(first_records, "x").join(suspected(second_records, "y"), key, "full")
    status = (F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra")
              .otherwise("corrupt"))
    return both.filter(~F.col("x").eqNullSafe(F.col("y"))).select(*key, status.alias("status"))


def fixity_report(archive: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of ``archive``: ``page_id, shard, offset, length, sha256``
    and its ``status`` in ``replica`` (``intact``, ``corrupt``, ``missing``).
    Records that only ``replica`` holds follow in shards of their own (``extra``)."""
    listed = catalogue(archive)
    last = listed.agg(F.max("shard")).first()[0]
    tail = 0 if last is None else last + 1
    added = _numbered(_sizes(replica).join(listed.select("row"), "row", "left_anti"))
    places = listed.unionByName(added.withColumn("shard", F.col("shard") + tail))
    form = shape(places)
    mine, theirs = digests(archive, places), digests(replica, places)
    found = audit(merkle_tree(mine, form), merkle_tree(theirs, form), mine, theirs, form)
    key = ["shard", "offset"]
    records = mine.unionByName(theirs.filter(F.col("shard") >= tail)).select(*key, "sha256")
    return (places.join(records, key).join(found, key, "left")
            .select("page_id", "shard", "offset", "length", "sha256",
                    F.coalesce("status", F.lit("intact")).alias("status")))


def damaged_copy(archive: DataFrame, corrupt: Column, lost: Column) -> DataFrame:
    """A stored second copy in which the records chosen by ``corrupt`` have
    their last payload byte changed and those chosen by ``lost`` are absent."""
    size = F.octet_length("record")
    changed = F.concat(F.substring("record", 1, size - 5), F.lit(b"\x00"),
                       F.substring("record", size - 3, F.lit(4)))
    return store(archive.filter(~F.coalesce(lost, F.lit(False)))
                 .withColumn("record", F.when(F.coalesce(corrupt, F.lit(False)), changed)
                             .otherwise(F.col("record"))), "replica")
