"""Prefix trie of conversations, sharded and written as balanced parentheses.

A turn is known by the first 16 bytes of the SHA-256 of its role and text, so
texts are read once and never shuffled. Conversations with equal turns become
one path with a count; the ids of those that end there are hashed as a stream.

Paths are cut into layers of ``LAYER`` turns, a layer's path beginning with the
digest of all turns before it, so no row grows with a conversation. Layers are
built from the deepest up. In a layer the distinct paths are sorted over
range partitions, and every run of at most ``SHARD_TURNS`` turns is a shard: a
trie in balanced parentheses (:mod:`parentheses`) whose ``findclose`` delimits
the subtrees, whose leaf pairs are counted by rank, and whose cumulative arrays
give members and savings. Only the nodes on a shard's first and last path, its
spines, can occur in other shards too. Shards leave their spines out of their
sums and hand them on with what hangs below them; one task merges the spines of
all shards (two paths a shard) in a trie of their own.

Cases: a NULL id takes no part; NULL role or text is empty; turns are ordered by
turn (NULL first), those of equal turn by their digest, so repeated rows are
turns of their own; a conversation without turns is a member of the root only;
without conversations there is no node; other columns are ignored. The ids that
end at one node are joined and hashed in order, which is one stream; it is cut
beforehand into texts of ``CHUNK_IDS`` ids made in parallel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import rank_all
from .common import store
from .parentheses import NONE, Trie

LAYER = 128
SHARD_TURNS = 250_000
CHUNK_IDS = 50_000
NODE, SPINE = 0, 1
#: ``below_*``: what the next layer has beneath a path's last node.
PART = ("kind int, shard long, side int, level int, digest binary, chars long, conv long, parent long, "
        "n long, children long, leaves long, saved long, ends string, "
        "below_children long, below_leaves long, below_saved long")
_PART = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(),
                        "binary": pa.binary()}[t]) for n, t in (c.split() for c in PART.split(", "))])


# --- conversations -----------------------------------------------------------

def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, digest, chars, rank``: turns with their place in the order
    of all turns by conversation."""
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    whole = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary")
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        _digest(whole).alias("digest"), F.char_length(said).cast("long").alias("chars"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("chars")]
    return rank_all(turns.filter(F.col("conv_id").isNotNull()), order, "rank",
                    rank_type="long").select("conv_id", "turn", "digest", "chars", "rank")


def _digest(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def whole_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, digest, chars)`` and ``(conv_id, length)`` of the
    conversations as they are."""
    heads = turns.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("length"))
    rows = turns.join(heads, "conv_id").select(
        "conv_id", (F.col("rank") - F.col("first") + 1).alias("depth"), "digest", "chars")
    return rows, heads.select("conv_id", "length")


def shared_openings(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """As :func:`whole_conversations`, each conversation ``c`` opening with the
    first ``h = crc32(c) % most`` turns of conversation ``c - c % group`` in
    place of its own first ``h``."""
    heads = turns.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    heads = heads.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % most,
        "base": F.col("conv_id") - F.col("conv_id") % group})
    place = Window.partitionBy("conv_id").orderBy("rank")
    opening = (turns.filter(F.col("conv_id") % group == 0)
               .withColumn("place", F.row_number().over(place)).filter(F.col("place") < most)
               .groupBy(F.col("conv_id").alias("base"))
               .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("opening")))
    given = F.filter("opening", lambda t: t["place"] <= F.col("h"))
    heads = store(heads.join(opening, "base", "left")
                  .withColumn("given", F.coalesce(given, F.expr("filter(opening, t -> false)")))
                  .withColumn("b", F.coalesce(F.array_size("given"), F.lit(0)))
                  .select("conv_id", "first", "n", "h", "b", "given"), "trie-heads")
    own = (turns.join(heads.select("conv_id", "first", "h", "b"), "conv_id")
           .withColumn("place", F.col("rank") - F.col("first") + 1).filter(F.col("place") > F.col("h"))
           .select("conv_id", (F.col("b") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars"))
    lent = heads.select("conv_id", F.explode("given").alias("t")).select(
        "conv_id", F.col("t.place").cast("long").alias("depth"), "t.digest", "t.chars")
    length = F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.unionByName(lent), heads.select("conv_id", length.alias("length"))


# --- paths -------------------------------------------------------------------

def _layers(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Conversations cut into pieces (stored): ``conv_id, layer, digests, chars,
    start`` (digest of the turns before), ``next`` (of these too), ``last``. A
    conversation that fills its last layer has an empty piece in the next."""
    turn = F.struct("depth", "digest", "chars")
    pieces = (rows.groupBy("conv_id", F.floor((F.col("depth") - 1) / LAYER).alias("layer"))
              .agg(F.sort_array(F.collect_list(turn)).alias("t"))
              .select("conv_id", "layer", F.col("t.digest").alias("digests"), F.col("t.chars").alias("chars")))
    none = lengths.filter(F.col("length") % LAYER == 0).select(
        "conv_id", F.floor(F.col("length") / LAYER).alias("layer"),
        F.lit([]).cast("array<binary>").alias("digests"), F.lit([]).cast("array<bigint>").alias("chars"))
    pieces = pieces.unionByName(none).withColumn("hash", F.sha2(F.concat_ws(
        " ", F.col("layer").cast("string"), F.concat_ws("", F.transform("digests", F.hex))), 256))
    # sums of 60-bit parts of the pieces' hashes name all turns up to a piece
    so_far = Window.partitionBy("conv_id").orderBy("layer").rowsBetween(Window.unboundedPreceding, 0)
    parts = [F.conv(F.substring("hash", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(p).over(so_far) for p in parts]

    def name(*columns: Column) -> Column:
        return _digest(F.concat_ws(" ", *[c.cast("string") for c in columns]).cast("binary"))

    before = [s - p for s, p in zip(sums, parts, strict=True)]
    here = pieces.withColumns({"start": name(F.col("layer"), *before),
                               "next": name(F.col("layer") + 1, *sums)})
    last = F.array_size("digests") < LAYER
    return store(here.withColumn("last", last).drop("hash"), "trie-pieces")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ``key, conv_id`` as ``key, least, n, ids`` texts."""
    key, ids = None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "key": pa.array([key], pa.binary()), "least": pa.array([ids[0]], pa.int64()),
            "n": pa.array([len(ids)], pa.int64()), "ids": pa.array([",".join(map(str, ids))])})

    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (k != key or len(ids) == CHUNK_IDS):
                yield out()
                ids = []
            key = k
            ids.append(c)
    if ids:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key of sorted texts: its smallest id, count and hash."""
    key, least, n, state = None, 0, 0, hashlib.sha256()
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        key, conv, n, ends = zip(*done, strict=True)
        return pa.RecordBatch.from_pydict({
            "key": pa.array(key, pa.binary()), "conv_id": pa.array(conv, pa.int64()),
            "n": pa.array(n, pa.int64()), "ends": pa.array(ends)})

    for batch in batches:
        for row in batch.to_pylist():
            if row["key"] == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((key, least, n, state.hexdigest()))
                key, least, n, state = row["key"], row["least"], 0, hashlib.sha256()
            state.update(row["ids"].encode())
            n += row["n"]
        if len(done) > 10_000:
            yield out()
            done = []
    if key is not None:
        done.append((key, least, n, state.hexdigest()))
        yield out()


def _distinct(pieces: DataFrame) -> DataFrame:
    """Pieces of one conversation for each distinct whole path (stored), with
    ``n`` conversations; ``ends`` hashes their ids on the last piece."""
    order, key = ["key", "conv_id"], F.col("next").alias("key")
    runs = (pieces.filter("last").select(key, "conv_id").repartitionByRange(*order)
            .sortWithinPartitions(*order).mapInArrow(_ends, "key binary, least long, n long, ids string"))
    whole = (runs.repartition("key").sortWithinPartitions("key", "least")
             .mapInArrow(_hashed, "key binary, conv_id long, n long, ends string"))
    return store(pieces.join(whole.drop("key"), "conv_id")
                 .withColumn("ends", F.when(F.col("last"), F.col("ends"))), "trie-paths")


# --- shards ------------------------------------------------------------------

def _rows(**columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _PART],
        schema=_PART)


def _nulled(values: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=null)


def _words(digests: pa.Array | list) -> np.ndarray:
    joined = b"".join(digests if isinstance(digests, list) else digests.to_pylist())
    return np.frombuffer(joined, np.uint64).reshape(-1, 2)


def _shard(table: pa.Table, shard: int) -> Iterator[pa.RecordBatch]:
    """One shard's own nodes, its spines, and the tops of layers below."""
    path = table.column("path").combine_chunks()
    sizes = np.diff(path.offsets.to_numpy()).astype(np.int64)
    digests = np.array(path.flatten().to_pylist() or [b""], object)
    chars = table.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    trie = Trie(_words(list(digests) if sizes.sum() else []), sizes)
    nodes = len(trie.depth)
    column = {c: table.column(c).to_numpy() for c in
              ("conv", "n", "below_children", "below_leaves", "below_saved")}
    at = trie.ends

    def spread(name: str, empty: int = 0) -> np.ndarray:
        out = np.full(nodes, empty, np.int64)
        out[at] = column[name]
        return out

    ends = np.full(nodes, None, object)
    ends[at] = table.column("ends").to_pylist()
    n, conv = trie.below(spread("n")), trie.least(spread("conv", NONE))
    beneath, leaves_beneath, saved_beneath = (spread(f"below_{c}") for c in ("children", "leaves", "saved"))
    spine = np.zeros(nodes, bool)
    for nodes_of in trie.paths:
        spine[nodes_of] = True
    said = np.zeros(nodes, np.int64)
    said[1:] = chars[trie.source[1:]]
    linked = np.bincount(trie.parent[1:], minlength=nodes)
    hidden = np.bincount(trie.parent[1:][spine[1:]], minlength=nodes)
    pair = trie.is_leaf()
    # leaf pairs, but spines are counted where they are merged, and a node with turns in the next layer by those
    leaves = trie.leaves() + trie.below(np.where(
        spine, -1 * pair, np.where(beneath > 0, leaves_beneath - 1, 0) * pair))
    saved = trie.below(np.where(spine, 0, (n - 1) * said + saved_beneath))
    own = np.flatnonzero(~spine)
    if len(own):
        up = trie.parent[own]
        side = np.zeros(nodes, np.int32)  # the spine that holds a parent
        if len(trie.paths) > 1:
            side[trie.paths[1]] = 1
        side[trie.paths[0]] = 0
        yield _rows(kind=np.full(len(own), NODE, np.int32), shard=np.full(len(own), shard), side=side[up],
                    level=trie.depth[own].astype(np.int32), conv=conv[own], parent=_nulled(conv[up], spine[up]),
                    digest=digests[trie.source[own]],
                    n=n[own], children=linked[own] + beneath[own], leaves=leaves[own], saved=saved[own],
                    ends=ends[own].tolist())
    for number, nodes_of in enumerate(trie.paths):
        shared = min(len(nodes_of), len(trie.paths[0])) if number else 0
        same = int((nodes_of[:shared] == trie.paths[0][:shared]).sum())
        first = np.arange(len(nodes_of)) >= same  # what both spines share is handed on once
        once = first.astype(np.int64)
        yield _rows(kind=np.full(len(nodes_of), SPINE, np.int32), shard=np.full(len(nodes_of), shard),
                    side=np.full(len(nodes_of), number, np.int32), level=trie.depth[nodes_of].astype(np.int32),
                    digest=[None, *digests[trie.source[nodes_of[1:]]]], chars=said[nodes_of],
                    conv=np.where(first, conv[nodes_of], NONE), n=n[nodes_of] * once,
                    children=(linked - hidden)[nodes_of] * once, leaves=leaves[nodes_of] * once,
                    saved=saved[nodes_of] * once, ends=np.where(first, ends[nodes_of], None).tolist(),
                    below_children=beneath[nodes_of] * once, below_leaves=leaves_beneath[nodes_of] * once,
                    below_saved=saved_beneath[nodes_of] * once)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, turns = [], 0
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, len(batch), 256):
            piece = batch.slice(at, 256)
            held.append(piece)
            turns += len(piece.column("chars").flatten()) + len(piece)
            if turns >= SHARD_TURNS:
                yield from _shard(pa.Table.from_batches(held), number)
                held, turns, number = [], 0, number + 1
    if held:
        yield from _shard(pa.Table.from_batches(held), number)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on spines, from all shards' spines in order (one task), and
    again as ``SPINE`` rows that tell the shards their nodes' ids."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    table = pa.Table.from_batches(held)
    got = {c: table.column(c).to_numpy() for c in (
        "shard", "side", "level", "chars", "conv", "n", "children", "leaves", "saved",
        "below_children", "below_leaves", "below_saved")}
    level = got["level"]
    start = np.flatnonzero(level == 0)
    sizes = np.diff(np.append(start, len(level))) - 1
    digests = np.array(table.column("digest").to_pylist(), object)
    trie = Trie(_words(list(digests[level > 0])), sizes.astype(np.int64), want_paths=True)
    node = np.concatenate(trie.paths)
    nodes = len(trie.depth)

    def total(name: str) -> np.ndarray:
        out = np.zeros(nodes, np.int64)
        np.add.at(out, node, got[name])
        return out

    conv = np.full(nodes, NONE)
    np.minimum.at(conv, node, got["conv"])
    ends, said, name = np.full(nodes, None, object), np.zeros(nodes, np.int64), np.full(nodes, None, object)
    said[node], name[node] = got["chars"], digests
    hashes = np.array(table.column("ends").to_pylist(), object)
    known = np.array([h is not None for h in hashes], bool)
    ends[node[known]] = hashes[known]
    n, beneath = total("n"), total("below_children")
    children = total("children") + np.bincount(trie.parent[1:], minlength=nodes) + beneath
    pair = trie.is_leaf()
    leaves = trie.leaves() + trie.below(total("below_leaves") * (beneath > 0) - (pair & (children > 0)))
    saved = trie.below((n - 1) * said + total("below_saved"))
    parent = np.where(trie.parent >= 0, conv[trie.parent], 0)
    yield _rows(kind=np.full(nodes, NODE, np.int32), level=trie.depth.astype(np.int32), digest=name, conv=conv,
                parent=_nulled(parent, trie.parent < 0), n=n, children=children,
                leaves=leaves + total("leaves"), saved=saved + total("saved"), ends=ends.tolist())
    yield _rows(kind=np.full(len(node), SPINE, np.int32), shard=got["shard"], side=got["side"], level=level,
                conv=conv[node])


def _layer(paths: DataFrame) -> DataFrame:
    """All nodes of one layer's paths: level, digest, conv, parent, counts."""
    parts = store(paths.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(_shards, PART),
                  "trie-shards")
    spines = store(parts.filter(F.col("kind") == SPINE).repartition(1)
                   .sortWithinPartitions("shard", "side", "level").mapInArrow(_merged, PART), "trie-spines")
    tops = spines.filter(F.col("kind") == SPINE).select(
        "shard", "side", (F.col("level") + 1).alias("level"), F.col("conv").alias("above"))
    own = parts.filter(F.col("kind") == NODE)
    loose = own.filter(F.col("parent").isNull()).join(tops, ["shard", "side", "level"]) \
        .withColumn("parent", F.col("above"))
    columns = ["level", "digest", "conv", "parent", "n", "children", "leaves", "saved", "ends"]
    return (own.filter(F.col("parent").isNotNull()).select(columns).unionByName(loose.select(columns))
            .unionByName(spines.filter(F.col("kind") == NODE).select(columns)))


def prefix_trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``rows`` (``conv_id, depth`` from 1,
    ``digest, chars``) and ``lengths`` (``conv_id, length``, 0 included):
    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    pieces = _distinct(_layers(rows, lengths))
    deepest = pieces.agg(F.max("layer")).first()[0]
    nothing, found, under = F.lit(0).cast("long"), [], None
    for layer in range(deepest if deepest is not None else 0, -1, -1):
        here = (pieces.filter(F.col("layer") == layer).groupBy("start", "digests")
                .agg(F.min("conv_id").alias("conv"), F.sum("n").alias("n"), F.max("ends").alias("ends"),
                     F.first("chars").alias("chars"), F.max("next").alias("next")))
        path, chars = F.col("digests"), F.col("chars")
        if layer:
            path = F.array_prepend(path, F.col("start"))
            chars = F.array_prepend(chars, nothing)
        here = here.select(path.alias("path"), chars.alias("chars"), "conv", "n", "ends",
                           F.when(F.array_size("digests") == LAYER, F.col("next")).alias("next"))
        if under is None:
            here = here.drop("next").withColumns(
                {f"below_{c}": nothing for c in ("children", "leaves", "saved")})
        else:
            here = here.join(under, "next", "left").select(
                "path", "chars", "conv", "n", F.coalesce("ends", "under_ends").alias("ends"),
                *[F.coalesce(f"below_{c}", nothing).alias(f"below_{c}") for c in ("children", "leaves", "saved")])
        nodes = _layer(here)
        if layer:  # level 0 stands for nothing, level 1 for nodes of the layer above
            nodes = store(nodes, "trie-nodes")
            under = nodes.filter(F.col("level") == 1).select(
                F.col("digest").alias("next"), F.col("ends").alias("under_ends"),
                *[F.col(c).alias(f"below_{c}") for c in ("children", "leaves", "saved")])
            nodes = nodes.filter(F.col("level") > 1)
        first = layer * LAYER - (1 if layer else 0)
        found.append(nodes.select(
            F.col("conv").alias("conv_id"), (F.col("level") + first).cast("long").alias("depth"),
            F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
