"""Quoted CSV records with line breaks, read in parallel (S-07).

Spark's ``multiLine`` mode reads a file in one task, because only a parser that
has seen the file from its start knows whether a line break is inside quotes.
Here the file is split like any text file, and that knowledge is computed:

1. Every line maps "quoted value open before the line" to "open after it".
   Of the four possible maps, a line without quotes is the identity, and a
   line either swaps both states or sets the state.
2. The maps of a split's lines compose to the split's own map (one row a
   split), and a running composition over the splits of a file gives the state
   in which each split begins.
3. Within a split (one window partition, so at most one split's bytes) the same
   running composition gives each line's state. Lines that begin outside
   quotes begin records; grouping the lines of a record needs no further
   exchange. Only the first and last piece of a split can belong to a record
   that crosses splits; those few are put together per file.

Records are parsed by ``from_csv``. The quote rules are those of Spark's CSV
reader with ``escape`` equal to ``quote``: a quote opens a value only at its
start, a doubled quote stands for one, and after a closing quote the value runs
to the delimiter. Lines end in ``\\n`` or ``\\r\\n``; empty records are skipped,
as that reader does. Compressed files are one split. UTF-8 only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTSIDE, INSIDE, CLOSED, FRESH = 0, 1, 2, 3
_SPLIT = ["file", "block"]


def _open_after(line: Column, start: int, sep: str, quote: str) -> Column:
    """Whether a quoted value is open after ``line``, begun in state ``start``
    (``FRESH``: at the start of a value, ``INSIDE``: in a quoted one)."""
    parts = F.split(line, "\\Q" + quote + "\\E", -1)
    before = F.slice(parts, F.lit(1), F.array_size(parts) - 1)  # what precedes each quote

    def step(state: Column, text: Column) -> Column:
        return (F.when(state == INSIDE, CLOSED)
                .when(text == "", F.when(state == OUTSIDE, OUTSIDE).otherwise(INSIDE))
                .when(text.endswith(sep), INSIDE).otherwise(OUTSIDE))

    return F.aggregate(before, F.lit(start), step) == INSIDE


def _lines(spark: SparkSession, path: str | list[str], sep: str, quote: str) -> DataFrame:
    """``file, block, at, line`` and the line's map: ``shut`` and ``open`` are
    the states after it for a line begun outside and inside quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    line, quoted = F.col("line"), F.contains("line", F.lit(quote))
    return (text.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
            .withColumns({
                "shut": F.when(quoted, _open_after(line, FRESH, sep, quote)).otherwise(False),
                "open": F.when(quoted, _open_after(line, INSIDE, sep, quote)).otherwise(True)}))


def _state_before(order: Window, first: Column) -> dict[str, Column]:
    """Running composition of the maps of all rows before a row, as columns
    for two projections: ``swaps`` and ``set``, then ``before``."""
    here = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("shut") & ~F.col("open")).cast("int")
    swaps = F.sum(swap).over(here)
    known = F.last(F.col("set"), ignorenulls=True).over(earlier)
    since = F.coalesce(F.sum(swap).over(earlier), F.lit(0)) - F.coalesce(known["swaps"], F.lit(0))
    begun = F.coalesce(known["state"], first).cast("int")
    return {"set": F.when(F.col("shut") == F.col("open"),
                          F.struct(F.col("shut").alias("state"), swaps.alias("swaps"))),
            "before": (begun + since) % 2 == 1}


def _splits(lines: DataFrame) -> DataFrame:
    """``file, block, begins``: whether a split begins inside quotes."""
    code = F.col("at") * 4 + F.col("shut").cast("int") * 2 + F.col("open").cast("int")
    # lines that leave the state as it is (shut -> shut, open -> open) are left out
    telling = F.when(F.col("shut") | ~F.col("open"), code)

    def end(first: bool) -> Column:
        return F.aggregate("codes", F.lit(first), lambda inside, c: F.when(
            inside, F.getbit(c, F.lit(0)) == 1).otherwise(F.getbit(c, F.lit(1)) == 1))

    maps = (lines.groupBy(*_SPLIT).agg(F.sort_array(F.collect_list(telling)).alias("codes"))
            .select(*_SPLIT, end(False).alias("shut"), end(True).alias("open")))
    state = _state_before(Window.partitionBy("file").orderBy("block"), F.lit(False))
    return (maps.withColumn("set", state["set"]).withColumn("begins", state["before"])
            .select(*_SPLIT, "begins"))


def read_records(spark: SparkSession, path: str | list[str], *, sep: str = ",", quote: str = '"',
                 header: bool = True, number: str | None = None) -> DataFrame:
    """``file, block, seq, record``: the CSV records of a file or folder. In a
    file, records are in the order of ``(block, seq)``; ``number`` names a
    column for their place in it (from 1 after the header, empty ones counted)."""
    lines = _lines(spark, path, sep, quote)
    order = Window.partitionBy(*_SPLIT).orderBy("at")
    # both scans cut the files alike; a split without its state must not pass
    begins = F.coalesce("begins", F.raise_error(F.lit("the file's splits changed while it was read")).cast("boolean"))
    state = _state_before(order, F.col("begins"))
    lines = (lines.join(_splits(lines), _SPLIT, "left").withColumn("begins", begins)
             .withColumn("set", state["set"]).withColumn("inside", state["before"])
             .withColumn("seq", F.sum((~F.col("inside")).cast("long"))
                         .over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("after", F.when(F.col("inside"), F.col("open")).otherwise(F.col("shut"))))
    joined = F.array_join(F.sort_array(F.collect_list(F.struct("at", "line")))["line"], "\n")
    pieces = lines.groupBy(*_SPLIT, "seq").agg(joined.alias("record"), F.max_by("after", "at").alias("after"))
    whole = pieces.filter((F.col("seq") > 0) & ~F.col("after")).drop("after")
    # a record that leaves its split, then the pieces that go on with it
    by_file = Window.partitionBy("file").orderBy("block", "seq")
    owner = F.last(F.when(F.col("seq") > 0, F.struct(F.col("block").alias("block"), F.col("seq").alias("seq"))),
                   ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, 0))
    crossing = (pieces.filter((F.col("seq") == 0) | F.col("after")).withColumn("owner", owner)
                .groupBy("file", "owner")
                .agg(F.array_join(F.sort_array(F.collect_list(F.struct("block", "seq", "record")))["record"], "\n")
                     .alias("record"))
                .select("file", "owner.block", "owner.seq", "record"))
    records = whole.unionByName(crossing).withColumn("record", F.regexp_replace("record", "\r$", ""))
    if number:
        sizes = records.groupBy(*_SPLIT).agg(F.max("seq").alias("n"))
        earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*_SPLIT, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
        place = F.col("offset") + F.col("seq") - int(header)
        records = records.join(offsets, _SPLIT).withColumn(number, place).drop("offset")
    if header:
        records = records.filter((F.col("block") > 0) | (F.col("seq") > 1))
    return records.filter(F.col("record") != "")


def parse_records(records: DataFrame, schema: T.StructType, *, sep: str = ",", quote: str = '"',
                  mode: str = "PERMISSIVE", corrupt: str | None = None) -> DataFrame:
    """The columns of ``schema``; ``corrupt`` names a column for the text of
    records that do not fit it."""
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": mode}
    wanted = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    if corrupt:
        wanted = wanted.add(corrupt, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields)
    return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
