"""Raw CSV sources (S-01 ... S-12) and warehouse table reads (S-13).

Every raw table is read with its declared schema - never inferred - and in
PERMISSIVE mode, so a value that does not parse as its column type becomes
NULL instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DERIVED_SCHEMAS, RAW_SCHEMAS, schema_of
from ..storage import current_path
from .records import parse_records, read_records
from .text_layer import read_text_table  # noqa: F401 - also found here

# Tables whose free text may contain quoted line breaks. Their records are found
# by :mod:`.records`, which still splits the files; other tables need no such step.
MULTILINE_TABLES = frozenset({"order_reviews"})


#: Column of a record's rejected values, and the entry for a record that has
#: another number of fields than its table.
REJECTS = "_rejects"
WHOLE_RECORD = "<record>"
_CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, *,
             sep: str = ",", header: bool = True, multi_line: bool = False,
             keep_empty_strings: bool = False, strict_delimited: bool = False,
             mode: str = "PERMISSIVE", rejects: bool = False) -> DataFrame:
    """Read delimited text with an explicit schema.

    ``multi_line`` lets quoted values hold line breaks; files are still split
    (:mod:`.records`). ``strict_delimited=True`` turns quote handling off, like
    a plain delimited text table: quotes stay in the values and an embedded
    delimiter shifts the columns. ``keep_empty_strings=True`` reads empty
    text fields as ``''`` rather than NULL (numeric columns stay NULL).
    ``rejects=True`` adds the column ``_rejects``, an array of
    ``(column, value)`` for every value that became NULL because it does not
    parse, found in the same pass.
    """
    quote = "" if strict_delimited else '"'
    if multi_line and not strict_delimited:
        df = parse_records(read_records(spark, path, sep=sep, quote=quote, header=header), schema,
                           sep=sep, quote=quote, mode=mode, corrupt=_CORRUPT if rejects else None)
    else:
        wanted = T.StructType(list(schema.fields))
        reader = (spark.read.option("header", str(header).lower()).option("sep", sep)
                  .option("mode", mode).option("quote", quote))
        if not strict_delimited:
            reader = reader.option("escape", quote)
        if rejects:
            wanted = wanted.add(_CORRUPT, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", _CORRUPT)
        df = reader.schema(wanted).csv(path)
    if rejects:
        df = df.withColumn(REJECTS, _rejected(schema, sep, quote)).drop(_CORRUPT)
    if keep_empty_strings:
        text = {f.name: F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields
                if isinstance(f.dataType, T.StringType)}
        df = df.withColumns(text) if text else df
    return df


def _rejected(schema: T.StructType, sep: str, quote: str) -> Column:
    """``(column, value)`` of the values lost in a row: only a record marked
    corrupt is parsed again, as text, and its fields set beside the row's."""
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE"}
    if quote:
        options["escape"] = quote
    as_text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    field = F.from_csv(_CORRUPT, as_text, options)

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("column"), value.alias("value"))

    lost = F.array_compact(F.array(*[
        F.when(F.col(f.name).isNull() & field[f.name].isNotNull(), entry(f.name, field[f.name]))
        for f in schema.fields]))
    whole = F.array(entry(WHOLE_RECORD, F.col(_CORRUPT)))
    none = F.array().cast("array<struct<column:string,value:string>>")
    return F.when(F.col(_CORRUPT).isNull(), none).when(F.array_size(lost) > 0, lost).otherwise(whole)


def reject_report(df: DataFrame) -> DataFrame:
    """``column, value, cnt`` of the values that a read with ``rejects=True``
    could not parse."""
    return (df.select(F.explode(REJECTS).alias("r")).groupBy("r.column", "r.value")
            .agg(F.count(F.lit(1)).alias("cnt")))


def read_source(spark: SparkSession, root: str, name: str, *, path: str | None = None,
                **options) -> DataFrame:
    """Read raw table ``name`` from ``root/name`` (a CSV file or folder)."""
    if name not in RAW_SCHEMAS:
        raise KeyError(f"unknown raw table {name!r}; expected one of {sorted(RAW_SCHEMAS)}")
    options.setdefault("multi_line", name in MULTILINE_TABLES)
    return read_csv(spark, path or f"{root.rstrip('/')}/{name}", RAW_SCHEMAS[name], **options)


def read_sources(spark: SparkSession, root: str, names=None, **options) -> dict[str, DataFrame]:
    return {n: read_source(spark, root, n, **options) for n in (names or RAW_SCHEMAS)}


def read_table(spark: SparkSession, root: str | None, name: str) -> DataFrame:
    """Read a warehouse table: a catalog table when ``root`` is None (the
    name may carry a database prefix), else the current version of ``root/name``
    (or the plain Parquet folder), typed by its contract schema when it has one."""
    if root is None:
        return spark.table(name)
    reader = spark.read
    if name in RAW_SCHEMAS or name in DERIVED_SCHEMAS:
        reader = reader.schema(schema_of(name))  # known contract: skip footer inference
    return reader.parquet(current_path(spark, root, name))
