"""Tables at rest as delimited text (S-11, L-03): one line a row, fields
separated by a tab, no header, ``\\N`` for NULL.

An empty text and NULL stay apart. A delimiter, line break or backslash inside
a value is escaped by a backslash, so every value survives; values without them
are written as they are. Reading casts each field to the contract type; a value
that does not fit becomes NULL, as in any table over text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform, schema_of
from ..storage import current_path, publish

NULL = "\\N"
#: Escaped characters and the letter that stands for each after a backslash.
ESCAPES = (("\t", "t"), ("\n", "n"), ("\r", "r"))


def escaped(value: Column, sep: str = "\t") -> Column:
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for char, letter in ESCAPES:
        out = F.replace(out, F.lit(char), F.lit("\\" + letter))
    if sep != "\t":
        out = F.replace(out, F.lit(sep), F.lit("\\s"))
    return out


def unescaped(field: Column, sep: str = "\t") -> Column:
    def plain(part: Column) -> Column:
        for char, letter in ESCAPES:
            part = F.replace(part, F.lit("\\" + letter), F.lit(char))
        return F.replace(part, F.lit("\\s"), F.lit(sep)) if sep != "\t" else part

    # between doubled backslashes every backslash begins an escape
    return F.array_join(F.transform(F.split(field, r"\\\\", -1), plain), "\\")


def text_lines(df: DataFrame, sep: str = "\t") -> DataFrame:
    """``value``: one line per row of ``df``."""
    def text(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`").cast("string")
        if sep == "\t" and isinstance(f.dataType, (T.NumericType, T.DateType, T.BooleanType)):
            return value  # holds nothing to escape
        return escaped(value, sep)

    fields = [F.coalesce(text(f), F.lit(NULL)) for f in df.schema.fields]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def _pattern(sep: str) -> str:
    """``sep`` as a pattern; one character alone is searched for without a regular expression."""
    if len(sep) != 1:
        return "\\Q" + sep + "\\E"
    return sep if sep.isalnum() or sep.isspace() else "\\" + sep


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = "\t") -> DataFrame:
    """The rows of ``lines`` (``value``); missing fields are NULL, further ones ignored."""
    fields = lines.select(F.split("value", _pattern(sep), -1).alias("fields"))

    def column(i: int, f: T.StructField) -> Column:
        raw = F.get("fields", F.lit(i))
        # without a backslash there is nothing to undo
        plain = F.when(F.contains(raw, F.lit("\\")), unescaped(raw, sep)).otherwise(raw)
        value = F.when(raw != NULL, plain)
        return (value if isinstance(f.dataType, T.StringType) else value.try_cast(f.dataType)).alias(f.name)

    return fields.select(*[column(i, f) for i, f in enumerate(schema.fields)])


def write_text_table(df: DataFrame, root: str, name: str, sep: str = "\t") -> str:
    """Publish ``df`` as text table ``name`` (typed by its contract); returns
    the path of the new version."""
    lines = text_lines(conform(df, name), sep)
    return publish(df.sparkSession, root, name,
                   lambda path: lines.write.option("lineSep", "\n").text(path))


def read_text_table(spark: SparkSession, path: str, name: str, sep: str = "\t") -> DataFrame:
    """Read text table ``name`` from the folder ``path`` (or its current
    version), typed by its contract schema."""
    root, _, folder = path.rstrip("/").rpartition("/")
    lines = spark.read.option("lineSep", "\n").text(current_path(spark, root, folder))
    return parse_lines(lines, schema_of(name), sep)
