"""Tables bucketed by a key, so that what groups or joins on it needs no exchange.

A bucketed table is an ordinary versioned table (:mod:`martforge.storage`) whose
version folder also holds a small file naming the key and the number of buckets.
:func:`read_bucketed` registers that folder with its bucketing in the session's
catalog and reads it; :func:`martforge.sources.raw.read_table` still reads it as
plain Parquet, whose splits adaptive execution may balance. Callers choose the
plain read where a single key holds a large share of the rows, as its bucket
would be one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DERIVED_SCHEMAS, RAW_SCHEMAS, conform
from ..storage import Store, current_path, publish
from .raw import read_table

BUCKETING = "_bucketing"


def default_buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_bucketed(df: DataFrame, root: str, name: str, key: str, buckets: int | None = None) -> str:
    """Replace table ``name`` by ``df`` bucketed and sorted by ``key``."""
    spark = df.sparkSession
    buckets = buckets or default_buckets(spark)
    if name in RAW_SCHEMAS or name in DERIVED_SCHEMAS:
        df = conform(df, name, comments=True)
    table = _table_name(name)

    def write(path: str) -> None:
        try:
            # one file a bucket; no exchange where df is already dealt like this
            (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
               .option("path", path).saveAsTable(table))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: its files stay
        Store(spark, path).write(f"{path}/{BUCKETING}", f"{key} {buckets}")

    return publish(spark, root, name, write)


def read_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` with its bucketing, or as :func:`read_table` has it if
    it was written without."""
    path = current_path(spark, root, name)
    made = Store(spark, path).read(f"{path}/{BUCKETING}")
    if made is None:
        return read_table(spark, root, name)
    key, buckets = made.split()
    table = _table_name(name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_table(spark, root, name).schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def _table_name(name: str) -> str:
    return f"`{name}_{uuid.uuid4().hex[:12]}`"
