"""Landing raw files into the warehouse (L-01) and post-load counts (L-02).

Landing parses each raw CSV once, with its declared schema, and writes typed
Parquet. The row count and the counts of values that did not parse are collected
during the write with ``observe`` - no second pass over the data.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_SCHEMAS, RAW_TABLES
from ..storage import Store, publish, table_folder
from .bucketed import write_bucketed
from .raw import REJECTS, WHOLE_RECORD, read_source

log = logging.getLogger(__name__)

# Default landing map: table -> file under the source folder. Pass your own
# map when the raw files carry other names.
DEFAULT_FILE_MAP = {name: f"{name}.csv" for name in RAW_TABLES}


# Tables that are joined on the order.
ORDER_TABLES = ("orders", "order_items", "order_payments")


def land_table(spark: SparkSession, src_path: str, dst: str, name: str, *,
               buckets: int | None = None, **options) -> dict:
    """Land one raw table as the new version of ``dst/name``; with ``buckets``
    the order tables are bucketed by order, which saves later joins an exchange. Rows and the
    values that did not parse (per column) are counted during the write. Only an
    absent source is ``skipped``; one that can't be read raises."""
    # An empty text field lands as '' (not NULL), as in the delimited text
    # tables the raw layer replaces; numbers that are empty stay NULL.
    options = {"keep_empty_strings": True, **options}
    try:
        df = read_source(spark, "", name, path=src_path, rejects=True, **options)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("skip %s: %s", name, e)
        return {"tbl": name, "status": "skipped", "rows": None, "rejected": None,
                "path": table_folder(dst, name), "error": str(e).splitlines()[0]}
    obs = Observation(f"land_{name}")
    typed = [f.name for f in RAW_SCHEMAS[name].fields if not isinstance(f.dataType, T.StringType)]
    lost = [_lost(c).alias(f"lost_{i}") for i, c in enumerate([*typed, WHOLE_RECORD])]
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), *lost).drop(REJECTS)
    if buckets and name in ORDER_TABLES:
        path = write_bucketed(df, dst, name, "order_id", buckets)
    else:
        path = publish(spark, dst, name, lambda p: df.write.parquet(p))
    seen = obs.get
    rejected = {c: seen[f"lost_{i}"] for i, c in enumerate([*typed, WHOLE_RECORD]) if seen[f"lost_{i}"]}
    return {"tbl": name, "status": "ok", "rows": seen["rows"], "rejected": rejected, "path": path,
            "error": None}


def _lost(column: str) -> Column:
    return F.sum(F.exists(REJECTS, lambda r: r["column"] == column).cast("long"))


def land_all(spark: SparkSession, src: str, dst: str,
             file_map: Mapping[str, str] | None = None, parallel_jobs: int = 4, **options) -> list[dict]:
    """Land every raw table of ``file_map`` (table -> file under ``src``), as
    concurrent jobs, the largest sources first, so that no large one is left to
    run alone at the end. A missing file is reported as ``skipped``; a re-run
    replaces the tables."""
    file_map = dict(file_map or DEFAULT_FILE_MAP)
    store = Store(spark, src)
    paths = {name: f"{src.rstrip('/')}/{file}" for name, file in file_map.items()}
    size = {name: store.size(path) for name, path in paths.items()}
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        runs = {name: pool.submit(land_table, spark, paths[name], dst, name, **options)
                for name in sorted(paths, key=lambda n: -size[n])}
        return [runs[name].result() for name in file_map]


def landing_report(spark: SparkSession, report: list[dict]) -> DataFrame:
    """``tbl, status, rows, rejected`` (all rejected values) per landed table."""
    return spark.createDataFrame(
        [(r["tbl"], r["status"], r["rows"], None if r["rejected"] is None else sum(r["rejected"].values()))
         for r in report], "tbl string, status string, rows long, rejected long")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One ``(tbl, cnt)`` row per table, as one frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("cnt"))
               .select(F.lit(name).alias("tbl"), F.col("cnt"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
