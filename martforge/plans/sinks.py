"""Sinks: table writes (L-03), CSV export (L-05, L-06), catalog registration
(L-07) and preview (L-08).

Every write replaces the whole table, so re-running a build is idempotent; a
table is replaced only when its write has succeeded (:mod:`martforge.storage`).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import (DERIVED_SCHEMAS, MART_TABLES, RAW_SCHEMAS, SORT_KEYS,
                       SUMMARY_TABLES, conform)
from ..sources.raw import read_table
from ..storage import Store, current_path, publish, table_folder

log = logging.getLogger(__name__)

DEFAULT_EXPORT_TABLES = list(MART_TABLES)


def table_path(root: str, name: str) -> str:
    return table_folder(root, name)


def write_table(df: DataFrame, root: str, name: str, *, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> str:
    """Replace table ``name`` under ``root``; returns the path of the new
    version. A contract table is written with its column comments."""
    if name in RAW_SCHEMAS or name in DERIVED_SCHEMAS:
        df = conform(df, name, comments=True)
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return publish(df.sparkSession, root, name, w.save)


def presentation_order(df: DataFrame, name: str) -> DataFrame:
    """Sort a mart into its presentation order (a distributed range sort)."""
    keys = SORT_KEYS.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
                        for c, asc in keys])


def export_csv(df: DataFrame, out: str, *, name: str | None = None,
               single_file: bool = True, sep: str = ",", **options: str) -> int:
    """Write ``df`` as header CSV into the folder ``out`` (replaced when the
    write has succeeded) and return the row count, observed during the write.

    With ``name`` the rows are range-sorted into presentation order.
    ``single_file`` still writes that sort's parts in parallel, without headers;
    the parts are then joined in order behind one header line, by the file
    system's own concatenation or one streaming copy. ``options`` go to the
    CSV writer."""
    spark = df.sparkSession
    if name:
        df = presentation_order(df, name)
    store, staged = Store(spark, out), f"{out.rstrip('/')}.writing-{uuid.uuid4().hex[:8]}"
    obs = Observation(f"export_{name or 'table'}")
    try:
        (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.options(**options)
           .option("header", str(not single_file).lower()).option("sep", sep).csv(staged))
        if single_file:
            parts = [f"{staged}/{n}" for n in store.names(staged) if n.startswith("part-")]
            store.write(f"{staged}/part-00000.csv.header", _header_line(df.columns, sep))
            store.join(parts, f"{staged}/part-00000.csv.header")
            for part in parts:
                if store.exists(part):  # a concatenation uses its sources up
                    store.delete(part)
            store.rename(f"{staged}/part-00000.csv.header", f"{staged}/part-00000.csv")
        store.delete(out)
        store.rename(staged, out)
    except BaseException:
        store.delete(staged)
        raise
    return obs.get["rows"]


def _header_line(columns: Sequence[str], sep: str) -> str:
    def quoted(name: str) -> str:
        plain = not any(x in name for x in (sep, '"', "\n"))
        return name if plain else '"' + name.replace('"', '""') + '"'

    return sep.join(map(quoted, columns)) + "\n"


def _export_one(spark: SparkSession, root: str | None, name: str, out: str, db: str | None) -> dict:
    target = table_path(out, name)
    try:
        df = read_table(spark, root, name if root is not None or not db else f"{db}.{name}")
        return {"table": name, "status": "ok", "rows": export_csv(df, target, name=name),
                "path": target, "error": None}
    except Exception as e:  # report and go on with the next table
        log.warning("export of %s failed: %s", name, e)
        return {"table": name, "status": "failed", "rows": None, "path": target,
                "error": str(e).splitlines()[0] if str(e) else type(e).__name__}


def run_export(spark: SparkSession, root: str | None, tables: Sequence[str] | None,
               out: str, *, db: str | None = None, parallel_jobs: int = 4) -> list[dict]:
    """Export marts to ``out/<table>`` as concurrent jobs, reported in the
    order asked for. A blank list falls back to the ten marts; a failing table
    is reported and skipped."""
    names = [t.strip() for t in (tables or []) if t and t.strip()] or DEFAULT_EXPORT_TABLES
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        return list(pool.map(lambda n: _export_one(spark, root, n, out, db), names))


def export_report(spark: SparkSession, report: Sequence[dict]) -> DataFrame:
    """``table, status, rows, error`` per exported table, in order."""
    return spark.createDataFrame(
        [(r["table"], r["status"], r["rows"], r["error"]) for r in report],
        "`table` string, status string, rows long, error string")


def register_all(spark: SparkSession, root: str, db: str,
                 names: Sequence[str] | None = None) -> DataFrame:
    """Create database ``db`` and (re)register the current version of each
    table under ``root`` as an external Parquet table; returns the table list.
    Run it again after a build, which publishes new versions."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    names = list(names or [*RAW_SCHEMAS, "trade_detail", *SUMMARY_TABLES, *MART_TABLES])
    for name in names:
        path = current_path(spark, root, name)
        try:
            spark.read.parquet(path).schema  # noqa: B018 - existence check
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # unreadable is not the same as absent
            continue
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
        spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet")
    return spark.createDataFrame(
        [(t.name, t.tableType) for t in spark.catalog.listTables(db)],
        "tableName string, tableType string")


def describe(spark: SparkSession, db: str, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE `{db}`.`{name}`")


def catalog_report(spark: SparkSession, db: str, names: Sequence[str] | None = None) -> DataFrame:
    """``tbl, position, column, type, comment, status`` of the tables of a
    database as the session's catalog has them, set beside their contracts:
    ``ok``, ``type`` or ``comment`` (that differs), ``extra`` (not in the
    contract), ``missing``, or ``free`` for a table without a contract."""
    names = sorted(names or [t.name for t in spark.catalog.listTables(db)])
    rows = []
    for name in names:
        contract = RAW_SCHEMAS.get(name) or DERIVED_SCHEMAS.get(name)
        wanted = {f.name: (f.dataType.simpleString(), f.metadata.get("comment")) for f in contract or ()}
        there = spark.catalog.tableExists(f"{db}.{name}")
        seen = spark.catalog.listColumns(f"{db}.{name}") if there else []
        for i, c in enumerate(seen):
            kind, comment = wanted.pop(c.name, (None, None))
            status = ("free" if contract is None else "extra" if kind is None else "type" if kind != c.dataType
                      else "comment" if comment != c.description else "ok")
            rows.append((name, i + 1, c.name, c.dataType, c.description, status))
        rows += [(name, None, column, kind, comment, "missing") for column, (kind, comment) in wanted.items()]
    return spark.createDataFrame(
        rows, "tbl string, position int, `column` string, type string, comment string, status string")


def preview(df: DataFrame, n: int = 10, name: str | None = None) -> DataFrame:
    """``SELECT * ... LIMIT n`` (in presentation order when ``name`` is a mart)."""
    if name:
        df = presentation_order(df, name)
    return df.limit(n)
