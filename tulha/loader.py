"""One load of every source: extract, check, clean, split, store, log."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tulha.model import ENTITIES
from tulha.operators.calendar import build_calendar
from tulha.operators.quality import referential_checks, run_checks
from tulha.operators.rules import judge, reject_log, rejected_rows, valid_rows
from tulha.session import shared_dir, short_shuffles, stored_rows
from tulha.sinks.kept import upsert_kept
from tulha.sinks.warehouse import Warehouse
from tulha.sources.csv_files import ExtractError, extract
from tulha.sources.landing import missing_files

DQ_TABLE = "dq_resultados"
MUST_HAVE_ROWS = ["dim_produtos", "dim_clientes", "fct_pedidos_venda", "fct_movimentacoes_estoque"]


@dataclass
class LoadResult:
    run_id: str
    status: str = "SUCCESS"
    entities: list[dict] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    elapsed_seconds: float = 0.0

    def total(self, name: str) -> int:
        return sum(e[name] for e in self.entities)


def new_run_id() -> str:
    return f"{dt.datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def check_landing(spark: SparkSession, folder: str) -> None:
    """Raise when an expected file is absent or empty."""
    missing = missing_files(spark, folder, [f"{n}.csv" for n in ENTITIES]).collect()
    if missing:
        names = ", ".join(f"{r['arquivo']} ({r['motivo']})" for r in missing)
        raise FileNotFoundError(f"missing or empty files: {names}")


def store(
    warehouse: Warehouse, name: str, staged: DataFrame, batch: str, date_mode: str = "per_value"
) -> dict:
    """Judge staged rows, store both sides, and return the counts.

    The target comes last: running a batch again replaces its logs and gives the same
    target rows.
    """
    entity, seen = ENTITIES[name], Observation()
    bad = F.col("_reject_reason").isNotNull()
    judged = judge(staged, name, date_mode)
    judged = judged.observe(seen, F.count(F.lit(1)).alias("i"), F.count_if(bad).alias("r"))
    with stored_rows(judged) as judged:
        counts = {"i": 0, "r": 0, **seen.get}  # counted while the rows are stored
        if counts["r"]:
            log = reject_log(judged, name, F.current_timestamp())
            warehouse.append(log, "log_registros_rejeitados", f"{batch}-{name}")
            warehouse.write_reject_csv(rejected_rows(judged, name), name, batch)
        if entity.dedup:
            # One row per key is left; any order will do.
            latest = [F.col(c) for c in entity.key]
        else:
            latest = [F.desc("_ord")]
        good = valid_rows(judged, name, keep=["_ord"])
        if warehouse.keeps_sums:
            upsert_kept(warehouse, good, entity, f"{batch}-{name}", latest)
        else:
            warehouse.upsert_entity(good, entity, latest, one_per_key=entity.dedup)
    rows, rejected = counts["i"], counts["r"]
    return {"entity": name, "input": rows, "valid": rows - rejected, "rejected": rejected}


def load_entity(
    warehouse: Warehouse, name: str, path: str, run_id: str, date_mode: str = "per_value"
) -> dict:
    """Load one source; returns its row counts and, after a failed read, the error."""
    spark, entity = warehouse.spark, ENTITIES[name]
    started = time.perf_counter()
    counts = {"entity": name, "input": 0, "valid": 0, "rejected": 0}
    status, problem = "SUCCESS", ""
    try:
        raw = extract(spark, path, entity, run_id)
        # The staged copy fixes row order and row ids for everything that follows.
        warehouse.replace(raw, entity.staging)
        staged = warehouse.read(entity.staging, raw.schema)
        checks = run_checks(staged, name, entity.required)
        checks = checks.withColumn("pipeline_run_id", F.lit(run_id))
        warehouse.append(checks, DQ_TABLE, f"{run_id}-{name}")
        counts = store(warehouse, name, staged, run_id, date_mode)
    except ExtractError as error:
        status, problem = "EXTRACT_ERROR", str(error)
    numbers = (counts["input"], counts["valid"], counts["rejected"])
    elapsed = time.perf_counter() - started
    warehouse.log_run(run_id, name, status, numbers, elapsed, problem, F.current_timestamp())
    return {**counts, "error": problem}


def load_all(
    spark: SparkSession,
    sources: dict[str, str],
    root: str,
    run_id: str | None = None,
    calendar: tuple[str, str] = ("2024-01-01", "2025-12-31"),
    date_mode: str = "per_value",
    at_once: int = 4,
) -> LoadResult:
    """Load every entity; one that cannot be read is logged and skipped.

    Entities do not depend on one another (references are checked afterwards), so
    several are submitted at once and Spark fills the cluster with their tasks.
    """
    result = LoadResult(run_id or new_run_id())
    warehouse = Warehouse(spark, root)
    shared_dir(spark)
    started = time.perf_counter()

    def one(name: str) -> dict:
        return load_entity(warehouse, name, sources[name], result.run_id, date_mode)

    with short_shuffles(spark):
        with ThreadPoolExecutor(at_once) as pool:
            loaded = list(pool.map(one, ENTITIES))
        result.entities = [e for e in loaded if not e["error"]]
        result.errors = [e["error"] for e in loaded if e["error"]]
        warehouse.replace(build_calendar(spark, *calendar), "dim_tempo")
        orphans = referential_checks(warehouse.star())
        orphans = orphans.withColumn("pipeline_run_id", F.lit(result.run_id))
        warehouse.append(orphans, DQ_TABLE, f"{result.run_id}-referencias")
    result.status = "PARTIAL" if result.errors else "SUCCESS"
    result.elapsed_seconds = round(time.perf_counter() - started, 2)
    return result


def check_loaded(warehouse: Warehouse) -> None:
    """Raise when a table every load must fill is empty."""
    empty = warehouse.empty_tables(MUST_HAVE_ROWS)
    if empty:
        raise ValueError(f"tables empty after the load: {empty}")
