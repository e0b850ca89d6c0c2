"""Run log, reject log and the queries over them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tulha.functions.columns import half_even, half_up, percent, ratio
from tulha.model import ENTITIES, REJECT_LOG
from tulha.operators.rules import judge, reject_log
from tulha.plans.shared import shared_path
from tulha.session import COMPRESSION, short_shuffles
from tulha.sources.raw_fixture import RawFixture

RUNS_SHOWN = 100
#: Entities judged at the same time: enough to fill the cluster at the end of each one's
#: stages, few enough that the disk holds the shuffles of two.
AT_ONCE = 2


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class StoredLog:
    """Logs of one load per month over the raw extracts, stored once and then queried.

    The first query of an application over a folder judges every raw row of every entity
    and writes the reject log and the run log (entities x months rows) to the shared
    folder; later queries read those files. The counts are real; there is no clock in the
    extracts, so a load is taken to end on the last day of its month, one entity per
    hour, at 1.5 ms a row.
    """

    def __init__(self, raw: RawFixture):
        self._raw = raw
        self._path = shared_path(raw.spark, "log", raw.folder, self._store)

    @staticmethod
    def _finished(run: Column, place: int) -> Column:
        month_end = F.last_day(F.to_date(F.substring(run, 5, 6), "yyyyMM")).cast("timestamp")
        return month_end + F.expr(f"INTERVAL {place + 1} HOURS")

    def _store(self, path: str) -> None:
        with short_shuffles(self._raw.spark):
            with ThreadPoolExecutor(AT_ONCE) as pool:
                list(pool.map(lambda e: self._store_rejects(path, *e), enumerate(ENTITIES)))
            self._store_runs(path)

    def _store_rejects(self, path: str, place: int, name: str) -> None:
        at = self._finished(F.col("_pipeline_run_id"), place)
        log = reject_log(judge(self._raw.extract(name), name), name, at)
        log.write.option("compression", COMPRESSION).parquet(f"{path}/rejects/{name}")

    def _read_rejects(self, path: str) -> DataFrame:
        return self._raw.spark.read.schema(REJECT_LOG).parquet(*[f"{path}/rejects/{n}" for n in ENTITIES])

    def _store_runs(self, path: str) -> None:
        run = F.col("_pipeline_run_id")
        read = []
        for place, name in enumerate(ENTITIES):
            rows = self._raw.extract(name)
            read.append(
                rows.groupBy(run.alias("pipeline_run_id"))
                .agg(F.count(F.lit(1)).alias("input_rows"))
                .withColumns({"entity": F.lit(name), "executed_at": self._finished(F.col("pipeline_run_id"), place)})
            )
        bad = (
            self._read_rejects(path)
            .groupBy("entity", F.col("pipeline_run").alias("pipeline_run_id"))
            .agg(F.count(F.lit(1)).alias("bad"))
        )
        runs = union_all(read).join(bad, ["entity", "pipeline_run_id"], "left")
        rejected = F.coalesce("bad", F.lit(0).cast("long"))
        seconds = F.col("input_rows") * F.lit(0.0015).cast("decimal(5,4)")
        runs.select(
            "pipeline_run_id", "entity", F.lit("SUCCESS").alias("status"), "input_rows",
            (F.col("input_rows") - rejected).alias("valid_rows"), rejected.alias("rejected_rows"),
            F.round(seconds, 3).cast("double").alias("elapsed_seconds"),
            F.lit("").alias("error_message"), "executed_at",
        ).coalesce(1).write.parquet(f"{path}/runs")

    def runs(self) -> DataFrame:
        """One row per run and entity."""
        return self._raw.spark.read.parquet(f"{self._path}/runs")

    def rejects(self) -> DataFrame:
        """One row per rejected row."""
        return self._read_rejects(self._path)


def plain_time(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz")


# --- run log -----------------------------------------------------------------
def api_execucoes(runs: DataFrame) -> DataFrame:
    """Latest entity loads with start, end and duration."""
    micros = F.unix_micros("executed_at") - F.round(F.col("elapsed_seconds") * 1000000).cast("long")
    seconds = (F.unix_micros("executed_at") - micros) / F.lit(1000000)
    return (
        runs.withColumns({"inicio": F.timestamp_micros(micros), "duracao": half_up(seconds, 2)})
        .orderBy(F.desc("inicio"), "pipeline_run_id", "entity")
        .limit(RUNS_SHOWN)
        .select(
            F.col("pipeline_run_id").alias("run_id"), F.col("entity").alias("entidade"), "status",
            F.col("input_rows").alias("linhas_lidas"), F.col("valid_rows").alias("linhas_validas"),
            F.col("rejected_rows").alias("linhas_rejeitadas"),
            plain_time("inicio").alias("inicio_execucao"),
            plain_time("executed_at").alias("fim_execucao"),
            F.col("duracao").alias("duracao_segundos"),
            F.col("error_message").alias("erro_mensagem"),
        )
    )


def dash_historico(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("executed_at"), "pipeline_run_id", "entity").select(
        "pipeline_run_id", "entity", "status", "input_rows", "valid_rows", "rejected_rows",
        half_up("elapsed_seconds", 2).alias("elapsed_s"),
        plain_time("executed_at").alias("executed_at"),
    )


def dash_execucoes_recentes(runs: DataFrame, n: int = 20) -> DataFrame:
    return dash_historico(runs).limit(n)


def api_rejeicoes(runs: DataFrame) -> DataFrame:
    """Rejected against read rows per entity, over loads that rejected something."""
    return (
        runs.filter(F.col("rejected_rows") > 0)
        .groupBy(F.col("entity").alias("entidade"))
        .agg(
            F.sum("rejected_rows").alias("total_rejeitadas"),
            F.sum("input_rows").alias("total_lidas"),
        )
        .withColumn("taxa_rejeicao_pct", percent("total_rejeitadas", "total_lidas", 2))
        .orderBy(F.desc("total_rejeitadas"), "entidade")
    )


def entity_report(runs: DataFrame) -> DataFrame:
    """Rows read, kept and rejected per entity, with the rejected share."""
    share = F.coalesce(ratio("rejeitadas", "entrada"), F.lit(0.0))
    return (
        runs.groupBy(F.col("entity").alias("entidade"))
        .agg(
            F.sum("input_rows").alias("entrada"),
            F.sum("valid_rows").alias("validas"),
            F.sum("rejected_rows").alias("rejeitadas"),
        )
        .withColumns(
            {
                "taxa_rejeicao_pct": half_even(share * 100, 1),
                "reject_rate": half_even(share, 4),
            }
        )
        .orderBy("entidade")
    )


def dash_taxa_ultima_execucao(runs: DataFrame) -> DataFrame:
    """Rejected share per entity in the latest run."""
    latest = runs.agg(F.max_by("pipeline_run_id", F.struct("executed_at", "pipeline_run_id")))
    read = F.when(F.col("input_rows") == 0, 1).otherwise(F.col("input_rows"))
    return (
        runs.filter(F.col("pipeline_run_id") == latest.scalar())
        .select("entity", half_even(ratio("rejected_rows", read) * 100, 1).alias("taxa_rejeicao"))
        .orderBy("entity")
    )


# --- reject log --------------------------------------------------------------
def dash_rejeitados(rejects: DataFrame) -> DataFrame:
    return rejects.orderBy(F.desc("logged_at"), "entity", "row_data").select(
        "entity", "reject_reason", plain_time("logged_at").alias("logged_at"),
        F.substring("row_data", 1, 120).alias("row_preview"),
    )


def dash_rejeicoes_motivo(rejects: DataFrame) -> DataFrame:
    return (
        rejects.groupBy("entity", "reject_reason")
        .agg(F.count(F.lit(1)).alias("qtd"))
        .orderBy("entity", "reject_reason")
    )


#: The value of each entity by which its rejected rows are counted.
SHOWN = {
    "produtos": "categoria", "clientes": "estado", "pedidos_venda": "status",
    "movimentacoes_estoque": "tipo_mov",
}


def rejeicoes_por_valor(rejects: DataFrame) -> DataFrame:
    """Rejected rows by a value inside the logged row, read as VARIANT; null where it had none."""
    row = F.try_parse_json("row_data")
    value = F.coalesce(*[
        F.when(F.col("entity") == name, F.try_variant_get(row, f"$.{field}", "string"))
        for name, field in SHOWN.items()
    ])
    return (
        rejects.filter(F.col("entity").isin(list(SHOWN)))
        .groupBy(F.col("entity").alias("entidade"), value.alias("valor"), F.col("reject_reason").alias("motivo"))
        .agg(F.count(F.lit(1)).alias("qtd"))
    )


def dash_qualidade_kpis(runs: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: rejected rows, entities watched, runs."""
    total = rejects.agg(F.count("entity")).scalar()
    return runs.agg(
        F.countDistinct("entity").alias("entidades_monitoradas"),
        F.countDistinct("pipeline_run_id").alias("execucoes"),
    ).select(total.alias("total_rejeitados"), "entidades_monitoradas", "execucoes")
