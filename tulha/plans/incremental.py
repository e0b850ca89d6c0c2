"""Registered queries over views that are kept batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tulha.model import ENTITIES, Entity
from tulha.operators.dedup import keep_first
from tulha.plans import views
from tulha.plans.cataloged import as_stored
from tulha.plans.shared import shared_path
from tulha.session import short_shuffles, stored_rows
from tulha.sinks.kept import KeptStar, kept_sums, upsert_kept
from tulha.sinks.warehouse import Warehouse
from tulha.sources.fixture import FixtureStar

LINES, MOVES = ENTITIES["itens_pedido_venda"], ENTITIES["movimentacoes_estoque"]


def _share(entity: Entity) -> Column:
    return F.pmod(F.xxhash64(*entity.key), F.lit(10))


def _batches(rows: DataFrame, entity: Entity) -> list[DataFrame]:
    """Three batches that end as ``rows``: the second and third replace rows of the first,
    which then had other values, or for movements another product."""
    share = _share(entity)
    wrong = {"valor_total_item": F.col("valor_total_item") + 1} if entity is LINES else {
        "cod_produto": F.lit("1"), "qty_sinal": -F.col("qty_sinal"),
    }
    kinds = {f.name: f.dataType for f in entity.schema}
    early = rows.withColumns({c: F.when(share.between(4, 5), v).otherwise(F.col(c)).cast(kinds[c]) for c, v in wrong.items()})
    return [early.filter(share <= 5), rows.filter(share.between(5, 8)), rows.filter((share == 4) | (share == 9))]


class _LinesOnce(FixtureStar):
    """The star of a folder over lines that were stored after the keep-first step."""

    def __init__(self, star: FixtureStar, lines: DataFrame):
        super().__init__(star.spark, star._dir)
        self._first = lines

    def _lines(self, orders: DataFrame | None = None) -> DataFrame:
        return self._first if orders is None else super()._lines(orders)


def _kept(spark: SparkSession, sf_dir: str) -> KeptStar:
    """A warehouse after three batches of lines and movements, the second one run twice."""

    def in_batches(star: FixtureStar, warehouse: Warehouse, entity: Entity) -> None:
        latest, rows = [F.col(c) for c in entity.key], as_stored(star, entity)
        # Lines have one row per key, straight from stored rows; movements, whose number is
        # made of two columns and which take a join, are worked out once for all batches.
        once = nullcontext(rows) if entity is LINES else stored_rows(keep_first(rows, list(entity.key), latest))
        with once as stored:
            for number, rows in enumerate(_batches(stored, entity)):
                for _ in range(2 if number == 1 else 1):
                    upsert_kept(warehouse, rows, entity, f"lote{number}", latest, one_per_key=True)
                if number == 1:
                    kept_sums(warehouse)[entity.name].compact()

    def others(star: FixtureStar, warehouse: Warehouse) -> None:
        for entity in ENTITIES.values():
            if entity not in (LINES, MOVES):
                warehouse.replace(as_stored(star, entity), entity.table)
        warehouse.replace(star.table("dim_tempo"), "dim_tempo")

    def build(root: str) -> None:
        star, warehouse = FixtureStar(spark, sf_dir), Warehouse(spark, root, keeps_sums=True)
        with short_shuffles(spark), stored_rows(star._lines()) as lines, ThreadPoolExecutor(3) as pool:
            star = _LinesOnce(star, lines)
            jobs = [pool.submit(in_batches, star, warehouse, e) for e in (LINES, MOVES)]
            for job in [*jobs, pool.submit(others, star, warehouse)]:
                job.result()

    return KeptStar(Warehouse(spark, shared_path(spark, "mantidas", sf_dir, build), keeps_sums=True))


def kept_view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A view over kept sums, its keys in the types of the given tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = getattr(views, name)(_kept(spark, sf_dir))
        types = dict(getattr(views, name)(FixtureStar(spark, sf_dir)).dtypes)
        return found.select(*[F.col(c).cast(types[c]).alias(c) for c in found.columns])

    return run
