"""Registered queries that read tables and views of the catalog by name."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tulha.model import ENTITIES, Entity
from tulha.plans import views
from tulha.plans.shared import shared_path
from tulha.sinks.catalog import CatalogWarehouse
from tulha.sources.fixture import FixtureStar
from tulha.sources.star import Star


def _registered(spark: SparkSession, root: str) -> CatalogWarehouse:
    return CatalogWarehouse(spark, root, f"tulha_{hashlib.md5(root.encode()).hexdigest()[:12]}")


def as_stored(star: Star, entity: Entity) -> DataFrame:
    """A table of the star in the columns and types that a warehouse stores."""
    rows = star.table(entity.table)
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in entity.schema
    ]
    return rows.select(*columns).fillna(1, "_is_active")


def catalog(spark: SparkSession, sf_dir: str) -> CatalogWarehouse:
    """The star in catalog tables: written once, and registered over its files for a query."""

    def build(root: str) -> None:
        star, warehouse = FixtureStar(spark, sf_dir), _registered(spark, root)
        for entity in ENTITIES.values():
            warehouse.replace(as_stored(star, entity), entity.table)
        warehouse.replace(star.table("dim_tempo"), "dim_tempo")

    return _registered(spark, shared_path(spark, "catalogo", sf_dir, build))


def view_by_name(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A view of the catalog, its keys in the types of the given tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = spark.table(catalog(spark, sf_dir).name(name))
        types = dict(getattr(views, name)(FixtureStar(spark, sf_dir)).dtypes)
        return found.select(*[F.col(c).cast(types[c]).alias(c) for c in found.columns])

    return run
