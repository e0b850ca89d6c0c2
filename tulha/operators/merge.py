"""Upsert as a plan: replaced rows leave, the last source row per key comes in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tulha.operators.dedup import keep_first


def incoming(
    source: DataFrame, schema: T.StructType, keys: list[str], latest: list[Column],
    defaults: dict[str, object] | None = None, one_per_key: bool = False,
) -> DataFrame:
    """The rows of ``source`` that go into a table: one per key, in the table's types.

    ``latest`` orders the rows of one key so that the winning (last) one is
    first. Columns the source omits take their defaults; an explicit null stays.
    ``one_per_key`` says that no key repeats.
    """
    last = source if one_per_key else keep_first(source, keys, latest)
    for field in schema:
        if field.name not in last.columns:
            value = (defaults or {}).get(field.name)
            last = last.withColumn(field.name, F.lit(value).cast(field.dataType))
    return last.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def untouched(target: DataFrame, last: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the target whose key does not come in."""
    return target.join(last.select(*keys), keys, "left_anti")


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], latest: list[Column],
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """``target`` with every row of ``source`` inserted or replaced as a whole."""
    last = incoming(source, target.schema, keys, latest, defaults)
    return untouched(target, last, keys).unionByName(last)
