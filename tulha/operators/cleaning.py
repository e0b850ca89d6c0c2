"""Row cleaning shared by every entity: names, null tokens, types, text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from tulha.functions.columns import parse_date, parse_integer, parse_number
from tulha.model import DATE_FORMATS, NULL_TOKENS, Entity


def standard_name(name: str) -> str:
    """Trimmed, lower case, blanks to underscores, other marks removed."""
    return re.sub(r"[^\w]", "", re.sub(r"\s+", "_", name.strip().lower()))


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace the text tokens that stand for a missing value by null."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in names}
    )


BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def trim_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: F.btrim(f.name, F.lit(BLANKS))
            for f in df.schema
            if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")
        }
    )


def voted_formats(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """One date format per column, by vote over the whole column.

    A format wins when it reads more rows than it fails on (nulls count as
    failures); when none does, the last format is kept. One aggregate pass; one
    row of counts comes back to the driver.
    """
    counts = [
        F.count(parse_date(c, [f])).alias(f"{c}|{i}")
        for c in columns
        for i, f in enumerate(DATE_FORMATS)
    ]
    row = df.agg(F.count(F.lit(1)).alias("n"), *counts).first()
    chosen = {}
    for c in columns:
        hits = [row[f"{c}|{i}"] for i in range(len(DATE_FORMATS))]
        winners = [f for f, h in zip(DATE_FORMATS, hits) if h > row["n"] - h]
        chosen[c] = winners[0] if winners else DATE_FORMATS[-1]
    return chosen


def to_types(df: DataFrame, entity: Entity, date_mode: str = "per_value") -> DataFrame:
    """Cast the text columns of an entity; unreadable values become null."""
    present = [c for c in entity.columns if c in df.columns]
    dates = [c for c in entity.of_kind("date") if c in present]
    formats = (
        {c: [f] for c, f in voted_formats(df, dates).items()}
        if date_mode == "column_vote" and dates
        else {c: DATE_FORMATS for c in dates}
    )
    typed = {}
    for c in present:
        kind = entity.columns[c]
        if kind == "date":
            typed[c] = parse_date(c, formats[c])
        elif kind == "num":
            typed[c] = parse_number(c)
        elif kind == "int":
            typed[c] = parse_integer(c)
    return df.withColumns(typed) if typed else df


def clean(df: DataFrame, entity: Entity, date_mode: str = "per_value") -> DataFrame:
    """Names, types and text of one entity, in that order.

    A column the source omits takes its default; an empty value stays null.
    """
    named = standardize_names(df)
    missing = [c for c in entity.columns if c not in named.columns]
    if missing:
        default = {c: entity.defaults.get(c) for c in missing}
        named = named.withColumns(
            {c: F.lit(None if v is None else str(v)).cast("string") for c, v in default.items()}
        )
    return trim_text(to_types(named, entity, date_mode))


def unreadable_dates(raw: DataFrame, entity: Entity) -> DataFrame:
    """Per date column: values present, and values no format can read."""
    columns = entity.of_kind("date")
    aggregates = []
    for c in columns:
        aggregates.append(F.count(c).alias(f"{c}|present"))
        aggregates.append(
            F.count_if(F.col(c).isNotNull() & parse_date(c).isNull()).alias(f"{c}|unreadable")
        )
    pairs = ", ".join(f"'{c}', `{c}|present`, `{c}|unreadable`" for c in columns)
    return raw.agg(*aggregates).selectExpr(
        f"stack({len(columns)}, {pairs}) as (coluna, preenchidas, ilegiveis)"
    )
