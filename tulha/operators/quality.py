"""Data-quality checks as rows: name, status, passed, failed, total, detail."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tulha.functions.columns import not_in
from tulha.model import FAIL_NULL_PCT, FOREIGN_KEYS, MAX_DUPLICATE_PCT, MAX_NULL_PCT
from tulha.sources.star import Star

CHECK_COLUMNS = [
    "entity", "check_name", "status", "passed_rows", "failed_rows", "total_rows", "detail",
    "pass_rate",
]


def _share(failed: Column, total: Column) -> Column:
    return F.when(total > 0, failed.cast("double") / total).otherwise(0.0)


def _detail(failed: Column, total: Column, word: str) -> Column:
    """Share with one decimal, empty when nothing failed."""
    percent = F.round((_share(failed, total) * 100).cast("decimal(38,8)"), 1)
    text = F.concat(percent.cast("decimal(5,1)").cast("string"), F.lit(f"% {word}"))
    return F.when(failed > 0, text).otherwise(F.lit(""))


def _finish(checks: DataFrame, entity: str) -> DataFrame:
    """Complete rows that have check_name, status, failed_rows, total_rows and detail."""
    passed = F.col("total_rows") - F.col("failed_rows")
    rate = F.when(F.col("total_rows") > 0, passed / F.col("total_rows")).otherwise(F.lit(0.0))
    return checks.withColumns(
        {"entity": F.lit(entity), "passed_rows": passed, "pass_rate": rate.cast("double")}
    ).select(*CHECK_COLUMNS)


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def required_columns_check(df: DataFrame, entity: str, required: tuple[str, ...]) -> DataFrame:
    """Names only: no row of ``df`` is read."""
    missing = [c for c in required if c not in df.columns]
    row = (
        "required_columns", "FAIL" if missing else "PASS", len(missing), len(required),
        f"Missing columns: {missing}" if missing else "",
    )
    schema = "check_name string, status string, failed_rows long, total_rows long, detail string"
    checks = df.sparkSession.createDataFrame([row], schema)
    if missing:
        # A missing column counts as a failure of the check, not of its rows.
        return _finish(checks, entity).withColumns(
            {"passed_rows": F.lit(0).cast("long"), "pass_rate": F.lit(0.0)}
        )
    return _finish(checks, entity)


def _profile(df: DataFrame) -> DataFrame:
    """One row: rows, repeats after the first, and nulls per column (``_nulls_<column>``).

    One scan. Rows meet by a 256-bit hash of their length-prefixed values and a bit per
    null, so no text is shuffled; copies are counted on the map side.
    """
    columns = business_columns(df)
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    bits = [F.when(t.isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(texts)]
    rows = df.select(
        F.unhex(F.sha2(F.concat(*marked), 256)).alias("_hash"),
        reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long").alias("_empty"),
    )
    copies = rows.groupBy("_hash", "_empty").agg(F.count(F.lit(1)).alias("_copies"))
    nulls = [
        F.coalesce(
            F.sum(F.when(F.getbit("_empty", F.lit(k)) == 1, F.col("_copies")).otherwise(0)),
            F.lit(0),
        ).alias(f"_nulls_{c}")
        for k, c in enumerate(columns)
    ]
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("_repeats"),
        *nulls,
    )


def run_checks(df: DataFrame, entity: str, required: tuple[str, ...] = ()) -> DataFrame:
    """The standard battery over one table: names, nulls per column, repeated rows."""
    found = [(f"null_check:{c}", f"_nulls_{c}") for c in business_columns(df)]
    found.append(("duplicate_rows", "_repeats"))
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("check_name"), F.col(f"`{c}`").alias("failed_rows"))
                for n, c in found
            ]
        )
    )
    rows = _profile(df).select("total_rows", pairs.alias("c")).select("total_rows", "c.*")
    failed, total = F.col("failed_rows"), F.col("total_rows")
    share = _share(failed, total)
    repeats = F.col("check_name") == "duplicate_rows"
    status = (
        F.when(repeats & (failed == 0), "PASS")
        .when(repeats, F.when(share <= MAX_DUPLICATE_PCT, "WARN").otherwise("FAIL"))
        .when(share <= MAX_NULL_PCT, "PASS")
        .when(share < FAIL_NULL_PCT, "WARN")
        .otherwise("FAIL")
    )
    detail = F.when(repeats, _detail(failed, total, "duplicates")).otherwise(
        _detail(failed, total, "null")
    )
    checks = _finish(rows.withColumns({"status": status, "detail": detail}), entity)
    return required_columns_check(df, entity, required).unionByName(checks)


def summary(checks: DataFrame) -> DataFrame:
    """Checks per entity and a total row; FAIL outranks WARN outranks PASS.

    ``falhas`` names the checks of an entity that fail.
    """
    status = F.col("status")
    failing = "listagg(check_name, ', ') WITHIN GROUP (ORDER BY check_name) FILTER (WHERE status = 'FAIL')"
    rows = F.max(F.when(F.col("check_name") == "duplicate_rows", F.col("total_rows")))
    counted = (
        checks.groupBy("entity")
        .agg(
            rows.alias("linhas"),
            F.count(F.lit(1)).alias("checks"),
            F.count_if(status == "PASS").alias("passed"),
            F.count_if(status == "WARN").alias("warned"),
            F.count_if(status == "FAIL").alias("failed"),
            F.expr(failing).alias("falhas"),
        )
    )
    total = counted.agg(
        F.lit("TOTAL").alias("entity"),
        F.lit(None).cast("long").alias("linhas"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("checks", "passed", "warned", "failed")],
        F.lit(None).cast("string").alias("falhas"),
    )
    overall = (
        F.when(F.col("failed") > 0, "FAIL").when(F.col("warned") > 0, "WARN").otherwise("PASS")
    )
    return counted.unionByName(total).withColumn("overall", overall)


# --- row predicates ----------------------------------------------------------
def out_of_range(c: Column, low: object = None, high: object = None) -> Column:
    """True outside [low, high]; a null is inside."""
    below = c < low if low is not None else F.lit(False)
    above = c > high if high is not None else F.lit(False)
    return F.coalesce(below | above, F.lit(False))


def out_of_domain(c: Column, allowed: list[str]) -> Column:
    """True outside the set; a null is outside."""
    return not_in(c, allowed)


def ends_before_start(start: Column, end: Column) -> Column:
    """True when both dates are present and in the wrong order."""
    return F.coalesce(end < start, F.lit(False))


def predicate_checks(df: DataFrame, entity: str, predicates: dict[str, Column]) -> DataFrame:
    """One check per predicate (true = bad row), all counted in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(bad).alias(name) for name, bad in predicates.items()],
    )
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("failed_rows"))
                for n in predicates
            ]
        )
    )
    rows = counts.select("total_rows", pairs.alias("c")).select("total_rows", "c.*")
    failed, total = F.col("failed_rows"), F.col("total_rows")
    return _finish(
        rows.withColumns(
            {
                "status": F.when(failed == 0, "PASS").otherwise("FAIL"),
                "detail": _detail(failed, total, "invalid"),
            }
        ),
        entity,
    )


def orphan_checks(
    child: DataFrame, name: str, references: list[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Child rows whose non-null key has no parent, for each (column, parent, key).

    One pass over the child for all its references. Children are counted per column and
    key first, so a hot key meets its parent as one row.
    """
    keys = [
        F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_key"))
        for c, _, _ in references
    ]
    counted = (
        child.select(F.explode(F.array(*keys)).alias("r"))
        .groupBy("r._column", "r._key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(c).alias("_column"), F.col(k).cast("string").alias("_key"))
            for c, parent, k in references
        ],
    ).withColumn("_known", F.lit(True))
    orphan = F.col("_key").isNotNull() & F.col("_known").isNull()
    found = counted.join(known, ["_column", "_key"], "left").groupBy("_column").agg(
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("failed"), F.sum("n").alias("total")
    )
    wanted = child.sparkSession.createDataFrame([(c,) for c, _, _ in references], "_column string")
    failed, total = F.col("failed_rows"), F.col("total_rows")
    return (
        wanted.join(found, "_column", "left")
        .withColumns(
            {
                "failed_rows": F.coalesce("failed", F.lit(0)),
                "total_rows": F.coalesce("total", F.lit(0)),
                "check_name": F.concat(F.lit("foreign_key:"), F.col("_column")),
            }
        )
        .withColumns(
            {
                "status": F.when(failed == 0, "PASS").otherwise("FAIL"),
                "detail": _detail(failed, total, "orphans"),
            }
        )
        .transform(_finish, name)
    )


def _by_child() -> dict[str, list[tuple[str, str, str]]]:
    out: dict[str, list[tuple[str, str, str]]] = {}
    for child, column, parent, key in FOREIGN_KEYS:
        out.setdefault(child, []).append((column, parent, key))
    return out


def all_orphan_checks(table: Callable[..., DataFrame]) -> DataFrame:
    """Every foreign key; ``table(name, *columns)`` delivers the tables."""
    return reduce(
        DataFrame.unionByName,
        [
            orphan_checks(
                table(child, *[c for c, _, _ in references]),
                child,
                [(c, table(parent, k), k) for c, parent, k in references],
            )
            for child, references in _by_child().items()
        ],
    )


def referential_checks(star: Star) -> DataFrame:
    """Every foreign key of the star."""
    return all_orphan_checks(star.table)
