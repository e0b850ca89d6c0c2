"""CSV extracts: everything read as text, with lineage on each row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tulha.model import Entity
from tulha.operators.cleaning import null_tokens
from tulha.operators.rules import MALFORMED

#: Quotes are doubled inside quoted fields; a row with another number of fields than the
#: header is kept as text in the MALFORMED column; a header in another order is an error.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "mode": "PERMISSIVE", "enforceSchema": "false",
    "columnNameOfCorruptRecord": MALFORMED,
    "columnPruning": "false",  # a parser that skips fields cannot count them
}


class ExtractError(Exception):
    """The source is missing, empty or lacks required columns."""


def row_hash(columns: list[str]) -> Column:
    """Hash of the business columns, equal for equal rows in every run."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("nan")) for c in columns]))


def _header(spark: SparkSession, path: str) -> list[str]:
    try:
        return spark.read.option("header", True).option("escape", '"').csv(path).columns
    except AnalysisException as error:
        raise ExtractError(f"File not found or without header: {path}") from error


def check_required(columns: list[str], required: tuple[str, ...], path: str) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise ExtractError(f"Required columns missing in {path}: {missing}")


def read_csv(
    spark: SparkSession, path: str, required: tuple[str, ...] = (), run_id: str = "",
    multi_line: bool = False,
) -> DataFrame:
    """A file or folder of CSV files as text columns plus lineage.

    ``_ord`` is the place of the row in its source (file, block, row) and
    ``_row_id`` identifies it; both feed the keep-first rule for duplicate keys.
    ``multi_line`` reads fields with line breaks; such files are not split, so keep
    them small or many. Rows with too many or too few fields have their text in
    ``_malformed`` (null otherwise) and are rejected by ``judge``.
    """
    names = _header(spark, path)
    check_required(names, required, path)
    schema = ", ".join(f"`{n}` string" for n in [*names, MALFORMED])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line)
    raw = reader.csv(path)
    place = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = raw.select(
        "*",
        F.col("_metadata.file_name").alias("_source_file"),
        F.current_timestamp().alias("_ingestion_ts"),
        F.lit(run_id).alias("_pipeline_run_id"),
        place.alias("_ord"),
    )
    rows = null_tokens(rows, names)
    return rows.withColumns(
        {"_row_hash": row_hash(names), "_row_id": F.col("_ord.row")}
    )


def extract(spark: SparkSession, path: str, entity: Entity, run_id: str = "") -> DataFrame:
    """Read one entity; an empty source is an error, as is a missing column."""
    rows = read_csv(spark, path, entity.required, run_id)
    if rows.isEmpty():
        raise ExtractError(f"File is empty: {path}")
    return rows


def preview(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first rows as the load reads them, all text."""
    schema = ", ".join(f"`{name}` string" for name in [*_header(spark, path), MALFORMED])
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path).drop(MALFORMED).limit(n)
