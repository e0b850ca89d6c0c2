"""Landing-zone checks: which files are there, how large, how old."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern).load(folder)


def _filled(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return _files(spark, folder, pattern).select(
        F.col("path").alias("_path"),
        F.element_at(F.split("path", "/"), -1).alias("arquivo"),
        F.col("length").alias("tamanho_bytes"),
        F.col("modificationTime").alias("modificado_em"),
    )


#: Listings write one, two or three slashes after the scheme.
SCHEME = "^([a-z0-9]+):/+"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Name, bytes and modification time of files; contents are not read.

    Scans skip empty files; these are listed with 0 bytes and no time. Files of one name in
    several folders are told apart by their paths.
    """
    names = [(unquote(path),) for path in _files(spark, folder, pattern).inputFiles()]
    plain = F.regexp_replace("_path", SCHEME, "$1:/").alias("_path")
    listed = spark.createDataFrame(names, "_path string").select(
        plain, F.element_at(F.split("_path", "/"), -1).alias("arquivo")
    )
    filled = _filled(spark, folder, pattern).select(plain, "tamanho_bytes", "modificado_em")
    return listed.join(filled, "_path", "left").drop("_path").fillna(0, "tamanho_bytes")


def missing_files(spark: SparkSession, folder: str, expected: list[str]) -> DataFrame:
    """Expected files that are absent or empty, with the reason.

    Scans skip empty files, the listing does not: the two tell empty from absent.
    Only the expected names are listed.
    """
    only_expected = "{" + ",".join(expected) + "}"
    try:
        listed = [p.rsplit("/", 1)[-1] for p in _files(spark, folder, only_expected).inputFiles()]
        filled = _filled(spark, folder, only_expected).select("arquivo")
    except AnalysisException:
        listed, filled = [], spark.createDataFrame([], "arquivo string")
    wanted = spark.createDataFrame(
        [(name, "vazio" if name in listed else "ausente") for name in expected],
        "arquivo string, motivo string",
    )
    return wanted.join(filled, "arquivo", "left_anti")
