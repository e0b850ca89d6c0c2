"""Session settings and the shared folder that survives lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A dimension is broadcast only when its estimated (and, under AQE, its
    # measured) size is below this limit; beyond it Spark uses a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan of this package relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, name: str = "tulha", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; unset, one below the warehouse folder.

    Both are shared by the driver and all executors.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: For files that are written to be read again soon: about half of the default's size.
COMPRESSION = "zstd"
SHORT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def stored_rows(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of ``df`` from compressed files in the shared folder, gone when the block ends.

    A checkpoint would keep them uncompressed until the driver collects garbage.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "linhas")
    try:
        df.write.option("compression", COMPRESSION).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver collects
    garbage. For blocks that return no DataFrame, since one that runs again would have to
    write its shuffles anew."""
    before = spark.conf.get(SHORT_SHUFFLES)
    spark.conf.set(SHORT_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(SHORT_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later plans read the stored rows, never recompute them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
