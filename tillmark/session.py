"""Session defaults and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", app_name: str = "tillmark", **settings: str) -> SparkSession:
    """Local session for tests and the bench; a cluster job brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.driver.memory", "12g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        base = str(Path(tempfile.mkdtemp(prefix="tillmark-pkg-")).resolve() / package.name)
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
        _shipped.add(application)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the one the session names in spark.checkpoint.dir.

    Only a local master may fall back to a folder of its own, because on a cluster
    a machine-local path is lost with its executor.
    """
    application = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None) or _local_folders.get(application)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = _local_folders[application] = tempfile.mkdtemp(prefix="tillmark-")
    return f"{folder.rstrip('/')}/tillmark/{application}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the session's checkpoint folder, without its lineage.

    The folder is the one of spark.checkpoint.dir; Spark deletes the files once the frame is
    garbage, if spark.cleaner.referenceTracking.cleanCheckpoints says so.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    Later passes then scan only the columns they need, and a lost executor costs a
    re-read instead of a replay of the joins upstream.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """The same, dealt out to files by ``key``: joins and groups by it read the table without a shuffle.

    A table of as many buckets as the session has shuffle partitions, so rows that a join has dealt out by that key
    already stay in their tasks. It lies in the scratch folder; only its name is in the session's catalog.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = f"tillmark_{path.rsplit('/', 1)[-1].replace('-', '_')}"
    df.write.bucketBy(buckets(spark), key).options(path=path, compression="zstd").saveAsTable(name)
    return spark.table(name)


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: If not so, a join by receipt and client would deal out again what is dealt out by receipt.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: A plan of more fields than this is not compiled; the sums of many columns are.
MOST_FIELDS = "spark.sql.codegen.maxFields"
