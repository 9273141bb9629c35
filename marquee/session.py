"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_MARKED: set[str] = set()


def build_session(master: str | None = None, partitions: int | None = None, app: str = "marquee", scratch: str | None = None) -> SparkSession:
    """Session with the settings the operators expect; cluster sizing stays with spark-submit.

    ``scratch`` sets ``spark.checkpoint.dir``, which should name a folder that all executors share.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, else a folder in the warehouse.

    It is this application's own and goes when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    root = f"{base.rstrip('/')}/marquee-{spark.sparkContext.applicationId}"
    if root.startswith("file:/") and not root.startswith("file://"):
        root = f"file://{root.removeprefix('file:')}"
    if root not in _MARKED:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MARKED.add(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and fixes the row placement, and outlives any executor. ``compression`` is the session's if not given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
