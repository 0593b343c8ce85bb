"""Session settings used by the bench and the tests; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str, cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # plans here are built from many small expressions; do not record a call site for each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder the cluster names; ``fallback`` only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; pass a shared folder")
    return root
