"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "oreline", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow on; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str | None] = {}       # temporary folders of local-mode applications


def _conf(spark: SparkSession, key: str) -> str | None:
    return spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may run without it; it then gets a temporary folder.
    """
    base = _conf(spark, "spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _LOCAL.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="oreline-")
        _LOCAL[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/oreline-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of iterative jobs, survives the loss of executors, and gives the
    optimizer true sizes, so later joins broadcast only what is known to be small.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once nothing will read them again; others are left alone."""
    for df in tables:
        if hasattr(df, "_stored_at"):
            _delete(df.sparkSession, df._stored_at)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote; call when results are stored."""
    _delete(spark, scratch_dir(spark))


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session plans with."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
