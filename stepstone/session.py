"""Session helpers: a local builder for tests and the shared scratch folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

_own_scratch: dict[str, str] = {}


def local_session(cpus: str | int = "*", app: str = "stepstone") -> SparkSession:
    """Single-JVM session used by the tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for local masters that set none."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    if context.applicationId not in _own_scratch:
        _own_scratch[context.applicationId] = tempfile.mkdtemp(prefix="stepstone-")
    return _own_scratch[context.applicationId]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute when executors are lost, and its file size gives the
    optimizer a true estimate, so a join broadcasts it only while it is really small.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, tag: str = "cut", where: Column | None = None) -> tuple[DataFrame, int]:
    """Like :func:`cut`, with the row count (of the rows matching ``where``) observed by the same job."""
    seen = Observation()
    metric = F.count(F.lit(1)) if where is None else F.count_if(where)
    return cut(df.observe(seen, metric.alias("n")), tag), seen.get["n"]
