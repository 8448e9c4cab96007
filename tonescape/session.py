"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Option lists up to this long are sent to every task; longer ones are joined by shuffle.
OPTION_ROWS = 10_000

_own_dirs: dict[str, str] = {}


def build_session(app: str = "tonescape", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; ``conf`` overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode a folder of our own if none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tonescape-")
    return _own_dirs[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: later steps read stored rows, so lost executors cost a re-read of
    the missing partitions, and values that depend on row placement cannot change.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def option_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A table of options given by the caller, broadcast when its known length allows.

    Spark has no statistics for such a table and might otherwise broadcast the data side.
    """
    table = spark.createDataFrame(list(rows), ddl)
    return F.broadcast(table) if len(rows) <= OPTION_ROWS else table
