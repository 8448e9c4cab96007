"""Result and raw tables: append with a count, scans, and the log of finished runs.

A run's rows of a table are one folder, which the run replaces as a whole. A run that was
broken off and is started again under its id leaves each of its rows once. Its last step
adds a row to the log, with the times between which its results lie, so that a range of days
is read from the runs that have rows in it, and the bounds of all results from the log alone.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tonescape import schemas
from tonescape.operators.panels import SUMS, panel_sums

RAW_POSTS = "raw_reddit_posts"
RAW_TWEETS = "raw_twitter_posts"
RAW_HEADLINES = "raw_news_articles"
SENTIMENT = "sentiment_analysis"
TOPICS = "topics"
#: Results of each run summed up for the panels.
PANELS = "panel_sums"

#: Finished runs: times of their first and last result, and how many there are.
RUN_LOG = "run_log"
_RUN_LOG = "first_time timestamp_ntz, last_time timestamp_ntz, n bigint, run_id string"

#: Columns and partition columns of every table.
LAYOUT: dict[str, tuple[str, list[str]]] = {
    RAW_POSTS: (f"{schemas.POSTS}, run_id string", ["run_id"]),
    RAW_TWEETS: (f"{schemas.TWEETS}, run_id string", ["run_id"]),
    RAW_HEADLINES: (f"{schemas.HEADLINES}, run_id string", ["run_id", "source"]),
    SENTIMENT: (schemas.SENTIMENT_ANALYSIS, ["run_id", "source"]),
    TOPICS: (schemas.TOPICS, ["run_id"]),
    PANELS: (SUMS, ["run_id"]),
}


#: Where a headline stood; null for feeds that do not say.
PLACE = ("page_id", "position")


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append") -> int:
    """Append (or overwrite) and return the number of rows, counted while they are written."""
    seen = Observation(f"append-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return int(seen.get["rows"])


def _run_folder(root: str, table: str, run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"a run id has letters, digits and _.- only: {run_id!r}")
    return f"{root}/{table}/run_id={run_id}"


def append_table(df: DataFrame, root: str, table: str, run_id: str) -> int:
    """Add a run's rows to a table and return their number; what the run had there goes."""
    ddl, partition_by = LAYOUT[table]
    kinds = dict(part.split() for part in ddl.split(", "))
    missing = {c: F.lit(None).cast(kinds[c]) for c in PLACE if c in kinds and c not in df.columns}
    df = df.withColumns(missing).select(*[c for c in kinds if c != "run_id"])
    inner = [c for c in partition_by if c != "run_id"]
    return append_rows(df, _run_folder(root, table, run_id), inner, "overwrite")


def append_if_any(df: DataFrame, root: str, table: str, run_id: str) -> int:
    """``append_table`` only where there are rows; without any, nothing is written."""
    return 0 if df.isEmpty() else append_table(df, root, table, run_id)


def finish_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Sum up a run's results for the panels, then log it; its last table must be written.

    The results are read once, without texts; the log is made from the sums.
    """
    append_table(panel_sums(read_table(spark, root, SENTIMENT, run_id)), root, PANELS, run_id)
    times = read_table(spark, root, PANELS, run_id).agg(
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )
    append_rows(times.coalesce(1), _run_folder(root, RUN_LOG, run_id), mode="overwrite")


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished run."""
    return spark.read.schema(_RUN_LOG).parquet(f"{root}/{RUN_LOG}")


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    """Sums of all finished runs, for the panels."""
    return read_table(spark, root, PANELS).join(run_log(spark, root).select("run_id"), "run_id", "left_semi")


def read_days(spark: SparkSession, root: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Results of finished runs from the start of one day to the end of another.

    Only folders of runs that have rows in the range are read; their list, one id a run, is
    part of the plan.
    """
    first, after = (F.lit(str(day)).cast("date").cast("timestamp_ntz") for day in (start, end))
    after = after + F.expr("interval '1' day")
    log = run_log(spark, root).filter((F.col("last_time") >= first) & (F.col("first_time") < after))
    runs = sorted(row.run_id for row in log.select("run_id").collect())
    found = read_table(spark, root, SENTIMENT).filter(F.col("run_id").isin(runs))
    return found.filter((F.col("processed_at") >= first) & (F.col("processed_at") < after))


def default_days(spark: SparkSession, root: str) -> tuple[dt.date, dt.date] | None:
    """The last day with results and the seven before it, but none before the first; None
    without results. Only the log is read."""
    bounds = run_log(spark, root).agg(F.to_date(F.min("first_time")), F.to_date(F.max("last_time"))).first()
    if bounds[0] is None:
        return None
    return max(bounds[0], bounds[1] - dt.timedelta(days=7)), bounds[1]


def read_last_week(spark: SparkSession, root: str) -> DataFrame:
    """Results of the default range of days."""
    days = default_days(spark, root)
    if days is None:
        return schemas.empty(spark, LAYOUT[SENTIMENT][0])
    return read_days(spark, root, *days)


def read_table(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """Scan a table, or one run of it: other runs' folders are not read."""
    ddl, _ = LAYOUT[table]
    df = spark.read.schema(ddl).parquet(f"{root}/{table}").select(*schemas.columns(ddl))
    return df if run_id is None else df.filter(F.col("run_id") == run_id)


def latest_run(topics: DataFrame) -> DataFrame:
    """Topic rows of the newest run: topic ids mean nothing across runs."""
    newest = topics.agg(F.max_by("run_id", F.struct("created_at", "run_id"))).scalar()
    return topics.filter(F.col("run_id") == newest)
