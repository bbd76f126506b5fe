"""Pipeline timing from run logs (text) and the slowest-pipelines report.

Log lines are read as rows (``spark.read.text`` on a cluster; here a
stand-in with the file name and line number). Each run's duration per
pipeline is the time since the previous pipeline finished (the first one:
since the workflow started) -- a range-partitioned ``lag`` over one run's lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.running_total import ranged_lag

# The engine's log line formats.
START_PATTERN = r"^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) - (\S+) - Start of workflow execution"
FINISH_PATTERN = r"^(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) - (\S+) - Execution finished on a local pipeline engine"
TS_FORMAT = "yyyy/MM/dd HH:mm:ss"


def read_log_lines(spark, path: str) -> DataFrame:
    """Log files as (arquivo, seq, linha) rows; seq is the line's position in its file."""
    lines = spark.read.text(path).select(F.input_file_name().alias("arquivo"), F.col("value").alias("linha"))
    return lines.withColumn("seq", F.monotonically_increasing_id())


def _ts(c):
    return F.to_timestamp(c, TS_FORMAT).cast("timestamp_ntz")


def step_timing(lines: DataFrame, workflow: str) -> DataFrame:
    """One row per finished pipeline: execution id, names, start, finish, seconds.

    The previous finish is a range-partitioned lag within the file, so one
    huge log does not sit in one task.
    """
    parsed = lines.select(
        "arquivo", "seq",
        F.regexp_extract("linha", START_PATTERN, 1).alias("start_ts"),
        F.regexp_extract("linha", FINISH_PATTERN, 1).alias("finish_ts"),
        F.regexp_extract("linha", FINISH_PATTERN, 2).alias("pipeline_name"))
    # the workflow start in effect is the last start line of the file
    starts = (parsed.where(F.col("start_ts") != "")
                    .groupBy("arquivo").agg(F.max_by(_ts(F.col("start_ts")), F.col("seq")).alias("workflow_started")))
    finishes = parsed.where(F.col("finish_ts") != "").select("arquivo", "seq", "pipeline_name",
                                                              _ts(F.col("finish_ts")).alias("finished_at"))
    prev = ranged_lag(finishes, ["arquivo"], "seq", "finished_at", "_prev")
    timed = (prev.join(starts, "arquivo")
                 .withColumn("started_at", F.coalesce(F.col("_prev"), F.col("workflow_started"))))
    return timed.select(
        F.col("workflow_started").alias("execution_id"), F.lit(workflow).alias("workflow_name"), "pipeline_name",
        "started_at", "finished_at",
        (F.unix_timestamp(F.col("finished_at").cast("timestamp")) - F.unix_timestamp(F.col("started_at").cast("timestamp")))
        .alias("duration_seconds"))


def slowest_of_latest(timing: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` slowest pipelines of the latest execution, with a one-line summary.

    The latest execution is a one-row aggregate read back as a scalar; its
    rows (one run's pipelines) are ranked by duration, ties by name then start.
    """
    latest = timing.agg(F.max("execution_id")).first()[0]
    run = timing.where(F.col("execution_id") == F.lit(latest))
    w = Window.partitionBy("execution_id").orderBy(F.col("duration_seconds").desc(), "pipeline_name", "started_at")
    top = run.withColumn("posicao", F.row_number().over(w)).where(F.col("posicao") <= k)
    item = F.concat(F.col("pipeline_name"), F.lit(" "), F.col("duration_seconds").cast("string"), F.lit("s"))
    summary = top.groupBy("execution_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("posicao", item.alias("t")))),
                                 lambda x: x["t"]), "; ").alias("resumo"))
    return top.join(summary, "execution_id").select("posicao", "pipeline_name", "duration_seconds", "resumo")
