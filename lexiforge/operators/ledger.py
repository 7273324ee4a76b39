"""The task ledger as an event log: the state of a task is a fold over its events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def state(events: DataFrame) -> DataFrame:
    """Latest state per task of events (seq, id, event, ts, ...); event: enqueue, claim, complete or fail.

    The first enqueue counts, later ones are ignored, as are events before it; complete keeps an earlier executor where it
    names none; an error is cut at 2000 characters.
    """
    by = W.partitionBy("id").orderBy("seq")
    first = F.min(F.when(F.col("event") == "enqueue", F.col("seq"))).over(W.partitionBy("id"))
    rows = events.withColumn("first", first).filter("seq >= first and (event <> 'enqueue' or seq = first)")
    rows = rows.withColumn("executor", F.last(F.when(F.col("event") == "complete", F.col("executor")), ignorenulls=True).over(by))
    of = lambda c, *kinds: F.max_by(c, F.when(F.col("event").isin(*kinds), F.col("seq")))
    last = F.max_by("event", "seq")
    status = F.when(last == "enqueue", "queued").when(last == "claim", "running").when(last == "complete", "done").otherwise("failed")
    return rows.groupBy("id").agg(
        of("stage", "enqueue").alias("stage"), of("book_id", "enqueue").alias("book_id"), of("item_key", "enqueue").alias("item_key"), F.max_by("executor", "seq").alias("executor"),
        status.alias("status"), F.count_if(F.col("event") == "claim").alias("attempts"), F.coalesce(of("max_attempts", "enqueue"), F.lit(3)).alias("max_attempts"),
        of("ts", "enqueue").alias("enqueue_ts"), of("ts", "claim").alias("start_ts"), of("ts", "complete", "fail").alias("end_ts"), of("prompt_tokens", "complete").alias("prompt_tokens"),
        of("completion_tokens", "complete").alias("completion_tokens"), of("output_path", "complete").alias("output_path"), F.left(of("error", "fail"), F.lit(2000)).alias("error"),
    )


def pending(tasks: DataFrame, stage: str, now: int, stale: int = 1800) -> DataFrame:
    """Tasks of a stage to run: queued, running for longer than `stale` seconds, or failed with attempts left; by enqueue time."""
    old = (F.col("status") == "running") & (F.col("start_ts") < now - stale)
    rows = tasks.filter(F.col("stage") == stage).withColumn("status", F.when(old, "queued").otherwise(F.col("status")))
    return rows.filter("status = 'queued' or (status = 'failed' and attempts < max_attempts)").orderBy("enqueue_ts", "id")


def done(tasks: DataFrame) -> DataFrame:
    return tasks.filter("status = 'done'").select("id")


def not_done(work: DataFrame, tasks: DataFrame, key: str = "task_id") -> DataFrame:
    """Work whose task isn't done yet: how a run resumes."""
    return work.join(done(tasks).withColumnRenamed("id", key), key, "left_anti")


def report(tasks: DataFrame) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return tasks.groupBy("stage", "status").agg(F.count("*").alias("n"), total("prompt_tokens"), total("completion_tokens")).orderBy("stage", "status")
