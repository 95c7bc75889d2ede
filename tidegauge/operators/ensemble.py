"""Fan-out of records to models, response correlation and voting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import fits_broadcast

MAX_BROADCAST_MODELS = 100_000


def fanout(data: DataFrame, models: DataFrame, key: str = "data_type", model: str = "model",
           max_broadcast: int = MAX_BROADCAST_MODELS) -> DataFrame:
    """One row per record and model registered for its key; a record whose key has no
    model keeps one row with a NULL model. A small registry (measured first) is
    broadcast; a large one is joined by shuffle, where AQE splits hot keys."""
    registry = models.select(key, model).distinct()
    if fits_broadcast(registry, max_broadcast):
        registry = F.broadcast(registry)
    return data.join(registry, key, "left")


def majority() -> Column:
    """Default decider: the mean of the votes, below one half is 0; no vote is NULL."""
    mean = F.avg(F.when(F.col("processed"), F.coalesce(F.col("result"), F.lit(0))))
    return F.when(mean < 0.5, F.lit(0)).when(mean >= 0.5, F.lit(1)).cast("int")


def vote(responses: DataFrame, request: str = "request_id", decider: Column | None = None,
         keep: list[str] | None = None, extra: list[Column] | None = None) -> DataFrame:
    """One decision per request from columns processed, result and source. `decider` is
    an aggregate expression over those; `keep` are columns fixed per request. Partial
    sums before the shuffle."""
    done = F.col("processed")
    return responses.groupBy(request, *(keep or [])).agg(
        F.coalesce(F.max(done), F.lit(False)).alias("processed"),
        F.max(F.when(done, F.col("source"))).alias("source"),
        (decider if decider is not None else majority()).alias("result"),
        F.count_if(done).alias("votes"), *(extra or []))


def vote_timeout(requests: DataFrame, responses: DataFrame, timeout_ms: Column | int, expected: int,
                 request: str = "request_id", decider: Column | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Votes from the responses that arrive within the timeout of their request; every
    request gets a row. A request is decided by its first `expected` responses when the last of
    them is there, otherwise when the timeout passes: that is its `duration`. Of responses at
    one time those with the smaller source come first. Columns:
    requests(request, req_ts), responses(request, resp_ts, processed, result, source),
    times in milliseconds."""
    limit = F.lit(timeout_ms) if isinstance(timeout_ms, int) else timeout_ms
    q = requests.select(F.col(request).alias("_rid"), "req_ts", limit.cast("bigint").alias("_limit"), *(keep or []))
    # The responses are the split side of an inner join, so AQE can divide a request
    # with very many of them; the votes are summed before they meet the requests again.
    in_time = ((F.col(request) == F.col("_rid")) & (F.col("resp_ts") >= F.col("req_ts"))
               & (F.col("resp_ts") <= F.col("req_ts") + F.col("_limit")))
    heard = (responses.select(request, "resp_ts", "processed", "result", "source")
             .join(q.select("_rid", "req_ts", "_limit"), in_time))
    # Spark limits the groups before the shuffle, so a request with very many responses sends
    # `expected` rows per task.
    first = Window.partitionBy(request).orderBy("resp_ts", "source", "processed", "result")
    heard = heard.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= expected)
    votes = vote(heard, request, decider, None, [F.count("resp_ts").alias("_got"), F.max("resp_ts").alias("_last")])
    out = q.withColumnRenamed("_rid", request).join(votes, request, "left")
    duration = F.when(F.col("_got") >= expected, F.col("_last") - F.col("req_ts")).otherwise(F.col("_limit"))
    return out.select(request, *(keep or []), F.coalesce("processed", F.lit(False)).alias("processed"), "source",
                      "result", F.coalesce("votes", F.lit(0)).cast("bigint").alias("votes"), duration.alias("duration"))


def ensemble_stats(decisions: DataFrame, key: str = "data_type", duration: str = "duration") -> DataFrame:
    """Usage of the ensemble per key; only processed decisions count."""
    d = F.col(duration)
    return decisions.where(F.col("processed")).groupBy(key).agg(
        F.count("*").alias("usage"), F.sum(d).alias("duration"), F.min(d).alias("min_duration"),
        F.max(d).alias("max_duration"))
