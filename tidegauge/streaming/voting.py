"""Correlating ensemble responses by request, with a timeout."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.ensemble import vote
from tidegauge.streaming import reorder

OUTPUT = "request_id bigint, processed boolean, source int, result int, votes bigint, duration bigint"
SHARES = 64


def decide(responses: list[tuple]) -> dict:
    """Majority of the processed (resp_ts, processed, result, source) responses of a request."""
    done = [r for r in responses if r[1]]
    if not done:
        return {"processed": False, "source": None, "result": None, "votes": 0}
    mean = sum(r[2] or 0 for r in done) / len(done)
    return {"processed": True, "source": max(r[3] for r in done), "result": 0 if mean < 0.5 else 1, "votes": len(done)}


def decide_many(responses: pd.DataFrame) -> pd.DataFrame:
    """`decide` for many requests at once, by request_id; requests without a processed response have no
    row."""
    done = responses[responses["processed"].to_numpy(dtype=bool)]
    votes = done.assign(result=done["result"].fillna(0)).groupby("request_id").agg(
        votes=("result", "size"), mean=("result", "mean"), source=("source", "max"))
    return pd.DataFrame({"processed": True, "source": votes["source"], "result": (votes["mean"] >= 0.5).astype(int),
                         "votes": votes["votes"]}, index=votes.index)


def _decide_each(responses: pd.DataFrame, requests: pd.Index, decider) -> pd.DataFrame:
    columns = ["resp_ts", "processed", "result", "source"]
    found = {request: decider([]) for request in requests.difference(responses["request_id"])}
    for request, own in responses.groupby("request_id"):
        rows = own[columns].astype(object).where(own[columns].notna(), None)
        found[request] = decider([(int(t), bool(p), None if v is None else int(v), None if s is None else int(s))
                                  for t, p, v, s in rows.itertuples(index=False)])
    return pd.DataFrame(list(found.values()), index=pd.Index(list(found), name="request_id"),
                        columns=["processed", "source", "result", "votes"])


class Correlate(StatefulProcessor):
    """Open requests and their responses, for many requests at once: a key is a share of the requests.
    State is one block of the rows that are not decided yet; there is one timer, for the first
    request that ends. Responses of unknown or decided requests stay until the watermark passes them."""

    def __init__(self, expected: int, decider=None):
        self.expected, self.decider = expected, decider

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "block binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._step(pd.concat([*self._held(), *rows], ignore_index=True), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        if held:
            yield from self._step(held[0], timerValues)

    def _held(self) -> list[pd.DataFrame]:
        return [reorder.of_block(self.open.get()[0])] if self.open.exists() else []

    def _step(self, rows: pd.DataFrame, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        asked = rows["is_request"].to_numpy(dtype=bool)
        # Of a request that is sent again the last one counts.
        requests = rows.loc[asked, ["request_id", "req_ts", "timeout"]].drop_duplicates("request_id", keep="last").set_index(
            "request_id").astype("int64")
        known = rows[~asked].join(requests, on="request_id", rsuffix="_of")
        since = known["resp_ts"] - known["req_ts_of"]
        valid = known[(since >= 0) & (since <= known["timeout_of"])].sort_values("resp_ts", kind="stable")
        place = valid.groupby("request_id").cumcount()
        got = valid.groupby("request_id").size().reindex(requests.index, fill_value=0)
        full = got >= self.expected
        over = requests["req_ts"] + requests["timeout"] < passed
        out = requests.index[full | over]
        if len(out):
            yield self._results(requests.loc[out], full.loc[out], valid[(place < self.expected) & valid["request_id"].isin(out)])
        left = rows[~rows["request_id"].isin(out)]
        unknown = ~left["is_request"].to_numpy(dtype=bool) & ~left["request_id"].isin(requests.index).to_numpy()
        left = left[~(unknown & (left["resp_ts"] < passed).to_numpy())]
        self._keep(left)

    def _results(self, requests: pd.DataFrame, full: pd.Series, valid: pd.DataFrame) -> pd.DataFrame:
        last = valid.groupby("request_id")["resp_ts"].max().reindex(requests.index)
        # Results of requests without any response too.
        decided = decide_many(valid) if self.decider is None else _decide_each(valid, requests.index, self.decider)
        decided = decided.reindex(requests.index)
        duration = (last - requests["req_ts"]).where(full, requests["timeout"]).astype("int64")
        return pd.DataFrame({
            "request_id": requests.index, "processed": decided["processed"].astype("boolean").fillna(False).astype(bool).to_numpy(),
            "source": decided["source"].astype("Int32").array, "result": decided["result"].astype("Int32").array,
            "votes": decided["votes"].fillna(0).astype("int64").to_numpy(), "duration": duration.to_numpy()})

    def _keep(self, left: pd.DataFrame) -> None:
        if not len(left):
            self.open.clear()
            return
        self.open.update((reorder.to_block(left),))
        ends = (left["req_ts"] + left["timeout"]).fillna(left["resp_ts"])
        self.handle.registerTimer(int(ends.min()) + 1)

    def close(self) -> None:
        pass


def _at_most(timeout: Column, bound: int) -> Column:
    fits = timeout <= F.lit(bound)
    return F.when(fits | timeout.isNull(), timeout).otherwise(
        F.raise_error(F.lit(f"a request has a timeout over {bound} ms")).cast("bigint"))


def vote_stream(requests: DataFrame, responses: DataFrame, expected: int, timeout_ms: int = 100,
                delay: str = "1 second", max_timeout_ms: int | None = None, decider: Column | None = None) -> DataFrame:
    """Streaming form of operators.ensemble.vote_timeout on event time: an interval join
    of the two streams, then one aggregate per request, both in the JVM. A decision is
    out when the watermark has passed its timeout. Requests carry req_ts; where they carry their
    own `timeout`, `max_timeout_ms` says how long the join keeps responses, and a request with
    a longer timeout stops the stream. Times are milliseconds. All responses in time vote, so
    send a request at most `expected` of them."""
    if "timeout" in requests.columns and max_timeout_ms is None:
        raise ValueError("requests with their own timeout need max_timeout_ms")
    bound = max_timeout_ms or timeout_ms
    own = F.col("timeout") if "timeout" in requests.columns else F.lit(timeout_ms)
    q = requests.select("request_id", "req_ts", _at_most(own, bound).cast("bigint").alias("_limit"),
                        F.timestamp_millis("req_ts").alias("req_time")).withWatermark("req_time", delay)
    r = responses.select(F.col("request_id").alias("_rid"), "resp_ts", "processed", "result", "source",
                         F.timestamp_millis("resp_ts").alias("resp_time")).withWatermark("resp_time", delay)
    in_time = ((F.col("request_id") == F.col("_rid")) & (F.col("resp_time") >= F.col("req_time"))
               & (F.col("resp_time") <= F.col("req_time") + F.expr(f"INTERVAL {bound} MILLISECONDS"))
               & (F.col("resp_ts") <= F.col("req_ts") + F.col("_limit")))
    out = vote(q.join(r, in_time, "leftOuter"), "request_id", decider, ["req_time", "req_ts", "_limit"],
               [F.count("resp_ts").alias("_got"), F.max("resp_ts").alias("_last")])
    duration = F.when(F.col("_got") >= expected, F.col("_last") - F.col("req_ts")).otherwise(F.col("_limit"))
    return out.select("request_id", "processed", "source", "result", "votes", duration.alias("duration"))


def vote_stream_early(requests: DataFrame, responses: DataFrame, expected: int, timeout_ms: int = 100,
                delay: str = "1 second", decider=decide, shares: int = SHARES) -> DataFrame:
    """As `vote_stream`, but a decision is out as soon as the expected number of responses is there; the
    first `expected` decide. The open requests are dealt to `shares` by their id, and a micro-batch
    works on a share in arrays, so its cost does not go by request. A share holds the requests that
    are open at a time: raise `shares` with their number."""
    own = F.col("timeout") if "timeout" in requests.columns else F.lit(timeout_ms)
    q = requests.select("request_id", F.lit(True).alias("is_request"), "req_ts", own.cast("bigint").alias("timeout"),
                        F.timestamp_millis("req_ts").alias("event_time"))
    r = responses.select("request_id", F.lit(False).alias("is_request"), "resp_ts", "processed", "result", "source",
                         F.timestamp_millis("resp_ts").alias("event_time"))
    both = q.unionByName(r, allowMissingColumns=True).withWatermark("event_time", delay)
    return both.withColumn("share", F.pmod(F.xxhash64("request_id"), F.lit(shares))).groupBy("share").transformWithStateInPandas(
        statefulProcessor=Correlate(expected, None if decider is decide else decider), outputStructType=OUTPUT,
        outputMode="Append", timeMode="EventTime")
