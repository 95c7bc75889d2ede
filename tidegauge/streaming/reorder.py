"""Events out of order: a buffer in front of a stateful processor.

A processor that sorts the rows of its micro-batch is exact when micro-batches come in order. Here the
rows of a key wait in state, in slots of event time, until the watermark has passed their slot;
an event-time timer then hands all finished slots to the processor, which sorts them. Rows that come
at most `delay_ms` after a later one are put in their place, whatever the files, partitions or
topics they came by. Rows that come later still are given to the processor at once, or dropped by
Spark where its watermark had passed them a micro-batch before (numRowsDroppedByWatermark in the progress).

Rows without an event time go to the processor at once: in the batch forms they come first. State per key is
the rows of the last `delay_ms` and of one slot, as one Arrow block per micro-batch, and one timer. What
still waits when a slot is done is written again as one block. Processors that wait here may not set
timers of their own.
"""

from __future__ import annotations

import keyword
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

DELAY_MS = 60_000
SLOTS = 6


def to_block(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def of_block(block: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(block).read_all().to_pandas()


class InOrder(StatefulProcessor):
    """Gives the rows of a key to `inner` in the order of the column `time`, slot by slot."""

    def __init__(self, inner: StatefulProcessor, time: str, slot_ms: int):
        self.inner, self.time, self.slot_ms = inner, time, slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.inner.init(handle)
        self.waiting = handle.getListState("waiting", "block binary")
        self.timer = handle.getValueState("timer", "at bigint")

    def _ends(self, rows: pd.DataFrame) -> pd.Series:
        """When the slots of the rows end, in milliseconds."""
        return (rows[self.time].astype("datetime64[ms]").astype("int64") // self.slot_ms + 1) * self.slot_ms

    def _wake(self, at: int) -> None:
        # One timer per key, for the first slot that ends.
        if not self.timer.exists() or at < self.timer.get()[0]:
            self.timer.update((at,))
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        untimed = batch[self.time].isna()
        if untimed.any():
            yield from self.inner.handleInputRows(key, iter([batch[untimed]]), timerValues)
            batch = batch[~untimed]
        if len(batch):
            self.waiting.appendValue((to_block(batch),))
            self._wake(int(self._ends(batch).min()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        blocks = [of_block(b[0]) for b in self.waiting.get()]
        if not blocks:
            return
        rows = pd.concat(blocks, ignore_index=True)
        ends = self._ends(rows)
        ready = ends <= timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        if ready.all():
            self.waiting.clear()
        else:
            self.waiting.put([(to_block(rows[~ready]),)])
            self._wake(int(ends[~ready].min()))
        if ready.any():
            yield from self.inner.handleInputRows(key, iter([rows[ready]]), timerValues)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.inner.handleInitialState(key, initialState, timerValues)

    def close(self) -> None:
        self.inner.close()


def in_order(df: DataFrame, keys: list[str], time: str, inner: StatefulProcessor, output: StructType | str,
             delay_ms: int = DELAY_MS, initial: DataFrame | None = None) -> DataFrame:
    """`inner` over the stream `df` by `keys`, with its rows in the order of the timestamp column
    `time`. A row is out when the watermark, `delay_ms` behind the newest event, has passed its
    slot of a sixth of that. Append mode."""
    # Spark drops what is not newer than the watermark, and a row exactly `delay_ms` late is in time.
    timed = df.withWatermark(time, f"{delay_ms + 1} milliseconds")
    return timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=InOrder(inner, time, max(1, delay_ms // SLOTS)), outputStructType=output,
        outputMode="Append", timeMode="EventTime", initialState=initial.groupBy(*keys) if initial is not None else None)


def safe(name: str) -> str:
    """A column name that processors can use: the state runtime loses columns named by keywords."""
    return f"{name}_" if keyword.iskeyword(name) else name


def run(df: DataFrame, keys: list[str], inner: StatefulProcessor, output: StructType | str, time: str | None = None,
        delay_ms: int = DELAY_MS, initial: DataFrame | None = None) -> DataFrame:
    """`inner` over a stream whose micro-batches come in order, or with `time` through the buffer."""
    if time is not None:
        return in_order(df, keys, time, inner, output, delay_ms, initial)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=inner, outputStructType=output, outputMode="Append", timeMode="None",
        initialState=initial.groupBy(*keys) if initial is not None else None)
