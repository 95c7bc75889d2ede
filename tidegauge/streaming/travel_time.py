"""Online travel-time prediction: three sums of state per cell and direction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.taxi import GROUP, ride_features
from tidegauge.streaming import reorder


class TravelTime(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n bigint, sxy double, sxx double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        b = pd.concat(list(rows))
        b = b.assign(is_end=~b["is_start"]).sort_values(["event_time", "is_end", "ride_id"])
        n0, sxy0, sxx0 = self.sums.get() if self.sums.exists() else (0, 0.0, 0.0)
        end = b["is_end"].to_numpy()
        x = np.where(end, b["dist"].to_numpy(), 0.0)
        y = np.where(end, b["minutes"].fillna(0.0).to_numpy(), 0.0)
        n, sxy, sxx = n0 + np.cumsum(end), sxy0 + np.cumsum(x * y), sxx0 + np.cumsum(x * x)
        self.sums.update((int(n[-1]), float(sxy[-1]), float(sxx[-1])))
        # At a START row the sums hold exactly the END rows before it.
        ask = ~end & (n >= 2) & (sxx > 0)
        minutes = np.trunc(sxy[ask] / sxx[ask] * b["dist"].to_numpy()[ask]).astype("int32")
        out = pd.DataFrame({"ride_id": b["ride_id"].to_numpy()[ask], "minutes": minutes})
        yield out[out["minutes"] >= 0]

    def close(self) -> None:
        pass


def predict_stream(rides: DataFrame, strict: bool = False, delay_ms: int | None = None) -> DataFrame:
    """Streaming form of operators.taxi.predict, for micro-batches that come in order, or with
    `delay_ms` for events that are out of order by so much (see reorder)."""
    features = ride_features(rides, strict).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return reorder.run(features, GROUP, TravelTime(), "ride_id bigint, minutes int",
                       None if delay_ms is None else "event_time", delay_ms or reorder.DELAY_MS)
