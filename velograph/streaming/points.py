"""The same operators over streams: deduplication, windowed counts, and kinematics with a carried last point."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "source_entity_id string, point_id string, timestamp_utc timestamp, time_delta_sec long"
STATE = "last timestamp"


def dedup_stream(points: DataFrame, late: str = "1 hour", key: str = "point_id", ts: str = "timestamp_utc") -> DataFrame:
    """Each point once; its key is forgotten after the watermark."""
    return points.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(points: DataFrame, width: str = "1 hour", late: str = "1 hour", ts: str = "timestamp_utc", *keys: str) -> DataFrame:
    """Points by window (and keys), closed by the watermark."""
    return points.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def carried_gaps(points: DataFrame) -> DataFrame:
    """Seconds since the point before of each source, across micro-batches: the state is one timestamp a source.

    Points of one batch are put in order; a point earlier than the state gives a negative gap, as in the batch operator.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["timestamp_utc", "point_id"], kind="stable")
        last = state.get[0] if state.exists else None
        before = rows["timestamp_utc"].shift(1)
        if last is not None:
            before.iloc[0] = pd.Timestamp(last)
        state.update((rows["timestamp_utc"].iloc[-1].to_pydatetime(),))
        gap = (rows["timestamp_utc"] - before).dt.total_seconds()
        yield pd.DataFrame({"source_entity_id": rows["source_entity_id"], "point_id": rows["point_id"], "timestamp_utc": rows["timestamp_utc"], "time_delta_sec": gap.astype("Int64")})

    return points.groupBy("source_entity_id").applyInPandasWithState(run, OUT, STATE, "append", "NoTimeout")
