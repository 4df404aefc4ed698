"""Streams as they arrive (an extension: recorded files are the contract, live ones extra).

A file source of JSON lines, windowed counts under a watermark, and actions of each episode
emitted as soon as the next record is there, with state kept per episode."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RECORD = "episode_id string, record_index long, event_time timestamp, position array<double>, gripper double, last boolean"


def read_lines(spark: SparkSession, folder: str, schema: str = RECORD, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def windowed_counts(records: DataFrame, delay: str = "10 seconds", width: str = "1 minute") -> DataFrame:
    """Records and distinct indexes per episode and window; late records beyond the delay
    are left out."""
    w = records.withWatermark("event_time", delay).groupBy(F.window("event_time", width), "episode_id")
    return w.agg(F.count("*").alias("n"), F.approx_count_distinct("record_index").alias("n_index")).select("episode_id", F.col("window.start").alias("start"), "n", "n_index")


_OUT = "episode_id string, record_index long, dx double, dy double, dz double, d_gripper double, terminal boolean"


def live_steps(records: DataFrame) -> DataFrame:
    """Translation steps: the step of record k comes when record k + 1 arrives (in order of
    index within a trigger); a record marked last gives zeros and the mark."""

    def steps(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prev = state.get if state.exists else None
        rows = []
        for b in batches:
            for r in b.sort_values("record_index").itertuples(index=False):
                p, g = list(r.position), float(r.gripper or 0.0)
                if prev is not None and r.record_index > prev[0]:
                    k, x, y, z, h = prev
                    rows.append((key[0], k, p[0] - x, p[1] - y, p[2] - z, g - h, False))
                elif prev is not None:
                    continue  # a copy or a record that came too late
                prev = (int(r.record_index), float(p[0]), float(p[1]), float(p[2]), g)
                if r.last:
                    rows.append((key[0], prev[0], 0.0, 0.0, 0.0, 0.0, True))
        if prev is not None:
            state.update(prev)
        yield pd.DataFrame(rows, columns=["episode_id", "record_index", "dx", "dy", "dz", "d_gripper", "terminal"])

    return records.groupBy("episode_id").applyInPandasWithState(steps, _OUT, "k long, x double, y double, z double, g double", "append", GroupStateTimeout.NoTimeout)
