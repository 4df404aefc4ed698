"""Deterministic episodes for trials, made by spark.range and expressions alone."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _frames(spark: SparkSession, n: int, fps: float) -> DataFrame:
    if n < 2 or fps <= 0:
        raise ValueError("an episode needs two frames at least and a positive fps")
    return spark.range(n).select(F.col("id").alias("i"), (F.col("id") / F.lit(float(n - 1))).alias("f"), (F.col("id") / F.lit(float(fps))).alias("t"))


def plain_poses(spark: SparkSession, n: int = 20, fps: float = 30.0) -> DataFrame:
    """(episode_id, frame_index, timestamp, position, quaternion, gripper)."""
    f = F.col("f")
    a = 0.08 * f
    return _frames(spark, n, fps).select(
        F.lit("episode_000000").alias("episode_id"), F.col("i").alias("frame_index"), F.col("t").alias("timestamp"),
        F.array(0.45 + 0.03 * f, 0.01 * F.sin(math.pi * f), 0.22 - 0.04 * f).alias("position"),
        F.array(F.lit(0.0), F.lit(0.0), F.sin(a / 2), F.cos(a / 2)).alias("quaternion"), F.lit(0.0).alias("gripper"),
    )


def plain_wrench(spark: SparkSession, n: int = 20, fps: float = 30.0) -> DataFrame:
    f = F.col("f")
    c = F.greatest(F.lit(0.0), (f - 0.7) / 0.3)
    zero = F.lit(0.0)
    return _frames(spark, n, fps).select(F.col("i").alias("frame_index"), F.col("t").alias("timestamp"), F.array(0.2 * F.sin(2 * math.pi * f), zero, 12.0 * c, zero, 0.03 * c, zero).alias("wrench"))


def _stream(spark: SparkSession, n: int, fps: float, episode_id: str) -> DataFrame:
    return _frames(spark, n, fps).select(
        F.lit(episode_id).alias("episode_id"), F.col("i").alias("record_index"), F.col("t").alias("source_stamp"),
        (F.col("t") + 0.001).alias("receipt_stamp"), (F.col("t") + 10.0).alias("monotonic_stamp"), "f",
    )


def joint_stream(spark: SparkSession, n: int = 20, fps: float = 30.0, episode_id: str = "synthetic_0") -> DataFrame:
    s = _stream(spark, n, fps, episode_id)
    pos = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda j: 5.0 * j + 2.0 * F.col("f"))
    vel = F.array_repeat(F.lit(2.0 / ((n - 1) / fps)), 6)
    names = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda j: F.concat(F.lit("joint_"), j.cast("string")))
    return s.select("*", names.alias("joint_names"), pos.alias("position"), vel.alias("velocity"), F.lit('{"joint_position": "deg", "joint_velocity": "deg/s"}').alias("units")).drop("f")


def robot_stream(spark: SparkSession, n: int = 20, fps: float = 30.0, episode_id: str = "synthetic_0") -> DataFrame:
    s = _stream(spark, n, fps, episode_id)
    f = F.col("f")
    c = F.greatest(F.lit(0.0), (f - 0.65) / 0.35)
    zero = F.lit(0.0)
    tcp = F.array(450 + 12 * f, 2 + 3 * f, 225 - 18 * f, zero, F.lit(180.0), 4 * f)
    wrench = F.array(0.1 * F.sin(math.pi * f), 0.05 * f, 1 + 8 * c, zero, 0.02 * c, zero)
    return s.select("*", tcp.alias("actual_tcp_position"), wrench.alias("tcp_wrench"), F.lit('{"tcp_position": "mm", "tcp_orientation": "deg", "force": "N", "torque": "Nm"}').alias("units")).drop("f")


def event_log(spark: SparkSession, n: int = 20, fps: float = 30.0) -> DataFrame:
    rows = [(0.0, "episode_start"), (int(0.7 * (n - 1)) / fps, "contact_begin"), (int(0.9 * (n - 1)) / fps, "success"), ((n - 1) / fps, "episode_stop")]
    return spark.createDataFrame(rows, "timestamp double, event string")
