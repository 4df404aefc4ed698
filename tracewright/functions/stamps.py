"""Stamps: a number of seconds, or an object with sec and nanosec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_FPS = 30.0


def finite(c: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def stamp_seconds(c: Column) -> Column:
    """Seconds of a stamp string; null if it states none or a value that is not finite."""
    plain = c.try_cast("double")
    sec = F.get_json_object(c, "$.sec").try_cast("double")
    nano = F.get_json_object(c, "$.nanosec").try_cast("double")
    obj = F.when((nano >= 0) & (nano < 1e9), sec + nano * F.lit(1e-9))
    t = F.coalesce(plain, F.when(F.ltrim(c).startswith("{"), obj))
    return F.when(finite(t), t)


def finite_vector(c: Column, n: int) -> Column:
    """True for an array of n finite numbers."""
    return (F.size(c) == n) & F.forall(c, lambda x: finite(x)) & c.isNotNull()


def episode_fps(metadata: DataFrame) -> DataFrame:
    """(episode_id, fps) of the episodes that state a positive finite fps other than the
    default; all others run at DEFAULT_FPS. Of several values the largest holds."""
    f = F.col("fps")
    return (
        metadata.where(finite(f) & (f > 0))
        .groupBy("episode_id")
        .agg(F.max("fps").alias("fps"))
        .where(F.col("episode_id").isNotNull())
    )
