"""Summaries of streams and episodes: counts, bounds, steps, offsets, sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.geometry import at, norm
from tracewright.functions.labels import non_empty, safe_path
from tracewright.functions.stamps import finite
from tracewright.functions.vectors import ACTION_LAYOUT, STATE_LAYOUT, part


def stream_summary(df: DataFrame, group: list[str], index: str, stamp: str) -> DataFrame:
    """Rows, index bounds and uniqueness, first and last stamp (by index), duration. Exact
    distinct counts go over (group, index) pairs first."""
    pairs = df.groupBy(*group, index).agg(F.count("*").alias("copies"), F.min(stamp).alias("t_min"), F.max(stamp).alias("t_max"))
    return (
        pairs.groupBy(*group)
        .agg(
            F.sum("copies").alias("n"), F.count(index).alias("n_index"), F.min(index).alias("min_index"), F.max(index).alias("max_index"),
            F.min_by("t_min", index).alias("first_stamp"), F.max_by("t_max", index).alias("last_stamp"),
        )
        .withColumn("unique", F.col("n") == F.col("n_index"))
        .withColumn("duration", F.col("last_stamp") - F.col("first_stamp"))
    )


def declared_against_actual(declared: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """(key, declared, actual, agrees): counts of the catalogue against counted rows."""
    a = actual.groupBy(*key).agg(F.count("*").alias("actual"))
    return declared.join(a, key, "left").withColumn("actual", F.coalesce("actual", F.lit(0))).withColumn("agrees", F.coalesce(F.col("declared") == F.col("actual"), F.lit(False)))


def step_stats(df: DataFrame, group: str, index: str, stamp: str) -> DataFrame:
    """Per group: least, largest and mean step between successive valid stamps, and span."""
    from tracewright.operators.actions import with_last_valid

    s = with_last_valid(df.where(finite(F.col(stamp))), group, index, [stamp], (stamp,))
    d = s.withColumn("dt", F.col(stamp) - F.col(f"last_{stamp}"))
    return d.groupBy(group).agg(
        F.count("*").alias("n"), F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"), F.avg("dt").alias("mean_dt"), (F.max(stamp) - F.min(stamp)).alias("duration")
    )


def motion_stats(frames: DataFrame, action: str = "measured_action") -> DataFrame:
    """Per episode: mean, largest and number of nonzero steps, moved and turned; padding
    frames left out, the mean of none is 0."""
    moved, turned = norm(part(F.col(action), ACTION_LAYOUT, "translation")), norm(part(F.col(action), ACTION_LAYOUT, "rotation"))
    ok = lambda c: F.when(finite(c), c)
    aggs = []
    for name, c in (("translation", moved), ("rotation", turned)):
        aggs += [F.coalesce(F.avg(ok(c)), F.lit(0.0)).alias(f"mean_{name}"), F.max(ok(c)).alias(f"max_{name}"), F.count(F.when(ok(c) > 1e-12, 1)).alias(f"nonzero_{name}")]
    return frames.where(~F.coalesce("action_is_terminal_padding", F.lit(False))).groupBy("episode_id").agg(*aggs)


def wrench_stats(frames: DataFrame, state: str = "model_state") -> DataFrame:
    """Per episode: largest |value| of each wrench axis, largest force and torque."""
    w = part(F.col(state), STATE_LAYOUT, "wrench")
    d = frames.where(F.col(state).isNotNull()).select("episode_id", w.alias("w"))
    axes = [F.max(F.abs(at(F.col("w"), i))).alias(f"max_{a}") for i, a in enumerate(("fx", "fy", "fz", "tx", "ty", "tz"))]
    return d.groupBy("episode_id").agg(*axes, F.max(norm(F.slice("w", 1, 3))).alias("max_force"), F.max(norm(F.slice("w", 4, 3))).alias("max_torque"))


def camera_rollup(cameras: DataFrame) -> DataFrame:
    """Per episode and stream: records, missing, unsafe and repeated paths, first and last."""
    p = F.col("image_path")
    per = cameras.groupBy("episode_id", "stream_name", "image_path").agg(
        F.count("*").alias("copies"), F.min("record_index").alias("lo"), F.max("record_index").alias("hi")
    )
    has = non_empty(p)
    return per.groupBy("episode_id", "stream_name").agg(
        F.sum("copies").alias("n"),
        F.coalesce(F.sum(F.when(~has, F.col("copies"))), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum(F.when(has & ~safe_path(p), F.col("copies"))), F.lit(0)).alias("n_unsafe"),
        F.coalesce(F.sum(F.when(has, F.col("copies") - 1)), F.lit(0)).alias("n_repeated"),
        F.min_by("image_path", F.when(has, F.struct("lo", "image_path"))).alias("first_path"),
        F.max_by("image_path", F.when(has, F.struct("hi", "image_path"))).alias("last_path"),
    )


def valid_counts(df: DataFrame, group: list[str], tests: dict[str, Column]) -> DataFrame:
    """Rows of each group, and how many pass each test."""
    return df.groupBy(*group).agg(F.count("*").alias("n"), *(F.count(F.when(t, 1)).alias(f"n_{k}") for k, t in tests.items()))


def first_and_last(df: DataFrame, group: list[str], value: str, order: Column) -> DataFrame:
    v = F.col(value)
    o = F.when(v.isNotNull(), order)
    return df.groupBy(*group).agg(F.count(v).alias("n"), F.min_by(v, o).alias("first_value"), F.max_by(v, o).alias("last_value"))


def distinct_list(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The sorted distinct labels of each group, joined by commas. Labels are collapsed
    before they are listed, so a list is as long as the group's vocabulary."""
    d = df.where(F.col(value).isNotNull()).select(*group, value).distinct()
    return d.groupBy(*group).agg(F.count("*").alias("n_values"), F.array_join(F.sort_array(F.collect_list(value)), ",").alias("labels"))


def summarize_array(v: Column) -> list[Column]:
    """Size, least, largest and mean of an array, values that are not finite left out."""
    ok = F.filter(v, lambda x: finite(x))
    return [
        F.size(v).alias("size"),
        F.array_min(ok).alias("least"),
        F.array_max(ok).alias("largest"),
        F.try_divide(F.aggregate(ok, F.lit(0.0), lambda a, x: a + x), F.size(ok)).alias("mean"),
    ]


def consistent(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Per group: distinct values (null counts as one) and whether there is just one."""
    d = df.select(*group, value).distinct()
    return d.groupBy(*group).agg(F.count("*").alias("n_values")).withColumn("consistent", F.col("n_values") == 1)


def backend_summary(names: Column) -> Column:
    """none, the one name, or mixed."""
    s = F.array_distinct(F.filter(names, lambda x: x.isNotNull()))
    return F.when(F.size(s) == 0, "none").when(F.size(s) == 1, F.get(s, F.lit(0))).otherwise("mixed")
