"""Measured actions, action chunks, relative time: what looks along an episode.

A window over an episode sorts it in one task. Where an episode may be as long as a third
of all rows, ``stretches`` cuts it at index multiples and hands every stretch the records
that follow it (a halo of as many rows as the look-ahead), so any episode spreads. What
was last known is carried over the stretches by a small table (``with_last_valid``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.geometry import at, conjugate, minus, multiply, quaternion_of, relative_rotvec, rotvec_of, unit_quaternion, vec
from tracewright.functions.vectors import ACTION_DIM

STRETCH = 8192


#: The stretch of the rows without an index: they come last, as in SQL.
NO_INDEX = 2**63 - 1


def stretch_of(index: str, length: int) -> Column:
    return F.coalesce(F.floor(F.col(index) / length), F.lit(NO_INDEX))


def stretches(df: DataFrame, group: str, index: str, ahead: int, behind: int = 0, length: int = STRETCH) -> DataFrame:
    """Adds ``stretch`` and ``own``: every row in its own stretch, and at the end of each
    stretch the ``ahead`` rows of the group that follow it, wherever they stand: gaps of any
    width and short or empty stretches change nothing. For what lies behind there is
    ``with_last_valid``; ``behind`` must be 0."""
    if behind:
        raise ValueError("stretches look ahead only; use with_last_valid for what lies behind")
    own = df.withColumn("stretch", stretch_of(index, length)).withColumn("own", F.lit(True))
    return own.unionByName(_following(df, group, index, ahead, length)) if ahead else own


def with_last_valid(df: DataFrame, group: str, index: str, values: list[str], order: tuple[str, ...] = (), length: int = STRETCH) -> DataFrame:
    """Adds ``last_{value}`` for each of ``values``: the last one before the row, by index
    and then ``order`` (nulls last), that is not null. What a stretch ends with is carried
    over its boundary by a table with one row a stretch, over any number of nulls."""
    by = [e for c in (index, *order) for e in (F.col(c).isNull(), F.col(c))]
    s = df.withColumn("stretch", stretch_of(index, length))
    ends = s.groupBy(group, "stretch").agg(*(F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*by))).alias(v) for v in values))
    past = Window.partitionBy(group).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(group, "stretch", *(F.last(v, True).over(past).alias(v) for v in values), F.lit(False).alias("own"))
    w = Window.partitionBy(group, "stretch").orderBy("own", *(F.col(c).asc_nulls_last() for c in (index, *order))).rowsBetween(Window.unboundedPreceding, -1)
    both = s.withColumn("own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    return both.select("*", *(F.last(v, True).over(w).alias(f"last_{v}") for v in values)).where("own").drop("stretch", "own")


def _following(df: DataFrame, group: str, index: str, ahead: int, length: int) -> DataFrame:
    """The first ``ahead`` rows after each stretch, in that ``stretch`` and not its ``own``.
    They are among the first rows of the stretches; which go where tells a table with one
    row a stretch: a row goes back over stretches while fewer than ``ahead`` rows are passed."""
    w = Window.partitionBy(group, "stretch").orderBy(index)
    heads = df.withColumn("stretch", stretch_of(index, length)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= ahead)
    g = Window.partitionBy(group).orderBy("stretch")
    sizes = heads.groupBy(group, "stretch").agg(F.max("rank").alias("size")).withColumn("upto", F.sum("size").over(g))
    past = F.col("upto") - F.col("size")
    before = F.collect_list(F.struct("stretch", "upto")).over(g.rowsBetween(-ahead, -1))
    back = sizes.select(F.col(group).alias("__group"), F.col("stretch").alias("__stretch"), past.alias("past"), before.alias("before"))
    back = back.withColumn("before", F.filter("before", lambda b: F.col("past") - b["upto"] < ahead))
    to = F.filter("before", lambda b: F.col("past") + F.col("rank") - b["upto"] <= ahead)
    j = heads.join(back, F.col(group).eqNullSafe(F.col("__group")) & (F.col("stretch") == F.col("__stretch")))
    return j.withColumn("stretch", F.explode(F.transform(to, lambda b: b["stretch"]))).select(*df.columns, "stretch", F.lit(False).alias("own"))


def delta_action(p0: Column, q0: Column, g0: Column, p1: Column, q1: Column, g1: Column) -> Column:
    """Seven numbers: translation in the base frame, rotation in the frame of the first
    pose, change of the gripper (0 if either is null)."""
    d, r = minus(p1, p0), relative_rotvec(q0, q1)
    return vec(at(d, 0), at(d, 1), at(d, 2), at(r, 0), at(r, 1), at(r, 2), F.coalesce(g1 - g0, F.lit(0.0)))


def measured_actions(poses: DataFrame, group: str, index: str) -> DataFrame:
    """poses (group, index, position in m, rotation vector in rad, gripper) with ``action``
    to the next record and ``terminal``: the last record has zeros and the mark."""
    p = stretches(poses.withColumn("q0", quaternion_of(F.col("rotation"))).withColumn("q", unit_quaternion(F.col("q0"))).drop("q0"), group, index, 1)
    w = Window.partitionBy(group, "stretch").orderBy(F.col(index).asc_nulls_last())
    nxt = {c: F.lead(c).over(w) for c in (index, "position", "q", "gripper")}
    out = p
    for c, e in nxt.items():
        out = out.withColumn(f"n_{c}", e)
    # step by step, so that no expression is written out many times in another
    out = out.withColumn("rel", multiply(conjugate(F.col("q")), F.col("n_q"))).withColumn("rot", rotvec_of(F.col("rel"))).withColumn("move", minus(F.col("n_position"), F.col("position")))
    act = F.concat("move", "rot", F.array(F.coalesce(F.col("n_gripper") - F.col("gripper"), F.lit(0.0))))
    last = F.col(f"n_{index}").isNull()
    zeros = F.array_repeat(F.lit(0.0), ACTION_DIM)
    return out.where("own").withColumn("action", F.when(last, zeros).otherwise(act)).withColumn("terminal", last).drop("stretch", "own", "q", "rel", "rot", "move", *(f"n_{c}" for c in nxt))


def action_chunks(actions: DataFrame, group: str, index: str, horizon: int, pad: str = "repeat_last") -> DataFrame:
    """Adds ``chunk`` (horizon actions from each record on), ``valid`` (how many are real)
    and ``padded``. Beyond the end the last action is repeated, or zeros are put."""
    if horizon < 1:
        raise ValueError("horizon must be positive")
    if pad not in ("repeat_last", "zero"):
        raise ValueError("pad must be repeat_last or zero")
    a = stretches(actions, group, index, horizon - 1)
    w = Window.partitionBy(group, "stretch").orderBy(F.col(index).asc_nulls_last()).rowsBetween(0, horizon - 1)
    real = F.collect_list("action").over(w)
    out = a.withColumn("real", real).where("own")
    filler = F.element_at("real", -1) if pad == "repeat_last" else F.transform(F.element_at("real", -1), lambda x: F.lit(0.0))
    return (
        out.withColumn("valid", F.size("real"))
        .withColumn("padded", F.lit(horizon) - F.col("valid"))
        .withColumn("chunk", F.concat("real", F.array_repeat(filler, F.col("padded"))))
        .drop("real", "stretch", "own")
    )


def debug_chunk(action: Column, horizon: int, mode: str) -> Column:
    """A chunk for trials: the action alone, or repeated."""
    if mode == "single":
        return F.array(action)
    if mode == "repeat":
        return F.array_repeat(action, horizon)
    raise ValueError("mode must be single or repeat; use action_chunks for the future")


def valid_mask(valid: Column, horizon: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: i < valid)


def relative_time(df: DataFrame, group: str, index: str, stamp: str, fallback: str | None = None) -> DataFrame:
    """Adds ``rel``: seconds since the group's first stamp, on ``stamp`` if that strictly
    increases throughout, else on ``fallback`` if that does, else null; and ``increasing``.
    The verdicts are sums over stretches, so groups need not fit into a task."""
    cols = [stamp] + ([fallback] if fallback else [])
    s = with_last_valid(df, group, index, cols)
    for c in cols:
        s = s.withColumn(f"bad_{c}", F.col(c).isNull() | F.coalesce(F.col(c) <= F.col(f"last_{c}"), F.lit(False)))
    g = s.groupBy(group).agg(
        *(F.min_by(c, index).alias(f"t0_{c}") for c in cols), *((~F.bool_or(f"bad_{c}")).alias(f"ok_{c}") for c in cols)
    )
    j = df.join(g, group)
    rel = F.when(F.col(f"ok_{stamp}"), F.col(stamp) - F.col(f"t0_{stamp}"))
    if fallback:
        rel = rel.when(F.col(f"ok_{fallback}"), F.col(fallback) - F.col(f"t0_{fallback}"))
    return j.withColumn("rel", rel).withColumn("increasing", F.col(f"ok_{stamp}")).drop(*(f"{p}_{c}" for p in ("t0", "ok") for c in cols))


def falls_below_last_valid(df: DataFrame, group: str, index: str, stamp: str) -> DataFrame:
    """Adds ``falls``: the value is lower than the last valid one before it (values that
    are null or not numbers are passed over, however many)."""
    v = F.when(F.col(stamp).isNotNull() & ~F.isnan(stamp), F.col(stamp))
    s = with_last_valid(df.withColumn("v", v), group, index, ["v"])
    return s.withColumn("falls", F.coalesce(F.col("v") < F.col("last_v"), F.lit(False))).drop("v", "last_v")
