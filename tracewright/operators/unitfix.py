"""Quantities recorded in different units, converted to rad, rad/s, N, Nm and m.

A record's own statement goes first, then its stream entry's units, then the entry's
notes. Where a source (an episode's quantity) states nothing, its log-scale level is held
against a mixture whose components are the common scale shifted by the logarithms of the
known conversion factors; the posterior gives a unit and marks it uncertain below
``CERTAIN``. For vectors the contract says that the common unit holds without a statement,
so there the posterior only marks the source; for the gripper it decides.

Defined results: null vectors stay null and are no cases; short or not finite vectors keep
their unit; an empty table gives an empty result; unknown unit names count as unstated;
extra columns pass through unread. Repeated rows are judged one by one.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.stamps import finite
from tracewright.functions.units import (
    TABLES,
    commanded_length_unit,
    stated_factor,
    stated_length_factor,
)
from tracewright.session import broadcast_if_small

CERTAIN = 0.95
#: A jaw opens this far, in metres (fixed by the data's contract).
JAW_M = (0.006, 0.11)
BIN = 0.02


def stream_statements(streams_index: DataFrame, stream: str, kinds: tuple[str, ...]) -> DataFrame:
    """(episode_id, <kind>_entry, <kind>_notes ...) of a stream's entries; of several
    entries of an episode the smallest entry_id that states something holds."""
    s = streams_index.where((F.col("stream_name") == stream) & F.col("episode_id").isNotNull())
    aggs = []
    for k in kinds:
        for name, col in (("entry", "units"), ("notes", "notes")):
            f = stated_length_factor(F.col(col)) if k == "length" else stated_factor(F.col(col), k)
            aggs.append(F.min_by(f, F.when(f.isNotNull(), F.col("entry_id"))).alias(f"{k}_{name}"))
    stated = s.groupBy("episode_id").agg(*aggs)
    return stated.where(F.coalesce(*(F.col(f"{k}_{n}") for k in kinds for n in ("entry", "notes"))).isNotNull())


def with_factors(records: DataFrame, streams_index: DataFrame, stream: str, kinds: tuple[str, ...]) -> DataFrame:
    """Adds <kind>_factor and <kind>_stated (record, entry, notes or null) to the records."""
    small = broadcast_if_small(stream_statements(streams_index, stream, kinds), 24 + 34 * len(kinds))
    own = [f"{k}_{x}" for k in kinds for x in ("factor", "stated", "entry", "notes")]
    records = records.drop("__ep", *own)  # columns of these names would be taken for ours
    out = records.join(small.withColumnRenamed("episode_id", "__ep"), F.col("episode_id") == F.col("__ep"), "left")
    for k in kinds:
        out = out.withColumn(f"__own_{k}", stated_factor(F.col("units"), k))
        e, n = F.col(f"{k}_entry"), F.col(f"{k}_notes")
        out = out.withColumn(f"{k}_factor", F.coalesce(F.col(f"__own_{k}"), e, n, F.lit(1.0)))
        out = out.withColumn(
            f"{k}_stated",
            F.when(F.col(f"__own_{k}").isNotNull(), "record").when(e.isNotNull(), "entry").when(n.isNotNull(), "notes"),
        )
    return out.drop("__ep", *(f"__own_{k}" for k in kinds), *(f"{k}_{n}" for k in kinds for n in ("entry", "notes")))


def scale_vector(v: Column, factor: Column) -> Column:
    return F.when(factor == 1.0, v).otherwise(F.transform(v, lambda x: x * factor))


def log_level_mixture(levels: DataFrame, factors: list[float], reference: DataFrame | None = None) -> dict:
    """EM for a one-dimensional mixture over the sources' log levels: one normal for the
    common scale, and for each known factor the same normal shifted by -log(factor).
    All sources count: they come as a histogram of bins of BIN, whose number is bounded by
    the range of doubles, so only the histogram goes to the driver.

    ``levels`` has a column ``level`` (natural log of a source's size), ``reference`` the
    levels of sources whose unit is stated, already in the common unit, which set the
    first guess of the normal."""
    hist = levels.groupBy(F.floor(F.col("level") / BIN).alias("b")).count().collect()
    x = np.array([(r["b"] + 0.5) * BIN for r in hist])
    n = np.array([r["count"] for r in hist], dtype=float)
    shift = -np.log(np.array(factors))
    mu, sd = 0.0, 1.0
    if reference is not None:
        r = reference.agg(F.avg("level").alias("m"), F.stddev("level").alias("s")).first()
        mu, sd = (r["m"] if r["m"] is not None else mu), (r["s"] or sd)
    elif len(x):
        mu = float(x[np.argmin(x)] if len(x) == 1 else np.average(x, weights=n))
    w = np.full(len(factors), 1.0 / len(factors))
    if len(x):
        for _ in range(200):
            d = (x[:, None] - mu - shift) / sd
            logp = np.log(w + 1e-12) - 0.5 * d * d
            p = np.exp(logp - logp.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = p * n[:, None]
            w2 = g.sum(0) / g.sum()
            mu2 = float((g * (x[:, None] - shift)).sum() / g.sum())
            sd2 = max(0.15, math.sqrt(float((g * (x[:, None] - mu2 - shift) ** 2).sum() / g.sum())))
            done = abs(mu2 - mu) + abs(sd2 - sd) + np.abs(w2 - w).sum() < 1e-7
            w, mu, sd = w2, mu2, sd2
            if done:
                break
    return {"mu": mu, "sd": sd, "factors": factors, "weights": w.tolist()}


def with_posterior(df: DataFrame, model: dict, evidence: list[Column] | None = None) -> DataFrame:
    """Adds ``post``: the posterior of each factor for the column ``level``, with extra log
    evidence per factor."""
    logs = []
    for k, (f, w) in enumerate(zip(model["factors"], model["weights"])):
        d = (F.col("level") - F.lit(model["mu"] - math.log(f))) / F.lit(model["sd"])
        lp = F.lit(math.log(w + 1e-12)) - 0.5 * d * d
        logs.append(lp if evidence is None else lp + evidence[k])
    return (
        df.withColumn("__lp", F.array(*logs))
        .withColumn("__top", F.array_max("__lp"))
        .withColumn("__ex", F.transform("__lp", lambda x: F.exp(x - F.col("__top"))))
        .withColumn("__sum", F.aggregate("__ex", F.lit(0.0), lambda a, x: a + x))
        .withColumn("post", F.transform("__ex", lambda x: x / F.col("__sum")))
        .drop("__lp", "__top", "__ex", "__sum")
    )


def gripper_units(gripper: DataFrame, streams_index: DataFrame) -> DataFrame:
    """(episode_id, factor, stated, posterior, uncertain) of the gripper widths of every
    episode. Notes state it outright; else widths (mixture over sources, kept to what a
    jaw can open) and the units of the commands tell it."""
    factors = sorted(set(TABLES["length"].values()))
    w = F.col("gripper_width_m")
    ok = finite(w) & (w > 0)
    cmd = commanded_length_unit(F.col("gripper_command"))
    per = gripper.groupBy("episode_id").agg(
        F.avg(F.when(ok, F.log(w))).alias("level"),
        F.min(F.when(ok, w)).alias("lo"),
        F.max(F.when(ok, w)).alias("hi"),
        *(F.count(F.when(cmd == f, 1)).alias(f"c{k}") for k, f in enumerate(factors)),
    )
    from tracewright.session import stage

    per = stage(per, "gripper-levels")
    model = log_level_mixture(per.where(F.col("level").isNotNull()), factors, None if not factors else _jaw_reference(per))
    total = sum((F.col(f"c{k}") for k in range(1, len(factors))), F.col("c0"))
    evidence = []
    for k, f in enumerate(factors):
        fits = (F.col("lo") * f >= JAW_M[0] * 0.7) & (F.col("hi") * f <= JAW_M[1] * 1.3)
        evidence.append(F.log((F.col(f"c{k}") + 0.25) / (total + 1.0)) + F.when(fits, 0.0).otherwise(-20.0))
    per = with_posterior(per, model, evidence).withColumn("best", F.array_max("post"))
    best = F.col("best")
    guess = F.get(F.lit(factors), F.array_position("post", best).cast("int") - 1)
    notes = stream_statements(streams_index, "gripper_state", ("length",)).withColumnRenamed("episode_id", "__ep")
    j = per.join(broadcast_if_small(notes, 60), F.col("episode_id").eqNullSafe(F.col("__ep")), "left")
    said = F.coalesce("length_entry", "length_notes")
    return j.select(
        "episode_id",
        F.coalesce(said, guess, F.lit(1.0)).alias("factor"),
        F.when(said.isNotNull(), "notes").when(F.col("level").isNotNull(), "posterior").otherwise("common").alias("stated"),
        F.when(said.isNotNull(), 1.0).otherwise(best).alias("posterior"),
        F.coalesce(said.isNull() & (best < CERTAIN), F.lit(False)).alias("uncertain"),
    )


def _jaw_reference(per: DataFrame) -> DataFrame:
    """Levels of the sources that fit the common unit as they stand."""
    return per.where((F.col("lo") >= JAW_M[0]) & (F.col("hi") <= JAW_M[1]))


def convert_joints(joint_states: DataFrame, streams_index: DataFrame) -> DataFrame:
    """joint_states with position in rad and velocity in rad/s, and how each was known."""
    j = with_factors(joint_states, streams_index, "joint_states", ("angle", "angle_rate"))
    return j.withColumn("position", scale_vector(F.col("position"), F.col("angle_factor"))).withColumn(
        "velocity", scale_vector(F.col("velocity"), F.col("angle_rate_factor"))
    )


def scale_wrench(v: Column, force: Column, torque: Column) -> Column:
    return F.when((force == 1.0) & (torque == 1.0), v).otherwise(
        F.transform(v, lambda x, i: F.when(i < 3, x * force).otherwise(x * torque))
    )


def convert_wrenches(robot_state: DataFrame, streams_index: DataFrame, columns=("tcp_wrench", "measured_tcp_wrench")) -> DataFrame:
    """robot_state_rt with wrench columns in N and Nm."""
    r = with_factors(robot_state, streams_index, "robot_state_rt", ("force", "torque"))
    for c in columns:
        r = r.withColumn(c, scale_wrench(F.col(c), F.col("force_factor"), F.col("torque_factor")))
    return r


def convert_gripper(gripper: DataFrame, streams_index: DataFrame) -> DataFrame:
    """gripper_state with widths in m, the unit's posterior and whether it is uncertain."""
    u = gripper_units(gripper, streams_index)
    small = broadcast_if_small(u, 64).select(F.col("episode_id").alias("__ep"), "factor", "stated", "posterior", "uncertain")
    return (
        gripper.drop("__ep", "factor", "stated", "posterior", "uncertain")
        .join(small, F.col("episode_id").eqNullSafe(F.col("__ep")), "left")
        .withColumn("gripper_width_m", F.col("gripper_width_m") * F.col("factor"))
        .drop("__ep")
    )


#: Vector quantities: field, table, its vector and which of its components (from 1), kind.
VECTORS = (
    ("joint_states.position", "joint_states", "position", (1, 6), "angle"),
    ("joint_states.velocity", "joint_states", "velocity", (1, 6), "angle_rate"),
    ("robot_state_rt.tcp_wrench force", "robot_state_rt", "tcp_wrench", (1, 3), "force"),
    ("robot_state_rt.tcp_wrench torque", "robot_state_rt", "tcp_wrench", (4, 3), "torque"),
)


def source_levels(records: DataFrame, streams_index: DataFrame, stream: str) -> DataFrame:
    """(field_name, episode_id, unstated, level, n): the mean log size of each vector quantity
    of each source, in the common unit as far as one is stated. One pass over the table."""
    mine = [v for v in VECTORS if v[1] == stream]
    r = with_factors(records, streams_index, stream, tuple(v[4] for v in mine))
    rows = []
    for name, _, vector, (a, n), kind in mine:
        part = F.slice(vector, a, n)
        size = F.sqrt(F.aggregate(part, F.lit(0.0), lambda x, y: x + y * y)) * F.col(f"{kind}_factor")
        ok = (F.size(vector) == 6) & finite(size) & (size > 0)
        rows.append(F.struct(F.lit(name).alias("field_name"), F.col(f"{kind}_stated").isNull().alias("unstated"), F.when(ok, F.log(size)).alias("level")))
    e = r.select("episode_id", F.explode(F.array(*rows)).alias("x")).select("episode_id", "x.*").where("level is not null")
    return e.groupBy("field_name", "episode_id", "unstated").agg(F.avg("level").alias("level"), F.count("*").alias("n"))


def suspicion(joint_states: DataFrame, robot_state: DataFrame, streams_index: DataFrame) -> DataFrame:
    """(field_name, episode_id, n, level, posterior_common, likeliest_factor, suspect, uncertain)
    of every source of a vector quantity that states no unit: the posterior of the common unit in
    a log-scale mixture fitted to all such sources of the quantity, the likeliest factor, whether
    the scale makes the common unit doubtful, and whether no unit is certain. Reported, not
    applied: the contract says that the common unit holds where none is stated."""
    from tracewright.session import stage

    lev = stage(source_levels(joint_states, streams_index, "joint_states").unionByName(source_levels(robot_state, streams_index, "robot_state_rt")), "levels")
    out = None
    for name, _, _, _, kind in VECTORS:
        mine = lev.where(F.col("field_name") == name)
        factors = sorted(set(TABLES[kind].values()))
        model = log_level_mixture(mine.where("unstated"), factors, mine.where("not unstated"))
        best = F.array_max("post")
        part = with_posterior(mine.where("unstated"), model).select(
            "field_name", "episode_id", "n", "level", F.get("post", F.lit(factors.index(1.0))).alias("posterior_common"),
            F.get(F.lit(factors), F.array_position("post", best).cast("int") - 1).alias("likeliest_factor"), (F.get("post", F.lit(factors.index(1.0))) < 1 - CERTAIN).alias("suspect"), (best < CERTAIN).alias("uncertain"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def found(joint_states: DataFrame, robot_state: DataFrame, gripper: DataFrame, streams_index: DataFrame) -> DataFrame:
    """(field_name, row_id) of the records whose value was not in the common unit."""
    j = with_factors(joint_states.select("joint_row_id", "episode_id", "position", "velocity", "units"), streams_index, "joint_states", ("angle", "angle_rate"))
    r = with_factors(robot_state.select("state_row_id", "episode_id", "tcp_wrench", "units"), streams_index, "robot_state_rt", ("force", "torque"))
    g = convert_gripper(gripper.select("gripper_row_id", "episode_id", "gripper_width_m", "gripper_command"), streams_index)
    joint_cases = F.array(
        F.when(F.col("position").isNotNull() & (F.col("angle_factor") != 1.0), F.lit("joint_states.position")),
        F.when(F.col("velocity").isNotNull() & (F.col("angle_rate_factor") != 1.0), F.lit("joint_states.velocity")),
    )
    return (
        j.select(F.explode(joint_cases).alias("field_name"), F.col("joint_row_id").alias("row_id"))
        .where("field_name is not null")
        .unionByName(
            r.where(F.col("tcp_wrench").isNotNull() & ((F.col("force_factor") != 1.0) | (F.col("torque_factor") != 1.0))).select(
                F.lit("robot_state_rt.tcp_wrench").alias("field_name"), F.col("state_row_id").alias("row_id")
            )
        )
        .unionByName(
            g.where(F.col("gripper_width_m").isNotNull() & (F.col("factor") != 1.0)).select(
                F.lit("gripper_state.gripper_width_m").alias("field_name"), F.col("gripper_row_id").alias("row_id")
            )
        )
    )
