import pytest
from pyspark.sql import functions as F

from tracewright.operators import actions as A
from tracewright.operators import rollups
from tracewright.plans import core


def rows(spark, n, group="e"):
    return spark.range(n).select(F.lit(group).alias("g"), F.col("id").alias("i"), F.array_repeat(F.col("id").cast("double"), 7).alias("action"))


@pytest.mark.parametrize(
    "n, start, horizon, pad, want, valid",
    [
        (5, 1, 3, "repeat_last", [1, 2, 3], 3),
        (4, 2, 5, "repeat_last", [2, 3, 3, 3, 3], 2),
        (3, 2, 4, "zero", [2, 0, 0, 0], 1),
        (19, 0, 50, "repeat_last", list(range(19)) + [18] * 31, 19),
    ],
)
def test_chunks(spark, n, start, horizon, pad, want, valid):
    r = A.action_chunks(rows(spark, n), "g", "i", horizon, pad).where(F.col("i") == start).first()
    assert [c[0] for c in r["chunk"]] == want
    assert (r["valid"], r["padded"]) == (valid, horizon - valid)


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        A.action_chunks(rows(spark, 2), "g", "i", 0)
    with pytest.raises(ValueError):
        A.action_chunks(rows(spark, 2), "g", "i", 2, "mirror")


def test_stretches_change_nothing(spark, monkeypatch):
    whole = {r["i"]: [c[0] for c in r["chunk"]] for r in A.action_chunks(rows(spark, 50), "g", "i", 6).collect()}
    monkeypatch.setattr(A.stretches, "__defaults__", (0, 8))
    assert {r["i"]: [c[0] for c in r["chunk"]] for r in A.action_chunks(rows(spark, 50), "g", "i", 6).collect()} == whole


def test_terminal_record(spark):
    p = rows(spark, 3).select(
        "g", "i", F.array(F.col("i") * 0.1, F.lit(0.0), F.lit(0.0)).alias("position"), F.array_repeat(F.lit(0.0), 3).alias("rotation"), F.lit(None).cast("double").alias("gripper")
    )
    out = A.measured_actions(p, "g", "i").orderBy("i").collect()
    assert [r["terminal"] for r in out] == [False, False, True]
    assert out[0]["action"][0] == pytest.approx(0.1) and out[2]["action"] == [0.0] * 7


def test_relative_time_falls_back(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 10.0), ("a", 1, 1.0, 10.5), ("b", 0, 2.0, 5.0), ("b", 1, 2.5, 4.0)], "g string, i long, s double, m double")
    out = {(r["g"], r["i"]): r["rel"] for r in A.relative_time(df, "g", "i", "s", "m").collect()}
    assert out == {("a", 0): 0.0, ("a", 1): 0.5, ("b", 0): 0.0, ("b", 1): 0.5}


def test_last_valid(spark):
    df = spark.createDataFrame([("a", 0, 3.0), ("a", 1, None), ("a", 2, 2.0), ("a", 3, 2.0)], "g string, i long, s double")
    assert [r["falls"] for r in A.falls_below_last_valid(df, "g", "i", "s").orderBy("i").collect()] == [False, False, True, False]


HOLES = {  # with stretches of 8: boundary records lost, whole stretches lost, stretches of a row or two
    "first of a stretch": [i for i in range(40) if i not in (8, 16, 17, 18, 31, 32)],
    "whole stretches": [*range(8), 24, 25, 41, *range(60, 70), 200],
    "single rows": list(range(3, 200, 9)),
    "none": list(range(30)),
}


@pytest.mark.parametrize("holes", HOLES)
@pytest.mark.parametrize("pad", ["repeat_last", "zero"])
def test_chunks_over_holes(spark, monkeypatch, holes, pad):
    monkeypatch.setattr(A.stretches, "__defaults__", (0, 8))
    at, horizon = HOLES[holes], 5
    df = rows(spark, 201).where(F.col("i").isin(at))
    df = df.unionByName(df.withColumn("g", F.lit(None).cast("string")))
    got = {(r["g"], r["i"]): ([c[0] for c in r["chunk"]], r["valid"], r["padded"]) for r in A.action_chunks(df, "g", "i", horizon, pad).collect()}
    want = {}
    for k, i in enumerate(at):
        real = at[k : k + horizon]
        want[i] = (real + [real[-1] if pad == "repeat_last" else 0] * (horizon - len(real)), len(real), horizon - len(real))
    assert got == {(g, i): x for g in ("e", None) for i, x in want.items()}


@pytest.mark.parametrize("holes", HOLES)
def test_terminal_only_at_the_end_over_holes(spark, monkeypatch, holes):
    monkeypatch.setattr(A.stretches, "__defaults__", (0, 8))
    at = HOLES[holes]
    p = rows(spark, 201).where(F.col("i").isin(at)).select(
        "g", "i", F.array(F.col("i").cast("double"), F.lit(0.0), F.lit(0.0)).alias("position"), F.array_repeat(F.lit(0.0), 3).alias("rotation"), F.lit(None).cast("double").alias("gripper")
    )
    out = A.measured_actions(p, "g", "i").orderBy("i").collect()
    assert [r["i"] for r in out if r["terminal"]] == [at[-1]]
    assert [r["action"][0] for r in out] == [b - a for a, b in zip(at, at[1:])] + [0.0]


def test_nothing_is_lost_over_long_runs_of_nulls(spark):
    n = A.STRETCH
    stamps = {0: 3.0, 1: 5.0, n: 4.0, n + 1: 6.0, 4 * n + 7: 5.5, 4 * n + 8: 9.0}
    nulls = [*range(n - 100, n), *range(n + 2, n + 200), 2 * n, 3 * n - 1]
    data = [("a", i, t) for i, t in stamps.items()] + [("a", i, None) for i in nulls] + [("a", None, 8.0)]
    df = spark.createDataFrame(data, "g string, i long, s double")
    out = A.falls_below_last_valid(df, "g", "i", "s").collect()
    assert len(out) == len(data)
    assert {r["i"] for r in out if r["falls"]} == {n, 4 * n + 7, None}
    assert {r["increasing"] for r in A.relative_time(df.where("s is not null and i <= " + str(n)), "g", "i", "s").collect()} == {False}


def test_steps_over_gaps(spark):
    n = A.STRETCH
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 3 * n, 4.0), ("a", 3 * n + 1, 4.5), ("a", None, 14.5)], "g string, i long, t double")
    r = rollups.step_stats(df, "g", "i", "t").first()
    assert (r["n"], r["min_dt"], r["max_dt"], r["mean_dt"], r["duration"]) == (4, 0.5, 10.0, 4.5, 13.5)


def test_chunk_queries_at_the_reference_horizon(spark, sf):
    r = core.QUERIES["action_chunk_zero_pad_50"](spark, sf)
    assert [c for c in r.columns if c.startswith("dx_")] == [f"dx_{k}" for k in range(50)]
    assert {x["valid"] + x["padded"] for x in r.select("valid", "padded").distinct().collect()} == {50}
    assert {"action_chunk_repeat_last_50", "chunk_mask_stats_50"} <= set(core.ORACLES)
