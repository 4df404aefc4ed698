import numpy as np
import pytest

from tests.helpers import clashing
from tracewright.operators import spikes

S = "field_name string, row_id long, episode_id string, idx long, vec array<double>, bad boolean"
R = "state_row_id long, episode_id string, record_index long, tcp_wrench array<double>, measured_tcp_wrench array<double>, units string"
FR = "frame_row_id long, episode_id string, frame_index long, measured_action array<double>, action_is_terminal_padding boolean"
SI = "entry_id long, episode_id string, stream_name string, units string, notes string"


def series(n=300, seed=0, level=5.0, noise=0.1):
    r = np.random.default_rng(seed)
    x = r.normal(scale=noise, size=(n, 6)) + level
    if n >= 200:
        x[n // 2 : n // 2 + 60] += np.linspace(0, 30, 60)[:, None]  # a contact
        x[n // 2 + 60 :] += 30
    return x


def run(spark, x, units=None, episode="e"):
    rows = [(i, episode, i, [float(v) for v in row], None, units[i] if units else None) for i, row in enumerate(x)]
    df = spikes.found(spark.createDataFrame(rows, R), spark.createDataFrame([], FR), spark.createDataFrame([], SI))
    return {r["row_id"] for r in df.collect()}


def test_planted_spikes_and_nothing_else(spark):
    x = series()
    x[40, 2] += 20
    x[90:92, 0] -= 15
    x[200:203, 4] += 9
    assert run(spark, x) == {40, 90, 91, 200, 201, 202}


def test_steps_and_contacts_are_no_spikes(spark):
    x = series(seed=2)
    x[30:] += 12  # a lasting step
    assert run(spark, x) == set()


def test_stuck_runs(spark):
    x = series(seed=3)
    x[20:28] = x[20]
    x[60:67] = x[60]  # one short of a run
    assert run(spark, x) == set(range(20, 28))


def test_values_out_of_range_or_not_finite(spark):
    x = series(seed=4)
    x[10, 1], x[11, 3], x[12, 0] = np.nan, np.inf, 1e6
    assert run(spark, x) == {10, 11, 12}


def test_change_of_unit_is_no_case(spark):
    x = series(seed=5)
    u = [None] * 300
    for i in range(100, 300):
        x[i] *= 1000
        u[i] = '{"force": "mN", "torque": "mNm"}'
    x[150, 0] += 20_000
    assert run(spark, x, u) == {150}


def test_blocks_change_nothing(spark):
    x = series(n=2000, seed=6)
    where = [50, 383, 384, 385 + 40, 767, 768, 1500]
    for k in where:
        x[k, 1] += 25
    x[378:392, :] = x[378, :]  # a stuck run over the edge of a block
    assert run(spark, x) == set(range(378, 392)) | {k for k in where if not 378 <= k < 392}


def test_copies_are_flagged_all(spark):
    x = series(n=100, seed=7)
    x[40, 2] += 30
    rows = [(i, "e", i, [float(v) for v in row], None, None) for i, row in enumerate(x)]
    rows.append((1000, "e", 40, rows[40][3], None, None))
    df = spikes.found(spark.createDataFrame(rows, R), spark.createDataFrame([], FR), spark.createDataFrame([], SI))
    assert {r["row_id"] for r in df.collect()} == {40, 1000}


def test_awkward_cases(spark):
    ok = [1.0] * 6
    rows = [(1, None, 0, ok, None, None), (2, "e", None, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0], None, None), (3, "e", 1, [1.0, 2.0], None, None), (4, "e", 2, None, None, None), (5, "e", 3, [None] * 6, None, None)]
    r = clashing(spark.createDataFrame(rows, R))
    f = clashing(spark.createDataFrame([(9, "e", 0, [0.0] * 7, True), (10, "e", 1, [float("inf")] * 7, None)], FR))
    got = {tuple(x) for x in spikes.found(r, f, clashing(spark.createDataFrame([], SI))).collect()}
    assert got == {("tcp_wrench", 2), ("measured_action", 10)}


@pytest.mark.parametrize("frac", [0.6])
def test_mostly_stuck_source_keeps_its_noise(spark, frac):
    x = series(n=100, seed=8)[:50]
    x[10:40] = x[10]
    assert run(spark, x) == set(range(10, 40))


def test_an_index_of_very_many_records_spreads(spark):
    """Thousands of different vectors under one index: blocks stay of one size, and spikes after
    them are found all the same."""
    r = np.random.default_rng(9)
    rows = [(i, "e", 0, [float(v) for v in x], None, None) for i, x in enumerate(r.normal(scale=0.1, size=(5000, 6)) + 5)]
    rows += [(10_000 + i, "e", 1 + i, [float(v) for v in x], None, None) for i, x in enumerate(r.normal(scale=0.1, size=(200, 6)) + 5)]
    rows[5100][3][2] += 20.0
    df = spark.createDataFrame(rows, R)
    s = spikes.as_series(df, "tcp_wrench", "state_row_id", "record_index", spikes.LIMITS)
    sizes = [len(x["pos"]) for x in spikes.blocks(s).collect()]
    assert len(sizes) == -(-5200 // spikes.BLOCK) and max(sizes) <= spikes.BLOCK + 2 * spikes.HALO
    got = {x["row_id"] for x in spikes.found(df, spark.createDataFrame([], FR), spark.createDataFrame([], SI)).collect()}
    assert got == {10_100}


def test_places_count_every_record_once(spark):
    r = np.random.default_rng(3)
    rows = [("tcp_wrench", i, f"e{i % 7}", int(r.integers(0, 300)), [float(i % 11)] * 6, False) for i in range(4000)]
    got = spikes.ordered_records(spark.createDataFrame(rows, S)).collect()
    by = {}
    for x in got:
        by.setdefault(x["episode_id"], []).append((x["pos"], x["idx"], x["first_id"]))
    for e, v in by.items():
        assert sorted(p for p, _, _ in v) == list(range(len(v)))
        assert [x[1:] for x in sorted(v)] == sorted(x[1:] for x in v)


def test_thresholds_are_parameters(spark):
    x = series(n=100, seed=7)
    x[40, 2] += 30
    df = spark.createDataFrame([(i, "e", i, [float(v) for v in row], None, None) for i, row in enumerate(x)], R)
    fr, si = spark.createDataFrame([], FR), spark.createDataFrame([], SI)
    assert spikes.found(df, fr, si, ao_z=1e6).count() == 0
    assert spikes.found(df, fr, si, limits={**spikes.LIMITS, "tcp_wrench": [4.0] * 6}).count() > 50
