import random

import pytest

from tests.helpers import clashing
from tracewright.llm import splits

M = "meta_row_id long, episode_id string, geometry_type string, collection_method string, source_staged_export string"


def find(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return root


@pytest.mark.parametrize("kind", ["random", "path", "star"])
def test_components_as_union_find(spark, kind):
    r = random.Random(3)
    n = 120
    e = {"random": [(r.randrange(n), r.randrange(n)) for _ in range(90)], "path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 80)]}[kind]
    got = {x["vertex"]: x["label"] for x in splits.components(spark.createDataFrame(e, "u long, v long")).collect()}
    root = find(e)
    nodes = {x for p in e if p[0] != p[1] for x in p}
    assert set(got) == nodes
    same = {}
    for x in nodes:
        assert same.setdefault(root(x), got[x]) == got[x]
    assert len(set(got.values())) == len({root(x) for x in nodes})


def test_spellings(spark):
    g, c = "round_peg_round_hole", "hand_guiding"
    ids = ["episode_000123", "EPISODE_000123", "ep000123", "ep-00123", "E123", "Episode-123", "episode 123", "episode_000123 (trimmed)", "episode-000123/cut-1", "EP_000123_retake2", "episode000123.v2", "episode_000123_copy", "episode_000123__2nd export"]
    gs = ["roundPegRoundHole", "Round Peg Round Hole", "round peg / round hole", "ROUND_PEG_ROUND_HOLE", "  round_peg_round_hole ", "round-peg-round-hole", "round_peg_ruond_hole", "round_peg_round_hle", g, g, g, g, g]
    rows = [(i + 1, e, gs[i], c, None) for i, e in enumerate(ids)]
    rows += [(100 + i, f"episode_{900000 + i}", g, c, None) for i in range(12)]  # the label is frequent
    rows += [(50, "episode_000123", "hex_peg_hex_hole", c, None), (51, "episode_000123", g, "vr_controller", None), (52, "episode_000123", None, c, None), (53, "episode_000123", None, c, None), (54, None, g, c, None)]
    got = {(r[0], r[1]) for r in splits.found(clashing(spark.createDataFrame(rows, M))).collect()}
    assert got == {(1, i) for i in range(2, 14)}


def test_exports_chain(spark):
    g = ("g", "c")
    rows = [
        (1, "episode_000001", *g, "data/staged/x_13d/episode_000002/"), (2, "episode_000002", *g, "./staged/x_25d/ep000003"), (3, "episode_000003", *g, None), (4, "episode_000004", *g, "/mnt/exports/x_25d/Episode-9"),
        (5, "episode_000005", *g, "/mnt/exports/x/Episode-9"), (6, "episode_000006", "h", "c", "data/x/episode_000001"), (7, "episode_000003", *g, None), (7000, "episode_000001", *g, None),
    ]
    got = {(r[0], r[1]) for r in splits.found(spark.createDataFrame(rows, M)).collect()}
    assert got == {(1, 2), (1, 3), (1, 7), (1, 7000)}


def test_shares_and_togetherness(spark):
    rows = [(i, f"episode_{i // 2:06d}", "g", "c", None) for i in range(4000)] + [(10_000 + i, "episode_777777", "g", "c", None) for i in range(2000)]
    out = splits.split_rows(spark.createDataFrame(rows, M)).collect()
    n = {s: sum(r["split"] == s for r in out) / len(out) for s in ("train", "validation", "test")}
    assert abs(n["train"] - 0.8) < 0.02 and abs(n["validation"] - 0.1) < 0.02 and abs(n["test"] - 0.1) < 0.02
    by = {}
    for r in out:
        assert by.setdefault(r["group_id"], r["split"]) == r["split"]


def test_empty(spark):
    e = spark.createDataFrame([], M)
    assert splits.found(e).count() == 0 and splits.split_rows(e).count() == 0


def test_a_differing_digit_is_no_misspelling(spark):
    rows = [(i, f"episode_{i}", "peg_hole_m8", "hand_guiding", None) for i in range(10, 18)] + [(1, "episode_3", "peg_hole_m6", "hand_guiding", None), (2, "episode_3", "peg_hole_m8", "hand_guiding", None)]
    assert splits.found(spark.createDataFrame(rows, M)).count() == 0


def test_the_number_stands_after_the_marker(spark):
    rows = [(1, "lab2_episode_7", "g", "c", None), (2, "lab2_episode_9", "g", "c", None), (3, "site 4 / ep-9 take 2", "g", "c", None), (4, "run3E7_cut1", "g", "c", None), (5, "7", "g", "c", None)]
    assert {tuple(r) for r in splits.found(spark.createDataFrame(rows, M)).collect()} == {(1, 4), (1, 5), (2, 3)}
