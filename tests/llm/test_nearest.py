import random

import pytest

from tests.helpers import clashing
from tracewright.llm import nearest

FR = "frame_row_id long, episode_id string, timestamp double"
C = "camera_row_id long, episode_id string, stream_name string, source_stamp string"
M = "episode_id string, fps double"
VIEW = {"external_camera_1": "external", "external_camera": "external", "tcp_camera": "tcp", "wrist_camera": "tcp"}


def brute(frames, cams, meta):
    tol = {e: 0.5 / f for e, f in meta if f and f > 0}
    out = set()
    for i, e, t in frames:
        if t is None or e is None:
            continue
        for v in ("external", "tcp"):
            c = [(abs(t - float(s)), k) for k, ce, n, s in cams if ce == e and VIEW.get(n) == v and s]
            if c and min(c)[0] <= tol.get(e, 0.02):
                out.add((i, min(c)[1]))
    return out


def run(spark, frames, cams, meta):
    f, c, m = (spark.createDataFrame(x, s) for x, s in ((frames, FR), (cams, C), (meta, M)))
    return sorted(tuple(r) for r in nearest.found(clashing(f), clashing(c), clashing(m)).collect())


@pytest.mark.parametrize("seed", [0, 1])
def test_as_brute_force(spark, seed):
    r = random.Random(seed)
    meta = [("a", 30.0), ("b", 10.0), ("c", None), ("c", 0.0)]
    frames = [(i, r.choice("abc"), r.choice([None, round(r.random() * 3, 3)])) for i in range(200)]
    cams = [(i, r.choice("abc"), r.choice([*VIEW, "external_camera_2"]), r.choice([None, f"{r.random() * 3:.3f}"])) for i in range(400)]
    got = run(spark, frames, cams, meta)
    assert len(got) == len(set(got)) and set(got) == brute(frames, cams, meta)


def test_ties_copies_and_edges(spark):
    frames = [(1, "a", 1.0), (2, "a", 1.0), (3, "a", 2.0), (4, "a", None), (5, None, 1.0)]
    cams = [(9, "a", "tcp_camera", "1.0078125"), (8, "a", "tcp_camera", "0.9921875"), (7, "a", "wrist_camera", "0.9921875"), (6, "a", "external_camera", '{"sec":2,"nanosec":15625000}'), (5, None, "tcp_camera", "1.0")]
    assert run(spark, frames, cams, [("a", 32.0)]) == [(1, 7), (2, 7), (3, 6)]


def test_empty(spark):
    assert run(spark, [], [], []) == []
    assert run(spark, [(1, "a", 1.0)], [], []) == []
