import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import clashing
from tracewright.operators import compact, drift

RF = "file_id long, file_path string, recorder_id string, stream_name string, written_at timestamp, n_bytes long, content string"


def files(spark, rows):
    import datetime

    t0 = datetime.datetime(2025, 1, 1)
    return spark.createDataFrame([(i, f"f{i}", rec, st, None if at is None else t0 + datetime.timedelta(hours=at), 0, c) for i, rec, st, at, c in rows], RF)


def lines(*objs):
    return "\n".join(o if isinstance(o, str) else json.dumps(o) for o in objs)


def frame(ep="episode_000001", k=0, a="images/a/0.jpg", b="images/b/0.jpg"):
    return {"episode_id": ep, "frame_index": k, "timestamp": 0.0, "external_rgb_path": a, "tcp_rgb_path": b}


def test_same_record_however_written(spark):
    same = [
        frame(), frame("EPISODE_000001"), frame(k="000000"), frame(a="/mnt/rec/episode_000001/images/a/0.jpg", b="episode_000001/images/b/0.jpg"), frame(a="./images/a/0.jpg", b="images//b//0.jpg"),
        frame(a="images/./a/0.jpg"),
    ]
    other = [frame(k=1), frame(a="images/take2/a/0.jpg"), frame(ep="episode_000002"), frame(a=None)]
    df = files(spark, [(1, "r", "frames", 0, lines(same[0], "", '{"episode_id":"epi', other[0])), (2, "r", "frames", 1, lines(*same[1:], *other[1:], "")), (3, "r", "frames", 2, ""), (4, "r", "frames", 3, None), (5, "r", "gripper_state", 3, lines(same[0])), (6, None, "frames", None, lines("[1]", "  ", other[3]))])
    got = sorted(tuple(r) for r in compact.found(clashing(df)).collect())
    assert got == [(2, 1), (2, 2), (2, 3), (2, 4), (2, 5), (6, 3)]


def test_consolidation_commits_only_what_it_read(spark, tmp_path, monkeypatch):
    df = files(spark, [(i, "r", "frames", i, lines(frame(k=i), frame(k=i // 2))) for i in range(200)])
    out = str(tmp_path / "out")
    _, t = compact.compact_frames(df, out)
    assert t.count() == 200 and t.select(*compact.KEY).distinct().count() == 200
    assert len(list((tmp_path / "out").glob("part-*.parquet"))) <= 8
    with pytest.raises(RuntimeError):
        compact.consolidate(t, str(tmp_path / "bad"), expect=(1, None, None))
    assert not (tmp_path / "bad").exists() and not (tmp_path / "bad.part").exists()


def test_no_files(spark):
    assert compact.found(files(spark, [])).count() == 0
    assert drift.found(files(spark, [])).count() == 0


def changes(spark, seq, stream="gripper_state"):
    rows = [(i + 1, "r", stream, i, lines(*f) if isinstance(f, list) else f) for i, f in enumerate(seq)]
    return sorted(tuple(r) for r in drift.found(clashing(files(spark, rows))).collect())


def g(**kw):
    return {"record_index": 1, "gripper_width_m": 0.05, **kw}


def test_kinds_of_change(spark):
    seq = [
        [g(gripper_position=0.5)],
        [g(gripper_position=0.6, finger="soft_pads")],  # added
        [{"record_index": 2, "width_m": 0.052, "gripper_position": 0.61, "finger": "v_groove"}],  # renamed
        [{"record_index": 3, "width_m": 0.05, "gripper_position": None, "finger": "soft_pads"}],  # nulls tell no type
        [{"record_index": 4, "width_m": 0.05, "gripper_position": "0.62", "finger": "soft_pads"}],  # retyped
        "",  # no record: passed over
        [{"record_index": 5, "width_m": 0.05, "gripper_position": [0.5], "fault": True}, "{broken"],  # retyped; finger goes, fault comes
        [{"record_index": 6, "width_m": 0.05, "gripper_position": [0.5], "fault": True, "finger": "soft_pads"}],  # comes again
    ]
    assert changes(spark, seq) == [
        (2, "added", "", "finger"), (3, "renamed", "gripper_width_m", "width_m"), (5, "retyped", "gripper_position", "gripper_position"),
        (7, "added", "", "fault"), (7, "removed", "finger", ""), (7, "retyped", "gripper_position", "gripper_position"), (8, "added", "", "finger"),
    ]


def test_sources_do_not_mix_and_null_recorders_are_one(spark):
    rows = [(1, "a", "gripper_state", 0, lines(g())), (2, "b", "gripper_state", 1, lines(g(x=1))), (3, None, "gripper_state", 2, lines(g())), (4, None, "gripper_state", 3, lines(g(y=1))), (5, "a", "frames", 4, lines(frame()))]
    assert [tuple(r) for r in drift.found(files(spark, rows)).collect()] == [(4, "added", "", "y")]


def test_chunks_change_nothing(spark, monkeypatch):
    seq = [[g(**({"a": k} if k % 3 else {}), **({"b": "x" if k % 5 else 1} if k > 7 else {}))] for k in range(40)]
    whole = changes(spark, seq)
    monkeypatch.setattr(drift, "CHUNK_FILES", 6)
    assert changes(spark, seq) == whole and len(whole) > 20


def test_one_table(spark):
    rows = [(1, "r", "gripper_state", 0, lines(g(gripper_position=0.5, placeholder=False))), (2, "r", "gripper_state", 1, lines({"record_index": 2, "width_m": 0.06, "gripper_position": "0.7", "placeholder": 1, "extra": "q"})), (3, "r", "gripper_state", 2, lines({"record_index": 3, "width_m": 0.061, "gripper_position": [0.8], "placeholder": "yes"}))]
    t = drift.unified(files(spark, rows), "gripper_state").orderBy("file_id").collect()
    assert [(r["gripper_width_m"], r["gripper_position"], r["placeholder"]) for r in t] == [(0.05, 0.5, False), (0.06, 0.7, True), (0.061, 0.8, True)]
    assert t[1]["others"] == {"extra": "q"}
    v = files(spark, [(1, "r", "robot_state_rt", 0, lines({"raw_force_torque": [1, 2, 3, 4, 5, 6]})), (2, "r", "robot_state_rt", 1, lines({"raw_ft": [1.5, 2, 3, 4, 5, 6]})), (3, "r", "robot_state_rt", 2, lines({"raw_ft": "1,2,3,4,5,7"}))])
    assert [r[0][5] for r in drift.unified(v, "robot_state_rt").orderBy("file_id").select("raw_force_torque").collect()] == [6, 6, 7]
    assert v.where(F.col("content").isNull()).count() == 0


def test_versions_and_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(drift, "CHUNK_FILES", 2)
    rec = lambda **k: lines({"record_index": 0, **k})
    rows = [(1, "r", "gripper_state", 0, rec(a=1)), (2, "r", "gripper_state", 1, rec(a=2)), (3, "r", "gripper_state", 2, rec(a=None)), (4, "r", "gripper_state", 3, rec(a="x")), (5, "r", "gripper_state", 4, rec(a="y", b=1)), (6, "r", "gripper_state", 5, rec(a="y", b=1)), (7, "q", "gripper_state", 0, rec(a=1))]
    got = {r["file_id"]: (r["version"], r["fingerprint"]) for r in drift.versions(files(spark, rows)).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 2, 6: 2, 7: 0}
    assert got[1][1] == got[3][1] == got[7][1] != got[4][1] and len(got[1][1]) == 64


def test_routes_follow_time_and_recorder(spark):
    """``w`` is a width in one recorder and, later there, a position; what it stands for is told
    by the chain it is in, not by its name."""
    obj = lambda **k: lines(*({"record_index": i, **{n: v + i / 1000 for n, v in k.items()}} for i in range(3)))
    rows = [
        (1, "r", "gripper_state", 0, obj(gripper_width_m=0.05, gripper_position=500.5)), (2, "r", "gripper_state", 1, obj(w=0.05, gripper_position=500.5)), (3, "r", "gripper_state", 2, obj(gripper_width_m=0.05, gripper_position=500.5)),
        (4, "r", "gripper_state", 3, obj(gripper_width_m=0.05, w=500.5)), (5, "q", "gripper_state", 0, obj(gripper_width_m=0.05, odd=3.25)),
    ]
    df = files(spark, rows)
    route = {(r["file_id"], r["name"]): r["target"] for r in drift.routes(df).collect()}
    assert route[2, "w"] == "gripper_width_m" and route[4, "w"] == "gripper_position" and (5, "odd") not in route
    t = {(r["file_id"], r["line_no"]): r for r in drift.unified(clashing(df), "gripper_state").collect()}
    assert len(t) == 15 and t[2, 1]["gripper_width_m"] == 0.05 and t[4, 1]["gripper_position"] == 500.5 and t[5, 2]["others"] == {"odd": "3.251"}


def test_values_that_lose_stay_in_others(spark):
    a = {"record_index": 0, "gripper_width_m": 0.05}
    rows = [(1, "r", "gripper_state", 0, lines(a)), (2, "r", "gripper_state", 1, lines({"record_index": 0, "width": 0.05})), (3, "r", "gripper_state", 2, lines({"record_index": 0, "width": 0.05, "gripper_width_m": 0.07}))]
    t = {r["file_id"]: r for r in drift.unified(files(spark, rows), "gripper_state").collect()}
    assert t[2]["gripper_width_m"] == 0.05 and t[2]["others"] == {}
    assert t[3]["gripper_width_m"] == 0.07 and t[3]["others"] == {"width": "0.05"}


def test_the_old_table_stays_until_the_new_one_is_there(spark, tmp_path):
    out = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a")], "id long, k string")
    compact.consolidate(first, out, key=("id",))
    again = compact.consolidate(spark.createDataFrame([(2, "b"), (3, "c")], first.schema), out, key=("id",))
    assert sorted(r["id"] for r in again.collect()) == [2, 3] and not (tmp_path / "t.old").exists()
    with pytest.raises(RuntimeError):
        compact.consolidate(first, out, key=("id",), expect=(9, 0, 0))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [2, 3]
