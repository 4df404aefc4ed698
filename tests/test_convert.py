import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import clashing
from tracewright.operators import cameras, convert, exportcheck, readiness

R = "state_row_id long, episode_id string, record_index long, source_stamp string, monotonic_stamp double, actual_tcp_position array<double>, tcp_wrench array<double>, measured_tcp_wrench array<double>, external_tcp_force array<double>, raw_force_torque array<double>, units string"
J = "joint_row_id long, episode_id string, record_index long, position array<double>, velocity array<double>, units string"
G = "gripper_row_id long, episode_id string, record_index long, gripper_position double, gripper_width_m double, placeholder boolean"
C = "camera_row_id long, episode_id string, stream_name string, record_index long, image_path string"
S = "entry_id long, episode_id string, stream_name string, units string, source_name string, source_type string"
W = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
U = '{"tcp_position": "mm", "tcp_orientation": "deg"}'
V = '{"position": "deg", "velocity": "deg/s"}'


def episode(spark, n=4, ep="a", units=U, entry=None, skip=(), grip=True):
    robot = [(i, ep, i, str(i * 0.1), 10.0 + i, [100.0 * i, 0.0, 50.0, 0.0, 0.0, 90.0 * i], None, W if i % 2 else None, W, None, units) for i in range(n)]
    joints = [(i, ep, i, [90.0] * 6, [180.0] * 6, V) for i in range(n) if i not in skip]
    g = [(i, ep, i, None, 0.01 * i, False) for i in range(n)] if grip else []
    cams = [(10 * k + i, ep, s, i, f"{s}/{i}.jpg") for k, s in enumerate(("tcp_camera", "external_camera_1")) for i in range(n)]
    streams = [(1, ep, "robot_state_rt", entry, "r", "t"), (2, ep, "joint_states", None, "r", "t")] + [(3 + k, ep, s, None, "c", "t") for k, s in enumerate(("tcp_camera", "external_camera_1"))]
    mk = spark.createDataFrame
    return mk(robot, R), mk(joints, J), mk(g, G), mk(cams, C), mk(streams, S)


def test_state_layout_and_units(spark):
    r, j, g, _, s = episode(spark)
    rows = {x["record_index"]: x for x in convert.states(clashing(r), clashing(j), g, s).collect()}
    x = rows[1]
    assert x["error"] is None and x["wrench_source"] == "measured_tcp_wrench" and rows[2]["wrench_source"] == "external_tcp_force"
    want = [0.1, 0.0, 0.05, 0.0, 0.0, math.pi / 2, 0.01, *W, *[math.pi / 2] * 6, *[math.pi] * 6]
    assert x["model_state"] == pytest.approx(want)
    assert rows[3]["model_state"][5] == pytest.approx(1.5 * math.pi)  # kept as recorded, not brought below half a turn
    assert x["joint_source"] == "joint_states.position; joint_states.velocity"


@pytest.mark.parametrize(
    "units, entry, defaults, want",
    [
        ('{"tcp_position": "m"}', U, None, 100.0),  # the record goes before the entry, key by key
        (None, U, None, 0.1),
        (None, None, convert.SYNTHETIC_UNITS, 0.1),
        (None, None, None, "tcp_position unit is missing or unknown"),
        ('{"tcp_position": "furlong", "tcp_orientation": "deg"}', None, convert.SYNTHETIC_UNITS, "tcp_position unit is missing or unknown"),
        ('{"tcp_position": " Millimeters ", "tcp_orientation": "quarter"}', None, None, "tcp_orientation unit is missing or unknown"),
    ],
)
def test_stated_units(spark, units, entry, defaults, want):
    r, _, _, _, s = episode(spark, units=units, entry=entry)
    x = convert.poses(r, s, defaults).where("record_index = 1").first()
    assert (x["error"] == want) if isinstance(want, str) else (x["position"][0] == pytest.approx(want) and x["error"] is None)


def views(streams):
    return cameras.select_views(streams.select("episode_id", "stream_name"))


def test_frames_of_a_whole_episode(spark):
    r, j, g, c, s = episode(spark)
    frames, refused = convert.processed_frames(r, j, g, c, s, views(s))
    rows = frames.orderBy("frame_index").collect()
    assert refused.count() == 0 and [x["frame_index"] for x in rows] == [0, 1, 2, 3]
    assert [x["timestamp"] for x in rows] == pytest.approx([0.0, 0.1, 0.2, 0.3])
    assert rows[2]["external_rgb_path"] == "external_camera_1/2.jpg" and rows[2]["tcp_rgb_path"] == "tcp_camera/2.jpg"
    assert rows[0]["measured_action"] == pytest.approx([0.1, 0, 0, 0, 0, math.pi / 2, 0.01]) and rows[3]["measured_action"] == [0.0] * 7
    assert [x["action_is_terminal_padding"] for x in rows] == [False, False, False, True]


def test_what_is_refused(spark):
    r, j, g, c, s = episode(spark, skip=(2,))
    assert [x["reason"] for x in convert.processed_frames(r, j, g, c, s, views(s))[1].collect()] == ["joint_states: record indexes differ from the robot's"]
    r, j, g, c, s = episode(spark, units=None)
    frames, refused = convert.processed_frames(r, j, g, c, s, views(s))
    assert refused.first()["reason"] == "tcp_position unit is missing or unknown" and frames.count() == 0
    r, j, g, c, s = episode(spark)
    tied = r.withColumn("source_stamp", F.lit("1.0"))
    assert [x["timestamp"] for x in convert.processed_frames(tied, j, g, c, s, views(s))[0].orderBy("frame_index").collect()] == pytest.approx([0, 1, 2, 3])  # the monotonic stamps
    assert convert.processed_frames(tied.withColumn("monotonic_stamp", F.lit(1.0)), j, g, c, s, views(s))[1].first()["reason"] == "stamps do not increase"
    e = [spark.createDataFrame([], x.schema) for x in (r, j, g, c, s)]
    assert all(x.count() == 0 for x in convert.processed_frames(*e, views(e[4])))


def test_index_sets(spark):
    r, j, g, c, _ = episode(spark, skip=(1, 3))
    extra = j.unionByName(spark.createDataFrame([(9, "a", 9, W, W, V)], J))
    got = {x["stream"]: (x["n_common"], x["first_missing"], x["first_extra"], x["aligned"]) for x in convert.index_sets(r, {"joint_states": extra.select("episode_id", "record_index"), "cameras": c.select("episode_id", "stream_name", "record_index")}).collect()}
    assert got == {"joint_states": (2, "1,3", "9", False), "tcp_camera": (4, None, None, True), "external_camera_1": (4, None, None, True)}


def test_plain_recordings_are_zipped_by_row(spark):
    h = math.sqrt(0.5)
    tcp = spark.createDataFrame([("a", 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0), ("a", 1, 0.1, 1.0, 0.0, 0.0, 0.0, 0.0, h, h), ("b", 0, 0.0, *[0.0] * 6, 1.0)], "episode_id string, row long, timestamp double, x double, y double, z double, qx double, qy double, qz double, qw double")
    jn = spark.createDataFrame([("a", i, *[float(i)] * 12) for i in range(2)], "episode_id string, row long, " + ", ".join(f"joint_{k}_{i} double" for k in ("pos", "vel") for i in range(6)))
    wr = spark.createDataFrame([("a", i, *W) for i in range(2)], "episode_id string, row long, fx double, fy double, fz double, tx double, ty double, tz double")
    rows = convert.plain_frames(tcp, jn, wr).orderBy("frame_index").collect()
    assert [r["episode_id"] for r in rows] == ["a", "a"] and convert.unequal_rows(tcp, jn, wr).first()["episode_id"] == "b"
    assert rows[1]["model_state"] == pytest.approx([1, 0, 0, 0, 0, math.pi / 2, 0, *W, *[1.0] * 12])
    assert rows[0]["measured_action"] == pytest.approx([1, 0, 0, 0, 0, math.pi / 2, 0]) and rows[1]["action_is_terminal_padding"]


# --- cameras ------------------------------------------------------------------------------
def pick(streams, objects=None):
    said = cameras.mapping_rows(objects, "meta", 0) if objects is not None else None
    return {x["view"]: (x["stream_name"], x["source"], x["error"]) for x in cameras.select_views(streams, said).collect()}


CAMS = "episode_id string, stream_name string, kind string, role string, model_input_key string, used_for_model boolean"


def cams(spark, *rows):
    return spark.createDataFrame([("e", *r, *[None] * (5 - len(r))) for r in rows], CAMS)


def test_camera_selection(spark):
    mk = lambda m: spark.createDataFrame([("e", m)], "episode_id string, meta string")
    two = cams(spark, ("tcp_camera",), ("external_camera_1",), ("external_camera_2",), ("joint_states", "joint_state"))
    assert pick(two) == {"tcp": ("tcp_camera", "inferred", None), "external": (None, None, "multiple candidates")}
    assert pick(two, mk('{"model_camera_mapping": {"external_rgb_path": "external_camera_2"}}'))["external"] == ("external_camera_2", "explicit", None)
    assert pick(two, mk('{"camera_mapping": {"Observation.Image": {"stream_name": "external_camera_1"}, "other": "x"}}'))["external"] == ("external_camera_1", "explicit", None)
    assert pick(two, mk('{"model_camera_mapping": {"external": "external_camera_2"}, "camera_mapping": {"external": "external_camera_1"}}'))["external"] == ("external_camera_2", "explicit", "conflicting assignments")
    assert pick(two, mk('{"model_camera_mapping": {"external": "joint_states"}}'))["external"] == (None, None, "assignment names no camera stream")
    assert pick(two, mk('{"model_camera_mapping": {"tcp": {}}}'))["tcp"] == ("tcp_camera", "inferred", "assignment must name a stream")
    keyed = cams(spark, ("cam_a", "camera_rgb", None, "external_rgb_path"), ("cam_b", None, "wrist"), ("external_camera",))
    assert pick(keyed) == {"external": ("cam_a", "explicit", None), "tcp": ("cam_b", "inferred", None)}
    used = cams(spark, ("external_camera_1", None, None, None, False), ("external_camera_2", None, None, None, True), ("odd", "camera", None, None, None))
    assert pick(used)["external"][:2] == ("external_camera_2", "explicit") and pick(used)["tcp"] == (None, None, "no camera stream")
    assert pick(cams(spark, ("odd", "camera", None, None, True)))["tcp"][2] == "used_for_model without a role or key"
    assert pick(cams(spark)) == {}


def test_camera_metadata_and_topics(spark):
    row = spark.createDataFrame([('{"path": "p", "role": "tcp", "secret": "x", "camera_id": ""}', '{"camera_topics": {"tcp_camera": "/t"}, "external_camera_topic": "/e", "odd_topic": "/o"}')], "e string, g string")
    r = row.select(cameras.kept_metadata(F.col("e")).alias("kept"), *(cameras.topic_of(F.col("g"), F.lit(s)).alias(s) for s in ("tcp_camera", "external_camera_1", "odd", "none"))).first()
    assert r["kept"] == '{"path":"p","role":"tcp"}' and (r["tcp_camera"], r["external_camera_1"], r["odd"], r["none"]) == ("/t", "/e", "/o", None)


# --- readiness ----------------------------------------------------------------------------
def rules_of(df):
    return sorted((r["rule_id"], r["row_id"]) for r in df.collect())


def test_calibration_and_provenance(spark):
    _, _, _, _, s = episode(spark)
    known = '{"tcp_tool_calibration": "c1", "force_torque_calibration": {"id": {"name": "f"}}, "camera_intrinsics": {"tcp_camera": "i", "external_camera_1": "TODO later"}, "camera_extrinsics": {"tcp_camera": {"ref": "x"}}}'
    docs = spark.createDataFrame([("a", known)], "episode_id string, calibration_refs string")
    got = sorted(r["message"] for r in readiness.calibration_findings(docs, s).collect())
    assert got == ["camera_extrinsics.external_camera_1 must be a known reference", "camera_intrinsics.external_camera_1 must be a known reference"]
    d = spark.createDataFrame([("a", '{"verified": true, "path": "/w", "git_commit": "unknown", "git_remote": "r", "git_branch": "b"}', '{"time_sync_verified": true, "camera_topics": {"tcp_camera": "/t", "external_camera_1": "tbd"}}')], "episode_id string, source_workspace string, live_graph_verification string")
    got = sorted(r["message"] for r in readiness.provenance_findings(d, s.withColumn("verified", F.lit(True))).collect())
    assert got == ["external_camera_1: topic must be known", "source_workspace.git_commit must be known"]


def test_orientation_timebase_wrench(spark):
    d = spark.createDataFrame([("a", "rotation_vector_degrees", '{"source_stamp_unit": "seconds"}'), ("b", "euler_zyz_degrees", None), ("c", None, "{}"), ("d", "sideways", "{}")], "episode_id string, tcp_orientation_convention string, timebase string")
    assert sorted((r["episode_id"], r["message"].split()[0]) for r in readiness.orientation_findings(d).collect()) == [("b", "native"), ("c", "orientation"), ("d", "orientation")]
    rec = spark.createDataFrame([("a", "1.0"), ("b", "2"), ("c", '{"sec": 1, "nanosec": 0}')], "episode_id string, source_stamp string")
    assert [r["episode_id"] for r in readiness.timebase_findings(rec, d).collect()] == ["b"]
    r, *_ = episode(spark)
    good = '{"measured_tcp_wrench": {"order": ["Fx", "Fy", "Fz", "Tx", "Ty", "Tz"], "force_unit": "N", "torque_unit": "Nm", "frame": "tcp", "approved_for_model_state": true}, "external_tcp_force": {"order": ["Fx", "Fy", "Fz", "Tx", "Ty", "Tz"], "force_unit": "kgf", "torque_unit": "Nm", "frame": "moon"}}'
    w = spark.createDataFrame([("a", good)], "episode_id string, wrench_sources string")
    assert sorted(r["message"] for r in readiness.wrench_metadata_findings(r, w).collect()) == [f"wrench metadata of external_tcp_force: {k}" for k in ("approved_for_model_state", "force_unit", "frame")]
    assert readiness.ordered_sources(r).first()["sources"] == ["external_tcp_force", "measured_tcp_wrench"]


def test_sequence_over_stretches(spark):
    n = 3 * 8192
    df = spark.range(n).select(F.lit("a").alias("episode_id"), F.col("id").alias("row"), F.when(F.col("id") >= 9000, F.col("id") + 1).otherwise(F.col("id")).alias("record_index"), F.when(F.col("id") == 8192, 5.0).otherwise(F.col("id").cast("double")).alias("t"))
    got = rules_of(readiness.sequence_findings(df, "s", "row", {"t": F.col("t")}))
    assert [g for g in got if g[0] == "t_falls"] == [("t_falls", 8192)]
    assert len(got) == 1 + n - 9000 and ("record_index_not_sequential", 9000) in got and ("record_index_not_sequential", 8999) not in got


def test_gripper_rules(spark):
    r, _, g, _, s = episode(spark)
    assert rules_of(readiness.gripper_findings(r, g, s)) == []
    assert rules_of(readiness.gripper_findings(r, g.where("false"), s)) == [("gripper_missing", None)]
    bad = g.where("record_index <> 2").withColumn("gripper_width_m", F.when(F.col("record_index") == 1, float("nan")).otherwise(0.1)).withColumn("placeholder", F.col("record_index") == 0)
    named = s.unionByName(spark.createDataFrame([(9, "a", "gripper_state", None, "synthetic gripper", "x")], S))
    f = readiness.gripper_findings(r, bad, named)
    assert rules_of(f) == [("gripper_indexes", None), ("gripper_placeholder", None), ("gripper_value", 1)]
    assert f.where("rule_id = 'gripper_placeholder'").first()["message"] == "placeholder=true, source_name=synthetic gripper"


def test_transforms_and_events(spark):
    t = "struct<parent_frame:string,child_frame:string,translation:array<double>,rotation_xyzw:array<double>>"
    tf = spark.createDataFrame([("a", 1, [("b", "t", [0.0] * 3, [0.0] * 4)]), ("a", 2, [("b", "", [0.0, float("nan"), 0.0], [0.0] * 3)]), ("a", 3, None)], f"episode_id string, row_id long, transforms array<{t}>")
    assert sorted((r["row_id"], r["message"].split()[0]) for r in readiness.transform_findings(tf).collect()) == [(2, "child_frame"), (2, "rotation_xyzw"), (2, "translation"), (3, "transforms")]
    ev = spark.createDataFrame([("a", 1, 0.0, "episode_start"), ("a", 2, None, "x"), ("a", 3, 2.0, ""), ("a", 4, 1.0, "contact"), ("b", 5, 0.0, "grasp failed")], "episode_id string, row_id long, timestamp double, event string")
    out = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "episode_id string, success boolean")
    got = sorted((r["episode_id"], r["rule_id"], r["row_id"]) for r in readiness.event_findings(ev, out).collect())
    assert got == sorted([("a", "timestamp_invalid", 2), ("a", "timestamp_falls", 4), ("a", "event_empty", 3), ("a", "success_missing", None), ("b", "start_missing", None), ("c", "events_missing", None)])


def test_inspection(spark):
    f = spark.createDataFrame([("frames", "x", "warning", "a", 1, "m"), ("readiness", "orientation_convention", "error", "b", None, "m"), ("frames", "y", "error", "c", 2, "m")], "layer string, rule_id string, severity string, episode_id string, row_id long, message string")
    e = spark.createDataFrame([("a", False), ("b", False), ("c", False), ("d", True)], "episode_id string, synthetic boolean")
    got = {r["episode_id"]: (r["status"], r["schema_valid"], r["conversion_ready"], r["training_ready"], r["blockers"]) for r in readiness.inspection(f, e).collect()}
    assert got == {"a": ("warning", True, True, True, ""), "b": ("failed", True, False, False, "readiness.orientation_convention"), "c": ("failed", False, False, False, "frames.y"), "d": ("ok", True, True, False, "")}


# --- exports ------------------------------------------------------------------------------
def test_features_and_plans(spark):
    f = exportcheck.features("compact_13d")
    assert f["observation.state"]["shape"] == [13] and f["observation.image"]["shape"] == [480, 640, 3] and list(f)[-1] == "prompt"
    with pytest.raises(ValueError):
        exportcheck.features("tiny")
    p = spark.createDataFrame([("a", 5, 4, 1, 4, 4, 13, 13, 7), ("b", 5, 4, 0, 3, 4, 13, 12, None)], "episode_id string, frames_in long, exported long, excluded long, external_images long, tcp_images long, state_dim long, state_length long, action_length long")
    assert sorted((r["episode_id"], r["rule_id"]) for r in exportcheck.plan_findings(p, "compact_13d").collect()) == [("b", "excluded_wrong"), ("b", "external_images_missing"), ("b", "preview_action_wrong"), ("b", "preview_state_wrong")]
    lack = spark.createDataFrame([('{"a": 1, "c": null}',)], "doc string").select(exportcheck.missing_keys(F.col("doc"), ["a", "b", "c"]).alias("m")).first()["m"]
    assert lack == ["b"]


def test_staged_against_plan(spark):
    row = lambda e, i, **k: {"episode_id": e, "frame_index": i, "observation.image": "x", "observation.wrist_image": "y", "observation.state": [0.0] * 13, "action": [0.0] * 7, "task": "t", "prompt": "t", "source": "s", **k}
    st = spark.createDataFrame([row("a", 0), row("a", 1, task=" ", prompt="t"), row("b", 0, source="other")], "episode_id string, frame_index long, `observation.image` string, `observation.wrist_image` string, `observation.state` array<double>, action array<double>, task string, prompt string, source string")
    plans = spark.createDataFrame([("a", 2, "s"), ("b", 2, "s")], "episode_id string, exported long, source string")
    got = sorted((r["episode_id"], r["rule_id"]) for r in exportcheck.staged_findings(st, plans, "compact_13d").collect())
    assert got == [("a", "prompt_differs"), ("a", "task_empty"), ("b", "count_differs"), ("b", "source_differs")]


def dataset(spark):
    fr = [(e, i, 2 * e + i, 0, "t", "t", [0.0] * 13, [0.0] * 7) for e in range(2) for i in range(2)]
    f = spark.createDataFrame(fr, "episode_index long, frame_index long, index long, task_index long, task string, prompt string, state array<double>, action array<double>")
    e = spark.createDataFrame([(0, 0, 2), (1, 0, 2)], "episode_index long, task_index long, length long")
    t = spark.createDataFrame([(0, "t")], "task_index long, task string")
    i = spark.createDataFrame([(2, 4, 1, 1)], "total_episodes long, total_frames long, total_tasks long, total_chunks long")
    return f, e, t, i


def test_dataset_rules(spark):
    f, e, t, i = dataset(spark)
    stats = e.select("episode_index")
    assert exportcheck.dataset_findings(f, e, t, stats, i, "compact_13d").count() == 0
    bad = f.withColumn("index", F.when(F.col("index") == 3, 7).otherwise(F.col("index"))).withColumn("prompt", F.when(F.col("index") == 0, "x").otherwise("t"))
    got = {r["rule_id"] for r in exportcheck.dataset_findings(bad, e.withColumn("length", F.lit(2) + F.col("episode_index")), t.union(t), stats.where("episode_index = 0"), i.withColumn("total_frames", F.lit(9)), "compact_13d").collect()}
    assert got == {"index_not_sequential", "prompt_differs", "length_differs", "task_index_repeated", "stats_missing", "totals_differ"}
    lost = exportcheck.dataset_findings(f, e.withColumn("episode_index", F.col("episode_index") * 2).withColumn("task_index", F.lit(5)), t, None, i, "compact_13d")
    assert {"episode_unknown", "task_unknown", "episode_index_not_sequential", "task_index_differs"} <= {r["rule_id"] for r in lost.collect()}


def test_samples_chunks_and_attempts(spark):
    f, e, _, _ = dataset(spark)
    assert exportcheck.sample(f, 1, 1).first()["index"] == 3
    with pytest.raises(IndexError):
        exportcheck.sample(f, 1, 2)
    with pytest.raises(ValueError):
        exportcheck.union_of_episodes([("a", f), ("a", f)])
    assert exportcheck.union_of_episodes([("a", f), ("b", f)]).groupBy("source").count().count() == 2
    c = exportcheck.exported_chunk(f, 3).where("episode_index = 1 and frame_index = 1").first()
    assert (c["valid"], c["padded"], len(c["chunk"])) == (1, 2, 3)
    status = spark.createDataFrame([(0, "data/chunk-000/episode_000000.parquet", 2, None), (1, "elsewhere", 1, None)], "episode_index long, path string, frames long, error string")
    more = e.union(spark.createDataFrame([(2, 0, 2)], e.schema))
    assert sorted((r["episode_id"], r["rule_id"]) for r in exportcheck.attempt_findings(status, more).collect()) == [("1", "frames_differ"), ("1", "path_wrong"), ("2", "episode_missing")]
    assert exportcheck.attempt_findings(status, e, dry_run=True).count() == 2 and exportcheck.preflight(True, {"parquet": True, "video": False}) == {"structural": True, "real_export_ready": True, "video_export_ready": False}
    o = f.select(F.col("state").alias("observation.state"), "action", "task", F.lit(None).cast("string").alias("prompt"), "frame_index", F.lit("e").alias("episode_id"))
    assert {r["rule_id"] for r in exportcheck.observation_findings(o, "compact_13d").collect()} == {"prompt_empty"}
