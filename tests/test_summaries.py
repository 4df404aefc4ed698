from pyspark.sql import functions as F

from tracewright.functions import labels as L
from tracewright.operators import align, cameras, dataset, rollups


def test_first_few_needs_no_whole_group(spark):
    df = spark.range(20000).select(F.lit("g").alias("g"), (F.col("id") * 3).alias("k"))
    assert align.first_few(df, ["g"], "k").first()["first"] == ",".join(str(3 * i) for i in range(10))


def test_tolerance(spark):
    cases = [(30.0, None, 1 / 60), (None, None, 0.02), (30.0, 0.055, 0.055), (30.0, 0.08, 1 / 60), (None, 0.1, 0.1)]
    df = spark.createDataFrame([(f, o, w) for f, o, w in cases], "f double, o double, w double")
    assert df.where(F.abs(align.tolerance(F.col("f"), F.col("o")) - F.col("w")) > 1e-12).count() == 0


def test_camera_views(spark):
    s = spark.createDataFrame([("a", "tcp_camera", "camera", None), ("a", "external_camera_1", "camera", "external"), ("b", "external_camera_1", "camera", None), ("b", "external_camera_2", "camera", None), ("c", "tf", "x", None)], "episode_id string, stream_name string, kind string, role string")
    got = {(r["episode_id"], r["view"]): (r["stream_name"], r["error"]) for r in cameras.select_views(s).collect()}
    assert got[("a", "tcp")] == ("tcp_camera", None) and got[("b", "external")] == (None, "multiple candidates") and got[("c", "tcp")] == (None, "no camera stream")
    s = s.unionByName(spark.createDataFrame([("a", "wrist_camera", "camera", None)], s.schema))
    e = spark.createDataFrame([("b", "external", "external_camera_2", 1), ("a", "tcp", "tcp_camera", 1), ("a", "tcp", "wrist_camera", 1), ("a", "external", "x", 1)], "episode_id string, view string, stream_name string, rank int")
    got = {(r["episode_id"], r["view"]): (r["stream_name"], r["source"], r["error"]) for r in cameras.select_views(s, e).collect()}
    assert got[("b", "external")] == ("external_camera_2", "explicit", None) and got[("a", "tcp")][2] == "conflicting assignments" and got[("a", "external")][2] == "assignment names no camera stream"


def test_labels(spark):
    df = spark.createDataFrame([(" To-Do ",), ("un set",), ("N/A",), (None,), ("", ), ("lab 3",), ("TBD-later",)], "x string")
    assert [r[0] for r in df.select(L.is_unknown(F.col("x"))).collect()] == [False, False, True, True, True, False, True]
    p = spark.createDataFrame([("a/b",), ("/a",), ("a/../b",), (" ",), (None,), ("a..b",)], "x string")
    assert [r[0] for r in p.select(L.safe_path(F.col("x"))).collect()] == [True, False, False, False, False, True]
    g = spark.createDataFrame([("synthetic_gripper_state",), ("my pipeline-smoke gripper",), ("jaw_01",), (None,)], "x string")
    assert [r[0] for r in g.select(L.is_placeholder_gripper(F.col("x"))).collect()] == [True, True, False, False]


def test_backends_and_paths(spark):
    df = spark.createDataFrame([([],), (["a", None, "a"],), (["a", "b"],)], "n array<string>")
    assert [r[0] for r in df.select(rollups.backend_summary(F.col("n"))).collect()] == ["none", "a", "mixed"]
    e = spark.range(1).select(dataset.data_path(F.lit(1234).cast("long")).alias("p"), dataset.data_path(F.lit(7).cast("long"), chunk_size=0).alias("q")).first()
    assert (e["p"], e["q"]) == ("data/chunk-001/episode_001234.parquet", "data/chunk-000/episode_000007.parquet")


def test_tasks_by_first_appearance(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "b"), (4, " "), (5, None)], "k long, task string")
    assert {r["task"]: r["task_index"] for r in dataset.task_dictionary(df, "k").collect()} == {"a": 0, "b": 1}
