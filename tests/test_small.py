import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import actions, dataset
from tracewright.sources import readers, sinks


def test_debug_chunks(spark):
    df = spark.range(1).select(F.array(F.lit(1.0)).alias("a"))
    one = lambda mode: df.select(actions.debug_chunk(F.col("a"), 3, mode).alias("c")).first()["c"]
    assert one("single") == [[1.0]] and one("repeat") == [[1.0]] * 3
    with pytest.raises(ValueError):
        actions.debug_chunk(F.col("a"), 3, "future")


def test_task_of(spark):
    df = spark.createDataFrame([("own", "ep", True), (None, "ep", True), (None, "ep", False), (" ", "ep", True)], "own string, ep string, has boolean")
    assert [r[0] for r in df.select(dataset.task_of(F.col("own"), F.col("ep"), F.col("has"))).collect()] == ["own", None, "ep", None]


def test_data_paths_and_exported_actions(spark, tmp_path):
    paths = readers.data_paths(str(tmp_path), "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", [0, 1001], 0)
    assert [p[len(str(tmp_path)) + 1 :] for p in paths] == ["data/chunk-000/episode_000000.parquet", "data/chunk-001/episode_001001.parquet"]
    for p in paths:
        spark.range(2).select(F.array(F.col("id").cast("float")).alias("action"), F.lit("x").alias("task")).coalesce(1).write.parquet(p)
    got = readers.exported_actions(spark, paths)
    assert got.columns == ["action"] and got.count() == 4


def test_side_file(spark):
    main, side = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", 1)], "k string, v long")
    assert sorted((r["k"], r["v"]) for r in readers.side_file(main, side, ["k"]).collect()) == [("a", 1), ("b", None)]


def test_adapted_info():
    info = {"features": {"i": {"dtype": "image"}, "s": {"dtype": "float32"}}, "data_path": "x"}
    a = sinks.adapted_info(info, "parquet")
    assert a["data_path"].endswith(".parquet") and a["features"]["i"]["dtype"] == "video" and info["features"]["i"]["dtype"] == "image"
    assert sinks.adapted_info(info, "jsonl")["data_path"].endswith(".jsonl.placeholder")


def test_write_csv(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([(1, "a")], "i long, s string"), str(tmp_path / "c"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == [("1", "a")]


def test_numbers_of_lines_over_blocks(spark, tmp_path):
    """Files read in many blocks keep their line numbers."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for k in range(3):
        (tmp_path / f"{k}.jsonl").write_text("".join(json.dumps({"i": i}) + "\n" if i % 7 else "\n" for i in range(500 * (k + 1))))
        (tmp_path / f"{k}.csv").write_text("a,b\n" + "".join(f"{i},{k}\n" for i in range(700)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        t = readers.strict_jsonl(spark, [str(tmp_path / f"{k}.jsonl") for k in range(3)])
        assert t.rdd.getNumPartitions() > 3
        rows = t.select("path", "line_no", F.try_variant_get("v", "$.i", "long").alias("i"), "error").collect()
        c = readers.csv_rows(spark, [str(tmp_path / f"{k}.csv") for k in range(3)], ["a", "b"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 3000 and all(r["i"] == r["line_no"] - 1 if (r["line_no"] - 1) % 7 else r["error"] == "blank line" for r in rows)
    assert len(c) == 2100 and all(int(r["a"]) == r["row"] for r in c)


def test_camera_index_files(spark, tmp_path):
    for s in ("tcp_camera", "wrist_camera"):
        (tmp_path / s).mkdir()
        (tmp_path / s / "index.jsonl").write_text('{"record_index": 0}\n[1]\n')
    got = sorted((r["stream_name"], r["line_no"], r["error"]) for r in readers.index_jsonl(spark, str(tmp_path), ["tcp_camera", "wrist_camera"]).collect())
    assert got == [("tcp_camera", 1, None), ("tcp_camera", 2, "not an object"), ("wrist_camera", 1, None), ("wrist_camera", 2, "not an object")]


def test_stream_paths(spark):
    df = spark.createDataFrame([("tf", None), ("laser", None), ("laser", "x/y.jsonl"), ("laser", "../y"), ("a/../../b", " ")], "s string, p string")
    assert [r[0] for r in df.select(readers.stream_path(F.col("s"), F.col("p"))).collect()] == ["streams/tf.jsonl", "streams/laser.jsonl", "x/y.jsonl", None, None]


def test_image_status_with_two_roots(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "r").mkdir()
    (tmp_path / "p" / "a.jpg").write_bytes(b"x")
    (tmp_path / "p" / "e.jpg").write_bytes(b"")
    (tmp_path / "r" / "b.jpg").write_bytes(b"x")
    listed = readers.images(spark, str(tmp_path))
    files = listed.unionByName(spark.createDataFrame([(str(tmp_path / "p" / "e.jpg"), 0)], "path string, length long"))
    f = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("c.jpg",), ("e.jpg",), (None,), (str(tmp_path / "r" / "b.jpg"),)], "img string")
    rows = readers.image_status(f, files, "img", str(tmp_path / "p"), str(tmp_path / "r")).collect()
    got = {r["img"]: (r["img_status"], (r["img_resolved"] or "")[-7:]) for r in rows}
    assert got["a.jpg"] == ("ok", "p/a.jpg") and got["b.jpg"] == ("ok", "r/b.jpg") and got["c.jpg"][0] == "absent" and got["e.jpg"][0] == "empty" and got[None][0] == "unnamed"


@pytest.mark.parametrize("ids", [["a10", "a1000", "a2"], ["x", "y" * 40, "é", "B", "b"], [f"{i}" for i in range(300)]])
def test_episodes_keep_the_order_of_their_ids(spark, ids):
    f = spark.createDataFrame([(e, i) for e in ids for i in range(2)], "episode_id string, frame_index long")
    rows = dataset.episode_table(f).orderBy("episode_index").collect()
    assert [r["episode_id"] for r in rows] == sorted(ids, key=lambda x: x.encode())
    assert [r["offset"] for r in rows] == [2 * i for i in range(len(ids))]
