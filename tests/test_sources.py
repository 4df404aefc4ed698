import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.operators import dataset, fixtures, rules
from tracewright.sources import media, readers, sinks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_strict_lines(spark, tmp_path):
    p = write(tmp_path / "s.jsonl", '{"a": 1}\n\n[1]\n{"a": \n{"a": NaN}\n{"b": {"c": 2}}\n')
    got = [(r["line_no"], r["error"]) for r in readers.strict_jsonl(spark, p).orderBy("line_no").select("line_no", "error").collect()]
    assert got == [(1, None), (2, "blank line"), (3, "not an object"), (4, "not valid JSON"), (5, "not valid JSON"), (6, None)]


def test_lenient_lines_and_one_record(spark, tmp_path):
    p = write(tmp_path / "l.jsonl", '{"a": 1}\n\n{"a": "x"}\n')
    df = readers.lenient_jsonl(spark, p, T.StructType.fromDDL("a long"))
    assert [r["a"] for r in readers.one_record(df, "it").collect()] == [1]
    with pytest.raises(ValueError):
        readers.one_record(df.unionByName(df), "it")


def test_json_object(spark, tmp_path):
    write(tmp_path / "j" / "a.json", '{"fps": 30}')
    write(tmp_path / "j" / "b.json", "[]")
    assert sorted(str(r["error"]) for r in readers.json_objects(spark, str(tmp_path / "j")).select("error").collect()) == ["None", "not an object"]


def test_csv_keeps_rows_in_order(spark, tmp_path):
    p = write(tmp_path / "c.csv", "timestamp,x\n0.0,1\n0.1,oops\n0.2,inf\n")
    df = readers.as_numbers(readers.csv_rows(spark, p, ["timestamp", "x"]), ["timestamp", "x"])
    assert [(r["row"], r["x"]) for r in df.orderBy("row").collect()] == [(0, 1.0), (1, None), (2, None)]


def test_stream_path(spark):
    df = spark.createDataFrame([("tf", None), ("tf", "../x"), ("tf", "a/b.jsonl"), ("odd", None)], "s string, p string")
    assert [r[0] for r in df.select(readers.stream_path(F.col("s"), F.col("p"))).collect()] == ["streams/tf.jsonl", None, "a/b.jsonl", "streams/odd.jsonl"]


def test_images(spark, tmp_path):
    write(tmp_path / "img" / "a.ppm", "P3")
    write(tmp_path / "img" / "b.ppm", "")
    f = spark.createDataFrame([("img/a.ppm",), ("img/b.ppm",), ("img/c.ppm",), (None,)], "p string")
    s = readers.image_status(f, readers.images(spark, str(tmp_path)), "p", str(tmp_path))
    assert sorted((str(r["p"]), r["p_status"]) for r in s.collect()) == [("None", "unnamed"), ("img/a.ppm", "ok"), ("img/b.ppm", "absent"), ("img/c.ppm", "absent")]


def test_output_checks(tmp_path):
    (tmp_path / "in" / "out").mkdir(parents=True)
    with pytest.raises(ValueError):
        sinks.check_output(str(tmp_path / "in" / "out"), str(tmp_path / "in"), True)
    with pytest.raises(FileExistsError):
        sinks.check_output(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        sinks.check_output(os.getcwd(), None, True)
    sinks.check_output(str(tmp_path / "new"))


def test_episode_files_and_report(spark, tmp_path):
    f = fixtures.plain_poses(spark).select(F.lit(3).cast("long").alias("episode_index"), F.lit("data/chunk-000/episode_000003.parquet").alias("path"), "frame_index", "timestamp")
    status = sinks.write_episode_files(f, str(tmp_path), ["frame_index", "timestamp"])
    status = spark.createDataFrame(status.collect(), status.schema)
    r = sinks.attempt_report(status, 1).first()
    assert (r["episodes"], r["frames"], r["success"]) == (1, 20, True)
    import pyarrow.parquet as pq

    assert pq.read_table(tmp_path / "data/chunk-000/episode_000003.parquet")["frame_index"].to_pylist() == list(range(20))


def test_documents_and_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    sinks.write_document(df, str(tmp_path / "d.json"))
    assert json.loads((tmp_path / "d.json").read_text()) == {"a": 1}
    sinks.write_lines(df, str(tmp_path / "lines"))
    assert "null" in "".join(p.read_text() for p in (tmp_path / "lines").glob("*.json"))


def test_staging(spark, tmp_path):
    write(tmp_path / "in" / "x.jpg", "i")
    f = spark.createDataFrame([("e", 4, "x.jpg")], "episode_id string, ordinal long, p string")
    pairs = sinks.staged_images(f, "observation.image", "p")
    assert [r["error"] for r in sinks.stage_images(pairs, str(tmp_path / "in"), str(tmp_path / "out"), "copy").collect()] == [None]
    assert (tmp_path / "out/image_staging/observation.image/e/000004.jpg").read_text() == "i"


def test_media_report():
    assert media.readiness({"pyarrow": True, "cv2": True}) == {"parquet": True, "video": True, "encoder": "cv2", "decode_images": False, "decode_video": False}


def test_fixtures_obey_the_rules(spark):
    r = fixtures.robot_stream(spark).withColumn("state_row_id", F.col("record_index")).withColumn("source_stamp", F.col("source_stamp").cast("string"))
    for c in ("measured_tcp_wrench", "external_tcp_force", "raw_force_torque"):
        r = r.withColumn(c, F.lit(None).cast("array<double>"))
    assert rules.findings(r, rules.robot_rules(), "state_row_id").count() == 0
    with pytest.raises(ValueError):
        fixtures.plain_poses(spark, 1)
    assert fixtures.event_log(spark).count() == 4
    assert fixtures.plain_wrench(spark).orderBy(F.desc("frame_index")).first()["wrench"][2] == pytest.approx(12.0)


def test_dataset_of_two_episodes(spark, tmp_path):
    f = spark.range(38).select(
        F.col("id").alias("frame_row_id"), F.format_string("episode_%06d", (F.col("id") / 19).cast("int")).alias("episode_id"), (F.col("id") % 19).alias("frame_index"),
        (F.col("id") / 30.0).alias("timestamp"), F.array_repeat(F.lit(0.5), 25).alias("model_state"), F.array_repeat(F.lit(0.0), 7).alias("measured_action"),
    )
    e = dataset.episode_table(f)
    g = dataset.global_index(f, e).orderBy("global_index").collect()
    assert [r["global_index"] for r in g] == list(range(38)) and g[19]["ordinal"] == 0
    dataset.write_dataset(f, e, str(tmp_path / "ds"))
    back = spark.read.parquet(str(tmp_path / "ds"))
    assert back.count() == 38 and dict(back.dtypes)["observation.state"] == "array<float>"
    with pytest.raises(Exception):
        dataset.write_dataset(f, e, str(tmp_path / "ds"))


MUTATIONS = [
    ("fps", "0.0D", "fps_invalid"),
    ("task_instruction", "'  '", "task_instruction_empty"),
    ("success", "cast(null as boolean)", "success_missing"),
    ("success", "false", "failure_reason_missing"),
    ("schema_version", "'v9'", "schema_version_unknown"),
    ("operator_id", "'TBD later'", "operator_unknown"),
]


@pytest.mark.parametrize("column, value, rule", MUTATIONS)
def test_each_rule_sees_its_mutation(spark, column, value, rule):
    good = dict(schema_version="raw_real_v0", episode_id="e", task_instruction="t", geometry_type="g", orientation_type="o", collection_method="c", action_label_primary="a", robot_type="r", recorder_version="v", success=True, failure_reason=None, fps=30.0, operator_id="op_1", meta_row_id=1)
    schema = "schema_version string, episode_id string, task_instruction string, geometry_type string, orientation_type string, collection_method string, action_label_primary string, robot_type string, recorder_version string, success boolean, failure_reason string, fps double, operator_id string, meta_row_id long"
    df = spark.createDataFrame([tuple(good[c.split()[0]] for c in schema.split(", "))], schema)
    assert rules.findings(df, rules.metadata_rules(), "meta_row_id").count() == 0
    f = rules.findings(df.withColumn(column, F.expr(value)), rules.metadata_rules(), "meta_row_id")
    assert [r["rule_id"] for r in f.collect()] == [rule]
    if rule != "operator_unknown":
        with pytest.raises(rules.GateClosed):
            rules.gate(f)
