import json
import os

from tracewright.streaming import live


def feed(path, name, rows, at=1_700_000_000):
    """A file that arrived at ``at``: the source takes files by the time of their last change."""
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    os.utime(path / name, (at, at))


def rec(e, k, x, last=False):
    return {"episode_id": e, "record_index": k, "event_time": f"2025-01-01T00:00:{k:02d}Z", "position": [x, 0.0, 0.0], "gripper": 0.1 * k, "last": last}


def test_steps_come_as_records_arrive(spark, tmp_path):
    feed(tmp_path / "in", "a.jsonl", [rec("a", 0, 0.0), rec("a", 1, 0.5), rec("b", 0, 1.0)])
    feed(tmp_path / "in", "b.jsonl", [rec("a", 2, 1.5, True), rec("a", 1, 0.5), rec("b", 1, 0.0)], 1_700_000_060)
    q = live.live_steps(live.read_lines(spark, str(tmp_path / "in"), files_per_trigger=1)).writeStream.format("memory").queryName("steps").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    got = {(r["episode_id"], r["record_index"]): (r["dx"], r["terminal"]) for r in spark.table("steps").collect()}
    assert got == {("a", 0): (0.5, False), ("a", 1): (1.0, False), ("a", 2): (0.0, True), ("b", 0): (-1.0, False)}


def test_windowed_counts_plan(spark, tmp_path):
    feed(tmp_path / "w", "a.jsonl", [rec("a", k, 0.0) for k in range(30)])
    q = live.windowed_counts(live.read_lines(spark, str(tmp_path / "w")), width="10 seconds").writeStream.format("memory").queryName("counts").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert sum(r["n"] for r in spark.table("counts").collect()) == 30
