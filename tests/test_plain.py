import json
import os

import pytest

from tracewright import session
from tracewright.__main__ import main
from tracewright.operators import plainrules


def rows_of(df):
    return sorted((r["episode_id"], r["rule_id"], r["row_id"] if r["row_id"] is not None else -1) for r in df.collect())


def test_tables_of_plain_recordings(spark):
    e = spark.createDataFrame([("a",), ("b",), ("c",)], "episode_id string")
    cols = plainrules.COLUMNS["wrench"]
    cell = lambda ep, i, t, **k: {"episode_id": ep, "row": i, **{c: "1.5" for c in cols}, "timestamp": t, **k}
    data = [cell("a", 0, "0.0"), cell("a", 1, "0.1"), cell("b", 0, "0.5"), cell("b", 1, "0.5"), cell("b", 2, "0.4"), cell("b", 3, "x", fx="nan", ty=None)]
    df = spark.createDataFrame(data, "episode_id string, row long, " + ", ".join(f"{c} string" for c in cols))
    got = rows_of(plainrules.table_findings("wrench", df, e))
    assert got == [("b", "cell_not_finite", 5), ("b", "cell_not_finite", 5), ("b", "cell_not_finite", 5), ("b", "timestamp_not_increasing", 3), ("c", "no_rows", -1)]
    short = rows_of(plainrules.table_findings("wrench", df.drop("tz"), e))
    assert [x for x in short if x[1] == "columns_missing"] == [(k, "columns_missing", -1) for k in "abc"]
    ev = spark.createDataFrame([("a", 0, "0.0", "start"), ("b", 0, "1e400", "start"), ("c", 0, "1", None)], "episode_id string, row long, timestamp string, event string")
    assert rows_of(plainrules.table_findings("events", ev, e)) == [("b", "cell_not_finite", 2), ("b", "timestamp_not_increasing", 2)]


def test_metadata_documents(spark):
    doc = lambda **k: json.dumps({"fps": 30, "success": True, "task": "t", **k})
    d = spark.createDataFrame([("a", doc()), ("b", doc(fps="25.0")), ("c", doc(fps=0, success="yes")), ("d", "[1]"), ("e", None), ("f", "{}"), ("g", "{broken")], "episode_id string, metadata string")
    got = rows_of(plainrules.metadata_findings(d, ["fps", "success", "task"]))
    assert got == [("c", "fps_invalid", -1), ("c", "success_invalid", -1), ("d", "not_an_object", -1), ("e", "not_an_object", -1), ("f", "keys_missing", -1), ("g", "not_an_object", -1)]


def test_staged_tables_are_released(spark):
    s = session.Staged(spark.range(3), "x")
    path = s.path.replace("file:", "")
    assert os.path.isdir(path) and session.release(spark) >= 1 and not os.path.isdir(path)
    assert session.release(spark) == 0 and session.stage(spark.range(2), "y").count() == 2


@pytest.mark.parametrize("args, code", [(["list"], 0), (["dependencies"], 0), (["nonsense"], 1), ([], 0)])
def test_commands(spark, capsys, args, code):
    assert main(args) == code
    out = capsys.readouterr()
    assert out.out or out.err


def test_commands_over_tables(spark, sf, capsys, tmp_path):
    assert main(["validate", sf]) == 1
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {"layer", "rule_id", "severity", "n"} <= set(lines[0])
    assert main(["run", "fps_consistency", sf, str(tmp_path / "o")]) == 0 and spark.read.parquet(str(tmp_path / "o")).count() > 0
    assert main(["inspect", sf, "episode_000000"]) == 1 and main(["plan", sf]) == 1
