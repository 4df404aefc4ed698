"""Rules of plain recordings: five tables of text cells and a metadata document an episode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.stamps import finite
from tracewright.operators.actions import with_last_valid
from tracewright.operators.exportcheck import missing_keys
from tracewright.operators.readiness import _found, union

# --- fixed values: columns of the tables ------------------------------------------------
COLUMNS = {
    "tcp_pose": ["timestamp", "x", "y", "z", "qx", "qy", "qz", "qw"],
    "joint_states": ["timestamp", *(f"joint_pos_{i}" for i in range(6)), *(f"joint_vel_{i}" for i in range(6))],
    "wrench": ["timestamp", "fx", "fy", "fz", "tx", "ty", "tz"],
    "events": ["timestamp", "event"],
    "commanded_twist": ["timestamp", "vx", "vy", "vz", "wx", "wy", "wz", "gripper_velocity"],
}
REQUIRED_TABLES = ["tcp_pose", "joint_states", "wrench", "events"]
# --- end of the fixed values ------------------------------------------------------------


def table_findings(name: str, rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Findings of one table of all episodes: ``rows`` has episode_id, row (0-based) and the
    cells as texts; ``episodes`` the ids that must have rows. Row numbers count the header, as
    an editor shows them. Of a stamp that does not increase only the first of an episode is told;
    what comes after it proves nothing."""
    lack = [c for c in COLUMNS[name] if c not in rows.columns]
    ids = episodes.select("episode_id").distinct()
    parts = [_found(ids.join(rows.select("episode_id").distinct(), "episode_id", "left_anti"), name, "no_rows", "error", None, "the table has no rows")]
    if lack:
        parts.append(_found(ids, name, "columns_missing", "error", None, f"missing columns: {', '.join(lack)}"))
    numeric = [c for c in COLUMNS[name] if c != "event" and c in rows.columns]
    if name == "tcp_pose" and "gripper_pos" in rows.columns:
        numeric.append("gripper_pos")
    at = F.col("row") + 2
    n = {c: F.col(c).try_cast("double") for c in numeric}
    bad = F.array_compact(F.array(*(F.when(x.isNull() | ~finite(x), F.lit(c)) for c, x in n.items())))
    cells = rows.select("episode_id", at.alias("at"), F.explode(bad).alias("cell"))
    parts.append(_found(cells, name, "cell_not_finite", "error", F.col("at"), F.concat("cell", F.lit(" must be a finite number"))))
    if "timestamp" in rows.columns:
        t = rows.select("episode_id", "row", F.when(finite(n["timestamp"]), n["timestamp"]).alias("t"))
        w = with_last_valid(t, "episode_id", "row", ["t"])
        first = w.where(F.col("t").isNull() | (F.col("t") <= F.col("last_t"))).groupBy("episode_id").agg(F.min("row").alias("row"))
        parts.append(_found(first, name, "timestamp_not_increasing", "error", at, "timestamps must strictly increase"))
    return union(parts)


def metadata_findings(documents: DataFrame, required: list[str], column: str = "metadata") -> DataFrame:
    """Findings of the metadata documents (episode_id and a JSON text): an object with the
    required keys, fps a positive number (a text of one will do), success a boolean."""
    v = F.try_parse_json(F.col(column))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    fps = F.get_json_object(F.col(column), "$.fps").try_cast("double")
    d = documents.select(
        "episode_id", is_object.alias("whole"), missing_keys(F.col(column), required).alias("lack"), F.json_object_keys(F.col(column)).alias("keys"),
        (finite(fps) & (fps > 0)).alias("fps_ok"), (F.schema_of_variant(F.try_variant_get(v, "$.success", "variant")) == "BOOLEAN").alias("success_ok"),
    )
    has = lambda k: F.coalesce(F.array_contains("keys", k), F.lit(False))
    return union([
        _found(d.where(~F.col("whole")), "metadata", "not_an_object", "error", None, "metadata must be a JSON object"),
        _found(d.where(F.col("whole") & (F.size("lack") > 0)), "metadata", "keys_missing", "error", None, F.concat(F.lit("missing keys: "), F.array_join("lack", ", "))),
        _found(d.where(F.col("whole") & has("fps") & ~F.coalesce("fps_ok", F.lit(False))), "metadata", "fps_invalid", "error", None, "fps must be a positive finite number"),
        _found(d.where(F.col("whole") & has("success") & ~F.coalesce("success_ok", F.lit(False))), "metadata", "success_invalid", "error", None, "success must be a boolean"),
    ])
