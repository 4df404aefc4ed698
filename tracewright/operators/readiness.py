"""Is an episode ready to be converted: rules that look at several tables together.

Each function gives findings (layer, rule_id, severity, episode_id, row_id, message), the form
of ``rules.findings``, so layers are put together by union. Rules of what an episode's own
documents say (calibration, provenance, timebase) take a table of one row an episode with the
documents as JSON text columns; a column that is not there counts as absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import labels as L
from tracewright.functions.stamps import finite, finite_vector
from tracewright.functions.vectors import WRENCH_ORDER, first_valid
from tracewright.operators import align, cameras, convert
from tracewright.operators.actions import with_last_valid

# --- fixed values: what documents must hold ---------------------------------------------
REFERENCE_ID_KEYS = ["id", "calibration_id", "reference_id", "ref", "reference", "name"]
CALIBRATIONS = ["tcp_tool_calibration", "force_torque_calibration"]
WORKSPACE_KEYS = ["path", "git_commit", "git_remote", "git_branch"]
WRENCH_FRAMES = ["base", "base_frame", "flange", "flange_frame", "tcp", "tcp_frame", "tool", "tool_frame"]
WRENCH_AXES = '["Fx","Fy","Fz","Tx","Ty","Tz"]'
TRANSFORM_FRAMES = ["parent_frame", "child_frame"]
# --- end of the fixed values ------------------------------------------------------------


def _found(df: DataFrame, layer: str, rule: str, severity: str, row: Column | None, message: Column | str) -> DataFrame:
    m = F.lit(message) if isinstance(message, str) else message
    return df.select(F.lit(layer).alias("layer"), F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), "episode_id", (row if row is not None else F.lit(None)).cast("long").alias("row_id"), m.alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- order within streams ----------------------------------------------------------------
def sequence_findings(df: DataFrame, layer: str, row_id: str, stamps: dict[str, Column]) -> DataFrame:
    """Record indexes that do not count up from 0 in file order (row ids), and stamps lower
    than the last valid one before them. File order is cut into stretches, so episodes spread."""
    s = df.select("episode_id", F.col(row_id).alias("__row"), "record_index", *(F.when(finite(c), c).alias(k) for k, c in stamps.items()))
    w = with_last_valid(s, "episode_id", "__row", list(stamps))
    parts = [_found(w.where(F.col(k) < F.col(f"last_{k}")), layer, f"{k}_falls", "error", F.col("__row"), f"{k} must not fall") for k in stamps]
    order = positions(s, "episode_id", "__row")
    parts.append(_found(order.where(~F.col("record_index").eqNullSafe(F.col("place"))), layer, "record_index_not_sequential", "error", F.col("__row"), "record_index must count up from 0"))
    return union(parts)


def positions(df: DataFrame, group: str, index: str, length: int = 8192) -> DataFrame:
    """Adds ``place``: how many rows of the group come before in the order of ``index``.
    Stretches of the index are counted first, so no task sorts a group."""
    from pyspark.sql import Window

    s = df.withColumn("__stretch", F.floor(F.col(index) / length))
    n = s.groupBy(group, "__stretch").count()
    n = n.withColumn("__past", F.coalesce(F.sum("count").over(Window.partitionBy(group).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    at = F.row_number().over(Window.partitionBy(group, "__stretch").orderBy(index)) - 1
    return s.withColumn("__at", at).join(n, [group, "__stretch"]).withColumn("place", (F.col("__past") + F.col("__at")).cast("long")).drop("__stretch", "__at", "__past")


# --- stamps of several streams ------------------------------------------------------------
def stamp_mismatches(robot: DataFrame, streams: DataFrame, tol: DataFrame) -> DataFrame:
    """Warnings: stamps that differ from the robot's at the same record index by more than the
    tolerance; at most one a stream and record, the source stamp before the receipt stamp.
    ``robot``: episode_id, record_index, source, receipt; ``streams``: those and stream;
    ``tol``: episode_id, tol (0.02 s where there is none)."""
    key = ["episode_id", "record_index"]
    r = robot.select(*key, F.col("source").alias("r_source"), F.col("receipt").alias("r_receipt"))
    j = streams.join(r, key).join(tol.select("episode_id", "tol"), "episode_id", "left").withColumn("tol", F.coalesce("tol", F.lit(0.02)))
    off = {k: F.abs(F.col(k) - F.col(f"r_{k}")) for k in ("source", "receipt")}
    over = lambda k: F.coalesce(finite(F.col(k)) & finite(F.col(f"r_{k}")) & (off[k] > F.col("tol")), F.lit(False))
    which = F.when(over("source"), "source_stamp").when(over("receipt"), "receipt_stamp")
    return j.select(*key, "stream", which.alias("stamp_key"), F.when(over("source"), off["source"]).when(over("receipt"), off["receipt"]).alias("offset")).where("stamp_key is not null")


# --- units, orientation, wrench, gripper --------------------------------------------------
def unit_findings(robot: DataFrame, joints: DataFrame, streams_index: DataFrame) -> DataFrame:
    """Records whose pose or joints state no unit that can be converted."""
    known = {
        "tcp_position": convert.MILLIMETRES + convert.METRES, "tcp_orientation": convert.DEGREES + convert.RADIANS,
        "joint_position": convert.DEGREES + convert.RADIANS, "joint_velocity": convert.DEGREE_RATES + convert.RADIAN_RATES,
    }
    parts = []
    for df, stream, row, quantities in ((robot, "robot_state_rt", "state_row_id", ("tcp_position", "tcp_orientation")), (joints, "joint_states", "joint_row_id", ("joint_position", "joint_velocity"))):
        r = convert.with_entry(df.select("episode_id", row, "units"), streams_index, stream)
        bad = [F.when(~F.coalesce(convert.merged_unit(F.col("units"), F.col("entry_units"), q).isin(known[q]), F.lit(False)), F.lit(q)) for q in quantities]
        hits = r.select("episode_id", row, F.explode(F.array_compact(F.array(*bad))).alias("q"))
        parts.append(hits.select(F.lit("readiness").alias("layer"), F.concat("q", F.lit("_unit")).alias("rule_id"), F.lit("error").alias("severity"), "episode_id", F.col(row).cast("long").alias("row_id"), F.concat(F.lit("unsupported or missing unit of "), "q").alias("message")))
    return union(parts)


def wrench_sources(robot: DataFrame) -> DataFrame:
    """(episode_id, source, n, first_row): the wrench columns that states are built from."""
    _, source = first_valid(list(WRENCH_ORDER), 6)
    return robot.select("episode_id", "state_row_id", source.alias("source")).where("source is not null").groupBy("episode_id", "source").agg(F.count("*").alias("n"), F.min("state_row_id").alias("first_row"))


def ordered_sources(robot: DataFrame) -> DataFrame:
    """(episode_id, sources): the same, each once, in the order of their first record."""
    s = wrench_sources(robot).groupBy("episode_id").agg(F.sort_array(F.collect_list(F.struct("first_row", "source"))).alias("x"))
    return s.select("episode_id", F.transform("x", lambda r: r["source"]).alias("sources"))


def wrench_metadata_findings(robot: DataFrame, documents: DataFrame, column: str = "wrench_sources") -> DataFrame:
    """Selected wrench sources without approved metadata. ``documents``: episode_id and the
    robot entry's object of sources as JSON text."""
    j = wrench_sources(robot).join(documents.select("episode_id", F.col(column).alias("doc")), "episode_id", "left")
    m = F.try_element_at(F.from_json("doc", "map<string,string>"), F.col("source"))
    get = lambda k: F.get_json_object(m, f"$.{k}")
    wrong = F.array_compact(F.array(
        F.when(m.isNull(), "missing"), F.when(m.isNotNull() & ~F.coalesce(F.regexp_replace(get("order"), r"\s", "") == WRENCH_AXES, F.lit(False)), "order"),
        F.when(m.isNotNull() & ~F.coalesce(get("force_unit") == "N", F.lit(False)), "force_unit"), F.when(m.isNotNull() & ~F.coalesce(get("torque_unit") == "Nm", F.lit(False)), "torque_unit"),
        F.when(m.isNotNull() & ~F.coalesce(get("frame").isin(WRENCH_FRAMES), F.lit(False)), "frame"), F.when(m.isNotNull() & ~F.coalesce(get("approved_for_model_state") == "true", F.lit(False)), "approved_for_model_state"),
    ))
    hits = j.select("episode_id", "source", "first_row", F.explode(wrong).alias("what"))
    return _found(hits, "readiness", "wrench_metadata", "error", F.col("first_row"), F.concat(F.lit("wrench metadata of "), "source", F.lit(": "), "what"))


def gripper_findings(robot: DataFrame, gripper: DataFrame, streams_index: DataFrame) -> DataFrame:
    """Episodes without a gripper stream, with a placeholder for one (the first five sources are
    named), with other record indexes than the robot's, and records without a finite value."""
    key = ["episode_id", "record_index"]
    episodes = robot.select("episode_id").distinct()
    none = episodes.join(gripper.select("episode_id").distinct(), "episode_id", "left_anti")
    e = streams_index.where("stream_name = 'gripper_state'")
    named = e.select("episode_id", F.explode(F.array_compact(F.array(*(F.when(L.is_placeholder_gripper(F.col(k)), F.concat(F.lit(f"{k}="), F.col(k))) for k in ("source_name", "source_type"))))).alias("what"))
    flagged = gripper.where(F.coalesce("placeholder", F.lit(False))).select("episode_id", F.lit("placeholder=true").alias("what"))
    first = named.unionByName(flagged).distinct().groupBy("episode_id").agg(F.slice(F.sort_array(F.collect_list("what")), 1, 5).alias("whats"))
    sets = convert.index_sets(robot, {"gripper_state": gripper.select(*key)}).where("not aligned")
    bare = gripper.where(convert.gripper_value(F.col("gripper_position"), F.col("gripper_width_m")).isNull())
    return union([
        _found(none, "readiness", "gripper_missing", "error", None, "gripper_state is required; it is never filled with zeros"),
        _found(first, "readiness", "gripper_placeholder", "error", None, F.array_join("whats", ", ")),
        _found(sets, "readiness", "gripper_indexes", "error", None, F.concat(F.lit("missing "), F.coalesce("first_missing", F.lit("")), F.lit("; extra "), F.coalesce("first_extra", F.lit("")))),
        _found(bare, "readiness", "gripper_value", "error", F.col("gripper_row_id"), "no finite gripper_position or gripper_width_m"),
    ])


def camera_findings(views: DataFrame, violations: DataFrame) -> DataFrame:
    """Views without one camera, and cameras whose stamps leave the tolerance."""
    return union([
        _found(views.where("error is not null"), "readiness", "camera_mapping", "error", None, F.concat("view", F.lit(": "), "error")),
        _found(violations, "readiness", "camera_sync", "error", F.col("record_index"), F.concat("stream_name", F.lit(": first offset beyond the tolerance"))),
    ])


# --- documents ----------------------------------------------------------------------------
def is_meaningful(ref: Column) -> Column:
    """A calibration reference that says something: a known text, or an object (JSON text) one
    of whose identifying keys does, however deep by such keys (two steps)."""
    inner = lambda c: reduce(lambda a, b: a | b, (~L.is_unknown(F.get_json_object(c, f"$.{k}")) for k in REFERENCE_ID_KEYS))
    deep = reduce(lambda a, b: a | b, (F.when(F.ltrim(F.get_json_object(ref, f"$.{k}")).startswith("{"), inner(F.get_json_object(ref, f"$.{k}"))).otherwise(~L.is_unknown(F.get_json_object(ref, f"$.{k}"))) for k in REFERENCE_ID_KEYS))
    return F.coalesce(F.when(F.ltrim(ref).startswith("{"), deep).otherwise(~L.is_unknown(ref)), F.lit(False))


def calibration_findings(documents: DataFrame, streams: DataFrame, column: str = "calibration_refs") -> DataFrame:
    """Missing or empty calibration references: tool, force sensor, and for each camera stream
    its intrinsics and extrinsics."""
    d = documents.select("episode_id", F.col(column).alias("doc"))
    cams = cameras.entries(streams).where("camera").select("episode_id", "stream_name").distinct()
    fixed = d.select("episode_id", F.explode(F.array(*(F.struct(F.lit(c).alias("path"), F.get_json_object("doc", f"$.{c}").alias("ref")) for c in CALIBRATIONS))).alias("x"))
    part = lambda k: F.struct(F.concat(F.lit(f"{k}."), "stream_name").alias("path"), F.try_element_at(F.from_json(F.get_json_object("doc", f"$.{k}"), "map<string,string>"), F.col("stream_name")).alias("ref"))
    by_camera = d.join(cams, "episode_id").select("episode_id", F.explode(F.array(part("camera_intrinsics"), part("camera_extrinsics"))).alias("x"))
    x = fixed.unionByName(by_camera).select("episode_id", "x.path", "x.ref")
    return _found(x.where(~is_meaningful(F.col("ref"))), "readiness", "calibration_reference", "error", None, F.concat("path", F.lit(" must be a known reference")))


def provenance_findings(documents: DataFrame, streams: DataFrame) -> DataFrame:
    """Documents with ``source_workspace`` and ``live_graph_verification`` (JSON texts): both
    verified, all their values known, every stream verified with a known source, every camera
    with a known topic."""
    w, g = F.col("source_workspace"), F.col("live_graph_verification")
    d = documents.select("episode_id", "source_workspace", "live_graph_verification")
    bad = F.array_compact(F.array(
        F.when(~F.coalesce(F.get_json_object(w, "$.verified") == "true", F.lit(False)), "source_workspace.verified"),
        *(F.when(L.is_unknown(F.get_json_object(w, f"$.{k}")), f"source_workspace.{k}") for k in WORKSPACE_KEYS),
        F.when(~F.coalesce(F.get_json_object(g, "$.time_sync_verified") == "true", F.lit(False)), "live_graph_verification.time_sync_verified"),
    ))
    own = _found(d.select("episode_id", F.explode(bad).alias("what")), "readiness", "provenance", "error", None, F.concat("what", F.lit(" must be known")))
    s = streams.where(~F.coalesce("verified", F.lit(False)) | L.is_unknown(F.col("source_name")))
    cams = cameras.entries(streams).where("camera").select("episode_id", "stream_name").distinct().join(d, "episode_id")
    topics = cams.where(L.is_unknown(cameras.topic_of(F.col("live_graph_verification"), F.col("stream_name"))))
    return union([
        own, _found(s, "readiness", "provenance_stream", "error", F.col("entry_id") if "entry_id" in streams.columns else None, F.concat("stream_name", F.lit(" must be verified, its source known"))),
        _found(topics, "readiness", "provenance_topic", "error", None, F.concat("stream_name", F.lit(": topic must be known"))),
    ])


def orientation_findings(documents: DataFrame, column: str = "tcp_orientation_convention") -> DataFrame:
    e = documents.select("episode_id", convert.convention_error(F.col(column)).alias("error"))
    return _found(e.where("error is not null"), "readiness", "orientation_convention", "error", None, F.col("error"))


def timebase_findings(records: DataFrame, documents: DataFrame, column: str = "timebase") -> DataFrame:
    """Episodes with source stamps that are plain numbers and a timebase not in seconds."""
    n = records.where(F.col("source_stamp").try_cast("double").isNotNull()).select("episode_id").distinct()
    d = documents.select("episode_id", F.get_json_object(F.col(column), "$.source_stamp_unit").alias("unit"))
    bad = n.join(d, "episode_id", "left").where(~F.coalesce(F.col("unit") == "seconds", F.lit(False)))
    return _found(bad, "readiness", "timebase", "error", None, "timebase.source_stamp_unit must be seconds")


# --- transforms and events ----------------------------------------------------------------
def transform_findings(tf: DataFrame) -> DataFrame:
    """Transforms (episode_id, row_id, transforms: array of struct parent_frame, child_frame,
    translation, rotation_xyzw) with nameless frames or vectors that are not finite."""
    t = tf.select("episode_id", "row_id", F.posexplode_outer("transforms").alias("at", "t"))
    bad = F.array_compact(F.array(
        F.when(F.col("at").isNull(), "transforms"), *(F.when(F.col("at").isNotNull() & ~L.non_empty(F.col(f"t.{k}")), k) for k in TRANSFORM_FRAMES),
        F.when(F.col("at").isNotNull() & ~F.coalesce(finite_vector(F.col("t.translation"), 3), F.lit(False)), "translation"),
        F.when(F.col("at").isNotNull() & ~F.coalesce(finite_vector(F.col("t.rotation_xyzw"), 4), F.lit(False)), "rotation_xyzw"),
    ))
    return _found(t.select("episode_id", "row_id", F.explode(bad).alias("what")), "tf", "transform_invalid", "error", F.col("row_id"), F.concat("what", F.lit(" is not valid")))


def event_findings(events: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Events (episode_id, row_id, timestamp, event) in file order: stamps finite and never
    falling, names given; warnings if the first is no start or the outcome is missing.
    ``outcomes``: episode_id, success of the episodes that must have events."""
    e = events.select("episode_id", F.col("row_id").alias("__row"), F.when(finite(F.col("timestamp")), F.col("timestamp")).alias("t"), "event")
    w = with_last_valid(e, "episode_id", "__row", ["t"])
    named = F.when(L.non_empty(F.col("event")), F.struct("__row", "event"))
    g = e.groupBy("episode_id").agg(F.min(named)["event"].alias("first"), F.bool_or(F.col("event") == "success").alias("won"), F.bool_or(F.lower("event").contains("fail")).alias("failed"))
    o = outcomes.join(g, "episode_id", "left")
    return union([
        _found(w.where("t is null"), "events", "timestamp_invalid", "error", F.col("__row"), "timestamp must be a finite number"),
        _found(w.where("t < last_t"), "events", "timestamp_falls", "error", F.col("__row"), "timestamp must not fall"),
        _found(w.where(~L.non_empty(F.col("event"))), "events", "event_empty", "error", F.col("__row"), "event must be a non-empty string"),
        _found(outcomes.select("episode_id").distinct().join(events.select("episode_id").distinct(), "episode_id", "left_anti"), "events", "events_missing", "error", None, "there must be one event at least"),
        _found(g.where("first is not null and first <> 'episode_start'"), "events", "start_missing", "warning", None, "the first event is not episode_start"),
        _found(o.where("first is not null and success and not coalesce(won, false)"), "events", "success_missing", "warning", None, "no success event"),
        _found(o.where("first is not null and not success and not coalesce(failed, false)"), "events", "failure_missing", "warning", None, "no failure event"),
    ])


# --- the inspector's verdict --------------------------------------------------------------
def inspection(findings: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode_id, errors, warnings, blockers, recommendations, schema_valid, conversion_ready,
    training_ready, status) of every episode. ``episodes``: episode_id, synthetic. Schema rules
    are those of every layer but ``readiness``; blockers are the distinct broken rules."""
    err = F.col("severity") == "error"
    # rules are collapsed first, so a list is as long as the rule book
    per = findings.groupBy("episode_id", "layer", "rule_id", "severity").agg(F.count("*").alias("n"))
    g = per.groupBy("episode_id").agg(
        F.sum(F.when(err, F.col("n"))).alias("errors"), F.sum(F.when(~err, F.col("n"))).alias("warnings"),
        F.count(F.when(err & (F.col("layer") != "readiness"), 1)).alias("schema_errors"),
        F.sort_array(F.collect_list(F.when(err, F.concat("layer", F.lit("."), "rule_id")))).alias("blockers"),
    )
    j = episodes.select("episode_id", "synthetic").join(g, "episode_id", "left")
    b = F.coalesce("blockers", F.array().cast("array<string>"))
    about = lambda word: F.exists(b, lambda x: x.contains(word))
    advice = F.array_compact(F.array(
        F.when(F.size(b) == 0, "run the conversion").otherwise("fix the blocking findings before conversion"),
        F.when(about("image_path"), "fix the image paths and files"), F.when(about("camera_sync") | about("stamp"), "check the stamps of cameras and robot"),
        F.when(about("orientation"), "verify the orientation convention"), F.when(about("gripper_missing"), "add gripper_state if gripper actions matter"),
    ))
    valid, ready = F.coalesce(F.col("schema_errors") == 0, F.lit(True)), F.size(b) == 0
    return j.select(
        "episode_id", F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"), F.array_join(b, ",").alias("blockers"), F.array_join(advice, "; ").alias("recommendations"),
        valid.alias("schema_valid"), ready.alias("conversion_ready"), (ready & ~F.coalesce("synthetic", F.lit(False))).alias("training_ready"),
        F.when(~ready, "failed").when(F.coalesce("warnings", F.lit(0)) > 0, "warning").otherwise("ok").alias("status"),
    )


def tolerance_policy(fps: Column, override: Column) -> tuple[Column, Column]:
    """(tolerance, source) of camera stamps, and where it comes from."""
    t = align.tolerance(fps, override)
    return t, F.when(t == override, "override").when(finite(fps) & (fps > 0), "fps").otherwise("fallback")
