"""Declarative validation: rules over tables, findings as rows, readiness as a rollup.

A rule is a layer, an id, a severity and a condition that is true where it is broken. All
rules of a layer are evaluated in one pass over its table; findings are exploded from an
array, so a layer is scanned once however many rules it has."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import labels as L
from tracewright.functions.stamps import finite, finite_vector, stamp_seconds
from tracewright.functions.vectors import ACTION_DIM, JOINTS, STATE_DIM, WRENCH_DIM, WRENCH_ORDER, is_zero


@dataclass(frozen=True)
class Rule:
    layer: str
    rule_id: str
    severity: str
    broken: Column
    message: str


def _nonneg(c: Column) -> Column:
    return F.coalesce(c >= 0, F.lit(False))


def _time(c: str) -> Column:
    return ~F.coalesce(finite(F.col(c)), F.lit(False))


def _vec(c: str, n: int) -> Column:
    return ~F.coalesce(finite_vector(F.col(c), n), F.lit(False))


def metadata_rules() -> list[Rule]:
    m = "metadata"
    texts = ["schema_version", "episode_id", "task_instruction", "geometry_type", "orientation_type", "collection_method", "action_label_primary", "robot_type", "recorder_version"]
    fps = F.col("fps")
    return [
        *(Rule(m, f"{t}_empty", "error", ~L.non_empty(F.col(t)), f"{t} must be a non-empty string") for t in texts),
        Rule(m, "schema_version_unknown", "error", F.coalesce(F.col("schema_version") != L.SCHEMA_VERSION, F.lit(False)), f"schema_version must be {L.SCHEMA_VERSION}"),
        Rule(m, "success_missing", "error", F.col("success").isNull(), "success must be a boolean"),
        Rule(m, "failure_reason_missing", "error", F.coalesce(~F.col("success"), F.lit(False)) & ~L.non_empty(F.col("failure_reason")), "a failed episode needs a failure_reason"),
        Rule(m, "failure_reason_blank", "error", F.col("failure_reason").isNotNull() & ~L.non_empty(F.col("failure_reason")), "failure_reason must be null or non-empty"),
        Rule(m, "fps_invalid", "error", ~F.coalesce(finite(fps) & (fps > 0), F.lit(False)), "fps must be a positive finite number"),
        Rule(m, "operator_unknown", "warning", L.is_unknown(F.col("operator_id")), "operator_id is unknown"),
    ]


def frame_rules() -> list[Rule]:
    f = "frames"
    pad = F.coalesce("action_is_terminal_padding", F.lit(False))
    return [
        Rule(f, "frame_index_invalid", "error", ~_nonneg(F.col("frame_index")), "frame_index must be a non-negative integer"),
        Rule(f, "timestamp_invalid", "error", _time("timestamp"), "timestamp must be a finite number"),
        Rule(f, "state_invalid", "error", _vec("model_state", STATE_DIM), f"model_state must hold {STATE_DIM} finite numbers"),
        Rule(f, "action_invalid", "error", _vec("measured_action", ACTION_DIM), f"measured_action must hold {ACTION_DIM} finite numbers"),
        Rule(f, "padding_missing", "error", F.col("action_is_terminal_padding").isNull(), "action_is_terminal_padding must be a boolean"),
        Rule(f, "padding_not_zero", "error", pad & ~F.coalesce(is_zero(F.col("measured_action")), F.lit(False)), "a padding action must be zero"),
        Rule(f, "external_path_empty", "error", ~L.non_empty(F.col("external_rgb_path")), "external_rgb_path must be a non-empty string"),
        Rule(f, "tcp_path_empty", "error", ~L.non_empty(F.col("tcp_rgb_path")), "tcp_rgb_path must be a non-empty string"),
    ]


def common_rules(layer: str, stamps: tuple[str, ...] = ("receipt_stamp",)) -> list[Rule]:
    return [
        Rule(layer, "record_index_invalid", "error", ~_nonneg(F.col("record_index")), "record_index must be a non-negative integer"),
        Rule(layer, "source_stamp_invalid", "error", stamp_seconds(F.col("source_stamp")).isNull(), "source_stamp must be seconds, or sec and nanosec"),
        *(Rule(layer, f"{s}_invalid", "error", _time(s), f"{s} must be a finite number") for s in stamps),
    ]


def robot_rules() -> list[Rule]:
    n = "robot_state_rt"
    some = F.lit(False)
    for c in WRENCH_ORDER:
        some = some | F.coalesce(finite_vector(F.col(c), WRENCH_DIM), F.lit(False))
    return [
        *common_rules(n, ("receipt_stamp", "monotonic_stamp")),
        Rule(n, "tcp_position_invalid", "error", _vec("actual_tcp_position", 6), "actual_tcp_position must hold 6 finite numbers"),
        Rule(n, "wrench_missing", "error", ~some, "no wrench source holds 6 finite numbers"),
    ]


def joint_rules() -> list[Rule]:
    n = "joint_states"
    names = F.col("joint_names")
    return [
        *common_rules(n),
        Rule(n, "joint_names_invalid", "error", ~F.coalesce((F.size(names) == JOINTS) & (F.size(F.array_distinct(names)) == JOINTS), F.lit(False)), "joint_names must be 6 different names"),
        Rule(n, "position_invalid", "error", _vec("position", JOINTS), "position must hold 6 finite numbers"),
        Rule(n, "velocity_invalid", "error", _vec("velocity", JOINTS), "velocity must hold 6 finite numbers"),
    ]


def gripper_rules() -> list[Rule]:
    n = "gripper_state"
    pos, width = F.coalesce(finite(F.col("gripper_position")), F.lit(False)), F.coalesce(finite(F.col("gripper_width_m")), F.lit(False))
    return [
        *common_rules(n),
        Rule(n, "value_missing", "error", ~(pos | width), "neither gripper_position nor gripper_width_m is finite"),
        Rule(n, "width_negative", "error", width & (F.col("gripper_width_m") < 0), "gripper_width_m must not be negative"),
        Rule(n, "placeholder", "warning", F.coalesce("placeholder", F.lit(False)), "a placeholder gripper is not fit for training"),
    ]


def camera_rules() -> list[Rule]:
    n = "camera_index"
    return [
        *common_rules(n),
        Rule(n, "image_path_empty", "error", ~L.non_empty(F.col("image_path")), "image_path must be a non-empty string"),
        Rule(n, "image_path_unsafe", "error", L.non_empty(F.col("image_path")) & ~L.safe_path(F.col("image_path")), "image_path must stay inside the episode"),
        Rule(n, "size_invalid", "error", ~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)), "width and height must be positive"),
        Rule(n, "role_missing", "warning", ~L.non_empty(F.col("camera_role")), "camera_role is missing"),
    ]


def stream_rules() -> list[Rule]:
    n = "streams_index"
    req = F.col("stream_name").isin(L.REQUIRED_STREAMS)
    opt = F.col("stream_name").isin(L.OPTIONAL_STREAMS)
    return [
        Rule(n, "source_name_empty", "error", ~L.non_empty(F.col("source_name")), "source_name must be a non-empty string"),
        Rule(n, "source_type_empty", "error", ~L.non_empty(F.col("source_type")), "source_type must be a non-empty string"),
        Rule(n, "path_unsafe", "error", ~L.safe_path(F.col("path")), "path must be relative and stay inside the episode"),
        Rule(n, "required_not_true", "error", req & ~F.coalesce("required", F.lit(False)), "a required stream must say required"),
        Rule(n, "optional_not_false", "error", opt & F.coalesce("required", F.lit(False)), "an optional stream must not say required"),
        Rule(n, "record_count_invalid", "error", ~_nonneg(F.col("record_count")), "record_count must be a non-negative integer"),
        Rule(n, "unverified", "warning", ~F.coalesce("verified", F.lit(True)), "the stream is not verified"),
        Rule(n, "source_unknown", "warning", L.is_unknown(F.col("source_name")), "source_name is unknown"),
    ]


def findings(df: DataFrame, rules: list[Rule], row_id: str) -> DataFrame:
    """(layer, rule_id, severity, episode_id, row_id, message) of every broken rule."""
    hits = F.array(
        *(
            F.when(
                F.coalesce(r.broken, F.lit(False)),
                F.struct(F.lit(r.layer).alias("layer"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(r.message).alias("message")),
            )
            for r in rules
        )
    )
    return df.select("episode_id", F.col(row_id).alias("row_id"), F.explode(F.array_compact(hits)).alias("h")).select(
        "h.layer", "h.rule_id", "h.severity", "episode_id", "row_id", "h.message"
    )


#: Table, its row id and its rules.
LAYERS = {
    "metadata": ("meta_row_id", metadata_rules),
    "frames": ("frame_row_id", frame_rules),
    "robot_state_rt": ("state_row_id", robot_rules),
    "joint_states": ("joint_row_id", joint_rules),
    "gripper_state": ("gripper_row_id", gripper_rules),
    "camera_index": ("camera_row_id", camera_rules),
    "streams_index": ("entry_id", stream_rules),
}


def all_findings(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row_id, rules = LAYERS[name]
        f = findings(df, rules(), row_id)
        out = f if out is None else out.unionByName(f)
    return out


def report(f: DataFrame) -> DataFrame:
    return f.groupBy("layer", "rule_id", "severity").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))


def readiness(f: DataFrame, episodes: DataFrame) -> DataFrame:
    """Per episode: errors, warnings, status (failed, warning or ok) and ready."""
    n = f.groupBy("episode_id").agg(F.count(F.when(F.col("severity") == "error", 1)).alias("errors"), F.count(F.when(F.col("severity") == "warning", 1)).alias("warnings"))
    e = episodes.select("episode_id").distinct().join(n, "episode_id", "left")
    err, warn = F.coalesce("errors", F.lit(0)), F.coalesce("warnings", F.lit(0))
    return e.select("episode_id", err.alias("errors"), warn.alias("warnings"), F.when(err > 0, "failed").when(warn > 0, "warning").otherwise("ok").alias("status"), (err == 0).alias("ready"))


class GateClosed(RuntimeError):
    """Raised before anything is written when an episode has errors."""


def gate(f: DataFrame) -> None:
    """Stops (as an action, before any write) if there is a finding of severity error."""
    first = f.where(F.col("severity") == "error").orderBy("layer", "rule_id", "row_id").limit(5).collect()
    if first:
        raise GateClosed("; ".join(f"{r['layer']} row {r['row_id']}: {r['message']}" for r in first))


def padding_rules(frames: DataFrame) -> DataFrame:
    """Per episode: padding frames, and whether there is just one and it is the last."""
    pad = F.coalesce("action_is_terminal_padding", F.lit(False))
    return frames.groupBy("episode_id").agg(F.count(F.when(pad, 1)).alias("n_padding"), F.max("frame_index").alias("last_frame"), F.max(F.when(pad, F.col("frame_index"))).alias("padding_frame")).withColumn(
        "one_and_last", F.coalesce((F.col("n_padding") == 1) & (F.col("padding_frame") == F.col("last_frame")), F.lit(False))
    )


def event_log_rules(events: DataFrame, group: str, order: list[str], name: str, first_name: str) -> DataFrame:
    """Per group: events, nameless ones, and whether the log begins as it should."""
    o = F.struct(*order)
    return events.groupBy(group).agg(F.count("*").alias("n"), F.count(F.when(~L.non_empty(F.col(name)), 1)).alias("n_nameless"), F.min_by(name, o).alias("first_event"), F.max_by(name, o).alias("last_event")).withColumn(
        "starts_right", F.coalesce(F.col("first_event") == first_name, F.lit(False))
    )
