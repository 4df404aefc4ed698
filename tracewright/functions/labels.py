"""Texts and labels: normalising, markers, paths, stream roles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: vocabularies of markers, streams and roles ---------------------------
UNKNOWN_WORDS = ["", "unknown", "unverified", "unset", "todo", "tbd", "none", "null", "n/a", "na"]
UNKNOWN_PREFIXES = ["unknown", "todo", "tbd"]
SYNTHETIC_METHODS = ["synthetic_raw_real", "synthetic_raw_real_fixture", "pipeline_smoke", "pipeline_smoke_raw_real"]
SYNTHETIC_RECORDERS = ["synthetic_raw_real_generator_v0", "pipeline_smoke_raw_real_generator_v0"]
PLACEHOLDER_GRIPPERS = ["synthetic_constant_pending_gripper_integration", "pipeline_smoke_constant_gripper", "synthetic_gripper_state"]
CAMERA_KINDS = ["camera_rgb", "camera_images", "rgb_camera", "camera"]
CAMERA_STREAMS = ["tcp_camera", "external_camera_1", "external_camera_2", "external_camera", "wrist_camera"]
EXTERNAL_ROLES = ["external_camera", "external", "external_camera_1", "external_rgb"]
TCP_ROLES = ["tcp_camera", "wrist_camera", "tcp", "wrist"]
REQUIRED_STREAMS = ["joint_states", "robot_state_rt", "tf", "tf_static"]
OPTIONAL_STREAMS = ["command_context", "gripper_state"]
SCHEMA_VERSION = "raw_real_v0"
ORIENTATION_CONVENTIONS = ["rotation_vector_degrees", "rotation_vector_radians"]
# --- end of the fixed values ------------------------------------------------------------


def unit_label(c: Column) -> Column:
    """Lower case, trimmed, blanks as underscores."""
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))


def label(c: Column) -> Column:
    """As unit_label, dashes as underscores too."""
    return F.replace(unit_label(c), F.lit("-"), F.lit("_"))


def non_empty(c: Column) -> Column:
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))


def is_unknown(c: Column) -> Column:
    """A value that stands for "not known": null, blank, one of the markers, or begins so."""
    n = label(c)
    begins = F.lit(False)
    for p in UNKNOWN_PREFIXES:
        begins = begins | n.startswith(p)
    return F.coalesce(n.isin(UNKNOWN_WORDS) | begins, F.lit(True))


def is_synthetic(method: Column, recorder: Column, *flags: Column) -> Column:
    """A method or recorder that is exactly a marker of synthetic data, or a flag that is true."""
    out = F.coalesce(method.isin(SYNTHETIC_METHODS), F.lit(False)) | F.coalesce(recorder.isin(SYNTHETIC_RECORDERS), F.lit(False))
    for f in flags:
        out = out | F.coalesce(f, F.lit(False))
    return out


def is_placeholder_gripper(source: Column) -> Column:
    n = label(source)
    hinted = (n.contains("synthetic") | n.contains("pipeline_smoke")) & n.contains("gripper")
    return F.coalesce(n.isin(PLACEHOLDER_GRIPPERS) | hinted, F.lit(False))


def safe_path(c: Column) -> Column:
    """A relative path without a step upwards; null and blank paths are not safe."""
    return F.coalesce(non_empty(c) & ~F.trim(c).startswith("/") & ~F.array_contains(F.split(F.trim(c), "/"), ".."), F.lit(False))


def numbered_name(i: Column, suffix: Column | str) -> Column:
    s = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lpad(i.cast("string"), 6, "0"), s)


def mentions(c: Column, words: list[str]) -> Column:
    n = F.lower(c)
    out = F.lit(False)
    for w in words:
        out = out | n.contains(w)
    return F.coalesce(out, F.lit(False))


def view_of_role(role: Column) -> Column:
    n = label(role)
    return F.when(n.isin(TCP_ROLES), "tcp").when(n.isin(EXTERNAL_ROLES), "external")


def view_of_stream(stream: Column) -> Column:
    return F.when(stream.isin("tcp_camera", "wrist_camera"), "tcp").when(
        (stream == "external_camera") | stream.startswith("external_camera_"), "external"
    )


def view_of(stream: Column, role: Column) -> Column:
    """The model's view of a camera stream: by its role, else by its name."""
    return F.coalesce(view_of_role(role), view_of_stream(stream))


def is_camera(stream: Column, kind: Column) -> Column:
    return F.coalesce(stream.isin(CAMERA_STREAMS) | label(kind).isin(CAMERA_KINDS), F.lit(False))
