"""Rules of what is exported: plans, staged frames, datasets and their attempts; and single
samples out of an export. Findings have the form of ``rules.findings``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import labels as L
from tracewright.functions.stamps import finite_vector
from tracewright.functions.vectors import ACTION_DIM, PROFILES
from tracewright.operators import actions
from tracewright.operators.dataset import EPISODES_PER_CHUNK
from tracewright.operators.readiness import _found, positions, union
from tracewright.operators.rules import Rule, findings

# --- fixed values: shapes of the exported features --------------------------------------
CAMERA_SHAPE = [480, 640, 3]
INFO_KEYS = ["codebase_version", "robot_type", "fps", "total_episodes", "total_frames", "total_tasks", "total_chunks", "chunks_size", "splits", "data_path", "features"]
CODEBASE_VERSION = "v2.1"
# --- end of the fixed values ------------------------------------------------------------


def features(profile: str, storage: str = "video") -> dict[str, dict]:
    """The catalogue of the exported columns: type and shape. Cameras have one fixed shape
    whatever their images measure."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    if storage not in ("image", "video"):
        raise ValueError(f"unknown camera storage {storage!r}")
    camera = {"dtype": storage, "shape": CAMERA_SHAPE, "names": ["height", "width", "channels"]}
    one = lambda t: {"dtype": t, "shape": [1]}
    return {
        "observation.image": camera, "observation.wrist_image": dict(camera), "observation.state": {"dtype": "float32", "shape": [PROFILES[profile]]}, "action": {"dtype": "float32", "shape": [ACTION_DIM]},
        "timestamp": one("float64"), **{k: one("int64") for k in ("frame_index", "episode_index", "task_index", "index")}, "task": one("string"), "prompt": one("string"),
    }


def missing_keys(document: Column, required: list[str]) -> Column:
    """The required keys a JSON object lacks, in their order."""
    return F.array_except(F.array(*(F.lit(k) for k in required)), F.coalesce(F.json_object_keys(document), F.array().cast("array<string>")))


def _int(c: str) -> Column:
    return F.coalesce(F.col(c) >= 0, F.lit(False))


def plan_findings(plans: DataFrame, profile: str) -> DataFrame:
    """Plans, one row an episode as ``dataset.export_plan`` gives them, held against their own
    rules. ``row_id`` is null: a plan is told by its episode."""
    p = "plan"
    c = F.col
    equal = lambda a, b: ~F.coalesce(a == b, F.lit(False))
    rs = [
        Rule(p, "exported_not_positive", "error", ~F.coalesce(c("exported") > 0, F.lit(False)), "a plan must export frames"),
        Rule(p, "excluded_wrong", "error", equal(c("excluded"), c("frames_in") - c("exported")), "excluded must be input less exported"),
        Rule(p, "state_dim_wrong", "error", equal(c("state_dim"), F.lit(PROFILES[profile])), "state_dim must be the profile's"),
        Rule(p, "external_images_missing", "error", equal(c("external_images"), c("exported")), "every exported frame must have its external image"),
        Rule(p, "tcp_images_missing", "error", equal(c("tcp_images"), c("exported")), "every exported frame must have its tcp image"),
        Rule(p, "preview_state_wrong", "error", equal(c("state_length"), c("state_dim")), "the preview's state must have the profile's length"),
        Rule(p, "preview_action_wrong", "error", equal(c("action_length"), F.lit(ACTION_DIM)), f"the preview's action must have {ACTION_DIM} numbers"),
    ]
    return findings(plans.withColumn("__row", F.lit(None).cast("long")), rs, "__row")


def staged_findings(staged: DataFrame, plans: DataFrame, profile: str, row_id: str = "frame_index") -> DataFrame:
    """Staged frames against their rules, and against the plan: the same episodes, as many
    frames as it exports, from the same source (``source`` where both have one)."""
    s = "staged"
    rs = [
        Rule(s, "state_invalid", "error", ~F.coalesce(finite_vector(F.col("`observation.state`"), PROFILES[profile]), F.lit(False)), "state must hold the profile's finite numbers"),
        Rule(s, "action_invalid", "error", ~F.coalesce(finite_vector(F.col("action"), ACTION_DIM), F.lit(False)), "action must hold finite numbers"),
        Rule(s, "image_empty", "error", ~L.non_empty(F.col("`observation.image`")), "observation.image must be a path"),
        Rule(s, "wrist_image_empty", "error", ~L.non_empty(F.col("`observation.wrist_image`")), "observation.wrist_image must be a path"),
        Rule(s, "task_empty", "error", ~L.non_empty(F.col("task")), "task must be a non-empty string"),
        Rule(s, "prompt_differs", "error", ~F.coalesce(F.col("prompt") == F.col("task"), F.lit(False)), "prompt must be the task"),
    ]
    own = [findings(staged, rs, row_id)]
    padding = [k for k in ("action_is_terminal_padding", "terminal_padding") if k in staged.columns]
    if padding:
        own.append(_found(staged.select("episode_id").distinct(), s, "padding_field", "error", None, "staged frames must not carry padding fields"))
    both = "source" in staged.columns and "source" in plans.columns
    n = staged.groupBy("episode_id").agg(F.count("*").alias("n"), *([F.min("source").alias("s_lo"), F.max("source").alias("s_hi")] if both else []))
    j = plans.select("episode_id", "exported", *(["source"] if both else [])).join(n, "episode_id", "full_outer")
    own.append(_found(j.where(~F.coalesce(F.col("exported") == F.coalesce("n", F.lit(0)), F.lit(False))), s, "count_differs", "error", None, "staged frames must be as many as the plan exports"))
    if both:
        own.append(_found(j.where(~F.coalesce((F.col("s_lo") == F.col("source")) & (F.col("s_hi") == F.col("source")), F.lit(False))), s, "source_differs", "error", None, "plan and staged frames must have the same source"))
    return union(own)


def dataset_findings(frames: DataFrame, episodes: DataFrame, tasks: DataFrame, stats: DataFrame | None, info: DataFrame, profile: str, finite: bool = True) -> DataFrame:
    """A dataset's tables held against one another. ``frames``: episode_index, frame_index,
    index, task_index, task, prompt, state, action; ``episodes``: episode_index, task_index,
    length; ``tasks``: task_index, task; ``stats``: episode_index; ``info``: one row of totals.
    ``finite`` also asks the numbers to be finite, else only to be there. Findings carry the
    episode index as ``episode_id`` and the frame's ``index`` as row."""
    d = "dataset"
    text = lambda c: F.col(c).cast("string")
    whole = (lambda c, n: finite_vector(F.col(c), n)) if finite else (lambda c, n: (F.size(c) == n) & F.forall(c, lambda x: x.isNotNull()))
    e = episodes.select("episode_index", F.col("task_index").alias("e_task"), F.col("length").alias("e_length"))
    t = tasks.select(F.col("task_index").alias("t_index"), F.col("task").alias("t_text"))
    f = frames.join(e, "episode_index", "left").join(t, F.col("e_task") == F.col("t_index"), "left").withColumn("episode_id", text("episode_index"))
    rs = [
        Rule(d, "episode_unknown", "error", F.col("e_length").isNull(), "the frame's episode must be listed"),
        Rule(d, "task_index_differs", "error", ~F.coalesce(F.col("task_index") == F.col("e_task"), F.lit(False)), "the frame's task_index must be its episode's"),
        Rule(d, "task_differs", "error", F.col("t_text").isNotNull() & ~F.coalesce(F.col("task") == F.col("t_text"), F.lit(False)), "the frame's task must be the listed text"),
        Rule(d, "prompt_differs", "error", F.col("t_text").isNotNull() & ~F.coalesce(F.col("prompt") == F.col("t_text"), F.lit(False)), "the frame's prompt must be the listed text"),
        Rule(d, "state_invalid", "error", ~F.coalesce(whole("state", PROFILES[profile]), F.lit(False)), "state must hold the profile's numbers"),
        Rule(d, "action_invalid", "error", ~F.coalesce(whole("action", ACTION_DIM), F.lit(False)), "action must hold its numbers"),
        *(Rule(d, f"{k}_invalid", "error", ~_int(k), f"{k} must be a non-negative integer") for k in ("frame_index", "index")),
    ]
    counted = e.join(frames.groupBy("episode_index").agg(F.count("*").alias("n")), "episode_index", "left").withColumn("episode_id", text("episode_index"))
    per = positions(episodes.select(F.lit(0).alias("g"), "episode_index"), "g", "episode_index").withColumn("episode_id", text("episode_index"))
    order = positions(frames.select(F.lit(0).alias("g"), "episode_index", F.col("index").alias("at")).where("at is not null"), "g", "at").withColumn("episode_id", text("episode_index"))
    orphan = episodes.join(tasks.select("task_index").distinct(), "task_index", "left_anti").withColumn("episode_id", text("episode_index"))
    doubled = tasks.groupBy("task_index").agg(F.count("*").alias("n")).where("n > 1").withColumn("episode_id", F.lit(None).cast("string"))
    parts = [
        findings(f, rs, "index"),
        _found(counted.where("coalesce(n, 0) <> e_length"), d, "length_differs", "error", None, "length must be the number of frames"),
        _found(per.where("episode_index <> place"), d, "episode_index_not_sequential", "error", None, "episode indexes must count up from 0"),
        _found(order.where("at <> place"), d, "index_not_sequential", "error", F.col("at"), "index must count up from 0 over all episodes"),
        _found(orphan, d, "task_unknown", "error", None, "task_index must be listed"),
        _found(doubled, d, "task_index_repeated", "error", F.col("task_index"), "a task_index must be listed once"),
    ]
    if stats is not None:
        parts.append(_found(episodes.join(stats.select("episode_index").distinct(), "episode_index", "left_anti").withColumn("episode_id", text("episode_index")), d, "stats_missing", "error", None, "every episode must have a stats record"))
    totals = info.withColumn("k", F.lit(1))  # one row, and one row each of the counts
    for name, df in (("n_frames", frames), ("n_episodes", episodes), ("n_tasks", tasks)):
        totals = totals.join(df.agg(F.count("*").alias(name)).withColumn("k", F.lit(1)), "k")
    wrong = F.array_compact(F.array(
        *(F.when(~F.coalesce(F.col(f"total_{k}") == F.col(f"n_{k}"), F.lit(False)), f"total_{k}") for k in ("episodes", "frames", "tasks")),
        F.when(~F.coalesce(F.col("total_chunks") == F.ceil(F.col("n_episodes") / EPISODES_PER_CHUNK), F.lit(False)), "total_chunks"),
    ))
    parts.append(_found(totals.select(F.lit(None).cast("string").alias("episode_id"), F.explode(wrong).alias("what")), d, "totals_differ", "error", None, F.concat("what", F.lit(" does not agree with the tables"))))
    return union(parts)


def union_of_episodes(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """All episodes' frames in one table, ``source`` telling where each is from. The same
    source twice is refused."""
    names = [n for n, _ in parts]
    if len(set(names)) != len(names):
        raise ValueError(f"repeated inputs: {sorted({n for n in names if names.count(n) > 1})}")
    return union([df.withColumn("source", F.lit(n)) for n, df in parts])


# --- samples ------------------------------------------------------------------------------
def sample(frames: DataFrame, episode_index: int, row: int) -> DataFrame:
    """One frame of an export by episode and row; an error where there is none."""
    one = frames.where((F.col("episode_index") == episode_index) & (F.col("frame_index") == row))
    if row < 0 or one.isEmpty():
        raise IndexError(f"episode {episode_index} has no row {row}")
    return one


def preview(v: Column, n: int) -> Column:
    """The first n values of a vector."""
    return F.slice(v, 1, n)


def exported_chunk(frames: DataFrame, horizon: int, pad: str = "repeat_last") -> DataFrame:
    """Action chunks of exported frames (episode_index, frame_index, action): only these three
    columns are read."""
    return actions.action_chunks(frames.select("episode_index", "frame_index", "action"), "episode_index", "frame_index", horizon, pad)


def observation_findings(frames: DataFrame, profile: str) -> DataFrame:
    """Exported frames that make no observation: missing columns, vectors, prompt or task."""
    lack = [k for k in ("observation.state", "action", "task", "prompt") if k not in frames.columns]
    if lack:
        raise ValueError(f"missing columns: {lack}")
    o = "observation"
    rs = [
        Rule(o, "state_invalid", "error", ~F.coalesce(finite_vector(F.col("`observation.state`"), PROFILES[profile]), F.lit(False)), "state must hold the profile's finite numbers"),
        Rule(o, "action_invalid", "error", ~F.coalesce(finite_vector(F.col("action"), ACTION_DIM), F.lit(False)), "action must hold finite numbers"),
        Rule(o, "prompt_empty", "error", ~L.non_empty(F.col("prompt")), "prompt must be a non-empty string"),
        Rule(o, "task_empty", "error", ~L.non_empty(F.col("task")), "task must be a non-empty string"),
    ]
    return findings(frames, rs, "frame_index")


def attempt_findings(status: DataFrame, episodes: DataFrame, dry_run: bool = False) -> DataFrame:
    """What an export attempt reports (episode_index, path, frames, error) against the episodes
    it had to write (episode_index, length): nothing in a dry run, else every episode once, in
    its chunk's folder, with all its frames."""
    text = F.col("episode_index").cast("string")
    if dry_run:
        return _found(status.withColumn("episode_id", text), "attempt", "dry_run_wrote", "error", None, "a dry run must write nothing")
    want = F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(F.col("episode_index") / EPISODES_PER_CHUNK), F.col("episode_index"))
    j = episodes.select("episode_index", "length").join(status.select("episode_index", "path", "frames", "error"), "episode_index", "left").withColumn("episode_id", text)
    return union([
        _found(j.where("path is null"), "attempt", "episode_missing", "error", None, "the episode was not written"),
        _found(j.where("error is not null"), "attempt", "episode_failed", "error", None, F.col("error")),
        _found(j.where(F.col("path").isNotNull() & (F.col("path") != want)), "attempt", "path_wrong", "error", None, "the file is not in its chunk's folder"),
        _found(j.where("error is null and frames <> length"), "attempt", "frames_differ", "error", None, "the file has not all frames"),
    ])


def preflight(structural: bool, libraries: dict[str, bool | str | None]) -> dict[str, bool]:
    """What may be exported: tables need the structure and Parquet, videos an encoder."""
    return {"structural": structural, "real_export_ready": structural and bool(libraries.get("parquet")), "video_export_ready": structural and bool(libraries.get("video"))}
