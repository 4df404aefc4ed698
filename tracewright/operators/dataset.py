"""Shaping episodes into a dataset: plans, tasks, running indexes, chunked layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.labels import non_empty
from tracewright.functions.vectors import PROFILES, profile_slice
from tracewright.session import stage

EPISODES_PER_CHUNK = 1000
#: Names of the exported columns (fixed values).
EXPORT_NAMES = {
    "external_rgb_path": "observation.image",
    "tcp_rgb_path": "observation.wrist_image",
    "model_state": "observation.state",
    "measured_action": "action",
    "task_instruction": "task",
}


def without_padding(frames: DataFrame) -> DataFrame:
    return frames.where(~F.coalesce("action_is_terminal_padding", F.lit(False)))


def export_plan(frames: DataFrame, profile: str, metadata: DataFrame | None = None) -> DataFrame:
    """Per episode: frames in, exported, left out; images there; a look at the first exported
    frame: its stamp, the lengths of its vectors, its task."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    keep = ~F.coalesce("action_is_terminal_padding", F.lit(False))
    state = profile_slice(F.col("model_state"), profile)
    first = F.min(F.when(keep, F.struct("frame_index", "frame_row_id", F.col("timestamp").alias("t"), F.size(state).alias("s"), F.size("measured_action").alias("a"))))
    p = frames.groupBy("episode_id").agg(
        F.count("*").alias("frames_in"),
        F.count(F.when(keep, 1)).alias("exported"),
        F.count(F.when(~keep, 1)).alias("excluded"),
        F.count(F.when(keep & non_empty(F.col("external_rgb_path")), 1)).alias("external_images"),
        F.count(F.when(keep & non_empty(F.col("tcp_rgb_path")), 1)).alias("tcp_images"),
        first.alias("f"), F.lit(PROFILES[profile]).cast("long").alias("state_dim"),
    )
    length = lambda k: F.when(F.col(f"f.{k}") >= 0, F.col(f"f.{k}")).cast("long")
    p = p.select("*", F.col("f.frame_index").alias("first_frame"), F.col("f.t").alias("first_timestamp"), length("s").alias("state_length"), length("a").alias("action_length")).drop("f")
    if metadata is None:
        return p
    m = metadata.groupBy("episode_id").agg(F.min_by("task_instruction", "meta_row_id").alias("first_task"))
    return p.join(m, "episode_id", "left")


def staged(frames: DataFrame, metadata: DataFrame, profile: str) -> DataFrame:
    """Exported frames under their export names, with state cut to the profile and task."""
    m = metadata.groupBy("episode_id").agg(F.min_by("task_instruction", "meta_row_id").alias("task_instruction"))
    f = without_padding(frames).join(m, "episode_id", "left").withColumn("model_state", profile_slice(F.col("model_state"), profile))
    return f.select("episode_id", "frame_index", "timestamp", *(F.col(a).alias(b) for a, b in EXPORT_NAMES.items())).withColumn("prompt", F.col("task"))


def task_of(own: Column, fallback: Column, has_own: Column) -> Column:
    """The frame's task if it has the key at all (a null there is an error), else the episode's."""
    t = F.when(has_own, own).otherwise(fallback)
    return F.when(non_empty(t), t)


def task_dictionary(episodes: DataFrame, order: str, task: str = "task") -> DataFrame:
    """(task, task_index) numbered by first appearance. There is one row a distinct task."""
    first = episodes.where(non_empty(F.col(task))).groupBy(task).agg(F.min(order).alias("first_at"))
    return first.withColumn("task_index", (F.row_number().over(Window.orderBy("first_at", task)) - 1).cast("long"))


def episode_table(frames: DataFrame) -> DataFrame:
    """(episode_id, episode_index, length, offset, chunk): episodes in order of id; offset
    is the number of frames before. One row an episode: these are range partitioned by id, and
    prefix sums run over the ranges first, so that neither their number nor the form of their
    ids matters."""
    e = frames.groupBy("episode_id").agg(F.count("*").alias("length"))
    e = stage(e.repartitionByRange("episode_id").withColumn("range", F.spark_partition_id()), "episodes")
    r = e.groupBy("range").agg(F.count("*").alias("n"), F.sum("length").alias("t"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    r = r.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"))
    w = Window.partitionBy("range").orderBy("episode_id")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    return (
        e.join(F.broadcast(r), "range")
        .withColumn("episode_index", F.col("n0") + F.row_number().over(w) - 1)
        .withColumn("offset", F.col("t0") + F.coalesce(F.sum("length").over(past), F.lit(0)))
        .withColumn("chunk", F.floor(F.col("episode_index") / EPISODES_PER_CHUNK))
        .select("episode_id", F.col("episode_index").cast("long").alias("episode_index"), "length", "offset", "chunk")
    )


def data_path(episode_index: Column, suffix: str = "parquet", chunk_size: int = EPISODES_PER_CHUNK) -> Column:
    size = chunk_size if isinstance(chunk_size, int) and chunk_size > 0 else EPISODES_PER_CHUNK
    return F.format_string(f"data/chunk-%03d/episode_%06d.{suffix}", F.floor(episode_index / size), episode_index)


def global_index(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Frames with their ordinal in the episode and their index over the whole dataset:
    the episode's offset and the ordinal, whose prefix counts run over stretches."""
    from tracewright.operators.actions import STRETCH

    f = frames.withColumn("stretch", F.floor(F.col("frame_index") / STRETCH))
    before = Window.partitionBy("episode_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    c = f.groupBy("episode_id", "stretch").count().withColumn("past", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    w = Window.partitionBy("episode_id", "stretch").orderBy("frame_index", "frame_row_id")
    return (
        f.withColumn("at", F.row_number().over(w) - 1)
        .join(c, ["episode_id", "stretch"])
        .join(episodes.select("episode_id", "episode_index", "offset"), "episode_id")
        .withColumn("ordinal", F.col("past") + F.col("at"))
        .withColumn("global_index", F.col("offset") + F.col("ordinal"))
        .drop("stretch", "at", "past", "offset")
    )


def dataset_info(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row of totals."""
    e = episodes.agg(F.count("*").alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames"))
    t = tasks.agg(F.count("*").alias("total_tasks"))
    return (
        e.withColumn("k", F.lit(1)).join(t.withColumn("k", F.lit(1)), "k").drop("k")  # one row each
        .withColumn("total_chunks", F.ceil(F.col("total_episodes") / EPISODES_PER_CHUNK))
        .withColumn("split", F.concat(F.lit("0:"), F.col("total_episodes").cast("string")))
    )


def write_dataset(frames: DataFrame, episodes: DataFrame, out: str, overwrite: bool = False) -> None:
    """Parquet partitioned by chunk and episode, numbers as 32-bit floats, sorted by frame.
    Nothing is written unless the gate of the caller passed; an existing target is kept
    unless ``overwrite``."""
    f = global_index(frames, episodes).withColumn("chunk", F.floor(F.col("episode_index") / EPISODES_PER_CHUNK))
    cols = [F.col("model_state").cast("array<float>").alias("observation.state"), F.col("measured_action").cast("array<float>").alias("action")]
    (
        f.select("chunk", "episode_index", "frame_index", F.col("global_index").alias("index"), "timestamp", *cols)
        .repartition("chunk", "episode_index", F.floor(F.col("frame_index") / 65536))
        .sortWithinPartitions("chunk", "episode_index", "frame_index")
        .write.mode("overwrite" if overwrite else "errorifexists")
        .partitionBy("chunk", "episode_index")
        .parquet(out)
    )
