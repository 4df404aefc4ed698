"""Which camera stream feeds which view: explicit assignments first, else only if unique.

Explicit are the entries of the mapping objects (metadata before the stream catalogue, their
keys in a fixed order), then what a stream's own entry says: ``model_input_key`` or
``model_key``, then ``used_for_model`` with its role or name. The first assignment of a view
holds; a different one after it is an error, and so is one that names no camera stream.
Several candidates without an explicit assignment are an error, never a guess."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.labels import CAMERA_KINDS, CAMERA_STREAMS, label, non_empty, view_of_role, view_of_stream

VIEWS = ("external", "tcp")
# --- fixed values: names of mapping objects and of their keys ---------------------------
MAPPINGS = ["model_camera_mapping", "model_input_cameras", "camera_mapping", "selected_camera_streams"]
EXTERNAL_KEYS = ["external_rgb_path", "observation.image", "observation_image", "external_camera", "external_camera_1", "external", "model_external_camera"]
TCP_KEYS = ["tcp_rgb_path", "observation.wrist_image", "observation_wrist_image", "wrist_image", "tcp_camera", "wrist_camera", "tcp", "wrist", "model_tcp_camera"]
STREAM_NAME_KEYS = ["stream", "stream_name", "source_stream", "raw_stream", "name"]
MODEL_KEYS = ["model_input_key", "model_key"]
ROLE_KEYS = ["role", "camera_role", "source_role", "model_role"]
KIND_KEYS = ["type", "stream_type", "kind"]
#: What a processed episode keeps of a camera's entry.
KEPT_KEYS = ["path", "type", "stream_type", "kind", "role", "camera_role", "camera_id", "external_camera_id", "source_name", "source_type", "model_input_key", "used_for_model", "record_count", "verified"]
# --- end of the fixed values ------------------------------------------------------------


def view_of_key(key: Column) -> Column:
    """The view that a key of a mapping object means."""
    n = label(key)
    return F.when(n.isin(EXTERNAL_KEYS), "external").when(n.isin(TCP_KEYS), "tcp")


def _first(cols: list[Column]) -> Column:
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def entries(streams: DataFrame) -> DataFrame:
    """(episode_id, stream_name, camera, by_key, by_role, used): what an entry says of itself.
    Columns of ``streams`` that an entry may have are read where they are there."""
    has = lambda keys: [k for k in keys if k in streams.columns]
    by_role = _first([view_of_role(F.col(k)) for k in has(ROLE_KEYS)])
    kind = reduce(lambda a, b: a | b, (F.coalesce(label(F.col(k)).isin(CAMERA_KINDS), F.lit(False)) for k in has(KIND_KEYS)), F.lit(False))
    camera = F.coalesce(F.col("stream_name").isin(CAMERA_STREAMS), F.lit(False)) | kind | by_role.isNotNull()
    used = F.coalesce(F.col("used_for_model").cast("boolean"), F.lit(False)) if "used_for_model" in streams.columns else F.lit(False)
    return streams.select("episode_id", "stream_name", camera.alias("camera"), _first([view_of_key(F.col(k)) for k in has(MODEL_KEYS)]).alias("by_key"), by_role.alias("by_role"), used.alias("used"))


def mapping_rows(objects: DataFrame, column: str, container: int) -> DataFrame:
    """(episode_id, view, stream_name, rank, named) of the mapping objects in a JSON text
    column: every key that means a view, the stream it names (a text, or an object that names
    one), and the rank of the source. A key that names no stream has a null name."""
    out = None
    for i, m in enumerate(MAPPINGS):
        pairs = F.explode(F.from_json(F.get_json_object(F.col(column), f"$.{m}"), "map<string,string>")).alias("key", "value")
        rows = objects.select("episode_id", pairs)
        nested = _first([F.nullif(F.trim(F.get_json_object("value", f"$.{k}")), F.lit("")) for k in STREAM_NAME_KEYS])
        name = F.when(F.ltrim("value").startswith("{"), nested).otherwise(F.nullif(F.trim("value"), F.lit("")))
        part = rows.select("episode_id", view_of_key(F.col("key")).alias("view"), name.alias("stream_name"), F.lit(10 * container + i).alias("rank")).where("view is not null")
        out = part if out is None else out.unionByName(part)
    return out


def select_views(streams: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """(episode_id, view, stream_name, source, error) for both views of every episode with
    streams. ``streams``: episode_id, stream_name and any of the keys an entry may have.
    ``explicit``: episode_id, view, stream_name, rank (smaller goes first), as from
    ``mapping_rows``."""
    e = entries(streams)
    cams = e.where("camera").withColumn("inferred", F.coalesce("by_key", "by_role", view_of_stream(F.col("stream_name")))).distinct()
    own = cams.select("episode_id", F.explode(F.array_compact(F.array(
        F.when(F.col("by_key").isNotNull(), F.struct(F.col("by_key").alias("view"), F.lit(100).alias("rank"))),
        F.when(F.col("used"), F.struct(F.coalesce("by_role", view_of_stream(F.col("stream_name"))).alias("view"), F.lit(101).alias("rank"))),
    ))).alias("x"), "stream_name").select("episode_id", "x.view", "stream_name", "x.rank")
    if explicit is not None:
        own = explicit.select("episode_id", "view", "stream_name", "rank").unionByName(own)
    said = own.join(cams.select("episode_id", "stream_name").distinct().withColumn("declared", F.lit(True)), ["episode_id", "stream_name"], "left")
    good = F.coalesce("declared", F.lit(False))
    first = F.min(F.when(good, F.struct("rank", "stream_name")))
    given = said.where("view is not null").groupBy("episode_id", "view").agg(
        first["stream_name"].alias("chosen"), F.countDistinct(F.when(good, F.col("stream_name"))).alias("streams"),
        F.bool_or(F.col("stream_name").isNull()).alias("nameless"), F.bool_or(F.col("stream_name").isNotNull() & ~good).alias("foreign"),
    )
    lost = said.where("view is null").groupBy("episode_id").agg(F.lit(True).alias("aimless"))
    inferred = cams.where("inferred is not null").groupBy("episode_id", F.col("inferred").alias("view")).agg(F.countDistinct("stream_name").alias("n"), F.min("stream_name").alias("only"))
    want = streams.select("episode_id").distinct().select("episode_id", F.explode(F.array(*(F.lit(v) for v in VIEWS))).alias("view"))
    j = want.join(given, ["episode_id", "view"], "left").join(inferred, ["episode_id", "view"], "left").join(lost, "episode_id", "left")
    error = (
        F.when(F.col("streams") > 1, "conflicting assignments").when(F.col("foreign"), "assignment names no camera stream").when(F.col("nameless"), "assignment must name a stream")
        .when(F.col("aimless"), "used_for_model without a role or key").when(F.col("chosen").isNotNull(), None)
        .when(F.col("n").isNull(), "no camera stream").when(F.col("n") > 1, "multiple candidates")
    )
    alone = F.col("chosen").isNull() & (F.col("n") == 1)
    return j.select(
        "episode_id", "view", F.coalesce("chosen", F.when(alone, F.col("only"))).alias("stream_name"),
        F.when(F.col("chosen").isNotNull(), "explicit").when(alone, "inferred").alias("source"), error.alias("error"),
    )


def kept_metadata(entry: Column) -> Column:
    """The keys of a camera's entry (JSON text) that a processed episode keeps, as JSON."""
    whole = F.from_json(entry, "map<string,string>")
    return F.to_json(F.map_filter(whole, lambda k, v: k.isin(KEPT_KEYS) & non_empty(v)))


def topic_of(live: Column, stream: Column) -> Column:
    """The topic that a verification object (JSON text) knows a camera stream by: its mapping,
    the key of the stream's own name, else the key of its older name."""
    old = F.when(stream.isin("tcp_camera", "wrist_camera"), "wrist_camera_topic").when(stream.isin("external_camera_1", "external_camera"), "external_camera_topic")
    whole, topics = F.from_json(live, "map<string,string>"), F.from_json(F.get_json_object(live, "$.camera_topics"), "map<string,string>")
    own = F.concat(stream, F.lit("_topic"))
    inside = lambda m, k: F.coalesce(F.map_contains_key(m, k), F.lit(False))
    return F.when(inside(topics, stream), F.try_element_at(topics, stream)).when(inside(whole, own), F.try_element_at(whole, own)).when(old.isNotNull(), F.try_element_at(whole, old))
