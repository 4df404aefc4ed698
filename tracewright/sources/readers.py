"""Reading recorded episodes: CSV, JSON and JSONL files, Parquet exports, image listings.

Strict readers keep every line with its number and say what is wrong with it as rows; the
lenient reader skips blank lines and lines that do not parse."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions.labels import non_empty, safe_path

#: Where a stream lies if its catalogue entry names no path (fixed values).
DEFAULT_PATHS = {
    "joint_states": "streams/joint_states.jsonl",
    "robot_state_rt": "streams/robot_state_rt.jsonl",
    "tf": "streams/tf.jsonl",
    "tf_static": "streams/tf_static.jsonl",
    "tcp_camera": "streams/tcp_camera",
    "external_camera_1": "streams/external_camera_1",
    "external_camera_2": "streams/external_camera_2",
    "external_camera": "streams/external_camera",
    "wrist_camera": "streams/wrist_camera",
    "command_context": "streams/command_context.jsonl",
    "gripper_state": "streams/gripper_state.jsonl",
}


def _numbered(df: DataFrame, name: str, first: int) -> DataFrame:
    """Adds ``path`` and the row's number in its file. Files may be read in many blocks: a row's
    place in its block comes from the scan, and what the blocks before hold from a table with
    one row a block, so a file of any size spreads."""
    rows = df.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    per = rows.groupBy("path", "__block").agg(F.min("__at").alias("__start"), F.count("*").alias("n"))
    past = F.sum("n").over(Window.partitionBy("path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(F.col("path").alias("__path"), F.col("__block").alias("__b"), (F.coalesce(past, F.lit(0)) - F.col("__start") + first).alias("__shift"))
    same = (F.col("path") == F.col("__path")) & (F.col("__block") == F.col("__b"))
    return rows.join(per, same).withColumn(name, (F.col("__at") + F.col("__shift")).cast("long")).drop("__at", "__block", "__path", "__b", "__shift")


def csv_rows(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """Rows of headed CSV files as text, with ``path`` and ``row`` (0-based in the file)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _numbered(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(paths), "row", 0)


def as_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns as doubles; texts that are no finite number become null."""
    from tracewright.functions.stamps import finite

    out = df
    for c in columns:
        n = F.col(c).try_cast("double")
        out = out.withColumn(c, F.when(finite(n), n))
    return out


def json_objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, v, error): whole files, each to be one JSON object."""
    t = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    v = F.try_parse_json("value")
    return t.select("path", v.alias("v"), F.when(v.isNull(), "not valid JSON").when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object").alias("error"))


def strict_jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line_no, v, error) of every line (1-based; an empty end of the file is none);
    blank lines, lines that do not parse and lines that are no objects carry an error. The
    JSON literal NaN counts as not parsing. Files are read in blocks, however large."""
    lines = _numbered(spark.read.text(paths), "line_no", 1)
    v = F.try_parse_json("value")
    error = F.when(F.length(F.trim("value")) == 0, "blank line").when(v.isNull(), "not valid JSON").when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object")
    return lines.select("path", "line_no", v.alias("v"), error.alias("error"))


def index_jsonl(spark: SparkSession, root: str, streams: list[str]) -> DataFrame:
    """(stream_name, path, line_no, v, error): the index of every camera folder of an episode,
    <root>/<stream>/index.jsonl."""
    lines = strict_jsonl(spark, [os.path.join(root, s, "index.jsonl") for s in streams])
    return lines.select(F.element_at(F.split("path", "/"), -2).alias("stream_name"), "path", "line_no", "v", "error")


def lenient_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Lines that parse to the schema; others are passed over. (The JSON source itself does
    not look at a line of which no column is asked for, so counts would differ.)"""
    full = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    r = F.from_json("value", full, {"columnNameOfCorruptRecord": "__bad"})
    return spark.read.text(paths).where(F.length(F.trim("value")) > 0).select(r.alias("r")).where("r is not null and r.__bad is null").select(*(F.col("r").getField(f.name).alias(f.name) for f in schema.fields))


def one_record(df: DataFrame, what: str) -> DataFrame:
    """The same table, if it has just one row."""
    n = df.limit(2).count()
    if n != 1:
        raise ValueError(f"{what} must hold exactly one record")
    return df


def data_paths(root: str, template: str, episodes: list[int], chunk_size: int = 1000) -> list[str]:
    """Paths of the episodes' files by the layout's template."""
    size = chunk_size if isinstance(chunk_size, int) and chunk_size > 0 else 1000
    return [os.path.join(root, template.format(episode_chunk=e // size, episode_index=e)) for e in episodes]


def exported_actions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Only the action column of exported episodes is read."""
    return spark.read.parquet(*paths).select("action")


def stream_path(stream: Column, path: Column) -> Column:
    """A stream's path by its entry, else by default (a stream without one of its own lies in
    streams/<name>.jsonl); null if it would leave the episode."""
    default = F.create_map(*(F.lit(x) for kv in DEFAULT_PATHS.items() for x in kv))
    other = F.concat(F.lit("streams/"), stream, F.lit(".jsonl"))
    p = F.when(non_empty(path), path).otherwise(F.coalesce(F.try_element_at(default, stream), other))
    return F.when(safe_path(p), p)


def images(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length) of image files under a folder; their contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length")


def image_status(frames: DataFrame, files: DataFrame, column: str, root: str, fallback: str | None = None) -> DataFrame:
    """Adds <column>_status: ok, empty, absent or unnamed, by a join with the listing (that of
    ``images`` has no empty files: they come out as absent). A relative
    path is looked for under ``root``, then under ``fallback`` if there is one; <column>_resolved
    is where it was found."""
    f = files.groupBy(F.regexp_replace("path", "^file:/+", "/").alias("p")).agg(F.max("length").alias("n"))
    full = lambda base: F.when(F.col(column).startswith("/"), F.col(column)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.col(column)))
    j = frames.withColumn("__at0", full(root)).join(f.select(F.col("p").alias("__p0"), F.col("n").alias("__n0")), F.col("__at0") == F.col("__p0"), "left")
    places = [("__at0", "__n0")]
    if fallback is not None:
        j = j.withColumn("__at1", full(fallback)).join(f.select(F.col("p").alias("__p1"), F.col("n").alias("__n1")), F.col("__at1") == F.col("__p1"), "left")
        places.append(("__at1", "__n1"))
    size = F.coalesce(*(F.col(n) for _, n in places))
    at = F.coalesce(*(F.when(F.col(n).isNotNull(), F.col(a)) for a, n in places))
    status = F.when(~non_empty(F.col(column)), "unnamed").when(size.isNull(), "absent").when(size == 0, "empty").otherwise("ok")
    return j.withColumn(f"{column}_status", status).withColumn(f"{column}_resolved", at).drop("__at0", "__p0", "__n0", "__at1", "__p1", "__n1")


def side_file(main: DataFrame, side: DataFrame, key: list[str]) -> DataFrame:
    """Rows with what an optional side table knows of them."""
    return main.join(side, key, "left")
