"""Schemas that drift between files: a report of every change, and one table per stream.

Every file has a fingerprint: its top-level fields, their types and a profile of their
contents. Within a source (recorder and stream) each file is held against the one before
it; what goes and what comes in one file, with the same kind of content, is a rename. The
renames form chains that run on in time; every file is routed through the chains it stands
in to the stream's target fields, then defaults and casts. Fingerprints that differ from the
one before make a new version.

Order within a source is made without gathering a source in one task: files are range
partitioned by (source, time), positions and last-known types are carried over the ends of
these chunks by a small table with one row per chunk, source and field.

Defined results: files without an id or any record have no fingerprint and are passed over; nulls
tell no type, a field's type stays as last known; a field of mixed types in one file has
its most frequent one (ties: by name); files of one instant go by file_id; extra columns are
unread; an empty table gives an empty report.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.compact import json_lines
from tracewright.session import stage

STREAMS = ("robot_state_rt", "gripper_state")
SOURCE = ["recorder_id", "stream_name"]
CHUNK_FILES = 20000
#: Score from which what goes and what comes is a rename.
RENAME_SCORE = 0.5


def field_values(raw_files: DataFrame) -> DataFrame:
    """One row per file, line and top-level field: name, kind and a profile of the value."""
    lines = json_lines(
        raw_files.where(F.col("stream_name").isin(*STREAMS) & F.col("file_id").isNotNull()).select("file_id", "recorder_id", "stream_name", "written_at", "content")
    )
    spark = raw_files.sparkSession
    x = lines.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    kind = F.schema_of_variant("value")
    text = F.try_variant_get("value", "$", "string")
    k = (
        F.when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", None)
        .otherwise("number")
    )
    return x.select(
        "file_id", *SOURCE, "written_at", F.col("key").alias("name"), k.alias("kind"), text.alias("text"),
    )


def fingerprints(raw_files: DataFrame) -> DataFrame:
    """(file_id, recorder_id, stream_name, written_at, name, kind, profile ...) per file and
    field. The profile is what tells contents apart: the mean size of numbers, whether they
    are whole, the length of arrays, the shape of texts."""
    f = field_values(raw_files)
    num = F.when(F.col("kind") == "number", F.col("text").try_cast("double"))
    parts = F.when(F.col("kind") == "array", F.size(F.split("text", ",")))
    listed = F.when(F.col("kind").isin("array", "string"), F.regexp_extract("text", r"(-?[0-9]+\.[0-9]+)", 1).try_cast("double"))
    shape = F.when(F.col("kind") == "string", F.regexp_replace(F.regexp_replace("text", r"-?[0-9]+(?:\.[0-9]+)?", "9"), "[A-Za-z]+", "a"))
    one = f.groupBy("file_id", *SOURCE, "written_at", "name", "kind").agg(
        F.count("*").alias("n"),
        F.avg(num).alias("mean"),
        F.avg(F.abs(F.coalesce(num, listed))).alias("size"),
        F.min(num).alias("lo"),
        F.max(num).alias("hi"),
        F.avg(F.when(num.isNotNull(), (num == F.floor(num)).cast("double"))).alias("whole"),
        F.max(parts).alias("parts"),
        F.mode(shape, True).alias("shape"),
        F.avg(F.length("text")).alias("width"),
        F.collect_set(F.when(F.col("kind") == "string", F.col("text"))).alias("words"),
    )
    best = F.max_by(
        F.struct("kind", "n", "mean", "size", "lo", "hi", "whole", "parts", "shape", "width", "words"),
        F.struct(F.col("kind").isNotNull(), F.col("n"), "kind"),
    )
    return one.groupBy("file_id", *SOURCE, "written_at", "name").agg(best.alias("p")).withColumn("kind", F.col("p.kind"))


def chunks(fp: DataFrame) -> DataFrame:
    """Files in order: (file_id, source, chunk, pos, fields). ``pos`` counts the files of a
    source from 0 over all chunks."""
    files = stage(fp.groupBy("file_id", *SOURCE, "written_at").agg(F.collect_list(F.struct("name", "kind", "p")).alias("fields")), "fingerprints")
    n = max(1, math.ceil(files.count() / CHUNK_FILES))
    ordered = stage(files.repartitionByRange(n, *SOURCE, "written_at", "file_id").withColumn("chunk", F.spark_partition_id()), "file-chunks")
    w = Window.partitionBy(*SOURCE, "chunk").orderBy("written_at", "file_id")
    local = ordered.withColumn("at", F.row_number().over(w) - 1)
    before = (
        ordered.groupBy(*SOURCE, "chunk").count()
        .withColumn("offset", F.coalesce(F.sum("count").over(Window.partitionBy(*SOURCE).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("count")
    )
    return _null_safe_join(local, before, [*SOURCE, "chunk"]).withColumn("pos", F.col("at") + F.col("offset")).drop("at", "offset")


def _null_safe_join(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    r = b.select(*(F.col(c).alias(f"__{c}") for c in on), *(c for c in b.columns if c not in on))
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"__{c}"))
        cond = e if cond is None else cond & e
    return a.join(r, cond, how).drop(*(f"__{c}" for c in on))


def neighbours(files: DataFrame) -> DataFrame:
    """Per file and field: position of the field's previous and next file, and the type
    known before, carried over the ends of the chunks."""
    e = files.select(*SOURCE, "chunk", "pos", "file_id", F.explode("fields").alias("f")).select(
        *SOURCE, "chunk", "pos", "file_id", "f.name", "f.kind", "f.p"
    )
    key = [*SOURCE, "name"]
    w = Window.partitionBy(*key, "chunk").orderBy("pos")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    local = e.withColumn("prev", F.lag("pos").over(w)).withColumn("next", F.lead("pos").over(w)).withColumn("known", F.last("kind", True).over(past)).withColumn("old", F.lag("p").over(w))
    ends = e.groupBy(*key, "chunk").agg(
        F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.max_by("p", "pos").alias("last_p"),
        F.max_by("kind", F.when(F.col("kind").isNotNull(), F.col("pos"))).alias("last_kind"),
    )
    c = Window.partitionBy(*key).orderBy("chunk")
    carried = ends.select(
        *key, "chunk", F.lag("last_pos").over(c).alias("c_prev"), F.lead("first_pos").over(c).alias("c_next"), F.lag("last_p").over(c).alias("c_old"),
        F.last("last_kind", True).over(c.rowsBetween(Window.unboundedPreceding, -1)).alias("c_known"),
    )
    j = _null_safe_join(local, carried, [*key, "chunk"])
    return j.select(
        *SOURCE, "pos", "file_id", "name", "kind", "p",
        F.coalesce("prev", "c_prev").alias("prev"), F.coalesce("next", "c_next").alias("next"), F.coalesce("known", "c_known").alias("known"),
    )


def _words(name: str) -> set[str]:
    return {w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()) if w}


def rename_score(a: dict, b: dict) -> float:
    """How far the contents of two fields are of one kind, 0 to 1; names only break ties."""
    ka, kb = a["kind"], b["kind"]
    wa, wb = _words(a["name"]), _words(b["name"])
    names = len(wa & wb) / max(1, len(wa | wb))
    if ka and kb and ka != kb:
        return 0.0
    if not ka or not kb:
        return 0.3 + 0.5 * names
    same = 0.5
    if ka == "array":
        same = 0.75 if a["parts"] == b["parts"] else 0.1
    elif ka == "string":
        if a["shape"] != b["shape"]:
            same = 0.2
        elif a["shape"] in ("a", ""):  # plain words: some of them have to come again
            same = 0.75 if set(a["words"]) & set(b["words"]) else 0.35
        else:
            same = 0.75
    elif ka == "number":
        whole = abs((a["whole"] or 0) - (b["whole"] or 0)) < 0.6
        size = abs(math.log10((a["size"] or 0) + 1e-3) - math.log10((b["size"] or 0) + 1e-3))
        same = 0.75 - 0.45 * min(1.0, size) - (0.0 if whole else 0.3)
    return max(0.0, same) + 0.24 * names


def match_renames(gone: list[dict], come: list[dict]) -> tuple[list[tuple[str, str]], list[str], list[str]]:
    """Greedy one-to-one pairs of gone and come fields of one file, best score first."""
    pairs = sorted(((-rename_score(a, b), a["name"], b["name"]) for a in gone for b in come))
    used_a, used_b, out = set(), set(), []
    for s, a, b in pairs:
        if -s >= RENAME_SCORE and a not in used_a and b not in used_b:
            out.append((a, b))
            used_a.add(a)
            used_b.add(b)
    return out, [a["name"] for a in gone if a["name"] not in used_a], [b["name"] for b in come if b["name"] not in used_b]


def _pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        rows = []
        for source, stream, file_id, gone, come in df.itertuples(index=False):
            flat = lambda x: [{"name": r["name"], "kind": r["kind"], **dict(r["p"].items())} for r in (x if x is not None else [])]
            r, a, b = match_renames(flat(gone), flat(come))
            rows += [(source, stream, file_id, "renamed", o, n) for o, n in r]
            rows += [(source, stream, file_id, "removed", o, "") for o in a] + [(source, stream, file_id, "added", "", n) for n in b]
        yield pd.DataFrame(rows, columns=["recorder_id", "stream_name", "file_id", "change_kind", "old_field", "new_field"])


def changes(raw_files: DataFrame) -> DataFrame:
    """(recorder_id, stream_name, file_id, change_kind, old_field, new_field) of every file."""
    return changes_of(*prepared(raw_files))


def prepared(raw_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The files in order and their fields with neighbours, both written."""
    files = stage(chunks(fingerprints(raw_files)), "files")
    return files, stage(neighbours(files), "neighbours")


def changes_of(files: DataFrame, n: DataFrame) -> DataFrame:
    field = F.struct("name", "kind", "p")
    come = n.where((F.col("pos") > 0) & (F.col("prev").isNull() | (F.col("prev") < F.col("pos") - 1))).groupBy("file_id").agg(F.collect_list(field).alias("come"))
    with_known = F.struct("name", F.coalesce("kind", "known").alias("kind"), "p")
    left = n.where(F.col("next").isNull() | (F.col("next") > F.col("pos") + 1)).select(*SOURCE, (F.col("pos") + 1).alias("pos"), with_known.alias("f"))
    at = files.select(*SOURCE, "pos", "file_id")
    gone = _null_safe_join(left, at, [*SOURCE, "pos"]).groupBy("file_id").agg(F.collect_list("f").alias("gone"))
    both = at.join(gone, "file_id", "left").join(come, "file_id", "left").where("gone is not null or come is not null")
    schema = "recorder_id string, stream_name string, file_id long, change_kind string, old_field string, new_field string"
    moved = both.select(*SOURCE, "file_id", "gone", "come").mapInPandas(_pair, schema)
    retyped = n.where((F.col("prev") == F.col("pos") - 1) & (F.col("kind") != F.col("known"))).select(
        *SOURCE, "file_id", F.lit("retyped").alias("change_kind"), F.col("name").alias("old_field"), F.col("name").alias("new_field")
    )
    return moved.unionByName(retyped)


def found(raw_files: DataFrame) -> DataFrame:
    return changes(raw_files).select("file_id", "change_kind", "old_field", "new_field")


#: Target fields of the streams with their kinds (fixed by the data's contract).
TARGETS = {
    "robot_state_rt": {"record_index": "long", "source_stamp": "double", "external_tcp_force": "vector", "raw_force_torque": "vector", "robot_mode": "string"},
    "gripper_state": {"record_index": "long", "source_stamp": "double", "gripper_position": "double", "gripper_width_m": "double", "gripper_command": "string", "placeholder": "boolean"},
}


def versions(raw_files: DataFrame) -> DataFrame:
    """(file_id, recorder_id, stream_name, version, fingerprint): the schema fingerprint of every
    file (its fields and their types, as last known) and the version it makes in its source: how
    often the fingerprint changed before."""
    return versions_of(*prepared(raw_files))


def versions_of(files: DataFrame, n: DataFrame) -> DataFrame:
    told = F.concat("name", F.lit(":"), F.coalesce("kind", "known", F.lit("?")))
    prints = n.groupBy("file_id").agg(F.sha2(F.array_join(F.sort_array(F.collect_list(told)), ","), 256).alias("fingerprint"))
    f = stage(files.select(*SOURCE, "chunk", "pos", "file_id").join(prints, "file_id"), "fingerprinted")
    # what a chunk ends with is carried over its end; then changes are counted chunk by chunk
    c = Window.partitionBy(*SOURCE).orderBy("chunk")
    ends = f.groupBy(*SOURCE, "chunk").agg(F.max_by("fingerprint", "pos").alias("last")).select(*SOURCE, "chunk", F.lag("last").over(c).alias("before"))
    w = Window.partitionBy(*SOURCE, "chunk").orderBy("pos")
    f = _null_safe_join(f, ends, [*SOURCE, "chunk"]).withColumn("old", F.coalesce(F.lag("fingerprint").over(w), "before"))
    f = f.withColumn("new", F.coalesce((F.col("old") != F.col("fingerprint")).cast("long"), F.lit(0)))
    sums = f.groupBy(*SOURCE, "chunk").agg(F.sum("new").alias("s")).select(*SOURCE, "chunk", F.coalesce(F.sum("s").over(c.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("past"))
    return _null_safe_join(f, sums, [*SOURCE, "chunk"]).select("file_id", *SOURCE, (F.col("past") + F.sum("new").over(w)).alias("version"), "fingerprint")


def routes(raw_files: DataFrame) -> DataFrame:
    """(file_id, name, target): which target every field of every file stands for.

    A field under one name, from the file it comes in to the one it goes after, is a spell. A
    rename makes the new spell follow the old one of its source, so chains of spells run on in
    time, each in its own recorder. A chain is what its spells named like a target say (the
    last of them); a chain without one is what most chains of the stream call its name."""
    files, n = prepared(raw_files)
    return routes_of(files, n, changes_of(files, n))


def routes_of(files: DataFrame, n: DataFrame, change_log: DataFrame) -> DataFrame:
    from tracewright.operators.actions import with_last_valid

    key = F.to_json(F.struct(*SOURCE, "name"))
    begins = F.when(F.col("prev").isNull() | (F.col("prev") < F.col("pos") - 1), F.col("pos"))
    f = n.select(*SOURCE, "pos", "file_id", "name", key.alias("track"), begins.alias("start"))
    f = with_last_valid(f, "track", "pos", ["start"]).withColumn("start", F.coalesce("start", "last_start")).drop("last_start")
    f = stage(f.withColumn("spell", F.xxhash64("track", "start")), "spells")
    at = files.select("file_id", F.col("pos").alias("new_pos"))
    links = change_log.where("change_kind = 'renamed'").join(at, "file_id").select(*SOURCE, F.col("old_field").alias("name"), (F.col("new_pos") - 1).alias("pos"), F.col("new_field"), "file_id")
    old = _null_safe_join(links, f.select(*SOURCE, "name", "pos", "spell"), [*SOURCE, "name", "pos"]).select("file_id", F.col("new_field").alias("name"), F.col("spell").alias("up"))
    new = f.select("file_id", "name", "spell").join(old, ["file_id", "name"]).select("spell", "up")
    # chains are paths: every spell finds its first one by doubling
    up = stage(new, "spell-links")
    while True:
        higher = up.select(F.col("spell").alias("up"), F.col("up").alias("top"))
        nxt = stage(up.join(higher, "up", "left").select("spell", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "spell-links")
        up = nxt.select("spell", "up")
        if nxt.where("moved").isEmpty():
            break
    is_target = F.lit(False)
    for stream, fields in TARGETS.items():
        is_target = is_target | ((F.col("stream_name") == stream) & F.col("name").isin(list(fields)))
    spells = f.groupBy(*SOURCE, "name", "spell").agg(F.min("pos").alias("pos")).join(up, "spell", "left").withColumn("chain", F.coalesce("up", "spell")).withColumn("own", F.coalesce(is_target, F.lit(False)))
    spells = stage(spells, "chains")
    says = spells.where("own").groupBy("chain").agg(F.max_by("name", "pos").alias("says"))
    told = stage(spells.join(says, "chain", "left"), "told")
    votes = told.where("says is not null").groupBy("stream_name", "name", "says").agg(F.count("*").alias("n"))
    usual = votes.groupBy("stream_name", "name").agg(F.max_by("says", F.struct("n", "says")).alias("usual"))
    target = F.coalesce(F.when(F.col("own"), F.col("name")), F.col("says"), F.col("usual"))
    known = told.join(usual, ["stream_name", "name"], "left").select("spell", target.alias("target")).where("target is not null")
    return f.join(known, "spell").select("file_id", "name", "target")


def _cast(text: Column, kind: str) -> Column:
    """A value's JSON text as the target's kind; what cannot be cast is null."""
    inner = F.regexp_replace(text, r'[\[\]"\s]', "")
    if kind == "vector":
        return F.when(F.length(inner) > 0, F.transform(F.split(inner, ","), lambda x: x.try_cast("double")))
    if kind in ("double", "long"):
        n = F.coalesce(inner.try_cast("double"), F.when(inner == "true", 1.0).when(inner == "false", 0.0))
        return n if kind == "double" else n.cast("long")
    if kind == "boolean":
        return F.when(F.lower(inner).isin("true", "1", "1.0", "yes"), True).when(F.lower(inner).isin("false", "0", "0.0", "no"), False)
    return text


def unified(raw_files: DataFrame, stream: str, route: DataFrame | None = None) -> DataFrame:
    """One table of a stream: every record line with the target fields (renamed by its file's
    route, cast, null where absent) and, as JSON texts, all other values in ``others``: fields
    without a target, and values whose target another field of the record fills already (the
    target's own name goes first, then by name)."""
    route = routes(raw_files) if route is None else route
    per_file = route.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "target"))).alias("route"))
    lines = json_lines(raw_files.where((F.col("stream_name") == stream) & F.col("file_id").isNotNull()).select("file_id", "recorder_id", "written_at", "content"))
    j = lines.withColumn("all", F.from_json(F.to_json("v"), "map<string,string>")).drop("v").join(per_file, "file_id", "left")
    target = lambda k: F.try_element_at("route", k)
    holds = lambda t: lambda k: F.coalesce(target(k) == t, F.lit(False)) & F.try_element_at("all", k).isNotNull()
    ranked = lambda t: lambda k: F.struct((k != t).alias("later"), k.alias("name"))
    for t in TARGETS[stream]:
        j = j.withColumn(f"__{t}", F.array_min(F.transform(F.filter(F.map_keys("all"), holds(t)), ranked(t)))["name"])
    chosen = F.array_compact(F.array(*(F.col(f"__{t}") for t in TARGETS[stream])))
    empty = F.map_filter("all", lambda k, v: ~F.array_contains(chosen, k) & ~(target(k).isNotNull() & v.isNull()))
    value = lambda t: F.try_element_at("all", F.col(f"__{t}"))
    cols = [_cast(F.when(F.col(f"__{t}").isNotNull(), value(t)), kind).alias(t) for t, kind in TARGETS[stream].items()]
    return j.select("file_id", "line_no", "recorder_id", "written_at", *cols, empty.alias("others"))
