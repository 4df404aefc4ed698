"""Writing results: documents, lines, tables, staged images, reports. Nothing that exists
is overwritten unless asked for, and no output lies inside its own input."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_output(out: str, source: str | None = None, overwrite: bool = False) -> None:
    """Refuses an output inside the input or around it, one that is no folder, and one that
    exists already."""
    o = os.path.abspath(out)
    if source is not None:
        s = os.path.abspath(source)
        if o == s or o.startswith(s + os.sep) or s.startswith(o + os.sep):
            raise ValueError("output and input must not contain one another")
    if os.path.exists(o):
        if not os.path.isdir(o):
            raise ValueError("output exists and is no folder")
        if os.path.commonpath([o, os.getcwd()]) == o:
            raise ValueError("refusing to replace the working folder or one around it")
        if not overwrite:
            raise FileExistsError(out)


def write_document(df: DataFrame, path: str, sort_keys: bool = False) -> None:
    """A result of one row as an indented JSON document."""
    rows = df.limit(2).toJSON().collect()
    if len(rows) != 1:
        raise ValueError("a document comes from a result of one row")
    with open(path, "w") as f:
        f.write(json.dumps(json.loads(rows[0]), indent=2, sort_keys=sort_keys, ensure_ascii=False) + "\n")


def write_lines(df: DataFrame, out: str, overwrite: bool = False) -> None:
    """JSON lines, null fields kept."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", False).json(out)


def write_csv(df: DataFrame, out: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(out)


def write_episode_files(frames: DataFrame, root: str, columns: list[str]) -> DataFrame:
    """One Parquet file an episode under its exact name; a row of status per episode, so a
    failing episode stops no other. Long episodes go in row groups, batch by batch, in the
    order of their frames: ``frames`` has episode_index, path and the columns."""
    spark = frames.sparkSession
    sc = spark.sparkContext.broadcast((root, columns))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        base, cols = sc.value
        writers: dict[str, pq.ParquetWriter] = {}
        status: dict[str, list] = {}
        for b in batches:
            for (e, path), g in b.groupby(["episode_index", "path"], sort=False):
                s = status.setdefault(path, [int(e), path, 0, None])
                if s[3]:
                    continue
                try:
                    full = os.path.join(base, path)
                    t = pa.Table.from_pandas(g[cols], preserve_index=False)
                    if path not in writers:
                        os.makedirs(os.path.dirname(full), exist_ok=True)
                        writers[path] = pq.ParquetWriter(full + ".part", t.schema)
                    writers[path].write_table(t)
                    s[2] += len(g)
                except Exception as error:  # reported, the other episodes go on
                    s[3] = str(error)[:200]
        for path, w in writers.items():
            w.close()
            if not status[path][3]:
                os.replace(os.path.join(base, path) + ".part", os.path.join(base, path))
        yield pd.DataFrame(list(status.values()), columns=["episode_index", "path", "frames", "error"])

    placed = frames.select("episode_index", "path", "frame_index", *[c for c in columns if c not in ("episode_index", "path", "frame_index")])
    return placed.repartition("episode_index").sortWithinPartitions("episode_index", "frame_index").mapInPandas(write, "episode_index long, path string, frames long, error string")


def staged_images(frames: DataFrame, key: str, column: str) -> DataFrame:
    """(source, target) of the images to stage: image_staging/<key>/<episode>/<ordinal>."""
    suffix = F.concat(F.lit("."), F.element_at(F.split(F.col(column), r"\."), -1))
    target = F.concat(F.lit(f"image_staging/{key}/"), F.col("episode_id"), F.lit("/"), F.lpad(F.col("ordinal").cast("string"), 6, "0"), suffix)
    return frames.where(F.length(column) > 0).select(F.col(column).alias("source"), target.alias("target"))


def stage_images(pairs: DataFrame, source_root: str, out_root: str, mode: str = "symlink") -> DataFrame:
    """Links or copies the images on the executors; a row of status per image."""
    if mode not in ("symlink", "copy"):
        raise ValueError("mode must be symlink or copy")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            errors = []
            for s, t in zip(b["source"], b["target"]):
                src, dst = os.path.join(source_root, s), os.path.join(out_root, t)
                try:
                    os.makedirs(os.path.dirname(dst), exist_ok=True)
                    if os.path.lexists(dst):
                        if os.path.isdir(dst) and not os.path.islink(dst):
                            raise IsADirectoryError(dst)
                        os.unlink(dst)
                    os.symlink(src, dst) if mode == "symlink" else shutil.copyfile(src, dst)
                    errors.append(None)
                except OSError as e:
                    errors.append(str(e)[:200])
            yield b.assign(error=errors)

    return pairs.mapInPandas(put, "source string, target string, error string")


def attempt_report(status: DataFrame, expected: int) -> DataFrame:
    """One row: episodes written, frames, failures, and whether all came through."""
    return status.agg(
        F.count(F.when(F.col("error").isNull(), 1)).alias("episodes"),
        F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"),
        F.count(F.when(F.col("error").isNotNull(), 1)).alias("failures"),
    ).withColumn("success", (F.col("episodes") == expected) & (F.col("failures") == 0))


def adapted_info(info: dict, kind: str) -> dict:
    """Dataset metadata with the data path and image types of what was really written."""
    out = json.loads(json.dumps(info))
    suffix = ".parquet" if kind == "parquet" else ".jsonl.placeholder"
    out["data_path"] = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}" + suffix
    for f in out.get("features", {}).values():
        if f.get("dtype") == "image" and kind == "parquet":
            f["dtype"] = "video"
    return out
