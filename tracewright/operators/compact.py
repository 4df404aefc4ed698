"""Many tiny files into few well-sized ones, every record once.

Lines of small JSONL files are parsed; repeated records (the same canonical key, however
written) are left out but the first. The records go through an adaptive REBALANCE shuffle,
whose output partitions AQE merges or splits near the advisory size, into a folder beside
the target. It is committed (renamed) only after a multiset checksum of the written records
equals that of the distinct records read; otherwise it is removed and an error raised.

Defined results: blank lines and lines that are not one whole JSON object are no records
but count for line numbers; null or empty contents hold no lines; files without an id are passed over; missing or null keys are
equal to each other; a key of any number of copies is met by an anti join on line identity,
so copies never gather in one task; extra columns are unread.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.session import Staged, remove_path, scratch_path

TARGET_BYTES = 128 << 20


def json_lines(files: DataFrame) -> DataFrame:
    """(file columns but content, line_no, v): the whole JSON objects of the files' lines."""
    lines = files.select(
        *(c for c in files.columns if c not in ("content", "line_no", "v")), F.posexplode(F.split("content", "\n")).alias("pos", "line")
    )
    v = F.try_parse_json(F.trim("line"))
    return (
        lines.where(F.trim(F.col("line")).startswith("{"))
        .withColumn("v", v)
        .where(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))
        .withColumn("line_no", (F.col("pos") + 1).cast("bigint"))
        .drop("pos", "line")
    )


def path_in_episode(path: Column, episode: Column) -> Column:
    """An image path relative to its episode's directory, without empty or dot steps."""
    p = F.regexp_replace(F.regexp_replace(F.trim(path), r"\\", "/"), r"/(?:\./|/)*", "/")
    p = F.regexp_replace(F.concat(F.lit("/"), p), r"^/(?:\.?/)*", "/")
    at = F.instr(F.lower(p), F.concat(F.lit("/"), episode, F.lit("/")))
    return F.when((at > 0) & (F.length(episode) > 0), F.substr(p, at + F.length(episode) + 2, F.length(p))).otherwise(F.substr(p, F.lit(2), F.length(p)))


def frame_records(raw_files: DataFrame) -> DataFrame:
    """Frame records with their canonical identity and where each was read."""
    get = lambda k: F.try_variant_get("v", f"$.{k}", "string")
    r = json_lines(raw_files.where((F.col("stream_name") == "frames") & F.col("file_id").isNotNull()).select("file_id", "content")).select(
        "file_id",
        "line_no",
        F.lower(F.trim(get("episode_id"))).alias("episode_id"),
        get("frame_index").alias("frame_text"),
        get("timestamp").try_cast("double").alias("timestamp"),
        get("external_rgb_path").alias("external_rgb_path"),
        get("tcp_rgb_path").alias("tcp_rgb_path"),
    )
    ep = F.coalesce("episode_id", F.lit(""))
    number = F.col("frame_text").try_cast("double").cast("long")
    return r.select(
        "file_id", "line_no", "episode_id", F.coalesce(number.cast("string"), "frame_text").alias("frame_number"), number.alias("frame_index"), "timestamp",
        path_in_episode(F.col("external_rgb_path"), ep).alias("external_rgb_path"),
        path_in_episode(F.col("tcp_rgb_path"), ep).alias("tcp_rgb_path"),
    )


KEY = ("episode_id", "frame_number", "external_rgb_path", "tcp_rgb_path")


def first_lines(records: DataFrame, key=KEY) -> DataFrame:
    """(file_id, line_no) of the first line of every distinct record."""
    return records.groupBy(*key).agg(F.min(F.struct("file_id", "line_no")).alias("at")).select("at.file_id", "at.line_no")


def checksum(records: DataFrame, key=KEY) -> tuple:
    """Multiset checksum: count and two sums of independent hashes of the key."""
    a = F.xxhash64(*key).cast("decimal(38,0)")
    b = F.crc32(F.to_json(F.struct(*key)))
    r = records.agg(F.count("*").alias("n"), F.sum(a).alias("a"), F.sum(b).alias("b")).first()
    return r["n"], r["a"], r["b"]


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def consolidate(records: DataFrame, out: str, target_bytes: int = TARGET_BYTES, key=KEY, expect: tuple | None = None) -> DataFrame:
    """Writes records into files near ``target_bytes`` at ``out`` and returns them read
    back. Nothing appears at ``out`` unless the checksums agree, and a table that stood there
    stays, at ``out`` or beside it with the ending .old, until the new one is in its place.
    The target size is a setting of the session while this writes."""
    spark = records.sparkSession
    part = f"{out.rstrip('/')}.part"
    with _conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes), "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}):
        records.hint("rebalance").write.mode("overwrite").parquet(part)
    wrote = checksum(spark.read.schema(records.schema).parquet(part), key)
    want = expect or checksum(records, key)
    if wrote != want:
        remove_path(spark, part)
        raise RuntimeError(f"consolidation lost or doubled records: read {want}, wrote {wrote}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{out.rstrip('/')}.old"
    # the old table is put aside, not deleted, until the new one is in its place
    if fs.exists(path(out)):
        fs.delete(path(old), True)
        if not fs.rename(path(out), path(old)):
            raise RuntimeError(f"could not put {out} aside")
    if not fs.rename(path(part), path(out)):
        if fs.exists(path(old)):
            fs.rename(path(old), path(out))
        raise RuntimeError(f"could not commit {out}")
    fs.delete(path(old), True)
    return spark.read.schema(records.schema).parquet(out)


def compact_frames(raw_files: DataFrame, out: str | None = None, target_bytes: int = TARGET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(all record lines, consolidated table of the distinct records)."""
    spark = raw_files.sparkSession
    lines = Staged(frame_records(raw_files), "frame-lines").df
    first = Staged(first_lines(lines), "frame-firsts").df
    once = lines.join(first, ["file_id", "line_no"], "left_semi")
    distinct = checksum(lines.groupBy(*KEY).count())
    return lines, consolidate(once, out or scratch_path(spark, "frames-compact"), target_bytes, expect=distinct)


def found(raw_files: DataFrame) -> DataFrame:
    """(file_id, line_no) of the lines that repeat a record: those not in the output."""
    lines, table = compact_frames(raw_files)
    return lines.join(table, ["file_id", "line_no"], "left_anti").select("file_id", "line_no")
