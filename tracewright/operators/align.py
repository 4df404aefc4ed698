"""Streams of an episode aligned on a record index: uniqueness, joins, misses, offsets.

All joins are equi-joins on (episode, index); no side is gathered, the first ten offenders
of an episode come from bounded partial lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.stamps import finite

FIRST = 10
_SPAN = 4096


def first_by_index(df: DataFrame, key: list[str], row_id: str) -> DataFrame:
    """One row a key, that of the smallest row id (the tolerant build of a lookup)."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), row_id).alias("r")).select(*key, "r.*")


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by several rows, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def contiguity(df: DataFrame, group: str, index: str) -> DataFrame:
    """Per group: rows, distinct indexes, bounds, and whether they run from 0 without gap
    or double and are two at least. Distinct (group, index) pairs come first, so a hot
    group is spread over its indexes."""
    pairs = df.groupBy(group, index).agg(F.count("*").alias("copies"))
    g = pairs.groupBy(group).agg(
        F.sum("copies").alias("n"), F.count(index).alias("n_distinct"), F.min(index).alias("lo"), F.max(index).alias("hi")
    )
    ok = (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1) & (F.col("n") == F.col("n_distinct")) & (F.col("n") >= 2)
    return g.withColumn("contiguous", F.coalesce(ok, F.lit(False)))


def first_few(df: DataFrame, group: list[str], index: str, n: int = FIRST) -> DataFrame:
    """(group, first): the n smallest indexes of each group, joined by commas. Spans of
    indexes give their n smallest first, so no task holds a whole group."""
    cut = lambda c: F.slice(F.sort_array(c), 1, n)
    part = df.groupBy(*group, F.floor(F.col(index) / _SPAN).alias("span")).agg(cut(F.collect_set(index)).alias("s"))
    top = part.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy("span"))).where(F.col("rank") <= n)
    return top.groupBy(*group).agg(F.array_join(cut(F.flatten(F.collect_list("s"))), ",").alias("first"))


def alignment(primary: DataFrame, candidate: DataFrame, group: str = "episode_id", index: str = "record_index") -> DataFrame:
    """Per group: indexes both have, those the candidate misses and those it has beyond."""
    a = primary.select(group, index).distinct().withColumn("in_a", F.lit(1))
    b = candidate.select(group, index).distinct().withColumn("in_b", F.lit(1))
    j = a.join(b, [group, index], "full_outer")
    counts = j.groupBy(group).agg(
        F.count(F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), 1)).alias("n_common"),
        F.count(F.when(F.col("in_b").isNull(), 1)).alias("n_missing"),
        F.count(F.when(F.col("in_a").isNull(), 1)).alias("n_extra"),
    )
    missing = first_few(j.where("in_b is null"), [group], index).withColumnRenamed("first", "first_missing")
    extra = first_few(j.where("in_a is null"), [group], index).withColumnRenamed("first", "first_extra")
    return counts.join(missing, group, "left").join(extra, group, "left").withColumn("aligned", (F.col("n_missing") == 0) & (F.col("n_extra") == 0))


def tolerance(fps: Column, override: Column | None = None) -> Column:
    """Allowed offset of a camera against the robot: half a frame, 0.02 s without fps; an
    override holds up to min(0.1 s, two frames)."""
    ok = finite(fps) & (fps > 0)
    base = F.when(ok, 0.5 / fps).otherwise(0.02)
    if override is None:
        return base
    most = F.when(ok, F.least(F.lit(0.1), 2.0 / fps)).otherwise(0.1)
    return F.when(finite(override) & (override > 0) & (override <= most), override).otherwise(base)


def sync_violations(offsets: DataFrame, group: list[str], index: str = "record_index") -> DataFrame:
    """Per group the first record (by index) whose |offset| is beyond its tolerance."""
    bad = offsets.where(F.abs("offset") > F.col("tol"))
    return bad.groupBy(*group).agg(F.count("*").alias("n"), F.min(index).alias(index), F.min_by("offset", index).alias("offset"))


def offset_summary(offsets: DataFrame, group: list[str]) -> DataFrame:
    return offsets.groupBy(*group).agg(
        F.count("offset").alias("n"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.avg("offset").alias("mean_offset"), F.max(F.abs("offset")).alias("max_abs_offset")
    )


def set_sizes(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """One row: sizes of intersection and both differences of two key sets."""
    x = a.select(*key).distinct().withColumn("a", F.lit(1))
    y = b.select(*key).distinct().withColumn("b", F.lit(1))
    j = x.join(y, key, "full_outer")
    return j.agg(
        F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("n_both"),
        F.count(F.when(F.col("b").isNull(), 1)).alias("n_only_a"),
        F.count(F.when(F.col("a").isNull(), 1)).alias("n_only_b"),
    )
