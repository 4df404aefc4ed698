"""Pairing records with the nearest record in time of the same entity, by expanding rings.

Stamps of both sides fall into buckets of the entity's own width, four rings wide. In a
round a right stamp stands in its bucket and, if it is within a ring of the border, in the
adjacent one too; whatever lies within a ring of a left stamp meets it, so a match no
further than that is provably the nearest and is accepted. Stamps without one go on to
rings and buckets of twice the width, up to the tolerance.
The first width is a fraction of the tolerance, so few pairs are formed, and equal stamps
are collapsed first on both sides, so a hot stamp costs one row.

Defined results: rows without a stamp or entity have no match; at equal distance the
smallest right id wins; repeated rows each get the same match; an empty side gives no rows.
Extra columns, also of clashing names, are unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.stamps import episode_fps, finite, stamp_seconds
from tracewright.session import broadcast_if_small, stage

#: First bucket width as a fraction of the tolerance (a power of 1/2).
FIRST = 0.25
NO_FPS_TOLERANCE = 0.02
#: Streams of each view; a spare camera belongs to no view.
VIEWS = {"external": ["external_camera_1", "external_camera"], "tcp": ["tcp_camera", "wrist_camera"]}


def ring_join(left: DataFrame, right: DataFrame, first: float = FIRST) -> DataFrame:
    """Nearest right stamp of every left stamp.

    ``left``: entity, t, tol (distinct stamps); ``right``: entity, t, id. Returns entity,
    t, id, distance for the left stamps that have a match within their tolerance. The
    width of a round is known on both sides because it hangs on the entity's tolerance,
    which ``right`` has too (column tol)."""
    points = stage(
        right.where(F.col("t").isNotNull()).groupBy("entity", "t").agg(F.min("id").alias("id"), F.max("tol").alias("tol")), "ring-right"
    )
    todo = left.where(F.col("t").isNotNull())
    done = None
    width = first
    while True:
        last = width >= 1.0
        # a hair wider, so that rounding in the bucket number can do no harm
        w = F.col("tol") * (width * (1 + 1e-6))
        at = lambda x: F.floor(x / (w * 4)).cast("long")
        a = todo.select("entity", "t", "tol", at(F.col("t")).alias("bucket"))
        # whatever lies within a width of a right stamp is in its bucket or the adjacent one
        near = F.array_distinct(F.array(at(F.col("t") - w), at(F.col("t") + w)))
        b = points.select("entity", F.col("t").alias("rt"), "id", F.explode(near).alias("bucket"))
        d = F.abs(F.col("t") - F.col("rt"))
        pairs = a.join(b, ["entity", "bucket"], "left")
        reach = F.col("tol") if last else F.col("tol") * width
        best = F.min(F.when(d <= reach, F.struct(d.alias("d"), F.col("id").alias("id"))))
        met = pairs.groupBy("entity", "bucket", "t", "tol").agg(best.alias("best"))
        if last:
            out = met.where("best is not null").select("entity", "t", "best.id", F.col("best.d").alias("distance"))
            return out if done is None else done.unionByName(out)
        met = stage(met.select("entity", "t", "tol", "best"), "ring")
        got = met.where("best is not null").select("entity", "t", "best.id", F.col("best.d").alias("distance"))
        done = got if done is None else done.unionByName(got)
        todo = met.where("best is null").select("entity", "t", "tol")
        width *= 2


def tolerances(metadata: DataFrame) -> DataFrame:
    """(episode_id, tol) of the episodes with a positive fps: half a frame."""
    return episode_fps(metadata).select("episode_id", (F.lit(0.5) / F.col("fps")).alias("tol"))


def frame_cameras(frames: DataFrame, camera_index: DataFrame, metadata: DataFrame) -> DataFrame:
    """(frame_row_id, view, camera_row_id, distance): for each frames row and view the
    nearest camera record of the episode within the tolerance."""
    tol = broadcast_if_small(stage(tolerances(metadata), "tolerances"), 40)
    view = F.coalesce(*(F.when(F.col("stream_name").isin(s), F.lit(v)) for v, s in VIEWS.items()))
    entity = lambda v: F.struct(F.col("episode_id"), v.alias("view"))
    with_tol = lambda df: df.join(tol, "episode_id", "left").withColumn("tol", F.coalesce("tol", F.lit(NO_FPS_TOLERANCE)))
    right = with_tol(
        camera_index.where(view.isNotNull() & F.col("episode_id").isNotNull()).select(
            "episode_id", view.alias("view"), stamp_seconds(F.col("source_stamp")).alias("t"), F.col("camera_row_id").alias("id")
        )
    ).select(entity(F.col("view")).alias("entity"), "t", "id", "tol")
    stamped = frames.where(finite(F.col("timestamp")) & F.col("episode_id").isNotNull())
    stamps = with_tol(stamped.select("episode_id", F.col("timestamp").alias("t")).distinct())
    left = stamps.select(
        F.explode(F.array(*(entity(F.lit(v)) for v in VIEWS))).alias("entity"), "t", "tol"
    )
    near = ring_join(left, right).select(
        F.col("entity.episode_id").alias("episode_id"), F.col("entity.view").alias("view"), F.col("t").alias("timestamp"), F.col("id").alias("camera_row_id"), "distance"
    )
    return stamped.select("frame_row_id", "episode_id", "timestamp").join(near, ["episode_id", "timestamp"]).select("frame_row_id", "view", "camera_row_id", "distance")


def found(frames: DataFrame, camera_index: DataFrame, metadata: DataFrame) -> DataFrame:
    return frame_cameras(frames, camera_index, metadata).select("frame_row_id", "camera_row_id")
