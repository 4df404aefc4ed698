"""Irregular readings onto a regular grid, gaps filled by low-rank factorisation.

A reading at t belongs to grid point floor(t * fps + 0.5) of its source (an episode's
stream); of several the one nearest to the point holds (ties: the smaller row id). Between
consecutive valid readings at most ``STOP_S`` apart every grid point without a reading is
missing; a longer pause is a stop of the recording and has no grid points.

Missing cells are filled by alternating least squares. The matrix has one row per source
component and stretch of ``WINDOW`` grid points, and one column per place in the stretch;
row factors are solved where the row lies, and the column factors (WINDOW x RANK numbers a
stream) from normal equations that are summed over all rows, so any number of rows and any
length of an episode spread evenly. Observed cells come out exact; a missing cell whose
row has fewer than ``SUPPORT`` observed cells stays empty and is marked ``unsupported``.

Defined results: readings without a stamp, with a vector that is not six finite numbers or
without an episode are no readings; repeated rows change nothing; sources of one reading
have one grid point; empty tables give an empty result; extra columns are unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.stamps import DEFAULT_FPS, episode_fps, finite, finite_vector, stamp_seconds
from tracewright.session import broadcast_if_small, stage

STOP_S = 20.0
WINDOW, RANK, SUPPORT = 32, 4, 6
ROUNDS, RIDGE = 4, 1e-2


def joint_readings(joint_states: DataFrame) -> DataFrame:
    """(table_name, episode_id, row_id, t, vals) of the valid joint velocity readings."""
    return joint_states.where(finite_vector(F.col("velocity"), 6)).select(
        F.lit("joint_states").alias("table_name"), "episode_id", F.col("joint_row_id").alias("row_id"), stamp_seconds(F.col("source_stamp")).alias("t"), F.col("velocity").alias("vals")
    )


def frame_readings(frames: DataFrame) -> DataFrame:
    """The valid frame stamps; their value is the stamp's offset from its grid point."""
    return frames.where(finite(F.col("timestamp"))).select(
        F.lit("frames").alias("table_name"), "episode_id", F.col("frame_row_id").alias("row_id"), F.col("timestamp").alias("t"), F.lit(None).cast("array<double>").alias("vals")
    )


def _span(fps: Column) -> Column:
    """Grid points of a stretch of work: whole windows, longer than any gap to be filled."""
    return F.lit(WINDOW) * (F.floor(fps * STOP_S / WINDOW) + 2)


def cells(readings: DataFrame, metadata: DataFrame) -> DataFrame:
    """(table_name, episode_id, fps, k, observed, vals): every grid point of every source.

    Work is split into stretches longer than STOP_S, and each stretch knows the last
    reading before and the first after it, so an episode of any length spreads."""
    fps = broadcast_if_small(stage(episode_fps(metadata).where(F.col("fps") != DEFAULT_FPS), "fps"), 40)
    r = (
        readings.where(F.col("t").isNotNull() & F.col("episode_id").isNotNull())
        .join(fps, "episode_id", "left")
        .withColumn("fps", F.coalesce("fps", F.lit(DEFAULT_FPS)))
        .withColumn("k", F.floor(F.col("t") * F.col("fps") + 0.5).cast("long"))
        .withColumn("vals", F.coalesce("vals", F.array(F.col("t") - F.col("k") / F.col("fps"))))
        .withColumn("part", F.floor(F.col("k") / _span(F.col("fps"))).cast("long"))
        .select("table_name", "episode_id", "fps", "part", "k", "t", "row_id", "vals")
    )
    key = ["table_name", "episode_id", "part"]
    ends = r.groupBy(*key, "fps").agg(
        F.min("t").alias("t0"), F.max("t").alias("t1"), F.min("k").alias("k0"), F.max("k").alias("k1")
    )
    none = F.lit(None)
    guard = lambda step, k, t: ends.select(
        "table_name", "episode_id", "fps", (F.col("part") + step).alias("part"), F.col(k).alias("k"), F.col(t).alias("t"), none.cast("long").alias("row_id"), none.cast("array<double>").alias("vals")
    )
    near = F.struct(F.abs(F.col("t") - F.col("k") / F.col("fps")), "row_id")
    points = (
        r.unionByName(guard(1, "k1", "t1"))
        .unionByName(guard(-1, "k0", "t0"))
        .repartition(*key)
        .groupBy(*key, "fps", "k")
        .agg(F.min("t").alias("ta"), F.max("t").alias("tb"), F.min_by("vals", F.when(F.col("row_id").isNotNull(), near)).alias("vals"))
    )
    w = Window.partitionBy(*key).orderBy("k")
    lo = F.col("part") * _span(F.col("fps"))
    hi = lo + _span(F.col("fps")) - 1
    gap = points.withColumn("pk", F.lag("k").over(w)).withColumn("pt", F.lag("tb").over(w))
    own = F.when(F.col("vals").isNotNull(), F.array(F.col("k")))
    a, b = F.greatest(F.col("pk") + 1, lo), F.least(F.col("k") - 1, hi)
    hole = F.when((F.col("ta") - F.col("pt") <= STOP_S) & (a <= b), F.sequence(a, b))
    return gap.select(
        "table_name", "episode_id", "part", "fps", "vals", F.explode(F.concat(F.coalesce(own, F.array().cast("array<bigint>")), F.coalesce(hole, F.array().cast("array<bigint>")))).alias("g"), "k"
    ).select(
        *key, "fps", F.col("g").alias("k"), (F.col("g") == F.col("k")).alias("observed"), F.when(F.col("g") == F.col("k"), F.col("vals")).alias("vals")
    )


def windows(c: DataFrame) -> DataFrame:
    """One row per stretch of WINDOW grid points: places, which are observed, and the
    observed vectors end to end. ``part`` keeps the rows where they are."""
    return (
        c.groupBy("table_name", "episode_id", "part", "fps", F.floor(F.col("k") / WINDOW).cast("long").alias("win"))
        .agg(
            F.collect_list(F.struct((F.col("k") % WINDOW).cast("int").alias("p"), F.col("observed").alias("o"), F.col("vals").alias("v"))).alias("s")
        )
        .select(
            "table_name", "episode_id", "fps", "win", F.col("s.p").alias("place"), F.col("s.o").alias("observed"),
            F.flatten(F.filter(F.col("s.v"), lambda x: x.isNotNull())).alias("vals"),
        )
    )


class Matrix:
    """Rows of a batch for one stream: x is rows x WINDOW, NaN where not observed."""

    def __init__(self, t: pa.Table):
        place = t["place"].combine_chunks()
        n = np.diff(np.asarray(place.offsets))
        place = place.flatten().to_numpy(zero_copy_only=False)
        self.place = place
        self.row = np.repeat(np.arange(len(n)), n)
        self.obs = t["observed"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
        vals = t["vals"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.width = max(1, len(vals) // max(1, int(self.obs.sum())))
        x = np.full((len(n), WINDOW, self.width), np.nan)
        x[self.row[self.obs], place[self.obs]] = vals.reshape(-1, self.width)
        self.rows = len(n)
        self.x = x.transpose(0, 2, 1).reshape(-1, WINDOW)
        self.m = ~np.isnan(self.x)
        filled = np.where(self.m, self.x, 0.0)
        # rows are brought to one size, so that a source's unit has no weight
        size = np.sqrt((filled**2).sum(1) / np.maximum(self.m.sum(1), 1))
        self.size = np.where(size > 0, size, 1.0)
        self.y = filled / self.size[:, None]

    def rows_of(self, v: np.ndarray) -> np.ndarray:
        """Least-squares row factors for the column factors v."""
        vv = np.einsum("ti,tj->tij", v, v).reshape(WINDOW, -1)
        a = (self.m @ vv).reshape(-1, RANK, RANK) + RIDGE * np.eye(RANK)
        return np.linalg.solve(a, (self.y @ v)[:, :, None])[:, :, 0]


def _streams(b: pa.RecordBatch) -> Iterator[tuple[str, pa.Table]]:
    t = pa.Table.from_batches([b])
    names = np.array(t["table_name"].to_pylist(), dtype=object)
    for name in sorted(set(names)):
        yield name, t.filter(pa.array(names == name))


def column_factors(w: DataFrame) -> dict[str, np.ndarray]:
    """Column factors of each stream by alternating least squares over all rows. Start:
    the lowest cosines. A round sums WINDOW small normal equations a stream."""
    start = np.cos(np.pi * np.arange(RANK)[None, :] * (np.arange(WINDOW)[:, None] + 0.5) / WINDOW)
    factors: dict[str, np.ndarray] = {}
    for _ in range(ROUNDS):
        known = dict(factors)

        def normals(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            for b in batches:
                for name, t in _streams(b):
                    x = Matrix(t)
                    u = x.rows_of(known.get(name, start))
                    uu = np.einsum("ni,nj->nij", u, u).reshape(len(u), -1)
                    a, c = sums.get(name, (0.0, 0.0))
                    sums[name] = (a + x.m.T.astype(float) @ uu, c + x.y.T @ u)
            for name, (a, c) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * WINDOW), pa.array(np.arange(WINDOW)), pa.array(np.hstack([a, c]).tolist())], ["table_name", "place", "eq"]
                )

        wide = RANK * RANK + RANK
        total = (
            w.mapInArrow(normals, "table_name string, place long, eq array<double>")
            .groupBy("table_name", "place")
            .agg(F.array(*(F.sum(F.get("eq", F.lit(i))) for i in range(wide))).alias("eq"))
            .collect()
        )
        for name in sorted({r["table_name"] for r in total}):
            v = np.zeros((WINDOW, RANK))
            for r in total:
                if r["table_name"] == name:
                    e = np.array(r["eq"])
                    v[r["place"]] = np.linalg.solve(e[: RANK * RANK].reshape(RANK, RANK) + RIDGE * np.eye(RANK), e[RANK * RANK :])
            factors[name] = v
    return factors


def fill(w: DataFrame, factors: dict[str, np.ndarray]) -> DataFrame:
    """(table_name, episode_id, fps, win, place, status, vals): every grid point with its
    values; status is observed, filled or unsupported."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, t in _streams(b):
                x = Matrix(t)
                est = x.rows_of(factors[name]) @ factors[name].T * x.size[:, None]
                out = np.where(x.m, x.x, est).reshape(x.rows, x.width, WINDOW)[x.row, :, x.place]
                supported = (x.m.sum(1) >= SUPPORT).reshape(x.rows, x.width)[x.row].all(1)
                status = np.where(x.obs, "observed", np.where(supported, "filled", "unsupported"))
                flat = pa.array(out.ravel())
                vals = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * x.width), flat)
                vals = pa.compute.if_else(pa.array(status != "unsupported"), vals, pa.scalar(None, vals.type))
                take = pa.array(x.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(x.row), pa.string()),
                        t["episode_id"].combine_chunks().take(take),
                        t["fps"].combine_chunks().take(take),
                        pa.array(t["win"].to_numpy()[x.row] * WINDOW + x.place),
                        pa.array(status.tolist(), pa.string()),
                        vals,
                    ],
                    ["table_name", "episode_id", "fps", "grid_no", "status", "vals"],
                )

    return w.mapInArrow(solve, "table_name string, episode_id string, fps double, grid_no long, status string, vals array<double>")


def regular(joint_states: DataFrame, frames: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row per grid point of both streams. For joint_states ``vals`` is the velocity;
    for frames the stamp, which is the grid time plus the factorised offset."""
    r = joint_readings(joint_states).unionByName(frame_readings(frames))
    w = stage(windows(cells(r, metadata)), "grid-windows")
    out = fill(w, column_factors(w))
    time = F.col("grid_no") / F.col("fps")
    return out.select(
        "table_name", "episode_id", "grid_no", time.alias("grid_time"), "status",
        F.when(F.col("table_name") == "frames", F.transform("vals", lambda x: x + time)).otherwise(F.col("vals")).alias("vals"),
    )


def found(joint_states: DataFrame, frames: DataFrame, metadata: DataFrame) -> DataFrame:
    """(table_name, episode_id, grid_no) of the missing grid points."""
    return regular(joint_states, frames, metadata).where(F.col("status") != "observed").select("table_name", "episode_id", "grid_no")
