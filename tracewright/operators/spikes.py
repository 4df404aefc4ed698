"""Implausible readings of vector series, judged by each source's own behaviour.

Per source (episode and field) the series is described by a running level and a robust
autoregression of the deviations from it. Additive-outlier and level-shift tests run in
rounds: a record whose innovation is far beyond the source's noise is a candidate; a
candidate whose level is still shifted after three records is a level shift (a contact, a
lasting step) and stays; the others are spikes, are taken out of the level, and the test
runs again. Runs of one and the same vector and values that are not finite or beyond the
physical range are flagged separately.

Sources are cut by place into blocks of ``BLOCK`` records with ``HALO`` records of context on
either side, so no source, and no index that many records share, has to fit into one task. The noise and the coefficient of a
source come from all its blocks (weighted mean of block values), so each block is judged
by the whole source.

Defined results: null vectors and nulls inside a vector are no cases; a vector of another
length than the field's is no case by itself; rows without episode or record index are
judged only by range; copies of a record under several row ids are judged once and flagged
all; an empty table gives an empty result; extra columns are unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import broadcast_if_small, stage

BLOCK, HALO = 384, 24
#: Half width of the running level, records before and after for the shift test.
REACH, SIDE = 5, 4
#: Innovations beyond this many robust standard deviations are candidates.
AO_Z = 14.0
MAX_SPIKE = 3
STUCK_RUN = 8
ROUNDS = 4
#: Physical range of the components, in N, Nm, m and rad (a step of one frame).
LIMITS = {
    "tcp_wrench": [1500.0] * 3 + [200.0] * 3,
    "measured_tcp_wrench": [1500.0] * 3 + [200.0] * 3,
    "measured_action": [1.0] * 3 + [6.5] * 3,
}
WIDTH = 6


def as_series(df: DataFrame, field: str, row_id: str, index: str, limits: dict[str, list[float]]) -> DataFrame:
    """(field_name, row_id, episode_id, idx, vec, bad) of one field; ``bad`` marks values
    that are not finite or out of range."""
    v = F.slice(F.col(field), 1, WIDTH)
    lim = F.array(*(F.lit(x) for x in limits[field]))
    beyond = F.exists(F.arrays_zip(v.alias("v"), lim.alias("m")), lambda s: F.coalesce(F.isnan(s["v"]) | (F.abs(s["v"]) > s["m"]), F.lit(False)))
    return df.where(F.col(field).isNotNull()).select(
        F.lit(field).alias("field_name"), F.col(row_id).alias("row_id"), "episode_id", F.col(index).cast("long").alias("idx"), v.alias("vec"), beyond.alias("bad")
    )


def ordered_records(series: DataFrame) -> DataFrame:
    """(field_name, episode_id, idx, first_id, vec, pos): the records of every source, copies
    collapsed, with their place in it (index, then row id). Records are range partitioned, and
    a source's places in a partition follow from its counts in those before, so neither a long
    source nor an index with very many records fills a task."""
    rec = (
        series.where(F.col("episode_id").isNotNull() & F.col("idx").isNotNull() & (F.size("vec") == WIDTH))
        .groupBy("field_name", "episode_id", "idx", "vec")
        .agg(F.min("row_id").alias("first_id"))
    )
    order = ["field_name", "episode_id", "idx", "first_id"]
    at = F.monotonically_increasing_id()  # partition in the upper bits, row in it in the lower ones
    rows = rec.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at)
    rows = stage(rows.select("*", F.shiftrightunsigned("at", 33).alias("part")), "records")
    source = ["field_name", "episode_id"]
    runs = rows.groupBy(*source, "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    before = Window.partitionBy(*source).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select(*source, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift")), "record-runs")
    return rows.join(broadcast_if_small(runs, 96), [*source, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def blocks(series: DataFrame) -> DataFrame:
    """One row per (field, episode, block) with the BLOCK records of the block and its halo."""
    at = F.floor(F.col("pos") / BLOCK)
    off = F.col("pos") % BLOCK
    near = F.array_compact(F.array(at, F.when((off < HALO) & (at > 0), at - 1), F.when(off >= BLOCK - HALO, at + 1)))
    return (
        ordered_records(series)
        .select("field_name", "episode_id", F.explode(near).alias("block"), "pos", "idx", "first_id", "vec")
        .groupBy("field_name", "episode_id", "block")
        .agg(F.collect_list(F.struct("pos", "idx", "vec")).alias("recs"))
        .select("field_name", "episode_id", "block", F.col("recs.pos").alias("pos"), F.col("recs.idx").alias("idx"), F.flatten("recs.vec").alias("vals"))
    )


def _numpy(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column end to end, and the length of each list."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    lens = np.diff(np.asarray(col.offsets))
    flat = col.flatten()
    if pa.types.is_floating(flat.type):
        return flat.to_numpy(zero_copy_only=False).astype(float), lens
    return flat.to_numpy(zero_copy_only=False), lens


class Series:
    """Records of many blocks end to end, each block in order."""

    def __init__(self, batch: pa.RecordBatch, limits: dict[str, list[float]]):
        t = pa.Table.from_batches([batch])
        idx, n = _numpy(t["idx"])
        pos, _ = _numpy(t["pos"])
        vals, _ = _numpy(t["vals"])
        self.group = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((pos, self.group))
        self.n, self.idx = n, idx[order]
        self.x = vals.reshape(-1, WIDTH)[order]
        self.end = np.cumsum(n)[self.group]
        self.start = self.end - n[self.group]
        block = t["block"].to_numpy()[self.group]
        self.core = pos[order] // BLOCK == block
        lim = np.array([limits[f] for f in limits])
        which = np.array([list(limits).index(f) for f in t["field_name"].to_pylist()], dtype=int)
        with np.errstate(invalid="ignore"):
            self.ok = np.isfinite(self.x) & (np.abs(self.x) <= lim[which[self.group]])

    def window(self, offsets: np.ndarray, use: np.ndarray) -> np.ndarray:
        """Values at the offsets of each record, NaN outside the block and where not used:
        records x offsets x components."""
        at = np.arange(len(self.idx))[:, None] + offsets
        inside = (at >= self.start[:, None]) & (at < self.end[:, None])
        at = np.where(inside, at, 0)
        return np.where((inside[:, :, None] & use[at]), self.x[at], np.nan)

    def level(self, use: np.ndarray) -> np.ndarray:
        """Running median of the records around, the record itself left out."""
        offsets = np.array([o for o in range(-REACH, REACH + 1) if o])
        return _median(self.window(offsets, use))


def _median(w: np.ndarray) -> np.ndarray:
    """Median over axis 1, NaN left out; NaN where nothing is left."""
    s = np.sort(w, axis=1)  # NaN go last
    k = (~np.isnan(s)).sum(1)
    lo = np.take_along_axis(s, np.maximum(k - 1, 0)[:, None, :] // 2, 1)[:, 0]
    hi = np.take_along_axis(s, (k // 2)[:, None, :].clip(max=s.shape[1] - 1), 1)[:, 0]
    return np.where(k > 0, (lo + hi) / 2, np.nan)


def _group_median(v: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Median of each group and component, NaN left out."""
    out = np.full((groups, v.shape[1]), np.nan)
    for c in range(v.shape[1]):
        ok = ~np.isnan(v[:, c])
        g, x = group[ok], v[ok, c]
        o = np.lexsort((x, g))
        g, x = g[o], x[o]
        k = np.bincount(g, minlength=groups)
        first = np.cumsum(k) - k
        has = k > 0
        out[has, c] = (x[first[has] + (k[has] - 1) // 2] + x[first[has] + k[has] // 2]) / 2
    return out


def _fit(s: Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Robust coefficient and innovation scale of each block and component."""
    g, groups = s.group, len(s.n)
    use = s.ok & ~_runs(s)[:, None]  # a stuck run shows no noise
    d = s.x - s.level(use)
    d[~use] = np.nan
    scale = 1.4826 * _group_median(np.abs(d), g, groups)
    clip = 2.5 * scale[g]
    y = np.clip(np.nan_to_num(d), -clip, clip)
    y = np.nan_to_num(y)
    same = np.r_[False, g[1:] == g[:-1]]
    prev = np.where(same[:, None], np.r_[y[:1], y[:-1]], 0.0)
    num = np.stack([np.bincount(g, y[:, c] * prev[:, c], groups) for c in range(WIDTH)], 1)
    den = np.stack([np.bincount(g, prev[:, c] ** 2, groups) for c in range(WIDTH)], 1)
    phi = np.clip(num / np.maximum(den, 1e-300), -0.8, 0.8)
    e = d - phi[g] * prev
    sigma = 1.4826 * _group_median(np.abs(e), g, groups)
    n = np.bincount(g, weights=s.core, minlength=groups)
    return phi, sigma, n


def _slices(batch: pa.RecordBatch, most: int = 30000) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with at most so many records each (one row at least)."""
    n = np.diff(np.asarray(batch.column(batch.schema.get_field_index("idx")).offsets))
    at = 0
    while at < len(n):
        k = max(1, int(np.searchsorted(np.cumsum(n[at:]), most, side="right")))
        yield batch.slice(at, k)
        at += k


def fit_blocks(batches: Iterator[pa.RecordBatch], limits: dict[str, list[float]]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in _slices(whole):
            phi, sigma, n = _fit(Series(b, limits))
            has = n > 0
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("field_name").filter(pa.array(has)),
                    b.column("episode_id").filter(pa.array(has)),
                    pa.array(n[has].astype(float)),
                    pa.array(np.nan_to_num(phi[has]).tolist(), pa.list_(pa.float64())),
                    pa.array(np.nan_to_num(sigma[has]).tolist(), pa.list_(pa.float64())),
                ],
                ["field_name", "episode_id", "n", "phi", "sigma"],
            )


def _runs(s: Series) -> np.ndarray:
    """Records in runs of STUCK_RUN or more successive records with the very same vector."""
    n = len(s.idx)
    same = np.zeros(n, bool)
    if n > 1:
        same[1:] = (s.group[1:] == s.group[:-1]) & ((s.x[1:] == s.x[:-1]) | (np.isnan(s.x[1:]) & np.isnan(s.x[:-1]))).all(1)
    run = np.cumsum(~same)
    return np.bincount(run)[run] >= STUCK_RUN


def _spikes(s: Series, phi: np.ndarray, sigma: np.ndarray, ao_z: float) -> tuple[np.ndarray, np.ndarray]:
    """Spikes and the largest innovation of each record in units of its source's noise."""
    n = len(s.idx)
    use, spike, most = s.ok.copy(), np.zeros(n, bool), np.zeros(n)
    same = np.r_[False, s.group[1:] == s.group[:-1]]
    before, after = np.arange(-SIDE, 0), np.arange(1, SIDE + 1)
    for turn in range(ROUNDS):
        d = s.x - s.level(use)
        d = np.where(s.ok, d, np.nan)
        kept = np.where(use & s.ok, np.nan_to_num(d), 0.0)
        prev = np.where(same[:, None], np.r_[kept[:1], kept[:-1]], 0.0)
        with np.errstate(invalid="ignore"):
            # what of the past deviation an outlier before the record explains is not its own
            e = np.where(np.abs(prev) < 3 * sigma, d - phi * prev, d)
            z = np.nan_to_num(np.abs(e) / sigma)
        if turn == 0:
            most = z.max(1)
        cand = (z > ao_z) & s.ok
        if not cand.any():
            break
        # length of the candidate runs, by component
        new = np.zeros(n, bool)
        for c in range(WIDTH):
            k = cand[:, c]
            if not k.any():
                continue
            # the largest first: neighbours whose level only suffers from an outlier wait
            part = np.cumsum(~(k & np.r_[False, k[:-1]] & same))
            top = np.zeros(part[-1] + 1)
            np.maximum.at(top, part, np.where(k, z[:, c], 0.0))
            k = k & (z[:, c] >= 0.5 * top[part])
            fresh = k & ~(np.r_[False, k[:-1]] & same)
            run = np.cumsum(fresh) - 1
            where = np.flatnonzero(k)
            first = np.flatnonzero(fresh)
            last = np.r_[where[np.searchsorted(where, first[1:]) - 1], where[-1]]
            short = last - first < MAX_SPIKE
            pre = _side(s, use[:, c] & ~k, c, first, -1)
            post = _side(s, use[:, c] & ~k, c, last, 1)
            for r in np.flatnonzero(short & ~np.isnan(pre) & ~np.isnan(post)):
                member = np.arange(first[r], last[r] + 1)
                size = np.abs(s.x[member, c] - (pre[r] + post[r]) / 2)
                if np.abs(post[r] - pre[r]) < 0.5 * size.min():
                    new[member] = True
        new &= ~spike
        if not new.any():
            break
        spike |= new
        use[new] = False
    return spike, most


def _side(s: Series, use: np.ndarray, c: int, at: np.ndarray, way: int) -> np.ndarray:
    """Median of the SIDE nearest usable records before or after each place, looking no
    further than the halo; NaN where there is none."""
    off = way * np.arange(1, 3 * SIDE + 1)
    pos = at[:, None] + off
    inside = (pos >= s.start[at][:, None]) & (pos < s.end[at][:, None])
    pos = np.where(inside, pos, 0)
    ok = inside & use[pos]
    ok &= np.cumsum(ok, 1) <= SIDE
    return _median(np.where(ok, s.x[pos, c], np.nan)[:, :, None])[:, 0]


def _floored(sigma: np.ndarray) -> np.ndarray:
    """Noise of at least a twentieth of that of the sister components, so that a component
    at rest does not make every move of it a spike."""
    three = np.repeat(np.maximum.reduceat(sigma, [0, 3], axis=1), 3, axis=1)
    return np.maximum(sigma, np.maximum(three / 20, 1e-9))


def flag_blocks(batches: Iterator[pa.RecordBatch], limits: dict[str, list[float]], ao_z: float) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in _slices(whole):
            s = Series(b, limits)
            phi, _ = _numpy(pa.Table.from_batches([b])["phi"])
            sigma, _ = _numpy(pa.Table.from_batches([b])["sigma"])
            spike, z = _spikes(s, phi.reshape(-1, WIDTH)[s.group], _floored(sigma.reshape(-1, WIDTH))[s.group], ao_z)
            stuck = _runs(s)
            out = (spike | stuck) & s.core
            g = s.group[out]
            vec = pa.ListArray.from_arrays(pa.array(np.arange(int(out.sum()) + 1, dtype=np.int32) * WIDTH), pa.array(s.x[out].ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("field_name").take(pa.array(g)),
                    b.column("episode_id").take(pa.array(g)),
                    pa.array(s.idx[out]),
                    vec,
                    pa.array(np.where(stuck[out], "stuck", "spike").tolist(), pa.string()),
                    pa.array(z[out]),
                ],
                ["field_name", "episode_id", "idx", "vec", "reason", "score"],
            )


FITS = "field_name string, episode_id string, n double, phi array<double>, sigma array<double>"
FLAGS = "field_name string, episode_id string, idx long, vec array<double>, reason string, score double"


def source_noise(b: DataFrame, limits: dict[str, list[float]]) -> DataFrame:
    """(field_name, episode_id, phi, sigma): of every source, from all its blocks."""
    fits = b.mapInArrow(lambda batches: fit_blocks(batches, limits), FITS)
    mean = lambda c: F.array(*(F.try_divide(F.sum(F.col("n") * F.get(c, F.lit(k))), F.sum("n")) for k in range(WIDTH)))
    return fits.groupBy("field_name", "episode_id").agg(mean("phi").alias("phi"), mean("sigma").alias("sigma"))


def found(robot_state: DataFrame, frames: DataFrame, streams_index: DataFrame, ao_z: float = AO_Z, limits: dict[str, list[float]] | None = None) -> DataFrame:
    """(field_name, row_id) of all implausible records of the three fields. ``ao_z``: how many
    robust standard deviations an innovation must leave; ``limits``: the physical range of the
    six components of each field."""
    from tracewright.operators.unitfix import convert_wrenches

    limits = limits or LIMITS
    r = convert_wrenches(
        robot_state.select("state_row_id", "episode_id", "record_index", "tcp_wrench", "measured_tcp_wrench", "units"), streams_index
    )
    act = frames.where(~F.coalesce("action_is_terminal_padding", F.lit(False)))
    series = (
        as_series(r, "tcp_wrench", "state_row_id", "record_index", limits)
        .unionByName(as_series(r, "measured_tcp_wrench", "state_row_id", "record_index", limits))
        .unionByName(as_series(act, "measured_action", "frame_row_id", "frame_index", limits))
    )
    return flag(series, ao_z, limits).select("field_name", "row_id")


def flag(series: DataFrame, ao_z: float = AO_Z, limits: dict[str, list[float]] | None = None) -> DataFrame:
    """(field_name, row_id, reason, score) of every record that is a spike, part of a stuck
    run, or out of range; one reason a record (range before stuck before spike). The flags go
    back to all copies of a record by its source, index and vector: one join."""
    limits = limits or LIMITS
    series = stage(series, "series")
    b = stage(blocks(series), "blocks")
    noise = broadcast_if_small(stage(source_noise(b, limits), "noise"), 192)
    flags = b.join(noise, ["field_name", "episode_id"]).mapInArrow(lambda batches: flag_blocks(batches, limits, ao_z), FLAGS)
    flags = stage(flags.groupBy("field_name", "episode_id", "idx", "vec").agg(F.max("reason").alias("reason"), F.max("score").alias("score")), "flags")
    flagged = series.where("not bad").join(broadcast_if_small(flags, 160), ["field_name", "episode_id", "idx", "vec"]).select("field_name", "row_id", "reason", "score")
    return series.where("bad").select("field_name", "row_id", F.lit("range").alias("reason"), F.lit(None).cast("double").alias("score")).unionByName(flagged)
