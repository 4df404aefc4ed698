"""Evaluation passages inside training documents, by greedy string tiling.

Documents and items are cut into words in the JVM; the hashes of their runs of five words
(seeds) are joined, in one pass over the documents however many items there are. Only
documents that share a seed with an item are compared with it in full: greedy string tiling
(longest non-overlapping matches first, found by running Karp-Rabin with falling lengths)
marks the words of the item that the document holds, in whatever order.

A document leaks an item if it holds a passage of at least ``MIN_WORDS`` successive words of
it of which at most one in ``REPLACED`` differs (such a passage always holds a seed), or if
tiles of at least a seed's length cover a share ``COVERED`` of the item and ``MIN_WORDS``
words, so that an item cut up and reordered is caught. Stock wording does not count: a
passage needs a seed that no other text has, or may not be covered by another item's passage
in the same place; a tile needs a seed that no other text has.

Defined results: case, punctuation, markup and line breaks are left aside; null and empty
texts leak nothing; copies of a document are reported each; items of the same text are
reported each (their seeds are theirs alone); an item shorter than ``MIN_WORDS`` words
cannot leak; extra columns are unread. No document is cut, no candidate is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.session import broadcast_if_small, stage

SEED, MIN_WORDS, REPLACED, MIN_TILE = 5, 12, 8, 2
#: Share of an item's words in tiles from which it leaked, in whatever order.
COVERED = 0.6
_BASE = np.uint64(1_000_003)
TAG = r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s[^<>]*)?/?>"


def words_of(text: Column) -> Column:
    """The words of a text in small letters, markup and punctuation left out."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, TAG, " ")), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)


def with_seeds(df: DataFrame) -> DataFrame:
    """One row for each run of SEED words of ``words``: its place from 0 (``pos``) and its
    hash (``h``). The places are exploded first, so the hashing is compiled code."""
    at = F.explode(F.sequence(F.lit(0), F.size("words") - SEED)).alias("pos")
    return df.where(F.size("words") >= SEED).select("*", at).withColumn("h", F.xxhash64(*(F.get("words", F.col("pos") + k) for k in range(SEED))))


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of k ids (modulo 2**64)."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = h * _BASE + x[j : j + n] * np.uint64(0x9E3779B97F4A7C15)
    return h


def tiles(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in a, place in b, length), longest first."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out: list[tuple[int, int, int]] = []
    length = min(len(a), 16)
    while length >= MIN_TILE:
        hb = rolling(b, length).tolist()
        where: dict[int, list[int]] = {}
        for p, x in enumerate(rolling(a, length).tolist()):
            if free_a[p : p + length].all():
                where.setdefault(x, []).append(p)
        found = []
        if where:
            for q, x in enumerate(hb):
                if x not in where or not free_b[q : q + length].all():
                    continue
                for p in where[x]:
                    n = 0
                    while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n] and free_a[p + n] and free_b[q + n]:
                        n += 1
                    if n >= length:
                        found.append((-n, p, q))
        longest = -min(found)[0] if found else 0
        if longest > 2 * length:  # begin again where it pays
            length = longest
            continue
        for n, p, q in sorted(found):
            n = -n
            if free_a[p : p + n].all() and free_b[q : q + n].all():
                free_a[p : p + n] = free_b[q : q + n] = False
                out.append((p, q, n))
        length = length // 2 if length > 2 * MIN_TILE else length - 1
    return out


def aligned_passages(a: np.ndarray, b: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """(start in b, words) of the passages of a on a diagonal of b that begin and end with the
    same words, differ in at most one word of REPLACED and have MIN_WORDS words at least; of
    those that begin inside another only the ones that go beyond it."""
    lo, hi = max(0, -diagonal), min(len(a), len(b) - diagonal)
    if hi - lo < MIN_WORDS:
        return []
    same = a[lo:hi] == b[lo + diagonal : hi + diagonal]
    at = np.flatnonzero(same)
    if len(at) < MIN_WORDS - MIN_WORDS // REPLACED:
        return []
    miss = np.r_[0, np.cumsum(~same)]
    out, upto = [], -1
    for s in at.tolist():
        ends = at[(at >= s + MIN_WORDS - 1) & (at > upto)]
        n = ends - s + 1
        ok = (miss[ends + 1] - miss[s]) * REPLACED <= n
        if ok.any():
            upto = int(ends[ok].max())
            out.append((lo + diagonal + s, upto - s + 1))
    return out


def leaks_in(b: np.ndarray, items: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[int, int, float]]:
    """(item_id, words of the longest passage, share of the item in tiles) of the items that
    leaked. ``b`` holds the hashes of the document's words; ``items`` all items that share a
    seed: id, hashes of the words, which seeds are its own, the seeds' places in item and
    document."""
    held = []
    for ident, a, own, p, q in items:
        mine = q[own[p]]
        diagonals, seeds = np.unique(q - p, return_counts=True)
        passages = sorted({s for d in diagonals[seeds > 1].tolist() for s in aligned_passages(a, b, d)})
        covered = 0.0
        if len(mine):
            tiled = np.zeros(len(a), bool)
            for lo, hi in _stretches(q, len(a), len(b)):
                for x, _, k in tiles(a, b[lo:hi]):
                    if k >= SEED and own[x : x + k - SEED + 1].any():
                        tiled[x : x + k] = True
            covered = float(tiled.mean()) if tiled.sum() >= MIN_WORDS else 0.0
        if passages or covered:
            held.append((ident, a, passages, mine, covered))
    out = []
    for ident, a, passages, mine, covered in held:
        longest = 0
        for s, n in passages:
            if ((mine >= s) & (mine <= s + n - SEED)).any() or not any(_covers(o, s, n) for _, c, o, _, _ in held if not np.array_equal(a, c)):
                longest = max(longest, n)
        if longest >= MIN_WORDS or covered >= COVERED:
            out.append((ident, longest, covered))
    return sorted(out)


def _stretches(at: np.ndarray, reach: int, end: int) -> list[tuple[int, int]]:
    """The document's stretches around the seeds, far enough to hold the whole item."""
    spans: list[list[int]] = []
    for x in np.unique(at).tolist():
        lo, hi = max(0, x - reach), min(end, x + reach + SEED)
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = hi
        else:
            spans.append([lo, hi])
    return [(lo, hi) for lo, hi in spans]


def _covers(passages: list[tuple[int, int]], start: int, n: int) -> bool:
    """Whether a passage holds all but one word in REPLACED of another one's place."""
    return any((min(start + n, s + m) - max(start, s)) * REPLACED >= n * (REPLACED - 1) for s, m in passages)


def hashed(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def items_with_seeds(eval_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, item, own): hashes of the words and which seeds no other text has; and the
    index (h, item_id, p)."""
    i = eval_items.where("item_text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("item_text")).alias("words"))
    i = i.where(F.size("words") >= MIN_WORDS).dropDuplicates(["item_id"]).withColumn("text", F.xxhash64("words"))
    each = stage(with_seeds(i).select("item_id", "text", F.col("pos").alias("p"), "h"), "item-seeds")
    texts = each.groupBy("h").agg((F.min("text") == F.max("text")).alias("own"))
    own = each.join(texts, "h").groupBy("item_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "own"))), lambda x: x["own"]).alias("own"))
    return stage(i.join(own, "item_id").select("item_id", hashed("words").alias("item"), "own"), "items"), each.select("h", "item_id", "p")


def leaks(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """(doc_id, item_id, passage_words, coverage) of every leak. The documents' seeds meet the
    items' in one join; of the texts only those with two seeds of one item (a passage has no
    fewer) go further, by id and hash."""
    items, index = items_with_seeds(eval_items)
    docs = documents.where(F.length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    cut = docs.select("doc_id", "text_hash", words_of(F.col("text")).alias("words"))
    met = with_seeds(cut).select("doc_id", "text_hash", F.col("pos").alias("q"), "h").join(broadcast_if_small(index, 32), "h")
    # copies of a row bring every place again
    places = met.groupBy("doc_id", "text_hash", "item_id").agg(F.collect_set(F.struct("p", "q")).alias("places")).where(F.size("places") > 1)
    hits = stage(places, "hits")
    full = hits.join(broadcast_if_small(items, 2048), "item_id").groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item_id", "item", "own", F.col("places.p").alias("p"), F.col("places.q").alias("q"))).alias("items"))
    keys = broadcast_if_small(hits.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct(), 32)
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
    near = cut.join(keys, same, "left_semi").select("doc_id", "text_hash", hashed("words").alias("b"))
    pairs = near.join(full.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "items"), same).select("doc_id", "b", "items")

    def lists(x: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(x.offsets), x.values.to_numpy(zero_copy_only=False)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bo, bv = lists(batch.column(1))
            its, at = batch.column(2).values, np.asarray(batch.column(2).offsets)
            ids = its.field("item_id").to_numpy(zero_copy_only=False).tolist()
            parts = [lists(its.field(n)) for n in ("item", "own", "p", "q")]
            rows = []
            for r, d in enumerate(batch.column(0).to_pylist()):
                items = [(ids[i], *(v[o[i] : o[i + 1]] for o, v in parts)) for i in range(at[r], at[r + 1])]
                rows += [(d, *x) for x in leaks_in(bv[bo[r] : bo[r + 1]], items)]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "item_id", "passage_words", "coverage"])

    return pairs.mapInArrow(search, "doc_id long, item_id long, passage_words long, coverage double")


def found(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    return leaks(documents, eval_items).select("doc_id", "item_id")
