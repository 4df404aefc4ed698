"""Mixing sources to target shares of all tokens, by Pareto order sampling.

The mix is as large as it can be: the total at which the scarcest source, used max_repeats
times, just gives its share (or the total asked for, if that is smaller). A source that has
to give r times its tokens gives floor(r) whole copies of every document; the fraction left
is an unequal-probability sample: inclusion probabilities grow with the document's tokens
(capped at 1, so these are certain), documents are ranked by random odds divided by
inclusion odds, and the first n are taken; n is fixed beforehand, the rounded sum of the
inclusion probabilities, so the sample's tokens are the target's in expectation.

No source is sorted in one task: ranks fall into BINS bins, the bins' sums tell the bin in
which the cut lies, and only that bin is sorted. Token counts for the probabilities go to
the driver as a histogram of bounded size.

Defined results: documents without a source of the targets take no part; sources are told
apart without regard to case, blanks, dashes; empty texts weigh nothing and are used floor(r)
times; a target source without tokens makes the mix empty for it and is left out of the
total's bound (reported with share 0); ties in rank go by doc_id; repeated doc_ids are
separate rows that share their rank; extra columns are unread.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import stage

BINS = 65536
#: The public tokenizer's vocabulary; a parameter of the queries.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# --- fixed value: how this tokenizer splits a text into words ---------------------------
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def source_name(c):
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s\-]+", "_")


def count_tokens(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens). The vocabulary is read once and travels to the workers."""
    with open(tokenizer, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    shared = documents.sparkSession.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        enc = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=shared.value, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), source_name(F.col("source")).alias("source"), "text").mapInArrow(
        count, "doc_id long, source string, tokens long"
    )


def _scale(hist: list[tuple[float, int]], want: float) -> float:
    """c with sum of min(1, c x) x n over the histogram equal to ``want``."""
    lo, hi = 0.0, 1.0 / max(1e-9, min((x for x, _ in hist if x > 0), default=1.0))
    for _ in range(100):
        c = (lo + hi) / 2
        if sum(min(1.0, c * x) * x * n for x, n in hist) < want:
            lo = c
        else:
            hi = c
    return hi


def plan(sizes: DataFrame, targets: list[tuple[str, float, int]], total_tokens: float | None = None) -> dict[str, dict]:
    """Per source: target tokens, whole copies, tokens wanted of the fraction, scale c."""
    step = 1.02
    b = F.floor(F.log(F.col("tokens").cast("double")) / math.log(step)).cast("int")
    hist = sizes.where("tokens > 0").groupBy("source", b.alias("b")).agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()
    have = {s: 0 for s, _, _ in targets}
    by: dict[str, list[tuple[float, int]]] = {s: [] for s in have}
    for r in hist:
        if r["source"] in have:
            have[r["source"]] += r["t"]
            by[r["source"]].append((r["t"] / r["n"], r["n"]))
    live = [(s, share, most) for s, share, most in targets if have[s] > 0 and share > 0 and most > 0]
    if not live:
        return {}
    whole = sum(share for _, share, _ in live)
    total = min(have[s] * most / (share / whole) for s, share, most in live)
    if total_tokens is not None:
        total = min(total, total_tokens)
    out = {}
    for s, share, most in live:
        want = share / whole * total
        copies = min(most, math.floor(want / have[s] + 1e-9))
        rest = max(0.0, want - copies * have[s]) if copies < most else 0.0
        out[s] = {"target_tokens": want, "copies": copies, "rest": rest, "c": _scale(by[s], rest) if rest else 0.0}
    return out


def mix(documents: DataFrame, mix_targets: DataFrame, seed: int = 0, total_tokens: float | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens, copies) of every document that takes part."""
    spark = documents.sparkSession
    rows = mix_targets.where("source is not null").groupBy(source_name(F.col("source")).alias("s")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("most")).collect()
    targets = sorted((r["s"], float(r["share"] or 0), int(r["most"] or 0)) for r in rows)
    sizes = stage(count_tokens(documents, tokenizer), "tokens")
    p = plan(sizes, targets, total_tokens)
    table = spark.createDataFrame(
        [(s, float(x["rest"]), int(x["copies"]), float(x["c"])) for s, x in p.items()], "source string, rest double, base int, c double"
    )  # one row a target source
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    lam = F.least(F.lit(1.0), F.col("c") * F.col("tokens"))
    # odds of u over odds of lam, folded into (0, 1); certain documents come first
    rank = F.when(lam >= 1.0, 0.0).when(lam <= 0.0, 1.0).otherwise(u * (1 - lam) / (u * (1 - lam) + lam * (1 - u)))
    d = sizes.join(F.broadcast(table), "source").withColumn("lam", lam).withColumn("rank", rank).withColumn("bin", F.least(F.lit(BINS - 1), F.floor(F.col("rank") * BINS)).cast("int"))
    d = stage(d, "ranked")
    open_ = d.where((F.col("rest") > 0) & (F.col("tokens") > 0))
    # the size of the sample: the sum of the inclusion probabilities, one row a source
    size = open_.groupBy("source").agg(F.round(F.sum("lam")).cast("long").alias("size"))
    w = Window.partitionBy("source").orderBy("bin")
    bins = open_.groupBy("source", "bin").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(w) - F.col("n")).join(F.broadcast(size), "source")
    cut = bins.where((F.col("before") < F.col("size")) & (F.col("before") + F.col("n") >= F.col("size"))).select("source", F.col("bin").alias("cut"), "before", "size")
    j = open_.join(F.broadcast(cut), "source", "left")
    sure = j.where(F.col("bin") < F.col("cut")).select("source", "doc_id", "tokens", "base", F.lit(1).alias("extra"))
    inner = Window.partitionBy("source").orderBy("rank", "doc_id")
    edge = j.where(F.col("bin") == F.col("cut")).withColumn("at", F.col("before") + F.row_number().over(inner))
    edge = edge.select("source", "doc_id", "tokens", "base", (F.col("at") <= F.col("size")).cast("int").alias("extra"))
    # a source whose sample has size 0 has no cut: none of it is taken once more
    later = j.where(F.col("cut").isNull() | (F.col("bin") > F.col("cut"))).select("source", "doc_id", "tokens", "base", F.lit(0).alias("extra"))
    closed = d.where((F.col("rest") <= 0) | (F.col("tokens") <= 0)).select("source", "doc_id", "tokens", "base", F.lit(0).alias("extra"))
    every = sure.unionByName(edge).unionByName(later).unionByName(closed)
    return every.select("doc_id", "source", "tokens", (F.col("base") + F.col("extra")).cast("long").alias("copies")).where("copies > 0")


def shares(mixed: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """Target and actual share of every source, with what was used."""
    used = mixed.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("copies").alias("uses"), F.max("copies").alias("most_copies"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens")
    )
    t = mix_targets.groupBy(source_name(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # over one row a target
    return t.join(used, "source", "left").withColumn("all_tokens", whole).select(
        "source", "target_share", F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("uses", F.lit(0)).alias("uses"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )
