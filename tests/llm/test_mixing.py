import random

import pytest

from tests.helpers import clashing
from tracewright.llm import mixing

D, T = "doc_id long, text string, source string", "source string, target_share double, max_repeats long"


def make(spark, sizes, targets, seed=0):
    r = random.Random(seed)
    docs, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            i += 1
            docs.append((i, " ".join(r.choice(["peg", "hole", "the", "force", "plug"]) for _ in range(r.randrange(1, 200))), s))
    return spark.createDataFrame(docs, D), spark.createDataFrame(targets, T)


def test_shares_meet_their_targets(spark):
    sizes = {"a": 900, "B-x": 300, "c": 60, "none": 50}
    targets = [("a", 0.3, 2), ("b_x", 0.4, 4), ("c", 0.3, 5)]
    d, t = make(spark, sizes, targets)
    m = mixing.mix(clashing(d), clashing(t))
    rows = {r["source"]: r for r in mixing.shares(m, t).collect()}
    assert set(rows) == {"a", "b_x", "c"}
    for s, share, most in targets:
        assert rows[s]["actual_share"] == pytest.approx(share, abs=0.02)
        assert rows[s]["most_copies"] <= most
    assert max(r["actual_share"] for r in rows.values()) < 1
    assert rows["c"]["uses"] == 5 * 60  # the scarcest source is used up
    ids = [r["doc_id"] for r in m.collect()]
    assert len(ids) == len(set(ids))


def test_whole_copies_come_before_the_sample(spark):
    d, t = make(spark, {"a": 200, "b": 500}, [("a", 0.5, 3), ("b", 0.5, 1)], 1)
    copies = {r["copies"] for r in mixing.mix(d, t).where("source = 'a'").collect()}
    assert copies == {2, 3}


def test_larger_documents_are_likelier(spark):
    d, t = make(spark, {"a": 2000}, [("a", 1.0, 1)], 2)
    m = mixing.mix(d, t, total_tokens=40_000)
    everything = mixing.count_tokens(d)
    mean = lambda df: df.agg({"tokens": "avg"}).first()[0]
    assert mean(m) > 1.15 * mean(everything)
    assert m.agg({"tokens": "sum"}).first()[0] == pytest.approx(40_000, rel=0.05)


def test_seeds_differ_and_repeat(spark):
    d, t = make(spark, {"a": 300}, [("a", 1.0, 1)], 3)
    take = lambda seed: {r["doc_id"] for r in mixing.mix(d, t, seed, total_tokens=8000).collect()}
    assert take(1) == take(1) != take(2)


def test_tokens_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["Insert the peg into the hole.", "", "Überprüft: 그리퍼 폭이 97 mm 에서 멈췄다.\n\n  3.14159  don't <|endoftext|>", "  tabs\tand   runs "]
    d = spark.createDataFrame([(i, x, "a") for i, x in enumerate(texts)] + [(9, None, None)], D)
    want = {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)} | {9: 0}
    assert {r["doc_id"]: r["tokens"] for r in mixing.count_tokens(d).collect()} == want


def test_awkward_cases(spark):
    d, t = make(spark, {"a": 5}, [("a", 0.5, 2), ("missing", 0.5, 2), (None, 0.1, 1)])
    rows = {r["source"]: r["actual_share"] for r in mixing.shares(mixing.mix(d, t), t).collect()}
    assert rows["a"] == 1.0 and rows["missing"] == 0.0
    e = spark.createDataFrame([], D)
    assert mixing.mix(e, t).count() == 0 and mixing.mix(d, spark.createDataFrame([], T)).count() == 0


def test_samples_have_a_fixed_size(spark):
    """Whatever the seed, as many documents are taken as the inclusion probabilities sum to."""
    d, t = make(spark, {"a": 700, "b": 400}, [("a", 0.5, 2), ("b", 0.5, 2)], 4)
    n = [mixing.mix(d, t, seed, total_tokens=60_000).groupBy("source").agg({"copies": "sum"}).collect() for seed in range(4)]
    sizes = [{r["source"]: r["sum(copies)"] for r in x} for x in n]
    assert all(x == sizes[0] for x in sizes)
    tokens = [mixing.mix(d, t, seed, total_tokens=60_000).agg({"tokens": "sum"}).first()[0] for seed in range(4)]
    assert len(set(tokens)) > 1 and sum(tokens) / 4 == pytest.approx(60_000, rel=0.03)


def test_inclusion_follows_the_probabilities(spark):
    """Over many seeds, documents come in as often as their share of the tokens says."""
    d, t = make(spark, {"a": 120}, [("a", 1.0, 1)], 5)
    size = {r["doc_id"]: r["tokens"] for r in mixing.count_tokens(d).collect()}
    hits = dict.fromkeys(size, 0)
    for seed in range(12):
        for r in mixing.mix(d, t, seed, total_tokens=4000).collect():
            hits[r["doc_id"]] += 1
    by = sorted(size, key=size.get)
    small, large = sum(hits[x] for x in by[:40]), sum(hits[x] for x in by[80:])
    want = sum(size[x] for x in by[80:]) / sum(size[x] for x in by[:40])
    assert large / max(1, small) == pytest.approx(want, rel=0.5)
