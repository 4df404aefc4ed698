import random

import numpy as np
import pytest

from tests.helpers import clashing
from tracewright.llm import leaks

D, E = "doc_id long, text string", "item_id long, item_text string"


def words(r, n, size=4000):
    return [f"w{r.randrange(size)}" for _ in range(n)]


def cover(a, b, least):
    """Plain greedy tiling, longest match first, every start tried."""
    fa, fb, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0,)
        for p in range(len(a)):
            for q in range(len(b)):
                n = 0
                while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n] and fa[p + n] and fb[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        if best[0] < least:
            return sum(x[0] for x in out)
        n, p, q = best
        fa[p : p + n] = [False] * n
        fb[q : q + n] = [False] * n
        out.append(best)


@pytest.mark.parametrize("seed", range(6))
def test_tiles_cover_as_much_as_plain_tiling(seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(0, 9, 40), r.integers(0, 9, 60)
    b[10:22], b[40:52] = a[20:32], a[2:14]
    t = leaks.tiles(a, b)
    assert all((a[p : p + n] == b[q : q + n]).all() for p, q, n in t)
    assert sum(n for _, _, n in t) == pytest.approx(cover(a.tolist(), b.tolist(), leaks.MIN_TILE), abs=6)


def run(spark, docs, items):
    d, e = spark.createDataFrame(docs, D), spark.createDataFrame(items, E)
    return sorted(tuple(x) for x in leaks.found(clashing(d), clashing(e)).collect())


def test_what_leaks(spark):
    r = random.Random(1)
    a, b = words(r, 60), words(r, 50)
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, None), (4, "short one"), (5, " ".join(a))]
    pad = lambda: " ".join(words(r, 30))
    swap = lambda ws, *at: [f"x{i}" if i in at else w for i, w in enumerate(ws)]
    docs = [
        (1, pad() + " " + " ".join(a[10:22]) + " " + pad()),  # twelve words
        (2, " ".join(a[10:21])),  # eleven: a quote
        (3, " ".join(swap(a[5:29], 3, 11, 19))),  # one in eight replaced
        (4, " ".join(swap(a[5:29], 3, 7, 11, 15, 19))),  # too many replaced
        (5, "\n".join(f"**{w.upper()}**," for w in b[:14]) + "."),  # markup, case, lines
        (6, " ".join(b[25:40] + a[40:55] + b[0:15])),  # reordered, two items
        (7, None), (8, ""), (9, pad()),
        (10, "<p>" + "</p> <p>".join(" ".join(b[i : i + 4]) for i in range(0, 16, 4)) + "</p>"),
        (11, " ".join(swap(a[30:42], 6))),
    ]
    want = [(1, 1), (3, 1), (5, 2), (6, 1), (6, 2), (10, 2), (11, 1)]
    assert run(spark, docs, items) == sorted(want + [(d, 5) for d, i in want if i == 1])


def test_stock_wording_is_no_leak(spark):
    r = random.Random(2)
    stock = words(r, 14)
    items = [(i, " ".join(words(r, 20) + stock + words(r, 20))) for i in range(3)]
    assert run(spark, [(1, " ".join(stock))], items) == []


def test_stock_wording_without_own_seeds(spark):
    """Every seed of a passage is shared by some item, but no other item holds all of it."""
    r = random.Random(7)
    a = words(r, 16)
    items = [(1, " ".join(words(r, 9) + a + words(r, 9))), (2, " ".join(words(r, 9) + a[:9] + words(r, 9))), (3, " ".join(words(r, 9) + a[5:14] + words(r, 9))), (4, " ".join(words(r, 9) + a[9:] + words(r, 9)))]
    assert run(spark, [(1, " ".join(words(r, 5) + a[:14] + words(r, 5)))], items) == [(1, 1)]


def test_reordered_item(spark):
    """Cut into three and reordered: no twelve successive words are left, the tiles cover it."""
    r = random.Random(8)
    a = words(r, 24)
    moved = a[16:] + words(r, 3) + a[8:16] + words(r, 3) + a[:8]
    docs = [(1, " ".join(moved)), (2, " ".join(a[16:] + words(r, 30))), (3, " ".join(a[:6] + words(r, 9) + a[12:17]))]
    assert run(spark, docs, [(1, " ".join(a)), (2, " ".join(words(r, 24)))]) == [(1, 1)]
    got = leaks.leaks(spark.createDataFrame(docs, D), spark.createDataFrame([(1, " ".join(a))], E)).first()
    assert (got["passage_words"], got["coverage"]) == (0, 1.0)


def test_seeds_join_by_shuffle_too(spark, monkeypatch):
    """Beyond the size a broadcast may have, the joins shuffle: the same result."""
    r = random.Random(3)
    items = [(i, " ".join(words(r, 40))) for i in range(12)]
    docs = [(i, items[i][1]) for i in range(12)]
    whole = run(spark, docs, items)
    monkeypatch.setattr(leaks, "broadcast_if_small", lambda df, row_bytes: df)
    assert run(spark, docs, items) == whole == [(i, i) for i in range(12)]


def test_against_brute_force(spark):
    """All windows of all items against all places of all documents, on a small vocabulary."""
    r = random.Random(5)
    items = [words(r, 30, 60) for _ in range(5)]
    docs = []
    for i in range(40):
        it = r.choice(items)
        s, n = r.randrange(0, 16), r.randrange(9, 15)
        part = [w if r.random() > 0.08 else "zz" for w in it[s : s + n]]
        docs.append(words(r, 10, 60) + part + words(r, 10, 60))

    def holds(d, a):
        for p in range(len(a)):
            for q in range(len(d)):
                miss = 0
                for n in range(1, min(len(a) - p, len(d) - q) + 1):
                    miss += a[p + n - 1] != d[q + n - 1]
                    if n >= leaks.MIN_WORDS and a[p] == d[q] and a[p + n - 1] == d[q + n - 1] and miss * leaks.REPLACED <= n:
                        return True
        return False

    want = sorted((i, j) for i, d in enumerate(docs) for j, a in enumerate(items) if holds(d, a))
    assert want and run(spark, [(i, " ".join(d)) for i, d in enumerate(docs)], [(j, " ".join(a)) for j, a in enumerate(items)]) == want


def test_empty(spark):
    assert run(spark, [], []) == [] and run(spark, [(1, "a b")], []) == [] and run(spark, [], [(1, "a b")]) == []


def test_long_text(spark):
    r = random.Random(4)
    a = words(r, 40)
    big = " ".join(words(r, 200_000) + a[3:30] + words(r, 1000))
    assert run(spark, [(1, big)], [(1, " ".join(a))]) == [(1, 1)]
