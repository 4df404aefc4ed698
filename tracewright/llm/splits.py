"""Splits that keep related records together.

Rows of one key (episode number, geometry, collection method, however written) are one
vertex; a staged export that names another episode of the same geometry and collection is
an edge. Components come from random-mate contraction: in each round every vertex tosses a
coin, a tails vertex with a heads neighbour collapses into the smallest of them, edges are
renamed, loops and doubles dropped, until no edge is left. The collapses form a forest with
the components' labels at the roots, which is unwound by doubling.

Components then go to the splits by cumulative weight in a hashed order; components beyond
``BIG`` of all rows (so fewer than 1/BIG of them) go first, largest first, to the split that
lacks most.

Defined results: a row without geometry or collection method, or whose episode id has no
number, is related to none (a group of its own); exact repeats share a vertex; null exports
make no edge; an empty table gives empty results; extra columns are unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tracewright.session import Staged, broadcast_if_small, stage

BIG = 0.01
#: A value this much rarer than one that is a single edit away is a misspelling of it.
TYPO_RATIO = 4
#: Shorter labels are never taken for misspellings.
TYPO_LENGTH = 6


def episode_number(c: Column) -> Column:
    """The number right after the episode marker (episode, ep, e); marks of retakes, cuts and
    copies follow it, other numbers may stand before it. Without a marker the first number."""
    marked = F.regexp_extract(F.lower(c), r"(?:^|[^a-z])(?:episode|ep|e)[^a-z0-9]*([0-9]+)", 1)
    text = F.coalesce(F.nullif(marked, F.lit("")), F.regexp_extract(c, r"([0-9]+)", 1))
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def last_step(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.trim(path), r"[/\\]+$", ""), r"[/\\]"), -1)


def spelled(c: Column) -> Column:
    """A label in lower snake case: camel case, blanks, dashes and slashes made alike."""
    s = F.regexp_replace(F.trim(c), r"(?<=[a-z0-9])(?=[A-Z])", "_")
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(s), r"[^a-z0-9]+", "_"), r"^_+|_+$", ""), F.lit(""))


def _digits(c: str) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def correct_values(values: DataFrame) -> DataFrame:
    """(field, value, right) from (field, value): misspelled labels and the frequent label one
    edit away (a letter left out, put in, changed, or two swapped). A differing digit is no
    misspelling: it names another thing. Two labels are one edit apart only if they share a
    form with at most one letter deleted, so the candidates come by an equi-join."""
    n = stage(values.groupBy("field", "value").count(), "labels")
    at = F.sequence(F.lit(1), F.length("value"))
    forms = n.select(
        "field", "value", "count", F.explode(F.array_distinct(F.concat(F.array("value"), F.transform(at, lambda i: F.concat(F.substr("value", F.lit(1), i - 1), F.substr("value", i + 1)))))).alias("form")
    )
    a = forms.select("field", "value", F.col("count").alias("n"), "form")
    b = forms.select("field", F.col("value").alias("right"), F.col("count").alias("m"), "form")
    return (
        a.join(b, ["field", "form"])
        .where((F.col("m") >= TYPO_RATIO * F.col("n")) & (F.levenshtein("value", "right") <= 2) & (F.length("value") >= TYPO_LENGTH) & (_digits("value") == _digits("right")))
        .groupBy("field", "value")
        .agg(F.max_by("right", F.struct("m", "right")).alias("right"))
    )


def keyed(metadata: DataFrame) -> DataFrame:
    """(meta_row_id, number, geometry, collection, exported): keys after normalising."""
    m = metadata.select(
        "meta_row_id",
        episode_number(F.col("episode_id")).alias("number"),
        spelled(F.col("geometry_type")).alias("geometry"),
        spelled(F.col("collection_method")).alias("collection"),
        episode_number(last_step(F.col("source_staged_export"))).alias("exported"),
    )
    m = stage(m, "keys")
    fields = ("geometry", "collection")
    both = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in fields))
    fix = stage(correct_values(m.select(F.explode(both).alias("x")).select("x.*").where("value is not null")), "fixes")
    small = broadcast_if_small(fix, 128)
    for c in fields:
        m = m.join(small.where(F.col("field") == c).select("value", "right"), F.col(c) == F.col("value"), "left").withColumn(c, F.coalesce("right", c)).drop("value", "right")
    return m


def coin(vertex: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(vertex, F.lit(turn)), F.lit(2)) == 1


def components(edges: DataFrame) -> DataFrame:
    """(vertex, label) of every vertex that has an edge, from edges (u, v). Every round is one
    written table with both its collapses and the edges left; how many are left is counted as
    they are written."""
    flat = lambda e: e.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    def write(rows: DataFrame, n: int) -> tuple[Staged, int]:
        seen = Observation(f"round-{n}")
        s = Staged(rows.observe(seen, F.count(F.when(~F.col("collapse"), 1)).alias("open")), "round")
        return s, seen.get["open"]

    first, open_edges = write(flat(edges).withColumn("collapse", F.lit(False)), 0)
    rounds = [first]
    while open_edges:
        turn = len(rounds)
        e = rounds[-1].df.where("not collapse").drop("collapse")
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        into = both.where(coin(F.col("u"), turn) & ~coin(F.col("v"), turn)).groupBy("u").agg(F.min("v").alias("v"))
        moved = (
            e.join(into.select("u", F.col("v").alias("tu")), "u", "left")
            .join(into.select(F.col("u").alias("v"), F.col("v").alias("tv")), "v", "left")
            .select(F.coalesce("tu", "u").alias("u"), F.coalesce("tv", "v").alias("v"))
        )
        nxt, open_edges = write(into.withColumn("collapse", F.lit(True)).unionByName(flat(moved).withColumn("collapse", F.lit(False))), turn)
        rounds.append(nxt)
    if len(rounds) == 1:
        return first.df.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    forest = edges.sparkSession.read.schema(first.df.schema).parquet(*(r.path for r in rounds)).where("collapse").select("u", F.col("v").alias("to"))
    up = Staged(forest, "forest")
    for r in rounds:
        r.drop()
    # a collapse of one round may go on in every later one: that many steps at most
    for _ in range(max(0, (len(rounds) - 2).bit_length())):
        higher = up.df.select(F.col("u").alias("to"), F.col("to").alias("top"))
        nxt = Staged(up.df.join(higher, "to", "left").select("u", F.coalesce("top", "to").alias("to")), "forest")
        up.drop()
        up = nxt
    roots = up.df.select(F.col("to").alias("vertex"), F.col("to").alias("label")).distinct()
    return up.df.select(F.col("u").alias("vertex"), F.col("to").alias("label")).unionByName(roots)


KEY = ["number", "geometry", "collection"]


def grouped(metadata: DataFrame) -> DataFrame:
    """(meta_row_id, group_id): group_id is the smallest row id of the related rows."""
    k = stage(keyed(metadata), "keyed")
    whole = F.coalesce(*(F.when(F.col(c).isNull(), False) for c in KEY), F.lit(True))
    v = stage(k.where(whole).groupBy(*KEY).agg(F.min("meta_row_id").alias("vertex")), "vertices")
    named = k.where(whole & F.col("exported").isNotNull() & (F.col("exported") != F.col("number"))).select(*KEY, "exported").distinct()
    edges = (
        named.join(v.withColumnRenamed("vertex", "u"), KEY)
        .select(F.col("exported").alias("number"), "geometry", "collection", "u")
        .join(v.withColumnRenamed("vertex", "v"), KEY)
        .select("u", "v")
    )
    c = components(edges)
    firsts = c.groupBy("label").agg(F.min("vertex").alias("group_id"))
    labelled = v.join(c.join(firsts, "label").select("vertex", "group_id"), "vertex", "left").select(*KEY, F.coalesce("group_id", "vertex").alias("group_id"))
    return k.join(stage(labelled, "groups"), KEY, "left").select("meta_row_id", F.coalesce("group_id", "meta_row_id").alias("group_id"))


def assign(groups: DataFrame, proportions: dict[str, float]) -> DataFrame:
    """(group_id, split) from (group_id, weight)."""
    names = list(proportions)
    total = groups.agg(F.sum("weight")).first()[0] or 0
    room = {s: proportions[s] * total for s in names}
    big = groups.where(F.col("weight") > BIG * total).orderBy(F.desc("weight"), "group_id").collect() if total else []
    given = {}
    for r in big:  # fewer than 1 / BIG rows
        s = max(names, key=lambda x: (room[x], -names.index(x)))
        given[r["group_id"]] = s
        room[s] -= r["weight"]
    left = sum(max(0.0, x) for x in room.values())
    # 4096 ranges of the hash, so that no task sorts them all
    rest = groups.where(F.col("weight") <= BIG * total).withColumn("h", F.md5(F.col("group_id").cast("string"))).withColumn("bucket", F.substr("h", F.lit(1), F.lit(3)))
    sums = rest.groupBy("bucket").agg(F.sum("weight").alias("w")).withColumn("offset", F.coalesce(F.sum("w").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("bucket").orderBy("h", "group_id")
    at = (F.col("offset") + F.sum("weight").over(w) - F.col("weight") / 2) / F.lit(float(max(1, total - sum(r["weight"] for r in big))))
    edge, split = 0.0, None
    for s in names:
        edge += max(0.0, room[s]) / left if left else 0.0
        hit = F.col("at") < edge
        split = F.when(hit, s) if split is None else split.when(hit, s)
    small = rest.join(F.broadcast(sums.select("bucket", "offset")), "bucket").withColumn("at", at).select("group_id", split.otherwise(names[0]).alias("split"))
    if not given:
        return small
    spark = groups.sparkSession
    return small.unionByName(spark.createDataFrame(list(given.items()), small.schema))


def split_rows(metadata: DataFrame, proportions: dict[str, float] | None = None) -> DataFrame:
    """(meta_row_id, group_id, split) of every row."""
    g = stage(grouped(metadata), "grouped")
    weights = stage(g.groupBy("group_id").agg(F.count("*").alias("weight")), "weights")
    s = assign(weights, proportions or {"train": 0.8, "validation": 0.1, "test": 0.1})
    return g.join(s, "group_id").select("meta_row_id", "group_id", "split")


def found(metadata: DataFrame) -> DataFrame:
    """(first_row_id, meta_row_id) of every related row but the first of its group."""
    return grouped(metadata).where("group_id <> meta_row_id").select(F.col("group_id").alias("first_row_id"), "meta_row_id")
