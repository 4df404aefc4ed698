"""SQL of the language-model data queries that need more than a few lines.

Written from the statement of the problems, not from the operators: labels are compared by
edit distance over the vocabulary, groups grow by recursive reachability, the nearest records
come from as-of joins, shares from plain window sums."""

from __future__ import annotations


def spelled(c: str) -> str:
    """A label in lower snake case."""
    return (
        "nullif(regexp_replace(regexp_replace(lower(regexp_replace(trim(" + c + "), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '')"
    )


def number(c: str) -> str:
    """The number after the episode marker, else the first one."""
    return f"try_cast(coalesce(nullif(regexp_extract(lower({c}), '(^|[^a-z])(episode|ep|e)[^a-z0-9]*([0-9]+)', 3), ''), regexp_extract({c}, '[0-9]+')) as bigint)"


def fixes(column: str, name: str) -> str:
    """Misspelled labels: one letter, or a swap of two, from a label four times as frequent."""
    return f"""{name}_n as (select {column} as value, count(*) as n from k0 where {column} is not null group by 1),
{name}_x as (select a.value, max_by(b.value, (b.n, b.value)) as fixed from {name}_n a, {name}_n b
  where b.n >= 4 * a.n and damerau_levenshtein(a.value, b.value) = 1 and length(a.value) >= 6
    and regexp_replace(a.value, '[^0-9]', '', 'g') = regexp_replace(b.value, '[^0-9]', '', 'g') group by 1)"""


_GROUPS = f"""
k0 as (select meta_row_id, {number("episode_id")} as number, {spelled("geometry_type")} as g0, {spelled("collection_method")} as c0,
  {number("list_last(string_split(regexp_replace(trim(source_staged_export), '/+$', ''), '/'))")} as exported from metadata),
{fixes("g0", "g")},
{fixes("c0", "c")},
k as (select meta_row_id, number, coalesce(g_x.fixed, g0) as geometry, coalesce(c_x.fixed, c0) as collection, exported from k0 left join g_x on g0 = g_x.value left join c_x on c0 = c_x.value),
v as (select number, geometry, collection, min(meta_row_id) as vertex from k where number is not null and geometry is not null and collection is not null group by all),
e as (select distinct v.vertex as a, w.vertex as b from k join v using (number, geometry, collection) join v w on w.number = k.exported and w.geometry = k.geometry and w.collection = k.collection where w.vertex <> v.vertex),
b as (select a, b from e union select b, a from e),
reach as (select vertex as a, vertex as r from v union select reach.a, b.b from reach join b on reach.r = b.a),
grp as (select a as vertex, min(r) as group_id from reach group by a)
"""

P2_FOUND = f"""
with recursive {_GROUPS}
select group_id as first_row_id, meta_row_id from k join v using (number, geometry, collection) join grp using (vertex) where group_id <> meta_row_id
"""

# groups beyond a hundredth of all rows go first, largest first, to the split that lacks most;
# the others by cumulative weight in the order of a hash
P2_SPLITS = f"""
with recursive {_GROUPS},
every as (select meta_row_id, coalesce(group_id, meta_row_id) as group_id from k left join v using (number, geometry, collection) left join grp using (vertex)),
w as (select group_id, count(*) as weight from every group by 1),
n as (select count(*) as total from every),
big as (select group_id, weight, row_number() over (order by weight desc, group_id) as i from w, n where weight > 0.01e0 * total),
walk as (
  select cast(0 as bigint) as i, 0.8e0 * total as a, 0.1e0 * total as b, 0.1e0 * total as c, cast(null as bigint) as group_id, cast(null as varchar) as split from n
  union all
  select big.i, a - case when a >= b and a >= c then weight else 0 end, b - case when b > a and b >= c then weight else 0 end, c - case when c > a and c > b then weight else 0 end,
    big.group_id, case when a >= b and a >= c then 'train' when b >= c then 'validation' else 'test' end
  from walk join big on big.i = walk.i + 1),
room as (select greatest(a, 0) as a, greatest(b, 0) as b, greatest(c, 0) as c from walk order by i desc limit 1),
rest as (select group_id, weight, sum(weight) over (order by md5(cast(group_id as varchar)), group_id) - weight / 2.0e0 as mid, sum(weight) over () as all_rest
  from w, n where weight <= 0.01e0 * total),
small as (select group_id, case when mid / all_rest < a / (a + b + c) then 'train' when mid / all_rest < a / (a + b + c) + b / (a + b + c) then 'validation' else 'test' end as split from rest, room),
given as (select group_id, split from small union all select group_id, split from walk where group_id is not null)
select meta_row_id, group_id, split from every join given using (group_id)
"""

_WORDS = "list_filter(regexp_split_to_array(lower(regexp_replace({0}, '</?[a-zA-Z][a-zA-Z0-9]*(?:\\s[^<>]*)?/?>', ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0)"

# every diagonal of document and item on which a run of five words of its own agrees, and on it
# every stretch that begins and ends alike, of twelve words or more and one in eight differing
P8_FOUND = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS.format("text")} as w from documents where length(text) > 0),
i as (select item_id, {_WORDS.format("item_text")} as w from eval_items where item_text is not null),
ds as (select r, q, array_to_string(w[q:q + 4], ' ') as s from (select r, w, unnest(range(1, len(w) - 3)) as q from d where len(w) >= 5)),
its as (select item_id, text, p, array_to_string(w[p:p + 4], ' ') as s from (select item_id, array_to_string(w, ' ') as text, w, unnest(range(1, len(w) - 3)) as p from i where len(w) >= 12)),
own as (select s from its group by s having count(distinct text) = 1),
diag as (select distinct r, item_id, q - p as g from ds join its using (s) where s in (select s from own)),
cells as (select r, item_id, g, unnest(range(1, len(i.w) + 1)) as p, i.w as a, d.w as b from diag join i using (item_id) join d using (r)),
same as (select r, item_id, g, p, coalesce(a[p] = b[p + g], false) as ok from cells where p + g between 1 and len(b)),
run as (select *, sum(case when ok then 0 else 1 end) over (partition by r, item_id, g order by p) as miss from same),
hit as (select distinct x.r, x.item_id from run x join run y on x.r = y.r and x.item_id = y.item_id and x.g = y.g and y.p >= x.p + 11 where x.ok and y.ok and (y.miss - x.miss) * 8 <= y.p - x.p + 1)
select doc_id, item_id from hit join d using (r)
"""
