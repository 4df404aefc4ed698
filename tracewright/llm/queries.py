"""Queries of the language-model data operators, with their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm import leaks, mixing, nearest, pii, splits
from tracewright.llm.oracles import P2_FOUND, P2_SPLITS, P8_FOUND
from tracewright.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.found(table(spark, d, "metadata"))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_rows(table(spark, d, "metadata"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nearest.found(table(spark, d, "frames"), table(spark, d, "camera_index"), table(spark, d, "metadata"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_coverage(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(table(spark, d, "documents"))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(table(spark, d, "documents").select("doc_id", "text"))


P6_SQL = """
with fps as (select episode_id, max(fps) as fps from metadata where isfinite(fps) and fps > 0 group by episode_id),
f as (select frame_row_id, episode_id, "timestamp" as t, v as "view", coalesce(0.5 / fps, 0.02) as tol
      from frames left join fps using (episode_id), (values ('external'), ('tcp')) as views(v)
      where "timestamp" is not null and isfinite("timestamp")),
c0 as (select episode_id, case when stream_name in ('external_camera_1', 'external_camera') then 'external'
        when stream_name in ('tcp_camera', 'wrist_camera') then 'tcp' end as "view",
      coalesce(try_cast(source_stamp as double),
        try_cast(json_extract_string(case when source_stamp like '{%' then source_stamp end, '$.sec') as double)
        + 1e-9 * try_cast(json_extract_string(case when source_stamp like '{%' then source_stamp end, '$.nanosec') as double)) as ct,
      camera_row_id from camera_index),
c as (select episode_id, "view", ct, min(camera_row_id) as id from c0 where "view" is not null and ct is not null and isfinite(ct) group by all),
b as (select f.*, c.ct as bt, c.id as bid from f asof left join c on f.episode_id = c.episode_id and f."view" = c."view" and f.t >= c.ct),
a as (select b.*, c.ct as after_t, c.id as aid from b asof left join c on b.episode_id = c.episode_id and b."view" = c."view" and b.t <= c.ct),
n as (select frame_row_id, tol, t - bt as bd, bid, after_t - t as ad, aid from a),
m as (select frame_row_id, tol, case when bd is null then ad when ad is null then bd else least(bd, ad) end as d,
      case when bd is null or ad < bd then aid when ad is null or bd < ad then bid else least(aid, bid) end as id from n)
select frame_row_id, id as camera_row_id from m where d <= tol
"""

QUERIES = {
    "p2_found": p2_found,
    "p2_splits": p2_splits,
    "p6_found": p6_found,
    "p8_found": p8_found,
    "p8_coverage": p8_coverage,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_redacted": p10_redacted,
}
ORACLES: dict[str, str] = {"p2_found": P2_FOUND, "p2_splits": P2_SPLITS, "p6_found": P6_SQL, "p8_found": P8_FOUND}
