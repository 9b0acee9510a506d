"""Registered queries for the single operators and functions the models are made of.

Names start with the operator's number in the inventory.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.catalog import (
    full_scorecard,
    listening,
    matched,
    metrics,
    paid,
    performance,
    query,
    raw,
    register,
    source,
    sov,
    staged_content,
    staged_performance,
    targets,
)
from checks.fixtures import FIXTURES, SETTINGS, duckdb_text, fixture, table
from checks.oracle import LONGS, dbl, div, key_ig, key_tk, num, statement, strip
from postlens.fixed_values import COLLABORATION, COUNTERS, DELTA_COUNTERS, NETWORK_VIEWS, RATIO_METRICS
from postlens.functions import (
    clean_number,
    extract,
    initcap_words,
    is_blank,
    is_collaboration,
    network_name,
    parse_month_day,
    pauta_of,
    safe_divide,
    safe_double,
    safe_long,
    trim_all,
    within_limit,
)
from postlens.operators import (
    date_spine,
    exact_sum,
    fill_days,
    keep_latest,
    link_pairs,
    long_pairs,
    share_within,
    unpivot_present,
    with_deltas,
    zero_fill,
)
from postlens.plans import content, posts, scorecard
from postlens.plans.rebuild import open_region, publish_views, rebuild, rebuild_regions
from postlens.plans.stored_views import open_views, store_views
from postlens.sources import (
    TABLE_LAYOUTS,
    checkpoint_folder,
    read_landed_metrics,
    read_table,
    read_text_snapshot,
    stage,
    write_table,
)

Spark = SparkSession


def _folder(spark: Spark, name: str) -> str:
    return os.path.join(checkpoint_folder(spark), f"{name}-{uuid.uuid4().hex}")


# Sources and sinks.

@query("s01_landed_json", "SELECT * FROM fx_post_metrics")
def landed_json(spark: Spark, sf: str) -> DataFrame:
    """Records written as JSON lines under region and day folders and read back."""
    df = fixture(spark, sf, "fx_post_metrics")
    base = _folder(spark, "landed")
    timed = df.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp"))
    timed.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").partitionBy("region", "dt").json(base)
    return read_landed_metrics(spark, base, region="latam").select(*df.columns)


def _snapshot(short: str, name: str, fmt: str) -> None:
    @query(f"s02_{short}_snapshot", f"SELECT * FROM {name}")
    def run(spark: Spark, sf: str) -> DataFrame:
        df = fixture(spark, sf, name)
        path = _folder(spark, short)
        # NULL and '' stay apart in text files only with a mark for NULL.
        options = {"header": "true", "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false",
                   "ignoreTrailingWhiteSpace": "false"} if fmt == "csv" else {}
        df.write.format(fmt).options(**options).save(path)
        dated = dict(df.dtypes).get("fecha") == "date"
        return read_text_snapshot(spark, path, df.columns, dated, fmt, **options)


for _short, _name, _fmt in [
    ("register", "fx_register", "csv"), ("paid", "fx_paid", "csv"), ("targets", "fx_targets", "csv"),
    ("listening", "fx_listening", "parquet"), ("competitors", "fx_competitors", "parquet"),
    ("sponsors", "fx_sponsors", "parquet"),
]:
    _snapshot(_short, _name, _fmt)


@query("s04_table_sink", "SELECT * FROM m02")
def table_sink(spark: Spark, sf: str) -> DataFrame:
    df = metrics(spark, sf)
    path = _folder(spark, "post_metrics")
    write_table(df, path, *TABLE_LAYOUTS["post_metrics"])
    return read_table(spark, path, df.schema)


@query("s04_pruned_read", (
    "SELECT ingest_date, network, count(*) AS records, sum(likes)::BIGINT AS likes FROM m01 "
    "WHERE ingest_date >= DATE '2024-01-11' AND ingest_date < DATE '2024-01-21' GROUP BY ALL"
))
def pruned_read(spark: Spark, sf: str) -> DataFrame:
    """Only the folders of the asked days are listed and read."""
    df = raw(spark, sf)
    path = _folder(spark, "post_metrics_raw")
    write_table(df, path, *TABLE_LAYOUTS["post_metrics_raw"])
    day = F.col("ingest_date")
    return (
        read_table(spark, path, df.schema)
        .where((day >= F.lit("2024-01-11").cast("date")) & (day < F.lit("2024-01-21").cast("date")))
        .groupBy("ingest_date", "network")
        .agg(F.count("*").alias("records"), F.sum("likes").alias("likes"))
    )


@query("s05_network_views", "SELECT network, count(*) AS posts, sum(likes)::BIGINT AS likes FROM m03 WHERE network <> 'SNAPCHAT' GROUP BY ALL")
def network_views(spark: Spark, sf: str) -> DataFrame:
    names = publish_views(posts.network_slices(performance(spark, sf)))
    rows = " UNION ALL ".join(f"SELECT network, likes FROM {n}" for n in names)
    return spark.sql(f"SELECT network, count(*) AS posts, sum(likes) AS likes FROM ({rows}) GROUP BY network")


def _s05_sql() -> str:
    views = ["dm_match_content", "dm_match_coverage", "dm_listening", "dm_sentiment", "dm_sov"]
    counted = [f"SELECT '{n}' AS name, count(*) AS records, CAST({_MEASURES[n]} AS BIGINT) AS total FROM {_BUILT[n]}" for n in views]
    counted += [f"SELECT 'dw_{n}' AS name, count(*) AS records, CAST(sum(likes) AS BIGINT) AS total FROM m03 WHERE network = '{code}'" for code, n in NETWORK_VIEWS.items()]
    return " UNION ALL ".join(counted)


_BUILT = {
    "post_metrics_raw": "m01", "post_metrics": "m02", "dm_post_performance": "m03", "dm_platform_summary": "m05",
    "dm_match_content": "m06", "dm_match_coverage": "m07", "dm_format_performance": "m08",
    "dm_content_timeseries": "m09", "kpi_targets": "m10", "dm_listening": "m11", "dm_sentiment": "m12",
    "dm_sov": "m13", "dm_executive_scorecard": "m14",
}


# What a model's rows add up to, beside their number.
_MEASURES = {
    "post_metrics_raw": "sum(likes)", "post_metrics": "sum(likes_delta)", "dm_post_performance": "sum(reach)",
    "dm_platform_summary": "sum(likes_gained)", "dm_match_content": "sum(likes)",
    "dm_match_coverage": "sum(CASE WHEN match_status = 'matched' THEN 1 ELSE 0 END)",
    "dm_format_performance": "sum(total_reach)", "dm_content_timeseries": "sum(posts)", "kpi_targets": "sum(display_order)",
    "dm_listening": "count(*)", "dm_sentiment": "count(*)", "dm_sov": "count(*)", "dm_executive_scorecard": "count(num)",
}


# Which records and register rows each of two regions has; every one belongs to a region.
_REGION_ROWS = {
    "latam": {"post_metrics": "coalesce(country, '') <> 'PE'", "register": "market <> 'andino'"},
    "emea": {"post_metrics": "coalesce(country, '') = 'PE'", "register": "market = 'andino'"},
}


def _region_sql(region: str) -> str:
    """The models of one region, from its rows of the source tables."""
    own = {f"fx_{n}": f"SELECT * FROM ({duckdb_text(f'fx_{n}')}) WHERE {rows}" for n, rows in _REGION_ROWS[region].items()}
    return "SELECT * FROM (" + statement(" UNION ALL ".join(
        f"SELECT '{region}' AS region, '{name}' AS model, count(*) AS records, CAST({_MEASURES[name]} AS BIGINT) AS total FROM {step}"
        for name, step in _BUILT.items()
    ), own) + ")"


@query("s05_stored_views", _s05_sql())
def stored_views(spark: Spark, sf: str) -> DataFrame:
    """All ten views from their stored SQL, over a region rebuilt from files."""
    base, out = _folder(spark, "sheets"), _folder(spark, "region")
    sources = {"post_metrics": source(spark, sf, "fx_post_metrics")}
    for name in FIXTURES:
        if name not in ("fx_post_metrics", "fx_platform_posts"):
            sheet = name.removeprefix("fx_")
            fixture(spark, sf, name).write.parquet(f"{base}/{sheet}")
            sources[sheet] = spark.read.parquet(f"{base}/{sheet}")
    rebuild(sources, out, SETTINGS)
    open_views(spark, store_views(spark, base, out, SETTINGS, prefix="stored_"))
    names = ["dm_match_content", "dm_match_coverage", "dm_listening", "dm_sentiment", "dm_sov", *[f"dw_{n}" for n in NETWORK_VIEWS.values()]]
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS records, CAST({_MEASURES.get(n, 'sum(likes)')} AS BIGINT) AS total FROM stored_{n}" for n in names))


@query("s06_region_rebuild", " UNION ALL ".join(map(_region_sql, _REGION_ROWS)))
def region_rebuild(spark: Spark, sf: str) -> DataFrame:
    """Every model of two regions with rows of their own, built at the same time, opened and added up."""
    sources = {n.removeprefix("fx_"): source(spark, sf, n) for n in FIXTURES if n != "fx_platform_posts"}
    chosen = {region: replace(SETTINGS, region=region) for region in _REGION_ROWS}
    fed = {region: sources | {n: sources[n].where(rows) for n, rows in wanted.items()} for region, wanted in _REGION_ROWS.items()}
    folder = _folder(spark, "rebuild")
    rebuild_regions(fed, folder, chosen)
    opened = {region: open_region(fed[region], folder, settings) for region, settings in chosen.items()}
    counts = [
        opened[region][n].agg(
            F.count("*").alias("records"), F.expr(f"CAST({_MEASURES[n]} AS BIGINT)").alias("total")
        ).select(F.lit(region).alias("region"), F.lit(n).alias("model"), "records", "total")
        for region in chosen for n in _BUILT
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


# Projections, filters and predicates.

@query("p01_project_rename", "SELECT post_id, created_at AS published_at, views AS impressions, views, video_views AS views_2_3s FROM m01")
def project_rename(spark: Spark, sf: str) -> DataFrame:
    return raw(spark, sf).select(
        "post_id", F.col("created_at").alias("published_at"), F.col("views").alias("impressions"), "views",
        F.col("video_views").alias("views_2_3s"),
    )


@query("p02_all_but", "SELECT * EXCLUDE (copy, thumbnail_url) FROM m03")
def all_but(spark: Spark, sf: str) -> DataFrame:
    return performance(spark, sf).drop("copy", "thumbnail_url")


@query("p03_replace_in_place", (
    "SELECT * REPLACE (map {'INSTAGRAMBUSINESS':'Instagram','TIKTOKBUSINESS':'TikTok','FACEBOOKPAGE':'Facebook','TWITTER':'X',"
    "'YOUTUBECHANNEL':'YouTube','SNAPCHAT':'Snapchat'}[network] AS network) FROM m03"
))
def replace_in_place(spark: Spark, sf: str) -> DataFrame:
    return performance(spark, sf).withColumn("network", network_name("network"))


@query("p04_qualified_star", "SELECT k.tipo_contenido, p.* FROM reg k JOIN m03 p ON p.post_id = k.tk_key")
def qualified_star(spark: Spark, sf: str) -> DataFrame:
    keys = content.register_keys(register(spark, sf)).alias("k")
    return keys.join(performance(spark, sf).alias("p"), F.col("p.post_id") == F.col("k.tiktok_id")).select(
        "k.tipo_contenido", "p.*"
    )


@query("p05_predicate_column", "SELECT post_id, ingest_date, is_initial_snapshot, reach IS NULL AS reach_missing FROM m02")
def predicate_column(spark: Spark, sf: str) -> DataFrame:
    return metrics(spark, sf).select(
        "post_id", "ingest_date", "is_initial_snapshot", F.col("reach").isNull().alias("reach_missing")
    )


@query("p06_equality_filter", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def equality_filter(spark: Spark, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")


@query("p07_present_filter", "SELECT market, nombre, link_ig FROM fx_register WHERE trim(coalesce(link_ig, '')) <> ''")
def present_filter(spark: Spark, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_register").where(~is_blank("link_ig")).select("market", "nombre", "link_ig")


@query("p08_null_tolerant_exclusion", "SELECT * FROM fx_register WHERE tipo_contenido IS DISTINCT FROM 'Colaboración'")
def null_tolerant_exclusion(spark: Spark, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_register").where(~is_collaboration("tipo_contenido"))


@query("p09_in_list", (
    "SELECT metric_id, market, pauta, (metric_id IN ('vtr','er','ave_impressions','ave_views','shares_rate','saves_rate',"
    "'sov','sov_sponsors','positive_sentiment'))::BIGINT AS is_ratio FROM m10 WHERE market IN ('mexico','andino')"
))
def in_list(spark: Spark, sf: str) -> DataFrame:
    return targets(spark, sf).where(F.col("market").isin("mexico", "andino")).select(
        "metric_id", "market", "pauta", F.col("metric_id").isin(RATIO_METRICS).cast("bigint").alias("is_ratio")
    )


@query("p10_prefix_filter", "SELECT name, url, post_id FROM fx_paid WHERE url LIKE 'http%'")
def prefix_filter(spark: Spark, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_paid").where(F.col("url").startswith("http")).select("name", "url", "post_id")


@query("p11_null_arithmetic", "SELECT post_id, ingest_date, reach - engagement AS difference, likes + exits AS total FROM m01")
def null_arithmetic(spark: Spark, sf: str) -> DataFrame:
    return raw(spark, sf).select(
        "post_id", "ingest_date", (F.col("reach") - F.col("engagement")).alias("difference"),
        (F.col("likes") + F.col("exits")).alias("total"),
    )


@query("p12_typed_nulls", (
    "SELECT 'Colaboración' AS tipo_contenido, sc_key AS post_id, NULL::VARCHAR AS profile_id, NULL::BIGINT AS saves, "
    "NULL::DOUBLE AS roi, NULL::DATE AS fact_date, sc_reach AS reach FROM paid"
))
def typed_nulls(spark: Spark, sf: str) -> DataFrame:
    none = F.lit(None)
    return content.paid_rows(paid(spark, sf), SETTINGS).select(
        F.lit(COLLABORATION).alias("tipo_contenido"), F.col("key").alias("post_id"),
        none.cast("string").alias("profile_id"), none.cast("bigint").alias("saves"),
        none.cast("double").alias("roi"), none.cast("date").alias("fact_date"), "reach",
    )


@query("p13_literal_tag", "SELECT 'competitor' AS scope, * FROM fx_competitors")
def literal_tag(spark: Spark, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_competitors").select(F.lit("competitor").alias("scope"), "*")


# Joins. The SQL uses the plain LIKE.

def _keys(spark: Spark, sf: str, kind: str, column: str) -> DataFrame:
    return content.register_keys(register(spark, sf)).where(F.col(column).isNotNull()).select(
        "nombre", F.col(column).alias("key")
    )


def _pairs(spark: Spark, sf: str) -> tuple[DataFrame, DataFrame]:
    """Register rows with an image-post key, and the (key, post_id) found for them."""
    rows = _keys(spark, sf, content.BY_LINK, "ig_shortcode")
    return rows, link_pairs(staged_performance(spark, sf), rows.select("key").distinct())


@query("j_sub_link_pairs", (
    "SELECT DISTINCT k.key, p.post_id FROM (SELECT ig_key AS key FROM reg UNION SELECT sc_key FROM paid WHERE NOT is_id) k "
    "JOIN m03 p ON p.source_link LIKE '%' || k.key || '%'"
))
def substring_pairs(spark: Spark, sf: str) -> DataFrame:
    keys = content.sheet_keys(register(spark, sf), paid(spark, sf), SETTINGS).where(F.col("kind") == content.BY_LINK)
    return link_pairs(staged_performance(spark, sf), keys)


@query("j_sub_shuffled", (
    "SELECT DISTINCT k.key, p.post_id FROM (SELECT ig_key AS key FROM reg UNION SELECT sc_key FROM paid WHERE NOT is_id) k "
    "JOIN m03 p ON p.source_link LIKE '%' || k.key || '%'"
))
def substring_pairs_shuffled(spark: Spark, sf: str) -> DataFrame:
    """The same join as planned for a key table too large to broadcast."""
    keys = content.sheet_keys(register(spark, sf), paid(spark, sf), SETTINGS).where(F.col("kind") == content.BY_LINK)
    return link_pairs(staged_performance(spark, sf), keys, broadcast_bytes=0)


@query("j01_left_by_link", (
    "SELECT nombre, ig_key AS key, post_id FROM reg LEFT JOIN m03 ON source_link LIKE '%' || ig_key || '%' WHERE ig_key IS NOT NULL"
))
def left_by_link(spark: Spark, sf: str) -> DataFrame:
    rows, pairs = _pairs(spark, sf)
    return rows.join(pairs, "key", "left").select("nombre", "key", "post_id")


@query("j02_left_by_id", "SELECT nombre, tk_key AS key, post_id FROM reg LEFT JOIN m03 ON post_id = tk_key WHERE tk_key IS NOT NULL")
def left_by_id(spark: Spark, sf: str) -> DataFrame:
    ids = performance(spark, sf).select("post_id", F.col("post_id").alias("key"))
    return _keys(spark, sf, content.BY_ID, "tiktok_id").join(ids, "key", "left").select("nombre", "key", "post_id")


@query("j03_inner_by_link", "SELECT nombre, ig_key AS key, post_id FROM reg JOIN m03 ON source_link LIKE '%' || ig_key || '%'")
def inner_by_link(spark: Spark, sf: str) -> DataFrame:
    rows, pairs = _pairs(spark, sf)
    return rows.join(pairs, "key").select("nombre", "key", "post_id")


@query("j04_inner_by_id", "SELECT nombre, tk_key AS key, post_id FROM reg JOIN m03 ON post_id = tk_key")
def inner_by_id(spark: Spark, sf: str) -> DataFrame:
    ids = performance(spark, sf).select("post_id", F.col("post_id").alias("key"))
    return _keys(spark, sf, content.BY_ID, "tiktok_id").join(ids, "key").select("nombre", "key", "post_id")


def _spend(spark: Spark, sf: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Posts, and the spend of each post per matching key."""
    performance_table = staged_performance(spark, sf)
    sheet = paid(spark, sf)
    matches = content.key_matches(performance_table, register(spark, sf), sheet, SETTINGS)
    spend = (
        content.paid_rows(sheet, SETTINGS)
        .where(F.col("kind") == kind)
        .groupBy("kind", "key")
        .agg(F.max("spend").alias("spend"), F.max("reach").alias("spend_reach"))
        .join(matches, ["kind", "key"])
        .select("post_id", "key", "spend", "spend_reach")
    )
    return performance_table.select("post_id"), spend


@query("j05_left_spend_by_link", (
    "SELECT post_id, sc_key AS key, spend, spend_reach FROM m03 LEFT JOIN spend ON NOT is_id AND source_link LIKE '%' || sc_key || '%'"
))
def left_spend_by_link(spark: Spark, sf: str) -> DataFrame:
    rows, spend = _spend(spark, sf, content.BY_LINK)
    return rows.join(spend, "post_id", "left")


@query("j06_left_spend_by_id", "SELECT post_id, sc_key AS key, spend, spend_reach FROM m03 LEFT JOIN spend ON is_id AND post_id = sc_key")
def left_spend_by_id(spark: Spark, sf: str) -> DataFrame:
    rows, spend = _spend(spark, sf, content.BY_ID)
    return rows.join(spend, "post_id", "left")


@query("j07_either_key", "SELECT sc_key AS key FROM owned_keys")
def either_key(spark: Spark, sf: str) -> DataFrame:
    sheet = paid(spark, sf)
    matches = content.key_matches(staged_performance(spark, sf), register(spark, sf), sheet, SETTINGS)
    rows = content.paid_rows(sheet, SETTINGS).select("kind", "key").distinct()
    return rows.join(matches, ["kind", "key"], "left_semi").select("key")


@query("j08_anti", "SELECT post_id, username, spend FROM collab")
def anti(spark: Spark, sf: str) -> DataFrame:
    sheet = paid(spark, sf)
    matches = content.key_matches(staged_performance(spark, sf), register(spark, sf), sheet, SETTINGS)
    return content.collaborations(sheet, matches, SETTINGS).select("post_id", "username", "spend")


@query("j09_constant_dimension", "SELECT market, pauta, metric_id, section, metric_label, target_value FROM m10")
def constant_dimension(spark: Spark, sf: str) -> DataFrame:
    return targets(spark, sf).select(        "market", "pauta", "metric_id", "section", "metric_label", "target_value"
    )


@query("j10_target_join", (
    "SELECT published_date, market, pauta, metric_id, num, den, target_value FROM brand_long JOIN m10 USING (metric_id, market, pauta)"
))
def target_join(spark: Spark, sf: str) -> DataFrame:
    rows = scorecard.brand_metrics(listening(spark, sf), sov(spark, sf), SETTINGS.focus_brand)
    return rows.join(targets(spark, sf), ["metric_id", "market", "pauta"]).select(
        "published_date", "market", "pauta", "metric_id", "num", "den", "target_value"
    )


@query("j11_trend_join", "SELECT metric_id, network, market, pauta, published_date, trend_pct FROM m14")
def trend_join(spark: Spark, sf: str) -> DataFrame:
    return full_scorecard(spark, sf).select("metric_id", "network", "market", "pauta", "published_date", "trend_pct")


_EVENT_DAYS = "SELECT ts::DATE AS day, event_type, count(*) AS events FROM events GROUP BY ALL"


@query("j12_spine_fill", (
    "SELECT day, o_orderstatus, coalesce(orders, 0) AS orders FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE "
    "AS day FROM days) CROSS JOIN (SELECT DISTINCT o_orderstatus FROM days) LEFT JOIN days USING (day, o_orderstatus)"
), {"days": "SELECT o_orderdate::DATE AS day, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL"})
def spine_fill(spark: Spark, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    days = stage(orders.groupBy("day", "o_orderstatus").agg(F.count("*").alias("orders")), "days")
    return fill_days(days, ["o_orderstatus"], "day").select("day", "o_orderstatus", *zero_fill(["orders"]))


def _event_days(spark: Spark, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(F.count("*").alias("events"))
    )


@query("j13_one_row_bounds", (
    "SELECT o_orderkey, (o_orderdate::DATE - (SELECT min(o_orderdate::DATE) FROM orders))::BIGINT AS age FROM orders"
))
def one_row_bounds(spark: Spark, sf: str) -> DataFrame:
    """Bounds of the whole table beside each row, as a scalar subquery."""
    orders = table(spark, sf, "orders")
    first = orders.agg(F.min(F.to_date("o_orderdate"))).scalar()
    return orders.select("o_orderkey", F.datediff(F.to_date("o_orderdate"), first).cast("bigint").alias("age"))


@query("j14_expand_dates", "SELECT unnest(generate_series(min(ts::DATE), max(ts::DATE), INTERVAL 1 DAY))::DATE AS day FROM events")
def expand_dates(spark: Spark, sf: str) -> DataFrame:
    bounds = table(spark, sf, "events").agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))


@query("j15_spine_by_dimension", "SELECT published_date, network, region, market, pauta FROM spine")
def spine_by_dimension(spark: Spark, sf: str) -> DataFrame:
    own = content.own_content(staged_content(spark, sf)).where(F.col("published_date").isNotNull()).withColumn(
        "market", F.coalesce("market", F.lit("sin_market"))
    )
    return date_spine(own, ["network", "region", "market", "pauta"], "published_date")


# Aggregations. Money is summed in cents, so that sums do not depend on row order.

_SQL_CENTS = "round(l_extendedprice * 100)::BIGINT"


def _cents() -> Column:
    return F.round(F.col("l_extendedprice") * 100).cast("bigint")


@query("a01_sum", f"SELECT l_returnflag, l_linestatus, sum({_SQL_CENTS})::BIGINT AS cents, sum(l_linenumber)::BIGINT AS lines FROM lineitem GROUP BY ALL")
def agg_sum(spark: Spark, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(_cents()).alias("cents"), F.sum("l_linenumber").alias("lines")
    )


@query("a01_exact_sum", (
    "SELECT l_returnflag, l_linestatus, sum((l_extendedprice * (1 - l_discount))::DECIMAL(31, 16))::DOUBLE AS revenue FROM lineitem GROUP BY ALL"
))
def sum_of_doubles(spark: Spark, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    return items.groupBy("l_returnflag", "l_linestatus").agg(exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query("a02_count", "SELECT l_suppkey, count(*) AS items FROM lineitem GROUP BY ALL")
def agg_count(spark: Spark, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("items"))


@query("a03_distinct_beside_sums", (
    "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, sum(o_orderkey)::BIGINT AS keys, count(*) AS orders FROM orders GROUP BY ALL"
))
def agg_distinct(spark: Spark, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.sum("o_orderkey").alias("keys"), F.count("*").alias("orders")
    )


@query("a03_posts_in_range", (
    "SELECT network, pauta, count(DISTINCT post_id) AS posts FROM own WHERE published_date BETWEEN DATE '2023-10-10' AND DATE '2023-12-20' GROUP BY ALL"
))
def posts_in_range(spark: Spark, sf: str) -> DataFrame:
    """Different posts of a range from stored bitmaps of its days."""
    days = content.content_posts(staged_content(spark, sf))
    return content.posts_in_range(stage(days, "content_posts"), ["network", "pauta"], dt.date(2023, 10, 10), dt.date(2023, 12, 20))


@query("a04_average", "SELECT network, avg(reach) AS avg_reach, avg(engagement) AS avg_engagement FROM m01 GROUP BY ALL")
def agg_average(spark: Spark, sf: str) -> DataFrame:
    return raw(spark, sf).groupBy("network").agg(F.avg("reach").alias("avg_reach"), F.avg("engagement").alias("avg_engagement"))


@query("a05_global_bounds", "SELECT min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders")
def agg_bounds(spark: Spark, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


@query("a06_count_if", "SELECT network, count(*) FILTER (WHERE reach IS NOT NULL) AS with_reach FROM m01 GROUP BY ALL")
def agg_count_if(spark: Spark, sf: str) -> DataFrame:
    return raw(spark, sf).groupBy("network").agg(F.count_if(F.col("reach").isNotNull()).alias("with_reach"))


@query("a07_conditional_sum", "SELECT * FROM voice_days")
def agg_conditional_sum(spark: Spark, sf: str) -> DataFrame:
    return scorecard.voice_by_day(sov(spark, sf), SETTINGS.focus_brand)


@query("a08_conditional_max", (
    "SELECT user_id, max(value) FILTER (WHERE event_type = 'purchase') AS best_purchase, "
    "max(value) FILTER (WHERE event_type = 'click') AS best_click FROM events GROUP BY ALL"
))
def agg_conditional_max(spark: Spark, sf: str) -> DataFrame:
    def best(kind: str) -> Column:
        return F.max(F.when(F.col("event_type") == kind, F.col("value")))

    return table(spark, sf, "events").groupBy("user_id").agg(
        best("purchase").alias("best_purchase"), best("click").alias("best_click")
    )


@query("a09_grouping_sets", "SELECT * FROM cube")
def agg_grouping_sets(spark: Spark, sf: str) -> DataFrame:
    return scorecard.rollup_cells(scorecard.content_cells(matched(spark, sf)))


@query("a09_grouping_sets_items", (
    f"SELECT l_shipdate::DATE AS day, if(grouping(l_returnflag) = 1, 'total', l_returnflag) AS flag, "
    f"if(grouping(l_linestatus) = 1, 'total', l_linestatus) AS status, sum({_SQL_CENTS})::BIGINT AS cents, count(*) AS items "
    "FROM lineitem GROUP BY l_shipdate::DATE, CUBE (l_returnflag, l_linestatus)"
))
def agg_grouping_sets_items(spark: Spark, sf: str) -> DataFrame:
    """Grouping sets over pre-aggregated cells."""
    day, flag, status = F.col("day"), F.col("l_returnflag"), F.col("l_linestatus")
    cells = (
        table(spark, sf, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_linestatus")
        .agg(F.sum(_cents()).alias("cents"), F.count("*").alias("items"))
    )
    rolled = cells.groupingSets([[day, flag, status], [day, flag], [day, status], [day]], day, flag, status).agg(
        F.sum("cents").alias("cents"), F.sum("items").alias("items"),
        F.grouping("l_returnflag").alias("all_flags"), F.grouping("l_linestatus").alias("all_statuses"),
    )
    return rolled.select(
        "day", F.when(F.col("all_flags") == 1, "total").otherwise(flag).alias("flag"),
        F.when(F.col("all_statuses") == 1, "total").otherwise(status).alias("status"), "cents", "items",
    )


@query("a10_ratio_of_sums", f"SELECT country, network, {div('sum(engagement)', 'sum(reach)')} AS engagement_rate FROM m01 GROUP BY ALL")
def agg_ratio(spark: Spark, sf: str) -> DataFrame:
    return raw(spark, sf).groupBy("country", "network").agg(
        safe_divide(F.sum("engagement"), F.sum("reach")).alias("engagement_rate")
    )


@query("a11_group_by_expression", "SELECT upper(country) AS country_code, count(*) AS records FROM fx_post_metrics GROUP BY ALL")
def agg_expression(spark: Spark, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_post_metrics").groupBy(F.upper("country").alias("country_code")).agg(F.count("*").alias("records"))


@query("a12_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg_select_distinct(spark: Spark, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("a13_gain_or_cumulative", (
    "SELECT network, " + ", ".join(f"sum(coalesce({c}_delta, {c}))::BIGINT AS {c}_gained" for c in DELTA_COUNTERS) + " FROM m02 GROUP BY ALL"
))
def agg_gains(spark: Spark, sf: str) -> DataFrame:
    return metrics(spark, sf).groupBy("network").agg(
        *[F.sum(F.coalesce(f"{c}_delta", c)).alias(f"{c}_gained") for c in DELTA_COUNTERS]
    )


@query("a14_max_per_key", "SELECT sc_key AS key, if(is_id, 'id', 'link') AS kind, spend, spend_reach FROM spend")
def agg_max_per_key(spark: Spark, sf: str) -> DataFrame:
    return content.paid_rows(paid(spark, sf), SETTINGS).groupBy("key", "kind").agg(
        F.max("spend").alias("spend"), F.max("reach").alias("spend_reach")
    )


@query("a15_mixed_rollup", "SELECT market, pauta, metric_id, target_value FROM m10")
def agg_mixed(spark: Spark, sf: str) -> DataFrame:
    return targets(spark, sf).select("market", "pauta", "metric_id", "target_value")


# Windows and top-1.

@query("w01_latest_record", "SELECT post_id, ingest_date, _ingested_at, likes, reach FROM m02_daily")
def latest_record(spark: Spark, sf: str) -> DataFrame:
    return posts.latest_records(raw(spark, sf)).select("post_id", "ingest_date", "_ingested_at", "likes", "reach")


@query("w02_latest_snapshot", "SELECT post_id, fact_date, likes, likes_delta FROM m03")
def latest_snapshot(spark: Spark, sf: str) -> DataFrame:
    return keep_latest(metrics(spark, sf), ["post_id"], "ingest_date", ties=False).select(
        "post_id", "fact_date", "likes", "likes_delta"
    )


@query("w03_previous_values", (
    "SELECT post_id, ingest_date, prev_ingest_date, " + ", ".join(f"{c}_delta" for c in DELTA_COUNTERS) + " FROM m02"
))
def previous_values(spark: Spark, sf: str) -> DataFrame:
    daily = posts.latest_records(raw(spark, sf))
    return with_deltas(daily, "post_id", "ingest_date", DELTA_COUNTERS).select(
        "post_id", "ingest_date", "prev_ingest_date", *[f"{c}_delta" for c in DELTA_COUNTERS]
    )


@query("w04_rows_per_platform", (
    "SELECT nombre, platform, link FROM (SELECT row_number() OVER () AS row_id, nombre, unnest(['instagram', 'tiktok']) AS platform, "
    "unnest([link_ig, link_tiktok]) AS link FROM fx_register)"
))
def rows_per_platform(spark: Spark, sf: str) -> DataFrame:
    """Rows keep apart without a row number, since nothing is grouped by row."""
    return fixture(spark, sf, "fx_register").select("nombre", F.inline(F.array(
        F.struct(F.lit("instagram").alias("platform"), F.col("link_ig").alias("link")),
        F.struct(F.lit("tiktok").alias("platform"), F.col("link_tiktok").alias("link")),
    )))


@query("w05_first_match", "SELECT content_name, platform, matched_post_id FROM m07")
def first_match(spark: Spark, sf: str) -> DataFrame:
    return content.match_coverage(register(spark, sf), staged_performance(spark, sf), SETTINGS).select(
        "content_name", "platform", "matched_post_id"
    )


@query("w06_share_of_partition", (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity, "
    "l_quantity / sum(l_quantity) OVER (PARTITION BY l_returnflag, l_linestatus) AS share FROM lineitem"
))
def share_of_partition(spark: Spark, sf: str) -> DataFrame:
    """Three flags share all rows; no task has to hold one flag's rows."""
    items, keys = table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"]
    return share_within(items, "l_quantity", keys, "share", keep=stage).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "share"
    )


@query("k01_top_one", (
    "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1"
))
def top_one(spark: Spark, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_latest(orders, ["o_custkey"], "o_orderdate")


@query("k02_display_order", "SELECT display_order, metric_label, market, pauta, target_value FROM m10 ORDER BY ALL")
def display_order(spark: Spark, sf: str) -> DataFrame:
    return targets(spark, sf).select("display_order", "metric_label", "market", "pauta", "target_value").orderBy(
        "display_order", "market", "pauta"
    )


# Set operations and reshaping.

@query("u01_union_all", "SELECT * FROM voices WHERE fecha IS NOT NULL")
def union_all(spark: Spark, sf: str) -> DataFrame:
    return sov(spark, sf).select("fecha", "scope", "brand_key", "mentions")


@query("u02_union_distinct", "SELECT * FROM owned")
def union_distinct(spark: Spark, sf: str) -> DataFrame:
    """Duplicates go on five narrow columns, before the wide rows are attached."""
    performance_table, sheet, rows = staged_performance(spark, sf), paid(spark, sf), register(spark, sf)
    matches = content.key_matches(performance_table, rows, sheet, SETTINGS)
    cells = stage(content.owned_cells(rows, sheet, matches, SETTINGS), "owned_cells")
    return cells.join(performance_table, "post_id").select(*content.CONTENT_COLUMNS)


@query("u03_set_exclusion", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def set_exclusion(spark: Spark, sf: str) -> DataFrame:
    finished = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(finished, "c_custkey", "left_anti")


@query("r01_unpivot_present", " UNION ALL ".join(
    f"SELECT fecha, '{b}' AS brand_key, {b} AS mentions_text FROM fx_sponsors WHERE {b} IS NOT NULL" for b in SETTINGS.sponsor_brands
))
def unpivot_drops_nulls(spark: Spark, sf: str) -> DataFrame:
    return unpivot_present(
        fixture(spark, sf, "fx_sponsors"), ["fecha"], SETTINGS.sponsor_brands, "brand_key", "mentions_text"
    )


@query("r02_unpivot_all", " UNION ALL ".join(
    f"SELECT fecha, '{b}' AS brand_key, {b} AS mentions_text FROM fx_sponsors" for b in SETTINGS.sponsor_brands
))
def unpivot_keeps_nulls(spark: Spark, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_sponsors").unpivot(["fecha"], list(SETTINGS.sponsor_brands), "brand_key", "mentions_text")


@query("r03_long_metrics", "SELECT * FROM content_long")
def long_metrics(spark: Spark, sf: str) -> DataFrame:
    return scorecard.content_metrics(scorecard.rollup_cells(scorecard.content_cells(matched(spark, sf))))


@query("r03_long_pairs", (
    "SELECT post_id, fact_date, 'er' AS metric_id, engagement::DOUBLE AS num, reach::DOUBLE AS den FROM m03 UNION ALL "
    "SELECT post_id, fact_date, 'likes', likes::DOUBLE, 0::DOUBLE FROM m03"
))
def long_pairs_of_posts(spark: Spark, sf: str) -> DataFrame:
    return long_pairs(performance(spark, sf), ["post_id", "fact_date"], {
        "er": (F.col("engagement"), F.col("reach")), "likes": (F.col("likes"), F.lit(0)),
    })


@query("r04_long_by_platform", (
    f"SELECT nombre AS content_name, 'instagram' AS platform, {key_ig('link_ig')} AS key FROM fx_register UNION ALL "
    f"SELECT nombre, 'tiktok', {key_tk('link_tiktok')} FROM fx_register"
))
def long_by_platform(spark: Spark, sf: str) -> DataFrame:
    coverage = content.match_coverage(register(spark, sf), staged_performance(spark, sf), SETTINGS)
    return coverage.select("content_name", "platform", F.coalesce("ig_shortcode", "tiktok_id").alias("key"))


@query("r05_trend", "SELECT * FROM trend")
def trend(spark: Spark, sf: str) -> DataFrame:
    cells = stage(scorecard.content_cells(matched(spark, sf)), "content_cells")
    return scorecard.trend(cells, SETTINGS)


@query("r06_date_spine", (
    "SELECT d::DATE AS day, o_orderstatus FROM (SELECT unnest(generate_series(min(o_orderdate::DATE), max(o_orderdate::DATE), "
    "INTERVAL 1 DAY)) AS d FROM orders) CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders)"
))
def spine(spark: Spark, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return date_spine(orders, ["o_orderstatus"], "day")


@query("r07_zero_fill", "SELECT post_id, ingest_date, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in LONGS) + " FROM m01")
def zero_filled(spark: Spark, sf: str) -> DataFrame:
    return raw(spark, sf).select("post_id", "ingest_date", *zero_fill(COUNTERS))


# Functions, each over a whole source table.

def _function(name: str, fx: str, keys: list[str], columns: dict[str, tuple[Callable[[], Column], str]]) -> None:
    """A query that shows some key columns and one column per expression."""
    sql = ", ".join([*keys, *[f"{text} AS {out}" for out, (_, text) in columns.items()]])

    @query(name, f"SELECT {sql} FROM {fx}")
    def run(spark: Spark, sf: str) -> DataFrame:
        df = fixture(spark, sf, fx) if fx in FIXTURES else table(spark, sf, fx)
        return df.select(*keys, *[expr().alias(out) for out, (expr, _) in columns.items()])


_POST, _SHEET_ROW, _PAID_ROW = ["post_id", "_ingested_at"], ["nombre"], ["name"]
_c = F.col


def _change() -> Column:
    return safe_divide(_c("shares") - _c("saves"), "saves")


# Where a word starts: at the first letter and after a blank or one of the breaks.
_INITCAP_SQL = (
    "list_aggregate(list_transform(range(1, length(t) + 1), lambda i: CASE WHEN i = 1 OR contains(' _/-.', substr(t, i - 1, 1)) "
    "THEN upper(substr(t, i, 1)) ELSE lower(substr(t, i, 1)) END), 'string_agg', '')"
)
_WORDS_SQL = "(p_type || '_' || p_name || '/x-' || p_brand || '.a')"


def _words() -> Column:
    return F.concat("p_type", F.lit("_"), "p_name", F.lit("/x-"), "p_brand", F.lit(".a"))


for _args in [
    ("f01_safe_long", "fx_post_metrics", _POST, {
        f"{c}_n": (lambda c=c: safe_long(c), num(c)) for c in ["reach", "exits", "taps_back", "likes"]}),
    ("f02_safe_double", "fx_post_metrics", _POST, {
        f"{c}_x": (lambda c=c: safe_double(c), dbl(c)) for c in ["engagement_rate", "roi", "full_video_watched_rate", "total_time_watched"]}),
    ("f03_cast_double", "events", ["event_id"], {
        "user_x": (lambda: _c("user_id").cast("double"), "user_id::DOUBLE"), "none": (lambda: F.lit(None).cast("double"), "NULL::DOUBLE")}),
    ("f04_safe_divide", "fx_platform_posts", ["event_id"], {
        "ratio": (lambda: safe_divide("likes", "post_reach"), div("likes", "post_reach")),
        "none": (lambda: safe_divide("link_clicks", "reach"), div("link_clicks", "reach"))}),
    ("f05_extract", "fx_post_metrics", _POST, {
        "tag": (lambda: extract("copy", SETTINGS.tag_pattern), "nullif(regexp_extract(copy, '#(TAG[A-Z0-9_]+)', 1), '')"),
        "code": (lambda: extract("source_link", r"/p/([^/?]+)"), "nullif(regexp_extract(source_link, '/p/([^/?]+)', 1), '')")}),
    ("f06_contains_pattern", "fx_register", _SHEET_ROW, {
        "story": (lambda: _c("link_ig").rlike(r"instagram\.com/s/"), "regexp_matches(link_ig, 'instagram\\.com/s/')"),
        "short": (lambda: _c("link_tiktok").rlike(r"tiktok\.com/t/"), "regexp_matches(link_tiktok, 'tiktok\\.com/t/')")}),
    ("f07_clean_number", "fx_paid", _PAID_ROW, {
        "spend": (lambda: safe_double(clean_number("inversion_ejecutada", "$, ")), dbl(strip("inversion_ejecutada", "$, "))),
        "reach_n": (lambda: safe_long(clean_number("reach", " ,")), num(strip("reach", " ,"))),
        "vtr": (lambda: safe_double(clean_number("vtr_50", "% ")), dbl(strip("vtr_50", "% ")))}),
    ("f08_trim", "fx_paid", _PAID_ROW, {"day": (lambda: trim_all("published_date"), "trim(published_date)")}),
    ("f09_upper", "fx_post_metrics", _POST, {"code": (lambda: F.upper("country"), "upper(country)")}),
    ("f10_concat", "fx_register", _SHEET_ROW, {
        "both": (lambda: F.concat("link_ig", F.lit("|"), "link_tiktok"), "link_ig || '|' || link_tiktok")}),
    ("f11_like_pattern", "fx_post_metrics", _POST, {
        "hit": (lambda: F.expr("source_link like concat('%', 'A_0000', '%')"), "source_link LIKE '%' || 'A_0000' || '%'")}),
    ("f12_initcap_words", "part", ["p_partkey"], {
        "words": (lambda: initcap_words(_words()), _INITCAP_SQL.replace("(t,", f"({_WORDS_SQL},").replace("length(t)", f"length({_WORDS_SQL})"))}),
    ("f13_coalesce", "fx_register", _SHEET_ROW, {
        "kind": (lambda: F.coalesce("tipo_contenido", "pauta_tiktok", F.lit("-")), "coalesce(tipo_contenido, pauta_tiktok, '-')")}),
    ("f14_if", "fx_register", _SHEET_ROW, {
        "flag": (lambda: F.when(_c("pauta_tiktok") == "Pagado", "yes").otherwise("no"), "if(pauta_tiktok = 'Pagado', 'yes', 'no')")}),
    ("f15_simple_case", "fx_register", _SHEET_ROW, {
        "pauta": (lambda: pauta_of("pauta_ig"), "CASE pauta_ig WHEN 'Pagado' THEN 'paid' ELSE 'organic' END")}),
    ("f16_searched_case", "orders", ["o_orderkey"], {
        "size": (lambda: F.when(_c("o_totalprice") > 300000, "large").when(_c("o_totalprice") > 100000, "middle").otherwise("small"),
                 "CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'small' END")}),
    ("f17_abs_guard", "fx_platform_posts", ["event_id"], {
        "change": (lambda: within_limit(_change(), 5),
                   f"CASE WHEN abs({div('shares - saves', 'saves')}) <= 5 THEN {div('shares - saves', 'saves')} END")}),
    ("f18_date_of_time", "orders", ["o_orderkey"], {"day": (lambda: F.to_date("o_orderdate"), "o_orderdate::DATE")}),
    ("f19_date_diff", "orders", ["o_orderkey"], {
        "days": (lambda: F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("bigint"),
                 "(o_orderdate::DATE - DATE '1995-01-01')::BIGINT")}),
    ("f20_date_sub", "orders", ["o_orderkey"], {
        "before": (lambda: F.date_sub(F.to_date("o_orderdate"), 30), "(o_orderdate::DATE - 30)::DATE")}),
    ("f21_parse_month_day", "fx_paid", _PAID_ROW, {
        "day": (lambda: parse_month_day("published_date", 2026), "try_strptime(trim(published_date) || ' 2026', '%B %d %Y')::DATE")}),
    ("f22_date_array", "fx_listening", ["fecha"], {
        "day": (lambda: F.explode(F.sequence("fecha", F.date_add("fecha", 2))),
                "unnest(generate_series(fecha, fecha + 2, INTERVAL 1 DAY))::DATE")}),
    ("f24_inline_structs", "orders", ["o_orderkey"], {
        "part": (lambda: F.explode(F.array(F.col("o_orderstatus"), F.col("o_orderpriority"))), "unnest([o_orderstatus, o_orderpriority])")}),
]:
    _function(*_args)


@query("f25_grouping", (
    "SELECT o_orderstatus, o_orderpriority, grouping(o_orderpriority)::BIGINT AS all_priorities, count(*) AS orders "
    "FROM orders GROUP BY o_orderstatus, ROLLUP (o_orderpriority)"
))
def grouping_flag(spark: Spark, sf: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf, "orders").groupingSets([[status, priority], [status]], status, priority).agg(
        F.grouping("o_orderpriority").cast("bigint").alias("all_priorities"), F.count("*").alias("orders")
    )
