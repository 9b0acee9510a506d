"""Source tables in the shape the models read, as SQL over the provided tables.

One text serves both engines: ``{events}``, ``{customer}`` and ``{part}`` stand
for the provided tables. Every statement reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlens.settings import Settings

SETTINGS = Settings(
    region="latam",
    tag_prefix="TAG",
    market_overrides={"Regional (A, B, ...)": "carcam"},
    paid_year=2026,
    collaboration_market="mexico",
    competitor_brands=["b0", "b1", "b2", "b3", "b4", "b5"],
    sponsor_brands=["b2", "s1", "s2", "s3", "s4", "s5", "s6", "s7", "s8"],
    brand_labels={"b0": "Brand Zero", "b2": "Focus Brand", "s1": "S & One"},
    focus_brand="b2",
)

FX_POST_METRICS = """
SELECT
  CASE user_id % 8 WHEN 0 THEN 'MX' WHEN 1 THEN 'co' WHEN 2 THEN 'CR' WHEN 3 THEN 'PE' WHEN 4 THEN 'AR' WHEN 5 THEN 'mx' ELSE CAST(NULL AS STRING) END AS country,
  CASE user_id % 7 WHEN 0 THEN 'INSTAGRAMBUSINESS' WHEN 1 THEN 'TIKTOKBUSINESS' WHEN 2 THEN 'INSTAGRAMBUSINESS' WHEN 3 THEN 'FACEBOOKPAGE'
                   WHEN 4 THEN 'TWITTER' WHEN 5 THEN 'YOUTUBECHANNEL' ELSE 'SNAPCHAT' END AS network,
  CASE WHEN user_id % 8 = 6 THEN 'Regional (A, B, ...)' ELSE 'acct_' || CAST(user_id % 5 AS STRING) END AS username,
  'prof' || CAST(user_id % 11 AS STRING) AS profile_id,
  'sn' || CAST(user_id % 11 AS STRING) AS social_network_id,
  CASE WHEN user_id % 7 = 1 THEN CAST(7000000000 + user_id AS STRING) ELSE 'p' || CAST(user_id AS STRING) END AS post_id,
  CAST(DATE '2023-10-01' + CAST(user_id % 90 AS INT) AS TIMESTAMP) AS created_at,
  CASE user_id % 3 WHEN 0 THEN 'REEL' WHEN 1 THEN 'IMAGE' ELSE 'VIDEO' END AS format,
  CASE user_id % 4 WHEN 0 THEN 'go #TAGALPHA now #TAGBETA' WHEN 1 THEN 'x #TAG_2' WHEN 2 THEN 'no tag' ELSE CAST(NULL AS STRING) END AS copy,
  CASE WHEN user_id % 7 = 0 THEN 'https://www.instagram.com/reel/A_' || LPAD(CAST(user_id AS STRING), 6, '0') || '/'
       WHEN user_id % 7 = 2 THEN 'https://www.instagram.com/p/AX' || LPAD(CAST(user_id AS STRING), 6, '0') || '/'
       ELSE 'https://example.com/' || CAST(user_id AS STRING) END AS source_link,
  'https://img.example.com/' || CAST(user_id AS STRING) AS thumbnail_url,
  CAST(event_id % 50 AS STRING) AS comments,
  CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS STRING) ELSE CAST(event_id * 2 + 5 AS STRING) END AS engagement,
  CASE WHEN tie = 1 THEN CAST(NULL AS STRING) ELSE CAST(event_id + 1 AS STRING) END AS likes,
  CASE event_id % 17 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN '0' ELSE CAST(event_id * 10 AS STRING) END AS reach,
  CAST(event_id % 40 AS STRING) AS saves,
  CASE WHEN tie = 2 THEN CAST(NULL AS STRING) ELSE CAST(event_id % 30 AS STRING) END AS shares,
  CAST(event_id * 15 AS STRING) AS views,
  CAST(event_id * 4 AS STRING) AS video_views,
  CAST(event_id % 9 AS STRING) AS follows,
  CASE event_id % 5 WHEN 0 THEN ' 12 ' WHEN 1 THEN '+7' WHEN 2 THEN '1.5' WHEN 3 THEN '1e3' ELSE '-3' END AS exits,
  CASE event_id % 3 WHEN 0 THEN '1,200' WHEN 1 THEN '0x1F' ELSE '99999999999999999999' END AS taps_back,
  CAST(NULL AS STRING) AS taps_forward,
  CAST(event_id % 6 AS STRING) AS profile_activity,
  CAST(event_id % 7 AS STRING) AS profile_visits,
  CAST(event_id % 3 AS STRING) AS posts_count,
  CASE event_id % 5 WHEN 0 THEN '1e-3' WHEN 1 THEN ' 2.5 ' WHEN 2 THEN '1.5d' WHEN 3 THEN '2f' ELSE '-.5' END AS engagement_rate,
  CASE event_id % 3 WHEN 0 THEN '0x1p3' WHEN 1 THEN '7.' ELSE '1,5' END AS roi,
  CAST(event_id % 60 AS STRING) || '.25' AS ig_reels_avg_watch_time,
  CAST(NULL AS STRING) AS ig_reels_video_view_total_time,
  CAST(event_id % 8 AS STRING) AS average_time_watched,
  CAST(event_id AS STRING) || 'e2' AS total_time_watched,
  CASE WHEN event_id % 4 = 0 THEN '0.25' WHEN event_id % 4 = 1 THEN '0.5' WHEN event_id % 4 = 2 THEN 'bad' ELSE '0.125' END AS full_video_watched_rate,
  'latam' AS region, CAST(ts AS DATE) AS dt, ts AS _ingested_at
FROM (SELECT *, 0 AS tie FROM {events}
      UNION ALL SELECT *, 1 AS tie FROM {events} WHERE event_id % 50 = 7
      UNION ALL SELECT *, 2 AS tie FROM {events} WHERE event_id % 50 = 7) e
"""

FX_REGISTER = """
SELECT
  CASE c_custkey % 3 WHEN 0 THEN 'mexico' WHEN 1 THEN 'andino' ELSE 'carcam' END AS market,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 30 AS INT) AS STRING) AS fecha,
  'item ' || CAST(c_custkey AS STRING) AS nombre,
  CASE c_custkey % 5
    WHEN 0 THEN 'https://www.instagram.com/reel/A_' || LPAD(CAST(c_custkey % 400 AS STRING), 6, '0') || '/?igsh=x'
    WHEN 1 THEN 'https://www.instagram.com/s/abc' WHEN 2 THEN '  '
    WHEN 3 THEN 'https://www.instagram.com/p/A_' || LPAD(CAST(c_custkey % 400 AS STRING), 6, '0')
    ELSE CASE c_custkey % 2 WHEN 0 THEN CAST(NULL AS STRING) ELSE 'see brief' END END AS link_ig,
  CASE c_custkey % 7
    WHEN 1 THEN 'https://www.tiktok.com/@a/video/' || CAST(7000000000 + c_custkey % 400 AS STRING) || '?x=1'
    WHEN 2 THEN 'https://www.tiktok.com/t/ZM1' WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN ''
    WHEN 5 THEN 'https://www.tiktok.com/@a/video/' || CAST(7000000000 + c_custkey AS STRING) ELSE 'tbd' END AS link_tiktok,
  'autor' || CAST(c_custkey % 4 AS STRING) AS autor, 'txt' AS copy_out,
  CASE c_custkey % 9 WHEN 0 THEN 'Video' WHEN 1 THEN 'Colaboración' WHEN 5 THEN 'Colaboración' ELSE CAST(NULL AS STRING) END AS tipo_contenido,
  CASE c_custkey % 3 WHEN 0 THEN 'Orgánico' WHEN 1 THEN 'Pagado' ELSE 'otro' END AS pauta_ig,
  CASE c_custkey % 2 WHEN 0 THEN 'Pagado' ELSE CAST(NULL AS STRING) END AS pauta_tiktok
FROM {customer}
"""

FX_PAID = """
SELECT
  CASE p_partkey % 4 WHEN 0 THEN 'June 8' WHEN 1 THEN ' July 14 ' WHEN 2 THEN 'Jun 3' ELSE 'soon' END AS published_date,
  'name ' || CAST(p_partkey AS STRING) AS name, 'creator' || CAST(p_partkey % 9 AS STRING) AS creador,
  'x' AS network, CASE p_partkey % 2 WHEN 0 THEN 'REEL' ELSE 'VIDEO' END AS format,
  CASE WHEN p_partkey % 19 = 0 THEN 'pending' ELSE 'https://example.com/c/' || CAST(p_partkey AS STRING) END AS url,
  CASE p_partkey % 3 WHEN 0 THEN '$1,250.50' WHEN 1 THEN '$ 300' ELSE '-' END AS inversion_ejecutada,
  CASE p_partkey % 5 WHEN 0 THEN '1,200' WHEN 1 THEN '3 400' WHEN 2 THEN '0' WHEN 3 THEN CAST(NULL AS STRING) ELSE CAST(p_partkey * 7 AS STRING) END AS reach,
  CAST(p_partkey * 9 AS STRING) AS impressions, CAST(p_partkey * 3 AS STRING) AS views,
  CASE p_partkey % 3 WHEN 0 THEN '25%' WHEN 1 THEN '12.5 %' ELSE 'na' END AS vtr_50,
  CAST(p_partkey AS STRING) AS likes, CAST(p_partkey % 21 AS STRING) AS comments, CAST(p_partkey % 12 AS STRING) AS shares,
  CAST(p_partkey * 2 AS STRING) AS engagement,
  CASE p_partkey % 4 WHEN 0 THEN CAST(7000000000 + p_partkey % 300 AS STRING)
       WHEN 1 THEN 'A_' || LPAD(CAST(p_partkey % 300 AS STRING), 6, '0') WHEN 2 THEN 'ZZ' || CAST(p_partkey AS STRING) ELSE '' END AS post_id
FROM {part}
"""

# Country rows from every customer and the sheet's own total rows from their sums.
# Percentages are powers of two over 100, so sums do not depend on row order.
FX_TARGETS = """
SELECT 'C' || CAST(c_nationkey AS STRING) AS pais,
  CASE c_custkey % 7 WHEN 0 THEN 'Mexico' WHEN 1 THEN ' andino ' WHEN 2 THEN 'CarCam' WHEN 3 THEN 'MEXICO' WHEN 4 THEN 'Brasil'
                     WHEN 5 THEN ' ' ELSE 'Andino' END AS region,
  CASE WHEN c_custkey % 7 = 3 AND c_custkey % 3 = 0 THEN 'TOTAL' WHEN c_custkey % 11 = 5 THEN CAST(NULL AS STRING)
       WHEN c_custkey % 7 = 0 AND c_custkey % 2 = 0 THEN 'Pagado' ELSE 'Organico' END AS kpi,
  '1,' || LPAD(CAST(c_custkey % 1000 AS STRING), 3, '0') AS reach,
  CASE WHEN c_custkey % 13 = 0 THEN 'n/a' ELSE CAST(c_custkey * 3 AS STRING) END AS views_platform,
  CAST(c_custkey * 5 AS STRING) AS impressions,
  CAST(c_custkey % 100 AS STRING) AS ave_impressions,
  CASE c_custkey % 3 WHEN 0 THEN '' ELSE '2,0' || CAST(c_custkey % 90 + 10 AS STRING) END AS ave_views,
  CAST(c_custkey % 8 AS STRING) AS comments, CAST(c_custkey % 9 AS STRING) AS likes,
  CAST(c_custkey % 10 AS STRING) AS share, CAST(NULL AS STRING) AS saves,
  CASE c_custkey % 3 WHEN 0 THEN '12.5%' WHEN 1 THEN '25%' ELSE '50' END AS vtr50,
  CASE c_custkey % 2 WHEN 0 THEN '6.25%' ELSE '3.125%' END AS engagement_rate,
  '0.78125%' AS share_rate, CASE c_custkey % 4 WHEN 0 THEN '' ELSE '1.5625%' END AS save_rate
FROM {customer}
UNION ALL
SELECT '-' AS pais, 'TOTAL' AS region, CASE c_custkey % 3 WHEN 0 THEN 'Organico' WHEN 1 THEN 'Pagado' ELSE 'total' END AS kpi,
  CAST(SUM(c_custkey) AS STRING) AS reach, CAST(COUNT(*) AS STRING) AS views_platform, CAST(MAX(c_custkey) AS STRING) AS impressions,
  '1,5' AS ave_impressions, '' AS ave_views, CAST(COUNT(DISTINCT c_nationkey) AS STRING) AS comments, '8' AS likes, '9' AS share,
  CAST(NULL AS STRING) AS saves, '20%' AS vtr50, '4%' AS engagement_rate, '1.5%' AS share_rate, 'x' AS save_rate
FROM {customer}
GROUP BY CASE c_custkey % 3 WHEN 0 THEN 'Organico' WHEN 1 THEN 'Pagado' ELSE 'total' END
"""

FX_LISTENING = """
SELECT CAST(ts AS DATE) AS fecha, CAST(COUNT(*) * 100 AS STRING) AS reach, CAST(COUNT(*) AS STRING) AS total_mentions,
  CAST(COUNT(DISTINCT user_id) AS STRING) AS menciones_efectivas,
  CASE WHEN DAY(MIN(ts)) % 7 = 0 THEN 'n/d' ELSE CAST(SUM(CASE WHEN event_type='purchase' THEN 1 ELSE 0 END) AS STRING) END AS men_pos,
  CAST(SUM(CASE WHEN event_type='error' THEN 1 ELSE 0 END) AS STRING) AS men_neg,
  CAST(SUM(CASE WHEN event_type='view' THEN 1 ELSE 0 END) AS STRING) AS men_neu
FROM {events} GROUP BY CAST(ts AS DATE)
"""


def _brand_table(brands: list[str]) -> str:
    """Daily counts per brand; on one day in ten a brand's cell is a dash or empty."""
    cells = []
    for i, brand in enumerate(brands):
        gap = "'-'" if i % 2 == 0 else "CAST(NULL AS STRING)"
        cells.append(
            f"CASE WHEN DAY(MIN(ts)) % 10 = {i} THEN {gap} "
            f"ELSE CAST(SUM(CASE WHEN user_id % {len(brands)} = {i} THEN 1 ELSE 0 END) AS STRING) END AS {brand}"
        )
    return "SELECT CAST(ts AS DATE) AS fecha, " + ", ".join(cells) + " FROM {events} GROUP BY CAST(ts AS DATE)"


# Posts under the names the platform formulas use.
FX_PLATFORM_POSTS = """
SELECT event_id,
  CASE user_id % 8 WHEN 0 THEN 'facebook' WHEN 1 THEN 'instagram' WHEN 2 THEN 'x' WHEN 3 THEN 'twitter' WHEN 4 THEN 'tiktok'
                   WHEN 5 THEN 'youtube' WHEN 6 THEN 'linkedin' ELSE 'snapchat' END AS platform,
  CASE WHEN event_id % 17 < 2 THEN CAST(NULL AS BIGINT) WHEN event_id % 17 = 2 THEN 0 ELSE event_id * 10 END AS reach,
  CASE WHEN event_id % 19 = 0 THEN 0 ELSE event_id * 8 END AS post_reach,
  event_id * 15 AS post_impressions, event_id * 4 AS video_views_50pct,
  event_id + 1 AS likes, event_id + 1 AS reactions, event_id % 50 AS comments, event_id % 50 AS replies,
  event_id % 30 AS shares, event_id % 30 AS retweets, event_id % 40 AS saves,
  CASE WHEN event_id % 23 = 0 THEN CAST(NULL AS BIGINT) ELSE event_id % 40 END AS link_clicks
FROM {events}
"""

FIXTURES = {
    "fx_post_metrics": FX_POST_METRICS,
    "fx_register": FX_REGISTER,
    "fx_paid": FX_PAID,
    "fx_targets": FX_TARGETS,
    "fx_listening": FX_LISTENING,
    "fx_competitors": _brand_table(list(SETTINGS.competitor_brands)),
    "fx_sponsors": _brand_table(list(SETTINGS.sponsor_brands)),
    "fx_platform_posts": FX_PLATFORM_POSTS,
}

_TABLES = ["events", "customer", "part"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; days are UTC days."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table as a DataFrame."""
    text = FIXTURES[name]
    used = {t: table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duckdb_text(name: str) -> str:
    return FIXTURES[name].format(**{t: t for t in _TABLES}).strip()
