"""The models again, in DuckDB SQL, written apart from the Spark code.

Each entry of ``_STEPS`` is one common table expression; ``statement`` gathers
those a query needs.
"""

from __future__ import annotations

import re

from checks.fixtures import FIXTURES, SETTINGS, duckdb_text

# Fixed values, spelled out again so that a slip in the library shows.
TEXTS = (
    "country network username profile_id social_network_id post_id created_at format copy source_link thumbnail_url"
).split()
LONGS = (
    "comments engagement likes reach saves shares views video_views follows exits taps_back taps_forward "
    "profile_activity profile_visits posts_count"
).split()
DOUBLES = (
    "engagement_rate roi ig_reels_avg_watch_time ig_reels_video_view_total_time average_time_watched "
    "total_time_watched full_video_watched_rate"
).split()
GAINS = (
    "reach views video_views comments likes shares saves engagement follows profile_visits profile_activity"
).split()
PERFORMANCE = (
    "post_id profile_id username network country region market published_at published_date fact_date format "
    "campaign_tag source_link copy thumbnail_url reach views video_views comments likes shares saves engagement "
    "follows profile_visits profile_activity exits taps_back taps_forward reach_delta views_delta video_views_delta "
    "comments_delta likes_delta shares_delta saves_delta engagement_delta follows_delta profile_visits_delta "
    "profile_activity_delta days_since_prev engagement_rate roi frequency share_rate save_rate "
    "ig_reels_avg_watch_time ig_reels_video_view_total_time average_time_watched total_time_watched "
    "full_video_watched_rate vtr_50"
).split()


def num(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '\\s*[+-]?\\d+\\s*') THEN try_cast(trim({c}) AS BIGINT) END"


def dbl(c: str) -> str:
    ok = "\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*"
    return f"CASE WHEN regexp_full_match({c}, '{ok}') THEN try_cast(trim({c}) AS DOUBLE) END"


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def total(c: str) -> str:
    return f"sum({c})::BIGINT"


def strip(c: str, chars: str) -> str:
    return f"translate({c}, '{chars}', '')"


def market(country: str = "country", username: str = "username") -> str:
    return (
        f"CASE WHEN {username} IN ('Regional (A, B, ...)') THEN 'carcam' WHEN upper({country}) = 'MX' THEN 'mexico' "
        f"WHEN list_contains(['CO','EC','PE','VE','BO'], upper({country})) THEN 'andino' "
        f"WHEN list_contains(['CR','DO','GT','JM','PA','PR','SV','HN','NI','TT','HT'], upper({country})) THEN 'carcam' END"
    )


def key_ig(c: str) -> str:
    return f"nullif(regexp_extract({c}, 'instagram\\.com/(?:reel|p|tv)/([^/?]+)', 1), '')"


def key_tk(c: str) -> str:
    return f"nullif(regexp_extract({c}, '/video/(\\d+)', 1), '')"


PAUTA = "CASE WHEN pauta = 'Pagado' THEN 'paid' ELSE 'organic' END"
NETWORK = (
    "CASE WHEN network IN ('TWITTER','TWITTERV2') THEN 'X' WHEN network IN ('LINKEDIN','LINKEDINCOMPANY') THEN 'LinkedIn' "
    "ELSE coalesce(map {'INSTAGRAMBUSINESS':'Instagram','TIKTOKBUSINESS':'TikTok','YOUTUBECHANNEL':'YouTube',"
    "'FACEBOOKPAGE':'Facebook'}[network], upper(left(network, 1)) || lower(substr(network, 2))) END"
)

_STEPS: dict[str, str] = {name: duckdb_text(name) for name in FIXTURES}

_STEPS["m01"] = (
    f"SELECT {', '.join(TEXTS)}, "
    + ", ".join(f"{num(c)} AS {c}" for c in LONGS)
    + ", "
    + ", ".join(f"{dbl(c)} AS {c}" for c in DOUBLES)
    + ", region, dt AS ingest_date, _ingested_at FROM fx_post_metrics"
)
_STEPS["m02_daily"] = (
    "SELECT * FROM m01 QUALIFY row_number() OVER (PARTITION BY post_id, ingest_date ORDER BY _ingested_at DESC NULLS LAST, "
    + " + ".join(f"({c} IS NULL)::INT" for c in LONGS)
    + ", "
    + ", ".join(f"{c} NULLS LAST" for c in [*TEXTS, *LONGS, *DOUBLES, "region"] if c != "post_id")
    + ") = 1"
)
_STEPS["m02"] = (
    "SELECT post_id, profile_id, social_network_id, username, country, network, region, created_at, "
    "created_at::DATE AS published_date, ingest_date, ingest_date AS fact_date, "
    "lag(ingest_date) OVER s AS prev_ingest_date, "
    "(ingest_date - lag(ingest_date) OVER s)::BIGINT AS days_since_prev, "
    "row_number() OVER s = 1 AS is_initial_snapshot, "
    "format, copy, source_link, thumbnail_url, "
    "nullif(regexp_extract(copy, '#(TAG[A-Z0-9_]+)', 1), '') AS campaign_tag, "
    + ", ".join(LONGS)
    + ", "
    + ", ".join(f"{c} - lag({c}) OVER s AS {c}_delta" for c in GAINS)
    + ", "
    + ", ".join(DOUBLES)
    + " FROM m02_daily WINDOW s AS (PARTITION BY post_id ORDER BY ingest_date)"
)
_STEPS["m03_all"] = (
    f"SELECT m.*, {market()} AS market, created_at AS published_at, {div('views', 'reach')} AS frequency, "
    f"{div('shares', 'reach')} AS share_rate, {div('saves', 'reach')} AS save_rate, "
    "CASE WHEN network = 'TIKTOKBUSINESS' THEN full_video_watched_rate END AS vtr_50 FROM m02 m "
    "JOIN (SELECT post_id, max(ingest_date) AS ingest_date FROM m02 GROUP BY post_id) newest USING (post_id, ingest_date)"
)
_STEPS["m03"] = f"SELECT {', '.join(PERFORMANCE)} FROM m03_all"
_STEPS["m05"] = (
    f"SELECT fact_date, network, country, region, {market()} AS market, campaign_tag, "
    "count(DISTINCT post_id) AS posts, "
    + ", ".join(f"{total(f'coalesce({c}_delta, {c})')} AS {c}_gained" for c in GAINS)
    + f", {div('sum(coalesce(engagement_delta, engagement))', 'sum(coalesce(reach_delta, reach))')} AS engagement_rate, "
    "avg(days_since_prev) AS avg_window_days FROM m02 GROUP BY ALL"
)

# Register and paid sheet. Matching is the plain LIKE, kept naive on purpose.
_STEPS["reg"] = f"SELECT *, {key_ig('link_ig')} AS ig_key, {key_tk('link_tiktok')} AS tk_key FROM fx_register"
_PAID_COUNTS = "reach impressions views likes comments shares engagement".split()
_STEPS["paid"] = (
    "SELECT post_id AS sc_key, regexp_full_match(post_id, '[0-9]+') AS is_id, name, creador, format AS sc_format, url, "
    f"{dbl(strip('inversion_ejecutada', '$, '))} AS spend, "
    "try_strptime(trim(published_date) || ' 2026', '%B %d %Y')::DATE AS sc_date, "
    + ", ".join(f"{num(strip(c, ' ,'))} AS sc_{c}" for c in _PAID_COUNTS)
    + f", {div(dbl(strip('vtr_50', '% ')), '100')} AS sc_vtr FROM fx_paid "
    "WHERE starts_with(url, 'http') AND trim(coalesce(post_id, '')) <> ''"
)
_STEPS["spend"] = "SELECT sc_key, is_id, max(spend) AS spend, max(sc_reach) AS spend_reach FROM paid GROUP BY ALL"
_STEPS["owned_keys"] = (
    "SELECT DISTINCT sc_key FROM paid, m03 WHERE CASE WHEN is_id THEN post_id = sc_key "
    "ELSE source_link LIKE '%' || sc_key || '%' END"
)
_STEPS["owned"] = (
    "SELECT tipo_contenido, pauta_ig AS pauta, p.*, spend, spend_reach FROM reg JOIN m03 p "
    "ON p.source_link LIKE '%' || ig_key || '%' LEFT JOIN spend ON NOT is_id AND p.source_link LIKE '%' || sc_key || '%' "
    "UNION SELECT tipo_contenido, pauta_tiktok, p.*, spend, spend_reach FROM reg JOIN m03 p ON p.post_id = tk_key "
    "LEFT JOIN spend ON is_id AND sc_key = p.post_id"
)
_COLLAB = {
    "post_id": "sc_key", "username": "creador", "network": "if(is_id, 'TIKTOKBUSINESS', 'INSTAGRAMBUSINESS')",
    "region": "'latam'", "market": "'mexico'", "published_date": "sc_date", "format": "sc_format", "source_link": "url",
    "copy": "name", "reach": "sc_reach", "views": "sc_impressions", "video_views": "sc_views",
    "comments": "sc_comments", "likes": "sc_likes", "shares": "sc_shares", "engagement": "sc_engagement",
    "engagement_rate": div("sc_engagement", "sc_reach"), "frequency": div("sc_impressions", "sc_reach"),
    "share_rate": div("sc_shares", "sc_reach"), "vtr_50": "sc_vtr",
}
_STEPS["collab"] = (
    "SELECT 'Colaboración' AS tipo_contenido, 'Pagado' AS pauta, "
    + ", ".join(f"{expr} AS {c}" for c, expr in _COLLAB.items())
    + ", spend, sc_reach AS spend_reach FROM paid ANTI JOIN owned_keys USING (sc_key)"
)
_STEPS["m06"] = (
    f"SELECT * REPLACE ({NETWORK} AS network) FROM (SELECT * FROM owned UNION ALL BY NAME SELECT * FROM collab)"
)
_STEPS["cover"] = (
    "SELECT market, nombre AS content_name, fecha, 'instagram' AS platform, link_ig AS link, ig_key AS ig_shortcode, "
    "NULL::VARCHAR AS tiktok_id, (SELECT min(post_id) FROM m03 WHERE source_link LIKE '%' || ig_key || '%') AS matched_post_id "
    "FROM reg UNION ALL SELECT market, nombre, fecha, 'tiktok', link_tiktok, NULL, tk_key, "
    "(SELECT min(post_id) FROM m03 WHERE post_id = tk_key) FROM reg"
)
_STEPS["m07"] = (
    "SELECT *, if(matched_post_id IS NULL, 'unmatched', 'matched') AS match_status, "
    "CASE WHEN trim(coalesce(link, '')) = '' THEN 'no_link' WHEN matched_post_id IS NOT NULL THEN 'ok' "
    "WHEN platform = 'instagram' AND contains(link, 'instagram.com/s/') THEN 'ig_story' "
    "WHEN platform = 'tiktok' AND contains(link, 'tiktok.com/t/') THEN 'tiktok_shortlink' "
    "WHEN coalesce(ig_shortcode, tiktok_id) IS NOT NULL THEN 'not_yet_ingested' ELSE 'unparseable' END AS reason FROM cover"
)
_STEPS["own"] = f"SELECT * REPLACE ({PAUTA} AS pauta) FROM m06 WHERE tipo_contenido IS DISTINCT FROM 'Colaboración'"
_STEPS["m08"] = (
    "SELECT network, country, region, market, pauta, format, campaign_tag, count(*) AS posts, "
    f"{div('sum(engagement)', 'sum(reach)')} AS engagement_rate, "
    + ", ".join(f"avg({c}) AS avg_{c}" for c in ["reach", "views", "video_views", "likes"])
    + ", "
    + ", ".join(f"{total(c)} AS total_{c}" for c in ["reach", "views", "engagement"])
    + " FROM own GROUP BY ALL"
)
_DAILY = "reach views video_views comments likes shares saves engagement".split()
_STEPS["daily"] = (
    "SELECT published_date, network, region, coalesce(market, 'sin_market') AS market, pauta, "
    "count(DISTINCT post_id) AS posts, "
    + ", ".join(f"{total(c)} AS {c}" for c in _DAILY)
    + " FROM own WHERE published_date IS NOT NULL GROUP BY ALL"
)
_STEPS["spine"] = (
    "SELECT d::DATE AS published_date, c.* FROM (SELECT unnest(generate_series(min(published_date), max(published_date), "
    "INTERVAL 1 DAY)) AS d FROM daily) CROSS JOIN (SELECT DISTINCT network, region, market, pauta FROM daily) c"
)
_STEPS["m09"] = (
    "SELECT published_date, network, region, market, pauta, coalesce(posts, 0) AS posts, "
    + ", ".join(f"coalesce(d.{c}, 0) AS {c}" for c in _DAILY)
    + f", coalesce(shares, 0) + coalesce(saves, 0) AS shares_saves, {div('engagement', 'reach')} AS engagement_rate, "
    f"{div('views', 'reach')} AS frequency FROM spine LEFT JOIN daily d USING (published_date, network, region, market, pauta)"
)

# Targets.
_SHEET = {  # metric column: (sheet column, is a percentage, is averaged)
    "reach": ("reach", 0, 0), "views_platform": ("views_platform", 0, 0), "impressions": ("impressions", 0, 0),
    "ave_impressions": ("ave_impressions", 0, 1), "ave_views": ("ave_views", 0, 1), "comments": ("comments", 0, 0),
    "likes": ("likes", 0, 0), "shares": ("share", 0, 0), "saves": ("saves", 0, 0), "vtr": ("vtr50", 1, 1),
    "er": ("engagement_rate", 1, 1), "shares_rate": ("share_rate", 1, 1), "saves_rate": ("save_rate", 1, 1),
}
_META = """VALUES ('reach','reach','Reach','Accounts Reached',1,'compact'),('views_platform','views_2_3s','Reach','Views (2-3s)',2,'compact'),
('impressions','impressions','Reach','Impressions',3,'compact'),('ave_impressions','ave_impressions','Reach','Ave. Impressions',4,'compact'),
('ave_views','ave_views','Reach','Ave. Views',5,'compact'),('vtr','vtr','Recall','View Through Rate (%)',6,'percent'),
('comments','total_comments','Recall','Total Comments',7,'compact'),('er','er','Engagement','Engagement Rate (%)',9,'percent'),
('likes','total_likes','Engagement','Total Likes',11,'compact'),('shares','shares','Engagement','Shares',12,'compact'),
('shares_rate','shares_rate','Engagement','Shares Rate (%)',13,'percent'),('saves','saves','Engagement','Saves',14,'compact'),
('saves_rate','saves_rate','Engagement','Saves Rate (%)',15,'percent')"""
_BRAND = """VALUES ('sov','total','total','Engagement','SOV vs Competidores (%)',8,0.041::DOUBLE,'percent'),
('total_mentions','total','total','Engagement','Total Mentions',10,86938.0::DOUBLE,'compact'),
('positive_sentiment','total','total','Engagement','Positive Sentiment (%)',16,0.25::DOUBLE,'percent'),
('sov_sponsors','total','total','Engagement','SOV entre Sponsors (%)',17,0.034::DOUBLE,'percent')"""


def _sheet_value(column: str, percent: int) -> str:
    return div(dbl(strip(column, "%,")), "100") if percent else dbl(strip(column, ","))


_STEPS["sheet"] = (
    "SELECT map {'MEXICO':'mexico','CARCAM':'carcam','ANDINO':'andino','TOTAL':'total'}[upper(trim(region))] AS market, "
    "map {'ORGANICO':'organic','PAGADO':'paid','TOTAL':'total'}[upper(trim(kpi))] AS pauta, "
    + ", ".join(f"{_sheet_value(c, pct)} AS {m}" for m, (c, pct, _) in _SHEET.items())
    + " FROM fx_targets WHERE trim(coalesce(region, '')) <> '' AND kpi IS NOT NULL"
)
_STEPS["sheet_wide"] = (
    "SELECT market, pauta, "
    + ", ".join(f"{'avg' if avg else 'sum'}({m}) AS {m}" for m, (_, _, avg) in _SHEET.items())
    + " FROM sheet WHERE market IN ('mexico', 'carcam', 'andino') GROUP BY ALL UNION ALL SELECT * FROM sheet WHERE market = 'total'"
)
_STEPS["meta"] = f"SELECT * FROM ({_META}) t(metric_col, metric_id, section, metric_label, display_order, format_type)"
_STEPS["m10"] = (
    "SELECT metric_id, market, pauta, section, metric_label, display_order::BIGINT AS display_order, val AS target_value, "
    "format_type FROM (SELECT market, pauta, unnest([" + ", ".join(f"'{m}'" for m in _SHEET) + "]) AS metric_col, unnest(["
    + ", ".join(_SHEET) + "]) AS val FROM sheet_wide) "
    "JOIN meta USING (metric_col) UNION ALL SELECT * FROM (" + _BRAND + ")"
)

# Listening and share of voice.
_LISTEN = "reach total_mentions menciones_efectivas men_pos men_neg men_neu".split()
_STEPS["heard"] = (
    "SELECT fecha, " + ", ".join(f"{num(c)} AS {c}" for c in _LISTEN) + " FROM fx_listening WHERE fecha IS NOT NULL"
)
_STEPS["m11"] = (
    "SELECT *, coalesce(men_pos, 0) + coalesce(men_neg, 0) + coalesce(men_neu, 0) AS sentiment_total, "
    + ", ".join(f"{div(f'men_{s}', 'men_pos + men_neg + men_neu')} AS pct_{s}" for s in ["pos", "neg", "neu"])
    + " FROM heard"
)
_STEPS["m12"] = (
    "SELECT fecha, 'Positive' AS sentiment, men_pos AS mentions FROM m11 WHERE men_pos IS NOT NULL UNION ALL "
    "SELECT fecha, 'Neutral', men_neu FROM m11 WHERE men_neu IS NOT NULL UNION ALL "
    "SELECT fecha, 'Negative', men_neg FROM m11 WHERE men_neg IS NOT NULL"
)


def _voices(fixture: str, scope: str, brands) -> str:
    return " UNION ALL ".join(
        f"SELECT fecha, '{scope}' AS scope, '{b}' AS brand_key, {num(b)} AS mentions FROM {fixture} WHERE {b} IS NOT NULL"
        for b in brands
    )


_STEPS["voices"] = (
    _voices("fx_competitors", "competitor", SETTINGS.competitor_brands)
    + " UNION ALL "
    + _voices("fx_sponsors", "sponsor", SETTINGS.sponsor_brands)
)
_STEPS["m13"] = (
    "SELECT fecha, scope, brand_key, coalesce(map {'b0':'Brand Zero','b2':'Focus Brand','s1':'S & One'}[brand_key], brand_key) "
    f"AS brand_label, mentions, {div('mentions', 'sum(mentions) OVER (PARTITION BY fecha, scope)')} AS share_pct "
    "FROM voices WHERE fecha IS NOT NULL"
)

# Scorecard.
_STEPS["dated"] = "SELECT * FROM own WHERE published_date IS NOT NULL"
_STEPS["cube"] = (
    "SELECT published_date, network, if(grouping(market) = 1, 'total', market) AS market, "
    "if(grouping(pauta) = 1, 'total', pauta) AS pauta, "
    + ", ".join(f"sum({c})::DOUBLE AS {c}" for c in [*_DAILY, "vtr_50"])
    + ", count(vtr_50)::DOUBLE AS rated, count(*)::DOUBLE AS posts FROM dated "
    "GROUP BY published_date, network, CUBE (market, pauta)"
)
_CONTENT_METRICS = {
    "views_2_3s": ("video_views", "0"), "impressions": ("views", "0"), "reach": ("reach", "0"),
    "ave_impressions": ("views", "posts"), "ave_views": ("video_views", "posts"), "total_comments": ("comments", "0"),
    "vtr": ("vtr_50", "rated"), "er": ("engagement", "reach"), "shares": ("shares", "0"),
    "shares_rate": ("shares", "reach"), "saves": ("saves", "0"), "saves_rate": ("saves", "reach"),
    "total_likes": ("likes", "0"),
}
_STEPS["content_long"] = " UNION ALL ".join(
    f"SELECT published_date, network, market, pauta, '{m}' AS metric_id, {a}::DOUBLE AS num, {b}::DOUBLE AS den FROM cube"
    for m, (a, b) in _CONTENT_METRICS.items()
)
_STEPS["voice_days"] = "SELECT fecha, " + ", ".join(
    f"coalesce(sum(mentions) FILTER (WHERE scope = '{scope}'{extra}), 0)::BIGINT AS {name}_{scope}"
    for scope in ["competitor", "sponsor"]
    for name, extra in [("focus", " AND brand_key = 'b2'"), ("all", "")]
) + " FROM m13 GROUP BY fecha"
_BRAND_METRICS = [
    ("total_mentions", "total_mentions", "0", "m11"), ("positive_sentiment", "men_pos", "sentiment_total", "m11"),
    ("sov", "focus_competitor", "all_competitor", "voice_days"), ("sov_sponsors", "focus_sponsor", "all_sponsor", "voice_days"),
]
_STEPS["brand_long"] = " UNION ALL ".join(
    f"SELECT fecha AS published_date, NULL::VARCHAR AS network, 'total' AS market, 'total' AS pauta, '{m}' AS metric_id, "
    f"{a}::DOUBLE AS num, {b}::DOUBLE AS den FROM {src}"
    for m, a, b, src in _BRAND_METRICS
)
_STEPS["span"] = "SELECT max(published_date) AS hi, min(published_date) AS lo FROM dated"


def _period_value(expr: str, when: str) -> str:
    return expr.replace("{p}", f"FILTER (WHERE {when})")


_TREND = {
    "views_2_3s": "sum(video_views) {p}", "impressions": "sum(views) {p}", "reach": "sum(reach) {p}",
    "total_comments": "sum(comments) {p}", "vtr": div("sum(vtr_50) {p}", "count(vtr_50) {p}"),
    "er": div("sum(engagement) {p}", "sum(reach) {p}"), "shares_saves": "sum(shares) {p} + sum(saves) {p}",
    "total_likes": "sum(likes) {p}", "total_mentions": "NULL", "sov": "NULL",
}
_LAST = "published_date > hi - 30"
_PREV = "published_date > hi - 60 AND published_date <= hi - 30 AND hi - lo >= 60"
_STEPS["trend_wide"] = " UNION ALL ".join(
    f"SELECT '{m}' AS metric_id, network, market, ({_period_value(e, _LAST)})::DOUBLE AS now, "
    f"({_period_value(e, _PREV)})::DOUBLE AS before FROM dated, span WHERE ({_LAST}) OR ({_PREV}) GROUP BY network, market"
    for m, e in _TREND.items()
)
_STEPS["trend"] = (
    "SELECT metric_id, network, market, CASE WHEN abs((now - before) / nullif(before, 0)) <= 5 "
    "THEN (now - before) / nullif(before, 0) END AS trend_pct FROM trend_wide"
)
_STEPS["m14"] = (
    "SELECT published_date, network, market, pauta, metric_id, section, metric_label, display_order, format_type, "
    "(metric_id IN ('vtr','er','ave_impressions','ave_views','shares_rate','saves_rate','sov','sov_sponsors',"
    "'positive_sentiment'))::BIGINT AS is_ratio, num, den, target_value, trend_pct "
    "FROM (SELECT * FROM content_long UNION ALL SELECT * FROM brand_long) JOIN m10 USING (metric_id, market, pauta) "
    "LEFT JOIN trend USING (metric_id, network, market)"
)


def statement(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` preceded by the steps it reads, directly or not."""
    steps = {**_STEPS, **(extra or {})}
    order: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for name in _sources(text, steps):
            if name in seen or name in order:
                continue
            visit(steps[name], (*seen, name))
            order.append(name)

    visit(select, ())
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({steps[n]})" for n in order) + "\n" + select


def _sources(text: str, steps: dict[str, str]) -> list[str]:
    """Step names that follow FROM, JOIN, UNPIVOT or a comma in a FROM list."""
    found = re.findall(r"(?:\bFROM|\bJOIN|INCLUDE NULLS|,)\s+([a-z_][a-z_0-9]*)\b", text)
    return [n for n in dict.fromkeys(found) if n in steps]
