"""The views of a region as SQL text that any later session can run, without this library.

``store_views`` writes ``<region>/views.sql``: statements that name the tables of the newest run, the sheets
where they lie, and the ten views over them, each computed from the sheets as they are when it is read.
``spark-sql -f views.sql`` opens them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from postlens.fixed_values import (
    COLLABORATION,
    IG_KEY_PATTERN,
    IG_STORY_PATTERN,
    NETWORK_NAMES,
    NETWORK_VIEWS,
    PAID_RAW,
    TIKTOK_KEY_PATTERN,
    TIKTOK_SHORT_PATTERN,
    WHITESPACE,
)
from postlens.functions.text import _BREAK, _DECIMAL, _MARK, _MONTH_DAY, _WHOLE
from postlens.operators.matching import GRAM_SIZES
from postlens.plans.brand import SENTIMENTS
from postlens.plans.content import CONTENT_COLUMNS
from postlens.plans.rebuild import latest_tables
from postlens.settings import Settings
from postlens.sources.files import read_text, write_text
from postlens.sources.writers import LANDED, READABLE, REJECTED

SHEETS = ["register", "paid", "listening", "competitors", "sponsors"]


def lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long(c: str) -> str:
    return f"CASE WHEN {c} RLIKE {lit(_WHOLE)} THEN try_cast({c} AS BIGINT) END"


def _double(c: str) -> str:
    return f"CASE WHEN {c} RLIKE {lit(_DECIMAL)} THEN try_cast({c} AS DOUBLE) END"


def _ratio(a: str, b: str) -> str:
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def _key(c: str, pattern: str) -> str:
    return f"nullif(regexp_extract({c}, {lit(pattern)}, 1), '')"


def _trim(c: str) -> str:
    return f"btrim({c}, {lit(WHITESPACE)})"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {_trim(c)} = '')"


def _case(c: str, names: Mapping[str, str], other: str) -> str:
    return f"CASE {' '.join(f'WHEN {c} = {lit(k)} THEN {lit(v)}' for k, v in names.items())} ELSE {other} END" if names else other


# Register rows with the keys of their links, cleaned rows of the paid sheet, and every key that a post has.
def _matching(p: str, settings: Settings, with_paid: bool) -> dict[str, str]:
    sizes = " ".join(f"WHEN length(run) >= {n} THEN {n}" for n in GRAM_SIZES)
    paid_keys = "UNION SELECT kind, key FROM paid_rows" if with_paid else ""
    steps = {
        "keyed": f"SELECT *, {_key('link_ig', IG_KEY_PATTERN)} AS ig_shortcode, {_key('link_tiktok', TIKTOK_KEY_PATTERN)} AS tiktok_id FROM {p}register",
    }
    if with_paid:
        counts = ", ".join(f"{_long(f'translate({c}, {lit(" ,")}, {lit("")})')} AS {c}"
                           for c in ["reach", "impressions", "views", "likes", "comments", "shares", "engagement"])
        day = _trim("published_date")
        steps["paid_rows"] = (
            f"SELECT post_id AS key, CASE WHEN post_id RLIKE '^[0-9]+$' THEN 'id' ELSE 'link' END AS kind, name, creador, format, url, "
            f"{_double(f'translate(inversion_ejecutada, {lit("$, ")}, {lit("")})')} AS spend, "
            f"CASE WHEN {day} RLIKE {lit(_MONTH_DAY)} THEN try_to_date(concat({day}, ' {settings.paid_year}'), 'MMMM d yyyy') END AS published_date, "
            f"{counts}, {_ratio(_double(f'translate(vtr_50, {lit("% ")}, {lit("")})'), '100')} AS vtr_50 "
            f"FROM {p}paid WHERE startswith(url, 'http') AND NOT {_blank('post_id')}"
        )
    return steps | {
        "sheet_keys": ("SELECT kind, key FROM (SELECT inline(array(struct('link' AS kind, ig_shortcode AS key), struct('id' AS kind, tiktok_id AS key))) "
                       f"FROM keyed) WHERE key IS NOT NULL {paid_keys}" if with_paid else
                       "SELECT DISTINCT kind, key FROM (SELECT inline(array(struct('link' AS kind, ig_shortcode AS key), struct('id' AS kind, tiktok_id AS key))) "
                       "FROM keyed) WHERE key IS NOT NULL"),
        "runs": (f"SELECT key, reduce(split(key, {lit('[%_' + chr(92) * 2 + ']')}), '', (best, run) -> if(length(run) > length(best), run, best)) AS run, "
                 f"regexp_replace(concat('%', key, '%'), {lit(chr(40) + chr(92) * 2 + '[_%' + chr(92) * 2 + '])|' + chr(92) * 2)}, '$1') AS pattern "
                 "FROM sheet_keys WHERE kind = 'link'"),
        "grams": f"SELECT *, right(run, size) AS gram, xxhash64(right(run, size)) AS hash FROM (SELECT *, CASE {sizes} END AS size FROM runs)",
        "pieces": (f"SELECT post_id, source_link, at, n, xxhash64(substring(source_link, at, n)) AS hash FROM {p}dm_post_performance "
                   "LATERAL VIEW explode(sequence(1, greatest(length(source_link), 1))) a AS at "
                   f"LATERAL VIEW explode(array({', '.join(map(str, GRAM_SIZES))})) s AS n "
                   # only lengths that some key has
                   "WHERE source_link IS NOT NULL AND array_contains((SELECT collect_set(size) FROM grams), n) AND ((n > 0 AND at + n - 1 <= length(source_link)) OR (n = 0 AND at = 1))"),
        # Spark takes the pieces for as small as the links they are cut from and would send all of them through the driver
        "matches": ("SELECT /*+ MERGE(pieces, grams) */ 'link' AS kind, key, post_id FROM pieces JOIN grams ON pieces.hash = grams.hash AND n = size "
                    "WHERE (size = 0 OR locate(gram, source_link) = at) AND source_link LIKE pattern "
                    f"UNION ALL SELECT kind, key, post_id FROM {p}dm_post_performance JOIN sheet_keys ON post_id = key WHERE kind = 'id'"),
    }


def _with(steps: Mapping[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in steps.items()) + "\n" + select


def _match_content(p: str, settings: Settings) -> str:
    known = {
        "tipo_contenido": lit(COLLABORATION), "pauta": lit(PAID_RAW), "post_id": "key", "username": "creador",
        "network": "CASE WHEN kind = 'id' THEN 'TIKTOKBUSINESS' ELSE 'INSTAGRAMBUSINESS' END", "region": lit(settings.region),
        "market": lit(settings.collaboration_market), "source_link": "url", "copy": "name", "views": "impressions", "video_views": "views",
        "engagement_rate": _ratio("engagement", "reach"), "frequency": _ratio("impressions", "reach"), "share_rate": _ratio("shares", "reach"),
        "spend_reach": "reach",
    } | {c: c for c in ["published_date", "format", "reach", "comments", "likes", "shares", "engagement", "vtr_50", "spend"]}
    steps = _matching(p, settings, with_paid=True) | {
        "spent": ("SELECT DISTINCT kind, post_id AS paid_post, spend, spend_reach FROM "
                  "(SELECT kind, key, max(spend) AS spend, max(reach) AS spend_reach FROM paid_rows GROUP BY kind, key) JOIN matches USING (kind, key)"),
        "listed": ("SELECT DISTINCT tipo_contenido, kind, pauta, post_id FROM (SELECT DISTINCT tipo_contenido, kind, key, pauta FROM "
                   "(SELECT tipo_contenido, inline(array(struct('link' AS kind, ig_shortcode AS key, pauta_ig AS pauta), "
                   "struct('id' AS kind, tiktok_id AS key, pauta_tiktok AS pauta))) FROM keyed) WHERE key IS NOT NULL) JOIN matches USING (kind, key)"),
        "cells": ("SELECT DISTINCT tipo_contenido, pauta, post_id AS cell_post, spend, spend_reach FROM listed "
                  "LEFT JOIN spent ON listed.kind = spent.kind AND listed.post_id <=> spent.paid_post"),
        "other": f"SELECT {', '.join(f'{known[c]} AS {c}' for c in CONTENT_COLUMNS if c in known)} FROM paid_rows LEFT ANTI JOIN matches USING (kind, key)",
        "content": (f"SELECT {', '.join(CONTENT_COLUMNS)} FROM cells JOIN {p}dm_post_performance ON cell_post <=> post_id UNION ALL "
                    f"SELECT {', '.join(c if c in known else f'NULL AS {c}' for c in CONTENT_COLUMNS)} FROM other"),
    }
    words = f"replace(initcap(regexp_replace(lower(network), {lit(_BREAK)}, {lit('$1' + _MARK)})), {lit(_MARK)}, '')"
    columns = [f"{_case('network', NETWORK_NAMES, words)} AS network" if c == "network" else c for c in CONTENT_COLUMNS]
    return _with(steps, f"SELECT {', '.join(columns)} FROM content")


def _match_coverage(p: str, settings: Settings) -> str:
    steps = _matching(p, settings, with_paid=False) | {
        "found": "SELECT kind, key, CASE WHEN count(post_id) = count(*) THEN min(post_id) END AS matched_post_id FROM matches GROUP BY kind, key",
        "cells": ("SELECT market, nombre AS content_name, fecha, inline(array("
                  "struct('instagram' AS platform, 'link' AS kind, link_ig AS link, ig_shortcode, CAST(NULL AS STRING) AS tiktok_id), "
                  "struct('tiktok' AS platform, 'id' AS kind, link_tiktok AS link, CAST(NULL AS STRING) AS ig_shortcode, tiktok_id))) FROM keyed"),
        "joined": ("SELECT cells.*, matched_post_id FROM cells LEFT JOIN found "
                   "ON cells.kind = found.kind AND coalesce(ig_shortcode, tiktok_id) = found.key"),
    }
    return _with(steps, (
        "SELECT market, content_name, fecha, platform, link, ig_shortcode, tiktok_id, matched_post_id, "
        "CASE WHEN matched_post_id IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS match_status, "
        f"CASE WHEN {_blank('link')} THEN 'no_link' WHEN matched_post_id IS NOT NULL THEN 'ok' "
        f"WHEN platform = 'instagram' AND link RLIKE {lit(IG_STORY_PATTERN)} THEN 'ig_story' "
        f"WHEN platform = 'tiktok' AND link RLIKE {lit(TIKTOK_SHORT_PATTERN)} THEN 'tiktok_shortlink' "
        "WHEN coalesce(ig_shortcode, tiktok_id) IS NOT NULL THEN 'not_yet_ingested' ELSE 'unparseable' END AS reason FROM joined"
    ))


def _listening(p: str) -> str:
    counts = ["reach", "total_mentions", "menciones_efectivas", "men_pos", "men_neg", "men_neu"]
    typed = ", ".join(f"{_long(f'CAST({c} AS STRING)')} AS {c}" for c in counts)
    total = " + ".join(f"coalesce(men_{s}, 0)" for s in ("pos", "neg", "neu"))
    shares = ", ".join(f"{_ratio(f'men_{s}', 'men_pos + men_neg + men_neu')} AS pct_{s}" for s in ("pos", "neg", "neu"))
    return f"SELECT *, {total} AS sentiment_total, {shares} FROM (SELECT CAST(fecha AS DATE) AS fecha, {typed} FROM {p}listening WHERE fecha IS NOT NULL)"


def _sov(p: str, settings: Settings) -> str:
    def long(table: str, scope: str, brands: list[str]) -> str:
        cells = ", ".join(f"struct({lit(b)} AS brand_key, CAST(`{b}` AS STRING) AS cell)" for b in brands)
        return (f"SELECT CAST(fecha AS DATE) AS fecha, '{scope}' AS scope, brand_key, {_long('cell')} AS mentions FROM "
                f"(SELECT fecha, inline(array({cells})) FROM {p}{table} WHERE fecha IS NOT NULL) WHERE cell IS NOT NULL")

    parts = [long(t, s, list(b)) for t, s, b in (("competitors", "competitor", settings.competitor_brands), ("sponsors", "sponsor", settings.sponsor_brands)) if b]
    steps = {"voices": " UNION ALL ".join(parts), "totals": "SELECT fecha, scope, sum(mentions) AS total FROM voices GROUP BY fecha, scope"}
    return _with(steps, f"SELECT fecha, scope, brand_key, {_case('brand_key', settings.brand_labels, 'brand_key')} AS brand_label, mentions, "
                        f"{_ratio('mentions', 'total')} AS share_pct FROM voices LEFT JOIN totals USING (fecha, scope)")


def view_statements(settings: Settings, prefix: str = "") -> dict[str, str]:
    """The SELECT of each view, over relations named as the tables and sheets with ``prefix``."""
    sentiments = ", ".join(f"struct({lit(name)} AS sentiment, {c} AS mentions)" for c, name in SENTIMENTS.items())
    return {f"dw_{name}": f"SELECT * FROM {prefix}dm_post_performance WHERE network = {lit(code)}" for code, name in NETWORK_VIEWS.items()} | {
        "dm_match_content": _match_content(prefix, settings),
        "dm_match_coverage": _match_coverage(prefix, settings),
        "dm_listening": _listening(prefix),
        "dm_sentiment": f"SELECT fecha, sentiment, mentions FROM (SELECT fecha, inline(array({sentiments})) FROM {prefix}dm_listening) WHERE mentions IS NOT NULL",
        "dm_sov": _sov(prefix, settings),
    }


def store_views(spark: SparkSession, base: str, out: str, settings: Settings, fmt: str = "parquet", prefix: str = "", **options: str) -> str:
    """Write the statements for the newest run of a region and the sheets under ``base``; returns where they are.

    Call it after each rebuild: the file then names the tables of that run. Sheets are bound by the names of their columns.
    """
    region = f"{out}/{settings.region}"
    tables = latest_tables(spark, region, hold_hours=1)
    run = tables.run
    listed = []
    for name, df in tables.items():
        if name in (READABLE, REJECTED):
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        # the partition column comes last in the files' relation
        listed.append(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}files_of_{name} ({columns}) USING parquet OPTIONS (path {lit(f'{region}/{run}/{name}')})")
        listed.append(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{name} AS SELECT {', '.join(f'`{c}`' for c in df.columns)} FROM {prefix}files_of_{name}")
    raw = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tables[READABLE].schema)
    landed = f"{prefix}{LANDED}_lines"
    listed.append(f"CREATE OR REPLACE TEMPORARY VIEW {landed} ({raw}, line string, part string) USING parquet OPTIONS (path {lit(f'{region}/{run}/{LANDED}')})")
    listed.append(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{READABLE} AS SELECT {', '.join(tables[READABLE].columns)} FROM {landed} WHERE part = {lit(READABLE)}")
    listed.append(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{REJECTED} AS SELECT region, ingest_date AS dt, line FROM {landed} WHERE part = {lit(REJECTED)}")
    given = {"header": "true"} | options if fmt == "csv" else options
    for name in SHEETS:
        settings_of = ", ".join(f"{lit(k)} {lit(v)}" for k, v in {"path": f"{base}/{name}", **given}.items())
        listed.append(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{name} USING {fmt} OPTIONS ({settings_of})")
    listed += [f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{name} AS\n{text}" for name, text in view_statements(settings, prefix).items()]
    tables.hold.release()
    path = f"{region}/views.sql"
    write_text(spark, path, "".join(f"{s};\n\n" for s in listed))
    return path


def open_views(spark: SparkSession, path: str) -> None:
    """Run the stored statements, as ``spark-sql -f`` does."""
    for statement in read_text(spark, path).split(";\n\n"):
        if statement.strip():
            spark.sql(statement)
