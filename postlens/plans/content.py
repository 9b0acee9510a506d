"""Register-to-post matching and the marts built on the matched content."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.fixed_values import (
    COLLABORATION,
    IG_KEY_PATTERN,
    IG_STORY_PATTERN,
    PAID_RAW,
    TIKTOK_KEY_PATTERN,
    TIKTOK_SHORT_PATTERN,
)
from postlens.functions import (
    clean_number,
    extract,
    is_blank,
    is_collaboration,
    network_name,
    parse_month_day,
    pauta_of,
    safe_divide,
    safe_double,
    safe_long,
)
from postlens.operators import distinct_bitmaps, distinct_counts, fill_days, link_pairs, numbered, zero_fill
from postlens.plans.posts import PERFORMANCE_COLUMNS
from postlens.settings import Settings
from postlens.sources.session import stage

Keep = Callable[[DataFrame, str], DataFrame]

# A key is looked for inside links ('link') or compared with post ids ('id').
BY_LINK, BY_ID = "link", "id"

CONTENT_COLUMNS = ["tipo_contenido", "pauta", *PERFORMANCE_COLUMNS, "spend", "spend_reach"]

COUNTED = ["reach", "views", "video_views", "comments", "likes", "shares", "saves", "engagement"]


def register_keys(register: DataFrame) -> DataFrame:
    """The register with the post keys its links carry."""
    return register.withColumns({
        "ig_shortcode": extract("link_ig", IG_KEY_PATTERN),
        "tiktok_id": extract("link_tiktok", TIKTOK_KEY_PATTERN),
    })


def paid_rows(paid: DataFrame, settings: Settings) -> DataFrame:
    """Cleaned rows of the paid sheet that carry a link and a key.

    An all-digit key is a post id, any other key is looked for inside links.
    """
    def count(c: str) -> Column:
        return safe_long(clean_number(c, " ,"))

    return paid.where(F.col("url").startswith("http") & ~is_blank("post_id")).select(
        F.col("post_id").alias("key"),
        F.when(F.col("post_id").rlike("^[0-9]+$"), BY_ID).otherwise(BY_LINK).alias("kind"),
        "name", "creador", "format", "url",
        safe_double(clean_number("inversion_ejecutada", "$, ")).alias("spend"),
        parse_month_day("published_date", settings.paid_year).alias("published_date"),
        *[count(c).alias(c) for c in ["reach", "impressions", "views", "likes", "comments", "shares", "engagement"]],
        safe_divide(safe_double(clean_number("vtr_50", "% ")), F.lit(100)).alias("vtr_50"),
    )


def sheet_keys(register: DataFrame, paid: DataFrame | None, settings: Settings) -> DataFrame:
    """Distinct (kind, key) of both sheets."""
    keyed = register_keys(register)
    keys = keyed.select(F.inline(F.array(
        F.struct(F.lit(BY_LINK).alias("kind"), F.col("ig_shortcode").alias("key")),
        F.struct(F.lit(BY_ID).alias("kind"), F.col("tiktok_id").alias("key")),
    ))).where(F.col("key").isNotNull())
    if paid is not None:
        keys = keys.unionByName(paid_rows(paid, settings).select("kind", "key"))
    return keys.distinct()


def key_matches(
    posts: DataFrame, register: DataFrame, paid: DataFrame | None, settings: Settings, keep: Keep = stage
) -> DataFrame:
    """Every (kind, key, post_id) that belongs together, kept as a small table.

    Only two narrow columns of the posts are read, and no wide row is shuffled.
    """
    keys = keep(sheet_keys(register, paid, settings), "sheet_keys")
    by_link = link_pairs(posts, keys.where(F.col("kind") == BY_LINK)).withColumn("kind", F.lit(BY_LINK))
    by_id = posts.select("post_id", F.col("post_id").alias("key")).join(keys.where(F.col("kind") == BY_ID), "key")
    columns = ["kind", "key", "post_id"]
    return keep(by_link.select(*columns).unionByName(by_id.select(*columns)), "key_matches")


def _listed(register: DataFrame) -> DataFrame:
    """Distinct (kind, key, type, pauta) of the register, one row per usable link."""
    def cell(kind: str, key: str, pauta: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.col(pauta).alias("pauta"))

    return (
        register_keys(register)
        .select("tipo_contenido", F.inline(F.array(
            cell(BY_LINK, "ig_shortcode", "pauta_ig"), cell(BY_ID, "tiktok_id", "pauta_tiktok"),
        )))
        .where(F.col("key").isNotNull())
        .distinct()
    )


def owned_cells(register: DataFrame, paid: DataFrame, matches: DataFrame, settings: Settings) -> DataFrame:
    """Distinct (type, pauta, post_id, spend, spend_reach) of registered posts.

    A post is one row of the performance mart, so rows that differ in any of its
    columns already differ here, and duplicates go before the wide join. A post
    with several spends keeps them all.
    """
    spent = (
        paid_rows(paid, settings)
        .groupBy("kind", "key")
        .agg(F.max("spend").alias("spend"), F.max("reach").alias("spend_reach"))
        .join(matches, ["kind", "key"])
        .select("kind", F.col("post_id").alias("paid_post"), "spend", "spend_reach")
        .distinct()
    )
    listed = _listed(register).join(matches, ["kind", "key"]).drop("key").distinct()
    same_post = (listed["kind"] == spent["kind"]) & listed["post_id"].eqNullSafe(spent["paid_post"])
    return (
        listed.join(spent, same_post, "left")
        .select("tipo_contenido", "pauta", "post_id", "spend", "spend_reach")
        .distinct()
    )


def collaborations(paid: DataFrame, matches: DataFrame, settings: Settings) -> DataFrame:
    """Paid rows that match no own post, in the columns of the matched content."""
    rows = paid_rows(paid, settings)
    unmatched = rows.join(matches.select("kind", "key").distinct(), ["kind", "key"], "left_anti")
    known = {
        "tipo_contenido": F.lit(COLLABORATION),
        "pauta": F.lit(PAID_RAW),
        "post_id": F.col("key"),
        "username": F.col("creador"),
        "network": F.when(F.col("kind") == BY_ID, "TIKTOKBUSINESS").otherwise("INSTAGRAMBUSINESS"),
        "region": F.lit(settings.region),
        "market": F.lit(settings.collaboration_market),
        "source_link": F.col("url"),
        "copy": F.col("name"),
        "views": F.col("impressions"),
        "video_views": F.col("views"),
        "engagement_rate": safe_divide("engagement", "reach"),
        "frequency": safe_divide("impressions", "reach"),
        "share_rate": safe_divide("shares", "reach"),
        "spend_reach": F.col("reach"),
    }
    as_is = ["published_date", "format", "reach", "comments", "likes", "shares", "engagement", "vtr_50", "spend"]
    known |= {c: F.col(c) for c in as_is}
    return unmatched.select(*[known[c].alias(c) for c in CONTENT_COLUMNS if c in known])


def match_content(
    register: DataFrame,
    paid: DataFrame,
    posts: DataFrame,
    settings: Settings,
    matches: DataFrame | None = None,
    keep: Keep = stage,
) -> DataFrame:
    """Registered posts with their spend, plus the paid rows of other accounts.

    The small sides are staged, so that Spark knows their size when it plans the
    one join that touches the wide rows. ``posts`` has one row per post_id.
    """
    if matches is None:
        matches = key_matches(posts, register, paid, settings, keep)
    cells = keep(owned_cells(register, paid, matches, settings), "owned_cells")
    owned = cells.withColumnRenamed("post_id", "cell_post").join(
        posts, F.col("cell_post").eqNullSafe(F.col("post_id"))
    ).select(*CONTENT_COLUMNS)
    other = collaborations(paid, matches, settings)
    return (
        owned.unionByName(other, allowMissingColumns=True)
        .withColumn("network", network_name("network"))
        .select(*CONTENT_COLUMNS)
    )


def match_coverage(
    register: DataFrame,
    posts: DataFrame,
    settings: Settings,
    matches: DataFrame | None = None,
    keep: Keep = stage,
) -> DataFrame:
    """One row per register row and platform: matched or not, and why.

    Which post a row gets depends on its key alone, so the first post is chosen
    per key and the register rows, repeats included, only look it up. A matching
    post without an id sorts first and leaves the row unmatched.
    """
    if matches is None:
        matches = key_matches(posts, register, None, settings, keep)
    first_post = F.when(F.count("post_id") == F.count("*"), F.min("post_id"))
    found = matches.groupBy("kind", "key").agg(first_post.alias("matched_post_id"))
    nothing = F.lit(None).cast("string")

    def cell(platform: str, kind: str, link: str, shortcode: Column, tiktok: Column) -> Column:
        return F.struct(
            F.lit(platform).alias("platform"), F.lit(kind).alias("kind"), F.col(link).alias("link"),
            shortcode.alias("ig_shortcode"), tiktok.alias("tiktok_id"),
        )

    rows = register_keys(register).select(
        "market", F.col("nombre").alias("content_name"), "fecha",
        F.inline(F.array(
            cell("instagram", BY_LINK, "link_ig", F.col("ig_shortcode"), nothing),
            cell("tiktok", BY_ID, "link_tiktok", nothing, F.col("tiktok_id")),
        )),
    )
    rows = rows.withColumn("key", F.coalesce("ig_shortcode", "tiktok_id"))
    # Rows without a key match nothing; kept out of the join they cannot pile up in one task.
    keyed = rows.where(F.col("key").isNotNull()).join(found, ["kind", "key"], "left")
    keyless = rows.where(F.col("key").isNull()).withColumn("matched_post_id", nothing)
    platform, link = F.col("platform"), F.col("link")
    matched = F.col("matched_post_id").isNotNull()
    reason = (
        F.when(is_blank(link), "no_link")
        .when(matched, "ok")
        .when((platform == "instagram") & link.rlike(IG_STORY_PATTERN), "ig_story")
        .when((platform == "tiktok") & link.rlike(TIKTOK_SHORT_PATTERN), "tiktok_shortlink")
        .when(F.col("key").isNotNull(), "not_yet_ingested")
        .otherwise("unparseable")
    )
    return keyed.unionByName(keyless).select(
        "market", "content_name", "fecha", "platform", "link", "ig_shortcode", "tiktok_id", "matched_post_id",
        F.when(matched, "matched").otherwise("unmatched").alias("match_status"),
        reason.alias("reason"),
    )


def own_content(content: DataFrame) -> DataFrame:
    """Content that counts towards KPIs, with pauta as organic or paid."""
    return content.where(~is_collaboration("tipo_contenido")).withColumn("pauta", pauta_of("pauta"))


def format_performance(content: DataFrame) -> DataFrame:
    """What a post of each format looks like: weighted rate, averages and totals."""
    keys = ["network", "country", "region", "market", "pauta", "format", "campaign_tag"]
    averages = [F.avg(c).alias(f"avg_{c}") for c in ["reach", "views", "video_views", "likes"]]
    totals = [F.sum(c).alias(f"total_{c}") for c in ["reach", "views", "engagement"]]
    return (
        own_content(content)
        .groupBy(*keys)
        .agg(F.count("*").alias("posts"), *averages, *totals)
        .select(
            *keys, "posts",
            safe_divide("total_engagement", "total_reach").alias("engagement_rate"),
            "avg_reach", "avg_views", "avg_video_views", "avg_likes",
            "total_reach", "total_views", "total_engagement",
        )
    )


def content_timeseries(content: DataFrame, keep: Keep = stage) -> DataFrame:
    """Gap-free daily series by publishing day for each existing combination.

    The daily totals are staged: bounds and values come from them, so the content is
    read once, and the missing days are made beside them without a join.

    Days without posts have zero counts and NULL rates. A combination with a NULL
    network or region is zero on every day.
    """
    day, dims = "published_date", ["network", "region", "market", "pauta"]
    own = (
        own_content(content.where(F.col(day).isNotNull()))
        .withColumn("market", F.coalesce("market", F.lit("sin_market")))
    )
    totals = own.groupBy(day, *dims).agg(
        F.count_distinct("post_id").alias("posts"), *[F.sum(c).alias(c) for c in COUNTED]
    )
    totals = keep(totals, "daily_totals")
    known = F.col("network").isNotNull() & F.col("region").isNotNull()
    values = totals.select(day, *dims, *[F.when(known, F.col(c)).alias(c) for c in ["posts", *COUNTED]])
    return fill_days(values, dims, day).select(
        day, *dims,
        *zero_fill(["posts", *COUNTED]),
        (F.coalesce("shares", F.lit(0)) + F.coalesce("saves", F.lit(0))).alias("shares_saves"),
        safe_divide("engagement", "reach").alias("engagement_rate"),
        safe_divide("views", "reach").alias("frequency"),
    )


# What a day's posts are told apart by in the bitmaps that a range adds up.
POST_KEYS = ["published_date", "network", "region", "market", "pauta"]


def content_posts(content: DataFrame, keep: Keep = stage) -> DataFrame:
    """(day, network, region, market, pauta, bucket, bits): the posts behind the daily series, as bitmaps that add up.

    Posts are numbered by their publishing day, so a day's bitmaps are few.
    """
    own = (
        own_content(content.where(F.col("published_date").isNotNull()))
        .withColumn("market", F.coalesce("market", F.lit("sin_market")))
        .select(*POST_KEYS, "post_id")
    )
    own = keep(own, "own_posts")
    return distinct_bitmaps(own, POST_KEYS, "post_id", numbered(own, "post_id", "published_date", keep))


def posts_in_range(posts: DataFrame, by: Sequence[str], first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Different posts that were published in a range, by any of the keys; only the stored bitmaps are read."""
    if first is not None:
        posts = posts.where(F.col("published_date") >= F.lit(first))
    if last is not None:
        posts = posts.where(F.col("published_date") <= F.lit(last))
    return distinct_counts(posts, by, "posts")
