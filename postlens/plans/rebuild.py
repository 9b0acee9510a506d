"""Full rebuild of every model of a region.

No table is kept up incrementally: each run writes all of them anew, so a record that
arrives late or twice needs no special case. A run has its own folder, and only a run
that has ended is entered in the region's list of runs, so until then, and if it fails,
readers see the run before. Old runs go unless a reader holds them; what a run stages goes
when it ends. Regions do not share keys; each is rebuilt from its own sources into its own
folder, and several at the same time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.plans import brand, content, posts, scorecard
from postlens.settings import Settings
from postlens.sources import (
    BROKEN,
    LANDED,
    OWN_LAYOUTS,
    READABLE,
    REJECTED,
    TABLE_LAYOUTS,
    Hold,
    create_view,
    finish_run,
    hold_latest,
    input_bytes,
    read_landed_part,
    read_table,
    retire_runs,
    schemas_of,
    size_shuffles,
    staging,
    with_load_time,
    write_landed,
    write_table,
)
from postlens.sources.runs import HOLD_HOURS, KEPT_RUNS

# The source tables a region needs.
SOURCES = ["post_metrics", "register", "paid", "targets", "listening", "competitors", "sponsors"]


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def region_views(performance: DataFrame, sources: Mapping[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    """The models that are views.

    They hold no staged rows: each read computes them from the sheets as they are
    then. Only whether the key table is broadcast is settled here, by its size.
    """
    register, paid = sources["register"], sources["paid"]
    daily = brand.listening(sources["listening"])
    return posts.network_slices(performance) | {
        "dm_match_content": content.match_content(register, paid, performance, settings, keep=_as_is),
        "dm_match_coverage": content.match_coverage(register, performance, settings, keep=_as_is),
        "dm_listening": daily,
        "dm_sentiment": brand.sentiment(daily),
        "dm_sov": brand.share_of_voice(sources["competitors"], sources["sponsors"], settings),
    }


class OpenTables(dict[str, DataFrame]):
    """Tables of a run by name. They stay readable until ``hold`` is released or its time is over."""

    run: str
    hold: Hold


def rebuild(sources: Mapping[str, DataFrame], out: str, settings: Settings, keep_runs: int = KEPT_RUNS) -> dict[str, DataFrame]:
    """Write the tables of a new run under ``out/<region>`` and return tables and views by name.

    Each model reads the written tables of the models before it. The landed lines are
    scanned once. The matched content is a view, but marts read it, so it is staged until the
    run ends. Shuffles are sized by the landed metrics for the run. Afterwards all runs but the
    newest ``keep_runs`` and those that readers hold are removed.
    """
    spark = sources["register"].sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(sources["post_metrics"])
    try:
        return _rebuild(spark, sources, out, settings, keep_runs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _rebuild(spark: SparkSession, sources: Mapping[str, DataFrame], out: str, settings: Settings, keep_runs: int) -> dict[str, DataFrame]:
    run, region = uuid.uuid4().hex, f"{out}/{settings.region}"
    folder = f"{region}/{run}"
    built: dict[str, DataFrame] = {}

    def table(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{folder}/{name}", *(TABLE_LAYOUTS | OWN_LAYOUTS)[name])
        built[name] = read_table(spark, f"{folder}/{name}", df.schema)
        return built[name]

    lines = sources["post_metrics"]
    if BROKEN not in lines.columns:
        lines = lines.withColumn(BROKEN, F.lit(None).cast("string"))
    landed = posts.post_metrics_raw(lines, BROKEN)
    write_landed(landed, BROKEN, f"{folder}/{LANDED}", TABLE_LAYOUTS[READABLE][1])
    for part in (READABLE, REJECTED):
        built[part] = read_landed_part(spark, f"{folder}/{LANDED}", landed.drop(BROKEN).schema, part)
    raw = built[READABLE]

    with staging(spark, f"rebuild-{run}") as keep:
        metrics = table("post_metrics", with_load_time(posts.post_series(raw, settings)))
        performance = table("dm_post_performance", posts.post_performance(metrics, settings))
        table("dm_platform_summary", posts.platform_summary(metrics, settings))

        built |= region_views(performance, sources, settings)
        matches = content.key_matches(performance, sources["register"], sources["paid"], settings, keep)
        matched = keep(
            content.match_content(sources["register"], sources["paid"], performance, settings, matches, keep), "dm_match_content"
        )
        table("dm_format_performance", content.format_performance(matched))
        table("dm_content_timeseries", content.content_timeseries(matched, keep))
        table("dm_content_posts", content.content_posts(matched, keep))
        targets = table("kpi_targets", scorecard.kpi_targets(sources["targets"], settings.brand_targets))
        table("dm_executive_scorecard", scorecard.executive_scorecard(
            matched, targets, built["dm_listening"], built["dm_sov"], settings, keep
        ))
    finish_run(spark, region, run, {n: built[n].schema.json() for n in TABLE_LAYOUTS | OWN_LAYOUTS})
    retire_runs(spark, region, keep_runs)
    return built


def latest_tables(spark: SparkSession, region: str, hold_hours: float = HOLD_HOURS) -> OpenTables:
    """The tables of the last run that has ended, with the schemas they were written with, held for so many hours."""
    run, hold = hold_latest(spark, region, hold_hours)
    schemas = {name: T.StructType.fromJson(json.loads(s)) for name, s in schemas_of(spark, region, run).items()}
    tables = OpenTables({part: read_landed_part(spark, f"{region}/{run}/{LANDED}", schemas[READABLE], part) for part in (READABLE, REJECTED)})
    tables |= {name: read_table(spark, f"{region}/{run}/{name}", schema) for name, schema in schemas.items() if name != READABLE}
    tables.run, tables.hold = run, hold
    return tables


def open_region(sources: Mapping[str, DataFrame], out: str, settings: Settings, hold_hours: float = HOLD_HOURS) -> OpenTables:
    """Tables of the last rebuild, with the views computed from the sources as they are now.

    Later rebuilds leave the run alone until ``hold.release()`` is called or the hours are over.
    """
    spark = sources["register"].sparkSession
    tables = latest_tables(spark, f"{out}/{settings.region}", hold_hours)
    tables |= region_views(tables["dm_post_performance"], sources, settings)
    return tables


def rebuild_regions(
    sources: Mapping[str, Mapping[str, DataFrame]], out: str, settings: Mapping[str, Settings], keep_runs: int = KEPT_RUNS
) -> dict[str, dict[str, DataFrame]]:
    """Rebuild every region that has settings, all at the same time.

    Each region has a thread and a pool of the scheduler, so small regions don't wait
    for a large one. Shuffles are sized for the largest of them. A region that fails leaves the
    others alone: they end, and what failed is raised together afterwards.
    """
    if not settings:
        return {}
    spark = next(iter(sources.values()))["register"].sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(max((sources[region]["post_metrics"] for region in settings), key=input_bytes))

    def build(region: str) -> dict[str, DataFrame]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", region)
        return _rebuild(spark, sources[region], out, settings[region], keep_runs)

    try:
        with ThreadPoolExecutor(len(settings)) as pool:
            running = {region: pool.submit(inheritable_thread_target(spark)(build), region) for region in settings}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    if failed := [e for f in running.values() if (e := f.exception())]:
        raise ExceptionGroup("regions that failed", failed)
    return {region: f.result() for region, f in running.items()}


def publish_views(built: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Register everything that was built as a temporary view of the session."""
    for name, df in built.items():
        create_view(df, f"{prefix}{name}")
    return [f"{prefix}{name}" for name in built]
