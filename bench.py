"""Times the models and prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. The sources are
written first, untimed: landed metrics as JSON lines by day, sheets as Parquet. The
metric is one ``rebuild`` of a region from there, tables written and run entered.
Beside it stand the times of single models, each built from the tables before it and
written, and ``scorecard_end_to_end``, the scorecard query from the provided tables with
everything it needs computed on the way. A first, untimed round warms the session up.
BENCH_COPIES repeats the landed records under other post ids, to see how times grow.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.catalog import QUERIES, source
from checks.fixtures import SETTINGS
from postlens.plans import brand, content, posts, scorecard
from postlens.plans.rebuild import rebuild
from postlens.sources import build_session, checkpoint_folder, read_sources, stage

SOURCES = ["fx_post_metrics", "fx_register", "fx_paid", "fx_targets", "fx_listening", "fx_competitors", "fx_sponsors"]


def model_times(src: dict[str, DataFrame]) -> dict[str, float]:
    times: dict[str, float] = {}

    def build(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        start = time.perf_counter()
        out = stage(make(), name)
        times[name] = round(time.perf_counter() - start, 3)
        return out

    s = SETTINGS
    register, paid = src["fx_register"], src["fx_paid"]
    raw = build("m01_post_metrics_raw", lambda: posts.post_metrics_raw(src["fx_post_metrics"]))
    metrics = build("m02_post_metrics", lambda: posts.post_series(raw, s))
    own = build("m03_post_performance", lambda: posts.post_performance(metrics, s))
    build("m04_dw_instagram", lambda: posts.network_slices(own)["dw_instagram"])
    build("m05_platform_summary", lambda: posts.platform_summary(metrics, s))
    matches = build("key_matches", lambda: content.key_matches(own, register, paid, s))
    matched = build("m06_match_content", lambda: content.match_content(register, paid, own, s, matches))
    build("m07_match_coverage", lambda: content.match_coverage(register, own, s, matches))
    build("m08_format_performance", lambda: content.format_performance(matched))
    build("m09_content_timeseries", lambda: content.content_timeseries(matched))
    targets = build("m10_kpi_targets", lambda: scorecard.kpi_targets(src["fx_targets"]))
    daily = build("m11_listening", lambda: brand.listening(src["fx_listening"]))
    build("m12_sentiment", lambda: brand.sentiment(daily))
    voice = build("m13_share_of_voice", lambda: brand.share_of_voice(src["fx_competitors"], src["fx_sponsors"], s))
    card = build("m14_executive_scorecard", lambda: scorecard.executive_scorecard(matched, targets, daily, voice, s))
    build("m15_scorecard_rollup", lambda: scorecard.scorecard_rollup(card))
    return times


def landed_sources(src: dict[str, DataFrame], copies: int) -> dict[str, DataFrame]:
    """The sources as a region has them: written to one folder and read from there."""
    spark = src["fx_register"].sparkSession
    base = os.path.join(checkpoint_folder(spark), f"landed-{uuid.uuid4().hex}")
    for name, df in src.items():
        if name == "fx_post_metrics":
            df = df.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.lit(copies))))
            own_id = F.when(F.col("copy_no") == 1, F.col("post_id")).otherwise(F.concat_ws("-", "post_id", "copy_no"))
            df = df.withColumn("post_id", own_id).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp")).drop("copy_no")
            df.repartition("dt").write.partitionBy("region", "dt").json(f"{base}/post_metrics")
        else:
            df.write.parquet(f"{base}/{name.removeprefix('fx_')}")
    return read_sources(spark, base, SETTINGS)


def rebuild_time(sources: dict[str, DataFrame]) -> float:
    spark = sources["register"].sparkSession
    start = time.perf_counter()
    rebuild(sources, os.path.join(checkpoint_folder(spark), f"rebuilt-{uuid.uuid4().hex}"), SETTINGS)
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    src = {name: source(spark, sf_dir, name) for name in SOURCES}
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    sources = landed_sources(src, copies)
    rebuild_time(sources)
    total = rebuild_time(sources)
    times = {"rebuild": total} | (model_times(src) if copies == 1 else {})

    if copies > 1:
        print(json.dumps({"metric": "full_rebuild_time", "value": total, "unit": "sec", "queries": times, "copies": copies}))
        return
    start = time.perf_counter()
    QUERIES["m14_executive_scorecard"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times["scorecard_end_to_end"] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "full_rebuild_time", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
