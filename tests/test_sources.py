"""Readers, writers, staging and the region rebuild."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import shutil
import uuid
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.catalog import full_scorecard, raw
from checks.fixtures import FIXTURES, SETTINGS, fixture
from conftest import plan_text
from postlens.plans import posts
from postlens.plans.rebuild import open_region, publish_views, rebuild, rebuild_regions
from postlens.sources import (
    OWN_LAYOUTS,
    TABLE_LAYOUTS,
    checkpoint_folder,
    finish_run,
    finished_runs,
    hold_latest,
    hold_run,
    input_bytes,
    read_landed_lines,
    read_landed_metrics,
    read_rejected_lines,
    read_sources,
    read_table,
    read_text_snapshot,
    retire_runs,
    shuffle_partitions,
    size_shuffles,
    stage,
    write_table,
)

SF = "/root/testdata/sf0.001"
D = dt.date


def _land(base, region, day, records):
    folder = base / f"region={region}" / f"dt={day}"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records))


def test_landed_records(spark, tmp_path):
    record = {"post_id": "p", "likes": "5", "views": 7, "region": "inside", "created_at": "2024-01-01T10:00:00Z",
              "_ingested_at": "2024-01-02T00:00:00.123456Z", "unknown": 1}
    _land(tmp_path, "latam", "2024-01-02", [record, {"post_id": "q"}])
    _land(tmp_path, "latam", "2024-01-03", [record])
    _land(tmp_path, "emea", "2024-01-03", [record])
    df = read_landed_metrics(spark, str(tmp_path))
    assert df.count() == 4
    first = df.where("region = 'latam' and dt = DATE '2024-01-02' and post_id = 'p'").first()
    assert (first["likes"], first["views"], first["region"], first["dt"]) == ("5", "7", "latam", D(2024, 1, 2))
    assert first["_ingested_at"].microsecond == 123456
    assert {r["region"] for r in read_landed_metrics(spark, str(tmp_path), region="emea").collect()} == {"emea"}


def test_landed_folders_are_pruned(spark, tmp_path):
    for day in ("2024-01-02", "2024-01-03"):
        _land(tmp_path, "latam", day, [{"post_id": "p", "likes": "1"}])
    df = read_landed_metrics(spark, str(tmp_path)).where("dt = DATE '2024-01-03'").select("post_id", "likes")
    plan = plan_text(df)
    filters = next(l for l in plan.splitlines() if "PartitionFilters" in l).split("PartitionFilters: ")[1]
    assert filters.startswith("[isnotnull(dt") and "post_id:string,likes:string" in plan and "thumbnail_url" not in plan


def test_text_snapshot_stays_text(spark, tmp_path):
    (tmp_path / "s.csv").write_text("fecha,reach\n2024-01-05,\" 1,200 \"\n,x\n")
    df = read_text_snapshot(spark, str(tmp_path / "s.csv"), ["fecha", "reach"], dated=True, fmt="csv", header="true")
    assert [tuple(r) for r in df.collect()] == [(D(2024, 1, 5), " 1,200 "), (None, "x")]


def test_table_round_trip_and_pruning(spark, tmp_path):
    df = raw(spark, SF)
    path = str(tmp_path / "t")
    for _ in range(2):  # the second run replaces the first
        write_table(df, path, *TABLE_LAYOUTS["post_metrics_raw"])
    back = read_table(spark, path, df.schema)
    assert back.columns == df.columns and back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    day = back.where("ingest_date = DATE '2024-01-03'")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_text(day)
    assert day.count() == df.where("ingest_date = DATE '2024-01-03'").count() > 0


def test_hot_day_is_written_by_many_tasks(spark, tmp_path):
    """Most rows lie on one day, as after a backfill."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 7, F.lit("2024-01-01")).otherwise("2024-01-02").cast("date").alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_table(df, str(tmp_path / "t"), "day", ["text"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_staged_tables_lie_in_the_named_folder(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = stage(spark.range(3), "three")
    assert spark.conf.get("spark.checkpoint.dir") in kept.inputFiles()[0]
    assert kept.count() == 3 and "Range" not in plan_text(kept)


def test_rebuild_regions(spark, tmp_path):
    base = str(tmp_path / "in")
    for name in FIXTURES:
        if name == "fx_post_metrics":
            landed = fixture(spark, SF, name).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp"))
            landed.write.partitionBy("region", "dt").json(f"{base}/post_metrics")
        elif name != "fx_platform_posts":
            fixture(spark, SF, name).write.parquet(f"{base}/{name.removeprefix('fx_')}")
    sources = read_sources(spark, base, SETTINGS)
    built = rebuild_regions({"latam": sources}, str(tmp_path), {"latam": SETTINGS})["latam"]
    assert built["dm_executive_scorecard"].count() == full_scorecard(spark, SF).count() > 0
    run = next(p for p in (tmp_path / "latam").iterdir() if len(p.name) == 32)
    assert set(TABLE_LAYOUTS | OWN_LAYOUTS) - {"post_metrics_raw"} | {"landed"} == {p.name for p in run.iterdir()}
    assert not [p for p in os.listdir(checkpoint_folder(spark)) if p.startswith("rebuild-")]  # what was staged is gone
    assert "_loaded_at" in built["post_metrics"].columns and "_loaded_at" not in built["dm_post_performance"].columns
    names = publish_views(built, "latam_")
    assert len(names) == len(TABLE_LAYOUTS) + 12
    assert spark.sql("SELECT count(*) FROM latam_dw_tiktok").first()[0] == built["dw_tiktok"].count()

    later = open_region(sources, str(tmp_path), SETTINGS)
    assert set(later) == set(built)
    assert built["rejected_lines"].count() == 0
    for name in ["dm_match_content", "dm_match_coverage", "dw_tiktok", "dm_sov", "dm_post_performance"]:
        assert later[name].count() == built[name].count()


def test_unset_folder_off_local_mode_is_refused(monkeypatch):
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(Session())


def test_shuffles_are_sized_by_the_input(spark):
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(2**40) == 2048
    assert shuffle_partitions(10**14) == 186_265
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffles(spark.range(10)) == int(before)
    try:
        files = spark.read.parquet(f"{SF}/orders.parquet")
        known = sum(os.path.getsize(p) for p in glob.glob(f"{SF}/*.parquet"))  # the folder is listed
        assert input_bytes(files) == known
        assert size_shuffles(files, per_partition=1000) == -(-known // 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lines_that_cannot_be_read_are_kept_apart(spark, tmp_path):
    _land(tmp_path, "latam", "2024-01-02", [{"post_id": "p", "likes": "5"}])
    (tmp_path / "region=latam" / "dt=2024-01-02" / "more.json").write_text('{"post_id": "q", "likes": \n{"post_id": "r"}\nnot json\n')
    assert {r["post_id"] for r in read_landed_metrics(spark, str(tmp_path)).collect()} == {"p", "r"}
    rejected = read_rejected_lines(spark, str(tmp_path))
    assert sorted((r["region"], r["dt"], r["line"]) for r in rejected.collect()) == [
        ("latam", D(2024, 1, 2), "not json"), ("latam", D(2024, 1, 2), '{"post_id": "q", "likes": ')]


def _staged_sources(spark):
    return {n.removeprefix("fx_"): stage(fixture(spark, SF, n), n) for n in FIXTURES if n != "fx_platform_posts"}


def test_a_failed_rebuild_leaves_the_tables_before(spark, tmp_path, monkeypatch):
    sources = _staged_sources(spark)
    built = rebuild(sources, str(tmp_path), SETTINGS)
    want = built["dm_executive_scorecard"].count()

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr("postlens.plans.scorecard.executive_scorecard", fail)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError, match="lost"):
        rebuild(sources, str(tmp_path), SETTINGS)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert open_region(sources, str(tmp_path), SETTINGS)["dm_executive_scorecard"].count() == want > 0


def test_a_region_without_matched_content_opens_again(spark, tmp_path):
    sources = _staged_sources(spark)
    sources |= {"register": sources["register"].limit(0), "paid": sources["paid"].limit(0)}
    rebuild(sources, str(tmp_path), SETTINGS)
    opened = open_region(sources, str(tmp_path), SETTINGS)
    assert opened["dm_content_timeseries"].count() == 0 and opened["post_metrics"].count() > 0
    assert "_loaded_at" in opened["post_metrics"].columns


def test_newest_rows_are_read_without_a_shuffle(spark, tmp_path):
    series = posts.post_series(raw(spark, SF), SETTINGS)
    path = str(tmp_path / "series")
    write_table(series, path, *TABLE_LAYOUTS["post_metrics"])
    newest = posts.post_performance(read_table(spark, path, series.schema), SETTINGS)
    plan = plan_text(newest)
    assert "Exchange" not in plan and "EqualTo(_is_newest,true)" in plan or "PushedFilters: [IsNotNull(_is_newest)" in plan
    want = posts.post_performance(posts.post_metrics(raw(spark, SF), SETTINGS), SETTINGS)
    assert newest.exceptAll(want).count() == 0 == want.exceptAll(newest).count()


def test_views_follow_the_sheets(spark, tmp_path):
    sources = _staged_sources(spark)
    folder = str(tmp_path / "register")
    sources["register"].write.parquet(folder)
    sources["register"] = spark.read.schema(sources["register"].schema).parquet(folder)
    rebuild(sources, str(tmp_path), SETTINGS)
    first = open_region(sources, str(tmp_path), SETTINGS)["dm_match_coverage"].count()
    sources["register"].limit(5).write.mode("append").parquet(folder)
    sources["register"] = spark.read.schema(sources["register"].schema).parquet(folder)
    assert open_region(sources, str(tmp_path), SETTINGS)["dm_match_coverage"].count() == first + 10


def test_brand_targets_are_settings(spark, tmp_path):
    own = replace(SETTINGS, brand_targets=[("sentiment", "brand", "Sentiment", 1, 0.9, "percent")])
    built = rebuild(_staged_sources(spark), str(tmp_path), own)
    rows = built["kpi_targets"].where("metric_id = 'sentiment'").collect()
    assert [r["target_value"] for r in rows] == [0.9]


REGISTER = ["market", "fecha", "nombre"]


@pytest.mark.parametrize("header", ["market,fecha,nombre", "nombre, Fecha ,more,market", '\ufeff"nombre",x,"fecha",y,"market"'])
def test_sheet_columns_are_bound_by_name(spark, tmp_path, header):
    names = [c.strip().strip('\ufeff"').lower() for c in header.split(",")]
    row = ",".join({"market": "mexico", "fecha": "2024-01-05", "nombre": '"Post, A"'}.get(c, "z") for c in names)
    (tmp_path / "s.csv").write_text(f"{header}\n{row}\n", encoding="utf8")
    df = read_text_snapshot(spark, str(tmp_path / "s.csv"), REGISTER, dated=True, fmt="csv")
    assert [tuple(r) for r in df.collect()] == [("mexico", D(2024, 1, 5), "Post, A")]


def test_files_of_a_sheet_may_differ_in_their_order(spark, tmp_path):
    folder = tmp_path / "a sheet"
    folder.mkdir()
    (folder / "1.csv").write_text("market,fecha,nombre\nm1,f1,n1\n")
    (folder / "2.csv").write_text("nombre,market,fecha,extra\nn2,m2,f2,x\nn3,m3,f3,x\n")
    (folder / "3.csv").write_text("")
    df = read_text_snapshot(spark, str(folder), REGISTER, fmt="csv")
    assert sorted(map(tuple, df.collect())) == [(f"m{k}", f"f{k}", f"n{k}") for k in (1, 2, 3)]
    assert df.select("nombre").count() == 3


@pytest.mark.parametrize("header,said", [("market,nombre", "no column fecha"), ("market,fecha,nombre,Market", "more than one column market"), ("a,b,c", "no column")])
def test_wrong_headers_raise(spark, tmp_path, header, said):
    (tmp_path / "s.csv").write_text(f"{header}\na,b,c\n")
    with pytest.raises(ValueError, match=said):
        read_text_snapshot(spark, str(tmp_path / "s.csv"), REGISTER, fmt="csv")
    (tmp_path / "ok.csv").write_text("market,nombre\na,b\n")
    df = read_text_snapshot(spark, str(tmp_path / "ok.csv"), REGISTER, fmt="csv", optional=["fecha"])
    assert [tuple(r) for r in df.collect()] == [("a", None, "b")]


def test_parquet_sheets_need_their_columns_too(spark, tmp_path):
    spark.createDataFrame([("n", "m")], "nombre string, market string").write.parquet(str(tmp_path / "s"))
    with pytest.raises(ValueError, match="no column fecha"):
        read_text_snapshot(spark, str(tmp_path / "s"), REGISTER)
    assert read_text_snapshot(spark, str(tmp_path / "s"), ["market", "nombre"]).first() == ("m", "n")


def test_landed_lines_are_scanned_once(spark, tmp_path, monkeypatch):
    """The landed files may go as soon as the first table is written."""
    base = tmp_path / "in"
    record = {"post_id": "p", "likes": "5", "network": "TWITTER", "created_at": "2024-01-01T10:00:00Z", "_ingested_at": "2024-01-02T00:00:00Z"}
    _land(base / "post_metrics", "latam", "2024-01-02", [record, record | {"post_id": "q"}])
    (base / "post_metrics" / "region=latam" / "dt=2024-01-02" / "more.json").write_text("not json\n")
    sources = _staged_sources(spark) | {"post_metrics": read_landed_lines(spark, str(base / "post_metrics"), "latam")}
    write = __import__("postlens.plans.rebuild", fromlist=["write_landed"]).write_landed

    def write_once(*args):
        write(*args)
        shutil.rmtree(base)

    monkeypatch.setattr("postlens.plans.rebuild.write_landed", write_once)
    built = rebuild(sources, str(tmp_path), SETTINGS)
    assert sorted(r["post_id"] for r in built["post_metrics"].collect()) == ["p", "q"]
    assert [tuple(r) for r in built["rejected_lines"].collect()] == [("latam", D(2024, 1, 2), "not json")]
    plan = plan_text(built["rejected_lines"])
    assert "part=rejected_lines" in plan or "PartitionFilters: [isnotnull(part" in plan


def test_files_of_a_split_day_are_skipped(spark, tmp_path):
    """One day holds most rows, one network most of those."""
    df = spark.range(120_000).select(
        F.when(F.col("id") % 10 < 8, F.lit("2024-01-01")).otherwise("2024-01-02").cast("date").alias("day"),
        F.when(F.col("id") % 2 == 0, F.lit("n0")).otherwise(F.concat(F.lit("n"), F.col("id") % 9)).alias("network"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("country"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        write_table(df, str(tmp_path / "t"), "day", ["network", "country"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))

    def may_hold(path, network):
        meta = pq.ParquetFile(path).metadata
        at = [meta.schema.column(k).name for k in range(len(meta.schema))].index("network")
        stats = [meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups)]
        return any(s.min <= network <= s.max for s in stats)

    assert len(files) >= 8
    assert sum(may_hold(f, "n5") for f in files) <= 3
    assert len(files) > sum(may_hold(f, "n0") for f in files) >= 4  # the hot network alone is cut as well
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    found = spark.read.parquet(str(tmp_path / "t")).where("network = 'n5'")
    assert found.count() == df.where("network = 'n5'").count()


def _fake_run(spark, region, run, value):
    spark.range(1).select(F.lit(value).alias("v")).write.parquet(f"{region}/{run}/t")
    finish_run(spark, region, run, {"t": "v"})


def test_open_readers_keep_their_run(spark, tmp_path):
    region = str(tmp_path / "r")
    runs = [uuid.uuid4().hex for _ in range(5)]
    with pytest.raises(ValueError, match="no run"):
        hold_latest(spark, region)
    for k, run in enumerate(runs[:3]):
        _fake_run(spark, region, run, k)
    assert finished_runs(spark, region) == runs[2::-1]
    opened, hold = hold_latest(spark, region)
    table = spark.read.parquet(f"{region}/{opened}/t")
    assert opened == runs[2] and retire_runs(spark, region, keep=2) == [runs[0]]
    for k in (3, 4):
        _fake_run(spark, region, runs[k], k)
        retire_runs(spark, region, keep=1)
    assert table.first()["v"] == 2 and finished_runs(spark, region) == [runs[4]]
    assert hold_run(spark, region, runs[2]) is None  # retired: no new reader
    assert {p for p in os.listdir(region) if len(p) == 32} == {runs[2], runs[4]}
    hold.release()
    assert retire_runs(spark, region, keep=1) == [runs[2]]
    assert {p for p in os.listdir(region) if len(p) == 32} == {runs[4]}
    assert os.listdir(f"{region}/runs") == [f"run={runs[4]}"] and not [p for p in os.listdir(f"{region}/retired") if p.startswith("run=")]
    assert retire_runs(spark, region, keep=1) == []


def test_holds_end_and_lost_runs_go(spark, tmp_path):
    region = str(tmp_path / "r")
    old, new, lost, running = (uuid.uuid4().hex for _ in range(4))
    for run in (old, new):
        _fake_run(spark, region, run, 1)
    for run in (lost, running):
        os.makedirs(f"{region}/{run}")
    os.utime(f"{region}/{lost}", (1, 1))
    hold_run(spark, region, old, hours=-1)
    assert retire_runs(spark, region, keep=1) == sorted([old, lost])
    assert {p for p in os.listdir(region) if len(p) == 32} == {new, running}
    with pytest.raises(ValueError):
        retire_runs(spark, region, keep=0)


def test_a_reader_stays_open_across_rebuilds(spark, tmp_path):
    sources = _staged_sources(spark)
    rebuild(sources, str(tmp_path), SETTINGS, keep_runs=1)
    opened = open_region(sources, str(tmp_path), SETTINGS)
    want = opened["dm_executive_scorecard"].count()
    folders = []
    for _ in range(2):
        rebuild(sources, str(tmp_path), SETTINGS, keep_runs=1)
        folders.append(sum(len(p) == 32 for p in os.listdir(tmp_path / "latam")))
    assert folders == [2, 2] and opened["dm_executive_scorecard"].count() == want > 0
    assert opened["dw_instagram"].count() >= 0 and opened["post_metrics_raw"].count() > 0
    opened.hold.release()
    rebuild(sources, str(tmp_path), SETTINGS, keep_runs=1)
    assert sum(len(p) == 32 for p in os.listdir(tmp_path / "latam")) == 1


def test_regions_with_different_records_are_built_together(spark, tmp_path):
    sources = _staged_sources(spark)
    chosen = {r: replace(SETTINGS, region=r) for r in ("latam", "emea")}
    fed = {
        "latam": sources | {"post_metrics": sources["post_metrics"].where("xxhash64(post_id) % 3 <> 0")},
        "emea": sources | {"post_metrics": sources["post_metrics"].where("xxhash64(post_id) % 3 = 0"), "listening": sources["listening"].limit(5)},
    }
    together = rebuild_regions(fed, str(tmp_path / "both"), chosen)
    for region, settings in chosen.items():
        alone = rebuild(fed[region], str(tmp_path / "alone"), settings)
        assert set(alone) == set(together[region])
        for name in alone:
            columns = [c for c in alone[name].columns if c != "_loaded_at"]
            if name == "dm_content_posts":  # numbers of posts differ from run to run only if the posts do
                columns.remove("bits")
            a, b = (t[name].select(*columns) for t in (alone, together[region]))
            assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count(), name
    assert together["latam"]["post_metrics"].count() != together["emea"]["post_metrics"].count() > 0


def test_a_region_that_fails_leaves_the_others_alone(spark, tmp_path):
    sources = _staged_sources(spark)
    chosen = {r: replace(SETTINGS, region=r) for r in ("latam", "emea")}
    broken = sources | {"listening": spark.range(1)}
    with pytest.raises(ExceptionGroup) as failed:
        rebuild_regions({"latam": sources, "emea": broken}, str(tmp_path), chosen)
    assert len(failed.value.exceptions) == 1
    assert open_region(sources, str(tmp_path), chosen["latam"])["dm_platform_summary"].count() > 0
    with pytest.raises(ValueError, match="no run"):
        open_region(sources, str(tmp_path), chosen["emea"])
