"""Views that a later session opens from SQL text alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.fixtures import FIXTURES, SETTINGS, fixture
from postlens.fixed_values import NETWORK_VIEWS
from postlens.plans.rebuild import open_region, rebuild
from postlens.plans.stored_views import open_views, store_views, view_statements
from postlens.sources import read_sources

SF = "/root/testdata/sf0.001"
VIEWS = ["dm_match_content", "dm_match_coverage", "dm_listening", "dm_sentiment", "dm_sov", *[f"dw_{n}" for n in NETWORK_VIEWS.values()]]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_new_session_needs_only_the_text(spark, tmp_path, fmt):
    base, out = str(tmp_path / "in"), str(tmp_path / "out")
    options = {"header": "true", "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"} if fmt == "csv" else {}
    for name in FIXTURES:
        if name == "fx_post_metrics":
            landed = fixture(spark, SF, name).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp"))
            landed.write.partitionBy("region", "dt").json(f"{base}/post_metrics")
        elif name != "fx_platform_posts":
            fixture(spark, SF, name).write.format(fmt).options(**options).save(f"{base}/{name.removeprefix('fx_')}")
    sources = read_sources(spark, base, SETTINGS, fmt, **options)
    rebuild(sources, out, SETTINGS)
    path = store_views(spark, base, out, SETTINGS, fmt, **options)
    later = spark.newSession()
    open_views(later, path)
    opened = open_region(sources, out, SETTINGS)
    for name in [*VIEWS, "post_metrics_raw", "rejected_lines", "dm_executive_scorecard"]:
        own, stored = opened[name], later.table(name)
        assert stored.columns == own.columns and [t for _, t in stored.dtypes] == [t for _, t in own.dtypes], name
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, own.collect())), name
    assert opened["dm_match_content"].count() > 0 and opened["dm_sov"].count() > 0


def test_pieces_of_links_are_never_broadcast(spark, tmp_path):
    """Cut links are many times the links, which Spark's estimate doesn't know."""
    schemas = {"register": "market string, fecha string, nombre string, link_ig string, link_tiktok string, autor string, copy_out string, "
                           "tipo_contenido string, pauta_ig string, pauta_tiktok string"}
    for name, schema in schemas.items():
        spark.createDataFrame([("m", "d", "n", "https://www.instagram.com/p/abcd1234", None, None, None, None, None, None)], schema).createOrReplaceTempView(f"cut_{name}")
    links = [(f"p{i}", f"https://www.instagram.com/p/{'abcd1234' if i == 3 else i}/") for i in range(50)]
    spark.createDataFrame([*links, (None, None), ("none", None)], "post_id string, source_link string").createOrReplaceTempView("cut_dm_post_performance")
    found = spark.sql(view_statements(SETTINGS, "cut_")["dm_match_coverage"])
    assert [r["matched_post_id"] for r in found.where("platform = 'instagram'").collect()] == ["p3"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
