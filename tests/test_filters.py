from __future__ import annotations

from postlens.operators import likely_in, split_likely


def test_what_is_in_stays_and_little_else(spark):
    df = spark.range(100_000).selectExpr("IF(id = 7, NULL, id) AS k", "id AS __row")
    ids = spark.range(0, 100_000, 100).selectExpr("id AS wanted").union(spark.createDataFrame([(None,)], "wanted long"))
    found = likely_in(df, "k", ids)
    assert found.columns == ["k", "__row"]
    rows = {r["__row"] for r in found.collect()}
    assert set(range(0, 100_000, 100)) | {7} <= rows and len(rows) < 1_100
    likely, others = split_likely(df, "k", ids)
    assert likely.count() + others.count() == 100_000
    assert likely_in(df, "k", ids.limit(0)).count() == 1
