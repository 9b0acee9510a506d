from __future__ import annotations

import pytest

from postlens.llm.common import _BATCH_BYTES_KEY, BATCH_BYTES, ship


def test_long_texts_reach_workers_in_bounded_batches(spark):
    spark.conf.set(_BATCH_BYTES_KEY, "64m")
    ship(spark)

    def measure(batches):
        for batch in batches:
            yield batch[["text"]].assign(n=batch["text"].str.len().sum())[["n"]].head(1)

    texts = spark.range(4000, numPartitions=1).selectExpr("repeat('word ', 1000) AS text")
    sizes = [r["n"] for r in texts.mapInPandas(measure, "n long").collect()]
    assert sum(sizes) == 4000 * 5000 and max(sizes) <= 1.1 * BATCH_BYTES


@pytest.mark.parametrize("given, then", [("64m", BATCH_BYTES), (str(8 * BATCH_BYTES), BATCH_BYTES), ("1m", "1m"), ("300000", "300000")])
def test_a_lower_setting_stays(spark, given, then):
    before = spark.conf.get(_BATCH_BYTES_KEY)
    spark.conf.set(_BATCH_BYTES_KEY, given)
    ship(spark)
    now = spark.conf.get(_BATCH_BYTES_KEY)
    spark.conf.set(_BATCH_BYTES_KEY, before)
    assert now.rstrip("b") == str(then)
