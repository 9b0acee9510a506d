from __future__ import annotations

import pytest

from postlens.sources import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df) -> list[tuple]:
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
