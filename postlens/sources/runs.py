"""The runs of a region: which have ended, who reads them, and how old ones go.

``runs/run=<id>`` lists a run that has ended. Readers lay a marker under ``readers/<id>``
before they read. To retire a run its entry moves to ``retired``, and only then are markers looked for; a reader
looks for the entry again after its marker is laid. So either the reader sees that the
run is going, or the run's removal sees the reader.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.sources.files import exists, listed, move, remove, touch

_ENTRY = T.StructType([
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("schemas", T.MapType(T.StringType(), T.StringType())),
    T.StructField("run", T.StringType()),
])
_RUN = re.compile("[0-9a-f]{32}")

#: Ended runs that stay, hours that a reader holds a run unless it says otherwise, and hours after which a run that never ended counts as lost.
KEPT_RUNS, HOLD_HOURS, LOST_HOURS = 2, 24.0, 72.0


@dataclass(frozen=True)
class Hold:
    """A reader's marker. The run stays until it is released or its time is over."""

    spark: SparkSession
    marker: str

    def release(self) -> None:
        remove(self.spark, self.marker)

    def __enter__(self) -> Hold:
        return self

    def __exit__(self, *error: object) -> None:
        self.release()


def finish_run(spark: SparkSession, region: str, run: str, schemas: dict[str, str]) -> None:
    """Enter a run that has ended, as a folder of its own, so that entries are added and removed one by one."""
    row = spark.createDataFrame([(None, schemas)], T.StructType(_ENTRY.fields[:2])).withColumn("finished_at", F.current_timestamp())
    row.coalesce(1).write.parquet(f"{region}/runs/run={run}")


def _entries(spark: SparkSession, region: str) -> DataFrame:
    return spark.read.schema(_ENTRY).parquet(f"{region}/runs")


def finished_runs(spark: SparkSession, region: str) -> list[str]:
    """Runs that have ended, the newest first."""
    if not any(n.startswith("run=") for n in listed(spark, f"{region}/runs")):
        return []
    return [r["run"] for r in _entries(spark, region).select("run", "finished_at").orderBy(F.desc("finished_at"), "run").collect()]


def schemas_of(spark: SparkSession, region: str, run: str) -> dict[str, str]:
    return _entries(spark, region).where(F.col("run") == run).first()["schemas"]


def hold_run(spark: SparkSession, region: str, run: str, hours: float = HOLD_HOURS) -> Hold | None:
    """Keep a run from being removed for so many hours; None if it has been retired already."""
    until = int((time.time() + 3600 * hours) * 1000)
    hold = Hold(spark, f"{region}/readers/{run}/{until}-{uuid.uuid4().hex}")
    touch(spark, hold.marker)
    if exists(spark, f"{region}/runs/run={run}"):
        return hold
    hold.release()
    return None


def hold_latest(spark: SparkSession, region: str, hours: float = HOLD_HOURS) -> tuple[str, Hold]:
    """The newest run that has ended, held."""
    while runs := finished_runs(spark, region):
        if hold := hold_run(spark, region, runs[0], hours):
            return runs[0], hold
    raise ValueError(f"no run of {region} has ended")


def _held(spark: SparkSession, region: str, run: str) -> bool:
    """Whether a reader holds the run. Markers whose time is over go."""
    now, held = time.time() * 1000, False
    for name in listed(spark, f"{region}/readers/{run}"):
        if int(name.split("-")[0]) > now:
            held = True
        else:
            remove(spark, f"{region}/readers/{run}/{name}")
    return held


def retire_runs(spark: SparkSession, region: str, keep: int = KEPT_RUNS, lost_hours: float = LOST_HOURS) -> list[str]:
    """Remove ended runs but the newest ``keep`` and those that readers hold, and runs that never ended; returns which went.

    A run that is held goes when a later call finds it free. May be called at any time, also twice at once or again after a failure.
    """
    if keep < 1:
        raise ValueError("the newest run stays")
    for run in finished_runs(spark, region)[keep:]:
        move(spark, f"{region}/runs/run={run}", f"{region}/retired/run={run}")
    entered = {n.removeprefix("run=") for n in listed(spark, f"{region}/runs")}
    retired = {n.removeprefix("run=") for n in listed(spark, f"{region}/retired")}
    lost = {n for n, at in listed(spark, region).items()
            if _RUN.fullmatch(n) and n not in entered | retired and at < (time.time() - 3600 * lost_hours) * 1000}
    gone = sorted(run for run in retired | lost if not _held(spark, region, run))
    for run in gone:
        for place in (run, f"readers/{run}", f"retired/run={run}"):
            remove(spark, f"{region}/{place}")
    return gone
