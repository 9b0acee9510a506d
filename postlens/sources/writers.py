"""Table and view sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Table -> (partition column, clustering columns).
TABLE_LAYOUTS: dict[str, tuple[str | None, list[str]]] = {
    "post_metrics_raw": ("ingest_date", ["network", "profile_id"]),
    "post_metrics": ("ingest_date", ["network", "country", "profile_id"]),
    "dm_post_performance": ("published_date", ["network", "campaign_tag"]),
    "dm_platform_summary": ("fact_date", ["network", "country"]),
    "dm_format_performance": (None, ["network", "format"]),
    "dm_content_timeseries": ("published_date", ["network", "market", "pauta"]),
    "kpi_targets": (None, []),
    "dm_executive_scorecard": ("published_date", ["metric_id", "network", "market", "pauta"]),
}


# Tables that are ours alone.
OWN_LAYOUTS: dict[str, tuple[str | None, list[str]]] = {
    "dm_content_posts": ("published_date", ["network", "market", "pauta"]),
}


def with_load_time(df: DataFrame, name: str = "_loaded_at") -> DataFrame:
    """Audit column, added only where a table is written."""
    return df.withColumn(name, F.current_timestamp())


def write_table(
    df: DataFrame, path: str, partition: str | Sequence[str] | None = None, cluster: Sequence[str] | None = None, gather: bool = True
) -> None:
    """Write a table, one folder per partition value, laid out and sorted by the clustering columns.

    Tasks get ranges of (partition, clustering columns). So a day's rows are in few
    files, and a day that holds much of the table is cut into files of which each
    has a narrow range of the clustering columns: a filter on those skips files by their
    statistics. A hash of the row ends the order, so even one combination that holds
    most of a day is cut. Ranges come from a sample, for which Spark computes the last stage of ``df`` a second
    time. With ``gather=False`` tasks write what they hold, for input that already lies
    by partition.
    """
    folders = [partition] if isinstance(partition, str) else list(partition or [])
    order = [*folders, *(cluster or [])]
    if order:
        if gather:
            df = df.repartitionByRange(*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in order] or [F.lit(0)]))
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*folders) if folders else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written table with its columns back in published order."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


# The folder of a run that holds the lines of one scan, the readable ones as table ``post_metrics_raw``.
LANDED, READABLE, REJECTED = "landed", "post_metrics_raw", "rejected_lines"


def write_landed(raw: DataFrame, broken: str, path: str, cluster: Sequence[str]) -> None:
    """Write typed records and, in folders of their own, the lines that could not be read, in one pass over the lines.

    ``broken`` is the column with such a line.
    """
    part = F.when(F.col(broken).isNull(), READABLE).otherwise(REJECTED)
    # landed files already lie by day
    write_table(raw.withColumn("part", part).withColumnRenamed(broken, "line"), path, ["part", "ingest_date"], cluster, gather=False)


def read_landed_part(spark: SparkSession, path: str, raw: T.StructType, part: str) -> DataFrame:
    """The records that ``write_landed`` wrote, in the columns of ``raw``, or the lines it put apart; other folders are not read."""
    schema = T.StructType([*raw.fields, T.StructField("line", T.StringType()), T.StructField("part", T.StringType())])
    rows = spark.read.schema(schema).parquet(path).where(F.col("part") == part)
    return rows.select(*raw.names) if part == READABLE else rows.select("region", F.col("ingest_date").alias("dt"), "line")


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
