"""Source tables. Schemas are stated, never inferred."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.fixed_values import COUNTERS, IDENTITY, POST_FIELDS, RATES
from postlens.settings import Settings

_TEXT = T.StringType()

LANDED_SCHEMA = T.StructType(
    [T.StructField(c, T.TimestampType() if c == "created_at" else _TEXT) for c in IDENTITY + POST_FIELDS]
    + [T.StructField(c, _TEXT) for c in COUNTERS + RATES]
    + [
        T.StructField("_ingested_at", T.TimestampType()),
        # The two path keys; the region field inside the records is not read.
        T.StructField("region", _TEXT),
        T.StructField("dt", T.DateType()),
    ]
)

# Columns of the text snapshots. The two brand tables have a date and
# one column per brand, which the settings name.
SNAPSHOT_COLUMNS = {
    "register": [
        "market", "fecha", "nombre", "link_ig", "link_tiktok", "autor", "copy_out", "tipo_contenido", "pauta_ig",
        "pauta_tiktok",
    ],
    "paid": [
        "published_date", "name", "creador", "esfuerzo", "network", "format", "url", "inversion_ejecutada", "reach",
        "impressions", "views", "vtr_50", "likes", "comments", "shares", "engagement", "engagement_rate",
        "investment", "fuente", "post_id",
    ],
    "targets": [
        "pais", "region", "kpi", "reach", "views_platform", "impressions", "ave_impressions", "ave_views",
        "comments", "likes", "share", "saves", "vtr50", "engagement_rate", "share_rate", "save_rate",
    ],
    "listening": ["fecha", "reach", "total_mentions", "menciones_efectivas", "men_pos", "men_neg", "men_neu"],
}

# Columns that no model reads; a sheet may lack them.
OPTIONAL_COLUMNS = {"paid": ["esfuerzo", "network", "engagement_rate", "investment", "fuente"]}

# The column of ``read_landed_lines`` that holds a line which can't be read, and is NULL beside a readable one.
BROKEN = "_corrupt_record"

# Empty for readable lines. Spark tells broken lines only to readers of some other column as well.
_BROKEN_TEXT = f"concat_ws('', {BROKEN}, left(post_id, 0))"


def read_landed_lines(spark: SparkSession, base: str, region: str | None = None) -> DataFrame:
    """All lines of newline-delimited JSON under ``region=<r>/dt=<day>/``, unreadable ones in a column of their own.

    A rebuild reads this once and writes both kinds apart.
    """
    schema = T.StructType([*LANDED_SCHEMA.fields, T.StructField(BROKEN, _TEXT)])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", BROKEN).option("basePath", base)
    return reader.json(f"{base}/region={region}" if region else base)


def read_landed_metrics(spark: SparkSession, base: str, region: str | None = None) -> DataFrame:
    """Readable records of newline-delimited JSON under ``region=<r>/dt=<day>/``; folders of other regions are not listed."""
    lines = read_landed_lines(spark, base, region)
    return lines.where(f"{_BROKEN_TEXT} = ''").drop(BROKEN)


def read_rejected_lines(spark: SparkSession, base: str, region: str | None = None) -> DataFrame:
    """The lines that ``read_landed_metrics`` leaves out, as they stand, with where they lie."""
    lines = read_landed_lines(spark, base, region).where(f"{_BROKEN_TEXT} <> ''")
    return lines.select("region", "dt", F.expr(_BROKEN_TEXT).alias("line"))


def snapshot_schema(columns: Sequence[str], dated: bool) -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.DateType() if dated and c == "fecha" else _TEXT) for c in columns]
    )


def _header_files(spark: SparkSession, path: str, options: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV snapshot by the columns that their first lines name.

    One job reads the first block of each file. What comes back is one line for each
    different header and the names of the files under it.
    """
    text = spark.read.format("text").options(**{k: v for k, v in options.items() if k in ("encoding", "lineSep", "pathGlobFilter")})
    lines = text.load(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at")).where("start = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line").collect():
        cells = next(csv.reader([row["line"].removeprefix("\ufeff")], delimiter=options.get("sep", ","), quotechar=options.get("quote", '"')), [])
        found.setdefault(tuple(c.strip() for c in cells), []).extend(unquote(f) for f in row["files"])
    return found


def _check_columns(path: str, found: Sequence[str], columns: Sequence[str], optional: Sequence[str]) -> list[str]:
    """The columns to read; an error where one is missing, or named twice."""
    names = [c.lower() for c in found]
    missing = [c for c in columns if c.lower() not in names and c not in optional]
    twice = [c for c in columns if names.count(c.lower()) > 1]
    if missing or twice:
        raise ValueError(f"{path}: " + "; ".join(
            f"{what} {', '.join(which)}" for what, which in (("no column", missing), ("more than one column", twice)) if which)
            + f"; the header has {', '.join(found)}")
    return [c for c in columns if c.lower() in names]


def read_text_snapshot(
    spark: SparkSession, path: str, columns: Sequence[str], dated: bool = False, fmt: str = "parquet",
    optional: Sequence[str] = (), **options: str
) -> DataFrame:
    """A sheet snapshot in which every metric is still text.

    Columns are bound by name, whatever their order, and others are not read. A column that
    is missing, unless it is ``optional`` (then NULL), or that stands there twice, is an error.
    Each CSV file is read by its own header, and names match without regard to case and outer blanks.
    Only with ``header="false"``, or in a format without a schema of its own, are
    columns taken as they are.
    """
    def read(names: Sequence[str], files: str | list[str], present: Sequence[str]) -> DataFrame:
        df = spark.read.schema(snapshot_schema(names, dated)).format(fmt).options(**options).load(files)
        return df.select(*[(F.col(f"`{c}`") if c in present else F.lit(None).cast(_TEXT)).alias(c) for c in columns])

    if fmt == "csv" and options.setdefault("header", "true").lower() == "true":
        by_header = _header_files(spark, path, options)
        parts = []
        for header, files in by_header.items():
            present = _check_columns(path, header, columns, optional)
            known = {c.lower(): c for c in present}
            names = [known.get(c.lower(), f"_{k}_{c}") for k, c in enumerate(header)]
            parts.append(read(names, path if len(by_header) == 1 else files, present))
        if not parts:  # no file has a line
            return read(columns, path, columns)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    present = list(columns)
    if fmt in ("parquet", "orc"):
        present = _check_columns(path, spark.read.format(fmt).load(path).columns, columns, optional)
    return read(present, path, present)


def read_sources(
    spark: SparkSession, base: str, settings: Settings, fmt: str = "parquet", **options: str
) -> dict[str, DataFrame]:
    """Every source table of a region: the lines of landed metrics, read and unreadable ones, and the six snapshots.

    ``fecha`` is a date in the three daily tables and text in the register.
    """
    columns = SNAPSHOT_COLUMNS | {
        "competitors": ["fecha", *settings.competitor_brands],
        "sponsors": ["fecha", *settings.sponsor_brands],
    }
    dated = {"listening", "competitors", "sponsors"}
    tables = {
        name: read_text_snapshot(spark, f"{base}/{name}", names, name in dated, fmt, OPTIONAL_COLUMNS.get(name, ()), **options)
        for name, names in columns.items()
    }
    return {"post_metrics": read_landed_lines(spark, f"{base}/post_metrics", settings.region), **tables}
