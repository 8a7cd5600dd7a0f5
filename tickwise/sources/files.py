"""File formats: CSV scans, archive JSON, scraped histories, cached tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwise import schemas
from tickwise.functions import numeric as num
from tickwise.functions import timefmt as tf
from tickwise.session import is_written


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
             header: bool = True, drop_index: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """S1 + U1 (+ S2): one scan over several CSV files with an explicit schema.

    ``drop_index`` names a saved row-label column to drop (the unnamed first
    column pandas writes). ``multi_line`` is for files with line feeds inside
    quoted cells; such a file cannot be split and is read by one task.
    """
    df = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
          .option("multiLine", multi_line).option("escape", '"').csv(list(paths) if not isinstance(paths, str) else paths))
    return df.drop(drop_index) if drop_index else df


def with_index_column(schema: StructType, name: str = "_c0") -> StructType:
    """The schema of a CSV written with its row label first (S2 input)."""
    from pyspark.sql.types import IntegerType, StructField
    return StructType([StructField(name, IntegerType()), *schema.fields])


def read_archive(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S3: monthly archive responses, one JSON document per file, or per line
    with ``multi_line=False`` (such files can be split)."""
    return spark.read.schema(schemas.ARCHIVE_JSON).option("multiLine", multi_line).json(path)


def read_history(spark: SparkSession, path: str | Sequence[str],
                 coin_from_file: bool = True) -> DataFrame:
    """Scraped daily histories -> ``(coin, date, open, high, low, close, volume, market_cap)``.

    P12: ``-`` volume / market cap becomes 0 (bigint); F13: ``MMM dd, yyyy``
    dates; the coin name comes from the file name (``<coin>-history.csv``).
    """
    df = read_csv(spark, path, schemas.HISTORY_CSV, header=True, drop_index="_index")
    df = df.withColumnsRenamed(schemas.HISTORY_RENAMES)
    coin = (F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"^(.*)-history\.csv$", 1)
            if coin_from_file else F.lit(None).cast("string"))
    return df.select(coin.alias("coin"), tf.parse_scraped_date("date_str").alias("date"),
                     "open", "high", "low", "close",
                     num.dash_to_zero_bigint("volume").alias("volume"),
                     num.dash_to_zero_bigint("market_cap").alias("market_cap"))


def freshness_split(spark: SparkSession, path: str, max_age_days: int,
                    reader: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """Rows tagged ``fresh`` when their file is at most ``max_age_days``
    old, else ``stale`` (to be fetched again); one scan, age from file metadata."""
    reader = reader or (lambda s, p: read_csv(s, p, schemas.HISTORY_CSV))
    df = reader(spark, path)
    mtime = F.col("_metadata.file_modification_time")
    age_days = F.datediff(F.current_timestamp(), mtime)
    return df.withColumn("cache_state",
                         F.when(age_days <= max_age_days, F.lit("fresh")).otherwise(F.lit("stale")))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None,
                sort_by: Sequence[str] | None = None) -> None:
    """K1 (+ O1): write a result (CSV gets a header row; Parquet is the default).

    ``sort_by`` writes the files in that global order (a range-partitioned
    sort, e.g. articles by publication time before a CSV export).
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame],
           recompile: bool = False, partition_by: Sequence[str] | None = None) -> DataFrame:
    """K4: reuse a materialised table unless ``recompile``; otherwise build,
    write (cutting the lineage in the shared folder) and read back. A table
    counts as there if its success marker is; any other error is raised."""
    if not recompile and is_written(spark, path):
        return spark.read.parquet(path)
    write_table(build(), path, partition_by=partition_by)
    return spark.read.parquet(path)
