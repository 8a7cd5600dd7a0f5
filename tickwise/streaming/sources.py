"""Stream sources (S5-S7) and a table-as-stream reader for tests and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickwise.session import is_folder


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table read as a file stream (schema taken from the table): a
    folder of part files, or one file (a stream then reads its parent folder,
    filtered to that name)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, path):
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def folder_stream(spark: SparkSession, path: str, schema: StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files anywhere below a folder, as they arrive."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def csv_stream(spark: SparkSession, path: str, schema: StructType, header: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """CSV files dropped into a folder, fixed schema, malformed rows kept as nulls."""
    r = (spark.readStream.schema(schema).option("header", header)
         .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per line (column ``value``), e.g. JSON envelopes in files."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)


def kafka_options(servers: str, topic: str, starting_offsets: str | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the message-bus source (topic, start offsets, rate limit)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str | None = None,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """``key, value`` strings from a topic (needs the Kafka connector jar)."""
    r = spark.readStream.format("kafka").options(
        **kafka_options(servers, topic, starting_offsets, max_offsets_per_trigger))
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
