"""Named queries over files: the tables written as scraped CSV histories and as
archive responses in the shared folder, then read back by the file readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickwise.operators import news
from tickwise.plans.common import finish, sql_list
from tickwise.session import scratch_path
from tickwise.sources import files, incremental, tables

CSV_SPLIT = "1995-06-17"                # orders of either side go to a folder of their own
NO_VOLUME = "P"                         # orders of this status have '-' cells
SECTIONS = ("src1", "src2", "src3")     # P8 list of the registered query
DOCS_PER_RESPONSE = 1000


def q_csv_history(spark, sf_dir):
    """S1 + S2 + U1 + K1 + P12 + F13: orders as scraped daily rows in two folders
    of CSV files (row label first, dates as text, ``-`` cells, thousands
    separators), read back in one scan."""
    o = tables.table(spark, sf_dir, "orders")
    number = F.format_number("o_custkey", 0)
    price = F.col("o_totalprice").cast("double")
    rows = o.select(
        F.col("o_orderkey").alias("_index"), F.date_format("o_orderdate", "MMM dd, yyyy").alias("Date"),
        price.alias("Open*"), price.alias("High"), price.alias("Low"), price.alias("Close**"),
        F.when(F.col("o_orderstatus") == NO_VOLUME, "-").otherwise(number).alias("Volume"),
        number.alias("Market Cap"), (F.col("o_orderdate") < F.lit(CSV_SPLIT).cast("date")).alias("_early"))
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    for name, side in (("early", F.col("_early")), ("late", ~F.col("_early"))):
        files.write_table(rows.where(side).drop("_early"), f"{base}/{name}", fmt="csv")
    back = files.read_history(spark, [f"{base}/early", f"{base}/late"], coin_from_file=False)
    return finish(back.drop("coin"))


def archive_responses(d):
    """``docs``: the rows as archive responses of at most ``DOCS_PER_RESPONSE`` rows,
    numbered by a row's place in its input task, whatever the ids are."""
    doc = F.struct(
        F.concat(F.lit("https://archive/"), F.col("doc_id")).alias("web_url"),
        F.struct(F.concat(F.lit("Document "), F.col("doc_id")).alias("main")).alias("headline"),
        F.struct(F.concat(F.lit("By Byron "), F.col("source")).alias("original")).alias("byline"),
        F.when(F.col("lang") == "en", "article").otherwise("blogpost").alias("document_type"),
        F.col("lang").alias("source"), F.col("source").alias("section_name"),
        F.col("n_chars").alias("word_count"))
    place = F.expr(f"monotonically_increasing_id() div {DOCS_PER_RESPONSE}")
    return (d.select(place.alias("_response"), doc.alias("_doc")).groupBy("_response")
            .agg(F.collect_list("_doc").alias("docs")).drop("_response"))


def q_archive_articles(spark, sf_dir):
    """S3 + P8 + F4 + F27 + P6: documents as archive responses (one a line), read
    back and flattened."""
    docs = archive_responses(tables.table(spark, sf_dir, "documents"))
    path = scratch_path(spark, f"archive-{uuid.uuid4().hex}")
    docs.select(F.to_json(F.struct(F.struct("docs").alias("response"))).alias("value")).write.text(path)
    return news.flatten_archive(files.read_archive(spark, path, multi_line=False), SECTIONS)


def _daily_totals(rows):
    return rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def q_incremental_daily(spark, sf_dir):
    """S8 + K4: daily totals of the events, built from a folder of weekly files; then
    the first week's file changes and only its days are built again."""
    ev = tables.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    base = scratch_path(spark, f"incremental-{uuid.uuid4().hex}")
    week = F.date_trunc("week", "ts").cast("date")
    ev.withColumn("week", week).repartition("week").write.partitionBy("week").parquet(f"{base}/in")

    def read(s, paths):
        return s.read.schema(ev.schema).parquet(*paths).withColumn("day", F.to_date("ts"))

    incremental.rebuild(spark, f"{base}/in", f"{base}/out", read, _daily_totals)
    first = ev.agg(F.min(week)).first()[0]
    if first is not None:
        (ev.where(week == F.lit(first)).withColumn("value", F.col("value") * 2)
         .coalesce(1).write.mode("overwrite").parquet(f"{base}/in/week={first}"))
    incremental.rebuild(spark, f"{base}/in", f"{base}/out", read, _daily_totals)
    return finish(spark.read.parquet(f"{base}/out"))


QUERIES = {"incremental_daily": q_incremental_daily,
           "csv_history": q_csv_history, "archive_articles": q_archive_articles}
ORACLE = {
    "incremental_daily": """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n,
  round(sum(CASE WHEN date_trunc('week', ts) = (SELECT min(date_trunc('week', ts)) FROM events)
            THEN value * 2 ELSE value END), 6) AS total
FROM events GROUP BY 1, 2""",
    "csv_history": f"""SELECT CAST(o_orderdate AS DATE) AS date, round(CAST(o_totalprice AS DOUBLE), 6) AS open,
  round(CAST(o_totalprice AS DOUBLE), 6) AS high, round(CAST(o_totalprice AS DOUBLE), 6) AS low,
  round(CAST(o_totalprice AS DOUBLE), 6) AS close,
  CAST(CASE WHEN o_orderstatus = '{NO_VOLUME}' THEN 0 ELSE o_custkey END AS BIGINT) AS volume,
  CAST(o_custkey AS BIGINT) AS market_cap FROM orders""",
    "archive_articles": f"""SELECT 'Document ' || doc_id AS headline, 'article' AS document_type,
  CAST(NULL AS VARCHAR) AS pub_date, lang AS source, source AS section_name,
  'Byron ' || source AS author, n_chars AS word_count, 'https://archive/' || doc_id AS web_url
FROM documents WHERE lang = 'en' AND source IN ({sql_list(SECTIONS)})""",
}
