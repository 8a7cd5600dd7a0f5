"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import scratch_path


def ship(module: str) -> None:
    """Send a module's worker functions by value, so executors that cannot
    import the package still run them."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write an intermediate that several jobs read, and read it back. It lies
    in the shared checkpoint folder, so it outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filter_rows(docs: DataFrame, run) -> DataFrame:
    """``docs`` filtered by a function over Arrow batches of all its columns (by
    position, so that any column names go)."""
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return inner.mapInArrow(run, inner.schema).toDF(*docs.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies (the default of every path parameter)."""
    import public_tokenizers
    return public_tokenizers.path(name)


# --- spans of pattern matches, JVM-side -----------------------------------

_BLOCK = 64


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row (a lambda variable;
    a column used twice in higher-order functions is otherwise computed anew
    for each use and element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """Sums of the elements before each element of a non-empty array. Blocks of
    64 keep the work near-linear: block sums are accumulated once, and each
    element adds the rest of its own block."""
    n_blocks = F.ceil(F.size(lengths) / F.lit(_BLOCK)).cast("int")
    sums = F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda b: F.aggregate(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0),
                              lambda s, x: s + x))
    starts = F.aggregate(
        sums, F.array(F.lit(0)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return let(starts, lambda st: F.transform(
        F.sequence(F.lit(0), F.size(lengths) - 1),
        lambda i: F.element_at(st, F.floor(i / F.lit(_BLOCK)).cast("int") + 1)
        + F.aggregate(F.slice(lengths, i - F.pmod(i, F.lit(_BLOCK)) + 1,
                              F.pmod(i, F.lit(_BLOCK))),
                      F.lit(0), lambda s, x: s + x)))


def match_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a Java pattern, as an array of
    ``(start, end, value)`` in code points, end exclusive. Null text: empty.
    The pattern must not match the empty string."""
    none = F.expr("array()").cast("array<struct<start:int,end:int,value:string>>")

    def spans(found):
        gaps = F.split(text, pattern, -1)
        lengths = F.flatten(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                                       lambda g, m: F.array(F.length(g), F.length(m))))
        return let(lengths, lambda ls: let(_running(ls), lambda at: F.transform(
            found, lambda m, i: F.struct(
                F.element_at(at, i * 2 + 2).alias("start"),
                (F.element_at(at, i * 2 + 2) + F.length(m)).alias("end"),
                m.alias("value")))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.coalesce(F.size(found), F.lit(0)) <= 0, none).otherwise(spans(found)))


# --- words ----------------------------------------------------------------

# The white space that separates words: blank and the controls 9 to 13.
WHITE = " \t\n\x0b\x0c\r"


def byte_words(text: str | None) -> list[bytes]:
    """UTF-8 words between runs of :data:`WHITE` (the split of ``bytes``)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


_NAME = re.compile(r"\w+")


def plain_words(text: str | None) -> list[str]:
    """Lower-case letter/digit runs."""
    return _NAME.findall((text or "").lower())
