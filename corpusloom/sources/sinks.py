"""Where documents go: a corpus as parquet by source, JSON copies, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.incremental import upsert


def write_corpus(docs: DataFrame, path: str, by: str = "source", key: str = "doc_id") -> None:
    """The corpus, partitioned by source and sorted by key inside the files; a hot source is spread over salted tasks."""
    salted = docs.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(32)))
    salted.repartition(by, "_salt").sortWithinPartitions(by, key).drop("_salt").write.mode("overwrite").partitionBy(by).parquet(path)


def upsert_corpus(new: DataFrame, path: str, target: str, key: str = "doc_id", replace: bool = True) -> None:
    """The corpus at `path` with new rows put in, written to `target` (a corpus is never rewritten in place)."""
    upsert(new.sparkSession.read.parquet(path), new, key, replace).write.mode("overwrite").parquet(target)


def write_copies(docs: DataFrame, path: str) -> None:
    """One JSON line a document."""
    docs.write.mode("overwrite").option("compression", "gzip").json(path)


def write_report(urls: DataFrame, path: str) -> None:
    """A sorted list of URLs."""
    urls.select("url").distinct().orderBy("url").write.mode("overwrite").text(path)
