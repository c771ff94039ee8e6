"""URL filter rules by a sort-merge range join.

The host of a URL or rule is written backwards by labels, each closed by a dot:
``www.example.com`` is ``com.example.www.``. The subdomains of a rule's host are then
exactly the keys that start with the rule's key, one interval, and intervals of rules
nest or are disjoint. URLs are range-partitioned by key; a rule travels to the ranges
its interval meets; in each range one sorted sweep over rules and URLs keeps the stack of
rules whose interval holds the current key, and a URL takes the longest rule of the
stack whose path its own path starts with.

Defined results: a null URL or one without ``://`` has empty host and path and matches no
rule unless a rule's host is empty; rules with a null host or path are ignored; equal
rules (host and path) count once, ``block`` before ``allow``; of fitting rules the one
with the most characters wins, of equally long ones that with the longer host; repeated
rows are judged alike. Without rules every URL gets the default verdict. Extra columns
are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import base_lower, settle, ship_package

DEFAULT = "allow"


def url_host(url: Column) -> Column:
    return F.coalesce(base_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _ranges(edges):
    """The ranges (low key, high key, number) that a rule's interval meets."""
    low, high, number = [e[0] for e in edges], [e[1] for e in edges], [e[2] for e in edges]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rules in batches:
            spans = [
                range(bisect_left(high, k), bisect_right(low, k + chr(0x10FFFF).encode())) for k in map(bytes, rules["key"])
            ]
            out = rules.loc[rules.index.repeat([len(s) for s in spans])].copy()
            out["range"] = [number[i] for s in spans for i in s]
            yield out

    return run


def _sweep(default: str):
    columns = ["id", "host", "path", "rule", "verdict"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple] = []
        at = None
        for batch in batches:
            rows = []
            for part, key, kind, ident, host, path, verdict in zip(
                *(batch[c] for c in ("range", "key", "kind", "id", "host", "path", "verdict"))
            ):
                if part != at:
                    stack, at = [], part
                key = bytes(key)
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, host, path, verdict))
                    continue
                best = None
                for _, rule_host, rule_path, says in stack:
                    if path.startswith(rule_path):
                        size = (len(rule_host) + len(rule_path), len(rule_host))
                        if best is None or size > best[0]:
                            best = size, rule_host + rule_path, says
                rows.append((ident, host, path, best[1] if best else None, best[2] if best else default))
            yield pd.DataFrame(rows, columns=columns)

    return run


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (host and path, else null), ``verdict``.

    ``rules``: ``host``, ``path``, ``verdict``. Ranges split by (key, path), so a host
    with a third of all URLs is many ranges. The driver sees two keys per range.
    """
    spark = pages.sparkSession
    ship_package(spark)
    id_type = dict(pages.dtypes)[page_id]
    split = pages.select(F.col(page_id).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    keyed = split.withColumn("key", host_key(F.col("host")).cast("binary")).withColumn("spread", F.monotonically_increasing_id())
    urls = settle(
        keyed.repartitionByRange("key", "path", "spread").withColumn("range", F.spark_partition_id()).drop("spread"), "urls"
    )
    edges = urls.groupBy("range").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("low", "high", "range").collect()
    edges = [(bytes(e.low), bytes(e.high), e.range) for e in edges]
    known = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .select(base_lower(F.col("host")).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", host_key(F.col("host")).cast("binary"))
    )
    placed = known.mapInPandas(_ranges(edges), "host string, path string, verdict string, key binary, range int")
    both = urls.select("range", "key", F.lit(1).alias("kind"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    both = both.unionByName(
        placed.select("range", "key", F.lit(0).alias("kind"), F.lit(None).cast(id_type).alias("id"), "host", "path", "verdict")
    )
    swept = (
        both.repartition("range")
        .sortWithinPartitions("range", "key", "kind", "path")
        .mapInPandas(_sweep(default), f"id {id_type}, host string, path string, rule string, verdict string")
    )
    return swept.withColumnRenamed("id", page_id)
