"""Benchmark decontamination by Wu-Manber search over words.

A window is a run of ``WINDOW`` consecutive words of a benchmark item (all its words if
it has fewer). Windows of one length m form one pattern set with two tables: ``shift``
says for a block of two words how far the search may skip when the block ends at the
current word, and ``bucket`` lists for the last block of a window the windows to test.
The search looks at one block of the document at a time: a block in no window skips
m - 1 words, one that ends a window is compared word by word. Documents stay where they
are; only the windows travel, in chunks of at most ``CHUNK`` words, so what is broadcast
has a bound whatever the size of the benchmark.

Defined results: null and empty texts have no words and no hit; an item without words
has no window; items that share a window all count; a repeated item id counts once, a
null item id marks hits but is not listed; repeated documents give repeated rows. Other
columns of the documents are kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shelfmark.llm.common import settle, ship_package

WINDOW = 10
#: Words of benchmark texts in one broadcast.
CHUNK = 100_000

SHAPE = StructType(
    [
        StructField("n_words", LongType()),
        StructField("spans", ArrayType(LongType())),
        StructField("items", ArrayType(StringType())),
    ]
)

#: Bytes of words (0-9, a-z and all of non-ASCII characters) as they are, A-Z to a-z,
#: everything else to a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class PatternSet:
    """Tables for all windows of one length."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]], length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                key = window[end - 2 : end] if self.block == 2 else window[end - 1]
                self.shift[key] = min(self.shift.get(key, length), length - end)
            self.bucket[key].append((list(window), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start of every occurrence and the items that have the window."""
        length, shift, bucket = self.length, self.shift, self.bucket
        at, n, skip = length - 1, len(words), length - self.block + 1
        while at < n:
            key = (words[at - 1], words[at]) if self.block == 2 else words[at]
            move = shift.get(key, skip)
            if move:
                at += move
                continue
            start = at - length + 1
            for window, items in bucket[key]:
                if words[start : at + 1] == window:
                    yield start, items
            at += 1


def pattern_sets(items: list[tuple[str | None, str | None]], window: int) -> list[PatternSet]:
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[start : start + size])].add(item)
    return [PatternSet(windows, size) for size, windows in sorted(by_length.items())]


def _searcher(shared, window: int):
    """Column function that adds one chunk's hits to those found so far."""
    tables: list[PatternSet] = []

    def search(texts: pd.Series, old_spans: pd.Series, old_items: pd.Series) -> pd.DataFrame:
        if not tables:
            tables.extend(pattern_sets(shared.value, window))
        rows = []
        for text, spans, names in zip(texts, old_spans, old_items):
            words = words_of(text)
            hit: dict[int, int] = {}
            items = set(names)
            for patterns in tables:
                for start, owners in patterns.search(words):
                    hit[start] = max(hit.get(start, 0), start + patterns.length)
                    items.update(x for x in owners if x is not None)
            merged: list[int] = []
            for a, b in sorted([*hit.items(), *zip(spans[::2], spans[1::2])]):
                if merged and a <= merged[-1]:
                    merged[-1] = max(merged[-1], b)
                else:
                    merged += [int(a), int(b)]
            rows.append((len(words), merged, sorted(items)))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return F.pandas_udf(search, SHAPE)


def with_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    found: str = "found",
    chunk: int = CHUNK,
) -> DataFrame:
    """``docs`` with the struct column ``found`` in place of any column of that name.

    ``n_words``; ``spans``: word offsets from, to (exclusive) of the maximal hit runs,
    one after the other; ``items``: sorted ids, as strings, of the items that occur. A
    benchmark of several chunks takes a pass over the documents for each.
    """
    spark = docs.sparkSession
    ship_package(spark)
    items = settle(
        benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
        .where("text IS NOT NULL")
        .distinct()
        .withColumn("size", F.length("text")),
        "items",
    )
    total = items.agg(F.sum("size")).first()[0] or 0
    chunks = -(-total // (4 * chunk)) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(chunks))
    out = docs.withColumn(
        found, F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    )
    for number in range(chunks):
        rows = items.where(part == number).select("item", "text").collect()
        shared = spark.sparkContext.broadcast([(r.item, r.text) for r in rows])
        search = _searcher(shared, window)
        out = out.withColumn(found, search(F.col(text).cast("string"), F.col(f"{found}.spans"), F.col(f"{found}.items")))
        if number + 1 < chunks:
            out = settle(out, "searched")
    return out


def n_hit(spans: Column) -> Column:
    """Words inside the spans: the ends less the starts."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)


def contamination_report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    marked = with_contamination(docs.select(doc_id, F.col(options.get("text", "text"))), benchmark, **options)
    spans = F.col("found.spans")
    return marked.select(
        doc_id,
        F.col("found.n_words").alias("n_words"),
        n_hit(spans).alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )
