"""Token totals by source, language and tokenizer version, maintained from deltas.

A batch is a set of signed rows: +1 for a document that came, -1 for one that went, both
for one whose text or count was revised; equal rows may come as one with the sum of their
signs. Its deltas are the signed sums of documents and
tokens per group, and they are written as the batch's own partition of the rollup, which
a repeated commit of the batch replaces as a whole (dynamic partition overwrite). Totals
are the sum over all batches; a batch may be committed again after any failure, in any
order, without counting twice. ``commit`` has the signature of a streaming
``foreachBatch`` function.

Defined results: a null text has no tokens but counts as a document; null sources and
languages are groups of their own; repeated rows count each; an empty batch replaces
what an earlier attempt of it wrote; groups whose documents and tokens are back at zero
are left out of the totals. Extra columns are ignored.
"""

from __future__ import annotations

import base64

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from shelfmark.llm.common import WORD, ship_package

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split that the rank file's vocabulary was made with.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose token count a task remembers.
REMEMBERED = 200_000

GROUP = ("source", "lang", "tokenizer")


def word_tokens(text: Column) -> Column:
    """Tokenizer version ``words-1``: runs of anything but white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def bpe_tokens(spark: SparkSession, ranks: str = RANKS):
    """Tokenizer version ``bpe50k-1``: byte-pair tokens of the vocabulary in ``ranks``.

    The driver reads the file and sends it along, so executors need no copy. A text is
    split as the vocabulary demands; each distinct piece is encoded once per task.
    """
    ship_package(spark)
    with open(ranks, "rb") as lines:
        shared = spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
    state: dict = {}

    def count(texts: pd.Series) -> pd.Series:
        if not state:
            state["encoding"] = tiktoken.Encoding("bpe50k", pat_str=SPLIT, mergeable_ranks=shared.value, special_tokens={})
            state["split"] = regex.compile(SPLIT)
        encode, split, known = state["encoding"].encode_ordinary, state["split"], state.setdefault("known", {})
        out = []
        for text in texts:
            total = 0
            for piece in split.findall(text) if text else ():
                size = known.get(piece)
                if size is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    size = known[piece] = len(encode(piece))
                total += size
            out.append(total)
        return pd.Series(out, dtype="int64")

    return F.pandas_udf(count, LongType())


def tokenizers(spark: SparkSession, ranks: str = RANKS) -> dict:
    """Column functions of all tokenizer versions."""
    return {"words-1": word_tokens, "bpe50k-1": bpe_tokens(spark, ranks)}


def counted(docs: DataFrame, versions: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens``, a map from tokenizer version to count, instead of the text."""
    entries = [part for name, count in versions.items() for part in (F.lit(name), count(F.col(text).cast("string")))]
    return docs.withColumn("tokens", F.create_map(*entries)).drop(text)


def deltas(signed: DataFrame) -> DataFrame:
    """Signed sums per group of rows with ``source``, ``lang``, ``tokens`` and ``sign``."""
    rows = signed.select("source", "lang", "sign", F.explode("tokens").alias("tokenizer", "count"))
    return rows.groupBy(*GROUP).agg(F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("count")).alias("tokens"))


def commit(signed: DataFrame, batch_id: int, path: str) -> None:
    """Write the deltas of one batch to the rollup at ``path``, in place of an earlier try."""
    spark = signed.sparkSession
    # a row without a tokenizer stands for the batch itself, so an empty one replaces too
    mark = spark.range(1).select(
        *[F.lit(None).cast("string").alias(c) for c in GROUP],
        F.lit(0).cast("long").alias("docs"),
        F.lit(0).cast("long").alias("tokens"),
    )
    rows = deltas(signed).select(*[F.col(c).cast("string").alias(c) for c in GROUP], F.col("docs").cast("long"), F.col("tokens").cast("long"))
    (
        rows.union(mark)
        .withColumn("batch_id", F.lit(int(batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``source``, ``lang``, ``tokenizer``, ``docs``, ``tokens`` over all committed batches."""
    rolled = spark.read.parquet(path).where("tokenizer IS NOT NULL").groupBy(*GROUP)
    summed = rolled.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return summed.where("docs <> 0 OR tokens <> 0")
