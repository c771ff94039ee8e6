"""Mixing sources to target weights: hash order, prefix sums, a cut at the budget.

Documents of a source stand in the order of a hash of their id. Whole epochs are taken
as often as the source's target holds its size; of one more epoch, documents are taken
in hash order until the rest is spent, the last of them up to the exact word. The order
is found by a range sort over (source, hash): each range knows its own running sums, and
the sums of the ranges before it are added. Only one row per range and source is ever
ordered as a whole, so a source with a third of all rows is as many ranges as its rows
fill.

Defined results: a null text has size 0; a null source is a source of its own and comes
last; null ids stand in a source like others; repeated rows each count and the cut takes
the one or the other; sizes of zero take nothing; without documents there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import free_names, settle, WORD

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source`` and ``source_size``.

    Sources by code point, null last, take the weights in turn. All targets are the
    same multiple of their weight, except those that stop at ``max_epochs`` times the
    size: sorted by cap over weight these come first, and the multiple is what is left
    over the weight that is left. One row per source is ordered as a whole.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", (F.col("source_size") * max_epochs).cast("long"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("per_weight", F.col("left") / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))))
        .withColumn("open", F.col("cap") > F.col("per_weight") * F.col("weight"))
    )
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("per_weight"))))
    ranked = ranked.withColumn("level", level.over(whole)["per_weight"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    )
    return ranked.select("source", "source_size", target.alias("target"))


def hash_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    row: str | None = None,
) -> DataFrame:
    """What the mix takes of every row of ``docs``.

    ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` (words,
    repeats counted), ``epochs`` (whole repeats) and ``part`` (words of one more,
    from the start of the text). ``row`` names a column that is unique per row and is
    carried along.
    """
    extra = [F.col(row).alias("row")] if row else []
    sized = settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text).cast("string")).alias("size"),
            hash_key(F.col(doc_id), seed).alias("key"),
            *extra,
        ),
        "sizes",
    )
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    # ranges: even in rows whatever the sources' sizes; repeated ids are told apart by a spread
    ranged = settle(
        sized.withColumn("spread", F.monotonically_increasing_id())
        .repartitionByRange("source", "key", "doc_id", "spread")
        .withColumn("range", F.spark_partition_id()),
        "ranges",
    )
    per_range = ranged.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_range.select("source", "range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("base"))
    plan = (
        bases.join(targets, bases.source.eqNullSafe(targets.source))
        .select(bases.source, "range", "base", "source_size", "target")
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
        .select(F.col("source").alias("of"), F.col("range").alias("at"), "base", "source_size", "target", "epochs", "rest")
    )
    running = Window.partitionBy("range", "source").orderBy("key", "doc_id", "spread").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("within", F.coalesce(F.sum("size").over(running), F.lit(0)))
    joined = summed.join(plan, (F.col("range") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("base") - F.col("within")))
    return joined.withColumn("part", part.cast("long")).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
        "epochs",
        "part",
        *(["row"] if row else []),
    )


def mixed_texts(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as taken, with ``epoch`` from 1.

    A document taken in part has its first words up to the cut. ``epoch`` and ``taken``
    (words of this repeat) replace columns of those names, in any case.
    """
    name, epochs, cut, size = free_names(docs, "__row", "__epochs", "__part", "__size")
    rows = settle(docs.withColumn(name, F.monotonically_increasing_id()), "mixed")
    plan = mix(rows, text=text, row=name, **options).where("taken > 0")
    plan = plan.select(F.col("row").alias(name), F.col("epochs").alias(epochs), F.col("part").alias(cut), F.col("size").alias(size))
    replaced = {"epoch", "taken"}
    kept = [c for c in docs.columns if c.lower() not in replaced]
    repeats = F.col(epochs) + F.when(F.col(cut) > 0, 1).otherwise(0)
    joined = rows.drop(*[c for c in docs.columns if c.lower() in replaced]).join(plan, name)
    joined = joined.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), repeats)))
    partial = F.col("epoch") > F.col(epochs)
    words = F.regexp_extract_all(F.col(text), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    shown = F.when(partial & (F.col(cut) < F.col(size)), F.array_join(F.slice(words, F.lit(1), F.col(cut).cast("int")), "")).otherwise(F.col(text))
    taken = F.when(partial, F.col(cut)).otherwise(F.col(size))
    return joined.select(*[F.col(f"`{c}`") for c in kept if c != text], shown.alias(text), "epoch", taken.alias("taken"))
