"""Mixing sources to target weights: budgets down a domain / language / source tree, token prefixes of seeded epochs.

A node's budget goes to its children by weight. A child takes no more than its capacity (``epochs`` times its tokens);
what it cannot take goes to its siblings by weight, and only what a whole family cannot take goes up to the siblings of
its parent. With B the budget of a family, the level L at which the children's ``min(capacity, L * weight)`` add up to B
is the largest of ``(B - capacity of the children before) / (weight of the others)`` over the children in order of
capacity per weight, so a family is one running sum.

A leaf takes whole epochs and then the longest prefix, in the next epoch's seeded order, that fits the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from modelmon.llm.common import fixed, unpack, words

# Production parameters: weights by name (others: OTHER_WEIGHT), the budget as a share of all tokens, epochs, seed.
DOMAIN_WEIGHTS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANGUAGE_WEIGHTS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}
SOURCE_WEIGHTS: dict[str, float] = {}
OTHER_WEIGHT = 1.0
SHARE = 0.8
EPOCHS = 2
SEED = 42
LEVELS = ("domain", "language", "leaf")
# Hexadecimal digits of the order key that make a bucket: a leaf is dealt over 4,096 of them.
BUCKET_DIGITS = 3


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def domain_of(source: Column) -> Column:
    """The domain of a source: its trailing number modulo 4; sources without one are a domain of their own."""
    number = F.regexp_extract(source, "([0-9]+)$", 1)
    return F.when(number == "", F.lit("other")).otherwise(F.concat(F.lit("d"), (F.substring(number, -6, 6).cast("int") % 4).cast("string")))


def _weight(name: Column, weights: dict[str, float]) -> Column:
    out = F.lit(OTHER_WEIGHT)
    for key, value in weights.items():
        out = F.when(name == key, F.lit(value)).otherwise(out)
    return out


def _spread(children: DataFrame, family: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to children (family..., name, capacity, weight, family_budget)."""
    order = W.partitionBy(*(family or [F.lit(0)])).orderBy(F.col("capacity") / F.col("weight"), name)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("family_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    whole_family = W.partitionBy(*(family or [F.lit(0)]))
    return children.withColumn("level", level).withColumn("level", F.max("level").over(whole_family)).withColumn(
        "budget", F.greatest(F.lit(0.0), F.least(F.col("capacity"), F.col("level") * F.col("weight")))
    ).drop("level")


def budgets(leaves: DataFrame, share: float, epochs: int) -> DataFrame:
    """(domain, language, leaf, tokens, budget): the tokens each leaf gives, from leaves (domain, language, leaf, tokens)."""
    capacity = (F.col("tokens") * epochs).cast("double")
    sized = leaves.withColumn("capacity", capacity)
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * share).cast("double")).first()[0]
    out = None
    for depth, (level, weights) in enumerate(zip(LEVELS, (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, SOURCE_WEIGHTS))):
        family = list(LEVELS[:depth])
        nodes = sized.groupBy(*family, level).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(F.col(level), weights))
        if out is None:
            nodes = nodes.withColumn("family_budget", F.lit(total))
        else:
            nodes = nodes.join(out.select(*family, F.col("budget").alias("family_budget")), family)
        out = _spread(nodes, family, level)
    return out.join(leaves, list(LEVELS)).select(*LEVELS, "tokens", F.floor("budget").cast("long").alias("budget"))


def _keyed(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return rows.join(plan, list(LEVELS)).withColumn("key", key).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))


def _ends(rows: DataFrame, share: float, epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Per leaf: its whole epochs and rest; and the bucket in which the prefix of the next epoch ends, with what is left for it."""
    leaf = list(LEVELS)
    leaves = fixed(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = fixed(
        budgets(leaves, share, epochs).select(
            *leaf,
            F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long").alias("full"),
            F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).cast("long").alias("rest"),
        ),
        "plan",
    )
    # Sums per bucket are combined before the shuffle; a leaf has 4,096 buckets at most.
    sums = _keyed(rows, plan, seed).groupBy(*leaf, "bucket", "rest").agg(F.sum("n_tokens").alias("n"))
    running = F.sum("n").over(W.partitionBy(*leaf).orderBy("bucket"))
    ends = (
        sums.withColumn("upto", running)
        .where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        .groupBy(*leaf).agg(F.min(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))).alias("end"))
        .select(*leaf, F.col("end.bucket").alias("end_bucket"), F.col("end.left").alias("left"))
    )
    return plan, fixed(ends, "ends")


def _copies(rows: DataFrame, plan: DataFrame, ends: DataFrame, seed: int) -> DataFrame:
    """Adds ``copies`` to rows (domain, language, leaf, n_tokens, doc_id, ...). Only rows of the end buckets are put in order."""
    leaf = list(LEVELS)
    placed = _keyed(rows, plan, seed).join(ends, leaf, "left")
    order = W.partitionBy(*leaf, "bucket").orderBy("key", "n_tokens")
    inside = placed.where(F.col("bucket") == F.col("end_bucket")).withColumn(
        "more", (F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, 0)) <= F.col("left")).cast("long")
    )
    # A leaf without tokens has no end bucket.
    outside = placed.where(F.col("end_bucket").isNull() | (F.col("bucket") != F.col("end_bucket"))).withColumn(
        "more", (F.col("end_bucket").isNull() | (F.col("bucket") < F.col("end_bucket"))).cast("long")
    )
    copies = F.when(F.col("n_tokens") > 0, F.col("full") + F.when(F.col("rest") > 0, F.col("more")).otherwise(0)).otherwise(0)
    return outside.unionByName(inside).withColumn("copies", copies.cast("long")).drop(
        "full", "rest", "key", "bucket", "end_bucket", "left", "more"
    )


def _counted(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, domain, language, leaf, n_tokens, more...) of documents."""
    return docs.select(
        "doc_id", domain_of(_name("source")).alias("domain"), _name("lang").alias("language"), _name("source").alias("leaf"),
        F.size(words(F.col("text"))).cast("long").alias("n_tokens"), *more,
    )


def mixture(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, domain, language, leaf, n_tokens, copies) for every row of ``docs`` (doc_id, text, lang, source).

    Tokens are words. ``copies`` says how often the mixture holds the document (0: not at all). Documents without a word
    are never taken. Null sources and languages are leaves of their own. Equal doc_ids are ordered by length; an empty
    table gives an empty one; further columns are ignored.
    """
    rows = fixed(_counted(docs), "mixture")
    return _copies(rows, *_ends(rows, share, epochs, seed), seed).select("doc_id", *LEVELS, "n_tokens", "copies")


def take(docs: DataFrame, share: float = SHARE, epochs: int = 1, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` in the mixture, with their own columns; a row taken in several epochs comes that often.

    Budgets and prefix ends come from counts alone; then each row is judged where it is read, and only rows of the end
    buckets (one of 4,096 per leaf) move with their texts.
    """
    plan, ends = _ends(fixed(_counted(docs), "mixture"), share, epochs, seed)
    rows = _counted(docs, F.struct(*[docs[c] for c in docs.columns]).alias("d"))
    chosen = _copies(rows, plan, ends, seed).where("copies > 0")
    return unpack(chosen.select("d", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")), docs.columns)
