"""Naive Bayes over words, with smoothed weights; scores in the log domain, so long texts do not underflow."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def features(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Distinct small-letter words of more than two characters per document."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z0-9_]{3,})"), 1))
    return docs.select(id_col, F.explode(words).alias("feature"))


def train(feats: DataFrame, labels: DataFrame, id_col: str, category: str) -> tuple[DataFrame, DataFrame]:
    """(category, feature, n) and (category, n): in how many documents of a category a word occurs, and how many it has."""
    by_feature = feats.join(labels.select(id_col, category), id_col).groupBy(category, "feature").agg(F.count(F.lit(1)).alias("n"))
    return by_feature, labels.groupBy(category).agg(F.count(F.lit(1)).alias("n"))


def recent(labels: DataFrame, order: str, memory: int = 1000) -> DataFrame:
    """The labelled rows that a bounded memory still has: the last so many."""
    return labels.orderBy(F.col(order).desc()).limit(memory)


def weights(by_feature: DataFrame, by_category: DataFrame, category: str, context: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(feature, base), (category, feature, more) and (category, prior), each within its context.

    A word weighs (0.5 + total * p) / (1 + total), where total counts it over all categories and p is its share among the category's documents. In all
    categories that do not have it that is the same, its base; the others have more. So a score is the prior and the bases of the document's words, which all categories
    share, and what the category has more: categories stay rows, and only those that know a word meet it."""
    total = by_feature.groupBy(*context, "feature").agg(F.sum("n").alias("total"))
    base = total.select(*context, "feature", F.log(0.5 / (1.0 + F.col("total"))).alias("base"))
    size = by_category.select(*context, category, F.col("n").alias("_docs"))
    more = by_feature.join(total, [*context, "feature"]).join(size, [*context, category]).select(*context, category, "feature", F.log1p(2.0 * F.col("total") * F.col("n") / F.col("_docs")).alias("more"))
    all_ = by_category.groupBy(*context).agg(F.sum("n").alias("_all"))
    return base, more, by_category.join(all_, context).select(*context, category, F.log(F.col("n") / F.col("_all")).alias("prior"))


def classify(feats: DataFrame, model: tuple[DataFrame, DataFrame], id_col: str, category: str, ids: DataFrame) -> DataFrame:
    """All categories of each document with log score, (id, category, score): a row for each pair, so this is for few categories; ``best_of`` is not. Unknown words weigh the same for all."""
    by_feature, by_category = model
    sizes = [(r[category], r["n"]) for r in by_category.where(F.col(category).isNotNull()).select(category, "n").collect()]
    every, own = sum(n for _, n in sizes), [F.sum(F.when(F.col(category) == c, F.col("n"))).alias(f"_n{k}") for k, (c, _) in enumerate(sizes)]
    of_word = by_feature.groupBy("feature").agg(F.sum("n").alias("total"), *own)  # the categories side by side, so that each word of a document is met once
    more = [F.log1p(2.0 * F.col("total") * F.col(f"_n{k}") / n).alias(f"_m{k}") for k, (_, n) in enumerate(sizes)]
    weight = of_word.select("feature", F.log(0.5 / (1.0 + F.col("total"))).alias("base"), *more)
    sums = feats.join(weight, "feature").groupBy(id_col).agg(*[F.sum(c).alias(c) for c in weight.columns[1:]])
    kind = dict(by_category.dtypes)[category]
    scores = [F.struct(F.lit(c).cast(kind).alias(category), (F.lit(math.log(n / every)) + F.coalesce("base", F.lit(0.0)) + F.coalesce(f"_m{k}", F.lit(0.0))).alias("score")) for k, (c, n) in enumerate(sizes)]
    none = F.expr(f"cast(array() as array<struct<`{category}`:{kind},score:double>>)")
    return ids.select(id_col).join(sums, id_col, "left").select(id_col, F.inline(F.array(*scores) if scores else none))


NONE = "NONE"


def train_contexts(feats: DataFrame, labels: DataFrame, id_col: str, context: str = "context", category: str = "category") -> tuple[DataFrame, DataFrame]:
    """The counts of several classifiers at once, from labels (id, context, category). As each must be able to say that nothing fits, contexts without documents of category ``NONE`` are left out."""
    kept = labels.groupBy(context).agg(F.max(F.col(category) == NONE).alias("_none"), F.count_distinct(category).alias("_n")).where("_none and _n > 1").select(context)
    labels = labels.join(kept, context, "left_semi")
    by_feature = feats.join(labels.select(id_col, context, category), id_col).groupBy(context, category, "feature").agg(F.count(F.lit(1)).alias("n"))
    return by_feature, labels.groupBy(context, category).agg(F.count(F.lit(1)).alias("n"))


def best_of(feats: DataFrame, model: tuple[DataFrame, DataFrame], id_col: str, ids: DataFrame, context: str = "context", category: str = "category") -> DataFrame:
    """(id, context, category, score): in each context the category of largest score, ties to the lesser one.

    What a category has more than the base is never less than nothing. So the best one is among those that know a word of the document and the
    one of largest prior; no document meets all categories, however many there are."""
    base, more, prior = weights(*model, category, [context])
    usual = prior.groupBy(context).agg(F.min_by(category, F.struct(-F.col("prior"), F.col(category))).alias(category), F.max("prior").alias("prior"))
    # bases and more in one list, of which the bases have no category, so that the words of the documents are found and joined once
    each = base.select("feature", context, F.lit(None).cast(dict(prior.dtypes)[category]).alias(category), "base", F.lit(None).cast("double").alias("more")).unionByName(more.withColumn("base", F.lit(None).cast("double")))
    known = feats.join(each, "feature").groupBy(id_col, context, category).agg(F.sum("base").alias("base"), F.sum("more").alias("more")).join(prior, [context, category], "left")
    contexts = [r[context] for r in usual.select(context).collect()]  # classifiers, a row of the result for each of them and document
    every = ids.select(id_col, F.explode(F.array(*map(F.lit, contexts)) if contexts else F.expr("cast(array() as array<string>)")).alias(context)).join(F.broadcast(usual), context)
    some = every.select(id_col, context, category, "prior", F.lit(None).cast("double").alias("base"), F.lit(0.0).alias("more")).unionByName(known.select(id_col, context, category, "prior", "base", "more"))
    s = F.col("prior") + F.col("more")  # sums differ in the last digits by the order of adding, which must not decide; null for the bases, which are no candidates
    top = some.groupBy(id_col, context).agg(F.min_by(F.struct(category, s.alias("s")), F.when(s.isNotNull(), F.struct(-F.round(s, 9), F.col(category)))).alias("_b"), F.sum("base").alias("base"))
    return top.where("_b is not null").select(id_col, context, F.col(f"_b.{category}").alias(category), (F.col("_b.s") + F.coalesce("base", F.lit(0.0))).alias("score"))


def best(classified: DataFrame, id_col: str, category: str) -> DataFrame:
    """The category of largest score; ties go to the lesser one."""
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), category)
    return classified.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
