"""Ratings shrunk by their number of reviews (empirical Bayes).

Ratings vary within a category (variance ``within``) and the categories' means vary around the global
mean (variance ``between``); both are estimated from the table by the usual analysis of variance.  A
mean of ``n`` ratings is then believed with weight ``n * between / (n * between + within)``, that is a prior
as strong as ``within / between`` reviews:

* a category's prior mean is its mean rating drawn to the global mean, ``n`` its rated products;
* a product's rating is drawn to its category's prior mean, ``n`` its reviews.

Products without a category are drawn to the global mean; a rating without a review count counts as
``unknown`` reviews; a product without a rating stays without.  No variance between categories: all
ratings become the prior mean; none at all: they stay as they are.  The statistics are one row per
category; only four numbers come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simcat.functions import parsers as P
from simcat.operators import normalise as N
from simcat.operators.search import PRODUCT_RANK, RankSpec


@dataclass(frozen=True)
class Prior:
    mean: float
    within: float
    between: float

    @property
    def strength(self) -> float:
        """Reviews that the prior is worth."""
        return float("inf") if self.between == 0 else self.within / self.between


def review_counts(raw: DataFrame, reviews: str = "no__of_reviews", id_col: str = "uniq_id") -> DataFrame:
    """(product_id, reviews) of the first record per id, as cleaning keeps them."""
    rows = raw.select(P.strip(F.col(id_col)).alias("product_id"), P.review_count(reviews).alias("reviews"), "src_seq")
    return N.dedup_first(N.filter_valid_id(rows)).select("product_id", "reviews")


def category_means(products: DataFrame, category: str = "child_category", rating: str = "rating") -> DataFrame:
    """(category, n, mean, squares within) of the rated products."""
    r = F.col(rating)
    return (products.where(r.isNotNull()).groupBy(F.col(category).alias("category"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(r).alias("mean"),
                 (F.var_pop(r) * F.count(F.lit(1))).alias("squares")))


def fit(means: DataFrame) -> Prior:
    """Variances from the category means; products without a category count for the global mean only."""
    known = F.col("category").isNotNull()
    only = lambda x: F.sum(F.when(known, x))
    n, mean = F.col("n"), F.col("mean")
    r = means.agg((F.sum(n * mean) / F.sum(n)).alias("mean"), only(n).alias("n"), F.count_if(known).alias("k"),
                  only(F.col("squares")).alias("squares"), only(n * n).alias("n2"), only(n * mean).alias("s1"),
                  only(n * mean * mean).alias("s2")).first()
    if r["mean"] is None:
        return Prior(0.0, 0.0, 0.0)
    total, k = r["n"] or 0, r["k"]
    within = r["squares"] / (total - k) if total > k else 0.0
    spread = r["s2"] - r["s1"] ** 2 / total if total else 0.0
    share = total - r["n2"] / total if total else 0.0
    between = max(0.0, (spread - (k - 1) * within) / share) if share > 0 else 0.0
    return Prior(float(r["mean"]), float(within), float(between))


def _weight(n: Column, prior: Prior) -> Column:
    if prior.within == 0 and prior.between == 0:
        return F.lit(1.0)
    return n * F.lit(prior.between) / (n * F.lit(prior.between) + F.lit(prior.within))


def shrink(products: DataFrame, reviews: DataFrame, unknown: float = 1.0, category: str = "child_category",
           rating: str = "rating", places: int = 6) -> tuple[DataFrame, Prior]:
    """``products`` with ``reviews``, ``prior_mean`` and ``rating_shrunk``; and the fitted prior."""
    means = category_means(products, category, rating)
    prior = fit(means)
    w = _weight(F.col("n"), prior)
    centre = (means.where(F.col("category").isNotNull())
              .select(F.col("category").alias(category),
                      (w * F.col("mean") + (1 - w) * F.lit(prior.mean)).alias("prior_mean")))
    known = products.join(reviews.select("product_id", "reviews"), "product_id", "left").join(centre, category, "left")
    centred = known.withColumn("prior_mean", F.coalesce("prior_mean", F.lit(prior.mean)))
    # no reviews at all is no evidence: n is 0, and only the prior speaks
    n = F.coalesce(F.col("reviews"), F.lit(float(unknown)))
    v = _weight(n, prior)
    value = F.round(v * F.col(rating) + (1 - v) * F.col("prior_mean"), places)
    return centred.withColumn("rating_shrunk", F.when(F.col(rating).isNotNull(), value)), prior


# Ranking order with the shrunk rating in the place of the rating.
SHRUNK_RANK: RankSpec = replace(PRODUCT_RANK, tiebreak=(("rating_shrunk", "desc", -1.0),
                                                        ("sales_price", "asc", float("inf"))))
