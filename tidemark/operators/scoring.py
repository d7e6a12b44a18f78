"""Fraud scoring: features, a logistic model with two thresholds, and its evaluation, all inside the plan."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import banding, exact_ratio
from ..sources.tables import Files

REVIEW_QUANTILE, DECLINE_QUANTILE = 0.90, 0.99
NUMERIC = ("log_amt", "distance", "hour")


def features(df: DataFrame) -> DataFrame:
    """log_amt, distance, hour and category of events or transactions; whatever is missing gets its default."""
    have = set(df.columns)
    col = lambda name, kind: F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
    times = [F.col(c).try_cast("timestamp_ntz") for c in ("event_ts", "trans_time") if c in have]
    hour = F.coalesce(col("trans_hour", "int"), *(F.hour(t) for t in times), F.lit(0))
    amt = F.nanvl(col("amt", "double"), F.lit(0.0))
    return df.withColumns({"log_amt": F.log1p(F.greatest(F.coalesce(amt, F.lit(0.0)), F.lit(0.0))), "distance": F.coalesce(F.nanvl(col("distance_km", "double"), F.lit(0.0)), F.lit(0.0)), "hour": hour.cast("double"), "category": F.coalesce(col("category", "string"), F.lit("unknown"))})


@dataclass
class Scorer:
    """Standardised numbers and one-hot categories of a fixed vocabulary, weighed; unknown categories are all zero."""

    vocabulary: list[str]
    mean: dict[str, float]
    scale: dict[str, float]
    weights: dict[str, float]
    intercept: float
    review: float = 1.0
    decline: float = 1.0

    def probability(self) -> Column:
        z = F.lit(self.intercept)
        for name in NUMERIC:
            z = z + (F.col(name) - self.mean[name]) / self.scale[name] * self.weights[name]
        for c in self.vocabulary:
            z = z + F.when(F.col("category") == c, self.weights[f"category={c}"]).otherwise(0.0)
        return 1 / (1 + F.exp(-z))

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with fraud_probability (rounded after deciding) and decision: one projection, no Python."""
        names = df.columns
        out = features(df).withColumn("__p", self.probability()).withColumn("decision", banding("__p", self.review, self.decline))
        return out.select(*(F.col(c) for c in names if c != "category"), "category", F.round("__p", 6).alias("fraud_probability"), "decision", reason("__p", self.review, self.decline).alias("reason"))

    def score_one(self, spark: SparkSession, event: dict[str, Any]) -> dict[str, Any]:
        kinds = {"amt": "double", "distance_km": "double", "trans_hour": "int"}
        names = list(event) or ["amt"]
        row = spark.createDataFrame([tuple(None if event.get(n) is None else str(event[n]) for n in names)], ", ".join(f"`{n}` string" for n in names))
        row = row.select(*(F.col(n).try_cast(kinds.get(n, "string")).alias(n) for n in names))
        return self.score(row).first().asDict()

    def save(self, spark: SparkSession, path: str) -> None:
        Files(spark, path).write(path, json.dumps(self.__dict__))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        files = Files(spark, path)
        if not files.exists(path):
            raise FileNotFoundError(path)
        return cls(**json.loads(files.read(path)))


def reason(p: Column | str, review: float, decline: float) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.when(p >= decline, F.format_string("probability %.3f at or above decline threshold %.3f", p, F.lit(decline))).when(p >= review, F.format_string("probability %.3f at or above review threshold %.3f", p, F.lit(review))).otherwise(F.format_string("probability %.3f below review threshold %.3f", p, F.lit(review)))


def train(df: DataFrame, vocabulary: list[str], label: str = "is_fraud", c: float = 1.0, max_iter: int = 1000) -> Scorer:
    """Balanced, L2-regularised logistic regression. Numbers are standardised by population deviation; classes weigh alike;
    thresholds are exact quantiles of the training scores."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    x = features(df.where(F.col(label).isNotNull())).withColumn("label", F.col(label).cast("double"))
    stats = x.agg(F.count("*").alias("n"), F.sum("label").alias("pos"), *(f(n).alias(f"{k}_{n}") for n in NUMERIC for k, f in (("mean", F.mean), ("sd", F.stddev_pop)))).first()
    n, pos = stats["n"], stats["pos"]
    if not n or pos in (0, n):
        raise ValueError("training needs rows of both classes")
    mean = {k: float(stats[f"mean_{k}"]) for k in NUMERIC}
    scale = {k: float(stats[f"sd_{k}"]) or 1.0 for k in NUMERIC}
    weight = F.when(F.col("label") == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos)))
    cols = [((F.col(k) - mean[k]) / scale[k]).alias(k) for k in NUMERIC] + [(F.col("category") == v).cast("double").alias(f"c{i}") for i, v in enumerate(vocabulary)]
    ready = VectorAssembler(inputCols=[*NUMERIC, *(f"c{i}" for i in range(len(vocabulary)))], outputCol="features").transform(x.select("label", weight.alias("w"), *cols)).select("label", "w", "features")
    model = LogisticRegression(weightCol="w", regParam=1 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-8).fit(ready)
    w = model.coefficients.toArray().tolist()
    out = Scorer(vocabulary, mean, scale, {**dict(zip(NUMERIC, w, strict=False)), **{f"category={v}": w[len(NUMERIC) + i] for i, v in enumerate(vocabulary)}}, float(model.intercept))
    q = x.select(out.probability().alias("p")).agg(F.percentile("p", [REVIEW_QUANTILE, DECLINE_QUANTILE]).alias("q")).first()["q"]
    out.review, out.decline = float(q[0]), float(q[1])
    return out


def thresholds(scored: DataFrame, score: str = "score") -> DataFrame:
    """Exact, interpolated quantiles."""
    return scored.agg(F.percentile(score, REVIEW_QUANTILE).alias("review"), F.percentile(score, DECLINE_QUANTILE).alias("decline"))


def _by_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives of each score; scores are far fewer than rows once they are rounded."""
    return scored.groupBy(F.col(score).alias("s")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))


def ranking_quality(scored: DataFrame, score: str = "score", label: str = "is_fraud", slices: int = 256) -> DataFrame:
    """roc_auc (ties count half) and average_precision (step-wise), from scores summed up in order.

    Running sums are taken within ranges of the score and offset by the ranges before, so no task sorts all scores.
    """
    by = _by_score(scored, score, label)
    low, high = F.min("s").alias("lo"), F.max("s").alias("hi")
    by = by.crossJoin(F.broadcast(by.agg(low, high)))
    by = by.withColumn("slice", F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo")) * slices), F.lit(slices - 1))).otherwise(0).cast("int"))
    parts = by.groupBy("slice").agg(F.sum("pos").alias("p"), F.sum("n").alias("c"))  # `slices` rows
    above = W.orderBy(F.desc("slice")).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("slice", F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p0"), F.coalesce(F.sum("c").over(above), F.lit(0)).alias("c0"))
    within = W.partitionBy("slice").orderBy(F.desc("s")).rowsBetween(W.unboundedPreceding, 0)
    run = by.join(F.broadcast(parts), "slice").withColumns({"tp": F.col("p0") + F.sum("pos").over(within), "k": F.col("c0") + F.sum("n").over(within)})
    neg = F.col("n") - F.col("pos")
    # a negative loses to the positives above it, and half to those beside it
    won = (neg * (F.col("tp") - F.col("pos") / 2.0)).cast("decimal(38,2)")
    sums = run.agg(F.sum(won).alias("won"), F.sum(F.col("pos") * F.col("tp") / F.col("k")).alias("ap"), F.sum("pos").alias("P"), F.sum(neg).alias("N"))
    return sums.select(F.round(F.col("won").cast("double") / (F.col("P") * F.col("N")), 9).alias("roc_auc"), F.round(F.col("ap") / F.col("P"), 9).alias("average_precision"))


def confusion(decided: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Each decision's rows, share, caught frauds and precision."""
    out = decided.groupBy("decision").agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("frauds"))
    return out.crossJoin(F.broadcast(out.agg(F.sum("n").alias("__n")))).select("decision", "n", exact_ratio(F.col("n"), F.col("__n")).alias("share"), "frauds", exact_ratio(F.col("frauds"), F.col("n")).alias("precision"))
