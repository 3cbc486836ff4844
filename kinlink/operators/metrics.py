"""Entity macro F-beta, threshold sweeps, class weights, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinlink.config import Config


def _f_beta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    """1 where nothing is true or predicted, 0 where tp is 0, else (1 + b2) tp / ((1 + b2) tp + b2 fn + fp)."""
    b = beta * beta
    return F.when((tp + fn == 0) & (fp == 0), 1.0).when(tp == 0, 0.0).otherwise((1 + b) * tp / ((1 + b) * tp + b * fn + fp))


def entity_macro_fbeta(pairs: DataFrame, threshold: float, beta: float = 0.5, key: str = "s1_id", label: str = "label", prob: str = "prob") -> DataFrame:
    """One row, score: the mean over the entities in pairs; a probability equal to the threshold is a reject."""
    p, y = F.col(prob) > F.lit(threshold), F.col(label) == 1
    per = pairs.groupBy(key).agg(*(F.sum(c.cast("long")).alias(n) for n, c in (("tp", p & y), ("fp", p & ~y), ("fn", ~p & y))))
    return per.agg(F.avg(_f_beta(F.col("tp"), F.col("fp"), F.col("fn"), beta)).alias("score"))


def official_macro_fbeta(predicted: DataFrame, truth: DataFrame, entities: DataFrame, beta: float = 0.5) -> DataFrame:
    """score over all of entities (s1), also those without a candidate; predicted and truth are (s1, cand)."""
    both = predicted.select("s1", "cand", F.lit(1).alias("p")).join(truth.select("s1", "cand", F.lit(1).alias("t")), ["s1", "cand"], "full").na.fill(0, ["p", "t"])
    per = both.groupBy("s1").agg(F.sum(F.col("p") * F.col("t")).alias("tp"), F.sum(F.col("p") * (1 - F.col("t"))).alias("fp"), F.sum((1 - F.col("p")) * F.col("t")).alias("fn"))
    return entities.select("s1").join(per, "s1", "left").na.fill(0).agg(F.avg(_f_beta(F.col("tp"), F.col("fp"), F.col("fn"), beta)).alias("score"))


def thresholds(config: Config = Config()) -> list[float]:
    n = round((config.threshold_end - config.threshold_start) / config.threshold_step)
    return [round(config.threshold_start + i * config.threshold_step, 4) for i in range(n + 1)]


def threshold_sweep(pairs: DataFrame, config: Config = Config(), key: str = "s1_id", label: str = "label", prob: str = "prob") -> DataFrame:
    """(threshold, score) for every threshold, in one pass: each entity's counts at all thresholds are arrays, made in one aggregation."""
    ts = thresholds(config)
    y, p = F.col(label) == 1, F.col(prob)
    sums = [F.sum((p > F.lit(t)).cast("long") * flag.cast("long")) for t in ts for flag in (y, ~y)]
    per = pairs.groupBy(key).agg(F.sum(y.cast("long")).alias("true"), F.array(*sums[::2]).alias("tp"), F.array(*sums[1::2]).alias("fp"))
    tp, fp = F.get("tp", F.col("i")), F.get("fp", F.col("i"))
    rows = per.select("true", "tp", "fp", F.posexplode(F.array(*map(F.lit, ts))).alias("i", "threshold"))
    return rows.select("threshold", _f_beta(tp, fp, F.col("true") - tp, config.beta).alias("s")).groupBy("threshold").agg(F.avg("s").alias("score"))


def best_threshold(sweep: DataFrame) -> tuple[float, float]:
    """The highest score's threshold, the lowest one on ties, and the score."""
    r = sweep.orderBy(F.desc(F.round("score", 12)), "threshold").first()
    return r["threshold"], r["score"]


def scale_pos_weight(pairs: DataFrame, label: str = "label") -> DataFrame:
    """One row, weight: negatives over positives; no positives is an error."""
    pos, neg = F.sum((F.col(label) == 1).cast("long")), F.sum((F.col(label) == 0).cast("long"))
    return pairs.agg(F.when(F.coalesce(pos, F.lit(0)) == 0, F.raise_error(F.lit("no positive labels")).cast("double")).otherwise(neg / pos).alias("weight"))


def explode_truth(truth: DataFrame) -> DataFrame:
    """(s1, cand) of comma lists; empty lists and empty ids give none."""
    ids = truth.select(F.col("source1_entity_id").alias("s1"), F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ",")).alias("cand"))
    return ids.select("s1", F.trim("cand").alias("cand")).where("cand <> ''")


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 where (s1, cand) is true, else 0."""
    return pairs.join(truth.select("s1", "cand", F.lit(1).alias("label")).distinct(), ["s1", "cand"], "left").na.fill(0, ["label"])


def target_means(pairs: DataFrame, category: str, label: str) -> DataFrame:
    """(category, mean) with a null category's row for the mean of all, which unseen values get."""
    return pairs.rollup(category).agg(F.avg(label).alias("mean"), F.grouping(category).alias("all_"))


def precision_recall(pairs: DataFrame, threshold: float, label: str = "label", prob: str = "prob") -> DataFrame:
    p, y = F.col(prob) > F.lit(threshold), F.col(label) == 1
    tp = F.sum((p & y).cast("long"))
    return pairs.agg(F.coalesce(F.try_divide(tp, F.sum(p.cast("long"))), F.lit(0.0)).alias("precision"), F.coalesce(F.try_divide(tp, F.sum(y.cast("long"))), F.lit(0.0)).alias("recall"))
