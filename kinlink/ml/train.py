"""Training: labelled pairs, folds, search, out-of-fold scores, calibration, artifact."""

from __future__ import annotations

import logging
import math
import os
import random
import sys
import time
from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce
from statistics import median

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import TargetEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from kinlink.config import Config
from kinlink.ml import booster
from kinlink.operators import metrics, quality
from kinlink.operators.features import COUNTRY, FEATURES, NUMERIC
from kinlink.sources import tables

#: Which features may only raise the probability, in order (the encoded country comes last).
MONOTONE = (1,) * 11 + (0,) * 2 + (1,) * 4 + (0,) * 9
#: Other names under which columns arrive.
ALIASES = {
    "source1_entity_id": "s1_id",
    "candidate_entity_id": "cand_id",
    "is_match": "label",
    "y": "label",
    "name_jaro_winkler": "dim_1_name_jaro_winkler",
    "name_monge_elkan": "dim_2_name_monge_elkan",
    "name_levenshtein": "dim_3_name_levenshtein_norm",
    "name_levenshtein_norm": "dim_3_name_levenshtein_norm",
    "dim_3_name_levenshtein": "dim_3_name_levenshtein_norm",
    "exact_name_match": "dim_4_name_exact_match",
    "name_phonetic_match": "dim_5_phonetic_match",
    "dim_5_name_phonetic_match": "dim_5_phonetic_match",
    "acronym_score": "dim_6_name_acronym_match",
    "dim_6_acronym_score": "dim_6_name_acronym_match",
    "name_semantic_cosine": "dim_7_semantic_cosine",
    "dim_7_name_semantic_cosine": "dim_7_semantic_cosine",
    "addr_token_jaccard": "dim_8_addr_jaccard",
    "dim_8_addr_token_jaccard": "dim_8_addr_jaccard",
    "addr_token_containment": "dim_9_addr_containment",
    "dim_9_addr_token_containment": "dim_9_addr_containment",
    "exact_addr_match": "dim_10_addr_exact_match",
    "addr_numeric_jaccard": "dim_11_num_jaccard",
    "dim_11_addr_numeric_jaccard": "dim_11_num_jaccard",
    "addr_numeric_exact": "dim_12_num_exact_match",
    "dim_12_addr_numeric_exact": "dim_12_num_exact_match",
    "addr_numeric_exists_both": "dim_13_num_presence",
    "dim_13_addr_numeric_exists_both": "dim_13_num_presence",
    "name_bm25_score": "dim_14_name_bm25_norm",
    "dim_14_name_bm25_score": "dim_14_name_bm25_norm",
    "addr_bm25_score": "dim_15_addr_bm25_norm",
    "dim_15_addr_bm25_score": "dim_15_addr_bm25_norm",
    "rrf_score": "dim_16_rrf_score",
    "dim_16_rrf": "dim_16_rrf_score",
    "dim_17_stream_overlap_count": "dim_17_overlap_count",
    "stream_overlap_count": "dim_17_overlap_count",
    "name_length_ratio": "dim_18_name_len_ratio",
    "dim_18_name_length_ratio": "dim_18_name_len_ratio",
    "addr_length_ratio": "dim_19_addr_len_ratio",
    "dim_19_addr_length_ratio": "dim_19_addr_len_ratio",
    "s1_name_missing": "dim_20_s1_name_missing",
    "cand_name_missing": "dim_21_cand_name_missing",
    "s1_addr_missing": "dim_22_s1_addr_missing",
    "cand_addr_missing": "dim_23_cand_addr_missing",
    "cross_script_target": "dim_24_cross_script",
    "dim_24_cross_script_target": "dim_24_cross_script",
    "source_origin": "dim_25_source_origin",
    "country": "dim_26_country_raw",
    "dim_26_country": "dim_26_country_raw",
}


def standardize(pairs: DataFrame, labelled: bool = True) -> DataFrame:
    """Canonical names, floats with 0 for what isn't a number, label as int. Of several columns for one name the canonical one, else the first, counts."""
    names: dict[str, str] = {}
    for c in pairs.columns:
        to = ALIASES.get(c, c)
        if to != c and to not in pairs.columns and to not in names.values():
            names[c] = to
    pairs = pairs.withColumnsRenamed(names)
    need = ["s1_id", "cand_id", *FEATURES, *(["label"] if labelled else [])]
    if lost := [c for c in need if c not in pairs.columns]:
        raise ValueError(f"columns are missing: {', '.join(lost)}")
    number = lambda c: F.coalesce(F.expr(f"try_cast(`{c}` as float)"), F.lit(0.0).cast("float")).alias(c)
    return pairs.select("s1_id", "cand_id", *(number(c) for c in NUMERIC), F.col(COUNTRY).cast("string"), *([F.col("label").cast("int")] if labelled else []))


def check_alignment(expected: list[str], got: list[str]) -> None:
    if list(expected) != list(got):
        raise RuntimeError(f"features differ: missing {sorted(set(expected) - set(got))}, unknown {sorted(set(got) - set(expected))}, or in another order")


def classifier(kind: str, params: dict, seed: int):
    if kind == "lightgbm":
        raise NotImplementedError(kind)
    if kind == "gbt":
        return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", seed=seed, maxIter=params.get("rounds", 40), maxDepth=params.get("depth", 5), stepSize=params.get("rate", 0.1), subsamplingRate=params.get("subsample", 1.0), featureSubsetStrategy=str(params.get("columns", 1.0)), minInstancesPerNode=params.get("child", 1), minInfoGain=params.get("gain", 0.0))
    if kind == "linear":  # a bounded linear model never falls in a feature that may only raise it
        low = Matrices.dense(1, len(MONOTONE), [0.0 if m else -1e6 for m in MONOTONE])
        return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=params.get("rounds", 50), regParam=params.get("reg", 1e-4), lowerBoundsOnCoefficients=low)
    raise ValueError(f"unknown model: {kind}")


def cross_fitted(rows: DataFrame, folds: int, seed: int) -> DataFrame:
    """rows with country_mean: each row's country mean of labels over the folds but its own, so that no row's label encodes it.

    Folds are by hash of the pair; a country seen in one fold only gets the mean of all other rows. Counts and sums by
    country and fold are made in one aggregation.
    """
    n = max(2, folds)
    dealt = rows.withColumn("part_", F.pmod(F.xxhash64("s1_id", "cand_id", F.lit(seed)), F.lit(n)))
    cell = dealt.groupBy(COUNTRY, "part_").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("y"))
    rest = lambda by, c: F.sum(c).over(W.partitionBy(*by)) - F.col(c)
    part = cell.groupBy("part_").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    total = part.select("part_", (rest([F.lit(1)], "y") / F.nullif(rest([F.lit(1)], "n"), F.lit(0))).alias("all_"))  # a row a fold
    means = cell.select(F.col(COUNTRY).alias("c_"), "part_", F.try_divide(rest([COUNTRY], "y"), rest([COUNTRY], "n")).alias("mean_")).join(total, "part_")
    joined = dealt.join(means.withColumnRenamed("part_", "p_"), F.col(COUNTRY).eqNullSafe(F.col("c_")) & (F.col("part_") == F.col("p_")))
    return joined.select(*rows.columns, F.coalesce("mean_", "all_", F.lit(0.0)).alias("country_mean"))


@dataclass
class Fitted:
    """Stages that encode (and, but for boosted trees of our own, classify), and those trees."""

    stages: PipelineModel
    trees: booster.Booster | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/model")
        if self.trees is not None:
            tables.write_json(spark, f"{path}/trees", self.trees.described())


def fit(rows: DataFrame, kind: str, params: dict, config: Config) -> Fitted:
    """Country by target mean (unseen: mean of all), numerics first, the country last. The classifier is fitted on
    cross-fitted means; the model that comes back encodes by the means of all rows. Kind monotone is boosted trees that
    never fall in the features of MONOTONE, linear a linear model that doesn't, gbt trees that may."""
    index = StringIndexer(inputCol=COUNTRY, outputCol="country_index", handleInvalid="keep").fit(rows)
    encode = TargetEncoder(inputCols=["country_index"], outputCols=["country_mean"], labelCol="label", targetType="continuous", handleInvalid="keep").fit(index.transform(rows))
    assemble = VectorAssembler(inputCols=[*NUMERIC, "country_mean"], outputCol="features")
    crossed = cross_fitted(rows, config.encoder_folds, config.seed)
    if kind == "monotone":
        given = {k: params[k] for k in ("rounds", "depth", "rate", "subsample", "columns", "child", "gain", "reg") if k in params}
        trees = booster.fit(crossed, [*NUMERIC, "country_mean"], [m > 0 for m in MONOTONE], seed=config.seed, **given)
        return Fitted(PipelineModel(stages=[index, encode]), trees)
    return Fitted(PipelineModel(stages=[index, encode, assemble, classifier(kind, params, config.seed).fit(assemble.transform(crossed))]))


def with_folds(pairs: DataFrame, folds: int, seed: int) -> tuple[DataFrame, int]:
    """(pairs with fold, number of folds): all rows of an entity in one fold, entities dealt in turn, so that folds differ by one at most; no more folds than entities.

    Entities are numbered in the order of their hashes: within 256 ranges of it, each beginning after the ranges before.
    """
    entities = pairs.select("s1_id").distinct().withColumn("h_", F.xxhash64("s1_id", F.lit(seed))).withColumn("range_", F.shiftright("h_", 56))
    counts = {r[0]: r[1] for r in entities.groupBy("range_").count().collect()}
    n = max(2, min(folds, sum(counts.values())))
    before, since = {}, 0
    for k in sorted(counts):
        before[k], since = since, since + counts[k]
    start = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("range_")] if before else F.lit(0)
    place = F.row_number().over(W.partitionBy("range_").orderBy("h_", "s1_id")) - 1 + start
    dealt = entities.select("s1_id", F.pmod(place, F.lit(n)).cast("int").alias("fold"))
    return pairs.join(dealt, "s1_id").select(*pairs.columns, "fold"), n


def scored(model: Fitted, pairs: DataFrame) -> DataFrame:
    out = model.stages.transform(pairs.withColumn("weight", F.lit(1.0)) if "weight" not in pairs.columns else pairs)
    made = vector_to_array("probability")[1] if model.trees is None else model.trees.probability()
    return out.withColumn("prob", made).select(*pairs.columns, "prob")


def fold_scores(pairs: DataFrame, fold: int, kind: str, params: dict, config: Config) -> DataFrame:
    """A fold's rows, scored by a model of the others; 0 where those have one class only."""
    train, held = pairs.where(F.col("fold") != fold), pairs.where(F.col("fold") == fold)
    if train.select("label").distinct().count() < 2:
        return held.withColumn("prob", F.lit(0.0))
    return scored(fit(train, kind, params, config), held)


def out_of_fold(pairs: DataFrame, n: int, kind: str, params: dict, config: Config) -> DataFrame:
    return reduce(DataFrame.unionByName, [fold_scores(pairs, fold, kind, params, config) for fold in range(n)])


#: What a trial draws: (low, high) of whole numbers, of numbers, and of numbers by their logarithm.
SPACE = {"rounds": (20, 80), "depth": (3, 9), "rate": (1e-3, 0.3, "log"), "subsample": (0.5, 1.0), "columns": (0.5, 1.0), "child": (1, 20), "gain": (1e-8, 1.0, "log"), "reg": (1e-8, 10.0, "log")}


def draw(chance: random.Random) -> dict:
    out = {}
    for name, (low, high, *scale) in SPACE.items():
        if scale:
            out[name] = math.exp(chance.uniform(math.log(low), math.log(high)))
        else:
            out[name] = chance.randint(low, high) if isinstance(low, int) else chance.uniform(low, high)
    return out


def search(pairs: DataFrame, n: int, kind: str, config: Config) -> tuple[dict, list[dict]]:
    """Seeded random search for the best mean of the folds' macro F-betas at 0.5, within the trials and the time given.

    A trial is pruned after a fold at which its log loss so far is above the median of the finished trials' there.
    """
    chance, trials, began = random.Random(config.seed), [], time.time()
    for _ in range(config.trials):
        trial = {"params": draw(chance), "fold_scores": [], "losses": [], "state": "complete"}
        for fold in range(n):
            held = fold_scores(pairs, fold, kind, trial["params"], config).persist()
            trial["fold_scores"].append(metrics.entity_macro_fbeta(held, 0.5, config.beta).first()[0] or 0.0)
            p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.when(F.col("label") == 1, F.col("prob")).otherwise(1 - F.col("prob"))))
            trial["losses"].append(held.agg(F.avg(-F.log(p))).first()[0] or 0.0)
            held.unpersist()
            others = [sum(t["losses"][: fold + 1]) for t in trials if t["state"] == "complete"]
            if len(others) >= 4 and fold + 1 < n and sum(trial["losses"]) > median(others):
                trial["state"] = "pruned"
                break
        trial["score"] = sum(trial["fold_scores"]) / len(trial["fold_scores"])
        trials.append(trial)
        if time.time() - began > config.trial_seconds:
            break
    return max((t for t in trials if t["state"] == "complete"), key=lambda t: t["score"])["params"], trials


def train(pairs: DataFrame, path: str, kind: str = "gbt", config: Config = Config(), logger: logging.Logger | None = None) -> dict:
    """Search, out-of-fold scores, calibrated threshold, final fit; writes the model, its description and the run's summary under path."""
    logger = logger or logging.getLogger("kinlink.train")
    rows = quality.negative_sample(standardize(pairs), config.negative_ratio, config.seed)
    weight = config.scale_pos_weight if config.scale_pos_weight > 0 else metrics.scale_pos_weight(rows).first()[0]
    rows, n = with_folds(rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(1.0)), config.folds, config.seed)
    rows, marks = rows.persist(), [time.time()]
    lap = lambda: (marks.append(time.time()), round(marks[-1] - marks[-2], 3))[1]
    try:
        size = rows.agg(F.count(F.lit(1)), F.sum("label"), F.count_distinct("s1_id")).first()
        dataset = {"total_rows": size[0], "n_features": len(FEATURES), "n_positive": size[1], "n_negative": size[0] - size[1], "scale_pos_weight": float(weight), "unique_s1_entities": size[2]}
        logger.info("%s rows, %s entities, %s folds, weight %.4f", size[0], size[2], n, weight)
        params, trials = search(rows, n, kind, config)
        best = max((t for t in trials if t["state"] == "complete"), key=lambda t: t["score"])
        hpo = {"total_trials": len(trials), "completed_trials": sum(t["state"] == "complete" for t in trials), "pruned_trials": sum(t["state"] == "pruned" for t in trials), "best_trial_number": trials.index(best), "best_score": best["score"], "best_params": params, "duration_seconds": lap(), "trials": trials}
        logger.info("best of %s trials (%s pruned): %.4f with %s", len(trials), hpo["pruned_trials"], best["score"], params)
        held = out_of_fold(rows, n, kind, params, config).persist()
        whole = metrics.entity_macro_fbeta(held, 0.5, config.beta).first()[0]
        clean = {"n_folds": n, "fold_scores": best["fold_scores"], "oof_macro_fbeta": whole, "hpo_winning_score": best["score"], "score_difference": whole - best["score"], "duration_seconds": lap()}
        sweep = metrics.threshold_sweep(held, config).orderBy("threshold").persist()
        threshold, score = metrics.best_threshold(sweep)
        pr = metrics.precision_recall(held, threshold).first()
        calibration = {"optimal_threshold": threshold, "best_score": score, "precision_at_optimal": pr[0], "recall_at_optimal": pr[1], "threshold_sweep": [r.asDict() for r in sweep.collect()], "duration_seconds": lap()}
        logger.info("threshold %.4f scores %.4f out of fold", threshold, score)
        model = fit(rows, kind, params, config)
        held.unpersist()
        sweep.unpersist()
    finally:
        rows.unpersist()
    model.save(pairs.sparkSession, path)
    told = {"threshold": threshold, "score": score, "precision": pr[0], "recall": pr[1], "params": params, "feature_names": list(FEATURES), "trials": trials, "kind": kind}
    spark = pairs.sparkSession
    tables.write_json(spark, f"{path}/artifact", told)
    final = {"artifact_path": path, "artifact_keys": sorted(told), "initial_scale_pos_weight": float(weight), "final_scale_pos_weight": float(weight), "weights_matched": True, "duration_seconds": lap()}
    tables.write_json(spark, f"{path}/summary", {"run_id": datetime.now().strftime("%Y%m%d_%H%M%S"), "timestamp": datetime.now().isoformat(), "config": asdict(config), "dataset": dataset, "phase_a_hpo": hpo, "phase_b_clean_eval": clean, "phase_c_calibration": calibration, "phase_d_final_fit": final})
    logger.info("model in %s", path)
    return told


def run_logger(folder: str, run_id: str) -> logging.Logger:
    """A logger to the console and to a file of the run in a folder of the driver's."""
    os.makedirs(folder, exist_ok=True)
    logger = logging.getLogger(f"kinlink.train.{run_id}")
    logger.setLevel(logging.INFO)
    logger.propagate = False
    for old in list(logger.handlers):
        logger.removeHandler(old)
        old.close()
    for handler in (logging.StreamHandler(sys.stdout), logging.FileHandler(f"{folder}/train_{run_id}.log", encoding="utf-8")):
        handler.setFormatter(logging.Formatter("[%(asctime)s] [%(levelname)s] %(message)s", "%Y-%m-%d %H:%M:%S"))
        logger.addHandler(handler)
    return logger


def load(spark: SparkSession, path: str) -> tuple[Fitted, dict]:
    """The model and the description that train() wrote."""
    told = tables.read_json(spark, f"{path}/artifact")
    check_alignment(list(FEATURES), told["feature_names"])
    trees = booster.Booster.from_description(tables.read_json(spark, f"{path}/trees")) if told["kind"] == "monotone" else None
    return Fitted(PipelineModel.load(f"{path}/model"), trees), told
