"""BM25 over character n-grams: postings, statistics, self-scores and ranked search within blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from kinlink.config import Config
from kinlink.functions.text import ngrams
from kinlink.operators.best import searched, sizes

#: Documents that are searched at a time.
HEAVY = 32768


@dataclass
class Index:
    """rows (block, doc, toks, dl), idf (block, tok, idf) and stats (block, n, avgdl); blocks are open."""

    rows: DataFrame
    idf: DataFrame
    stats: DataFrame


def _listed(rows: DataFrame, block: str, key: str, text: str, config: Config, to: str = "doc") -> DataFrame:
    """(block, {to}, toks): each row's n-grams with repeats."""
    return rows.select(F.col(block).alias("block"), F.col(key).alias(to), ngrams(F.col(text), config.ngram).alias("toks"))


def build(rows: DataFrame, block: str, key: str, text: str, config: Config = Config()) -> Index:
    """The index of rows by block; empty texts count as documents. A negative idf becomes epsilon times the block's mean idf.

    A key's texts are one document, as long as the first that has n-grams. Texts and counts by block and token are shuffled, no row a token.
    """
    size = F.size(ngrams(F.col(text), config.ngram))
    stats = rows.groupBy(F.col(block).alias("block")).agg(F.count(F.lit(1)).alias("n"), (F.sum(size) / F.count(F.lit(1))).alias("avgdl"))
    texts = rows.groupBy(F.col(block).alias("block"), F.col(key).alias("doc")).agg(F.collect_list(text).alias("texts"))
    grams = texts.select("block", "doc", F.filter(F.transform("texts", lambda t: ngrams(t, config.ngram)), lambda g: F.size(g) > 0).alias("g"))
    listed = grams.where(F.size("g") > 0).select("block", "doc", F.flatten("g").alias("toks"), F.size(F.get("g", F.lit(0))).cast("double").alias("dl"))
    df = listed.select("block", F.explode(F.array_distinct("toks")).alias("tok")).groupBy("block", "tok").agg(F.count(F.lit(1)).alias("df"))
    raw = df.join(stats, "block").select("block", "tok", (F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
    mean = raw.groupBy("block").agg(F.avg("raw").alias("mean"))
    idf = raw.join(mean, "block").select("block", "tok", F.when(F.col("raw") >= 0, F.col("raw")).otherwise(config.bm25_epsilon * F.col("mean")).alias("idf"))
    return Index(listed, idf, stats)


def weight(config: Config) -> Column:
    """A posting's share of the score, without the query's count, over columns idf, tf, dl, avgdl."""
    k1, b = config.bm25_k1, config.bm25_b
    return F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))


def search(queries: DataFrame, index: Index, block: str, key: str, text: str, k: int, config: Config = Config()) -> DataFrame:
    """(block, q, doc, score, rank): the k best documents of each query's block, scores above 0 only, ties by doc.

    Tiles of queries and documents are scored where they lie, and of each pair of tiles a query's k best are given out. Rows
    go to tiles with their n-grams in lists, and are weighed there.
    """
    if k <= 0:
        raise ValueError(f"k must be positive, not {k}")
    asked = _listed(queries, block, key, text, config, "q").where(F.size("toks") > 0).withColumn("ws", F.lit(None))
    k1, b = config.bm25_k1, config.bm25_b
    known = index.idf.join(index.stats.select("block", "avgdl"), "block")
    weigh = lambda idf, tf, dl, avgdl: idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
    of = (sizes(queries, block), index.stats.select("block", "n"))
    return searched(asked, index.rows.withColumn("ws", F.array("dl")), k, of, HEAVY, known, weigh).where("score > 0")


def self_scores(rows: DataFrame, index: Index, block: str, key: str, text: str, config: Config = Config()) -> DataFrame:
    """(block, doc, self_score): each row's score against itself, at least the floor; unknown tokens weigh nothing."""
    listed = _listed(rows, block, key, text, config).select("block", "doc", F.size("toks").cast("long").alias("dl"), F.explode("toks").alias("tok"))
    counts = listed.groupBy("block", "doc", "tok").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))
    own = counts.join(index.idf, ["block", "tok"], "left").na.fill(0.0, ["idf"]).join(index.stats, "block")
    scored = own.groupBy("block", "doc").agg(F.sum(F.col("tf") * weight(config)).alias("s"))
    base = rows.select(F.col(block).alias("block"), F.col(key).alias("doc"))
    return base.join(scored, ["block", "doc"], "left").select("block", "doc", F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(config.self_score_floor)).alias("self_score"))
