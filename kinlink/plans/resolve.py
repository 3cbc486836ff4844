"""Records to scored candidates and results, without a loop around the model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

from kinlink.config import Config
from kinlink.operators import bm25, features, merge, outputs, vector
from kinlink.operators.best import SORTED


def hashed_vectors(rows: DataFrame, text: str, size: int = 64) -> DataFrame:
    """rows with vec: counts of hashed trigrams; stands in for an encoder, which callers may give instead."""
    from kinlink.functions.text import trigrams

    @F.pandas_udf("array<double>")
    def counts(slots: pd.Series) -> pd.Series:
        return slots.map(lambda x: np.bincount(x, minlength=size).astype(np.float64))

    return rows.withColumn("vec", counts(F.transform(trigrams(F.col(text)), lambda g: F.pmod(F.xxhash64(g), F.lit(size)).cast("int"))))


def model_encoder(make_predict: Callable[[], Callable], batch_size: int = 256) -> Callable[[DataFrame, str], DataFrame]:
    """An encoder that runs a model over batches of texts on executors.

    make_predict loads the model, once a worker, and returns a function from an array of texts to a matrix of their vectors.
    """
    run = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return lambda rows, text: rows.withColumn("vec", run(F.coalesce(F.col(text), F.lit(""))).cast("array<double>"))


def _kept(rows: DataFrame, work: str | None, name: str) -> DataFrame:
    """rows written under work and read back, or persisted on disk where there is no such folder: what several results share is made once, and stays off the heap."""
    if work is None:
        return rows.persist(StorageLevel.DISK_ONLY)
    rows.write.mode("overwrite").parquet(f"{work}/{name}")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{work}/{name}")


def retrieve(queries: DataFrame, targets: DataFrame, config: Config = Config(), encode: Callable[[DataFrame, str], DataFrame] = hashed_vectors, work: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits, self scores): the three streams to the deepest rank any cycle needs; rows are (id, country, name, addr)."""
    k, streams, selves = config.max_rank, [], []
    for stream in ("name", "addr"):
        made = bm25.build(targets, "country", "id", stream, config)
        # rows are texts cut anew, and statistics a few rows a block, that need few tasks
        few = targets.sparkSession.sparkContext.defaultParallelism
        index = bm25.Index(made.rows, *(_kept(getattr(made, t).coalesce(few), work, f"{stream}_{t}") for t in ("idf", "stats")))
        streams.append(bm25.search(queries, index, "country", "id", stream, k, config).withColumn("stream", F.lit(stream)))
        selves.append(bm25.self_scores(queries, index, "country", "id", stream, config).select("block", "doc", F.col("self_score").alias(f"{stream}_self")))
    dense = vector.search(encode(queries, "name"), encode(targets, "name"), "country", "id", "vec", k)
    streams.append(dense.withColumn("stream", F.lit("vector")))
    hits = streams[0].unionByName(streams[1]).unionByName(streams[2]).select(F.col("q").alias("s1"), F.col("doc").alias("cand"), "stream", "rank", "score")
    return hits, selves[0].join(selves[1], ["block", "doc"]).select(F.col("doc").alias("s1"), "name_self", "addr_self")


def candidates(queries: DataFrame, targets: DataFrame, config: Config = Config(), encode: Callable[[DataFrame, str], DataFrame] = hashed_vectors, work: str | None = None) -> DataFrame:
    """(s1, cand, cycle, 26 features) of all pairs that any cycle draws."""
    # a table in one piece would be encoded by one task, as would a small one whose parts were put together again
    tasks = 4 * queries.sparkSession.sparkContext.defaultParallelism
    queries, targets = queries.repartition(tasks, "id"), targets.repartition(tasks, "id")
    hits, selves = retrieve(queries, targets, config, encode, work)
    # pairs lie by s1 as they are drawn, and what joins them there goes to them and is never broadcast
    most = queries.count() * len(merge.STREAMS) * config.max_rank
    pairs = merge.drawn(hits, config, max(tasks, most // SORTED + 1)).join(selves.hint("merge"), "s1")
    told = lambda s: [F.col("name").alias(f"name_{s}"), F.col("addr").alias(f"addr_{s}"), F.col("is_cross_script").cast("int").alias(f"cross_{s}")]
    unit = lambda rows, key, s: encode(rows, "name").withColumnRenamed("id", key).withColumn("block", F.col("country")).withColumn(f"vec_{s}", vector.unit(F.col("vec")))
    # what is short goes with the pairs, vectors only from tile to tile
    named = pairs.join(queries.select(F.col("id").alias("s1"), "country", *told("a")).hint("merge"), "s1").withColumnsRenamed({"s1": "q", "cand": "doc", "country": "block"})
    asked = unit(queries, "q", "a").select("block", "q", "vec_a")
    docs = unit(targets, "doc", "b").select("block", "doc", "vec_b", *told("b"), F.col("source").alias("source_b"))
    met = vector.with_cosines(named, asked, docs)
    return features.features(met.withColumnsRenamed({"q": "s1", "doc": "cand", "block": "country"}), config)


def resolve(queries: DataFrame, targets: DataFrame, score: Callable[[DataFrame], DataFrame], threshold: float, config: Config = Config(), work: str | None = None) -> dict[str, DataFrame]:
    """The three result tables; score adds prob to candidates. What they share is made once, under work (a shared folder) or persisted."""
    seen = _kept(merge.stop(score(candidates(queries, targets, config, work=work)), threshold, config), work, "seen")
    entities = queries.select(F.col("id").alias("s1"))
    return {"matching_results": outputs.matching_results(entities, seen), "candidate_pairs": outputs.candidate_pairs(entities, seen), "candidate_pairs_per_cycle": outputs.per_cycle_pairs(entities, seen)}
