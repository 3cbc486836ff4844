"""Fusion of ranked streams, blacklists, cycles and the stopping rule."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kinlink.config import Config

STREAMS = ("name", "addr", "vector")


def rrf(config: Config = Config()) -> Column:
    """Sum over streams of 1 / (K + rank); a missing rank adds nothing."""
    ks = (config.rrf_k_name, config.rrf_k_addr, config.rrf_k_vector)
    return sum((F.coalesce(1.0 / (F.lit(k) + F.col(f"{s}_rank")), F.lit(0.0)) for s, k in zip(STREAMS, ks, strict=True)), F.lit(0.0))


def overlap() -> Column:
    return sum((F.col(f"{s}_rank").isNotNull().cast("int") for s in STREAMS), F.lit(0))


def merged(hits: DataFrame, config: Config = Config()) -> DataFrame:
    """hits (s1, cand, stream, rank, score) as one row per pair: a rank and score for each stream (null where absent), rrf, overlap.

    One aggregation stands for the three-way full join.
    """
    picked = [F.min(F.when(F.col("stream") == s, F.col(c))).alias(f"{s}_{c}") for s in STREAMS for c in ("rank", "score")]
    return hits.groupBy("s1", "cand").agg(*picked).withColumn("rrf", rrf(config)).withColumn("overlap", overlap())


def merge_streams(hits: DataFrame, config: Config = Config()) -> DataFrame:
    """merged() with priority, which orders by streams, then by name rank, then by id."""
    order = W.partitionBy("s1").orderBy(F.desc("overlap"), F.asc_nulls_last("name_rank"), "cand")
    return merged(hits, config).withColumn("priority", F.row_number().over(order))


def unseen(hits: DataFrame, seen: DataFrame) -> DataFrame:
    return hits.join(seen.select("s1", "cand"), ["s1", "cand"], "left_anti")


def candidate_union(hits: DataFrame, k: int) -> DataFrame:
    """(s1, cand): the distinct candidates that any stream ranks k or better."""
    return hits.where(F.col("rank") <= k).select("s1", "cand").distinct()


def _drawn(streams: list[list], base: int, most: int) -> list[tuple]:
    """(candidate, cycle) as they are drawn from ranked streams."""
    seen: dict = {}
    cycle = 0
    while len(seen) < most:
        cycle += 1
        depth, drawn = base + len(seen), {}
        for s in streams:
            for cand in [c for c in s[:depth] if c not in seen][:base]:
                drawn[cand] = cycle
        if not drawn:
            break
        seen |= drawn
    return list(seen.items())


def cycles(hits: DataFrame, config: Config = Config()) -> DataFrame:
    """(s1, cand, cycle): when each candidate would be drawn; at most three streams of max_rank rows an entity, in one shuffle.

    In each cycle every stream gives its first k_base unseen among its top k_base + seen; drawing ends at max_seen.
    Which candidates a cycle draws doesn't depend on verdicts, as accepted and rejected ones are both seen. Entities are
    arrays of their streams, handled in Arrow batches.
    """
    types = dict(hits.dtypes)
    pick = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("stream") == s, F.struct("rank", "cand")))), lambda x: x["cand"]).alias(s)
    ranked = hits.where(F.col("rank") <= config.max_rank).groupBy("s1").agg(*(pick(s) for s in sorted(STREAMS)))

    @F.pandas_udf(f"array<struct<cand:{types['cand']},cycle:int>>")
    def run(*streams: pd.Series) -> pd.Series:
        return pd.Series([[{"cand": c, "cycle": n} for c, n in _drawn([list(s) for s in row], config.k_base, config.max_seen)] for row in zip(*streams, strict=True)])

    return ranked.select("s1", F.explode(run(*sorted(STREAMS))).alias("x")).select("s1", "x.cand", "x.cycle")


def drawn(hits: DataFrame, config: Config = Config(), parts: int | None = None) -> DataFrame:
    """The rows of merged() that cycles() draws, with their cycle: both in one shuffle by entity, without hits that are not drawn.

    hits may have any number of rows an entity; those below max_rank count too where another stream draws their candidate. parts: so many tasks take the entities.
    """
    types = dict(hits.dtypes)
    names, most = sorted(STREAMS), config.max_rank
    listed = lambda s: F.array_sort(F.collect_list(F.when(F.col("stream") == s, F.struct("rank", "cand", "score")))).alias(s)
    each = (hits.repartition(parts, "s1") if parts else hits).groupBy("s1").agg(*map(listed, names)).select("s1", *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in names for c in ("rank", "cand", "score")))
    fields = [("cand", types["cand"]), ("cycle", "int"), *((f"{s}_{c}", types[c]) for s in names for c in ("rank", "score"))]

    @F.pandas_udf(", ".join(f"{n} array<{t}>" for n, t in fields))
    def run(*columns: pd.Series) -> pd.DataFrame:
        out = []
        for row in zip(*columns, strict=True):
            row = [v.tolist() if hasattr(v, "tolist") else list(v) for v in row]
            told = [dict(zip(reversed(c), zip(reversed(r), reversed(x), strict=True), strict=True)) for r, c, x in zip(row[::3], row[1::3], row[2::3], strict=True)]
            picked = _drawn([[c for r, c in zip(*row[i : i + 2], strict=True) if r <= most] for i in range(0, len(row), 3)], config.k_base, config.max_seen)
            found = [[t.get(c, (None, None)) for c, _ in picked] for t in told]
            out.append([[c for c, _ in picked], [n for _, n in picked], *([x[i] for x in f] for f in found for i in (0, 1))])
        return pd.DataFrame(out, columns=[n for n, _ in fields])

    given = [f"{s}_{c}" for s in names for c in ("rank", "cand", "score")]
    rows = each.select("s1", run(*given).alias("x")).select("s1", F.explode(F.arrays_zip(*(F.col(f"x.{n}").alias(n) for n, _ in fields))).alias("z")).select("s1", *(F.col(f"z.{n}").alias(n) for n, _ in fields))
    return rows.withColumn("rrf", rrf(config)).withColumn("overlap", overlap())


def stop(scored: DataFrame, threshold: float, config: Config = Config()) -> DataFrame:
    """scored (s1, cand, cycle, prob) up to the stopping cycle, with accepted = prob > threshold.

    An entity stops at the first cycle by which it has seen max_seen, or from min_cycles on one without a match.
    """
    verdict = scored.withColumn("accepted", F.col("prob") > F.lit(threshold))
    per = verdict.groupBy("s1", "cycle").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("accepted").cast("long")).alias("m"))
    total = F.sum("n").over(W.partitionBy("s1").orderBy("cycle").rowsBetween(W.unboundedPreceding, 0))
    ended = (F.col("total") >= config.max_seen) | ((F.col("cycle") >= config.min_cycles) & (F.col("m") == 0))
    cut = per.withColumn("total", total).groupBy("s1").agg(F.coalesce(F.min(F.when(ended, F.col("cycle"))), F.max("cycle")).alias("last"))
    return verdict.join(cut, "s1").where("cycle <= last").drop("last")
