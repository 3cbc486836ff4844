"""Result tables: one row per reference entity, ids in comma lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinlink.sources import tables


def _lists(seen: DataFrame, keys: list[str], name: str) -> DataFrame:
    return seen.groupBy(*keys).agg(F.concat_ws(",", F.array_sort(F.collect_set(F.col("cand").cast("string")))).alias(name))


def matching_results(entities: DataFrame, seen: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): accepted ids; empty where there are none."""
    lists = _lists(seen.where("accepted"), ["s1"], "matched_entity_ids")
    return entities.select("s1").distinct().join(lists, "s1", "left").na.fill("").withColumnRenamed("s1", "source1_entity_id")


def candidate_pairs(entities: DataFrame, seen: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_ids): accepted and rejected ids."""
    return entities.select("s1").distinct().join(_lists(seen, ["s1"], "candidate_entity_ids"), "s1", "left").na.fill("").withColumnRenamed("s1", "source1_entity_id")


def per_cycle_pairs(entities: DataFrame, seen: DataFrame) -> DataFrame:
    """(source1_entity_id, cycle, candidate_entity_ids): a row per cycle; one with a null cycle for entities without candidates."""
    lists = _lists(seen, ["s1", "cycle"], "candidate_entity_ids")
    return entities.select("s1").distinct().join(lists, "s1", "left").na.fill("", ["candidate_entity_ids"]).withColumnRenamed("s1", "source1_entity_id")


def seen_state(updates: DataFrame) -> DataFrame:
    """(s1, accepted, rejected, per_cycle): the first update of each (s1, cand) in order of seq wins, later ones are ignored."""
    first = updates.groupBy("s1", "cand").agg(F.min_by(F.struct("cycle", "accepted"), "seq").alias("u"))
    flat = first.select("s1", "cand", "u.cycle", "u.accepted")
    cycles = flat.groupBy("s1", "cycle").agg(F.array_sort(F.collect_set("cand")).alias("c"), F.collect_set(F.when(F.col("accepted"), F.col("cand"))).alias("a"), F.collect_set(F.when(~F.col("accepted"), F.col("cand"))).alias("r"))
    return cycles.groupBy("s1").agg(F.array_sort(F.flatten(F.collect_list("a"))).alias("accepted"), F.array_sort(F.flatten(F.collect_list("r"))).alias("rejected"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("cycle").cast("string"), "c")))).alias("per_cycle"))


def has_been_seen(state: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (s1, cand) with seen: whether a state row (s1, accepted, rejected, ..) of the entity holds the candidate."""
    known = state.select("s1", F.explode(F.array_union("accepted", "rejected")).alias("cand")).distinct().withColumn("seen_", F.lit(True))
    return pairs.join(known, ["s1", "cand"], "left").withColumn("seen", F.coalesce("seen_", F.lit(False))).drop("seen_")


def seen_of(state: DataFrame) -> DataFrame:
    """(s1, cand, cycle, accepted) rows of states; a candidate that no cycle lists has a null cycle."""
    verdict = state.select("s1", F.explode(F.array_union(F.coalesce("accepted", F.array()), F.coalesce("rejected", F.array()))).alias("cand"), "accepted")
    verdict = verdict.select("s1", "cand", F.array_contains("accepted", F.col("cand")).alias("accepted"))
    cycles = state.select("s1", F.explode("per_cycle").alias("cycle", "cands")).select("s1", F.col("cycle").cast("int").alias("cycle"), F.explode("cands").alias("cand"))
    return verdict.join(cycles, ["s1", "cand"], "left").select("s1", "cand", "cycle", "accepted")


def write_results(entities: DataFrame, seen: DataFrame, folder: str) -> dict[str, str]:
    """Write the three result files under folder, sorted by id (and cycle), each headed once; their paths by name.

    An entity without candidates has an empty list, and in the file by cycle an empty cycle too. What can't be written is
    a FileWriteError.
    """
    made = {"matching_results": matching_results(entities, seen), "candidate_pairs": candidate_pairs(entities, seen), "candidate_pairs_per_cycle": per_cycle_pairs(entities, seen)}
    for name, rows in made.items():
        tables.write_tsv(rows, f"{folder}/{name}.tsv", ["source1_entity_id"] + ["cycle"] * ("cycle" in rows.columns))
    return {name: f"{folder}/{name}.tsv" for name in made}


def write_state_results(spark: SparkSession, log: str, folder: str) -> dict[str, str]:
    """write_results() of what a state log holds; without a log the files have no rows."""
    state = tables.read_state(spark, log)
    return write_results(state.select("s1"), seen_of(state), folder)
