"""Relational checks of result files."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinlink.sources import tables

#: The headers of the result files, and the files of the records that they are held against.
HEADERS = {"matching": "source1_entity_id\tmatched_entity_ids", "candidates": "source1_entity_id\tcandidate_entity_ids"}
REFERENCE_FILE, TARGET_FILES = "test_source1.tsv", ("test_source2.tsv", "test_source3.tsv")
EXAMPLES = 5


def id_list(ids: Column) -> Column:
    """The ids of a comma list as they stand: an empty one between commas is an id without a prefix; a blank list has none."""
    return F.when(F.trim(F.coalesce(ids, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.split(ids, ","))


def findings(results: DataFrame, required: DataFrame, known: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """(rule, severity, n, examples): one row per broken rule, with the number of distinct offenders and the first five.

    results and candidates are (s1, ids) with comma lists; a null ids column means a row without a tab, which is an
    offence by itself and counts for nothing else. required is (s1); known, if given, is (id) of all S2 and S3 records.
    An id offends against one of self_match, bad_prefix and unknown_id only. Rules and offenders are counted by partial
    sums, and only the first five of each rule are ranked.
    """
    whole = results.where("ids is not null").select("s1", id_list(F.col("ids")).alias("list"))
    flat = whole.select("s1", F.explode("list").alias("id")).distinct()
    own, sound = F.col("id").startswith("S1-"), F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    one = lambda rule, severity, df, c="s1": df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.col(c).cast("string").alias("id"))
    parts = [
        one("row_without_tab", "error", results.where("ids is null and trim(s1) <> ''")),
        one("duplicate_s1", "error", whole.groupBy("s1").count().where("count > 1")),
        one("duplicate_in_list", "error", whole.where(F.size("list") != F.size(F.array_distinct("list")))),
        one("self_match", "error", flat.where(own), "id"),
        one("bad_prefix", "error", flat.where(~own & ~sound), "id"),
        one("missing_s1", "error", required.join(whole, "s1", "left_anti")),
        one("unexpected_s1", "error", whole.join(required, "s1", "left_anti")),
    ]
    if known is not None:
        parts.append(one("unknown_id", "error", flat.where(sound).join(known, "id", "left_anti"), "id"))
    if candidates is not None:
        pool = candidates.where("ids is not null").select("s1", F.explode(id_list(F.col("ids"))).alias("id")).distinct()
        parts.append(one("match_not_candidate", "warning", flat.join(pool, ["s1", "id"], "left_anti")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    distinct = out.distinct()
    counts = distinct.groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n"))
    first = distinct.withColumn("r", F.row_number().over(Window.partitionBy("rule").orderBy("id"))).where(F.col("r") <= EXAMPLES)
    shown = first.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return counts.join(shown, "rule").select("rule", "severity", "n", "examples")


def _said(name: str, found: DataFrame) -> Iterator[tuple[str, str]]:
    for r in found.orderBy("rule").collect():  # at most one row per rule
        yield r["severity"], f"{name}: {r['rule']}: {r['n']} total, e.g. {r['examples']}"


def validate(spark: SparkSession, matching: str, candidates: str | None, folder: str, check_ids: bool = False) -> tuple[list[str], list[str]]:
    """(errors, warnings) of a matching file and, where it is there, a candidate file, against the records in folder.

    A missing records or matching file, an empty one and a wrong header are errors; a missing candidate file, missing
    target files and ids that are not checked are warnings.
    """
    errors: list[str] = []
    warnings: list[str] = []
    if not tables.exists(spark, f"{folder}/{REFERENCE_FILE}"):
        return [f"file not found: {folder}/{REFERENCE_FILE}"], warnings
    required = tables.read_ids(spark, f"{folder}/{REFERENCE_FILE}").withColumnRenamed("id", "s1")
    known = None
    if not check_ids:
        warnings.append("ids are not checked against the target files")
    elif lost := [f for f in TARGET_FILES if not tables.exists(spark, f"{folder}/{f}")]:
        warnings.append(f"ids are not checked, as files are not found: {', '.join(lost)}")
    else:
        known = tables.read_id_union(spark, [f"{folder}/{f}" for f in TARGET_FILES])
    held: dict[str, DataFrame] = {}
    for kind, path in (("matching", matching), ("candidates", candidates)):
        if path is None:
            continue
        try:
            held[kind] = tables.read_results(spark, path, HEADERS[kind])
        except FileNotFoundError:
            (errors if kind == "matching" else warnings).append(f"file not found: {path}")
        except tables.InvalidFileFormatError as e:
            errors.append(str(e))
    for kind, rows in held.items():
        others = held.get("candidates") if kind == "matching" else None
        for severity, text in _said(kind, findings(rows, required, known, others)):
            (errors if severity == "error" else warnings).append(text)
    return errors, warnings
