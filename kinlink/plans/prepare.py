"""Raw records to processed records."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinlink.functions import text, unicode
from kinlink.operators import quality
from kinlink.sources import tables


def process(raw: DataFrame) -> DataFrame:
    """Processed records (and role, handled, degenerate) of raw rows; an id without its file's prefix is an error when read."""
    source = F.split_part("entity_id", F.lit("-"), F.lit(1))
    named = raw.na.fill("").select(
        "entity_id", "role", F.when(source == F.col("expected"), source).otherwise(F.raise_error(F.concat(F.lit("unexpected prefix: "), F.col("entity_id"))).cast("string")).alias("source"), "country",
        F.col("business_name").alias("name_original"), F.col("business_address").alias("addr_original"),
        unicode.detect_script(F.col("business_name")).alias("s"), unicode.nfkc_lower(F.col("business_name")).alias("n"), unicode.nfkc_lower(F.col("business_address")).alias("a"),
    )
    cleaned = named.select("*", text.clean_name(F.col("name_original"), F.col("n")).alias("name_for_faiss"))
    latin = cleaned.withColumn("t", unicode.transliterated(F.col("name_for_faiss"), F.col("s.script"), F.col("s.is_cross_script")))
    return latin.select("entity_id", "source", "country", "name_original", "addr_original", "s.is_cross_script", "s.script", text.has_address(F.col("addr_original")).alias("has_address"), "name_for_faiss", F.col("t.name").alias("name_for_bm25"), text.clean_address(F.col("addr_original"), F.col("a")).alias("addr_for_bm25"), "role", "t.handled", "t.degenerate")


def run(spark: SparkSession, folder: str, out: str, split: str, expected: dict[str, int] | None = None, metrics: str | None = None, multiline: bool = True) -> DataFrame:
    """Process a split's three files, write them by role and country, check row counts, return what was written; metrics is a folder for the run's."""
    began = time.time()
    rows = process(tables.read_records(spark, tables.split_files(folder, split), multiline))
    tables.write_processed(rows, out)
    written = spark.read.parquet(out)
    took = {"total": round(time.time() - began, 3)}
    if metrics:
        quality.save_metrics(spark, metrics, quality.run_metrics(written, datetime.now().strftime("%Y%m%d_%H%M%S"), took, expected))
    if expected:
        tables.assert_rows(written, "source", expected)
    return written
