"""Readers and writers of records, truth, results, state, indexes and artifacts."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from kinlink.functions.text import without_fake_nulls

RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
#: The processed record's columns.
PROCESSED = ("entity_id", "source", "country", "name_original", "addr_original", "is_cross_script", "script", "has_address", "name_for_faiss", "name_for_bm25", "addr_for_bm25")
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
STATE = "accepted array<string>, rejected array<string>, per_cycle map<string,array<string>>"
BAD = "malformed_"


class InvalidFileFormatError(ValueError):
    """A file doesn't have the columns or the shape that its reader needs."""


class FileWriteError(OSError):
    """A result could not be written."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def _tsv(spark: SparkSession, schema: T.StructType, multiline: bool) -> DataFrameReader:
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').option("multiLine", multiline)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RAW, multiline: bool = True) -> DataFrame:
    """A headed TSV, all strings, null as empty; the text NA stays text.

    Quoted fields may hold tabs, doubled quotes and line breaks, so a file is read by one task; multiline=False reads
    splits of it in parallel, for files whose records hold no line breaks.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return _tsv(spark, schema, multiline).csv(path).na.fill("")


def read_records(spark: SparkSession, files: list[tuple[str, str, str]], multiline: bool = True) -> DataFrame:
    """Rows of several (path, role, prefix) with role and expected prefix beside them."""
    parts = [read_tsv(spark, p, multiline=multiline).withColumn("role", F.lit(role)).withColumn("expected", F.lit(prefix)) for p, role, prefix in files]
    return reduce(DataFrame.unionByName, parts)


def split_files(folder: str, split: str) -> list[tuple[str, str, str]]:
    return [(f"{folder}/{split}_source{i}.tsv", "Query" if i == 1 else "Target", f"S{i}") for i in (1, 2, 3)]


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(source1_entity_id, matched_entity_ids) of a truth TSV; no match is an empty list."""
    return read_tsv(spark, path, TRUTH, multiline=False)


def load_cleaned(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A raw TSV with literals that stand for null emptied.

    A missing file, another header, and a row with fewer or more fields are an InvalidFileFormatError here and now: rows
    are counted in a pass of their own, as a plan would fail only when something reads it.
    """
    if not exists(spark, path):
        raise InvalidFileFormatError(f"{path} is not there")
    first = spark.read.text(path).first()
    if first is None or first[0].lstrip("﻿").split("\t") != RAW.fieldNames():
        raise InvalidFileFormatError(f"{path} has header {first and first[0]!r}")
    marked = T.StructType([*RAW.fields, T.StructField(BAD, T.StringType())])
    reader = _tsv(spark, marked, multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).option("columnPruning", False)
    try:
        wrong = reader.csv(path).select(*RAW.fieldNames(), BAD).where(F.col(BAD).isNotNull()).head(1)
    except PySparkException as e:
        raise InvalidFileFormatError(path) from e
    if wrong:
        raise InvalidFileFormatError(f"{path} has a malformed row: {wrong[0][BAD]!r}")
    rows = read_tsv(spark, path, multiline=multiline)
    return rows.select(*(without_fake_nulls(F.col(c)).alias(c) for c in rows.columns))


def assert_rows(df: DataFrame, by: str, expected: dict[str, int]) -> None:
    got = {r[0]: r[1] for r in df.groupBy(by).count().collect()}
    wrong = {k: (n, got.get(k, 0)) for k, n in expected.items() if got.get(k, 0) != n}
    if wrong:
        raise AssertionError(f"rows (expected, found) differ: {wrong}")


def read_any(spark: SparkSession, data) -> DataFrame:
    """A path by suffix (.parquet, a folder, .csv, .tsv, .txt), a DataFrame, or a pandas, Arrow or Polars table."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, str):
        suffix = data.rsplit(".", 1)[-1].lower() if "." in data.rsplit("/", 1)[-1] else ""
        if suffix in ("parquet", ""):
            if not exists(spark, data):
                raise FileNotFoundError(data)
            p, fs = _path(spark, data)
            if fs.getFileStatus(p).isDirectory() and not (exists(spark, f"{data}/*.parquet") or exists(spark, f"{data}/*=*")):
                raise FileNotFoundError(f"no Parquet files in {data}")
            return spark.read.parquet(data)
        if suffix in ("csv", "tsv", "txt"):
            return spark.read.option("header", True).option("inferSchema", True).option("sep", "," if suffix == "csv" else "\t").csv(data)
        raise ValueError(f"unknown suffix: {data}")
    if hasattr(data, "to_arrow"):
        return spark.createDataFrame(data.to_arrow())
    if type(data).__module__.split(".")[0] in ("pandas", "pyarrow"):
        return spark.createDataFrame(data)
    raise TypeError(type(data))


def discover_partitions(spark: SparkSession, path: str, column: str = "country") -> list[str]:
    """Partition values, in order, from the names of folders; no row is read, however many there are."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    p, fs = _path(spark, path)
    found, todo = set(), [p]
    while todo:
        for status in fs.listStatus(todo.pop()):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(f"{column}="):
                found.add(spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.split("=", 1)[1]))
            elif status.isDirectory() and "=" in name:
                todo.append(status.getPath())
    if not found:
        raise FileNotFoundError(f"no partitions in {path}")
    return sorted(found)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches, sorted."""
    p, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def write_chunks(pairs: DataFrame, path: str, entities: int = 100_000, key: str = "s1_id") -> None:
    """Write training pairs as Parquet by chunk, a chunk having all rows of about so many entities; each chunk is written by one task at most, so files stay whole."""
    chunks = max(1, -(-pairs.select(key).distinct().count() // entities))
    chunk = F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")
    pairs.withColumn("chunk", chunk).repartition(chunks, "chunk").write.mode("overwrite").partitionBy("chunk").parquet(path)


def write_processed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").partitionBy("role", "country").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(s1, accepted, rejected, per_cycle) of a JSONL log, whose lines map ids to states; blank and malformed lines are skipped; no log, no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"s1 string, {STATE}")
    parsed = spark.read.text(path).select(F.from_json("value", f"map<string,struct<{STATE.replace(' array', ':array').replace(' map', ':map').replace(', ', ',')}>>").alias("m"))
    return parsed.where("m is not null").select(F.explode("m").alias("s1", "state")).where("state is not null").select("s1", "state.*")


def state_lines(state: DataFrame) -> DataFrame:
    """(value): a state log's lines, one id to a line."""
    none = F.array().cast("array<string>")
    lists = [F.array_sort(F.coalesce(c, none)).alias(c) for c in ("accepted", "rejected")]
    cycles = F.coalesce("per_cycle", F.create_map().cast("map<string,array<string>>")).alias("per_cycle")
    return state.select(F.to_json(F.create_map("s1", F.struct(*lists, cycles))).alias("value"))


def append_state(state: DataFrame, path: str) -> None:
    """Add states to a log; what can't be written is a FileWriteError."""
    written(lambda: state_lines(state).write.mode("append").text(path), path)


def completed_ids(spark: SparkSession, path: str) -> DataFrame:
    """(s1): entities that a log has finished."""
    return read_state(spark, path).select("s1").distinct()


def unfinished(rows: DataFrame, path: str) -> DataFrame:
    """Rows of entities that the log at path doesn't have yet: what a restart must still do."""
    return rows.join(completed_ids(rows.sparkSession, path), "s1", "left_anti")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of the first column of a headed TSV."""
    lines = spark.read.text(path).select(F.trim(F.split_part("value", F.lit("\t"), F.lit(1))).alias("id"))
    return lines.where("id <> '' and lower(id) not in ('entity_id', 'source1_entity_id')").distinct()


def read_id_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Distinct ids of several files."""
    return reduce(DataFrame.union, [read_ids(spark, p) for p in paths]).distinct()


def read_results(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(s1, ids) of a result file: what stands before and after a line's first tab; ids is null for rows without one.

    The header must be the expected one, case and blanks around names aside. Lines equal to it are no rows.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    first = spark.read.text(path).first()
    if first is None:
        raise InvalidFileFormatError(f"{path} is empty")
    if "," in first[0] and "\t" not in first[0]:
        raise InvalidFileFormatError(f"{path} is separated by commas")
    if [x.strip().lower() for x in first[0].split("\t")] != header.split("\t"):
        raise InvalidFileFormatError(f"{path} has header {first[0]!r}")
    lines = spark.read.text(path).where((F.trim("value") != "") & (F.col("value") != F.lit(first[0])))
    tab = F.instr("value", "\t")
    return lines.select(F.split_part("value", F.lit("\t"), F.lit(1)).alias("s1"), F.when(tab > 0, F.expr("substring(value, instr(value, '\\t') + 1)")).alias("ids"))


def write_tsv(df: DataFrame, path: str, order: list[str], header: bool = True) -> None:
    """A TSV without quoting, sorted; its part files, in order, are one file with one header line."""
    fields = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    lines = df.select(F.lit(1).alias("part"), *keys, fields.alias("value"))
    if header:
        top = df.sparkSession.range(1).select(F.lit(0).alias("part"), *(F.lit(None).cast(lines.schema[f"k{i}"].dataType).alias(f"k{i}") for i in range(len(order))), F.lit("\t".join(df.columns)).alias("value"))
        lines = lines.union(top)
    written(lambda: lines.orderBy("part", *(f"k{i}" for i in range(len(order)))).select("value").write.mode("overwrite").text(path), path)


def written(write, path: str) -> None:
    """Run write; whatever fails is a FileWriteError."""
    try:
        write()
    except Exception as e:
        raise FileWriteError(f"can't write {path}") from e


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """One JSON object, written through Spark so that any store it knows will do."""
    spark.createDataFrame([(json.dumps(value, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def append_json(spark: SparkSession, path: str, value: dict) -> None:
    """One more line of a JSONL history."""
    spark.createDataFrame([(json.dumps(value, default=str),)], "value string").coalesce(1).write.mode("append").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def write_index(index, path: str) -> None:
    """Write a BM25 or vector index: each of its tables by block."""
    for name in index.__dataclass_fields__:
        getattr(index, name).write.mode("overwrite").partitionBy("block").parquet(f"{path}/{name}")


def read_index(spark: SparkSession, path: str, kind: type | None = None):
    """The index that write_index() wrote; kind is bm25.Index unless given."""
    from kinlink.operators.bm25 import Index

    kind = kind or Index
    return kind(*(spark.read.parquet(f"{path}/{n}") for n in kind.__dataclass_fields__))
