"""Readers and writers on small files with quotes, blanks, malformed rows and missing parts."""

import json

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinlink.operators import bm25, outputs, quality, validator, vector
from kinlink.plans import prepare
from kinlink.sources import tables

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_tsv_keeps_quoted_breaks_and_na(spark, put):
    path = put("a.tsv", HEAD + 'S1-1\t"Two\nlines ""quoted"""\t\tPeru\nS1-2\tNA\tMill Lane 4\tPeru\n')
    rows = {r.entity_id: r for r in tables.read_tsv(spark, path).collect()}
    assert rows["S1-1"].business_name == 'Two\nlines "quoted"' and rows["S1-1"].business_address == ""
    assert rows["S1-2"].business_name == "NA" and len(rows) == 2
    assert tables.read_tsv(spark, path, multiline=False).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_tsv(spark, path + ".none")


def test_record_sets_and_counts(spark, put, tmp_path):
    for i in (1, 2, 3):
        put(f"dev_source{i}.tsv", HEAD + "".join(f"S{i}-{k}\tname {k}\tstreet {k}\tPeru\n" for k in range(i)))
    rows = tables.read_records(spark, tables.split_files(str(tmp_path), "dev"))
    assert {(r.role, r.expected, r["count"]) for r in rows.groupBy("role", "expected").count().collect()} == {("Query", "S1", 1), ("Target", "S2", 2), ("Target", "S3", 3)}
    tables.assert_rows(rows, "expected", {"S1": 1, "S3": 3})
    with pytest.raises(AssertionError, match="S2"):
        tables.assert_rows(rows, "expected", {"S2": 5})
    written = prepare.run(spark, str(tmp_path), str(tmp_path / "out"), "dev", {"S1": 1, "S2": 2, "S3": 3}, str(tmp_path / "metrics"))
    assert written.count() == 6 and tables.discover_partitions(spark, str(tmp_path / "out")) == ["Peru"]
    assert tables.discover_partitions(spark, str(tmp_path / "out"), "role") == ["Query", "Target"]
    told = json.loads(spark.read.text(str(tmp_path / "metrics" / "history.jsonl")).first()[0])
    assert told["source_files"]["S3"] == {"input_rows": 3, "output_rows": 3, "match": True} and told["partition_counts"] == {"Peru": {"Query": 1, "Target": 5}}
    assert told["length_percentiles"]["Peru"]["name"]["P50"] == 6.0 and told["has_address_rate"]["by_source"]["S2"] == 1.0
    with pytest.raises(FileNotFoundError):
        tables.discover_partitions(spark, str(tmp_path / "metrics"))


def test_wrong_prefix(spark, put, tmp_path):
    for i in (1, 2, 3):
        put(f"bad_source{i}.tsv", HEAD + "S1-9\tname\tstreet\tPeru\n")
    with pytest.raises(Exception, match="unexpected prefix"):
        prepare.process(tables.read_records(spark, tables.split_files(str(tmp_path), "bad"))).collect()


def test_cleaned_loader(spark, put):
    rows = tables.load_cleaned(spark, put("a.tsv", HEAD + "S1-1\tN/A\t -\tnone\nS1-2\tNable\tNull\tPeru\n")).orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [("S1-1", "", "", ""), ("S1-2", "Nable", "", "Peru")]
    for name, text in (("short.tsv", HEAD + "S1-1\tx\n"), ("long.tsv", HEAD + "S1-1\tx\ty\tz\tw\n"), ("head.tsv", "a,b,c,d\n1,2,3,4\n"), ("empty.tsv", "")):
        with pytest.raises(tables.InvalidFileFormatError):
            tables.load_cleaned(spark, put(name, text))
    with pytest.raises(tables.InvalidFileFormatError):
        tables.load_cleaned(spark, "/nowhere/at/all.tsv")


def test_any_input(spark, put, tmp_path):
    frame = pd.DataFrame({"k": [1, 2], "v": ["a", "b"]})
    path = str(tmp_path / "p")
    spark.createDataFrame(frame).write.parquet(path)
    assert all(tables.read_any(spark, x).count() == 2 for x in (path, frame, pa.Table.from_pandas(frame), spark.createDataFrame(frame), put("c.csv", "k,v\n1,a\n2,b\n"), put("c.tsv", "k\tv\n1\ta\n2\tb\n"), put("c.txt", "k\tv\n1\ta\n2\tb\n")))
    (tmp_path / "none").mkdir()
    for wrong, error in ((str(tmp_path / "none"), FileNotFoundError), (str(tmp_path / "gone"), FileNotFoundError), ("x.json", ValueError), (3, TypeError)):
        with pytest.raises(error):
            tables.read_any(spark, wrong)


def test_truth(spark, put):
    rows = tables.read_truth(spark, put("t.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-4\nS1-2\t\n"))
    assert {tuple(r) for r in rows.collect()} == {("S1-1", "S2-1,S3-4"), ("S1-2", "")}


def test_state_log(spark, put, tmp_path):
    line = json.dumps({"S1-7": {"accepted": ["S2-3"], "rejected": ["S3-1", "S2-9"], "per_cycle": {"1": ["S2-3", "S3-1"], "10": ["S2-9"]}}})
    log = put("log/part.jsonl", f"{line}\n\n{{broken\n" + '{"S1-8": {"accepted": [], "rejected": [], "per_cycle": {}}}\n')
    state = tables.read_state(spark, log)
    assert {r.s1 for r in state.collect()} == {"S1-7", "S1-8"}
    todo = spark.createDataFrame([("S1-7",), ("S1-9",)], "s1 string")
    assert [r.s1 for r in tables.unfinished(todo, log).collect()] == ["S1-9"]
    assert tables.read_state(spark, str(tmp_path / "gone")).count() == 0
    asked = spark.createDataFrame([("S1-7", "S3-1"), ("S1-7", "S3-2"), ("S1-9", "S3-1")], "s1 string, cand string")
    assert {(r.s1, r.cand): r.seen for r in outputs.has_been_seen(state, asked).collect()} == {("S1-7", "S3-1"): True, ("S1-7", "S3-2"): False, ("S1-9", "S3-1"): False}
    again = str(tmp_path / "again")
    tables.append_state(state, again)
    assert {json.dumps(json.loads(r[0]), sort_keys=True) for r in spark.read.text(again).collect()} == {json.dumps(x, sort_keys=True) for x in ({"S1-7": {"accepted": ["S2-3"], "rejected": ["S2-9", "S3-1"], "per_cycle": {"1": ["S2-3", "S3-1"], "10": ["S2-9"]}}}, {"S1-8": {"accepted": [], "rejected": [], "per_cycle": {}}})}
    paths = outputs.write_state_results(spark, log, str(tmp_path / "results"))
    read = {k: [r[0] for r in spark.read.text(v).collect()] for k, v in paths.items()}
    assert read["matching_results"] == ["source1_entity_id\tmatched_entity_ids", "S1-7\tS2-3", "S1-8\t"]
    assert read["candidate_pairs"][1:] == ["S1-7\tS2-3,S2-9,S3-1", "S1-8\t"]
    assert read["candidate_pairs_per_cycle"][1:] == ["S1-7\t1\tS2-3,S3-1", "S1-7\t10\tS2-9", "S1-8\t\t"]
    with pytest.raises(tables.FileWriteError):
        tables.append_state(state, put("file", "x") + "/under")


def test_results_keep_what_follows_tabs(spark, put):
    header = validator.HEADERS["matching"]
    rows = tables.read_results(spark, put("r.tsv", f"{header}\nS1-1\tS2-1\tS2-2\nS1-2\nS1-3\t\n\n"), header).collect()
    assert {tuple(r) for r in rows} == {("S1-1", "S2-1\tS2-2"), ("S1-2", None), ("S1-3", "")}
    for text in ("", "source1_entity_id,matched_entity_ids\n", "a\tb\n"):
        with pytest.raises(tables.InvalidFileFormatError):
            tables.read_results(spark, put("bad.tsv", text), header)


def test_many_part_files_are_one_table(spark, tmp_path):
    rows = spark.range(5000).select(F.format_string("S1-%05d", "id").alias("source1_entity_id"), F.lit("x").alias("matched_entity_ids")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    tables.write_tsv(rows, str(tmp_path / "t"), ["source1_entity_id"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "t").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert len(parts) > 1 and lines[0] == validator.HEADERS["matching"] and lines[1:] == sorted(lines[1:]) and len(lines) == 5001


def test_indexes(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x", f"mill lane {i}", [float(i), 1.0]) for i in range(6)], "id int, b string, t string, v array<double>")
    built = bm25.build(rows, "b", "id", "t")
    tables.write_index(built, str(tmp_path / "lex"))
    made, read = (bm25.search(rows, i, "b", "id", "t", 3).orderBy("q", "rank").collect() for i in (built, tables.read_index(spark, str(tmp_path / "lex"))))
    assert [(r.q, r.doc, r.score) for r in made] == [(r.q, r.doc, r.score) for r in read]
    tables.write_index(vector.build(rows, "b", "id", "v"), str(tmp_path / "vec"))
    index = tables.read_index(spark, str(tmp_path / "vec"), vector.Index)
    made, read = (vector.search(rows, c, "b", "id", "v", 2).orderBy("q", "rank").collect() for c in (rows, index))
    assert [tuple(r) for r in made] == [tuple(r) for r in read]


def test_samples(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") < 100, 1).otherwise(0).alias("label"), F.col("id").cast("string").alias("s1_id"), F.lit("c").alias("cand_id"))
    for ratio in (0.1, 0.5, 0.0001):
        kept = quality.negative_sample(rows, ratio)
        assert kept.where("label = 1").count() == 100 and kept.where("label = 0").count() == max(1, round(2900 * ratio)) and kept.distinct().count() == kept.count()
    same = rows.withColumn("s1_id", F.lit("one"))
    assert quality.negative_sample(same, 0.25).where("label = 0").count() == 725
    assert quality.head_sample(rows, "g", "id", 2).count() == 6 and quality.spot_sample(rows, "id").count() == 50
    assert [r.id for r in quality.systematic_sample(rows, "g", "id", 100).where("g = 1").orderBy("id").collect()] == list(range(1, 3000, 30))


def test_spot_sample_export(spark, tmp_path):
    rows = spark.range(200).select(F.format_string("S2-%03d", "id").alias("entity_id"), F.lit("tab\there").alias("name"))
    quality.export_spot_sample(rows, "entity_id", str(tmp_path / "spot"), 7)
    lines = [r[0] for r in spark.read.text(str(tmp_path / "spot")).collect()]
    assert lines[0] == "entity_id\tname" and len(lines) == 8 and lines[1:] == sorted(lines[1:])


def test_chunks(spark, tmp_path):
    pairs = spark.range(1000).select(F.concat(F.lit("S1-"), F.col("id") % 90).alias("s1_id"), F.col("id").alias("cand_id"))
    tables.write_chunks(pairs, str(tmp_path / "c"), 20)
    read = spark.read.parquet(str(tmp_path / "c"))
    assert read.count() == 1000 and read.groupBy("s1_id").agg(F.count_distinct("chunk").alias("n")).where("n > 1").count() == 0
    found = tables.list_files(spark, str(tmp_path / "c" / "chunk=*" / "*.parquet"))
    assert found == sorted(found) and 1 < len(found) <= 5


def test_faults(spark):
    rows = spark.createDataFrame([("a", "x", "न", "n", True, "Devanagari"), ("a", "x", " ", "é", True, "Devanagari"), ("b", "x", "o�", None, False, "Latin")], "entity_id string, country string, name_for_faiss string, name_for_bm25 string, is_cross_script boolean, script string")
    r = quality.processed_faults(rows).first()
    assert (r.n, r.repeated_ids, r.blank_name_for_faiss, r.blank_name_for_bm25, r.replaced_name_for_faiss, r.replaced_name_for_bm25, r.leaked) == (3, 1, 1, 1, 1, 0, 1)
