import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinlink import queries
from kinlink.config import Config
from kinlink.operators import bm25, features, merge, metrics, outputs, vector


def test_bm25_ties_and_k(spark, monkeypatch):
    made = [(i, 1, t) for i, t in enumerate(["willow", "willowherb", "oak", "willow", "ash", "elm", "fir"])]
    rows = spark.createDataFrame(made, "id int, b int, t string")
    asked = spark.createDataFrame([(9, 1, "willow"), (8, 1, "zzz"), (7, 2, "willow")], "id int, b int, t string")
    got = bm25.search(asked, bm25.build(rows, "b", "id", "t"), "b", "id", "t", 5).orderBy("rank").collect()
    assert [(r.q, r.doc) for r in got] == [(9, 0), (9, 3), (9, 1)] and got[0].score == got[1].score > got[2].score > 0
    monkeypatch.setattr(bm25, "HEAVY", 1)  # every token in as many parts as it has documents
    parts = bm25.search(asked, bm25.build(rows, "b", "id", "t"), "b", "id", "t", 5).orderBy("rank").collect()
    assert [tuple(r) for r in parts] == [tuple(r) for r in got]
    with pytest.raises(ValueError):
        bm25.search(asked, None, "b", "id", "t", 0)


def plain_fbeta(rows, t, beta):
    scores = []
    for s1 in {r[0] for r in rows}:
        mine = [(y, p > t) for s, _, y, p in rows if s == s1]
        tp, fp, fn = (sum((y, q) == z for y, q in mine) for z in ((1, True), (0, True), (1, False)))
        precision, recall = tp / (tp + fp) if tp + fp else 0, tp / (tp + fn) if tp + fn else 0
        both = beta * beta * precision + recall
        scores.append(1.0 if not tp + fp + fn else (1 + beta * beta) * precision * recall / both if both else 0.0)
    return sum(scores) / len(scores)


@pytest.mark.parametrize("beta", [0.5, 1.0, 2.0])
def test_macro_fbeta(spark, beta):
    rng = random.Random(beta)
    made = [(f"e{i % 23}", i, int(rng.random() < 0.3), rng.choice((0.1, 0.5, 0.55, 0.9))) for i in range(140)] + [("none", 1, 0, 0.2), ("edge", 2, 1, 0.5)]
    rows = spark.createDataFrame(made, "s1_id string, cand_id int, label int, prob double")
    assert metrics.entity_macro_fbeta(rows, 0.5, beta).first()[0] == pytest.approx(plain_fbeta(made, 0.5, beta))
    predicted = rows.where("prob > 0.5").selectExpr("s1_id as s1", "cand_id as cand")
    truth = rows.where("label = 1").selectExpr("s1_id as s1", "cand_id as cand")
    entities = spark.createDataFrame([(s,) for s in {r[0] for r in made} | {"absent"}], "s1 string")
    n = entities.count()
    assert metrics.official_macro_fbeta(predicted, truth, entities, beta).first()[0] == pytest.approx((plain_fbeta(made, 0.5, beta) * (n - 1) + 1) / n)


def test_pair_expressions(spark):
    from kinlink.functions import text

    rng = random.Random(2)
    made = [(" ".join(rng.choice(["7", "mill", "lane", "x9", "12b", "quay"]) for _ in range(rng.randrange(6))), " ".join(rng.choice(["7", "mill", "lane", "9", "quay"]) for _ in range(rng.randrange(6)))) for _ in range(60)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(made)], "i int, a string, b string")
    p, q = text.tokens(F.col("a")), text.tokens(F.col("b"))
    digits = lambda s: {d for d in "".join(c if c.isdigit() else " " for c in s).split()}
    for r in rows.select("i", features.jaccard(p, q).alias("j"), features.containment(p, q).alias("c"), features.number_match(text.numbers(F.col("a")), text.numbers(F.col("b"))).alias("n"), features.length_ratio(F.col("a"), F.col("b")).alias("l")).collect():
        a, b = made[r.i]
        x, y, u, v = set(a.split()), set(b.split()), digits(a), digits(b)
        assert r.j == pytest.approx(len(x & y) / len(x | y) if x | y else 0) and r.c == pytest.approx(len(x & y) / min(len(x), len(y)) if x and y else 0)
        assert r.n == (-1 if bool(u) != bool(v) else int(bool(u) and u == v))
        assert r.l == pytest.approx(min(len(a), len(b)) / max(len(a), len(b)) if a or b else 0)


def test_cycles_match_the_loop(spark):
    rng, rows, want, config = random.Random(3), [], {}, Config(k_base=3, max_seen=9)
    for s1 in range(40):
        streams = {s: rng.sample(range(30), rng.randint(0, 20)) for s in merge.STREAMS}
        rows += [(s1, c, s, r + 1) for s, cands in streams.items() for r, c in enumerate(cands)]
        seen: dict[int, int] = {}
        cycle = 0
        while len(seen) < 9:
            cycle, new = cycle + 1, {}
            for cands in streams.values():
                new |= dict.fromkeys([c for c in cands[: 3 + len(seen)] if c not in seen][:3], cycle)
            if not new:
                break
            seen |= new
        want |= {(s1, c): k for c, k in seen.items()}
    got = merge.cycles(spark.createDataFrame(rows, "s1 int, cand int, stream string, rank int"), config).collect()
    assert {(r.s1, r.cand): r.cycle for r in got} == want


def test_seen_state_and_outputs(spark):
    u = spark.createDataFrame([("e", "k", 2, False, 9), ("e", "k", 3, True, 11), ("e", "b", 2, True, 4), ("e", "a", 10, True, 5), ("e", "b", 1, False, 6)], "s1 string, cand string, cycle int, accepted boolean, seq long")
    r = outputs.seen_state(u).first()
    assert (r.accepted, r.rejected, r.per_cycle) == (["a", "b"], ["k"], {"2": ["b", "k"], "10": ["a"]})
    seen = spark.createDataFrame([("m", "z", 1, True), ("m", "c", 2, True), ("m", "q", 1, False)], "s1 string, cand string, cycle int, accepted boolean")
    both = spark.createDataFrame([("m",), ("n",)], "s1 string")
    assert sorted(map(tuple, outputs.matching_results(both, seen).collect())) == [("m", "c,z"), ("n", "")]
    assert sorted(map(tuple, outputs.candidate_pairs(both, seen).collect())) == [("m", "c,q,z"), ("n", "")]


def test_vectors(spark):
    rows = spark.createDataFrame([(1, 1, [3.0, 4.0, 0.0]), (2, 1, [0.0, 0.0, 0.0]), (3, 1, None)], "id int, b int, v array<double>")
    assert rows.where("id = 1").select(vector.unit(F.col("v"))).first()[0] == pytest.approx([0.6, 0.8, 0.0])
    got = vector.search(rows, rows.where("id < 3"), "b", "id", "v", 5).collect()
    assert {r.q for r in got} == {1}


@pytest.mark.parametrize("tile", [7, 4096])
def test_vector_search_against_a_full_sort(spark, tile):
    rng = random.Random(6)
    made = [(i, i % 3, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(90)]
    rows = spark.createDataFrame(made, "id int, b int, v array<double>")
    want = set()
    length = lambda v: sum(x * x for x in v) ** 0.5
    for i, b, v in made:
        if any(v):
            scored = sorted((-round(sum(p * q for p, q in zip(v, w, strict=True)) / length(v) / (length(w) or 1), 6), j) for j, c, w in made if c == b)
            want |= {(i, j, rank + 1) for rank, (_, j) in enumerate(scored[:6])}
    assert {(r.q, r.doc, r["rank"]) for r in vector.search(rows, rows, "b", "id", "v", 6, tile).collect()} == want


def test_training_round_trip(spark, tmp_path):
    from kinlink.ml import train

    rng = random.Random(1)
    rows = []
    for e in range(24):
        for c in range(6):
            y = int(c == 0 and e % 5 > 0)
            rows.append((f"S1-{e}", f"S2-{e}-{c}", *[0.7 * y + 0.3 * rng.random() for _ in features.NUMERIC], "us" if e % 2 else "india", y))
    schema = "s1_id string, cand_id string, " + ", ".join(f"{f} double" for f in features.NUMERIC) + f", {features.COUNTRY} string, label int"
    table = spark.createDataFrame(rows, schema)
    told = train.train(table, str(tmp_path / "m"), "monotone", Config(trials=1, folds=2))
    model, read = train.load(spark, str(tmp_path / "m"))
    assert told["score"] > 0.8 and read["threshold"] == told["threshold"] and len(told["params"]) == 8
    probs = [r.prob for r in train.scored(model, train.standardize(table)).orderBy("s1_id", "cand_id").collect()]
    assert len(probs) == len(rows) and len(set(probs)) > 1
    summary = json.loads(spark.read.text(str(tmp_path / "m" / "summary")).first()[0])
    assert summary["dataset"]["n_positive"] == sum(r[-1] for r in rows) and summary["phase_c_calibration"]["optimal_threshold"] == told["threshold"]
    with pytest.raises(ValueError, match="missing"):
        train.standardize(spark.createDataFrame([(1,)], "s1_id int"))
    with pytest.raises(NotImplementedError):
        train.classifier("lightgbm", {}, 1)
    logger = train.run_logger(str(tmp_path / "logs"), "x")
    logger.info("told")
    assert (tmp_path / "logs" / "train_x.log").read_text().endswith("told\n")


def test_linear_model_and_pruning(spark):
    from kinlink.ml import train

    rng = random.Random(5)
    rows = [(f"S1-{e}", f"S2-{c}", *[rng.random() for _ in features.NUMERIC], "us", int(c == 0), 1.0, e % 2) for e in range(10) for c in range(4)]
    table = spark.createDataFrame(rows, "s1_id string, cand_id string, " + ", ".join(f"{f} double" for f in features.NUMERIC) + f", {features.COUNTRY} string, label int, weight double, fold int")
    weights = train.fit(table, "linear", {"rounds": 20}, Config()).stages.stages[-1].coefficients
    assert all(w >= -1e-9 for w, m in zip(weights, train.MONOTONE, strict=True) if m)
    _, trials = train.search(table, 2, "monotone", Config(trials=6, encoder_folds=2))
    assert len(trials) == 6 and all(len(t["fold_scores"]) == (1 if t["state"] == "pruned" else 2) for t in trials)


def test_booster_rises_and_learns(spark, monkeypatch):
    from kinlink.ml import booster

    rng = np.random.default_rng(0)
    x = rng.random((1500, 3))
    p = 1 / (1 + np.exp(-(6 * x[:, 0] - 3 + 2 * np.sin(9 * x[:, 1]))))
    y = (rng.random(1500) < p).astype(int)
    table = spark.createDataFrame([(*map(float, r), int(t), 1.0) for r, t in zip(x, y, strict=True)], "a double, b double, c double, label int, weight double").repartition(3).persist()
    model = booster.fit(table, ["a", "b", "c"], [True, False, True], rounds=25, depth=3)
    got = table.select("label", model.probability().alias("p")).collect()
    loss = -sum(math.log(r.p if r.label else 1 - r.p) for r in got) / len(got)
    assert loss < -np.where(y == 1, np.log(p), np.log(1 - p)).mean() + 0.05
    grid = model.binned([rng.random(200) for _ in range(3)])
    for f in (0, 2):
        steps = []
        for v in range(64):
            at = grid.copy()
            at[:, f] = v
            steps.append(model.margins(at))
        assert all((b >= a - 1e-12).all() for a, b in zip(steps[:-1], steps[1:], strict=True))
    again = booster.Booster.from_description(json.loads(json.dumps(model.described())))
    assert (again.margins(grid) == model.margins(grid)).all()
    monkeypatch.setattr(booster, "LOCAL", 0)  # the same sums in Spark
    spread = booster.fit(table, ["a", "b", "c"], [True, False, True], rounds=2, depth=3)
    assert all(s.feature == t.feature and np.allclose(s.value, t.value) for s, t in zip(spread.trees, model.trees, strict=False))
    assert booster.fit(table.where("label = 0"), ["a"], [True]).trees == [] and booster.fit(table.limit(0), ["a"], [True]).trees == []
    table.unpersist()


def test_training_parts(spark):
    from kinlink.ml import train

    names = {"dim_1_name_jaro_winkler": ["name_jaro_winkler"], "dim_7_semantic_cosine": ["name_semantic_cosine", "dim_7_name_semantic_cosine"], "dim_16_rrf_score": ["rrf_score", "dim_16_rrf"]}
    for to, others in names.items():
        assert all(train.ALIASES[o] == to for o in others)
    assert len(train.ALIASES) == 48 and set(train.ALIASES.values()) <= {*features.FEATURES, "s1_id", "cand_id", "label"}
    given = {to: c for c, to in train.ALIASES.items()}  # the last other name of each column
    columns = [given.get(f, f) for f in ("s1_id", "cand_id", "label", *features.FEATURES)]
    frame = spark.createDataFrame([tuple("1" for _ in columns)], ", ".join(f"{c} string" for c in columns))
    made = train.standardize(frame)
    assert made.columns == ["s1_id", "cand_id", *features.FEATURES, "label"] and made.first()["dim_16_rrf_score"] == 1.0
    rows = spark.createDataFrame([(f"e{i % 13}", f"c{i}", "p" if i % 4 else "q", int(i % 3 == 0)) for i in range(80)], f"s1_id string, cand_id string, {features.COUNTRY} string, label int")
    dealt, n = train.with_folds(rows, 5, 1)
    per = dealt.select("s1_id", "fold").distinct().groupBy("fold").count().collect()
    assert n == 5 and dealt.count() == 80 and sorted(r["count"] for r in per) == [2, 2, 3, 3, 3]
    marked = rows.withColumn("part_", F.pmod(F.xxhash64("s1_id", "cand_id", F.lit(1)), F.lit(4))).collect()
    got = {r.cand_id: r.country_mean for r in train.cross_fitted(rows, 4, 1).collect()}
    for r in marked:
        others = [x.label for x in marked if x[features.COUNTRY] == r[features.COUNTRY] and x.part_ != r.part_]
        assert got[r.cand_id] == pytest.approx(sum(others) / len(others))


def test_seen_stream(spark, tmp_path):
    from kinlink.sources import tables
    from kinlink.streaming import seen_state

    first = [("a", "x", 2, True, False, False, 1), ("a", "x", 3, False, False, False, 2), ("a", "w", 10, False, False, False, 3), ("b", None, None, None, True, False, 4), ("b", None, None, None, True, False, 5), ("c", "k", None, True, False, False, 6)]
    then = [("a", "x", 4, False, False, False, 7), ("a", "v", 2, True, False, False, 8), ("a", None, None, None, False, True, 9), ("a", "y", 3, True, False, False, 10)]
    spark.createDataFrame(first, seen_state.UPDATES).coalesce(1).write.parquet(str(tmp_path / "in"))
    run = lambda: seen_state.keep(seen_state.track(seen_state.source(spark, str(tmp_path / "in"))), str(tmp_path / "log"), str(tmp_path / "c"), strict=False)
    q = run()
    q.processAllAvailable()
    q.stop()
    spark.createDataFrame(then, seen_state.UPDATES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = run()  # a restart goes on from the checkpoint
    q.processAllAvailable()
    q.stop()
    state = tables.read_state(spark, str(tmp_path / "log")).collect()
    assert [(r.s1, r.accepted, r.rejected, r.per_cycle) for r in state] == [("a", ["v", "x"], ["w"], {"2": ["x", "v"], "10": ["w"]})]
    events = seen_state.track(seen_state.source(spark, str(tmp_path / "in"), 9)).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "d")).start()
    events.processAllAvailable()
    events.stop()
    got = spark.table("seen")
    assert sorted((r.s1, r.event) for r in got.collect()) == [("a", "finalized"), ("a", "late"), ("a", "seen"), ("a", "seen"), ("a", "seen"), ("b", "active"), ("c", "malformed")]
    for event, error in (("late", seen_state.AlreadyFinalizedError), ("active", seen_state.AlreadyActiveError), ("malformed", TypeError)):
        with pytest.raises(error):
            seen_state.raise_late(got.where(F.col("event") == event))


def test_candidates(spark):
    from kinlink.operators import blocking

    cases = [("4 Mill Ln, Tarn, Ohio, OH", "tarn"), ("Old  Quay , 4711", "old quay"), ("OHIO, 12", None), ("", None), (None, None)]
    rows = spark.createDataFrame([(i, 1, a) for i, (a, _) in enumerate(cases)], "id int, b int, a string")
    assert [r.c for r in rows.orderBy("id").select(blocking.city(F.col("a"), ("Ohio",)).alias("c")).collect()] == [c for _, c in cases]
    assert [tuple(r) for r in blocking.city_candidates(rows, rows, "b", "id", "a", ("Ohio",)).orderBy("q").collect()] == [(1, 0, 0), (1, 1, 1)]
    rng = random.Random(3)
    made = [(i, i % 2, "".join(rng.choice("abcde ") for _ in range(30)) if i % 3 else "mill lane tarn bridge" + "x" * (i % 7)) for i in range(60)] + [(90, 0, ""), (91, 1, None)]
    table = spark.createDataFrame(made, "id int, b int, t string")
    grams = {i: {t[k : k + 3] for k in range(max(1, len(t) - 2))} if t else set() for i, _, t in made}
    near = {(i, j) for i, b, _ in made for j, c, _ in made if b == c and grams[i] and grams[j] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])}
    got = {(r.q, r.doc): r.jaccard for r in blocking.minhash_candidates(table, table, "b", "id", "t", 0.8).collect()}
    assert set(got) == near and all(got[p] == pytest.approx(len(grams[p[0]] & grams[p[1]]) / len(grams[p[0]] | grams[p[1]])) for p in got)
    parts, whole = (sorted(map(tuple, blocking.tfidf_candidates(table, table, "b", "id", "t", 4, heavy).collect())) for heavy in (2, 10**6))
    assert parts == whole and all(r[3] == 1.0 for r in whole if r[4] == 1)


def test_minhash_compares_copies_once(spark, monkeypatch):
    from kinlink.operators import blocking

    made = [(i, i % 2, ("Mill Lane", "mill lanes", "tarn bridge")[i % 3] if i < 36 else ("", None, "mill lane")[i % 3]) for i in range(48)] + [(3, 1, "mill lane"), (3, 1, "mill lanes"), (None, 1, "Tarn Bridge"), (5, None, "tarn bridge")]
    table = spark.createDataFrame(made, "id int, b int, t string")
    seen, real = spark.sparkContext.accumulator(0), blocking.jaccard

    @F.pandas_udf("double")
    def counted(x: pd.Series) -> pd.Series:
        seen.add(len(x))
        return x

    monkeypatch.setattr(blocking, "jaccard", lambda a, b: counted(real(a, b)))
    got = [tuple(r) for r in blocking.minhash_candidates(table, table, "b", "id", "t").collect()]
    assert 0 < seen.value <= 2 * 18  # pairs of texts, for the filter and the value; not of rows, nor once a band
    monkeypatch.setattr(blocking, "jaccard", real)
    grams = {i: {t.lower()[k : k + 3] for k in range(len(t) - 2)} if t else set() for i, (_, _, t) in enumerate(made)}
    share = lambda i, j: len(grams[i] & grams[j]) / len(grams[i] | grams[j])
    near = {(b, p, q, share(i, j)) for i, (p, b, _) in enumerate(made) for j, (q, c, _) in enumerate(made) if b is not None and b == c and grams[i] and grams[j] and share(i, j) >= 0.5}
    assert sorted(got, key=str) == sorted(near, key=str)
    with monkeypatch.context() as m:
        m.setattr(blocking, "TILE", 3)
        assert sorted(map(tuple, blocking.minhash_candidates(table, table, "b", "id", "t").collect()), key=str) == sorted(near, key=str)
    links, asked, docs = blocking.minhash_classes(table, table, "b", "id", "t")
    of = [{(r.block, r.key): r["class"] for r in side.collect()} for side in (asked, docs)]
    pairs = {tuple(r) for r in links.collect()}
    spread = {(b, p, q, j) for (b, p), x in of[0].items() for (c, q), y in of[1].items() for d, u, v, j in pairs if b == c == d and (x, y) == (u, v)}
    assert spread == near and len(pairs) < len(near) / 8


def test_cosines_of_pairs_are_taken_tile_by_tile(spark):
    rng = np.random.default_rng(5)
    made = [[(i, i % 2, [float(x) for x in rng.integers(0, 3, 6)]) for i in range(n)] for n in (9, 23)]
    made[0][4] = (4, 0, [0.0] * 6)
    asked, docs = (spark.createDataFrame(m, "id long, b int, v array<double>") for m in made)
    asked = asked.select(F.col("b").alias("block"), F.col("id").alias("q"), vector.unit(F.col("v")).alias("vec_a"))
    docs = docs.select(F.col("b").alias("block"), F.col("id").alias("doc"), vector.unit(F.col("v")).alias("vec_b"), F.concat(F.lit("n"), "id").alias("name_b"))
    pairs = asked.join(docs, "block").where((F.col("q") + F.col("doc")) % 3 != 0).select("block", "q", "doc", (F.col("q") * 100).alias("more"))
    want = pairs.join(asked, ["block", "q"]).join(docs, ["block", "doc"]).select("block", "q", "doc", "more", "name_b", vector.cosine_feature(F.col("vec_a"), F.col("vec_b")).alias("cosine"))
    met = vector.with_cosines(pairs, asked, docs, 2, 5)
    assert met.columns == want.columns and sorted(map(tuple, met.collect())) == sorted(map(tuple, want.collect())) and want.count() > 60
    for bad in (F.lit(None).cast("array<double>"), F.array(F.lit(float("nan"))), F.array(F.lit(1.0))):
        with pytest.raises(Exception, match="null, non-finite or of unequal length"):
            vector.with_cosines(pairs, asked, docs.withColumn("vec_b", F.when(F.col("doc") == 7, bad).otherwise(F.col("vec_b")))).collect()


def test_pairs_carry_no_vectors(spark):
    from kinlink.plans import resolve

    rows = spark.createDataFrame([(i, i % 2, f"acme {i % 5} mill", f"{i} lane", False, "S2") for i in range(12)], "id long, country int, name string, addr string, is_cross_script boolean, source string")
    got = resolve.candidates(rows, rows, Config(k_base=2, max_seen=4))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and not any("vec_a" in x and "vec_b" in x for x in plan.splitlines())
    vectors = {r.id: np.array(r.vec) for r in resolve.hashed_vectors(rows, "name").collect()}
    share = lambda a, b: vectors[a] @ vectors[b] / np.linalg.norm(vectors[a]) / np.linalg.norm(vectors[b])
    found = got.select("s1", "cand", "dim_7_semantic_cosine").collect()
    assert len(found) > 24 and all(r[2] == pytest.approx(min(1, share(r.s1, r.cand)), abs=1e-6) for r in found)


def test_every_oracle_has_a_query():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_best_documents_of_a_hot_block_go_by_tiles(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "b", f"abc{i % 7}xyz{i % 3}") for i in range(60)], "id long, b string, t string")
    index = bm25.build(rows, "b", "id", "t")
    whole = bm25.search(rows, index, "b", "id", "t", 9)
    assert "FlatMap" not in (plan := whole._jdf.queryExecution().toString()) and "MapInArrow" in plan
    monkeypatch.setattr(bm25, "HEAVY", 7)
    monkeypatch.setattr("kinlink.operators.best.ASKED", 11)
    monkeypatch.setattr("kinlink.operators.best.CELLS", 20)
    parts = bm25.search(rows, index, "b", "id", "t", 9)
    got = sorted(map(tuple, parts.collect()))
    assert len(got) == 540 and got == sorted(map(tuple, whole.collect()))


def test_search_by_tokens_holds_no_tile_as_a_list(spark):
    made = [(i, "b" if i % 4 else "c", f"abc{i % 7}xyz{i % 3}" if i % 9 else None) for i in range(90)] + [(5, "b", "xyz1abc5"), (95, None, "abc1xyz1")]
    rows = spark.createDataFrame(made, "id long, b string, t string")
    found = bm25.search(rows, bm25.build(rows, "b", "id", "t"), "b", "id", "t", 6)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # texts of a key are gathered before they are cut into tokens; no row a token is joined
    assert not any(x in line for line in plan.splitlines() for x in ("collect_list(struct", "tf#")) and "first(" not in plan
    texts = defaultdict(lambda: defaultdict(list))
    for i, b, t in made:
        if b:
            texts[b][i] += [t[k : k + 3] for k in range(len(t) - 2)] if t else []
    want = {}
    for b, of in texts.items():
        n = sum(x[1] == b for x in made)
        average = sum(map(len, of.values())) / n
        df = Counter(g for x in of.values() for g in set(x))
        raw = {g: math.log(n - c + 0.5) - math.log(c + 0.5) for g, c in df.items()}
        idf = {g: x if x >= 0 else 0.25 * sum(raw.values()) / len(raw) for g, x in raw.items()}
        for i, x in of.items():
            scores = {j: sum(idf[g] * (tf := y.count(g)) * 2.5 / (tf + 1.5 * (0.25 + 0.75 * 6 / average)) for g in x if g in y) for j, y in of.items()}
            want |= {(b, i, j): s for s, j in sorted((-round(s, 6), j) for j, s in scores.items() if round(s, 6) > 0)[:6]}
    got = {(r.block, r.q, r.doc): -r.score for r in found.collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 2e-6 for p in got)


def test_drawn_pairs_need_one_shuffle_of_hits(spark):
    rng = random.Random(9)
    made = [(s, c, stream, k + 1, float(50 - k)) for s in range(12) for stream in merge.STREAMS if (s, stream) != (3, "addr") for k, c in enumerate(rng.sample(range(60), 30))]
    hits = spark.createDataFrame(made, "s1 long, cand long, stream string, rank int, score double")
    config = Config(k_base=4, max_seen=15)
    want = merge.merged(hits, config).join(merge.cycles(hits, config), ["s1", "cand"])
    for parts in (None, 3):
        got = merge.drawn(hits, config, parts)
        assert set(got.columns) == set(want.columns) and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 150
