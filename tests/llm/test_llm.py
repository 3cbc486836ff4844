"""Operators against brute force on small tables with nulls, empties, repeats, ties and clashing columns."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kinlink.llm import automata, bpe, graph, hnsw, packing, quality, queries, repeats, secrets, similar, simhash, store, suffix, urls

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"w{i}" for i in range(60))
TEXTS = [(1, "alpha " * 5 + PASSAGE), (2, PASSAGE + " omega"), (3, None), (4, ""), (5, "alpha " * 5 + PASSAGE), (6, "a" * 3000), (7, "é" * 60), (7, "é" * 60), (None, PASSAGE + " omega"), (8, "x <|endoftext|> it's  \n\n9"), (9, "token = 'abcdefghijkl.mn' AKIAABCDEFGHIJKLMN1 0123456789abcdef0 k9Xk2LmQ7vR4tZ8wB3nJ6y")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, key long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if i == 2 else "en", None if i == 4 else f"s{(i or 0) % 2}", len(t or ""), "x", 0) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module", autouse=True)
def small_batches():
    kept = repeats.BATCH, repeats.SHARD, repeats.BUCKET, suffix.ARRAY_BYTES, automata.AUTOMATON_WORDS
    repeats.BATCH = repeats.SHARD = repeats.BUCKET = 1 << 11
    suffix.ARRAY_BYTES, automata.AUTOMATON_WORDS = 500, 100
    yield
    repeats.BATCH, repeats.SHARD, repeats.BUCKET, suffix.ARRAY_BYTES, automata.AUTOMATON_WORDS = kept


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, x) for x in t[:1]) + (str(t),))


def expected(made):
    return sorted(made, key=lambda t: tuple((x is not None, x) for x in t[:1]) + (str(t),))


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def test_tokens(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    made, trips = [], []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        made.append((i, len((t or "").encode()), len(ids), len(ids) > 512))
        trips.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert rows(bpe.count_tokens(docs, path)) == expected(made)
    assert rows(bpe.encode_digests(docs, path)) == expected(trips)


def test_suffix_dedup(docs):
    least = {}
    for i, t in TEXTS:
        b = (t or "").encode()
        for k in range(len(b) - 49 if i is not None else 0):
            least[b[k : k + 50]] = min(least.get(b[k : k + 50], i), i)
    made = []
    for i, t in TEXTS:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49 if i is not None else 0):
            if least[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        made.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    assert rows(suffix.remove_repeats_digests(docs)) == expected(made)


def test_substring_dedup(docs):
    words = [WORDS.findall(t or "") for _, t in TEXTS]
    counts = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    made = []
    for (i, _), w in zip(TEXTS, words, strict=True):
        gone = bytearray(len(w))
        for k in range(len(w) - 34):
            if counts[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = b"\1" * 35
        made.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode())))
    assert rows(automata.remove_phrases_digests(docs)) == expected(made)


def test_simhash(docs):
    prints = {}
    for i, t in TEXTS:
        w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints[t] = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
    parent = {p: p for p in prints.values()}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in list(parent):
        for b in list(parent):
            if (a ^ b).bit_count() <= 2:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, t in TEXTS:
        if i is not None:
            least[root(prints[t])] = min(least.get(root(prints[t]), i), i)
    made = [(i, f"{prints[t]:016x}", least.get(root(prints[t]))) for i, t in TEXTS]
    assert rows(simhash.near_groups(docs)) == expected(made)


def test_quality_counts(docs):
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    text = dict(TEXTS)[9]
    assert got[9].n_words == len(WORDS.findall(text)) and got[9].base_failed and not got[9].kept
    assert got[3].n_words == 0 and not got[3].kept and got[2].kept
    assert got[1].word_chars == sum(map(len, WORDS.findall(dict(TEXTS)[1])))
    assert quality.quality(docs.limit(0)).count() == 0


def test_quality_references(docs, monkeypatch):
    several = docs.unionByName(docs.withColumn("lang", F.lit("de")))
    judged = lambda: rows(quality.quality(several, min_chars=1, min_words=1, min_reference_docs=1))
    sent = judged()
    monkeypatch.setattr(quality, "BROADCAST_LANGUAGES", 0)
    assert judged() == sent


def prose(rng, lang, n, common=0.26):
    made = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(4, 9))) for _ in range(n)]
    made = [str(rng.choice(quality.COMMON_WORDS[lang])) if common and rng.random() < common else w for w in made]
    return " ".join(w + "." * (k % 9 == 8) for k, w in enumerate(made))


def test_quality_distances(spark):
    rng = np.random.default_rng(3)
    made = [(lang, lang, prose(rng, lang, int(n))) for lang in ("en", "de") for n in rng.integers(60, 300, 60)]
    made += [("junk", "en", prose(rng, "de", 120)), ("junk", "de", prose(rng, "fr", 60)), ("junk", "en", prose(rng, "en", 90, 0)), ("junk", "de", prose(rng, "de", 300, 0))]
    made += [("junk", "en", prose(rng, "en", n).replace(" ", " | ")) for n in (60, 150, 400)]
    table = spark.createDataFrame([(i, t, lang) for i, (_, lang, t) in enumerate(made)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.quality(table).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [got[i].kept for i in range(len(made))] == [kind != "junk" for kind, *_ in made]
    by_language = [i for i, r in got.items() if r.class_distance <= 0.18 and not r.kept]
    assert len(by_language) >= 4


def test_quality_rare_language(spark):
    rng = np.random.default_rng(5)
    far = lambda n: " ".join("".join(rng.choice(list("абвгдежзиклмнопрст"), rng.integers(4, 9))) for _ in range(n))
    made = [("en", prose(rng, "en", 120)) for _ in range(200)] + [("ru", far(100)) for _ in range(29)] + [("uk", far(100)) for _ in range(30)] + [(None, far(100))]
    table = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(made)], "doc_id long, text string, lang string")
    got = quality.quality(table).collect()
    assert all(r.kept for r in got)
    assert sum(r.class_distance is None for r in got) == 30


def test_secrets(docs):
    got = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    r = got[9]
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 1, 1) and r.spans.count("entropy") == 1
    assert r.base_sha256 == sha(",".join(r.spans.split(",")[:3]).encode()) and got[3].spans == ""
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    assert out.where("doc_id = 9").first().text == "[SECRET]' [SECRET] [SECRET] [SECRET]"


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.org/fr/x", '<a href="http://b.io/x"> <a href=http://c.io>'), (2, "http://b.io/", '<a href="https://D.io">'), (3, "http://e.com", '<a href="http://x.net/">'), (4, "HTTP://X.net/", None), (None, None, None), (5, "nourl", "x"), (6, "http://example.net/en/a?b", "")], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, damping=0.5, tolerance=1e-4).collect()}
    assert got == {1: ("a.org", "/fr/x", "org/fr/", "allow"), 2: ("b.io", "/", None, "allow"), 3: ("e.com", "", None, "block"), 4: ("x.net", "/", "net/", "block"), None: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("example.net", "/en/a", "example.net/en/", "allow")}


def test_urls_relative_to_scheme(spark):
    made = [(1, "http://a.com/", '<a href="//b.com/x?u=http://no.io/"> <a href=/own//path>'), (2, "http://b.com/", "<a href='HTTPS://C.com'>"), (3, "http://c.com/", "<a href=//x.net/>"), (4, "http://x.net/", "")]
    pages = spark.createDataFrame(made, "page_id long, url string, html string")
    assert {(r.src, r.dst) for r in urls.host_edges(pages).collect()} == {("a.com", "b.com"), ("b.com", "c.com"), ("c.com", "x.net")}
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, damping=0.5, tolerance=1e-4).collect()}
    assert got == dict.fromkeys(range(1, 5), "block")


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 16))
    made = [(i, (base[i % 12] + rng.normal(size=16) * 0.1).tolist(), i % 2) for i in range(200)]
    made += [(300, [0.0] * 16, 0), (301, None, 0), (302, [1.0] * 15 + [None], 1), (303, [float("nan")] * 16, 1), (304, base[0].tolist(), None), (305, base[0].tolist(), 0), (305, base[0].tolist(), 0)]
    real = [(i, np.array(v), l) for i, v, l in made if v and l is not None and None not in v and np.isfinite(v).all() and any(v)]
    unit = np.stack([v / np.linalg.norm(v) for _, v, _ in real])
    near = (unit @ unit.T >= 0.93) & np.equal.outer([l for *_, l in real], [l for *_, l in real]) & ~np.eye(len(real), dtype=bool)
    for shard_rows in (8192, 40):
        got = hnsw.near_vectors(spark.createDataFrame(made, "vec_id long, embedding array<double>, label int"), shard_rows=shard_rows).collect()
        links = {r.vec_id: r.n_links for r in got}
        assert len(got) == len(made) and all(links[i] == n for (i, *_), n in zip(real, near.sum(1), strict=True))
        assert all(links[i] == 0 for i in (300, 301, 302, 303, 304))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 200), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == dict.fromkeys(range(51), 0) | {100: 100, 200: 100}


def test_packing(docs):
    placed = packing.best_fit([(5, "a", 1), (4, "b", 2), (3, "a", 3), (3, None, 2), (1, None, None)], 8)
    assert placed == [(0, 0), (1, 0), (1, 1), (0, 1), (1, 2)]
    got = packing.pack(docs, capacity=100, with_text=True).collect()
    whole: dict = {}
    for r in got:
        whole.setdefault((r.doc_id, r.cluster), []).append(r)
    bins: dict = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        assert sum(r.length for r in b) <= 100
        for c in ("source", "cluster"):
            values = [getattr(r, c) for r in b if getattr(r, c) is not None]
            assert len(values) == len(set(values))
    assert sum(r.length for r in got) == sum(len(t or "") for _, t in TEXTS)
    six = sorted((r for r in got if r.doc_id == 6), key=lambda r: r.piece)
    assert "".join(r.text for r in six) == dict(TEXTS)[6]


def test_packing_near_copies(spark, tmp_path):
    base = [f"w{k}" for k in range(60)]
    made = [(i, " ".join([*base[:59], f"x{i}"])) for i in range(8)] + [(20 + i, " ".join(f"y{i}z{k}" for k in range(40))) for i in range(8)]
    spark.createDataFrame([(i, t, "en", f"s{i}", len(t)) for i, t in made], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op9_best_fit_packing"](spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in made)
    assert len({r.bin_id for r in got if r.doc_id < 20}) == 8 and len({r.cluster for r in got if r.doc_id < 20}) == 1
    assert len({r.cluster for r in got}) == 9 and all(0 < r.fill <= 1 for r in got)


def test_pipeline(spark, docs, tmp_path):
    prose = " ".join(f"{a}{b} the of and" for a in "bcdfg" for b in "aeiou") + "."
    long = [(20 + i, f"{prose} {chr(97 + i) * 3} {prose[::-1]}", "en", "s", 1, "x", 0) for i in range(3)]
    table = docs.unionByName(spark.createDataFrame(long, SCHEMA))
    now = table
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, str(tmp_path)).cache()
        assert name == "best_fit_packing" or after.columns == table.columns
        if name == "quality_rules":
            # too few documents for a reference: the base rules decide
            assert {r.doc_id for r in after.collect()} == {None, 1, 2, 5, 20, 21, 22}
        if name == "simhash_near_dedup":
            ids = [r.doc_id for r in after.collect()]
            assert 1 in ids and 5 not in ids
        now = after
    assert now.where("text is null and length > 0").count() == 0


def test_pipeline_keeps_what_leads_in_a_secret(spark):
    passage = "settings of the service are held in this file and nowhere else at all; "
    made = [(1, passage + "password=hunter2hunter2x end"), (2, "intro " + passage + "password=abcdefgh12345678 end"), (3, passage + "AKIA" + "B" * 20), (4, passage + "AKIA" + "C" * 20), (5, passage)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t), "x", 0) for i, t in made], SCHEMA)
    now = corpus_pipeline.secret_scan(spark, corpus_pipeline.suffix_dedup(spark, table, ""), "")
    got = {r.doc_id: r.text for r in now.collect()}
    assert "[SECRET]" in got[2] and "abcdefgh" not in got[2] and passage not in got[2]
    assert got[4].endswith("[SECRET]") and "CCC" not in got[4] and got[5] == ""


def test_pipeline_runs_and_leaves_only_its_result(spark, docs, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr(store, "shared_dir", lambda _: str(folder))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in got.collect()} == {1} and len(list(folder.glob("kinlink/*/*"))) == 1
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_local_folder_on_a_cluster(spark):
    class Away:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "x"})

    with pytest.raises(RuntimeError):
        store.shared_dir(Away)


def test_empty_tables(docs):
    none = docs.limit(0)
    path = public_tokenizers.path("byte_bpe_50k.json")
    for made in (bpe.count_tokens(none, path), bpe.encode(none, path), suffix.remove_repeats(none), automata.remove_phrases(none), simhash.near_groups(none), secrets.secrets(none), packing.pack(none)):
        assert made.count() == 0


def test_pipeline_near_copies(spark, monkeypatch):
    rng = np.random.default_rng(7)
    made = []
    for k in range(40):
        base = [f"w{x}" for x in rng.integers(0, 400, rng.integers(30, 300))]
        for _ in range(rng.integers(1, 7)):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, max(2, len(words) // 35))):
                words[at] = f"n{rng.integers(10**6)}"
            made.append("the same line opens many of them all " * (k % 3 == 0) + " ".join(words))
    made += [made[3], "", "", "one two", "One  two", "one two three"]
    table = spark.createDataFrame([(i, t, "en", "s", len(t), "x", 0) for i, t in enumerate(made)], SCHEMA)
    sets = []
    for t in made:
        w = WORDS.findall(t.lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    root = list(range(len(made)))
    pairs = [(i, j) for i in range(len(made)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for _ in made:
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    assert sum(sets[i] != sets[j] for i, j in pairs) > 50
    for heavy, bucket in ((similar.HEAVY, similar.BUCKET), (3, 900)):
        monkeypatch.setattr(similar, "HEAVY", heavy)
        monkeypatch.setattr(similar, "BUCKET", bucket)
        kept = corpus_pipeline.near_dedup(spark, table.union(table.limit(5)), "").collect()
        assert sorted(r.doc_id for r in kept) == sorted(set(root))


def test_near_copies_are_linked_by_fingerprints_and_long_sets_ruled_out_by_fine_counts(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 400, np.uint64)
    near = np.concatenate([base[:380], rng.integers(0, 1 << 63, 20, np.uint64)])
    other = rng.integers(0, 1 << 63, 400, np.uint64)
    fp = simhash.majority(np.concatenate([base, near, other]), np.array([0, 400, 800, 1200]))
    cells = [b"\1" * 5 * 3, np.arange(1, 4).astype("<i8").tobytes(), np.full(3, 400, "<i4").tobytes(), fp.tobytes()]
    table = pa.table([pa.array([0]), *(pa.array([c]) for c in cells)], names=["bucket", "token", "node", "n", "fp"])
    met = similar._met(table, 0.8).to_pylist()
    assert [(r["node"], r["other"]) for r in met if r["token"] is None] == [(1, 2)]
    # 8000 shingles each, the half in common: counts in 256 bins leave 0.8 possible, finer ones do not
    sets = np.sort(rng.integers(0, 1 << 63, (3, 4000), np.uint64) * np.uint64(2), axis=1)
    sides = [np.concatenate([sets[0], sets[k]]) for k in (1, 2)]
    fine = [similar._fine(s, np.array([0, 8000]))[0].as_py() for s in sides]
    coarse = [np.bincount((s >> np.uint64(56)).astype(int), minlength=256).clip(max=255).astype(np.uint8).tobytes() for s in sides]
    rows = [(1, 2, 8000, 8000, bytearray(coarse[0]), bytearray(coarse[k]), bytearray(fine[0]), bytearray(fine[k])) for k in (0, 1)]
    pairs = spark.createDataFrame(rows, "a long, b long, n_a int, n_b int, sketch_a binary, sketch_b binary, fine_a binary, fine_b binary")
    assert similar._bounded(pairs, 0.8).count() == 1


def test_nodes_whose_sizes_rule_out_all_others_of_a_token_stay_in_their_bucket():
    held = [(1, 100), (2, 124), (3, 400), (1, 100), (4, 1000)]  # at two tokens
    cells = [b"".join(t * 5 for t in (b"\1", b"\1", b"\1", b"\2", b"\2")), *(np.array(x).astype(t).tobytes() for x, t in zip(zip(*held), ("<i8", "<i4"))), np.zeros(5, "<u8").tobytes()]
    table = pa.table([pa.array([0]), *(pa.array([c]) for c in cells)], names=["bucket", "token", "node", "n", "fp"])
    assert sorted(r["node"] for r in similar._met(table, 0.8).to_pylist() if r["token"] is not None) == [1, 2]
    assert not [r for r in similar._met(table, 0.9).to_pylist() if r["token"] is not None]


def test_pairs_that_may_be_alike_leave_as_forests(spark):
    rng = np.random.default_rng(5)
    # 120 sets of 40 shingles that share 34 each: none is alike (34 of 46), but all counts leave it possible
    low = rng.integers(0, 1 << 56, (121, 6), np.uint64) + (np.arange(6, dtype=np.uint64) << np.uint64(56))
    base = rng.integers(0, 1 << 63, 34, np.uint64) * np.uint64(2)
    sets = [np.concatenate([base, x]) for x in low[:120]]
    sets.append(np.concatenate([sets[7][:39], low[120, :1]]))  # 39 of 41 in common with one of them
    sketch = [np.bincount((x >> np.uint64(56)).astype(int), minlength=256).astype(np.uint8).tobytes() for x in sets]
    rows = spark.createDataFrame([(t, k, 40, k, bytearray(sketch[k])) for t in (1, 2) for k in range(121)], "token long, node long, n int, component long, sketch binary").coalesce(1)
    spans = similar._others(rows, 0.8).collect()
    assert 120 <= len(spans) <= 240 and {r[0] for r in graph.components(spark.createDataFrame(spans)).select("component").distinct().collect()} == {0}
    members = spark.createDataFrame([(0, k, k, x.view(np.int64).tolist()) for k, x in enumerate(sets)], "cluster long, node long, component long, hashes array<long>")
    assert [sorted(r) for r in similar._joined(members, 0.8).collect()] == [[7, 120]]
    held, similar.HELD = similar.HELD, 1000  # five tiles
    try:
        assert [sorted(r) for r in similar._joined(members, 0.8).collect()] == [[7, 120]]
    finally:
        similar.HELD = held


def test_texts_that_are_not_asked_for_stay_where_they_lie(spark, monkeypatch):
    rng = np.random.default_rng(3)
    asked, others = rng.integers(-(1 << 63), 1 << 63, 5000), rng.integers(-(1 << 63), 1 << 63, 50_000)
    matching = similar._matching(spark.createDataFrame([(int(x),) for x in asked], "node long"))
    assert matching(asked).all() and matching(others).mean() < 0.01
    assert not similar._matching(spark.createDataFrame([], "node long"))(others).any()
    # a set of near copies among others: no join of texts, rows for Python in small batches, the session's setting as it was
    key, plans, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", [], []

    def recorded(df, cut=similar.cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        seen.append(spark.conf.get(key))
        return cut(df)

    monkeypatch.setattr(similar, "cut", recorded)
    words = [[f"w{x}" for x in rng.integers(0, 10**6, 60)] for _ in range(30)]
    words += [words[0][:-2] + ["x", "y"], words[1][1:]]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
    most, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get(key)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        groups = {r.doc_id: r[similar.GROUP] for r in similar.similar_groups(table).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert groups[0] == groups[30] and groups[1] == groups[31] and len(set(groups.values())) == 30
    assert not any("Join [mark" in p for p in plans) and set(seen) == {"2048"} and spark.conf.get(key) == before
