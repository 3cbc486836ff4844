"""Graphs, tiles, automata, suffix arrays and code points at sizes where the method's every part has work to do."""

import datetime as dt
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from kinlink.llm import automata, bpe, graph, hnsw, repeats, simhash, suffix, text

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# pre-tokens


def test_every_code_point_is_cut_as_the_library_does():
    library, cutter = ByteLevel(add_prefix_space=False, use_regex=True), bpe.PreTokens(bpe.class_differences())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same = lambda t: cutter.cut(t) == [t[x:y] for _, (x, y) in library.pre_tokenize_str(t)]
    assert cutter.differences and all(same("".join(f"{c}a" for c in points[k : k + (1 << 15)])) for k in range(0, len(points), 1 << 15))
    odd = [chr(c) for c in cutter.differences] + points[::997]
    for t in ("".join(f"a<{c}'t" for c in odd), " ".join(odd), "".join(f"1{c}b{c} {c}\n{c}" for c in odd)):
        assert same(t)


def test_tokens_of_odd_texts(spark):
    library, rng = Tokenizer.from_file(VOCABULARY), random.Random(0)
    odd = [chr(c) for c in bpe.class_differences()][::37] + list("aZ9 '\n\t é😀漢") + ["'s", "'ll", "  ", "<|endoftext|>", "<|endof", " ", " "]
    made = ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", "a" * 30_000, " " * 5000, "é" * 20_000, "ab" * 20_000]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(made)] + [(3, made[3], 1, "x"), (None, None, None, None)], "doc_id long, text string, n_tokens long, ids string")
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in made]
    got = {r.doc_id: r for r in bpe.encode(table, VOCABULARY).collect()}
    counts = {r.doc_id: r.n_tokens for r in bpe.count_tokens(table, VOCABULARY).collect()}
    assert all(got[i].ids == x and counts[i] == len(x) and got[i].decoded == library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids))
    assert got[None].ids == [] and bpe.encode_digests(table.limit(0), VOCABULARY).count() == 0


def test_vocabularies_that_ask_for_more_are_refused(tmp_path):
    path = tmp_path / "v.json"
    source = open(VOCABULARY, encoding="utf-8").read()
    for old, new in (('"add_prefix_space":false', '"add_prefix_space":true'), ('"use_regex":true', '"use_regex":false'), ('"lstrip":false', '"lstrip":true'), ('"ignore_merges":false', '"ignore_merges":true')):
        made = re.sub(re.escape(old).replace(":", r"\s*:\s*"), new, source)
        assert made != source
        path.write_text(made, encoding="utf-8")
        with pytest.raises(ValueError):
            bpe.Vocabulary(str(path))


# embeddings


def clustered(rng, n, dim, spread):
    base = rng.normal(size=(n // 3, dim))
    return base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dim)) * spread


def test_large_shards_are_walked():
    rng = np.random.default_rng(2)
    unit = clustered(rng, 6000, 32, 0.15)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    made = hnsw.Graph(unit)
    made.walks = 0
    q, r, audit = hnsw.audited(made, unit.astype(np.float32), 0.93, own=True)
    truth = np.argwhere(unit @ unit.T >= 0.93)
    truth = {(a, b) for a, b in truth.tolist() if a != b}
    found = set(zip(q.tolist(), r.tolist(), strict=True))
    assert len(truth) > 3000 and len(truth & found) >= 0.9 * len(truth)
    assert made.walks >= 6000 and audit.ef < 6000 and audit.true >= 300 and audit.found >= 0.9 * audit.true
    small = hnsw.Graph(unit[:200])
    small.walks = 0
    hnsw.audited(small, unit[:200].astype(np.float32), 0.93, own=True)
    assert small.walks >= 200


def test_rows_that_few_links_lead_to_are_found():
    rng = np.random.default_rng(0)
    unit = rng.normal(size=(3000, 64))
    unit[:400] = rng.normal(size=64) + rng.uniform(0.01, 0.2, (400, 1)) * rng.normal(size=(400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit = unit[rng.permutation(3000)]
    truth = {(a, b) for a, b in np.argwhere(unit @ unit.T >= 0.93).tolist() if a != b}
    made = hnsw.Graph(unit)
    q, r = made.near(unit.astype(np.float32), 0.93 - 1e-5, 32)
    assert truth <= set(zip(q.tolist(), r.tolist(), strict=True)) and len(made.apart) < 100
    made.walks = 0
    assert hnsw.audited(made, unit.astype(np.float32), 0.93 - 1e-5, own=True)[2].ef == 32 and made.walks < 6000


@pytest.mark.parametrize("shard_rows", [8192, 700])
def test_links_of_large_labels(spark, shard_rows):
    rng = np.random.default_rng(3)
    vectors = clustered(rng, 5200, 24, 0.15)
    vectors[5000:5100] = vectors[:100]  # copies
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    table = spark.createDataFrame(pa.table({"vec_id": np.arange(5200), "embedding": pa.array(vectors.tolist()), "label": np.zeros(5200, np.int64), "key": pa.array(["x"] * 5200)}))
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_vectors(table, shard_rows=shard_rows).collect()}
    least = np.arange(5200)
    while True:
        new = np.minimum(least, np.where(near, least[None, :], 1 << 40).min(1))
        if (new == least).all():
            break
        least = new
    links = near.sum(1)
    assert sum(got[i][0] for i in range(5200)) >= 0.9 * links.sum() and all(got[i][0] <= links[i] for i in range(5200))
    assert sum(got[i] == (links[i], least[i]) for i in range(5200)) >= 0.98 * 5200
    told = hnsw.recall_audits(table, shard_rows=shard_rows).collect()
    shards = -(-5100 // shard_rows)
    assert len(told) == shards * (shards + 1) // 2 and all(r.found >= 0.9 * r.audited > 0 for r in told)


def test_one_id_for_two_vectors(spark):
    made = [(1, [1.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (2, [1.0, 0.01], "a"), (3, [0.0, 2.0], "b"), (4, [0.0, 2.0, 0.0], "b"), (5, [0.0, 3.0], "b"), (None, [0.0, 3.0], "b"), (6, [], "b")]
    table = spark.createDataFrame([(*m, 1, 2) for m in made], "vec_id long, embedding array<double>, label string, node long, size long")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(table).collect())
    assert got == Counter([(1, 1, 1, True), (1, 0, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 0, 4, True), (5, 1, 3, False), (None, 0, None, False), (6, 0, 6, True)])
    assert hnsw.near_vectors(table.limit(0)).count() == 0 and hnsw.recall_audits(table.limit(0)).count() == 0


# fingerprints


def test_links_at_one_and_two_bits_over_many_tiles(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64).astype(np.uint64)
    made = [int(x) for x in base]
    for x in base.tolist():
        for bits in ((1,), (1, 2), (63,), (15, 16), (31, 47), (0, 1, 2), (60, 61, 62)):
            made.append(x ^ sum(1 << b for b in bits))
    made += [0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2, 0xFFFF, 0xFFFF0000, 0x1FFFE]
    made = sorted(set(made))
    table = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in made], "fp long")
    want = {frozenset((a, b)) for i, a in enumerate(made) for b in made[:i] if (a ^ b).bit_count() <= 2}

    def classes(pairs):
        root = {x: x for x in made}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in map(tuple, pairs):
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {x: top(x) for x in made}

    assert {(a ^ b).bit_count() for a, b in map(tuple, want)} == {1, 2}
    for tile in (3, 2048):
        links = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(table, 2, tile).collect()}
        assert links <= want and classes(links) == classes(want)


def test_fingerprints_of_edited_texts(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(300)]
    made = [None, "", " \n", "one", "one two", "ONE two", "x " * 40_000, "x y " * 10_000]
    for _ in range(25):
        t = [rng.choice(words) for _ in range(rng.choice((60, 200, 400)))]
        made += [" ".join(t), " ".join(t).upper()]
        for _ in range(6):  # few edits in long texts: near fingerprints
            u = list(t)
            u[rng.randrange(len(u))] = "new"
            made.append("  ".join(u))
    table = spark.createDataFrame([(i, t, "f", 1) for i, t in enumerate(made)] + [(None, made[9], "f", 1), (9, made[9], "f", 1)], "doc_id long, text string, fp string, root long")
    prints = {}
    for i, t in enumerate(made):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
        h = Counter(grams)
        total, bits = sum(h.values()), np.zeros(64, np.int64)
        for g, n in h.items():
            v = xxhash.xxh64_intdigest(g, 42)
            bits += n * np.array([v >> k & 1 for k in range(64)])
        prints[i] = sum(1 << k for k in range(64) if 2 * bits[k] > total)
    least = {i: i for i in prints}
    distances = Counter()
    for _ in range(3):
        for i in prints:
            for j in range(i):
                d = (prints[i] ^ prints[j]).bit_count()
                distances[d] += 1
                if d <= 2:
                    least[i] = least[j] = min(least[i], least[j])
    assert distances[1] and distances[2]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(table).collect()]
    want = [(i, f"{prints[i]:016x}", least[i]) for i in prints] + [(None, f"{prints[9]:016x}", least[9]), (9, f"{prints[9]:016x}", least[9])]
    assert Counter(got) == Counter(want) and simhash.near_groups(table.limit(0)).count() == 0


# automata and suffix arrays


def test_what_automata_hit_is_linear_in_uniform_texts():
    lengths = list(range(40, 2000, 10))
    codes = np.concatenate([np.zeros(n, np.int64) for n in lengths] + [np.arange(50)])
    at = np.concatenate([[0], np.cumsum([*lengths, 50])])
    began = time.time()
    mask = automata.occurrences(codes, at, automata.phrases_of(at[:-2], at[1:-1], 35), 35, 1 << 17)
    assert mask[: at[-2]].all() and not mask[at[-2] :].any() and time.time() - began < 5


def test_phrases_make_up_passages():
    starts, ends = np.array([0, 100, 300]), np.array([35, 171, 405])
    phrases = automata.phrases_of(starts, ends, 35)
    covered = {x for p in phrases.tolist() for x in range(p, p + 35)}
    assert covered == {x for a, b in zip(starts.tolist(), ends.tolist(), strict=True) for x in range(a, b)} and len(phrases) == 1 + 3 + 3


def test_occurrences_against_a_search():
    rng = random.Random(5)
    for words in (3, 40, 5000):
        docs = [[rng.randrange(words) for _ in range(rng.randrange(60))] for _ in range(40)]
        docs += [d[5:] + d[:9] for d in docs[:20]]
        codes, at = np.array([x for d in docs for x in d], np.int64), np.cumsum([0, *map(len, docs)])
        phrases = [int(at[k]) + rng.randrange(len(d) - 7) for k, d in enumerate(docs) if len(d) > 8 and rng.random() < 0.4]
        wanted = {tuple(codes[p : p + 7].tolist()) for p in phrases}
        want = np.zeros(len(codes), bool)
        for a, b in zip(at[:-1], at[1:], strict=True):
            for p in range(a, b - 6):
                if tuple(codes[p : p + 7].tolist()) in wanted:
                    want[p : p + 7] = True
        for most in (20, 1 << 17):
            assert (automata.occurrences(codes, at, np.array(phrases), 7, most) == want).all()


def test_suffix_arrays():
    rng = np.random.default_rng(6)
    for n, kinds in ((1, 2), (50, 2), (400, 3), (3000, 200)):
        data = rng.integers(1, kinds + 1, n).astype(np.uint8)
        data[rng.integers(0, n, max(1, n // 60))] = 0
        data[-1] = 0
        raw = data.tobytes()
        tails = [raw[k : raw.index(b"\0", k) + 1] for k in range(n)]
        order = suffix.suffix_array(data)
        assert order.tolist() == sorted(range(n), key=lambda k: (tails[k], k))
        same = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y or x == 0), min(len(a), len(b)))
        assert suffix.common_prefixes(data, order)[1:].tolist() == [same(tails[a], tails[b]) for a, b in zip(order[:-1], order[1:], strict=True)]


def test_long_uniform_texts_take_no_longer():
    def took(data):
        began = time.time()
        suffix.locate_repeats(np.array([1, 2]), np.array([len(data), 100]), data + data[:100], 50)
        return time.time() - began

    noise = bytes(np.random.default_rng(0).integers(65, 90, 400_000).astype(np.uint8))
    assert took(b"a" * 400_000) < 3 * took(noise) + 1


@pytest.mark.parametrize("unit", ["bytes", "words"])
def test_segments_meet_wherever_windows_recur(unit):
    """Every window lies in one segment, and equal windows' segments have equal anchors."""
    rng = random.Random(7)
    kind = repeats.Kind(unit, 12, 5, unit == "bytes")
    texts = ["", "ab", "a" * 200] + ["".join(rng.choice("ab c") for _ in range(rng.randrange(90))) for _ in range(60)] + ["é d " * 30]
    units = repeats.Units(unit, pa.array(texts))
    row, first, last, anchor, places = repeats.segments(units, kind)
    owner, seen = {}, {}
    for r, a, b, h in zip(row.tolist(), first.tolist(), last.tolist(), anchor.tolist(), strict=True):
        assert units.at[r] <= a <= b <= units.at[r + 1] - 12
        for p in range(a, b + 1):
            assert p not in owner
            owner[p] = h
            assert seen.setdefault(units.cut(p, p + 12), h) == h
    assert len(owner) == sum(max(0, int(n) - 11) for n in np.diff(units.at)) and set(anchor.tolist()) <= set(places.tolist())


def test_cost_of_anchors_is_flat_in_buckets():
    rng = np.random.default_rng(1)
    b = repeats.Batch.__new__(repeats.Batch)
    b.anchor = b.places = rng.integers(0, 1 << 63, 250_000, dtype=np.int64).astype(np.uint64)

    def took(buckets):
        began = time.time()
        b.anchors(buckets)
        return time.time() - began

    assert max(took(4000), took(3_000_000)) < 3 * took(16) + 0.2


@pytest.fixture
def small(monkeypatch):
    for name, size in (("BATCH", 3000), ("SHARD", 2000), ("BUCKET", 2500)):
        monkeypatch.setattr(repeats, name, size)
    monkeypatch.setattr(suffix, "ARRAY_BYTES", 700)
    monkeypatch.setattr(automata, "AUTOMATON_WORDS", 70)


def test_repeats_of_many_batches(spark, small):
    rng = random.Random(12)
    common = [" ".join(rng.choice(["aa", "b", "cc", "é", "x"]) for _ in range(rng.randrange(30, 90))) for _ in range(8)]
    made = []
    for i in range(90):
        parts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(30))) if rng.random() < 0.5 else rng.choice(common) for _ in range(rng.randrange(4))]
        made.append((rng.randrange(70) if i else None, rng.choice([" ", "\n"]).join(parts)))
    made += [(100 + k, common[0]) for k in range(40)] + [(200, "z" * 900), (201, "z" * 70), (202, "z z " * 200), (203, "z " * 30), (204, None), (205, common[1] * 30)]
    table = spark.createDataFrame([(i, t, 1, 2, "m") for i, t in made], "doc_id long, text string, batch long, n long, payload string")
    least = {}
    for i, t in made:
        raw = (t or "").encode()
        for k in range(len(raw) - 49 if i is not None else 0):
            least[raw[k : k + 50]] = min(least.get(raw[k : k + 50], i), i)
    want = []
    for i, t in made:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49 if i is not None else 0):
            if least[raw[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        want.append((i, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(c for c, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    assert Counter(map(tuple, suffix.remove_repeats_digests(table).collect())) == Counter(want)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in made]
    counts, want = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34)), []
    for (i, _), w in zip(made, words, strict=True):
        gone = bytearray(len(w))
        for k in range(len(w) - 34):
            if counts[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = b"\1" * 35
        want.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    assert Counter(map(tuple, automata.remove_phrases_digests(table).collect())) == Counter(want)


def test_words_are_split_as_the_pattern_says():
    made = ["", " ", "a", " a\tb\x0b\x0cc\r\nd ", "é ü 漢", "a" * 50, "x\x1cy"] * 3
    words, at = text.split_words(pa.array(["skip", *made]).slice(1))
    want = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in made]
    assert [words[int(a) : int(b)].to_pylist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    assert len(set(text.word_hashes(*text.spaced(words)).tolist())) == len({w for ws in want for w in ws})


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 4999), (5000, 5001)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long").withColumn("c", F.lit(1))).collect()}
    assert got == {i: 0 for i in range(401)} | {1000 + k: 1000 for k in range(300)} | {4999: 4999, 5000: 4999, 5001: 4999}


def test_documents_are_dealt_once_with_all_their_columns(spark):
    passage, day = "a passage of well over fifty bytes that several of the documents have in common, ", dt.datetime(2024, 5, 6, 7, 8, 9)
    made = [(1, passage + "x"), (2, passage + "y"), (2, passage + "y"), (2, "z" + passage), (None, passage), (None, None), (3, None), (4, ""), (5, passage), (6, "über " + passage), (1, passage + "x")]
    rows = [(i, t, None if t is None else 7, day if n % 2 else None, [n, None], {"k": n}, (str(n), None), None) for n, (i, t) in enumerate(made)]
    table = spark.createDataFrame(rows, "doc_id int, text string, n_chars int, `a.b day` timestamp, list array<int>, map map<string,int>, both struct<x:string,y:date>, none string")
    left = {2: ("y", "z"), 5: ("",), 6: ("über ",)}
    want = []
    for i, t, n, *rest in rows:
        short = t.replace(passage, "") if t and i in left else t
        want.append((i, short, n if short == t else len(short), *rest))
    out = suffix.without_repeats(table)
    plan = out._jdf.queryExecution().executedPlan().toString().split("FlatMapCoGroupsInArrow")[0]
    assert out.columns == table.columns and Counter(map(str, map(tuple, out.collect()))) == Counter(str(tuple(spark.createDataFrame([w], table.schema).first())) for w in want)
    assert suffix.without_repeats(table.limit(0)).count() == 0
    assert "Exchange" not in plan and "Join" not in plan  # no text is dealt again to be joined
