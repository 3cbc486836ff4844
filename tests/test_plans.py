"""Records to results in one go, against a plain Python version of the whole."""

import math
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from kinlink.config import Config
from kinlink.functions import similarity
from kinlink.functions.metaphone import primary_code
from kinlink.operators.features import FEATURES
from kinlink.plans import resolve
from tests.test_text import slow_jaro_winkler as jw

CONFIG = Config(k_base=4, max_seen=9, min_cycles=2)


def grams(t):
    return [t] if 0 < len(t) < 3 else [t[k : k + 3] for k in range(len(t) - 2)]


class Bm25:
    def __init__(self, docs):
        self.docs = {i: Counter(grams(t)) for i, t in docs.items()}
        self.long = {i: sum(c.values()) for i, c in self.docs.items()}
        n, df = len(docs), Counter(g for c in self.docs.values() for g in c)
        self.mean = sum(self.long.values()) / n
        raw = {g: math.log(n - d + 0.5) - math.log(d + 0.5) for g, d in df.items()}
        low = 0.25 * sum(raw.values()) / len(raw) if raw else 0.0
        self.idf = {g: r if r >= 0 else low for g, r in raw.items()}

    def weight(self, g, tf, dl):
        return self.idf.get(g, 0.0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / self.mean))

    def hits(self, text):
        asked = Counter(grams(text))
        scores = {i: round(sum(q * self.weight(g, c[g], self.long[i]) for g, q in asked.items() if g in c), 6) for i, c in self.docs.items()}
        return sorted(((s, i) for i, s in scores.items() if s > 0), key=lambda x: (-x[0], x[1]))

    def own(self, text):
        c = Counter(grams(text))
        return max(sum(n * self.weight(g, n, sum(c.values())) for g, n in c.items()), 1e-9)


def vec(t):
    out = [0.0] * 64
    for g in grams(t):
        out[xxhash.xxh64_intdigest(g.encode(), 42) % 64 if xxhash.xxh64_intdigest(g.encode(), 42) < 1 << 63 else (xxhash.xxh64_intdigest(g.encode(), 42) - (1 << 64)) % 64] += 1
    n = math.sqrt(sum(x * x for x in out)) or 1e-10
    return [x / n for x in out]


def share(a, b, low):
    return len(a & b) / low if low else 0.0


def pair(q, t, ranks, scores, own):
    (name, addr, cross), (name2, addr2, cross2, source) = (q["name"], q["addr"], q["cross"]), (t["name"], t["addr"], t["cross"], t["source"])
    x, y = name.split(), name2.split()
    elkan = (sum(max(jw(a, b) for b in y) for a in x) / len(x) + sum(max(jw(a, b) for a in x) for b in y) / len(y)) / 2 if x and y else 0.0
    u, v = set(addr.split()), set(addr2.split())
    digits = lambda s: set("".join(c if c.isdigit() else " " for c in s).split())
    m, n = digits(addr), digits(addr2)
    ratio = lambda a, b: min(len(a), len(b)) / max(len(a), len(b)) if a or b else 0.0
    dot = min(1.0, max(0.0, sum(a * b for a, b in zip(vec(name), vec(name2), strict=True))))
    codes = [{primary_code(w) for w in z} - {""} for z in (x, y)]
    from_distance = 1 - levenshtein(name, name2) / max(len(name), len(name2)) if name.strip() and name2.strip() else 0.0
    return [
        jw(name, name2), elkan, from_distance, name == name2, bool(codes[0] & codes[1]), similarity.acronym(name, name2), dot,
        share(u, v, len(u | v)), share(u, v, min(len(u), len(v))), addr == addr2, share(m, n, len(m | n)), -1 if bool(m) != bool(n) else bool(m) and m == n, bool(m and n),
        scores.get("name", 0.0) / own[0], scores.get("addr", 0.0) / own[1], sum(1 / (60 + r) for r in ranks.values()), len(ranks), ratio(name, name2), ratio(addr, addr2),
        name == "", name2 == "", addr == "", addr2 == "", cross or cross2, source == "S3",
    ]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


@pytest.fixture(scope="module")
def records():
    rng = random.Random(13)
    words = ["willow", "mill", "quay", "tarn", "photo", "foto", "bridge", "oak"]
    make = lambda i, s: {"id": f"{s}-{i:02d}", "country": rng.choice(["peru", "fiji"]), "name": " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), "addr": " ".join([str(rng.randrange(3)), rng.choice(words), "lane"][rng.randrange(2) :]) if rng.random() < 0.8 else "", "is_cross_script": rng.random() < 0.2, "source": s}
    return [make(i, "S1") for i in range(6)], [make(i, rng.choice(["S2", "S3"])) for i in range(30)]


def expected(asked, targets):
    out = {}
    for q in asked:
        mine = {t["id"]: t for t in targets if t["country"] == q["country"]}
        indexes = {s: Bm25({i: t[s] for i, t in mine.items()}) for s in ("name", "addr")}
        streams = {s: indexes[s].hits(q[s]) for s in indexes}
        scored = [(math.floor(max(-1, min(1, sum(a * b for a, b in zip(vec(q["name"]), vec(t["name"]), strict=True)))) * 1e6 + 0.5) / 1e6, i) for i, t in mine.items()]
        streams["vector"] = sorted(scored, key=lambda x: (-x[0], x[1]))
        streams = {s: h[: CONFIG.max_rank] for s, h in streams.items()}
        order = {s: [i for _, i in h] for s, h in streams.items()}
        seen: dict = {}
        cycle = 0
        while len(seen) < CONFIG.max_seen:
            cycle += 1
            new = {c for s in order.values() for c in [c for c in s[: CONFIG.k_base + len(seen)] if c not in seen][: CONFIG.k_base]}
            if not new:
                break
            seen |= dict.fromkeys(new, cycle)
        side = lambda r: {**r, "cross": r["is_cross_script"]}
        for c, n in seen.items():
            ranks = {s: o.index(c) + 1 for s, o in order.items() if c in o}
            scores = {s: dict((i, x) for x, i in h).get(c) for s, h in streams.items() if c in order[s]}
            out[q["id"], c] = (n, pair(side(q), side(mine[c]), ranks, scores, (indexes["name"].own(q["name"]), indexes["addr"].own(q["addr"]))), q["country"])
    return out


def test_model_encoder(spark):
    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], np.float32)

    rows = spark.createDataFrame([(1, "banana"), (2, None), (3, "oak")], "id int, t string")
    got = {r.id: r.vec for r in resolve.model_encoder(load, 2)(rows, "t").collect()}
    assert got == {1: [6.0, 3.0], 2: [0.0, 0.0], 3: [3.0, 1.0]}


def test_candidates_and_results(spark, records, tmp_path):
    asked, targets = records
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], "id string, country string, name string, addr string, is_cross_script boolean, source string")
    want = expected(asked, targets)
    got = {(r.s1, r.cand): r for r in resolve.candidates(frame(asked), frame(targets), CONFIG, work=str(tmp_path / "w")).collect()}
    assert got.keys() == want.keys()
    for key, (cycle, values, country) in want.items():
        r = got[key]
        assert r.cycle == cycle and r[FEATURES[-1]] == country
        assert [r[f] for f in FEATURES[:-1]] == pytest.approx([float(v) for v in values], abs=2e-5)
    made = resolve.resolve(frame(asked), frame(targets), lambda rows: rows.withColumn("prob", F.col(FEATURES[0])), 0.8, CONFIG)
    kept: dict = {}
    for q in asked:
        mine = sorted((n, c, v[0]) for (s, c), (n, v, _) in want.items() if s == q["id"])
        seen, last = 0, max((n for n, _, _ in mine), default=0)
        for n in range(1, last + 1):
            now = [p for k, _, p in mine if k == n]
            seen += len(now)
            if seen >= CONFIG.max_seen or (n >= CONFIG.min_cycles and not any(p > 0.8 for p in now)):
                last = n
                break
        kept[q["id"]] = [(c, n, p > 0.8) for n, c, p in mine if n <= last]
    lists = lambda name, column: {r.source1_entity_id: r[column] for r in made[name].collect()}
    assert lists("matching_results", "matched_entity_ids") == {s: ",".join(sorted(c for c, _, ok in x if ok)) for s, x in kept.items()}
    assert lists("candidate_pairs", "candidate_entity_ids") == {s: ",".join(sorted(c for c, _, _ in x)) for s, x in kept.items()}
    per = {(r.source1_entity_id, r.cycle): r.candidate_entity_ids for r in made["candidate_pairs_per_cycle"].collect()}
    assert per == {(s, n): ",".join(sorted(c for c, k, _ in x if k == n)) for s, x in kept.items() for n in {k for _, k, _ in x}} | {(s, None): "" for s, x in kept.items() if not x}
