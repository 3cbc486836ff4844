"""Every rule of the result files' checks, by a plain Python version."""

import random

import pytest

from kinlink.operators import validator


def plain(rows, required, known, pool):
    """Offenders by rule, line by line."""
    found = {}
    add = lambda rule, x: found.setdefault(rule, set()).add(x)
    lists = {}
    for s1, ids in rows:
        if ids is None:
            add("row_without_tab", s1)
            continue
        if s1 in lists:
            add("duplicate_s1", s1)
        parts = ids.split(",") if ids.strip() else []
        lists.setdefault(s1, set()).update(parts)
        if len(parts) != len(set(parts)):
            add("duplicate_in_list", s1)
        for x in parts:
            if x[:3] == "S1-":
                add("self_match", x)
            elif x[:3] not in ("S2-", "S3-"):
                add("bad_prefix", x)
            elif known is not None and x not in known:
                add("unknown_id", x)
    for s1 in required - set(lists):
        add("missing_s1", s1)
    for s1 in set(lists) - required:
        add("unexpected_s1", s1)
    for s1, ids in lists.items():
        if pool is not None and ids - pool.get(s1, set()):
            add("match_not_candidate", s1)
    return {rule: (len(x), ",".join(sorted(x)[:5])) for rule, x in found.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_rules(spark, seed):
    rng = random.Random(seed)
    ids = [f"S{k}-{n}" for k in (2, 2, 3, 3, 1) for n in range(40)] + ["", "X-1", " S2-1", "S2-10 ", "s2-3"]
    rows = [(f"S1-{rng.randrange(60)}", None if rng.random() < 0.1 else ",".join(rng.choice(ids) for _ in range(rng.randrange(5)))) for _ in range(80)] + [("S1-1", "S2-10,S2-11,S2-22"), ("S1-2", " "), ("S1-3", ",")]
    required, known = {f"S1-{n}" for n in range(50)}, {i for i in ids if i[1:] and rng.random() < 0.8}
    pool_rows = [(f"S1-{n}", ",".join(rng.sample(ids, 60))) for n in range(45)]
    pool = {s: set(x.split(",")) for s, x in pool_rows}
    frame = lambda made, schema: spark.createDataFrame(made, schema)
    pairs = "s1 string, ids string"
    for with_known, with_pool in ((True, True), (False, False)):
        got = validator.findings(frame(rows, pairs), frame([(s,) for s in required], "s1 string"), frame([(k,) for k in known], "id string") if with_known else None, frame(pool_rows, pairs) if with_pool else None).collect()
        assert {r.rule: (r.n, r.examples) for r in got} == plain(rows, required, known if with_known else None, pool if with_pool else None)
    assert {r.rule: r.severity for r in got}.get("match_not_candidate") is None


def test_sound_ids_give_no_findings(spark):
    rows = spark.createDataFrame([("S1-1", "S2-10,S2-11,S2-22"), ("S1-2", "")], "s1 string, ids string")
    known = spark.createDataFrame([(f"S2-{n}",) for n in range(30)], "id string")
    assert validator.findings(rows, rows.select("s1"), known, rows).count() == 0


def test_files(spark, tmp_path):
    head = validator.HEADERS
    put = lambda name, text: (tmp_path / name).write_text(text)
    go = lambda c="cand.tsv", check=False: validator.validate(spark, str(tmp_path / "match.tsv"), str(tmp_path / c), str(tmp_path), check)
    errors, _ = go()
    assert errors and "test_source1.tsv" in errors[0]
    put("test_source1.tsv", "entity_id\tname\nS1-1\tx\n\nS1-2\ty\n")
    errors, warnings = go()
    assert any("match.tsv" in e for e in errors) and len(warnings) == 2
    put("match.tsv", f"{head['matching']}\nS1-1\tS2-1,S2-2\nS1-2\t\n")
    put("cand.tsv", f"{head['candidates']}\nS1-1\tS2-1\nS1-2\t\n")
    errors, warnings = go()
    assert errors == [] and any("match_not_candidate: 1 total, e.g. S1-1" in w for w in warnings)
    assert any("test_source2.tsv" in w for w in go(check=True)[1])
    put("test_source2.tsv", "entity_id\tname\nS2-1\tx\n")
    put("test_source3.tsv", "entity_id\tname\nS3-1\tx\n")
    errors, warnings = go("gone.tsv", True)
    assert [e for e in errors if "unknown_id: 1 total, e.g. S2-2" in e] and any("gone.tsv" in w for w in warnings)
    for text in ("", "source1_entity_id,matched_entity_ids\n", "a\tb\n"):
        put("match.tsv", text)
        assert go()[0]
