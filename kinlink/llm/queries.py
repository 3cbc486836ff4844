"""The operators as queries over the whole of their tables, and what of them SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinlink.llm import automata, bpe, hnsw, packing, quality, secrets, simhash, suffix, urls

VOCABULARY = "byte_bpe_50k.json"


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


documents, embeddings, pages = _table("documents"), _table("embeddings"), _table("pages")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": lambda s, d: hnsw.near_vectors(embeddings(s, d)),
    "op2_quality_rules": lambda s, d: quality.quality(documents(s, d)),
    "op3_secret_scans": lambda s, d: secrets.secrets(documents(s, d)),
    "op4_url_filters": lambda s, d: urls.judge_urls(pages(s, d)).drop("trust", "distrust"),
    "op5_token_counts": lambda s, d: bpe.count_tokens(documents(s, d), public_tokenizers.path(VOCABULARY)),
    "op6_substring_dedup": lambda s, d: automata.remove_phrases_digests(documents(s, d)),
    "op7_simhash_near_dedup": lambda s, d: simhash.near_groups(documents(s, d)),
    "op8_bpe_round_trip": lambda s, d: bpe.encode_digests(documents(s, d), public_tokenizers.path(VOCABULARY)),
    "op9_best_fit_packing": lambda s, d: packing.pack_apart(documents(s, d)),
    "op10_suffix_array_dedup": lambda s, d: suffix.remove_repeats_digests(documents(s, d)),
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) as (select vec_id, vec_id from embeddings union select reach.a, link.b from reach join link on reach.b = link.a),
top as (select a, min(b) as component_id from reach group by a)
select vec_id, (select count(*) from link where link.a = vec_id)::bigint as n_links, component_id, vec_id = component_id as kept from embeddings join top on a = vec_id""",
    "op6_substring_dedup": """
with words as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') as w from documents),
win as (select doc_id, p, w[p:p + 34] as s from (select doc_id, w, unnest(range(1, len(w) - 33)) as p from words)),
again as (select s from win group by s having count(*) > 1),
hit as (select doc_id, p from win semi join again using (s)),
covered as (select distinct doc_id, unnest(range(p, p + 35)) as p from hit),
gone as (select doc_id, list(p) as ps from covered group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed,
    sha256(coalesce(array_to_string(list_filter(w, lambda x, i: ps is null or not list_contains(ps, i)), ' '), '')) as kept_sha256
from words left join gone using (doc_id)""",
    "op10_suffix_array_dedup": """
with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
win as (select doc_id, p, substr(h, 2 * p - 1, 100) as s from (select doc_id, h, unnest(range(1, n - 48)) as p from bytes where n >= 50)),
first as (select s, min(doc_id) as least from win group by s having min(doc_id) < max(doc_id)),
hit as (select doc_id, p from win join first using (s) where least < doc_id),
covered as (select distinct doc_id, unnest(range(p, p + 50)) as p from hit),
runs as (select doc_id, p, p - row_number() over (partition by doc_id order by p) as r from covered),
spans as (select doc_id, min(p) as a, max(p) as b from runs group by doc_id, r),
edges as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as since from spans),
kept as (select e.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - 1 - since)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as h,
    sum(b - a + 1)::bigint as n_removed, count(*)::bigint as n_spans from edges e join bytes using (doc_id) group by e.doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept.h, bytes.h))) as kept_sha256
from bytes left join kept using (doc_id)""",
}
