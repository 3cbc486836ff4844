"""URL filters: host and path rules, and trust and distrust propagated over links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinlink.llm.store import cut, drop, tidy

#: (verdict, host/path) in the form the filter lists have.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched_rule(rules: tuple[tuple[str, str], ...], host: Column, path: Column) -> Column:
    """The longest rule that fits; of equally long ones the first by alphabet; null where none does."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, rest = rule.partition("/")
        out = F.when(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest), F.lit(rule)).otherwise(out)
    return out


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, score, own): PageRank over edges (src, dst, weight) that restarts at seeds (host, weight); own is the part that the restart gives.

    Scores sum to the seeds' weights; hosts without out-links restart too. Ends when a round moves less than tolerance of
    that sum in all and reaches no new host, so every host that a seed leads to has a score, however far it is. What a
    round moves falls by the damping, and each host is reached once, so the rounds end. No seeds: no rows. Each round is a
    join and a sum over edges and hosts, written to the shared folder; only three sums come to the driver.
    """
    start = cut(seeds.groupBy("host").agg(F.sum("weight").alias("p")).where("host is not null and p > 0"))
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    share = cut(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")))
    linked = cut(share.select(F.col("src").alias("host"), F.lit(True).alias("linked")).distinct())
    total = start.agg(F.sum("p")).first()[0] or 0.0
    now = cut(start.select("host", F.col("p").alias("score"), F.col("p").alias("own")))
    held = start.join(linked, "host", "left_semi").agg(F.sum("p")).first()[0] or 0.0  # what hosts with links hold
    while total:
        restart = 1.0 - damping * held / total
        # both sides are plain tables, so a hub's links are split by the engine's handling of skewed joins
        moved = now.join(share, F.col("host") == F.col("src")).select(F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("score"), F.lit(0.0).alias("own"))
        own = F.lit(restart) * F.col("p")
        new = cut(moved.unionByName(start.select("host", own.alias("score"), own.alias("own"))).groupBy("host").agg(F.sum("score").alias("score"), F.sum("own").alias("own")))
        both = new.join(now.select("host", F.col("score").alias("old")), "host", "left").join(linked, "host", "left")
        change, held, fresh = both.agg(F.sum(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0)))), F.sum(F.when(F.col("linked"), F.col("score")).otherwise(0.0)), F.count(F.when(F.col("old").isNull(), 1))).first()
        drop(now)
        now = new
        if change < tolerance * total and not fresh:
            break
    drop(share)
    drop(linked)
    return now


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, weight): links (with a scheme or from // on) between different hosts, weight being the pages' number that have them."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(r"(?i)\shref\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s<>]+)"), F.lit(1)), lambda x: host_of(F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))))
    links = pages.where(F.col(html_col).contains("//")).select(host_of(F.col(url_col)).alias("src"), F.explode(found).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


@tidy
def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, threshold: float = 0.5, damping: float = 0.85, tolerance: float = 1e-6, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for each row of pages.

    Rules decide first. A host's seed weights are the shares of all its pages that rules allow and block. Trust is
    PageRank over links from the allowed, distrust PageRank over reversed links from the blocked. Where no rule decides, a
    host is blocked if its distrust is more than threshold of distrust, trust and what the pages of a seed without a rule
    would hold themselves; so a host with few blocked pages keeps the rest unless its links tell more. A host that no seed
    reaches is allowed. A null url, or one without ://, has empty host and path, is allowed and is no node. Rows repeat as
    in the input, and each counts as a page; a null id stays null; ties in length go to the first rule by alphabet; an
    empty table gives no rows; other columns are not read.
    """
    kinds = {rule: verdict for verdict, rule in rules}
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("rule", matched_rule(rules, F.col("host"), F.col("path")))
    told = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))[F.col("rule")] if kinds else F.lit(None).cast("string")
    judged = judged.withColumn("told", told)
    share = lambda verdict: F.avg(F.coalesce(F.col("told") == verdict, F.lit(False)).cast("double"))
    by_host = cut(judged.where("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad")).where("good > 0 or bad > 0"))
    edges = cut(host_edges(pages))
    rank = lambda links, seed, name: personalised_rank(links, by_host.select("host", F.col(seed).alias("weight")), damping, tolerance).withColumnsRenamed({"score": name, "own": f"own_{name}"})
    trust = rank(edges, "good", "trust")
    distrust = rank(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"), "bad", "distrust")
    scores = trust.join(distrust, "host", "full").join(by_host, "host", "left").na.fill(0.0)
    part = lambda name, seed: F.coalesce(F.try_divide(F.col(f"own_{name}"), F.col(seed)), F.lit(0.0))
    untold = (1 - F.col("good") - F.col("bad")) * F.greatest(part("trust", "good"), part("distrust", "bad"))
    # written, so that the pages of a hot host are split in the join below
    scores = cut(scores.select("host", "trust", "distrust", (F.col("distrust") > F.lit(threshold) * (F.col("trust") + F.col("distrust") + untold)).alias("doubt")))
    none = F.lit(0.0)
    return judged.join(scores, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("told", F.when(F.col("doubt"), "block").otherwise("allow")).alias("verdict"), F.coalesce("trust", none).alias("trust"), F.coalesce("distrust", none).alias("distrust"))
