"""Secret scans in DataFrame functions only: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

#: The base patterns; keyword letters count in either case.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in KEYWORDS) + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Runs shorter than these fail, and what a short run holds is shorter still, so the bound can stand in the pattern.
ACCESS, HEX = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: What begins a secret whose rest follows, for operators that would cut it in two.
LEAD_IN = r"(?:(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]*|AKIA[A-Z0-9]*|[0-9a-f]{8,})\Z"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Least entropy in bits per character of some window, by the class of the candidate.
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "base64": 3.9}
#: Candidates that match any of these are known not to be secrets.
ALLOW = ("EXAMPLE", "(?i)0123456789|abcdefghij", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "^sha(1|256|384|512)[-=]")
_SCALE = 1 << 32
#: Matches whose positions are summed in one go.
BLOCK = 128


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(pattern: str, order: int, keep: str = "true", group: int = 0) -> Column:
    """Sorted (start, ord, end, s) of leftmost non-overlapping matches in column text_; keep filters on s, the match or its group.

    Positions in code points come from the pieces between matches: start = all pieces and matches before it.
    """
    p = _quoted(pattern)
    none = "cast(array() as array<struct<start:int,ord:int,end:int,s:string>>)"
    zipped = f"arrays_zip(slice(split(text_, {p}, -1), 1, size(regexp_extract_all(text_, {p}, 0))) as p, regexp_extract_all(text_, {p}, 0) as m, regexp_extract_all(text_, {p}, {group}) as g)"
    zipped = zipped.replace(" as p, regexp", ", regexp").replace(" as m, regexp", ", regexp").replace(" as g)", ")", 1)
    # an array that grows is copied at every step, so matches are walked in blocks, whose starts are summed first
    length = "length(x['0']) + length(x['1'])"
    starts = f"aggregate(transform(k, y -> aggregate(y, 0, (n, x) -> n + {length})), named_struct('pos', 0, 'out', cast(array() as array<int>)), (a, n) -> named_struct('pos', a.pos + n, 'out', concat(a.out, array(a.pos))), a -> a.out)"
    span = f"named_struct('start', a.pos + length(x['0']), 'ord', {order}, 'end', a.pos + {length}, 's', x['2'])"
    block = f"aggregate(y, named_struct('pos', n, 'out', {none}), (a, x) -> named_struct('pos', a.pos + {length}, 'out', concat(a.out, array({span}))), a -> a.out)"
    blocks = f"transform(sequence(0, cast((size(z) - 1) div {BLOCK} as int)), b -> slice(z, b * {BLOCK} + 1, {BLOCK}))"
    walked = f"transform(array({zipped}), z -> transform(array({blocks}), k -> flatten(zip_with(k, {starts}, (y, n) -> {block})))[0])[0]"
    return F.expr(f"case when text_ rlike {p} then filter({walked}, x -> {keep.format(s='x.s')}) else {none} end")


def _is_random(s: str, thresholds: dict[str, float], window: int, allow: tuple[str, ...]) -> str:
    """SQL: whether some window of s has the entropy of its class. Counts per character move with the window; sums are whole numbers."""
    f = [round(c * math.log2(c) * _SCALE) if c else 0 for c in range(window + 2)]
    table = f"array({', '.join(f'{x}L' for x in f)})"
    most = {k: math.floor(window * (math.log2(window) - t) * _SCALE) for k, t in thresholds.items()}
    limit = f"case when {s} rlike '^[0-9a-fA-F]+$' then {most['hex']}L when {s} rlike '^[A-Za-z0-9]+$' then {most['alnum']}L else {most['base64']}L end"
    chars = f"transform(split({s}, ''), c -> instr('{ALPHABET}', c))"
    # a: count of the entering character once the leaving one is out; b: count of the leaving one
    step = f"""(z, i) -> named_struct(
        'c', transform(z.c, (n, j) -> n + int(j + 1 = k[i]) - int(i >= {window} and j + 1 = k[greatest(i - {window}, 0)])),
        's', z.s + case when i >= {window} and k[i] = k[greatest(i - {window}, 0)] then 0L
            else {table}[z.c[k[i] - 1] + 1] - {table}[z.c[k[i] - 1]]
                + case when i >= {window} then {table}[z.c[k[greatest(i - {window}, 0)] - 1] - 1] - {table}[z.c[k[greatest(i - {window}, 0)] - 1]] else 0L end end,
        'best', case when i >= {window} then least(z.best, z.s) else z.best end)"""
    start = f"named_struct('c', array_repeat(0, {len(ALPHABET)}), 's', 0L, 'best', {1 << 60}L)"
    # the state is copied at every step, so the characters' numbers stay outside it, in an enclosing lambda
    swept = f"transform(array({chars}), k -> aggregate(sequence(0, length({s}) - 1), {start}, {step}, z -> least(z.best, z.s)))[0]"
    allowed = " or ".join(f"{s} rlike {_quoted(a)}" for a in allow) or "false"
    return f"(case when not ({s} rlike '[0-9]' and {s} rlike '[A-Za-z]') or {allowed} then false else {swept} <= {limit} end)"


def _scanned(docs: DataFrame, text_col: str, thresholds: dict[str, float], window: int, allow: tuple[str, ...]) -> DataFrame:
    """docs as a struct row_, its text text_, and the sorted span arrays base_ and spans_."""
    found = docs.select(F.struct("*").alias("row_"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_")).select(
        "row_", "text_",
        _found(ASSIGN, 0, "length({s}) >= 12", 2).alias("assign_"), _found(ACCESS, 1).alias("access_"), _found(HEX, 2).alias("hex_"),
        _found(f"[A-Za-z0-9+/_=-]{{{window},}}", 3, _is_random("{s}", thresholds, window, allow).replace("{s}", "\0").replace("{", "{{").replace("}", "}}").replace("\0", "{s}")).alias("random_"),
    ).withColumn("base_", F.array_sort(F.concat("assign_", "access_", "hex_")))
    added = F.expr("filter(random_, r -> not exists(base_, b -> b.start <= r.start and r.end <= b.end))")
    return found.withColumn("spans_", F.array_sort(F.concat("base_", added)))


def _listed(column: str) -> Column:
    kinds = "array(" + ", ".join(map(_quoted, KINDS)) + ")"
    return F.expr(f"concat_ws(',', transform({column}, x -> concat({kinds}[x.ord], ':', x.start, ':', x.end)))")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thresholds: dict[str, float] = THRESHOLDS, window: int = WINDOW, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end in code points, end exclusive) of every whole text.

    A candidate is a maximal run of base64 characters, at least a window long, with a letter and a digit; the allow-list
    suppresses it, as does a base span that holds it. One row per input row, repeated rows included; a null text is
    empty: no spans, the digest of the empty string; a null id stays null; other columns are not read.
    """
    one = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = _scanned(one, "text", thresholds, window, allow)
    return found.select("row_.doc_id", *(F.size(f"{k}_").cast("long").alias(f"n_{k}") for k in KINDS[:3]), F.sha2(_listed("base_"), 256).alias("base_sha256"), _listed("spans_").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", length_col: str | None = "n_chars", thresholds: dict[str, float] = THRESHOLDS, window: int = WINDOW, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """docs with every run of overlapping spans replaced by mark; a null text stays null; repeated rows repeat; an empty table stays empty.

    All columns of docs stay, in order, whatever their names; length_col, where docs has it, gets the new length.
    """
    found = _scanned(docs, text_col, thresholds, window, allow)
    out = f"""case when size(spans_) = 0 then text_ else aggregate(spans_, struct(0 as pos, '' as out),
        (a, x) -> struct(greatest(a.pos, x.end) as pos,
            case when x.start < a.pos then a.out else concat(a.out, substring(text_, a.pos + 1, x.start - a.pos), {_quoted(mark)}) end as out),
        a -> concat(a.out, substring(text_, a.pos + 1, length(text_) - a.pos))) end"""
    made = found.withColumn("new_", F.expr(f"case when row_.`{text_col}` is not null then {out} end"))
    swap = {text_col: F.col("new_")} | ({length_col: F.length("new_").cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {})
    return made.select(*(swap.get(c, F.col(f"row_.`{c}`")).alias(c) for c in docs.columns))
