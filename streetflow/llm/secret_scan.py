"""Secret scan: fixed patterns, and two character Markov models; DataFrame functions only.

One scan finds the spans of the fixed patterns and the long tokens outside
them. Two first-order Markov models of characters are then counted, one of
random strings (the distinct values that the patterns found) and one of ordinary
identifiers (words of the documents in which they found none). A long token whose
log-likelihood ratio between them passes the threshold becomes a span too.
Positions come from the lengths of what lies between matches, since
``split`` and ``regexp_extract_all`` walk the same matches.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import staged

# fixed values: the base patterns
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_TOKEN_CLASS = "[A-Za-z0-9+/_=-]"


def _token(least: int) -> str:
    return rf"(?<!{_TOKEN_CLASS}){_TOKEN_CLASS}{{{least},}}"


def spans_of(text: Column, pattern: str, kind: int, value_group: int = 0, least_value: int = 0) -> Column:
    """array<struct<start, kind, end, value>> of a pattern's leftmost
    non-overlapping matches whose group has ``least_value`` characters; code
    points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    before = F.zip_with(F.slice(F.split(text, pattern), 1, F.size(found)), found, lambda gap, m: F.length(gap) + F.length(m))
    ends = running(before, "x + y")
    spans = F.transform(
        F.arrays_zip(ends.alias("end"), found.alias("found"), value.alias("value")),
        lambda x: F.struct((x["end"] - F.length(x["found"])).alias("start"), F.lit(kind).alias("kind"),
                           x["end"].alias("end"), x["value"].alias("value")))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), F.filter(spans, lambda x: F.length(x["value"]) >= least_value)).otherwise(nothing)


def running(values: Column, both: str) -> Column:
    """The array whose element i is elements 0 to i of ``values`` put together by an
    associative ``both`` of x and y. Each step puts together neighbours twice as far
    apart, so the work is n log n and no array is grown element by element."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def step(acc: Column, k: Column) -> Column:
        return F.transform(acc, lambda x, i: F.when(i < F.pow(2, k), x).otherwise(
            put(F.get(acc, (i - F.pow(2, k)).cast("int")), x)))

    put = {"x + y": lambda x, y: x + y, "greatest(x, y)": F.greatest, "least(x, y)": F.least}[both]
    return F.aggregate(steps, values, step)


def base_of(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    return F.array_sort(F.concat(spans_of(text, ASSIGN, 0, 2, 6), spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)))


def scan(docs: DataFrame, id_col: str, text_col: str, least_token: int) -> DataFrame:
    """(doc_id, base, tokens): spans of the fixed patterns by start, then kind,
    and of long tokens that overlap none of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), base_of(text).alias("base"),
                       spans_of(text, _token(least_token), 3).alias("tokens"))
    # all by their start; a token is clear of the base spans that begin before it if the latest end of
    # those is not behind its start, and of the others if the earliest start of those is not before its end
    items = F.array_sort(F.concat("base", "tokens"))
    own = rows.select("doc_id", "base", items.alias("items")).withColumn(
        "end", running(F.transform("items", lambda x: F.when(x["kind"] < 3, x["end"]).otherwise(F.lit(-1))), "greatest(x, y)")
    ).withColumn("start", F.reverse(running(F.reverse(F.transform(
        "items", lambda x: F.when(x["kind"] < 3, x["start"]).otherwise(F.lit(2**31 - 1)))), "least(x, y)")))
    clear = F.transform(F.filter(F.arrays_zip("items", "end", "start"), lambda x: (x["items"]["kind"] == 3) & (
        x["end"] <= x["items"]["start"]) & (x["start"] >= x["items"]["end"])), lambda x: x["items"])
    return own.select("doc_id", "base", clear.alias("tokens"))


def _code(text: Column, at: Column) -> Column:
    """Place of a character in the alphabet, from 1; 0 before the first character."""
    return F.when(at < 1, 0).otherwise(F.position(F.substr(text, at, F.lit(1)), F.lit(ALPHABET)))


def pair_counts(strings: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of neighbouring characters (codes) in column ``value``; collected,
    since there are at most (len(ALPHABET) + 1) ** 2 of them."""
    # each different string is cut up once
    counted = strings.where(F.length("value") > 0).groupBy("value").agg(F.count("*").alias("n"))
    pairs = counted.select("n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("value")),
        lambda i: F.struct(_code(F.col("value"), i - 1).alias("a"), _code(F.col("value"), i).alias("b")))).alias("p"))
    return {(r["a"], r["b"]): r["n"] for r in pairs.groupBy("p.a", "p.b").agg(F.sum("n").alias("n")).collect()}


def ratio_table(random: dict[tuple[int, int], int], ordinary: dict[tuple[int, int], int],
                smoothing: float = 0.5) -> list[float]:
    """Log ratio of the transition probabilities of two models, at a * len(ALPHABET) + b - 1."""
    size = len(ALPHABET)

    def logs(counts: dict[tuple[int, int], int]) -> list[float]:
        out = []
        for a in range(size + 1):
            total = sum(counts.get((a, b), 0) for b in range(1, size + 1)) + smoothing * size
            out += [log((counts.get((a, b), 0) + smoothing) / total) for b in range(1, size + 1)]
        return out

    return [x - y for x, y in zip(logs(random), logs(ordinary), strict=True)]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_token: int = 16,
                 threshold: float = 8.0) -> DataFrame:
    """(doc_id, base, added) of each row: spans as array<struct<start, kind, end,
    value, score>>, by start, then kind (an index into ``KINDS``).

    ``base`` are the matches of the fixed patterns. ``added`` are tokens of
    ``least_token`` or more characters that overlap no base span and whose
    log-likelihood ratio is at least ``threshold``. The models are counted on
    all distinct base values, and on all words of six or more letters of the
    rows without base spans. Where there are none of either (so also on an
    empty table) nothing is added. Null texts have no spans; ids may be
    null or repeat, each row is scanned by itself. Other columns are ignored.
    """
    found = staged(scan(docs, id_col, text_col, least_token), "scan")
    values = found.select(F.explode("base.value").alias("value")).distinct()
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.size(base_of(F.col("text"))) == 0)
    ordinary = texts.select(F.explode(F.regexp_extract_all("text", F.lit(_token(6)), F.lit(0))).alias("value"))
    random_counts, ordinary_counts = pair_counts(values), pair_counts(ordinary)

    scored = F.lit(None).cast("array<struct<start:int,kind:int,end:int,value:string,score:double>>")
    if random_counts and ordinary_counts:
        table = ",".join(map(repr, ratio_table(random_counts, ordinary_counts)))
        ratio = F.split(F.lit(table), ",").cast("array<double>")  # folded to a constant by the optimizer
        size = len(ALPHABET)

        def score(value: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(1), F.length(value)), F.lit(0.0),
                lambda acc, i: acc + F.get(ratio, _code(value, i - 1) * size + _code(value, i) - 1))

        scored = F.transform("tokens", lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["value"].alias("value"),
            score(c["value"]).alias("score")))
    plain = F.transform("base", lambda b: F.struct(
        b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"), b["value"].alias("value"),
        F.lit(None).cast("double").alias("score")))
    return found.select(
        "doc_id", plain.alias("base"),
        F.coalesce(F.filter(scored, lambda c: c["score"] >= threshold), F.array()).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
