"""Quality classifier with hierarchical empirical Bayes over sites.

1. A scan turns each text into a few bounded features; a ridge logistic model of
   them is fitted on a bounded sample of labelled rows.
2. Every document's probability (its label, where it has one) is evidence about
   its site. Paths shrink toward their host and hosts toward the global rate:
   beta-binomial posteriors whose strengths come from the sites themselves by
   the method of moments. All of this is grouped sums over all documents.
3. A document's posterior odds are the classifier's odds times the odds of its
   path, without the document itself, over the global odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import sample_by_hash, staged
from streetflow.llm.textscan import Words, mix, slices

FEATURES = ("log_words", "short", "word_length", "distinct", "top_share", "upper", "symbols", "bangs", "digits",
            "worst_upper", "worst_symbols", "worst_bangs", "worst_distinct", "repeated_lines", "empty")
#: Shorter lines do not count as a text's worst line.
_LINE_BYTES = 20

_CLASSES = np.zeros((4, 256), np.int32)
for _i, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "#$%&*|<>{}[]\\^~=_@+/", "!?", "0123456789")):
    _CLASSES[_i, list(_chars.encode())] = 1

_U = np.uint64


def _distinct(group: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, copies of the most frequent) of each group."""
    with np.errstate(over="ignore"):
        key = mix(h + mix(group.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(1)))
    _, at, copies = np.unique(key, return_index=True, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, group[at], copies)
    return np.bincount(group[at], minlength=n), most


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text of a slice."""
    n = len(offsets) - 1
    w = Words(data, offsets, lower=False)
    words = np.diff(w.first)
    size = np.diff(offsets)
    totals = np.zeros((len(_CLASSES), len(data) + 1), np.int64)
    for i, table in enumerate(_CLASSES):
        np.cumsum(table[data], out=totals[i, 1:])
    distinct, most = _distinct(w.row, w.hash, n)
    some, letters = np.maximum(words, 1), np.maximum(size, 1)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = np.log1p(words)
    out[:, 1] = 1 / np.sqrt(some)
    out[:, 2] = np.bincount(w.row, w.end - w.start, n) / some / 10
    out[:, 3] = distinct / some
    out[:, 4] = most / some
    out[:, 5:9] = ((totals[:, offsets[1:]] - totals[:, offsets[:-1]]) / letters).T

    # the same of each line, at its worst
    edge = np.zeros(len(data) + 1, bool)
    edge[np.flatnonzero(data == 10) + 1] = True
    edge[offsets] = True
    edge[len(data)] = False
    start = np.flatnonzero(edge)
    end = np.append(start[1:], len(data)) if len(start) else start
    row = np.searchsorted(offsets, start, "right") - 1
    lines = len(start)
    line_of = np.searchsorted(start, w.start, "right") - 1
    line_words = np.bincount(line_of, minlength=lines)
    line_distinct = _distinct(line_of, w.hash, lines)[0] / np.maximum(line_words, 1)
    long = end - start >= _LINE_BYTES
    out[:, 9:12] = out[:, 5:8]
    out[:, 12] = 1 - out[:, 3]
    shares = (totals[:3, end] - totals[:3, start]) / np.maximum(end - start, 1)
    for i in range(3):
        np.maximum.at(out[:, 9 + i], row[long], shares[i, long])
    np.maximum.at(out[:, 12], row[long], 1 - line_distinct[long])
    with np.errstate(over="ignore"):  # order-free, but enough to tell lines apart
        sums = np.zeros(lines, _U)
        np.add.at(sums, line_of, mix(w.hash))
    kinds = _distinct(row[long], sums[long], n)[0]
    out[:, 13] = 1 - kinds / np.maximum(np.bincount(row[long], minlength=n), 1)
    out[:, 13][np.bincount(row[long], minlength=n) == 0] = 0
    out[words == 0] = 0
    out[:, 14] = words == 0
    return out


def _scan(docs: DataFrame) -> DataFrame:
    """Adds array<double> ``x`` to (doc_id, host, path, t, text) and drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(4)):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, hi - lo) for c in batch.columns[:4]]
                    + [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                    names=["doc_id", "host", "path", "t", "x"])

    return docs.mapInArrow(run, "doc_id long, host string, path string, t long, x array<double>")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic model, by Newton steps."""
    z = np.c_[np.ones(len(x)), x]
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-3
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _strength(stats: DataFrame) -> float:
    """Beta strength of site rates (columns k of n) around their parents' (rate),
    by the method of moments: what their spread exceeds sampling noise by."""
    r = stats.agg(
        F.sum("n").alias("n"), F.count("*").alias("sites"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("rate")) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("rate") * (1 - F.col("rate"))).alias("within")).first()
    if not r["n"] or not r["within"]:
        return 1e6
    noise = r["within"] / r["n"]  # variance of one document around its parent's rate
    spread = (r["between"] - r["sites"] * noise) / (r["n"] - r["nn"] / r["n"] if r["sites"] > 1 else r["n"])
    rho = min(max(spread / noise, 1e-6), 1 - 1e-6)
    return (1 - rho) / rho


def site_of(source: Column, lang: Column) -> tuple[Column, Column]:
    """(host, path): the host of a source, and its first path segment and language below it."""
    plain = F.regexp_replace(F.lower(F.coalesce(source.cast("string"), F.lit(""))), "^[a-z]+://", "")
    host = F.regexp_extract(plain, "^[^/?#]*", 0)
    return host, F.concat_ws("/", host, F.regexp_extract(plain, "^[^/?#]*/([^/?#]*)", 1),
                             F.coalesce(lang.cast("string"), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", lang_col: str = "lang", *, label_col: str = "quality",
             sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """(doc_id, t, evidence, host, path, host_rate, path_rate, score, kept) of each
    row of ``docs``; ``score`` is the posterior probability of label 1, ``t`` the
    text's xxhash64.

    The model is fitted on at most ``sample`` labelled rows, chosen by hash of
    the id; all other counts cover all rows. Null and empty texts count as
    empty; null sources and languages are sites of their own; rows whose labels
    disagree use their mean; null labels are none. Rows may repeat or lack an
    id. Without labels of both kinds no model can be fitted, and every row's
    score is 1 (all kept) if there is no label 0, else 0.5. An empty table gives
    an empty result. Other columns are ignored.
    """
    host, path = site_of(F.col(source_col), F.col(lang_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.alias("host"), path.alias("path"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("t"),
                       F.col(text_col).cast("string").alias("text"))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("doc_id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    scanned = staged(_scan(rows).join(known, "doc_id", "left"), "features")

    fitted = sample_by_hash(scanned.where("y is not null").select("x", "y", "doc_id"), "doc_id", sample).toPandas()
    y = fitted["y"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        flat = F.lit(0.5 if len(y) and y.max() < 0.5 else 1.0)
        return scanned.select("doc_id", "t", flat.alias("evidence"), "host", "path", flat.alias("host_rate"),
                              flat.alias("path_rate"), flat.alias("score"), F.lit(True).alias("kept"))
    x = np.array(fitted["x"].tolist())
    mean, spread = x.mean(0), x.std(0) + 1e-9
    w = fit_logistic((x - mean) / spread, y)
    scale = w[1:] / spread
    logit = F.lit(float(w[0] - mean @ scale))
    for i, c in enumerate(scale):
        logit = logit + F.get("x", F.lit(i)) * float(c)
    evidence = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))
    judged = scanned.select("doc_id", "t", "host", "path", evidence.alias("evidence"),
                            F.coalesce("y", evidence).alias("vote"))

    # rates of hosts and paths, each shrunk toward its parent
    paths = staged(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("vote").alias("k")), "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    rate = (total["k"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    m = _strength(hosts.withColumn("rate", F.lit(rate)))
    hosts = hosts.select("host", ((F.col("k") + m * rate) / (F.col("n") + m)).alias("host_rate"))
    paths = paths.join(hosts, "host")
    m = _strength(paths.withColumn("rate", F.col("host_rate")))

    odds = lambda p: p / (1 - p)
    inside = lambda p: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    rest = inside((F.col("k") - F.col("vote") + m * F.col("host_rate")) / (F.col("n") - 1 + m))
    posterior = odds(inside(F.col("evidence"))) * odds(rest) / float(odds(rate))
    return judged.join(paths.select("path", "host", "n", "k", "host_rate"), ["host", "path"]).select(
        "doc_id", "t", "evidence", "host", "path", "host_rate",
        ((F.col("k") + m * F.col("host_rate")) / (F.col("n") + m)).alias("path_rate"),
        (posterior / (1 + posterior)).alias("score")).withColumn("kept", F.col("score") >= threshold)
