"""Toxicity by the nearest labelled examples.

Exact TF-IDF cosine over all terms of the examples (words, and the first four
letters of longer ones), searched through a block-max inverted index, many texts
at a time: the longest lists are rows of a matrix, so that one product in single
precision and the short lists' postings bound the cosines with all examples; the
largest bounds of blocks of examples tell which blocks can hold the nearest, and
the examples there whose bound reaches the k-th get their cosine in double
precision from their own terms. A term weighs more the better it tells the labels
apart. The neighbours' labels are voted with their cosines as weights, and the
vote is calibrated by leaving each example out.

The index holds a bounded sample of the labelled rows, so each task gets the
whole of it; chi-squared of terms and the rates of labels cover that sample,
document frequencies all documents. Every document is then scored by itself,
wherever it lies.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import sample_by_hash, staged

_WORD = re.compile(r"\w+")
_ASCII_GAPS = str.maketrans({chr(i): " " for i in range(128) if not _WORD.match(chr(i))})
_STEM = 4
_BLOCK = 32
#: Lists held as rows of a matrix at most, and the least length of one.
_ROWS, _LONG = 1024, 64
#: Texts searched at a time.
_QUERIES = 128
#: Words whose terms are remembered, and words counted at a time.
_WORDS, _CHUNK = 1 << 18, 1 << 17


def words_of(text: str) -> list[str]:
    """A text's words, lowered; in ASCII the matches of ``_WORD`` are what other characters leave."""
    text = text.lower()
    return text.translate(_ASCII_GAPS).split() if text.isascii() else _WORD.findall(text)


def terms(text: str) -> Counter:
    """Counts of a text's words, lowered, and of their stems (``word*``)."""
    words = Counter(words_of(text))
    out = Counter(words)
    for w, n in words.items():
        if len(w) > _STEM:
            out[w[:_STEM] + "*"] += n
    return out


class Known(dict):
    """Word -> its number in ``both``, which has the numbers of its terms in
    ``place``, the word's own and its stem's (-1: none)."""

    def __init__(self, place: dict[str, int]) -> None:
        super().__init__()
        self.place = place
        self.both = array("q")

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.both.append(self.place.get(word, -1))
        self.both.append(self.place.get(word[:_STEM] + "*", -1) if len(word) > _STEM else -1)
        return n

    def __reduce__(self) -> tuple:
        return Known, (self.place,)

    def _counted(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self) > _WORDS:
            self.clear()
            self.both = array("q")
        size = [len(w) for w in words]
        number = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, sum(size))
        span = max(1, len(self.place))
        row = np.repeat(np.arange(len(words)) * span, size)
        at = np.frombuffer(self.both, np.int64).reshape(-1, 2)[number]
        pair, n = np.unique((at + row[:, None])[at >= 0], return_counts=True)
        return pair // span, pair % span, n

    def batch(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, terms, counts) of the texts' known terms, by row and term: ``terms`` without the others."""
        out, words, lo, total = [], [], 0, 0
        for i, text in enumerate(texts, 1):
            words.append(words_of(text or ""))
            total += len(words[-1])
            if total >= _CHUNK or i == len(texts):
                row, term, n = self._counted(words)
                out.append((row + lo, term, n))
                words, lo, total = [], i, 0
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def counts(self, text: str) -> dict[int, int]:
        """Counts of a text's known terms by number."""
        _, term, n = self.batch([text])
        return dict(zip(term.tolist(), n.tolist(), strict=True))


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers from each start to before its end, one after the other; lengths)."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size), size


class Index:
    """Block-max inverted index of L2-normalised TF-IDF vectors."""

    def __init__(self, vocabulary: dict[str, float], ids: list[int], labels: list[int],
                 texts: list[Counter] | list[dict[int, int]]) -> None:
        """``vocabulary``: weight of each term; ``texts``: counts by term, or by place in the vocabulary."""
        self.place = {t: i for i, t in enumerate(vocabulary)}
        self.known = Known(self.place)
        self.idf = np.fromiter(vocabulary.values(), np.float64, len(vocabulary))
        vectors = [self.weigh({self.place.get(t, t): n for t, n in c.items()}) for c in texts]
        # neighbours in the index share their heaviest term, which keeps block bounds tight
        held = sorted((i for i, (t, _) in enumerate(vectors) if len(t)),
                      key=lambda i: (vectors[i][0][np.argmax(vectors[i][1])], i))
        self.ids = np.array([ids[i] for i in held], np.int64)
        self.labels = np.array([labels[i] for i in held], np.float64)
        self.blocks = -(-len(held) // _BLOCK)
        none = (np.zeros(0, np.int64), np.zeros(0))
        term, weight = (np.concatenate(x) for x in zip(none, *(vectors[i] for i in held), strict=True))
        size = np.array([len(vectors[i][0]) for i in held], np.int64)
        # terms of example i: from own[i]
        self.own, self.term, self.weight = np.concatenate([[0], np.cumsum(size)]), term.astype(np.int32), weight
        length = np.bincount(term, minlength=len(vocabulary))
        longest = np.argsort(-length, kind="stable")[:_ROWS]
        longest = longest[length[longest] >= _LONG]
        # row of a term in the matrix, or -1; postings of the others: from start[t]
        self.row = np.full(len(vocabulary), -1, np.int32)
        self.row[longest] = np.arange(len(longest))
        self.rows = len(longest)
        short = np.flatnonzero(self.row[term] < 0)
        short = short[np.argsort(term[short], kind="stable")]
        self.start = np.searchsorted(term[short], np.arange(len(vocabulary) + 1))
        self.docs, self.weights = np.repeat(np.arange(len(held), dtype=np.int32), size)[short], weight[short]
        self.without = [i for i, (t, _) in enumerate(vectors) if not len(t)]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "matrix"}

    @cached_property
    def matrix(self) -> np.ndarray:
        """Weights of the longest lists, a row each, in single precision."""
        out = np.zeros((self.rows, self.blocks * _BLOCK), np.float32)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.own))
        row = self.row[self.term]
        out[row[row >= 0], doc[row >= 0]] = self.weight[row >= 0]
        return out

    def weigh(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of a text in the index's space; empty if no term is known."""
        t = np.array(sorted(counts), np.int64)
        w = (1 + np.log(np.array([counts[i] for i in t.tolist()], np.float64))) * self.idf[t]
        norm = np.sqrt((w * w).sum())
        return (t, w / norm) if norm else (t[:0], w[:0])

    def vector(self, counts: Counter) -> list[tuple[int, float]]:
        """(term, weight) of a text, from the counts of all its terms."""
        t, w = self.weigh({self.place[x]: n for x, n in counts.items() if x in self.place})
        return list(zip(t.tolist(), w.tolist(), strict=True))

    def nearest(self, query: list[tuple[int, float]], k: int, leave: int = -1) -> list[tuple[float, int]]:
        """The k examples of highest cosine above 0, as (cosine, place), ties by place; exact."""
        return self.search(np.array([t for t, _ in query], np.int64), np.array([w for _, w in query], np.float64), k, leave)

    def search(self, t: np.ndarray, w: np.ndarray, k: int, leave: int = -1) -> list[tuple[float, int]]:
        """``nearest`` of (terms, weights)."""
        return self.search_all(np.zeros(len(t), np.int64), t, w, 1, k, [leave])[0]

    def weigh_all(self, row: np.ndarray, t: np.ndarray, n: np.ndarray, texts: int) -> np.ndarray:
        """Weights of the terms of several texts: (rows, terms, counts) as of ``Known.batch``."""
        w = (1 + np.log(n)) * self.idf[t]
        return w / np.sqrt(np.bincount(row, w * w, texts))[row]

    def search_all(self, row: np.ndarray, t: np.ndarray, w: np.ndarray, texts: int, k: int,
                   leave: Sequence[int] | None = None) -> list[list[tuple[float, int]]]:
        """``nearest`` of each of ``texts`` texts: (rows, terms, weights) by row."""
        out = []
        for lo in range(0, texts, _QUERIES):
            n = min(_QUERIES, texts - lo)
            a, b = np.searchsorted(row, [lo, lo + n])
            out += self._search(row[a:b] - lo, t[a:b], w[a:b], n, k, None if leave is None else leave[lo:lo + n])
        return out

    def _search(self, row: np.ndarray, t: np.ndarray, w: np.ndarray, texts: int, k: int,
                leave: Sequence[int] | None) -> list[list[tuple[float, int]]]:
        if not len(t) or not len(self.ids):
            return [[] for _ in range(texts)]
        width = self.blocks * _BLOCK
        column = self.row[t]
        long = column >= 0
        query = np.zeros((texts, self.rows), np.float32)
        query[row[long], column[long]] = w[long]
        i, size = _ranges(self.start[t[~long]], self.start[t[~long] + 1])
        near = np.bincount(np.repeat(row[~long] * width, size) + self.docs[i],
                           self.weights[i] * np.repeat(w[~long], size), texts * width).reshape(texts, width)
        near += query @ self.matrix
        for j, x in enumerate(leave or ()):
            if x >= 0:
                near[j, x] = 0
        near = near.reshape(texts, self.blocks, _BLOCK)
        tops = near.max(axis=2)
        kth = np.partition(tops, -k, axis=1)[:, -k] if self.blocks > k else np.zeros(texts)
        # at most twice what rounding takes from a sum of products that is at most 1; sums without a term stay 0
        slack = 2 * (self.rows + 4) * 2.0 ** -24
        ends = np.searchsorted(row, np.arange(texts + 1))
        dense = np.zeros(len(self.idf))
        out = []
        for j in range(texts):
            # k blocks reach kth, so the k nearest by their bounds are in blocks that do
            inside = near[j, tops[j] >= kth[j]].ravel()
            least = max(np.partition(inside, -k)[-k] - slack, 0.0) if len(inside) > k else 0.0
            blocks = np.flatnonzero((tops[j] >= least) & (tops[j] > 0))
            held = near[j, blocks]
            block, place = np.nonzero((held >= least) & (held > 0))
            found = blocks[block] * _BLOCK + place
            spans = [slice(x, y) for x, y in zip(self.own[found].tolist(), self.own[found + 1].tolist(), strict=True)]
            if not spans:
                out.append([])
                continue
            mine = slice(ends[j], ends[j + 1])
            dense[t[mine]] = w[mine]
            share = dense[np.concatenate([self.term[x] for x in spans])] * np.concatenate([self.weight[x] for x in spans])
            cosine = np.add.reduceat(share, np.cumsum([0] + [x.stop - x.start for x in spans[:-1]]))
            dense[t[mine]] = 0
            out.append(sorted(zip(cosine.tolist(), found.tolist(), strict=True), key=lambda p: (-p[0], p[1]))[:k])
        return out

    def vote(self, near: list[tuple[float, int]], prior: float) -> float:
        """Mean label of the neighbours weighted by squared cosine, with one vote for the prior's rate."""
        weight = sum(c * c for c, _ in near)
        return (sum(c * c * self.labels[i] for c, i in near) + 0.5 * prior) / (weight + 0.5)


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a * logit(vote) + b), by ridge Newton steps; the identity if a label is missing."""
    if len(labels) == 0 or labels.min() == labels.max():
        return 1.0, 0.0
    z = np.c_[np.log(votes / (1 - votes)), np.ones(len(votes))]
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - labels) + (w - [1.0, 0.0])
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.eye(2), grad)
    return float(max(w[0], 1e-3)), float(w[1])


def held_out_of(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   label_col: str = "toxic", per_label: int = 2_000, k: int = 15) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of each row of ``docs``.

    ``held_out`` rows' labels are never used. Of the others at most
    ``per_label`` of each label, chosen by hash of the id, make the index, with
    all their terms. A term weighs its inverse document frequency in ``docs``
    by the root of 1 + its chi squared between the labels. ``score`` is the
    calibrated probability of label 1, ``evidence`` the nearest examples as
    array<struct<doc_id, cosine, label>>. Texts without any such term, null and
    empty ones included, score what such examples' labels show. Null labels are
    none; an id whose labels disagree counts as 1. Rows may repeat or lack an
    id. Without labelled rows the score is 0.5, with one label only its own
    smoothed rate. An empty table gives an empty result. Other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(~held_out_of(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    rate = known.agg(F.sum("y").alias("k"), F.count("*").alias("n")).first()
    prior = ((rate["k"] or 0) + 1) / (rate["n"] + 2)

    chosen = None
    for y in (0, 1):
        part = sample_by_hash(known.where(F.col("y") == y), "doc_id", per_label)
        chosen = part if chosen is None else chosen.union(part)
    sample = staged(rows.join(chosen, "doc_id").dropDuplicates(["doc_id"]), "examples")
    index, weights, a, b, none = _fit(sample, rows, prior, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                scores, places, cosines, ends = [], [], [], [0]
                row, t, n = index.known.batch(part.column(1).to_pylist())
                for near in index.search_all(row, t, index.weigh_all(row, t, n, part.num_rows), part.num_rows, k):
                    scores.append(_sigmoid(a, b, index.vote(near, prior), weights) if near else none)
                    places += [i for _, i in near]
                    cosines += [c for c, _ in near]
                    ends.append(len(places))
                at = np.array(places, np.int64)
                evidence = pa.StructArray.from_arrays(
                    [pa.array(index.ids[at]), pa.array(cosines, pa.float64()), pa.array(index.labels[at].astype(np.int32))],
                    names=["doc_id", "cosine", "label"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), evidence)],
                    names=["doc_id", "score", "evidence"])

    scored = rows.mapInArrow(
        run, "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,label:int>>")
    return scored.select("doc_id", held_out_of(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def _sigmoid(a: float, b: float, vote: float, shift: float) -> float:
    vote = min(max(vote, 1e-6), 1 - 1e-6)
    return 1 / (1 + np.exp(-float(np.clip(a * log(vote / (1 - vote)) + b + shift, -30, 30))))


def _document_counts(rows: DataFrame, place: dict[str, int]) -> tuple[int, np.ndarray]:
    """(number of rows, number of rows with each term) of all ``rows``."""
    known = Known(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(place) + 1, np.int64)
        for batch in batches:
            n[-1] += batch.num_rows
            for lo in range(0, batch.num_rows, 512):
                n[:-1] += np.bincount(known.batch(batch.column(0).slice(lo, 512).to_pylist())[1], minlength=len(place))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], names=["term", "n"])

    # at most one row a term
    out = rows.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(place) + 1, np.int64)
    n[out["term"].to_numpy()] = out["n"].to_numpy()
    return int(n[-1]), n[:-1]


def _fit(sample: DataFrame, rows: DataFrame, prior: float, k: int) -> tuple[Index, float, float, float, float]:
    """(index, shift of the log odds from the sample's rate to the rows', a, b,
    score of texts without terms) from the staged examples."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1), strict=True):
                own = sorted(terms(t.as_py() or ""))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([y.as_py()] * len(own), pa.int32())],
                                                 names=["term", "y"])

    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Index({}, [], [], []), 0.0, 1.0, 0.0, prior if n0 or n1 else 0.5
    # the terms of a bounded number of texts
    by_term = sample.select("text", "y").mapInArrow(counts, "term string, y int").groupBy("term").agg(
        F.sum("y").alias("p"), F.count("*").alias("d")).orderBy("term").toArrow()
    d = by_term["d"].to_numpy().astype(np.float64)
    p = by_term["p"].to_numpy().astype(np.float64)
    n = n1 + n0
    chi2 = n * (p * (n0 - d + p) - (d - p) * (n1 - p)) ** 2 / np.maximum(d * (n - d) * n1 * n0, 1.0)
    place = {t: i for i, t in enumerate(by_term["term"].to_pylist())}
    n_docs, df = _document_counts(rows, place)
    weight = (np.log((1 + n_docs) / (1 + df)) + 1) * np.sqrt(1 + chi2)

    examples = _vectors(sample, place)
    ids, labels = [e[0] for e in examples], [e[1] for e in examples]
    index = Index(dict(zip(place, weight.tolist(), strict=True)), ids, labels, [e[2] for e in examples])
    # the sample holds labels in other shares than the rows do
    shift = log(prior / (1 - prior)) - log((n1 + 1) / (n0 + 1))
    place = {int(d): i for i, d in enumerate(index.ids)}
    votes, truth = [], []
    held = [e for e in examples if e[0] in place]
    vectors = [index.weigh(c) for _, _, c in held]
    for lo in range(0, len(held), _QUERIES):
        part = vectors[lo:lo + _QUERIES]
        row = np.repeat(np.arange(len(part)), [len(t) for t, _ in part])
        t, w = (np.concatenate(x) for x in zip(*part, strict=True))
        leave = [place[e[0]] for e in held[lo:lo + _QUERIES]]
        for e, near in zip(held[lo:], index.search_all(row, t, w, len(part), k, leave)):
            votes.append(min(max(index.vote(near, prior), 1e-6), 1 - 1e-6))
            truth.append(e[1])
    a, b = calibrate(np.array(votes), np.array(truth, float))
    z1 = sum(labels[i] for i in index.without)
    z0 = len(index.without) - z1
    # rate among examples without terms, weighted back to the rows' shares of labels
    odds = (z1 / n1 * prior + 0.5 / n) / (z0 / n0 * (1 - prior) + 0.5 / n)
    return index, shift, a, b, odds / (1 + odds)


def _vectors(sample: DataFrame, place: dict[str, int]) -> list[tuple[int, int, dict[int, int]]]:
    """(doc_id, label, counts of terms by number) of every example: a bounded number of texts."""
    known = Known(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.counts(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.int64())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))],
                names=["doc_id", "y", "term", "n"])

    out = sample.select("doc_id", "y", "text").mapInArrow(
        run, "doc_id long, y int, term array<long>, n array<long>").orderBy("doc_id").toArrow()
    return [(d, y, dict(zip(t.as_py(), n.as_py(), strict=True)))
            for d, y, t, n in zip(out["doc_id"].to_pylist(), out["y"].to_pylist(), out["term"], out["n"], strict=True)]
