import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers_llm import clashing, corpus, docs_of, lower_ascii

from streetflow.llm import ranked_search as rs


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text))


def plain(docs, items, top=20):
    """All scores by loops."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    lists = defaultdict(list)
    for r, (_, c) in enumerate(held):
        for t, tf in c.items():
            lists[t].append((r, tf))
    out = []
    for item, text in items:
        score = Counter()
        for t in terms(text):
            if t in df:
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                for r, tf in lists[t]:
                    m = 100 - 25 + (25 * sum(held[r][1].values()) * n) // total
                    score[r] += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
        best = sorted(((-s, held[r][0] is None, held[r][0] or 0) for r, s in score.items() if s > 0))[:top]
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(best)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


def found(spark, docs, items, top=20):
    table = clashing(docs_of(spark, items, "item_id long, text string, lang string, source string, n_chars long"))
    got = rs.search(clashing(docs_of(spark, docs)), table, top).select("row.item_id", "rank", "doc_id", "score").collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


def some(seed=2):
    rng = random.Random(seed)
    docs = [*enumerate(corpus())] + [(i, " ".join(rng.choice("the of a Ñandú x1 ÉTÉ été über 42".split()) for _ in range(
        rng.randrange(1, 40)))) for i in range(500, 700)]
    docs += [(None, "null id über"), (None, "null id über"), (501, "again Ñandú"), (501, "again Ñandú"), (900, "!!! ..."), (901, None)]
    texts = [t for _, t in docs if t]
    items = [(i, " ".join(rng.choice(texts).split()[:rng.randrange(1, 60)])) for i in range(40)]
    items += [(None, "über x1"), (7, "the the of"), (7, "the the of"), (50, None), (51, ""), (52, "..."), (53, "nowhere"), (54, docs[-7][1])]
    return docs, items


def test_equals_adding_everything(spark):
    docs, items = some()
    assert found(spark, docs, items) == plain(docs, items)


def test_small_slices_bundles_and_ranks(spark, monkeypatch):
    """Several bundles and many slices, whose best must be merged, and pruning with a
    short ranking."""
    monkeypatch.setattr(rs, "_ITEMS", 17)
    docs, items = some(3)
    assert found(spark, docs, items, 3) == plain(docs, items, 3)


def test_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in (9, 3, 30, 12, 4)] + [(100 + i, "other") for i in range(10)]
    assert [r[2] for r in found(spark, docs, [(1, "words")], 3)] == [3, 4, 9]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_terms_of_one_hash_are_told_apart():
    """Were two terms to share a hash, their bytes decide."""
    v = rs.Vocabulary(["abc xyz", "longer"])
    data = np.frombuffer(b"abc xyz longer abc abx", np.uint8)
    t = rs.Terms(data, np.array([0, len(data)]))
    t.hash[:] = 5
    v.hash[:] = 5
    at, number = v.find(t)
    order = np.argsort(at)
    assert at[order].tolist() == [0, 1, 2, 3] and number[order].tolist() == [0, 1, 2, 0]


def test_pruning_leaves_out_accumulators(spark):
    """Later owners carry fewer accumulators than there are scores."""
    rng = random.Random(1)
    docs = [(i, " ".join(["common", *(f"w{rng.randrange(300)}" for _ in range(20))])) for i in range(2000)]
    texts = [docs[i][1] for i in range(10)]
    table = docs_of(spark, docs)
    v = rs.Vocabulary(texts)
    slices = rs.blocks(table, v, "doc_id", "text")
    assert slices.selectExpr("sum(docs)").first()[0] == 2000
    kept = []
    real = rs._stage

    def counted(*args):
        out = real(*args)
        kept.append(out.selectExpr("coalesce(sum(size(item)), 0)").first()[0])
        return out

    rs._stage = counted
    try:
        got = found(spark, docs, list(enumerate(texts)), 5)
    finally:
        rs._stage = real
    assert got == plain(docs, list(enumerate(texts)), 5)
    assert kept[-1] <= 50 * 4 and max(kept) < 20000 * 0.6
