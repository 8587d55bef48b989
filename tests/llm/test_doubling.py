import re

from helpers_llm import clashing, corpus, docs_of

from streetflow.llm import doubling


def brute(rows, words):
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    low = {}
    for i, w in tokens:
        if i is not None:
            for a in range(len(w) - words + 1):
                g = tuple(w[a:a + words])
                low[g] = min(low.get(g, i), i)
    out = []
    for i, w in tokens:
        gone = set()
        for a in range(len(w) - words + 1):
            if i is not None and low[tuple(w[a:a + words])] < i:
                gone |= set(range(a, a + words))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_matches_brute_force(spark):
    texts = corpus(groups=4)
    for words in (13, 4):
        rows = list(enumerate(texts))
        assert result(doubling.substring_dedup(clashing(docs_of(spark, rows)), words=words)) == brute(rows, words)


def test_ties_repeats_and_a_passage_that_all_share(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    same = " ".join(["la"] * 50)  # one window over and over
    rows = [(i, f"x{i} {passage} y{i}") for i in range(60)] + [(100, same), (101, same + " la"), (102, "la " * 12)]
    rows += [(200, passage), (200, passage), (200, same), (None, passage), (None, None), (300, None), (301, "")]
    assert result(doubling.substring_dedup(docs_of(spark, rows))) == brute(rows, 13)


def test_join_by_shuffle_gives_the_same(spark, monkeypatch):
    rows = [*enumerate(corpus(groups=2)), (None, "a b"), (None, None)]
    expected = brute(rows, 5)
    assert result(doubling.substring_dedup(docs_of(spark, rows), words=5)) == expected
    monkeypatch.setattr(doubling, "SMALL_ROWS", -1)
    assert result(doubling.substring_dedup(docs_of(spark, rows), words=5)) == expected


def test_empty(spark):
    assert doubling.substring_dedup(docs_of(spark, [])).count() == 0
