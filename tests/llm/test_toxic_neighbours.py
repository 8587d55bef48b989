import random
import zlib
from collections import Counter

import numpy as np
from helpers_llm import clashing, docs_of, prose

from streetflow.llm import toxic_neighbours as T

BAD = ["vileword", "nastyone", "foulterm", "grimword"]


def labelled(n=600, seed=1):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(20, 120), 800)
        y = int(rng.random() < 0.25)
        for _ in range(y * rng.randrange(2, 6)):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ish"]))
        texts.append(" ".join(words))
        labels.append((i, 1, y))
    return texts, labels


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy_and_fields(spark):
    texts, labels = labelled()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = T.score_toxicity(clashing(docs_of(spark, texts)), clashing(lab)).collect()
    truth = {i: y for i, _, y in labels}
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        assert r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
        assert not any(held_out(e["doc_id"]) for e in r["evidence"])
    test = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in test]) > 0.97


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    texts, labels = labelled(300)
    flipped = [(i, 0, 1 - y if held_out(i) else y) for i, _, y in labels]
    schema = "doc_id long, quality int, toxic int"
    a = T.score_toxicity(docs_of(spark, texts), spark.createDataFrame(labels, schema)).select("doc_id", "score")
    df = docs_of(spark, texts).drop("lang", "source")
    b = T.score_toxicity(df, spark.createDataFrame(flipped, schema)).select("doc_id", "score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_search_is_exact():
    rng = random.Random(4)
    names = [f"t{i}" for i in range(60)]
    idf = {t: 1 + rng.random() * 4 for t in names}
    texts = [Counter({t: rng.randrange(1, 5) for t in rng.sample(names, rng.randrange(0, 9))}) for _ in range(500)]
    index = T.Index(idf, list(range(500)), [0] * 500, texts)
    dense = np.zeros((len(index.ids), 60))
    for at, i in enumerate(index.ids):
        for t, w in index.vector(texts[i]):
            dense[at, t] = w
    for _ in range(200):
        query = index.vector(Counter({t: rng.randrange(1, 4) for t in rng.sample(names, rng.randrange(0, 12))}))
        q = np.zeros(60)
        for t, w in query:
            q[t] = w
        cosine = dense @ q
        best = sorted(((round(c, 9), -i) for i, c in enumerate(cosine) if c > 0), reverse=True)[:15]
        assert sorted(round(c, 9) for c, _ in index.nearest(query, 15)) == sorted(c for c, _ in best)


def test_edge_cases(spark):
    schema = "doc_id long, quality int, toxic int"
    texts, labels = labelled(200)
    rows = [*enumerate(texts), (None, "vileword"), (None, None), (500, ""), (3, texts[3]), (3, texts[3]), (501, "x " * 50000)]
    lab = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None), (labels[8][0], 1, labels[8][2])], schema)
    out = T.score_toxicity(docs_of(spark, rows), lab).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["held_out"] for r in out if r["doc_id"] is None} == {False}
    none = spark.createDataFrame([], schema)
    assert {r["score"] for r in T.score_toxicity(docs_of(spark, texts[:5]), none).collect()} == {0.5}
    one = T.score_toxicity(docs_of(spark, texts[:5]), lab.where("toxic = 0")).collect()
    assert all(r["score"] < 0.1 and r["predicted"] == 0 for r in one)
    assert T.score_toxicity(docs_of(spark, []), lab).count() == 0


def test_wording_of_few_examples_counts(spark):
    """Toxic words that three examples each have, too few for any of them to stand out."""
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(400):
        y = int(i % 4 == 0)
        own = [f"rude{j}x" for j in rng.sample(range(60), 3)] if y else []
        texts.append(" ".join([*prose(rng, 12, 300), *own]))
        labels.append((i, 1, y))
    rows = T.score_toxicity(docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    test = [r for r in rows.collect() if r["held_out"]]
    assert all(r["evidence"] for r in test)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in test]) > 0.9


def test_document_frequencies_cover_all_documents(spark):
    texts = ["longer words here", None, "", "longest word, longest", "here and there", "Here"]
    place = {"here": 0, "long*": 1, "word": 2, "absent": 3}
    n, df = T._document_counts(docs_of(spark, texts).repartition(3), place)
    assert n == 6 and df.tolist() == [3, 2, 1, 0]


def test_search_of_many_texts_is_exact():
    """Long lists, short lists, texts without terms, equal examples and more texts than one step takes."""
    rng = random.Random(7)
    names = [f"w{i}" for i in range(40)] + [f"rare{i}" for i in range(3000)]
    idf = {t: 0.5 + rng.random() * 4 for t in names}

    def text():
        common = rng.sample(names[:40], rng.randrange(0, 30))
        return Counter({t: rng.randrange(1, 5) for t in common + rng.sample(names, rng.randrange(0, 20))})

    texts = [text() for _ in range(900)]
    texts += texts[:100]
    index = T.Index(idf, list(range(1000)), [0] * 1000, texts)
    assert index.rows == 40
    dense = np.zeros((len(index.ids), len(names)))
    for at, i in enumerate(index.ids):
        for t, w in index.vector(texts[i]):
            dense[at, t] = w
    queries = [Counter() if i % 50 == 0 else text() for i in range(150)] + [texts[i] for i in range(0, 900, 3)]
    words = [" ".join(x for t, n in q.items() for x in [t] * n) for q in queries]
    row, t, n = index.known.batch(words)
    leave = [-1 if i % 2 else i % len(index.ids) for i in range(len(queries))]
    found = index.search_all(row, t, index.weigh_all(row, t, n, len(queries)), len(queries), 15, leave)
    assert len(found) == len(queries)
    for j, near in enumerate(found):
        q = np.zeros(len(names))
        for at, w in index.vector(Counter(words[j].split())):
            q[at] = w
        cosine = dense @ q
        if leave[j] >= 0:
            cosine[leave[j]] = 0
        best = sorted(((round(c, 9), -i) for i, c in enumerate(cosine) if c > 0), reverse=True)[:15]
        assert [round(c, 9) for c, _ in near] == [c for c, _ in best]
        assert all(abs(cosine[i] - c) < 1e-9 for c, i in near) and len({i for _, i in near}) == len(near)


def test_known_terms_of_many_texts():
    texts = ["Longer words, longer", None, "", "wordy here WORD", "here " * 5]
    texts += ["tab\there_2 caf\u00e9 \u212aelvin", "a\x1fb\x00c\x7fd-e", "\u00a0here\u2003word"]
    assert [T.words_of(x or "") for x in texts] == [T._WORD.findall((x or "").lower()) for x in texts]
    known = T.Known({"longer": 0, "long*": 1, "word": 2, "word*": 3, "here": 4})
    row, term, n = known.batch(texts)
    got = [{} for _ in texts]
    for r, t, c in zip(row.tolist(), term.tolist(), n.tolist(), strict=True):
        got[r][t] = c
    assert got == [{known.place[t]: c for t, c in T.terms(x or "").items() if t in known.place} for x in texts]
