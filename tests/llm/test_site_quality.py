import random

import numpy as np
from helpers_llm import clashing, docs_of, prose

from streetflow.llm import site_quality as Q


def corpus(n=500, seed=2):
    """Prose, and junk of several kinds; source 'bad.example' has mostly junk."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad_site = rng.random() < 0.3
        junk = rng.random() < (0.8 if bad_site else 0.15)
        words = [w.strip("w") + rng.choice("aeiou") for w in prose(rng, rng.randrange(30, 200), 3000)]
        if junk:
            kind = rng.randrange(3)
            words = [words[:1] * 60, [w.upper() + "!!" for w in words], [w + "%%%" for w in words]][kind]
        docs.append((i, " ".join(words), rng.choice(["en", "de"]),
                     f"https://{'bad' if bad_site else 'good'}.example/{rng.choice('ab')}/x{i}", 0))
        labels.append((i, int(not junk), 0))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy_and_site_rates(spark):
    docs, labels = corpus()
    d, l = frames(spark, docs, [x for x in labels if x[0] % 4])
    rows = {r["doc_id"]: r for r in Q.classify(clashing(d), clashing(l)).collect()}
    truth = {i: y for i, y, _ in labels}
    assert np.mean([rows[i]["kept"] == bool(truth[i]) for i in truth if i % 4 == 0]) > 0.95
    rate = {r["host"]: r["host_rate"] for r in rows.values()}
    assert rate["bad.example"] < 0.5 < rate["good.example"]
    assert {r["path"] for r in rows.values()} >= {"good.example/a/en", "bad.example/b/de"}


def test_sites_move_a_doubtful_document(spark):
    docs, labels = corpus()
    same = "plain words of no great note here"
    docs += [(900, same, "en", "http://good.example/a/1", 0), (901, same, "en", "http://bad.example/a/1", 0)]
    d, l = frames(spark, docs, labels)
    rows = {r["doc_id"]: r for r in Q.classify(d, l).collect()}
    assert rows[900]["evidence"] == rows[901]["evidence"] and rows[900]["score"] > rows[901]["score"]


def test_rates_match_a_plain_computation(spark):
    docs, labels = corpus(200)
    d, l = frames(spark, docs, labels)
    rows = Q.classify(d, l).collect()
    truth = {i: y for i, y, _ in labels}
    n, k = {}, {}
    for r in rows:
        n[r["path"]] = n.get(r["path"], 0) + 1
        k[r["path"]] = k.get(r["path"], 0) + truth[r["doc_id"]]
    for r in rows:  # a path's rate lies between its own share and its host's rate
        lo, hi = sorted((k[r["path"]] / n[r["path"]], r["host_rate"]))
        assert lo - 1e-9 <= r["path_rate"] <= hi + 1e-9


def test_features():
    data = np.frombuffer(b"aa bb aa\nCC!! CC!!  CC!! CC!! CC!! 12 34", np.uint8)
    x = dict(zip(Q.FEATURES, Q.features(data, np.array([0, 0, len(data)]))[1], strict=True))
    assert x["distinct"] == 5 / 10 and x["top_share"] == 5 / 10 and x["upper"] == 10 / len(data)
    assert x["worst_upper"] == 10 / (len(data) - 9) and x["worst_bangs"] == 10 / (len(data) - 9)
    assert Q.features(data, np.array([0, 0, len(data)]))[0].tolist() == [0.0] * 14 + [1.0]


def test_edge_cases(spark):
    docs, labels = corpus(120)
    docs += [(None, "x", None, None, 0), (None, None, None, None, None), (1000, "", "en", "", 0), (5, *docs[5][1:]),
             (1001, "word " * 40000, "en", "a/b/c", 0), (1002, "\n\n\n", "en", "http://", 0)]
    d, l = frames(spark, docs, [*labels, (5, 0, 0), (None, 1, 1), (6, None, None)])
    out = Q.classify(d, l).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
    none = Q.classify(d, l.where("quality is null")).collect()
    assert all(r["kept"] and r["score"] == 1 for r in none)
    assert {r["score"] for r in Q.classify(d, l.where("quality = 0 and doc_id <> 5")).collect()} == {0.5}
    assert Q.classify(docs_of(spark, []), l).count() == 0
