import random
import re

from helpers_llm import clashing, corpus, docs_of, lower_ascii, prose

from streetflow.llm import winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items, words=10):
    windows = {}
    for k, t in items:
        w = WORD.findall(lower_ascii(t))
        n = min(words, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(k)
    lengths = {len(g) for g in windows}
    out = []
    for i, t in rows:
        w = WORD.findall(lower_ascii(t))
        hit, found = set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[a:a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    found |= own
        out.append((i, len(w), len(hit), sorted(str(k) for k in found if k is not None)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()), key=repr)


def test_matches_brute_force_with_items_of_every_length(spark):
    rng = random.Random(4)
    items = [(n, " ".join(prose(rng, n, 30))) for n in range(1, 30)] + [(100, None), (101, ""), (102, "!!"), (None, "w1 w2")]
    items += [(7, "Ünï W3"), (200, " ".join(prose(rng, 40, 10**6)))]
    texts = corpus(groups=2) + [" ".join(prose(rng, 300, 30)) for _ in range(20)]
    texts += [f"{t[:len(t) // 2]}; {x}, {t[len(t) // 2:]}" for t, (_, x) in zip(texts[-10:], items[9:19], strict=True)]
    texts += [(items[-1][1] + " ") * 3, "W1W2", "ünï-w3", "\x00w1\x7fw2"]
    rows = [*enumerate(texts), (None, "w1 w2"), (5, "w1 w2"), (5, "w1 w2")]
    for some in (items, items[15:29]):
        table = spark.createDataFrame(some, "item_id long, text string")
        assert result(winnow.decontaminate(clashing(docs_of(spark, rows)), clashing(table))) == brute(rows, some)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert result(winnow.decontaminate(docs_of(spark, ["a b c", None]), none)) == brute([(0, "a b c"), (1, None)], [])
    assert winnow.decontaminate(docs_of(spark, []), some).count() == 0


def test_native(spark):
    plan = winnow.decontaminate(docs_of(spark, ["a b"]), spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text
