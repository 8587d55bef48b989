from helpers_llm import clashing, components, corpus, docs_of, shingles

from streetflow.llm import bottomk


def brute(rows, length, percent=80):
    sets = {i: shingles(t, length) for i, t in rows}
    ids = list(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(ids, links)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in ids}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_matches_brute_force(spark):
    for length in (2, 5):
        texts = corpus(groups=12)
        assert result(bottomk.near_duplicates(clashing(docs_of(spark, texts)), length=length)) == brute(
            list(enumerate(texts)), length)


def test_hot_group_of_near_copies_and_a_common_passage(spark):
    import random

    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(400):  # near copies, many of them under the threshold of each other
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    common = " ".join(f"c{i}" for i in range(25))
    texts += [common + " " + " ".join(f"s{i}x{j}" for j in range(15)) for i in range(300)]
    texts += ["same text of all these rows"] * 300
    rng.shuffle(texts)
    assert result(bottomk.near_duplicates(docs_of(spark, texts), length=2)) == brute(list(enumerate(texts)), 2)


def test_edge_cases(spark):
    rows = [(None, "a b c"), (None, None), (7, "a b c"), (7, "a b c"), (3, "d e f"), (3, "a b c"), (1, None), (2, "")]
    out = bottomk.near_duplicates(docs_of(spark, rows), length=2).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_shingles"], r["component_id"], r["kept"]) for r in out
                 if r["component_id"] is not None)
    assert got == [((False, 1), 0, 1, True), ((False, 2), 0, 2, True), ((False, 3), 2, 3, True), ((False, 3), 2, 3, True),
                   ((False, 7), 2, 3, False), ((False, 7), 2, 3, False), ((True, 0), 2, 3, False)]
    assert sum(r["component_id"] is None for r in out) == 1
    assert bottomk.near_duplicates(docs_of(spark, []), length=2).count() == 0


def test_pairs_of_sizes_about_the_sketch(spark):
    """Sets under 64 shingles with partners over 64, at or just under the threshold."""
    texts = []
    for at, (small, large) in enumerate([(60, 75), (62, 77), (63, 76), (63, 77), (63, 78), (63, 79), (64, 80), (70, 87), (79, 98)]):
        for j in range(30):
            words = [f"w{at}x{j}x{i}" for i in range(large + 1)]
            texts += [" ".join(words[:small + 1]), " ".join(words)]
    assert result(bottomk.near_duplicates(docs_of(spark, texts), length=2)) == brute(list(enumerate(texts)), 2)
