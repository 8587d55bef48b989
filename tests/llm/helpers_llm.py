"""Brute-force versions and fixtures of the text operators' tests."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, schema=SCHEMA):
    """Documents with ids from 0; entries may be texts or (id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], schema)


def clashing(df):
    """The same rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    for c in ("id", "t", "v", "key", "n", "a", "b", "part", "family", "row", "lines", "rest", "h", "at", "spots", "doc",
              "host", "path", "x", "y", "ws", "ids", "items", "base", "tokens", "score", "w", "kind"):
        df = df.withColumn(c, F.lit(f"clash {c}"))
    return df


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=5, groups=6, singles=20):
    """Texts with near copies, shared passages, exact copies and edge cases."""
    rng = random.Random(seed)
    out = [None, "", "   ", "one", "One", "one two", "Héllo  wörld\tfoo", "x" * 5000]
    passage = prose(rng, 30)
    for _ in range(groups):
        base = prose(rng, rng.randrange(20, 160), 5000)
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(copy))
        out.append(" ".join(base))
        out.append(" ".join(base).upper())
    for _ in range(singles):
        own = prose(rng, rng.randrange(5, 80), 50)
        if rng.random() < 0.4:
            own[rng.randrange(len(own)):0] = passage
        out.append("\n".join(" ".join(own[i:i + 9]) for i in range(0, len(own), 9)))
    out += [out[10], out[11], " ".join(prose(rng, 4000, 10**6))]
    rng.shuffle(out)
    return out


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, length):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + length]) for i in range(max(1, len(w) - length + 1)))
