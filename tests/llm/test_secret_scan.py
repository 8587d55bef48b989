import hashlib
import random
import re
from math import log

from helpers_llm import clashing, corpus, docs_of

from streetflow.llm import secret_scan
from streetflow.llm.queries import span_digests

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base_spans(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(t) if len(m[0]) >= 24]
    return sorted(out)


def texts_with_secrets():
    rng = random.Random(6)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    mixed = lambda n: "".join(rng.choice(secret_scan.ALPHABET[:62]) for _ in range(n))
    out = corpus(groups=1)
    for _ in range(60):
        out.append(f"Ünïcode 😀 begin {rng.choice(['password', 'PassWd', 'api_key', 'apikey', 'TOKEN'])}"
                   f"{rng.choice(['=', ': ', ' = ', chr(34) + ':' + chr(39)])}{mixed(rng.randrange(3, 30))} then\n"
                   f"AKIA{key(rng.randrange(8, 20))} and {hexa(rng.randrange(15, 45))} end {hexa(24)}")
    out += [f"the value {mixed(40)} stands alone", "ordinary_identifier_of_some_length and wordswithoutanybreakatall",
            "secret=token : abcdefgh", "token=token=abcdef1", "token==abc", "token == abcdef password='x' passwd:\"longenough",
            "paſſword=abcdefgh toKen=abcdefgh", "AKIAAKIA" + key(16), "AKIA" + key(16) + hexa(30), "secret" * 3 + "=abcdefg",
            hexa(24) + "g" + hexa(23), "x" + hexa(100), "token=\nabcdefgh"]
    return out


def test_base_spans_match_brute_force(spark):
    texts = texts_with_secrets()
    rows = [*enumerate(texts), (None, "token=abcdefgh"), (None, None), (4, "token=abcdefgh"), (4, "token=abcdefgh")]
    out = span_digests(secret_scan.scan_secrets(clashing(docs_of(spark, rows)))).collect()
    got, expected = [], []
    for r in out:
        got.append((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]))
        spans = r["spans"].split(",") if r["spans"] else []
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), secret_scan.KINDS.index(s.split(":")[0])))
    for i, t in rows:
        spans = base_spans(t)
        said = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        count = [sum(k == x for _, k, _ in spans) for x in range(3)]
        expected.append((i, *count, hashlib.sha256(said.encode()).hexdigest()))
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_models_add_random_tokens_only(spark):
    rng = random.Random(12)
    parts = "the of and ing tion er re th an on in he st en ly ed ti es or te some name word out any break at all length".split()
    words = lambda: " ".join(rng.choice(["", "_"]).join(rng.choice(parts) for _ in range(rng.randrange(2, 8))) for _ in range(300))
    texts = texts_with_secrets() + [words() for _ in range(60)]
    rows = {r["doc_id"]: r for r in secret_scan.scan_secrets(docs_of(spark, texts)).collect()}
    added = {texts[i][s["start"]:s["end"]] for i, r in rows.items() for s in r["added"]}
    alone = next(t for t in texts if t and t.startswith("the value ")).split()[2]
    assert alone in added
    assert not any(w in a for a in added for w in ("ordinary_identifier", "wordswithout"))
    for i, r in rows.items():  # value and score belong to the span, and the score is the models' ratio
        for s in r["added"]:
            assert texts[i][s["start"]:s["end"]] == s["value"] and s["score"] >= 8


def test_ratio_table():
    a = {(0, 1): 3, (1, 2): 2}
    b = {(0, 1): 1, (0, 2): 1}
    table, size = secret_scan.ratio_table(a, b, 0.5), len(secret_scan.ALPHABET)
    assert abs(table[0] - (log(3.5 / (3 + size / 2)) - log(1.5 / (2 + size / 2)))) < 1e-12
    assert len(table) == (size + 1) * size


def test_nothing_to_learn_from(spark):
    assert secret_scan.scan_secrets(docs_of(spark, [])).count() == 0
    rows = secret_scan.scan_secrets(docs_of(spark, ["plain words only", None, ""])).collect()
    assert all(r["base"] == [] and r["added"] == [] for r in rows) and len(rows) == 3


def test_native(spark):
    text = secret_scan.scan_secrets(docs_of(spark, texts_with_secrets()))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_models_count_all_documents_and_values(spark, monkeypatch):
    counted = []
    whole = secret_scan.ratio_table
    monkeypatch.setattr(secret_scan, "ratio_table", lambda random, ordinary: counted.append((random, ordinary)) or whole(random, ordinary))
    texts = ["plainword here" for _ in range(2500)] + [f"password = zq{i:06d}" for i in range(20500)]
    secret_scan.scan_secrets(docs_of(spark, texts))
    random, ordinary = counted[0]
    assert sum(ordinary.values()) == 2500 * len("plainword")
    assert sum(random.values()) == 20500 * 8


def test_many_matches_in_one_text(spark):
    """Work grows about as the matches: 100,000 in one text, half of them assignments and half long tokens."""
    import time

    from helpers_llm import docs_of

    text = "\n".join(f"token = abcdef{i} Zq8{i:017d}" for i in range(50_000))
    t = time.time()
    row = secret_scan.scan(docs_of(spark, [text]), "doc_id", "text", 20).selectExpr(
        "size(base) as b", "size(tokens) as t", "base[49999].end as e", "tokens[49999].start as s").first()
    assert (row.b, row.t) == (50_000, 50_000)
    last = text.rindex("\n") + 1
    assert (row.e, row.s) == (text.rindex(" "), text.rindex("Zq8")) and row.e > last
    assert time.time() - t < 30
