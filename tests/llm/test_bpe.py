import hashlib
import random

import public_tokenizers
import tiktoken
from helpers_llm import clashing, corpus, docs_of

from streetflow.llm import bpe
from streetflow.llm.queries import encoding_digests

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH),
                             special_tokens={})


def test_random_texts_encode_as_the_library_does():
    rng = random.Random(1)
    parts = ["a", "b", "s", "t", "re", "ve", "ll", "'", "'", "\"", " ", "  ", "\n", "\t", "1", "٣", "é", "ß", "!", "…",
             " ", "　", "😀", "한", "d", "m", "'s", "\r\n", "́", "\x1c", "\x85", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(5000)]
    enc = reference()
    for text, ids in zip(texts, bpe.encode_texts(texts, PATH), strict=True):
        assert ids.tolist() == enc.encode_ordinary(text), text
        assert bpe.decode_ids(ids, PATH).tobytes() == text.encode()


def test_scan_equals_stepping():
    """The associative scan gives the states that the automaton goes through."""
    rng = random.Random(2)
    text = "".join(rng.choice("ab1 '!\n\ts") for _ in range(1000))
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    whole = bpe.piece_starts(points, np.array([0])).tolist()
    import regex

    assert whole == [m.start() for m in regex.finditer(public_tokenizers.PATTERN, text)]


def test_long_pieces_and_empty_slices():
    enc = reference()
    texts = ["", "x" * 70000 + "aé" * 20000, "", " " * 5000, "a" * 47 + "b", "\n" * 300 + "a", ""]
    for text, ids in zip(texts, bpe.encode_texts(texts, PATH), strict=True):
        assert ids.tolist() == enc.encode_ordinary(text)


def test_query_digests_against_the_library(spark):
    texts = corpus() + [None, "", "tail's end"]
    enc = reference()
    rows = [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again")]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        expected.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    got = [tuple(r) for r in encoding_digests(clashing(docs_of(spark, rows))).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert encoding_digests(docs_of(spark, [])).count() == 0


def test_offsets_decode_a_part(spark):
    text = "Héllo wörld, it's 1234 o'clock"
    row = bpe.decode(bpe.encode(docs_of(spark, [text]), PATH), PATH).first()
    raw = text.encode()
    ends = [*row["offsets"][1:], len(raw)]
    assert bytes(row["decoded"]) == raw
    for i, a, b in zip(row["ids"], row["offsets"], ends, strict=True):
        assert bpe.decode_ids(__import__("numpy").array([i]), PATH).tobytes() == raw[a:b]
