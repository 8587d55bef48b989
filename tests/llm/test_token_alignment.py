import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
from helpers_llm import clashing, corpus, docs_of
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from streetflow.llm import token_alignment as ta
from streetflow.llm.queries import alignment

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain(rows):
    """The figures by the two libraries, whole texts, and loops over all token pairs."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B_PATH)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(c): c for c in shown}
    byte_of |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    count, docs = Counter(), []
    for doc_id, text in rows:
        groups, links, n_a, n_b = [], [], 0, 0
        if text:
            e = a.encode(" " + text, add_special_tokens=False)
            pa_ = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in e.ids]
            ids = b.encode(text)
            pb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                  else b.id_to_piece(i).replace("▁", " ").encode() for i in ids]
            if b"".join(pa_) == b"".join(pb) == b" " + text.encode():
                n_a, n_b = len(pa_), len(pb)
                spans = []
                for tokens in (pa_, pb):
                    at, own = 0, []
                    for t in tokens:
                        own.append((at, at + len(t)))
                        at += len(t)
                    spans.append(own)
                j = 0
                for i, (s, t) in enumerate(spans[0]):
                    while spans[1][j][1] <= s:
                        j += 1
                    k = j
                    while k < n_b and spans[1][k][0] < t:
                        links.append((e.ids[i], ids[k]))
                        k += 1
                common = sorted({x[1] for x in spans[0]} & {x[1] for x in spans[1]})
                at = [0, 0]
                for end in common:
                    inside = []
                    for k, (v, sp) in enumerate(((e.ids, spans[0]), (ids, spans[1]))):
                        to = next(i for i in range(at[k], len(v)) if sp[i][1] == end) + 1
                        inside.append(",".join(map(str, v[at[k]:to])))
                        at[k] = to
                    groups.append("|".join(inside))
        count.update(links)
        docs.append((doc_id, n_a, n_b, groups, links))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return sorted(
        ((i, n_a, n_b, len(g), len(ls), sum(count[x] == top[x[1]] for x in ls), sum(count[x] for x in ls),
          hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "") for i, n_a, n_b, g, ls in docs),
        key=lambda r: (r[0] is not None, r))


def some_texts():
    rng = random.Random(4)
    parts = ["a", "the", "señor", "'s", " ", "  ", "\n", "\t", "1234", "١٢", "é", "…", " ", "　", "😀", "한국", "<|endoftext|>",
             "<s>", "<0x41>", "▁", "\x00", "\x85", "Straße", "!!", "ndingnd", "ción", "é", "\r\n", "\x1c"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    return corpus() + odd + [" lead", "trail ", " ", "a  b", "x" * 3000, "word " * 500, "日本語" * 200]


FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=lambda r: (r[0] is not None, r))


def test_equals_the_libraries_and_plain_loops(spark):
    rows = [*enumerate(some_texts()), (None, "no id"), (None, None), (3, "again"), (3, "again")]
    assert rows_of(alignment(clashing(docs_of(spark, rows)))) == plain(rows)


def test_rare_pairs_are_joined(spark, monkeypatch):
    """With room for only a few pairs in every task the others come by the join."""
    monkeypatch.setattr(ta, "_HEAD", 40)
    monkeypatch.setattr(ta, "_SLICE_CHARS", 500)
    rows = [*enumerate(some_texts()[:120])]
    assert rows_of(alignment(docs_of(spark, rows))) == plain(rows)


def test_ids_are_those_of_the_library():
    """Every token of the vocabulary and odd texts: merging by ids gives what the library gives."""
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    texts = [library.decode([i]) for i in range(library.get_vocab_size())]
    texts = [t for t in texts + some_texts() if t] + [" " * 10000, "ab" * 20000, "\n" * 5000]
    expected = [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert ta.byte_level(A_PATH).encode(texts) == expected


def test_lists_give_the_overlaps(spark):
    texts = [t for t in some_texts()[:60]]
    a, b = ta.byte_level(A_PATH), ta.sentence_pieces(B_PATH)
    for r in ta.lists(ta.align(docs_of(spark, texts), A_PATH, B_PATH)).collect():
        a_end, b_end = np.cumsum(a.size[r["a_ids"]]), np.cumsum(b.size[r["b_ids"]])
        first, links = ta.overlaps(a_end, b_end)
        assert r["a_first"] == first.tolist() and r["a_links"] == links.tolist()


def test_empty_table_and_no_tokens(spark):
    assert rows_of(alignment(docs_of(spark, []))) == []
    assert rows_of(alignment(docs_of(spark, [None, ""]))) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(2)]


def test_gallop_and_overlaps():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (1, 500), (500, 1), (300, 4000), (4000, 300), (2000, 2100)):
        top = 10 * max(n, m)
        a, b = (np.append(np.sort(rng.choice(top, k - 1, replace=False)) + 1, top + 1) for k in (n, m))
        short, long = (a, b) if n <= m else (b, a)
        assert (ta.gallop(short, long) == np.searchsorted(long, short)).all()
        first, count = ta.overlaps(a, b)
        start = np.append(0, a[:-1])
        low = np.searchsorted(b, start, "right")
        assert (first == low).all() and (first + count - 1 == np.searchsorted(b, a)).all()
