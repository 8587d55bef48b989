import hashlib
import random
import time

import corpus_pipeline as C
import public_tokenizers
import tiktoken
from helpers_llm import docs_of, prose

from streetflow.llm import bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, folder):
    """A small corpus with junk, copies, shared lines and a benchmark passage."""
    rng = random.Random(11)
    words = lambda n: [w.strip("w") + rng.choice("aeiou") + "t" for w in prose(rng, n, 10**6)]
    item = " ".join(words(25))
    line = "This line of a licence is found below very many of these documents."
    texts, kind = [], []
    for i in range(160):
        own = "\n".join(" ".join(words(14)) for _ in range(4))
        if i % 8 == 0:
            own, k = (own.upper().replace(" ", "!! "), "junk")
        elif i % 8 == 1 and i > 8:
            own, k = texts[i - 8] if kind[i - 8] == "first" or kind[i - 8] == "copy" else own, "copy"
        elif i == 1:
            k = "first"
        elif i % 8 == 2:
            own, k = own + "\n" + item, "leak"
        elif i % 8 == 3:
            own, k = own + "\n" + line, "line"
        else:
            k = "clean"
        texts.append(own)
        kind.append(k)
    docs_of(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(k != "junk"), 0) for i, k in enumerate(kind) if i % 3],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, kind, line


def test_stages_and_run(spark, tmp_path):
    texts, kind, line = tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    after = {}
    for n, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert n == len(C.STAGES) - 1 or out.columns == COLUMNS
        docs = C.staged(out, name)
        after[name] = {r["doc_id"]: r for r in docs.collect()}
    of = lambda k: {i for i, x in enumerate(kind) if x == k}
    clean = of("clean") | of("line") | of("first")
    assert not of("junk") & after["quality"].keys() and after["quality"].keys() == set(range(160)) - of("junk")
    assert not of("copy") & after["lines"].keys() and clean <= after["lines"].keys()
    assert sum(line in r["text"] for r in after["lines"].values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in after["lines"].values())
    assert clean <= after["near_duplicates"].keys()
    # the item's line was kept in one document only, which then goes
    assert len(of("leak") - after["decontamination"].keys()) == 1 and clean <= after["decontamination"].keys()
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    assert after["tokens"].keys() == after["decontamination"].keys()
    for i, r in after["tokens"].items():
        text = after["decontamination"][i]["text"]
        assert r["ids"] == enc.encode_ordinary(text) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    whole = {tuple(r) for r in C.run(spark, str(tmp_path)).select("doc_id", "ids_sha256").collect()}
    assert whole == {(i, r["ids_sha256"]) for i, r in after["tokens"].items()}


def test_near_duplicates_stage_on_its_own(spark):
    rng = random.Random(5)
    base = prose(rng, 200, 10**6)
    near = [*base[:100], "other", *base[100:]]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (7, " ".join(prose(rng, 200, 10**6))), (None, "no id here"),
            (8, "twice"), (8, "twice"), (9, None), (10, "")]
    out = C.near_duplicates(spark, docs_of(spark, rows), "").collect()
    assert sorted(((r["doc_id"] or -1) for r in out)) == [-1, 3, 7, 8, 9, 10]


def test_edge_cases_pass_every_stage(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = docs_of(spark, [(None, None), (1, None), (2, ""), (3, "short"), (3, "short"), (4, "long " * 30000)])
    for _, stage in C.STAGES[:-1]:
        docs = C.staged(stage(spark, docs, str(tmp_path)), "edge")
        assert docs.columns == COLUMNS
    empty = docs_of(spark, [])
    for _, stage in C.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0


def test_shuffle_files_go_with_the_execution(spark, tmp_path):
    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {x for x in blocks.mkString(" ").split() if x.startswith("shuffle_")}

    spark.conf.unset("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    docs = docs_of(spark, ["A line that is long enough, and held by both.\none", "A line that is long enough, and held by both.\ntwo"])
    before = shuffles()
    for stage in (C.lines, C.near_duplicates):
        out = stage(spark, docs, "")
        out.write.parquet(f"{tmp_path}/{stage.__name__}")
    until = time.time() + 20  # files are removed in the background
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
