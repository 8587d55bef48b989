"""Registered queries of the subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm import (
    bottomk,
    bpe,
    doubling,
    fuzzy_lines,
    hash_ring,
    html_wrapper,
    projections,
    ranked_search,
    secret_scan,
    site_quality,
    token_alignment,
    toxic_neighbours,
    winnow,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(_table(spark, sf_dir, "documents"))


def encoding_digests(docs: DataFrame) -> DataFrame:
    """Documents encoded and decoded, as counts and digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(secret_scan.scan_secrets(_table(spark, sf_dir, "documents")))


def span_digests(found: DataFrame) -> DataFrame:
    def of(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "host", "path", F.round("evidence", 6).alias("evidence"), F.round("host_rate", 6).alias("host_rate"),
        F.round("path_rate", 6).alias("path_rate"), F.round("score", 6).alias("score"), "kept")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(_table(spark, sf_dir, "documents"), length=2).drop("t")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.substring_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_neighbours.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(_table(spark, sf_dir, "documents"), short_copies=True).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(_table(spark, sf_dir, "documents"))


def alignment(docs: DataFrame) -> DataFrame:
    """Figures of the documents' tokens aligned, and digests of their groups."""
    aligned = token_alignment.align(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))

    def digest(links: token_alignment.Links) -> list[str]:
        return [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in token_alignment.group_texts(links)]

    return token_alignment.link_figures(aligned, token_alignment.pair_counts(aligned), digest).drop("row").withColumnRenamed(
        "digest", "groups_sha256")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding(_table(spark, sf_dir, "documents"))


def sharding(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents on a ring of shards that hold equal numbers of rows."""
    return hash_ring.assign(docs, hash_ring.Ring(shards)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "row.item_id", "rank", "doc_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_secret_scan": op4_secret_scan,
    "op5_site_quality": op5_site_quality,
    "op6_decontamination": op6_decontamination,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_sharding": op12_sharding,
    "op13_ranked_search": op13_ranked_search,
}

#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op2_embedding_dedup": r"""
with recursive v as (
  select vec_id, e from (select vec_id, cast(embedding as double[]) as e from embeddings)
  where e is not null and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0
        and list_aggregate(list_transform(e, lambda x: abs(x)), 'max') > 0),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id < b.vec_id and len(a.e) = len(b.e)
         where list_cosine_similarity(a.e, b.e) >= 0.9),
two as (select a, b from link union all select b, a from link),
reach as (select vec_id as node, vec_id as least from embeddings
          union select two.b, reach.least from reach join two on two.a = reach.node where reach.least < two.b),
comp as (select node, min(least) as component_id from reach group by node),
deg as (select a, count(*) as n from two group by a)
select vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, vec_id = component_id as kept
from embeddings join comp on comp.node = vec_id left join deg on deg.a = vec_id
""",
    "op6_decontamination": r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, l, array_to_string(w[i:i + l - 1], ' ') as x
       from (select item_id, w, least(len(w), 10) as l, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
             from b where len(w) > 0)),
dw as (select doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') as x
       from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i
             from d cross join (select distinct l from bw) where len(w) >= l)),
hit as (select doc_id, item_id, i, l from dw join bw using (l, x)),
pos as (select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + l)) as p from (select distinct doc_id, i, l from hit)) group by 1),
its as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as x
        from (select distinct doc_id, cast(item_id as varchar) as x from hit) group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(x, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join pos on pos.doc_id = d.doc_id left join its on its.doc_id = d.doc_id
""",
    "op7_minhash_dedup": r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
         else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from d),
e as (select doc_id, len(s) as n, unnest(s) as x from s),
rare as (select doc_id, n, x, row_number() over (partition by doc_id order by df, x) as r
         from e join (select x, count(*) as df from e group by x) using (x)),
p as (select doc_id, n, x from rare where r <= n - ceil(n * 0.8 - 1e-9) + 1),
cand as (select distinct a.doc_id as a, b.doc_id as b from p a join p b on a.x = b.x and a.doc_id < b.doc_id
         and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
link as (
  select a, b from cand join s sa on sa.doc_id = a join s sb on sb.doc_id = b
  where 100 * len(list_intersect(sa.s, sb.s)) >= 80 * (len(sa.s) + len(sb.s) - len(list_intersect(sa.s, sb.s)))),
two as (select a, b from link union select b, a from link),
reach as (select doc_id as node, doc_id as least from d
          union select two.b, reach.least from reach join two on two.a = reach.node
          where reach.least < two.b),
comp as (select node, min(least) as component_id from reach group by node)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, component_id, s.doc_id = component_id as kept
from s join comp on comp.node = s.doc_id
""",
    "op8_substring_dedup": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as x
      from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
f as (select x, min(doc_id) as low from g group by x),
c as (select distinct doc_id, i + j as p from (select doc_id, i from g join f using (x) where low < doc_id)
      cross join (select unnest(range(13)) as j)),
k as (select doc_id, p, w[p] as t from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d)),
r as (select k.doc_id, count(c.p) as n_removed, string_agg(case when c.p is null then k.t end, ' ' order by k.p) as t
      from k left join c on c.doc_id = k.doc_id and c.p = k.p group by k.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join r on r.doc_id = d.doc_id
""",
    "op13_ranked_search": r"""
with d as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, row_number() over () as i, unnest(regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
q as (select item_id, i, t, count(*) as times from b group by all),
n as (select count(*) as n, cast(sum(len(w)) as bigint) as l from d where len(w) > 0),
p as (select r, doc_id, t, count(*) as tf, any_value(m) as m
      from (select r, doc_id, 75 + (25 * cast(len(w) as bigint) * n.n) // n.l as m, unnest(w) as t from d, n where len(w) > 0)
      where t in (select t from q) group by r, doc_id, t),
k as (select t, cast(floor(1000 * ln(cast(2 * n.n + 2 as double) / (2 * df + 1))) as bigint) as weight
      from (select t, count(*) as df from p group by t), n),
s as (select i, item_id, r, doc_id, cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
      from q join k using (t) join p using (t) group by i, item_id, r, doc_id),
o as (select *, row_number() over (partition by i order by score desc, doc_id, r) as rank from s where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from o where rank <= 20
""",
}
