"""The operators bound to the test tables, each over a whole table, and the SQL that checks those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm import decontaminate, extract, hmm, jaccard, langid, licenses, mtree, openpacking, packing, resampling, secrets, sharding, whitening
from tidewright.llm.common import fold_of, table
from tidewright.session import configure


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; learns from the folds other than 0. A null id counts as held out."""
    docs = table(configure(spark), folder, "documents")
    network = langid.fit(docs, fold_of(F.col("doc_id")) != 0)
    held = F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(True))
    return langid.identify(docs, network).select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_bytes")


def op2_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(configure(spark), folder, "pages"))


def op3_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Likelihood of every document; learns from the folds other than 1. A null id counts as held out."""
    docs = table(configure(spark), folder, "documents")
    found = hmm.language_model(docs, fold_of(F.col("doc_id")) != 1).withColumn("doc_id", F.col("kept.doc_id"))
    held = F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(True))
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, one row for each pair."""
    spark = configure(spark)
    found = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "matched", "share", "run", "begins")


def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its bin and its place there; near copies are in bins of their own."""
    return packing.pack(table(configure(spark), folder, "documents"), near=True)


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document."""
    return jaccard.similar_components(table(configure(spark), folder, "documents")).withColumnRenamed("id", "doc_id")


def op7_shard(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document; the counts of any two shards differ by one at most."""
    found = sharding.assign(table(configure(spark), folder, "documents"), 24)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets.scan(table(configure(spark), folder, "documents"))
    return found.select(
        "kept.doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"), secrets.spelled(F.col("spans")).alias("spans")
    )


def op9_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows for every fiftieth embedding."""
    return mtree.top_k(table(configure(spark), folder, "embeddings"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(table(configure(spark), folder, "documents"))


def op11_whiten(spark: SparkSession, folder: str) -> DataFrame:
    """Eight whitened components of every embedding; a deviation beyond 64 bits is null."""
    found = whitening.whiten(table(configure(spark), folder, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    """The tenth of the documents that is most like the benchmark, drawn with noise."""
    spark = configure(spark)
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_open_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return openpacking.pack(table(configure(spark), folder, "documents"), vocabulary).drop("ids")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_extract, op3_language_model, op4_decontaminate, op5_pack, op6_jaccard, op7_shard, op8_secrets, op9_top_k, op10_licenses,
        op11_whiten, op12_resample, op13_open_pack,
    )
}

ORACLES = {
    "op6_jaccard": r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, case when len(w) = 0 then [] else
        list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from words
), tokens as (select doc_id, len(s) as n, unnest(s) as t from sets),
links as (
    select a.doc_id as a, b.doc_id as b from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach as (
    select doc_id as a, doc_id as b from sets
    union
    select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, r.c as component_id
from sets s join (select a, min(b) as c from reach group by a) r on r.a = s.doc_id
""",
    "op9_top_k": """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, d.vec_id, cast(list_inner_product(q.e, d.e) as bigint) as score
    from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0
), ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
""",
    "op12_resample": r"""
with codes as (
    select list(list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as step
    from range(256) as r(n)
), words as (
    select 'd' as side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
    from documents
    union all
    select 'b', null, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
    from benchmark
), vocabulary as (
    select w, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t, hex(encode(w)) as x from words group by w
), hashed as (
    select w, s, t, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: cast('0x' || x[i:i + 1] as bigint))),
        lambda c, b: xor(c >> 8, codes.step[1 + (xor(c, b) & 255)])), 4294967295) % 10000 as b
    from vocabulary, codes
), counts as (select b, sum(s) as s, sum(t) as t from hashed group by b),
totals as (select sum(s) as ss, sum(t) as tt from counts),
gains as (
    select b, cast(floor(1000 * ln(cast((t + 1) * (ss + 10000) as double) / cast((s + 1) * (tt + 10000) as double))) as bigint) as g from counts, totals
), weighed as (
    select d.doc_id, count(g) as n_features, cast(coalesce(sum(g), 0) as bigint) as weight
    from documents d left join (select doc_id, g from words join hashed using (w) join gains using (b) where side = 'd') using (doc_id)
    group by d.doc_id
), scored as (
    select *, weight + cast(floor(-1000 * ln(-ln((cast('0x' || sha256('2024:' || doc_id)[1:8] as bigint) + 0.5) / 4294967296))) as bigint) as score from weighed
), ranked as (
    select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as r, count(*) filter (n_features >= 20) over () as n from scored
)
select doc_id, n_features, weight, score, case when n_features >= 20 and r <= 10 * n // 100 then r end as rank from ranked
""",
}
