"""The operators' registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import ann, decontam, divergence, html, langid, minhash, packing, quality, substring, suffix, toxicity, warc, whitening
from lamina.llm.store import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_recurring(table(spark, sf_dir, "documents"), length=35, with_text=False)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages)).select("page_id", "url", "text", "n_chars")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; the folder is the installed package's, never copied."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                        tokenizer_file("byte_bpe_50k.tiktoken"), capacity=1024, end_id=2)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeated(table(spark, sf_dir, "documents"), length=50)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def _fold(number: int) -> Column:
    """Fold of a document: crc32 of its doc_id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(number))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").withColumn("held_out", _fold(4) == 2)
    model = langid.train(docs.where("not held_out"))
    return langid.predict(docs, model, ("doc_id", "held_out"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").withColumn("held_out", _fold(5) == 0)
    known = toxicity.labelled(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, toxicity.train(known), ("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", "predicted", "measure", "n_words")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


def op12_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    if not warc.write(table(spark, sf_dir, "pages"), folder, at_least=0):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    found = warc.records(warc.read(spark, folder, with_payload=False))
    return found.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), support=3, shown=200)


QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_warc_archives": op12_warc_archives,
    "op13_source_divergence": op13_source_divergence,
}
_OP4_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 34], ' ') as g from d, unnest(range(1, len(w) - 33)) t(i)),
twice as (select g from win group by g having count(*) > 1),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 35)) as p from win semi join twice using (g))),
kept as (select doc_id, p, w[p] as word from d, unnest(range(1, len(w) + 1)) t(p)),
texts as (select doc_id, count(*) as n, string_agg(word, ' ' order by p) as text
  from kept anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(texts.text, '')) as kept_sha256
from d left join texts using (doc_id)"""

_OP8_SQL = r"""
with lowered as (select 0 as kind, doc_id as id, text from documents union all select 1, item_id, text from benchmark),
words as (select kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from lowered),
win as (select distinct id as item, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
  from words, unnest(range(1, greatest(1, len(w) - 12) + 1)) t(i) where kind = 1 and len(w) > 0),
docs as (select id as doc_id, w from words where kind = 0),
seen as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from docs, (select distinct n from win) lengths, unnest(range(1, len(w) - n + 2)) t(i)),
hits as (select doc_id, i, n, item from seen join win using (n, g)),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct doc_id, cast(item as varchar) as item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from docs left join covered using (doc_id) left join items using (doc_id)"""

_OP12_SQL = r"""
with p as (select page_id, url, coalesce(html, '') as html, sha1(coalesce(html, '')) as sha from pages where page_id is not null),
first as (select sha, max(page_id) as page_id, count(*) as n from p group by sha),
signs as (select sha, g, cast('0x' || substr(sha, 5 * (g // 4) + 1, 5) as integer) // [32768, 1024, 32, 1][g % 4 + 1] % 32 as code
  from first, range(0, 32) r(g)),
digests as (select sha, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', code + 1, 1), '' order by g) as digest
  from signs group by sha),
placed as (select p.page_id, sha, html, first.page_id as best,
  row_number() over (partition by sha, p.page_id order by url desc nulls last) as k from p join first using (sha))
select page_id, cast(strlen(html) as bigint) as payload_bytes, digest as payload_digest,
  case when page_id = best and k = 1 then 'response' else 'revisit' end as record_type,
  case when page_id = best and k = 1 then null else best end as refers_to
from placed join digests using (sha)"""

_OP13_SQL = r"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from w group by lang, term having count(distinct id) >= 3),
v as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from d),
n as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by lang, source, term),
sums as (select lang, source, sum(n) as s from n group by lang, source),
p as (select g.lang, g.source, k.term, coalesce(n.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(n.n, 0) + 1)) // (coalesce(s.s, 0) + v.v) as p
  from groups g join kept k using (lang) join v using (lang) left join sums s using (lang, source)
  left join n using (lang, source, term)),
whole as (select lang, term, 1 + (1000000000::hugeint * (sum(n) + 1)) // (any_value(t.s) + any_value(v.v)) as q
  from n join (select lang, sum(s) as s from sums group by lang) t using (lang) join v using (lang) group by lang, term),
far as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(far.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join far on far.lang = a.lang and far.source = a.source and far.item = b.source),
above as (select p.lang, p.source, 'term' as part, term as item, ((p - q) * (p - q)) // q as value
  from p join whole using (lang, term) where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pair union all select * from above))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 200"""

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": _OP4_SQL,
    "op8_benchmark_decontamination": _OP8_SQL,
    "op12_warc_archives": _OP12_SQL,
    "op13_source_divergence": _OP13_SQL,
}
