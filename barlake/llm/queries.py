"""The registered queries of this subpackage, with production parameters over whole tables, and SQL twins where
SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (
    block_topk,
    curriculum_mix,
    exact_dedup,
    fertility,
    hard_negatives,
    hybrid_search,
    language_bayes,
    ngram_join,
    quality_embeddings,
    temporal_lists,
)
from barlake.llm.bpe_tree import decode_documents, encode_documents
from barlake.llm.token_counts import count_tokens
from barlake.llm.token_planes import read_tokens, write_tokens
from barlake.workspace import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = write_tokens(docs, work_path(spark, "token-planes"), public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = encode_documents(table(spark, sf_dir, "documents"), vocabulary)
    return decode_documents(encoded, vocabulary).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_bayes.in_fold("doc_id", 4, 2)
    model = language_bayes.learn(docs.filter(~held_out))
    return language_bayes.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum_mix.by_first_position(curriculum_mix.mix(table(spark, sf_dir, "documents")))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_passes")).alias("taken"),
        F.col("mix_first").alias("first_position"),
        F.col("mix_last").alias("last_position"),
    )


#: DuckDB's words, sizes, draw order and inverse of the demand are those of the operator.
OP6_SQL = r"""
with d as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as drawn,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents
), s as (
  select source, sum(size)::bigint as source_size,
         ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight
  from d group by source
), l as (
  select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over b, 0))::bigint as words,
         (sum(weight) over () - coalesce(sum(weight) over b, 0))::bigint as weights
  from s window b as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
), f as (select *, words * weight / weights > 3 * source_size as stops from l
), first_on as (select words, weights from f where not stops order by weights desc limit 1
), t as (
  select f.source, f.source_size, case when f.weight % 2 = 1 then 0.5::double else -0.5::double end as tilt,
         case when stops then (3 * f.source_size)::double else coalesce(o.words * f.weight / o.weights, 0) end as target
  from f left join first_on o on true
), c as (
  select d.*, t.source_size, t.target, t.tilt,
         coalesce(sum(size) over (partition by d.source order by drawn
                                  rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join t on d.source is not distinct from t.source
), p as (
  select *, (size > 0 and 2 * start + size <= 2 * target)::bigint
          + (size > 0 and 2 * (start + source_size) + size <= 2 * target)::bigint
          + (size > 0 and 2 * (start + 2 * source_size) + size <= 2 * target)::bigint as passes
  from c
)
select doc_id, size, source_size, target, size * passes as taken,
       case when passes > 0 then (sqrt(greatest((1 - tilt) * (1 - tilt) + 4 * tilt * (start::double / target), 0::double)) - (1 - tilt)) / (2 * tilt) end as first_position,
       case when passes > 0 then (sqrt(greatest((1 - tilt) * (1 - tilt) + 4 * tilt * (((passes - 1) * source_size + start)::double / target), 0::double)) - (1 - tilt)) / (2 * tilt) end as last_position
from p
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language_bayes.in_fold("doc_id", 3, 1)
    model = quality_embeddings.fit(docs.filter(~held_out), labels.filter(~held_out))
    return quality_embeddings.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP8_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.rate(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _draw(*parts: str | Column) -> Column:
    """A number that follows from the text of its parts."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 6), 16, 10).cast("long")


def _day(number: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + number * 86400)


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time in 2024 that follows from the URL."""
    return pages.select(
        F.col("page_id").alias("capture_id"), "url", F.timestamp_seconds(F.lit(1704067200) + _draw("fetch", F.col("url")) % (366 * 86400)).alias("fetched_at")
    )


def list_events_of(pages: DataFrame) -> DataFrame:
    """Three dated lists over the hosts and first path steps of the pages: hosts blocked for a while, the domains
    above them blocked from a day on, and first path steps allowed from a day on."""
    seen = pages.select(temporal_lists.url_host(F.col("url")).alias("host"), temporal_lists.url_path(F.col("url")).alias("path"))
    seen = seen.filter("host is not null").select("host", F.split_part(F.col("path"), F.lit("/"), F.lit(2)).alias("step")).distinct()
    hosts = seen.select("host").distinct()
    domains = hosts.filter(F.size(F.split("host", r"\.")) > 3).select(F.regexp_extract("host", r"^[^.]*\.(.*)$", 1).alias("value")).distinct()
    begin = _draw("begin", F.col("value")) % 330
    end = begin + 1 + _draw("end", F.col("value")) % 120
    host_events = hosts.select(F.col("host").alias("value")).select(
        F.lit("hosts").alias("list_name"), F.lit("block").alias("verdict"), "value",
        F.explode(F.array(F.struct(F.lit("add").alias("action"), _day(begin).alias("dated")), F.struct(F.lit("remove").alias("action"), _day(end).alias("dated")), F.struct(F.lit("add").alias("action"), _day(end + 60).alias("dated")))).alias("e"),
    )
    domain_events = domains.select(
        F.lit("domains").alias("list_name"), F.lit("block").alias("verdict"), "value",
        F.explode(F.array(F.struct(F.lit("add").alias("action"), _day(_draw("domain", F.col("value")) % 366).alias("dated")))).alias("e"),
    )
    steps = seen.filter("step != ''").select(F.concat_ws("/", "host", "step").alias("value")).select(
        F.lit("steps").alias("list_name"), F.lit("allow").alias("verdict"), "value",
        F.explode(F.array(F.struct(F.lit("add").alias("action"), _day(_draw("step", F.col("value")) % 366).alias("dated")))).alias("e"),
    )
    events = host_events.union(domain_events).union(steps)
    return events.select("list_name", "verdict", "value", "e.action", "e.dated")


def op10_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return temporal_lists.judge(captures_of(pages), list_events_of(pages)).select(
        F.col("capture_id").alias("page_id"), "blocked", "n_entries", F.array_join("lists", ",").alias("lists"), "verdict_value"
    )


OP10_SQL = r"""
with p as (
  select page_id, url, rtrim(lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#\\]*@)?(\[[^\]]*\]|[^/?#:\\]*)', 1)), '.') as host,
         regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*(/[^?#]*)', 1), '[/\s]+$', '') as path,
         (1704067200 + ('0x' || substr(md5('fetch|' || url), 1, 6))::bigint % (366 * 86400)) as at
  from pages
), seen as (select distinct host, split_part(path, '/', 2) as step from p where host <> ''
), hosts as (select distinct host as value from seen
), drawn as (
  select value, ('0x' || substr(md5('begin|' || value), 1, 6))::bigint % 330 as b,
         ('0x' || substr(md5('end|' || value), 1, 6))::bigint % 120 + 1 as n
  from hosts
), entries as (
  select 'hosts' as list_name, false as allow, value, b as d0, b + n as d1 from drawn
  union all select 'hosts', false, value, b + n + 60, 1000000 from drawn
  union all
  select 'domains', false, value, ('0x' || substr(md5('domain|' || value), 1, 6))::bigint % 366, 1000000
  from (select distinct regexp_extract(value, '^[^.]*\.(.*)$', 1) as value from hosts where len(string_split(value, '.')) > 3)
  union all
  select 'steps', true, value, ('0x' || substr(md5('step|' || value), 1, 6))::bigint % 366, 1000000
  from (select distinct lower(host) || '/' || step as value from seen where step <> '')
), hits as (
  select p.page_id, e.* from p left join entries e
    on (p.host = e.value or p.host like '%.' || e.value or p.host || p.path = e.value or starts_with(p.host || p.path, e.value || '/'))
   and p.at >= 1704067200 + e.d0 * 86400 and p.at < 1704067200 + e.d1 * 86400
)
select page_id, coalesce(not arg_max(allow, len(value) * 2 + allow::int), false) as blocked, count(value) as n_entries,
       coalesce(string_agg(distinct list_name, ',' order by list_name), '') as lists,
       arg_max(value, len(value) * 2 + allow::int) as verdict_value
from hits group by page_id
"""


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(exact_dedup.without_spaces(F.col("text")), 256)
    found = exact_dedup.equal_texts(table(spark, sf_dir, "documents"), carry=[digest])
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("carried_0").alias("text_sha256"))


OP11_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
)
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by text_sha256)::bigint as group_size,
       row_number() over best = 1 as kept, text_sha256
from d window best as (partition by text_sha256 order by chars desc, doc_id nulls last)
"""


def op12_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP12_SQL = r"""
with d as (
  select doc_id, row_number() over () as place,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), q as (
  select item_id, term, count(*) as repeats
  from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term
), a as (select count(*)::bigint as n_docs, sum(len(terms))::bigint as n_all from d where len(terms) > 0
), p as (
  select place, any_value(doc_id) as doc_id, any_value(n) as n, term, count(*)::bigint as tf
  from (select place, doc_id, len(terms)::bigint as n, unnest(terms) as term from d) group by place, term
), w as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight
  from p, a group by term, n_docs
), s as (
  select q.item_id, p.place, any_value(p.doc_id) as doc_id,
         sum(q.repeats * w.weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_all))))::bigint as score
  from q join w using (term) join p using (term), a group by q.item_id, p.place
), r as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::integer as rank, doc_id, score
  from s where score > 0
)
select item_id, rank, doc_id, score from r where rank <= 10
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, least=50, most=95)


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         list_sum(list_transform(list_zip(a.w, c.w), lambda p: p[1] * p[2]))::bigint as score
  from v a join v c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id
), p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, row_number() over best::integer as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not same
 and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window best as (partition by p.anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over best <= 3
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_token_planes": op2_token_planes,
        "op3_token_counts": op3_token_counts,
        "op4_bpe_tree": op4_bpe_tree,
        "op5_language_id": op5_language_id,
        "op6_curriculum_mix": op6_curriculum_mix,
        "op7_quality": op7_quality,
        "op8_block_topk": op8_block_topk,
        "op9_fertility": op9_fertility,
        "op10_temporal_lists": op10_temporal_lists,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_hybrid_search": op12_hybrid_search,
        "op13_hard_negatives": op13_hard_negatives,
    }


def llm_sql() -> dict[str, str]:
    return {
        "op6_curriculum_mix": OP6_SQL,
        "op8_block_topk": OP8_SQL,
        "op10_temporal_lists": OP10_SQL,
        "op11_exact_dedup": OP11_SQL,
        "op12_hybrid_search": OP12_SQL,
        "op13_hard_negatives": OP13_SQL,
    }
