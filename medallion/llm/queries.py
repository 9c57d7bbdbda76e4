"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import decontamination, langid, quality, qualityrules
from medallion.llm.lexical import search
from medallion.llm.linefreq import drop_frequent_lines
from medallion.llm.neardup import near_duplicates
from medallion.llm.packing import pack
from medallion.llm.revisits import header_lines, resolve_revisits
from medallion.llm.secretscan import scan
from medallion.llm.spelling import variants
from medallion.llm.store import ship
from medallion.llm.substrings import repeated_passages
from medallion.llm.vectors import near_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, quality.third_of_four(labels["doc_id"]))
    return quality.score(docs, model).select(
        "doc_id",
        quality.third_of_four(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def captures(pages: DataFrame) -> DataFrame:
    """A capture log made from the pages: each is a full response and is visited again twice,
    under other spellings of its URL and with validators that agree, disagree or are missing."""
    page = F.col("page_id")
    ts = F.lit(1_700_000_000) + (page % 5000) * 600
    visits = pages.select(
        page, "url", F.md5(F.col("html")).alias("digest"), F.explode(F.array(*map(F.lit, range(3)))).alias("visit")
    )
    again = F.col("visit") > 0
    etag = F.when(page % 7 == 0, None).when(again & (page % 5 == 0), F.concat(F.lit("new-"), "digest"))
    modified = F.when(page % 21 == 0, None).when(again & (page % 14 == 0), ts + 1).otherwise(ts)
    date = F.concat(F.lit("t"), (ts + F.col("visit")).cast("string"))
    url = F.when(F.col("visit") == 1, F.concat("url", F.lit("#again"))).otherwise(F.col("url"))
    return visits.select(
        (page * 4 + F.col("visit")).alias("record_id"),
        url.alias("url"),
        F.when(again & (page % 11 == 0), ts - 5).otherwise(ts + F.col("visit") * (1800 + page % 3 * 86400)).alias("ts"),
        again.alias("is_revisit"),
        etag.otherwise(F.col("digest")).alias("etag"),
        modified.alias("last_modified"),
        "digest",
        F.when(again, F.create_map(F.lit("Date"), date, F.lit("Content-Length"), F.lit("0")))
        .otherwise(F.create_map(F.lit("Date"), date, F.lit("Content-Type"), F.lit("text/html")))
        .alias("headers"),
    ).withColumnRenamed("digest", "payload_digest")


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", header_lines(F.col("headers")))


OP5_SQL = r"""
with
visits as (
  select page_id, url, md5(html) as digest, visit, 1700000000 + (page_id % 5000) * 600 as t
  from pages, (select unnest([0, 1, 2]) as visit)
),
captures as (
  select page_id * 4 + visit as record_id,
         case when visit = 1 then url || '#again' else url end as url,
         case when visit > 0 and page_id % 11 = 0 then t - 5
              else t + visit * (1800 + page_id % 3 * 86400) end as ts,
         visit > 0 as is_revisit,
         case when page_id % 7 = 0 then null
              when visit > 0 and page_id % 5 = 0 then 'new-' || digest else digest end as etag,
         case when page_id % 21 = 0 then null
              when visit > 0 and page_id % 14 = 0 then t + 1 else t end as last_modified,
         digest, 't' || (t + visit)::varchar as date
  from visits
),
parts as (
  select *, regexp_replace(trim(url), '#.*$', '') as whole from captures
),
split_up as (
  select *,
    regexp_replace(regexp_replace(regexp_replace(
      lower(regexp_extract(whole, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)),
      '^.*@', ''), ':(80|443)$', ''), '^www\.', '') as host,
    regexp_replace(whole, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') as rest
  from parts
),
fielded as (
  select *, regexp_replace(regexp_replace(rest, '\?.*$', ''), '/+$', '') as path,
    list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))) as fields
  from split_up
),
canonical as (
  select *, host || path ||
    case when len(fields) > 0 then '?' || array_to_string(fields, '&') else '' end as canon
  from fielded
),
paired as (
  select r.record_id, r.canon, r.ts, r.etag, r.last_modified, r.digest, r.date,
         f.record_id as f_id, f.etag as f_etag, f.last_modified as f_modified, f.digest as f_digest,
         row_number() over (partition by r.record_id order by f.ts desc, f.record_id desc) as rn
  from canonical r left join canonical f
    on f.canon = r.canon and not f.is_revisit and f.ts < r.ts
  where r.is_revisit
),
judged as (
  select *, case
    when f_id is null then 'no_earlier_response'
    when etag is not null and f_etag is not null then
      case when etag = f_etag then 'resolved' else 'validator_mismatch' end
    when last_modified is not null and f_modified is not null then
      case when last_modified = f_modified then 'resolved' else 'validator_mismatch' end
    when digest = f_digest then 'resolved' else 'validator_mismatch' end as outcome
  from paired where rn = 1
)
select record_id, canon as url, ts, f_id as refers_to, outcome,
       case when outcome = 'resolved' then f_digest end as payload_digest,
       case when outcome = 'resolved'
         then 'content-type: text/html' || chr(10) || 'date: ' || date end as headers
from judged
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.apply_rules(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.every_fifth(docs["doc_id"])
    found = langid.identify(docs, langid.fit(docs, held_out))
    return found.select(
        "doc_id", langid.every_fifth(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = """
with
doc as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
),
item as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
),
sized as (select item_id, w, least(13, len(w)) as n from item where len(w) > 0),
windows as (
  select distinct item_id, n, array_to_string(w[s:s + n - 1], ' ') as gram
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as s from sized)
),
lengths as (select distinct n from windows),
grams as (
  select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as gram
  from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as s
        from doc, lengths where len(w) >= n)
),
occurrences as (
  select doc_id, item_id, g.n, s from grams g join windows v on g.n = v.n and g.gram = v.gram
),
hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(s, s + n)) as p from occurrences) group by 1
),
named as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id::varchar as item_id from occurrences) group by 1
),
bags as (
  select item_id, s, unnest(list_distinct(w[s:s + n - 1])) as word, len(list_distinct(w[s:s + n - 1])) as kinds
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as s from sized)
),
tokens as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from doc),
whole as (
  select doc_id, item_id, s, kinds from (select distinct doc_id, word from tokens) join bags using (word)
  group by all having count(*) = kinds
),
placed as (
  select doc_id, item_id, s, kinds, pos, word
  from whole join bags using (item_id, s, kinds) join tokens using (doc_id, word)
),
near as (
  select doc_id, count(*) as n_near, string_agg(item_id, ',' order by item_id) as near_ids
  from (
    select distinct doc_id, item_id::varchar as item_id from (
      select doc_id, item_id, kinds, count(distinct word) over (
        partition by doc_id, item_id, s order by pos range between current row and 25 following) as met
      from placed)
    where met = kinds)
  group by 1
)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated,
       coalesce(n_near, 0)::bigint as n_near_items, sha256(coalesce(near_ids, '')) as near_sha256
from doc d left join hit using (doc_id) left join named using (doc_id) left join near using (doc_id)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = drop_frequent_lines(table(spark, sf_dir, "documents"))
    return reduced.select("doc_id", "source", "n_lines", "n_dropped", "text")


OP10_SQL = """
with
raw as (
  select doc_id, coalesce(source, '') as host, source,
         unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as place
  from documents
),
lines as (
  select *, translate(trim(regexp_replace(line, '[ \t\x0B\f\r]+', ' ', 'g')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
  from raw
),
totals as (select coalesce(source, '') as host, count(*) as pages from documents group by 1),
frequent as (
  select host, norm
  from (select host, norm, count(distinct doc_id) as n from lines where norm <> '' group by 1, 2)
  join totals using (host)
  where n >= 3 and n > 0.1::double * pages
),
judged as (
  select l.doc_id, l.place, l.line, l.norm, f.norm is not null as dropped
  from lines l left join frequent f on l.host = f.host and l.norm = f.norm
),
texts as (
  select doc_id, count(*) filter (norm <> '') as n_lines,
         count(*) filter (dropped) as n_dropped,
         coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '') as kept
  from judged group by 1
)
select d.doc_id, d.source, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
       case when d.text is null then null else t.kept end as text
from documents d left join texts t using (doc_id)
"""

def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = """
with
doc as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from documents where text is not null
),
item as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark where text is not null
),
sized as (select doc_id, count(*)::bigint as n from doc group by 1),
total as (select count(*)::bigint as nn, sum(n)::bigint as l from sized),
tf as (select doc_id, term, count(*)::bigint as tf from doc where term in (select term from item) group by 1, 2),
weight as (
  select term, floor(1000 * ln((2 * max(nn) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, total group by 1
),
scored as (
  select item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::bigint as score
  from item join tf using (term) join weight using (term) join sized using (doc_id), total
  group by 1, 2
),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank,
         doc_id, score
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_quality_classifier,
        op3_secret_scan,
        op4_substring_dedup,
        op5_warc_revisits,
        op6_quality_rules,
        op7_language_id,
        op8_minhash_near_dedup,
        op9_decontamination,
        op10_line_dedup,
        op11_embedding_near_dedup,
        op12_spelling_variants,
        op13_lexical_search,
    )
}
SQL = {"op5_warc_revisits": OP5_SQL, "op9_decontamination": OP9_SQL, "op10_line_dedup": OP10_SQL, "op13_lexical_search": OP13_SQL}
