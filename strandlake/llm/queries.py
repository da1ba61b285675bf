"""One query for each numbered operator, with production parameters, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .exact_dedup import exact_dedup
from .fill_middle import fill_digests
from .language import identify
from .licences import scan_licences
from .mixing import mix
from .ngram_jaccard import link_components
from .packing import VOCABULARY, pack_documents
from .personal_data import personal_data_report
from .quality_crf import quality
from .quality_rules import apply_rules
from .substrings import remove_repeats
from .textkit import small_batches
from .toxicity import toxicity
from .whitening import whitening_report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def vocabulary() -> str:
    """The tokenizer file, which the workers' installation has at the same place."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# the same results by plain joins over all shingles and over all strings of 50 bytes
LINKS = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) as sh
  from w where len(w) > 0
), n as (select doc_id, count(*) as n from s group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2
), link as (
  select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)
), edge as (select a, b from link union select b, a from link),
reach as (
  select doc_id, doc_id as r from documents
  union select edge.b, reach.r from reach join edge on edge.a = reach.doc_id
)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r) as component_id
from documents d join reach on reach.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""
REPEATS = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, p, substr(h, 2 * p + 1, 100) as s from (
  select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as p from d)),
f as (select s, min(doc_id) as m from w group by s),
c as (select w.doc_id, p from w join f on f.s = w.s where m < w.doc_id),
i as (
  select doc_id, min(p) as s, max(p) + 50 as e from (
    select doc_id, p, sum(fresh) over (partition by doc_id order by p) as g from (
      select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 50 then 0 else 1 end as fresh from c))
  group by doc_id, g),
k as (
  select i.doc_id, s, substr(h, 2 * coalesce(lag(e) over (partition by i.doc_id order by s), 0) + 1,
    2 * (s - coalesce(lag(e) over (partition by i.doc_id order by s), 0))) as piece, e from i join d on d.doc_id = i.doc_id),
r as (select doc_id, sum(e - s) as gone, count(*) as spans, string_agg(piece, '' order by s) as kept, max(e) as last from k group by doc_id)
select d.doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(gone, 0) as bigint) as n_removed,
  coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join r on r.doc_id = d.doc_id
"""


@query("""
with t as (
  select doc_id, coalesce(text, '') as text,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm
  from documents
), r as (
  select doc_id, length(text) as len, norm,
         row_number() over (partition by norm order by length(text) desc, doc_id) as rk,
         first_value(doc_id) over (partition by norm order by length(text) desc, doc_id) as keep_id,
         count(*) over (partition by norm) as group_size
  from t
)
select doc_id, keep_id, group_size, rk = 1 as kept, sha256(norm) as text_sha256 from r
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query(LINKS)
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(REPEATS)
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


@query(r"""
with t as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d
  from documents
), h as (
  select doc_id, text, u, len(u) as n,
    cast('0x' || substr(d, 1, 8) as bigint) as h1, cast('0x' || substr(d, 9, 8) as bigint) as h2,
    cast('0x' || substr(d, 17, 8) as bigint) as h3, cast('0x' || substr(d, 25, 8) as bigint) as h4
  from t
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
         when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from h
), p as (
  select doc_id, text, n, form, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid,
    array_to_string(u[b + 1:n], '') as suf
  from c
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
         else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256
from p
""")
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_digests(table(spark, sf_dir, "documents"))


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))
