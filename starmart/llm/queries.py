"""One query for each operator over its whole table, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_path
from ..sinks.stage import stage
from . import (
    alignment, bpe, brown, decontamination, html, infilling, langid, neardup, quality, secrets, topk, urlfilter, warc,
)
from .common import held_out, remainder, table

QUERIES = {}
ORACLES = {}

VOCABULARY = "word_bpe_49k.json"


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.digest(decontamination.find_benchmark(docs, table(spark, sf_dir, "benchmark")))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = stage(warc.read_records(spark, path, blocks=False), "warc-records")
    return warc.digest(warc.captures(records))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


@query
def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.digest(neardup.near_duplicates(docs, shingle=4, percent=80))


@query
def op6_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = brown.train(docs.where(remainder(F.col("doc_id"), 7) != 2).select("text"))
    return brown.score(docs, model).withColumn("held_out", held_out(F.col("doc_id"), 7, 2))


@query
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.digest(html.extract(table(spark, sf_dir, "pages")))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.where(~out))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "language.lang_pred", "language.score"
    )


@query
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(bpe.encode_digest(docs, vocabulary_path()))


@query
def op11_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return infilling.digest(infilling.fill_in_middle(docs))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


@query
def op13_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op1_decontamination"] = f"""
with d as (
  select doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '{_WORDS}'), []) as w from documents),
b as (select item_id, regexp_extract_all({_LOWER.format('text')}, '{_WORDS}') as w from benchmark),
bw as (
  select distinct item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as k, least(10, len(w)) as l
  from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct l from bw),
dk as (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i from d, sizes where len(w) >= l),
hit as (
  select dk.doc_id, dk.i, dk.l, bw.item_id from dk join bw
  on bw.l = dk.l and bw.k = array_to_string(dk.w[dk.i : dk.i + dk.l - 1], ' ')),
places as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + l)) as p from hit) group by doc_id),
items as (select doc_id, count(distinct item_id) as n, list_sort(list(distinct item_id::varchar)) as ids from hit group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(places.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
  sha256(coalesce(array_to_string(items.ids, ','), '')) as items_sha256, coalesce(places.n, 0) > 0 as contaminated
from d left join places using (doc_id) left join items using (doc_id)
"""

ORACLES["op2_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
s as (select page_id, strlen(html)::bigint as n, sha1(html) as h from p),
o as (select *, max(page_id) over (partition by h, n) as top from s)
select page_id, n as payload_bytes, h as payload_digest,
  case when n >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id < top then top end as refers_to
from o
"""

ORACLES["op9_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""


def _secrets_sql() -> str:
    """One branch for each rule; RE2 reads the same patterns."""
    branches = []
    for place, rule in enumerate(secrets.BASE + secrets.MORE):
        pattern = rule.pattern.replace("'", "''")
        branches.append(f"""
  select r, {place} as place, '{rule.kind}' as kind, regexp_extract_all(t, '{pattern}', 0) as m,
    list_transform(regexp_extract_all(t, '{pattern}', {rule.group}), lambda x: length(x) >= {rule.least}) as ok,
    string_split_regex(t, '{pattern}') as p from d""")
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE)
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(branches)}),
each as (select *, unnest(range(1, len(m) + 1)) as i from found where len(m) > 0),
spans as (
  select r, place, kind, list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(
    list_sum(list_transform(m[: i - 1], lambda x: length(x))), 0) as s, length(m[i]) as n
  from each where ok[i]),
s as (select *, kind || ':' || s::bigint || ':' || (s + n)::bigint as word from spans),
g as (
  select r, count(*) filter (kind = 'assign') as a, count(*) filter (kind = 'access') as c, count(*) filter (kind = 'hex') as h,
    string_agg(word, ',' order by s, place) filter (kind in ({base})) as base, string_agg(word, ',' order by s, place) as spans
  from s group by r)
select doc_id, coalesce(a, 0)::bigint as n_assign, coalesce(c, 0)::bigint as n_access, coalesce(h, 0)::bigint as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (r)
"""


ORACLES["op4_secrets"] = _secrets_sql()

ORACLES["op5_neardup"] = f"""
with recursive d as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[ \t-\r]+'),
    lambda x: x <> '') as w from documents),
s as (
  select r, doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) end as s from d),
c as (select s, min(doc_id) as id, min(r) as node from (select r, doc_id, list_sort(s) as s from s) where len(s) > 0 group by s),
sh as (select node, unnest(s) as x, len(s) as n from c),
p as (
  select a.node as a, b.node as b from sh a join sh b on a.x = b.x and a.node < b.node
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e as (select a as u, b as v from p union all select b, a from p),
reach as (select node as u, node as v from c union select reach.u, e.v from reach join e on reach.v = e.u),
named as (select reach.u as node, min(c.id) as id from reach join c on c.node = reach.v group by reach.u),
placed as (select list_sort(s.s) as s, s.doc_id, len(s.s) as n from s),
out as (
  select placed.doc_id, placed.n, case when placed.n = 0 then placed.doc_id else named.id end as component_id
  from placed left join c on c.s = placed.s and placed.n > 0 left join named on named.node = c.node)
select doc_id, n::bigint as n_shingles, component_id, doc_id is not distinct from component_id as kept from out
"""

ORACLES["op11_infilling"] = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
n as (
  select doc_id, t, length(t)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from n),
p as (select *, substring(t, 1, a) as x, substring(t, a + 1, b - a) as y, substring(t, b + 1) as z from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y else '<S>' || z || '<P>' || x || '<M>' || y end)
    as output_sha256, sha256(t) as restored_sha256
from p
"""


def _urls_sql() -> str:
    """Every rule on every url."""
    rules = [
        "struct_pack(k := {}, l := {}, name := '{}', verdict := '{}', p := '{}')".format(
            r.rank, len(r.name), r.name, r.verdict, r.pattern.replace("'", "''")
        ) for r in urlfilter.DEFAULT
    ]
    return f"""
with u as (select row_number() over () as r, page_id, case when contains(url, '://') then substring(url, instr(url, '://') + 3) end as rest from pages),
h as (select r, page_id, rest, regexp_extract(rest, '^[^/?#]*') as own from u),
t as (select *, {_LOWER.format('own')} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from h),
rules as (select unnest([{", ".join(rules)}]) as rule),
best as (
  select r, max(struct_pack(k := rule.k, l := rule.l, name := rule.name, verdict := rule.verdict)) as b
  from t join rules on regexp_matches(t.host || substring(t.rest, length(t.own) + 1), rule.p) group by r)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, case when b.k >= 1 then b.name end as rule,
  coalesce(b.verdict, 'allow') as verdict, b.name as pattern
from t left join best using (r)
"""


ORACLES["op13_urlfilter"] = _urls_sql()
