"""Registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm import language, secrets, topk, toxicity
from recengine.llm.common import crc_text
from recengine.llm.decontaminate import find_leaks
from recengine.llm.exact_dedup import exact_copies
from recengine.llm.html_text import extract_text
from recengine.llm.lexical_search import rank_documents
from recengine.llm.mixing import mix
from recengine.llm.ngram_join import near_duplicates
from recengine.llm.passages import repeated_passages
from recengine.llm.token_counts import count_tokens
from recengine.llm.vector_codes import vector_codes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


SQL["op1_ngram_join"] = r"""
with recursive w as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
d as (
  select r, doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as s
  from w),
t as (select r, unnest(s) as shingle from d),
p as (select x.r as a, y.r as b, count(*) as shared from t x join t y on x.shingle = y.shingle and x.r < y.r group by all),
l as (
  select a, b from p join d x on x.r = p.a join d y on y.r = p.b
  where 100 * shared >= 75 * (len(x.s) + len(y.s) - shared)),
reach(a, b) as (
  select r, r from d
  union
  select reach.a, n.b from reach join (select a, b from l union all select b, a from l) n on n.a = reach.b)
select d.doc_id, len(d.s)::bigint as n_shingles, min(o.doc_id) as component_id
from reach join d on d.r = reach.a join d o on o.r = reach.b group by d.r, d.doc_id, d.s
"""


@query
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query
def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = crc_text(F.col("doc_id")) % 4 == 2
    model = language.fit(docs, learn=~held_out)
    return language.predict(docs.withColumn("held_out", held_out).drop("lang"), model).drop("text")


@query
def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"), least_words=1)


@query
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "slots")


SQL["op5_mixing"] = r"""
with recursive d as (
  select row_number() over () as r, doc_id, source, md5('mix:' || coalesce(doc_id::varchar, '')) as h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from s),
o as (  -- sources by the ratio at which they reach their cap; the capped ones come first
  select *, sum(source_size) over () as total,
    coalesce(sum(source_size) over (order by source_size::double / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as held,
    sum(weight) over (order by source_size::double / weight desc, source desc nulls first
      rows between unbounded preceding and current row) as free
  from w),
c as (select *, (3 * total - 4 * held) * weight > 4 * source_size * free as capped from o),
l as (select (3 * max(total) - 4 * coalesce(sum(source_size) filter (where capped), 0))::double as rest,
    greatest(coalesce(sum(weight) filter (where not capped), 0), 1)::double as free from c),
t as (select source, source_size, case when capped then (2 * source_size)::double else weight * l.rest / (2 * l.free) end as target
  from c, l),
q as (
  select *, row_number() over (order by source nulls last) - 1 as sid, least(floor(target + 0.5)::bigint, 2 * source_size) as quota from t),
p as (
  select d.r, d.doc_id, d.size, q.sid, q.source_size, q.target, q.quota,
    (sum(d.size) over (partition by d.source order by d.h, d.size, d.r) - d.size)::bigint as a
  from d join q on d.source is not distinct from q.source),
cells as (select sid, sum(ceil(quota / 4096)::bigint) over (order by sid) - ceil(quota / 4096)::bigint as cell0, ceil(quota / 4096)::bigint as n from q),
m as (select sum(n)::bigint as n from cells),
step as (select min(s) as step from m, (select unnest(range(
    greatest(1, round(n * (sqrt(5) - 1) / 2)::bigint), greatest(1, round(n * (sqrt(5) - 1) / 2)::bigint) + 1000)) as s from m) where gcd(s, n) = 1),
slot as (  -- golden-ratio points over the cells; a source's slots ranked
  select t, sid, row_number() over (partition by sid order by t) - 1 as rank
  from (select t, (t::hugeint * step % n)::bigint as cell from (select unnest(range(n)) as t from m), m, step) g
    join cells on g.cell >= cells.cell0 and g.cell < cells.cell0 + cells.n),
pieces as (
  select p.r, p.sid, least(b, (rank + 1) * 4096) - greatest(a, rank * 4096) as words, rank
  from (select r, sid, a + pass * source_size as a, least(a + pass * source_size + size, quota) as b
        from p, range(2) x(pass) where size > 0) p, unnest(range((a // 4096)::bigint, ((b - 1) // 4096)::bigint + 1)) u(rank)
  where a < b),
k as (select r, sum(words)::bigint as taken, min(t) as first_slot, count(*) as slots from pieces p join slot s on s.sid = p.sid and s.rank = p.rank group by r)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken, first_slot::bigint as first_slot, coalesce(slots, 0)::bigint as slots
from p left join k using (r)
"""


@query
def op6_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))
    base = secrets.base_only(F.col("found"))
    return found.select(
        "doc_id", *(secrets.count_of(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("found")).alias("spans"))


def secrets_sql() -> str:
    """Every rule searched in every text; positions from the lengths of matches and of what lies between them."""
    parts = []
    for i, rule in enumerate(secrets.BASE + secrets.MORE):
        flag = "(?i)" if rule.any_case else ""
        pattern = (flag + rule.pattern).replace("'", "''")
        parts.append(f"""
  select r, {i} as k, '{rule.kind}' as kind, unnest(list_transform(range(1, len(own) + 1), lambda i:
      {{'a': list_sum(gap[1:i]) + coalesce(list_sum(own[1:i - 1]), 0), 'b': list_sum(gap[1:i]) + list_sum(own[1:i]),
       'n': part[i]}})) as m
  from (select r, list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) as gap,
      list_transform(regexp_extract_all(t, '{pattern}'), lambda x: length(x)) as own,
      list_transform(regexp_extract_all(t, '{pattern}', {rule.group}), lambda x: length(x)) as part
    from d where regexp_matches(t, '{pattern}'))
  where len(own) > 0""")
    least = " ".join(f"when {i} then {rule.least}" for i, rule in enumerate(secrets.BASE + secrets.MORE))
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
s as ({" union all ".join(parts)}),
f as (select r, k, kind, m.a::bigint as a, m.b::bigint as b from s where m.n >= case k {least} end),
g as (
  select r, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access,
    count(*) filter (where k = 2) as n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' order by a, k) as spans,
    string_agg(kind || ':' || a || ':' || b, ',' order by a, k) filter (where k < {len(secrets.BASE)}) as base
  from f group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (r)
"""


SQL["op6_secrets"] = secrets_sql()


@query
def op7_passages(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op8_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages").select("page_id", "url", "html")).drop("html")


@query
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = crc_text(F.col("doc_id")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf, "labels"), learn=~held_out)
    return toxicity.score(docs.withColumn("held_out", held_out), model).drop("text")


@query
def op10_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("id") % 100 == 0)


SQL["op10_topk"] = """
with v as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(1024 * x::double)) as e
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (
  select q.vec_id as query_id, q.r as qr, v.vec_id as vec_id, list_inner_product(q.e, v.e)::bigint as score
  from v as q join v on q.r <> v.r and len(q.e) = len(v.e) where q.vec_id % 100 = 0),
t as (select *, row_number() over (partition by qr order by score desc, vec_id) as n from s)
select query_id, n::integer as rank, vec_id, score from t where n <= 10
"""


@query
def op11_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_copies(table(spark, sf, "documents").select("doc_id", "text"))


SQL["op11_exact_dedup"] = """
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t)::bigint as group_size,
  row_number() over (partition by t order by doc_id desc nulls last, r desc) = 1 as kept, sha256(t) as text_sha256
from d
"""


@query
def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))


def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every round as tables: the key distance * entries + index has its least value at the nearest entry, lower index on ties."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} as materialized (
  select x.r, x.part, any_value(x.v) as v, min((x.q - 2 * list_inner_product(x.v, b.v) + b.q)::hugeint * {entries} + b.entry) as k
  from x join b{i} b on b.part = x.part group by x.r, x.part)""")
        if i < rounds:
            steps.append(f"""
m{i} as (
  select part, k % {entries} as entry, u.place, floor(sum(u.y) / count(*)) as y
  from a{i}, (select unnest(range(1, len(v) + 1)) as place, unnest(v) as y) u group by all),
n{i} as (select part, entry, list(y order by place) as v from m{i} group by all),
b{i + 1} as materialized (
  select b.part, b.entry, coalesce(n.v, b.v) as v, list_inner_product(coalesce(n.v, b.v), coalesce(n.v, b.v)) as q
  from b{i} b left join n{i} n on n.part = b.part and n.entry = b.entry)""")
    return f"""
with e as (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda z: floor(1024 * z::double)) as v
  from embeddings
  where embedding is not null and len(embedding) > 0 and len(embedding) % {parts} = 0
    and len(list_filter(embedding, lambda z: z is null or not isfinite(z::double))) = 0),
x as materialized (
  select r, vec_id, label, part::integer as part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] as v,
    list_inner_product(v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}], v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}]) as q
  from e, range({parts}) p(part)),
f as (select r, row_number() over (order by vec_id nulls last, v) - 1 as entry from e),
b0 as materialized (select x.part, f.entry, x.v, x.q from x join f using (r) where f.entry < {entries}),{",".join(steps)},
c as (select sha256(string_agg(array_to_string(list_transform(v, lambda z: z::bigint::varchar), ','), ',' order by part, entry)) as h from b{rounds}),
s as (
  select r, string_agg(printf('%02x', (k % {entries})::integer), '' order by part) as code, sum(k // {entries})::bigint as error
  from a{rounds} group by r)
select e.vec_id, s.code, s.error, sum(s.error) over (partition by e.label)::bigint as label_error, c.h as codebooks_sha256
from s join e using (r), c
"""


SQL["op12_vector_codes"] = vector_codes_sql()


@query
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return rank_documents(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").select("item_id", "text"))


SQL["op13_lexical_search"] = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents),
i as (
  select row_number() over () as i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
n as (select count(*) filter (where len(words) > 0)::bigint as n, sum(len(words))::bigint as l from d),
t as (select r, term, count(*)::bigint as tf from (select r, unnest(words) as term from d) where term in (select term from i) group by all),
w as (
  select term, floor(1000 * ln((2 * any_value(n.n) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from t, n group by term),
s as (
  select i.i, any_value(i.item_id) as item_id, t.r, any_value(d.doc_id) as doc_id,
    sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * len(d.words) * n.n) // n.l))))::bigint as score
  from i join t using (term) join w using (term) join d on d.r = t.r, n group by i.i, t.r),
o as (select *, row_number() over (partition by i order by score desc, doc_id nulls last, r) as rank from s where score > 0)
select item_id, rank::integer as rank, doc_id, score from o where rank <= 20
"""
