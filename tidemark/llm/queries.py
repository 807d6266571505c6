"""Registered queries of the subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie, decontaminate, filter_audit, lexical_packing, minhash, packing, quality_rules, sharding, suffixes, templates, toxicity, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24

# The URL rules of the contract.
URL_RULES = [
    url_filter.UrlRule("net", "/", "block"),
    url_filter.UrlRule("example.net", "/en/", "allow"),
    url_filter.UrlRule("example.com", "/de/", "block"),
    url_filter.UrlRule("org", "/fr/", "allow"),
]


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_virtual_slots")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


# n_repeat_words in SQL compares every pair of windows of a text by hash table,
# as a list of windows with more than one occurrence.
OP4_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
win as (select doc_id, t, i, array_to_string(ws[i:i+4], ' ') as g
  from (select doc_id, t, ws, unnest(range(1, len(ws) - 3)) as i from w)),
starts as (select doc_id, t, i from (select *, count(*) over (partition by doc_id, t, g) as n from win) where n > 1),
cov as (select doc_id, t, sum(least(5, coalesce(nxt - i, 5))) as c
  from (select *, lead(i) over (partition by doc_id, t order by i) as nxt from starts) group by doc_id, t),
lines as (select doc_id, t, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
m as (select w.doc_id, w.t, cast(len(ws) as bigint) as n_words,
    cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(c, 0) as bigint) as n_repeat_words
  from w join lines l on l.doc_id = w.doc_id and l.t = w.t left join cov on cov.doc_id = w.doc_id and cov.t = w.t),
v as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, greatest(word_chars, 1) as wc from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (
    n_symbols / wc > 0.05
    or len(regexp_extract_all(t, '[A-Z]')) / wc > 0.4
    or len(regexp_extract_all(t, '!')) / wc > 0.05
    or len(regexp_extract_all(t, '[0-9]')) / wc > 0.5
    or word_chars > 25 * greatest(length(t) - word_chars + 1, 1)
    or len(regexp_extract_all(t, '(\.\.\.|…)[ \t\r]*(\n|$)')) > 0.3 * (len(regexp_extract_all(t, '\n')) + 1)
    or len(list_distinct(string_split(t, chr(10)))) < 0.5 * len(string_split(t, chr(10)))) as kept
from v"""


@query("op4_rule_cascade", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"), "text")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP7_SQL = r"""
with u as (select page_id,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') as raw,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
h as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from u),
r as (select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')) r(rh, rp, v)),
f as (select h.*, rh || rp as rule, v, row_number() over (partition by page_id, host, path order by length(rh || rp) desc) as k
  from h left join r on (host = rh or suffix(host, '.' || rh)) and prefix(path, rp))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from f where k = 1"""


@query("op7_wildcard_automaton", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url", URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_bbit_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", 85)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


@query("op10_sparse_suffixes")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("op2_cgk_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_line_templates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = templates.drop_templates(table(spark, sf_dir, "documents"), "text")
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


@query("op5_residual_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_weak_supervision")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, "doc_id", "text", model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op6_warc_index")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
w as (select doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by t) as first_id from d),
f as (select w.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
    case when len(ws) < 100 then 1 else 0 end
    + case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 2 else 0 end
    + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    + case when w.doc_id > first_id then 16 else 0 end as mask
  from w left join l on l.doc_id = w.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, mask),
x as (select unnest(range(5)) as i),
o as (select a.i as a, b.i as b, c.i as c, d.i as d, e.i as e from x a, x b, x c, x d, x e
  where (1 << a.i) + (1 << b.i) + (1 << c.i) + (1 << d.i) + (1 << e.i) = 31
    and a.i <> b.i and a.i <> c.i and a.i <> d.i and a.i <> e.i and b.i <> c.i and b.i <> d.i and b.i <> e.i and c.i <> d.i and c.i <> e.i and d.i <> e.i),
s as (select substr('ABCDE', cast(a + 1 as int), 1) || substr('ABCDE', cast(b + 1 as int), 1) || substr('ABCDE', cast(c + 1 as int), 1)
      || substr('ABCDE', cast(d + 1 as int), 1) || substr('ABCDE', cast(e + 1 as int), 1) as filter_order,
    [a, b, c, d, e] as fs, unnest(range(1, 6)) as step from o),
p as (select filter_order, cast(step as int) as step, cast(1 << fs[step] as int) as own,
    cast(list_sum(list_transform(fs[1:step], lambda y: 1 << y)) as int) as upto from s),
r as (select part, filter_order, step, own,
    sum(case when mask & upto = 0 then n else 0 end) as kept,
    sum(case when mask & own <> 0 and mask & (upto - own) = 0 then n else 0 end) as removed,
    sum(case when mask & own <> 0 and mask & (upto - own) <> 0 then n else 0 end) as redundant,
    sum(case when mask = own then n else 0 end) as unique_fails,
    sum(case when mask & own <> 0 and mask & (upto - own) = 0 then good else 0 end) as good_lost,
    sum(case when mask & own <> 0 and mask & (upto - own) = 0 then toxic else 0 end) as toxic_lost
  from c cross join p group by part, filter_order, step, own)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, own) as bigint) as shapley
from r"""


@query("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
with o as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
    {'r': coalesce(role, ''), 't': coalesce(text, '')} as x from conversations where conv_id is not null),
c as (select distinct conv_id from o),
names as (select conv_id, cast(conv_id as varchar) as s from c),
crc as (select conv_id, list_reduce(list_prepend(4294967295::ubigint, list_transform(range(length(s)), lambda i:
      ascii(substr(s, cast(i + 1 as int), 1))::ubigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::ubigint, 1, 2, 3, 4, 5, 6, 7]),
      lambda y, z: case when y % 2 = 1 then xor(y >> 1, 3988292384::ubigint) else y >> 1 end)) as v
  from names),
h as (select conv_id, cast(xor(v, 4294967295::ubigint) % 9 as bigint) as h, conv_id - conv_id % 5 as base from crc),
m as (select h.*, least(h, (select count(*) from o where o.conv_id = h.base)) as taken from h),
turns as (select m.conv_id, o.pos as d, o.x from m join o on o.conv_id = m.base and o.pos <= m.h
  union all select m.conv_id, o.pos - m.h + m.taken, o.x from m join o on o.conv_id = m.conv_id and o.pos > m.h),
walk as (select conv_id, d, strlen(x.t) as size, sha256(cast(list(x) over (partition by conv_id order by d) as varchar)) as k from turns
  union all select conv_id, 0, 0, '' from c),
total as (select conv_id, max(d) as n from walk group by conv_id),
p as (select w.*, coalesce(lag(k) over (partition by w.conv_id order by d), '') as up, d = n as ends from walk w join total on total.conv_id = w.conv_id),
nodes as (select k, min(up) as up, min(conv_id) as conv_id, min(d) as d, count(*) as n, (count(*) - 1) * max(size) as saved,
    case when count(*) = count(*) filter (ends) then 1 else 0 end as leaf,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as sha from p group by k),
below as (select a.k, sum(saved) as saved, sum(leaf) as leaves from nodes join p a on a.conv_id = nodes.conv_id and a.d <= nodes.d group by a.k),
kids as (select up, count(*) as n from nodes where d > 0 group by up)
select nodes.conv_id, cast(nodes.d as bigint) as depth, case when nodes.d > 0 then above.conv_id end as parent_conv_id, nodes.n as n_convs,
  coalesce(kids.n, 0) as n_children, cast(below.leaves as bigint) as n_leaves, cast(below.saved as bigint) as saved_tokens, nodes.sha as ends_sha256
from nodes join below on below.k = nodes.k left join kids on kids.up = nodes.k left join nodes above on above.k = nodes.up"""


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_lexical_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = lexical_packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
