"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chatloom.llm.common import table
from chatloom.llm.conversation_trie import conversation_trie
from chatloom.llm.divergence import source_divergence
from chatloom.llm.exact import exact_groups
from chatloom.llm.html_text import main_text
from chatloom.llm.licenses import license_scan
from chatloom.llm.mixing import mix_sources
from chatloom.llm.packing import pack_documents
from chatloom.llm.quality import quality
from chatloom.llm.rules import quality_rules
from chatloom.llm.simhash import near_duplicates
from chatloom.llm.suffix import remove_repeats
from chatloom.llm.toxicity import toxicity
from chatloom.llm.urls import parse_rule, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return register


_EXACT_SQL = r"""
with rows as (
    select doc_id, length(coalesce(text, '')) as chars, translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ', '') as content
    from documents
), ranked as (
    select doc_id, content, count(*) over (partition by content) as group_size,
           first_value(doc_id) over (partition by content order by chars desc, doc_id) as keep_id
    from rows
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(content) as text_sha256 from ranked
"""


@query("op3_exact_dedup", _EXACT_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op10_mix_sources")
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


URL_RULES = (parse_rule("net/", "block"), parse_rule("example.net/en/", "allow"), parse_rule("example.com/de/", "block"), parse_rule("org/fr/", "allow"))


@query("op7_url_filters")
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES)


@query("op4_license_scans")
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_html_text")
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


_DIVERGENCE_SQL = r"""
with rows as (
    select coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
), numbered as (select *, row_number() over () as row_no from rows),
hits as (select lang, source, row_no, unnest(terms) as term from numbered),
kept as (select lang, term from hits group by lang, term having count(distinct row_no) >= 30),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from rows),
seen as (select h.lang, h.source, h.term, count(*) as n from hits h join kept k on h.lang = k.lang and h.term = k.term group by h.lang, h.source, h.term),
totals as (select lang, source, sum(n) as total from seen group by lang, source),
full_counts as (
    select g.lang, g.source, k.term, coalesce(s.n, 0) as n, coalesce(t.total, 0) as total, z.v
    from groups g join kept k on k.lang = g.lang join sizes z on z.lang = g.lang
    left join seen s on s.lang = g.lang and s.source = g.source and s.term = k.term
    left join totals t on t.lang = g.lang and t.source = g.source
), p as (
    select lang, source, term, n, (1 + (1000000000::hugeint * (n + 5)::hugeint) // (total + 5 * v)::hugeint)::bigint as p from full_counts
), q as (
    select lang, term, (1 + (1000000000::hugeint * (sum(n) + 5)::hugeint) // (max(l.total) + 5 * max(l.v))::hugeint)::bigint as q
    from full_counts join (select lang, sum(n) as total, max(v) as v from full_counts group by lang) l using (lang) group by lang, term
), apart as (
    select a.lang, a.source, 'pair' as part, b.source as item,
           coalesce((select sum(abs(x.p - y.p)) from p x join p y on x.lang = y.lang and x.term = y.term where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
), typical as (
    select p.lang, p.source, 'term' as part, p.term as item, p.p - q.q as value from p join q using (lang, term) where p.n > 0 and p.p > q.q
), ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as place from (select * from apart union all select * from typical)
)
select lang, source, part, item, value, place::integer as rank from ranked where part = 'pair' or place <= 50
"""


@query("op12_source_divergence", _DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


# CRC-32 is folded from the digits, bit by bit
_TRIE_SQL = r"""
with turns as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, key) as pos, key, size
    from (select conv_id, turn, substr(sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as key,
                 octet_length(encode(coalesce(text, '')))::bigint as size from conversations where conv_id is not null)
), convs as (
    select conv_id, conv_id - conv_id % 5 as base,
           xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
               lambda x, i: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end)), 4294967295::bigint), 4294967295) % 9 as h
    from (select distinct conv_id from turns)
), heads as (
    select c.conv_id, t.pos, t.key, t.size from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
), built as (
    select * from heads
    union all
    select t.conv_id, t.pos - c.h + coalesce(n.n, 0) as pos, t.key, t.size
    from turns t join convs c using (conv_id) left join (select conv_id, count(*) as n from heads group by conv_id) n using (conv_id) where t.pos > c.h
), whole as (
    select conv_id, list(key order by pos) as keys, list(size order by pos) as sizes from built group by conv_id
    union all
    select conv_id, [], [] from convs where conv_id not in (select conv_id from built)
), steps as (
    select conv_id, d, keys[:d] as path, case when d > 0 then sizes[d] else 0 end as size, d = len(keys) as ends
    from (select *, unnest(range(len(keys) + 1)) as d from whole)
), nodes as (
    select path, d as depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as own,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
    from steps group by path, d
), families as (
    select p.path, count(c.path) as n_children from nodes p left join nodes c on c.depth = p.depth + 1 and c.path[:p.depth] = p.path group by p.path
), under as (
    select n.path[:k] as path, sum(n.own) as saved, sum(case when f.n_children = 0 then 1 else 0 end) as leaves
    from (select *, unnest(range(depth + 1)) as k from nodes) n join families f on f.path = n.path group by 1
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, f.n_children, u.leaves::bigint as n_leaves, u.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join families f on f.path = n.path join under u on u.path = n.path left join nodes p on p.depth = n.depth - 1 and p.path = n.path[:n.depth - 1]
"""


@query("op13_conversation_trie", _TRIE_SQL)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = conversation_trie(table(spark, sf_dir, "conversations"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
