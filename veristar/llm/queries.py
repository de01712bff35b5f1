"""The registered queries of the subpackage and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import bpe, chat, filteraudit, fingerprints, kdtree, langid, mixing, neardup, prefixtrie, secrets, tokencount, toxicity, warc
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LANG_FOLDS, LANG_HELD = 5, 0
TOXIC_FOLDS, TOXIC_HELD = 3, 1


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those whose fold is not 0."""
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", LANG_FOLDS) == LANG_HELD
    net = langid.train(langid.sample(docs, ~held, "doc_id", "text", "lang"))
    return langid.predict(docs, net, keep=(F.col("doc_id"), held.alias("held_out")))


@_query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketch of every document and of its edited text."""
    return fingerprints.edited_documents(table(spark, sf_dir, "documents"))


@_query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through a WARC archive and back."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


ORACLES["op3_warc"] = """
with p as (
  select page_id, coalesce(html, '') as payload from pages
), d as (
  select page_id, strlen(payload)::bigint as payload_bytes, sha256(payload) as payload_digest from p
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_id from d
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id > first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id > first_id then first_id end as refers_to
from f
"""


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labels whose fold is not 1."""
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", TOXIC_FOLDS) == TOXIC_HELD
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model, keep=(F.col("doc_id"), held.alias("held_out")))


@_query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), bpe.vocabulary())


@_query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    return neardup.linked_components(table(spark, sf_dir, "documents"))


ORACLES["op6_near_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) = 1 then [ws[1]]
         else [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] end) as sh from w
), c as (
  select list_sort(sh) as sh, min(doc_id) as node from s where len(sh) > 0 group by 1
), e as (
  select node, len(sh) as n, unnest(sh) as x from c
), p as (
  select a.node as a, b.node as b, a.n as na, b.n as nb, count(*) as k
  from e a join e b on a.x = b.x and a.node < b.node and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n
  group by all
), l as (
  select a, b from p where 100 * k >= 80 * (na + nb - k)
), g as (
  select a, b from l union all select b, a from l
), r(node, reach) as (
  select a, a from g union select r.node, g.b from r join g on r.reach = g.a
), m as (
  select node, min(reach) as label from r group by node
)
select s.doc_id, len(s.sh)::bigint as n_shingles,
       case when len(s.sh) = 0 then s.doc_id else coalesce(m.label, c.node) end as component_id,
       s.doc_id = case when len(s.sh) = 0 then s.doc_id else coalesce(m.label, c.node) end as kept
from s left join c on c.sh = list_sort(s.sh) left join m on m.node = c.node
"""


@_query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every fiftieth vector."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5).select(
        "query_id", "rank", "vec_id", "score")


ORACLES["op7_exact_top_k"] = """
with v as (
  select vec_id, [floor(256 * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
         list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)])::bigint as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.rows.select("doc_id", F.col(found.size).alias("size"), F.col(found.source_size).alias("source_size"),
                             F.col(found.target).alias("target"), F.col(found.taken).alias("taken"))


@_query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fitted(docs))


@_query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation, repaired and rendered."""
    found = chat.repaired(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "position", "turn", "role", "new_role", "action",
                        F.array_join("inserted", ",").alias("inserted"), "rendered")


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct opening of the rebuilt conversations, with its subtree's leaves and savings."""
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = """
with recursive t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first,
           sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null
), crc(conv_id, s, c, i) as (
  select distinct conv_id, conv_id::varchar, 4294967295::bigint, 0 from t
  union all
  select conv_id, s, xor(c >> 8, list_reduce([xor(c, ord(s[i + 1])) & 255, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))), i + 1
  from crc where i < length(s)
), l as (
  select conv_id, conv_id - conv_id % 5 as base, xor(c, 4294967295) % 9 as h from crc where i = length(s)
), seq as (
  select conv_id, list({'role': role, 'text': text} order by pos) as turns from t group by 1
), r as (
  select l.conv_id, coalesce(b.turns[1:h], []) || o.turns[h + 1:] as turns
  from l join seq o on o.conv_id = l.conv_id left join seq b on b.conv_id = l.base
), p as (
  select conv_id, d, turns[1:d] as node, d = len(turns) as ends
  from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from r)
), n as (
  select node, d, min(conv_id) as conv_id, count(*) as n_convs,
         case when d = 0 then 0 else (count(*) - 1) * strlen(any_value(node[d].text)) end as saved,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '') as ends
  from p group by node, d
), c as (
  select node[1:d - 1] as node, count(*) as n_children from n where d > 0 group by 1
), m as (
  select n.*, coalesce(n_children, 0) as n_children from n left join c using (node)
), s as (
  select node, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved_tokens
  from (select node[1:k] as node, n_children, saved from (select *, unnest(range(d + 1)) as k from m)) group by 1
)
select m.conv_id, m.d::bigint as depth, up.conv_id as parent_conv_id, m.n_convs::bigint as n_convs,
       m.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens,
       sha256(m.ends) as ends_sha256
from m join s using (node) left join n up on m.d > 0 and up.node = m.node[1:m.d - 1]
"""


@_query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, step by step, for every language."""
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
with recursive w as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
         min(doc_id) over (partition by coalesce(text, '')) as first_id
  from documents
), k as (
  select doc_id, max(coalesce(quality = 1, false)::int) as good, max(coalesce(toxic = 1, false)::int) as bad
  from labels group by 1
), d as (
  select part, coalesce(good, 0) as good, coalesce(bad, 0) as bad, [x for x in [
           case when len(ws) < 100 then 'A' end, case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' end,
           case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 'C' end,
           case when regexp_matches(t, '[#$%&*|]') then 'D' end, case when w.doc_id > first_id then 'E' end]
           if x is not null] as fails
  from w left join k on k.doc_id = w.doc_id
), g as (
  select part, fails, count(*) as n, sum(good) as good, sum(bad) as bad from d group by all
), o(filter_order) as (
  select '' union all
  select filter_order || f from o, (select unnest(['A', 'B', 'C', 'D', 'E']) as f)
  where not contains(filter_order, f)
), s as (
  select filter_order, step::integer as step, filter_order[step] as f,
         string_split(filter_order[1:step - 1], '') as earlier
  from o, (select unnest(range(1, 6)) as step) where length(filter_order) = 5
), r as (
  select part, filter_order, step, f,
         sum(n * (not list_has_any(fails, earlier) and not list_contains(fails, f))::int)::bigint as kept,
         sum(n * (not list_has_any(fails, earlier) and list_contains(fails, f))::int)::bigint as removed,
         sum(n * (list_has_any(fails, earlier) and list_contains(fails, f))::int)::bigint as redundant,
         sum(n * (fails = [f])::int)::bigint as unique_fails,
         sum(good * (not list_has_any(fails, earlier) and list_contains(fails, f))::int)::bigint as good_lost,
         sum(bad * (not list_has_any(fails, earlier) and list_contains(fails, f))::int)::bigint as toxic_lost
  from g, s group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, f))::bigint as shapley
from r
"""


@_query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed the window."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokencount.vocabulary(), keep=(F.col("doc_id"),))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
