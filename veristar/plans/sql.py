"""SQL building blocks of the oracle queries (DuckDB dialect).

Written from the rules, by other means than the DataFrame code where there is a
choice (per-word lists, window lags, row numbers).
"""

from __future__ import annotations

from ..sources import params as P
from . import inputs as I

SPACE = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WORD = r"[\p{L}\p{N}_]+"
PUNCT = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"  # quoted for SQL


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    def cell(v):
        if v is None:
            return "null"
        return text(v) if isinstance(v, str) else f"cast({v!r} as double)"

    body = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)
    return f"(values {body}) as v({columns})"


RAW = """raw as (
  select doc_id as review_id, source as category,
         case when doc_id % 17 = 0 then null else cast(1 + doc_id % 5 as double) end as rating,
         case when quality = 0 then ' cg ' when quality = 1 then 'or' end as label, text as text_
  from documents left join labels using (doc_id))"""

CLEAN = f"""firsts as (
  select *, row_number() over (partition by text_ order by review_id) as copy_no from raw),
cleaned as (
  select * from (
    select review_id, category, rating, upper(regexp_replace(label, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')) as label,
      regexp_replace(regexp_replace(text_, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), '[{SPACE}]+', ' ', 'g') as review_text
    from firsts where copy_no = 1 and text_ is not null and rating is not null and label is not null)
  where label in ('CG', 'OR'))"""


def style(source: str, text_col: str = "review_text") -> str:
    return f"""counted as (
  select *, regexp_extract_all(lower({text_col}), '{WORD}') as w,
    len(list_filter(string_split_regex({text_col}, '[.!?]+'), lambda x: regexp_matches(x, '[^{SPACE}]'))) as n_sent,
    len(regexp_extract_all({text_col}, '[!-/:-@\\[-`{{-~]')) as n_punct
  from {source}),
syllabled as (
  select *, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: greatest(1,
      len(regexp_extract_all(x, '[aeiouy]+')) - case when regexp_matches(x, '[^aeiouyl]e$') then 1 else 0 end))), 0) as n_syll
  from counted),
style as (
  select *,
    case when length({text_col}) = 0 then 0.0 else round(cast(n_punct as double) / length({text_col}) * 100, 4) end as punctuation_freq,
    case when n_words = 0 then 0.0 else round(cast(len(list_distinct(w)) as double) / n_words, 4) end as vocab_diversity,
    case when n_words = 0 or n_sent = 0 then 0.0 else
      round(cast(206.835 as double) - cast(1.015 as double) * (cast(n_words as double) / n_sent)
            - cast(84.6 as double) * (cast(n_syll as double) / n_words), 4) end as readability_score,
    case when n_sent = 0 then 0.0 else round(cast(n_words as double) / n_sent, 4) end as avg_sentence_length,
    case when n_words = 0 or n_sent = 0 then 0.0 else
      round(cast(0.39 as double) * (cast(n_words as double) / n_sent)
            + cast(11.8 as double) * (cast(n_syll as double) / n_words) - cast(15.59 as double), 4) end as fk_grade
  from syllabled)"""


def split_tokens(source: str, text_col: str = "review_text") -> str:
    return f"""split as (
  select review_id, {text_col} as txt, list_transform(
    list_filter(string_split_regex({text_col}, '[{SPACE}]+'), lambda x: x <> ''),
    lambda x: case when length(trim(x, '{PUNCT}')) <= 2 then x else trim(x, '{PUNCT}') end) as toks
  from {source})"""


def sentiment(source: str, text_col: str = "review_text", split: str | None = None, lexicon: dict | None = None,
              boosters: dict | None = None) -> str:
    """CTEs up to ``sentiment``; ``split`` takes the place of the tokens, the two tables that of the usual ones."""
    lexicon = values((lexicon or I.LEXICON).items(), "token, valence")
    boosters = values((boosters or I.BOOSTERS).items(), "token, scalar")
    negations = values([(t,) for t in I.NEGATIONS], "token")
    head = values([(t, *w) for t, w in I.HEAD.items()], "token, w_neg, w_neu, w_pos")

    def step(k: int, damping: float, before: str) -> str:
        upper = f"(mixed and p{k} = upper(p{k}) and p{k} <> lower(p{k}))"
        return f"""
    step{k} as (
      select *, ({before} + case when s{k} is null then 0.0 else
        (case when {before} < 0 then -1.0 else 1.0 end)
        * (s{k} + case when {upper} then {P.CAPS_EMPHASIS} else 0.0 end) * cast({damping} as double) end)
        * (case when n{k} then {P.NEGATION_FACTOR} else 1.0 end) as v{k}
      from {'step%d' % (k - 1) if k > 1 else 'step0'}),"""

    steps = "".join(step(k, d, f"v{k - 1}") for k, d in enumerate(P.DAMPING, 1)).rstrip(",")
    side_joins = "\n".join(
        f"      left join mods m{k} on m{k}.token = lower(p{k})" for k in (1, 2, 3))
    return f"""{split or split_tokens(source, text_col)},
measured as (
  select *, len(toks) as n_toks,
    len(list_filter(toks, lambda x: x = upper(x) and x <> lower(x))) as n_caps,
    coalesce(list_position(list_transform(toks, lambda x: lower(x)), {text(I.CONTRAST)}), 0) as contrast_at,
    least(length(txt) - length(replace(txt, '!', '')), {P.EXCLAMATION_MAX}) * {P.EXCLAMATION_STEP}
      + case when length(txt) - length(replace(txt, '?', '')) <= 1 then 0.0
             when length(txt) - length(replace(txt, '?', '')) <= {P.QUESTION_STEPS_MAX}
             then (length(txt) - length(replace(txt, '?', ''))) * {P.QUESTION_STEP}
             else {P.QUESTION_CEILING} end as emphasis
  from split),
tok as (
  select review_id, unnest(toks) as t, generate_subscripts(toks, 1) as pos, contrast_at,
         n_caps > 0 and n_caps < n_toks as mixed
  from measured),
ctx as (
  select *, lag(t, 1) over r as p1, lag(t, 2) over r as p2, lag(t, 3) over r as p3
  from tok window r as (partition by review_id order by pos)),
lex as (select * from {lexicon}),
boost as (select * from {boosters}),
neg as (select * from {negations}),
head as (select * from {head}),
mods as (
  select token, scalar, coalesce(negates, false) as negates from (
    select coalesce(boost.token, neg.token) as token, scalar, neg.token is not null as negates
    from boost full join neg on boost.token = neg.token)
  where token not in (select token from lex)),
step0 as (
  select review_id, pos, contrast_at, mixed, p1, p2, p3,
    m1.scalar as s1, m2.scalar as s2, m3.scalar as s3,
    (coalesce(m1.negates, false) or coalesce(contains(lower(p1), 'n''t'), false)) as n1, (coalesce(m2.negates, false) or coalesce(contains(lower(p2), 'n''t'), false)) as n2, (coalesce(m3.negates, false) or coalesce(contains(lower(p3), 'n''t'), false)) as n3,
    valence + case when mixed and t = upper(t) and t <> lower(t) then sign(valence) * {P.CAPS_EMPHASIS} else 0.0 end as v0
  from ctx join lex on lex.token = lower(t)
{side_joins}
  where lower(t) not in (select token from boost)),{steps},
valued as (
  select review_id, sum(v3 * case when contrast_at = 0 or pos = contrast_at then 1.0
                                  when pos < contrast_at then {P.BEFORE_CONTRAST} else {P.AFTER_CONTRAST} end) as s
  from step3 group by review_id),
headed as (
  select review_id, sum(w_neg) as l_neg, sum(w_neu) as l_neu, sum(w_pos) as l_pos
  from tok join head on head.token = lower(t) group by review_id),
logit as (
  select review_id, n_toks, emphasis, coalesce(s, 0.0) as s,
    {I.BIAS[0]} + coalesce(l_neg, 0.0) / greatest(n_toks, 1) as z_neg,
    {I.BIAS[1]} + coalesce(l_neu, 0.0) / greatest(n_toks, 1) as z_neu,
    {I.BIAS[2]} + coalesce(l_pos, 0.0) / greatest(n_toks, 1) as z_pos
  from measured left join valued using (review_id) left join headed using (review_id)),
softmaxed as (
  select *, s + sign(s) * emphasis as total, greatest(z_neg, z_neu, z_pos) as z_top from logit),
parts as (
  select *, exp(z_neg - z_top) as e_neg, exp(z_neu - z_top) as e_neu, exp(z_pos - z_top) as e_pos from softmaxed),
sentiment as (
  select review_id, round(total / sqrt(total * total + {P.NORMALIZER}), 4) as sentiment_score,
    case when n_toks = 0 then 0.0 else round(e_pos / (e_neg + e_neu + e_pos) - e_neg / (e_neg + e_neu + e_pos), 4) end as model_sentiment,
    case when n_toks = 0 then 0.0 else round(e_neg / (e_neg + e_neu + e_pos), 4) end as model_neg,
    case when n_toks = 0 then 1.0 else round(e_neu / (e_neg + e_neu + e_pos), 4) end as model_neu,
    case when n_toks = 0 then 0.0 else round(e_pos / (e_neg + e_neu + e_pos), 4) end as model_pos
  from parts)"""


SCALED = "round((rating - 1) / 4 * 2 - 1, 4)"


def features(source: str) -> str:
    """CTEs up to ``features``: all columns of ``source`` plus the nine features."""
    return f"""{style(source)},
{sentiment(source)},
features as (
  select style.*, sentiment_score, model_sentiment,
    round(abs(sentiment_score - {SCALED}), 4) as rating_sentiment_gap,
    round(abs(model_sentiment - {SCALED}), 4) as model_rating_gap,
    round(abs(sentiment_score - model_sentiment), 4) as sentiment_dissonance
  from style join sentiment using (review_id))"""


STORED = """stored as (select review_id, text_ as review_text, rating, label, category from raw)"""
ALL_FEATURES = f"with {RAW},\n{STORED},\n{features('stored')}\n"
CLEAN_FEATURES = f"with {RAW},\n{CLEAN},\n{features('cleaned')}\n"


def term_ctes(source: str, stop_words, text_col: str = "review_text") -> str:
    """``terms(review_id, term, tf)`` of unigrams and bigrams."""
    stop = ", ".join(text(s) for s in stop_words)
    return f"""tokens as (
  select review_id, list_filter(regexp_extract_all(lower({text_col}), '{WORD}'),
    lambda x: length(x) >= 2 and x not in ({stop})) as toks from {source}),
unigrams as (select review_id, unnest(toks) as term, generate_subscripts(toks, 1) as pos from tokens),
pairs as (
  select review_id, term || ' ' || lead(term) over (partition by review_id order by pos) as term from unigrams),
terms as (
  select review_id, term, count(*) as tf
  from (select review_id, term from unigrams union all select review_id, term from pairs where term is not null)
  group by review_id, term)"""


def vocabulary_ctes(max_terms: int = 2000) -> str:
    return f"""vocab as (
  select term, sum(tf)::bigint as total, count(*) as df from terms group by term order by total desc, term limit {max_terms}),
weights as (
  select review_id, terms.term, (1 + ln(tf)) * (ln(cast(1 + (select count(*) from tokens) as double) / (1 + df)) + 1) as w
  from terms join vocab on terms.term = vocab.term)"""


def coefficient_cte() -> str:
    rows = [("text", f, w, idf) for f, w, idf in I.TEXT_WEIGHTS]
    return f"coef as (select * from {values(rows, 'kind, feature, weight, idf')})"


def score_ctes(source: str = "features") -> str:
    """``scored``: columns of ``features`` plus ``p``; needs ``terms`` and ``coef``."""
    z = " + ".join(
        f"(coalesce({f}, 0.0) - cast({m!r} as double)) / cast({s!r} as double) * cast({w!r} as double)"
        for f, w, m, s in I.NUMBER_WEIGHTS)
    return f"""text_part as (
  select review_id, sum((1 + ln(tf)) * idf * weight) / sqrt(sum(((1 + ln(tf)) * idf) * ((1 + ln(tf)) * idf))) as text_z
  from terms join coef on coef.feature = terms.term group by review_id),
scored as (
  select {source}.*, 1 / (1 + exp(-(cast({I.INTERCEPT} as double) + {z} + coalesce(text_z, 0.0)))) as p
  from {source} left join text_part using (review_id))"""


def flag_list() -> str:
    """SQL list of the messages that apply, in order."""
    from ..functions import verdict as V

    def message(template: str, col: str) -> str:
        before, after = template.split("{}")
        return (f"{text(before)} || cast(cast(cast({col} as decimal(18,4)) as decimal(18,2)) as varchar) || {text(after)}")

    tests = [
        (f"sentiment_dissonance > {V.DISSONANCE_ABOVE}", V.DISSONANCE_MESSAGE, "sentiment_dissonance"),
        (f"model_rating_gap > {V.MODEL_GAP_ABOVE}", V.MODEL_GAP_MESSAGE, "model_rating_gap"),
        (f"rating_sentiment_gap > {V.LEXICON_GAP_ABOVE}", V.LEXICON_GAP_MESSAGE, "rating_sentiment_gap"),
        (f"punctuation_freq > {V.PUNCTUATION_ABOVE}", V.PUNCTUATION_MESSAGE, "punctuation_freq"),
        (f"vocab_diversity < {V.DIVERSITY_BELOW}", V.DIVERSITY_MESSAGE, "vocab_diversity"),
    ]
    cases = ", ".join(f"case when {test} then {message(m, c)} end" for test, m, c in tests)
    return f"list_filter([{cases}], lambda x: x is not null)"
