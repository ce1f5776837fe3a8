"""The quality rules in plain SQL, for comparison."""

from tallyhall.llm.rules import LEAST, RATES

_WORD = r"[^ \t\n\v\f\r]"
_VALUES = "\n  union all ".join(
    f"select lang, source, '{name}' as rate, ({how.replace(' div ', ' // ')}) as value from passed" for name, how, _, _ in RATES)
_CUTS = ",\n  ".join(
    f"max(case when rate = '{name}' then high + 3 * (high - low) + {slack} end) as max_{name}"
    + (f", max(case when rate = '{name}' then low - 3 * (high - low) - {slack} end) as min_{name}" if two else "")
    for name, _, slack, two in RATES)
_INSIDE = " and ".join(
    f"({how.replace(' div ', ' // ')}) <= max_{name}" + (f" and ({how.replace(' div ', ' // ')}) >= min_{name}" if two else "")
    for name, how, _, two in RATES)


def _quantiles(groups: str) -> str:
    part = f"partition by {groups}"
    return f"""select {groups}, max(total) as size,
    min(case when upto >= ceil(0.25 * total) then top end) as low, min(case when upto >= ceil(0.75 * total) then top end) as high
    from (select *, sum(n) over ({part} order by top) as upto, sum(n) over ({part}) as total
          from (select {groups}, top, sum(n) as n from sketch group by {groups}, top)) group by {groups}"""


def _pick(c: str) -> str:
    return f"case when f.size >= {LEAST} then f.{c} when l.size >= {LEAST} then l.{c} else a.{c} end as {c}"


QUALITY_RULES_SQL = f"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls
  from documents),
grams as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
places as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as times from grams) where times > 1),
repeats as (
  select doc_id, sum(least(8, coalesce(nxt - i, 8))) as n
  from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from places) group by doc_id),
counts as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words
  from d left join repeats r using (doc_id)),
judged as (
  select *, (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed from counts),
passed as (select * from judged where not base_failed),
vals as ({_VALUES}),
sketch as (
  select lang, source, rate, (((value >> s) + 1) << s) - 1 as top, count(*) as n
  from (select *, greatest(length(bin(value)) - 7, 0)::bigint as s from vals) group by all),
f as ({_quantiles("lang, source, rate")}),
l as ({_quantiles("lang, rate")}),
a as ({_quantiles("rate")}),
q as (
  select f.lang, f.source, f.rate, {_pick("low")}, {_pick("high")}
  from f join l on f.lang = l.lang and f.rate = l.rate join a on f.rate = a.rate),
cuts as (select lang, source, {_CUTS} from q group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  case when base_failed then false else {_INSIDE} end as kept
from judged left join cuts using (lang, source)
"""
