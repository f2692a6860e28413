"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _count(column: str, characters: str) -> str:
    return (f"(length({column}) - length(translate({column}, '{characters}', '')))")


_STOCK = ("cookies?|privacy_policy|terms_of_(use|service)|all_rights_reserved|javascript|lorem_ipsum|click_here|read_more|"
          "sign_(in|up)|log_?in|subscribe|newsletter|share_this|follow_us|skip_to_content|back_to_top|powered_by")
_SPACED = r"regexp_replace(' ' || translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || ' ', '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '  ', 'g')"
_LETTERS = f"replace({_SPACED}, ' ', '')"
_PHRASE_LETTERS = (f"(length({_LETTERS}) - length(replace(regexp_replace({_SPACED}, "
                   f"' ({_STOCK.replace('_?', '( ?| {2})').replace('_', '  ')}) ', '', 'g'), ' ', '')))")

QUALITY_RULES = rf"""
with parts as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, {_WORDS} as words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
), grams as (
  select r, i, words[i:i + 4] as g
  from (select r, words, unnest(range(1, len(words) - 3)) as i from parts)
), repeated as (
  select r, i from grams qualify count(*) over (partition by r, g) > 1
), covered as (
  select r, count(distinct i + j) as n
  from repeated, (select unnest(range(0, 5)) as j) group by r
), passing as (
  select r, list_filter(lines, lambda l:
      regexp_matches(l, '[.!?…]["''”’»)\]]*(\s|$)')
      and {_count('l', '|>»·•')} * 20 <= length(l)
      and {_count('l', '#*$%&<!')} * 20 <= length(l)
      and ({_PHRASE_LETTERS} = 0 or 100 * {_PHRASE_LETTERS} < 33 * length({_LETTERS}))) as ok
  from parts
), counts as (
  select doc_id, cast(len(words) as bigint) as n_words,
         cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
         cast({_count('t', '#*$%&|<>')} as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(n, 0) as bigint) as n_repeat_words,
         coalesce(list_sum(list_transform(lines, lambda l: length(l))), 0) as all_chars,
         coalesce(list_sum(list_transform(ok, lambda l: length(l))), 0) as ok_chars
  from parts join passing using (r) left join covered using (r)
), judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * ok_chars >= 50 * all_chars as kept
from judged
"""

SUBSTRING_DEDUP = rf"""
with parts as (
  select row_number() over () as r, doc_id, {_WORDS} as words from documents
), windows as (
  select r, i, sha256(array_to_string(words[i:i + 34], ' ')) as g
  from (select r, words, unnest(range(1, len(words) - 33)) as i from parts)
), repeated as (
  select r, i from windows qualify count(*) over (partition by g) > 1
), gone as (
  select distinct r, i + j as p from repeated, (select unnest(range(0, 35)) as j)
), places as (
  select r, p, words[p] as w
  from (select r, words, unnest(range(1, len(words) + 1)) as p from parts)
), kept as (
  select r, count(*) as n, string_agg(w, ' ' order by p) as t
  from places anti join gone using (r, p) group by r
)
select doc_id, cast(len(words) as bigint) as n_words,
       cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from parts left join kept using (r)
"""

_FOLDED = (r"list_filter(string_split_regex(translate(coalesce(text, ''), "
           r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

DECONTAMINATE = rf"""
with items as (
  select coalesce(cast(item_id as varchar), '') as item_id, {_FOLDED} as words from benchmark
), wanted as (
  select distinct item_id, len(words) as m, words as g from items where len(words) between 1 and 9
  union
  select distinct item_id, 10, words[i:i + 9]
  from (select item_id, words, unnest(range(1, len(words) - 8)) as i from items)
), docs as (
  select row_number() over () as r, doc_id, {_FOLDED} as words from documents
), lengths as (
  select distinct m from wanted
), windows as (
  select r, m, i, words[i:i + m - 1] as g
  from (select r, m, words, unnest(range(1, len(words) - m + 2)) as i from docs, lengths)
), found as (
  select r, m, i, item_id from windows join wanted using (m, g)
), hit as (
  select r, count(distinct i + j) as n
  from (select r, i, unnest(range(0, m)) as j from found) group by r
), named as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct r, item_id from found) group by r
)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n, 0) > 0 as contaminated
from docs left join hit using (r) left join named using (r)
"""

_HEX = "cast('0x' || substr(seed, {}, 8) as bigint)"

FILL_MIDDLE = rf"""
with parts as (
  select coalesce(text, '') as t, doc_id, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as seed,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units
  from documents
), cuts as (
  select *, len(units) as n, {_HEX.format(1)} % (len(units) + 1) as x,
         {_HEX.format(9)} % (len(units) + 1) as y,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                   or {_HEX.format(17)} % 100 >= 90 then 'plain'
              when {_HEX.format(25)} % 100 < 20 then 'spm' else 'psm' end as form
  from parts
), cut as (
  select *, array_to_string(units[1:least(x, y)], '') as p,
         array_to_string(units[least(x, y) + 1:greatest(x, y)], '') as m,
         array_to_string(units[greatest(x, y) + 1:], '') as s
  from cuts
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m
                        else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from cut
"""
