"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tallyframe.llm import decontam, quality

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"

CHAT = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
    as loss_sha256,
  cast(sum(length({ESCAPED.format('role')}) + length({ESCAPED.format('text')})
    + {len('<|im_start|><|im_sep|><|im_end|>') + 1}) as bigint) as formatted_chars
from turns group by conv_id
"""


def _quality() -> str:
    short = {"_q_words": "n_words", "_q_lines": "n_lines", "_q_word_chars": "word_chars",
             "_q_n_symbols": "n_symbols", "_q_n_dup_lines": "n_dup_lines",
             "_q_n_repeat_words": "n_repeat_words"}
    measures, inside = [], []
    for m, (a, b, scale, slack, low) in quality.MEASURES.items():
        measures.append(f"coalesce(({scale} * {short[a]}) // nullif({short[b]}, 0), 0) as {m}")
        bound = f"q3 + {quality.REACH} * (q3 - q1) + {slack}"
        inside.append(f"{m} <= (select {bound} from limits l where l.g = wide.g and l.measure = '{m}')")
        if low:
            bound = f"q1 - {quality.REACH} * (q3 - q1) - {slack}"
            inside.append(f"{m} >= (select {bound} from limits l where l.g = wide.g and l.measure = '{m}')")
    longs = ", ".join(f"struct_pack(measure := '{m}', x := {m})" for m in quality.MEASURES)
    return rf"""
with texts as (select doc_id, lang, source, coalesce(text, '') as text from documents),
lists as (select *, {WORDS.format('text')} as w, list_filter(string_split(text, chr(10)),
    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as rows from texts),
windows as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from lists)),
repeated as (select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by doc_id),
counted as (select doc_id, lang, source, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(rows) as bigint) as n_lines, cast(len(rows) - len(list_distinct(rows)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from lists left join repeated using (doc_id)),
judged as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
    {', '.join(measures)} from counted),
sizes as (select lang, source, count(*) as own, sum(count(*)) over (partition by lang) as by_lang
  from judged where not base_failed group by lang, source),
wide as (select j.*, case when own >= {quality.MIN_GROUP} then concat('s', coalesce('l' || j.lang, ''), '/',
      coalesce('s' || j.source, '')) when by_lang >= {quality.MIN_GROUP}
      then concat('l', coalesce('l' || j.lang, '')) else 'all' end as g
  from judged j left join sizes s on s.lang is not distinct from j.lang
    and s.source is not distinct from j.source),
cells as (select unnest([concat('s', coalesce('l' || lang, ''), '/', coalesce('s' || source, '')),
      concat('l', coalesce('l' || lang, '')), 'all']) as g, cell.measure as measure, cell.x as x
  from (select lang, source, unnest([{longs}]) as cell from judged where not base_failed)),
bins as (select g, measure, (x >> s) << s as bin, count(*) as n
  from (select *, greatest(length(bin(x)) - 6, 0)::int as s from cells) group by all),
ranked as (select *, sum(n) over (partition by g, measure) as size,
    sum(n) over (partition by g, measure order by bin) as upto from bins),
limits as (select g, measure, min(bin) filter (4 * upto >= size) as q1,
    min(bin) filter (4 * upto >= 3 * size) as q3 from ranked group by g, measure)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce({' and '.join(inside)}, false) as kept
from wide
"""


def _leaks() -> str:
    """All alignments of all items of five tokens or more, without seeds; shorter items as whole lines."""
    def tokens(text: str) -> str:
        return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"
    return f"""
with items as (select item_id, w, len(w) as size from (select item_id, {tokens('text')} as w from benchmark)),
asked as (select item_id, size, unnest(w) as token, unnest(range(len(w))) as k from items
  where size >= {decontam.GROUP}),
placed as (select doc_id, unnest(w) as token, unnest(range(len(w))) as p
  from (select doc_id, {tokens('text')} as w from documents)),
lined as (select doc_id, item_id, size, p - k as at, count(*) as n
  from placed join asked using (token) group by all),
lines as (select doc_id, {tokens('line')} as w
  from (select doc_id, unnest(string_split(text, chr(10))) as line from documents))
select doc_id, item_id, max(n) as n_match, cast(size as bigint) as n_tokens from lined
where n >= {decontam.SIMILARITY} * size group by doc_id, item_id, size
union all
select distinct doc_id, item_id, size as n_match, cast(size as bigint) as n_tokens
from lines join items using (w) where size between 1 and {decontam.GROUP - 1}
"""


IMPORTANCE = r"""
with recursive
-- CRC-32 by its rule: a table of the 256 bytes, then one step per byte of each distinct word
steps(n, k, c) as (select range, 0, range from range(256) union all
  select n, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8),
bytewise as (select list(c order by n) as t from steps where k = 8),
texts as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
wanted as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
used as (select doc_id, unnest(w) as word from texts),
words as (select word, hex(encode(word)) as h from (select word from used union select word from wanted)),
coded as (select word, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
    range(1, length(h), 2), lambda i: (16 * (instr('0123456789ABCDEF', h[i]) - 1)
      + instr('0123456789ABCDEF', h[i + 1]) - 1)::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 as bucket from words, bytewise),
source as (select bucket, count(*) as s from used join coded using (word) group by bucket),
target as (select bucket, count(*) as t from wanted join coded using (word) group by bucket),
sums as (select (select coalesce(sum(s), 0) from source)::double as n, (select coalesce(sum(t), 0) from target)::double as m),
gains as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (n + 10000)
    / ((s + 1)::double * (m + 10000))))::bigint as gain from source left join target using (bucket), sums),
weights as (select doc_id, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
  from used join coded using (word) join gains using (bucket) group by doc_id),
scored as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::bigint + 0.5::double) / 4294967296)))::bigint as score
  from texts left join weights using (doc_id)),
placed as (select doc_id, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20),
drawn as (select * from placed where rank <= (select count(*) * 10 // 100 from placed))
select doc_id, n_features, weight, score, rank from scored left join drawn using (doc_id)
"""

NEGATIVES = """
with rows as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
    list_dot_product(a.q, b.q)::bigint as score from rows a join rows b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (select *, row_number() over (partition by anchor_id order by score desc, other) as k
  from scored where same qualify k <= 5),
windows as (select p.anchor_id, p.other as positive_id, n.other as negative_id, p.score as positive_score,
    n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other) as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from windows where rank <= 3
"""

ORACLES = {"op2_chat_format": CHAT, "op6_quality_rules": _quality(), "op10_decontaminate": _leaks(),
           "op11_importance": IMPORTANCE, "op12_hard_negatives": NEGATIVES}
