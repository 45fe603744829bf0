"""SQL counterparts of the training-data queries, for DuckDB."""

from __future__ import annotations

from reviewscope.llm import chat_format, collocations, lexical_search, secret_scan, suffix_dedup


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _spans(order: int, rule: secret_scan.Rule) -> str:
    search = _quote(f"(?s)(.*?)({rule.regex})")
    return f"""
select doc_id, {_quote(rule.kind)} as kind, {order} as ord,
       sum(length(b) + length(w)) over (partition by doc_id order by i) - length(w) as s,
       sum(length(b) + length(w)) over (partition by doc_id order by i) as e, length(v) as n
from (select doc_id, unnest(regexp_extract_all(text, {search}, 1)) as b, unnest(regexp_extract_all(text, {search}, 2)) as w,
             unnest(regexp_extract_all(text, {search}, {rule.group + 2})) as v,
             unnest(range(len(regexp_extract_all(text, {search}, 2)))) as i from d)
qualify n >= {rule.least}"""


_BASE = ", ".join(_quote(r.kind) for r in secret_scan.BASE_RULES)
_ITEM = "concat_ws(':', kind, s, e)"
SECRETS_SQL = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
found as ({" union all ".join(_spans(i, r) for i, r in enumerate(secret_scan.RULES))}),
listed as (
  select doc_id, {", ".join(f"count(*) filter (kind = {_quote(r.kind)}) as n_{r.kind}" for r in secret_scan.BASE_RULES)},
         string_agg({_ITEM}, ',' order by s, ord) filter (kind in ({_BASE})) as base,
         string_agg({_ITEM}, ',' order by s, ord) as spans
  from found group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secret_scan.BASE_RULES)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join listed on d.doc_id = listed.doc_id
"""


def _escaped(column: str, escapes) -> str:
    for plain, escaped in escapes:
        column = f"replace({column}, {_quote(plain)}, {_quote(escaped)})"
    return column


_MARKS = len(chat_format.HEAD + chat_format.MID + chat_format.TAIL)
_CONTROL = _quote(r"\### Assistant: </turn> ok")
CHATS_SQL = f"""
with c as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', {_CONTROL} union all select -7, 1, 'assistant', {_CONTROL})
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum({_MARKS} + length({_escaped('role', chat_format.ROLE_ESCAPES)}) + length({_escaped('text', chat_format.TEXT_ESCAPES)}))::bigint as formatted_chars
from c group by conv_id
"""


def _terms(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{lexical_search.UPPER}', '{lexical_search.LOWER}')"
    return f"unnest(regexp_extract_all({lowered}, {_quote('[^' + lexical_search.GAPS[1:])}))"


SEARCH_SQL = f"""
with q as (select distinct item_id, term from (select item_id, {_terms("text")} as term from benchmark)),
t as (select r, doc_id, {_terms("text")} as term from (select *, row_number() over () as r from documents)),
d as (select r, any_value(doc_id) as doc_id, count(*) as n from t group by r),
total as (select count(*) as docs, sum(n)::bigint as length from d),
tf as (select r, term, count(*) as tf from t where term in (select term from q) group by r, term),
w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
      from (select term, count(*) as df from tf group by term), total),
scored as (
  select item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // length)))))::bigint as score
  from q join tf using (term) join w using (term) join d using (r), total group by item_id, doc_id, r)
select * from (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id nulls last))::int as rank, doc_id, score
  from scored where score > 0) where rank <= 10
"""


_PIECE_ENDS = _quote(r"[.,;:!?\n\x0B\x0C\r]")
_LOWERED = f"translate(coalesce(text, ''), '{lexical_search.UPPER}', '{lexical_search.LOWER}')"
COLLOCATIONS_SQL = f"""
with pieces as (
  select lang, regexp_extract_all(piece, '[^ \\x09]+') as w
  from (select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWERED}, {_PIECE_ENDS})) as piece from documents)),
grams as (
  select lang, unnest(w) as phrase, 1 as k from pieces
  union all select lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 from pieces
  union all select lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 from pieces),
f as (select lang, phrase, k, count(*) as f from grams group by lang, phrase, k),
totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
candidates as (select lang, phrase, k, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= {collocations.LEAST}),
longer as (
  select lang, phrase, max(a) as a from (
    select lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase from candidates where k = 3) group by lang, phrase),
kept as (
  select c.* from candidates c left join longer o on c.k = 2 and o.lang = c.lang and o.phrase = c.phrase
  where o.a is null or 100 * o.a < {collocations.DROP_PERCENT} * c.a),
cuts as (
  select lang, phrase, a, cut, array_to_string(w[1:cut], ' ') as left_part, array_to_string(w[cut + 1:], ' ') as right_part
  from (select *, unnest(range(1, k)) as cut from kept)),
scored as (
  select c.lang, c.phrase, c.a, cut, x.f as l, y.f as r, ((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join f x on x.lang = c.lang and x.phrase = left_part join f y on y.lang = c.lang and y.phrase = right_part),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best) join totals using (lang)
where rank <= {collocations.TOP}
"""


_LENGTH = suffix_dedup.LENGTH
# Byte strings as hexadecimal digits, two a byte.
SUFFIXES_SQL = f"""
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (select r, i, md5(substr(h, 2 * i + 1, {2 * _LENGTH})) as w from (select r, h, unnest(range(0, len(h) // 2 - {_LENGTH - 1})) as i from d)),
gone as (select r, i from windows join (select w from windows group by w having count(*) > 1) using (w)),
spans as (
  select r, min(i) as a, max(i) + {_LENGTH} as b
  from (select r, i, sum(new::int) over (partition by r order by i) as span
        from (select r, i, coalesce(i > lag(i) over (partition by r order by i) + {_LENGTH}, true) as new from gone))
  group by r, span),
stays as (
  select r, h, a, b, substr(h, 2 * lag(b, 1, 0) over (partition by r order by a) + 1, 2 * (a - lag(b, 1, 0) over (partition by r order by a))) as part
  from spans join d using (r)),
cut as (
  select r, count(*) as n_spans, sum(b - a)::bigint as n_removed,
         string_agg(part, '' order by a) || substr(any_value(h), 2 * max(b) + 1) as kept
  from stays group by r)
select doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join cut using (r)
"""
