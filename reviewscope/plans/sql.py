"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Of a fitted model SQL follows what does not depend on the fit: sizes and baselines
of its report, which rows can be scored at all, the tried grid, and the whole
result of a one-cut tree.
"""

from __future__ import annotations

from itertools import product

from reviewscope.functions.wordlists import ENGLISH_STOP_WORDS, PUNCTUATION
from reviewscope.models.tuning import ALS_GRID, BOOSTED_GRID, TREE_GRID
from reviewscope.schema import ID_COLUMNS, RATINGS

# The 181 default English stop words of Spark ML.
ML_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(words: list[str]) -> str:
    return "(" + ", ".join(map(_quote, words)) + ")"


RATINGS_SQL = """
select event_id as review_id, user_id, (event_id * 7919 + 13) % 997 as business_id, ts as date,
       (cast(floor(value) as bigint) % 7)::int as funny, (cast(floor(value) as bigint) % 5)::int as cool,
       (cast(floor(value) as bigint) % 11)::int as useful,
       case event_type when 'error' then 1 when 'view' then 2 when 'click' then 3
                       when 'signup' then 4 else 5 end as stars, value
from events"""
REVIEWS_SQL = f"""
select r.*, d.text from ({RATINGS_SQL}) r
join documents d on d.doc_id = r.review_id % (select max(doc_id) + 1 from documents)"""
DATE = "strftime(date, '%Y-%m-%d %H:%M:%S')"
STRING_KEYS_SQL = f"""
select review_id as row_id, md5(user_id::varchar) as user_id, md5(business_id::varchar) as business_id,
       md5(review_id::varchar) as review_id, stars from ({RATINGS_SQL})"""
ENCODED_SQL = f"""
select row_id, {', '.join(f'dense_rank() over (order by {c}) - 1 as {c}' for c in ID_COLUMNS)}, stars
from ({STRING_KEYS_SQL})"""
# Keys of the first load are numbered in order, then those that only the second one has.
LOADS_SQL = f"""
with loaded as (
  select md5(user_id::varchar) as user_id, md5(business_id::varchar) as business_id, md5(review_id::varchar) as review_id,
         review_id as row_id, stars, case when day(date) <= 15 then 1 else 2 end as load
  from ({RATINGS_SQL})),
{', '.join(f"""
{c}_codes as (select {c}, row_number() over (order by min(load), {c}) - 1 as code from loaded group by 1)""" for c in ID_COLUMNS)}
select row_id, {', '.join(f'{c}_codes.code as {c}' for c in ID_COLUMNS)}, stars, load
from loaded {' '.join(f'join {c}_codes on loaded.{c} = {c}_codes.{c}' for c in ID_COLUMNS)}"""
TRAINING = "('0x' || substr(md5(review_id::varchar), 1, 4))::bigint % 10 < 7"
LABELLED_SQL = """
select doc_id, text, n_chars, quality::double as label from documents join labels using (doc_id)"""
SCORED_SQL = f"""
select doc_id, n_chars, case when n_chars > 1400 then 1.0::double else 0.0::double end as prediction,
       label as "trueLabel" from ({LABELLED_SQL})"""


def _strip(value: str) -> str:
    return f"""trim(trim({value}, ''''), '"')"""


def _clean(value: str) -> str:
    """Prefix, then single quotes, then double quotes."""
    return _strip(f"""regexp_replace({value}, '^b([''"])', '\\1')""")


def _scale(column: str, digits: int) -> str:
    low, high = f"min({column}) over ()", f"max({column}) over ()"
    return f"round(({column} - {low})::double / ({high} - {low}), {digits}) as {column}"


def _tokens(text: str, final: str = "") -> str:
    """Word tokens by padding with blanks step by step; every blank of the text becomes two. ``final``: what follows a final period."""
    steps = [
        (r"[\s\p{Z}]", "  "),
        (rf"""([^. ])\.([\])}}>"']*)  {final}""", r"\1  .  \2  "),
        (r"""(\.\.\.|--|[;@#$%&?!\[\](){}<>"])""", r"  \1  "),
        (r"([:,])", r"  \1  "),
        (r"  ([:,])  ([0-9])", r"\1\2"),
        (r"([^' ])(n't|N'T)  ", r"\1  \2  "),
        (r"([^' ])('(?:[sSmMdD]|ll|LL|re|RE|ve|VE)?)  ", r"\1  \2  "),
        (r"(?i)\b(can)(not)\b", r"\1  \2"),
        (r"(?i)\b(gim|lem)(me)\b", r"\1  \2"),
        (r"(?i)\b(gon|wan)(na)\b", r"\1  \2"),
        (r"(?i)\b(got)(ta)\b", r"\1  \2"),
    ]
    value = f"('  ' || {text} || '  ')"
    for pattern, put in steps:
        value = f"regexp_replace({value}, {_quote(pattern)}, {_quote(put)}, 'g')"
    return f"list_filter(string_split_regex({value}, ' +'), lambda t: t <> '')"


def _kept(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: lower(t) not in {_in(ENGLISH_STOP_WORDS)})"


def _stripped(tokens: str) -> str:
    bare = f"list_transform({tokens}, lambda t: translate(t, {_quote(PUNCTUATION)}, ''))"
    return f"list_filter({bare}, lambda t: t not in ('', ' '))"


def _token_query(tokens: str, name: str = "tokens") -> str:
    return f"""
select doc_id, len({name})::int as n_tokens, array_to_string({name}, ' ') as {name}
from (select doc_id, {tokens} as {name} from documents)"""


CLEAN_TOKENS = _stripped(_kept(_tokens("text")))
WORD_FREQ_SQL = f"""
select stars, lower(w) as word, count(*) as n
from (select stars, unnest({CLEAN_TOKENS}) as w from ({REVIEWS_SQL})) group by 1, 2"""

# Spark's Tokenizer splits at each white-space character and drops trailing empties only.
ML_TOKENS = r"string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')"
ML_KEPT = f"list_filter({ML_TOKENS}, lambda t: t not in {_in(ML_STOP_WORDS)})"


_OPENING, _CLOSING = """''"([{<""", """"'')]}>"""


def _word(piece: str) -> str:
    return f"lower(rtrim(ltrim({piece}, '{_OPENING}'), '{_CLOSING}.,;:!?'))"


def _ending(piece: str) -> str:
    bare = f"rtrim({piece}, '{_CLOSING}')"
    return f"""case when right({bare}, 1) in ('!', '?') then 'end' when {bare} like '%_.' and {bare} not like '%..' then 'dot'
                    when {bare} like '%..' then 'dots' else 'open' end"""


def _first(piece: str) -> str:
    return f"substr(ltrim({piece}, '{_OPENING}'), 1, 1)"


def _likelihood(k: str, n: str, share: str) -> str:
    return f"(case when {k} > 0 then {k} * ln({share}) else 0 end + case when {n} > {k} then ({n} - {k}) * ln(1 - {share}) else 0 end)"


# Pieces in their places, and the words with a period: how often, the ratio, and the score.
ABBREVIATIONS_SQL = f"""
with split as (select doc_id, list_filter(string_split_regex(text, '[\\s\\p{{Z}}]+'), lambda p: p <> '') as ps from documents),
placed as (
  select doc_id, place, ps[place] as piece, case when place > 1 then ps[place - 1] end as last, ps[place + 1] as follow
  from (select doc_id, ps, unnest(range(1, len(ps) + 1)) as place from split)),
known as (
  select *, {_word('piece')} as word, {_word('follow')} as next_word, {_ending('piece')} as kind,
         case when last is null then 'end' else {_ending('last')} end as before, {_word('last')} as before_word,
         {_first('follow')} <> lower({_first('follow')}) as next_capital,
         rtrim(piece, '{_CLOSING},;:') as shorn
  from placed),
per_word as (
  select word, count(*) filter (where shorn like '%_.' and shorn not like '%..') as n_dot,
         count(*) filter (where not (shorn like '%_.' and shorn not like '%..')) as n_plain
  from known where lower(word) <> upper(word) group by 1),
share as (select sum(n_dot)::double / sum(n_dot + n_plain) as p from per_word),
ratios as (
  select word, n_dot, n_plain, length(word) - length(replace(word, '.', '')) as inner_periods,
         2 * (n_dot * ln(0.99 / p) + case when n_plain > 0 then n_plain * ln(0.01 / (1 - p)) else 0 end) as ratio
  from per_word, share where n_dot > 0),
scores as (
  select word, n_dot, n_plain, ratio,
         ratio * exp(inner_periods - length(word)) * (inner_periods + 1) * pow(length(word) - inner_periods, -20.0 * n_plain / n_dot) as score
  from ratios)"""
# A period after one of those ends a sentence before a starter only.
SENTENCES_SQL = f"""{ABBREVIATIONS_SQL},
short as (select word from scores where score >= 0.3),
told as (
  select word, case before when 'dot' then 'end' else before end as before, piece from known
  where before in ('end', 'open') or before = 'dot' and before_word not in (select word from short)),
counts as (
  select word, count(*) filter (where before = 'end') as k1, count(*) filter (where before = 'open') as k2,
         count(*) filter (where {_first('piece')} <> upper({_first('piece')})) as n_small,
         count(*) filter (where before = 'open' and {_first('piece')} <> lower({_first('piece')})) as n_capital
  from (select {_word('piece')} as word, before, piece from told) group by 1),
totals as (select sum(k1)::double as n1, sum(k2)::double as n2 from counts),
starters as (
  select word from counts, totals
  where lower(word) <> upper(word) and (n_small > 0 and n_capital = 0 or k1 / n1 > k2 / n2 and 2 * (
    {_likelihood('k1', 'n1', '(k1 / n1)')} + {_likelihood('k2', 'n2', '(k2 / n2)')}
    - {_likelihood('k1', 'n1', '((k1 + k2) / (n1 + n2))')} - {_likelihood('k2', 'n2', '((k1 + k2) / (n1 + n2))')}) >= 30)),
ended as (
  select *, follow is null or kind = 'end' or kind = 'dots' and next_capital
            or kind = 'dot' and (word not in (select word from short) or next_capital and next_word in (select word from starters)) as is_end
  from known),
numbered as (
  select *, coalesce(sum(is_end::int) over (partition by doc_id order by place rows between unbounded preceding and 1 preceding), 0) as sentence
  from ended),
lines as (select doc_id, sentence::int as sentence, string_agg(piece, ' ' order by place) as line from numbered group by 1, 2)
select doc_id, sentence, len(tokens)::int as n_tokens, array_to_string(tokens, ' ') as tokens
from (select doc_id, sentence, {_tokens('line', ' *$')} as tokens from lines)"""


def _crosstab(label: str, source: str) -> str:
    counts = ", ".join(f"count(*) filter (where stars = {r}) as stars_{r}" for r in RATINGS)
    return f"select {label}, {counts} from ({source}) group by 1"


BOXES_SQL = """
quartiles as (
  select measure, stars, count(*) as n, quantile_cont(y, 0.25) as q1, quantile_cont(y, 0.5) as median,
         quantile_cont(y, 0.75) as q3
  from measured group by 1, 2),
whiskers as (
  select m.measure, m.stars,
         min(y) filter (where y >= q1 - 1.5 * (q3 - q1)) as low,
         max(y) filter (where y <= q3 + 1.5 * (q3 - q1)) as high,
         count(*) filter (where y < q1 - 1.5 * (q3 - q1) or y > q3 + 1.5 * (q3 - q1)) as n_outliers
  from measured m join quartiles q on m.measure = q.measure and m.stars = q.stars group by 1, 2)"""


def _confusion(select: str) -> str:
    return f"""
with c as (
  select count(*) filter (where prediction = 1 and "trueLabel" = 1) as tp,
         count(*) filter (where prediction = 1 and "trueLabel" = 0) as fp,
         count(*) filter (where prediction = 0 and "trueLabel" = 0) as tn,
         count(*) filter (where prediction = 0 and "trueLabel" = 1) as fn
  from ({SCORED_SQL}))
{select}"""


def _raw(columns: list[str], source: str = REVIEWS_SQL) -> str:
    def cell(c: str) -> str:
        value = {**{i: f"md5({i}::varchar)" for i in ID_COLUMNS}, "date": DATE}.get(c, f"{c}::varchar")
        return f"'b''' || {value} || '''' as {c}"
    return f"select {', '.join(map(cell, columns))} from ({source})"


_ALL = ["user_id", "text", "date", "review_id", "business_id", "funny", "cool", "useful", "stars"]
_CLEANED = ", ".join(
    f"{_clean(c)}::int as {c}" if c in ("funny", "cool", "useful", "stars")
    else f"md5({_clean(c)}) as text, length({_clean(c)})::int as n_chars" if c == "text"
    else f"{_clean(c)} as {c}" for c in _ALL)
CLEAN_ROWS_SQL = f"select {_CLEANED} from ({_raw(_ALL)})"
PLAIN_RATINGS_SQL = f"""
select review_id, user_id, business_id, {DATE} as date, funny, cool, useful, stars from ({RATINGS_SQL})"""
GAPPY_SQL = """
select d.doc_id, case when lang = 'de' then null when quality is null then 'nan'::double
                      else (n_chars - 1400) / 1000.0::double end as prediction
from documents d left join labels l on d.doc_id = l.doc_id"""

DOC_TRAINING = TRAINING.replace("review_id", "doc_id")


def _judged(test_rows: str) -> str:
    """Class sizes and majority F1 of rows with a 0/1 ``label``."""
    return f"""
select n_positive, n_negative, round(2 * share * share / (1 + share), 9) as majority_f1, true as holds_up
from (select count(*) filter (label = 1) as n_positive, count(*) filter (label = 0) as n_negative,
             greatest(count(*) filter (label = 1), count(*) filter (label = 0))::double / count(*) as share
      from ({test_rows}))"""


ID_TEST = f"select case when stars > 2 then 1 else 0 end as label from ({RATINGS_SQL}) where not {TRAINING}"
TEXT_TEST = f"select quality as label from labels join documents using (doc_id) where not {DOC_TRAINING}"


def _grid(values: dict[str, list], facts: str) -> str:
    """All grid points in order, beside the one row of ``facts``."""
    points = [dict(zip(values, p)) for p in product(*values.values())]
    shown = [", ".join(f"{k}={v}" for k, v in sorted(p.items())) for p in points]
    rows = ", ".join(f"({i}::int, {_quote(x)})" for i, x in enumerate(shown))
    return f"select point, parameters, true as usable, f.* from (values {rows}) g(point, parameters), ({facts}) f"


COVERAGE_SQL = f"""
with r as (select review_id, user_id, business_id, case when stars > 2 then 1.0::double else 0.0::double end as label,
                  {TRAINING} as training from ({RATINGS_SQL}))
select review_id, label as "trueLabel",
       user_id in (select user_id from r where training) and business_id in (select business_id from r where training) as scored
from r where not training"""
SCORED_COUNTS = f"select count(*) as n_rows, count(*) filter (scored) as n_scored from ({COVERAGE_SQL})"

STUMP_SQL = f"""
with d as (select doc_id, least(n_chars // 200, 20)::bigint as length, quality::double as label, {DOC_TRAINING} as training
           from documents join labels using (doc_id)),
cuts as (select distinct length as cut from d where training),
sides as (
  select cut, count(*) filter (length <= cut) as nl, coalesce(sum(label) filter (length <= cut), 0) as pl,
         count(*) filter (length > cut) as nr, coalesce(sum(label) filter (length > cut), 0) as pr
  from cuts, d where training group by cut),
best as (
  select * from sides where nr > 0
  order by nl * (pl / nl) * (1 - pl / nl) + nr * (pr / nr) * (1 - pr / nr), cut limit 1)
select doc_id, length, case when length <= cut then (2 * pl > nl)::int::double else (2 * pr > nr)::int::double end as prediction,
       label as "trueLabel"
from d, best where not training"""

# MurmurHash3 for 32 bits over UTF-8, seed 42. Its multipliers and shifts.
_WORD = 4294967296


def _turned(value: str, bits: int) -> str:
    return f"(({value}) * {1 << bits} % {_WORD} + ({value}) // {1 << 32 - bits})"


def _stirred(value: str) -> str:
    return f"({_turned(f'({value}) * 3432918353 % {_WORD}', 15)} * 461845907 % {_WORD})"


def _little_endian(first: str, size: int) -> str:
    digits = " || ".join(f"substr(x, 2 * ({first}) + {2 * i + 1}, 2)" for i in reversed(range(size)))
    return f"('0x' || {digits})::ubigint"


_TAIL = "case n % 4 " + " ".join(f"when {i} then {_stirred(_little_endian('n - n % 4', i))}" for i in (1, 2, 3)) + " else 0::ubigint end"
HASHED_SQL = f"""
with words as (select doc_id, unnest({ML_KEPT}) as word from documents),
spelled as (select word, hex(encode(word)) as x, octet_length(encode(word))::bigint as n from (select distinct word from words)),
blocks as (
  select word, n, {_TAIL} as tail,
         list_prepend(42::ubigint, list_transform(range(0, n // 4), lambda i: {_stirred(_little_endian('4 * i', 4))})) as k from spelled),
body as (select word, n, tail, list_reduce(k, lambda h, b: ({_turned('xor(h, b)', 13)} * 5 + 3864292196) % {_WORD}) as h from blocks),
h1 as (select word, xor(xor(h, tail), n::ubigint) as h from body),
h2 as (select word, xor(h, h // 65536) * 2246822507 % {_WORD} as h from h1),
h3 as (select word, xor(h, h // 8192) * 3266489909 % {_WORD} as h from h2),
buckets as (select word, (xor(h, h // 65536) % 262144)::int as bucket from h3),
entries as materialized (select doc_id, bucket, count(*)::double as weight from words join buckets using (word) group by doc_id, bucket)"""


def _gradient_steps(steps: int, rate: float, reg: float) -> str:
    """Steps on hashed terms of the training texts, then probabilities of the others."""
    parts = [f"""
labelled as materialized (select doc_id, quality::double as y, {TRAINING.replace('review_id', 'doc_id')} as training from labels join documents using (doc_id)),
train as materialized (select e.* from entries e join labelled using (doc_id) where training),
size as (select count(*)::double as n from labelled where training),
spread as materialized (
  select bucket, (sum(weight * weight) - sum(weight) * sum(weight) / any_value(n)) / (any_value(n) - 1) as v from train, size group by bucket),
c0 as (select bucket, v, 0.0::double as w from spread where v > 0), b0 as (select 0.0::double as b)"""]
    for i in range(steps):
        parts.append(f"""
r{i} as materialized (
  select doc_id, 1 / (1 + exp(-(b + coalesce(m, 0)))) - y as r
  from labelled left join (select doc_id, sum(w * weight) as m from train join c{i} using (bucket) group by doc_id) using (doc_id), b{i} where training),
g{i} as (select bucket, sum(r * weight) / any_value(n) as g from train join r{i} using (doc_id), size group by bucket),
c{i + 1} as materialized (select bucket, v, w - {rate} * (g + {reg} * v * w) / v as w from c{i} join g{i} using (bucket)),
b{i + 1} as materialized (select b - {rate} * r as b from b{i}, (select avg(r) as r from r{i}))""")
    return f"""{HASHED_SQL}, {', '.join(parts)}
select doc_id, y as "trueLabel", round(1 / (1 + exp(-(b + coalesce(m, 0)))), 6) as probability
from labelled left join (select doc_id, sum(w * weight) as m from entries join c{steps} using (bucket) group by doc_id) using (doc_id), b{steps}
where not training"""


HEAVY_SQL = f"""
select review_id, case when review_id % 3 = 0 then 0 else user_id end as user_id, business_id,
       case when stars > 2 then 1.0::double else 0.0::double end as label from ({RATINGS_SQL})"""


def _start_factors(rank: int, seed: int = 42) -> str:
    digits = [f"('0x' || substr(md5(id::varchar || ':{i}:{seed}'), 1, 8))::bigint / 4294967296.0::double as f_{i}" for i in range(rank)]
    return f"select id, {', '.join(digits)} from (select distinct user_id as id from rated)"


def _half_step(solve_for: str, known: str, factors: str, rank: int, reg: float) -> str:
    """One side's factors by Gaussian elimination on the augmented normal equations, one column a sub-query."""
    def cell(i: int, j: int) -> str:
        return f"a_{i}_{j}"

    cells = [f"sum(f_{i} * f_{j}) + {reg if i == j else 0} * count(*) as {cell(i, j)}" for i in range(rank) for j in range(rank)]
    cells += [f"sum(f_{i} * label) as {cell(i, rank)}" for i in range(rank)]
    step = f"select {solve_for} as id, {', '.join(cells)} from rated join {factors} k on k.id = {known} group by {solve_for}"
    for p in range(rank):
        row = {j: f"{cell(p, j)} / {cell(p, p)}" for j in range(rank + 1)}
        cells = [
            f"{row[j]} as {cell(p, j)}" if i == p else f"{cell(i, j)} - {cell(i, p)} * ({row[j]}) as {cell(i, j)}"
            for i in range(rank) for j in range(rank + 1)
        ]
        step = f"select id, {', '.join(cells)} from ({step})"
    return f"select id, {', '.join(f'{cell(i, rank)} as f_{i}' for i in range(rank))} from ({step})"


def _factors(rows: str, rank: int = 3, iterations: int = 2, reg: float = 0.1) -> str:
    """CTEs up to ``users`` and ``items``, the factors of both sides."""
    parts = [f"rated as materialized ({rows})", f"u0 as materialized ({_start_factors(rank)})"]
    for i in range(iterations):
        parts.append(f"i{i + 1} as materialized ({_half_step('business_id', 'user_id', f'u{i}', rank, reg)})")
        parts.append(f"u{i + 1} as materialized ({_half_step('user_id', 'business_id', f'i{i + 1}', rank, reg)})")
    return f"with {', '.join(parts)}, users as (select * from u{iterations}), items as (select * from i{iterations})"


_PRODUCT = "u.f_0 * i.f_0 + u.f_1 * i.f_1 + u.f_2 * i.f_2"
_SHOWN = ", ".join(f"round(f_{i}, 6) as f_{i}" for i in range(3))

FOLD_GAINS = [0.0, 0.005, 0.02]
FOLD_FEATURES = {
    "n_chars": "length(text)", "n_commas": "length(text) - length(replace(text, ',', ''))",
    "n_periods": "length(text) - length(replace(text, '.', ''))",
    "n_capitals": "length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))",
}


def _fold_trees(bins: list[int], depths: list[int], gains: list[float], folds: int = 5) -> str:
    """The whole search level by level: every row carries its node in every tree."""
    names = list(FOLD_FEATURES)
    gini = "2.0::double * ({p}::double / {n}) * (1.0::double - {p}::double / {n})".format
    gain = (f"{gini(p='positive', n='n')} - n_left::double / n * ({gini(p='positive_left', n='n_left')}) - "
            f"(n - n_left)::double / n * ({gini(p='(positive - positive_left)', n='(n - n_left)')})")
    parts = [f"""
base as materialized (
  select row_number() over () as rid, coalesce(('0x' || substr(md5(doc_id::varchar), 1, 4))::bigint % {folds}, 0)::int as fold,
         label::int as label, {', '.join(f'({e})::double as {c}' for c, e in FOLD_FEATURES.items())}
  from ({LABELLED_SQL}) where label is not null),
vals as materialized ({' union all '.join(f'select rid, {i} as feature, {c} as value from base' for i, c in enumerate(names))}),
sizes as (select unnest({bins}) as b),
upto as (
  select *, sum(n) over (partition by feature order by value) as upto, sum(n) over (partition by feature) as total
  from (select feature, value, count(*) as n from vals where value is not null group by all)),
cuts as (select b, feature, value as cut from upto, sizes where upto < total and (upto - n) * b // total < upto * b // total),
binned as materialized (
  select b, rid, feature, coalesce(sum((cut < value)::int), 0)::int as bin
  from (select * from vals, sizes) left join cuts using (b, feature) group by all),
r0 as materialized (
  select b, left_out, rid, fold, label, 1 as node, 9000000000 as least_gain, true as open
  from base, sizes, (select unnest(range(-1, {folds}))::int as left_out))"""]
    for level in range(max(depths)):
        parts.append(f"""
s{level} as (
  select b, left_out, node, feature, bin, count(*) as n, sum(label) as positive
  from r{level} join binned using (b, rid) where open and fold <> left_out group by all),
g{level} as (
  select *, case when n_left < n then floor(({gain}) * 1e9::double) else 0 end::bigint as gain
  from (select b, left_out, node, feature, bin as last,
               sum(n) over (partition by b, left_out, node, feature order by bin) as n_left,
               sum(positive) over (partition by b, left_out, node, feature order by bin) as positive_left,
               sum(n) over (partition by b, left_out, node, feature) as n,
               sum(positive) over (partition by b, left_out, node, feature) as positive from s{level})),
c{level} as materialized (
  select * from g{level} qualify row_number() over (partition by b, left_out, node order by gain desc, feature, last) = 1),
r{level + 1} as materialized (
  select r.b, r.left_out, r.rid, r.fold, r.label, case when open and gain > 0 then 2 * r.node + (bin > last)::int else r.node end as node,
         case when open and gain > 0 then least(least_gain, gain) else least_gain end as least_gain, open and coalesce(gain > 0, false) as open
  from r{level} r left join c{level} c using (b, left_out, node)
  left join binned x on x.b = r.b and x.rid = r.rid and x.feature = c.feature)""")
    levels = range(max(depths) + 1)
    parts.append(f"""
nodes as (
  select b, left_out, node, any_value(n) as n, any_value(positive) as positive from (
  {' union all '.join(f'select b, left_out, node, count(*) as n, sum(label) as positive from r{i} where fold <> left_out group by all' for i in levels)})
  group by all),
held as (
  select b, max_depth, min_gain, left_out, rid, label, arg_max(node, level) as node
  from ({' union all '.join(f'select *, {i} as level from r{i} where fold = left_out' for i in levels)}),
       (select unnest({depths}) as max_depth), (select unnest({gains})::double as min_gain)
  where level <= max_depth and least_gain >= min_gain * 1e9::double group by all),
hits as (
  select h.b, max_depth, min_gain, h.left_out as fold, label = 1 as is_one, 2 * positive > n as says_one
  from held h join nodes using (b, left_out, node)),
told as (
  select b as max_bins, max_depth, min_gain, fold, count(*) filter (is_one and says_one) as tp,
         count(*) filter (not is_one and says_one) as fp, count(*) filter (not is_one and not says_one) as tn,
         count(*) filter (is_one and not says_one) as fn from hits group by all)""")
    return "with" + ",".join(parts) + """
select *, round(((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + (tn + fp) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0))
                / (tp + fp + tn + fn), 9) as f1 from told"""


TOP_WORDS_SQL = f"""
select * from (select *, (row_number() over (partition by stars order by n desc, word))::int as rank
               from ({WORD_FREQ_SQL})) where rank <= 25"""
ORACLE_SQL = {
    "scan_csv_reviews": CLEAN_ROWS_SQL,
    "scan_csv_split": CLEAN_ROWS_SQL,
    "scan_csv_infer": PLAIN_RATINGS_SQL,
    "scan_table_sql": PLAIN_RATINGS_SQL,
    "schema_enforced_scan": f"""
select user_id, md5(text) as text, {DATE} as date, review_id, business_id, funny, cool, useful, stars,
       length(text)::int as n_chars from ({REVIEWS_SQL})""",
    "sink_csv_roundtrip": f"""
select {', '.join(_scale(c, 6) for c in ID_COLUMNS)}, funny, cool, useful, stars from ({RATINGS_SQL})""",
    "sink_parquet_roundtrip": CLEAN_ROWS_SQL,
    "project_columns": f"select user_id, business_id, stars from ({RATINGS_SQL})",
    "label_binarize": f"""
select user_id, review_id, business_id, case when stars > 2 then 1.0::double else 0.0::double end as label
from ({RATINGS_SQL})""",
    "filter_by_rating": f"""
select stars, count(*) as n_reviews, sum(funny)::bigint as sum_funny, sum(cool)::bigint as sum_cool,
       sum(useful)::bigint as sum_useful from ({RATINGS_SQL}) where stars in (1, 2, 3, 4, 5) group by 1""",
    "filter_conjunction": f"""select * from ({SCORED_SQL}) where prediction = 1 and "trueLabel" = 1""",
    "filter_nan": f"""
select doc_id, round(prediction, 6) as prediction from ({GAPPY_SQL})
where prediction is not null and not isnan(prediction)""",
    "dropna_any": """
select d.doc_id, lang, n_chars, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id
where lang is not null and n_chars is not null and quality is not null and toxic is not null""",
    "join_predictions_source": f"""
select review_id, case when useful > 4 then 1.0::double else 0.0::double end as prediction, user_id,
       business_id, stars, md5(text) as text, length(text)::int as n_chars from ({REVIEWS_SQL})""",
    "encode_ids_by_load": LOADS_SQL,
    "encode_ids": ENCODED_SQL,
    "split_sizes": f"""
select case when {TRAINING} then 'train' else 'test' end as split, count(*) as n_rows
from ({RATINGS_SQL}) group by 1""",
    "distinct_keys": f"""
select count(distinct user_id) as n_user_id, count(distinct business_id) as n_business_id,
       count(distinct review_id) as n_review_id from ({RATINGS_SQL})""",
    "distinct_values": f"select distinct business_id from ({RATINGS_SQL})",
    "dt_grid_folds": _fold_trees(TREE_GRID["maxBins"], TREE_GRID["maxDepth"], FOLD_GAINS),
    "word_freq_by_rating": WORD_FREQ_SQL,
    "top_words_by_rating": TOP_WORDS_SQL,
    "heavy_words_by_rating": TOP_WORDS_SQL,
    "crosstab_day_stars": _crosstab("dayname(date) as day", RATINGS_SQL),
    "crosstab_month_stars": _crosstab(
        "monthname(date) as month",
        "select o_orderdate as date, substr(o_orderpriority, 1, 1)::int as stars from orders"),
    "box_stats": f"""
with measured as (
  select 'funny' as measure, stars, funny::double as y from ({RATINGS_SQL})
  union all select 'cool', stars, cool from ({RATINGS_SQL})
  union all select 'useful', stars, useful from ({RATINGS_SQL})
  union all select 'value', stars, value from ({RATINGS_SQL})), {BOXES_SQL}
select measure, stars, n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
       round(least(low, q1), 6) as whisker_low, round(greatest(high, q3), 6) as whisker_high, n_outliers
from quartiles join whiskers using (measure, stars)""",
    "box_outliers": """
with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
           from events group by 1)
select event_id, event_type, value from events join q using (event_type)
where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)""",
    "scatter_counts": " union all ".join(
        f"select '{x} x {y}' as cloud, {x} as x, {y} as y, stars, count(*) as n from ({RATINGS_SQL}) group by 1, 2, 3, 4"
        for x, y in [("cool", "cool"), ("cool", "funny"), ("cool", "useful"), ("useful", "funny")]),
    "head_slice": f"select * from ({PLAIN_RATINGS_SQL}) order by review_id limit 2500",
    "scaled_subset": f"""
select row_id, {', '.join(_scale(c, 9) for c in ID_COLUMNS)}, stars from ({ENCODED_SQL})
order by row_id limit 800""",
    "prepare_tables": f"""
with working as (
  select md5(user_id::varchar) as user_id, md5(business_id::varchar) as business_id,
         md5(review_id::varchar) as review_id, {DATE} as date, text, stars
  from ({REVIEWS_SQL})),
codes as (
  select {', '.join(f'dense_rank() over (order by {c}) - 1 as {c}' for c in ID_COLUMNS)}, date, text, stars
  from working),
scaled as (select {', '.join(_scale(c, 9) for c in ID_COLUMNS)}, date, text, stars from codes)
select user_id, business_id, review_id, date, stars, md5(text) as text, length(text)::int as n_chars
from scaled""",
    "clean_byte_prefix": f"""
select regexp_replace(user_id, '^b([''"])', '\\1') as user_id, review_id, md5(body) as text, length(body)::int as n_chars
from (select user_id, review_id, regexp_replace(
        case when review_id < 'b''8' then text else substr(text, 3) end, '^b([''"])', '\\1') as body
      from ({_raw(['user_id', 'review_id', 'text'])}))""",
    "clean_quotes": f"""
select doc_id, md5(body) as text, length(body)::int as n_chars
from (select doc_id, {_strip("('''\"' || text || '\"''''')")} as body from documents)""",
    "strip_punctuation": f"select doc_id, translate(text, {_quote(PUNCTUATION)}, '') as text from documents",
    "weekday_name": f"select review_id, dayname(date) as day from ({RATINGS_SQL})",
    "month_name": "select o_orderkey, monthname(o_orderdate) as month from orders",
    "round_abs": "select event_id, abs(round((value - 20) / 8.0::double)) as prediction from events",
    "minmax_ids": f"""
select review_id as row_id, {', '.join(_scale(c, 9) for c in ID_COLUMNS)} from ({RATINGS_SQL})""",
    "word_tokens": _token_query(_tokens("text")),
    "abbreviation_scores": f"{ABBREVIATIONS_SQL} select word, n_dot, n_plain, round(ratio, 6) as ratio, round(score, 6) as score from scores",
    "sentence_tokens": SENTENCES_SQL,
    "tokens_no_stopwords": _token_query(_kept(_tokens("text"))),
    "tokens_clean": _token_query(CLEAN_TOKENS),
    "bigrams": f"""
select doc_id, place - 1 as place, t[place] as w1, t[place + 1] as w2
from (select doc_id, t, unnest(range(1, len(t))) as place
      from (select doc_id, {CLEAN_TOKENS} as t from documents))""",
    "ml_tokenize": _token_query(ML_TOKENS),
    "ml_stopwords": _token_query(ML_KEPT, "kept"),
    "ml_hashing_tf": f"{HASHED_SQL} select doc_id, bucket, weight from entries",
    "hash_split": f"""
select review_id, case when {TRAINING} then 'train' else 'test' end as split from ({RATINGS_SQL})""",
    "assemble_features": f"""
select review_id, user_id::double as feature_0, review_id::double as feature_1, business_id::double as feature_2,
       case when stars > 2 then 1.0::double else 0.0::double end as label from ({RATINGS_SQL})""",
    "confusion_counts": _confusion("select * from c"),
    "precision_recall": _confusion(
        'select round(tp::double / (tp + fp), 9) as "precision", round(tp::double / (tp + fn), 9) as recall from c'),
    "f1_weighted": _confusion("""
select round(((tp + fn) * 2.0::double * tp / (2 * tp + fp + fn) + (tn + fp) * 2.0::double * tn / (2 * tn + fp + fn))
             / (tp + fp + tn + fn), 9) as f1_weighted from c"""),
    "auc_hard": _confusion(
        "select round((tp::double / (tp + fn) + tn::double / (tn + fp)) / 2, 9) as auc_hard from c"),
    "metrics_table": _confusion("""
select 'TP' as metric, tp::double as value from c union all select 'FP', fp from c
union all select 'TN', tn from c union all select 'FN', fn from c
union all select 'Precision', round(tp::double / (tp + fp), 9) from c
union all select 'Recall', round(tp::double / (tp + fn), 9) from c"""),
    "rmse": f"""
select round(sqrt(avg((n_chars / 3000.0::double - "trueLabel") * (n_chars / 3000.0::double - "trueLabel"))), 9) as rmse
from ({SCORED_SQL})""",
    "random_split": f"select review_id, 1::bigint as n_parts, true as share_expected from ({RATINGS_SQL})",
    "lr_sentiment": _judged(TEXT_TEST),
    "lr_gradient_steps": _gradient_steps(3, 0.01, 0.01),
    **{name: _judged(ID_TEST) for name in ("dt_classify", "gbt_classify", "rf_binary")},
    "dt_stump": STUMP_SQL,
    "rf_multiclass": f"""
select stars::double as "trueLabel", count(*) as n_rows, count(*) as n_predicted
from ({RATINGS_SQL}) where not {TRAINING} group by 1""",
    "als_recommend": COVERAGE_SQL,
    "als_top_items": f"""
select user_id, least(5, (select count(distinct business_id) from ({RATINGS_SQL})))::bigint as n_items, 1 as first_rank,
       least(5, (select count(distinct business_id) from ({RATINGS_SQL})))::int as last_rank
from ({RATINGS_SQL}) group by user_id""",
    "als_factors": f"""
{_factors(HEAVY_SQL)}
select 'user' as side, id, {_SHOWN} from users union all select 'business', id, {_SHOWN} from items""",
    "als_scores": f"""
{_factors(f"select * from ({HEAVY_SQL}) where {TRAINING}")}
select t.review_id, t.label as "trueLabel", round({_PRODUCT}, 6) as prediction
from ({HEAVY_SQL}) t left join users u on u.id = t.user_id left join items i on i.id = t.business_id where not {TRAINING.replace('review_id', 't.review_id')}""",
    "als_best_items": f"""
{_factors(HEAVY_SQL)}
select user_id, business_id, rank::int as rank, round(score, 6) as score from (
  select *, row_number() over (partition by user_id order by score desc, business_id) as rank
  from (select u.id as user_id, i.id as business_id, {_PRODUCT} as score from users u, items i)) where rank <= 5""",
    "als_tuned": _grid(ALS_GRID, SCORED_COUNTS),
    "als_tuned_cv": _grid(ALS_GRID, SCORED_COUNTS),
    "dt_tuned_tvs": _grid(TREE_GRID, _judged(ID_TEST)),
    "dt_tuned_cv": _grid(TREE_GRID, _judged(ID_TEST)),
    "gbt_tuned_tvs": _grid(BOOSTED_GRID, _judged(ID_TEST)),
}
