"""Secret scans over a trigram inverted index.

Each rule's regex is turned into a Boolean query of trigrams that every match
must hold: an AND of parts, each an OR of literals, each an AND of trigrams.
Only trigrams that some rule asks for are indexed. The posting table (trigram,
key) is written once to the shared folder; the postings of a literal are
intersected per document, and a rule's regex runs on its candidate texts only.
Rules without a mandatory trigram (long hex runs) scan every text.

Edge cases: a NULL text is an empty text; repeated rows and equal keys are
scanned row by row (postings of equal keys are united, which can only add
candidates); a NULL key is a key like any other; an empty table gives no rows.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.session import materialize

MAX_LITERALS = 64       # alternatives kept for one part of a query; beyond, the part is dropped
TRIGRAMS_PER_LITERAL = 60


@dataclass(frozen=True)
class Rule:
    """A kind of secret: every leftmost match counts whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int
    least: int
    any_case: bool = False

    @property
    def regex(self) -> str:
        return f"(?i:{self.pattern})" if self.any_case else self.pattern


# The three kinds every result counts.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published forms of other credentials.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE_RULES + MORE_RULES

Query = list[list[frozenset[str]]]


def trigram_query(pattern: str) -> Query:
    """AND of parts, OR of literals, AND of lower-case trigrams; an empty list admits every text."""
    parts: Query = []
    _close(_strings(rp.parse(pattern), parts), parts)
    return parts


def _strings(items, parts: Query) -> set[str]:
    """Literals that may stand at the end of what was read; finished parts go to ``parts``."""
    open_ = {""}
    for op, arg in items:
        options = _options(op, arg)
        if options is None or len(open_) * len(options) > MAX_LITERALS:
            _close(open_, parts)
            if op is rc.SUBPATTERN:
                _close(_strings(arg[3], parts), parts)
            elif op is rc.MAX_REPEAT and arg[0] > 0:
                _close(_strings(arg[2], parts), parts)
            open_ = {""}
        else:
            open_ = {a + b for a in open_ for b in options}
    return open_


def _options(op, arg) -> set[str] | None:
    """All texts of one item of a regex, or None when there are too many to list."""
    if op is rc.LITERAL:
        return {chr(arg).lower()}
    if op is rc.IN:
        found = set()
        for kind, value in arg:
            if kind is rc.LITERAL:
                found.add(chr(value).lower())
            elif kind is rc.RANGE and value[1] - value[0] < 8:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is rc.SUBPATTERN:
        return _sequence(arg[3])
    if op is rc.BRANCH:
        each = [_sequence(branch) for branch in arg[1]]
        return None if any(e is None for e in each) else set().union(*each)
    if op is rc.MAX_REPEAT and arg[:2] == (0, 1):
        inner = _sequence(arg[2])
        return None if inner is None else inner | {""}
    if op is rc.AT:
        return {""}
    return None


def _sequence(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        options = _options(op, arg)
        if options is None or len(out) * len(options) > MAX_LITERALS:
            return None
        out = {a + b for a in out for b in options}
    return out


def _close(literals: set[str], parts: Query) -> None:
    if all(len(x) >= 3 for x in literals):
        sets = {frozenset([x[i:i + 3] for i in range(len(x) - 2)][:TRIGRAMS_PER_LITERAL]) for x in literals}
        parts.append(sorted((s for s in sets if not any(t < s for t in sets)), key=sorted))


def trigram_postings(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Inverted index over ``trigrams``: one row (trigram, key) for each text that holds it, letters lower-cased."""
    low = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("low")).where("low is not null")
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    return low.select("key", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """Per key the kinds whose Boolean query its postings satisfy.

    The terms table is as small as the rules are. Bits of a literal's trigrams
    are united before the shuffle, so a trigram that every document holds adds
    no more than one row per document and literal.
    """
    terms = [
        (kind, p, l, trigram, 1 << bit, (1 << len(literal)) - 1)
        for kind, query in queries.items() for p, part in enumerate(query)
        for l, literal in enumerate(part) for bit, trigram in enumerate(sorted(literal))
    ]
    parts = [(kind, len(query)) for kind, query in queries.items()]
    spark = postings.sparkSession
    term = spark.createDataFrame(terms, "kind string, part int, literal int, trigram string, bit bigint, full bigint")
    need = spark.createDataFrame(parts, "kind string, n_parts int")
    literals = (
        postings.join(F.broadcast(term), "trigram")
        .groupBy("key", "kind", "part", "literal").agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"))
        .where("bits = full")
    )
    return (
        literals.groupBy("key", "kind").agg(F.count_distinct("part").alias("n"))
        .join(F.broadcast(need), "kind").where("n = n_parts")
        .groupBy("key").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))
    )


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind), in code points, of the rule's leftmost matches.

    Each step of the search takes what lies before a match, too, so lengths add
    up to positions; \\G ties a step to the end of the last one.
    """
    search = F.lit(rf"(?s)\G(.*?)({rule.regex})")

    def lengths(group: int) -> Column:
        return F.transform(F.regexp_extract_all(text, search, F.lit(group)), F.length)

    steps = F.arrays_zip(lengths(1).alias("before"), lengths(2).alias("whole"), lengths(rule.group + 2).alias("value"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def advance(state: Column, step: Column) -> Column:
        start = state["at"] + step["before"]
        end = start + step["whole"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        kept = F.when(step["value"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(steps, start, advance, lambda state: state["spans"])


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (key, text, spans) with all verified spans by start, then rule order."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if indexed:
        vocabulary = sorted({t for q in indexed.values() for part in q for literal in part for t in literal})
        index = materialize(trigram_postings(docs, vocabulary, key, text).sortWithinPartitions("trigram"), "trigram-index")
        found = candidates(index, indexed).withColumnRenamed("key", "found_key")
        rows = rows.join(found, F.col("key").eqNullSafe(F.col("found_key")), "left").drop("found_key")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    each = []
    for order, rule in enumerate(rules):
        if rule.kind in indexed:
            due = F.array_contains("kinds", rule.kind)
        else:
            due = F.col("text").rlike(_quick(rule))
        each.append(F.when(due, rule_spans(F.col("text"), rule, order)).otherwise(none))
    return rows.select(F.col("key").alias(key), "text", F.array_sort(F.concat(*each)).alias("spans"))


def _quick(rule: Rule) -> str:
    """A test for a full scan: a lone repeated class must reach the least length, else the rule itself."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1 and rule.pattern.startswith("["):
        return f"{rule.regex[:-1]}{{{rule.least}}}"
    return rule.regex


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
