"""Language identification by interpolated Kneser-Ney character models.

Letters are lower-cased, everything else becomes one blank. For each language a
model of order ``ORDER`` is learned from every labelled text; n-grams are counted
by Spark, and only the table of distinct n-grams, which grows with the languages and
not with the rows, reaches the driver. The models of all languages share one sorted
array of n-gram hashes per order, with a matrix of log probabilities beside it, so
one binary search per character serves all of them. The language of the lowest
cross-entropy per character wins.

Rejection is calibrated on every labelled text too: a hash of the key deals them into
two halves, and each half is scored by models of the other. A text is rejected when
its cross-entropy lies beyond its language's median by a margin plus twice the widest
deviation (that of all but ``BEYOND_WIDEST`` of the texts), scaled to the text's length.

Edge cases: a NULL text or one without letters is ``und`` with score 0 and is
rejected; so is every text when nothing was learned. Labels that are NULL are not
learned from. Ties go to the language first in code point order. Repeated rows
are scored alike; all columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.llm.common import text_parts, unit_hash
from reviewscope.session import materialize

ORDER = 4
MARGIN = 1.0              # nats per character
SLACK = 2.0
BEYOND_WIDEST = 0.001     # share of the texts whose deviations are left out of the widest
STEP = 1e-4               # nats to which entropies and deviations are rounded before their quantiles
SHARPNESS = 20.0          # of the score, per nat
ALPHABET = 65_536         # for characters never seen
CHUNK_BYTES = 1 << 18
COUNTED_BYTES = 1 << 20
UNKNOWN = "und"
RESULT = "struct<lang:string,score:double,entropy:double,n_letters:bigint,rejected:boolean>"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = 32


@cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter, or blank."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def letter_stream(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(padded characters, places to score, number of them per text).

    Each text is preceded by ORDER - 1 blanks; runs of blanks are one blank.
    """
    chars = _letters()[codes]
    blank = chars == _BLANK
    first = np.zeros(len(chars) + 1, bool)
    first[starts[:-1]] = True
    after_blank = np.concatenate([[True], blank[:-1]]) | first[:-1]
    keep = ~(blank & after_blank) if len(chars) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(keep)])[starts]
    lengths = np.diff(ends)
    pad = ORDER - 1
    places = np.arange(int(ends[-1])) + pad * (np.repeat(np.arange(len(lengths)), lengths) + 1)
    padded = np.full(int(ends[-1]) + pad * len(lengths), _BLANK, np.uint32)
    padded[places] = chars[keep]
    return padded, places, lengths


def gram_hashes(padded: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place."""
    out = np.zeros(len(places), np.uint64)
    for back in range(order - 1, -1, -1):
        out = out * _BASE + padded[places - back]
    return out


class KneserNey:
    """Interpolated model of one language from counts of its ORDER-grams."""

    def __init__(self, counts: dict[str, int]):
        self.counts = {ORDER: counts}
        for order in range(ORDER - 1, 0, -1):
            self.counts[order] = Counter(gram[1:] for gram in self.counts[order + 1])
        self.discount, self.total, self.types = {}, {}, {}
        for order, grams in self.counts.items():
            once = sum(c == 1 for c in grams.values())
            twice = sum(c == 2 for c in grams.values())
            self.discount[order] = once / (once + 2 * twice) if once and twice else 0.5
            total, types = defaultdict(int), defaultdict(int)
            for gram, count in grams.items():
                total[gram[:-1]] += count
                types[gram[:-1]] += 1
            self.total[order], self.types[order] = total, types

    def backoff(self, context: str) -> float:
        """Weight of the lower order after ``context``."""
        order = len(context) + 1
        total = self.total[order].get(context, 0)
        return self.discount[order] * self.types[order][context] / total if total else 1.0

    def probability(self, gram: str) -> float:
        below = self.probability(gram[1:]) if len(gram) > 1 else 1.0 / ALPHABET
        order, context = len(gram), gram[:-1]
        total = self.total[order].get(context, 0)
        if not total:
            return below
        seen = max(self.counts[order].get(gram, 0) - self.discount[order], 0.0)
        return seen / total + self.backoff(context) * below


@dataclass
class LanguageModels:
    """All languages: sorted n-gram hashes and log probabilities per order, sorted contexts and log back-off weights."""

    languages: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    means: np.ndarray | None = None
    widest: float = 0.0

    @classmethod
    def fit(cls, counts: dict[str, dict[str, int]]) -> LanguageModels:
        rows = [(lang, gram, n) for lang, grams in counts.items() for gram, n in grams.items()]
        return cls.of_counts(*([r[i] for r in rows] for i in range(3)))

    @classmethod
    def of_counts(cls, langs: Sequence[str], texts: Sequence[str], counts: Sequence[int]) -> LanguageModels:
        """What ``KneserNey`` says of each language, for all at once, from (language, ORDER-gram, count) in columns."""
        languages, column = np.unique(np.array(langs, object).astype(str), return_inverse=True)
        if not len(languages):
            return cls([], {}, {})
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
        hashes, first, row = np.unique(_row_hashes(chars), return_index=True, return_inverse=True)
        known = chars[first]
        seen = np.zeros((len(hashes), len(languages)))
        np.add.at(seen, (row, column), np.asarray(counts, np.float64))
        grams, contexts, levels = {}, {}, []
        for order in range(ORDER, 0, -1):
            heads, head = np.unique(_row_hashes(known[:, :-1]), return_inverse=True)
            tails, first, tail = np.unique(_row_hashes(known[:, 1:]), return_index=True, return_inverse=True)
            once, twice = (seen == 1).sum(0), (seen == 2).sum(0)
            discount = np.where((once > 0) & (twice > 0), once / np.maximum(once + 2 * twice, 1), 0.5)
            total, types = _summed(seen, head, len(heads)), _summed(seen > 0, head, len(heads))
            backoff = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
            contexts[order] = heads, np.log(backoff).astype(np.float32)
            own = np.where(total[head] > 0, np.maximum(seen - discount, 0) / np.maximum(total[head], 1), 0.0)
            levels.append((order, hashes, own, backoff[head], tail))
            known, hashes, seen = known[first, 1:], tails, _summed(seen > 0, tail, len(tails))
        below = np.full((1, len(languages)), 1.0 / ALPHABET)
        for order, hashes, own, weight, tail in reversed(levels):
            below = own + weight * below[tail]
            grams[order] = hashes, np.log(below).astype(np.float32)
        return cls(languages.tolist(), grams, contexts)

    def log_probabilities(self, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Row per place, column per language."""
        out = np.zeros((len(places), len(self.languages)), np.float32)
        open_ = np.arange(len(places))
        for order in range(ORDER, 0, -1):
            at, found = _find(self.grams[order][0], gram_hashes(padded, places[open_], order))
            out[open_[found]] += self.grams[order][1][at[found]]
            open_ = open_[~found]
            if not len(open_):
                return out
            before = gram_hashes(padded, places[open_] - 1, order - 1)
            at, found = _find(self.contexts[order][0], before)
            out[open_[found]] += self.contexts[order][1][at[found]]
        out[open_] -= np.float32(math.log(ALPHABET))
        return out

    def entropies(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character for each text and language, and characters per text."""
        padded, places, lengths = letter_stream(codes, starts)
        sums = np.zeros((len(lengths), len(self.languages)))
        some = lengths > 0
        if some.any():
            first = np.concatenate([[0], np.cumsum(lengths)])[:-1][some]
            sums[some] = np.add.reduceat(self.log_probabilities(padded, places), first, axis=0, dtype=np.float64)
        return -sums / np.maximum(lengths, 1)[:, None], lengths

    def limits(self, best: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(best), np.inf)
        return self.means[best] + MARGIN + SLACK * self.widest / np.sqrt(np.maximum(lengths, 1))


def _row_hashes(chars: np.ndarray) -> np.ndarray:
    """``gram_hashes`` of grams that are rows of code points."""
    out = np.zeros(len(chars), np.uint64)
    for char in chars.T:
        out = out * _BASE + char
    return out


def _summed(values: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Columns of ``values`` added up by ``place``."""
    return np.stack([np.bincount(place, weights=v, minlength=n) for v in values.T], 1)


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        names, half = langs.dictionary.to_pylist(), batch.column(2).to_numpy()
        group = 2 * langs.indices.to_numpy().astype(np.int64) + half
        row = 0
        for codes, starts in text_parts(batch.column(1), COUNTED_BYTES):
            padded, places, lengths = letter_stream(codes, starts)
            owner = np.repeat(group[row:row + len(lengths)], lengths)
            row += len(lengths)
            for g in np.unique(owner).tolist():
                mine = places[owner == g]
                _, first, n = np.unique(gram_hashes(padded, mine, ORDER), return_index=True, return_counts=True)
                chars = padded[mine[first][:, None] + np.arange(1 - ORDER, 1)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[g // 2]] * len(n), pa.string()), pa.array(np.full(len(n), g % 2, np.int32)),
                    pa.array(np.ascontiguousarray(chars).view(f"<U{ORDER}")[:, 0], pa.string()), pa.array(n.astype(np.int64)),
                ], ["lang", "half", "gram", "n"])


def fit_languages(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModels:
    """Models and their rejection limits from all labelled rows."""
    rows = labelled.where(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        (unit_hash(key, seed="language-half") < 0.5).cast("int").alias("half"),
    )
    counted = rows.mapInArrow(_count_grams, "lang string, half int, gram string, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("half") == 1, F.col("n")).otherwise(0)).alias("n_1")).toArrow()
    langs, grams = (counted.column(c).to_pylist() for c in ("lang", "gram"))
    n, n_1 = (counted.column(c).to_numpy() for c in ("n", "n_1"))
    models = LanguageModels.of_counts(langs, grams, n)
    if not models.languages:
        return models

    def of_half(counts: np.ndarray) -> LanguageModels:
        some = np.flatnonzero(counts).tolist()
        return LanguageModels.of_counts([langs[i] for i in some], [grams[i] for i in some], counts[some])

    # Each half is scored by the other's models, where those know its language.
    halves = [of_half(n_1), of_half(n - n_1)]
    scored = [_entropies(rows.where((F.col("half") == i) & F.col("lang").isin(m.languages)), m) for i, m in enumerate(halves) if m.languages]
    found = materialize(reduce(DataFrame.unionByName, scored), "entropies")
    _calibrate(models, found if not found.isEmpty() else _entropies(rows, models))
    return models


def _entropies(rows: DataFrame, models: LanguageModels) -> DataFrame:
    return identify(rows.select("text"), models).where("entropy is not null").select("lang_pred", "entropy", "n_letters")


def _quantile(rows: DataFrame, value: Column, share: float, *groups: str) -> DataFrame:
    """Exact quantile of the values rounded to STEP, from their counts."""
    counts = rows.groupBy(*groups, F.round(value / STEP).alias("step")).agg(F.count("*").alias("n"))
    return counts.groupBy(*groups).agg((F.percentile("step", share, F.col("n")) * STEP).alias("quantile"))


def _calibrate(models: LanguageModels, scored: DataFrame) -> None:
    every = _quantile(scored, F.col("entropy"), 0.5).first()
    if every is None or every[0] is None:
        return
    medians = {r["lang_pred"]: r["quantile"] for r in _quantile(scored, F.col("entropy"), 0.5, "lang_pred").collect()}
    models.means = np.array([medians.get(x, every[0]) for x in models.languages])
    mean = F.create_map(*[F.lit(v) for pair in medians.items() for v in pair])[F.col("lang_pred")]
    deviation = (F.col("entropy") - mean) * F.sqrt("n_letters")
    models.widest = max(0.0, _quantile(scored, deviation, 1 - BEYOND_WIDEST).first()[0])


def identify(docs: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (0 to 1), entropy (nats per character), n_letters and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf(RESULT)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            yield _scored(known, batch)

    # Spark moves a filter on a deterministic result below it and so scores every text twice, in two workers.
    out = docs.withColumn("_found", score.asNondeterministic()(F.col(text)))
    return out.withColumns({
        "lang_pred": F.col("_found.lang"), "score": F.col("_found.score"), "entropy": F.col("_found.entropy"),
        "n_letters": F.col("_found.n_letters"), "rejected": F.col("_found.rejected"),
    }).drop("_found")


def _scored(models: LanguageModels, texts: pa.Array) -> pa.Array:
    langs, scores, entropy, letters, rejected = [], [], [], [], []
    for codes, starts in text_parts(texts, CHUNK_BYTES):
        if models.languages:
            each, lengths = models.entropies(codes, starts)
            best = each.argmin(1)
            low = each[np.arange(len(best)), best]
            score = 1.0 / np.exp(-SHARPNESS * (each - low[:, None])).sum(1)
            none = (lengths == 0)
            beyond = none | (low > models.limits(best, lengths))
            langs += [UNKNOWN if z else models.languages[b] for z, b in zip(none, best)]
            scores += np.where(none, 0.0, score).tolist()
            entropy += [None if z else float(x) for z, x in zip(none, low)]
            letters += lengths.tolist()
            rejected += beyond.tolist()
        else:
            n = len(starts) - 1
            langs, scores = langs + [UNKNOWN] * n, scores + [0.0] * n
            entropy, letters, rejected = entropy + [None] * n, letters + [0] * n, rejected + [True] * n
    return pa.StructArray.from_arrays([
        pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(entropy, pa.float64()),
        pa.array(letters, pa.int64()), pa.array(rejected, pa.bool_()),
    ], ["lang", "score", "entropy", "n_letters", "rejected"])


def held_out(key: str) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
