"""Quality rules as a learned decision list.

Statistics of every text are computed in one pass. Sequential covering learns, from a bounded sample of
labelled documents, an ordered list of threshold conjunctions that describe poor documents: a conjunction is
grown condition by condition on two thirds of the rows, pruned on the others, and the rows it covers are
set aside before the next. The list is emitted as one Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.text import WindowHasher, mixed, per_document, slices, within, words_of
from factloom.sources.workspace import stage

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?'\"()-"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_punctuation", "n_distinct", "n_other_letters",
)
#: What rules look at: name and SQL over the counts (0 where the divisor is 0).
FEATURES = {
    "words": "double(n_words)",
    "word_length": "word_chars / n_words",
    "symbols_a_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "punctuation_a_word": "n_punctuation / n_words",
    "distinct_share": "n_distinct / n_words",
    "other_letter_share": "n_other_letters / word_chars",
    "words_a_line": "n_words / n_lines",
}


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every text; NULL and empty texts have only zeros.

    ``n_repeat_words``: words in 3-word windows that occur twice or more in the text, the first included.
    ``n_dup_lines``: lines with a word that equal an earlier line.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WindowHasher()
        kinds = np.zeros((256, 5), np.int64)  # letters and signs that start a character; symbol, A-Z, 0-9, punctuation
        kinds[:, 0] = [not 0x80 <= b < 0xC0 and b != 32 for b in range(256)]
        for k, chars in ((1, SYMBOLS), (2, bytes(range(65, 91))), (3, b"0123456789"), (4, PUNCTUATION)):
            kinds[list(chars), k] = 1
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            each = [words_of(t) for t in texts]
            counts = np.array([len(w) for w in each], np.int64)
            words = [w for ws in each for w in ws]
            data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
            ends = np.flatnonzero(data == 32)
            if not words:
                ends = ends[:0]
            sums = [np.concatenate([[0], np.cumsum(kinds[data, k])]) for k in range(5)]
            sums.append(np.concatenate([[0], np.cumsum(data >= 0xC0)]))
            starts = np.concatenate([[0], ends[:-1] + 1]) if words else ends
            chars, symbols, upper, digits, signs, other = (per_document(s[ends] - s[starts], counts) for s in sums)

            owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
            salt = mixed(owner + np.uint64(1))
            covered = np.zeros(len(words), bool)
            inside = np.flatnonzero(within(counts, 3))
            keys = hasher.windows(words, 3)[inside] ^ salt[inside]
            for i in inside[repeated(keys)]:
                covered[i : i + 3] = True
            single = np.unique(hasher.windows(words, 1) ^ salt, return_index=True)[1] if words else []
            distinct = np.bincount(owner[single].astype(np.int64), minlength=len(texts)) if words else counts

            lines, dup = [], []
            for t in texts:
                seen: set[str] = set()
                n = d = 0
                for line in (t or "").split("\n"):
                    if line.encode("utf-8", "surrogatepass").split():
                        n += 1
                        d += line in seen
                        seen.add(line)
                lines.append(n)
                dup.append(d)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *[
                        pa.array(c, pa.int64())
                        for c in (counts, chars, symbols, dup, per_document(covered, counts), lines, upper, digits, signs, distinct, other)
                    ],
                ],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    found = keys[order]
    same = np.zeros(len(keys), bool)
    equal = found[1:] == found[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    out = np.zeros(len(keys), bool)
    out[order] = same
    return out


def feature_columns() -> list[Column]:
    return [F.expr(f"coalesce(try_divide({n.split(' / ')[0]}, {n.split(' / ')[1]}), 0D)" if " / " in n else n).alias(name) for name, n in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.feature] > self.value if self.above else x[:, self.feature] <= self.value

    def sql(self) -> str:
        return f"`{list(FEATURES)[self.feature]}` {'>' if self.above else '<='} {self.value!r}D"


def _covers(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    held = np.ones(len(x), bool)
    for c in rule:
        held &= c.holds(x)
    return held


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> list[Condition]:
    """Adds the condition of the largest information gain until only bad rows are covered."""
    rule: list[Condition] = []
    held = np.ones(len(x), bool)
    while len(rule) < most and not bad[held].all():
        p, n = bad[held].sum(), (~bad[held]).sum()
        before, best = np.log2(p / (p + n)), (1e-9, None)
        for f in range(x.shape[1]):
            values = x[held, f]
            order = np.argsort(values, kind="stable")
            v, b = values[order], bad[held][order]
            cuts = np.flatnonzero(v[1:] > v[:-1])
            if not len(cuts):
                continue
            below_p = np.cumsum(b)[cuts]
            below_n = cuts + 1 - below_p
            for above, ps, ns in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - before), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], Condition(f, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        held = _covers(rule, x)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The beginning of the rule with the best (p - n) / (p + n) on rows it was not grown on."""
    best, kept = -2.0, rule
    for k in range(len(rule), 0, -1):
        held = _covers(rule[:k], x)
        p, n = bad[held].sum(), (~bad[held]).sum()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth >= best:
            best, kept = worth, rule[:k]
    return kept


def learn_list(x: np.ndarray, bad: np.ndarray, most_rules: int = 12, most_conditions: int = 4, precision: float = 0.8) -> list[list[Condition]]:
    """Sequential covering. Stops at the first rule that is not precise on both parts of the remaining rows."""
    rules: list[list[Condition]] = []
    grow = np.arange(len(x)) % 3 != 2
    left = np.ones(len(x), bool)
    while len(rules) < most_rules and bad[left & grow].any():
        g, p = left & grow, left & ~grow
        rule = _grow(x[g], bad[g], most_conditions)
        if not rule:
            break
        rule = _prune(rule, x[p], bad[p])
        covered = _covers(rule, x) & left
        if covered.sum() < 3 or bad[covered].mean() < precision or ((covered & p).any() and bad[covered & p].mean() < precision - 0.1):
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit_rules(statistics: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> list[list[Condition]]:
    """Rules learned from at most ``most_rows`` labelled documents, those with the smallest hashes of doc_id.

    A document labelled more than once counts as its least quality; NULL labels are left out. No labels, or
    labels of one kind, give no rules.
    """
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality IS NOT NULL AND doc_id IS NOT NULL")
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    rows = (
        statistics.join(F.broadcast(few), "doc_id")  # at most `most_rows` rows
        .select("doc_id", "quality", *feature_columns())
        .orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES)
        .limit(most_rows)
        .toPandas()
    )
    if not len(rows):
        return []
    return learn_list(rows[list(FEATURES)].to_numpy(float), (rows["quality"] == 0).to_numpy())


def rule_number(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that fires, from 1; 0 if none does."""
    chosen = F.lit(0)
    for k in range(len(rules), 0, -1):
        chosen = F.when(F.expr(" AND ".join(c.sql() for c in rules[k - 1])), k).otherwise(chosen)
    return chosen


def apply_rules(statistics: DataFrame, rules: list[list[Condition]], min_words: int = 50, most_repeat_percent: int = 50) -> DataFrame:
    """Adds ``base_failed``, ``rule`` (number of the list's rule that fires, 0 if none) and ``kept``.

    The base fails texts of fewer than ``min_words`` words and texts whose repeated words exceed a share.
    Empty and NULL texts fail the base.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))
    return (
        statistics.select("*", *feature_columns())
        .withColumn("rule", rule_number(rules))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("rule") == 0))
        .drop(*FEATURES)
    )


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document. Repeated rows are judged each; an empty table gives no rows."""
    statistics = stage(text_statistics(docs), "statistics")
    return apply_rules(statistics, fit_rules(statistics, labels))
