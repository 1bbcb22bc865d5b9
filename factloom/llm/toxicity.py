"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols: insults, threats, targets, negations, markers of reported speech, clause ends and
the rest. Four small transducers rewrite the symbols of a clause - one marks reported speech, one what a
negation reaches, one what is aimed at a target, one joins threats to their targets - and their composition
is one machine that a text is run through once. What it emits are matched patterns, such as an insult that is
aimed at someone and not negated; each carries the weight of its word. The weights of insult words and of the
patterns are learned from a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.text import WindowHasher, slices, words_of
from factloom.sources.workspace import stage

#: Words of the fixed classes, in English, German, French and Spanish.
FIXED = {
    "target": "you your yours yourself u they them he she these those people du dich dir ihr euch sie tu toi vous vos ils elles tú ti usted ustedes ellos ellas",
    "negation": "not no never neither nor isn't aren't wasn't don't nicht kein keine nie niemals ne pas jamais nunca jamás tampoco",
    "reported": "said says say wrote writes called calls quote quoted claimed according sagte sagt schrieb nannte laut dit disait écrit appelé dijo dice escribió llamó según",
    "threat": "kill hurt destroy beat burn shoot die töten schlagen zerstören sterben tuer frapper détruire mourir matar golpear destruir morir",
}
#: Insults known without labels, with weight 1 until labels say otherwise.
SEED_INSULTS = "idiot moron stupid loser trash scum worthless pathetic disgusting clown imbecile dumb"
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W\d_]+)*|[.!?;:,\n]")
CLAUSE_ENDS = frozenset(".!?;:,\n")
#: Lengths of the stems that are learned beside whole words.
STEMS = (4, 5, 6)
#: Odds at which a word gets the full weight.
FULL_ODDS = 400.0
#: How many words a negation reaches.
REACH = 3
FEATURES = ("plain", "aimed", "negated", "reported", "threat", "late_target")
#: Pattern weights without labels, and the intercept: the centre to which the fit is drawn.
PRIOR = dict(zip(FEATURES, (6.0, 7.0, 3.0, 3.0, 6.0, 0.5), strict=True)) | {"": -3.0}


@dataclass
class Transducer:
    """Arcs (state, read symbol) -> (next state, written symbol), deterministic; start state "0".

    A symbol without an arc is copied and the state kept.
    """

    arcs: dict[tuple[str, str], tuple[str, str]] = field(default_factory=dict)

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(parts: list[Transducer], symbols: Iterable[str]) -> tuple[dict[tuple[int, str], tuple[int, str]], int]:
    """One machine that does what the parts do one after another; its states are those that can be reached."""
    start = ("0",) * len(parts)
    numbers, queue, arcs = {start: 0}, [start], {}
    symbols = list(symbols)
    while queue:
        at = queue.pop()
        for read in symbols:
            symbol, to = read, []
            for part, state in zip(parts, at, strict=True):
                state, symbol = part.step(state, symbol)
                to.append(state)
            to = tuple(to)
            if to not in numbers:
                numbers[to] = len(numbers)
                queue.append(to)
            arcs[numbers[at], read] = (numbers[to], symbol)
    return arcs, len(numbers)


def grammar() -> dict[tuple[int, str], tuple[int, str]]:
    """The composed machine over the symbols insult, threat, target, negation, reported, other and end."""
    reported = Transducer({("0", "reported"): ("said", "other"), ("said", "insult"): ("said", "insult/reported"), ("said", "threat"): ("said", "other"), ("said", "end"): ("0", "end")})
    negation = Transducer({("0", "negation"): (f"not{REACH}", "other")})
    for k in range(1, REACH + 1):
        below = f"not{k - 1}" if k > 1 else "0"
        negation.arcs |= {(f"not{k}", "negation"): (f"not{REACH}", "other"), (f"not{k}", "other"): (below, "other"), (f"not{k}", "target"): (below, "target"), (f"not{k}", "insult"): ("0", "insult/negated"), (f"not{k}", "threat"): ("0", "other"), (f"not{k}", "insult/reported"): (below, "insult/reported"), (f"not{k}", "end"): ("0", "end")}
    aim = Transducer({("0", "target"): ("aimed", "target"), ("aimed", "insult"): ("aimed", "insult/aimed"), ("aimed", "end"): ("0", "end"), ("0", "insult"): ("open", "insult"), ("open", "target"): ("aimed", "target/late"), ("open", "end"): ("0", "end")})
    threat = Transducer({("0", "threat"): ("menace", "other"), ("menace", "target"): ("0", "threat/joined"), ("menace", "target/late"): ("0", "threat/joined"), ("menace", "end"): ("0", "end")})
    return compose([reported, negation, aim, threat], ["insult", "threat", "target", "negation", "reported", "other", "end"])[0]


#: What the machine writes, and the pattern it counts for.
WRITTEN = {"insult": 0, "insult/aimed": 1, "insult/negated": 2, "insult/reported": 3, "threat/joined": 4, "target/late": 5}


class Reader(dict):
    """The symbol and weight of each token, found once and remembered.

    Insults are whole words, or stems written as a prefix and a star; a word takes its own entry before a stem's.
    """

    REMEMBERED = 400_000

    def __init__(self, insults: dict[str, float]) -> None:
        self.insults = insults
        self.stems = sorted({len(w) - 1 for w in insults if w.endswith("*")}, reverse=True)
        self.fixed = {w: (c, 1.0) for c, ws in FIXED.items() for w in ws.split()} | dict.fromkeys(CLAUSE_ENDS, ("end", 0.0))

    def __missing__(self, token: str) -> tuple[str, float]:
        found = self.fixed.get(token)
        for entry in (token, *[token[:k] + "*" for k in self.stems if len(token) > k]):
            if entry in self.insults:
                found = ("insult", self.insults[entry])
                break
        if len(self) >= self.REMEMBERED:
            self.clear()
        self[token] = found = found or ("other", 0.0)
        return found


@dataclass
class Grammar:
    """Insult weights, pattern weights and the composed machine."""

    insults: dict[str, float]
    weights: dict[str, float] = field(default_factory=lambda: dict(PRIOR))

    def patterns(self, text: str | None) -> np.ndarray:
        """Total word weight of each matched pattern in a text; all zero for None."""
        found = np.zeros(len(FEATURES))
        if not text:
            return found
        tokens = TOKEN.findall(text.lower())
        if not hasattr(self, "reader"):
            self.reader, self.machine = Reader(self.insults), grammar()
        read = list(map(self.reader.__getitem__, tokens))
        if not any(symbol in ("insult", "threat") for symbol, _ in set(read)):
            return found
        arcs, state = self.machine, 0
        for symbol, weight in read:
            if symbol == "other" and state == 0:
                continue
            state, written = arcs[state, symbol]
            if (k := WRITTEN.get(written)) is not None:
                found[k] += weight
        return found

    def score(self, text: str | None) -> float:
        return self.chance(self.patterns(text))

    def chance(self, patterns: np.ndarray) -> float:
        x = self.weights[""] + float(np.dot(np.log1p(patterns), [self.weights[f] for f in FEATURES]))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def labelled_sample(docs: DataFrame, labels: DataFrame, keep, most_rows: int) -> DataFrame:
    """At most ``most_rows`` toxic and as many other labelled documents (``doc_id``, ``text``, ``toxic``).

    They are those with the smallest hashes of doc_id among the labels for which ``keep`` holds. A document
    labelled more than once is toxic if any label says so; NULL labels are left out. Of rows that share a doc_id the
    one with the first text counts, so the sample has no more rows than the labels taken.
    """
    known = (
        labels.where(keep).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    )
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = known.where("toxic = 1").orderBy(*by_hash).limit(most_rows).unionByName(known.where("toxic = 0").orderBy(*by_hash).limit(most_rows))
    few = few.withColumnRenamed("doc_id", "label_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("label_id"))  # bounded by most_rows
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def learn_insults(
    sample: DataFrame, min_documents: int = 3, min_share: float = 0.005, min_odds: float = 8.0
) -> dict[str, float]:
    """Weights in (0, 1] of words and stems that mark toxic documents in the sample, besides the known ones.

    Documents that share the smallest hash of their 5-word windows are near copies for the most part and
    count once. A word must stand in ``min_documents`` toxic documents and in ``min_share`` of them, with
    odds ``min_odds`` times those of other documents, and with a log-likelihood ratio that chance does not
    give any of so many words (2 ln of their number). The weight follows the odds. A stem is judged in the same
    way by the words that are not known by then; it must begin three of them, with six times the share and
    odds of 20.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WindowHasher(seed=5)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            keys = []
            for t in texts:
                parts = words_of(t)
                hashes = hasher.windows(parts, min(5, len(parts))) if parts else np.zeros(1, np.uint64)
                keys.append(int(hashes.min().astype(np.int64)))
            found = [set(TOKEN.findall((t or "").lower())) - CLAUSE_ENDS for t in texts]
            found = [sorted(ws) for ws in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array(found, pa.list_(pa.string()))],
                names=["near", "doc_id", "toxic", "words"],
            )

    once = (
        sample.mapInArrow(words, "near long, doc_id long, toxic int, words array<string>")
        .groupBy("near", "toxic")
        .agg(F.min_by("words", F.struct("doc_id", F.xxhash64("words"))).alias("words"))
    )
    once = stage(once, "distinct-sample")
    totals = {int(t): n for t, n in once.groupBy("toxic").count().collect()}
    p_all, n_all = totals.get(1, 0), totals.get(0, 0)
    insults = dict.fromkeys(SEED_INSULTS.split(), 1.0)
    if not p_all or not n_all:
        return insults
    each = once.select("near", "toxic", F.explode("words").alias("word"))

    def marks(counts: DataFrame, odds_above: float, share_above: float, min_words: int, known: list[str]) -> list:
        """Entries with ``p`` toxic and ``n`` other documents that mark toxic ones, and the known ones."""
        counts = stage(counts, "word-counts")
        p, n, share = F.col("p"), F.col("n"), F.lit(p_all / (p_all + n_all))
        odds = F.log((p + 0.5) / (p_all + 1.0)) - F.log((n + 0.5) / (n_all + 1.0))
        part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
        ratio = 2 * (part(p, (p + n) * share) + part(n, (p + n) * (1 - share)))
        marking = (
            (p >= max(min_documents, share_above * p_all))
            & (F.col("odds") >= math.log(odds_above))
            & (F.col("ratio") >= 2 * math.log(max(2, counts.count())))
            & (F.col("words") >= min_words)
        )
        # A word must mark a share of the bounded sample, so this list is bounded, too.
        rows = counts.withColumn("odds", odds).withColumn("ratio", ratio).where(F.col("word").isin(known) | marking)
        return rows.orderBy(F.desc(F.col("word").isin(known)), F.desc("ratio"), "word").collect()

    toxic = F.col("toxic") == 1
    whole = each.groupBy("word").agg(F.count_if(toxic).alias("p"), F.count_if(~toxic).alias("n"), F.lit(1).alias("words"))
    for r in marks(whole, min_odds, min_share, 1, list(insults)):
        # A known insult that other documents hold as often fades out.
        insults[r["word"]] = max(0.02, min(1.0, r["odds"] / math.log(FULL_ODDS)))
    known = sample.sparkSession.createDataFrame([(w,) for w in insults], "word string")
    stems = F.explode(F.array(*[F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS]))
    others = each.join(known, "word", "left_anti").select("near", "toxic", "word", stems.alias("stem")).where("stem IS NOT NULL")
    begun = (
        others.groupBy(F.col("stem").alias("word"))
        .agg(F.count_distinct(F.when(toxic, F.col("near"))).alias("p"), F.count_distinct(F.when(~toxic, F.col("near"))).alias("n"), F.count_distinct(F.when(toxic, F.col("word"))).alias("words"))
    )
    for r in marks(begun, 20.0, 6 * min_share, 3, []):
        insults[r["word"]] = min(1.0, r["odds"] / math.log(FULL_ODDS))
    return insults


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> dict[str, float]:
    """Pattern weights by logistic regression, drawn to the prior by a ridge for each row; classes weigh the same.

    The prior lets a single sure insult decide, also where labelled texts mostly have several.
    """
    ridge = ridge * len(x)
    z = np.column_stack([np.log1p(x), np.ones(len(x))])
    prior = np.array([PRIOR[f] for f in FEATURES] + [PRIOR[""]])
    w, share = prior.copy(), np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (share * (y - p)) - ridge * (w - prior)
        curve = (z * (share * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return dict(zip([*FEATURES, ""], map(float, w), strict=True))


def learn_grammar(docs: DataFrame, labels: DataFrame, keep=None, most_rows: int = 10_000) -> Grammar:
    """A grammar fitted to a sample of labelled documents; without labels, the known words and weights."""
    sample = stage(labelled_sample(docs, labels, F.lit(True) if keep is None else keep, most_rows), "toxic-sample")
    known = Grammar(learn_insults(sample))
    scored = with_patterns(sample, known, ["toxic"]).select("toxic", *FEATURES).toPandas()  # bounded by most_rows
    if scored["toxic"].nunique() == 2:
        known.weights = fit_weights(scored[list(FEATURES)].to_numpy(float), scored["toxic"].to_numpy(float))
    return known


def with_patterns(docs: DataFrame, known: Grammar, carry: list[str]) -> DataFrame:
    """The columns ``carry``, the weight of each pattern in the text, and ``score``."""
    insults, weights = known.insults, known.weights

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Grammar(insults, weights)
        for batch in batches:
            found = np.array([machine.patterns(t.as_py()) for t in batch.column("text")]).reshape(-1, len(FEATURES))
            scores = [machine.chance(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], *[pa.array(found[:, k]) for k in range(len(FEATURES))], pa.array(scores, pa.float64())],
                names=[*carry, *FEATURES, "score"],
            )

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, "text").mapInArrow(match, f"{types}, {', '.join(f'{f} double' for f in FEATURES)}, score double")


def keep_clean(docs: DataFrame, labels: DataFrame, keep=None) -> DataFrame:
    """The documents that are not predicted toxic, unchanged; NULL and empty texts stay."""
    known = learn_grammar(docs, labels, keep)
    insults, weights = known.insults, known.weights

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Grammar(insults, weights)
        for batch in slices(batches):
            yield batch.filter(pa.array([machine.score(t.as_py()) < 0.5 for t in batch.column("text")]))

    return docs.mapInArrow(clean, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame, keep=None) -> DataFrame:
    """``doc_id``, pattern weights, ``score`` (0 to 1) and ``predicted`` (1 from 0.5) for every document.

    NULL and empty texts match nothing and get the lowest score. Repeated rows are scored each; an empty
    table gives no rows. ``keep``: condition on the labels that may be learned from.
    """
    scored = with_patterns(docs, learn_grammar(docs, labels, keep), ["doc_id"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
