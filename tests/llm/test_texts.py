"""Pieces, class model, quality rules and toxicity."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from factloom.llm import class_model, pieces, quality, queries, toxicity
from factloom.llm.text import WindowHasher
from tests.llm import data


@pytest.fixture(scope="module")
def model(spark):
    return queries.piece_model(spark)


ODD = [t for _, t, *_ in data.ROWS if t] + ["  a  b ", "\n\n x", "a▁b ▁▁ c", "▁", "<s> </s> <0x41>", "a" * 500, " " * 70, "é\u0301 ½ ﬁ"]
ODD += ["a\U0010fffeb \U0010fffe ▁\U0010ffff▁", "\U0010fffe", "\uffff▁\ufdd0"]


def test_window_hashes_depend_on_the_words_alone():
    a = [b"x", b"yy", b"z", b"x", b"yy", b"z"]
    h = WindowHasher().windows(a, 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 3
    assert (WindowHasher().windows([b"q", *a], 3)[1:] == h).all()
    assert WindowHasher().windows([b"xy", b"y"], 2)[0] != WindowHasher().windows([b"x", b"yy"], 2)[0]


def test_without_dropout_pieces_are_the_library_s(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [t for t in ODD if "▁" not in t] + [r.text for r in data.given(spark, "documents").limit(60).collect()]
    for text, ids in zip(texts, pieces.load(model).encode(texts, np.arange(len(texts), dtype=np.uint64)), strict=True):
        assert ids.tolist() == library.encode(text)


def test_dropout_varies_and_decodes_losslessly(model):
    tables = pieces.load(model, 0.3, 5)
    salts = np.arange(len(ODD), dtype=np.uint64)
    made = tables.encode(ODD, salts)
    assert [tables.decode(x) for x in made] == ODD
    again = pieces.load(model, 0.3, 5).encode(ODD[::-1], salts[::-1])[::-1]
    assert all((a == b).all() for a, b in zip(made, again, strict=True))
    forms = {tuple(x) for x in tables.encode(["segmentation of internationally"] * 50, np.arange(50, dtype=np.uint64))}
    assert len(forms) > 5


def test_matrix_and_agenda_agree(model):
    tables = pieces.load(model, 0.2, 3)
    pick = random.Random(1)
    chunks = ["▁" + "".join(pick.choice("abcdeéöst日▁x") for _ in range(pick.randint(1, 30))) for _ in range(400)]
    keys = tables.chunk_keys(chunks, np.zeros(len(chunks)))
    made = tables.segment(chunks, np.zeros(len(chunks)))
    assert made == [tables.merge_long(c, k) for c, k in zip(chunks, keys, strict=True)]


def test_every_occurrence_is_drawn_for_itself(model):
    tables = pieces.load(model, 0.1, 1)
    for letter in "abcst":
        whole = pieces.load(model).encode([letter], np.zeros(1, np.uint64))[0]
        assert len(whole) == 1  # one candidate: the space sign and the letter
        made = tables.encode([" ".join([letter] * 20_000)], np.zeros(1, np.uint64))[0]
        assert 0.09 < (len(made) - 20_000) / 20_000 < 0.11
    text = " ".join(["segmentation"] * 2000)
    at = tables.segment(["▁segmentation"] * 2000, pieces.occurrences(7, text, 2000))
    assert len(set(at)) > 8
    assert tables.encode([text], np.array([7], np.uint64))[0].astype("<u2").tobytes() == b"".join(at)


def test_remembered_chunks_change_nothing(spark, model):
    tables = pieces.load(model, 0.2, 3)
    texts = [t for t in ODD if "▁" not in t] + [r.text for r in data.given(spark, "documents").limit(40).collect()]
    for i, (text, made) in enumerate(zip(texts, tables.encode(texts, np.arange(len(texts), dtype=np.uint64)), strict=True)):
        chunks = pieces.chunks_of(text)
        each = tables.segment(chunks, pieces.occurrences(i, text, len(chunks)))
        assert made.astype("<u2").tobytes() == b"".join(each)


def test_only_what_leaves_the_trees_is_merged_anew(spark, model, monkeypatch):
    tables, merged = pieces.load(model, 0.1, 1), []
    rows = tables.merge_rows
    monkeypatch.setattr(tables, "merge_rows", lambda chunks, *more: merged.append(len(chunks)) or rows(chunks, *more))
    text = " ".join(["segmentation", "of", "internationally", "\u65e5x"] * 5000)
    made = tables.encode([text], np.array([7], np.uint64))[0]
    # Most occurrences that skip a candidate skip one that others skip too, or one that would not be merged.
    assert sum(merged) < 2000
    chunks = pieces.chunks_of(text)
    keys = tables.chunk_keys(chunks, pieces.occurrences(7, text, len(chunks)))
    assert made.astype("<u2").tobytes() == b"".join(tables.merge_long(c, k) for c, k in zip(chunks, keys, strict=True))


def test_trees_that_are_full_change_nothing(model, monkeypatch):
    pick = random.Random(3)
    texts = [" ".join("".join(pick.choice("abcdet\u00e9\u65e5\u2581\n") for _ in range(pick.randint(1, 45))) for _ in range(60)) for _ in range(12)]
    salts = np.arange(len(texts), dtype=np.uint64)
    whole = pieces.load(model, 0.3, 1).encode(texts, salts)
    monkeypatch.setattr(pieces, "MERGES", 100)
    monkeypatch.setattr(pieces, "GROWTHS", 0)
    tables = pieces.load(model, 0.3, 1)
    for text, salt, made in zip(texts, salts, whole, strict=True):
        assert (tables.encode([text], np.array([salt]))[0] == made).all()


def test_pieces_of_awkward_documents(spark, model):
    done = pieces.decode(pieces.encode(data.documents(spark), model), model)
    rows = done.collect()
    assert len(rows) == len(data.ROWS)
    assert all(r.decoded == r.text and (r.pieces is None) == (r.text is None) for r in rows)
    assert rows[0].label == "label"
    assert pieces.encode(data.no_documents(spark), model).count() == 0


def test_base_scores_by_brute_force(spark):
    docs = data.given(spark, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    got = {r.doc_id: r for r in class_model.score(docs, ~held_out).collect()}
    rows = docs.collect()
    low = lambda r: r.text.encode().lower().split() + [None]
    counts = collections.Counter(w for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for w in low(r))
    n, v = sum(counts.values()), len(counts)
    better = worse = 0
    for r in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in low(r))
        g = got[r.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(low(r)), sum(counts[w] > 0 for w in low(r)), n)
        assert g.base_score == pytest.approx(base, rel=1e-9)
        if zlib.crc32(str(r.doc_id).encode()) % 7 == 2:
            better, worse = better + g.score, worse + base
    assert better > worse  # held out


def test_class_model_is_a_distribution(spark):
    model, others = class_model.learn(data.given(spark, "documents"))
    assert np.allclose((10**model.moves).sum(axis=1), 1)
    known, n = model.known, model.known.clustered
    sums = np.bincount(model.word_class, 10**model.in_class, len(model.moves))
    for w, count in others.select("word", "n").collect():
        e = class_model.ending(w.encode())
        sums[class_model.CLASSES + 1 + e] += (count + 1) * 10 ** model.endings[e]
    sums[class_model.CLASSES + 1 :] += 10**model.endings  # the unseen word
    sums[class_model.CLASSES] = 1  # the end
    used = np.bincount(model.classes[:n], minlength=class_model.CLASSES)[: class_model.CLASSES] > 0
    assert np.allclose(sums[: class_model.CLASSES][used], 1) and np.allclose(sums[class_model.CLASSES :], 1)
    assert known.tokens == sum(known.counts) + known.documents + (others.agg(F.sum("n")).first()[0] or 0)


def test_neighbours_are_packed_and_moves_counted_alone(spark):
    training = data.given(spark, "documents").limit(300)
    known, _ = class_model.learn_vocabulary(class_model.count_words(training), training.count())
    bigrams = class_model.count_bigrams(training, known)
    exchange = class_model.Exchange(bigrams, known)
    n, want = known.clustered, collections.Counter()
    for a, b, count in bigrams.collect():
        want["right", a, b], want["left", b, a] = count, count
    got = collections.Counter()
    for row in exchange.rows.collect():
        for side in ("right", "left"):
            others, counts = np.frombuffer(row[side], np.int32), np.frombuffer(row[f"{side}_n"], np.int64)
            got += {(side, row.word, other): count for other, count in zip(others.tolist(), counts.tolist(), strict=True)}
    assert got == {k: v for k, v in want.items() if k[1] < n}
    assert {t for name, t in exchange.rows.dtypes if name != "word"} == {"binary"}
    classes = exchange.classes.copy()
    classes[: n // 3] = np.arange(n // 3)[::-1] % class_model.CLASSES
    assert (classes != exchange.classes).any()
    assert (exchange.moved(classes) == exchange.matrix(classes)).all()


def test_bigrams_travel_packed_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(class_model, "FLUSH_BIGRAMS", 300)
    monkeypatch.setattr(class_model, "DEALT", 100)
    monkeypatch.setattr(class_model, "MERGED", 3)
    pick = random.Random(5)
    words = [f"{w}{i}" for i in range(12) for w in ("A", "b", "\u00c9", "\u65e5")]
    gaps = [" ", "  ", "\n", "\t\x0b", "\x0c\r "]
    texts = [None, "", " \n", "\x1c a\u00a0b "] + ["".join(pick.choice(words) + pick.choice(gaps) for _ in range(pick.randint(0, 60))) for _ in range(80)]
    docs = spark.createDataFrame([(i, pick.choice(["", " "]) + x if x else x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    known, _ = class_model.learn_vocabulary(class_model.count_words(docs), docs.count())
    n = known.clustered
    assert 8 + known.tokens // 3 > 500 and 0 < n < len(known.words)
    number = {w: i for i, w in enumerate(known.words[:n])}
    want, seen = collections.Counter(), collections.Counter()
    for text in texts:
        low = (text or "").encode().lower().split()
        seen.update(low)
        ids = [n, *[number.get(w, n + 1 + class_model.ending(w)) for w in low], n]
        want.update(zip(ids, ids[1:], strict=False))
    assert dict(zip(known.words, known.counts.tolist(), strict=True)) == seen
    bigrams = class_model.count_bigrams(docs, known)
    rows = bigrams.collect()
    assert len(rows) == len(want) and {(r.a, r.b): r.n for r in rows} == want
    assert "HashAggregate" not in bigrams._jdf.queryExecution().toString()  # no row for each bigram is shuffled
    exchange = class_model.Exchange(bigrams, known)
    found = exchange.rows.collect()
    assert sorted(r.word for r in found) == list(range(n))
    for r in found:
        right = dict(zip(np.frombuffer(r.right, np.int32).tolist(), np.frombuffer(r.right_n, np.int64).tolist(), strict=True))
        left = dict(zip(np.frombuffer(r.left, np.int32).tolist(), np.frombuffer(r.left_n, np.int64).tolist(), strict=True))
        assert right == {b: k for (a, b), k in want.items() if a == r.word}
        assert left == {a: k for (a, b), k in want.items() if b == r.word}
    fixed = exchange.still[class_model.CLASSES :, class_model.CLASSES :]
    assert {(a, b): fixed[a - n, b - n] for a, b in want if a >= n and b >= n} == {k: v for k, v in want.items() if min(k) >= n}
    assert exchange.still.sum() == fixed.sum() == sum(v for k, v in want.items() if min(k) >= n)


def test_exchange_finds_words_of_the_same_use(spark, monkeypatch):
    monkeypatch.setattr(class_model, "CLASSES", 4)
    pick = random.Random(2)
    nouns, verbs = [f"n{i}" for i in range(8)], [f"v{i}" for i in range(8)]
    texts = [(i, " ".join(w for _ in range(40) for w in (pick.choice(nouns), pick.choice(verbs)))) for i in range(60)]
    model, _ = class_model.learn(spark.createDataFrame(texts, "doc_id long, text string"))
    of = dict(zip(model.known.words, model.word_class, strict=True))
    assert not {of[w.encode()] for w in nouns} & {of[w.encode()] for w in verbs}


def class_likelihood(pairs, classes):
    """By its definition: each pair's class bigram against the classes on both sides."""
    both, first, second = collections.Counter(), collections.Counter(), collections.Counter()
    for (a, b), n in pairs.items():
        both[classes[a], classes[b]] += n
        first[classes[a]] += n
        second[classes[b]] += n
    return sum(n * math.log(n / first[a] / second[b]) for (a, b), n in both.items())


def test_exchange_ends_where_no_word_gains_by_moving(spark, monkeypatch):
    monkeypatch.setattr(class_model, "CLASSES", 5)
    monkeypatch.setattr(class_model, "HEADS", 40)
    pick = random.Random(4)
    kinds = [[f"{k}{i}" for i in range(50)] for k in "abcd"]
    follows = [1, 2, 3, 1]
    texts = []
    for i in range(250):
        kind, words = pick.randrange(4), []
        for _ in range(60):
            words += [pick.choice(kinds[kind])] * pick.choice([1, 1, 1, 2])
            kind = follows[kind] if pick.random() < 0.8 else pick.randrange(4)
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    known, _ = class_model.learn_vocabulary(class_model.count_words(docs), docs.count())
    bigrams = class_model.count_bigrams(docs, known)
    pairs = {(r.a, r.b): r.n for r in bigrams.collect()}
    exchange, seen = class_model.Exchange(bigrams, known), []
    assert known.clustered == 200
    plain = class_model.Exchange.round

    def watched(self, *args):
        before = class_likelihood(pairs, self.classes)
        moved, gain = plain(self, *args)
        after = class_likelihood(pairs, self.classes)
        assert after - before == pytest.approx(gain, rel=1e-6, abs=1e-4) and gain >= 0
        seen.append(moved)
        return moved, gain

    monkeypatch.setattr(class_model.Exchange, "round", watched)
    exchange.run(0.0)
    assert seen[0] > 0 and seen[-1] == 0
    best = class_likelihood(pairs, exchange.classes)
    for word in range(0, 200, 8):
        for to in range(5):
            moved = exchange.classes.copy()
            moved[word] = to
            assert class_likelihood(pairs, moved) <= best + 1e-4


def test_scores_of_awkward_documents(spark):
    rows = class_model.score(data.documents(spark), F.lit(True)).collect()
    assert len(rows) == len(data.ROWS) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    unseen = class_model.score(data.documents(spark), F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in unseen)
    assert class_model.score(data.no_documents(spark), F.lit(True)).count() == 0


def statistics_of(text):
    ws = data.words(text)
    windows = collections.Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(ws), sum(len(w.decode()) for w in ws), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_text_statistics_by_brute_force(spark):
    for docs in (data.given(spark, "documents"), data.documents(spark)):
        want = collections.Counter((r.doc_id, *statistics_of(r.text)) for r in docs.collect())
        columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert collections.Counter(map(tuple, quality.text_statistics(docs).select(*columns).collect())) == want


def test_decision_list_learns_thresholds():
    pick = np.random.default_rng(1)
    x = pick.random((3000, len(quality.FEATURES)))
    bad = (x[:, 2] > 0.7) & (x[:, 4] <= 0.5) | (x[:, 5] > 0.9)
    rules = quality.learn_list(x, bad)
    fires = np.zeros(len(x), bool)
    for rule in rules:
        fires |= quality._covers(rule, x)
    assert (fires == bad).mean() > 0.98
    assert quality.learn_list(x, np.zeros(len(x), bool)) == []


def test_rules_fire_in_order(spark):
    rules = [[quality.Condition(0, True, 100.0), quality.Condition(2, False, 0.5)], [quality.Condition(0, True, 10.0)]]
    rows = spark.createDataFrame([(200.0, 0.1), (200.0, 0.9), (5.0, 0.0)], "words double, symbols_a_word double")
    assert [r[0] for r in rows.select(quality.rule_number(rules)).collect()] == [1, 2, 0]


def test_quality_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality.judge_documents(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    rows = judged.where("NOT base_failed").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.95


def test_quality_of_awkward_documents(spark):
    rows = quality.judge_documents(data.documents(spark), data.labels(spark)).collect()
    assert len(rows) == len(data.ROWS) and all(r.base_failed for r in rows if r.n_words < 50)
    nobody = data.labels(spark, rows=[(1, None, None)])
    assert all(r.rule == 0 for r in quality.judge_documents(data.documents(spark), nobody).collect())
    assert quality.judge_documents(data.no_documents(spark), data.labels(spark)).count() == 0


def patterns(text):
    return dict(zip(toxicity.FEATURES, toxicity.Grammar({"idiot": 1.0, "tras*": 0.5}).patterns(text), strict=True))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("what an idiot", {"plain": 1}),
        ("you idiot. fine", {"aimed": 1}),
        ("idiot you", {"plain": 1, "late_target": 1}),
        ("not an idiot", {"negated": 1}),
        ("not one of the very many idiot", {"plain": 1}),
        ("not so. idiot", {"plain": 1}),
        ("they said idiot", {"reported": 1}),
        ("someone wrote trashy", {"reported": 0.5}),
        ("we will kill you", {"threat": 1}),
        ("never kill you", {}),
        ("the idiotic", {}),
        ("", {}),
        (None, {}),
    ],
)
def test_grammar_matches_clauses(text, found):
    assert {k: v for k, v in patterns(text).items() if v} == found


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    rows = toxicity.score_documents(docs, labels, keep=fold != 0).join(labels, "doc_id").where(fold == 0).collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.95
    assert not [r for r in rows if r.predicted and not r.toxic]


def test_toxicity_of_awkward_documents(spark):
    docs = data.documents(spark)
    rows = toxicity.score_documents(docs, data.labels(spark)).collect()
    assert len(rows) == len(data.ROWS) and all(0 <= r.score <= 1 for r in rows)
    low = min(r.score for r in rows)
    assert all(r.score == low for r in rows if r.doc_id in (4, 5, 6))
    kept = toxicity.keep_clean(docs, data.labels(spark))
    assert kept.columns == docs.columns and kept.where("doc_id = 7").count() == 0 and kept.count() >= len(data.ROWS) - 2
    assert toxicity.score_documents(data.no_documents(spark), data.labels(spark)).count() == 0
    assert toxicity.keep_clean(docs, data.labels(spark, rows=[(1, None, None)])).where("doc_id = 1").count() == 1
