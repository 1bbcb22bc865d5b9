"""Spelling variants, dimension-sharded centroids, byte-level BPE."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from factloom.llm import byte_pairs, centroids, queries, variants
from tests.compare import connect, spark_bag, sql_bag
from tests.llm import data

# ---- spelling variants --------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, shortest=7, fewest=2, every=31):
    counts = collections.Counter()
    for row, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if row is None else row}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= fewest}


def brute_groups(counts, times=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in best.items() if counts[v] >= times * counts[w]}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        yield w, counts[w], len(near[w]), form.get(w), counts[form[w]] if w in form else None, root


def some_words():
    pick = random.Random(1)
    words = {"".join(pick.choice("abà") for _ in range(pick.randint(1, 7))) for _ in range(300)}
    # Long words, and chains of forms: 1 -> 20 -> 400 -> 9000.
    words |= {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149, "kkkkqqqq", "kkkkqqq", "kkkkqq", "kkkkq"}
    counts = {w: pick.choice([1, 2, 30, 500]) for w in sorted(words)}
    return counts | {"kkkkqqqq": 1, "kkkkqqq": 20, "kkkkqq": 400, "kkkkq": 9000}


@pytest.mark.parametrize("tile_words", [16_384, 9])
def test_near_words_are_all_found_once(spark, tile_words):
    counts = some_words()
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(map(tuple, variants.near_words(df, tile_words).collect()))
    assert got == sorted((a, b, counts[b]) for a in counts for b in counts if one_edit(a, b))


def test_groups_follow_forms_to_the_root(spark):
    counts = some_words()
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = variants.group_variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_groups(counts), key=str)
    assert {r.word: r.root for r in got}["kkkkqqqq"] == "kkkkq"
    with pytest.raises(ValueError):
        variants.group_variants(df, times=1)


def test_variants_of_the_given_documents(spark):
    docs = data.given(spark, "documents")
    counts = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.word: r for r in queries.op11_variants(spark, data.FOLDER).collect()}
    assert {w: r.n for w, r in got.items()} == counts and len(counts) > 1000
    columns, rows = spark_bag(queries.op11_variants(spark, data.FOLDER))
    assert (columns, rows) == sql_bag(connect(data.FOLDER), queries.CHECK_SQL["op11_variants"])
    assert any(r.form for r in got.values())


def test_words_of_awkward_documents(spark):
    extra = [(50, "Àéîõüÿß Àéîõüÿß ÀÉÎÕÜŸß naïvely,NAïVELY;naïvely ×÷×÷×÷× ×÷×÷×÷× кириллица кириллица", "xx", "a", 1)]
    rows = [*data.ROWS, *extra]
    docs = spark.createDataFrame(rows, data.DOCUMENTS).withColumns({c: F.lit(c) for c in [*data.CLASHING, "word", "n", "form", "root"]})
    for every in (31, 2):
        got = {r.word: r.n for r in variants.count_words(docs, 3, 1, every).collect()}
        assert got == brute_words([r[:2] for r in rows], 3, 1, every)
    assert variants.count_words(docs).where("word = '×÷×÷×÷×'").count() == 1
    assert variants.group_variants(variants.count_words(data.no_documents(spark))).count() == 0


# ---- centroids ----------------------------------------------------------------------


def brute_lloyd(rows, components, k, rounds, seed=3, scale=1024):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == components and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([[int(np.floor(scale * float(e))) for e in v] for _, v in kept], dtype=object).reshape(len(kept), components)
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), tuple(v)) for (i, _), v in zip(kept, x, strict=True) if i is not None)[:k]
    c = [np.array(v, dtype=object) for _, v in first]
    for turn in range(rounds + 1):
        far = [[int(((v - m) ** 2).sum()) for m in c] for v in x]
        label = [d.index(min(d)) for d in far]
        if turn < rounds:
            for j in range(len(c)):
                mine = [v for v, at in zip(x, label, strict=True) if at == j]
                if mine:
                    c[j] = np.array([int(s) // len(mine) for s in sum(mine)], dtype=object)
    return [(i, at, min(d)) for (i, _), at, d in zip(kept, label, far, strict=True)], c


def test_centroids_of_the_given_vectors(spark):
    vectors = data.given(spark, "embeddings")
    want, c = brute_lloyd([(r.vec_id, r.embedding) for r in vectors.collect()], 64, 8, 10)
    got = queries.op12_centroids(spark, data.FOLDER).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(want)
    sums = collections.Counter()
    for _, at, d in want:
        sums[at] += d
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (sums[r.cluster], sum(sums.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()
    columns, rows = spark_bag(queries.op12_centroids(spark, data.FOLDER))
    assert (columns, rows) == sql_bag(connect(data.FOLDER), queries.CHECK_SQL["op12_centroids"])


def test_centroids_of_awkward_vectors(spark):
    pick = random.Random(4)
    rows = [(i, [pick.uniform(-3, 3) for _ in range(5)]) for i in range(40)]
    rows += [(5, rows[5][1])] * 60 + [(7, [0.5] * 5), (None, [1.0] * 5), (None, [1.0] * 5)]
    rows += [(90, None), (91, []), (92, [1.0] * 4), (93, [1.0, None, 1.0, 1.0, 1.0]), (94, [float("nan")] * 5), (95, [float("inf")] * 5)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, block string")
    as_floats = [(r.vec_id, r.embedding) for r in df.collect()]
    for k, width in ((4, 2), (3, 5), (200, 3)):
        got, found = centroids.lloyd(df, components=5, k=k, rounds=3, width=width, chunk_rows=7)
        want, _ = brute_lloyd(as_floats, 5, k, 3)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
        assert centroids.cluster_digest(got, found, width).count() == len(want)
    for none in (df.where("false"), df.where("vec_id >= 90"), df.where("vec_id IS NULL")):
        got, found = centroids.lloyd(none, components=5, k=4, rounds=2)
        assert centroids.cluster_digest(got, found).count() == 0
    far, _ = centroids.lloyd(spark.createDataFrame([(1, [1e30] * 5), (2, [-1e30] * 5)], "vec_id long, embedding array<float>"), components=5, k=1, rounds=0)
    assert max(r.distance for r in far.collect()) == 5 * (2 * centroids.LARGEST) ** 2  # held within bounds


# ---- byte pairs ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def merges(spark):
    return byte_pairs.load(queries.vocabulary(spark, "byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(merges):
    ranks = {t: i for i, t in enumerate(merges.tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD_PARTS = ["a", "aa", " ", "  ", "\n", "\r\n", "é", "日本語", "\U0001f600", "'", "'s", "'re", "12", "́", "x" * 60, "the", "ing", "\x1c", "\x85", "½", "Ⅷ", "\x00"]


def odd_texts(count, most=60):
    pick = random.Random(7)
    return ["".join(pick.choice(ODD_PARTS) for _ in range(pick.randint(1, most))) for _ in range(count)]


def test_tokens_are_the_library_s(spark, merges, library):
    texts = odd_texts(400) + ["x" * 3000, " " * 3000 + "a", "the" * 1000, "", None]
    texts += [r.text for r in data.given(spark, "documents").collect()] + ["a " + chr(c) * 2 + "1" for c in range(0x3000)]
    made = byte_pairs.Encoder(merges, public_tokenizers.PATTERN).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in made] == [library.encode_ordinary(t or "") for t in texts]


def test_every_prefix_ends_with_its_last_token(merges):
    encoder, ranks = byte_pairs.Encoder(merges, "(?s).+"), {t: i for i, t in enumerate(merges.tokens)}
    for text in odd_texts(25, 8):
        raw = text.encode()[:60]
        last = encoder.extend(raw, [])
        assert [byte_pairs.slow(raw[: i + 1], ranks)[-1] for i in range(len(raw))] == last
        assert encoder.read_back(last, 0, len(raw)) == byte_pairs.slow(raw, ranks)
        assert [x.tolist() for x in encoder.side_by_side([raw] * 30)] == [last] * 30


def test_appends_and_edits_work_out_little(merges, library):
    encoder, pick = byte_pairs.Encoder(merges, public_tokenizers.PATTERN), random.Random(3)
    for text in odd_texts(60, 20):
        held = encoder.prefixes("")
        for cut in range(0, len(text), 3):
            held.append(text[cut : cut + 3])
            assert held.tokens() == library.encode_ordinary(text[: cut + 3])
        for _ in range(15):
            a, b = sorted(pick.randint(0, len(held.text)) for _ in range(2))
            b, new = min(b, a + 4), "".join(pick.choice(ODD_PARTS) for _ in range(pick.randint(0, 2)))
            want = held.text[:a] + new + held.text[b:]
            held.edit(a, b, new)
            assert held.text == want and held.tokens() == library.encode_ordinary(want)
    for word in ("internationalisation " * 500, "z" * 4000, "ab" * 3000):
        held = encoder.prefixes(word)
        before, middle = held.worked, len(word) // 2
        held.edit(middle, middle + 1, "Q")
        held.append("tail")
        assert held.tokens() == library.encode_ordinary(word[:middle] + "Q" + word[middle + 1 :] + "tail")
        # In runs of one letter, all that follows an edit may be cut at other places.
        assert held.worked - before < 400 or word[0] != "i"


def test_byte_pairs_of_awkward_documents(spark, merges, library):
    docs = data.documents(spark).withColumns({"token_bytes": F.lit("x"), "decoded": F.lit("y"), "reworked": F.lit("z")})
    done = byte_pairs.decode(byte_pairs.encode(docs, merges, public_tokenizers.PATTERN), merges).collect()
    assert len(done) == len(data.ROWS) and done[0].label == "label"
    for r in done:
        assert np.frombuffer(bytes(r.token_bytes), "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")
    edits = "array(named_struct('begin', 2, 'end', 4, 'text', 'new'), named_struct('begin', 9999999, 'end', NULL, 'text', ' end'))"
    edited = byte_pairs.edit(docs.withColumn("edits", F.expr(edits)), merges, public_tokenizers.PATTERN).collect()
    for r, old in zip(sorted(edited, key=lambda r: str(r.doc_id) + r.text), sorted(data.ROWS, key=lambda r: str(r[0]) + (r[1] or "")[:2] + "new" + (r[1] or "")[4:]), strict=True):
        want = (old[1] or "")[:2] + "new" + (old[1] or "")[4:] + " end"
        assert r.text == want and np.frombuffer(bytes(r.token_bytes), "<u4").tolist() == library.encode_ordinary(want)
    for none in (byte_pairs.encode, byte_pairs.edit):
        empty = data.no_documents(spark).withColumn("edits", F.expr(edits))
        assert none(empty, merges, public_tokenizers.PATTERN).count() == 0


def test_byte_pair_query(spark, library):
    texts = {r.doc_id: r.text for r in data.given(spark, "documents").collect()}
    for r in queries.op13_byte_pairs(spark, data.FOLDER).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_vocabularies_that_merges_do_not_make_are_refused():
    every_byte = [bytes([b]) for b in range(256)]
    line = lambda t, i: base64.b64encode(t) + b" " + str(i).encode()
    with pytest.raises(ValueError):
        byte_pairs.load(b"\n".join(line(t, i) for i, t in enumerate([*every_byte, b"abc"])))
    with pytest.raises(ValueError):
        byte_pairs.load(b"\n".join(line(t, i) for i, t in enumerate(every_byte[1:])))
