"""Near copies by ProbMinHash, banding and verification.

A document is the weighted set of its 5-word shingles, weight being how often a shingle occurs. Every shingle
sends arrivals of a Poisson process whose rate is its weight, each to one of the signature's components at
random; a component keeps the shingle that arrives first. Two documents agree in a component with the
probability Jaccard similarity of their weighted sets (Jaccard similarity where no shingle repeats). A
document's shingles stop as soon as their next arrival is later than the latest first arrival.

Bands of components that agree make candidates; these are verified exactly. Exact copies are one node from
the start. In a bucket, all members are first compared with its least node, in chunks of bounded size. Of the
members that are still in different classes, those are compared that share a shingle among the rarest of both:
a similarity of t needs common shingles that hold a share t of either document's weight, so the rarest common
shingle stands among each document's rarest shingles that hold the share 1 - t. If the shingles before it hold
the shares a and b, the similarity is at most (1 - a) (1 - b) / (1 - a b). The same bound is taken with the shares
that lie in places of a bitmap of hashed shingles which the other document leaves empty: collisions only make them
smaller, and so the bound larger. No link is lost by any of this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import has_repeats, running_total
from factloom.llm.components import components
from factloom.llm.text import U64, WindowHasher, mixed, slices, within, words_of
from factloom.sources.workspace import stage

SHINGLE, BANDS, ROWS = 5, 25, 5
#: Places of the bitmap of a document's shingles.
BITS = 4096
#: Text that one comparison task holds beside its centre, about.
CHUNK_BYTES = 4 << 20


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """Document number, hash and weight of every distinct shingle, by document and hash; and the words.

    A text of fewer than five words is one shingle; one without words has none.
    """
    hasher = WindowHasher(4)
    each = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in each], np.int64)
    words = [w for ws in each for w in ws]
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = np.flatnonzero(within(counts, SHINGLE))
    doc = owner[inside]
    hashes = hasher.windows(words, SHINGLE)[inside] if len(inside) else np.empty(0, U64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        doc = np.concatenate([doc, short])
        hashes = np.concatenate([hashes, *[hasher.windows(each[i], len(each[i])) for i in short]])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])) if len(doc) else np.empty(0, np.int64)
    return doc[first], hashes[first], np.diff(np.append(first, len(doc))), each


def signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, count: int, size: int) -> np.ndarray:
    """ProbMinHash signatures, ``count`` x ``size``; 0 for documents without shingles."""
    earliest, sent = np.full(count * size, np.inf), np.zeros(count * size, U64)
    at, clock, step, burst = np.arange(len(doc)), np.zeros(len(doc)), 0, 1
    while len(at):
        steps = np.arange(step + 1, step + burst + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
        drawn = mixed(hashes[at][:, None] + steps)
        gaps = -np.log1p(-(drawn >> U64(11)).astype(np.float64) * 2.0**-53) / weights[at][:, None]
        # Sums run from the last arrival on, one by one, so that they don't depend on the bursts.
        arrivals = np.cumsum(np.column_stack([clock, gaps]), axis=1)[:, 1:]
        limit = earliest.reshape(count, size).max(axis=1)
        use = arrivals <= limit[doc[at]][:, None]
        row = np.broadcast_to(at[:, None], use.shape)[use]
        slot = doc[row] * size + (mixed(drawn[use]) % U64(size)).astype(np.int64)
        when = arrivals[use]
        np.minimum.at(earliest, slot, when)
        won = when == earliest[slot]
        sent[slot[won]] = hashes[row[won]]
        limit = earliest.reshape(count, size).max(axis=1)
        clock = arrivals[:, -1]
        go_on = clock <= limit[doc[at]]
        at, clock, step = at[go_on], clock[go_on], step + burst
        burst = max(1, min(2 * burst, (1 << 20) // max(1, len(at))))
    return sent.reshape(count, size)


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64) * U64(0xD6E8FEB86659FD93), (len(signature), BANDS)).copy()
    for k in range(ROWS):
        keys = mixed(keys * U64(0x9E3779B97F4A7C15) + signature[:, k::ROWS][:, :BANDS])
    return keys.view(np.int64)


def similarity(ha: np.ndarray, ca: np.ndarray, hb: np.ndarray, cb: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets with ascending hashes; 0 if either is empty."""
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    if ca.max() == cb.max() == 1:
        return len(ia) / (len(ha) + len(hb) - len(ia))
    only_a, only_b = np.delete(ca, ia), np.delete(cb, ib)
    x = np.concatenate([ca[ia], only_a, np.zeros(len(only_b))]).astype(float)
    y = np.concatenate([cb[ib], np.zeros(len(only_a)), only_b]).astype(float)
    ratio = np.concatenate([ca[ia] / cb[ib], np.full(len(only_a), np.inf), np.zeros(len(only_b))])
    order = np.argsort(ratio, kind="stable")
    from_here = np.concatenate([np.cumsum(x[order][::-1])[::-1], [0.0]])
    up_to = np.concatenate([[0.0], np.cumsum(y[order])])
    cut = np.searchsorted(ratio[order], ratio[: len(ia)], side="left")
    return float((1 / (from_here[cut] / x[: len(ia)] + up_to[cut] / y[: len(ia)])).sum())


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``copy_key`` (128 bits of the word sequence), ``bytes``, ``bands`` (NULL without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, hashes, weights, each = shingles(batch.column("text").to_pylist())
            keys = band_keys(signatures(doc, hashes, weights, len(batch), BANDS * ROWS))
            joined = [b" ".join(w) for w in each]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([xxhash.xxh3_128_digest(j) for j in joined], pa.binary()),
                    pa.array([len(j) for j in joined], pa.int64()),
                    pa.array([list(k) if j else None for k, j in zip(keys, joined, strict=True)], pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "copy_key", "bytes", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, copy_key binary, bytes long, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of the distinct pairs (``a``, ``b``), those of at least ``threshold`` similarity, with ``similarity``.

    Pairs of the same ``a`` are dealt to chunks by the bytes of their ``b``, so that a task holds a bounded
    number of texts; the text of ``a`` goes once to each chunk. ``texts``: ``node``, ``bytes``, ``text``.
    """
    sized = pairs.join(texts.select(F.col("node").alias("b"), "bytes"), "b")
    parts = sized.groupBy("a").agg((1 + F.floor(F.sum("bytes") / CHUNK_BYTES)).cast("long").alias("parts"))
    chunk = F.pmod(F.xxhash64("b"), F.col("parts"))
    members = pairs.join(parts, "a").select("a", chunk.alias("chunk"), F.col("b").alias("node"))
    centres = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("chunk"), F.col("a").alias("node"))
    held = members.unionByName(centres).join(texts.select("node", "text"), "node")

    def compare(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        doc, hashes, weights, _ = shingles(group.column("text").to_pylist())
        edges = np.searchsorted(doc, np.arange(len(nodes) + 1))
        part = lambda i: (hashes[edges[i] : edges[i + 1]], weights[edges[i] : edges[i + 1]])
        a = group.column("a")[0].as_py()
        centre = part(int(np.flatnonzero(nodes == a)[0]))
        found = [(int(n), s) for i, n in enumerate(nodes) if n != a and (s := similarity(*centre, *part(i))) >= threshold]
        return pa.table(
            {"a": pa.array([a] * len(found), pa.int64()), "b": pa.array([n for n, _ in found], pa.int64()), "similarity": pa.array([s for _, s in found], pa.float64())}
        )

    return held.groupBy("a", "chunk").applyInArrow(compare, "a long, b long, similarity double")


def rarest_shingles(texts: DataFrame, threshold: float) -> DataFrame:
    """(``shingle``, ``node``, ``label``, ``skipped``): each text's rarest shingles that hold the share 1 - threshold.

    ``skipped`` is the share of the text's weight in still rarer ones. Shingles that occur under one label only can link nothing and are left out.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, hashes, weights, _ = shingles(batch.column("text").to_pylist())
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(take), batch.column("label").take(take), pa.array(hashes.view(np.int64)), pa.array(weights)],
                names=["node", "label", "shingle", "weight"],
            )

    rows = texts.select("node", "label", "text").mapInArrow(split, "node long, label long, shingle long, weight long")
    common = rows.groupBy("shingle").agg(F.count("*").alias("n"), (F.min("label") != F.max("label")).alias("links"))
    return rows.join(common, "shingle").selectExpr(
        "*",
        "sum(weight) OVER (PARTITION BY node ORDER BY n, shingle) - weight AS before",
        "sum(weight) OVER (PARTITION BY node) AS total",
    ).where(f"links AND before <= {1 - threshold} * total + 1e-9").selectExpr("shingle", "node", "label", "before / total AS skipped")


def shingle_bits(texts: DataFrame) -> DataFrame:
    """(``node``, ``bits``, ``marked``, ``weight``): a bitmap of the hashed shingles, packed, its ones, and the weight of all shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            doc, hashes, weights, _ = shingles(batch.column("text").to_pylist())
            made = np.zeros((len(batch), BITS), np.uint8)
            made[doc, (mixed(hashes) % U64(BITS)).astype(np.int64)] = 1
            packed = np.packbits(made, axis=1).view(np.int64)
            whole = np.bincount(doc, weights, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(list(packed), pa.list_(pa.int64())), pa.array(made.sum(axis=1, dtype=np.int64)), pa.array(whole)],
                names=["node", "bits", "marked", "weight"],
            )

    return texts.select("node", "text").mapInArrow(run, "node long, bits array<long>, marked long, weight double")


def common_bits_needed(threshold: float) -> str:
    """The least number of common bits with which two documents can be ``threshold`` similar.

    With c common bits, (marked - c) / weight of either document is not in the other. The bound of the similarity,
    which grows with c, reaches the threshold at the greater root of (1 + t) c^2 + q c + r. If r > 0 it does so at 0.
    """
    t = threshold
    q = f"(weight - marked + other_weight - other_marked - {t} * (marked + other_marked))"
    r = f"((weight - marked) * (other_weight - other_marked) - {t} * (weight * other_weight - marked * other_marked))"
    return f"CASE WHEN {r} > 0 THEN 0 ELSE (sqrt({q} * {q} - 4 * (1 + {t}) * {r}) - {q}) / (2 * (1 + {t})) END - 1e-6"


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The class of every document: ``doc_id``, ``text_key``, ``class_id``, ``first`` (whether it opens its class).

    Documents are linked if their similarity reaches ``threshold``, and a class is what links connect. Its id
    is the least doc_id in it (NULL if it has no other). ``first`` holds for the least (doc_id, text_key) of
    the class. A document without words (NULL or empty text included) resembles none and is a class of its
    own. Repeated rows are exact copies and all ``first`` if one of them is. An empty table gives no rows.
    """
    signed = stage(sign(docs), "signed")
    with_words = signed.where("bands IS NOT NULL")
    same = with_words.groupBy("copy_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("rep"),
        F.first("bands").alias("bands"),
        F.first("bytes").alias("bytes"),
    )
    nodes = running_total(
        same.select("copy_key", "bands", "bytes", "rep.none", "rep.doc_id", "rep.text_key", F.lit(1).cast("long").alias("one")),
        [],
        ["none", "doc_id", "text_key"],
        {"node": "one"},
    )
    nodes = stage(nodes.select("copy_key", F.col("node").cast("long").alias("node"), "doc_id", "text_key", "bytes", "bands"), "nodes")

    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    buckets = stage(banded.join(shared, "key"), "buckets")
    involved = buckets.select("node").distinct()
    wanted = nodes.join(involved, "node", "left_semi").select("node", "bytes", F.col("doc_id").alias("want_id"), F.col("text_key").alias("want_key"))
    texts = stage(
        docs.select("doc_id", "text")
        .join(wanted.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col("want_id")) & (F.xxhash64("text") == F.col("want_key")))
        .groupBy("node", "bytes").agg(F.first("text").alias("text")),
        "candidate-texts",
    )

    pairs = buckets.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = stage(verify(stage(pairs, "pairs"), texts, threshold), "verified")
    labels = components(links)

    # What the stars left apart: members of one bucket in different classes that were not compared yet.
    open_ = buckets.where("n > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = open_.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    apart = stage(open_.join(split, "key").where("node <> centre").select("node", "label").distinct(), "apart")
    unlike = texts.join(apart, "node")
    rare = stage(rarest_shingles(unlike, threshold).join(shingle_bits(unlike), "node"), "rarest")
    other = rare.select("shingle", F.col("node").alias("b"), *[F.col(c).alias(f"other_{c}") for c in ("label", "skipped", "bits", "marked", "weight")])
    bound = f"(1 - skipped) * (1 - other_skipped) >= {threshold} * (1 - skipped * other_skipped) - 1e-9"
    common = " + ".join(f"bit_count(element_at(bits, {k}) & element_at(other_bits, {k}))" for k in range(1, BITS // 64 + 1))
    alike = f"node < b AND label <> other_label AND {bound} AND {common} >= {common_bits_needed(threshold)}"
    rest = rare.join(other, "shingle").where(alike).select(F.col("node").alias("a"), "b").distinct()
    rest = stage(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
    more = stage(verify(rest, texts, threshold).select("a", "b"), "verified-rest")
    if not more.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))

    labelled = nodes.select("copy_key", "node", F.col("doc_id").alias("rep_id")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = nodes.select(F.col("node").alias("label"), F.col("doc_id").alias("class_id"), F.col("text_key").alias("head_key"))
    named = labelled.join(heads, "label").select("copy_key", "class_id", "head_key")
    of_words = with_words.select("doc_id", "text_key", "copy_key").join(named, "copy_key")
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("head_key"))
    return of_words.select("doc_id", "text_key", "class_id", first.alias("first")).unionByName(
        signed.where("bands IS NULL").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(True).alias("first"))
    )


def keep_first(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One document of every class of near copies: the least doc_id. Documents without words all stay."""
    firsts = classes(docs, threshold).where("first").select(F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_key")).distinct()
    # Repeated rows of a first document: one stays.
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.where(has_words).dropDuplicates(["doc_id", "text"]).unionByName(docs.where(~has_words)) if has_repeats(docs) else docs
    whole = rows.select(F.struct(*rows.columns).alias("doc"))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("keep_id")) & (F.xxhash64("doc.text") == F.col("keep_key"))
    return whole.join(firsts.hint("shuffle_hash"), same).select("doc.*")
