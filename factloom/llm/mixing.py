"""Mixing sources to target weights by a low-discrepancy schedule.

The targets are shares of the unit interval. The points of a golden-ratio sequence fall into them, one for
each slot of the mix, so that every stretch of the schedule has its sources in nearly the right shares. The
slots of a source are ranked; the source's documents, in a seeded order, form a stream that is cut into
blocks of equal numbers of words; slot rank r takes block r. A stream that ends starts again, up to the
limit of repeats that the targets respect.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import GAP, has_repeats, running_total, word_count
from factloom.sources.workspace import stage

#: Points of the schedule: i * GOLDEN mod 2**31, where GOLDEN is 2**31 over the golden ratio, made odd.
PERIOD, GOLDEN = 2**31, 1327217885


def source_targets(sources: DataFrame, factor: float, weights: Sequence[float], most: float) -> DataFrame:
    """Adds ``source_no`` (by code point, NULL last) and ``target`` to (``source``, ``source_size``) rows.

    The sources share ``factor`` times all sizes by weight; a target stops at ``most`` times its source's
    size, and the excess is shared again by weight until no target is above. That is one water level L with
    target = min(most * size, L * weight): by rising most * size / weight, the sources that stop are the
    first ones, and the level follows from what is left after them.
    """
    ranked = running_total(
        sources.select("source", "source_size", F.col("source").isNull().alias("none"), F.lit(1).alias("one")),
        [],
        ["none", "source"],
        {"source_no": "one"},
    ).select("source", "source_size", F.col("source_no").cast("long").alias("source_no"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int")
    )
    weighed = ranked.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    levels = stage(
        running_total(
            weighed.withColumn("stops_at", F.col("limit") / F.col("weight")),
            [],
            ["stops_at", "source_no"],
            {"limits_before": "limit", "weights_before": "weight"},
        ),
        "levels",
    )
    total, weighing = levels.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted, weighing = factor * (total or 0), weighing or 0.0
    # The level if this source is the first that does not stop; the first whose level is within its stop is it.
    level = (F.lit(wanted) - F.col("limits_before")) / (F.lit(weighing) - F.col("weights_before"))
    # After the first such source the expression stays below the stops, so the least of them is the level.
    found = levels.where(level <= F.col("stops_at")).agg(F.min_by(level, F.struct("stops_at", "source_no"))).first()[0]
    target = F.col("limit") if found is None else F.least("limit", found * F.col("weight"))
    return levels.select("source", "source_no", "source_size", target.cast("double").alias("target"))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """The slots of the mix: ``slot``, ``source_no``, ``rank`` (from 0 within the source), ``words`` to take.

    A source gets ceil(target / block_words) slots, the last one shortened to its rounded target. Points that
    fall to a source beyond that are passed over; what a source lacks after the last point follows at the end
    (both are few, as the sequence's discrepancy grows with the logarithm of its length).
    """
    need = targets.select(
        "source_no",
        F.round("target").cast("long").alias("goal"),
        F.ceil(F.round("target") / block_words).cast("long").alias("need"),
        "target",
    ).where("goal > 0")
    need = stage(running_total(need, [], ["source_no"], {"before": "target", "slots_before": "need"}), "shares")
    points, total, count = need.agg(F.sum("need"), F.sum("target"), F.count("*")).first()
    points, total = points or 0, total or 1.0
    grid = 2 ** math.ceil(math.log2(4 * count + 1))
    cell = lambda x: F.floor(x * grid).cast("long")
    # A share lies in the cells of a grid; a point looks only at the shares of its own cell.
    shares = need.select(
        "source_no",
        (F.col("before") / total).alias("low"),
        ((F.col("before") + F.col("target")) / total).alias("high"),
    ).withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    at = F.pmod((F.pmod("id", F.lit(PERIOD)) + 1) * GOLDEN, F.lit(PERIOD)) / PERIOD
    hit = (
        targets.sparkSession.range(points)
        .select(F.col("id").alias("slot"), at.alias("at"))
        .withColumn("cell", cell(F.col("at")))
        .join(shares, "cell")
        .where("at >= low AND at < high")
        .select("slot", "source_no", F.lit(1).cast("long").alias("one"))
    )
    ranked = stage(running_total(hit, ["source_no"], ["slot"], {"rank": "one"}).drop("one"), "ranked")
    had = ranked.groupBy("source_no").agg(F.count("*").alias("had"))
    late = (
        need.join(had, "source_no", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .where("had < need")
        .select(
            "source_no", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("rank"), "slots_before"
        )
        .select((points + F.col("slots_before") + F.col("rank")).alias("slot"), "source_no", "rank")
    )
    words = F.least(F.lit(block_words), F.col("goal") - F.col("rank") * block_words)
    return (
        ranked.unionByName(late)
        .join(need.select("source_no", "goal", "need"), "source_no")
        .where("rank < need")
        .select("slot", "source_no", "rank", words.cast("long").alias("words"))
    )


def mix(
    docs: DataFrame,
    factor: float = 1.5,
    weights: Sequence[float] = (5, 2, 1),
    most: float = 2.0,
    block_words: int = 1024,
    seed: int = 1,
) -> DataFrame:
    """The mix, as the pieces of documents that its slots take, together with documents that it leaves out.

    Columns: ``row_key`` (with ``source_no``, unique for documents that have words), ``doc_id``, ``text_key``
    (xxhash64 of the text), ``source_no``, ``size`` (words), ``source_size``, ``target``; and for a taken
    piece ``slot``, ``pass`` (0 for the first time), ``first_word`` and ``words``; NULL where nothing is taken.
    NULL text has no words, NULL source is a source of its own (the last), and documents without words are
    never taken. Repeated rows are separate documents. An empty table gives an empty mix.
    """
    rows = stage(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key")
        ),
        "words",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sources, factor, weights, most), "targets")
    mixed = rows.withColumn("mixed", F.xxhash64(F.lit(seed), "doc_id", "text_key"))
    stream = running_total(mixed, ["source"], ["mixed", "doc_id", "text_key"], {"row_key": "size"})
    known = targets.withColumnRenamed("source", "known_source")
    stream = stream.join(known, F.col("source").eqNullSafe(F.col("known_source")), "left")
    again = F.sequence(F.lit(0), F.greatest(F.ceil(F.round("target") / F.col("source_size")) - 1, F.lit(0)).cast("int"))
    pieces = (
        stream.withColumn("pass", F.explode(F.when(F.col("size") > 0, again).otherwise(F.array(F.lit(0)))))
        .withColumn("start", F.col("row_key") + F.col("pass") * F.col("source_size"))
        .withColumn("end", F.col("start") + F.col("size"))
        .withColumn(
            "rank",
            F.explode_outer(
                F.when(
                    F.col("size") > 0,
                    F.sequence(
                        F.floor(F.col("start") / block_words).cast("long"),
                        F.floor((F.col("end") - 1) / block_words).cast("long"),
                    ),
                )
            ),
        )
    )
    slots = schedule(targets, block_words)
    low = F.greatest(F.col("start"), F.col("rank") * block_words)
    high = F.least(F.col("end"), F.col("rank") * block_words + F.col("take"))
    return (
        pieces.join(slots.withColumnRenamed("words", "take"), ["source_no", "rank"], "left")
        .withColumn("words", F.when(F.col("slot").isNotNull(), F.greatest(high - low, F.lit(0))))
        .withColumn("first_word", low - F.col("start"))
        .select(
            "row_key", "doc_id", "text_key", "source_no", "size", "source_size", "target",
            "slot", "pass", "first_word", "words",
        )
    )


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: ``size``, ``source_size``, ``target`` of its source, and words ``taken``."""
    return (
        mix(docs, **options)
        .groupBy("source_no", "row_key", "doc_id", "text_key", "size", "source_size", "target")
        .agg(F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"), F.count("*").alias("pieces"))
        # Rows without words can be told apart by nothing; each was one piece.
        .withColumn("copy", F.explode(F.when(F.col("size") == 0, F.sequence(F.lit(1), F.col("pieces"))).otherwise(F.array(F.lit(1).cast("long")))))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, in the columns of ``docs``: a row for each time that a document is taken.

    A document that the target cuts short keeps its first words, one space between them.
    """
    taken = (
        mix(docs, **options)
        .where("words > 0")
        .groupBy("source_no", "row_key", "doc_id", "text_key", "size", "pass")
        .agg(F.sum("words").alias("take"))
        .select(
            F.col("doc_id").alias("take_id"), F.col("text_key").alias("take_key"),
            F.struct("source_no", "row_key", "pass").alias("take_no"), "size", "take",
        )
    )
    # Rows that agree in id and text were taken separately; each finds one of them here.
    rows = docs.dropDuplicates(["doc_id", "text"]) if has_repeats(docs) else docs
    whole = rows.select(F.struct(*docs.columns).alias("doc"))
    words = F.split(F.regexp_replace("doc.text", f"^{GAP}", ""), GAP)
    short = F.array_join(F.slice(words, F.lit(1), F.col("take").cast("int")), " ")
    same = F.col("doc.doc_id").eqNullSafe(F.col("take_id")) & (F.xxhash64("doc.text") == F.col("take_key"))
    joined = whole.join(taken.hint("shuffle_hash"), same).withColumn(
        "kept_text", F.when(F.col("take") >= F.col("size"), F.col("doc.text")).otherwise(short)
    )
    values = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return joined.select(*[values.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
