"""Small tables with everything awkward in them."""

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns of the input.
CLASHING = "label score node size slice order rank shard slot item pieces take kept_text n_words n_removed class_id first words url bad".split()

BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, BASE, "en", "a", 1),
    (2, BASE, "en", "a", 1),  # an exact copy
    (3, BASE.replace("w59", "x59"), "en", "b", 1),  # a near copy
    (4, None, "en", "a", None),
    (5, "", None, "a", 0),
    (6, " \t\n ", "en", None, 4),
    (None, "no id at all", "en", None, 12),
    (None, "no id at all", "en", None, 12),  # a repeated row
    (7, "idiot", "en", "z", 5),
    (8, "one two\x0bthree\r\nfour ▁ five\u3000six 日本 \U0001f600", "xx", "\U0001f600", 9),
    (9, " ".join(f"v{i % 977}" for i in range(30_000)), "en", "a", 9),  # very long
    (10, "same same same same same same same same same same\nline\nline\nline", "en", "b", 9),
    (10, "another text of the same id", "en", "b", 9),
    (11, "x" * 3000, "en", "b", 9),
]


def documents(spark, extra=True):
    df = spark.createDataFrame(ROWS, DOCUMENTS)
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if extra else df


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def labels(spark, rows=((1, 1, 0), (7, 0, 1), (7, 0, 1), (None, 1, 1), (3, None, None), (99, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def given(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def words(text):
    return text.encode().split() if text else []
