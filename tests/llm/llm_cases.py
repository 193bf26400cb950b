"""Small tables that hold every awkward case at once, for all operators."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns named as operators name their own
    *[T.StructField(c, T.StringType()) for c in ("key", "node", "sha", "rid", "n", "position", "label", "chunk", "recipe", "size", "kept", "toxic", "a", "b")],
])

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = "\n".join(f"this passage is shared line {i} of several documents" for i in range(12))
BASE = " ".join(f"token{i}" for i in range(60))

ROWS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " changed at the end"), (4, BASE.replace("token30", "other")),
    (5, None), (6, ""), (7, "   \n\t "), (8, "one two"), (9, "ONE two"), (10, LONG), (11, LONG + " tail"),
    (12, "before it\nmore before\n" + PASSAGE + "\nafter a\nafter b"), (13, "head of other\n" + PASSAGE), (14, PASSAGE),
    (15, "cc by cc-by CC  BY"), (16, "General Public License; All rights reserved. cc by"),
    (17, "permission is hereby granted free of charge to any other person obtaining a copy"),
    (None, "a row without an id says this much"), (18, None), (19, "same id"), (19, "but another text"),
    (20, "é Kelvin K <|endoftext|> it's we've  two\r\n\r\nlines"), (21, "x" * 5000), (22, "ab" * 4000),
    (23, "naïve café non-break 漢字 🙂🙂"), (-5, "negative id"), (2**62, "large id"),
]


def rows():
    return [(i, t, "en" if i else None, f"src{(i or 0) % 3}", len(t) if t else None, *["x"] * 14) for i, t in ROWS]


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def docs_of(spark, texts):
    return table(spark, [(i, t, "en", "s", None, *["x"] * 14) for i, t in enumerate(texts)])
