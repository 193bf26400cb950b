"""Operator 9: document fingerprints, bottom-k sketches of shingle hashes.

A text's fingerprint is the k smallest hashes of its word shingles, in order.
Fingerprints of parts merge into that of the whole, and two fingerprints
estimate resemblance, containment and the number of distinct shingles.
DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, texts_of, written
from tablewright.llm.ordering import positions

#: Words in a shingle, and hashes in a fingerprint.
WORDS, K = 5, 64
_BLANK = r"[ \t\n\x0B\f\r]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of the text's runs of ``words`` words (repeats included).  A text
    with fewer words is one shingle; without words it has none."""
    trimmed = F.regexp_replace(text, rf"^{_BLANK}|{_BLANK}$", "")
    return F.transform(F.array(F.split(trimmed, _BLANK)), lambda w: F.when(
        F.element_at(w, 1) == "", F.array().cast("array<bigint>")).when(
        F.size(w) < words, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))))[0]


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The k smallest distinct shingle hashes, ascending (all, if fewer)."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either text that both have.  Two
    texts without shingles are alike (1)."""
    smallest = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    both = F.size(F.array_intersect(smallest, F.array_intersect(a, b)))
    return F.when(F.size(smallest) == 0, F.lit(1.0)).otherwise(both / F.size(smallest))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The number of distinct shingles: exact below k, estimated from the
    k-th smallest hash's place in the hash range otherwise."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too (1 for a without any)."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j / (1 + j) * (na + nb) / na))


def merge_sketches(parts: DataFrame, key: str, sketch_col: str, k: int = K, fan_in: int = 64) -> DataFrame:
    """One sketch for each key from those of its parts; a key whose parts are
    all empty (or null) has an empty one, and a null key is a key.

    Sketches are merged in rounds of about ``fan_in`` parts each, so a key with
    very many parts is merged by many tasks, and no task holds more than about
    that many of its sketches at once."""
    most = parts.groupBy(key).count().agg(F.max("count")).first()[0] or 1
    value = F.coalesce(F.col(sketch_col), F.array().cast("array<bigint>"))
    rows = parts.select(key, value.alias(sketch_col))
    while True:
        lots = -(-most // fan_in)
        lot = free_name(rows, "lot")
        dealt = rows.withColumn(lot, F.pmod(F.monotonically_increasing_id(), F.lit(lots)) if lots > 1 else F.lit(0))
        rows = dealt.groupBy(key, lot).agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list(sketch_col)))), 1, k).alias(sketch_col)).drop(lot)
        if lots == 1:
            return rows
        rows, most = written(rows, "sketches"), lots


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def edited_fingerprints(docs: DataFrame, k: int = K, words: int = WORDS,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, the estimates n_shingles and
    in_edited (containment in the edited text), and next_doc_id.

    The edited text is the text with its last floor(n_chars / 2) characters
    replaced by as many from the start of the next document's text (or all of
    it), next in descending doc_id, the first after the last.  Null texts count
    as empty; a null doc_id comes last.  Rows with the same doc_id are ordered
    by their text's hash, and rows that also share the text count as one
    document in this order.  A single document follows itself.

    Each text moves once, to where its row of the order is, and from there the
    stretch that the document before it needs."""
    # a document is its id and 128 bits of its text's hash: one key that is never null, so that joins and the
    # aggregate below share a partitioning, and binary, as random hex does not compress
    base = (texts_of(docs, id_col, text_col).withColumn("sha", F.expr("substring(unhex(sha2(text, 256)), 1, 16)"))
            .withColumn("key", F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit("/").cast("binary"), "sha")))
    own = base.select("key", "doc_id", "sha", F.char_length("text").alias("n")).distinct()
    placed = positions(own, F.col("doc_id").desc_nulls_last(), F.col("sha"))
    total = placed.count()
    follows = placed.select(F.pmod(F.col("position") - 1, F.lit(max(total, 1))).alias("position"), F.col("key").alias("next_key"))
    wanted = placed.join(follows, "position").select("next_key", F.col("key").alias("to_key"), F.expr("n div 2").cast("int").alias("half"))
    texts = base.select("key", "doc_id", "text")  # both joins below use all three, so one shuffle serves both
    # rows repeated whole give the same stretch; one of them is enough
    given = (texts.join(wanted, F.col("key") == F.col("next_key"))
             .select("to_key", "half", F.col("doc_id").alias("next_doc_id"), F.expr("substring(text, 1, half)").alias("stretch"), sketch(F.col("text"), k, words).alias("next_sketch")))
    once = given.groupBy("to_key").agg(*[F.first(c).alias(c) for c in ("half", "next_doc_id", "stretch", "next_sketch")])
    both = texts.join(once, F.col("key") == F.col("to_key"))
    both = both.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), sketch(F.col("text"), k, words).alias("a"),
                       F.expr("concat(substring(text, 1, char_length(text) - half), stretch)").alias("edited"), "next_sketch", "next_doc_id")
    sketched = both.select("doc_id", "n_chars", "a", "next_doc_id", F.sha2("edited", 256).alias("edited_sha256"),
                           sketch(F.col("edited"), k, words).alias("b"), "next_sketch")
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b"), k).alias("near_edited"), resemblance(F.col("a"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("a"), k).alias("n_shingles"), containment(F.col("a"), F.col("b"), k).alias("in_edited"), "next_doc_id")
