import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from llm_cases import ROWS, table
from pyspark.sql import functions as F
from tablewright.llm import fingerprints, hilbert, license_scan, ordering, toxicity
from tablewright.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def template_scan(text):
    """Labels of templates whose words stand in a text word by word."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    joined = f" {' '.join(WORD.findall(low))} "
    return {label for phrase, label in license_scan.TEMPLATES.items() if f" {phrase} " in joined}


def held(row):
    return row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]


def test_license_query_against_brute_force(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = QUERIES["op2_license_scan"](spark, sf_small).collect()
    assert len(got) == len(texts)
    for r in got:
        assert held(r) == base_scan(texts[r["doc_id"]])
        labels = set(filter(None, r["labels"].split(",")))
        assert set(filter(None, r["base_labels"].split(","))) | template_scan(texts[r["doc_id"]]) <= labels
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
    assert any(r["labels"] for r in got)


def test_license_awkward_rows(spark):
    got = license_scan.scan(table(spark)).collect()
    assert sorted(map(str, map(held, got))) == sorted(str(base_scan(t)) for _, t in ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[15]["n_base"] == 3 and by_id[16]["labels"] == "cc-by,gpl,reserved"
    assert by_id[17]["labels"] == "mit" and by_id[17]["base_labels"] == "" and by_id[17]["score"] == 1.0  # one word put in
    assert by_id[5]["labels"] == "" and by_id[5]["score"] == 0
    assert license_scan.scan(table(spark, [])).count() == 0


def test_license_with_words_put_in(spark):
    """Three words put in, also beside pairs that stand there by chance or a second place."""
    apache, mit = "licensed under the terms of the Apache License, Version 2.0", "Released under the terms of the MIT license."
    texts = {1: (f"It is {apache}.", "apache-2.0"), 2: (mit, "mit"), 3: (f"{mit} {mit} x {apache} {apache}", "apache-2.0,mit"),
             4: ("under the under the licensed under the apache license version 2.0 version 2 license version", "apache-2.0"),
             5: ("released under the mit a b c d license", "mit"), 6: ("released under the very long and other terms of the mit license", ""),
             7: ("the MIT license. Released under the GPL", "")}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert {i: r["labels"] for i, r in got.items()} == {i: labels for i, (_, labels) in texts.items()}
    assert [(s["label"], s["start"], s["end"]) for s in got[1]["spans"]] == [("apache-2.0", 2, 12)]
    assert [(s["label"], s["start"], s["end"]) for s in got[4]["spans"]] == [("apache-2.0", 4, 11)]
    assert [s["label"] for s in got[3]["spans"]] == ["apache-2.0", "apache-2.0", "mit", "mit"]


def test_license_identifiers_and_openings(spark):
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    texts = ["Licensed under Apache-2.0", "// SPDX-License-Identifier: MIT", 'THE SOFTWARE IS PROVIDED "AS IS"', "GPL-3.0-or-later", "LGPL-3.0-or-later",
             f"{isc}, provided that the above copyright notice and this permission notice appear in all copies.", "Licensed under Apache-1.0",
             "SPDX-License-Identifier: GPL-2.0-only", "the software is good", "version 3.0 or later"]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == ["apache-2.0", "mit", "as-is", "gpl-3.0-or-later", "lgpl-3.0-or-later", "isc", "", "gpl-2.0-only", "", ""]


def edited(words, kind, rng):
    """A body with words put in, cut out or reworded, one in twenty."""
    out = []
    for w in words:
        if rng.random() >= 0.05:
            out.append(w)
        elif kind == "put in":
            out += [w, f"new{rng.randrange(999)}"]
        elif kind == "reworded":
            out.append(f"other{rng.randrange(999)}")
    return out


def test_license_bodies_edited(spark):
    """Bodies among other words, one word in twenty changed: nine in ten at least are found, and no label but theirs."""
    rng, rows, expected = random.Random(5), [], {}
    bodies = [(WORD.findall(text.lower()), label) for text, label in license_scan.BODIES.items() if len(text.split()) > 20]
    for kind in ("whole", "put in", "cut", "reworded"):
        for words, label in bodies:
            for _ in range(1 if kind == "whole" else 5):
                own = words if kind == "whole" else edited(words, kind, rng)
                around = [[f"w{rng.randrange(500)}" for _ in range(40)] for _ in range(2)]
                expected[len(rows)] = (kind, label)
                rows.append((len(rows), " ".join([*around[0], *own, *around[1]]).upper()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for k in (2, 3):
        got = {r["doc_id"]: r for r in license_scan.scan(docs, k=k).collect()}
        for kind in ("whole", "put in", "cut", "reworded"):
            of_kind = [i for i, e in expected.items() if e[0] == kind]
            found = sum(expected[i][1] in got[i]["labels"].split(",") for i in of_kind)
            assert found >= (1 if kind == "whole" else 0.9) * len(of_kind), (k, kind, found, len(of_kind))
        assert all(s["start"] >= 38 for r in got.values() for s in r["spans"])


def test_license_templates_as_a_table(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one two x three four"), (3, "one two three five")], "doc_id long, text string")
    templates = spark.createDataFrame([("a", "One, two; three four.", 1.0), ("b", "two three", None), ("b", "two three", None)], "label string, text string, least double")
    got = {r["doc_id"]: (r["labels"], len(r["spans"])) for r in license_scan.scan(docs, templates=templates).collect()}
    assert got == {1: ("a,b", 2), 2: ("a", 1), 3: ("b", 1)}
    with pytest.raises(Exception, match="two words"):
        license_scan.scan(docs, templates={"one": "x"}).collect()
    none = license_scan.scan(docs, base={}, templates=templates.limit(0)).collect()
    assert sorted((r["doc_id"], r["labels"], r["n_words"]) for r in none) == [(1, "", 4), (2, "", 5), (3, "", 4)]


def test_license_letters_that_fold_onto_ascii(spark):
    docs = spark.createDataFrame([(1, "all rights reſerved"), (2, "PUBLIC general public licenİse"), (3, "Kind of MOZILLA public license")], "doc_id long, text string")
    phrases = {"kind of mozilla": "x"}
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(docs, templates=phrases).collect()}
    assert got == {1: "", 2: "", 3: ""}


@pytest.mark.parametrize("dims,bits", [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_curve_is_a_hilbert_curve(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side ** dims).select(*[F.expr(f"cast(id div {side ** k} % {side} as int)").alias(f"c{k}") for k in range(dims)])
    got = cells.withColumn("h", hilbert.curve_index([F.col(f"c{k}") for k in range(dims)], bits)).collect()
    at = {r["h"]: tuple(r[f"c{k}"] for k in range(dims)) for r in got}
    assert set(at) == set(range(side ** dims))
    assert all(sum(abs(x - y) for x, y in zip(at[i], at[i + 1])) == 1 for i in range(side ** dims - 1))


def check_shards(got, n, shards):
    sizes = [0] * shards
    slots = [[] for _ in range(shards)]
    for r in got:
        sizes[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_shards(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = QUERIES["op5_hilbert_sharding"](spark, sf_small).collect()
    check_shards(got, len(texts), 40)
    import zlib
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
    # runs of the curve: shards do not overlap on it
    spans = sorted((r["shard"], r["curve"]) for r in got)
    assert [c for _, c in spans] == sorted(c for _, c in spans)


def test_shards_awkward_rows(spark, tmp_path):
    docs = table(spark)
    sharded = hilbert.shard(docs, ["text", "source", "lang"], shards=5)
    check_shards(sharded.collect(), len(ROWS), 5)
    check_shards(hilbert.shard(docs, ["n_chars"], shards=100).collect(), len(ROWS), 100)
    assert hilbert.shard(table(spark, []), ["text", "source"]).count() == 0
    assert hilbert.write_shards(docs, ["text", "source", "lang"], str(tmp_path / "out"), shards=5) == "shard"
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and set(docs.columns) < set(back.columns)


def test_written_shards_of_repeated_rows_and_taken_names(spark, tmp_path):
    rows = [(1, "the same", "s", k, k) for k in (7,) * 30] + [(i, f"text {i}", "t", i, i) for i in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Shard string, row_number int, slot_number int").repartition(4)
    name = hilbert.write_shards(docs, ["text"], str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert name.lower() not in {c.lower() for c in docs.columns}
    assert sorted(tuple(r) for r in back.select(*docs.columns).collect()) == sorted(rows)
    assert [r["count"] for r in back.groupBy(name).count().collect()] == [10] * 5


def test_many_equal_rows_span_ranges(spark, monkeypatch):
    from tablewright.llm import ordering
    kept = []
    monkeypatch.setattr(ordering, "written", lambda df, label, of=ordering.written: kept.append(of(df, label)) or kept[-1])
    got = ordering.positions(spark.range(4000).select((F.col("id") % 2).alias("x")), F.col("x"))
    assert sorted(r["position"] for r in got.collect()) == list(range(4000))
    assert kept[0].groupBy("__range").count().agg(F.max("count")).first()[0] < 1000


def test_merged_sketches_keep_every_key(spark):
    rows = [("a", [3, 9]), ("a", [1, 9]), ("b", []), ("c", None), (None, [5])] + [("many", [i, i + 1]) for i in range(500)]
    parts = spark.createDataFrame(rows, "key string, s array<bigint>").repartition(5)
    got = {r["key"]: r["s"] for r in fingerprints.merge_sketches(parts, "key", "s", 3, fan_in=4).collect()}
    assert got == {"a": [1, 3, 9], "b": [], "c": [], None: [5], "many": [0, 1, 2]}


def test_training_sample_holds_one_row_of_an_id(spark):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text")).unionByName(
        spark.createDataFrame([(2, "some other words")], "doc_id long, text string"))
    seen = []
    fit = toxicity.fit_chain
    toxicity.fit_chain = lambda rows, labels, folds, *a: seen.append(len(rows)) or fit(rows, labels, folds, *a)
    try:
        toxicity.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    finally:
        toxicity.fit_chain = fit
    assert seen == [2]


def test_text_dimension_with_a_common_beginning(spark):
    """Sources that begin alike still lie apart on the curve, in their order; nulls come first."""
    docs = spark.range(640).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
                                   F.when(F.col("id") % 16 > 0, F.format_string("https://common_crawl_%02d", F.col("id") % 16)).alias("source"))
    got = hilbert.shard(docs, ["source"], shards=16).collect()
    check_shards(got, 640, 16)
    assert all(r["shard"] == r["doc_id"] % 16 for r in got)
    assert len({r["curve"] for r in got}) == 16


def test_positions_of_a_hot_value(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("hot"), "id").repartition(7)
    got = {r["id"]: r["position"] for r in ordering.positions(df, F.col("hot"), F.xxhash64("id"), F.col("id")).collect()}
    assert sorted(got.values()) == list(range(5000))
    assert max(p for i, p in got.items() if i % 3) < min(p for i, p in got.items() if i % 3 == 0)


def py_sketch(text, k=fingerprints.K):
    words = [w for w in re.split(r"[ \t\n\x0B\f\r]+", text) if w]

    def h(parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p.encode(), seed)
        return seed - (1 << 64) if seed >> 63 else seed
    if not words:
        return []
    if len(words) < 5:
        return [h([" ".join(words)])]
    return sorted({h(words[i:i + 5]) for i in range(len(words) - 4)})[:k]


def likeness(a, b, k=fingerprints.K):
    smallest = sorted(set(a) | set(b))[:k]
    return len(set(smallest) & set(a) & set(b)) / len(smallest) if smallest else 1.0


def brute_fingerprints(rows):
    def key(r):
        return r[0] is not None, r[0] or 0, [-x for x in hashlib.sha256((r[1] or "").encode()).hexdigest().encode()]
    distinct = sorted({(i, t or "") for i, t in rows}, key=key, reverse=True)
    out = {}
    for n, (i, t) in enumerate(distinct):
        follows = distinct[(n + 1) % len(distinct)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + follows[:half]
        a, b, c = py_sketch(t), py_sketch(edited), py_sketch(follows)
        out[i, t] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{h & (1 << 64) - 1:016x}" for h in a),
                     "".join(f"{h & (1 << 64) - 1:016x}" for h in b), likeness(a, b), likeness(a, c))
    return out


@pytest.mark.parametrize("awkward", [True, False])
def test_fingerprints_against_brute_force(spark, sf_small, awkward):
    if awkward:
        rows, got = ROWS, fingerprints.edited_fingerprints(table(spark)).collect()
    else:
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
        got = QUERIES["op9_fingerprints"](spark, sf_small).collect()
    want = brute_fingerprints(rows)
    own = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in got]
    assert sorted(map(str, own)) == sorted(str((i, *want[i, t or ""])) for i, t in rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["in_edited"] <= 1 for r in got)


def test_fingerprints_of_few_rows(spark):
    assert fingerprints.edited_fingerprints(table(spark, [])).count() == 0
    alone = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "only one here")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0


def test_sketch_estimates_and_merge(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(6000)]
    whole, half = " ".join(words), " ".join(words[:3000])
    df = spark.createDataFrame([(whole, half)], "a string, b string").select(*[fingerprints.sketch(F.col(c), 256).alias(c) for c in "ab"])
    r = df.select(fingerprints.resemblance(F.col("a"), F.col("b"), 256).alias("j"), fingerprints.containment(F.col("b"), F.col("a"), 256).alias("c"),
                  fingerprints.distinct_shingles(F.col("a"), 256).alias("n")).first()
    assert abs(r["j"] - 0.5) < 0.12 and r["c"] > 0.8 and abs(r["n"] / 5996 - 1) < 0.2
    parts = spark.createDataFrame([("k", " ".join(words[i:i + 504])) for i in range(0, 5996, 500)], "key string, t string").select(
        "key", fingerprints.sketch(F.col("t"), 256).alias("s"))
    assert fingerprints.merge_sketches(parts, "key", "s", 256).first()["s"] == df.first()["a"]


def planted(rng, n):
    words = [f"plain{i}" for i in range(400)]
    texts, labels = [], []
    for _ in range(n):
        own = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 4)):
                own[rng.randrange(len(own))] = rng.choice(["idiot!", "Trash.", "moronic", "moronhaft", "pathetic"])
        texts.append(" ".join(own))
        labels.append(int(toxic))
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = planted(random.Random(1), 1200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    known = spark.createDataFrame([(i, y) for i, y in enumerate(labels) if i < 800], "doc_id long, toxic int")
    chain = toxicity.train(docs, known)
    assert chain.categories == ["kind_1", "kind_2", "toxic"] and [len(m.earlier) for m in chain.models] == [0, 1, 2]
    got = {r["doc_id"]: r for r in toxicity.score(docs, chain).collect()}
    wrong = [i for i in range(800, 1200) if got[i]["toxic"] != bool(labels[i])]
    assert len(wrong) <= 4
    left = {r["doc_id"] for r in toxicity.drop_toxic(docs, chain).collect()}
    assert left == {i for i, r in got.items() if not r["toxic"]}


def test_toxicity_kinds_of_another_vocabulary(spark):
    """The earlier categories come from the labelled rows, whatever their words."""
    rng = random.Random(6)
    swap = {"idiot!": "zorgul!", "Trash.": "Blenkat.", "moronic": "vrastish", "moronhaft": "vrasthaft", "pathetic": "quombic"}
    texts, labels = planted(rng, 900)
    texts = [" ".join(swap.get(w, w) for w in t.split()) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    chain = toxicity.train(docs, spark.createDataFrame([(i, y) for i, y in enumerate(labels) if i < 600], "doc_id long, toxic int"))
    assert chain.categories == ["kind_1", "kind_2", "toxic"] and all(len(m.numbers) for m in chain.models)
    got = {r["doc_id"]: r for r in toxicity.score(docs, chain).collect()}
    for name in ("p_kind_1", "p_kind_2"):
        high = [i for i in range(600, 900) if got[i][name] >= 0.5]
        assert len(high) >= 10 and all(labels[i] for i in high)
    assert sum(got[i]["toxic"] != bool(labels[i]) for i in range(600, 900)) <= 4


def test_earlier_categories_reach_later_models():
    rng = np.random.default_rng(4)
    first = rng.integers(0, 2, 600)
    rows = [np.array([10 if y else 20]) for y in first]
    chain = toxicity.fit_chain(rows, {"a": first, "b": first}, np.arange(600) % 5)
    assert chain.models[1].earlier[0] > 0.5
    assert chain.score([10])[1] > 0.9 and chain.score([20])[1] < 0.1


def test_toxicity_awkward_tables(spark):
    docs = table(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 0), (99999, 1)], "doc_id long, toxic int")
    for labels in (none, odd):
        chain = toxicity.train(docs, labels)
        got = toxicity.score(docs, chain).collect()
        assert len(got) == len(ROWS) and not any(r["toxic"] for r in got)
        assert toxicity.drop_toxic(docs, chain).count() == len(ROWS)
        assert toxicity.drop_toxic(docs, chain).columns == docs.columns
    assert toxicity.score(table(spark, []), chain).count() == 0


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fit = spark.createDataFrame([(i, y) for i, y in labels.items() if i % 2], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, toxicity.train(docs, fit)).collect()}
    held_out = [i for i in labels if not i % 2]
    missed = sum(labels[i] and not got[i] for i in held_out)
    false = sum(got[i] and not labels[i] for i in held_out)
    # about a tenth of the labels called toxic stand on text without anything toxic in it
    assert missed <= 0.15 * sum(labels[i] for i in held_out) and false <= 0.005 * len(held_out)
