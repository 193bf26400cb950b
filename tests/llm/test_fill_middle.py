import hashlib
import random
import re

import pytest
from llm_cases import ROWS, docs_of, table
from pyspark.sql import functions as F

from tablewright.llm import fill_middle as fim


def brute(text, doc_id):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("stretch", [1, 2, 3, 7, 1 << 20])
def test_units_against_findall(stretch):
    rng = random.Random(stretch)
    texts = ["", "a", "-", "ab" * 50, "--" * 9, "é漢🙂x\n\0", *["".join(rng.choice("aBz é1\n🙂-") for _ in range(rng.randrange(40))) for _ in range(300)]]
    for t in texts:
        ends = [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", t)]
        units = fim.Units(t, stretch)
        assert units.n == len(ends) and [units.end(k) for k in range(units.n + 1)] == [0, *ends]


def test_long_texts_go_by_stretches():
    text = "word, " * 900_000 + "x" * 3_000_000 + " end"
    units = fim.Units(text)
    assert units.n == 2_700_000 + 3 and units.end(units.n) == len(text) and units.end(units.n - 2) == len(text) - 4


def test_awkward_rows_against_brute_force(spark):
    marks = ["<P>", "x <S> y", "a<M>", "<P", "S>", "<<P", "<S<S<M", "<P" * 9, "M>M>" * 9]
    more = [(100 + i, t) for i, t in enumerate(marks * 12)]
    data = [(i, t, "en", "s", None, *["x"] * 14) for i, t in [*ROWS, *more]]
    out = fim.transform(table(spark, data)).withColumn("back", fim.restored(F.col("text"), F.col("form")))
    got = sorted((repr(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"], r["back"]) for r in out.collect())
    assert got == sorted((repr(i), *brute(t or "", i), t or "") for i, t in [*ROWS, *more])
    assert {g[2] for g in got} == {"plain", "spm", "psm"}
    assert fim.transform(table(spark, [])).count() == 0


def test_stretches_change_nothing(spark):
    docs = docs_of(spark, ["one two, three" * 30, "é" * 50, "", "abc" * 40])
    whole = fim.transform(docs).collect()
    assert sorted(whole, key=repr) == sorted(fim.transform(docs, stretch=5).collect(), key=repr)
