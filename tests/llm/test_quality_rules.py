import math
import random
import re
from collections import Counter

from llm_cases import ROWS, docs_of, table
from pyspark.sql import functions as F

from tablewright.llm import queries
from tablewright.llm import quality_rules as Q

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    w = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered),
            "n_capitals": len(re.findall("[A-Z]", text)), "n_shouts": text.count("!"),
            "n_plain": sum(bool(re.fullmatch(r"[^\W\d_]+[.,;:?!]?", x)) for x in w), "n_ends": sum(x[-1] in ".?!" for x in w),
            "n_distinct": len(set(w))}


def test_statistics_against_brute_force(spark):
    rng = random.Random(12)
    texts = ["a b c d e " * 9, "a b c d", "x\nx\n\n x\nx", "###|A!!\n!!", "a b c d e f a b c d e", "a a a a a a", "a a a a a",
             *["".join(rng.choice(["a ", "b ", "c ", "\n", "A! ", "<x ", "é. "]) for _ in range(rng.randrange(80))) for _ in range(150)]]
    data = [(i, t, "en", "s", None, *["x"] * 14) for i, t in [*ROWS, *enumerate(texts, 1000)]]
    got = Counter(tuple(r.asDict().items()) for r in Q.statistics(table(spark, data)).collect())
    assert got == Counter(tuple(({"doc_id": r[0]} | brute(r[1] or "")).items()) for r in data)


def plain_em(ballots, rules, rounds=Q.ROUNDS):
    share, fg, fb, ag, ab = Q.SHARE, [Q.FOR_GOOD] * rules, [Q.FOR_BAD] * rules, [Q.AGAINST_GOOD] * rules, [Q.AGAINST_BAD] * rules

    def good(votes):
        z = math.log(share / (1 - share))
        for j, v in enumerate(votes):
            z += max(math.log(fg[j] / fb[j]), 0) if v == 1 else min(math.log(ag[j] / ab[j]), 0) if v == -1 else 0
        return 1 / (1 + math.exp(-z))

    for _ in range(rounds):
        q = {v: good(v) for v in ballots}
        g, n = sum(q[v] * c for v, c in ballots.items()), sum(ballots.values())

        def rate(believed, vote, j, weight, whole, n=n):
            return (Q.SEEN * believed + sum(weight(v) * c for v, c in ballots.items() if v[j] == vote)) / (Q.SEEN + whole)

        share = (Q.SEEN * Q.SHARE + g) / (Q.SEEN + n)
        fg = [rate(Q.FOR_GOOD, 1, j, lambda v: q[v], g) for j in range(rules)]
        fb = [rate(Q.FOR_BAD, 1, j, lambda v: 1 - q[v], n - g) for j in range(rules)]
        ag = [rate(Q.AGAINST_GOOD, -1, j, lambda v: q[v], g) for j in range(rules)]
        ab = [rate(Q.AGAINST_BAD, -1, j, lambda v: 1 - q[v], n - g) for j in range(rules)]
    return share, fg, fb, ag, ab


def test_model_against_plain_em(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(2000):
        bad = rng.random() < 0.2
        rows.append([(-1 if rng.random() < (0.6 if bad else 0.03) else 1 if rng.random() < (0.2 if bad else 0.7) else 0) for _ in range(4)])
    model = Q.fit(spark.createDataFrame([(r,) for r in rows], "votes array<int>"), 4)
    share, *rates = plain_em(Counter(map(tuple, rows)), 4)
    assert abs(model.share - share) < 1e-9 and abs(share - 0.8) < 0.05
    for mine, theirs in zip((model.for_good, model.for_bad, model.against_good, model.against_bad), rates, strict=True):
        assert all(abs(a - b) < 1e-9 for a, b in zip(mine, theirs, strict=True))
    assert all(b > 0.4 > 0.1 > g for g, b in zip(model.against_good, model.against_bad, strict=True))


def test_verdicts_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = queries.op12_quality_rules(spark, sf).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert len(good) > 200 and len(bad) > 20
    assert sum(good) / len(good) >= 0.97 and sum(bad) / len(bad) <= 0.1
    assert not any(r["kept"] for r in rows if r["base_failed"])


def test_awkward_rows_and_own_rules(spark):
    out = {r["text_id"]: r for r in Q.judge(table(spark)).withColumnRenamed("doc_id", "text_id").collect()}
    assert not out[5]["kept"] and out[5]["base_failed"] and out[1]["n_words"] == 60 and None in out
    assert Q.judge(table(spark, [])).count() == 0
    rules = (Q.Rule("short", "n_words > 2", "n_words <= 2"), Q.Rule("loud", "n_shouts = 0", "n_shouts > 0"))
    docs = docs_of(spark, ["some quiet words here"] * 30 + ["LOUD!"] * 5 + ["loud!!! though longer"])
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(docs, rules, base_failed="FALSE").collect()}
    assert all(kept[i] for i in range(30)) and not any(kept[i] for i in range(30, 35))
    plain = Q.judge(docs, rules, base_failed="FALSE")._jdf.queryExecution().toString()
    assert "Python" not in plain and "MapInArrow" not in plain


def test_large_groups_of_equal_ballots(spark):
    votes = spark.range(100_000).select(F.array(F.lit(1), F.when(F.col("id") % 50 == 0, -1).otherwise(0)).alias("votes"))
    assert 0 < Q.fit(votes, 2).share < 1
