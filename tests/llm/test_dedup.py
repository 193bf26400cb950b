import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from llm_cases import ROWS, docs_of, table
from tablewright.llm import components, exact_dedup, jaccard_join, line_dedup
from tablewright.llm.queries import QUERIES, SQL


def test_boundaries_follow_content():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, 40_000).astype(np.uint8)
    b = np.concatenate([rng.integers(0, 256, 777).astype(np.uint8), a])
    cut = exact_dedup.boundaries(a, [0, len(a)])[0]
    assert cut[-1] == len(a) and all(x < y for x, y in zip(cut, cut[1:]))
    assert all(y - x <= exact_dedup.MAX_CHUNK for x, y in zip([0, *cut], cut))
    other = {x - 777 for x in exact_dedup.boundaries(b, [0, len(b)])[0]}
    assert len(other & set(cut)) > 0.8 * len(cut)
    # a text's boundaries do not depend on what stands before it in the batch
    joint = exact_dedup.boundaries(np.concatenate([b, a]), [0, len(b), len(b) + len(a)])[1]
    assert [x - len(b) for x in joint] == cut


@pytest.mark.parametrize("widths", [exact_dedup.WIDTHS, (1, 16)])
def test_exact_groups(spark, widths):
    got = exact_dedup.duplicate_groups(table(spark), widths=widths).collect()
    assert len(got) == len(ROWS)
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    kept = defaultdict(int)
    for r in got:
        own = groups[r["text_sha256"]]
        assert r["group_size"] == len(own)
        assert r["keep_id"] == max((x for x in own if x is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}


def test_key_widths_that_collide_are_refused(spark):
    with pytest.raises(ValueError, match="wider"):
        exact_dedup.duplicate_groups(docs_of(spark, [f"text {i}" * 300 for i in range(400)]), widths=(1,)).collect()


def test_exact_stage_keeps_columns(spark):
    docs = table(spark)
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.schema.names == docs.schema.names
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    best = {}
    for i, t in ROWS:
        t = t or ""
        best[t] = max(best.get(t, -2**63), -2**63 if i is None else i)
    assert got == sorted((i == -2**63, 0 if i == -2**63 else i, t) for t, i in best.items())


def test_empty_tables(spark):
    docs = table(spark, [])
    assert exact_dedup.duplicate_groups(docs).count() == 0
    assert line_dedup.remove_repeated_chunks(docs).count() == 0
    assert jaccard_join.linked_components(docs, counters=1 << 10).count() == 0


def brute_lines(rows):
    """Every repeated chunk but its first occurrence, by plain dictionaries."""
    docs = sorted({(i is not None, i or 0, hashlib.sha256((t or "").encode()).digest(), t or "") for i, t in rows})
    seen, gone = set(), defaultdict(set)
    for d in docs:
        lines = d[3].encode().split(b"\n")
        for a, b in line_dedup.line_chunks(lines):
            c = b"\n".join(lines[a:b])
            if line_dedup.removable(lines[a:b]):
                if c in seen:
                    gone[d].add(a)
                seen.add(c)
    out = {}
    for d in docs:
        lines = d[3].encode().split(b"\n")
        out[d[1] if d[0] else None, d[3]] = b"\n".join(x for a, b in line_dedup.line_chunks(lines) if a not in gone[d] for x in lines[a:b]).decode() if gone[d] else d[3]
    return out


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["\n".join(f"pool {p} line {i}" for i in range(9)) for p in range(4)]
    more = [(100 + k, "\n".join([f"own {k} {j}" for j in range(rng.randint(0, 5))] + [rng.choice(pool)] + ["", "", f"end {k}"])) for k in range(30)]
    rows = ROWS + more + more[:2]
    docs = table(spark, [(i, t, None, None, None, *["x"] * 14) for i, t in rows])
    want = brute_lines(rows)
    got = line_dedup.remove_repeated_chunks(docs, widths=(1, 16)).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in got) == sorted(
        (i is not None, i or 0, want[i, t or ""]) for i, t in rows)
    assert sum(r["removed_lines"] for r in got) > 100
    by_text = {r["doc_id"]: r for r in got}
    assert by_text[14]["removed_lines"] >= 6  # the passage, bar its edges


def test_blank_lines_inside_a_passage(spark):
    """Paragraphs with blank lines between them are found as lines without are."""
    def lines_of(k, between):
        passage = between.join(f"paragraph {i} of the shared passage" for i in range(100))
        return "\n".join([f"own {k} {j}" for j in range(k + 1)]) + "\n" + passage + f"\nend {k}"

    for between in ("\n", "\n\n", "\n \n\n"):
        docs = docs_of(spark, [lines_of(k, between) for k in range(2)])
        second = {r["doc_id"]: r for r in line_dedup.remove_repeated_chunks(docs).collect()}[1]
        left = sum("paragraph" in x for x in second["text"].split("\n"))
        assert left <= 10, (between, left)  # the edges only
    chunks = line_dedup.line_chunks(lines_of(0, "\n\n").encode().split(b"\n"))
    assert [b for _, b in chunks[:-1]] == [a for a, _ in chunks[1:]] and chunks[0][0] == 0
    assert all(line_dedup.removable(lines_of(0, "\n\n").encode().split(b"\n")[a:b]) for a, b in chunks[:-1])


def test_short_passages_line_by_line(spark):
    """Every shared passage of 3 or 4 lines goes whole, edges included; a line shared alone stays."""
    rng, texts, own = random.Random(9), [], []
    for k in range(60):
        passage = ("\n\n" if k % 3 == 0 else "\n").join(f"passage {k} line {i}" for i in range(3 + k % 2))
        for side in "ab":
            head, tail = (["said in every document"] + [f"{side} {k} {where} {j}" for j in range(rng.randint(1, 5))] for where in ("before", "after"))
            texts.append("\n".join([*head, passage, *tail[::-1]]))
            own.append("\n".join(head + tail[::-1]))
    for widths in (line_dedup.WIDTHS, (1, 16)):
        got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated_passages(docs_of(spark, texts), widths=widths).collect()}
        for i, text in enumerate(texts):
            assert got[i] == (own[i] if i % 2 else text)


def brute_passages(rows):
    """Every repeated pair of neighbouring lines but where it comes first, by plain dictionaries."""
    docs = sorted({(i is not None, i or 0, hashlib.sha256((t or "").encode()).digest(), t or "") for i, t in rows})
    at = defaultdict(list)
    for d in docs:
        solid = [x for x in d[3].encode().split(b"\n") if x.strip()]
        for n, pair in enumerate(zip(solid, solid[1:])):
            at[pair].append((d, n))
    gone, kept = defaultdict(set), defaultdict(set)
    for places in at.values():
        for k, (d, n) in enumerate(places if len(places) > 1 else []):
            (gone if k else kept)[d].update((n, n + 1))
    want = {}
    for d in docs:
        out, n = [], -1
        for x in d[3].split("\n"):
            n += bool(x.encode().strip())
            out += [x] if max(n, 0) not in gone[d] - kept[d] else []
        want[d[1] if d[0] else None, d[3]] = "\n".join(out)
    return want


def test_passages_against_brute_force(spark):
    rng = random.Random(4)
    for rounds in range(2):
        long = [rng.sample(["a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "", " "], 12) for _ in range(4)]
        rows = ROWS + [(100 + k, "\n".join([rng.choice(["a", "b", "c", "d", "e", "f", "", " "]) for _ in range(rng.randint(0, 9))]
                                           + (rng.choice(long)[rng.randint(0, 3):] if rounds else []))) for k in range(60)]
        rows += rows[-3:]
        want = brute_passages(rows)
        got = line_dedup.remove_repeated_passages(table(spark, [(i, t, None, None, None, *["x"] * 14) for i, t in rows])).collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), want[i, t or ""]) for i, t in rows)
    assert line_dedup.remove_repeated_passages(table(spark, [])).count() == 0


def test_repeated_passages_of_any_length_are_found(spark):
    """Of 50 passages of each length put into two documents, at least nine lines in ten go from the second."""
    rng = random.Random(8)
    texts, lengths = [], [3, 4, 6, 8, 12, 40]
    for size in lengths:
        for k in range(50):
            passage = [f"passage {size} {k} line {i} {rng.random()}" for i in range(size)]
            for side in "ab":
                head, tail = ([f"{side} {size} {k} {where} {i} {rng.random()}" for i in range(rng.randint(0, 9))] for where in ("head", "tail"))
                texts.append("\n".join(head + passage + tail))
    got = {r["doc_id"]: r for r in line_dedup.remove_repeated_passages(docs_of(spark, texts)).collect()}
    for g, size in enumerate(lengths):
        removed = [got[i]["removed_lines"] for i in range(100 * g, 100 * g + 100)]
        assert sum(removed[::2]) == 0 and sum(removed[1::2]) >= 0.9 * 50 * size, size


def test_chunks_settle_most_of_a_long_passage():
    """The rolling hash of two lines brings copies into step soon: most pairs are settled by chunks."""
    rng = random.Random(1)
    lines = [f"{rng.random()}".encode() for _ in range(400)]
    ours = {b"\n".join(x[a:b]) for x in ([b"one", *lines],) for a, b in line_dedup.line_chunks(x)}
    other = [b"two", b"words", b"before", *lines]
    shared = sum(b - a for a, b in line_dedup.line_chunks(other) if b"\n".join(other[a:b]) in ours)
    assert line_dedup.WINDOW >= 2 and shared >= 0.95 * len(lines)


def test_forest_and_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 640)] + [(900, i) for i in range(700, 880)]
    forest = components.Forest()
    for x, y in edges:
        forest.join(x, y)

    def name(i):
        return i.to_bytes(4, "big")
    df = spark.createDataFrame([(bytearray(name(x)), bytearray(name(y))) for x, y in edges], "a binary, b binary").repartition(7)
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["component"], "big") for r in components.connected_components(df).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {x: forest.find(x) for x in nodes}


def brute_sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute_components(texts):
    sets = [brute_sets(t) for t in texts]
    forest = components.Forest()
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                forest.join(i, j)
    return [(len(s), forest.find(i)) for i, s in enumerate(sets)]


def near_texts(rng, n=160):
    words = [f"v{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for g in range(n // 8):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        if g % 3 == 0:
            base += passage
        for _ in range(8):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4, 8))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    return texts + ["", "   ", "one", "one", "ONE", None]


@pytest.mark.parametrize("unit_docs,bucket", [(4, 3), (30, 1), (2048, 2048)])
def test_jaccard_against_brute_force(spark, unit_docs, bucket):
    """Also with buckets and units so small that clusters are connected outright and dealt over tasks."""
    texts = near_texts(random.Random(unit_docs))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           jaccard_join.linked_components(docs_of(spark, texts), counters=1 << 12, bucket=bucket, unit_docs=unit_docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)


@pytest.mark.parametrize("seed", range(6))
def test_trees_lose_no_link(seed):
    rng = random.Random(seed)
    known = jaccard_join._Words()
    texts = [t for t in near_texts(rng, 96) if t and t.strip()]
    sets = [jaccard_join.shingle_set(t.encode(), known) for t in texts]

    def plain(pairs):
        forest = components.Forest()
        for i, j in pairs:
            if jaccard_join._linked(sets[i], sets[j], (4, 5)):
                forest.join(i, j)
        return [forest.find(i) for i in range(len(sets))]

    def found(links):
        forest = components.Forest()
        for i, j in links:
            forest.join(i, j)
        return [forest.find(i) for i in range(len(sets))]

    n = len(sets)
    assert found(jaccard_join.links(sets, None, list(range(n)))) == plain([(i, j) for i in range(n) for j in range(i)])
    h = n // 3
    assert found(jaccard_join.links(sets[:h], sets[h:], list(range(n)))) == plain([(i, j) for i in range(h) for j in range(h, n)])


@pytest.mark.parametrize("seed", range(4))
def test_bitmaps_refuse_no_link(seed):
    rng = random.Random(seed)
    known = jaccard_join._Words()
    sets = [jaccard_join.shingle_set(t.encode(), known) for t in near_texts(rng, 64) if t and t.strip()]
    bitmaps = [np.frombuffer(jaccard_join.signature(s), np.uint64) for s in sets]
    sizes = [len(s) for s in sets]
    forest = components.Forest()
    for i, j in jaccard_join.may_link(sizes, bitmaps):
        forest.join(i, j)
    for i in range(len(sets)):
        for j in range(i):
            if jaccard_join._linked(sets[i], sets[j], (4, 5)):
                assert forest.find(i) == forest.find(j)
                assert jaccard_join.may_link([sizes[i], sizes[j]], [bitmaps[i], bitmaps[j]]) == [(0, 1)]


def test_jaccard_awkward_rows(spark):
    got = jaccard_join.linked_components(table(spark), counters=1 << 12).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["component_id"] == by_id[1]["component_id"] == by_id[3]["component_id"] == by_id[4]["component_id"] == 1
    assert by_id[9]["component_id"] == 8 and by_id[11]["component_id"] == 10
    assert by_id[5]["n_shingles"] == 0 and by_id[5]["component_id"] == 5 and by_id[6]["component_id"] == 6
    out = jaccard_join.drop_near_duplicates(table(spark))
    ids = sorted(r["doc_id"] for r in out.where("doc_id IS NOT NULL").collect())
    assert out.columns == table(spark).columns
    assert ids == sorted([-5, 1, 5, 6, 7, 8, 10, *([12, 13, 14] if by_id[13]["component_id"] == 13 else [12]), 15, 16, 17, 18, 19, 19, 20, 21, 22, 23, 2**62])
    assert out.where("doc_id IS NULL").count() == 1


def test_stages_keep_columns_of_any_name(spark):
    rows = [(1, "some text", "KEEP1", 5, b"x"), (2, "some text", "KEEP2", 6, b"y"), (3, "other words", "KEEP3", 7, b"z"), (3, "other words", "KEEP3", 7, b"z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __sha string, stay_key int, STAY_KEY_ binary")
    for drop, stay in ((exact_dedup.drop_exact_duplicates, rows[1:3]), (jaccard_join.drop_near_duplicates, [rows[0], rows[2]])):
        out = drop(docs)
        assert out.schema == docs.schema and sorted(tuple(r) for r in out.collect()) == stay
    plan = exact_dedup.drop_exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange" in x and "text#" in x for x in plan.split("\n")) <= 1


def test_queries_match_sql(spark, sf_small):
    from oracle_check import compare, duck
    con = duck(sf_small)
    for name in ("op6_jaccard_join", "op8_exact_dedup"):
        info = compare(spark, name, QUERIES[name], SQL[name], sf_small, con)
        assert info["cols_ok"] and info["hash_ok"], info


def test_line_query_against_brute_force(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = brute_passages(rows)
    got = QUERIES["op3_line_dedup"](spark, sf_small).collect()
    assert len(got) == len(rows)
    for r in got:
        t = next(t for i, t in rows if i == r["doc_id"])
        assert r["clean_sha256"] == hashlib.sha256(want[r["doc_id"], t].encode()).hexdigest()
