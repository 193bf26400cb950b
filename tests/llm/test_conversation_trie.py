import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tablewright.llm import conversation_trie as T
from tablewright.llm import queries
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, digest string, shard string, conv string, slot string"


def ordered(rows):
    convs = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r or "", x or ""))

    def key(v):
        framed = f"{len(v[1].encode())}:{v[1]}{v[2]}".encode()
        return (v[0] is not None, v[0] or 0, hashlib.sha256(framed).digest()[:16])
    return {c: [v[1:] for v in sorted(vs, key=key)] for c, vs in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    return out


def brute(paths):
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(tuple(p[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in members if len(paths[c]) == len(p))))
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below) for q in below)
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def made(seed, convs=40, most=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 200), convs):
        for t in range(rng.randrange(1, most + 1)):
            rows.append((rng.choice([c, c, c, None]) if t > 1 else c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]),
                         rng.choice(["a b", "a b", "c\td e", "", None, "ab"]), *["x"] * 4))
    return rows + rows[:5]


def test_node_table_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 1000, 20_000):
        digests = T.distinct(rng.integers(0, 1 << 64, (n, 2), dtype=np.uint64)) if n else np.zeros((0, 2), np.uint64)
        table = T.NodeTable(digests)
        assert sorted(table.slots(digests).tolist()) == list(range(len(digests))) and table.n == len(digests)
    with pytest.raises(KeyError):
        table.slots(np.array([[1, 2]], np.uint64))


def test_mixing_loses_nothing():
    assert len(np.unique(T.mixed(np.arange(200_000)))) == 200_000


@pytest.mark.parametrize("piece, shard", [(1, 1), (2, 5), (3, 8), (1024, 200_000)])
def test_trie_against_brute_force(spark, piece, shard):
    for seed in range(2):
        rows = made(seed + piece)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        paths = ordered(rows)
        assert got(T.prefix_trie(df, piece=piece, shard=shard)) == brute(paths)
        conv = F.col("conv")
        shared = T.prefix_trie(df, from_conv=conv - conv % 20, from_turns=F.crc32(F.encode(conv.cast("string"), "UTF-8")) % 4, most_from=3,
                               piece=piece, shard=shard)
        assert got(shared) == brute(rebuilt(paths))


def test_one_conversation_of_many_turns(spark):
    rows = [(1, t, "user", f"turn {t % 7}", *["x"] * 4) for t in range(400)] + [(c, t, "user", f"turn {t % 7}", *["x"] * 4) for c in (2, 3) for t in range(40 * c)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(T.prefix_trie(df, piece=16, shard=50)) == brute(ordered(rows))


def test_many_equal_conversations(spark):
    rows = [(c, t, "user", "the same first words" if t < 2 else f"own {c % 3}", *["x"] * 4) for c in range(600) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(T.prefix_trie(df, shard=100)) == brute(ordered(rows))


def test_empty_table_and_registered_query(spark, sf_small):
    assert T.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_conversation_trie(spark, sf_small)) == brute(rebuilt(ordered(rows)))
