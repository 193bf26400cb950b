import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from llm_cases import ROWS, table
from tablewright.llm import bpe, byte_bpe, packing, token_counts
from tablewright.llm.queries import QUERIES

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
ALPHABET = " \n\t'abcdersvlt<|>endoftext  \x1c   é漢字🙂1234.,!?  "


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def odd_texts(n, seed=7):
    rng = random.Random(seed)
    plain = ["", "a", " ", " a", "a ", "a  b", "a\n\nb", "a \n b", "\n", "it's we've", "we'", "'re", "<|endoftext|>", "x <|endoftext|> y",
             "don't  <|endoftext|><|endoftext|>b", "aaaa" * 99, "\x1c a", "a\x1c b", *[t or "" for _, t in ROWS]]
    return plain + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_codec_equals_library(tik):
    texts = odd_texts(3000)
    own = byte_bpe.Codec(RANKS, P.PATTERN)
    for t, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == tik.encode_ordinary(t), t
        assert own.decode(packed) == t.encode()


def naive(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    if piece in ranks:
        return [ranks[piece]]
    while True:
        best = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
        if best[0] == 1 << 60:
            return [ranks[p] for p in parts]
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


@pytest.mark.parametrize("seed", range(20))
def test_rank_queue_on_any_ranks(seed):
    """Also ranks that training would not give, where a merge makes a pair that goes first."""
    rng = random.Random(seed)
    tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(40)}
    order = sorted(tokens)
    rng.shuffle(order)
    ranks = {t: 7 * i for i, t in enumerate(order)}
    queue = bpe.RankQueue(ranks)
    for _ in range(200):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60)))
        assert queue.encode(piece) == naive(piece, ranks)


def test_memory_is_bounded_and_right(tik):
    memory = bpe.Remembered(P.PATTERN, lambda ps: [len(tik.encode_ordinary(p)) for p in ps], sum, limit=50)
    texts = odd_texts(500, 3)
    for k in range(0, len(texts), 7):
        assert memory.many(texts[k:k + 7]) == [len(tik.encode_ordinary(t)) for t in texts[k:k + 7]]
    assert len(memory.stretches) < 50 + 7 * 40


def test_counts_at_every_prefix(library):
    own = token_counts.Counter(JSON, P.PATTERN)
    texts = odd_texts(250)

    def n(t):
        return len(library.encode(t, add_special_tokens=False).ids)

    assert own.totals(texts) == [n(t) for t in texts]
    for t in texts:
        if len(t) < 400:
            counts = [n(t[:i]) for i in range(len(t) + 1)]
            assert own.prefixes(t).tolist() == counts, t
            for budget in (0, 3, 9):
                assert own.cut(t, budget) == max(i for i, c in enumerate(counts) if c <= budget)


def test_count_tokens(spark, library):
    got = token_counts.count_tokens(table(spark), JSON, P.PATTERN, limit=20, with_prefixes=True).collect()
    texts = defaultdict(list)
    for i, t in ROWS:
        texts[i].append(t or "")
    assert len(got) == len(ROWS)
    for r in got:
        assert any((r["n_bytes"], r["n_tokens"]) == (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids))
                   and r["prefix_tokens"][-1] == r["n_tokens"] and len(r["prefix_tokens"]) == len(t) + 1 for t in texts[r["doc_id"]])
        assert r["over_limit"] == (r["n_tokens"] > 20) and r["prefix_tokens"][r["fit_chars"]] <= 20
    assert token_counts.count_tokens(table(spark, []), JSON, P.PATTERN).count() == 0


def test_encode_and_decode_documents(spark, tik):
    encoded = byte_bpe.encode_documents(table(spark), RANKS, P.PATTERN)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoded.collect())
    want = []
    for i, t in ROWS:
        ids = tik.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = byte_bpe.decode_documents(encoded.select("doc_id", "ids"), RANKS)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((t or "").encode() for _, t in ROWS)
    assert byte_bpe.encode_documents(table(spark, []), RANKS, P.PATTERN).count() == 0


def test_packed_ids_equal_the_library(library, sf_small):
    import pyarrow.parquet as pq
    other = P.path("word_bpe_49k.json")
    assert bpe.is_plain_byte_level(JSON) and not bpe.is_plain_byte_level(other)
    texts = odd_texts(1500) + [t or "" for t in pq.read_table(f"{sf_small}/documents.parquet")["text"].to_pylist()]
    own = packing.Tokens(JSON, P.PATTERN)
    for t, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
    whole, own = Tokenizer.from_file(other), packing.Tokens(other, P.PATTERN)
    for t, packed in zip(texts[:300], own.encode(texts[:300])):
        assert np.frombuffer(packed, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def check_packing(rows, documents, library, window=2048):
    """The rows hold every id of every document once, in sequences without gaps."""
    ids = {}
    for key, t in documents.items():
        ids[key] = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for key, own in pieces.items():
        own.sort(key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["doc_tokens"] == len(ids[key])
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[key][r["start"]:at].tobytes())
        assert at == len(ids[key])
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
    assert set(sequences) == set(range(len(sequences)))
    return 1 - sum(map(len, ids.values())) / (len(sequences) * window)


def test_packing_query(spark, sf_small, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    padding = check_packing(QUERIES["op4_packing"](spark, sf_small).collect(), docs, library)
    assert padding < 0.03


def test_packing_awkward_rows(spark, library):
    rows = packing.pack(table(spark), JSON, P.PATTERN, window=64).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 2 * len(library.encode(ROWS[1][1]).ids) + 2  # repeated rows are packed twice
    once = {}
    for i, t in ROWS:
        if sum(i == j for j, _ in ROWS) == 1:
            once[i] = t or ""
    assert {r["doc_id"] for r in rows} == {i for i, _ in ROWS}
    ends = defaultdict(int)
    for r in rows:
        ends[r["sequence_id"]] = max(ends[r["sequence_id"]], r["offset"] + r["length"])
    assert max(ends.values()) <= 64 and sum(r["length"] for r in rows) <= 64 * len(ends)
    check = [r for r in rows if r["doc_id"] in once]
    assert sum(r["length"] for r in check) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in once.values())
    assert packing.pack(table(spark, []), JSON, P.PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([64, 256]))
    lengths = rng.integers(1, window + 1, int(rng.choice([0, 1, 50, 20_000])))
    hist = np.bincount(lengths, minlength=window + 1)
    used = np.zeros(window + 1, int)
    planned = packing.plan(hist, window)
    for repeats, own in planned:
        assert repeats > 0 and sum(own) <= window
        for n in own:
            used[n] += repeats
    assert (used == hist).all()
    if len(lengths) == 20_000:
        assert 1 - lengths.sum() / (window * sum(r for r, _ in planned)) < 0.26
        # the solver's counts come close to the histogram where combinations exist
        combos = packing.combinations(np.flatnonzero(hist), window)
        x = packing.solve(combos, hist.astype(float))
        assert (x >= 0).all() and (combos.sum(1) == window).all()
