"""Operator 13: the prefix trie of conversations, in flat node tables.

Conversations that begin with the same turns share nodes.  A node is known by
its prefix digest: the exclusive or of its turns' hashes, each mixed with the
depth it stands at, so a long conversation's digests can be computed piece by
piece.

Conversations are cut into pieces of at most PIECE turns, at fixed depths, and
dealt over tasks.  A task gathers pieces up to a bounded number of turns (a
shard), enumerates their distinct digests and builds a minimal perfect hash of
them: every digest gets a slot of its own, and the digest kept at the slot is
compared on every lookup.  Counts are scattered into flat arrays by slot, and
one pass over the arrays of parent slots, deepest nodes first, adds up what
lies below.  What a node sums over its subtree is a sum over the conversations
through it - each adds what it owns, as the smallest member, from that depth
on - so the shards' sums for a node simply add up, and a prefix shared by a
third of all conversations is one row for each shard.

Spark then checks that a digest means one prefix everywhere: mixing a turn with
a depth loses nothing, so digest and parent digest give the last turn's hash
back, and equal digests with equal parents all the way up are equal turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import fixed_binary, shuffle_partitions, written

#: Turns in a piece of a conversation, and in a shard, at most.
PIECE, SHARD = 1024, 200_000
#: Bytes of joined ids in one row on their way to being hashed.
JOINED = 1 << 12
#: A turn on its way: 16 bytes of its hash, 8 of its number of words.
TURN = np.dtype([("hash", "<u8", 2), ("words", ">i8")])
_TURN = TURN.itemsize
_BLANK = r"[\x20\x09-\x0D]+"


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled one-to-one."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def at_depth(turn: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Hashes of turns, two 64-bit numbers each (n, 2), as they stand at a depth."""
    with np.errstate(over="ignore"):
        salt = depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.column_stack([mixed(turn[:, 0] ^ salt), mixed(turn[:, 1] ^ mixed(salt + np.uint64(1)))])


class NodeTable:
    """A minimal perfect hash of distinct digests: slots 0 to n - 1, no gaps.

    Level by level, digests not placed yet are hashed into a bitmap; those
    that meet no other take their bit, the others go on to the next level.  A
    slot is the number of bits set before its own."""

    def __init__(self, digests: np.ndarray, spread: float = 1.5):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, before = digests, 0
        while len(left):
            size = max(64, int(len(left) * spread))
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            rank = before + np.cumsum(alone) - alone
            self.levels.append((alone, rank))
            before += int(alone.sum())
            left = left[~alone[place]]
        self.n = before
        self.digests = np.zeros((self.n, 2), np.uint64)
        if self.n:
            self.digests[self._slots(digests)] = digests

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            seed = np.uint64(level + 1) * np.uint64(0xD6E8FEB86659FD93)
            return (mixed(digests[:, 0] + mixed(digests[:, 1] ^ seed)) % np.uint64(size)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> np.ndarray:
        out = np.full(len(digests), -1, np.int64)
        todo = np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(digests[todo], level, len(alone))
            hit = alone[place]
            out[todo[hit]] = rank[place[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slots of digests in the table; one that is not is an error."""
        out = self._slots(digests)
        if len(out) and (out.min() < 0 or (self.digests[out] != digests).any()):
            raise KeyError("a digest that is not in the node table")
        return out


def distinct(digests: np.ndarray) -> np.ndarray:
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    rows = digests[order]
    return rows[np.r_[True, (rows[1:] != rows[:-1]).any(1)]] if len(rows) else rows


def accumulate(values: np.ndarray, parent: np.ndarray, depth: np.ndarray, piece: int, ufunc=np.add) -> None:
    """Add every node's value to its parent's, deepest first, within pieces:
    the first node of a piece passes nothing on, but to the root."""
    inner = np.flatnonzero((parent >= 0) & (((depth - 1) % piece > 0) | (depth == 1)))
    step = (depth[inner] - 1) % piece
    order = np.argsort(-step, kind="stable")
    inner, step = inner[order], step[order]
    for at in np.split(inner, np.flatnonzero(np.diff(step)) + 1) if len(inner) else ():
        ufunc.at(values, parent[at], values[at])


# ------------------------------------------------------------------ turns to pieces
def _runs(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns, with consecutive ones of a conversation in one row, ``most`` at most."""
    place, conv, held = 0, None, []

    def row(convs, turns):
        return pa.RecordBatch.from_arrays(
            [pa.array(convs, pa.int64()), pa.array(range(place, place + len(convs)), pa.int64()),
             pa.array([len(t) // _TURN for t in turns], pa.int64()), pa.array(turns, pa.binary())], ["conv", "place", "k", "turns"])

    for batch in rows:
        convs, turns = [], []
        ids, data = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "data"))
        for c, t in zip(ids, data, strict=True):
            if held and (c != conv or len(held) == most):
                convs.append(conv)
                turns.append(b"".join(held))
                held = []
            conv = c
            held.append(t)
        yield row(convs, turns)
        place += len(convs)
    if held:
        yield row([conv], [b"".join(held)])


def _digest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The exclusive or of the turns' hashes of each run at its depth, as two longs."""
    for b in batches:
        turns, first = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("own", "depth"))
        out = np.zeros((len(turns), 2), np.uint64)
        for i, (t, d) in enumerate(zip(turns, first, strict=True)):
            own = np.frombuffer(t, TURN)["hash"]
            if len(own):
                out[i] = np.bitwise_xor.reduce(at_depth(own, np.arange(d + 1, d + 1 + len(own))), axis=0)
        keep = [b.column(b.schema.get_field_index(c)) for c in ("conv", "range", "place", "depth")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(out[:, 0].view(np.int64)), pa.array(out[:, 1].view(np.int64))],
                                         ["conv", "range", "place", "depth", "xa", "xb"])


def _pieces(most: int):
    """Runs, each with the depth it starts from and the digest there, cut at the depths where pieces begin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            names = ("conv", "depth", "own", "xa", "xb", "end")
            for conv, depth, own, xa, xb, end in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in names], strict=True):
                turns = np.frombuffer(own, TURN)["hash"]
                n = len(turns)
                at = np.array([[xa, xb]], np.int64).view(np.uint64)
                digests = np.bitwise_xor.accumulate(np.vstack([at, at_depth(turns, np.arange(depth + 1, depth + 1 + n))]), axis=0).view(np.int64)
                lo = depth
                while lo < depth + n or lo == depth == 0 == n:
                    hi = min(depth + n, (lo // most + 1) * most)
                    a, z = digests[lo - depth].tolist()
                    for c, x in zip(cols, (conv, lo, a, z, own[(lo - depth) * _TURN:(hi - depth) * _TURN], end), strict=True):
                        c.append(x)
                    if lo == hi:
                        break
                    lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.binary(), pa.int64()), strict=True)],
                                             ["conv", "depth", "xa", "xb", "turns", "end"])
    return run


# ------------------------------------------------------------------ pieces to shards
_NODE = "shard long, slot int, parent int, depth long, digest binary, above binary, words long, n long, ends long, conv long, last_of long"


def _as_bytes(digests: np.ndarray) -> pa.Array:
    return fixed_binary(np.ascontiguousarray(digests).view(np.uint8).reshape(len(digests), 16))


CLASH = "two prefixes share a digest"


def shard_nodes(conv, depth, digest, turns: list[bytes], end, shard: int, piece: int) -> pa.RecordBatch:
    """The node table of a shard's pieces.

    A row for each node, its conversations counted within the shard; a node
    that pieces only hang from has no conv and counts none.  Then a row for
    each piece (``last_of``: its conv) with its last node, ends saying whether
    the conversation ends there."""
    sizes = np.array([len(t) // _TURN for t in turns])
    own = np.frombuffer(b"".join(turns), TURN)
    starts = np.r_[0, np.cumsum(sizes + 1)[:-1]]  # of each piece: the node it hangs from, then its turns
    total = int((sizes + 1).sum())
    rel = np.arange(total) - np.repeat(starts, sizes + 1)
    deep = np.repeat(depth, sizes + 1) + rel
    is_turn = rel > 0
    value = np.zeros((total, 2), np.uint64)
    value[is_turn] = at_depth(own["hash"], deep[is_turn])
    value[~is_turn] = digest
    upto = np.bitwise_xor.accumulate(value, axis=0)
    digests = upto ^ np.repeat(np.vstack([np.zeros((1, 2), np.uint64), upto])[starts], sizes + 1, axis=0)
    table = NodeTable(distinct(digests))
    slot = table.slots(digests)
    parent, depths, words = np.full(table.n, -1), np.zeros(table.n, np.int64), np.zeros(table.n, np.int64)
    n, ends, least = np.zeros(table.n, np.int64), np.zeros(table.n, np.int64), np.full(table.n, np.iinfo(np.int64).max)
    before = slot[np.flatnonzero(is_turn) - 1]
    depths[slot] = deep
    parent[slot[is_turn]] = before
    words[slot[is_turn]] = own["words"]
    if (depths[slot] != deep).any() or (parent[slot[is_turn]] != before).any():
        raise ValueError(CLASH)
    last, goes_on = slot[starts + sizes], depth + sizes < end
    np.add.at(n, last[(sizes > 0) | (depth == 0)], 1)
    np.add.at(ends, last[~goes_on], 1)
    counted = is_turn | (deep == 0)
    np.minimum.at(least, slot[counted], np.repeat(conv, sizes + 1)[counted])
    accumulate(n, parent, depths, piece)
    above = np.where(parent[:, None] >= 0, table.digests[parent], np.zeros((1, 2), np.uint64))
    m = len(conv)
    none = np.zeros(m, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(table.n + m, shard, np.int64)), pa.array(np.r_[np.arange(table.n), last].astype(np.int32)),
        pa.array(np.r_[parent, none].astype(np.int32)), pa.array(np.r_[depths, depth + sizes]),
        _as_bytes(np.vstack([table.digests, digests[starts + sizes]])), _as_bytes(np.vstack([above, np.zeros((m, 2), np.uint64)])),
        pa.array(np.r_[words, none]), pa.array(np.r_[n, none]), pa.array(np.r_[ends, ~goes_on]),
        pa.array(np.r_[least, conv], mask=np.r_[n == 0, none > 0]), pa.array(np.r_[none[:0], np.zeros(table.n, np.int64), conv], mask=np.r_[np.ones(table.n, bool), none > 0])],
        ["shard", "slot", "parent", "depth", "digest", "above", "words", "n", "ends", "conv", "last_of"])


def _shards(most: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        turns = 0

        def made():
            conv, depth, xa, xb, data, end = zip(*held, strict=True)
            digest = np.column_stack([np.array(xa, np.int64), np.array(xb, np.int64)]).view(np.uint64)
            return shard_nodes(np.array(conv, np.int64), np.array(depth, np.int64), digest, [bytes(t) for t in data],
                               np.array(end, np.int64), number, piece)

        for b in batches:
            for row in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "depth", "xa", "xb", "turns", "end")], strict=True):
                size = len(row[4]) // _TURN + 1
                if held and turns + size > most:
                    yield made()
                    number, held, turns = number + 1, [], 0
                held.append(row)
                turns += size
        if held:
            yield made()
    return run


def _subtrees(piece: int):
    """Of a shard's nodes with what is known of them over all shards: what they own, summed over what lies below."""
    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("slot", "parent", "depth", "words", "n", "ends", "conv", "mine", "leaves", "saved", "kind")}
        node = col["kind"] == 0
        size = int(node.sum())
        slot = col["slot"][node]
        put = {c: np.zeros(size, np.int64) for c in col}
        for c in put:
            put[c][slot] = col[c][node]
        mine = put["mine"] > 0
        leaves = np.where(mine & (put["ends"] == put["n"]), 1, 0)
        saved = np.where(mine, (put["n"] - 1) * put["words"], 0)
        more = ~node
        np.add.at(leaves, col["slot"][more], col["leaves"][more])
        np.add.at(saved, col["slot"][more], col["saved"][more])
        accumulate(leaves, put["parent"], put["depth"], piece)
        accumulate(saved, put["parent"], put["depth"], piece)
        children = np.zeros(size, np.int64)
        has = put["parent"] >= 0
        np.add.at(children, put["parent"][mine & has], 1)
        above = np.where(mine & has, put["conv"][put["parent"]], -1)
        counted = np.empty(table.num_rows, np.int64)
        counted[np.flatnonzero(node)] = np.arange(size)
        digest = table.column("digest").filter(pa.array(node)).take(pa.array(np.argsort(slot, kind="stable")))
        return pa.table({"digest": digest.cast(pa.binary()), "depth": put["depth"], "conv_id": put["conv"], "n_convs": put["n"],
                         "parent_conv_id": pa.array(above, mask=~(mine & has)), "n_children": children, "n_leaves": leaves, "saved_tokens": saved})
    return run


# ------------------------------------------------------------------ who ends where
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv) rows, with the ids of a digest joined, at most about JOINED bytes a row."""
    at, first, ids, size = None, 0, [], 0
    names = ["digest", "first", "ids"]

    def row(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.string())], names)

    for b in batches:
        out = []
        for digest, conv in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("digest", "conv")], strict=True):
            if digest != at or size > JOINED:
                if ids:
                    out.append((at, first, ",".join(ids)))
                at, first, ids, size = digest, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield row(out)
    if ids:
        yield row([(at, first, ",".join(ids))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of joined ids, in order, hashed in passing: one row for each digest."""
    at, state = None, None
    for b in batches:
        out = []
        for digest, ids in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("digest", "ids")], strict=True):
            if state is not None and digest == at:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((at, state.hexdigest()))
            at, state = digest, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], ["digest", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["digest", "sha"])


# ------------------------------------------------------------------ the whole
def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, data): a turn's 16 bytes of hash and number of words."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.filter(F.split(text, _BLANK), lambda w: w != "")).cast("long")
    return (conversations.where(F.col(f"`{conv_col}`").isNotNull())
            .select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                    F.concat(F.substring(F.sha2(framed, 256), 1, 32), F.lpad(F.hex(words), 16, "0")).alias("data"))
            .withColumn("data", F.unhex("data")))


def _paths(runs: DataFrame, from_conv: Column | None, from_turns: Column | None, most_from: int) -> DataFrame:
    """For each run (range, place) of a conversation: what it adds to the
    rebuilt path (head, and its own turns but the first ``drop``), the depth it
    adds them at, the path's length ``end``, and whether there are more runs."""
    of_conv = Window.partitionBy("conv")  # one row for each run
    earlier = of_conv.orderBy("range", "place").rowsBetween(Window.unboundedPreceding, -1)
    thin = runs.select("conv", "range", "place", "k", F.expr(f"substring(turns, 1, {_TURN * most_from})").alias("head"),
                       F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("before"), F.sum("k").over(of_conv).alias("m"))
    if from_conv is None or from_turns is None:
        rows = thin.withColumns({"head": F.lit(b""), "h": F.lit(0).cast("long")})
    else:
        heads = (thin.where(F.col("before") < most_from).groupBy("conv")  # at most most_from runs of a conversation
                 .agg(F.array_sort(F.collect_list(F.struct("before", "head"))).alias("parts"))
                 .select(F.col("conv").alias("from_conv"), F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x["head"])).alias("head")))
        rows = (thin.drop("head").withColumns({"from_conv": from_conv.cast("long"), "h": F.least(from_turns.cast("long"), F.lit(most_from))})
                .join(heads, "from_conv", "left").withColumn("head", F.expr(f"coalesce(substring(head, 1, int(h) * {_TURN}), X'')")))
    borrowed = F.expr(f"octet_length(head) div {_TURN}").cast("long")
    left, first = (lambda c: F.greatest(F.lit(0).cast("long"), F.col(c) - F.col("h"))), F.col("before") == 0
    return rows.select(
        "conv", "range", "place", "before", (F.col("m") > F.col("k")).alias("several"),
        F.greatest(F.lit(0).cast("long"), F.least(F.col("k"), F.col("h") - F.col("before"))).alias("drop"),
        F.when(first, F.col("head")).otherwise(F.lit(b"")).alias("head"), (borrowed + left("m")).alias("end"),
        F.when(first, F.lit(0).cast("long")).otherwise(borrowed + left("before")).alias("depth"))


def _shard_tables(conversations: DataFrame, from_conv, from_turns, most_from: int, piece: int, shard: int) -> DataFrame:
    """``shard_nodes`` of all shards, written."""
    turns = conversations.withColumn("row", F.monotonically_increasing_id())  # repeated rows need not stay together
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("data"), F.col("row")]
    spread = turns.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    runs = written(spread.select("conv", "data").mapInArrow(lambda b: _runs(b, piece), "conv long, place long, k long, turns binary")
                   .withColumn("range", F.spark_partition_id()), "trie-runs")
    paths = written(_paths(runs, from_conv, from_turns, most_from), "trie-paths")

    def with_turns(rows: DataFrame) -> DataFrame:
        return (rows.join(runs.select("range", "place", "turns"), ["range", "place"])
                .withColumn("own", F.expr(f"concat(head, substring(turns, int(drop) * {_TURN} + 1))")).drop("turns", "head"))

    # where a conversation has several runs, the digest before each is that of the runs before it
    digests = with_turns(paths.where("several")).mapInArrow(_digest_of, "conv long, range int, place long, depth long, xa long, xb long")
    earlier = Window.partitionBy("conv").orderBy("range", "place").rowsBetween(Window.unboundedPreceding, -1)  # one row for each run
    digests = digests.select("range", "place", *[F.expr(f"bit_xor({x})").over(earlier).alias(x) for x in ("xa", "xb")])
    placed = paths.join(digests, ["range", "place"], "left").withColumns({x: F.coalesce(x, F.lit(0).cast("long")) for x in ("xa", "xb")})
    ready = with_turns(placed).where("before = 0 OR octet_length(own) > 0")
    cut = ready.select("conv", "depth", "own", "xa", "xb", "end").mapInArrow(
        _pieces(piece), "conv long, depth long, xa long, xb long, turns binary, end long")
    # runs end where ranges do, pieces at fixed depths: what belongs to one piece comes together again
    whole = (cut.groupBy("conv", F.expr(f"depth div {piece}L").alias("piece"))
             .agg(F.array_sort(F.collect_list(F.struct("depth", "xa", "xb", "turns"))).alias("parts"), F.max("end").alias("end"))  # one piece's turns
             .select("conv", *[F.col("parts")[0][c].alias(c) for c in ("depth", "xa", "xb")],
                     F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x["turns"])).alias("turns"), "end"))
    return written(whole.mapInArrow(_shards(shard, piece), _NODE), "trie-shards")


def _known_nodes(local: DataFrame) -> DataFrame:
    """The shards' nodes with what all shards together know of them: members,
    ends, smallest member, and whether that is one of this shard's."""
    of_node = Window.partitionBy("digest")  # one row for each shard
    above = F.when(F.col("parent") >= 0, F.col("above"))
    nodes = local.where("last_of IS NULL").select(
        "shard", "slot", "parent", "depth", "digest", "words", F.sum("n").over(of_node).alias("n"), F.sum("ends").over(of_node).alias("ends"),
        F.min("conv").over(of_node).alias("conv"), F.col("conv").alias("own"),
        *[f("depth").over(of_node).alias(f"depth_{f.__name__}") for f in (F.min, F.max)],
        *[f(above).over(of_node).alias(f"above_{f.__name__}") for f in (F.min, F.max)])
    one = (F.col("depth_min") == F.col("depth_max")) & F.equal_null("above_min", "above_max")
    nodes = nodes.where(F.when(one, F.lit(True)).otherwise(F.raise_error(F.lit(CLASH)).cast("boolean")))
    return written(nodes.select("shard", "slot", "parent", "depth", "digest", "words", "n", "ends", "conv",
                                F.coalesce(F.col("own") == F.col("conv"), F.lit(False)).cast("long").alias("mine")), "trie-nodes")


def _carried(known: DataFrame, local: DataFrame, piece: int) -> DataFrame:
    """What a conversation owns beyond each of its pieces, for the piece's last node."""
    of_piece = F.expr(f"(depth - 1) div {piece}L").alias("piece")
    beyond = (known.where((F.col("depth") > piece) & (F.col("mine") > 0)).groupBy("conv", of_piece)
              .agg(F.sum(F.when(F.col("ends") == F.col("n"), 1).otherwise(0)).alias("leaves"), F.sum(F.expr("(n - 1) * words")).alias("saved"))
              .withColumns({"shard": F.lit(None).cast("long"), "slot": F.lit(None).cast("int")}))
    lasts = local.where("last_of IS NOT NULL AND ends = 0").select(
        F.col("last_of").alias("conv"), of_piece, "shard", "slot", *[F.lit(0).cast("long").alias(c) for c in ("leaves", "saved")])
    later = Window.partitionBy("conv").orderBy(F.col("piece").desc()).rangeBetween(Window.unboundedPreceding, -1)  # one row for each piece
    return (beyond.unionByName(lasts).withColumns({c: F.coalesce(F.sum(c).over(later), F.lit(0).cast("long")) for c in ("leaves", "saved")})
            .where("shard IS NOT NULL AND (leaves > 0 OR saved > 0)"))


def _ends(local: DataFrame) -> DataFrame:
    """For each node where conversations end, the hash of their ids in order."""
    parts = shuffle_partitions(local.sparkSession)
    ended = local.where("last_of IS NOT NULL AND ends = 1").select("digest", F.col("last_of").alias("conv"))
    joined = ended.repartitionByRange(parts, "digest", "conv").sortWithinPartitions("digest", "conv").mapInArrow(
        _joined, "digest binary, first long, ids string")
    return joined.repartition(parts, "digest").sortWithinPartitions("digest", "first").mapInArrow(_hashed, "digest binary, sha string")


def prefix_trie(conversations: DataFrame, from_conv: Column | None = None, from_turns: Column | None = None, most_from: int = 0,
                piece: int = PIECE, shard: int = SHARD, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation's turns are taken in order of ``turn``, null first, those of
    the same turn by the hash of role and text.  With ``from_conv`` and
    ``from_turns`` (over the column ``conv``) the first turns of another
    conversation, ``most_from`` at most, come in place of as many of its own; all
    if that one has fewer, none if there is no such.  Null roles and texts count
    as empty; rows without a conversation id are left out.  Repeated rows are
    turns of their own.  The root (depth 0) is there if any conversation is; an
    empty table gives an empty result.

    Turns move as 24 bytes, texts never.  A long conversation is sorted, hashed
    and counted in pieces, so neither it nor a common prefix is one task's work;
    only the ids that end at one node are hashed in one place, in passing, as
    the hash asks for one sequence."""
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    local = _shard_tables(turns, from_conv, from_turns, most_from, piece, shard)
    known = _known_nodes(local)
    zero = F.lit(0).cast("long")
    seeds = _carried(known, local, piece).select(
        "shard", "slot", F.lit(-1).alias("parent"), *[zero.alias(c) for c in ("depth", "words", "n", "ends", "conv", "mine")],
        F.lit(b"").alias("digest"), "leaves", "saved", F.lit(1).alias("kind"))
    sums = (known.withColumns({"leaves": zero, "saved": zero, "kind": F.lit(0)}).unionByName(seeds).groupBy("shard").applyInArrow(
        _subtrees(piece), "digest binary, depth long, conv_id long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"))
    own = ("depth", "conv_id", "n_convs", "parent_conv_id")
    added = ("n_children", "n_leaves", "saved_tokens")
    nodes = sums.unionByName(_ends(local), allowMissingColumns=True).groupBy("digest").agg(  # a row for each shard
        *[F.max(c).alias(c) for c in own], *[F.sum(c).alias(c) for c in added], F.max("sha").alias("sha"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", *added,
                        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
