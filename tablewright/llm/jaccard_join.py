"""Operator 6: n-gram Jaccard join by signature trees.

Two documents link when their sets of word shingles reach a Jaccard likeness.
The join is exact over the sets (shingles go by 64-bit hashes):

1. Every text becomes its set.  Equal sets are one class from here on, and a
   fixed-size count of all shingles tells common ones from rare.
2. Shingles are put in one order for all classes, common ones last.  Linked
   classes share a shingle among the first n - ceil(s n) + 1 of each.  The
   classes that have such a shingle in common meet in a bucket; equal buckets
   are looked at once, and a signature tree over its classes' bitmaps leaves
   the pairs whose overlap may still be enough.  (A bucket too large for one
   task connects all its classes instead.)  What is connected is a cluster.
3. Within a cluster (a large one is dealt in units, and pairs of units are
   tasks), signature trees are built: a node holds the OR of its documents'
   shingle bitmaps and their range of sizes.  A traversal of two trees at once
   drops a pair of nodes when the overlap that bitmaps and sizes still allow is
   too small, or when all it could link is linked already; pairs of documents
   that are left are decided on the sets themselves.
4. The links' connected components are the result."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import beside_group, fixed_binary, raw, rows_that_stay, steps, texts_of, written
from tablewright.llm.components import Forest, connected_components

#: Words in a shingle, and the likeness as a fraction.
WORDS, LEAST = 5, (4, 5)
#: Counters of the corpus-wide shingle counts (16 MB of them for a task, 4 MB of levels to all tasks).  They only order shingles.
COUNTERS = 1 << 22
#: Documents and shingles of a unit, beyond which a cluster is dealt over several.
UNIT_DOCS, UNIT_SHINGLES = 1024, 1_000_000
#: Bits of a bitmap: at least so many for each shingle of a usual document, within bounds.
BITS_EACH, LEAST_BITS, MOST_BITS = 8, 256, 1 << 14
#: A class's bitmap in the buckets: twice as many bits as shingles, within bounds.
LEAST_SIGNATURE, MOST_SIGNATURE = 64, 1 << 16
#: Classes of a bucket beyond which it connects all of them, and that many within one step of a task.
BUCKET, STEP_BUCKET = 2048, 64
#: Children of a tree node, and node pairs looked at together.
FANOUT, TOGETHER = 8, 1 << 12
#: Distinct words and classes that a task remembers.
REMEMBERED = 300_000

_ODD = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def shingle_set(text: bytes, known: _Words) -> np.ndarray:
    """The text's distinct shingle hashes, sorted."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n < WORDS:  # another multiplier for each length: a short sequence is no shingle of a longer text
        total = np.full(1, n, np.uint64)
        for k in range(n):
            total = total * _ODD[0] + h[k]
        return _mixed(total)
    total = h[:n - WORDS + 1] * _ODD[0]
    for k in range(1, WORDS):
        total = total + h[k:n - WORDS + 1 + k] * _ODD[k]
    return np.unique(_mixed(total))


def digest(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def prefix_length(n: int, least: tuple[int, int] = LEAST) -> int:
    """n - ceil(s * n) + 1: two linked sets share one of so many first shingles."""
    return n - -(-least[0] * n // least[1]) + 1


def needed(na, nb, least: tuple[int, int] = LEAST):
    """The smallest overlap at which sets of these sizes link: with union =
    na + nb - overlap, least[1] * overlap >= least[0] * union."""
    return -(-least[0] * (na + nb) // (least[0] + least[1]))


def signature(own: np.ndarray) -> bytes:
    """The set as a bitmap: shingle h sets bit h mod its width, a power of two."""
    bits = min(MOST_SIGNATURE, max(LEAST_SIGNATURE, 1 << (2 * len(own)).bit_length()))
    flags = np.zeros(bits, np.uint8)
    flags[own & np.uint64(bits - 1)] = 1
    return np.packbits(flags).tobytes()


def folded(bitmap: np.ndarray, width: int) -> np.ndarray:
    """A bitmap (64-bit words) as the same set's bitmap of fewer words."""
    while len(bitmap) > width:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


def _classes(counters: int):
    """A task's documents as (doc_id, sha, n, node, signature) and, at its end,
    its counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, pending, held = _Words(), np.zeros(counters, np.uint32), [], 0
        names = ["doc_id", "sha", "n", "node", "signature", "counts"]
        for part in steps(batches):
            mv, at = raw(part.column(part.schema.get_field_index("text")))
            spans = list(zip(at, at[1:], strict=False))
            sets = [shingle_set(bytes(mv[a:b]), known) for a, b in spans]
            pending += sets
            held += sum(map(len, sets))
            if held > 4 * counters:
                counts += np.bincount(np.concatenate(pending) & np.uint64(counters - 1), minlength=counters).astype(np.uint32)
                pending, held = [], 0
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")),
                                              pa.array([hashlib.sha256(mv[a:b]).digest() for a, b in spans], pa.binary()),
                                              pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([digest(s) for s in sets], pa.binary()),
                                              pa.array([signature(s) for s in sets], pa.binary()), pa.nulls(len(sets), pa.binary())], names)
        if held:
            counts += np.bincount(np.concatenate(pending) & np.uint64(counters - 1), minlength=counters).astype(np.uint32)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                              pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names)
    return run


def _added(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.int64)
        for b in batches:
            for packed in b.column(0):
                total += np.frombuffer(zlib.decompress(packed.as_buffer()), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["counts"])
    return run


def shingle_levels(spark: SparkSession, counts: DataFrame, counters: int) -> np.ndarray:
    """0 for counters that hold what chance explains, else how often over the
    mean, as a power of two.  At most 16 sums of fixed size reach the driver."""
    total = np.zeros(counters, np.int64)
    for r in counts.coalesce(16).mapInArrow(_added(counters), "counts binary").toLocalIterator():
        total += np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    mean = total.sum() / counters
    common = total > mean + 5 * mean ** 0.5 + 4
    return np.where(common, 1 + np.log2(np.maximum(total / (mean + 1), 1)), 0).astype(np.uint8)


def _prefix_rows(sent, least):
    """(k, hot, a, null) for each shingle k at the front of a class a.  A class
    is listed once in a task.  A shingle that very many classes of a step have
    is listed once, marked hot, and (k, true, a, b) connects the others with
    that one: its bucket will connect all its classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, known, seen = sent.value, _Words(), set()
        low = np.uint64(len(levels) - 1)
        for part in steps(batches):
            mv, at = raw(part.column(part.schema.get_field_index("text")))
            nodes, fronts = [], []
            for a, b in zip(at, at[1:], strict=False):
                own = shingle_set(bytes(mv[a:b]), known)
                if not len(own) or (node := digest(own)) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                level = levels[own & low]
                if level.any():
                    own = own[np.lexsort((own, level))]
                nodes.append(node)
                fronts.append(own[:prefix_length(len(own), least)])
            if not nodes:
                continue
            owner = np.repeat(np.arange(len(nodes)), [len(f) for f in fronts])
            tokens = np.concatenate(fronts)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            first = np.r_[True, tokens[1:] != tokens[:-1]]
            head = np.flatnonzero(first)
            run_of = np.cumsum(first) - 1
            hot = np.diff(np.r_[head, len(tokens)])[run_of] > STEP_BUCKET
            ids = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, 16)
            stay = ~hot | first
            k, o, h = tokens[stay].view(np.int64), owner[stay], hot[stay]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(h), fixed_binary(ids[o]), pa.nulls(len(k), pa.binary())], names)
            if not stay.all():
                pairs = np.unique(np.stack([owner[~stay], owner[head[run_of]][~stay]], 1), axis=0)
                a = ids[pairs[:, 0]]
                yield pa.RecordBatch.from_arrays([pa.array(a[:, :8].copy().view(np.int64).ravel()), pa.array(np.ones(len(a), bool)),
                                                  fixed_binary(a), fixed_binary(ids[pairs[:, 1]])], names)

    names = ["k", "hot", "a", "b"]
    return run


class _Bucket:
    """The classes that share a shingle, as they come by; ``rows`` takes what is to be emitted."""

    def __init__(self, rows: list[tuple[bytes | None, bytes, bytes | None]], seen: set[bytes], most: int):
        self.rows, self.seen, self.most = rows, seen, most
        self.nodes: list[bytes] = []
        self.lead: bytes | None = None  # set once the bucket connects all its classes

    def add(self, nodes: list[bytes], hot: bool) -> None:
        if self.lead is None:
            self.nodes += nodes
            if not hot and len(self.nodes) <= self.most:
                return
            nodes, self.lead, self.nodes = self.nodes, self.nodes[0], []
        self.rows += [(None, n, self.lead) for n in nodes if n != self.lead]

    def close(self) -> None:
        members = sorted(set(self.nodes))
        if len(members) > 1:
            name = xxhash.xxh3_128_digest(b"".join(members))
            if name not in self.seen:  # most shingles of near copies have one and the same bucket
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen.add(name)
                self.rows += [(name, n, None) for n in members]
        self.nodes, self.lead = [], None


def _buckets(most: int):
    """Of rows sorted by k, hot ones first: (bucket, a, null) for the classes
    of each bucket, named by its classes, and (null, a, b) for classes that are
    connected outright."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes | None, bytes, bytes | None]] = []
        bucket, last = _Bucket(rows, set(), most), None

        def out() -> pa.RecordBatch:
            cols = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.binary())] * 3
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, ["bucket", "a", "b"])

        for b in batches:
            edge = b.column(3).is_valid()
            ready = b.filter(edge)
            if ready.num_rows:
                yield pa.RecordBatch.from_arrays([pa.nulls(ready.num_rows, pa.binary()), ready.column(2), ready.column(3)], ["bucket", "a", "b"])
            b = b.filter(pc.invert(edge))
            if not b.num_rows:
                continue
            k, hot = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            mv, at = raw(b.column(2))
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            end = np.r_[start[1:], len(k)]
            # a lone row says nothing, unless its shingle may go on in the next batch
            told = (end - start > 1) | hot[start] | (end == len(k)) | (start == 0)
            for x, y in zip(start[told].tolist(), end[told].tolist(), strict=True):
                if k[x] != last:
                    bucket.close()
                    last = k[x]
                bucket.add([bytes(mv[at[i]:at[i + 1]]) for i in range(x, y)], bool(hot[x]))
            if len(rows) > 50_000:
                yield out()
        bucket.close()
        yield out()
    return run


def _bucket_edges(least):
    """Rows (bucket, node, n, signature) sorted by bucket: edges that connect
    the classes of each whose signatures allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*(b.column(k).to_pylist() for k in range(4)), strict=True) for b in batches)
        us, vs = [], []
        for _, group in groupby(rows, key=lambda r: r[0]):
            members = {node: (n, np.frombuffer(bits, np.uint64)) for _, node, n, bits in group}
            names = list(members)
            for i, j in may_link([members[m][0] for m in names], [members[m][1] for m in names], least):
                us.append(names[i])
                vs.append(names[j])
            if len(us) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["a", "b"])
                us, vs = [], []
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["a", "b"])
    return run


def may_link(sizes: list[int], bitmaps: list[np.ndarray], least=LEAST) -> list[tuple[int, int]]:
    """Pairs that connect what the bitmaps let link."""
    if len(sizes) == 2:  # by far the most buckets
        a, b = bitmaps
        if least[1] * min(sizes) < least[0] * max(sizes):
            return []
        width = min(len(a), len(b))
        a, b = folded(a, width), folded(b, width)
        spare = min(n - int(np.bitwise_count(x).sum()) for n, x in zip(sizes, (a, b), strict=True))
        both = int(np.bitwise_count(a & b).sum()) + spare
        return [(0, 1)] if min(both, *sizes) >= needed(*sizes, least) else []
    # sizes that can link differ by a quarter, so widths by one step: trees of one width, and of a width and the next
    widths: dict[int, list[int]] = {}
    for i, x in enumerate(bitmaps):
        widths.setdefault(len(x), []).append(i)

    def tree(own: list[int], width: int) -> Tree:
        return Tree(np.array([sizes[i] for i in own]), np.stack([folded(bitmaps[i], width) for i in own]), range(len(own)))

    forest, found = Forest(), []
    for width, own in sorted(widths.items()):
        for other in (None, widths[2 * width]) if 2 * width in widths else (None,):
            everything = own + (other or [])
            if len(everything) < 2:
                continue
            component = [forest.find(i) for i in everything]
            pairs = traverse(tree(own, width), tree(other, width) if other else None, component, lambda i, j: True, least)
            for i, j in pairs:
                forest.join(everything[i], everything[j])
                found.append((everything[i], everything[j]))
    return found


class Tree:
    """A signature tree over documents' sets.  ``levels[0]`` are the leaves,
    one for each document in the order ``docs``; a node of the next level joins
    FANOUT neighbours: bits (OR of the bitmaps), lo and hi (sizes), spare (most
    shingles that a document has beyond its bits), tag (the component of all,
    or -1)."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray, docs):
        self.docs = list(docs)
        sizes, bitmaps = sizes[self.docs].astype(np.int64), bitmaps[self.docs]
        spare = sizes - np.bitwise_count(bitmaps).sum(1, dtype=np.int64)
        self.levels = [{"bits": bitmaps, "lo": sizes, "hi": sizes, "spare": spare}]
        while len(self.levels[-1]["lo"]) > 1:
            b = self.levels[-1]
            at = np.arange(0, len(b["lo"]), FANOUT)
            self.levels.append({"bits": np.bitwise_or.reduceat(b["bits"], at, axis=0), "lo": np.minimum.reduceat(b["lo"], at),
                                "hi": np.maximum.reduceat(b["hi"], at), "spare": np.maximum.reduceat(b["spare"], at)})

    @classmethod
    def of(cls, sets: list[np.ndarray], bits: int, docs) -> Tree:
        flags = np.zeros((len(sets), bits), np.uint8)
        for row, s in enumerate(sets):
            flags[row, s & np.uint64(bits - 1)] = 1
        return cls(np.array([len(s) for s in sets]), np.packbits(flags, axis=1).view(np.uint64), docs)

    def tag(self, component: np.ndarray) -> None:
        """Notes on every node the component of its documents, -1 if they differ."""
        own = component[self.docs]
        for level in self.levels:
            level["tag"] = own
            at = np.arange(0, len(own), FANOUT)
            lo, hi = np.minimum.reduceat(own, at), np.maximum.reduceat(own, at)
            own = np.where(lo == hi, lo, -1)


def _allowed(p: dict, q: dict, i: np.ndarray, j: np.ndarray, least) -> np.ndarray:
    """Which node pairs may still hold a link that is not known."""
    fine = (p["tag"][i] < 0) | (p["tag"][i] != q["tag"][j])
    lo_p, lo_q, hi_p, hi_q = p["lo"][i], q["lo"][j], p["hi"][i], q["hi"][j]
    fine &= (least[1] * hi_p >= least[0] * lo_q) & (least[1] * hi_q >= least[0] * lo_p)
    at = np.flatnonzero(fine)
    i, j = i[at], j[at]
    shared = np.bitwise_count(p["bits"][i] & q["bits"][j]).sum(1, dtype=np.int64)
    most = np.minimum(shared + np.minimum(p["spare"][i], q["spare"][j]), np.minimum(hi_p[at], hi_q[at]))
    fine[at] = most >= needed(lo_p[at], lo_q[at], least)
    return fine


def _linked(a: np.ndarray, b: np.ndarray, least) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return least[1] * both >= least[0] * (len(a) + len(b) - both)


def traverse(p: Tree, q: Tree | None, component: list[int], linked, least=LEAST) -> list[tuple[int, int]]:
    """Pairs for which ``linked`` holds, as many as connect what it connects,
    among the documents of ``p`` or, with ``q``, between the two trees' (q's are
    numbered on).  ``component``: what is connected already, a number for each."""
    base = len(p.docs) if q is not None else 0
    forest, found = Forest(), []
    first: dict[int, int] = {}
    for i, c in enumerate(component):
        forest.join(first.setdefault(c, i), i)
    now = np.array([forest.find(i) for i in range(len(component))])
    p.tag(now[:len(p.docs)])
    if q is None:
        q = p
    else:
        q.tag(now[base:])
    stack = [(len(p.levels) - 1, len(q.levels) - 1, np.array([0]), np.array([0]))]
    while stack:
        x, y, i, j = stack.pop()
        if len(i) > TOGETHER:
            stack += [(x, y, i[k:k + TOGETHER], j[k:k + TOGETHER]) for k in range(0, len(i), TOGETHER)]
            continue
        fine = _allowed(p.levels[x], q.levels[y], i, j, least)
        if p is q:  # one tree: both sides stay on one level, and each pair comes once
            fine &= i <= j if x else i < j
        i, j = i[fine], j[fine]
        if not len(i):
            continue
        if x == y == 0:
            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                a, b = p.docs[a], base + q.docs[b]
                if forest.find(a) != forest.find(b) and linked(a, b):
                    forest.join(a, b)
                    found.append((a, b))
            continue
        # open the nodes of the higher level; in one tree, both
        if x >= y and x:
            x -= 1
            i, j = _opened(p, x, i, j)
        else:
            y -= 1
            j, i = _opened(q, y, j, i)
        if p is q:
            y -= 1
            j, i = _opened(q, y, j, i)
        stack.append((x, y, i, j))
    return found


def _opened(tree: Tree, level: int, nodes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children (on ``level``) of nodes, each with its node's partner."""
    kids = nodes[:, None] * FANOUT + np.arange(FANOUT)
    has = kids < len(tree.levels[level]["lo"])
    return kids[has], np.broadcast_to(others[:, None], kids.shape)[has]


def links(sets: list[np.ndarray], other: list[np.ndarray] | None, component: list[int], least=LEAST) -> list[tuple[int, int]]:
    """Links that connect what likeness connects, between ``sets`` and
    ``other`` (numbered on from len(sets)) or, without it, among ``sets``.
    ``component``: what earlier links connect, one number for each document."""
    everything, base = sets + (other or []), len(sets)

    def leaves(own: list[np.ndarray]) -> list[int]:
        """Alike ones side by side: near copies mostly share their smallest shingles."""
        return sorted(range(len(own)), key=lambda i: (own[i][:2].tolist(), len(own[i])))

    forest, found = Forest(), []
    first: dict[int, int] = {}
    for i, c in enumerate(component):
        forest.join(first.setdefault(c, i), i)

    def likely(i: int, j: int) -> None:
        if forest.find(i) != forest.find(j) and _linked(everything[i], everything[j], least):
            forest.join(i, j)
            found.append((i, j))

    one = leaves(sets)
    two = leaves(other) if other is not None else one
    if other is None:
        for i, j in zip(one, one[1:], strict=False):
            likely(i, j)
    else:
        for i in {one[0], one[-1], one[len(one) // 2]}:
            for j in {two[0], two[-1], two[len(two) // 2]}:
                likely(i, base + j)
    now = [forest.find(i) for i in range(len(everything))]
    if len(set(now)) == 1:
        return found
    usual = int(np.median([len(s) for s in everything]))
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * usual).bit_length()))
    p = Tree.of(sets, bits, one)
    q = Tree.of(other, bits, two) if other is not None else None
    return found + traverse(p, q, now, lambda i, j: _linked(everything[i], everything[j], least), least)


def _task_links(least):
    """Links of each task's documents: rows (task, side, node, component, text)
    sorted by task; one task at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        rows = chain.from_iterable(zip(*(b.column(k).to_pylist() for k in range(b.num_columns)), strict=True) for b in batches)
        us, vs = [], []
        for _, group in groupby(rows, key=lambda r: r[0]):
            sides: tuple[dict, dict] = ({}, {})
            for _, side, node, component, text in group:
                if node not in sides[side]:
                    sides[side][node] = (component, shingle_set(text, known))
            if not sides[0]:
                continue
            everything = list(sides[0].items()) + list(sides[1].items())
            number: dict[bytes, int] = {}
            component = [number.setdefault(c, len(number)) for _, (c, _) in everything]
            other = [s for _, s in sides[1].values()] or None
            if other is None and len(everything) < 2:
                continue
            for i, j in links([s for _, s in sides[0].values()], other, component, least):
                us.append(everything[i][0])
                vs.append(everything[j][0])
            if len(us) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["a", "b"])
                us, vs = [], []
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["a", "b"])
    return run


def _units(members: DataFrame, least, unit_docs: int, unit_shingles: int) -> DataFrame:
    """Members (node, n, cluster) with their unit: ``band`` (sizes that can
    link lie in one band or two neighbouring ones) and ``part`` of the band.  A
    small cluster is one unit (band -1, part 0)."""
    total = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    large = total.where((F.col("docs") > unit_docs) | (F.col("shingles") > unit_shingles)).select("cluster", F.lit(True).alias("large"))
    width = float(np.log(least[1] / least[0]))
    marked = members.join(large, "cluster", "left").withColumn(
        "band", F.when(F.col("large"), F.floor(F.log(F.col("n").cast("double")) / width + 1e-9).cast("int")).otherwise(F.lit(-1)))
    sized = marked.where("large").groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")).select(
        "cluster", "band", F.greatest(F.ceil(F.col("docs") / unit_docs), F.ceil(F.col("shingles") / unit_shingles)).cast("int").alias("parts"))
    return marked.join(sized, ["cluster", "band"], "left").select(
        "node", "n", "cluster", "band", F.when(F.col("band") < 0, 0).otherwise(F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int").alias("part"))


def linked_components(docs: DataFrame, least: tuple[int, int] = LEAST, id_col: str = "doc_id", text_col: str = "text",
                      counters: int = COUNTERS, bucket: int = BUCKET, unit_docs: int = UNIT_DOCS, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, node, component, sha, stays.

    ``component_id`` is the smallest doc_id that links lead to; ``node``
    names the document's set and ``component`` its group (null for documents
    without words, which link with nothing); ``sha`` is the text's SHA-256 and
    ``stays`` marks the row that stands for its group.  A null text counts as empty.  A
    null doc_id is left out of the smallest unless its group has no other.
    Rows that repeat, or differ only in what makes no shingle, are one class.
    An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col)
    both = written(rows.mapInArrow(_classes(counters), "doc_id long, sha binary, n long, node binary, signature binary, counts binary"), "classes")
    listed = both.where("n IS NOT NULL").select("doc_id", "sha", "n", "node")
    levels = spark.sparkContext.broadcast(shingle_levels(spark, both.where("counts IS NOT NULL").select("counts"), counters))
    fronts = rows.mapInArrow(_prefix_rows(levels, least), "k long, hot boolean, a binary, b binary")
    met = written(fronts.repartition("k").sortWithinPartitions("k", F.desc("hot"))
                  .mapInArrow(_buckets(bucket), "bucket binary, a binary, b binary"), "buckets")
    # a class once, and the row that stands for it: smallest known doc_id, then text hash
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "sha")
    classes = both.where("n > 0").groupBy("node").agg(F.min(row).alias("least"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = written(classes, "class-rows")
    seats = met.where("bucket IS NOT NULL").select("bucket", F.col("a").alias("node")).distinct()
    may = (seats.join(classes, "node").select("bucket", "node", "n", "signature")
           .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_bucket_edges(least), "a binary, b binary"))
    near = met.where("bucket IS NULL").select("a", "b").union(may)
    clusters = connected_components(near).withColumnRenamed("component", "cluster")
    members = classes.select("node", "n", "least").join(clusters, "node")
    units = written(_units(members.select("node", "n", "cluster"), least, unit_docs, unit_shingles), "units")
    wanted = members.select("node", F.col("least.doc_id").alias("__id"), F.col("least.sha").alias("__sha"))
    hashed = rows.withColumn("sha", F.unhex(F.sha2("text", 256)))
    texts = hashed.join(wanted, hashed["doc_id"].eqNullSafe(wanted["__id"]) & (hashed["sha"] == wanted["__sha"]))
    texts = written(texts.dropDuplicates(["doc_id", "sha"]).select("node", F.encode("text", "UTF-8").alias("text")), "cluster-texts")
    component = connected_components(_links(units, texts, least))

    named = classes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = beside_group(named, ["component"], F.col("node"), {"top": (F.min("least"), F.min)})
    named = written(named.select("node", "component", "top"), "named")
    # both sides are plain tables here, so a class with very many rows is split by adaptive execution
    some = F.col("n") > 0
    return listed.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(some, F.col("top.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, F.col("node")).alias("node"), "component", "sha",
        F.when(some, row == F.col("top")).otherwise(True).alias("stays"))


def _run_tasks(texts: DataFrame, seats: DataFrame, least) -> DataFrame:
    """Links of the tasks that ``seats`` (node, task, side, component) describe."""
    return (seats.join(texts, "node").select("task", "side", "node", "component", "text")
            .repartition("task").sortWithinPartitions("task").mapInArrow(_task_links(least), "a binary, b binary"))


def _links(units: DataFrame, texts: DataFrame, least) -> DataFrame:
    """Links that connect what likeness connects within the clusters.

    A first round looks within each unit and between neighbours in the order
    of units, which already connects groups of near copies.  A second round
    takes the other pairs of units whose sizes can link, but for pairs that
    the first one has connected throughout."""
    own = ["cluster", "band", "part"]
    numbered = units.select(*own).distinct().withColumn(
        "i", F.row_number().over(Window.partitionBy("cluster").orderBy("band", "part"))).withColumn(
        "last", F.max("i").over(Window.partitionBy("cluster")))
    seated = written(units.join(numbered, own).select("node", "cluster", "band", "i", "last"), "seats")

    def task(i, j):
        return F.concat_ws("/", F.hex("cluster"), i, j)

    i = F.col("i")
    places = F.filter(F.array(
        F.struct(task(i, i).alias("task"), F.lit(0).alias("side")),
        F.when(i < F.col("last"), F.struct(task(i, i + 1).alias("task"), F.lit(0).alias("side"))),
        F.when(i > 1, F.struct(task(i - 1, i).alias("task"), F.lit(1).alias("side")))), lambda x: x.isNotNull())
    first = written(_run_tasks(texts, seated.select("node", F.explode(places).alias("p"), F.col("node").alias("component"))
                               .select("node", "p.task", "p.side", "component"), least), "links")
    several = seated.where("last > 2")
    if several.isEmpty():
        return first
    so_far = connected_components(first)
    tagged = written(several.join(so_far, "node", "left").withColumn("component", F.coalesce("component", "node")), "tagged")
    unit = tagged.groupBy("cluster", "band", "i").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    a, b = unit.alias("a"), unit.alias("b")
    pairs = a.join(b, (F.col("a.cluster") == F.col("b.cluster")) & (F.col("b.i") > F.col("a.i") + 1)
                   & (F.col("b.band") - F.col("a.band") <= 1)
                   & ~((F.col("a.lo") == F.col("a.hi")) & (F.col("b.lo") == F.col("b.hi")) & (F.col("a.lo") == F.col("b.lo"))))
    pairs = pairs.select(F.col("a.cluster").alias("cluster"), F.col("a.i").alias("x"), F.col("b.i").alias("y"))
    both = pairs.select("cluster", F.concat_ws("/", F.hex("cluster"), "x", "y").alias("task"),
                        F.explode(F.array(F.struct(F.col("x").alias("i"), F.lit(0).alias("side")),
                                          F.struct(F.col("y").alias("i"), F.lit(1).alias("side")))).alias("p"))
    seats = tagged.join(both.select("cluster", "task", "p.i", "p.side"), ["cluster", "i"]).select("node", "task", "side", "component")
    return first.union(_run_tasks(texts, seats, least))


def drop_near_duplicates(docs: DataFrame, least: tuple[int, int] = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each linked group, all columns as they were:
    the one with the smallest doc_id, then text hash; of rows that repeat in
    both, one.  Documents without words link with nothing and stay."""
    stay = linked_components(docs, least, id_col, text_col).where("stays").select("doc_id", "sha")
    return rows_that_stay(docs, stay, id_col, text_col)
