"""Byte-level BPE inside tasks: splitting texts, a bounded memory of what was
encoded before, and two ways of encoding a pre-token.

``RankQueue`` (operator 10) merges by a hierarchical-bitmap rank queue;
``PrefixTable`` (operator 7) gives the token count at every prefix.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

import regex

#: Distinct strings remembered per Python worker before the memory starts anew.
REMEMBERED = 600_000
#: Strings longer than this are not remembered.
LONG = 64


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def load_json(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """A byte-level tokenizers file: (token bytes -> id, special string -> id)."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = byte_alphabet()
    vocab = {}
    for token, i in spec["model"]["vocab"].items():
        if all(c in shown for c in token):
            vocab[bytes(shown[c] for c in token)] = i
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for t in special:
        vocab.pop(t.encode(), None)
    return vocab, special


def is_plain_byte_level(path: str) -> bool:
    """Whether a tokenizers file is byte-level BPE without normalising, whose
    single bytes come first and whose merges stand in the order of the ids of
    what they make."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or model.get("type") != "BPE"
            or any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix"))):
        return False
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    single = [model["vocab"][c] for c in byte_alphabet() if c in model["vocab"]]
    return len(single) == 256 and all(x < y for x, y in zip([max(single), *made], made, strict=False))


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes:
    printable Latin-1 stands for itself, the others count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class RankQueue:
    """Encodes one pre-token by merging, lowest rank first and leftmost first.

    Positions wait in one bucket per rank.  Two levels of bitmaps say which
    buckets hold something: a word of 256 bits for as many ranks, and above
    them one bit for each word that is not zero.  Finding the next rank is two
    find-first-sets, whatever the length of the pre-token.  Merging joins a
    position with its right neighbour in a linked list; entries whose pair
    changed meanwhile are stale, known by the rank noted at the position, and
    skipped when met."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.words = [0] * ((max(ranks.values(), default=0) >> 8) + 1)  # all zero between calls

    def encode(self, piece: bytes) -> list[int]:
        ranks, words = self.ranks, self.words
        get = ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after = list(range(1, n + 2))   # start of the next part
        before = list(range(-1, n))     # start of the part before
        noted = [-1] * (n + 1)          # rank of the pair that starts here; -1: none, or not a part's start
        buckets: dict[int, list[int]] = {}
        summary = 0

        def push(rank: int, at: int) -> None:
            nonlocal summary
            noted[at] = rank
            if rank in buckets:
                buckets[rank].append(at)
            else:
                buckets[rank] = [at]
                words[rank >> 8] |= 1 << (rank & 255)
                summary |= 1 << (rank >> 8)

        for i in range(n - 1):
            r = get(piece[i:i + 2])
            if r is not None:
                push(r, i)
        while summary:
            a = (summary & -summary).bit_length() - 1
            w = words[a]
            first = w & -w
            rank = a << 8 | first.bit_length() - 1
            words[a] = w = w ^ first
            if not w:
                summary ^= 1 << a
            waiting = buckets.pop(rank)
            if len(waiting) > 1:
                waiting.sort()
            for k, i in enumerate(waiting):
                if noted[i] != rank:
                    continue
                j = after[i]
                end = after[j]
                after[i] = end
                before[end] = i
                noted[j] = noted[i] = -1
                lowest = rank
                if end < n:
                    r = get(piece[i:after[end]])
                    if r is not None:
                        push(r, i)
                        if r < lowest:
                            lowest = r
                p = before[i]
                if p >= 0:
                    r = get(piece[p:end])
                    if r is None:
                        noted[p] = -1
                    else:
                        push(r, p)
                        if r < lowest:
                            lowest = r
                if lowest < rank:  # a merge made a pair that goes first: the rest waits again
                    for later in waiting[k + 1:]:
                        if noted[later] == rank:
                            push(rank, later)
                    break
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:after[i]]])
            i = after[i]
        return out


class PrefixTable:
    """Token counts at every prefix of a pre-token, by dynamic programming.

    The encoding of a prefix ends with exactly one token; take it away and
    what is left is the encoding of a shorter prefix.  So for each prefix the
    table looks for the one token that ends there and may follow the last
    token of the prefix before it; the count is that prefix's count and one.
    Two tokens may stand side by side if encoding their joint bytes gives just
    the two; that is remembered per pair."""

    def __init__(self, vocab: dict[bytes, int]):
        self.vocab = vocab
        self.longest = max(map(len, vocab), default=1)
        self.tails = {token[k:] for token in vocab for k in range(len(token))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.queue = RankQueue(vocab)

    def _may_follow(self, left: bytes, right: bytes) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            joint = left + right
            known = self.queue.encode(joint) == [self.vocab[left], self.vocab[right]]
            self.pairs[left, right] = known
        return known

    def counts(self, piece: bytes) -> list[int]:
        """counts(p)[i]: tokens of p[:i], for i from 0 to len(p)."""
        vocab, tails, follows = self.vocab, self.tails, self._may_follow
        count, last = [0], [b""]
        for i in range(1, len(piece) + 1):
            for j in range(i - 1, max(-1, i - 1 - self.longest), -1):
                token = piece[j:i]
                if token not in tails:
                    raise ValueError(f"no encoding ends at byte {i}")
                if token in vocab and (not j or follows(last[j], token)):
                    count.append(count[j] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no encoding ends at byte {i}")
        return count


class Remembered:
    """Values of whole texts from the values of their pre-tokens.

    ``of_pieces`` maps a list of pre-tokens to their values, ``combine`` joins
    values in order.  A text is cut at its single spaces first: a stretch that
    is not empty and neither starts nor ends with white space is split by the
    pattern as it would be in its text, with the space before it.  So values
    are remembered by stretch, and the pattern runs only over new ones.  A
    text in which white space meets a space goes through the pattern whole.
    With ``of_texts``, an encoder that splits by the pattern itself, new
    stretches go straight there."""

    def __init__(self, pattern: str, of_pieces: Callable[[list[str]], list] | None, combine: Callable,
                 limit: int = REMEMBERED, of_texts: Callable[[list[str]], list] | None = None):
        self.pattern = regex.compile(pattern)
        self.of_pieces, self.combine, self.limit = of_pieces, combine, limit
        if of_texts is not None:
            self._plain = of_texts
        self.pieces: dict[str, object] = {}
        self.stretches: dict[str, object] = {}

    def _known(self, pieces: list[str]) -> list:
        if len(self.pieces) >= self.limit:
            self.pieces.clear()
        known = self.pieces
        new = list({p for p in pieces if p not in known})
        found = dict(zip(new, self.of_pieces(new), strict=True)) if new else {}
        for p, v in found.items():
            if len(p) <= LONG:
                known[p] = v
        return [known[p] if p in known else found[p] for p in pieces]

    def _plain(self, texts: list[str]) -> list:
        """Values of ``texts``, each through the pattern."""
        split = [self.pattern.findall(t) for t in texts]
        values = self._known([p for s in split for p in s])
        out, at = [], 0
        for s in split:
            out.append(self.combine(values[at:at + len(s)]))
            at += len(s)
        return out

    def many(self, texts: list[str]) -> list:
        """The value of each text."""
        if len(self.stretches) >= self.limit:
            self.stretches.clear()
        known = self.stretches
        cut = [t.split(" ") for t in texts]
        values = [list(map(known.get, c)) for c in cut]
        new: set[str] = set()
        for c, v in zip(cut, values, strict=True):
            v[0] = b""  # a text's first stretch has no space before it and is split apart from the others
            if None in v:
                new.update(s for s, x in zip(c, v, strict=True) if x is None)
        odd = {s for s in new if not s or s[0].isspace() or s[-1].isspace()}
        fine = list(new - odd)
        found = dict(zip(fine, self._plain([f" {s}" for s in fine]), strict=True)) if fine else {}
        for s, v in found.items():
            if len(s) <= LONG:
                known[s] = v
        whole = [i for i, (t, c) in enumerate(zip(texts, cut, strict=True))
                 if t and (not c[0] or c[0][-1:].isspace() or odd and not odd.isdisjoint(c[1:]))]
        out: list = [None] * len(texts)
        for i, v in zip(whole, self._plain([texts[i] for i in whole]), strict=True):
            out[i] = v
        rest = [i for i in range(len(texts)) if out[i] is None]
        first = self._plain([cut[i][0] for i in rest])
        for i, v in zip(rest, first, strict=True):
            own = values[i]
            own[0] = v
            if None in own:
                own = [found[s] if x is None else x for s, x in zip(cut[i], own, strict=True)]
            out[i] = self.combine(own)
        return out
