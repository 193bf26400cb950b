"""Operator 1: toxicity by classifier chains.

The categories are predicted one after the other by linear models.  Each model
sees the text's features and the probabilities of the categories before it.
For training, those are out-of-fold predictions - made by models that did not
see the row - so a later model learns how far it may trust an earlier one on
new text.

The models are fitted on a bounded sample of labelled rows (TRAIN_ROWS); every
document is scored, whole."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import steps, texts_of

#: Labelled rows used for training at most, chosen by a hash of their id.
TRAIN_ROWS = 6000
#: Features of a training row at most: the smallest of their hashes, so about as many words of any part of it.
MOST_OF_ROW = 8192
#: Folds of the out-of-fold predictions.
FOLDS = 5
#: Stems as well as whole words: prefixes of these lengths are features too.
PREFIXES = (4, 5, 6)
#: A feature enters a model if its chi-squared with the category is this large, and at most so many do.
LEAST_CHI2, MOST_FEATURES = 30.0, 1000
#: The categories before the last: groups of the features that go most strongly with the last one's label.
KINDS = ("kind_1", "kind_2")
#: So many features are grouped at most; two that share more than this part of the rarer one's rows stay together.
MOST_TELLING, TOGETHER = 200, 0.9
THRESHOLD = 0.5
_WORD = regex.compile(r"[^\W\d_]+")
#: Distinct words whose features a task remembers.
REMEMBERED = 500_000


def word_features(word: str) -> tuple[int, ...]:
    """A word and its prefixes as 32-bit feature numbers."""
    own = [f"={word}", *[f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n]]
    return tuple(zlib.crc32(f.encode()) for f in own)


def text_features(text: str) -> set[int]:
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


@dataclass
class Linear:
    """A logistic model over feature numbers and earlier probabilities."""

    numbers: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def score(self, hits: np.ndarray, probabilities: np.ndarray) -> float:
        """``hits``: places in ``numbers`` of the features the text has."""
        z = self.bias + self.weights[hits].sum() + (self.earlier * probabilities).sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


@dataclass
class Chain:
    """Models of the categories in order; ``seen`` maps a feature number to
    its (model, place) pairs."""

    categories: list[str]
    models: list[Linear]
    seen: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    def __post_init__(self):
        for m, model in enumerate(self.models):
            for place, number in enumerate(model.numbers.tolist()):
                self.seen.setdefault(number, []).append((m, place))

    def score(self, features) -> np.ndarray:
        hits: list[list[int]] = [[] for _ in self.models]
        for f in features:
            for m, place in self.seen.get(f, ()):
                hits[m].append(place)
        out = np.zeros(len(self.models))
        for m, model in enumerate(self.models):
            out[m] = model.score(np.array(hits[m], int), out[:m])
        return out


class Scorer:
    """Scores texts within a task, remembering what words mean to the chain."""

    def __init__(self, chain: Chain):
        self.chain, self.base = chain, chain.score(())
        self.known: dict[str, tuple[int, ...]] = {}

    def scores(self, texts: list[str]) -> np.ndarray:
        known, seen, out = self.known, self.chain.seen, []
        for text in texts:
            hits: set[int] = set()
            for w in set(text.lower().split()):
                f = known.get(w)
                if f is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    f = known[w] = tuple(x for part in _WORD.findall(w) for x in word_features(part) if x in seen)
                if f:
                    hits.update(f)
            out.append(self.chain.score(hits) if hits else self.base)
        return np.array(out).reshape(len(out), len(self.chain.models))


@dataclass
class Rows:
    """Training rows: which of the ``numbers`` each has, as (row, place) pairs."""

    numbers: np.ndarray
    row: np.ndarray
    place: np.ndarray
    n: int

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        numbers, place = np.unique(flat, return_inverse=True)
        return cls(numbers, np.repeat(np.arange(len(rows)), [len(r) for r in rows]), place, len(rows))


def _association(data: Rows, y: np.ndarray, inside: np.ndarray):
    """Of each feature over the rows ``inside``: chi-squared with the category, and
    how many rows have the feature with and without the category."""
    n, positive, size = int(inside.sum()), float(y[inside].sum()), len(data.numbers)
    counted = inside[data.row]
    both = np.bincount(data.place, counted & (y[data.row] > 0), size)     # rows with the feature and the category
    only = np.bincount(data.place, counted, size) - both
    miss, none = positive - both, (n - positive) - only
    chi2 = n * (both * none - only * miss) ** 2 / np.maximum((both + only) * (miss + none) * positive * (n - positive), 1e-9)
    return chi2, both, only


def kinds_of(rows: list[np.ndarray], toxic: np.ndarray, kinds: int) -> np.ndarray:
    """Which of so many kinds each toxic row belongs to, shape (kinds, rows).

    The features that go with the label beyond chance are taken strongest
    first.  One that shares its toxic rows with an earlier one (a word and its
    prefixes, say) joins that one's kind, another the kind with the fewest
    rows so far.  A row belongs to a kind if it is toxic and has one of the
    kind's features."""
    data, y = Rows.of(rows), np.asarray(toxic, float)
    marks = np.zeros((kinds, data.n), bool)
    positive = y.sum()
    if not kinds or positive in (0.0, float(data.n)):
        return marks
    chi2, both, only = _association(data, y, np.ones(data.n, bool))
    telling = np.flatnonzero((chi2 >= LEAST_CHI2) & (both >= 2) & (both * (data.n - positive) > only * positive))
    telling = telling[np.argsort(-chi2[telling], kind="stable")[:MOST_TELLING]]
    at = np.full(len(data.numbers), -1)
    at[telling] = np.arange(len(telling))
    used = (at[data.place] >= 0) & (y[data.row] > 0)
    has = np.zeros((len(telling), data.n), bool)
    has[at[data.place][used], data.row[used]] = True
    count, kind = has.sum(1), np.zeros(len(telling), int)
    for f in range(len(telling)):
        shared = (has[:f] & has[f]).sum(1) / np.minimum(count[:f], count[f])
        kind[f] = kind[shared.argmax()] if f and shared.max() > TOGETHER else marks.sum(1).argmin()
        marks[kind[f]] |= has[f]
    return marks


def _fit(data: Rows, earlier: np.ndarray, y: np.ndarray, inside: np.ndarray, rounds: int = 100, ridge: float = 0.02):
    """Logistic regression with ridge on the rows ``inside``, by accelerated
    gradient steps; features that go with the category beyond chance take
    part.  Returns the model and its probabilities for all rows."""
    n, e = int(inside.sum()), earlier.shape[1]
    positive = float(y[inside].sum())
    if not n or positive in (0.0, float(n)):
        rate = (positive + 0.5) / (n + 1) if n else 0.0
        model = Linear(data.numbers[:0], np.zeros(0), np.zeros(e), float(np.log(max(rate, 1e-9) / max(1 - rate, 1e-9))))
        return model, np.full(data.n, rate)
    chi2, both, only = _association(data, y, inside)
    size = len(data.numbers)
    keep = np.flatnonzero((chi2 >= LEAST_CHI2) & (both + only >= 2))
    keep = np.sort(keep[np.argsort(-chi2[keep], kind="stable")[:MOST_FEATURES]])
    k = len(keep)
    at = np.full(size, -1)
    at[keep] = np.arange(k)
    used = at[data.place] >= 0
    col, row = at[data.place][used], data.row[used]

    def forward(theta):
        return np.bincount(row, theta[col], data.n) + earlier @ theta[k:k + e] + theta[-1]

    def backward(g):
        g = np.where(inside, g, 0.0)
        return np.r_[np.bincount(col, g[row], k), earlier.T @ g, g.sum()]

    v = np.ones(k + e + 1)
    top = 1.0
    for _ in range(10):  # the largest eigenvalue of X'X sets the step
        v = backward(forward(v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-30)
    step = 1 / (0.3 * top + ridge)
    penalty = np.r_[np.full(k + e, ridge), 0.0]
    theta = look = np.zeros(k + e + 1)
    t = 1.0
    for _ in range(rounds):
        g = 1 / (1 + np.exp(-np.clip(forward(look), -30, 30))) - y
        new = look - step * (backward(g) + penalty * look)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look = new + (t - 1) / t_new * (new - theta)
        theta, t = new, t_new
    model = Linear(data.numbers[keep], theta[:k], theta[k:k + e], float(theta[-1]))
    return model, 1 / (1 + np.exp(-np.clip(forward(theta), -30, 30)))


def fit_chain(rows: list[np.ndarray], labels: dict[str, np.ndarray], fold_of: np.ndarray, folds: int = FOLDS) -> Chain:
    """``rows``: each row's sorted feature numbers; ``labels``: 0/1 by
    category, in chain order; ``fold_of``: each row's fold."""
    data = Rows.of(rows)
    earlier = np.zeros((data.n, 0))
    models = []
    for y in labels.values():
        y = np.asarray(y, float)
        models.append(_fit(data, earlier, y, np.ones(data.n, bool))[0])
        held_out = np.zeros(data.n)
        for f in range(folds):
            if (outside := fold_of == f).any():
                held_out[outside] = _fit(data, earlier, y, ~outside)[1][outside]
        earlier = np.column_stack([earlier, held_out])
    return Chain(list(labels), models)


def train(docs: DataFrame, labels: DataFrame, kinds: tuple[str, ...] = KINDS, train_rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Chain:
    """A chain of one model for each kind and, last, one for toxicity.

    The kinds are found in the labelled rows (``kinds_of``): their names say
    nothing about the words.  They are found once, in all training rows, before
    the folds.  Rows whose label or id is null are left out; of an id labelled
    twice the larger label counts.  With no labelled rows, or only one class,
    the model is the constant rate (0 without rows)."""
    chosen = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))  # the sample: a documented bound
    picked = texts_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most train_rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            ids, y = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "y"))
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            features = [np.sort(np.array(list(text_features(t)), "<u4"))[:MOST_OF_ROW].tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(y, pa.int32()), pa.array(features, pa.binary())],
                                             ["doc_id", "y", "features"])

    # one row for each id, before anything reaches the driver: of an id with several texts the least features
    per_id = picked.mapInArrow(run, "doc_id long, y int, features binary").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("features").alias("features"))
    got = sorted(per_id.toLocalIterator(), key=lambda r: r["doc_id"])  # at most train_rows rows
    rows = [np.frombuffer(bytes(r["features"]), "<u4").astype(np.int64) for r in got]
    toxic = np.array([r["y"] > 0 for r in got], float)
    by_kind = dict(zip(kinds, kinds_of(rows, toxic, len(kinds)).astype(float), strict=True))
    fold_of = np.array([zlib.crc32(str(r["doc_id"]).encode()) % FOLDS for r in got], int)
    return fit_chain(rows, by_kind | {"toxic": toxic}, fold_of)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, p_<category> for each category of the
    chain, and toxic: whether the last one reaches the threshold.

    A null or empty text has no features and gets the models' base rates.
    Every word of a text counts, however long it is."""
    names = [f"p_{c}" for c in chain.categories]
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(chain)  # at most MOST_FEATURES numbers for each category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for part in steps(batches):
            p = scorer.scores(part.column(part.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), *[pa.array(p[:, k]) for k in range(len(names))],
                 pa.array(p[:, -1] >= threshold)], ["doc_id", *names, "toxic"])

    fields = ", ".join(["doc_id long", *[f"{n} double" for n in names], "toxic boolean"])
    return texts_of(docs, id_col, text_col).mapInArrow(run, fields)


def drop_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns as they were.  Rows
    stay where they are: the chain looks at the text column in passing."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for part in steps(batches, text_col):
            p = scorer.scores([t or "" for t in part.column(names.index(text_col)).to_pylist()])
            yield part.filter(pa.array(p[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
