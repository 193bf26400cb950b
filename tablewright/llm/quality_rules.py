"""Operator 12: quality rules under weak supervision.

Every rule looks at a text's statistics and votes: good, bad, or it abstains.
No rule is taken at its word.  How often each one is right about good and about
bad texts is estimated from all votes together by expectation-maximisation,
with no labels: a text's quality is the hidden class that explains its votes.
The posterior probability of the good class then decides, where a filter by
rules alone would ask that all pass.

A text meets the model only through its votes, and there are at most 3^rules
different ballots, so the model is fitted on the counts of ballots over all
texts.  DataFrame and SQL functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import texts_of, written

_BLANK = r"[\x20\x09-\x0D]+"
#: Words in a window that may repeat.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Votes by two conditions over the statistics (SQL text); where neither holds it abstains."""

    name: str
    good: str
    bad: str

    @property
    def vote(self) -> str:
        return f"CASE WHEN {self.good} THEN 1 WHEN {self.bad} THEN -1 ELSE 0 END"


#: The rules, over the columns of ``statistics``.  Most only speak when something is wrong, and what is wrong
#: with a text is seen by more than one of them: their agreement is what tells good votes from bad ones.
RULES = (
    Rule("length", "n_words >= 40", "n_words < 15"),
    Rule("word_size", "FALSE", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    Rule("symbols", "FALSE", "100 * n_symbols > 10 * n_words"),
    Rule("plain_words", "100 * n_plain >= 95 * n_words AND n_words > 0", "100 * n_plain < 80 * n_words"),
    Rule("repeats", "FALSE", "100 * n_repeat_words > 15 * n_words"),
    Rule("variety", "FALSE", "n_words >= 40 AND n_distinct * n_distinct < 9 * n_words"),
    Rule("lines", "FALSE", "10 * n_dup_lines > 3 * n_lines"),
    Rule("sentences", "n_words >= 40 AND n_ends * 100 BETWEEN 2 * n_words AND 30 * n_words", "n_words >= 40 AND (n_ends * 200 < n_words OR n_ends * 2 > n_words)"),
    Rule("capitals", "FALSE", "100 * n_capitals > 30 * word_chars"),
    Rule("shouts", "FALSE", "100 * n_shouts > 10 * n_words"),
)
#: Texts that fail whatever the votes say.
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"

#: Rounds of expectation-maximisation, and what is believed before any text is seen: the share of good texts,
#: how often a rule votes for (+) and against (-) a text of either class, all that as if seen in so many texts.
ROUNDS, SHARE, SEEN = 40, 0.8, 10.0
FOR_GOOD, FOR_BAD, AGAINST_GOOD, AGAINST_BAD = 0.5, 0.3, 0.05, 0.3
#: A text is kept from this posterior on.
THRESHOLD = 0.5


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in a window of so many words that occurs twice or
    more in the text, the first one included.

    Hashes show whether any window may repeat; then windows are sorted by hash
    and words, so that only windows equal word by word count, and the places
    that they cover are added up in one pass."""
    def exact(w: Column, h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), F.slice(w, i + 1, window).alias("words"), i.alias("i"))))

        def places(s: Column) -> Column:
            def again(x: Column, k: Column) -> Column:
                alike = [(F.get(s, n)["h"] == x["h"]) & (F.get(s, n)["words"] == x["words"]) for n in (k - 1, k + 1)]
                return F.coalesce(alike[0], F.lit(False)) | F.coalesce(alike[1], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, again), lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(_let(ordered, places), start, lambda acc, i: F.struct(
            (acc["n"] + window - F.greatest(F.lit(0), acc["end"] - i)).alias("n"), (i + window).alias("end")), lambda acc: acc["n"])

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return F.when(F.size(w) < window, F.lit(0)).otherwise(
            _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(w, h))))

    return _let(words, of)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and, as long, n_words, word_chars,
    n_symbols, n_lines (those with a word), n_dup_lines, n_repeat_words,
    n_capitals (A to Z), n_shouts (exclamation marks), n_plain (words of letters
    that one mark may follow), n_ends (words that end a sentence) and
    n_distinct (different words), of the whole text (null counts as empty)."""
    text, w = F.col("text"), F.col("w")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(text, pattern, ""))

    counts = {
        "n_words": F.size(w), "word_chars": F.char_length(F.array_join(w, "")), "n_symbols": left(r"[^#*$%&|<>]+"),
        "n_lines": F.size(F.col("lines")), "n_dup_lines": F.size(F.col("lines")) - F.size(F.array_distinct(F.col("lines"))),
        "n_repeat_words": repeated_words(w), "n_capitals": left("[^A-Z]+"), "n_shouts": left("[^!]+"),
        "n_plain": F.size(F.filter(w, lambda x: x.rlike(r"^\p{L}+[.,;:?!]?\z"))), "n_ends": F.size(F.filter(w, lambda x: x.rlike(r"[.?!]\z"))),
        "n_distinct": F.size(F.array_distinct(w)),
    }
    rows = texts_of(docs, id_col, text_col).select("doc_id", "text", words_of(text).alias("w"), lines.alias("lines"))
    return rows.select("doc_id", *[c.cast("long").alias(n) for n, c in counts.items()])


def ballots(stats: DataFrame, rules=RULES) -> Column:
    return F.array(*[F.expr(r.vote).cast("int") for r in rules])


@dataclass(frozen=True)
class Model:
    """What the votes tell: the share of good texts, and for each rule how
    often it votes for and against good and bad texts."""

    share: float
    for_good: tuple[float, ...]
    for_bad: tuple[float, ...]
    against_good: tuple[float, ...]
    against_bad: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        """Probability of the good class, given the votes."""
        score = F.lit(math.log(self.share / (1 - self.share)))
        for j, (fg, fb, ag, ab) in enumerate(zip(self.for_good, self.for_bad, self.against_good, self.against_bad, strict=True)):
            vote = F.get(votes, F.lit(j))
            score = score + (F.when(vote == 1, max(math.log(fg / fb), 0.0)).when(vote == -1, min(math.log(ag / ab), 0.0)).otherwise(0.0))
        return 1 / (1 + F.exp(-score))


def fit(votes: DataFrame, rules: int, rounds: int = ROUNDS, votes_col: str = "votes") -> Model:
    """The model after so many rounds of expectation-maximisation on the counts
    of ballots.

    Votes of a text are taken as independent given its class, and abstentions as
    saying nothing.  A vote may turn out to say nothing, but never the opposite
    of what it says, so the classes cannot swap their names.

    One row holds all ballots (3^rules at most, however many texts there are),
    and one expression runs all rounds over it; what comes to the driver is the
    model's 4 * rules + 1 numbers.  Without texts the model is what is believed
    beforehand."""
    counts = votes.groupBy(F.col(votes_col).alias("votes")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    table = counts.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("ballots"))
    each = F.sequence(F.lit(0), F.lit(rules - 1))
    believed = {"fg": FOR_GOOD, "fb": FOR_BAD, "ag": AGAINST_GOOD, "ab": AGAINST_BAD}
    start = F.struct(F.lit(SHARE).alias("share"), *[F.array_repeat(F.lit(p), rules).alias(k) for k, p in believed.items()])

    def total(rows: Column, of) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda s, x: s + of(x))

    def one_round(m: Column, _: Column) -> Column:
        def weighed(x: Column) -> Column:
            def add(s: Column, j: Column) -> Column:
                vote = F.get(x["votes"], j)
                return s + (F.when(vote == 1, F.greatest(F.log(F.get(m["fg"], j) / F.get(m["fb"], j)), F.lit(0.0)))
                            .when(vote == -1, F.least(F.log(F.get(m["ag"], j) / F.get(m["ab"], j)), F.lit(0.0))).otherwise(F.lit(0.0)))
            score = F.aggregate(each, F.log(m["share"] / (1 - m["share"])), add)
            return F.struct(x["votes"].alias("votes"), x["n"].alias("n"), (x["n"] / (1 + F.exp(-score))).alias("good"))

        def new(rows: Column) -> Column:
            def rate(name: str, vote: int, weight) -> Column:
                def of(j: Column) -> Column:
                    cast = total(rows, lambda x: F.when(F.get(x["votes"], j) == vote, weight(x)).otherwise(F.lit(0.0)))
                    return (SEEN * believed[name] + cast) / (SEEN + total(rows, weight))
                return F.transform(each, of).alias(name)

            good, bad = (lambda x: x["good"]), (lambda x: x["n"] - x["good"])
            return F.struct(((SEEN * SHARE + total(rows, good)) / (SEEN + total(rows, lambda x: x["n"]))).alias("share"),
                            rate("fg", 1, good), rate("fb", 1, bad), rate("ag", -1, good), rate("ab", -1, bad))

        return _let(F.transform(F.col("ballots"), weighed), new)

    got = table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, one_round).alias("m")).first()["m"]
    return Model(got["share"], *[tuple(got[k]) for k in believed])


def judge(docs: DataFrame, rules=RULES, base_failed: str = BASE_FAILED, threshold: float = THRESHOLD, rounds: int = ROUNDS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the columns of ``statistics``, votes (array, in
    the order of the rules), base_failed, posterior and kept.

    A text is kept unless ``base_failed`` holds or its posterior stays under the
    threshold.  Null and empty texts have no words and fail.  Repeated rows are
    texts of their own, and each counts in the model.  An empty table gives an
    empty result.  The statistics are written once; only numbers are shuffled."""
    stats = written(statistics(docs, id_col, text_col), "quality")
    voted = stats.withColumn("votes", ballots(stats, rules))
    model = fit(voted, len(rules), rounds)
    failed = F.expr(base_failed)
    posterior = model.posterior(F.col("votes"))
    return (voted.withColumn("base_failed", failed).withColumn("posterior", posterior)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))
