"""Quality rules as weak supervision.

Nine rules each vote good, bad or abstain on a document.  The accuracies of the
rules are not given: expectation-maximisation over the histogram of vote
patterns (at most 3**9 rows, whatever the corpus holds) estimates for each rule
how often it votes what on good and on bad documents.  A document is kept when
its posterior probability of being good is at least ``keep_at``; no single rule
decides, except the two base limits that ``base_failed`` states.

Everything on the data path is a Spark column expression.  Only the vote
histogram reaches the driver.

Edge cases: a null text is an empty one and has zero words, so it fails the base
limits.  Very long texts are judged whole.  Ties at ``keep_at`` are kept.  Repeated rows are judged one by one.  An empty table gives an empty
result and uniform rule accuracies.  Extra columns do not matter; ``keep``
returns all columns of its input unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.textops import BLANKS, WORD_GAP, let, lines, settle, whole, words, written

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
RULES = ("length", "symbols", "symbol_words", "repeats", "dup_lines", "word_length", "capitals", "variety", "sentences")
GOOD, ABSTAIN, BAD = 2, 1, 0
#: What a rule is taken to vote (bad, abstain, good) on bad and on good documents before any is seen.
GUESS = {BAD: (0.4, 0.1, 0.5), GOOD: (0.01, 0.19, 0.8)}
_OWN = "__harrow_quality"


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows of eight words that the text holds at least twice.

    Windows are compared by a 64-bit hash, inside one text only: word hashes are
    joined to hashes of two, four and eight words.  Sorting (hash, position) pairs finds the repeated windows in
    n log n; texts without a repeat, nearly all, skip the sort.
    """

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            pairs,
            lambda s: F.filter(
                s,
                lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)),
            ),
        )
        at = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return F.aggregate(
            at,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total")),
            lambda a, x: F.struct(x.alias("last"), (a["total"] + F.least(F.lit(WINDOW), x - a["last"])).alias("total")),
            lambda a: a["total"],
        )

    def doubled(h: Column, step: int) -> Column:
        """Hashes of runs twice as long; the last ``step`` are padded and go at the end."""
        return F.zip_with(h, F.slice(h, F.lit(1 + step), F.size(h)), lambda x, y: F.xxhash64(x, y))

    runs = let(doubled(hashes, 1), lambda two: let(doubled(two, 2), lambda four: doubled(four, 4)))
    found = F.slice(runs, F.lit(1), F.size(hashes) - (WINDOW - 1))
    repeats = let(found, lambda f: F.when(F.size(F.array_distinct(f)) == F.size(f), F.lit(0).cast("long")).otherwise(covered(f)))
    return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(repeats)


def features(text: Column) -> Column:
    """Struct of the counts that rules and base limits read; one pass over the words."""

    def counts(tokens: Column, rows: Column, hashes: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.aggregate(tokens, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
            F.regexp_count(whole(text), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.regexp_count(whole(text), F.lit(SYMBOLS + "($|" + WORD_GAP + ")")).cast("long").alias("n_symbol_words"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
            _repeat_words(hashes).alias("n_repeat_words"),
            F.size(rows).cast("long").alias("n_lines"),
            F.size(F.array_distinct(hashes)).cast("long").alias("n_distinct"),
            F.regexp_count(whole(text), F.lit("\\p{Lu}{2}")).cast("long").alias("n_capitals"),
            F.regexp_count(whole(text), F.lit("\\p{L}[.?]($|" + WORD_GAP + ")")).cast("long").alias("n_stops"),
        )

    full = F.filter(lines(text), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(words(text), lambda t: let(full, lambda r: let(F.transform(t, lambda w: F.xxhash64(w)), lambda h: counts(t, r, h))))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def votes(f: Column) -> Column:
    """One digit in base three for each rule, the first rule lowest."""
    n = f["n_words"]
    never = F.lit(False)
    cast = {
        "length": _vote(n < 20, n >= 50),
        "symbols": _vote(10 * f["n_symbols"] > n, never),
        "symbol_words": _vote(10 * f["n_symbol_words"] > n, never),
        "repeats": _vote(10 * f["n_repeat_words"] > 3 * n, never),
        "dup_lines": _vote(5 * f["n_dup_lines"] > 2 * f["n_lines"], never),
        "word_length": _vote((f["word_chars"] < 3 * n) | (f["word_chars"] > 12 * n), never),
        "capitals": _vote(2 * f["n_capitals"] > n, never),
        "variety": _vote(5 * f["n_distinct"] < n, (2 * f["n_distinct"] > n) & (n >= 20)),
        "sentences": _vote(100 * f["n_stops"] < n, 25 * f["n_stops"] >= n),
    }
    return sum((cast[r] * F.lit(3**k) for k, r in enumerate(RULES)), F.lit(0))


def base_failed(f: Column) -> Column:
    return (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])


@dataclass
class RuleModel:
    """Prior of a good document, and for each rule how often each class draws each vote.

    Whatever a rule says, an abstention too, is evidence by the ratio of its
    probabilities, in the fit and in the verdicts alike.
    """

    prior: float = 0.8
    good: list[list[float]] = field(default_factory=lambda: [list(GUESS[GOOD]) for _ in RULES])
    bad: list[list[float]] = field(default_factory=lambda: [list(GUESS[BAD]) for _ in RULES])

    def weights(self, rule: int) -> list[float]:
        """Log odds for a good document that a bad vote, an abstention and a good vote bring."""
        return [math.log(g) - math.log(b) for g, b in zip(self.good[rule], self.bad[rule], strict=True)]

    def log_odds(self, pattern: int) -> float:
        x = math.log(self.prior) - math.log(1 - self.prior)
        return x + sum(self.weights(k)[pattern // 3**k % 3] for k in range(len(RULES)))

    def probability(self, pattern: Column) -> Column:
        """Posterior of a good document as a column expression."""
        x = F.lit(math.log(self.prior) - math.log(1 - self.prior))
        for k in range(len(RULES)):
            w = self.weights(k)
            digit = F.pmod(F.floor(pattern / F.lit(3**k)), F.lit(3))
            x = x + F.when(digit == BAD, w[BAD]).when(digit == GOOD, w[GOOD]).otherwise(w[ABSTAIN])
        return 1 / (1 + F.exp(-x))


def expect_maximise(histogram: dict[int, int], rounds: int = 500) -> RuleModel:
    """Two latent classes fitted to a histogram of vote patterns.

    ``GUESS`` enters as pseudo-counts of a twentieth of the documents: it keeps
    probabilities off zero and ties the classes to their meaning.
    """
    model = RuleModel()
    total = sum(histogram.values())
    if not total:
        return model
    pseudo = 1.0 + total / 20
    digits = {p: [p // 3**k % 3 for k in range(len(RULES))] for p in histogram}
    for _ in range(rounds):
        share = {p: 1 / (1 + math.exp(-model.log_odds(p))) for p in histogram}
        mass = sum(share[p] * n for p, n in histogram.items())
        fresh = RuleModel(prior=(mass + 0.8 * pseudo) / (total + pseudo), good=[], bad=[])
        for k in range(len(RULES)):
            g = [pseudo * x for x in GUESS[GOOD]]
            b = [pseudo * x for x in GUESS[BAD]]
            for p, n in histogram.items():
                g[digits[p][k]] += share[p] * n
                b[digits[p][k]] += (1 - share[p]) * n
            fresh.good.append([x / sum(g) for x in g])
            fresh.bad.append([x / sum(b) for x in b])
        moved = max(abs(x - y) for a, b in ((fresh.good, model.good), (fresh.bad, model.bad), ([[fresh.prior]], [[model.prior]])) for p, q in zip(a, b, strict=True) for x, y in zip(p, q, strict=True))
        model = fresh
        if moved < 1e-9:
            break
    return model


def _fitted(judged: DataFrame) -> RuleModel:
    """The model of a table of vote patterns."""
    patterns = judged.groupBy("pattern").agg(F.count("*").alias("n"))
    return expect_maximise({r["pattern"]: r["n"] for r in patterns.collect()})


def fit(docs: DataFrame, text: str = "text") -> RuleModel:
    """Estimate the rules' accuracies over all documents."""
    return _fitted(docs.select(votes(features(F.col(text))).alias("pattern")))


def score(docs: DataFrame, model: RuleModel | None = None, text: str = "text", doc_id: str = "doc_id", keep_at: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the posterior ``p_good``.

    The texts are read once: the counts, a few integers a document, are
    checkpointed and serve both the fit and the verdicts.
    """
    judged = docs.select(F.col(doc_id).alias("doc_id"), features(F.col(text)).alias("f"))
    if model is None:
        judged = settle(judged)
        model = _fitted(judged.select(votes(F.col("f")).alias("pattern")))
    f = F.col("f")
    judged = judged.withColumn("failed", base_failed(f)).withColumn("p", model.probability(votes(f)))
    return judged.select(
        "doc_id",
        *[f[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("failed").alias("base_failed"),
        (~F.col("failed") & (F.col("p") >= keep_at)).alias("kept"),
        F.col("p").alias("p_good"),
    )


def keep(docs: DataFrame, model: RuleModel | None = None, text: str = "text", keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The texts are judged once: the rows are written with their vote pattern, which
    serves both the fit and the verdicts.
    """
    f = features(F.col(text))
    marked = docs.withColumn(_OWN, let(f, lambda x: F.struct(base_failed(x).alias("failed"), votes(x).alias("pattern"))))
    own = F.col(_OWN)
    if model is None:
        marked = written(marked)
        model = _fitted(marked.select(own["pattern"].alias("pattern")))
    return marked.filter(~own["failed"] & (model.probability(own["pattern"]) >= keep_at)).drop(_OWN)
