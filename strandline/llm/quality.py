"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Very frequent words of the four languages; fixed values.
STOP_WORDS = {
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "be", "by", "this", "are", "at", "from", "a"),
    "fr": ("le", "la", "les", "des", "et", "en", "du", "de", "un", "une", "est", "que", "qui", "dans", "pour", "par", "au", "sur", "avec", "elle"),
    "de": ("der", "die", "das", "und", "von", "ist", "nicht", "ein", "eine", "mit", "sich", "auf", "für", "den", "dem", "des", "zu", "es", "er", "im"),
    "es": ("el", "la", "los", "las", "que", "de", "en", "y", "un", "una", "por", "con", "para", "del", "su", "se", "no", "es", "al", "lo"),
}
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Votes -1 where `bad` holds, else 1 where `good` holds, else 0 (abstains)."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(F.coalesce(self.bad, F.lit(False)), -1).when(F.coalesce(self.good, F.lit(False)), 1).otherwise(0).cast("tinyint").alias(f"vote_{self.name}")


def word_statistics(rows: DataFrame) -> DataFrame:
    """Add counts to rows with a column `text` (not null); each step is a projection of its own, so that arrays that
    later lambdas refer to are made once."""
    flat = F.col("text")
    for c in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    rows = rows.withColumn("flat", flat)
    rows = rows.withColumn("words", F.array_remove(F.split("flat", " "), ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")
    length = F.length("text")
    count = lambda pattern: (length - F.length(F.regexp_replace("text", pattern, ""))).cast("long")
    stops = sorted({w for words in STOP_WORDS.values() for w in words})
    rows = rows.select(
        "row",
        n.cast("long").alias("n_words"),
        F.length(F.replace("flat", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]+").alias("n_symbols"),
        (length - F.length(F.replace("text", F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.!?:;\"')…。][\x20\x09-\x0D]*$"))).cast("long").alias("n_ended_lines"),
        F.size(F.filter("words", lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
        F.size(F.filter("hashes", lambda h, i: h == F.get(F.col("hashes"), i - 1))).cast("long").alias("n_stutters"),
        count(r"\p{Lu}+").alias("n_upper"),
        F.length(F.regexp_replace("text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.col("hashes").alias("windows"),
    )
    # a hash of each word and the next, then of each two and the next two, then of eight; the last seven lack words
    for width in (1, 2, 4):
        rows = rows.withColumn("windows", F.zip_with("windows", F.slice("windows", width + 1, F.size("windows")), lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn("windows", F.slice("windows", 1, F.greatest(F.size("windows") - (WINDOW - 1), F.lit(0))))
    # windows in the order of their hashes; those next to an equal one are repeated
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("windows", F.when(repeats, F.sort_array(pairs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    equal = F.filter("windows", lambda x, k: (x.h == F.get(F.col("windows"), k - 1).h) | (x.h == F.get(F.col("windows"), k + 1).h))
    rows = rows.withColumn("windows", F.sort_array(F.transform(equal, lambda x: x.i)))
    covered = F.transform("windows", lambda p, k: F.least(F.lit(WINDOW), F.get(F.col("windows"), k + 1) - p))
    return rows.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long")).drop("windows")


def default_rules() -> list[Rule]:
    """Rules for five kinds of fault. The label model takes rules to err independently, so tests that see the same kind
    of fault make one rule: it votes bad if any of them does."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    some = F.col("n_words") >= 20
    share = lambda name: F.col(name) / n
    upper = F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1))
    mean = F.col("word_chars") / n
    stops = share("n_stop_words")
    ended = F.col("n_ended_lines") / lines
    repeated_lines = F.col("n_dup_lines") / lines
    return [
        Rule(
            "typography",
            (share("n_symbols") <= 0.03) | (share("n_exclamations") <= 0.1) | (upper <= 0.2),
            (share("n_symbols") > 0.1) | (share("n_exclamations") > 0.25) | (upper > 0.4),
        ),
        Rule("word_length", (mean >= 2.5) & (mean <= 9.5), (mean < 2) | (mean > 13)),
        Rule("stop_words", some & (stops >= 0.06), some & (stops < 0.03)),
        Rule("ended_lines", ended >= 0.6, ended < 0.3),
        Rule(
            "repetition",
            (repeated_lines <= 0.1) | (share("n_repeat_words") <= 0.1) | (share("n_stutters") <= 0.05),
            (repeated_lines > 0.3) | (share("n_repeat_words") > 0.25) | (share("n_stutters") > 0.2),
        ),
    ]


@dataclass
class LabelModel:
    """Share of good documents, and for each rule the chance that its vote is right on a good and on a bad document."""

    prior: float
    on_good: list[float]
    on_bad: list[float]

    def log_odds(self, votes: Sequence[int]) -> float:
        total = math.log(self.prior / (1 - self.prior))
        for v, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            total += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0.0
        return total

    def log_odds_column(self, names: Sequence[str]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, g, b in zip(names, self.on_good, self.on_bad, strict=True):
            total = total + F.when(F.col(name) > 0, math.log(g / (1 - b))).when(F.col(name) < 0, math.log((1 - g) / b)).otherwise(0.0)
        return total


def fit(patterns: Iterable[tuple[Sequence[int], float]], n_rules: int, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over patterns of votes and how many documents have each. Starts with rules that seldom
    err on good documents and find some of the bad ones; each estimate has two imagined votes of that kind, so none is
    0 or 1. Without documents the start is returned."""
    patterns = [(tuple(v), float(c)) for v, c in patterns]
    model = LabelModel(0.8, [0.95] * n_rules, [0.5] * n_rules)
    for _ in range(rounds):
        good = total = 0.0
        right_good, voted_good, right_bad, voted_bad = ([0.0] * n_rules for _ in range(4))
        for votes, count in patterns:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(votes)))))
            good, total = good + p * count, total + count
            for j, v in enumerate(votes):
                if v:
                    voted_good[j] += p * count
                    voted_bad[j] += (1 - p) * count
                    right_good[j] += p * count * (v > 0)
                    right_bad[j] += (1 - p) * count * (v < 0)
        new = LabelModel(
            (good + 1.6) / (total + 2),
            [(r + 1.9) / (v + 2) for r, v in zip(right_good, voted_good, strict=True)],
            [(r + 1.0) / (v + 2) for r, v in zip(right_bad, voted_bad, strict=True)],
        )
        moved = max(abs(a - b) for a, b in zip([new.prior, *new.on_good, *new.on_bad], [model.prior, *model.on_good, *model.on_bad], strict=True))
        model = new
        if moved < 1e-9:
            break
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), rules: Sequence[Rule] | None = None, threshold: float = 0.5) -> tuple[DataFrame, LabelModel]:
    """Statistics, votes and verdict of every whole text, and the model that was fitted to all that the base rules keep.

    The rows have `row` (a struct of the id and the carried columns, under their own names), the counts of
    word_statistics, base_failed, one vote_* per rule, quality_probability, and kept: the posterior probability of a good
    document is at least `threshold` and the base rules hold. The base rules: at least 20 words, and at most 30 % of the
    words in repeated windows of 8.

    The model weighs the documents whose verdict it gives, all of them: those that the base rules keep. The statistics are
    written once to the shared folder; what comes to the driver is the number of documents for each
    pattern of votes, at most 3**rules rows. A null or empty text has no words, so base_failed is true and kept false.
    Rows are independent, so null and repeated ids are carried as they are. An empty table gives no rows. The rule of stop
    words knows four languages; a long text in another one gets a bad vote from it, and from it alone.
    """
    rules = default_rules() if rules is None else list(rules)
    held = F.struct(*[docs[c].alias(c) for c in dict.fromkeys([id_col, *carry])])
    rows = word_statistics(docs.select(held.alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = materialise(rows.select("*", failed.alias("base_failed"), *[r.vote() for r in rules]), "quality")
    names = [f"vote_{r.name}" for r in rules]
    counted = rows.filter("not base_failed").groupBy(*names).count().collect()
    # patterns in order, so that sums and thus the model don't depend on the order of arrival
    model = fit(sorted((tuple(r[:-1]), r["count"]) for r in counted), len(rules))
    odds = model.log_odds_column(names)
    probability = 1 / (1 + F.exp(-odds))
    return rows.withColumn("quality_probability", probability).withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= threshold)), model
