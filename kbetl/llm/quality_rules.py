"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes.

1. Row-local expressions count words, symbols, repeated lines and repeated 8-word windows of each whole text.
2. Each rule votes good, bad or not at all. A document is then one of at most ``3 ** rules`` vote patterns.
3. The number of documents with each pattern (a table bounded by the number of rules, not of documents) is all
   that expectation-maximisation needs: it estimates how often documents are good and how often each rule is
   right on good and on bad ones, without labels.
4. The posterior probability of a document's pattern, not the demand that all rules pass, decides.

DataFrame expressions only. Windows are compared by 64-bit hashes; the work on a text is a sort, never a
comparison of all its windows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, pick, table, written

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
KEEP_AT = 0.5
_BLANKS = " \t\n\x0b\f\r"
_GOOD, _BAD, _NONE = 2, 1, 0


def _votes(good: Column, bad: Column) -> Column:
    return F.when(bad, _BAD).when(good, _GOOD).otherwise(_NONE)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


# Each rule: what it votes good on, and what it votes bad on; bad wins, and neither is no vote.
RULES: dict[str, Callable[[], Column]] = {
    "length": lambda: _votes(F.col("n_words") >= 50, F.col("n_words") < MIN_WORDS),
    "word_length": lambda: _votes(_share("word_chars", "n_words").between(3, 10), ~_share("word_chars", "n_words").between(2.5, 14)),
    "symbols": lambda: _votes(_share("n_symbols", "n_words") < 0.01, _share("n_symbols", "n_words") > 0.1),
    "symbol_runs": lambda: _votes(_share("n_symbol_runs", "n_words") < 0.02, _share("n_symbol_runs", "n_words") > 0.1),
    "letters": lambda: _votes(_share("n_letters", "word_chars") > 0.93, _share("n_letters", "word_chars") < 0.88),
    "lines": lambda: _votes(F.col("n_dup_lines") == 0, _share("n_dup_lines", "n_lines") > 0.3),
    "windows": lambda: _votes(F.col("n_repeat_words") == 0, _share("n_repeat_words", "n_words") > 0.2),
    "capitals": lambda: _votes(_share("n_capitals", "word_chars") < 0.1, _share("n_capitals", "word_chars") > 0.3),
    "ending": lambda: _votes(F.col("ends_sentence"), F.lit(False)),
    # Distinct words grow about with the root of the words, so this holds for texts of any length.
    "variety": lambda: _votes(F.col("n_kinds") > 4 * F.sqrt("n_words"), F.col("n_kinds") < 1.5 * F.sqrt("n_words")),
}


def text_features(docs: DataFrame) -> DataFrame:
    """Counts of each row of ``doc_id, text``. A null text has no words."""
    blank = f"{WHITESPACE}+"
    trimmed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("core", F.btrim("text", F.lit(_BLANKS)))
    words = trimmed.withColumn("words", F.when(F.col("core") == "", F.array().cast("array<string>")).otherwise(F.split("core", blank)))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    window = F.when(
        F.size("words") >= WINDOW_WORDS,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW_WORDS),
            lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW_WORDS))),
        ),
    )
    hashed = words.withColumn("lines", lines).withColumn("hashes", window)
    marked = hashed.withColumn(
        # Hashes with their places in order, only where some window is repeated.
        "sorted",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )

    def at(k: Column) -> Column:
        return F.get("sorted", k)["h"]

    repeated = F.filter(F.transform("sorted", lambda x, k: F.when((at(k - 1) == x["h"]) | (at(k + 1) == x["h"]), x["i"])), lambda i: i.isNotNull())
    marked = marked.withColumn("starts", F.sort_array(repeated))
    # A window covers its words up to the start of the next repeated window.
    covered = F.aggregate(
        F.zip_with("starts", F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return marked.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("sorted").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{L}+", ""))).cast("long").alias("n_letters"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        F.size(F.array_distinct("words")).cast("long").alias("n_kinds"),
        F.coalesce(F.substring("core", -1, 1).isin(*".!?\"'…"), F.lit(False)).alias("ends_sentence"),
    )


@dataclass(frozen=True)
class LabelModel:
    """``good``: share of good documents; ``right``: per rule, P(votes good | good) and P(votes bad | bad) when it votes."""

    good: float
    right: list[tuple[float, float]]

    def posterior(self, votes: list[int]) -> float:
        """The probability of good, given one vote a rule."""
        log_odds = math.log(self.good) - math.log1p(-self.good)
        for vote, (on_good, on_bad) in zip(votes, self.right, strict=True):
            if vote == _GOOD:
                log_odds += math.log(on_good) - math.log(1 - on_bad)
            elif vote == _BAD:
                log_odds += math.log(1 - on_good) - math.log(on_bad)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, log_odds))))

    def posterior_of(self, votes: list[Column]) -> Column:
        """The same as an expression: one term a rule, however many vote patterns there are."""
        log_odds = F.lit(math.log(self.good) - math.log1p(-self.good))
        for vote, (on_good, on_bad) in zip(votes, self.right, strict=False):
            good, bad = math.log(on_good) - math.log(1 - on_bad), math.log(1 - on_good) - math.log(on_bad)
            log_odds = log_odds + F.when(vote == _GOOD, good).when(vote == _BAD, bad).otherwise(0.0)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), log_odds))))


def fit_label_model(patterns: dict[tuple[int, ...], int], rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over vote patterns and their numbers, with one pseudo-vote each way.

    A rule is taken to be right on at least half of the good documents, and a vote of bad to be no likelier on
    good ones than on bad ones; that fixes which class is which.
    Without any vote pattern the model knows nothing: half of the documents are good.
    """
    rules = len(next(iter(patterns), ()))
    model = LabelModel(0.8, [(0.95, 0.3)] * rules)
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        good = 0.0
        seen = [[1.0, 2.0, 1.0, 2.0] for _ in range(rules)]  # right and voted on good, right and voted on bad
        for votes, n in patterns.items():
            p = model.posterior(list(votes))
            good += n * p
            for tally, vote in zip(seen, votes, strict=True):
                if vote != _NONE:
                    tally[0] += n * p * (vote == _GOOD)
                    tally[1] += n * p
                    tally[2] += n * (1 - p) * (vote == _BAD)
                    tally[3] += n * (1 - p)
        right = []
        for t in seen:
            on_good = min(0.999, max(0.5, t[0] / t[1]))
            right.append((on_good, min(0.999, max(1 - on_good, t[2] / t[3]))))
        new = LabelModel(min(0.999, max(0.001, good / total)), right)
        moved = abs(new.good - model.good) + sum(abs(a - c) + abs(b - d) for (a, b), (c, d) in zip(new.right, model.right, strict=True))
        model = new
        if moved < tolerance:
            break
    return model


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: its counts, ``base_failed, posterior, kept`` and its votes by rule.

    * A null or blank text has no words and fails the base rule. Texts are read whole.
    * Repeated rows are counted and returned one by one. An empty table gives no rows.
    * Documents with the same votes have the same posterior; one of exactly ``keep_at`` is kept.
    * Null ids are returned as they are. Further columns are ignored.
    """
    features = text_features(pick(docs, doc_id=id_col, text=text_col))
    votes = {f"vote_{name}": rule().cast("int") for name, rule in RULES.items()}
    voted = written(features.withColumns(votes), "quality-votes")
    code = sum((F.col(v) * 3**i for i, v in enumerate(votes)), F.lit(0))
    numbers = {r.code: r.n for r in voted.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = {tuple(c // 3**i % 3 for i in range(len(votes))): n for c, n in numbers.items()}
    model = fit_label_model(patterns)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("posterior", model.posterior_of([F.col(v) for v in votes]))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at))
    )


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )
