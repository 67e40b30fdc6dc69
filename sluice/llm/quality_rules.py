"""Quality rules as weak supervision: rules vote or abstain, and a label model weighs the votes.

Only Spark expressions touch the rows. Rules read columns that statistics() derives from the text; each gives 1 (good),
-1 (bad) or 0 (abstains). The label model is a two-class naive Bayes mixture over the votes, fitted by
expectation-maximisation on the table of vote patterns: at most 3**rules rows, whatever the number of documents, so the
patterns and their counts may go to the driver. The posterior probability of "good" decides.

Defined cases: null and empty texts have no words and every statistic zero; repeated rows count as often as they occur;
an empty table gives an empty result; extra columns of the input pass through keep() unread, whatever their names. score() adds
columns beside those of the input and refuses names that it would add.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored, words

SYMBOLS = r"[^#*$%&|<>]"

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "for", "with", "as", "was", "by", "on", "are", "be", "this", "le", "la", "les", "de", "des", "et", "un", "une", "en", "que", "qui", "dans", "pour", "sur", "par", "pas", "der", "die", "das", "und", "zu", "den", "ein", "eine", "mit", "nicht", "von", "auf", "für", "el", "los", "las", "del", "y", "es", "se", "no", "por", "con", "para", "al", "su")


@dataclass(frozen=True)
class Rule:
    """Votes 1 where good holds, else -1 where bad holds, else 0. Both are SQL over the statistics."""

    name: str
    good: str
    bad: str


#: Only what speaks for prose votes good; the absence of a fault is no vote.
RULES = (
    Rule("length", "false", "_n_words < 12"),
    Rule("word_length", "false", "_word_chars < 2.2 * _n_words or _word_chars > 14 * _n_words"),
    Rule("symbols", "_n_symbols * 20 <= _n_words", "_n_symbols * 4 > _n_words"),
    Rule("repeated_lines", "false", "_n_dup_lines * 5 > 2 * _n_lines"),
    Rule("repeated_windows", "false", "_n_repeat_words * 4 > _n_words"),
    Rule("stop_words", "_n_stop_words * 20 >= _n_words and _n_words > 0", "_n_words >= 20 and _n_stop_words * 50 < _n_words"),
    Rule("line_ends", "_n_ended_lines * 2 > _n_lines", "_n_lines > 3 and _n_ended_lines * 10 < _n_lines"),
    Rule("distinct_words", "false", "_n_words >= 20 and _n_distinct_words * 12 < _n_words"),
)


def statistics(df: DataFrame, text_col: str = "text", window: int = 8) -> DataFrame:
    """df with _n_words, _word_chars, _n_symbols, _n_lines (lines with a word), _n_dup_lines, _n_repeat_words,
    _n_stop_words, _n_ended_lines and _n_distinct_words, all long.

    Each row is handled within itself, without a shuffle: a window is known by the 64-bit hash of its words, windows are
    sorted by hash, and those that equal a neighbour mark the words that they cover.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, h, s, p = (F.col(x) for x in ("_w", "_h", "_s", "_p"))
    of_words = F.transform(w, lambda x: F.xxhash64(x))
    windows = F.when(F.size(w) >= window, F.transform(F.slice(h, 1, F.size(h) - (window - 1)), lambda _, i: F.xxhash64(*(F.get(h, i + k) for k in range(window)))))
    by_hash = F.when(F.size(F.array_distinct(p)) < F.size(p), F.sort_array(F.transform(p, lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
    same = lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"]) | x["h"].eqNullSafe(F.get(s, i + 1)["h"])
    starts = F.sort_array(F.transform(F.filter(s, same), lambda x: x["p"]))
    q = F.col("_q")
    covered = F.aggregate(
        F.transform(q, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(q, i + 1) - x, F.lit(window)))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = df.withColumn("_w", words(F.col(text_col))).withColumn("_l", lines)
    for name, c in (("_h", of_words), ("_p", windows), ("_s", by_hash), ("_q", starts)):
        out = out.withColumn(name, c)
    return out.withColumns({
        "_n_words": F.size(w).cast("long"),
        "_word_chars": F.length(F.array_join(w, "")).cast("long"),
        "_n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "_n_lines": F.size("_l").cast("long"),
        "_n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long"),
        "_n_ended_lines": F.size(F.filter("_l", lambda x: x.rlike(r"[.!?:;。]['\")\]]*[\x20\x09-\x0D]*$"))).cast("long"),
        "_n_distinct_words": F.size(F.array_distinct(w)).cast("long"),
    }).drop("_w", "_l", "_h", "_p", "_s", "_q")


@dataclass
class LabelModel:
    """P(good), and for each rule the probability of its voting good if it votes, for bad and for good documents."""

    prior: float
    says_good: list[tuple[float, float]] = field(default_factory=list)
    rounds: int = 0

    def log_odds(self, rule: int, vote: int) -> float:
        """What a vote adds to the log odds of "good". Whether a rule abstains says nothing."""
        bad, good = self.says_good[rule]
        return math.log(good / bad) if vote == 1 else math.log((1 - good) / (1 - bad)) if vote == -1 else 0.0

    def posterior(self, cols: list[Column]) -> Column:
        """The probability of "good", as an expression over the vote columns."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for k, col in enumerate(cols):
            odds = odds + F.when(col == 1, F.lit(self.log_odds(k, 1))).when(col == -1, F.lit(self.log_odds(k, -1))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 50, accuracy: float = 0.85, prior: float = 0.7, strength: float = 0.05) -> LabelModel:
    """EM over (votes, count) pairs. It starts from rules that are right with the given accuracy, which fixes which class
    is "good"; that start also counts as strength * documents more votes in each class (a Beta prior), so that no small
    cluster of odd votes takes the place of the bad class. Where EM would turn a rule round, the rule says nothing."""
    model = LabelModel(prior, [(1 - accuracy, accuracy)] * n_rules)
    patterns = sorted(patterns)
    total = sum(n for _, n in patterns)
    weight = strength * total
    for model.rounds in range(1, rounds + 1) if total else ():
        good = 0.0
        yes, seen = [[weight * (1 - accuracy), weight * accuracy] for _ in range(n_rules)], [[weight, weight] for _ in range(n_rules)]
        for votes, n in patterns:
            odds = math.log(model.prior / (1 - model.prior)) + sum(model.log_odds(k, v) for k, v in enumerate(votes))
            q = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good += n * q
            for k, v in enumerate(votes):
                for c, share in ((0, 1 - q), (1, q)) if v else ():
                    seen[k][c] += n * share
                    yes[k][c] += n * share * (v == 1)
        model.says_good = [tuple(a / b for a, b in zip(y, s, strict=True)) for y, s in zip(yes, seen, strict=True)]
        model.says_good = [p if p[0] < p[1] else (0.5, 0.5) for p in model.says_good]
        moved = abs(good / total - model.prior)
        model.prior = min(0.999, max(0.001, good / total))
        if moved < 1e-9:
            break
    return model


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.good), 1).when(F.expr(rule.bad), -1).otherwise(0)


def score(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, rounds: int = 50, keep_cols: list[str] | None = None) -> DataFrame:
    """df with its statistics, a column _vote_<rule> for each rule and p_good, the posterior probability.

    The statistics are computed once and stored with df's own columns in the shared folder, only
    those in keep_cols if given; nothing is shuffled but pattern counts."""
    names = [f"_vote_{r.name}" for r in rules]
    keep_cols = df.columns if keep_cols is None else keep_cols
    own = df.select(F.struct(*(F.col(f"`{c}`") for c in keep_cols)).alias("_own"), F.col(f"`{text_col}`").alias("_text"))
    stats = statistics(own, "_text").drop("_text")
    if twice := {c.lower() for c in keep_cols} & {"p_good", *names, *(c for c in stats.columns if c != "_own")}:
        raise ValueError(f"columns that score() would add are there already: {sorted(twice)}")
    voted, p_good = _posterior(stats, rules, rounds)
    return voted.withColumn("p_good", p_good).select("_own.*", *(c for c in voted.columns if c != "_own"), "p_good")


def _posterior(stats: DataFrame, rules: tuple[Rule, ...], rounds: int) -> tuple[DataFrame, Column]:
    """stats with votes, stored, and the posterior over these."""
    names = [f"_vote_{r.name}" for r in rules]
    voted = stored(stats.withColumns({n: vote(r) for n, r in zip(names, rules, strict=True)}), "votes")
    found = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # 3**rules rows at most
    model = fit_label_model([(tuple(r[n] for n in names), r["n"]) for r in found], len(rules), rounds)
    return voted, model.posterior([F.col(n) for n in names])


def base_failed() -> Column:
    return (F.col("_n_words") < 20) | (100 * F.col("_n_repeat_words") > 30 * F.col("_n_words"))


def keep(df: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of df that pass the base limits and whose posterior is at least least; the columns stay as they are."""
    own = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_own"), F.col(f"`{text_col}`").alias("_text"))
    voted, p_good = _posterior(statistics(own, "_text").drop("_text"), RULES, 50)
    return voted.where(~base_failed() & (p_good >= least)).select("_own.*")
