"""Learned decision list for text quality (built-in functions only).

``text_statistics`` computes counts over the whole text with built-in
functions. ``learn_rules`` fits a decision list by sequential covering on a
bounded sample of labelled rows: each rule is a conjunction of thresholds, grown
by information gain on two thirds of the sample, pruned on the other third, and
kept only if it is precise there; the rows it covers leave the sample before the
next rule is grown. ``verdict`` turns the list into one ordered
``CASE WHEN ... THEN`` expression.

Defined results: a null text counts as empty (all counts 0, so it fails the base
rule); repeated rows get equal verdicts; an empty documents table gives an empty
result; with no usable labels the list is empty and only the base rule decides;
input columns that share a name with a statistic are untouched, because the
statistics travel in one struct column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import computed, fresh, whole_text, words_of

# The symbols that n_symbols counts.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
# Up to this many repeated windows, membership is tested in the list itself;
# beyond it the windows are sorted. Both give the same positions.
SHORT_LIST = 48



def _count(text: Column, chars: str) -> Column:
    out = F.lit(0)
    for c in chars:
        out = out + F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return out


def text_statistics(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a struct column ``out``: base counts and the features.

    Words are hashed once and three word hashes make a window hash (64 bits).
    Sorting a text's window hashes shows those that repeat; the positions of
    these give the covered words: each adds up to three, less what the position
    before has covered.
    """
    w, ln, h, g, d, r = fresh(df, "_words", "_lines", "_hashes", "_grams", "_dups", "_ranked")
    body = whole_text(text)
    word, line, one, gram, dup, rank = (F.col(c) for c in (w, ln, h, g, d, r))
    n = F.size(word)
    none = F.array().cast("array<bigint>")
    at = F.sequence(F.lit(0), n - 3)
    step = computed(df, w, words_of(body))
    step = computed(step, h, F.transform(word, lambda x: F.xxhash64(x)))
    step = computed(step, g, F.when(n < 3, none).otherwise(F.transform(
        at, lambda i: F.xxhash64(F.get(one, i), F.get(one, i + 1), F.get(one, i + 2)))))
    ordered = fresh(step, "_sorted")[0]
    step = computed(step, ordered, F.sort_array(gram))
    step = computed(step, d, F.array_distinct(F.filter(
        F.col(ordered), lambda x, i: (i > 0) & (x == F.get(F.col(ordered), i - 1)))))
    # Only texts with many repeated windows pay for the sort by (hash, position).
    step = computed(step, r, F.when(F.size(dup) > SHORT_LIST, F.array_sort(F.transform(
        gram, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    step = computed(step, ln, F.filter(F.split(body, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]")))

    def covered(found: Column) -> Column:
        return F.aggregate(
            found, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")),
            lambda a, p: F.struct(p.alias("last"),
                                  (a["total"] + F.least(F.lit(3), p - a["last"])).alias("total")),
            lambda a: a["total"])

    few = F.filter(at, lambda i: F.array_contains(dup, F.get(gram, i)))
    many = F.sort_array(F.transform(
        F.filter(rank, lambda x, i: F.coalesce(x["h"] == F.get(rank, i - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(rank, i + 1)["h"], F.lit(False))),
        lambda x: x["i"]))
    repeat = (F.when(F.size(dup) == 0, F.lit(0))
              .when(F.size(dup) <= SHORT_LIST, covered(few))
              .otherwise(covered(many)))
    step = computed(step, out, F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words"),
        F.size(line).cast("long").alias("n_lines"),
        _count(body, "!?").cast("long").alias("n_shouts"),
        _count(body, ".,").cast("long").alias("n_stops")))
    return step.drop(w, h, g, ordered, d, r, ln)


def features(stats: Column) -> dict[str, Column]:
    """The learner's numeric features of a statistics struct (never null)."""
    words = F.greatest(stats["n_words"], F.lit(1)).cast("double")
    lines = F.greatest(stats["n_lines"], F.lit(1)).cast("double")
    return {
        "n_words": stats["n_words"].cast("double"),
        "mean_word": stats["word_chars"] / words,
        "symbols_per_word": stats["n_symbols"] / words,
        "shout_per_word": stats["n_shouts"] / words,
        "stop_per_word": stats["n_stops"] / words,
        "dup_line_share": stats["n_dup_lines"] / lines,
        "repeat_share": stats["n_repeat_words"] / words,
        "words_per_line": stats["n_words"] / lines,
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > REPEAT_PERCENT * stats["n_words"])


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_at_least, threshold) that rejects a text."""

    conditions: tuple[tuple[str, bool, float], ...]
    precision: float

    def covers(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(rows.values()))), bool)
        for name, at_least, cut in self.conditions:
            hit &= (rows[name] >= cut) if at_least else (rows[name] < cut)
        return hit

    def column(self, cols: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, at_least, cut in self.conditions:
            out = out & ((cols[name] >= F.lit(cut)) if at_least else (cols[name] < F.lit(cut)))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if g else '<'} {c:.6g}" for n, g, c in self.conditions)


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray],
          max_conditions: int) -> list[tuple[str, bool, float]]:
    """Add the threshold of the highest information gain until no good row is covered."""
    live, conditions = np.ones(len(bad), bool), []
    while len(conditions) < max_conditions:
        p0, n0 = int((live & bad).sum()), int((live & ~bad).sum())
        if not p0 or not n0:
            break
        before, best, choice = np.log2(p0 / (p0 + n0)), 1e-9, None
        for name, thresholds in cuts.items():
            x = rows[name]
            for cut in thresholds:
                high = x >= cut
                for at_least, part in ((True, live & high), (False, live & ~high)):
                    p = int((part & bad).sum())
                    if not p:
                        continue
                    gain = p * (np.log2(p / int(part.sum())) - before)
                    if gain > best:
                        best, choice = gain, (name, at_least, float(cut))
        if choice is None:
            break
        conditions.append(choice)
        live &= (rows[choice[0]] >= choice[2]) == choice[1]
    return conditions


def _prune(conditions: list, rows: dict[str, np.ndarray], bad: np.ndarray) -> tuple:
    """The leading conditions that score best on rows the growth has not seen."""
    best, kept = -2.0, tuple(conditions)
    for k in range(1, len(conditions) + 1):
        hit = Rule(tuple(conditions[:k]), 0).covers(rows)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        score = (p - n) / (p + n) if p + n else -1.0
        if score > best + 1e-12:
            best, kept = score, tuple(conditions[:k])
    return kept


def cover(rows: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12,
          max_conditions: int = 4, min_precision: float = 0.9, min_support: int = 3,
          n_cuts: int = 24) -> list[Rule]:
    """Sequential covering on numpy columns: the ordered rejecting rules."""
    rules: list[Rule] = []
    if not len(bad) or not bad.any() or bad.all():
        return rules
    fold = np.arange(len(bad)) % 3 == 2
    live = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow, test = live & ~fold, live & fold
        if not (grow & bad).any():
            break
        part = {k: v[grow] for k, v in rows.items()}
        seen = bad[grow]
        # Thresholds: quantiles of the rejected rows and of the whole part, so a
        # rare fault's own range is always among them.
        grid = np.linspace(0, 1, n_cuts)
        cuts = {k: np.unique(np.concatenate([np.quantile(v, grid), np.quantile(v[seen], grid)]))
                for k, v in part.items()}
        conditions = _grow(part, seen, cuts, max_conditions)
        if not conditions:
            break
        kept = _prune(conditions, {k: v[test] for k, v in rows.items()}, bad[test])
        hit = Rule(kept, 0).covers(rows) & live
        p, n = int((hit & bad).sum()), int(hit.sum())
        unseen = hit & fold
        good = n and p / n >= min_precision and p >= min_support and (
            not unseen.any() or (unseen & bad).sum() / unseen.sum() >= min_precision)
        if not good:
            break
        rules.append(Rule(kept, p / n))
        live &= ~hit
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_fit_rows: int = 4000, **fit) -> list[Rule]:
    """Fit the list on at most ``max_fit_rows`` labelled documents.

    The sample is the labelled ids of the smallest hash, so it is the same in
    every run; the bound is also the size bound of its broadcast. Labels other
    than 0 and 1 and null ids are ignored; of several labels of one document
    the lowest counts, and of several documents of one id the least text hash.
    """
    k, y, s = fresh(docs, "_fit_id", "_fit_label", "_fit_stats")
    sample = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
              .groupBy(F.col(id_col).alias(k)).agg(F.min(label_col).alias(y))
              .orderBy(F.xxhash64(k), k).limit(max_fit_rows))
    # A repeated id must not bring more rows than there are ids.
    fit_docs = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        F.broadcast(sample), F.col("_doc") == F.col(k)).groupBy(k, y).agg(
        F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    stats = text_statistics(fit_docs, "_text", s)
    cols = features(F.col(s))
    rows = stats.select(F.col(k), F.col(y), *[c.alias(n) for n, c in cols.items()],
                        base_failed(F.col(s)).alias("_base")).collect()
    # Texts the base rule rejects are decided already.
    rows = sorted((r[:-1] for r in rows if not r[-1]), key=lambda r: (r[0], tuple(r[2:])))
    if len(rows) == 0:
        return []
    order = np.random.default_rng(7).permutation(len(rows))
    data = np.array([[float(v) for v in r[2:]] for r in rows])[order]
    bad = np.array([r[1] == 0 for r in rows])[order]
    return cover({n: data[:, i] for i, n in enumerate(cols)}, bad, **fit)


def verdict(stats: Column, rules: list[Rule]) -> Column:
    """True where the text is kept: the base rule, then the rules in order."""
    cols = features(stats)
    out = F.when(base_failed(stats), F.lit(False))
    for rule in rules:
        out = out.when(rule.column(cols), F.lit(False))
    return out.otherwise(F.lit(True))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            **fit) -> DataFrame:
    """One row per document: id, the five base counts, base_failed, kept."""
    rules = learn_rules(docs, labels, id_col, text_col, **fit)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    stats = text_statistics(narrow, "text", "s").drop("text")
    s = F.col("s")
    return stats.select("doc_id", s["n_words"].alias("n_words"),
                        s["word_chars"].alias("word_chars"), s["n_symbols"].alias("n_symbols"),
                        s["n_dup_lines"].alias("n_dup_lines"),
                        s["n_repeat_words"].alias("n_repeat_words"),
                        base_failed(s).alias("base_failed"), verdict(s, rules).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **fit) -> DataFrame:
    """The documents the list keeps, with their own columns."""
    rules = learn_rules(docs, labels, id_col, text_col, **fit)
    s = fresh(docs, "_stats")[0]
    return text_statistics(docs, text_col, s).where(verdict(F.col(s), rules)).select(*docs.columns)
