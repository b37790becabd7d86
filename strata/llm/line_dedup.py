"""Near-duplicate line removal by an exact set-similarity join (built-ins only).

A line is the set of its words. A line goes when an earlier line (by document
id, text hash and line number) has a word set of Jaccard similarity at or above
the threshold; equal sets are the case of similarity 1.

1. *Rarity*: words are counted in a fixed number of hash buckets, a table of
   bounded size, and each line's distinct words are ordered rarest bucket first.
2. *Copies*: lines of equal sets collapse to their first line by a partial
   aggregate, so a line that a third of the corpus repeats joins as one row.
3. *Leaders*: lines that agree in the smallest or the largest word hash of their
   rarer half are compared with the first such line only. In a large group of
   near copies this settles nearly every line with one comparison.
4. *Candidates*: two similar sets must share a word among their rarest
   ``n - ceil(t n) + 1`` words. The equi-join on those words filters each pair
   by length, by the position of the shared word and by a 128-bit parity map
   of the sets, whose differing bits bound the symmetric difference from below.
   Pairs of two settled lines are left out: both are known to go, and a line
   that goes still counts as an earlier line for those that are not settled.
5. *Verification*: the words of candidate lines are fetched from their documents
   and the Jaccard similarity is taken in whole numbers.

The steps lose no similar earlier line. Sets of fewer words than
``1 / (1 - t) - 1`` can only match equal sets and skip the join. Words compare
by 64-bit hashes.

Defined results: a null text is empty; lines without a word are never removed;
identical rows (same id and text) are one document and get equal results, rows
with one id and different texts are different documents; a null id comes first;
an empty table gives an empty result; other columns, whatever their names, pass
through.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import computed, fresh, whole_text, words_of, written

BUCKETS = 1 << 16


def line_words(line: Column) -> Column:
    """``words_of``; a split at plain spaces is several times faster."""
    other = F.lit(False)
    for c in "\t\x0b\x0c\r\n":
        other = other | line.contains(c)
    return F.when(other, words_of(line)).otherwise(F.array_remove(F.split(line, " ", -1), ""))


def rarity_levels(docs: DataFrame, text: str) -> list[int]:
    """For each of ``BUCKETS`` word buckets, twice the log2 of its word count.
    Only these ``BUCKETS`` numbers reach the driver, whatever the corpus. Any
    order serves the join, so pieces between spaces are near enough to words."""
    flat = F.replace(whole_text(text), F.lit("\n"), F.lit(" "))
    word = docs.select(F.explode(F.split(flat, " ", -1)).alias("w"))
    counts = word.groupBy(
        F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).count().collect()
    levels = [0] * BUCKETS
    for b, n in counts:
        levels[b] = min(127, (n * n).bit_length())
    return levels


def ordered_tokens(words: Column, levels: list[int]) -> Column:
    """Distinct words as sorted longs: 7 bits of rarity, then 56 of the hash."""
    # One string literal, which the optimizer folds into an array.
    level = F.split(F.lit(",".join(str(v << 56) for v in levels)), ",").cast("array<bigint>")

    def key(x: Column) -> Column:
        return F.coalesce(F.get(level, x.bitwiseAND(F.lit(BUCKETS - 1))).bitwiseOR(
            F.shiftrightunsigned(x, 8)), F.lit(0))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.sort_array(F.transform(F.array_distinct(hashes), key))


def prefix_length(n: Column, t: Fraction) -> Column:
    """n - ceil(t n) + 1 in whole numbers."""
    num, den = t.numerator, t.denominator
    return (n - F.floor((n * num + (den - 1)) / den) + 1).cast("int")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _parity(toks: Column, half: int) -> Column:
    """64 of 128 parities: every word flips one bit of one half. A shift takes
    the lowest six bits of its distance."""
    def bit(x: Column) -> Column:
        own = x.bitwiseAND(F.lit(1))
        return F.call_function("shiftleft", own if half else own.bitwiseXOR(F.lit(1)), F.hash(x))

    return F.aggregate(toks, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(bit(x)))


def representatives(docs: DataFrame, levels: list[int], t: Fraction) -> DataFrame:
    """One row per distinct word set: its hash, size, first line, parity map, the
    extreme hashes of its rarer half and the hashed rare words of its prefix.
    ``docs`` has columns id, key, text."""
    lines = docs.select("id", "key", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    toks = computed(lines, "toks", ordered_tokens(line_words(F.col("line")), levels))
    n = F.size("toks")
    toks = computed(toks, "rare", F.transform(
        F.slice("toks", F.lit(1), F.ceil(n / 2).cast("int")),
        lambda x: x.bitwiseAND(F.lit((1 << 56) - 1))))
    narrow = toks.where(n > 0).select(
        "id", "key", "pos", n.alias("n"), F.xxhash64("toks").alias("sig"),
        _parity(F.col("toks"), 0).alias("m0"), _parity(F.col("toks"), 1).alias("m1"),
        F.array_min("rare").alias("lo"), F.array_max("rare").alias("hi"),
        F.transform(F.slice("toks", F.lit(1), prefix_length(n, t)),
                    lambda x: F.hash(x)).alias("prefix"))
    first = F.min(F.struct("id", "key", "pos", "m0", "m1", "lo", "hi", "prefix")).alias("f")
    return narrow.groupBy("sig", "n").agg(first).select("sig", "n", "f.*")


def _may_match(a: str, b: str, t: Fraction) -> Column:
    """Length filter and parity bound of two sets with columns n, m0, m1."""
    num, den = t.numerator, t.denominator
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = (F.bit_count(F.col(f"{a}.m0").bitwiseXOR(F.col(f"{b}.m0")))
              + F.bit_count(F.col(f"{a}.m1").bitwiseXOR(F.col(f"{b}.m1"))))
    return ((F.least(na, nb) * den >= F.greatest(na, nb) * num)
            & (differ * (num + den) <= (na + nb) * (den - num)))


def shortest(t: Fraction) -> int:
    """The least size of a set that a different set can match."""
    return ceil(1 / (1 - t)) - 1 if t < 1 else 1 << 30


def leader_pairs(reps: DataFrame, t: Fraction) -> DataFrame:
    """(sa, sb): each set with the first set that shares an extreme hash."""
    keyed = reps.where(F.col("n") >= shortest(t)).select(
        F.explode(F.array("lo", "hi")).alias("k"),
        F.struct("id", "key", "pos").alias("at"), "sig", "n", "m0", "m1")
    lead = keyed.groupBy("k").agg(F.min(F.struct("at", "sig", "n", "m0", "m1")).alias("f"),
                                  F.count("*").alias("c")).where("c > 1").select("k", "f.*")
    a, b = lead.alias("a"), keyed.alias("b")
    return a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.sig") != F.col("b.sig"))
                  & _may_match("a", "b", t)).select(
        F.col("a.sig").alias("sa"), F.col("b.sig").alias("sb")).distinct()


def candidate_pairs(reps: DataFrame, t: Fraction) -> DataFrame:
    """Distinct (sa, sb) set hashes that pass the prefix, length, position and
    parity filters and are not both ``settled``."""
    num, den = t.numerator, t.denominator
    posting = reps.where(F.col("n") >= shortest(t)).select(
        "sig", "n", "settled", "m0", "m1", F.posexplode("prefix").alias("i", "tok"))
    a, b = posting.alias("a"), posting.alias("b")
    na, nb = F.col("a.n"), F.col("b.n")
    rest = F.least(na - F.col("a.i"), nb - F.col("b.i"))
    return a.join(b, (F.col("a.tok") == F.col("b.tok")) & (F.col("a.sig") < F.col("b.sig"))
                  & ~(F.col("a.settled") & F.col("b.settled")) & _may_match("a", "b", t)
                  & (rest * (num + den) >= (na + nb) * num)).select(
        F.col("a.sig").alias("sa"), F.col("b.sig").alias("sb")).distinct()


def later_sets(docs: DataFrame, reps: DataFrame, pairs: DataFrame, t: Fraction) -> DataFrame:
    """Hashes of the sets that are similar to a set that occurs earlier."""
    num, den = t.numerator, t.denominator
    wanted = pairs.select(F.explode(F.array("sa", "sb")).alias("sig")).distinct()
    place = reps.select("sig", "id", "key", "pos").join(wanted, "sig").groupBy("id", "key").agg(
        F.collect_list(F.struct("pos", "sig")).alias("at"))
    d, p = docs.alias("d"), place.alias("p")
    found = d.join(p, F.col("d.id").eqNullSafe(F.col("p.id"))
                   & (F.col("d.key") == F.col("p.key"))).select(
        F.col("d.id").alias("id"), F.col("d.key").alias("key"),
        _lines(F.col("text")).alias("lines"), "at")
    one = found.select("id", "key", F.explode(F.transform("at", lambda x: F.struct(
        x["sig"].alias("sig"), x["pos"].alias("pos"),
        F.get(F.col("lines"), x["pos"]).alias("line")))).alias("x"))
    sets = one.select(F.col("x.sig").alias("sig"), F.struct("id", "key", "x.pos").alias("first"),
                      F.array_distinct(F.transform(line_words(F.col("x.line")), lambda w: F.xxhash64(w)))
                      .alias("words")).dropDuplicates(["sig"])
    left = sets.select(F.col("sig").alias("sa"), F.col("first").alias("fa"),
                       F.col("words").alias("wa"))
    right = sets.select(F.col("sig").alias("sb"), F.col("first").alias("fb"),
                        F.col("words").alias("wb"))
    both = F.size("wa") + F.size("wb")
    same = F.size(F.array_intersect("wa", "wb"))
    return (pairs.join(left, "sa").join(right, "sb").where(same * (num + den) >= both * num)
            .select(F.when(F.col("fa") < F.col("fb"), F.col("sb")).otherwise(F.col("sa"))
                    .alias("sig")).distinct())


def kept_lines(docs: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> DataFrame:
    """(id, key, kept): per document the numbers of the lines that stay. Documents
    without a kept line are absent. ``key`` is the hash of the text."""
    t = Fraction(threshold).limit_denominator(1000)
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("key"),
                         whole_text(text_col).alias("text"))
    reps = written(representatives(narrow, rarity_levels(docs, text_col), t), "line-sets")
    led = written(leader_pairs(reps, t), "line-leaders")
    settled = written(later_sets(narrow, reps, led, t), "line-settled")
    flagged = reps.join(settled.withColumn("s", F.lit(True)), "sig", "left").withColumn(
        "settled", F.coalesce("s", F.lit(False)))
    pairs = written(candidate_pairs(flagged, t), "line-pairs")
    later = written(settled.union(later_sets(narrow, reps, pairs, t)).distinct(), "line-later")
    return reps.join(later, "sig", "left_anti").groupBy("id", "key").agg(
        F.collect_list("pos").alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = 0.8, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the later similar lines taken out of the text; with
    ``counts``, also the numbers of lines with a word and of lines removed."""
    kept = kept_lines(docs, id_col, text_col, threshold)
    i, k, v, ln = fresh(docs, "_kept_id", "_kept_key", "_kept", "_lines")
    kept = kept.select(F.col("id").alias(i), F.col("key").alias(k), F.col("kept").alias(v))
    body = whole_text(text_col)
    joined = docs.join(kept, F.col(id_col).eqNullSafe(F.col(i))
                       & (F.xxhash64(body) == F.col(k)), "left")
    joined = computed(joined, ln, _lines(body))
    lines = F.col(ln)
    blank = F.filter(F.sequence(F.lit(0), F.size(lines) - 1),
                     lambda x: ~F.get(lines, x).rlike("[^ \\t-\\r]"))
    stay = F.coalesce(F.col(v), F.array().cast("array<int>"))
    clean = F.array_join(F.transform(F.sort_array(F.array_union(stay, blank)),
                                     lambda x: F.get(lines, x)), "\n")
    out = {text_col: clean}
    if counts:
        total = F.size(lines) - F.size(blank)
        out |= {counts[0]: total, counts[1]: total - F.size(stay)}
    return joined.select(*[F.col(c) for c in docs.columns if c not in out],
                         *[e.alias(c) for c, e in out.items()]).select(
        *docs.columns, *(counts or ()))
