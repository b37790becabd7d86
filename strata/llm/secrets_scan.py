"""Secret scan with corpus-wide ownership frequency.

Base candidates are the three fixed patterns. The method adds generic ones: long
tokens of mixed characters and high entropy outside the base spans. All
candidate values are hashed and aggregated by distinct repositories and owners
over the whole corpus: a value that ``copied_owners`` owners or ``copied_repos``
repositories hold is a copied example, one in fewer of both that looks live
(enough entropy, no placeholder) is owner-specific. A repository is an owner's: the
same name under another owner is another one. Generic candidates become spans only if owner-specific; base
spans always stay, and both counts are reported.

Texts are read once. What is shuffled are hashes and offsets: first made distinct by
(value, owner, repository), so a value that a third of all rows hold is a few
rows, then joined back.

Defined results: a null text is empty; rows are told apart by position, so null
and repeated ids keep a row each; a null owner or repository is one unknown
owner; overlapping spans of different kinds are all kept; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import durable

# The base patterns, their least lengths and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KINDS = ["assign", "access", "hex", "owned"]

GENERIC = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]|(.)\1{5}|123456|abcdef",
                         re.IGNORECASE)
CANDIDATES = "array<struct<kind:int,start:int,end:int,value:bigint,live:boolean>>"


def entropy(value: str) -> float:
    """Shannon entropy of the characters, in bits."""
    from collections import Counter
    from math import log2
    n = len(value)
    return -sum(c / n * log2(c / n) for c in Counter(value).values())


def looks_live(value: str) -> bool:
    return entropy(value) >= 2.8 and not PLACEHOLDER.search(value)


def _mixed(value: str) -> bool:
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit))
    return kinds >= 2 and any(c.isdigit() for c in value) and entropy(value) >= 3.5


# Runs of 16 and more are the same maximal runs that the base pattern finds.
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)


def candidates(text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int, str]]]:
    """(base, generic): lists of (kind, start, end, value)."""
    base = [(0, m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_LENGTH]
    base += [(1, m.start(), m.end(), m.group()) for m in ACCESS.finditer(text)
             if m.end() - m.start() >= ACCESS_LENGTH]
    base += [(2, m.start(), m.end(), m.group()) for m in _LONG_HEX.finditer(text)]
    base.sort(key=lambda s: (s[1], s[0]))
    found, at = [], 0
    for m in GENERIC.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        if any(b[1] < m.end() and m.start() < b[2] for b in base[at:at + 4]):
            continue
        if _mixed(m.group()):
            found.append((3, m.start(), m.end(), m.group()))
    return base, found


def _value(value: str) -> int:
    from xxhash import xxh3_64_intdigest
    h = xxh3_64_intdigest(value)
    return h - (1 << 64) if h >> 63 else h


def _scanner(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from hashlib import sha256
    for part in parts:
        rows = []
        for text in part["text"]:
            base, more = candidates(text)
            told = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in base)
            rows.append((*(sum(s[0] == k for s in base) for k in range(3)),
                         sha256(told.encode()).hexdigest(),
                         [{"kind": k, "start": a, "end": b, "value": _value(v),
                           "live": looks_live(v)} for k, a, b, v in base + more]))
        out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "found"])
        for name in ("owner", "repo", "id"):
            out.insert(0, name, part[name].array)
        yield out


def scan(docs: DataFrame, owner: Column, repo: Column, id_col: str = "doc_id",
         text_col: str = "text", copied_owners: int = 2, copied_repos: int = 3) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans,
    n_owned (owner-specific and live-looking), n_copied (values that at least
    ``copied_owners`` owners or ``copied_repos`` repositories hold), and the most owners
    and repositories that hold one of its values: n_owners, n_repos (0 without a value)."""
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(repo, F.lit("")).alias("repo"),
                         F.coalesce(owner, F.lit("")).alias("owner"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    rows = durable(narrow.mapInPandas(
        _scanner, f"id {kind}, repo string, owner string, n_assign long, n_access long, "
        f"n_hex long, base_sha256 string, found {CANDIDATES}").withColumn(
        "row", F.monotonically_increasing_id()))
    one = rows.select("row", "owner", "repo", F.explode("found").alias("c")).select(
        "row", "owner", "repo", "c.*")
    held = one.groupBy("value", "owner").agg(F.count_distinct("repo").alias("n"))
    spread = held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repos"))
    copied = (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos)
    judged = one.join(spread, "value").withColumn("copied", copied).withColumn(
        "owned", ~copied & F.col("live"))
    shown = (F.col("kind") < 3) | F.col("owned")
    kinds = F.array(*map(F.lit, KINDS))
    told = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(shown, F.struct("start", "kind", "end")))).alias("s"),
        F.count_if("owned").alias("n_owned"), F.count_if("copied").alias("n_copied"),
        F.max("owners").alias("n_owners"), F.max("repos").alias("n_repos"))
    spans = F.array_join(F.transform("s", lambda x: F.concat_ws(
        ":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")
    return rows.drop("found", "repo", "owner").join(told, "row", "left").select(
        "id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(spans, F.lit("")).alias("spans"),
        F.coalesce("n_owned", F.lit(0)).alias("n_owned"),
        *(F.coalesce(n, F.lit(0)).alias(n) for n in ("n_copied", "n_owners", "n_repos")))
