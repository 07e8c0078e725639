"""Quality rules by document, and verdicts on hosts from the rules their documents break.

The rate at which a host's documents break a rule is shrunk towards the rate of all hosts by a beta
prior fitted to them, so a host with few documents is not judged by chance. Where the shrunk rate is
too high the host breaks the rule, and its documents that break it too are rejected. A document that
breaks no rule is never rejected for its host.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequality.llm import words
from lakequality.llm.tables import add_columns, col, store

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.array([chr(b) in "#*$%&|<>" for b in range(256)])

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Rules by document that feed the verdicts on hosts: true where a document breaks them.
RULES: dict[str, str] = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "repeated_lines": "10 * n_dup_lines > n_words",
    "symbols": "n_symbols > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The features of one whole text, in the order of `FEATURES`."""
    data = words.as_bytes(text)
    starts, ends = words.spans(data, words.SOLID)
    n = len(starts)
    if not n:
        return 0, 0, 0, 0, 0
    inside = words.SOLID[data] & ((data & 0xC0) != 0x80)
    # A line with a word, equal to an earlier one.
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(b" \t\n\r\x0b\x0c"):
            seen.add(line)
    grams = words.windows(words.hashes(data, starts, ends), 3)
    in_repeats = 0
    if len(grams) > 1:
        again = np.flatnonzero(words.repeated(grams))
        covered = np.zeros(n, dtype=bool)
        for k in range(3):
            covered[again + k] = True
        in_repeats = int(covered.sum())
    return n, int(inside.sum()), int(_SYMBOL[data].sum()), repeated, in_repeats


def add_features(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The documents with their features; input columns of the same names are replaced."""

    def compute(texts):
        rows = [measure(t) for t in words.texts(texts)]
        return list(zip(*rows, strict=True)) if rows else [[] for _ in FEATURES]

    return add_columns(docs, ", ".join(f"{f} long" for f in FEATURES), [text_col], compute, keep)


def host_verdicts(
    measured: DataFrame, host: Column, rules: Mapping[str, str] = RULES, max_rate: float = 0.5
) -> DataFrame:
    """One row for each host: documents, shrunk rate by rule, and the rules it breaks.

    The prior of a rule is the beta distribution with the mean and the variance of the hosts' rates,
    each host counting once; where the rates vary no more than chance it is strong, and bounded by
    the 10000 documents it counts as at most. Null hosts are one host.
    """
    failing = {name: F.coalesce(F.expr(f"({rule})"), F.lit(False)) for name, rule in rules.items()}
    hosts = measured.groupBy(host.alias("host")).agg(
        F.count("*").alias("n_docs"), *(F.count_if(broken).alias(f"f_{name}") for name, broken in failing.items())
    )
    hosts = store(hosts, "hosts")
    rates = {name: F.col(f"f_{name}") / F.col("n_docs") for name in rules}
    prior = hosts.agg(
        *(F.avg(rate).alias(f"m_{name}") for name, rate in rates.items()),
        *(F.coalesce(F.var_pop(rate), F.lit(0.0)).alias(f"v_{name}") for name, rate in rates.items()),
    ).first()
    columns, broken = [], []
    for name in rules:
        mean, variance = prior[f"m_{name}"] or 0.0, prior[f"v_{name}"] or 0.0
        strength = min(10000.0, max(1.0, mean * (1 - mean) / variance - 1)) if variance > 0 else 10000.0
        shrunk = (F.col(f"f_{name}") + mean * strength) / (F.col("n_docs") + strength)
        columns.append(shrunk.alias(f"rate_{name}"))
        broken.append(F.when(shrunk > max_rate, F.lit(name)))
    return hosts.select("host", "n_docs", *columns, F.array_compact(F.array(*broken)).alias("broken"))


def judge(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    rules: Mapping[str, str] = RULES,
    base_failed: str = BASE_FAILED,
    max_rate: float = 0.5,
    keep: list[str] | None = None,
) -> DataFrame:
    """The documents with their features, `base_failed`, `host_broken` and `kept`.

    `host_broken` lists the rules that both the document and its host break; `kept` is false where
    the base rule fails or that list is not empty. Input columns of the new names are replaced.

    Null and blank texts have no words and fail the base rule; null hosts are one host; repeated
    rows count as often as they come; an empty table gives no rows. The features are computed in one
    pass and stored, hosts are counted map-side, and only hosts that break a rule are joined back.
    """
    passed = [c for c in (docs.columns if keep is None else keep)]
    passed = [c for c in passed if c.lower() not in {"base_failed", "host_broken", "kept", "__host"}]
    named = docs.withColumn("__host", col(host_col).cast("string"))
    measured = store(add_features(named, text_col, [*passed, "__host"]), "features")
    verdicts = host_verdicts(measured, F.col("__host"), rules, max_rate)
    bad = store(verdicts.filter(F.size("broken") > 0).select(F.col("host").alias("__bad"), "broken"), "bad-hosts")
    joined = measured.join(bad, F.col("__host").eqNullSafe(F.col("__bad")), "left")
    own = F.array_compact(
        F.array(*(F.when(F.expr(f"({rule})"), F.lit(name)) for name, rule in rules.items()))
    )
    both = F.coalesce(F.array_intersect(own, F.col("broken")), F.array().cast("array<string>"))
    judged = joined.withColumn("host_broken", both).withColumn("base_failed", F.expr(f"({base_failed})"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("host_broken") == 0)).drop(
        "__host", "__bad", "broken"
    )


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with the columns they have."""
    new = {*FEATURES, "base_failed", "host_broken", "kept"}
    clash = {c: f"__own_{c}" for c in docs.columns if c.lower() in new}
    judged = judge(docs.withColumnsRenamed(clash), **options).filter("kept")
    return judged.select(*(col(clash.get(c, c)).alias(c) for c in docs.columns))
