"""Rates at which to draw documents so that domains reach target shares of tokens.

Membership is soft: a classifier read from a labelled table gives each document a probability for
every domain. The rates r >= 0 minimise the distance between the expected domain totals
T_k(r) = sum_i r_i * n_i * p_ik and their targets, by projected gradient steps over the whole table.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequality.llm.sharding import uniform
from lakequality.llm.tables import col, store, without

BLANKS = "\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words of lower-cased text, cut at blanks; null and blank texts have none."""
    flat = F.lower(F.coalesce(text, F.lit("")))
    for blank in BLANKS:
        flat = F.replace(flat, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(flat, " ", -1), "")


def _numbers(values: Sequence[float]) -> Column:
    """A constant array; folded once when the query is planned."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class DomainTable:
    """Telling words with a weight for each domain.

    `start` holds each domain's score for a text without any telling word.
    """

    def __init__(self, domains: Sequence[str], words: Sequence[str], weights: np.ndarray, start: np.ndarray):
        self.domains, self.words, self.weights, self.start = list(domains), list(words), weights, start

    def posteriors(self, words: Column) -> Column:
        """An array of probabilities, one for each domain, that sum to one."""
        k = len(self.domains)
        flat = _numbers(self.weights.reshape(-1))
        listed = F.array(*(F.lit(w) for w in self.words)).cast("array<string>")

        def add(total, word):
            at = (F.array_position(listed, word) - 1).cast("int") * k
            return let(at, lambda i: F.transform(total, lambda t, d: t + F.get(flat, i + d)))

        def shares(scores):
            grown = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
            return let(grown, lambda g: F.transform(g, lambda x: x / F.aggregate(g, F.lit(0.0), lambda a, y: a + y)))

        evidence = F.aggregate(F.array_intersect(words, listed), _numbers(self.start), add)
        return let(evidence, shares)


def fit_domains(
    docs: DataFrame,
    labels: DataFrame,
    domains: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    max_labelled: int = 6000,
    max_words: int = 300,
    min_evidence: float = 30.0,
) -> DomainTable:
    """Count the documents of each domain that have a word, in a bounded sample of labelled ones.

    `max_labelled` bounds the labelled rows that are read, chosen by the hash of the id; `max_words`
    bounds the model, whatever the vocabulary: logistic regression on the words present. It is a cut:
    where more words than that have the evidence, those with the least of it are not used. The words kept are those with the most evidence that a domain uses them more
    or less than the others (a likelihood-ratio test), `min_evidence` at least. Rows with a null
    id, domain or a domain not asked for are left out, an id with several domains counts for the
    first by name, and without labels all domains are equally likely.
    """
    names = list(domains)
    chosen = (
        labels.select(col(id_col).alias("id"), col(domain_col).alias("domain"))
        .filter(F.col("id").isNotNull() & F.col("domain").isin(names))
        .groupBy("id")
        .agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), "id")
        .limit(max_labelled)
    )
    texts = store(
        docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
        .join(chosen, "id")
        .select("domain", F.array_distinct(words_of(F.col("text"))).alias("words")),
        "labelled",
    )
    found = {r["domain"]: r["count"] for r in texts.groupBy("domain").count().collect()}
    n = np.array([found.get(d, 0) for d in names], dtype=float)
    if len(names) < 2 or not n.any():
        return DomainTable(names, [""], np.zeros((1, len(names))), np.zeros(len(names)))
    counts = texts.select("domain", F.explode("words").alias("word")).groupBy("word").agg(
        *(F.count_if(F.col("domain") == d).alias(f"c{k}") for k, d in enumerate(names))
    )
    total = sum((F.col(f"c{k}") for k in range(len(names))), F.lit(0))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    def evidence(k):
        here, size, everything = F.col(f"c{k}"), float(n[k]), float(n.sum())
        share = total / everything
        return 2 * (
            part(here, share * size)
            + part(total - here, share * (everything - size))
            + part(size - here, (1 - share) * size)
            + part(everything - size - total + here, (1 - share) * (everything - size))
        )

    strength = F.greatest(*(evidence(k) for k in range(len(names)) if 0 < n[k] < n.sum()), F.lit(0.0), F.lit(0.0))
    telling = (
        counts.withColumn("strength", strength)
        .filter(F.col("strength") >= min_evidence)
        .orderBy(F.desc("strength"), "word")
        .limit(max_words)
        .collect()
    )
    words = [r["word"] for r in telling] or [""]
    listed = F.array(*(F.lit(w) for w in words)).cast("array<string>")
    places = F.transform(F.array_intersect("words", listed), lambda w: F.array_position(listed, w) - 1)
    rows = texts.select("domain", places.alias("at")).collect()
    present = np.zeros((len(rows), len(words)))
    for i, row in enumerate(rows):
        present[i, row["at"]] = 1.0
    weights, start = _softmax_regression(present, np.array([names.index(r["domain"]) for r in rows]), len(names))
    return DomainTable(names, words, np.round(weights, 6), np.round(start, 6))


def _softmax_regression(
    x: np.ndarray, y: np.ndarray, k: int, rounds: int = 400, penalty: float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and start scores by accelerated gradient steps; the penalty acts on the weights."""
    x = np.hstack([x, np.ones((len(x), 1))])
    goal = np.eye(k)[y]
    hold = np.full((x.shape[1], 1), penalty)
    hold[-1] = 0.0
    pace = 1.0 / (0.5 * np.linalg.norm(x, 2) ** 2 + penalty)
    w = ahead = np.zeros((x.shape[1], k))
    for t in range(rounds):
        scores = x @ ahead
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        new = ahead - pace * (x.T @ (chance - goal) + hold * ahead)
        ahead, w = new + t / (t + 3.0) * (new - w), new
    return w[:-1], w[-1]


def solve_rates(
    p: Column, steps: Sequence[np.ndarray]
) -> Column:
    """The rate after the given steps: start at one, move against p . step, never below zero."""
    rate = F.lit(1.0)
    for step in steps:
        move = sum((F.get(p, F.lit(k)) * float(s) for k, s in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


def _gram(rows: DataFrame, k: int, taken: Column) -> tuple[np.ndarray, np.ndarray]:
    """Sums of n p p' over the rows that `taken` holds for, and the domain totals of all rows."""
    n = F.when(taken, F.col("n")).otherwise(0)
    sums = rows.agg(
        *(F.sum(n * F.get("p", F.lit(a)) * F.get("p", F.lit(b))).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k)),
        *(F.sum(F.col("r") * F.col("n") * F.get("p", F.lit(a))).alias(f"t{a}") for a in range(k)),
    ).first()
    g = np.zeros((k, k))
    for a in range(k):
        for b in range(a, k):
            g[a, b] = g[b, a] = sums[f"g{a}_{b}"] or 0.0
    return g, np.array([sums[f"t{a}"] or 0.0 for a in range(k)])


def fit_rates(
    rows: DataFrame, targets: np.ndarray, rounds: int = 200, tolerance: float = 1e-6
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Projected gradient steps for rows (`n`, `p`); also the domain totals before each step and at the end.

    The distance is measured in the metric of G = sum n p p' over the rows whose rate is not at zero,
    and a document's step is free of its own length. While no rate reaches zero, one step of length
    one then reaches the least-squares solution; later steps correct for rates held at zero. A step
    that widens the gap is taken back and halved. It ends within `tolerance` of the targets, or when
    no step narrows the gap; `rounds` is a guard. The last totals tell what is missed. Each round is
    one aggregate of a few numbers over the whole table; the driver holds only those.
    """
    k = len(targets)
    steps, seen = [], []
    least = np.inf
    for _ in range(rounds):
        g, totals = _gram(rows.select(solve_rates(F.col("p"), steps).alias("r"), "n", "p"), k, F.col("r") > 0)
        if not g.any() and not steps:
            return [], []
        gap = totals - targets
        wide = float(np.linalg.norm(gap))
        if steps and wide >= least * (1 - 1e-9):
            if np.abs(steps[-1]).max() < 1e-9:
                steps.pop()
                break
            steps[-1] = steps[-1] / 2
            continue
        least = wide
        seen.append(totals)
        if np.abs(gap).max() <= tolerance * max(1.0, np.abs(targets).max()):
            break
        steps.append(np.linalg.inv(g + np.eye(k) * (1e-9 * max(np.trace(g), 1e-9) / k)) @ gap)
    else:
        # The last step was not measured.
        steps = steps[: max(0, len(seen) - 1)]
    return steps, seen


def _copies(rate: Column, ident: Column, seed: str) -> Column:
    """A rate rounded up or down by a repeatable draw."""
    return F.floor(rate + uniform(ident.cast("string"), F.lit(seed))).cast("long")


def _known(table: DomainTable, text: Column) -> Column:
    """Words and domain posteriors of a text."""
    return let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), table.posteriors(w).alias("p")))


def _fitted(docs, labels, weights, anchor, headroom, rounds, id_col, text_col, domain_col, **model):
    """The documents' words and posteriors, stored; the classifier; and the steps to their rates."""
    domains = list(weights)
    table = fit_domains(docs, labels, domains, id_col, text_col, domain_col, **model)
    rows = docs.select(col(id_col).alias("id"), _known(table, col(text_col)).alias("known")).select("id", "known.n", "known.p")
    rows = store(rows, "posteriors")
    share = np.array([weights[d] for d in domains], dtype=float)
    share /= share.sum()
    now = rows.agg(*(F.sum(F.col("n") * F.get("p", F.lit(k))).alias(f"t{k}") for k in range(len(domains)))).first()
    totals = np.array([now[f"t{k}"] or 0.0 for k in range(len(domains))])
    lead = domains.index(anchor) if anchor else int(share.argmax())
    targets = share / share[lead] * totals[lead] * headroom
    steps, seen = fit_rates(rows, targets, rounds)
    missed = np.abs(seen[-1] - targets) if seen else np.zeros(len(domains))
    if missed.max() > 1e-6 * max(1.0, targets.max()):
        told = ", ".join(f"{d}: {t:.6g} of {w:.6g}" for d, t, w in zip(domains, seen[-1], targets, strict=True))
        warnings.warn(f"targets of tokens not met: {told}", stacklevel=3)
    return rows, table, steps


def mix(
    docs: DataFrame,
    labels: DataFrame,
    weights: Mapping[str, float],
    anchor: str | None = None,
    headroom: float = 1.05,
    rounds: int = 200,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    seed: str = "mix",
    **model,
) -> DataFrame:
    """Every document with its domain, rate and number of copies.

    `weights` are target shares of tokens by domain; the scale is set by `anchor`, the heaviest
    domain by default, which is to reach `headroom` times the tokens it has now. Result: the id,
    `n_tokens` (words), `domain` (the likeliest), `posteriors` (in the order of `weights`), `rate`
    and `copies`, the rate rounded up or down by a repeatable draw so that copies average to it.

    Targets that no rates meet are approached, and a warning names the totals reached.

    Null texts have no tokens and a rate like any text of their posteriors, null ids are kept and
    drawn alike, repeated rows are drawn alike, an empty table gives no rows, and other columns are
    not read.
    """
    rows, _, steps = _fitted(docs, labels, weights, anchor, headroom, rounds, id_col, text_col, domain_col, **model)
    domains = list(weights)
    rate = F.round(solve_rates(F.col("p"), steps), 9)
    best = F.array_position("p", F.array_max("p")).cast("int")
    names = F.array(*(F.lit(d) for d in domains))
    copies = _copies(rate, F.col("id"), seed)
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_tokens"),
        F.element_at(names, best).alias("domain"),
        F.transform("p", lambda x: F.round(x, 9)).alias("posteriors"),
        rate.alias("rate"),
        copies.alias("copies"),
    )


def remix(
    docs: DataFrame,
    labels: DataFrame,
    weights: Mapping[str, float],
    anchor: str | None = None,
    headroom: float = 1.05,
    rounds: int = 200,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    seed: str = "mix",
    **model,
) -> DataFrame:
    """The documents, each as often as `mix` gives it copies, with the columns they have.

    A row's copies follow from its own text and id once the rates are fitted, so they are computed
    where the row is: whole texts are neither joined nor shuffled. Rows of one id but other texts
    have copies of their own. Nulls, repeated rows and empty tables are as in `mix`.
    """
    _, table, steps = _fitted(docs, labels, weights, anchor, headroom, rounds, id_col, text_col, domain_col, **model)
    known = docs.withColumn("__mix_p", _known(table, col(text_col))["p"])
    rated = known.withColumn("__mix_copies", _copies(F.round(solve_rates(F.col("__mix_p"), steps), 9), col(id_col), seed))
    copied = rated.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), F.col("__mix_copies").cast("int"))))
    return copied.select(*(col(c) for c in docs.columns))


def resample(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents, each as often as its copies say, with the columns they have."""
    copies = mixed.groupBy(col(id_col).alias("__mix_id")).agg(F.max("copies").alias("__mix_copies"))
    joined = docs.join(copies, col(id_col).eqNullSafe(F.col("__mix_id")))
    copied = joined.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), F.col("__mix_copies").cast("int"))))
    return copied.select(*(col(c) for c in without(docs, ["__mix_id", "__mix_copies", "__mix_copy"])))
