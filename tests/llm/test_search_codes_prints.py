"""Lexical search, vector codes and phrase fingerprints against brute force and odd input."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakequality.llm import codes, phrases, queries, ranking, token_counts
from lakequality.session import work_dir
from tests.llm.test_operators import DOCS, ODD, SF, read

VECTORS = "vec_id bigint, embedding array<float>, label int, error string, __id int"


# Search


def terms(text):
    return [t.translate(str.maketrans(ranking.UPPER, ranking.LOWER)) for t in re.findall(ranking.TERM, text or "")]


def ranked(docs, items, top=ranking.TOP):
    """Every document scored for every item, term by term."""
    said = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in said]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in said for t in c)
    out = []
    for item, text in items:
        scored = []
        for (ident, counts), size in zip(said, sizes, strict=True):
            m = 75 + 25 * size * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in terms(text) if t in counts
            )
            if score > 0:
                scored.append((-score, ident is None, ident or 0, ident))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["item"], r["rank"], r["id"], r["score"]) for r in df.collect()), key=repr)


def test_search_against_all_scores(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, "benchmark").collect()]
    want = ranked(docs, items)
    got = queries.op11_search(spark, SF).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr) == want
    # Small blocks and leaves change how the work is cut, not the result.
    tables = read(spark, "documents"), read(spark, "benchmark").limit(6)
    some = [(r.item_id, r.text) for r in tables[1].collect()]
    assert found(ranking.search(*tables, block_terms=50, leaf_rows=1)) == ranked(docs, some)


def test_search_odd_input(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    rows = [(1, "Word30, word31 WORD1 é 漢字 word1"), (1, "Word30, word31 WORD1 é 漢字 word1"), (None, "lines of"), (2, None), (3, "-- "), (4, "absent")]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    assert found(ranking.search(docs, items)) == ranked([(r[0], r[1]) for r in ODD], rows)
    assert ranking.search(docs.limit(0), items).count() == 0 and ranking.search(docs, items.limit(0)).count() == 0
    assert ranking.search(docs.filter("text IS NULL"), items).count() == 0
    # Ties of many copies: the least ids win, a null id is last.
    copies = spark.range(9000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("same words here").alias("text"))
    both = copies.unionByName(spark.range(9000).select((F.col("id") + 9000).alias("doc_id"), F.lit("others").alias("text")))
    got = ranking.search(both, spark.createDataFrame([("a", "same others")], "item_id string, text string")).collect()
    assert sorted((r["rank"], r["id"]) for r in got) == [(k, 8999 + k) for k in range(1, 21)]
    got = ranking.search(both, spark.createDataFrame([("a", "same")], "item_id string, text string"), top=9000).collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])] == [*range(1, 9000), None]


def test_trie_bounds_hold_and_prune():
    rng = random.Random(4)
    n_terms, n_docs = 30, 700
    docs = [{t: rng.randrange(1, 5) for t in range(n_terms) if rng.random() < 1 / (1 + t / 3)} or {0: 1} for _ in range(n_docs)]
    norms = np.array([rng.randrange(75, 300) for _ in docs], dtype=np.int64)
    flat = [np.array(v) for v in ([len(d) for d in docs], [t for d in docs for t in d], [c for d in docs for c in d.values()])]
    trie = ranking.Trie(*flat, norms, np.zeros(n_docs, bool), np.arange(n_docs), n_terms, leaf_rows=4)
    weights = np.arange(1, n_terms + 1, dtype=np.int64) * 100
    every = ranking.scores(trie.tf, trie.norms, weights)
    bounds = ranking.scores(trie.most, trie.least_norm, weights)
    for (low, high), bound in zip(trie.ends, bounds, strict=True):
        assert every[low:high].max() <= bound
    best = ranking.Best(5)
    rare = np.array([25, 27, 29])
    trie.search(rare, weights[rare], best)
    want = ranking.scores(trie.tf[:, rare], trie.norms, weights[rare])
    assert best.score.tolist() == sorted(want.tolist(), reverse=True)[:5]
    assert 0 < trie.seen < n_docs / 2


def test_long_text_is_counted_in_pieces(monkeypatch):
    text = ("Ab é1 " * 5000 + "x" * 70000 + " end").encode()
    whole = ranking.term_counts(text)
    monkeypatch.setattr(ranking, "_CHUNK", 1000)
    assert ranking.term_counts(text) == whole == {b"ab": 5000, "é1".encode(): 5000, b"x" * 70000: 1, b"end": 1}


# Vector codes


def coded(rows, n_parts=codes.N_PARTS, n_entries=codes.N_ENTRIES, rounds=codes.ROUNDS):
    """Every distance computed, in Python's whole numbers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // n_parts
    parts = [[v[p * width : (p + 1) * width] for p in range(n_parts)] for _, v, _ in kept]
    books = [[list(row[p]) for row in parts[:n_entries]] for p in range(n_parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), k) for k, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(n_parts):
            groups = {}
            for row in parts:
                groups.setdefault(nearest(p, row[p])[1], []).append(row[p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = []
    for (i, _, label), row in zip(kept, parts, strict=True):
        best = [nearest(p, part) for p, part in enumerate(row)]
        out.append((i, label, [k for _, k in best], sum(d for d, _ in best)))
    totals = Counter()
    for _, label, _, error in out:
        totals[label] += error
    return sorted(((*r, totals[r[1]]) for r in out), key=repr), books


def test_codes_against_all_distances(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, "embeddings").collect()]
    want, books = coded(rows)
    got = queries.op12_vector_codes(spark, SF).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(
        (i, "".join(f"{k:02x}" for k in code), error, total) for i, _, code, error, total in want
    )
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_odd_input(spark):
    rng = random.Random(8)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(16)], k % 3 or None, "x", k) for k in range(60)]
    rows += [(3, rows[3][1], 1, None, None)] * 200  # repeated rows and a hot label
    rows += [(None, [0.5] * 16, None, None, None), (70, None, 1, None, None), (71, [float("nan")] * 16, 1, None, None)]
    rows += [(72, [None] + [0.1] * 15, 1, None, None), (73, [float("-inf")] + [0.1] * 15, 1, None, None)]
    df = spark.createDataFrame(rows, VECTORS).repartition(7)
    floats = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    for options in ({}, {"n_entries": 300, "n_parts": 4}, {"memo_cells": 2}):
        sizes = {k: v for k, v in options.items() if k != "memo_cells"}
        want, books = coded(floats, **sizes)
        got, found_books = codes.compress(df, **options)
        assert sorted(((r.id, r.label, r.codes, r.error, r.label_error) for r in got.collect()), key=repr) == want
        assert found_books.tolist() == books
    none, books = codes.compress(df.limit(0))
    assert none.columns == got.columns and none.count() == 0 and books.size == 0
    assert codes.compress(df.filter("embedding IS NULL"))[0].count() == 0
    empty, books = codes.compress(spark.createDataFrame([(1, [], None), (2, [], 1)], "vec_id int, embedding array<float>, label int"))
    assert sorted((r.id, r.codes, r.error, r.label_error) for r in empty.collect()) == [(1, [0] * 8, 0, 0), (2, [0] * 8, 0, 0)]
    assert codes.books_digest(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="one length"):
        codes.compress(spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], "vec_id int, embedding array<float>, label int"))
    with pytest.raises(Exception, match="does not fit"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], "vec_id int, embedding array<float>, label int"))


def test_cells_keep_every_nearest_entry():
    rng = np.random.default_rng(2)
    entries = rng.integers(-500, 500, (16, 8))
    entries[5] = entries[2]  # a tie goes to the lower index
    parts = rng.integers(-900, 900, (4000, 8))
    distances = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for bits in (0, 5, 8, 12):
        nearest = codes.Nearest(entries)
        nearest.bits = bits
        best, least = nearest(parts)
        assert (best == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()
    assert nearest.compared == parts.shape[0] * 16
    nearest = codes.Nearest(entries)
    nearest(parts)
    assert nearest.compared < parts.shape[0] * 14
    book = rng.integers(-500, 500, (2, 4, 3))
    assert (codes.decode([1, 3], book) == np.concatenate([book[0, 1], book[1, 3]]) / 4096).all()


# Phrase fingerprints


def phrase_set(text):
    """Phrases of a text, cut by the definition."""
    seen, first = set(), 0
    for end in range(1, len(text) + 1):
        if text[first:end] not in seen:
            seen.add(text[first:end])
            first = end
    return seen


def order(rows, hashes):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1] or ""]))


def neighbours(spark, rows):
    texts = spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}], "t string")
    hashes = {r.t: r.h for r in texts.select("t", F.xxhash64("t").alias("h")).collect()}
    rows = [(i, t or "") for i, t in order(rows, hashes)]
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        swapped = len(text) // 4
        edited = text[: len(text) - swapped] + following[:swapped]
        prints = [phrases.fingerprint(t.encode()) for t in (text, edited, following)]
        near = [phrases.likeness(prints[0], p) for p in prints[1:]]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0].tobytes().hex(), prints[1].tobytes().hex(), *near))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()),
        key=repr,
    )


def shown(df):
    return df.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def test_prints_against_one_by_one(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    assert rows_of(queries.op13_phrase_prints(spark, SF)) == neighbours(spark, rows)


def test_prints_odd_input(spark):
    docs = spark.createDataFrame([(r[0], r[1], "x", 1) for r in ODD], "doc_id bigint, text string, n_chars string, near_next int")
    found = phrases.compare_neighbours(docs.repartition(5))
    assert rows_of(shown(found)) == neighbours(spark, [(r[0], r[1]) for r in ODD])
    assert found.columns[:2] == ["doc_id", "text"] and len(found.columns) == 8
    assert phrases.compare_neighbours(docs.limit(0)).count() == 0
    one = phrases.compare_neighbours(docs.filter("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    # One id and one text for most rows: the ranges still share them, and every row has its neighbour.
    hot = spark.range(3000).select(F.lit(7).cast("bigint").alias("doc_id"), F.when(F.col("id") < 2500, F.lit("hot text " * 9)).otherwise(F.format_string("own %d", "id")).alias("text"))
    rows = [(r.doc_id, r.text) for r in hot.collect()]
    assert rows_of(shown(phrases.compare_neighbours(hot))) == neighbours(spark, rows)


def test_phrases_are_the_definition(monkeypatch):
    rng = random.Random(3)
    for n in (0, 1, 2, 50, 3000):
        text = "".join(rng.choice("abé漢 ") for _ in range(n)).encode()
        ends = phrases.Parser().ends(text)
        cuts = [0, *ends]
        assert {text[a:b] for a, b in zip(cuts, ends, strict=False)} == phrase_set(text)
        for cut in (0, n // 2, len(text)):
            tail = text[::-1][: n // 3]
            own, other = phrases.fingerprints(text, cut, tail)
            assert own.tobytes() == phrases.fingerprint(text).tobytes()
            assert other.tobytes() == phrases.fingerprint(text[:cut] + tail).tobytes()
    whole = phrases.fingerprint(text)
    monkeypatch.setattr(phrases, "_CHUNK", 7)
    assert (phrases.fingerprint(text) == whole).all()
    # A full dictionary starts anew; the state at a cut is the same either way.
    parser = phrases.Parser(limit=10)
    head = parser.ends(text[:100])
    one, two = parser.both(text[100:], text[100:])
    assert one == two and [*head, *(100 + e for e in one)] == list(phrases.Parser(limit=10).ends(text))


def test_likeness_estimates_shared_phrases():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    errors = []
    for _ in range(40):
        text = " ".join(rng.choice(vocabulary) for _ in range(600)).encode()
        other = text[: rng.randrange(len(text))] + " ".join(rng.choice(vocabulary) for _ in range(300)).encode()
        a, b = phrase_set(text), phrase_set(other)
        errors.append(phrases.likeness(phrases.fingerprint(text), phrases.fingerprint(other)) - len(a & b) / len(a | b))
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.02
    text = b"the same text " * 40
    assert phrases.likeness(phrases.fingerprint(text), phrases.fingerprint(text)) == 1.0


# Token counts


def test_token_ledger_refuses_unknown_words(spark):
    ledger = token_counts.Ledger(spark, work_dir(spark, "ledger"))
    rows = spark.createDataFrame([(1, "a b", "s", "en", "insert"), (2, "c", "s", "en", "insert")], "doc_id bigint, text string, source string, lang string, op string")
    counters = {"words": token_counts.Words()}
    assert ledger.commit("load", rows, counters, F.col("op"))
    for word in (None, "Delete", ""):
        with pytest.raises(ValueError, match="op is"):
            ledger.commit("odd", rows.withColumn("op", F.lit(word).cast("string")), counters, F.col("op"))
    assert [(r.docs, r.tokens) for r in ledger.totals().collect()] == [(2, 3)] and ledger.batches() == ["load"]
