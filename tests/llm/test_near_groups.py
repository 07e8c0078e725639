"""Large groups of edited copies: every link between different texts, by brute force."""

import itertools
import random

import numpy as np

from lakequality.llm import minhash


def classes_of(rows, threshold=0.8):
    sets = [minhash.shingles(t.encode()) for _, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, y in itertools.combinations(range(len(rows)), 2):
        if rows[x][1] == rows[y][1] or minhash.similarity(sets[x], sets[y]) >= threshold:
            a, b = sorted((find(rows[x][0]), find(rows[y][0])))
            root[b] = a
    return {i: find(i) for i, _ in rows}


def edited_group(seed: int):
    """Copies of one text with few to many words changed, copies of copies, and cut ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    base = [f"base{k % 90}" for k in range(130)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        words = rng.choice(rows)[1].split() if rng.random() < 0.3 else list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words = words[: int(len(words) * rng.uniform(0.6, 1))]
        rows.append((i, " ".join(words)))
    return rows


def test_groups_of_edited_copies(spark):
    for seed in (1, 2):
        rows = edited_group(seed)
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = {r.id: r.class_id for r in minhash.near_classes(df).collect()}
        want = classes_of(rows)
        assert got == want and 1 < len(set(want.values())) < len(rows)


def test_rare_shingles_lose_no_pair(spark):
    """All pairs across roots at the threshold are candidates, repeated rows included."""
    rows = edited_group(3)
    texts = spark.createDataFrame([(i, i, t) for i, t in rows] + [(0, 0, rows[0][1])], "id bigint, h bigint, text string")
    open_ = spark.createDataFrame([(i, i % 3, i) for i, _ in rows], "h bigint, root bigint, rep bigint")
    pairs, tables = minhash._rare_pairs(open_, texts, 0.8)
    got = {(r.pivot, r.other) for r in pairs.collect()}
    for table in tables:
        table.remove()
    sets = {i: minhash.shingles(t.encode()) for i, t in rows}
    want = {
        (i, j) for (i, _), (j, _) in itertools.combinations(rows, 2)
        if i % 3 != j % 3 and minhash.similarity(sets[i], sets[j]) >= 0.8
    }
    assert want and want <= got and all(i % 3 != j % 3 for i, j in got)
    # A key is met from both sides, whatever the sizes.
    e, c, seen = np.array([7], np.uint64), np.array([10]), np.array([2])
    small, large = minhash._rare_keys(1, 10, e, c, seen, 0.8)[0], minhash._rare_keys(2, 12, e, c, seen, 0.8)[0]
    assert set(small) & set(large)
