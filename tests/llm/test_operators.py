"""Operators on training data against brute force, round trips and odd input."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakequality.llm import (
    chat, decontaminate, host_rules, induced, lines, minhash, mixing, pages, queries, sharding, suffixes, token_counts,
)
from lakequality.session import work_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string, lang string, n_words string, `__hash` int"
BASE = " ".join(f"word{i}" for i in range(60))
ODD = [
    (1, BASE, "a", "en", "x", 1),
    (2, BASE, "a", "en", "x", 1),
    (2, BASE, "a", "en", "x", 1),
    (3, BASE.replace("word30", "other"), "a", None, None, None),
    (4, None, None, None, None, None),
    (5, "", "b", "en", "x", 1),
    (None, "A null id\nwith lines of its own\nwith lines of its own", "b", "en", "x", 1),
    (6, "word " * 20000, "b", "en", "x", 1),
    (7, "é\x00 ퟿ 漢字 <|im_end|>", "b", "en", "x", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", "<|im_end|><|im_start|>assistant ok", "x"), (1, 1, "assistant", "a <\\|im_end|> b<|im_end|", "x"),
        (1, 1, "assistant", "a <\\|im_end|> b<|im_end|", "x"), (1, 2, "us\ner<|nl|><\\|im_start|>", None, "x"),
        (None, None, None, None, None), (2, None, "assistant", "long " * 30000, "x"), (2, 1, "assistant", "", "x"),
    ]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, formatted string")
    rows = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert all(r.exact for r in rows.values()) and set(rows) == {1, 2, None}
    assert [t.text for t in rows[1].turns] == [t[3] or "" for t in turns[:4]]
    digest = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    want = "".join(f"{t[2]}\n{t[3] or ''}\n" for t in turns[:4])
    assert digest[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert digest[1].loss_sha256 == hashlib.sha256((turns[1][3] * 2).encode()).hexdigest()
    assert digest[2].loss_chars == 150000
    assert chat.format_chats(df.limit(0)).count() == 0
    bad = spark.createDataFrame([("<|im_start|>user\nhi",), ("hi<|im_end|>",), ("",)], "t string")
    assert [r.p for r in bad.select(chat.parse(F.col("t")).alias("p")).collect()] == [None, None, []]


def test_shards_are_even_and_gapless(spark, odd, none):
    rows = queries.op3_sharding(spark, SF).collect()
    by = {k: [r for r in rows if r.shard == k] for k in range(8)}
    sizes = [sum(r["size"] for r in part) for part in by.values()]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in rows)
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in by.values())
    texts = {r.doc_id: r.text for r in read(spark, "documents").collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    got = sharding.assign(odd, 3).collect()
    assert len(got) == len(ODD) and sorted(r["size"] for r in got)[:2] == [1, 1]
    hot = sharding.assign(spark.range(999).select(F.col("id").alias("doc_id"), F.lit("same").alias("text")), 3)
    assert max(r["count"] for r in hot.groupBy("shard").count().collect()) < 400
    assert sharding.assign(none, 3).count() == 0


def test_copies_stay_in_one_shard_while_they_fit(spark):
    # 8 shards: one text with half a shard of the bytes, one with one and a half, and others.
    texts = F.when(F.col("id") < 500, F.lit("half " * 4)).when(F.col("id") < 2000, F.lit("more " * 4)).otherwise(F.format_string("other %014d", "id"))
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), texts.alias("text"))
    rows = sharding.assign(docs).collect()
    assert len({r.shard for r in rows if r.doc_id < 500}) == 1
    assert len({r.shard for r in rows if 500 <= r.doc_id < 2000}) <= 2
    sizes = [sum(r["size"] for r in rows if r.shard == k) for k in range(8)]
    assert max(sizes) < 1.1 * sum(sizes) / 8
    assert all(sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows))) for k in range(8))


@pytest.mark.filterwarnings("error:targets of tokens")
def test_mixing_meets_targets_on_real_posteriors(spark):
    rows = queries.op1_mixing(spark, "/root/testdata/sf0.01").collect()
    totals = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in queries.MIX}
    now = sum(r.n_tokens * r.p_good for r in rows)
    scale = 1.05 * now / queries.MIX["good"]
    assert all(abs(totals[d] - share * scale) <= 1e-4 * share * scale for d, share in queries.MIX.items())


def test_mixing_meets_targets_and_finds_toxic(spark, odd, none):
    rows = spark.createDataFrame(
        [(n, [a, 1 - a]) for n, a in ((100, 0.9), (300, 0.2), (50, 0.5), (80, 0.0), (0, 1.0))], "n int, p array<double>"
    )
    target = np.array([300.0, 200.0])
    steps, seen = mixing.fit_rates(rows, target)
    rates = [r.r for r in rows.select(mixing.solve_rates(F.col("p"), steps).alias("r")).collect()]
    a = np.array([[100 * 0.9, 300 * 0.2, 25, 0, 0], [10, 240, 25, 80, 0]])
    assert min(rates) >= 0 and np.allclose(a @ rates, target, rtol=1e-5)
    # Held-out accuracy: labels that the fit does not see.
    labels = queries.labelled_domains(spark, "/root/testdata/sf0.01").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix(docs, labels.filter("half = 0"), queries.MIX)
    held = mixed.join(labels.filter("half = 1").withColumnRenamed("domain", "label"), "doc_id").collect()
    clean = [r for r in held if r.label == "good"]
    assert sum(r.domain == "good" for r in clean) >= 0.85 * len(clean)
    labelled = spark.createDataFrame([(1, "good"), (None, "junk"), (3, None), (6, "junk")], "doc_id bigint, domain string")
    assert mixing.mix(odd, labelled, queries.MIX).count() == len(ODD)
    assert mixing.mix(none, labelled, queries.MIX).count() == 0
    once = mixing.mix(odd, labelled, queries.MIX)
    assert mixing.resample(odd, once).columns == odd.columns
    again = mixing.remix(odd, labelled, queries.MIX)
    assert again.columns == odd.columns and mixing.remix(none, labelled, queries.MIX).count() == 0
    wanted = sorted((r.doc_id or 0, r.copies) for r in once.collect() if r.copies)
    assert sorted(r.doc_id or 0 for r in again.collect()) == [i for i, n in wanted for _ in range(n)]


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    a, b = sorted((a, b), key=len)
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def test_line_dedup_against_brute_force(spark, odd, none):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde ") for _ in range(n)) + "z" for n in (16, 40, 63, 64, 65, 127, 128, 129, 200, 512, 700)]
    said = []
    for line in base * 4:
        k = rng.randrange(len(line))
        said.append(rng.choice([line, line[:k] + line[k + 1 :], line[:k] + "Q" + line[k:], line[:k] + "R" + line[k + 1 :], line[:k] + "XY" + line[k:]]))
    rng.shuffle(said)
    texts = ["\n".join(said[k : k + 4]) for k in range(0, len(said), 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    flat = [(d, i, s) for d, t in enumerate(texts) for i, s in enumerate(t.split("\n"))]
    want = {
        (d, i) for n, (d, i, s) in enumerate(flat)
        if s.strip() and any(o == s or len(s) >= 16 and len(o) >= 16 and distance_one(o, s) for _, _, o in flat[:n])
    }
    got = {(r.id, r.line) for r in lines.find_repeats(docs).collect()}
    assert got == want
    out = lines.remove_repeats(odd)
    rows = out.collect()
    assert len(rows) == len(ODD) and {r.text for r in rows if r.doc_id is None} == {"A null id\nwith lines of its own"}
    assert [r.n_lines for r in rows if r.doc_id == 4] == [0]
    assert lines.remove_repeats(none).count() == 0


def test_token_ledger(spark, odd, none):
    counters = {"v1": token_counts.Words()}
    ledger = token_counts.Ledger(spark, work_dir(spark, "t-ledger"))
    insert = F.lit("insert")
    assert ledger.commit("one", odd, counters, insert)
    assert not ledger.commit("one", odd, counters, insert)
    total = sum(len((r[1] or "").split()) for r in ODD if r[0] != 7) + 4
    assert sum(r.tokens for r in ledger.totals().collect()) == total
    assert ledger.commit("two", odd.filter("doc_id = 6"), counters, F.lit("delete"))
    assert ledger.commit("three", odd.filter("doc_id = 1").withColumn("text", F.lit("two words")), counters, F.lit("revise"))
    assert ledger.commit("four", none, counters, insert)
    assert ledger.commit("five", odd.filter("doc_id = 6"), counters, F.lit("delete"))
    rows = ledger.totals().collect()
    assert sum(r.tokens for r in rows) == total - 20000 - 58 and sum(r.docs for r in rows) == len(ODD) - 1
    pairs = token_counts.count_tokens(odd, {"bpe": token_counts.BytePairs(spark)}).collect()
    assert next(r.tokens for r in pairs if r.doc_id == 4) == 0 and all(r.tokens > 0 for r in pairs if r.text)


PAGE = (
    '<html><head><title>T</title><body><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">We</div>'
    '<article><h1>T &amp; x</h1><p>One<b>bold</b>  two<!-- c -->three &lt;t&gt;<script>if(a<b){}</script><div class=ad>buy</div>'
    '<form><input>n</form></article><section class="comments"><p>first!</p></section><footer>f'
)


def test_pages(spark):
    assert pages.page_text(PAGE, set()) == "T & x\nOnebold twothree <t>"
    plain = "<body><p>Site name</p><p>Own text {0} here</p><p>More of {0}</p><p>Own end {0}</p><p>All rights reserved</p>"
    rows = [(k, f"http://h.org/d/{k}", plain.format(k), "x") for k in range(4)]
    rows += [(9, "http://h.org/d/9", plain.format(3), "x"), (10, None, None, None), (11, "http://x.org/a", "", "x"), (12, "http://y.org/", PAGE, "x"), (12, "http://y.org/", PAGE, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got[0] == "Own text 0 here\nMore of 0\nOwn end 0" and got[10] == got[11] == ""
    assert got[12].startswith("T & x") and pages.extract(df.limit(0)).count() == 0 and len(got) == 8
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(10))] for _ in range(2))
        best = max(
            (n for n in range(len(a) + 1) for c in itertools.combinations(a, n) if (it := iter(b)) and all(x in it for x in c)), default=0
        )
        assert len(pages.shared(a, b)) == best


def test_every_page_is_differenced_and_articles_are_restored(spark):
    page = "<body><p>Site name</p><article><h1>Notes</h1><p>Own text {0}</p></article><p>Own side {0}</p><p>All rights reserved</p></body>"
    rows = [(k, f"http://h.org/d/{k}", page.format(k)) for k in range(4)] + [(9, "http://alone.org/", page.format(9))]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == f"Notes\nOwn text {k}\nOwn side {k}" for k in range(4))
    # No page to compare with: the marked article alone.
    assert got[9] == "Notes\nOwn text 9"


def test_menus_go_beside_short_texts_and_copies(spark):
    menu = "".join(f"<li>Entry {k}" for k in range(9))
    page = f"<body><ul>{menu}</ul><p>Own {{0}}</p><p>More {{0}}</p>"
    rows = [(k, f"http://h.org/d/{k:02d}", page.format(k)) for k in range(4)]
    # Equal pages, and pages with a changed block, at neighbouring addresses.
    text = "<body><p>Site</p>" + "".join(f"<p>{{0}} says {k}</p>" for k in range(8)) + "<p>{1}</p><p>Rights</p>"
    rows += [(10 + k, f"http://c.org/a{k}", text.format("A", "end")) for k in range(3)]
    rows += [(20 + k, f"http://c.org/b{k}", text.format("B", f"end {k}")) for k in range(5)]
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == f"Own {k}\nMore {k}" for k in range(4))
    said = {c: "\n".join(f"{c} says {k}" for k in range(8)) for c in "AB"}
    assert all(got[10 + k] == said["A"] + "\nend" for k in range(3))
    assert all(got[20 + k] == said["B"] + f"\nend {k}" for k in range(5))


def test_leaks(spark, odd, none):
    items = spark.createDataFrame(
        [(1, " ".join(f"WORD{i}" for i in range(20, 45))), (2, "漢字"), (3, ""), (4, None), (None, "null id"), (1, "é")], "item_id bigint, text string"
    )
    for block in (1 << 20, 8):
        rows = {(r.doc_id, i): r for i, r in enumerate(decontaminate.find_leaks(odd, items, block_bytes=block).collect())}
        first = next(r for (d, _), r in rows.items() if d == 1)
        assert first.n_hit == 25 and first["items"] == ["1"] and "word44" not in first.clean_text and "word45" in first.clean_text
        assert next(r["items"] for (d, _), r in rows.items() if d is None) == ["null"]
        assert next(r["items"] for (d, _), r in rows.items() if d == 7) == ["1", "2"]
    assert decontaminate.remove_leaks(odd, items).columns == odd.columns
    assert decontaminate.find_leaks(odd, items.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.find_leaks(none, items).count() == 0


def test_host_rules(spark, odd, none):
    assert host_rules.measure(b"a b c x\na b c x\n\n#$") == (9, 10, 2, 1, 8)
    judged = host_rules.judge(odd).collect()
    assert len(judged) == len(ODD) and not any(r.kept for r in judged if r.doc_id in (4, 5, 6))
    assert all(r.kept for r in judged if r.doc_id == 1)
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(60)) + " ###" * (40 if k % 5 else 0), "bad") for k in range(200)]
    rows += [(1000 + k, " ".join(f"v{k}x{i}" for i in range(60)), "good") for k in range(200)]
    rows += [(2000, rows[1][1], "good")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    rules = {"symbols": "n_symbols > n_words"}
    kept = {r.doc_id: r.kept for r in host_rules.judge(docs, rules=rules, base_failed="n_words < 50").collect()}
    assert not kept[1] and kept[0] and kept[1000] and kept[2000]
    assert host_rules.filter_documents(odd).columns == odd.columns and host_rules.judge(none).count() == 0


def test_suffix_sort():
    rng = random.Random(3)
    for _ in range(60):
        some = [bytes(rng.randrange(1, 1 + rng.choice([1, 2, 200])) for _ in range(rng.randrange(1, 40))) for _ in range(8)]
        text = np.frombuffer(b"".join(c + b"\0" for c in [*some, *some[:2]]), np.uint8)
        chunks = list(induced.sorted_suffixes(text, 20, rng.choice([5, 50, 1 << 20])))
        places, common = (np.concatenate([c[k] for c in chunks]) for k in (0, 1))
        raw = text.tobytes() + b"\0" * 20
        heads = [raw[p : p + 20] for p in places.tolist()]
        assert heads == sorted(heads) and sorted(places.tolist()) == np.flatnonzero(text).tolist()
        for a, b, n in zip(heads, heads[1:], common[1:].tolist(), strict=False):
            assert a[:n] == b[:n] and (n == 20 or a[n] != b[n])


def test_suffix_dedup_against_brute_force(spark, odd, none):
    rows = sorted((r.doc_id, r.text.encode()) for r in read(spark, "documents").collect())
    first, want = {}, {}
    for i, text in rows:
        for k in range(len(text) - 49):
            first.setdefault(text[k : k + 50], i)
    for i, text in rows:
        gone = bytearray(len(text))
        for k in range(len(text) - 49):
            if first[text[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        want[i] = (len(text), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = queries.op9_suffix_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    out = suffixes.remove_repeats(odd).collect()
    assert len(out) == len(ODD) and all(r.kept == b"" for r in out if r.doc_id == 2)
    assert next(len(r.kept) for r in out if r.doc_id == 6) == 100000 and suffixes.remove_repeats(none).count() == 0


def test_heavy_anchors_are_cut_by_strings(spark):
    rng = random.Random(9)
    phrase = "a phrase that is said everywhere"
    said = ["".join(rng.choice("abcdef ") for _ in range(40)) for _ in range(60)]
    rows = [(k, f"{said[rng.randrange(60)]}{phrase}{said[rng.randrange(60)]}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def removed(**options):
        out = {}
        for r in suffixes.find_repeats(docs, **options).collect():
            out[r.row] = {b for s in r.spans for b in range(s.start, s.end)}
        return out

    assert suffixes._heavy(spark.createDataFrame([(1, b"x" * 60), (1, b"y" * 60), (2, b"z" * 60)], "anchor bigint, said binary"), 100).collect() == [(1,)]
    assert suffixes._heavy(spark.createDataFrame([(1, b"x" * 60)], "anchor bigint, said binary"), 100) is None
    want = removed()
    assert want and removed(heavy_bytes=200) == want and removed(heavy_bytes=0) == want


def test_suffix_steps_work_on_many_texts_at_once(monkeypatch):
    """Python calls of the steps don't grow with the texts, and chunks of any size give the same."""
    rng = random.Random(6)
    said = ["".join(rng.choice("abcdé ") for _ in range(90)).encode() for _ in range(40)]

    def steps(n):
        texts = [None, b"", b"short"] + [b"".join(rng.choice(said) + bytes([97 + k % 26]) for _ in range(5)) for k in range(n)]
        rows = pa.array(range(len(texts)))
        calls = Counter()

        def counted(step, parts):
            sys.setprofile(lambda frame, event, arg: calls.update([step.__name__] if event == "call" else []))
            try:
                return list(step(parts, 50))
            finally:
                sys.setprofile(None)

        def packets(parts, length):
            return suffixes._packets(parts, 1, length)

        counted(packets, [pa.RecordBatch.from_arrays([rows, pa.array(texts, pa.binary())], names=["row", "text"])])
        hashes = [suffixes.anchors(t).astype(np.int64).tolist() for t in texts]
        batch = pa.RecordBatch.from_arrays([rows, rows, pa.array(texts, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))], names=["row", "id", "text", "hashes"])
        found = [r for b in counted(suffixes._stretches, [batch]) for r in b.to_pylist()]
        assert all(texts[r["row"]] for r in found if r["said"] is None)
        held = {}
        for r in found:
            if r["said"] is not None:
                one = held.setdefault((r["anchor"], r["name"]), [r["said"], r["least"], r["most"]])
                assert one[0] == r["said"]
                one[1:] = min(one[1], r["least"]), max(one[2], r["most"])
        stretches = sorted((*k, *v) for k, v in held.items())
        names = ["anchor", "name", "said", "least", "most"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        parts = [
            pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*stretches[a : a + 50], strict=True), kinds, strict=True)], names=names)
            for a in range(0, len(stretches), 50)
        ]
        ranges = {(r["anchor"], r["name"]): [] for b in counted(suffixes._shards, parts) for r in b.to_pylist()}
        for b in suffixes._shards(parts, 50):
            for r in b.to_pylist():
                ranges[r["anchor"], r["name"]].append((r["first"], r["last"], r["least_id"]))
        gone = {}
        for r in found:
            for a, b, least in ranges.get((r["anchor"], r["name"]), ()) if r["said"] is None else ():
                if least < r["id"]:
                    gone.setdefault(r["row"], set()).update(range(r["at"] + a, r["at"] + b + 50))
        first, want = {}, {}
        for k, text in enumerate(texts):
            for at in range(len(text or b"") - 49):
                if first.setdefault(text[at : at + 50], k) < k:
                    want.setdefault(k, set()).update(range(at, at + 50))
        assert gone == want and want
        return calls

    few, many = steps(60), steps(600)
    assert many["packets"] < 2 * few["packets"] and many["_stretches"] < 2 * few["_stretches"]
    for setting, value in (("CHUNK_BYTES", 700), ("CHUNK_TEXTS", 7), ("SHARD_ROWS", 60), ("SHARD_BYTES", 2000)):
        monkeypatch.setattr(suffixes, setting, value)
        steps(60)


def test_repeats_of_fewer_bytes_than_an_anchor(spark):
    rows = [(1, "abcdefghijkl one"), (2, "two abcdefghij-"), (3, None), (4, "abcdefghi"), (5, "zabcdefghijk")]
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), length=10).collect()
    assert {r.doc_id: bytes(r.kept) for r in out} == {1: b"abcdefghijkl one", 2: b"two -", 3: b"", 4: b"abcdefghi", 5: b"z"}
    assert {r.doc_id: r.n_bytes for r in out} == {1: 16, 2: 15, 3: 0, 4: 9, 5: 12}
    assert [tuple(s) for r in out if r.doc_id == 5 for s in r.removed] == [(1, 12)]


def test_line_edits_at_every_window(spark):
    """Every kind of edit, at ends, at window borders and between, in lines of many lengths, is found."""
    rng = random.Random(5)
    rows, edited = [], 0
    for n in (16, 17, 31, 32, 33, 63, 64, 65, 127, 128, 257, 1000, 4097):
        for at in sorted({0, 1, n // 2 - 1, n // 2, n - 2, n - 1, *(rng.randrange(n) for _ in range(3)), *(x for x in (31, 32, 64, 96) if x < n)}):
            base = "".join(rng.choice("abcdé漢 xyz") for _ in range(n - 1)) + "q"
            for text in (base[:at] + "#" + base[at + 1 :], base[:at] + "#" + base[at:], base[:at] + base[at + 1 :]):
                # A base of its own for each edit, so edits don't meet each other.
                own = f"{edited:06d}"
                rows += [(edited, own + base), (100000 + edited, own + text)]
                edited += 1
    found = lines.find_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.id for r in found} >= {100000 + k for k in range(edited)}
    assert all(r.kind == "edit" for r in found)


def test_near_classes_against_brute_force(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    sets = [minhash.shingles(t.encode()) for _, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (x, (i, s)), (y, (j, t)) in itertools.combinations(enumerate(rows), 2):
        if s == t or minhash.similarity(sets[x], sets[y]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    got = {r.doc_id: r.class_id for r in queries.op10_near_dedup(spark, SF).collect()}
    assert got == {i: find(i) for i, _ in rows}
    out = minhash.near_classes(odd).collect()
    assert {r.id: r.class_id for r in out if r.id in (1, 2, 3)} == {1: 1, 2: 1, 3: 1 if minhash.similarity(*(minhash.shingles(ODD[k][1].encode()) for k in (0, 3))) >= 0.8 else 3}
    left = minhash.remove_near(odd)
    assert left.columns == odd.columns and left.filter("doc_id = 2").count() == 0 and minhash.near_classes(none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    docs = read(spark, "documents")
    kept = {r.doc_id for r in queries.op8_quality(spark, SF).filter("kept").collect()}
    leaked = {r.doc_id for r in queries.op7_decontamination(spark, SF).filter("contaminated").collect()}
    ids = {r.doc_id for r in rows}
    assert ids and ids <= kept - leaked
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len({texts[i] for i in ids}) == len(ids)
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_anchors_of_long_texts_and_parts_in_pieces(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdé ") for _ in range(4000)).encode()
    starts = np.arange(0, len(text) - 80, 64)
    want, names = suffixes.anchors(text), suffixes._names(text, starts, starts + 80)
    assert len(want) == len(text) - 49
    assert [len(suffixes.anchors(t)) for t in (None, b"", b"a" * 49, b"a" * 50)] == [0, 0, 0, 1]
    for size in (50, 64, 333):
        monkeypatch.setattr(suffixes, "PIECE", size)
        assert (suffixes.anchors(text) == want).all()
        assert (suffixes._names(text, starts, starts + 80) == names).all()
    # Anchors met range by range are those that more than one row has, and no others.
    rows = {k: np.unique(np.append(rng.sample(range(1 << 48), 300), [7, (1 << 48) - 1 - k // 2, 1 << 40])) for k in range(9)}
    count = Counter(h for held in rows.values() for h in held.tolist())
    cut = {k: np.sort(v.astype(np.uint64)) for k, v in rows.items()}
    for n_parts in (1, 3):
        part_of = {k: ((v >> np.uint64(16)) * np.uint64(n_parts) >> np.uint64(32)).astype(int) for k, v in cut.items()}
        batches = []
        for part in range(n_parts):
            for k, v in cut.items():
                here = v[part_of[k] == part]
                one = [part], [False], [np.array([k]).tobytes()], [suffixes._planes(here * np.uint64(0), 3)], [suffixes._planes(here, 6)]
                batches.append(pa.RecordBatch.from_arrays([pa.array(c) for c in one], names=["part", "known", "rows", "places", "hashes"]))
        got = [(r["row"], h) for b in suffixes._answers(batches, n_parts) for r in b.to_pylist() for h in r["hashes"]]
        assert sorted(got) == sorted((k, h) for k, v in cut.items() for h in v.tolist() if count[h] > 1)
