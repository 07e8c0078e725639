"""Loads with manifests, rules on groups, and masks at any depth."""

import os
import re

import pytest
from pyspark.sql import functions as F

from lakequality.functions import privacy
from lakequality.operators import loads, packs, quality, sinks
from lakequality.operators.rules import WARN, GroupRule, Rule, RuleSet, rule_from_config, unique
from lakequality.session import work_dir


# Loads


def part(spark, first, last):
    site = F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b:%"), (F.col("id") % 3).cast("string")))
    return spark.range(first, last).select("id", site.alias("site"))


def told(manifest):
    return {(r.load_id, r.site): (r.n, r.files) for r in manifest.collect()}


def test_every_load_reports_what_it_wrote(spark):
    path = work_dir(spark, "table")
    first = told(loads.write_load(part(spark, 0, 30).coalesce(1), path, "one", ["site"]))
    assert first == {("one", site): (10, 1) for site in (None, "a b:%1", "a b:%2")}
    second = told(loads.write_load(part(spark, 30, 36).coalesce(1), path, "two", ["site"]))
    assert second == {("two", site): (2, 1) for site in (None, "a b:%1", "a b:%2")}
    # Delivered again, with other rows even: nothing is written, the manifest is that of the load.
    assert told(loads.write_load(part(spark, 0, 99), path, "one", ["site"])) == first
    table = spark.read.parquet(path)
    assert sorted(r.id for r in table.collect()) == list(range(36)) and table.columns == ["id", "site"]
    assert {r.site for r in table.collect()} == {None, "a b:%1", "a b:%2"}
    files = {r.f.rsplit("/", 1)[1] for r in table.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    listed = loads.manifest_files(spark, path, "one").unionByName(loads.manifest_files(spark, path, "two"))
    assert files == {r.file.rsplit("/", 1)[1] for r in listed.collect()}
    assert all(r.bytes > 0 for r in listed.collect())
    assert loads.write_load(part(spark, 0, 0), path, "none", ["site"]).count() == 0
    assert {r.load_id: r.state for r in loads.loads(spark, path).collect()} == {"one": "finished", "two": "finished", "none": "finished"}
    loads.write_load(part(spark, 0, 25), path + "-flat", "one", [], max_records_per_file=5)
    assert loads.manifest(spark, path + "-flat", "one").first().n == 25 and spark.read.parquet(path + "-flat").count() == 25
    assert loads.loads(spark, work_dir(spark, "nothing")).count() == 0
    with pytest.raises(ValueError, match="load id"):
        loads.write_load(part(spark, 0, 1), path, "../x", ["site"])


def test_a_broken_load_is_finished_not_repeated(spark, monkeypatch):
    path, rows = work_dir(spark, "table"), part(spark, 0, 30).repartition(4, "id")
    real = loads.publish
    # Broken before the manifest: the load starts anew.
    os.makedirs(f"{path}/_loads/one/staged/site=x")
    monkeypatch.setattr(loads, "publish", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        loads.write_load(rows, path, "one", ["site"])
    assert {r.load_id: r.state for r in loads.loads(spark, path).collect()} == {"one": "staged"}
    # Broken between moves: some files are in the table.
    listed = [r.file for r in loads.manifest_files(spark, path, "one").collect()]
    assert len(listed) > 3
    from urllib.parse import unquote

    for name in listed[:2]:
        plain = unquote(name)
        os.makedirs(os.path.dirname(f"{path}/{plain}"), exist_ok=True)
        os.rename(f"{path}/_loads/one/staged/{plain}", f"{path}/{plain}")
    monkeypatch.setattr(loads, "publish", real)
    again = loads.write_load(spark.range(5).select("id", F.lit("other").alias("site")), path, "one", ["site"])
    assert again.agg(F.sum("n")).first()[0] == 30
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(30))
    assert real(spark, path, "one") == 0
    os.remove(f"{path}/{unquote(listed[0])}")
    with pytest.raises(FileNotFoundError):
        real(spark, path, "one")


# Rules on groups


def test_group_rules_stand_beside_row_rules(spark):
    rows = [(1, "a", "x", 5.0), (2, "a", "x", -1.0), (3, "a", "y", 5.0), (4, None, "x", 5.0), (5, None, "x", 5.0), (6, "b", None, 50.0), (7, "b", None, None)]
    df = spark.createDataFrame(rows, "id int, `k.1` string, s string, broken_groups_0 double")
    rules = RuleSet(
        (
            Rule("positive", "broken_groups_0 > 0"),
            unique("k.1", "s", name="pairs"),
            unique("k.1", name="loose", criticality=WARN, category="low", on_null="pass"),
            GroupRule("mean", F.avg("broken_groups_0") < 10, WARN, "high", "mean too high", keys="s"),
            GroupRule("unsure", "max(CAST(NULL AS INT)) > 0", WARN, "low", keys=("s",), on_null="pass"),
        )
    )
    checked = quality.validate(df, rules)
    got = {r.id: r for r in checked.collect()}
    assert checked.columns[:4] == df.columns and len(checked.columns) == 4 + 9 and len(got) == 7
    broken = {i: [] if r.rule_results == ["All rules passed"] else r.rule_results for i, r in got.items()}
    assert broken == {
        1: ["pairs", "loose"], 2: ["positive", "pairs", "loose"], 3: ["loose"], 4: ["pairs"], 5: ["pairs"],
        6: ["pairs", "loose", "mean"], 7: ["positive", "pairs", "loose", "mean"],
    }
    assert got[6].failure_reason == "k.1, s not unique; k.1 not unique; mean too high" and got[3].quality_flag == "WARNING"
    counts = {r.rule: r.failed for r in quality.rule_failures(df, rules).collect()}
    assert counts == {"positive": 2, "pairs": 6, "loose": 5, "mean": 2, "unsure": 0}
    flags = quality.rule_flags(df, rules, ["id"]).collect()
    assert {r.id: [n for n in counts if not r[n]] for r in flags} == broken
    good, bad = sinks.write_split(df, rules, work_dir(spark, "split"))
    assert good.count() == 0 and bad.count() == 7
    assert quality.validate(df.limit(0), rules).count() == 0
    with pytest.raises(TypeError, match="groups"):
        unique("id").passed()
    with pytest.raises(ValueError, match="keys"):
        GroupRule("none", "count(1) = 1")
    assert rule_from_config({"name": "u", "check": "count(1) = 1", "keys": ["id"]}) == unique("id", name="u", message=None)
    with pytest.raises(ValueError, match="unknown"):
        rule_from_config({"name": "u", "check": "true", "key": "id"})
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="batches"):
        quality.validate(stream, RuleSet((unique("value"),)))


def test_group_rules_survive_a_hot_key(spark):
    df = spark.range(200000).select("id", F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), (F.col("id") % 3 > 0).alias("hot"))
    rules = RuleSet((unique("k"),))
    flags = quality.validate(df, rules).groupBy("hot", "quality_flag").count().collect()
    assert {(r.hot, r.quality_flag): r["count"] for r in flags} == {(True, "FAIL"): 133333, (False, "PASS"): 66667}
    # Only keys that break a rule meet the rows: the hot key is one row there, and no window gathers it.
    plan = quality.validate(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("HashAggregate") >= 2
    assert len(packs.framework_rules_unique()) == 5


# Masks


def test_masks_reach_every_text(spark):
    kind = (
        "id int, note string, who struct<Email: string, phone: string, deep: struct<said: string, n: int>>, "
        "list array<struct<said: string>>, email array<string>, more map<string, string>, days map<string, array<string>>, keep string"
    )
    said = "mail bob.x@a.org, é4111 1111 1111 1234. call +1 (743) 555-3824 or 743-555-3824; card 4111111111111234x 4111-1111-1111-1234"
    want = "mail bo***@a.org, é****-****-****-1234. call ***-***-3824 or ***-***-3824; card 4111111111111234x ****-****-****-1234"
    row = (
        1, said, (("ann@b.org"), "0123 456789", (said, 3)), [(said,), (None,), None], ["carl@c.org", None],
        {"credit_card": "4111 1111 1111 9876", "note": said, "none": None}, {"d": [said, None]}, said,
    )
    df = spark.createDataFrame([row, (2, None, None, None, None, None, None, None)], kind)
    masked = privacy.mask_everywhere(df, skip=["keep"])
    assert masked.schema.simpleString() == df.schema.simpleString()
    got = {r.id: r for r in masked.collect()}
    one = got[1]
    assert one.note == want and one.keep == said
    assert (one.who.Email, one.who.phone, one.who.deep.said, one.who.deep.n) == ("an***@b.org", "***-***-6789", want, 3)
    assert [x and x.said for x in one["list"]] == [want, None, None] and one.email == ["ca***@c.org", None]
    assert one.more == {"credit_card": "****-****-****-9876", "note": want, "none": None} and one.days == {"d": [want, None]}
    assert [v for v in got[2] if v is not None] == [2]
    named = privacy.mask_everywhere(df.select("note"), fields={"note": "email"}).first()
    assert named.note == "ma***@a.org" + said.split("@a.org", 1)[1]
    with pytest.raises(ValueError, match="unknown masks"):
        privacy.mask_everywhere(df, fields={"note": "name"})


def test_masked_text_against_python(spark):
    texts = [
        "", "@", "a@b", "ab@c.d,cd@e.f", "x" * 200000 + "@y.z", "1234567812345678", "12345678123456789", "(555) 123-4567(555) 123-4567",
        "555-123-45678", "+49.555.123.4567", "a" * 300000, "1234 5678 1234 5678 1234 5678 1234 5678", "9" * 300000, "+" * 100000, "a@" * 50000,
    ]
    words = re.ASCII
    card = re.compile(r"(?<!\w)(?:[0-9]{4}[ -]?){3}([0-9]{4})(?!\w)", words)
    phone = re.compile(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|(?<!\w)[0-9]{3})[ .-][0-9]{3}[ .-]([0-9]{4})(?!\w)", words)
    mail = re.compile(r"(?<![a-zA-Z0-9._%+-])([a-zA-Z0-9._%+-]{1,2})[a-zA-Z0-9._%+-]*@([a-zA-Z0-9.-]+)")

    def mask(text):
        return mail.sub(r"\1***@\2", phone.sub(r"***-***-\1", card.sub(r"****-****-****-\1", text)))

    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.m for r in df.select("k", privacy.mask_text(F.col("t")).alias("m")).collect()}
    assert [got[k] for k in range(len(texts))] == [mask(t) for t in texts]
