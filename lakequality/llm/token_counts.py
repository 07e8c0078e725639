"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A ledger is a folder in shared storage with two tables, both in one folder for each batch:

* `entries`: signed rows (id, source, lang, version, docs, tokens) that the batch adds;
* `totals`: their sums by source, lang and version.

An insert adds a row. A delete adds the negative of what the ledger holds for the id. A revised
document adds both, so totals stay sums and never need a recount. A batch counts from the moment its
`totals` are complete: committing an id again does nothing, and a batch that broke off is written
anew by the next try, over its own folder.
"""

from __future__ import annotations

import base64
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequality.llm import words
from lakequality.llm.tables import add_columns, col

KEYS = ("source", "lang", "version")
BPE_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed pattern that the public byte-level vocabularies were made with.
BPE_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


class BytePairs:
    """Counts byte-pair tokens; the vocabulary is read where the job starts and sent to the tasks."""

    def __init__(self, spark: SparkSession, path: str = BPE_FILE, pattern: str = BPE_PATTERN):
        with open(path, "rb") as file:
            self.file = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def count(self, texts: list[str]) -> list[int]:
        import tiktoken

        made = _encoders.get(self.pattern)
        if made is None:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.file.value.splitlines())}
            made = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            _encoders[self.pattern] = made
        return [len(made.encode_ordinary(t)) for t in texts]


class Words:
    """Counts runs of anything but blanks."""

    def count(self, texts: list[str]) -> list[int]:
        return [len(words.spans(words.as_bytes(t), words.SOLID)[0]) for t in texts]


_encoders: dict = {}


def count_tokens(docs: DataFrame, counters: Mapping[str, object], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for each document and tokenizer version, with `version` and `tokens`.

    Null texts have no tokens. Whole texts are counted, whatever their length.
    """

    def compute(column):
        texts = [t or "" for t in column.to_pylist()]
        each = [counter.count(texts) for counter in counters.values()]
        return ([list(row) for row in zip(*each, strict=True)] if texts else [],)

    counted = add_columns(docs, "tokens array<bigint>", [text_col], compute, keep)
    names = F.array(*(F.lit(v) for v in counters))
    pairs = F.arrays_zip(names.alias("version"), F.col("tokens").alias("tokens"))
    rest = [c for c in counted.columns if c != "tokens"]
    return counted.select(*(col(c) for c in rest), F.inline(pairs)).toDF(*rest, "version", "tokens")


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, table: str, batch: str) -> str:
        return f"{self.path}/{table}/batch={batch}"

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def committed(self, batch: str) -> bool:
        return self._exists(f"{self._folder('totals', batch)}/_SUCCESS")

    def batches(self) -> list[str]:
        """Ids of the batches committed so far: one short folder name for each."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals")
        system = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(at):
            return []
        names = [s.getPath().getName() for s in system.listStatus(at)]
        return sorted(n[6:] for n in names if n.startswith("batch=") and self.committed(n[6:]))

    def _read(self, table: str, schema: str) -> DataFrame:
        paths = [self._folder(table, b) for b in self.batches()]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def entries(self, id_type: str = "bigint") -> DataFrame:
        return self._read("entries", f"id {id_type}, source string, lang string, version string, docs bigint, tokens bigint")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and version, without groups that have neither."""
        rows = self._read("totals", "source string, lang string, version string, docs bigint, tokens bigint")
        return (
            rows.groupBy(*KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .filter("docs <> 0 OR tokens <> 0")
        )

    def commit(
        self,
        batch: str,
        changes: DataFrame,
        counters: Mapping[str, object],
        op: Column,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        lang_col: str = "lang",
    ) -> bool:
        """Write one batch of changes; false where it was committed before.

        `op` is "insert", "delete" or "revise" for each row; with any other word, or null, nothing is
        written and ValueError is raised. What a batch says of an id replaces what
        the ledger holds for it: an insert of a known id revises it, and a delete of an unknown one
        does nothing. Several inserted rows of one id in a batch all count. Null ids are one id like
        any other, null sources and languages are groups of their own, null texts have no tokens, an
        empty batch is committed and adds nothing, and other columns are not read.

        The only shuffles are the join of the batch's ids with the ledger, on narrow rows, and the
        sums, which are made map-side first.
        """
        if not batch or any(c in batch for c in "/=\\\n"):
            raise ValueError(f"{batch!r} can't name a batch")
        if self.committed(batch):
            return False
        id_type = changes.schema[id_col].dataType.simpleString()
        rows = changes.select(
            col(id_col).alias("id"),
            op.alias("op"),
            col(source_col).cast("string").alias("source"),
            col(lang_col).cast("string").alias("lang"),
            col(text_col).cast("string").alias("text"),
        )
        unknown = rows.filter("op IS NULL OR op NOT IN ('insert', 'delete', 'revise')").select("op").limit(1).collect()
        if unknown:
            raise ValueError(f"op is insert, delete or revise, not {unknown[0].op!r}")
        added = count_tokens(rows.filter("op <> 'delete'"), counters, "text", ["id", "source", "lang"])
        added = added.select("id", *KEYS, F.lit(1).cast("bigint").alias("docs"), "tokens")
        held = self.entries(id_type)
        named = rows.select("id").distinct().withColumnRenamed("id", "changed")
        removed = (
            held.join(named, F.col("id").eqNullSafe(F.col("changed")), "left_semi")
            .groupBy("id", *KEYS)
            .agg((-F.sum("docs")).alias("docs"), (-F.sum("tokens")).alias("tokens"))
            .filter("docs <> 0 OR tokens <> 0")
        )
        added.unionByName(removed).write.mode("overwrite").parquet(self._folder("entries", batch))
        written = self.spark.read.schema(added.schema).parquet(self._folder("entries", batch))
        written.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode(
            "overwrite"
        ).parquet(self._folder("totals", batch))
        return True
