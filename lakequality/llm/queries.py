"""One query for each operator of this package, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequality.llm import (
    chat,
    codes,
    decontaminate,
    host_rules,
    lines,
    minhash,
    mixing,
    pages,
    phrases,
    ranking,
    sharding,
    suffixes,
    token_counts,
)
from lakequality.llm.tables import maybe_in, read
from lakequality.session import work_dir

N_SHARDS = 8
# Target shares of tokens. A twentieth of all documents is labelled toxic without a word that tells,
# so a smaller share than this could only be met by dropping clean documents.
MIX = {"good": 0.875, "junk": 0.085, "toxic": 0.04}
EXTRA_TURN = "<|im_end|><|im_start|>assistant ok"


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "junk").alias("domain"),
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), MIX).select(
        "doc_id", "n_tokens", "domain",
        *(F.get("posteriors", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(MIX)),
        "rate", "copies",
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TURN).alias("text"),
    )
    return chat.digests(chat.format_chats(turns.unionByName(extra)))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeats(docs)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, take the toxic ones down, revise the poor ones, and deliver the load twice."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    ledger = token_counts.Ledger(spark, work_dir(spark, "token-ledger"))
    counters = {"byte_bpe_50k": token_counts.BytePairs(spark), "words": token_counts.Words()}
    ledger.commit("load", docs, counters, F.lit("insert"))
    toxic = labels.filter("toxic = 1").select("doc_id")
    gone = docs.select("doc_id", "source", "lang", F.lit(None).cast("string").alias("text")).join(toxic, "doc_id", "left_semi")
    ledger.commit("takedown", gone, counters, F.lit("delete"))
    poor = labels.filter("quality = 0 AND toxic = 0").select("doc_id")
    maybe = maybe_in(docs, F.xxhash64("doc_id"), poor.select(F.xxhash64("doc_id").alias("h")))
    revised = maybe.join(poor, "doc_id", "left_semi").withColumn("text", F.regexp_replace("text", "[#*$%&|<>]+", ""))
    ledger.commit("revision", revised, counters, F.lit("revise"))
    ledger.commit("load", docs, counters, F.lit("insert"))
    return ledger.totals()


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"], cleaned=False
    )
    return decontaminate.digests(found)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *host_rules.FEATURES, "base_failed", "kept")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.remove_repeats(read(spark, sf_dir, "documents"), keep=["doc_id"]))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "class_size", "keep"
    )


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(read(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"), codes.code_text(F.col("codes")).alias("code"), "error", "label_error",
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"),
    )


def op13_phrase_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.compare_neighbours(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        *(F.lower(F.hex(name)).alias(name) for name in ("fingerprint", "edited_fingerprint")),
        "near_edited", "near_next",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_chat, op3_sharding, op4_line_dedup, op5_token_counts,
        op6_html_text, op7_decontamination, op8_quality, op9_suffix_dedup, op10_near_dedup,
        op11_search, op12_vector_codes, op13_phrase_prints,
    )
}

_SOLID = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{EXTRA_TURN}'
  UNION ALL SELECT -1, 1, 'assistant', '{EXTRA_TURN}'
),
written AS (
  SELECT *, regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\\\1|\2|>', 'g') AS shown FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(shown) + {len(chat.START) + 1 + len(chat.END)})::BIGINT AS formatted_chars,
       count(*) FILTER (shown <> text) AS n_escaped
FROM written GROUP BY conv_id
"""

_LINES_SQL = rf"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS said,
         generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents
),
solid AS (SELECT * FROM split WHERE regexp_matches(said, '{_SOLID}')),
contents AS (
  SELECT said, length(said) AS n, min(struct_pack(d := doc_id, l := line)) AS spot FROM solid GROUP BY said
),
sides AS (
  SELECT said, n, spot, m, unnest([left(said, m // 2), right(said, m - m // 2)]) AS side, unnest([0, 1]) AS which
  FROM (SELECT *, unnest([n, n - 1]) AS m FROM contents WHERE n >= {lines.MIN_EDIT_CHARS})
),
pairs AS (
  SELECT DISTINCT b.said, b.n, a.said AS other, a.n AS m
  FROM sides a JOIN sides b USING (m, side, which) WHERE a.spot < b.spot AND abs(a.n - b.n) <= 1
),
headed AS (
  SELECT *, len(list_filter(range(1, least(n, m) + 1), lambda i: left(said, i) = left(other, i))) AS head FROM pairs
),
near AS (
  SELECT DISTINCT said FROM headed
  WHERE CASE WHEN n = m THEN right(said, n - head - 1) = right(other, m - head - 1)
             WHEN n > m THEN right(said, n - head - 1) = right(other, m - head)
             ELSE right(said, n - head) = right(other, m - head - 1) END
),
marked AS (
  SELECT s.*, regexp_matches(s.said, '{_SOLID}') AND c.spot < struct_pack(d := s.doc_id, l := s.line) AS equal,
         near.said IS NOT NULL AS edit
  FROM split s LEFT JOIN contents c USING (said) LEFT JOIN near USING (said)
),
counted AS (
  SELECT doc_id, count(*) AS n_lines,
         count(*) FILTER (coalesce(equal, false)) AS n_equal,
         count(*) FILTER (edit AND NOT coalesce(equal, false)) AS n_edit,
         coalesce(string_agg(said, chr(10) ORDER BY line) FILTER (NOT coalesce(equal, false) AND NOT edit), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT doc_id, CASE WHEN documents.text IS NOT NULL THEN counted.text END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_edit, 0) AS n_edit
FROM documents LEFT JOIN counted USING (doc_id)
"""

_LEAKS_SQL = rf"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_ALNUM}') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_ALNUM}') AS w
  FROM benchmark
),
sized AS (SELECT item_id, w, least(len(w), {decontaminate.NGRAM}) AS n FROM items WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item_id::VARCHAR AS item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM said, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)
),
hits AS (SELECT DISTINCT doc_id, i, n, item_id FROM windows JOIN grams USING (n, gram)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM said LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def _quality_sql() -> str:
    rules = host_rules.RULES
    flags = ", ".join(f"coalesce({rule}, false) AS b_{name}" for name, rule in rules.items())
    counts = ", ".join(f"count(*) FILTER (b_{name}) AS f_{name}" for name in rules)
    prior = ", ".join(f"avg(f_{r} / n) AS m_{r}, var_pop(f_{r} / n) AS v_{r}" for r in rules)
    strength = ", ".join(
        f"CASE WHEN v_{r} > 0 THEN least(10000, greatest(1, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE 10000 END AS s_{r}" for r in rules
    )
    broken = ", ".join(f"(f_{r} + m_{r} * s_{r}) / (n + s_{r}) > 0.5 AS h_{r}" for r in rules)
    both = " OR ".join(f"(b_{r} AND h_{r})" for r in rules)
    return rf"""
WITH said AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SOLID}') AS w FROM documents
),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c
  FROM (SELECT doc_id, i, w[i : i + 2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM said WHERE len(w) > 2))
),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE c > 1) GROUP BY doc_id
),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM said) WHERE regexp_matches(line, '{_SOLID}') GROUP BY doc_id
),
features AS (
  SELECT said.doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM said LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id)
),
flagged AS (SELECT *, {flags} FROM features),
hosts AS (SELECT source, count(*) AS n, {counts} FROM flagged GROUP BY source),
prior AS (SELECT *, {strength} FROM (SELECT {prior} FROM hosts)),
verdicts AS (SELECT source, {broken} FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({host_rules.BASE_FAILED}) AS base_failed, NOT ({host_rules.BASE_FAILED}) AND NOT ({both}) AS kept
FROM flagged JOIN verdicts ON flagged.source IS NOT DISTINCT FROM verdicts.source
"""

_SEARCH_SQL = rf"""
WITH said AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, '{ranking.UPPER}', '{ranking.LOWER}'), '{ranking.TERM}') AS w
  FROM documents WHERE text IS NOT NULL
),
sizes AS (SELECT r, doc_id, len(w) AS n FROM said WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM said) GROUP BY ALL),
asked AS (
  SELECT i, item_id, term, count(*) AS repeats
  FROM (SELECT row_number() OVER () AS i, item_id,
               unnest(regexp_extract_all(translate(text, '{ranking.UPPER}', '{ranking.LOWER}'), '{ranking.TERM}')) AS term
        FROM benchmark) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
norms AS (SELECT r, doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM sizes, totals),
scored AS (
  SELECT i, item_id, r, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (r) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {ranking.TOP}
"""


def _codes_sql() -> str:
    apart = "list_sum(list_transform(list_zip(parts.v, books.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = []
    for k in range(codes.ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, parts.p, any_value(parts.v) AS v, min(struct_pack(d := {apart}, e := e)) AS best
  FROM parts JOIN books{k} AS books USING (p) GROUP BY r, parts.p
)""")
        if k < codes.ROUNDS:
            steps.append(f"""
sums{k} AS (
  SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT p, best.e AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{k}) GROUP BY ALL
),
moved{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums{k} GROUP BY p, e),
books{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM books{k} b LEFT JOIN moved{k} m USING (p, e)
)""")
    last = codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // {codes.N_PARTS} + 1 : (p + 1) * len(v) // {codes.N_PARTS}] AS v
  FROM kept, range({codes.N_PARTS}) AS of(p)
),
books0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {codes.N_ENTRIES}),{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{last} GROUP BY r
),
digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM books{last})
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


ORACLES = {
    "op2_chat": _CHAT_SQL.strip(),
    "op4_line_dedup": _LINES_SQL.strip(),
    "op7_decontamination": _LEAKS_SQL.strip(),
    "op8_quality": _quality_sql().strip(),
    "op11_search": _SEARCH_SQL.strip(),
    "op12_vector_codes": _codes_sql().strip(),
}
