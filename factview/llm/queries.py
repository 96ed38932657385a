"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factview.llm import byte_bpe, decontaminate, line_dedup, ngram_join, pii, quality_rank, quality_rules, secret_scan, sharding, token_counts
from factview.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
#: Rows of an Arrow batch: bounds a Python worker's memory on long texts.
ARROW_ROWS = "1000"
ARROW_BYTES = str(16 << 20)


def batched(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched(spark)
    return ngram_join.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id")).select("doc_id", "shard_slot", "shard")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.with_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.deduplicate(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op8_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = quality_rank.train(docs, table(spark, sf_dir, "labels"))
    return quality_rank.scored(docs, ranking).select("doc_id", "held_out", "score", "predicted")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = byte_bpe.with_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judge(docs, texts=False).select("doc_id", *quality_rules.ADDED)


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_ngram_join": op2_ngram_join,
        "op3_pii": op3_pii,
        "op4_secret_scan": op4_secret_scan,
        "op5_sharding": op5_sharding,
        "op6_token_counts": op6_token_counts,
        "op7_line_dedup": op7_line_dedup,
        "op8_quality_rank": op8_quality_rank,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_quality_rules": op10_quality_rules,
    }


#: The words of a text in DuckDB, given a text expression.
WORDS_SQL = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_GRAMS = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"
_SETS = f"CASE WHEN len(w) >= 5 THEN {_GRAMS} ELSE [array_to_string(w, ' ')] END"
OP1_SQL = f"""
    WITH i AS (SELECT item_id, {WORDS_SQL.format("lower(coalesce(text, ''))")} AS w FROM benchmark),
    g AS (SELECT item_id, len(w) AS n, list_distinct({_SETS}) AS g FROM i WHERE len(w) > 0),
    e AS (SELECT item_id, n, unnest(g) AS s FROM g),
    wt AS (SELECT s, 1.0::DOUBLE / count(*) AS weight FROM e GROUP BY s),
    t AS (SELECT item_id, sum(weight) AS total FROM e JOIN wt USING (s) GROUP BY item_id),
    d AS (SELECT doc_id, {WORDS_SQL.format("lower(coalesce(text, ''))")} AS w FROM documents),
    h AS (SELECT doc_id, {_SETS} AS h FROM d WHERE len(w) > 0),
    p AS (SELECT doc_id, unnest(h) AS s, generate_subscripts(h, 1) - 1 AS p FROM h),
    a AS (SELECT DISTINCT doc_id, item_id, n, p FROM p JOIN e USING (s)),
    st AS (
        SELECT DISTINCT doc_id, item_id, a.n, unnest(range(greatest(p - a.n + least(a.n, 5), 0), least(p, greatest(len(h) + 4 - a.n, 0)) + 1)) AS st
        FROM a JOIN h USING (doc_id)
    ),
    v AS (SELECT doc_id, item_id, st, list_distinct(h[st + 1:st + greatest(st.n - 4, 1)]) AS v, g FROM st JOIN h USING (doc_id) JOIN g USING (item_id)),
    x AS (SELECT doc_id, item_id, st, len(v) AS nv, unnest(list_intersect(v, g)) AS s FROM v),
    y AS (SELECT doc_id, item_id, st, nv, count(*) AS k, sum(weight) AS inside FROM x JOIN wt USING (s) GROUP BY ALL),
    z AS (SELECT doc_id, item_id, st, inside / (total + nv - k) AS similarity FROM y JOIN t USING (item_id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, st) AS rn FROM z WHERE similarity >= 0.75 - 1e-9)
    SELECT doc_id, item_id, similarity, CAST(st AS INTEGER) AS first_word FROM r WHERE rn = 1
"""

OP2_SQL = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS w FROM documents),
    s AS (
        SELECT doc_id, CASE
            WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
        FROM w
    ),
    e AS (SELECT doc_id, unnest(g) AS t FROM s),
    n AS (SELECT doc_id, len(g) AS n FROM s),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
    SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.y) AS component_id FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.n
"""


def _js_sql(x: str, y: str, n: int) -> str:
    """The rounded Jensen-Shannon distance of two lists of n counts."""
    p, q = (f"({c}[i] / list_sum({c})::DOUBLE)" for c in (x, y))
    part = lambda a: f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({p} + {q}) / 2)) ELSE 0 END"
    total = f"list_sum(list_transform(range(1, {n + 1}), lambda i: {part(p)} + {part(q)}))"
    return f"CASE WHEN n >= {quality_rules.MIN_WORDS} AND list_sum({x}) > 0 AND list_sum({y}) > 0 THEN round(sqrt(greatest({total} / 2, 0)), 9) ELSE 0 END"


def op10_sql() -> str:
    rules, listed = quality_rules, quality_rules.COMMON_WORDS
    quoted = lambda some: ", ".join("'" + x + "'" for x in some)
    classes = {k: v.replace("'", "''") for k, v in rules.CHARACTER_CLASSES.items()}
    columns = ", ".join(f"len(regexp_replace(t, '[^{v}]', '', 'g')) AS c_{k}" for k, v in classes.items())
    named = " ".join(f"WHEN '{k}' THEN list_transform([{quoted(v)}], lambda x: len(list_filter(w, lambda y: lower(y) = x)))" for k, v in listed.items())
    n_classes, n_words = len(classes) + 2, max(map(len, listed.values())) + 1
    near = lambda c, limit: f"{c} <= {limit[0]} + {limit[1]} / sqrt(greatest(n, 1))"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({quoted(listed)}) THEN lang ELSE 'other' END AS l, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
    c AS (
        SELECT *, len(w) AS n, len(array_to_string(w, '')) AS wc, {columns}, CASE l {named} END AS named,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM d
    ),
    h AS (
        SELECT id, doc_id, l, n, wc, c_symbol, len(lines) - len(list_distinct(lines)) AS dup,
            [len(t) - wc, {", ".join(f"c_{k}" for k in classes)}, wc - {" - ".join(f"c_{k}" for k in classes)}] AS cls, list_concat(named, [n - list_sum(named)]) AS com
        FROM c
    ),
    win AS (SELECT id, unnest(list_transform(range(1, n - {rules.WINDOW} + 2), lambda i: array_to_string(w[i:i + {rules.WINDOW - 1}], ' '))) AS x, unnest(range(1, n - {rules.WINDOW} + 2)) AS i FROM c),
    again AS (SELECT id, i, count(*) OVER (PARTITION BY id, x) AS k FROM win),
    cover AS (SELECT id, count(DISTINCT spot) AS repeated FROM (SELECT id, unnest(range(i, i + {rules.WINDOW})) AS spot FROM again WHERE k > 1) GROUP BY id),
    rc AS (SELECT l, list(s ORDER BY i) AS rcls FROM (SELECT l, i, sum(cls[i]) AS s FROM h, range(1, {n_classes + 1}) x(i) WHERE n >= {rules.MIN_WORDS} GROUP BY l, i) GROUP BY l),
    rw AS (SELECT l, list(s ORDER BY i) AS rcom FROM (SELECT l, i, sum(com[i]) AS s FROM h, range(1, {n_words + 1}) x(i) WHERE n >= {rules.MIN_WORDS} AND com IS NOT NULL GROUP BY l, i) GROUP BY l),
    j AS (
        SELECT doc_id, n, wc, c_symbol, dup, coalesce(repeated, 0) AS repeated, {_js_sql("cls", "rcls", n_classes)} AS jc, {_js_sql("com", "rcom", n_words)} AS jw,
            n < {rules.MIN_RULE_WORDS} OR 100 * coalesce(repeated, 0) > {rules.MAX_REPEAT_PERCENT} * n AS failed
        FROM h LEFT JOIN rc USING (l) LEFT JOIN rw USING (l) LEFT JOIN cover USING (id)
    )
    SELECT doc_id, n AS n_words, CAST(wc AS BIGINT) AS word_chars, CAST(c_symbol AS BIGINT) AS n_symbols, CAST(dup AS BIGINT) AS n_dup_lines, CAST(repeated AS BIGINT) AS n_repeat_words,
        CAST(jc AS DOUBLE) AS js_characters, CAST(jw AS DOUBLE) AS js_words, failed AS base_failed,
        NOT failed AND {near("jc", rules.MAX_CHARACTER_DISTANCE)} AND {near("jw", rules.MAX_WORD_DISTANCE)} AS kept
    FROM j
    """


def oracle_sql() -> dict[str, str]:
    names = [f"shard-{k:05d}" for k in range(sharding.SHARDS)]
    owner = ", ".join(map(str, sharding.lookup_table(names)))
    return {
        "op1_decontamination": OP1_SQL,
        "op2_ngram_join": OP2_SQL,
        "op10_quality_rules": op10_sql(),
        "op5_sharding": f"""
            WITH s AS (
                SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE} AS shard_slot
                FROM documents
            )
            SELECT doc_id, shard_slot, CAST(list_extract([{owner}], CAST(shard_slot AS INTEGER) + 1) AS INTEGER) AS shard FROM s
        """,
    }
