"""The registered queries of the engine's own operators, each with SQL where SQL can say the same."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factview.functions.hashing import bucket
from factview.functions.names import column
from factview.operators import checks, normalize, verify
from factview.operators.writers import write_file
from factview.plans.manifest import Component, ContourDataset, load_manifest
from factview.plans.views import contour_plan, join_plan, template_plan, view_plan
from factview.sources import ArrowSource, resolve, statistics
from factview.store.export import export_parquet
from factview.store.publishing import materialize, publish_table
from factview.store.snapshot import open_store

Query = Callable[[SparkSession, str], DataFrame]

CHAIN = load_manifest(
    {
        "name": "order_regions",
        "components": [
            {"name": "orders", "kind": "fact", "primary_key": ["o_orderkey"]},
            {"name": "customer", "kind": "dimension", "primary_key": ["c_custkey"]},
            {"name": "nation", "kind": "dimension", "primary_key": ["n_nationkey"]},
            {"name": "region", "kind": "dimension", "primary_key": ["r_regionkey"]},
        ],
        "view": {
            "base": "orders",
            "joins": [
                {"component": "customer", "on": {"o_custkey": "c_custkey"}},
                {"component": "nation", "left": "customer", "on": {"c_nationkey": "n_nationkey"}},
                {"component": "region", "left": "nation", "on": {"n_regionkey": "r_regionkey"}},
            ],
            "select": ["o_orderkey", "o_totalprice", {"column": "c_name", "from": "customer", "as": "customer"}, {"column": "n_name", "as": "nation"}, {"column": "r_name", "as": "region"}],
        },
    }
)
SEGMENTS = ContourDataset(
    "supplier_segments",
    geometry_column="c_mktsegment",
    contour_table="segments",
    fact_join_columns=("s_nationkey",),
    contour_join_columns=("c_nationkey",),
    output_columns=("s_suppkey", "s_nationkey", "s_acctbal", "c_mktsegment"),
    contour_source="customer",
)
LINES = ContourDataset("lines", "l_comment_part", "parts", ("l_suppkey",), ("l_suppkey",), ("l_suppkey", "l_returnflag", "l_linestatus", "l_comment_part"))
LABELLED = load_manifest(
    {
        "name": "labelled",
        "components": [{"name": "documents", "kind": "fact"}, {"name": "labels", "kind": "dimension", "primary_key": ["doc_id"]}],
        "view_sql": {"default": "SELECT doc_id, lang, quality, '{kept}' AS note FROM {documents} JOIN {labels} USING (doc_id)".replace("{kept}", "{\"braces\": 1}")},
    }
)
TIES = """
    SELECT l_orderkey AS order_key, 'ALL' AS flag, l_quantity AS quantity FROM {lineitem} WHERE l_linenumber = 1
    UNION ALL
    SELECT order_key, flag, quantity FROM (
        SELECT l_orderkey AS order_key, l_returnflag AS flag, l_quantity AS quantity, row_number() OVER (
            PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice
        ) AS rn FROM {lineitem}
    ) ranked WHERE rn = 1
"""


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sources(sf_dir: str, *names: str) -> dict[str, str]:
    return {n: f"{sf_dir}/{n}.parquet" for n in names}


def _home_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").where("c_nationkey < 10")


def _store(spark: SparkSession):
    """A store of its own for one query, in the shared folder where one is named."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    local = base.removeprefix("file:") if base and (base.startswith("file:") or "://" not in base) else None
    if local is None and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a POSIX folder that the driver and all executors share")
    return open_store(spark, tempfile.mkdtemp(prefix="factview-store-", dir="/" + local.lstrip("/") if local else None))


def chain_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {n: _t(spark, sf_dir, n) for n in CHAIN.component_names()}
    return join_plan(CHAIN, frames)


def default_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = load_manifest({"name": "d", "components": [{"name": "nation", "kind": "fact"}, {"name": "region", "kind": "dimension", "primary_key": ["r_regionkey"]}], "view": {"base": "nation", "joins": [{"component": "region", "on": {"n_regionkey": "r_regionkey"}}]}})
    return join_plan(dataset, {n: _t(spark, sf_dir, n) for n in ("nation", "region")})


def compact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.compact(_t(spark, sf_dir, "lineitem"), LINES)


def contour_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.contours(_t(spark, sf_dir, "customer"), SEGMENTS)


def zone_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.zones(_t(spark, sf_dir, "customer"), SEGMENTS)


def keyed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.parts(_t(spark, sf_dir, "customer"), SEGMENTS)


def reconstruct_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, contour = _t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "customer")
    facts = facts.select("s_suppkey", "s_nationkey", "s_acctbal")
    return contour_plan(SEGMENTS, facts.distinct(), normalize.contours(contour, SEGMENTS))


def orphan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.orphans(_t(spark, sf_dir, "orders"), ["o_custkey"], _home_customers(spark, sf_dir), ["c_custkey"])
    return found.agg(F.count(F.lit(1)).alias("orphans"))


def null_key_is_orphan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(F.expr("nullif(o_custkey, 1)").alias("k"))
    return checks.orphans(orders, ["k"], _t(spark, sf_dir, "customer"), ["c_custkey"]).agg(F.count(F.lit(1)).alias("orphans"))


def dup_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.repeated_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).agg(F.count(F.lit(1)).alias("repeated"))


def null_pk_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "customer").select(F.expr("nullif(c_nationkey, 3)").alias("k"), "c_custkey")
    return checks.null_keys(rows, ["k", "c_custkey"]).agg(F.count(F.lit(1)).alias("nulls"))


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events")
    rows, nulls = statistics(events.select(F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type")))
    return spark.createDataFrame([(rows, nulls["user_id"], nulls["event_type"])], "n_rows long, user_id_nulls long, event_type_nulls long")


def left_join_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = load_manifest({"name": "d", "components": [{"name": "orders", "kind": "fact"}, {"name": "home", "kind": "dimension", "primary_key": ["c_custkey"]}], "view": {"base": "orders", "joins": [{"component": "home", "on": {"o_custkey": "c_custkey"}, "type": "left"}], "select": ["o_orderkey", {"column": "c_name", "from": "home", "as": "customer"}]}})
    return join_plan(dataset, {"orders": _t(spark, sf_dir, "orders"), "home": _home_customers(spark, sf_dir)})


def priority_tiebreak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_plan(spark, TIES, {"lineitem": _t(spark, sf_dir, "lineitem")})


def bridge_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    first = normalize.first_by_priority(bridge, ["l_orderkey", "p_brand"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return first.select("l_orderkey", "p_brand", "l_partkey", "l_quantity")


def view_sql_using_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_plan(spark, LABELLED, {n: _t(spark, sf_dir, n) for n in ("documents", "labels")})


def rank_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"), "o_orderkey")
    return normalize.first_by_priority(rows, ["o_custkey"], ["price", "o_orderkey"])


def portable_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment")), 1, 15), 16, 10).cast("decimal(38,0)")
    return _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(digest).cast("string").alias("checksum"))


def group_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("c_acctbal").cast("double")
    return _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.round(F.sum(x), 2).alias("total"), F.round(F.sum(F.abs(x)), 2).alias("size")
    )


def group_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _t(spark, sf_dir, "customer")
    a = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("a_rows"))
    b = customer.where("c_acctbal > 0 AND c_nationkey <> 4").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("b_rows"))
    return a.join(b, F.col("c_nationkey").eqNullSafe(F.col("k")), "full_outer").select(F.coalesce("c_nationkey", "k").alias("nation"), "a_rows", "b_rows")


def multiset_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag")
    return lines.exceptAll(lines.distinct()).groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("surplus"))


def union_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).union(_t(spark, sf_dir, "customer").select("c_nationkey")).distinct()


def key_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _t(spark, sf_dir, "customer").select(F.expr("nullif(c_nationkey, 7)").alias("k"), "c_acctbal")
    held = keys.where(F.col("k").isin(1, 2, 3) | F.col("k").isNull())
    return held.groupBy(F.coalesce(F.col("k").cast("string"), F.lit("none")).alias("k")).agg(F.count(F.lit(1)).alias("n_rows"))


def hash_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = F.col("o_orderkey") * -7919
    return _t(spark, sf_dir, "orders").groupBy(bucket(signed, 16).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


def content_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


def ordered_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.total_order(_t(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), ["s_name"]).limit(5)


def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.check_values(_t(spark, sf_dir, "lineitem"), {"quantity": "l_quantity < 25", "status": "l_linestatus = 'O'"})
    return spark.createDataFrame(sorted(found.items()), "rule string, failing long")


def arrow_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = _t(spark, sf_dir, "region").toArrow()
    return resolve(spark, ArrowSource("region", small)).select("r_regionkey", "r_name")


def equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    near = orders.withColumn("o_totalprice", F.col("o_totalprice") * (1 + 1e-13))
    far = orders.where("o_orderkey % 100 <> 0")
    rows = []
    for name, other in (("same", orders), ("near", near), ("far", far)):
        found = verify.compare_relations(orders, other)
        rows.append((name, found.reference_rows, found.view_rows, found.equivalent))
    return spark.createDataFrame(rows, "pair string, reference_rows long, view_rows long, equivalent boolean")


def keyed_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = orders.withColumn("o_orderstatus", F.when(F.col("o_custkey") % 50 == 0, F.lit("?")).otherwise(F.col("o_orderstatus")))
    found = verify.compare_keyed(orders, changed, key="o_custkey")
    return spark.createDataFrame([(found.original_rows, found.keys, found.mismatched_keys)], "n_rows long, n_keys long, mismatched long")


def published_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    materialize(store, CHAIN, _sources(sf_dir, *CHAIN.component_names()))
    return store.relation("order_regions")


def published_contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    wide = reconstruct_fanout(spark, sf_dir)
    dataset = ContourDataset(**{**SEGMENTS.__dict__, "keyed": True, "fact_source": "wide"})
    materialize(store, dataset, {"wide": wide, "customer": f"{sf_dir}/customer.parquet"})
    return store.relation("supplier_segments")


def published_table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    publish_table(store, "nations", f"{sf_dir}/nation.parquet")
    one = Component("n", "dimension", ("n_nationkey",), source_table="nations", columns=("n_nationkey", "n_name"))
    return normalize.component(resolve(spark, store.table_source("nations")), one)


def materialized_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    dataset = load_manifest({"name": "labelled", "components": [{"name": "documents", "kind": "fact"}, {"name": "labels", "kind": "dimension", "primary_key": ["doc_id"]}], "view_sql": "SELECT doc_id, lang, quality FROM {documents} JOIN {labels} USING (doc_id)", "materialize": "materialized"})
    materialize(store, dataset, _sources(sf_dir, "documents", "labels"))
    export_parquet(store, "labelled", store.root / "labelled", single_file=False)
    return spark.read.parquet(str(store.root / "labelled"))


def written_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _store(spark).root / "nation.parquet"
    write_file(normalize.total_order(_t(spark, sf_dir, "nation")), path)
    return spark.read.parquet(str(path)).select(*map(column, ("n_nationkey", "n_name", "n_regionkey")))




def queries() -> dict[str, Query]:
    own = (
        chain_join, default_select, compact_distinct, contour_distinct, zone_distinct, keyed_parts, reconstruct_fanout, orphan_count, null_key_is_orphan, dup_key_count,
        null_pk_count, null_counts, left_join_misses, priority_tiebreak, bridge_first, view_sql_using_join, rank_nulls_last, portable_checksum, group_fingerprint, group_diff,
        multiset_except_all, union_keys, key_batch, hash_buckets, content_sha256, ordered_sample, value_checks, arrow_source, equivalence, keyed_equivalence,
        published_chain, published_contours, published_table_source, materialized_export, written_file,
    )
    return {f.__name__: f for f in own}


_CHAIN_SQL = """
    SELECT o_orderkey, o_totalprice, c_name AS customer, n_name AS nation, r_name AS region
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
_FANOUT_SQL = """
    SELECT s_suppkey, s_nationkey, s_acctbal, c_mktsegment
    FROM (SELECT DISTINCT s_suppkey, s_nationkey, s_acctbal FROM supplier) JOIN (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) ON s_nationkey = c_nationkey
"""


def oracle_sql() -> dict[str, str]:
    return {
        "chain_join": _CHAIN_SQL,
        "published_chain": _CHAIN_SQL,
        "default_select": "SELECT nation.*, region.* FROM nation JOIN region ON n_regionkey = r_regionkey",
        "compact_distinct": "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
        "contour_distinct": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
        "zone_distinct": "SELECT DISTINCT c_nationkey FROM customer",
        "keyed_parts": "SELECT c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment NULLS LAST) AS INTEGER) AS part_no, c_mktsegment FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)",
        "reconstruct_fanout": _FANOUT_SQL,
        "published_contours": _FANOUT_SQL,
        "orphan_count": "SELECT count(*) AS orphans FROM (SELECT DISTINCT o_custkey FROM orders) o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey < 10)",
        "null_key_is_orphan": "SELECT count(*) AS orphans FROM (SELECT DISTINCT nullif(o_custkey, 1) AS k FROM orders) o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = k)",
        "dup_key_count": "SELECT count(*) AS repeated FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
        "null_pk_count": "SELECT count(*) AS nulls FROM customer WHERE nullif(c_nationkey, 3) IS NULL OR c_custkey IS NULL",
        "null_counts": "SELECT count(*) AS n_rows, count(*) FILTER (WHERE user_id % 7 = 0 OR user_id IS NULL) AS user_id_nulls, count(*) FILTER (WHERE event_id % 11 = 0 OR event_type IS NULL) AS event_type_nulls FROM events",
        "left_join_misses": "SELECT o_orderkey, c_name AS customer FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 10) ON o_custkey = c_custkey",
        "priority_tiebreak": TIES.replace("{lineitem}", "lineitem"),
        "bridge_first": "SELECT l_orderkey, p_brand, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, p_brand ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE rn = 1",
        "view_sql_using_join": "SELECT doc_id, lang, quality, '{\"braces\": 1}' AS note FROM documents JOIN labels USING (doc_id)",
        "rank_nulls_last": "SELECT o_custkey, price, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY price NULLS LAST, o_orderkey) AS rn FROM (SELECT o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price, o_orderkey FROM orders)) WHERE rn = 1",
        "portable_checksum": "SELECT c_nationkey, count(*) AS n_rows, CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws('|', c_custkey, c_name, c_mktsegment)), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS checksum FROM customer GROUP BY c_nationkey",
        "group_fingerprint": "SELECT c_nationkey, count(*) AS n_rows, count(c_acctbal) AS n, min(c_acctbal) AS lo, max(c_acctbal) AS hi, round(sum(c_acctbal), 2) AS total, round(sum(abs(c_acctbal)), 2) AS size FROM customer GROUP BY c_nationkey",
        "group_diff": "SELECT coalesce(a.k, b.k) AS nation, a_rows, b_rows FROM (SELECT c_nationkey AS k, count(*) AS a_rows FROM customer GROUP BY 1) a FULL JOIN (SELECT c_nationkey AS k, count(*) AS b_rows FROM customer WHERE c_acctbal > 0 AND c_nationkey <> 4 GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k",
        "multiset_except_all": "SELECT l_suppkey, l_returnflag, count(*) - 1 AS surplus FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
        "union_keys": "SELECT n_nationkey AS k FROM nation UNION SELECT c_nationkey FROM customer",
        "key_batch": "SELECT coalesce(CAST(k AS VARCHAR), 'none') AS k, count(*) AS n_rows FROM (SELECT nullif(c_nationkey, 7) AS k FROM customer) WHERE k IN (1, 2, 3) OR k IS NULL GROUP BY 1",
        "hash_buckets": "SELECT ((o_orderkey * -7919) % 16 + 16) % 16 AS bucket, count(*) AS n_rows FROM orders GROUP BY 1",
        "content_sha256": "SELECT doc_id, sha256(text) AS sha FROM documents",
        "ordered_sample": "SELECT s_suppkey, s_name FROM supplier ORDER BY s_name NULLS LAST, s_suppkey NULLS LAST LIMIT 5",
        "value_checks": "SELECT 'quantity' AS rule, count(*) AS failing FROM lineitem WHERE NOT coalesce(l_quantity < 25, false) UNION ALL SELECT 'status', count(*) FROM lineitem WHERE NOT coalesce(l_linestatus = 'O', false)",
        "arrow_source": "SELECT r_regionkey, r_name FROM region",
        "equivalence": "SELECT 'same' AS pair, count(*) AS reference_rows, count(*) AS view_rows, true AS equivalent FROM orders UNION ALL SELECT 'near', count(*), count(*), true FROM orders UNION ALL SELECT 'far', count(*), count(*) FILTER (WHERE o_orderkey % 100 <> 0), false FROM orders",
        "keyed_equivalence": "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys, count(DISTINCT o_custkey) FILTER (WHERE o_custkey % 50 = 0) AS mismatched FROM orders",
        "published_table_source": "SELECT n_nationkey, n_name FROM nation",
        "materialized_export": "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)",
        "written_file": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    }
