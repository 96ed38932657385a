"""Sources, names, normalisation, checks and comparison."""

import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factview.errors import FanOutError
from factview.functions.hashing import row_hash
from factview.functions.names import column, is_identifier, literal, quoted, require_distinct
from factview.operators import checks, normalize, verify
from factview.operators.writers import export_joined, write_components, write_csv, write_file
from factview.plans.manifest import ContourDataset, load_manifest
from factview.plans.views import join_plan
from factview.sources import ArrowSource, as_source, from_directory, identity, resolve, statistics
from factview.sources.jdbc import connection, read_table

HOSTILE = ['say "hi"', "a`b", "x; DROP TABLE y --", "nom de l'été", "a.b", "(c)"]
ZONES = ContourDataset("z", "shape", "shapes", ("zone",), ("zone",), ("zone", "metric", "shape"))


def test_hostile_column_names_survive(spark, tmp_path):
    df = spark.createDataFrame([tuple(range(len(HOSTILE)))], HOSTILE)
    path = tmp_path / "h.parquet"
    write_file(df, path)
    back = normalize.project(spark.read.parquet(str(path)), HOSTILE)
    assert back.columns == HOSTILE and tuple(back.first()) == tuple(range(len(HOSTILE)))
    assert spark.sql(f"SELECT {literal(HOSTILE[2] + chr(39) + chr(92))} AS x").first()["x"] == HOSTILE[2] + "'\\"
    assert quoted("a`b") == "`a``b`"
    assert not any(map(is_identifier, [*HOSTILE, "", "1a", "a\n", None])) and is_identifier("_a1")
    with pytest.raises(ValueError):
        require_distinct(["a", "A"], "t")


def test_sources(spark, tmp_path):
    frame = pd.DataFrame({"zone id": ["a", "b", "a"], "v": [0.1 + 0.2, 1e-300, 3.0]})
    table = pa.table({"zone id": pa.array(["a", "b", "a"]).dictionary_encode(), "v": [0.1 + 0.2, 1e-300, 3.0], "s": pa.array([1, 2, 3], pa.int16())})
    assert [r["v"] for r in resolve(spark, frame).collect()] == [0.1 + 0.2, 1e-300, 3.0]
    df = resolve(spark, table)
    assert dict(df.dtypes) == {"zone id": "string", "v": "double", "s": "smallint"}
    whole = pa.table({"x": list(range(100))})
    parts = pa.concat_tables([whole.slice(0, 30), whole.slice(30)])
    assert identity(spark, ArrowSource("a", whole)) == identity(spark, ArrowSource("b", parts)) != identity(spark, whole.slice(1))
    folder = tmp_path / "d"
    folder.mkdir()
    pq.write_table(whole, folder / "part-0.parquet")
    one = identity(spark, str(folder))
    pq.write_table(whole, folder / "part-1.parquet")
    assert identity(spark, str(folder)) != one
    assert resolve(spark, str(folder)).count() == 200
    assert from_directory(["a"], "/x/") == {"a": "/x/a.parquet"}
    assert statistics(spark.createDataFrame([(1, None), (None, None)], "`a b` int, c string")) == (2, {"a b": 1, "c": 2})
    assert as_source("p") == "p"
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        identity(spark, str(tmp_path / "none"))


def test_database_settings_keep_secrets_apart(spark):
    settings_, secrets = connection("postgresql+psycopg://me:p%40ss@h1:5432,h2:5433/db?sslmode=require&sslkey=k")
    assert settings_["url"] == "jdbc:postgresql://h1:5432,h2:5433/db" and settings_["sslmode"] == "require"
    assert secrets == {"sslkey": "k", "user": "me", "password": "p@ss"}
    with pytest.raises(ConnectionError) as error:
        read_table(spark, "postgresql://me:secret@nowhere/db", "t")
    assert "secret" not in str(error.value)
    with pytest.raises(ValueError):
        connection("mysql://x/y")


def test_normalised_forms(spark, tmp_path):
    wide = spark.createDataFrame([("Z1", 10, "b"), ("Z1", 10, "a"), ("Z2", 20, "c"), (None, 1, None)], "zone string, metric int, shape string")
    facts, shapes = normalize.compact(wide, ZONES), normalize.contours(wide, ZONES)
    assert facts.count() == 3 and normalize.compact(facts, ZONES).count() == 3
    assert sorted((r["zone"] or "", r["part_no"], r["shape"]) for r in normalize.parts(wide.where("zone IS NOT NULL"), ZONES).collect()) == [("Z1", 1, "a"), ("Z1", 2, "b"), ("Z2", 1, "c")]
    assert normalize.zones(shapes, ZONES).count() == 3
    assert checks.contour_orphans(wide, shapes, ZONES).count() == 1  # the null key
    full = wide.where("zone IS NOT NULL")
    out = [tmp_path / "one", tmp_path / "two"]
    for folder in out:
        assert write_components(ZONES, full, full, folder) == {"compact__z": 2, "shapes": 3}
    for name in ("compact__z", "shapes"):
        assert (out[0] / f"{name}.parquet").read_bytes() == (out[1] / f"{name}.parquet").read_bytes()
    assert export_joined(ZONES, normalize.compact(full, ZONES), normalize.contours(full, ZONES), tmp_path / "wide.parquet") == 3
    assert verify.compare_keyed(full, spark.read.parquet(str(tmp_path / "wide.parquet"))).equivalent


def test_csv_tells_null_from_empty(spark, tmp_path):
    write_csv(spark.createDataFrame([("", 1), (None, 2), ('q"é\n', 3)], "s string, n int").coalesce(1), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("part-*")).read_text()
    assert text.startswith('"",1\n,2\n')


def test_unused_joins_are_left_out_only_where_that_is_right(spark):
    spec = {"name": "d", "components": [{"name": "f", "kind": "fact"}, {"name": "a", "kind": "dimension", "primary_key": ["k"]}, {"name": "p", "kind": "bridge", "primary_key": ["k", "n"]}], "view": {"base": "f", "joins": [{"component": "a", "on": {"k": "k"}}, {"component": "p", "on": {"k": "k"}, "fan_out": True}], "select": ["k"]}}
    frames = {"f": spark.createDataFrame([(1,), (2,)], "k int"), "a": spark.createDataFrame([(1, "x"), (2, "y")], "k int, label string"), "p": spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, n int")}
    plain, short = (join_plan(load_manifest(spec), frames, drop_unused=d) for d in (False, True))
    assert sorted(plain.collect()) == sorted(short.collect()) and short.count() == 3
    assert short._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    spec["view"]["joins"][1].pop("fan_out")
    with pytest.raises(FanOutError):
        load_manifest(spec)


def test_null_positions_and_multiplicities_count(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string").select(row_hash([F.col("x"), F.col("y")]).alias("h"))
    assert df.distinct().count() == 2
    a = spark.createDataFrame([("k", 1, None), ("k", 1, None), (None, 2, "s")], "k string, i int, s string")
    assert verify.compare_keyed(a, a).equivalent and verify.compare_relations(a, a).equivalent
    for other in (a.distinct(), a.where("k IS NOT NULL"), a.union(spark.createDataFrame([("new", 1, None)], a.schema)), a.withColumn("i", F.col("i") + 1)):
        assert not verify.compare_keyed(a, other).equivalent and not verify.compare_relations(a, other).equivalent and not verify.same_multiset(a, other)
    found = verify.compare_keyed(a, a.withColumn("i", F.col("i").cast("long")))
    assert not found.equivalent and found.mismatched_keys == 0 and found.schema[0].position == 1


def test_tolerance_and_columns(spark):
    a = spark.createDataFrame([("g", 1.0, 5), ("g", 1e9, 5), ("g", -1e9, 5)], "k string, v double, n int")
    scaled = lambda by: a.withColumn("v", F.col("v") * (1 + by))
    assert verify.compare_relations(a, scaled(5e-10)).equivalent
    far = verify.compare_relations(a, scaled(2e-9))
    assert not far.equivalent and far.mismatched_groups == 1 and len(far.sample) == 1
    assert verify.compare_relations(a, a.withColumn("v", F.col("v").cast("decimal(20,3)"))).equivalent
    missing = verify.compare_relations(a, a.drop("n").withColumn("extra", F.lit(1)))
    assert (missing.missing_columns, missing.extra_columns, missing.reference_rows) == (("n",), ("extra",), 3)
    assert verify.compare_relations(a, a.withColumn("extra", F.lit(1)), columns=["k", "v"]).equivalent
    assert verify.compare_relations(a, a, key_column="k", key_batch_size=1).batches == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=8), st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=8))
def test_comparison_is_multiset_equality(spark, a, b):
    x, y = (spark.createDataFrame(z, "k string, v int") for z in (a, b))
    key = lambda r: (str(r[0]), str(r[1]))
    same = sorted(a, key=key) == sorted(b, key=key)
    assert verify.compare_keyed(x, y).equivalent == same
    assert verify.compare_relations(x, y).equivalent == same


def test_priority_and_value_checks(spark):
    rows = [(k % 5, None if k % 7 == 0 else k % 3, k) for k in random.Random(1).sample(range(100), 60)]
    first = {r["k"]: (r["p"], r["i"]) for r in normalize.first_by_priority(spark.createDataFrame(rows, "k int, p int, i int"), ["k"], ["p", "i"]).collect()}
    for k in range(5):
        assert first[k] == min(((p, i) for x, p, i in rows if x == k), key=lambda r: (r[0] is None, r))
    assert checks.check_values(spark.createDataFrame([(1,), (None,), (3,)], "a int"), {"small": "a < 2"}) == {"small": 2}
    assert checks.check_values(spark.range(1), {}) == {}
    assert column("a").isNull() is not None


def test_streamed_publication(spark, tmp_path):
    from factview.store.snapshot import open_store
    from factview.streaming import publish_stream

    store = open_store(spark, tmp_path / "store")
    (tmp_path / "in").mkdir()
    for k in range(2):
        pq.write_table(pa.table({"id": [k]}), tmp_path / "in" / f"{k}.parquet")
        query = publish_stream(store, "t", str(tmp_path / "in"), "id long", str(tmp_path / "ck"))
        query.awaitTermination(60)
        assert query.exception() is None
        assert sorted(r["id"] for r in store.read("t").collect()) == list(range(k + 1))
