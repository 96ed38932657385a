"""Staging and publishing: what is visible when, and what is refused."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from factview.errors import ComponentColumnsError, ComponentKeyError, DatasetNotPublished, KeptOldExists, OrphanFactsError, PublishConflict, ReconciliationError, UnsupportedTypeError
from factview.plans.manifest import load_manifest
from factview.store import freshness, grants, publishing
from factview.store.admin import main, verify_store, verify_view
from factview.store.export import export_parquet
from factview.store.locks import held, seconds
from factview.store.publishing import materialize, publish
from factview.store.reconcile import prune, reconcile
from factview.store.snapshot import Receipt, make_store, open_store
from factview.store.staging import is_current, stage, stage_table
from factview.streaming.feed import publish_stream

CONTOURS = {"name": "zones_view", "contour_table": "shapes", "contour_source": "contours", "fact_source": "facts", "geometry_column": "polygon coords", "fact_join_columns": ["zone id"], "contour_join_columns": ["zone id"], "output_columns": ["zone id", "metric", "polygon coords"]}
#: The depot of first choice for each order, with its stock of the goods.
DEPOT_SQL = """
    WITH options AS (SELECT o.no, o.goods, c.depot, row_number() OVER (PARTITION BY o.no ORDER BY c.rank) AS choice FROM {orders} o JOIN {choices} c USING (town))
    SELECT no, depot, stock FROM options JOIN {depots} USING (depot, goods) WHERE choice = 1
"""


def write(folder, name, /, **columns):
    path = folder / f"{name}.parquet"
    pq.write_table(pa.table(columns), path)
    return str(path)


@pytest.fixture
def store(spark, tmp_path):
    return open_store(spark, tmp_path / "store")


@pytest.fixture
def contour_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "contours", **{"zone id": ["Z1", "Z1", "Z2"], "polygon coords": ["b", "a", "c"], "label": ["x", "y", "z"]})
    write(folder, "facts", **{"zone id": ["Z1", "Z1", "Z2"], "metric": [10, 10, 20], "polygon coords": ["a", "b", "c"]})
    return folder


def star(materialize_as="view", kind="inner"):
    return load_manifest(
        {"name": "joined", "materialize": materialize_as, "components": [{"name": "f", "kind": "fact"}, {"name": "region", "kind": "dimension", "primary_key": ["code"]}], "view": {"base": "f", "joins": [{"component": "region", "on": {"region_code": "code"}, "type": kind}], "select": ["id", "label"]}}
    )


@pytest.fixture
def star_files(tmp_path):
    folder = tmp_path / "star"
    folder.mkdir()
    write(folder, "f", id=[1, 2], region_code=["01", "02"])
    write(folder, "region", code=["01", "02"], label=["one", "two"])
    return folder


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tables_start_stay_and_change(store, tmp_path):
    a, b = write(tmp_path, "a", id=[1, 2], score=[0.1, None]), write(tmp_path, "b", id=[3], name=pa.array([None], pa.string()))
    assert store.snapshot()["relations"] == {} and not store.root.exists()
    receipts = [stage_table(store, "a", a), stage_table(store, "b", b)]
    assert [r.status for r in receipts] == ["staged", "staged"]
    with pytest.raises(LookupError):
        store.read("a")
    assert publish(store, receipts) == ["a", "b"]
    before = store.snapshot()
    again = [stage_table(store, "a", a), stage_table(store, "b", b)]
    assert [r.status for r in again] == ["current", "current"] and publish(store, again) == [] and store.snapshot() == before
    assert is_current(store, "a", a) and not is_current(store, "a", b)
    write(tmp_path, "a", id=[1, 2, 3], score=[0.1, None, 0.30000000000000004])
    assert publish(store, [stage_table(store, "a", a), stage_table(store, "b", b)]) == ["a"]
    assert rows(store.read("a").where("score > 0.3")) == [(3, 0.30000000000000004)]
    assert store.marker("a")["null_counts"] == {"id": 0, "score": 1}


def test_receipts_travel_as_text_and_twice(store, tmp_path):
    receipt = stage_table(store, "a", write(tmp_path, "a", id=[1]))
    other = Receipt.from_json(receipt.as_json())
    assert other == receipt
    assert publish(store, [other]) == ["a"] and publish(store, [receipt]) == []


def test_a_crash_while_staging_leaves_nothing(store, tmp_path, monkeypatch):
    path = write(tmp_path, "a", id=[1])
    monkeypatch.setattr("factview.store.staging.write_atomically", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        stage_table(store, "a", path)
    monkeypatch.undo()
    assert store.staged("table", "a") is None
    assert stage_table(store, "a", path).status == "staged"
    assert len(store.collect_garbage(0)) == 1  # the first attempt's folder


def test_conflict_on_one_keeps_all(store, tmp_path):
    a, b = write(tmp_path, "a", id=[1]), write(tmp_path, "b", id=[1])
    publish(store, [stage_table(store, "a", a), stage_table(store, "b", b)])
    write(tmp_path, "a", id=[2])
    write(tmp_path, "b", id=[2])
    late = [stage_table(store, "a", a), stage_table(store, "b", b)]
    write(tmp_path, "b", id=[3])
    publish(store, [stage_table(store, "b", b)])
    with pytest.raises(PublishConflict):
        publish(store, late)
    assert rows(store.read("a")) == [(1,)] and rows(store.read("b")) == [(3,)]


def test_contours_keyed_and_not(store, contour_files):
    wide = [("Z1", 10, "a"), ("Z1", 10, "b"), ("Z2", 20, "c")]
    for keyed in (False, True):
        dataset = load_manifest(CONTOURS | {"keyed": keyed, "name": f"view_{keyed}", "contour_table": f"shapes_{keyed}"})
        receipt = materialize(store, dataset, str(contour_files))
        assert receipt.status == "staged"
        assert rows(store.relation(dataset)) == wide
        assert store.read(dataset.compact_table, "analytics_storage").count() == 2
        assert stage(store, dataset, str(contour_files)).status == "current"
        assert verify_store(store, dataset, str(contour_files / "facts.parquet")).equivalent
    assert rows(store.read("shapes_True", "analytics_storage").select("zone id", "part_no")) == [("Z1", 1), ("Z1", 2), ("Z2", 1)]
    assert store.read("shapes_True_zone", "analytics_storage").count() == 2


def test_contour_change_invalidates_and_dependents_must_follow(store, contour_files):
    one, two = (load_manifest(CONTOURS | {"name": n}) for n in ("one", "two"))
    publish(store, [stage(store, one, str(contour_files)), stage(store, two, str(contour_files))])
    write(contour_files, "contours", **{"zone id": ["Z1", "Z2"], "polygon coords": ["n", "c"]})
    first = stage(store, one, str(contour_files))
    assert first.status == "staged"
    with pytest.raises(PublishConflict, match="two"):
        publish(store, [first])
    publish(store, [first, stage(store, two, str(contour_files))])
    assert rows(store.relation("one")) == rows(store.relation("two")) == [("Z1", 10, "n"), ("Z2", 20, "c")]


def test_orphan_facts_fail_before_any_write(store, contour_files):
    write(contour_files, "facts", **{"zone id": ["Z1", "Z9", None], "metric": [1, 2, 3], "polygon coords": ["a", "b", "c"]})
    with pytest.raises(OrphanFactsError, match="2 compact"):
        stage(store, load_manifest(CONTOURS), str(contour_files))
    assert not store.root.exists()


def test_crash_at_commit_keeps_the_old_version(store, contour_files, monkeypatch):
    dataset = load_manifest(CONTOURS)
    materialize(store, dataset, str(contour_files))
    write(contour_files, "facts", **{"zone id": ["Z2"], "metric": [7], "polygon coords": ["c"]})
    receipt = stage(store, dataset, str(contour_files))
    monkeypatch.setattr("factview.store.snapshot.write_atomically", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        publish(store, [receipt])
    monkeypatch.undo()
    assert store.relation(dataset).count() == 3
    again = stage(store, dataset, str(contour_files))
    assert again.objects[-1].relation == receipt.objects[-1].relation  # nothing was written anew
    publish(store, [again])
    assert rows(store.relation(dataset)) == [("Z2", 7, "c")]


def test_ranked_choices_of_a_bridge(store, tmp_path):
    rng = random.Random(12)
    towns, depots = [f"t{k}" for k in range(6)], [f"d{k}" for k in range(5)]
    ranked = {t: rng.sample(depots, rng.randint(1, 5)) for t in towns}
    stock = {(d, g): rng.randint(1, 99) for d in depots for g in ("ink", "nut")}
    orders = [(k, rng.choice(towns), rng.choice(["ink", "nut"])) for k in range(30)]
    parts = [
        {"name": "orders", "kind": "fact", "primary_key": ["no"]},
        {"name": "choices", "kind": "bridge", "primary_key": ["town", "depot"], "priority": "rank"},
        {"name": "depots", "kind": "dimension", "primary_key": ["depot", "goods"]},
    ]
    dataset = load_manifest({"name": "served", "components": parts, "view_sql": DEPOT_SQL})
    rows_of = {"town": [t for t in towns for _ in ranked[t]], "depot": [d for t in towns for d in ranked[t]], "rank": [k for t in towns for k in range(len(ranked[t]))]}
    sources = {
        "orders": write(tmp_path, "orders", no=[o[0] for o in orders], town=[o[1] for o in orders], goods=[o[2] for o in orders]),
        "choices": write(tmp_path, "choices", **rows_of),
        "depots": write(tmp_path, "depots", depot=[d for d, _ in stock], goods=[g for _, g in stock], stock=list(stock.values())),
    }
    materialize(store, dataset, sources)
    assert rows(store.relation(dataset)) == [(no, ranked[t][0], stock[ranked[t][0], g]) for no, t, g in orders]
    for name, columns, error, fault in (
        ("unranked", {"town": ["t0"], "depot": ["d0"]}, ComponentColumnsError, "rank"),
        ("repeated", {"town": ["t0", "t0"], "depot": ["d1", "d1"], "rank": [3, 4]}, ComponentKeyError, "duplicate"),
        ("unknown", {"town": [None, "t0"], "depot": ["d1", "d1"], "rank": [3, 4]}, ComponentKeyError, "NULL"),
    ):
        with pytest.raises(error, match=fault):
            stage(store, dataset, sources | {"choices": write(tmp_path, name, **columns)})


def test_changed_component_restages_itself_only(store, star_files):
    dataset = star()
    materialize(store, dataset, str(star_files))
    write(star_files, "region", code=["01", "02"], label=["ONE", "two"])
    receipt = stage(store, dataset, str(star_files))
    assert {o.name: o.status for o in receipt.objects} == {"f": "current", "region": "staged", "joined": "staged"}
    publish(store, [receipt])
    assert rows(store.relation(dataset)) == [(1, "ONE"), (2, "two")]


def test_inner_orphans_are_refused_and_left_joins_keep_them(store, star_files):
    write(star_files, "f", id=[1, 2], region_code=["01", "99"])
    with pytest.raises(OrphanFactsError):
        stage(store, star(), str(star_files))
    assert not store.root.exists()
    materialize(store, star(kind="left"), str(star_files))
    assert sorted((r[0], r[1] or "") for r in store.relation("joined").collect()) == [(1, "one"), (2, "")]


def test_view_and_materialized_both_ways(store, star_files):
    for mode in ("view", "materialized", "view"):
        materialize(store, star(mode), str(star_files))
        assert store.find("joined")["kind"] == mode
        assert rows(store.relation("joined")) == [(1, "one"), (2, "two")]
        assert stage(store, star(mode), str(star_files)).status == "current"
    assert store.marker("joined")["row_count"] is None


def test_shared_component_and_live_versions(store, tmp_path):
    def dataset(name, fact):
        return load_manifest({"name": name, "components": [{"name": "dim", "kind": "dimension", "primary_key": ["k"]}, {"name": fact, "kind": "fact"}], "view_sql": f"SELECT id, label FROM {{{fact}}} JOIN {{dim}} USING (k)"})

    sources = {"dim": write(tmp_path, "dim", k=["a", "b"], label=["A", "B"]), "fa": write(tmp_path, "fa", id=[1, 2], k=["a", "b"]), "fb": write(tmp_path, "fb", id=[3], k=["b"])}
    one, two = dataset("one", "fa"), dataset("two", "fb")
    publish(store, [stage(store, one, sources), stage(store, two, sources)])
    assert store.dependents("dim") == ["one", "two"]
    early = stage(store, two, sources)
    write(tmp_path, "dim", k=["a", "b"], label=["A2", "B2"])
    with pytest.raises(PublishConflict, match="two"):
        publish(store, [stage(store, one, sources)])
    assert rows(store.relation("one")) == [(1, "A"), (2, "B")]
    with pytest.raises(PublishConflict):
        publish(store, [stage(store, one, sources), early])
    publish(store, [stage(store, one, sources), stage(store, two, sources)])
    assert rows(store.relation("one")) == [(1, "A2"), (2, "B2")] and rows(store.relation("two")) == [(3, "B2")]


def test_two_forms_in_one_publish_and_a_published_table_as_source(store, contour_files, tmp_path):
    publish(store, [stage_table(store, "codes", write(tmp_path, "codes", code=["01"], label=["one"]))])
    dataset = load_manifest({"name": "from_table", "components": [{"name": "c", "kind": "dimension", "primary_key": ["code"], "source": {"table": "codes"}}], "view_sql": "SELECT * FROM {c}"})
    publish(store, [stage(store, load_manifest(CONTOURS), str(contour_files)), stage(store, dataset, {})])
    assert rows(store.relation("from_table")) == [("01", "one")] and store.relation("zones_view").count() == 3
    missing = load_manifest({"name": "m", "components": [{"name": "c2", "kind": "fact", "source": {"table": "nowhere"}}], "view_sql": "SELECT * FROM {c2}"})
    with pytest.raises(LookupError):
        stage(store, missing, {})


def test_lost_folders_are_noticed_and_rebuilt(store, star_files):
    import shutil

    materialize(store, star(), str(star_files))
    shutil.rmtree(store.find("region", "analytics_storage")["location"])
    receipt = stage(store, star(), str(star_files))
    assert {o.name: o.status for o in receipt.objects}["region"] == "staged"
    publish(store, [receipt])
    assert store.relation("joined").count() == 2


def test_kept_generations(store, tmp_path):
    path = write(tmp_path, "a", id=[1])
    publish(store, [stage_table(store, "a", path)])
    grants.grant(store, "reader", ["public.a"])
    write(tmp_path, "a", id=[2])
    publish(store, [stage_table(store, "a", path)], keep_old=True)
    assert publishing.kept(store) == ["public.__old__a"] and rows(publishing.read_kept(store, "a")) == [(1,)]
    write(tmp_path, "a", id=[3])
    with pytest.raises(KeptOldExists):
        publish(store, [stage_table(store, "a", path)], keep_old=True)
    publishing.roll_back(store, ["a"])
    assert rows(store.read("a", role="reader")) == [(1,)] and store.marker("a") is None
    publishing.roll_back(store)
    assert rows(store.read("a")) == [(2,)]
    assert publishing.clean_up(store) == ["public.__old__a"] and publishing.kept(store) == []
    with pytest.raises(LookupError):
        publishing.roll_back(store)
    assert publish(store, [stage_table(store, "a", path)]) == ["a"]  # without a marker nothing conflicts


def test_locks_and_settings(store, tmp_path, monkeypatch):
    receipt = stage_table(store, "a", write(tmp_path, "a", id=[1]))
    with held(store.publish_lock), pytest.raises(TimeoutError):
        publish(store, [receipt], timeout="50ms")
    assert (seconds("2s"), seconds(1500), seconds(""), seconds("1min")) == (2.0, 1.5, None, 60.0)
    with pytest.raises(ValueError):
        seconds("soon")
    monkeypatch.setenv("FACTVIEW_ANALYZE", "perhaps")
    with pytest.raises(ValueError):
        publish(store, [receipt])
    assert store.snapshot()["relations"] == {}


def test_reconcile_and_prune(store, star_files, tmp_path):
    publish(store, [stage_table(store, "a", write(tmp_path, "a", id=[1])), stage(store, star(), str(star_files))])
    snapshot = store.snapshot()
    snapshot["relations"]["public.foreign"] = snapshot["relations"]["public.a"]
    store.swing(snapshot)
    report = reconcile(store, ["b"], [star()])
    assert (report.missing, report.obsolete, report.unmanaged) == (("public.b",), ("public.a",), ("public.foreign",))
    with pytest.raises(ReconciliationError):
        prune(store, ["b"], [star()], execute=True)
    assert prune(store, [], [star()]).obsolete == ("public.a",) and "public.a" in store.snapshot()["relations"]
    prune(store, [], [star()], authoritative=True, execute=True)
    assert "public.a" not in store.snapshot()["relations"] and "public.foreign" in store.snapshot()["relations"]
    assert store.relation("joined").count() == 2


def test_grants(store, star_files):
    materialize(store, star(), str(star_files))
    assert grants.grant_datasets(store, "app", [star()]) == ["analytics_storage.f", "analytics_storage.region", "public.joined"]
    assert store.read("joined", role="app").count() == 2
    with pytest.raises(PermissionError):
        store.read("joined", role="other")
    with pytest.raises(LookupError):
        grants.grant(store, "app", ["public.none"])
    first = grants.receipt(store, "app")
    assert grants.receipt(store, "app") == first and freshness.exists(store, "grants/app")
    write(star_files, "f", id=[5], region_code=["01"])
    materialize(store, star(), str(star_files))
    assert not grants.may_select(store, "app", "public.joined") and grants.may_select(store, "app", "analytics_storage.region")


def test_freshness_and_receipts(store, tmp_path, star_files):
    path = write(tmp_path, "t", id=[1])
    receipt = stage_table(store, "t", path)
    assert freshness.exists(store, "t") and not freshness.exists(store, "published/t")
    publish(store, [receipt])
    text, time = freshness.receipt(store, "published/t"), freshness.modified(store, "published/t")
    assert freshness.exists(store, "published/t") and time > 0 and freshness.modified(store, "published/none") == 0
    publish(store, [stage_table(store, "t", path)], refresh=True)
    assert freshness.receipt(store, "published/t") == text and freshness.modified(store, "published/t") > time
    write(tmp_path, "t", id=[2])
    stage_table(store, "t", path)
    assert not freshness.exists(store, "published/t")
    publish(store, [stage(store, star(), str(star_files))])
    assert freshness.datasets_are_published(store, ["joined", "none"]) == {"joined": True, "none": False}
    assert freshness.exists(store, "dataset/joined") and not freshness.exists(store, "dataset/none")
    one = freshness.fingerprint(store, ["joined", "region"], count_rows=True)
    assert one == freshness.fingerprint(store, ["region", "joined"], count_rows=True) and json.loads(one)["joined"]["rows"] == 2
    for bad in ("odd/t", "a b", "t; drop"):
        with pytest.raises(ValueError):
            freshness.parse(bad)
    assert freshness.parse("published/{name}", wildcards=True) == ("published", "{name}")


def test_export_and_command_line(store, star_files, tmp_path, capsys, spark):
    out = tmp_path / "out.parquet"
    with pytest.raises(DatasetNotPublished):
        export_parquet(store, "joined", out)
    assert not out.exists()
    materialize(store, star(), str(star_files))
    assert export_parquet(store, star(), out) == 2 and pq.read_table(out).num_rows == 2
    assert pq.read_table(out).schema.field("id").type == pa.int64()
    assert verify_view(store, "joined", str(out)).equivalent
    assert verify_view(store, "joined", f"(SELECT * FROM parquet.`{out}`)").equivalent
    (tmp_path / "m.json").write_text(json.dumps([star().canonical()]))
    (star_files / "joined.parquet").write_bytes(out.read_bytes())
    assert main(["--root", str(store.root), "verify", "--manifest", str(tmp_path / "m.json"), "--sources", str(star_files)], spark) == 0
    pq.write_table(pa.table({"id": [1], "label": ["one"]}), star_files / "joined.parquet")
    assert main(["--root", str(store.root), "verify", "--manifest", str(tmp_path / "m.json"), "--sources", str(star_files)], spark) == 1
    assert main(["--root", str(store.root), "list"], spark) == 0
    assert make_store(spark, {"root": str(store.root)}).relation("joined").count() == 2
    with pytest.raises(ValueError):
        make_store(spark, {"type": "odd", "root": "x"})


def test_types(store, tmp_path):
    import datetime
    import decimal

    path = write(tmp_path, "t", i8=pa.array([1], pa.int8()), d=pa.array([decimal.Decimal("1.50")]), l=pa.array([[1, 2]]), when=pa.array([datetime.datetime(2020, 1, 2)], pa.timestamp("us")))
    publish(store, [stage_table(store, "t", path)])
    assert dict(store.find("t")["columns"]) == {"i8": "smallint", "d": "string", "l": "string", "when": "timestamp_ntz"}
    assert store.read("t").first()["l"] == "[1,2]"
    dataset = load_manifest({"name": "d", "components": [{"name": "t2", "kind": "fact", "source": "t"}], "view_sql": "SELECT * FROM {t2}"})
    with pytest.raises(UnsupportedTypeError, match="'d'"):
        stage(store, dataset, {"t": path})


def test_lost_column_keeps_the_old_version(store, star_files):
    dataset = load_manifest({"name": "j", "components": [{"name": "f", "kind": "fact", "columns": ["id", "region_code"]}], "view_sql": "SELECT * FROM {f}"})
    materialize(store, dataset, str(star_files))
    write(star_files, "f", id=[9])
    with pytest.raises(ComponentColumnsError):
        stage(store, dataset, str(star_files))
    assert store.relation("j").count() == 2


def test_a_frame_is_known_by_its_rows(store, tmp_path):
    """A path overwritten with other rows is loaded again; the same rows in another order are not."""
    spark, path = store.spark, str(tmp_path / "grown")
    spark.range(3).write.parquet(path)
    assert publishing.publish_table(store, "grown", spark.read.parquet(path)).status == "staged"
    spark.range(9).write.mode("overwrite").parquet(path)
    assert publishing.publish_table(store, "grown", spark.read.parquet(path)).status == "staged"
    assert store.read("grown").count() == 9
    shuffled = spark.range(9).repartition(3).orderBy("id", ascending=False)
    assert publishing.publish_table(store, "grown", shuffled).status == "current"
    assert publishing.publish_table(store, "grown", spark.range(9).selectExpr("IF(id = 4, NULL, id) AS id")).status == "staged"


def test_publishing_leaves_running_jobs_and_readers_alone(store):
    spark = store.spark
    publishing.publish_table(store, "one", spark.range(5))
    reader = store.read("one")
    in_flight = store.new_location("public", "two")
    spark.range(7).write.parquet(in_flight)  # staged by another job, whose marker is still to come
    publishing.publish_table(store, "one", spark.range(6))
    publishing.publish_table(store, "one", spark.range(8))
    assert reader.count() == 5 and spark.read.parquet(in_flight).count() == 7
    assert store.collect_garbage(3600) == [] and len(store.collect_garbage(0)) == 3
    assert store.read("one").count() == 8


def test_a_stream_writes_each_batch_once(store, tmp_path):
    spark, folder = store.spark, tmp_path / "feed"
    folder.mkdir()
    write(folder, "a", k=[1, 2], s=["x", None])
    feed = lambda: publish_stream(store, "fed", str(folder), "k long, s string", str(tmp_path / "check")).awaitTermination()
    feed()
    first = store.find("fed")
    write(folder, "b", k=[3], s=["y"])
    feed()
    feed()
    second = store.find("fed")
    assert second["earlier"] == [first["location"]] and second["rows"] == 3
    assert sorted(r["k"] for r in store.read("fed").collect()) == [1, 2, 3]
    assert store.marker("fed")["null_counts"] == {"k": 0, "s": 1}
    assert store.collect_garbage(0) == [] and spark.read.parquet(*store.locations(second)).count() == 3
