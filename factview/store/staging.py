"""Staging: decide, check, write a version, and only then its marker."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from factview.functions.types import for_component, for_table
from factview.operators import checks, normalize
from factview.operators.writers import write_folder
from factview.plans.manifest import Component, ComponentDataset, ContourDataset, Dataset
from factview.plans.views import view_plan
from factview.sources import bind, describe, from_directory, identity, resolve, statistics
from factview.store import identity as ids
from factview.store.locks import held
from factview.store.snapshot import PUBLIC, Receipt, Staged, Store, write_atomically


def _stage(store: Store, kind: str, name: str, schema: str, update_id: str, write: Callable[[str], tuple[DataFrame | None, dict[str, Any]]], marker: Mapping[str, Any], before: Mapping[str, Any] | None = None) -> Staged:
    """Current if it is live and whole, staged if it was written before, else written now.

    ``write`` makes the rows of a location and tells what the relation's
    record holds; the marker file comes last, so a crash leaves nothing that counts.
    With ``before``, a relation, what is written comes after its folders.
    """
    with held(store.stage_lock(kind, name)):
        snapshot = store.snapshot()
        live = store.published(kind, name, snapshot)
        expected = live["update_id"] if live else None
        relation = snapshot["relations"].get(f"{schema}.{name}")
        if expected == update_id and store.whole(relation, "table"):
            return Staged(kind, name, schema, update_id, "current", expected, relation, live)
        found = store.staged(kind, name)
        if not (found and found["update_id"] == update_id and store.whole(found["relation"])):
            location = store.new_location(schema, name)
            df, more = write(location)
            rows = write_folder(df, location)
            relation = {"kind": "table", "location": location, "columns": [list(c) for c in describe(df)], "rows": rows}
            if before:
                rows += before["rows"]
                relation |= {"earlier": store.locations(before), "rows": rows}
            found = {"update_id": update_id, "relation": relation, "marker": {**marker, **more, "update_id": update_id, "row_count": rows, "loader_version": ids.LOADER_VERSION, "type_map_version": ids.TYPE_MAP_VERSION}}
            write_atomically(store.staged_path(kind, name), json.dumps(found, sort_keys=True))
        return Staged(kind, name, schema, update_id, "staged", expected, found["relation"], found["marker"])


def stage_table(store: Store, table: str, source: Any, extra: Mapping[str, Any] | None = None) -> Receipt:
    """A plain table from a source. Types that a table does not hold become text."""
    sha = identity(store.spark, source)
    update_id = ids.table_id(table, sha, extra)

    def write(location: str) -> tuple[DataFrame, dict[str, Any]]:
        df = for_table(resolve(store.spark, source))
        return df, {"null_counts": statistics(df)[1]}

    one = _stage(store, "table", table, PUBLIC, update_id, write, {"source_sha": sha})
    return Receipt("table", table, update_id, one.status, (one,))


def stage_append(store: Store, table: str, batch: DataFrame, number: int) -> Receipt:
    """A plain table with a numbered batch after what is published of it; only the batch is read and written.

    Batches have the table's columns. The version is named by the one before
    and the number, so that a batch staged again is found.
    """
    snapshot = store.snapshot()
    live = store.published("table", table, snapshot)
    before = snapshot["relations"][f"{PUBLIC}.{table}"] if live else None
    rows = for_table(batch)
    if before and [list(c) for c in describe(rows)] != before["columns"]:
        raise ValueError(f"table {table!r} has columns {before['columns']}, not {describe(rows)}")
    nulls = live.get("null_counts", {}) if live else {}
    write = lambda _: (rows, {"null_counts": {c: n + nulls.get(c, 0) for c, n in statistics(rows)[1].items()}})
    update_id = ids.table_id(table, live["update_id"] if live else "", {"batch": number})
    one = _stage(store, "table", table, PUBLIC, update_id, write, {"batch": number}, before)
    return Receipt("table", table, update_id, one.status, (one,))


def is_current(store: Store, table: str, source: Any, extra: Mapping[str, Any] | None = None) -> bool:
    """Whether a table's marker and rows are what staging would give; reads only."""
    live, snapshot = store.published("table", table), store.snapshot()
    return bool(live) and live["update_id"] == ids.table_id(table, identity(store.spark, source), extra) and store.whole(snapshot["relations"].get(f"{PUBLIC}.{table}"), "table")


def _view(store: Store, dataset: Dataset, update_id: str, status: str, expected: str | None, pins: Mapping[str, Staged], marker: Mapping[str, Any], columns: list, relation: dict[str, Any] | None = None) -> Staged:
    view = {
        "kind": "view",
        "view": {"manifest": dataset.canonical(), "pins": {n: {"name": s.name, "schema": s.schema, "update_id": s.update_id, "location": s.relation["location"]} for n, s in pins.items()}},
        "columns": [list(c) for c in columns],
    }
    marker = {**marker, "update_id": update_id, "manifest_hash": dataset.manifest_hash(), "loader_version": ids.LOADER_VERSION, "type_map_version": ids.TYPE_MAP_VERSION}
    return Staged("dataset", dataset.name, PUBLIC, update_id, status, expected, relation or view, marker)


def _status(store: Store, dataset: Dataset, update_id: str, kind: str) -> tuple[str, str | None]:
    snapshot = store.snapshot()
    live = store.published("dataset", dataset.name, snapshot)
    expected = live["update_id"] if live else None
    whole = store.whole(snapshot["relations"].get(f"{PUBLIC}.{dataset.name}"), kind)
    return ("current" if expected == update_id and whole else "staged"), expected


def stage_contour_dataset(store: Store, dataset: ContourDataset, facts: Any, contours: Any) -> Receipt:
    """Compact facts, contours (and zones, if keyed) and the view that joins them. Orphans are found before any write."""
    spark = store.spark
    fact_sha, contour_sha = identity(spark, facts), identity(spark, contours)
    update_id = ids.contour_dataset_id(dataset, fact_sha, contour_sha)
    contour_id = ids.contour_id(dataset, contour_sha)
    status, expected = _status(store, dataset, update_id, "view")
    rows, shapes = resolve(spark, facts), resolve(spark, contours)
    if status != "current":
        checks.check_contours(rows, shapes, dataset)
    schema, sources = dataset.compact_schema, {"source_sha": contour_sha}
    objects = []
    if dataset.keyed:
        objects.append(_stage(store, "contour", dataset.zone_table, schema, contour_id, lambda _: (for_component(normalize.zones(shapes, dataset)), {}), sources))
    form = normalize.parts if dataset.keyed else normalize.contours
    shape = _stage(store, "contour", dataset.contour_table, schema, contour_id, lambda _: (for_component(form(shapes, dataset)), {}), sources)
    fact = _stage(store, "component", dataset.compact_table, schema, update_id, lambda _: (for_component(normalize.compact(rows, dataset)), {}), {"source_sha": fact_sha})
    marker = {"fact_sha": fact_sha, "contour_sha": contour_sha, "row_count": fact.relation["rows"]}
    columns = [c for n in dataset.output_columns for c in (shape if n == dataset.geometry_column else fact).relation["columns"] if c[0] == n]
    view = _view(store, dataset, update_id, status, expected, {"facts": fact, "contours": shape}, marker, columns)
    objects += [shape, fact, view]
    whole = "current" if all(o.status == "current" for o in objects) else "staged"
    return Receipt("contour_dataset", dataset.name, update_id, whole, tuple(objects))


def stage_component(store: Store, one: Component, schema: str, source: Any, sha: str | None = None, checked: bool = False) -> Staged:
    """One component; its key is checked before anything is written, unless it was."""
    sha = sha or identity(store.spark, source)

    def write(location: str) -> tuple[DataFrame, dict[str, Any]]:
        rows = resolve(store.spark, source)
        if not checked:
            checks.check_component(rows, one)
        return for_component(normalize.component(rows, one)), {}

    return _stage(store, "component", one.name, schema, ids.component_id(one, sha), write, {"source_sha": sha, "schema": schema})


def stage_component_dataset(store: Store, dataset: ComponentDataset, sources: Mapping[str, Any]) -> Receipt:
    """All components and the view. Columns, keys and orphans are checked before any write."""
    spark = store.spark
    given = {c.name: store.table_source(c.source_table) if c.source_table else sources[c.source_key] for c in dataset.components}
    found = {c.name: identity(spark, given[c.name]) for c in dataset.components}
    pinned = {c.name: ids.component_id(c, found[c.name]) for c in dataset.components}
    update_id = ids.component_dataset_id(dataset, pinned)
    kind = "materialized" if dataset.materialize == "materialized" else "view"
    status, expected = _status(store, dataset, update_id, kind)
    if status != "current":
        frames = bind(spark, given)
        for one in dataset.components:
            checks.check_component(frames[one.name], one)
        checks.check_joins(dataset, {c.name: normalize.component(frames[c.name], c) for c in dataset.components})
    objects = {c.name: stage_component(store, c, dataset.schema_of(c), given[c.name], found[c.name], status != "current") for c in dataset.components}
    components = {n: s.update_id for n, s in objects.items()}
    frames = {n: spark.read.parquet(s.relation["location"]) for n, s in objects.items()}
    plan = view_plan(spark, dataset, frames)
    marker = {"fact_sha": ids.components_digest(components), "contour_sha": "components", "components": components, "materialize": dataset.materialize, "row_count": None}
    if kind == "view":
        view = _view(store, dataset, update_id, status, expected, objects, marker, describe(plan))
    elif status == "current":
        relation = store.snapshot()["relations"][f"{PUBLIC}.{dataset.name}"]
        view = _view(store, dataset, update_id, status, expected, objects, marker | {"row_count": relation["rows"]}, describe(plan), relation)
    else:
        done = _stage(store, "materialized", dataset.name, PUBLIC, update_id, lambda _: (plan, {}), {})
        relation = {**done.relation, "kind": "materialized"}
        view = _view(store, dataset, update_id, status, expected, objects, marker | {"row_count": relation["rows"]}, describe(plan), relation)
    whole = "current" if status == "current" and all(s.status == "current" for s in objects.values()) else "staged"
    return Receipt("component_dataset", dataset.name, update_id, whole, (*objects.values(), view))


def stage(store: Store, dataset: Dataset, sources: Mapping[str, Any] | str) -> Receipt:
    """Any dataset; ``sources`` maps source keys, or names a folder of <key>.parquet."""
    if isinstance(dataset, ContourDataset):
        given = from_directory([dataset.fact_key, dataset.contour_source], sources) if isinstance(sources, str) else sources
        return stage_contour_dataset(store, dataset, given[dataset.fact_key], given[dataset.contour_source])
    given = from_directory([c.source_key for c in dataset.components if not c.source_table], sources) if isinstance(sources, str) else sources
    return stage_component_dataset(store, dataset, given)
