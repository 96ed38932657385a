"""A store of versioned relations that change together.

Data lie in immutable folders. One JSON document names all relations, markers,
links, kept generations and grants of a moment; publishing writes the next
document and swings a pointer file, under a lock. Staging writes folders and
markers of its own, so that readers never see it. The root must be a folder of
a POSIX file system that the driver and all executors share.
"""

from __future__ import annotations

import json
import os
import shutil
import time
import uuid
from collections.abc import Mapping
from copy import deepcopy
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from getpass import getuser
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from factview.errors import DatasetNotPublished
from factview.functions.names import require_identifiers
from factview.plans.manifest import ComponentDataset, ContourDataset, load_manifest
from factview.plans.views import contour_plan, view_plan
from factview.sources import TableSource
from factview.store.locks import held, retention_seconds

EMPTY: dict[str, Any] = {
    "generation": 0,
    "relations": {},
    "markers": {"table": {}, "dataset": {}, "contour": {}, "component": {}},
    "links": {},
    "kept": {},
    "grants": {},
}
PUBLIC = "public"


@dataclass(frozen=True)
class Staged:
    """One object that staging found current or wrote."""

    kind: str
    name: str
    schema: str
    update_id: str
    status: str
    expected: str | None
    relation: dict[str, Any]
    marker: dict[str, Any]


@dataclass(frozen=True)
class Receipt:
    """What staging did, to be handed to publishing, by way of JSON if need be."""

    kind: str
    name: str
    update_id: str
    status: str
    objects: tuple[Staged, ...] = field(default=())

    def as_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Receipt:
        found = json.loads(text)
        return Receipt(**{**found, "objects": tuple(Staged(**x) for x in found["objects"])})


def now() -> str:
    return datetime.now(UTC).isoformat()


def write_atomically(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.parent / f".{path.name}.{uuid.uuid4().hex}"
    beside.write_text(text)
    os.replace(beside, path)


class Store:
    """Reading and bookkeeping; staging and publishing are functions over it."""

    def __init__(self, spark: SparkSession, root: str | Path) -> None:
        self.spark, self.root = spark, Path(root).absolute()

    # Snapshots

    def snapshot(self) -> dict[str, Any]:
        """The current document; an absent store is an empty one, and reading creates nothing."""
        pointer = self.root / "CURRENT"
        if not pointer.exists():
            return deepcopy(EMPTY)
        return json.loads((self.root / "snapshots" / f"{pointer.read_text().strip()}.json").read_text())

    def swing(self, snapshot: dict[str, Any]) -> None:
        """Makes a document the current one. The caller holds the publish lock."""
        snapshot["generation"] += 1
        name = f"{snapshot['generation']:08d}"
        write_atomically(self.root / "snapshots" / f"{name}.json", json.dumps(snapshot, sort_keys=True, indent=1))
        write_atomically(self.root / "CURRENT", name)

    @property
    def publish_lock(self) -> Path:
        return self.root / "locks" / "publish"

    def stage_lock(self, kind: str, name: str) -> Path:
        return self.root / "locks" / f"{kind}-{name}"

    # Staged markers

    def staged_path(self, kind: str, name: str) -> Path:
        return self.root / "staged" / kind / f"{name}.json"

    def staged(self, kind: str, name: str) -> dict[str, Any] | None:
        path = self.staged_path(kind, name)
        return json.loads(path.read_text()) if path.exists() else None

    def new_location(self, schema: str, name: str) -> str:
        require_identifiers("store", schema=schema, name=name)
        return str(self.root / "data" / schema / name / uuid.uuid4().hex)

    # Presence

    def whole(self, relation: Mapping[str, Any] | None, kind: str | None = None) -> bool:
        """Whether a relation is of the kind and all that it reads is there."""
        if relation is None or (kind is not None and relation["kind"] != kind):
            return False
        return all(Path(x, "_SUCCESS").exists() for x in self.locations(relation))

    @staticmethod
    def locations(relation: Mapping[str, Any]) -> list[str]:
        if "location" in relation:
            return [*relation.get("earlier", ()), relation["location"]]
        return [p["location"] for p in relation["view"]["pins"].values()]

    def published(self, kind: str, name: str, snapshot: dict[str, Any] | None = None) -> dict[str, Any] | None:
        return (snapshot or self.snapshot())["markers"].get(kind, {}).get(name)

    def marker(self, name: str) -> dict[str, Any] | None:
        """A published marker by name: of a table, else a dataset, a contour, a component."""
        markers = self.snapshot()["markers"]
        return next((markers[k][name] for k in ("table", "dataset", "contour", "component") if name in markers[k]), None)

    def dependents(self, component: str, snapshot: dict[str, Any] | None = None) -> list[str]:
        """Published datasets whose views hold the component."""
        links = (snapshot or self.snapshot())["links"]
        return sorted(d for d, held in links.items() if component in held)

    # Reading

    def find(self, name: str, schema: str | None = None, snapshot: dict[str, Any] | None = None) -> dict[str, Any]:
        relations = (snapshot or self.snapshot())["relations"]
        keys = [f"{schema or PUBLIC}.{name}"] if schema or f"{PUBLIC}.{name}" in relations else [k for k in relations if k.endswith(f".{name}")]
        if not keys or keys[0] not in relations:
            raise LookupError(f"{name!r} is not published")
        return relations[keys[0]]

    def plan(self, relation: Mapping[str, Any]) -> DataFrame:
        """A relation's rows: of its folder, or of its view over the versions that it pins."""
        if "location" in relation:
            return self.spark.read.parquet(*self.locations(relation))
        view = relation["view"]
        dataset = load_manifest(view["manifest"])
        pins = {n: self.spark.read.parquet(p["location"]) for n, p in view["pins"].items()}
        if isinstance(dataset, ContourDataset):
            return contour_plan(dataset, pins["facts"], pins["contours"])
        return view_plan(self.spark, dataset, pins, drop_unused=True)

    def read(self, name: str, schema: str | None = None, role: str | None = None) -> DataFrame:
        """A published relation; with a role, only if that may select from it."""
        snapshot = self.snapshot()
        relation = self.find(name, schema, snapshot)
        if role is not None:
            key = next(k for k, v in snapshot["relations"].items() if v is relation)
            if key not in snapshot["grants"].get(role, []):
                raise PermissionError(f"role {role!r} may not select from {key!r}")
        return self.plan(relation)

    def relation(self, dataset: ContourDataset | ComponentDataset | str) -> DataFrame:
        """A published dataset's view."""
        name = dataset if isinstance(dataset, str) else dataset.name
        snapshot = self.snapshot()
        if name not in snapshot["markers"]["dataset"]:
            raise DatasetNotPublished(f"dataset {name!r} is not published")
        return self.plan(self.find(name, PUBLIC, snapshot))

    def table_source(self, table: str) -> TableSource:
        """A published plain table as a source; a LookupError if there is none."""
        snapshot = self.snapshot()
        marker = snapshot["markers"]["table"].get(table)
        if marker is None:
            raise LookupError(f"table {table!r} is not published")
        return TableSource(table, tuple(self.locations(self.find(table, PUBLIC, snapshot))), marker["update_id"])

    # Cleaning

    def collect_garbage(self, retention: float | None = None) -> list[str]:
        """Removes version folders that nothing has named for ``retention`` seconds; returns them.

        A folder is first only noted as unnamed. It goes when a later call
        finds it noted, and untouched, for long enough: jobs that are still
        staging and readers of the version before keep theirs. With 0 it goes
        at once, which is for stores that nobody else uses at the time.
        """
        keep = retention_seconds() if retention is None else retention
        with held(self.publish_lock):
            snapshot, clock = self.snapshot(), time.time()
            used = {x for r in (*snapshot["relations"].values(), *(k["relation"] for k in snapshot["kept"].values())) for x in self.locations(r)}
            for path in (self.root / "staged").glob("*/*.json"):
                used |= {*self.locations(json.loads(path.read_text())["relation"])}
            unnamed = {str(p): p for p in (self.root / "data").glob("*/*/*") if p.is_dir() and str(p) not in used}
            noted = self.root / "unnamed.json"
            since = json.loads(noted.read_text()) if noted.exists() else {}
            since = {path: since.get(path, clock) for path in unnamed}
            touched = {path: max(x.stat().st_mtime for x in (p, *p.iterdir())) if keep else 0.0 for path, p in unnamed.items()}
            gone = [path for path in unnamed if clock - max(since[path], touched[path]) >= keep]
            if unnamed or noted.exists():
                write_atomically(noted, json.dumps({k: v for k, v in since.items() if k not in gone}, sort_keys=True))
        for path in gone:
            shutil.rmtree(path, ignore_errors=True)
        return gone


def open_store(spark: SparkSession, root: str | Path) -> Store:
    return Store(spark, root)


def make_store(spark: SparkSession, spec: Mapping[str, Any]) -> Store:
    """A store from ``{"type": "snapshot", "root": ...}``."""
    if spec.get("type", "snapshot") != "snapshot":
        raise ValueError(f"unknown store type {spec.get('type')!r}")
    return open_store(spark, spec["root"])


def by() -> str:
    try:
        return getuser()
    except (KeyError, OSError):
        return "unknown"
