"""Which roles may select from which relations."""

from __future__ import annotations

import json
from collections.abc import Iterable

from factview.functions.names import require_identifiers
from factview.plans.manifest import ContourDataset, Dataset
from factview.store.locks import held, lock_timeout
from factview.store.snapshot import PUBLIC, Store


def dataset_relations(dataset: Dataset) -> list[str]:
    """The dataset's view and all that it reads."""
    if isinstance(dataset, ContourDataset):
        stored = sorted(f"{dataset.compact_schema}.{n}" for n in dataset.physical_names())
    else:
        stored = sorted(f"{dataset.schema_of(c)}.{c.name}" for c in dataset.components)
    return [f"{PUBLIC}.{dataset.name}", *stored]


def grant(store: Store, role: str, relations: Iterable[str], timeout: str | float | None = None) -> list[str]:
    """Lets a role select from published relations; a LookupError names those that are not."""
    require_identifiers("grant", role=role)
    with held(store.publish_lock, lock_timeout(timeout)):
        snapshot = store.snapshot()
        wanted = set(relations)
        absent = sorted(wanted - set(snapshot["relations"]))
        if absent:
            raise LookupError(f"not published: {absent}")
        before = set(snapshot["grants"].get(role, []))
        if wanted - before:
            snapshot["grants"][role] = sorted(before | wanted)
            store.swing(snapshot)
    return sorted(wanted)


def grant_datasets(store: Store, role: str, datasets: Iterable[Dataset]) -> list[str]:
    return grant(store, role, [r for d in datasets for r in dataset_relations(d)])


def may_select(store: Store, role: str, relation: str) -> bool:
    return relation in store.snapshot()["grants"].get(role, [])


def receipt(store: Store, role: str) -> str:
    """The role's grants as JSON, equal bytes for equal grants."""
    return json.dumps({"role": role, "relations": sorted(store.snapshot()["grants"].get(role, []))}, sort_keys=True)
