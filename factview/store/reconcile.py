"""What is declared against what is published, and pruning of what no declaration covers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from factview.errors import ReconciliationError
from factview.plans.manifest import ContourDataset, Dataset
from factview.store.locks import held, lock_timeout
from factview.store.snapshot import PUBLIC, Store


@dataclass(frozen=True)
class Report:
    """missing: declared but not published; obsolete: managed by markers but not declared; unmanaged: without a marker."""

    missing: tuple[str, ...]
    obsolete: tuple[str, ...]
    unmanaged: tuple[str, ...]

    @property
    def clean(self) -> bool:
        return not (self.missing or self.obsolete)


def desired(tables: Iterable[str] = (), datasets: Iterable[Dataset] = ()) -> set[str]:
    """The relations that declarations give rise to."""
    out = {f"{PUBLIC}.{t}" for t in tables}
    for d in datasets:
        out.add(f"{PUBLIC}.{d.name}")
        if isinstance(d, ContourDataset):
            out |= {f"{d.compact_schema}.{n}" for n in d.physical_names()}
        else:
            out |= {f"{d.schema_of(c)}.{c.name}" for c in d.components}
    return out


def _managed(snapshot: dict) -> set[str]:
    names = {n for kind in snapshot["markers"].values() for n in kind}
    return {key for key in snapshot["relations"] if key.partition(".")[2] in names}


def reconcile(store: Store, tables: Iterable[str] = (), datasets: Iterable[Dataset] = ()) -> Report:
    """Reads only."""
    snapshot, wanted = store.snapshot(), desired(tables, datasets)
    actual, managed = set(snapshot["relations"]), _managed(snapshot)
    return Report(tuple(sorted(wanted - actual)), tuple(sorted(managed - wanted)), tuple(sorted(actual - managed - wanted)))


def prune(store: Store, tables: Iterable[str] = (), datasets: Iterable[Dataset] = (), *, authoritative: bool = False, execute: bool = False, timeout: str | float | None = None) -> Report:
    """Drops obsolete relations, all at once; what has no marker is never touched.

    Without ``execute`` it only reports. Executing needs ``authoritative``:
    the caller vouches that the declarations are complete.
    """
    if execute and not authoritative:
        raise ReconciliationError("pruning needs authoritative=True: only a complete declaration may remove relations")
    tables, datasets = list(tables), list(datasets)
    report = reconcile(store, tables, datasets)
    if not (execute and report.obsolete):
        return report
    with held(store.publish_lock, lock_timeout(timeout)):
        snapshot = store.snapshot()
        wanted = desired(tables, datasets)
        gone = _managed(snapshot) - wanted
        for d, links in snapshot["links"].items():
            if f"{PUBLIC}.{d}" not in gone and (used := {g for g in gone if g.partition(".")[2] in links}):
                raise ReconciliationError(f"{sorted(used)} are still used by dataset {d!r}")
        for key in gone:
            del snapshot["relations"][key]
            name = key.partition(".")[2]
            for kind in snapshot["markers"].values():
                kind.pop(name, None)
            snapshot["links"].pop(name, None)
            for role in snapshot["grants"].values():
                if key in role:
                    role.remove(key)
        store.swing(snapshot)
    store.collect_garbage()
    return report
