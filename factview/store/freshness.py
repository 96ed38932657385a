"""Objects of a workflow: do they exist, since when, and what is their receipt.

``t`` is a staged table, ``published/t`` a published one (of any kind),
``dataset/d`` a published dataset, ``grants/r`` a role's grants.
"""

from __future__ import annotations

import json
from datetime import datetime

from factview.functions.names import IDENTIFIER
from factview.plans.manifest import digest
from factview.store import grants
from factview.store.snapshot import PUBLIC, Store

PREFIXES = ("published", "dataset", "grants")


def parse(query: str, wildcards: bool = False) -> tuple[str, str]:
    """(prefix or 'table', name); a wildcard in braces is accepted where asked for."""
    prefix, slash, name = query.rpartition("/")
    if slash and prefix not in PREFIXES:
        raise ValueError(f"{query!r}: the prefix must be one of {PREFIXES}")
    if not IDENTIFIER.fullmatch(name) and not (wildcards and name.startswith("{") and name.endswith("}")):
        raise ValueError(f"{query!r}: not a relation's name")
    return prefix or "table", name


def exists(store: Store, query: str, update_id: str | None = None) -> bool:
    """Whether the object is there and whole (and, if given, of this version)."""
    kind, name = parse(query)
    snapshot = store.snapshot()
    if kind == "grants":
        return bool(snapshot["grants"].get(name))
    if kind == "table":
        found = store.staged("table", name)
        live = store.published("table", name, snapshot)
        good = [m for m in (found, live) if m and (update_id is None or m["update_id"] == update_id)]
        return any(store.whole(m["relation"]) if "relation" in m else store.whole(snapshot["relations"].get(f"{PUBLIC}.{name}")) for m in good)
    marker = store.published("dataset", name, snapshot) if kind == "dataset" else store.marker(name)
    if marker is None or (update_id is not None and marker["update_id"] != update_id):
        return False
    try:
        relation = store.find(name, None if kind == "published" else PUBLIC, snapshot)
    except LookupError:
        return False
    if kind == "published" and (staged := store.staged("table", name)) and staged["update_id"] != marker["update_id"]:
        return False  # staged again and not published since
    return store.whole(relation)


def modified(store: Store, query: str) -> float:
    """When the object was published, in seconds; 0 if it is not."""
    kind, name = parse(query)
    markers = store.snapshot()["markers"]
    kinds = ("dataset",) if kind == "dataset" else ("table", "dataset", "contour", "component")
    times = [datetime.fromisoformat(markers[k][name]["published_at"]).timestamp() for k in kinds if name in markers[k]]
    return max(times, default=0.0)


def receipt(store: Store, query: str) -> str:
    """A small JSON that stays the same as long as the version does: no times in it."""
    kind, name = parse(query)
    if kind == "grants":
        return grants.receipt(store, name)
    marker = store.marker(name) if kind != "dataset" else store.published("dataset", name)
    if marker is None:
        raise LookupError(f"{query!r} is not published")
    kept = {k: v for k, v in marker.items() if k not in ("published_at", "published_by")}
    return json.dumps({"object": query, **kept}, sort_keys=True)


def datasets_are_published(store: Store, names: list[str]) -> dict[str, bool]:
    """Of several datasets at once, from one snapshot."""
    snapshot = store.snapshot()
    return {n: n in snapshot["markers"]["dataset"] and store.whole(snapshot["relations"].get(f"{PUBLIC}.{n}")) for n in names}


def fingerprint(store: Store, relations: list[str], count_rows: bool = False) -> str:
    """Marker, columns and, if asked, counted rows of relations, as JSON of stable bytes.

    Uncounted, rows that came into a folder from outside go unnoticed.
    """
    out = {}
    for name in sorted(relations):
        relation, marker = store.find(name), store.marker(name)
        entry = {"update_id": marker and marker["update_id"], "schema": digest(relation["columns"])}
        out[name] = entry | ({"rows": store.plan(relation).count()} if count_rows else {})
    return json.dumps(out, sort_keys=True)
