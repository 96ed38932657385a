"""What identifies a version of a stored object: its definition, its sources and the loader."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from factview.plans.manifest import Component, ComponentDataset, ContourDataset, digest

LOADER_VERSION = 1
TYPE_MAP_VERSION = 2

_VERSIONS = {"loader_version": LOADER_VERSION, "type_map_version": TYPE_MAP_VERSION}


def table_id(table: str, source: str, extra: Mapping[str, Any] | None = None) -> str:
    return digest({"table": table, "source": source, "extra": dict(extra or {}), **_VERSIONS})


def contour_id(dataset: ContourDataset, contour_source: str) -> str:
    """Depends on the definition too: other columns of the same file are another table."""
    return digest({"contours": dataset.contour_definition(), "source": contour_source, **_VERSIONS})


def contour_dataset_id(dataset: ContourDataset, fact_source: str, contour_source: str) -> str:
    return digest({"manifest": dataset.manifest_hash(), "facts": fact_source, "contours": contour_source, **_VERSIONS})


def component_id(one: Component, source: str) -> str:
    return digest({"definition": one.definition_hash(), "source": source, **_VERSIONS})


def component_dataset_id(dataset: ComponentDataset, components: Mapping[str, str]) -> str:
    return digest({"manifest": dataset.manifest_hash(), "components": dict(components), **_VERSIONS})


def components_digest(components: Mapping[str, str]) -> str:
    return digest(dict(components))
