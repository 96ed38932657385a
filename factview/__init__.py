"""factview: compact relational components, declared views and atomic publication of Parquet datasets on Spark.

A dataset is described by a manifest: components (facts, dimensions, bridges)
and either declared joins or a SQL template over them. Staging checks keys and
orphans and writes immutable versions; publishing swings one snapshot pointer,
so that any number of datasets change together or not at all.
"""

from factview.plans.manifest import load_manifest, load_manifests
from factview.plans.relations import KeyGraph, graph_from_spec, reference
from factview.store.snapshot import Store, open_store

__all__ = ["KeyGraph", "Store", "graph_from_spec", "load_manifest", "load_manifests", "open_store", "reference"]
