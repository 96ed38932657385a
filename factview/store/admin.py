"""Command line: kept generations, and proof that published datasets equal their sources.

    python -m factview.store.admin --root DIR list | cleanup [NAME...] | rollback [NAME...]
    python -m factview.store.admin --root DIR verify --manifest FILE.json --sources DIR
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from factview.operators import normalize
from factview.operators.verify import compare_keyed, compare_relations
from factview.plans.manifest import ContourDataset, Dataset, load_manifests
from factview.sources import from_directory, identity, resolve
from factview.store import identity as ids
from factview.store import publishing
from factview.store.locks import held
from factview.store.snapshot import PUBLIC, Store, by, now, open_store


def verify_view(store: Store, dataset: Dataset | str, reference: DataFrame | str, **options):
    """A published dataset against a reference: a DataFrame, a path, or (with a parenthesis) a query."""
    if isinstance(reference, str):
        reference = store.spark.sql(f"SELECT * FROM {reference}") if "(" in reference else store.spark.read.parquet(reference)
    return compare_relations(reference, store.relation(dataset), **options)


def verify_store(store: Store, dataset: ContourDataset, facts) -> object:
    """A published contour dataset against its wide source, key by key, types included."""
    original = normalize.project(resolve(store.spark, facts), dataset.output_columns)
    return compare_keyed(original, store.relation(dataset), list(dataset.output_columns), dataset.fact_join_columns[0])


def seed_markers(store: Store, tables: dict[str, str], verify_only: bool = False) -> dict[str, bool]:
    """Adopts published tables known to equal their sources: verifies each and writes its marker."""
    out = {}
    for table, source in tables.items():
        rows = store.read(table)
        out[table] = compare_relations(resolve(store.spark, source), rows).equivalent
        if out[table] and not verify_only:
            with held(store.publish_lock):
                snapshot = store.snapshot()
                sha = identity(store.spark, source)
                marker = {"update_id": ids.table_id(table, sha), "source_sha": sha, "row_count": rows.count(), "loader_version": ids.LOADER_VERSION, "type_map_version": ids.TYPE_MAP_VERSION}
                snapshot["markers"]["table"][table] = {**marker, "published_at": now(), "published_by": by()}
                store.swing(snapshot)
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--root", required=True)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    for name in ("cleanup", "rollback"):
        commands.add_parser(name).add_argument("names", nargs="*")
    verify = commands.add_parser("verify")
    verify.add_argument("--manifest", required=True)
    verify.add_argument("--sources", required=True)
    given = parser.parse_args(arguments)
    store = open_store(spark or SparkSession.builder.getOrCreate(), given.root)
    if given.command == "list":
        print("\n".join(publishing.kept(store)))
    elif given.command == "cleanup":
        print("\n".join(publishing.clean_up(store, given.names or None)))
    elif given.command == "rollback":
        print("\n".join(publishing.roll_back(store, given.names or None)))
    else:
        bad = []
        for dataset in load_manifests(json.loads(Path(given.manifest).read_text())):
            if isinstance(dataset, ContourDataset):
                result = verify_store(store, dataset, from_directory([dataset.fact_key], given.sources)[dataset.fact_key])
            else:
                result = verify_view(store, dataset, f"{given.sources}/{dataset.name}.parquet")
            print(f"{PUBLIC}.{dataset.name}: {'equal' if result.equivalent else result}")
            bad += [] if result.equivalent else [dataset.name]
        return int(bool(bad))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
