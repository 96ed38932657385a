"""Published datasets as files of their own."""

from __future__ import annotations

from pathlib import Path

from factview.operators.normalize import total_order
from factview.operators.writers import write_file, write_folder
from factview.plans.manifest import Dataset
from factview.store.snapshot import Store


def export_parquet(store: Store, dataset: Dataset | str, path: str | Path, *, single_file: bool = True, ordered: bool = False) -> int:
    """The dataset's rows; DatasetNotPublished before anything is written. Without ``single_file`` a folder, in parallel."""
    rows = store.relation(dataset)
    rows = total_order(rows) if ordered else rows
    return write_file(rows, path) if single_file else write_folder(rows, str(path))
