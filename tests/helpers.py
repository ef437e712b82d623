"""Test helpers: micro-batches as files, rows as sorted tuples."""

from __future__ import annotations

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq


def write_batches(folder: str, batches: list[list[dict]], schema: pa.Schema) -> str:
    """One parquet file per micro-batch, with increasing modification times so a file
    stream with ``maxFilesPerTrigger=1`` reads them in order."""
    os.makedirs(folder, exist_ok=True)
    t0 = time.time() - 10_000
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"b{i:04d}.parquet")
        pq.write_table(pa.Table.from_pylist(rows, schema=schema), path)
        os.utime(path, (t0 + i, t0 + i))
    return folder


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
