"""Whole groups from the sorted Arrow batches of a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches, key: str) -> Iterator[pa.Table]:
    """One table per run of equal ``key`` values (a non-null integer column); runs may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        if held and keys[0] != last:
            yield pa.Table.from_batches(held)
            held = []
        at, last = 0, keys[-1]
        for cut in np.flatnonzero(keys[1:] != keys[:-1]) + 1:
            held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches, key: str, least: int) -> Iterator[pa.Table]:
    """Tables of ``least`` rows or more (but the last) that hold whole runs of equal ``key`` values."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if len(changes):
            cut = int(changes[-1]) + 1
            yield table.slice(0, cut)
            held, rows = table.slice(cut).to_batches(), len(keys) - cut
    if rows:
        yield pa.Table.from_batches(held)
