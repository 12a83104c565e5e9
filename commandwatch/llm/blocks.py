"""Keys that groups of documents exchange through blocks of an index.

A group sends each of its distinct keys once, packed, one row for each block; a block has all
keys of a range of hashes, and answers each group that sent it something.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def dealt(keys: np.ndarray, values: np.ndarray | None, group: int, n_blocks: int) -> pa.Table:
    """Sorted keys as one row for each block, with packed keys and values."""
    block = (keys >> np.uint64(16)) % np.uint64(n_blocks)
    order = np.argsort(block, kind="stable")
    numbers, starts = np.unique(block[order], return_index=True)
    keys = keys[order]
    rows: dict[str, list] = {"block": numbers.astype(np.int64).tolist(), "group": [group] * len(numbers)}
    rows["keys"] = [part.tobytes() for part in np.split(keys, starts[1:])] if len(numbers) else []
    if values is not None:
        rows["values"] = [part.tobytes() for part in np.split(values[order], starts[1:])] if len(numbers) else []
    kinds = {"block": pa.int64(), "group": pa.int64(), "keys": pa.binary(), "values": pa.binary()}
    return pa.table({c: pa.array(v, kinds[c]) for c, v in rows.items()})


def packed(table: pa.Table, column: str, kind: type) -> np.ndarray:
    parts = [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def shared_keys(table: pa.Table) -> pa.Table:
    """For each group, its keys that another group has too."""
    keys, counts = np.unique(packed(table, "keys", np.uint64), return_counts=True)
    shared = keys[counts > 1]
    groups, answers = [], []
    for group, sent in zip(table.column("group").to_pylist(), table.column("keys").to_pylist(), strict=True):
        own = np.frombuffer(sent, np.uint64)
        if len(own := own[np.isin(own, shared, assume_unique=True)]):
            groups.append(group)
            answers.append(own.tobytes())
    return pa.table({"group": pa.array(groups, pa.int64()), "keys": pa.array(answers, pa.binary())})


def summed_keys(table: pa.Table) -> pa.Table:
    """For each group, its keys that another group has too, with the sum of all values."""
    sizes = [len(x) // 8 for x in table.column("keys").to_pylist()]
    keys, which, rows = np.unique(packed(table, "keys", np.uint64), return_inverse=True, return_counts=True)
    sums = np.bincount(which, weights=packed(table, "values", np.uint32), minlength=len(keys)).astype(np.uint32)
    groups, answers, values = [], [], []
    for group, own in zip(table.column("group").to_pylist(), np.split(which, np.cumsum(sizes)[:-1]), strict=True):
        if len(own := own[rows[own] > 1]):
            groups.append(group)
            answers.append(keys[own].tobytes())
            values.append(sums[own].tobytes())
    return pa.table({"group": pa.array(groups, pa.int64()), "keys": pa.array(answers, pa.binary()), "values": pa.array(values, pa.binary())})
