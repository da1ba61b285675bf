"""(key, owner) pairs packed into one row per receiving task, so that a pair costs a few bytes in a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SCHEMA = "task int, owners binary, runs binary, keys binary"


def pack(keys: np.ndarray, owners: np.ndarray, task: np.ndarray, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Rows of ``SCHEMA``: the keys for a task, and their owners as runs of equal ones."""
    order = np.argsort(task, kind="stable")  # pairs of one owner stay together within a task
    keys, owners, task = keys[order], owners[order], task[order]
    cuts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]])) if len(task) else np.zeros(1, np.int64)
    out: list[tuple] = []
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = owners[s:e]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out.append((int(task[s]), own[new].tobytes(), np.diff(np.append(new, e - s)).astype(np.uint32).tobytes(),
                    keys[s:e].tobytes()))
        if len(out) == rows:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["task", "owners", "runs", "keys"])


def unpack(table: pa.Table, width: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of all rows of a task; keys of another width than 8 come as rows of bytes."""
    raw, owners = [], [np.zeros(0, np.int64)]
    for o, r, k in zip(*(table.column(c).to_pylist() for c in ("owners", "runs", "keys"))):
        owners.append(np.repeat(np.frombuffer(o, np.int64), np.frombuffer(r, np.uint32)))
        raw.append(k)
    keys = np.frombuffer(b"".join(raw), np.uint64 if width == 8 else np.uint8)
    return keys if width == 8 else keys.reshape(-1, width), np.concatenate(owners)
