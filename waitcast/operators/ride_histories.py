"""Histories of whole rides from their counts, in numpy on Arrow batches.

A ride's counts are sorted by value once; each grain then is one stable sort of its group numbers, so no grain's rows are
shuffled, and its percentiles are looked up in one running count. Spark deals the counts by ride and sorts them by ride.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Counted rows that are gathered, over several rides, before their histories are derived.
HELD_ROWS = 1 << 18


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, int]:
    """A number from 0 for each entry, equal for equal ones (NULL is one too), and how many numbers there are."""
    d = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(d.dictionary), 1)


def _numbered(columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """One number for each combination of codes."""
    out, size = columns[0]
    for more, n in columns[1:]:
        if size * n >= 1 << 62:
            out = np.unique(out, return_inverse=True)[1].astype(np.int64)
            size = len(out)
        out, size = out * n + more, size * n
    return out


def grain_statistics(group: np.ndarray, value: np.ndarray, n: np.ndarray, shares: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(a row of each group, count, mean, deviation, percentiles) of rows in the order of ``value``, each of which stands ``n`` times."""
    order = np.argsort(group, kind="stable")
    group, v, n = group[order], value[order], n[order]
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    upto = np.cumsum(n)
    count = np.add.reduceat(n, start)
    before = upto[start] - n[start]
    least = v[start]
    x = v - np.repeat(least, np.diff(np.append(start, len(v))))
    s1, s2 = np.add.reduceat(x * n, start), np.add.reduceat(x * x * n, start)
    mean = least + s1 / count
    deviation = np.sqrt(np.maximum(0.0, (s2 - s1 * s1 / count) / np.maximum(count - 1, 1)))
    percentiles = []
    for p in shares:
        h = (count - 1) * p
        low, high = (v[np.searchsorted(upto, before + f(h).astype(np.int64), side="right")] for f in (np.floor, np.ceil))
        percentiles.append(low + (h - np.floor(h)) * (high - low))
    return order[start], count, mean, deviation, percentiles


def whole_rides(batches: Iterator[pa.RecordBatch], held_rows: int) -> Iterator[pa.Table]:
    """Batches sorted by ``_ride``, gathered to tables that end between two rides."""
    held, n = [], 0
    for b in batches:
        while n + len(b) > held_rows and n:
            last, ride = held[-1].column("_ride")[-1].as_py(), b.column("_ride").to_numpy()
            other = np.flatnonzero(ride != last)
            if not len(other):
                break
            yield pa.Table.from_batches([*held, b.slice(0, int(other[0]))])
            held, n, b = [], 0, b.slice(int(other[0]))
        if len(b):
            held.append(b)
            n += len(b)
    if held:
        yield pa.Table.from_batches(held)


def histories(batches: Iterator[pa.RecordBatch], grains: dict[str, list[str]], keys: list[str], value: str, shares: list[float],
              held_rows: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """(grain, keys, n, mean, std, percentiles) of ``grains`` from counts (_ride, keys, value, _n) sorted by ``_ride``."""
    names = ["grain", *keys, "n", "mean", "std", *[f"p{round(100 * p)}" for p in shares]]
    for t in whole_rides(batches, held_rows):
        values = t.column(value).to_numpy()
        order = np.argsort(values, kind="stable")
        values, n = values[order], t.column("_n").to_numpy()[order]
        codes = {k: (c[order], size) for k, (c, size) in ((k, _codes(t.column(k))) for k in keys)}
        with np.errstate(all="ignore"):
            for grain, own in grains.items():
                row, count, mean, deviation, percentiles = grain_statistics(_numbered([codes[k] for k in own]), values, n, shares)
                at = pa.array(order[row])
                named = [t.column(k).take(at).combine_chunks() if k in own else pa.nulls(len(at), t.schema.field(k).type) for k in keys]
                columns = [pa.array([grain], pa.string()).take(pa.array(np.zeros(len(at), np.int32))), *named, pa.array(count), pa.array(mean),
                           pa.array(deviation, mask=count < 2), *[pa.array(p) for p in percentiles]]
                yield from pa.Table.from_arrays(columns, names=names).to_batches(max_chunksize=10_000)
