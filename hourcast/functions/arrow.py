"""List columns of Arrow batches as numpy arrays, and back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Cells of rows that are added up together.
TOTALS_CELLS = 1 << 15


def lists(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column end to end, and where each list starts."""
    column = part.column(name)
    at = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    return values, at - at[0]


def matrix(part: pa.RecordBatch, name: str, precision: str = "float64") -> np.ndarray:
    """A list column whose lists are all of one length, one row per list."""
    return lists(part, name)[0].astype(precision).reshape(part.num_rows, -1)


def list_column(rows: np.ndarray, precision: str) -> pa.ListArray:
    n, width = rows.shape
    starts = pa.array(np.arange(n + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(starts, pa.array(rows.ravel().astype(precision)))


def float_text(value: np.floating) -> str:
    """A number in the JVM's layout, `3.0` or `1.1920929E-7`: the fewest digits that read back as it."""
    if not np.isfinite(value):
        return "NaN" if np.isnan(value) else "Infinity" if value > 0 else "-Infinity"
    if value == 0 or 1e-3 <= abs(value) < 1e7:
        return np.format_float_positional(value, unique=True, trim="0")
    text = np.format_float_scientific(value, unique=True, trim="0", exp_digits=1)
    return text.replace("e+", "e").replace("e", "E")


def texts(cells: pa.Array, end: str = "") -> pa.Array:
    """Numbers as text with `end` behind, a null as `end` alone. Each different one is written once."""
    coded = cells.dictionary_encode()
    words = [float_text(v) + end for v in coded.dictionary.to_numpy(zero_copy_only=False)]
    none = pa.scalar(len(words), coded.indices.type)
    at = coded.indices.fill_null(none) if cells.null_count else coded.indices
    return pa.array([*words, end], pa.string()).take(at)


def spans(column: pa.StringArray) -> tuple[pa.Buffer, np.ndarray]:
    """All texts end to end, and where each begins; the last place is the end."""
    _, places, text = column.buffers()
    return text, np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1]


def first_cells(column: pa.ListArray, n: int) -> pa.Array:
    """The first `n` cells of every list end to end; a null list has nulls, a shorter one is an error."""
    starts = column.offsets.to_numpy()
    sizes = np.diff(starts)
    absent = np.array(column.is_null())
    if ((sizes < n) & ~absent).any():
        raise ValueError(f"a list of {sizes[~absent].min()} cells where {n} are needed")
    if (sizes == n).all() and not absent.any():
        return column.values.slice(starts[0], starts[-1] - starts[0])
    at = starts[:-1, None] + np.arange(n)
    return column.values.take(pa.array(at.ravel(), mask=np.repeat(absent, n)))


def totals(column: pa.ListArray) -> pa.Array:
    """The sum of each list, its cells added in order as doubles; null where the list or a cell is."""
    starts = column.offsets.to_numpy()
    sizes, starts = np.diff(starts), starts[:-1]
    if len(sizes) and sizes[0] and not column.null_count and (sizes == sizes[0]).all():
        cells = column.values.slice(starts[0], len(sizes) * sizes[0])
        if not cells.null_count:
            return pa.array(_row_totals(cells.to_numpy().reshape(-1, sizes[0])))
    values = column.values.to_numpy(zero_copy_only=False)
    absent = column.values.is_null().to_numpy(zero_copy_only=False)
    out = np.zeros(len(column))
    missing = np.array(column.is_null())
    # One place of every list at a time.
    for k in range(sizes.max(initial=0)):
        rows = np.flatnonzero(sizes > k)
        at = starts[rows] + k
        out[rows] += values[at]
        if column.values.null_count:
            missing[rows] |= absent[at]
    return pa.array(out, mask=missing)


def _row_totals(rows: np.ndarray) -> np.ndarray:
    """Sums of rows whose cells are added from the first on, some rows that fit the cache at a time."""
    out = np.empty(len(rows))
    step = max(1, TOTALS_CELLS // rows.shape[1])
    for at in range(0, len(rows), step):
        # Over the first axis numpy adds whole rows one after the other, never in pairs.
        cells = rows[at : at + step].T.astype(np.float64, order="C")
        out[at : at + step] = cells.sum(axis=0) if cells.shape[1] > 1 else np.cumsum(cells)[-1]
    return out
