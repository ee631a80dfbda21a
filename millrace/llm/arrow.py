"""Row-wise text jobs over Arrow batches, and byte-level word arithmetic in numpy.

A text column arrives in a Python worker as one UTF-8 buffer with offsets.  The
helpers here work on that buffer directly, in chunks of whole texts, so memory
follows the chunk and not the batch, and no Python object is made per word.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

CHUNK_BYTES = 2 << 20


def with_result(df: DataFrame, text: str, name: str, kind: str | T.StructType,
                job: Callable[[np.ndarray, np.ndarray], list], carry: list[str] | None = None) -> DataFrame:
    """``df`` with a struct column ``name`` computed from its text column.

    ``job(data, offsets)`` gets the bytes of some whole texts and returns one Arrow
    array or numpy array per field of ``kind``.  ``carry`` names the columns to return
    (default all).  A null text is passed as an empty one.  A column of the input that
    is called ``name`` already is replaced.
    """
    kind = kind if isinstance(kind, T.StructType) else T.StructType.fromDDL(kind)
    names = [c for c in (carry if carry is not None else df.columns) if c.lower() != name.lower()]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(name, kind)])
    needed = list(dict.fromkeys(names + [text]))
    at = {c: i for i, c in enumerate(needed)}
    fields = [f.name for f in kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(at[text])):
                out = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in job(data, offsets)]
                struct = pa.StructArray.from_arrays(out, names=fields)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part.column(at[c]) for c in names] + [struct], names=names + [name])

    return df.select(*[f"`{c}`" for c in needed]).mapInArrow(run, schema)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of whole texts of about ``limit`` bytes."""
    if len(column) == 0:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, values[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def byte_set(spec: str) -> np.ndarray:
    """256 booleans: the bytes a word is made of.  ``spec`` is 'printable' or 'letters'.

    printable: everything but space and \\t..\\r.  letters: 0-9, A-Z, a-z and every byte
    from 0x80, so that whole non-ASCII characters stay in a word.
    """
    table = np.ones(256, bool)
    if spec == "printable":
        table[9:14] = False
        table[32] = False
    elif spec == "letters":
        table[:128] = False
        for a, b in ("09", "AZ", "az"):
            table[ord(a):ord(b) + 1] = True
    else:
        raise ValueError(spec)
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_TILE = 1 << 19
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < size:
        size = max(size, 2 * _TILE)
        have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
        _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of some texts: text number, byte range and hash of each, in order."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    per_doc: np.ndarray  # words of each text
    first: np.ndarray  # number of each text's first word


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, lower: bool = False) -> Words:
    """All words of the texts.  Equal words have equal hashes; the hash does not depend on the place."""
    n, docs = len(data), len(offsets) - 1
    inside = member[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    value = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        # Prefix sums over a tile of whole words; unsigned arithmetic wraps on purpose.
        high = max(int(np.searchsorted(end, start[low] + _TILE, "right")), low + 1)
        base, stop = start[low], end[high - 1]
        part = data[base:stop]
        part = (LOWER[part] if lower else part).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _power_table(_P, len(part))[:len(part)], out=sums[1:])
        s, e = start[low:high] - base, end[low:high] - base
        value[low:high] = (sums[e] - sums[s]) * _power_table(_P_INV, len(part))[s]
        low = high
    per_doc = np.bincount(doc, minlength=docs).astype(np.int64)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_doc)])
    return Words(doc, start, end, mix(value), per_doc, first[:-1])


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of every run of ``n`` words inside one text."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(words.doc[:count] == words.doc[n - 1:])
    value = words.hash[at]
    for k in range(1, n):
        value = value * np.uint64(0xD6E8FEB86659FD93) + words.hash[at + k]
    return at, mix(value)


def sums_per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per byte, any further axes) over each text, zero for empty texts."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte, and for the end, how many characters begin before it."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
