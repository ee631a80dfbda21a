"""Product codes of vectors, entries found by a geometric near-neighbour access tree (GNAT).

A vector's components become whole numbers floor(4096 * x) and are cut into equal
consecutive parts.  Each part position has a codebook, trained by rounds of assigning
every part to its nearest entry and moving each entry to its parts' floored mean.

The nearest entry is found through a GNAT over the entries.  A node holds split points;
every other entry belongs to its nearest split point, and for each split point and each
child the tree keeps the range of distances from the one to the other's members.  A
query's distance to one split point then rules out whole children: a child whose range
lies beyond what the best distance so far can reach is left without looking at it.
Ranges and radii are floating point, rounded outwards, and only strict inequality rules
out, so an entry at an equal distance is never lost; candidates are compared by exact
integer squared distances, ties to the lower index.

Training passes over the data once a round; a task returns sums and counts per entry,
so what reaches the driver is bounded by the codebooks and not by the data.

Rows left out: a null vector, null or non-finite components, and vectors whose length is
not that of the usable vector with the smallest key (a length counts as usable if it is a
positive multiple of ``parts``).  A null key comes after all others; equal keys are
ordered by their vectors.  With fewer rows than entries the codebooks are shorter; an
empty table gives an empty result.  A component beyond 2**26 after scaling raises an
error, since distances could leave 64 bits.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
FAN = 4
LARGEST = 1 << 26
_OUT = 1 + 2.0**-48


def _root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


class Gnat:
    """Tree over the rows of an integer matrix; ``nearest`` is exact, ties to the lower row."""

    def __init__(self, entries: np.ndarray, fan: int = FAN):
        self.entries = np.asarray(entries, np.int64)
        self.fan = fan
        self.looked = 0  # distances computed so far
        self.top = self._build(np.arange(len(self.entries)))

    def _square(self, rows: np.ndarray, entry: int) -> np.ndarray:
        self.looked += len(rows)
        return ((rows - self.entries[entry]) ** 2).sum(1)

    def _build(self, members: np.ndarray):
        if len(members) <= self.fan:
            return members
        points = self.entries[members]
        # Split points far from each other: each next one is the farthest from those chosen.
        splits, far = [0], ((points - points[0]) ** 2).sum(1)
        while len(splits) < self.fan and far.max() > 0:
            splits.append(int(far.argmax()))
            far = np.minimum(far, ((points - points[splits[-1]]) ** 2).sum(1))
        if len(splits) == 1:
            return members  # all equal
        square = ((points[:, None, :] - points[None, splits, :]) ** 2).sum(2)
        owner = square.argmin(1)
        owner[splits] = np.arange(len(splits))
        reach = _root(square)
        low, high = np.empty((len(splits), len(splits))), np.empty((len(splits), len(splits)))
        children = []
        for j, s in enumerate(splits):
            held = np.flatnonzero(owner == j)
            low[:, j], high[:, j] = reach[held].min(0) / _OUT, reach[held].max(0) * _OUT
            children.append(self._build(members[held[held != s]]))
        return members[splits], low, high, children

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for every row."""
        best = np.full(len(rows), np.iinfo(np.int64).max)
        entry = np.full(len(rows), len(self.entries))
        self._search(self.top, rows, np.arange(len(rows)), best, entry)
        return entry, best

    def _offer(self, rows, at, k, best, entry) -> np.ndarray:
        square = self._square(rows[at], k)
        better = (square < best[at]) | ((square == best[at]) & (k < entry[at]))
        best[at[better]], entry[at[better]] = square[better], k
        return square

    def _search(self, node, rows, at, best, entry) -> None:
        if not len(at):
            return
        if isinstance(node, np.ndarray):
            for k in node:
                self._offer(rows, at, int(k), best, entry)
            return
        splits, low, high, children = node
        alive = np.ones((len(at), len(splits)), bool)
        for i, k in enumerate(splits):
            here = np.flatnonzero(alive[:, i])
            if not len(here):
                continue
            far = _root(self._offer(rows, at[here], int(k), best, entry))
            radius = _root(best[at[here]]) * _OUT
            for j in range(len(splits)):
                if j != i:
                    beyond = (far / _OUT > (radius + high[i, j]) * _OUT) | ((far + radius) * _OUT * _OUT < low[i, j])
                    alive[here[beyond], j] = False
        for j, child in enumerate(children):
            self._search(child, rows, at[alive[:, j]], best, entry)


@dataclass
class Codebooks:
    """``entries``: part position x entry x component, whole numbers."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The scaled vectors that rows of entry numbers stand for."""
        return np.concatenate([self.entries[p][codes[:, p]] for p in range(len(self.entries))], axis=1)


def _usable(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0) & (F.size(vector) % parts == 0), F.lit(False))


def _whole(column: pa.Array, size: int) -> np.ndarray:
    """Rows of scaled whole numbers from a list array without nulls and of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.floor(flat * SCALE)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST // SCALE}: its squared distances do not fit 64 bits")
    return flat.astype(np.int64).reshape(-1, size)


def _kept(df: DataFrame, vector: str, size: int, parts: int) -> DataFrame:
    return df.filter(_usable(F.col(vector), parts) & (F.size(vector) == size))


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks started from the ``entries`` smallest keys and trained on all rows; None without a usable row."""
    narrow = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")).filter(_usable(F.col("vector"), parts))
    order = [F.col("key").asc_nulls_last(), "vector"]
    first = narrow.orderBy(*order).limit(1).collect()
    if not first:
        return None
    size = len(first[0]["vector"])
    narrow = narrow.filter(F.size("vector") == size)
    start = narrow.orderBy(*order).limit(entries).collect()
    start = _whole(pa.array([r["vector"] for r in start]), size)
    books = np.ascontiguousarray(start.reshape(len(start), parts, size // parts).transpose(1, 0, 2))

    for _ in range(rounds):
        def sums(batches, books=books):
            trees = [Gnat(b) for b in books]
            total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                rows = _whole(batch.column(0), size).reshape(-1, *books.shape[::2])
                for p, tree in enumerate(trees):
                    nearest, _ = tree.nearest(rows[:, p])
                    np.add.at(total[p], nearest, rows[:, p])
                    count[p] += np.bincount(nearest, minlength=books.shape[1])
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "total"])

        found = narrow.select("vector").mapInArrow(sums, "part int, entry int, n bigint, total array<bigint>")
        found = found.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
        found = found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(28,0)")).alias("x")).collect()
        books = books.copy()
        for r in found:
            books[r["part"], r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return Codebooks(books)


def encode(df: DataFrame, model: Codebooks, vector: str = "embedding", name: str = "code", carry: list[str] | None = None) -> DataFrame:
    """The usable rows of ``df`` with a struct ``name``: ``entries`` (one number per part) and ``error``.

    ``error`` is the squared distance to the entries, summed over parts.  ``carry`` names
    the columns to return (default all); a column called ``name`` is replaced.
    """
    parts, _, width = model.entries.shape
    size = parts * width
    names = [c for c in (carry if carry is not None else df.columns) if c.lower() != name.lower()]
    made = T.StructType.fromDDL("entries array<int>, error bigint")
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(name, made)])
    books = model.entries

    def run(batches):
        trees = [Gnat(b) for b in books]
        for batch in batches:
            rows = _whole(batch.column(len(names)), size).reshape(-1, parts, width)
            codes, error = np.empty((len(rows), parts), np.int32), np.zeros(len(rows), np.int64)
            for p, tree in enumerate(trees):
                codes[:, p], square = tree.nearest(rows[:, p])
                error += square
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * parts), pa.array(codes.ravel()))
            struct = pa.StructArray.from_arrays([flat, pa.array(error)], names=["entries", "error"])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + [struct], names=names + [name])

    kept = _kept(df, vector, size, parts)
    return kept.select(*[f"`{c}`" for c in names], F.col(vector).cast("array<double>").alias("__vector")).mapInArrow(run, schema)
