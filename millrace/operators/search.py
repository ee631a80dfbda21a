"""Exact filtered nearest-neighbour search for a table of requests.

``requests``: request_id, vector, k and optional filters; NULL means "any":
    family      one of FAMILIES: the chunk has a key of this kind
    codes       that key is one of these
    countries   the text holds one of these, case-insensitive
    start_year, end_year   both given: year_key in this range, inclusive
    lists       the chunk is in one of these index lists (see ``ivf``)

No pair of request and chunk becomes a row.  Chunks stay where they are scanned;
each task scores Arrow batches against all requests with matrix products, one per
distinct filter, and keeps only the best k per request, so what is shuffled is k
rows per request and task.  Products are in single precision first; those that may be among
the best k are made again in double precision, so the result is that of the latter alone.
Requests are shipped to the tasks only while their number is under ``request_limit`` and
their size under REQUEST_BYTES.  Beyond that they are counted and go in larger blocks, two at
a time: each block is one scan of the chunks, and its best k are written.
Chunks are neither shuffled nor copied for any number of requests.

Similarities are rounded to nine places, and equal ones ordered by id, so results
do not depend on the order of summation.  A zero vector has no similarity and
never ranks.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.rows import top_per_key
from millrace.session import scratch_path, side_by_side, stable

FAMILIES = {
    "socioeconomic": "socio_indicator_key",
    "asset": "asset_key",
    "realestate": "realestate_indicator_key",
}
DIGITS = 9
REQUEST_LIMIT = 4096
REQUEST_BYTES = 256 << 20
BLOCK = 32  # times the limit that a block may hold once the requests are counted
BUCKET_ROWS = 50_000
TILE = 512  # requests scored at once, and the chunks they meet: both bound the score matrix
WIDTH = 512
GATHER_ROWS, GATHER_BYTES = 32_768, 32 << 20

_OPTIONAL = {
    "family": "string", "codes": "array<string>", "countries": "array<string>",
    "start_year": "int", "end_year": "int", "lists": "array<int>",
}
_HITS = "request_id {rid}, id {cid}, similarity double, k int"


def _matrix(column) -> np.ndarray:
    """List column to (n, dim) doubles without a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / length  # NaN for a zero vector


class _Tile:
    """Requests of one filter that are scored together, and the best k of each so far."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, k: np.ndarray):
        self.rows, self.vectors, self.k = rows, vectors, k
        self.rough = vectors.astype(np.float32)
        # No product in single precision is further from the true one, for vectors of length 1.
        self.margin = (vectors.shape[1] + 8) * 2.0 ** -24 + 10.0 ** -DIGITS
        self.width = max(WIDTH, TILE * WIDTH // len(rows))
        # What a chunk must reach: the k-th best so far, and of equal ones a smaller id.
        self.floor = np.full(len(rows), -np.inf)
        self.last = None
        self.bar = self.floor.astype(np.float32)
        self.held = None  # places in ``rows``, scores and ids, at most k of each place
        self.new: list = []
        self.waiting = 0


class _Scorer:
    """Running best-k per request over batches of chunks."""

    def __init__(self, requests: pa.Table):
        self.ids = requests.column("request_id")
        self.k = np.array([k or 0 for k in requests.column("k").to_pylist()], dtype=np.int64)
        vectors = _unit(_matrix(requests.column("vector")))
        groups: dict = {}
        columns = [requests.column(c).to_pylist() for c in _OPTIONAL]
        asks = (self.k > 0) & ~np.isnan(vectors).any(axis=1) if len(vectors) else np.zeros(0, dtype=bool)
        for row, (family, codes, countries, first, last, lists) in enumerate(zip(*columns)):
            if not asks[row]:
                continue  # nothing is asked for, or a zero vector
            years = (first, last) if first is not None and last is not None else None
            key = (
                family, frozenset(codes) if codes is not None else None,
                frozenset(c.lower() for c in countries) if countries else None, years,
                frozenset(lists) if lists is not None else None,
            )
            groups.setdefault(key, []).append(row)
        self.groups = {}
        for key, rows in groups.items():
            cuts = [np.array(rows[start:start + TILE]) for start in range(0, len(rows), TILE)]
            self.groups[key] = [_Tile(cut, vectors[cut], self.k[cut]) for cut in cuts]
        self.scores = np.empty(0, dtype=np.float32)

    @staticmethod
    def _tests(batch):
        """A function from filter key to mask that computes each condition once per batch."""
        done: dict = {}

        def once(key, compute) -> np.ndarray:
            if key not in done:
                done[key] = pc.fill_null(compute(), False).to_numpy(zero_copy_only=False)
            return done[key]

        def among(column, values, kind):
            return pc.is_in(batch.column(column), pa.array(sorted(values), kind))

        def between(first, last):
            column = batch.column("year_key")
            return pc.and_(pc.greater_equal(column, first), pc.less_equal(column, last))

        def mentions(term):
            if "text" not in done:
                done["text"] = pc.utf8_lower(batch.column("text"))
            return pc.match_substring(done["text"], term)

        def mask(key) -> np.ndarray:
            family, codes, countries, years, lists = key
            kept = np.ones(batch.num_rows, dtype=bool)
            if family is not None:
                name = FAMILIES[family]
                kept &= once(
                    (name, codes),
                    lambda: pc.is_valid(batch.column(name)) if codes is None else among(name, codes, pa.string()),
                )
            if years is not None:
                kept &= once(("years", years), lambda: between(*years))
            if lists is not None:
                kept &= once(("lists", lists), lambda: among("list_id", lists, pa.int32()))
            if countries is not None:
                found = [once(("term", term), lambda term=term: mentions(term)) for term in countries]
                kept &= np.logical_or.reduce(found)
            return kept

        return mask

    def add(self, batch) -> None:
        if batch.num_rows == 0 or not self.groups:
            return
        vectors = _unit(_matrix(batch.column("embedding")))
        ids = batch.column("id").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) \
            else batch.column("id").to_numpy()
        usable = ~np.isnan(vectors).any(axis=1)
        rough = vectors.astype(np.float32)
        mask_of = self._tests(batch)
        for key, tiles in self.groups.items():
            found = np.flatnonzero(mask_of(key) & usable)
            if not len(found):
                continue
            matching = rough[found]
            for tile in tiles:
                for start in range(0, len(found), tile.width):
                    at = found[start:start + tile.width]
                    self._score(tile, matching[start:start + tile.width], at, vectors, ids)
                if tile.waiting:
                    self._merge(tile)

    def _score(self, tile: _Tile, rough: np.ndarray, at: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        """Find the chunks ``at`` that may be among the best of a request of the tile.

        Products in single precision tell which cannot be, by more than their error; only the
        others are multiplied in double precision, and what they give is exact.
        """
        n, m = len(tile.rows), len(at)
        if len(self.scores) < n * m:
            self.scores = np.empty(n * m, dtype=np.float32)
        scores = np.matmul(tile.rough, rough.T, out=self.scores[:n * m].reshape(n, m))
        rows = np.flatnonzero(scores.max(axis=1) >= tile.bar)
        if not len(rows):
            return
        near, bar = scores[rows], tile.bar[rows]
        # Where nothing is known yet, the k-th best of these chunks is what the others must reach.
        open_ = np.flatnonzero((bar == -np.inf) & (tile.k[rows] <= m))
        if len(open_):
            k = tile.k[rows[open_]]
            most = int(k.max())
            top = np.sort(np.partition(near[open_], m - most, axis=1)[:, m - most:], axis=1)
            bar[open_] = top[np.arange(len(open_)), most - k] - 2 * tile.margin
        place, chunk = np.divmod(np.flatnonzero(near >= bar[:, None]), m)
        if len(place) * 16 > near.size:  # many equal ones: a product of all is less work
            exact = (tile.vectors[rows] @ vectors[at].T)[place, chunk]
        else:
            exact = np.einsum("ij,ij->i", tile.vectors[rows[place]], vectors[at[chunk]])
        place, found, exact = rows[place], ids[at[chunk]], np.round(exact, DIGITS)
        floor = tile.floor[place]
        better = exact > floor
        if tile.last is not None:
            better |= (exact == floor) & (found < tile.last[place])
        if better.any():
            tile.new.append((place[better], exact[better], found[better]))
            tile.waiting += int(better.sum())
            if tile.waiting > 4 * n:
                self._merge(tile)

    def _merge(self, tile: _Tile) -> None:
        place, scores, ids = (np.concatenate(x) for x in zip(*tile.new))
        tile.new, tile.waiting = [], 0
        self._keep(tile.rows[np.unique(place)], tile, place, scores, ids)

    def _keep(self, rows: np.ndarray, tile: _Tile, place: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Put what was found for ``rows`` among their best, and cut each at its k-th."""
        rest = None
        if tile.held is not None:
            again = np.isin(tile.rows, rows)[tile.held[0]]
            rest = [x[~again] for x in tile.held]
            place, scores, ids = (np.concatenate([x[again], y]) for x, y in zip(tile.held, (place, scores, ids)))
        order = np.lexsort((ids, -scores, place))
        place, scores, ids = place[order], scores[order], ids[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        rank = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
        kept = rank < tile.k[place]
        place, scores, ids, rank = place[kept], scores[kept], ids[kept], rank[kept]
        full = rank == tile.k[place] - 1
        if tile.last is None:
            tile.last = np.empty(len(tile.rows), dtype=ids.dtype)
        tile.floor[place[full]], tile.last[place[full]] = scores[full], ids[full]
        tile.bar[place[full]] = scores[full] - tile.margin
        tile.held = [place, scores, ids] if rest is None else [np.concatenate(x) for x in zip(rest, (place, scores, ids))]

    @property
    def best(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Scores and ids of each request, best first."""
        out = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in range(len(self.ids))]
        for tile in self._tiles():
            place, scores, ids = tile.held
            for i in np.unique(place):
                own = np.flatnonzero(place == i)
                own = own[np.lexsort((ids[own], -scores[own]))]
                out[tile.rows[i]] = scores[own], ids[own]
        return out

    def _tiles(self) -> list[_Tile]:
        return [tile for tiles in self.groups.values() for tile in tiles if tile.held is not None]

    def result(self, schema: pa.Schema) -> pa.Table:
        tiles = self._tiles()
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
        rows = joined([tile.rows[tile.held[0]] for tile in tiles], np.int64)
        scores = joined([tile.held[1] for tile in tiles], np.float64)
        ids = joined([tile.held[2] for tile in tiles], np.int64)
        return pa.table([self.ids.take(pa.array(rows)), ids, scores, self.k[rows]], names=schema.names).cast(schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together, as a product of few rows costs more a row."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GATHER_ROWS or size >= GATHER_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _best(hits: DataFrame, salts: int = 0) -> DataFrame:
    """The k best hits of each request, ranked."""
    return top_per_key(hits, ["request_id"], [F.desc("similarity"), F.asc("id")], "k", salts=salts)


def _prepare(requests: DataFrame) -> DataFrame:
    have = set(requests.columns)
    optional = [
        (F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in _OPTIONAL.items()
    ]
    k = F.col("k").cast("int").alias("k")
    return requests.select("request_id", F.col("vector").cast("array<double>").alias("vector"), k, *optional)


def search(
    requests: DataFrame, chunks: DataFrame, where: Column | None = None,
    request_limit: int = REQUEST_LIMIT,
) -> DataFrame:
    """(request_id, id, similarity, rank): the k most similar chunks of each request.

    ``where`` is a condition common to all requests; it reaches the scan.
    """
    wanted = _prepare(requests)
    if where is not None:
        chunks = chunks.filter(where)
    # One row over the limit tells that there are more; never more than that is fetched.
    head = wanted.limit(request_limit + 1).toArrow()
    ships = head.num_rows <= request_limit and head.nbytes <= REQUEST_BYTES
    some = head if ships else wanted.filter(F.size("countries") > 0).limit(1).toArrow()
    has_countries = any(v.as_py() for v in some.column("countries"))
    has_lists = "list_id" in chunks.columns
    # The long text is only read when some request filters on it.
    columns = ["id", "embedding", "year_key", *FAMILIES.values()]
    columns += ["text"] if has_countries else []
    columns += ["list_id"] if has_lists else []
    scanned = chunks.filter(F.col("embedding").isNotNull()).select(*columns)
    types = dict(requests.dtypes), dict(chunks.dtypes)
    schema = _HITS.format(rid=types[0]["request_id"], cid=types[1]["id"])
    if not ships:
        best = _blocks(scanned, wanted, request_limit, schema)
    else:
        # Where nothing is asked no chunk is read.
        partial = _scan(scanned, head, schema) if head.num_rows else chunks.sparkSession.createDataFrame([], schema)
        salts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        best = _best(partial, salts)
    return best.select("request_id", "id", "similarity", "rank")


def _arrow_schema(schema: str, session) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(session.createDataFrame([], schema).schema)


def _scan(chunks: DataFrame, requests: pa.Table, schema: str) -> DataFrame:
    spark = chunks.sparkSession
    shipped = spark.sparkContext.broadcast(requests)
    out = _arrow_schema(schema, spark)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shipped.value)
        for batch in _gathered(batches):
            scorer.add(batch)
        yield from scorer.result(out).to_batches()

    return chunks.mapInArrow(score, schema)


def search_lists(index: DataFrame, probes: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """As ``search``, but every request meets only the chunks of its own lists.

    ``probes`` are requests with one ``list_id`` a row.  Requests and chunks meet by an
    equi-join on the list; a list of more than ``bucket_rows`` chunks is split, so a hot
    list is many tasks.
    """
    spark = index.sparkSession
    named = ["request_id", "vector", "k", *[c for c in _OPTIONAL if c != "lists"]]
    # Carried through as the one list of the row, then cleared: the join has applied it.
    wanted = _prepare(probes.withColumn("lists", F.array("list_id"))).select(*named, F.col("lists")[0].alias("list_id"))
    wanted = wanted.withColumn("lists", F.lit(None).cast("array<int>"))
    columns = ["id", "embedding", "year_key", *FAMILIES.values(), "list_id"]
    columns += ["text"] if "countries" in probes.columns else []
    scanned = index.filter(F.col("embedding").isNotNull()).select(*columns)
    types = dict(probes.dtypes), dict(index.dtypes)
    schema = _HITS.format(rid=types[0]["request_id"], cid=types[1]["id"])
    out = _arrow_schema(schema, spark)
    # A row per list, a number fixed when the index was built; without the mark the vectors are shuffled by list twice.
    sizes = F.broadcast(scanned.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("_parts")))
    left = scanned.join(sizes, "list_id").withColumn("_bucket", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")).drop("_parts")
    right = wanted.join(sizes, "list_id").withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")

    def score(block: pa.Table, some: pa.Table) -> pa.Table:
        scorer = _Scorer(some)
        for batch in block.to_batches(max_chunksize=10_000):
            scorer.add(batch)
        return scorer.result(out)

    meet = ["list_id", "_bucket"]
    partial = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(score, schema)
    return _best(partial).select("request_id", "id", "similarity", "rank")


def _blocks(chunks: DataFrame, requests: DataFrame, request_limit: int, schema: str) -> DataFrame:
    """Too many requests to ship unseen: a scan of the chunks for each block of them, and its best k written.

    A block holds more than ``request_limit``, as number and size are known here: the fewer blocks,
    the fewer times the chunks are read.
    """
    spark = chunks.sparkSession
    asked = stable(requests)
    # Bytes of a request: its vector, what else it may name, and the best it finds.
    named = F.size(F.array_compact(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("codes", "countries")])))
    size = 64 + 8 * F.greatest(F.size("vector"), F.lit(0)) + 64 * named + 4 * F.greatest(F.coalesce(F.size("lists"), F.lit(0)), F.lit(0))
    size = size + 16 * F.greatest(F.lit(0), F.least(F.coalesce("k", F.lit(0)), F.lit(4096)))
    n, total = asked.agg(F.count(F.lit(1)), F.sum(size)).first()
    # Twice as many as fit on average, so that none is over the limit by chance; two blocks are on their way at a time.
    blocks = max(2, -(-2 * n // (BLOCK * request_limit)), -(-4 * int(total or 0) // REQUEST_BYTES))
    number = F.pmod(F.xxhash64("request_id"), F.lit(blocks))
    path = scratch_path(spark, "hits")

    def answer(block: int) -> None:
        head = asked.filter(number == block).toArrow()
        if head.num_rows:
            # A task gives k of a request at most, so the rows of one are few.
            _best(_scan(chunks, head, schema)).write.parquet(f"{path}/{block}")

    side_by_side(spark, {str(block): lambda block=block: answer(block) for block in range(blocks)}, most=2)
    return spark.read.schema(f"{schema}, rank int").option("recursiveFileLookup", "true").parquet(path)
