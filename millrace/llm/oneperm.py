"""Near-duplicate classes by one-permutation hashing and star-shaped candidate edges.

A text's set holds its runs of two words (split at blanks, A-Z lower-cased); a text of one
word has that word, a text without words none, and then no links.  Texts with equal
sets are one representative from here on, named by a number, so exact copies cost nothing.

1. One permutation.  One hash per run: its high bits name one of 128 bins, the least
   value of a bin is kept.  Optimal densification fills an empty bin from a full one found by a
   sequence of hashes of the bin's number, the same sequence for all texts, so filled
   bins of two texts agree with the probability of their similarity.
2. Banded buckets of four bins.  A pair at similarity 0.8 misses all 32 with probability
   5e-8.  Buckets with the same members count once.
3. Stars.  Each bucket links its members to the one with the smallest number: as many
   candidates as members, however large the bucket.  Candidates whose sizes exclude the
   threshold, or less than ``NEED`` of whose bins agree, go; the rest is counted on
   whole sets; a centre's set travels once per ``BLOCK`` of its members.
4. Rest.  A star says nothing about two members that are both unlike the centre.  Where the
   members of a bucket lie in several components, members outside its largest one
   are compared by bins with all others, in blocks; survivors are counted on whole sets
   in blocks too, and only a spanning forest of true links leaves a task.  So every true
   link that shares a bucket joins its ends, as if all pairs had been counted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.arrow import byte_set, grams, mix, with_result, words_of
from millrace.llm.components import components
from millrace.llm.neardup import common, roots
from millrace.session import stable

GRAM = 2
PERCENT = 80
BINS, BANDS = 128, 32
# Bins of a small set depend on each other, so their share scatters more than that of as many
# independent draws; half of the bins is beyond six deviations from 0.8 at any size.
NEED = 64
BLOCK = 256
BLOCK_GRAMS = 1_000_000
_PRINTABLE = byte_set("printable")
_WIDTH = 2 * BINS // BANDS  # bytes of a band


def run_sets(data: np.ndarray, offsets: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text number, distinct run hashes), in order of the texts."""
    words = words_of(data, offsets, _PRINTABLE, lower=True)
    at, value = grams(words, n)
    owner, values = [words.doc[at]], [value]
    for k in range(1, n):
        at, value = grams(words, k)
        whole = words.per_doc[words.doc[at]] == k
        owner.append(words.doc[at[whole]])
        values.append(value[whole])
    owner, value = np.concatenate(owner), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def densified(bins: np.ndarray, full: np.ndarray) -> np.ndarray:
    """``bins`` (texts x BINS) with every empty bin filled from a full one of its row.

    The t-th try of bin b looks at one bin that depends on b and t alone; a row needs one full bin.
    """
    out = bins.copy()
    row, at = np.nonzero(~full)
    t = 0
    while len(row):
        t += 1
        look = (mix(np.arange(BINS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t)) >> np.uint64(64 - 7)).astype(np.int64)[at]
        found = full[row, look]
        out[row[found], at[found]] = bins[row[found], look[found]]
        row, at = row[~found], at[~found]
    return out


def signatures(data: np.ndarray, offsets: np.ndarray, n: int = GRAM) -> list:
    """Per text: set size, digest of the set, and the filled bins, 16 bits each."""
    rows = len(offsets) - 1
    owner, value = run_sets(data, offsets, n)
    cut = np.searchsorted(owner, np.arange(rows + 1))
    size = np.diff(cut).astype(np.int64)
    digest, packed = [None] * rows, [None] * rows
    some = np.flatnonzero(size)
    if len(some):
        # The hashes are spread anew: sets are sorted by the first hash, bins should not follow that order.
        spread = mix(value ^ np.uint64(0x94D049BB133111EB))
        place = np.searchsorted(some, owner) * BINS + (spread >> np.uint64(57)).astype(np.int64)
        low = np.full(len(some) * BINS, 1 << 32, np.int64)
        np.minimum.at(low, place, (spread & np.uint64(0xFFFFFFFF)).astype(np.int64))
        low = low.reshape(len(some), BINS)
        full = low < 1 << 32
        # A kept value is small where a bin holds many, so its bits are spread before 16 are kept.
        short = (mix(densified(low, full).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
        for k, i in enumerate(some):
            digest[i] = hashlib.blake2b(value[cut[i]:cut[i + 1]].tobytes(), digest_size=16).hexdigest()
            packed[i] = short[k].tobytes()
    return [size, pa.array(digest, pa.string()), pa.array(packed, pa.binary())]


def _bins(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BINS)


def _agreeing(batches, need: int):
    """Candidate edges (a, b, sa, sb) whose bins agree often enough."""
    for batch in batches:
        keep = (_bins(batch.column("sa")) == _bins(batch.column("sb"))).sum(1) >= need
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])


def _groups(batches, keys: list[str]):
    """Tables of the rows with equal ``keys`` (whole numbers), from batches sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys], 1)
        cuts = np.concatenate([[0], np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1, [batch.num_rows]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            now = tuple(values[low])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray):
    label = roots(len(ids), i, j)
    far = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[far], pa.int64()), pa.array(ids[label[far]], pa.int64())], names=["a", "b"])


def _count_stars(batches, percent: int):
    """True links of each centre, row by row: a group's first row is the centre's own."""
    key, centre = None, None
    for batch in batches:
        a, block, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "block", "b"))
        out = []
        for k, held in enumerate(batch.column("runs")):
            runs = np.frombuffer(held.as_py(), np.uint64)
            if (a[k], block[k]) != key:
                key, centre = (a[k], block[k]), runs
                continue
            both = len(np.intersect1d(centre, runs, assume_unique=True))
            if 100 * both >= percent * (len(centre) + len(runs) - both):
                out.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(a[out], pa.int64()), pa.array(b[out], pa.int64())], names=["a", "b"])


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a group in two sides, the same for a block with itself; a member that came twice counts once."""
    _, once = np.unique(np.stack([group["id"].to_numpy(), group["block"].to_numpy()], 1), axis=0, return_index=True)
    first, second = group["first"][0].as_py(), group["second"][0].as_py()
    block = group["block"].to_numpy()[once]
    return (once, once) if first == second else (once[block == first], once[block == second])


def _pairs(group: pa.Table, need: int):
    """(ids, i, j): pairs of the group's sides in different components whose bins agree often enough."""
    left, right = _sides(group)
    if not len(left) or not len(right):
        return None
    sig, comp, ids = _bins(group["sig"]), group["comp"].to_numpy(), group["id"].to_numpy()
    equal = np.zeros((len(left), len(right)), np.int16)
    for k in range(BINS):
        equal += sig[left, k][:, None] == sig[right, k][None, :]
    i, j = np.nonzero((equal >= need) & (comp[left][:, None] != comp[right][None, :]))
    return (left, right, ids, left[i], right[j]) if len(i) else None


def _tie(batches, keys, need: int):
    for group in _groups(batches, keys):
        found = _pairs(group, need)
        if found:
            _, _, ids, i, j = found
            yield _forest(ids, i, j)


def _count_blocks(batches, keys, need: int, percent: int):
    for group in _groups(batches, keys):
        found = _pairs(group, need)
        if not found:
            continue
        left, right, ids, i, j = found
        rows = np.unique(np.concatenate([i, j]))
        sets = [np.frombuffer(group["runs"][int(k)].as_py(), np.uint64) for k in rows]
        x, y = np.searchsorted(rows, i), np.searchsorted(rows, j)
        both = common(sets, sets, x, y)
        size = np.array([len(s) for s in sets])
        true = 100 * both >= percent * (size[x] + size[y] - both)
        if true.any():
            yield _forest(ids[rows], x[true], y[true])


def _dealt(members: DataFrame, key: str) -> DataFrame:
    """Members of a group once for each pair of blocks they take part in, sorted by (key, first, second).

    ``rest_blocks`` and ``blocks`` are counts of a group's blocks outside its largest component and
    within it; the latter are not paired with each other.
    """
    of = F.when(F.col("major"), F.col("blocks")).otherwise(F.col("rest_blocks"))
    block = F.pmod(F.xxhash64("id"), of).cast("int") + F.when(F.col("major"), F.col("rest_blocks")).otherwise(0).cast("int")
    last = F.when(F.col("major"), F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("blocks")).cast("int") - 1
    rows = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    rows = rows.filter(~(F.col("single") & (F.col("first") == F.col("second")))).drop("other", "blocks", "rest_blocks", "major", "single")
    order = [key, "first", "second"]
    return rows.repartition(*order).sortWithinPartitions(*order)


def _majors(members: DataFrame, key: str, size: str | None = None) -> DataFrame:
    """Per group of several components: its largest one, and blocks within and outside it.

    With ``size`` (runs of a member) blocks also hold at most about ``BLOCK_GRAMS`` runs.
    """
    parts = members.groupBy(key, "comp").agg(F.count("*").alias("n"), (F.sum(size) if size else F.sum(F.lit(0))).cast("long").alias("runs"))
    whole = parts.groupBy(key).agg(F.max(F.struct("n", "runs", "comp")).alias("most"), F.sum("n").alias("n"), F.sum("runs").alias("runs"), F.count("*").alias("parts"))
    blocks = lambda n, runs: F.ceil(F.greatest(n / BLOCK, runs / BLOCK_GRAMS))
    rest = F.col("n") - F.col("most.n")
    return whole.filter("parts > 1").select(
        key, F.col("most.comp").alias("largest"), blocks(F.col("most.n"), F.col("most.runs")).alias("blocks"),
        blocks(rest, F.col("runs") - F.col("most.runs")).alias("rest_blocks"), (rest == 1).alias("single"))


def _first_only(batches):
    """Of rows with the same id (equal rows of the table) one per task."""
    seen: set[int] = set()
    for batch in batches:
        ids = batch.column("id").to_pylist()
        keep = []
        for i in ids:
            keep.append(i not in seen)
            seen.add(i)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _with_runs(texts: DataFrame, reps: DataFrame, ids: DataFrame, gram: int) -> DataFrame:
    """(id, runs): whole sets of the representatives in ``ids``, written."""
    wanted = reps.join(ids, "id", "left_semi").select("id", "text_key", F.col("key").alias("pick_key"))
    mine = texts.join(stable(wanted), "text_key").filter(F.col("key").eqNullSafe(F.col("pick_key"))).select("id", "text")

    def sets(data, offsets):
        owner, value = run_sets(data, offsets, gram)
        cut = np.searchsorted(owner, np.arange(len(offsets)))
        return [pa.array([value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())]

    once = mine.mapInArrow(_first_only, "id bigint, text string")
    return stable(with_result(once, "text", "g", "runs binary", sets, ["id"]).select("id", "g.runs"))


def _star_edges(reps: DataFrame, close: DataFrame, percent: int, need: int) -> DataFrame:
    """Edges (a, b) from each bucket's centre to its members that sizes and bins leave possible."""
    edges = close.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    side = lambda name: reps.select(F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("sig").alias(f"s{name}"))
    edges = edges.join(side("a"), "a").join(side("b"), "b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return stable(edges.select("a", "b", "sa", "sb").mapInArrow(lambda it: _agreeing(it, need), "a bigint, b bigint"))


def _star_links(edges: DataFrame, runs: DataFrame, percent: int) -> DataFrame:
    """The true links among the edges."""
    blocks = stable(edges.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")))
    edges = edges.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").alias("block"))
    centres = blocks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    both = centres.join(runs, centres["a"] == runs["id"]).select("a", "block", F.lit(0).alias("role"), F.col("a").alias("b"), "runs").union(
        edges.join(runs, edges["b"] == runs["id"]).select("a", "block", F.lit(1).alias("role"), "b", "runs"))
    order = ["a", "block", "role"]
    both = both.repartition("a", "block").sortWithinPartitions(*order)
    return stable(both.mapInArrow(lambda it: _count_stars(it, percent), "a bigint, b bigint"))


def _rest_links(runs: DataFrame, reps: DataFrame, close: DataFrame, found: DataFrame, percent: int, need: int) -> DataFrame | None:
    """True links between members of a bucket that the stars left in different components."""
    known = lambda df: df.join(found.withColumnsRenamed({"node": "id", "root": "__root"}), "id", "left").withColumn("comp", F.coalesce("__root", "id")).drop("__root")
    sig = reps.select("id", "n", "sig")
    # A bucket of two is a star of one edge and has been compared already.
    members = stable(known(close.filter("members > 2").select("bucket", "id")))
    majors = stable(_majors(members, "bucket"))
    rest = members.join(majors, "bucket").withColumn("major", F.col("comp") == F.col("largest")).drop("largest").join(sig.drop("n"), "id")
    tied = stable(_dealt(rest, "bucket").mapInArrow(lambda it: _tie(it, ["bucket", "first", "second"], need), "a bigint, b bigint"))
    if not tied.take(1):
        return None
    clusters = known(stable(components(tied)).withColumnsRenamed({"node": "id", "root": "cluster"})).join(sig, "id")
    clusters = stable(clusters)
    majors = stable(_majors(clusters, "cluster", "n"))
    rest = clusters.join(majors, "cluster").withColumn("major", F.col("comp") == F.col("largest")).drop("largest", "n").join(runs, "id")
    return stable(_dealt(rest, "cluster").mapInArrow(
        lambda it: _count_blocks(it, ["cluster", "first", "second"], need, percent), "a bigint, b bigint"))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    ``component_id`` is the smallest key that can be reached over links (``100 * common >=
    percent * union``), ``kept`` whether it is the row's own.  A row without words (null,
    empty or blank text) has no shingles, is its own component and kept.  Keys may be null
    or repeated: rows are told apart by their sets; a component of null keys alone has a
    null id and its rows are kept.  Other columns are not read, an empty table gives an
    empty result.
    """
    need = NEED
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.md5(F.col(text)).alias("text_key"))
    made = with_result(texts, "text", "s", "n bigint, digest string, sig binary", lambda d, o: signatures(d, o, gram), ["key", "text_key"])
    rows = stable(made.select("key", "text_key", "s.*"))
    reps = rows.filter("n > 0").groupBy("digest").agg(F.min("key").alias("least"), F.min(F.struct("text_key", "key", "n", "sig")).alias("pick"))
    # Written, so the numbers stay as they are.
    reps = stable(reps.select(F.monotonically_increasing_id().alias("id"), "digest", "least", "pick.*"))

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * _WIDTH + 1, F.lit(_WIDTH))))
    members = reps.select("id", F.explode(band).alias("bucket"))
    held = members.groupBy("bucket").agg(F.count("*").alias("members"), F.min("id").alias("centre"), F.bit_xor(F.xxhash64("id")).alias("x"),
                                         F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).filter("members > 1")
    held = held.groupBy("members", "centre", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "members", "centre")
    close = stable(members.join(held, "bucket"))

    edges = _star_edges(reps, close, percent, need)
    # One pass over the texts makes the sets for both ways of counting.
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).union(close.filter("members > 2").select("id")).distinct()
    runs = _with_runs(texts, reps, ids, gram)
    found = stable(components(_star_links(edges, runs, percent)))
    more = _rest_links(runs, reps, close, found, percent, need)
    if more is not None:
        found = stable(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)))

    named = reps.select("id", "digest", "least").join(found.withColumnRenamed("node", "id"), "id", "left").select("digest", "least", F.coalesce("root", "id").alias("root"))
    ids = stable(named.groupBy("root").agg(F.min("least").alias("component")))
    named = stable(named.join(ids, "root").select("digest", "component"))
    out = rows.select("key", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("key")).alias("kept"))
