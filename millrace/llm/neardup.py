"""Jaccard join of word n-gram sets with Bayesian candidate pruning.

A text's set holds its runs of five words (split at blanks); a text of one to four
words has one run, a text without words none, and then no links.  Texts with equal
sets are one representative with a weight from here on, so exact copies cost nothing.

1. Candidates.  128 MinHash values make 32 bands of four; representatives that share a
   band meet in a bucket.  A pair at similarity 0.8 misses all bands with probability
   5e-8.  Buckets with the same members count once.
2. Pruning.  Pairs in a bucket compare their values 16 at a time and are dropped once the
   posterior probability (uniform prior) of reaching the threshold is below ``TOLERANCE``.
   What is left only ties representatives into clusters: a spanning forest per bucket.
3. Verification.  Within a cluster, pairs are pruned the same way and the rest counted
   exactly on whole n-gram sets.  A task returns each member's number of links and a
   spanning forest of the true links, never the pairs.

A bucket or cluster of more than ``BLOCK`` members is cut into blocks by hash, and pairs
of blocks are separate groups; so is one whose sets are long in sum.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.arrow import byte_set, grams, mix, with_result, words_of
from millrace.llm.components import components
from millrace.session import stable

GRAM = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
VALUES, BANDS, STEP = 128, 32, 16
BLOCK = 256
BLOCK_GRAMS = 1_000_000
_PRINTABLE = byte_set("printable")


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram hash), in order of the texts, repeats included."""
    words = words_of(data, offsets, _PRINTABLE)
    at, value = grams(words, n)
    owner = [words.doc[at]]
    value = [value]
    for k in range(1, n):
        at, g = grams(words, k)
        whole = words.per_doc[words.doc[at]] == k
        owner.append(words.doc[at[whole]])
        value.append(g[whole])
    owner, value = np.concatenate(owner), np.concatenate(value)
    order = np.argsort(owner, kind="stable")
    return owner[order], value[order]


def _constants() -> tuple[np.ndarray, np.ndarray]:
    dice = np.random.default_rng(20)
    return dice.integers(0, 1 << 31, VALUES, np.uint32) * np.uint32(2) + np.uint32(1), dice.integers(0, 1 << 32, VALUES, np.uint32)


def signatures(data: np.ndarray, offsets: np.ndarray, n: int = GRAM) -> list:
    """Per text: set size, digest of the set, and 128 MinHash values of 16 bits."""
    rows = len(offsets) - 1
    owner, value = gram_sets(data, offsets, n)
    cut = np.searchsorted(owner, np.arange(rows + 1))
    size, digest, packed = np.zeros(rows, np.int32), [None] * rows, [None] * rows
    for i in np.flatnonzero(np.diff(cut)):
        distinct = np.unique(value[cut[i]:cut[i + 1]])
        size[i] = len(distinct)
        digest[i] = hashlib.blake2b(distinct.tobytes(), digest_size=16).hexdigest()
    full = np.flatnonzero(size)
    if len(full):
        short = (mix(value) >> np.uint64(32)).astype(np.uint32)
        out = np.empty((len(full), VALUES), np.uint16)
        work = np.empty_like(short)
        for k, (a, b) in enumerate(zip(*_constants())):
            np.multiply(short, a, out=work)
            np.add(work, b, out=work)
            out[:, k] = (np.minimum.reduceat(work, cut[full]) * np.uint32(0x9E3779B1)) >> np.uint32(16)
        for k, i in enumerate(full):
            packed[i] = out[k].tobytes()
    return [size, pa.array(digest, pa.string()), pa.array(packed, pa.binary())]


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 16, 32, ... compared values: the fewest equal ones with P(similarity >= threshold) >= tolerance.

    Under a uniform prior the posterior is Beta(m + 1, k - m + 1), and its upper tail at t
    is the probability of at most m successes in k + 1 draws at t.
    """
    out = []
    for k in range(STEP, VALUES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out.append(m)
    return out


def survivors(a: np.ndarray, b: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` (signatures) whose pairs outlive every comparison."""
    equal = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        equal += a[:, k, None] == b[None, :, k]
    keep = equal >= least[0]
    if same:
        keep &= np.tri(len(a), k=-1, dtype=bool)
    i, j = np.nonzero(keep)
    have = equal[i, j]
    for s, need in enumerate(least[1:], 1):
        have = have + (a[i, s * STEP:(s + 1) * STEP] == b[j, s * STEP:(s + 1) * STEP]).sum(1, dtype=np.int16)
        alive = have >= need
        i, j, have = i[alive], j[alive], have[alive]
    return i, j


def common(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of sorted sets, for the pairs (i, j)."""
    if len(i) <= 2 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    # Many pairs: products of 0/1 matrices, a slice of the n-grams at a time.
    flat = np.concatenate(left + right)
    universe, place = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    total = np.zeros((len(left), len(right)), np.float64)
    for low in range(0, len(universe), 4096):
        s, e = np.searchsorted(place, [low, low + 4096])
        block = np.zeros((len(left) + len(right), 4096), np.float32)
        block[owner[s:e], place[s:e] - low] = 1
        total += block[: len(left)] @ block[len(left):].T
    return np.rint(total[i, j]).astype(np.int64)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes is connected to by the links (i, j)."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            break
    return label


def _groups(batches, keys: int):
    """Rows with equal first ``keys`` columns, from batches sorted by them, as tables."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for c in range(keys):
            column = batch.column(c)
            values = np.asarray(column.to_pylist(), object) if pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.concatenate([[0], np.flatnonzero(new), [batch.num_rows]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            held.append(batch.slice(low, high - low))
            if high < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _sides(table: pa.Table):
    """Members of a group in two sides (one and the same for a block with itself), without repeats."""
    first, second = table["first"][0].as_py(), table["second"][0].as_py()
    digest, block = table["digest"].to_pylist(), table["block"].to_pylist()
    seen, left, right = set(), [], []
    for k, (d, b) in enumerate(zip(digest, block)):
        if d not in seen:
            seen.add(d)
            (left if b == first else right).append(k)
    return first == second, digest, left, left if first == second else right


def _unpack(column, rows) -> np.ndarray:
    return np.frombuffer(b"".join(column[k].as_py() for k in rows), np.uint16).reshape(len(rows), VALUES)


def _tie(batches, least):
    for group in _groups(batches, 3):
        same, digest, left, right = _sides(group)
        if len(left) + (0 if same else len(right)) < 2 or not right:
            continue
        i, j = survivors(_unpack(group["sig"], left), _unpack(group["sig"], right), same, least)
        nodes = left if same else left + right
        label = roots(len(nodes), i, j if same else j + len(left))
        far = np.flatnonzero(label != np.arange(len(nodes)))
        if len(far):
            yield pa.RecordBatch.from_arrays([pa.array([digest[nodes[k]] for k in far]), pa.array([digest[nodes[label[k]]] for k in far])], names=["a", "b"])


def _verify(batches, least, threshold):
    for group in _groups(batches, 3):
        same, digest, left, right = _sides(group)
        if len(left) + (0 if same else len(right)) < 2 or not right:
            continue
        i, j = survivors(_unpack(group["sig"], left), _unpack(group["sig"], right), same, least)
        if not len(i):
            continue
        sets = {k: np.frombuffer(group["grams"][k].as_py(), np.uint64) for k in {*left, *right}}
        ours, theirs = [sets[k] for k in left], [sets[k] for k in right]
        both = common(ours, theirs, i, j)
        union = np.array([len(ours[x]) + len(theirs[y]) for x, y in zip(i, j)]) - both
        true = both >= threshold * union - 1e-9
        i, j = i[true], j[true]
        nodes = left if same else left + right
        j2 = j if same else j + len(left)
        weight = np.array([group["weight"][k].as_py() for k in nodes], np.int64)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, weight[j2])
        np.add.at(links, j2, weight[i])
        label = roots(len(nodes), i, j2)
        rows = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array([digest[nodes[k]] for k in rows], pa.string()), pa.array(links[rows]), pa.array([digest[nodes[label[k]]] for k in rows], pa.string())],
            names=["digest", "links", "root"])


def _paired(members: DataFrame, key: str) -> DataFrame:
    """Each member once for every pair of blocks that its own block is in; sorted groups (key, first, second)."""
    block = F.pmod(F.xxhash64("digest", key), F.col("blocks")).cast("int")
    rows = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    rows = rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other", "blocks")
    order = [key, "first", "second"]
    rows = rows.select(*order, *[c for c in rows.columns if c not in order])
    return rows.repartition(*order).sortWithinPartitions(*order)


class Join:
    """The finished join: ``rows`` (the key columns, text_key, digest) and ``classes`` per digest.

    ``classes``: digest, weight (rows with this set), root (digest that names the class),
    links (rows, other than the row itself, at or above the threshold).
    """

    def __init__(self, rows: DataFrame, classes: DataFrame):
        self.rows, self.classes = rows, classes


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         tolerance: float = TOLERANCE, gram: int = GRAM) -> Join:
    """All links of ``docs`` at or above ``threshold``; see the module's text.

    ``key`` may be null or repeated: rows are told apart by their sets.  Other columns are
    not read.  An empty table gives empty results.
    """
    least = least_matches(threshold, tolerance)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.md5(F.col(text)).alias("text_key"))
    sigs = with_result(narrow, "text", "s", "n int, digest string, sig binary", lambda d, o: signatures(d, o, gram), ["key", "text_key"])
    rows = stable(sigs.select("key", "text_key", "s.*"))
    reps = stable(rows.filter("n > 0").groupBy("digest").agg(
        F.count("*").alias("weight"), F.min(F.struct("text_key", "key", "n", "sig")).alias("pick")).select("digest", "weight", "pick.*"))

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * 8 + 1, F.lit(8))))
    members = reps.select("digest", F.explode(band).alias("bucket"))
    held = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("y")).filter("n > 1")
    held = held.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    close = members.join(held, "bucket").join(reps.select("digest", "sig"), "digest")
    tied = _paired(close, "bucket").mapInArrow(lambda it: _tie(it, least), "a string, b string")
    clusters = stable(components(tied))

    sized = clusters.join(reps, clusters["node"] == reps["digest"]).drop("node")
    # Written, so that the join is between plain shuffles and AQE can split a cluster that holds much.
    blocks = stable(sized.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_GRAMS)).alias("blocks")))
    sized = sized.join(blocks, "root")
    wanted = narrow.join(sized.withColumnRenamed("key", "pick_key"), "text_key").filter(F.col("key").eqNullSafe(F.col("pick_key")))

    def sets(data, offsets):
        owner, value = gram_sets(data, offsets, gram)
        cut = np.searchsorted(owner, np.arange(len(offsets)))
        return [pa.array([np.unique(value[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())]

    whole = with_result(wanted, "text", "g", "grams binary", sets, ["root", "digest", "blocks", "weight", "sig"])
    whole = whole.select("root", "digest", "blocks", "weight", "sig", "g.grams")
    found = stable(_paired(whole, "root").withColumnRenamed("root", "cluster").mapInArrow(
        lambda it: _verify(it, least, threshold), "digest string, links bigint, root string"))

    named = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("digest").agg(F.sum("links").alias("more"))
    classes = reps.select("digest", "weight").join(links, "digest", "left").join(named.withColumnRenamed("node", "digest"), "digest", "left")
    classes = classes.select("digest", "weight", F.coalesce("root", "digest").alias("root"),
                             (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    return Join(rows, stable(classes))


def link_table(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: its key, class_id (smallest key of its class) and n_links.

    The class is the connected component of the links.  A row without words is a class of
    its own with no links.  A class whose keys are all null has a null class_id.
    """
    made = join(docs, key, text, **options)
    least = made.rows.filter("n > 0").groupBy("digest").agg(F.min("key").alias("least"))
    named = made.classes.join(least, "digest")
    ids = stable(named.groupBy("root").agg(F.min("least").alias("class_id")))
    named = named.select("digest", "root", "links").join(ids, "root").select("digest", "class_id", "links")
    out = made.rows.select("key", "digest").join(named, "digest", "left")
    alone = F.col("digest").isNull()
    return out.select(F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest key (nulls last, then the text's digest).

    Rows without words are all kept.  Of rows equal in key and text one stays, by a digest of
    their other columns; of fully equal rows any one.
    """
    made = join(docs, key, text, **options)
    ranked = made.rows.filter("n > 0").select("key", "text_key", "digest").join(made.classes.select("digest", "root"), "digest")
    # The rank is cut to one row per class in every task before the shuffle.
    order = Window.partitionBy("root").orderBy(F.col("key").asc_nulls_last(), "text_key")
    chosen = ranked.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select(F.col("key").alias("__key"), F.col("text_key").alias("__text"))
    blank = made.rows.filter("n = 0").select(F.col("key").alias("__key"), F.col("text_key").alias("__text")).distinct()
    chosen = stable(chosen.withColumn("__blank", F.lit(False)).union(blank.withColumn("__blank", F.lit(True))))
    mine = docs.withColumn("__text_key", F.md5(F.col(text)))
    joined = mine.join(chosen, mine["__text_key"].eqNullSafe(chosen["__text"]) & mine[key].eqNullSafe(chosen["__key"]))
    # Rows of one key and text are ordered by their other columns, so a task run anew keeps the same one.
    rest = [docs[c] for c in docs.columns if c.lower() not in (key.lower(), text.lower())]
    once = Window.partitionBy("__text_key", key).orderBy(F.md5(F.to_json(F.struct(*rest))) if rest else F.lit(0))
    joined = joined.withColumn("__n", F.when(F.col("__blank"), 1).otherwise(F.row_number().over(once)))
    return joined.filter("__n = 1").select(*[docs[c] for c in docs.columns])
