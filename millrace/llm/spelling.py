"""Spelling variants of words: neighbours at one edit, by dynamic programming over a sorted list.

Words are counted over whole texts; a task adds up its own counts first.  Two words are
near if one inserted, deleted or replaced code point turns one into the other.

The sorted vocabulary is scanned with the edit matrix of every word against the list, held
to the band of one diagonal either side.  Neighbouring words of the list share a prefix
(their LCP); the matrix rows of a shared prefix are computed once and used for all words
in its range, and where a row's least value exceeds one edit the whole range is skipped.
The scan goes level by level, one row for each (word, prefix) pair that is still alive,
so numpy works on many words at a time.

The vocabulary is dealt out so that near words meet: for words of length c and c + 1 an
edit leaves the first c // 2 code points as they are, or else the last c // 2.  Groups share
(c, those code points), forwards and, for reversed words, backwards; a pair that shares both
counts forwards.  A group of more than ``BLOCK`` words is cut into blocks by hash, each
block scanned against each other.  A task returns per word its number of neighbours and
the best one, never the pairs.

Chains of forms are followed by pointer doubling: a form occurs at least twice as often
as its word, so their length grows with the logarithm of the largest count.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stable

DAMAGE = 97
LENGTH, COUNT = 5, 3
RATIO = 2
BLOCK = 4096
HELD_WORDS = 200_000
CELLS = 1_000_000
# Bytes of A-Z lower-cased, a-z and U+00C0 to U+00FF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def damaged(run: bytes, key: bytes, every: int = DAMAGE) -> bytes:
    """``run`` without one code point if ``every`` divides the checksum of key:run."""
    h = zlib.crc32(key + b":" + run)
    if h % every:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, count: int = COUNT, every: int = DAMAGE) -> DataFrame:
    """(word, n) of all runs of letters with at least ``length`` code points and ``count`` occurrences.

    A null text has no runs; a null key counts as an empty one.
    """
    narrow = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())

    def run(batches):
        held: dict[bytes, int] = {}

        def out():
            words = [w.decode() for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                mine: dict[bytes, int] = {}
                for w in _RUN.findall(t.as_py().encode().lower()):
                    mine[w] = mine.get(w, 0) + 1
                k = k.as_py().encode()
                for w, n in mine.items():
                    w = damaged(w, k, every)
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    counts = narrow.mapInArrow(run, "word string, n bigint").filter(F.char_length("word") >= length)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


def _points(words: list[str], size: int) -> np.ndarray:
    """Code points, one row a word, zeros at the end."""
    return np.array(words, f"U{size}").view(np.uint32).reshape(len(words), size)


def scan(words: np.ndarray, group: np.ndarray, asked: np.ndarray, asked_group: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``asked``, place in ``words``) of all pairs of a group at one edit.

    ``words``: rows of code points of one length, sorted within their groups, which are in
    order and whose words share the first ``shared`` points.  ``asked``: rows of at most one
    point more, padded by zeros.  Groups are numbered from 0, and all of them occur in ``words``.
    """
    n, c = words.shape
    same = words[1:] == words[:-1]
    lcp = np.zeros(n, np.int64)
    lcp[1:] = np.where(same.all(1), c, same.argmin(1))
    lcp[1:][group[1:] != group[:-1]] = -1
    lcp[0] = -1
    asked = np.concatenate([asked, np.zeros((len(asked), 2 + c - asked.shape[1]), asked.dtype)], axis=1) if asked.shape[1] < c + 2 else asked
    # Prefixes of the shared length are the groups themselves.
    query, node = np.arange(len(asked)), asked_group.copy()
    starts = np.flatnonzero(lcp < 0)
    left, mid, right = (np.full(len(asked), v, np.int8) for v in (1, 0, 1))
    for d in range(shared, c):
        # The prefixes one point longer, and the range of them below each prefix.
        new = np.flatnonzero(lcp <= d)
        first = np.searchsorted(new, np.append(starts, n))
        many = first[node + 1] - first[node]
        at = np.repeat(np.arange(len(node)), many)
        child = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + first[node][at]
        q, point = query[at], words[new[child], d]
        old_left, old_mid, old_right = left[at], mid[at], right[at]
        left = np.minimum(old_left + (asked[q, d - 1] != point), old_mid + 1) if d else old_mid + 1
        mid = np.minimum(np.minimum(old_mid + (asked[q, d] != point), old_right + 1), left + 1)
        right = np.minimum(old_right + (asked[q, d + 1] != point), mid + 1)
        alive = np.minimum(np.minimum(left, mid), right) <= 1
        query, node, left, mid, right = q[alive], child[alive], left[alive].astype(np.int8), mid[alive].astype(np.int8), right[alive].astype(np.int8)
        starts = new
    longer = asked[query, c] != 0
    near = np.where(longer, right, mid) == 1
    return query[near], starts[node[near]]


def _rows(batches, keys: list[str], cells: int):
    """Tables of whole groups of one side and length, of up to about ``cells`` code points each."""
    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys], 1)
        cuts = np.concatenate([[0], np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1, [batch.num_rows]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            now = tuple(values[low])
            if held and now != last and (now[:2] != last[:2] or size > cells):
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(low, high - low))
            size += int((high - low) * (now[1] + 1))
            last = now
    if held:
        yield pa.Table.from_batches(held)


_KEYS = ["back", "c", "half", "first", "second"]


def _neighbours(batches, cells: int):
    for rows in _rows(batches, _KEYS, cells):
        back, c = rows["back"][0].as_py(), rows["c"][0].as_py()
        keys = np.stack([rows[k].to_numpy() for k in _KEYS[2:]], 1)
        role, words, n = rows["role"].to_numpy(), rows["word"].to_pylist(), rows["n"].to_numpy()
        points = _points([w[::-1] for w in words] if back else words, c + 1)
        # Rows are sorted by the shared points too, so equal hashes of different ones do no harm.
        group = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(1) | (points[1:, :c // 2] != points[:-1, :c // 2]).any(1))])
        listed = np.flatnonzero((role & 1 > 0) & (points[:, c] == 0))
        asked = np.flatnonzero(role & 2)
        # Groups with a listed word, numbered anew.
        number = np.full(group[-1] + 1, -1)
        number[group[listed]] = 0
        number[number == 0] = np.arange((number == 0).sum())
        asked = asked[number[group[asked]] >= 0]
        if not len(listed) or not len(asked):
            continue
        q, w = scan(points[listed, :c], number[group[listed]], points[asked], number[group[asked]], c // 2)
        q, w = asked[q], listed[w]
        if back:
            # The first half of both, read from the end of the reversed words.
            size = np.where(points[:, c] == 0, c, c + 1)
            ahead = lambda rows: np.take_along_axis(points[rows], size[rows][:, None] - 1 - np.arange(c // 2), 1)
            other = (ahead(q) != ahead(w)).any(1)
            q, w = q[other], w[other]
        # Words of one length find each other from both ends, others only from the longer one.
        longer = points[q, c] != 0
        q, w = np.concatenate([q, w[longer]]), np.concatenate([w, q[longer]])
        if not len(q):
            continue
        text = np.array(words, dtype=object)
        order = np.lexsort((text[w].astype(str), -n[w], q))
        q, w = q[order], w[order]
        head = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(text[q[head]], pa.string()), pa.array(np.diff(np.append(head, len(q)))), pa.array(n[w[head]]), pa.array(text[w[head]], pa.string())],
            names=["word", "near", "most", "best"])


def neighbours(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the rows of ``words(word, n)`` that have a near word.

    ``best`` is the near word of largest n, of equal ones the smallest in code-point order.
    """
    size = F.char_length("word")
    # Of words of length c and c + 1: the shorter are listed and ask, the longer only ask.
    sides = F.array(F.lit(False), F.lit(True))
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("c"), size.alias("size"), sides.alias("sides"))
    rows = rows.select("word", "n", "c", "size", F.explode("sides").alias("back")).filter("c > 0")
    part: Column = F.substring(F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")), F.lit(1), F.floor(F.col("c") / 2).cast("int"))
    rows = rows.withColumn("half", F.xxhash64(part)).withColumn("part", part)
    key = ["back", "c", "part"]
    large = stable(rows.groupBy(*key).agg(F.count("*").alias("words")).filter(F.col("words") > block).select(*key, F.ceil(F.col("words") / block).cast("int").alias("blocks")))
    rows = rows.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("word", F.lit(7)), F.col("blocks")).cast("int")
    # Role 1: listed, 2: asks.  Block ``first`` of the list meets block ``second`` of those who ask.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    meet = lambda first, second, role: F.struct(first.alias("first"), second.alias("second"), F.lit(role).alias("role"))
    pairs = F.concat(
        F.when(F.col("size") == F.col("c"), F.transform(every, lambda b: meet(mine, b, 1))).otherwise(F.array().cast("array<struct<first:int,second:int,role:int>>")),
        F.transform(every, lambda b: meet(b, mine, 2)))
    one = F.array(meet(F.lit(0), F.lit(0), 3))
    rows = rows.withColumn("pair", F.explode(F.when(F.col("blocks") == 1, one).otherwise(pairs)))
    rows = rows.select("back", "c", "half", "pair.first", "pair.second", "pair.role", "part", "word", "n")
    text = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    rows = rows.repartition(*_KEYS).withColumn("text", text).sortWithinPartitions(*_KEYS, "part", "text").drop("text", "part")
    found = rows.mapInArrow(lambda it: _neighbours(it, CELLS), "word string, near bigint, most bigint, best string")
    best = F.min(F.struct((-F.col("most")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.best", (-F.col("b.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows of ``forms(word, form)``: the word at the end of the chain of forms."""
    now = stable(forms.select("word", F.col("form").alias("root")))
    while True:
        after = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left")
        after = stable(after.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = after.select("word", "root")
        if not after.filter("moved").take(1):
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, count: int = COUNT,
             ratio: int = RATIO, every: int = DAMAGE, block: int = BLOCK) -> DataFrame:
    """One row per word of ``docs``: word, n, n_near, form, form_n, root.

    ``form`` is the word's best near word if that occurs at least ``ratio`` times as often,
    ``root`` the end of the chain of forms (the word itself without a form).  Texts may be
    null, empty or very long, keys null or repeated; other columns are not read; an empty
    table gives an empty result.
    """
    words = stable(word_counts(docs, key, text, length, count, every))
    near = words.join(neighbours(words, block), "word", "left")
    held = F.col("best_n") >= ratio * F.col("n")
    near = stable(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                              F.when(held, F.col("best")).alias("form"), F.when(held, F.col("best_n")).alias("form_n")))
    ends = roots(near.filter("form is not null"))
    return near.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
