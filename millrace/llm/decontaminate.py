"""Passages of test items in training texts: rare n-gram seeds, then local alignment.

Words are letters and digits, lower-cased.  Every item offers three words in a row, and
three of four with one of the inner two left open, so that every third word of a copy may
be another; the corpus is counted once for them.  Those that stand in no text open nothing
and are left out; of the others the rarest ``share`` of each item's (at least ``LEAST``)
are its seeds.  The choice is by rank within the item, so an item that stands in very
many texts keeps its seeds all the same.  A text that holds a seed is aligned with the item around the seed's diagonal by Smith-Waterman (match 2, mismatch
and gap -1); the score is the alignment's share of a perfect one.

A text holds an item if the score reaches ``threshold``, or ``SHORT`` words of an item so
short that they are a larger share of it (all of it where it has no more); an item of
fewer than ``TINY`` words only if the text is nothing else.  It also holds it, however
small the share, if a stretch aligns with ``STRETCH`` more matching words than ``ERROR``
times its errors.  Such a stretch has a run of ``ERROR + 1`` matching words, so with a
seed in every such run of the item none is missed.

Items travel with the tasks in blocks of at most ``BLOCK_BYTES`` of item text; a larger
benchmark takes one pass over the corpus per block.  Nothing is shuffled but the counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.arrow import byte_set, chunks, grams, mix, with_result, words_of

GRAM = 3
# Places of a seed's words by the number of its shape; 1 to GRAM are that many words in a row.
GAPPED = {11: (0, 1, 3), 12: (0, 2, 3)}
SHARE = 0.75
LEAST = 8
THRESHOLD = 0.3
SHORT, TINY = 8, 5
STRETCH, ERROR = 13, 4
BLOCK_BYTES = 4 << 20
CELLS = 400_000
MATCH, MISS, GAP = 2, -1, -1
RESULT = "hits array<struct<item_id:bigint,score:double,first_word:bigint,last_word:bigint>>"
_LETTERS = byte_set("letters")


def _shape(words, shape: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of every seed of a shape inside one text."""
    if shape not in GAPPED:
        return grams(words, shape)
    places = GAPPED[shape]
    count = len(words.hash) - places[-1]
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(words.doc[:count] == words.doc[places[-1]:])
    value = np.full(len(at), shape, np.uint64)
    for k in places:
        value = value * np.uint64(0xD6E8FEB86659FD93) + words.hash[at + k]
    return at, mix(value)


class Items:
    """Word hashes of some items, and the n-grams that open an alignment."""

    def __init__(self, ids: list, texts: list[str], gram: int = GRAM):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        words = words_of(data, offsets, _LETTERS, lower=True)
        cut = np.split(words.hash, words.first[1:]) if len(raw) else []
        self.ids = [i for i, w in zip(ids, cut) if len(w)]
        self.words = [w for w in cut if len(w)]
        self.gram = gram
        # Items shorter than an n-gram are sought as a whole.
        rows = []
        for item, w in enumerate(self.words):
            for shape in (min(gram, len(w)), *GAPPED):
                _, value = _shape(_as_words(w), shape)
                rows.append((np.full(len(value), shape), np.full(len(value), item), np.arange(len(value)), value))
        size, item, place, value = (np.concatenate(x) for x in zip(*rows)) if rows else [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]
        order = np.lexsort((place, item, value, size))
        self.size, self.item, self.place, self.value = size[order], item[order], place[order], value[order]
        self.alive = np.ones(len(order), bool)
        self._index()

    def _index(self):
        self.seeds = {}
        for n in np.unique(self.size[self.alive]):
            rows = np.flatnonzero(self.alive & (self.size == n))
            value, first = np.unique(self.value[rows], return_index=True)
            self.seeds[int(n)] = (value, rows, np.concatenate([first, [len(rows)]]))

    def found(self, words):
        """(size, word number, seed number) of every n-gram of the texts that is a seed."""
        for n, (value, rows, cut) in self.seeds.items():
            at, g = _shape(words, n)
            slot = np.searchsorted(value, g)
            slot[slot == len(value)] = 0
            hit = np.flatnonzero(value[slot] == g)
            yield n, at[hit], slot[hit]

    def keep_rare(self, frequency: dict[tuple[int, int], int], share: float = SHARE, least: int = LEAST) -> "Items":
        """Keep the rarest seeds of each item that stand in a text, and the rarest words in a row of every run of
        ``ERROR + 1`` words, given the texts that hold (shape, seed number)."""
        count = np.zeros(len(self.value), np.int64)
        for n, (value, rows, cut) in self.seeds.items():
            per = np.array([frequency.get((n, s), 0) for s in range(len(value))], np.int64)
            count[rows] = np.repeat(per, np.diff(cut))
        order = np.lexsort((self.place, self.value, count, self.item))
        start = np.searchsorted(self.item[order], np.arange(len(self.words) + 1))
        self.alive[:] = False
        for i in range(len(self.words)):
            mine = order[start[i]:start[i + 1]]
            there = mine[count[mine] > 0]
            self.alive[there[: max(least, math.ceil(share * len(there)))]] = True
            wide = max(1, ERROR + 2 - self.gram)
            plain = mine[self.size[mine] == self.gram]
            if len(self.words[i]) >= STRETCH and len(plain) >= wide:
                rank = np.empty(len(plain), np.int64)
                rank[self.place[plain]] = np.arange(len(plain))
                runs = np.lib.stride_tricks.sliding_window_view(rank, wide)
                # A run with a part that stands nowhere stands nowhere itself.
                runs = runs[(count[plain][runs] > 0).all(1)]
                self.alive[plain[np.unique(runs.min(1))]] = True
        self._index()
        return self

    def windows(self, words):
        """(text, item, first word, word after the last) around every diagonal that a seed opens."""
        parts = []
        for n, at, slot in self.found(words):
            _, rows, cut = self.seeds[n]
            times = cut[slot + 1] - cut[slot]
            hit = np.repeat(np.arange(len(at)), times)
            step = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)
            row = rows[cut[slot][hit] + step]
            parts.append((words.doc[at[hit]], self.item[row], at[hit] - self.place[row]))
        if not parts:
            return np.empty((0, 4), np.int64)
        doc, item, diagonal = (np.concatenate(x) for x in zip(*parts))
        length = np.array([len(w) for w in self.words], np.int64)
        slack = np.maximum(8, length // 3)
        order = np.lexsort((diagonal, item, doc))
        doc, item, diagonal = doc[order], item[order], diagonal[order]
        if not len(doc):
            return np.empty((0, 4), np.int64)
        # Diagonals whose windows touch are aligned together.
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > (length + 2 * slack)[item[1:]])])
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(doc)]]) - 1
        doc, item = doc[head], item[head]
        low = np.maximum(diagonal[head] - slack[item], words.first[doc])
        high = np.minimum(diagonal[tail] + length[item] + slack[item], words.first[doc] + words.per_doc[doc])
        return np.stack([doc, item, low, high], 1)


def _as_words(hashes):
    from types import SimpleNamespace

    return SimpleNamespace(hash=hashes, doc=np.zeros(len(hashes), np.int64))


def align(items: list[np.ndarray], texts: list[np.ndarray], match: int = MATCH, miss: int = MISS, gap: int = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each (item, text) pair, and the word after its end in the text."""
    n = len(items)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = sorted(range(n), key=lambda i: (len(texts[i]), len(items[i])))
    low = 0
    while low < n:
        high = low + 1
        while high < n and (high + 1 - low) * len(texts[order[high]]) <= CELLS:
            high += 1
        part = order[low:high]
        wide, tall = len(texts[part[-1]]), max(len(items[i]) for i in part)
        text, item = np.zeros((len(part), wide), np.uint64), np.ones((len(part), tall), np.uint64)
        for k, i in enumerate(part):
            text[k, : len(texts[i])] = texts[i]
            item[k, : len(items[i])] = items[i]
        ramp = -gap * np.arange(1, wide + 1, dtype=np.int64)
        above = np.zeros((len(part), wide + 1), np.int64)
        top, where = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for r in range(tall):
            cell = above[:, :-1] + np.where(text == item[:, r:r + 1], match, miss)
            np.maximum(cell, above[:, 1:] + gap, out=cell)
            np.maximum(cell, 0, out=cell)
            # A gap along the row: the running maximum of what each cell would lend.
            cell = np.maximum.accumulate(cell + ramp, axis=1) - ramp
            above[:, 1:] = cell
            at = cell.argmax(1)
            value = cell[np.arange(len(part)), at]
            better = value > top
            top[better], where[better] = value[better], at[better] + 1
        best[part], end[part] = top, where
        low = high
    return best, end


class Search:
    def __init__(self, items: Items, threshold: float = THRESHOLD):
        self.items, self.threshold = items, threshold

    def hits(self, words):
        """(text, item number, score, first and last word) of the best alignment of each pair that the text holds."""
        window = self.items.windows(words)
        item = [self.items.words[i] for i in window[:, 1]]
        text = [words.hash[a:b] for a, b in window[:, 2:]]
        size = np.array([len(w) for w in item], np.int64)
        score, end = align(item, text)
        share = score / (MATCH * np.maximum(size, 1))
        held = share >= np.maximum(self.threshold, np.minimum(1, SHORT / np.maximum(size, 1)))
        held &= (size >= TINY) | (words.per_doc[window[:, 0]] == size)
        # A stretch that suffices scores at least so much here too.
        part = np.flatnonzero(~held & (score >= MATCH * STRETCH))
        strict = {"match": 1, "miss": -ERROR, "gap": -ERROR}
        value, until = align([item[i] for i in part], [text[i] for i in part], **strict)
        part, until = part[value >= STRETCH], until[value >= STRETCH]
        best = {}
        for good, stop, weights in ((np.flatnonzero(held), end[held], {}), (part, until, strict)):
            # Backwards from the end, the best alignment ends where this one begins.
            _, back = align([item[i][::-1] for i in good], [text[i][:e][::-1] for i, e in zip(good, stop)], **weights)
            for i, e, n in zip(good, stop, back):
                d, j, low, _ = (int(x) for x in window[i])
                at = low - int(words.first[d])
                row = (float(share[i]), at + int(e - n), at + int(e) - 1)
                if (d, j) not in best or row[0] > best[d, j][0]:
                    best[d, j] = row
        return [(d, j, *row) for (d, j), row in sorted(best.items())]

    def job(self, data, offsets):
        rows = len(offsets) - 1
        out = [[] for _ in range(rows)]
        for d, j, score, first, last in self.hits(words_of(data, offsets, _LETTERS, lower=True)):
            out[d].append({"item_id": self.items.ids[j], "score": score, "first_word": first, "last_word": last})
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
        return [pa.array(out, kind)]


def seed_frequency(docs: DataFrame, items: Items, text: str = "text") -> dict[tuple[int, int], int]:
    """How many texts of the corpus hold each n-gram of the items."""

    def count(batches):
        for batch in batches:
            total = {n: np.zeros(len(v[0]), np.int64) for n, v in items.seeds.items()}
            for _, _, data, offsets in chunks(batch.column(0)):
                words = words_of(data, offsets, _LETTERS, lower=True)
                for n, at, slot in items.found(words):
                    pairs = np.unique(words.doc[at].astype(np.int64) * len(total[n]) + slot)
                    total[n] += np.bincount(pairs % len(total[n]), minlength=len(total[n]))
            for n, x in total.items():
                at = np.flatnonzero(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n)), pa.array(at), pa.array(x[at])], names=["size", "seed", "n"])

    rows = docs.select(text).mapInArrow(count, "size bigint, seed bigint, n bigint").groupBy("size", "seed").agg(F.sum("n"))
    return {(n, s): c for n, s, c in rows.collect()}


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
           name: str = "leaks", carry: list[str] | None = None, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``name.hits``: the items a text holds, best alignment each, by item in benchmark order.

    Texts and items that are null or have no word hold and match nothing.  Items with
    equal texts or ids are reported each.  An empty benchmark gives empty lists.  Other
    columns are kept; one called ``name`` is replaced.
    """
    wanted = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).filter(F.col("text").isNotNull())
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    keep = [c for c in (carry if carry is not None else docs.columns) if c.lower() != name.lower()]
    out, made = docs, []
    for b in range(blocks):
        rows = wanted.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).orderBy("id", "text").collect()
        items = Items([r[0] for r in rows], [r[1] for r in rows])
        items.keep_rare(seed_frequency(docs, items, text))
        column = name if blocks == 1 else f"__{name}_{b}"
        out = with_result(out, text, column, RESULT, Search(items, threshold).job, keep + ([] if b == blocks - 1 or text in keep else [text]) + made)
        made.append(column)
    if blocks > 1:
        out = out.select(*[f"`{c}`" for c in keep], F.struct(F.concat(*[F.col(f"`{c}`.hits") for c in made]).alias("hits")).alias(name))
    return out
