"""Language of a text by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes with the counts of
the byte that follows.  The code length of a byte is that of escape method C: in its
longest known context a byte seen ``c`` of ``n`` times among ``u`` distinct ones costs
-ln(c / (n + u)); an unseen one costs the escape -ln(u / (n + u)) and is then coded in
the context one byte shorter, down to all 256 bytes alike.  Counts are frozen, so the
cost of (context, byte) is a constant and a text costs the exact sum of table entries.
The cheapest language wins; the score is its posterior under equal priors.

The model is fitted on a bounded sample (``per_lang`` texts a language, whole texts);
``max_contexts`` keeps the most frequent three-byte contexts, rarer ones are coded in
their two-byte suffix.  Scoring reads every byte of every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.arrow import chunks, sums_per_text, with_result
from millrace.llm.shared import sample_ids

PER_LANG = 400
MAX_CONTEXTS = 20_000
STEP = 1 << 20
RESULT = "lang_pred string, score double, nats double"


def _history(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The bytes one, two and three places back; before a text there are spaces."""
    out = []
    starts = offsets[:-1][offsets[1:] > offsets[:-1]]
    ends = offsets[1:][offsets[1:] > offsets[:-1]]
    for back in (1, 2, 3):
        past = np.full(len(data), 32, np.uint8)
        past[back:] = data[:-back] if len(data) > back else past[back:]
        for k in range(back):
            at = starts + k
            past[at[at < ends]] = 32
        out.append(past)
    return out


def _keys(data, offsets):
    one, two, three = _history(data, offsets)
    return (three.astype(np.uint32) << 24) | (two.astype(np.uint32) << 16) | (one.astype(np.uint32) << 8) | data


class Model:
    """Frozen counts: ``keys`` are four bytes (three of context), ``counts`` has a column per language."""

    def __init__(self, languages: list[str], keys: np.ndarray, counts: np.ndarray, max_contexts: int):
        self.languages, self.keys, self.counts, self.max_contexts = languages, keys, counts, max_contexts
        self._tables = None

    def __getstate__(self):
        return self.__dict__ | {"_tables": None}

    def tables(self):
        if self._tables is None:
            self._tables = self._build()
        return self._tables

    def _build(self):
        k, n_lang = self.keys, len(self.languages)
        byte = k & 0xFF
        known = np.unique(byte)
        cls = np.full(256, len(known), np.int64)
        cls[known] = np.arange(len(known))
        width = len(known) + 1

        def level(context, below):
            """Costs [context, byte class, language] from the counts, given those one byte shorter."""
            size = len(below)
            count = np.zeros((size * width, n_lang))
            keep = context >= 0
            np.add.at(count, context[keep] * width + cls[byte[keep]], self.counts[keep])
            count = count.reshape(size, width, n_lang)
            total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = -np.log(count / (total + kinds))
                miss = np.where(total > 0, -np.log(kinds / (total + kinds)), 0.0) + below
            return np.where(count > 0, hit, miss)

        none = np.zeros(len(k), np.int64)
        zero = level(none, np.full((1, width, n_lang), np.log(256.0)))
        past = (k >> 8) & 0xFF
        one = level(cls[past], np.broadcast_to(zero, (width, width, n_lang)))
        pairs = np.unique((k >> 8) & 0xFFFF)
        at_pair = np.full(1 << 16, -1, np.int64)
        at_pair[pairs] = np.arange(len(pairs))
        two = level(at_pair[(k >> 8) & 0xFFFF], one[cls[pairs & 0xFF]])
        triples, where = np.unique(k >> 8, return_inverse=True)
        weight = np.bincount(where, self.counts.sum(1))
        order = np.lexsort((triples, -weight))[: self.max_contexts]
        triples = np.sort(triples[order])
        at_triple = np.full(len(pairs) * width, -1, np.int64)
        at_triple[at_pair[triples & 0xFFFF] * width + cls[triples >> 16]] = np.arange(len(triples))
        three = level(at_triple[at_pair[(k >> 8) & 0xFFFF] * width + cls[k >> 24]], two[at_pair[triples & 0xFFFF]])
        costs = np.concatenate([x.reshape(-1, n_lang) for x in (one, two, three)]).astype(np.float32)
        return cls, width, at_pair, at_triple, len(one) * width, (len(one) + len(two)) * width, costs

    def costs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in nats of each text under each language; long texts in steps."""
        cls, width, at_pair, at_triple, base2, base3, costs = self.tables()
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        history = _history(data, offsets)
        for low in range(0, len(data), STEP):
            high = min(low + STEP, len(data))
            one, two, three = (x[low:high].astype(np.int64) for x in history)
            symbol = cls[data[low:high]]
            pair = at_pair[(two << 8) | one]
            # An unknown pair may not be looked up further; its triple cannot be known either.
            triple = np.where(pair >= 0, at_triple[pair * width + cls[three]], -1)
            row = np.where(triple >= 0, base3 + triple * width, np.where(pair >= 0, base2 + pair * width, cls[one] * width)) + symbol
            out += sums_per_text(costs[row], np.clip(offsets, low, high) - low)
        return out


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_lang: int = PER_LANG, max_contexts: int = MAX_CONTEXTS) -> Model:
    """Count contexts over at most ``per_lang`` texts of each language.

    Rows without text, language or key are not used.  The counts are summed by Spark;
    what reaches the driver is bounded by the sample.  No rows: a model without languages.
    """
    usable = rows.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    ids = sample_ids(usable.select(key, lang), key, per_lang, lang)
    chosen = usable.select(key, text, lang).join(ids, [key, lang], "left_semi").select(text, lang)

    def count(batches):
        for batch in batches:
            names = np.asarray(batch.column(1).to_pylist(), dtype=object)
            for low, high, data, offsets in chunks(batch.column(0)):
                keys, part = _keys(data, offsets), names[low:high]
                owner = np.repeat(np.arange(high - low), np.diff(offsets))
                for name in dict.fromkeys(part):
                    found, times = np.unique(keys[(part == name)[owner]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(times.astype(np.int64))],
                        names=["lang", "key", "n"])

    counted = chosen.mapInArrow(count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    keys, where = np.unique(counted["key"].to_numpy(np.int64).astype(np.uint32), return_inverse=True)
    counts = np.zeros((len(keys), len(languages)))
    counts[where, [languages.index(x) for x in counted["lang"]]] = counted["n"]
    return Model(languages, keys.astype(np.int64), counts, max_contexts)


def predict(docs: DataFrame, model: Model, text: str = "text", name: str = "language", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``name``: the language, its posterior (0 to 1) and its code length in nats.

    ``und`` with score 0 where the text is null, empty or has no letter, or where the
    model knows no language.  Equal costs go to the language first in the alphabet.
    Other columns are kept; one called ``name`` is replaced.
    """
    def job(data, offsets):
        m, rows = model, len(offsets) - 1
        folded = data | 0x20
        letters = sums_per_text(((folded >= 97) & (folded <= 122)).astype(np.uint8), offsets) > 0
        for i in np.flatnonzero(~letters & (offsets[1:] > offsets[:-1])):
            letters[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
        if not m.languages:
            return [pa.array(["und"] * rows), np.zeros(rows), np.zeros(rows)]
        cost = m.costs(data, offsets)
        best = cost.argmin(1)
        least = cost[np.arange(rows), best]
        score = 1.0 / np.exp(least[:, None] - cost).sum(1)
        names = [m.languages[b] if ok else "und" for b, ok in zip(best, letters)]
        return [pa.array(names, pa.string()), np.where(letters, score, 0.0), np.where(letters, least, 0.0)]

    return with_result(docs, text, name, RESULT, job, carry)
