"""Quality of a text by naive Bayes support vectors.

Features are indicators: byte runs of four, words, and pairs of words, told apart by
64-bit hashes.  The model's dictionary holds those that stand in at least ``LEAST`` texts of
the training sample, so no two share a place and a text of any length is looked up whole;
others have no log ratio and weigh nothing.  Each indicator is scaled by the log ratio of its smoothed shares
in the two classes, every text's vector to length one, and a linear hinge-loss model is
fitted by dual coordinate descent.  The weights are drawn towards their mean magnitude
(``BLEND``), as usual for this model.  Margins of texts left out of the descent fix a
logistic curve, so the score is a probability.

Fitted on at most ``sample`` labelled texts, picked by hash, whole texts; what reaches
the driver is the different features of those texts, eight bytes each.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from millrace.llm.arrow import byte_set, chunks, grams, mix, with_result, words_of
from millrace.llm.shared import sample_ids

LEAST = 2
SAMPLE = 4000
BLEND = 0.25
COST = 4.0
EPOCHS = 15
_PRINTABLE = byte_set("printable")


def everywhere(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit feature) of every place of a feature, repeats included."""
    words = words_of(data, offsets, _PRINTABLE)
    at, pairs = grams(words, 2)
    owner, value = [words.doc, words.doc[at]], [words.hash, pairs ^ np.uint64(0x5555555555555555)]
    if len(data) >= 4:
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        run = data.astype(np.uint32)
        run = (run[:-3] << 24) | (run[1:-2] << 16) | (run[2:-1] << 8) | run[3:]
        whole = text[:-3] == text[3:]
        owner.append(text[:-3][whole])
        value.append(mix(run[whole].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return np.concatenate(owner), np.concatenate(value)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit feature) pairs, each once, by text."""
    owner, value = everywhere(data, offsets)
    seen, number = np.unique(value, return_inverse=True)
    owner, number = distinct(owner, number, len(seen))
    return owner, seen[number]


def distinct(owner: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs, each once and sorted; ``number`` is below ``size``."""
    # Sorted here, as np.unique may hash, which takes many times as long over so many keys.
    keys = owner.astype(np.int64) * max(1, size) + number
    keys.sort()
    return np.divmod(keys[firsts(keys)], max(1, size))


def firsts(values: np.ndarray) -> np.ndarray:
    """Places in sorted ``values`` where a value stands first."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[:len(values)])


class Model:
    """score = logistic(slope * (x . weights / |x . scale| + bias) + shift), x over the sorted ``dictionary``."""

    def __init__(self, dictionary, scale, weights, bias, slope, shift):
        self.dictionary, self.scale, self.weights = dictionary, scale, weights
        self.bias, self.slope, self.shift = bias, slope, shift

    @cached_property
    def heads(self) -> tuple[np.uint64, np.ndarray]:
        """Bits to drop from a feature, and for each value of the bits left the first place in the dictionary that is not below it."""
        bits = (2 * len(self.dictionary)).bit_length()
        drop = np.uint64(64 - bits)
        return drop, np.searchsorted(self.dictionary, np.arange(1 << bits, dtype=np.uint64) << drop).astype(np.int32)

    def places(self, value: np.ndarray) -> np.ndarray:
        """What ``np.searchsorted(dictionary, value)`` returns; hashes spread evenly, so few steps from the head lead there."""
        drop, head = self.heads
        ended = np.append(self.dictionary, ~np.uint64(0))
        at = head[value >> drop]
        low = np.flatnonzero(ended[at] < value)
        while len(low):
            at[low] += 1
            low = low[ended[at[low]] < value[low]]
        return at

    def margins(self, data, offsets):
        rows = len(offsets) - 1
        if not len(self.dictionary):
            return np.full(rows, self.bias)
        owner, value = everywhere(data, offsets)
        at = self.places(value)
        at[at == len(self.dictionary)] = 0
        known = self.dictionary[at] == value
        owner, feature = distinct(owner[known], at[known], len(self.dictionary))
        dot = np.bincount(owner, self.weights[feature], rows)
        norm = np.sqrt(np.bincount(owner, self.scale[feature] ** 2, rows))
        return np.divide(dot, norm, out=np.zeros(rows), where=norm > 0) + self.bias

    def scores(self, data, offsets):
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(data, offsets) + self.shift, -35, 35)))


def descend(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS):
    """Weights and bias of the hinge-loss model by dual coordinate descent."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    norm = np.array([v @ v + 1.0 for v in values])
    dice = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in dice.permutation(len(rows)):
            slope = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                moved = max(moved, abs(new - alpha[i]))
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that maximise the likelihood of 0/1 labels, with smoothed targets (Newton)."""
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    beta = np.array([1.0, np.log((good + 1) / (bad + 1))])
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (target - p) - 1e-3 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def solve(rows: list[np.ndarray], label: np.ndarray, dictionary: np.ndarray) -> Model:
    """Fit on lists of dictionary places and 0/1 labels.  One class only, or no row: the same score for all texts."""
    size = len(dictionary)
    share = (label.sum() + 1.0) / (len(label) + 2.0) if len(label) else 0.5
    if len(set(label.tolist())) < 2:
        return Model(dictionary[:0], np.zeros(0), np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    learn = np.arange(len(rows)) % 5 != 0
    if len(set(label[learn].tolist())) < 2:
        learn = np.ones(len(rows), bool)
    seen = [np.bincount(np.concatenate([r for r, l, k in zip(rows, label, learn) if k and l == c]), minlength=size) + 1.0 for c in (0, 1)]
    scale = np.log((seen[1] / seen[1].sum()) / (seen[0] / seen[0].sum()))
    scale[(seen[0] == 1) & (seen[1] == 1)] = 0.0
    values = []
    for r in rows:
        v = scale[r].astype(np.float32)
        length = np.sqrt(v @ v)
        values.append(v / length if length > 0 else v)
    pick = np.flatnonzero(learn)
    w, bias = descend([rows[i] for i in pick], [values[i] for i in pick], np.where(label[pick] > 0, 1.0, -1.0), size)
    w = (1 - BLEND) * w + BLEND * (np.abs(w[w != 0]).mean() if w.any() else 0.0)
    held = np.flatnonzero(~learn) if not learn.all() else pick
    margin = np.array([w[rows[i]] @ values[i] + bias for i in held])
    slope, shift = logistic(margin, label[held].astype(float))
    used = scale != 0
    return Model(dictionary[used], scale[used], (w * scale)[used], bias, slope, shift)


def fit(rows: DataFrame, label: str = "label", text: str = "text", key: str = "doc_id", sample: int = SAMPLE, labels: DataFrame | None = None,
        least: int = LEAST) -> Model:
    """Fit on ``rows`` (or on ``rows`` joined with ``labels`` by ``key``) with 0/1 in ``label``.

    Rows without text, label or key are not used; several labels of a key count as the largest.
    """
    marks = (rows if labels is None else labels).filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    marks = marks.groupBy(key).agg(F.max(label).cast("int").alias("__label"))
    ids = sample_ids(marks, key, sample)
    chosen = rows.filter(F.col(text).isNotNull()).select(key, text).join(ids, key).select(key, "__label", text)

    def extract(batches):
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(2)):
                owner, value = features(data, offsets)
                cuts = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(cuts, value.view(np.int64))], names=["key", "label", "feature"])

    kind = chosen.schema[key].dataType.simpleString()
    # Kept as one flat array of features; the lists below are views of it.
    got = chosen.mapInArrow(extract, f"key {kind}, label int, feature array<bigint>").toArrow().combine_chunks()
    order = pc.sort_indices(got["key"]).to_pylist()
    keys, label = got["key"].to_pylist(), got["label"].to_pylist()
    lists = got["feature"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int64()))
    flat, cuts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(zero_copy_only=False)
    first = [i for n, i in enumerate(order) if n == 0 or keys[i] != keys[order[n - 1]]]
    lists = [flat[cuts[i]:cuts[i + 1]].view(np.uint64) for i in first]
    dictionary = _held_by(lists, least)
    rows = []
    for values in lists:
        at = np.searchsorted(dictionary, values)
        at[at == len(dictionary)] = 0
        rows.append(at[dictionary[at] == values].astype(np.int32) if len(dictionary) else at[:0].astype(np.int32))
    return solve(rows, np.array([label[i] for i in first], np.int64), dictionary)


def _held_by(lists: list[np.ndarray], least: int) -> np.ndarray:
    """The sorted features that at least ``least`` of the lists hold."""
    if not lists:
        return np.empty(0, np.uint64)
    every = np.concatenate(lists)
    every.sort()
    first = firsts(every)
    return every[first[np.diff(np.concatenate([first, [len(every)]])) >= least]]


def predict(docs: DataFrame, model: Model, text: str = "text", name: str = "quality", carry: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``name``: score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts get the score of a text without features.  Other columns are
    kept; one called ``name`` is replaced.
    """
    def job(data, offsets):
        score = model.scores(data, offsets)
        return [score, (score >= threshold).astype(np.int32)]

    return with_result(docs, text, name, "score double, predicted int", job, carry)
