"""License notices by an exact set-similarity join of text blocks with notice templates.

A block is a line (or a paragraph); block and template are sets of lower-cased words.
A pair is a match if the block holds at least ``threshold`` of the template's words.
With ``run`` the blocks are lines and, for every template of n words, all runs of
n / ``threshold`` words in a row, whatever lines and comment signs they stand in; so a
notice is found however it is wrapped.
Template words are ordered by how many blocks of the whole corpus hold them, rarest
first.  Then, without losing a match:

* prefix: a template of n words that needs k of them shares one of its n - k + 1 rarest
  words with every matching block, so only those words open a pair;
* length: a block of fewer than k words is no match;
* position: what is left in both orders from the shared word on must reach k; of a run,
  only words less than its length from a shared word can be in it.

Pairs that remain are counted exactly.  Templates are a parameter of known, small size
and travel with the tasks; the corpus is never shuffled.  Beside the join, phrases
(consecutive words, across lines) are found exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.arrow import byte_set, chunks, with_result, words_of

# Phrases and the labels they stand for.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences of well-known license notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.8
RESULT = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
          "matches array<struct<label:string,block:bigint,containment:double>>")
_LETTERS = byte_set("letters")


def _flat(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)], np.int64)


def _hashes(text: str) -> np.ndarray:
    return words_of(*_flat(text), _LETTERS, lower=True).hash


class Scan:
    """Templates and phrases prepared for a scan; ``rank`` orders their words, rarest first."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, block: str = "line"):
        if block not in ("line", "paragraph", "run") or not 0 < threshold <= 1:
            raise ValueError("block is line, paragraph or run, threshold in (0, 1]")
        self.block = block
        self.labels = [label for label, _ in templates]
        hashes = [_hashes(text) for _, text in templates]
        self.length = [math.floor(len(h) / threshold + 1e-9) for h in hashes]
        sets = [np.unique(h) for h in hashes]
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
        self.member = np.zeros((len(sets), len(self.vocabulary)), bool)
        for t, words in enumerate(sets):
            self.member[t, np.searchsorted(self.vocabulary, words)] = True
        self.size = self.member.sum(1)
        self.need = np.array([max(1, math.ceil(threshold * n - 1e-9)) for n in self.size], np.int64)
        self.phrases = [(text.lower().encode().split(), _hashes(text), label) for text, label in phrases.items()]
        self.order(np.zeros(len(self.vocabulary), np.int64))

    def order(self, frequency: np.ndarray) -> "Scan":
        """Fix the global order of words, and each template's prefix under it."""
        self.rank = np.empty(len(frequency), np.int64)
        self.rank[np.lexsort((np.arange(len(frequency)), frequency))] = np.arange(len(frequency))
        self.opens = np.zeros_like(self.member)
        for t in range(len(self.member)):
            words = np.flatnonzero(self.member[t])
            words = words[np.argsort(self.rank[words])]
            self.opens[t, words[: len(words) - self.need[t] + 1]] = True
        return self

    def blocks(self, data, words):
        """The number of each word's block, rising with the text."""
        if self.block != "paragraph":
            cut = np.flatnonzero(data == 10)
        else:
            # A paragraph ends where a second line feed follows, blanks between them aside.
            solid = np.flatnonzero(~np.isin(data, (9, 13, 32)))
            feeds = data[solid] == 10
            cut = solid[1:][feeds[1:] & feeds[:-1]] if len(solid) > 1 else solid[:0]
        return np.searchsorted(cut, words.start) + words.doc

    def known(self, words):
        """(word number, template word) of every word of the texts that some template has."""
        if not len(self.vocabulary) or not len(words.hash):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.searchsorted(self.vocabulary, words.hash)
        at[at == len(self.vocabulary)] = 0
        hit = np.flatnonzero(self.vocabulary[at] == words.hash)
        return hit, at[hit]

    def holdings(self, data, offsets):
        """Words, their blocks, and the distinct (block, template word) pairs as two arrays."""
        words = words_of(data, offsets, _LETTERS, lower=True)
        block = self.blocks(data, words)
        hit, token = self.known(words)
        keys = np.unique(block[hit].astype(np.int64) * max(1, len(self.vocabulary)) + token)
        return words, block, keys // max(1, len(self.vocabulary)), keys % max(1, len(self.vocabulary))

    def matches(self, words, block, owner, token):
        """(block, template, containment) of every block that reaches a template's need."""
        none = np.empty(0, np.int64)
        if not len(owner):
            return none, none, np.empty(0)
        edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ids = owner[edge]
        group = np.repeat(np.arange(len(ids)), np.diff(np.concatenate([edge, [len(owner)]])))
        # Prefix: pairs opened by a rare word; the rarest shared one sets the position.
        row, template = np.nonzero(self.opens.T[token])
        if not len(row):
            return none, none, np.empty(0)
        order = np.lexsort((self.rank[token[row]], template, group[row]))
        row, template = row[order], template[order]
        first = np.concatenate([[True], (group[row][1:] != group[row][:-1]) | (template[1:] != template[:-1])])
        row, template = row[first], template[first]
        pair = group[row]
        # Length: words of the block, repeats included, are at least its distinct ones.
        low, high = np.searchsorted(block, ids[pair]), np.searchsorted(block, ids[pair], "right")
        keep = high - low >= self.need[template]
        # Position: words not before the shared one, in the block and in the template.
        ranks = np.sort(group * len(self.rank) + self.rank[token])
        last = np.searchsorted(ranks, (pair + 1) * len(self.rank))
        left_block = last - np.searchsorted(ranks, pair * len(self.rank) + self.rank[token[row]])
        by_rank = np.cumsum(self.member[:, np.argsort(self.rank)], 1)
        left_template = self.size[template] - by_rank[template, self.rank[token[row]]] + 1
        keep &= np.minimum(left_block, left_template) >= self.need[template]
        pair, template = pair[keep], template[keep]
        # Exact count for what is left.
        chosen, back = np.unique(pair, return_inverse=True)
        if not len(chosen):
            return none, none, np.empty(0)
        take = np.isin(group, chosen)
        starts = np.flatnonzero(np.concatenate([[True], group[take][1:] != group[take][:-1]]))
        common = np.add.reduceat(self.member.T[token[take]].astype(np.int64), starts, axis=0)[back, template]
        good = common >= self.need[template]
        return ids[pair[good]], template[good], common[good] / self.size[template[good]]

    def runs(self, words):
        """(first word number, template, containment): each text's best run for every template that has one."""
        found = []
        hit, token = self.known(words)
        for t, (length, need) in enumerate(zip(self.length, self.need)):
            inside = self.member[t][token] if len(token) else np.empty(0, bool)
            place, word = hit[inside], token[inside]
            # Prefix and position: a rare word of the template is less than a run away.
            rare = place[self.opens[t][word]]
            near = np.searchsorted(rare, place - length, "right") < np.searchsorted(rare, place + length)
            place, word = place[near], word[near]
            # Length: the run that ends at a word holds enough words of the template.
            low = np.searchsorted(place, np.maximum(place - length + 1, words.first[words.doc[place]]))
            ends = np.flatnonzero(np.arange(len(place)) - low + 1 >= need)
            if not len(ends):
                continue
            # Exact count of different words.
            common = np.zeros(len(ends), np.int64)
            for w in np.flatnonzero(self.member[t]):
                last = np.maximum.accumulate(np.where(word == w, np.arange(len(place)), -1))
                common += last[ends] >= low[ends]
            good = np.flatnonzero(common >= need)
            doc = words.doc[place[ends[good]]]
            order = np.lexsort((ends[good], -common[good], doc))
            best = good[order][np.concatenate([[True], np.diff(doc[order]) > 0])] if len(order) else good
            found += [(int(place[low[ends[i]]]), t, common[i] / self.size[t]) for i in best]
        return found

    def places(self, data, words):
        """(word number, label number) of every place of every phrase, in order of the text."""
        found = []
        for label, (text, hashes, _) in enumerate(self.phrases):
            k = len(hashes)
            if not 0 < k <= len(words.hash):
                continue
            at = np.flatnonzero(words.hash[: len(words.hash) - k + 1] == hashes[0])
            for j in range(1, k):
                at = at[(words.hash[at + j] == hashes[j]) & (words.doc[at + j] == words.doc[at])]
            for i in at:
                if all(data[words.start[i + j]:words.end[i + j]].tobytes().lower() == text[j] for j in range(k)):
                    found.append((i, label))
        return sorted(found)

    def job(self, data, offsets):
        rows = len(offsets) - 1
        words, block, owner, token = self.holdings(data, offsets)
        n_base, first, last = [0] * rows, [None] * rows, [None] * rows
        base = [set() for _ in range(rows)]
        for i, label in self.places(data, words):
            d = int(words.doc[i])
            at = int(i - words.first[d])
            n_base[d] += 1
            first[d] = at if first[d] is None else first[d]
            last[d] = at
            base[d].add(self.phrases[label][2])
        score = [1.0 if b else 0.0 for b in base]
        every = [set(b) for b in base]
        found, lines = [[] for _ in range(rows)], set()
        for b, t, share in zip(*self.matches(words, block, owner, token)):
            d = int(words.doc[np.searchsorted(block, b)])
            every[d].add(self.labels[t])
            score[d] = max(score[d], float(share))
            origin = block[words.first[d]]
            found[d].append({"label": self.labels[t], "block": int(b - origin), "containment": float(share)})
            lines.add((d, t))
        for i, t, share in self.runs(words) if self.block == "run" else ():
            d = int(words.doc[i])
            every[d].add(self.labels[t])
            score[d] = max(score[d], float(share))
            if (d, t) not in lines:
                found[d].append({"label": self.labels[t], "block": int(block[i] - block[words.first[d]]), "containment": float(share)})
        join = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
        kind = pa.list_(pa.struct([("label", pa.string()), ("block", pa.int64()), ("containment", pa.float64())]))
        return [words.per_doc, pa.array(n_base, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                join(base), join(every), pa.array(score, pa.float64()), pa.array(found, kind)]


def word_frequency(docs: DataFrame, scan: Scan, text: str = "text") -> np.ndarray:
    """In how many blocks of the corpus each template word stands; as many numbers as template words."""

    def count(batches):
        for batch in batches:
            total = np.zeros(len(scan.vocabulary), np.int64)
            for _, _, data, offsets in chunks(batch.column(0)):
                total += np.bincount(scan.holdings(data, offsets)[3], minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    out = np.zeros(len(scan.vocabulary), np.int64)
    for word, n in docs.select(text).mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n")).collect():
        out[word] = n
    return out


def scan(docs: DataFrame, text: str = "text", name: str = "license", carry: list[str] | None = None, templates=TEMPLATES,
         phrases=PHRASES, threshold: float = THRESHOLD, block: str = "line") -> DataFrame:
    """``docs`` with ``name``: words, places of phrases, labels, and the matching blocks.

    ``score`` is 1 where a phrase stands, else the largest containment that reaches the
    threshold, else 0.  Null and empty texts: no words, no labels, score 0.  Block numbers
    count from the block of the first word; a run, listed where no line matches its template,
    has the line it begins in.  Other columns are kept; one called ``name``
    is replaced.
    """
    prepared = Scan(templates, phrases, threshold, block)
    prepared.order(word_frequency(docs, prepared, text))
    return with_result(docs, text, name, RESULT, prepared.job, carry)
