"""Vector codes, one-permutation near copies and spelling variants against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import BLANK, EDGE, LONG, SCHEMA, docs_of

from millrace.llm import gnat, oneperm, spelling


@pytest.mark.parametrize("entries,spread", [(1, 5), (3, 1), (16, 40), (200, 3), (300, 4000)])
def test_tree_finds_the_nearest_entry_and_the_lowest_of_ties(entries, spread):
    dice = np.random.default_rng(entries)
    book = dice.integers(-spread, spread + 1, (entries, 6))
    book[entries // 2] = book[0]
    rows = np.concatenate([dice.integers(-spread, spread + 1, (400, 6)), book, (book[:1] + book[-1:]) // 2])
    square = ((rows[:, None] - book[None]) ** 2).sum(2)
    tree = gnat.Gnat(book)
    tree.looked = 0
    entry, best = tree.nearest(rows)
    assert (best == square.min(1)).all() and (entry == square.argmin(1)).all()


def test_tree_leaves_whole_subtrees_out():
    dice = np.random.default_rng(7)
    centres = dice.integers(-10**6, 10**6, (12, 4))
    book = np.concatenate([c + dice.integers(-50, 50, (20, 4)) for c in centres])
    rows = np.concatenate([c + dice.integers(-60, 60, (30, 4)) for c in centres])
    tree = gnat.Gnat(book)
    tree.looked = 0
    entry, _ = tree.nearest(rows)
    assert (entry == ((rows[:, None] - book[None]) ** 2).sum(2).argmin(1)).all()
    assert tree.looked < len(rows) * len(book) / 4


def codes_by_hand(rows, parts=2, entries=3, rounds=4):
    """rows: (id, ints) in order; plain loops of the same rules."""
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[list(cut(v, p)) for _, v in rows[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v in rows:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, xs in held.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    return books, [(i, [near(cut(v, p), books[p])[1] for p in range(parts)], sum(near(cut(v, p), books[p])[0] for p in range(parts))) for i, v in rows]


def test_codes_leave_damaged_rows_out(spark):
    dice = random.Random(3)
    good = [(i, [dice.randint(-30, 30) / 8 for _ in range(4)]) for i in range(1, 60)] + [(5, [0.5, 0.25, 1.0, -1.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    bad = [(0, None), (-1, [1.0, None, 2.0, 3.0]), (-2, [float("nan"), 1.0, 1.0, 1.0]), (-3, [float("inf"), 0.0, 0.0, 0.0]), (-4, []), (-5, [1.0, 2.0, 3.0]), (70, [1.0] * 6)]
    schema = "vec_id bigint, embedding array<float>, label int, code string, CODE_ string, vector string, key string, entries int"
    df = spark.createDataFrame([(i, v, None, "x", "x", "x", "x", 1) for i, v in good + bad], schema)
    order = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books, want = codes_by_hand([(i, [int(np.floor(4096 * x)) for x in v]) for i, v in order])
    model = gnat.fit(df, parts=2, entries=3, rounds=4)
    assert model.entries.tolist() == books
    out = gnat.encode(df, model)
    assert out.columns == ["vec_id", "embedding", "label", "CODE_", "vector", "key", "entries", "code"]
    got = sorted(((r["vec_id"], r["code"]["entries"], r["code"]["error"]) for r in out.collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert gnat.fit(df.limit(0)) is None and gnat.fit(df.filter("vec_id <= 0")) is None
    with pytest.raises(Exception, match="64 bits"):
        gnat.fit(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id int, embedding array<double>"), parts=2)


def sets_by_hand(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [BLANK.findall((t or "").translate(lower)) for t in texts]
    return [{tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} - {()} for w in words]


def components_by_hand(texts):
    sets = sets_by_hand(texts)
    label = list(range(len(texts)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return sets, [root(k) for k in range(len(texts))]


def edited(dice, words, changes):
    words = list(words)
    for _ in range(changes):
        words[dice.randrange(len(words))] = f"new{dice.randrange(10**6)}"
    return words


def test_near_copies_against_all_pairs(spark, monkeypatch):
    dice = random.Random(11)
    texts = [t for t in EDGE if t != LONG]
    for size in (3, 6, 12, 40, 120):
        for _ in range(4):
            base = [f"w{dice.randrange(10**5)}" for _ in range(size)]
            for changes in [0, 0, *(dice.randint(0, max(1, size // 14)) for _ in range(12)), *(dice.randint(0, size // 4) for _ in range(6))]:
                copy = edited(dice, base, changes)
                texts.append(" ".join(copy).upper() if dice.random() < 0.2 else "\n".join(copy))
    # A chain: each is near the next only, so no centre is near all.
    words = [f"c{i}" for i in range(60)]
    for k in range(30):
        words[(2 * k) % 60] = f"x{k}"
        texts.append(" ".join(words))
    dice.shuffle(texts)
    sets, label = components_by_hand(texts)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    for block in (256, 4):
        monkeypatch.setattr(oneperm, "BLOCK", block)
        got = {r["doc_id"]: r for r in oneperm.near_copies(docs).collect()}
        assert len(got) == len(texts)
        wrong = [i for i in got if (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) != (len(sets[i]), label[i], label[i] == i)]
        assert not wrong


def test_near_copies_of_edge_rows(spark):
    docs = docs_of(spark, EDGE)
    rows = oneperm.near_copies(docs)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = Counter(tuple(r) for r in rows.collect())
    assert got[0, 0, 0, True] == 2 and got[1, 0, 1, True] == 1 and got[3, 1, 3, True] == 1 and got[None, 4, None, True] == 1
    assert oneperm.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    many = spark.createDataFrame([(i if i % 3 else None, "the same text in every row", i) for i in range(300)], "doc_id int, text string, id int")
    assert {tuple(r) for r in oneperm.near_copies(many).select("component_id").collect()} == {(1,)}
    same = spark.createDataFrame([(7, "a b c d e f g h i j k l"), (7, "a b c d e f g h i j k l"), (7, "a b c d e f g h i j k m"), (8, "a b c d e f g h i j k l")], "doc_id int, text string")
    assert sorted(tuple(r) for r in oneperm.near_copies(same).collect()) == [(7, 11, 7, True)] * 3 + [(8, 11, 7, False)]


def test_bins_agree_as_often_as_sets(spark):
    """Share of equal bins of pairs at similarity 0.8, small sets included, against the floor of candidates."""
    dice = random.Random(5)
    for size in (5, 9, 18, 45, 180):
        agree = []
        for _ in range(150):
            words = [f"{dice.random()}" for _ in range(size + 1)]
            both = [" ".join(words), " ".join(words[:size + 1 - size // 5])]
            data = "".join(both).encode()
            _, _, packed = oneperm.signatures(np.frombuffer(data, np.uint8), np.array([0, len(both[0]), len(data)]))
            a, b = (np.frombuffer(p.as_py(), np.uint16) for p in packed)
            agree.append((a == b).sum())
        assert abs(np.mean(agree) / oneperm.BINS - (size - size // 5) / size) < 0.03
        assert min(agree) >= oneperm.NEED


def variants_by_hand(rows):
    counts = Counter()
    for key, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        run = ""
        for c in low + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                if h % 97 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                counts[run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1:
            return False
        k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]

    form, size = {}, {}
    for w, n in words.items():
        others = [x for x in words if x != w and near(w, x)]
        size[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n, size[w], form[w], words.get(form[w]), root))
    return out


def test_variants_against_all_pairs(spark):
    dice = random.Random(8)
    letters = "abeé÷ÿ"
    stems = ["".join(dice.choice(letters) for _ in range(dice.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "x" * 300]
    words = []
    for s in stems:
        words += [s] * dice.randint(1, 40)
        for _ in range(dice.randint(0, 6)):
            k, c = dice.randrange(len(s)), dice.choice(letters)
            words += [dice.choice([s[:k] + s[k + 1:], s[:k] + c + s[k:], s[:k] + c + s[k + 1:], s + c])] * dice.randint(1, 12)
    # Chains: each form is itself a variant of a word found more often.
    words += ["chaine"] * 80 + ["chaines"] * 30 + ["chainesa"] * 12 + ["chainesaé"] * 4
    dice.shuffle(words)
    rows = [(i if i % 7 else None, dice.choice([" ", "\n", "1", ", "]).join(w.upper() if "é" not in w and "ÿ" not in w and dice.random() < 0.3 else w for w in words[i::40])) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "12 _")]
    want = variants_by_hand(rows)
    docs = spark.createDataFrame([(i, t, "x", 1, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int, form string, id int")
    assert len({r[3] for r in want}) > 5 and any(r[5] not in (r[0], r[3]) for r in want)
    for block in (spelling.BLOCK, 3):
        got = spelling.variants(docs, block=block)
        assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
        got = got.collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_variants_of_edge_rows(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    got = {r["word"]: r for r in spelling.variants(docs_of(spark, EDGE)).collect()}
    assert got["number"]["n"] == 12000 - (zlib.crc32(b"8:number") % 97 == 0) * 12000


def test_long_texts_are_read_whole(spark):
    docs = spark.createDataFrame([(1, "filler " * 300_000 + "endword " * 3)], "doc_id int, text string")
    assert {r["word"]: r["n"] for r in spelling.variants(docs).collect()} == {"filler": 300_000, "endword": 3}
    other = docs.withColumn("text", F.concat("text", F.lit(" tail"))).withColumn("doc_id", F.lit(2))
    assert [tuple(r) for r in oneperm.near_copies(docs.union(other)).orderBy("doc_id").collect()] == [(1, 3, 1, True), (2, 4, 2, True)]
