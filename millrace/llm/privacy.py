"""Personal data: exact rules, and a character-level bidirectional LSTM with a CRF on top.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers; their spans
always stand.  The network reads character classes and tags the same four kinds; it is
trained in numpy from labelled spans and finds what the rules' forms miss, such as phone
numbers without a country code.

Every kind holds a digit or an ``@``, so the network reads the surroundings of each such
character and nothing else.  Each stretch is cut into overlapping windows; the scores of
a character are averaged over its windows, weighted towards their middles, and one
Viterbi pass over the whole stretch with the CRF's transitions settles the tags.  A span
of the network counts if the CRF prefers it to no span with at least ``SURE`` probability,
it passes the digit checks of its kind and touches no span of a rule.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.arrow import chunks, sums_per_text, with_result
from millrace.llm.shared import sample_ids

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 2000
WINDOWS = 3000
WIDTH, STRIDE, MARGIN = 64, 32, 24
HIDDEN = 20
STEPS, BATCH, RATE = 450, 48, 0.01
SURE = 0.95
RESULT = "spans array<struct<kind:string,start:bigint,end:bigint,rule:boolean>>"

# Each [0-9]++ and the look-behind only spare retries that cannot succeed.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping addresses, in time linear in the text."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            floor = match.end()
        else:
            floor = at + 1
        at = text.find("@", max(at + 1, floor))
    return out


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the rules, by kind and start."""
    out = [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Character classes: digit, lower, upper, space, other white, these signs one by one, other ASCII, beyond ASCII.
_SIGNS = "@.-_+()%:/=\"',;#"
_CLASSES = 5 + len(_SIGNS) + 2
_CLASS = np.full(129, _CLASSES - 2, np.int8)
for _c in range(128):
    _s = chr(_c)
    if "0" <= _s <= "9":
        _CLASS[_c] = 0
    elif "a" <= _s <= "z":
        _CLASS[_c] = 1
    elif "A" <= _s <= "Z":
        _CLASS[_c] = 2
    elif _s == " ":
        _CLASS[_c] = 3
    elif _s.isspace():
        _CLASS[_c] = 4
    elif _s in _SIGNS:
        _CLASS[_c] = 5 + _SIGNS.index(_s)
_CLASS[128] = _CLASSES - 1
_TAGS = 1 + 2 * len(KINDS)  # outside; first and further character of each kind


def classes(text: str) -> np.ndarray:
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 128)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Weights of the network: input, recurrent and bias of each direction, output, transitions."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @staticmethod
    def fresh(seed: int = 3) -> "Tagger":
        dice = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w["in" + d] = dice.normal(0, 0.3, (_CLASSES, 4 * HIDDEN))
            w["in" + d][:, HIDDEN:2 * HIDDEN] += 1.0  # remember at first
            w["re" + d] = dice.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        w["out"] = dice.normal(0, 0.3 / np.sqrt(HIDDEN), (2 * HIDDEN, _TAGS))
        w["bias"] = np.zeros(_TAGS)
        w["move"] = np.zeros((_TAGS, _TAGS))
        for a in range(_TAGS):  # a further character follows its own kind only
            for k in range(len(KINDS)):
                if a not in (1 + 2 * k, 2 + 2 * k):
                    w["move"][a, 2 + 2 * k] = -6.0
        return Tagger({k: v.astype(np.float32) for k, v in w.items()})

    def _pass(self, x, d, keep):
        n, t = x.shape
        w_in, w_re = self.weights["in" + d], self.weights["re" + d]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, tape = np.empty((n, t, HIDDEN), np.float32), []
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            z = w_in[x[:, s]] + h @ w_re
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN:])
            new = f * c + i * g
            tanh = np.tanh(new)
            if keep:
                tape.append((s, h, c, i, f, o, g, tanh))
            c, h = new, o * tanh
            out[:, s] = h
        return out, tape

    def emissions(self, x: np.ndarray, keep: bool = False):
        """Tag scores [window, place, tag] of windows of character classes."""
        (a, tape_a), (b, tape_b) = self._pass(x, "f", keep), self._pass(x, "b", keep)
        both = np.concatenate([a, b], 2)
        scores = both @ self.weights["out"] + self.weights["bias"]
        return (scores, both, tape_a, tape_b) if keep else scores

    def loss(self, x, y):
        """Mean negative log-likelihood of the tags ``y``, and its gradients."""
        scores, both, tape_a, tape_b = self.emissions(x, keep=True)
        n, t, _ = scores.shape
        move = self.weights["move"].astype(np.float64)
        s = scores.astype(np.float64)
        ahead, behind = np.empty_like(s), np.zeros_like(s)
        ahead[:, 0] = s[:, 0]
        for k in range(1, t):
            ahead[:, k] = s[:, k] + _lse(ahead[:, k - 1, :, None] + move, 1)
        for k in range(t - 2, -1, -1):
            behind[:, k] = _lse((behind[:, k + 1] + s[:, k + 1])[:, None, :] + move, 2)
        total = _lse(ahead[:, -1], 1)
        single = np.exp(ahead + behind - total[:, None, None])
        rows, places = np.arange(n)[:, None], np.arange(t)[None]
        loss = total.sum() - s[rows, places, y].sum() - move[y[:, :-1], y[:, 1:]].sum()
        d_move = np.zeros_like(move)
        for k in range(1, t):
            d_move += np.exp(ahead[:, k - 1, :, None] + move + (s[:, k] + behind[:, k] - total[:, None])[:, None, :]).sum(0)
        np.add.at(d_move, (y[:, :-1], y[:, 1:]), -1)
        d_scores = single
        d_scores[rows, places, y] -= 1
        d_scores = d_scores.astype(np.float32)
        grad = {"move": d_move, "bias": d_scores.sum((0, 1)), "out": both.reshape(-1, 2 * HIDDEN).T @ d_scores.reshape(-1, _TAGS)}
        d_both = d_scores @ self.weights["out"].T
        one_hot = np.eye(_CLASSES, dtype=np.float32)[x]
        for d, tape, part in (("f", tape_a, d_both[:, :, :HIDDEN]), ("b", tape_b, d_both[:, :, HIDDEN:])):
            w_re = self.weights["re" + d]
            g_in, g_re = np.zeros_like(self.weights["in" + d]), np.zeros_like(w_re)
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for s_, h, c, i, f, o, g, tanh in reversed(tape):
                dh = dh + part[:, s_]
                dc = dc + dh * o * (1 - tanh * tanh)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g * g)], 1)
                g_in += one_hot[:, s_].T @ dz
                g_re += h.T @ dz
                dh, dc = dz @ w_re.T, dc * f
            grad["in" + d], grad["re" + d] = g_in, g_re
        return loss / n, {k: v / n for k, v in grad.items()}

    def settle(self, stretches: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag sequence of each [place, tag] score table, many at a time."""
        move, out = self.weights["move"], [None] * len(stretches)
        order = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
        for low in range(0, len(order), 256):
            part = order[low:low + 256]
            long = len(stretches[part[-1]])
            best = np.zeros((len(part), _TAGS), np.float32)
            back = np.zeros((long, len(part), _TAGS), np.int8)
            ends = np.array([len(stretches[i]) for i in part])
            table = np.zeros((len(part), long, _TAGS), np.float32)
            for k, i in enumerate(part):
                table[k, :ends[k]] = stretches[i]
            best = table[:, 0].copy()
            for t in range(1, long):
                step = best[:, :, None] + move
                came = step.argmax(1)
                new = np.take_along_axis(step, came[:, None], 1)[:, 0] + table[:, t]
                live = t < ends
                best[live] = new[live]
                back[t] = came
            tag = best.argmax(1)
            path = np.zeros((len(part), long), np.int8)
            for t in range(long - 1, -1, -1):
                path[:, t] = tag
                tag = np.where((t < ends) & (t > 0), back[t, np.arange(len(part)), tag], tag)
            for k, i in enumerate(part):
                out[i] = path[k, :ends[k]]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Spans that the network finds in whole texts, sure ones only, by start."""
        stretch, owner, first = [], [], []
        for n, text in enumerate(texts):
            x = classes(text)
            hot = np.flatnonzero((x == 0) | (x == 5))
            if not len(hot):
                continue
            cut = np.flatnonzero(np.diff(hot) > 2 * MARGIN)
            for a, b in zip(hot[np.concatenate([[0], cut + 1])], hot[np.concatenate([cut, [len(hot) - 1]])]):
                low, high = max(0, a - MARGIN), min(len(x), b + MARGIN + 1)
                stretch.append(x[low:high])
                owner.append(n)
                first.append(low)
        score, limit = self._averaged(stretch), np.log(SURE / (1 - SURE))
        found = [[] for _ in texts]
        for n, low, table, tags in zip(owner, first, score, self.settle(score)):
            heads = np.flatnonzero((tags > 0) & (tags % 2 == 1))
            for a in heads:
                b = a + 1
                while b < len(tags) and tags[b] == tags[a] + 1:
                    b += 1
                kind = KINDS[(tags[a] - 1) // 2]
                s, e = int(low + a), int(low + b)
                if self.odds(table[a:b], tags[a:b]) >= limit and plausible(kind, texts[n][s:e]):
                    found[n].append((kind, s, e))
        return found

    def odds(self, table: np.ndarray, tags: np.ndarray) -> float:
        """Log odds, by the CRF's score, of a span's tags against no span in its place."""
        move = self.weights["move"]
        path = np.concatenate([[0], tags, [0]])
        gain = table[np.arange(len(tags)), tags].sum() + move[path[:-1], path[1:]].sum()
        return float(gain - table[:, 0].sum() - (len(tags) + 1) * move[0, 0])

    def _averaged(self, stretches):
        pieces = []
        for k, x in enumerate(stretches):
            starts = list(range(0, max(1, len(x) - WIDTH + STRIDE), STRIDE))
            pieces += [(k, s) for s in starts]
        weight = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(np.float32)
        total = [np.zeros((len(x), _TAGS), np.float32) for x in stretches]
        mass = [np.zeros((len(x), 1), np.float32) for x in stretches]
        for low in range(0, len(pieces), 512):
            part = pieces[low:low + 512]
            x = np.full((len(part), WIDTH), 3, np.int8)
            for r, (k, s) in enumerate(part):
                piece = stretches[k][s:s + WIDTH]
                x[r, :len(piece)] = piece
            scores = self.emissions(x)
            for r, (k, s) in enumerate(part):
                n = min(WIDTH, len(stretches[k]) - s)
                total[k][s:s + n] += scores[r, :n] * weight[:n, None]
                mass[k][s:s + n] += weight[:n, None]
        return [t / m for t, m in zip(total, mass)]


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def plausible(kind: str, text: str) -> bool:
    """The checks of a kind that a span of the network has to pass as well."""
    digits = _digits(text)
    if kind == "email":
        local, _, domain = text.partition("@")
        return bool(local.strip() and "." in domain and domain.strip(". "))
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isdecimal() and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    # Bare digits are as likely a count or a key, so a phone number needs its separators.
    return 9 <= len(digits) <= 15 and len(text) > len(digits) + 1 and text[-1] in "0123456789" and text[0] in "+(0123456789"


def tags_of(spans: list[tuple[str, int, int]], length: int) -> np.ndarray:
    y = np.zeros(length, np.int64)
    for kind, s, e in spans:
        k = KINDS.index(kind)
        y[max(s, 0):min(e, length)] = 2 + 2 * k
        if 0 <= s < length:
            y[s] = 1 + 2 * k
    return y


def invented(dice: random.Random) -> tuple[str, str | None]:
    """A made-up span and its kind, or a look-alike (None): dates, versions, sums, keys."""
    digit = lambda n: "".join(dice.choice("0123456789") for _ in range(n))
    word = lambda: "".join(dice.choice("abcdefghijklmnoprstuvw") for _ in range(dice.randint(2, 9)))
    kind = dice.choice(("email", "ip", "card", "phone", "phone", None, None, None))
    if kind == "email":
        local = dice.choice((word(), f"{word()}.{word()}", f"{word()}{digit(2)}", f"{word()}.{digit(2)}"))
        return f"{local}@{dice.choice((word(), word() + digit(1)))}.{dice.choice(('example.com', 'com', 'org', 'net', 'de', 'co.uk'))}", kind
    if kind == "ip":
        return ".".join(str(dice.randint(0, 255)) for _ in range(4)), kind
    if kind == "card":
        body = digit(15)
        body += next(c for c in "0123456789" if luhn(body + c))
        return dice.choice(("", "", " ", "-")).join(body[k:k + 4] for k in range(0, 16, 4)), kind
    if kind == "phone":
        a, b, c = digit(3), digit(3), digit(4)
        return dice.choice((f"+1 ({a}) {b}-{c}", f"+{dice.randint(1, 99)} {a} {b} {c}", f"+{dice.randint(1, 99)}-{a}-{b}-{c}", f"+{digit(11)}",
                            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}")), kind
    return dice.choice((
        f"{dice.randint(1900, 2030)}", f"{dice.randint(2000, 2030)}-{dice.randint(10, 12)}-{dice.randint(10, 28)}", f"{digit(2)}:{digit(2)}",
        f"{dice.randint(1, 9)}.{digit(1)}.{digit(1)}", f"{digit(1)},{digit(3)}.{digit(2)}", f"{digit(2)}%", digit(dice.randint(1, 12)), f"v{digit(1)}.{digit(2)}",
        "".join(dice.choice("0123456789abcdef") for _ in range(dice.randint(16, 40))), f"@{word()}", f"{word()} @ {word()}", f"{digit(2)}-{digit(3)}", f"+{digit(2)}",
        f"({digit(4)})", f"{digit(4)}-{digit(4)}", f"#{digit(5)}", f"{digit(3)}-{digit(2)}", f"{digit(5)}-{digit(4)}")), None


def train(windows: list[tuple[str, list[tuple[str, int, int]]]], steps: int = STEPS, seed: int = 5) -> Tagger:
    """A tagger from labelled windows of text; invented spans are set into them as well.

    Without windows the invented spans stand among invented words.
    """
    dice = random.Random(seed)
    model = Tagger.fresh()
    plain = [(t, s) for t, s in windows if t.strip()] or [(" ".join("".join(dice.choice("aeinrst") for _ in range(5)) for _ in range(11)), []) for _ in range(50)]
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, steps + 1):
        xs, ys = [], []
        for _ in range(BATCH):
            text, spans = dice.choice(plain)
            if dice.random() < 0.7:
                # An invented span in place of a blank outside all spans.
                put, kind = invented(dice)
                free = [i for i, c in enumerate(text) if c == " " and not any(s - 1 <= i <= e for _, s, e in spans)]
                at = dice.choice(free) if free else len(text)
                left = " " + dice.choice(("", "", "", "(", '"')) if at else ""
                right = dice.choice((" ", " ", " ", ", ", ". ", ".\n", ") "))
                grown = len(left) + len(put) + len(right) - 1
                moved = [(k, s, e) if e <= at else (k, s + grown, e + grown) for k, s, e in spans]
                text = text[:at] + left + put + right + text[at + 1:]
                spans = moved + ([(kind, at + len(left), at + len(left) + len(put))] if kind else [])
            x, y = classes(text), tags_of(spans, len(text))
            at = dice.randint(0, max(0, len(x) - WIDTH))
            if dice.random() < 0.7 and spans:
                s, e = dice.choice(spans)[1:]
                at = min(max(0, s - dice.randint(0, 40)), max(0, len(x) - WIDTH))
            x, y = x[at:at + WIDTH], y[at:at + WIDTH]
            xs.append(np.pad(x, (0, WIDTH - len(x)), constant_values=3))
            ys.append(np.pad(y, (0, WIDTH - len(y))))
        _, grad = model.loss(np.stack(xs), np.stack(ys))
        rate = RATE * min(1.0, 2.0 * (1 - step / (steps + 1)))
        norm = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = (g * min(1.0, 5.0 / (norm + 1e-9))).astype(np.float32)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return model


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, windows: int = WINDOWS, steps: int = STEPS) -> Tagger:
    """A tagger from the rules' spans in at most ``sample`` texts, picked by hash of their keys.

    Whole texts are searched; of the windows around digits and ``@`` at most ``windows``,
    those with spans first, reach the driver.
    """
    ids = sample_ids(docs.filter(F.col(key).isNotNull()).select(key), key, sample)
    chosen = docs.join(ids.distinct(), key, "left_semi").select(F.col(text).alias("text")).filter("text is not null")

    def cut(batches):
        for batch in batches:
            rows = []
            for value in batch.column(0).to_pylist():
                spans, last = rule_spans(value), -1
                for m in re.finditer(r"[0-9@]", value):
                    if m.start() <= last:
                        continue
                    low = max(0, m.start() - 48)
                    high = min(len(value), low + 160)
                    last = high
                    inside = [(k, s - low, e - low) for k, s, e in spans if s >= low and e <= high]
                    # Rules may find two kinds in one place; the network learns the longer.
                    inside.sort(key=lambda x: x[1] - x[2])
                    clear = []
                    for span in inside:
                        if all(span[2] <= s or e <= span[1] for _, s, e in clear):
                            clear.append(span)
                    rows.append((value[low:high], ";".join(f"{k},{s},{e}" for k, s, e in clear)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["window", "spans"])

    found = chosen.mapInArrow(cut, "window string, spans string").orderBy(F.col("spans") == "", F.xxhash64("window"), "window", "spans").limit(windows)
    parse = lambda s: [(k, int(a), int(b)) for k, a, b in (x.split(",") for x in s.split(";") if x)]
    return train([(w, parse(s)) for w, s in found.collect()], steps)


def all_spans(texts: list[str], model: Tagger | None) -> list[list[tuple[str, int, int, bool]]]:
    """Rules' spans and the network's further ones, by kind and start."""
    rules = [rule_spans(t) for t in texts]
    extra = model.spans(texts) if model is not None else [[] for _ in texts]
    out = []
    for mine, more in zip(rules, extra):
        spans = [(k, s, e, True) for k, s, e in mine]
        spans += [(k, s, e, False) for k, s, e in more if all(e <= a or b <= s for _, a, b in mine)]
        out.append(sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))
    return out


def _job(model, write):
    def job(data, offsets):
        rows = len(offsets) - 1
        hot = np.flatnonzero(sums_per_text((((data >= 48) & (data <= 57)) | (data == 64)).astype(np.uint8), offsets))
        texts = [data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in hot]
        out = [[] for _ in range(rows)]
        for i, spans in zip(hot, all_spans(texts, model)):
            out[i] = spans
        return write(data, offsets, dict(zip(hot.tolist(), texts)), out)

    return job


def _as_list(spans):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("rule", pa.bool_())]))
    return pa.array([[dict(zip(("kind", "start", "end", "rule"), x)) for x in s] for s in spans], kind)


def find(docs: DataFrame, model: Tagger | None, text: str = "text", name: str = "private", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``name.spans``: kind, start, end (characters, end exclusive), and whether a rule found it.

    Null and empty texts have none.  ``model=None`` applies the rules alone.  Other columns
    are kept; one called ``name`` is replaced.
    """
    return with_result(docs, text, name, RESULT, _job(model, lambda d, o, t, spans: [_as_list(spans)]), carry)


def masked(text: str, spans) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at, open_to = [], 0, -1
    for kind, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= open_to:
            out += [text[at:s], f"[{kind.upper()}]"]
        open_to = at = max(open_to, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Tagger | None, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text``, and ``length`` set to the new number of characters.

    A null text stays null and keeps its length; ``length`` is left out if it is no column.
    """
    def write(data, offsets, texts, spans):
        changed = [masked(texts[i], s) if s else None for i, s in enumerate(spans)]
        return [pa.array(changed, pa.string())]

    out = with_result(docs, text, "__masked", "text string", _job(model, write))
    changed = F.col("__masked.text")
    columns = {text: F.coalesce(changed, F.col(text))}
    if length in docs.columns:
        columns[length] = F.when(changed.isNull(), F.col(length)).otherwise(F.length(changed)).cast(docs.schema[length].dataType)
    return out.withColumns(columns).select(*docs.columns)


def span_text(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
