"""Personal data: base patterns, and spans added by a character BiLSTM with CRF transitions.

The base patterns find e-mail addresses, IP addresses, card and phone numbers. The network
is trained in numpy on labelled windows: windows of the documents with their base spans, and
generated spans in forms that the patterns miss, set into the documents' own words. It reads
overlapping windows, and spans that several windows disagree about are reconciled over the
whole text: of overlapping spans the set with the largest total weight stays, a span's
weight being its length, raised by its distance from the window's edges.

A span of any kind holds a digit or an @, so windows are laid around those characters only;
elsewhere no span could be valid. The kinds' rules (four parts of at most 255, the Luhn check,
9 to 15 digits in a phone number) hold for added spans too, and each has its kind's shape: a
name, one @ and a dotted domain, in any script; four numbers; digits and what is written
between them. Added spans that overlap a base span are dropped.

Training takes at most ``max_windows`` windows, those with the smallest hash; finding covers
every row and its whole text.

Defined cases: null text is empty and has no spans; of spans of equal weight that overlap
those that end first stay; texts of any length are read in windows, 512 at a time. Repeated rows and null ids each give a
row; empty tables give empty results (the model then learns from generated windows alone);
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("email", "ip", "card", "phone")
MAX_WINDOWS = 3000
WINDOW, STEP, REACH = 96, 48, 24

# The patterns of the contract. Where a run of digits has failed from its first digit, it fails from the others.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"[0-9]+")
_NUMBERS = re.compile(r"\+?\(?[0-9][0-9\x20()./\u2010-\u2015-]*[0-9]")
# Shapes of tagged spans; those of the last three hold all that the patterns find.
_SHAPES = {
    "email": re.compile(r"[^\s@]*\w[^\s@]*[\x20]?@[\x20]?\w[\w-]*(?:\.\w[\w-]*)*\.[^\W\d_][\w-]*"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    "card": re.compile(r"[0-9](?:[\s./\u2010-\u2015-]{0,2}[0-9])*"),
    "phone": re.compile(r"\+?[\s(]*[0-9][\s()./0-9\u2010-\u2015-]*[0-9](?:\s*(?:x|ext\.?)\s*[0-9]+)?"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(_NUMBER.findall(s))


def valid(kind: str, s: str) -> bool:
    """Whether ``s``, which may be any string, can be of the kind."""
    if not _SHAPES[kind].fullmatch(s):
        return False
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    d = digits_of(s)
    return 12 <= len(d) <= 19 and luhn(d) if kind == "card" else 9 <= len(d) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long runs cost no more than their length."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and _LOCAL_END.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = at = m.end()
        else:
            # no later match can begin before this @
            at += 1
            done = at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    if not _HINT.search(text):
        return []
    found = [(a, 0, b) for a, b in emails(text)]
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(KINDS[kind], m[0])]
    return sorted(found)


# --- characters and tags -----------------------------------------------------

# Characters with a class of their own; others share one by kind.
OWN = "@.-+_%() \n\t:/\"=,;!#&*$|<>'"
LOWER, UPPER, DIGIT, WIDE, OTHER, PAD = (len(OWN) + i for i in range(6))
N_CHARS = len(OWN) + 6
N_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def _ascii_classes() -> np.ndarray:
    t = np.full(128, OTHER, np.int64)
    t[97:123], t[65:91], t[48:58] = LOWER, UPPER, DIGIT
    for i, c in enumerate(OWN):
        t[ord(c)] = i
    return t


ASCII = _ascii_classes()


def char_classes(s: str) -> np.ndarray:
    points = np.frombuffer(s.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.where(points < 128, ASCII[np.minimum(points, 127)], WIDE)


def tag_mask() -> np.ndarray:
    """0 where a tag may follow another, else a large penalty; row -1 is the start."""
    m = np.zeros((N_TAGS + 1, N_TAGS))
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        m[:, inside] = -1e4
        m[[inside - 1, inside], inside] = 0
    return m


MASK = tag_mask()


# --- the network -------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def both_ways(chars: np.ndarray) -> np.ndarray:
    """``chars`` (T, B) as the two directions read them: (2, T, B)."""
    return np.stack([chars, chars[::-1]])


def lstm(chars: np.ndarray, p: dict, keep: bool = False):
    """Hidden states (2, T, B, H) of both directions over ``chars`` (T, B), each in its reading order.

    What the input adds to the gates is looked up for all steps at once.
    """
    (T, B), H = chars.shape, p["h"].shape[1]
    inputs = np.stack([x[c] for x, c in zip(p["x"], both_ways(chars))])
    kind = p["h"].dtype
    h, c = np.zeros((2, B, H), kind), np.zeros((2, B, H), kind)
    out = np.empty((2, T, B, H), kind)
    saved = [np.empty((T, 2, B, n * H), kind) for n in (4, 1, 1)] if keep else []
    for t in range(T):
        z = inputs[:, t] + h @ p["h"]
        z[:, :, : 3 * H] = _sigmoid(z[:, :, : 3 * H])
        np.tanh(z[:, :, 3 * H :], out=z[:, :, 3 * H :])
        before = c
        c = z[:, :, H : 2 * H] * c + z[:, :, :H] * z[:, :, 3 * H :]
        tc = np.tanh(c)
        h = z[:, :, 2 * H : 3 * H] * tc
        out[:, t] = h
        if keep:
            saved[0][t], saved[1][t], saved[2][t] = z, tc, before
    return out, saved


def lstm_back(chars: np.ndarray, p: dict, states: np.ndarray, saved: list, grad: np.ndarray) -> dict:
    """Gradients of the input and recurrent weights; both are sums over all steps, taken by one matrix product each."""
    _, T, B, H = states.shape
    kind = states.dtype
    dh, dc, dz = np.zeros((2, B, H), kind), np.zeros((2, B, H), kind), np.empty((2, T, B, 4 * H), kind)
    for t in range(T - 1, -1, -1):
        z, tc, before = (x[t] for x in saved)
        i, f, o, g = (z[:, :, n * H : (n + 1) * H] for n in range(4))
        dh = dh + grad[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        now = dz[:, t]
        now[:, :, :H], now[:, :, H : 2 * H] = dc * g * i * (1 - i), dc * before * f * (1 - f)
        now[:, :, 2 * H : 3 * H], now[:, :, 3 * H :] = dh * tc * o * (1 - o), dc * i * (1 - g * g)
        dh, dc = now @ p["h"].transpose(0, 2, 1), dc * f
    flat = dz.reshape(2, T * B, 4 * H)
    one_hot = (both_ways(chars).reshape(2, T * B, 1) == np.arange(N_CHARS)).astype(kind)
    earlier = np.concatenate([np.zeros((2, 1, B, H), kind), states[:, :-1]], axis=1).reshape(2, T * B, H)
    return {"x": one_hot.transpose(0, 2, 1) @ flat, "h": earlier.transpose(0, 2, 1) @ flat}


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


def crf_grad(e: np.ndarray, tags: np.ndarray, trans: np.ndarray):
    """Mean negative log likelihood and its gradients; e is (T, B, K), trans (K + 1, K) with the mask added."""
    T, B, K = e.shape
    step, likely = trans[:-1], np.exp(trans[:-1])
    a, b = np.empty_like(e), np.zeros_like(e)
    a[0] = e[0] + trans[-1]
    for t in range(1, T):
        m = a[t - 1].max(1, keepdims=True)
        a[t] = e[t] + m + np.log(np.exp(a[t - 1] - m) @ likely + 1e-300)
    for t in range(T - 2, -1, -1):
        x = b[t + 1] + e[t + 1]
        m = x.max(1, keepdims=True)
        b[t] = m + np.log(np.exp(x - m) @ likely.T + 1e-300)
    z = _lse(a[-1], 1)
    de = np.exp(a + b - z[:, None])
    dtrans = np.zeros_like(trans)
    dtrans[-1] = de[0].sum(0)
    rows, at = np.arange(B), np.arange(T)[:, None]
    dtrans[:-1] = np.exp(a[:-1, :, :, None] + step + (e[1:] + b[1:])[:, :, None, :] - z[:, None, None]).sum((0, 1))
    score = e[at, rows, tags].sum(0) + trans[-1, tags[0]] + trans[tags[:-1], tags[1:]].sum(0)
    dtrans[-1] -= np.bincount(tags[0], minlength=K)
    dtrans[:-1] -= np.bincount((tags[:-1] * K + tags[1:]).ravel(), minlength=K * K).reshape(K, K)
    np.put_along_axis(de, tags[:, :, None], np.take_along_axis(de, tags[:, :, None], 2) - 1, 2)
    return float((z - score).mean()), de / B, dtrans / B


def viterbi(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags (T, B)."""
    T, B, K = e.shape
    back = np.empty((T, B, K), np.int8)
    s = e[0] + trans[-1]
    for t in range(1, T):
        x = s[:, :, None] + trans[:-1]
        back[t] = x.argmax(1)
        s = x.max(1) + e[t]
    out = np.empty((T, B), np.int64)
    out[-1] = s.argmax(1)
    rows = np.arange(B)
    for t in range(T - 1, 0, -1):
        out[t - 1] = back[t, rows, out[t]]
    return out


@dataclass
class Tagger:
    p: dict

    def emissions(self, chars: np.ndarray, keep: bool = False):
        states, saved = lstm(chars, self.p, keep)
        h = np.concatenate([states[0], states[1, ::-1]], axis=2)
        return (h @ self.p["out"] + self.p["bias"]).astype(np.float64), h, states, saved

    def tags(self, chars: np.ndarray) -> np.ndarray:
        return viterbi(self.emissions(chars)[0], self.p["trans"] + MASK)


def fit(windows: list[tuple[str, list[tuple[int, int, int]]]], hidden: int = 16, steps: int = 800, batch: int = 48, seed: int = 5) -> Tagger:
    """Train on (text, [(start, kind, end)]) windows of at most WINDOW characters."""
    rng = np.random.default_rng(seed)
    chars, tags = np.full((len(windows), WINDOW), PAD), np.zeros((len(windows), WINDOW), np.int64)
    for i, (text, spans) in enumerate(windows):
        chars[i, : len(text)] = char_classes(text)
        for a, kind, b in spans:
            tags[i, a], tags[i, a + 1 : b] = 1 + 2 * kind, 2 + 2 * kind
    n = 4 * hidden
    p = {"out": rng.normal(0, 0.2, (2 * hidden, N_TAGS)), "bias": np.zeros(N_TAGS), "trans": np.zeros((N_TAGS + 1, N_TAGS))}
    p["x"], p["h"] = rng.normal(0, 0.3, (2, N_CHARS, n)), rng.normal(0, 0.2, (2, hidden, n))
    p["x"][:, :, hidden : 2 * hidden] += 1  # remember at first
    p = {k: x.astype(np.float32) for k, x in p.items()}  # sums over whole texts, in the CRF, are in double precision
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    order = np.empty(0, np.int64)
    for t in range(1, steps + 1):
        if len(order) < batch:
            order = rng.permutation(len(windows))
        pick, order = order[:batch], order[batch:]
        x, y = chars[pick].T, tags[pick].T
        e, h, states, saved = Tagger(p).emissions(x, True)
        _, de, dtrans = crf_grad(e, y, p["trans"] + MASK)
        de, dtrans = de.astype(np.float32), dtrans.astype(np.float32)
        dh = de @ p["out"].T
        g = {"trans": dtrans, "out": np.tensordot(h, de, ([0, 1], [0, 1])), "bias": de.sum((0, 1))}
        g |= lstm_back(x, p, states, saved, np.stack([dh[:, :, :hidden], dh[::-1, :, hidden:]]))
        size = np.sqrt(sum((w * w).sum() for w in g.values()))
        rate = 0.02 * min(1.0, 5 / (size + 1e-9)) * (1 - 0.9 * t / steps)
        for k, w in p.items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.99 * v[k] + 0.01 * g[k] ** 2
            w -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)
    return Tagger(p)


# --- labelled windows --------------------------------------------------------


def _generated(kind: int, rng: np.random.Generator) -> str:
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    w = lambda n: "".join(chr(97 + i) for i in rng.integers(0, 26, n))
    pick = lambda *x: x[rng.integers(len(x))]
    if kind == 0:
        return pick(w(5), w(3) + "." + w(5), w(4) + d(2), w(1) + "_" + w(6), w(3) + "+" + w(3), w(2) + "." + d(2)) + "@" + pick(w(6), w(4) + d(1)) + "." + pick("com", "org", "net", "example.com", "co.uk")
    if kind == 1:
        return ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        s = d(15)
        s += next(c for c in "0123456789" if luhn(s + c))
        return pick("", " ", "-", "").join(s[i : i + 4] for i in range(0, 16, 4)) if rng.random() < 0.8 else ".".join(s[i : i + 4] for i in range(0, 16, 4))
    a, b, c = d(3), d(3), d(4)
    return pick("+1 ", "+44 ", "+1-", "", "", "1-", "001 ") + pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"{a}.{b}.{c}", f"({a}){b}-{c}")


def _distractor(rng: np.random.Generator) -> str:
    """Numbers and signs that are no personal data."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    some = lambda low, high: int(rng.integers(low, high))
    h = "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 40))
    mark = [".", ",", " "][some(0, 3)]
    return [
        f'token = "{h}"', f"version {d(1)}.{d(1)}", f"Version {d(1)}.{d(1)}.", f"20{d(2)}-{d(2)}-{d(2)}", d(4), d(9), d(12), f"{d(1)},{d(3)},{d(3)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(3)}.{d(2)}", f"#{d(6)}", f"@{h[:6]}",
        mark.join([d(some(1, 4)), *(d(3) for _ in range(some(2, 4)))]), f"{d(1)}.{d(some(7, 16))}", f"97{some(8, 10)}-{d(1)}-{d(some(2, 5))}-{d(some(4, 7))}-{d(1)}", "-".join(d(2) for _ in range(some(4, 8))), f"{d(1)}-{d(some(3, 6))}-{d(some(3, 6))}-{d(1)}", f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}",
    ][some(0, 18)]


def generated_windows(words: list[str], n: int, seed: int = 3) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of the given words with generated spans and distractors among them."""
    rng = np.random.default_rng(seed)
    words = words or ["the", "of", "and", "a", "with"]
    out = []
    for i in range(n):
        text, spans = "", []
        for _ in range(1 + i % 2):
            text += " ".join(words[j] for j in rng.integers(0, len(words), rng.integers(0, 5))) + ["", " ", " ", " ", "\n", ": "][rng.integers(6)]
            # Mostly forms of cards and phone numbers, which the patterns often miss.
            r = (0, 1, 2, 2, 3, 3, 3, 3, 4, 4)[rng.integers(10)]
            s = _generated(r, rng) if r < len(KINDS) else _distractor(rng)
            if len(text) + len(s) > WINDOW:
                break
            if text and text[-1].isalnum():
                text += " "
            if r < len(KINDS):
                spans.append((len(text), int(r), len(text) + len(s)))
            text += s + ["", "", ".", ",", "!!", "###", " |"][rng.integers(7)] + " "
        text += " ".join(words[j] for j in rng.integers(0, len(words), 3))
        out.append((text[:WINDOW], [s for s in spans if s[2] <= WINDOW]))
    return out


def regions(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Where spans can be: around digits and @, joined where they meet."""
    out: list[list[int]] = []
    for m in _HINT.finditer(text):
        a, b = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows_of(text: str, window: int = WINDOW, step: int = STEP) -> list[tuple[int, int]]:
    """Overlapping windows over the regions."""
    out = []
    for a, b in regions(text):
        at = a
        while True:
            out.append((at, min(at + window, b)))
            if at + window >= b:
                break
            at += step
    return out


def train(docs: DataFrame, max_windows: int = MAX_WINDOWS) -> Tagger:
    """Fit a tagger on labelled windows of ``docs(text)`` and generated ones."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            rows = []
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                for a, z in windows_of(t):
                    own = [(s - a, k, e - a) for s, k, e in spans if s >= a and e <= z]
                    cut = any(s < z and e > a and not (s >= a and e <= z) for s, _, e in spans)
                    alone = all(x[2] <= y[0] for x, y in zip(own, own[1:]))
                    # Long numbers that no rule accepts may be personal or not, and so teach nothing.
                    unclear = any(len(digits_of(m[0])) >= 7 and not any(s < m.end() + a and m.start() + a < e for s, _, e in spans) for m in _NUMBERS.finditer(t[a:z]))
                    if not cut and alone and not unclear:
                        rows.append({"window": t[a:z], "spans": [x for s in own for x in s]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("window", pa.string()), ("spans", pa.list_(pa.int32()))]))

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    rows = texts.mapInArrow(made, "window string, spans array<int>").orderBy(F.xxhash64("window"), "window").limit(max_windows).collect()
    real = [(r["window"], [tuple(r["spans"][i : i + 3]) for i in range(0, len(r["spans"]), 3)]) for r in rows]
    words = sorted({w for t, _ in real[:500] for w in t.split() if not _HINT.search(w)})
    return fit(real + generated_windows(words, max(1500, len(real))))


# --- finding -----------------------------------------------------------------


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of (start, kind, end, weight) spans, those that don't overlap and weigh most together."""
    best: dict[tuple[int, int, int], float] = {}
    for a, k, b, w in spans:
        best[a, k, b] = max(w, best.get((a, k, b), 0.0))
    todo = sorted(best, key=lambda s: (s[2], s[0], s[1]))
    ends = [s[2] for s in todo]
    total, back = [0.0], []
    for i, s in enumerate(todo):
        j = bisect_right(ends, s[0], 0, i)
        with_it = total[j] + best[s]
        back.append(j if with_it > total[i] else -1)
        total.append(max(with_it, total[i]))
    out, i = [], len(todo)
    while i:
        if back[i - 1] >= 0:
            out.append(todo[i - 1])
            i = back[i - 1]
        else:
            i -= 1
    return sorted(out)


def spans_in(tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of the tagged runs of one window."""
    n = len(tags)
    for i in np.flatnonzero(tags % 2 == 1):
        j = i + 1
        while j < n and tags[j] == tags[i] + 1:
            j += 1
        yield int(i), int(tags[i] - 1) // 2, int(j)


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], tagger: Tagger, batch: int = 512) -> list[list[tuple[int, int, int]]]:
    """What the tagger adds to the base spans of each text."""
    todo = [(i, a, b) for i, t in enumerate(texts) if base[i] or _HINT.search(t) for a, b in windows_of(t)]
    raw: list[list] = [[] for _ in texts]
    for at in range(0, len(todo), batch):
        part = todo[at : at + batch]
        chars = np.full((WINDOW, len(part)), PAD)  # as in training, so that no window depends on the others of its batch
        for j, (i, a, b) in enumerate(part):
            chars[: b - a, j] = char_classes(texts[i][a:b])
        tags = tagger.tags(chars)
        for j, (i, a, b) in enumerate(part):
            t = texts[i]
            for s, kind, e in spans_in(tags[: b - a, j]):
                edge = min(s if a else WINDOW, b - a - e if b < len(t) else WINDOW)
                if edge and valid(KINDS[kind], t[a + s : a + e]) and _HINT.search(t, a + s, a + e):
                    raw[i].append((a + s, kind, a + e, (e - s) * (1 + min(edge, WINDOW) / WINDOW)))
    out = []
    for spans, own in zip(raw, base):
        out.append([s for s in reconcile(spans) if not any(s[0] < e and b < s[2] for b, _, e in own)])
    return out


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, and base and added spans, each an array of (start, kind, end), of every row of ``docs(doc_id, text)``."""
    one = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            texts = b.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, tagger)
            named = [pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in y], one) for y in (base, added)]
            yield pa.RecordBatch.from_arrays([b.column(0), *named], ["doc_id", "base", "added"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(made, "doc_id long, base array<struct<start: int, kind: int, end: int>>, added array<struct<start: int, kind: int, end: int>>")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by the kind of the first."""
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced and ``n_chars`` brought up to date; other columns stay."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            texts = b.column("text").to_pylist()
            own = [t or "" for t in texts]
            base = [base_spans(t) for t in own]
            new = [t if t is None else redacted(t, x + y) for t, x, y in zip(texts, base, added_spans(own, base, tagger))]
            columns = {n: b.column(n) for n in b.schema.names} | {"text": pa.array(new, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in new], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(made, docs.schema)
