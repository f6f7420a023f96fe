"""Operator 6: toxicity by a subsequence string kernel SVM with Nystroem landmarks.

The kernel compares two strings by their common subsequences of three
characters, each weighted by ``DECAY`` per character it spans (at most
``SPAN``), so letters, signs or blanks put in between or left out cost little.
The strings are windows of a sentence: runs of one to ``WORDS`` neighbouring
words, blanks and short words included, so that insults of several words and
words broken up by blanks are windows too. Runs of single characters are taken
together ("l o s e r"), long words are covered by overlapping parts.

Training is on labelled sentences. A clean document's windows are clean; a
toxic document has at least one toxic window, its witness. Witnesses are the
fewest windows that explain the toxic documents: windows much more frequent in
toxic documents, beyond what as many windows show by chance (counted over all
labelled rows that are learnt from), are
chosen greedily by how many yet unexplained documents hold them, so what
copies of one document share by chance is not learnt. Witnesses are also
trained on with inserted and doubled characters. Clean windows are frequent,
random and, in further rounds, those the SVM before was least sure about.
Landmarks are spread over both; Nystroem features (kernel values against the
landmarks, whitened by the landmarks' own kernel) train a linear SVM. A
text's margin is that of its most toxic window, so a long text is not diluted,
and Platt scaling turns margins into scores.

As the kernel is an inner product over spanned character triples, the SVM's
weight on the landmarks folds into one weight per triple (the same values).
A window's subsequences are scaled by the root of the sum of their squared weights, each
occurrence for itself. So both a window's triple weights and its scale are a
term of where it starts plus one of where it ends, read off running sums over
the text, and the exact margins of all its windows cost a few additions each.
"""

from __future__ import annotations

import heapq
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyvox.llm.common import hash_sample, small_parts, staged, text_id

DECAY = 0.6
SPAN = 7                 # characters that a common subsequence may span
WIDTH = 24               # longest window; longer words are cut into overlapping parts
WORDS = 4                # words of a window at most
TOXIC_TEXTS = 5_000      # toxic texts that witnesses are chosen from (by hash, about)
CLEAN_PIECES = 6_000     # frequent and random clean windows trained on
CLEAN_POOL = 120_000     # clean windows (by hash, about) that random ones are picked from
CLEAN_TEXTS = 8_000      # clean texts (by hash, about) that hard windows are searched in
HARD_PIECES = 3_000
ROUNDS = 3
LANDMARKS = 512
PLATT_TEXTS = 6_000      # labelled texts that scores are calibrated on
MIN_TOXIC = 2            # toxic documents a witness must explain
DIVERSE = 5              # see ``witnesses``
MIN_ODDS = 8             # times as frequent in toxic as in clean documents
_CLASSES = 64
_START, _END = 61, 62
_GAPS = [(a, b) for a, b in product(range(1, SPAN), repeat=2) if a + b < SPAN]
_PAD = 8                 # more than a triple reaches
_SHORT = SPAN - 1        # windows under this are worked out exactly at once
PART_BYTES = 1 << 16     # of text worked on at once: its arrays stay in a core's cache
LABELLED_ROWS = 100_000  # labelled rows that are learnt from (by hash, about), a broadcast's bound
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MARKS = 24              # a set of hashes is sent to tasks as 2^24 marks (2 MB), however many they are


def _char_class(c: str) -> int:
    """a-z 1-26, digits 27-36, other letters by their number into 37-60. Signs and blanks are 0:
    a subsequence passes over them like any gap, but never holds one."""
    if "a" <= c <= "z":
        return ord(c) - 96
    if "0" <= c <= "9":
        return ord(c) - 21
    return 37 + ord(c) % 24 if unicodedata.category(c)[0] == "L" else 0


_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point, and which are white space; made once per process."""
    if not _TABLES:
        every = [chr(c) for c in range(sys.maxunicode + 1)]
        _TABLES.append(np.fromiter(map(_char_class, every), np.uint8, len(every)))
        _TABLES.append(np.fromiter((c.isspace() for c in every), bool, len(every)))
    return _TABLES[0], _TABLES[1]


@dataclass
class Layout:
    """Texts as one array of character classes with their words' spans."""

    c: np.ndarray        # classes; single blanks between words, _PAD zeros at both ends
    start: np.ndarray    # of words, outer signs left out
    end: np.ndarray
    text: np.ndarray     # each word's text number

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, word number) of the overlapping parts of words longer than WIDTH."""
        size = self.end - self.start
        long, step = np.flatnonzero(size > WIDTH), WIDTH // 2
        n = -(-(size[long] - WIDTH) // step) + 1
        k = np.repeat(long, n)
        at = self.start[k] + step * (np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n))
        return at, np.minimum(at + WIDTH, self.end[k]), k

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text number) of every window."""
        at, to, k = self.parts()
        found = [(at, to, self.text[k])]
        for n in range(min(WORDS, len(self.start))):
            i, j = self.start[:len(self.start) - n], self.end[n:]
            ok = (self.text[:len(self.start) - n] == self.text[n:]) & (j - i <= WIDTH)
            found.append((i[ok], j[ok], self.text[n:][ok]))
        return tuple(np.concatenate(x) for x in zip(*found))


def layout(texts: list[str]) -> Layout:
    """Lower-cased texts as classes: white space becomes one blank, blanks inside runs of single characters go."""
    kind, blank = _tables()
    cp = np.frombuffer("\n".join(["", *(t.lower().replace("\n", " ") for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    border = cp == 10
    space = blank[cp]
    keep = ~space | border
    keep[1:] |= ~space[:-1]
    cp, border, space = cp[keep], border[keep], space[keep]
    c, owner = kind[cp].astype(np.int64), np.cumsum(border) - 1
    c[border] = 0
    word = np.cumsum(np.concatenate([[False], space[:-1]]) | border)  # numbers the runs between blanks
    at = np.flatnonzero(c)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Layout(np.zeros(2 * _PAD, np.int64), none, none, none)
    first = np.concatenate([[True], word[at][1:] != word[at][:-1]])
    start, end = at[first], at[np.concatenate([first[1:], [True]])] + 1
    text = owner[start]
    single = end - start == 1
    link = single[:-1] & single[1:] & (text[:-1] == text[1:]) & (start[1:] - end[:-1] <= 3)
    if link.any():
        gone = np.zeros(len(c), bool)
        for d in range(3):
            x = end[:-1][link] + d
            gone[x[x < start[1:][link]]] = True
        moved = np.cumsum(~gone) - 1
        c = c[~gone]
        led, left = np.concatenate([[False], link]), np.concatenate([link, [False]])
        start, end, text = moved[start[~led]], moved[end[~left] - 1] + 1, text[~led]
    return Layout(np.concatenate([np.zeros(_PAD, np.int64), c, np.zeros(_PAD, np.int64)]), start + _PAD, end + _PAD, text)


def pieces(text: str) -> list[bytes]:
    """The windows of a text as class strings."""
    own = layout([text])
    flat = own.c.astype(np.uint8).tobytes()
    return [flat[i:j] for i, j in zip(*(x.tolist() for x in own.windows()[:2]))]


def piece(s: str) -> bytes:
    """A string as one window (for landmarks and tests)."""
    own = layout([s])
    return own.c[own.start[0]:own.end[-1]].astype(np.uint8).tobytes()[:WIDTH]


def _cut(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Windows as rows of classes, led and ended by classes of their own: where a
    subsequence lies at a window's edge it counts as another one than inside."""
    n = end - start
    cols = np.arange(WIDTH)
    m = np.zeros((len(start), WIDTH + 2), np.int64)
    m[:, 1:-1] = np.where(cols < n[:, None], c[np.minimum(start[:, None] + cols, len(c) - 1)], 0)
    m[:, 0] = _START
    m[np.arange(len(n)), n + 1] = _END
    return m


def _matrix(windows: list[bytes]) -> np.ndarray:
    end = np.cumsum([len(w) for w in windows])
    return _cut(np.frombuffer(b"".join(windows) + b"\0", np.uint8).astype(np.int64), end - [len(w) for w in windows], end)


def _triples(m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(row, triple number, weight) for every gap pattern over a matrix of classes."""
    for a, b in _GAPS:
        n = m.shape[1] - a - b
        x, y, z = m[:, :n], m[:, a:a + n], m[:, a + b:]
        row, col = np.nonzero((x > 0) & (y > 0) & (z > 0))
        yield row, (x[row, col] * _CLASSES + y[row, col]) * _CLASSES + z[row, col], DECAY ** (a + b + 1)


def features(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse kernel features (row, triple, value) of a matrix of windows, scaled by the root of the sum of
    squared weights of all occurrences (a row without repeated triples has length one)."""
    rows, keys, vals = [], [], []
    for r, t, w in _triples(m):
        rows.append(r)
        keys.append(t)
        vals.append(np.full(len(r), w))
    r, t, v = np.concatenate(rows), np.concatenate(keys), np.concatenate(vals)
    norm = np.sqrt(np.bincount(r, v * v, minlength=len(m)))
    u, back = np.unique(r * _CLASSES ** 3 + t, return_inverse=True)
    r, t = u // _CLASSES ** 3, u % _CLASSES ** 3
    return r, t, np.bincount(back, v) / np.maximum(norm[r], 1e-12)


class _Against:
    """Kernel values of a fixed list of windows against others, one by one."""

    def __init__(self, windows: list[bytes]):
        self.n = len(windows)
        # chunk by chunk: the sort behind the features needs many times their room
        got = [(lo, *features(_matrix(windows[lo:lo + 1024]))) for lo in range(0, self.n, 1024)]
        self.r = np.concatenate([r.astype(np.int32) + lo for lo, r, _, _ in got] or [np.zeros(0, np.int32)])
        self.t = np.concatenate([t.astype(np.int32) for _, _, t, _ in got] or [np.zeros(0, np.int32)])
        self.v = np.concatenate([v for *_, v in got] or [np.zeros(0)])
        self.cut = np.searchsorted(self.r, np.arange(self.n + 1))
        self.dense = np.zeros(_CLASSES ** 3)

    def column(self, t: np.ndarray, v: np.ndarray) -> np.ndarray:
        self.dense[t] = v
        out = np.bincount(self.r, self.v * self.dense[self.t], minlength=self.n)
        self.dense[t] = 0
        return out

    def own(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.cut[i], self.cut[i + 1])
        return self.t[s], self.v[s]


def kernel(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Scaled gap-weighted subsequence kernel matrix between two lists of windows."""
    left, right = _Against(a), _Against(b)
    return np.stack([left.column(*right.own(j)) for j in range(len(b))], axis=1) if b else np.zeros((len(a), 0))


def _edges(c: np.ndarray, at: np.ndarray, ends: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """Per gap pattern the two other characters of the triple that a window starting (or ending) at ``at`` has
    with its edge, the triple's number, and its weight."""
    for a, b in _GAPS:
        x, y = (c[at - a - b], c[at - b]) if ends else (c[at - 1 + a], c[at - 1 + a + b])
        yield x, y, (x * _CLASSES + y) * _CLASSES + _END if ends else (_START * _CLASSES + x) * _CLASSES + y, DECAY ** (a + b + 1)


def _ends(c: np.ndarray, start: np.ndarray, end: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Terms x, y, x2, y2: x[i] + y[j] is the sum of ``weight`` times DECAY over all triples of the window from
    start i to end j, x2[i] + y2[j] that of the squared DECAY, for windows of _SHORT or more: triples that
    start inside it, less those that reach over its end, plus those with its edges."""
    out = []
    for at, ends in ((start, False), (end, True)):
        w, n2 = np.zeros(len(at)), np.zeros(len(at))
        for x, y, key, d in _edges(c, at, ends):
            w += weight[key] * d
            n2 += ((x > 0) & (y > 0)) * d * d
        out += [w, n2]
    x, x2, y, y2 = out
    n, full = len(c), c > 0
    c = c.astype(np.int32)
    pair = {a: (c[:-a] * _CLASSES + c[a:]) * _CLASSES for a in range(1, SPAN - 1)}
    both = {a: full[:-a] & full[a:] for a in range(1, SPAN - 1)}
    run, have = np.zeros(n), np.zeros(n)
    for s in range(2, SPAN):
        m = n - s
        g, k = np.zeros(m), np.zeros(m, np.int8)
        for a in range(1, s):
            g += weight.take(pair[a][:m] + c[s:])
            k += both[a][:m] & full[s:]
        np.cumsum(g * DECAY ** (s + 1), out=run[1:m + 1])  # of triples that start before each place
        np.cumsum(k * DECAY ** (2 * s + 2), out=have[1:m + 1])
        x -= run[start]
        y += run[end - s]
        x2 -= have[start]
        y2 += have[end - s]
    return x, y, x2, y2


@dataclass
class Model:
    """Weights of triples (the landmark expansion folded), bias and Platt scaling; fixed size."""

    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def exact(self, m: np.ndarray) -> np.ndarray:
        """SVM margins of a matrix of windows."""
        out = np.full(len(m), self.bias)
        for lo in range(0, len(m), 2048):
            part = m[lo:lo + 2048]
            r, t, v = features(part)
            out[lo:lo + 2048] += np.bincount(r, v * self.weight[t], minlength=len(part))
        return out

    def margins(self, windows: list[bytes]) -> np.ndarray:
        return self.exact(_matrix(windows)) if windows else np.zeros(0)

    def top_windows(self, texts: list[str], most: int) -> list[tuple[bytes, float]]:
        """The ``most`` different windows of largest margin of each text, with their margins."""
        own = layout(texts)
        if not len(own.start):
            return []
        start, end, text = own.windows()
        i, ib = np.unique(start, return_inverse=True)
        j, jb = np.unique(end, return_inverse=True)
        x, y, x2, y2 = _ends(own.c, i, j, self.weight)
        got = self.bias + (x[ib] + y[jb]) / np.sqrt(np.maximum(x2[ib] + y2[jb], 1e-9))
        few = np.flatnonzero(end - start < _SHORT)
        h = _hashes(own.c, start, end)
        _, first, back = np.unique(h[few], return_index=True, return_inverse=True)
        if len(first):
            got[few] = self.exact(_cut(own.c, start[few[first]], end[few[first]]))[back]
        order = np.lexsort((h, text))
        order = order[np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])])]
        order = order[np.lexsort((-got[order], text[order]))]
        led = np.concatenate([[0], np.flatnonzero(text[order][1:] != text[order][:-1]) + 1])
        order = order[np.arange(len(order)) - np.repeat(led, np.diff(np.append(led, len(order)))) < most]
        flat = own.c.astype(np.uint8).tobytes()
        return [(flat[start[k]:end[k]], float(got[k])) for k in order]

    def text_margins(self, texts: list[str]) -> np.ndarray:
        """The largest margin over each text's windows; the bias less one for texts without any."""
        out = np.full(len(texts), self.bias - 1.0)
        own = layout(texts)
        n = len(own.start)
        if not n:
            return out
        long = own.parts()
        x, y, x2, y2 = _ends(own.c, np.concatenate([own.start, long[0]]), np.concatenate([own.end, long[1]]), self.weight)
        margin = lambda i, j: self.bias + (x[i] + y[j]) / np.sqrt(np.maximum(x2[i] + y2[j], 1e-9))
        best, few = np.full(n, -np.inf), []  # of the windows that start at each word
        for more in range(min(WORDS, n)):
            i, j = slice(0, n - more), slice(more, n)
            size = own.end[j] - own.start[i]
            fits = (size <= WIDTH) & (own.text[i] == own.text[j])
            np.maximum(best[i], np.where(fits & (size >= _SHORT), margin(i, j), -np.inf), out=best[i])
            k = np.flatnonzero(fits & (size < _SHORT))
            few.append((k, own.start[k], size[k]))
        if len(long[0]):
            np.maximum.at(best, long[2], margin(slice(n, None), slice(n, None)))
        # short windows repeat often: each distinct one once
        word, at, size = (np.concatenate(v) for v in zip(*few))
        col = np.arange(_SHORT - 1)
        key = np.where(col < size[:, None], own.c[at[:, None] + col], 0) @ (np.int64(_CLASSES) ** col) * _SHORT + size
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        if len(first):
            np.maximum.at(best, word, self.exact(_cut(own.c, at[first], at[first] + size[first])[:, :_SHORT + 1])[back])
        led = np.concatenate([[0], np.flatnonzero(own.text[1:] != own.text[:-1]) + 1])
        out[own.text[led]] = np.maximum.reduceat(best, led)
        return out


def _disguised(s: bytes, rng: np.random.Generator) -> list[bytes]:
    """The ways an insult is written around a filter: signs, blanks or letters put in, letters doubled."""
    at = int(rng.integers(1, max(2, len(s))))
    sign = b"\0" if rng.integers(5) else bytes([24])  # a sign or blank; the letter x
    return [x[:WIDTH] for x in (sign.join(s[i:i + 1] for i in range(len(s))), s[:at] + sign + s[at:], s[:at] + s[at - 1:at] + s[at:])]


def fit(toxic: list[bytes], clean: list[bytes], mine: Callable[[Model], list[bytes]] | None = None, landmarks: int = LANDMARKS,
        seed: int = 5) -> Model:
    """Linear SVM on Nystroem features of the windows (dual coordinate descent, classes
    weighted evenly), with further rounds on what ``mine`` finds hardest under the model
    so far. Without windows of both classes nothing is toxic."""
    rng = np.random.default_rng(seed)
    if not toxic or not clean:
        return Model(np.zeros(_CLASSES ** 3), -1.0)
    known, hard = set(toxic), []
    more = [d for s in toxic for d in _disguised(s, rng)]
    model = None
    for left in reversed(range(ROUNDS if mine else 1)):
        x = [*toxic, *more, *clean]
        y = np.concatenate([np.ones(len(toxic) + len(more)), -np.ones(len(clean))])
        half = landmarks // 2
        marks = list(dict.fromkeys([*(toxic[i] for i in _spread(toxic, half)), *hard[:half // 2],
                                    *(clean[i] for i in _spread(clean, half - len(hard[:half // 2])))]))
        model = _trained(x, y, marks, rng)
        if left:
            hard = [w for w in mine(model) if w not in known]
            clean = list(dict.fromkeys([*clean, *hard]))
    return model


def nystroem(x: list[bytes], marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Whitened kernel values of ``x`` against the landmarks, and the whitening."""
    val, vec = np.linalg.eigh(kernel(marks, marks))
    keep = val > 1e-6 * val.max()
    white = vec[:, keep] / np.sqrt(val[keep])
    return kernel(x, marks) @ white, white


def _trained(x: list[bytes], y: np.ndarray, marks: list[bytes], rng: np.random.Generator) -> Model:
    f, white = nystroem(x, marks)
    w, bias = _svm(f, y, rng)
    r, t, v = features(_matrix(marks))
    return Model(np.bincount(t, v * (white @ w)[r], minlength=_CLASSES ** 3), bias)


def witnesses(held: dict[bytes, list[bytes]], least: int = MIN_TOXIC) -> list[bytes]:
    """Greedy cover: windows by how many texts hold them that no chosen piece explains yet;
    then pieces held by texts that at least DIVERSE different pieces of the cover explain
    (copies of one text are all explained by one)."""
    texts: dict[bytes, set[bytes]] = {}
    for t, own in held.items():
        for p in own:
            texts.setdefault(p, set()).add(t)
    heap = [(-len(v), p) for p, v in texts.items()]
    heapq.heapify(heap)
    open_, out = set(held), []
    by: dict[bytes, bytes] = {}
    while heap:
        n, p = heapq.heappop(heap)
        gain = len(texts[p] & open_)
        if gain < least:
            continue
        if gain < -n:
            heapq.heappush(heap, (-gain, p))
            continue
        out.append(p)
        by.update(dict.fromkeys(texts[p] & open_, p))
        open_ -= texts[p]
    rest = sorted((p for p in texts if p not in set(out)), key=lambda p: (-len(texts[p]), p))
    out += [p for p in rest if len({by[t] for t in texts[p] if t in by}) >= DIVERSE]
    return out


def _spread(strings: list[bytes], n: int) -> list[int]:
    """Landmarks by farthest-first choice under the kernel, from the most frequent on."""
    if len(strings) <= n:
        return list(range(len(strings)))
    k = _Against(strings)
    picked, best = [0], k.column(*k.own(0))
    while len(picked) < n:
        i = int(best.argmin())
        picked.append(i)
        best = np.maximum(best, k.column(*k.own(i)))
    return picked


def _svm(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, c: float = 4.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    share = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    cap, a, w = c * share, np.zeros(len(y)), np.zeros(x1.shape[1])
    q = (x1 ** 2).sum(1)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            g = y[i] * (x1[i] @ w) - 1
            new = min(max(a[i] - g / q[i], 0.0), cap[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x1[i]
                a[i] = new
    return w[:-1], float(w[-1])


def _hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit numbers of windows: equal class strings have equal ones."""
    def powers(base: int) -> np.ndarray:
        out = np.full(len(c) + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    base = int(_MIX)  # odd, so it has an inverse, which shifts each window to place 0
    run = np.concatenate([[np.uint64(0)], np.cumsum((c.astype(np.uint64) + np.uint64(7)) * powers(base)[:-1], dtype=np.uint64)])
    h = (run[end] - run[start]) * powers(pow(base, -1, 1 << 64))[start]
    h ^= h >> np.uint64(29)
    return (h * _MIX).view(np.int64)


def _counted(rows: DataFrame, pick, schema: str) -> DataFrame:
    """``pick(layout, start, end, text number, hash)`` over each text's distinct windows -> columns of ``schema``."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches, limit=4 * PART_BYTES):
            own = layout(b.column(b.num_columns - 1).to_pylist())
            if not len(own.start):
                continue
            start, end, text = own.windows()
            h = _hashes(own.c, start, end)
            order = np.lexsort((h, text))
            once = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])])
            at = order[once]
            for columns in pick(b, own, start[at], end[at], text[at], h[at]):
                yield pa.RecordBatch.from_arrays(columns, names)
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def _bytes(own: Layout, start: np.ndarray, end: np.ndarray) -> pa.Array:
    flat = own.c.astype(np.uint8).tobytes()
    return pa.array([flat[i:j] for i, j in zip(start.tolist(), end.tolist())], pa.binary())


def marks(hashes: DataFrame) -> np.ndarray:
    """A bit for the lowest _MARKS bits of every ``h``: of fixed size, with some hits by chance, which a join on
    ``h`` removes."""
    low = F.pmod("h", F.lit(1 << _MARKS))
    words = (hashes.select(F.shiftright(low, 5).cast("int").alias("i"), F.expr("shiftleft(1L, cast(pmod(h, 32) as int))").alias("b"))
             .groupBy("i").agg(F.bit_or("b").alias("b"))).toPandas()
    out = np.zeros(1 << _MARKS - 5, np.uint32)
    out[words["i"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return out


def _marked(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = h & ((1 << _MARKS) - 1)
    return (table[low >> 5] >> (low & 31).astype(np.uint32) & 1).astype(bool)


def toxic_counts(toxic: DataFrame) -> DataFrame:
    """``h, t``: toxic texts that hold each window."""
    def pick(b, own, start, end, text, h):
        u, n = np.unique(h, return_counts=True)
        yield [pa.array(u), pa.array(n)]
    return _counted(toxic.select("text"), pick, "h long, n long").groupBy("h").agg(F.sum("n").alias("t"))


def clean_counts(clean: DataFrame, asked, share: float) -> DataFrame:
    """``h, piece, n``: clean texts that hold each window; of all windows those whose hash is marked (without
    ``piece``), and with ``piece`` single words and, by hash, a ``share`` of all windows."""
    def pick(b, own, start, end, text, h):
        u, first, n = np.unique(h, return_index=True, return_counts=True)
        hit = _marked(asked.value, u)
        yield [pa.array(u[hit]), pa.nulls(int(hit.sum()), pa.binary()), pa.array(n[hit])]
        i, j = start[first], end[first]
        blank = np.cumsum(np.concatenate([[0], own.c == 0]))
        named = (blank[j] == blank[i]) | ((u.view(np.uint64) >> np.uint64(33)) < np.uint64(share * 2 ** 31))
        yield [pa.array(u[named]), _bytes(own, i[named], j[named]), pa.array(n[named])]
    got = _counted(clean.select("text"), pick, "h long, piece binary, n long")
    return got.groupBy("h", "piece").agg(F.sum("n").alias("n"))


def telling_windows(texts: DataFrame, telling: DataFrame) -> DataFrame:
    """``tid, piece``: each text's windows among ``telling(h)`` that MIN_TOXIC texts hold. Of windows that the same
    texts hold (those of copies, or what always stands around an insult) the shortest stands for all."""
    table = texts.sparkSession.sparkContext.broadcast(marks(telling))

    def pick(b, own, start, end, text, h):
        hit = _marked(table.value, h)
        yield [b.column(0).take(pa.array(text[hit])), pa.array(h[hit]), _bytes(own, start[hit], end[hit])]

    held = staged(_counted(texts.select("tid", "text"), pick, "tid binary, h long, piece binary").join(telling.select("h"), "h", "left_semi"), "held")
    sets = held.groupBy("piece").agg(F.bit_xor(F.xxhash64("tid")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "tid")).alias("y"), F.count("*").alias("n"))
    first = (sets.filter(F.col("n") >= MIN_TOXIC).groupBy("x", "y", "n")
             .agg(F.min(F.struct(F.length("piece").alias("l"), F.col("piece"))).alias("p")).select("p.piece"))
    return held.join(first, "piece", "left_semi").select("tid", "piece")


def hardest(clean: DataFrame, model: Model) -> list[bytes]:
    """The HARD_PIECES windows of clean texts with the largest margins: of each text's three best, so that
    what fools the model anywhere is found, not only what is frequent."""
    shared = clean.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches, limit=PART_BYTES):
            top = shared.value.top_windows(b.column(0).to_pylist(), 3)
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([m for _, m in top], pa.float64())], ["piece", "m"])

    found = clean.select("text").mapInArrow(run, "piece binary, m double").groupBy("piece").agg(F.max("m").alias("m"))
    got = found.orderBy(F.desc("m"), "piece").limit(HARD_PIECES).select("piece").toPandas()["piece"]
    shared.unpersist()
    return [bytes(w) for w in got]


def train(labelled: DataFrame) -> Model:
    """Fit on ``text, toxic`` rows (about LABELLED_ROWS at most, see ``scored``): document counts of windows over all of
    them, witnesses of the toxic ones, the SVM, and Platt scaling on about PLATT_TEXTS texts (by hash)."""
    sc = labelled.sparkSession.sparkContext
    lab = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    total = {r[0]: (r[1], r[2] or 0) for r in lab.groupBy("toxic").agg(F.count("*"), F.sum(F.length("text"))).collect()}
    if not total.get(1) or not total.get(0):
        return Model(np.zeros(_CLASSES ** 3), -1.0)
    nt, nc, letters = total[1][0], total[0][0], total[0][1]
    toxic = staged(toxic_counts(lab.filter("toxic = 1")).filter(F.col("t") >= MIN_TOXIC), "toxic-windows")
    asked = sc.broadcast(marks(toxic))
    share = min(1.0, CLEAN_POOL / max(1.0, letters * WORDS / 6))  # about WORDS windows for each six letters
    clean = staged(clean_counts(lab.filter("toxic = 0"), asked, share), "clean-windows")
    odds = (F.col("t") / nt) / ((F.coalesce("n", F.lit(0)) + 0.5) / nc)
    both = toxic.join(clean.filter("piece is null").select("h", "n"), "h", "left").withColumn("odds", odds)
    # how surprising a window's counts are if labels fell by chance; of as many windows as there are some surprise by log(windows)
    share, held_by = nt / (nt + nc), F.col("t") + F.coalesce("n", F.lit(0))
    clean_part = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") / held_by / (1 - share))).otherwise(0.0)
    both = staged(both.withColumn("surprise", F.col("t") * F.log(F.col("t") / held_by / share) + clean_part), "window-odds")
    tells = (F.col("odds") >= MIN_ODDS) & (F.col("surprise") >= float(np.log(max(2, toxic.count()))))
    few = hash_sample(lab.filter("toxic = 1"), TOXIC_TEXTS, nt, "text").select(text_id().alias("tid"), "text").dropDuplicates(["tid"])
    held: dict[bytes, list[bytes]] = {}
    for r in sorted(telling_windows(few, both.filter(tells)).collect(), key=lambda r: (bytes(r[0]), bytes(r[1]))):
        held.setdefault(bytes(r[0]), []).append(bytes(r[1]))
    found = witnesses(held)
    common = clean.filter("piece is not null").join(both.filter("odds >= 2").select("h"), "h", "left_anti")
    often = [bytes(r[0]) for r in common.orderBy(F.desc("n"), "piece").limit(CLEAN_PIECES // 2).select("piece").collect()]
    # a filter, not an ordered limit: that would send every task's best rows to the driver
    some = hash_sample(common, CLEAN_PIECES // 2, common.count(), "piece").select("piece").toPandas()["piece"]
    texts = staged(hash_sample(lab.filter("toxic = 0"), CLEAN_TEXTS, nc, "text").select("text"), "clean-texts")
    model = fit(found, list(dict.fromkeys([*often, *sorted(map(bytes, some))])), lambda m: hardest(texts, m))
    got = margins(hash_sample(lab, PLATT_TEXTS, nt + nc, "text"), model, ["toxic"]).select("toxic", "margin").toPandas()
    model.slope, model.shift = _platt(got["margin"].to_numpy(), got["toxic"].to_numpy())
    return model


def _platt(m: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Logistic fit of label on margin with smoothed targets (Newton steps)."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    share = np.full(len(m), 1 / len(m))
    x = np.stack([m, np.ones(len(m))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (p - target)) + 1e-4 * w
        h = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def margins(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``margin``: that of the most toxic window of the whole text
    (texts without a letter or digit get the lowest margin, the bias less one)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (docs.schema[c] for c in keep)) + ", margin double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches, limit=PART_BYTES):
            out = shared.value.text_margins(b.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(out)], [*keep, "margin"])

    return docs.select(*keep, "text").mapInArrow(run, ddl)


def scored(docs: DataFrame, labels: DataFrame, training: Column, keep: list[str] | None = None) -> DataFrame:
    """Per row: ``doc_id`` (or the ``keep`` columns), ``held_out, score, predicted``.

    ``training``, an expression of doc_id, marks ids whose labels (``labels.toxic``, 0 or 1;
    others and nulls are ignored, of repeated labels the largest holds) may be learnt from, about
    LABELLED_ROWS of them at most, by hash. Null text
    is empty; texts without words get the lowest score. Rows stay one for one.
    """
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & F.coalesce(training, F.lit(False)))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    lab = hash_sample(lab, LABELLED_ROWS, lab.count(), "doc_id")
    base = docs.withColumn("__held", ~F.coalesce(training, F.lit(False)))
    own = base.filter(~F.col("__held")).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(own.join(F.broadcast(lab), "doc_id"))
    keep = keep or ["doc_id"]
    got = margins(base.withColumn("text", F.coalesce("text", F.lit(""))), model, [*keep, "__held"])
    score = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.shift)))
    return (got.withColumn("score", score)
            .select(*keep, F.col("__held").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
