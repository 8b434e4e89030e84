"""Toxicity: a support vector machine on sentences, with a subsequence string kernel.

Method: texts fall into sentences. Two strings are alike by the subsequences of three
letters that they share, each weighed by decay ** span on both sides, so gaps cost but
don't hide a match. Signs inside a word take up room and match nothing, look-alike
digits and accented letters count as their letters, the gap between two words is a
letter of its own, and runs of single letters are one word. A sentence enters the kernel
by its runs of one or two words (stretches of a longer word): its value is that of its
worst run, a document's that of its worst sentence. Words that are toxic only side by
side are thus seen, and a long sentence doesn't dilute them.

The machine works on the Nystroem features of a bounded set of landmarks, which are
runs of labelled sentences. As all landmarks enter linearly, they fold into one table
over letter triples, and a run's value is a sum over its own triples divided by its
norm: the same value as through the landmarks, at a cost that doesn't depend on their
number. The norm is that of a run no triple of which occurs twice.

Training: labels are those of documents, instances their sentences. All sentences of
clean documents are negative; of a toxic one the worst sentence is positive, chosen anew
after each fit, weighed by how far its run is beyond chance. Positive runs also enter
with inserted characters. Every bound on training is a parameter of `Bounds`.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, lean

DECAY = 0.5
SPAN = 8
WIDTH, STRIDE = 24, 8
WORDS = 2
BLOCK, MOST, OVERLAP = 1 << 20, 1 << 23, 256
LETTERS = 34
BETWEEN, GAP = 31, 33

#: Signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


@dataclass(frozen=True)
class Bounds:
    """What the machine is trained on, at most: labelled documents, half of each class and none longer than doc_chars, chars of them in all; distinct positive runs, variants of the commonest, negative runs drawn at first and hard ones added a round; landmarks."""

    docs: int = 3_000
    doc_chars: int = 20_000
    chars: int = 6_000_000
    positive: int = 600
    variants: int = 100
    negative: int = 5_000
    hard: int = 2_000
    landmarks: int = 256
    rounds: int = 4


def _letter(c: str) -> int:
    c = unicodedata.normalize("NFKD", LOOKALIKES.get(c, c))[:1].lower()[:1]
    if "a" <= c <= "z":
        return ord(c) - ord("a")
    return 26 + ord(c) % 5 if c.isalnum() else GAP


_LOW = np.array([_letter(chr(i)) for i in range(0x250)], dtype=np.uint8)
_WHITE = np.array([chr(i).isspace() for i in range(0x250)])
_STOPS = np.array([ord(c) for c in ".!?"], dtype=np.uint32)


def spelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all texts, and the number of the text of each code. A run of other characters is one code, BETWEEN words or GAP inside one; after a sentence and a text come SPAN of GAP."""
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), dtype=np.uint32)
    low = np.minimum(points, 0x24F)
    codes, white = _LOW[low], _WHITE[low]
    high = np.flatnonzero(points >= 0x250)
    if len(high):
        kinds, which = np.unique(points[high], return_inverse=True)
        codes[high] = np.array([_letter(chr(p)) for p in kinds], dtype=np.uint8)[which]
        white[high] = np.array([chr(p).isspace() for p in kinds])[which]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    sort = white.astype(np.uint8)  # 0 inside a word, 1 between words, 2 between sentences
    stop = np.isin(points[:-1], _STOPS) & white[1:]
    sort[:-1][stop] = 2
    sort[ends] = 2
    letter = codes != GAP
    starts = np.flatnonzero(~letter & np.concatenate(([True], letter[:-1])))
    sort = np.maximum.reduceat(np.where(letter, 0, sort), starts)
    codes[starts] = np.where(sort == 0, GAP, BETWEEN)
    copies = letter.astype(np.int64)
    copies[starts] = np.where(sort == 2, SPAN + 1, 1)
    at = np.cumsum(copies) - copies
    out = np.repeat(codes, copies)
    cut = starts[sort == 2]
    out[(at[cut][:, None] + np.arange(1, SPAN + 1)).ravel()] = GAP
    owner = np.repeat(np.searchsorted(ends, np.arange(len(points))), copies)
    # Each sentence also begins between words; the first code has no place before it.
    out[at[cut] + SPAN] = BETWEEN
    owner[at[cut] + SPAN] = np.minimum(owner[at[cut] + SPAN] + np.isin(cut + 1, ends + 1), len(texts) - 1)
    out, owner = np.concatenate(([BETWEEN], out)).astype(np.uint8), np.concatenate(([0], owner))
    # Single letters: what stands between three or more of them is inside a word.
    gap = np.flatnonzero(out == BETWEEN)
    if len(gap) > 3:
        single = (np.diff(gap) == 2) & (out[gap[:-1] + 1] < 26)
        run = np.concatenate(([False], single, [False]))
        inner = run[:-1] & run[1:]
        beside = np.concatenate(([False], inner[:-1])) | np.concatenate((inner[1:], [False]))
        out[gap[inner & beside]] = GAP
    return out, owner


def runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of 1 to WORDS words, with what stands before and after them. Of a run longer than WIDTH, overlapping stretches that cover all of a word, or with several words all about the first gap between them. No run leaves its sentence."""
    gap = np.flatnonzero(codes == BETWEEN)
    first, last = [], []
    for n in range(1, WORDS + 1):
        a, b = gap[:-n], gap[n:] + 1
        inside = codes[a + 1] != GAP  # not the end of a sentence
        for i in range(1, n):
            inside &= codes[np.minimum(gap[i : len(gap) - n + i] + 1, len(codes) - 1)] != GAP
        a, b = a[inside & (b - a >= 3)], b[inside & (b - a >= 3)]
        pieces = np.maximum(1, -(-(b - a - WIDTH) // STRIDE) + 1)
        place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        middle = np.repeat(gap[1 : len(gap) - n + 1][inside & (gap[n:] + 1 - gap[:-n] >= 3)], pieces) if n > 1 else None
        a, b = np.repeat(a, pieces), np.repeat(b, pieces)
        a = np.where(b - a > WIDTH, np.minimum(a + STRIDE * place, b - WIDTH), a)
        b = np.minimum(a + WIDTH, b)
        if n > 1:  # stretches of one word alone are there already
            both = (a + 1 < middle) & (middle < b - 2)
            a, b = a[both], b[both]
        first.append(a)
        last.append(b)
    return np.concatenate(first), np.concatenate(last)


_PLAIN = np.sqrt([max(1e-9, sum((n - k) * (k - 1) * DECAY ** (2 * (k + 1)) for k in range(2, min(SPAN, n)))) for n in range(WIDTH + 1)])


def norms(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The norm of each run, as if no triple occurred twice in it. Only runs with a GAP need a look at their codes."""
    out = _PLAIN[last - first]
    gaps = np.concatenate(([0], np.cumsum(codes == GAP)))
    some = np.flatnonzero(gaps[last] > gaps[first])
    for at in range(0, len(some), 50_000):
        i = some[at : at + 50_000]
        place = first[i][:, None] + np.arange(WIDTH + SPAN)
        real = (place < last[i][:, None]) & (codes[np.minimum(place, len(codes) - 1)] != GAP)
        total = np.zeros(len(i))
        for k in range(2, SPAN):
            ends = real[:, :WIDTH] & real[:, k : k + WIDTH]
            for j in range(1, k):
                total += DECAY ** (2 * (k + 1)) * (ends & real[:, j : j + WIDTH]).sum(axis=1)
        out[i] = np.sqrt(np.maximum(total, 1e-9))
    return out


@lru_cache(maxsize=64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the triples within SPAN of a run of n codes."""
    at = np.array([(i, i + j, i + k) for k in range(2, min(SPAN, n)) for j in range(1, k) for i in range(n - k)], dtype=np.int64).reshape(-1, 3)
    return at, (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32)


def _by_length(pieces: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the run, cells of its triples, their weights over the norm) in blocks of at most `most` runs of one length. A triple with a GAP weighs nothing."""
    length = np.array([len(c) for c in pieces])
    for n in np.unique(length):
        at, weight = _triples(int(n))
        which = np.flatnonzero(length == n)
        for i in range(0, len(which), most):
            c = np.stack([pieces[j] for j in which[i : i + most]])
            ends = np.arange(1, len(c) + 1) * n
            real = (c[:, at] != GAP).all(axis=2)
            x = c[:, at].astype(np.int64)
            yield which[i : i + most], (x[:, :, 0] * LETTERS + x[:, :, 1]) * LETTERS + x[:, :, 2], real * weight / norms(c.ravel(), ends - n, ends)[:, None].astype(np.float32)


def embed(pieces: list[np.ndarray]) -> np.ndarray:
    """Kernel features of a bounded list of runs: a column over all letter triples for each."""
    out = np.zeros((LETTERS**3, len(pieces)), dtype=np.float32)
    for index, cells, weight in _by_length(pieces, 256):
        np.add.at(out, (cells, index[:, None]), weight)
    return out


def kernel(pieces: list[np.ndarray], base: np.ndarray) -> np.ndarray:
    """The kernel of each run with each landmark; base is embed() of these."""
    out = np.empty((len(pieces), base.shape[1]), dtype=np.float32)
    for index, cells, weight in _by_length(pieces, 32):
        out[index] = np.matmul(weight[:, None, :], base[cells])[:, 0]
    return out


_ENDS = re.compile(r"[.!?](?=\s)")
_WORDS = re.compile(r"[^\W_]{2}\s+(?=[^\W_]{2})")


def pieces_of(text: str) -> Iterator[str]:
    """A long text in blocks with the runs of the whole: cut after a sentence, or else between two words of several letters, and the next block starts with the last word again. In a word longer than MOST blocks overlap by OVERLAP characters, which stretches of a word don't reach over."""
    at = 0
    while len(text) - at > BLOCK:
        cut = next((m.end() for m in _last(_ENDS, text, at, at + BLOCK)), None)
        if cut is not None:
            yield text[at:cut]
            at = cut
            continue
        m = _WORDS.search(text, at + BLOCK, at + BLOCK + MOST)
        if m is None:
            cut = min(at + BLOCK + MOST, len(text))
            yield text[at:cut]
            at = cut - OVERLAP if cut < len(text) else cut
            continue
        word = m.start() + 1
        while word > at and not text[word - 1].isspace():
            word -= 1
        yield text[at : m.end()]
        at = word if word > at else m.start() + 2 - OVERLAP
    if at < len(text):
        yield text[at:]


def _last(pattern: re.Pattern, text: str, low: int, high: int) -> Iterator[re.Match]:
    """The last match in the stretch, looked for from its end on."""
    size = 4_096
    while True:
        start = max(low, high - size)
        found = None
        for found in pattern.finditer(text, start, high):
            pass
        if found is not None:
            yield found
        if found is not None or start == low:
            return
        size *= 8


class Machine:
    """table: the folded landmarks; bias; slope and shift turn a document's value into a probability."""

    def __init__(self, table: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.table, self.bias, self.slope, self.shift = table.astype(np.float32), bias, slope, shift

    def run_values(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray, norm: np.ndarray | None = None) -> np.ndarray:
        """The value of each run: a sum over the triples inside it, by running sums over the text for each distance of a triple's ends."""
        c = np.concatenate([codes, np.full(SPAN, GAP, dtype=np.uint8)]).astype(np.int32)
        n = len(codes)
        heads = {j: (c[:n] * LETTERS + c[j : n + j]) * LETTERS for j in range(1, SPAN - 1)}
        total = np.zeros(len(first))
        for k in range(2, SPAN):
            here = sum(self.table.take(heads[j] + c[k : n + k]) for j in range(1, k))
            upto = np.concatenate(([0.0], np.cumsum(here, dtype=np.float64)))
            total += DECAY ** (k + 1) * np.where(last - k > first, upto[np.maximum(last - k, 0)] - upto[first], 0.0)
        return total / (norms(codes, first, last) if norm is None else norm) + self.bias

    def values(self, texts: list[str | None]) -> np.ndarray:
        """The value of the worst run of the worst sentence of each whole text; the bias where there is none. Texts go in blocks; a longer text is cut into blocks that overlap."""
        out = np.full(len(texts), self.bias, dtype=np.float64)
        seen = np.full(len(texts), -np.inf)
        block, own, size = [], [], 0

        def settle() -> None:
            codes, owner = spelled(block)
            first, last = runs(codes)
            if len(first):
                np.maximum.at(seen, np.array(own)[owner[last - 1]], self.run_values(codes, first, last))

        for i, text in enumerate(texts):
            for piece in pieces_of(text or ""):
                block.append(piece)
                own.append(i)
                size += len(piece)
                if size >= BLOCK:
                    settle()
                    block, own, size = [], [], 0
        if block:
            settle()
        return np.where(np.isfinite(seen), seen, out)

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -50, 50)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3, steps: int = 20) -> tuple[np.ndarray, float]:
    """Squared hinge by Newton steps over the rows inside the margin; y is -1 or 1."""
    z = np.hstack([x, np.ones((len(x), 1))])
    v = np.zeros(z.shape[1])
    keep = ridge * np.eye(z.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(steps):
        inside = y * (z @ v) < 1
        a = z[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ z[inside] + keep, a.T @ y[inside])
        if np.allclose(new, v, atol=1e-6):
            break
        v = new
    return v[:-1], float(v[-1])


def _variants(run: np.ndarray) -> list[np.ndarray]:
    """A run with signs or a letter set between all its letters, or one sign in the middle."""
    inner = run[1:-1]
    gap = np.full(len(inner), GAP, dtype=np.uint8)
    out = []
    for between in (gap, np.full(len(inner), ord("x") - ord("a"), dtype=np.uint8)):
        mixed = np.stack([inner, between], axis=1).ravel()[:-1]
        out.append(np.concatenate([run[:1], mixed, run[-1:]]))
    half = len(run) // 2
    out.append(np.concatenate([run[:half], gap[:1], run[half:]]))
    # Of a long one, its beginning and its end, which overlap or touch.
    return [v for w in out for v in ([w] if len(w) <= WIDTH else [w[:WIDTH], w[-WIDTH:]])]


def _platt(worst: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A sigmoid from values to probabilities, by damped steps with a weak prior."""
    a, c = 2.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * worst + c, -50, 50)))
        g = np.array([((p - y) * worst).mean() + 2e-3 * (a - 4), (p - y).mean()])
        h = p * (1 - p)
        hess = np.array([[(h * worst * worst).mean(), (h * worst).mean()], [(h * worst).mean(), h.mean()]]) + 2e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, g), -0.5, 0.5)
        a, c = a - step[0], c - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(c)


class _Instances:
    """The sentences' runs of labelled texts, in blocks: own[i] is the text of run i, kind[i] the number of its spelling, at[k] a run of kind k."""

    def __init__(self, texts: list[str]):
        self.blocks, own, mark = [], [], []
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and size < BLOCK:
                size += len(texts[end])
                end += 1
            codes, owner = spelled(texts[begin:end])
            first, last = runs(codes)
            self.blocks.append((codes, first.astype(np.int32), last.astype(np.int32), norms(codes, first, last).astype(np.float32)))
            own.append((owner[last - 1] + begin).astype(np.int32))
            m = np.zeros(len(first), dtype=np.uint64)
            for j in range(WIDTH):
                on = np.flatnonzero(last - first > j)
                m[on] = m[on] * np.uint64(0x9E3779B97F4A7C15) + codes[first[on] + j] + np.uint64(1)
            mark.append(m)
            begin = end
        self.starts = np.cumsum([0, *(len(m) for m in mark)])
        self.own = np.concatenate([np.empty(0, np.int32), *own])
        _, self.at, kind = np.unique(np.concatenate([np.empty(0, np.uint64), *mark]), return_index=True, return_inverse=True)
        self.kind = kind.astype(np.int32)

    def piece(self, k: int) -> np.ndarray:
        b = int(np.searchsorted(self.starts, self.at[k], side="right")) - 1
        codes, first, last, _ = self.blocks[b]
        i = self.at[k] - self.starts[b]
        return codes[first[i] : last[i]]

    def values(self, machine: Machine) -> np.ndarray:
        return np.concatenate([machine.run_values(*b).astype(np.float32) for b in self.blocks])


def train(docs: list[tuple[int, str]], bounds: Bounds = Bounds()) -> Machine | None:
    """docs: (label, text). None if a class is missing."""
    label = np.array([y for y, t in docs if t], dtype=np.int64)
    rows = _Instances([t for _, t in docs if t])
    own, kind = rows.own, rows.kind
    toxic = label[own] == 1
    n1, n0 = len(np.unique(own[toxic])), len(np.unique(own[~toxic]))
    if not n1 or not n0:
        return None
    pairs = np.unique(kind.astype(np.int64) * len(label) + own)
    in_toxic = np.bincount(pairs // len(label), weights=label[pairs % len(label)] == 1)
    in_clean = np.bincount(pairs // len(label), weights=label[pairs % len(label)] == 0)
    del pairs
    rate1, rate0 = in_toxic / n1, in_clean / n0
    lift = np.log(np.maximum(in_toxic, 1e-9) ** 1.5 / n1 / ((in_clean + 0.2) / n0))
    beyond = np.clip(1 - rate0 / np.maximum(rate1, 1e-9), 0, 1) + 1e-6
    rng = np.random.default_rng(0)
    clean_kinds = np.flatnonzero(in_clean)
    negative = rng.choice(clean_kinds, min(bounds.negative, len(clean_kinds)), replace=False)
    hard, tough = np.empty(0, np.int64), np.empty(0, np.int64)
    toxic_at = np.flatnonzero(toxic)

    def choose(score: np.ndarray) -> np.ndarray:
        """The kind of the worst run of the worst sentence of each toxic document."""
        worst = np.full(len(label), -1, dtype=np.int64)
        at = toxic_at[np.lexsort((kind[toxic_at], score))]
        worst[own[at]] = at
        return kind[worst[worst >= 0]]

    chosen, machine, value = choose(lift[kind[toxic_at]]), None, None
    for _ in range(bounds.rounds):
        positive, count = np.unique(chosen, return_counts=True)
        top = np.lexsort((positive, -count * beyond[positive]))[: bounds.positive]
        positive, count = positive[top], (count * beyond[positive])[top]
        negative = np.unique(negative)
        half = bounds.landmarks // 2
        others = np.concatenate([hard[: half // 2], rng.choice(negative, min(len(negative), half - min(len(hard), half // 2)), replace=False)])
        base = embed([rows.piece(k) for k in [*positive[:half], *others]])
        val, vec = np.linalg.eigh(base.T @ base + 1e-4 * np.eye(base.shape[1]))
        root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-6))) @ vec.T
        varied = [_variants(rows.piece(k)) for k in positive[: bounds.variants]]
        extra = [v for some in varied for v in some]
        weight = np.concatenate([count, *(np.full(len(some), c / len(some)) for some, c in zip(varied, count))])
        x = kernel([*(rows.piece(k) for k in positive), *extra, *(rows.piece(k) for k in negative)], base) @ root
        y = np.concatenate([np.ones(len(weight)), -np.ones(len(negative))])
        against = np.minimum(1 + np.log2(np.maximum(in_clean[negative], 1)), 6.0) * np.where(np.isin(negative, tough), 3, 1)
        v, bias = _svm(x, y, np.concatenate([weight * (against.sum() / 4 / weight.sum()), against]))
        machine = Machine(base @ (root @ v), bias)
        value = rows.values(machine)
        chosen = choose(value[toxic_at] + 0.25 * np.clip(lift[kind[toxic_at]], -3, 3))
        high = np.flatnonzero(~toxic & (value > -0.8))
        hard, at = np.unique(kind[high], return_index=True)
        hard = hard[np.lexsort((hard, -value[high[at]]))][: bounds.hard]
        negative = np.concatenate([negative, hard])
        tough = np.union1d(tough, kind[high[value[high] > 0]])
    worst = np.full(len(label), -np.inf)
    np.maximum.at(worst, own, value)
    machine.slope, machine.shift = _platt(np.where(np.isfinite(worst), worst, machine.bias), label.astype(np.float64))
    return machine


def training_docs(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> list[tuple[int, str]]:
    """(label, text) of labelled documents, none held out, within the bounds: those with the smallest hash of doc_id. Of a doc_id with several texts the least counts; labels other than 0 and 1 are left out, of several the largest counts. Labels without such a document don't count. The list of ids that is joined has the bound's size."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.where(F.length("text").between(1, bounds.doc_chars)).select("doc_id").distinct(), "doc_id", "left_semi")
    dice = F.xxhash64(F.col("doc_id").cast("string"))
    half = [known.where(f"toxic = {y}").orderBy(dice, "doc_id").limit(bounds.docs // 2) for y in (0, 1)]
    some = half[0].unionByName(half[1])
    rows = docs.select("doc_id", "text").where(F.length("text").between(1, bounds.doc_chars)).join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    left, out = [bounds.chars // 2, bounds.chars // 2], []
    for r in rows.orderBy(dice, "doc_id").select("toxic", "text").toLocalIterator():
        y = int(r["toxic"])
        if left[y] >= len(r["text"]):
            left[y] -= len(r["text"])
            out.append((y, r["text"]))
    return out


def _scores(machine: Machine | None, texts: pa.Array) -> np.ndarray:
    """Probabilities of a slice of texts."""
    if machine is None:
        return np.zeros(len(texts))
    return machine.probability(machine.values([t.as_py() for t in texts]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, bounds: Bounds = Bounds()) -> DataFrame:
    """docs(doc_id, text, ...), labels(doc_id, toxic, ...) -> doc_id, held_out, score, predicted; a row per row.

    Null, empty and blank texts have no sentence and get the score of a document without
    any toxic one. Without labelled rows of both classes every score is 0. Each row is
    scored by itself, repeated ones alike. Other columns are not read.
    """
    machine = train(training_docs(docs, labels, bounds), bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.slice(at, 500)
                score = _scores(machine, part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, bounds: Bounds = Bounds()) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns. Null, empty and blank texts stay, as do rows without doc_id whose text is clean; repeated rows go or stay together."""
    machine = train(training_docs(docs, labels, bounds), bounds)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.slice(at, 500)
                yield part.filter(pa.array(_scores(machine, part.column(text)) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)
