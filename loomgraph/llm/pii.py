"""Personal data: base patterns, and spans added by a bidirectional LSTM with CRF transitions.

Method: a character tagger, trained in numpy on the driver from labelled spans: those
that the base patterns find in a bounded sample of documents, and spans written in other
manners (an address spelt out, a number grouped in another way) set into text of the
sample. Overlapping windows cover every character of the whole text, and each is decoded
by Viterbi; the way back is only followed where the best path is not the one outside
all spans. For every character the window in which it lies deepest decides, over the
whole document, and spans are read off the merged tags and widened to whole numbers and
names. A found span must be plausible for its kind and clear of all base spans.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_sample, lean

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_PLACES = 600, 8
TRAIN_WINDOW = 64
LEAN = 2.0
WINDOW, STRIDE = 1024, 960

#: The base patterns and their limits.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
IP_RUN = re.compile(r"[0-9][0-9.]{6,}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def base_spans(text: str) -> list[Span]:
    """The contract's spans, in time linear in the text. An email is found from its at sign: the match starts where the run before it starts, or where the last match ended."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > end and text[low - 1] in LOCAL:
            low -= 1
        if low < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", low, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    # An address lies in a run of digits and points; the pattern for runs skips other text faster.
    out += [("ip", *m.span()) for r in IP_RUN.finditer(text) for m in IP.finditer(text, *r.span()) if _octets(m[0])]
    out += [("card", *m.span()) for m in CARD.finditer(text) if CARD_DIGITS[0] <= len(d := _digits(m[0])) <= CARD_DIGITS[1] and luhn(d)]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


#: Characters with a code of their own.
_OWN = "abcdefghijklmnopqrstuvwxyz0123456789@.-_+() /:,%[]{}<>\n"
_OTHER, _ALNUM = len(_OWN), len(_OWN) + 1
CODES = len(_OWN) + 2
TAGS = 1 + 2 * len(KINDS)
_CODE = np.full(0x10000, _OTHER, dtype=np.int16)
for _i in range(0x10000):
    if chr(_i).isalnum():
        _CODE[_i] = _ALNUM
for _i, _c in enumerate(_OWN):
    _CODE[ord(_c)] = _CODE[ord(_c.upper())] = _i


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(points < 0x10000, _CODE[np.minimum(points, 0xFFFF)], _OTHER).astype(np.int16)


#: Fixed values of tanh_into, as arrays, which numpy takes faster than numbers.
_HIGH, _LOW, *_QUOTIENT = (np.array(v, dtype=np.float32) for v in (5.25, -5.25, 12.04095, -195.605263, 22.94797))
_BY = (np.array(6.360039, dtype=np.float32), np.array(0.050914, dtype=np.float32))


def tanh_into(x: np.ndarray, room: np.ndarray) -> None:
    """The hyperbolic tangent of any numbers within 6e-5, in place, as a quotient of polynomials fitted on [-5.25, 5.25] and level beyond; room is two arrays of the same shape. Cells need less, see tanh_of_cells. It takes less than half the time of numpy's own where that has no vectors of 512 bits."""
    y, q = room
    np.clip(x, _LOW, _HIGH, out=x)
    np.multiply(x, x, out=y)
    np.add(y, _QUOTIENT[0], out=q)
    np.divide(_QUOTIENT[1], q, out=q)
    np.add(q, y, out=q)
    np.add(q, _QUOTIENT[2], out=q)
    np.divide(_BY[0], q, out=q)
    np.add(q, _BY[1], out=q)
    np.multiply(x, q, out=x)


#: Fixed values of tanh_of_cells.
_CELL = tuple(np.array(v, dtype=np.float32) for v in (2.523, 2.11858, 0.16024))
#: Each gate (input, output, cell) is a straight line held between two bounds: the first two have the slope of a sigmoid at 0, the last that of the tangent. The lines' slopes and heights at 0, and the bounds.
_SLOPES, _HEIGHTS, _LEAST, _MOST = (np.array(v, dtype=np.float32)[:, None, None, None] for v in ((0.25, 0.25, 1), (0.5, 0.5, 0), (0, 0, -1), (1, 1, 1)))


def tanh_of_cells(x: np.ndarray, room: np.ndarray, out: np.ndarray) -> None:
    """The hyperbolic tangent within 1e-5 where x is between -1 and 1, as cells are: means of what their gates let in."""
    np.multiply(x, x, out=room)
    np.add(room, _CELL[0], out=room)
    np.divide(_CELL[1], room, out=room)
    np.add(room, _CELL[2], out=room)
    np.multiply(x, room, out=out)


class Tagger:
    """Emissions from two LSTMs of `hidden` units, transitions of a linear-chain CRF. The gates are input, output and cell, straight lines held between bounds in place of sigmoids and a tangent; a unit forgets as much as it takes in (the forget gate is 1 less the input gate), so a cell stays between -1 and 1. Learning and scoring have the same gates. A step takes half the time of one with four gates and a tangent in each."""

    def __init__(self, hidden: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = 3 * hidden
        self.hidden = hidden
        w = {"o": rng.normal(0, 0.1, (2 * hidden, TAGS)), "ob": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS))}
        for d in "fb":  # input codes go straight to the gates, as one-hot inputs
            w |= {d + "x": rng.normal(0, 0.3, (CODES, n)), d + "h": rng.normal(0, 1 / np.sqrt(hidden), (hidden, n)), d + "b": np.zeros(n)}
        self.w = {k: v.astype(np.float32) for k, v in w.items()}
        self.bar = np.zeros((TAGS, TAGS), dtype=np.float32)  # tags that can't follow one another
        for to in range(2, TAGS, 2):
            self.bar[[i for i in range(TAGS) if i not in (to - 1, to)], to] = -1e4
            self.bar[1:, to - 1] = -1e4  # a span doesn't touch the one before

    def _gates(self, name: str) -> np.ndarray:
        """Weights of both directions as (3, 2, rows, hidden), a block for each gate."""
        return np.stack([self.w[d + name].reshape(-1, 3, self.hidden).transpose(1, 0, 2) for d in "fb"], axis=1)

    def _scaled(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of input codes with the bias, and the weights of the last outputs, both as the gates take them."""
        return (self._gates("x") + self._gates("b")) * _SLOPES + _HEIGHTS, self._gates("h") * _SLOPES

    def _steps(self, x: np.ndarray, keep: list) -> Iterator[np.ndarray]:
        """x (2, length, batch), the second from each window's end -> for each step the outputs (2, batch, hidden). Keeps the steps, to learn from them, and takes numpy's tangent."""
        table, turn = self._scaled()
        h, c = (np.zeros((2, x.shape[2], self.hidden), dtype=np.float32) for _ in range(2))
        for codes in x.transpose(1, 0, 2):
            a = np.stack([table[:, d, codes[d]] for d in (0, 1)], axis=1)
            a += np.matmul(h, turn)
            np.clip(a, _LEAST, _MOST, out=a)
            keep.append((a, c, h))
            c = c + a[0] * (a[2] - c)
            h = a[1] * np.tanh(c)
            yield h

    def _runs(self, x: np.ndarray, counts: list[int], ends: set[int], run: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """x as for _steps -> start, end, and outputs (2, end - start, windows, hidden) of at most `run` steps. counts says how many windows, the first ones, are longer than each step; it changes at `ends` only. All arrays are used again."""
        table, turn = self._scaled()
        length, size, n = len(counts), x.shape[2], self.hidden
        table = table.reshape(3, 2 * CODES, n)
        x = np.ascontiguousarray((x + np.array([0, CODES], dtype=x.dtype)[:, None, None]).transpose(1, 0, 2))
        space, room = np.empty((2, 6 * size * n), dtype=np.float32), np.empty(2 * run * size * n, dtype=np.float32)
        h, c = (np.zeros((2, size, n), dtype=np.float32) for _ in range(2))
        cuts = sorted({0, length, *ends, *range(0, length, run)})
        for low, high in zip(cuts, cuts[1:]):
            m = counts[low]
            if not m:
                return
            h, c = h[:, :m].copy(), np.ascontiguousarray(c[:, :m])
            block = room[: 2 * (high - low) * m * n].reshape(2, high - low, m, n)
            a, more = space[:, : 6 * m * n].reshape(2, 3, 2, m, n)
            rows, (i, o, g) = a.reshape(3, 2 * m, n), a
            for t in range(low, high):
                np.take(table, x[t, :, :m].ravel(), axis=1, out=rows, mode="clip")
                np.matmul(h, turn, out=more)
                np.add(a, more, out=a)
                np.clip(a, _LEAST, _MOST, out=a)
                np.subtract(g, c, out=g)
                np.multiply(g, i, out=g)
                np.add(c, g, out=c)
                h = block[:, t - low]
                tanh_of_cells(c, more[0], h)
                np.multiply(h, o, out=h)
            yield low, high, block

    def _lstm(self, x: np.ndarray, keep: list) -> np.ndarray:
        """x (length, batch) -> outputs (2, length, batch, hidden)."""
        length, size = x.shape
        out = np.empty((2, length, size, self.hidden), dtype=np.float32)
        for t, h in enumerate(self._steps(np.stack([x, x[::-1]]), keep)):
            out[0, t], out[1, length - 1 - t] = h
        return out

    def _back(self, x: np.ndarray, keep: list, grad: np.ndarray, to: dict) -> None:
        """grad: (2, length, batch, hidden), of the outputs."""
        n, (length, size) = self.hidden, x.shape
        turn = self._gates("h").transpose(0, 1, 3, 2)
        dh, dc = (np.zeros((2, size, n), dtype=np.float32) for _ in range(2))
        gates = np.empty((length, 3, 2, size, n), dtype=np.float32)
        before = np.empty((length, 2, size, n), dtype=np.float32)
        for t in range(length - 1, -1, -1):
            (i, o, g), c0, h0 = keep[t]
            squashed = np.tanh(c0 + i * (g - c0))
            h = dh + np.stack([grad[0, t], grad[1, length - 1 - t]])
            c = dc + h * o * (1 - squashed * squashed)
            z = gates[t]
            z[0], z[1], z[2] = c * (g - c0), h * squashed, c * i
            z *= _SLOPES * ((keep[t][0] > _LEAST) & (keep[t][0] < _MOST))
            before[t] = h0
            dh = np.matmul(z, turn).sum(axis=0)
            dc = c * (1 - i)
        for k, (d, codes) in enumerate((("f", x), ("b", x[::-1]))):
            z = gates[:, :, k].transpose(0, 2, 1, 3).reshape(-1, 3 * n)
            to[d + "h"] += before[:, k].reshape(-1, n).T @ z
            to[d + "b"] += z.sum(axis=0)
            to[d + "x"] += np.eye(CODES, dtype=np.float32)[codes.ravel()].T @ z

    def emissions(self, x: np.ndarray, lengths: np.ndarray | None = None, run: int = 32, out: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """(TAGS, length, batch), of windows as long as `lengths` says, in falling order; all as long as x where it is None. What lies beyond a window's end means nothing. The outputs of `run` steps at most are in memory. `out` has other weights and biases than those of the tags."""
        n, (length, size) = self.hidden, x.shape
        weights, bias = (self.w["o"], self.w["ob"]) if out is None else out
        lengths = np.full(size, length) if lengths is None else lengths
        counts = np.searchsorted(-lengths, -np.arange(length), side="left").tolist()
        kinds = [(int(k), *(int(np.searchsorted(-lengths, -k, side=side)) for side in ("left", "right"))) for k in np.unique(lengths)]
        turned = np.empty_like(x)
        for k, low, high in kinds:
            turned[:k, low:high] = x[:k, low:high][::-1]
        e = np.empty((len(bias), length, size), dtype=np.float32)
        e[:] = bias[:, None, None]
        for begin, end, h in self._runs(np.stack([x, turned]), counts, {k for k, _, _ in kinds}, run):
            took, m = h.shape[1:3]
            e[:, begin:end, :m] += (weights[:n].T @ h[0].reshape(-1, n).T).reshape(-1, took, m)
            back = (weights[n:].T @ h[1].reshape(-1, n).T).reshape(-1, took, m)[:, ::-1]
            for k, low, high in kinds:
                if k >= end:
                    e[:, k - end : k - begin, low:high] += back[:, :, low:high]
        return e

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """x, y: (length, batch) codes and tags. The mean negative log likelihood a window; sums over paths are scaled at each place."""
        keep, n = [], self.hidden
        h = self._lstm(x, keep)
        h = np.concatenate([h[0], h[1]], axis=2)
        e = (h @ self.w["o"] + self.w["ob"]).astype(np.float64)
        trans = (self.w["t"] + self.bar).astype(np.float64)
        length, size = x.shape
        top = e.max(axis=2, keepdims=True)
        p, step = np.exp(e - top), np.exp(trans)
        alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((length, size, 1))
        for t in range(length):
            a = p[t] * (alpha[t - 1] @ step) if t else p[t]
            scale[t] = a.sum(axis=1, keepdims=True)
            alpha[t] = a / scale[t]
        for t in range(length - 2, -1, -1):
            beta[t] = (p[t + 1] * beta[t + 1] / scale[t + 1]) @ step.T
        z = (np.log(scale) + top).sum(axis=(0, 2))
        rows = np.arange(size)
        path = e[np.arange(length)[:, None], rows, y].sum(axis=0) + trans[y[:-1], y[1:]].sum(axis=0)
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        de = alpha * beta
        de[np.arange(length)[:, None], rows, y] -= 1
        later = p[1:] * beta[1:] / scale[1:]
        dt = step * (alpha[:-1].reshape(-1, TAGS).T @ later.reshape(-1, TAGS))
        np.add.at(dt, (y[:-1], y[1:]), -1)
        de = (de / size).astype(np.float32)
        grad["t"] = (dt / size).astype(np.float32)
        grad["o"] = np.tensordot(h, de, axes=([0, 1], [0, 1]))
        grad["ob"] = de.sum(axis=(0, 1))
        dh = de @ self.w["o"].T
        self._back(x, keep, np.stack([dh[:, :, :n], dh[:, :, n:]]), grad)
        return float((z - path).mean()), grad

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 1000, batch: int = 64, rate: float = 0.03, seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(a) for k, a in self.w.items()}
        for t in range(1, steps + 1):
            rows = rng.integers(0, len(x), batch)
            _, grad = self.loss_and_gradient(x[rows].T, y[rows].T)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step = rate * (1 - t / (steps + 1)) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.w[k] = self.w[k] - (step * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
        return self

    def ways(self) -> np.ndarray:
        """Transitions for decoding."""
        out = self.w["t"] + self.bar
        out[0, 1::2] += LEAN
        return out

    def _forward(self, e: np.ndarray, lengths: np.ndarray, way: np.ndarray, second: np.ndarray, leave: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray]:
        """Best scores of the ways to each tag (outside, first tags, later tags) -> at each window's end as (TAGS, batch), and at every place as (length, TAGS, batch) if `keep`, else of two places only. e has the way into a span, or on in it, added."""
        k, (length, size) = len(KINDS), e.shape[1:]
        score, last = np.empty((length if keep else 2, TAGS, size), dtype=np.float32), np.empty((TAGS, size), dtype=np.float32)
        score[0, 0], score[0, 1:] = 0.0, e[:, 0] - way[:, None]
        counts = [*np.searchsorted(-lengths, -np.arange(length), side="left").tolist(), 0]
        now, ends = size, np.empty((2 * k, size), dtype=np.float32)
        for t in range(1, length + 1):
            before, new = score[(t - 1) % len(score)], score[t % len(score)]
            if counts[t] != now:
                last[:, counts[t] : now] = before[:, counts[t] : now]
                now = counts[t]
                ends = np.empty((2 * k, now), dtype=np.float32)
            if not now:
                break
            before, new, on = before[:, :now], new[:, :now], ends[:k]
            np.add(before[0], e[:k, t, :now], out=new[1 : 1 + k])
            np.add(before[1 : 1 + k], second, out=on)
            np.maximum(on, before[1 + k :], out=on)
            np.add(on, e[k:, t, :now], out=new[1 + k :])
            np.add(before[1:], leave, out=ends)
            np.maximum(on, ends[k:], out=on)
            np.maximum.reduce(on, axis=0, out=new[0])
            np.maximum(new[0], before[0], out=new[0])
        return last, score

    def decode(self, x: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """Most probable tags, the way into a span given LEAN more, as implausible spans go anyway; x and the result are (batch, length), windows as long as `lengths` says, in falling order. Scores are those above the path outside all spans, which so has 0; of ways that score alike the first counts. Scores of every place are only kept of windows where another path wins, of 256 at a time."""
        size, length = x.shape
        lengths = np.full(size, length) if lengths is None else lengths
        trans = self.ways()
        trans = trans - trans[0, 0]
        order = np.array([*range(1, TAGS, 2), *range(2, TAGS, 2)])
        first, later = order.reshape(2, -1)
        way = np.concatenate([trans[0, first], trans[later, later]])
        steps = way, (trans[first, later] - trans[later, later])[:, None], trans[order, 0][:, None]
        e = self.emissions(np.ascontiguousarray(x.T), lengths, out=(self.w["o"][:, order] - self.w["o"][:, :1], self.w["ob"][order] - self.w["ob"][0] + way))
        last, _ = self._forward(e, lengths, *steps, keep=False)
        tags = np.zeros(x.shape, dtype=np.int8)
        names, ways = np.array([0, *order]), np.ascontiguousarray(trans[[0, *order]][:, [0, *order]].T)
        won = np.flatnonzero(last.max(axis=0) > 0)
        for some in np.split(won, range(256, len(won), 256)) if len(won) else ():
            ends = lengths[some]
            _, score = self._forward(e[:, : ends[0], some], ends, *steps, keep=True)
            at, end = np.arange(len(some)), ends - 1
            now = last[:, some].argmax(axis=0)
            tags[some, end] = names[now]
            for back in range(1, int(ends[0])):
                m = int(np.searchsorted(-end, -back, side="right"))
                at, end, now = at[:m], end[:m], now[:m]
                now = (score[end - back, :, at] + ways[now]).argmax(axis=1)
                tags[some[:m], end - back] = names[now]
        return tags


_SPELT = re.compile(r"(?i)[\[({< ]at[\])}> ]")
_DOT = re.compile(r"(?i)\.|[\[({< ]dot[\])}> ]")


def plausible(kind: str, s: str) -> bool:
    digits = _digits(s)
    if kind == "email":
        return ("@" in s or bool(_SPELT.search(s))) and bool(_DOT.search(s)) and sum(c.isalnum() for c in s) >= 5
    if kind == "ip":
        parts = re.findall("[0-9]+", s)
        return len(parts) == 4 and _octets(".".join(parts)) and not any(c.isalpha() for c in s)
    if kind == "card":
        return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits) and not any(c.isalpha() for c in s)
    return PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1] and not any(c.isalpha() for c in s) and (s[0] in "+(0" or any(c not in "0123456789" for c in s))


def name_start(s: str) -> int:
    """Where the name of a found address starts: it holds no space, so words before it are not its."""
    at = min((m.start() for m in (re.search("@", s), _SPELT.search(s)) if m), default=0)
    name = s[:at].rstrip()
    return max(name.rfind(c) for c in " \n\t") + 1


def name_end(s: str) -> int:
    """Where a found address ends: with the word after its last full stop, written or spelt."""
    stop = max((m.end() for m in _DOT.finditer(s)), default=0)
    word = re.search(r"\S+", s[stop:])
    return stop + word.end() if stop and word else len(s)


def widened(text: str, kind: str, a: int, b: int) -> tuple[int, int, int]:
    """A found span on whole numbers or names, however long, without signs at its ends but for an opening parenthesis or plus; and where what it was widened to ends."""
    joined = (LOCAL if kind == "email" else "0123456789").__contains__
    while a and joined(text[a - 1]) and joined(text[a]):
        a -= 1
    while b < len(text) and joined(text[b]) and joined(text[b - 1]):
        b += 1
    reach = b
    while a < b and not (text[a].isalnum() or text[a] in "(+"):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    if kind == "phone" and a and text[a - 1] in "(+":
        a -= 1
    if kind == "email":
        a += name_start(text[a:b])
        b = a + name_end(text[a:b])
        while b > a and not text[b - 1].isalnum():
            b -= 1
    return a, b, reach


def read_off(tags: np.ndarray) -> list[Span]:
    """Spans of a tag sequence."""
    at = np.flatnonzero(tags)
    if not len(at):
        return []
    kind = (tags[at].astype(np.int64) - 1) // 2
    new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(kind) != 0) | (tags[at[1:]] % 2 == 1)))
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(at)) - 1
    return [(KINDS[k], a, b + 1) for k, a, b in zip(kind[starts].tolist(), at[starts].tolist(), at[ends].tolist())]


def merged_tags(texts: list[str], tagger: Tagger, batch: int = 1024) -> list[np.ndarray]:
    """A tag for each character of each text, from windows over all of it. Last windows are as long as the rest of their text asks, in sixteenths of a window; a text's tags don't depend on other texts. A step costs some fifty calls of numpy however many windows take it, so a batch has many."""
    step, lead = WINDOW // 16, (WINDOW - STRIDE) // 2
    rows: list[np.ndarray] = []
    spot = np.zeros((0, 3), dtype=np.int64)  # text, start, length of each window
    parts = [spot]
    for i, text in enumerate(texts):
        n = len(text)
        rows.append(np.concatenate([char_codes(text), np.full(WINDOW, _OTHER, dtype=np.int16)]))
        count = max(1, -(-(n - WINDOW) // STRIDE) + 1) if n else 0
        starts = np.arange(count) * STRIDE
        length = np.full(count, WINDOW)
        if count:
            length[-1] = min(WINDOW, max(step, -(-(n - starts[-1]) // step) * step))
        parts.append(np.stack([np.full(count, i), starts, length], axis=1))
    spot = np.concatenate(parts)
    out = [np.zeros(len(t), dtype=np.int8) for t in texts]
    begin = np.cumsum([0, *(len(r) for r in rows)])
    codes = np.concatenate([np.empty(0, np.int16), *rows])
    spot = spot[np.argsort(-spot[:, 2], kind="stable")]
    for at in range(0, len(spot), batch):
        some = spot[at : at + batch]
        tags = tagger.decode(codes[(begin[some[:, 0]] + some[:, 1])[:, None] + np.arange(some[0, 2])], some[:, 2])
        for j in np.flatnonzero(tags.any(axis=1)):
            i, start, length = some[j]
            # The middle of an overlap is where the deeper window changes.
            low = lead if start else 0
            high = min(len(out[i]) - start, length if start + WINDOW >= len(out[i]) else STRIDE + lead)
            out[i][start + low : start + high] = tags[j, low:high]
    return out


def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """What the tagger adds to the base spans of each text: clear of these and of one another."""
    out: list[list[Span]] = []
    for text, known, tags in zip(texts, base, merged_tags(texts, tagger)):
        found: list[Span] = []
        taken = sorted((a, b) for _, a, b in known)
        starts = [a for a, _ in taken]
        furthest = list(accumulate((b for _, b in taken), max))
        end, seen = 0, dict.fromkeys(KINDS, 0)
        for kind, a, b in read_off(tags):
            if a < seen[kind]:  # it would be widened to what was looked at already
                continue
            a, b, seen[kind] = widened(text, kind, a, b)
            if a >= max(b, end) or a < end or not plausible(kind, text[a:b]):
                continue
            before = bisect_left(starts, b)
            if before and furthest[before - 1] > a:
                continue
            found.append((kind, a, b))
            end = b
        out.append(found)
    return out


def _luhn_number(rng: random.Random, n: int) -> str:
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + d for d in "0123456789" if luhn(head + d))


#: Manners of writing: what stands for the at sign and for the full stop, between parts of a number, and a phone's groups of digits.
ATS = ("@", "@", " [at] ", " (at) ", " {at} ", " <at> ", " @ ", " at ", " at ", "[at]", "(at)", "{at}")
DOTS = (".", ".", ".", " dot ", " dot ", " . ", " [dot] ", " (dot) ", "[dot]", "(dot)", " {dot} ", "[.]")
CARD_SEPARATORS = ("", " ", "-", ".", "/", "  ", "_", " - ")
PHONE_SEPARATORS = (" ", "-", ".", "/", " - ", " / ")


def write_span(rng: random.Random) -> tuple[str, str]:
    """A kind and a made-up example in one of many manners, base ones among them."""
    kind = rng.choice(KINDS)
    word = lambda a, b: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(a, b)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        name = word(2, 9) + rng.choice(["", ".", "_", "-"]) + word(1, 7) + rng.choice(["", "", number(2)])
        at, dot = rng.choice(((" at ", "."), (" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "))) if rng.random() < 0.4 else (rng.choice(ATS), rng.choice(DOTS))
        host = [word(3, 10)] + [word(2, 6)] * (rng.random() < 0.2) + [rng.choice(["com", "org", "net", "de", "fr", "example", "es", "io", word(2, 3)])]
        made = name + at + dot.join(host)
        return kind, made.upper() if rng.random() < 0.15 else made
    if kind == "ip":
        return kind, rng.choice([".", ".", "[.]", " . ", "(.)"]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        d, sep = _luhn_number(rng, rng.choice([13, 15, 16, 16, 16, 19])), rng.choice(CARD_SEPARATORS)
        cuts = rng.choice([(4, 8, 12, 16), (4, 8, 12, 16), (4, 10), (5, 10, 15), (2, 4, 6, 8, 10, 12, 14, 16, 18)])
        return kind, sep.join(d[a:b] for a, b in zip((0, *cuts), (*cuts, len(d))) if a < len(d))
    sep = rng.choice(PHONE_SEPARATORS)
    groups = [number(rng.randint(2, 5)) for _ in range(rng.randint(2, 4))]
    start = rng.choice(["+" + number(rng.randint(1, 3)), "+" + number(2), "00" + number(2), "0" + number(rng.randint(2, 4)), number(3), f"({number(3)})", f"(0{number(2)})", f"+{number(2)} ({number(2)})", f"(+{number(2)}) {number(2)}"])
    made = start + (rng.choice([" ", " ", sep]) if start[-1] == ")" else sep) + sep.join(groups)
    if not PHONE_DIGITS[0] <= len(_digits(made)) <= PHONE_DIGITS[1]:
        made = "+" + number(rng.randint(10, 12)) if rng.random() < 0.3 else f"0{number(2)}{sep}{number(3)}{sep}{number(4)}"
    return kind, made


def write_other(rng: random.Random) -> str:
    """A made-up string with digits or signs that is no personal data."""
    n = lambda a, b: str(rng.randint(a, b))
    word = lambda a, b: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(a, b)))
    return rng.choice(
        [
            f"{n(1950, 2040)}-{n(1, 12):0>2}-{n(1, 31):0>2}",
            f"{n(1, 31):0>2}.{n(1, 12):0>2}.{n(1950, 2040)}",
            f"{n(1, 12)}/{n(1, 31)}/{n(1950, 2040)}",
            f"v{n(0, 9)}.{n(0, 40)}.{n(0, 40)}",
            f"{n(0, 9)}.{n(0, 40)}.{n(0, 40)}",
            f"{n(0, 23):0>2}:{n(0, 59):0>2}:{n(0, 59):0>2}",
            "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 32, 40]))),
            "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
            f"{n(1, 99999)}",
            f"{n(10000000, 99999999)}",
            f"${n(1, 999)}.{n(10, 99)}",
            f"{n(1, 999)},{n(100, 999)},{n(100, 999)}",
            f"{n(0, 9)}.{n(1000, 99999999)}",
            f"@{rng.choice(['user', 'name', 'home'])}{n(1, 99)}",
            f"{n(100000, 999999)}/{n(1, 99)}",
            f"ISBN {n(100, 999)}-{n(0, 9)}-{n(10000, 99999)}",
            f"{n(1, 40)}-{n(41, 99)}",
            f"{n(1, 9)}, {n(1, 9)}, {n(1, 9)}, {n(10, 99)}",
            f"{word(2, 6)} at {word(3, 8)} {word(2, 6)}",
            f"{word(2, 6)} at {n(1, 12)}.{n(10, 59)}",
            f"{word(2, 6)} at the {word(3, 8)}. {word(3, 8)}",
            f"{word(3, 6)}@{word(2, 6)}",
            f"({n(1, 9)}) {word(2, 6)} [{n(1, 99)}]",
            f"{word(3, 8)} dot {word(3, 8)}",
        ]
    )


def training_windows(texts: list[str], count: int = 10_000, seed: int = 11, length: int = TRAIN_WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of windows from the sample, most of them with made-up strings set in."""
    rng = random.Random(seed)
    texts = [t for t in texts if t] or ["a b c d e f g h"]
    spans = {i: base_spans(t) for i, t in enumerate(texts)}
    marked = [(i, s) for i, found in spans.items() for s in found]
    x, y = [], []
    while len(x) < count:
        if marked and rng.random() < 0.2:
            i, (_, a, b) = rng.choice(marked)
            text, found = texts[i], spans[i]
            low = max(0, rng.randint(b - length, a) if b - a < length else a - rng.randint(0, length // 2))
        else:
            text = texts[rng.randrange(len(texts))]
            at = rng.randint(0, max(0, len(text) - 2 * length))
            piece = text[at : at + 2 * length]
            found = base_spans(piece)
            if rng.random() < 0.9:
                if found:
                    continue
                cut = rng.randint(0, min(len(piece), length))
                kind, made = write_span(rng) if rng.random() < 0.65 else ("", write_other(rng))
                lead, tail = piece[:cut] + rng.choice([" ", " ", ": ", "\n"]), rng.choice([" ", " ", ". ", ", ", "\n"]) + piece[cut:]
                text = lead + made + tail
                found = [(kind, len(lead), len(lead) + len(made))] if kind else base_spans(text)
            else:
                text = piece
            low = max(0, min(rng.randint(0, length), len(text) - length // 2))
        tags = np.zeros(len(text) + length, dtype=np.int64)
        for k, a, b in sorted(found, key=lambda s: s[1] - s[2]):
            tags[a] = 1 + 2 * KINDS.index(k)
            tags[a + 1 : b] = 2 + 2 * KINDS.index(k)
        tag = tags[low : low + length].copy()
        # Overlapping spans may leave an inner tag without its start: it starts there.
        for j in range(1, length):
            if tag[j] and tag[j] % 2 == 0 and tag[j - 1] not in (tag[j], tag[j] - 1):
                tag[j] -= 1
        if ((tag[:-1] > 0) & (tag[1:] % 2 == 1)).any():  # spans that touch
            continue
        x.append(np.concatenate([char_codes(text[low : low + length]), np.full(length, _OTHER, dtype=np.int16)])[:length])
        y.append(tag)
    return np.stack(x).astype(np.int64), np.stack(y)


def fit_tagger(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, places: int = SAMPLE_PLACES) -> Tagger:
    """A tagger trained on at most sample_docs documents, those with the smallest hash of doc_id (of a repeated one the least text); of each, at most `places` base spans spread over it and its middle, as long as a few windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                text = text or ""
                found = base_spans(text)
                some = [found[i] for i in sorted({round(j * (len(found) - 1) / max(1, places - 1)) for j in range(min(places, len(found)))})]
                rows += [text[max(0, p - 2 * TRAIN_WINDOW) : p + 2 * TRAIN_WINDOW] for p in [*((a + e) // 2 for _, a, e in some), len(text) // 2]]
            yield pa.RecordBatch.from_pydict({"piece": pa.array(rows, pa.string())})

    few = id_sample(docs, "doc_id", sample_docs)
    texts = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    return Tagger().fit(*training_windows(sorted(r["piece"] for r in texts.select("text").mapInArrow(lean(run), "piece string").toLocalIterator())))


def _slices(b: pa.RecordBatch, text: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `most` bytes of text, one row at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(b.column(text)), 0), dtype=np.int64)
    group = (np.cumsum(size) - size) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(b)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield b.slice(low, high - low)


def _all_spans(texts: list[str], tagger: Tagger) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    return base, [ordered(x + y) for x, y in zip(base, added_spans(texts, base, tagger))]


def find_spans(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; a row per row.

    The counts and base_sha256 are of the base spans; spans lists these and the added
    ones. Offsets are in code points, ends exclusive. Null and empty texts have no
    spans, repeated rows the same ones. Other columns are not read.
    """
    tagger = tagger or fit_tagger(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, 1):
                base, both = _all_spans([t or "" for t in part.column(1).to_pylist()], tagger)
                out = {"doc_id": part.column(0)}
                out |= {f"n_{k}": pa.array([sum(s[0] == k for s in found) for found in base], pa.int64()) for k in KINDS}
                out["base_sha256"] = pa.array([hashlib.sha256(written(found).encode()).hexdigest() for found in base], pa.string())
                out["spans"] = pa.array([written(found) for found in both], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")


def mask(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the name of its first."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, low, high = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < high:
            high = max(high, spans[i][2])
            i += 1
        out += [text[at:low], f"[{kind.upper()}]"]
        at = high
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """docs with personal data in text masked; all columns and rows stay, null and empty texts and repeated rows too. A column n_chars is set to the new length where docs has one."""
    tagger = tagger or fit_tagger(docs)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, text):
                old = part.column(text).to_pylist()
                _, both = _all_spans([t or "" for t in old], tagger)
                new = pa.array([mask(t, spans) if spans else t for t, spans in zip(old, both)], part.column(text).type)
                yield pa.RecordBatch.from_arrays([*part.columns[:text], new, *part.columns[text + 1 :]], part.schema.names)

    out = docs.mapInArrow(lean(run), docs.schema)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))) if "n_chars" in docs.columns else out
