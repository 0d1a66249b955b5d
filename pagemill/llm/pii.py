"""Personal data: exact patterns, and a character model for forms that they miss.

The patterns give the base spans. A bidirectional LSTM over characters with CRF
transitions between tags, trained in numpy from labelled spans, adds spans of the
same kinds. It reads every character of every text in overlapping windows; where two
windows overlap, their tag scores fade into each other, and one best path over the
whole text decides, so that a span across a window's end is found whole.

The best path is exact, but sought only where it can leave "no span" at all: a run of
tags beats the path without it only if its characters' advantages add up to more than
its transitions cost, and sums over runs bound that for each character (``open_places``).

A span of the model counts if its own score, the log-odds of its path against the path
without it, reaches the cut of its kind. The cuts come from lines that training did not
see: the least at which hardly any span is wrong. What follows from no shape is checked exactly (``checked``):
a card's check digit, the range of an address's numbers.

The model is trained from generated lines (``trained``), so it is the same at every size; its weights lie beside this
module and go along with the tasks.

Defined results: a null text counts as empty and has no spans; texts of any length
are read whole (beyond ``PIECE`` characters in pieces that meet where the model is surest of
no span); rows are independent; a null doc_id stays null; other columns are
ignored, and kept as they are by ``redact``; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import os
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.base import begin, map_arrow, slices, texts

KINDS = ("email", "ip", "card", "phone")
HIDDEN = 12
#: Characters of a window, and of the overlap of two.
WIDTH, LAP = 192, 16
#: Characters whose tag scores are held at once (36 bytes each).
PIECE = 2_000_000
#: Texts whose spans a task keeps in mind.
REMEMBERED = 100_000
Span = tuple[int, int, str]
clip = np.core.umath.clip if not hasattr(np, '_core') else np._core.umath.clip

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: The look-behind spares a second try inside a run of digits that gave no match.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: About these training looks more often.
MARKS = re.compile(r"[0-9@]|\b(?:at|dot)\b|_at_", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, leftmost and non-overlapping within a kind, by start and then kind."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end(), "email"))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            d = digits_of(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                found.append((*m.span(), "card"))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def as_string(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


# The character model

TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 \n.,:;@+-()[]{}<>/\\_%='\"#*&|$!?"
CODE = {c: i + 3 for i, c in enumerate(ALPHABET)}
N_CODES = len(ALPHABET) + 3
UPPER_FLAG = N_CODES


@functools.cache
def classes() -> np.ndarray:
    """The class of each code point: 1 another letter, 2 anything else; capitals share the class of the small letter."""
    return np.array([CODE.get(c.lower(), 1 if c.isalpha() else 2) for c in map(chr, range(0x110000))], np.uint8)


def codes(text: str) -> np.ndarray:
    return classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


@dataclass
class Tagger:
    """Weights: input and recurrent matrices of both directions, output, transitions; the least score of a span, by kind."""

    wx: list[np.ndarray]
    wh: list[np.ndarray]
    b: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    trans: np.ndarray
    cuts: dict[str, float] = field(default_factory=dict)

    def parameters(self) -> list[np.ndarray]:
        return [*self.wx, *self.wh, *self.b, self.out, self.bias, self.trans]


def new_tagger(hidden: int, seed: int) -> Tagger:
    rng = np.random.default_rng(seed)
    n = len(TAGS)
    draw = lambda *shape: rng.normal(0, 0.25, shape).astype(np.float32)
    bias = lambda: np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
    return Tagger([draw(N_CODES, 4 * hidden) for _ in "ab"], [draw(hidden, 4 * hidden) for _ in "ab"], [bias(), bias()], draw(2 * hidden, n), np.zeros(n, np.float32), np.zeros((n, n), np.float32))


def squash(x: np.ndarray) -> np.ndarray:
    """The hyperbolic tangent's Pade approximant, which reaches 1 at 3 and stays: sums and products only, many times faster."""
    x = np.clip(x, -3, 3)
    return x * (27 + x * x) / (27 + 9 * x * x)


def slope(x: np.ndarray) -> np.ndarray:
    """The derivative of squash."""
    x = np.clip(x, -3, 3) ** 2
    return ((9 - x) / (3 + x) / 3) ** 2


def run_lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """x: codes (time, rows). Hidden states (time, rows, hidden), and what the backward pass needs. Gates are 1/2 + z/4 within 0 and 1."""
    t, n = x.shape
    h = wh.shape[0]
    state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
    out, kept = np.empty((t, n, h), np.float32), []
    input_ = (wx + b)[x]
    for i in range(t):
        z = state @ wh
        z += input_[i]
        g, new = np.clip(z[:, : 3 * h] * 0.25 + 0.5, 0, 1), squash(z[:, 3 * h :])
        before, previous = cell, state
        cell = g[:, h : 2 * h] * cell + g[:, :h] * new
        squashed = squash(cell)
        state = g[:, 2 * h :] * squashed
        out[i] = state
        kept.append((g, new, before, cell, squashed, previous, z))
    return out, kept


def back_lstm(x: np.ndarray, grad: np.ndarray, wx: np.ndarray, wh: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t, n, h = grad.shape
    gh = np.zeros_like(wh)
    dh = dc = np.zeros_like(grad[0])
    dz = np.empty((t, n, 4 * h), np.float32)
    for i in range(t - 1, -1, -1):
        g, new, before, cell, squashed, previous, z = kept[i]
        dh = dh + grad[i]
        dc = dc + dh * g[:, 2 * h :] * slope(cell)
        d = dz[i]
        d[:, :h], d[:, h : 2 * h], d[:, 2 * h : 3 * h] = dc * new, dc * before, dh * squashed
        d[:, : 3 * h] *= 0.25 * ((g > 0) & (g < 1))
        d[:, 3 * h :] = dc * g[:, :h] * slope(z[:, 3 * h :])
        gh += previous.T @ d
        dh, dc = d @ wh.T, dc * g[:, h : 2 * h]
    flat = dz.reshape(-1, 4 * h)
    order = np.argsort(x.ravel(), kind="stable")
    codes_, first = np.unique(x.ravel()[order], return_index=True)
    gx = np.zeros_like(wx)
    gx[codes_] = np.add.reduceat(flat[order], first, axis=0)
    return gx, gh, flat.sum(0)


def emissions(model: Tagger, x: np.ndarray):
    """Tag scores (time, rows, tags) of code windows (time, rows), for training."""
    fore, kf = run_lstm(x, model.wx[0], model.wh[0], model.b[0])
    back, kb = run_lstm(x[::-1], model.wx[1], model.wh[1], model.b[1])
    both = np.concatenate([fore, back[::-1]], 2)
    return both @ model.out + model.bias, both, kf, kb


def squash_into(x: np.ndarray, a: np.ndarray) -> None:
    """squash in place, times 9; a is room of the same shape."""
    clip(x, -3, 3, x)
    np.multiply(x, x, out=a)
    a += 3
    np.divide(24, a, out=a)
    a += 1
    x *= a


def read_windows(model: Tagger, x: np.ndarray) -> np.ndarray:
    """Tag scores (time, tags, rows) of code windows (time, rows): emissions without what training keeps. Arrays lie
    with the rows last, and constant factors are in the weights, so that a step is a few passes over memory."""
    t, n = x.shape
    h = model.wh[0].shape[0]
    quarter = np.repeat(np.array([0.25, 1], np.float32), [3 * h, h])
    middle = np.repeat(np.array([0.5, 0], np.float32), [3 * h, h])
    out = np.empty((t, len(TAGS), n), np.float32)
    z, input_ = (np.empty((4 * h, n), np.float32) for _ in range(2))
    a, more = np.empty((h, n), np.float32), np.empty((len(TAGS), n), np.float32)
    for back in (0, 1):
        wx = np.ascontiguousarray(((model.wx[back] + model.b[back]) * quarter + middle).T)
        wh = np.ascontiguousarray((model.wh[back] * quarter).T) / 9
        w_out = np.ascontiguousarray(model.out[back * h : back * h + h].T) / 9
        state, cell = np.zeros((h, n), np.float32), np.zeros((h, n), np.float32)
        g, new = z[: 3 * h], z[3 * h :]
        for i in range(t - 1, -1, -1) if back else range(t):
            np.take(wx, x[i], axis=1, out=input_, mode="clip")
            np.matmul(wh, state, out=z)
            z += input_
            clip(g, 0, 1, g)
            squash_into(new, a)
            new *= 1 / 9
            new *= g[:h]
            cell *= g[h : 2 * h]
            cell += new
            np.copyto(state, cell)
            squash_into(state, a)
            state *= g[2 * h :]
            if back:
                np.matmul(w_out, state, out=more)
                out[i] += more
            else:
                np.matmul(w_out, state, out=out[i])
    out += model.bias[:, None]
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def crf_gradient(scores: np.ndarray, trans: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of the tag paths, and its gradients by forward and backward sums."""
    t, n, k = scores.shape
    ahead = np.empty_like(scores)
    ahead[0] = scores[0]
    for i in range(1, t):
        ahead[i] = log_sum(ahead[i - 1][:, :, None] + trans, 1) + scores[i]
    behind = np.zeros_like(scores)
    for i in range(t - 2, -1, -1):
        behind[i] = log_sum(trans + (scores[i + 1] + behind[i + 1])[:, None, :], 2)
    z = log_sum(ahead[-1], 1)
    grad = np.exp(ahead + behind - z[None, :, None])
    rows = np.arange(n)
    gold = scores[np.arange(t)[:, None], rows, y].sum(0) + trans[y[:-1], y[1:]].sum(0)
    g_trans = np.zeros_like(trans)
    for i in range(t - 1):
        g_trans += np.exp(ahead[i][:, :, None] + trans + (scores[i + 1] + behind[i + 1])[:, None, :] - z[:, None, None]).sum(0)
    np.add.at(g_trans, (y[:-1].ravel(), y[1:].ravel()), -1)
    grad[np.arange(t)[:, None], rows, y] -= 1
    return float((z - gold).mean()), grad / n, g_trans / n


def tags_of(n: int, spans: list[Span]) -> np.ndarray:
    y = np.zeros(n, np.int64)
    for a, b, k in spans:
        at = 1 + 2 * KINDS.index(k)
        y[a:b] = at + 1
        y[a] = at
    return y


def train(rows: list[tuple[str, list[Span]]], width: int = 64, hidden: int = HIDDEN, epochs: int = 12, batch: int = 128, rate: float = 0.02, seed: int = 3) -> Tagger:
    """Adam on windows around the labelled spans and other marks of the rows, and anywhere. The same rows give the same model."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for text, spans in rows:
        x, y = codes(text), tags_of(len(text), spans)
        marks = [m.start() for m in MARKS.finditer(text)] + [p for a, b, _ in spans for p in (a, (a + b) // 2, b - 1)] + [int(rng.integers(len(text)))]
        starts = sorted({max(0, min(len(text) - width, p - int(rng.integers(4, width - 4)))) for p in marks})
        for s in [starts[int(i)] for i in rng.choice(len(starts), min(4, len(starts)), replace=False)]:
            w, v = x[s : s + width], y[s : s + width]
            xs.append(np.pad(w, (0, width - len(w)))), ys.append(np.pad(v, (0, width - len(v))))
    x, y = np.array(xs).T, np.array(ys).T
    model = new_tagger(hidden, seed)
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step = 0
    n_steps = epochs * -(-x.shape[1] // batch)
    for _ in range(epochs):
        order = rng.permutation(x.shape[1])
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            xb, yb = x[:, part], y[:, part]
            scores, both, kf, kb = emissions(model, xb)
            _, g, g_trans = crf_gradient(scores, model.trans, yb)
            h = hidden
            g_both = g @ model.out.T
            fx, fh, fb = back_lstm(xb, g_both[:, :, :h], model.wx[0], model.wh[0], kf)
            bx, bh, bb = back_lstm(xb[::-1], g_both[::-1, :, h:], model.wx[1], model.wh[1], kb)
            grads = [fx, bx, fh, bh, fb, bb, np.tensordot(both, g, ([0, 1], [0, 1])), g.sum((0, 1)), g_trans]
            step += 1
            lr = rate * (1 - (step - 1) / n_steps) + 1e-4
            norm = np.sqrt(sum(float((a * a).sum()) for a in grads))
            for p, a, m, v in zip(model.parameters(), grads, first, second):
                a = a * min(1.0, 5 / max(norm, 1e-9))
                m += 0.1 * (a - m)
                v += 0.005 * (a * a - v)
                p -= (lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-8)).astype(np.float32)
    return model


def viterbi(scores: np.ndarray, trans: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The best tag path of each text, from the rows of scores that are its own; a step goes on in all texts at once."""
    order = np.argsort(-lengths, kind="stable")
    start, length = starts[order], lengths[order]
    k, longest = len(trans), int(length[0])
    open_ = np.searchsorted(-length, -np.arange(longest), side="left")  # texts longer than i
    place = np.concatenate([[0], np.cumsum(open_)])
    back = np.empty((k, place[-1]), np.uint8)
    best = np.ascontiguousarray(scores[start].T)
    steps = [np.ascontiguousarray(trans[j][:, None]) for j in range(k)]
    ends = np.empty(len(order), np.int64)
    for i in range(1, longest):
        n, was = open_[i], best.shape[1]
        if n < was:
            ends[n:was] = best[:, n:].argmax(0)
            best = best[:, :n]
        top = best[0] + steps[0]
        which = back[:, place[i] : place[i] + n]
        which[:] = 0
        for j in range(1, k):
            other = best[j] + steps[j]
            np.copyto(which, j, where=other > top)
            np.maximum(top, other, out=top)
        top += scores[start[:n] + i].T
        best = top
    ends[: best.shape[1]] = best.argmax(0)
    path = np.empty(place[-1], np.uint8)
    tag = ends
    for i in range(longest - 1, -1, -1):
        n = open_[i]
        path[place[i] : place[i] + n] = tag[:n]
        if i:
            tag[:n] = back[tag[:n], np.arange(place[i], place[i] + n)]
    out: list[np.ndarray] = [np.zeros(0, np.uint8)] * len(order)
    for r, (at, n) in enumerate(zip(order.tolist(), length.tolist())):
        out[at] = path[place[:n] + r]
    return out


def spans_of(path: np.ndarray) -> list[Span]:
    tagged = np.flatnonzero(path)
    if not len(tagged):
        return []
    tags = path[tagged].astype(np.int64)
    goes_on = (np.diff(tagged) == 1) & (tags[1:] % 2 == 0) & ((tags[1:] - 1) // 2 == (tags[:-1] - 1) // 2)
    first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    last = np.append(first[1:], len(tagged)) - 1
    return [(int(tagged[f]), int(tagged[e]) + 1, KINDS[(int(tags[f]) - 1) // 2]) for f, e in zip(first, last)]


def joined_scores(model: Tagger, parts: list[np.ndarray], rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Tag scores (places, tags) of the codes of texts, one after another with some room, and where each begins. A window's
    first scores fade in as the last of the window before fade out."""
    step = WIDTH - LAP
    count = np.array([max(1, -(-(len(c) - LAP) // step)) for c in parts])
    begins = np.concatenate([[0], np.cumsum((count + 1) * step)])  # after the last window its end
    flat = np.zeros(begins[-1], np.uint8)
    for c, at in zip(parts, begins):
        flat[at : at + len(c)] = c
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place = np.repeat(begins[:-1] // step - first, count) + np.arange(count.sum())
    opens, closes = np.zeros(len(place), bool), np.zeros(len(place), bool)
    opens[first], closes[first + count - 1] = True, True
    out = np.zeros((len(flat) // step, step, len(TAGS)), np.float32)
    fade = ((1 + np.arange(LAP)) / (LAP + 1)).astype(np.float32)[:, None, None]
    tail = np.zeros((LAP, len(TAGS), 1), np.float32)
    for w in range(0, len(place), rows):
        some = place[w : w + rows]
        scores = read_windows(model, flat[some * step + np.arange(WIDTH)[:, None]])
        before = np.concatenate([tail, scores[step:, :, :-1]], 2)
        tail = scores[step:, :, -1:].copy()
        share = np.where(opens[w : w + rows], 1, fade)
        scores[:LAP] *= share
        before *= 1 - share
        scores[:LAP] += before
        out[some] = scores[:step].transpose(2, 0, 1)
        last = closes[w : w + rows]
        out[some[last] + 1, :LAP] = scores[step:, :, last].transpose(2, 0, 1)
    return out.reshape(-1, len(TAGS)), begins


def open_places(scores: np.ndarray, trans: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which places the best path of a text may tag. A run of tags changes the score of a path by the advantages of its tags
    over O and by its transitions. If no run over a place can gain by that, at most, then the place has no tag: the
    largest sum of a run over a place is that of the best run ending there and the best beginning there."""
    inner = float(trans[1:, 1:].max() - trans[0, 0])
    enter, leave = float(trans[0, 1:].max() - trans[0, 0]), float(trans[1:, 0].max() - trans[0, 0])
    gain = scores[:, 1].astype(np.float64)
    for j in range(2, scores.shape[1]):
        np.maximum(gain, scores[:, j], out=gain)
    gain += inner - scores[:, 0]
    gain[starts] += max(0.0, -enter)  # a run at the very start or end of a text lacks that transition
    gain[starts + lengths - 1] += max(0.0, -leave)
    edge = np.zeros(len(gain) + 1, np.int32)
    edge[starts] += 1
    edge[starts + lengths] -= 1
    outside = np.cumsum(edge[:-1]) == 0
    gain[outside] = -1e4
    total = np.cumsum(gain)
    low = np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))
    total = np.maximum.accumulate(total[::-1])[::-1]
    return (total - low >= inner - enter - leave - 0.01) & ~outside


def span_scores(path: np.ndarray, scores: np.ndarray, trans: np.ndarray) -> list[tuple[int, int, str, float]]:
    """The spans of a path, each with the log-odds of its tags against none."""
    out, none = [], float(trans[0, 0])
    for a, b, kind in spans_of(path):
        tags = path[a:b].astype(np.int64)
        own = float((scores[np.arange(a, b), tags] - scores[a:b, 0]).sum() + (trans[tags[:-1], tags[1:]] - none).sum())
        own += float(trans[path[a - 1], tags[0]] - none) if a else 0.0
        own += float(trans[tags[-1], path[b]] - none) if b < len(path) else 0.0
        out.append((a, b, kind, own))
    return out


def best_spans(model: Tagger, parts: list[np.ndarray], everywhere: bool = False) -> Iterator[tuple[list[tuple[int, int, str, float]], int]]:
    """For the codes of each text its spans by the best path, and the place near its end where the model is surest of none."""
    scores, begins = joined_scores(model, parts)
    starts, lengths = begins[:-1], np.array([len(c) for c in parts])
    mark = open_places(scores, model.trans, starts, lengths)
    if everywhere:
        for a, n in zip(starts.tolist(), lengths.tolist()):
            mark[a : a + n] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
    owner = np.searchsorted(starts, edge[::2], side="right") - 1
    # each run of open places with the untagged places beside it, if the text has them
    low = np.maximum(edge[::2] - 1, starts[owner])
    high = np.minimum(edge[1::2] + 1, (starts + lengths)[owner])
    found: list[list[tuple[int, int, str, float]]] = [[] for _ in parts]
    if len(low):
        n = high - low
        own = np.concatenate([[0], np.cumsum(n)])
        some = scores[np.repeat(low - own[:-1], n) + np.arange(own[-1])]
        shut = np.concatenate([own[:-1][low < edge[::2]], own[1:][high > edge[1::2]] - 1])
        some[shut, 1:] = -1e9
        # scores over those of no tag keep sums small, so that nearly equal paths are told apart wherever a run begins
        for k, path in enumerate(viterbi(some - some[:, :1], model.trans - model.trans[0, 0], own[:-1], n)):
            if path.any():
                at = int(low[k] - starts[owner[k]])
                found[owner[k]] += [(at + a, at + b, kind, score) for a, b, kind, score in span_scores(path, some[own[k] : own[k + 1]], model.trans)]
    for i, (a, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
        tail = max(0, n - 8 * WIDTH)
        near = scores[a + tail : a + max(n - WIDTH, tail + 1)]
        yield found[i], tail + int((near[:, 0] - near[:, 1:].max(1)).argmax())


def model_spans(model: Tagger, whole: list[str], everywhere: bool = False) -> list[list[tuple[int, int, str, float]]]:
    """Spans of the model in each text, with their scores; ``everywhere`` seeks the best path without ruling out places."""
    found: list[list[tuple[int, int, str, float]]] = [[] for _ in whole]
    held: list[int] = []
    size = 0

    def close() -> None:
        nonlocal size
        for i, (spans, _) in zip(held, best_spans(model, [codes(whole[i]) for i in held], everywhere)):
            found[i] = spans
        held.clear()
        size = 0

    for i, text in enumerate(whole):
        if len(text) > PIECE:
            at = 0
            while at < len(text):
                low = max(0, at - WIDTH)
                ((spans, cut),) = best_spans(model, [codes(text[low : low + PIECE])], everywhere)
                end = low + cut if low + PIECE < len(text) else len(text)
                found[i] += [(low + a, low + b, k, s) for a, b, k, s in spans if at <= low + a < end]
                at = end
        elif text:
            held.append(i)
            size += len(text)
            if size > PIECE // 4:
                close()
    if held:
        close()
    return found


#: What stands for the sign of an address.
AT = r"@|&#64;|&commat;|[\[({<]\s*(?:at|a)\s*[\])}>]|_at_|\bat\b"
#: After it a host's name, some dot, and the start of another name.
HOST = re.compile(rf"(?:{AT})\s*[^\W_][\w-]*\s*(?:\.|\bdot\b|[\[({{<]\s*dot\s*[\])}}>])\s*[^\W_]", re.I)


def checked(text: str, span: Span) -> bool:
    """What no model of shapes can tell: a card's check digit, the size of an address's numbers, some sign for "at" with a host behind it, digits enough to call."""
    s = text[span[0] : span[1]]
    d = digits_of(s)
    if span[2] == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if span[2] == "ip":
        numbers = re.findall(r"[0-9]+", s)
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    if span[2] == "email":
        return HOST.search(s) is not None
    return 7 <= len(d) <= 15


def calibrated(model: Tagger, rows: list[tuple[str, list[Span]]], wrong: float = 0.003, least: float = 3.0) -> Tagger:
    """The model with the least cut for each kind, ``least`` or more, at which at most this share of what it finds in the
    rows touches no labelled span of the kind."""
    seen: dict[str, list[tuple[float, bool]]] = {k: [] for k in KINDS}
    for (text, gold), spans in zip(rows, model_spans(model, [t for t, _ in rows])):
        for a, b, kind, score in spans:
            if checked(text, (a, b, kind)):
                seen[kind].append((score, any(k == kind and a < e and s < b for s, e, k in gold)))
    for kind, some in seen.items():
        some.sort(reverse=True)
        bad = np.cumsum([not ok for _, ok in some])
        fine = [s for (s, _), n, m in zip(some, bad, range(1, len(some) + 1)) if n <= wrong * m]
        model.cuts[kind] = max(least, fine[-1]) if fine else float("inf")
    return model


def trimmed(text: str, span: Span) -> Span:
    """Without the blanks and stops of the sentence around it; an address's name holds no blank, so words before it go."""
    a, b, kind = span
    b = a + len(text[a:b].rstrip(" \t\r\n.,;:!?"))
    a = b - len(text[a:b].lstrip(" \t\r\n.,;:!?"))
    if kind == "email" and (sign := re.search(rf"\s*(?:{AT})", text[a:b], re.I)):
        a += len(re.match(r"(?:.*\s)?", text[a : a + sign.start()], re.S)[0])
    return a, b, kind


def find_spans(model: Tagger | None, whole: list[str], known: dict[int, list] | None = None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text. A span of the model that touches a base span gives way to it. A text that
    occurs again is read once; ``known`` keeps what was found by the texts' 128-bit hashes."""
    out = []
    known = {} if known is None else known
    if len(known) > REMEMBERED:
        known.clear()
    keys = [xxhash.xxh3_128_intdigest(t.encode("utf-8", "surrogatepass")) for t in whole]
    new = {k: t for k, t in zip(keys, whole) if k not in known}
    known.update(zip(new, model_spans(model, list(new.values())) if model else [[]] * len(new)))
    for text, key in zip(whole, keys):
        base, more = base_spans(text), known[key]
        added = [trimmed(text, (a, b, kind)) for a, b, kind, score in more if score >= model.cuts.get(kind, 0.0)]
        kept = [s for s in added if s[0] < s[1] and checked(text, s) and not any(s[0] < b and a < s[1] for a, b, _ in base)]
        out.append((base, sorted(base + kept, key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


# Labelled spans

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ción ez que eau ä ü sch ver".split()


def labelled_rows(n: int = 1500, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Invented lines with marked personal data in many forms, and with numbers, keys, dates and versions that are none."""
    r = random.Random(seed)
    cased = lambda x: x if (p := r.random()) < 0.8 else x.capitalize() if p < 0.95 else x.upper()
    word = lambda: cased("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) if r.random() < 0.8 else letters())
    letters = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 14)))
    name = lambda: re.sub(r"[^a-zA-Z]", "a", word()) if r.random() < 0.6 else letters()
    num = lambda k: "".join(r.choices("0123456789", k=k))

    def card() -> str:
        d = r.choice(["3", "4", "5", "6", num(1)]) + num(r.choice([12, 13, 14, 14, 14, 14, 15, 16, 17]))
        d += next(c for c in "0123456789" if luhn(d + c)) if r.random() < 0.5 else num(1)  # the check digit is no matter of shape
        sep = r.choice(["", " ", "-", ".", ""])
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def email() -> str:
        at, dot = r.choice([("@", "."), (" @ ", "."), ("[at]", "."), ("(at)", "."), (" (at) ", "."), (" [at] ", "."), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" [at] ", " [dot] "), (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), ("{at}", "."), ("_at_", "."), ("&#64;", ".")])
        if r.random() < 0.15:
            at, dot = at.upper(), dot.upper()
        own = name() + r.choice(["", name() + name(), num(2) + name() + name(), r.choice(["", ".", "_"]) + num(2), r.choice([".", "_", "-"]) + name(), r.choice([".", "_"]) + name() + num(2)])
        host = dot.join([name() + r.choice(["", "", num(1)]), *(name() for _ in range(r.choice([0, 0, 1])))])
        own = r.choice([own, own, own, num(r.randint(1, 3)) + own])
        return f"{own}{at}{host}{dot}{r.choice(['com', 'org', 'net', 'de'])}"

    def phone() -> str:
        return r.choice([f"+1 ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"+{num(2)} {num(3)} {num(4)} {num(3)}", f"{num(3)}-{num(3)}-{num(4)}", f"00{num(2)} {num(2)} {num(4)} {num(4)}", f"+{num(11)}"])

    def ip() -> str:
        return r.choice([".", ".", ".", " . "]).join(str(r.randint(0, 255)) for _ in range(4))

    plain = lambda: r.choice("the a it me us you home noon night least last work school first all that once".split())
    junk = lambda: r.choice(["&&&", "%%%", "***", "###", "$$$", "!!", ".***", "&&&", "%%%"])
    other = [
        lambda: f"{word()}{junk()} {r.choice(['at', 'At', 'dot', 'a'])}{r.choice([junk(), ''])} {word()}{junk()}", lambda: f"{word()}{junk()} {word()}{junk()} {word()}{junk()}", lambda: f"{word()} {word()}{junk()} at {word()},{junk()} {word()}",
        lambda: num(r.randint(1, 12)), lambda: f"{word()} at {plain()}", lambda: f"{word()} at {plain()} {r.choice(['dot', word()])} {word()}", lambda: f"{word()} {r.choice(['at', 'AT', 'dot'])} {word()} {word()}", lambda: f"{word()} at {word()} {word()} dot {word()}",
        lambda: " ".join(num(2) for _ in range(r.randint(4, 9))), lambda: " ".join(num(r.randint(1, 4)) for _ in range(r.randint(3, 8))),
        lambda: f"{r.choice(['ISBN', 'isbn', 'EAN', 'ISBN-13:'])} {r.choice(['978', '979'])}-{num(1)}-{num(2)}-{num(6)}-{num(1)}", lambda: f"ISBN {num(1)}-{num(3)}-{num(5)}-{num(1)}",
        lambda: f"{r.choice(['order', 'Order', 'invoice', 'case', 'part', 'serial', 'ticket', 'id'])} {r.choice(['no.', 'number', '#', 'nr.', 'no'])} {r.choice([num(3) + '-' + num(3) + '-' + num(4), num(4) + '-' + num(5), num(10), num(2) + '-' + num(7)])}", lambda: f"version {r.randint(1, 9)}.{r.randint(0, 9)}", lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
        lambda: f"password={''.join(r.choices('0123456789abcdef', k=18))}", lambda: "AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)),
        lambda: f'token = "{"".join(r.choices("0123456789abcdef", k=40))}"', lambda: f"{r.randint(1, 999)},{num(3)}.{num(2)}", lambda: f"[{r.randint(1, 99)}] {word()}", lambda: f"@{name()}", lambda: f"({word()}) {word()} [{word()}]", lambda: f"{word()} {r.choice(['(at)', '[at]', '@', '(dot)', '[dot]'])} {word()} {word()}, {word()}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: word() + r.choice([".***", "***", "!!", " ###", "$$$.", ".*** " + word(), "...", "@#$"]), lambda: f"{r.randint(1, 20)}.{r.randint(1, 20)}.{r.randint(1, 20)}",
    ]
    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    rows = []
    for _ in range(n):
        text, spans = "", []
        for part in range(r.randint(1, 4)):
            if part or r.random() < 0.8:  # some texts begin with it
                text += " ".join(word() for _ in range(r.randint(1, 8))) + r.choice([" ", " ", ": ", ", ", ". "])
            if r.random() < 0.55:
                kind = r.choice(KINDS)
                s = makers[kind]()
                spans.append((len(text), len(text) + len(s), kind))
            else:
                s = r.choice(other)()
            text += s + r.choice([" ", " ", ", ", ". ", "\n"])
        rows.append((text + word() if r.random() < 0.8 else text[:-1], spans))  # and some end with it
    return rows


def trained(rows: int = 8000, epochs: int = 12) -> Tagger:
    """A model from the labelled rows above, cut by others: no corpus enters. Takes minutes."""
    return calibrated(train(labelled_rows(rows), epochs=epochs), labelled_rows(8000, seed=12))


WEIGHTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "pii_weights.npz")


def save(model: Tagger, path: str = WEIGHTS) -> None:
    np.savez_compressed(path, *model.parameters(), np.array([model.cuts[k] for k in KINDS], np.float32))


@functools.cache
def default_tagger(path: str = WEIGHTS) -> Tagger:
    """The model of the queries, the same at all sizes: what ``trained`` gave (``python -m pagemill.llm.pii`` makes it anew)."""
    with np.load(path) as f:
        *w, cuts = (f[k] for k in sorted(f.files, key=lambda k: int(k[4:])))
    return Tagger(w[0:2], w[2:4], w[4:6], w[6], w[7], w[8], dict(zip(KINDS, cuts.tolist())))


def detect(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """doc_id, counts by kind of the base spans, the digest of the base spans, all spans."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[int, list] = {}
        for b in slices(batches, 1000):
            found = find_spans(model, texts(b.column("text")), known)
            count = lambda kind: [sum(s[2] == kind for s in base) for base, _ in found]  # noqa: E731, B023
            yield {"doc_id": b.column("doc_id")} | {f"n_{k}": count(k) for k in KINDS} | {"base_sha256": [hashlib.sha256(as_string(x).encode()).hexdigest() for x, _ in found], "spans": [as_string(x) for _, x in found]}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """The same rows and columns; every span of ``text`` becomes its kind in angle brackets, and n_chars, if there, follows."""
    names = docs.columns
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        known: dict[int, list] = {}
        for b in slices(batches, 1000):
            raw = b.column("text").to_pylist()
            new = []
            for text, (_, spans) in zip(raw, find_spans(model, [t or "" for t in raw], known)):
                parts, at = [], 0
                for a, e, k in spans:
                    if a >= at:
                        parts += [text[at:a], f"<{k.upper()}>"]
                    at = max(at, e)
                new.append(text if not spans else "".join(parts) + text[at:])
            cols = {n: b.column(n) for n in names} | {"text": pa.array(new, b.schema.field("text").type)}
            if kinds.get("n_chars") == "bigint":
                old = b.column("n_chars").to_pylist()
                cols["n_chars"] = pa.array([o if x is None or x == y else len(x) for o, x, y in zip(old, new, raw)], pa.int64())
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], schema=b.schema)

    from pagemill import ship

    ship.ensure(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


if __name__ == "__main__":
    save(trained())
