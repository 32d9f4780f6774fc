"""A gated recurrent language model in numpy, with a class-factored softmax.

Token ids: 0 is the end of a text, ids up to `head` are words that the network
tells apart, and each further id is a class of rarer words. An output is first
the end, a block of words or the rarer words as one, then a word of its block or
a class of rarer words. The last row of output weights is their bias.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

BLOCK = 64  # words that share a class of the output
PIECE = 1 << 14  # parameters updated at a time, so that they stay in the cache
SIDE = 256  # texts scored side by side
FEW = 4  # gradients of an id in a window that are added one by one


class Scratch:
    """Arrays that are used again and again, by name: new ones for every window may be
    handed back to the system each time, which then clears them again."""

    def __init__(self) -> None:
        self.kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], kind: type = np.float32) -> np.ndarray:
        size = int(np.prod(shape))
        found = self.kept.get(name)
        if found is None or len(found) < size or found.dtype != kind:
            found = self.kept[name] = np.empty(size, kind)
        return found[:size].reshape(shape)


@dataclass
class Shape:
    head: int  # words with an id of their own, a multiple of BLOCK
    tail: int  # classes of rarer words
    hidden: int

    @property
    def blocks(self) -> int:
        return self.head // BLOCK

    @property
    def classes(self) -> int:
        return 2 + self.blocks

    @property
    def id_type(self) -> type:
        return np.uint16 if self.head + self.tail < 1 << 16 else np.uint32

    def split(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, place among the words or rarer words of that class, or -1) of target ids."""
        words, tail = np.arange(self.head), np.arange(self.tail)
        short = np.uint16 if self.classes < 1 << 16 else np.int64  # short ones are sorted by radix
        kind = np.concatenate([[0], 1 + words // BLOCK, np.full(self.tail, 1 + self.blocks)]).astype(short)
        return kind[ids], np.concatenate([[-1], words % BLOCK, tail])[ids]


def _log_sum(logs: np.ndarray) -> np.ndarray:
    top = logs.max(axis=-1, initial=-99.0, keepdims=True)
    return top[..., 0] + np.log(np.exp(logs - top).sum(axis=-1))


def start(shape: Shape, mass: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Parameters whose first predictions are the ids' shares of `mass`."""
    rng = np.random.default_rng(seed)
    h, draw = shape.hidden, lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
    logs = np.log(mass / mass.sum()).astype(np.float32)
    words, tail = logs[1 : shape.head + 1].reshape(shape.blocks, BLOCK), logs[shape.head + 1 :]
    p = {
        # of the gate that keeps, of the reset and of the new state
        "in": draw(3, 1 + shape.head + shape.tail, h),
        "rec": (rng.standard_normal((3, h, h)) / np.sqrt(h)).astype(np.float32),
        "bias": np.repeat(np.float32([1, 0, 0]), h).reshape(3, 1, h),  # begins by keeping its state
        "out": draw(h + 1, shape.classes) * np.float32(0.1),
        "word": draw(shape.blocks, h + 1, BLOCK) * np.float32(0.1),
        "tail": draw(h + 1, shape.tail) * np.float32(0.1),
    }
    p["out"][-1] = np.concatenate([logs[:1], _log_sum(words), [_log_sum(tail)]])
    p["word"][:, -1], p["tail"][-1] = words, tail
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def step(p: dict, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One token for each lane; a lane at the start of a text forgets its state."""
    h = h * (x != 0)[:, None].astype(np.float32)
    given, past = p["in"][:, x] + p["bias"], h @ p["rec"]
    keep, reset = _sigmoid(given[:2] + past[:2])
    fresh = np.tanh(given[2] + reset * past[2])
    return fresh + keep * (h - fresh), h, keep, reset, fresh, past[2]


def _row_sums(x: np.ndarray) -> np.ndarray:
    """As `x.sum(axis=1)`, which takes five times as long on short rows."""
    return x @ np.ones(x.shape[1], x.dtype)


def _in_range(x: np.ndarray) -> np.ndarray:
    """Outputs less the top of their row, or as they are if no exponential is near infinite or 0."""
    if not -80 < x.min(initial=0) <= x.max(initial=0) < 80:
        x -= x.max(axis=1, keepdims=True)
    return x


def _log_share(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at its target; `x` is used up."""
    hit = _in_range(x)[np.arange(len(x)), target]
    np.exp(x, out=x)
    return hit - np.log(_row_sums(x))


def log_prob(p: dict, shape: Shape, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target id after each state."""
    return _log_prob(p, shape, np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1), target, Scratch())


def _log_prob(p: dict, shape: Shape, flat: np.ndarray, target: np.ndarray, some: Scratch) -> np.ndarray:
    """As `log_prob`, for states that end in a one."""
    order, kind, place, at = _by_class(shape, target)
    flat, real = np.take(flat, order, axis=0, out=some("inside", flat.shape, flat.dtype), mode="clip"), flat.dtype
    got = _log_share(np.matmul(flat, p["out"], out=some("classes", (len(flat), shape.classes), real)), kind)
    words, rare = slice(at[0], at[-1]), slice(at[-1], len(flat))
    d = some("words", (at[-1] - at[0], BLOCK), real)
    for c, (i, j) in enumerate(zip(at, at[1:])):
        if j > i:
            np.matmul(flat[i:j], p["word"][c], out=d[i - at[0] : j - at[0]])
    got[words] += _log_share(d, place[words])
    got[rare] += _log_share(flat[rare] @ p["tail"], place[rare])
    out = np.empty_like(got)
    out[order] = got
    return out


def _by_class(shape: Shape, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(rows sorted by the class of their target, their classes, their places, where each block and the rarer words begin)."""
    kind, place = shape.split(target)
    order = np.argsort(kind, kind="stable")
    kind = kind[order]
    return order, kind, place[order], np.searchsorted(kind, np.arange(1, shape.blocks + 2)).tolist()


def _softmax_loss(x: np.ndarray, target: np.ndarray, n: float) -> float:
    """The sum of the rows' log losses; `x` becomes their gradient, over `n`."""
    at = np.arange(len(x))
    hit = _in_range(x)[at, target].sum()
    np.exp(x, out=x)
    total = _row_sums(x)
    loss = float(np.log(total).sum() - hit)
    x *= (1 / (total * n))[:, None]
    x[at, target] -= 1 / n
    return loss


def _inputs(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """(weights of each id with the bias, recurrent weights); the reset's are negated, for `_forward`."""
    given, rec = p["in"] + p["bias"], p["rec"].copy()
    for x in (given[1], rec[1]):
        np.negative(x, out=x)
    return given, rec


def _forward(weights: tuple, x: np.ndarray, h: np.ndarray, some: Scratch) -> tuple[np.ndarray, ...]:
    """As `step`, over all steps of x (steps, lanes): (states before each step, new states, gates,
    states after each step). Of `gates` the first is 1 less the share that is kept, the second
    the reset and the last what the past gives. States after a step end in a one."""
    table, rec = weights
    (steps, lanes), width, real = x.shape, table.shape[2], table.dtype
    given = some("given", (3, steps, lanes, width), real)
    for part, out in zip(table, given):
        np.take(part, x, axis=0, out=out, mode="clip")
    before, fresh, after = some("steps", (3, steps, lanes, width), real)
    gates, states = some("gates", (3, steps, lanes, width), real), some("states", (steps, lanes, width + 1), real)
    move, one = some("move", (lanes, width), real), real.type(1)
    live = (x != 0).astype(real)[:, :, None]
    whole = live.all(axis=(1, 2))
    with np.errstate(over="ignore"):  # a gate of 1 / inf is closed
        for t in range(steps):
            if whole[t]:
                before[t] = h
            else:
                np.multiply(h, live[t], out=before[t])
            h, new, now = before[t], fresh[t], gates[:2, t]
            np.matmul(h, rec, out=gates[:, t])
            now += given[:2, t]
            np.exp(now, out=now)
            now += one
            np.divide(one, now, out=now)
            np.multiply(now[1], gates[2, t], out=new)
            new += given[2, t]
            np.tanh(new, out=new)
            np.subtract(new, h, out=move)
            move *= now[0]
            h = np.add(h, move, out=after[t])
    states[:, :, :width], states[:, :, width] = after, 1
    return before, fresh, gates, states


def _by_id(ids: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, list]:
    """(rows sorted by id, those of at most FEW rows first; where each id's rows begin; the ids; how many have
    few rows; which of these have a second, a third, ... row)."""
    many = np.bincount(ids, minlength=distinct) > FEW
    key = (ids + distinct * many[ids]).astype(np.uint16 if 2 * distinct < 1 << 16 else np.int64)  # a radix sort if it may
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] + 1))
    few = int(np.searchsorted(key[first], distinct))
    size = np.diff(first, append=len(key))[:few]
    return order, first, key[first] % distinct, few, [np.flatnonzero(size > k) for k in range(1, FEW)]


def window_gradients(
    p: dict, shape: Shape, x: np.ndarray, y: np.ndarray, h: np.ndarray, g: dict | None = None, some: Scratch | None = None
) -> tuple[dict, np.ndarray, float]:
    """Gradients of the mean log loss over one window (steps, lanes), cut off at
    its first step, with the state at its end and the loss. They are put into
    the arrays `g` if given."""
    steps, lanes = x.shape
    width, real = shape.hidden, p["in"].dtype
    if g is None:
        g = {k: np.empty_like(v) for k, v in p.items()}
    some = some or Scratch()
    before, fresh, gates, states = _forward(_inputs(p), x, h, some)
    # the output, in rows sorted by class: classes of all, then words of each block and rarer words
    flat = states.reshape(-1, width + 1)
    order, kind, place, at = _by_class(shape, y.reshape(-1))
    flat = np.take(flat, order, axis=0, out=some("inside", flat.shape, real), mode="clip")
    words, rare, n = slice(at[0], at[-1]), slice(at[-1], len(flat)), real.type(len(flat))
    d = np.matmul(flat, p["out"], out=some("classes", (len(flat), shape.classes), real))
    loss = _softmax_loss(d, kind, n)
    np.matmul(flat.T, d, out=g["out"])
    back = np.matmul(d, p["out"][:-1].T, out=some("back", (len(flat), width), real))
    g["word"][:] = 0
    d, more = some("words", (at[-1] - at[0], BLOCK), real), some("more", (at[-1] - at[0], width), real)
    parts = [(c, slice(i, j), slice(i - at[0], j - at[0])) for c, (i, j) in enumerate(zip(at, at[1:])) if j > i]
    for c, here, part in parts:
        np.matmul(flat[here], p["word"][c], out=d[part])
    loss += _softmax_loss(d, place[words], n)
    for c, here, part in parts:
        np.matmul(flat[here].T, d[part], out=g["word"][c])
        np.matmul(d[part], p["word"][c, :-1].T, out=more[part])
    back[words] += more
    d = flat[rare] @ p["tail"]
    loss += _softmax_loss(d, place[rare], n)
    np.matmul(flat[rare].T, d, out=g["tail"])
    back[rare] += d @ p["tail"][:-1].T
    d_states = some("d_states", (len(flat), width), real)
    d_states[order] = back
    # backward: factors that do not depend on the gradient are made for all steps at once
    d_states = d_states.reshape(steps, lanes, width)
    rest, reset, past = gates
    to_fresh, to_keep, to_reset, keep = some("factors", (4, steps, lanes, width), real)
    np.subtract(1, rest, out=keep)
    np.multiply(fresh, fresh, out=to_fresh)
    np.subtract(1, to_fresh, out=to_fresh)
    to_fresh *= rest
    np.subtract(before, fresh, out=to_keep)
    to_keep *= keep
    to_keep *= rest
    np.subtract(1, reset, out=to_reset)
    to_reset *= reset
    to_reset *= past
    # of the gates, of the past in the new state, and of all of the new state
    d_given = some("d_given", (4, steps, lanes, width), real)
    back, rec = np.zeros((lanes, width), real), p["rec"].transpose(0, 2, 1).copy()
    to_past, live = some("to_past", (3, lanes, width), real), (x != 0).astype(real)[:, :, None]
    whole = live.all(axis=(1, 2))
    for t in reversed(range(steps)):
        back += d_states[t]
        d_keep, d_reset, d_past, d_new = d_given[:, t]
        np.multiply(back, to_keep[t], out=d_keep)
        np.multiply(back, to_fresh[t], out=d_new)
        np.multiply(d_new, to_reset[t], out=d_reset)
        np.multiply(d_new, reset[t], out=d_past)
        back *= keep[t]
        for more in np.matmul(d_given[:3, t], rec, out=to_past):
            back += more
        if not whole[t]:
            back *= live[t]
    d_given = d_given.reshape(4, -1, width)
    np.matmul(before.reshape(-1, width).T, d_given[:3], out=g["rec"])
    g["in"][:] = 0
    order, first, seen, few, later = _by_id(x.reshape(-1), p["in"].shape[1])
    pairs = np.result_type(real, np.complex64) if width % 2 == 0 else real  # two numbers are added at a time, as one complex
    for i, part in enumerate((d_given[0], d_given[1], d_given[3])):
        np.matmul(np.ones((1, len(part)), real), part, out=g["bias"][i])
        part = np.take(part, order, axis=0, out=some("sorted", part.shape, real), mode="clip")
        total = part[first]
        for k, rows in enumerate(later, 1):
            total[rows] += part[first[rows] + k]
        if few < len(first):
            total[few:] = np.add.reduceat(part.view(pairs), first[few:], axis=0).view(real)
        g["in"][i, seen] = total
    return g, states[-1, :, :width].copy(), float(loss / n)


def _views(flat: np.ndarray, like: dict) -> dict:
    """Arrays of the shapes in `like` that lie in `flat` one after the other."""
    ends = np.cumsum([0, *[v.size for v in like.values()]])
    return {k: flat[i:j].reshape(v.shape) for (k, v), i, j in zip(like.items(), ends, ends[1:])}


def _adam(p: np.ndarray, m: np.ndarray, v: np.ndarray, d: np.ndarray, some: np.ndarray, clip: float, rate: float, k: int) -> None:
    """Adam's step `k`; `m` and `v` are kept as plain sums, 10 and 100 times the means."""
    if clip < 1:
        d *= clip
    m *= np.float32(0.9)
    m += d
    v *= np.float32(0.99)
    d *= d
    v += d
    scale = 0.1 / np.sqrt(1 - 0.99**k)
    np.sqrt(v, out=some)
    some += np.float32(1e-6 / scale)
    np.divide(m, some, out=some)
    some *= np.float32(rate * 0.1 / (1 - 0.9**k) / scale)
    p -= some


def train(p: dict, shape: Shape, stream: np.ndarray, lanes: int, window: int, rate: float) -> dict:
    """One pass over a stream of ids in `lanes` side by side, by truncated
    backpropagation: gradients stop at a window's start, states go on (Adam)."""
    values = np.concatenate([v.reshape(-1) for v in p.values()])
    p = _views(values, p)
    m, v, d = (np.zeros_like(values) for _ in range(3))
    g, some, kept = _views(d, p), np.empty(PIECE, values.dtype), Scratch()
    lanes = max(1, min(lanes, (len(stream) - 1) // window))
    steps = (len(stream) - 1) // lanes
    if steps < 1:
        return p
    x = stream[: lanes * steps].reshape(lanes, steps).T
    y = stream[1 : lanes * steps + 1].reshape(lanes, steps).T
    h = np.zeros((lanes, shape.hidden), np.float32)
    for k, t in enumerate(range(0, steps, window), 1):
        _, h, _ = window_gradients(p, shape, x[t : t + window], y[t : t + window], h, g, kept)
        clip = np.float32(min(1.0, 1.0 / (np.sqrt(float(d @ d)) + 1e-9)))
        for i in range(0, len(values), PIECE):
            _adam(*(z[i : i + PIECE] for z in (values, m, v, d)), some[: len(values) - i], clip, rate, k)
    return {k: v.copy() for k, v in p.items()}


def _lanes(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(each text's place, each lane's first place, each lane's length) if texts run in lanes, one after
    the other, longest texts first to the lane that is shortest by then. Lanes are filled up
    to whole windows; the longest come first."""
    loads = [(0, lane) for lane in range(min(SIDE, len(lengths)))]
    order = np.argsort(-lengths, kind="stable")
    owner, before = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        load, lane = loads[0]
        owner[i], before[i] = lane, load
        heapq.heapreplace(loads, (load + n, lane))
    size = np.empty(len(loads), np.int64)
    for load, lane in loads:
        size[lane] = -(-load // window) * window
    by_size = np.argsort(-size, kind="stable")
    first = np.empty(len(size), np.int64)
    first[by_size] = np.cumsum(size[by_size]) - size[by_size]
    return first[owner] + before, first[by_size], size[by_size]


def score_texts(p: dict, shape: Shape, ids: np.ndarray, offsets: np.ndarray, window: int, held: int = 1 << 14) -> np.ndarray:
    """Log-probability of each whole text and its end. Texts run in lanes side by
    side; a text's state goes on from window to window to its end. Outputs are worked out
    for `held` tokens at a time."""
    lengths = np.diff(offsets) + 1
    if not len(lengths):
        return np.zeros(0)
    place, first, size = _lanes(lengths, window)
    # the ids of all lanes, an end after each text; what fills a lane up is no target of a text
    target = np.zeros(int(size.sum()), shape.id_type)
    target[np.repeat(place - offsets[:-1], lengths - 1) + np.arange(len(ids))] = ids
    logs = np.zeros(len(target), np.float32)
    weights, some, h = _inputs(p), Scratch(), np.zeros((len(first), shape.hidden), np.float32)
    for t in range(0, int(size[0]), window):
        n = int(np.searchsorted(-size, -t, side="left"))  # lanes longer than t
        at = first[:n] + np.arange(t, t + window)[:, None]
        # the id before; a lane begins after the end of the one before it
        states = _forward(weights, target[at - 1], h[:n], some)[3]
        flat, at = states.reshape(-1, shape.hidden + 1), at.reshape(-1)
        for i in range(0, len(flat), held):
            logs[at[i : i + held]] = _log_prob(p, shape, flat[i : i + held], target[at[i : i + held]], some)
        h = states[-1, :, : shape.hidden].copy()
    order = np.argsort(place)
    edges = np.stack([place, place + lengths], axis=1)[order].reshape(-1)
    total = np.empty(len(lengths))
    total[order] = np.add.reduceat(np.append(logs, 0), edges, dtype=np.float64)[::2]
    return total
