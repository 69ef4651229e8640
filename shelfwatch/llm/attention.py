"""A small causal self-attention model over token classes, in numpy.

One attention layer and one hidden layer. It predicts the class of the next token; the token
within its class is left to corpus counts. Windows are batched and masked.
"""

from __future__ import annotations

import math

import numpy as np

#: Positions of a window, positions that are context only, vector size, hidden size.
SPAN, OVERLAP, SIZE, HIDDEN = 32, 16, 16, 32
_SEEN = np.tril(np.ones((SPAN, SPAN), np.float32))
#: Windows worked on at once, in scoring and in a gradient: what they need stays in a core's cache.
AT_ONCE, STEP_AT_ONCE = 64, 32
#: Sums of exponents below the first hold no exponent above 60; in sums above the second those below -60 do not count.
_TOP, _LOW = 1e26, 1e-15


def shapes(inputs: int, classes: int) -> dict[str, tuple[int, ...]]:
    return {
        "embed": (inputs, SIZE),
        "place": (SPAN, SIZE),
        "q": (SIZE, SIZE),
        "k": (SIZE, SIZE),
        "v": (SIZE, SIZE),
        "mixed": (SIZE, SIZE),
        "up": (SIZE, HIDDEN),
        "up_bias": (HIDDEN,),
        "down": (HIDDEN, SIZE),
        "out": (SIZE, classes),
        "out_bias": (classes,),
    }


def start_weights(inputs: int, classes: int, seed: int = 11) -> np.ndarray:
    """All weights as one vector, from a fixed seed."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, shape in shapes(inputs, classes).items():
        if name.endswith("bias"):
            parts.append(np.zeros(shape))
        else:
            scale = 0.3 if name in ("embed", "place") else 1 / np.sqrt(shape[0])
            parts.append(rng.standard_normal(shape) * scale)
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def unpack(vector: np.ndarray, inputs: int, classes: int) -> dict[str, np.ndarray]:
    """Named views of a weight vector."""
    out, at = {}, 0
    for name, shape in shapes(inputs, classes).items():
        n = int(np.prod(shape))
        out[name] = vector[at : at + n].reshape(shape)
        at += n
    return out


_rooms: dict[tuple, np.ndarray] = {}
_views: dict[tuple, np.ndarray] = {}


def _room(name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
    """Memory for one intermediate result, used again by the next call: new memory costs more than the arithmetic."""
    view = _views.get((name, shape, kind))
    if view is None:
        size, held = math.prod(shape), _rooms.get((name, kind))
        if held is None or len(held) < size or len(_views) > 4096:
            held = _rooms[name, kind] = np.empty(size, kind)
            _views.clear()
        view = _views[name, shape, kind] = held[:size].reshape(shape)
    return view


def _attended(q: np.ndarray, k: np.ndarray, v: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, their sums, means of the values seen), for positions from ``first`` on; ``k`` has a window's keys as columns."""
    kind = q.dtype
    near = _room("near", (len(q), SPAN - first, SPAN), kind)

    def fill(top: bool) -> np.ndarray:
        np.matmul(q, k, out=near)
        if top:
            np.minimum(near, 60, out=near)
        np.exp(near, out=near)
        np.multiply(near, _SEEN[first:], out=near)
        # Sums as products with ones: faster than numpy's reductions over short rows.
        return (near.reshape(-1, SPAN) @ np.ones(SPAN, kind)).reshape(-1, SPAN - first, 1)

    with np.errstate(over="ignore", invalid="ignore"):
        mass = fill(False)
    if not mass.max(initial=0) < _TOP:
        mass = fill(True)
    seen = np.matmul(near, v, out=_room("seen", (len(q), SPAN - first, SIZE), kind))
    seen /= mass
    return near, mass, seen


def _odds(y: np.ndarray, out: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the exponents of the class logits, logits of the targets); logits are held within 60 of 0."""
    logits = np.matmul(y, out, out=_room("logits", (len(y), out.shape[1]), y.dtype))
    ones = np.ones(out.shape[1], y.dtype)
    own = logits.reshape(-1).take(np.arange(0, logits.size, len(ones)) + targets.ravel())
    own = np.minimum(np.maximum(own, -60), 60)
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(logits, out=logits)
        mass = logits @ ones
    if not (mass.max(initial=1) < _TOP and mass.min(initial=1) > _LOW):
        mass = np.exp(np.clip(y @ out, -60, 60)) @ ones
    return mass, own


def prepared(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights, and what a token or a place adds to keys and values, and to its own vector and query."""
    near = np.concatenate([w["k"], w["v"] @ w["mixed"]], axis=1)
    own = np.concatenate([np.eye(SIZE, dtype=near.dtype), w["q"] * near.dtype.type(SIZE**-0.5)], axis=1)
    tables = {f"{n}{place}": w[of] @ m for n, m in (("near", near), ("own", own)) for of, place in (("embed", ""), ("place", "_place"))}
    # For rows that end with a one, which carries the biases.
    none = np.zeros((HIDDEN, 1), w["down"].dtype)
    return w | tables | {
        "up_all": np.vstack([w["up"], w["up_bias"]]),
        "down_all": np.hstack([w["down"], none]),
        "out_all": np.vstack([w["out"], w["out_bias"]]),
    }


def class_log10(w: dict[str, np.ndarray], tokens: np.ndarray, targets: np.ndarray, first: int = 0) -> np.ndarray:
    """log10 probability of each target class, window by window; places before ``first`` are context only and have no targets.

    ``w`` are named weights; those that ``prepared`` gives save work where many windows are asked for.
    """
    if "near" not in w:
        w = prepared(w)
    n, kind = len(tokens), w["near"].dtype
    near = np.take(w["near"], tokens, axis=0, out=_room("near-rows", (n, SPAN, 2 * SIZE), kind), mode="clip")
    near += w["near_place"]
    own = np.take(w["own"], tokens[:, first:], axis=0, out=_room("own-rows", (n, SPAN - first, 2 * SIZE), kind), mode="clip")
    own += w["own_place"][first:]
    return _rows_log10(w, near, own, targets)


def _rows_log10(w: dict[str, np.ndarray], near: np.ndarray, own: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """The same from keys and values of the places of each window, and own vectors and queries of its last ones."""
    n, at, kind = len(own), own.shape[1], own.dtype
    seen = _attended(own[..., SIZE:], near[..., :SIZE].transpose(0, 2, 1), near[..., SIZE:], SPAN - at)[2]
    h = _room("h", (n, at, SIZE + 1), kind)
    np.add(seen, own[..., :SIZE], out=h[..., :SIZE])
    h[..., SIZE] = 1
    h = h.reshape(-1, SIZE + 1)
    hidden = np.matmul(h, w["up_all"], out=_room("hidden", (len(h), HIDDEN), kind))
    np.maximum(hidden, 0, out=hidden)
    y = np.matmul(hidden, w["down_all"], out=_room("y", h.shape, kind))
    y += h
    mass, logits = _odds(y, w["out_all"], targets)
    logits -= np.log(mass)
    logits /= np.log(10)
    return logits.reshape(targets.shape)


def texts_log10(w: dict[str, np.ndarray], tokens: np.ndarray, targets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each target class of sequences laid end to end, in the windows that ``windows`` gives.

    Later windows begin ``OVERLAP`` places apart, so what a token adds is looked up once for the two windows
    that it stands in: a window is a block of ``OVERLAP`` places and the next. Windows of the last block of a
    sequence and the first of the next are thrown away.
    """
    found = np.empty(len(tokens), w["near"].dtype)
    begins, kind = np.cumsum(sizes) - sizes, found.dtype
    at = begins[sizes > 0][:, None] + np.arange(SPAN)
    real = at < (begins + sizes)[sizes > 0][:, None]
    np.minimum(at, len(tokens) - 1, out=at)
    for a in range(0, len(at), AT_ONCE // 2):
        some = at[a : a + AT_ONCE // 2]
        found[some[real[a : a + AT_ONCE // 2]]] = class_log10(w, tokens[some], targets[some])[real[a : a + AT_ONCE // 2]]
    # Blocks from the second of a sequence on; the first of these is context only.
    count = np.where(sizes > SPAN, -(-sizes // OVERLAP) - 1, 0)
    of = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = (begins[of] + (number + 1) * OVERLAP)[:, None] + np.arange(OVERLAP)
    scored = (at < (begins + sizes)[of][:, None]) & (number > 0)[:, None]
    np.minimum(at, len(tokens) - 1, out=at)
    looked, wanted, log10 = tokens[at], targets[at], np.empty(at.shape, kind)
    for a in range(0, len(at) - 1, AT_ONCE):
        some = looked[a : a + AT_ONCE + 1]
        n = len(some) - 1
        rows = np.take(w["near"], some, axis=0, out=_room("rows", (n + 1, OVERLAP, 2 * SIZE), kind), mode="clip")
        near = _room("near-rows", (n, SPAN, 2 * SIZE), kind)
        np.add(rows[:-1], w["near_place"][:OVERLAP], out=near[:, :OVERLAP])
        np.add(rows[1:], w["near_place"][OVERLAP:], out=near[:, OVERLAP:])
        own = np.take(w["own"], some[1:], axis=0, out=_room("own-rows", (n, OVERLAP, 2 * SIZE), kind), mode="clip")
        own += w["own_place"][OVERLAP:]
        log10[a + 1 : a + 1 + n] = _rows_log10(w, near, own, wanted[a + 1 : a + 1 + n])
    found[at[scored]] = log10[scored]
    return found


def _joined(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights, and those that are used together as one matrix; a last row carries the biases."""
    kind = w["q"].dtype
    return w | {
        "into": np.concatenate([w["q"] * kind.type(SIZE**-0.5), w["k"], w["v"] @ w["mixed"]], axis=1),
        "up_all": np.vstack([w["up"], w["up_bias"]]),
        "down_all": np.hstack([w["down"], np.zeros((HIDDEN, 1), kind)]),
        "out_all": np.vstack([w["out"], w["out_bias"]]),
    }


def _across(name: str, rows: np.ndarray, ones: int = 0) -> np.ndarray:
    """The rows of each window as columns, and ``ones`` rows of ones; laid out in order, too."""
    out = _room(name, (len(rows), SIZE + ones, SPAN), rows.dtype)
    out[:, :SIZE] = rows.transpose(0, 2, 1)
    out[:, SIZE:] = 1
    return out


def _logits(w: dict[str, np.ndarray], tokens: np.ndarray, held: bool = True) -> tuple[np.ndarray, dict]:
    """Class logits, a row per position, and what the backward step needs. All but the attention
    itself is a product of two matrices. The logits are ``held`` within 60 of 0, or left as they are.
    The next call uses the same memory."""
    if "into" not in w:
        w = _joined(w)
    windows, n, kind = len(tokens), tokens.size, w["into"].dtype
    x = np.take(w["embed"], tokens, axis=0, out=_room("x", (windows, SPAN, SIZE), kind), mode="clip")
    x += w["place"]
    x = x.reshape(n, SIZE)
    qkv = np.matmul(x, w["into"], out=_room("qkv", (n, 3 * SIZE), kind)).reshape(windows, SPAN, 3 * SIZE)
    q, k, v = qkv[..., :SIZE], qkv[..., SIZE : 2 * SIZE], qkv[..., 2 * SIZE :]
    near, mass, seen = _attended(q, _across("k-across", k), v, 0)
    h = _room("h", (n, SIZE + 1), kind)
    np.add(x, seen.reshape(n, SIZE), out=h[:, :SIZE])
    h[:, SIZE] = 1
    hidden = np.matmul(h, w["up_all"], out=_room("hidden", (n, HIDDEN), kind))
    np.maximum(hidden, 0, out=hidden)
    y = np.matmul(hidden, w["down_all"], out=_room("y", h.shape, kind))
    y += h
    logits = np.matmul(y, w["out_all"], out=_room("logits", (n, w["out_all"].shape[1]), kind))
    if held:
        np.clip(logits, -60, 60, out=logits)
    return logits, {"x": x, "q": q, "k": k, "v": v, "near": near, "mass": mass, "seen": seen, "h": h, "hidden": hidden, "y": y}


def gradient(w: dict[str, np.ndarray], tokens: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean cross-entropy over the counted positions, summed over ``STEP_AT_ONCE`` windows at a time."""
    w = _joined(w)
    back = {name: np.ascontiguousarray(w[name].T) for name in ("into", "up", "down", "out")}
    kind, classes = w["into"].dtype, w["out"].shape[1]
    ones, units = np.ones(classes, kind), np.ones(SIZE, kind)
    share = (counted.reshape(-1, 1) / max(1, counted.sum())).astype(kind)
    hit = np.arange(tokens.size) % (STEP_AT_ONCE * SPAN) * classes + targets.ravel()
    g = {name: np.zeros(w[name].shape, kind) for name in ("into", "up_all", "down", "out_all")}
    dx_all = _room("dx", (tokens.size, SIZE), kind)
    for a in range(0, len(tokens), STEP_AT_ONCE):
        # Gradients are led back by matrices laid out in order: products with these are twice as fast.
        some = tokens[a : a + STEP_AT_ONCE]
        windows, n, at = len(some), some.size, slice(a * SPAN, (a + len(some)) * SPAN)
        # The difference of the classes' shares and the targets is ``d * each``.
        with np.errstate(over="ignore", invalid="ignore"):
            d, s = _logits(w, some, held=False)
            mass = np.exp(d, out=d) @ ones
        if not (mass.max() < _TOP and mass.min() > _LOW):
            d, s = _logits(w, some)
            mass = np.exp(d, out=d) @ ones
        each = share[at] / mass[:, None]
        d.reshape(-1)[hit[at]] -= mass
        g["out_all"] += np.multiply(s["y"], each, out=_room("y-each", s["y"].shape, kind)).T @ d
        dy = np.matmul(d, back["out"], out=_room("dy", (n, SIZE), kind))
        dy *= each
        dhidden = np.matmul(dy, back["down"], out=_room("dhidden", (n, HIDDEN), kind))
        dhidden *= np.greater(s["hidden"], 0, out=_room("active", dhidden.shape, np.dtype(bool)))
        g["down"] += s["hidden"].T @ dy
        g["up_all"] += s["h"].T @ dhidden
        dh = np.matmul(dhidden, back["up"], out=_room("dh", (n, SIZE), kind))
        dh += dy
        # What a score adds is its weight times (its value's part of the gradient - the mean of all such parts).
        dseen = _room("dseen", (windows, SPAN, SIZE + 1), kind)
        own = np.divide(dh.reshape(windows, SPAN, SIZE), s["mass"], out=dseen[..., :SIZE])
        parts = np.multiply(own, s["seen"], out=_room("parts", own.shape, kind))
        np.negative((parts.reshape(n, SIZE) @ units).reshape(windows, SPAN), out=dseen[..., SIZE])
        dscore = np.matmul(dseen, _across("v-across", s["v"], 1), out=_room("dscore", s["near"].shape, kind))
        dscore *= s["near"]
        dqkv = _room("dqkv", (n, 3 * SIZE), kind)
        dq, dk, dv = (dqkv.reshape(windows, SPAN, 3 * SIZE)[..., j : j + SIZE] for j in range(0, 3 * SIZE, SIZE))
        np.matmul(dscore, s["k"], out=dq)
        np.matmul(dscore.transpose(0, 2, 1), s["q"], out=dk)
        np.matmul(s["near"].transpose(0, 2, 1), own, out=dv)
        g["into"] += s["x"].T @ dqkv
        dx = np.matmul(dqkv, back["into"], out=dx_all[at])
        dx += dh
    into, up_all, out_all = (g.pop(name) for name in ("into", "up_all", "out_all"))
    g["q"], g["k"] = into[:, :SIZE] * kind.type(SIZE**-0.5), into[:, SIZE : 2 * SIZE]
    g["v"], g["mixed"] = into[:, 2 * SIZE :] @ w["mixed"].T, w["v"].T @ into[:, 2 * SIZE :]
    g["up"], g["up_bias"], g["out"], g["out_bias"] = up_all[:SIZE], up_all[SIZE], out_all[:SIZE], out_all[SIZE]
    g["place"] = dx_all.reshape(-1, SPAN, SIZE).sum(0)
    # Two columns at a time, as complex numbers: half as many additions by index.
    pairs = dx_all.view(np.result_type(kind, np.complex64)).T.astype(np.complex128, order="C")
    embed, at = np.zeros((len(pairs), len(w["embed"])), np.complex128), tokens.ravel()
    for into, pair in zip(embed, pairs):
        np.add.at(into, at, pair)
    g["embed"] = embed.T.copy().view(np.float64).astype(kind)
    return g


class Adam:
    """Gradient steps on one weight vector."""

    def __init__(self, vector: np.ndarray, inputs: int, classes: int, rate: float = 0.01):
        self.vector, self.inputs, self.classes, self.rate = vector.copy(), inputs, classes, rate
        self.mean, self.square, self.steps = np.zeros_like(vector), np.zeros_like(vector), 0

    def step(self, tokens: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> None:
        g = gradient(unpack(self.vector, self.inputs, self.classes), tokens, targets, counted)
        g = np.concatenate([g[name].ravel() for name in shapes(self.inputs, self.classes)])
        self.steps += 1
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.001 * (g * g - self.square)
        mean, square = self.mean / (1 - 0.9**self.steps), self.square / (1 - 0.999**self.steps)
        self.vector -= (self.rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)


def windows(sizes: np.ndarray, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over sequences laid end to end: (places, real, scored), a row per window.

    Every place of every sequence is scored in exactly one window; later windows begin with
    ``overlap`` places that are context only.
    """
    step = SPAN - overlap
    count = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - SPAN) // step)), 0)
    of = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    places = (begin[of] + number * step)[:, None] + np.arange(SPAN)
    real = places < begin[of + 1][:, None]
    scored = real & ((np.arange(SPAN) >= overlap) | (number == 0)[:, None])
    return np.minimum(places, max(0, begin[-1] - 1)), real, scored
