"""A gated recurrent language model in numpy with a class-factored softmax.

A token belongs to a class, and some classes have members: its probability is that of the class
times, there, that of the member. Inputs are looked up, so a step costs one small product. Gates and
new states saturate by x / (1 + |x|), which costs a fraction of a hyperbolic tangent. The parts of a
step lie one after another, not side by side, so each is worked on as one run of memory. Large
products are done in slices too small for a linear algebra library to start threads for, as the cores
of an executor are taken by other tasks.
"""

import numpy as np

Params = dict[str, np.ndarray]


def start(class_odds: np.ndarray, member_odds: np.ndarray, inputs: int, hidden: int) -> Params:
    """Parameters with which every state gives the classes and members these log probabilities."""
    draw = np.random.default_rng(7)
    groups, members = member_odds.shape
    small = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "look": small(inputs, 3 * hidden),
        "gates": small(hidden, 2 * hidden),
        "fresh": small(hidden, hidden),
        "classes": np.zeros((hidden, len(class_odds)), np.float32),
        "class_odds": class_odds.astype(np.float32),
        "members": np.zeros((groups, members, hidden), np.float32),
        "member_odds": member_odds.astype(np.float32),
    }


def to_vector(params: Params) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)])


def from_vector(vector: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size
        out[k] = vector[at : at + size].reshape(like[k].shape).astype(np.float32)
        at += size
    return out


_PRODUCT = 1 << 18
_ROWS = 2048


def _saturate(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place. With y for the result, its slope is (1 - |y|) ** 2."""
    below = np.abs(x)
    below += 1
    x /= below
    return x


def _slice(one: int, other: int) -> int:
    """How many rows of so many columns a product may take."""
    return min(128, max(16, (_PRODUCT - 1) // (one * other) // 16 * 16))


def _times(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The product of many rows with a matrix, or with each of several."""
    one, other = weights.shape[-2:]
    if len(rows) * one * other < _PRODUCT:
        return np.matmul(rows, weights)
    size = _slice(one, other)
    whole = len(rows) // size * size
    out = np.empty((*weights.shape[:-2], len(rows), other), rows.dtype)
    sliced = out[..., :whole, :].reshape(*weights.shape[:-2], -1, size, other, copy=False)
    np.matmul(rows[:whole].reshape(-1, size, one), weights[..., None, :, :], out=sliced)
    if whole < len(rows):
        np.matmul(rows[whole:], weights, out=out[..., whole:, :])
    return out


def _across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of the transpose of many rows with as many others."""
    one, other = a.shape[1], b.shape[1]
    if len(a) * one * other < _PRODUCT:
        return a.T @ b
    size = _slice(one, other)
    whole = len(a) // size * size
    left = a[:whole].reshape(-1, size, one).transpose(0, 2, 1)
    out = np.matmul(left, b[:whole].reshape(-1, size, other)).sum(0)
    if whole < len(a):
        out += a[whole:].T @ b[whole:]
    return out


def _apart(weights: np.ndarray, hidden: int) -> np.ndarray:
    """Matrices of ``hidden`` columns that stand side by side, one after another."""
    return np.ascontiguousarray(weights.reshape(len(weights), -1, hidden).transpose(1, 0, 2))


def run(params: Params, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, back: bool = True):
    """States after each step of ``inputs`` (steps x lanes) and, for ``back``, what going back needs.

    Where ``fresh`` is set a text begins, and the state before that step is 0.
    """
    hidden = state.shape[1]
    gates, inner = _apart(params["gates"], hidden), params["fresh"]
    parts = inputs * 3 + np.arange(3)[:, None, None]
    looked = np.take(params["look"].reshape(-1, hidden), parts, axis=0)
    states = np.empty((len(inputs), *state.shape), looked.dtype)
    any_fresh = fresh.any(1).tolist()
    trail = []
    for t in range(len(inputs)):
        if any_fresh[t]:
            state = state.copy()
            state[np.flatnonzero(fresh[t])] = 0
        both = _times(state, gates)
        both += looked[:2, t]
        _saturate(both)
        both += 1
        both *= 0.5
        update, reset = both
        held = reset * state
        new = _times(held, inner)
        new += looked[2, t]
        _saturate(new)
        if back:
            trail.append((state, both, held, new))
        step = new - state
        step *= update
        state = np.add(state, step, out=states[t])
    return states, trail


def _with_one(states: np.ndarray) -> np.ndarray:
    """States with a last column of ones, which odds of their own are multiplied with."""
    out = np.ones((len(states), states.shape[1] + 1), states.dtype)
    out[:, :-1] = states
    return out


def _steep(weights: np.ndarray) -> bool:
    """Whether, states being within -1 and 1, an exponential could be too large or too small."""
    return bool(np.abs(weights).sum(-2).max() > 60)


def _softmax(states: np.ndarray, weights: np.ndarray, picks: np.ndarray, steep: bool):
    """The exponentials of all odds, their sums by row, the log probability of what is picked, and
    where that lies among the exponentials.

    Only if the odds are ``steep`` are rows shifted by their maximum.
    """
    odds = _times(states, weights)
    if steep:
        odds -= odds.max(1, keepdims=True)
    at = np.arange(0, odds.size, odds.shape[1]) + picks
    own = odds.ravel()[at]
    np.exp(odds, out=odds)
    sums = np.einsum("ij->i", odds)
    return odds, sums, own - np.log(sums), at


def _weights(params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes, and of the members group by group, with their odds in a last row."""
    classes = np.vstack([params["classes"], params["class_odds"]])
    members = params["members"].transpose(0, 2, 1)
    return classes, np.concatenate([members, params["member_odds"][:, None]], 1)


def _blocks(first: int, last: int) -> list[slice]:
    """Ranges of rows whose odds stay in a core's own cache."""
    return [slice(at, min(at + _ROWS, last)) for at in range(first, last, _ROWS)]


def _by_group(params: Params, member: np.ndarray):
    """Places of what has a member, group by group, and for groups that occur, ranges they have
    there and their members; -1 is none."""
    groups, size = params["members"].shape[:2]
    group = np.where(member >= 0, member // size, -1).astype(np.int16)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    order = order[edges[0] :]
    edges = (edges - edges[0]).tolist()
    place = member[order] % size
    parts = [(g, part) for g in range(groups) for part in _blocks(edges[g], edges[g + 1])]
    return order, [(g, part, place[part]) for g, part in parts]


def log_chances(params: Params, states: np.ndarray, kinds: np.ndarray, member: np.ndarray):
    """For each state the log probability of what ``kinds`` and ``member`` name, and that of the
    last class.

    ``member`` is the number of the member, class by class, or -1 for a class without any.
    """
    states = _with_one(states)
    classes, members = _weights(params)
    own, last = np.empty(len(states), states.dtype), np.empty(len(states), states.dtype)
    steep = _steep(classes)
    for part in _blocks(0, len(states)):
        every, sums, own[part], _ = _softmax(states[part], classes, kinds[part], steep)
        last[part] = np.log(every[:, -1] / sums)
    order, groups = _by_group(params, member)
    states, steep = states[order], _steep(members)
    within = np.empty(len(order), own.dtype)
    for g, part, place in groups:
        within[part] = _softmax(states[part], members[g], place, steep)[2]
    own[order] += within
    return own, last


def _softmax_back(states, weights, picks, steep):
    """The summed log probability of what is picked, and the gradients of its negative by the
    transposed weights and by the states."""
    back, sums, own, at = _softmax(states, weights, picks, steep)
    back.ravel()[at] -= sums
    sums = (1 / sums)[:, None]
    by_state = _times(back, np.ascontiguousarray(weights[:-1].T))
    by_state *= sums
    return own.sum(), _across(back, states * sums), by_state


def _gate_slope(gate: np.ndarray) -> np.ndarray:
    """The slope of a gate 0.5 + 0.5 y by what is in y: 0.5 (1 - |2 gate - 1|) ** 2."""
    slope = gate - 0.5
    np.abs(slope, out=slope)
    slope -= 0.5
    slope *= slope
    slope *= 2
    return slope


def _sums(rows: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Sums of the rows of each of ``count`` ids: many rows of one id at once, of few rows the
    first of each id, then the second of each, and so on."""
    order = np.argsort(ids.astype(np.int16 if count < 1 << 15 else np.int32), kind="stable")
    ids, rows = ids[order], rows[order]
    edges = np.flatnonzero(np.diff(ids, prepend=-1))
    size = np.diff(edges, append=len(order))
    sums = rows[edges]
    for i in np.flatnonzero(size > 16).tolist():
        np.add.reduce(rows[edges[i] : edges[i] + size[i]], 0, out=sums[i])
    few = np.flatnonzero(size <= 16)
    for k in range(1, 16):
        few = few[size[few] > k]
        sums[few] += rows[edges[few] + k]
    out = np.zeros((count, rows.shape[1]), rows.dtype)
    out[ids[edges]] = sums
    return out


def gradients(params, inputs, fresh, state, kinds, member):
    """Gradients of the mean negative log probability over a window, its last state, and the mean.

    ``kinds`` and ``member`` are the classes and members to be predicted, steps x lanes. The state
    comes from the window before; gradients end at the window's start.
    """
    states, trail = run(params, inputs, fresh, state)
    steps, lanes, hidden = states.shape
    kind, member = kinds.ravel(), member.ravel()
    flat = _with_one(states.reshape(-1, hidden))
    n = len(flat)
    out = {k: np.zeros_like(params[k]) for k in ("members", "member_odds")}
    classes, members = _weights(params)
    d_states = np.empty((n, hidden), flat.dtype)
    total, both, steep = 0.0, 0, _steep(classes)
    for part in _blocks(0, n):
        own, by_weight, d_states[part] = _softmax_back(flat[part], classes, kind[part], steep)
        total += own
        both += by_weight
    out["classes"], out["class_odds"] = both[:, :-1].T / n, both[:, -1] / n
    order, groups = _by_group(params, member)
    ordered, steep = flat[order], _steep(members)
    d_ordered = np.empty((len(order), hidden), flat.dtype)
    for g, part, place in groups:
        own, both, d_ordered[part] = _softmax_back(ordered[part], members[g], place, steep)
        total += own
        out["members"][g] += both[:, :-1]
        out["member_odds"][g] += both[:, -1]
    out["members"] /= n
    out["member_odds"] /= n
    d_states[order] += d_ordered
    d_states /= n
    d_states = d_states.reshape(steps, lanes, hidden)
    d_next = np.zeros((lanes, hidden), flat.dtype)
    d_look = np.empty((steps, lanes, 3 * hidden), flat.dtype)
    d_gates, d_fresh = (np.zeros((hidden, k * hidden), flat.dtype) for k in (2, 1))
    inner, gates = (np.ascontiguousarray(params[k].T) for k in ("fresh", "gates"))
    slope = np.empty((lanes, hidden), flat.dtype)
    for t in range(steps - 1, -1, -1):
        before, gated, held, new = trail[t]
        update, reset = gated
        d = d_states[t]
        d += d_next
        d_new = d * update
        d_next = d - d_new
        np.abs(new, out=slope)
        np.subtract(1, slope, out=slope)
        slope *= slope
        new -= before
        new *= d
        d_new *= slope
        d_held = _times(d_new, inner)
        gate_slope = _gate_slope(gated)
        now = d_look[t]
        np.multiply(new, gate_slope[0], out=now[:, :hidden])
        np.multiply(d_held, before, out=new)
        np.multiply(new, gate_slope[1], out=now[:, hidden : 2 * hidden])
        now[:, 2 * hidden :] = d_new
        d_held *= reset
        d_next += d_held
        of_gates = now[:, : 2 * hidden]
        d_next += _times(of_gates, gates)
        d_gates += _across(before, of_gates)
        d_fresh += _across(held, d_new)
        d_next[np.flatnonzero(fresh[t])] = 0
    out["gates"], out["fresh"] = d_gates, d_fresh
    rows = d_look.reshape(-1, 3 * hidden)
    out["look"] = _sums(rows, inputs.ravel(), len(params["look"]))
    return out, states[-1], -total / n


class Adam:
    """Steps with rates adapted to each parameter. Gradients are used up."""

    def __init__(self, params: Params, rate: float):
        self._rate, self._step = rate, 0
        self._first = {k: np.zeros_like(v) for k, v in params.items()}
        self._second = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params: Params, gradient: Params) -> None:
        self._step += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in gradient.values()))
        scale = float(min(1.0, 1.0 / max(size, 1e-12)))
        rate = self._rate * float(np.sqrt(1 - 0.99**self._step)) / (1 - 0.9**self._step)
        for k, p in params.items():
            g, first, second = gradient[k], self._first[k], self._second[k]
            g *= scale
            change = g - first
            change *= 0.1
            first += change
            g *= g
            g -= second
            g *= 0.01
            second += g
            np.sqrt(second, out=change)
            change += 1e-6
            np.divide(first, change, out=change)
            change *= rate
            p -= change
