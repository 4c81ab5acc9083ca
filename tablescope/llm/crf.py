"""A linear-chain conditional random field of two tags over many sequences.

All sequences lie one after the other in flat arrays. Instead of stepping
through positions one by one, the flat array is cut into columns of equal
length; the 2 x 2 products of all columns advance together, and the columns
are then joined from first to last. The first position of a sequence forgets
what was before, so sequence borders need no special case.
"""

from __future__ import annotations

import numpy as np


class Chain:
    """Parameters: ``step[i, j]`` log weight of tag j after tag i, ``start[j]``
    of the first tag. Emissions are log odds of tag 1 against tag 0."""

    def __init__(self, step=None, start=None):
        self.step = np.zeros((2, 2)) if step is None else np.asarray(step, float)
        self.start = np.zeros(2) if start is None else np.asarray(start, float)


def columns(x: np.ndarray, rows: int, fill) -> np.ndarray:
    """A flat array as (rows, columns), column after column."""
    cols = -(-len(x) // rows)
    out = np.full(rows * cols, fill, x.dtype)
    out[: len(x)] = x
    return np.ascontiguousarray(out.reshape(cols, rows).T)


def height(n: int) -> int:
    return max(1, int(np.sqrt(n / 8)))


def marginals(odds: np.ndarray, first: np.ndarray, chain: Chain, pairs: bool = False):
    """P(tag 1) at each position by forward-backward; with ``pairs`` also the
    expected number of (i, j) steps and of first tags."""
    n = len(odds)
    if not n:
        return (odds, np.zeros((2, 2)), np.zeros(2)) if pairs else odds
    rows = height(n)
    # The padding behind the last position is a fresh start, which changes nothing.
    o, new = columns(np.clip(odds, -60, 60), rows, 0.0), columns(first, rows, True)
    e = np.exp(-np.maximum(o, 0)), np.exp(np.minimum(o, 0))
    step, start = np.exp(chain.step - chain.step.max()), np.exp(chain.start - chain.start.max())
    # m[i][j]: weight of tag j here after tag i; each a (rows, columns) array.
    m = [[np.where(new, start[j], step[i, j]) * e[j] for j in (0, 1)] for i in (0, 1)]
    cols = o.shape[1]
    ahead = np.empty((4, rows, cols))
    p = [m[0][0][0], m[0][1][0], m[1][0][0], m[1][1][0]]
    for t in range(rows):
        if t:
            a, b, c, d = m[0][0][t], m[0][1][t], m[1][0][t], m[1][1][t]
            p = [p[0] * a + p[1] * c, p[0] * b + p[1] * d, p[2] * a + p[3] * c, p[2] * b + p[3] * d]
        scale = 1 / (p[0] + p[1] + p[2] + p[3])
        p = [x * scale for x in p]
        for k in range(4):
            ahead[k, t] = p[k]
    enter = np.empty((2, cols))
    v, w = 0.5, 0.5
    for c, (a, b, x, y) in enumerate(ahead[:, -1].T.tolist()):
        enter[0, c], enter[1, c] = v, w
        v, w = v * a + w * x, v * b + w * y
        v, w = v / (v + w), w / (v + w)
    alpha = [enter[0] * ahead[0] + enter[1] * ahead[2], enter[0] * ahead[1] + enter[1] * ahead[3]]
    # Backward: the product of what follows inside the column, then the column behind.
    behind = ahead
    q = [np.ones(cols), np.zeros(cols), np.zeros(cols), np.ones(cols)]
    for t in range(rows - 1, -1, -1):
        for k in range(4):
            behind[k, t] = q[k]
        a, b, c, d = m[0][0][t], m[0][1][t], m[1][0][t], m[1][1][t]
        q = [a * q[0] + b * q[2], a * q[1] + b * q[3], c * q[0] + d * q[2], c * q[1] + d * q[3]]
        scale = 1 / (q[0] + q[1] + q[2] + q[3])
        q = [x * scale for x in q]
    leave = np.empty((2, cols))
    v, w = 0.5, 0.5
    for c, (a, b, x, y) in reversed(list(enumerate(zip(*(x.tolist() for x in q))))):
        leave[0, c], leave[1, c] = v, w
        v, w = a * v + b * w, x * v + y * w
        v, w = v / (v + w), w / (v + w)
    beta = [behind[0] * leave[0] + behind[1] * leave[1], behind[2] * leave[0] + behind[3] * leave[1]]
    flat = lambda x: x.T.reshape(-1)[:n]
    joint = alpha[0] * beta[0], alpha[1] * beta[1]
    one = flat(joint[1] / (joint[0] + joint[1]))
    if not pairs:
        return one
    al, be, e = [flat(x) for x in alpha], [flat(x) for x in beta], [flat(x) for x in e]
    inner = np.flatnonzero(~first)
    xi = [[al[i][inner - 1] * step[i, j] * e[j][inner] * be[j][inner] for j in (0, 1)] for i in (0, 1)]
    total = xi[0][0] + xi[0][1] + xi[1][0] + xi[1][1]
    p1 = one[first].sum()
    return one, np.array([[(xi[i][j] / total).sum() for j in (0, 1)] for i in (0, 1)]), np.array([first.sum() - p1, p1])


def blocks(first: np.ndarray, size: int = 1 << 17) -> list[tuple[int, int]]:
    """Ranges of whole sequences of about ``size`` positions, or one longer sequence."""
    starts = np.flatnonzero(first)
    cuts = starts[np.r_[True, np.diff(starts // size) > 0]] if len(starts) else starts
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(first)]))


def viterbi(odds: np.ndarray, first: np.ndarray, chain: Chain) -> np.ndarray:
    """The best tag sequence of each sequence; of equal ones the smaller tag."""
    n = len(odds)
    if not n:
        return np.zeros(0, np.int8)
    rows = height(n)
    o, new = columns(odds.astype(float), rows, 0.0), columns(first, rows, True)
    m = [[np.where(new, chain.start[j], chain.step[i, j]) + j * o for j in (0, 1)] for i in (0, 1)]
    cols = o.shape[1]
    ahead = np.empty((4, rows, cols))
    p = [m[0][0][0], m[0][1][0], m[1][0][0], m[1][1][0]]
    for t in range(rows):
        if t:
            a, b, c, d = m[0][0][t], m[0][1][t], m[1][0][t], m[1][1][t]
            p = [np.maximum(p[0] + a, p[1] + c), np.maximum(p[0] + b, p[1] + d), np.maximum(p[2] + a, p[3] + c), np.maximum(p[2] + b, p[3] + d)]
        top = np.maximum(np.maximum(p[0], p[1]), np.maximum(p[2], p[3]))
        p = [x - top for x in p]
        for k in range(4):
            ahead[k, t] = p[k]
    enter = np.empty((2, cols))
    v, w = 0.0, 0.0
    for c, (a, b, x, y) in enumerate(ahead[:, -1].T.tolist()):
        enter[0, c], enter[1, c] = v, w
        v, w = max(v + a, w + x), max(v + b, w + y)
        v, w = v - max(v, w), w - max(v, w)
    flat = lambda x: x.T.reshape(-1)
    best = [flat(np.maximum(enter[0] + ahead[0], enter[1] + ahead[2])), flat(np.maximum(enter[0] + ahead[1], enter[1] + ahead[3]))]
    before = [np.r_[x[:1], x[:-1]] for x in best]
    # prev[j]: the tag before tag j; the last tag of a sequence is free.
    prev = [columns((before[1] + flat(m[1][j]) > before[0] + flat(m[0][j])).astype(np.int8), rows, 0) for j in (0, 1)]
    free = columns((best[1] > best[0]).astype(np.int8), rows, 0)
    last = columns(np.r_[first[1:], np.ones(rows * cols - n + 1, bool)], rows, True)
    # For both tags that a column may end with, walk all columns back together.
    tag = np.empty((2, rows, cols), np.int8)
    state = [np.zeros(cols, np.int8), np.ones(cols, np.int8)]
    for t in range(rows - 1, -1, -1):
        for k in (0, 1):
            state[k] = np.where(last[t], free[t], state[k])
            tag[k, t] = state[k]
            state[k] = np.where(state[k], prev[1][t], prev[0][t])
    ends, end = np.empty(cols, np.int64), 0
    for c in range(cols - 1, -1, -1):
        ends[c] = end
        end = int(state[end][c])
    return flat(np.where(ends, tag[1], tag[0]))[:n]


def train(rows: np.ndarray, cols: np.ndarray, token: np.ndarray, first: np.ndarray, tags: np.ndarray, n_items: int, n_features: int, rounds: int = 40, rate: float = 0.3, ridge: float = 2.0, weight: np.ndarray | None = None) -> tuple[np.ndarray, float, Chain]:
    """(feature weights, bias, chain) that fit ``tags`` (0 or 1, one per
    position). Item ``rows[k]`` has feature ``cols[k]``; position t shows item
    ``token[t]``. Adam steps on the log likelihood with a quadratic penalty."""
    chain = Chain()
    theta = np.zeros(n_features + 1 + 4 + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.flatnonzero(~first)
    seen = np.bincount(2 * tags[inner - 1] + tags[inner], minlength=4).astype(float)
    seen_first = np.bincount(tags[first], minlength=2).astype(float)
    for k in range(1, rounds + 1):
        w, bias = theta[:n_features], theta[n_features]
        chain = Chain(theta[n_features + 1 : n_features + 5].reshape(2, 2), theta[n_features + 5 :])
        odds = (np.bincount(rows, weights=w[cols], minlength=n_items) + bias)[token]
        parts = [marginals(odds[a:b], first[a:b], chain, pairs=True) for a, b in blocks(first)]
        one, steps, starts = np.concatenate([p[0] for p in parts]), sum(p[1] for p in parts), sum(p[2] for p in parts)
        gap = tags - one
        by_item = np.bincount(token, weights=gap, minlength=n_items)
        g = np.r_[np.bincount(cols, weights=by_item[rows], minlength=n_features), gap.sum(), seen - steps.ravel(), seen_first - starts] - ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return theta[:n_features], float(theta[n_features]), Chain(theta[n_features + 1 : n_features + 5].reshape(2, 2), theta[n_features + 5 :])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights, the last one the constant, of a logistic regression by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - ridge * w * np.r_[np.ones(len(w) - 1), 0]
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.diag(np.r_[np.ones(len(w) - 1), 1e-6])
        w = w + np.linalg.solve(h, g)
    return w
