"""Recurrent layers in numpy, forward and backward, over batches of sequences (time, batch, width).

Masked steps (past a sequence's end) hand the state on unchanged, so both directions of a layer
read each sequence from its own first or last step.
"""

from __future__ import annotations

import numpy as np

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    """By tanh, which does not overflow."""
    out = np.tanh(x * F32(0.5))
    out *= F32(0.5)
    out += F32(0.5)
    return out


def _uniform(rng: np.random.Generator, rows: int, columns: int) -> np.ndarray:
    return rng.uniform(-1, 1, (rows, columns)).astype(F32) * F32((6.0 / (rows + columns)) ** 0.5)


def lstm_weights(rng: np.random.Generator, width: int, hidden: int) -> dict[str, np.ndarray]:
    b = np.zeros(4 * hidden, F32)
    b[hidden : 2 * hidden] = 1  # at first it forgets little
    return {"x": _uniform(rng, width, 4 * hidden), "h": _uniform(rng, hidden, 4 * hidden), "b": b}


def lstm(w: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, reverse: bool) -> tuple[np.ndarray, tuple]:
    """States (time, batch, hidden) and what the backward pass needs. Gates: in, forget, out, new."""
    steps, batch, _ = x.shape
    n = w["h"].shape[0]
    at_x = x @ w["x"] + w["b"]
    h, c = np.zeros((batch, n), F32), np.zeros((batch, n), F32)
    out = np.empty((steps, batch, n), F32)
    trace = []
    for t in reversed(range(steps)) if reverse else range(steps):
        z = at_x[t] + h @ w["h"]
        gates = sigmoid(z[:, : 3 * n])
        new = np.tanh(z[:, 3 * n :])
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        m = mask[t][:, None]
        before = c
        c = np.where(m, f * c + i * new, c)
        tc = np.tanh(c)
        last = h
        h = np.where(m, o * tc, h)
        out[t] = h
        trace.append((t, i, f, o, new, before, tc, last, m))
    return out, (x, trace)


def lstm_back(w: dict[str, np.ndarray], saved: tuple, grad: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    x, trace = saved
    n = w["h"].shape[0]
    dw = {k: np.zeros_like(v) for k, v in w.items()}
    dx = np.zeros_like(x)
    dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t, i, f, o, new, before, tc, last, m in reversed(trace):
        dh = dh + grad[t]
        dhm = np.where(m, dh, 0)
        dcm = np.where(m, dc, 0) + dhm * o * (1 - tc * tc)
        dz = np.concatenate((dcm * new * i * (1 - i), dcm * before * f * (1 - f), dhm * tc * o * (1 - o), dcm * i * (1 - new * new)), axis=1)
        dw["x"] += x[t].T @ dz
        dw["h"] += last.T @ dz
        dw["b"] += dz.sum(0)
        dx[t] = dz @ w["x"].T
        dh = np.where(m, dz @ w["h"].T, dh)
        dc = np.where(m, dcm * f, dc)
    return dw, dx


def gru_weights(rng: np.random.Generator, width: int, hidden: int) -> dict[str, np.ndarray]:
    return {
        "x": _uniform(rng, width, 3 * hidden),
        "h": _uniform(rng, hidden, 3 * hidden),
        "b": np.zeros(3 * hidden, F32),
    }


def gru(w: dict[str, np.ndarray], at_x: np.ndarray, mask: np.ndarray, reverse: bool, keep: bool = False) -> tuple[np.ndarray, list]:
    """States from inputs that already went through `x` and `b`. Gates: reset, update, new."""
    steps, batch, _ = at_x.shape
    n = w["h"].shape[0]
    h = np.zeros((batch, n), F32)
    out = np.empty((steps, batch, n), F32)
    trace = []
    for t in reversed(range(steps)) if reverse else range(steps):
        zh = h @ w["h"]
        gates = sigmoid(at_x[t, :, : 2 * n] + zh[:, : 2 * n])
        r, u = gates[:, :n], gates[:, n:]
        new = np.tanh(at_x[t, :, 2 * n :] + r * zh[:, 2 * n :])
        m = mask[t][:, None]
        last = h
        h = np.where(m, new + u * (h - new), h)
        out[t] = h
        if keep:
            trace.append((t, r, u, new, last, zh[:, 2 * n :], m))
    return out, trace


def gru_back(w: dict[str, np.ndarray], trace: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the recurrent weights and of the inputs (after `x` and `b`)."""
    n = w["h"].shape[0]
    dwh = np.zeros_like(w["h"])
    dx = np.zeros((*grad.shape[:2], 3 * n), F32)
    dh = np.zeros_like(grad[0])
    for t, r, u, new, last, zn, m in reversed(trace):
        dh = dh + grad[t]
        dhm = np.where(m, dh, 0)
        dn = dhm * (1 - u) * (1 - new * new)
        du = dhm * (last - new) * u * (1 - u)
        dr = dn * zn * r * (1 - r)
        dx[t] = np.concatenate((dr, du, dn), axis=1)
        dz = np.concatenate((dr, du, dn * r), axis=1)
        dwh += last.T @ dz
        dh = np.where(m, dhm * u + dz @ w["h"].T, dh)
    return dwh, dx


class Adam:
    """Steps of Adam on a dictionary of weights, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float) -> None:
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += F32(0.1) * (g - self.m[k])
            self.v[k] += F32(0.001) * (g * g - self.v[k])
            self.weights[k] -= F32(rate) * self.m[k] / (np.sqrt(self.v[k]) + F32(1e-6))
