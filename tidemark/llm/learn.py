"""Small models fitted on the driver from a bounded sample: L-BFGS, logistic regression, calibration."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import cache

import numpy as np


@cache
def _allocator() -> ctypes.CDLL | None:
    try:
        found = ctypes.CDLL(None)
        found.malloc_trim
    except (OSError, AttributeError, TypeError):  # another C library than glibc
        return None
    return found


def give_back() -> None:
    """Returns freed memory to the system: glibc keeps what large arrays have left, in workers that live on."""
    if (library := _allocator()) is not None:
        library.malloc_trim(0)


def lbfgs(
    f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 100, memory: int = 8
) -> np.ndarray:
    """Minimises f, which returns value and gradient, by limited-memory BFGS with backtracking."""
    value, grad = f(x)
    ss: list[np.ndarray] = []
    ys: list[np.ndarray] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y in zip(reversed(ss), reversed(ys), strict=True):
            a = s @ q / (s @ y)
            alphas.append(a)
            q -= a * y
        if ss:
            q *= ss[-1] @ ys[-1] / (ys[-1] @ ys[-1])
        for (s, y), a in zip(zip(ss, ys, strict=True), reversed(alphas), strict=True):
            q += (a - y @ q / (s @ y)) * s
        slope = -(grad @ q)
        if slope >= 0:
            q, slope = grad, -(grad @ grad)
        if -slope < 1e-10:
            break
        t = 1.0 if ss else min(1.0, 1.0 / max(1e-12, float(np.abs(grad).sum())))
        for _ in range(30):
            new_value, new_grad = f(x - t * q)
            if new_value <= value + 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = -t * q, new_grad - grad
        if s @ y > 1e-12:
            ss, ys = [*ss, s][-memory:], [*ys, y][-memory:]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, grad = x - t * q, new_value, new_grad
        if done:
            break
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


CHUNK = 256


def logistic(samples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, ridge: float) -> np.ndarray:
    """Weights (the last is the bias) of a logistic regression on sparse rows (columns, values); y is 0 or 1.

    Works through the rows in chunks, so that what it needs beside the rows stays small.
    """
    chunks = []
    for a in range(0, len(samples), CHUNK):
        part = samples[a : a + CHUNK]
        owner = np.repeat(np.arange(len(part), dtype=np.int32), [len(c) for c, _ in part])
        chunks.append((owner, np.concatenate([c for c, _ in part]), np.concatenate([v for _, v in part]), y[a : a + CHUNK]))
    n = len(y)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        value, grad = 0.5 * ridge * float(w[:-1] @ w[:-1]), np.append(ridge * w[:-1], 0.0)
        for owner, columns, values, target in chunks:
            z = np.bincount(owner, values * w[columns], len(target)) + w[-1]
            error = (sigmoid(z) - target) / n
            value += float((np.logaddexp(0, z) - target * z).sum()) / n
            grad[:-1] += np.bincount(columns, values * error[owner], width)
            grad[-1] += error.sum()
        return value, grad

    return lbfgs(loss, np.zeros(width + 1))


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) such that sigmoid(a * z + b) is the chance of y = 1, with softened targets."""
    up, down = y.sum(), (1 - y).sum()
    soft = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        u = p[0] * z + p[1]
        error = sigmoid(u) - soft
        return float((np.logaddexp(0, u) - soft * u).sum()), np.array([(error * z).sum(), error.sum()])

    a, b = lbfgs(loss, np.array([1.0, 0.0]))
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)
