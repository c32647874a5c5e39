"""Minimisation of smooth functions whose values and gradients may come from Spark jobs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def lbfgs(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 60, memory: int = 8, tol: float = 1e-5) -> np.ndarray:
    """Limited-memory BFGS with a backtracking line search; ``f`` gives value and gradient."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(grad).max(initial=0.0) <= tol:
            break
        direction = -_apply_inverse(past, grad)
        slope = grad @ direction
        if slope >= 0:
            past, direction, slope = [], -grad, -(grad @ grad)
        step = 1.0 if past else min(1.0, 1.0 / np.abs(grad).sum())
        for _ in range(30):
            there = x + step * direction
            new_value, new_grad = f(there)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        moved, turned = there - x, new_grad - grad
        if moved @ turned > 1e-12:
            past = [*past, (moved, turned)][-memory:]
        x, value, grad = there, new_value, new_grad
    return x


def _apply_inverse(past: list[tuple[np.ndarray, np.ndarray]], grad: np.ndarray) -> np.ndarray:
    """The inverse Hessian estimate of the last moves, applied to a gradient (two-loop recursion)."""
    d = grad.copy()
    shares = []
    for s, y in reversed(past):
        shares.append(s @ d / (s @ y))
        d -= shares[-1] * y
    if past:
        s, y = past[-1]
        d *= s @ y / (y @ y)
    for (s, y), a in zip(past, reversed(shares)):
        d += s * (a - y @ d / (s @ y))
    return d
