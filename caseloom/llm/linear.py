"""Small linear models in numpy, fitted on the driver on bounded samples."""

from __future__ import annotations

import numpy as np


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 15, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge loss) by dual coordinate descent; y is +-1."""
    rnd = np.random.default_rng(seed)
    n, d = x.shape
    w, b = np.zeros(d, np.float64), 0.0
    alpha = np.zeros(n)
    diag = (x.astype(np.float64) ** 2).sum(axis=1) + 1.0 + 0.5 / c
    for _ in range(epochs):
        moved = 0.0
        for i in rnd.permutation(n):
            g = y[i] * (x[i] @ w + b) - 1.0 + alpha[i] * 0.5 / c
            new = max(alpha[i] - g / diag[i], 0.0)
            if (step := new - alpha[i]) != 0.0:
                alpha[i] = new
                w += step * y[i] * x[i]
                b += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w.astype(np.float32), float(b)


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25, weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression by Newton steps; x without a constant, y is 0 or 1. Returns weights, the bias last and unpenalised."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    weight = np.ones(len(x)) if weight is None else weight
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    loss = np.inf
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x.T * (weight * p * (1 - p))) @ x + np.diag(ridge + 1e-9)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-4:
            z = x @ (new := w - size * step)
            now = float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ new**2)
            if now <= loss:
                break
            size /= 2
        if size <= 1e-4 or loss - now < 1e-9 * max(1.0, abs(now)):
            break
        w, loss = new, now
    return w


def logistic_sparse(row: np.ndarray, col: np.ndarray, val: np.ndarray, width: int, y: np.ndarray, l2: float = 1.0, steps: int = 25, weight: np.ndarray | None = None) -> np.ndarray:
    """As logistic(), of the values val at (row, col) and 0 elsewhere; Newton's equations are solved by conjugate gradients, so no matrix is formed."""
    n = len(y)
    row, col, val = np.append(row, np.arange(n)), np.append(col, np.full(n, width)), np.append(val, np.ones(n))
    weight = np.ones(n) if weight is None else weight
    ridge = np.full(width + 1, l2)
    ridge[-1] = 1e-6
    times = lambda w: np.bincount(row, val * w[col], minlength=n)
    back = lambda r: np.bincount(col, val * r[row], minlength=width + 1)
    w = np.zeros(width + 1)
    loss = np.inf
    for _ in range(steps):
        p = sigmoid(times(w))
        grad, h = back(weight * (p - y)) + ridge * w, weight * p * (1 - p)
        scale = 1 / (np.bincount(col, val * val * h[row], minlength=width + 1) + ridge + 1e-9)
        step, rest = np.zeros(width + 1), grad
        to = scale * rest
        rz = rest @ to
        enough = 1e-6 * rz
        for _ in range(500):
            if rz <= enough:
                break
            bent = back(h * times(to)) + (ridge + 1e-9) * to
            a = rz / (to @ bent)
            step, rest = step + a * to, rest - a * bent
            near = scale * rest
            rz, was = rest @ near, rz
            to = near + rz / was * to
        size = 1.0
        while size > 1e-4:
            z = times(new := w - size * step)
            now = float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * ridge @ new**2)
            if now <= loss:
                break
            size /= 2
        if size <= 1e-4 or loss - now < 1e-9 * max(1.0, abs(now)):
            break
        w, loss = new, now
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(z, np.float64)))
