"""Eigenvectors of a symmetric matrix: single-precision ones, refined by matrix products in double precision.

The refinement is Ogita and Aishima's. With approximate eigenvectors X of A, the products R = I - X'X and S = X'AX give
eigenvalues and a correction X + XE whose error is the square of the former one. It cannot tell eigenvectors apart
whose eigenvalues lie closer than the error of S; those are a cluster, whose small projected matrix, less the cluster's
mean, is solved again by the same means. Its own single-precision solution resolves differences that the whole
matrix hides.
"""

from __future__ import annotations

import numpy as np

MAX_STEPS = 12
#: Sub-solves within sub-solves; what three of them do not tell apart is equal in double precision.
MAX_DEPTH = 3


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Indices of values that neighbours no further than ``width`` connect, if there are two or more."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One refinement: new vectors, eigenvalues, the width of clusters, and the size of the correction."""
    r = np.eye(len(x.T)) - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    width = 2 * (np.linalg.norm(s - np.diag(values), 2) + np.linalg.norm(a, 2) * np.linalg.norm(r, 2))
    gaps = values[None, :] - values[:, None]
    near = np.abs(gaps) <= width
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gaps))
    return x + x @ e, values, width, float(np.abs(e).max())


def eigenvectors(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Vectors of equal eigenvalues are some orthonormal basis of their space. The largest entry of each
    vector by size is positive. A matrix of zeros gives unit vectors.
    """
    a = (a + a.T) / 2
    size = len(a)
    scale = float(np.abs(a).max()) if size else 0.0
    if scale == 0:
        return np.zeros(size), np.eye(size)
    b = a / scale
    x = np.linalg.eigh(b.astype(np.float32))[1].astype(np.float64)
    last = np.inf
    for _ in range(MAX_STEPS):
        x, values, width, change = _step(b, x)
        clusters = _clusters(values, width)
        if depth < MAX_DEPTH:
            for part in clusters:
                inside = x[:, part].T @ (b - values[part].mean() * np.eye(size)) @ x[:, part]
                if np.abs(inside).max() > size * np.finfo(float).eps:
                    x[:, part] = x[:, part] @ eigenvectors(inside, depth + 1)[1]
        if change < 1e-15 or (change >= last and change < 1e-12):
            break
        last = change
    x = x + x @ (np.eye(size) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, b @ x) * scale
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(size)])
    return values[order], x * np.where(signs == 0, 1, signs)
