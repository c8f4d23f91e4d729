"""Eigenvectors of a symmetric matrix by polar decompositions (QDWH) and spectral divide-and-conquer.

The orthogonal polar factor of A - s I maps eigenvectors above the shift s to themselves and
those below to their negatives.  Half of its sum with the identity is hence the projector on
the invariant subspace above s.  Both subspaces are split again, until a block is one number or a multiple of the identity.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a square matrix by the dynamically weighted Halley iteration.

    Weights follow a lower bound of the smallest singular value; every step is a QR
    decomposition of the scaled iterate over the identity, which needs no inverse.
    """
    n = len(matrix)
    bound = np.linalg.norm(matrix)
    if not bound:
        return np.eye(n)
    x = matrix / bound
    try:
        inverse = np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        inverse = np.inf
    low = min(max(1.0 / inverse if np.isfinite(inverse) else 0.0, _EPS), 1.0)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        a = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0)) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))
        following = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        change = np.linalg.norm(following - x)
        x = following
        low = min(low * (a + b * square) / (1 + c * square), 1.0)
        if change < np.cbrt(5 * _EPS) and abs(1 - low) < 10 * _EPS:
            break
    return x


def _split(block: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None for a multiple of the identity."""
    n = len(block)
    diagonal = np.diag(block)
    middle = diagonal.mean()
    if np.linalg.norm(block - middle * np.eye(n)) <= 4 * n * _EPS * scale:
        return None
    spread = np.linalg.norm(block - middle * np.eye(n)) / np.sqrt(n)
    # The mean lies strictly between the extreme eigenvalues; the others avoid a shift that meets an eigenvalue.
    shifts = [np.median(diagonal), middle, *(middle + spread * s for s in (0.037, -0.041, 0.11, -0.13, 0.29, -0.31))]
    best = None
    for shift in shifts:
        projector = (polar_factor(block - shift * np.eye(n)) + np.eye(n)) / 2
        rank = round(np.trace(projector))
        if not 0 < rank < n:
            continue
        start = np.random.default_rng(n).normal(size=(n, rank))
        basis = np.linalg.qr(projector @ start)[0]
        whole = np.linalg.qr(projector @ basis, mode="complete")[0]
        upper, lower = whole[:, :rank], whole[:, rank:]
        off = np.linalg.norm(lower.T @ block @ upper)
        if best is None or off < best[0]:
            best = (off, upper, lower)
        if off <= 16 * n * _EPS * scale:
            break
    return best and best[1:]


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors as columns.

    Parts that hold none of the k are not split further.
    """
    matrix = (matrix + matrix.T) / 2
    n = len(matrix)
    scale = np.linalg.norm(matrix)
    found: list[np.ndarray] = []
    # Bases of invariant subspaces, that of the largest eigenvalues last.
    open_parts = [np.eye(n)] if n else []
    while open_parts and sum(b.shape[1] for b in found) < min(k, n):
        basis = open_parts.pop()
        block = basis.T @ matrix @ basis
        parts = _split((block + block.T) / 2, scale) if basis.shape[1] > 1 else None
        if parts is None:
            found.append(basis)
        else:
            open_parts += [basis @ parts[1], basis @ parts[0]]
    vectors = np.linalg.qr(np.hstack(found))[0] if found else np.zeros((n, 0))
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], vectors[:, order]
