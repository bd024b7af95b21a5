"""Right singular vectors of one small triangular matrix: bidiagonal form, dqds, twisted factorisations.

Everything here works on one matrix of the width of an embedding; the rows of a table never come here.
"""

from __future__ import annotations

import math

import numpy as np

EPS = 2.0**-52
# Differences of squared singular values, in parts of the largest: taken as one group; found as one span.
NEAR, TIGHT = 1e-6, 1e-9


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with U' A V upper bidiagonal, by Householder reflections from both sides."""
    a = np.array(matrix, dtype=np.float64)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0.0:
            return None
        w = x / size
        w[0] += math.copysign(1.0, w[0])
        return w / np.linalg.norm(w)

    for k in range(n):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2.0 * np.outer(w, w @ a[k:, k:])
        if k + 2 < n:
            w = reflector(a[k, k + 1 :])
            if w is not None:
                a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ w, w)
                v[:, k + 1 :] -= 2.0 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float] | None:
    """One differential qd step with a shift: (q, e, smallest and last d), or None if the shift was too large."""
    d = q[0] - shift
    least, new_q, new_e = d, [0.0] * len(q), [0.0] * len(e)
    for k in range(len(e)):
        if d < 0.0:
            return None
        top = d + e[k]
        new_q[k] = top
        if top == 0.0:
            d = q[k + 1] - shift  # the row is zero: nothing is carried on
        else:
            ratio = q[k + 1] / top
            new_e[k] = e[k] * ratio
            d = d * ratio - shift
        least = min(least, d)
    if d < 0.0:
        return None
    new_q[-1] = d
    return new_q, new_e, least, d


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, by dqds with deflation at both kinds of zeros.

    The shift is a lower bound seen in the step before; a step that turns negative is repeated with a smaller one, in
    the end without shift, which never fails and keeps small values accurate.
    """
    size = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(above).max(initial=0.0)))
    if size == 0.0:
        return np.zeros(len(diagonal))
    todo = [([(x / size) ** 2 for x in diagonal.tolist()], [(x / size) ** 2 for x in above.tolist()], 0.0)]
    found: list[float] = []
    while todo:
        q, e, moved = todo.pop()
        shift = 0.0
        while q:
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if e[-1] <= EPS * EPS * (moved + q[-1]) or e[-1] == 0.0:
                found.append(q.pop() + moved)
                e.pop()
                shift = 0.0
                continue
            cut = next((k for k in range(len(e) - 1) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e, shift = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            step = _sweep(q, e, shift)
            while step is None:
                shift = shift / 8.0 if shift > EPS * EPS else 0.0
                step = _sweep(q, e, shift)
            q, e, least, last = step
            moved += shift
            # Close to the end the last d is nearly the smallest value that is left; a part of it is a safe shift.
            shift = 0.75 * max(least, 0.0) if e[-1] > 0.01 * last else max(0.0, last - math.sqrt(e[-1] * last)) * (1.0 - 4 * EPS) if last else 0.0
            shift = min(shift, max(least, 0.0))
    return np.array(sorted(found, reverse=True)) * size * size


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue: factorise B'B - value from both ends, join at the twist with the smallest pivot."""
    n = len(diagonal)
    squares, links = diagonal * diagonal, above * above
    tiny = max(EPS * EPS * value, 1e-300)
    safe = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    plus, s = np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n):
        plus[k] = safe(squares[k] + s[k])
        if k + 1 < n:
            s[k + 1] = links[k] / plus[k] * s[k] - value
    minus, p = np.zeros(n), np.zeros(n)
    p[n - 1] = squares[n - 1] - value
    for k in range(n - 2, -1, -1):
        minus[k + 1] = safe(links[k] + p[k + 1])
        p[k] = p[k + 1] * (squares[k] / minus[k + 1]) - value
    twist = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -(diagonal[k] * above[k] / plus[k]) * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -(diagonal[k] * above[k] / minus[k + 1]) * z[k]
    return z / np.linalg.norm(z)


def _blocks(diagonal: np.ndarray, above: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of the bidiagonal matrix that no link joins."""
    size = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(above).max(initial=0.0)))
    cuts = [k + 1 for k in range(len(above)) if abs(above[k]) <= EPS * EPS * size]
    return list(zip([0, *cuts], [*cuts, len(diagonal)]))


def _near_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal span of the eigenvectors of values that nearly coincide, by inverse iteration of a block."""
    lower = np.diag(diagonal) + np.diag(above, 1)
    shifted = lower.T @ lower - values.mean() * (1.0 + 8 * EPS) * np.eye(len(diagonal))
    span = np.random.default_rng(len(values)).normal(size=(len(diagonal), len(values)))
    for _ in range(6):
        span, _ = np.linalg.qr(np.linalg.lstsq(shifted, span, rcond=EPS * EPS)[0])
    return span


def leading_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(all squared singular values, falling; the unit right singular vectors of the first ``count`` as columns).

    Each unlinked block gives its own vectors. Where values of one block are too near for a twist to tell them apart,
    the span of their vectors is found at once. Groups of near values are turned into singular vectors by the singular
    values of the matrix on their span. A direction of a value of 0 is 0.
    """
    n = matrix.shape[1]
    diagonal, above, v = bidiagonal(matrix)
    pairs = []
    for start, end in _blocks(diagonal, above):
        values = squared_singular_values(diagonal[start:end], above[start : end - 1])
        pairs += [(float(value), start, end) for value in values]
    pairs.sort(key=lambda pair: (-pair[0], pair[1]))
    values = np.array([pair[0] for pair in pairs])
    top = values[0] if n else 0.0
    wanted = min(count, n)
    while 0 < wanted < n and values[wanted - 1] - values[wanted] <= NEAR * top and values[wanted - 1] > 0:
        wanted += 1  # a group of near values is taken whole
    runs: dict[tuple[int, int], list[list[int]]] = {}
    for k in range(wanted):
        own = runs.setdefault(pairs[k][1:], [])
        if own and values[own[-1][-1]] - values[k] <= TIGHT * top:
            own[-1].append(k)
        else:
            own.append([k])
    vectors = np.zeros((n, wanted))
    for (start, end), own in runs.items():
        a, b = diagonal[start:end], above[start : end - 1]
        for run in own:
            if len(run) > 1:
                vectors[:, run] = v[:, start:end] @ _near_vectors(a, b, values[run])
            elif values[run[0]] > 0.0:
                vectors[:, run[0]] = v[:, start:end] @ twisted_vector(a, b, values[run[0]])
    group = 0
    for k in range(1, wanted + 1):
        if k == wanted or values[k - 1] - values[k] > NEAR * top:
            if k - group > 1 and values[group] > 0.0:
                inside, _ = np.linalg.qr(vectors[:, group:k])
                _, _, turn = np.linalg.svd(matrix @ inside, full_matrices=False)
                vectors[:, group:k] = inside @ turn.T
            group = k
    return values, vectors[:, : min(count, n)]
