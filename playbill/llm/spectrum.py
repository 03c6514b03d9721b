"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of A - s I, read from its LDL' factors, tells how many eigenvalues lie above s. Counts
at halved intervals isolate each leading eigenvalue; Rayleigh quotient iteration
from there converges cubically; and counts just above and below what it
found certify its number in the order of eigenvalues.
"""

from __future__ import annotations

import numpy as np

#: the pivot rule of Bunch and Kaufman
_ALPHA = (1 + 17 ** 0.5) / 8
_EPS = np.finfo(float).eps


def inertia(matrix: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix are positive, and how many negative.

    From the blocks of D in P' A P = L D L', with pivots of one or two rows.
    """
    a = np.array(matrix, float)
    positive = negative = k = 0
    n = len(a)
    while k < n:
        column = np.abs(a[k + 1:, k])
        big = column.max(initial=0.0)
        if big == 0:
            positive, negative = positive + (a[k, k] > 0), negative + (a[k, k] < 0)
            k += 1
            continue
        r = k + 1 + int(column.argmax())
        two = False
        if abs(a[k, k]) < _ALPHA * big:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            wide = row.max()
            if abs(a[k, k]) * wide >= _ALPHA * big * big:
                swap = k
            elif abs(a[r, r]) >= _ALPHA * wide:
                swap = r
            else:
                two, swap = True, r
            at = k + 1 if two else k
            if swap != at:
                a[[at, swap], k:] = a[[swap, at], k:]
                a[k:, [at, swap]] = a[k:, [swap, at]]
        size = 2 if two else 1
        pivot, below = a[k:k + size, k:k + size], a[k + size:, k:k + size]
        if two:  # its determinant is negative by the choice of pivots
            positive, negative = positive + 1, negative + 1
        else:
            positive, negative = positive + (pivot[0, 0] > 0), negative + (pivot[0, 0] < 0)
        if len(below):
            rest = a[k + size:, k + size:]
            rest -= below @ np.linalg.solve(pivot, below.T)
            rest += rest.T.copy()  # keeps it symmetric
            rest *= 0.5
        k += size
    return positive, negative


class Slicer:
    """Leading eigenpairs of one symmetric matrix, largest first."""

    def __init__(self, matrix: np.ndarray):
        self.a = (matrix + matrix.T) / 2
        self.n = len(matrix)
        self.scale = float(np.abs(self.a).sum(axis=1).max(initial=0.0))  # bounds all eigenvalues
        self.near = 64 * self.n * _EPS * self.scale
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """How many eigenvalues are greater than ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = inertia(self.a - shift * np.eye(self.n))[0]
        return self.counts[shift]

    def isolated(self, number: int) -> tuple[float, float, int, int]:
        """An interval that holds eigenvalue ``number``, counted from 1: (low, high, first, last),
        with the numbers of all that it holds. It is halved until it holds one alone and is
        narrow enough to start from, or is as narrow as rounding allows."""
        high = min((s for s, c in self.counts.items() if c < number), default=2 * self.scale)
        low = max((s for s, c in self.counts.items() if c >= number), default=-2 * self.scale)
        while True:
            first, last = self.above(high) + 1, self.above(low)
            if high - low <= self.near or first == last and high - low <= 1e-3 * max(
                    abs(high), abs(low)):
                return low, high, first, last
            middle = (low + high) / 2
            if self.above(middle) >= number:
                low = middle
            else:
                high = middle

    def _iterated(self, shift: float, start: np.ndarray, found: np.ndarray) -> tuple[float, np.ndarray]:
        """Rayleigh quotient iteration, orthogonal to the vectors found; one step of inverse
        iteration at the middle of the interval comes first."""
        vector = start - found.T @ (found @ start)
        vector /= np.linalg.norm(vector)
        best = (np.inf, shift, vector)
        for step in range(12):
            system = self.a - shift * np.eye(self.n)
            try:
                moved = np.linalg.solve(system, vector)
            except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
                moved = np.linalg.solve(system + self.near / 64 * np.eye(self.n), vector)
            moved -= found.T @ (found @ moved)
            vector = moved / np.linalg.norm(moved)
            value = float(vector @ self.a @ vector)
            residual = float(np.linalg.norm(self.a @ vector - value * vector))
            if residual < best[0]:
                best = residual, value, vector
            if residual <= 4 * _EPS * self.scale or step > 5 and residual >= best[0]:
                break
            if step:
                shift = value
        return best[1], best[2]

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` largest eigenvalues that are positive beyond rounding, and their unit vectors
        as rows. Eigenvalues that no count can tell apart share an interval and are
        ordered by their quotients."""
        values, vectors = [], np.zeros((0, self.n))
        most = min(most, self.above(self.near) if self.scale else 0)
        rng = np.random.default_rng(0)
        while len(values) < most:
            number = len(values) + 1
            low, high, first, last = self.isolated(number)
            if first == last:
                value, vector = self._certified(low, high, number, vectors, rng)
                values.append(value)
                vectors = np.vstack([vectors, vector])
                continue
            cluster = []
            for _ in range(last - number + 1):
                value, vector = self._iterated(
                    (low + high) / 2, rng.standard_normal(self.n), vectors)
                if not low - self.near <= value <= high + self.near:
                    raise ArithmeticError("an eigenvalue was found outside of its interval")
                cluster.append(value)
                vectors = np.vstack([vectors, vector])
            order = np.argsort(-np.array(cluster), kind="stable")
            vectors[number - 1:] = vectors[number - 1:][order]
            values += [cluster[k] for k in order]
        return np.array(values[:most]), vectors[:most]

    def _certified(
        self, low: float, high: float, number: int, found: np.ndarray, rng: np.random.Generator
    ) -> tuple[float, np.ndarray]:
        """Iterate inside the interval, halving it, until counts confirm the number of the result."""
        while True:
            value, vector = self._iterated((low + high) / 2, rng.standard_normal(self.n), found)
            if low - self.near <= value <= high + self.near and (
                    self.above(value + self.near) < number <= self.above(value - self.near)):
                return value, vector
            if high - low <= self.near:
                raise ArithmeticError("counts do not confirm an eigenvalue")
            middle = (low + high) / 2
            low, high = (middle, high) if self.above(middle) >= number else (low, middle)
