"""Small dense algebra of the regression fits, on standardised cross-products.

Columns are centred and scaled before anything is solved, so a column on an epoch
scale is fitted as well as its standardised twin.  A column that the columns before
it explain (but for a share of TOLERANCE of its variance) is aliased: it gets no
estimate and is named, instead of half of another column's effect."""

from __future__ import annotations

import numpy as np

# Share of a column's own variance that must be left after the columns before it.
TOLERANCE = 1e-9


def independent(cross: np.ndarray, tolerance: float = TOLERANCE) -> list[int]:
    """Columns, in order, that those before them do not explain; ``cross`` is a matrix
    of (weighted) sums of products."""
    scale = np.sqrt(np.maximum(np.diag(cross), 0.0))
    some = np.flatnonzero(scale > 0)
    left = cross[np.ix_(some, some)] / np.outer(scale[some], scale[some])
    try:  # the squared diagonal is what each column has left after those before it
        if np.all(np.diag(np.linalg.cholesky(left)) ** 2 > tolerance):
            return some.tolist()
    except np.linalg.LinAlgError:
        pass
    kept: list[int] = []
    for j in range(len(some)):
        if left[j, j] > tolerance:
            kept.append(int(some[j]))
            left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return kept


def inverse(cross: np.ndarray) -> np.ndarray:
    """Inverse of a positive definite matrix, by way of its unit-diagonal form."""
    scale = np.sqrt(np.diag(cross))
    unit = cross / np.outer(scale, scale)
    return np.linalg.inv((unit + unit.T) / 2) / np.outer(scale, scale)


class Entering:
    """What the columns that are in have left of all others: a Cholesky factor of the columns
    that entered, one row of cross-products each, so that K candidates cost K numbers a step."""

    def __init__(self, diagonal: np.ndarray, with_label: np.ndarray, label: float):
        self.whole, self.left = diagonal, diagonal.copy()
        self.with_label, self.label = with_label.copy(), label
        self.factor: list[np.ndarray] = []

    def enter(self, term: int, row: np.ndarray) -> None:
        """``row``: the term's cross-products with all columns."""
        for f in self.factor:
            row = row - f[term] * f
        row = row / np.sqrt(row[term])
        mine = self.with_label[term] / np.sqrt(self.left[term])
        self.left = self.left - row ** 2
        self.with_label = self.with_label - mine * row
        self.label -= mine ** 2
        self.factor.append(row)

    def candidates(self, n: int, intercept: bool = True) -> np.ndarray:
        """t statistic of each column if it entered next; NaN if those that are in explain it."""
        df = n - len(self.factor) - 1 - intercept
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.maximum(self.label - self.with_label ** 2 / self.left, 0.0)
            t = self.with_label / self.left / np.sqrt(rest / df / self.left) if df > 0 else np.full(len(self.left), np.nan)
        return np.where((self.whole > 0) & (self.left > TOLERANCE * self.whole), t, np.nan)
