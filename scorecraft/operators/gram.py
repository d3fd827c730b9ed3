"""Cross-products of a wide design in one pass over the rows.

A design has number columns and string columns, of which every level is a 0/1 term.
Rows travel as one array of numbers and the strings themselves, so a plan does not
grow with the terms or the levels.  Each task adds up, in numpy and on columns shifted
by a common value near their means, one row of sums per term: products of numbers for
a number column, count and sums of numbers for a level, and counts of pairs of levels
of different columns (which is what a product of dummies is).  These rows are added
by term across tasks, so the work of adding is spread over the cluster; the driver
gets terms x numbers sums and the pairs of levels that occur.

Rows with a NULL or NaN number are left out; a row with a NULL string has no level."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows whose means are the shift (any value near the means will do), and pairs of levels a task holds before it passes them on.
SHIFT_ROWS, HELD_PAIRS = 100, 1_000_000
# Numbers a task returns up to which they are added up as rows.
FEW_NUMBERS = 2_000
_SUMS = "term int, other int, v array<double>"


@dataclass
class Design:
    """Columns of a design in order; ``levels`` has the levels that are terms of the string ones."""
    columns: list
    levels: dict = field(default_factory=dict)

    def __post_init__(self):
        self.numbers = [c for c in self.columns if c not in self.levels]
        self.text = [c for c in self.columns if c in self.levels]
        self.names, self.place = [], []  # of the terms: name, and (number, -1) or (string column, level)
        for c in self.columns:
            if c in self.levels:
                self.names += [f"{c}_{x}" for x in self.levels[c]]
                self.place += [(self.text.index(c), k) for k in range(len(self.levels[c]))]
            else:
                self.names.append(c)
                self.place.append((self.numbers.index(c), -1))
        self.at = {n: k for k, n in enumerate(self.names)}
        if len(self.at) < len(self.names):
            raise ValueError("two terms have one name: " + ", ".join(sorted({n for n in self.names if self.names.count(n) > 1})[:5]))
        # terms of the numbers, and of each string column's levels
        self.number_terms = np.array([t for t, (_, v) in enumerate(self.place) if v < 0], np.int64)
        self.level_terms = [np.array([t for t, (c, v) in enumerate(self.place) if v >= 0 and c == k], np.int64) for k in range(len(self.text))]

    def rows(self, df: DataFrame, label: str) -> DataFrame:
        """One array of the numbers and the label, and the strings as they are."""
        numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in [*self.numbers, label]])
        return df.select(numbers.alias("x"), *[F.col(f"`{c}`").cast("string").alias(f"s{k}") for k, c in enumerate(self.text)])

    def reader(self):
        """A function of an Arrow batch of ``rows``: (numbers of complete rows, label last; codes of
        each string column, -1 without a term)."""
        width = len(self.numbers) + 1
        known = [{v: k for k, v in enumerate(self.levels[c])} for c in self.text]

        def read(batch):
            lists = batch.column(0)
            flat = lists.values.slice(lists.offsets[0].as_py(), len(lists) * width).to_numpy(zero_copy_only=False)
            x = flat.astype(float, copy=False).reshape(len(lists), width)
            whole = ~np.isnan(x).any(axis=1)
            codes = []
            for k, level in enumerate(known):
                coded = batch.column(1 + k).dictionary_encode()
                of = np.array([*(level.get(v, -1) for v in coded.dictionary.to_pylist()), -1], np.int64)
                at = coded.indices.fill_null(len(of) - 1).to_numpy(zero_copy_only=False)
                codes.append(of[at] if whole.all() else of[at][whole])
            return (x if whole.all() else x[whole]), codes
        return read


def summed(partial: DataFrame, numbers: int) -> list[tuple]:
    """(term, other, array) with arrays of equal (term, other) added up, spread over the cluster
    by term.  ``numbers`` is about what a task returns: a few are added up as rows, many as
    arrays in numpy."""
    if numbers <= FEW_NUMBERS:
        found: dict = {}
        for t, o, at, x in (partial.select("term", "other", F.posexplode("v").alias("at", "x"))
                            .groupBy("term", "other", "at").agg(F.sum("x").alias("x")).collect()):
            found.setdefault((t, o), []).append((at, x))
        return [(t, o, np.array([x for _, x in sorted(v)])) for (t, o), v in found.items()]

    def add(batches):
        held: dict = {}
        for batch in batches:
            for t, o, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                v = v.values.to_numpy(zero_copy_only=False)
                held[t, o] = held[t, o] + v if (t, o) in held else v.copy()
        if held:
            yield _batch([(t, o, v) for (t, o), v in held.items()])
    return [(t, o, np.array(v)) for t, o, v in partial.repartition("term").mapInArrow(add, _SUMS).collect()]


def _batch(rows) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(v) for _, _, v in rows)])
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[2] for r in rows])))], ["term", "other", "v"])


@dataclass
class Gram:
    """Sums over n complete rows.  Numbers come first among the stored rows, the label last of them."""
    design: Design
    n: int
    mean: np.ndarray    # of the terms, then of the label
    products: np.ndarray  # centred, of numbers and label
    counts: list        # of each string column, by level
    sums: list          # of each string column: centred sums of numbers and label by level
    pairs: dict         # (string column, level) -> {(string column, level): rows}

    @property
    def names(self) -> list:
        return self.design.names

    def row(self, term: int) -> np.ndarray:
        """Centred cross-products of a term with all terms and the label (last); the label's
        number is -1."""
        d, out = self.design, np.empty(len(self.names) + 1)
        k, level = (len(d.numbers), -1) if term == -1 else d.place[term]
        if level < 0:
            of_numbers = self.products[k]
            of_levels = [s[:, k] for s in self.sums]
        else:
            mine = self.counts[k][level]
            of_numbers = self.sums[k][level]
            of_levels = [-mine * c / max(self.n, 1) for c in self.counts]
            of_levels[k][level] += mine
            for (c, v), rows in self.pairs.get((k, level), {}).items():
                of_levels[c][v] += rows
        out[d.number_terms] = of_numbers[:-1]
        for at, values in zip(d.level_terms, of_levels):
            out[at] = values
        out[-1] = of_numbers[-1]
        return out

    def sub(self, terms) -> np.ndarray:
        """Centred cross-products of some terms and the label (last)."""
        at = [*terms, -1]
        d = self.design
        if all(d.place[t][1] < 0 for t in terms):
            k = [d.place[t][0] for t in terms] + [len(d.numbers)]
            return self.products[np.ix_(k, k)]
        return np.array([self.row(t)[at] for t in at])

    def diagonal(self) -> np.ndarray:
        d, out = self.design, np.empty(len(self.names) + 1)
        out[[*d.number_terms, -1]] = np.diag(self.products)
        for at, counts in zip(d.level_terms, self.counts):
            out[at] = counts * (1 - counts / max(self.n, 1))
        return out


def gram(rows: DataFrame, design: Design) -> Gram:
    """All sums of ``design.rows`` in one pass (and a look at the first rows for the shift)."""
    width, texts = len(design.numbers) + 1, len(design.text)
    sizes = [len(design.levels[c]) for c in design.text]
    first = [r[0] for r in rows.select("x").limit(SHIFT_ROWS).collect()]
    first = np.array([[np.nan if v is None else v for v in r] for r in first], float).reshape(len(first), width)
    first = first[np.isfinite(first).all(axis=1)]
    shift = first.mean(axis=0) if len(first) else np.zeros(width)
    read = design.reader()
    base = np.cumsum([width, *sizes])  # number of the first level of each string column among the stored rows

    def add(batches):
        n, total, products = 0, np.zeros(width), np.zeros((width, width))
        by_level = [np.zeros((s, width + 1)) for s in sizes]
        pairs: dict = {}
        for batch in batches:
            x, codes = read(batch)
            if not len(x):
                continue
            x = x - shift
            n += len(x)
            total += x.sum(axis=0)
            products += x.T @ x
            for k, code in enumerate(codes):
                has = np.flatnonzero(code >= 0)
                order = has[np.argsort(code[has], kind="stable")]
                if not len(order):
                    continue
                own = code[order]
                begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                by_level[k][own[begin], 0] += np.diff(np.append(begin, len(own)))
                by_level[k][own[begin], 1:] += np.add.reduceat(x[order], begin, axis=0)
                for j in range(k + 1, texts):
                    both = (code >= 0) & (codes[j] >= 0)
                    seen, count = np.unique((code[both] + base[k]) * base[-1] + codes[j][both] + base[j], return_counts=True)
                    for p, c in zip(seen.tolist(), count.tolist()):
                        pairs[p] = pairs.get(p, 0) + c
            if len(pairs) > HELD_PAIRS:
                yield _batch([(p // base[-1], p % base[-1], np.array([float(c)])) for p, c in pairs.items()])
                pairs = {}
        if not n:
            return
        out = [(k, -1, products[k, k:]) for k in range(width)] + [(-1, -1, np.append(total, n))]
        for k in range(texts):
            out += [(int(base[k]) + v, -1, by_level[k][v]) for v in np.flatnonzero(by_level[k][:, 0])]
        out += [(p // base[-1], p % base[-1], np.array([float(c)])) for p, c in pairs.items()]
        for lo in range(0, len(out), 500):
            yield _batch(out[lo:lo + 500])

    n, total, products = 0, np.zeros(width), np.zeros((width, width))
    counts, sums, pairs = [np.zeros(s) for s in sizes], [np.zeros((s, width)) for s in sizes], {}
    about = width * (width + 1) // 2 + sum(sizes) * (width + 1) + sum(a * b for k, a in enumerate(sizes) for b in sizes[k + 1:])
    for t, o, v in summed(rows.mapInArrow(add, _SUMS), about):
        if t < 0:
            n, total = int(v[-1]), np.array(v[:-1])
        elif o >= 0:
            a, b = ((int(np.searchsorted(base, z, side="right")) - 1, z) for z in (t, o))
            a, b = (a[0], int(a[1] - base[a[0]])), (b[0], int(b[1] - base[b[0]]))
            pairs.setdefault(a, {})[b] = v[0]
            pairs.setdefault(b, {})[a] = v[0]
        elif t < width:
            products[t, t:] = products[t:, t] = v
        else:
            k = int(np.searchsorted(base, t, side="right")) - 1
            counts[k][t - base[k]] = v[0]
            sums[k][t - base[k]] = v[1:]
    off = total / n if n else np.zeros(width)  # of the means from the shift
    products -= n * np.outer(off, off)
    sums = [s - np.outer(c, off) for s, c in zip(sums, counts)]
    number_mean = shift + off if n else np.zeros(width)
    mean = np.empty(len(design.names) + 1)
    mean[[*design.number_terms, -1]] = number_mean
    for at, c in zip(design.level_terms, counts):
        mean[at] = c / max(n, 1)
    return Gram(design, n, mean, products, counts, sums, pairs)
