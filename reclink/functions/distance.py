"""Text distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from reclink.functions.text import as_column

# Fixed values of the affine gap: costs of a match, a mismatch, opening and extending a gap, and the share of the gap
# cost paid beyond the length of the shorter text (abbreviations).
MATCH, MISMATCH, GAP, SPACE, ABBREVIATION = 1.0, 11.0, 10.0, 7.0, 0.125


def longest(left: Column, right: Column) -> Column:
    return F.greatest(F.length(left), F.length(right))


def edit_budget(length: Column, similarity: float) -> Column:
    """Most edits that keep the Levenshtein ratio at or above `similarity`, for the longer of two texts."""
    return F.floor((F.lit(1.0) - F.lit(similarity)) * length + F.lit(1e-9)).cast("int")


def levenshtein_ratio(left: Column | str, right: Column | str) -> Column:
    """1 for equal texts, 0 for texts without a common character; null when one is missing."""
    left, right = as_column(left), as_column(right)
    # The distance is null when a text is missing; the length alone would skip the null.
    return 1 - F.levenshtein(left, right) / F.greatest(longest(left, right), F.lit(1))


def token_jaccard(left: Column | str, right: Column | str) -> Column:
    """Shared words over all words."""
    a, b = F.split(as_column(left), r"\s+"), F.split(as_column(right), r"\s+")
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def _codes(texts: list[str], width: int) -> np.ndarray:
    out = np.full((len(texts), width), -1, dtype=np.int32)
    for row, text in enumerate(texts):
        out[row, : len(text)] = np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)
    return out


# Cells of a table row that are handled at a time, over all pairs of a slice.
AREA = 1 << 18


def gap_costs(left: pd.Series, right: pd.Series) -> pd.Series:
    """Affine gap cost over the summed lengths (after Gotoh 1982), for many pairs at once.

    Pairs of like lengths are handled together, in slices of bounded size, so that one long text does not widen the arrays of
    all others.
    """
    out = pd.Series(np.nan, index=left.index, dtype="float64")
    usable = (left.notna() & right.notna() & (left != "") & (right != "")).to_numpy()
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in zip(left[usable], right[usable])]
    costs = np.empty(len(pairs))
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    start = 0
    while start < len(order):
        # Lengths rise, so the last pair of a slice is its longest.
        end = start + 1
        while end < len(order) and (end + 1 - start) * len(pairs[order[end]][0]) <= AREA:
            end += 1
        costs[order[start:end]] = _slice_costs([pairs[i] for i in order[start:end]])
        start = end
    out[usable] = costs
    return out


def _slice_costs(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Costs of (longer, shorter) pairs by the rows of their tables, side by side."""
    long_texts, short_texts = [a for a, _ in pairs], [b for _, b in pairs]
    n = np.array([len(a) for a in long_texts])
    m = np.array([len(b) for b in short_texts])
    a, b = _codes(long_texts, n.max()), _codes(short_texts, m.max())
    rows = np.arange(len(pairs))
    costs = np.empty(len(pairs))

    best = np.tile(GAP + SPACE * np.arange(n.max() + 1, dtype=float), (len(pairs), 1))
    best[:, 0] = 0.0
    down = np.full_like(best, np.inf)
    for i in range(1, m.max() + 1):
        above, best = best, np.empty_like(best)
        best[:, 0] = GAP + SPACE * i
        across = np.full(len(pairs), np.inf)
        step = above[:, :-1] + np.where(a == b[:, i - 1 : i], MATCH, MISMATCH)
        down = np.minimum(down, above + GAP) + SPACE
        for j in range(1, n.max() + 1):
            scale = np.where(j <= m, 1.0, ABBREVIATION)
            across = np.minimum(across, best[:, j - 1] + GAP * scale) + SPACE * scale
            best[:, j] = np.minimum(np.minimum(across, down[:, j]), step[:, j - 1])
        ended = m == i
        costs[ended] = best[rows[ended], n[ended]]
    same = np.array([x == y for x, y in pairs])
    costs[same] = MATCH * n[same]
    return costs / (n + m)


@pandas_udf(DoubleType())
def affine_gap(left: pd.Series, right: pd.Series) -> pd.Series:
    """Normalised affine gap distance; call it on distinct value pairs. Null when a text is missing or empty."""
    return gap_costs(left, right)
