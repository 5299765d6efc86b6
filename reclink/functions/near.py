"""Pairs of names within an edit budget, many at once: letters are counted first, then edits by bits (Myers 1999)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

# Letters of a name that one word of bits holds.
WORD = 64
# Pairs whose letters, and pairs whose edits are counted at a time.
CELLS, EDITS = 1 << 16, 1 << 13


class Names:
    """One side of a group: the code of each letter of its names, and words of bits that count letters."""

    def __init__(self, texts: list[str], signs: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.letters = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        self.signs = [np.ascontiguousarray(s).view(np.uint64) for s in signs]
        self.bits = sum(np.bitwise_count(s).astype(np.int16) for s in self.signs)

    def table(self, codes: np.ndarray, blank: int) -> np.ndarray:
        """A row of codes for each name, filled up with `blank`."""
        out = np.full((len(self.sizes), int(self.sizes.max(initial=0))), blank, dtype=np.int64)
        out[np.arange(out.shape[1]) < self.sizes[:, None]] = codes
        return out


def near_pairs(left: Names, right: Names | None, by_size: np.ndarray, budget: Callable | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (u, v) of near names of both sides; without a right side those of the left one among themselves, u < v.

    `by_size` holds the most edits for each length of the longer name. `budget(u, v, longer)` may allow fewer of a pair. An edit
    takes away one letter at most and adds one at most, so a name with more letters that the other lacks is out of reach.
    No name is longer than a word.
    """
    same = right is None
    right = left if same else right
    alphabet, codes = np.unique(np.concatenate([left.letters, right.letters]), return_inverse=True)
    text = np.ascontiguousarray(right.table(codes[len(left.letters) :], len(alphabet)).T)
    pattern = left.table(codes[: len(left.letters)], len(alphabet))
    by_size = by_size.astype(np.int16)
    rows = max(1, CELLS // max(1, len(right.sizes)))
    for start in range(0, len(left.sizes), rows):
        end, first = min(start + rows, len(left.sizes)), start if same else 0
        shared = sum(np.bitwise_count(a[start:end, None] & b[None, first:]).astype(np.int16) for a, b in zip(left.signs, right.signs))
        longer = np.maximum(left.sizes[start:end, None], right.sizes[None, first:])
        met = shared >= np.maximum(left.bits[start:end, None], right.bits[None, first:]) - by_size[longer]
        u, v = np.nonzero(met)
        u, v = u + start, v + first
        if same:
            u, v = u[u < v], v[u < v]
        most = by_size[np.maximum(left.sizes[u], right.sizes[v])]
        if budget is not None:
            most = np.minimum(most, budget(u, v, np.maximum(left.sizes[u], right.sizes[v])))
            shared = sum(np.bitwise_count(a[u] & b[v]).astype(np.int16) for a, b in zip(left.signs, right.signs))
            able = shared >= np.maximum(left.bits[u], right.bits[v]) - most
            u, v, most = u[able], v[able], most[able]
        if not len(u):
            continue
        places = _places(pattern[start:end], len(alphabet))
        at_place = text * (end - start)
        for at in range(0, len(u), EDITS):
            part = slice(at, at + EDITS)
            near = _edits(places, u[part] - start, left.sizes[u[part]], at_place, v[part], right.sizes[v[part]]) <= most[part]
            if near.any():
                yield u[part][near], v[part][near]


def _places(pattern: np.ndarray, letters: int) -> np.ndarray:
    """For each letter and name the bits of the places where it stands; none for the blank."""
    out = np.zeros((letters + 1, len(pattern)), dtype=np.uint32 if pattern.shape[1] <= 32 else np.uint64)
    each = np.arange(len(pattern))
    for k in range(pattern.shape[1]):
        out[pattern[:, k], each] |= out.dtype.type(1 << k)
    out[letters] = 0
    return out


def _edits(places: np.ndarray, u: np.ndarray, m: np.ndarray, text: np.ndarray, v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Edits between pattern u, of m letters, and text v, of n letters: the columns of all tables side by side, as bits.

    `text` holds the letters of all texts at a place, times the number of patterns, in a row.
    """
    order = np.argsort(-n, kind="stable")
    u, m, v, n = u[order], m[order], v[order], n[order]
    word = places.dtype.type
    one, top = word(1), np.maximum(m - 1, 0).astype(word)
    flat = places.ravel()
    more, less = np.full(len(u), ~word(0)), np.zeros(len(u), dtype=word)
    found, spare, up = m.astype(word), np.empty(len(u), dtype=word), np.empty(len(u), dtype=word)
    # Longest texts come first, so those that have ended are cut off.
    lives = np.searchsorted(-n, -np.arange(int(n.max(initial=0))), side="left")
    for j, k in enumerate(lives):
        p, q, x, h, t, f = more[:k], less[:k], spare[:k], up[:k], top[:k], found[:k]
        equal = flat.take(text[j].take(v[:k]) + u[:k])
        # across: ((equal & more) + more ^ more) | equal
        np.bitwise_and(equal, p, out=x)
        np.add(x, p, out=x)
        np.bitwise_xor(x, p, out=x)
        np.bitwise_or(x, equal, out=x)
        # up: less | ~(across | more), off: more & across
        np.bitwise_or(x, p, out=h)
        np.invert(h, out=h)
        np.bitwise_or(h, q, out=h)
        np.bitwise_and(x, p, out=x)
        # down: equal | less
        np.bitwise_or(equal, q, out=equal)
        np.right_shift(h, t, out=q)
        np.bitwise_and(q, one, out=q)
        np.add(f, q, out=f)
        np.right_shift(x, t, out=q)
        np.bitwise_and(q, one, out=q)
        np.subtract(f, q, out=f)
        np.left_shift(h, one, out=h)
        np.bitwise_or(h, one, out=h)
        np.bitwise_and(h, equal, out=q)
        # more: off << 1 | ~(down | up)
        np.bitwise_or(equal, h, out=equal)
        np.invert(equal, out=equal)
        np.left_shift(x, one, out=x)
        np.bitwise_or(x, equal, out=p)
    out = np.empty(len(u), dtype=np.int64)
    out[order] = np.where(m == 0, n, found)
    return out
