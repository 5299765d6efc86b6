"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard of bytes held as a numpy array.

Induced sorting follows SA-IS (Nong, Zhang and Chan, 2009): suffixes are classified, leftmost-smaller substrings are sorted
by an induced pass and named, their order is found by recursion where names repeat, and two induced passes fill the array.
A pass reads the array from one side and writes ahead of itself. It is done in stretches: as long as no entry of a stretch
is written inside the stretch itself, all its entries can be handled at once; else the stretch ends before the first one.
"""

from __future__ import annotations

import numpy as np

# Entries handled at once at most, and a stretch under which entries are handled one by one for a while.
STRETCH, SHORT, SINGLES = 1 << 16, 8, 256

# Letters of substrings that are compared in step; longer ones are compared as a whole.
IN_STEP = 64


def suffix_array(letters: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. letters ends with a 0, all others are larger."""
    n = len(letters)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    rising = _rising(letters)
    marks = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    counts = np.bincount(letters)
    ends = np.cumsum(counts)
    # Sort the substrings between marks by induction from marks in any order, then name them.
    order = _induced(letters, rising, marks, ends, counts)
    is_mark = np.zeros(n, bool)
    is_mark[marks] = True
    by_substring = order[is_mark[order]]
    names = _names(letters, marks, by_substring)
    text = names[marks]
    if text.max() + 1 == len(marks):
        by_suffix = by_substring
    else:
        by_suffix = marks[suffix_array(text)]
    return _induced(letters, rising, by_suffix, ends, counts)


def _rising(letters: np.ndarray) -> np.ndarray:
    """Whether a suffix is smaller than the next one; the last one is."""
    n = len(letters)
    step = np.empty(n, np.int8)
    step[:-1] = np.sign(letters[1:].astype(np.int64) - letters[:-1])
    step[-1] = 1
    # A run of equal letters takes the step at its end.
    place = np.where(step != 0, np.arange(n), n - 1)
    after = np.minimum.accumulate(place[::-1])[::-1]
    return step[after] > 0


def _induced(letters: np.ndarray, rising: np.ndarray, marks: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All suffixes in order, if marks are; else sorted up to the next mark of each."""
    n = len(letters)
    order = np.full(n, -1, np.int32)
    # Marks at the ends of their buckets, in the given order.
    heads = letters[marks]
    by_letter = np.argsort(heads, kind="stable")
    sorted_heads = heads[by_letter]
    per = np.bincount(heads, minlength=len(counts))
    first = np.cumsum(per) - per
    rank = np.arange(len(marks)) - first[sorted_heads]
    order[ends[sorted_heads] - per[sorted_heads] + rank] = marks[by_letter]
    _pass(order, letters, ~rising, (ends - counts).astype(np.int64), 1)
    # What rises is filled anew, from the right; the last suffix is the smallest one.
    slots = letters[order.clip(0)]
    keep = (order >= 0) & ~rising[order.clip(0)]
    order[~keep] = -1
    order[0] = n - 1
    del slots
    _pass(order, letters, rising, ends.astype(np.int64) - 1, -1)
    order[0] = n - 1
    return order


def _pass(order: np.ndarray, letters: np.ndarray, wanted: np.ndarray, free: np.ndarray, way: int) -> None:
    """Write the suffix before each entry, if it is wanted, to the next free slot of its bucket, reading in this direction."""
    n = len(order)
    at, size = 0, 1024
    view, flip = (order, 0) if way > 0 else (order[::-1], n - 1)
    while at < n:
        stop = min(n, at + size)
        entries = view[at:stop]
        place = np.flatnonzero(entries > 0)
        before = entries[place] - 1
        chosen = wanted[before]
        place, before = place[chosen], before[chosen]
        done = stop - at
        if len(before):
            heads = letters[before]
            by_letter = np.argsort(heads, kind="stable")
            sorted_heads = heads[by_letter]
            starts = np.flatnonzero(np.concatenate(([True], sorted_heads[1:] != sorted_heads[:-1])))
            sizes = np.diff(np.append(starts, len(heads)))
            rank = np.arange(len(heads)) - np.repeat(starts, sizes)
            target = np.empty(len(heads), np.int64)
            target[by_letter] = free[sorted_heads] + way * rank
            seen = target if way > 0 else flip - target
            nearest = int(seen.min())
            if nearest < stop:
                done = nearest - at
                inside = place < done
                heads, target, before = heads[inside], target[inside], before[inside]
                np.add.at(free, heads, way)
            else:
                free[sorted_heads[starts]] += way * sizes
            order[target] = before
        at += done
        if done >= size:
            size = min(2 * size, STRETCH)
        elif done >= SHORT:
            size = max(2 * done, 64)
        else:
            at = _one_by_one(view, order, letters, wanted, free, way, at)
            size = 64


def _one_by_one(view: np.ndarray, order: np.ndarray, letters: np.ndarray, wanted: np.ndarray, free: np.ndarray, way: int, at: int) -> int:
    stop = min(len(order), at + SINGLES)
    while at < stop:
        entry = int(view[at])
        at += 1
        if entry > 0 and wanted[entry - 1]:
            head = letters[entry - 1]
            order[free[head]] = entry - 1
            free[head] += way
    return at


def _names(letters: np.ndarray, marks: np.ndarray, by_substring: np.ndarray) -> np.ndarray:
    """Rank of the substring that starts at each mark; equal ones share it."""
    n = len(letters)
    length = np.zeros(n, np.int32)
    length[marks[:-1]] = np.diff(marks) + 1
    length[marks[-1]] = 1
    a, b = by_substring[:-1], by_substring[1:]
    same = length[a] == length[b]
    open_pairs = np.flatnonzero(same)
    for k in range(IN_STEP):
        if not len(open_pairs):
            break
        x, y = a[open_pairs], b[open_pairs]
        inside = k < length[x]
        open_pairs, x, y = open_pairs[inside], x[inside], y[inside]
        differ = letters[x + k] != letters[y + k]
        same[open_pairs[differ]] = False
        open_pairs = open_pairs[~differ]
    for p in open_pairs.tolist():
        x, y, size = int(a[p]), int(b[p]), int(length[a[p]])
        same[p] = np.array_equal(letters[x : x + size], letters[y : y + size])
    names = np.zeros(n, np.int32)
    names[by_substring] = np.concatenate(([0], np.cumsum(~same)))
    return names


def common_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start in text, the start before it in order (-1: none) and the length of their common prefix within room.

    text has one byte for each letter, without the closing 0 of the suffix array; room is the number of bytes from each start
    to the end of its piece. Lengths stand in the order of the text: where the letters before both starts agree, a length is
    one less than that of the start before, so only the others are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    before = before[:n]
    before[before == n] = -1
    starts = np.arange(n)
    linked = before >= 0
    fresh = np.ones(n, bool)
    after = np.flatnonzero(linked[1:] & linked[:-1]) + 1
    after = after[before[after] > 0]
    fresh[after] = (text[after - 1] != text[before[after] - 1]) | (room[after - 1] == 0) | (room[before[after] - 1] == 0)
    common = np.zeros(n, np.int64)
    words = np.ndarray((n + 1,), "<u8", np.concatenate([text, np.zeros(8, np.uint8)]).tobytes(), 0, (1,))
    open_starts = np.flatnonzero(fresh & linked)
    most = np.minimum(room[open_starts], room[before[open_starts]])
    k = 0
    while len(open_starts):
        inside = k < most
        common[open_starts[~inside]] = most[~inside]
        open_starts, most = open_starts[inside], most[inside]
        differ = words[open_starts + k] ^ words[before[open_starts] + k]
        ended = differ != 0
        low = differ[ended]
        bits = np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64)
        common[open_starts[ended]] = np.minimum(k + bits // 8, most[ended])
        open_starts, most = open_starts[~ended], most[~ended]
        k += 8
    # Carry each compared length along the starts that follow from it.
    source = np.maximum.accumulate(np.where(fresh, starts, 0))
    common = np.maximum(common[source] - (starts - source), 0)
    common[~linked] = 0
    return before, common
