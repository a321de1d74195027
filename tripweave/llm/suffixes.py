"""Suffix arrays by induced sorting, and their permuted common prefixes."""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S type); the last one is L type.

    A suffix is compared with the next by the first letter that differs from its own.
    """
    change = np.flatnonzero(text[1:] != text[:-1])
    small = np.zeros(len(text), dtype=bool)
    if len(change):
        rises = text[change] < text[change + 1]
        small[:change[-1] + 1] = np.repeat(rises, np.diff(change, prepend=-1))
    return small


def _place(order: np.ndarray, free: np.ndarray, text: np.ndarray, found: np.ndarray) -> None:
    """Put suffixes, in this order, at the free ends of their letters' buckets."""
    if not len(found):
        return
    letters = text[found]
    by = letters.argsort(kind="stable")
    letters = letters[by]
    slots = free[letters] + np.arange(len(by)) - letters.searchsorted(letters)
    order[slots] = found[by]
    free[letters] = slots + 1  # the last of a letter counts


def _scan(order: np.ndarray, free: np.ndarray, text: np.ndarray, wanted: np.ndarray) -> None:
    """Go through the order upwards and place the suffix before each one met, if it is wanted.

    A stretch is scanned at a time, up to the first slot that the stretch itself fills: what is met
    before that slot is final.  The next stretch begins there.  So buckets need no loop of their own
    and the alphabet may be as large as the text.
    """
    done, width = 0, 1024
    while done < len(order):
        stretch = order[done:done + width]
        slots = (wanted[stretch - 1] & (stretch > 0)).nonzero()[0]
        before = stretch[slots] - 1
        step = len(stretch)
        if len(slots):
            least = np.minimum.accumulate(free[text[before]]) - done
            late = slots[1:] > least[:-1]
            ready = int(late.argmax()) + 1 if late.any() else len(slots)
            step = min(step, int(least[ready - 1]))
            _place(order, free, text, before[:ready])
        done += step
        width = min(max(2 * step, 256), 65_536)


def _induce(text: np.ndarray, small: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from an order of the leftmost S-type ones.

    The scan upwards places the L-type suffixes, the scan downwards the S-type ones.
    """
    n = len(text)
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    order = np.full(n, -1, dtype=np.int64)
    _place(order, ends - np.bincount(text[starts], minlength=len(counts)), text, starts)
    seeds = np.flatnonzero(order >= 0)
    free = ends - counts
    # The last suffix is L type, and only the end of the text is before it.
    _place(order, free, text, np.array([n - 1]))
    _scan(order, free, text, ~small)
    order[seeds] = -1
    _scan(order[::-1], n - ends, text, small)
    return order


def _names(text: np.ndarray, leftmost: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """By leftmost position: the rank of its substring, up to and with the next leftmost position."""
    n = len(text)
    length = np.zeros(n, dtype=np.int64)
    length[leftmost] = np.append(leftmost[1:], n - 1) - leftmost + 1
    a, b = sorted_[:-1], sorted_[1:]
    size = length[a]
    # The last substring runs into the end of the text: no other equals it.
    same = (size == length[b]) & (a != leftmost[-1]) & (b != leftmost[-1])
    pending, offset = np.flatnonzero(same), 0
    while len(pending):
        equal = text[a[pending] + offset] == text[b[pending] + offset]
        same[pending[~equal]] = False
        offset += 1
        pending = pending[equal]
        pending = pending[size[pending] > offset]
    name = np.empty(n, dtype=np.int64)
    name[sorted_] = np.concatenate(([0], np.cumsum(~same)))
    return name[leftmost]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The sorted suffixes of an array of bytes, or of whole numbers from 0.

    Suffixes are classified, the substrings between leftmost S-type ones are sorted by induction
    and named, the text of names (half as long at most) is sorted by recursion if a name repeats,
    and all suffixes are induced from that.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    small = _types(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(leftmost):
        return _induce(text, small, leftmost)
    by = _induce(text, small, leftmost)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[leftmost] = True
    sorted_ = by[is_leftmost[by]]
    names = _names(text, leftmost, sorted_)
    if names.max() + 1 < len(names):
        sorted_ = leftmost[suffix_order(names)]
    return _induce(text, small, sorted_)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By text position: bytes in common with the suffix before it in the order of all suffixes.

    If a suffix and the one before it follow the same byte, their common prefix is that of the
    position before, less one.  Only the others are compared, eight bytes at a time; these have
    2 n log n bytes in common together at most.
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    previous = np.empty(n, dtype=np.int64)
    previous[order[1:]] = order[:-1]
    previous[order[0]] = -1
    compared = np.ones(n, dtype=bool)
    compared[1:] = (previous[1:] < 1) | (text[:-1] != text[previous[1:] - 1])
    padded = np.concatenate((text, np.zeros(16, dtype=np.uint8))).astype(np.uint64)
    eight = np.zeros(n + 8, dtype=np.uint64)
    for k in range(8):
        eight |= padded[k:k + len(eight)] << np.uint64(8 * k)
    at = np.flatnonzero(compared)
    before = previous[at]
    room = np.where(before < 0, 0, n - np.maximum(at, before))  # up to the end of the text
    shared = np.zeros(len(at), dtype=np.int64)
    pending, offset = np.flatnonzero(room), 0
    while len(pending):
        differ = eight[at[pending] + offset] ^ eight[before[pending] + offset]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)) // 8).astype(np.int64))
        shared[pending] = np.minimum(offset + same, room[pending])
        offset += 8
        pending = pending[(same == 8) & (room[pending] > offset)]
    which = np.cumsum(compared) - 1
    return shared[which] - (np.arange(n) - at[which])
