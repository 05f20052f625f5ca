"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are larger (L) or smaller (S) than their right neighbour; a leftmost S suffix (LMS) follows an L suffix. The
substrings between LMS places are sorted by inducing from them in any order, named by rank, and the string of names is
sorted in turn; inducing once more from the sorted LMS suffixes sorts all. Each bucket of a character is induced at
once: what its suffixes say about the ones to their left is dealt to the other buckets in order.
"""

from __future__ import annotations

import numpy as np

# Strings of names with more different names than this are sorted by doubling their ranks: a turn for each bucket would
# take longer than the sorting.
MOST_BUCKETS = 4096


def _types(t: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last character is the only smallest one."""
    n = len(t)
    differ = t[:-1] != t[1:]
    at = np.where(differ, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(n, dtype=bool)
    small[:-1] = (t[:-1] < t[1:])[following]
    return small


def _deal(places: np.ndarray, chars: np.ndarray, waiting: list[list[np.ndarray]]) -> None:
    """Append places to the buckets of their characters, keeping their order."""
    if not len(places):
        return
    order = np.argsort(chars, kind="stable")
    chars, places = chars[order], places[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    for char, part in zip(chars[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts), strict=True):
        waiting[char].append(part)


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, sorted from the order of the LMS suffixes within their buckets."""
    starts: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(lms, t[lms], starts)
    larger: list[np.ndarray] = []
    empty = np.zeros(0, dtype=lms.dtype)

    def turn(char: int, waiting: list[list[np.ndarray]], kind: bool) -> np.ndarray:
        """The bucket's own suffixes of a kind, as they become known; all others that they lead to are dealt out."""
        found, now = [], np.concatenate(waiting[char]) if waiting[char] else empty
        while len(now):
            found.append(now)
            now = lead(now, char, waiting, kind)
        return np.concatenate(found) if found else empty

    def lead(now: np.ndarray, char: int, waiting: list[list[np.ndarray]], kind: bool) -> np.ndarray:
        left = now[now > 0] - 1
        left = left[small[left] == kind]
        chars = t[left]
        own = chars == char
        _deal(left[~own], chars[~own], waiting)
        return left[own]

    waiting: list[list[np.ndarray]] = [[] for _ in range(size)]
    for char in range(size):
        larger.append(turn(char, waiting, False))
        if starts[char]:
            lead(np.concatenate(starts[char]), char, waiting, False)
    waiting = [[] for _ in range(size)]
    waiting[int(t[-1])].append(np.array([len(t) - 1], dtype=lms.dtype))
    buckets: list[np.ndarray] = [empty] * size
    for char in range(size - 1, -1, -1):
        smaller = turn(char, waiting, True)
        lead(larger[char][::-1], char, waiting, True)
        buckets[char] = np.concatenate([larger[char], smaller[::-1]])
    return np.concatenate(buckets)


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank of each LMS substring, equal for equal ones, in the order of ``ordered``."""
    ends = np.zeros(len(t), dtype=np.int64)
    ends[lms[:-1]] = lms[1:] - lms[:-1] + 1
    ends[lms[-1]] = 1
    length = ends[ordered]
    same = np.zeros(len(ordered), dtype=bool)
    rows = np.flatnonzero(length[1:] == length[:-1]) + 1
    depth = 0
    while len(rows):
        done = length[rows] <= depth
        same[rows[done]] = True
        rows = rows[~done]
        rows = rows[t[ordered[rows] + depth] == t[ordered[rows - 1] + depth]]
        depth += 1
    return np.cumsum(~same) - 1


def _by_doubling(ranks: np.ndarray) -> np.ndarray:
    """Suffix array of a string of ranks, by sorting pairs of places at doubling distances.

    A suffix's place is the number of suffixes known to be smaller. Only those that share their place are sorted again.
    """
    n, step = len(ranks), 1
    counts = np.bincount(ranks)
    place = (np.cumsum(counts) - counts)[ranks]
    rows = np.flatnonzero(counts[ranks] > 1)
    while len(rows) and step < n:
        after = rows + step
        following = np.where(after < n, place[np.minimum(after, n - 1)] + 1, 0)
        keys = (place[rows] << 32) | following
        order = np.argsort(keys)
        keys, rows = keys[order], rows[order]
        old, at = keys >> 32, np.arange(len(rows))
        head = np.concatenate([[True], old[1:] != old[:-1]])
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        place[rows] = old + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        rows = rows[~(fresh & np.concatenate([fresh[1:], [True]]))]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[place] = np.arange(n)
    return order


def suffix_array(t: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of ``t``, numbers below ``size`` whose last one is the only smallest one."""
    if len(t) == 1:
        return np.zeros(1, dtype=np.int64)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    first = _induce(t, small, lms, size)
    marked = np.zeros(len(t), dtype=bool)
    marked[lms] = True
    ordered = first[marked[first]]
    names = _names(t, lms, ordered)
    if names[-1] < len(lms) - 1:
        rank = np.zeros(len(t), dtype=np.int64)
        rank[ordered] = names
        count = int(names[-1]) + 1
        reduced = rank[lms]
        ordered = lms[suffix_array(reduced.astype(np.uint16), count) if count <= MOST_BUCKETS else _by_doubling(reduced)]
    return _induce(t, small, ordered, size)


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number; zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    out = np.empty(len(data) + 8, dtype=np.uint64)
    for k in range(8):
        part = padded[k : k + (len(padded) - k) // 8 * 8].view("<u8")[: len(out[k::8])]
        out[k::8][: len(part)] = part
    return out[: len(data)]


def prefixes_reach(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``order`` (some places of a suffix array, in its order): whether the common prefix with the
    place before it has ``length`` bytes at least.

    Permuted: place by place as they stand in the text, where each knows its predecessor, so that the text is read in
    order; all places of ``order`` must have ``length`` bytes after them.
    """
    words = words_at(data)
    before = np.full(len(data), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    places = np.flatnonzero(before >= 0)
    same, other = np.ones(len(places), dtype=bool), before[places]
    steps = [*range(0, length - 7, 8), length - 8] if length >= 8 else []
    for k in steps:
        same &= words[places + k] == words[other + k]
    for k in range(length if length < 8 else 0):
        same &= data[places + k] == data[other + k]
    reach = np.zeros(len(data), dtype=bool)
    reach[places] = same
    return reach[order]
