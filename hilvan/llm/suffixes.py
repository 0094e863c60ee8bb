"""Suffix arrays of shards by induced sorting, and common prefixes in text order.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost
S suffixes of runs are sorted by the substrings between them; equal substrings are told apart
by a recursion on their names. From these the L and then the S suffixes are induced in linear
time. On small alphabets the induction runs bucket by bucket on whole arrays.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 600


def s_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last one (sentinel) is."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    step[-1] = 1
    place = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(place[::-1])[::-1]] > 0


def grouped(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by char, the distinct chars, their counts, and each one's rank in its group."""
    order = np.argsort(chars, kind="stable")
    ordered = chars[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[first, len(ordered)])
    return order, ordered[first], counts, np.arange(len(ordered)) - np.repeat(first, counts)


def induce_arrays(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n = len(text)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    array = np.full(n, -1, dtype=np.int64)
    held = np.bincount(text[lms], minlength=len(sizes))
    array[ends[text[lms]] - np.repeat(held, held) + (np.arange(len(lms)) - np.repeat(np.cumsum(held) - held, held))] = lms
    used = np.flatnonzero(sizes)

    head = starts.copy()

    def push(front: np.ndarray) -> None:
        left = front[front > 0] - 1
        left = left[~is_s[left]]
        if len(left):
            order, chars, counts, rank = grouped(text[left])
            array[np.repeat(head[chars], counts) + rank] = left[order]
            head[chars] += counts

    for c in used.tolist():
        done = starts[c]
        while head[c] > done:
            front = array[done : head[c]].copy()
            done = head[c]
            push(front)
        if held[c]:
            push(array[ends[c] - held[c] : ends[c]].copy())

    tail = ends.copy()

    def push_back(front: np.ndarray) -> None:
        left = front[front > 0] - 1
        left = left[is_s[left]]
        if len(left):
            order, chars, counts, rank = grouped(text[left])
            array[np.repeat(tail[chars], counts) - 1 - rank] = left[order]
            tail[chars] -= counts

    array[0] = n - 1  # the sentinel is the only suffix of its bucket
    for c in used[::-1].tolist():
        if c == 0:
            break
        done = ends[c]
        while tail[c] < done:
            front = array[tail[c] : done][::-1].copy()
            done = tail[c]
            push_back(front)
        push_back(array[starts[c] : head[c]][::-1].copy())
    return array


def induce_lists(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n = len(text)
    chars, small = text.tolist(), is_s.tolist()
    ends = np.cumsum(sizes)
    starts = ends - sizes
    array = [-1] * n
    tail = ends.tolist()
    for i in lms[::-1].tolist():
        c = chars[i]
        tail[c] -= 1
        array[tail[c]] = i
    head = starts.tolist()
    for at in range(n):
        i = array[at] - 1
        if i >= 0 and not small[i]:
            c = chars[i]
            array[head[c]] = i
            head[c] += 1
    tail = ends.tolist()
    for at in range(n - 1, 0, -1):
        i = array[at] - 1
        if i >= 0 and small[i]:
            c = chars[i]
            tail[c] -= 1
            array[tail[c]] = i
    array[0] = n - 1
    return np.array(array, dtype=np.int64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted starts of the suffixes of ``text``, which ends with its only 0."""
    n = len(text)
    if n <= 2:
        return np.arange(n - 1, -1, -1, dtype=np.int64)
    sizes = np.bincount(text)
    induce = induce_arrays if len(sizes) <= SMALL_ALPHABET else induce_lists
    is_s = s_types(text)
    is_lms = is_s.copy()
    is_lms[0] = False
    is_lms[1:] &= ~is_s[:-1]
    lms = np.flatnonzero(is_lms)
    # Any order within a bucket will do to sort the substrings between leftmost S suffixes.
    rough = induce(text, is_s, lms[np.argsort(text[lms], kind="stable")], sizes)
    ranked = rough[is_lms[rough]]
    names, n_names = substring_names(text, lms, ranked)
    if n_names < len(lms):
        order = suffix_array(names)
        ranked = lms[order]
    return induce(text, is_s, ranked, sizes)


def substring_names(text: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the substrings in text order: equal substrings share one, order is kept."""
    place = np.empty(len(text), dtype=np.int64)
    place[lms] = np.arange(len(lms))
    length = np.diff(np.r_[lms, len(text)]) + 1  # up to and with the next leftmost S
    length[-1] = 1
    size = length[place[ranked]]
    differs = np.ones(len(ranked), dtype=bool)
    pairs = np.flatnonzero(size[1:] == size[:-1]) + 1
    widths = size[pairs]
    first = np.cumsum(widths) - widths
    within = np.arange(int(widths.sum())) - np.repeat(first, widths)
    other = text[np.repeat(ranked[pairs], widths) + within] != text[np.repeat(ranked[pairs - 1], widths) + within]
    if len(pairs):
        differs[pairs] = np.logical_or.reduceat(other, first)
    rank = np.cumsum(differs) - 1
    names = np.empty(len(lms), dtype=np.int64)
    names[place[ranked]] = rank
    return names, int(rank[-1]) + 1


def repeated_starts(block: np.ndarray, width: int) -> np.ndarray:
    """True at every start whose next ``width`` bytes start elsewhere in ``block`` too.

    Takes each suffix's predecessor in the suffix array, and computes their common prefixes in
    text order, eight bytes at a time, up to ``width``.
    """
    n = len(block)
    text = np.zeros(n + 1, dtype=np.int64)
    text[:n] = block
    text[:n] += 1
    array = suffix_array(text)[1:]
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    padded = np.zeros(n + width + 16, dtype=np.uint64)
    padded[:n] = block.astype(np.uint64) + np.uint64(1)
    limit = n + width + 8
    eight = np.zeros(limit, dtype=np.uint64)
    for k in range(8):  # nine bits would not fit: the end is kept apart by the bound below
        eight |= (padded[k : limit + k] - np.uint64(1) & np.uint64(255)) << np.uint64(8 * k)
    here = np.flatnonzero(before >= 0)
    here = here[np.maximum(here, before[here]) + width <= n]
    done = 0
    while done < width and len(here):
        step = min(8, width - done)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(64 - 8 * step)
        same = (eight[here + done] ^ eight[before[here] + done]) & mask == 0
        here = here[same]
        done += step
    found = np.zeros(n, dtype=bool)
    found[here] = True
    found[before[here]] = True
    return found
