"""Suffix arrays by induced sorting, and common prefixes in text order.

The steps of the linear construction: classify every suffix as smaller or larger than its
right neighbour; sort the leftmost-smaller substrings by one induction; name them; sort the
string of names by recursion where names repeat; induce all suffixes from that order.

An induction scans bucket by bucket. Over a byte alphabet all entries of a bucket known so
far are handled as one numpy step; over names, whose buckets are short, entry by entry.
Places are 32-bit numbers in flat arrays as long as the string allows it.
"""

from __future__ import annotations

from array import array

import numpy as np


def _places(n: int) -> type:
    """The narrowest type for places in a string of ``n`` symbols."""
    return np.int32 if n < 1 << 31 else np.int64


def _smaller(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one starting next; the last counts as smaller."""
    n = len(text)
    rises = np.append(text[1:] > text[:-1], True)
    # equal neighbours take the kind of the next differing pair
    at = np.arange(n, dtype=_places(n))
    at[:-1][text[1:] == text[:-1]] = n
    np.minimum.accumulate(at[::-1], out=at[::-1])
    return rises[at]


def _induce_by_bucket(text: np.ndarray, small: np.ndarray, heads: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n, kinds = len(text), len(heads) - 1
    order = np.full(n, -1, _places(n))
    tails = heads[1:].copy()

    def place(found: np.ndarray, fill: np.ndarray, step: int) -> None:
        """Put found suffixes, in this order, at the fronts (or backs) of their buckets."""
        key = text[found]
        by = np.argsort(key, kind="stable")
        found, key = found[by], key[by]
        count = np.bincount(key, minlength=kinds)
        nth = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
        order[np.repeat(fill, count) + step * nth - (step < 0)] = found
        fill += step * count

    seen = np.flatnonzero(np.diff(heads))
    seeded = tails.copy()
    place(seeds[::-1], seeded, -1)
    front = heads[:-1].copy()

    def before(entries: np.ndarray, want_small: bool) -> np.ndarray:
        left = entries[entries > 0] - 1
        return left[small[left] == want_small]

    for c in seen:
        done = heads[c]
        while done < front[c]:
            upto = front[c]
            found = before(order[done:upto], False)
            done = upto
            if len(found):
                place(found, front, 1)
        found = before(order[seeded[c] : tails[c]], False)
        if len(found):
            place(found, front, 1)
    back = tails.copy()
    for c in seen[::-1]:
        done = tails[c]
        while done > back[c]:
            upto = back[c]
            found = before(order[upto:done][::-1], True)
            done = upto
            if len(found):
                place(found, back, -1)
        found = before(order[heads[c] : front[c]][::-1], True)
        if len(found):
            place(found, back, -1)
    # the last suffix has no right neighbour to induce it
    order[heads[text[n - 1]]] = n - 1
    return order


def _induce_by_entry(text: np.ndarray, small: np.ndarray, heads: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n = len(text)
    order = array(_places(n)(0).dtype.char, [-1]) * n
    front, back = heads[:-1].tolist(), heads[1:].tolist()
    fill = list(back)
    for i, c in zip(reversed(seeds.tolist()), reversed(text[seeds].tolist())):
        fill[c] -= 1
        order[fill[c]] = i
    # symbol to the left where it starts a suffix of the kind wanted, else -1; the spare place at
    # the end answers for places of the order that are still empty (-1)
    left = np.full(n + 1, -1, _places(n))
    left[1:n] = np.where(small[:-1], -1, text[:-1])
    wanted = memoryview(left)
    for i in order:
        c = wanted[i]
        if c >= 0:
            at = front[c]
            order[at] = i - 1
            front[c] = at + 1
    left[1:n] = np.where(small[:-1], text[:-1], -1)
    for i in reversed(order):
        c = wanted[i]
        if c >= 0:
            at = back[c] - 1
            order[at] = i - 1
            back[c] = at
    order[0] = n - 1
    return np.frombuffer(order, _places(n))


def _names(text: np.ndarray, starts: np.ndarray, sorted_starts: np.ndarray) -> np.ndarray:
    """For leftmost-smaller substrings in sorted order: equal neighbours get equal numbers."""
    length = np.zeros(len(text), _places(len(text)))
    length[starts[:-1]] = np.diff(starts) + 1
    length[starts[-1]] = 1
    a, b = sorted_starts[:-1], sorted_starts[1:]
    new = length[a] != length[b]
    open_ = np.flatnonzero(~new)
    k = 0
    while len(open_):
        differs = text[a[open_] + k] != text[b[open_] + k]
        new[open_[differs]] = True
        k += 1
        open_ = open_[~differs & (length[a[open_]] > k)]
    return np.concatenate([[0], np.cumsum(new)])


def suffix_array(text: np.ndarray, kinds: int) -> np.ndarray:
    """Of a string that ends in its one least symbol 0; symbols are below ``kinds``."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    heads = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds))])
    small = _smaller(text)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _induce_by_bucket if kinds <= 1024 and n >= 4096 else _induce_by_entry
    order = induce(text, small, heads, starts)
    leftmost = np.zeros(n, bool)
    leftmost[starts] = True
    ranked = order[leftmost[order]]
    names = _names(text, starts, ranked)
    if names[-1] + 1 < len(starts):
        name_at = np.zeros(n, _places(n))
        name_at[ranked] = names
        ranked = starts[suffix_array(name_at[starts], int(names[-1]) + 1)]
    return induce(text, small, heads, ranked)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By position: how many symbols the suffix shares with the one before it in sorted order.

    Where the symbol to the left is the same for both, the length is that of the position to
    the left less one; only the other positions are compared symbol by symbol.
    """
    n = len(text)
    before = np.full(n, -1, _places(n))
    before[order[1:]] = order[:-1]
    own = np.arange(n, dtype=_places(n))
    start = np.ones(n, bool)
    inner = (own > 0) & (before > 0)
    start[inner] = text[own[inner] - 1] != text[before[inner] - 1]
    start[before < 0] = True
    at = np.flatnonzero(start & (before >= 0))
    length = np.zeros(n, _places(n))
    other, k = before[at], 0
    while len(at):
        inside = np.maximum(at, other) + k < n
        at, other = at[inside], other[inside]
        same = text[at + k] == text[other + k]
        at, other = at[same], other[same]
        length[at] += 1
        k += 1
    last = np.maximum.accumulate(np.where(start, own, 0))
    return np.maximum(length[last] - (own - last), 0)
