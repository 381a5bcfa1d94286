"""The suffix array of one shard of text by induced sorting, and its permuted common
prefixes, in numpy.

A suffix is of type S if it is smaller than the next one, else of type L; an S suffix
after an L suffix is a leftmost S one. Sorted leftmost S suffixes induce the order of
all others in two scans of the buckets of first letters, each linear: L types from the
left, S types from the right. Buckets are worked on whole: what a bucket's suffixes induce
is dealt out to the other buckets in one stable step, and what they induce in their own
bucket is the next step.

The order of the leftmost S suffixes themselves comes from the same induction over their
substrings: unsorted seeds induce the order of the substrings between leftmost S places,
equal ones get equal names, and the string of names is sorted recursively. Where the
names are over ``MOST_LETTERS``, buckets hold next to nothing each; from there the names
are sorted by naming pairs of names until all differ.
"""

from __future__ import annotations

import numpy as np

#: Largest alphabet that is induced bucket by bucket.
MOST_LETTERS = 4096


def suffix_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the empty suffix is the least."""
    smaller = np.zeros(len(t), bool)
    turns = np.flatnonzero(t[1:] != t[:-1])
    if len(turns):
        kinds = t[turns] < t[turns + 1]
        smaller[: turns[-1] + 1] = np.repeat(kinds, np.diff(np.concatenate(([-1], turns))))
    return smaller


def induced(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in the order that ``seeds``, the leftmost S places in some order,
    induces."""
    n = len(t)
    sizes = np.bincount(t, minlength=letters)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    out = np.empty(n, np.int32)
    seed_sizes = np.bincount(t[seeds], minlength=letters)
    seeds = seeds[np.argsort(t[seeds], kind="stable")]
    seed_ends = np.cumsum(seed_sizes).tolist()
    at = heads.tolist()
    begins = list(at)
    used = np.flatnonzero(sizes).tolist()

    def deal(places: np.ndarray) -> None:
        """The L types before ``places``, to the fronts of their buckets."""
        before = places - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if not len(before):
            return
        first = t[before]
        order = np.argsort(first, kind="stable")
        before = before[order]
        counts = np.bincount(first)
        done = 0
        for c in np.flatnonzero(counts).tolist():
            k = int(counts[c])
            out[at[c] : at[c] + k] = before[done : done + k]
            at[c] += k
            done += k

    deal(np.array([n], np.int32))
    for c in used:
        done = begins[c]
        while done < at[c]:
            part = out[done : at[c]]
            done = at[c]
            deal(part)
        if seed_sizes[c]:
            deal(seeds[seed_ends[c] - int(seed_sizes[c]) : seed_ends[c]])
    larger_ends = list(at)
    at = ends.tolist()

    def deal_back(places: np.ndarray) -> None:
        """The S types before ``places``, which come in falling order, to the backs."""
        before = places - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if not len(before):
            return
        first = t[before]
        order = np.argsort(first, kind="stable")
        before = before[order]
        counts = np.bincount(first)
        done = 0
        for c in np.flatnonzero(counts).tolist():
            k = int(counts[c])
            out[at[c] - k : at[c]] = before[done : done + k][::-1]
            at[c] -= k
            done += k

    for c in reversed(used):
        done = int(ends[c])
        while done > at[c]:
            part = out[at[c] : done][::-1]
            done = at[c]
            deal_back(part.copy())
        if larger_ends[c] > begins[c]:
            deal_back(out[begins[c] : larger_ends[c]][::-1].copy())
    return out


def _same_substrings(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether t[a:a + length] equals t[b:b + length], pair by pair."""
    same = np.ones(len(a), bool)
    if t.dtype == np.uint8:
        words, width = eight_bytes(t), 8
    else:
        words, width = t, 1
    live = np.arange(len(a))
    done = 0
    while len(live):
        x = words[a[live] + done]
        y = words[b[live] + done]
        if width == 8:
            rest = np.minimum(length[live] - done, 8).astype(np.uint64)
            differs = ((x ^ y) << ((np.uint64(8) - rest) * np.uint64(8))) != 0
        else:
            differs = x != y
        same[live[differs]] = False
        done += width
        live = live[~differs & (length[live] > done)]
    return same


def eight_bytes(t: np.ndarray) -> np.ndarray:
    """At each place the 8 bytes from there on, as one number; the text goes on with zeros."""
    padded = np.concatenate((t, np.zeros(8, np.uint8)))
    return np.ndarray((len(t) + 1,), "<u8", padded, strides=(1,))


def sorted_by_pairs(names: np.ndarray) -> np.ndarray:
    """The suffixes of ``names`` in order: names of pairs, of pairs of pairs and so on."""
    order = np.argsort(names, kind="stable").astype(np.int64)
    n = len(names)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    new = np.concatenate(([True], names[order[1:]] != names[order[:-1]]))
    starts = np.flatnonzero(new)
    rank[order] = np.repeat(starts, np.diff(np.concatenate((starts, [n]))))
    step = 1
    while True:
        sorted_ranks = rank[order]
        tied = np.zeros(n, bool)
        tied[1:] = sorted_ranks[1:] == sorted_ranks[:-1]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        places, first = order[at], sorted_ranks[at]
        second = rank[np.minimum(places + step, n)]
        pair = first * (n + 1) + second + 1
        o = np.argsort(pair)
        places, pair = places[o], pair[o]
        order[at] = places
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        starts = np.flatnonzero(new)
        rank[places] = np.repeat(at[starts], np.diff(np.concatenate((starts, [len(at)]))))
        step *= 2


def suffix_array(t: np.ndarray, letters: int = 256) -> np.ndarray:
    """The places of the suffixes of ``t`` (numbers below ``letters``) in their order."""
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    smaller = suffix_types(t)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + 1
    if len(leftmost) > 1:
        order = induced(t, smaller, leftmost, letters)
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        order = order[is_leftmost[order]]
        # Names of the substrings from one leftmost S place to the next, both included.
        size = np.zeros(n, np.int64)
        size[leftmost] = np.diff(np.concatenate((leftmost, [n]))) + 1
        size[leftmost[-1]] = 0  # it meets the end of the text and equals no other
        a, b = order[:-1], order[1:]
        same = (size[a] == size[b]) & (size[a] > 0)
        among = np.flatnonzero(same)
        same[among] = _same_substrings(t, a[among], b[among], size[a[among]])
        name = np.empty(n, np.int32)
        names = np.cumsum(np.concatenate(([0], ~same)))
        name[order] = names
        distinct = int(names[-1]) + 1
        if distinct < len(leftmost):
            reduced = name[leftmost]
            if distinct <= MOST_LETTERS:
                leftmost = leftmost[suffix_array(reduced, distinct)]
            else:
                leftmost = leftmost[sorted_by_pairs(reduced)]
        else:
            leftmost = order
    return induced(t, smaller, leftmost, letters)


def permuted_prefixes(t: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """For each place the length, up to ``most``, that its suffix has in common with the one
    before it in ``order``, ends of pieces aside.

    A place's value is at least the value before it less one, so it is compared from there
    on. The pieces of the text (of ``sizes`` bytes from ``starts``) go forward together,
    eight bytes at a time."""
    words = eight_bytes(t)
    before = np.full(len(t), -1, np.int32)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(t), np.int32)
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    have = np.zeros(len(starts), np.int64)
    for j in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -j, side="left"))  # pieces longer than j
        place = starts[:live] + j
        other = before[place].astype(np.int64)
        have = np.maximum(have[:live] - 1, 0)
        have[other < 0] = 0
        todo = np.flatnonzero((other >= 0) & (have < most))
        while len(todo):
            k = have[todo]
            p, q = place[todo] + k, other[todo] + k
            inside = np.maximum(p, q) < len(t)
            p, q = np.minimum(p, len(t)), np.minimum(q, len(t))
            differ = words[p] ^ words[q]
            low = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) >> 3)
            equal = np.minimum(equal, len(t) - np.maximum(p, q))
            have[todo] = np.minimum(k + equal, most)
            todo = todo[(equal == 8) & inside & (have[todo] < most)]
        out[place] = have
    return out
