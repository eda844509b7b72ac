"""Suffix arrays by linear grouping.

Suffixes are grouped by their Lyndon prefixes.  The groups are processed from the largest down: each member
finds the nearest earlier suffix of a smaller group (a previous-smaller pointer), whose prefix the member's
own prefix extends, so that suffix moves into a new group right behind its old one.  Afterwards one pass from
the smallest suffix up places every suffix in its group by following the same pointers.  Nothing is renamed or
sorted recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int]) -> list[int]:
    """Order of the suffixes of ``symbols`` (whole numbers above 0); a shorter suffix comes before its extensions."""
    n = len(symbols) + 1  # with an end mark below all symbols
    if n == 1:
        return []
    text = np.zeros(n, dtype=np.int64)
    text[:-1] = symbols
    first = np.argsort(text, kind="stable")
    ranked = text[first]
    starts = np.r_[True, ranked[1:] != ranked[:-1]]
    begin = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    order = first.tolist()
    group_of = np.zeros(n, dtype=np.int64)
    group_of[first] = begin
    group = group_of.tolist()
    size = np.bincount(begin, minlength=n).tolist()
    place = np.argsort(first, kind="stable").tolist()
    smaller = [-1] * n

    high = n
    while high > 0:
        low = group[order[high - 1]]
        members = order[low:high]
        high = low
        if len(members) > 1:
            members.sort()
        counts: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        if not counts:
            continue
        by_count: dict[int, list[int]] = {}
        for p, k in counts.items():
            by_count.setdefault(k, []).append(p)
        # More repeats of the extension are larger, because something smaller than it follows the last one.
        for k in sorted(by_count, reverse=True):
            moved = by_count[k]
            for p in moved:
                g = group[p]
                size[g] -= 1
                to, at = g + size[g], place[p]
                other = order[to]
                order[to], order[at] = p, other
                place[p], place[other] = to, at
            fresh: dict[int, int] = {}
            for p in moved:
                g = group[p]
                if g not in fresh:
                    fresh[g] = g + size[g]
            for p in moved:
                group[p] = fresh[group[p]]
            for p in moved:
                size[group[p]] += 1

    free = list(range(n))  # next place of the group that starts here
    placed = [False] * n
    result = [0] * n
    result[0] = n - 1
    placed[n - 1] = True
    for at in range(n):
        j = result[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            result[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = smaller[j]
    return result[1:]


def common_prefixes(symbols: list[int], order: list[int], stop: int) -> list[int]:
    """Symbols that each suffix shares with the one before it in ``order``, up to the symbol ``stop``."""
    n = len(symbols)
    rank = [0] * n
    for at, i in enumerate(order):
        rank[i] = at
    shared, out = 0, [0] * n
    for i in range(n):
        if rank[i] == 0:
            shared = 0
            continue
        j = order[rank[i] - 1]
        most = n - max(i, j)
        while shared < most and symbols[i + shared] == symbols[j + shared] != stop:
            shared += 1
        out[rank[i]] = shared
        if shared:
            shared -= 1
    return out
