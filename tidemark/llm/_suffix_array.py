"""Linear-time suffix sorting by grouping (Baier, 2016), without recursion or renaming.

Suffixes are grouped by their longest Lyndon prefix. Phase 1 processes groups from the highest down: each member's
previous-smaller pointer leads to the suffix that the member's prefix extends, and the suffixes so reached split off,
just above the rest of their group. Phase 2 fills the groups in final order: whatever is placed puts the suffix before it,
and those along that one's pointers, into the next free places of their groups.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of a sequence of integers, in ascending order of the suffixes."""
    n = len(text)
    if not n:
        return []
    first: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        if symbol in first:
            first[symbol].append(i)
        else:
            first[symbol] = [i]
    symbols = sorted(first)
    members: list[list[int]] = [first[s] for s in symbols]
    below: list[int] = list(range(-1, len(members) - 1))
    size = [len(m) for m in members]
    above = [*range(1, len(members)), -1]
    number = {s: g for g, s in enumerate(symbols)}
    group = [number[s] for s in text]
    done = [False] * n
    previous = [-1] * n
    order: list[int] = []
    g = len(members) - 1
    while g >= 0:
        own = members[g]
        if len(own) != size[g]:
            own = [i for i in own if group[i] == g]
        if len(own) > 1:
            own.sort()
        members[g] = own
        order.append(g)
        for i in own:
            done[i] = True
        reached: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                reached[j] = reached.get(j, 0) + 1
        if reached:
            by_times: dict[int, dict[int, list[int]]] = {}
            for j, times in reached.items():
                by_times.setdefault(times, {}).setdefault(group[j], []).append(j)
            for times in sorted(by_times, reverse=True):
                for old, moved in by_times[times].items():
                    if len(moved) == size[old]:
                        continue  # the whole group moves, so it stays what it is
                    new = len(members)
                    members.append(moved)
                    size[old] -= len(moved)
                    size.append(len(moved))
                    over = above[old]
                    above.append(over)
                    below.append(old)
                    above[old] = new
                    if over >= 0:
                        below[over] = new
                    for j in moved:
                        group[j] = new
        g = below[g]
    free = [0] * len(members)
    at = n
    for g in order:
        at -= size[g]
        free[g] = at
    out = [-1] * n
    placed = [False] * n
    j = n - 1
    k = 0
    while True:
        while j >= 0 and not placed[j]:
            placed[j] = True
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            j = previous[j]
        if k == n:
            return out
        j = out[k] - 1
        k += 1


def repeats(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Of the places `starts` (ascending), those whose `length` symbols stand at an earlier one of them too.

    text must hold `length` symbols from each. Neighbours in the suffix array's order that agree that far are one class.
    """
    if len(starts) < 2:
        return np.zeros(len(starts), bool)
    number = np.full(len(text), -1, np.int64)
    number[starts] = np.arange(len(starts))
    ranked = number[np.array(suffix_array(text.tolist()), np.int64)]
    ranked = ranked[ranked >= 0]
    here, before = starts[ranked[1:]], starts[ranked[:-1]]
    same = np.ones(len(here), bool)
    for k in range(length):
        same &= text[here + k] == text[before + k]
    label = np.concatenate([[0], np.cumsum(~same)])
    earliest = np.full(label[-1] + 1, len(starts), np.int64)
    np.minimum.at(earliest, label, ranked)
    out = np.zeros(len(starts), bool)
    out[ranked] = earliest[label] != ranked
    return out
