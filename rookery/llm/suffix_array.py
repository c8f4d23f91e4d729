"""Suffix array by linear grouping construction."""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int], list[list[int]]]:
    """Suffixes grouped by their Lyndon prefix.

    Returns the previous smaller suffix of each suffix (-1: none), the group
    of each, and the groups in ascending order.

    Suffixes start in groups of their first symbol.  Groups are processed in
    descending order: what is not processed yet is smaller, so positions are
    linked in a list, a group's members leave it from left to right, and what
    then stands left of a member is its previous smaller suffix.  A suffix that
    this makes the previous one of k members has the group's prefix k times
    behind its own.  It moves to a new group above its old one, higher for a
    larger k.  Each suffix is linked, unlinked and pointed at once: linear.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(text[order])) + 1)
    members = [part.tolist() for part in parts]
    groups = np.empty(n, np.int64)
    groups[order] = np.repeat(np.arange(len(parts)), list(map(len, parts)))
    group = groups.tolist()
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    # Entry n is the end of the list of positions, entry -1 (the last) its start.
    left = [*range(-1, n), 0]
    right = [*range(1, n + 1), 0, 0]
    left.append(0)
    descending: list[int] = []
    g = len(members) - 1
    while g >= 0:
        held = [s for s in members[g] if group[s] == g]
        if not held:
            g = below[g]
            continue
        members[g] = held
        descending.append(g)
        moved: dict[tuple[int, int], list[int]] = {}
        last, times = -1, 0
        for s in held:
            p, r = left[s], right[s]
            right[p] = r
            left[r] = p
            if p == last:
                times += 1
                continue
            if last >= 0:
                moved.setdefault((group[last], times), []).append(last)
            last, times = p, 1
        if last >= 0:
            moved.setdefault((group[last], times), []).append(last)
        # Larger k first: each new group goes directly above its old one.
        for (old, _), part in moved.items() if len(moved) == 1 else sorted(moved.items(), key=lambda x: -x[0][1]):
            new, upper = len(members), above[old]
            members.append(part)
            below.append(old)
            above.append(upper)
            above[old] = new
            below[upper] = new
            for s in part:
                group[s] = new
        g = below[g]
    descending.reverse()
    return left[:n], group, [members[g] for g in descending]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; the last symbol must be smaller than all others and occur once.

    Groups give each suffix its part of the order.  Within the parts, suffixes
    are emitted in the order of the suffix behind their Lyndon prefix: once a
    suffix stands, those whose next smaller suffix it is follow, which are the
    position before it and the previous smaller ones of that, as far as they do not stand yet.
    """
    n = len(text)
    previous, group, ordered = lyndon_groups(text)
    free: dict[int, int] = {}
    at = 0
    for part in ordered:
        free[group[part[0]]] = at
        at += len(part)
    found = [0] * n
    stands = bytearray(n)
    found[0] = n - 1
    stands[n - 1] = 1
    for i in range(n):
        s = found[i] - 1
        while s >= 0 and not stands[s]:
            g = group[s]
            k = free[g]
            found[k] = s
            free[g] = k + 1
            stands[s] = 1
            s = previous[s]
    return np.array(found, np.int64)
