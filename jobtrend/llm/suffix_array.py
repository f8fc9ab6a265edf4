"""Suffix arrays by linear grouping, for many short texts side by side.

First the suffixes are grouped by their longest Lyndon prefix. Groups start as first symbols
and are taken from the highest down: for each member its previous smaller position is the
nearest one to its left that lies in a lower group, found by following such pointers of
groups taken before. The positions so reached are cut out of their groups, by how many members
reached them, into new groups just behind: their prefixes grow by that many copies of the
group's prefix. Then groups are emitted in ascending order. A suffix is its Lyndon prefix and the
suffix behind it, which is smaller; so members of a group are ordered by how often
the prefix repeats and then by the place of the suffix behind, which is known already. Nothing is renamed.

All texts take each step together, one group of each text at a time, as numpy operations over the
members of these groups. A text of n symbols takes as many steps as it has groups.
"""

from __future__ import annotations

import numpy as np

from jobtrend.llm.common import spread


def suffix_arrays(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the texts in order, text by text, as places in their concatenation; and where texts start.

    Symbols are whole numbers from 0 to 1023; the last symbol of a text must occur once in it and be its smallest.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    front = np.cumsum(sizes + 1) - sizes - 1  # before each text stands a place below all groups
    total = int((sizes + 1).sum())
    block = np.repeat(np.arange(len(texts)), sizes + 1)
    symbol = np.zeros(total, np.int64)
    inside = np.ones(total, bool)
    inside[front] = False
    symbol[inside] = np.concatenate(texts) + 1
    key = block * 1025 + symbol
    array = np.argsort(key, kind="stable")
    place = np.empty(total, np.int64)
    place[array] = np.arange(total)
    ordered = key[array]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.zeros(total, np.int64)
    size[starts] = np.diff(np.append(starts, total))
    group = np.empty(total + 1, np.int64)
    group[array] = np.repeat(starts, size[starts])
    group[total] = -1
    length = np.ones(total, np.int64)
    before = np.arange(-1, total - 1)
    chosen = np.zeros(total, bool)

    low, high = front + 1, front + sizes + 1
    active = np.flatnonzero(high > low)
    prefix = np.zeros(len(texts), np.int64)
    while len(active):
        top = high[active]
        last = array[top - 1]
        first = group[last]
        prefix[active] = length[last]
        owner, k = spread(top - first)
        members = array[first[owner] + k]
        floor = first[owner]
        left = members - 1
        going = np.flatnonzero(group[left] >= floor)
        while len(going):
            before[members] = left
            left[going] = before[left[going]]
            going = going[group[left[going]] >= floor[going]]
        before[members] = left
        left = left[inside[left]]
        high[active] = first
        active = active[first > low[active]]
        if not len(left):
            continue
        left.sort()
        cut = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
        reached, times = left[cut], np.diff(np.append(cut, len(left)))
        length[reached] += times * prefix[block[reached]]
        old = group[reached]
        order = np.lexsort((times, old))
        reached, times, old = reached[order], times[order], old[order]
        cut = np.concatenate([[True], old[1:] != old[:-1]])
        at = np.flatnonzero(cut)
        number = np.diff(np.append(at, len(old)))
        limit = (old[at] + size[old[at]] - number).repeat(number)  # where the moved ones of a group begin
        target = limit + np.arange(len(old)) - at.repeat(number)
        chosen[reached] = True
        there, source = array[target], place[reached]
        staying = there[~chosen[there]]
        free = source[source < limit]
        array[free], place[staying] = staying, free
        array[target], place[reached] = reached, target
        chosen[reached] = False
        size[old[at]] -= number
        cut[1:] |= times[1:] != times[:-1]
        at = np.flatnonzero(cut)
        number = np.diff(np.append(at, len(old)))
        size[target[at]] = number
        group[reached] = target[at].repeat(number)

    rank = np.full(total + 1, -1, np.int64)
    whole = np.flatnonzero((group[array] == np.arange(total)) & inside[array])  # where groups begin
    alone = whole[size[whole] == 1]
    rank[array[alone]] = alone
    several = whole[size[whole] > 1]
    of = block[array[several]]
    turn = np.arange(len(several)) - np.searchsorted(of, np.arange(len(texts)))[of] if len(several) else several
    by_turn = np.argsort(turn, kind="stable")
    ends = np.searchsorted(turn[by_turn], np.arange(int(turn.max()) + 1 if len(turn) else 0), side="right")
    begin = 0
    for end in ends:
        first = several[by_turn[begin:end]]
        begin = end
        owner, k = spread(size[first])
        members = array[first[owner] + k]
        behind, depth = members + length[members], np.zeros(len(members), np.int64)
        same = np.flatnonzero(group[behind] == first[owner])
        while len(same):
            depth[same] += 1
            behind[same] += length[behind[same]]
            same = same[group[behind[same]] == first[owner[same]]]
        order = np.lexsort((rank[behind], depth, owner))
        slots = first[owner] + k
        array[slots] = members[order]
        rank[members[order]] = slots
    array = array[inside[array]]
    return array - block[array] - 1, front - np.arange(len(texts))
