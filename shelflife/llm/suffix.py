"""Generalised suffix arrays of many short pieces, in numpy.

The pieces lie one after another in ``text``; a suffix ends with its piece, and equal
suffixes are ordered by piece, as if every piece ended in a separator of its own.
"""

from __future__ import annotations

import numpy as np

FIRST = 5  # bytes that the first sort looks at; they and an index fit into 64 bits


def sort_keys(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned keys; packed with their index where there is room."""
    n = len(keys)
    room = 64 - int(n).bit_length()
    if n and int(keys.max()) >> room == 0:
        shift = np.uint64(64 - room)
        packed = np.sort(keys << shift | np.arange(n, dtype=np.uint64))
        return (packed & np.uint64((1 << (64 - room)) - 1)).astype(np.int64)
    return np.argsort(keys, kind="stable")


def suffix_array(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; ``ends[i]`` is where the piece of i ends.

    Larsson-Sadakane refinement: suffixes are grouped by their first bytes; each round
    orders the members of a group by the group of the suffix that follows as many bytes
    later, so the sorted length doubles, and only groups of several members go on.
    """
    n = len(text)
    place = np.arange(n)
    rest = ends - place
    keys = np.zeros(n, np.uint64)
    for j in range(FIRST):
        inside = rest > j
        byte = np.zeros(n, np.uint64)
        byte[inside] = text[place[inside] + j].astype(np.uint64) + np.uint64(1)
        keys = keys * np.uint64(257) + byte
    order = sort_keys(keys)
    group = np.empty(n, np.int64)  # of each position: where its group begins in the order
    new = np.ones(n, bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    begin = np.maximum.accumulate(np.where(new, place, 0))
    group[order] = begin
    h = FIRST
    longest = int(rest.max(initial=0))
    alone = new & np.append(new[1:], True)
    active = order[~alone]
    while h < longest and len(active):
        later = np.where(rest[active] > h, group[np.minimum(active + h, n - 1)] + 1, 0)
        keys = group[active].astype(np.uint64) * np.uint64(n + 1) + later.astype(np.uint64)
        by = sort_keys(keys)
        active, keys = active[by], keys[by]
        old = group[active]
        first = np.ones(len(active), bool)
        first[1:] = old[1:] != old[:-1]
        new = np.ones(len(active), bool)
        new[1:] = keys[1:] != keys[:-1]
        index = np.arange(len(active))
        begin = np.maximum.accumulate(np.where(first, index, 0))
        inner = np.maximum.accumulate(np.where(new, index, 0))
        group[active] = old + inner - begin
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        h *= 2
    # Suffixes still together are equal: by position, that is by piece.
    return sort_keys(group.astype(np.uint64))


def common_prefixes(
    text: np.ndarray, starts: np.ndarray, stops: np.ndarray, order: np.ndarray, least: int = 1
) -> np.ndarray:
    """Length shared by each suffix of the order with the one before it (0 for the first).

    Suffixes shorter than ``least`` are passed over, with 0.

    Kasai's walk, all pieces abreast: the prefix that a suffix shares with its
    predecessor is at most one byte shorter for the suffix one byte later.
    """
    n = len(text)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    ends = np.repeat(stops, stops - starts)
    shared = np.zeros(n, np.int64)
    length = np.zeros(len(starts), np.int64)
    lanes = np.arange(len(starts))
    for step in range(int((stops - starts).max(initial=0)) - least + 1):
        lanes = lanes[starts[lanes] + step + least <= stops[lanes]]
        i = starts[lanes] + step
        before = rank[i] - 1
        j = order[np.maximum(before, 0)]
        here = np.where(before < 0, 0, np.maximum(length[lanes] - 1, 0))
        limit = np.where(before < 0, 0, np.minimum(ends[i] - i, ends[j] - j))
        going = np.flatnonzero(here < limit)
        while len(going):
            same = text[i[going] + here[going]] == text[j[going] + here[going]]
            going = going[same]
            here[going] += 1
            going = going[here[going] < limit[going]]
        length[lanes] = here
        shared[rank[i]] = here
    return shared
