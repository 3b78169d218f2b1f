"""Suffix sorting in numpy, used inside tasks on one bounded shard."""

from __future__ import annotations

import numpy as np


def sort_order(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Order of the pairs (major, minor), both from 0; equal pairs keep their
    order.  Sorts packed words where key and index fit into 63 bits."""
    n = len(major)
    if not n:
        return np.zeros(0, np.int64)
    index, low = int(n - 1).bit_length(), int(minor.max()).bit_length()
    if int(major.max()).bit_length() + low + index <= 63:
        packed = (((major.astype(np.int64) << low) | minor) << index) | np.arange(n)
        packed.sort()
        return packed & ((1 << index) - 1)
    return np.lexsort((minor, major))


def heads(*keys: np.ndarray) -> np.ndarray:
    """For sorted key columns, the index of the first row of each row's group."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(n), 0))


def suffix_array(symbols: np.ndarray, depth: int | None = None, first: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks by Larsson-Sadakane refinement.

    ``symbols`` (from 0) orders the suffixes by their first ``first`` elements;
    each round orders the groups that are still tied by the rank of the suffix
    ``h`` further on, and doubles ``h``.  A suffix that ends sorts before one that
    goes on.  With ``depth`` the refinement ends once suffixes in one group agree
    in ``depth`` elements; a group's rank is the index of its first suffix.
    """
    n = len(symbols)
    sa = sort_order(symbols, np.zeros(n, np.int64))
    rank = np.empty(n, np.int64)
    head = heads(symbols[sa]) if n else sa
    rank[sa] = head
    tied = np.arange(n)
    h = first
    while depth is None or h < depth:
        # places in the array whose group has more than one suffix
        head = rank[sa[tied]]
        same = head[1:] == head[:-1]
        open_ = np.zeros(len(tied), bool)
        open_[1:] |= same
        open_[:-1] |= same
        tied, head = tied[open_], head[open_]
        if not len(tied):
            break
        suffix = sa[tied]
        after = np.zeros(len(suffix), np.int64)
        inside = suffix + h < n
        after[inside] = rank[suffix[inside] + h] + 1
        group = np.cumsum(np.concatenate(([0], head[1:] != head[:-1])))
        order = sort_order(group, after)
        sa[tied] = suffix[order]
        rank[sa[tied]] = tied[heads(group, after[order])]
        h *= 2
    return sa, rank


def byte_view(text: np.ndarray, dtype: str, pad: int = 8) -> np.ndarray:
    """The 8-byte word at every place of a byte array, zeros after its end."""
    padded = np.concatenate((text, np.zeros(pad, np.uint8)))
    return np.ndarray((len(text),), dtype, padded.data, strides=(1,))


def byte_suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of a byte array, ordered by ``depth`` bytes at least."""
    if not len(text):
        return np.zeros(0, np.int64)
    first = (byte_view(text, ">u8") >> np.uint64(24)).astype(np.int64)  # five bytes
    return suffix_array(first, depth, first=5)[0]


def common_prefixes(text: np.ndarray, sa: np.ndarray, enough: int) -> np.ndarray:
    """For each suffix but the first in the array's order, the number of bytes it shares
    with the one before it, exact up to ``enough`` (larger values may be lower bounds).

    By Kasai's lemma, if the predecessors of places i - 1 and i are neighbours too, the
    prefix at i is that at i - 1 less its first byte.  So only the first place of each such run
    is compared byte by byte, as far as the run can use it.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0)
    # the shared first byte
    check = np.flatnonzero(follows)
    follows[check] = text[check - 1] == text[before[check] - 1]
    starts = np.flatnonzero(~follows)
    run = np.diff(np.append(starts, n))
    word = byte_view(text, "<u8")
    shared = np.zeros(len(starts), np.int64)
    left = np.flatnonzero(before[starts] >= 0)
    at = 0
    while len(left):
        i, j = starts[left] + at, before[starts[left]] + at
        room = n - np.maximum(i, j)
        inside = room > 0
        left, i, j, room = left[inside], i[inside], j[inside], room[inside]
        differ = word[i] ^ word[j]
        # equal leading bytes: trailing zero bytes of a little-endian word
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, (np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64))
        same = np.minimum(same, room)
        shared[left] += same
        at += 8
        left = left[(same == 8) & (at < run[left] - 1 + enough)]
    out = np.repeat(shared + starts, run) - np.arange(n)  # by place
    return np.maximum(out, 0)[sa[1:]]


def repeated_windows(text: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Of the given window starts (ascending) those whose ``size`` bytes also start
    at an earlier given place, as a mask."""
    mask = np.zeros(len(text), bool)
    if len(text) < size or not len(places):
        return mask[places]
    sa = byte_suffix_array(text, size)
    together = np.concatenate(([False], common_prefixes(text, sa, size) >= size))
    mask[places] = True
    group = np.cumsum(~together)
    chosen = mask[sa]
    place, group = sa[chosen], group[chosen]
    least = np.full(int(group[-1]) + 1 if len(group) else 1, len(text), np.int64)
    np.minimum.at(least, group, place)
    mask[:] = False
    mask[place[place > least[group]]] = True
    return mask[places]
