"""Hamming self-join of 64-bit codes by a simultaneous descent of binary tries.

A sorted array of codes is a binary trie: a node is a run of codes with a
common prefix, its children are the run's halves by the next bit. The join
descends pairs of nodes level by level, adds one to a pair's error count
where the two children differ in the bit, and drops the pair once the count
exceeds the budget. All pairs of a level are advanced together with numpy,
block by block, so memory is bounded.

The result is not the pairs (a dense cluster of n codes has n * n / 2) but a
forest with the same connected components. Budgets are raised step by step,
and a pair of nodes whose codes are all linked to each other already is
dropped, so a dense cluster costs little after its closest codes are linked.
"""

from __future__ import annotations

import numpy as np

BLOCK_PAIRS = 1 << 19  # node pairs advanced at a time


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest member index) after linking a[i] with b[i]."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up


def linked(codes: np.ndarray, groups: np.ndarray, budget: int, bits: int = 64) -> np.ndarray:
    """For codes sorted by (group, code): the index of the smallest code's
    position each code is connected to, by links of at most ``budget``
    differing bits between codes of the same group.

    ``bits``: how many low bits of the codes take part (the higher ones are
    equal within each group).
    """
    n = len(codes)
    labels = np.arange(n)
    if n < 2:
        return labels
    new_group = np.r_[True, groups[1:] != groups[:-1]]
    new_code = new_group | np.r_[True, codes[1:] != codes[:-1]]
    labels = np.maximum.accumulate(np.where(new_code, labels, 0))  # equal codes
    starts = np.flatnonzero(new_group)
    ends = np.r_[starts[1:], n]
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    for most in range(1, budget + 1):
        # stack of (level, node a start, end, node b start, end, errors)
        zero = np.zeros(len(starts), dtype=np.int8)
        todo = [(0, starts, ends, starts, ends, zero)]
        while todo:
            level, a0, a1, b0, b1, errors = todo.pop()
            if len(a0) > BLOCK_PAIRS:
                half = len(a0) // 2
                todo.append((level, *(x[half:] for x in (a0, a1, b0, b1, errors))))
                a0, a1, b0, b1, errors = (x[:half] for x in (a0, a1, b0, b1, errors))
                todo.append((level, a0, a1, b0, b1, errors))
                continue
            # drop pairs of nodes that are one component already
            changes = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
            done = ((labels[a0] == labels[b0]) & (changes[a0] == changes[a1 - 1])
                    & (changes[b0] == changes[b1 - 1]))
            # single codes against single codes need no further descent
            single = (a1 - a0 == 1) & (b1 - b0 == 1) & ~done
            if single.any():
                x, y = a0[single], b0[single]
                near = np.bitwise_count(codes[x] ^ codes[y]) <= most
                if near.any():
                    labels = joined(labels, x[near], y[near])
            rest = ~(done | single)
            if level == bits:  # all bits read within the budget
                labels = joined(labels, a0[rest], b0[rest])
                continue
            a0, a1, b0, b1, errors = (x[rest] for x in (a0, a1, b0, b1, errors))
            if not len(a0):
                continue
            one = ((codes >> np.uint64(bits - 1 - level)) & np.uint64(1)).astype(np.int64)
            ones = np.r_[0, np.cumsum(one)]
            am = a1 - (ones[a1] - ones[a0])
            bm = b1 - (ones[b1] - ones[b0])
            same = (a0 == b0) & (a1 == b1)
            apart = errors < most
            children = []
            for left, right, keep, more in (((a0, am), (b0, bm), None, 0), ((am, a1), (bm, b1), None, 0),
                                            ((a0, am), (bm, b1), apart, 1),
                                            ((am, a1), (b0, bm), apart & ~same, 1)):
                ok = (left[0] < left[1]) & (right[0] < right[1])
                if keep is not None:
                    ok &= keep
                children.append((left[0][ok], left[1][ok], right[0][ok], right[1][ok], errors[ok] + np.int8(more)))
            todo.append((level + 1, *(np.concatenate(x) for x in zip(*children))))
    return labels
