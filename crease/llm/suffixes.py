"""Suffix arrays over integer sequences, by prefix doubling in numpy."""

from __future__ import annotations

import numpy as np


class Suffixes:
    """The suffixes of ``values`` (integers from 0) in sorted order.

    ``order`` has their positions.  With ``depth``, suffixes may be ordered by
    their first ``depth`` symbols (or more) only.  A shorter suffix sorts
    before its extensions.  With ``boundary``, ``begins[i]`` tells whether
    suffix ``i`` of the order differs from the one before it within the first
    ``boundary`` symbols.
    """

    def __init__(self, values: np.ndarray, depth: int | None = None, boundary: int = 0):
        n = len(values)
        self.begins = np.ones(n, bool)
        self.order = np.zeros(0, np.int64)
        if n == 0:
            return
        # pack as many symbols as fit into the first sort key
        bits = max(1, int(values.max() + 1).bit_length())
        have = max(1, min(62 // bits, boundary or 62))
        key = np.zeros(n, np.int64)
        for j in range(have):
            key <<= bits
            key[:n - j] |= values[j:] + 1
        near = None
        while True:
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            if have <= boundary:
                near = rank, have
            if rank[order[-1]] == n or have >= n or (depth is not None and have >= depth):
                break
            # a rank of ``have`` symbols here and one ``have`` symbols on; short of
            # the boundary's depth the second may overlap the first
            step = have if not have < boundary < 2 * have else boundary - have
            second = np.zeros(n, np.int64)
            second[:n - step] = rank[step:]
            key = rank * (n + 2) + second
            have += step
        self.order = order
        if boundary and near:
            rank, have = near
            here = rank[order]
            differ = here[1:] != here[:-1]
            if have < boundary and rank.max() < n:
                far = np.zeros(n, np.int64)
                far[:max(0, n - (boundary - have))] = rank[boundary - have:]
                far = far[order]
                differ |= far[1:] != far[:-1]
            self.begins[1:] = differ


def suffix_array(values: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Positions of all suffixes of ``values`` in sorted order."""
    return Suffixes(values, depth).order
