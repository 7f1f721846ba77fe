"""Similar sets found in a trie of globally ordered sets."""

from __future__ import annotations

import numpy as np


def enough(overlap: int, total: int) -> bool:
    """Whether sets of ``total`` elements together and ``overlap`` common ones reach a Jaccard similarity of 0.75.

    100 * overlap >= 75 * (total - overlap), shortened.
    """
    return 7 * overlap >= 3 * total


def local_ranks(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Sets of (element, how many sets have it) as ascending ranks in the global order: rare first, then by element."""
    elements, counts = (np.concatenate([s[k] for s in sets]) for k in (0, 1))
    order = np.lexsort((elements, counts))
    ordered = elements[order]
    ranks = np.empty(len(elements), np.int32)
    if len(ordered):
        ranks[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]), dtype=np.int32)
    ends = np.cumsum([len(s[0]) for s in sets])
    return [np.sort(ranks[e - len(s[0]) : e]) for s, e in zip(sets, ends)]


class PrefixTrie:
    """A trie of ascending rank arrays: the arrays in lexicographic order, so a node is a range of rows and a depth.

    ``sizes`` are the whole sets' sizes; arrays may leave out elements that no other set has.
    """

    def __init__(self, rows: list[np.ndarray], sizes: list[int]):
        self.order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">i4").tobytes())
        self.rows = [rows[i] for i in self.order]
        self.sizes = [sizes[i] for i in self.order]

    def similar(self, probe: np.ndarray, size: int) -> list[int]:
        """Numbers of the rows similar to the probe (a rank array of a set of ``size``).

        The overlap with a shared prefix is counted once, at its node, and passed to the subtree. A subtree is left
        out if even its smallest set can't reach the similarity with the elements that still remain on both sides.
        """
        found = []
        nodes = [(0, len(self.rows), 0, 0)] if self.rows else []
        while nodes:
            lo, hi, depth, overlap = nodes.pop()
            first, last = self.rows[lo], self.rows[hi - 1]
            end = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:end] != last[depth:end])
            if len(differ):
                end = depth + int(differ[0])
            edge = first[depth:end]
            if len(edge) and len(probe):
                at = np.searchsorted(probe, edge)
                overlap += int(np.count_nonzero(probe[np.minimum(at, len(probe) - 1)] == edge))
            left = len(probe) - int(np.searchsorted(probe, first[end - 1], "right")) if end else len(probe)
            while lo < hi and len(self.rows[lo]) == end:
                if enough(overlap, size + self.sizes[lo]):
                    found.append(self.order[lo])
                lo += 1
            if lo == hi:
                continue
            most = overlap + min(left, max(len(r) for r in self.rows[lo:hi]) - end)
            if not enough(most, size + min(self.sizes[lo:hi])):
                continue
            begin = lo
            for k in range(lo + 1, hi + 1):
                if k == hi or self.rows[k][end] != self.rows[begin][end]:
                    nodes.append((begin, k, end, overlap))
                    begin = k
        return found
