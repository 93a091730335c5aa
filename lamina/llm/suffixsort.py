"""Deep-shallow sorting of equally long strings of one buffer.

Shallow: multikey quicksort, whose keys are eight characters at a time, splits all
groups at once and lets strings go that are alone. Deep: a group that still shares
a long prefix is ordered by a blind trie, which looks at one character a branch on
its way down and compares whole strings once per insertion.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32


class BlindTrie:
    """Distinct strings of one length, by their branching characters alone."""

    def __init__(self, first: bytes):
        self.root = first           # a leaf is its string; a branch is (depth, {character: child})

    def insert(self, new: bytes) -> None:
        node = self.root
        while isinstance(node, tuple):          # blind: only branching characters decide
            node = node[1].get(new[node[0]]) or next(iter(node[1].values()))
        leaf = node
        same = 0
        step = 16
        while new[same:same + step] == leaf[same:same + step]:
            same += step
            if same >= len(new):
                return
        while new[same] == leaf[same]:
            same += 1
        above, sign, node = None, 0, self.root
        while isinstance(node, tuple) and node[0] < same:
            above, sign = node, new[node[0]]
            node = node[1][sign]
        if isinstance(node, tuple) and node[0] == same:
            node[1][new[same]] = new
            return
        branch = (same, {leaf[same]: node, new[same]: new})
        if above is None:
            self.root = branch
        else:
            above[1][sign] = branch

    def ordered(self):
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                yield node


def _split(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by (group, key): the order, the new groups, and which strings aren't alone."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.append(True, (g[1:] != g[:-1]) | (k[1:] != k[:-1]))
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(g)))
    return order, np.repeat(begin, size), np.repeat(size, size) > 1


def equal_runs(text: bytes, starts: np.ndarray, length: int, group: np.ndarray,
               shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The strings text[s:s + length] that another one of the same group equals, in
    sorted order: their places in ``starts``, and the number of their class."""
    padded = text + bytes(8)
    words = np.ndarray((len(text) + 1,), dtype=">u8", buffer=padded, strides=(1,))
    at = np.argsort(group, kind="stable")
    g = np.unique(group, return_inverse=True)[1].astype(np.int64)[at]
    for depth in range(0, min(shallow, length - 7), 8):
        if not len(at):
            break
        order, g, many = _split(g, words[starts[at] + depth].astype(np.uint64))
        at, g = at[order][many], g[many]
    if not len(at):
        return at, at
    begin = np.flatnonzero(np.append(True, g[1:] != g[:-1])).tolist()
    offset = starts[at].tolist()
    places, classes, count = [], [], 0
    at = at.tolist()
    for a, b in zip(begin, [*begin[1:], len(at)]):
        same: dict[bytes, list[int]] = {}
        for i in range(a, b):
            s = offset[i]
            same.setdefault(text[s:s + length], []).append(at[i])
        if len(same) == 1:
            ranked = same
        else:
            strings = iter(same)
            trie = BlindTrie(next(strings))
            for s in strings:
                trie.insert(s)
            ranked = trie.ordered()
        for s in ranked:
            own = same[s]
            if len(own) > 1:
                places += own
                classes += [count] * len(own)
                count += 1
    return np.array(places, np.int64), np.array(classes, np.int64)
