"""Deep-shallow sorting of byte strings.

A multikey quicksort splits on eight bytes at a time down to a shallow depth;
strings still equal there mostly stay equal for long, and comparing them byte by
byte again and again would dominate. Each such group is ordered by a blind trie
instead: a trie that keeps only branching positions, in which a string is
inserted by walking blindly to some leaf, comparing once with that leaf to find
the true common prefix, and branching where it ends.
"""

from __future__ import annotations

import os

SHALLOW = 64
_WORD = 8


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix; the first ``start`` bytes are known equal."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    step = 64
    at = start
    while a[at: at + step] == b[at: at + step]:
        at += step
    return at + len(os.path.commonprefix([a[at: at + step], b[at: at + step]]))


def deep_shallow(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with the one before.

    Equal strings keep their order; the first has common prefix 0.
    """
    order, shared = [], []
    if strings:
        _quicksort(strings, list(range(len(strings))), 0, order, shared)
    return order, shared


def _quicksort(strings: list[bytes], which: list[int], depth: int, order: list[int], shared: list[int]) -> None:
    """Appends the strings ``which``, equal in their first ``depth`` bytes."""
    todo = [(which, depth)]
    while todo:
        which, depth = todo.pop()
        if len(which) == 1:
            _append(strings, which[0], depth, order, shared)
        elif depth >= SHALLOW:
            trie = BlindTrie(strings, which[0], depth)
            for i in which[1:]:
                trie.insert(i)
            for i in trie.leaves():
                _append(strings, i, depth, order, shared)
        else:
            pivot = strings[which[len(which) // 2]][depth: depth + _WORD]
            less, equal, more = [], [], []
            for i in which:
                key = strings[i][depth: depth + _WORD]
                (less if key < pivot else more if key > pivot else equal).append(i)
            if more:
                todo.append((more, depth))
            if len(pivot) < _WORD:
                # Strings that end within the pivot word are equal as a whole.
                todo.append((equal, SHALLOW))
            else:
                todo.append((equal, depth + _WORD))
            if less:
                todo.append((less, depth))


def _append(strings: list[bytes], i: int, depth: int, order: list[int], shared: list[int]) -> None:
    shared.append(common_prefix(strings[order[-1]], strings[i]) if order else 0)
    order.append(i)


class BlindTrie:
    """Strings that share their first ``depth`` bytes, in order."""

    __slots__ = ("strings", "depth", "root")

    def __init__(self, strings: list[bytes], first: int, depth: int):
        self.strings, self.depth = strings, depth
        self.root: list | int = [len(strings[first]), {}, [first]]

    # A node is [position, children by the byte at position, strings ending there];
    # a leaf is a node without children whose position is its string's length.

    def insert(self, i: int) -> None:
        text = self.strings[i]
        # Blindly down to some leaf: only the branching bytes are looked at.
        node = self.root
        while node[1]:
            at = node[0]
            step = node[1].get(text[at]) if at < len(text) else None
            if step is None:
                break
            node = step
        while node[1] and not node[2]:
            node = next(iter(node[1].values()))
        met = self.strings[node[2][0]]
        same = common_prefix(text, met, min(self.depth, len(text), len(met)))
        # From the root again to where the common prefix ends.
        above, node = None, self.root
        while node[0] < same:
            above, node = node, node[1][text[node[0]]]
        if node[0] == same:
            if len(text) == same:
                node[2].append(i)
            else:
                # No child begins with this byte, or the walk had gone there.
                node[1][text[same]] = [len(text), {}, [i]]
            return
        fork = [same, {met[same]: node}, []]
        if len(text) == same:
            fork[2].append(i)
        else:
            fork[1][text[same]] = [len(text), {}, [i]]
        if above is None:
            self.root = fork
        else:
            above[1][text[above[0]]] = fork

    def leaves(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            out.extend(node[2])
            todo.extend(child for _, child in sorted(node[1].items(), reverse=True))
        return out
