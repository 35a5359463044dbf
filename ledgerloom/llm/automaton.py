"""A minimal acyclic transducer from words to numbers, as flat arrays.

Words that end alike share their last states. Every arc carries how many words
sort before those it leads to, so the sum along a word's path is the word's
number; the number's row in a table holds the outputs. Arcs of all states lie
interleaved in one array: the arc of state s with byte c is at ``base[s] + c``
if ``owner`` there is s. All words of a batch are looked up together, one byte a
step.
"""

from __future__ import annotations

import numpy as np


#: How far past the first gap a place for a state's arcs is looked for.
_REACH = 2_048


class _State:
    __slots__ = ("arcs", "final", "words", "number")

    def __init__(self) -> None:
        self.arcs: dict[int, _State] = {}
        self.final, self.words, self.number = False, 0, -1

    def form(self) -> tuple:
        return self.final, tuple((c, id(s)) for c, s in self.arcs.items())


def _minimal(words: list[bytes]) -> _State:
    """From sorted distinct words, sharing equal right ends as they close."""
    root, known = _State(), {}
    open_path: list[tuple[_State, int, _State]] = []
    before = b""
    for word in words:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        _close(open_path, same, known)
        at = open_path[-1][2] if open_path else root
        for c in word[same:]:
            new = at.arcs[c] = _State()
            open_path.append((at, c, new))
            at = new
        at.final, before = True, word
    _close(open_path, 0, known)
    return root


def _close(path: list, keep: int, known: dict) -> None:
    while len(path) > keep:
        parent, c, child = path.pop()
        child.words = child.final + sum(s.words for s in child.arcs.values())
        parent.arcs[c] = known.setdefault(child.form(), child)


def build(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the transducer for sorted distinct ``words``; word i gets i."""
    root = _minimal(words)
    states, todo = [], [root]
    while todo:
        state = todo.pop()
        if state.number < 0:
            state.number = len(states)
            states.append(state)
            todo.extend(state.arcs.values())
    base = np.zeros(len(states), np.int64)
    used = np.zeros(sum(len(s.arcs) for s in states) + 1024, bool)
    used[:256] = True
    free, end = 256, 256
    # States with many arcs first; those with one fill the gaps.
    for state in sorted(states, key=lambda s: -len(s.arcs)):
        if not state.arcs:
            continue
        own = np.fromiter(state.arcs, np.int64)
        own.sort()
        if end + 512 > len(used):
            used = np.append(used, np.zeros(len(used), bool))
        while used[free]:
            free += 1
        places = free + np.flatnonzero(~used[free: min(free + _REACH, end)])
        fits = places[~used[places[:, None] + (own - own[0])].any(axis=1)] if len(places) else places
        start = int(fits[0]) if len(fits) else end
        base[state.number] = start - own[0]
        used[start + own - own[0]] = True
        end = max(end, start + int(own[-1] - own[0]) + 1)
    length = end + 256
    owner = np.full(length, -1, np.int32)
    target, skip = np.zeros(length, np.int32), np.zeros(length, np.int32)
    for state in states:
        before = int(state.final)
        for c, child in state.arcs.items():
            at = base[state.number] + c
            owner[at], target[at], skip[at] = state.number, child.number, before
            before += child.words
    return {
        "base": base.astype(np.int32),
        "final": np.array([s.final for s in states], np.int32),
        "owner": owner,
        "target": target,
        "skip": skip,
    }


def look_up(table: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of each word ``data[start:end]``, or -1."""
    base, owner, target, skip = (table[k] for k in ("base", "owner", "target", "skip"))
    out = np.full(len(starts), -1, np.int64)
    live = np.arange(len(starts))
    at, state, number = starts.copy(), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    while len(live):
        done = at == ends[live]
        if done.any():
            final = table["final"][state] == 1
            out[live[done & final]] = number[done & final]
            live, at, state, number = live[~done], at[~done], state[~done], number[~done]
        arc = np.minimum(base[state] + data[at].astype(np.int64), len(owner) - 1)
        ok = owner[arc] == state
        arc = arc[ok]
        live, at = live[ok], at[ok] + 1
        state, number = target[arc].astype(np.int64), number[ok] + skip[arc]
    return out
