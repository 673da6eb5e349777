"""Regular expressions over bytes compiled into one minimal deterministic automaton.

The syntax is what secret rules need: literals, classes, groups, ``|``, ``?``, ``*``, ``+``,
``{n}``, ``{n,}`` and ``{n,m}``; an ``i`` flag folds ASCII case. Rules are parsed with the
standard library's own parser, turned into one nondeterministic automaton, made
deterministic by subset construction, and minimised by refining state classes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property
from re import _constants as sre
from re import _parser

import numpy as np


class _Nfa:
    """Thompson construction; ``edges[s]`` holds (byte mask, target), ``empty[s]`` targets."""

    def __init__(self):
        self.edges: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, items, start: int, fold: bool) -> int:
        for op, arg in items:
            start = self._one(op, arg, start, fold)
        return start

    def _one(self, op, arg, start: int, fold: bool) -> int:
        if op in (sre.LITERAL, sre.NOT_LITERAL, sre.IN):
            end = self.state()
            self.edges[start].append((_mask(op, arg, fold), end))
            return end
        if op is sre.SUBPATTERN:
            return self.add(arg[-1], start, fold)
        if op is sre.BRANCH:
            end = self.state()
            for branch in arg[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(branch, first, fold)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            least, most, items = arg
            for _ in range(least):
                start = self.add(items, start, fold)
            if most is sre.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[start].append(loop)
                self.empty[self.add(items, loop, fold)].append(loop)
                self.empty[loop].append(end)
                return end
            end = self.state()
            for _ in range(most - least):
                self.empty[start].append(end)
                start = self.add(items, start, fold)
            self.empty[start].append(end)
            return end
        raise ValueError(f"not supported in a rule: {op}")

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)


def _mask(op, arg, fold: bool) -> int:
    parts = arg if op is sre.IN else [(op, arg)]
    mask, negate = 0, False
    for kind, value in parts:
        if kind is sre.NEGATE:
            negate = True
        elif kind is sre.RANGE:
            mask |= sum(1 << b for b in range(value[0], value[1] + 1))
        elif kind is sre.LITERAL:
            mask |= 1 << value
        elif kind is sre.NOT_LITERAL:
            mask |= ((1 << 256) - 1) ^ (1 << value)
        else:
            raise ValueError(f"not supported in a class: {kind}")
    if fold:
        for low in range(97, 123):
            if mask >> low & 1 or mask >> (low - 32) & 1:
                mask |= 1 << low | 1 << (low - 32)
    return ((1 << 256) - 1) ^ mask if negate else mask


@dataclass(frozen=True)
class Automaton:
    """``moves[state, kind[byte]]`` is the next state; state 0 is the start.

    ``accepts[state]`` has bit k set if a match of rule k ends here. ``resets`` marks the
    bytes that lead from every state to the start.
    """

    moves: np.ndarray
    kind: np.ndarray
    accepts: np.ndarray
    resets: np.ndarray

    @cached_property
    def dead(self) -> int:
        """The state that no match leaves, or -1."""
        own = np.arange(len(self.moves))
        stuck = (self.moves == own[:, None]).all(axis=1) & (self.accepts == 0)
        return int(np.flatnonzero(stuck)[0]) if stuck.any() else -1


def compile_rules(patterns: list[tuple[str, str]], anchored: bool = False, backward: bool = False) -> Automaton:
    """One automaton for all ``(pattern, flags)``.

    Unless ``anchored``, matches may start anywhere. ``backward`` reads texts from the end.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends = []
    for pattern, flags in patterns:
        first = nfa.state()
        nfa.empty[start].append(first)
        items = _parser.parse(pattern.encode("ascii"))
        ends.append(nfa.add(_turned(items) if backward else items, first, "i" in flags))
    if not anchored:
        nfa.edges[start].append(((1 << 256) - 1, start))

    # Bytes that no edge tells apart share a column.
    masks = sorted({m for row in nfa.edges for m, _ in row})
    names: dict[tuple, int] = {}
    kind = np.array([names.setdefault(tuple(m >> b & 1 for m in masks), len(names)) for b in range(256)], np.uint8)
    samples = [int(np.flatnonzero(kind == k)[0]) for k in range(len(names))]

    first = nfa.closure([start])
    states, order, rows = {first: 0}, [first], []
    for subset in order:  # grows while it runs
        edges = [e for s in subset for e in nfa.edges[s]]
        row = []
        for byte in samples:
            target = nfa.closure({t for m, t in edges if m >> byte & 1})
            if target not in states:
                states[target] = len(order)
                order.append(target)
            row.append(states[target])
        rows.append(row)
    accepts = np.array([sum(1 << k for k, e in enumerate(ends) if e in s) for s in order], np.int64)
    moves, accepts = _minimised(np.array(rows, np.int32), accepts)
    resets = (moves == 0).all(axis=0)[kind]
    return Automaton(moves, kind, accepts, resets)


def _turned(items):
    """The items of a pattern that matches the reversed strings."""
    out = []
    for op, arg in reversed(list(items)):
        if op is sre.SUBPATTERN:
            arg = (*arg[:-1], _turned(arg[-1]))
        elif op is sre.BRANCH:
            arg = (arg[0], [_turned(b) for b in arg[1]])
        elif op is sre.MAX_REPEAT:
            arg = (arg[0], arg[1], _turned(arg[2]))
        out.append((op, arg))
    return out


def _minimised(moves: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Refine classes of states by their successors' classes until none splits."""
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[moves]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    # Number the classes by first occurrence, so that the start stays state 0.
    _, first = np.unique(group, return_index=True)
    order = np.argsort(first)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    keep = first[order]
    return number[group[moves[keep]]].astype(np.int32), accepts[keep]


def scan(automaton: Automaton, data: np.ndarray, lanes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a match of any rule ends, and the rules' bits, in one byte pass.

    The bytes are cut after reset bytes into lanes of about equal length, and all lanes are
    stepped together: after a reset byte the state does not depend on what came before.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = np.flatnonzero(automaton.resets[data]) + 1
    wanted = np.linspace(0, n, min(lanes, n // 64 + 1) + 1).astype(np.int64)[1:-1]
    at = np.searchsorted(cuts, wanted)
    starts = np.unique(np.concatenate([[0], cuts[at[at < len(cuts)]]]))
    starts = starts[starts < n]
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]

    width = automaton.moves.shape[1]
    moves = (automaton.moves * width).ravel()
    accepts = np.zeros(moves.max() + 1, np.int64)
    accepts[np.arange(len(automaton.accepts)) * width] = automaton.accepts
    column = automaton.kind[data].astype(np.int32)
    state = np.zeros(len(starts), np.int32)
    live_at = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    places, bits = [], []
    for step in range(lengths[0]):
        live = live_at[step]
        state = moves[state[:live] + column[starts[:live] + step]]
        hit = accepts[state]
        if hit.any():
            k = np.flatnonzero(hit)
            places.append(starts[k] + step)
            bits.append(hit[k])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places, bits = np.concatenate(places), np.concatenate(bits)
    order = np.argsort(places, kind="stable")
    return places[order], bits[order]


def longest(automaton: Automaton, data: bytes, start: int, step: int = 1) -> int:
    """Where the longest match of an anchored automaton that begins at ``start`` ends, else -1."""
    state, best, kind, moves, accepts = 0, -1, automaton.kind, automaton.moves, automaton.accepts
    dead = automaton.dead
    at = start
    while 0 <= at < len(data):
        state = moves[state, kind[data[at]]]
        if state == dead:
            break
        at += step
        if accepts[state]:
            best = at
    return best


def reference(pattern: str, flags: str) -> re.Pattern:
    """The same rule for the standard library, for tests."""
    return re.compile(pattern.encode("ascii"), re.IGNORECASE if "i" in flags else 0)
