"""Probabilistic automata from example strings, by merging compatible states of their prefix tree."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np

#: Character kinds that the automata read; a character of none is other.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "_-", "+/=", ".")
_CLASS = {c: k for k, chars in enumerate(CLASSES) for c in chars}
SYMBOLS = len(CLASSES) + 1
#: The end of a string among an automaton's steps.
END = -1
CONFIDENCE = 0.05
SMOOTHING = 0.05


def symbols(value: str) -> list[int]:
    return [_CLASS.get(c, SYMBOLS - 1) for c in value]


@dataclass
class Automaton:
    """States with counts of strings that pass, that end, and that leave by each symbol."""

    passed: list[int] = field(default_factory=lambda: [0])
    ended: list[int] = field(default_factory=lambda: [0])
    count: list[dict[int, int]] = field(default_factory=lambda: [{}])
    target: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def add(self, value: str) -> None:
        state = 0
        for s in symbols(value):
            self.passed[state] += 1
            self.count[state][s] = self.count[state].get(s, 0) + 1
            if s not in self.target[state]:
                self.target[state][s] = len(self.passed)
                self.passed.append(0)
                self.ended.append(0)
                self.count.append({})
                self.target.append({})
            state = self.target[state][s]
        self.passed[state] += 1
        self.ended[state] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        """Hoeffding's test of two shares."""
        bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(f1 / n1 - f2 / n2) > bound

    def compatible(self, a: int, b: int) -> bool:
        """Whether two states, and all states reached from both alike, could be one; ``b`` is the root of a tree."""
        left = [(a, b)]
        while left:
            a, b = left.pop()
            n, m = self.passed[a], self.passed[b]
            if self._differ(self.ended[a], n, self.ended[b], m):
                return False
            for s in sorted(self.count[a].keys() | self.count[b].keys()):
                if self._differ(self.count[a].get(s, 0), n, self.count[b].get(s, 0), m):
                    return False
                if s in self.target[a] and s in self.target[b]:
                    left.append((self.target[a][s], self.target[b][s]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree at ``b`` to state ``a``."""
        left = [(a, b)]
        while left:
            a, b = left.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for s, n in self.count[b].items():
                self.count[a][s] = self.count[a].get(s, 0) + n
                if s not in self.target[b]:
                    continue
                if s in self.target[a]:
                    left.append((self.target[a][s], self.target[b][s]))
                else:
                    self.target[a][s] = self.target[b][s]

    def merge(self) -> Automaton:
        """Merge each state, the most frequent first, with a compatible kept one, or keep it."""
        kept = [0]
        while True:
            waiting = [(-self.passed[t], k, s, t) for k in kept for s, t in self.target[k].items() if t not in kept]
            if not waiting:
                return self
            _, parent, s, state = min(waiting)
            same = next((k for k in kept if self.compatible(k, state)), None)
            if same is None:
                kept.append(state)
            else:
                self.target[parent][s] = same
                self.fold(same, state)

    def walk(self, path: Sequence[int], n: int, steps: Counter[tuple[int, int]]) -> None:
        """Add to ``steps`` the (state, symbol) pairs that ``n`` strings of these symbols take, the end as symbol ``END``."""
        state = 0
        for s in path:
            steps[state, s] += n
            state = self.target[state].get(s, 0)
        steps[state, END] += n

    def counted(self, steps: Iterable[tuple[int, int, int]]) -> Automaton:
        """The same states and targets with the counts of (state, symbol, n) ``steps``, which all strings took together."""
        size = len(self.passed)
        found = Automaton([0] * size, [0] * size, [{} for _ in range(size)], self.target)
        for state, s, n in steps:
            found.passed[state] += n
            if s == END:
                found.ended[state] += n
            else:
                found.count[state][s] = n
        return found

    def log_likelihood(self, value: str) -> float:
        """Bits, a negative number; unseen steps have a small probability and lead to the start."""
        total, state = 0.0, 0
        for s in symbols(value):
            total += math.log2((self.count[state].get(s, 0) + SMOOTHING) / (self.passed[state] + SMOOTHING * (SYMBOLS + 1)))
            state = self.target[state].get(s, 0)
        return total + math.log2((self.ended[state] + SMOOTHING) / (self.passed[state] + SMOOTHING * (SYMBOLS + 1)))


def infer(values: list[str]) -> Automaton:
    """Automaton of example strings, whose order does not matter."""
    tree = Automaton()
    for value in sorted(values):
        tree.add(value)
    return tree.merge() if values else tree


def infer_from_prefixes(nodes: Iterable[tuple[str, int, int]], least: int) -> Automaton:
    """Automaton of a prefix tree given as (prefix, strings that pass, strings that end), prefixes in digits of their symbols.

    A prefix that ``least`` strings pass is a state of the tree, as is the empty one; others count as steps that leave one.
    """
    tree, state_of = Automaton(), {"": 0}
    for prefix, passed, ended in sorted(nodes, key=lambda node: (len(node[0]), node[0])):
        if prefix[:-1] not in state_of:
            continue
        if prefix:
            parent, s = state_of[prefix[:-1]], int(prefix[-1])
            tree.count[parent][s] = passed
            if passed < least:
                continue
            state_of[prefix] = tree.target[parent][s] = len(tree.passed)
            for part, empty in ((tree.passed, 0), (tree.ended, 0), (tree.count, {}), (tree.target, {})):
                part.append(empty)
        tree.passed[state_of[prefix]], tree.ended[state_of[prefix]] = passed, ended
    return tree.merge()


def chain_steps(path: Sequence[int]) -> Counter[tuple[int, int]]:
    """Pairs of symbols that follow each other in a string, its start before the first and its end after the last as ``SYMBOLS``."""
    return Counter(zip([SYMBOLS, *path], [*path, SYMBOLS]))


class Background:
    """Order-one chain over character kinds of ordinary strings, from the numbers of :func:`chain_steps` over all of them."""

    def __init__(self, steps: Mapping[tuple[int, int], int]):
        counts = np.full((SYMBOLS + 1, SYMBOLS + 1), 0.5)  # the last row starts strings, the last column ends them
        for pair, n in steps.items():
            counts[pair] += n
        self.bits = np.log2(counts / counts.sum(axis=1, keepdims=True))

    def log_likelihood(self, value: str) -> float:
        path = [SYMBOLS, *symbols(value), SYMBOLS]
        return float(sum(self.bits[a, b] for a, b in zip(path, path[1:])))
