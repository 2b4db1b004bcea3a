"""Cheapest repairs of role sequences: a min-plus product over a Re-Pair grammar.

A conversation is a string of symbols, one for each row: its role's initial (s, u, a, or another)
with whether it is truncated, or DOOMED for a row that has to be deleted. What a repair leaves must
read ``(s?(ua)+)?``, an automaton of four states. The transfer matrix of a symbol holds for each
pair of states the least cost of inserting what is needed, then keeping, re-labelling or
deleting the row. Matrices of strings are products of matrices, so each rule of the grammar needs
one product, however many conversations use it.

Ties go to the audit that sorts first. Audits from one state over the same rows all end in a
letter for a row and have as many of these, so none is the beginning of another; and an audit
decides its end state. So it is enough to keep, for each state to start from, the order of the
audits by end state: a rule's matrix has costs, that order, and the state in the middle, by
which the audit is a rope of the two parts' audits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

START, OPENED, ASKED, ANSWERED = range(4)
INITIALS = "sua"
OTHER = 3
DOOMED = 8
N_SYMBOLS = 9
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
INFINITE = 1 << 40

# The state after a role's initial; a missing entry is a role that may not stand there.
_AFTER = {(START, "s"): OPENED, (START, "u"): ASKED, (OPENED, "u"): ASKED, (ANSWERED, "u"): ASKED,
          (ASKED, "a"): ANSWERED}
# The one of user and assistant that may come in each state, which an inserted or re-labelled row gets.
WANTED = {START: "u", OPENED: "u", ASKED: "a", ANSWERED: "u"}
ENDING = {START: "", OPENED: INSERT * 2, ASKED: INSERT, ANSWERED: ""}
ENDING_COST = np.array([INSERT_COST * len(ENDING[q]) for q in range(4)], np.int64)


def symbol(role: str, truncated: bool) -> int:
    kind = INITIALS.find(role[:1]) if role else -1
    return 2 * (OTHER if kind < 0 else kind) + truncated


def after(state: int, initial: str) -> int:
    return _AFTER[state, initial]


def _edits(symbol_: int, state: int):
    """(cost, letter, next state) of what can be done with a row in a state."""
    yield DELETE_COST, DELETE, state
    if symbol_ != DOOMED:
        kind, truncated = divmod(symbol_, 2)
        if kind != OTHER and (state, INITIALS[kind]) in _AFTER:
            yield TRUNCATED_COST * truncated, KEEP, _AFTER[state, INITIALS[kind]]
        yield REROLE_COST + TRUNCATED_COST * truncated, REROLE, _AFTER[state, WANTED[state]]


def _terminals():
    costs = np.full((N_SYMBOLS, 4, 4), INFINITE, np.int64)
    audits: dict[tuple[int, int, int], str] = {}
    for x in range(N_SYMBOLS):
        for p in range(4):
            state = p
            for inserted in range(3):
                for cost, letter, q in _edits(x, state):
                    found = (cost + INSERT_COST * inserted, INSERT * inserted + letter)
                    if found < (costs[x, p, q], audits.get((x, p, q), "")):
                        costs[x, p, q], audits[x, p, q] = found
                state = _AFTER[state, WANTED[state]]
    order = np.full((N_SYMBOLS, 4, 4), 4, np.int64)
    for x in range(N_SYMBOLS):
        for p in range(4):
            own = sorted((audits[x, p, q], q) for q in range(4) if (x, p, q) in audits)
            order[x, p, [q for _, q in own]] = range(len(own))
    return costs, order, audits


_COSTS, _ORDER, _AUDITS = _terminals()


def product(c1: np.ndarray, o1: np.ndarray, c2: np.ndarray, o2: np.ndarray):
    """Costs, order and middle states of the products of (n, 4, 4) matrices."""
    costs = c1[:, :, :, None] + c2[:, None, :, :]
    middle = np.argmin(costs * 8 + o1[:, :, :, None], axis=2)
    best = np.minimum(np.take_along_axis(costs, middle[:, :, None, :], 2)[:, :, 0, :], INFINITE)
    first = np.take_along_axis(o1, middle, 2)
    n = len(middle)
    then = o2[np.arange(n)[:, None, None], middle, np.arange(4)[None, None, :]]
    key = np.where(best < INFINITE, first * 8 + then, 64 + np.arange(4))
    order = (key[:, :, :, None] > key[:, :, None, :]).sum(axis=3)
    return best, order, middle


def re_pair(strings: Iterable[bytes]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules, each a pair of earlier symbols, and the strings in terms of them.

    The most frequent pair becomes a rule, and so on, until no pair occurs twice. What is left of
    each string is then paired up, so that a string is one symbol (or none, if it is empty).
    """
    cells: list[int] = []
    begins = []
    for own in strings:
        begins.append(len(cells))
        cells.extend(own)
        cells.append(-1)
    n = len(cells)
    after_, before = list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[tuple[int, int], set[int]] = {}
    for at in range(n - 1):
        if cells[at] >= 0 and cells[at + 1] >= 0:
            where.setdefault((cells[at], cells[at + 1]), set()).add(at)
    heap = [(-len(own), pair) for pair, own in where.items() if len(own) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        own = where.get(pair, ())
        if len(own) != -count:
            if len(own) > 1:
                heapq.heappush(heap, (-len(own), pair))
            continue
        new = N_SYMBOLS + len(rules)
        rules.append(pair)
        touched = set()
        for at in sorted(own):
            follows = after_[at] if after_[at] < n else -1
            if cells[at] != pair[0] or follows < 0 or cells[follows] != pair[1]:
                continue  # overlapped one that was replaced
            left, right = before[at], after_[follows]
            if left >= 0 and cells[left] >= 0:
                where.get((cells[left], cells[at]), set()).discard(left)
                where.setdefault((cells[left], new), set()).add(left)
                touched.add((cells[left], new))
            if right < n and cells[right] >= 0:
                where.get((cells[follows], cells[right]), set()).discard(follows)
                where.setdefault((new, cells[right]), set()).add(at)
                touched.add((new, cells[right]))
            cells[at], cells[follows] = new, -2
            after_[at] = right
            if right < n:
                before[right] = at
        where.pop(pair, None)
        for other in touched:
            if len(where.get(other, ())) > 1:
                heapq.heappush(heap, (-len(where[other]), other))
    known = {pair: N_SYMBOLS + i for i, pair in enumerate(rules)}
    roots = []
    for at in begins:
        own = []
        while cells[at] != -1:
            own.append(cells[at])
            at = after_[at]
        while len(own) > 1:
            up = own[len(own) & ~1:]
            paired = []
            for pair in zip(own[::2], own[1::2]):
                if pair not in known:
                    known[pair] = N_SYMBOLS + len(rules)
                    rules.append(pair)
                paired.append(known[pair])
            own = paired + up
        roots.append(own)
    return rules, roots


class Grammar:
    """The transfer matrices of all rules over some strings, and of the strings."""

    def __init__(self, strings: list[bytes]):
        distinct = list(dict.fromkeys(strings))
        self.rules, roots = re_pair(distinct)
        self.root = {own: symbols[0] if symbols else -1 for own, symbols in zip(distinct, roots)}
        n = N_SYMBOLS + len(self.rules)
        self.costs = np.empty((n, 4, 4), np.int64)
        self.order = np.empty((n, 4, 4), np.int64)
        self.middle = np.zeros((n, 4, 4), np.int64)
        self.costs[:N_SYMBOLS], self.order[:N_SYMBOLS] = _COSTS, _ORDER
        levels: list[list[int]] = []
        level = [0] * n
        for i, (a, b) in enumerate(self.rules, N_SYMBOLS):
            level[i] = 1 + max(level[a], level[b])
            if level[i] > len(levels):
                levels.append([])
            levels[level[i] - 1].append(i)
        for own in levels:
            left, right = np.array([self.rules[i - N_SYMBOLS] for i in own]).T
            self.costs[own], self.order[own], self.middle[own] = product(
                self.costs[left], self.order[left], self.costs[right], self.order[right])

    def best(self, string: bytes) -> tuple[int, int]:
        """(cost, end state) of the cheapest repair of a whole conversation."""
        root = self.root[string]
        if root < 0:
            return 0, START
        costs = self.costs[root, START] + ENDING_COST
        end = int(np.argmin(costs * 8 + self.order[root, START]))
        return int(costs[end]), end

    def audits(self, wanted: list[tuple[bytes, int, int]]) -> list[str]:
        """The audit of each (string, from state, to state): the ropes, shared by all, spelled out."""
        asked = [(self.root[own], p, q) for own, p, q in wanted]
        needed: dict[int, set[tuple[int, int]]] = {}
        for x, p, q in asked:
            needed.setdefault(x, set()).add((p, q))
        for x in range(N_SYMBOLS + len(self.rules) - 1, N_SYMBOLS - 1, -1):
            left, right = self.rules[x - N_SYMBOLS]
            for p, q in needed.get(x, ()):
                m = int(self.middle[x, p, q])
                needed.setdefault(left, set()).add((p, m))
                needed.setdefault(right, set()).add((m, q))
        spelled = dict(_AUDITS)
        for x in range(N_SYMBOLS, N_SYMBOLS + len(self.rules)):
            left, right = self.rules[x - N_SYMBOLS]
            for p, q in needed.get(x, ()):
                m = int(self.middle[x, p, q])
                spelled[x, p, q] = spelled[left, p, m] + spelled[right, m, q]
        return [spelled[key] if key[0] >= 0 else "" for key in asked]
