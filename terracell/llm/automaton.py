"""One deterministic automaton for many rules: parse, subset construction, product, minimisation, scan.

Rules are regular expressions over bytes. Each is compiled to an automaton
that finds its leftmost, longest, non-overlapping matches: a state holds the
live threads in order of their starts, and once one has matched, those that
started later are cut. The rules' automata are combined into one by the
product construction, minimised, and stored as a transition array over byte
classes, so one pass over the bytes runs all rules. Many texts are scanned in
step: one array operation moves all of them by a byte.

A match's end is where the automaton leaves it; its start is found by running
the rule's reversed automaton back from the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

ALL = (1 << 256) - 1
#: Long texts are cut for the scan after bytes that lead every state to the start; pieces have about this length.
PIECE = 4096


def byte_range(first: int, last: int) -> int:
    return ((1 << (last + 1)) - 1) & ~((1 << first) - 1)


@dataclass
class Nfa:
    """Thompson automaton: state 0 starts; masks of bytes on edges."""

    empty: list[list[int]] = field(default_factory=list)
    edges: list[list[tuple[int, int]]] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def step(self, states, byte: int) -> frozenset[int]:
        return self.closure({t for s in states for mask, t in self.edges[s] if mask >> byte & 1})


class _Parser:
    """Literals, escapes, classes, groups ( ) and (?i: ), alternation, ? * + {m} {m,} {m,n}."""

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def parse(self):
        node = self.choice()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {self.text!r}")
        return node

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self):
        options = [self.series()]
        while self.peek() == "|":
            self.take()
            options.append(self.series())
        return options[0] if len(options) == 1 else ("or", options)

    def series(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("then", parts)

    def repeated(self):
        node = self.atom()
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(sign, (0, 0))
            if sign == "{":
                inside = self.text[self.at : self.text.index("}", self.at)]
                self.at += len(inside) + 1
                low, comma, high = inside.partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            node = ("times", node, least, most)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            before = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            node = self.choice()
            if self.take() != ")":
                raise ValueError("unclosed group")
            self.fold = before
            return node
        if c == "[":
            return ("bytes", self.folded(self.members()))
        if c == ".":
            return ("bytes", ALL & ~(1 << 10))
        return ("bytes", self.folded(1 << (self.escape() if c == "\\" else ord(c))))

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def members(self) -> int:
        negated = self.peek() == "^" and bool(self.take())
        mask, first = 0, True
        while first or self.peek() != "]":
            first = False
            c = self.take()
            low = self.escape() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else ord(c)
            mask |= byte_range(low, high)
        self.take()
        return ALL & ~mask if negated else mask

    def folded(self, mask: int) -> int:
        if self.fold:
            for lower in range(97, 123):
                if mask >> lower & 1 or mask >> (lower - 32) & 1:
                    mask |= 1 << lower | 1 << (lower - 32)
        return mask


def _build(nfa: Nfa, node, start: int, backward: bool) -> int:
    """Adds node's automaton behind start; its last state."""
    kind = node[0]
    if kind == "bytes":
        end = nfa.state()
        nfa.edges[start].append((node[1], end))
        return end
    if kind == "then":
        for part in reversed(node[1]) if backward else node[1]:
            start = _build(nfa, part, start, backward)
        return start
    if kind == "or":
        end = nfa.state()
        for option in node[1]:
            first = nfa.state()
            nfa.empty[start].append(first)
            nfa.empty[_build(nfa, option, first, backward)].append(end)
        return end
    _, inner, least, most = node
    for _ in range(least):
        start = _build(nfa, inner, start, backward)
    if most is None:
        loop, end = nfa.state(), nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[loop].append(end)
        nfa.empty[_build(nfa, inner, loop, backward)].append(loop)
        return end
    end = nfa.state()
    for _ in range(most - least):
        nfa.empty[start].append(end)
        start = _build(nfa, inner, start, backward)
    nfa.empty[start].append(end)
    return end


@dataclass(frozen=True)
class Rule:
    """kind: its name. pattern: what is reported. consumes: what a match takes up, where that is more than is reported.

    With consumes, matches of it that pattern rejects are dropped, but what
    they took up is not searched again.
    """

    kind: str
    pattern: str
    consumes: str | None = None


class _RuleDfa:
    """Leftmost, longest, non-overlapping matches of one rule, byte by byte."""

    def __init__(self, rule: Rule):
        self.nfa = Nfa()
        start = self.nfa.state()
        first = self.nfa.state()
        self.nfa.empty[start].append(first)
        self.reports = _build(self.nfa, _Parser(rule.pattern).parse(), first, False)
        self.takes = {self.reports}
        if rule.consumes:
            other = self.nfa.state()
            self.nfa.empty[start].append(other)
            self.takes.add(_build(self.nfa, _Parser(rule.consumes).parse(), other, False))
        self.start = self.nfa.closure({start})
        if self.start & self.takes:
            raise ValueError(f"rule {rule.kind} matches an empty text")
        self.kind = rule.kind
        self.masks = {mask for edges in self.nfa.edges for mask, _ in edges}

    def move(self, state: tuple, byte: int) -> tuple[tuple, bool, bool]:
        """The next state; whether a match ends before this byte; whether it is reported."""
        if state and state[0] & self.takes:
            on = self.nfa.step(state[0], byte)
            if on:
                if not on & self.takes or (self.reports in state[0] and self.reports not in on):
                    raise ValueError(f"rule {self.kind}: a match may grow by one byte at a time only")
                return (on,), False, False
            return self.move((), byte)[0], True, self.reports in state[0]
        threads, seen = [], set()
        for group in (*state, self.start):
            on = self.nfa.step(group, byte) - seen
            if on:
                seen |= on
                threads.append(frozenset(on))
                if on & self.takes:
                    if len(threads) > 1:
                        raise ValueError(f"rule {self.kind}: a later start matches before an earlier one is decided")
                    break
        return tuple(threads), False, False

    def arrays(self, samples: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Transitions and events by state and byte class, and events at the end; state 0 is the start."""
        numbers, todo, table, ends = {(): 0}, [()], [], []
        while len(table) < len(todo):
            moved = [self.move(todo[len(table)], b) for b in samples]
            for to, _, _ in moved:
                if to not in numbers:
                    numbers[to] = len(todo)
                    todo.append(to)
            table.append([numbers[to] for to, _, _ in moved])
            ends.append([ended | reported << 1 for _, ended, reported in moved])
        last = [bool(s and s[0] & self.takes) | bool(s and self.reports in s[0]) << 1 for s in todo]
        return np.array(table, dtype=np.int64), np.array(ends, dtype=np.uint32), np.array(last, dtype=np.uint32)


class Automaton:
    """The combined, minimal automaton of rules as arrays.

    classes: byte to class. table: state and class to state. ends: state and
    class to a mask of events, bits 2k (rule k's match ends before this byte)
    and 2k + 1 (and it is reported). last: the same at the end of a text.
    """

    def __init__(self, rules: list[Rule]):
        if not 0 < len(rules) <= 16:
            raise ValueError("from 1 to 16 rules can be combined")
        self.rules = list(rules)
        parts = [_RuleDfa(r) for r in rules]
        masks = sorted({m for p in parts for m in p.masks})
        kinds: dict[tuple, int] = {}
        self.classes = np.array([kinds.setdefault(tuple(m >> b & 1 for m in masks), len(kinds)) for b in range(256)], dtype=np.uint8)
        samples = [int(np.flatnonzero(self.classes == c)[0]) for c in range(len(kinds))]

        single = [p.arrays(samples) for p in parts]
        # Product: a combined state is a mixed-radix number of the rules' states; a frontier moves at once.
        sizes = [len(t) for t, _, _ in single]
        if np.prod([float(n) for n in sizes]) >= 2.0**62:
            raise ValueError("the rules have too many states to be combined")
        radix = np.cumprod([1, *sizes[:-1]], dtype=np.int64)

        def of_each(states: np.ndarray) -> list[np.ndarray]:
            return [states // r % n for r, n in zip(radix, sizes, strict=True)]

        known = frontier = np.zeros(1, dtype=np.int64)
        while len(frontier):
            to = sum(t[x] * r for (t, _, _), x, r in zip(single, of_each(frontier), radix, strict=True))
            frontier = np.setdiff1d(to, known)
            known = np.union1d(known, frontier)
        each = of_each(known)
        table = np.searchsorted(known, sum(t[x] * r for (t, _, _), x, r in zip(single, each, radix, strict=True)))
        ends = sum(e[x] << 2 * k for k, ((_, e, _), x) in enumerate(zip(single, each, strict=True)))
        last = sum(f[x] << 2 * k for k, ((_, _, f), x) in enumerate(zip(single, each, strict=True)))
        self._minimise(table, ends, last)
        self.resets = np.array([bool((self.table[:, self.classes[b]] == 0).all()) for b in range(256)])
        self.backward = [_Backward(r.pattern) for r in rules]

    @staticmethod
    def _blocks(block: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Numbers rows by equality of (block, columns)."""
        radix = int(columns.max()) + 1
        for column in columns.T:
            _, block = np.unique(block.astype(np.int64) * radix + column, return_inverse=True)
        return block

    def _minimise(self, table: np.ndarray, ends: np.ndarray, last: np.ndarray) -> None:
        """Moore's refinement: states stay together while outputs and successors' blocks agree."""
        block = self._blocks(np.unique(last, return_inverse=True)[1], np.unique(ends, return_inverse=True)[1].reshape(ends.shape))
        while True:
            finer = self._blocks(block, block[table])
            if finer.max() == block.max():
                break
            block = finer
        order = np.unique(block, return_index=True)[1]
        order = order[np.argsort(order)]  # the start state stays 0
        rank = np.empty(len(order), dtype=np.int64)
        rank[block[order]] = np.arange(len(order))
        self.table = rank[block[table[order]]].astype(np.int32)
        self.ends, self.last = ends[order], last[order]

    def scan(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Events (text, position in data, mask) over texts data[starts[i]:stops[i]], by text and position."""
        text, begin, end = self._pieces(data, starts, stops)
        order = np.argsort(begin - end, kind="stable")
        text, begin, end = text[order], begin[order], end[order]
        lengths = end - begin
        width = self.table.shape[1]
        table, ends = self.table.ravel() * width, self.ends.ravel()
        symbols = self.classes[data]
        state = np.zeros(len(begin), dtype=np.int32)
        found = []
        alive = len(lengths) - np.searchsorted(lengths[::-1], np.arange(int(lengths[0]) if len(lengths) else 0), side="right")
        for i, k in enumerate(alive):
            at = state[:k] + symbols[begin[:k] + i]
            hit = np.flatnonzero(ends[at])
            if len(hit):
                found.append((text[hit], begin[hit] + i, ends[at[hit]]))
            state[:k] = table[at]
        final = self.last[state // width]
        hit = np.flatnonzero((final > 0) & (end == stops[text]))
        found.append((text[hit], end[hit], final[hit]))
        texts, places, masks = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((places, texts))
        return texts[order], places[order], masks[order]

    def _pieces(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts cut behind reset bytes, about every PIECE bytes; a text without such bytes stays whole."""
        number = np.arange(len(starts))
        long = np.flatnonzero(stops - starts > 2 * PIECE)
        if not len(long) or not self.resets.any():
            return number, starts.copy(), stops.copy()
        resets = np.flatnonzero(self.resets[data])
        texts, cuts = [number], [starts]
        for t in long:
            wanted = np.arange(starts[t] + PIECE, stops[t] - PIECE, PIECE)
            j = np.searchsorted(resets, wanted)
            cut = np.unique(resets[j[j < len(resets)]] + 1)
            cut = cut[cut < stops[t]]
            texts.append(np.full(len(cut), t))
            cuts.append(cut)
        text, begin = np.concatenate(texts), np.concatenate(cuts)
        order = np.lexsort((begin, text))
        text, begin = text[order], begin[order]
        end = np.append(begin[1:], 0)
        final = np.append(text[1:] != text[:-1], True)
        end[final] = stops[text[final]]
        return text, begin, end

    def spans(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """By text: (start, rule, end) in bytes from the text's start, ascending."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        free: dict[tuple[int, int], int] = {}
        raw = memoryview(data)
        for t, p, mask in zip(*(x.tolist() for x in self.scan(data, starts, stops)), strict=True):
            first = int(starts[t])
            for k in range(len(self.rules)):
                if mask >> 2 * k & 1:
                    if mask >> 2 * k + 1 & 1:
                        begin = self.backward[k].first(raw, free.get((t, k), first), p)
                        found.setdefault(t, []).append((begin - first, k, p - first))
                    free[t, k] = p
        return {t: sorted(x) for t, x in found.items()}


class _Backward:
    """A rule's reversed automaton, determinised as it is used."""

    def __init__(self, pattern: str):
        self.nfa = Nfa()
        start = self.nfa.state()
        self.accept = _build(self.nfa, _Parser(pattern).parse(), start, True)
        self.start = self.nfa.closure({start})
        self.moves: dict[tuple[frozenset, int], frozenset] = {}

    def first(self, data, least: int, end: int) -> int:
        """The smallest start >= least of a match that ends at end."""
        state, found = self.start, -1
        for at in range(end - 1, least - 1, -1):
            key = (state, data[at])
            if key not in self.moves:
                self.moves[key] = self.nfa.step(state, data[at])
            state = self.moves[key]
            if not state:
                break
            if self.accept in state:
                found = at
        if found < 0:
            raise AssertionError("a reported match has a start")
        return found
