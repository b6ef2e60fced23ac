"""Rule regexes compiled to one deterministic automaton over bytes.

Each rule becomes an automaton that finds its leftmost, longest, non-overlapping matches; their product is
minimised into one transition array, and one pass over the bytes serves all rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

#: Lanes that are scanned side by side, and how much longer than its share a lane may be before it is
#: scanned on its own (by the same automaton): a stretch without any byte that ends all matches.
LANES = 2048
LONG_LANE = 64


# --- regex to nondeterministic automaton -------------------------------------------------------------------


class _Builder:
    """States are numbers; ``moves[s]`` are (byte set, state), ``free[s]`` states reached without a byte."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def literal(self, allowed: frozenset[int]) -> tuple[int, int]:
        a, b = self.state(), self.state()
        self.moves[a].append((allowed, b))
        return a, b

    def chain(self, parts: list[tuple[int, int]]) -> tuple[int, int]:
        for (_, end), (start, _) in zip(parts, parts[1:]):
            self.free[end].append(start)
        return (parts[0][0], parts[-1][1]) if parts else (s := self.state(), s)

    def either(self, parts: list[tuple[int, int]]) -> tuple[int, int]:
        a, b = self.state(), self.state()
        for start, end in parts:
            self.free[a].append(start)
            self.free[end].append(b)
        return a, b


class _Parser:
    """Literals, ``[...]`` with ranges, ``\\xHH`` and escapes, groups, ``|``, ``? * +`` and ``{n}``, ``{n,}``."""

    def __init__(self, pattern: str, any_case: bool) -> None:
        self.tokens = re.findall(r"\\x[0-9A-Fa-f]{2}|\\.|\{\d+,?\}|.", pattern, re.S)
        self.any_case, self.at, self.out = any_case, 0, _Builder()

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def byte(self, token: str) -> int:
        return int(token[2:], 16) if token.startswith("\\x") else ord(token[-1])

    def either(self) -> tuple[int, int]:
        parts = [self.chain()]
        while self.peek() == "|":
            self.take()
            parts.append(self.chain())
        return self.out.either(parts) if len(parts) > 1 else parts[0]

    def chain(self) -> tuple[int, int]:
        parts = []
        while self.peek() not in ("", "|", ")"):
            start = self.at
            one = self.atom()
            sign = self.peek()
            if sign in ("?", "*", "+"):
                self.take()
                one = self.repeated(one, sign)
            elif sign.startswith("{") and len(sign) > 1:
                self.take()
                after, times = self.at, int(re.search(r"\d+", sign)[0])
                copies = [one]
                for _ in range(times - 1):
                    self.at = start
                    copies.append(self.atom())
                if sign.endswith(",}"):
                    copies[-1] = self.repeated(copies[-1], "+")
                self.at = after
                one = self.out.chain(copies)
            parts.append(one)
        return self.out.chain(parts)

    def repeated(self, part: tuple[int, int], sign: str) -> tuple[int, int]:
        a, b = self.out.state(), self.out.state()
        self.out.free[a].append(part[0])
        self.out.free[part[1]].append(b)
        if sign in "?*":
            self.out.free[a].append(b)
        if sign in "*+":
            self.out.free[part[1]].append(part[0])
        return a, b

    def atom(self) -> tuple[int, int]:
        token = self.take()
        if token == "(":
            inside = self.either()
            self.take()
            return inside
        if token == "[":
            allowed: set[int] = set()
            while self.peek() != "]":
                low = self.byte(self.take())
                if self.peek() == "-" and self.tokens[self.at + 1] != "]":
                    self.take()
                    allowed.update(range(low, self.byte(self.take()) + 1))
                else:
                    allowed.add(low)
            self.take()
        else:
            allowed = {self.byte(token)}
        if self.any_case:
            allowed |= {ord(chr(b).swapcase()) for b in allowed if b < 128 and chr(b).isalpha()}
        return self.out.literal(frozenset(allowed))


# --- deterministic automata --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """``least`` bounds the match, or with ``of_tail`` the part from the first byte that completes a match
    (the last, repeated part of the pattern). Matches below it are found and dropped, so they still use up
    the text they cover. Every pattern must end in a repeated byte set or a fixed text."""

    kind: str
    pattern: str
    least: int = 1
    of_tail: bool = False
    any_case: bool = False


class _Nfa:
    def __init__(self, rule: Rule) -> None:
        parser = _Parser(rule.pattern, rule.any_case)
        self.start, self.end = parser.either()
        self.moves, self.free = parser.out.moves, parser.out.free
        self.first = self.closure({self.start})

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({t for s in states for allowed, t in self.moves[s] if byte in allowed})

    def sets(self) -> set[frozenset[int]]:
        return {allowed for moves in self.moves for allowed, _ in moves}


def _one_rule(rule: Rule, examples: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions (state, byte class) and accepting states of the leftmost, longest, non-overlapping search.

    A state is the list of live attempts, earliest start first, each a set of nondeterministic states. An
    attempt that completes ends all later ones; when it cannot go on, the search starts afresh with the byte
    that ended it.
    """
    nfa = _Nfa(rule)

    def settle(attempts: list[frozenset[int]]) -> tuple[frozenset[int], ...]:
        seen: set[int] = set()
        kept = []
        for states in attempts:
            own = frozenset(states - seen)
            seen |= own
            if own:
                kept.append(own)
        done = [i for i, states in enumerate(kept) if nfa.end in states]
        if done and done[0] > 0:
            raise ValueError(f"{rule.kind}: a later match completes before an earlier attempt is decided")
        return tuple(kept[:1] if done else kept)

    def step(state: tuple[frozenset[int], ...], byte: int) -> tuple[frozenset[int], ...]:
        if state and nfa.end in state[0]:
            onward = nfa.step(state[0], byte)
            if onward:
                if nfa.end not in onward:
                    raise ValueError(f"{rule.kind}: a complete match may grow only byte by byte")
                return (onward,)
            state = ()
        return settle([*(nfa.step(s, byte) for s in state), nfa.step(nfa.first, byte)])

    number: dict[tuple, int] = {(): 0}
    order, table = [()], []
    for state in order:  # grows while it is read
        row = []
        for byte in examples:
            target = step(state, byte)
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
    return np.array(table), np.array([bool(s) and nfa.end in s[0] for s in order])


def _minimised(table: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Merge states that no input tells apart; returns transitions, labels and the start state."""
    block, count = np.unique(label, return_inverse=True)[1], 0
    while True:
        shape = np.column_stack([block, block[table]])
        _, first, block = np.unique(shape, axis=0, return_index=True, return_inverse=True)
        block = block.ravel()
        if len(first) == count:
            return block[table[first]], label[first], int(block[0])
        count = len(first)


@dataclass(frozen=True)
class Automaton:
    rules: tuple[Rule, ...]
    byte_class: np.ndarray  # of each byte
    moves: np.ndarray  # flat; state times classes plus class -> next state times classes
    accepts: np.ndarray  # bit set of the rules that are complete in a state
    start: int
    ends_all: np.ndarray  # bytes after which every state is the start state

    def scan(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which some rule is complete, and the bit set of those rules."""
        data = np.frombuffer(text, dtype=np.uint8)
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.uint16)
        classes = self.byte_class[data]
        stops = np.flatnonzero(self.ends_all[data]) + 1
        share = max(64, -(-len(data) // LANES))
        wanted = np.arange(share, len(data), share)
        cuts = np.searchsorted(stops, wanted)
        begin = np.unique(np.r_[0, stops[cuts[cuts < len(stops)]]])
        begin = begin[begin < len(data)]
        length = np.diff(np.r_[begin, len(data)])
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        alone = int((length > LONG_LANE * share).sum())
        found = [self._scan_alone(classes, b, n) for b, n in zip(begin[:alone], length[:alone])]
        begin, length = begin[alone:], length[alone:]
        state = np.full(len(begin), self.start, dtype=np.int32)
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), "left")
        where, hits = [], []
        for t, n in enumerate(active):
            at = begin[:n] + t
            state = self.moves[state[:n] + classes[at]]
            label = self.accepts[state]
            if label.any():
                hit = np.flatnonzero(label)
                where.append(at[hit])
                hits.append(label[hit])
        where += [w for w, _ in found]
        hits += [h for _, h in found]
        if not where:
            return np.empty(0, np.int64), np.empty(0, np.uint16)
        where, hits = np.concatenate(where), np.concatenate(hits)
        order = np.argsort(where, kind="stable")
        return where[order], hits[order]

    def _scan_alone(self, classes: np.ndarray, begin: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        moves, accepts, state = self.moves.tolist(), self.accepts.tolist(), self.start
        where, hits = [], []
        for at, c in enumerate(classes[begin : begin + length].tolist(), int(begin)):
            state = moves[state + c]
            if accepts[state]:
                where.append(at)
                hits.append(accepts[state])
        return np.array(where, np.int64), np.array(hits, np.uint16)


def compile_rules(rules: tuple[Rule, ...]) -> Automaton:
    if len(rules) > 16:
        raise ValueError("at most 16 rules share an automaton")
    sets = sorted({s for rule in rules for s in _Nfa(rule).sets()}, key=sorted)
    signature = [tuple(b in s for s in sets) for b in range(256)]
    classes = {sig: i for i, sig in enumerate(dict.fromkeys(signature))}
    byte_class = np.array([classes[s] for s in signature], dtype=np.int32)
    examples = [signature.index(sig) for sig in classes]
    single = [_one_rule(rule, examples) for rule in rules]
    number = {(0,) * len(rules): 0}
    order, table = [(0,) * len(rules)], []
    for state in order:  # the product: states of all rules that occur together
        rows = [t[s] for (t, _), s in zip(single, state)]
        targets = list(zip(*(r.tolist() for r in rows)))
        for target in targets:
            if target not in number:
                number[target] = len(order)
                order.append(target)
        table.append([number[t] for t in targets])
    label = np.array([sum(1 << r for r, (_, done) in enumerate(single) if done[s[r]]) for s in order], dtype=np.uint16)
    moves, label, start = _minimised(np.array(table), label)
    width = moves.shape[1]
    accepts = np.zeros(len(label) * width, dtype=np.uint16)
    accepts[::width] = label
    ends = (moves == start).all(axis=0)
    return Automaton(
        rules, byte_class, (moves * width).astype(np.int32).ravel(), accepts, start * width, ends[byte_class]
    )


class Reader:
    """Turns completed positions into spans: their starts come from reading the pattern backwards."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton
        self.backwards = []
        for rule in automaton.rules:
            nfa = _Nfa(rule)
            moves: dict[int, list[tuple[frozenset[int], int]]] = {}
            free: dict[int, list[int]] = {}
            for s, targets in enumerate(nfa.moves):
                for allowed, t in targets:
                    moves.setdefault(t, []).append((allowed, s))
            for s, targets in enumerate(nfa.free):
                for t in targets:
                    free.setdefault(t, []).append(s)
            self.backwards.append((nfa.start, nfa.end, moves, free))

    def start_of(self, rule: int, text: bytes, first: int, lowest: int) -> int:
        """The smallest start, not below ``lowest``, of a match that ends with byte ``first``."""
        start, end, moves, free = self.backwards[rule]

        def closure(states: set[int]) -> set[int]:
            todo = list(states)
            while todo:
                for s in free.get(todo.pop(), ()):
                    if s not in states:
                        states.add(s)
                        todo.append(s)
            return states

        states, best, at = closure({end}), first, first
        while at >= lowest and states:
            states = closure({t for s in states for allowed, t in moves.get(s, ()) if text[at] in allowed})
            if start in states:
                best = at
            at -= 1
        return best

    def spans(self, text: bytes, borders: np.ndarray) -> list[tuple[int, int, int]]:
        """(rule, start, end) of all matches, end exclusive; ``borders`` are the starts of the documents."""
        where, hits = self.automaton.scan(text)
        out = []
        for r, rule in enumerate(self.automaton.rules):
            own = where[(hits >> r) & 1 == 1]
            if not len(own):
                continue
            breaks = np.flatnonzero(np.diff(own) > 1) + 1
            firsts, lasts = own[np.r_[0, breaks]], own[np.r_[breaks - 1, len(own) - 1]]
            lows = borders[np.searchsorted(borders, firsts, "right") - 1]
            used = 0
            for first, last, low in zip(firsts.tolist(), lasts.tolist(), lows.tolist()):
                begin = self.start_of(r, text, first, max(low, used))
                used = last + 1
                if used - (first if rule.of_tail else begin) >= rule.least:
                    out.append((r, begin, used))
        return out
