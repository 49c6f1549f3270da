"""Rule regexes compiled to one deterministic automaton over bytes.

The rules are parsed to a nondeterministic automaton, made deterministic by subset construction with the search state
always alive (so a match may begin anywhere), and minimised by partition refinement. What is left is a transition array
`table[state, class]`, a byte-class array and, per state, the bit set of the rules that end there.

Syntax: literals, `\\xHH`, escaped characters, classes with ranges and negation, groups, `|`, `?`, `*`, `+`, `{m}`,
`{m,}`, `{m,n}`. Byte 0xFF, which UTF-8 never has, resets the automaton; texts are laid end to end with it in between.
"""

from __future__ import annotations

import numpy as np

RESET = 0xFF
_ALL = frozenset(range(255))


class _Parser:
    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        c = self.text[self.at]
        self.at += 1
        return c

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("or", options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            item = self.atom()
            while self.peek() in ("?", "*", "+", "{") and self.peek():
                item = self.repeated(item)
            items.append(item)
        return ("seq", items)

    def repeated(self, item):
        c = self.take()
        if c != "{":
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        else:
            end = self.text.index("}", self.at)
            low_text, comma, high_text = self.text[self.at : end].partition(",")
            self.at = end + 1
            low = int(low_text)
            high = low if not comma else int(high_text) if high_text else None
        return ("rep", item, low, high)

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def atom(self):
        c = self.take()
        if c == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            inner = self.alternatives()
            self.take()
            return inner
        if c == "[":
            return ("set", self.members())
        if c == ".":
            return ("set", _ALL - {10})
        return ("set", frozenset([self.escaped() if c == "\\" else ord(c)]))

    def members(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.escaped() if (c := self.take()) == "\\" else ord(c)
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.escaped() if (c := self.take()) == "\\" else ord(c)
            found.update(range(low, high + 1))
        self.take()
        return frozenset(_ALL - found if negated else found)


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def build(self, node, start: int) -> int:
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "seq":
            for item in node[1]:
                start = self.build(item, start)
            return start
        if kind == "or":
            end = self.state()
            for option in node[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.build(option, first)].append(end)
            return end
        _, item, low, high = node
        for _ in range(low):
            start = self.build(item, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.build(item, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.build(item, start)
            self.empty[start].append(end)
        return end

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


class Automaton:
    """`rules` maps names to regexes; bit i of `accepts[state]` is the i-th rule."""

    def __init__(self, rules: dict[str, str]):
        self.names = list(rules)
        nfa = _Nfa()
        root = nfa.state()
        ends = {}
        for i, pattern in enumerate(rules.values()):
            first = nfa.state()
            nfa.empty[root].append(first)
            ends[nfa.build(_Parser(pattern).alternatives(), first)] = 1 << i
        sets = {s for moves in nfa.moves for s, _ in moves}
        signature = [tuple(b in s for s in sets) for b in range(255)]
        kinds = {sig: k for k, sig in enumerate(dict.fromkeys(signature))}
        classes = np.array([kinds[sig] for sig in signature] + [len(kinds)], np.uint8)
        samples = [signature.index(sig) for sig in kinds]
        start = nfa.closed([root])
        number, todo, table = {start: 0}, [start], []
        while todo:
            current = todo.pop(0)
            row = []
            for b in samples:
                target = nfa.closed([t for s in current for members, t in nfa.moves[s] if b in members] + [root])
                if target not in number:
                    number[target] = len(number)
                    todo.append(target)
                row.append(number[target])
            table.append([*row, 0])
        accepts = np.zeros(len(number), np.int64)
        for states, k in number.items():
            for s in states:
                accepts[k] |= ends.get(s, 0)
        self.table, self.accepts = self._minimised(np.array(table), accepts)
        self.classes = classes
        self.flat = self.table.astype(np.int32).ravel() * self.table.shape[1]

    @staticmethod
    def _minimised(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moore's refinement: split blocks by the blocks their moves lead to until nothing splits."""
        block = np.unique(accepts, return_inverse=True)[1]
        while True:
            _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            if finer.max() == block.max():
                break
            block = finer
        block = finer
        order = np.concatenate([[block[0]], np.setdiff1d(np.arange(block.max() + 1), [block[0]])])
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        first = np.unique(block, return_index=True)[1][order]
        return new[block[table[first]]], accepts[first]

    def hits(self, data: np.ndarray, lane: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which rules end, and their bits, in one pass over all bytes.

        The bytes are cut into lanes that advance together, each from the start state. A lane whose neighbour to the
        left ended in another state is run again from that state until both runs meet; what that adds is kept.
        """
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = self.table.shape[1]
        lanes = -(-n // lane)
        padded = np.full(lanes * lane, self.classes[RESET], np.uint8)
        padded[:n] = self.classes[data]
        steps = np.ascontiguousarray(padded.reshape(lanes, lane).T).astype(np.int32)
        ending = self.accepts != 0
        by_offset = np.zeros(len(self.flat), bool)
        by_offset[::width] = ending
        places, states = [], []
        state = np.zeros(lanes, np.int32)
        for t in range(lane):
            state = self.flat[state + steps[t]]
            here = by_offset[state]
            if here.any():
                at = np.flatnonzero(here)
                places.append(at * lane + t)
                states.append(state[at])
        wrong = np.flatnonzero(state[:-1] != 0) + 1
        finals = state
        begins = finals[wrong - 1]
        while len(wrong):
            right, left = begins.copy(), np.zeros(len(wrong), np.int32)
            live = np.arange(len(wrong))
            for t in range(lane):
                c = steps[t][wrong[live]]
                right[live] = self.flat[right[live] + c]
                left[live] = self.flat[left[live] + c]
                at = live[by_offset[right[live]]]
                if len(at):
                    places.append(wrong[at] * lane + t)
                    states.append(right[at])
                live = live[right[live] != left[live]]
                if not len(live):
                    break
            # Lanes whose run from the right state never met the other end in another state: their neighbours run next.
            moved = live[wrong[live] + 1 < lanes]
            wrong, begins = wrong[moved] + 1, right[moved]
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, bits = np.concatenate(places), self.accepts[np.concatenate(states) // width]
        inside = at < n
        return at[inside], bits[inside]
