"""Regular expressions over bytes as one minimal deterministic automaton in transition arrays.

Patterns are parsed to a tree, the tree becomes a nondeterministic automaton, subset construction makes
it deterministic, and states that no input tells apart are merged.  Each pattern of a combined
automaton has its bit, and a state's output says which patterns have just been matched.

Understood are characters (those beyond ASCII as their UTF-8 bytes), ``\\xHH``, ``\\n``, ``\\t``, other
escaped punctuation, classes with ranges and ``^``, groups ``(..)`` and ``(?:..)``, ``(?i:..)`` for the
letters A-Z in either case, ``|``, ``?``, ``*``, ``+``, ``{n}``, ``{n,}`` and ``{n,m}``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ANY = frozenset(range(256))
ESCAPED = {"n": 10, "t": 9, "r": 13, "f": 12, "v": 11}
#: Lanes that step through a run of bytes side by side, and rounds of mending before one lane goes alone.
LANES, MENDING_ROUNDS = 4096, 8


class _Parser:
    def __init__(self, pattern: str):
        self.rest, self.folding = pattern, False

    def take(self, count: int = 1) -> str:
        head, self.rest = self.rest[:count], self.rest[count:]
        if len(head) < count:
            raise ValueError("pattern ends too early")
        return head

    def whole(self):
        tree = self.either()
        if self.rest:
            raise ValueError(f"unexpected {self.rest[0]!r}")
        return tree

    def either(self):
        options = [self.sequence()]
        while self.rest.startswith("|"):
            self.take()
            options.append(self.sequence())
        return ("or", options) if len(options) > 1 else options[0]

    def sequence(self):
        items = []
        while self.rest and self.rest[0] not in "|)":
            items.append(self.repeated(self.atom()))
        return ("cat", items)

    def repeated(self, item):
        while self.rest and self.rest[0] in "?*+{":
            sign = self.take()
            if sign == "{":
                bounds, brace, self.rest = self.rest.partition("}")
                if not brace:
                    raise ValueError("unclosed {")
                low, comma, high = bounds.partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            item = ("rep", item, least, most)
        return item

    def atom(self):
        c = self.take()
        if c == "(":
            held = self.folding
            for opening, folding in (("?:", held), ("?i:", True)):
                if self.rest.startswith(opening):
                    self.take(len(opening))
                    self.folding = folding
            if self.rest.startswith("?"):
                raise ValueError("unknown group")
            tree = self.either()
            if not self.rest.startswith(")"):
                raise ValueError("unclosed (")
            self.take()
            self.folding = held
            return tree
        if c == "[":
            return ("set", self.bracket())
        if c in "?*+{":
            raise ValueError(f"nothing before {c!r}")
        if c == "\\":
            return ("set", self.folded({self.escaped()}))
        if ord(c) < 128:
            return ("set", ANY - {10} if c == "." else self.folded({ord(c)}))
        return ("cat", [("set", frozenset({b})) for b in c.encode()])

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            return int(self.take(2), 16)
        if c in ESCAPED:
            return ESCAPED[c]
        if c.isalnum() or ord(c) > 127:
            raise ValueError(f"unknown escape {c!r}")
        return ord(c)

    def bracket(self) -> frozenset:
        negated = self.rest.startswith("^")
        if negated:
            self.take()
        members, first = set(), True
        while first or not self.rest.startswith("]"):
            first = False
            low = self.member()
            high = low
            if self.rest.startswith("-") and not self.rest.startswith("-]"):
                self.take()
                high = self.member()
            members.update(range(low, high + 1))
        self.take()
        return ANY - self.folded(members) if negated else self.folded(members)

    def member(self) -> int:
        c = self.take()
        if ord(c) > 127:
            raise ValueError("only ASCII in classes")
        return self.escaped() if c == "\\" else ord(c)

    def folded(self, members) -> frozenset:
        if self.folding:
            members = set(members) | {b ^ 32 for b in members if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(members)


def _reversed(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [_reversed(t) for t in tree[1][::-1]])
    if kind == "or":
        return ("or", [_reversed(t) for t in tree[1]])
    return ("rep", _reversed(tree[1]), *tree[2:]) if kind == "rep" else tree


class _Nondeterministic:
    """States with either free moves or one move on a set of bytes; built from the end backwards."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.move: list[tuple[frozenset, int] | None] = []
        self.output: list[int] = []

    def state(self, free=(), move=None, output=0) -> int:
        self.free.append(list(free))
        self.move.append(move)
        self.output.append(output)
        return len(self.free) - 1

    def before(self, tree, to: int) -> int:
        """A state from which ``tree`` leads to the state ``to``."""
        kind = tree[0]
        if kind == "set":
            return self.state(move=(tree[1], to))
        if kind == "cat":
            for part in tree[1][::-1]:
                to = self.before(part, to)
            return to
        if kind == "or":
            return self.state(free=[self.before(t, to) for t in tree[1]])
        _, part, least, most = tree
        if most is None:
            loop = self.state(free=[to])
            self.free[loop].append(self.before(part, loop))
            to = loop
        else:
            for _ in range(most - least):
                to = self.state(free=[self.before(part, to), to])
        for _ in range(least):
            to = self.before(part, to)
        return to

    def closure(self, states) -> frozenset:
        seen, waiting = set(states), list(states)
        while waiting:
            for s in self.free[waiting.pop()]:
                if s not in seen:
                    seen.add(s)
                    waiting.append(s)
        return frozenset(s for s in seen if self.move[s] or self.output[s])


@dataclass(frozen=True)
class Automaton:
    """``steps[state + code]`` is the next state; states are multiples of ``codes``, so no product is needed.

    ``code`` gives the code of a byte, ``codes - 1`` is the code of an end of text, which leads any
    state to the start.  ``output[state]`` is the mask of patterns matched, ``hope[state]`` of those
    that may still be.
    """

    code: np.ndarray
    codes: int
    steps: np.ndarray
    output: np.ndarray
    hope: np.ndarray
    start: int

    @property
    def states(self) -> int:
        return len(self.steps) // self.codes

    def along(self, codes: np.ndarray, begin: int | None = None) -> np.ndarray:
        """The state after each code, from the start or the state ``begin``.

        The run is cut in lanes that step together, each as if it began at the start.  Lanes whose
        predecessor ends elsewhere step again from there until they meet the states they had, which
        nearly always takes a few bytes.  Lanes that keep waiting for each other, as in a text of
        blanks alone, are stepped one after the other, so the work stays linear.
        """
        if not len(codes):
            return np.zeros(0, np.intp)
        lanes = max(1, min(LANES, len(codes) // 64))
        width = -(-len(codes) // lanes)
        grid = np.full(lanes * width, self.codes - 1, np.intp)
        grid[: len(codes)] = codes
        grid = np.ascontiguousarray(grid.reshape(lanes, width).T)
        seen = np.empty((width, lanes), np.intp)
        begin = self.start if begin is None else begin
        assumed = np.full(lanes, self.start, np.intp)
        assumed[0] = begin
        now = assumed.copy()
        for i in range(width):
            np.take(self.steps, now + grid[i], out=seen[i], mode="clip")
            now = seen[i]
        for _ in range(MENDING_ROUNDS):
            entered = np.concatenate([[begin], seen[-1, :-1]])
            wrong = np.flatnonzero(entered != assumed)
            if not len(wrong):
                break
            now = assumed[wrong] = entered[wrong]
            for i in range(width):
                now = self.steps[now + grid[i, wrong]]
                other = now != seen[i, wrong]
                now, wrong = now[other], wrong[other]
                if not len(wrong):
                    break
                seen[i, wrong] = now
        else:
            steps = self.steps.tolist()
            for lane in range(1, lanes):
                state = int(seen[-1, lane - 1])
                if state != assumed[lane]:
                    for i, code in enumerate(grid[:, lane].tolist()):
                        state = steps[state + code]
                        if state == seen[i, lane]:
                            break
                        seen[i, lane] = state
        return seen.T.reshape(-1)[: len(codes)]

    def longest(self, data: bytes, at: int, bit: int) -> tuple[int, int]:
        """(end, output there) of the longest match of one pattern that begins at a byte; (at, 0) if none."""
        steps, code, state, end, told = self.steps, self.code, self.start, at, 0
        for place in range(at, len(data)):
            state = steps[state + code[data[place]]]
            if not int(self.hope[state]) & bit:
                break
            if int(self.output[state]) & bit:
                end, told = place + 1, int(self.output[state])
        return end, told


def compile_patterns(patterns: list[str], anchored: bool = True, backwards: bool = False) -> Automaton:
    """One minimal automaton of up to 63 patterns.

    ``anchored`` matches begin at the first byte only; without it they may begin at any.  With
    ``backwards`` texts are read from their ends, and a match is told where it begins.
    """
    if len(patterns) > 63:
        raise ValueError("at most 63 patterns")
    loose, starts = _Nondeterministic(), []
    for number, pattern in enumerate(patterns):
        tree = _Parser(pattern).whole()
        starts.append(loose.before(_reversed(tree) if backwards else tree, loose.state(output=1 << number)))
        if any(loose.output[s] for s in loose.closure([starts[-1]])):
            raise ValueError(f"{pattern!r} matches an empty text")
    # Bytes that every set treats alike share a code.
    sets = list({m[0] for m in loose.move if m})
    kinds: dict[tuple, int] = {}
    code = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)])
    sample = [int(np.flatnonzero(code == c)[0]) for c in range(len(kinds))]
    begin = loose.closure(starts)
    number, rows, waiting = {begin: 0}, [], [begin]
    for states in waiting:
        row = []
        for byte in sample:
            moved = loose.closure([m[1] for m in map(loose.move.__getitem__, states) if m and byte in m[0]])
            if not anchored:
                moved |= begin
            if moved not in number:
                number[moved] = len(number)
                waiting.append(moved)
            row.append(number[moved])
        rows.append(row)
    table = np.array(rows, np.int64)
    output = np.array([sum({loose.output[s] for s in states}) for states in waiting], np.int64)
    # Minimisation: parts of equal output are split until equal states also step to equal parts.
    part = np.unique(output, return_inverse=True)[1].reshape(-1)
    while True:
        split = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if split.max() == part.max():
            break
        part = split
    member = np.zeros(part.max() + 1, np.int64)
    member[part] = np.arange(len(part))
    table, output, start = part[table[member]], output[member], int(part[0])
    hope = output.copy()
    while True:
        more = hope | np.bitwise_or.reduce(hope[table], axis=1)
        if (more == hope).all():
            break
        hope = more
    codes = len(sample) + 1
    steps = np.column_stack([table, np.full(len(table), start)]) * codes
    wide = lambda values: np.repeat(values, codes)
    return Automaton(code.astype(np.uint16), codes, steps.reshape(-1).astype(np.intp), wide(output), wide(hope), start * codes)
