"""Many regular expressions as one automaton over bytes.

Patterns are read with the standard library's parser, joined as position sets, made deterministic
by subset construction over classes of like bytes, and minimised by partition refinement.  What
remains is an array of transitions per state, with the rules that match at it in the last place.

Supported: literals, classes, groups, alternation, greedy repeats.  No anchors or look-around."""

from re import _constants as op
from re import _parser

import numpy as np


class Graph:
    """A nondeterministic automaton: per state its empty moves and its (bytes, target) moves."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, tree, start: int, fold: bool, backward: bool) -> int:
        """Append what `tree` matches after state `start`; gives its end state."""
        for kind, value in reversed(list(tree)) if backward else tree:
            if kind in (op.LITERAL, op.NOT_LITERAL, op.IN, op.ANY):
                middle, end = self.state(), self.state()
                self.empty[start].append(middle)
                self.moves[middle] = (bytes_of(kind, value, fold), end)
                start = end
            elif kind is op.SUBPATTERN:
                start = self.add(value[-1], start, fold, backward)
            elif kind is op.BRANCH:
                end = self.state()
                for branch in value[1]:
                    first = self.state()
                    self.empty[start].append(first)
                    self.empty[self.add(branch, first, fold, backward)].append(end)
                start = end
            elif kind is op.MAX_REPEAT:
                least, most, inner = value
                for _ in range(least):
                    start = self.add(inner, start, fold, backward)
                if most is op.MAXREPEAT:
                    loop = self.state()
                    self.empty[start].append(loop)
                    self.empty[self.add(inner, loop, fold, backward)].append(loop)
                    start = loop
                else:
                    end = self.state()
                    self.empty[start].append(end)
                    for _ in range(most - least):
                        start = self.add(inner, start, fold, backward)
                        self.empty[start].append(end)
                    start = end
            else:
                raise ValueError(f"not supported in a rule: {kind}")
        return start

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def bytes_of(kind, value, fold: bool) -> frozenset[int]:
    if kind is op.ANY:
        return frozenset(range(256)) - {10}
    if kind in (op.LITERAL, op.NOT_LITERAL):
        found, negated = {value}, kind is op.NOT_LITERAL
    else:
        found, negated = set(), False
        for k, v in value:
            if k is op.NEGATE:
                negated = True
            elif k is op.LITERAL:
                found.add(v)
            elif k is op.RANGE:
                found.update(range(v[0], v[1] + 1))
            else:
                raise ValueError(f"not supported in a class: {k}")
    if max(found) > 127:
        raise ValueError("rules are ASCII")
    if fold:
        found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
    return frozenset(set(range(256)) - found if negated else found)


class Automaton:
    """`classes`: a table for bytes.translate; `table` and `masks`: the next state by state and
    class, and the rules that match at a state as a bit mask."""

    def __init__(self, patterns: list[tuple[str, bool]], searching: bool, backward: bool = False):
        """`patterns`: (pattern, whether letters match in either case).  A searching automaton may
        start a match at every byte."""
        graph = Graph()
        first = graph.state()
        ends = {}
        for rule, (pattern, fold) in enumerate(patterns):
            start = graph.state()
            graph.empty[first].append(start)
            ends[graph.add(_parser.parse(pattern), start, fold, backward)] = 1 << rule
        self.classes, members = byte_classes(graph)
        table, masks = subsets(graph, first, ends, members, searching)
        part = refine(table, masks)
        _, chosen = np.unique(part, return_index=True)
        self.table, self.masks, self.first = part[table[chosen]], masks[chosen], int(part[0])

    def linked(self) -> tuple[list, list | None]:
        """The first state and the state without a way on, each state a list: by class the next
        state's list, then the mask.  Made anew in every process, as it can't be sent."""
        width = self.table.shape[1]
        states: list[list] = [[None] * width + [int(m)] for m in self.masks]
        for state, row in zip(states, self.table.tolist(), strict=True):
            state[:width] = [states[t] for t in row]
        stuck = (s for s in states if not s[width] and all(x is s for x in s[:width]))
        return states[self.first], next(stuck, None)


def byte_classes(graph: Graph) -> tuple[bytes, list[int]]:
    """The class of each byte, and one byte of each class."""
    sets = list({m[0] for m in graph.moves if m})
    signs = [tuple(b in s for s in sets) for b in range(256)]
    number: dict[tuple, int] = {}
    classes = bytes(number.setdefault(s, len(number)) for s in signs)
    return classes, [classes.index(c) for c in range(len(number))]


def subsets(graph: Graph, first: int, ends: dict[int, int], members: list[int], searching: bool):
    """Subset construction: transitions by state and class, and the rules that end at each state.
    Sets of states are bit masks."""
    as_mask = lambda states: sum(1 << s for s in states)
    initial = as_mask(graph.closure([first]))
    ahead: dict[int, list[int]] = {}
    for s, move in enumerate(graph.moves):
        if move:
            target = as_mask(graph.closure([move[1]]))
            ahead[s] = [target if byte in move[0] else 0 for byte in members]
    moving = as_mask(ahead)
    number, order, rows = {initial: 0}, [initial], []
    for states in order:
        row = [initial if searching else 0] * len(members)
        left = states & moving
        while left:
            s = (left & -left).bit_length() - 1
            left &= left - 1
            row = [a | b for a, b in zip(row, ahead[s], strict=True)]
        for target in row:
            if target not in number:
                number[target] = len(order)
                order.append(target)
        rows.append([number[target] for target in row])
    masks = [sum(m for s, m in ends.items() if states >> s & 1) for states in order]
    return np.array(rows), np.array(masks, dtype=np.int64)


def refine(table: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The coarsest partition into states that no continuation tells apart."""
    part = np.unique(masks, return_inverse=True)[1].ravel()
    while True:
        signs = np.column_stack([part, part[table]])
        finer = np.unique(signs, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            return finer
        part = finer
