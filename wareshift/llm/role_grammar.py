"""Cheapest repair of a role sequence by generalised LR parsing.

``RoleGrammar`` builds SLR(1) tables from productions.  ``RoleRepair`` reads
a conversation's rows from left to right and keeps a graph-structured stack:
nodes (LR state, node below) shared between the live stacks.  A row is kept
(shift its role), reroled (shift another), deleted (no shift), and turns may
be inserted before it (shifts without a row).  Live stacks with equal tops
are merged into the one of least (cost, audit); the tables are checked to
have equal futures under equal tops, so that the merge loses nothing.

The audit is the edits' letters in order.  Between rows all live audits end
with a row's letter and hold as many row letters, so none is a proper prefix
of another and their order never changes by what follows.  That makes a
step a function of the live stacks, their costs above the least, the order
of their audits, and the row; steps are computed once and remembered, and a
conversation keeps one small integer a row.  A stack that another one can
imitate for less than the difference of their costs is dropped: it can
neither win nor tie.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterable
from typing import NamedTuple

END = "$"
INSERT_COST, REROLE_COST, DELETE_COST, OPEN_COST = 3, 3, 4, 3
#: Initials that a row may be reroled to, or a turn inserted with.
ROLES = {"u": "user", "a": "assistant"}
#: C -> (s? (u a)+)?
CONVERSATION = (("C", ""), ("C", "D"), ("D", "T"), ("D", "sT"), ("T", "ua"), ("T", "Tua"))


class Node(NamedTuple):
    """A stack: its top state and the stack below."""

    state: int
    below: "Node | None"


class RoleGrammar:
    """SLR(1) tables; left sides are the non-terminals, one letter each."""

    def __init__(self, productions: Iterable[tuple[str, str]] = CONVERSATION):
        rules = [("^", productions[0][0]), *productions]
        names = {left for left, _ in rules}
        self.rules = rules
        self.terminals = sorted({c for _, right in rules for c in right if c not in names})
        follow = _follow(rules, names)

        def closure(items: set[tuple[int, int]]) -> frozenset:
            todo = list(items)
            while todo:
                rule, dot = todo.pop()
                for n, (left, _) in enumerate(rules):
                    if rules[rule][1][dot : dot + 1] == left and (n, 0) not in items:
                        items.add((n, 0))
                        todo.append((n, 0))
            return frozenset(items)

        states = [closure({(0, 0)})]
        self.goto: list[dict[str, int]] = []
        self.reduce: list[dict[str, list[int]]] = []
        for state in states:  # grows while new states are found
            moves: dict[str, set] = {}
            ends: dict[str, list[int]] = {}
            for rule, dot in sorted(state):
                left, right = rules[rule]
                if dot < len(right):
                    moves.setdefault(right[dot], set()).add((rule, dot + 1))
                else:
                    for c in sorted(follow[left]):
                        ends.setdefault(c, []).append(rule)
            self.goto.append({})
            for c, items in moves.items():
                to = closure(items)
                if to not in states:
                    states.append(to)
                self.goto[-1][c] = states.index(to)
            self.reduce.append(ends)
        self.root = Node(0, None)
        self._next: dict[tuple[Node, str], tuple[Node, ...]] = {}
        self._check_merging()

    def reductions(self, stack: Node, lookahead: str) -> Iterable[Node]:
        """The stack and all that reductions before ``lookahead`` make of it."""
        todo = [stack]
        while todo:
            node = todo.pop()
            yield node
            for rule in self.reduce[node.state].get(lookahead, ()):
                if rule == 0:
                    continue
                left, right = self.rules[rule]
                base = node
                for _ in right:
                    base = base.below
                to = self.goto[base.state].get(left)
                if to is not None:
                    todo.append(Node(to, base))

    def shift(self, stack: Node, terminal: str) -> tuple[Node, ...]:
        """All stacks after reading ``terminal``."""
        key = (stack, terminal)
        if key not in self._next:
            self._next[key] = tuple(dict.fromkeys(
                Node(self.goto[n.state][terminal], n) for n in self.reductions(stack, terminal)
                if terminal in self.goto[n.state]))
        return self._next[key]

    def accepts(self, stack: Node) -> bool:
        return any(0 in self.reduce[n.state].get(END, ()) for n in self.reductions(stack, END))

    def stacks(self) -> list[Node]:
        """All stacks between two terminals (their number must be finite)."""
        found = [self.root]
        for stack in found:
            for t in self.terminals:
                found.extend(n for n in self.shift(stack, t) if n not in found)
            if len(found) > 1000:
                raise ValueError("the grammar's stacks are not bounded; use left recursion")
        return found

    def _check_merging(self) -> None:
        stacks = self.stacks()
        kind = {s: int(self.accepts(s)) for s in stacks}
        while True:
            signs = {s: (kind[s], *[frozenset(kind[n] for n in self.shift(s, t)) for t in self.terminals]) for s in stacks}
            numbers = {sign: i for i, sign in enumerate(dict.fromkeys(signs.values()))}
            if len(numbers) == len(set(kind.values())):
                break
            kind = {s: numbers[signs[s]] for s in stacks}
        tops: dict[int, int] = {}
        if any(tops.setdefault(s.state, kind[s]) != kind[s] for s in stacks):
            raise ValueError("stacks with equal tops have different futures; merging them would lose repairs")


def _follow(rules: list[tuple[str, str]], names: set[str]) -> dict[str, set[str]]:
    empty: set[str] = set()
    first: dict[str, set[str]] = {n: set() for n in names}
    follow: dict[str, set[str]] = {n: set() for n in names}
    follow["^"].add(END)
    before = None
    while before != (before := (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))):
        for left, right in rules:
            if all(c in empty for c in right):
                empty.add(left)
            for c in right:
                first[left] |= first[c] if c in names else {c}
                if c not in empty:
                    break
            after = follow[left]
            for c in reversed(right):
                if c in names:
                    follow[c] |= after
                    after = first[c] | (after if c in empty else set())
                else:
                    after = {c}
    return follow


class Live(NamedTuple):
    """A live stack between rows: cost above the least, place of its audit."""

    stack: Node
    cost: int
    order: int


class Step(NamedTuple):
    """What one row does to the live stacks: their number, the cost all
    share, and for each new stack (old stack's index, edits, roles)."""

    to: int
    cost: int
    came: tuple[tuple[int, str, str], ...]


class RoleRepair:
    """Cheapest repairs, (cost, audit) least, of rows given one by one.

    A row is a letter: its role's initial where it is a terminal of the
    grammar, else ``x``; in upper case where its text is cut off; ``-`` where
    it must be deleted.
    """

    def __init__(self, grammar: RoleGrammar | None = None):
        self.grammar = grammar or RoleGrammar()
        self.extra = self._imitation_costs()
        start = (Live(self.grammar.root, 0, 0),)
        self.fronts: list[tuple[Live, ...]] = [start]
        self.number = {start: 0}
        self.steps: list[Step] = []
        self.known: dict[tuple[int, str], int] = {}
        self.ends: dict[int, tuple[int, int, str, str] | None] = {}

    def _with_inserts(self, front: tuple[Live, ...]) -> dict[int, tuple]:
        """Best (cost, order, edits, roles, index, stack) by top state, any
        turns inserted."""
        heap = [(x.cost, x.order, "", "", i, x.stack) for i, x in enumerate(front)]
        heapq.heapify(heap)
        best: dict[int, tuple] = {}
        while heap:
            found = heapq.heappop(heap)
            cost, order, edits, roles, i, stack = found
            if stack.state in best:
                continue
            best[stack.state] = found
            for t in ROLES:
                for n in self.grammar.shift(stack, t):
                    heapq.heappush(heap, (cost + INSERT_COST, order, edits + "I", roles + t, i, n))
        return best

    def step(self, front: int, row: str) -> int:
        """Number of the step that a row takes from a front."""
        at = self.known.get((front, row))
        if at is None:
            at = self.known[front, row] = len(self.steps)
            self.steps.append(self._step(front, row))
        return at

    def _step(self, front: int, row: str) -> Step:
        grammar = self.grammar
        new: dict[int, tuple] = {}

        def offer(stack: Node, found: tuple) -> None:
            if stack.state not in new or found < new[stack.state][0]:
                new[stack.state] = (found, stack)

        for cost, order, edits, roles, i, stack in self._with_inserts(self.fronts[front]).values():
            offer(stack, (cost + DELETE_COST, order, edits + "D", roles, i))
            if row == "-":
                continue
            cost += OPEN_COST if row.isupper() else 0
            own = row.lower()
            if own in grammar.terminals:
                for n in grammar.shift(stack, own):
                    offer(n, (cost, order, edits + "K", roles + own, i))
            for t in ROLES:
                if t != own:
                    for n in grammar.shift(stack, t):
                        offer(n, (cost + REROLE_COST, order, edits + "R", roles + t, i))
        kept = [x for x in new.values() if not any(
            y[0][0] + self.extra[y[1].state, x[1].state] < x[0][0] for y in new.values())]
        kept.sort(key=lambda x: x[1].state)
        least = min(found[0] for found, _ in kept)
        places = {p: n for n, p in enumerate(sorted({found[1:3] for found, _ in kept}))}
        live = tuple(Live(stack, found[0] - least, places[found[1:3]]) for found, stack in kept)
        if live not in self.number:
            self.number[live] = len(self.fronts)
            self.fronts.append(live)
        return Step(self.number[live], least, tuple((f[4], f[2], f[3]) for f, _ in kept))

    def end(self, front: int) -> tuple[int, int, str, str]:
        """(cost, live stack's index, edits, roles) that close a front."""
        if front not in self.ends:
            closed = [x for x in self._with_inserts(self.fronts[front]).values() if self.grammar.accepts(x[5])]
            cost, _, edits, roles, i, _ = min(closed, key=lambda x: x[:3])
            self.ends[front] = (cost, i, edits, roles)
        return self.ends[front]

    def begin(self) -> "Reading":
        return Reading(self)

    def _imitation_costs(self) -> dict[tuple[int, int], float]:
        """Bound on what top y pays to end with any rows as top x could.

        The least numbers that hold for every way x may go on: x ends (y
        inserts what it lacks), or x reads a letter (y inserts, then reads
        it, another one, or none).  Numbers that keep growing are no bound.
        """
        stack_of = {s.state: s for s in reversed(self.grammar.stacks())}
        never = float("inf")
        reach = {}  # y -> tops by inserts, with their cost
        for y, stack in stack_of.items():
            reach[y] = {s: c[0] for s, c in self._with_inserts((Live(stack, 0, 0),)).items()}
        close = {y: min((c for s, c in reach[y].items() if self.grammar.accepts(stack_of[s])), default=never) for y in stack_of}
        moves = {(x, t): [n.state for n in self.grammar.shift(stack, t)] for x, stack in stack_of.items()
                 for t in self.grammar.terminals}
        bound = {(y, x): 0.0 for y in stack_of for x in stack_of}
        limit = 10 * len(stack_of) * DELETE_COST
        while True:
            now = {}
            for y, x in bound:
                worst = close[y] if self.grammar.accepts(stack_of[x]) else 0.0
                for t in self.grammar.terminals:
                    for x2 in moves[x, t]:
                        answers = [c + DELETE_COST + bound[s, x2] for s, c in reach[y].items()]
                        for s, c in reach[y].items():
                            answers += [c + bound[n, x2] for n in moves[s, t]]
                            answers += [c + REROLE_COST + bound[n, x2] for r in ROLES if r != t for n in moves[s, r]]
                        worst = max(worst, min(answers))
                now[y, x] = worst if worst <= limit else never
            if now == bound:
                return bound
            bound = now


class Reading:
    """One conversation, read row by row; holds four bytes a row."""

    def __init__(self, repair: RoleRepair):
        self.repair, self.front, self.cost, self.path = repair, 0, 0, array("I")

    def row(self, letter: str) -> None:
        n = self.repair.known.get((self.front, letter))
        if n is None:
            n = self.repair.step(self.front, letter)
        step = self.repair.steps[n]
        self.path.append(n)
        self.front = step.to
        self.cost += step.cost

    def finish(self) -> tuple[int, str, str]:
        """(cost, audit, roles of the turns that the repair leaves)."""
        cost, i, edits, roles = self.repair.end(self.front)
        audit, left = [edits], [roles]
        for n in reversed(self.path):
            i, edits, roles = self.repair.steps[n].came[i]
            audit.append(edits)
            left.append(roles)
        return self.cost + cost, "".join(reversed(audit)), "".join(reversed(left))
