"""LR tables of a role grammar and the cheapest repair of a row sequence by a weighted, generalised LR parse.

The terminals are role initials.  A stack is a chain of LR states; stacks share what lies below them, so all stacks of
a parse form one graph, whose cells are interned.  A row forks every top: it may be kept (its initial is shifted), get
another role (that role's initial is shifted) or be deleted (the top stays), and terminals may be inserted before it.
Tops that are equal after a row are merged: the least (cost, audit) stays, where the audit is the string of edit
initials so far.  A role grammar is regular, so there are few different tops, and a row costs a constant number of steps.

Audits are not copied from row to row.  They are linked from row to row and compared by rank: after a row every audit
has the same number of keeps, reroles and deletes and ends in one of these, so none is a proper prefix of another one,
and two audits compare as their ranks before the row do, or, for equal ranks, as the edits of this row do.  An
insertion never stands before a deletion: behind it, it costs the same and the audit is less.
"""

from __future__ import annotations

#: ``(head, body)``; the first head is the start.  Roles: an optional system row, then pairs of user and assistant.
ROLE_GRAMMAR = (("C", ""), ("C", "B"), ("C", "sB"), ("B", "P"), ("B", "BP"), ("P", "ua"))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3


class Tables:
    """SLR tables: ``shift[state][symbol]`` and the productions to reduce by, for each state and next terminal."""

    def __init__(self, grammar: tuple[tuple[str, str], ...]) -> None:
        self.grammar = grammar
        self.heads = {head for head, _ in grammar}
        self.start = grammar[0][0]
        self._firsts()
        self.items: list[frozenset] = []
        self.shift: list[dict[str, int]] = []
        self._state(self._closed({(i, 0) for i, (head, _) in enumerate(grammar) if head == self.start}))

    def _firsts(self) -> None:
        self.empty, first = set(), {h: set() for h in self.heads}
        self.follow = {h: set() for h in self.heads}
        self.follow[self.start].add("$")
        changed = True
        while changed:
            before = (len(self.empty), [len(first[h]) for h in sorted(self.heads)], [len(self.follow[h]) for h in sorted(self.heads)])
            for head, body in self.grammar:
                if all(x in self.empty for x in body):
                    self.empty.add(head)
                for x in body:
                    first[head] |= first.get(x, {x})
                    if x not in self.empty:
                        break
                after = set(self.follow[head])
                for x in reversed(body):
                    if x in self.heads:
                        self.follow[x] |= after
                        after = after | first[x] if x in self.empty else set(first[x])
                    else:
                        after = {x}
            changed = before != (len(self.empty), [len(first[h]) for h in sorted(self.heads)],
                                 [len(self.follow[h]) for h in sorted(self.heads)])

    def _closed(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            i, dot = todo.pop()
            for j, (head, _) in enumerate(self.grammar):
                if self.grammar[i][1][dot:dot + 1] == head and (j, 0) not in items:
                    items.add((j, 0))
                    todo.append((j, 0))
        return frozenset(items)

    def _state(self, items: frozenset) -> int:
        if items in self.items:
            return self.items.index(items)
        state = len(self.items)
        self.items.append(items)
        self.shift.append({})
        for symbol in sorted({self.grammar[i][1][dot] for i, dot in items if dot < len(self.grammar[i][1])}):
            self.shift[state][symbol] = self._state(self._closed(
                {(i, dot + 1) for i, dot in items if self.grammar[i][1][dot:dot + 1] == symbol}))
        return state

    def reductions(self, state: int, terminal: str) -> list[tuple[str, str]]:
        done = [self.grammar[i] for i, dot in sorted(self.items[state]) if dot == len(self.grammar[i][1])]
        return [(head, body) for head, body in done if terminal in self.follow[head]]

    def sole(self, state: int) -> tuple[str, str] | None:
        """The production of a state that can do nothing but reduce by it."""
        if len(self.items[state]) == 1 and not self.shift[state]:
            (i, _), = self.items[state]
            return self.grammar[i]
        return None


class Repairer:
    """Cheapest repairs under a grammar; ``roles`` are the initials that a row may be given or that may be inserted."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = ROLE_GRAMMAR, roles: str = "ua") -> None:
        self.tables, self.roles = Tables(grammar), sorted(roles)
        self.terminals = sorted({x for _, body in grammar for x in body} - self.tables.heads)
        self.cells: list[tuple[int, int]] = []      # state, cell below
        self._known: dict[tuple[int, int], int] = {}
        self._shifted: dict[tuple[int, str], tuple[int, ...]] = {}
        self._moves: dict[tuple[int, str, bool, bool], list] = {}
        self.tops = [self._cell(0, -1)]             # all tops between rows, numbered alike in every process
        for top in self.tops:
            for t in self.terminals:
                self.tops += [to for to in self.after(top, t) if to not in self.tops]

    def _cell(self, state: int, below: int) -> int:
        if (state, below) not in self._known:
            self._known[state, below] = len(self.cells)
            self.cells.append((state, below))
        return self._known[state, below]

    def _reduced(self, cell: int, head: str, body: str) -> int | None:
        for _ in body:
            cell = self.cells[cell][1]
        to = self.tables.shift[self.cells[cell][0]].get(head)
        return None if to is None else self._cell(to, cell)

    def _forks(self, cell: int, terminal: str) -> set[int]:
        """The cell and all that reductions before ``terminal`` make of it."""
        seen, todo = {cell}, [cell]
        while todo:
            at = todo.pop()
            for head, body in self.tables.reductions(self.cells[at][0], terminal):
                new = self._reduced(at, head, body)
                if new is not None and new not in seen:
                    seen.add(new)
                    todo.append(new)
        return seen

    def after(self, cell: int, terminal: str) -> tuple[int, ...]:
        """The tops after ``terminal``."""
        if (cell, terminal) not in self._shifted:
            tops = set()
            for at in self._forks(cell, terminal):
                to = self.tables.shift[self.cells[at][0]].get(terminal)
                if to is None:
                    continue
                top = self._cell(to, at)
                while (one := self.tables.sole(self.cells[top][0])) and (new := self._reduced(top, *one)) is not None:
                    top = new
                tops.add(top)
            self._shifted[cell, terminal] = tuple(sorted(tops))
        return self._shifted[cell, terminal]

    def accepts(self, cell: int) -> bool:
        """Whether the rows so far are a sentence: a reduction to the start leaves nothing but the bottom."""
        for at in self._forks(cell, "$"):
            for head, body in self.tables.reductions(self.cells[at][0], "$"):
                below = at
                for _ in body:
                    below = self.cells[below][1]
                if head == self.tables.start and below == 0:
                    return True
        return False

    def inserted(self, cell: int) -> dict[int, str]:
        """Every top that insertions alone can reach, with the fewest terminals inserted (the least of as many)."""
        found, layer = {cell: ""}, {cell: ""}
        while layer:
            new: dict[int, str] = {}
            for at, made in layer.items():
                for t in self.roles:
                    for to in self.after(at, t):
                        if to not in found:
                            new[to] = min(new.get(to, made + t), made + t)
            found |= new
            layer = new
        return found

    def moves(self, cell: int, initial: str, doomed: bool, truncated: bool) -> list[tuple[int, int, str, str]]:
        """``top, cost, edits, initials made`` of one row, the cheapest for each top."""
        key = cell, initial, doomed, truncated
        if key not in self._moves:
            best = {cell: (DELETE, "D", "")}
            if not doomed:
                more = TRUNCATED if truncated else 0
                for at, made in self.inserted(cell).items():
                    cost, edits = more + INSERT * len(made), "I" * len(made)
                    for t, price, edit in [(initial, KEEP, "K"), *((r, REROLE, "R") for r in self.roles)]:
                        for to in self.after(at, t) if t in self.terminals else ():
                            new = cost + price, edits + edit, made + t
                            best[to] = min(best.get(to, new), new)
            self._moves[key] = [(to, *b) for to, b in sorted(best.items())]
        return self._moves[key]


class Run:
    """A parse of consecutive rows from one top: ``tops`` maps each top to ``(cost, rank of its audit, link)``."""

    def __init__(self, repairer: Repairer, start: int) -> None:
        self.repairer = repairer
        self.tops: dict[int, tuple[int, int, tuple | None]] = {start: (0, 0, None)}

    def row(self, initial: str, doomed: bool, truncated: bool, copies: int = 1) -> None:
        """One row and ``copies - 1`` repetitions of it, which must go."""
        best: dict[int, tuple] = {}
        for top, (cost, rank, link) in self.tops.items():
            for to, price, edits, made in self.repairer.moves(top, initial, doomed, truncated):
                new = cost + price, rank, edits, made, link
                if to not in best or new[:4] < best[to][:4]:
                    best[to] = new
        again, price = "D" * (copies - 1), DELETE * (copies - 1)
        ranks = {key: i for i, key in enumerate(sorted({b[1:3] for b in best.values()}))}
        self.tops = {to: (cost + price, ranks[rank, edits], (link, edits + again, made))
                     for to, (cost, rank, edits, made, link) in best.items()}

    def ends(self) -> list[tuple[int, int, str, str]]:
        """``top, cost, audit, initials made`` for each top."""
        return [(top, cost, *unlinked(link)) for top, (cost, _, link) in sorted(self.tops.items())]


def unlinked(link: tuple | None) -> tuple[str, str]:
    edits, made = [], []
    while link is not None:
        link, e, m = link
        edits.append(e)
        made.append(m)
    return "".join(reversed(edits)), "".join(reversed(made))


def joined(repairer: Repairer, runs: list[list[tuple[int, int, int, str, str]]]) -> tuple[int, list[tuple[str, str]]]:
    """The cheapest way through consecutive runs, each given as its ``(start, top, cost, audit, made)``.

    Returns the cost and, for each run, its audit and initials made; insertions at the end belong to the last run.
    """
    tops: dict[int, tuple] = {0: (0, 0, None)}
    for run in runs:
        best: dict[int, tuple] = {}
        for start, top, price, edits, made in run:
            if start in tops:
                cost, rank, link = tops[start]
                new = cost + price, rank, edits, made, link
                if top not in best or new[:4] < best[top][:4]:
                    best[top] = new
        ranks = {key: i for i, key in enumerate(sorted({b[1:3] for b in best.values()}))}
        tops = {top: (cost, ranks[rank, edits], (link, edits, made)) for top, (cost, rank, edits, made, link) in best.items()}
    ends = [(cost + INSERT * len(made), rank, "I" * len(made), made, link) for top, (cost, rank, link) in tops.items()
            for at, made in repairer.inserted(top).items() if repairer.accepts(at)]
    cost, _, last, made, link = min(ends, key=lambda e: e[:4])
    parts = []
    while link is not None:
        link, e, m = link
        parts.append((e, m))
    parts.reverse()
    if parts:
        parts[-1] = parts[-1][0] + last, parts[-1][1] + made
    return cost, parts
