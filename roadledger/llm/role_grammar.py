"""Generalised LR repair of a sequence of role initials: a graph-structured stack with weighted edits.

The grammar of a whole conversation is ``(s?(ua)+)?``; ``PRODUCTIONS`` writes it with left recursion, so stacks stay
short. An automaton of LR(0) items gives the moves. A stack is a node (state, node below); nodes are shared by all
stacks that grew from them. Before every row, and at the end, assistants and users may be inserted; then every stack
keeps, reroles or deletes the row. Where two stacks end in the same top, the one of least (cost, audit) stays. That
loses nothing here: the tops tell what may follow, and an audit that has consumed the same rows at the same cost is
never the beginning of another, so what is appended later cannot turn their order round.

Stacks carry no audits: a frontier knows the order of its stacks' audits only, and stacks too dear to win leave it.
So it is one of a few hundred configurations, and the moves of each are worked out once and remembered.
"""

from __future__ import annotations

from functools import lru_cache

START = "C"
PRODUCTIONS = [("C", ()), ("C", ("T",)), ("C", ("s", "T")), ("T", ("u", "a")), ("T", ("T", "u", "a"))]
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: What an undeleted truncated row costs besides.
TRUNCATED_COST = 1
#: Whatever follows one stack can follow any other for at most two inserts and one deletion more (they end the pair that
#: is open, and do without an opening system turn), so a stack further than this above the cheapest never wins.
SLACK = 2 * COSTS[INSERT] + COSTS[DELETE]


def _closure(items: frozenset) -> frozenset:
    found, left = set(items), list(items)
    while left:
        number, dot = left.pop()
        ahead = PRODUCTIONS[number][1][dot:dot + 1]
        for k, (head, _) in enumerate(PRODUCTIONS):
            if ahead == (head,) and (k, 0) not in found:
                found.add((k, 0))
                left.append((k, 0))
    return frozenset(found)


def _automaton() -> tuple[list[frozenset], dict[tuple[int, str], int]]:
    """Item sets and the moves between them; set 0 is the start."""
    sets = [_closure(frozenset((k, 0) for k, (head, _) in enumerate(PRODUCTIONS) if head == START))]
    moves: dict[tuple[int, str], int] = {}
    for number, items in enumerate(sets):  # grows while it is read
        for symbol in sorted({PRODUCTIONS[k][1][dot] for k, dot in items if dot < len(PRODUCTIONS[k][1])}):
            onward = _closure(frozenset((k, dot + 1) for k, dot in items if PRODUCTIONS[k][1][dot:dot + 1] == (symbol,)))
            if onward not in sets:
                sets.append(onward)
            moves[number, symbol] = sets.index(onward)
    return sets, moves


SETS, MOVES = _automaton()
EMPTY = (0, None)


def _reduced(stack: tuple, whole: bool) -> list[tuple]:
    """``stack`` and what reductions make of it; those to the start symbol happen at the end of the input only."""
    out, left = [], [stack]
    while left:
        node = left.pop()
        done = [PRODUCTIONS[k] for k, dot in SETS[node[0]] if dot == len(PRODUCTIONS[k][1])]
        if len(done) < len(SETS[node[0]]) or not done:
            out.append(node)
        for head, body in done:
            below = node
            for _ in body:
                below = below[1]
            if head != START:
                left.append((MOVES[below[0], head], below))
            elif whole:
                out.append((START, below))
    return out


def pushed(stack: tuple, symbol: str) -> list[tuple]:
    onward = MOVES.get((stack[0], symbol))
    return [] if onward is None else _reduced((onward, stack), False)


def _offer(table: dict, stack: tuple, rank: tuple) -> bool:
    """Puts a stack in, if none with its top has a lower (cost, audit)."""
    if stack[0] in table and table[stack[0]][1] <= rank:
        return False
    table[stack[0]] = (stack, rank)
    return True


def _with_inserts(frontier: tuple) -> dict:
    """top: (stack, (cost, place of the audit so far in the frontier, what follows it))."""
    table = {stack[0]: (stack, (cost, place, "")) for place, (stack, cost) in enumerate(frontier)}
    left = list(table)
    while left:
        stack, (cost, place, more) = table[left.pop()]
        for symbol in NAMES:
            for onward in pushed(stack, symbol):
                if _offer(table, onward, (cost + COSTS[INSERT], place, more + INSERT)):
                    left.append(onward[0])
    return table


@lru_cache(maxsize=1 << 16)
def advance(frontier: tuple, initial: str, must_delete: bool, truncated: bool) -> tuple[tuple, tuple, int]:
    """The frontier behind one row, where each of its audits comes from, and the cost all of them share.

    A frontier is ((stack, cost above the least), ...) in the order of the audits. The second part has for each new
    audit the place of the one it continues and what it adds.
    """
    table: dict = {}
    extra = COSTS[KEEP] + (TRUNCATED_COST if truncated else 0)
    for stack, (cost, place, more) in _with_inserts(frontier).values():
        _offer(table, stack, (cost + COSTS[DELETE], place, more + DELETE))
        if must_delete:
            continue
        for onward in pushed(stack, initial):
            _offer(table, onward, (cost + extra, place, more + KEEP))
        for symbol in NAMES:
            for onward in pushed(stack, symbol) if symbol != initial else []:
                _offer(table, onward, (cost + COSTS[REROLE] + extra, place, more + REROLE))
    ordered = sorted(table.values(), key=lambda entry: entry[1][1:])
    least = min(rank[0] for _, rank in ordered)
    ordered = [(stack, rank) for stack, rank in ordered if rank[0] - least <= SLACK]
    return (tuple((stack, rank[0] - least) for stack, rank in ordered), tuple(rank[1:] for _, rank in ordered), least)


def finished(frontier: tuple) -> tuple[int, int, str]:
    """(cost above the shared one, place of the audit, what is added to it) of the best whole conversation."""
    return min(rank for stack, rank in _with_inserts(frontier).values()
               if any(node[0] == START and node[1] == EMPTY for node in _reduced(stack, True)))


class Repair:
    """The repair of one sequence, row by row. Audits are chains of pieces of text which stacks share."""

    PIECE = 512

    def __init__(self) -> None:
        self.frontier, self.cost, self.audits = ((EMPTY, 0),), 0, ((None, ""),)

    def row(self, initial: str, must_delete: bool, truncated: bool) -> None:
        self.frontier, origins, least = advance(self.frontier, initial, must_delete, truncated)
        self.cost += least
        full: dict[int, tuple] = {}
        audits = []
        for place, more in origins:
            before, text = self.audits[place]
            if len(text) >= self.PIECE:
                before, text = full.setdefault(place, (before, text)), ""
            audits.append((before, text + more))
        self.audits = tuple(audits)

    def result(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest repair."""
        cost, place, more = finished(self.frontier)
        pieces, chain = [more], self.audits[place]
        while chain:
            pieces.append(chain[1])
            chain = chain[0]
        return self.cost + cost, "".join(reversed(pieces))


def repaired_roles(audit: str, roles) -> list[tuple[str, str, int | None]]:
    """(edit, role, place of the row or None) of every row of the repaired sequence; ``roles`` are those of all rows."""
    out, place, before = [], 0, ""
    for edit in audit:
        if edit != DELETE:
            role = roles[place] if edit == KEEP else following(before)
            out.append((edit, role, None if edit == INSERT else place))
            before = role[:1]
        place += edit != INSERT
    return out


def following(initial: str) -> str:
    """The role that a rerole or insert writes behind a row."""
    return NAMES["a"] if initial == "u" else NAMES["u"]
