"""Cheapest edits that give a conversation legal roles, by the auction algorithm for shortest paths.

A conversation is a lattice of whole-number costs: a layer before, between and behind its turns, each with the
four states of ``(s?(ua)+)?`` (nothing yet, after the system turn, after a user turn, after an assistant turn).
Keep, rerole and delete lead over a turn, insert stays in its layer. Every node has a price, 0 at first, that
never exceeds its distance to the end. A path grows from the start: where an arc's cost plus the price behind it
equals the price of the path's last node, the path is extended along it; otherwise the node's price rises to the
smallest such sum and the path gives the node up. When the path reaches the end, the prices along it are
distances, the tight arcs (price = cost + price behind) hold all cheapest paths, and the one with the least
letters is traced along them. Among equal arcs the auction itself takes the least letter, so a trace along
tight arcs never meets a dead end: an arc that is tight at the end was so when the path chose.

Long conversations come as blocks of turns. ``crossing`` gives the cost from each state before a block to each
state behind it, ``moves`` the edits of a block from each state, given what the states behind it cost.
"""

from __future__ import annotations

from functools import lru_cache

USER, ASSISTANT = "user", "assistant"
START, SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # costs; CUT: a truncated turn that stays
SPOKEN = {(START, "s"): SYSTEM, (START, "u"): AFTER_USER, (SYSTEM, "u"): AFTER_USER, (AFTER_ASSISTANT, "u"): AFTER_USER, (AFTER_USER, "a"): AFTER_ASSISTANT}
MADE = {START: AFTER_USER, SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER, AFTER_USER: AFTER_ASSISTANT}  # by rerole or insert
ENDING = {START: "", SYSTEM: "II", AFTER_USER: "I", AFTER_ASSISTANT: ""}  # inserts behind the last turn
BEHIND_LAST = tuple(INSERT * len(ENDING[state]) for state in range(4))

Arcs = list[list[tuple[str, int, int]]]


def lattice(initials: str, faults: str, exits: tuple[int | None, ...]) -> Arcs:
    """Arcs (letter, cost, node behind) of each node in the order of their letters; node ``4 * layer + state``.

    The last node is the end, reached from the last layer's states at the cost of ``exits`` (None: not at all).
    Inserts stand before a turn, so that a border between two blocks has them once.
    """
    n = len(initials)
    arcs: Arcs = []
    for i, (initial, fault) in enumerate(zip(initials, faults)):
        stay = CUT if fault == "t" else 0
        for state in range(4):
            out = [("D", DELETE, 4 * i + 4 + state), ("I", INSERT, 4 * i + MADE[state])]
            if fault not in "bd":
                if (state, initial) in SPOKEN:
                    out.append(("K", KEEP + stay, 4 * i + 4 + SPOKEN[state, initial]))
                out.append(("R", REROLE + stay, 4 * i + 4 + MADE[state]))
            arcs.append(out)
    end = 4 * n + 4
    arcs += [[("", cost, end)] if cost is not None else [] for cost in exits]
    return arcs + [[]]


def without_dead_ends(arcs: Arcs) -> Arcs:
    """``arcs`` without those that lead where no way to the end begins."""
    reaches = [False] * len(arcs)
    reaches[-1] = True
    for layer in reversed(range(len(arcs) // 4)):
        nodes = range(4 * layer, 4 * layer + 4)
        for _ in range(3):  # inserts stay in the layer, at most two in a row are of use
            for node in nodes:
                reaches[node] = reaches[node] or any(reaches[behind] for _, _, behind in arcs[node])
    return [[arc for arc in out if reaches[arc[2]]] for out in arcs]


def auction(arcs: Arcs, prices: list[int], origin: int) -> bool:
    """Raise ``prices`` until a path of tight arcs leads from ``origin`` to the last node; False if there is no way.

    Prices of earlier calls on the same arcs may be handed over; they stay valid for any origin.
    """
    end, path = len(arcs) - 1, [origin]
    while path[-1] != end:
        node = path[-1]
        if not arcs[node]:
            return False
        least, behind = None, end
        for _, cost, target in arcs[node]:
            value = cost + prices[target]
            if least is None or value < least:
                least, behind = value, target
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()  # contraction
        else:
            path.append(behind)  # extension
    return True


def traced(arcs: Arcs, prices: list[int], node: int) -> tuple[str, int]:
    """Letters of the tight path with the least letters, and the last node before the end."""
    letters = []
    while True:
        letter, behind = next((letter, target) for letter, cost, target in arcs[node] if prices[node] == cost + prices[target])
        if behind == len(arcs) - 1:
            return "".join(letters), node
        letters.append(letter)
        node = behind


@lru_cache(1 << 14)
def crossing(initials: str, faults: str) -> tuple[int | None, ...]:
    """Cost from state ``i`` before a block to state ``j`` behind it at ``4 * i + j``; None where no way leads."""
    costs: list[int | None] = [None] * 16
    for j in range(4):
        arcs = without_dead_ends(lattice(initials, faults, tuple(0 if k == j else None for k in range(4))))
        prices = [0] * len(arcs)
        for i in range(4):
            if auction(arcs, prices, i):
                costs[4 * i + j] = prices[i]
    return tuple(costs)


def before(block: tuple[int | None, ...], exits: tuple[int | None, ...]) -> tuple[int | None, ...]:
    """What the states before a block cost, given its ``crossing`` and what those behind it cost."""
    sums = ([a + b for a, b in zip(block[4 * i : 4 * i + 4], exits) if a is not None and b is not None] for i in range(4))
    return tuple(min(s, default=None) for s in sums)


@lru_cache(1 << 15)
def moves(initials: str, faults: str, exits: tuple[int | None, ...], entries: tuple[int, ...] = (0, 1, 2, 3)) -> tuple[tuple[str, int] | None, ...]:
    """Edits of a block and the state behind it, for each state before it (None for those not asked or without a way).

    ``exits`` should be brought near 0 by ``levelled``, as prices climb from 0.
    """
    arcs = without_dead_ends(lattice(initials, faults, exits))
    prices, found = [0] * len(arcs), [None] * 4
    for state in entries:
        if auction(arcs, prices, state):
            letters, last = traced(arcs, prices, state)
            found[state] = letters, last % 4
    return tuple(found)


def levelled(exits: tuple[int | None, ...]) -> tuple[int | None, ...]:
    """``exits`` less the smallest of them; the cheapest edits stay the same."""
    least = min(e for e in exits if e is not None)
    return tuple(None if e is None else e - least for e in exits)


def cost_of(audit: str, faults: str) -> int:
    """Cost of edits over turns with ``faults``."""
    total, turn = 0, 0
    for letter in audit:
        total += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter]
        if letter in "KR" and faults[turn] == "t":
            total += CUT
        turn += letter != "I"
    return total


def spoken(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts that edits leave of a block's turns, from the state before it."""
    new_roles, new_texts, turn = [], [], 0
    for letter in audit:
        if letter == "D":
            turn += 1
            continue
        if letter == "K":
            role, state = roles[turn], SPOKEN[state, roles[turn][:1]]
        else:
            state = MADE[state]
            role = USER if state == AFTER_USER else ASSISTANT
        new_roles.append(role)
        new_texts.append("" if letter == "I" else texts[turn])
        turn += letter != "I"
    return new_roles, new_texts
