"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest

from recordwise.llm import auction, queries, turn_repair

WHITE = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def best(turns):
    """Least (cost, letters, lines) of all edits of ``(role, text, fault)`` turns."""

    def grown(states):
        states = dict(states)
        for _ in range(3):
            for q, (cost, letters, lines) in list(states.items()):
                to = 3 if q == 2 else 2
                new = (cost + 3, letters + "I", [*lines, "assistant:" if to == 3 else "user:"])
                if to not in states or new[:2] < states[to][:2]:
                    states[to] = new
        return states

    states = {0: (0, "", [])}
    for role, text, fault in turns:
        new = {}
        for q, (cost, letters, lines) in grown(states).items():
            found = [(q, 4, "D", [])]
            if fault not in "bd":
                stay = 3 * (fault == "t")
                to = 3 if q == 2 else 2
                found.append((to, 3 + stay, "R", [("assistant:" if to == 3 else "user:") + text]))
                if (q, role[:1]) in NEXT:
                    found.append((NEXT[q, role[:1]], stay, "K", [f"{role}:{text}"]))
            for to, more, letter, line in found:
                value = (cost + more, letters + letter, lines + line)
                if to not in new or value[:2] < new[to][:2]:
                    new[to] = value
        states = new
    return min(value for q, value in grown(states).items() if q in (0, 3))


def plain_report(conv, rows):
    """``rows``: (turn, role, text) after damage."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, turns = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
        seen.add((role, text))
        turns.append((role, text, fault))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults = [f for _, _, f in turns]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    cost, audit, lines = best(turns)
    return (conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def some_conversations(seed, lengths):
    rnd = random.Random(seed)
    rows = []
    for conv, n in enumerate(lengths):
        for turn in range(n):
            role = rnd.choices(["user", "assistant", "system", "tool", "", None], [6, 6, 1, 1, 0.3, 0.3])[0]
            text = rnd.choice([f"Text {rnd.randrange(3 * n)}.", "Same!", "cut off", " \t", "", None, "wide　\n", "done? \r\n"])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


def framed(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, n int")
    return table.repartition(4)


@pytest.mark.parametrize("block", [3, 32])
def test_reports_equal_the_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK_TURNS", block)
    rows = some_conversations(block, [0, 1, 2, 3, 5, 8, 4, 40, 7, 90, 6] * 2)
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (90, 0, "user", "again.")] + [(91, 5, "user", "many.")] * 70
    found = sorted((tuple(r) for r in turn_repair.reports(turn_repair.repair(framed(spark, rows))).collect()), key=str)
    wanted = [plain_report(conv, [r[1:] for r in rows if r[0] == conv]) for conv in {r[0] for r in rows}]
    assert found == sorted(wanted, key=str)


def test_repaired_turns_are_legal_and_blocks_hold(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK_TURNS", 4)
    rows = some_conversations(7, [30, 12, 1])
    blocks = turn_repair.repair(framed(spark, rows)).orderBy("conv_id", "block").collect()
    for conv in {b.conv_id for b in blocks}:
        roles = [r for b in blocks if b.conv_id == conv for r in b.roles]
        roles = roles[1:] if roles and roles[0][:1] == "s" else roles
        assert [r[:1] for r in roles] == ["u", "a"] * (len(roles) // 2)
        assert sum(letter != "I" for b in blocks if b.conv_id == conv for letter in b.audit) == sum(r[0] == conv for r in rows)
    assert max(sum(letter != "I" for letter in b.audit) for b in blocks) <= 4


def test_conversations_without_turns_and_empty_tables(spark):
    table = framed(spark, [(1, 0, "user", "a."), (2, 0, "user", "b.")]).selectExpr("*", "conv_id = 2 as there")
    found = {r.conv_id: r for r in turn_repair.reports(turn_repair.repair(table, present="there")).collect()}
    assert tuple(found[1]) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[2].audit == "KI"
    assert turn_repair.reports(turn_repair.repair(framed(spark, []))).count() == 0


def test_long_texts_stay_whole(spark):
    text = "long " * 600_000 + "."
    found = turn_repair.repair(framed(spark, [(1, 0, "user", text), (1, 1, "assistant", text + "!")])).collect()
    assert [t for b in found for t in b.texts] == [text, text + "!"]


def test_prices_are_distances_along_the_path_and_never_above():
    rnd = random.Random(11)
    for _ in range(200):
        n = rnd.randrange(9)
        initials, faults = "".join(rnd.choices("suat", k=n)), "".join(rnd.choices("-bdt", k=n))
        arcs = auction.without_dead_ends(auction.lattice(initials, faults, auction.BEHIND_LAST))
        prices = [0] * len(arcs)
        assert auction.auction(arcs, prices, 0)
        far = [0 if i == len(arcs) - 1 else 10**6 for i in range(len(arcs))]
        for _ in range(len(arcs)):
            for node, out in enumerate(arcs):
                far[node] = min([far[node], *(cost + far[to] for _, cost, to in out)])
        assert all(p <= f for p, f in zip(prices, far)) and prices[0] == far[0]
        assert all(prices[node] <= cost + prices[to] for node, out in enumerate(arcs) for _, cost, to in out)


@pytest.mark.tables
def test_query_equals_the_plain_search(spark, folder):
    original = queries.table(spark, folder, "conversations").collect()
    turns = {r.conv_id: [] for r in original}
    for conv, turn, role, text in original:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        turns[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {tuple(r) for r in queries.QUERIES["op11_turn_repair"](spark, folder).collect()}
    assert found == {plain_report(conv, rows) for conv, rows in turns.items()}
