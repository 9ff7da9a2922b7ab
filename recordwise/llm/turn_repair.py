"""Repair of conversations: faults of their turns, and the cheapest edits that give legal roles (``auction``).

Rows of ``conv_id, turn, role, text`` are a conversation's turns in the order of turn (NULL first), role, text.
NULL roles and texts are read as one space. A turn is blank (nothing but white space), else a duplicate (role
and text stood earlier in the conversation), else truncated (its last visible character is none of ``.!?``),
else sound. Blank and duplicate turns must go.

* Equal rows are counted before they move, so a turn that repeats a billion times is one row. What stood
  earlier comes from a grouped minimum that is joined back, never from a conversation held in one place.
* Rows are dealt by ranges of (conversation, turn, role, text). A long conversation spans several tasks and
  comes as blocks of at most ``BLOCK_TURNS`` turns and about ``BLOCK_BYTES`` of text.
* A conversation that is one block is repaired where it lies. Of the others each block is crossed in a task of
  its own choice; only the sixteen costs per block are chained backwards per conversation, the edits of a block
  from each of the four states are found in parallel again, and a last pass in order takes the right ones.

``repair`` returns one row per block, each conversation within one partition and in order: ``conv_id``,
``block``, counts of faults and of illegal pairs, ``cost``, ``audit`` (the letters of the edits), the repaired
``roles`` and ``texts``, ``first_turn``, ``last_turn`` and ``n_turns`` (distinct known turns not counted in an earlier
block). ``reports`` folds these into one row per conversation without holding its texts.

A NULL ``conv_id`` is a conversation of its own. Rows whose ``present`` column is false only name their
conversation, so that one without turns is reported too. Empty tables give none; extra columns are not read;
texts of any length stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwise.llm import auction
from recordwise.llm.files import partition_number, stored
from recordwise.operators.sizing import broadcast_if_small

BLOCK_TURNS = 32
BLOCK_BYTES = 1 << 20
OUT_ROWS = 2048

BLOCK = "conv_id long, block long, whole boolean, initials string, faults string, roles array<string>, texts array<string>, first_turn long, last_turn long, n_turns long"
REPAIRED = (
    "conv_id long, block long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles array<string>, texts array<string>, "
    "first_turn long, last_turn long, n_turns long"
)
LEGAL = {"su", "ua", "au"}


def arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in schema.split(", "))])


def batched(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded count and size."""
    shape, held, size = arrow(schema), [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), shape)], schema=shape)

    for row in rows:
        held.append(row)
        size += sum(len(t or "") for value in row if isinstance(value, list) for t in value if not isinstance(t, int))
        if len(held) >= OUT_ROWS or size > 8 * BLOCK_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def unbatched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns))


def in_order(rows: DataFrame) -> DataFrame:
    """Blocks by conversation and place, each conversation in one partition."""
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "block")


def faulty(turns: DataFrame, present: str | None = None) -> DataFrame:
    """Distinct turns with their count ``n`` and ``fault`` of the first of them; the others are duplicates."""
    there = F.coalesce(F.col(present).cast("boolean"), F.lit(True)) if present else F.lit(True)
    words = [F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *words, there.alias("there"))
    rows = rows.groupBy("conv_id", "turn", "role", "text", "there").agg(F.count("*").alias("n"))
    # a text is named by its SHA-256, so texts themselves move only to be counted and to be put in order
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    again = rows.where("there").groupBy("conv_id", "role", "digest").agg(F.min(order).alias("first"), F.count("*").alias("times")).where("times > 1")
    again = broadcast_if_small(again.select(F.col("conv_id").alias("a_conv"), F.col("role").alias("a_role"), F.col("digest").alias("a_digest"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("role") == F.col("a_role")) & (F.col("digest") == F.col("a_digest"))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "b")
        .when(F.col("first").isNotNull() & (order != F.col("first")), "d")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t")
        .otherwise("-")
    )
    gone = F.col("fault").isin("b", "d")
    return (
        rows.join(again, same, "left")
        .withColumn("fault", fault)
        .select("conv_id", "turn", "role", "text", "there", "n", "fault")
        .withColumn("text", F.when(~gone & F.col("there"), F.col("text")))
    )


def blocks(turns: DataFrame) -> DataFrame:
    """Blocks of turns in order; ``whole`` says that a block is all of its conversation."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        base, number = partition_number() << 40, 0
        held: list[tuple] = []  # (role, text, fault) of the open block
        size, known, opened, owner, before = 0, [None, None, 0], False, None, None

        def block(whole: bool) -> tuple:
            roles = [h[0] for h in held]
            return (owner, base + number, whole, "".join((r[:1] or " ") for r in roles), "".join(h[2] for h in held), roles, [h[1] for h in held], *known)

        first, parts = True, 0
        for conv, turn, role, text, there, n, fault in unbatched(batches):
            if opened and conv != owner:
                yield block(parts == 0 and not first)
                number, first, parts, held, size, known, before = number + 1, False, 0, [], 0, [None, None, 0], None
            owner, opened = conv, True
            if not there:
                continue
            for copy in range(n):
                if len(held) >= BLOCK_TURNS or size > BLOCK_BYTES:
                    yield block(False)
                    number, parts, held, size, known, before = number + 1, parts + 1, [], 0, [None, None, 0], None
                if turn is not None:
                    known = [turn if known[0] is None else known[0], turn, known[2] + (turn != before)]
                    before = turn
                held.append((role, text if copy == 0 else None, fault if copy == 0 or fault == "b" else "d"))
                size += len(text or "") if copy == 0 else 0
        if opened:
            yield block(False)  # the next partition may go on with it

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.col("text").asc_nulls_first(), "there"]
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lambda b: batched(gather(b), BLOCK), BLOCK)


def exits(parts: DataFrame) -> DataFrame:
    """What the states behind each block cost: the blocks' crossings, chained from the last to the first."""
    sides = "conv_id long, block long, costs array<long>"

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, number, initials, faults in unbatched(batches):
            yield conv, number, list(auction.crossing(initials, faults))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        owner, behind = (), auction.BEHIND_LAST
        for conv, number, costs in unbatched(batches):
            if (conv,) != owner:
                owner, behind = (conv,), auction.BEHIND_LAST
            yield number, list(behind)
            behind = auction.levelled(auction.before(tuple(costs), behind))

    crossed = parts.select("conv_id", "block", "initials", "faults").mapInArrow(lambda b: batched(cross(b), sides), sides)
    backwards = crossed.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("block").desc())
    return backwards.mapInArrow(lambda b: batched(chain(b), "block long, exits array<long>"), "block long, exits array<long>")


def repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Blocks in order, with ``edits`` from each state (NULL: find them here), to repaired blocks."""
    owner, state, spoke, turned, held = (), auction.START, "", None, None

    def done(row: list, last: bool) -> tuple:
        if last:
            ending = auction.ENDING[state]
            roles, texts = auction.spoken(ending, state, [], [])
            row[6] += auction.cost_of(ending, "")
            row[7:10] = row[7] + ending, row[8] + roles, row[9] + texts
        return tuple(row)

    for conv, number, whole, initials, faults, roles, texts, first, last, n, edits in rows:
        if held is not None:
            yield done(held, (conv,) != owner)
        if (conv,) != owner:
            owner, state, spoke, turned = (conv,), auction.START, "", None
        if edits is None:
            audit, behind = auction.moves(initials, faults, auction.BEHIND_LAST, (auction.START,))[auction.START]
        else:
            audit, behind = edits[state][:-1], int(edits[state][-1])
        said = spoke + initials
        illegal = sum(said[i : i + 2] not in LEGAL for i in range(len(said) - 1))
        new_roles, new_texts = auction.spoken(audit, state, roles, texts)
        if first is not None:
            n -= first == turned
            turned = last
        counts = [faults.count(kind) for kind in "bdt"]
        held = [conv, number, *counts, illegal, auction.cost_of(audit, faults), audit, new_roles, new_texts, first, last, n]
        state, spoke = behind, initials[-1:] or spoke
    if held is not None:
        yield done(held, True)


def repair(turns: DataFrame, present: str | None = None) -> DataFrame:
    """Repaired blocks of every conversation; see above."""
    table = stored(blocks(faulty(turns, present)), "turns")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for *row, behind in unbatched(batches):
            found = auction.moves(row[3], row[4], auction.levelled(tuple(behind)))
            yield *row, [None if f is None else f"{f[0]}{f[1]}" for f in found]

    edited = f"{BLOCK}, edits array<string>"
    alone = table.where("whole").withColumn("edits", F.lit(None).cast("array<string>"))
    spread = table.where("not whole")
    spread = spread.join(exits(spread), "block").select(*table.columns, "exits").mapInArrow(lambda b: batched(edit(b), edited), edited)
    return alone.unionByName(in_order(spread)).mapInArrow(lambda b: batched(repaired(unbatched(b)), REPAIRED), REPAIRED)


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def reports(repaired_blocks: DataFrame) -> DataFrame:
    """One row per conversation from ``repair``'s rows in their order; texts are hashed as they pass."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        owner, counts, audit, digest, lines, first, last, turns = (), [], [], None, 0, None, None, 0

        def report() -> tuple:
            gaps = last - first + 1 - turns if turns else 0
            return *owner, gaps, *counts, "".join(audit), digest.hexdigest()

        for conv, _, *numbers, letters, roles, texts, begin, end, n in unbatched(batches):
            if (conv,) != owner:
                if owner:
                    yield report()
                owner, counts, audit, digest, lines, first, last, turns = (conv,), [0] * 5, [], hashlib.sha256(), 0, None, None, 0
            counts = [a + b for a, b in zip(counts, numbers)]
            audit.append(letters)
            for role, text in zip(roles, texts):
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
            if begin is not None:
                first, last = begin if first is None else first, end
            turns += n
        if owner:
            yield report()

    return repaired_blocks.mapInArrow(lambda b: batched(fold(b), REPORT), REPORT)


def damaged(conversations: DataFrame) -> DataFrame:
    """The faults that the query plants, by a checksum of id and turn; ``present`` is false for rows that are gone."""
    key = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, auction.USER).otherwise(role)
    again = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"), again.alias("again")).drop("again")


def later(state: str, cost: str, letters: str, lines: str) -> str:
    """SQL of a partial result (cost, audit, text) after further edits."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}', 'o': {state}.o || {lines}}}"


def sql() -> str:
    """The query in SQL: a fold over the turns of a conversation that keeps the least (cost, audit) per state."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    insert = auction.INSERT
    closed = (
        f"[p[1], p[2], list_min([p[3], {later('p[1]', insert, 'I', user)}, {later('p[2]', insert, 'I', user)}, {later('p[4]', insert, 'I', user)}]), "
        f"list_min([p[4], {later('p[3]', insert, 'I', assistant)}, {later('p[1]', 2 * insert, 'II', f'{user} || {assistant}')}, "
        f"{later('p[2]', 2 * insert, 'II', f'{user} || {assistant}')}])]"
    )
    stay = "case when fault in ('b', 'd') then 1000000000 when fault = 't' then 3 else 0 end"

    def keep(state: int, initial: str) -> str:
        return later(f"p[{state}]", f"{stay} + case when role[1] = '{initial}' then 0 else 1000000000 end", "K", "chr(10) || role || ':' || text")

    def rerole(state: int, role: str) -> str:
        return later(f"p[{state}]", f"{stay} + {auction.REROLE}", "R", f"chr(10) || '{role}:' || text")

    def delete(state: int) -> str:
        return later(f"p[{state}]", str(auction.DELETE), "D", "''")

    spoke = ", ".join(
        [
            delete(1),
            f"list_min([{delete(2)}, {keep(1, 's')}])",
            f"list_min([{', '.join([delete(3), *(keep(k, 'u') for k in (1, 2, 4)), *(rerole(k, 'user') for k in (1, 2, 4))])}])",
            f"list_min([{delete(4)}, {keep(3, 'a')}, {rerole(3, 'assistant')}])",
        ]
    )
    far = "{'c': 1000000000000, 'a': '', 'o': ''}"
    return rf"""
with recursive crc as (select list_transform(range(256), lambda b: list_reduce(range(8)::ubigint[], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b::ubigint)) as crc),
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
kinds as (
  select key, xor(4294967295, list_reduce(
    list_transform(range(length(key)), lambda i: ascii(key[i + 1])::ubigint),
    lambda c, b: xor(c >> 8, list_extract(crc, (xor(c, b) & 255)::bigint + 1)), 4294967295::ubigint)) % 20 as kind
  from (select distinct key from keyed), crc
),
turns as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as again
  from keyed join kinds using (key) where kind <> 0
),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, again) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, again) as seen
  from turns
),
marked as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'b' when seen > 1 then 'd' when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 't' else '-' end as fault,
    lag(role[1]) over (partition by conv_id order by i) || role[1] as pair
  from placed
),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'b') as blank,
    count(*) filter (where fault = 'd') as duplicate, count(*) filter (where fault = 't') as truncated, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id
),
walk as (
  select conv_id, 0::bigint as i, [{{'c': 0::bigint, 'a': '', 'o': ''}}, {far}, {far}, {far}] as p from (select distinct conv_id from conversations)
  union all
  select conv_id, i, [{spoke}] as p
  from (select m.*, {closed.replace("p[", "w.p[")} as p from walk w join marked m on m.conv_id is not distinct from w.conv_id and m.i = w.i + 1)
),
ends as (
  select conv_id, list_min([p[1], p[4]]) as best
  from (select conv_id, {closed} as p from walk qualify row_number() over (partition by conv_id order by i desc) = 1)
)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, best.c as cost, best.a as audit, sha256(substr(best.o, 2)) as repaired_sha256
from ends e left join counts c on c.conv_id is not distinct from e.conv_id
"""


SQL = sql()
