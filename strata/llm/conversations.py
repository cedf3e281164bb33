"""Repair of conversation structure by Wagner-Fischer alignment to the alternating grammar.

A conversation should read (s?(ua)+)? in role initials. Its turns are aligned to every
feasible length of that pattern; the band of a table (Ukkonen) and the lengths tried follow
from the cheapest cost found so far, and equally cheap tables compare their backtraced
audits.

A conversation may hold any share of all turns. Turns are dealt out by a range sort of
(conversation, turn), so a long conversation spreads over tasks; within a piece, runs of
``BLOCK`` turns are aligned for every pair of states (nothing said yet, after s, u, a) in
which the pattern can enter and leave them, and the cheapest ways are put together. That
is exact, ties included: two audits of the same turns with the same cost and states never
start one another. Only the text of a repaired conversation, whose digest is sequential,
is read by one task in order, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import small_batches, stored

#: Turns aligned in one table.
BLOCK = 32
#: Tables kept by a task.
TABLES = 1 << 14
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 1 << 60

# A turn as one letter: its role's initial (u, a, s, other); upper case if truncated; the
# letters of the last row if it must go. A further copy of the same row is an x.
INITIALS = "uaso"
GOES = dict(zip("vbtp", INITIALS, strict=True))
COPY = "x"
#: States: nothing said yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
LEGAL = ("su", "ua", "au")


def _cost(letter: str, wanted: str) -> int:
    """Cost of a turn that stands for the wanted initial."""
    if letter == COPY or letter in GOES:
        return FAR
    more = TRUNCATED if letter.isupper() else 0
    if letter.lower() == wanted:
        return KEEP + more
    return REROLE + more if wanted != "s" else FAR


def table_of(turns: str, target: str, limit: int) -> list[list[int]]:
    """Costs of aligning turns[i:] to target[j:], inside the band that a cost up to ``limit`` can reach."""
    n, m = len(turns), len(target)
    down, right = limit // DELETE, limit // INSERT
    rows = [[FAR] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        here, below = rows[i], rows[i + 1]
        for j in range(min(m, i + right, m - n + i + down), max(0, i - down, m - n + i - right) - 1, -1):
            if i == n and j == m:
                here[j] = 0
                continue
            best = below[j] + DELETE if i < n else FAR
            if j < m:
                if target[j] != "s":
                    best = min(best, here[j + 1] + INSERT)
                if i < n:
                    best = min(best, below[j + 1] + _cost(turns[i], target[j]))
            here[j] = best
    return rows


def backtrace(turns: str, target: str, rows: list[list[int]]) -> str:
    """The ASCII-least audit of a table: D, I, K, R in that order where costs agree."""
    i, j, out = 0, 0, []
    while i < len(turns) or j < len(target):
        left = rows[i][j]
        if i < len(turns) and rows[i + 1][j] + DELETE == left:
            out.append("D")
            i += 1
        elif j < len(target) and target[j] != "s" and rows[i][j + 1] + INSERT == left:
            out.append("I")
            j += 1
        else:
            out.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return "".join(out)


def _targets(entry: int, leave: int, turns: str) -> list[tuple[str, str, int]]:
    """(lead, first letter, parity) of the patterns between two states; their lengths without the lead have the parity."""
    first = "a" if entry == AFTER_U else "u"
    if leave == START:
        return [("", first, -1)] if entry == START else []
    if leave == AFTER_S:
        return [("", first, -1)] if entry == AFTER_S else [("s", first, -1)] if entry == START else []
    parity = int((leave == AFTER_U) != (entry == AFTER_U))
    leads = [""] + (["s"] if entry == START and ("s" in turns or "S" in turns) else [])
    return [(lead, first, parity) for lead in leads]


def aligned(turns: str, entry: int, leave: int, limit: int = FAR) -> tuple[int, str] | None:
    """The cheapest cost up to ``limit`` and its least audit over all feasible lengths; None if there is none."""
    n, live = len(turns), sum(c != COPY and c not in GOES for c in turns)
    best: tuple[int, str] | None = None
    for lead, first, parity in _targets(entry, leave, turns):
        if lead and not ("s" in turns or "S" in turns):
            continue
        other = "a" if first == "u" else "u"
        # between start and start, or a and a, nothing said is a feasible length; from start or s to a it is not
        least = 0 if parity != 0 or entry == leave else 2
        sizes = [0] if parity < 0 else range(max(least, parity), n + (limit if limit < FAR else DELETE * n + INSERT * 2) // INSERT + 3, 2)
        goal = live - len(lead)
        for size in sorted(sizes, key=lambda k: (abs(k - goal), k)):
            gap = live - size - len(lead)
            if DELETE * (n - live) + (DELETE * gap if gap > 0 else -INSERT * gap) > limit:
                continue
            target = lead + (first + other) * (size // 2) + first * (size % 2)
            whole = min(limit, DELETE * n + INSERT * len(target) + TRUNCATED)
            rows = table_of(turns, target, whole)
            if rows[0][0] <= limit and rows[0][0] < FAR:
                found = (rows[0][0], backtrace(turns, target, rows))
                if best is None or found < best:
                    best = found
                limit = best[0]
    return best


Ways = dict[tuple[int, int], tuple[int, str, str]]


@lru_cache(maxsize=TABLES)
def ways_of(turns: str) -> Ways:
    """(cost, audit, state left) of a block for each pair of states."""
    out = {}
    for entry in range(4):
        for leave in range(4):
            found = aligned(turns, entry, leave)
            if found:
                out[entry, leave] = (*found, str(leave))
    return out


def joined(a: Ways, b: Ways) -> Ways:
    out: Ways = {}
    for (entry, between), (cost, audit, path) in a.items():
        for leave in range(4):
            then = b.get((between, leave))
            if then is None:
                continue
            old = out.get((entry, leave))
            total = cost + then[0]
            if old is None or total < old[0] or (total == old[0] and audit + then[1] < old[1]):
                out[entry, leave] = (total, audit + then[1], path + then[2])
    return out


def together(parts: list[Ways]) -> Ways:
    """Pairwise, so that an audit is copied once a level."""
    while len(parts) > 1:
        parts = [joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def piece_ways(turns: str) -> Ways:
    """Ways through a piece of any length; the path names only the state in which the piece is left."""
    parts = [ways_of(turns[i : i + BLOCK]) for i in range(0, len(turns), BLOCK)]
    return {k: (cost, audit, str(k[1])) for k, (cost, audit, _) in together(parts).items()}


@lru_cache(maxsize=TABLES)
def whole_conversation(turns: str) -> tuple[int, str]:
    """Cost and audit of a conversation that lies in one block."""
    empty = aligned(turns, START, START)
    full = aligned(turns, START, AFTER_A, empty[0])
    return min(x for x in (empty, full) if x)


def illegal_pairs(turns: str) -> int:
    last, out = None, 0
    for c in turns:
        now = last if c == COPY else GOES.get(c, c.lower())
        out += last is not None and last + now not in LEGAL
        last = now
    return out


# ------------------------------------------------------------------ Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, by crc32 of ``conv_id:turn`` mod 20: 0 drops the turn, 1 empties its text,
    2 removes its sentence ends, 3 repeats it, 4 makes it the user's; null values count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(space("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text")).alias("text"),
        fault.alias("fault"),
    ).where("fault <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("fault", "copy")


def _letter(role: Column, goes: Column, truncated: Column) -> Column:
    initial = F.when(F.substring(role, 1, 1).isin("u", "a", "s"), F.substring(role, 1, 1)).otherwise("o")
    return F.when(goes, F.translate(initial, INITIALS, "vbtp")).when(truncated, F.upper(initial)).otherwise(initial)


class Plan(NamedTuple):
    """Stored turns (src, conv_id, turn, role, text), their order (row, src), and a row a piece with its audit."""

    turns: DataFrame
    order: DataFrame
    pieces: DataFrame
    faults: DataFrame


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Illegal pairs, and the cost and audit of pieces that are a conversation of one block; all ways through others."""
    for batch in batches:
        out = []
        for r in batch.select(["conv_id", "part", "first_row", "turns", "pieces"]).to_pylist():
            turns, alone = r.pop("turns"), r.pop("pieces") == 1
            cost, audit, ways = None, None, []
            if alone and len(turns) <= BLOCK:
                cost, audit = whole_conversation(turns)
            else:
                ways = [{"entry": e, "leave": x, "cost": c, "audit": a} for (e, x), (c, a, _) in piece_ways(turns).items()]
                if alone:
                    cost, audit = min((w["cost"], w["audit"]) for w in ways if w["entry"] == START and w["leave"] in (START, AFTER_A))
                    ways = []
            at = lambda c: GOES.get(c, c.lower())
            out.append(r | {"turns": turns, "illegal": illegal_pairs(turns), "first": at(turns[0]), "last": at(turns.rstrip(COPY)[-1]), "entry": START, "cost": cost, "audit": audit, "ways": ways})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("conv_id", pa.int64()), ("part", pa.int64()), ("first_row", pa.int64()), ("turns", pa.string()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
            ("entry", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()),
            ("ways", pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
        ]))


WAYS = "array<struct<entry:int,leave:int,cost:bigint,audit:string>>"
PIECE = f"conv_id long, part long, first_row long, turns string, illegal long, first string, last string, entry int, cost long, audit string, ways {WAYS}"


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way through each piece of a conversation of several pieces."""
    for batch in batches:
        for r in batch.to_pylist():
            parts = [{(w["entry"], w["leave"]): (w["cost"], w["audit"], str(w["leave"])) for w in p["ways"]} for p in r["parts"]]
            ends = [w for (entry, leave), w in together(parts).items() if entry == START and leave in (START, AFTER_A)]
            path, entry, out = min(ends, key=lambda w: w[:2])[2], START, []
            for p, ways, leave in zip(r["parts"], parts, map(int, path), strict=True):
                cost, audit, _ = ways[entry, leave]
                out.append((r["conv_id"], p["part"], entry, cost, audit))
                entry = leave
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)],
                names=["conv_id", "part", "entry", "cost", "audit"],
            )


def plan(turns: DataFrame) -> Plan:
    """Align all conversations of ``turns`` (conv_id, turn, role, text; null role and text count as one space)."""
    small_batches(turns.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = stored(turns.select(
        F.monotonically_increasing_id().alias("src"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"), space("text").alias("text"),
    ), "turns")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    slim = rows.select(
        "src", "conv_id", "turn", "role", F.unhex(F.md5(F.concat("role", F.lit("\0"), "text").cast("binary"))).alias("mark"),
        (last == "").alias("blank"), ((last != "") & ~last.isin(".", "!", "?")).alias("cut"),
    )
    # Equal rows of a turn follow each other in any case: they become one with a count, added up where they are read.
    slim = slim.groupBy("conv_id", "turn", "role", "mark", "blank", "cut").agg(F.min("src").alias("src"), F.count(F.lit(1)).alias("copies"))
    slim = stored(slim, "turns-slim")
    seen = slim.where("not blank").groupBy("conv_id", "mark").agg(F.count(F.lit(1)).alias("times"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("none")).where("times > 1")
    slim = slim.join(seen.withColumnRenamed("conv_id", "c").withColumnRenamed("mark", "m"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    later = F.col("times").isNotNull() & ~F.col("blank") & F.when(F.col("none"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    slim = slim.withColumn("again", later).withColumn("cut", F.col("cut") & ~later)
    slim = slim.select("conv_id", "turn", "role", "mark", "src", "copies", "blank", "again", "cut", _letter(F.col("role"), F.col("blank") | F.col("again"), F.col("cut")).alias("letter"))
    by = ["conv_id", "turn", "role", "mark"]
    slim = slim.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id()).drop("role", "mark")
    slim = stored(slim, "turns-in-order")
    one, more = F.col("copies"), F.col("copies") - 1
    faults = slim.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), one).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.when(F.col("again"), one).otherwise(more)).otherwise(0)).alias("duplicate"), F.sum(F.when(F.col("cut"), 1).otherwise(0)).alias("truncated"),
    )
    span = (F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count("turn")).cast("decimal(38,0)")
    faults = faults.groupBy("conv_id").agg(
        F.when(F.count("turn") > 0, F.least(span, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")).otherwise(0).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    line = F.transform(F.array_sort(F.collect_list(F.struct("row", "letter", "copies"))), lambda x: F.concat(x["letter"], F.repeat(F.lit(COPY), (x["copies"] - 1).cast("int"))))
    pieces = slim.groupBy("conv_id", F.shiftright("row", 33).alias("part")).agg(F.min("row").alias("first_row"), F.array_join(line, "").alias("turns"))
    pieces = pieces.withColumn("pieces", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))  # a row a task that holds the conversation
    pieces = stored(pieces.mapInArrow(_aligned, PIECE), "turns-aligned")
    alone, split = pieces.where("audit is not null").drop("ways"), pieces.where("audit is null")
    found = split.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "ways"))).alias("parts")).mapInArrow(_chosen, "conv_id long, part long, entry int, cost long, audit string")
    rest = split.drop("entry", "cost", "audit", "ways")
    found = rest.join(found, _same(rest, found, "conv_id", "part")).select(rest["*"], found["entry"], found["cost"], found["audit"])
    return Plan(rows, slim.select("row", "src"), stored(alone.unionByName(found), "turns-audited"), faults)


def audits(made: Plan) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of the conversations that have turns."""
    before = F.lag("last").over(Window.partitionBy("conv_id").orderBy("part"))
    seam = F.when(before.isNotNull() & ~F.concat(before, "first").isin(*LEGAL), 1).otherwise(0)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "")
    ways = made.pieces.withColumn("illegal", F.col("illegal") + seam).groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit")
    )
    return made.faults.join(ways, _same(made.faults, ways, "conv_id")).select(made.faults["*"], "illegal", "cost", "audit")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that a repaired conversation has: kept rows, with a new role or none, and inserted ones, in order (at, k)."""
    names = {"u": "user", "a": "assistant"}
    for batch in batches:
        for r in batch.to_pylist():
            out, i, state, row, k = [], 0, r["entry"], r["first_row"] - 1, 0
            for edit in r["audit"]:
                wanted = "a" if state == AFTER_U else "u"
                if edit == "I":
                    out.append((r["conv_id"], 2 * row + 1, k, None, names[wanted]))
                    k += 1
                else:
                    letter = r["turns"][i]
                    row += letter != COPY
                    i += 1
                    if edit == "D":
                        continue
                    if edit == "K":
                        wanted = letter.lower()
                    out.append((r["conv_id"], 2 * row, 0, row, names[wanted] if edit == "R" else None))
                    k = 0
                state = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[wanted]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True)],
                    names=["conv_id", "at", "k", "row", "role"],
                )


def repaired(made: Plan) -> DataFrame:
    """conv_id, at, k, role, text: the turns of the repaired conversations, in the order of (at, k)."""
    lines = stored(made.pieces.select("conv_id", "first_row", "turns", "entry", "audit").mapInArrow(_lines, "conv_id long, at long, k int, row long, role string"), "repaired-lines")
    kept = lines.where("row is not null").withColumnRenamed("role", "new_role").join(made.order, "row").select("src", "at", "k", "new_role")
    kept = made.turns.join(kept, "src").select("conv_id", "at", "k", F.coalesce("new_role", "role").alias("role"), "text")
    return kept.unionByName(lines.where("row is null").select("conv_id", "at", "k", "role", F.lit("").alias("text")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` lines of sorted conversations, as a stream: no conversation is held."""
    now, digest, started = None, None, False
    for batch in batches:
        done = []
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if started and conv_id == now:
                digest.update(b"\n")
            else:
                if started:
                    done.append((now, digest.hexdigest()))
                now, digest, started = conv_id, hashlib.sha256(), True
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], names=["conv_id", "repaired_sha256"])
    if started:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])


def digests(lines: DataFrame) -> DataFrame:
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "k").select("conv_id", "role", "text")
    return lines.mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 after planted damage.

    One row for every conv_id of the input, null included (rows without conv_id are one
    conversation). Null values count as one space, so a null role is no legal one. Turns
    are taken by turn, nulls first; of different rows with one turn, by role, then by the
    MD5 of role and text; equal rows are duplicates. Roles count by their first character;
    other initials than u, a, s, and empty roles, are never kept as they are. A
    conversation without rows after damage has zeros, an empty audit and the digest of
    nothing. Reads conv_id, turn, role and text.
    """
    made = plan(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found, digest = audits(made), digests(repaired(made))
    out = every.join(found, _same(every, found, "conv_id"), "left").join(digest, _same(every, digest, "conv_id"), "left")
    return out.select(
        every["conv_id"], *[F.coalesce(found[c], F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(found["audit"], F.lit("")).alias("audit"), F.coalesce(digest["repaired_sha256"], F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
