"""Conversation structure repair by Hirschberg divide and conquer over four states.

A conversation is repaired when its role initials read ``(s?(ua)+)?``: nothing, or at most one
system turn and then user and assistant in turn. The edits are Keep (0), Rerole to user or
assistant (2), Delete (3; required for blank and duplicate rows) and Insert an
empty user or assistant turn (2); a truncated row that stays adds 1. While reading, one of
four states holds: at the start, after the system turn, after a user, after an assistant.

A row is a table: for each pair of states the cheapest edits that lead from one to the
other (inserts before the row, then the row), of equally cheap ones the least by code point. A
forward vector holds for each state the cost of reaching it and the rank of its least audit among
the four, a backward vector the cost from there to the end. Audits of different states differ at
a character that both have (each ends by an edit that uses a row), so ranks and next letters order
them without storing them. The vectors meet in the middle; of the cheapest crossings the one
with the least rank is on the least audit, and both halves are solved alike. Vectors
are kept relative to their least cost; few different ones exist, so steps are looked up.

Rows are sorted by range of (conversation, turn, ...), so a long conversation runs over many
tasks. Tasks cut it into blocks of at most ``ROWS`` lines; a block is a table of four by four like a
row, and the same crossing over a conversation's blocks (one small record each) fixes the
states at their borders. Rows equal in all columns travel once with their number, and the text of a
row only with its first occurrence. What stays sequential is the digest of a conversation of more
than one block: SHA-256 has to read the blocks in order, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import SPACES, map_arrow, stored, table

#: Lines of a block, and characters of text after which it ends.
ROWS, CHARS = 4_096, 1 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
FORCED, END = 8, 9
ROLES = {USER: "user", ASSISTANT: "assistant"}


def _read(state: int, initial: str) -> int | None:
    """The state after a turn with this initial; None where the form doesn't allow it."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _wanted(state: int) -> int:
    """The state after the only turn that can be made up here."""
    return ASSISTANT if state == USER else USER


def _tables() -> list[list[list[tuple[int, str] | None]]]:
    """For each kind of row, by state before and after: (cost, audit) of the best edits.

    Kind 2 i + t: initial s, u, a or another, truncated or not; FORCED: must be deleted; END: what is inserted behind the last row.
    """
    out = []
    for kind in range(10):
        best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]

        def offer(a: int, b: int, cost: int, audit: str) -> None:
            best[a][b] = min(filter(None, [best[a][b], (cost, audit)]))

        for a in range(4):
            if kind != END:
                offer(a, a, DELETE, "D")
            at = a
            for n in range(3):
                if kind == END:
                    if at in (START, ASSISTANT):
                        offer(a, ASSISTANT, INSERT * n, "I" * n)
                elif kind != FORCED:
                    extra = INSERT * n + TRUNCATED * (kind % 2)
                    kept = _read(at, "sua-"[kind // 2])
                    if kept is not None:
                        offer(a, kept, extra, "I" * n + "K")
                    offer(a, _wanted(at), extra + REROLE, "I" * n + "R")
                at = _wanted(at)
        out.append(best)
    return out


TABLES = _tables()
Vector = tuple[tuple[int, int] | None, ...]


def unit(state: int) -> Vector:
    return tuple((0, 0) if q == state else None for q in range(4))


def through(vector: Vector, rows: list) -> Vector:
    """A forward vector behind one more table: cost relative to the least, and rank of the least audit."""
    reach: dict[int, tuple] = {}
    for a, held in enumerate(vector):
        for b, way in enumerate(rows[a]) if held else ():
            if way:
                offer = (held[0] + way[0], held[1], way[1])
                reach[b] = min(reach.get(b, offer), offer)
    low = min(x[0] for x in reach.values())
    order = sorted(reach, key=lambda b: reach[b][1:])
    return tuple((reach[b][0] - low, order.index(b)) if b in reach else None for b in range(4))


def back(costs: tuple[int | None, ...], rows: list) -> tuple[int | None, ...]:
    """A backward vector before one more table."""
    out = []
    for a in range(4):
        ways = [way[0] + costs[b] for b, way in enumerate(rows[a]) if way and costs[b] is not None]
        out.append(min(ways) if ways else None)
    low = min(c for c in out if c is not None)
    return tuple(None if c is None else c - low for c in out)


@lru_cache(maxsize=1 << 16)
def _row_through(vector: Vector, kind: int) -> Vector:
    return through(vector, TABLES[kind])


@lru_cache(maxsize=1 << 16)
def _row_back(costs: tuple[int | None, ...], kind: int) -> tuple[int | None, ...]:
    return back(costs, TABLES[kind])


def hirschberg(items: list, first: int, last: int, forward: Callable, backward: Callable) -> list[int]:
    """The states behind each item on the cheapest and least way from ``first`` to ``last``, in linear space."""
    if not items:
        return []
    states = [0] * len(items)
    states[-1] = last
    parts = [(0, len(items), first, last)]
    while parts:
        lo, hi, p, q = parts.pop()
        if hi - lo < 2:
            continue
        middle = (lo + hi) // 2
        ahead: Vector = unit(p)
        for x in range(lo, middle):
            ahead = forward(ahead, items[x])
        behind = tuple(0 if s == q else None for s in range(4))
        for x in range(hi - 1, middle - 1, -1):
            behind = backward(behind, items[x])
        meet = min((ahead[s][0] + behind[s], ahead[s][1], s) for s in range(4) if ahead[s] and behind[s] is not None)[2]
        states[middle - 1] = meet
        parts += [(lo, middle, p, meet), (middle, hi, meet, q)]
    return states


def solve(kinds: list[int], first: int, last: int) -> list[str]:
    """The audit of each row of a block between two states."""
    states = hirschberg(kinds, first, last, _row_through, _row_back)
    return [TABLES[k][a][b][1] for k, a, b in zip(kinds, [first, *states], states)]


def block_table(kinds: list[int]) -> list[list[tuple[int, int] | None]]:
    """A block as one table: cost and rank of the least audit for each pair of states."""
    out = []
    for p in range(4):
        vector, total = unit(p), [0 if q == p else None for q in range(4)]
        for k in kinds:
            vector = _row_through(vector, k)
            total = [
                min((total[a] + TABLES[k][a][b][0] for a in range(4) if total[a] is not None and TABLES[k][a][b]), default=None) for b in range(4)
            ]
        out.append([(total[q], vector[q][1]) if vector[q] else None for q in range(4)])
    return out


def kind_of(role: str, fault: str) -> int:
    return FORCED if fault in ("blank", "duplicate") else 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (fault == "truncated")


BLOCK_ID = "part int, block int, conv_id long, open boolean"
BLOCK = f"{BLOCK_ID}, lines array<struct<turn:long, role:string, fault:string, n:long, text:string>>"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with planted faults; nulls of role and text become one space.

    By crc32 of ``conv_id:turn`` (a null: one space) modulo 20: 0 drops the row, 1 empties the text, 2 removes
    ``[.!?]``, 3 repeats the row, 4 makes the role ``user``. Other columns are left out.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), part("role").alias("role"), part("text").alias("text"),
        (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20).alias("fate"),
    ).filter("fate <> 0")
    fate = F.col("fate")
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fate == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _visible(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def lines(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Sorted by range: one line per distinct row with its number, and behind it the first occurrence of a role and text."""
    text = F.col("text")
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), named("role"), named("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    counted = rows.select("conv_id", "turn", "role", digest, (_visible(text) == "").alias("blank")).groupBy("conv_id", "turn", "role", "digest", "blank").agg(F.count("*").alias("n"))
    heads = rows.filter(_visible(text) != "").groupBy("conv_id", "role", "text").agg(F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("least"))
    heads = heads.select(
        "conv_id", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", digest, F.lit(2).alias("what"), F.lit(0).cast("long").alias("n"),
        F.when(F.substring(_visible(text), -1, 1).isin(".", "!", "?"), "").otherwise("truncated").alias("fault"), "text",
    )
    counted = counted.select(
        "conv_id", "turn", "role", "digest", F.lit(1).alias("what"), "n", F.when(F.col("blank"), "blank").otherwise("duplicate").alias("fault"), F.lit(None).cast("string").alias("text")
    )
    none = lambda kind: F.lit(None).cast(kind)
    present = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"), F.lit(0).alias("what"), F.lit(0).cast("long").alias("n"),
        F.lit("").alias("fault"), none("string").alias("text"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    return present.unionByName(counted).unionByName(heads).repartitionByRange(*order).sortWithinPartitions(*order, "what")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted lines of one task; ``open`` where a conversation may go on elsewhere."""
    from pyspark import TaskContext

    part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
    current, started, first, cut = None, False, True, False

    def block(open_: bool) -> pa.RecordBatch:
        nonlocal number
        number += 1
        row = {"part": part, "block": number, "conv_id": current, "open": open_, "lines": held}
        return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)

    for row in _rows(batches):
        if not started or row["conv_id"] != current:
            if started:
                yield block(first or cut)
                first = False
            current, started, held, size, cut = row["conv_id"], True, [], 0, False
        line = {c: row[c] for c in ("turn", "role", "fault", "n", "text")}
        if row["what"] == 1:
            if len(held) >= ROWS or size >= CHARS:
                yield block(True)
                held, size, cut = [], 0, True
            held.append(line)
        elif row["what"] == 2:  # the first of the rows just counted
            held[-1]["n"] -= 1
            rest = held.pop()
            held += [{**line, "n": 1}] + ([rest] if rest["n"] else [])
            size += len(row["text"])
    if started:
        yield block(True)


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 64) -> Iterator[dict]:
    """Rows as dictionaries, few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_once):
            yield from batch.slice(start, at_once).to_pylist()


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def _arrow(ddl: str, **nested: pa.DataType) -> pa.Schema:
    """Arrow schema of flat columns, and of nested ones given by name; made without a session, as workers need it."""
    flat = [c.split(" ", 1) for c in ddl.split(", ")]
    return pa.schema([(name, _TYPES[kind]) for name, kind in flat] + list(nested.items()))


_LINE = pa.struct(list(_arrow("turn long, role string, fault string, n long, text string")))
BLOCK_ARROW = _arrow(BLOCK_ID, lines=pa.list_(_LINE))
_FOUND = (
    f"{BLOCK_ID}, audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
    "first_role string, last_role string, low long, high long, distinct_turns long"
)
SOLVED = f"{_FOUND}, turns array<struct<role:string, text:string>>"
SOLVED_ARROW = _arrow(_FOUND, turns=pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))
LEGAL = {"su", "ua", "au"}


def _kinds(rows: list[dict]) -> list[int]:
    """Kinds of a block's lines; a run of rows that must go counts as one, which changes no state."""
    return [kind_of(x["role"], x["fault"]) for x in rows]


def _repaired(block: dict, first: int, last: int, end: bool) -> dict:
    rows = block["lines"]
    kinds = _kinds(rows) + ([END] if end else [])
    audits = solve(kinds, first, last)
    state, turns, cost = first, [], 0
    for i, audit in enumerate(audits):
        row = rows[i] if i < len(rows) else None
        for letter in audit:
            if letter == "D":
                cost += DELETE * row["n"]
                continue
            cost += {"I": INSERT, "R": REROLE, "K": 0}[letter]
            if letter in "KR" and row["fault"] == "truncated":
                cost += TRUNCATED
            if letter == "K":
                state = _read(state, row["role"][:1])
                turns.append({"role": row["role"], "text": row["text"]})
            else:
                state = _wanted(state)
                turns.append({"role": ROLES[state], "text": row["text"] if letter == "R" else ""})
        if row and audit == "D":
            audits[i] = "D" * row["n"]
    known = [x["turn"] for x in rows if x["turn"] is not None]
    initials = [x["role"][:1] for x in rows]
    return {
        **{c: block[c] for c in ("part", "block", "conv_id", "open")}, "audit": "".join(audits), "cost": cost, "turns": turns,
        **{f: sum(x["n"] for x in rows if x["fault"] == f) for f in ("blank", "duplicate", "truncated")},
        # Legal pairs have different initials, so all pairs within a run of equal rows are illegal.
        "illegal": sum(x["n"] - 1 for x in rows) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_role": initials[0] if rows else None, "last_role": initials[-1] if rows else None,
        "low": known[0] if known else None, "high": known[-1] if known else None, "distinct_turns": len(set(known)),
    }


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for block in _rows(batches, 8):
        held.append(_repaired(block, block.get("p", START), block.get("q", ASSISTANT), block.get("last", True)))
        size += len(block["lines"])
        if size >= ROWS or len(held) >= 256:
            yield pa.RecordBatch.from_pylist(held, schema=SOLVED_ARROW)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=SOLVED_ARROW)


def _block_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _rows(batches, 8):
        flat = [x for way in sum(block_table(_kinds(block["lines"])), []) for x in (way or (-1, -1))]
        yield pa.RecordBatch.from_pylist([{**{c: block[c] for c in ("part", "block", "conv_id")}, "ways": flat}], schema=_arrow(TABLE))


TABLE = "part int, block int, conv_id long, ways array<long>"
BORDERS = "part int, block int, p int, q int, last boolean"


def _borders(found: pa.Table) -> pa.Table:
    """States at the borders of one conversation's blocks."""
    rows = sorted(found.to_pylist(), key=lambda x: (x["part"], x["block"]))
    tables = []
    for x in rows:
        w = x["ways"]
        ways = [(w[i], w[i + 1]) if w[i] >= 0 else None for i in range(0, 32, 2)]
        tables.append([ways[i : i + 4] for i in range(0, 16, 4)])
    states = hirschberg([*tables, TABLES[END]], START, ASSISTANT, through, back)
    states[-2:] = states[-1:]  # the last block also takes what is inserted at the end
    out = [
        {"part": x["part"], "block": x["block"], "p": p, "q": q, "last": i == len(rows) - 1}
        for i, (x, p, q) in enumerate(zip(rows, [START, *states], states))
    ]
    return pa.Table.from_pylist(out, schema=_arrow(BORDERS))


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The repaired conversations in blocks: conv_id, part and block (their order), audit, cost, turns, counts.

    ``rows`` has conv_id and turn (long), role and text; ``ids`` lists the conversations to
    return (those of ``rows`` if left out). Nulls of role and text count as one space, a null conv_id is a
    conversation of its own, null turns come first; rows of one turn follow by role and then by the SHA-256 of
    their text. A row is blank without a visible character, else a duplicate if its role and text occurred
    before, else truncated if its last visible character isn't one of ``.!?``. Repeated rows count
    each. ``turns`` holds the repaired turns (role, text); the audit names the edits in order. Other columns
    are left out; a conversation without rows has one block without turns, and an empty table none.
    """
    wanted = rows.select("conv_id") if ids is None else ids.select("conv_id")
    blocks = stored(map_arrow(lines(rows, wanted), _cut, BLOCK), "conversation-blocks")
    whole = map_arrow(blocks.filter("not open"), _solve_blocks, SOLVED)
    parts = blocks.filter("open")
    tables = stored(map_arrow(parts, _block_tables, TABLE), "conversation-tables")
    borders = stored(tables.groupBy("conv_id").applyInArrow(_borders, BORDERS), "conversation-borders")
    return whole.unionByName(map_arrow(parts.join(borders, ["part", "block"]), _solve_blocks, SOLVED))


DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
FIGURES = ("blank", "duplicate", "truncated", "illegal", "cost")


def _digest_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its sorted blocks, one block at a time."""
    current, held = None, None

    def done() -> pa.RecordBatch:
        spread = 0 if held["low"] is None else held["high"] - held["low"] + 1 - held["turns"]
        row = {"conv_id": current, "gaps": spread, "audit": "".join(held["audit"]), "repaired_sha256": held["hash"].hexdigest(), **{c: held[c] for c in FIGURES}}
        return pa.RecordBatch.from_pylist([row], schema=_arrow(DIGEST))

    for x in _rows(batches, 8):
        if held is None or x["conv_id"] != current:
            if held:
                yield done()
            current = x["conv_id"]
            held = {"hash": hashlib.sha256(), "any": False, "audit": [], "low": None, "high": None, "turns": 0, "role": None, **dict.fromkeys(FIGURES, 0)}
        for c in FIGURES:
            held[c] += x[c]
        held["audit"].append(x["audit"])
        if x["first_role"] is not None:
            held["illegal"] += held["role"] is not None and held["role"] + x["first_role"] not in LEGAL
            held["role"] = x["last_role"]
        if x["low"] is not None:
            held["turns"] += x["distinct_turns"] - (held["high"] == x["low"])
            held["low"] = x["low"] if held["low"] is None else held["low"]
            held["high"] = x["high"]
        if x["n_turns"]:
            held["hash"].update((("\n" if held["any"] else "") + x["body"]).encode("utf-8"))
            held["any"] = True
    if held:
        yield done()


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps between its turns, counts of faults, cost, audit and the SHA-256 of its repaired turns."""
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    spread = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct_turns"), F.lit(0).cast("long"))
    names = [c.split()[0] for c in DIGEST.split(", ")]
    whole = repaired.filter("not open").withColumns({"gaps": spread, "repaired_sha256": F.sha2(body, 256)}).select(names)
    parts = repaired.filter("open").withColumns({"body": body, "n_turns": F.size("turns")}).drop("turns")
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return whole.unionByName(map_arrow(ordered, _digest_blocks, DIGEST))


def op11_hirschberg_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    return digest(stored(repair(damage(given), given), "conversation-repaired"))


#: DuckDB has no crc32, so it is folded bit by bit; the least audits come from a plain forward pass.
SQL = """
WITH RECURSIVE fate AS (
  SELECT *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS k FROM conversations
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i::int, 1))::bigint)),
      lambda c, x: list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda j: j::bigint)),
        lambda a, j: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::bigint) ELSE a // 2 END)), 4294967295::bigint) % 20 AS f
  FROM fate
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), seen AS (
  SELECT *, coalesce(conv_id::varchar, '') AS cid, row_number() OVER w AS pos, substr(role, 1, 1) AS ini,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS shown
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))
), judged AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM seen
), nxt(q, ch, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)
), made AS (SELECT q, r FROM nxt WHERE ch <> 's'
), ahead(q, r, c, l) AS (
  SELECT i, i, 0, '' FROM range(4) t(i)
  UNION ALL SELECT q, r, 2, 'I' FROM made
  UNION ALL SELECT a.q, b.r, 4, 'II' FROM made a JOIN made b ON a.r = b.q
), dp(cid, pos, q, cost, audit) AS (
  SELECT DISTINCT coalesce(conv_id::varchar, ''), 0::bigint, 0, 0::bigint, '' FROM conversations
  UNION ALL
  SELECT cid, pos, r, best.c, best.l FROM (
    SELECT d.cid, j.pos, m.r, min({'c': (d.cost + m.c + CASE WHEN j.fault = 'truncated' AND m.stays THEN 1 ELSE 0 END)::bigint, 'l': d.audit || m.l}) AS best
    FROM dp d JOIN judged j ON j.cid = d.cid AND j.pos = d.pos + 1 JOIN (
      SELECT q, r, 3 AS c, 'D' AS l, NULL AS need, false AS stays FROM ahead WHERE c = 0
      UNION ALL SELECT a.q, n.r, a.c, a.l || 'K', n.ch, true FROM ahead a JOIN nxt n ON a.r = n.q
      UNION ALL SELECT a.q, n.r, a.c + 2, a.l || 'R', NULL, true FROM ahead a JOIN made n ON a.r = n.q) m
    ON m.q = d.q AND (m.need IS NULL OR m.need = j.ini) AND (NOT m.stays OR j.fault IN ('', 'truncated'))
    GROUP BY d.cid, j.pos, m.r)
), ends AS (
  SELECT d.cid, min({'c': (d.cost + a.c)::bigint, 'l': d.audit || a.l}) AS best
  FROM dp d JOIN (SELECT q, r, c, l FROM ahead) a ON a.q = d.q AND a.r IN (0, 3)
  WHERE d.pos = coalesce((SELECT max(pos) FROM judged j WHERE j.cid = d.cid), 0) GROUP BY d.cid
), letters AS (
  SELECT cid, i, substr(best.l, i::int, 1) AS letter, substr(best.l, 1, i::int) AS so_far FROM ends, range(1, length(best.l) + 1) t(i)
), placed AS (
  SELECT *, length(so_far) - length(replace(so_far, 'I', '')) AS made_up, length(so_far) - length(replace(so_far, 'D', '')) AS gone FROM letters
), turns AS (
  SELECT p.cid, p.i, p.letter, j.role, j.text,
    row_number() OVER (PARTITION BY p.cid ORDER BY p.i) AS place,
    max(CASE WHEN p.letter = 'K' AND j.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.cid) AS sys
  FROM placed p LEFT JOIN judged j ON j.cid = p.cid AND j.pos = p.i - p.made_up AND p.letter <> 'I' WHERE p.letter <> 'D'
), bodies AS (
  SELECT cid, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS body FROM turns GROUP BY cid
), counts AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY cid
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, e.best.c AS cost, e.best.l AS audit, sha256(coalesce(b.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::varchar, '') AS cid FROM conversations) o
JOIN ends e ON e.cid = o.cid LEFT JOIN counts c ON c.cid = o.cid LEFT JOIN bodies b ON b.cid = o.cid
"""

QUERIES = {"op11_hirschberg_repair": (op11_hirschberg_repair, SQL)}
