"""Cheapest repair of conversations by a dynamic program whose cost vectors are kept at checkpoints only.

The program has four states: nothing said yet, a system message said, a user message said last, an assistant message said
last. Backward cost vectors are kept only where blocks of rows meet. Blocks grow with the rows before them, so a
conversation of n rows has about the square root of n blocks of at most that order of rows each. A block is summed up by
its least costs between states; a backward pass over these sums gives the vector at every checkpoint. Each block then
recomputes its own vectors from its checkpoint while it walks forward. Blocks of one conversation are worked on by
different tasks; only their sums meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.llm.common import map_rows
from reclink.session import cut

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

# The k-th block of a run of rows has at most k times so many rows, and no block more than about so many bytes of text.
BLOCK_ROWS = 256
BLOCK_BYTES = 1 << 20

SPACES = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 50
# State after a message of the role that the state allows next, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
FINE = {"su", "ua", "au"}


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the checksum of `conv_id:turn` modulo 20; nulls count as one space.

    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks out, 3 repeats it, 4 makes
    the user its author. Other columns are not read.
    """
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.array_repeat(F.lit(0), times).alias("_n")).select(
        "conv_id", "turn", "role", "text", F.explode("_n").alias("_n")
    ).drop("_n")


def row_code(role: str, text: str) -> int:
    """0 for a blank row, else 1 + 2 * (place of the role's initial in s, u, a, any other) + (1 if the text is cut off)."""
    end = text.rstrip(SPACES)[-1:]
    if not end:
        return 0
    return 1 + 2 * "sua".find(role[:1] or "-") % 8 + (end not in ".!?")


def _kept(state: int, initial: int) -> int | None:
    """State after a kept message with this initial, None where it may not stand."""
    if initial == 0:
        return SYSTEM if state == NOTHING else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Least costs when messages may also be inserted here; two in a row reach every state that more could."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


class Steps(dict):
    """(code, costs after the row) to (costs before it, their least), both less their own least: few differ, so all are kept."""

    def __missing__(self, key: tuple[int, tuple[int, ...]]) -> tuple[tuple[int, ...], int]:
        code, after = key
        initial, cut_off = divmod(code - 1, 2)
        costs = []
        for state in range(4):
            best = DELETE + after[state]
            if code:
                best = min(best, REROLE + CUT_OFF * cut_off + after[NEXT[state]])
                to = _kept(state, initial)
                if to is not None:
                    best = min(best, KEEP + CUT_OFF * cut_off + after[to])
            costs.append(best)
        found = self[key] = _lowered(_with_inserts(costs))
        return found


def _lowered(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least if c < FAR else FAR for c in costs), least


END = _with_inserts([0, FAR, FAR, 0])


def block_costs(codes: bytes, steps: Steps) -> list[int]:
    """Least cost from each state before the block to each state after its last row, 16 numbers."""
    columns = []
    for to in range(4):
        costs, total = tuple(0 if s == to else FAR for s in range(4)), 0
        for code in reversed(codes):
            costs, least = steps[code, costs]
            total += least
        columns.append([c + total if c < FAR else FAR for c in costs])
    return [columns[to][state] for state in range(4) for to in range(4)]


def before(matrix: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a block from its sums and the costs after it."""
    return tuple(min(min(matrix[4 * s + t] + after[t] for t in range(4)), FAR) for s in range(4))


def vectors(codes: bytes, after: tuple[int, ...], steps: Steps) -> list[tuple[tuple[int, ...], int]]:
    """Lowered costs and what they are less by, before each row and after the last one."""
    costs, total = _lowered(after)
    found = [(costs, total)]
    for code in reversed(codes):
        costs, least = steps[code, costs]
        total += least
        found.append((costs, total))
    return found[::-1]


def walk(codes: bytes, known: list[tuple[tuple[int, ...], int]], state: int, last: bool) -> Iterator[tuple[str, int, int]]:
    """(edit, row, state after it) of the ASCII-least cheapest edits of a block entered in this state; row -1 is an insert."""
    at = 0
    while at < len(codes):
        (costs, total), (later, rest), code = known[at], known[at + 1], codes[at]
        best = costs[state] + total
        if best == DELETE + later[state] + rest:
            yield "D", at, state
        elif best == INSERT + costs[NEXT[state]] + total:
            state = NEXT[state]
            yield "I", -1, state
            continue
        else:
            initial, cut_off = divmod(code - 1, 2)
            to = _kept(state, initial)
            if to is not None and best == KEEP + CUT_OFF * cut_off + later[to] + rest:
                state = to
                yield "K", at, state
            else:
                state = NEXT[state]
                yield "R", at, state
        at += 1
    while last and state not in (NOTHING, ASSISTANT):
        state = NEXT[state]
        yield "I", -1, state


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in ranges of (conv_id, turn), nulls first; ties by role and text, so that equal rows are neighbours.

    A number for each row ends the sort key, so that equal rows may lie in several ranges. Texts enter it by their first
    letters and a digest: range bounds stay small.
    """
    key = ["conv_id", "turn", "_role", "_text", "_digest", "_row"]
    keyed = (
        rows.withColumn("_role", F.substring("role", 1, 64))
        .withColumn("_text", F.substring("text", 1, 64))
        .withColumn("_digest", F.md5(F.concat_ws(":", "role", "text")))
        .withColumn("_row", F.monotonically_increasing_id())
    )
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(count, *key).sortWithinPartitions(*key).select("conv_id", "turn", "role", "text")


BLOCK = "part int, block int, conv_id long, codes binary, marks array<binary>, roles array<string>, texts array<string>, turns long, first_turn long, last_turn long"


def _cut_blocks(read: Iterator[dict]) -> Iterator[dict]:
    """Blocks of neighbouring rows of one conversation, numbered within this range."""
    part, number, open_block, size, kth, limit = TaskContext.get().partitionId(), 0, None, 0, 0, 0
    for row in read:
        if open_block is not None and (open_block["conv_id"] != row["conv_id"] or len(open_block["codes"]) >= limit or size >= BLOCK_BYTES):
            same = open_block["conv_id"] == row["conv_id"]
            yield open_block | {"codes": bytes(open_block["codes"])}
            open_block, kth = None, kth if same else 0
        if open_block is None:
            kth, number, size = kth + 1, number + 1, 0
            limit = kth * BLOCK_ROWS
            open_block = {"part": part, "block": number, "conv_id": row["conv_id"], "codes": bytearray(), "turns": 0, "first_turn": None, "last_turn": None}
            open_block |= {"marks": [], "roles": [], "texts": []}
        role, text, turn = row["role"], row["text"], row["turn"]
        code = row_code(role, text)
        open_block["codes"].append(code)
        said = f"{len(role)}:{role}{text}".encode()
        open_block["marks"].append(hashlib.blake2b(said, digest_size=16).digest() if code else None)
        open_block["roles"].append(role)
        open_block["texts"].append(text)
        size += len(said)
        if turn is not None and turn != open_block["last_turn"]:
            open_block["turns"] += 1
            open_block["last_turn"] = turn
            if open_block["first_turn"] is None:
                open_block["first_turn"] = turn
    if open_block is not None:
        yield open_block | {"codes": bytes(open_block["codes"])}


def _sum_blocks(read: Iterator[dict]) -> Iterator[dict]:
    steps = Steps()
    for row in read:
        # A row with a text is a first one or a duplicate; blank rows (0) keep their code, duplicates get 0 and a mark.
        firsts, codes = set(row["firsts"] or ()), row["codes"]
        now = bytes(c if not c or i in firsts else 0 for i, c in enumerate(codes))
        yield {
            "part": row["part"],
            "block": row["block"],
            "conv_id": row["conv_id"],
            "now": now,
            "blank": codes.count(0),
            "duplicate": now.count(0) - codes.count(0),
            "truncated": sum(1 for c in now if c and not c % 2),
            "sums": block_costs(now, steps),
        }


def _checkpoints(read: Iterator[dict]) -> Iterator[dict]:
    """Costs at the end of every block; blocks come last to first."""
    conv, after, begun = None, END, False
    for row in read:
        last = not begun or row["conv_id"] != conv
        conv, begun, after = row["conv_id"], True, END if last else after
        yield {"part": row["part"], "block": row["block"], "after": list(after), "last": last}
        after = before(row["sums"], after)


def _exits(read: Iterator[dict]) -> Iterator[dict]:
    """State after the block for each state before it."""
    steps = Steps()
    for row in read:
        known = vectors(row["now"], tuple(row["after"]), steps)
        found = []
        for state in range(4):
            end = state
            if known[0][0][state] < FAR:
                for _, _, end in walk(row["now"], known, state, False):
                    pass
            found.append(end)
        yield {"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "exits": found}


def _entries(read: Iterator[dict]) -> Iterator[dict]:
    """State before every block; blocks come first to last."""
    conv, state, begun = None, NOTHING, False
    for row in read:
        if not begun or row["conv_id"] != conv:
            conv, begun, state = row["conv_id"], True, NOTHING
        yield {"part": row["part"], "block": row["block"], "entry": state}
        state = row["exits"][state]


def _emit(read: Iterator[dict]) -> Iterator[dict]:
    """Edits and repaired messages of every block, and what its neighbours need to know of it."""
    steps = Steps()
    for row in read:
        codes, roles, texts = row["now"], row["roles"], row["texts"]
        known = vectors(codes, tuple(row["after"]), steps)
        audit, said_by, said, cost = [], [], [], 0
        for edit, at, state in walk(codes, known, row["entry"], row["last"]):
            audit.append(edit)
            if edit == "D":
                cost += DELETE
            elif edit == "I":
                cost += INSERT
                said_by.append(ROLE[0] if state == USER else ROLE[2])
                said.append("")
            else:
                cost += (KEEP if edit == "K" else REROLE) + CUT_OFF * ((codes[at] - 1) % 2)
                said_by.append(roles[at] if edit == "K" else ROLE[0] if state == USER else ROLE[2])
                said.append(texts[at])
        illegal = sum(1 for a, b in zip(roles, roles[1:]) if a[:1] + b[:1] not in FINE)
        ends = {"first_role": roles[0][:1], "last_role": roles[-1][:1]}
        plain = {k: row[k] for k in ("part", "block", "conv_id", "blank", "duplicate", "truncated", "turns", "first_turn", "last_turn")}
        yield plain | ends | {"audit": "".join(audit), "cost": cost, "illegal": illegal, "roles": said_by, "texts": said}


def repaired(rows: DataFrame) -> DataFrame:
    """Edits and repaired messages of every conversation in (conv_id, turn, role, text), one row for each block of rows.

    (part, block) orders the blocks of a conversation. audit has an initial for each edit (Keep, Rerole, Delete, Insert),
    roles and texts are the repaired messages, cost is the cost of the edits. blank, duplicate, truncated and illegal count
    faults; first_role, last_role, turns, first_turn and last_turn let neighbouring blocks be joined.

    A row whose role and text stood earlier in its conversation is a duplicate; the earliest of all equal rows is found by
    their digest in an aggregation that starts inside the tasks, so a message that fills a third of the table costs one
    row for each task.
    """
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    blocks = cut(map_rows(_ordered(clean), _cut_blocks, BLOCK), "blocks")
    marks = blocks.select("conv_id", "part", "block", F.posexplode("marks").alias("row", "mark")).where("mark is not null")
    earliest = marks.groupBy("conv_id", "mark").agg(F.min(F.struct("part", "block", "row")).alias("at"))
    firsts = earliest.groupBy("at.part", "at.block").agg(F.collect_list("at.row").alias("firsts"))
    place = ["part", "block"]
    counts = "blank long, duplicate long, truncated long"
    summed = blocks.select("part", "block", "conv_id", "codes").join(firsts, place, "left")
    summed = cut(map_rows(summed, _sum_blocks, f"part int, block int, conv_id long, now binary, {counts}, sums array<long>"), "sums")
    backward = summed.select("conv_id", "part", "block", "sums").repartition("conv_id")
    backward = backward.sortWithinPartitions("conv_id", F.col("part").desc(), F.col("block").desc())
    after = map_rows(backward, _checkpoints, "part int, block int, after array<long>, last boolean")
    known = cut(summed.drop("sums").join(after, place), "checkpoints")
    exits = map_rows(known.select("conv_id", "part", "block", "now", "after"), _exits, "conv_id long, part int, block int, exits array<int>")
    forward = exits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    entries = map_rows(forward, _entries, "part int, block int, entry int")
    texts = blocks.select("part", "block", "roles", "texts", "turns", "first_turn", "last_turn")
    whole = known.join(entries, place).join(texts, place)
    schema = f"part int, block int, conv_id long, {counts}, turns long, first_turn long, last_turn long, first_role string, last_role string"
    return map_rows(whole, _emit, f"{schema}, audit string, cost long, illegal long, roles array<string>, texts array<string>")


def repaired_messages(blocks: DataFrame) -> DataFrame:
    """(conv_id, part, block, position, role, text): the messages of repaired conversations, in order."""
    said = F.posexplode(F.arrays_zip("roles", "texts")).alias("position", "said")
    return blocks.select("conv_id", "part", "block", said).select("conv_id", "part", "block", "position", "said.roles", "said.texts").toDF(
        "conv_id", "part", "block", "position", "role", "text"
    )


def _report(read: Iterator[dict]) -> Iterator[dict]:
    """One row for each conversation from its blocks in order; the hash runs on from block to block."""
    found, digest, started, last = None, None, False, None

    def closed() -> dict:
        low, high = found.pop("low"), found.pop("high")
        turns = found.pop("turns")
        gaps = 0 if low is None else high - low + 1 - turns
        return found | {"gaps": gaps, "audit": "".join(found["audit"]), "repaired_sha256": digest.hexdigest()}

    for row in read:
        if found is None or found["conv_id"] != row["conv_id"]:
            if found is not None:
                yield closed()
            counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
            found = {"conv_id": row["conv_id"], "audit": [], "low": None, "high": None} | counts
            digest, started, last = hashlib.sha256(), False, None
        if row["audit"] is None:  # the mark of a conversation, which has no rows
            continue
        for name in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
            found[name] += row[name]
        if last is not None and last + row["first_role"] not in FINE:
            found["illegal"] += 1
        last = row["last_role"]
        if row["first_turn"] is not None:
            if found["high"] == row["first_turn"]:
                found["turns"] -= 1
            found["low"] = row["first_turn"] if found["low"] is None else found["low"]
            found["high"] = row["last_turn"]
        found["audit"].append(row["audit"])
        for role, text in zip(row["roles"], row["texts"]):
            digest.update(f"{chr(10) if started else ''}{role}:{text}".encode())
            started = True
    if found is not None:
        yield closed()


def repair_report(blocks: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of conversations: faults, cost, edits and the digest of the repaired messages.

    gaps counts the turns that are missing between the least and the largest one. A conversation without blocks has zeros,
    no edits and the digest of no text. A null conv_id is a conversation of its own. Whole blocks of messages reach the
    task that runs a digest over a conversation, one after the other.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(-1).alias("part"), F.lit(0).alias("block")).distinct()
    together = blocks.unionByName(ids, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return map_rows(together, _report, f"conv_id long, {counts}, audit string, repaired_sha256 string")
