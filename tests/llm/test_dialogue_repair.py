"""Repair of conversations against a search over all edits of plain code."""

import hashlib
import random
import zlib

import duckdb
import pytest

from reclink.llm import dialogue_repair as m
from tests.llm.helpers import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, part int, block int, audit string, codes int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        fault = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def plain_report(rows):
    """rows of one conversation in any order."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    # Forward over (row, state): least (cost, audit), with the messages. States are what was said so far, as a letter.
    best = {"": (0, "", ())}
    allowed = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    names = {"u": "user", "a": "assistant"}

    def offer(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def inserted(states):
        for _ in range(4):
            for state, (cost, audit, said) in list(states.items()):
                for letter in "ua":
                    if (state, letter) in allowed:
                        offer(states, letter, (cost + 5, audit + "I", said + ((names[letter], ""),)))
        return states

    for (_, _, role, text), fault, initial in zip(rows, faults, initials):
        then = {}
        for state, (cost, audit, said) in inserted(dict(best)).items():
            offer(then, state, (cost + 2, audit + "D", said))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if initial and (state, initial) in allowed:
                    offer(then, initial, (cost + more, audit + "K", said + ((role, text),)))
                for letter in "ua":
                    if (state, letter) in allowed:
                        offer(then, letter, (cost + more + 1, audit + "R", said + ((names[letter], text),)))
        best = then
    final = inserted(dict(best))
    cost, audit, said = min((final[s] for s in ("", "a") if s in final), key=lambda v: v[:2])
    joined = "\n".join(f"{role}:{text}" for role, text in said)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(1 for a, b in zip(initials, initials[1:]) if a + b not in ("su", "ua", "au")),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256(joined.encode()).hexdigest(),
    }


def check(spark, rows, damage=True):
    source = table(spark, rows)
    found = m.repair_report(m.repaired(m.damaged(source) if damage else source), source).collect()
    assert sorted((r["conv_id"] is None, r["conv_id"] or 0) for r in found) == sorted({(r[0] is None, r[0] or 0) for r in rows})
    left = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    groups = {}
    for r in left:
        groups.setdefault(r[0], []).append(r)
    for r in found:
        wanted = plain_report(groups.get(r["conv_id"], []))
        assert {k: r[k] for k in wanted} == wanted, r["conv_id"]


def invented(seed, convs, most):
    chooser = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(chooser.randrange(1, most)):
            role = chooser.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ugly"])
            text = chooser.choice(["Yes.", "No", "", " \n", None, "Why?", f"line {turn}.", f"line {turn}", "Done!\n"])
            rows.append((conv, chooser.choice([turn, turn, turn, turn // 2, None]), role, text))
    return rows


def test_small_table(spark):
    check(spark, duckdb.sql(f"select conv_id, turn, role, text from '{SMALL}/conversations.parquet'").fetchall())


def test_faults_of_all_kinds(spark):
    check(spark, invented(1, 60, 12))
    check(spark, invented(2, 60, 12), damage=False)


def test_long_conversations_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_ROWS", 2)
    check(spark, invented(3, 3, 150), damage=False)
    hot = [(7, 1, "user", "Again and again.")] * 300 + [(7, 2, "assistant", "Yes."), (None, None, None, None), (8, 20, "user", "Hm")]
    check(spark, hot, damage=False)


def test_messages_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi there."), (1, 2, "assistant", "Hello.")]
    blocks = m.repaired(table(spark, rows))
    said = m.repaired_messages(blocks).orderBy("part", "block", "position").collect()
    assert [(r["role"], r["text"]) for r in said] == [("user", "Hi there."), ("assistant", "Hello.")]
    assert "".join(r["audit"] for r in blocks.orderBy("part", "block").collect()) == "DKK"
    empty = table(spark, rows).limit(0)
    assert m.repair_report(m.repaired(empty), empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_blocks_agree_with_one_block(seed):
    """Vectors at checkpoints from sums of blocks are those of a pass over all rows."""
    chooser, steps = random.Random(seed), m.Steps()
    codes = bytes(chooser.randrange(9) for _ in range(200))
    whole = [tuple(c + t for c in v) for v, t in m.vectors(codes, m.END, steps)]
    after = m.END
    for start in range(180, -1, -20):
        assert after == whole[start + 20]
        after = m.before(m.block_costs(codes[start : start + 20], steps), after)
    assert after == whole[0]
