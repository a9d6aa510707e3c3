"""Conversation repair against the enumeration of all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from claimlode.llm import turns

ROWS = "conv_id long, turn long, role string, text string, audit string, place int, id long"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 7, 8) for row in rows], ROWS)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3]))


def flaws(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def enumerated(rows, found):
    """(cost, audit, lines) by trying every edit of every turn, with up to two turns put in before each."""
    best = (10**9, "", [])
    choices = [["D"] if flaw in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for flaw in found]
    gaps = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*choices):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, roles, lines = 3 * sum(map(len, put)), "", "", []
            for i in range(len(rows) + 1):
                audit += "I" * len(put[i])
                roles += put[i]
                lines += [{"u": "user:", "a": "assistant:"}[c] for c in put[i]]
                if i == len(rows):
                    break
                _, _, role, text = rows[i]
                audit += edits[i][0]
                if edits[i] == "D":
                    cost += 4
                    continue
                cost += 3 * (found[i] == "truncated")
                if edits[i] == "K":
                    roles += role[:1] if role[:1] in ("s", "u", "a") else "?"
                    lines.append(f"{role}:{text}")
                else:
                    cost += 3
                    roles += edits[i][1]
                    lines.append({"u": "user:", "a": "assistant:"}[edits[i][1]] + text)
            if (cost, audit) < best[:2] and re.fullmatch("(s?(ua)+)?", roles):
                best = (cost, audit, lines)
    return best


def expected(rows):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ordered(rows)]
    found = flaws(rows)
    numbers = [t for _, t, _, _ in rows if t is not None]
    pairs = zip(rows, rows[1:])
    cost, audit, lines = enumerated(rows, found)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        **{flaw: found.count(flaw) for flaw in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def random_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, 4)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["One.", "Two!", "no end", "", " \t", None, "One.", f"t{turn}?", "mid. word"])
            out.append((conv, rng.choice([turn, turn, turn * 2, None, 0]), role, text))
    return out + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes.")]


@pytest.mark.parametrize("size,rules", [(4096, 4096), (2, 4096), (1, 3)])
def test_plan_and_digests_equal_the_enumeration(spark, monkeypatch, size, rules):
    rows = random_rows(60, 5)
    monkeypatch.setattr(turns.repair_plan, "__defaults__", (size, rules))
    data = frame(spark, rows)
    got = {r["conv_id"]: r.asDict() for r in turns.repair_report(data, data).collect()}
    assert len(got) == 61
    for conv in {r[0] for r in rows}:
        want = expected([r for r in rows if r[0] == conv])
        assert {key: got[conv][key] for key in want} == want, conv


def test_long_conversations_in_pieces(spark):
    rng = random.Random(2)
    rows = [(conv, t, rng.choice(["user", "assistant"]), rng.choice(["One.", f"{t}?", "cut", ""])) for conv in range(3) for t in range(300)]
    rows += [(9, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)]
    whole = sorted(map(str, turns.repair_plan(frame(spark, rows)).collect()))
    assert whole == sorted(map(str, turns.repair_plan(frame(spark, rows), size=7, rules=5).collect()))
    assert whole == sorted(map(str, turns.repair_plan(frame(spark, rows), size=64, rules=0).collect()))
    assert any("'" + "K" * 400 + "'" in row for row in whole)


def test_damage_and_conversations_that_vanish(spark):
    rows = [(conv, turn, "assistant" if turn == 1 else "user", "Is it. So? no") for conv in range(80) for turn in [*range(3), None]]
    want = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    data = frame(spark, rows)
    got = turns.damaged(data)
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in spark.createDataFrame(want, "conv_id long, turn long, role string, text string").collect())
    gone = frame(spark, [(1, 1, "user", "a"), (2, 1, "user", "a")])
    told = {r.conv_id: r for r in turns.repair_report(gone, turns.damaged(gone).where("conv_id = 2")).collect()}
    assert told[1].audit == "" and told[1].cost == 0 and told[1].repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_table_long_texts_and_far_turns(spark):
    none = frame(spark, [])
    assert turns.repair_report(none, none).collect() == []
    rows = [(1, -(2**62), "user", "x" * 3_000_000 + "."), (1, 2**62, "assistant", "y " * 1_000_000 + "!")]
    row = turns.repair_report(frame(spark, rows), frame(spark, rows)).first()
    assert row.audit == "KK" and row.gaps == 2**63 - 1
    assert row.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows).encode()).hexdigest()


def test_ropes_compare_as_their_texts():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("DIK", k=rng.randint(0, 9))) for _ in range(2))
        assert turns.text_of(turns.rope_of(a)) == a
        assert turns.before(turns.rope_of(a), turns.rope_of(b)) == (a < b)
        cut = rng.randint(0, len(a))
        assert not turns.before(turns.joined(turns.rope_of(a[:cut]), turns.rope_of(a[cut:])), turns.rope_of(a))
