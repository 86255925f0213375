"""Conversation repair beside a search over all edits."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from wardspan.llm.repair import damage, digest, edits, parse, repair, repair_report

TURNS = "conv_id long, turn int, role string, text string, at string, key int, first int"
VALID = re.compile(r"(s?(ua)+)?")


def brute(turns: str, most: int) -> tuple[int, str]:
    """The least (cost, audit) of all edits that cost at most ``most``."""
    found = []

    def go(i, roles, cost, audit):
        if cost > most:
            return
        if i == len(turns) and VALID.fullmatch(roles):
            found.append((cost, audit))
        for r in "ua":
            go(i, roles + r, cost + 5, audit + "I")
        if i < len(turns):
            turn = turns[i]
            go(i + 1, roles, cost + 2, audit + "D")
            if turn != "-":
                cut = 5 if turn.isupper() else 0
                if turn.lower() in "sua":
                    go(i + 1, roles + turn.lower(), cost + cut, audit + "K")
                for r in "ua":
                    go(i + 1, roles + r, cost + cut + 1, audit + "R")

    go(0, "", 0, "")
    return min(found)


def test_parse_is_the_cheapest():
    rng = random.Random(1)
    for _ in range(150):
        turns = "".join(rng.choice("ssuuuaaaxSUAX-") for _ in range(rng.randint(0, 6)))
        cost, audit = parse(turns)
        assert (cost, audit) == brute(turns, cost), turns


def random_rows(rng, conversations, turns):
    rows = []
    for c in conversations:
        for t in range(turns):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t", None, "Why?  \n", "x" * 50 + "."])
            rows.append((c, rng.choice([t, t, None, t // 2, 40 * t]), role, text, "old", 1, 2))
    return rows


def expected(rows):
    """report and digest of each conversation by plain steps"""
    out, groups = {}, {}
    for c, turn, role, text, *_ in rows:
        groups.setdefault(c, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    for c, some in groups.items():
        some.sort()
        seen, faults = set(), []
        for _, _, role, text in some:
            bare = text.rstrip(" \t\n\v\f\r")
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        initials = [r[:1] if r[:1] in ("s", "u", "a") else "x" for _, _, r, _ in some]
        turns = "".join(
            "-" if f in ("blank", "duplicate") else i.upper() if f else i for i, f in zip(initials, faults)
        )
        cost, audit = parse(turns)
        lines = [
            f"{role or some[turn][2]}:{some[turn][3] if edit != 'I' else ''}"
            for turn, _, edit, role in edits(audit)
            if edit != "D"
        ]
        times = [t for known, t, _, _ in some if known]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, *counts, illegal, cost, audit, sha)
    return out


@pytest.mark.parametrize("block_bits", [1, 3, 10])
def test_repair(spark, block_bits):
    """Blocks of two turns take the way of long conversations, which must not change anything."""
    rng = random.Random(block_bits)
    rows = random_rows(rng, [1, 2, None, 7], 7) + random_rows(rng, [9], 40)
    rows += rows[:5]
    done = repair(spark.createDataFrame(rows, TURNS), block_bits)
    sums = {r.conv_id: r.repaired_sha256 for r in digest(done.repaired, block_bits).collect()}
    none = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (*tuple(r)[1:], sums.get(r.conv_id, none)) for r in done.report.collect()}
    assert got == expected(rows)
    repaired = done.repaired.orderBy("at", "place").collect()
    for c in got:
        assert VALID.fullmatch("".join(r.role[0] for r in repaired if r.conv_id == c))
        assert "".join(r.edit for r in repaired if r.conv_id == c) == got[c][-2].replace("D", "")


def test_a_long_conversation_is_parsed_in_blocks(spark):
    rows = [(3, t, "user" if t % 2 else "assistant", f"{t}.", "", 0, 0) for t in range(5000)]
    done = repair(spark.createDataFrame(rows, TURNS))
    (row,) = done.report.collect()
    assert (row.cost, row.audit) == (2 + 2, "D" + "K" * 4998 + "D")
    assert done.repaired.count() == 4998


def test_dropped_conversations_and_empty_tables(spark):
    rows = [(c, t, "user", "Hm. ", "", 0, 0) for c in range(40) for t in range(2)] + [(None, None, None, None, None, 0, 0)]
    turns = spark.createDataFrame(rows, TURNS)
    damaged = damage(turns)
    out = {r.conv_id: r for r in repair_report(damaged, turns).collect()}
    assert len(out) == 41
    left = {r.conv_id for r in damaged.collect()}
    for c, r in out.items():
        if c not in left:
            assert (r.cost, r.audit, r.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    empty = repair_report(turns.filter("false"), turns.filter("false"))
    assert empty.collect() == [] and repair(turns.filter("false")).edits.collect() == []
