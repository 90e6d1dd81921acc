"""Conversation repair against plain search, and the query against a computation without a grammar."""

import hashlib
import itertools
import random
import re
import zlib

from tideline.llm import queries, repair

LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of each (turn, role, text), in order."""
    seen, found = set(), []
    for _, role, text in rows:
        ending = text.rstrip(SPACE)
        if not ending:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("sound" if ending[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def searched(rows):
    """Cost, audit and rows of the cheapest repair: every state after every row, insertions one by one."""
    found = faults(rows)
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def widened(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                role = "assistant" if state == "u" else "user"
                way = (cost + 5, audit + "I", [*out, f"{role}:"])
                if role[0] not in best or way[:2] < best[role[0]][:2]:
                    best[role[0]] = way
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, found):
        following: dict = {}

        def offer(state, way):
            if state not in following or way[:2] < following[state][:2]:
                following[state] = way

        for state, (cost, audit, out) in widened(best).items():
            offer(state, (cost + 2, audit + "D", out))
            if fault in ("sound", "truncated"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in after[state]:
                    offer(role[:1], (cost + more, audit + "K", [*out, f"{role}:{text}"]))
                for name in ("user", "assistant"):
                    if name[0] in after[state]:
                        offer(name[0], (cost + more + 1, audit + "R", [*out, f"{name}:{text}"]))
        best = following
    final = [way for state, way in widened(best).items() if state in ("", "a")]
    return min(final, key=lambda way: way[:2])


def enumerated(rows, inserts=2):
    """The same by trying every string of edits."""
    found, best = faults(rows), None
    for extra in range(inserts + 1):
        for where in itertools.combinations_with_replacement(range(len(rows) + 1), extra):
            for edits in itertools.product("DKR", repeat=len(rows)):
                cost, audit, choices = 5 * extra, "", []
                for k in range(len(rows) + 1):
                    audit += "I" * where.count(k)
                    choices += ["ua"] * where.count(k)
                    if k == len(rows):
                        break
                    audit += edits[k]
                    if edits[k] == "D":
                        cost += 2
                        continue
                    cost += (100 if found[k] in ("blank", "duplicate") else 5 if found[k] == "truncated" else 0) + (edits[k] == "R")
                    choices.append(rows[k][1][:1] or "-" if edits[k] == "K" else "ua")
                if any(LEGAL.fullmatch("".join(roles)) for roles in itertools.product(*choices)):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def summary(rows):
    found = faults(rows)
    cost, audit, out = searched(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def ordered(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


ROLES = ["system", "user", "assistant", "tool", "", None]
TEXTS = ["Fine.", "Why?", "broken", "cut \n", "", " \t", None, "é!", "Yes. \n"]


def conversations(n, chance, longest=12):
    return {
        i: [(chance.choice([None, 0, 1, 2, 3, 4, 7]), chance.choice(ROLES[: 3 + i % 4]), chance.choice(TEXTS)) for _ in range(chance.randint(1, longest))]
        for i in range(n)
    }


def test_search_against_every_string_of_edits():
    for rows in conversations(60, random.Random(4), 4).values():
        rows = ordered(rows)
        assert searched(rows)[:2] == enumerated(rows)


def whole(spark, made):
    rows = [(i, t, r, x, "other") for i, said in made.items() for t, r, x in said]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(5)
    report = repair.repair_conversations(df)
    repaired = repair.repaired_rows(df, report)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.repaired_digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: (*tuple(r)[1:], digests.get(r["conv_id"], empty)) for r in report.collect()}


def test_repair_against_search(spark, monkeypatch):
    made = conversations(400, random.Random(5))
    made[None] = [(1, "user", "Hm."), (None, "assistant", "Hm."), (2, "assistant", "Well.")]
    want = {i: summary(ordered(rows)) for i, rows in made.items()}
    assert whole(spark, made) == want
    monkeypatch.setattr(repair, "BLOCK_ROWS", 3)
    assert whole(spark, made) == want


def test_a_long_conversation(spark):
    chance = random.Random(6)
    rows = [(t, chance.choice(ROLES[:4]), chance.choice(["Fine.", "broken", ""]) + chance.choice(["", f"{t}."])) for t in range(9_000)]
    found = whole(spark, {1: rows, 2: rows[:5]})
    assert found == {1: summary(ordered(rows)), 2: summary(ordered(rows[:5]))}


def test_rules_shorten_blocks(spark):
    blocks = [bytes([4, 8] * 300), bytes([0] * 77), bytes([0]), bytes([4, 8, 8, 4] * 5)]
    rules = repair.learn(spark.createDataFrame([(b,) for b in blocks], "symbols binary"))
    short = repair.compressed(blocks, rules)
    assert (short == -1).sum() == 4 and len(short) < 60
    flat = {i: bytes([i]) for i in range(repair.SYMBOLS)} | {-1: b"\xff"}
    for chosen in rules:
        for a, b, symbol in chosen:
            flat[symbol] = flat[a] + flat[b]
    assert b"".join(flat[i] for i in short.tolist()) == b"".join(b + b"\xff" for b in blocks)


def test_query_against_search(spark, folder):
    found = queries.op13_conversation_repair(spark, folder)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    made: dict = {}
    for conv_id, turn, role, text in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        said = made.setdefault(conv_id, [])
        kind = zlib.crc32(f"{conv_id}:{turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            said += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {i: summary(ordered(rows)) for i, rows in made.items()}


def test_nothing_left_and_empty(spark):
    lost = next(i for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(lost, 0, "user", "Hm.")], "conv_id long, turn long, role string, text string")
    assert tuple(repair.repair_digests(rows).first()) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair_digests(rows.filter("false")).count() == 0
