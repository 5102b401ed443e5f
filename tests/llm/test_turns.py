"""Repair of conversations, held against a plain search over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from parallax.llm import turns
from parallax.llm.common import Scratch

GOOD = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, audit string, k int"


def damaged(rows):
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d:
            text = "" if d == 1 else re.sub(r"[.!?]", "", text) if d == 2 else text
            yield from [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)


def brute(rows):
    """What is found in one conversation's damaged rows, and its cheapest repair, searched forward."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserts(states):
        todo = list(states.items())
        while todo:
            at, (cost, audit, out) = todo.pop()
            for role in ("user", "assistant"):
                if to := go.get((at, role[0])):
                    new = (cost + 5, audit + "I", (*out, role + ":"))
                    if to not in states or new < states[to]:
                        states[to] = new
                        todo.append((to, new))
        return states

    states = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}

        def add(to, way):
            if to is not None and (to not in after or way < after[to]):
                after[to] = way

        for at, (cost, audit, out) in inserts(states).items():
            add(at, (cost + 2, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                add(go.get((at, role[:1])), (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    add(go.get((at, name[0])), (cost + 1 + more, audit + "R", (*out, f"{name}:{text}")))
        states = after
    cost, audit, out = min(v for k, v in inserts(states).items() if k in ("", "a"))
    assert GOOD.match("".join(x[0] for x in out))
    given = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return {
        "gaps": max(given) - min(given) + 1 - len(set(given)) if given else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def table(seed, conversations, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Yes. ", "a.b", "Grüße.", None, "odd\u0085", "end.\t"]
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "User", "", None, "umpire"]
    rows = []
    for conv in [*range(conversations), None]:
        n = draw.randint(1, longest)
        odd = draw.random() < 0.3  # roles that can't be kept, or texts that are all cut short
        for k in range(n):
            role = draw.choice(roles) if draw.random() < 0.4 else ("user", "assistant")[k % 2]
            text = draw.choice(texts) if draw.random() < 0.6 else f"{draw.randint(0, 10**6)}."
            rows.append((conv, draw.choice([k, k, k, k // 2, None, k + 3]), "tool" if odd else role, text))
    return rows


def expected(rows):
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    return {conv: brute(own) for conv, own in by.items()}


@pytest.mark.parametrize("chunk, longest", [(3, 60), (1024, 12)])
def test_repair(spark, chunk, longest):
    rows = table(chunk, 60, longest)
    rows += rows[:20]  # repeated rows
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = {r["conv_id"]: r.asDict() for r in turns.repair_damaged(frame, Scratch(spark, "test"), chunk).collect()}
    want = expected(rows)
    assert got == {conv: {"conv_id": conv, **w} for conv, w in want.items()}


def test_repaired_rows(spark):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Hi."), (2, 0, "tool", "x"), (3, 0, "user", " ")]
    done = turns.Repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), Scratch(spark, "test"), 2)
    got = sorted(tuple(r) for r in done.turns().collect())
    assert got == [(1, 1, "system", "Be kind.", "K"), (1, 2, "user", "Hello.", "R"), (1, 3, "assistant", "Hi.", "R")]
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in done.summary.collect()} == {1: (2, "KRR"), 2: (2, "D"), 3: (2, "D")}


def test_empty_and_one_hot_conversation(spark):
    empty = turns.repair_damaged(spark.createDataFrame([], SCHEMA), Scratch(spark, "test"))
    assert empty.count() == 0
    rows = [(7, k, ("user", "assistant")[k % 2] if k % 97 else "tool", f"{k % 1500}.") for k in range(6000)] + [(8, 1, "user", "Hi there.")]
    got = {r["conv_id"]: r.asDict() for r in turns.repair_damaged(spark.createDataFrame(rows, SCHEMA[:49]), Scratch(spark, "test"), 64).collect()}
    assert got == {conv: {"conv_id": conv, **w} for conv, w in expected(rows).items()}


def test_chunks_that_never_converge_take_few_passes(spark, monkeypatch):
    scratch, names = Scratch(spark, "test"), []
    save = scratch.save
    monkeypatch.setattr(scratch, "save", lambda df, name, **more: (names.append(name), save(df, name, **more))[1])
    rows = [(1, k, "tool", f"text {k}.") for k in range(2001)]  # what a row costs depends on the parity of the rest
    got = turns.Repaired(spark.createDataFrame(rows, SCHEMA[:49]), scratch, 8).summary.first()
    assert (got["cost"], got["audit"]) == (2002, "D" + 2000 * "R") and sum(n.startswith("pass") for n in names) <= 4


def test_a_run_stops_where_it_meets_the_former_one():
    draw = random.Random(3)
    for _ in range(300):
        codes = bytes(draw.randrange(16) for _ in range(draw.randint(1, 40)))
        old, new = draw.randrange(len(turns.CLASSES)), draw.randrange(len(turns.CLASSES))
        left, total = turns.first_run(codes, old)
        again, change = turns.run_again(codes, old, new)
        assert (left if again is None else again, total + change) == turns.first_run(codes, new)
