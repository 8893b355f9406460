import hashlib
import itertools
import random
import zlib
from functools import reduce

import pytest
from pyspark.sql import functions as F

from quarrylog.llm import conversations as c

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """rows: (conv, turn, role, text) in order. What the contract's faults leave of them."""
    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(x for x in text if x not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "ok")
        seen.add((role, text))
    return out


LEGAL = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows, kinds):
    """Turn by turn, the least (cost, audit) for each last role: no matrices."""
    def inserts(at):
        for _ in range(4):
            for last, (cost, audit, out) in list(at.items()):
                for role in ("user", "assistant"):
                    if role[0] in LEGAL[last]:
                        new = (cost + 5, audit + "I", [*out, f"{role}:"])
                        if role[0] not in at or new[:2] < at[role[0]][:2]:
                            at[role[0]] = new
        return at

    at = inserts({"": (0, "", [])})
    for (_, _, role, text), kind in zip(rows, kinds, strict=True):
        new = {}

        def offer(last, item, new=new):
            if last not in new or item[:2] < new[last][:2]:
                new[last] = item

        for last, (cost, audit, out) in at.items():
            offer(last, (cost + 2, audit + "D", out))
            if kind in ("ok", "truncated"):
                more = 5 * (kind == "truncated")
                if role[:1] and role[0] in LEGAL[last]:
                    offer(role[0], (cost + more, audit + "K", [*out, f"{role}:{text}"]))
                for r in ("user", "assistant"):
                    if r[0] in LEGAL[last]:
                        offer(r[0], (cost + more + 1, audit + "R", [*out, f"{r}:{text}"]))
        at = inserts(new)
    return min((at[x] for x in ("", "a") if x in at), key=lambda x: x[:2])


def expected(rows):
    kinds = faults(rows)
    cost, audit, out = cheapest(rows, kinds)
    turns = [t for _, t, _, _ in rows if t is not None]
    roles = [r[:1] for _, _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": kinds.count("blank"), "duplicate": kinds.count("duplicate"), "truncated": kinds.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }, out


def groups(rows):
    """By conversation, then as the operator orders them: null turns first, then role and text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or " ", (r[3] or " ")[:32]))
    return {k: list(g) for k, g in itertools.groupby(order, key=lambda r: r[0])}


def run(spark, tmp_path, rows, schema="conv_id long, turn long, role string, text string"):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, schema).write.parquet(path + "/conversations.parquet")
    return {r.conv_id: r.asDict() for r in c.op13_conversation_repair(spark, path).collect()}


def check(got, rows):
    want = groups(rows)
    assert got.keys() == want.keys()
    for k, g in want.items():
        assert {n: v for n, v in got[k].items() if n != "conv_id"} == expected(damage(g))[0], k


def random_rows(seed, conversations=60, texts=("Yes.", "No!", "what", "", " \t", "Ok?\n", "thing", "Why. ", None), roles=("user", "assistant", "system", "tool", "", None)):
    rng = random.Random(seed)
    return [(k, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}.") for k in range(conversations) for t in sorted(rng.sample(range(40), rng.randrange(1, 14)))]


def test_matrix_against_all_edits():
    """Every audit with up to two insertions in a place, tried one by one."""
    rng = random.Random(1)
    for _ in range(25):
        rows = [(0, i, rng.choice(["user", "assistant", "system", "x"]), "") for i in range(rng.randrange(0, 4))]
        kinds = [rng.choice(["ok", "ok", "truncated", "blank"]) for _ in rows]
        found = None
        for edits in itertools.product("DKR", repeat=len(rows)):
            for places in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
                audit = places[0] + "".join(e + p for e, p in zip(edits, places[1:], strict=True))
                states, at, cost = {""}, 0, 0
                for e in audit:
                    if e == "I":
                        states, cost = {r for s in states for r in "ua" if r in LEGAL[s]}, cost + 5
                        continue
                    role, kind = rows[at][2], kinds[at]
                    at += 1
                    if e == "D":
                        cost += 2
                        continue
                    states = set() if kind == "blank" else {r for s in states for r in ("ua" if e == "R" else role[0]) if r in LEGAL[s]}
                    cost += (e == "R") + 5 * (kind == "truncated")
                if states & {"", "a"} and (found is None or (cost, audit) < found):
                    found = (cost, audit)
        letters = "".join(c.letter({"ok": 0, "truncated": 1, "blank": 2}[k], "sua".find(r[2][0]) % 4) for r, k in zip(rows, kinds, strict=True))
        assert c.best(c.span_matrix(letters)) == found


def test_product_is_associative():
    rng = random.Random(2)
    text = "".join(c.letter(rng.randrange(4), rng.randrange(4)) for _ in range(60))
    whole = reduce(c.times, map(c.turn_matrix, text), c.INSERTED)
    assert c.span_matrix(text) == whole
    for cut in range(0, 60, 7):
        assert c.times(c.span_matrix(text[:cut]), c.span_matrix(text[cut:])) == whole


def test_small_conversations(spark, tmp_path):
    rows = random_rows(3)
    check(run(spark, tmp_path, rows), rows)


@pytest.mark.parametrize("block, fan, part", [(3, 2, 7), (1, 3, 40)])
def test_conversations_over_blocks_and_partitions(spark, tmp_path, monkeypatch, block, fan, part):
    monkeypatch.setattr(c, "BLOCK", block)
    monkeypatch.setattr(c, "FAN", fan)
    monkeypatch.setattr(c, "PER_PARTITION", part)
    rows = random_rows(4, 12) + [(99, t, "user" if t % 2 == 0 else "assistant", ("Yes.", "again.", f"no {t}.")[t % 3]) for t in range(150)]
    check(run(spark, tmp_path, rows), rows)


def test_nulls_ties_long_texts_and_other_columns(spark, tmp_path):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "system", "S."), (1, None, "system", "S."), (1, 5, "assistant", "b."), (1, 5, "user", "a."), (2, 3, "user", "word " * 200_000 + "."), (2, 4, "assistant", "é" * 100_000), (3, 1 << 62, "user", "x."), (3, -(1 << 62), "user", "y.")]
    got = run(spark, tmp_path, [(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, cost int, kind string")
    check(got, rows)


def test_no_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}


def test_all_rows_dropped(spark, tmp_path):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = run(spark, tmp_path, [(gone, 0, "user", "a.")])[gone]
    assert got["audit"] == "" and got["cost"] == got["gaps"] == 0 and got["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repaired_turns(spark):
    rows = [(k, t, r, x) for k, t, r, x in random_rows(5, 20) if x is not None and r is not None]
    turns = c.prepared(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = c.repaired(turns, c.audits(turns)).orderBy("conv_id", "place").collect()
    for k, g in groups(rows).items():
        mine = [r for r in got if r.conv_id == k]
        assert [r.place for r in mine] == list(range(len(mine)))
        assert [f"{r.role}:{r.text}" for r in mine] == expected(g)[1]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check({r.conv_id: r.asDict() for r in c.op13_conversation_repair(spark, SF).collect()}, rows)
    assert spark.range(1).select(F.crc32(F.encode(F.lit("é"), "utf-8"))).first()[0] == zlib.crc32("é".encode())
