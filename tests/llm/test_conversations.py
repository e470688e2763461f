"""Repair of conversations against all sequences of edits, and against the SQL."""

import hashlib
import itertools
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from safetymart.llm import conversations as c
from safetymart.llm.queries import ORACLE_SQL

ROWS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
BODY = re.compile(r"[^\x20\x09-\x0D]")


def plain(rows):
    """Facts and the repair of one conversation, by trying out every sequence of edits."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    faults, seen = [], set()
    for _, role, text in rows:
        body = BODY.findall(text)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else None
        kind = kind or ("truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
        faults.append(kind)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    best = None
    edits = [["D"] if f in ("blank", "duplicate") else ["D", "K", "u", "a"] for f in faults]
    inserts = ["", "u", "a", "ua", "au"]
    for chosen in itertools.product(*edits):
        for extra in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, roles, lines = 0, "", "", []
            for i in range(len(rows) + 1):
                for r in extra[i]:
                    cost, audit, roles = cost + 2, audit + "I", roles + r
                    lines.append({"u": "user:", "a": "assistant:"}[r])
                if i == len(rows):
                    break
                _, role, text = rows[i]
                e = chosen[i]
                audit += e if e in "DK" else "R"
                cost += {"D": 3, "K": 0}.get(e, 2) + (e != "D" and faults[i] == "truncated")
                if e != "D":
                    name = role if e == "K" else {"u": "user", "a": "assistant"}[e]
                    roles += name[:1] or "?"
                    lines.append(f"{name}:{text}")
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(lines))
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    sha = hashlib.sha256(best[2].encode()).hexdigest()
    return (gaps, *counts, illegal, *best[:2], sha)


def test_every_sequence_of_edits(spark):
    rng = np.random.default_rng(3)
    roles = ["user", "assistant", "system", "tool", "", None, "u"]
    texts = ["Yes.", "No", " ", "", None, "a\nb!", "Sure?  \t", "é."]
    data = []
    for conv in range(60):
        for turn in range(int(rng.integers(1, 4))):
            t = None if rng.random() < 0.1 else int(turn + 3 * (rng.random() < 0.2))
            role = roles[rng.choice(7, p=[0.3, 0.3, 0.1, 0.1, 0.05, 0.1, 0.05])]
            data.append((conv, t, role, texts[rng.integers(len(texts))]))
    data += [(None, 0, "user", "Hi."), (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho")]
    table = spark.createDataFrame(data, ROWS).withColumn("part", F.lit(1)).withColumn("first", F.lit(2))
    for rows in (1, 4096):  # every row a segment, or whole conversations
        got = {r["conv_id"]: tuple(r)[1:] for r in c.repair(table, segment_rows=rows).collect()}
        assert len(got) == 61
        for conv, found in got.items():
            assert found == plain([r[1:] for r in data if r[0] == conv]), conv


def test_long_and_repeated(spark):
    """One conversation over many tasks and segments; one row a thousand times."""
    rows = [(7, i, "user" if i % 3 else "system", f"Text {i}{'.' * (i % 2)}") for i in range(600)]
    rows += [(8, 0, "user", "Again.")] * 1000 + [(9, i, "assistant", "Same.") for i in range(50)]
    table = spark.createDataFrame(rows, ROWS)
    pieces = c.repair(table, segment_rows=7)
    whole = {r["conv_id"]: r for r in c.repair(table.coalesce(1)).collect()}
    got = {r["conv_id"]: r for r in pieces.collect()}
    assert got == whole
    assert got[8]["duplicate"] == 999 and got[8]["audit"] == "K" + "D" * 999 + "I"
    assert got[9]["duplicate"] == 49 and got[9]["audit"] == "IK" + "D" * 49
    turns = c.repaired_turns(table, pieces)
    for conv, found in got.items():
        lines = sorted((r for r in turns.collect() if r["conv_id"] == conv), key=lambda r: r["place"])
        assert GRAMMAR.fullmatch("".join(r["role"][0] for r in lines))
        joined = "\n".join(f"{r['role']}:{r['text']}" for r in lines)
        assert hashlib.sha256(joined.encode()).hexdigest() == found["repaired_sha256"]
        assert "".join(r["edit"] for r in lines) == found["audit"].replace("D", "")


def test_damage_against_sql(spark):
    rng = np.random.default_rng(4)
    texts = ["Yes. No!", "cut", None, " ", "What?", "x" * 5000 + "."]
    rows = [(i // 6, None if rng.random() < 0.05 else i % 6, ["user", "assistant"][i % 2], texts[rng.integers(6)])
            for i in range(600)]
    rows += [(None, None, None, None), (1000, -3, "system", "S.")]
    table = spark.createDataFrame(rows, ROWS)
    got = c.repair(c.damaged(table), copies="copies")
    con = duckdb.connect()
    con.register("conversations", table.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    expected = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op13_conversation_repair']})")
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected.fetchall(), key=key)


def test_empty_table(spark):
    assert c.repair(spark.createDataFrame([], ROWS)).collect() == []
