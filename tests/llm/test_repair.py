"""Conversation repair: against every way to edit short conversations, and a plain search of whole audits."""

import random

import pytest
from pyspark.sql import functions as F

from nearkin.llm import repair

from . import definitions

SCHEMA = "conv_id long, turn long, role string, text string"
FAULTS = {None: repair.FINE, "truncated": repair.CUT, "blank": repair.BLANK, "duplicate": repair.DUPLICATE}


def code(role, fault):
    return repair.code_of(role[:1] if role[:1] in ("s", "u", "a") else "x", FAULTS[fault])


def searched(rows):
    search, found = repair.Search(), []
    for role, fault in rows:
        found += search.step(code(role, fault))
    cost, rest, letters, _ = search.finish()
    return cost, "".join(x for x, _ in found + rest) + letters


@pytest.mark.parametrize("seed", range(12))
def test_every_way_to_edit_short_conversations(seed):
    rng = random.Random(seed)
    for _ in range(25):
        rows = [
            (rng.choice(["user", "assistant", "system", "tool", "uncle", ""]), rng.choice([None, None, None, "truncated", "blank", "duplicate"]))
            for _ in range(rng.randrange(4))
        ]
        assert searched(rows) == min(definitions.all_edits(rows))


def open_rows(rows):
    """The most rows that a search holds back at one time."""
    search, held, most = repair.Search(), 0, 0
    for role, fault in rows:
        held += 1 - len(list(search.step(code(role, fault))))
        most = max(most, held)
    return most


def test_memory_is_bound_by_what_is_undecided():
    rng = random.Random(5)
    legal = [("user" if i % 2 == 0 else "assistant", None) for i in range(20_000)]
    noisy = [(rng.choice(["user", "assistant", "tool"]), rng.choice([None, None, "truncated", "blank"])) for _ in range(20_000)]
    assert open_rows(legal) < 10
    assert open_rows(noisy) < 200
    search = repair.Search()
    for role, fault in legal:
        list(search.step(code(role, fault)))
    seen, todo = 0, [search.root]
    while todo:
        node = todo.pop()
        seen += 1
        todo += node.refs
    assert seen < 20


def checked(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("clash")).withColumn("mark", F.lit(1))
    got = {r.conv_id: tuple(r)[1:] for r in repair.summary(frame, frame).collect()}
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: definitions.repair(own) for conv, own in convs.items()}
    return frame


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", "", None]) if rng.random() < 0.1 else role
            text = rng.choice(["Yes.", "No!", "why", "  ", "", None, "Ah? \n", "long. but", "\u00a0"]) if rng.random() < 0.6 else f"t{conv} {turn}."
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn + (turn > 4) * 3, role, text))
    return rows


@pytest.mark.parametrize("chunk_bits", [12, 1])
def test_matches_the_definition(spark, monkeypatch, chunk_bits):
    monkeypatch.setattr(repair, "CHUNK_BITS", chunk_bits)
    rows = conversations(chunk_bits, 120)
    frame = checked(spark, rows)
    got = {}
    for r in repair.repaired(frame).collect():
        got.setdefault(r.conv_id, []).append((r.place, r.nth, r.edit, r.role, r.text))
    for own in got.values():
        initials = "".join(role[:1] for _, _, _, role, _ in sorted(own))
        initials = initials[1:] if initials.startswith("s") else initials
        assert initials and initials == "ua" * (len(initials) // 2)
        assert all(text == "" for _, _, edit, _, text in own if edit == "I")


def test_ties_repeated_rows_and_long_conversations(spark):
    rows = [(1, 0, "user", "same."), (1, 0, "user", "same."), (1, 0, "assistant", "same."), (1, None, "assistant", "first."), (1, None, "user", "first?")]
    rows += [(2, i, ("user", "assistant")[i % 2], f"{i} " + "x" * 50 + ".") for i in range(9_000)]
    rows += [(3, 7, "user", "again.")] * 6_000 + [(4, -5, "user", "a" * 100_000 + "."), (4, 5, "assistant", "b.")]
    checked(spark, rows)


def test_damage_matches_the_definition(spark):
    rows = conversations(9, 60)
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(definitions.damage(rows), key=repr)


def test_conversations_without_rows_and_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.summary(empty, empty).count() == 0
    assert repair.repaired(empty).count() == 0
    (row,) = repair.summary(empty, spark.createDataFrame([(5,), (5,)], "conv_id long")).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", definitions.hashlib.sha256(b"").hexdigest())


def test_registered_query_matches_the_definition(spark):
    from nearkin.llm import queries

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    convs = {conv: [] for conv, *_ in rows}
    for conv, *rest in definitions.damage(rows):
        convs[conv].append(tuple(rest))
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_repair(spark, folder).collect()}
    assert got == {conv: definitions.repair(own) for conv, own in convs.items()}
