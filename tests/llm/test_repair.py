"""Conversation repair against all edit sequences, colliding hashes and edge rows."""

import hashlib
import random
import zlib

import pytest
from quotelake.llm.conversation_repair import (
    EMPTY_HASH,
    Audits,
    Repair,
    damaged,
    repair_conversations,
    turn_hashes,
)

ROWS = "conv_id long, turn long, role string, text string, pos string, row_id long"


def all_repairs(rows, at=0, state="n", inserts=2):
    """(cost, audit) of every legal repair with at most two inserts between rows."""
    if at == len(rows) and state in "na":
        yield 0, ""
    if inserts:
        for cost, audit in all_repairs(rows, at, "a" if state == "u" else "u", inserts - 1):
            yield cost + 5, "I" + audit
    if at < len(rows):
        initial, must_go, cut = rows[at]
        for cost, audit in all_repairs(rows, at + 1, state):
            yield cost + 2, "D" + audit
        if not must_go:
            late, after = 5 * cut, "a" if state == "u" else "u"
            for cost, audit in all_repairs(rows, at + 1, after):
                yield cost + late + 1, "R" + audit
            if initial == after or (initial == "s" and state == "n"):
                for cost, audit in all_repairs(rows, at + 1, initial):
                    yield cost + late, "K" + audit


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 2])
def test_repair_is_the_least_of_all_repairs(modulus):
    """Also with hashes modulo 2, which collide all the time."""
    rng = random.Random(7)
    for _ in range(150):
        rows = [
            (rng.choice("suauat"), rng.random() < 0.15, rng.random() < 0.15)
            for _ in range(rng.randrange(5))
        ]
        repair = Repair(modulus)
        for row in rows:
            repair.add(*row)
        assert repair.finish() == min(all_repairs(rows)), rows


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3])
def test_audits_compare_as_text(modulus):
    rng, audits = random.Random(3), Audits(modulus)
    texts = {0: ""}
    for _ in range(400):
        node = rng.choice(list(texts)[-12:])
        text = texts[node] + rng.choice("DIKR")
        if text not in texts.values():
            texts[audits.extend(node, text[-1])] = text
    nodes = list(texts)
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert audits.less(a, b) == (texts[a] < texts[b])
        assert audits.edits(a) == texts[a]


def frame(spark, *rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], ROWS)


def repaired(spark, *rows):
    audits, turns = repair_conversations(frame(spark, *rows))
    said = {}
    for row in turns.orderBy("conv_id", "pos").collect():
        said.setdefault(row.conv_id, []).append((row.role, row.text))
    assert {r.conv_id: r.sha256 for r in turn_hashes(turns).collect()} == {
        c: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in s).encode()).hexdigest()
        for c, s in said.items()
    }
    return {r.conv_id: r for r in audits.collect()}, said


def test_repair_edges(spark):
    long = "word " * 40_000 + "end."
    audits, said = repaired(
        spark,
        (1, 0, "user", None),
        (1, 1, None, "a role is missing."),
        (1, 1, None, "a role is missing."),
        (2, 5, "system", "be kind."),
        (2, 9, "assistant", long),
        (None, None, "user", "no id."),
        (None, 3, "assistant", "an answer"),
        (3, 0, "user", " \t\n"),
        (4, None, "user", "later?"),
        (4, None, "user", "earlier?"),
        (5, 0, "system", "alone."),
    )
    assert (audits[1].blank, audits[1].duplicate, audits[1].audit) == (1, 1, "DDD")
    assert audits[1].illegal == 2 and audits[1].cost == 6
    assert (audits[2].gaps, audits[2].audit, audits[2].cost) == (3, "RK", 1)
    assert said[2] == [("user", "be kind."), ("assistant", long)]
    assert (audits[None].gaps, audits[None].truncated, audits[None].audit) == (0, 1, "DD")
    assert (audits[3].audit, audits[4].audit, audits[5].audit) == ("D", "KR", "D")
    assert audits[4].gaps == 0 and [role for role, _ in said[4]] == ["user", "assistant"]
    assert set(said) == {2, 4}


def test_repair_inserts_turns_and_keeps_long_texts(spark):
    long = "word " * 40_000 + "end."
    turns = [(7, i, "user" if i % 2 else "assistant", f"{long}{i}.") for i in range(7)]
    audits, said = repaired(spark, *turns)
    assert audits[7].audit == "DKKKKKK" and audits[7].cost == 2
    assert [text for _, text in said[7]] == [text for *_, text in turns[1:]]


def test_repair_of_a_long_conversation(spark):
    rows = [(1, i, "user", f"question {i}?") for i in range(20_000)] + [(2, 0, "user", "hello.")]
    audits, said = repaired(spark, *rows)
    assert audits[1].audit == "KR" * 10_000 and audits[1].cost == 10_000
    assert len(said[1]) == 20_000 and audits[2].audit == "D"


def test_repair_of_no_rows(spark):
    audits, turns = repair_conversations(frame(spark))
    assert audits.count() == turns.count() == turn_hashes(turns).count() == 0
    assert damaged(frame(spark)).count() == 0


def test_query_names_conversations_without_rows(spark, tmp_path):
    from quotelake.llm.queries import QUERIES

    rows = [(i, 0, "user", "one row each.") for i in range(60)] + [(None, None, None, None)]
    frame(spark, *rows).write.parquet(f"{tmp_path}/conversations.parquet")
    left = {r.conv_id for r in damaged(frame(spark, *rows)).select("conv_id").collect()}
    found = QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()
    assert len(found) == 61 and any(r.conv_id not in left for r in found)
    for r in found:
        assert r.conv_id in left or (r.audit, r.cost) == ("", 0)
        assert r.repaired_sha256 == EMPTY_HASH


def test_damage_of_rows(spark):
    rows = [(i, 1, "assistant", "One. Two! Three?") for i in range(400)]
    kinds = {i: zlib.crc32(f"{i}:1".encode()) % 20 for i in range(400)}
    found = {}
    for r in damaged(frame(spark, *rows)).collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    for i, k in kinds.items():
        whole = ("assistant", "One. Two! Three?")
        expected = {
            0: None,
            1: [("assistant", "")],
            2: [("assistant", "One Two Three")],
            3: [whole, whole],
            4: [("user", whole[1])],
        }
        assert found.get(i) == expected.get(k, [whole])
