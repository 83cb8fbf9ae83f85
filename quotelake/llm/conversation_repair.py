"""Conversation structure repair with a persistent audit of edits.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Rows are
kept, given another role, or deleted, and empty turns inserted, at the least
cost; among equally cheap edits the audit (their initials in order) that is
least in ASCII wins. A dynamic program goes through the rows and keeps, for each
of the four states of that pattern, the best audit so far. Audits are linked
nodes that share their prefixes; a node holds its depth, a rolling hash and a
jump to an ancestor (binary lifting in the skew form, one jump a node), so two
audits are compared by a search for their longest common prefix.

Only fixed-size facts of a row go to the program: a conversation passes through
one task as a stream, whose memory is about 80 bytes a row. Texts meet their
edits afterwards, dealt by row.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.llm.common import BLANKS, staged

NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired turns end with
RETITLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5  # costs; Keep costs nothing
LEGAL_PAIRS = ("su", "ua", "au")
MODULUS, BASE = (1 << 61) - 1, 1_000_003
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class Audits:
    """Edit sequences as nodes of a tree; node 0 is the empty sequence."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.parent, self.jump, self.depth = array("q", [0]), array("q", [0]), array("q", [0])
        self.hash, self.edit = array("Q", [0]), bytearray(1)

    def extend(self, node: int, edit: str) -> int:
        """The node of the sequence at ``node`` and one more edit."""
        near = self.jump[node]
        far = self.jump[near]
        level = self.depth[node] - self.depth[near] == self.depth[near] - self.depth[far]
        self.parent.append(node)
        self.jump.append(far if level else node)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(edit)) % self.modulus)
        self.edit.append(ord(edit))
        return len(self.parent) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            jump = self.jump[node]
            node = jump if self.depth[jump] >= depth else self.parent[node]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the sequence at ``a`` comes before the one at ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            first = self._difference(x, y)
            if first is None:
                return self.depth[a] < self.depth[b]
            return first
        up, jump, seen = self.parent, self.jump, self.hash
        while True:
            if seen[jump[x]] != seen[jump[y]]:
                x, y = jump[x], jump[y]
            elif seen[up[x]] != seen[up[y]]:
                x, y = up[x], up[y]
            else:
                break
        # Equal hashes of different nodes are no proof: the prefixes are compared.
        first = self._difference(up[x], up[y])
        return self.edit[x] < self.edit[y] if first is None else first

    def _difference(self, x: int, y: int) -> bool | None:
        """Whether x is less at the first difference; None if there is none.

        Sequences that share their prefix meet at once, so this walk is short
        unless hashes collide.
        """
        first = None
        while x != y:
            if self.edit[x] != self.edit[y]:
                first = self.edit[x] < self.edit[y]
            x, y = self.parent[x], self.parent[y]
        return first

    def edits(self, node: int) -> str:
        out = bytearray()
        while node:
            out.append(self.edit[node])
            node = self.parent[node]
        return out[::-1].decode()


class Repair:
    """The cheapest edits of one conversation, row by row."""

    def __init__(self, modulus: int = MODULUS):
        self.audits = Audits(modulus)
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self._insert()

    def _choose(self, offers: list[tuple[int, int, str]]) -> tuple[int, int] | None:
        """The best of (cost, node, edit), where no edit stands for the node itself."""
        if not offers:
            return None
        cost = min(offer[0] for offer in offers)
        chosen = None
        for _, node, edit in (offer for offer in offers if offer[0] == cost):
            node = self.audits.extend(node, edit) if edit else node
            if chosen is None or self.audits.less(node, chosen):
                chosen = node
        return cost, chosen

    def _insert(self) -> None:
        for state, sources in ((USER, (NOTHING, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            offers = [(*self.best[state], "")] if self.best[state] else []
            offers += [
                (self.best[s][0] + INSERT, self.best[s][1], "I") for s in sources if self.best[s]
            ]
            self.best[state] = self._choose(offers)

    def add(self, initial: str, must_go: bool, unfinished: bool) -> None:
        """The next row: its role's initial, whether it has to be deleted, or ends early."""
        offers: list[list[tuple[int, int, str]]] = [[], [], [], []]
        late = UNFINISHED if unfinished else 0
        for state, best in enumerate(self.best):
            if best is None:
                continue
            cost, node = best
            offers[state].append((cost + DELETE, node, "D"))
            if must_go:
                continue
            after = ASSISTANT if state == USER else USER
            offers[after].append((cost + late + RETITLE, node, "R"))
            if initial == ("a" if state == USER else "u"):
                offers[after].append((cost + late, node, "K"))
            if state == NOTHING and initial == "s":
                offers[SYSTEM].append((cost + late, node, "K"))
        self.best = [self._choose(found) for found in offers]
        self._insert()

    def finish(self) -> tuple[int, str]:
        """Cost and audit of the cheapest legal repair."""
        ends = [(*self.best[s], "") for s in (NOTHING, ASSISTANT) if self.best[s]]
        cost, node = self._choose(ends)
        return cost, self.audits.edits(node)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Conversation:
    """Facts of one conversation, gathered in the order of its rows."""

    def __init__(self, conv_id):
        self.conv_id, self.repair = conv_id, Repair()
        self.rows, self.initials = array("q"), []
        self.seen: set[bytes] = set()
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, row, initial, blank, cut, digest) -> None:
        again = digest in self.seen
        self.seen.add(digest)
        fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        if self.initials and self.initials[-1] + initial not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.rows.append(row)
        self.initials.append(initial)
        self.repair.add(initial, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self):
        """One row of counts, then one row for each turn of the repaired conversation."""
        cost, audit = self.repair.finish()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        counts = self.counts | {"gaps": gaps, "cost": cost}
        yield {"conv_id": self.conv_id, "audit": audit, **counts}
        at, last, pos = 0, "", 0
        for edit in audit:
            expected = "assistant" if last == "u" else "user"
            if edit == "D":
                at += 1
                continue
            row = {"conv_id": self.conv_id, "pos": pos, "edit": edit}
            if edit == "K":
                last = self.initials[at]
            else:
                row["role"], last = expected, expected[0]
            if edit != "I":
                row["row_id"] = self.rows[at]
                at += 1
            pos += 1
            yield row


def _batches(rows, schema: pa.Schema, size: int = 4096):
    found = []
    for row in rows:
        found.append(row)
        if len(found) == size:
            yield pa.RecordBatch.from_pylist(found, schema=schema)
            found = []
    if found:
        yield pa.RecordBatch.from_pylist(found, schema=schema)


def _audited(facts: DataFrame) -> DataFrame:
    kind = facts.schema["conv_id"].dataType
    spark_schema = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("audit", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in (*COUNTS, "pos", "row_id")]
        + [T.StructField("edit", T.StringType()), T.StructField("role", T.StringType())]
    )

    def run(source):
        schema = None

        def rows():
            nonlocal schema
            open_one = None
            for batch in source:
                if schema is None:
                    long, text = pa.int64(), pa.string()
                    schema = pa.schema(
                        [("conv_id", batch.schema.field("conv_id").type), ("audit", text)]
                        + [(c, long) for c in (*COUNTS, "pos", "row_id")]
                        + [("edit", text), ("role", text)]
                    )
                for conv_id, *row in zip(*(column.to_pylist() for column in batch.columns)):
                    if open_one is None or open_one.conv_id != conv_id:
                        if open_one is not None:
                            yield from open_one.result()
                        open_one = _Conversation(conv_id)
                    open_one.add(*row)
            if open_one is not None:
                yield from open_one.result()

        # The schema is known once the first row has been read.
        stream = rows()
        first = next(stream, None)
        if first is not None:
            def again():
                yield first
                yield from stream

            yield from _batches(again(), schema)

    return facts.mapInArrow(run, spark_schema)


def ordered_facts(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, row_id, initial, blank, cut, digest) of rows with a row_id, in order.

    Order: turn, nulls first; rows of one turn by role, then by the digest of role
    and text (so equal rows are neighbours), then by row_id.
    """
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    size = F.octet_length("role").cast("string")
    digest = F.md5(F.concat(size, F.lit(":"), "role", "text").cast("binary"))
    facts = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "row_id",
        F.left("role", F.lit(1)).alias("initial"),
        (stripped == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(digest).alias("digest"),
        "role",
    )
    return (
        facts.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest", "row_id")
        .drop("role")
    )


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, turns) of all conversations in (conv_id, turn, role, text).

    ``audits`` has a row per conv_id: gaps in its turn numbers, rows that are blank
    (no character but white space), duplicate (role and text of an earlier row) or
    truncated (last character not ``.!?``), each row counted once in that order;
    adjacent roles that are no legal pair; cost and audit of the cheapest repair.
    ``turns`` has the repaired rows: conv_id, pos from 0, edit (K, R or I), role, text.

    Null roles and texts read as one space, so such rows are blank or have a role
    that is never legal. Rows without conv_id are one conversation; rows without
    turn come first in theirs. Only the four columns are read. No rows, no result.
    """
    rows = staged(
        conversations.select(
            "conv_id",
            "turn",
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        ).withColumn("row_id", F.monotonically_increasing_id()),
        "conversation_rows",
    )
    found = staged(_audited(ordered_facts(rows)), "conversation_edits")
    audits = found.where(F.col("audit").isNotNull()).select("conv_id", *COUNTS, "audit")
    edits = found.where(F.col("edit").isNotNull()).select("conv_id", "pos", "edit", "role", "row_id")
    given = rows.select("row_id", F.col("role").alias("old_role"), "text")
    kept = edits.where(F.col("row_id").isNotNull()).join(given, "row_id")
    turns = kept.select(
        "conv_id", "pos", "edit", F.coalesce("role", "old_role").alias("role"), "text"
    ).unionByName(
        edits.where(F.col("row_id").isNull()).select(
            "conv_id", "pos", "edit", "role", F.lit("").alias("text")
        )
    )
    return audits, turns


def turn_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` of the repaired turns, joined by newlines.

    A conversation is hashed as it streams by, never held whole.
    """
    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = (
        turns.select("conv_id", "pos", line)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos")
    )
    kind = turns.schema["conv_id"].dataType
    spark_schema = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("sha256", T.StringType())]
    )

    def run(source):
        kind = open_one = digest = None
        for batch in source:
            kind = batch.schema.field("conv_id").type
            schema = pa.schema([("conv_id", kind), ("sha256", pa.string())])
            done = []
            for conv_id, _, text in zip(*(column.to_pylist() for column in batch.columns)):
                if digest is None or conv_id != open_one:
                    if digest is not None:
                        done.append({"conv_id": open_one, "sha256": digest.hexdigest()})
                    open_one, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(text.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if digest is not None:
            last = [{"conv_id": open_one, "sha256": digest.hexdigest()}]
            yield pa.RecordBatch.from_pylist(last, schema=schema)

    return ordered.mapInArrow(run, spark_schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows broken by the CRC of ``conv_id:turn`` modulo 20; nulls read as one space.

    0 drops a row, 1 empties its text, 2 removes the ends of its sentences, 3
    repeats it, 4 gives it to the user.
    """

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind"))
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.where(F.col("kind") != 0)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(shown("role")).alias("role"),
            F.when(F.col("kind") == 1, "")
            .when(F.col("kind") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))),
        )
        .drop("col")
    )
