"""Repair of conversation structure: cheapest edits to the role pattern (s?(ua)+)?, least audit among the cheapest.

A dynamic program over the rows of a conversation keeps, for each state of the pattern, the cheapest edits so far. Edit
sequences share their prefixes: each is a node linked to the node before it, with its ancestors at powers of two and a rolling
hash of all its edits. Two sequences of one cost are ordered by their first difference, found by binary lifting on
hashes; a node exists once for each sequence, so equal hashes are verified by the nodes being the same.

Conversations of bounded size are repaired one by one, as their rows stream by in order. Of a larger one, blocks of rows are solved
side by side for every state they may begin in, and a second program of the same kind chains the blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.bpe import text_slices
from waterline.llm.store import materialize

#: Conversations beyond so many rows or bytes of text are repaired in blocks of so many rows.
MOST_ROWS, MOST_BYTES, BLOCK_ROWS = 10_000, 64 << 20, 4_096
#: Larger conversations up to this many are named in a broadcast list; more are joined by shuffles.
MOST_NAMED = 100_000
#: Joins on a hash of a row's content are salted: all rows may be alike.
SALTS = 16

#: States of the pattern: nothing yet, after s, after u, after a. It may end in the first and the last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NOTHING, ASSISTANT)
#: The state that a user's or assistant's turn leads to.
SPOKEN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

BLANKS = " \t\n\x0b\x0c\r"
AUDIT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
TURNS = "conv_id bigint, part bigint, block bigint, place bigint, role string, text string"


class Row(NamedTuple):
    """What the program needs of a row. at: its place in a partition of a larger conversation."""

    turn: int | None
    initial: str
    blank: bool
    duplicate: bool
    truncated: bool
    at: int = 0


class Edits:
    """Sequences of labels (edits, or edits of a block) as nodes that share their prefixes. Node 0 is empty."""

    _PRIME = (1 << 61) - 1

    def __init__(self):
        self.label, self.hash = [""], [0]
        self.depth = [0]
        #: Ancestors 1, 2, 4, ... labels back.
        self.up: list[list[int]] = [[]]
        self._known: dict[tuple[int, str], int] = {}

    def add(self, node: int, label: str) -> int:
        found = self._known.get((node, label))
        if found is None:
            found = self._known[node, label] = len(self.label)
            self.label.append(label)
            self.hash.append((self.hash[node] * 1_000_003 + hash(label)) % self._PRIME)
            self.depth.append(self.depth[node] + 1)
            up, back = [node], node
            while len(self.up[back]) >= len(up):
                back = self.up[back][len(up) - 1]
                up.append(back)
            self.up.append(up)
        return found

    def _same(self, a: int, b: int) -> bool:
        return self.hash[a] == self.hash[b] and a == b

    def _back(self, node: int, labels: int) -> int:
        for k in range(labels.bit_length()):
            if labels >> k & 1:
                node = self.up[node][k]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether a's labels come before b's: by the first that differs, a prefix first."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._back(a, self.depth[a] - depth), self._back(b, self.depth[b] - depth)
        if self._same(x, y):
            return self.depth[a] < self.depth[b]
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and not self._same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.label[x] < self.label[y]

    def labels(self, node: int) -> list[str]:
        found = []
        while node:
            found.append(self.label[node])
            node = self.up[node][0]
        return found[::-1]


class _Layer(dict):
    """For each state the cost and node of the cheapest edits, of the least among those."""

    def __init__(self, edits: Edits):
        super().__init__()
        self.edits = edits

    def offer(self, state: int, cost: int, node: int, label: str) -> None:
        held = self.get(state)
        if held is None or cost <= held[0]:
            made = self.edits.add(node, label)
            if held is None or cost < held[0] or self.edits.less(made, held[1]):
                self[state] = (cost, made)

    def insert(self) -> None:
        """Insertions before the next row, two at most: more would only come back to the same states."""
        for _ in range(2):
            for state, (cost, node) in list(self.items()):
                self.offer(SPOKEN[state], cost + INSERT, node, "I")

    def row(self, row: Row) -> _Layer:
        """The layer after a row, without insertions behind it."""
        self.insert()
        after = _Layer(self.edits)
        kept = KEPT.get(row.initial, {})
        for state, (cost, node) in self.items():
            after.offer(state, cost + DELETE, node, "D")
            if not row.blank and not row.duplicate:
                cost += TRUNCATED * row.truncated
                after.offer(SPOKEN[state], cost + REROLE, node, "R")
                if state in kept:
                    after.offer(kept[state], cost, node, "K")
        return after


def solve(rows: Iterable[Row], start: int = NOTHING) -> dict[int, tuple[int, str]]:
    """Cost and audit of the cheapest edits of the rows, for each state after the last row."""
    edits = Edits()
    layer = _Layer(edits)
    layer[start] = (0, 0)
    for row in rows:
        layer = layer.row(row)
    return {state: (cost, "".join(edits.labels(node))) for state, (cost, node) in layer.items()}


def close(layer: _Layer) -> tuple[int, int]:
    """Cost and node of the cheapest edits that end the pattern."""
    layer.insert()
    best = [layer[s] for s in ENDS if s in layer]
    low = min(cost for cost, _ in best)
    nodes = [node for cost, node in best if cost == low]
    return low, nodes[0] if len(nodes) == 1 or layer.edits.less(*nodes) else nodes[1]


def cheapest(rows: Iterable[Row]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    edits = Edits()
    layer = _Layer(edits)
    layer[NOTHING] = (0, 0)
    for row in rows:
        layer = layer.row(row)
    cost, node = close(layer)
    return cost, "".join(edits.labels(node))


def apply(audit: str, turns: Iterable[tuple[str, str]], state: int = NOTHING) -> Iterator[tuple[str, str]]:
    """The repaired (role, text)s of a conversation's (role, text)s."""
    turns = iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[role[:1]][state]
        else:
            state = SPOKEN[state]
            role = "user" if state == USER else "assistant"
        yield role, text


class _Findings:
    """Counts over rows in order; those of later rows can be added."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, row: Row) -> None:
        self.blank += row.blank
        self.duplicate += row.duplicate
        self.truncated += row.truncated
        self.illegal += self.last is not None and self.last + row.initial not in LEGAL
        self.last = row.initial
        if self.first is None:
            self.first = row.initial
        if row.turn is not None:
            self.turns += row.turn != self.high
            self.low, self.high = row.turn if self.low is None else self.low, row.turn

    def join(self, blank, duplicate, truncated, illegal, turns, first, last, low, high) -> None:
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
        self.first, self.last = first if self.first is None else self.first, last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def counts(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _digest(turns: Iterable[tuple[str, str]]) -> str:
    seen, between = sha256(), ""
    for role, text in turns:
        seen.update(f"{between}{role}:{text}".encode())
        between = "\n"
    return seen.hexdigest()


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as a batch; schema: names with bigint, string and lists of both."""
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = [x.split(" ") for x in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) of (conv_id, turn, role, text), damaged by crc32(`conv_id:turn`) % 20.

    0 drops the row (it stays as `gone`, so that its conversation is known), 1 empties its text, 2 takes . ! ? from it, 3 repeats
    it, 4 sets the role user. A null id or turn counts as one space there and stays null; a null role or text is one space.
    """
    blank = F.lit(" ")
    rows = rows.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.col("kind")
    rows = rows.withColumn("kind", F.crc32(named.cast("binary")) % 20)
    rows = rows.withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone")
    )


def _with_faults(rows: DataFrame) -> DataFrame:
    """Rows with `gone` (if not there), `blank` and `truncated` by their own text; a row of both is blank."""
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    rows = rows.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.coalesce("gone", F.lit(False)).alias("gone"),
    )
    ending = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    rows = rows.withColumn("blank", ending == "")
    return rows.withColumn("truncated", ~F.col("blank") & ~ending.isin(".", "!", "?"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of each partition by conversation and turn (nulls first), then role and text."""
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Row], list[tuple[str, str]]]]:
    """Each conversation of a sorted stream: id, rows and their (role, text)s."""
    held, rows, turns, seen = None, [], [], set()
    for batch in batches:
        for part in text_slices(batch, 3, MOST_BYTES):
            for conv, turn, role, text, gone, blank, truncated in zip(*(c.to_pylist() for c in part.columns)):
                if held is None or held[0] != conv:
                    if held:
                        yield held[0], rows, turns
                    held, rows, turns, seen = (conv,), [], [], set()
                if gone:
                    continue
                again = not blank and (role, text) in seen
                seen.add((role, text))
                rows.append(Row(turn, role[:1], blank, again, truncated and not again))
                turns.append((role, text))
    if held:
        yield held[0], rows, turns


def _repair_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done = []
    for conv, rows, turns in _conversations(batches):
        found = _Findings()
        for row in rows:
            found.add(row)
        cost, audit = cheapest(rows)
        done.append((conv, *found.counts(), cost, audit, _digest(apply(audit, turns))))
        if len(done) == 10_000:
            yield _batch(AUDIT + ", repaired_sha256 string", done)
            done = []
    yield _batch(AUDIT + ", repaired_sha256 string", done)


def _turns_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, rows, turns in _conversations(batches):
        _, audit = cheapest(rows)
        made = enumerate(apply(audit, turns))
        yield _batch(TURNS, [(conv, 0, 0, place, role, text) for place, (role, text) in made])


BLOCK = (
    "conv_id bigint, part bigint, block bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
    "first string, last string, low bigint, high bigint, costs array<bigint>, audits array<string>"
)
CHAIN = AUDIT + ", parts array<bigint>, blocks array<bigint>, starts array<bigint>, ends array<bigint>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of a stream sorted by block, solved from every state: costs and audits by start and end state."""

    def solved(key: tuple, rows: list[Row]) -> tuple:
        found = _Findings()
        for row in rows:
            found.add(row)
        costs, audits = [None] * 16, [None] * 16
        for start in range(4):
            for end, (cost, audit) in solve(rows, start).items():
                costs[4 * start + end], audits[4 * start + end] = cost, audit
        return (
            *key, found.blank, found.duplicate, found.truncated, found.illegal, found.turns,
            found.first, found.last, found.low, found.high, costs, audits,
        )

    key, rows = None, []
    for batch in batches:
        for conv, part, block, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (conv, part, block):
                if rows:
                    yield _batch(BLOCK, [solved(key, rows)])
                key, rows = (conv, part, block), []
            rows.append(Row(*row))
    if rows:
        yield _batch(BLOCK, [solved(key, rows)])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest edits of each conversation from its blocks, which stream by in order, and the blocks' states on that path.

    Holds the audits of a block that may still count: as many characters as the audit itself, four times at most.
    """

    def ended(conv, found, layer, keys, steps) -> pa.RecordBatch:
        cost, node = close(layer)
        labels = layer.edits.labels(node)
        starts, ends, state = [], [], NOTHING
        for label, step in zip(labels, steps):
            starts.append(state)
            state = step[state, label]
            ends.append(state)
        parts, blocks = zip(*keys)
        return _batch(CHAIN, [(conv, *found.counts(), cost, "".join(labels), list(parts), list(blocks), starts, ends)])

    held = None
    for batch in batches:
        for conv, part, block, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held[0] != conv:
                if held:
                    yield ended(*held)
                layer = _Layer(Edits())
                layer[NOTHING] = (0, 0)
                held = (conv, _Findings(), layer, [], [])
            _, found, layer, keys, steps = held
            found.join(*rest[:-2])
            costs, audits = rest[-2:]
            after, step = _Layer(layer.edits), {}
            for start, (cost, node) in layer.items():
                for end in range(4):
                    if costs[4 * start + end] is not None:
                        label = audits[4 * start + end]
                        after.offer(end, cost + costs[4 * start + end], node, label)
                        step[start, label] = end
            keys.append((part, block))
            steps.append(step)
            held = (conv, found, after, keys, steps)
    if held:
        yield ended(*held)


def _apply_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns of each block. In a stream sorted by block, its audit and start state come before its rows."""
    for batch in batches:
        for part_of in text_slices(batch, 5, MOST_BYTES):
            done = []
            for conv, part, block, at, role, text, state in zip(*(c.to_pylist() for c in part_of.columns)):
                if at < 0:
                    audit, spoken, start, place = text, state, 0, 0
                    last = len(audit.rstrip("I"))
                    continue
                # Insertions come with the row behind them, those at the end with the last row.
                stop = start + 1
                while audit[stop - 1] == "I":
                    stop += 1
                edits = audit[start : len(audit) if stop == last else stop]
                for role_made, text_made in apply(edits, [(role, text)], spoken):
                    done.append((conv, part, block, place, role_made, text_made))
                    spoken = KEPT[role_made[:1]][spoken]
                    place += 1
                start = stop
            yield _batch(TURNS, done)


def _hash_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's repaired turns, which stream by in order. Holds no more than a slice."""
    schema = "conv_id bigint, repaired_sha256 string"
    held = None
    for batch in batches:
        for part in text_slices(batch, 2, MOST_BYTES):
            for conv, role, text in zip(*(c.to_pylist() for c in part.columns)):
                if held is None or held[0] != conv:
                    if held:
                        yield _batch(schema, [(held[0], held[1].hexdigest())])
                    held, between = (conv, sha256()), ""
                held[1].update(f"{between}{role}:{text}".encode())
                between = "\n"
    if held:
        yield _batch(schema, [(held[0], held[1].hexdigest())])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the partition and their place in it."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        extra = [pa.array(np.full(n, part, "i8")), pa.array(np.arange(at, at + n, dtype="i8"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "part", "at"])
        at += n


class _Large:
    """The larger conversations, repaired in blocks; every step is a Spark job over their rows."""

    def __init__(self, rows: DataFrame, block_rows: int):
        lead = F.substring("text", 1, 64)
        dealt = rows.withColumn("lead", lead).repartitionByRange("conv_id", "turn", "role", "lead").drop("lead")
        columns = "conv_id bigint, turn bigint, role string, text string, gone boolean, blank boolean, truncated boolean"
        numbered = _ordered(dealt).mapInArrow(_numbered, f"{columns}, part bigint, at bigint")
        self.rows = materialize(numbered, "conversation-rows").withColumn("block", F.expr(f"at div {block_rows}"))
        present = self._with_duplicates(self.rows.where("not gone"))
        key = ["conv_id", "part", "block"]
        narrow = present.select(
            *key, "turn", F.substring("role", 1, 1).alias("initial"), "blank", "again", (F.col("truncated") & ~F.col("again")).alias("cut"), "at"
        )
        solved = narrow.repartition(*key).sortWithinPartitions(*key, "at").mapInArrow(_blocks, BLOCK)
        self.blocks = materialize(solved, "conversation-blocks")
        chained = self.blocks.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(_chain, CHAIN)
        self.audits = materialize(chained, "conversation-audits")

    def _with_duplicates(self, rows: DataFrame) -> DataFrame:
        """Rows with `again`: whether an earlier row of the conversation has the role and text."""
        content = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"), 256)
        named = rows.withColumn("content", content).withColumn("__conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
        here = F.struct("part", "at")
        twice = named.where("not blank").groupBy("__conv", "content").agg(F.min(here).alias("earliest"), F.count("*").alias("n"))
        twice = twice.where("n > 1").drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = named.withColumn("salt", F.pmod(F.col("at"), F.lit(SALTS)).cast("int"))
        joined = salted.join(twice, ["__conv", "content", "salt"], "left").drop("salt", "content", "__conv")
        return joined.withColumn("again", ~F.col("blank") & F.coalesce(F.col("earliest") != here, F.lit(False))).drop("earliest")

    def turns(self) -> DataFrame:
        """The repaired turns: conv_id, part, block, place (together their order), role, text."""
        key = ["conv_id", "part", "block"]
        steps = F.explode(F.arrays_zip("parts", "blocks", "starts", "ends")).alias("step")
        inserted = F.length(F.regexp_extract("audit", "I*$", 0))
        # Insertions behind the last row are in no block's audit; the last block takes them.
        path = self.audits.select("conv_id", inserted.alias("behind"), F.element_at("parts", -1).alias("__part"), F.element_at("blocks", -1).alias("__block"), steps)
        path = path.select(
            F.col("conv_id").alias("__conv"), F.col("step.parts").alias("part"), F.col("step.blocks").alias("block"),
            F.col("step.starts").alias("start"), F.col("step.ends").alias("end"),
            F.when((F.col("step.parts") == F.col("__part")) & (F.col("step.blocks") == F.col("__block")), F.col("behind")).otherwise(0).alias("behind"),
        )
        same = self.blocks["conv_id"].eqNullSafe(path["__conv"])
        # A part holds blocks of few conversations, so part and block lead the join.
        chosen = self.blocks.join(path, ["part", "block"]).where(same)
        audit = F.concat(F.get("audits", F.col("start") * 4 + F.col("end")), F.expr("repeat('I', behind)"))
        heads = chosen.select("conv_id", "part", "block", F.lit(-1).cast("bigint").alias("at"), F.lit("").alias("role"), audit.alias("text"), F.col("start").alias("state"))
        rows = self.rows.where("not gone").select(*key, "at", "role", "text", F.lit(0).cast("bigint").alias("state"))
        both = heads.unionByName(rows).repartition(*key).sortWithinPartitions(*key, "at")
        return both.mapInArrow(_apply_blocks, TURNS)

    def repaired(self) -> DataFrame:
        names = [x.split(" ")[0] for x in AUDIT.split(", ")]
        turns = self.turns().repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place")
        hashes = turns.select("conv_id", "role", "text").mapInArrow(_hash_turns, "conv_id bigint, repaired_sha256 string")
        hashes = hashes.withColumnRenamed("conv_id", "__conv")
        # All rows of a conversation may be dropped, or deleted.
        known = self.rows.select("conv_id").distinct().withColumnRenamed("conv_id", "__known")
        audits = known.join(self.audits, F.col("conv_id").eqNullSafe(F.col("__known")), "left").drop("conv_id").withColumnRenamed("__known", "conv_id")
        found = audits.join(hashes, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
        zeros = [F.coalesce(n, F.lit("") if n == "audit" else F.lit(0).cast("bigint")).alias(n) for n in names[1:]]
        return found.select("conv_id", *zeros, F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))


def _split(rows: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations of bounded size, and of larger ones if there are any."""
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("size"))
    large = sizes.where((F.col("n") > most_rows) | (F.col("size") > most_bytes)).select(F.col("conv_id").alias("__large"))
    large = materialize(large, "large-conversations")
    n = large.count()
    if not n:
        return rows, None
    named = F.broadcast(large) if n <= MOST_NAMED else large
    same: Column = F.col("conv_id").eqNullSafe(F.col("__large"))
    return rows.join(named, same, "left_anti"), rows.join(named, same, "left_semi")


def repair(rows: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per conversation of (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit and the
    sha256 of the repaired turns (`role:text`, newline-joined).

    A null conv_id is a conversation like others. Rows go by turn, nulls first, then role and text by bytes. A null role or text
    is one space. Rows marked in a boolean column `gone` only make their conversation known: one without others has zeros, an
    empty audit and the empty text's digest. Roles count by their first character; one that is none of s, u, a can't be
    kept. Gaps beyond 64 bits are the largest number. Other columns are ignored; an empty table gives no rows.

    A conversation beyond the bounds is repaired in blocks, with the same result. Its digest is one chain by definition: one task
    hashes its turns as they stream by, and its audit is one value.
    """
    small, large = _split(_with_faults(rows), most_rows, most_bytes)
    done = _ordered(small.repartition("conv_id")).mapInArrow(_repair_small, AUDIT + ", repaired_sha256 string")
    return done if large is None else done.unionByName(_Large(large, block_rows).repaired())


def repaired_turns(rows: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired turns themselves: conv_id, part, block, place (together their order), role, text. Otherwise as repair."""
    small, large = _split(_with_faults(rows), most_rows, most_bytes)
    done = _ordered(small.repartition("conv_id")).mapInArrow(_turns_small, TURNS)
    return done if large is None else done.unionByName(_Large(large, block_rows).turns())


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
