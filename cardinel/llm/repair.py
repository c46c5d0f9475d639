"""Structure repair of conversations: the cheapest edits that make the roles take turns.

A conversation's rows are dealt out by its id and sorted, so that a task reads them as a
stream. Faults are found by Spark; the choice of edits is `edit_paths.Repair`, which
holds only what is still undecided. A conversation is one stream of one task, as its
digest is one of its whole text in order; a task's memory does not grow with it unless
its best histories never meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cardinel.llm.edit_paths import Repair, Row

SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
LEGAL = {"su", "ua", "au"}
AUDIT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
TURN = "position long, edit string, role string, text string"
# Rows and bytes of one batch of results.
BATCH_ROWS, BATCH_BYTES = 4096, 4_000_000


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role and text with planted faults, and `gone` where dropped.

    crc32 of `conv_id:turn` modulo 20 decides: 0 drops the row, 1 empties its text, 2 takes
    its `[.!?]` away, 3 repeats it, 4 makes its role user. Nulls count as one space; a
    turn that is null stays null in its order.
    """
    blank = F.lit(" ")
    key = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank)
    )
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    role = F.coalesce(F.col("role").cast("string"), blank)
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault == 0).alias("gone"),
        F.when(fault == 3, 2).otherwise(1).alias("_times"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return rows.select("*", copies.alias("_copy")).drop("_times", "_copy")


def _streams(rows: DataFrame) -> DataFrame:
    """Rows in order within each conversation, with their faults.

    Both orders, by text for finding repeats and by turn, are local to a task.
    """
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    own = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        "gone",
    ).repartition("conv_id")
    alike = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return own.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("binary").alias("role"),
        F.col("text").cast("binary").alias("text"),
        F.substring("role", 1, 1).alias("initial"),
        "gone",
        (~F.col("text").rlike(SOLID)).alias("blank"),
        (F.row_number().over(alike) > 1).alias("again"),
        (~F.col("text").rlike(ENDED)).alias("open"),
    ).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )


class _Conversation:
    """Figures and edits of one conversation while its rows go by."""

    def __init__(self, conv_id, out: list[tuple] | None) -> None:
        self.conv_id, self.out = conv_id, out
        self.first = self.last = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.digest, self.letters, self.left, self.bytes = hashlib.sha256(), [], 0, 0
        self.repair = Repair(self.give)

    def give(self, letter: str, role: bytes | None, text: bytes | None) -> None:
        self.letters.append(letter)
        if role is not None:
            if self.left:
                self.digest.update(b"\n")
            self.digest.update(role + b":" + text)
            self.left += 1
        if self.out is not None:
            at = None if role is None else self.left
            self.out.append((self.conv_id, at, letter, role, text))
            self.bytes += len(text or b"")

    def add(self, turn, role: bytes, text: bytes, initial: str, blank: bool, again: bool, open_: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        duplicate = again and not blank
        truncated = open_ and not blank and not duplicate
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.repair.add(Row(initial, role, text, blank or duplicate, truncated))

    def end(self) -> tuple:
        cost = self.repair.finish()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
            "".join(self.letters), self.digest.hexdigest(),
        )


def _run(schema: pa.Schema, each_turn: bool):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
        arrays = []
        for field, values in zip(schema, columns, strict=True):
            kind = pa.binary() if each_turn and field.name in ("role", "text") else field.type
            arrays.append(pa.array(values, kind).cast(field.type))
        return pa.record_batch(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        own: _Conversation | None = None
        size = 0
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                conv_id, turn, role, text, initial, gone, *faults = values
                if own is None or conv_id != own.conv_id:
                    if own is not None:
                        ended = own.end()
                        size += own.bytes if each_turn else len(ended[-2])
                        if not each_turn:
                            rows.append(ended)
                    own = _Conversation(conv_id, rows if each_turn else None)
                if not gone:
                    own.add(turn, role, text, initial, *faults)
                if len(rows) >= BATCH_ROWS or size + (own.bytes if each_turn else 0) >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows.clear()
                    size = own.bytes = 0
        if own is not None:
            ended = own.end()
            if not each_turn:
                rows.append(ended)
        yield batch_of(rows)

    return run


def _mapped(rows: DataFrame, schema: str, each_turn: bool) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    named = f"conv_id {kind}, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(named))
    return _streams(rows).mapInArrow(_run(arrow, each_turn), named)


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and what they cost.

    Rows come as conv_id, turn, role and text, and may carry `gone` for rows that are not
    there, which only keep their conversation in the result. They are taken by turn (nulls
    first), then role and text. Null roles and texts count as one space, a null conv_id is
    a conversation of its own; other columns are not looked at. A conversation without
    rows has zeros, no edits, and the digest of an empty text.

    A row's first fault counts: `blank`, `duplicate` (role and text were there before) or
    `truncated` (does not end in `[.!?]`). `illegal` counts neighbours whose initials are
    not su, ua or au, `gaps` the turns that are missing between the first and the last.
    `audit` has the initials of the edits Keep, Rerole, Delete and Insert, and
    `repaired_sha256` the digest of the repaired `role:text` lines.
    """
    return _mapped(rows, AUDIT, each_turn=False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """One row per edit, in order: `position` among the repaired rows, `edit`, `role`, `text`.

    Rows come as for `audits`. Deleted rows have no position, role and text.
    """
    return _mapped(rows, TURN, each_turn=True)
