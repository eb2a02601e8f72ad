"""Online packing with a bounded number of open windows.

Each partition keeps a fixed number of open windows while its documents pass once. A document goes to the window
that it fits best; when none fits, the fullest window is filled with the document's head and emitted, so only its last windows
stay open. These leftovers are merged in a tree over the partitions, each lot of it leaving less than one window.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import ready, stage, table, tokenizer_path
from talweg.llm.packing import _encoder as encoder

#: Tokens of a window, token after each document, open windows of a partition, partitions whose leftovers meet in one task.
LENGTH, END, OPEN, FAN = 2048, 1, 32, 16
_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_SCHEMA = pa.schema(
    [pa.field(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in _COLUMNS.split(", ")]
)


class Piece(NamedTuple):
    """Consecutive ids of a document, 4 bytes each."""

    doc: int | None
    start: int
    doc_tokens: int
    ids: bytes

    @property
    def size(self) -> int:
        return len(self.ids) // 4

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * size]), self._replace(start=self.start + size, ids=self.ids[4 * size :])


class Windows:
    """At most ``most`` open windows of ``length`` tokens; full ones turn into rows of ``done``."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.rooms: list[tuple[int, int]] = []  # (room, sequence), in order
        self.pieces: dict[int, list[Piece]] = {}
        self.done: list[tuple] = []

    def emit(self, sequence: int, pieces: list[Piece], keep_ids: bool = False) -> None:
        at = 0
        for p in pieces:
            self.done.append((p.doc, p.start, p.size, zlib.crc32(p.ids), p.doc_tokens, sequence, at, p.ids if keep_ids else None))
            at += p.size

    def _put(self, room: int, sequence: int, pieces: list[Piece]) -> None:
        held = [*self.pieces.pop(sequence, ()), *pieces]
        room -= sum(p.size for p in pieces)
        if room:
            self.pieces[sequence] = held
            insort(self.rooms, (room, sequence))
        else:
            self.emit(sequence, held)

    def add(self, pieces: list[Piece], sequence: int) -> None:
        """Place pieces of at most one window together; ``sequence`` names the window that they may open."""
        while pieces:
            size = sum(p.size for p in pieces)
            best = bisect_left(self.rooms, (size, -1 << 63))
            if best < len(self.rooms):
                return self._put(*self.rooms.pop(best), pieces)
            if len(self.rooms) < self.most:
                return self._put(self.length, sequence, pieces)
            pieces = self.fill(0, pieces)

    def fill(self, which: int, pieces: list[Piece]) -> list[Piece]:
        """Emit an open window after filling it with the head of ``pieces``; what is left of them is given back."""
        room, sequence = self.rooms.pop(which)
        head, rest, left = [], [], room
        for p in pieces:
            if left >= p.size:
                head.append(p)
            elif left:
                first, second = p.cut(left)
                head.append(first)
                rest.append(second)
            else:
                rest.append(p)
            left -= min(left, p.size)
        self._put(room, sequence, head)
        return rest

    def merge(self) -> None:
        """Fill the fullest windows from the emptiest ones until less than one window's tokens are open."""
        while len(self.rooms) > 1:
            _, sequence = self.rooms.pop()
            pieces = self.pieces.pop(sequence)
            while pieces and self.rooms:
                pieces = self.fill(0, pieces) if sum(p.size for p in pieces) >= self.rooms[0][0] else self._put(*self.rooms.pop(0), pieces)
            if pieces:
                self._put(self.length, sequence, pieces)

    def rows(self) -> pa.Table:
        out, self.done = self.done, []
        columns = list(zip(*out, strict=True)) or [()] * len(_SCHEMA)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    def close(self) -> None:
        """All open windows turn into rows that keep their ids."""
        for _, sequence in self.rooms:
            self.emit(sequence, self.pieces[sequence], keep_ids=True)


def _first_pass(docs: DataFrame, tokenizer: str, ranks: str, length: int, end: int, most: int) -> DataFrame:
    """Rows of all windows; those still open at the end of their partition keep their ids."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, last = encoder(tokenizer, ranks), np.array([end], "<u4").tobytes()
        windows, sequence = Windows(length, most), TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens.encode(text.as_py() or "") + last
                rest = Piece(doc, 0, len(ids) // 4, ids)
                while rest.size >= length:
                    whole, rest = rest.cut(length)
                    windows.emit(sequence, [whole])
                    sequence += 1
                if rest.size:
                    windows.add([rest], sequence)
                    sequence += 1
            yield from windows.rows().to_batches()
        windows.close()
        yield from windows.rows().to_batches()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packed, _COLUMNS)


def _merge(left: DataFrame, fan: int, length: int, most: int) -> DataFrame:
    """One round: the open windows of ``fan`` lots are packed together, and less than one window of each stays open."""

    def merged(rows: pa.Table) -> pa.Table:
        held: dict[int, list[Piece]] = {}
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        for r in rows.to_pylist():
            held.setdefault(r["sequence_id"], []).append(Piece(r["doc_id"], r["start"], r["doc_tokens"], r["ids"]))
        windows, sizes = Windows(length, most), {s: sum(p.size for p in pieces) for s, pieces in held.items()}
        for sequence in sorted(held, key=lambda s: (-sizes[s], s)):
            windows.add(held[sequence], sequence)
        windows.merge()
        windows.close()
        out, lot = windows.rows(), rows["lot"][0].as_py() // fan
        return out.append_column("lot", pa.array([lot] * len(out), pa.int64()))

    return left.groupBy(F.floor(F.col("lot") / fan)).applyInArrow(merged, f"{_COLUMNS}, lot long")


def pack_online(
    docs: DataFrame, tokenizer: str, ranks: str, length: int = LENGTH, end: int = END, most: int = OPEN, fan: int = FAN
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every piece of every document.

    Each document is its ids and the token ``end``. All sequences hold ``length`` tokens but those of the last
    remainder, which is cut at powers of two, largest first; so nothing needs padding. A task keeps ``most`` windows, or
    those of ``fan`` lots; rounds of merging are the logarithm of the partitions.
    Null and empty texts are the end token alone; ids may repeat or be null, each row is packed; other columns are
    ignored; an empty table gives an empty result.
    """
    columns = [c.split()[0] for c in _COLUMNS.split(", ")][:-1]
    placed = stage(_first_pass(docs, tokenizer, ranks, length, end, most))
    result, left = placed.filter("ids IS NULL").select(*columns), placed.filter("ids IS NOT NULL")
    left = left.withColumn("lot", F.shiftright("sequence_id", 40))
    lots = (left.agg(F.max("lot")).first()[0] or 0) + 1
    while True:
        merged = stage(_merge(left, fan, length, most))
        result = result.unionByName(merged.filter("ids IS NULL").select(*columns))
        left, lots = merged.filter("ids IS NOT NULL"), -(-lots // fan)
        if lots == 1:
            return result.unionByName(_at_powers(left, length).select(*columns))


def _at_powers(left: DataFrame, length: int) -> DataFrame:
    """The last open window, of less than ``length`` tokens, as sequences of powers of two with negative numbers."""

    def split(rows: pa.Table) -> pa.Table:
        windows, number = Windows(length, 1), -1
        rest = [Piece(r["doc_id"], r["start"], r["doc_tokens"], r["ids"]) for r in rows.sort_by("offset").to_pylist()]
        while rest:
            power = 1 << (sum(p.size for p in rest).bit_length() - 1)
            windows.rooms = [(power, number)]
            rest = windows.fill(0, rest)
            number -= 1
        return windows.rows()

    return left.groupBy("lot").applyInArrow(split, _COLUMNS)


def op11_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens; the last remainder at powers of two.

    No SQL: tests compare ids with the library and check places, cover and padding against brute force.
    """
    docs = table(spark, sf_dir, "documents")
    return pack_online(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))


QUERIES = {"op11_online_packing": ready(op11_online_packing)}
ORACLES: dict[str, str] = {}
