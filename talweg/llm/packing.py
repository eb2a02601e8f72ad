"""Best-fit packing whose bin counts are certified by lower bounds.

Documents are dealt into partitions, each packed best-fit decreasing. Dual feasible functions give a lower bound
of each partition's bin count; a partition that meets it is proven optimal. Partitions with gaps release the documents of bins
that are not full, these are dealt anew among them, and packed again. The same bound over all documents tells when to stop.
"""

from __future__ import annotations

import base64
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import ready, stage, table, tokenizer_path

#: Tokens of a sequence, token after each document, documents packed together.
LENGTH, END, TOGETHER = 1024, 2, 32768
#: Remembered words of a worker, to bound its memory.
MAX_WORDS = 700_000
_SPECIAL = "<|endoftext|>"
_LATIN = 0x250


def _class(first: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_LATIN) if unicodedata.category(chr(c))[0] == first)


_L, _N, _S = _class("L"), _class("N"), "\\t-\\r \\x85\\xa0"
#: The public split pattern of the vocabulary, for texts of Latin characters.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_OTHER = re.compile(f"[^\x00-{chr(_LATIN - 1)}]")


class _Words(dict):
    """Ids of a word as bytes, remembered."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.merge(word.encode()), "<u4").tobytes()
        if len(word) <= 32:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, as the tokenizer file gives them without added tokens.

    Texts of Latin characters are split here and their words merged by ranks, word by word; the
    merges never cross the split. All other texts go through the tokenizer as they are.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.special = np.array([self.tokenizer.token_to_id(_SPECIAL)], "<u4").tobytes()
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=merges, special_tokens={})
        self.words = _Words(encoding._core_bpe.encode_single_piece)

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = (b"".join(map(self.words.__getitem__, _SPLIT.findall(part))) for part in text.split(_SPECIAL))
        return self.special.join(parts)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(*paths: str) -> Encoder:
    if paths not in _ENCODERS:
        _ENCODERS[paths] = Encoder(*paths)
    return _ENCODERS[paths]


def cut(docs: DataFrame, tokenizer: str, ranks: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end token in pieces.

    Documents of at most ``length`` ids are one piece; of longer ones all pieces but the first are full.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = _encoder(tokenizer, ranks), np.array([end], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + last
                size, at, piece = len(ids) // 4, 0, 0
                while at < size:
                    upto = size if size - at <= length else at + ((size - at) % length or length)
                    out.append((doc, piece, at, upto - at, zlib.crc32(memoryview(ids)[4 * at : 4 * upto])))
                    at, piece = upto, piece + 1
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        pieces, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def lower_bound(counts: np.ndarray) -> int:
    """Bins that items need at least: ``counts[s]`` items of size s, capacity ``len(counts) - 1``.

    The best of two families of dual feasible functions, in exact integers: rounding down to k-ths of
    the capacity, and leaving out small items while large ones count fully.
    """
    capacity = len(counts) - 1
    counts, sizes = counts.astype(object), np.arange(capacity + 1)
    best = 0
    for k in range(1, 31):
        exact = sizes * (k + 1) % capacity == 0
        weight = np.where(exact, sizes * k, (k + 1) * sizes // capacity * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (k * capacity)))
    for small in range(capacity // 2 + 1):
        weight = np.where(sizes > capacity - small, capacity, np.where(sizes < small, 0, sizes))
        best = max(best, -(-int((counts * weight).sum()) // capacity))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and what each bin has left: best-fit decreasing."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    left: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r left
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        left[b] = rest = room - size
        if rest:
            open_bins[rest].append(b)
            mask |= 1 << rest
    return bins, offsets, np.array(left, np.int64)


def _packed(items: DataFrame, count: int, together: int, capacity: int, round_: int) -> DataFrame:
    """Deal ``count`` items into partitions and pack each: working columns are added."""
    lots = max(1, -(-count // together))
    dealt = items.withColumn("__lot", F.pmod(F.xxhash64("__row", F.lit(round_)), F.lit(lots)))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__row", ignore_index=True)
        sizes = frame["length"].to_numpy()
        bins, places, left = best_fit(sizes, capacity)
        return frame.assign(
            __bin=bins, __place=places, __left=left[bins], __bins=len(left), __bound=lower_bound(np.bincount(sizes, minlength=capacity + 1))
        )

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return stage(dealt.groupBy("__lot").applyInPandas(packed, f"{kind}, __bin long, __place long, __left long, __bins long, __bound long"))


def _totals(packed: DataFrame) -> tuple[int, int]:
    """Bins and sum of the bounds over all partitions."""
    row = packed.select("__lot", "__bins", "__bound").distinct().agg(F.sum("__bins"), F.sum("__bound")).first()
    return row[0] or 0, row[1] or 0


def pack(pieces: DataFrame, capacity: int = LENGTH, together: int = TOGETHER, rounds: int | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces of 1 to ``capacity`` tokens.

    Full pieces are sequences of their own. Stops when the number of bins meets the bound over all pieces or when an
    exchange gains nothing; every exchange gains a bin at least, so it ends. With ``rounds`` given, it stops after so many.
    An empty table gives an empty result.
    """
    columns = pieces.columns
    items = stage(pieces.withColumn("__row", F.monotonically_increasing_id()))
    own = items.filter(F.col("length") == capacity).select(*columns, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.filter(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for row in rest.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    goal = lower_bound(counts)

    def numbered(packed: DataFrame, round_: int) -> DataFrame:
        # Round, lot and bin: rows of a lot are fewer than 2^24, lots than 2^28.
        number = F.lit(round_ << 52) + F.shiftleft(F.col("__lot"), 24) + F.col("__bin")
        return packed.select(*columns, number.alias("sequence_id"), F.col("__place").alias("offset"))

    now = _packed(rest, int(counts.sum()), together, capacity, 0)
    bins, bounds = _totals(now)
    result, kept, at, round_ = own, 0, 0, 0
    while kept + bins > goal and (rounds is None or round_ < rounds):
        round_ += 1
        # Where all partitions meet their bounds, what is left to gain is the rounding of each.
        gap = (F.col("__bins") > F.col("__bound")) | F.lit(bins == bounds)
        released = now.filter(gap & (F.col("__left") > 0))
        count = released.count()
        before = released.select("__lot", "__bin").distinct().count()
        if not count:
            break
        again = _packed(released.select(*items.columns), count, together, capacity, round_)
        after, again_bounds = _totals(again)
        if after >= before:
            break
        result = result.unionByName(numbered(now.filter(~(gap & (F.col("__left") > 0))), at))
        kept += bins - before
        now, bins, bounds, at = again, after, again_bounds, round_
    return result.unionByName(numbered(now, at))


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str) -> DataFrame:
    """Pieces of all documents in sequences.

    Null and empty texts are the end token alone; ids may repeat or be null, each row is packed; other
    columns are ignored.
    """
    return pack(cut(docs, tokenizer, ranks))


def _paths() -> tuple[str, str]:
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens.

    Texts with a character from U+0250 on are split by the tokenizer itself, all others here; a test on random texts of both kinds
    holds the ids against the tokenizer's.
    """
    return pack_documents(table(spark, sf_dir, "documents"), *_paths())


QUERIES = {"op7_packing": ready(op7_packing)}
ORACLES: dict[str, str] = {}
