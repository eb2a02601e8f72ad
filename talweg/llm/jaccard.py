"""Similarity join of word shingle sets by parity sketches.

A token (a shingle) XORs its hash into the sketch, so a token that two documents share cancels out in their
difference, and the sketches differ in at most as many places as the sets differ in tokens. Two sketches
are used. The blocked one has a 64-bit word in each of ``m`` pieces; a token goes to one piece, by the range its hash lies in. At the asked
similarity, sets of a size band differ in at most ``d`` tokens, so with ``m = d + 1 + s`` pieces at least ``s + 1`` agree:
documents are joined on equal pieces. The flat one has at least two bits for each token of the set, of which the token flips
one; its Hamming distance drops candidates before texts are compared. Of two lengths, the longer one is folded. Every candidate is verified on the whole texts.

Weak pieces, with hardly any token, agree by chance. A document leaves them out if it has at most ``s`` of them; then
one of the pieces that agree is left, else all are given, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import byte_rows, mix64, ready, stage, table
from talweg.llm.components import connected

#: Words in a shingle, and the least similarity in hundredths.
WORDS, LEAST = 4, 85
#: Least bits of the flat sketch; most tokens of a weak piece; spare pieces for each needed one.
BITS, WEAK, SPARE = 512, 2, 0.2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _shingles_of(parts: list[bytes], words: int) -> np.ndarray:
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, n)
    length = min(n, words)
    value = hashes[: n - length + 1].copy()
    for k in range(1, length):
        value *= _STEP
        value += hashes[k : n - length + 1 + k]
    value += np.uint64(length)
    value = mix64(value)
    value.sort()
    first = np.ones(len(value), bool)
    np.not_equal(value[1:], value[:-1], out=first[1:])
    return value[first]


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; words are split at ASCII white space, A to Z lower-cased."""
    return _shingles_of(text.lower().split(), words)


class Bands:
    """Size bands such that sets of a link lie in one band or in neighbours, and their pieces."""

    def __init__(self, least: int):
        self.least, self.starts = least, [1, 2]
        self.known: dict[int, tuple[int, int, int]] = {}
        self.cut: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(max(self.starts[-1] + 1, (self.starts[-1] - 1) * 100 // self.least + 1))
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def difference(self, sizes: int) -> int:
        """The most tokens in which two sets of these sizes, added, differ at the least similarity."""
        return (100 - self.least) * sizes // (100 + self.least)

    def pieces(self, band: int) -> tuple[int, int, int]:
        """Pieces for links whose larger set lies in ``band``, how many are spare, and up to how many tokens make one weak.

        The last follows from the smallest sets of such links: of their pieces, weak ones must be expected to be well within the spare ones.
        """
        while len(self.starts) <= band + 1:
            self.of(self.starts[-1])
        if band not in self.known:
            need = self.difference(2 * (self.starts[band + 1] - 1)) + 1
            spare = 0 if need == 1 else int(np.ceil(SPARE * need))
            rate = self.starts[max(0, band - 1)] / (need + spare)
            shares = np.cumsum([np.exp(-rate) * rate**k / factorial(k) for k in range(WEAK + 1)])
            weak = max(0, int((shares * (need + spare) <= 0.7 * spare).sum()) - 1)
            self.known[band] = need + spare, spare, weak
        return self.known[band]

    def ranges(self, band: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces after the first begin, and a number for each piece that tells it from all others."""
        if band not in self.cut:
            count = self.pieces(band)[0]
            edges = np.arange(1, count, dtype=np.uint64) * np.uint64((2**64 - 1) // count)
            self.cut[band] = edges, mix64(np.arange(count, dtype=np.uint64) + np.uint64(band << 32))
        return self.cut[band]


def signatures(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the pieces, once for links to sets of the own band and smaller, once for those of the next band.

    Tokens are sorted, and a piece is a range of them, so its word follows from the parities before both ends.
    """
    n = len(tokens)
    parity = np.zeros(n + 1, np.uint64)
    np.bitwise_xor.accumulate(tokens, out=parity[1:])
    own, keys = bands.of(n), []
    for band in (own, own + 1):
        (count, spare, most), (edges, salts) = bands.pieces(band), bands.ranges(band)
        ends = np.empty(count + 1, np.int64)
        ends[0], ends[1:-1], ends[-1] = 0, tokens.searchsorted(edges), n
        words = (parity[ends[1:]] ^ parity[ends[:-1]]) + salts
        full = ends[1:] - ends[:-1] > most
        keys.append(words[full] if count - np.count_nonzero(full) <= spare else words)
    return mix64(np.concatenate(keys)).view(np.int64)


def _flat_sketch(tokens: np.ndarray) -> np.ndarray:
    bits = max(BITS, 1 << (2 * len(tokens) - 1).bit_length())
    odd = (np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _folded(flat: np.ndarray, words: int) -> np.ndarray:
    """The sketch that the same tokens give with fewer bits."""
    return np.bitwise_xor.reduce(flat.reshape(-1, words), axis=0)


def sketch(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """(doc, n, digest, flat, keys) of every row; the digest is that of the words in order."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(least)
        for batch in batches:
            sizes, digests, flats, keys = [], [], [], []
            for text in byte_rows(batch.column(1)):
                parts = text.lower().split()
                tokens = _shingles_of(parts, words)
                sizes.append(len(tokens))
                digests.append(xxhash.xxh3_128_digest(b" ".join(parts)) if parts else None)
                flats.append(_flat_sketch(tokens))
                keys.append(signatures(tokens, bands) if len(tokens) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(flats, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc", "n", "digest", "flat", "keys"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sketched, "doc long, n long, digest binary, flat array<long>, keys array<long>"
    )


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, doc) in order: rows of keys with several documents, with the first one as head."""
    key = head = None
    emitted = False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, docs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        group = np.cumsum(np.r_[False, keys[1:] != keys[:-1]])
        heads = docs[starts]
        carried = key is not None and keys[0] == key
        if carried:
            heads[0] = head
        head_of = heads[group]
        other = docs != head_of
        several = np.zeros(len(starts), bool)
        np.logical_or.at(several, group, other)
        fresh = np.r_[True, (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])]
        use = several[group] & fresh
        if carried and emitted:  # the head was given with an earlier batch
            use &= ~((group == 0) & ~other)
        out = [keys[use], head_of[use], docs[use]]
        if carried and not emitted and several[0] and not (use & (group == 0) & ~other).any():
            out = [np.r_[v, column] for v, column in zip((key, head, head), out, strict=True)]
        emitted = bool(several[-1]) or (carried and emitted and len(starts) == 1)
        key, head = keys[-1], heads[-1]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["key", "head", "doc"])


def _with_sketches(pairs: DataFrame, facts: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link, with the sizes and flat sketches of both."""
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}")), side)
    pairs = pairs.filter(100 * F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b"))
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("doc").alias(side), F.col("flat").alias(f"flat_{side}")), side)
    return pairs


def _allowed(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs whose flat sketches are near enough for a link."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            flats = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            for both, one, other in zip(sizes, *flats, strict=True):
                words = min(len(one), len(other))
                far = int(np.bitwise_count((_folded(one, words) ^ _folded(other, words)).view(np.uint64)).sum())
                keep.append((100 + least) * far <= (100 - least) * both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "n_a", "n_b", "flat_a", "flat_b").mapInArrow(near, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, least: int) -> DataFrame:
    """Links among candidate pairs, by their whole texts. ``pairs`` is a written table."""
    # A written table has a known size, by which Spark broadcasts it or shuffles the texts.
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
    for side in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            same = []
            for one, other in zip(byte_rows(batch.column(2)), byte_rows(batch.column(3)), strict=True):
                if one != last:
                    last, left = one, shingles(one, words)
                right = shingles(other, words)
                common = len(left) + len(right) - len(np.union1d(left, right))
                same.append(100 * common >= least * (len(left) + len(right) - common))
            keep = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(verified, "a long, b long")


def _blocks(start: int, stop: int, step: int) -> Iterator[tuple[int, int]]:
    return ((i, min(stop, i + step)) for i in range(start, stop, step))


def _across(least: int):
    """Candidates in a bucket between documents that are not connected yet, by label groups."""

    def bucket(labels, docs, sizes, flats, heads) -> Iterator[np.ndarray]:
        order = np.argsort(labels, kind="stable")
        labels, docs, sizes, flats = labels[order], docs[order], sizes[order], flats[order]
        ends = np.r_[np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(labels)]
        begin = 0
        words = flats.shape[1]
        for end in ends[:-1]:  # a group against all later ones, in blocks of bounded size
            for i, j in _blocks(begin, end, 64):
                for m, n in _blocks(end, len(labels), max(64, (1 << 14) // words)):
                    far = np.bitwise_count(flats[i:j, None] ^ flats[None, m:n]).sum(axis=2, dtype=np.int64)
                    a, b = sizes[i:j, None], sizes[None, m:n]
                    x, y = np.nonzero(
                        ((100 + least) * far <= (100 - least) * (a + b)) & (100 * np.minimum(a, b) >= least * np.maximum(a, b))
                    )
                    one, other = docs[i:j][x], docs[m:n][y]
                    fresh = (one != heads) & (other != heads)  # pairs with the head were verified before
                    if fresh.any():
                        yield np.stack([np.minimum(one, other)[fresh], np.maximum(one, other)[fresh]])
            begin = end

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held)
            flats = whole.column("flat").combine_chunks().to_numpy(zero_copy_only=False)
            words = min(map(len, flats))
            flats = np.stack([_folded(f, words) for f in flats]).view(np.uint64)
            numbers = {c: whole.column(c).to_numpy() for c in ("label", "doc", "n")}
            for found in bucket(numbers["label"], numbers["doc"], numbers["n"], flats, whole.column("head")[0].as_py()):
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], ["a", "b"])

        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for i, j in pairwise(cuts):
                if held and keys[i] != key:
                    yield from flush()
                    held = []
                key = keys[i]
                held.append(batch.slice(i, j - i))
        if held:
            yield from flush()

    return across


def link_components(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Documents link if 100 * intersection >= ``least`` * union. A text of fewer words than a shingle is
    one shingle; one without words, or null, has none and links with nothing. Documents with the same words in
    the same order are linked to the smallest of them, and only that one is searched. Within a bucket of equal
    pieces, every document is compared with the smallest one first; after that only documents that are not
    connected yet are compared, so a group of near copies costs about as many comparisons as it has
    documents, and no link is missed. Rows with a null id keep it, with a null component. Rows that share
    an id are one document. An empty table gives an empty result.
    """
    facts = stage(sketch(docs, words, least))
    groups = facts.filter("n > 0").groupBy("digest").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    copies = stage(facts.select("doc", "digest").join(groups, "digest").filter("doc <> rep").select("doc", "rep").distinct())
    keys = facts.filter("doc IS NOT NULL").select("doc", "keys").join(copies.select("doc"), "doc", "left_anti")
    members = stage(
        keys.select(F.explode("keys").alias("key"), "doc").repartition("key").sortWithinPartitions("key", "doc")
        .mapInArrow(_buckets, "key long, head long, doc long")
    )
    slim = facts.filter("n > 0").select("doc", "n", "flat")
    stars = members.filter("doc <> head").select(F.col("head").alias("a"), F.col("doc").alias("b")).distinct()
    first = stage(_verified(stage(_allowed(_with_sketches(stars, slim, least), least)), docs, words, least))
    labels = connected(first)
    labelled = (
        members.join(labels, F.col("doc") == F.col("node"), "left")
        .select("key", "head", "doc", F.coalesce("component", "doc").alias("label"))
    )
    labelled = stage(labelled)
    open_keys = (
        labelled.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        .filter("c > 2 AND lo <> hi").select("key")
    )
    rest = stage(
        labelled.join(open_keys, "key").join(slim, "doc").select("key", "head", "doc", "label", "n", "flat")
        .repartition("key").sortWithinPartitions("key").mapInArrow(_across(least), "a long, b long").distinct()
    )
    links = first.unionByName(_verified(rest, docs, words, least))
    final = connected(links.unionByName(copies.select(F.col("doc").alias("a"), F.col("rep").alias("b"))))
    return (
        facts.select("doc", "n").join(final, F.col("doc") == F.col("node"), "left")
        .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
    )


def keep_one_of_each(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """Documents without those that link, directly or through others, to one that comes before them; all columns stay.

    Rows that agree in id and text are one document and stay or go together. Documents come in order of their ids,
    null first, and different texts with one id in order of the texts' hash.
    """
    body = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"))
    shared = docs.groupBy("doc_id").agg(F.min(body).alias("lo"), F.max(body).alias("hi")).filter("doc_id IS NULL OR lo <> hi")
    if not shared.limit(1).count():
        gone = link_components(docs, words, least).filter("component_id <> doc_id").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    # Ids that don't tell documents apart: rows get numbers of their own, and each component keeps its first document.
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("doc_id", body.alias("body")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all")))
    found = link_components(rows.select(F.col("row").alias("doc_id"), F.col("all.text").alias("text")), words, least)
    parts = stage(found.join(rows.select(F.col("row").alias("doc_id"), "key"), "doc_id"))
    first = parts.groupBy("component_id").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first <> last")
    gone = parts.join(first, "component_id").filter("key <> first").select(F.col("doc_id").alias("row")).distinct()
    return rows.join(gone, "row", "left_anti").select("all.*")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 4-word shingles agree by 85 in 100 or more."""
    return link_components(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
tokens AS (SELECT doc_id, hash(t) AS t FROM (SELECT doc_id, unnest(s) AS t FROM sets)),
rare AS (SELECT t FROM tokens GROUP BY t HAVING count(*) > 1),
shared AS (SELECT tokens.* FROM tokens JOIN rare USING (t)),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shared x JOIN shared y ON x.t = y.t AND x.doc_id <> y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 85 * (any_value(p.n) + any_value(q.n) - count(*))),
reach AS (SELECT doc_id, doc_id AS c FROM sizes UNION SELECT links.a, reach.c FROM reach JOIN links ON links.b = reach.doc_id)
SELECT doc_id, any_value(n) AS n_shingles, min(c) AS component_id FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
"""

QUERIES = {"op6_jaccard_join": ready(op6_jaccard_join)}
ORACLES = {"op6_jaccard_join": OP6_SQL}
