"""Token counts by a compiled finite-state transducer, chunk by chunk.

The vocabulary's merge rules become a deterministic transducer over characters. A state
holds, for every suffix of the read text that still begins a piece, the token before that
suffix and the number of tokens up to it, so a transition knows by how many tokens the
encoding of the longer prefix differs: that number annotates it. States and transitions are
compiled when texts first reach them.

Why this equals the merge procedure: merges happen in one fixed order, so a token sequence is the
encoding of its text exactly if each pair of neighbours is the encoding of the pair's text.
Hence the last token of a prefix is the one piece that ends there and forms a valid pair with the
last token of the prefix before it.

No piece holds a space mark after another character, so a mark after one leads to one state from
everywhere. The map of a chunk (entry state to exit state and count) is then constant from its first
such mark on; only the part before it depends on the entry state. Maps compose associatively, and the
chunks of a text are combined in a tree.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import ready, table, tokenizer_path

MARK = "▁"
#: Characters in a chunk; any size gives the same counts.
CHUNK = 4096
#: Compiled transitions and remembered words of a worker, to bound its memory; beyond them, it starts anew.
MAX_TRANSITIONS, MAX_WORDS = 1_500_000, 600_000

_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_BOUNDARY = re.compile(f"[^{MARK}]{MARK}")
START = 0


def _packed(flag: int, entries: list[tuple[int, int, int]]) -> bytes:
    return array("i", [int(flag), *(x for entry in entries for x in entry)]).tobytes()


def _unpacked(state: bytes) -> tuple[int, list[tuple[int, int, int]]]:
    flag, *rest = array("i", state)
    return flag, list(zip(rest[::3], rest[1::3], rest[2::3], strict=True))


class ChunkMap(NamedTuple):
    """What a chunk does: run ``head`` from the entry state; then, if ``exit`` is set, all entries go on alike."""

    head: str
    exit: int | None
    emitted: int


class Transducer:
    """Compiled from the pieces of a merge vocabulary with byte fallback."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in scores):
            raise ValueError("a piece crosses the start of a word")
        # A trie as rows of children; the number of the piece that ends at a node, or 0.
        self.children: list[dict[str, int]] = [{}]
        self.piece = [0]
        self.texts = ["", *scores]
        for number, text in enumerate(scores, 1):
            node = 0
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.piece.append(0)
                node = self.children[node][c]
            self.piece[node] = number
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # A state: whether a mark came last; then (trie node, piece before, tokens up to there less tokens up to here), packed.
        self.states = [_packed(0, [(0, 0, 0)])]
        self.numbers = {self.states[0]: START}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.compiled = 0
        self.words: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """The merge procedure on a short text: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _follows(self, before: int, piece: int) -> bool:
        known = self.pairs.get(before << 32 | piece)
        if known is None:
            if len(self.pairs) > MAX_TRANSITIONS:
                self.pairs.clear()
            whole = [self.texts[n] for n in (before, piece) if n]
            known = self.pairs[before << 32 | piece] = self.merged("".join(whole)) == whole
        return known

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        in_run, entries = _unpacked(self.states[state])
        if c == MARK and not in_run:
            entries = [(0, 0, 0)]
        longer = [(self.children[node][c], before, rel) for node, before, rel in entries if c in self.children[node]]
        ends = [(self.piece[node], rel + 1) for node, before, rel in longer if self.piece[node] and self._follows(before, self.piece[node])]
        if ends:
            ((token, step),) = ends
            kept = [(node, before, rel - step) for node, before, rel in longer if self.children[node]]
            after = _packed(c == MARK, [*kept, (0, token, 0)])
        else:  # not in the vocabulary: its bytes are tokens, and no piece spans it
            step, after = len(c.encode()), _packed(c == MARK, [(0, 0, 0)])
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
            self.moves.append({})
        self.moves[state][c] = move = (number, step)
        self.compiled += 1
        return move

    def run(self, state: int, text: str) -> tuple[int, int]:
        """Exit state and tokens that the text adds."""
        moves, count = self.moves, 0
        for c in text:
            move = moves[state].get(c) or self._compile(state, c)
            state = move[0]
            count += move[1]
        return state, count

    def _word(self, word: str) -> int:
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        count = self.run(START, word)[1]
        if len(word) <= 48:
            self.words[word] = count
        return count

    def chunk_map(self, chunk: str) -> ChunkMap:
        """Map of a chunk; the entry state is not needed."""
        found = _BOUNDARY.search(chunk)
        if not found:
            return ChunkMap(chunk, None, 0)
        words, known = _WORD.findall(chunk, found.start() + 1), self.words
        last = words.pop()
        count = 0
        for w in words:
            n = known.get(w)
            count += self._word(w) if n is None else n
        state, more = self.run(START, last)
        return ChunkMap(chunk[: found.start() + 1], state, count + more)

    def compose(self, left: ChunkMap, right: ChunkMap) -> ChunkMap:
        """The map of both chunks; associative."""
        if left.exit is None:
            return ChunkMap(left.head + right.head, right.exit, right.emitted)
        state, count = self.run(left.exit, right.head)
        if right.exit is None:
            return ChunkMap(left.head, state, left.emitted + count)
        return ChunkMap(left.head, right.exit, left.emitted + count + right.emitted)

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """All maps as one, composed pairwise, level by level."""
        while len(maps) > 1:
            pairs = [self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[2 * len(pairs) :]
        return maps[0]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if not text:
            return 0
        if self.compiled > MAX_TRANSITIONS:
            self.reset()
        text = MARK + text.replace(" ", MARK)
        whole = self.scan([self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)])
        return self.run(START, whole.head)[1] + whole.emitted


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The transducer of a vocabulary file, once for each worker.

    Texts must reach the merges unchanged but for space marks and one mark in front; other normalizers are refused.
    """
    if path not in _COMPILED:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " ﬁＡ  é\t\n"
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the vocabulary changes texts before it splits them")
        plain = (i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
        _COMPILED[path] = Transducer({model.id_to_piece(i): model.get_score(i) for i in plain})
    return _COMPILED[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have none. Rows stay rows, repeated ones too; an empty table gives an
    empty result; other columns are ignored.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            counts = [machine.count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), "text", size).mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the piece vocabulary."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {"op2_token_counts": ready(op2_token_counts)}
ORACLES: dict[str, str] = {}
