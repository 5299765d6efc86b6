"""SentencePiece encoding and decoding by a streaming search.

A text is cut into the pieces that the merges of the model give (`merged`), or into those of the greatest total score
(`commit`). Either search keeps only the boundaries that a next piece can still start from, at most as many as the longest
piece has letters. When the paths to all of them go through one boundary, everything before it is final and its ids are
committed.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclink.llm.common import BATCH_ROWS

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# The mark that stands for a space, and the letters that are read, beside the longest piece, between two commits.
SPACE = "▁"
LOOK = 32

# A letter that no piece holds scores so much below the worst piece, and becomes its bytes.
PENALTY = 10.0

# Words whose ids a worker keeps in each of two generations, and the longest word kept.
WORD_MEMO = 1 << 17
MEMO_LETTERS = 64

# Pairs of neighbouring pieces of long words whose merges a worker remembers.
PAIR_MEMO = 1 << 16


@dataclass
class Pieces:
    """Piece scores and ids, the ids of the 256 bytes, and the pieces by id; tree leads letter by letter to the pieces,
    by_id holds their bytes for decoding many ids at once."""

    scores: dict[str, tuple[float, int]]
    byte_ids: list[int]
    texts: dict[int, bytes]
    longest: int = field(init=False)
    worst: float = field(init=False)
    tree: dict = field(init=False)
    by_id: pa.LargeBinaryArray = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.scores), default=1)
        self.worst = min((s for s, _ in self.scores.values()), default=0.0) - PENALTY
        self.tree = {}
        for piece, found in self.scores.items():
            node = self.tree
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = found
        self.by_id = pa.array([self.texts.get(i) for i in range(max(self.texts, default=-1) + 1)], pa.large_binary())

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        """The pieces of a SentencePiece model file that has a piece for each byte."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids, texts = {}, [0] * 256, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                texts[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores[piece] = (model.get_score(i), i)
                texts[i] = piece.replace(SPACE, " ").encode()
        return Pieces(scores, byte_ids, texts)

    @property
    def words_apart(self) -> bool:
        """No piece goes on from a letter to a space, so no piece spans the start of a word."""
        return not any(SPACE in piece.lstrip(SPACE) for piece in self.scores)


def commit(pieces: Pieces, letters: Iterator[str]) -> Iterator[list[int]]:
    """Ids of a stream of letters, in the lists in which they become final.

    total[i], start[i] and number[i] describe the best path to boundary i of the window: its score, where its last piece
    starts and the piece's id. Pieces are tried from each boundary in turn, once the letters of the longest one are there.
    Then only boundaries from the next one on can be on the final path. Walking back from all of them, always from the
    latest, the paths meet at the boundary on which all agree; what lies before it is committed and leaves the window.
    Equal scores go to the longer last piece.
    """
    tree, longest, worst = pieces.tree, pieces.longest, pieces.worst
    never = -float("inf")
    window: list[str] = []
    total, start, number = [0.0], [-1], [-1]
    at, ended = 0, False
    while not ended:
        more = list(islice(letters, longest + LOOK))
        ended = len(more) < longest + LOOK
        window += more
        total += [never] * len(more)
        start += [-1] * len(more)
        number += [-1] * len(more)
        size = len(window)
        for at in range(at, size if ended else size - longest + 1):
            base = total[at]
            node = tree
            alone = True
            for end in range(at, size):
                node = node.get(window[end])
                if node is None:
                    break
                found = node.get("")
                if found is not None:
                    alone = alone and end > at
                    if base + found[0] > total[end + 1]:
                        total[end + 1], start[end + 1], number[end + 1] = base + found[0], at, found[1]
            if alone and base + worst > total[at + 1]:
                total[at + 1], start[at + 1], number[at + 1] = base + worst, at, -1
        if ended:
            yield _ids(pieces, window, start, number, size)
        else:
            at = size - longest + 1
            cut = _agreed(start, {b for b in range(at, size + 1) if start[b] >= 0})
            if cut:
                yield _ids(pieces, window, start, number, cut)
                base = total[cut]
                window = window[cut:]
                total = [t - base for t in total[cut:]]
                start = [-1] + [max(-1, s - cut) for s in start[cut + 1 :]]
                number = number[cut:]
                at -= cut


def merge(pieces: Pieces, letters: str) -> list[str]:
    """Parts of some letters after all merges: of the neighbours that make a piece, those of the greatest score join first,
    the leftmost ones at equal scores. A part that is no piece is a single letter."""
    scores, never = pieces.scores, (-float("inf"), -1)
    parts = list(letters)
    ranks = [scores.get(a + b, never)[0] for a, b in zip(parts, parts[1:])]
    while ranks:
        best = max(ranks)
        if best == never[0]:
            break
        i = ranks.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = scores.get(parts[i] + parts[i + 1], never)[0]
        if i:
            ranks[i - 1] = scores.get(parts[i - 1] + parts[i], never)[0]
    return parts


def merged(pieces: Pieces, letters: Iterator[str], follows: Callable[[str, str], bool]) -> Iterator[list[int]]:
    """Ids of the merges of a stream of letters, in the lists in which they become final.

    A row of pieces is what the merges of its letters give if and only if this holds for each two neighbours, which
    `follows` tells. So of the pieces that end at a boundary just one can follow the piece before it: the path to each
    boundary is what the merges of the letters up to there give. Paths are committed as in `commit`.
    """
    tree, longest = pieces.tree, pieces.longest
    window: list[str] = []
    start, number, last = [-1], [-1], [""]
    at, ended = 0, False
    while not ended:
        more = list(islice(letters, longest + LOOK))
        ended = len(more) < longest + LOOK
        window += more
        start += [-1] * len(more)
        number += [-1] * len(more)
        last += [""] * len(more)
        size = len(window)
        for at in range(at, size if ended else size - longest + 1):
            before, node, piece = last[at], tree, ""
            for end in range(at, size):
                piece += window[end]
                node = node.get(window[end]) if node is not None else None
                found = node.get("") if node is not None else None
                if (found is not None or end == at) and start[end + 1] < 0 and follows(before, piece):
                    start[end + 1], number[end + 1], last[end + 1] = at, -1 if found is None else found[1], piece
                if node is None:
                    break
        if ended:
            yield _ids(pieces, window, start, number, size)
        else:
            at = size - longest + 1
            cut = _agreed(start, {b for b in range(at, size + 1) if start[b] >= 0})
            if cut:
                yield _ids(pieces, window, start, number, cut)
                window, number, last = window[cut:], number[cut:], last[cut:]
                start = [-1] + [max(-1, s - cut) for s in start[cut + 1 :]]
                at -= cut


def _agreed(start: list[int], ends: set[int]) -> int:
    """The latest boundary that the best paths to all of the ends go through."""
    while len(ends) > 1:
        last = max(ends)
        ends.remove(last)
        ends.add(start[last])
    return ends.pop()


def _ids(pieces: Pieces, window: list[str], start: list[int], number: list[int], end: int) -> list[int]:
    found: list[int] = []
    while end > 0:
        if number[end] >= 0:
            found.append(number[end])
        else:
            found += [pieces.byte_ids[b] for b in reversed(_bytes(window[start[end]]))]
        end = start[end]
    return found[::-1]


# A mark that the text itself holds is kept apart from the spaces it would look like: in the lattice it is this letter,
# which no text can hold, and it becomes the bytes of the mark.
MARK = "\udc81"


def _bytes(letter: str) -> bytes:
    return (SPACE if letter == MARK else letter).encode()


class Encoder:
    """Ids of whole texts: of the greatest total score, or, if merges is set, those that the merges give.

    Short words are searched once and remembered; their number is bounded.

    When the words of a generation are full, it becomes the older one and the one before is forgotten. Words still in use
    move up, so frequent words are never forgotten.
    """

    def __init__(self, pieces: Pieces, merges: bool = False):
        self.pieces = pieces
        self.merges = merges
        self.follows = lru_cache(maxsize=PAIR_MEMO)(self._follows)
        self.apart = pieces.words_apart
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> list[int]:
        """Ids of a text, with a space put in front. Empty texts have none."""
        return array("i", self.packed(text)).tolist()

    def packed(self, text: str) -> bytes:
        """The ids as the integers of `array("i")`, so that those of remembered words are joined without touching each."""
        if not text:
            return b""
        if SPACE in text:
            text = text.replace(SPACE, MARK)
        if not self.apart:
            return array("i", self._search(SPACE + text.replace(" ", SPACE))).tobytes()
        # No piece spans the start of a word, so all paths agree there. A run of spaces stays with the word after it.
        words = _spaced(text)
        found = list(map(self.memo.get, words))
        if None in found:
            found = [self._word(word) if ids is None else ids for word, ids in zip(words, found)]
        return b"".join(found)

    def _word(self, word: str) -> bytes:
        """Ids of a word, remembered if it is short."""
        ids = self.memo.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = array("i", self._search(SPACE + word)).tobytes()
            if len(word) < MEMO_LETTERS:
                if len(self.memo) >= WORD_MEMO:
                    self.older, self.memo = self.memo, {}
                self.memo[word] = ids
        return ids

    def _search(self, letters: str) -> list[int]:
        if self.merges and len(letters) <= MEMO_LETTERS:
            return [i for part in merge(self.pieces, letters) for i in self._part(part)]
        if self.merges:
            return [i for part in merged(self.pieces, iter(letters), self.follows) for i in part]
        return [i for part in commit(self.pieces, iter(letters)) for i in part]

    def _part(self, part: str) -> list[int]:
        found = self.pieces.scores.get(part)
        return [found[1]] if found else [self.pieces.byte_ids[b] for b in _bytes(part)]

    def _follows(self, before: str, piece: str) -> bool:
        return merge(self.pieces, before + piece) == ([before, piece] if before else [piece])


@lru_cache(maxsize=1)
def _encoder(path: str, merges: bool) -> Encoder:
    """One encoder for all tasks of a worker: the model is loaded once, and words are remembered from task to task."""
    return Encoder(Pieces.load(path), merges)


def _spaced(text: str) -> list[str]:
    """Words with the marks of the spaces before them, but one; one space stands before the text."""
    words = text.split(" ")
    if "" not in words:
        return words
    out, spaces = [], 0
    for word in words:
        if word:
            out.append(SPACE * spaces + word)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(SPACE * (spaces - 1))
    return out


def decode(pieces: Pieces, ids: list[int]) -> str:
    """The text of a list of ids: their bytes joined, without the space put in front."""
    texts = pieces.texts
    return b"".join([texts[i] for i in ids])[1:].decode("utf-8", "replace") if ids else ""


def decoded_equal(pieces: Pieces, values: np.ndarray, ends: np.ndarray, texts: list[str]) -> list[bool]:
    """Whether the ids from each end to the next decode to the text; the pieces of all ids are gathered at once."""
    joined = pieces.by_id.take(pa.array(values))
    places = np.frombuffer(joined.buffers()[1], np.int64)[: len(values) + 1] if len(values) else np.zeros(1, np.int64)
    whole = joined.buffers()[2].to_pybytes() if len(values) else b""
    edges = places[ends].tolist()
    # The first byte is the space put in front; a text without ids has none.
    return [whole[a + 1 : b].decode("utf-8", "replace") == t for a, b, t in zip(edges, edges[1:], texts)]


def encode_texts(docs: DataFrame, path: str = MODEL, check: bool = True, merges: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, intact) of every row of docs. One scan, no shuffle; each worker loads the model file once.

    ids are those that the merges of the model give, or, if merges is off, those of the greatest total score. intact tells
    whether decoding the ids gives back the text; it is null if check is off.

    Edge cases: an empty text has no ids; a null text has null ids and null counts. A text may hold any character, the
    space mark too: what no piece covers becomes its bytes, and every text is restored exactly. Long texts and words
    without a space are searched in a window of bounded length. Null ids of documents stay null, repeated rows get equal
    results, other columns are not read, and an empty table gives an empty result.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, merges)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [encoder.packed(t or "") for t in texts]
            values = np.frombuffer(b"".join(found), np.int32)
            ends = np.cumsum([0] + [len(f) for f in found]) // values.itemsize
            missing = np.array([t is None for t in texts], bool)
            intact = [None] * len(texts)
            if check:
                same = decoded_equal(encoder.pieces, values, ends, [t or "" for t in texts])
                intact = [None if t is None else s for t, s in zip(texts, same)]
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=pa.array(missing))
            counts = pa.array(np.diff(ends), pa.int64(), mask=missing)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, ids, pa.array(intact, pa.bool_())], names=["doc_id", "n_tokens", "ids", "intact"]
            )

    read = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return read.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, intact boolean")


def decode_ids(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows with ids; null ids give a null text. One scan, no shuffle."""
    encoded.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(path, True).pieces
        for batch in batches:
            texts = [None if ids is None else decode(pieces, ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
