"""Language identification by cross-parsing entropy.

A text is parsed into the fewest phrases that occur in a sample of a language (Ziv and Merhav, 1993): each phrase is the
longest match from where the last one ended. A suffix automaton of the sample reads a phrase letter by letter. The language
whose sample needs the fewest phrases, each weighed by the bits that name a place in the sample, wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reclink.llm.common import crc_fold, map_rows

FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"

# Bounds of the sample of a language, in texts and characters. The automaton has at most twice as many states, which
# 16 bits must number.
SAMPLE_TEXTS = 64
SAMPLE_CHARS = 12_000

# Different letters that the automata tell apart; the rarer ones count as one letter that no sample holds.
LETTERS = 126
SPACE, STRANGE = 0, 1

# Phrases end at every so many letters, so that the pieces of a long text are parsed side by side; letters parsed at once.
PIECE = 4096
TOGETHER = 1 << 21


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """The lower case of each letter of the basic plane, a space for all other characters."""
    folded = np.full(0x10000, 32, np.uint32)
    for code in range(0x10000):
        character = chr(code)
        if character.isalpha():
            lowered = character.lower()
            folded[code] = ord(lowered) if len(lowered) == 1 else code
    return folded


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters of a whole text, a single space for each run of others between them; empty without a letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
    high = codes >= 0x10000
    read = _folded()[np.minimum(codes, 0xFFFF)]
    if high.any():
        for i in np.flatnonzero(high):
            read[i] = codes[i] if chr(codes[i]).isalpha() else 32
    gap = read == 32
    read = read[~(gap & np.concatenate([[True], gap[:-1]]))] if len(read) else read
    return read[:-1] if len(read) and read[-1] == 32 else read


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Moves of the suffix automaton of a sequence, as a table of states by symbols; 0 stands for no move, 1 is the start."""
    limit = 2 * len(symbols) + 2
    moves = np.zeros((limit, width), np.uint16)
    link, depth = [0] * limit, [0] * limit
    count, last = 2, 1
    for symbol in symbols:
        state, count = count, count + 1
        depth[state] = depth[last] + 1
        at = last
        while at and not moves[at, symbol]:
            moves[at, symbol] = state
            at = link[at]
        if not at:
            link[state] = 1
        else:
            target = int(moves[at, symbol])
            if depth[target] == depth[at] + 1:
                link[state] = target
            else:
                copy, count = count, count + 1
                moves[copy] = moves[target]
                depth[copy], link[copy] = depth[at] + 1, link[target]
                while at and moves[at, symbol] == target:
                    moves[at, symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves[:count]


@dataclass
class LanguageModel:
    """Names, the alphabet, the sample lengths, and the moves of all automata below each other.

    moves[row, symbol] is the row of the next state, or -1; starts has the row of each automaton's start.
    """

    names: list[str]
    alphabet: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    moves: np.ndarray

    def symbols(self, read: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.full(len(read), STRANGE, np.uint8)
        at = np.minimum(np.searchsorted(self.alphabet, read), len(self.alphabet) - 1)
        return np.where(read == 32, SPACE, np.where(self.alphabet[at] == read, at + 2, STRANGE)).astype(np.uint8)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each sequence of symbols needs, a row for each text and a column for each language.

        All texts and languages step through their automata together, the longest texts in front; a text leaves when it
        ends. A symbol that starts no phrase is one by itself.
        """
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        sizes = np.array([len(texts[i]) for i in order])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate([texts[i] for i in order]).astype(np.int32) if len(order) else np.empty(0, np.int32)
        width, langs = self.moves.shape[1], len(self.names)
        moves = self.moves.ravel()
        state = np.tile(self.starts, (len(texts), 1))
        counts = np.ones((len(texts), langs), np.int64) * (sizes > 0)[:, None]
        alive = len(texts)
        for t in range(int(sizes[0]) if len(order) else 0):
            while sizes[alive - 1] <= t:
                alive -= 1
            symbol = flat[starts[:alive] + t][:, None]
            now = state[:alive]
            after = moves[now * width + symbol]
            ended = after < 0
            if ended.any():
                # A new phrase begins with this symbol, unless the one that ended is empty.
                counts[:alive] += ended & (now != self.starts)
                again = moves[(self.starts * width + symbol)]
                lone = again < 0
                after = np.where(ended, again, after)
                if lone.any():
                    # The symbol is a phrase by itself; the next one begins after it, if there is a next symbol.
                    alone = ended & lone
                    counts[:alive] += alone & (sizes[:alive] > t + 1)[:, None]
                    after = np.where(alone, self.starts, after)
            state[:alive] = after
        out = np.empty_like(counts)
        out[order] = counts
        return out

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of whole texts, parsed in pieces of PIECE letters."""
        pieces, owners = [], []
        for i, text in enumerate(texts):
            for start in range(0, len(text), PIECE):
                pieces.append(text[start : start + PIECE])
                owners.append(i)
        out = np.zeros((len(texts), len(self.names)), np.int64)
        np.add.at(out, np.array(owners, np.int64), self.phrases(pieces))
        return out

    def decide(self, counts: np.ndarray, size: int) -> tuple[str, float]:
        """The language of the least cost in bits, ties by name, and its share among all languages by cost per letter."""
        if not size or not self.names:
            return UNDETERMINED, 0.0
        bits = counts * np.log2(self.lengths + 2)
        best = int(np.argmin(bits))
        gaps = (bits - bits[best]) / math.sqrt(size)
        return self.names[best], float(1 / np.exp2(-gaps).sum())


def build(samples: dict[str, str]) -> LanguageModel:
    """Automata of the sample texts of each language, by name."""
    names = sorted(name for name, text in samples.items() if len(letters(text)))
    read = {name: letters(samples[name]) for name in names}
    codes, counts = np.unique(np.concatenate([*read.values(), np.empty(0, np.uint32)]), return_counts=True)
    known = codes != 32
    codes, counts = codes[known], counts[known]
    alphabet = np.sort(codes[np.lexsort((codes, -counts))[:LETTERS]])
    model = LanguageModel(names, alphabet, np.array([len(read[n]) for n in names]), np.empty(0, np.int64), np.empty((0, 0)))
    tables, starts, at = [], [], 0
    for name in names:
        moves = suffix_automaton(model.symbols(read[name]).tolist(), len(alphabet) + 2).astype(np.int32)
        moves[:, STRANGE] = 0
        tables.append(np.where(moves > 0, moves + at, -1).astype(np.int32))
        starts.append(at + 1)
        at += len(moves)
    model.starts = np.array(starts, np.int32)
    model.moves = np.concatenate(tables) if tables else np.full((1, 2), -1, np.int32)
    return model


def train(docs: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Automata of a bounded sample of every language that rows outside the held-out fold name.

    Of each language the `texts` smallest text hashes are drawn, each hash once, so that copies of one text do not fill the
    sample. Hashes are counted and ranked in the executors before any text moves, and the chosen texts, cut to `chars`
    characters, meet their hashes in one scan. At most texts * chars characters of each language come to the driver, where
    the first `chars` of each language's sample build its automaton.
    """
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where((crc_fold(FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & (F.length("text") > 0))
    hashed = known.select("lang", "text", F.xxhash64("text").alias("mark"))
    marks = hashed.groupBy("lang", "mark").agg(F.count("*").alias("_n"))
    ranked = marks.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("mark")))
    chosen = ranked.where(F.col("_rank") <= texts).select("lang", "mark")
    drawn = hashed.join(F.broadcast(chosen), ["lang", "mark"]).select("lang", "mark", F.substring("text", 1, chars).alias("text"))
    rows = sorted({(r["lang"], r["mark"], r["text"]) for r in drawn.distinct().collect()})
    samples: dict[str, str] = {}
    for lang, _, text in rows:
        samples[lang] = (samples.get(lang, "") + " " + text)[: chars + 1]
    return build(samples)


def languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of docs. One scan; the automata are broadcast.

    A worker parses texts together until they have TOGETHER letters, whole, in memory of a few times their letters.

    Edge cases: a null text, or one without a letter, is `und` with score 0, as is every text if no language was learned.
    Ties go to the language that comes first by name. Null ids stay null, with a null held_out; repeated rows get equal
    results; other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select("doc_id", (crc_fold(FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        automata = shared.value

        def told(held: list[tuple[dict, np.ndarray]]) -> Iterator[dict]:
            for (row, text), counts in zip(held, automata.costs([x for _, x in held])):
                name, score = automata.decide(counts, len(text))
                yield {"doc_id": row["doc_id"], "held_out": row["held_out"], "lang_pred": name, "score": score}

        held, total = [], 0
        for row in rows:
            held.append((row, automata.symbols(letters(row.pop("text")))))
            total += len(held[-1][1])
            if total >= TOGETHER:
                yield from told(held)
                held, total = [], 0
        yield from told(held)

    return map_rows(read, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
