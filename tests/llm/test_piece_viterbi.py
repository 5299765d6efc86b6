"""Streaming search against dynamic programming over the whole text, and exact round trips."""

import random

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from reclink.llm import piece_viterbi as pv
from reclink.llm.piece_viterbi import SPACE, Encoder, Pieces, commit, decode, decode_ids, encode_texts
from tests.llm.helpers import SMALL, documents, prose, texts

REAL = Pieces.load()


def plain(pieces, letters):
    """Ids of the best cut of all letters, equal scores to the longer last piece."""
    best = [(0.0, -1, -1)]
    for end in range(1, len(letters) + 1):
        top = None
        for start in range(max(0, end - pieces.longest), end):
            found = pieces.scores.get(letters[start:end])
            if found and (top is None or best[start][0] + found[0] > top[0]):
                top = (best[start][0] + found[0], start, found[1])
        if letters[end - 1] not in pieces.scores and (top is None or best[end - 1][0] + pieces.worst > top[0]):
            top = (best[end - 1][0] + pieces.worst, end - 1, -1)
        best.append(top)
    out, end = [], len(letters)
    while end > 0:
        _, start, number = best[end]
        out += [number] if number >= 0 else [pieces.byte_ids[b] for b in reversed(pv._bytes(letters[start]))]
        end = start
    return out[::-1]


def toy(scores):
    byte_ids = list(range(1000, 1256))
    numbered = {piece: (score, i) for i, (piece, score) in enumerate(scores.items())}
    return Pieces(numbered, byte_ids, {i: p.replace(SPACE, " ").encode() for p, (_, i) in numbered.items()} | {1000 + b: bytes([b]) for b in range(256)})


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(st.text("ab", min_size=1, max_size=5), st.integers(-6, -1).map(float), min_size=1, max_size=12),
    st.text("abc", max_size=300),
)
def test_commits_equal_the_search_over_the_whole_text(scores, letters):
    """Integer scores, so that ties are common; c is in no piece."""
    pieces = toy(scores)
    assert [i for part in commit(pieces, iter(letters)) for i in part] == plain(pieces, letters)


def test_real_pieces(spark):
    encoder = Encoder(REAL)
    for text in list(texts(SMALL).values())[:60]:
        text = text[:2500]
        assert encoder.encode(text) == plain(REAL, SPACE + text.replace(" ", SPACE))


def test_window_stays_bounded():
    """A long text without spaces is committed in many short parts, long before it ends."""
    read = 0

    def letters():
        nonlocal read
        chooser = random.Random(1)
        for _ in range(20_000):
            read += 1
            yield chooser.choice("etaoinshrdlu")

    done = 0
    for part in commit(REAL, letters()):
        done += sum(len(REAL.texts[i]) for i in part)
        assert read - done < 400
    assert done == 20_000


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_of_any_text(text):
    assert decode(REAL, Encoder(REAL).encode(text)) == text


def test_round_trip_of_hard_texts():
    encoder = Encoder(REAL)
    for text in (" ", "  ", " a", "a ", "a  b", "▁", "▁ ▁a ▁", "\r\n\t\x00", "𐍈é한", " " * 5000, "\n" * 3000, "ab" * 20_000):
        assert decode(REAL, encoder.encode(text)) == text


def test_memo_does_not_change_results(monkeypatch):
    wanted = [Encoder(REAL).encode(t) for t in list(texts(SMALL).values())[:20]]
    monkeypatch.setattr(pv, "WORD_MEMO", 3)
    encoder = Encoder(REAL)
    assert [encoder.encode(t) for t in list(texts(SMALL).values())[:20]] == wanted


def test_tables_and_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "▁ x"), (4, " ".join(prose(3, 60_000, 10**6)))]
    docs = documents(spark, rows)
    encoded = encode_texts(docs)
    got = {r["doc_id"]: r for r in encoded.collect()}
    assert (got[1]["ids"], got[1]["n_tokens"], got[1]["intact"]) == (None, None, None)
    assert (got[2]["ids"], got[2]["n_tokens"], got[2]["intact"]) == ([], 0, True)
    assert all(r["intact"] and r["n_tokens"] == len(r["ids"]) for k, r in got.items() if k != 1)
    back = sorted((r["doc_id"] or -1, r["text"] or "") for r in decode_ids(encoded).collect())
    assert back == sorted((d or -1, t or "") for d, t in rows)
    assert encode_texts(docs.limit(0)).count() == 0


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pv.MODEL)


def test_ids_of_the_table_are_the_librarys(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    wanted = {doc_id: LIBRARY.encode(text) for doc_id, text in texts(SMALL).items() if SPACE not in text}
    got = {r["doc_id"]: r for r in encode_texts(docs).collect()}
    assert len(wanted) > 100 and all(got[k]["ids"] == ids and got[k]["intact"] for k, ids in wanted.items())
    assert Encoder(REAL, merges=True).encode("The document") == [LIBRARY.piece_to_id(p) for p in ("▁The", "▁document")]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(["ab", "etaoinshrdlu", "the ", "aé한x", "0123456789"]), st.integers(0, 10**6), st.integers(1, 700))
def test_merges_of_any_word_are_the_librarys(letters, seed, size):
    text = "".join(random.Random(seed).choices(letters, k=size))
    assert Encoder(REAL, merges=True).encode(text) == LIBRARY.encode(text)


def test_merges_stay_in_a_window_and_round_trip():
    read = 0
    encoder = Encoder(REAL, merges=True)

    def letters():
        nonlocal read
        chooser = random.Random(1)
        for _ in range(20_000):
            read += 1
            yield chooser.choice("etaoinshrdlu")

    done = 0
    for part in pv.merged(REAL, letters(), encoder.follows):
        done += sum(len(REAL.texts[i]) for i in part)
        assert read - done < 400
    assert done == 20_000
    for text in (" ", "  ", " a", "a ", "a  b", "▁", "▁ ▁a ▁", "\r\n\t\x00", "𐍈é한", " " * 5000, "\n" * 3000, "ab" * 20_000):
        assert decode(REAL, encoder.encode(text)) == text


def test_ids_are_joined_and_decoded_for_many_texts_at_once():
    given = ["", " ", "a  b ", "the cat\nthe cat", "é한 ▁x", " " * 70, "word " * 50]
    encoder = Encoder(REAL, merges=True)
    packed = [encoder.packed(t) for t in given]
    assert [np.frombuffer(p, np.int32).tolist() for p in packed] == [Encoder(REAL, merges=True).encode(t) for t in given]
    values = np.frombuffer(b"".join(packed), np.int32)
    ends = np.cumsum([0] + [len(p) // 4 for p in packed])
    assert pv.decoded_equal(REAL, values, ends, given) == [True] * len(given)
    assert pv.decoded_equal(REAL, values, ends, ["x", *given[1:3], "the cat", *given[4:]]) == [False, True, True, False, True, True, True]
    assert pv.decoded_equal(REAL, values[:0], np.zeros(2, int), [""]) == [True]
