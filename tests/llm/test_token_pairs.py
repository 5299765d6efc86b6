"""Alignment of two tokenizers against plain code over all pairs of tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from reclink.llm import token_pairs as m
from tests.llm.helpers import SMALL, documents, texts

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"


def byte_letters():
    """Bytes of the letters that a byte-level vocabulary is written in."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain(rows):
    first = Tokenizer.from_file(BYTE_MODEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=m.MODEL)
    letters = byte_letters()

    def piece_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if piece.startswith("<0x") else piece.replace("▁", " ").encode()

    found = []
    for doc_id, text in rows:
        groups = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            b = second.encode(text)
            b_bytes = [piece_bytes(i) for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
                ends = [np.cumsum([len(t) for t in side]).tolist() for side in (a_bytes, b_bytes)]
                common = sorted(set(ends[0]) & set(ends[1]))
                group_of = {e: g for g, e in enumerate(common)}
                groups = [([], []) for _ in common]
                for side, ids in enumerate((a, b)):
                    g = 0
                    for i, e in zip(ids, ends[side]):
                        groups[g][side].append(i)
                        g += e in group_of
        found.append((doc_id, groups))
    count = Counter()
    for _, groups in found:
        count.update({(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, groups in found:
        links = [(x, y) for a, b in groups for x in a for y in b]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(1 for x, y in links if count[x, y] == most[x]),
                sum(count[p] for p in links),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


def check(spark, rows):
    got = m.aligned(documents(spark, rows))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n"), (5, "a ▁ mark"), (6, "<|endoftext|> </s> <s> <0x41>"), (7, "日本語のテキスト😀"), (8, "é́ ß \x00 \t"),
    (8, "the same again"), (8, "the same again"), (None, "the same again"), (None, None), (9, "=" * 700 + " 1234567890" * 30), (10, "नमस्ते " * 40),
]


def test_small_table(spark):
    check(spark, list(texts(SMALL).items()))


def test_odd_texts(spark):
    check(spark, ODD)
    assert m.aligned(documents(spark, ODD).limit(0)).count() == 0


def test_many_spills_and_large_groups(spark, monkeypatch):
    """Small buffers, few ways and groups counted by distinct ids give the same rows."""
    monkeypatch.setattr(m, "SPILL_RECORDS", 40)
    monkeypatch.setattr(m, "WAYS", 2)
    monkeypatch.setattr(m, "LISTED", 3)
    check(spark, ODD + [(100 + i, t) for i, t in enumerate(list(texts(SMALL).values())[:60])])


def test_count_table(spark):
    rows = [(1, "one two"), (2, "two three"), (3, "two two")]
    runs = m.spilled(documents(spark, rows)).where("radix is not null")
    found = m.count_table(m.pair_counts(runs)).collect()
    assert max(r["documents"] for r in found) == 3
    assert all(r["best"] for r in found if r["documents"] == 3)
    assert len({(r["first_id"], r["second_id"]) for r in found}) == len(found)
