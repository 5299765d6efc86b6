"""The pipeline stage by stage against plain code, and the registry."""

import re
from collections import Counter
from pathlib import Path

import sentencepiece

import corpus_pipeline
from reclink.llm import line_crf
from reclink.llm.piece_viterbi import MODEL
from reclink.llm.queries import ORACLES, QUERIES
from reclink.session import cut
from tests.llm.helpers import MIDDLE, SMALL, documents, prose
from tests.llm.test_blob_ledger import plain as plain_secrets
from tests.llm.test_circulant_minhash import plain_classes

COLUMNS = {
    "op1_line_crf": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op2_factorisation_machine": {"doc_id", "held_out", "score", "predicted"},
    "op3_permutation_index": {"query_id", "rank", "vec_id", "score"},
    "op4_piece_viterbi": {"doc_id", "n_tokens", "ids", "intact"},
    "op5_pivotal_mix": {"doc_id", "size", "source_size", "target", "taken"},
    "op6_token_histogram": {"n_tokens", "documents", "tokens_at_least", "truncated_total"},
    "op7_blob_ledger": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op8_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_cross_parsing": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_circulant_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op11_checkpointed_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    "op12_induced_sorting": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op13_spill_counting": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "pipeline": {"doc_id", "n_tokens", "ids", "intact"},
}


def test_registry_and_columns(spark):
    assert set(QUERIES) == set(COLUMNS) and set(ORACLES) == {"op8_warc"}
    for name, columns in COLUMNS.items():
        got = QUERIES[name](spark, SMALL)
        assert columns <= set(got.columns), name
        assert got.count() > 0, name


def test_nothing_else_imports_the_folder():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("reclink/**/*.py"), *root.glob("checks/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"reclink\.llm|corpus_pipeline", path.read_text()), path


def test_stages_against_plain_code(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "secret_scan", "source_mix", "piece_encoding"]

    def step(name, frame):
        out = cut(stages[name](spark, frame, MIDDLE), name)
        if name != "piece_encoding":
            assert out.columns == docs.columns
        return out, [tuple(r) for r in out.select("doc_id", "text", "source").collect()] if name != "piece_encoding" else out.collect()

    given = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    one, rows = step("quality_rules", docs)
    model = line_crf.train(docs, labels)
    assert sorted(rows) == sorted(r for r in given if line_crf.verdict(r[1], model)["kept"])

    two, kept = step("near_duplicates", one)
    classes = plain_classes([r[:2] for r in rows], 5)
    assert sorted(kept) == sorted(r for r in rows if classes[r[0]] == r[0])

    three, clean = step("secret_scan", two)
    before = {r[0]: r[1] for r in kept}
    assert sorted(r[0] for r in clean) == sorted(before)
    for doc_id, text, _ in clean:
        if plain_secrets(before[doc_id]):
            assert not plain_secrets(text) and text != before[doc_id]
        else:
            assert text == before[doc_id] or re.search(r"\[(private_key|github|slack|jwt|google)\]", text)

    four, taken = step("source_mix", three)
    copies = Counter(taken)
    assert set(copies) <= set(clean) and set(copies.values()) <= {1, 2}
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in clean)
    mixed = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in taken)
    assert abs(mixed - 1.5 * words) < 0.1 * words

    _, encoded = step("piece_encoding", four)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = {r[0]: library.encode(r[1]) for r in taken}
    assert Counter(r["doc_id"] for r in encoded) == Counter(r[0] for r in taken)
    assert all(r["intact"] and r["ids"] == ids[r["doc_id"]] for r in encoded)


def test_run_is_all_stages(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SMALL), "stage")
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((r["doc_id"], tuple(r["ids"])) for r in docs.collect())


def test_edge_cases_of_every_stage(spark):
    body, other = " ".join(prose(5, 60)), " ".join(prose(6, 60))
    long = " ".join(prose(7, 50_000, 10**6))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, body, "en", "a"), (3, body, "en", "a"), (4, body, None, "b"), (None, body, "en", None)]
    rows += [(None, body, "en", None), (5, long, "en", "a"), (6, other + " token = abcdefghijkl", "en", "b"), (7, other, "en", "b")]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.count() == 0 and out.count() > 0, name
        if name != "piece_encoding":
            assert out.columns == docs.columns, name
    kept = corpus_pipeline.near_duplicate_removal(spark, docs, SMALL).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == [-1, -1, 1, 2, 3, 5, 6]


def test_other_texts_of_a_repeated_id_stay(spark):
    one, two, three = (" ".join(prose(seed, 60)) for seed in (11, 12, 13))
    rows = [(1, one), (2, two), (2, three), (2, three), (3, one + " end"), (3, two + " end"), (3, None), (4, three)]
    kept = corpus_pipeline.near_duplicate_removal(spark, documents(spark, rows), SMALL).collect()
    got = Counter(r["text"] for r in kept)
    assert got[one] == 1 and got[None] == 1 and len(kept) == 4
    assert sum(got[t] for t in (two, two + " end")) == 1 and got[three] == 1
    assert {r["doc_id"] for r in kept if r["text"] is None} == {3}
