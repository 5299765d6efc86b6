"""The histogram and its sums against plain Python over all documents."""

from reclink.llm import token_histogram as h
from reclink.llm.token_histogram import length_histogram, length_quantiles, load_encoding, token_lengths, truncated_totals
from tests.llm.helpers import SMALL, documents, prose, texts


def test_histogram_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(h, "RANGE", 100)
    encoding = load_encoding()
    lengths = [len(encoding.encode_ordinary(t)) for t in texts(SMALL).values()]
    histogram = length_histogram(token_lengths(spark.read.parquet(f"{SMALL}/documents.parquet"))).cache()
    rows = {r["n_tokens"]: r for r in histogram.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for n, r in rows.items():
        assert r["documents"] == lengths.count(n) and r["tokens"] == n * lengths.count(n)
        assert r["at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
        assert r["up_to"] == sum(x <= n for x in lengths) and r["share"] == r["up_to"] / len(lengths)
    limits = [0, 1, 77, 500, 2048, 10**6]
    got = {r["context_limit"]: r for r in truncated_totals(histogram, limits).collect()}
    for limit in limits:
        assert got[limit]["truncated_total"] == sum(min(x, limit) for x in lengths)
        assert got[limit]["documents_cut"] == sum(x > limit for x in lengths)
    ordered = sorted(lengths)
    for r in length_quantiles(histogram, [0.01, 0.5, 0.9, 1.0]).collect():
        assert r["n_tokens"] == ordered[max(0, -(-int(r["share"] * 10000) * len(ordered) // 10000) - 1)]


def test_edge_cases(spark):
    long = " ".join(prose(3, 60_000, 10**6))
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (4, long), (5, "<|endoftext|>"), (6, "x" * 100_000)]
    docs = documents(spark, rows)
    encoding = load_encoding()
    got = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in token_lengths(docs).collect() if r["n_tokens"] is not None)
    assert got == sorted((d or -1, len(encoding.encode_ordinary(t))) for d, t in rows if t is not None)
    assert encoding.decode(encoding.encode_ordinary(long)) == long
    histogram = length_histogram(token_lengths(docs))
    assert sum(r["documents"] for r in histogram.collect()) == 7
    assert length_histogram(token_lengths(docs.limit(0))).count() == 0


def test_limits_over_any_histogram(spark):
    """Limits between, at, under and over the lengths, repeated ones, and an empty histogram."""
    lengths = [0, 3, 3, 7, 20]
    table = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, n_tokens long")
    limits = [0, 1, 3, 5, 7, 19, 20, 50, 5]
    got = {r["context_limit"]: (r["documents_cut"], r["truncated_total"]) for r in truncated_totals(length_histogram(table), limits).collect()}
    assert got == {x: (sum(n > x for n in lengths), sum(min(n, x) for n in lengths)) for x in limits}
    none = truncated_totals(length_histogram(table.limit(0)), [4, 9]).collect()
    assert sorted(tuple(r) for r in none) == [(4, 0, 0), (9, 0, 0)]
