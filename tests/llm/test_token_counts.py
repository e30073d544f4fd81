"""The length histogram against sums over the documents themselves."""

from pledgeflow.llm import byte_bpe, queries, token_counts

SF = "/root/testdata/sf0.001"
LIBRARY = token_counts._encoding(byte_bpe.RANKS)


def brute(lengths):
    out = {}
    for limit in set(lengths):
        within = [n for n in lengths if n <= limit]
        beyond = [n for n in lengths if n > limit]
        cut = sum(min(n, limit) for n in lengths)
        out[limit] = (lengths.count(limit), len(within), sum(within), len(beyond), sum(beyond), cut, len(within) / len(lengths))
    return out


def as_dict(histogram):
    columns = ("docs", "docs_within", "tokens_within", "docs_beyond", "tokens_beyond", "truncated_tokens", "quantile")
    return {r.n_tokens: tuple(r[c] for c in columns) for r in histogram.collect()}


def test_query(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lengths = [len(LIBRARY.encode_ordinary(t or "")) for t in texts]
    assert as_dict(queries.QUERIES["op4_token_counts"](spark, SF)) == brute(lengths)


def test_odd_documents_over_blocks(odd, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 8)
    counted = token_counts.encoded_lengths(odd)
    lengths = [len(LIBRARY.encode_ordinary(r.text or "")) for r in odd.collect()]
    histogram = token_counts.length_histogram(counted)
    assert as_dict(histogram) == brute(lengths)
    limits = [0, 1, 10, 1000, 10**6]
    for r in token_counts.truncated_totals(histogram, limits).collect():
        whole = sum(n <= r.limit for n in lengths)
        assert (r.whole_docs, r.cut_docs, r.tokens) == (whole, len(lengths) - whole, sum(min(n, r.limit) for n in lengths))
    ordered = sorted(lengths)
    for r in token_counts.length_quantiles(histogram, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == next(n for n in ordered if sum(m <= n for m in lengths) / len(lengths) >= r.share)


def test_empty_table(no_documents):
    assert as_dict(token_counts.length_histogram(token_counts.encoded_lengths(no_documents))) == {}
