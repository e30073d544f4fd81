"""Phrases against a count of all of them."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from oracle import compare, duck

from pledgeflow.llm import phrases, queries

SF = "/root/testdata/sf0.01"


def brute(documents, min_count=10, max_words=3, top=2000):
    """Rows of (lang, rank, phrase, a, l, r, n, score) for (lang, text) documents."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in documents:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        covered = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 2 * a >= counts[p[i:j]]:
                        covered.add(p[i:j])
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df, **settings):
    return sorted(map(tuple, phrases.collocations(df, **settings).collect()))


def test_query_at_sf001(spark):
    name = "op11_phrase_tiles"
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) is None


def texts():
    rng = random.Random(3)
    words = ["aé", "B", "b", "cc", "x y", "D'd", "the"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", "\n", ". "]) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return rows + [("en", None), ("en", ""), ("en", " \t\n"), ("fr", "the the the " * 4000), (None, "THE" * 50)] + [("de", "one hot line of text")] * 40


def test_against_all_phrases(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(df) == brute(rows)
    for size in (2, 4):
        assert found(df, max_words=size, min_count=12, top=15) == brute(rows, 12, size, 15)


def test_small_chunks_and_tiles_change_nothing(spark, monkeypatch):
    rows = texts()
    for name, value in (("CHUNK_BYTES", 500), ("SIDE", 2), ("HEAD", 2), ("BATCH_ROWS", 3)):
        monkeypatch.setattr(phrases, name, value)
    assert sorted(_local(rows)) == sorted(_local_brute(rows))
    assert found(spark.createDataFrame(rows, "lang string, text string")) == brute(rows)


def _local(rows):
    codes, words = phrases.word_codes("\n".join(t or "" for _, t in rows).encode())
    names = words.to_pylist()
    at = phrases._neighbours(codes)
    ids = np.arange(100, 100 + 3 * len(names), 3)
    first, second, n = phrases.tile_counts(codes[at] - 1, codes[at + 1] - 1, ids)
    return [(names[(a - 100) // 3], names[(b - 100) // 3], c) for a, b, c in zip(first.tolist(), second.tolist(), n.tolist())]


def _local_brute(rows):
    counts = Counter()
    for _, text in rows:
        for piece in re.split("[.,;:!?\n]", (text or "").lower()):
            words = re.findall("[^ \t]+", piece)
            counts.update(zip(words, words[1:]))
    return [(a, b, c) for (a, b), c in counts.items()]


def test_scores_beyond_64_bits(spark):
    """Counts whose products pass 64 bits keep exact scores."""
    from pyspark.sql import functions as F

    big = 9_000_000_000_000
    wide = [F.lit(x).cast("decimal(19,0)") for x in (big, big + 7, big + 11)]
    score = F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])
    assert spark.range(1).select(score.alias("s")).first().s == 1_000_000 * big * big // ((big + 7) * (big + 11))


def test_odd_documents(spark, odd, no_documents):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert found(odd) == brute(rows)
    assert found(no_documents) == []
