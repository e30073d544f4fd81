"""SimHash components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pledgeflow.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    """Smallest index reachable from each fingerprint by links."""
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["A", "b", "É", "é", "word", " ", "\n", "\x1c", " "]), max_size=30).map(" ".join))
def test_fingerprint_of_any_text(text):
    assert int.from_bytes(simhash.fingerprint(text.encode()), "big") == brute_print(text)


def test_hashes_in_several_turns(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    text = " ".join(str(i * i) for i in range(100))
    assert int.from_bytes(simhash.fingerprint(text.encode()), "big") == brute_print(text)


def test_query(spark):
    rows = sorted(queries.QUERIES["op8_simhash_pivots"](spark, SF).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    prints = [brute_print(texts[i]) for i in ids]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == [ids[r] for r in brute_groups(prints)]


def test_odd_documents(odd):
    rows = simhash.near_duplicates(odd, passed=("text", "row")).collect()
    assert len(rows) == odd.count()
    prints = [brute_print(r.kept.text) for r in rows]
    assert [r.print % (1 << 64) for r in rows] == prints
    groups = brute_groups(prints)
    for r, group in zip(rows, groups):
        keys = [x.kept.doc_id for x, g in zip(rows, groups) if g == group and x.kept.doc_id is not None]
        assert r.component_id == (min(keys) if keys else None)
    one_each = simhash.representatives(odd).collect()
    assert len(one_each) == len(set(groups))
    assert {r.doc_id for r in one_each} == {r.component_id for r in rows}
    assert one_each[0].asDict().keys() == odd.first().asDict().keys()


def test_empty_table(no_documents):
    assert simhash.near_duplicates(no_documents).collect() == []
    assert simhash.representatives(no_documents).collect() == []


@pytest.mark.parametrize("crowded", [2, 30, 1 << 10])
def test_dense_and_scattered_groups(spark, monkeypatch, crowded):
    """Balls of near fingerprints, chains through them, and random ones, for every key length and size of a crowd."""
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(7)

    def near(value, bits):
        return value ^ sum(1 << b for b in rng.sample(range(64), bits))

    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {near(c, rng.randint(0, 5)) for c in centres[:2] for _ in range(120)}
    chain = [centres[2]]
    for _ in range(40):
        chain.append(near(chain[-1], rng.randint(3, 5)))
    prints = sorted(prints | set(chain) | {rng.getrandbits(64) for _ in range(100)} | {0, 7, 1 << 63})
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    want = brute_groups(prints)
    for agree in (1, 2, 3) if crowded > 2 else (2,):
        found = simhash.components(simhash.links(frame, agree=agree)).collect()
        root = {r.node: r.root for r in found}
        assert len(root) == len(found)
        got = [root.get(r[0], r[0]) for r in frame.collect()]
        pairs = set(zip(want, got))
        assert len(pairs) == len(set(want)) == len(set(got))


def test_a_crowded_key_is_spread(spark, monkeypatch):
    """Members that agree on half of their bits are met under longer keys in many tasks, and none of their links is lost."""
    rng = random.Random(11)
    prints = {0xABCD1234 << 32 | rng.getrandbits(32) for _ in range(3000)}
    prints |= {p ^ 1 << rng.randrange(32) for p in list(prints)[:200]}
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64),) for p in prints], "print long")
    first = simhash._met(frame, 4, 2, False)
    left = first.filter("b is null").select("a").distinct().count()
    assert left == len(prints) and first.filter("b is not null").count() < 40 * len(prints)
    values = np.array(prints, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 4) for v in values]
    root = {r.node: r.root for r in simhash.components(simhash.links(frame, agree=2)).collect()}
    signed = values.view(np.int64).tolist()
    for v, others in zip(signed, near):
        assert all(root.get(signed[o], signed[o]) == root.get(v, v) for o in others)
    assert len(set(root.values())) == len({brute for brute in _roots(near)} - {i for i, o in enumerate(near) if len(o) == 1})


def _roots(near):
    root = list(range(len(near)))
    changed = True
    while changed:
        new = [min(root[o] for o in others) for others in near]
        changed, root = new != root, new
    return root


def test_masks_leave_no_link_out():
    rng = np.random.default_rng(3)
    for agree in (1, 2, 3, 4):
        masks = simhash.block_masks(4, agree)
        for _ in range(200):
            differing = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(differing & mask == 0 for mask in masks)


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 100: 99}
