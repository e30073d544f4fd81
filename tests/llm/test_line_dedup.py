"""Line dedup against a dictionary of all lines."""

import re
from collections import defaultdict

from pledgeflow.llm import line_dedup


def brute(documents, min_chars=40, min_docs=5):
    """(kept text, lines, dropped lines) for rows of (doc_id, text)."""
    def key(line):
        stripped = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)

    holders = defaultdict(set)
    rank = lambda n: float("-inf") if documents[n][0] is None else documents[n][0]
    for n, (doc_id, text) in enumerate(documents):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add((rank(n), n if doc_id is None else None))
    keeper = {k: max(held)[0] for k, held in ((k, {(r, n or 0) for r, n in h}) for k, h in holders.items()) if len(holders[k]) >= min_docs}
    out = []
    for n, (_, text) in enumerate(documents):
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or rank(n) == keeper[key(x)]]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def shown(rows):
    return sorted((repr((r.record.doc_id, r.record.text)), r.kept, r.n_lines, r.n_dropped) for r in rows)


def expected(documents, **settings):
    return sorted((repr(d), *b) for d, b in zip(documents, brute(documents, **settings)))


def test_odd_documents(odd):
    documents = [(r.doc_id, r.text) for r in odd.collect()]
    for batches, fan_out in ((1, 2), (6, 2), (5, 3)):
        got = line_dedup.dedup_lines(odd, batches=batches, fan_out=fan_out).collect()
        assert shown(got) == expected(documents)


def test_ties_and_many_drops(spark):
    line = "Ä repeated line with Ünicode letters, more than forty of them"
    text = "\n".join([line, line.replace("r", "R"), "own", line.replace("Ä", "ä")] * 3000)
    documents = [(i, text) for i in range(6)] + [(5, line), (5, None), (None, line), (-9, "x\n" + line + "\n")]
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    got = line_dedup.dedup_lines(docs).collect()
    assert shown(got) == expected(documents)


def test_all_ids_null(spark):
    documents = [(None, "a line of forty code points or even more than that" + "!" * (i % 2)) for i in range(12)]
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    assert shown(line_dedup.dedup_lines(docs).collect()) == expected(documents)


def test_rows_that_share_an_id_are_one_document(spark):
    """Five rows of two ids are two documents; five ids, some of them repeated, are five."""
    line = "a line of forty code points or even more than that"
    two = [(1, line), (1, line + "\nx"), (2, line), (2, line), (2, "y\n" + line)]
    five = [(i % 5, f"{i}\n{line}") for i in range(8)]
    for documents, dropped in ((two, 0), (five, 7)):
        got = line_dedup.dedup_lines(spark.createDataFrame(documents, "doc_id long, text string")).collect()
        assert shown(got) == expected(documents) and sum(r.n_dropped for r in got) == dropped


def test_other_bounds(spark):
    documents = [(i, f"ab\n{i}\nAB \nabc") for i in range(4)]
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    got = line_dedup.dedup_lines(docs, min_chars=2, min_docs=3).collect()
    assert shown(got) == expected(documents, min_chars=2, min_docs=3)


def test_empty_table(no_documents):
    assert line_dedup.dedup_lines(no_documents).collect() == []


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fan_out=2)
    for first in (40, 30, 20, 10):
        rows = [(first + i, ["k", f"k{first + i}", "k", None]) for i in range(3)]
        runs.add(spark.createDataFrame(rows, "id long, keys array<string>").selectExpr("*", "false as again"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    totals = {r.key: (r.n, r.keeper) for r in runs.totals().collect()}
    assert totals["k"] == (12, 42) and totals["k11"] == (1, 11) and len(totals) == 13


def test_no_python_in_the_plan(odd):
    assert "Python" not in line_dedup.dedup_lines(odd)._jdf.queryExecution().executedPlan().toString()
