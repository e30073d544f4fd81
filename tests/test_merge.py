"""Upsert properties."""

import datetime as dt

from helpers import plan, rows
from pyspark.sql import functions as F

from pledgeflow import session
from pledgeflow.operators import merge, money, reconcile


def _table(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, s string, v double")


def _batch(spark):
    data = [(2, "x", 1), (2, "y", 2), (3, "z", 1)]
    return spark.createDataFrame(data, "id long, s string, seq int")


def test_replace_takes_last_and_nulls_what_the_batch_lacks(spark):
    got = merge.upsert_replace(_table(spark), _batch(spark), ["id"], [F.desc("seq")])
    assert rows(got) == [(1, "a", 1.0), (2, "y", None), (3, "z", None)]


def test_replace_is_idempotent(spark):
    once = merge.upsert_replace(_table(spark), _batch(spark), ["id"], [F.desc("seq")])
    twice = merge.upsert_replace(once, _batch(spark), ["id"], [F.desc("seq")])
    assert rows(once) == rows(twice)


def test_ignore_never_changes_old_rows(spark):
    got = merge.insert_ignore(_table(spark), _batch(spark), ["id"], [F.asc("seq")])
    assert rows(got) == [(1, "a", 1.0), (2, "b", 2.0), (3, "z", None)]


def test_partial_keeps_other_columns(spark):
    batch = spark.createDataFrame([(2, "x", 9.0), (3, "z", 8.0)], "id long, s string, v double")
    assert rows(merge.upsert_partial(_table(spark), batch, "id", ["v"])) == [(1, "a", 1.0), (2, "b", 9.0), (3, "z", 8.0)]


def test_staged_empty_text_is_null(spark):
    batch = spark.createDataFrame([(2, "", 5.0)], "id long, s string, v double")
    assert rows(merge.upsert_staged(_table(spark), batch, ["id"], [F.asc("v")])) == [(1, "a", 1.0), (2, None, 5.0)]


def test_if_newer_ignores_undated_and_older(spark):
    schema = "loc string, mod string, tags array<string>"
    old = spark.createDataFrame([("a", "2", ["x"]), ("b", None, ["x"]), ("c", "2", None)], schema)
    new = spark.createDataFrame([("a", "1", ["y"]), ("b", "3", ["y"]), ("c", "3", ["y"]), ("d", None, ["y"])], schema)
    got = {r.loc: (r.mod, r.tags) for r in merge.upsert_if_newer(old, new, "loc", "mod", ["tags"]).collect()}
    assert got == {"a": ("2", ["x"]), "b": (None, ["x"]), "c": ("3", ["y"]), "d": (None, ["y"])}


def test_align_drops_extra_columns(spark, caplog):
    wide = _batch(spark).withColumn("extra", F.lit(1))
    with caplog.at_level("WARNING"):
        assert merge.align(wide, _table(spark).schema).columns == ["id", "s", "v"]
    assert "extra" in caplog.text


def test_quarantine_keeps_every_row_once(spark):
    df = spark.createDataFrame([("ok",), ("bad",), ("bad",), (None,)], "u string")
    good, bad = merge.quarantine(df, F.col("u") == "ok")
    assert rows(good) == [("ok",)]
    assert rows(bad) == [("bad",), (None,)]


def test_hot_key_is_cut_before_the_shuffle(spark, tmp_path):
    spark.range(1000).select(F.lit(1).alias("k"), "id").write.parquet(str(tmp_path / "hot"))
    df = reconcile.first_per_key(spark.read.parquet(str(tmp_path / "hot")), ["k"], [F.desc("id")])
    text = plan(df)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert rows(df) == [(1, 999)]


def test_first_match_merge_prefers_non_null_primary(spark):
    primary = spark.createDataFrame([(1, None, "p"), (2, "v", "p"), (9, "v", "p")], "id long, a string, only string")
    secondary = spark.createDataFrame([(1, "s1", 1), (1, "s2", 2), (2, "s", 1)], "id long, a string, n int")
    got = reconcile.first_match_merge(primary, secondary, "id", [F.asc("n")])
    assert rows(got.select("id", "a", "only", "n")) == [(1, "s1", "p", 1), (2, "v", "p", 1)]


def test_snapshot_of_empty_store_takes_everything(spark):
    empty = _table(spark).limit(0)
    assert merge.snapshot(empty, _table(spark), ["id", "s"]).count() == 2


def test_merge_tables_uses_each_tables_key(spark):
    tables = {"a": _table(spark), "b": _table(spark)}
    batch = spark.createDataFrame([(2, "n", 7.0)], "id long, s string, v double")
    got = merge.merge_tables(tables, {"b": batch, "a": batch}, {"a": ["id"], "b": ["id", "s"]}, first=["a"])
    assert list(got) == ["a", "b"]
    assert got["a"].count() == 2 and got["b"].count() == 3


def test_a_key_twice_in_the_batch_is_written_once(spark):
    batch = spark.createDataFrame([(1, "x", 5.0), (1, "y", 9.0), (7, "p", 1.0), (7, "q", 2.0)], "id long, s string, v double")
    partial = merge.upsert_partial(_table(spark), batch, "id", ["v"])
    assert rows(partial) == [(1, "a", 9.0), (2, "b", 2.0), (7, "q", 2.0)]
    newer = merge.upsert_if_newer(_table(spark), batch, "id", "v", [])
    assert rows(newer) == [(1, "y", 9.0), (2, "b", 2.0), (7, "q", 2.0)]


def test_snapshot_stores_a_repeated_state_once(spark):
    store = spark.createDataFrame([(1, 1, "s")], "id long, at long, v string")
    current = spark.createDataFrame([(1, 1, "t"), (2, 1, "a"), (2, 1, "b"), (2, 2, "a")], "id long, at long, v string")
    assert rows(merge.snapshot(store, current, ["id", "at"])) == [(1, 1, "s"), (2, 1, "b"), (2, 2, "a")]


def test_repeats_that_differ_in_a_map_are_ordered(spark):
    schema = "id long, m map<string,int>"
    batch = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], schema)
    for part in (batch, batch.orderBy(F.desc(F.col("m")["a"]))):
        merged = merge.merge_tables({"t": batch.limit(0)}, {"t": part}, {"t": ["id"]})
        assert rows(merged["t"]) == [(1, {"a": 2})]


def test_a_repeated_rate_does_not_multiply_facts(spark):
    facts = spark.createDataFrame([(1, 10.0, "EUR", dt.date(2020, 1, 1))], "id long, amount double, cur string, day date")
    rates = spark.createDataFrame([("EUR", dt.date(2020, 1, 1), 1.1), ("EUR", dt.date(2020, 1, 1), 1.2)], "currency string, rate_date date, usd_rate double")
    for given in (rates, money.prepared_rates(rates)):
        assert [r.amount for r in money.to_usd(facts, ["amount"], "cur", given, "day").collect()] == [12.0]


def test_scratch_removes_what_it_wrote(spark):
    with session.scratch(spark):
        kept = session.materialise(_table(spark))
        path = kept.inputFiles()[0]
        assert kept.count() == 2 and session.path_exists(spark, path)
    assert not session.path_exists(spark, path)
