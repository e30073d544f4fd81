"""Running totals, row numbers and buckets, with a hot key and tiny blocks."""

from helpers import plan, rows
from pyspark.sql import functions as F

from pledgeflow import session
from pledgeflow.operators import ordering, topk
from pledgeflow.sources import fetchlog

# 300 rows, a third of them under one key


def _skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return spark.range(300).select(key.alias("k"), (F.col("id") * 37 % 301).alias("pos"), "id")


def test_row_number_within_hot_key(spark):
    got = rows(ordering.running_total(_skewed(spark), ["pos"], ["k"]).select("k", "pos", "row_number"))
    groups = {}
    for k, pos, _ in [tuple(r) for r in _skewed(spark).collect()]:
        groups.setdefault(k, []).append(pos)
    want = sorted(((k, p, i + 1) for k, ps in groups.items() for i, p in enumerate(sorted(ps))), key=repr)
    assert got == want


def test_global_running_total_with_weights(spark):
    df = ordering.running_total(_skewed(spark), ["pos"], weight=F.col("id"), out="total")
    data = sorted((r.pos, r.id) for r in _skewed(spark).collect())
    total, want = 0, []
    for pos, value in data:
        total += value
        want.append((pos, total))
    assert sorted((r.pos, r.total) for r in df.collect()) == want


def test_previous_value_skips_nulls_and_crosses_blocks(spark):
    df = _skewed(spark).withColumn("v", F.when(F.col("pos") % 50 == 0, F.col("pos")))
    got = {(r.k, r.pos): r.before for r in ordering.previous_value(df, "v", ["pos"], ["k"], "before").collect()}
    last = {}
    for k, pos in sorted((r.k, r.pos) for r in df.collect()):
        assert got[(k, pos)] == last.get(k)
        if pos % 50 == 0:
            last[k] = pos


def test_balanced_parts_match_slicing(spark):
    for n_rows, parts in ((6, 4), (10, 3), (3, 5), (7, 7)):
        df = ordering.balanced_parts(spark.range(n_rows), "id", parts)
        got = [r.part for r in df.orderBy("id").collect()]
        want = [p for p in range(parts) for _ in range(p * n_rows // parts, (p + 1) * n_rows // parts)]
        assert got == want


def test_chunks_and_round_robin(spark):
    df = spark.range(100, 110)
    assert [r.chunk for r in ordering.fixed_chunks(df, "id", 4).orderBy("id").collect()] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert [r.bucket for r in ordering.round_robin(df, "id", 3).orderBy("id").collect()] == [0, 1, 2, 0, 1, 2, 0, 1, 2, 0]


def test_skip_first(spark):
    assert [r.id for r in ordering.skip_first(spark.range(10, 20), "id", 7).orderBy("id").collect()] == [17, 18, 19]


def test_fold_runs_drops_rows_before_first_start(spark):
    data = [("f", 1, "x"), ("f", 2, "open"), ("f", 3, "a"), ("f", 4, None), ("f", 5, "open"), ("g", 1, "open")]
    df = spark.createDataFrame(data, "file string, n long, what string")
    got = ordering.fold_runs(df, "file", ["n"], F.col("what").eqNullSafe("open"), F.col("what"), keep=["what"])
    assert rows(got.select("file", "run", "started", "chain", "pieces")) == [
        ("f", 1, 2, "open > a", 2),
        ("f", 2, 5, "open", 1),
        ("g", 1, 1, "open", 1),
    ]


def test_endless_run_is_folded_in_segments(spark):
    """A run without a next start is cut into segments of bounded size, whose chains join to the whole."""
    lines = spark.range(5000).select(F.lit("f").alias("file"), "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("p"), "id")).alias("what"))
    lines = lines.unionByName(lines.filter("id < 40").withColumn("file", F.lit("g")))
    opens = F.col("id").isin(0, 30)
    segments = ordering.fold_segments(lines.filter("file = 'f' and id <> 30"), "file", ["id"], opens, F.col("what"), ["what"], size=100).collect()
    assert max(r.pieces for r in segments) == 100 and sum(r.pieces for r in segments) == 3333
    assert {(r.run, r.file) for r in segments} == {(1, "f")} and min(r.first.id for r in segments) == 0
    got = {(r.file, r.run): r for r in ordering.fold_runs(lines, "file", ["id"], opens, F.col("what"), ["id"], size=7).collect()}
    pieces = lambda ids: " > ".join(f"p{i}" for i in ids if i % 3)
    want = {("f", 1): range(30), ("f", 2): range(30, 5000), ("g", 1): range(30), ("g", 2): range(30, 40)}
    assert {k: (r.started, r.id, r.chain) for k, r in got.items()} == {k: (v[0], v[0], pieces(v)) for k, v in want.items()}


def _brute(data, by, order, value=None):
    """Row numbers and last earlier values by position; NULLs first."""
    out, last, count = {}, {}, {}
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[c] for c in order))
    for r in sorted(data, key=key):
        group = tuple(r[c] for c in by)
        count[group] = count.get(group, 0) + 1
        out[r["id"]] = (count[group], last.get(group))
        if value and r[value] is not None:
            last[group] = r[value]
    return out


def test_any_type_nulls_and_null_groups(spark):
    """Text, double, decimal and time order columns; NULL order values and a NULL group; several ranges."""
    base = spark.range(400).select(
        "id",
        F.when(F.col("id") % 5 > 0, F.when(F.col("id") % 2 == 0, "a").otherwise("b")).alias("g"),
        F.when(F.col("id") % 40 > 0, F.concat(F.lit("u"), F.col("id") * 7919 % 400)).alias("text"),
        F.when(F.col("id") % 40 > 0, (F.col("id") * 7919 % 400) / 3).alias("number"),
        F.when(F.col("id") % 40 > 0, (F.col("id") * 7919 % 400).cast("decimal(9,2)")).alias("decimal"),
        F.when(F.col("id") % 40 > 0, F.timestamp_seconds(F.col("id") * 7919 % 400)).alias("at"),
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"),
    )
    data = [r.asDict() for r in base.collect()]
    for column in ("text", "number", "decimal", "at"):
        want = _brute(data, ["g"], [column, "id"], "v")
        numbered = {r.id: r.row_number for r in ordering.running_total(base, [column, "id"], ["g"]).collect()}
        before = {r.id: r.before for r in ordering.previous_value(base, "v", [column, "id"], ["g"], "before").collect()}
        assert {i: (numbered[i], before[i]) for i in numbered} == want


def test_one_value_repeated_is_numbered_across_ranges(spark):
    df = spark.range(2000).select(F.lit("same").alias("pos"), "id")
    got = ordering.running_total(df, ["pos"])
    assert sorted(r.row_number for r in got.collect()) == list(range(1, 2001))
    assert got.select("row_number").distinct().count() == 2000


def test_equal_rows_spread_over_ranges(spark):
    """Rows equal in every column are no hot group: they span several ranges and are still numbered gaplessly."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        equal = spark.range(20_000).select(F.lit("same").alias("pos"), F.lit(1).alias("pad"))
        _, ranges = ordering._ranges(equal, ["pos"], [], __w=F.lit(1))
        sizes = [r["count"] for r in ranges.groupBy("__part").count().collect()]
        assert len(sizes) > 2 and max(sizes) < 10_000
        got = ordering.running_total(equal, ["pos"])
        assert sorted(r.row_number for r in got.collect()) == list(range(1, 20_001))
        parts = ordering.balanced_parts(equal, "pos", 3).groupBy("part").count()
        assert rows(parts) == [(0, 6666), (1, 6667), (2, 6667)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_skip_first_keeps_rows_without_a_key(spark):
    df = spark.range(10).select(F.when(F.col("id") < 7, F.col("id")).alias("id"))
    assert [ordering.skip_first(df, "id", n).count() for n in (0, 2, 7, 9)] == [10, 8, 3, 3]


def test_string_keys_in_every_bucket_form(spark):
    df = spark.range(50).select(F.format_string("k%03d", "id").alias("key"))
    assert [r.bucket for r in ordering.round_robin(df, "key", 3).orderBy("key").collect()] == [i % 3 for i in range(50)]
    assert [r.chunk for r in ordering.fixed_chunks(df, "key", 7).orderBy("key").collect()] == [i // 7 for i in range(50)]
    assert [r.key for r in ordering.skip_first(df, "key", 48).orderBy("key").collect()] == ["k048", "k049"]
    assert ordering.skip_first(df, "key", 0).count() == 50 and ordering.skip_first(df, "key", 60).count() == 0


def test_rows_are_numbered_inside_ranges_only(spark):
    """The window that carries rows is partitioned by range; what is broadcast has a row per range."""
    padded = spark.range(1000).withColumn("pad", F.rand(1))
    text = plan(ordering.running_total(padded, ["id"]))
    windows = [line for line in text.splitlines() if "Window [" in line]
    over_rows = [line for line in windows if "sum(__n" not in line]
    assert len(windows) == 2 and len(over_rows) == 1
    assert "__part" in over_rows[0]


def test_seeded_shuffle_is_a_repeatable_permutation(spark):
    df = spark.range(500).repartition(5)
    orders = [[r.id for r in topk.shuffled(df, "id", seed).collect()] for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2]
    assert sorted(orders[0]) == sorted(orders[2]) == list(range(500))
    rises = sum(a < b for a, b in zip(orders[0], orders[0][1:]))
    assert 200 < rises < 300


def test_runs_folded_inside_parts_are_the_same(spark):
    """Runs of many parts, parts without a start, groups whose first rows belong to no run, an unnamed group."""
    made = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
        F.col("id").alias("at"),
        F.floor(F.col("id") / 40).alias("part"),
        F.when(F.col("id") * 7 % 13 < 3, "open").when(F.col("id") * 5 % 17 < 3, "follow").alias("step"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("p"), "id")).alias("piece"),
    )
    parts, found = ["part"], []
    for given in ([], parts):
        rows = ordering.previous_value(made, "step", ["at"], ["g"], "before", given)
        starts = (F.col("step") == "open") & ~F.col("before").eqNullSafe("follow")
        runs = ordering.fold_runs(rows, "g", ["at"], starts, F.col("piece"), ["step", "before"], size=3, parts=given)
        found.append(sorted(map(repr, runs.collect())))
    assert found[0] == found[1] and len(found[0]) > 20


def test_fetch_log_across_stretches(spark, monkeypatch):
    """A chain goes on over the edges of stretches, and lines are neither sorted into ranges nor moved whole."""
    monkeypatch.setattr(fetchlog, "_STRETCH", 2)
    response = "awaiting response... "
    text = [
        response + "lost", "--2024-01-01 10:00:00--  http://a", response + "301", "Location: b [following]", "x", "y", "z",
        "--2024-01-01 10:00:01--  b", response + "200", "--2024-01-01 10:00:02--  http://c", "--2024-01-01 10:00:03--  http://d",
        response + "302", "Location: d [following]", "20 redirections exceeded.",
    ]
    lines = spark.createDataFrame([("f", 0, i, line) for i, line in enumerate(text)], "file string, block long, line_id long, line string")
    got = fetchlog.fetch_log(lines)
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.select("run", "url", "fetched_at", "chain", "pieces").collect()) == [
        (1, "http://a", "2024-01-01 10:00:00", "301 > b > 200", 3),
        (2, "http://c", "2024-01-01 10:00:02", "", 0),
        (3, "http://d", "2024-01-01 10:00:03", "302 > d > Redirections Exceeded", 3),
    ]


def test_fetch_log_writes_less_than_its_lines(spark, monkeypatch):
    """What is kept between the steps is far less than the lines, which are kept once and without their prose."""
    kept = []
    for module in (ordering, fetchlog):
        if hasattr(module, "materialise"):
            monkeypatch.setattr(module, "materialise", lambda df: kept.append(df.columns) or session.materialise(df))
    lines = spark.createDataFrame([("f", 0, 0, "--2024-01-01 10:00:00--  http://a")], "file string, block long, line_id long, line string")
    assert fetchlog.fetch_log(lines).count() == 1
    assert len(kept) == 2 and not any("line" in columns for columns in kept)
