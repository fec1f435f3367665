import datetime as dt

import pytest
from pyspark.sql import functions as F

from firstprint.operators import filings, store as K
from firstprint.streaming import stores as X

SCHEMA = "k string, v string, n int"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_first_print_wins(spark, tmp_path):
    path = str(tmp_path / "store")
    first = K.append_dedup(batch(spark, ("a", "1", 1)), path, ["k", "v", "extra"], ["k"], "n")
    second = K.append_dedup(batch(spark, ("a", "9", 1), ("b", "3", 3), ("b", "2", 2)), path, ["k", "v", "extra"], ["k"], "n")
    third = K.append_dedup(batch(spark, ("a", "9", 1)), path, ["k", "v", "extra"], ["k"], "n")
    assert (first, second, third) == (1, 1, 0)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", "1", ""), ("b", "2", "")]


def test_partitioned_store_reads_touched_slices_only(spark, tmp_path):
    path = str(tmp_path / "store")
    for rows in ([("a", "1", 1), ("b", "1", 2)], [("a", "2", 1), ("a", "3", 2), ("c", "5", 3)]):
        K.append_dedup(batch(spark, *rows), path, ["k", "v"], ["k", "v"], "n", "k")
    assert spark.read.parquet(path).count() == 5


def test_a_hot_key_collapses_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"), F.col("id").alias("n"))
    out = K.first_per_key(rows, ["k"], "n")
    assert [tuple(r) for r in out.collect()] == [("hot", "0", 0)]
    assert out._jdf.queryExecution().executedPlan().toString().count("partial_min_by") >= 1


def test_slices_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    K.overwrite_partition(batch(spark, ("a", "1", 1), ("b", "1", 1)), path, ["k"])
    K.overwrite_partition(batch(spark, ("a", "7", 2)), path, ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", "7"), ("b", "1")]


def test_priority_merge_and_fallback(spark):
    day = lambda y: dt.date(y, 1, 2)
    schema = "d date, v double, r int"
    primary = spark.createDataFrame([(day(2020), 1.0, 1), (day(2020), 1.5, 2)], schema)
    secondary = spark.createDataFrame([(day(2020), 9.0, 9), (day(2021), 2.0, 1), (day(2022), 3.0, 1)], schema)
    got = K.priority_merge(primary, secondary, ["d"], "d", "r", [2020, 2021])
    assert sorted((r["d"].year, r["source"], r["v"]) for r in got.collect()) == [(2020, "primary", 1.5), (2021, "secondary", 2.0)]
    names = K.entity_fallback(batch(spark, ("SPY", "1", 1)), batch(spark, ("SPY", "2", 2), ("GLD", "3", 3)), "k")
    assert sorted((r["k"], r["source"]) for r in names.collect()) == [("GLD", "secondary"), ("SPY", "primary")]


def test_rebuild_takes_the_first_file(spark):
    rows = spark.createDataFrame([("a", "2", "f2", 0), ("a", "1", "f1", 1), ("b", "3", "f2", 1)], "k string, v string, path string, pos int")
    got = K.rebuild(rows, ["k"], "path", "pos")
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("a", "1"), ("b", "3")]


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_stream_keeps_the_first_print_over_restarts(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    for rows in ([("a", "1", 1)], [("a", "9", 2), ("b", "2", 3)]):
        write(spark, src, rows, SCHEMA)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        X.stream_append_dedup(stream, out, state, ["k", "v"], ["k"], "n").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("a", "1"), ("b", "2")]


def test_stream_weeks_run_monday_to_sunday(spark, tmp_path):
    src, out, schema = str(tmp_path / "src"), str(tmp_path / "out"), "ts timestamp, query string, story string"
    at = lambda d, h=12: dt.datetime(2024, 1, d, h)
    first = [(at(1, 0), "q", "s1"), (at(7, 23), "q", "s2"), (at(3), "q", "s1"), (at(3), "r", "s1"), (at(22), "q", "s9"), (None, "q", "s8")]
    late = [(at(7, 1), "q", "s4"), (at(8, 0), "q", "s3"), (at(3), "q", "s1")]
    for rows in (first, late):
        write(spark, src, rows, schema)
        X.stream_weekly_counts(spark.readStream.schema(schema).parquet(src), out, out + "-state", "ts", "query", "story").awaitTermination()
    got = {(r["week_ending"].day, r["search"]): r["n"] for r in X.weekly_counts(spark, out, ["q", "r"]).collect()}
    assert got == {(7, "total"): 3, (7, "q"): 3, (7, "r"): 1, (14, "total"): 1, (14, "q"): 1, (14, "r"): 0,
                   (21, "total"): 0, (21, "q"): 0, (21, "r"): 0, (28, "total"): 1, (28, "q"): 1, (28, "r"): 0}


def test_stream_ranks_over_batches_with_late_and_missing_weeks(spark, tmp_path):
    schema = "series string, report_date string, net double, at int"
    weeks = [("s", (dt.date(2020, 1, 7) + dt.timedelta(days=7 * i)).isoformat(), float((i * 37) % 53), i) for i in range(80)]
    weeks[40] = (*weeks[40][:2], None, 40)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    reprint = [(s, d, 999.0, 900 + at) for s, d, _, at in weeks[10:12]]
    for rows in (weeks[:20] + weeks[30:50], weeks[50:] + reprint, weeks[20:30]):
        write(spark, src, rows, schema)
        X.stream_gap_delta_rank(spark.readStream.schema(schema).parquet(src), out, out + "-state", "series", "at").awaitTermination()
    got = {r["report_date"]: r for r in spark.read.parquet(out + "/ranked").collect()}
    nets = [w[2] for w in weeks]
    moves = [None if i == 0 or None in nets[i - 1:i + 1] else abs(nets[i] - nets[i - 1]) for i in range(80)]
    assert len(got) == 80 and got[weeks[40][1]]["net_rank_pct"] is None
    for i in (60, 79):
        for rank, values in (("net_rank_pct", nets), ("move_rank_pct", moves)):
            past = [v for v in values[:i] if v is not None]
            assert got[weeks[i][1]][rank] == pytest.approx(100.0 * sum(v < values[i] for v in past) / len(past))


def test_weekly_windows_are_final_after_the_watermark(spark, tmp_path):
    src, out, schema = str(tmp_path / "src"), str(tmp_path / "out"), "ts timestamp, query string, story string"
    at = lambda d, h=12: dt.datetime(2024, 1, d, h)
    batches = [[(at(1, 0), "q", "s1"), (at(7, 23), "q", "s2"), (at(3), "r", "s1"), (at(9), "q", "s1"), (None, "q", "s8")],  # watermark: 7th, 12 h
               [(at(7, 20), "q", "s4"), (at(7, 21), "q", "s4"), (at(10), "q", "s5")],  # late but in time; then the 8th, 12 h: first week over
               [(at(7, 22), "q", "s6"), (at(20), "r", "s9")],  # s6 is too late
               [(at(28), "q", "s1")]]
    for rows in batches:
        write(spark, src, rows, schema)
        X.stream_weekly_windows(spark.readStream.schema(schema).parquet(src), out, out + "-state", "ts", "query", "story", "2 days").awaitTermination()
    got = sorted((r["week_ending"].day, r["search"], r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [(7, "q", 3), (7, "r", 1), (7, "total", 3), (14, "q", 2), (14, "total", 2), (21, "r", 1), (21, "total", 1)]


def test_a_late_week_changes_what_follows_it_only(spark, tmp_path):
    schema = "series string, report_date string, net double, at int"
    day = lambda i: (dt.date(2019, 1, 1) + dt.timedelta(days=7 * i)).isoformat()
    weeks = [("s", day(i), float((i * 29) % 31), i) for i in range(150)] + [("t", day(i), 1.0, i) for i in range(5)]
    src, out = str(tmp_path / "src"), str(tmp_path / "out")

    def run(rows):
        write(spark, src, rows, schema)
        X.stream_gap_delta_rank(spark.readStream.schema(schema).parquet(src), out, out + "-state", "series", "at", 3).awaitTermination()
        return {(r["series"], r["report_date"]): r.asDict() for r in spark.read.parquet(out + "/ranked").collect()}

    files = lambda: {p for p in (tmp_path / "out" / "ranked").rglob("*.parquet")}
    late = ("s", day(120), 30.5, 999)
    first = run([w for w in weeks if w[1] != day(120) or w[0] != "s"])
    before = files()
    second = run([late, ("s", day(3), 77.0, 1000), (None, day(4), 1.0, 0), ("s", None, 1.0, 0)])  # a replayed week, no series, no date
    assert {k for k in second if second[k] != first.get(k)} <= {("s", day(i)) for i in range(120, 150)}
    assert second[("s", day(3))]["net"] == weeks[3][2] and second[("s", day(120))]["net"] == 30.5
    assert {p.parent.name for p in files() - before} == {"year=2021"}  # weeks 105 to 149 and no other year
    nets = [30.5 if i == 120 else weeks[i][2] for i in range(150)]
    for i in (121, 149):
        assert second[("s", day(i))]["net_rank_pct"] == pytest.approx(100.0 * sum(v < nets[i] for v in nets[:i]) / i)
        assert second[("s", day(i))]["net_change"] == pytest.approx(nets[i] - nets[i - 1])


def test_a_watermark_moves_only_after_good_work(spark, tmp_path):
    marks, store = str(tmp_path / "marks"), str(tmp_path / "store")
    rows = lambda *days: spark.createDataFrame([(i, dt.date(2024, 1, d) if d else None) for i, d in enumerate(days)], "id int, day date")
    seen = []

    def work(new):
        seen.append(sorted(r["day"].day for r in new.collect()))
        K.append_dedup(new, store, ["id", "day"], ["id"], "id")

    def broken(new):
        work(new)
        raise RuntimeError("lost")

    ids = lambda: sorted(int(r["id"]) for r in spark.read.parquet(store).collect())
    filings.work_since(rows(1, 2, None), "day", marks, work)
    with pytest.raises(RuntimeError):
        filings.work_since(rows(1, 2, None, 2, 5), "day", marks, broken)
    assert filings.stored_watermark(spark, marks) == dt.date(2024, 1, 2) and ids() == [0, 1, 3, 4]
    filings.work_since(rows(1, 2, None, 2, 5, 3), "day", marks, work)  # the failed run again: nothing twice, nothing lost
    assert filings.stored_watermark(spark, marks) == dt.date(2024, 1, 5) and ids() == [0, 1, 3, 4, 5]
    assert seen == [[1, 2], [2, 2, 5], [2, 2, 3, 5]]
    assert filings.work_since(rows(1), "day", marks, work).count() == 0 and len(seen) == 3
