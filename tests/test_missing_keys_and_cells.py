"""Missing keys, odd cells and unreadable payloads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from firstprint.functions import periods as P
from firstprint.operators import diff as D, stats, store as K
from firstprint.sources import delimited as DL, jsons as J, xmls as XM


@pytest.mark.parametrize("partition_by", [None, "k"])
def test_first_print_wins_for_every_key(spark, tmp_path, partition_by):
    keys = [(None, "a"), ("", "b"), ("08", "c"), ("8", "d"), ("x/y=z", "e"), ("none", "f")]
    path, header = str(tmp_path / "store"), ["k", "v"]
    batch = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(keys)], "k string, v string, at int")
    assert [K.append_dedup(batch, path, header, ["k"], "at", partition_by) for _ in range(3)] == [6, 0, 0]
    later = batch.withColumn("v", F.lit("late")).union(spark.createDataFrame([("9", "new", 9)], batch.schema))
    assert K.append_dedup(later, path, header, ["k"], "at", partition_by) == 1
    assert sorted(map(repr, (tuple(r) for r in K.read_store(spark, path).select(*header).collect()))) == sorted(map(repr, [*keys, ("9", "new")]))


def test_identical_snapshots_have_no_news(spark):
    rows = spark.createDataFrame([("s", None, 1.0), ("s", "b", None), (None, "c", 2.0)], "source string, k string, v double")
    assert D.snapshot_diff(rows, rows, ["source", "k"], "v").count() == 0
    changed = rows.withColumn("v", F.when(F.col("k").isNull(), 5.0).otherwise(F.col("v")))
    assert [r["change"] for r in D.snapshot_diff(rows, changed, ["source", "k"], "v").collect()] == ["revised"]


def test_cells_with_quotes_line_ends_and_any_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x\ny"\n2,"he said ""hi"", ok"\n1,later\n')
    (tmp_path / "b.csv").write_text("v,k\nswapped,2\n")
    (tmp_path / "c.csv").write_text("k\n3\n")
    got = {r["k"]: r["v"] for r in DL.multi_file_last_wins(spark, str(tmp_path / "*.csv"), ["k", "v"], ["k"]).collect()}
    assert got == {"1": "later", "2": "swapped", "3": None}
    one = DL.csv_strings(spark, str(tmp_path / "a.csv"), ["v"])
    assert sorted(r["v"] for r in one.collect()) == ['he said "hi", ok', "later", "x\ny"]


def test_preamble_cells_keep_quoted_commas(spark):
    text = 'About us\nDate,Price,"Tonnes, total"\n2026-01-05,"1,234.5","8,090.25"\n"a ""b""",,x\n'
    df = spark.createDataFrame([(1, text)], "id int, body string")
    rows = DL.preamble_rows(df, "body", "date", "tonne", ["id"]).orderBy("line").collect()
    assert [r["cells"] for r in rows] == [["2026-01-05", "1,234.5", "8,090.25"], ['a "b"', "", "x"]]
    assert rows[0]["header"] == ["date", "price", "tonnes, total"]


def test_last_of_equal_header_names_stands(spark):
    df = spark.createDataFrame([('[["a","b","a"],["1","2","3"],["4"]]',)], "body string")
    assert [r["fields"] for r in J.header_rows(df, "body").collect()] == [{"b": "2", "a": "3"}, {"a": "4"}]


def test_unreadable_xml_raises_and_blank_has_no_rows(spark):
    read = lambda text: XM.xml_rows(spark.createDataFrame([(text,)], "body string"), "body", ["list", "row", "row"], ["x"])
    assert [r["x"] for r in read("<r><list><row><row><x>1</x></row></row></list></r>").collect()] == ["1"]
    assert read("  ").count() == 0
    with pytest.raises(Exception, match="not XML"):
        read("<r><list><row>").collect()


def test_last_span_of_a_month_stands_however_long_the_title(spark):
    title = "、".join(f"{m}月：速報" for m in range(1, 13)) * 60 + "、3月：確報"
    got = spark.range(1).select(P.stage_spans(F.lit(title)).alias("s")).first()["s"]
    assert [r["month"] for r in got] == [m for m in range(1, 13) if m != 3] + [3] and len({r["stage"] for r in got}) == 2


@pytest.mark.parametrize("horizon", [1, 2, 3, 4, 13])
def test_lags_follow_the_horizon(spark, horizon):
    rng = np.random.default_rng(horizon)
    x = np.cumsum(rng.standard_normal(120))
    y = np.convolve(x + rng.standard_normal(120), np.ones(horizon), "same")
    rows = [("c", horizon, i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "c string, horizon int, d int, x double, y double")
    got = stats.newey_west_t(df, ["c", "horizon"], "d", "x", "y", "horizon").first()["t_nw"]
    score = lambda v: (lambda r: (r - r.mean()) / r.std())(v.argsort().argsort().astype(float))
    zx, zy = score(x), score(y)
    rho = (zx * zy).mean()
    u = zx * (zy - rho * zx)
    s = (u * u).mean() + sum(2 * (1 - k / (horizon + 1)) * (u[k:] * u[:-k]).sum() / len(u) for k in range(1, horizon + 1))
    assert got == pytest.approx(rho / np.sqrt(s / len(u)), rel=1e-9)


def test_medians_of_a_missing_key(spark):
    from firstprint.operators.quantiles import exact_median
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, v double")
    got = {r["k"]: (r["n"], r["median"], r["top"]) for r in exact_median(df, ["k"], "v", also=[F.max("v").alias("top")]).collect()}
    assert got == {None: (2, 2.0, 3.0), "a": (1, 2.0, 2.0)}
