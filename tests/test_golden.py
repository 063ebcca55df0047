"""Golden values from the reference's committed outputs (a few rows as literals)."""
import datetime as dt

from pyspark.sql import functions as F

from pluvio.functions.timefmt import parse_stamp
from pluvio.operators import risk, series
from pluvio.sources.results import normalise_results, thresholds_long

# One catchment's 28 committed result rows (cat_id, max, mean, count,
# Forecast Timestamp, Timestep) and its committed summary (42.3, 4.1, 27.2).
CAT = 11111
ROWS = [
    (8.4, 2.1, 2019062118), (20.8, 3.3, 2019062200), (27.2, 2.6, 2019062206), (11.1, 1.1, 2019062212),
    (13.7, 3.8, 2019062218), (1.7, 0.5, 2019062300), (10.5, 1.0, 2019062306), (1.6, 0.5, 2019062312),
    (2.8, 0.4, 2019062318), (1.2, 0.1, 2019062400), (1.6, 0.2, 2019062406), (0.8, 0.1, 2019062412),
    (0.6, 0.1, 2019062418), (0.1, 0.0, 2019062500), (2.7, 0.2, 2019062506), (6.2, 0.6, 2019062512),
    (9.0, 3.2, 2019062518), (11.7, 3.0, 2019062600), (17.6, 3.9, 2019062606), (2.2, 0.5, 2019062612),
    (12.2, 4.1, 2019062618), (8.6, 1.9, 2019062700), (6.6, 0.8, 2019062706), (10.1, 1.0, 2019062712),
    (12.0, 2.6, 2019062718), (8.6, 1.3, 2019062800), (13.0, 1.5, 2019062806), (12.6, 1.9, 2019062812),
]
SUMMARY = (42.3, 4.1, 27.2)
THRESHOLD = 25.0
FIRST_REACHED = 2019062606


def _results(spark):
    rows = [("BLZ", "Belize", CAT, mx, mn, 300988, 2019062112, ts) for mx, mn, ts in ROWS]
    df = spark.createDataFrame(rows, "ISO3 string, NAME string, cat_id long, max double, mean double, "
                                     "count long, `Forecast Timestamp` long, Timestep long")
    return normalise_results(df, region="centralamerica", model="gfs")


def _thresholds(spark):
    wide = spark.createDataFrame([(CAT, THRESHOLD)], "BASIN long, `01FFG2018021312` double")
    return thresholds_long(wide)


def test_catchment_summary_golden(spark):
    r = risk.catchment_summary(_results(spark)).collect()
    assert len(r) == 1
    assert (r[0]["cum_mean"], r[0]["mean"], r[0]["max"]) == SUMMARY


def test_time_to_threshold_golden(spark):
    run = series.running_total(_results(spark))
    out = risk.time_to_threshold(run, _thresholds(spark)).collect()[0]
    want = dt.datetime.strptime(str(FIRST_REACHED), "%Y%m%d%H")
    assert out["reached_at"].replace(tzinfo=None) == want
    assert out["lead_h"] == 114           # 2019-06-21 12Z -> 2019-06-26 06Z


def test_cumulative_chart_reference_semantics(spark):
    s = series.cumulative_series(_results(spark), _thresholds(spark)).orderBy("valid_time").collect()
    cum = 0.0
    for (mx, mn, ts), row in zip(ROWS, s):
        cum = round(float(cum + mn), 1)            # the chart's step-by-step rounding
        assert row["value"] == cum
    assert s[-1]["chart_max"] == max(cum, THRESHOLD)


def test_interval_chart_max_is_latest_value(spark):
    s = series.interval_series(_results(spark), _thresholds(spark)).collect()
    # latest step's mean (1.9) is below the threshold, so the chart max is the threshold
    assert {r["chart_max"] for r in s} == {THRESHOLD}
    clean = series.interval_series(_results(spark), _thresholds(spark), semantics="clean").collect()
    assert {r["chart_max"] for r in clean} == {THRESHOLD}


def test_parse_stamp_roundtrip(spark):
    df = spark.createDataFrame([(2019062112,)], "t long")
    v = df.select(F.unix_millis(parse_stamp("t")).alias("ms")).collect()[0]["ms"]
    assert v == 1561118400000


def test_reference_colour_equals_bins_at_five(spark):
    vals = [(float(v) / 4,) for v in range(-8, 200)]
    df = spark.createDataFrame(vals, "value double")
    a = [r["class"] for r in risk.class_bins(df, interval=5).orderBy("value").collect()]
    b = [r["class"] for r in risk.reference_colour(df, interval=5).orderBy("value").collect()]
    assert a == b
    c = [r["class"] for r in risk.reference_colour(df, interval=3).orderBy("value").collect()]
    assert c != a


def test_chart_json_text_matches_python_json(spark):
    import json
    rows = _results(spark)
    docs = series.chart_json(series.chart_types(rows, _thresholds(spark))).collect()
    for d in docs:
        parsed = json.loads(d["json"])
        assert json.dumps(parsed) == d["json"]          # same text as a Python JSON reply
        assert parsed["threshold"] == THRESHOLD
        assert len(parsed["values"]) == len(ROWS)


def test_all_products_keep_product_key(spark):
    wide = spark.createDataFrame([(CAT, 25.0, 50.0)], "BASIN long, p1 double, p2 double")
    thr = thresholds_long(wide)
    scales = risk.catchment_summary(_results(spark))
    cmp = {r["product"]: r["cum_exceeds"] for r in risk.threshold_compare(scales, thr).collect()}
    assert cmp == {"p1": True, "p2": False}                # cum_mean 42.3
    run = series.running_total(_results(spark))
    t = {r["product"]: r["lead_h"] for r in risk.time_to_threshold(run, thr).collect()}
    assert t == {"p1": 114, "p2": None}


def test_chart_types_per_product(spark):
    wide = spark.createDataFrame([(CAT, 25.0, 50.0)], "BASIN long, p1 double, p2 double")
    ct = series.chart_types(_results(spark), thresholds_long(wide))
    last = {(r["product"], r["chart_type"]): r["value"] for r in ct.orderBy("valid_time").collect()}
    assert last[("p1", "cumulative")] == last[("p2", "cumulative")] == SUMMARY[0]


def test_reference_csv_layout_roundtrip(spark, tmp_path):
    """Results, thresholds and scales read from files in the reference's CSV layout."""
    from pluvio.sources.results import read_results, read_scales, read_thresholds
    res_csv = tmp_path / "gfsresults.csv"
    lines = ["ISO3,NAME,cat_id,max,mean,count,Forecast Timestamp,Timestep"]
    lines += [f"BLZ,Belize,{CAT},{mx},{mn},300988,2019062112,{ts}" for mx, mn, ts in ROWS]
    res_csv.write_text("\n".join(lines) + "\n")
    thr_csv = tmp_path / "thresholds.csv"
    thr_csv.write_text(f"BASIN,01FFG2018021312\n{CAT},25\n")
    sc_csv = tmp_path / "gfscolorscales.csv"
    sc_csv.write_text(f"cat_id,cum_mean,mean,max\n{CAT}.0,{SUMMARY[0]},{SUMMARY[1]},{SUMMARY[2]}\n")

    res = normalise_results(read_results(spark, str(res_csv), "csv"), region="centralamerica", model="gfs")
    assert res.count() == len(ROWS) and dict(res.dtypes)["valid_time"] == "timestamp"
    mine = risk.catchment_summary(res).collect()[0]
    ref = read_scales(spark, str(sc_csv), "csv").collect()[0]
    assert (mine["cat_id"], mine["cum_mean"], mine["mean"], mine["max"]) == \
        (ref["cat_id"], ref["cum_mean"], ref["mean"], ref["max"])
    thr = thresholds_long(read_thresholds(spark, str(thr_csv)))
    out = risk.time_to_threshold(series.running_total(res), thr).collect()[0]
    assert out["lead_h"] == 114
    proj = read_results(spark, str(res_csv), "csv", columns=["cat_id", "mean", "max", "Timestep"])
    assert proj.columns == ["cat_id", "mean", "max", "Timestep"]


def test_stored_cycles_are_read_and_written_as_numbers(spark):
    """A number's stamp is what its text is, null where it is no stamp; the year decides how a stamp is written."""
    from pyspark.sql import functions as F

    from pluvio.functions.timefmt import STAMP, fmt, parse_stamp_number
    want = {2024010100: 1704067200, 2024022923: 1709247600, 9999123123: 253402297200, 2023022900: None, 2024010124: None, 2024130100: None,
            2024043100: None, 2024000100: None, 999999999: None, -2024010100: None, 20240101001: None, None: None}
    df = spark.createDataFrame([(n,) for n in want], "c long")
    got = df.select("c", F.unix_seconds(parse_stamp_number("c")).alias("a"), F.unix_seconds(parse_stamp(F.col("c").cast("string"))).alias("b")).collect()
    assert {r["c"]: r["a"] for r in got} == want == {r["c"]: r["b"] for r in got}
    ts = spark.createDataFrame([(s,) for s in (1704067200, -62135593200, -1, 253402297200, None)], "s long").select(F.timestamp_seconds("s").alias("t"))
    assert [r[0] for r in ts.select(fmt("t", STAMP)).collect()] == ["2024010100", "0001010101", "1969123123", "9999123123", None]
