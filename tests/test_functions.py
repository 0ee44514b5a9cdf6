import datetime as dt

import pytest
from pyspark.sql import functions as F

from returnscope.config import Labels, ModelFamily, PipelineMode, RunWindow, artifact_name
from returnscope.functions.params import param_int, param_string
from returnscope.functions.rates import is_positive, refund_rate, smoothed_rate
from returnscope.functions.strings import channel_grouping, clean_string, normalize_string
from returnscope.sources.columns import clean_name, sink_name, sink_safe_columns

# (source, medium, campaign, channel): every rule once, and the order between rules.
CHANNELS = [
    ("(direct)", "(none)", None, "Direct"),
    ("(direct)", "(not set)", "brand", "Direct"),
    ("x", "y", "eu cross-network 3", "Cross-network"),
    ("amazon.de", "cpc", "b", "Paid Shopping"),
    ("x", "paid-ads", "autumn shopping", "Paid Shopping"),
    ("google", "ppc", "b", "Paid Search"),
    ("m.facebook.com", "cpm", "b", "Paid Social"),
    ("youtube", "paid", "b", "Paid Video"),
    ("x", "banner", "b", "Display"),
    ("x", "cpm", "b", "Display"),
    ("etsy", "x", "b", "Organic Shopping"),
    ("x", "x", "my shop", "Organic Shopping"),
    ("x", "x", "eshop", "Organic Shopping"),
    ("x", "x", "workshop", "Unassigned"),
    ("x", "sm", "b", "Organic Social"),
    ("vimeo", "x", "b", "Organic Video"),
    ("x", "a video b", "b", "Organic Video"),
    ("bing", "x", "b", "Organic Search"),
    ("x", "organic", "b", "Organic Search"),
    ("x", "e-mail", "b", "Email"),
    ("x", "affiliate", "b", "Affiliates"),
    ("x", "referral", "b", "Referral"),
    ("x", "audio", "b", "Audio"),
    ("x", "sms", "b", "SMS"),
    ("x", "webpush", "b", "Mobile Push Notifications"),
    ("x", "notification-1", "b", "Mobile Push Notifications"),
    (None, None, None, "Unassigned"),
    ("google", None, None, "Organic Search"),
]


def test_channel_grouping(spark):
    rows = spark.createDataFrame(CHANNELS, "s string, m string, n string, want string")
    got = rows.select("want", channel_grouping(F.col("s"), F.col("m"), F.col("n")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_placeholders(spark):
    rows = spark.createDataFrame([("",), ("(not set)",), ("(none)",), ("(data deleted)",), ("a",), (None,)], "v string")
    got = rows.select(normalize_string(F.col("v")).alias("n"), clean_string(F.col("v")).alias("c")).collect()
    assert [r.n for r in got] == [None, None, "(none)", "(data deleted)", "a", None]
    assert [r.c for r in got] == ["", "unknown", "unknown", "unknown", "a", None]


def test_rates(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (None, 2.0), (0.0, None)], "h double, n double")
    rate = rows.agg(refund_rate(F.col("h"), F.lit(0.5), F.col("n")).alias("r")).first().r
    assert rate == pytest.approx((1 + 0.1) / 6.2)
    one = rows.select(smoothed_rate(F.col("h"), F.lit(0.5), F.col("n")).alias("r"), is_positive(F.col("h")).alias("p")).collect()
    assert one[0].r == pytest.approx(1.1 / 4.2) and one[1].r is None and one[2].r is None
    assert [r.p for r in one] == [1, 0, 0]


def test_params_take_the_first_match(spark):
    rows = spark.sql(
        "select array(named_struct('key', 'a', 'value', named_struct('string_value', 'x', 'int_value', 1L)),"
        " named_struct('key', 'a', 'value', named_struct('string_value', 'y', 'int_value', 2L))) as p"
        " union all select null"
    )
    got = rows.select(param_string(F.col("p"), "a").alias("s"), param_int(F.col("p"), "b").alias("i")).collect()
    assert {(r.s, r.i) for r in got} == {("x", None), (None, None)}


def test_names(spark):
    assert [clean_name(n) for n in ["Net (EUR)", " Tax/rate ", "", "9:30", "x++y__z", 12]] == [
        "net_eur", "tax_rate", "", "9_30", "x_y_z", "12",
    ]
    assert sink_name("__My Col!!") == "my_col__" and len(sink_name("a" * 200)) == 128
    safe = sink_safe_columns(spark.sql("select timestamp'2024-01-01 10:00:00' as `_When At`, 1 as B"))
    assert safe.dtypes == [("when_at", "timestamp_ntz"), ("b", "int")]
    with pytest.raises(ValueError, match="collide"):
        sink_safe_columns(spark.sql("select 1 as `a b`, 2 as `a_b`"))


def test_run_window():
    day = dt.date(2024, 6, 30)
    training = RunWindow.for_run(day, PipelineMode.TRAINING)
    assert training == RunWindow(dt.date(2023, 7, 1), dt.date(2023, 7, 1), dt.date(2024, 5, 30))
    prediction = RunWindow.for_run(day, PipelineMode.PREDICTION)
    assert (prediction.transaction_start, prediction.end) == (dt.date(2024, 6, 28), day)
    with pytest.raises(ValueError):
        RunWindow.for_run(day, PipelineMode.TRAINING, data_recency_days=10)


def test_labels_and_artifact_names():
    for bad in [((), ()), (("a", "a"), ()), (("a",), ("a",))]:
        with pytest.raises(ValueError):
            Labels(*bad)
    name = artifact_name(PipelineMode.TRAINING, "orders", "refund_value", "scores", ModelFamily.LINEAR_REGRESSION)
    assert name == "training_orders_refund_value_linear_reg_scores"
