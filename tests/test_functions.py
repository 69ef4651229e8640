import datetime as dt
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwatch import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def brute_holiday(day):
    gaps = [
        (dt.date(y, m, d) - day).days for m, d in fn.HOLIDAYS for y in (day.year, day.year + 1)
    ]
    return min([g for g in gaps if g >= 0] + [365])


def test_days_to_holiday_over_eight_years(spark):
    start = dt.date(2012, 1, 1)
    days = spark.range(8 * 366).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    for row in days.select("d", fn.days_to_holiday(F.col("d")).alias("gap")).collect():
        assert row["gap"] == brute_holiday(row["d"]), row["d"]


def test_days_to_holiday_takes_other_holidays_in_any_order(spark):
    day = F.lit("2023-06-30").cast("date")
    assert one(spark, fn.days_to_holiday(day, [(7, 1), (1, 1)])) == 1
    assert one(spark, fn.days_to_holiday(day, [])) == 365
    with pytest.raises(ValueError):
        fn.days_to_holiday(day, [(2, 29)])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=40), min_size=5, max_size=30))
def test_tokenize_equals_python_words(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", fn.tokenize(F.col("t")).alias("w")).collect():
        assert set(row["w"]) == set(re.findall(r"\w+", row["t"].lower()))


def test_token_precision(spark):
    def score(context, answer):
        return one(spark, fn.token_precision(F.lit(context), F.lit(answer)))

    assert score("The tower is in Paris, France.", "Tower in PARIS!") == 1.0
    assert score("water boils", "water freezes") == 0.5
    assert score("some context", "?!") == 0.0
    assert score("café été _x1", "ÉTÉ _x1") == 1.0
    assert score("", "answer") is None
    assert score(None, "answer") is None


def test_cosine_clip(spark):
    def score(a, b):
        return one(spark, fn.cosine_clip(F.lit(a).cast("array<float>"), F.lit(b).cast("array<float>")))

    assert score([1.0, 2.0], [2.0, 4.0]) == pytest.approx(1.0)
    assert score([1.0, 0.0], [-1.0, 0.0]) == 0.0
    assert score([1.0, 0.0], [0.0, 1.0]) == 0.0
    assert score([0.0, 0.0], [0.0, 1.0]) == 0.0
    assert score([1.0], [1.0, 0.0]) is None


def test_nli_score(spark):
    def score(label, value):
        return one(spark, fn.nli_score(F.lit(label), F.lit(value).cast("double")))

    assert score("entailment", 0.9) == 0.9
    assert score("CONTRADICTION", 0.9) == pytest.approx(0.1)
    assert score("NEUTRAL", 0.9) == 0.5
    assert score("other", 0.9) == 0.5
    assert score(None, None) == 0.5


def test_clip_forecast(spark):
    def clip(value):
        return one(spark, fn.clip_forecast(F.lit(value).cast("double")))

    assert [clip(v) for v in (3.5, -1.0, 0.0, None)] == [3.5, 0.0, 0.0, 0.0]
    assert clip(math.nan) == 0.0


def test_drift_band_limits(spark):
    bands = [one(spark, fn.drift_band(F.lit(v))) for v in (0.0, 0.099999, 0.1, 0.2, 0.200001)]
    assert bands == ["stable", "stable", "moderate", "moderate", "significant"]
    assert one(spark, fn.drift_band(F.lit(None).cast("double"))) is None


def test_is_blank_knows_every_kind_of_space(spark):
    for text in ("", " ", "\t\n", " ", "  　", "\x1c"):
        assert one(spark, fn.is_blank(F.lit(text))) is True
        assert not text.strip()
    assert one(spark, fn.is_blank(F.lit(" a "))) is False
