"""Date spine: default range size, weekend count, calendar edge."""

import datetime as dt

from pyspark.sql import functions as F

from starhouse.operators.gold import dim_date


def test_default_range(spark):
    d = dim_date(spark, "2025-01-01 00:00:00")
    s = d.agg(F.count("*"), F.min("date_key"), F.max("date_key"),
              F.sum(F.col("is_weekend").cast("int")), F.countDistinct("date_key")).first()
    assert tuple(s) == (7670, 20100101, 20301231, 2192, 7670)


def test_iso_week_edge(spark):
    r = dim_date(spark, "2025-01-01 00:00:00").filter(F.col("date_key") == 20100101).first()
    assert (r.full_date, r.day_of_week, r.day_name, r.week_of_year, r.is_holiday) == \
        (dt.date(2010, 1, 1), 6, "Friday", 53, False)
