import datetime as dt

import pytest

from medallion.operators.series import date_spine, generate_series
from medallion.operators import checks as C


def test_generate_series(spark):
    assert [r[0] for r in generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        generate_series(spark, 0)


def test_date_spine_end_exclusive_no_gaps(spark):
    s = date_spine(spark, "day", dt.date(2018, 1, 1), dt.date(2018, 1, 10))
    days = [r[0] for r in s.orderBy("date_day").collect()]
    assert len(days) == 9 and days[0] == dt.date(2018, 1, 1) and days[-1] == dt.date(2018, 1, 9)
    assert C.sequential_values(s, "date_day", datepart="day").failing_rows().count() == 0
    m = date_spine(spark, "month", dt.date(2018, 1, 15), dt.date(2018, 4, 1))
    # three month boundaries are crossed, and every generated date is <= the end
    assert [r[0] for r in m.orderBy("date_month").collect()] == \
        [dt.date(2018, 1, 15), dt.date(2018, 2, 15), dt.date(2018, 3, 15)]
    h = date_spine(spark, "hour", dt.datetime(2018, 1, 1, 0), dt.datetime(2018, 1, 1, 5))
    assert h.count() == 5
