import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesplane.session import get_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 4, app="salesplane-tests")
    yield s
    s.stop()


FACT_SCHEMA = ("sales_month date, primary_platform string, store_name string, brand_name string, "
               "product_code string, sales_amount double, sales_quantity double")


def fact(spark, rows):
    """rows: (month 'YYYY-MM', platform, store, brand, product, amount, quantity)."""
    out = []
    for m, p, s, b, pr, a, q in rows:
        y, mm = map(int, m.split("-"))
        out.append((date(y, mm, 1), p, s, b, pr, float(a), float(q)))
    return spark.createDataFrame(out, FACT_SCHEMA)
