"""Expanding-window moments against the exploded training rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from salesplane.operators import encode as en
from salesplane.operators import model as md
from salesplane.operators import splits as sp

from conftest import fact


def close(a, b):
    if isinstance(a, float):
        return a == pytest.approx(b, rel=1e-9)
    return a == b


def test_moments_equal_those_of_the_copied_rows(spark):
    rows = [(f"{y}-{m:02d}", ["p", "q", None][(m + y) % 3], "s", f"b{m % 4}", f"c{i}", 2.0 * q, q) for i, (y, m, q) in
            enumerate((y, m, float((y * 7 + m * 13 + j * 5) % 23)) for y in (2020, 2021, 2022) for m in range(1, 13) for j in range(3))]
    df = fact(spark, rows)
    windows = sp.expanding_windows(2020)
    tagged = sp.tag_splits(df, windows)
    train, cols = tagged.where("role = 'train'"), ["sales_quantity", "sales_amount"]
    got = sp.train_moments(df, windows, cols)
    pairs = [(en.standard_of(got, cols), en.fit_standard(train, cols)), (en.minmax_of(got, cols), en.fit_minmax(train, cols)),
             (en.target_encode_of(sp.train_moments(df, windows, cols, ["brand_name"]), got, "brand_name", "sales_quantity"),
              en.target_encode(train, "brand_name", "sales_quantity")),
             (md.expanding_baselines(df, windows), md.baseline_predictions(tagged))]
    for own, plain in pairs:
        a, b = (sorted(map(tuple, x.collect()), key=lambda r: tuple(map(str, r[:7]))) for x in (own, plain))
        assert own.columns == plain.columns and len(a) == len(b)
        assert all(close(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


def test_an_empty_table_has_no_moments(spark):
    df = fact(spark, [])
    assert sp.train_moments(df, [(1, date(2020, 1, 1), date(2021, 1, 1), date(2021, 1, 1), date(2021, 4, 1), "")], ["sales_quantity"]).count() == 0
