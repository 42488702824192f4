"""Store flag totals and platform landscape on rows without stores or brands."""

from salesplane.operators import explore as ex

SCHEMA = "primary_platform string, store_name string, brand_name string, sales_quantity double"


def test_store_flag_totals_by_platform_and_over_all(spark):
    df = spark.createDataFrame([("P", "a", "x", 1.0), ("P", "a", "y", 1.0), ("P", "b", "x", 1.0), ("Q", "a", "x", 1.0),
                                ("Q", None, "x", 1.0)], SCHEMA)
    types = spark.createDataFrame([("a", 1, 0), ("b", 0, 1)], "store_name string, t1 int, t2 int")
    tiers = spark.createDataFrame([("P", "a", 1), ("Q", "a", 0)], "primary_platform string, store_name string, high int")
    got = {tuple(r) for r in ex.store_flag_totals(df, {"type": types, "tier": tiers}).collect()}
    assert got == {("P", "type", "t1", 2), ("P", "type", "t2", 1), ("P", "tier", "high", 2),
                   ("Q", "type", "t1", 1), ("Q", "type", "t2", 0), ("Q", "tier", "high", 0),
                   ("all", "type", "t1", 3), ("all", "type", "t2", 1), ("all", "tier", "high", 2)}


def test_landscape_and_reach(spark):
    df = spark.createDataFrame([("P", "a", "x", 1.0), ("Q", "a", "x", 1.0), ("R", "b", "x", 1.0), ("P", "b", "y", 0.0),
                                ("Q", "c", "y", 3.0), ("Q", None, None, 2.0)], SCHEMA)
    assert {tuple(r) for r in ex.platform_landscape(df).collect()} == {
        ("P", 1.0, 12.5, 2, 2), ("Q", 6.0, 75.0, 2, 2), ("R", 1.0, 12.5, 1, 1)}
    assert tuple(ex.brand_reach(df).first()) == (1, 0, 1)
    empty = df.where("false")
    assert ex.platform_landscape(empty).count() == 0
    assert tuple(ex.brand_reach(empty).first()) == (0, 0, 0)
