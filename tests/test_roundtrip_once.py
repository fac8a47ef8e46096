"""encode_roundtrip computes the interactions once for both id dictionaries and the table they encode."""

from tunelake.operators import recommend as rc
from tunelake.plans import catalog
from tunelake.sources import testdata as td


def test_line_items_are_joined_once(spark, tmp_path):
    spark.createDataFrame([(o, o % 5 + 1, 2.0) for o in range(40)], "l_orderkey long, l_partkey long, l_quantity double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 3) for o in range(40)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = catalog.QUERIES["encode_roundtrip"](spark, str(tmp_path))
    names = got.columns
    want = rc.interactions(td.triplets(spark, str(tmp_path))).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 15
    assert not [f for f in got.inputFiles() if "lineitem" in f or "orders" in f]
