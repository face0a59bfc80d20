"""Given class weights over customer numbers of any size."""

from gradus.queries import QUERIES


def test_high_customer_numbers(spark, tmp_path):
    orders = spark.createDataFrame([(k, c) for k, c in enumerate([1, 20_001, 5_000_000, 5_000_000])], "o_orderkey long, o_custkey long")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = {r["class"]: r["weight"] for r in QUERIES["class_weights_many"](spark, str(tmp_path)).collect()}
    assert found == {c: round(1.0 / (1 + c % 97), 6) for c in (1, 20_001, 5_000_000)}
