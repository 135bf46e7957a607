"""Division at every size, rate maps, copies of a key."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from ratewell.functions.numeric import safe_divide
from ratewell.operators.reconcile import rate_map
from ratewell.operators.upserts import missing_rows


def test_division_is_exact_at_every_size(spark):
    cases = [("999999999", "7"), ("1000000000", "7"), ("10000000000000", "3"), ("-1000000000", "7"), ("1000000000.5", "-3"), ("1", "3"), ("2", "3"), ("1", "2000000000"), ("1", "0"), ("123456789012345.123456789", "0.000000007"), ("0.000000001", "2"), ("-0.000000001", "2")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in cases], "a decimal(38,9), b decimal(38,9)")
    for r in df.select("a", "b", safe_divide(F.col("a"), F.col("b")).alias("q")).collect():
        with localcontext() as context:
            context.prec = 80
            want = None if r.b == 0 else (r.a / r.b).quantize(Decimal("1e-9"), ROUND_HALF_UP)
        assert r.q == want, (r.a, r.b)


def test_last_rate_counts_and_long_maps_are_linear(spark):
    pairs = "array(named_struct('currency', 'B', 'rate', 1), named_struct('currency', 'A', 'rate', 2), named_struct('currency', 'B', 'rate', 0))"
    assert spark.sql(f"SELECT {pairs} AS p").select(rate_map(F.col("p")).alias("m")).first()["m"] == {"A": 2, "B": 0}
    many = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(17_576)), lambda k: F.struct(k.cast("string").alias("currency"), k.alias("rate"))).alias("p"))
    assert many.select(F.size(rate_map(F.col("p"))).alias("n")).first()["n"] == 17_576


def test_the_same_copy_is_kept(spark):
    new = spark.createDataFrame([("h", "b", 1), ("h", "a", 2)], "hash_id string, gcs_zip_uri string, zip_size long")
    assert [tuple(r) for r in missing_rows(new.limit(0), new).collect()] == [("h", "a", 2)]
