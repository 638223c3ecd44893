"""Exhaustive / property checks of the exact arithmetic helpers."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larchmart.functions.columns import quotient_half_up
from larchmart.operators.ranking import ntile_from_rank


def _ntile(rank: int, total: int, n: int) -> int:
    """Reference NTILE: the first total % n buckets hold one extra row."""
    q, r = divmod(total, n)
    bucket, start = 0, 0
    for b in range(n):
        size = q + (1 if b < r else 0)
        if start < rank <= start + size:
            return b + 1
        start += size
    return bucket


def test_ntile_formula_all_small_totals(spark):
    pairs = [(rank, total) for total in range(1, 61) for rank in range(1, total + 1)]
    df = spark.createDataFrame(pairs, "rank long, total long")
    for n in (1, 2, 5, 7):
        got = df.select("rank", "total", ntile_from_rank(F.col("rank"), F.col("total"), n).alias("t")).collect()
        bad = [(r.rank, r.total, r.t) for r in got if r.t != _ntile(r.rank, r.total, n)]
        assert not bad, (n, bad[:5])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_quotient_half_up_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(quotient_half_up(F.col("n"), F.col("d"))).collect()]
    want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert [int(g) for g in got] == want
