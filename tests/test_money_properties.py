"""Property checks for the money helpers against an SQL engine and exact arithmetic."""

from fractions import Fraction

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions.money import cents, div_half_away, round_dp

money = st.one_of(
    st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False),
    # exact half-cent ties and values just around them
    st.integers(min_value=-10**9, max_value=10**9).map(lambda k: k / 100 + 0.005),
    st.integers(min_value=-10**7, max_value=10**7).map(lambda k: (2 * k + 1) / 2000),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(money, min_size=50, max_size=200), st.integers(min_value=0, max_value=4))
def test_round_dp_equals_sql_round(spark, xs, n):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round_dp("x", n)).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT ROUND(CAST(? AS DOUBLE), {n})", [x]).fetchone()[0] for x in xs]
    assert [repr(g) for g in got] == [repr(w) for w in want]
    got_cents = [r[0] for r in df.select(cents("x")).collect()]
    want_2dp = [con.execute("SELECT ROUND(CAST(? AS DOUBLE), 2)", [x]).fetchone()[0] for x in xs]
    assert got_cents == [round(w * 100) for w in want_2dp]  # w * 100 is within an ulp of an integer


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**6)), min_size=20, max_size=100))
def test_div_half_away_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(div_half_away("n", "d")).collect()]

    def exact(n, d):
        q = Fraction(abs(n), d)
        m = int(q + Fraction(1, 2))  # half away from zero on the magnitude
        return m if n >= 0 else -m
    assert got == [exact(n, d) for n, d in pairs]
