"""The previous-row lookup equals a plain lag, whatever the range split (empty ranges included)."""

import random


from trellis.operators.ordered import global_lag


def test_global_lag_equals_lag(spark):
    random.seed(7)
    data = [(i, random.randint(0, 50), random.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, ts long, u long")
    got = {r.id: r.prev_u for r in global_lag(df, ["ts", "id"], ["u"], n_ranges=13).collect()}
    order = sorted(data, key=lambda t: (t[1], t[0]))
    exp = {order[0][0]: None}
    for a, b in zip(order, order[1:]):
        exp[b[0]] = a[2]
    assert got == exp


def test_global_lag_one_hot_value(spark):
    data = [(i, 5, i % 3) for i in range(1000)]  # every row has the same ts: the split uses the id
    df = spark.createDataFrame(data, "id long, ts long, u long")
    got = {r.id: r.prev_u for r in global_lag(df, ["ts", "id"], ["u"], n_ranges=6).collect()}
    assert got[0] is None and all(got[i] == (i - 1) % 3 for i in range(1, 1000))
