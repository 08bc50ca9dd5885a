from loamwork.operators.salted import lookup


def test_lookup_is_an_inner_join(spark):
    rows = spark.createDataFrame([(k % 3 if k < 90 else None, k) for k in range(100)] + [(0, 0), (7, 1)], "k long, x long")
    values = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (9, "d")], "k long, v string")
    for salts in (1, 4, 256):
        got = lookup(rows, ["k"], ["x"], values, salts)
        assert got.columns == ["k", "x", "v"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(values, "k").collect()))
    assert lookup(rows.limit(0), ["k"], ["x"], values).count() == 0
