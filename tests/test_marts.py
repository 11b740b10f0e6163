"""Top-k queries and boxes on small stars with orphans, null prices, null makes and mass ties."""

from stratamart.plans import marts


def star(spark):
    fato = spark.createDataFrame(
        [(9, 99.0), (9, 98.0), (1, 50.0), (1, 50.0), (1, 50.0), (2, 40.0), (2, None), (3, 30.0)],
        "id_modelo long, price double")
    modelo = spark.createDataFrame(
        [(1, "a", "x", "suv"), (2, "b", "y", "van"), (3, None, "z", "van")],
        "id_modelo long, make string, model string, body_type string")
    return fato, modelo


def test_orphans_do_not_shorten_a_top_k(spark):
    fato, modelo = star(spark)
    want = [("a", "x", 50.0)] * 3 + [("b", "y", 40.0)]
    assert [tuple(r) for r in marts.price_between(fato, modelo, 0, 100, n=4).collect()] == want
    assert [r["price"] for r in marts.most_expensive(fato, modelo, n=4).collect()] == [50.0, 50.0, 50.0, 40.0]
    espec = spark.createDataFrame([(7, "maior")], "id_especificacao long, accident_history string")
    classed = fato.selectExpr("*", "7L as id_especificacao")
    found = marts.accident_class(classed, modelo, espec, n=2).collect()
    assert [tuple(r) for r in found] == [("a", "x", 50.0, "maior")] * 2


def test_null_prices_rank_last(spark):
    fato, modelo = star(spark)
    assert [r["price"] for r in marts.most_expensive(fato, modelo, n=9).collect()] == [50.0, 50.0, 50.0, 40.0, 30.0, None]


def test_a_null_make_takes_no_place(spark):
    fato, modelo = star(spark)
    many = fato.union(spark.createDataFrame([(3, 30000.0)] * 9 + [(1, 30000.0)] * 2 + [(2, 30000.0)], fato.schema))
    assert {r["make"] for r in marts.box_of_top_makes(many, modelo, n=2).collect()} == {"a", "b"}
