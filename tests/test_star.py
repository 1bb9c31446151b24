"""Star join: versions as of the fact, inferred members and their completion."""

import datetime as dt

from shopcube.operators.star import Lookup, complete_members, new_dimension, new_versions, star_join

D = lambda n: dt.date(2024, 1, n)


def _load(spark):
    customers = spark.createDataFrame([(5, None, "New"), (5, D(3), "Regular"), (5, D(9), "VIP"), (7, None, "New")],
                                      "customer long, valid_from date, segment string")
    goods = spark.createDataFrame([("b", "Bowl"), ("a", "Axe")], "product string, name string")
    facts = spark.createDataFrame(
        [(1, 5, "a", D(2)), (2, 5, "b", D(3)), (3, 5, "a", D(4)), (4, 5, "z", D(9)), (5, 5, None, D(10)), (6, 8, "z", D(1)),
         (7, None, "y", D(2)), (8, 7, "a", D(30)), (8, 7, "a", D(30))], "id long, customer long, product string, day date")
    return star_join(facts, [
        (Lookup("customer", "customer", "customer_sk", at="day"), new_versions(customers, "customer"), "customer"),
        (Lookup("product", "product", "product_sk"), new_dimension(goods, "product"), "product")])


def test_keys_of_versions_and_inferred_members(spark):
    facts, dims = _load(spark)
    got = sorted((r.id, r.customer_sk, r.product_sk) for r in facts.collect() if r.customer_sk and r.product_sk)
    # customer 5 has versions 1 (no beginning), 2 (day 3), 3 (day 9), customer 7 has 4, unknown 8 gets 5; a, b, y, z get 1..4
    assert got == [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 4), (6, 5, 4), (8, 4, 1), (8, 4, 1)]
    rest = {r.id: (r.customer_sk, r.product_sk) for r in facts.collect()}
    assert rest[5] == (3, None) and rest[7] == (None, 3) and facts.count() == 9
    assert [(r.sk, r.product, r.name) for r in dims["product"].where("is_inferred").orderBy("sk").collect()] == [
        (3, "y", None), (4, "z", None)]


def test_members_are_completed_in_place(spark):
    _, dims = _load(spark)
    arrived = spark.createDataFrame([("z", "Zither"), ("a", "changed"), ("k", "Kite"), ("c", "Cup")], "product string, name string")
    done = complete_members(dims["product"], arrived, "product")
    assert sorted((r.sk, r.product, r.name, r.is_inferred) for r in done.collect()) == [
        (1, "a", "Axe", False), (2, "b", "Bowl", False), (3, "y", None, True), (4, "z", "Zither", False),
        (5, "c", "Cup", False), (6, "k", "Kite", False)]
    again = complete_members(done, arrived, "product")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, done.collect()))


def test_a_second_load_keeps_keys(spark):
    _, dims = _load(spark)
    more = spark.createDataFrame([(9, 8, "y", D(20)), (10, 11, "q", D(21))], "id long, customer long, product string, day date")
    facts, dims2 = star_join(more, [
        (Lookup("customer", "customer", "customer_sk", at="day"), dims["customer"], "customer"),
        (Lookup("product", "product", "product_sk"), dims["product"], "product")])
    assert sorted((r.id, r.customer_sk, r.product_sk) for r in facts.collect()) == [(9, 5, 3), (10, 6, 5)]
    assert dims2["customer"].count() == dims["customer"].count() + 1


def test_empty_dimension_and_empty_facts(spark):
    none = spark.createDataFrame([], "product string, name string")
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, product string")
    out, dims = star_join(facts, [(Lookup("product", "product", "sk_p"), new_dimension(none, "product"), "product")])
    assert sorted((r.id, r.sk_p) for r in out.collect() if r.sk_p) == [(1, 1), (2, 1)] and dims["product"].count() == 1
    out, dims = star_join(facts.where("false"), [(Lookup("product", "product", "sk_p"), new_dimension(none, "product"), "product")])
    assert out.count() == 0 and dims["product"].count() == 0


def test_versions_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(k, D(n), "New") for k in range(20) for n in (1, 2, 3)]
    counted = spark.sparkContext.parallelize(rows, 2).map(lambda x: seen.add(1) or x)
    dim = new_versions(spark.createDataFrame(counted, "customer long, valid_from date, segment string"), "customer")
    assert sorted(r.sk for r in dim.collect()) == list(range(1, 61))
    assert seen.value == 60
