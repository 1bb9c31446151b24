"""Enforced constraints: first causes, cascades along references, circular references."""

from pyspark.sql import functions as F

from shopcube.operators import quality as Q
from shopcube.operators.enforce import Constraints, Parent, _groups, enforce


def test_rejected_parents_take_their_children_along(spark):
    shops = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "shop int, name string")
    orders = spark.createDataFrame([(10, 1, 5), (11, 2, 5), (12, 1, -5), (13, 9, 1), (14, 3, 2), (14, 3, 2), (15, None, 2)],
                                   "order_id int, shop int, total int")
    lines = spark.createDataFrame([(10, 1), (10, 2), (10, 2), (11, 1), (12, 1), (14, 1), (15, 1), (None, 7), (77, 1)], "order_id int, line int")
    tables = [Constraints("lines", ["order_id", "line"], [], [Parent("order_id", "orders", "order_id")]),
              Constraints("orders", ["order_id"], Q.in_range("not_negative", "total", F.col("total") >= 0), [Parent("shop", "shops", "shop")]),
              Constraints("shops", ["shop"], Q.not_null("name"))]
    good, bad = enforce({"lines": lines, "orders": orders, "shops": shops}, tables)
    assert sorted(r.shop for r in good["shops"].collect()) == [1, 3]
    assert sorted(r.order_id for r in good["orders"].collect()) == [10, 15]
    assert sorted((r.order_id, r.reason) for r in bad["orders"].collect()) == [
        (11, "foreign_key:shop"), (12, "not_negative:total"), (13, "foreign_key:shop"), (14, "unique:order_id"), (14, "unique:order_id")]
    assert sorted(map(tuple, good["lines"].collect()), key=str) == [(10, 1), (15, 1), (None, 7)]
    assert sorted((r.order_id, r.reason) for r in bad["lines"].collect()) == [
        (10, "unique:order_id,line")] * 2 + [(x, "foreign_key:order_id") for x in (11, 12, 14, 77)]
    stored = spark.createDataFrame([(77,), (11,)], "order_id int")
    good, _ = enforce({"lines": lines}, tables[:1], {"orders": stored})
    assert sorted(map(tuple, good["lines"].collect()), key=str) == [(11, 1), (77, 1), (None, 7)]
    # what was accepted is accepted again
    again, rest = enforce({"lines": good["lines"]}, tables[:1], {"orders": stored})
    assert again["lines"].count() == good["lines"].count() and rest["lines"].count() == 0


def test_circular_references_reach_a_fixpoint(spark):
    rows = [(1, None, "x"), (2, 1, "x"), (3, 2, "x"), (4, 5, "x"), (5, 6, "x"), (6, 7, None), (7, None, "x"), (8, 8, "x"), (9, 4, "x")]
    df = spark.createDataFrame(rows, "id int, parent int, name string")
    tables = [Constraints("category", ["id"], Q.not_null("name"), [Parent("parent", "category", "id")])]
    good, bad = enforce({"category": df}, tables)
    assert sorted(r.id for r in good["category"].collect()) == [1, 2, 3, 7, 8]
    assert {r.id: r.reason for r in bad["category"].collect()} == {6: "not_null:name", **{i: "foreign_key:parent" for i in (4, 5, 9)}}
    empty, none = enforce({"category": df.where("false")}, tables)
    assert empty["category"].count() == none["category"].count() == 0


def test_order_of_tables():
    t = lambda name, *parents: Constraints(name, ["id"], [], [Parent("x", p, "id") for p in parents])
    got = [[c.table for c in g] for g in _groups([t("d", "c", "a"), t("c", "b"), t("b", "c", "a"), t("a", "stored")])]
    assert [sorted(g) for g in got] == [["a"], ["b", "c"], ["d"]]
