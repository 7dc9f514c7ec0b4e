"""How the derived forms are computed: what is shuffled, and that levels are what grouping sets give."""

from pyspark.sql import functions as F

from ledgerloom.plans.bindings import built_forms
from ledgerloom.plans.common import table

SF = "/root/testdata/sf0.001"


def test_forms_of_customers_are_shuffled_once_after_the_join(spark):
    plan = built_forms(spark, SF, by_customer=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3  # lines by order, orders by customer, and customers where they are many


def test_levels_of_forms_equal_grouping_sets(spark):
    o, c = table(spark, SF, "orders"), table(spark, SF, "customer")
    base = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.concat(F.lit("C"), "c_custkey").alias("province"), F.year("o_orderdate").alias("year"), "c_mktsegment", "o_orderpriority", "o_orderstatus")
    keys = ["province", "year", "c_mktsegment", "o_orderpriority", "o_orderstatus"]
    sets = base.groupingSets([[F.col(k) for k in keys[:n]] for n in range(2, 6)], *[F.col(k) for k in keys]).agg((F.grouping("c_mktsegment") + F.grouping("o_orderpriority") + F.grouping("o_orderstatus")).alias("g"))
    expected = sorted((r["province"], r["year"], r["g"]) for r in sets.collect())
    found = built_forms(spark, SF, by_customer=True).filter("series = 'PLAN'").select("province", "year", (F.col("gs") + F.col("gp") + F.col("gt")).alias("g")).collect()
    assert sorted((r["province"], r["year"], r["g"]) for r in found) == expected and len(expected) > 100
