"""The views that queries run over hold their whole table."""

from corpweave.plans import queries
from tests.differential import DATA


def least_members(links):
    above = {}

    def top(x):
        above.setdefault(x, x)
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    return {x: top(x) for x in above}


def test_graph_components_links_all_orders(spark):
    sf = str(DATA / "sf0.001")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderkey").collect()
    want = least_members([(r.o_custkey, r.o_orderkey % 400 + 1_000_000) for r in orders])
    got = {r.node: r.component for r in queries.Q["graph_components"](spark, sf).collect()}
    assert got == want
    assert queries.view(spark, sf, "customer_links").count() == len(orders)


def test_names_and_seeds_grow_with_customer(spark):
    for size in ("sf0.001", "sf0.01"):
        sf = str(DATA / size)
        customers = spark.read.parquet(f"{sf}/customer.parquet").count()
        assert queries.view(spark, sf, "near_names").select("raw_mention").distinct().count() == customers
        assert queries.view(spark, sf, "cik_seeds").count() == customers
