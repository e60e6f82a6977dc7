import random

from touchline.llm.components import components


def test_long_chains_settle(spark):
    """Neighbours only are linked, as successive versions of a page are."""
    order = list(range(3000))
    random.Random(1).shuffle(order)
    chains = [order, [5000 + i for i in range(2500)], [9001, 9000]]
    edges = [(a, b) for chain in chains for a, b in zip(chain, chain[1:])]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {node: min(chain) for chain in chains for node in chain}
