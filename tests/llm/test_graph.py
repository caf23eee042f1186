import random

from quarry.llm._graph import connected_components


def components(spark, links):
    return dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))


def test_shuffled_chain_of_a_thousand(spark):
    """Chains whose ids follow no order settle, however long they are."""
    ids = random.Random(3).sample(range(10_000), 1300)
    chain, other = ids[:1000], ids[1000:]
    links = [*zip(chain, chain[1:]), *zip(other[1:], other)]
    assert components(spark, links) == {x: min(c) for c in (chain, other) for x in c}


def test_stars_cliques_and_loops(spark):
    links = [(50, i) for i in range(300, 400)] + [(i, j) for i in range(10, 20) for j in range(10, 20)] + [(7, 7), (1, 2), (2, 1), (1, 2)]
    want = {i: 50 for i in (50, *range(300, 400))} | {i: 10 for i in range(10, 20)} | {1: 1, 2: 1}
    assert components(spark, links) == want
    assert components(spark, [(7, 7)]) == {}
