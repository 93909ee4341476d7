"""Connected components against a union-find."""

import random

from cograph.llm.components import connected_components


def test_components_match_union_find(spark):
    r = random.Random(4)
    links = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(90)] + [(500 + i, 501 + i) for i in range(40)]
    links += [(1000, 2000 + i) for i in range(300)] + [(7, 7), (None, 3), (3, None), (-5, 900), (-5, 900)]
    owner = {}

    def root(x):
        owner.setdefault(x, x)
        while owner[x] != x:
            x = owner[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = sorted((root(a), root(b)))
            owner[b] = a
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in owner}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
