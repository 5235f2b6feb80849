import random

from folioforge.llm.components import components


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in links)}


def test_components_match_brute_force(spark):
    """A chain, a star around its largest node and one around its smallest, random links, repeated links and loops."""
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(1000, 1040)] + [(5000, 5000 - k) for k in range(1, 60)] + [(1, 7000 + k) for k in range(300)]
    links += [(rng.randrange(8000, 8100), rng.randrange(8000, 8100)) for _ in range(70)] + links[:5] + [(9, 9), (-3, 7001)]
    rng.shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len({r["id"] for r in got})
    assert {r["id"]: r["component"] for r in got} == brute(links)


def test_no_links(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).count() == 0
    assert components(spark.createDataFrame([(4, 4)], "a long, b long")).count() == 0
