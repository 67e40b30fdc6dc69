import random

from sluice.llm import graph


def test_pairs_of_several_buckets_are_made_once(spark):
    """Rows that share ten buckets are one pair, not ten; what is left out has both sides in one group or in no common bucket."""
    rnd = random.Random(1)
    sharing = {i: sorted(rnd.sample(range(12), 10)) for i in range(30)}
    sharing |= {i: sorted(rnd.sample(range(40), 10)) for i in range(30, 60)}
    group = {i: i % 4 if i < 20 else i for i in sharing}
    rows = [(i, k, 10, group[i], 0) for i, keys in sharing.items() for k in keys]
    split = spark.createDataFrame(rows, "id long, key long, size int, g long, top long")
    got = [(r["a"], r["b"]) for r in graph.pairs_between(split, ("size",), (), graph.sizes_allow(0.8)).collect()]
    want = {(a, b) for a in sharing for b in sharing if a < b and group[a] != group[b] and set(sharing[a]) & set(sharing[b])}
    assert len(got) == len(set(got)) and set(got) == want
