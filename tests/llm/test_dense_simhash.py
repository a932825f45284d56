"""SimHash search in dense groups: few candidates, every link between groups, any key width."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.common import components


def table(spark, fps):
    return spark.createDataFrame([(simhash.signed(f), simhash.signed(f)) for f in sorted(set(fps))], "fp long, root long")


def groups(spark, fps):
    """The fingerprints' groups as ``near_groups`` finds them."""
    classes = table(spark, fps)
    rooted = simhash.slice_roots(classes.select("fp"))
    near = components(rooted.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    return rooted.select("fp").join(near.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def brute(fps):
    fps, parent = sorted(set(fps)), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[find(a)] = find(b)
    return {frozenset(simhash.signed(f) for f in fps if find(f) == r) for r in {find(f) for f in fps}}


def found(spark, fps, chain=simhash.CHAIN):
    rooted = groups(spark, fps)
    links = simhash.search_links(rooted, chain=chain).unionByName(rooted.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    root = {r["node"]: r["root"] for r in components(links).collect()}
    out = {}
    for f in sorted(set(fps)):
        out.setdefault(root.get(simhash.signed(f), simhash.signed(f)), set()).add(simhash.signed(f))
    return {frozenset(g) for g in out.values()}


def test_a_dense_group_is_not_paired_with_itself(spark):
    r = random.Random(1)
    centre, places = r.getrandbits(64), r.sample(range(64), 12)
    dense = [centre ^ sum(1 << p for i, p in enumerate(places) if x >> i & 1) for x in range(4096)]
    far = [p for p in range(64) if p not in places]
    stray = [centre ^ sum(1 << p for p in r.sample(far, n)) for n in (5, 5, 6, 4)]  # share keys with the group, the last one links
    rooted = groups(spark, dense + stray)
    n = simhash.candidates(rooted).count()
    assert 0 < n < 1_000_000
    assert found(spark, dense + stray) == brute(dense + stray)


@pytest.mark.parametrize("chain", [3, 4, 5])
def test_key_width_changes_no_group(spark, chain):
    r = random.Random(2)
    fps = [r.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in r.sample(range(64), k % 7)) for k, f in enumerate(fps)]
    fps += [fps[0] ^ sum(1 << b for b in r.sample(range(30), r.randint(0, 5))) for _ in range(150)]
    assert found(spark, fps, chain) == brute(fps)


def test_keys_of_every_width_find_near_pairs():
    r = random.Random(3)
    masks = simhash.segment_masks()
    for chain in (4, 5):
        keys = simhash.chain_keys(chain=chain)
        for _ in range(3000):
            x = sum(1 << b for b in r.sample(range(64), r.randint(0, 4)))
            valid = {s for s in range(5) if all(sum((x & masks[(s + i) % 5]).bit_count() for i in range(n + 1)) <= (n + 1) * 4 // 5 for n in range(5))}
            assert any(not x & m and s in valid for s, m in keys)
    assert [simhash.chain_for(n) for n in (0, 1 << 30, (1 << 30) + 1, 1 << 36, 1 << 40)] == [3, 3, 4, 4, 5]
