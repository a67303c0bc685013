"""Exact copies, near copies and components against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from featmart.llm import exact, simhash
from featmart.llm.components import components
from tests import oracle
from tests.llm.conftest import SF


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("max_keys", [200_000, 0])
def test_exact_copies_of_odd_rows(odd, max_keys):
    got = as_rows(exact.exact_duplicates(odd, max_keys=max_keys))
    groups = defaultdict(list)
    for r in odd.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            want.append((i, keep, len(ids), i == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != keep
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("max_keys", [200_000, 0])
def test_dropping_exact_copies(odd, max_keys):
    left = exact.drop_exact_duplicates(odd, max_keys=max_keys)
    assert left.columns == odd.columns
    got = sorted((r["text"] or "", r["doc_id"]) for r in left.collect())
    best = {}
    for r in odd.collect():
        best[r["text"] or ""] = max(best.get(r["text"] or "", -1), -1 if r["doc_id"] is None else r["doc_id"])
    assert got == sorted(best.items())


def test_empty_tables(none):
    assert exact.exact_duplicates(none).collect() == []
    assert exact.drop_exact_duplicates(none).collect() == []
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.drop_near_duplicates(none).collect() == []


def test_query_against_sql(spark, registered):
    query = registered["op2_exact_dedup"]
    assert oracle.compare(query.run(spark, SF), oracle.connect(SF), query.sql) is None


def plain_simhash(text, shingle):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, distance):
    """Union of all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_near_copies_against_all_pairs(request, which):
    df = request.getfixturevalue(which)
    data = [(r["doc_id"], r["text"]) for r in df.collect()]
    fps = [plain_simhash(t, 3) for _, t in data]
    comps = plain_components([i for i, _ in data], fps, 3)
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(data, fps, comps)), key=repr)
    got = simhash.near_duplicates(df, 3, 3)
    assert as_rows(got.select(simhash.ID, "fingerprint", "component_id")) == want


@pytest.mark.parametrize("distance", [1, 2, 3, 4, 6])
def test_links_of_clusters_and_correlated_bits(spark, distance):
    rnd = random.Random(distance)
    fps = set()
    for _ in range(60):
        center = rnd.getrandbits(64) & rnd.getrandbits(64) | (0xFF00 if rnd.random() < 0.5 else 0)
        for _ in range(rnd.choice([1, 2, 30])):
            fps.add(center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, distance + 2))))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "_fl_fp long")
    rooted = {r["node"]: r["root"] for r in components(simhash.links(df, distance, block=16)).collect()}
    want = plain_components(signed, fps, distance)
    assert [rooted.get(f, f) for f in signed] == want


def test_thresholds_add_up(spark):
    cost, chosen = simhash.allocate([[0, 1, 5, 9], [0, 100, 200, 300], [0, 2, 3, 20]], 1)
    assert sum(chosen) == 1 and chosen == [1, -1, 1] and cost == 8


def test_dropping_near_copies(odd):
    left = simhash.drop_near_duplicates(odd, 3, 3)
    assert left.columns == odd.columns
    rows = simhash.near_duplicates(odd, 3, 3).collect()
    assert left.count() == len({r["_fl_root"] for r in rows})
    assert {r["doc_id"] for r in left.collect()} <= {r["component_id"] for r in rows}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (200, 201)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
