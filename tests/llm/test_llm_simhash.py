from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash
from sluice.llm.graph import components


def brute_print(text, words=4):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(len(found) - words + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance):
    """The least reachable value of every value, over all pairs."""
    values = np.array(sorted(set(prints)), np.uint64)
    root = {int(v): int(v) for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for v in values:
        for w in values[np.bitwise_count(values ^ v) <= distance]:
            a, b = find(int(v)), find(int(w))
            root[max(a, b)] = min(a, b)
    return {v: find(v) for v in root}


def check_documents(rows, found):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_classes(prints, 4)
    least = {}
    for (i, _), p in zip(rows, prints):
        old = least.get(roots[p])
        least[roots[p]] = i if old is None else old if i is None else min(i, old)
    wanted = Counter((i, f"{p:016x}", least[roots[p]]) for (i, _), p in zip(rows, prints))
    assert Counter(map(tuple, found)) == wanted


def test_edge_documents(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    check_documents(rows, simhash.near_duplicates(edge).collect())


def test_documents(tables):
    docs = tables("documents", "sf0.01")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check_documents(rows, simhash.near_duplicates(docs).collect())


def near_values(count, seed):
    """Random values, chains of near ones, and many in one small ball."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(count)}
    for _ in range(30):
        value = rng.getrandbits(64)
        for _ in range(8):
            out.add(value)
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                value ^= 1 << bit
    middle = rng.getrandbits(64)
    for _ in range(count):
        value = middle
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            value ^= 1 << bit
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("large", [2048, 8])
@pytest.mark.parametrize("distance", [0, 1, 3, 4, 6])
def test_classes_of_near_values(spark, monkeypatch, large, distance):
    monkeypatch.setattr(simhash, "LARGE", large)  # 8: most keys are cut by pieces of the other segment
    values = near_values(300, distance)
    roots = brute_classes(values, distance)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    found = simhash.classes(spark.createDataFrame(signed, "print long"), distance).collect()
    got = {int(np.int64(r["print"]).astype(np.uint64)): r.root for r in found}
    groups = {}
    for v, r in roots.items():
        groups.setdefault(r, set()).add(v)
    linked = {}
    for v, r in got.items():
        linked.setdefault(r, set()).add(v)
    assert sorted(map(sorted, linked.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_links_are_a_forest_of_each_key(spark):
    values = near_values(300, 9)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "print long")).collect()
    assert all((r.a ^ r.b).bit_count() <= 4 or bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4 for r in links)
    assert len(links) <= 66 * len(values)


def test_one_of_each_group_stays(spark, edge, clashing, nothing):
    kept = simhash.one_of_each(edge).collect()
    prints = [brute_print(r.text) for r in edge.collect()]
    assert len(kept) == len(set(brute_classes(prints, 4).values()))
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 3, 3, 4, 6, 7]
    assert any(r.text == "a text without an id" for r in kept)
    docs = clashing("print", "row_number", "fingerprint", "component_id")
    assert simhash.one_of_each(docs).columns == docs.columns
    assert simhash.near_duplicates(docs).count() == docs.count()
    assert simhash.one_of_each(nothing).collect() == [] and simhash.near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(200)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(7, 7)],
        "none": [],
    }[shape]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert sorted(map(tuple, found)) == sorted(root.items())
