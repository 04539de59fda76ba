"""SimHash and its components against a plain version over all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlens.llm import components, simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs):
    """Smallest id reachable, by id; ``pairs`` are (id, fingerprint)."""
    parent = {i: i for i, _ in pairs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, (i, x) in enumerate(pairs):
        for j, y in pairs[:n]:
            if (x ^ y).bit_count() <= 3:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def test_shingle_hash_is_the_engines(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("eins zwei drei"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"eins zwei drei", seed=42)


def test_documents(sample):
    rows = simhash.near_duplicates(sample).collect()
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(sorted(fps.items()))
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (i, f"{fps[i]:016x}", want[i]) for i in fps}


def test_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    source = odd.where("doc_id is not null").collect()
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in source}
    want = plain_components(sorted(fps.items()))
    assert len(rows) == odd.count()
    for r in rows:
        assert r["component_id"] == want.get(r["doc_id"])
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5, 6)} == {4}  # no words: all linked
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert ids.count(None) == 3
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one_of_each(nothing).count() == 0


@pytest.mark.parametrize("piece", [16, 4096])
def test_dense_groups(spark, monkeypatch, piece):
    """Chains of one to four bits, many in one shard, cut into pieces."""
    monkeypatch.setattr(simhash, "PIECE", piece)
    rng = np.random.default_rng(3)
    values = set(rng.integers(0, 2**63, 200).tolist())
    centre = int(rng.integers(0, 2**63))
    for _ in range(300):
        v = centre
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            v ^= 1 << int(b)
        values.add(v)
    x = centre
    for b in range(0, 60, 4):  # a chain
        x ^= 0b1011 << b
        values.add(x)
    pairs = [(i, v) for i, v in enumerate(sorted(values))]
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in pairs]
    nodes = spark.createDataFrame(signed, "node long, fp long")
    found = components.components(simhash.fingerprint_links(nodes))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert {i: got.get(i, i) for i, _ in pairs} == plain_components(pairs)


def test_bk_tree_finds_all_within_radius():
    rng = np.random.default_rng(1)
    values = np.unique((rng.integers(0, 1 << 12, 800).astype(np.uint64) << np.uint64(20)))
    tree = simhash.BKTree(values)
    got = {(int(a), int(b)) for who, node in tree.search(values, 3) for a, b in zip(who, node)}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(near))}


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000 + i, 1000) for i in range(1, 300)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(401)}, **{1000 + i: 1000 for i in range(300)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_id_with_several_texts(spark):
    """The id links nothing: each text is in its own fingerprint's component,
    and one row of each component stays."""
    from tests.llm.conftest import prose
    base = [prose(80, i) for i in range(6)]
    rows = [(5, base[0]), (5, base[1]), (5, base[1]), (7, base[1]), (8, base[0] + " end"), (8, base[2]), (3, base[3]),
            (9, base[3]), (9, base[4]), (2, base[4]), (2, base[5]), (None, base[5]), (None, base[5]), (2, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    fps = [plain_fingerprint(t) for _, t in rows]
    named = [i for i, (d, _) in enumerate(rows) if d is not None]
    component = plain_components([(i, fps[i]) for i in named])  # of row numbers
    smallest = {}
    for i in named:
        smallest[component[i]] = min(smallest.get(component[i], rows[i][0]), rows[i][0])
    want = sorted(((rows[i][0], f"{fps[i]:016x}", smallest[component[i]] if i in component else None)
                   for i in range(len(rows))), key=repr)
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=repr) == want
    kept = simhash.keep_one_of_each(docs).collect()
    own = [r for r in kept if r["doc_id"] is not None]
    assert len(own) == len(set(component.values())) and len(kept) - len(own) == 2
    where = {(rows[i][0], rows[i][1]): component[i] for i in named}
    assert {where[(r["doc_id"], r["text"])] for r in own} == set(component.values())
    assert all(r["doc_id"] == smallest[where[(r["doc_id"], r["text"])]] for r in own)
