import random

import numpy as np
import xxhash

from planmart.llm import simhash
from planmart.llm.components import connected_components


def components(prints, bits=3):
    """Brute force: {fingerprint: set of its component}."""
    a = np.array(sorted(prints), np.uint64)
    left, out = set(range(len(a))), {}
    while left:
        todo, found = [left.pop()], set()
        while todo:
            i = todo.pop()
            found.add(i)
            near = [j for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits) if j in left]
            left.difference_update(near)
            todo += near
        for i in found:
            out[int(a[i])] = frozenset(int(a[j]) for j in found)
    return out


def signed(x):
    return int(np.uint64(x).astype(np.int64))


def test_links_of_random_and_planted_fingerprints(session):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(600)} | {0, (1 << 64) - 1}
    for base in list(prints)[:60]:                       # chains and stars around some
        x = base
        for _ in range(rng.randint(1, 6)):
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    centre = rng.getrandbits(64)                          # one large dense group
    prints |= {centre ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20)}
    df = session.createDataFrame([(signed(p),) for p in prints], "fp long")
    for blocks in (4, 5, 6):
        got = {r.fp: r.component for r in simhash.link_components(df, 3, blocks).collect()}
        expected = components(prints)
        linked = {signed(p) for p, c in expected.items() if len(c) > 1}
        assert got.keys() == linked
        groups = {}
        for p, c in expected.items():
            if len(c) > 1:
                groups.setdefault(frozenset(map(signed, c)), set()).add(got[signed(p)])
        assert all(len(x) == 1 for x in groups.values())
        assert len(set.union(*groups.values())) == len(groups)


def test_finer_masks_lose_no_link():
    rng = random.Random(7)
    masks = [0]
    while masks[0].bit_count() < 64 - simhash.OPEN:
        finer = {m: simhash.finer_masks(m, 3, 5) for m in masks}
        for m in rng.sample(masks, min(len(masks), 20)):
            for _ in range(50):
                free = [b for b in range(64) if not m >> b & 1]
                differing = sum(1 << b for b in rng.sample(free, rng.randint(0, 3)))
                assert any(not f & differing for f in finer[m])
        assert all(f & m == m for m, fs in finer.items() for f in fs)
        masks = sorted({f for fs in finer.values() for f in fs})


def test_crowded_keys_are_refined(session, monkeypatch):
    rng = random.Random(11)
    high = rng.getrandbits(26) << 38                      # one key for all, far from each other below it
    prints = {high | rng.getrandbits(38) for _ in range(900)}
    for base in sorted(prints)[:80]:
        x = base
        for _ in range(3):
            x ^= sum(1 << b for b in rng.sample(range(64), 3))
            prints.add(x)
    narrow = high | rng.getrandbits(24) << 14              # most of what fits under a key of 50 bits
    prints |= {narrow | x for x in rng.sample(range(1 << 14), 700) if x.bit_count() % 4 == 0}
    df = session.createDataFrame([(signed(p),) for p in prints], "fp long")
    expected = {signed(p): min(map(signed, c)) for p, c in components(prints).items() if len(c) > 1}
    calls, refined = [], simhash._refined
    monkeypatch.setattr(simhash, "_refined", lambda *a: calls.append(len(a[1])) or refined(*a))
    for crowd, levels in ((256, 2), (3, 4), (10 ** 9, 1)):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        calls.clear()
        got = {r.fp: r.component for r in simhash.link_components(df, 3, 5).collect()}
        assert got.keys() == expected.keys()
        # components are named by one of their fingerprints: the same partition
        assert len(set(got.values())) == len(set(expected.values())) == len({(got[f], expected[f]) for f in got})
        assert len(calls) >= levels and (crowd < 10 ** 9 or len(calls) == 1)


def test_pivot_distances_bound_the_distance(session):
    rng = random.Random(3)
    rows = [(signed(rng.getrandbits(64)),) for _ in range(20)]
    table = simhash.pivot_table(session.createDataFrame(rows, "fp long")).collect()
    for r in table:
        for i in range(simhash.PIVOTS):
            pivot = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 42)
            d = (r[f"d{i // 8}"] >> (8 * (i % 8))) & 127
            assert d == bin((r.fp & (1 << 64) - 1) ^ pivot).count("1")


def test_fingerprint_of_texts():
    def plain(text):
        w = (text or "").encode().lower().split()
        s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for text in (None, "", " \n\t", "one", "Two words", "a b c", "a b c a b c a b", "É É É x y z", "w " * 70000 + "v"):
        assert simhash.text_fingerprint(text, 3) == plain(text)


BASE = " ".join(f"word{i}" for i in range(400))


def test_documents(session, small_dir):
    docs = session.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    extra = session.createDataFrame([(90001, None), (90000, ""), (90002, BASE), (90003, BASE), (90003, BASE),
                                     (None, BASE), (90004, BASE.replace("word7 ", "WORD7 "))], "doc_id long, text string")
    rows = docs.unionByName(extra)
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    prints = [(d, simhash.text_fingerprint(t, 3)) for d, t in texts]
    expected = components({p for _, p in prints})
    least = {}
    for d, p in prints:
        if d is not None:
            least[expected[p]] = min(d, least.get(expected[p], d))
    wanted = sorted((str(d), f"{p:016x}", least[expected[p]]) for d, p in prints)
    named = rows.withColumn("component_id", rows.text).withColumn("fp", rows.text)
    got = simhash.dedup(named).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == wanted
    kept = simhash.keep_one(named)
    assert kept.columns == named.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))


def test_empty(session):
    df = session.createDataFrame([], "doc_id long, text string")
    assert simhash.dedup(df).count() == 0
    assert simhash.keep_one(df).count() == 0


def test_components_of_paths_stars_and_loops(session):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100, 300)]
    rng.shuffle(path)
    links = path + [(1, x) for x in range(2, 80)] + [(500, 500), (7, 500), (None, 3), (600, 601), (601, 600)]
    got = {r.node: r.component for r in connected_components(session.createDataFrame(links, "a long, b long")).collect()}
    assert got == ({i: 100 for i in range(100, 301)} | {i: 1 for i in range(1, 80)} | {500: 1}
                   | {600: 600, 601: 600})
    assert connected_components(session.createDataFrame([], "a long, b long")).count() == 0
