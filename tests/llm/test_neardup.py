import itertools

import numpy as np

from stratakit.llm import golay
from stratakit.llm import neardup as N


def test_code_is_perfect():
    words = np.arange(1 << 12, dtype=np.uint32) << 11
    code = words ^ np.array([N.golay._remainder(int(w)) for w in words], dtype=np.uint32)
    weights = np.array([bin(c).count("1") for c in code])
    assert set(weights) == {0, 7, 8, 11, 12, 15, 16, 23}
    assert np.array_equal(golay.decode(code), np.arange(1 << 12))
    rng = np.random.default_rng(0)
    for _ in range(200):
        flips = rng.choice(23, rng.integers(0, 4), replace=False)
        c = rng.integers(0, 1 << 12)
        assert golay.decode(np.array([code[c] ^ np.uint32(sum(1 << int(f) for f in flips))], dtype=np.uint32))[0] == c


def test_words_two_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 300).astype(np.uint32)
    keys = lambda x: [set(k[f]) for k, f in zip(*golay.keys(x))]
    own = keys(w)
    assert {len(k) for k in own} <= {1, 6}
    for a, b in itertools.combinations(range(0, 23, 3), 2):
        assert all(x & y for x, y in zip(own, keys(w ^ np.uint32(1 << a | 1 << b))))


def _rows(spark, sets):
    rows = [(i, None if v is None else float(v), float(v or 0) * 2, None, 1) for i, s in sets for v in s]
    return spark.createDataFrame(rows, "rec long, a double, b double, c double, id int")


def brute(sets, threshold):
    full = {}
    for i, s in sets:
        if i is not None:
            full.setdefault(i, set()).update(s)
    return {(i, j) for i, j in itertools.combinations(sorted(full), 2) if len(full[i] & full[j]) >= threshold * len(full[i] | full[j])}


def test_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [list(rng.integers(0, 10**6, 60)) for _ in range(30)]
    sets = [(k, b) for k, b in enumerate(base)]
    for k, b in enumerate(base):
        sets.append((100 + k, b[: 60 - k] + list(rng.integers(10**7, 10**8, k // 2))))  # similarity falls with k
        if k % 5 == 0:
            sets.append((200 + k, list(reversed(b)) + b[:10]))  # same rows, other order, repeats
    sets += [(300, [None, 1]), (301, [None, 1]), (302, [1]), (None, base[0])]
    rows = _rows(spark, sets)
    membership, links = N.similar_classes(rows, "rec", ["a", "b", "c"], 0.6)
    got = {tuple(r) for r in N.similar_records(membership, links).collect()}
    assert got == brute(sets, 0.6)
    groups = {r["id"]: r["component"] for r in N.components(membership.selectExpr("rep as id").distinct(), links).collect()}
    assert groups[0] == 0


def test_hot_records_get_the_same_keys(spark, monkeypatch):
    rng = np.random.default_rng(7)
    sets = [(k, list(rng.integers(0, 10**6, 50 + 40 * k))) for k in range(4)]
    cold = {r["id"]: r for r in N.fingerprints(_rows(spark, sets), "rec", ["a", "b", "c"]).collect()}
    monkeypatch.setattr(N, "HOT_ROWS", 100)
    hot = {r["id"]: r for r in N.fingerprints(_rows(spark, sets), "rec", ["a", "b", "c"]).collect()}
    assert set(cold) == set(hot)
    for i in cold:
        assert cold[i][1:4] == hot[i][1:4] and list(cold[i]["keys"]) == list(hot[i]["keys"])


def test_crowded_keys_are_refined(spark, monkeypatch):
    """Records that share a few boilerplate rows meet under crowded keys; the similar pairs among them still come out."""
    rng = np.random.default_rng(11)
    common = list(rng.integers(0, 10**6, 40))
    sets = [(k, common + list(rng.integers(10**7, 10**9, 40))) for k in range(40)]
    sets += [(100 + k, s[:72]) for k, s in sets[:10]]
    monkeypatch.setattr(N, "CROWD", 5)
    rows = _rows(spark, sets)
    prints = N.cut(N.fingerprints(rows, "rec", ["a", "b", "c"]))
    refined = {(r["a"], r["b"]) for r in N.candidates(prints, 0.6).collect()}
    monkeypatch.setattr(N, "CROWD", 10**9)
    direct = {(r["a"], r["b"]) for r in N.candidates(prints, 0.6).collect()}
    assert refined <= direct
    want = {(k, 100 + k) for k in range(10)}
    assert brute(sets, 0.6) == want and want <= refined


def test_nothing(spark):
    membership, links = N.similar_classes(_rows(spark, []), "rec", ["a", "b", "c"], 0.6)
    assert membership.count() == 0 and links.count() == 0
    assert N.components(membership.selectExpr("id").distinct(), links).count() == 0


def test_components_on_a_long_chain(spark):
    nodes = spark.range(60)
    links = spark.createDataFrame([(k, k + 1) for k in range(39)] + [(50, 55)], "a long, b long")
    got = {r["id"]: r["component"] for r in N.components(nodes, links).collect()}
    assert all(got[k] == 0 for k in range(40)) and got[55] == 50 and got[45] == 45
