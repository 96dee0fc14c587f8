import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratakit.llm import spans as S


def brute(docs):
    """Pairs with a common run of 200 characters, and covered characters per record."""
    where = {}
    for i, t in docs:
        for k in range(len(t or "") - 199):
            where.setdefault(t[k : k + 200], set()).add(i)
    pairs = {(a, b) for s in where.values() for a in s for b in s if a < b}
    cover = {}
    for i, t in docs:
        if i is None:
            continue
        on = np.zeros(len(t or ""), bool)
        for k in range(len(t or "") - 199):
            if len(where[t[k : k + 200]]) > 1:
                on[k : k + 200] = True
        cover[i] = int(on.sum())
    return pairs, cover


def corpus():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [word(n) for n in (200, 199, 201, 640, 340)]
    docs = []
    for i in range(40):
        parts = [word(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), word(rng.randint(0, 120))]
        docs.append((i, "".join(parts)))
    docs += [(50, shared[3][100:500]), (51, "a" * 900), (52, "a" * 250 + "b"), (53, "ab" * 200), (54, "x" + "ab" * 150), (55, None), (56, ""), (57, "  "), (58, shared[0] * 3), (59, "é" + shared[4][:205] + "😀" * 5), (60, "😀" * 220), (61, "z" + "😀" * 300)]
    return docs


def run(spark, docs):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, pos int, h int")
    places = S.cut(S.occurrences(df))
    return {tuple(r) for r in S.sharing_pairs(places).collect()}, {r["doc_id"]: r["shared_chars"] for r in S.shared_cover(df, places).collect()}


def test_equals_brute_force(spark):
    docs = corpus()
    pairs, cover = run(spark, docs)
    want_pairs, want_cover = brute(docs)
    assert pairs == want_pairs and cover == want_cover


@pytest.mark.parametrize("few", [1, 1000])
def test_both_routes_and_small_pieces_give_the_same(spark, monkeypatch, few):
    docs = corpus()
    monkeypatch.setattr(S, "FEW", few)
    pairs, cover = run(spark, docs)
    want_pairs, want_cover = brute(docs)
    assert pairs == want_pairs
    assert cover == want_cover


@pytest.mark.parametrize("few", [1, 32, 1000])
def test_a_passage_twenty_times_in_one_text_and_once_in_fifteen_others(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW", few)
    monkeypatch.setattr(S, "SHARD", 5)
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    run_ = word(230)
    docs = [(1, "".join(word(160) + run_ for _ in range(20)) + word(160))]
    docs += [(k, word(150) + run_ + word(150)) for k in range(2, 17)] + [(20, "q" * 5000), (21, "q" * 3000), (22, word(3000))]
    pairs, cover = run(spark, docs)
    want_pairs, want_cover = brute(docs)
    assert pairs == want_pairs and cover == want_cover and cover[1] >= 20 * 230


def test_boilerplate_shorter_than_a_run_links_nothing(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common = word(150)
    docs = [(i, word(200) + common + word(200)) for i in range(60)]
    pairs, cover = run(spark, docs)
    assert pairs == set() and set(cover.values()) == {0}


def test_one_record_repeats_a_run_in_many_surroundings(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    docs = [(1, word(400))]
    for i in range(10, 60, 10):
        footer, own = word(200), word(200)
        docs += [(i, "".join(word(150) + footer + word(150) + own for _ in range(40))), (i + 1, word(150) + footer + word(150))]
    pairs, cover = run(spark, docs)
    assert pairs == {(i, i + 1) for i in range(10, 60, 10)}
    assert cover == brute(docs)[1]
    assert cover[10] >= 40 * 200 and cover[11] >= 200 and cover[1] == 0


def test_passages_come_from_the_text_that_was_marked(spark):
    """Record 1 has a second text whose characters at the passage's place sort before it."""
    rng = random.Random(9)
    word = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    common = word(260, "abcdefgh ")
    docs = [(1, word(90, "abcdefgh ") + common), (1, word(400, "!#$%&")), (2, common + word(50, "abcdefgh ")), (3, word(20, "abcdefgh ") + common)]
    assert run(spark, docs)[0] == {(1, 2), (1, 3), (2, 3)}


def test_nothing(spark):
    assert run(spark, []) == (set(), {})


@given(st.text(alphabet="ab", min_size=0, max_size=60), st.text(alphabet="ab", max_size=40), st.text(alphabet="ab", max_size=40))
@settings(max_examples=100, deadline=None)
def test_texts_with_a_common_run_share_a_mark(run_, left, right):
    """Winnowing's promise, at a small size: passage 4, run 12."""
    if len(run_) >= 12:
        a, b = S.marks(left + run_, 4, 12)[0], S.marks(run_ + right, 4, 12)[0]
        assert set(a) & set(b)


def test_window_hashes_depend_on_content_only():
    a, b = S.code_points("xx" + "hello world" + "yy"), S.code_points("hello world")
    assert S.window_hashes(a, 11)[2] == S.window_hashes(b, 11)[0]
    assert len(S.window_hashes(b, 12)) == 0
