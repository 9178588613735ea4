"""Spelling variants, the grouped prefix join and ranked search against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import ball_search, group_join, spelling
from ordermill.llm.ball_search import search
from ordermill.llm.group_join import join_groups
from ordermill.llm.spelling import near_pairs, near_words, variants

from . import brute
from tests.conftest import tuples


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def table(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind).repartition(3)


@pytest.fixture(scope="module")
def spelled():
    """(id, text) with many words that one edit parts, chains of forms, letters beyond ASCII, very long words."""
    pick = random.Random(5)
    stems = ["straßenbahn", "überlegen", "orchestra", "Mitteilung", "garçonnière", "abcdefg", "aaaaaaaa", "ÀÉÎõüÿ×÷"]
    words = []
    for stem in stems:
        for size in (1, 2, 12, 150):
            word = list(stem)
            for _ in range(pick.randint(0, 2)):
                k = pick.randrange(len(word))
                word[k:k + 1] = pick.choice([[], [pick.choice("abeéñ")], [word[k], pick.choice("abeéñ")]])
            words += ["".join(word)] * size
    words += ["chainword"] * 400 + ["chainwor"] * 30 + ["chainwo"] * 2
    words += ["x" * 5000] * 3 + ["x" * 5001] * 2 + ["x" * 2500 + "é" + "x" * 2500] * 2 + ["ab" * 9, "ba" * 9] * 2
    pick.shuffle(words)
    rows = [(k, " ".join(words[k * 7:k * 7 + 7])) for k in range(-(-len(words) // 7))]
    return rows + [(3, "Orchestra-ORCHESTRA_orchestra1orchestraĀorchestra"), (None, "orchestra überlegen"), (900, None), (901, ""), (902, "1 2")]


@pytest.mark.parametrize("chunk", [1024, 3])
def test_variants(spark, spelled, chunk, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    got = variants(table(spark, spelled).withColumn("word", F.lit(1)).withColumn("n", F.lit(2)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = ordered(brute.variants(spelled))
    assert tuples(got) == want and any(r[1] for r in want) and any(r[1] != r[2] and r[1] for r in want)


def test_variants_without_slips(spark, spelled):
    assert tuples(variants(table(spark, spelled), slip=None, length=2, count=1, times=3)) == ordered(brute.variants(spelled, None, 2, 1, 3))


def test_variants_of_prose(spark, documents, prose):
    assert tuples(variants(documents, length=3)) == ordered(brute.variants(prose, length=3))


def test_near_words_are_all_found(spark):
    pick = random.Random(2)
    words = list({"".join(pick.choice("abcÿ") for _ in range(pick.randint(3, 6))) for _ in range(1200)})
    rows = [(w, pick.randint(2, 9)) for w in words]
    n = dict(rows)
    want = []
    for w in words:
        near = [v for v in words if v != w and abs(len(v) - len(w)) < 2 and brute.one_edit(v, w)]
        if near:
            best = min(near, key=lambda v: (-n[v], v))
            want.append((w, len(near), n[best], best))
    assert tuples(near_words(table(spark, rows, "word string, n long"))) == ordered(want)


def test_blocks_reach_every_edit():
    pick = random.Random(1)
    moves = {tuple(m) for m in spelling._moves()}
    assert len(moves) == 22
    block = lambda w: np.array([sum(ord(c) % spelling.GROUPS == g for c in w) for g in range(spelling.GROUPS)])
    for _ in range(3000):
        a = [pick.choice(spelling.LETTERS) for _ in range(8)]
        b, k = list(a), pick.randrange(8)
        b[k:k + 1] = pick.choice([[], [pick.choice(spelling.LETTERS)], [a[k], pick.choice(spelling.LETTERS)]])
        move = block(b) - block(a)
        assert tuple(move) in moves or tuple(-move) in moves


def test_gram_matrix_of_long_words_is_exact():
    a = np.zeros((2, 5000), np.uint8)
    a[1, 7] = 1
    assert [x.tolist() for x in near_pairs(a, a, True)] == [[0], [1]]
    b = np.insert(a, 4321, 5, axis=1)
    assert sorted(zip(*(x.tolist() for x in near_pairs(a, b, False)))) == [(0, 0), (1, 1)]


@pytest.mark.parametrize("share, block", [(3 / 8, 2048), (1 / 8, 5)])
def test_joined_groups(spark, documents, prose, share, block, monkeypatch):
    monkeypatch.setattr(group_join, "_EDGE", int(share * 2**48))
    monkeypatch.setattr(group_join, "BLOCK", block)
    want = [r[:3] for r in brute.components(prose, 4, 85)]
    got = join_groups(documents)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert tuples(got) == ordered(want)


@pytest.mark.parametrize("most", [2, 3, 100])
@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_runs_of_tokens_over_batches(most, size):
    pick = random.Random(size)
    tokens = sorted(pick.choice([1, 2, 3, 3, 3, 3, *range(10, 60)]) for _ in range(200))
    rows = [(t, k) for k, t in enumerate(tokens)]
    batch = lambda part: group_join.pa.RecordBatch.from_arrays([group_join.pa.array([r[j] for r in part], group_join.pa.int64()) for j in (0, 1)], ["token", "row"])
    cut = [batch(rows[k:k + size]) for k in range(0, len(rows), size)]
    got = [tuple(r.values()) for b in group_join.shared_runs(iter([*cut[:1], batch([]), *cut[1:]]), most) for r in b.to_pylist()]
    assert sorted(got) == [(t, k, min(tokens.count(t), most)) for t, k in rows if tokens.count(t) > 1]


def near_texts(seed, n, words, alphabet):
    """Texts around a few bases, many of them just above or below the threshold of a link."""
    pick = random.Random(seed)
    bases = [[f"{pick.choice('abcdef')}{pick.randint(0, alphabet)}" for _ in range(pick.randint(1, words))] for _ in range(6)]
    rows = []
    for k in range(n):
        text = list(pick.choice(bases))
        for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
            at = pick.randrange(len(text) + 1)
            text[at:at + pick.randint(0, 2)] = [f"n{pick.randint(0, 40)}"] * pick.randint(0, 2)
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed, words, alphabet, block", [(1, 60, 50, 2048), (2, 120, 3, 20), (5, 6, 1, 4)])
def test_joined_groups_near_the_threshold(spark, seed, words, alphabet, block, monkeypatch):
    monkeypatch.setattr(group_join, "BLOCK", block)
    rows = near_texts(seed, 220, words, alphabet)
    want = [r[:3] for r in brute.components(rows, 4, 85)]
    assert tuples(join_groups(table(spark, rows))) == ordered(want)


def test_crowds_share_a_passage_but_do_not_link(spark):
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join(passage + [f"own{k}_{j}" for j in range(4 + k % 5)])) for k in range(150)]
    want = [r[:3] for r in brute.components(rows, 4, 85)]
    assert len({r[2] for r in want}) > 20
    assert tuples(join_groups(table(spark, rows))) == ordered(want)


def test_equal_texts_are_sent_once_per_task(spark):
    docs = spark.createDataFrame([(k, "one two three four five six" if k % 3 else f"own {k} text of its own") for k in range(3000)], "doc_id long, text string").repartition(4)
    sent = group_join._cut(docs)
    assert sent.where("packed is not null and n = 3 and n_bytes = 27").count() <= 4
    got = join_groups(docs)
    assert got.groupBy("component_id").count().agg(F.max("count")).first()[0] == 2000 and got.count() == 3000


ITEMS = [(1, "ka lo mi ren tus"), (2, "SAME same kado"), (3, None), (4, ""), (5, "日本語 x"), (6, "nothing of this"), (1, "one two"), (None, "valdo valna")]


@pytest.mark.parametrize("tree, leaf, block", [(8192, 32, 50_000), (20, 2, 12)])
def test_ranking(spark, documents, prose, tree, leaf, block, monkeypatch):
    for name, value in (("TREE", tree), ("LEAF", leaf), ("BLOCK_TERMS", block)):
        monkeypatch.setattr(ball_search, name, value)
    items = table(spark, ITEMS, "item_id long, text string").withColumn("score", F.lit("x"))
    for k in (3, 20):
        got = search(documents.withColumn("rank", F.lit(0)), items, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert tuples(got) == ordered(brute.ranking(prose, ITEMS, k))


def test_ties_go_by_id(spark):
    rows = [(k * 37 % 500, "alpha beta") for k in range(500)] + [(None, "alpha beta"), (1000, "gamma")]
    items = [(1, "alpha"), (2, "beta gamma")]
    got = search(table(spark, rows), table(spark, items, "item_id long, text string"))
    assert tuples(got) == ordered(brute.ranking(rows, items))


def test_ids_may_be_text(spark, prose):
    rows = [(None if key is None else f"d{key}", text) for key, text in prose]
    got = search(table(spark, rows, "doc_id string, text string"), table(spark, ITEMS, "item_id long, text string"), 5)
    assert tuples(got) == ordered(brute.ranking(rows, ITEMS, 5))


def test_balls_prune_and_stay_exact():
    rng = np.random.default_rng(3)
    clusters = [np.arange(c * 10, c * 10 + 10) for c in range(20)]
    rows = [clusters[rng.integers(20)] for _ in range(4000)]
    of = np.cumsum([0, *map(len, rows)])
    terms, values = np.concatenate(rows), rng.integers(4 * 10**8, 5 * 10**8, of[-1])
    queries = ball_search.Queries([[(c * 10 + k, 1 + k % 2) for k in range(5)] for c in range(20)], 200)
    tree = ball_search.Tree(of, terms, values, queries)
    assert sorted(tree.order) == list(range(4000))
    scored = 0
    for q in range(20):
        dense = np.zeros(200, np.int64)
        own = slice(queries.of[q], queries.of[q + 1])
        dense[queries.terms[own]] = queries.times[own]
        best = ball_search.Best(20)
        best.ids = ball_search.pa.array(np.arange(4000))
        scored += tree.search(q, dense, best)
        exact = [int(dense[terms[of[k]:of[k + 1]]] @ values[of[k]:of[k + 1]]) for k in range(4000)]
        assert [(-m, i) for m, _, i in best.rows] == sorted(((s, k) for k, s in enumerate(exact) if s > 0), key=lambda x: (-x[0], x[1]))[:20]
    assert scored < 20 * 4000 / 8


def test_bounds_hold():
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(50, rng.integers(1, 12), replace=False)) for _ in range(700)]
    of = np.cumsum([0, *map(len, rows)])
    terms, values = np.concatenate(rows), rng.integers(1, 10**6, of[-1])
    queries = ball_search.Queries([[(int(t), int(rng.integers(0, 13000))) for t in rng.choice(50, 8, replace=False)] for _ in range(9)] + [[]], 50)
    tree = ball_search.Tree(of, terms, values, queries)
    for node, (a, b) in enumerate(tree.spans):
        low, high = tree.of[a], tree.of[b]
        for q in range(10):
            dense = np.zeros(50, np.int64)
            dense[queries.terms[queries.of[q]:queries.of[q + 1]]] = queries.times[queries.of[q]:queries.of[q + 1]]
            scores = ball_search._sums(dense[tree.terms[low:high]] * tree.values[low:high], tree.of[a:b + 1] - low)
            assert scores.max() <= tree.bounds[node, q]


def test_one_very_long_text(spark):
    long = " ".join(f"wordnumber{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{k % 7}" for k in range(400_000))
    rows = [(1, long), (2, long[:-2]), (3, "wordnumberak"), (4, "z" * 3_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in join_groups(docs).select("doc_id", "component_id").collect()} >= {(1, 1), (2, 1), (4, 4)}
    got = {r.word: r.n for r in variants(docs, slip=None).collect()}
    assert got["wordnumberak"] == sum(len([w for w in t.split() if w[:12] == "wordnumberak"]) for _, t in rows)
    items = table(spark, [(1, "wordnumberak3")], "item_id long, text string")
    assert tuples(search(docs, items)) == ordered(brute.ranking(rows, [(1, "wordnumberak3")]))


def test_empty_tables(spark, nothing, documents):
    assert variants(nothing).count() == join_groups(nothing).count() == 0
    items = table(spark, ITEMS, "item_id long, text string")
    assert search(nothing, items).count() == search(documents, items.limit(0)).count() == search(documents, items.where("item_id = 3")).count() == 0


def test_forms_must_be_more_frequent(spark, nothing):
    with pytest.raises(ValueError):
        variants(nothing, times=1)
