"""Spelling variants, hard negatives and exact top-k against plain versions."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestitch.llm import hard_negatives, pivot_search, spelling, whole_vectors

CLASHES = ("v", "ids", "cell", "t", "b", "planes", "tiles", "blocks", "distances", "class_id", "score", "rank", "word", "n", "run", "owner", "h", "at", "part", "form")


def _with_clashes(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


# -- spelling variants ----------------------------------------------------------------------

def _texts():
    r = random.Random(8)
    base = ["".join(r.choice("abcdeéÉß") for _ in range(r.randint(5, 9))) for _ in range(120)]
    texts = []
    for word in base:
        for _ in range(r.choice([1, 6, 30])):
            texts.append(word.upper() if r.random() < 0.1 else word)
        for _ in range(4):
            w, i = list(word), r.randrange(len(word))
            w[i : i + r.randint(0, 1)] = r.choice(["", "a", "é", "ÿ", "b"])
            texts += ["".join(w)] * r.choice([1, 5, 7])
    texts += ["x" * 3000] * 5 + ["x" * 2999 + "y"] * 6 + ["x" * 3001] * 50
    r.shuffle(texts)
    docs, at = [], 0
    while at < len(texts):
        n = r.randint(1, 60)
        docs.append(r.choice([" ", "-", "0", " \n", "Ā"]).join(texts[at : at + n]))
        at += n
    rows = list(enumerate(docs)) + [(9000, None), (9001, ""), (9002, "12 34"), (None, "abcdeé " * 7), (0, docs[0]), (0, docs[0])]
    return rows


def _spelled(rows, typo):
    low = str.maketrans(spelling.UPPER, spelling.LOWER)
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % typo == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        near = [x for x in words if x != w and _one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = [best if best and words[best] >= 5 * n else None, n, len(near)]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return {w: (form, root, n, near, words[form] if form else None) for w, (form, n, near, root) in out.items()}


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[p:] == b[p + 1 :] if len(a) < len(b) else a[p + 1 :] == b[p + 1 :]


@pytest.mark.parametrize("rule", [spelling.Spelling(), spelling.Spelling(typo=7, block=9, block_letters=40)])
def test_spelling_variants_match_a_comparison_of_all(spark, rule):
    rows = _texts()
    docs = _with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = spelling.spelling_variants(docs, rule).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == _spelled(rows, rule.typo)
    assert len(got) == len({r.word for r in got}) and any(r.form for r in got)


def test_chains_of_forms_are_followed_to_their_end(spark):
    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg"]
    rows = [(i, " ".join([w] * (5 ** (i + 1)))) for i, w in enumerate(chain)]
    got = {r.word: r for r in spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), spelling.Spelling(typo=0)).collect()}
    assert [got[w].form for w in chain] == [*chain[1:], None] and {r.root for r in got.values()} == {chain[-1]}


def test_near_words_of_two_blocks():
    one, two = ["banana", "bandit", "bananb"], ["banana", "banene", "abnana", "ganana"]
    i, j = spelling.near_words(spelling._letters(one), spelling._letters(two))
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 3), (2, 0)]
    i, j = spelling.near_words(spelling._letters(one), spelling._letters(["bananaa", "abanana", "banxana", "abandit", "nabanan"]))
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (0, 2), (1, 3)]


def test_spelling_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(none).collect() == [] and spelling.spelling_variants(none.union(spark.createDataFrame([(1, None)], none.schema))).collect() == []


# -- vectors --------------------------------------------------------------------------------

def _vectors(seed=3, n=700, width=13):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width)) * r.uniform(0.2, 2, size=(n, 1))
    x[100:400] = x[100]  # one frequent vector
    x[400:450] = -x[100]
    x[450] = 0
    rows = [(i, v.tolist(), int(i % 4)) for i, v in enumerate(x)]
    bad = [None, [], [float("nan")] * width, [None] + [1.0] * (width - 1), [float("inf")] * width, [1.0] * (width - 1)]
    odd = [(20000 + 100 * i, v, 1) for i, v in enumerate(bad)]
    odd += [(None, [1.0] * width, 1), rows[0], rows[100], (700, [1.0] * width, None)]
    return rows, odd


def _whole(rows, scale):
    return {i: np.floor(scale * np.array(v, float)).astype(int) for i, v, _ in rows}


def test_top_k_matches_a_search_of_all(spark):
    rows, odd = _vectors()
    table = _with_clashes(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(7))
    table = table.where("vec_id is null or vec_id <> 700")
    v = _whole(rows, 64)
    for rule in (pivot_search.PivotSearch(), pivot_search.PivotSearch(pivots=9, tile=60, block=5, first=8)):
        got = collections.defaultdict(list)
        for r in pivot_search.top_k(table, rule=rule).collect():
            got[r.query_id].append((r["rank"], r.vec_id, r.score))
        for q in (i for i in v if i % 20 == 0):
            best = sorted(((i, int(v[i] @ v[q])) for i in v if i != q), key=lambda x: (-x[1], x[0]))[:20]
            assert sorted(got.pop(q)) == [(n, *b) for n, b in enumerate(best, 1)], q
        assert not got
    few = pivot_search.top_k(table.where("vec_id < 5")).collect()
    assert len(few) == 4 and {r.query_id for r in few} == {0}
    assert pivot_search.top_k(table.limit(0)).collect() == [] and pivot_search.top_k(table.where("vec_id = 20")).collect() == []


def test_bounds_leave_out_what_lies_far_away():
    """Where vectors lie in clusters, most of a tile isn't evaluated; the result is that of all rows."""
    r = np.random.default_rng(1)
    x = np.floor(64 * (r.normal(size=(40, 1, 16)) * 3 + r.normal(size=(40, 100, 16)) * 0.1).reshape(-1, 16)).astype(int)
    rule = pivot_search.PivotSearch()
    pivots = pivot_search.choose(x[r.permutation(len(x))[:500]], float((x * x).sum(axis=1).max()), rule.pivots)
    table, away, many = pivots.distances(x), pivots.distances(x[:200], query=True), np.ones(len(x), int)
    evaluated = 0
    for i in range(0, 200, 10):
        rows, scores, n = pivot_search.best_of_tile(x, table.T, many, x[i], away[i], None, pivots.square, rule)
        s = x @ x[i]
        assert rows.tolist() == np.lexsort((np.arange(len(x)), -s))[:21].tolist() and scores.tolist() == s[rows].tolist()
        evaluated += n
    assert evaluated < 0.5 * 20 * len(x)


def _mined(rows, anchors, rule):
    v, label = _whole(rows, rule.scale), {i: x for i, _, x in rows}
    out = []
    for a in anchors:
        score = {i: int(v[i] @ v[a]) for i in v if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if label[i] == label[a]][: rule.positives]:
            found = [i for i in order if label[i] != label[a] and rule.least * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, n, i, score[p], score[i]) for n, i in enumerate(found[: rule.negatives], 1)]
    return out


def test_hard_negatives_match_a_search_of_all(spark):
    rows, odd = _vectors()
    table = _with_clashes(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(7))
    for rule in (hard_negatives.HardNegatives(), hard_negatives.HardNegatives(scale=64, least=20, tile=50, block=3)):
        got = hard_negatives.hard_negatives(table, F.col("vec_id") % 20 == 0, rule).collect()
        mine = sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)
        assert mine == sorted(_mined(rows, [i for i, _, _ in rows if i % 20 == 0], rule)) and mine
    alone = table.withColumn("label", F.lit(1))
    assert hard_negatives.hard_negatives(alone).collect() == [] and hard_negatives.hard_negatives(table.limit(0)).collect() == []


def test_looked_up_scores_are_inner_products():
    r = np.random.default_rng(2)
    for bits, width in ((2, 3), (10, 64), (26, 21)):
        v, a = (r.integers(-(1 << bits - 1), 1 << bits - 1, size=(n, width)) for n in (50, 9))
        v[0], v[1] = -(1 << bits - 1), (1 << bits - 1) - 1
        assert (hard_negatives.look_up(hard_negatives.bit_planes(v, bits), hard_negatives.subset_sums(a)) == v @ a.T).all()
        assert all((s == v @ a[i]).all() for i, s in hard_negatives._scores(hard_negatives.bit_planes(v, bits), a))


def test_components_too_large_for_a_long_take_no_part(spark):
    table = spark.createDataFrame([(1, [1e30, 1.0], 1), (2, [0.5, -0.5], 1), (2, [0.25, 0.0], 1), (3, [262143.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    got = whole_vectors.whole_vectors(table, 64).collect()
    assert sorted((r.vec_id, r.v) for r in got) == [(2, [16, 0]), (3, [64 * 262143, 0])]
