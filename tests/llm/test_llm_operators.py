"""The text operators against plain versions, on fixtures with nulls, empty and long texts, ties, repeated rows,
empty tables and further columns whose names clash."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestitch.llm import chat, fingerprints, hamming_index, mixing, near_duplicates, packing, quality, suffixes, tokens, training_order, units
from carestitch.llm import words as word_arrays
from carestitch.llm.components import components
from carestitch.llm.superminhash import signatures
from carestitch.llm.words import shingles, words

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, row int, doc string, score string, kept int, "
          "start string, bucket string, open string, component_id string, version string, key string, size string")
OTHERS = tuple(["x", 1, "d", "s", 0, "st", "b", "o", "c", "v", "k", "z"])


def _prose(r, n):
    return " ".join("".join(r.choice("aeioumnrst") for _ in range(r.randint(2, 9))) for _ in range(n))


def _rows(seed=1):
    r = random.Random(seed)
    base, passage, line = _prose(r, 300), _prose(r, 60), _prose(r, 12) + "."
    near = base.split()
    near[100] = "changed"
    texts = [base, base.upper(), " ".join(near), passage, _prose(r, 40) + ". " + passage + " " + _prose(r, 30), line + "\n" + _prose(r, 20) + ".\n" + line,
             line + "\nEnd of it all here.", "", None, "one two three", "one  two\tthree", "a", " \n ", "é" * 70 + "ß", "x" * 200, _prose(r, 30000), base, _prose(r, 5)]
    texts += [_prose(r, r.randint(1, 80)) + ".\n" + r.choice([line, passage, ""]) for _ in range(40)]
    rows = [(i, t, "en", ["a", "b", None, "B"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, "en", "a", 1), (None, None, "en", None, 0), (None, "free of an id", "en", "a", 1), (7, line + "\nother", "en", "b", 1)]
    r.shuffle(rows)
    return [(*x, *OTHERS) for x in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# -- near duplicates ------------------------------------------------------------------------

def _sets(rows):
    found = {}
    for _, t in rows:
        w = words(t)
        found[t] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return found


def _components(rows, percent=85):
    """Sets of linked (id, text), over rows with ids and words, by comparing all."""
    sets = _sets(rows)
    nodes = sorted({(i, t) for i, t in rows if i is not None and sets[t]})
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            s, t = sets[a[1]], sets[b[1]]
            both = len(s & t)
            if both and 100 * both >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    found = collections.defaultdict(set)
    for x in nodes:
        found[find(x)].add(x)
    return list(found.values())


def _groups(rows, percent=85):
    """The smallest id linked with each (id, text)."""
    return {x: min(group)[0] for group in _components(rows, percent) for x in group}


def test_near_duplicates_match_a_comparison_of_all(docs):
    """Rows of one id with different texts included."""
    rows = _pairs(docs)
    expected, sets = _groups(rows), _sets(rows)
    got = near_duplicates.near_duplicates(docs).collect()
    first = lambda i, t: expected.get((i, t), i)
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == collections.Counter(
        (i, len(sets[t]), first(i, t), i is None or first(i, t) == i) for i, t in rows)


def test_texts_that_share_an_id_are_told_apart(spark):
    r = random.Random(3)
    a, b, c = (_prose(r, 120) for _ in range(3))
    rows = [(1, a), (1, b), (2, b), (3, c), (3, a + " more"), (4, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.near_duplicates(table).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (3, 3, True), (4, 4, True)]
    assert len({r.group for r in got if r.doc_id < 4}) == 3


def test_chains_of_near_copies_are_found_past_the_centre_of_a_bucket(spark):
    """Each text differs a little from the one before, so that ends are far from the smallest id."""
    r = random.Random(4)
    text = _prose(r, 200).split()
    rows = []
    for i in range(60):
        rows.append((i, " ".join(text)))
        for j in r.sample(range(200), 2):
            text[j] = f"w{i}x{j}"
    r.shuffle(rows)
    ids = {i: n for n, (i, _) in enumerate(rows)}
    rows = [(ids[i], t) for i, t in rows]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.near_duplicates(table, near_duplicates.NearDuplicates(tile=16)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: first for (i, _), first in _groups(rows).items()}


def test_a_bucket_is_dealt_in_rows_proportional_to_its_members_and_every_open_pair_meets_once(spark):
    copies, few = 3000, 5
    rows = [("hot", 0, i, 0 if i < copies else i) for i in range(copies + few)] + [("even", 0, i, i % 3) for i in range(90)]
    placed = spark.createDataFrame(rows, "key string, band int, id long, component long")
    opened = near_duplicates._open(placed)
    dealt = near_duplicates._dealt(placed, opened, 100).collect()
    assert sum(r.key == "hot" for r in dealt) <= 1.1 * (copies + few)
    small = near_duplicates._dealt(placed.where("key = 'even'"), opened, 20).collect()
    tiles = collections.defaultdict(list)
    for r in small:
        tiles[r.first, r.second].append(r)
    met = collections.Counter()
    for (first, second), rows in tiles.items():
        assert len({r.id for r in rows}) == len(rows)
        for a in rows:
            for b in rows:
                if a.component != a.main and a.o_part == second and b.part == first and a.component != b.component and (b.component == b.main or b.id < a.id):
                    met[frozenset((a.id, b.id))] += 1
    assert met == collections.Counter(frozenset((a, b)) for a in range(90) for b in range(a) if a % 3 != b % 3)


@pytest.mark.parametrize("rule", [dict(tile=8), dict(tile=8, rounds=0), dict(tile=1, rounds=1), dict()])
def test_buckets_of_several_groups_are_resolved_whatever_the_tile(spark, rule):
    """Groups that share much of their text, so that buckets hold members of many groups and outsiders."""
    r = random.Random(5)
    frame, rows = _prose(r, 60).split(), []
    for group in range(6):
        own = _prose(r, 14).split()
        for copy in range(9):
            text = frame + own
            text[r.randrange(60)] = f"c{group}x{copy}"
            rows.append((len(rows), " ".join(text)))
    rows += [(100 + i, " ".join(frame + _prose(r, 16).split())) for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.near_duplicates(table, near_duplicates.NearDuplicates(**rule)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: first for (i, _), first in _groups(rows).items()}


def test_signatures_of_a_huge_set_in_bounded_memory():
    element = np.arange(2_000_000, dtype=np.uint64) * np.uint64(2654435761)
    owner = np.zeros(len(element), np.int64)
    tracemalloc.start()
    ranks = signatures(owner, element, 1, 96)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    few = element[:5000], owner[:5000]
    assert (signatures(few[1], few[0], 1, 96) == signatures(few[1], few[0], 1, 96, slice_=7)).all() and (ranks >> np.uint64(32) < 96).all()


def test_near_duplicates_of_an_empty_table(none):
    assert near_duplicates.near_duplicates(none).collect() == []


def test_signatures_estimate_similarity_and_are_the_same_in_any_company():
    a, b = [f"w{i}" for i in range(400)], [f"w{i}" for i in range(60, 460)]
    owner, element = shingles([" ".join(a), " ".join(b), "x"], 1)
    ranks = signatures(owner, element, 3, 512)
    assert abs((ranks[0] == ranks[1]).mean() - 340 / 460) < 0.06
    only, part = shingles(["x"], 1)
    assert (signatures(only, part, 1, 512)[0] == ranks[2]).all() and len(set((ranks[2] >> np.uint64(32)).tolist())) == 512


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200, 300)] + [(5, i) for i in range(10, 60)] + [(3, 3), (None, 4), (60, 61), (61, 62)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "x long, y long")).collect())
    assert got == {i: 200 for i in range(200, 301)} | {i: 5 for i in [5, *range(10, 60)]} | {60: 60, 61: 60, 62: 60}


# -- repeated units -------------------------------------------------------------------------

def test_repeated_units_go_after_their_first_occurrence(docs):
    got = units.remove_repeated_units(docs).collect()
    rows = sorted(_pairs(docs), key=lambda x: (x[0] is None, x[0] or 0))
    first = {}
    for i, t in rows:
        for a, b in units.split_units(t or "", "sentence"):
            w = units.normalise(t[a:b])
            if len(w) >= 4:
                first.setdefault(tuple(w), i)
    assert len(got) == len(rows)
    for r in got:
        assert (r.kept_text is None) == (r.text is None) and r.n_units == len(units.split_units(r.text or "", "sentence"))
        assert r.kept_text is None or r.kept_text == "".join(r.text[s.start:s.end] for s in r.kept)
        assert sorted([(s.start, s.end) for s in r.kept] + [(s.start, s.end) for s in r.removed]) == sorted((s.start, s.end) for s in r.kept + r.removed)
        for s in r.removed:
            for a, b in units.split_units(r.text[s.start:s.end], "sentence"):
                assert first[tuple(units.normalise(r.text[s.start + a:s.start + b]))] in (r.doc_id, *[i for i, _ in rows if i is not None and (r.doc_id is None or i <= r.doc_id)])
    seen = collections.Counter()
    for key in {(r.doc_id, r.text): r.kept_text for r in got}.items():
        seen.update(tuple(w) for a, b in units.split_units(key[1] or "", "sentence") if len(w := units.normalise(key[1][a:b])) >= 4)
    assert set(seen) == set(first) and max(seen.values()) == 1
    assert {r.score for r in got} == {"s"}


@pytest.mark.parametrize("unit", ["sentence", "line"])
def test_repeated_lines_and_blocks_of_short_lines_go_whole(spark, unit):
    line = "It was the sixth, anea. Eriner thanea. So ended a very long day."
    menu = "Home\nAbout us\n\nNews\nContact\n"
    rows = [(1, f"Alpha beta gamma delta.\n{line}\n{menu}"), (2, f"{menu}Something else is said here.\n{line.upper()}\nEriner thanea."),
            (3, f"Eriner thanea. {line}\nNews\nTravel\n"), (4, menu), (5, "one two three"), (6, "one two\tthree")]
    got = units.remove_repeated_units(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), unit).collect()
    kept = {r.doc_id: r.kept_text for r in got}
    assert kept[1] == rows[0][1] and kept[4] == ""
    assert kept[2] == "Something else is said here.\nEriner thanea."
    assert kept[3] == ("Eriner thanea. Eriner thanea. News\nTravel\n" if unit == "sentence" else rows[2][1])
    assert (kept[5], kept[6]) == ("one two three", "one two\tthree")
    assert all(r.kept_text == "".join(t[s.start:s.end] for s in r.kept) for r in got for t in [dict(rows)[r.doc_id]])


@pytest.mark.parametrize("unit, text, parts", [
    ("line", "a\n\nb c\n", ["a\n\n", "b c\n"]), ("paragraph", "a\nb\n \nc", ["a\nb\n \n", "c"]), ("sentence", "A b. C?  D\nE", ["A b. ", "C?  ", "D\n", "E"]), ("line", "", [])])
def test_units_tile_a_text(unit, text, parts):
    assert [text[a:b] for a, b in units.split_units(text, unit)] == parts


def test_repeated_units_of_an_empty_table(none):
    assert units.remove_repeated_units(none).collect() == []


# -- mixing ---------------------------------------------------------------------------------

def _targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] >= cap * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mixing_meets_its_targets(docs):
    docs = docs.where("n_chars < 100000")  # no source can come near its target around one text of most of its words
    got = mixing.mix_sources(docs).collect()
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += size(t)
    targets = _targets(sizes)
    by_target = {round(t, 6): s for s, t in targets.items()}
    assert len(by_target) == len(targets) and len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        source = by_target[round(r.target, 6)]
        assert r.source_size == sizes[source] and r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[source] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1, (s, taken[s], t)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix_sources(docs.repartition(5)).collect()))


def test_lengths_that_fit_exactly_are_found():
    r = random.Random(2)
    for _ in range(200):
        length = np.array(sorted(r.sample(range(1, 60), r.randint(1, 8))))
        count = np.array([r.randint(1, 4) for _ in length])
        total, budget = int((length * count).sum()), 0
        budget = r.randint(0, 2 * total)
        passes, take = mixing.fit_lengths(length, count, budget)
        assert (take >= 0).all() and (take <= count).all()
        words_ = passes * total + int((length * take).sum())
        assert words_ <= budget and budget - words_ < 60


def test_mixing_of_an_empty_table(none):
    assert mixing.mix_sources(none).collect() == []


def test_a_length_with_many_documents_is_drawn_by_slices(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    got = mixing.mix_sources(rows).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert len(got) == 2 and all(abs(r.t - r.target) <= 3 for r in got)


# -- quality --------------------------------------------------------------------------------

def test_quality_tells_junk_from_prose(spark):
    r = random.Random(3)
    junk = lambda t, k: [" | ".join(t.split()), " ".join(w.upper() + "!!" for w in t.split()), " ".join(f"{w} {w} {w}" for w in t.split())][k % 3]
    rows, labels = [], []
    for i in range(1600):
        text, good = _prose(r, r.randint(20, 120)), i % 4 > 0
        rows.append((i, text if good else junk(text, i // 4)))
        if i % 2:
            labels.append((i, int(good)))
    rows += [(None, "no id"), (1601, None), (1602, ""), (0, rows[0][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, quality int")
    got = quality.score_quality(table, quality.fit_quality(table, marks)).withColumn("h", quality.held_out()).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.predicted, int(r.doc_id % 4 > 0)) for r in got if r.h and r.doc_id is not None and r.doc_id < 1600]
    assert len(held) > 80 and sum(a == b for a, b in held) / len(held) > 0.97
    assert {r.h for r in got if r.doc_id is None} == {False}
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    empty = quality.fit_quality(table.limit(0), marks.limit(0))
    assert {r.score for r in quality.score_quality(table, empty).collect()} == {0.5}
    assert quality.score_quality(table.limit(0), empty).collect() == []


def test_the_prior_is_estimated_from_tails():
    r = np.random.default_rng(0)
    good, bad = r.normal(2, 1, 4000), r.normal(-2, 1, 4000)
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        assert abs(quality.estimate_prior(r.normal(2, 1, 4000), np.concatenate([good[:n], bad[n:]])) - share) < 0.08


# -- suffixes -------------------------------------------------------------------------------

def _repeats(rows, n=50):
    first = {}
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        data = (t or "").encode()
        for p in range(len(data) - n + 1):
            first.setdefault(data[p:p + n], i)
    found = []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - n + 1):
            if first[data[p:p + n]] != i:
                gone[p:p + n] = True
        spans = int(((~gone[:-1][:-1] & gone[:-1][1:]).sum() + gone[0]) if len(data) else 0)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        found.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(found)


@pytest.mark.parametrize("per_bucket", [1_000_000, 300])
def test_repeated_bytes_match_a_search_of_all(docs, per_bucket):
    some = docs.where("n_chars < 100000")
    got = suffixes.repeated_bytes(some, suffixes.Suffixes(per_bucket=per_bucket, flush=2000)).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == _repeats(_pairs(some))


def test_hot_suffixes_over_many_buckets_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 700)
    r = random.Random(8)
    line, run = _prose(r, 30), "ab" * 300
    rows = [(i, r.choice([line + " " + _prose(r, 10), _prose(r, 5) + line, run[r.randint(0, 5):], _prose(r, 200) + line])) for i in range(150)]
    got = suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), suffixes.Suffixes(per_bucket=50, flush=500, sample=40)).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == _repeats(rows)


def test_repeated_bytes_of_an_empty_table(none):
    assert suffixes.repeated_bytes(none).collect() == []


# -- fingerprints ---------------------------------------------------------------------------

def test_fingerprints_follow_the_next_document(docs):
    got = fingerprints.document_fingerprints(docs, buckets=7).collect()
    rows = sorted(((i, t or "") for i, t in _pairs(docs)), key=lambda x: x[1])
    rows.sort(key=lambda x: -x[0] if x[0] is not None else 1 << 62)
    expected = collections.Counter()
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        new = t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
        expected[i, len(t), hashlib.sha256(new.encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.doc_id in (0, 16)}) == 1
    assert fingerprints.document_fingerprints(docs.limit(0)).collect() == []
    one = fingerprints.document_fingerprints(docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


# -- tokens, packing, order -----------------------------------------------------------------

def test_tokens_are_those_of_the_library(docs):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    odd = ["it's 'll WE'VE ÀÉß ÿÆ x×y ª º µ ² ½ a1b22 don't!!! É\x1cq ﬀ İ", "a<|endoftext|>b <|startoftext|>", "\t\x0b\x0c y z\x85q", "ΑΣ Σ. é ́x 12 3", "日本 語 🙂!", "", "\n", "w" * 3000]
    for text in [t for _, t in _pairs(docs) if t] + odd:
        assert tokens.token_ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]
    assert tokens.token_ids(None).tolist() == [] and tokens.with_end(None).tolist() == [1]


def test_plain_words_are_not_remembered(monkeypatch):
    """However many different ones there are, a text's plain words go through the merges at once, not each by itself."""
    tokens._tokenizer.cache_clear()
    taken, new = [], tokens.Words._new
    monkeypatch.setattr(tokens.Words, "_new", lambda self, word: taken.append(word) or new(self, word))
    text = " ".join(f"w{i}x" for i in range(80_000))
    ids = tokens.token_ids(text).tolist()
    assert taken == []
    assert tokens.token_ids(f"{text}\n– {text}").tolist() == ids + tokens.token_ids("–").tolist() + ids
    assert taken == ["–".encode()]
    tokens._tokenizer.cache_clear()


def test_tokens_of_mixed_runs_are_those_of_the_library():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    parts = [*"abstvdmreßÀÞ×÷ÿµ–é日09 '\".!<|~", "'s", "'re", "'LL", "''", " ", " ", "\n", "\r\n", "\t\x0b\x0c", "\x85", "\xa0", "\x1c", "\u0301", "İ", "Σ", " the", " Don't", " a b c d e f g h i ", "<|endoftext|>"]
    for i in range(3000):
        r = random.Random(i)
        some = r.sample(parts, r.randint(3, len(parts))) + [" ", " "]
        text = "".join(r.choices(some, k=r.randint(0, 60)))
        assert tokens.token_ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_workers_remember_few_words():
    """They serve the stages of a pipeline in turn, so what one stage leaves behind is missing in the next."""
    tokens.with_end("the file is read")
    tracemalloc.start()
    text = " ".join(f"w{i}" for i in range(250_000))
    quality.features([text])
    assert len(tokens.token_ids(text)) > 250_000
    del text
    left = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert left < 64 << 20


def test_forgotten_words_change_no_result(monkeypatch):
    texts = [_prose(random.Random(i), 300) + " I'd 1st É!" for i in range(3)] + [None, ""]
    whole = quality.features(texts), [tokens.token_ids(t).tolist() for t in texts], shingles(texts, 5)
    monkeypatch.setattr(word_arrays, "MOST_KNOWN", 3)
    again = quality.features(texts), [tokens.token_ids(t).tolist() for t in texts], shingles(texts, 5)
    assert (whole[0] == again[0]).all() and whole[1] == again[1] and all((a == b).all() for a, b in zip(whole[2], again[2], strict=True))


def test_other_tokenizer_files_go_through_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Some  text, with\nlines and é."
    assert tokens.token_ids(text, path).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def _check_pieces(got, rows):
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    lost = 0
    for pieces in by_sequence.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end and n > 0
            end += n
        assert end <= 2048
        lost += 0 if end & (end - 1) == 0 else 2048 - end
    assert lost == 0
    coded = collections.Counter()
    for i, t in rows:
        coded[i, len(tokens.with_end(t))] += 1
    lengths = collections.Counter()
    for r in got:
        lengths[r.doc_id, r.doc_tokens] += r.length
    assert lengths == collections.Counter({k: k[1] * n for k, n in coded.items()})


@pytest.mark.parametrize("block", [3000, 2_000_000])
def test_packing_places_every_id_once(docs, block):
    got = packing.pack_documents(docs, packing.Packing(block_tokens=block)).collect()
    _check_pieces(got, _pairs(docs))
    by_text = {(i, len(x)): x for i, t in _pairs(docs) if (x := tokens.with_end(t)) is not None}
    for r in got:
        if r.doc_id is not None and r.doc_id != 7:
            ids = by_text[r.doc_id, r.doc_tokens][r.start:r.start + r.length]
            assert r.ids == ids.tolist() and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())


def test_packing_keeps_costs_even():
    r = random.Random(6)
    lengths = [r.randint(1, 900) for _ in range(3000)]
    rule = packing.Packing()
    cost = collections.Counter()
    for _, _, n, s, _ in packing.pack(lengths, rule):
        cost[s] += rule.linear * n + rule.quadratic * n * n / rule.capacity
    full = sorted(cost.values())[20:]
    assert max(full) < 1.25 * min(full)


def test_only_what_fits_nowhere_is_cut():
    """Each document goes to the cheapest of all sequences with room, found here by looking at all of them."""
    r = np.random.default_rng(5)
    rule = packing.Packing()
    for mean in (4.5, 5.5, 6.0):
        lengths = np.maximum(1, r.lognormal(mean, 1.2, 1500).astype(int)) % rule.capacity + 1
        full = int(lengths.sum()) // rule.capacity
        used, spent, home = np.zeros(full, int), np.zeros(full), {}
        for n, doc in sorted(zip(lengths.tolist(), range(len(lengths)), strict=True), key=lambda x: (-x[0], x[1])):
            if (used + n <= rule.capacity).any():
                home[doc] = s = int(np.where(used + n <= rule.capacity, spent, np.inf).argmin())
                used[s] += n
                spent[s] += rule.linear * n + rule.quadratic * n * n / rule.capacity
        pieces = collections.defaultdict(list)
        for doc, start, n, s, _ in packing.pack(lengths.tolist(), rule):
            pieces[doc].append((start, n, s))
        whole = {doc: p[0][2] for doc, p in pieces.items() if p[0][1] == lengths[doc] and p[0][2] < full}
        assert home and all(whole.get(doc) == s for doc, s in home.items() if lengths[doc] < rule.capacity)


def test_packing_of_an_empty_table(none):
    assert packing.pack_documents(none).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_the_permutation_is_one_and_can_be_undone(n):
    slots = training_order.permute(np.arange(n), n, 99)
    assert sorted(slots.tolist()) == list(range(n))
    assert (training_order.permute(slots, n, 99, back=True) == np.arange(n)).all()
    assert n < 1000 or (slots != training_order.permute(np.arange(n), n, 98)).mean() > 0.9


def test_shards_are_read_back_from_anywhere_and_resumed(spark, docs, tmp_path):
    order = training_order.Order(length=64, per_shard=50)
    path = f"file://{tmp_path}/shards"
    index = {r.slot: r for r in training_order.write_in_order(docs, path, order).collect()}
    got = {r.slot: r for r in training_order.read_in_order(spark, path).collect()}
    assert sorted(got) == sorted(index) == list(range(len(index))) and all(r.sound for r in got.values())
    assert sum(r.n_tokens for r in got.values()) == sum(len(tokens.with_end(t)) for _, t in _pairs(docs))
    coded = {i: tokens.with_end(t).tolist() for i, t in _pairs(docs) if i is not None and i != 7}
    for slot, r in got.items():
        pieces = index[slot].pieces
        if all(p.doc_id in coded for p in pieces):
            assert r.ids == [x for p in pieces for x in coded[p.doc_id][p.start:p.start + p.length]]
    part = training_order.read_in_order(spark, path, 73, 160).collect()
    assert sorted(r.slot for r in part) == list(range(73, 160)) and all(got[r.slot].ids == r.ids for r in part)
    files = sorted((tmp_path / "shards").glob("*.bin"))
    assert {f.stat().st_size for f in files[:-1]} == {50 * order.stride}
    files[0].unlink()
    before = files[1].stat().st_mtime_ns
    training_order.write_in_order(docs, path, order)
    assert files[0].exists() and files[1].stat().st_mtime_ns == before


def test_a_folder_is_never_taken_for_other_sequences(spark, docs, tmp_path):
    order, path = training_order.Order(length=64, per_shard=50), f"file://{tmp_path}/shards"
    some = docs.where("n_chars < 1000")
    training_order.write_in_order(some, path, order)
    (tmp_path / "shards" / ".left.tmp").write_bytes(b"x")
    other = some.withColumn("text", F.reverse("text"))
    with pytest.raises(ValueError):
        training_order.write_in_order(other, path, order)
    with pytest.raises(ValueError):
        training_order.write_in_order(some, path, training_order.Order(length=64, per_shard=50, key=5))
    index = {r.slot: r.pieces for r in training_order.write_in_order(other, path, order, replace=True).collect()}
    got = training_order.read_in_order(spark, path).collect()
    texts = {r.doc_id: r.text for r in other.collect() if r.doc_id is not None and r.doc_id != 7}
    assert {r.slot for r in got} == set(index) and all(r.sound for r in got)
    for r in got:
        if all(p.doc_id in texts for p in index[r.slot]):
            assert r.ids == [x for p in index[r.slot] for x in tokens.with_end(texts[p.doc_id]).tolist()[p.start:p.start + p.length]]
    assert not list((tmp_path / "shards").glob(".*.tmp"))
    crc = {r.slot: r.ids_crc32 for r in training_order.read_in_order(spark, path, digests=True).collect()}
    assert crc == {r.slot: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_training_order_of_an_empty_table(spark, none, tmp_path):
    assert training_order.order_digests(none, f"file://{tmp_path}/none").collect() == []


# -- nearest neighbours ---------------------------------------------------------------------

def test_nearest_neighbours(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(3000, 16)) * r.uniform(0.5, 2, size=(3000, 1))
    x[200:900] = x[200]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(4000, None, 1), (4020, [], 1), (4040, [0.0] * 16, 1), (4060, [float("nan")] * 16, 1), (4080, [None] + [1.0] * 15, 1), (4100, [1.0, 2.0], 1), (None, [1.0] * 16, 1), rows[40]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("vector", F.lit("clash")).withColumn("score", F.lit(1))
    got = hamming_index.nearest(table, rule=hamming_index.Search(stripe=700, block=40)).collect()
    found = collections.defaultdict(list)
    for r_ in got:
        found[r_.query_id].append((r_["rank"], r_.vec_id, r_.score))
    asked = [i for i in range(3000) if i % 20 == 0]
    assert sorted(found) == asked
    hits = 0
    for q in asked:
        s = x @ x[q]
        best = sorted((i for i in range(3000) if i != q), key=lambda i: (-round(s[i], 9), i))[:20]
        mine = sorted(found[q])
        assert [m[0] for m in mine] == list(range(1, 21)) and q not in {m[1] for m in mine}
        assert all(abs(m[2] - s[m[1]]) < 1e-9 for m in mine)
        assert [(-round(m[2], 9), m[1]) for m in mine] == sorted((-round(m[2], 9), m[1]) for m in mine)
        hits += len({m[1] for m in mine} & set(best))
    assert hits / (20 * len(asked)) >= 0.95
    few = hamming_index.nearest(table.where("vec_id < 5")).collect()
    assert {r_.query_id for r_ in few} == {0} and len(few) == 4
    assert hamming_index.nearest(table.limit(0)).collect() == []


def test_the_index_finds_every_code_within_the_radius():
    r = np.random.default_rng(1)
    codes = r.integers(0, 1 << 16, size=(2000, 4), dtype=np.uint16)
    codes[500:600] = codes[0]
    index = hamming_index.SubstringIndex(codes)
    for radius in (0, 3, 7, 11, 20, 28):
        query = codes[int(r.integers(2000))] ^ np.array([1, 0, 2, 0], np.uint16)
        apart = np.bitwise_count(codes ^ query).sum(axis=1)
        rows, distance = index.within(query, radius)
        assert rows.tolist() == np.flatnonzero(apart <= radius).tolist() and (distance == apart[rows]).all()


# -- chat -----------------------------------------------------------------------------------

def _conversations():
    r = random.Random(9)
    rows = []
    for c in range(30):
        n = r.choice([1, 2, 5, 40, 400]) if c < 8 else r.randint(1, 9)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ["user", "assistant"][t % 2]
            rows.append((c, t, role, r.choice(["", None, "<|end|>\n", "\\<|turn|>assistant<|text|>", "a\\", "<", "<\\|", _prose(r, r.randint(1, 60)), _prose(r, 2) + "é" * 50])))
    rows.append((40, 0, "assistant", _prose(r, 3000)))
    rows += [(41, 0, "system", _prose(r, 2500)), (41, 1, "user", "q"), (41, 2, "assistant", "r")]
    rows += [(None, 1, "assistant", "no id"), (None, 0, None, "x"), (42, None, "assistant", "b"), (42, None, "assistant", "b"), (42, None, "assistant", "a")]
    return rows


def test_windows_read_back_to_the_conversations(spark):
    rows = _conversations()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("span", F.lit("clash")).repartition(4)
    rule = chat.Windows(budget=300, history=60, block=16)
    windows = chat.chat_windows(table, rule)
    got = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        said = "".join(f"{x[2]}\n{x[3]}\n" for x in turns)
        lost = "".join(x[3] for x in turns if x[2] == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(lost)), c
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()
    for w in windows.collect():
        assert not w.over_budget or w.n_turns - w.n_repeated == 1 or w.conv_id == 41
    many = [w for w in windows.where("conv_id = 4 or n_repeated > 0").collect()]
    assert any(w.n_repeated for w in many)
    for w in many:
        assert w.formatted.count(chat.END) == w.n_turns
    assert chat.chat_windows(table.limit(0), rule).collect() == []


def test_windows_stay_on_the_jvm(spark):
    table = spark.createDataFrame(_conversations(), "conv_id long, turn long, role string, text string")
    plan = chat.conversation_digests(chat.chat_windows(table))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_suffixes_of_a_long_text_are_made_in_bounded_memory():
    """Pieces of a megabyte, whatever a text's length; both ways stay below 250 MB with the powers that a worker keeps."""
    r = np.random.default_rng(6)
    text, rule = r.integers(97, 123, 6 << 20, np.uint8).tobytes().decode(), suffixes.Suffixes()
    pieces = list(suffixes._pieces([text, "short", None, text[:2_000_000]], rule.length))
    assert max(sum(len(p[2]) for p in group) for group in pieces) <= (1 << 20) + rule.length
    assert sum(max(0, len(p[2]) - rule.length + 1) for group in pieces for p in group) == len(text) + 2_000_000 - 2 * rule.length + 2
    tracemalloc.start()
    for group in pieces:
        suffixes._anchored(group, rule)
    suffixes._each_byte(pieces[0], [np.arange(len(text) - rule.length)] * 4, rule)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20
