"""Spelling variants of a corpus' words by blocked Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced letter have letter counts at a squared distance of 1 or 2.
Words lie in cells of equal length and equal counts in a few groups of letters; one edit leads to the cell itself or to
one of few cells beside it (one letter moved between two groups, or one more letter in a group). Blocks of a cell's
words meet the blocks of those cells only: one product of two blocks' count matrices gives all squared distances, pairs
near enough are verified on their letters, and what leaves a task is a count and the best partner of each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "word string, n_near long, best_n long, best string"


@dataclass(frozen=True)
class Spelling:
    """``typo``: a run loses a letter where this divides its hash (0: never); ``least_length``, ``least_count``: which
    words are looked at; ``ratio``: a form is that many times as frequent; ``block``, ``block_letters``: most words and
    letters of a block (a longer word is a block alone)."""

    typo: int = 199
    least_length: int = 6
    least_count: int = 5
    ratio: int = 5
    block: int = 256
    block_letters: int = 4096


def word_counts(docs: DataFrame, rule: Spelling = Spelling(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of the whole texts, counted before they are shuffled. Null texts hold none."""
    runs = docs.select(
        F.col(id).cast("string").alias("owner"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"),
    )
    word: Column = F.col("run")
    if rule.typo:
        h = F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        shorter = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
        runs = runs.withColumn("h", h).withColumn("at", at)
        word = F.when(F.col("h") % rule.typo == 0, shorter).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= rule.least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rule.least_count)


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """The letters in use (90 at most), dealt to groups of about equal weight."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count()
    found, weight = [""] * groups, [0] * groups
    for letter, count in sorted(letters.collect(), key=lambda x: (-x[1], x[0])):
        lightest = weight.index(min(weight))
        found[lightest] += letter
        weight[lightest] += count
    return found


def _blocks(words: DataFrame, groups: list[str], rule: Spelling) -> DataFrame:
    """(cell, part, words, counts): a cell is the length and the number of letters in each group."""
    count = lambda letters: F.length("word") - F.length(F.translate("word", letters, "")) if letters else F.lit(0)
    placed = words.withColumn("cell", F.array(F.length("word"), *[count(g) for g in groups]))
    most = F.greatest(F.lit(1), F.least(F.lit(rule.block), F.lit(rule.block_letters) / F.col("cell")[0])).cast("int")
    sizes = placed.groupBy("cell").count().select("cell", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    dealt = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    one = F.sort_array(F.collect_list(F.struct("word", "n")))
    return dealt.groupBy("cell", "part").agg(one.alias("rows")).select("cell", "part", F.col("rows.word").alias("words"), F.col("rows.n").alias("counts"))


def _meetings(groups: int) -> Column:
    """The cells that a cell's words are compared with: itself, then each other one of a pair of cells once."""
    moved = lambda *steps: F.array(*[F.col("cell")[i] + sum(d for at, d in steps if at == i) for i in range(groups + 1)])
    same = [moved((a, 1), (b, -1)) for a in range(1, groups + 1) for b in range(a + 1, groups + 1)]
    longer = [moved((0, 1), (a, 1)) for a in range(1, groups + 1)]
    return F.array(F.col("cell"), *same, *longer)


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _counts(letters: np.ndarray, used: np.ndarray) -> np.ndarray:
    rows, length = letters.shape
    places = np.zeros(256, np.int64)
    places[used] = np.arange(len(used))
    at = places[letters] + len(used) * np.arange(rows)[:, None]
    # A sum of squares stays exact: 2 ** 24 in single, 2 ** 53 in double precision.
    return np.bincount(at.ravel(), minlength=rows * len(used)).reshape(rows, -1).astype(np.float32 if length < 2000 else np.float64)


def near_words(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of ``one``, j of ``two``) of words at one edit. Each block's words have one length; those of ``two`` have the
    same or one letter more."""
    used = np.flatnonzero(np.bincount(one.ravel(), minlength=256) + np.bincount(two.ravel(), minlength=256))
    a, b = _counts(one, used), _counts(two, used)
    apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    more = two.shape[1] - one.shape[1]
    i, j = np.nonzero(apart == (1 if more else 2))
    if not len(i):
        return i, j
    if not more:
        true = (one[i] != two[j]).sum(axis=1) == 1
    else:  # as many letters agree from the left and from the right as the shorter word has
        length = one.shape[1]
        from_left = np.cumprod(one[i] == two[j][:, :length], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
        from_right = np.cumprod((one[i] == two[j][:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
        true = from_left + from_right >= length
    return i[true], j[true]


def _best(rows: np.ndarray, others: np.ndarray, names: list[str], own: list[str], counts: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """For each word that has any: how many near words, and the most frequent one (names are in order)."""
    if not len(rows):
        return
    order = np.lexsort((others, -counts[others], rows))
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    many = np.diff(np.append(first, len(rows)))
    for at, n in zip(order[first].tolist(), many.tolist(), strict=True):
        best = int(others[at])
        yield own[rows[at]], n, int(counts[best]), names[best]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[tuple[str, int, int, str]] = []
        for k in range(batch.num_rows):
            one, two = batch.column("words")[k].as_py(), batch.column("other_words")[k].as_py()
            one_n = batch.column("counts")[k].values.to_numpy(zero_copy_only=False)
            two_n = batch.column("other_counts")[k].values.to_numpy(zero_copy_only=False)
            i, j = near_words(_letters(one), _letters(two))
            found += _best(i, j, two, one, two_n)
            if not batch.column("same")[k].as_py():  # a block against itself has each pair both ways already
                found += _best(j, i, one, two, one_n)
        columns = list(zip(*found, strict=True)) or [[]] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "best_n", "best"])


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word along (word, form). A form is more frequent than its word, so there are no circles, and
    each round doubles the length of the way that is known."""
    links = cut(links.select("word", F.col("form").alias("root")), "links")
    while True:
        step = links.alias("a").join(links.alias("b"), F.col("a.root") == F.col("b.word"), "left")
        step = cut(step.select("a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        links = step.select("word", "root")


def spelling_variants(docs: DataFrame, rule: Spelling = Spelling(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row for each word that is long and frequent enough.

    Null and empty texts hold no words; a row without an id gets no typos (its hash is null); a repeated row counts
    again. Ties between near words go to the first in code-point order. Other columns aren't looked at; an empty table
    gives an empty result. A word's length isn't limited.
    """
    words = cut(word_counts(docs, rule, id, text), "words")
    n = words.count()
    groups = letter_groups(words, max(4, n.bit_length() // 3))
    blocks = cut(_blocks(words, groups, rule), "blocks")
    left = blocks.select("words", "counts", "part", F.posexplode(_meetings(len(groups))).alias("way", "cell"))
    right = blocks.select("cell", F.col("part").alias("other_part"), F.col("words").alias("other_words"), F.col("counts").alias("other_counts"))
    pairs = left.join(right, "cell").where("way > 0 or part <= other_part")
    pairs = pairs.select("words", "counts", "other_words", "other_counts", F.expr("way = 0 and part = other_part").alias("same"))
    best = F.min(F.struct((-F.col("best_n")).alias("rest"), "best"))
    near = pairs.mapInArrow(_compare, FOUND).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    joined = words.join(near, "word", "left")
    form_n = F.when(-F.col("top.rest") >= rule.ratio * F.col("n"), -F.col("top.rest"))
    forms = cut(joined.select(
        "word", F.when(form_n.isNotNull(), F.col("top.best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form_n.alias("form_n"),
    ), "forms")
    roots = _roots(forms.where("form is not null"))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows by letters taken out instead of counts, in DuckDB.
SQL = r"""
WITH RECURSIVE steps AS (
  SELECT range(0, 256) AS bytes
), crc AS (  -- the table of the reflected polynomial, by its rule
  SELECT list_transform(bytes, lambda b: list_reduce(range(0, 8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS entry FROM steps
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (  -- a letter beyond ASCII is two bytes of UTF-8
  SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS b
  FROM counted
), hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda h, x: xor(h >> 8, entry[xor(h & 255, x) + 1]), 4294967295), 4294967295) AS h
  FROM bytes, crc
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), cuts AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM cuts a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, a.word, a.n FROM cuts a JOIN words w ON a.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top_n, first(other ORDER BY n DESC, other) AS top FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN top_n >= 5 * w.n THEN top END AS form, CASE WHEN top_n >= 5 * w.n THEN top_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), roots AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT r.word, f.form, r.steps + 1 FROM roots r JOIN forms f ON r.root = f.word AND f.form IS NOT NULL
)
SELECT f.word, f.form, last_root.root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(root, steps) AS root FROM roots GROUP BY word) last_root USING (word)
"""
