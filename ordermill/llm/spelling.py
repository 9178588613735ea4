"""Grouping spelling variants: words that one edit parts are found by Gram matrices of their letter counts.

One inserted, deleted or replaced letter changes a word's vector of letter counts by a squared distance of 1 or 2. Words are
blocked by how many letters of each of six letter groups they have; an edit moves a word into few other blocks, known in
advance. Two blocks that such a move joins are multiplied as matrices, which gives the squared distances of all their pairs
at once; pairs of the right distance are verified letter by letter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import arrow_map, column, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The letters of a word after A-Z is lower-cased: a-z, then U+00C0 to U+00FF.
LETTERS = _LOWER + "".join(map(chr, range(0xC0, 0x100)))
#: A letter is of group code point % GROUPS; a block is the words with the same number of letters in each group.
GROUPS = 6
#: Words, and letters of all words, in a chunk of a block; two chunks are multiplied at once.
CHUNK, CHUNK_LETTERS = 1024, 1 << 20
#: Pairs times letters that are verified at once.
VERIFIED = 1 << 22


def _moves() -> list[list[int]]:
    """What one edit adds to a word's block, up to direction: nothing (a replacement inside a group), a letter of one group
    less and of a later one more, a letter more."""
    unit = np.eye(GROUPS, dtype=int)
    out = [0 * unit[0]]
    out += [unit[j] - unit[i] for i in range(GROUPS) for j in range(i + 1, GROUPS)]
    out += list(unit)
    return [m.tolist() for m in out]


def _block(word: Column) -> Column:
    groups = ["".join(c for c in LETTERS if ord(c) % GROUPS == g) for g in range(GROUPS)]
    return F.array(*(F.length(word) - F.length(F.translate(word, g, "")) for g in groups))


def count_words(docs: DataFrame, slip: int | None = 31, length: int = 7, count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of ``length`` letters and ``count`` occurrences at least.

    With ``slip``, a run whose crc32 (of ``<id>:<run>``, a null id as ``null``) is a multiple of it loses its letter number
    crc32 % letters, before lengths and occurrences are judged.
    """
    text = F.translate(F.coalesce(column(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(column(id_col).cast("string"), F.lit("null")).alias("id"), F.explode(runs).alias("run"))
    word = F.col("run")
    if slip:
        rows = rows.withColumn("crc", F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8")))
        at = (F.col("crc") % F.length("run")).cast("int")
        word = F.when(F.col("crc") % slip == 0, F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length("run")))).otherwise(word)
    words = rows.select(word.alias("word")).where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return words.where(F.col("n") >= count)


class _Chunks:
    """The words of a batch's chunks: ``letters`` of all of them as numbers, ``first`` letter of each, ``of`` chunk to words."""

    def __init__(self, members: pa.Array):
        self.of = members.offsets.to_numpy()
        flat = members.values
        self.minus, self.words = flat.field("minus"), flat.field("word")
        raw = self.words.cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
        data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(raw) else np.zeros(0, np.uint8)
        single = data < 0x80
        keeps = single | (data < 0xC0)  # a letter beyond ASCII is 0xC3 and a byte that tells it
        before = np.concatenate([[0], np.cumsum(keeps)])
        self.letters = np.where(single, data - 97, (data & 0x3F) + 26)[keeps].astype(np.uint8)
        self.first = before[offsets - offsets[0]]

    def matrix(self, chunk: int) -> np.ndarray:
        """One row of letters per word; all words of a block are equally long."""
        a, b = self.of[chunk], self.of[chunk + 1]
        return self.letters[self.first[a]:self.first[b]].reshape(b - a, -1)


def _counts(words: np.ndarray, kind: type, left: bool) -> np.ndarray:
    """Letter counts with two more columns, so that the product of a left and a right matrix holds squared distances."""
    n, size = len(words), len(LETTERS)
    flat = (np.arange(n)[:, None] * size + words).ravel()
    counts = np.bincount(flat, minlength=n * size).reshape(n, size).astype(kind)
    squares, ones = (counts * counts).sum(axis=1, keepdims=True), np.ones((n, 1), kind)
    return np.hstack([counts, squares, ones] if left else [-2 * counts, ones, squares])


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a, into b) of words that one edit parts. Words of b are as long as those of a or one letter longer;
    ``same``: both are one chunk, and a pair is given once."""
    length, longer = a.shape[1], b.shape[1] - a.shape[1]
    kind = np.float32 if length < 4000 else np.float64  # counts are whole numbers, whose products these hold exactly
    distances = _counts(a, kind, True) @ _counts(b, kind, False).T
    i, j = np.nonzero(distances == (1 if longer else 2))
    if same:
        i, j = i[i < j], j[i < j]
    good = np.zeros(len(i), bool)
    step = max(1, VERIFIED // (length + 1))
    for k in range(0, len(i), step):
        x, y = a[i[k:k + step]], b[j[k:k + step]]
        if longer:
            head = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
            tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            good[k:k + step] = head + tail >= length
        else:
            good[k:k + step] = (x != y).sum(axis=1) == 1
    return i[good], j[good]


def _side(own: _Chunks, i: np.ndarray, other: _Chunks, j: np.ndarray) -> list[pa.Array]:
    """Per word of ``own`` with near words: the word, how many, and the first of them; a chunk's words are in their order of choice."""
    order = np.lexsort((j, i))
    i, j = i[order], j[order]
    new = np.flatnonzero(np.append(True, np.diff(i) != 0))[:len(i)]
    best = pa.array(j[new])
    return [own.words.take(pa.array(i[new])), pa.array(np.diff(np.append(new, len(i))), pa.int64()), other.minus.take(best), other.words.take(best)]


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best for the words of ``words`` (word, n; each once) that have near words: their number and the
    one with the largest n (ties: the smallest by code point).

    Words meet by their blocks' chunks: a chunk is sent once to each chunk of the 22 blocks that one edit may lead to (or
    come from; every pair of chunks is one row). No pair of words leaves a task: a task gives one row per word and side.
    """
    sized = words.select("word", "n", _block(F.col("word")).alias("block"))
    letters = F.aggregate("block", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = sized.groupBy("block").agg(F.count("*").alias("n")).select("block", F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("n") * letters / CHUNK_LETTERS)).cast("int").alias("chunks"))
    sizes = written(sizes, "blocks")
    chunk = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    members = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "word")))
    chunks = sized.join(sizes, "block").groupBy("block", chunk.alias("chunk")).agg(members.alias("members"))
    chunks = written(chunks, "chunks")

    moves = F.array(*(F.array(*map(F.lit, m)) for m in _moves()))
    work = sizes.select(F.col("block").alias("block_a"), F.col("chunks").alias("chunks_a"), F.explode(moves).alias("move"))
    work = work.withColumn("block_b", F.zip_with("block_a", "move", lambda x, y: x + y))
    work = work.join(sizes.select(F.col("block").alias("block_b"), F.col("chunks").alias("chunks_b")), "block_b")
    work = work.withColumn("chunk_a", F.explode(F.sequence(F.lit(0), F.col("chunks_a") - 1))).withColumn("chunk_b", F.explode(F.sequence(F.lit(0), F.col("chunks_b") - 1)))
    work = work.withColumn("one_block", F.col("block_a") == F.col("block_b")).where("not one_block or chunk_a <= chunk_b")
    of = lambda x: chunks.select(F.col("block").alias(f"block_{x}"), F.col("chunk").alias(f"chunk_{x}"), F.col("members").alias(f"members_{x}"))
    work = work.join(of("a"), ["block_a", "chunk_a"]).join(of("b"), ["block_b", "chunk_b"])
    work = work.select((F.col("one_block") & (F.col("chunk_a") == F.col("chunk_b"))).alias("same"), "members_a", "members_b")

    def run(batches):
        for batch in batches:
            same = batch.column("same").to_pylist()
            a, b = _Chunks(batch.column("members_a")), _Chunks(batch.column("members_b"))
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, one in enumerate(same):
                i, j = near_pairs(a.matrix(row), b.matrix(row), one)
                left.append(i + a.of[row])
                right.append(j + b.of[row])
            i, j = np.concatenate(left), np.concatenate(right)
            if len(i):
                for side in (_side(a, i, b, j), _side(b, j, a, i)):
                    yield pa.RecordBatch.from_arrays(side, ["word", "n_near", "minus", "best"])

    found = arrow_map(work, run, "word string, n_near long, minus long, best string")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "best")).alias("b"))
    return found.select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def variants(docs: DataFrame, slip: int | None = 31, length: int = 7, count: int = 2, times: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (see ``count_words``).

    Two words are near if they differ by exactly one inserted, deleted or replaced letter. A word's ``form`` is its near word
    with the largest n (ties: the smallest by code point), if that is ``times`` times the word's own n or more; else null. ``root``
    is the last word on the way over forms, the word itself if it has none. ``n_near`` is the number of near words.

    Null and empty texts have no words; a null id counts as the text ``null``; rows that repeat an id or a text all count. Words of
    any length are compared in full. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    if times < 2:
        raise ValueError("times must be 2 at least: a form must be more frequent than its word")
    words = written(count_words(docs, slip, length, count, id_col, text_col), "words")
    judged = words.join(near_words(words), "word", "left")
    form = F.col("best_n") >= times * F.col("n")
    judged = written(judged.select("word", F.when(form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                   F.when(form, F.col("best_n")).alias("form_n")), "variants").select("word", "form", "n", "n_near", "form_n")
    most = words.agg(F.max("n")).first()[0] or 0
    steps, reach = 0, count  # n grows with every step, which bounds the way to a root
    while reach * times <= most:
        steps, reach = steps + 1, reach * times
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):  # every round doubles the steps taken
        roots = written(roots, "roots").select("word", "root")
        far = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        roots = roots.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
