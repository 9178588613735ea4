"""Removing repeated passages: runs of 13 words are grouped by minimiser and compared where they meet.

Consecutive windows of a text that share a minimiser (the least hash among their runs of MINIMISER words) travel together
as one packed string, a super-k-mer, to the bucket of that minimiser. Equal windows have equal minimisers, so all copies of
a window meet in one bucket, where sorting finds them and the smallest document that has each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_map, buffer, column, ship, slices, squeezed, unsqueezed
from .hashing import BASE, mixed, span_hashes, windows, words

#: Words of a window and of a minimiser.
WINDOW, MINIMISER = 13, 3
#: Text of a part: the documents one task call handles together.
PART_BYTES = 2 << 20
#: A minimiser is crowded if it has more than this share of all super-k-mers, so there are fewer than 1 / CROWDED of them.
CROWDED = 1 / 4000
#: Ids above all: what a null id counts as.
LAST = np.iinfo(np.int64).max


def _least(word: np.ndarray) -> np.ndarray:
    """For every window start (also across texts) the least hash among its minimiser candidates."""
    n = len(word) - WINDOW + 1
    grams = np.zeros(len(word) - MINIMISER + 1, np.uint64)
    for k in range(MINIMISER):
        grams = grams * np.uint64(BASE) + word[k:k + len(grams)]
    grams = mixed(grams)
    least = grams[:n].copy()
    for k in range(1, WINDOW - MINIMISER + 1):
        np.minimum(least, grams[k:k + n], out=least)
    return least


class Cut:
    """The super-k-mers of some texts: ``first`` window and number of windows (``size``) of each occurrence, ``least`` its minimiser."""

    def __init__(self, array: pa.Array, crowded: np.ndarray):
        self.values, offsets = buffer(array)
        self.starts, self.ends, self.before = words(self.values, offsets)
        self.word = span_hashes(self.values, self.starts, self.ends)
        at, _ = windows(self.word, self.before, WINDOW)
        if not len(at):
            self.first = self.size = np.zeros(0, np.int64)
            self.least = np.zeros(0, np.uint64)
            return
        least = _least(self.word)[at]
        new = np.append(True, (np.diff(at) != 1) | (least[1:] != least[:-1]))
        if len(crowded):
            alone = np.isin(least, crowded)
            new |= alone
            new[1:] |= alone[:-1]
        begin = np.flatnonzero(new)
        self.first, self.size, self.least = at[begin], np.diff(np.append(begin, len(at))), least[begin]

    def text_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.before, word, "right") - 1


def crowded_minimisers(docs: DataFrame) -> np.ndarray:
    """Minimisers with more than CROWDED of all super-k-mers, counted in pieces of the corpus.

    A piece reports what has at least half that share in it, so a minimiser that is crowded everywhere is in every report.
    Which minimisers are treated as crowded never changes a result, only where windows are compared.
    """

    def run(batches):
        for batch in slices(batches):
            cut = Cut(batch.column("text"), np.zeros(0, np.uint64))
            least, n = np.unique(cut.least, return_counts=True)
            many = n > max(16, len(cut.least) * CROWDED / 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(least[many].view(np.int64), 0)), pa.array(np.append(n[many], len(cut.least))),
                                              pa.array(np.append(np.zeros(many.sum(), bool), True))], ["least", "n", "all"])

    counted = arrow_map(docs.select("text"), run, "least long, n long, all boolean").groupBy("all", "least").agg(F.sum("n").alias("n"))
    total = counted.where("all").agg(F.sum("n")).first()[0] or 0
    rows = counted.where((~F.col("all")) & (F.col("n") > total * CROWDED)).select("least").collect()  # fewer than 1 / CROWDED
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


def _distinct(cut: Cut, ids: np.ndarray):
    """The distinct super-k-mers of a part: index of one occurrence each, the distinct one of each occurrence, and the smallest id.

    They are numbered by their hashes, so a part gives the same numbers each time, in whatever order its rows come.
    """
    stop = cut.first + cut.size + WINDOW - 1
    one, two = span_hashes(cut.word, cut.first, stop), span_hashes(mixed(cut.word), cut.first, stop)
    order = np.lexsort((two, one))
    new = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0))[:len(order)]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    at = order[new]
    smallest = np.full(len(at), LAST)
    np.minimum.at(smallest, which, ids[cut.text_of(cut.first)])
    return at, which, smallest, one


def _spaced(cut: Cut) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each word starts in that."""
    length = cut.ends - cut.starts
    start = np.concatenate([[0], np.cumsum(length + 1)])
    out = np.full(int(start[-1]), 32, np.uint8)
    shift = np.repeat(cut.starts - start[:-1], length)
    to = np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)
    out[to] = cut.values[to + shift]
    return out.tobytes(), start


def _same_texts(values, start, stop, order, group):
    """``group`` (numbers along ``order``), with members whose bytes differ from the group's first told apart."""
    first = order[np.searchsorted(group, group)]
    length = stop[order] - start[order]
    wrong = length != stop[first] - start[first]
    step = max(1, (4 << 20) // int(length.max() if len(length) else 1))
    repeated = np.flatnonzero((first != order) & ~wrong)
    for i in range(0, len(repeated), step):
        k = repeated[i:i + step]
        n = length[k]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        differs = values[np.repeat(start[order[k]], n) + inner] != values[np.repeat(start[first[k]], n) + inner]
        wrong[k] |= np.logical_or.reduceat(differs, np.cumsum(n) - n)
    if wrong.any():  # two texts with one hash: number these groups by their bytes
        bad = np.isin(group, np.unique(group[wrong]))
        own: dict[tuple, int] = {}
        group = group.copy()
        for k in np.flatnonzero(bad):
            key = (int(group[k]), values[start[order[k]]:stop[order[k]]].tobytes())
            group[k] = -1 - own.setdefault(key, len(own))
        sort = np.argsort(group, kind="stable")
        order, group = order[sort], group[sort]
    return order, group


def _pack(part: int, bucket: np.ndarray, texts: list[bytes], ids: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        own = order[a:b]
        joined = b"\n".join([texts[i] for i in own.tolist()])
        yield {"bucket": int(bucket[own[0]]), "part": part, "numbers": own.astype("<i4").tobytes(), "ids": ids[own].astype("<i8").tobytes(),
               "packed": squeezed(np.frombuffer(joined, np.uint8), level=6), "n_bytes": len(joined)}


_SENT = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("numbers", pa.binary()), ("ids", pa.binary()), ("packed", pa.binary()), ("n_bytes", pa.int64())])
_FOUND = pa.schema([("part", pa.int64()), ("numbers", pa.binary()), ("least_ids", pa.binary()), ("n", pa.int64())])


def _column(table: pa.Table, name: str) -> pa.Array:
    chunks = table.column(name).combine_chunks()
    return chunks.combine_chunks() if isinstance(chunks, pa.ChunkedArray) else chunks


def _ids(table: pa.Table) -> np.ndarray:
    return _column(table, "id").fill_null(LAST).to_numpy(zero_copy_only=False)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words, one space between) for every row of ``docs``.

    A window is 13 consecutive words of one document. Every word is removed that is covered by a window whose word sequence
    also starts in a document with a smaller id; windows are judged on the input. Ids are whole numbers. A null id counts
    as larger than all others. Rows that repeat an id are the same document to each other: they remove nothing from one
    another. Null, empty and short texts have no windows and lose nothing. An empty table gives an empty result; other
    columns are ignored, whatever their names.

    Documents are dealt out by hash into parts of about ``part_bytes``. A part sends each distinct super-k-mer once, with its
    smallest id, so a passage that a third of all documents share reaches its bucket once per part. Windows whose minimiser
    is crowded are sent one by one, by their own hash, so that one frequent run of words with ever different neighbours does
    not fill one bucket. Buckets answer the parts with the smallest ids of windows that others have; the parts, cut again in
    the same way, remove the words. Windows with equal hashes are compared by their bytes.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(column(id_col).cast("long").alias("id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    crowded = crowded_minimisers(docs)
    grouped = docs.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))

    def send(table: pa.Table) -> pa.Table:
        cut = Cut(_column(table, "text"), crowded)
        part = table.column("part")[0].as_py()
        if not len(cut.first):
            return _SENT.empty_table()
        at, _, smallest, one = _distinct(cut, _ids(table))
        spaced, start = _spaced(cut)
        begin, end = start[cut.first[at]].tolist(), (start[cut.first[at] + cut.size[at] + WINDOW - 1] - 1).tolist()
        by = np.where(np.isin(cut.least[at], crowded), mixed(one[at]), mixed(cut.least[at]))
        rows = _pack(part, (by % np.uint64(parts)).astype(np.int64), [spaced[a:b] for a, b in zip(begin, end)], smallest)
        return pa.Table.from_pylist(list(rows), _SENT)

    def compare(table: pa.Table) -> pa.Table:
        texts = [unsqueezed(p, n).tobytes() for p, n in zip(table.column("packed").to_pylist(), table.column("n_bytes").to_pylist())]
        numbers = [np.frombuffer(x, "<i4") for x in table.column("numbers").to_pylist()]
        ids = np.concatenate([np.frombuffer(x, "<i8") for x in table.column("ids").to_pylist()])
        values = np.frombuffer(b"\n".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.flatnonzero(values == 10) + 1, [len(values)]])
        starts, ends, before = words(values, offsets)
        at, hashes = windows(span_hashes(values, starts, ends), before, WINDOW)
        order = np.argsort(hashes, kind="stable")
        group = np.cumsum(np.append(False, np.diff(hashes[order]) != 0))
        order, group = _same_texts(values, starts[at], ends[at + WINDOW - 1], order, group)
        owner = np.searchsorted(before, at, "right") - 1
        edges = np.flatnonzero(np.append(True, np.diff(group) != 0))
        least = np.empty(len(at), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(ids[owner[order]], edges), np.diff(np.append(edges, len(at))))
        told = np.zeros(len(ids), bool)
        told[owner[least < ids[owner]]] = True
        rows, done = [], 0
        for part, own in zip(table.column("part").to_pylist(), numbers):
            some = np.flatnonzero(told[done:done + len(own)])
            if len(some):
                lines = some + done
                low, high = np.searchsorted(owner, lines), np.searchsorted(owner, lines, "right")
                answer = np.concatenate([least[a:b] for a, b in zip(low, high)])
                rows.append({"part": part, "numbers": own[some].tobytes(), "least_ids": squeezed(answer.astype("<i8")), "n": len(answer)})
            done += len(own)
        return pa.Table.from_pylist(rows, _FOUND)

    def remove(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        cut = Cut(_column(table, "text"), crowded)
        ids, n = _ids(table), table.num_rows
        covered = np.zeros(len(cut.word) + 1, np.int64)
        if len(cut.first):
            at, which, least, _ = _distinct(cut, ids)
            size = cut.size[at]
            place = np.cumsum(size) - size
            least = np.repeat(least, size)
            for numbers, packed, count in zip(*(answers.column(c).to_pylist() for c in ("numbers", "least_ids", "n"))):
                own = np.frombuffer(numbers, "<i4")
                k = size[own]
                least[np.repeat(place[own] - (np.cumsum(k) - k), k) + np.arange(k.sum())] = unsqueezed(packed, 8 * count).view("<i8")
            inner = np.arange(cut.size.sum()) - np.repeat(np.cumsum(cut.size) - cut.size, cut.size)
            window = np.repeat(cut.first, cut.size) + inner
            hit = window[least[np.repeat(place[which], cut.size) + inner] < ids[cut.text_of(window)]]
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + WINDOW, -1)
        gone = np.cumsum(covered)[:-1] > 0
        spaced, start = _spaced(cut)
        kept, removed = [], []
        for i in range(n):
            a, b = int(cut.before[i]), int(cut.before[i + 1])
            here = gone[a:b]
            removed.append(int(here.sum()))
            if not removed[-1]:
                kept.append(spaced[start[a]:max(start[a], start[b] - 1)])
            else:
                change = np.flatnonzero(np.diff(np.concatenate([[True], here, [True]]).astype(np.int8)))
                kept.append(b" ".join([spaced[start[a + x]:start[a + y] - 1] for x, y in zip(change[::2], change[1::2])]))
        return pa.table([table.column("id"), pa.array(np.diff(cut.before), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                        ["doc_id", "n_words", "n_removed", "kept"])

    sent = grouped.groupBy("part").applyInArrow(send, "bucket long, part long, numbers binary, ids binary, packed binary, n_bytes long")
    found = sent.groupBy("bucket").applyInArrow(compare, "part long, numbers binary, least_ids binary, n long")
    return grouped.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept string")
