"""Removing repeated byte strings: a difference-cover suffix order wherever equal strings can meet.

Equal strings of WINDOW bytes hold the same anchor, the least hash among their GRAM-byte grams. So texts are cut into runs of
windows with one anchor; runs whose anchor stands nowhere else are done, and the others meet in the bucket of their anchor.
There all suffixes are sorted by the difference-cover algorithm: sampled triples are sorted and named, the names are sorted
by the same step until they cover a window, the remaining suffixes are merged in, and neighbours' first WINDOW bytes are
compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_map, buffer, column, ship, slices, squeezed, unsqueezed
from .hashing import BASE, INVERSE, mixed, powers, span_hashes

#: Bytes of a string that must not repeat, of the grams that anchor it, and of a symbol of the suffix order.
WINDOW, GRAM, SYMBOL = 200, 32, 8
#: Text of a part: the documents one task call handles together; and how much of it is hashed at once, so that it stays in cache.
PART_BYTES, STEP_BYTES = 8 << 20, 1 << 16
#: Buckets per part.
BUCKETS = 4
#: A gram is crowded if it anchors more than this share of all places, and more than LEAST of them. Fewer than 1 / CROWDED are.
CROWDED, LEAST = 1 / 50_000, 64
#: Set in a crowded gram's hash, so that any other gram is less.
_HIGH = np.uint64(1 << 63)
#: Low grams, the first that are looked at: about 8 in a window.
_LOW = np.uint64((1 << 63) * 8 // (WINDOW - GRAM + 1))


# --- the suffix order of one bucket


def _joint(*groups: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """One number per element of each group of key columns, that compare as the keys do, across all groups."""
    bits = [max(int(g[k].max()).bit_length() if len(g[k]) else 0 for g in groups) for k in range(len(groups[0]))]
    if sum(bits) <= 64:
        out = []
        for g in groups:
            key = g[0].astype(np.uint64)
            for k in range(1, len(g)):
                key = (key << np.uint64(bits[k])) | g[k].astype(np.uint64)
            out.append(key)
        return out
    columns = [np.concatenate([g[k] for g in groups]) for k in range(len(groups[0]))]
    order = np.lexsort(columns[::-1])
    new = np.logical_or.reduce([np.append(True, c[order][1:] != c[order][:-1]) for c in columns])
    key = np.empty(len(order), np.uint64)
    key[order] = np.cumsum(new)
    return np.split(key, np.cumsum([len(g[0]) for g in groups])[:-1])


def _named(at: np.ndarray, keys: tuple[np.ndarray, ...], n: int) -> np.ndarray:
    """For all n places the rank of their key among those of ``at``, from 1; 0 elsewhere."""
    key = _joint(keys)[0]
    order = np.argsort(key)
    names = np.zeros(n, np.int64)
    names[at[order]] = np.cumsum(np.append(True, key[order][1:] != key[order][:-1]))
    return names


def suffix_ranks(at: np.ndarray, names: np.ndarray, step: int) -> np.ndarray:
    """Ranks from 1 of the suffixes at ``at`` (ascending) by at least their first WINDOW bytes; ties may share a rank.

    ``names`` holds, for every place, the rank of its first ``step`` bytes, and 0 past the end. The places whose block of
    ``step`` bytes is the second or third of three are the sample: its triples are named and the sample is ranked by its
    names, three times as far apart. Every other place is one step before a place of the sample.
    """
    n = len(names)
    padded = np.append(names, np.zeros(2 * step, np.int64))
    if 3 * step >= WINDOW:
        return _named(at, (padded[at], padded[at + step], padded[at + 2 * step]), n)
    third = at // step % 3
    rest, one, two = at[third == 0], at[third == 1], at[third == 2]
    sample = at[third != 0]
    ranks = suffix_ranks(sample, _named(sample, (padded[sample], padded[sample + step], padded[sample + 2 * step]), n), 3 * step)
    tail = np.append(ranks, np.zeros(2 * step, np.int64))
    rest_one, own_one = _joint((padded[rest], tail[rest + step]), (padded[one], tail[one + step]))
    rest_two, own_two = _joint((padded[rest], padded[rest + step], tail[rest + 2 * step]), (padded[two], padded[two + step], tail[two + 2 * step]))
    by_one, by_two, sampled = np.sort(rest_one), np.sort(rest_two), np.sort(ranks[sample])
    merged = np.zeros(n, np.int64)
    merged[rest] = 1 + np.searchsorted(by_one, rest_one) + np.searchsorted(np.sort(own_one), rest_one) + np.searchsorted(np.sort(own_two), rest_two)
    merged[one] = 1 + np.searchsorted(sampled, ranks[one]) + np.searchsorted(by_one, own_one)
    merged[two] = 1 + np.searchsorted(sampled, ranks[two]) + np.searchsorted(by_two, own_two)
    return merged


def repeated_windows(values: np.ndarray, judged: np.ndarray) -> np.ndarray:
    """Which of the windows at ``judged`` (ascending) have the same bytes as another of them.

    A window that holds a symbol which stands nowhere else is discarded; the others are ordered, in a text that only holds what they cover.
    """
    found = np.zeros(len(judged), bool)
    symbol, single = _symbols(values)
    before = np.concatenate([[0], np.cumsum(single)])
    left = np.flatnonzero(before[judged + (WINDOW - SYMBOL + 1)] == before[judged])
    if len(left) < 2:
        return found
    cover = np.zeros(len(values) + 1, np.int64)
    stretch = np.flatnonzero(np.append(True, np.diff(judged[left]) >= WINDOW))
    cover[judged[left][stretch]] = 1
    cover[judged[left][np.append(stretch[1:], len(left)) - 1] + WINDOW] -= 1
    covered = np.cumsum(cover[:-1]) > 0
    place = np.cumsum(covered) - 1
    found[left] = _ordered_repeats(values[covered], place[judged[left]])
    return found


def _symbols(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The SYMBOL bytes at every place (zeros past the end) as a number, and which of them stand nowhere else."""
    n = len(values)
    symbol = np.zeros(n + WINDOW, np.uint64)
    for k in range(SYMBOL):
        symbol[:n - k] |= values[k:].astype(np.uint64) << np.uint64(8 * (SYMBOL - 1 - k))
    order = np.argsort(symbol[:n])
    new = np.append(True, np.diff(symbol[order]) != 0)
    single = np.zeros(n, bool)
    single[order] = new & np.append(new[1:], True)
    return symbol, single


def _ordered_repeats(values: np.ndarray, judged: np.ndarray) -> np.ndarray:
    """``repeated_windows`` by the suffix order alone."""
    n = len(values)
    found = np.zeros(len(judged), bool)
    symbol, _ = _symbols(values)
    ranks = suffix_ranks(np.arange(n), _named(np.arange(n), (symbol[:n],), n), SYMBOL)
    order = np.argsort(ranks[judged])
    a, b = judged[order[:-1]], judged[order[1:]]
    same = np.arange(len(a))
    for k in range(0, WINDOW, SYMBOL):
        same = same[symbol[a[same] + k] == symbol[b[same] + k]]
    found[order[same]] = True
    found[order[same + 1]] = True
    return found


# --- anchors and runs of texts


def _member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values of ``x`` stand in the ascending ``ordered``."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _extremes(x: np.ndarray, low: np.ndarray, high: np.ndarray, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of x[low:high] for each pair; none may be empty."""
    out = np.empty(len(low), x.dtype)
    size, width = high - low, 1
    while len(x):
        own = np.flatnonzero((size >= width) & (size < 2 * width))
        out[own] = pick(x[low[own]], x[high[own] - width])
        x = pick(x[:-width], x[width:]) if (size >= 2 * width).any() else x[:0]
        width *= 2
    return out


def _gram_hashes(values: np.ndarray) -> np.ndarray:
    """``mixed`` of a rolling hash of the GRAM bytes at each place, without its highest bit; worked out in place."""
    n = len(values)
    terms = values.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(BASE, n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(terms, out=sums[1:])
    gram = np.subtract(sums[GRAM:], sums[:-GRAM])
    gram *= powers(INVERSE, n)[:len(gram)]
    shifted = terms[:len(gram)]
    for by, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        np.right_shift(gram, np.uint64(by), out=shifted)
        gram ^= shifted
        if times > 1:
            gram *= np.uint64(times)
    gram &= ~_HIGH
    return gram


class Runs:
    """Runs of neighbouring windows with one anchor: ``first`` window (byte), ``size`` in windows, ``anchor``; and ``places``, the anchors' hashes wherever they stand (``at``).

    Only low grams are looked at, of which nearly every window holds some; and all grams of a stretch as wide as a window's without one.
    """

    def __init__(self, values: np.ndarray, offsets: np.ndarray, crowded: np.ndarray):
        none = np.zeros(0, np.int64)
        self.first, self.size, self.anchor, self.places, self.at = none, none, none.astype(np.uint64), none.astype(np.uint64), none
        n, width = len(values), WINDOW - GRAM + 1
        long = np.flatnonzero(np.diff(offsets) >= WINDOW)
        if not len(long):
            return
        gram = _gram_hashes(values)
        at = np.flatnonzero(gram <= _LOW)
        at = at[~_member(gram[at], crowded)]
        edges = np.concatenate([[-1], at, [len(gram)]])
        gap = np.flatnonzero(np.diff(edges) > width)
        if len(gap):
            length = edges[gap + 1] - edges[gap] - 1
            between = np.repeat(edges[gap] + 1 - (np.cumsum(length) - length), length) + np.arange(length.sum())
            gram[between[_member(gram[between], crowded)]] |= _HIGH
            at = np.sort(np.concatenate([at, between]))
        own = gram[at]
        # the grams that windows hold change only here; between ``start`` and ``stop`` of a text all windows are whole
        start, stop = offsets[long], offsets[long + 1] - WINDOW + 1
        begin = np.sort(np.concatenate([start, stop, at - width + 1, at + 1]))
        begin = begin[np.append(True, begin[1:] != begin[:-1]) & (begin >= 0) & (begin <= n - WINDOW + 1)]
        text = np.searchsorted(start, begin, "right") - 1
        whole = np.flatnonzero((text >= 0) & (begin < stop[text]))
        end, begin = begin[whole + 1], begin[whole]
        least = _extremes(own, np.searchsorted(at, begin), np.searchsorted(at, begin + width), np.minimum)
        new = np.flatnonzero(np.append(True, (begin[1:] != end[:-1]) | (least[1:] != least[:-1])))
        self.first, self.anchor = begin[new], least[new]
        last = end[np.append(new[1:], len(end)) - 1] - 1
        self.size = last - self.first + 1
        # a gram anchors some window if the largest of the anchors of the runs around it is its own
        low, high = np.searchsorted(last, at - width + 1), np.searchsorted(self.first, at, "right")
        near = np.flatnonzero(low < high)
        near = near[_extremes(self.anchor, low[near], high[near], np.maximum) == own[near]]
        self.at, self.places = at[near], own[near]

    def alone(self) -> np.ndarray:
        """Which runs hold their anchor only once."""
        low = np.searchsorted(self.at, self.first)
        n = np.searchsorted(self.at, self.first + self.size + WINDOW - GRAM) - low
        inner = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        same = self.places[inner] == np.repeat(self.anchor, n)
        return np.bincount(np.repeat(np.arange(len(n)), n), weights=same, minlength=len(n)) == 1


def _steps(array: pa.Array):
    """values, offsets and first row of pieces of a text column, whole texts of about STEP_BYTES together."""
    values, offsets = buffer(array)
    at = 0
    while at < len(array):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP_BYTES, "right")) - 1)
        yield values[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], at
        at = to


def crowded_grams(docs: DataFrame) -> np.ndarray:
    """Grams that anchor so many places that their bucket would be too full: a bounded number, counted over all texts."""

    def run(batches):
        for batch in slices(batches):
            places = [Runs(values, offsets, np.zeros(0, np.uint64)).places for values, offsets, _ in _steps(batch.column("text"))]
            gram, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *places]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], ["gram", "n"])

    counts = arrow_map(docs.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > LEAST)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = total / (WINDOW - GRAM + 2) * 2  # what random hashes give
    rows = counts.where(F.col("n") > places * CROWDED).select("gram").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


# --- the distributed part


def _column(table: pa.Table, name: str) -> pa.Array:
    chunks = table.column(name).combine_chunks()
    return chunks.combine_chunks() if isinstance(chunks, pa.ChunkedArray) else chunks


def _split(part: int, bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        yield int(bucket[order[a]]), order[a:b]


_ANCHORS = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("grams", pa.binary()), ("twice", pa.binary())])
_REPEATED = pa.schema([("part", pa.int64()), ("grams", pa.binary())])
_STRINGS = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("sizes", pa.binary()), ("grams", pa.binary()), ("twice", pa.binary()), ("alone", pa.binary()), ("packed", pa.binary()), ("n_bytes", pa.int64())])
_FOUND = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("bits", pa.binary())])


def _keys(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """128 bits for each run's bytes."""
    stop = first + size + WINDOW - 1
    return np.stack([span_hashes(values, first, stop), span_hashes(values ^ np.uint8(0x5A), first, stop)], axis=1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) for every row of ``docs``.

    Every byte of a text's UTF-8 form is removed that is covered by a string of 200 bytes which also starts anywhere else,
    in any row or elsewhere in the same one; overlapping strings count, and strings are judged on the input. ``n_spans`` are
    the maximal removed runs. Null, empty and short texts lose nothing. Null ids are kept as they are; rows that repeat an
    id or are equal are rows like any other. An empty table gives an empty result; other columns are ignored, whatever their
    names.

    Documents are dealt out by hash into parts of about ``part_bytes``. Parts first send only the hashes of their anchors;
    then, for anchors that stand in two places, each distinct run of windows once; buckets answer with the windows that repeat.
    A gram that anchors very many places is passed over by every window that holds any other gram, so a passage that a third
    of all documents share meets itself only in windows that lie inside it, and those are alike and sent once per part.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    buckets = parts * BUCKETS
    crowded = crowded_grams(docs)
    grouped = docs.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))

    def bucket_of(gram):
        return (mixed(gram) % np.uint64(buckets)).astype(np.int64)

    def send_anchors(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        places = [Runs(values, offsets, crowded).places for values, offsets, _ in _steps(_column(table, "text"))]
        gram, n = np.unique(np.concatenate(places), return_counts=True)
        rows = [{"bucket": b, "part": part, "grams": gram[own].tobytes(), "twice": (n[own] > 1).tobytes()} for b, own in _split(part, bucket_of(gram))]
        return pa.Table.from_pylist(rows, _ANCHORS)

    def match_anchors(table: pa.Table) -> pa.Table:
        grams = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        twice = [np.frombuffer(x, bool) for x in table.column("twice").to_pylist()]
        gram, which, n = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        n = n + np.bincount(which, weights=np.concatenate(twice), minlength=len(gram))
        many = np.split(n[which] > 1, np.cumsum([len(g) for g in grams])[:-1])
        rows = [{"part": part, "grams": g[m].tobytes()} for part, g, m in zip(table.column("part").to_pylist(), grams, many) if m.any()]
        return pa.Table.from_pylist(rows, _REPEATED)

    def send_strings(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return _STRINGS.empty_table()
        repeated = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in answers.column("grams").to_pylist()]))
        seen: dict[bytes, list] = {}
        for values, offsets, _ in _steps(_column(table, "text")):
            runs = Runs(values, offsets, crowded)
            some = _member(runs.anchor, repeated)
            text = values.tobytes()
            for a, n, gram, alone in zip(*(x[some].tolist() for x in (runs.first, runs.size, runs.anchor, runs.alone()))):
                seen.setdefault(text[a:a + n + WINDOW - 1], [0, gram, alone])[0] += 1
        strings = list(seen)
        times = np.array([seen[s][0] for s in strings], np.int64)
        grams = np.array([seen[s][1] for s in strings], np.uint64)
        alone = np.array([seen[s][2] for s in strings], bool)
        rows = []
        for b, own in _split(0, bucket_of(grams)):
            chosen = [strings[i] for i in own.tolist()]
            joined = np.frombuffer(b"".join(chosen), np.uint8)
            rows.append({"bucket": b, "part": key[0].as_py(), "sizes": np.array([len(s) for s in chosen], "<i8").tobytes(), "twice": (times[own] > 1).tobytes(),
                         "grams": grams[own].tobytes(), "alone": alone[own].tobytes(), "packed": squeezed(joined), "n_bytes": len(joined)})
        return pa.Table.from_pylist(rows, _STRINGS)

    def compare(table: pa.Table) -> pa.Table:
        strings: dict[bytes, int] = {}
        twice, once, grams, of = [], [], [], []
        for sizes, gram, more, alone, packed, n in zip(*(table.column(c).to_pylist() for c in ("sizes", "grams", "twice", "alone", "packed", "n_bytes"))):
            text, stop = unsqueezed(packed, n).tobytes(), np.cumsum(np.frombuffer(sizes, "<i8"))
            own = []
            each = zip([0, *stop[:-1].tolist()], stop.tolist(), *(np.frombuffer(x, kind).tolist() for x, kind in ((gram, np.uint64), (more, bool), (alone, bool))))
            for a, b, g, again, single in each:
                k = strings.setdefault(text[a:b], len(strings))
                if k == len(twice):
                    twice.append(again)
                    once.append(single)
                    grams.append(g)
                else:
                    twice[k] = True
                own.append(k)
            of.append(own)
        values = np.frombuffer(b"".join(strings), np.uint8)
        length = np.fromiter(map(len, strings), np.int64, len(strings))
        first, size = np.cumsum(length) - length, length - WINDOW + 1
        stop = np.cumsum(size)
        # a string that is the only one with its anchor, and holds it once, has no window in common with any other place but its copies
        _, which, n = np.unique(np.array(grams, np.uint64), return_inverse=True, return_counts=True)
        sort = (n[which] > 1) | ~np.array(once, bool)
        found = np.repeat(np.array(twice, bool), size)
        some = np.flatnonzero(sort)
        if len(some):
            own = np.concatenate([values[first[k]:first[k] + length[k]] for k in some])
            at = np.cumsum(length[some]) - length[some]
            n = size[some]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(stop[some] - n, n) + inner
            found[place] |= repeated_windows(own, np.repeat(at, n) + inner)
        any_found = np.logical_or.reduceat(found, stop - size)
        keys = _keys(values, first, size)
        rows = []
        for part, own in zip(table.column("part").to_pylist(), of):
            own = np.array(own, np.int64)
            own = own[any_found[own]]
            if len(own):
                bits = np.concatenate([found[stop[k] - size[k]:stop[k]] for k in own])
                rows.append({"part": part, "keys": keys[own].tobytes(), "sizes": size[own].astype("<i8").tobytes(), "bits": squeezed(np.packbits(bits))})
        return pa.Table.from_pylist(rows, _FOUND)

    def remove(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        known = np.zeros((0, 2), np.uint64)
        sizes, bits = np.zeros(0, np.int64), np.zeros(0, bool)
        if answers.num_rows:
            known = np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in answers.column("keys").to_pylist()])
            each = [np.frombuffer(x, "<i8") for x in answers.column("sizes").to_pylist()]
            sizes = np.concatenate(each)
            bits = np.concatenate([np.unpackbits(unsqueezed(x, int(-(-n.sum() // 8))))[:n.sum()] for x, n in zip(answers.column("bits").to_pylist(), each)]).astype(bool)
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(known[:, 0], kind="stable")
        known, begin = known[order], begin[order]
        halves = np.ascontiguousarray(known[:, 0])
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for values, offsets, _ in _steps(_column(table, "text")):
            covered = np.zeros(len(values) + 1, np.int64)
            if len(known):
                runs = Runs(values, offsets, crowded)
                keys = _keys(values, runs.first, runs.size)
                place = np.minimum(np.searchsorted(halves, keys[:, 0]), len(halves) - 1)
                hit = np.flatnonzero((known[place] == keys).all(axis=1))
                size = runs.size[hit]
                inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                window = (np.repeat(runs.first[hit], size) + inner)[bits[np.repeat(begin[place[hit]], size) + inner]]
                np.add.at(covered, window, 1)
                np.add.at(covered, window + WINDOW, -1)
            gone = np.cumsum(covered)[:-1] > 0
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                here, text = gone[a:b], values[a:b]
                n_bytes.append(b - a)
                n_removed.append(int(here.sum()))
                n_spans.append(int((np.diff(here.astype(np.int8), prepend=0) == 1).sum()) if n_removed[-1] else 0)
                kept.append((text[~here] if n_removed[-1] else text).tobytes())
        return pa.table([table.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], names)

    by_part = grouped.groupBy("part")
    anchors = by_part.applyInArrow(send_anchors, "bucket long, part long, grams binary, twice binary")
    repeated = anchors.groupBy("bucket").applyInArrow(match_anchors, "part long, grams binary")
    strings = by_part.cogroup(repeated.groupBy("part")).applyInArrow(send_strings, "bucket long, part long, sizes binary, grams binary, twice binary, alone binary, packed binary, n_bytes long")
    found = strings.groupBy("bucket").applyInArrow(compare, "part long, keys binary, sizes binary, bits binary")
    return by_part.cogroup(found.groupBy("part")).applyInArrow(remove, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")
