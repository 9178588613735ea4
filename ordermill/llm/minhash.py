"""Near-duplicates by fast similarity sketching: banded sketches propose pairs, full shingle sets confirm them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .blocks import in_blocks
from .components import labelled
from .frames import arrow_map, buffer, column, id_type, slices, squeezed, texts, unsqueezed, written
from .hashing import mixed, span_hashes, windows, words

#: Words of a shingle, and the least similarity of a link in hundredths.
SHINGLE, SIMILAR = 5, 75
#: Coordinates of a sketch and rows of a band. A pair at similarity 0.75 shares none of the 40 bands with a probability of
#: 2.5e-7, at 0.8 of 7e-10.
COORDINATES, ROWS = 160, 4
#: Pairs that no star links are confirmed only if this many of the sketches' bits agree: at 0.75 similarity 140 of 160
#: do on average, with a standard deviation of 4.2; fewer than this with a probability of 7.6e-7.
AGREEING = 118
#: Members of a bucket's block, and bytes of their packed texts, that are compared in one task with as many others.
BLOCK, BLOCK_BYTES = 2048, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fast similarity sketches of sets, one row each. ``counts``: the number of hashes before each set; no set is empty.

    In round i every element of a set goes to one place, chosen by the round's hash; a place keeps the least hash of the
    first round that reached it. After as many rounds as there are places, round t + j sends every element to place j, so
    each place is filled in the end. A set takes part until all its places are filled.
    """
    t, n = COORDINATES, len(counts) - 1
    out = np.full(n * t, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(counts))
    open_ = np.full(n, t)
    for i in range(2 * t):
        if not len(owner):
            break
        h = mixed(hashes + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = owner * t + ((h % np.uint64(t)).astype(np.int64) if i < t else i - t)
        new = np.flatnonzero(out[place] == _EMPTY)
        if not len(new):
            continue
        place, value = place[new], np.minimum(h[new], _EMPTY - np.uint64(1))
        order = np.lexsort((value, place))
        place, value = place[order], value[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        out[place[first]] = value[first]
        filled = np.bincount(place[first] // t, minlength=n)
        open_ -= filled
        if (open_[filled > 0] == 0).any():
            on = open_[owner] > 0
            owner, hashes = owner[on], hashes[on]
    return out.reshape(n, t)


def sketch_bits(s: np.ndarray) -> np.ndarray:
    """One bit of each value of the sketches, as three longs a row. A value's low bits will not do: they tell its place."""
    bits = np.zeros((len(s), 192), np.uint8)
    bits[:, :COORDINATES] = (s >> np.uint64(40)) & np.uint64(1)
    return np.packbits(bits, axis=1).view("<i8")


def differing(bits: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many of the sketches' bits differ, row by row. Counted without sign: of negative numbers numpy counts the absolute value's bits."""
    return np.bitwise_count((bits ^ others).view(np.uint64)).sum(axis=1)


def shingles(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased texts: word hashes, words before each text, shingle hashes, shingles before each text."""
    starts, ends, before = words(values, offsets)
    word = span_hashes(values, starts, ends)
    at, hashes = windows(word, before, SHINGLE)
    n = np.diff(before)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))  # the whole sequence is the one shingle
    if len(short):
        whole = span_hashes(word, before[short], before[short + 1])
        at, hashes = np.concatenate([at, before[short]]), np.concatenate([hashes, whole])
        order = np.argsort(at, kind="stable")
        at, hashes = at[order], hashes[order]
    return word, before, hashes, np.searchsorted(at, before)


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches):
            values, offsets = buffer(batch.column("text"))
            values = _LOWER[values]
            word, before, hashes, counts = shingles(values, offsets)
            n = np.diff(counts)
            size = np.array([len(np.unique(hashes[a:b])) for a, b in zip(counts[:-1], counts[1:])], np.int64)
            some = np.flatnonzero(n)
            s = sketches(hashes, np.append(counts[some], len(hashes)))
            bits = sketch_bits(s)
            bands = np.full((len(some), COORDINATES // ROWS), np.uint64(0))
            for k in range(ROWS):
                bands = bands * np.uint64(0x9E3779B97F4A7C15) + s[:, k::ROWS]
            bands = mixed(bands + mixed(np.arange(1, COORDINATES // ROWS + 1, dtype=np.uint64))).view(np.int64)
            key = np.stack([span_hashes(word, before[some], before[some + 1]), span_hashes(mixed(word), before[some], before[some + 1])], axis=1)
            rows = {i: k for k, i in enumerate(some.tolist())}
            pick = [rows.get(i) for i in range(len(n))]
            columns = [
                batch.column("doc_id"), batch.column("row"), batch.column("text_key"), pa.array(size),
                pa.array([None if k is None else key[k].tobytes() for k in pick], pa.binary()),
                *(pa.array([None if k is None else bits[k, j] for k in pick], pa.int64()) for j in range(3)),
                pa.array([None if k is None else bands[k] for k in pick], pa.list_(pa.int64())),
                pa.array([None if k is None else squeezed(values[offsets[i]:offsets[i + 1]]) for i, k in enumerate(pick)], pa.binary()),
                pa.array(np.diff(offsets), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "text_key", "n_shingles", "key", "bits0", "bits1", "bits2", "bands", "packed", "n_bytes"])

    docs = docs.withColumn("row", F.monotonically_increasing_id()).withColumn("text_key", F.xxhash64("text"))
    return arrow_map(docs, run, f"doc_id {id_type(docs)}, row long, text_key long, n_shingles long, key binary, bits0 long, bits1 long, bits2 long, "
                                "bands array<long>, packed binary, n_bytes long")


def _confirmed(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def run(batches):
        @lru_cache(maxsize=256)
        def shingle_set(row, packed, n):
            values = unsqueezed(packed, n)
            return np.unique(shingles(values, np.array([0, n]))[2])

        for batch in batches:
            a, b, pa_, na, pb, nb = (batch.column(c).to_pylist() for c in ("a", "b", "packed_a", "n_a", "packed_b", "n_b"))
            good = []
            for i in range(len(a)):
                good.append(_similar(shingle_set(a[i], pa_[i], na[i]), shingle_set(b[i], pb[i], nb[i])))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda x: kept.select(F.col("row").alias(x), F.col("packed").alias(f"packed_{x}"), F.col("n_bytes").alias(f"n_{x}"), F.col("n_shingles").alias(f"s_{x}"))
    near = F.col("s_a") * 100 >= F.col("s_b") * SIMILAR, F.col("s_b") * 100 >= F.col("s_a") * SIMILAR
    both = pairs.join(of("a"), "a").join(of("b"), "b").where(near[0] & near[1]).select("a", "b", "packed_a", "n_a", "packed_b", "n_b")
    return arrow_map(both, run, "a long, b long")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (bucket, row, label) of buckets whose members do not all have one label yet."""
    members = members.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    differing = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
    return members.join(differing, "bucket")


def _links_in_blocks(apart: DataFrame, kept: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket whose labels differ; of those that join the same two labels in one block, one.

    Candidates are compared and confirmed in bounded blocks (see ``in_blocks``) and only links come out: neither pairs nor a
    whole bucket are ever held together. A pair is looked at in the first band it shares.
    """
    rows = in_blocks(apart.join(kept.select("row", "packed", "n_bytes", "n_shingles", "bits0", "bits1", "bits2", "bands"), "row"), BLOCK, BLOCK_BYTES)

    def run(table: pa.Table) -> pa.Table:
        column_of = lambda c: table.column(c).to_numpy()
        row, label, block, size = (column_of(c) for c in ("row", "label", "block", "n_shingles"))
        bits = np.stack([column_of(f"bits{k}") for k in range(3)], axis=1)
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        bucket, same_block = table.column("bucket")[0].as_py(), table.column("low")[0] == table.column("high")[0]
        packed, n_bytes = table.column("packed"), column_of("n_bytes")
        parent: dict[int, int] = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        @lru_cache(maxsize=2 * BLOCK)
        def shingle_set(i):
            return np.unique(shingles(unsqueezed(packed[i].as_py(), n_bytes[i]), np.array([0, n_bytes[i]]))[2])

        found = []
        for i in np.argsort(row).tolist():
            fits = (label != label[i]) & ((row > row[i]) if same_block else ((block != block[i]) & (block > block[i])))
            fits &= (size * 100 >= size[i] * SIMILAR) & (size[i] * 100 >= size * SIMILAR)
            fits &= differing(bits, bits[i]) <= COORDINATES - AGREEING
            some = np.flatnonzero(fits)
            if len(some):
                equal = bands[some] == bands[i]
                some = some[bands[i][equal.argmax(axis=1)] == bucket]
            for j in some.tolist():
                if root(label[i]) != root(label[j]) and _similar(shingle_set(i), shingle_set(j)):
                    parent[root(label[i])] = root(label[j])
                    found.append((row[i], row[j]))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table([pa.array(pairs.min(axis=1) if len(pairs) else pairs[:, 0]), pa.array(pairs.max(axis=1) if len(pairs) else pairs[:, 1])], ["a", "b"])

    return rows.groupBy("bucket", "low", "high").applyInArrow(run, "a long, b long")


def _similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sets, as sorted arrays, are similar enough."""
    same = len(one) + len(two) - len(np.unique(np.concatenate([one, two])))
    return 100 * same >= SIMILAR * (len(one) + len(two) - same)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    A text's set is that of its distinct runs of five words, A-Z lower-cased; with one to four words the whole sequence.
    Texts with similarity 0.75 or more are linked; ``component_id`` is the smallest id reachable over links, ``kept`` says
    that it is the row's own. Texts without words (null, empty, blanks) have no set and are linked with nothing. Rows with
    equal words are one class, judged once; rows that repeat an id are judged by their own texts. Null ids never are the
    smallest; a group of only null ids has a null component and keeps all its rows. An empty table gives an empty result;
    other columns are ignored, whatever their names.

    Pairs come from the buckets of banded sketches, first as stars: the member with most company in all its buckets is
    compared with all others, so that the text which many are copies of is found. Only buckets whose members are still
    apart after that are looked at in full, block by block, and of those only pairs of different components whose sizes
    and sketches' bits allow a link. So a group of many near copies sends a few rows per member, and no link is left out
    but with the sketch's own probability. Every link is confirmed on the full sets. Hot buckets and hot members meet in
    inner joins and bounded blocks only.
    """
    staged, named = _linked(docs, id_col, text_col)
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    found = named.join(smallest, "label").select("key", "component_id")
    rows = staged.select("doc_id", "n_shingles", "key").join(found, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _linked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The staged rows, and the classes of equal words: key, row, first_id, first (the least id with its text_key) and label.

    Classes with one label are one component. ``first`` is null where all ids are.
    """
    staged = written(_sketched(texts(docs, id_col, text_col)), "sketches")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("first")
    classes = staged.where("key is not null").groupBy("key").agg(F.min("row").alias("row"), F.min("doc_id").alias("first_id"), first)
    classes = written(classes, "classes")
    banded = staged.select("row", "bands").join(classes.select("row"), "row").select("row", F.explode("bands").alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(banded.join(crowded, "bucket"), "buckets")
    company = members.groupBy("row").agg(F.sum("n").alias("company"))
    kept = staged.select("row", "packed", "n_bytes", "n_shingles", "bits0", "bits1", "bits2", "bands").join(company, "row")
    kept = written(kept, "candidates")
    centres = members.join(kept.select("row", "company"), "row").groupBy("bucket").agg(F.max(F.struct("company", "row")).alias("c"))
    stars = members.join(centres.select("bucket", F.col("c.row").alias("centre")), "bucket").where("row <> centre")
    stars = stars.select(F.least("centre", "row").alias("a"), F.greatest("centre", "row").alias("b")).distinct()
    links = written(_confirmed(stars, kept), "links")
    labels = labelled(links)

    apart = written(_apart(members.select("bucket", "row"), labels), "apart")
    links = written(links.union(_links_in_blocks(apart, kept)), "links")
    labels = labelled(links)

    return staged, classes.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that with the smallest id.

    Where the smallest id stands at several texts of a component, the text with the least xxhash64 is taken, and of rows with
    equal id and text that whose other columns come first as JSON. Components with null ids only keep all their rows, as no
    id tells these apart. A text without words is a component of its own; of equal ones with one id, one is kept.

    Rows that repeat neither id nor text need no comparison and pass a semi-join; only the others are grouped.
    """
    staged, named = _linked(docs, id_col, text_col)
    named = written(named.select("key", "label", "first"), "named")
    firsts = named.groupBy("label").agg(F.min("first").alias("first"))
    nameless = named.join(firsts.where("first is null").select("label"), "label").select("key")
    keyed = staged.select("doc_id", "text_key", "key")
    chosen = (firsts.where("first is not null").select("first.*")
              .union(keyed.where("key is null").select("doc_id", "text_key").distinct())
              .union(keyed.where("doc_id is null").distinct().join(nameless, "key").select("doc_id", "text_key")).distinct())
    repeats = keyed.where("doc_id is not null").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").withColumn("repeated", F.lit(True))
    chosen = chosen.join(repeats, ["doc_id", "text_key"], "left")
    chosen = chosen.select("doc_id", "text_key", F.coalesce("repeated", F.lit(False)).alias("repeated"))
    crowd = Observation()  # counted while the choice is stored
    chosen = written(chosen.observe(crowd, F.count_if("repeated").alias("n")), "chosen").select("doc_id", "text_key", "repeated")

    # the row travels as a struct, so that its columns may have any names
    others = F.to_json(F.struct(*(column(c) for c in docs.columns if c not in (id_col, text_col)), F.lit(0).alias("__none")))
    whole = docs.select(F.struct(*(column(c) for c in docs.columns)).alias("whole"), column(id_col).alias("id"), others.alias("others"),
                        F.xxhash64(F.coalesce(column(text_col).cast("string"), F.lit(""))).alias("key"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    single = whole.drop("others").join(chosen.where("not repeated"), same, "left_semi").select("whole.*")
    if not crowd.get["n"]:
        return single
    several = whole.join(chosen.where("repeated"), (F.col("id") == F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left_semi")
    several = several.groupBy("id", "key").agg(F.min_by("whole", "others").alias("whole"))
    return single.union(several.select("whole.*"))
