"""N-gram Jaccard join by grouped prefixes.

Of two similar sets, each sorted by one order over all shingles, the first few (the prefix) have a shingle in common. With
rare shingles first, most prefixes hold shingles that no other document has, and meet nothing. Documents with the same size
and the same shared prefix are one group; groups that have a prefix shingle in common, sizes that allow a link and enough
left after it are expanded to their members, whose full sets decide.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import in_blocks
from .components import labelled
from .frames import SLICE_BYTES, arrow_map, buffer, id_type, slices, squeezed, texts, unsqueezed, written
from .hashing import mixed, span_hashes, windows, words

#: Words of a shingle, and the least similarity of a link in hundredths.
SHINGLE, SIMILAR = 4, 85
#: Bits of a shingle's hash, its token, that order and match prefixes (full sets are compared by 64 bits). Where two shingles
#: of a text have one token, its prefix of as many tokens reaches further than it must.
TOKEN_BITS = 48
#: The share of all shingles, by hash, that is ordered by frequency and comes before the rest. A document whose prefix fits
#: into its part of them needs no others, so only this share travels. Documents with too few give all their shingles.
ORDERED = 3 / 8
_EDGE = int(ORDERED * (1 << TOKEN_BITS))
#: Shingles of so many texts or more count as equally frequent, so that a task need not hold all rows of one to count them.
FREQUENT = 1 << 20
#: Rows handled at once inside a task, where each has lists or texts.
PIECE = 500
#: Members of a bucket's block, and bytes of their packed texts, that are compared in one task with as many others.
BLOCK, BLOCK_BYTES = 2048, 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def sets_of(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of lower-cased texts, and how many before each text (one more entry: all)."""
    starts, ends, before = words(values, offsets)
    word = span_hashes(values, starts, ends)
    at, hashes = windows(word, before, SHINGLE)
    n = np.diff(before)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))  # the whole sequence is the one shingle
    if len(short):
        at, hashes = np.concatenate([at, before[short]]), np.concatenate([hashes, span_hashes(word, before[short], before[short + 1])])
    owner = np.searchsorted(before, at, "right") - 1
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1]))[:len(owner)]
    return hashes[new], np.searchsorted(owner[new], np.arange(len(n) + 1))


def prefix_length(n):
    return n - (SIMILAR * n + 99) // 100 + 1


def similar(one: np.ndarray, two: np.ndarray) -> bool:
    same = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * same >= SIMILAR * (len(one) + len(two) - same)


def _cut(docs: DataFrame) -> DataFrame:
    """Every row with its set's size and 128-bit key (null without words); the first row of each key in a task also has its text."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in slices(batches):
            values, offsets = buffer(batch.column("text"))
            values = _LOWER[values]
            sets, of = sets_of(values, offsets)
            keys = np.stack([span_hashes(sets, of[:-1], of[1:]), span_hashes(mixed(sets), of[:-1], of[1:])], axis=1)
            tokens = sets >> np.uint64(64 - TOKEN_BITS)
            own = np.append(True, (np.diff(tokens) != 0))[:len(tokens)]
            own[of[:-1][of[:-1] < len(tokens)]] = True
            counts = [np.diff(np.concatenate([[0], np.cumsum(own & part)])[of]) for part in (tokens < _EDGE, True)]
            key, packed = [], []
            for i in range(batch.num_rows):
                key.append(keys[i].tobytes() if of[i] < of[i + 1] else None)
                new = key[-1] is not None and key[-1] not in seen
                packed.append(squeezed(values[offsets[i]:offsets[i + 1]]) if new else None)
                if new and len(seen) < 1 << 20:  # a task that forgets a key only sends it again
                    seen.add(key[-1])
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(np.diff(of), pa.int64()), *(pa.array(c, pa.int64()) for c in counts),
                       pa.array(key, pa.binary()), pa.array(packed, pa.binary()), pa.array(np.diff(offsets), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n", "n_ordered", "n_tokens", "key", "packed", "n_bytes"])

    docs = docs.withColumn("row", F.monotonically_increasing_id())
    return arrow_map(docs, run, f"doc_id {id_type(docs)}, row long, n long, n_ordered long, n_tokens long, key binary, packed binary, n_bytes long")


def _pieces(batches):
    """Batches of PIECE rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    n = batch.column("n_bytes").to_numpy()
    parts = [unsqueezed(p, k) for p, k in zip(batch.column("packed").to_pylist(), n.tolist())]
    return np.concatenate([np.zeros(0, np.uint8), *parts]), np.concatenate([[0], np.cumsum(n)])


def _tokens(firsts: DataFrame) -> DataFrame:
    """token, row: the ordered shingles of each text, or all where these do not fill its prefix."""

    def run(batches):
        for batch in slices(batches, "packed", SLICE_BYTES // 4):
            sets, of = sets_of(*_unpacked(batch))
            token = (sets >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(of))
            few = batch.column("n_ordered").to_numpy() < prefix_length(np.diff(of))
            sent = np.flatnonzero((token < _EDGE) | few[owner])
            sent = sent[np.append(True, (np.diff(token[sent]) != 0) | (np.diff(owner[sent]) != 0))[:len(sent)]]
            yield pa.RecordBatch.from_arrays([pa.array(token[sent]), batch.column("row").take(pa.array(owner[sent]))], ["token", "row"])

    return arrow_map(firsts.select("row", "n_ordered", "packed", "n_bytes"), run, "token long, row long")


def shared_runs(batches, most: int):
    """Of batches sorted by token, the rows whose token stands in another row, too, with the number of its rows, ``most`` at most.

    A token's rows are held until their number is known or is ``most``, also over the borders of batches.
    """
    token, rows, given = None, [], 0  # the last run: its rows that are not given out yet, and how many are
    for batch in batches:
        tokens, own = batch.column("token").to_numpy(), batch.column("row").to_numpy()
        if not len(tokens):
            continue
        begin = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        size = np.diff(np.append(begin, len(tokens)))
        out, first = [], int(size[0])
        if token is not None and tokens[0] == token:  # the run goes on
            rows.append(own[:first])
        else:
            out += _run(token, rows, given, most)
            token, rows, given = int(tokens[0]), [own[:first]], 0
        if len(begin) > 1:
            out += _run(token, rows, given, most)
            inner = np.repeat(size[1:-1], size[1:-1])
            some = np.flatnonzero(inner > 1)
            out.append((tokens[begin[1]:begin[-1]][some], own[begin[1]:begin[-1]][some], np.minimum(inner[some], most)))
            token, rows, given = int(tokens[-1]), [own[begin[-1]:]], 0
        held = sum(map(len, rows))
        if given or held >= most:
            out.append((np.full(held, token), np.concatenate(rows), np.full(held, most)))
            rows, given = [], given + held
        yield from _batches(out)
    yield from _batches(_run(token, rows, given, most))


def _run(token, rows, given, most):
    """What is left of a run that has ended."""
    held = sum(map(len, rows))
    if held == 0 or given + held < 2:
        return []
    return [(np.full(held, token), np.concatenate(rows), np.full(held, min(given + held, most)))]


def _batches(parts):
    if parts:
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "row", "df"])


def _prefixes(firsts: DataFrame) -> DataFrame:
    """row, n, prefix (token and its position in the sorted set; the prefix shingles that other texts have too) and a 128-bit hash of it."""
    tokens = _tokens(firsts).repartition("token").sortWithinPartitions("token")
    tokens = arrow_map(tokens, lambda batches: shared_runs(batches, FREQUENT), "token long, row long, df long")
    shared = tokens.groupBy("row").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    rows = shared.join(firsts.select("row", "n", "n_ordered", "n_tokens"), "row")

    def run(batches):
        for batch in _pieces(batches):
            shared = batch.column("shared")
            of = shared.offsets.to_numpy().astype(np.int64)
            df, token = (shared.values.field(c).to_numpy()[of[0]:of[-1]] for c in ("df", "token"))
            of, owner = of - of[0], np.repeat(np.arange(batch.num_rows), np.diff(of))
            late = token >= _EDGE
            order = np.lexsort((token, df, late, owner))
            token, late = token[order], late[order]
            n, n_ordered, n_tokens = (batch.column(c).to_numpy() for c in ("n", "n_ordered", "n_tokens"))
            n_late = np.bincount(owner, late, batch.num_rows).astype(np.int64)
            n_early = np.diff(of) - n_late
            # shingles that no other text has come first in either part
            place = np.arange(len(token)) - of[owner]
            alone_early, alone_late = n_ordered - n_early, n_tokens - n_ordered - n_late
            at = np.where(late, (n_ordered + alone_late - n_early)[owner] + place, alone_early[owner] + place)
            held = np.flatnonzero(at < prefix_length(n)[owner])
            token, at, owner = token[held], at[held], owner[held]
            some, first = np.unique(owner, return_index=True)
            ends = np.append(first, len(owner))
            marks = mixed(token.astype(np.uint64)) ^ mixed(at.astype(np.uint64) + np.uint64(1 << TOKEN_BITS))
            pairs = pa.StructArray.from_arrays([pa.array(token), pa.array(at)], ["token", "at"])
            hashes = [span_hashes(x, ends[:-1], ends[1:]).view(np.int64) for x in (marks, mixed(marks))]
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(some)), pa.array(n[some]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), *map(pa.array, hashes)],
                                             ["row", "n", "prefix", "one", "two"])

    return arrow_map(rows, run, "row long, n long, prefix array<struct<token: long, at: long>>, one long, two long")


def _fits(n_a: Column, n_b: Column, at_a: Column, at_b: Column) -> Column:
    """Whether two sets whose first common shingle stands at these positions can be similar, by their sizes and what is left."""
    left = F.least(n_a - at_a, n_b - at_b)
    return (n_a * 100 >= n_b * SIMILAR) & (n_b * 100 >= n_a * SIMILAR) & (left * (100 + SIMILAR) >= (n_a + n_b) * SIMILAR)


def _verified(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def run(batches):
        @lru_cache(maxsize=256)
        def set_of(row, packed, n):
            return sets_of(unsqueezed(packed, n), np.array([0, n]))[0]

        for batch in _pieces(batches):
            columns = [batch.column(c).to_pylist() for c in ("a", "packed_a", "bytes_a", "b", "packed_b", "bytes_b")]
            good = [similar(set_of(*row[:3]), set_of(*row[3:])) for row in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda x: kept.select(F.col("row").alias(x), F.col("packed").alias(f"packed_{x}"), F.col("n_bytes").alias(f"bytes_{x}"))
    return arrow_map(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "packed_a", "bytes_a", "packed_b", "bytes_b"), run, "a long, b long")


def _distinct_buckets(members: DataFrame) -> DataFrame:
    """Of ``members`` (bucket, row, label; a row once per bucket) the buckets whose members have different labels, and of buckets
    with the same members one. Near copies of a long text share hundreds of shingles, and so hundreds of equal buckets."""
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"mark{seed}") for seed in (1, 2)]
    buckets = members.groupBy("bucket").agg(F.count("*").alias("n"), *marks, F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return members.join(buckets.groupBy("n", "mark1", "mark2").agg(F.min("bucket").alias("bucket")).select("bucket"), "bucket")


def _rest(apart: DataFrame, kept: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket whose labels differ; of those that join the same two labels in one task, one.

    Near copies share many buckets, so texts are not sent to each. Rows that buckets connect are a crowd; a crowd that fits into
    one block is compared at once, every pair that shares a bucket, so its texts are sent once. Of larger crowds every
    bucket is compared in blocks, a pair in the least bucket that it shares.
    """
    starts = apart.groupBy("bucket").agg(F.min("row").alias("a"))
    crowds = labelled(apart.join(starts, "bucket").where("row <> a").select("a", F.col("row").alias("b"))).toDF("row", "crowd")
    rows = apart.groupBy("row", "label").agg(F.array_sort(F.collect_list("bucket")).alias("buckets"))
    rows = rows.join(crowds, "row").join(kept, "row")
    sizes = rows.groupBy("crowd").agg(F.count("*").alias("size"), F.sum(F.octet_length("packed")).alias("bytes"))
    fits = (F.col("size") <= BLOCK) & (F.col("bytes") <= BLOCK_BYTES)
    rows = written(rows.join(sizes.select("crowd", fits.alias("fits")), "crowd"), "crowds")
    at_once = rows.where("fits").withColumn("bucket", F.col("crowd")).withColumns({c: F.lit(0) for c in ("block", "low", "high")})
    held = apart.select("bucket", "row").join(rows.where("not fits"), "row")
    columns = ["bucket", "low", "high", "block", "row", "label", "n", "n_bytes", "packed", "buckets"]

    def compared(table: pa.Table, at_once: bool) -> pa.Table:
        get = lambda c: table.column(c).to_numpy()
        row, label, block, n, n_bytes = (get(c) for c in ("row", "label", "block", "n", "n_bytes"))
        bucket, one_block = table.column("bucket")[0].as_py(), table.column("low")[0] == table.column("high")[0]
        packed = table.column("packed")
        told = [b if at_once else b[:b.index(bucket)] for b in table.column("buckets").to_pylist()]
        of = np.concatenate([[0], np.cumsum([len(e) for e in told])])
        _, code = np.unique(np.array([x for e in told for x in e], np.int64), return_inverse=True)
        mark = np.zeros(len(code) + 1, np.int64)
        parent: dict[int, int] = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        @lru_cache(maxsize=2 * BLOCK)
        def set_of(i):
            return sets_of(unsqueezed(packed[i].as_py(), n_bytes[i]), np.array([0, n_bytes[i]]))[0]

        found = []
        for i in np.argsort(row).tolist():
            fits = (label != label[i]) & ((row > row[i]) if one_block else (block > block[i]))
            fits &= (n * 100 >= n[i] * SIMILAR) & (n[i] * 100 >= n * SIMILAR)
            if fits.any():
                mark[code[of[i]:of[i + 1]]] = 1
                common = np.concatenate([[0], np.cumsum(mark[code])])
                mark[code[of[i]:of[i + 1]]] = 0
                fits &= (common[of[1:]] > common[of[:-1]]) if at_once else (common[of[1:]] == common[of[:-1]])
            for j in np.flatnonzero(fits).tolist():
                if root(label[i]) != root(label[j]) and similar(set_of(i), set_of(j)):
                    parent[root(label[i])] = root(label[j])
                    found.append((row[i], row[j]))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def of_crowd(table: pa.Table) -> pa.Table:
        return compared(table, True)

    def of_bucket(table: pa.Table) -> pa.Table:
        return compared(table, False)

    links = at_once.select(*columns).groupBy("bucket", "low", "high").applyInArrow(of_crowd, "a long, b long")
    blocks = in_blocks(held, BLOCK, BLOCK_BYTES).select(*columns)
    return links.union(blocks.groupBy("bucket", "low", "high").applyInArrow(of_bucket, "a long, b long"))


def join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``.

    A text's set is that of its distinct runs of four words, A-Z lower-cased; with one to three words the whole sequence.
    Texts are linked if 100 * intersection >= 85 * union; ``component_id`` is the smallest id reachable over links. Texts
    without words (null, empty, blanks) have no set and are linked with nothing. Equal sets are one class. Null ids never are
    the smallest; a component of null ids only has a null id. Rows that repeat an id are judged by their own texts. An empty
    table gives an empty result; other columns are ignored, whatever their names.

    Only links that join different components matter, so a bucket (the groups with one prefix shingle) is first compared as a
    star: the group with most company against all others. Members that are still apart after that are compared in bounded
    blocks, exactly and in full: no pairs are written there, and no bucket is held whole.
    """
    staged = written(_cut(texts(docs, id_col, text_col)), "sets")
    firsts = staged.where("packed is not null")
    classes = written(staged.where("key is not null").groupBy("key").agg(F.min("row").alias("row"), F.min("doc_id").alias("first_id")), "classes")
    prefixes = _prefixes(firsts).join(classes.select("row"), "row")
    prefixes = written(prefixes.withColumn("group", F.struct("n", "one", "two")), "prefixes")
    groups = prefixes.groupBy("group").agg(F.min("row").alias("gid"), F.count("*").alias("members"))
    members = written(prefixes.select("row", "n", "group").join(groups, "group").select("row", "gid", "members"), "members")

    index = prefixes.join(members.where("row = gid").select("row"), "row").select(F.col("row").alias("gid"), "n", F.inline("prefix"))
    index = index.withColumnRenamed("token", "bucket")
    met = index.groupBy("bucket").agg(F.count("*").alias("groups")).where("groups > 1")
    index = written(index.join(met, "bucket"), "index")
    company = index.groupBy("gid").agg(F.sum("groups").alias("company"))
    centres = index.join(company, "gid").groupBy("bucket").agg(F.max(F.struct("company", F.col("gid").alias("centre"), F.col("n").alias("n_c"), F.col("at").alias("at_c"))).alias("c"))
    stars = index.join(centres.select("bucket", "c.centre", "c.n_c", "c.at_c"), "bucket").where(F.col("gid") != F.col("centre"))
    stars = stars.where(_fits(F.col("n"), F.col("n_c"), F.col("at"), F.col("at_c"))).select("centre", "gid").distinct()
    pairs = stars.join(members.select("gid", "row"), "gid").select(F.col("centre").alias("a"), F.col("row").alias("b"))
    pairs = pairs.union(members.where("row <> gid").select(F.col("gid").alias("a"), F.col("row").alias("b")))

    touched = index.select("gid").union(members.where("row <> gid").select("gid")).distinct()
    kept = written(firsts.select("row", "n", "packed", "n_bytes").join(members.join(touched, "gid").select("row"), "row"), "candidates")
    links = written(_verified(pairs, kept), "links")
    labels = labelled(links)

    inside = members.where("members > 2 and row <> gid").select((-1 - F.col("gid")).alias("bucket"), "row")
    others = index.join(centres.select("bucket", "c.centre"), "bucket").join(members.select("gid", "row"), "gid").where(F.col("row") != F.col("centre"))
    apart = others.select("bucket", "row").union(inside).join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    apart = written(_distinct_buckets(apart), "apart")
    labels = labelled(written(links.union(_rest(apart, kept)), "links"))

    named = classes.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    found = named.join(smallest, "label").select("key", "component_id")
    rows = staged.select("doc_id", "n", "key").join(found, "key", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
