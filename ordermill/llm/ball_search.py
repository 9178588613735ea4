"""Ranked lexical search: the exact best documents of each query by inner products, pruned by ball trees.

A document is a sparse vector with a whole number per query term: what the term adds to a score there, by its weight, its
frequency and the length. A query is the vector of how often it has each term; a score is their inner product. Tasks arrange their documents in a binary tree of balls. By
Cauchy and Schwarz no document of a ball scores above query * centre + |query| * radius. As the vectors are sparse and a query
looks at few terms, a ball also has a radius along each term (how far a document goes beyond the centre there), and with
these no document scores above query * (centre + radii); the lower bound counts. Balls are opened best first until the next
one's bound is below the score of the last place. Bounds are rounded up; what decides are exact scores in integers.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import arrow_map, buffer, column, id_type, slices, written
from .hashing import span_hashes, words

#: Bytes that are no part of a term: all of ASCII but digits and letters. Fixed values.
APART = np.zeros(256, bool)
APART[:128] = True
APART[48:58] = APART[65:91] = APART[97:123] = False
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
#: The same as a pattern.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Distinct terms of all queries that are searched at once; more queries are taken in blocks.
BLOCK_TERMS = 50_000
#: Documents of a leaf, and of a tree.
LEAF, TREE = 32, 8192
#: Bounds are raised by this share. Sums of n products of doubles err by less than n * 2**-52 of the sum of their absolute
#: values, which for the terms of a block is far below it.
SLACK = 1e-9


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Queries:
    """Queries as rows of a sparse matrix of whole numbers; ``norm`` is rounded up."""

    def __init__(self, rows: list[list[tuple[int, int]]], size: int):
        self.size, self.n = size, len(rows)
        self.of = np.cumsum([0, *map(len, rows)])
        self.terms = np.array([t for row in rows for t, _ in row], np.int64)
        self.times = np.array([n for row in rows for _, n in row], np.int64)
        squares = self.times.astype(float) ** 2
        self.norm = np.sqrt(_sums(squares, self.of)) * (1 + SLACK)

    def products(self, centre: np.ndarray) -> np.ndarray:
        return _sums(self.times * centre[self.terms], self.of)


def _sums(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sums of values[of[k]:of[k + 1]]."""
    running = np.empty(len(values) + 1, values.dtype)
    running[0] = 0
    if values.dtype.kind == "i":
        np.cumsum(values, out=running[1:])
        return running[of[1:]] - running[of[:-1]]
    out = np.zeros(len(of) - 1)  # doubles are summed by row: differences of running sums would lose digits
    some = np.flatnonzero(np.diff(of))
    if len(some):
        out[some] = np.add.reduceat(values, of[some])
    return out


class Tree:
    """A ball tree over sparse rows (``of``: row to entries; ``terms``, ``values``), with every query's bound for every ball."""

    def __init__(self, of: np.ndarray, terms: np.ndarray, values: np.ndarray, queries: Queries):
        order, self.spans, self.children, bounds = np.arange(len(of) - 1), [], [], []
        norms = _sums(values.astype(float) ** 2, of)
        todo = [(0, len(order), -1)]
        while todo:
            a, b, parent = todo.pop()
            if parent >= 0:
                self.children[parent].append(len(self.spans))
            rows = order[a:b]
            inner, entries = _entries(of, rows)
            x, t = values[entries].astype(float), terms[entries]
            centre = np.bincount(t, x, queries.size) / (b - a)
            far = self._distances(x, t, inner, norms[rows], centre)
            radius = math.sqrt(far.max()) * (1 + SLACK)
            radii = np.zeros(queries.size)
            np.maximum.at(radii, t, x - centre[t])  # no less than 0 where no document goes beyond
            at = queries.products(centre)
            bounds.append((at + np.minimum(queries.norm * radius, queries.products(radii))) * (1 + SLACK) + 1)
            self.spans.append((a, b))
            self.children.append([])
            if b - a > LEAF:
                poles = []
                for _ in range(2):  # the row farthest from the centre, and the row farthest from that
                    k = int(far.argmax())
                    pole = np.zeros(queries.size)
                    pole[t[inner[k]:inner[k + 1]]] = x[inner[k]:inner[k + 1]]
                    far = self._distances(x, t, inner, norms[rows], pole)
                    poles.append(far)
                first = np.argsort(poles[0] - poles[1], kind="stable")
                order[a:b] = rows[first]
                middle = int((poles[0] < poles[1]).sum())
                middle = a + min(max(middle, (b - a) // 8), (b - a) - (b - a) // 8)  # also where all rows are alike
                todo += [(middle, b, len(self.spans) - 1), (a, middle, len(self.spans) - 1)]
        self.order, self.bounds = order, np.array(bounds)
        self.of, entries = _entries(of, order)
        self.terms, self.values = terms[entries], values[entries]

    @staticmethod
    def _distances(x, t, inner, norms, to):
        """Squared distances of rows to a dense vector, rounded up."""
        own = float(to @ to)
        return np.maximum(norms - 2 * _sums(x * to[t], inner) + own, 0) + SLACK * (norms + own)

    def search(self, query: int, dense: np.ndarray, best: Best) -> int:
        """Offers ``best`` what this tree has for a query (also given as a ``dense`` vector); returns the number of rows scored."""
        heap, scored = [(-self.bounds[0, query], 0)], 0
        while heap and -heap[0][0] >= best.least:
            _, node = heapq.heappop(heap)
            if self.children[node]:
                for child in self.children[node]:
                    if self.bounds[child, query] >= best.least:
                        heapq.heappush(heap, (-self.bounds[child, query], child))
                continue
            a, b = self.spans[node]
            low, high = self.of[a], self.of[b]
            scores = _sums(dense[self.terms[low:high]] * self.values[low:high], self.of[a:b + 1] - low)
            scored += b - a
            good = np.flatnonzero(scores >= max(1, best.least))
            if len(good):
                best.offer(scores[good], self.order[a + good])
        return scored


def _entries(of: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' own offsets, and the indices of their entries."""
    n = of[rows + 1] - of[rows]
    inner = np.concatenate([[0], np.cumsum(n)])
    return inner, np.arange(inner[-1]) + np.repeat(of[rows] - inner[:-1], n)


class Best:
    """The best ``k`` (score, id) of a query so far; equal scores by ascending id, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.least, self.ids = k, [], 0, None

    def offer(self, scores: np.ndarray, rows: np.ndarray) -> None:
        ids = self.ids.take(pa.array(rows)).to_pylist()
        self.rows += [(-s, i is None, i) for s, i in zip(scores.tolist(), ids)]
        self.rows.sort()
        del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _matched(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms of the text) and, of the terms in ``vocabulary``, their numbers and how often each stands there."""
    flat = np.frombuffer(b"".join(vocabulary), np.uint8)
    ends = np.cumsum([len(v) for v in vocabulary])
    starts = ends - np.array([len(v) for v in vocabulary])
    hashes = span_hashes(flat, starts, ends)
    order = np.argsort(hashes)

    def run(batches):
        for batch in slices(batches):
            values, offsets = buffer(batch.column("text"))
            values = _LOWERED[values]
            begin, end, before = words(values, offsets, APART)
            own = span_hashes(values, begin, end)
            at = order[np.minimum(np.searchsorted(hashes, own, sorter=order), len(order) - 1)]
            hit = np.flatnonzero((hashes[at] == own) & (end - begin == (ends - starts)[at]))
            at, length = at[hit], (end - begin)[hit]
            if len(hit):  # equal hashes: compare the bytes
                inner = np.concatenate([[0], np.cumsum(length)[:-1]])
                each = np.arange(int(length.sum())) - np.repeat(inner, length)
                same = values[np.repeat(begin[hit], length) + each] == flat[np.repeat(starts[at], length) + each]
                right = np.logical_and.reduceat(same, inner)
                hit, at = hit[right], at[right]
            row = np.searchsorted(before, hit, "right") - 1
            pair, tf = np.unique(row * len(vocabulary) + at, return_counts=True)
            of = pa.array(np.searchsorted(pair // len(vocabulary), np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(of, pa.array(x, pa.int32())) for x in (pair % len(vocabulary), tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(before), pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return arrow_map(docs, run, f"doc_id {id_type(docs)}, n long, terms array<int>, tfs array<int>")


def added(weight: np.ndarray, n: np.ndarray, tf: np.ndarray, total: int, length: int) -> np.ndarray:
    """What a term adds to a score that stands ``tf`` times in a document of ``n`` terms, of ``total`` documents with ``length`` terms."""
    m = 100 - 25 + (25 * n * total) // length
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _found(postings: DataFrame, queries: Queries, weights: np.ndarray, numbers: list[int], total: int, length: int, k: int) -> DataFrame:
    """query, doc_id, score: each task's best ``k`` documents of each query."""

    def run(batches):
        best = [Best(k) for _ in range(queries.n)]
        dense = np.zeros(queries.size, np.int64)
        for whole in batches:
            for low in range(0, whole.num_rows, TREE):
                batch = whole.slice(low, TREE)
                terms, tfs = batch.column("terms"), batch.column("tfs")
                of = terms.offsets.to_numpy().astype(np.int64)
                entries = slice(of[0], of[-1])
                n = np.repeat(batch.column("n").to_numpy(), np.diff(of))
                own_terms = terms.values.to_numpy()[entries].astype(np.int64)
                values = added(weights[own_terms], n, tfs.values.to_numpy()[entries].astype(np.int64), total, length)
                tree = Tree(of - of[0], own_terms, values, queries)
                for q in range(queries.n):
                    own = slice(queries.of[q], queries.of[q + 1])
                    dense[queries.terms[own]] = queries.times[own]
                    best[q].ids = batch.column("doc_id")
                    tree.search(q, dense, best[q])
                    dense[queries.terms[own]] = 0
                kind = batch.column("doc_id").type
        rows = [(number, -minus, i) for number, own in zip(numbers, best) for minus, _, i in own.rows]
        if rows:
            number, score, ids = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(ids, kind), pa.array(score, pa.int64())], ["query", "doc_id", "score"])

    return arrow_map(postings, run, f"query long, doc_id {id_type(postings)}, score long")


def _query_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """query (a number for each row), item_id and terms (term and how often), for rows with terms."""
    rows = items.select(column(item_col).alias("item_id"), column(text_col).cast("string").alias("text")).withColumn("query", F.monotonically_increasing_id())
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = rows.select("query", "item_id", F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    rows = rows.groupBy("query", "item_id", "term").agg(F.count("*").alias("times"))
    return rows.groupBy("query", "item_id").agg(F.array_sort(F.collect_list(F.struct("term", "times"))).alias("terms"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of each row of ``items``, if their score is above 0.

    Terms are runs of digits, letters A-Z (lower-cased) and everything beyond ASCII. N documents have terms, L in all, n in
    one; df documents hold a term, tf times in one. The term's weight is floor(1000 ln((2N + 2) / (2df + 1))). With m = 75 +
    (25 n N) div L, a score is the sum of weight * ((10**9 tf) div (1000 tf + 12 m)) over the item's terms, repeats
    included, in 64-bit integers. Equal scores are ranked by ascending id, null ids last.

    Null and empty texts have no terms and are not found, and such items find nothing. Rows that repeat an id or a text are
    ranked each; rows of ``items`` that repeat an id give a ranking each. Empty tables give an empty result; other columns
    are ignored, whatever their names.

    Documents are read once and only their query terms are stored; each task gives at most ``k`` rows per query, of which
    Spark keeps ``k`` before and after the shuffle. A block of queries (up to BLOCK_TERMS distinct terms) is searched at once.
    """
    docs = docs.select(column(id_col).alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    queries = written(_query_terms(items, item_col, item_text_col), "queries")
    blocks = -(-(queries.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS) or 1
    out = None
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "terms").collect()  # a bounded block
        names = sorted({t.term.encode() for r in rows for t in r.terms})
        number = {t: k for k, t in enumerate(names)}
        postings = written(_matched(docs, names or [b"\0"]), "postings")
        total, length = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        held = {r.term: r.df for r in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}  # one row per name
        weights = np.array([weight(total, held.get(t, 0)) for t in range(len(names))], np.int64)
        matrix = Queries([[(number[t.term.encode()], t.times) for t in r.terms] for r in rows], max(1, len(names)))
        found = _found(postings.where(F.size("terms") > 0), matrix, weights, [r.query for r in rows], total, length or 1, k)
        out = found if out is None else out.union(found)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
