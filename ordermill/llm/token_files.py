"""Token files: frequency-ranked ids in byte-aligned variable-length codes, control bytes kept apart from data bytes.

A token file set is a folder with two Parquet data sets. ``ranks`` (rank, token) orders the vocabulary by its count in
the corpus, most frequent first, ties by token. ``documents`` holds one row per document in ascending id order:
``position`` (ascending over the whole set), ``doc_id``, ``n_tokens``, ``control`` and ``data``. A rank takes one to four
little-endian bytes of ``data``; ``control`` has two bits per rank (bytes less one), four ranks to a byte, the first rank
in the lowest bits. Parquet with binary columns, because Spark commits it atomically in any store and a lost task is
simply run again.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Encoder, shared_encoder, stretches
from .frames import SLICE_BYTES, arrow_map, id_type, new_path, remove, slices, squeezed, texts, unsqueezed
from .token_counts import CHUNK, encoded

#: Ids counted at once.
TOGETHER = 1 << 18
#: For each control byte: the bytes of its four ranks, and which of 16 places (four per rank) they fill.
WIDTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
PLACES = np.arange(4) < WIDTHS[:, :, None]
TOTALS = WIDTHS.sum(axis=1)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes."""
    values = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    values[:len(ranks)] = ranks
    width = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = ((width - 1).reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    filled = (np.arange(4) < width[:, None])
    filled[len(ranks):] = False  # the last control byte's spare places have no data
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[filled].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks, by table lookup on the control bytes."""
    codes = np.frombuffer(control, np.uint8)
    filled = PLACES[codes].reshape(-1, 4)
    filled[n:] = False
    out = np.zeros((len(codes) * 4, 4), np.uint8)
    out[filled] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")[:n]


def _planes(ids: np.ndarray) -> bytes:
    """Ids with their lowest bytes first, then the next, and so on: compresses well."""
    return squeezed(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def _ids(planes: bytes, n: int) -> np.ndarray:
    raw = unsqueezed(planes, 4 * n)
    return np.ascontiguousarray(raw.reshape(4, -1).T).reshape(-1).view("<u4")


def encoded_once(encoder: Encoder, values: list[str], chunk: int = CHUNK, together: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another and the number before each text. Texts over ``chunk`` characters are cut where that changes
    nothing, and about ``together`` characters are encoded at once."""
    if not encoder.cuttable:
        return encoded(encoder, values)
    parts, sizes = [np.zeros(0, np.uint32)], np.zeros(len(values), np.int64)
    group, of, held = [], [], 0
    for i, text in enumerate(values):
        for part in stretches(text, chunk) if len(text) > chunk else (text,):
            group.append(part)
            of.append(i)
            held += len(part)
            if held >= together:
                parts.append(_add(encoder, group, of, sizes))
                group, of, held = [], [], 0
    parts.append(_add(encoder, group, of, sizes))
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def _add(encoder: Encoder, group: list[str], of: list[int], sizes: np.ndarray) -> np.ndarray:
    """The ids of a group of stretches, whose numbers are added to the ``sizes`` of their texts."""
    ids, before = encoder.encode(group)
    np.add.at(sizes, np.array(of, np.int64), np.diff(before))
    return ids


def tokenized(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """doc_id, tie, n_tokens and the ids of every row, in the binary form used between the passes."""

    def run(batches):
        encoder = shared_encoder(tokenizer)
        for batch in slices(batches):
            ids, before = encoded_once(encoder, batch.column("text").to_pylist())
            out = []
            for a, b in zip(before[:-1], before[1:]):
                own = ids[a:b]
                out.append(own if end_id is None else np.append(own, np.uint32(end_id)))
            columns = [batch.column("doc_id"), batch.column("tie"), pa.array([len(x) for x in out], pa.int64()),
                       pa.array([_planes(x) if len(x) else b"" for x in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "n_tokens", "ids"])

    docs = docs.withColumn("tie", F.xxhash64("text"))
    return arrow_map(docs, run, f"doc_id {id_type(docs)}, tie long, n_tokens long, ids binary")


def token_ranks(tokens: DataFrame) -> np.ndarray:
    """All tokens that occur, the most frequent first. As long as the vocabulary at most, so the driver may hold it."""

    def run(batches):
        counts = np.zeros(1, np.int64)
        held: list[np.ndarray] = []

        def counted():
            new = np.bincount(np.concatenate(held)) if held else counts[:0]
            held.clear()
            return np.pad(counts, (0, max(0, len(new) - len(counts)))) + np.pad(new, (0, max(0, len(counts) - len(new))))

        for batch in batches:
            size = 0
            for n, planes in zip(batch.column("n_tokens").to_pylist(), batch.column("ids").to_pylist()):
                if n:
                    held.append(_ids(planes, n))
                    size += n
                    if size >= TOGETHER:
                        counts, size = counted(), 0
            counts = counted()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["token", "n"])

    rows = arrow_map(tokens.select("n_tokens", "ids"), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return np.array([token for _, token in sorted((-n, token) for token, n in rows)], np.uint32)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every row's whole text and write a token file set to ``folder`` in ascending id order.

    ``tokenizer`` is the path of a ``.json`` file of the tokenizers library that every executor can read; ids are those of
    ``add_special_tokens=False``, followed by ``end_id`` if one is given. Null and empty texts have no ids but that.
    Null ids come first; rows with the same id stand next to each other, ordered by a hash of their texts; equal rows all
    stay. An empty table gives an empty set. Other columns are ignored, whatever their names.

    Texts are encoded once: the first pass stores compressed ids as the documents come, the second counts them, the third
    deals them out by ranges of doc_id and replaces them by ranks. The ranges are sampled from the stored rows, not by
    encoding again.
    """
    spark = docs.sparkSession
    staged = new_path(spark, "ids")
    try:
        tokenized(texts(docs, id_col, text_col), tokenizer, end_id).write.option("compression", "none").parquet(staged)
        tokens = spark.read.parquet(staged)
        order = token_ranks(tokens)
        rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)

        def run(batches):
            for batch in batches:
                n = batch.column("n_tokens").to_pylist()
                coded = [pack(rank[_ids(planes, k)]) if k else (b"", b"") for k, planes in zip(n, batch.column("ids").to_pylist())]
                columns = [batch.column("position"), batch.column("doc_id"), batch.column("n_tokens"),
                           pa.array([c for c, _ in coded], pa.binary()), pa.array([d for _, d in coded], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["position", "doc_id", "n_tokens", "control", "data"])

        tokens = (tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
                  .select(F.monotonically_increasing_id().alias("position"), "doc_id", "n_tokens", "ids"))
        (arrow_map(tokens, run, f"position long, doc_id {id_type(tokens)}, n_tokens long, control binary, data binary")
         .write.option("compression", "zstd").parquet(f"{folder}/documents"))
        table = spark.createDataFrame([(i, int(t)) for i, t in enumerate(order)], "rank long, token long")
        table.coalesce(1).write.parquet(f"{folder}/ranks")
    finally:
        remove(spark, staged)


def read_tokens(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """position, doc_id, n_tokens and ``ids`` (array of long), or with ``digest`` their ``ids_crc32``, from a token file set.

    The crc is that of the ids as little-endian unsigned 32-bit integers.
    """
    token = np.zeros(1, np.uint32)
    rows = spark.read.parquet(f"{folder}/ranks").collect()  # as long as the vocabulary at most
    if rows:
        token = np.zeros(len(rows), np.uint32)
        token[[r.rank for r in rows]] = [r.token for r in rows]
    files = spark.read.parquet(f"{folder}/documents")

    def run(batches):
        for batch in batches:
            coded = zip(*(batch.column(c).to_pylist() for c in ("control", "data", "n_tokens")))
            ids = (token[unpack(control, data, n)] for control, data, n in coded)
            if digest:
                last = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())
            else:
                last = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("position"), batch.column("doc_id"), batch.column("n_tokens"), last],
                                             ["position", "doc_id", "n_tokens", "ids_crc32" if digest else "ids"])

    return arrow_map(files, run, f"position long, doc_id {id_type(files)}, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>"))


def with_starts(tokens: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before. Sums per written part first, so no task sees all documents."""
    part = F.shiftright("position", 33)
    tokens = tokens.withColumn("part", part)
    # a row per part of the write: few, and the only rows that meet in one task
    before = tokens.groupBy("part").agg(F.sum("n_tokens").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("part").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return (tokens.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(before, "part").withColumn("start", F.col("earlier") + F.col("inside")).drop("part", "earlier", "inside"))
