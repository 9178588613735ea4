"""Token counts of whole documents; huge documents are encoded in overlapping chunks and spliced."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Encoder, shared_encoder
from .frames import arrow_map, byte_lengths, id_type, slices, texts

#: Characters of a chunk, and of the first overlap with the next.
CHUNK, OVERLAP = 50_000, 400
#: Cuts are made only before these. Fixed values.
BLANKS = " \t\n\v\f\r"


def with_offsets(encoder: Encoder) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """A text's ids, and the character each token starts at."""

    def encode(text):
        found = encoder.library.encode(text, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.array([start for start, _ in found.offsets], np.int64)

    return encode


def common_cut(text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
    """The first character in (low, high) where a token starts in both encodings and the cut is stable.

    Proof: no piece of the pre-tokenizer goes from a solid character on to a blank, so a piece ends there whatever stands
    before it and the next starts there; pieces are encoded independently, so tokens before the cut depend only on text
    before it, and tokens after it only on text after it. Special strings hold no blank.
    """
    both = np.intersect1d(left[(left > low) & (left < high)], right)
    solid = lambda c: c.isalnum() or (c.isascii() and not c.isspace())  # noqa: E731  surely no blank in any table
    return next((int(p) for p in both if text[p] in BLANKS and solid(text[p - 1])), None)


def spliced(encode, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """Ids of ``text`` from overlapping chunks. An overlap without a common stable cut is doubled until there is one."""
    parts: list[np.ndarray] = []
    start, done, n = 0, 0, len(text)
    end = min(n, chunk + overlap)
    ids, at = encode(text[:end])
    while end < n:
        following = start + chunk
        stop = min(n, following + chunk + overlap)
        next_ids, next_at = encode(text[following:stop])
        next_at = next_at + following
        width = overlap
        while (cut := common_cut(text, at, next_at, following, end)) is None and end < n:
            width *= 2
            end = min(n, following + width)
            ids, at = encode(text[start:end])
            at = at + start
            if end > stop:
                stop = min(n, end + chunk)
                next_ids, next_at = encode(text[following:stop])
                next_at = next_at + following
        if cut is None:
            break
        kept = slice(np.searchsorted(at, done), np.searchsorted(at, cut))
        parts.append(ids[kept])
        start, done, end, ids, at = following, cut, stop, next_ids, next_at
    parts.append(ids[np.searchsorted(at, done):])
    return np.concatenate(parts)


def encoded(encoder: Encoder, values: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another and the number before each text. Texts over ``chunk`` characters are spliced."""
    huge = [i for i, text in enumerate(values) if len(text) > chunk and encoder.by_pieces]
    if not huge:
        return encoder.encode(values)
    away = set(huge)
    ids, before = encoder.encode(["" if i in away else text for i, text in enumerate(values)])
    encode = with_offsets(encoder)
    parts = [spliced(encode, values[i], chunk, overlap) if i in away else ids[before[i]:before[i + 1]] for i in range(len(values))]
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row of ``docs``.

    ``tokenizer`` is the path of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file that every executor can read.
    Tokens are those of the library's defaults without added special tokens. Byte-level vocabularies take the chunked
    way for texts over ``chunk`` characters; for any other kind no cut is proven stable, so their texts stay whole.

    Null and empty texts have 0 bytes and 0 tokens; null and repeated ids give a row each; an empty table an empty
    result; other columns are ignored, whatever their names.
    """
    docs = texts(docs, id_col, text_col)

    def run(batches):
        if tokenizer.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
            count = lambda values: [len(x) for x in model.encode(values, num_threads=1)] if values else []
        else:
            encoder = shared_encoder(tokenizer)
            count = lambda values: np.diff(encoded(encoder, values, chunk, overlap)[1])
        for batch in slices(batches):
            column = batch.column("text")
            n = pa.array(count(column.to_pylist()), pa.int64())
            size = pa.array(byte_lengths(column), pa.int64())
            over = pa.array(n.to_numpy() > limit, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, n, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return arrow_map(docs, run, f"doc_id {id_type(docs)}, n_bytes long, n_tokens long, over_limit boolean")
