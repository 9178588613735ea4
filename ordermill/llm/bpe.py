"""Byte-level BPE over many texts: the tokenizers library encodes each distinct piece once.

The vocabulary's pre-tokenizer cuts a text into pieces that are encoded independently of each other. Where all its
characters are of the older Latin ranges, whose classes are settled, ``pieces`` finds these cuts for a whole batch at
once; the library then sees every distinct piece once. Any other text, and any text that holds a special string, goes to
the library whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

from .hashing import span_hashes

#: Characters below this are classed by table.
SETTLED = 0x250
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: The endings that the pre-tokenizer cuts off after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
#: White space of the pre-tokenizer below SETTLED. Fixed values.
BLANKS = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}

CLASS = np.array([SPACE if c in BLANKS else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(SETTLED)], np.uint8)


def pieces(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all texts start. ``codes``: characters below SETTLED; ``offsets``: where each text starts, then the end."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = CLASS[codes]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    blank = kind == SPACE
    cut = first[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    # the last of several blanks before something solid stands alone; a plain space belongs to what follows
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = blank[:-1] & ~blank[1:] & ~first[1:n]
    cut |= solid_next
    attached = np.flatnonzero(solid_next & (codes == 32))
    cut[attached + 1] = False
    # apostrophe endings
    marks = np.flatnonzero((codes == ord("'")) & cut[:n])
    if len(marks):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        after = np.concatenate([first, np.ones(3, bool)])
        inside = ~after[marks + 1]
        short = inside & np.isin(padded[marks + 1], [ord(c) for c in SHORT_ENDINGS])
        long = np.zeros(len(marks), bool)
        for a, b in LONG_ENDINGS:
            long |= (padded[marks + 1] == ord(a)) & (padded[marks + 2] == ord(b))
        long &= inside & ~after[marks + 2]
        cut[marks[short | long] + 1] = False
        ends = np.concatenate([marks[short] + 2, marks[long] + 3])
        cut[ends[ends < n]] = True
    return np.flatnonzero(cut)


def fits(spec: dict) -> bool:
    """Whether ``pieces`` describes this tokenizer's pre-tokenizer."""
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and not spec.get("post_processor") and not spec.get("truncation") and not spec.get("padding"))


#: A blank after something that is surely no blank in any table. Fixed values.
STABLE = re.compile(r"(?<=[\w!-~])[ \t\n\v\f\r]")


def stretches(text: str, size: int) -> Iterator[str]:
    """``text`` in stretches of at least ``size`` characters that are encoded independently, where the encoder is ``cuttable``.

    Proof: no piece of the pre-tokenizer goes from a solid character on to a blank, so one ends where a stretch does; and special
    strings hold no blank and take none with them.
    """
    start = 0
    while cut := STABLE.search(text, start + size):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def shared_encoder(path: str) -> Encoder:
    """One encoder per worker, kept from task to task with the pieces it remembers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_encoders: dict[str, Encoder] = {}


class Places:
    """In which place each key was added, for whole arrays of spread 64-bit keys: a table with open addressing, half full at most."""

    def __init__(self, bits: int = 16):
        self.bits, self.added = bits, 0
        self.keys, self.places = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def __len__(self) -> int:
        return self.added

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Their places, -1 for keys that were not added."""
        at = self._home(keys)
        out = self.places[at].astype(np.int64)
        other = np.flatnonzero((self.keys[at] != keys) & (out >= 0))
        while len(other):
            next_ = (at[other] + 1) & (len(self.keys) - 1)
            at[other] = next_
            out[other] = self.places[next_]
            other = other[(self.keys[next_] != keys[other]) & (out[other] >= 0)]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Add distinct keys that are not there, in this order."""
        places = np.arange(self.added, self.added + len(keys), dtype=np.int32)
        self.added += len(keys)
        if 2 * self.added > len(self.keys):
            full = self.places >= 0
            keys, places = np.concatenate([self.keys[full], keys]), np.concatenate([self.places[full], places])
            self.bits = (2 * self.added - 1).bit_length()
            self.keys, self.places = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        at = self._home(keys)
        while len(keys):
            free = np.flatnonzero(self.places[at] < 0)
            self.places[at[free]] = places[free]  # of several keys at one free place the last one written has it
            put = free[self.places[at[free]] == places[free]]
            self.keys[at[put]] = keys[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, places, at = keys[left], places[left], (at[left] + 1) & (len(self.keys) - 1)


class Encoder:
    """Ids of whole texts, as the library gives them with ``add_special_tokens=False``."""

    #: Distinct pieces remembered by one worker; then it starts anew.
    REMEMBERED = 1_000_000
    #: Distinct pieces sent to the library in one text, a line each.
    TOGETHER = 100

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            text = file.read()
        spec = json.loads(text)
        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_pieces = fits(spec)
        added = spec.get("added_tokens", [])
        self.special = [token["content"] for token in added]
        self.cuttable = self.by_pieces and not any(token.get("lstrip") or token.get("rstrip") or re.search(r"\s", token["content"]) for token in added)
        line = self.whole("\n")
        self.line = int(line[0]) if len(line) == 1 else None
        self.forget()

    def forget(self):
        self.known = Places()
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, keys: np.ndarray, new: list[str]) -> None:
        """Pieces without a line feed go a line each: a line feed after a solid piece is a piece of its own."""
        lined = np.array([self.line is not None and "\n" not in piece and not piece.isspace() for piece in new], bool)
        lines = [new[i] for i in np.flatnonzero(lined)]
        groups = ["\n".join(lines[i:i + self.TOGETHER]) + "\n" for i in range(0, len(lines), self.TOGETHER)]
        found = [x.ids for x in self.library.encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.array([i for x in found for i in x], np.uint32)
        stops = np.flatnonzero(ids == self.line) if lines else np.zeros(0, np.int64)
        self._store(keys[lined], ids[ids != self.line] if lines else ids, np.diff(stops, prepend=-1) - 1)
        alone = np.flatnonzero(~lined)
        found = [x.ids for x in self.library.encode_batch_fast([new[i] for i in alone], add_special_tokens=False)]
        self._store(keys[alone], np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64))

    def _store(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        start = int(self.ends[-1])
        total = start + len(ids)
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids[:start], np.zeros(max(total, len(self.ids)), np.uint32)])
        self.ids[start:total] = ids
        self.known.add(keys)
        self.ends = np.concatenate([self.ends, start + np.cumsum(lengths)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids before each text (one more entry: all)."""
        plain = [self.by_pieces and not any(s in text for s in self.special) for text in texts]
        joined = "".join(text for text, ok in zip(texts, plain) if ok)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(text) if ok else 0 for text, ok in zip(texts, plain)], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        odd = np.flatnonzero(codes >= SETTLED)
        if len(odd):
            strange = np.unique(np.searchsorted(starts, odd, "right") - 1)
            for i in strange:
                plain[i] = False
            keep = np.ones(len(codes), bool)
            for i in strange:
                keep[starts[i]:starts[i + 1]] = False
            codes = codes[keep]
            joined = "".join(text for text, ok in zip(texts, plain) if ok)
            sizes[strange] = 0
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        begin = pieces(codes, starts[:-1][sizes > 0])
        end = np.append(begin[1:], len(codes)) if len(begin) else begin
        ids, lengths = self._pieces(joined, codes, begin, end)
        before = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.diff(before[np.searchsorted(begin, starts)])
        if all(plain):
            return ids, np.concatenate([[0], np.cumsum(counts)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        parts = [ids[bounds[i]:bounds[i + 1]] if ok else self.whole(texts[i]) for i, ok in enumerate(plain)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def _pieces(self, joined, codes, begin, end):
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        keys = span_hashes(codes, begin, end)
        slot = self.known.find(keys)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            at = missing[at]
            if len(self.known) + len(new) > self.REMEMBERED:
                self.forget()
                new, at = np.unique(keys, return_index=True)
                missing = slice(None)
            self._learn(new, [joined[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist())])
            slot[missing] = self.known.find(keys[missing])
        sources = self.ends[slot]
        lengths = self.ends[slot + 1] - sources
        shift = np.repeat(sources - (np.cumsum(lengths) - lengths), lengths)
        return self.ids[shift + np.arange(len(shift))], lengths
