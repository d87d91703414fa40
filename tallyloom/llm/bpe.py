"""Byte-level BPE of a public tokenizer by a backtracking encoder.

An Aho-Corasick automaton finds the longest token that starts at each byte of a piece. The encoder takes it if it goes
with the token before it; else a shorter one; else it takes the last token back. Two tokens go together if merging
their bytes by rank would not have crossed the border between them, which a table of merges tells. That gives the exact
merges in time linear in the length. Pieces are independent, so the ids of short white-space-delimited chunks are kept.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

VOCABULARY = os.environ.get("TALLYLOOM_BPE", "/opt/tokenizers/byte_bpe_50k.json")
#: White space as the tokenizer's pattern has it (the Unicode property).
_WS = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_BORDER = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")
KEEP_LENGTH = 48
KEEP_CHUNKS = 400_000


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Chunks(dict):
    """Encoded chunks by text, as int32 bytes; None for chunks whose white space the neighbours decide on."""

    def __init__(self, encoder: Encoder, lead: str) -> None:
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, chunk: str) -> bytes | None:
        ids = None if not chunk or chunk[0].isspace() or chunk[-1].isspace() else self.encoder.encode_pieces(self.lead + chunk)
        if len(chunk) <= KEEP_LENGTH:
            if len(self) >= KEEP_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Encoder and decoder over the bytes of a vocabulary file (JSON with ``vocab`` and ``merges``)."""

    def __init__(self, vocabulary: bytes) -> None:
        model = json.loads(vocabulary)["model"]
        byte_of = _byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        text = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if all(c in byte_of for c in s)}
        self.split = {i: (i, i) for i in text}
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in merges:
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.split[whole] = (a, b)
            self.merged[a, b] = whole
        ids = {text[i]: i for i in {x for ab in self.split.values() for x in ab} | set(self.merged.values()) | set(self.split)}
        reachable = {i for i in text if self.split[i] != (i, i) or len(text[i]) == 1}
        ids = {s: i for s, i in ids.items() if i in reachable}
        self.size = [0] * (max(text) + 1)
        self.shorter: list[int] = [-1] * (max(text) + 1)
        self.automaton = ahocorasick.Automaton()
        for s, i in ids.items():
            self.size[i] = len(s)
            self.automaton.add_word(s.decode("latin-1"), (len(s) - 1, i))
            for n in range(len(s) - 1, 0, -1):
                if (k := ids.get(s[:n])) is not None:
                    self.shorter[i] = k
                    break
        self.automaton.make_automaton()
        self.blob = b"".join(text.get(i, b"") for i in range(max(text) + 1))
        self.offset = np.cumsum([0, *(len(text.get(i, b"")) for i in range(max(text) + 1))])
        self.goes: dict[tuple[int, int], bool] = {}
        self.first, self.later = Chunks(self, ""), Chunks(self, " ")

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two tokens stay as they are when their bytes are merged by rank."""
        limit, split, merged = 1 << 62, self.split, self.merged
        while True:
            whole = merged.get((a, b))
            if whole is not None and whole < limit:
                return False
            if a > b:
                limit, a = a, split[a][1]
                if a == limit:
                    limit, b = b + 1, split[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, split[b][0]
                if b + 1 == limit:
                    limit, a = a, split[a][1]
                    if a == limit:
                        return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece of the pattern."""
        data = piece.encode("utf-8", "replace").decode("latin-1")
        n = len(data)
        longest = [-1] * (n + 1)
        for end, (back, token) in self.automaton.iter(data):
            longest[end - back] = token
        out: list[int] = []
        open_ = bytearray(b"\x01") * (n + 1)
        at, token, size, shorter, goes = 0, longest[0], self.size, self.shorter, self.goes
        while at < n:
            last = out[-1] if out else -1
            while True:
                end = at + size[token]
                if open_[end]:
                    if last < 0:
                        ok = True
                    elif (ok := goes.get((last, token))) is None:
                        if len(goes) > 2_000_000:
                            goes.clear()
                        ok = goes[last, token] = self.compatible(last, token)
                    if ok:
                        out.append(token)
                        at, token = end, longest[end]
                        break
                token = shorter[token]
                if token < 0:
                    open_[at] = 0
                    token = out.pop()
                    at -= size[token]
                    last = out[-1] if out else -1
                    token = shorter[token]
                    while token < 0:
                        open_[at] = 0
                        token = out.pop()
                        at -= size[token]
                        last = out[-1] if out else -1
                        token = shorter[token]
        return out

    def encode_pieces(self, text: str) -> bytes:
        """Ids of a text, piece by piece, as int32 bytes."""
        ids: list[int] = []
        for piece in PIECES.findall(text):
            ids += self.encode_piece(piece)
        return np.array(ids, dtype=np.int32).tobytes()

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a whole text as int32 bytes; none for null and empty texts."""
        if not text:
            return b""
        head, *rest = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.later.__getitem__, rest))
        except TypeError:  # white space beside a blank: only blanks between two other characters part the text
            head, *rest = _BORDER.split(text)
            return self._part(self.first, head) + b"".join([self._part(self.later, x) for x in rest])

    def _part(self, known: Chunks, chunk: str) -> bytes:
        ids = known[chunk]
        return self.encode_pieces(known.lead + chunk) if ids is None else ids

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype=np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, through the table of offsets into one string of all tokens' bytes."""
        o = self.offset
        return b"".join([self.blob[o[i] : o[i + 1]] for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def _encoder(vocabulary: bytes) -> Encoder:
    return Encoder(vocabulary)


def _vocabulary(spark: SparkSession, path: str):
    """The vocabulary file (a few MB) as a broadcast, so that only the driver needs the file."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_texts(df: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>) of every row.

    Null and empty texts have the empty list, blank ones their ids; strings that look like special tokens are ordinary
    text. Rows with a null or repeated key are kept; an empty table gives none; extra columns are ignored.
    """
    data = _vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(data.value)
        for batch in batches:
            parts = [e.encode_bytes(x) for x in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, parts)]) // 4
            values = pa.array(np.frombuffer(b"".join(parts), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens) of every row; 0 for null and empty texts."""
    data = _vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(data.value)
        for batch in batches:
            n = [len(e.encode_bytes(x)) // 4 for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=[key, "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint")


def decode_ids(df: DataFrame, *, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text) of rows with a list of ids; null ids give null."""
    data = _vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(data.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else e.decode(x) for x in batch.column(1).to_pylist()], pa.string())], names=[key, "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")
