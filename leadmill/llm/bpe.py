"""Encoding of whole texts with a public byte-level BPE vocabulary, exact and in linear time.

A text is cut into pieces by the vocabulary's pattern. Within a piece the encoder walks from
left to right: it takes the longest token that starts at the place (all matches of the piece
come from one Aho-Corasick pass), checks against a table of pair compatibility that the merges
would have left this token beside the one before, and otherwise tries the next shorter token or
steps back. Each place is left for good at most once, so the time is linear in the text. Decoding
looks up slices of one byte string by an offset table.

Defined results
---------------
* null and empty texts give an empty list; blanks are ordinary text;
* strings that look like special tokens are ordinary text;
* texts and unbroken runs of any length are encoded whole; repeated rows give repeated rows;
* only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.session import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pattern that goes with the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and pairs remembered in a worker; beyond that the memory is begun anew.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 48
MAX_VOCABULARY_BYTES = 64 << 20


class Encoder:
    """Exact BPE by backtracking over longest matches; ids must be ordered by merge rank."""

    def __init__(self, tokens: list[bytes], pattern: str = PATTERN):
        self.tokens = tokens
        self.lengths = [len(t) for t in tokens]
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.data = b"".join(tokens)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.cut = regex.compile(pattern)
        self.size = len(tokens)
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [self._longest_proper_prefix(t) for t in tokens]
        self.left, self.right = list(range(self.size)), list(range(self.size))
        self.merged: dict[tuple[int, int], int] = {}
        self._fill_splits()
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}

    @classmethod
    def from_ranks(cls, content: bytes) -> Encoder:
        """From the content of a file with a base64 token and its rank on each line."""
        ranked = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, content.splitlines()))
        return cls([t for _, t in ranked])

    def _longest_proper_prefix(self, token: bytes) -> int:
        for k in range(len(token) - 1, 0, -1):
            if (i := self.rank.get(token[:k])) is not None:
                return i
        return -1

    def _fill_splits(self) -> None:
        """The pair each token is merged from: the one split whose halves the merges would leave side by side."""
        for i, t in enumerate(self.tokens):
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k], self.size), self.rank.get(t[k:], self.size)
                if a < i and b < i and self._compatible(a, b):
                    self.left[i], self.right[i] = a, b
                    self.merged[a, b] = i
                    break

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``a`` beside token ``b``: undoing them one by one, the later
        first, no merge across the border may come before the one just undone."""
        limit = self.size
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                return False
            if a > b:
                limit, inner = a, self.right[a]
                if inner == a:
                    limit, inner = b + 1, self.left[b]
                    if inner == b:
                        return True
                    b = inner
                else:
                    a = inner
            else:
                limit, inner = b + 1, self.left[b]
                if inner == b:
                    limit, inner = a, self.right[a]
                    if inner == a:
                        return True
                    a = inner
                else:
                    b = inner

    def compatible(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(a, b)
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one piece."""
        raw = piece.encode("utf-8")
        whole = self.rank.get(raw)
        if whole is not None:
            return [whole]
        n, lengths, shorter = len(raw), self.lengths, self.shorter
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # ends ascend, so the last is the longest
        open_at = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            before = out[-1] if out else -1
            while True:
                end = at + lengths[token]
                if open_at[end] and (before < 0 or self.compatible(before, token)):
                    out.append(token)
                    at, token = end, longest[end]
                    break
                token = shorter[token]
                if token < 0:
                    # nothing fits here: close the place and try a shorter token before it
                    open_at[at] = 0
                    token = out.pop()
                    at -= lengths[token]
                    break
        return out

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; an empty list for null and empty."""
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for piece in self.cut.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) <= REMEMBERED_LENGTH:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        data, offsets = self.data, self.offsets
        return b"".join(data[offsets[i] : offsets[i + 1]] for i in ids)

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


_encoders: dict[str, Encoder] = {}


def encoder_for(content: bytes) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder.from_ranks(content)
    return _encoders[key]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return content


def _mapped(df: DataFrame, keep: list[str], text_col: str, vocabulary: str, count_only: bool) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    slim = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))
    kept = slim.select(*slim.columns[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_for(sent.value).encode
        for batch in batches:
            # long texts: a few thousand at a time bound the memory of a batch
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                ids = [encode(t) for t in part.column(len(keep)).to_pylist()]
                sizes = np.fromiter(map(len, ids), np.int32, len(ids))
                if count_only:
                    made = pa.array(sizes.astype(np.int64))
                else:
                    flat = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
                    made = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
                columns = [part.column(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, made], names=[*keep, "n_tokens" if count_only else "ids"])

    made = "n_tokens bigint" if count_only else "ids array<int>"
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + [made])
    return spread(slim).mapInArrow(run, schema)


def encode_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, ids) of each row, in one narrow pass without a shuffle."""
    return _mapped(df, [id_col], text_col, vocabulary, count_only=False)


def count_tokens(df: DataFrame, keep: list[str], text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The kept columns and ``n_tokens`` of each row."""
    return _mapped(df, keep, text_col, vocabulary, count_only=True)


def decode_table(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, text) of each row of ids; null ids give a null text."""
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    slim = df.select(F.col(f"`{id_col}`"), F.col(f"`{ids_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder_for(sent.value).decode
        for batch in batches:
            texts = [None if x is None else decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return slim.mapInArrow(run, f"`{id_col}` {slim.schema[0].dataType.simpleString()}, text string")
