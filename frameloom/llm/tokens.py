"""Problem 8: encoding of a whole corpus with a public byte-level BPE.

Forced-boundary splitting. A pair of bytes that stands side by side in no vocabulary entry
can't lie inside any token, so a text may be cut between the two, the pieces encoded on
their own and their ids concatenated. Such pairs are read from the vocabulary once per
worker as a 256 x 256 table, which is looked up for all byte pairs of a batch at once.

The vocabulary's text pattern decides on a piece by what follows white space and treats
an apostrophe before some letters as a unit, so no cut is made after white space, before an
apostrophe or inside a character; elsewhere the pattern goes on the same way from a cut.
Pieces repeat very often and are looked up in a bounded table of encoded pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
KNOWN_PIECES = 300_000
LONGEST_KNOWN = 64
# The text pattern of the vocabulary; last bytes of white space characters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_ENDS = [*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]


class PieceEncoder:
    """Encodes texts of one vocabulary piece by piece."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        inside = np.zeros((256, 256), bool)
        for token in ranks:
            if len(token) > 1:
                x = np.frombuffer(token, np.uint8)
                inside[x[:-1], x[1:]] = True
        cut = ~inside
        cut[SPACE_ENDS, :] = False
        cut[:, ord("'")] = False
        cut[:, 0x80:0xC0] = False  # inside a character
        self.cut = cut
        self.space = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
        self.known: dict[bytes, list[int]] = {}

    def pieces(self, data: np.ndarray) -> np.ndarray:
        """Places at which the bytes are cut: before white space, and elsewhere in pieces longer than LONGEST_KNOWN."""
        at = np.flatnonzero(self.cut[data[:-1], data[1:]]) + 1
        word = self.space[data[at]]
        ends = np.concatenate([at[word], [len(data)]])
        length = np.diff(ends, prepend=0)
        return at[word | (length[np.searchsorted(ends, at)] > LONGEST_KNOWN)]

    def encode(self, piece: bytes) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.whole.encode_ordinary(piece.decode("utf-8"))
            if len(piece) <= LONGEST_KNOWN:
                if len(self.known) >= KNOWN_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts in a row, and where each text's begin and end; null and empty texts have none."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        starts = offsets - offsets[0]
        ends = np.unique(np.concatenate([self.pieces(data) if len(data) > 1 else np.zeros(0, np.int64), starts[1:]]))
        ends = ends[ends > 0]
        text = data.tobytes()
        ids: list[int] = []
        known, encode, begin = self.known, self.encode, 0
        counts = np.empty(len(ends) + 1, np.int64)
        counts[0] = 0
        for n, end in enumerate(ends.tolist(), 1):
            piece = text[begin:end]
            got = known.get(piece)
            ids += got if got is not None else encode(piece)
            counts[n] = len(ids)
            begin = end
        # a text ends where its last piece does
        return np.array(ids, np.int32), counts[np.searchsorted(ends, starts, "right")]


@lru_cache(maxsize=4)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str, count_only: bool) -> Iterator[pa.RecordBatch]:
    encoder = piece_encoder(path)
    for b in batches:
        step = max(1, int(b.num_rows * 8_000_000 // max(b.nbytes, 1)))  # some MB of text at a time
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            ids, ends = encoder.encode_all(part.column("text"))
            got = pa.array(np.diff(ends)) if count_only else pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), got], ["doc_id", "n_tokens" if count_only else "ids"])


def token_ids(documents: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row of documents; null and empty texts have an empty list.

    Strings that look like special tokens are ordinary text. One row for each row, also for
    repeated or null doc_ids; texts of any length are encoded whole; an empty table gives an
    empty result; other columns are ignored. No shuffle.
    """
    path = f"{tokenizer_dir}/{vocabulary}"
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lambda x: _encode(x, path, False), "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every row of documents: the lengths of token_ids."""
    path = f"{tokenizer_dir}/{vocabulary}"
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lambda x: _encode(x, path, True), "doc_id bigint, n_tokens bigint")
