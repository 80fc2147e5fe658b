"""SentencePiece encoding through a table of distinct marked words, and decoding.

A model whose pieces hold whitespace markers only at their start never merges
across the border before a marker.  A normalised text then falls into marked
words (markers and what follows up to the next marker) that are segmented
independently of each other: each task keeps a table of the distinct words it
has met, has the library segment a word when it is new, and joins the ids back
by position.  The table is emptied when it reaches ``TABLE_BYTES``, which
changes no result; words of over ``WORD_BYTES`` are segmented without it.  A
model for which the borders do not hold is given whole texts.

Nothing is shuffled: a join of all words of the corpus to one table would send
several times the text over the network, while words repeat within a task
nearly as much as they do across tasks.  The model travels as its bytes, so
executors need no file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from duelframe.llm.common import core, ddl, slices

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
TABLE_BYTES = 32 << 20
WORD_BYTES = 512
BPE = 2                        # the model type in the library's own numbering


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def separable(model: bytes) -> bool:
    """Whether marked words are segmented independently: a BPE model whose pieces hold markers only at their start."""
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    names = {p.piece for p in spec.pieces}
    return (spec.trainer_spec.model_type == BPE and MARK in names and not spec.trainer_spec.treat_whitespace_as_suffix
            and spec.normalizer_spec.escape_whitespaces and not any(re.search(f"[^{MARK}]{MARK}", p) for p in names))


def word_model(model: bytes) -> bytes:
    """The model with a normaliser that leaves marked words as they are."""
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    n = spec.normalizer_spec
    n.name, n.precompiled_charsmap = "identity", b""
    n.add_dummy_prefix = n.remove_extra_whitespaces = False
    return spec.SerializeToString()


class Encoder:
    """Encodes texts to the ids' bytes (little-endian unsigned 32-bit) in one task."""

    def __init__(self, model: bytes, bos: bool, eos: bool, table_bytes: int = TABLE_BYTES):
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.words = sentencepiece.SentencePieceProcessor(model_proto=word_model(model)) if separable(model) else None
        self.first = self.pack([self.whole.bos_id()]) if bos else b""
        self.last = self.pack([self.whole.eos_id()]) if eos else b""
        self.table: dict[str, bytes] = {}
        self.held, self.table_bytes = 0, table_bytes

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Segments the words that the table lacks; the long ones come back apart."""
        new = list(words)
        found = dict(zip(new, map(self.pack, self.words.encode(new, num_threads=1) if new else [])))
        long = {w: b for w, b in found.items() if len(w) > WORD_BYTES}
        short = {w: b for w, b in found.items() if len(w) <= WORD_BYTES} if long else found
        self.table.update(short)
        self.held += sum(2 * len(w) + len(b) + 200 for w, b in short.items())
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.words is None:
            return [self.first + self.pack(ids) + self.last for ids in self.whole.encode(texts, num_threads=1)]
        if self.held > self.table_bytes:
            self.table, self.held = {}, 0
        chunks = [CHUNK.findall(self.whole.normalize(t)) for t in texts]
        missing = set().union(*chunks) - self.table.keys()
        long = self.learn(missing)
        out = []
        for found in chunks:
            try:
                out.append(self.first + b"".join(map(self.table.__getitem__, found)) + self.last)
            except KeyError:
                out.append(self.first + b"".join([self.table.get(c) or long[c] for c in found]) + self.last)
        return out


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           bos: bool = True, eos: bool = True, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(id, n_tokens, ids) of every text, whole; ``ids`` are the token ids as little-endian unsigned 32-bit integers.

    The ids are those of the library for the whole text.  A null text is
    empty; an empty text has the begin and end ids alone.  Row by row:
    repeated rows, null ids and ties need no rule, an empty table gives no
    rows, and other columns are ignored.
    """
    src = core(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, bos, eos, table_bytes)
        for piece, _, _ in slices(batches, text_col):
            ids = encoder.encode([t or "" for t in piece.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_col), pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array(ids, pa.binary())],
                [id_col, "n_tokens", "ids"])

    return src.mapInArrow(run, f"{ddl(src, [id_col])}, n_tokens long, ids binary")


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The encoded rows with the text that the library's decode makes of their ids (null: of none) as ``decoded``."""
    schema = ", ".join([ddl(encoded, encoded.columns), "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for piece, _, _ in slices(batches, ids_col):
            ids = [np.frombuffer(b or b"", "<u4").tolist() for b in piece.column(ids_col).to_pylist()]
            text = [sp.decode(i) if i else "" for i in ids]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(text, pa.string())], [*piece.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
