"""Byte-level BPE by a sentencepiece model that is written down from the vocabulary, not trained.

Each byte becomes one character, each token one piece scored by its negative rank, and normalisation is the
identity, so the merges of sentencepiece are those of the rank file. Texts are split into pre-tokens first; a piece's
id is its rank. Decoding maps ids to pieces, pieces to bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as pb2

from urlsieve.llm.narrow import small_batches
from urlsieve.llm.words import chunks, give_back

SHIFT = 0x100
_UNKNOWN = "⁇"
_MAP = {b: SHIFT + b for b in range(256)}
_held: dict[str, tuple] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file (base64 and number per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_MAP)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model of a vocabulary whose ranks are 0 to n - 1."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0 to n - 1")
    model = pb2.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=mapped(token), score=-float(rank), type=pb2.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece=_UNKNOWN, score=0.0, type=pb2.ModelProto.SentencePiece.UNKNOWN)
    trainer, norm = model.trainer_spec, model.normalizer_spec
    trainer.model_type, trainer.vocab_size = pb2.TrainerSpec.BPE, len(ranks) + 1
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(ranks), -1, -1, -1
    trainer.unk_piece = _UNKNOWN
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class PieceCache(dict):
    """Ids of pre-tokens as int32 bytes; emptied when it would hold over ``bound`` of them, so memory is bounded."""

    def __init__(self, model: bytes, bound: int = 100_000):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bound = bound
        n = self.processor.get_piece_size() - 1
        self.token = [bytes(ord(c) - SHIFT for c in self.processor.id_to_piece(i)) for i in range(n)]
        # a token that no sequence of merges reaches is still taken whole when it is the whole pre-token
        self.unreached = {t: i for i, t in enumerate(self.token) if len(t) > 1 and self.processor.encode(mapped(t)) != [i]}

    def learn(self, pres: list[list[str]]) -> None:
        """Encode in one call whatever of these pre-tokens isn't held yet."""
        new = list(set(chain.from_iterable(pres)).difference(self))
        if len(self) + len(new) > self.bound:
            self.clear()
            new = list(set(chain.from_iterable(pres)))
        raw = [pre.encode() for pre in new]
        ids = self.processor.encode([t.decode("latin-1").translate(_MAP) for t in raw], num_threads=1) if raw else []
        for pre, token, found in zip(new, raw, ids):
            self[pre] = array("i", [self.unreached[token]] if token in self.unreached else found).tobytes()


def _cache(model: bytes) -> PieceCache:
    key = hashlib.md5(model).hexdigest()
    if key not in _held:
        _held.clear()
        _held[key] = PieceCache(model)
    return _held[key]


def _lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _decoded(lists: pa.ListArray, token: list[bytes]) -> pa.Array:
    """The bytes of each list of ids; null for null."""
    flat, ends = np.asarray(lists.values), np.asarray(lists.offsets)
    if len(flat) and flat.min() < 0:
        raise ValueError("negative id")
    get, some = token.__getitem__, np.asarray(lists.is_valid())
    return pa.array([b"".join(map(get, flat[a:b].tolist())) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], some)], pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text", decoded: str | None = None) -> DataFrame:
    """(key, ids array<int>): every whole text, each match of ``pattern`` encoded by itself; null counts as empty.

    With ``decoded``, a column of that name holds the bytes that the ids stand for, as ``decode`` gives them, made in the same pass.
    An empty text gives an empty list. Repeated rows and keys stay as they are; other columns are left out.
    The model (about 1 MB, the size of the vocabulary) is broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, split = _cache(model.value), regex.compile(pattern).findall
        get = cache.__getitem__
        for batch in batches:
            for part, _, _ in chunks(batch, "text"):
                pres = [split(t or "") for t in part.column(1).to_pylist()]
                cache.learn(pres)
                ids = _lists([b"".join(map(get, p)) for p in pres])
                back = [_decoded(ids, cache.token)] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), ids, *back], names=["key", "ids", "back"][:2 + len(back)])
        give_back()

    kind = dict(docs.dtypes)[key]
    texts = small_batches(docs.select(docs[key].alias("key"), docs[text].alias("text")))
    out = texts.mapInArrow(run, f"key {kind}, ids array<int>" + (", back binary" if decoded else ""))
    return out.withColumnsRenamed({"key": key, "back": decoded} if decoded else {"key": key})


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids: str = "ids", into: str = "bytes") -> DataFrame:
    """All columns and ``into``, the bytes that the ids stand for. Null ids stay null; an unknown id raises."""
    model = tokens.sparkSession.sparkContext.broadcast(model_bytes(ranks))
    names = tokens.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _cache(model.value).token
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(part.column(names.index(ids)), token)], names=[*names, into])

    kinds = ", ".join(f"`{n}` {k}" for n, k in tokens.dtypes)
    return tokens.mapInArrow(run, f"{kinds}, `{into}` binary")
