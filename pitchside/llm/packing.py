"""Packing of token streams by power-of-two decomposition.

A document's ids are cut into whole pieces of ``max_tokens`` and the binary
digits of the rest, longest first. Every piece is a sequence of its own and
belongs to the bucket of its length, so no sequence crosses documents and
none needs padding. Documents are independent: there is no shuffle.

Token ids of a word do not depend on its neighbours across white space, so
each worker keeps the ids of words it has met (a bounded memory); of new
ones, plain Latin-1 words go straight to the tokenizer's BPE model in its
byte alphabet, and all others through the whole tokenizer. ``sequence_id`` is the partition's number in
the high bits and a running number in the low ones: unique within one
result, and a task that is run again gives ids of its own partition only.

Defined results: null and empty texts hold the end id alone; repeated rows
are packed once each; null ids are kept; an empty table gives no pieces;
extra columns are ignored. ``end_id`` may be any id of 32 bits.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrays import give_back

MAX_TOKENS = 2048
END_ID = 1
WORD_MEMORY = 300_000
TOKENIZER = "word_bpe_49k.json"

SPACES = re.compile("[\\x20\\x09-\\x0D]+")
# Latin-1 letters and a tail of ASCII marks without apostrophe: the tokenizer
# splits exactly between the two, whatever stands around them.
LETTERS_AND_TAIL = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


# Latin-1 letters are two bytes in UTF-8 and so two characters here.
IN_BYTES = {ord(c): "".join(byte_alphabet()[b] for b in c.encode()) for c in map(chr, range(0xC0, 0x100))}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds(dict):
    """Little-endian 32-bit ids of words, computed on first use."""

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, text: str) -> bytes:
        """Ids of one run of lower-case letters or of marks."""
        ids = self.parts.get(text)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(text.translate(IN_BYTES))]).tobytes()
            if len(self.parts) < WORD_MEMORY:
                self.parts[text] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        m = LETTERS_AND_TAIL.fullmatch(word)
        if m:
            letters, tail = m.groups()
            ids = self.part(letters.lower()) + (self.part(tail) if tail else b"")
        else:
            ids = self.encode(word)
        if len(self) < WORD_MEMORY:
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, SPACES.split(text)))


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def cuts(n: int, most: int) -> list[int]:
    """Piece lengths of ``n`` tokens: whole pieces, then binary digits."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(batches, path: str, end_id: int, most: int, with_ids: bool):
    ids_of = word_ids(path)
    end = np.asarray([end_id], dtype="<u4").tobytes()
    sequence = TaskContext.get().partitionId() << 40
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
    kinds = [pa.int64()] * 7 + [pa.int32()]

    def batch(rows, ids):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        if with_ids:
            columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=names + ["input_ids"] * with_ids)

    for b in batches:
        rows, ids, size = [], [], 0
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
            stream = ids_of.text(text.as_py() or "") + end
            n, start = len(stream) // 4, 0
            for length in cuts(n, most):
                piece = stream[4 * start:4 * (start + length)]
                rows.append((doc_id, start, length, zlib.crc32(piece), n, sequence, 0, length.bit_length() - 1))
                if with_ids:
                    ids.append(piece)
                    size += len(piece)
                sequence += 1
                start += length
            if len(rows) > 50_000 or size > 16 << 20:
                yield batch(rows, ids)
                rows, ids, size = [], [], 0
        if rows:
            yield batch(rows, ids)
    give_back()


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, path: str | None = None,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, bucket (log2 of the length) and, ``with_ids``, the
    ids themselves. ``max_tokens`` is a power of two."""
    if max_tokens & (max_tokens - 1) or max_tokens < 1:
        raise ValueError("max_tokens must be a power of two")
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, bucket int") + ", input_ids array<int>" * with_ids
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(partial(_pieces, path=path or tokenizer_path(), end_id=end_id, most=max_tokens,
                                   with_ids=with_ids), schema)
