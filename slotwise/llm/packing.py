"""Operator 4: packing by power-of-two decomposition.

A document of n tokens is cut from its start into as many pieces of the sequence limit as fit
and then into the binary digits of the rest, longest first. Every piece has a power-of-two
length and is a sequence of its own: equal lengths share a bucket, nothing is padded and no
sequence crosses documents.

Defined results: a null text is an empty one; an empty text is the end token alone (one piece
of length 1); repeated rows are packed once each; an empty table gives no rows; only the id and
text columns are read, so other columns may have any name; a text of any length is tokenized
whole, word by word, in memory proportional to that text.
"""

from __future__ import annotations

import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, worker_state

LIMIT = 2048
#: Words of which a Python worker remembers the ids; older ones are forgotten (speed only).
REMEMBERED = 150_000
#: Byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others for 256, 257, ... in order.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_LETTERS = re.compile(r"[a-zß-öø-ÿ]+\Z")
_TAIL = re.compile(r"([a-zß-öø-ÿ]+)([.,!?;:%$#&*|]+)\Z")


class Words(dict):
    """Ids of blank-free strings as packed little-endian uint32.

    The tokenizer splits at white space, so the ids of a text are the ids of its parts
    between blanks, one after the other.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.older = Tokenizer.from_file(path), {}
        self.model = self.tokenizer.model
        self[""] = b""

    def ids(self, word: str) -> bytes:
        if _LETTERS.match(word):  # one pre-token: its bytes, as the byte alphabet spells them, go to the model
            ids = [t.id for t in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(BYTES))]
            return struct.pack(f"<{len(ids)}I", *ids)
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            m = _TAIL.match(word)  # letters, then punctuation: two pre-tokens
            got = self[m[1]] + self[m[2]] if m else self.ids(word)
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        self[word] = got
        return got

    def text(self, text: str) -> bytes:
        # Lower-casing first lets more words share an entry. It is the tokenizer's own second
        # step; texts on which the order or the context of that step could matter are left as they are.
        if "Σ" not in text and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        if "<|" in text:
            return self.ids(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def words_of(path: str) -> Words:
    state = worker_state("packing")
    if path not in state:
        state[path] = Words(path)
    return state[path]


def decompose(n: int, limit: int = LIMIT) -> list[int]:
    """Lengths of the pieces of n tokens: limits first, then the binary digits of the rest."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << k for k in range(limit.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         end_id: int = 1, limit: int = LIMIT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (packed little-endian uint32), doc_tokens,
    sequence_id, offset. ``length`` names the bucket. ``tokenizer`` is the file's path.
    """
    assert limit & (limit - 1) == 0, "limit must be a power of two"
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, rows, starts, lengths, ids, totals = words_of(path), [], [], [], [], []
        end = struct.pack("<I", end_id)
        for row, value in enumerate(batch.column("_text")):
            packed = words.text(value.as_py() or "") + end
            n, at = len(packed) // 4, 0
            for length in decompose(n, limit):
                rows.append(row)
                starts.append(at)
                lengths.append(length)
                ids.append(packed[4 * at:4 * (at + length)])
                totals.append(n)
                at += length
        of = batch.column("_doc").take(pa.array(rows, pa.int32()))
        return pa.RecordBatch.from_arrays(
            [of, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
            names=["doc_id", "start", "length", "ids", "doc_tokens"])

    kind = docs.schema[doc_id].dataType.simpleString()
    cut = map_batches(docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")), run,
                      f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint", "_text")
    # Each piece is a sequence. The number is partition and position: a map over input splits, so a
    # task that runs again gives its pieces the same numbers.
    return cut.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length."""
    packed.write.partitionBy("length").parquet(path)


def unpack(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")
