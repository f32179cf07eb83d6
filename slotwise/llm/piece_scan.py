"""Operator 5: SentencePiece encoding and decoding with a max-plus scan over chunks.

The public model merges pairs by score (BPE), so the best segmentation is not the one of the largest
sum. It is the only one in which every two neighbouring pieces are stable: encoding the two joined
gives the two back. That is a max-plus problem with weights 0 and minus infinity, and is solved as one:

* a giant text is cut every ``CHUNK`` characters. The state of a cut is the piece that holds the
  character before it: how far it reaches to the left and to the right of the cut;
* a chunk's transfer matrix has weight 0 from a state of its left cut to one of its right cut where stable
  pieces lead from the one to the other;
* matrices combine associatively; prefix and suffix products give the one state of each cut;
* each chunk is then traced back on its own between its two states.

No piece holds a blank after another character, or a line end, so a cut there has one state, and what lies
between two such places is encoded by the library, word by word with a memory. Only the words
at the cuts, or a text without any blank, need the states.

Defined results: null and empty texts have no pieces and no rows; repeated rows are encoded each; blanks and
the model's own blank sign are one character to the model; an empty table gives no rows; only the named columns
are read. A cut that falls on or behind a run of blanks is moved to a word's edge, since pieces of blanks only
share one score. A table of matrices holds at most a row per ``CHUNK`` characters of one text.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, worker_state

CHUNK, REMEMBERED, STABLE = 32_768, 100_000, 100_000
BLANK = "▁"
BEHIND = "\ud800"  # marks a remembered word; no text holds it
HARD = 0  # the only state of a cut that no piece crosses


class Pieces(dict):
    """The model; as a dictionary, ids of words (with a blank before, or behind a line end) as packed uint32."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.older: dict = {}
        plain = [i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.id_of = {sp.id_to_piece(i): i for i in plain}
        self.longest = max(map(len, self.id_of))
        self.bytes_of = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.line_end = self.unit("\n")
        self.raw = [sp.id_to_piece(i).replace(BLANK, " ").encode() for i in range(sp.vocab_size())]
        for b, i in enumerate(self.bytes_of):
            self.raw[i] = bytes([b])
        self.stable: dict[tuple[str, str], bool] = {}

    def unit(self, piece: str) -> list[int]:
        """Ids of a piece; of a character that the model lacks, its bytes."""
        i = self.id_of.get(piece)
        return [i] if i is not None else [self.bytes_of[b] for b in piece.encode("utf-8", "surrogatepass")]

    def ids(self, text: str) -> list[int]:
        """Library ids of a string that is not preceded by a blank: a line end keeps the library's own blank off."""
        return self.sp.encode("\n" + text)[1 + len(self.line_end):]

    def __missing__(self, word: str) -> bytes:
        """``word`` has one blank before it, which is left out, or is marked as behind a line end, which is then included."""
        got = self.older.get(word)
        if got is None:
            if word[:1] == BEHIND:
                ids = self.line_end + self.ids(word[1:])
            elif "\n" in word:
                head, *rest = word.split("\n")
                got = self[head] + b"".join(self[BEHIND + r] for r in rest)
            else:
                ids = self.ids(BLANK + word)
            if got is None:
                got = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got

    def between(self, text: str) -> bytes:
        """Ids of normalised text from one hard place to another."""
        if not text:
            return b""
        if text[0] != BLANK:  # behind a line end, or at one
            head, sign, rest = text.partition(BLANK)
            ids = self.ids(head)
            return struct.pack(f"<{len(ids)}I", *ids) + self.between(sign + rest)
        if BLANK * 2 in text or text[-1] == BLANK:
            words = [w[1:] for w in re.findall(f"{BLANK}+[^{BLANK}]*", text)]
        else:
            words = text[1:].split(BLANK)
        return b"".join(map(self.__getitem__, words))

    def joins(self, a: str, b: str) -> bool:
        """Whether two neighbouring pieces are stable; with an empty ``a``, whether one piece is."""
        key = a, b
        if key not in self.stable:
            if len(self.stable) > STABLE:
                self.stable.clear()
            self.stable[key] = self.ids(a + b) == (self.unit(a) if a else []) + self.unit(b)
        return self.stable[key]

    def starts(self, text: str, at: int):
        """Ends of the pieces that begin at a place."""
        for end in range(at + 1, min(len(text), at + self.longest) + 1):
            piece = text[at:end]
            if (end == at + 1 or piece in self.id_of) and self.joins("", piece):
                yield end


def model(path: str | None = None) -> Pieces:
    path, state = path or public_tokenizers.path("piece_bpe_32k.model"), worker_state("piece_scan")
    if path not in state:
        state[path] = Pieces(path)
    return state[path]


def normalise(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


def hard(text: str, at: int) -> bool:
    """No piece crosses this place."""
    return at in (0, len(text)) or text[at] == "\n" or text[at - 1] == "\n" or text[at] == BLANK != text[at - 1]


def cuts(text: str, chunk: int = CHUNK) -> list[int]:
    """Places of the cuts, both ends included."""
    out, edge = [0], re.compile(f"[^{BLANK}]{BLANK}|\n")
    while out[-1] + chunk < len(text):
        last, at = out[-1], out[-1] + chunk
        blank = text.rfind(BLANK, last, at)
        if not hard(text, at) and blank > text.rfind("\n", last, at):
            run = blank
            while run > last and text[run - 1] == BLANK:
                run -= 1
            if run < blank or text[at] == BLANK:
                found = None if run > last else edge.search(text, at)
                at = run if run > last else found.start() + 1 if found else len(text)
        if at >= len(text):
            break
        out.append(at)
    return [*out, len(text)] if text else []


def state_of(begin: int, end: int, cut: int, longest: int) -> int:
    return 1 + (cut - begin - 1) * longest + (end - cut)


def piece_of(state: int, cut: int, longest: int) -> tuple[int, int]:
    return cut - (state - 1) // longest - 1, cut + (state - 1) % longest


def states(p: Pieces, text: str, cut: int) -> dict[int, tuple[int, int]]:
    """All pieces that hold the character before the cut, by state."""
    return {state_of(b, e, cut, p.longest): (b, e) for b in range(max(0, cut - p.longest), cut) for e in p.starts(text, b) if e >= cut}


def run(p: Pieces, text: str, seeds: dict[tuple[int, int] | int, int], stop: int):
    """Bit masks of the seeds from which stable pieces lead to a piece, as ends[end][begin].

    A seed is a piece (begin, end), or a hard place. Pieces begin before ``stop``.
    """
    ends: dict[int, dict[int, int]] = defaultdict(dict)
    for seed, mask in seeds.items():
        begin, end = seed if isinstance(seed, tuple) else (seed, seed)
        ends[end][begin] = ends[end].get(begin, 0) | mask
    for at in range(min(ends), stop):
        if before := ends.get(at):
            for end in p.starts(text, at):
                mask = 0
                for begin, m in before.items():
                    if begin == at or p.joins(text[begin:at], text[at:end]):
                        mask |= m
                if mask:
                    ends[end][at] = ends[end].get(at, 0) | mask
    return ends


def trace(p: Pieces, text: str, ends, last: tuple[int, int], seed: tuple[int, int] | int) -> bytes:
    """Ids of the pieces behind the seed up to and with the last one."""
    out, (begin, end) = [], last
    while (begin, end) != seed:
        out.append(p.unit(text[begin:end]))
        if begin == seed:
            break
        before = next(b for b, m in ends[begin].items() if m and b < begin and p.joins(text[b:begin], text[begin:end]))
        begin, end = before, begin
    flat = [i for ids in reversed(out) for i in ids]
    return struct.pack(f"<{len(flat)}I", *flat)


def edges(text: str, begin: int, end: int) -> tuple[int, int] | None:
    """First and last hard place of a chunk."""
    first = next((i for i in range(begin, end + 1) if hard(text, i)), None)
    return None if first is None else (first, next(i for i in range(end, begin - 1, -1) if hard(text, i)))


def transfer(p: Pieces, text: str, begin: int, end: int) -> dict[tuple[int, int], float]:
    """Max-plus matrix of a chunk, without its cells of minus infinity."""
    left = {HARD: None} if hard(text, begin) else states(p, text, begin)
    right = {HARD: None} if hard(text, end) else states(p, text, end)
    places = edges(text, begin, end)
    if places:
        enter, leave = {HARD: 1}, {HARD: 1}
        if HARD not in left:
            ends = run(p, text, {piece: 1 << i for i, piece in enumerate(left.values())}, places[0])
            mask = 0
            for m in ends.get(places[0], {}).values():
                mask |= m
            enter = {s: 1 for i, s in enumerate(left) if mask >> i & 1}
        if HARD not in right:
            ends = run(p, text, {places[1]: 1}, end)
            leave = {s: 1 for s, (b, e) in right.items() if b >= places[1] and ends.get(e, {}).get(b)}
        return {(i, j): 0.0 for i in enter for j in leave}
    ends = run(p, text, {piece: 1 << i for i, piece in enumerate(left.values())}, end)
    out = {}
    for j, (b, e) in right.items():
        mask = ends.get(e, {}).get(b, 0)
        out |= {(i, j): 0.0 for k, i in enumerate(left) if mask >> k & 1}
    return out


def combine(a: dict, b: dict) -> dict:
    """Max-plus product of two sparse matrices."""
    rows, out = defaultdict(list), {}
    for (k, j), w in b.items():
        rows[k].append((j, w))
    for (i, k), v in a.items():
        for j, w in rows[k]:
            out[i, j] = max(out.get((i, j), float("-inf")), v + w)
    return out


def cut_states(matrices: list[dict]) -> list[int]:
    """State of every cut, both ends included: where prefix and suffix products meet at the best weight."""
    prefix = list(accumulate(matrices, combine))
    suffix = list(accumulate(reversed(matrices), lambda a, b: combine(b, a)))[::-1]
    out = [HARD]
    for a, b in zip(prefix[:-1], suffix[1:], strict=True):
        best = [(w + b[k, HARD], k) for (i, k), w in a.items() if i == HARD and (k, HARD) in b]
        out.append(max(best)[1])
    return [*out, HARD]


def backtrace(p: Pieces, text: str, begin: int, end: int, enter: int, leave: int) -> bytes:
    """Ids of a chunk between its two states: what begins behind the entering piece, up to the leaving one."""
    at = begin if enter == HARD else piece_of(enter, begin, p.longest)
    last = None if leave == HARD else piece_of(leave, end, p.longest)
    places = edges(text, begin, end)
    if places is None:
        if at == last:
            return b""
        return trace(p, text, run(p, text, {at: 1}, end), last, at)
    ids = b""
    if enter != HARD and at[1] < places[0]:
        ends = run(p, text, {at: 1}, places[0])
        ids += trace(p, text, ends, (next(b for b, m in ends[places[0]].items() if m), places[0]), at)
    ids += p.between(text[places[0]:places[1]])
    if leave != HARD:
        ids += trace(p, text, run(p, text, {places[1]: 1}, end), last, places[1])
    return ids


def _slices(docs: DataFrame, chunk: int, path: str | None, kind: str) -> DataFrame:
    """A row per chunk of the texts longer than one: with the text around it that pieces at its cuts may need."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, number, begin, end, texts, starts, of = [], [], [], [], [], [], model(path).longest
        for row, value in enumerate(batch.column("_text")):
            text = normalise(value.as_py())
            places = cuts(text, chunk)
            for i, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True)):
                low = max(0, a - of - 1)
                rows.append(row)
                number.append(i)
                starts.append(a)
                # Two characters more than a piece on either side, so that only the text's own ends look like ends.
                texts.append(text[low:b + of + 1])
                begin.append(a - low)
                end.append(b - low)
        at = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column("_doc").take(at), batch.column("_hash").take(at), pa.array(number, pa.int32()), pa.array(starts, pa.int64()),
             pa.array(begin, pa.int32()), pa.array(end, pa.int32()), pa.array(texts, pa.string())],
            names=["_doc", "_hash", "chunk", "start", "begin", "end", "slice"])

    return map_batches(docs, cut, f"_doc {kind}, _hash bigint, chunk int, start bigint, begin int, end int, slice string")


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, chunk (number from 0), start (in the normalised text), n_chars, ids (packed uint32) of each chunk, in order."""
    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    out_schema = f"doc_id {kind}, chunk int, start bigint, n_chars bigint, ids binary"
    giant = own.where(F.length("_text") >= chunk).withColumn("_hash", F.xxhash64("_text"))
    slices = _slices(giant, chunk, path, kind)

    def matrix(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = model(path)
        cells = [transfer(p, s.as_py(), b.as_py(), e.as_py()) for s, b, e in zip(batch.column("slice"), batch.column("begin"), batch.column("end"), strict=True)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("_doc", "_hash", "chunk")), pa.array([[i for i, _ in m] for m in cells], pa.list_(pa.int32())),
             pa.array([[j for _, j in m] for m in cells], pa.list_(pa.int32())), pa.array([list(m.values()) for m in cells], pa.list_(pa.float64()))],
            names=["_doc", "_hash", "chunk", "i", "j", "w"])

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("chunk").sort_values("chunk")  # repeated rows have the same matrices
        found = cut_states([{(i, j): w for i, j, w in zip(m.i, m.j, m.w, strict=True)} for m in group.itertuples(index=False)])
        return pd.DataFrame({"_doc": group["_doc"].array, "_hash": group["_hash"].array, "chunk": group["chunk"].array, "enter": found[:-1], "leave": found[1:]})

    matrices = map_batches(slices, matrix, f"_doc {kind}, _hash bigint, chunk int, i array<int>, j array<int>, w array<double>", "slice")
    at = matrices.groupBy("_doc", "_hash").applyInPandas(scan, f"_doc {kind}, _hash bigint, chunk int, enter int, leave int")
    at = at.select(F.col("_doc").alias("_d"), F.col("_hash").alias("_h"), F.col("chunk").alias("_c"), "enter", "leave")
    joined = slices.join(at, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")) & (F.col("chunk") == F.col("_c")))

    def back(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, columns = model(path), [batch.column(n).to_pylist() for n in ("slice", "begin", "end", "enter", "leave")]
        return pa.RecordBatch.from_arrays(
            [batch.column("_doc"), batch.column("chunk"), batch.column("start"),
             pa.array([e - b for b, e in zip(columns[1], columns[2], strict=True)], pa.int64()),
             pa.array([backtrace(p, *row) for row in zip(*columns, strict=True)], pa.binary())],
            names=["doc_id", "chunk", "start", "n_chars", "ids"])

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n = [normalise(t) for t in batch.column("_text").to_pylist()], batch.num_rows
        ids, sizes = list(map(model(path).between, texts)), list(map(len, texts))
        return pa.RecordBatch.from_arrays(
            [batch.column("_doc"), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n, np.int64)), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
            names=["doc_id", "chunk", "start", "n_chars", "ids"])

    one = map_batches(own.where(F.length("_text").between(1, chunk - 1)), whole, out_schema, "_text")
    many = map_batches(joined.select("_doc", "chunk", "start", "begin", "end", "slice", "enter", "leave"), back, out_schema, "slice")
    return one.unionByName(many)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The encoded rows with ``text``: what the chunk's pieces spell. A text is its chunks' texts in order."""
    kept = [c for c in encoded.columns if c != "text"]

    def run_(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, out = model(path).raw, []
        for ids, number in zip(batch.column("ids"), batch.column("chunk"), strict=True):
            spelt = b"".join(map(raw.__getitem__, np.frombuffer(ids.as_py(), "<u4").tolist())).decode("utf-8", "surrogatepass")
            out.append(spelt[1:] if number.as_py() == 0 else spelt)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.string())], names=[*kept, "text"])

    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(encoded.select(*kept), run_, f"{kinds}, text string", "ids")
