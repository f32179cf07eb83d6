"""Operator 9: URL filter by a bit-parallel wildcard automaton.

Glob rules are packed into Shift-And masks of as many 64-bit words as their literals need. All
rules advance together: one shift, one mask look-up and one self-loop mask per character, for
all URLs of a batch at a time.

A canonical URL is ``"." + host + path``. Globs: ``*`` is any run without a slash, ``**`` any run,
``?`` one character other than a slash; the rest stands for itself and must match to the end.

Defined results: a null URL or one without ``://`` has an empty host and path; no rule fits it, so
the default verdict holds. Of several fitting rules the longest wins, then the earlier one.
Repeated rows are judged alike, long URLs whole, an empty table gives no rows; only the id and
URL columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; a rule without one only decides where no named rule fits."""

    glob: str
    action: str
    name: str | None = None

    @classmethod
    def prefix(cls, host: str, path: str, action: str) -> Rule:
        """URLs of a host and its subdomains whose path starts with ``path``."""
        return cls(f"*.{host}{path}**", action, host + path)


#: The rules of the production query.
RULES = (
    Rule.prefix("com", "/", "allow"), Rule.prefix("example.com", "/en/", "block"), Rule.prefix("www.example.com", "/en/", "allow"),
    Rule.prefix("net", "/es/", "block"), Rule.prefix("net", "/fr/", "block"),
    Rule("*cheap-**", "block"), Rule("*spam-**", "block"), Rule("*casino**", "block"),
)


class Automaton:
    """All globs as one state vector: bit i of a glob is set when its first i literals are read."""

    def __init__(self, globs: list[str]):
        cells, loops, self.final, first = [], [], [], []
        for glob in globs:
            first.append(len(cells))
            cells.append(None)
            loops.append("")
            i = 0
            while i < len(glob):
                if glob.startswith("**", i):
                    loops[-1], i = "any", i + 2
                elif glob[i] == "*":
                    loops[-1], i = loops[-1] or "part", i + 1
                else:
                    cells.append(glob[i])
                    loops.append("")
                    i += 1
            self.final.append(len(cells) - 1)
        self.words = -(-len(cells) // 64)
        self.letters = sorted({c for c in cells if c and c != "?"} | {"/"})
        classes = ["", *self.letters]  # class 0: any character that no glob names
        self.step = np.array([self._mask(c is not None and (c == x or c == "?" and x != "/") for c in cells) for x in classes])
        self.stay = np.array([self._mask(k == "any" or k == "part" and x != "/" for k in loops) for x in classes])
        self.start = self._mask(i in first for i in range(len(cells)))

    def _mask(self, flags) -> np.ndarray:
        bits = np.zeros(self.words * 64, np.uint8)
        for i, flag in enumerate(flags):
            bits[i] = flag
        return np.packbits(bits, bitorder="little").view("<u8")

    def classes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        known = np.array([ord(c) for c in self.letters], np.uint32)
        at = np.searchsorted(known, points)
        at[at == len(known)] = 0
        return np.where(known[at] == points, at + 1, 0).astype(np.uint8)

    def run(self, texts: list[str]) -> np.ndarray:
        """Which globs match which texts: booleans of shape (texts, globs)."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        flat, begins = self.classes("".join(texts[i] for i in order)), np.cumsum(lengths) - lengths
        state = np.tile(self.start, (len(texts), 1))
        # Texts are sorted by falling length, so the unfinished ones are a prefix.
        falls = [0, *sorted(set(lengths.tolist()))]
        for low, high in pairwise(falls):
            n = int(np.searchsorted(-lengths, -high, "right"))
            live, begin = state[:n], begins[:n]
            for t in range(low, high):
                c = flat[begin + t]
                moved = live << np.uint64(1)
                moved[:, 1:] |= live[:, :-1] >> np.uint64(63)
                live = (moved & self.step[c]) | (live & self.stay[c])
            state[:n] = live
        out = np.empty((len(texts), len(self.final)), bool)
        for j, bit in enumerate(self.final):
            out[order, j] = state[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1) == 1
        return out


def canonical(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    part = lambda k: F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", k)
    return pages.select(F.col(page_id).alias("page_id"), F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"))


def judge(pages: DataFrame, rules=RULES, default: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule (its name or null), verdict of every page."""
    rules = sorted(rules, key=lambda r: (r.name is None, -len(r.name or r.glob)))  # the first that fits decides
    automaton = Automaton([r.glob for r in rules])
    names, actions = [r.name for r in rules] + [None], [r.action for r in rules] + [default]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        host, path = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        hits = automaton.run([f".{h}{p}" for h, p in zip(host, path, strict=True)])
        best = np.where(hits.any(1), hits.argmax(1), len(rules))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([names[i] for i in best], pa.string()), pa.array([actions[i] for i in best], pa.string())],
            names=["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema[page_id].dataType.simpleString()
    return map_batches(canonical(pages, page_id, url), run, f"page_id {kind}, host string, path string, rule string, verdict string")
