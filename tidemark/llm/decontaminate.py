"""Benchmark decontamination: pigeonhole pieces, exact piece hits, Myers bit-parallel verification.

An item of m characters may differ by k = floor(m * RATE) edits. Cut into k + 1 pieces, at least one of them is free of
edits, so one pass of a multi-pattern automaton over each text finds every place worth a look; there Myers' algorithm, the
item's column of differences held as bits of one integer, gives the exact distance. The places that an item's hits point to are
merged to windows first, so that a text is read once for an item however often a piece repeats in it.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ints_of, slices

#: Edits allowed for each character of an item; items of fewer characters must stand in the text exactly, as whole words.
RATE, SHORTEST = 0.05, 24
#: Characters of items that are searched for in one pass over the documents; more take more passes.
BLOCK_CHARS = 4_000_000

#: White space, one space each.
_SPACES = {i: " " for i in (9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}


def normal(text: str) -> str:
    """Lower case, every white-space character a space; of the same length, so places stay valid."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(d := c.lower()) != 1 else d for c in text)
    return low.translate(_SPACES)


def best_end(pattern: str, text: str, k: int) -> tuple[int, int]:
    """The least edit distance (at most k, else k + 1) of pattern to a substring of text, and where the first such ends."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, at = full, 0, m, k + 1, -1
    if m <= k:
        best, at = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, at = score, j + 1
    return best, at


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their offsets."""
    cut = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Windows in order, those that meet joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(windows):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


class Finder:
    """Items (number, text) ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, shortest: int = SHORTEST):
        self.items = [(i, n) for i, t in items if t is not None and (n := normal(t).strip())]
        self.rate, self.shortest = rate, shortest
        self._auto = None

    def __getstate__(self):
        return {"items": self.items, "rate": self.rate, "shortest": self.shortest, "_auto": None}

    def budget(self, item: str) -> int:
        return int(len(item) * self.rate) if len(item) >= self.shortest else 0

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, start, end, distance) of the best place of each item found in text, by item."""
        if not self.items:
            return []
        if self._auto is None:
            where: dict[str, list[tuple[int, int]]] = {}
            for n, (_, t) in enumerate(self.items):
                for o, p in pieces(t, self.budget(t)):
                    where.setdefault(p, []).append((n, o))
            self._auto = ahocorasick.Automaton()
            for p, w in where.items():
                self._auto.add_word(p, (len(p), w))
            self._auto.make_automaton()
        text = normal(text)
        wanted: dict[int, list[tuple[int, int]]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        for end, (size, places) in self._auto.iter(text):
            for n, o in places:
                item = self.items[n][1]
                if len(item) < self.shortest:
                    start = end + 1 - size
                    if n not in best and not text[max(0, start - 1) : start].isalnum() and not text[end + 1 : end + 2].isalnum():
                        best[n] = (start, end + 1, 0)
                    continue
                k, start = self.budget(item), end + 1 - size - o
                window = max(0, start - 2 * k), min(len(text), start + len(item) + 2 * k)
                have = wanted.setdefault(n, [])
                if have and have[-1][0] <= window[0] <= have[-1][1]:
                    have[-1] = have[-1][0], max(have[-1][1], window[1])
                else:
                    have.append(window)
        for n, windows in wanted.items():
            item = self.items[n][1]
            k = self.budget(item)
            for lo, hi in _merged(windows):
                d, e = best_end(item, text[lo:hi], k)
                if d <= k and (n not in best or d < best[n][2]):
                    _, back = best_end(item[::-1], text[max(lo, lo + e - len(item) - d) : lo + e][::-1], d)
                    best[n] = (lo + e - back, lo + e, d)
        return [(self.items[n][0], *x) for n, x in sorted(best.items())]


def leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, item_id, start, end, distance: the best place of each item in each text that holds it within its budget.

    docs: doc_id, text; items: item_id, text; further columns are ignored. Places are code points [start, end). Null and empty
    texts hold nothing; null and blank items are not searched for, items of fewer than `shortest` characters exactly and as whole
    words. Of places of equal distance the first counts. Rows that repeat give rows that repeat. Items beyond BLOCK_CHARS characters are dealt by a hash
    of their id to blocks, each searched for in a pass of its own over all documents.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL AND item_id IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    out = None
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        found = _search(docs, Finder([(r["item_id"], r["text"]) for r in block.sort("item_id", "text").collect()], rate, shortest))
        out = found if out is None else out.union(found)
    return out


def _search(docs: DataFrame, finder: Finder) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(finder)

    def run(batches):
        find = sent.value
        for batch in slices(batches, "text", 4_000_000):
            ids, rows = ints_of(batch, "doc_id").to_pylist(), []
            for i, t in zip(ids, ints_of(batch, "text").to_pylist(), strict=True):
                rows += [(i, *m) for m in find.matches(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64() if i < 2 else pa.int32()) for i in range(5)], names=["doc_id", "item_id", "start", "end", "distance"]
            )

    return docs.mapInArrow(run, "doc_id long, item_id long, start int, end int, distance int")
