"""Repeated passages: winnowed line hashes, joined positions, matches extended both ways, later runs deleted.

Pasted passages begin and end inside physical lines, so the lines hashed here are re-flowed ones: the LINE words from each
word on, whatever the newlines. Of every WINDOW consecutive line hashes the smallest is a fingerprint; any run of
LINE + WINDOW - 1 words (50) that two places share therefore has a fingerprint at the same place in both. Every fingerprint
joins to its first occurrence by (doc_id, position) only, never to all others. Fingerprints that agree on the shift between
the two places chain to runs, each run is extended word by word both ways, and runs of RUN words or more are deleted from
the later place.

What stands earlier in the same text is found there, where its words are at hand; a fingerprint that only such windows have
joins nothing.

A fingerprint of three places or more may occur first in a text that differs from what two later places share. Where such a
fingerprint stands so near a run's end that windows of RUN words around it reach beyond the run's lines, those windows are hashed
and grouped, and all but the first of equal ones are deleted. (A window within the lines equals one at the first occurrence, and
so does any window equal to it: the run deletes it.) What goes is exactly every window of RUN words that stands earlier, but for
collisions of hashes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, hash_words, ints_of, mix, owner, slices, texts_of, written

#: Words of a re-flowed line, line hashes in a window, words of a run that is deleted.
LINE, WINDOW, RUN = 26, 25, 50
#: Context requests of which the driver passes all to every task; beyond that they are joined.
SEND = 2_000_000

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of _BASE and of its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over every window of w values, by doubling; len(x) - w + 1 results."""
    at, have = x, 1
    while have < w:
        step = min(have, w - have)
        at = f(at[:-step], at[step:])
        have += step
    return at


def _hashes(h: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """Hashes of all runs of so many words, for each size; h: hashes of at least so many words."""
    up, down = _powers(len(h))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)))
    return [mix((sums[n:] - sums[:-n]) * down[: len(h) - n + 1]) | np.uint64(1) for n in sizes]


def winnow(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions in all words, and their line hashes; h: word hashes, off: where texts begin."""
    n = len(h)
    if n < LINE + WINDOW - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    (g,) = _hashes(h, LINE)
    who = owner(off)
    low = _slide(g, WINDOW, np.minimum)
    low[who[: len(low)] != who[LINE + WINDOW - 2 :]] = 0  # such a window leaves its text
    pad = np.zeros(WINDOW - 1, np.uint64)
    high = _slide(np.concatenate((pad, low, pad)), WINDOW, np.maximum)
    at = np.flatnonzero(high == g)
    return at, g[at]


def _windows_of(g: np.ndarray, off: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first window of RUN words whose first smallest line hash stands at each of at, and how many there are; g: line hashes."""
    first, count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    step = np.arange(1, WINDOW)
    for i in range(0, len(at), 100_000):  # a text of one repeated word has a fingerprint at each word
        p = at[i : i + 100_000]
        who = np.searchsorted(off, p, "right") - 1
        left, right = p[:, None] - step, p[:, None] + step
        ends = (left < off[who][:, None]) | (g[np.maximum(left, 0)] <= g[p][:, None])
        lo = p - np.where(ends.any(axis=1), ends.argmax(axis=1), WINDOW - 1)
        ends = (right + LINE > off[who + 1][:, None]) | (g[np.minimum(right, len(g) - 1)] < g[p][:, None])
        hi = p + np.where(ends.any(axis=1), ends.argmax(axis=1), WINDOW - 1) - (WINDOW - 1)
        first[i : i + len(p)], count[i : i + len(p)] = lo, np.maximum(hi - lo + 1, 0)
    return first, count


def windows_at(h: np.ndarray, off: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of RUN words whose first smallest line hash stands at each of at: that hash, the first such window's start,
    how many there are, and the hashes of all of them; h, off: as in winnow, at: where lines begin.
    """
    g, x = _hashes(h, LINE, RUN)
    lo, count = _windows_of(g, off, at)
    return g[at], lo, count, x[np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())]


def repeated_within(h: np.ndarray, off: np.ndarray, at: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of RUN words that stand earlier in the same text (by where they start), and which fingerprints are of others too.

    h, off: as in winnow; at, g: what it gives. A fingerprint all of whose windows repeat need not be joined to other texts.
    """
    who = owner(off)
    of = who[at]
    order = np.lexsort((g, of))
    twice = np.flatnonzero((of[order][1:] == of[order][:-1]) & (g[order][1:] == g[order][:-1]))
    some = np.unique(of[order][twice])
    if not len(some):
        return np.empty(0, np.int64), np.ones(len(at), bool)
    lines, x = _hashes(h, LINE, RUN)
    size = np.maximum(off[some + 1] - off[some] - RUN + 1, 0)
    start = np.repeat(off[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    order = np.lexsort((x[start], who[start]))  # stable: equal windows by where they start
    sorted_x, sorted_who = x[start][order], who[start][order]
    later = start[order[1:][(sorted_x[1:] == sorted_x[:-1]) & (sorted_who[1:] == sorted_who[:-1])]]
    open_ = np.ones(len(h) + 1, np.int64)
    open_[later] = 0
    upto = np.concatenate(([0], np.cumsum(open_)))
    use = np.ones(len(at), bool)
    mine = np.flatnonzero(np.isin(of, some))
    lo, count = _windows_of(lines, off, at[mine])
    use[mine] = upto[lo + count] > upto[lo]
    return np.sort(later), use


def _fingerprints(docs: DataFrame) -> DataFrame:
    """h, _key, _th, pos of fingerprints; and for each stretch that repeats earlier words of its own text, h: the stretch's words,
    twice (an even number, as no line's hash is), pos: -1 less its first word.
    """

    def run(batches):
        for batch in slices(batches, "text", 8_000_000):
            off, code, vocab = ascii_words(texts_of(batch))
            words = hash_words(vocab)[code] if len(vocab) else np.empty(0, np.uint64)
            at, g = winnow(words, off)
            later, use = repeated_within(words, off, at, g) if len(at) else (at, np.empty(0, bool))
            at, g = at[use], g[use]
            whose = owner(off) if len(words) else np.empty(0, np.int64)
            new = np.ones(len(later), bool)
            new[1:] = (later[1:] > later[:-1] + RUN) | (whose[later[1:]] != whose[later[:-1]])
            s, e = later[new], later[np.roll(new, -1)] + RUN
            who = np.concatenate((whose[at], whose[s]))
            take = pa.array(who)
            h = np.concatenate((g.view(np.int64), 2 * (e - s)))
            pos = np.concatenate((at - off[whose[at]], -1 - (s - off[whose[s]])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), ints_of(batch, "_key").take(take), ints_of(batch, "_th").take(take), pa.array(pos.astype(np.int32))],
                names=["h", "_key", "_th", "pos"],
            )

    return docs.select("_key", "_th", "text").mapInArrow(run, "h long, _key long, _th int, pos int")


def _chains(hits: DataFrame) -> DataFrame:
    """Runs of fingerprints with one shift; hits: _key, _th, hits array of (c, cth, cpos, pos, many), many: if three places have it.

    many: pos of the others where windows around it reach beyond the run's lines.
    """

    def run(batches):
        for batch in batches:
            lists = ints_of(batch, "hits")
            flat = lists.flatten()
            who = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            c, cth, cpos, pos, many = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            shift = pos.astype(np.int64) - cpos
            order = np.lexsort((pos, shift, cth, c, who))
            who, c, cth, shift, pos, many = who[order], c[order], cth[order], shift[order], pos[order].astype(np.int64), many[order]
            if not len(who):
                continue
            new = np.ones(len(who), bool)
            new[1:] = (who[1:] != who[:-1]) | (c[1:] != c[:-1]) | (cth[1:] != cth[:-1]) | (shift[1:] != shift[:-1]) | (pos[1:] - pos[:-1] > LINE)
            s = np.flatnonzero(new)
            e = np.concatenate((s[1:], [len(who)])) - 1
            run = np.cumsum(new) - 1
            near = (pos - pos[s][run] < WINDOW - 1) | (pos[e][run] - pos < WINDOW - 1)
            some = np.flatnonzero(near & many)
            of = np.concatenate(([0], np.cumsum(np.bincount(run[some], minlength=len(s))))).astype(np.int32)
            take = pa.array(who[s])
            yield pa.RecordBatch.from_arrays(
                [ints_of(batch, "_key").take(take), ints_of(batch, "_th").take(take), pa.array(c[s]), pa.array(cth[s]), pa.array(pos[s].astype(np.int32)), pa.array(pos[e].astype(np.int32)),
                 pa.array((pos[s] - shift[s]).astype(np.int32)), pa.array((pos[e] - shift[s]).astype(np.int32)), pa.ListArray.from_arrays(pa.array(of), pa.array(pos[some].astype(np.int32)))],
                names=["_key", "_th", "c", "cth", "first", "last", "cfirst", "clast", "many"],
            )

    return hits.mapInArrow(run, "_key long, _th int, c long, cth int, first int, last int, cfirst int, clast int, many array<int>")


def _contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """What is around the asked places (c, cth, p, a, b), in one reading of the texts.

    Where a is -1: c, cth, p, before (hashed words, nearest first), after (from p + LINE on). Else, for each window that
    windows_at finds at p and that is not within the words [a, b): c, cth, start, the line hash h, the window's hash w.
    """
    side = WINDOW - 1

    def answer(batch, places):
        rows = [i for i, x in enumerate(places) if x is not None and len(x[0])]
        if not rows:
            return
        off, code, vocab = ascii_words(texts_of(batch).take(pa.array(rows)))
        words = hash_words(vocab)[code] if len(vocab) else np.empty(0, np.uint64)
        h = words.view(np.int64)
        row, at = [], []
        before, after = [], []
        for j, i in enumerate(rows):
            w = h[off[j] : off[j + 1]]
            for p in places[i][0][places[i][1] < 0].tolist():
                row.append(i)
                at.append(p)
                before.append(w[max(0, p - side) : p][::-1])
                after.append(w[p + LINE : p + LINE + side])

        def out(row, p, before, after, start, h, w):
            take = pa.array(row, pa.int64())
            return pa.RecordBatch.from_arrays([ints_of(batch, "_key").take(take), ints_of(batch, "_th").take(take), p, before, after, start, h, w], names=names)

        n, lists = len(row), pa.list_(pa.int64())
        yield out(row, pa.array(at, pa.int32()), pa.array(before, lists), pa.array(after, lists), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()))
        p, a, b = (np.concatenate([places[i][x] for i in rows]).astype(np.int64) for x in range(3))
        text = np.repeat(np.arange(len(rows)), [len(places[i][0]) for i in rows])[a >= 0]
        if len(text):
            p, b, a = p[a >= 0], b[a >= 0], a[a >= 0]
            g, lo, count, x = windows_at(words, off, off[text] + p)
            each = np.repeat(np.arange(len(text)), count)
            start = lo[each] - off[text[each]] + np.arange(len(each)) - (np.cumsum(count) - count)[each]
            use = (start < a[each]) | (start + RUN > b[each])
            each, n = each[use], int(use.sum())
            yield out(np.array(rows)[text[each]], pa.nulls(n, pa.int32()), pa.nulls(n, lists), pa.nulls(n, lists), pa.array(start[use].astype(np.int32)), pa.array(g[each].view(np.int64)), pa.array(x[use].view(np.int64)))

    names = ["c", "cth", "p", "before", "after", "start", "h", "w"]
    kind = "c long, cth int, p int, before array<long>, after array<long>, start int, h long, w long"
    if asked.count() <= SEND:
        t = asked.toArrow().combine_chunks()
        c, cth, p, a, b = (t.column(x).to_numpy() for x in ("c", "cth", "p", "a", "b"))
        order = np.lexsort((p, cth, c))
        sent = t.num_rows and docs.sparkSession.sparkContext.broadcast((c[order], cth[order], p[order], a[order], b[order]))

        def look(batches):
            for batch in slices(batches, "text", 4_000_000):
                if not sent:
                    return
                c, cth, *rest = sent.value
                key, th = ints_of(batch, "_key").to_numpy(), ints_of(batch, "_th").to_numpy()
                lo, hi = np.searchsorted(c, key, "left"), np.searchsorted(c, key, "right")
                places = [[x[s:e][same] for x in rest] if e > s and (same := cth[s:e] == t).any() else None for s, e, t in zip(lo.tolist(), hi.tolist(), th.tolist(), strict=True)]
                yield from answer(batch, places)

        return docs.select("_key", "_th", "text").mapInArrow(look, kind)

    def joined(batches):
        for batch in slices(batches, "text", 4_000_000):
            lists = ints_of(batch, "ps").to_pylist()
            yield from answer(batch, [[np.array([x[k] for x in ps]) for k in ("p", "a", "b")] for ps in lists])

    places = asked.groupBy(F.col("c").alias("_key"), F.col("cth").alias("_th")).agg(F.collect_list(F.struct("p", "a", "b")).alias("ps"))
    return docs.select("_key", "_th", "text").join(places, ["_key", "_th"]).mapInArrow(joined, kind)


def _extended(h: np.ndarray, first: int, last: int, before: np.ndarray, after: np.ndarray) -> tuple[int, int]:
    """The words [a, b) of a run, as far as the words around it agree; h: the text's hashed words."""
    a, b = first, last + LINE
    m = min(a, len(before))
    differ = np.flatnonzero(h[a - m : a][::-1] != before[:m])
    a -= int(differ[0]) if len(differ) else m
    m = min(len(h) - b, len(after))
    differ = np.flatnonzero(h[b : b + m] != after[:m])
    b += int(differ[0]) if len(differ) else m
    return a, b


def _cut(text: str, gone: np.ndarray) -> tuple[str, list[dict]]:
    """The text without the words that are gone, and the code points [start, end) that went."""
    spans = [m.span() for m in WORD.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    cuts = []
    for a, b in edge.reshape(-1, 2).tolist():
        if b < len(spans):
            cuts.append((spans[a][0], spans[b][0]))
        else:
            cuts.append((spans[a - 1][1] if a else 0, len(text)))
    at, kept = 0, []
    for s, e in cuts:
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return "".join(kept), [{"start": s, "end": e} for s, e in cuts]


def _plainly(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its other columns under names that clash with nothing, and those other columns."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"other{i}") for i, c in enumerate(rest)]), rest


def cleaned(docs: DataFrame) -> DataFrame:
    """docs, all columns as they are but for the text, which dedup_lines has cleaned; without documents of which nothing remains."""
    plain, rest = _plainly(docs)
    out = _dedup(plain).where("NOT emptied")
    back = {c: F.col(f"other{i}").alias(c) for i, c in enumerate(rest)}
    return out.select(*[back.get(c, c) for c in docs.columns])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with text cleaned and three more columns: removed (spans of the text before, code points [start, end)),
    n_removed (words), and emptied (whether they were all). One row for each row of docs (doc_id, text, any others; others that
    are named like the three are replaced).

    The place that stays is the first by doc_id, then by position; with null doc_id first of all. Rows that repeat a doc_id
    with another text are ordered by a hash of the text; rows that repeat both are one document, of which no copy counts as
    later. Null texts stay null, with nothing removed; texts of fewer than RUN words lose nothing. Words are compared with
    A-Z lowered.
    """
    plain, rest = _plainly(docs.drop("removed", "n_removed", "emptied"))
    back = {c: F.col(f"other{i}").alias(c) for i, c in enumerate(rest)}
    return _dedup(plain).select(*[back.get(c, c) for c in docs.columns if c in ("doc_id", "text", *rest)], "removed", "n_removed", "emptied")


def _dedup(docs: DataFrame) -> DataFrame:
    keyed = docs.withColumns({"_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "_th": F.pmod(F.xxhash64("text"), F.lit(2**31)).cast("int")})
    found = written(_fingerprints(keyed), "prints")
    own = found.where("pos < 0").distinct().selectExpr("_key", "_th", "-1 - pos AS start", "CAST(-1 - pos + h / 2 AS INT) AS end")
    prints = found.where("pos >= 0")
    first = prints.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("_key", "_th", "pos")).alias("f")).where("n > 1")
    # written, so that both sides of the join are plain exchanges: then a fingerprint that very many places have can be split
    first = written(first.select("h", "n", F.col("f._key").alias("c"), F.col("f._th").alias("cth"), F.col("f.pos").alias("cpos")), "first")
    # each key once on the built side: its tables are as even as the hashes, and the many rows beside them need no sort
    later = prints.join(first.hint("shuffle_hash"), "h").where("NOT (_key = c AND _th = cth AND pos = cpos)")
    hits = later.groupBy("_key", "_th").agg(F.collect_list(F.struct("c", "cth", "cpos", "pos", (F.col("n") > 2).alias("many"))).alias("hits"))
    chains = written(_chains(hits), "chains")
    asked = chains.select("c", "cth", F.explode(F.array("cfirst", "clast")).alias("p"), F.lit(-1).alias("a"), F.lit(-1).alias("b"))
    again = chains.select(F.col("_key").alias("c"), F.col("_th").alias("cth"), F.explode("many").alias("p"), F.col("first").alias("a"), (F.col("last") + LINE).alias("b"))
    asked = written(asked.union(again).distinct(), "asked")
    around = written(_contexts(keyed, asked), "around")
    windows = around.where("w IS NOT NULL").select("h", "w", F.col("c").alias("_key"), F.col("cth").alias("_th"), F.col("start").alias("first"))
    oldest = windows.groupBy("h", "w").agg(F.count("*").alias("n"), F.min(F.struct("_key", "_th", "first")).alias("f")).where("n > 1")
    oldest = written(oldest.select("h", "w", "f"), "oldest")
    repeats = windows.join(oldest.hint("shuffle_hash"), ["h", "w"]).where("NOT (_key = f._key AND _th = f._th AND first = f.first)")
    repeats = repeats.selectExpr("_key", "_th", "first AS start", f"first + {RUN} AS end").union(own)
    repeats = repeats.groupBy("_key", "_th").agg(F.collect_list(F.struct("start", "end")).alias("_windows"))
    around = around.where("w IS NULL")
    left = around.select("c", "cth", F.col("p").alias("cfirst"), "before")
    right = around.select("c", "cth", F.col("p").alias("clast"), "after")
    runs = chains.join(left, ["c", "cth", "cfirst"]).join(right, ["c", "cth", "clast"])
    runs = runs.groupBy("_key", "_th").agg(F.collect_list(F.struct("first", "last", "before", "after")).alias("_runs"))
    runs = runs.join(repeats, ["_key", "_th"], "full")
    rows = keyed.join(runs.hint("shuffle_hash"), ["_key", "_th"], "left").select(*docs.columns, "_runs", "_windows")
    extra = "removed array<struct<start:int,end:int>>, n_removed int, emptied boolean"
    schema = docs.select(*docs.columns).schema

    def run(batches):
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches, "text", 4_000_000):
            n = batch.num_rows
            found, windows = ints_of(batch, "_runs"), ints_of(batch, "_windows")
            some = np.flatnonzero(pc.and_(pc.or_(found.is_valid(), windows.is_valid()), ints_of(batch, "text").is_valid()).to_numpy(zero_copy_only=False))
            texts = texts_of(batch).take(pa.array(some))
            off, code, vocab = ascii_words(texts)
            h = hash_words(vocab).view(np.int64)[code] if len(vocab) else np.empty(0, np.int64)
            runs = found.take(pa.array(some))
            each, flat = runs.offsets.to_numpy(), runs.flatten()
            each = each - each[0] if len(each) else each
            windows = windows.take(pa.array(some))
            w_off, starts, ends = windows.offsets.to_numpy(), *(windows.flatten().field(x).to_numpy() for x in ("start", "end"))
            w_off = w_off - w_off[0] if len(w_off) else w_off
            first, last = flat.field("first").to_numpy(), flat.field("last").to_numpy()
            (b_off, b), (a_off, a) = ((x.offsets.to_numpy(), x.values.to_numpy()) for x in (flat.field("before"), flat.field("after")))
            changed, new, removed, emptied = np.zeros(n, bool), [], np.zeros(n, np.int32), np.zeros(n, bool)
            cuts = [()] * n
            for j, i in enumerate(some.tolist()):
                w = h[off[j] : off[j + 1]]
                gone = np.bincount(starts[w_off[j] : w_off[j + 1]], minlength=len(w) + 1) - np.bincount(ends[w_off[j] : w_off[j + 1]], minlength=len(w) + 1)
                for r in range(each[j], each[j + 1]):
                    s, e = _extended(w, int(first[r]), int(last[r]), b[b_off[r] : b_off[r + 1]], a[a_off[r] : a_off[r + 1]])
                    if e - s >= RUN:
                        gone[s] += 1
                        gone[e] -= 1
                off_words = np.cumsum(gone[:-1]) > 0
                if off_words.any():
                    text, cuts[i] = _cut(texts[j].as_py(), off_words)
                    new.append(text)
                    changed[i], removed[i], emptied[i] = True, off_words.sum(), off_words.all()
            names = [f.name for f in batch.schema if f.name not in ("_runs", "_windows")]
            cols = [batch.column(i) for i, f in enumerate(batch.schema) if f.name not in ("_runs", "_windows")]
            if changed.any():
                at = names.index("text")
                whole = cols[at].take(pa.array(np.arange(n)))
                cols[at] = pc.replace_with_mask(whole, pa.array(changed), pa.array(new, whole.type))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(cuts, spans), pa.array(removed), pa.array(emptied)], names=[*names, "removed", "n_removed", "emptied"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.mapInArrow(run, f"{kind}, {extra}")
