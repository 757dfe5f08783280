"""Document fingerprints: a randomised edit embedding, sampled, banded and verified.

All texts share one random walk: at step j a text gives the character its pointer is at, and the pointer moves on or stays by
a bit that step and character decide. Texts that differ by few edits fall back into step soon after each, so edit distance
becomes Hamming distance between the characters given. A hash samples the steps: every text keeps between SAMPLES / 2 and
about 1.4 SAMPLES of them, the longer the text the sparser, and the steps of a sparser sample are among those of a denser one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ints_of, mix, shared_dir, slices, texts_of, written

#: Steps kept of a text (the scale), steps after which the walk's bits repeat, code points that walk together.
SAMPLES, PERIOD, WALK_CHARS = 256, 4096, 8_000_000
#: Bands of each part of a fingerprint, sampled characters in a band, likeness that a link needs, edits per character that it may have.
BANDS, WIDTH, LIKE, EDITS = 24, 8, 0.25, 0.2
#: Ranges of doc_id that the documents are dealt to, for each shuffle partition.
RANGES = 2

_BITS = np.random.Generator(np.random.PCG64(11)).integers(0, 2, (PERIOD, 256), dtype=np.uint8)
_BITS[:, 0] = 0  # the end of a text: the pointer stays


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as bytes (ASCII as it is, others hashed to 128..255), each text closed by a 0; where texts begin."""
    cp = np.frombuffer("\x00".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    start = np.cumsum(size) - size
    high = 128 + (mix(cp.astype(np.uint64)) % np.uint64(128)).astype(np.uint8)
    code = np.where((cp > 0) & (cp < 128), cp.astype(np.uint8), high)
    code[start + size - 1] = 0
    return code, start


def _levels(steps: int) -> np.ndarray:
    """How sparse a sample may be to keep each step: the number of trailing zeros of its hash."""
    h = mix(np.arange(1, steps + 1, dtype=np.uint64)) | np.uint64(1 << 40)
    return np.log2((h & (~h + np.uint64(1))).astype(np.float64)).astype(np.int8)


def level_of(n: np.ndarray) -> np.ndarray:
    """The sparseness of texts of n characters."""
    return np.maximum(0, np.floor(np.log2(np.maximum(3 * n, 1) / SAMPLES))).astype(np.int64)


def embed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled characters (texts x places, 0 beyond the end), how many each text has, and its level."""
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    code, start = _codes(texts)
    order = np.argsort(-size, kind="stable")
    level = level_of(size)[order]
    at = start[order].copy()
    out, count = np.zeros((n, 4 * SAMPLES), np.uint8), np.zeros(n, np.int64)
    steps = 3 * int(size.max() if n else 0) + 64
    keep = _levels(steps)
    first = [int(np.searchsorted(-level, -v, side="left")) for v in range(int(keep.max(initial=0)) + 1)]  # texts whose level is at most v
    active = n
    for j in range(steps):
        if j % 32 == 0:
            alive = np.flatnonzero(code[at[:active]])
            active = int(alive[-1]) + 1 if len(alive) else 0
            if not active:
                break
            p = at[:active]
        c = code[p]
        lo = first[keep[j]]
        if lo < active:
            now = np.arange(lo, active)
            out[now, np.minimum(count[lo:active], out.shape[1] - 1)] = c[lo:]
            count[lo:active] += 1
        p += _BITS[j % PERIOD][c]
    count = np.minimum(count, out.shape[1])
    given = (out != 0).sum(axis=1)  # zeros stand beyond the end only
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return _nibbles(out)[back], given[back], level_of(size)


def _nibbles(out: np.ndarray) -> np.ndarray:
    """Four hashed bits of each sampled character, plus one; 0 stays 0."""
    table = (mix(np.arange(256, dtype=np.uint64) + np.uint64(99)) % np.uint64(16)).astype(np.uint8) + 1
    table[0] = 0
    return table[out]


def likeness(a: tuple[np.ndarray, int, int], b: tuple[np.ndarray, int, int]) -> float:
    """0 to 1: the share of the sampled steps at which two fingerprints (values, number, level) agree, less that of chance.

    The sparser level's steps count. Two empty texts are alike, an empty and another one are not.
    """
    (x, n, p), (y, m, q) = a, b
    top = max(p, q)
    x, y = _thin(x[:n], p, top), _thin(y[:m], q, top)
    most = max(len(x), len(y))
    if not most:
        return 1.0 if n == m == 0 or n and m else 0.0
    k = min(len(x), len(y))
    return max(0.0, (float((x[:k] == y[:k]).sum()) / most - 1 / 16) / (15 / 16))


_PLACES: dict[int, np.ndarray] = {}


def _thin(x: np.ndarray, level: int, top: int) -> np.ndarray:
    """Of a level's sample the part that belongs to the sparser level top."""
    if level == top or not len(x):
        return x
    have = _PLACES.get(level)
    if have is None or len(have) < len(x):
        steps = 8 * SAMPLES << level
        lv = _levels(steps)
        have = _PLACES[level] = lv[lv >= level]
    return x[have[: len(x)] >= top]


def text_of(values: np.ndarray, n: int, level: int) -> str:
    """A fingerprint as a string: its level, a point, one hexadecimal digit for each sampled character."""
    return f"{level:x}." + (values[:n] - 1).astype(np.uint8).tobytes().translate(b"0123456789abcdef" + bytes(240)).decode()


# ---------------------------------------------------------------- each document and the next one


def _place(value, cuts: list[float]):
    """How many of the sorted cuts are less than value: first among every so many of them, then between two of those."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts) - 1) + 1
    parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = lambda a: F.size(F.filter(a, lambda c: c < value))
    part = below(F.array(*[F.lit(p[0]) for p in parts]))
    inner = F.get(F.array(*[F.array(*map(F.lit, p)) for p in parts]), part - 1)
    return F.when(part == 0, F.lit(0)).otherwise((part - 1) * step + below(inner))


def _beside_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, _range, _own: documents dealt by ranges of doc_id, each range followed by the first document of the next.

    The ranges are cut at sample quantiles of doc_id, so that no range depends on how ids lie; only their first ids come to
    the driver, as many as ranges.
    """
    spark = docs.sparkSession
    ranges = RANGES * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = sorted(set(keyed.select(F.col("_id").cast("double").alias("x")).approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    keyed = keyed.withColumn("_range", _place(F.col("_id").cast("double"), cuts))
    heads = {r["_range"]: (r["id"], r["n"]) for r in keyed.groupBy("_range").agg(F.max("_id").alias("id"), F.count("*").alias("n")).collect()}
    order = sorted(heads, reverse=True)  # descending ids
    after = [(heads[b][0], a) for a, b in zip(order, [*order[1:], *order[:1]], strict=True)]  # after the last: the first
    if not after:
        return keyed.withColumn("_own", F.lit(True))
    table = spark.createDataFrame(after, "_id long, _to int")
    # of rows that share that id, the first by text is the head
    head = keyed.select("_id", "doc_id", "text").join(F.broadcast(table), "_id")
    head = head.groupBy("_id", "_to").agg(F.min(F.struct("text", "doc_id")).alias("h"))
    head = head.select("_id", F.col("h.doc_id").alias("doc_id"), F.col("h.text").alias("text"), F.col("_to").alias("_range"), F.lit(False).alias("_own"))
    return keyed.withColumn("_own", F.lit(True)).unionByName(head)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    docs: doc_id, text; further columns are ignored. Null texts count as empty. The next document is the one that follows by
    descending doc_id, then by text; null ids come last; after the last comes the first. A single document follows itself.
    """
    rows = _beside_next(docs)
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # within a range descending ids, equal ones by text; the head of the next range last
    rows = rows.repartition(n, "_range").sortWithinPartitions("_range", F.col("_own").desc(), F.col("_id").desc(), F.col("text").asc_nulls_first())

    def done(part: list[tuple]) -> pa.RecordBatch | None:
        """Rows of part but the last, each with the one after it where both are of one range."""
        texts = [t for _, t, _, _ in part]
        use = [i for i in range(len(part) - 1) if part[i][3]]
        edited = [t[: len(t) - (h := len(t) // 2)] + texts[i + 1][:h] for i, t in ((i, texts[i]) for i in use)]
        values, count, level = embed(texts + edited)
        prints = list(zip(values, count.tolist(), level.tolist(), strict=True))
        own = [prints[i] for i in use]
        other = prints[len(texts) :]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part[i][0] for i in use], pa.int64()),
                pa.array([len(texts[i]) for i in use], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
                pa.array([text_of(*p) for p in own], pa.string()),
                pa.array([text_of(*p) for p in other], pa.string()),
                pa.array([likeness(p, q) for p, q in zip(own, other, strict=True)], pa.float64()),
                pa.array([likeness(prints[i], prints[i + 1]) for i in use], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches):
        part: list[tuple] = []
        chars = 0
        for batch in batches:
            cols = [ints_of(batch, c).to_pylist() for c in ("doc_id", "text", "_range", "_own")]
            for i, t, r, o in zip(*cols, strict=True):
                part.append((i, t or "", r, o))
                chars += len(t or "")
                if chars > WALK_CHARS and len(part) > 1:
                    yield done(part)
                    part, chars = part[-1:], len(part[-1][1])
        if len(part) > 1:
            yield done(part)

    return rows.select("doc_id", "text", "_range", "_own").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


# ---------------------------------------------------------------- links


def links(docs: DataFrame, like: float = LIKE, edits: float = EDITS) -> DataFrame:
    """doc_id, other_id, distance: documents that share a band with the smallest id of a bucket and lie within the edit budget.

    docs: doc_id, text. Equal texts fold into the smallest id first and link to it with distance 0. Bands are sampled from all
    parts of the fingerprint at its own and at the next sparser level; a bucket links its members to its smallest id only, so a large group
    gives one link a member; likeness, then the exact edit distance (at most edits times the longer text) verify. Null and empty
    texts link with nothing.
    """
    shared_dir(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND length(text) > 0")
    fold = docs.withColumns({"a": F.xxhash64("text"), "b": F.sha2(F.col("text").cast("binary"), 256)})
    first = fold.groupBy("a", "b").agg(F.min("doc_id").alias("rep"))
    same = fold.join(first, ["a", "b"]).select("doc_id", "rep")
    reps = written(docs.join(first.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "reps")
    pick = np.random.Generator(np.random.PCG64(21))
    # in parts, up to the most places a text has: what differs in one part leaves the others' bands alone
    parts = [0, SAMPLES // 4, SAMPLES // 2, 3 * SAMPLES // 4, SAMPLES, 3 * SAMPLES // 2]
    places = [np.sort(lo + pick.choice(hi - lo, WIDTH, replace=False)) for lo, hi in zip(parts[:-1], parts[1:], strict=True) for _ in range(BANDS)]

    def bands(batches):
        for batch in slices(batches, "text", 4_000_000):
            values, count, level = embed(texts_of(batch).to_pylist())
            doc, key = [], []
            for i in range(batch.num_rows):
                for lv in (level[i], level[i] + 1):
                    x = _thin(values[i, : count[i]], int(level[i]), int(lv)).astype(np.uint64)
                    for b, p in enumerate(places):
                        if b >= BANDS and p[-1] >= len(x):
                            continue  # such a text has no such place
                        y = x[p[p < len(x)]]
                        key.append(int(mix(np.array([(y * (np.uint64(17) ** np.arange(len(y), dtype=np.uint64))).sum(dtype=np.uint64) + np.uint64(int(lv) * len(places) + b << 48)]))[0].view(np.int64)))
                        doc.append(i)
            yield pa.RecordBatch.from_arrays([ints_of(batch, "doc_id").take(pa.array(doc, pa.int64())), pa.array(key, pa.int64())], names=["doc_id", "key"])

    keys = written(reps.mapInArrow(bands, "doc_id long, key long"), "bands")
    low = keys.groupBy("key").agg(F.min("doc_id").alias("other_id"), F.count("*").alias("n")).where("n > 1").select("key", "other_id")
    pairs = keys.join(low, "key").where("doc_id <> other_id").select("doc_id", "other_id").distinct()
    left = reps.select("doc_id", F.col("text").alias("a_text"))
    right = reps.select(F.col("doc_id").alias("other_id"), F.col("text").alias("b_text"))
    both = pairs.join(left, "doc_id").join(right, "other_id").select("doc_id", "other_id", "a_text", "b_text")

    def verify(batches):
        for batch in (p for q in slices(batches, "a_text", 2_000_000) for p in cut(q, "b_text", 2_000_000)):
            a, b = (ints_of(batch, c).to_pylist() for c in ("a_text", "b_text"))
            values, count, level = embed(a + b)
            prints = list(zip(values, count.tolist(), level.tolist(), strict=True))
            keep, far = [], []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                k = int(edits * max(len(x), len(y)))
                if abs(len(x) - len(y)) <= k and likeness(prints[i], prints[len(a) + i]) >= like:
                    d = edit_distance(x, y)
                    if d <= k:
                        keep.append(i)
                        far.append(d)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([ints_of(batch, "doc_id").take(take), ints_of(batch, "other_id").take(take), pa.array(far, pa.int32())], names=["doc_id", "other_id", "distance"])

    near = both.mapInArrow(verify, "doc_id long, other_id long, distance int")
    return near.union(same.where("doc_id <> rep").select("doc_id", F.col("rep").alias("other_id"), F.lit(0).alias("distance")))


def edit_distance(x: str, y: str) -> int:
    """Levenshtein distance, Myers' columns as integers: whole against whole, so the text's start costs too."""
    if not x or not y:
        return max(len(x), len(y))
    m = len(x)
    peq: dict[str, int] = {}
    for i, c in enumerate(x):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for c in y:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | 1) & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return score
