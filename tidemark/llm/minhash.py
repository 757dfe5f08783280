"""Near-duplicate documents: MinHash signatures, banding, exact verification, connected components.

Equal shingle sets first fold into one representative. A document's 128 universal hash minima give 32 bands of four;
a pair of Jaccard 0.75 shares no band with probability (1 - 0.75**4)**32, about 5e-6.

No bucket emits all its pairs. Each bucket names its most central member (the one whose buckets are largest), links every
other member to it, and those pairs are confirmed on whole texts. Components of the confirmed links are formed. Only where
a bucket still holds two components are members of different components compared, in blocks of bounded size: every pair of them
on whole texts, those of likest signatures first, until no two components are linked. Members of one component need no more
comparison, so a large group of copies costs one pair a member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, odd_constants, shared_dir, shingle_sets, slices, texts_of, written
from .components import connected_components

#: Hash minima of a signature, and minima in a band.
HASHES, ROWS = 128, 4
#: Similarity at which documents are linked, as a fraction of whole numbers: 100 * intersection >= 75 * union.
SIMILARITY = 75
#: Members of a centre that are compared with one copy of its text.
CHUNK = 256
#: Documents of a bucket, and shingles of theirs, that are compared with as many others at once.
BLOCK, BULK = 512, 500_000
#: Bits by which documents that are compared are told from others before texts are moved.
MARKS = 1 << 25

_PASS = "doc_id long, n_shingles long, set_a long, set_b long, sig array<int>"


def signatures(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the shingle set, and its HASHES minima (null without shingles)."""

    def run(batches):
        a, b = odd_constants(HASHES, 1), odd_constants(HASHES, 2)
        for batch in slices(batches, "text", 4_000_000):
            w, g = shingle_sets(texts_of(batch), k)
            n = batch.num_rows
            count = np.bincount(w, minlength=n)
            has = np.flatnonzero(count)
            starts = (np.cumsum(count) - count)[has]
            sig = np.empty((len(has), HASHES), np.uint32)
            one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            if len(has):
                for lo in range(0, len(has), 256):  # so many documents' shingles fit a core's cache
                    hi = min(len(has), lo + 256)
                    s, e = starts[lo], starts[hi] if hi < len(has) else len(g)
                    x, at = g[s:e], starts[lo:hi] - s
                    for j in range(HASHES):
                        sig[lo:hi, j] = np.minimum.reduceat(((x * a[j] + b[j]) >> np.uint64(32)).astype(np.uint32), at)
                one[has] = np.add.reduceat(mix(g ^ np.uint64(0x9E3779B97F4A7C15)), starts)
                two[has] = np.bitwise_xor.reduceat(mix(g * a[0] + b[1]), starts)
            valid = np.zeros(n, bool)
            valid[has] = True
            lists = np.zeros(n + 1, np.int32)
            lists[1:] = np.cumsum(valid * HASHES)
            sigs = pa.ListArray.from_arrays(pa.array(lists), pa.array(sig.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(count.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), sigs],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sig"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PASS)


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (doc_id, ...) whose doc_id is one of ids (doc_id), and few others: a filter before an exact join.

    Each id sets one of MARKS bits; the words of them that are not 0 are broadcast, so at most MARKS / 64 rows at any size.
    """
    word = F.expr(f"pmod(shiftright(xxhash64(doc_id), 6), {MARKS // 64})")
    bit = F.expr("shiftleft(1L, CAST(pmod(xxhash64(doc_id), 64) AS INT))")
    words = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    return rows.withColumn("_word", word).join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Those of pairs (src, dst) whose whole texts' shingle sets are alike.

    A centre dst may have very many members: they are dealt to chunks of about CHUNK, and its text goes to each chunk once, not to each
    member. Texts that are in no pair stay where they are. Of a repeated id each text counts.
    """

    def run(batches):
        key, centre = None, []
        for batch in batches:
            for part in cut(batch, "text", 4_000_000):
                dst, salt, doc, first = (part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("dst", "salt", "id", "centre"))
                w, g = shingle_sets(texts_of(part), k)
                at = np.searchsorted(w, np.arange(len(dst) + 1))
                left, right = [], []
                for i in range(len(dst)):
                    mine = g[at[i] : at[i + 1]]
                    if first[i]:
                        now = dst[i], salt[i]
                        centre = [*centre, mine] if now == key else [mine]
                        key = now
                    elif any(_alike(mine, c) for c in centre):
                        left.append(int(doc[i]))
                        right.append(int(dst[i]))
                centre = [c.copy() for c in centre]  # not the whole part's
                yield _pairs(list(zip(left, right, strict=True)))

    sizes = pairs.groupBy("dst").agg(F.count("*").alias("members"))
    chunk = F.pmod(F.xxhash64("src"), F.ceil(F.col("members") / CHUNK)).cast("int")
    members = pairs.join(sizes, "dst").select("dst", chunk.alias("salt"), F.col("src").alias("id"), F.lit(False).alias("centre"))
    centres = members.select("dst", "salt").distinct().select("dst", "salt", F.col("dst").alias("id"), F.lit(True).alias("centre"))
    texts = _marked(texts, pairs.select(F.col("src").alias("doc_id")).union(pairs.select("dst")))
    rows = members.union(centres).join(texts.select(F.col("doc_id").alias("id"), "text"), "id").select("dst", "salt", "id", "centre", "text")
    n = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(n, "dst", "salt").sortWithinPartitions("dst", "salt", F.col("centre").desc())
    return rows.mapInArrow(run, "src long, dst long")


def _alike(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(p), len(q)) < SIMILARITY * max(len(p), len(q)):
        return False
    both = len(np.intersect1d(p, q, assume_unique=True))
    return both > 0 and 100 * both >= SIMILARITY * (len(p) + len(q) - both)


def _across(members: DataFrame, k: int) -> DataFrame:
    """Confirmed links (src, dst) between different components that share a bucket.

    members: key, band, size, bulk, doc_id, comp, sig, text; bulk: shingles in the bucket. A bucket of more than BLOCK members
    or BULK shingles is cut into blocks by a hash of the document; a row goes to one group for each pair of blocks that its
    own block is part of. A pair is looked at in its first common band only. Of a group's links those are returned that
    join components the ones before have not joined, so at most one for each member.
    """
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("bulk") / BULK)).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    rows = members.select("key", "band", "doc_id", "comp", "sig", "text", mine.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rows = rows.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "band", "mine", "doc_id", "comp", "sig", "text")

    def linked(band, two, mine, doc, comp, sig, texts):
        """Links within one group."""
        n = len(doc)
        root = {c: c for c in comp.tolist()}

        def find(c):
            while root[c] != c:
                c = root[c]
            return c

        left, right, agree = [], [], []
        w, g = shingle_sets(texts, k)
        size = np.bincount(w, minlength=n)
        for r in range(n - 1):
            o = np.flatnonzero((comp[r + 1 :] != comp[r]) & (100 * np.minimum(size[r + 1 :], size[r]) >= SIMILARITY * np.maximum(size[r + 1 :], size[r]))) + r + 1
            if two:
                o = o[mine[o] != mine[r]]
            same = sig[o] == sig[r]
            ok = np.ones(len(o), bool)
            if band:
                ok &= ~same[:, : band * ROWS].reshape(len(o), band, ROWS).all(axis=2).any(axis=1)
            left.append(np.full(ok.sum(), r))
            right.append(o[ok])
            agree.append(same[ok].sum(axis=1))
        left, right = np.concatenate(left), np.concatenate(right)
        if not len(left):
            return
        order = np.argsort(-np.concatenate(agree), kind="stable")
        used = np.unique(np.concatenate((left, right)))
        place = np.full(n, -1)
        place[used] = np.arange(len(used))
        g, w = g[place[w] >= 0], place[w[place[w] >= 0]]
        both = None
        if len(left) > 300:  # shared shingles of all pairs at once
            names, col, df = np.unique(g, return_inverse=True, return_counts=True)
            shared = np.flatnonzero(df > 1)
            both = np.zeros((len(used), len(used)), np.float32)
            slot = np.full(len(names), -1)
            slot[shared] = np.arange(len(shared))
            s = slot[col]
            for lo in range(0, len(shared), 4096):
                at = (s >= lo) & (s < lo + 4096)
                x = np.zeros((len(used), min(4096, len(shared) - lo)), np.float32)
                x[w[at], s[at] - lo] = 1
                both += x @ x.T
        at = np.searchsorted(w, np.arange(len(used) + 1))
        for p in order.tolist():
            a, b = int(left[p]), int(right[p])
            ca, cb = find(int(comp[a])), find(int(comp[b]))
            if ca == cb:
                continue
            x, y = place[a], place[b]
            n_both = int(both[x, y]) if both is not None else len(np.intersect1d(g[at[x] : at[x + 1]], g[at[y] : at[y + 1]], assume_unique=True))
            if n_both and 100 * n_both >= SIMILARITY * (size[a] + size[b] - n_both):
                root[max(ca, cb)] = min(ca, cb)
                yield int(doc[a]), int(doc[b])

    def groups(t: pa.Table, last: bool):
        key, i, j, band, mine, doc, comp = (t.column(c).to_numpy() for c in ("key", "i", "j", "band", "mine", "doc_id", "comp"))
        n = len(key)
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        ends = np.concatenate((new[1:], [n]))
        upto = n if last else int(new[-1])
        sig = t.column("sig").combine_chunks()
        sig = pa.concat_arrays([c.flatten() for c in sig.chunks]) if isinstance(sig, pa.ChunkedArray) else sig.flatten()
        sig = sig.to_numpy().reshape(n, HASHES)
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in t.column("text").chunks])
        out = []
        for s, e in zip(new.tolist(), ends.tolist(), strict=True):
            if s < upto and (comp[s:e] != comp[s]).any():
                out += linked(int(band[s]), i[s] != j[s], mine[s:e], doc[s:e], comp[s:e], sig[s:e], texts.take(pa.array(np.arange(s, e))))
        return out, upto

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= 16_000_000:
                out, upto = groups(pa.Table.from_batches(held), False)
                held = pa.Table.from_batches(held).slice(upto).to_batches()
                yield _pairs(out)
        if held and sum(b.num_rows for b in held):
            yield _pairs(groups(pa.Table.from_batches(held), True)[0])

    n = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(run, "src long, dst long")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([y for _, y in rows], pa.int64())], names=["src", "dst"])


def near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs (doc_id, text; further columns are ignored).

    Null and empty texts and texts of spaces have no shingles and link with nothing. Rows of a repeated doc_id count as one
    node that has the links of each; a null doc_id has a null component and is kept. Ties need no rule: the component is
    the smallest doc_id reachable.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = written(signatures(docs, k), "sig")
    sets = first.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = sets.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    ids = first.select("doc_id", "n_shingles", "set_a", "set_b")
    member = written(ids.join(classes, ["set_a", "set_b", "n_shingles"], "left").select("doc_id", "n_shingles", "rep"), "class")
    reps = member.where("doc_id = rep").select("doc_id").distinct()

    bands = HASHES // ROWS
    keys = F.array(*[F.xxhash64(F.lit(i), *[F.col("sig")[i * ROWS + r] for r in range(ROWS)]) for i in range(bands)])
    sigs = sets.select("doc_id", "sig")
    in_band = sets.select("doc_id", "n_shingles", keys.alias("keys")).join(reps, "doc_id", "left_semi")
    in_band = in_band.select("doc_id", "n_shingles", F.posexplode("keys").alias("band", "key"))
    sizes = in_band.groupBy("key").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("bulk")).where("size > 1")
    buckets = written(in_band.join(sizes, "key").select("key", "band", "doc_id", "size", "bulk"), "buckets")
    weight = buckets.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    heavy = buckets.join(weight, "doc_id")
    centre = heavy.groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("low"))).alias("top"))
    centre = centre.select("key", (-F.col("top.low")).alias("dst"))
    stars = buckets.join(centre, "key").where("doc_id <> dst").select(F.col("doc_id").alias("src"), "dst")
    links = written(_confirmed(written(stars.distinct(), "stars"), docs, k), "links")

    comps = connected_components(links)
    label = buckets.where("size > 2").join(comps, F.col("doc_id") == F.col("node"), "left")
    label = written(label.select("key", "band", "doc_id", "size", "bulk", F.coalesce("component", "doc_id").alias("comp")), "labels")
    open_ = label.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    apart = written(label.join(open_, "key"), "open")
    across = apart.join(_marked(sigs, apart), "doc_id").join(_marked(docs, apart), "doc_id")
    links = links.union(written(_across(across, k), "across"))

    twice = member.where("rep IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    comps = connected_components(links.union(twice.select("lo", "hi")))
    out = member.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    root = F.least(F.coalesce("component", "rep", "doc_id"), F.coalesce("rep", "doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), root).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
