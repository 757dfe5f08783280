"""Mixing sources to target weights: rake token weights to marginals, then sample documents by calibrated probabilities.

Iterative proportional fitting scales the token counts of the cells (source, language, topic) to each dimension's target
shares in turn until all hold. A cell's weight per token, times one factor that meets the wanted number of tokens with no
probability above 1, is the probability of each of its documents; a hash of the id draws.
"""

from __future__ import annotations

import warnings
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, owner, shared_dir, slices, texts_of, written

DIMS = ("source", "lang", "topic")
#: Target shares: proportional to a power of the tokens that a category has (0: all categories alike).
POWERS = {"source": 0.7, "lang": 0.6, "topic": 0.5}
#: By how much a share may miss its target without a warning.
MET = 1e-3
#: Share of all tokens to keep; topics; rounds over the dimensions; the shift of weight at which they end.
KEEP, TOPICS, ROUNDS, CLOSE = 0.5, 8, 50, 1e-9
#: Cells that the driver rakes; more are raked as tables.
DRIVER_CELLS = 200_000
#: Letters of a word that can name a topic.
TOPIC_LETTERS = 6


def with_topics(docs: DataFrame) -> DataFrame:
    """docs and two columns: topic, the crc32 of the commonest word of TOPIC_LETTERS letters or more (of equally common ones the
    smallest) modulo TOPICS, and n_tokens, its words. Texts without such a word, empty and null ones have topic -1."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for batch in slices(batches, "text"):
            off, code, vocab = ascii_words(texts_of(batch))
            n, v = batch.num_rows, max(1, len(vocab))
            topic = np.full(n, -1, np.int32)
            if len(vocab):
                rank = np.empty(len(vocab), np.int64)
                rank[np.argsort(vocab, kind="stable")] = np.arange(len(vocab))
                names = np.sort(vocab)
                long = np.fromiter((len(w) >= TOPIC_LETTERS for w in vocab), bool, len(vocab))
                ok = long[code]
                pair, times = np.unique(owner(off)[ok] * v + rank[code[ok]], return_counts=True)
                doc, word = pair // v, pair % v
                best = np.lexsort((word, -times, doc))
                first = best[np.concatenate(([True], doc[best][1:] != doc[best][:-1]))] if len(best) else best
                topic[doc[first]] = [zlib.crc32(names[w].encode()) % TOPICS for w in word[first]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(topic), pa.array(np.diff(off))], names=[*batch.schema.names, "topic", "n_tokens"])

    return docs.mapInArrow(run, f"{schema}, topic int, n_tokens long")


def rake(cells: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the cells, of the same total, whose sums by each code have the target shares (where the cells allow it)."""
    w, total = cells.astype(float), float(cells.sum())
    for _ in range(rounds):
        before = w
        for code, share in zip(codes, shares, strict=True):
            now = np.bincount(code, w, minlength=len(share))
            w = w * np.divide(share * total, now, out=np.zeros(len(share)), where=now > 0)[code]
        if np.abs(w - before).sum() <= CLOSE * total:
            break
    far = max((float(np.abs(np.bincount(code, w, minlength=len(share)) / max(total, 1e-300) - share).max(initial=0)) for code, share in zip(codes, shares, strict=True)), default=0.0)
    if total and far > MET:
        warnings.warn(f"after {rounds} rounds a marginal is {far:.4f} from its target share: the cells do not allow the targets, or need more rounds", stacklevel=2)
    return w


def factor(cells: np.ndarray, weights: np.ndarray, keep: float) -> float:
    """x for which the sum of cells * min(1, x * weights / cells) is keep of all tokens."""
    ratio = np.divide(weights, cells, out=np.zeros(len(cells)), where=cells > 0)
    order = np.argsort(-ratio)
    n, w = cells[order].astype(float), weights[order]
    whole = np.concatenate(([0.0], np.cumsum(n)))
    rest = np.concatenate((np.cumsum(w[::-1])[::-1], [0.0]))
    want = keep * n.sum()
    for i in range(len(n)):  # the first i cells are kept whole
        x = (want - whole[i]) / rest[i] if rest[i] > 0 else 0.0
        if x * ratio[order[i]] <= 1:
            return x
    return float("inf")


def _rake_table(cells: DataFrame, powers: dict[str, float], keep: float, rounds: int) -> DataFrame:
    """The same over tables, each dimension's factors a table of its own: cells and their probability and weight."""
    shared_dir(cells.sparkSession)
    total = float(cells.agg(F.sum("n")).first()[0] or 0)
    w = cells.select(*DIMS, "n", F.col("n").cast("double").alias("w"))
    for r in range(rounds):
        start = w.select(*DIMS, F.col("w").alias("was"))
        for d in DIMS:
            sums = w.groupBy(d).agg(F.sum("n").alias("tokens"), F.sum("w").alias("now"))
            size = sums.select(d, F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(powers[d]))).otherwise(0.0).alias("size"), "now")
            whole = size.agg(F.sum("size")).first()[0] or 1.0
            scale = size.select(d, F.when(F.col("now") > 0, F.col("size") / whole * total / F.col("now")).otherwise(0.0).alias("f"))
            w = w.join(scale, d).select(*DIMS, "n", (F.col("w") * F.col("f")).alias("w")).checkpoint()
        if (w.join(start, list(DIMS)).agg(F.sum(F.abs(F.col("w") - F.col("was")))).first()[0] or 0) <= CLOSE * total:
            break
    ratio = F.when(F.col("n") > 0, F.col("w") / F.col("n")).otherwise(0.0)
    lo, hi = 0.0, 1.0
    kept = lambda x: w.agg(F.sum(F.col("n") * F.least(F.lit(1.0), F.lit(x) * ratio))).first()[0] or 0.0
    while kept(hi) < keep * total and hi < 1e9:
        hi *= 4
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if kept(mid) < keep * total else (lo, mid)
    return w.select(*DIMS, ratio.alias("weight"), F.least(F.lit(1.0), F.lit(hi) * ratio).alias("probability"))


def _inner(name: str, taken: list[str]) -> str:
    """A name for a dimension's cells that no column of the documents has."""
    name = f"_{name}"
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def mix(docs: DataFrame, powers: dict[str, float] | None = None, keep: float = KEEP, rounds: int = ROUNDS, driver_cells: int = DRIVER_CELLS, seed: int = 1, with_text: bool = True) -> DataFrame:
    """docs (without text, if not with_text) with topic, n_tokens, weight (per token, 1 on average), probability and sampled.

    docs: doc_id, text, source, lang and any others; those named like the five are replaced. Null sources and languages are categories of
    their own. A document is drawn where a hash of its doc_id falls under its probability: rows of one id and cell are drawn
    together, rows without tokens never.
    """
    powers = powers or POWERS
    spark = docs.sparkSession
    docs = docs.drop("topic", "n_tokens", "weight", "probability", "sampled")
    narrow = None if with_text else written(with_topics(docs).drop("text"), "topics")  # texts are read once
    counted = with_topics(docs.select("source", "lang", "text")) if narrow is None else narrow
    cells = written(counted.groupBy(*DIMS).agg(F.sum("n_tokens").alias("n")), "cells")
    null = "\x00null"
    safe = cells.select(F.coalesce(F.col("source").cast("string"), F.lit(null)).alias("source"), F.coalesce(F.col("lang").cast("string"), F.lit(null)).alias("lang"), "topic", "n")
    safe = safe.groupBy(*DIMS).agg(F.sum("n").alias("n"))
    if cells.count() <= driver_cells:
        t = safe.sort(*DIMS).toPandas()
        codes, shares = [], []
        n = t["n"].to_numpy(np.int64)
        for d in DIMS:
            names, code = np.unique(t[d].to_numpy(), return_inverse=True)
            tokens = np.bincount(code, n, minlength=len(names))
            size = np.where(tokens > 0, np.power(np.maximum(tokens, 1), powers[d]), 0)
            codes.append(code)
            shares.append(size / max(size.sum(), 1e-300))
        w = rake(n, codes, shares, rounds)
        t["weight"] = np.divide(w, n, out=np.zeros(len(n)), where=n > 0)
        t["probability"] = np.minimum(1.0, factor(n, w, keep) * t["weight"]) if len(t) else 0.0
        table = spark.createDataFrame(t.drop(columns="n"), "source string, lang string, topic int, weight double, probability double")
        table = F.broadcast(table)
    else:
        table = written(_rake_table(written(safe, "cells"), powers, keep, rounds), "rates")
    table = table.select(*[F.col(d).alias(_inner(d, docs.columns)) for d in DIMS], "weight", "probability")
    out = with_topics(docs) if narrow is None else narrow
    kept = [c for c in docs.columns if with_text or c != "text"]
    of = {d: F.col(_inner(d, docs.columns)) for d in DIMS}
    same = (F.coalesce(F.col("source").cast("string"), F.lit(null)) == of["source"]) & (F.coalesce(F.col("lang").cast("string"), F.lit(null)) == of["lang"]) & (F.col("topic") == of["topic"])
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(2**53)) / float(2**53)
    return out.join(table, same, "left").select(*[F.col(f"`{c}`") for c in kept], "topic", "n_tokens", "weight", "probability", ((drawn < F.col("probability")) & (F.col("n_tokens") > 0)).alias("sampled"))
