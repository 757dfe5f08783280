"""Whole queries without SQL against plain versions of them: mixing, toxicity, language and the pipeline."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_near_duplicates import brute
from test_texts import nearest, repeated, words

from tidemark.llm import decontaminate, langid, mixing, toxicity
from tidemark.llm.common import table, written


def texts(spark, sf):
    return [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


# ---------------------------------------------------------------- mixing


def mixed(rows):
    """doc_id -> probability; rows: doc_id, source, lang, topic, tokens. Factors by dictionaries, the common one by bisection."""
    cells = Counter()
    for _, *cell, n in rows:
        cells[tuple(cell)] += n
    total, w = sum(cells.values()), {c: float(n) for c, n in cells.items()}
    target = []
    for d, power in enumerate(mixing.POWERS.values()):
        have = Counter()
        for c, n in cells.items():
            have[c[d]] += n
        size = {k: n**power if n else 0 for k, n in have.items()}
        target.append({k: s / sum(size.values()) for k, s in size.items()})
    for _ in range(mixing.ROUNDS):
        for d in range(3):
            now = defaultdict(float)
            for c, x in w.items():
                now[c[d]] += x
            w = {c: x * target[d][c[d]] * total / now[c[d]] if now[c[d]] else 0.0 for c, x in w.items()}
    weight = {c: w[c] / n if n else 0.0 for c, n in cells.items()}
    lo, hi = 0.0, 1e6
    for _ in range(200):
        x = (lo + hi) / 2
        lo, hi = (x, hi) if sum(n * min(1, x * weight[c]) for c, n in cells.items()) < mixing.KEEP * total else (lo, x)
    return {i: min(1, hi * weight[tuple(cell)]) for i, *cell, _ in rows}


def test_mixing(spark, sf):
    out = mixing.mix(table(spark, sf, "documents")).withColumn("drawn", F.pmod(F.xxhash64(F.lit(1), F.col("doc_id")), F.lit(2**53)) / float(2**53)).collect()
    want = mixed([(r["doc_id"], r["source"], r["lang"], r["topic"], len(words(r["text"]))) for r in out])
    for r in out:
        assert abs(r["probability"] - want[r["doc_id"]]) < 1e-4
        assert r["n_tokens"] == len(words(r["text"])) and r["sampled"] == (r["drawn"] < r["probability"] and r["n_tokens"] > 0)


# ---------------------------------------------------------------- toxicity


def plain_logit(g, text):
    """By looking back from each insult and ahead from each threat's verb."""
    w = words(text)
    symbols = [g.symbols(x) for x in w]
    closing = [i for i, y in enumerate(symbols) if toxicity.CLOSE in y]
    quoted = [False] * (len(w) + 1)
    for i, y in enumerate(symbols):
        if toxicity.OPEN in y and any(j >= i for j in closing):
            for k in range(i, min(j for j in closing if j >= i) + 1):
                quoted[k] = True
    found, clause = [], []
    for i, y in enumerate(symbols):
        clause.append(i)
        if toxicity.END not in y and i < len(w) - 1:
            continue
        kind = [next(c for c in symbols[j] if c in toxicity.WORDS) for j in clause]
        count, said = [0] * len(toxicity.NAMES), False
        for n, (j, k) in enumerate(zip(clause, kind, strict=True)):
            before = lambda reach, c, n=n: c in kind[max(0, n - reach) : n]
            if k in (toxicity.INSULT, toxicity.THREAT) and not quoted[j] and not said and not before(toxicity.REACH, toxicity.NEGATION):
                if k == toxicity.INSULT:
                    count[0] += 1
                    count[1] += before(toxicity.REACH + 1, toxicity.TARGET)
                else:
                    count[3] += 1
                    ahead = kind[n + 1 : n + 1 + toxicity.REACH]
                    if toxicity.TARGET in ahead and toxicity.THREAT not in ahead[: ahead.index(toxicity.TARGET)]:
                        count[0] += 1
                        count[2] += 1
            said = said or k == toxicity.REPORT
        found.append(float(g.weights @ np.minimum(count, 3)))
        clause = []
    best = sorted(found, reverse=True)
    return g.weights[-1] + (best[0] if best else 0.0) + toxicity.LATER * sum(best[1 : 1 + toxicity.MORE])


def test_toxicity(spark, sf):
    g = toxicity.Grammar(["idiot", "the", "of"], ["dumm"], [5.0, 0.7, 0.6, 0.4, -4.0])
    rng = random.Random(3)
    parts = ["idiot", "you", "not", "said", "kill", '"idiot"', '"a', 'b"', "him", "x", "y", "end.", "Dummkopf!"]
    made = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    made += [t or "" for _, t in texts(spark, sf)]
    got = g.score(pa.array(made, pa.large_string()))[0]
    for t, x in zip(made, got, strict=True):
        assert abs(x - plain_logit(g, t)) < 1e-9, t


# ---------------------------------------------------------------- language


def test_language(spark, sf):
    """The language of most letters on the best path, found by plain dynamic programming over the words' scores."""
    docs = [(i, t) for i, t in texts(spark, sf) if t and len(t) < 3000][:80]
    m = langid.learned(table(spark, sf, "documents"))
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(docs, "doc_id long, text string"), m).collect()}
    for i, t in docs:
        w = t.lower().split()
        scores, letters = m.word_scores(w)
        if not letters.sum():
            continue
        n = len(m.langs)
        value, back = list(scores[0].astype(float)), []
        for x in scores[1:].astype(float):
            best = max(range(n), key=lambda k: value[k])
            step = [k if value[k] >= value[best] - langid.SWITCH else best for k in range(n)]
            value = [max(value[k], value[best] - langid.SWITCH) + x[k] for k in range(n)]
            back.append(step)
        path = [max(range(n), key=lambda k: value[k])]
        for step in reversed(back):
            path.append(step[path[-1]])
        have = np.bincount(path[::-1], letters, minlength=n)
        assert got[i]["lang_pred"] == m.langs[int(have.argmax())] and abs(got[i]["score"] - have.max() / have.sum()) < 1e-6


# ---------------------------------------------------------------- the pipeline


@pytest.mark.parametrize("seed", [1, 2])
def test_pipeline(spark, tmp_path, seed):
    rng = random.Random(seed)
    some = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n)]
    items, passage = [(k, " ".join(some(12))) for k in range(4)], some(56)
    rows = []
    for i in range(40):
        w = some(rng.randint(20, 40))
        if i % 5 == 1:
            w = w[:7] + passage + w[7:]
        if i % 8 == 3:
            item = items[i % 4][1].split()
            w = [*w, *item[:5], item[5][:-1], *item[6:], *some(3)]  # one edit
        rows.append((i, " ".join(w)))
    rows += [(100 + i, t.replace(t.split()[3], "zzzz", 1)) for i, t in rows[:6]] + [(200, rows[7][1]), (201, None), (202, ""), (203, "12 34"), (204, rows[12][1].upper())]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "de", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {i: t for i, t in rows if any(c.isalpha() for c in t or "")}
    gone = repeated(left.items())
    left = {i: " ".join(w for n, w in enumerate(words(t)) if n not in gone[i]) for i, t in left.items() if len(gone[i]) < len(words(t))}
    near = brute(list(left.items()))
    left = {i: t for i, t in left.items() if near[i][1] == i}
    left = {i: t for i, t in left.items() if not any(nearest(p, decontaminate.normal(t)) <= int(len(p) * decontaminate.RATE) for _, p in items)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, str(tmp_path)), name)
    assert {r["doc_id"]: " ".join(words(r["text"])) for r in docs.collect()} == left and 20 < len(left) < len(rows) - 8
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    chance = mixed([(r["doc_id"], r["source"], r["lang"], r["topic"], r["n_tokens"]) for r in mixing.mix(docs).collect()])
    assert {r["doc_id"] for r in last} <= set(left) and all(abs(r["probability"] - chance[r["doc_id"]]) < 1e-4 for r in last)
