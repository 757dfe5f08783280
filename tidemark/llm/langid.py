"""Language identification: script ranges, per-word scores, Viterbi with a switching penalty.

A word's script leaves the languages that write it; character n-grams (hashed, add-one smoothed) score the word for each of
them; a Viterbi path over the words, which pays SWITCH to change language, labels spans of mixed text. The document's
language is the one that holds most letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_hash, ints_of, owner, slices, texts_of

#: The first code points of the script ranges, in order, and the script of each (0: no letters).
SCRIPT_STARTS = [0x0, 0x41, 0x5B, 0x61, 0x7B, 0xAA, 0xAB, 0xB5, 0xB6, 0xBA, 0xBB, 0xC0, 0xD7, 0xD8, 0xF7, 0xF8, 0x2B0, 0x370, 0x400, 0x530,
                 0x590, 0x600, 0x900, 0x980, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x2C00, 0x2C60, 0x2C80, 0x3040,
                 0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB50, 0xFE00, 0xFF66, 0xFFA0, 0xFFF0, 0x20000, 0x32000]
SCRIPT_IDS = [0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 2, 3, 4,
              5, 6, 7, 8, 9, 10, 11, 12, 13, 1, 2, 0, 3, 1, 14, 15,
              15, 16, 17, 14, 12, 0, 17, 1, 6, 0, 15, 12, 0, 17, 0]
SCRIPTS = 18

#: Buckets of hashed n-grams, the longest n-gram, documents per language that the model learns from (a bound).
BUCKETS, LONGEST, FIT_DOCS = 1 << 15, 3, 4000
#: Characters of distinct words that a worker holds as n-grams at once; a longer single word is a block of its own.
GRAM_CHARS = 1 << 17
#: What a change of language costs, in natural log units; the most that one word may speak against a language.
SWITCH, CLIP = 12.0, 6.0


def _word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of words with a mark at each end: word number and bucket; and each word's script and letters.

    A word's script is that of its last letter.
    """
    n = len(words)
    text = "\x02" + "\x02".join(words) + "\x02"
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    edge = cp == 2
    who = np.cumsum(edge) - 1  # a mark belongs to the word after it
    script = np.asarray(SCRIPT_IDS)[np.searchsorted(SCRIPT_STARTS, cp, side="right") - 1]
    script[edge] = 0
    letters = np.bincount(who[script > 0], minlength=n + 1)[:n]
    kind = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(script > 0)
    kind[who[at]] = script[at]
    grams, owners = [], []
    key = cp.astype(np.uint64) + np.uint64(1)
    for m in range(1, LONGEST + 1):
        g = np.zeros(len(cp) - m + 1, np.uint64)
        for j in range(m):
            g = g * np.uint64(0x9E3779B97F4A7C15) + key[j : len(cp) - m + 1 + j] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(m)
        inner = edge[: len(g)].astype(np.int64)
        for j in range(1, m - 1):
            inner = inner + 2 * edge[j : len(g) + j]
        ok = (inner < 2) & (who[: len(g)] < n)  # a mark may stand first or last only
        if m == 1:
            ok &= ~edge
        bucket = (g ^ (g >> np.uint64(29))) % np.uint64(BUCKETS)
        grams.append(bucket[ok].astype(np.int64))
        owners.append(who[: len(g)][ok])
    return np.concatenate(owners), np.concatenate(grams), kind[:n], letters


def _blocks(words: list[str], chars: int = 0):
    """Where blocks of words begin and end: of at most so many characters (GRAM_CHARS), or one word."""
    ends = np.cumsum([len(w) for w in words])
    at = 0
    while at < len(words):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + (chars or GRAM_CHARS), side="right")))
        yield at, to
        at = to


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    parts = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    flat, off = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        off = np.concatenate(([0], np.cumsum(full)))[off]
        flat = flat.filter(pa.array(full))
    enc = flat.dictionary_encode()
    return off, enc.indices.to_numpy(zero_copy_only=False), [w.replace("\x02", "") for w in enc.dictionary.to_pylist()]


class Model:
    """langs; logp[language, bucket]; writes[script, language]: whether the language is written in that script."""

    def __init__(self, langs: list[str], logp: np.ndarray, writes: np.ndarray):
        self.langs, self.logp, self.writes = langs, logp.astype(np.float32), writes

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A score for each word and language, and each word's letters. Words without letters score 0."""
        out, letters = np.empty((len(words), len(self.langs)), np.float32), np.empty(len(words), np.int64)
        for a, b in _blocks(words):
            out[a:b], letters[a:b] = self._block_scores(words[a:b])
        return out, letters

    def _block_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        who, gram, script, letters = _word_grams(words)
        out = np.zeros((len(words), len(self.langs)), np.float64)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(who, self.logp[k][gram], minlength=len(words))[: len(words)]
        per = np.bincount(who, minlength=len(words))[: len(words)]
        out *= (0.5 * np.minimum(1, 12 / np.maximum(per, 1)))[:, None]  # n-grams overlap, and long words repeat themselves
        allowed = self.writes[script]
        allowed = np.where(allowed.any(axis=1, keepdims=True), allowed, True)
        out = np.where(allowed, out, -1e9)
        out = np.maximum(out - out.max(axis=1, keepdims=True), -CLIP)
        out[letters == 0] = 0
        return out.astype(np.float32), letters


def fit(docs: DataFrame, lang: str = "lang", fit_docs: int = FIT_DOCS) -> Model:
    """Learn from docs (text and a language column); at most about fit_docs documents a language, by a hash of doc_id.

    Rows with null text or language teach nothing; with none left the model knows no language. All counts are whole numbers summed
    over the sample, so the model does not depend on how rows are dealt.
    """
    docs = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col(lang).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((SCRIPTS, 0), bool))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, fit_docs / sizes[k]))])
    place = (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) / 1_000_000)
    sample = docs.where(place < share[F.col("lang")])

    def run(batches):
        for batch in slices(batches, "text"):
            lg = ints_of(batch, "lang").to_pylist()
            off, code, words = _tokens(texts_of(batch))
            if not len(code):
                continue
            doc_lang = np.array([langs.index(x) for x in lg])
            counts = np.zeros((len(langs), BUCKETS + SCRIPTS))
            word_lang = doc_lang[owner(off)]
            once = np.unique(owner(off) * len(words) + code)  # a text's word counts once, however often the text repeats it
            once_lang, once_word = doc_lang[once // len(words)], once % len(words)
            times = [np.bincount(code[word_lang == k], minlength=len(words)) for k in range(len(langs))]
            texts = [np.bincount(once_word[once_lang == k], minlength=len(words)) for k in range(len(langs))]
            for a, b in _blocks(words):
                who, gram, script, letters = _word_grams(words[a:b])
                for k in range(len(langs)):
                    counts[k, :BUCKETS] += np.bincount(gram, texts[k][a:b][who], minlength=BUCKETS)[:BUCKETS]
                    counts[k, BUCKETS:] += np.bincount(script, times[k][a:b] * letters, minlength=SCRIPTS)
            row, col = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(col), pa.array(counts[row, col])], names=["k", "f", "n"])

    total = np.zeros((len(langs), BUCKETS + SCRIPTS))
    sums = sample.mapInArrow(run, "k long, f long, n double").groupBy("k", "f").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # at most languages x (BUCKETS + SCRIPTS) rows
        total[r["k"], r["f"]] = r["n"]
    grams, scripts = total[:, :BUCKETS], total[:, BUCKETS:]
    logp = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    writes = (scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) > 0.005).T
    writes[0] = True
    return Model(langs, logp, writes)


def viterbi(scores: np.ndarray, off: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word; scores: words x languages, off: where texts begin. Texts step together."""
    m, langs = scores.shape
    state = np.zeros(m, np.int16)
    length = np.diff(off)
    order = np.argsort(-length, kind="stable")
    start, size = off[:-1][order], length[order]
    top = int(size[0]) if len(size) else 0
    if not top:
        return state
    active = np.searchsorted(-size, -np.arange(1, top + 1), side="right")  # texts of at least t + 1 words
    best, stay = np.empty(m, np.int16), np.empty((m, langs), bool)
    v = scores[start[: active[0]]].copy()
    for t in range(1, top):
        a = active[t]
        v = v[:a]
        at = start[:a] + t
        b = v.argmax(axis=1)
        leap = v[np.arange(a), b] - switch
        best[at] = b
        stay[at] = keep = v >= leap[:, None]
        v = np.where(keep, v, leap[:, None]) + scores[at]
        if a > 0 and t % 64 == 0:
            v -= v.max(axis=1, keepdims=True)
        final = active[t + 1] if t + 1 < top else 0
        if final < a:
            state[at[final:]] = v[final:].argmax(axis=1)
    single = active[1] if top > 1 else 0
    one = start[single : active[0]]
    state[one] = scores[one].argmax(axis=1)
    for t in range(top - 1, 0, -1):
        at = start[: active[t]] + t
        s = state[at]
        state[at - 1] = np.where(stay[at, s], s, best[at])
    return state


def label(texts: pa.Array, model: Model, switch: float = SWITCH):
    """For each text the number of its language (the number of languages: none), the share of its letters, and its spans:
    offsets of the texts' spans, each span's first word, words and language."""
    n, k = len(texts), len(model.langs)
    has = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    none = np.empty(0, np.int64)
    if not k or not has.any():
        return np.full(n, k), np.zeros(n), np.zeros(n + 1, np.int32), none, none, none
    off, code, words = _tokens(texts)
    table, letters = model.word_scores(words)
    state = viterbi(table[code], off, switch)
    who = owner(off)
    got = np.bincount(who * k + state, letters[code], minlength=n * k).reshape(n, k)
    total = got.sum(axis=1)
    known = has & (total > 0)
    pred = np.where(known, got.argmax(axis=1), np.where(has, 0, k))
    score = np.where(known, got.max(axis=1) / np.maximum(total, 1), 0.0)
    change = np.concatenate(([True], (state[1:] != state[:-1]) | (who[1:] != who[:-1])))
    first = np.flatnonzero(change)
    size = np.diff(np.concatenate((first, [len(state)])))
    keep = has[who[first]]
    first, size = first[keep], size[keep]
    lists = np.concatenate(([0], np.cumsum(np.bincount(who[first], minlength=n)))).astype(np.int32)
    return pred, score, lists, first - off[who[first]], size, state[first]


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score, spans for each row of docs (doc_id, text; further columns are ignored).

    score: the share of letters that the path gives to lang_pred. spans: (lang, first_word, words), in reading order.
    Null texts and texts without a letter, and any text when nothing was learned, get 'und', 0 and no spans; texts whose only
    letters are of no listed script get the first language and 0. Ties go to the language that sorts first.
    """

    def run(batches):
        kinds = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())]))
        langs = np.array([*model.langs, "und"], object)
        for batch in slices(batches, "text"):
            pred, score, lists, first, size, lang = label(texts_of(batch), model, switch)
            spans = [pa.array(langs[lang.astype(int)], pa.string()), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))]
            spans = pa.StructArray.from_arrays(spans, fields=list(kinds.value_type))
            yield pa.RecordBatch.from_arrays(
                [ints_of(batch, "doc_id"), pa.array(langs[pred], pa.string()), pa.array(score), pa.ListArray.from_arrays(pa.array(lists), spans)],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    kind = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first_word:int,words:int>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


def accepted(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """The rows of docs in whose text a language is found, all columns as they are but for a null lang: it becomes the found one."""

    def run(batches):
        langs = np.array([*model.langs, "und"], object)
        for batch in slices(batches, "text"):
            pred = label(texts_of(batch), model, switch)[0]
            at = batch.schema.get_field_index("lang")
            kept = pa.array(pred < len(model.langs))
            lang = pc.coalesce(batch.column(at), pa.array(langs[pred], batch.schema.field(at).type))
            yield batch.set_column(at, batch.schema.field(at), lang).filter(kept)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, kind)


def learned(docs: DataFrame) -> Model:
    """The model of the rows of documents that may be learned from: crc32 of the id mod 3 is not 1."""
    return fit(docs.where(F.pmod(id_hash(F.col("doc_id")), F.lit(3)) != 1))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans: learned on two thirds of docs, applied to all."""
    held = (F.pmod(id_hash(F.col("doc_id")), F.lit(3)) == 1).alias("held_out")
    return identify(docs, learned(docs)).select("doc_id", held, "lang_pred", "score", "spans")
