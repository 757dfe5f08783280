"""Toxicity: a grammar of weighted finite-state transducers over the words of a clause.

Five transducers stand in a row, each reading what the one before writes: reported speech (verbs of speech, quotations), negation,
target, threat and insult. Each marks insults and threats by what it has seen, and its arcs carry weights; their composition is one
machine, and a clause weighs what the best path through it does. Insults that are quoted, reported or negated weigh nothing, aimed
ones more, and a threat needs a victim. A document's score is the logistic of its best clause's weight and a part of the next ones'.
The insult words and stems, and the weights, are learned from labelled rows; the small lists below seed the rest.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, hash_words, id_hash, ints_of, owner, slices, texts_of, written

#: Labelled rows that the lexicon and the weights are learned from, toxic and clean, at most about.
FIT_ROWS = {1: 4000, 0: 12000}
#: The share of a learned word's documents that must be toxic; how many times more such words than chance gives a number of
#: documents must have; above how many documents numbers are taken together; words that make a stem; a stem's letters.
PURITY, BEYOND, LEVELS, FORMS, STEM = 0.9, 4, 12, 3, (4, 9)
#: Words that a negation or a target reaches, before or (of a threat's victim) behind.
REACH = 2

# Seed words of the transducers.
NEGATIONS = "not no never isn't aren't wasn't nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says wrote writes claimed called quoted reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
TARGETS = "you your you're u he she they him her them du dich ihr euch sie tu te toi vous elle ils usted ustedes vosotros ellos".split()
THREATS = "kill murder stab hang strangle töten umbringen erschießen tuer massacrer matar asesinar".split()
STRIP = ".,;:!?\"'()[]{}<>*_~-…«»“”„¿¡|/\\#%&$"
ENDS, CLOSING = (".", "!", "?", ";", ":"), "\"')]»”"
OPEN_QUOTES, CLOSE_QUOTES = ('"', "“", "«", "„"), ('"', "”", "»", "“")

#: What a clause's words are read as: one symbol each, and one more for a quote that opens or closes and for a clause's end.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, OPEN, CLOSE, END = "oitynrq)e"
WORDS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)
MARKS = (OPEN, CLOSE, END)
#: What the transducers make of an insult or a threat: said by someone else, negated, aimed.
SAID, NEGATED, AIMED = "s", "n", "a"
#: The weights that labels teach, with their values before any label is seen: an insult or a threat at someone, what an aimed insult
#: and a threat weigh besides, a threat's verb, and a text without any.
NAMES = ("insult", "aimed", "threat", "verb", "none")
PRIOR = np.array([4.5, 0.5, 0.5, 0.5, -3.0])
#: How much of the weight of a clause behind the best one counts, and of how many.
LATER, MORE = 0.25, 2
_NOTHING = float("-inf")


class Transducer:
    """A weighted finite-state transducer: arcs[state, symbol] is a list of (next state, output symbol, weight); start: a state.

    Every state has at least one arc for each symbol it can meet. A reading's weight is the sum of its arcs', and the best reading
    of a sequence is that of the largest weight.
    """

    def __init__(self, start, arcs: dict[tuple, list[tuple]]):
        self.start, self.arcs = start, arcs

    def then(self, other: Transducer) -> Transducer:
        """The composition: other reads what self writes."""
        start = (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        mine: dict = {}
        for (state, symbol), found in self.arcs.items():
            mine.setdefault(state, []).append((symbol, found))
        while todo:
            s, t = state = todo.pop()
            for symbol, found in mine.get(s, ()):
                best: dict = {}
                for s2, middle, w in found:
                    for t2, out, v in other.arcs.get((t, middle), ()):
                        key = (s2, t2), out
                        best[key] = max(w + v, best.get(key, _NOTHING))
                if best:
                    arcs[state, symbol] = [(to, out, w) for (to, out), w in best.items()]
                for to, _ in best:
                    if to not in seen:
                        seen.add(to)
                        todo.append(to)
        return Transducer(start, arcs)

    def best(self, symbols) -> tuple[float, list[str]]:
        """The weight of the best reading and what it writes."""
        now = {self.start: (0.0, None)}
        for y in symbols:
            after: dict = {}
            for s, (w, back) in now.items():
                for to, out, v in self.arcs.get((s, y), ()):
                    if to not in after or w + v > after[to][0]:
                        after[to] = (w + v, (back, out))
            now = after
        if not now:
            return _NOTHING, []
        w, back = max(now.values(), key=lambda x: x[0])
        out = []
        while back:
            back, o = back
            out.append(o)
        return w, out[::-1]


def _hot(kind: str) -> list[str]:
    """An insult or a threat as it is read, and with all that the transducers before may have made of it."""
    return [kind, kind + SAID, kind + NEGATED, kind + AIMED]


def reported() -> Transducer:
    """Within a quotation, and behind a verb of speech to the clause's end, insults and threats are somebody else's."""
    arcs = {}
    for inside in range(4):  # whether a verb of speech was read, plus 2 within a quotation
        for y in (*WORDS, *MARKS):
            to = {OPEN: inside | 2, CLOSE: inside & 1, END: inside & 2, REPORT: inside | 1}.get(y, inside)
            arcs[inside, y] = [(to, y + SAID if inside and y in (INSULT, THREAT) else y, 0.0)]
    return Transducer(0, arcs)


def negated() -> Transducer:
    """A negation takes back insults and threats within REACH words behind it."""
    arcs = {}
    for left in range(REACH + 1):
        for y in (OTHER, *_hot(INSULT)[:2], *_hot(THREAT)[:2], TARGET, NEGATION, REPORT, *MARKS):
            to = REACH if y == NEGATION else 0 if y == END else left if y in (OPEN, CLOSE) else max(0, left - 1)
            arcs[left, y] = [(to, y + NEGATED if left and y in (INSULT, THREAT) else y, 0.0)]
    return Transducer(0, arcs)


def targeted(weight: float) -> Transducer:
    """A target reaches insults REACH words behind it: they are aimed, and weigh more."""
    arcs = {}
    for left in range(REACH + 2):
        for y in (OTHER, *_hot(INSULT)[:3], *_hot(THREAT)[:3], TARGET, NEGATION, REPORT, *MARKS):
            to = REACH + 1 if y == TARGET else 0 if y == END else left if y in (OPEN, CLOSE) else max(0, left - 1)
            aimed = left and y == INSULT
            arcs[left, y] = [(to, y + AIMED if aimed else y, weight if aimed else 0.0)]
    return Transducer(0, arcs)


def threatened(weight: float, alone: float) -> Transducer:
    """A threat is one where a target stands within REACH words behind its verb; else the verb weighs little."""
    arcs = {}
    for wait in range(REACH + 1):  # words that are left for the target of a threat's verb
        for y in (OTHER, *_hot(INSULT), *_hot(THREAT)[:3], TARGET, NEGATION, REPORT, *MARKS):
            if y == THREAT:
                arcs[wait, y] = [(REACH, y, alone)]
            elif y == TARGET and wait:
                arcs[wait, y] = [(0, THREAT + AIMED, weight)]
            else:
                to = 0 if y == END else wait if y in (OPEN, CLOSE) else max(0, wait - 1)
                arcs[wait, y] = [(to, y, 0.0)]
    return Transducer(0, arcs)


def insulted(weight: float) -> Transducer:
    """Insults count unless they are said by another or negated; any of them may as well be passed over."""
    arcs = {}
    for y in (OTHER, *_hot(INSULT), *_hot(THREAT), TARGET, NEGATION, REPORT, *MARKS):
        arcs[0, y] = [(0, y, weight), (0, OTHER, 0.0)] if y in (INSULT, INSULT + AIMED) else [(0, y, 0.0)]
    return Transducer(0, arcs)


def machine(weights=PRIOR) -> Transducer:
    """The five transducers, one reading what the other writes, as one."""
    insult, aimed, threat, verb, _ = map(float, weights)
    return reported().then(negated()).then(targeted(aimed)).then(threatened(insult + threat, verb)).then(insulted(insult))


#: What is counted of a clause's best reading, in the order of NAMES: the symbols that carry each weight.
_CARRY = {INSULT: (0,), INSULT + AIMED: (0, 1), THREAT + AIMED: (0, 2), THREAT: (3,)}


class Grammar:
    """Learned insult words and stems, and the weights of the machine that reads clauses."""

    def __init__(self, words, stems, weights=PRIOR):
        self.words, self.stems = frozenset(words), tuple(stems)
        self.classes = {w: k for k, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in ws}
        self.weigh(weights)

    def weigh(self, weights) -> None:
        self.weights = np.asarray(weights, float)
        self.machine = machine(self.weights)
        self.read: dict[str, tuple[float, tuple[int, ...]]] = {}

    def symbols(self, raw: str) -> str:
        """A word as symbols: quotes that open before it, itself, quotes that close and a clause that ends behind it."""
        w = raw.lower().strip(STRIP)
        insult = w in self.words or self.stems and w.startswith(self.stems)
        head, tail = raw.lstrip("([{<*_~-¿¡"), raw.rstrip(".,;:!?)]}>*_~-…#%&$")
        out = OPEN if head.startswith(OPEN_QUOTES) else ""
        out += INSULT if insult else self.classes.get(w, OTHER)
        out += CLOSE if w and tail.endswith(CLOSE_QUOTES) else ""
        return out + (END if raw.rstrip(CLOSING).endswith(ENDS) else "")

    def clause(self, symbols: str) -> tuple[float, tuple[int, ...]]:
        """A clause's weight, and how often each of NAMES is in its best reading (3 at most; the last never)."""
        got = self.read.get(symbols)
        if got is None:
            out = self.machine.best(symbols)[1]
            count = [0] * len(NAMES)
            for o in out:
                for k in _CARRY.get(o, ()):
                    count[k] += 1
            if len(self.read) > 100_000:
                self.read.clear()
            count = tuple(min(c, 3) for c in count)
            got = self.read[symbols] = (float(self.weights @ count), count)
        return got

    def clauses(self, texts: pa.Array):
        """(text, clauses) for each text with an insult's or a threat's word: what clause() makes of the clauses that have one."""
        off, code, vocab = ascii_words(texts)
        symbols = [self.symbols(w) for w in vocab]
        hot = np.fromiter((INSULT in y or THREAT in y for y in symbols), bool, len(vocab))
        opens, closes = (np.fromiter((q in y for y in symbols), bool, len(vocab)) for q in (OPEN, CLOSE))
        ends = np.fromiter((END in y for y in symbols), bool, len(vocab))
        who = owner(off)
        for d in np.unique(who[hot[code]]).tolist():
            part = code[off[d] : off[d + 1]]
            end, warm = ends[part], hot[part]
            number = np.cumsum(end) - end
            inside, stray = np.zeros(len(part) + 1, bool), set()  # whether a quotation is open before a word; quotes that nothing closes
            shut = np.flatnonzero(closes[part])
            for a in np.flatnonzero(opens[part]).tolist():
                k = np.searchsorted(shut, a)
                if k < len(shut):
                    inside[a + 1 : shut[k] + 1] = True
                else:
                    stray.add(a)
            found = []
            for c in np.unique(number[warm]).tolist():
                lo, hi = np.searchsorted(number, (c, c + 1)).tolist()
                words = [symbols[x] for x in part[lo:hi].tolist()]
                for a in stray.intersection(range(lo, hi)) if stray else ():
                    words[a - lo] = words[a - lo].replace(OPEN, "")
                found.append(self.clause((OPEN if inside[lo] else "") + "".join(words)))
            yield d, found

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each text the logit of its best clause and a part of the next ones, and what of NAMES it has."""
        logit, counts = np.full(len(texts), self.weights[-1]), np.zeros((len(texts), len(NAMES)), np.int32)
        for d, found in self.clauses(texts):
            w = sorted((max(x, 0.0) for x, _ in found), reverse=True)
            logit[d] += w[0] + LATER * sum(w[1 : 1 + MORE])
            counts[d] = np.sum([c for _, c in found], axis=0)
        return logit, counts


def features(counts: list) -> list[float]:
    """What a text's logit multiplies the weights with; counts: of NAMES in its best clause and the next ones."""
    return [sum(c[k] * (LATER if n else 1.0) for n, c in enumerate(counts)) for k in range(len(NAMES) - 1)] + [1.0]


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def fit_weights(x: np.ndarray, y: np.ndarray, times: np.ndarray, steps: int = 30) -> np.ndarray:
    """Newton steps on the labelled rows, held near PRIOR, none but the constant below 0; times: how many rows each stands for."""
    w = PRIOR.copy()
    hold = np.full(len(w), 1.0)
    for _ in range(steps):
        p = logistic(x @ w)
        grad = x.T @ (times * (y - p)) - hold * (w - PRIOR)
        hess = (x * (times * p * (1 - p))[:, None]).T @ x + np.diag(hold)
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        new = w + step
        new[:-1] = np.maximum(new[:-1], 0.0)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def lexicon(tokens: DataFrame) -> list[str]:
    """Words of which more than chance explains stand in toxic documents (nearly) alone.

    tokens: toxic, word, sig. Documents of one sig (the smallest hash of their words) count once, so that a group of near
    copies does not make its own rare words toxic. Among words that so many documents have, a share of (toxic share) ** number
    would be purely toxic by chance; a number counts where BEYOND times more are.
    """
    stats = tokens.groupBy("word").agg(F.count_distinct("sig").alias("n"), F.count_distinct(F.when(F.col("toxic") == 1, F.col("sig"))).alias("t"))
    stats = stats.where("n > 1").withColumns({"pure": F.col("t") >= PURITY * F.col("n"), "level": F.least(F.col("n"), F.lit(LEVELS))})
    stats = stats.persist()
    rate = tokens.groupBy("sig").agg(F.max("toxic").alias("t")).agg(F.avg("t")).first()[0] or 0.0
    levels = stats.groupBy("level").agg(F.count("*").alias("all"), F.sum(F.col("pure").cast("long")).alias("pure")).collect()
    good = [r["level"] for r in levels if r["pure"] >= BEYOND * r["all"] * rate ** r["level"] and r["pure"]]
    words = sorted(r["word"] for r in stats.where(F.col("pure") & F.col("level").isin(good)).select("word").collect()) if good else []
    stats.unpersist()
    return words


def stems_of(words: list[str]) -> list[str]:
    """Beginnings that at least FORMS of the words share; the shortest of each kind."""
    count: dict[str, int] = {}
    for w in words:
        for n in range(STEM[0], min(STEM[1], len(w)) + 1):
            count[w[:n]] = count.get(w[:n], 0) + 1
    return sorted(s for s, n in count.items() if n >= FORMS)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: dict[int, int] = FIT_ROWS) -> Grammar:
    """Learn the lexicon and the weights from labelled documents.

    At most about fit_rows rows of each label, chosen by a hash of doc_id; their ids are sent to every task, so documents are
    read where they lie. Null labels and texts teach nothing; without labels the seeds and PRIOR hold.
    """
    labels = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if not sizes:
        return Grammar([], [])
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, fit_rows[k] / n))])
    some = labels.where(place < share[F.col("toxic")])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL").join(F.broadcast(some), "doc_id")

    def run(batches):
        for batch in slices(batches, "text"):
            off, code, vocab = ascii_words(texts_of(batch))
            words = np.array([w.lower().strip(STRIP) for w in vocab], object)
            who = owner(off)
            pairs = np.unique(who * max(1, len(vocab)) + code) if len(code) else np.empty(0, np.int64)
            w, d = words[pairs % max(1, len(vocab))], pairs // max(1, len(vocab))
            sig = np.zeros(batch.num_rows, np.int64)
            if len(d):
                h = hash_words(vocab)[pairs % len(vocab)] >> np.uint64(1)
                first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
                sig[d[first]] = np.minimum.reduceat(h, first).astype(np.int64)
            take, keep = pa.array(d), np.array([len(x) >= 3 for x in w], bool)
            t = pa.RecordBatch.from_arrays([ints_of(batch, "doc_id").take(take), ints_of(batch, "toxic").take(take), pa.array(w, pa.string()), pa.array(sig[d])], names=["doc_id", "toxic", "word", "sig"])
            yield t.filter(pa.array(keep))

    tokens = written(rows.mapInArrow(run, "doc_id long, toxic int, word string, sig long"), "labelled")
    words = lexicon(tokens)
    stems = stems_of(words)
    if stems:
        starts = F.filter(F.array(*[F.lit(s) for s in stems]), lambda s: F.startswith(F.col("word"), s))
        seen = tokens.select("toxic", F.explode(starts).alias("stem")).groupBy("stem").agg(F.avg("toxic").alias("p")).where(F.col("p") >= PURITY)
        pure_stems = sorted(r["stem"] for r in seen.collect())
        stems = [s for s in pure_stems if not any(o != s and s.startswith(o) for o in pure_stems)]
    grammar = Grammar(words, stems)

    def match(batches):
        for batch in slices(batches, "text"):
            rows = [[]] * batch.num_rows
            for d, found in grammar.clauses(texts_of(batch)):
                rows[d] = [c for w, c in sorted(found, reverse=True)[: 1 + MORE] if w > 0]
            yield pa.RecordBatch.from_arrays([ints_of(batch, "toxic"), pa.array([json.dumps(r) for r in rows])], names=["toxic", "clauses"])

    table = rows.select("toxic", "text").mapInArrow(match, "toxic int, clauses string").groupBy("toxic", "clauses").count().collect()
    if not table:
        return grammar
    y = np.array([r["toxic"] for r in table], float)
    times = np.array([r["count"] for r in table], float)
    whole = times.sum()
    for k in (0, 1):  # in the shares that the classes have, not in those that were chosen; as many rows in all as were read
        if times[y == k].sum():
            times[y == k] *= sizes.get(k, 0) / sum(sizes.values()) * whole / times[y == k].sum()
    x = np.array([features(json.loads(r["clauses"])) for r in table])
    grammar.weigh(fit_weights(x, y, times))
    return grammar


def scores(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score (0 to 1) and matches (the counts of NAMES in its clauses) of each row of docs (doc_id, text).

    Null, empty and unmatched texts get the score of no match, and so do texts whose insults are all negated, quoted or reported.
    Rows that repeat get the same score; other columns are ignored.
    """
    parts = (grammar.words, grammar.stems, grammar.weights)

    def run(batches):
        g = Grammar(*parts)
        for batch in slices(batches, "text"):
            logit, c = g.score(texts_of(batch))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * (len(NAMES) - 1)), pa.array(c[:, :-1].ravel()))
            yield pa.RecordBatch.from_arrays([ints_of(batch, "doc_id"), pa.array(logistic(logit)), lists], names=["doc_id", "score", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, matches array<int>")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, matches: learned from labels whose crc32 of the id mod 5 is not 0, for all docs."""
    grammar = fit(docs, labels.where(F.pmod(id_hash(F.col("doc_id")), F.lit(5)) != 0))
    held = (F.pmod(id_hash(F.col("doc_id")), F.lit(5)) == 0).alias("held_out")
    return scores(docs, grammar).select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches")
