"""Personal data, with DataFrame functions only: pattern spans, then information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, card numbers that pass Luhn, and telephone numbers. The method then asks what
else gives protected entities away. The REACH words on either side of an entity of kind c are its company; p(c) is the share of
all words that are company of a c, and the entity has the information IC(c) = -log2 p(c). A term t reveals
PMI(t; c) = log2(p(c | t) / p(c)) of it, where p(c | t) is the share of t's occurrences that are company of a c, less SURE
standard errors over the different texts that show it. What reveals more than DISCLOSURE of IC, in SUPPORT different texts at
least, is a risk wherever it stands: its spans, of kind email_term and so on by what it reveals most of, join the base spans, and
sanitising generalises them to that kind. Entities themselves are masked before words are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Words on either side of an entity that are its company; the share of an entity's information that a term may reveal.
REACH, DISCLOSURE = 50, 0.5
#: Different texts that must show a term as company; standard errors that its share is lowered by.
SUPPORT, SURE = 3, 1.0
#: Risky terms that the plan itself holds, and terms whose counts are looked for by sending them to every task; more are joined.
SEND, SEND_COUNTED = 5_000, 1_000_000
#: Characters of text before and after an entity in which its company is looked for.
NEAR = 16 * REACH

KINDS = ["email", "ip", "card", "phone"]

# Each pattern finds what the plain one finds, without its retries: a run of an e-mail's first characters either stands
# before an @ as a whole or nowhere, a number begins at its first digit, digit groups never give digits back.
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have before its pattern is tried.
NEEDS = {"email": "@", "ip": ".", "card": "0123456789", "phone": "+"}


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total, i):
        d = F.coalesce(F.try_to_number(F.substr(digits, F.length(digits) - i + 1, F.lit(1)), F.lit("9")).cast("int"), F.lit(0))
        twice = F.when(i % 2 == 0, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return n.between(16, 19) & luhn(_digits(m))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _check(kind: str):
    return lambda span: _valid(kind, span["match"])


def spans_of(text: Column, pattern: Column, kind: Column, needed: Column) -> Column:
    """Leftmost non-overlapping matches: array of (kind, start, end, match), code points, end exclusive.

    The pieces between the matches, and the matches, tell where each match stands; no function gives places.
    """
    found = F.when(needed, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,match:string>>")
    pieces = F.split(text, pattern, -1)
    both = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("match")))
    first = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["match"])
        one = F.struct(kind.alias("kind"), start.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(both, first, step, lambda acc: acc["out"])).otherwise(none)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """docs and a column spans: the valid matches of each kind, kinds in the order of KINDS, then by place."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = []
    for kind in KINDS:
        if kind == "card":
            need = F.length(F.regexp_replace(text, "[^0-9]", "")) >= 16
        elif kind == "ip":
            need = text.rlike(r"[0-9]\.[0-9]")
        else:
            need = F.contains(text, F.lit(NEEDS[kind]))
        found = spans_of(text, F.lit(PATTERNS[kind]), F.lit(kind), need)
        parts.append(F.filter(found, _check(kind)))
    return docs.withColumn("spans", F.concat(*parts))


def terms_of(text: Column) -> Column:
    """Words of a text as terms: without A-Z's case and without the punctuation at either end."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, "[\\x20\\x09-\\x0D.,;:!?()\"']+"), "")


def _in_order(spans: Column) -> Column:
    """Spans by place, of those that begin at one place the longest first."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["match"].alias("match"))))
    return F.transform(order, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (-s["back"]).alias("end"), s["match"].alias("match")))


def masked(text: Column, spans: Column) -> Column:
    """The text with a space for every character of a span."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        begin, end = F.greatest(s["start"], acc["at"]), F.greatest(s["end"], acc["at"])
        out = F.concat(acc["out"], F.substr(text, acc["at"] + 1, begin - acc["at"]), F.repeat(F.lit(" "), end - begin))
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(_in_order(spans), first, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))


def risky_terms(docs: DataFrame, found: DataFrame, reach: int = REACH, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """term, kind, revealed: the terms that reveal more of a kind of entity than may be, with the kind of which they reveal most.

    docs: text; found: text and spans, of the documents that have some. A term counts at most as often near entities as it
    occurs. Digits alone and words of one or two letters are no terms.
    """
    found = found.select("text", F.xxhash64("text").alias("of"), "spans", masked(F.col("text"), F.col("spans")).alias("masked"))
    around = found.select("of", "masked", F.explode("spans").alias("s"))
    start, end = F.col("s.start"), F.col("s.end")
    before = F.reverse(terms_of(F.substr("masked", F.greatest(start + 1 - NEAR, F.lit(1)), F.least(start, F.lit(NEAR)))))
    after = terms_of(F.substr("masked", end + 1, F.lit(NEAR)))
    # where the characters end before the words do, the outermost word may be cut
    before = F.slice(before, 1, F.least(F.lit(reach), F.greatest(F.size(before) - (start > NEAR).cast("int"), F.lit(0))))
    after = F.slice(after, 1, F.least(F.lit(reach), F.greatest(F.size(after) - (F.length("masked") - end > NEAR).cast("int"), F.lit(0))))
    near = around.select("of", F.col("s.kind").alias("kind"), F.concat(before, after).alias("terms"))
    near = written(near.select("of", "kind", F.explode("terms").alias("term")).groupBy("kind", "term", "of").agg(F.count("*").alias("n")), "near")
    company = near.where("length(term) > 2 AND NOT term rlike '^[0-9+@.-]+$'").groupBy("kind", "term").agg(F.sum("n").alias("both"), F.count("*").alias("texts"))
    company = written(company.where(F.col("texts") >= support), "company")
    terms = company.select("term").distinct()
    terms = F.broadcast(terms) if company.count() <= SEND_COUNTED else terms
    counted = lambda text: F.explode(terms_of(text)).alias("term")
    every = docs.select(counted(F.col("text"))).groupBy("term").agg(F.count("*").alias("n")).join(terms, "term", "left_semi")
    own = found.select(counted(F.col("text")), F.lit(-1).alias("n")).union(found.select(counted(F.col("masked")), F.lit(1).alias("n")))
    own = own.groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term", "left_semi")  # words of entities do not count
    counts = written(every.union(own).groupBy("term").agg(F.sum("n").alias("n")), "terms")
    total = docs.agg(F.sum(F.size(terms_of(F.col("text")))).cast("double")).first()[0] or 1.0
    kinds = near.groupBy("kind").agg(F.sum("n").alias("slots"))
    kinds = F.broadcast(kinds.select("kind", F.least(F.col("slots") / total, F.lit(1.0)).alias("p")))  # as many rows as kinds
    share = F.least(F.col("both") / F.greatest("n", F.lit(1)), F.lit(1.0)) * F.greatest(1 - SURE / F.sqrt("texts"), F.lit(0.0))
    pmi = F.when((share > 0) & (F.col("p") < 1), F.log2(share / F.col("p")) / -F.log2("p")).otherwise(0.0)
    scored = company.join(counts, "term").join(kinds, "kind").withColumn("revealed", pmi).where(F.col("revealed") > disclosure)
    top = scored.groupBy("term").agg(F.max(F.struct("revealed", "kind")).alias("t"))
    return top.select("term", F.col("t.kind").alias("kind"), F.col("t.revealed").alias("revealed"))


def quoted(term: Column) -> Column:
    """A pattern that matches the term as it is."""
    return F.concat(F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def _term_spans(text: Column, terms: dict[str, Column]) -> Column:
    """Spans of terms, by the kind they reveal; terms: for each kind those of the text."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    edge = r"[^\x20\x09-\x0D.,;:!?()\"']"
    pattern = lambda a: F.concat(F.lit(f"(?<!{edge})(?:"), F.array_join(F.transform(a, quoted), "|"), F.lit(f")(?!{edge})"))
    return F.concat(*[spans_of(low, pattern(a), F.lit(f"{k}_term"), F.size(a) > 0) for k, a in terms.items()])


def _those(terms, wanted: list[str]) -> Column:
    return F.filter(terms, lambda t: t.isin(wanted))


def _of_kind(terms, kind: str) -> Column:
    return F.filter(terms, lambda t: t["kind"] == kind)


def detect(docs: DataFrame, reach: int = REACH, disclosure: float = DISCLOSURE, support: int = SUPPORT, send: int = SEND) -> DataFrame:
    """doc_id, spans: base spans by kind and place, then spans of risky terms (kind email_term and so on) that no base span
    overlaps, by place.

    One row for each row of docs (doc_id, text; further columns are ignored). Null and empty texts have no spans. Rows that
    repeat, and rows without an id, get the spans of their text.
    """
    docs = docs.select("doc_id", "text")
    some = F.size("spans") > 0
    base = with_base_spans(docs).select("doc_id", F.xxhash64("text").alias("_th"), F.when(some, F.col("text")).alias("text"), "spans")
    base = written(base, "spans")  # texts are tried once; those without spans are not kept
    risky = written(risky_terms(docs, base.where(some), reach, disclosure, support), "risky")
    many = risky.count()
    if not many:
        return base.select("doc_id", "spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("_th", F.xxhash64("text"))
    if many <= send:
        held = sorted((r["kind"], r["term"]) for r in risky.collect())
        lists = {k: [t for x, t in held if x == k] for k in KINDS}
        every = [t for _, t in held]
        rows = rows.withColumn("_terms", _those(F.array_distinct(terms_of(text)), every)).where(F.size("_terms") > 0)
        terms = {k: _those("_terms", v) for k, v in lists.items() if v}
    else:
        has = rows.select("doc_id", "_th", F.explode(F.array_distinct(terms_of(text))).alias("term")).join(risky, "term")
        has = has.groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_of")).agg(F.sort_array(F.collect_set(F.struct("kind", "term"))).alias("_terms"))
        rows = rows.join(has, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_of")))
        terms = {k: F.transform(_of_kind("_terms", k), lambda t: t["term"]) for k in KINDS}
    more = rows.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_of"), _term_spans(text, terms).alias("_more")).dropDuplicates(["_id", "_of"])
    out = base.join(written(more, "term-spans"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_of")), "left")
    clear = F.filter("_more", lambda t: ~F.exists("spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return out.select("doc_id", F.concat("spans", F.coalesce(_in_order(clear), F.array().cast(base.schema["spans"].dataType))).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span generalised to its kind in brackets; of spans that overlap the first, which begins earliest and of
    those is the longest, names them all."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        label = F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        out = F.concat(acc["out"], F.when(s["start"] >= acc["at"], label).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(_in_order(spans), first, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))


def digest(found: DataFrame) -> DataFrame:
    """The counts and strings of detect's rows."""
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, part), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(KINDS))
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
