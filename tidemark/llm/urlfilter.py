"""URL filters: host and path rules and glob rules, packed into one bit-parallel automaton.

Every rule is a chain of states, one more than its characters; all chains lie side by side in the bits of a few 64-bit words.
Reading a byte shifts all states at once (Shift-And) and keeps those whose next character it is; a state before a '*' also
stays. All rules run over all URLs of a batch together. What they read of a URL is one string: a point, the host, a mark, the path,
another mark, the canonical URL. A host and path rule is the chain of any bytes, a point, its host, the first mark, its path, any bytes; a
glob is any bytes, the second mark, and the glob itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ints_of, slices

#: Fixed values: (host, path, verdict) of the query's rules; the longest that fits decides.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Globs over canonical URLs that are blocked where no rule decides.
GLOBS = ["*cheap-pills*", "*casino*", "*free-bets*", "*spam-farm*", "ads-track.*", "*.ads-track.*", "*/wp-login*", "*payday-loan*", "*xxx*", "*.onion/*"]

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Marks between the parts of what the automaton reads; bytes that no rule contains.
_PATH, _CANON = "\x00", "\x01"


def chain(pattern: str, plain: bool = False) -> list[int | str]:
    """A pattern as bytes, 'any' (one byte) and 'all' (any bytes); plain: '*' and '?' stand for themselves."""
    return [c if plain or c not in b"*?" else "all" if c == ord("*") else "any" for c in pattern.encode()]


def rule_chain(host: str, path: str) -> list[int | str]:
    """The chain of a rule that fits its host, all its subdomains, and paths that start with its own."""
    return ["all", *chain(f".{host}{_PATH}{path}", plain=True), "all"]


def glob_chain(glob: str) -> list[int | str]:
    """The chain of a glob over the canonical URL."""
    return ["all", *chain(_CANON), *chain(glob)]


class Automaton:
    """Chains, each to match the whole of what is read."""

    def __init__(self, patterns: list[list[int | str]]):
        self.patterns = list(patterns)
        chains = []
        for p in self.patterns:
            steps, stays = [], [False]
            for c in p:
                if c == "all":
                    stays[-1] = True
                else:
                    steps.append(c)
                    stays.append(False)
            chains.append((steps, stays))
        bits = sum(len(s) for _, s in chains)
        self.words = max(1, -(-bits // 64))
        self.first, self.stay = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.on = np.zeros((256, self.words), np.uint64)
        self.last = []
        at = 0
        for steps, stays in chains:
            self._set(self.first, at)
            for i, s in enumerate(stays):
                if s:
                    self._set(self.stay, at + i)
            for i, c in enumerate(steps, 1):
                for b in range(256) if c == "any" else [c]:
                    self._set(self.on[b], at + i)
            at += len(stays)
            self.last.append(at - 1)

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def match(self, urls: list[bytes]) -> np.ndarray:
        """urls x patterns: which match."""
        n = len(urls)
        size = np.fromiter(map(len, urls), np.int64, n)
        order = np.argsort(-size, kind="stable")
        text = np.frombuffer(b"".join(urls), np.uint8)
        start = (np.cumsum(size) - size)[order]
        left = size[order]
        state = np.tile(self.first, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(left[0]) if n else 0):
            a = int(np.searchsorted(-left, -t, side="left"))  # URLs longer than t
            d = state[:a]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:a] = (moved & self.on[text[start[:a] + t]]) | (d & self.stay)
        out = np.zeros((n, len(self.patterns)), bool)
        for j, bit in enumerate(self.last):
            out[order, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one > 0
        return out


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host, path and canonical URL (host, path and query with A-Z lowered, no scheme, no fragment); all empty without '://'."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", "", ""
    rest = url[at + 3 :].partition("#")[0]
    path = rest.partition("?")[0]
    cut = path.find("/")
    host, path = (path, "") if cut < 0 else (path[:cut], path[cut:])
    return host.translate(_UPPER), path, rest.translate(_UPPER)


def judge(pages: DataFrame, rules=tuple(RULES), globs=tuple(GLOBS), key: str = "page_id") -> DataFrame:
    """key, host, path, rule, verdict, globs for each row of pages (key, url; further columns are ignored).

    verdict is the longest fitting rule's, host and path together, of equally long ones the smallest's; without one, block if a glob
    matches the canonical URL, else allow. globs: those that match. Null URLs and those without '://' have an empty host and path, no
    rule, and are allowed. A URL of any length is read whole; repeated rows are judged alike.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    machine = Automaton([rule_chain(h, p) for h, p, _ in ordered] + [glob_chain(g) for g in globs])
    texts, verdicts = [h + p for h, p, _ in ordered], [v for _, _, v in ordered]

    def run(batches):
        names = np.array(globs, object)
        for batch in slices(batches, "url"):
            parts = [split_url(u) for u in ints_of(batch, "url").to_pylist()]
            clear = str.maketrans(_PATH + _CANON, "\x02\x02")
            hit = machine.match([f".{h.translate(clear)}{_PATH}{p.translate(clear)}{_CANON}{c.translate(clear)}".encode("utf-8", "replace") for h, p, c in parts])
            fits, hit = hit[:, : len(ordered)], hit[:, len(ordered) :] & np.array([u is not None and "://" in u for u in ints_of(batch, "url").to_pylist()], bool)[:, None]
            first = np.where(fits.any(axis=1), fits.argmax(axis=1) if len(ordered) else 0, -1).tolist()
            found = [(texts[k], verdicts[k]) if k >= 0 else (None, None) for k in first]
            verdict = [v or ("block" if any_ else "allow") for (_, v), any_ in zip(found, hit.any(axis=1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ints_of(batch, key), pa.array([h for h, _, _ in parts], pa.string()), pa.array([p for _, p, _ in parts], pa.string()),
                 pa.array([r for r, _ in found], pa.string()), pa.array(verdict, pa.string()), pa.array([names[x].tolist() for x in hit], pa.list_(pa.string()))],
                names=[key, "host", "path", "rule", "verdict", "globs"],
            )

    return pages.select(F.col(key).cast("long").alias(key), F.col("url").cast("string").alias("url")).mapInArrow(
        run, f"`{key}` long, host string, path string, rule string, verdict string, globs array<string>"
    )


def oracle_sql() -> str:
    """The same over the table pages, in SQL."""
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    order = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in order)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in order)
    like = " OR ".join(f"canon LIKE '{g.replace('*', '%')}'" for g in GLOBS)
    return f"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, lower(regexp_extract(rest, '^[^#]*')) AS canon FROM r)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN {like} THEN 'block' ELSE 'allow' END AS verdict FROM s"""
