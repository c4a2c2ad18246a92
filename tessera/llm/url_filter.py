"""URL filtering with a bit-parallel wildcard automaton.

All glob rules are packed into one multiword Shift-And automaton: each rule has a bit for every prefix of its pattern, a mask
for each byte that occurs in a pattern says which bits the byte may move into, and loop masks say at which bits a wildcard
absorbs it. One step, ``(state << 1) & move[byte] | state & loop[byte]`` over machine words, simulates all rules at once.
Steps from states met before are remembered, within a bound of memory, so that a common URL costs one lookup a byte; a URL
whose state is empty, or can only stay as it is, is read no further.

Globs: ``*`` takes any bytes but ``/``, ``**`` takes any bytes; all else is literal. A glob must match the whole canonical
URL, which is the lower-cased host followed by the path.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, packed, table, unpacked

#: (verdict, host and path). A rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Words of unwanted sites (fixed values).
UNWANTED = (
    "casino", "poker", "jackpot", "roulette", "slot-machine", "sportsbook", "betting-tips", "cheap-pills", "online-pharmacy", "viagra", "cialis", "tramadol", "xanax", "weight-loss-pills",
    "payday-loan", "fast-cash", "credit-repair", "forex-signals", "binary-options", "get-rich", "work-from-home", "free-money", "lottery-winner", "replica-watches", "fake-designer",
    "cheap-viagra", "porn", "xxx-video", "sex-cam", "adult-dating", "escort-service", "hookup", "spam-", "link-farm", "buy-backlinks", "seo-blast", "traffic-bot", "buy-followers",
    "essay-writing", "cheap-essays", "keygen", "crack-download", "warez", "serial-key", "torrent-download", "free-ringtones", "parked-domain", "domain-for-sale", "doorway-page",
    "clickbank", "miracle-cure", "detox-tea",
)
#: Where such a word condemns a URL: anywhere in the host, or as a path segment of the first three, alone or to be bought.
SHAPES = ("*{w}*", "*{w}*/**", *(f"{'*/' * d}{x}" for d in (1, 2, 3) for x in ("{w}", "{w}/**", "{w}.html", "{w}.php", "buy-{w}", "buy-{w}/**")))
#: What decides where no rule fits: URLs that match one of these globs are blocked, all others allowed.
GLOBS = tuple(shape.format(w=w) for w in UNWANTED for shape in SHAPES)
#: A table of globs of more rows is refused with an error, never cut; bytes that remembered states may take in a task.
MOST_GLOBS, MOST_BYTES = 1_000_000, 1 << 26
OUTPUT = ("host", "path", "rule", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLASH = ord("/")


class Automaton:
    """The masks of all globs together, as integers of as many words as their lengths need."""

    def __init__(self, globs: list[str]) -> None:
        start, finals, move, anywhere, within = [], [], {}, [], []
        bit = 0
        for g in globs:
            data, i = g.encode(), 0
            start.append(bit)
            while i < len(data):
                if data[i : i + 1] == b"*":
                    wide = data[i : i + 2] == b"**"
                    (anywhere if wide else within).append(bit)
                    i += 1 + wide
                else:
                    bit += 1
                    move.setdefault(data[i], []).append(bit)
                    i += 1
            finals.append(bit)
            bit += 1
        self.size = bit
        mask = self._mask
        self.start, self.finals, self.final_of = mask(start), mask(finals), {b: k for k, b in enumerate(finals)}
        self.move = {c: mask(bits) for c, bits in move.items()}
        self.anywhere, self.within = mask(anywhere), mask(within)

    def _mask(self, bits: list[int]) -> int:
        out = bytearray(self.size // 8 + 1)
        for b in bits:
            out[b >> 3] |= 1 << (b & 7)
        return int.from_bytes(out, "little")

    def step(self, state: int, byte: int) -> int:
        loop = self.anywhere if byte == SLASH else self.anywhere | self.within
        return (state << 1) & self.move.get(byte, 0) | state & loop

    def matched(self, state: int) -> list[int]:
        """The globs whose last bit is in the state, in order."""
        hit, out = state & self.finals, []
        while hit:
            low = hit & -hit
            out.append(self.final_of[low.bit_length() - 1])
            hit ^= low
        return sorted(out)

    @cached_property
    def absorbing(self) -> int:
        return self.anywhere & self.finals

    def runner(self):
        """bytes -> its final state, with a memory of steps of its own."""
        most = max(256, MOST_BYTES // (self.size // 8 + 64))
        ids: dict[int, int] = {}
        states: list[int] = []
        ended: list[bool] = []
        steps: dict[int, int] = {}

        def number(state: int) -> int:
            if state not in ids:
                ids[state] = len(states)
                states.append(state)
                ended.append(not state & ~self.absorbing)
            return ids[state]

        def run(text: bytes) -> int:
            if len(states) > most:
                for kept in (ids, states, ended, steps):
                    kept.clear()
            at = number(self.start)
            for byte in text:
                key = at << 8 | byte
                if key in steps:
                    at = steps[key]
                else:
                    if len(states) > 2 * most:  # in the middle of a long text
                        state = states[at]
                        for kept in (ids, states, ended, steps):
                            kept.clear()
                        key = number(state) << 8 | byte
                    at = steps[key] = number(self.step(states[key >> 8], byte))
                if ended[at]:
                    break
            return states[at]

        return run


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def globs_of(globs: DataFrame, column: str = "glob") -> tuple[str, ...]:
    """The distinct globs of a table, without nulls, for :func:`filter_urls`; at most ``MOST_GLOBS``."""
    found = globs.select(globs[f"`{column}`"].alias("g")).where("g is not null").distinct().limit(MOST_GLOBS + 1).collect()
    if len(found) > MOST_GLOBS:
        raise ValueError(f"more than {MOST_GLOBS} globs")
    return tuple(sorted(r["g"] for r in found))


def filter_urls(pages: DataFrame, url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES, globs: tuple[str, ...] = GLOBS, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Each row of ``pages`` with ``host, path, rule, verdict``.

    The longest rule that fits wins (of equal ones the earlier); ``rule`` is null where none fits and ``globs`` decide.
    A null URL and one without ``://`` have an empty host and path, fit no rule and are allowed. Rows never meet, so there
    is no shuffle. Input columns named like an output are replaced; empty tables give empty results.
    """
    # A rule "host/path" fits host and all subdomains.
    patterns = [g for _, rule in rules for g in (f"{rule}**", f"*.{rule}**")]
    own = len(patterns)
    machine = pages.sparkSession.sparkContext.broadcast(Automaton([*patterns, *globs]))  # bounded by the globs

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = machine.value
        run, said = m.runner(), {}
        for host, path in parts:
            out = []
            for h, p in zip(host, path, strict=True):
                state = run((h + p).encode("utf-8", "surrogatepass"))
                if state not in said:
                    if len(said) > 10_000:
                        said.clear()
                    hits = m.matched(state)
                    fit = [g // 2 for g in hits if g < own]
                    best = max(fit, key=lambda k: (len(rules[k][1]), -k), default=None)
                    said[state] = (None, "block" if hits else "allow") if best is None else (rules[best][1], rules[best][0])
                out.append(said[state])
            yield pd.DataFrame(out, columns=["rule", "verdict"])

    url = pages[f"`{url_col}`"]
    rows = pages.select(packed(pages, OUTPUT, keep), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("__j", judge("host", "path"))
    return rows.select(*unpacked(rows), "host", "path", "__j.rule", "__j.verdict")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return filter_urls(table(spark, sf_dir, "pages"), keep=("page_id",)).select("page_id", *OUTPUT)


ANY = "|".join(UNWANTED)
SQL = rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rule, h, p) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
      ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
f AS (SELECT p.page_id, max(r.rule) AS rule, max(r.verdict) AS verdict FROM p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)
      WHERE NOT EXISTS (SELECT 1 FROM r q WHERE length(q.rule) > length(r.rule) AND (p.host = q.h OR ends_with(p.host, '.' || q.h)) AND starts_with(p.path, q.p))
      GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN regexp_matches(p.host, '{ANY}')
  OR regexp_full_match(p.path, '(?s)(/[^/]*){{0,2}}/(({ANY})(/.*|\.html|\.php)?|buy-({ANY})(/.*)?)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id
"""
