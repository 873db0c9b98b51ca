"""URL filters by a bit-parallel wildcard automaton.

Glob rules over the URL (lower-cased host, then path) are packed side
by side into one multiword Shift-And state: bit k of a pattern says that its
first k elements have matched.  A character moves every pattern at once,
``S = ((S << 1) & move[c]) | (S & stay[c])``; ``stay`` holds the wildcard
loops.  The state of a whole batch of URLs is one matrix of 64-bit words, so a
step is a few vector operations over all URLs and all patterns.

Globs: ``*`` any run of characters but ``/``, ``**`` any run, ``?`` one
character but ``/``.  A rule ``host/path`` becomes the two globs ``host/path**``
and ``*.host/path**``, over the path as it is written.  The method's own globs see the
canonical URL, whose path is percent-decoded once and has A-Z in lower case: words
anywhere in a host, words that are a whole label of it, and words in a path.
A host matches them with or without a path.

Defined cases: a null URL, or one without ``://``, has host and path empty and
gets the default verdict unless a rule says otherwise; very long URLs are matched
whole, a bounded number of states at a time; bytes of a decoded path that are no
UTF-8 match no word; an empty table gives an empty result; repeated rows get equal
results; other columns pass through, and added ones get underscores where the
name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, col, free_name, lower_ascii

#: Rules (verdict, host and path), fixed by the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The method's own words for URLs that no rule fits: anywhere in a host, as a label of a host, in a path.
HOST_WORDS = ("cheap-pills", "casino", "porn", "viagra", "free-ringtone", "payday-loan", "sportwetten", "camgirl")
HOST_LABELS = ("xxx", "sex", "bet", "poker", "adult")
PATH_WORDS = ("/wp-login.php", "/xmlrpc.php", "/viagra", "/cialis", "/casino", "/payday-loan")
MAX_STATE_WORDS = 1 << 22  # URLs x words of one matrix

WORD_BITS = 64


def host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def word_globs(words=HOST_WORDS, labels=HOST_LABELS, paths=PATH_WORDS) -> list[str]:
    """Globs over canonical URLs for the method's words."""
    hosts = [f"*{w}*" for w in words] + [f"{at}{w}{to}" for w in labels for at in ("", "*.") for to in ("", ".*")]
    return [h + end for h in hosts for end in ("", "/**")] + [f"**{p}**" for p in paths]


def canonical(path: str) -> str:
    """A path percent-decoded once, A-Z in lower case."""
    return (unquote(path) if "%" in path else path).translate(UPPER)


def rule_globs(rule: str) -> tuple[str, str]:
    return f"{rule}**", f"*.{rule}**"


class Automaton:
    """All globs in one Shift-And state of ``words`` 64-bit words."""

    def __init__(self, globs: list[str]):
        moves: list[tuple[int, str]] = []  # bit, character ('' is any but '/')
        stays: list[tuple[int, bool]] = []  # bit, whether '/' may pass too
        self.starts, self.accepts = [], []
        bit = 0
        for g in globs:
            self.starts.append(bit)
            k = 0
            while k < len(g):
                if g[k] == "*":
                    deep = g[k:k + 2] == "**"
                    stays.append((bit, deep))
                    k += 2 if deep else 1
                    continue
                bit += 1
                moves.append((bit, "" if g[k] == "?" else g[k]))
                k += 1
            self.accepts.append(bit)
            bit += 1
        self.words = -(-bit // WORD_BITS)
        chars = sorted({c for _, c in moves if c} | {"/"})
        self.codes = np.array([ord(c) for c in chars], dtype=np.uint32)
        # row 0: every character that no pattern names
        self.move = np.zeros((len(chars) + 1, self.words), dtype=np.uint64)
        self.stay = np.zeros_like(self.move)
        slash = chars.index("/") + 1
        for b, c in moves:
            rows = [chars.index(c) + 1] if c else [r for r in range(len(chars) + 1) if r != slash]
            self.move[rows, b // WORD_BITS] |= np.uint64(1 << (b % WORD_BITS))
        for b, deep in stays:
            rows = [r for r in range(len(chars) + 1) if deep or r != slash]
            self.stay[rows, b // WORD_BITS] |= np.uint64(1 << (b % WORD_BITS))
        self.first = np.zeros(self.words, dtype=np.uint64)
        for b in self.starts:
            self.first[b // WORD_BITS] |= np.uint64(1 << (b % WORD_BITS))

    def classes(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == code, at + 1, 0).astype(np.int16)

    def match(self, texts: list[str]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        step = max(1, MAX_STATE_WORDS // self.words)
        parts = [self._match(texts[a:a + step]) for a in range(0, len(texts), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.accepts)), dtype=bool)

    def _match(self, texts: list[str]) -> np.ndarray:
        seqs = [self.classes(t) for t in texts]
        order = np.argsort([-len(s) for s in seqs], kind="stable")
        lens = np.array([len(seqs[i]) for i in order])
        flat = np.concatenate([seqs[i] for i in order]) if len(texts) else np.zeros(0, np.int16)
        begin = np.r_[0, np.cumsum(lens)[:-1]]
        state = np.repeat(self.first[None, :], len(texts), axis=0)
        live = len(texts)
        for pos in range(int(lens[0]) if len(lens) else 0):
            while live and lens[live - 1] <= pos:
                live -= 1
            c = flat[begin[:live] + pos]
            s = state[:live]
            moved = s << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= s[:, :-1] >> np.uint64(WORD_BITS - 1)
            state[:live] = (moved & self.move[c]) | (s & self.stay[c])
        out = np.empty((len(texts), len(self.accepts)), dtype=bool)
        for k, b in enumerate(self.accepts):
            out[order, k] = (state[:, b // WORD_BITS] >> np.uint64(b % WORD_BITS)) & np.uint64(1) == 1
        return out


def judge(pages: DataFrame, url: str = "url", rules=RULES, block_globs=None) -> DataFrame:
    """``pages`` with host, path, rule and verdict (longest rule, else the method's)."""
    rules = list(rules)
    globs = [g for _, r in rules for g in rule_globs(r)]
    own = word_globs() if block_globs is None else list(block_globs)
    by_length = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1]), rules[i][1]))
    n = {x: free_name(pages, x) for x in ("host", "path", "rule", "verdict")}
    df = pages.withColumns({n["host"]: host(col(pages, url)), n["path"]: path(col(pages, url))})
    found = free_name(df, "__rule")

    @F.pandas_udf("rule string, verdict string")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        written, meant = Automaton(globs), Automaton(own)
        for h, p in batches:
            hit = written.match([a + b for a, b in zip(h, p, strict=True)])
            blocked = meant.match([a + canonical(b) for a, b in zip(h, p, strict=True)]).any(axis=1)
            rule = np.full(len(h), None, dtype=object)
            verdict = np.where(blocked, "block", "allow").astype(object)
            for i in reversed(by_length):
                fits = hit[:, 2 * i] | hit[:, 2 * i + 1]
                rule[fits], verdict[fits] = rules[i][1], rules[i][0]
            yield pd.DataFrame({"rule": rule, "verdict": verdict})

    df = df.withColumn(found, apply(n["host"], n["path"]))
    return df.withColumns({n["rule"]: F.col(found)["rule"], n["verdict"]: F.col(found)["verdict"]}).drop(found)


def _loose(word: str) -> str:
    """Pattern of a word in a path as it is written: each character so, in capitals, or percent-coded."""
    def one(c: str) -> str:
        codes = {f"%{ord(x):02x}" for x in (c.lower(), c.upper())}
        return "(?:" + "|".join(sorted({f"[{c}{c.upper()}]", *codes, *(x[0] + x[1:].upper() for x in codes)})) + ")"

    return "".join(map(one, word))


ORACLE = r"""
with u as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
r as (
  select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from u)
select page_id, host, path, rule,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow'
            when rule is not null then 'block'
            when regexp_matches(host, '@host@') then 'block'
            when regexp_matches(path, '@path@') then 'block'
            else 'allow' end as verdict
from r
""".replace("@host@", "|".join([*HOST_WORDS, *(rf"(?:^|[.]){w}(?:[.]|$)" for w in HOST_LABELS)])).replace(
    "@path@", "|".join(map(_loose, PATH_WORDS)))
