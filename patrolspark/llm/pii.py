"""Personal data by candidate generation and gradient boosted trees.

Base spans come from fixed patterns with their checks.  High-recall generators
propose further, overlapping spans (numbers without a plus, spelled-out mail
addresses, bare card numbers, keys); boosted trees judge each by its format and
its context, and a span is added if its score passes the threshold of its kind
and it overlaps no span that stands already.

The trees learn from the corpus itself: base spans, and rewritten forms of them
in their own context, are positive; proposed spans that fail a check (octets,
check digits, digit counts) are negative.  A proposed span that no check decides
is labelled by independent evidence only (context words, impossible digits,
address ranges, lengths of digests); without any it neither trains nor
calibrates.  Other numbers and words of a text with base spans are negative too,
``OTHERS`` of them a text, the smallest by a hash over the whole text.  At most
``TRAIN_DOCS`` documents (the smallest by a hash of the id) and ``TRAIN_ROWS``
candidates train them; a fifth is held out, and a kind's threshold is the
lowest score at which the held-out precision is ``PRECISION``.

Positions are code points, end exclusive.  Every pattern runs in linear time.

Defined cases: a null text counts as empty and has no spans; with too few
candidates to learn from only base spans are found; an empty table gives an
empty result; whole texts are read; repeated rows get equal results; other
columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import ipaddress
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boost import Boost
from .common import col, free_name, small_batches

#: Fixed by the contract: the kinds in order, their patterns and checks.
KINDS = ("email", "ip", "card", "phone", "secret")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A number starts a run of digits, so the look-behind only saves repeated tries.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CLUE = re.compile(r"[0-9@]")

#: Generators of further candidates.
_PROPOSE = (
    ("phone", re.compile(r"(?<![0-9.])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])00[0-9]{2}[ 0-9-]{7,14}[0-9](?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])(?:AKIA|ghp_|sk-)[0-9A-Za-z]{16,40}")),
)
_G = "[0-9A-Fa-f]{1,4}"
_SHORT_IP6 = re.compile(rf"(?<![0-9A-Za-z:.])(?:{_G}(?::{_G}){{0,6}}::(?:{_G}(?::{_G}){{0,5}})?|::{_G}(?::{_G}){{0,6}})"
                        r"(?![0-9A-Za-z:])")
_DOT = re.compile("dot", re.IGNORECASE)
#: "name at host dot com"; a last label that is no top-level domain is evidence against it.
_PLAIN_MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} {1,3}at {1,3}[A-Za-z0-9-]{1,63}"
                         r"(?: {1,3}dot {1,3}[A-Za-z0-9-]{1,63}){1,4}(?![A-Za-z0-9-])", re.IGNORECASE)
_TOP = frozenset("com org net edu gov mil int info biz name io co ai app dev me tv eu us uk de fr es it nl be ch at se no dk "
                 "fi pl cz ru ua cn jp kr in au nz ca mx br ar za il tr gr pt ie hu ro".split())
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}"
                      r"(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}){1,4}", re.IGNORECASE)
_OTHER = re.compile(r"[0-9]{1,12}|[A-Za-z]{4,12}")
_CONTEXT = re.compile(r"(?i)\b(?:tel|phone|call|mobile|fax|mail|e-mail|card|visa|ip|host|address|token|key|secret|"
                      r"password)\b")
#: Evidence for spans that no check decides.
_PHONE_WORD = re.compile(r"(?i)\b(?:tel|phone|call|mobile|fax)\b")
_KEY_WORD = re.compile(r"(?i)(?:token|key|secret|password)\W{1,6}$")
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64})")
_LOCAL_FORM = re.compile(r"\(?([0-9])[0-9]{2}\)?[ .-]([0-9])[0-9]{2}[ .-][0-9]{4}")
_RANGES = tuple(map(ipaddress.IPv6Network, ("2000::/3", "fc00::/7", "fe80::/10", "ff00::/8", "::ffff:0:0/96")))
TRAIN_DOCS = 4000
TRAIN_ROWS = 20_000
OTHERS = 64
LEAST_ROWS = 200
PRECISION = 0.99
REACH = 24
Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    if not _CLUE.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if len(m[0]) >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def proposals(text: str) -> list[Span]:
    """Candidate spans of the generators; they may overlap."""
    out: list[Span] = []
    if _CLUE.search(text):
        for kind, pattern in _PROPOSE:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    if "::" in text:
        out += [("ip", *m.span()) for m in _SHORT_IP6.finditer(text)]
    if _DOT.search(text):
        out += [("email", *m.span()) for pattern in (_SPELLED, _PLAIN_MAIL) for m in pattern.finditer(text)]
    return out


def describe(text: str, span: Span, shown: str | None = None) -> list[float]:
    """Format and context features of a span (``shown`` instead of its own text)."""
    kind, a, b = span
    s = text[a:b] if shown is None else shown
    before, after = text[max(0, a - REACH):a], text[b:b + REACH]
    digits = _digits(s)
    letters = sum(c.isalpha() for c in s)
    groups = [g for g in re.split(r"[^0-9A-Za-z]+", s) if g]
    counts = np.unique(list(s), return_counts=True)[1] / max(1, len(s))
    return [
        float(KINDS.index(kind)), len(s), len(digits), letters, len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(digits)), float(-(counts * np.log2(counts)).sum()),
        sum(c in " -.()" for c in s), float("(" in s), float(":" in s), float("at" in s.lower()),
        float(luhn(digits)) if 13 <= len(digits) <= 19 else 0.5,
        max((int(g) for g in groups if g.isascii() and g.isdigit() and len(g) < 6), default=0),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\"'="),
        float(bool(_CONTEXT.search(before))), sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        sum(c in "#$%&*|{}<>" for c in before + after),
        *(float(g[0]) if g[:1].isascii() and g[:1].isdigit() else -1.0 for g in (*groups, "", "")[:2]),
        float(s.count(":")), float(bool(groups) and all(len(g) == 2 for g in groups)), float(bool(_DIGEST.fullmatch(s))),
        float(_top(s)), float("::" in s), sum(c in "[]" for c in s),
    ]


def _apart(spans: Iterator[Span], others: list[Span]) -> Iterator[Span]:
    """Spans, given in order, that overlap none of ``others``."""
    others = sorted((a, b) for _, a, b in others)
    at, end = 0, 0
    for span in spans:
        while at < len(others) and others[at][0] < span[2]:
            end = max(end, others[at][1])
            at += 1
        if end <= span[1]:
            yield span


def _overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < e and s < span[2] for _, s, e in others)


def _valid(text: str, span: Span) -> bool | None:
    """Whether a proposed span passes its kind's check; None where the kind has none."""
    kind, a, b = span
    s = text[a:b]
    if kind == "card":
        return 13 <= len(_digits(s)) <= 19 and luhn(_digits(s))
    if kind == "ip":
        return _octets(s) if "." in s else None if _ipv6(s) else False
    if kind == "phone":
        return None if 9 <= len(_digits(s)) <= 15 else False
    return None


def _ipv6(s: str) -> ipaddress.IPv6Address | None:
    try:
        return ipaddress.IPv6Address(s)
    except ValueError:
        return None


def _evidence(text: str, span: Span) -> int | None:
    """Label of a proposed span by its check or else by independent evidence; None without any."""
    kind, a, b = span
    valid = _valid(text, span)
    if valid is not None:
        return int(valid)
    s, before = text[a:b], text[max(0, a - REACH):a]
    if kind == "phone":
        if _PHONE_WORD.search(before):
            return 1
        local = _LOCAL_FORM.fullmatch(s)  # no area or exchange starts with 0 or 1, no country with 0
        return 0 if (local and (local[1] in "01" or local[2] in "01")) or s.startswith("000") else None
    if kind == "ip":
        if "::" in s and not _digits(s):  # a scope operator between words
            return 0
        if all(len(g) == 2 for g in s.split(":")):  # a fingerprint or hardware address
            return 0
        return 1 if any(_ipv6(s) in r for r in _RANGES) else None
    if kind == "secret":
        return 1 if _KEY_WORD.search(before) else 0 if _DIGEST.fullmatch(s) else None
    if _PLAIN_MAIL.fullmatch(s) and not _top(s):
        return 0
    return None


def _top(s: str) -> bool:
    """Whether a span ends in a top-level domain."""
    return re.split(r"[^0-9A-Za-z-]+", s.rstrip("])"))[-1].lower() in _TOP


def _rewritten(text: str, span: Span) -> Iterator[str]:
    """Other forms in which the span's content could stand."""
    kind, a, b = span
    s = text[a:b]
    if kind == "email":
        yield s.replace("@", " [at] ").replace(".", " [dot] ")
        yield s.replace("@", "(at)").replace(".", "(dot)")
        if _top(s):
            yield s.replace("@", " at ").replace(".", " dot ")
    elif kind == "phone":
        yield s.lstrip("+")
        d = _digits(s)
        yield f"00{d}"
        yield f"00{d[:2]} {d[2:4]} {d[4:]}"
        if len(d) >= 10 and d[-10] not in "01" and d[-7] not in "01":
            yield f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}"
            yield f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}"
    elif kind == "ip":  # as an IPv6 address: mapped, and one of the global range
        octets = [int(p) for p in s.split(".")]
        yield "0:0:0:0:0:ffff:{:02x}{:02x}:{:02x}{:02x}".format(*octets)
        h = hashlib.md5(s.encode()).hexdigest()
        groups = ["2001", *(h[i:i + 4].lstrip("0") or "0" for i in range(0, 28, 4))]
        yield ":".join(groups)
        yield ":".join(groups[:2]) + "::" + groups[2]
        yield ":".join(groups[:4]) + "::" + ":".join(groups[4:6])
        yield "fe80::" + ":".join(groups[1:5])
    elif kind == "card":
        d = _digits(s)
        yield "-".join(d[i:i + 4] for i in range(0, len(d), 4))
        yield " ".join(d[i:i + 4] for i in range(0, len(d), 4))


def examples(text: str, others: int = OTHERS) -> list[tuple[list[float], int]]:
    """Training rows of one text: features and whether they are personal data."""
    base = base_spans(text)
    out = [(describe(text, s), 1) for s in base]
    out += [(describe(text, s, form), 1) for s in base for form in _rewritten(text, s)]
    open_ = [s for s in proposals(text) if not _overlaps(s, base)]
    labels = [_evidence(text, s) for s in open_]
    out += [(describe(text, s), y) for s, y in zip(open_, labels, strict=True) if y is not None]
    kept_out = base + [s for s, y in zip(open_, labels, strict=True) if y != 0]
    if base:  # other numbers and words of the same texts
        found = (("phone" if m[0].isdigit() else "email", *m.span()) for m in _OTHER.finditer(text))
        free = _apart(found, kept_out)
        chosen = heapq.nsmallest(others, free, key=lambda s: (zlib.crc32(f"{s[1]}:{text[s[1]:s[2]]}".encode()), s))
        out += [(describe(text, s), 0) for s in chosen]
    return out


class Judge:
    """Boosted trees and a threshold a kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray):
        self.trees = None
        self.least = np.full(len(KINDS), np.inf)
        if len(y) < LEAST_ROWS or not 0 < y[~held].sum() < (~held).sum():
            return
        self.trees = Boost().fit(x[~held], y[~held])
        score = self.trees.predict(x[held])
        for k in range(len(KINDS)):
            own = x[held][:, 0] == k
            order = np.argsort(-score[own], kind="stable")
            right = y[held][own][order].cumsum()
            good = np.flatnonzero((right / np.arange(1, len(order) + 1) >= PRECISION) & (y[held][own][order] == 1))
            if len(good):
                self.least[k] = max(0.5, score[own][order][good[-1]])

    def added(self, text: str, base: list[Span]) -> list[Span]:
        if self.trees is None:
            return []
        open_ = [s for s in proposals(text) if not _overlaps(s, base)]
        if not open_:
            return []
        x = np.array([describe(text, s) for s in open_])
        score = self.trees.predict(x)
        out: list[Span] = []
        for i in np.argsort(-score, kind="stable"):
            span = open_[i]
            if score[i] >= self.least[int(x[i, 0])] and _valid(text, span) is not False and not _overlaps(span, out):
                out.append(span)
        return out


def written(spans: list[Span]) -> str:
    """kind:start:end by kind and start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", docs_used: int = TRAIN_DOCS,
          rows_used: int = TRAIN_ROWS, others: int = OTHERS) -> Judge:
    """Trees from a bounded sample: ``docs_used`` documents by hash order, ``rows_used`` candidates.

    ``others`` bounds the negatives drawn from a text's other numbers and words.
    """
    ids = docs.select(col(docs, doc_id).alias("id")).where("id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(docs_used)
    rows = docs.select(col(docs, doc_id).alias("d"), F.coalesce(col(docs, text), F.lit("")).alias("t"))
    rows = rows.join(F.broadcast(ids), F.col("d") == F.col("id"))  # docs_used rows at most

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(d, i, x, y) for d, t in zip(batch["d"].astype(str), batch["t"], strict=True)
                   for i, (x, y) in enumerate(examples(t, others))]
            yield pd.DataFrame(out, columns=["d", "i", "x", "y"])

    found = rows.select("d", "t").mapInPandas(apply, "d string, i int, x array<double>, y int")
    found = found.orderBy(F.xxhash64("d", "i"), "d", "i").limit(rows_used).toPandas()
    width = len(describe("", ("email", 0, 0)))
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), width)
    held = np.array([int(hashlib.md5(d.encode()).hexdigest()[:8], 16) % 5 == 0 for d in found["d"]], dtype=bool)
    return Judge(x, found["y"].to_numpy(dtype=np.int64), held)


SCHEMA = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_secret long, redacted string")


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", judge: Judge | None = None) -> DataFrame:
    """``docs`` with a ``pii`` struct of SCHEMA's fields (underscores added if taken).

    ``n_added`` counts the spans beside the base ones, ``n_secret`` all secrets;
    ``redacted`` is the text with every span replaced by its kind in brackets.
    """
    small_batches(docs.sparkSession)
    judge = judge or train(docs, text, doc_id)

    @F.pandas_udf(SCHEMA)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_row(t, judge) for t in batch], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.withColumn(free_name(docs, "pii"), apply(F.coalesce(col(docs, text), F.lit(""))))


def _row(text: str, judge: Judge) -> tuple:
    base = base_spans(text)
    spans = base + judge.added(text, base)
    counts = [sum(s[0] == k for s in base) for k in KINDS[:4]]
    out, at = [], math.inf
    tail = len(text)
    for kind, a, b in sorted(spans, key=lambda s: (-s[2], s[1])):  # from the end; inner overlaps are covered already
        if b <= at:
            out += [text[b:tail], f"[{kind}]"]
            at = tail = a
        elif a < at:
            at = tail = a
    redacted = "".join(reversed([*out, text[:tail]]))
    secrets = sum(s[0] == "secret" for s in spans)
    return (*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans) - len(base), secrets, redacted)
