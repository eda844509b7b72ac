"""Secret scan with multipart credential linking.

A credential has parts: an access identifier, a secret, and often an endpoint.  Strong parts tell by their form what they
are: an assignment to a password, token or key, an access key id, a long hexadecimal number.  They are always reported.
Weak parts (a labelled user or client, a random-looking run of letters and digits, a URL or host with port) are harmless
alone.  They are reported only where complementary parts co-occur:

* A scope is a block of lines without a blank line; a line ``[section]`` begins another.  No part crosses lines.
* Every part reaches ``REACH`` characters to both sides within its scope; parts whose reach meets the other are in touch.
  This is an interval join: the parts of the other sort, by their starts and running furthest ends, are searched with
  the ends of each part's reach, so no pairs are formed, however many parts a scope has.
* An identifier and a secret in touch are linked if one of them is strong, or if an endpoint is in touch with one of them.
  Weak parts that are linked are reported, and endpoints in touch with an identifier and a secret that are reported.

A credential never leaves its document, so this is one map pass without a shuffle; each text is searched as a whole.

Defined cases: a null text is empty; an empty text has no spans (the hash of the empty string); rows repeated in all
columns are scanned each; other columns are ignored; an empty table gives no rows.  Weak parts that overlap a strong one, or
an endpoint or identifier before them in ``KINDS``' weak order, are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from typing import Iterator, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Kinds of spans in the order of equal starts; the first three are strong.
KINDS = ("assign", "access", "hex", "endpoint", "identifier", "secret")
STRONG = KINDS[:3]
IDENTIFIERS, SECRETS = ("access", "identifier"), ("assign", "hex", "secret")

#: Characters up to which parts reach for each other.
REACH = 200
#: Least length and least bits a character of a random-looking run.
RANDOM_LENGTH, RANDOM_BITS = 16, 3.0

# The strong patterns.  What a match must hold to count is told beside them; failing matches are used up.
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_LENGTH, _ACCESS_LENGTH = 6, 20
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# What weak parts look like.
_ENDPOINT = re.compile(
    r"""(?ai)\b(?:https?|ftp|sftp|ssh|ldaps?|smtps?|imaps?|amqps?|rediss?|mysql|postgres(?:ql)?|mongodb(?:\+srv)?|s3|wss?)://[^\x00-\x20"'<>]+"""
    r"""|(?<![A-Za-z0-9.-])[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,9}:[0-9]{2,5}(?![0-9])"""
    r"""|\b(?:host(?:name)?|server|endpoint|base_?url|database|bucket)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_./:-]{3,}"""
)
_IDENTIFIER = re.compile(
    r"""(?ai)\b(?:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|app_?id|access_?key(?:_?id)?|key_?id|tenant(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]{3,})"""
)
_IDENTIFIER_WORDS = ("user", "login", "account", "client", "app", "key", "tenant")
_RANDOM = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % RANDOM_LENGTH)
_LABELLED = re.compile(r"""(?ai)\b(?:pwd|pass(?:phrase|word)?|auth|credentials?|private_?key|signature)["']?\x20*[:=]\x20*["']?([^\x00-\x20"'<>]{6,})""")
_SCOPE = re.compile(r"\n[\x20\t\r]*\n|\n(?=\[[^\]\n]+\][\x20\t\r]*(?:\n|\Z))")


class Span(NamedTuple):
    start: int
    order: int
    end: int

    @property
    def kind(self) -> str:
        return KINDS[self.order]

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


class Found(NamedTuple):
    """Spans of a text, and its credentials: (identifier, secret, endpoint if any)."""

    base: list[Span]
    spans: list[Span]
    credentials: list[tuple[Span, Span, Span | None]]


def strong_spans(text: str) -> list[Span]:
    """Assignments, access key ids and long hexadecimal numbers, per kind leftmost and without overlap."""
    lower = text.lower()
    found = []
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [Span(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= _ACCESS_LENGTH]
    # A run of hexadecimal digits is taken whole, so its length can stand in the pattern.
    found += [Span(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def looks_random(run: str) -> bool:
    """Letters of both cases or letters and digits, mixed as by chance."""
    classes = sum(any(test(c) for c in run) for test in (str.islower, str.isupper, str.isdigit))
    if classes < 2 or not any(c.isdigit() for c in run):
        return False
    shares = [n / len(run) for n in Counter(run).values()]
    return -sum(p * math.log2(p) for p in shares) >= RANDOM_BITS


def _free(found: list[Span], taken: list[Span]) -> list[Span]:
    """Those that overlap none of ``taken``."""
    if not taken:
        return found
    touch = Reach(taken)
    return [span for span in found if not touch.meets(span.start + 1, span.end - 1)]


def weak_spans(text: str, strong: list[Span]) -> list[Span]:
    """Endpoints, labelled identifiers and random-looking or labelled secrets beside the strong spans."""
    lower = text.lower()
    named = [Span(m.start(), 4, m.end()) for m in _IDENTIFIER.finditer(text)] if any(word in lower for word in _IDENTIFIER_WORDS) else []
    if not named and not any(span.kind in IDENTIFIERS for span in strong):
        return []  # whatever is weak here needs an identifier
    taken = list(strong)
    ends = _free([Span(m.start(), 3, m.end()) for m in _ENDPOINT.finditer(text)], taken)
    taken = sorted(taken + ends)
    named = _free(named, taken)
    taken = sorted(taken + named)
    runs = [Span(m.start(), 5, m.end()) for m in _LABELLED.finditer(text)]
    runs = sorted(runs + _free([Span(m.start(), 5, m.end()) for m in _RANDOM.finditer(text) if looks_random(m[0])], sorted(runs)))
    return sorted(ends + named + _free(runs, taken))


class Reach:
    """Sorted intervals that are asked whether one of them meets another interval."""

    def __init__(self, spans: list[Span]) -> None:
        self.spans = spans
        self.starts = np.array([span.start for span in spans], dtype=np.int64)
        ends = np.array([span.end for span in spans], dtype=np.int64)
        self.furthest = np.maximum.accumulate(ends) if len(spans) else ends

    def meets(self, low: int, high: int) -> bool:
        """Does an interval begin at or before ``high`` and end at or behind ``low``?"""
        upto = int(np.searchsorted(self.starts, high, "right"))
        return upto > 0 and int(self.furthest[upto - 1]) >= low

    def nearest(self, span: Span, low: int, high: int) -> Span | None:
        """The interval in ``low`` to ``high`` with the smallest gap to ``span``; of two the earlier one."""
        at = int(np.searchsorted(self.starts, span.start, "left"))
        # Spans of one sort hardly overlap: the neighbours on both sides are the nearest ones.
        near = [s for s in self.spans[max(0, at - 1) : at + 2] if s.start <= high and s.end >= low and s != span]
        return min(near, key=lambda s: (max(s.start - span.end, span.start - s.end, 0), s), default=None)


def link(text: str, strong: list[Span], weak: list[Span], reach: int = REACH) -> Found:
    """Join the parts of a text by their reach within scopes."""
    every = sorted(strong + weak)
    bounds = np.array([0, *[m.end() for m in _SCOPE.finditer(text)], len(text) + 1], dtype=np.int64) if every else np.zeros(1, np.int64)

    def around(span: Span) -> tuple[int, int]:
        at = int(np.searchsorted(bounds, span.start, "right"))
        return max(int(bounds[at - 1]), span.start - reach), min(int(bounds[at]) - 1, span.end + reach)

    area = {span: around(span) for span in every}
    endpoints = Reach([s for s in weak if s.kind == "endpoint"])
    at_end = {span for span in every if span.kind != "endpoint" and endpoints.meets(*area[span])}

    def linked(own: tuple[str, ...], other: tuple[str, ...]) -> set[Span]:
        """Parts of one sort that are linked with a part of the other sort."""
        partners = [s for s in every if s.kind in other]
        sure = Reach([s for s in partners if s.kind in STRONG or s in at_end])
        any_ = Reach(partners)
        # A strong part, or one in touch with an endpoint, needs any partner; another one needs such a partner.
        return {s for s in every if s.kind in own and (any_ if s.kind in STRONG or s in at_end else sure).meets(*area[s])}

    identifiers, secrets = linked(IDENTIFIERS, SECRETS), linked(SECRETS, IDENTIFIERS)
    told = [s for s in every if s.kind in STRONG or s in identifiers or s in secrets]
    by_id, by_secret = Reach(sorted(identifiers)), Reach(sorted(secrets))
    ends = [s for s in endpoints.spans if by_id.meets(*area[s]) and by_secret.meets(*area[s])]
    used = Reach(ends)
    credentials = []
    for secret in sorted(secrets):
        owner = by_id.nearest(secret, *area[secret])
        if owner is not None:
            credentials.append((owner, secret, used.nearest(secret, *area[secret])))
    return Found(strong, sorted(told + ends), credentials)


def find(text: str | None, reach: int = REACH) -> Found:
    text = text or ""
    strong = strong_spans(text)
    return link(text, strong, weak_spans(text, strong), reach)


_SPAN = "struct<kind: string, start: long, stop: long>"
SCANNED = f"doc_id string, base array<{_SPAN}>, spans array<{_SPAN}>, credentials array<struct<identifier: {_SPAN}, secret: {_SPAN}, endpoint: {_SPAN}>>"


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, ``base`` (the strong spans), ``spans`` (all reported ones) and ``credentials`` (linked parts)."""

    def plain(span: Span | None):
        return None if span is None else {"kind": span.kind, "start": span.start, "stop": span.end}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [find(text, reach) for text in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].array,
                "base": [[plain(s) for s in f.base] for f in found],
                "spans": [[plain(s) for s in f.spans] for f in found],
                "credentials": [[{"identifier": plain(i), "secret": plain(s), "endpoint": plain(e)} for i, s, e in f.credentials] for f in found],
            })

    # Ids go as text: beside nulls pandas would make them floats.
    done = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(rows, SCANNED)
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the strong spans, their hash, and all spans as text."""
    written = lambda name: F.array_join(F.transform(name, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select("doc_id", *[count(kind) for kind in STRONG], F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))
