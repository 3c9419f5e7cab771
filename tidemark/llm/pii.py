"""Personal data: an Aho-Corasick pass finds anchors, local parsers expand and validate them.

Anchors are at-signs, digits, plus signs, ``://`` and identifier cues (``token``, ``iban``, ...). Each
kind has a parser that works on the characters around its anchor only:

* ``email``, ``ip``, ``card`` and ``phone``: the leftmost non-overlapping matches of the kind's pattern over the
  whole text, less those that fail the kind's test (parts up to 255; 12 to 19 digits and Luhn; 9 to 15 digits).
* ``url``: a scheme with user information in it (``scheme://user:secret@host``).
* ``account``: the value after a cue, at least 8 letters, digits, ``-`` or ``_`` with 3 digits among them.

Offsets are code points, the end exclusive. A null text is empty and has no span; repeated rows get equal
results, one per row. A run of characters is walked a bounded number of times per kind: an address begins where a run of digits
begins, and a value is walked only where it does not follow its cue at once, so long texts take linear time.
"""

from __future__ import annotations

import re
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import annotate, unused

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
CUES = ("token", "account", "acct", "iban", "ssn", "passport", "password", "passwd", "secret", "api_key", "apikey", "license_key")
RANK = {kind: i for i, kind in enumerate(KINDS)}

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_RUN = re.compile(r"[0-9.]+")
# from within a run of digits a match would be the rest of one from its beginning
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD_RUN = re.compile(r"[0-9 -]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_USERINFO = re.compile(r"://[^\s/?#@\"'<>]+@(?=[^\s\"'<>])")
_REST = re.compile(r"[^\s\"'<>]+")
_LEAD = re.compile(r"[\"']?(?:\s{0,3}(?:number|no\.?|id|is)\b)?\s{0,3}[:=#]?\s{0,3}[\"']?(?=[A-Za-z0-9_-]{8})")
_VALUE = re.compile(r"[A-Za-z0-9_-]+")


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("cue", len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find(text: str) -> list[Span]:
    """All spans, by start, then kind."""
    spans: list[Span] = []
    email_end = ip_end = card_end = url_end = 0
    for last, (anchor, width) in _automaton().iter(text):
        at = last - width + 1
        if anchor == "digit":
            if at >= ip_end:
                ip_end = _IP_RUN.match(text, at).end()
                for m in _IP.finditer(text, at, ip_end):
                    if all(map(_small, m.group().split("."))):
                        spans.append(("ip", m.start(), m.end()))
            if at >= card_end:
                card_end = _CARD_RUN.match(text, at).end()
                for m in _CARD.finditer(text, at, card_end):
                    number = _digits(m.group())
                    if 12 <= len(number) <= 19 and luhn(number):
                        spans.append(("card", m.start(), m.end()))
        elif anchor == "at":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email_end = m.end()
                spans.append(("email", start, email_end))
        elif anchor == "plus":
            if (m := _PHONE.match(text, at)) and 9 <= len(_digits(m.group())) <= 15:
                spans.append(("phone", at, m.end()))
        elif anchor == "scheme":
            start = at
            while start and at - start < 32 and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (m := _USERINFO.match(text, at)):
                if m.end() >= url_end:  # else within the rest of the last one, which ends where this one does
                    url_end = _REST.match(text, m.end()).end()
                spans.append(("url", start, url_end))
        elif not (at and text[at - 1].isalnum()):
            lead = _LEAD.match(text, last + 1)
            if lead and lead.end() > last + 1:
                m = _VALUE.match(text, lead.end())
                if sum("0" <= c <= "9" for c in m.group()) >= 3:
                    spans.append(("account", m.start(), m.end()))
    spans.sort(key=lambda s: (s[1], RANK[s[0]]))
    return spans


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the name of the first one's kind."""
    out, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"<{kind.upper()}>"]
        done = end
    return "".join([*out, text[done:]])


def texts_of(piece: pa.RecordBatch, text: str = "text") -> list[str]:
    return [x.decode("utf-8", "replace") for x in W.text_column(piece, text).cast(pa.binary()).to_pylist()]


def detect(docs: DataFrame, into: str = "pii") -> DataFrame:
    """docs with a struct column: spans as an array, counts of the base kinds, and the two digests."""

    def compute(piece: pa.RecordBatch) -> list:
        found = [find(x) for x in texts_of(piece)]
        counts = [[sum(s[0] == kind for s in spans) for spans in found] for kind in BASE]
        base = [sha256(listed([s for s in spans if s[0] in BASE]).encode()).hexdigest() for spans in found]
        return [*(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(map(listed, found), pa.string())]

    fields = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return annotate(docs, compute, fields, into)


def masked(docs: DataFrame, into: str = "masked") -> DataFrame:
    """docs with a struct column of the masked text, its code points and the number of spans."""

    def compute(piece: pa.RecordBatch) -> list:
        texts = texts_of(piece)
        found = [find(x) for x in texts]
        new = [mask(x, spans) if spans else x for x, spans in zip(texts, found, strict=True)]
        return [pa.array(new, pa.string()), pa.array(map(len, new), pa.int64()), pa.array(map(len, found), pa.int64())]

    return annotate(docs, compute, "text string, n_chars long, n_spans long", into)


def op8(spark, sf_dir: str) -> DataFrame:
    """Counts and spans of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return detect(docs, "p").select("doc_id", "p.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their personal data masked; texts without any stay as they are, null too."""
    name = unused(docs, "masked")
    changed = F.col(name)["n_spans"] > 0
    new = {"text": F.when(changed, F.col(name)["text"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        old = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.col(name)["n_chars"].cast(old)).otherwise(F.col("n_chars"))
    return masked(docs, name).withColumns(new).select(*docs.columns)
