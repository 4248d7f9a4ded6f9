"""Personal data by anchor expansion.

An Aho-Corasick automaton walks over a text once and reports anchors: at-signs, plus signs,
digits, ``://`` and cues that announce an identifier. From an anchor a local parser extends the
match to the left and right and validates it. No other part of the text is looked at twice.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import others, small

BASE = ("email", "ip", "card", "phone")
# Added by this operator, after the base kinds: user data in an address, values announced by a
# cue, access keys of a known shape.
ADDED = ("login", "account", "key")
KINDS = BASE + ADDED

# The cues, each also in capitals and with a capital first letter.
CUES = ("iban", "account", "acct", "konto", "ssn", "password", "passwd", "passport")
KEY_PREFIX = "AKIA"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_REST = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN_REST = re.compile(r"[^\x00-\x20/@]+@[A-Za-z0-9.-]+")
_VALUE = re.compile(r"\x20?[:=#]\x20?([A-Za-z0-9-]+)")
_KEY = re.compile(r"[A-Z0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DIGIT_CHARS = frozenset("0123456789")

Span = tuple[int, int]


def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for text, kind in [("@", "@"), ("+", "+"), ("://", ":"), (KEY_PREFIX, "K"), *((d, "0") for d in "0123456789")]:
        automaton.add_word(text, (kind, len(text)))
    for cue in CUES:
        for text in {cue, cue.upper(), cue.capitalize()}:
            automaton.add_word(text, ("C", len(text)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban(value: str) -> bool:
    """Whether the check digits of an international account number hold."""
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _reach(text: str, at: int, least: int, allowed: frozenset) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def find_spans(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[Span]]:
    """Spans per kind in code points, end exclusive, in order of their start.

    Matches of one kind never overlap: ``done`` holds the end of the last match of each kind,
    those that failed their check included.
    """
    spans: dict[str, list[Span]] = {}
    done = dict.fromkeys(KINDS, 0)

    def keep(kind: str, begin: int, end: int, good: bool) -> None:
        done[kind] = end
        if good:
            spans.setdefault(kind, []).append((begin, end))

    for last, (kind, size) in automaton.iter(text):
        at = last + 1 - size
        if kind == "0":
            if at >= done["card"] and (m := _DIGITS.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                keep("card", at, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
            if at and text[at - 1] == ".":
                begin = _reach(text, at - 1, done["ip"], _DIGIT_CHARS)
                if begin < at - 1 and (m := _IP_REST.match(text, at)):
                    parts = text[begin : m.end()].split(".")
                    keep("ip", begin, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts))
        elif kind == "@":
            begin = _reach(text, at, done["email"], _LOCAL_CHARS)
            if begin < at and (m := _DOMAIN.match(text, at + 1)):
                keep("email", begin, m.end(), True)
        elif kind == "+":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                keep("phone", at, m.end(), 9 <= sum(c in _DIGIT_CHARS for c in m[0]) <= 15)
        elif kind == ":":
            begin = _reach(text, at, done["login"], _SCHEME_CHARS)
            if begin < at and (m := _LOGIN_REST.match(text, at + 3)):
                keep("login", begin, m.end(), True)
        elif kind == "C":
            if at >= done["account"] and (m := _VALUE.match(text, last + 1)):
                value = m[1]
                checked = iban(value) if text[at : last + 1].lower() == "iban" else 6 <= len(value) <= 34 and any(c in _DIGIT_CHARS for c in value)
                keep("account", m.start(1), m.end(1), checked)
        elif at >= done["key"]:
            m = _KEY.match(text, at)
            keep("key", at, m.end(), m.end() - at == 20)
    return spans


def listed(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind in kinds for begin, end in spans.get(kind, ()))


def redacted(text: str, spans: dict[str, list[Span]]) -> str:
    """``text`` with every span, or union of overlapping spans, replaced by its kind."""
    out, at = [], 0
    for begin, end, kind in sorted((b, e, k) for k, own in spans.items() for b, e in own):
        if begin >= at:
            out += [text[at:begin], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_RESULT = [("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"),
           ("base_sha256", "string"), ("spans", "string"), ("redacted", "string")]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with counts of the base kinds, a digest of the base spans, all spans, and the
    redacted text.

    ``redacted`` is null where nothing was found. A null text is empty and has no spans.
    Columns of these names are replaced, all others stay. Rows are independent of each other,
    so null or repeated ids and an empty table need no rule.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = docs.select(*others(docs, *(name for name, _ in _RESULT)))
    extra = docs.sparkSession.createDataFrame([], ", ".join(f"{n} {t}" for n, t in _RESULT)).schema
    arrow = to_arrow_schema(extra)
    place = next(i for i, c in enumerate(kept.columns) if c.lower() == "text")

    def run(batches):
        automaton = anchors()
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in small(batches):
            rows = []
            for text in batch.column(place).to_pylist():
                spans = find_spans(text, automaton) if text else {}
                if not spans:
                    rows.append((0, 0, 0, 0, nothing, "", None))
                    continue
                digest = hashlib.sha256(listed(spans, BASE).encode()).hexdigest()
                rows.append((*(len(spans.get(k, ())) for k in BASE), digest, listed(spans, KINDS), redacted(text, spans)))
            columns = zip(*rows) if rows else [()] * len(arrow)
            made = [pa.array(v, f.type) for v, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *arrow.names])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *extra.fields]))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every piece of personal data replaced by its kind."""
    found = find_personal_data(docs)
    return found.withColumn("text", F.coalesce("redacted", "text")).select(*others(docs, *(name for name, _ in _RESULT)))
