"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds the anchors: at-signs, plus signs, digits, schemes and words that
announce an identifier. From each anchor a small parser goes left and right as far as its kind of value can reach and
validates what it finds. Text without anchors is not looked at again.

Base kinds are email, ip, card and phone: leftmost matches of their patterns, not overlapping within a kind; a match that
fails its test is dropped as a whole. Added by the method: ``iban`` (check digits), ``ssn`` and ``account`` after a word
that announces them, ``login`` (user and password in a URL). Places are in code points, the end exclusive.

A NULL or empty text has no spans. Repeated rows give repeated rows, NULL ids and further columns do not matter, an empty
table gives an empty result. Every text is scanned whole; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts_for_python

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "account", "login")

# Words that announce an identifier, and the kind of identifier.
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security": "ssn",
    "account": "account",
    "acct": "account",
    "passport": "account",
    "customer id": "account",
    "user id": "account",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_SPACED = re.compile(r"[0-9 -]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LEAD = r"(?: ?(?:number|no\.?|nr\.?|#))? ?[:#=]? ?"
_AFTER_CUE = {
    "iban": re.compile(_LEAD + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", re.I),
    "ssn": re.compile(_LEAD + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])", re.I),
    "account": re.compile(_LEAD + r"([A-Z]{0,3}[0-9]{6,17})(?![A-Za-z0-9])", re.I),
}
_SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+(?::[A-Za-z0-9._~%!$&'()*+,;=:-]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    plain = value.replace(" ", "").upper()
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(ch, 36)) for ch in moved)) % 97 == 1


def ssn_valid(value: str) -> bool:
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def anchor_automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for sign in "@+0123456789":
        automaton.add_word(sign, ("digit" if sign.isdigit() else sign, 1))
    automaton.add_word("://", ("://", 3))
    for cue, kind in CUES.items():
        for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
            automaton.add_word(form, (kind, len(form)))
    automaton.make_automaton()
    return automaton


def find_spans(text: str, automaton) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by kind and then by start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    reached = dict.fromkeys(KINDS, 0)  # how far the parser of each kind has consumed the text
    for last, (kind, length) in automaton.iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= reached["ip"]:
                reached["ip"] = end = _DOTTED.match(text, at).end()
                if end - at >= 7:
                    for match in _IP.finditer(text, at, end):
                        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                            found["ip"].append(match.span())
            if at >= reached["card"]:
                reached["card"] = end = _SPACED.match(text, at).end()
                if end - at >= 13:
                    for match in _CARD.finditer(text, at, end):
                        digits = match[0].replace(" ", "").replace("-", "")
                        if 13 <= len(digits) <= 19 and luhn(digits):
                            found["card"].append(match.span())
        elif kind == "@":
            start, floor = at, reached["email"]
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1)
            if match and start < at:
                found["email"].append((start, match.end()))
                reached["email"] = match.end()
        elif kind == "+":
            if at >= reached["phone"] and (match := _PHONE.match(text, at)):
                reached["phone"] = match.end()
                if 9 <= sum(ch.isdigit() for ch in match[0]) <= 15:
                    found["phone"].append(match.span())
        elif kind == "://":
            start = at
            while start > reached["login"] and text[start - 1] in _SCHEME_CHARS:
                start -= 1
            match = _USERINFO.match(text, at + 3)
            if match and start < at:
                found["login"].append((start, match.end()))
                reached["login"] = match.end()
        elif last + 1 >= reached[kind]:
            match = _AFTER_CUE[kind].match(text, last + 1)
            if match and (at == 0 or not text[at - 1].isalnum()):
                value = match[1]
                if (kind == "iban" and iban_valid(value)) or (kind == "ssn" and ssn_valid(value)) or kind == "account":
                    found[kind].append(match.span(1))
                    reached[kind] = match.end()
    return [(kind, start, end) for kind in KINDS for start, end in sorted(found[kind])]


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the outer or earlier one counts."""
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of the base spans, all spans, number of spans the method adds."""

    def scan(batches):
        automaton = anchor_automaton()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                spans = find_spans(value.as_py() or "", automaton)
                base = [span for span in spans if span[0] in BASE_KINDS]
                counts = [sum(span[0] == kind for span in base) for kind in BASE_KINDS]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*counts, digest, _joined(spans), len(spans) - len(base)))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], NAMES)

    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    kinds = ["long"] * 4 + ["string"] * 2 + ["long"]
    NAMES = ["doc_id", *names]
    id_kind = documents.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_kind}", *[f"{name} {kind}" for name, kind in zip(names, kinds)]])
    return texts_for_python(documents.select("doc_id", "text")).mapInArrow(scan, schema)


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in square brackets; all columns stay."""
    place = documents.columns.index("text")

    def replace(batches):
        automaton = anchor_automaton()
        for batch in batches:
            texts = [None if (text := value.as_py()) is None else redact(text, find_spans(text, automaton)) for value in batch.column(place)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return texts_for_python(documents).mapInArrow(replace, documents.schema)
