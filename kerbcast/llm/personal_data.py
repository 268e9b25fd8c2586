"""Personal data: regular expressions propose spans, checksums confirm them, words nearby move the score.

Four base kinds follow fixed rules and are always reported: email, ip, card, phone. The method adds spans of
further kinds whose score reaches the threshold: bank account numbers (only those that meet mod-97), social
security numbers (only those that can have been given out), local telephone numbers and keys of fixed form. Every pattern works on the whole text in time proportional to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from kerbcast.llm.common import slices, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone", "secret")
KINDS = BASE_KINDS + ADDED_KINDS
THRESHOLD = 0.75
#: Code points before and after a span that are searched for context words.
REACH = 40

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match never starts inside a run of digits: from its start the same text would follow.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# No area 000, 666 or 900 and above, no group 00, no serial 0000.
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ /-])[0-9]{3,4}[ -]?[0-9]{3,5}"
                         r"|[2-9][0-9]{2}([ .-])[0-9]{3}\1[0-9]{4})(?![0-9.-])")
# Forms of access keys, tokens and private keys.
SECRET = re.compile(r"(?<![A-Za-z0-9_])(?:AKIA[A-Z0-9]{16}|gh[opusr]_[A-Za-z0-9]{36})(?![A-Za-z0-9_])"
                    r"|-----BEGIN (?:[A-Z]{2,9} ){0,2}PRIVATE KEY-----")
# Every secret holds one of these, which are found faster than the pattern.
SECRET_PARTS = ("AKIA", "gho_", "ghp_", "ghu_", "ghs_", "ghr_", "PRIVATE KEY-----")

#: Context words by kind (English, French, German, Spanish), lower case.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "courriel", "correo", "contact"),
    "ip": ("ip", "address", "host", "server", "adresse", "dirección"),
    "card": ("card", "credit", "visa", "mastercard", "carte", "karte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "téléphone", "telefon", "teléfono"),
    "iban": ("iban", "account", "bank", "compte", "konto", "cuenta", "bic"),
    "ssn": ("ssn", "social", "security", "sécurité", "seguro"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "téléphone", "telefon", "teléfono"),
    "secret": ("key", "token", "secret", "password", "clé", "schlüssel", "clave"),
}
#: Score of a proposed span before checksum and context.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.7, "iban": 0.5, "ssn": 0.5, "local_phone": 0.4, "secret": 0.9}
CHECKSUM_GAIN, CONTEXT_GAIN = 0.3, 0.4
#: Kinds whose spans have all met a checksum.
CHECKED = ("card", "iban")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (2 if place % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, ``@`` and dotted domain. Each match holds exactly one
    ``@``, so it is found by looking left and right of every one; the left limit is the last match."""
    limit, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > limit and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            limit = found.end()
        else:
            limit = at + 1
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds in the order of kinds, then of starts."""
    out = [("email", s, e) for s, e in emails(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def near(text: str, start: int, end: int, kind: str) -> bool:
    """Whether a context word of the kind stands close to the span."""
    around = f"{text[max(0, start - REACH):start]} {text[end:end + REACH]}".lower()
    return not set(re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", around)).isdisjoint(CONTEXT[kind])


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost strings built like an IBAN that meet mod-97, at most 34 characters without spaces. Words in
    capitals behind a number look like more of it, so a match is cut at its spaces from the right until it meets
    the checksum; if none does, the search goes on behind its first character."""
    found = IBAN.search(text)
    while found:
        start, end = found.span()
        while end > start:
            cut = text[start:end]
            if IBAN.fullmatch(cut) and len(cut.replace(" ", "")) <= 34 and mod97(cut):
                break
            end = text.rfind(" ", start, end)
        if end > start:
            yield start, end
        found = IBAN.search(text, max(end, start + 1))


def score(text: str, kind: str, start: int, end: int) -> float:
    checked = kind in CHECKED
    return min(1.0, PRIOR[kind] + CHECKSUM_GAIN * checked + CONTEXT_GAIN * near(text, start, end, kind))


def all_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """Base spans, then the added ones that reach the threshold; those that no checksum confirms must not overlap
    a base span."""
    keyed = any(part in text for part in SECRET_PARTS)
    if not keyed and not any(c in text for c in "@0123456789"):
        return []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    out = [(k, s, e, score(text, k, s, e)) for k, s, e in base]
    added = [("iban", s, e) for s, e in ibans(text)]
    patterns = [("ssn", SSN), ("local_phone", LOCAL_PHONE)] + [("secret", SECRET)] * keyed
    added += [(kind, *m.span()) for kind, pattern in patterns for m in pattern.finditer(text)]
    for kind, s, e in added:
        value = score(text, kind, s, e)
        if value >= threshold and (kind in CHECKED or not any(a < e and s < b for a, b in taken)):
            out.append((kind, s, e, value))
    return out


def masked_text(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    merged: list[list] = []
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    parts, last = [], 0
    for kind, start, end in merged:
        parts += [text[last:start], f"[{kind.upper()}]"]
        last = end
    return "".join([*parts, text[last:]])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Spans of personal data in every whole text.

    ``docs``: ``doc_id``, ``text``; other columns are ignored. Result, one row per input row, repeated rows
    included: ``doc_id`` and ``spans``, an array of kind, start, end (code points, end exclusive) and score, by
    kind as in ``KINDS``, then by start. A null or empty text has no spans; a null ``doc_id`` stays null; an
    empty table gives an empty result. Equal spans of different kinds are all listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [[dict(zip(("kind", "start", "end", "score"), x)) for x in all_spans(t, threshold)]
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(SPAN))],
                                             ["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>")


def without_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all its rows and columns, every span in ``text`` replaced by its kind in brackets. A null
    text stays null. Columns other than ``text`` pass through unchanged, whatever their names."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [None if t is None else masked_text(t, all_spans(t, threshold))
                     for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
