"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Every pattern runs over the whole text in time linear in its length (no
nested backtracking), so very long texts and words are safe.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kinds in the order of the result; the first four are the base kinds
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double,confirmed:boolean>>"
_ARROW_SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
         ("confirmed", pa.bool_())]
    )
)

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
WORD = re.compile(r"[a-z]+")

# Length of an IBAN by country (SWIFT IBAN registry).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}
# Score of a bare match, and the words nearby that raise or lower it.
BASE_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
RAISING = {
    "email": {"email", "mail", "contact", "write", "e"},
    "ip": {"ip", "address", "host", "server", "login", "from"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "pay"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "whatsapp"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "taxpayer", "tin"},
}
LOWERING = {
    "ip": {"version", "release", "build", "section", "chapter"},
    "card": {"isbn", "order", "tracking", "serial", "invoice"},
    "phone": {"isbn", "fax"},
}
CONTEXT_CHARS = 40
CONTEXT_STEP = 0.2
#: spans of the added kinds need this score; base spans always stay
ADDED_MIN_SCORE = 0.5


def luhn(digits: str) -> bool:
    """Whether the digit string passes the Luhn check."""

    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether a compact IBAN leaves remainder 1 (ISO 13616)."""

    moved = iban[4:] + iban[:4]
    return int("".join(str(int(ch, 36)) for ch in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            floor = m.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def _octets_fit(match: str) -> bool:
    parts = [p.lstrip("0") for p in match.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _digits(match: str) -> str:
    return "".join(ch for ch in match if "0" <= ch <= "9")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Valid IBANs, not overlapping: a start that fails leaves all later ones to be tried."""

    at = 0
    while m := IBAN.search(text, at):
        length = IBAN_LENGTHS.get(m.group()[:2])
        ends = [i + 1 for i, ch in enumerate(m.group()) if ch != " "]
        at = m.start() + 1
        if length is None or len(ends) < length:
            continue
        end = m.start() + ends[length - 1]
        follows = text[end : end + 1]
        if not follows.isalnum() and mod97(text[m.start() : end].replace(" ", "")):
            yield m.start(), end
            at = end


def _proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a checksum), by kind, then start."""

    if "@" in text:
        for s, e in _emails(text):
            yield "email", s, e, False
    for m in IP.finditer(text):
        if _octets_fit(m.group()):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                yield "phone", m.start(), m.end(), False
    for s, e in _ibans(text):
        yield "iban", s, e, True
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end(), False


def find_spans(text: str | None) -> list[dict]:
    """All spans of one text (null: none), by kind as in KINDS, then start; code points, end exclusive."""

    spans = []
    for kind, start, end, confirmed in _proposals(text or ""):
        near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
        words = set(WORD.findall(near.lower()))
        score = BASE_SCORE[kind]
        if words & RAISING[kind]:
            score += CONTEXT_STEP
        if words & LOWERING.get(kind, set()):
            score -= CONTEXT_STEP
        if kind in BASE_KINDS or score >= ADDED_MIN_SCORE:
            spans.append({"kind": kind, "start": start, "end": end, "score": round(min(score, 1.0), 3),
                          "confirmed": confirmed})
    return spans


def pii_spans(text: Column | str) -> Column:
    """Array of spans (kind, start, end, score, confirmed) of a text column; null and empty texts give an empty array."""

    @F.arrow_udf(SPAN_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array((find_spans(t.as_py()) for t in texts), type=_ARROW_SPANS)

    return spans(text)


def redact(docs: DataFrame, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """Replace every span of at least ``min_score`` by ``<KIND>``; all other columns stay as they are.

    Null texts stay null. Overlapping spans are merged under the first one's kind.
    """

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        out = []
        for item in texts:
            t = item.as_py()
            if t is None:
                out.append(None)
                continue
            parts, at = [], 0
            for s in sorted(find_spans(t), key=lambda s: (s["start"], -s["end"])):
                if s["score"] >= min_score and s["end"] > at:
                    if s["start"] >= at:
                        parts += [t[at : s["start"]], f"<{s['kind'].upper()}>"]
                    at = s["end"]
            out.append("".join([*parts, t[at:]]))
        return pa.array(out, type=pa.string())

    return docs.withColumn(text, cleaned(text))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans.

    Repeated rows give repeated rows; an empty table gives an empty result;
    other columns of ``docs`` are not read.
    """

    found = docs.select(F.col(doc_id).alias("doc_id"), pii_spans(F.col(text)).alias("found"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
