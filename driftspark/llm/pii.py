"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in the whole text in one pass: at-signs, plus
signs, digits, scheme separators and the cue words of accounts. At each anchor a small
deterministic parser expands to the borders of what could stand there and validates it.

Base kinds (each leftmost and without overlap inside its kind): email, ip, card, phone.
Further kinds: ``login`` (a user or password in front of the host of a URL), ``account``
(a cue word and the number after it), ``iban`` (a cue word and a number that passes the
mod-97 check).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("login", "iban", "account")

# Characters and shapes of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = frozenset("0123456789")

# Cue words of account numbers.
CUES = ("account", "acct", "iban", "ssn", "passport", "customer id", "user id", "konto", "cuenta", "compte")
ACCOUNT = re.compile(r"(?: (?:no|nr|number|num|id))?\.?[ ]?[:=#]?[ ]?#?([A-Za-z]{0,3}[0-9][A-Za-z0-9-]{5,30})")
IBAN = re.compile(r"[ ]?[:=]?[ ]?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
LOGIN = re.compile(r"[^\s/?#@\"'<>]+@[A-Za-z0-9.-]+")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid_iban(number: str) -> bool:
    plain = number.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for mark in ("@", "+", "://", *DIGITS):
        found.add_word(mark, (mark, len(mark)))
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.upper()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def _email(text: str, at: int, after: int) -> tuple[int, int] | None:
    """The address around an at-sign; its local part begins at ``after`` or later."""
    start = at
    while start > after and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    domain = DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain else None


def _account(text: str, start: int, end: int) -> tuple[str, int, int] | None:
    """The number after a cue word."""
    if start and text[start - 1].isalnum():
        return None
    iban = IBAN.match(text, end)
    if iban and valid_iban(iban[1]):
        return "iban", iban.start(1), iban.end(1)
    number = ACCOUNT.match(text, end)
    if number and sum(c in DIGITS for c in number[1]) >= 6:
        return "account", number.start(1), number.end(1)
    return None


def find_spans(text: str, automaton) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then by kind as listed; ends are exclusive."""
    spans = []
    upto = dict.fromkeys((*KINDS, *MORE_KINDS), 0)  # a kind's next match starts there or later
    digits_upto = 0  # end of the run of digits that was parsed last
    for last, (mark, size) in automaton.iter(text):
        start = last + 1 - size
        if mark == "@":
            found = _email(text, start, upto["email"])
            if found:
                spans.append(("email", *found))
                upto["email"] = found[1]
        elif mark == "+":
            match = PHONE.match(text, start) if start >= upto["phone"] else None
            if match:
                upto["phone"] = match.end()
                if 9 <= sum(c in DIGITS for c in match[0]) <= 15:
                    spans.append(("phone", start, match.end()))
        elif mark == "://":
            match = LOGIN.match(text, last + 1) if start >= upto["login"] else None
            if match:
                spans.append(("login", last + 1, match.end()))
                upto["login"] = match.end()
        elif mark == "cue":
            found = _account(text, start, last + 1) if start >= upto["account"] else None
            if found:
                spans.append(found)
                upto["account"] = found[2]
        elif start >= digits_upto:  # the first digit of a run
            if start >= upto["ip"]:
                match = IP.match(text, start)
                if match:
                    upto["ip"] = match.end()
                    if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in match[0].split(".")):
                        spans.append(("ip", start, match.end()))
            if start >= upto["card"]:
                match = CARD.match(text, start)
                if match:
                    upto["card"] = match.end()
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append(("card", start, match.end()))
            digits_upto = start + 1
            while digits_upto < len(text) and text[digits_upto] in DIGITS:
                digits_upto += 1
    order = {k: i for i, k in enumerate((*KINDS, *MORE_KINDS))}
    return sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) for each row: kind, start and exclusive end in code points.

    Null and empty texts have no spans. Repeated rows stay; other columns are left out.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for chunk in chunks(batch, "text"):
                found = [
                    [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t.as_py() or "", automaton)]
                    for t in chunk.column("text")
                ]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {id_type}, spans {SPANS}")


def joined(spans: str) -> str:
    """SQL text: ``kind:start:end`` of each span, comma-joined."""
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def op7_pii(spark, sf_dir: str) -> DataFrame:
    found = with_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = "filter(spans, s -> s.kind IN ('email', 'ip', 'card', 'phone'))"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(joined(base)), 256).alias("base_sha256"),
        F.expr(joined("spans")).alias("spans"),
    )
