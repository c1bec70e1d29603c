"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

Texts pass through Arrow batches to a small matcher, a text at a time; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base kinds in their order, then those that only the method finds.
KINDS = ("email", "ip", "card", "phone")
FURTHER = ("iban", "card_near", "phone_near", "ssn")
#: A span that the method adds needs this score.
ACCEPT = 0.7
BEFORE, AFTER = 48, 16
CONTEXT = {
    "card_near": ("card", "visa", "credit", "debit", "mastercard", "karte", "carte", "tarjeta", "payment"),
    "phone_near": ("phone", "call", "tel", "fax", "mobile", "telefon", "telefono", "contact", "whatsapp", "cell"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social-security"),
}
#: Context words count as whole words, in the singular or plural.
_CONTEXT = {kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, said)) + r")s?(?!\w)") for kind, said in CONTEXT.items()}
#: Score of a kind as proposed, and what a passed checksum adds; a context word adds CONTEXT_GAIN.
PROPOSED = {"email": 0.8, "ip": 0.7, "card": 0.5, "phone": 0.7, "iban": 0.4, "card_near": 0.2, "phone_near": 0.5, "ssn": 0.5}
CHECKED = {"card": 0.4, "iban": 0.5, "card_near": 0.4, "ip": 0.1}
CONTEXT_GAIN = 0.25

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match opens a run of digits: no use in trying further in, which would take the square of a long run's length.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9]+")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(_GROUP.findall(s))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost longest, without overlap: from each @ back over the characters of a local part, then on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The base spans by kind, then start; a proposed match whose check fails is dropped."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b, 0.0) for a, b in emails(text)]
    if _GROUP.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
                out.append(("ip", m.start(), m.end(), 0.0))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end(), 0.0))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end(), 0.0))
    return out


def _windows(groups: list[tuple[int, int]], text: str, least: int, most: int, good: Callable[[str], bool]) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring digit groups with ``least`` to ``most`` digits that are good: leftmost, then longest."""
    i = 0
    while i < len(groups):
        found = None
        size, digits = 0, []
        for j in range(i, len(groups)):
            size += groups[j][1] - groups[j][0]
            if size > most:
                break
            digits.append(text[groups[j][0] : groups[j][1]])
            if size >= least and good("".join(digits)):
                found = j
        if found is None:
            i += 1
        else:
            yield groups[i][0], groups[found][1]
            i = found + 1


def further_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """What the method proposes beside the base, checksums passed: card and phone numbers inside longer runs of digits,
    shorter cards, account numbers, national numbers."""
    if not _GROUP.search(text):
        return
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if len(d) >= 13 and not (16 <= len(d) <= 19 and luhn(d)):
            groups = [(g.start() + m.start(), g.end() + m.start()) for g in _GROUP.finditer(m[0])]
            for a, b in _windows(groups, text, 13, 19, luhn):
                if len(set(text[a:b])) > 3:
                    yield ("card" if len(_digits(text[a:b])) >= 16 else "card_near"), a, b
    if "+" in text:
        for m in _PHONE.finditer(text):
            if len(_digits(m[0])) > 15:
                size, end = 0, None
                for g in _GROUP.finditer(m[0]):
                    size += g.end() - g.start()
                    if size > 15:
                        break
                    end = g.end() if size >= 8 else end
                if end:
                    yield "phone", m.start(), m.start() + end
    for m in _IBAN.finditer(text):
        if 15 <= len(account := m[0].replace(" ", "")) <= 34 and mod97(account):
            yield "iban", m.start(), m.end()
    for m in _LOCAL_PHONE.finditer(text):
        yield "phone_near", m.start(), m.end()
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    said = False
    if kind in _CONTEXT:
        near = (text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]).lower()
        said = _CONTEXT[kind].search(near) is not None
    return min(1.0, PROPOSED[kind] + CHECKED.get(kind, 0.0) + CONTEXT_GAIN * said)


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added ones, scored. An added span needs ACCEPT and overlaps no base span nor an earlier added one."""
    text = text or ""
    base = [(k, a, b, score(text, k, a, b)) for k, a, b, _ in base_spans(text)]
    # Stretches taken already, apart and in order: at most two of them stand next to a new span.
    taken: list[tuple[int, int]] = []
    for _, a, b, _ in sorted(base, key=lambda s: s[1]):
        if taken and a < taken[-1][1]:
            taken[-1] = taken[-1][0], max(taken[-1][1], b)
        else:
            taken.append((a, b))
    added: list[Span] = []
    for kind, a, b in further_spans(text):
        at = bisect_left(taken, (a, b))
        free = (at == len(taken) or taken[at][0] >= b) and (at == 0 or taken[at - 1][1] <= a)
        if free and (s := score(text, kind, a, b)) >= ACCEPT:
            added.append((kind, a, b, s))
            insort(taken, (a, b))
    return base, added


def redacted(text: str, found: list[Span]) -> str:
    """Each span replaced by its kind in square brackets; spans that overlap are replaced together, under the first's kind."""
    out, at = [], 0
    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.removesuffix('_near').upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
_SQL_SPANS = "array<struct<kind:string,start:int,stop:int,score:double>>"
#: Texts handled at once in a worker.
STEP = 256


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "stop", "score")
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            both = [spans(t) for t in part.column("text").to_pylist()]
            lists = [pa.array([[dict(zip(names, s, strict=True)) for s in x[i]] for x in both], _SPANS) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], names=["doc_id", "base", "added"])


def find(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, base and added spans (kind, start, stop, score), a row for each row of ``docs``.

    Offsets are code points, ends exclusive. Runs of digits of any length take linear time. Null text counts as empty. Whole texts are searched, however long; repeated rows
    are searched each by itself; extra columns are ignored; an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_find, f"doc_id long, base {_SQL_SPANS}, added {_SQL_SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in text replaced by its kind in square brackets and n_chars, where there, counted anew. Null
    texts stay null; all other columns stay as they are."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts = [t if t is None else redacted(t, sum(spans(t), [])) for t in part.column("text").to_pylist()]
                place = part.schema.get_field_index("text")
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    out = docs.mapInArrow(clean, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out
