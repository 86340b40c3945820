"""Personal data: patterns propose spans, checks confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds whose confirmed spans always stay, in the order of output.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id", "local_phone")

# The optional tail lets a pattern consume a run it can't use, so that each run of
# characters is looked at once however long it is; ``group(1)`` tells a proposal.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(?:(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)|@)?")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9]((?:[ -]?[0-9])++)?")
_PHONE = re.compile(r"\+([0-9][ ().0-9-]+[0-9])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+(.-])(\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9.-]*[0-9])")
_DIGIT = re.compile("[0-9]")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    """Sum of digits, every second from the right doubled, is a multiple of ten."""
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Remainder 1 by 97 after the first four characters go to the end and letters count from 10."""
    account = account.replace(" ", "")
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _national(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Kind:
    """``score`` of a confirmed span; ``near`` words within ``REACH`` characters add ``STEP``, ``against`` take it away."""

    name: str
    pattern: re.Pattern
    confirm: Callable[[str], bool]
    score: float
    near: re.Pattern
    against: re.Pattern
    trigger: str = ""


REACH, STEP, LEAST = 40, 0.3, 0.5


def _any(*stems: str) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(stems) + ")", re.IGNORECASE) if stems else re.compile(r"(?!)")


_PAPER = _any("order", "invoice", "isbn", "issn", "part no", "serial", "version")
KINDS = (
    Kind("email", _EMAIL, lambda t: True, 0.7, _any("mail", "contact", "write"), _any("example", "noreply"), "@"),
    Kind("ip", _IP, _octets, 0.6, _any("ip", "host", "server", "address"), _any("version", "release"), "."),
    Kind("card", _CARD, lambda t: 13 <= len(d := digits(t)) <= 19 and luhn(d), 0.7, _any("card", "visa", "credit", "karte", "tarjeta", "carte"), _PAPER),
    Kind("phone", _PHONE, lambda t: 9 <= len(digits(t)) <= 15, 0.7, _any("phone", "tel", "call", "fax", "mobile"), _PAPER, "+"),
    Kind("iban", _IBAN, mod97, 0.8, _any("iban", "account", "bank", "konto", "cuenta", "compte"), _PAPER),
    Kind("national_id", _NATIONAL, _national, 0.3, _any("ssn", "social security", "national id", "tax id"), _PAPER, "-"),
    Kind("local_phone", _LOCAL, lambda t: len(digits(t)) == 10, 0.3, _any("phone", "tel", "call", "fax", "mobile"), _PAPER),
)


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """Kind, start, end (exclusive, code points) and score; by kind in the order of ``KINDS``, then by start.

    A base span stays whatever its score. One of another kind needs ``LEAST`` and must
    not overlap a base span or an added one before it.
    """
    out: list[tuple[str, int, int, float]] = []
    if "@" not in text and not _DIGIT.search(text):
        return out
    taken: list[tuple[int, int]] = []
    for kind in KINDS:
        if kind.trigger not in text:
            continue
        for m in kind.pattern.finditer(text):
            if m[1] is None or not kind.confirm(m[0]):
                continue
            start, end = m.span()
            around = text[max(0, start - REACH) : start] + " " + text[end : end + REACH]
            score = kind.score + STEP * bool(kind.near.search(around)) - STEP * bool(kind.against.search(around))
            if kind.name not in BASE and (score < LEAST or any(s < end and start < e for s, e in taken)):
                continue
            out.append((kind.name, start, end, round(min(1.0, score), 2)))
            taken.append((start, end))
    return out


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def found(docs: DataFrame, text_col: str = "text", name: str = "pii") -> DataFrame:
    """Every column of ``docs`` and ``name``: the spans of personal data of the whole text.

    A null or empty text has an empty array; repeated rows are searched each. A column
    of that name in ``docs`` is replaced. Nothing is shuffled.
    """
    kept = docs.drop(name)
    schema = kept.select("*", F.lit(None).cast(SPANS).alias(name)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            got = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t.as_py() or "")] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, kind)], names=[*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def redacted(docs: DataFrame, text_col: str = "text", name: str = "pii") -> DataFrame:
    """``found`` with each span in the text replaced by its kind in brackets; a null text stays null."""

    @F.udf("string")
    def cut(text, got):
        if text is None:
            return None
        out, at = [], 0
        for s in sorted(got, key=lambda s: (s["start"], -s["end"])):
            if s["end"] > at:
                out += [text[at : s["start"]], f"[{s['kind']}]"] if s["start"] >= at else []
                at = s["end"]
        return "".join([*out, text[at:]])

    return found(docs, text_col, name).withColumn(text_col, cut(text_col, name))
