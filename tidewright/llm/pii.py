"""Personal data in texts: patterns propose spans, checks confirm them, words nearby weigh in.

Each kind has a pattern. A proposal starts with the chance its pattern alone gives, gains by a
passed check (Luhn for cards, mod-97 for bank accounts, ranges for addresses, lengths for
phones) or is thrown out by a failed one, and gains or loses by words just before it. Four
kinds have a strict form that counts whatever its score (`base`); all others need the
threshold.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, ship, slices, text_bytes, with_fields, without

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "secret"]
NEAR = 48  # characters before a span in which words count
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Nothing can be found without one of these
NEEDED = re.compile(rb"[0-9@]")

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match cannot begin inside a run of digits: it would have begun with the run
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

GROUP = re.compile(r"[0-9]+")
# +49 30 1234567, +1 (310) 555-4510: country, perhaps an area in brackets, groups
DIALLED = re.compile(r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,5}\))?(?:[ .-]?[0-9]{2,}){1,5}")
NATIONAL = re.compile(r"(?<![0-9.+-])(?<![0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-]*[0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
ISSUED = re.compile(r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,})\Z")

# Characters of a bank account number by country
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26,
}


def words(text: str) -> re.Pattern:
    return re.compile(r"(?<![a-z])(?:" + "|".join(text.split()) + r")(?![a-z])")


@dataclass(frozen=True)
class Weight:
    """What a pattern alone is worth, and what words before it add or take."""

    start: float
    for_it: re.Pattern
    against: re.Pattern
    gain: float = 0.3
    loss: float = 0.3


WEIGHTS = {
    "email": Weight(0.9, words("e-?mail contact write mailto"), words("example")),
    "ip": Weight(0.6, words("ip ips host server address client addr"), words("version release section chapter v")),
    "card": Weight(0.4, words("card cards visa mastercard amex credit debit payment"), words("isbn order tracking serial")),
    "phone": Weight(0.45, words("phone tel telephone mobile cell call fax"), words("isbn order tracking serial version")),
    "iban": Weight(0.4, words("iban account konto cuenta compte bank"), words("isbn serial model")),
    "ssn": Weight(0.3, words("ssn social security taxpayer"), words("order part serial model")),
    "secret": Weight(0.3, words("token key apikey api_key secret password passwd pwd bearer auth credential credentials"),
                     words("sha commit checksum digest md5 hash"), gain=0.4),
}


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether the check digits of an international bank account number are right."""
    value = "".join(str(int(c, 36)) for c in account[4:] + account[:4])
    return int(value) % 97 == 1


def entropy(text: str) -> float:
    """Bits a character."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ with a domain, back over what may stand before it: as the pattern from
    left to right finds them, without rescanning a long run once per character."""
    floor = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            floor = m.end()


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def count_digits(text: str) -> int:
    return sum(map(text.count, "0123456789"))


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the strict forms, per kind from left to right; a match that fails its check
    is dropped, and what it covers is not looked at again."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(map(small, m.group().split("."))):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    for m in PHONE.finditer(text):
        if m.end() - m.start() >= 10 and 9 <= count_digits(m.group()) <= 15:
            yield "phone", *m.span()


def more_spans(text: str) -> Iterator[tuple[str, int, int, float]]:
    """(kind, start, end, what its check adds) of all looser forms that pass their check."""
    for m in CARD.finditer(text):  # card numbers inside longer chains of digits
        if m.end() - m.start() >= 13:
            yield from _cards(m)
    for m in DIALLED.finditer(text):
        end = _dialled(m)
        if end:
            yield "phone", m.start(), end, 0.3
    for m in NATIONAL.finditer(text):
        yield "phone", *m.span(), 0.1 if m.group()[0] == "(" else 0.0
    for m in IBAN.finditer(text):
        end = _account(m.group())
        if end:
            yield "iban", m.start(), m.start() + end, 0.5
    for m in SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
            yield "ssn", *m.span(), 0.0
    for m in SECRET.finditer(text):
        value = m.group()
        if ISSUED.match(value):
            yield "secret", *m.span(), 0.6
        elif re.search("[0-9]", value) and re.search("[A-Za-z]", value) and entropy(value) >= 3:
            yield "secret", *m.span(), 0.0


def _cards(chain: re.Match) -> Iterator[tuple[str, int, int, float]]:
    """Groups of a chain that are a card number of their own: one group of 13 to 19 digits,
    four of four digits, or four, six and five."""
    groups = [m.span() for m in GROUP.finditer(chain.group())]
    sizes = [b - a for a, b in groups]
    k = 0
    while k < len(groups):
        for shape in ((sizes[k],), (4, 4, 4, 4), (4, 6, 5)):
            last = k + len(shape)
            if 13 <= sum(shape) <= 19 and tuple(sizes[k:last]) == shape:
                a, b = groups[k][0], groups[last - 1][1]
                digits = re.sub("[ -]", "", chain.group()[a:b])
                if luhn(digits) and "2" <= digits[0]:
                    yield "card", chain.start() + a, chain.start() + b, 0.3
                    k = last - 1
                    break
        k += 1


def _dialled(m: re.Match) -> int:
    """Where the longest number of 10 to 13 digits ends that begins here and ends with a
    group; 0 if there is none."""
    total, best = 0, 0
    for group in GROUP.finditer(m.group()):
        total += group.end() - group.start()
        if 10 <= total <= 13:
            best = m.start() + group.end()
        if best and total >= 11:
            break
    return best


def _account(text: str) -> int:
    """Characters of the account number at the beginning of `text`, 0 if there is none."""
    want = IBAN_LENGTHS.get(text[:2].upper())
    if not want:
        return 0
    taken = 0
    for k, c in enumerate(text):
        taken += c != " "
        if taken == want:
            whole = k + 1 == len(text) or not text[k + 1].isalnum()
            return k + 1 if whole and mod97(text[:k + 1].replace(" ", "").upper()) else 0
    return 0


def scored(text: str, kind: str, start: int, added: float) -> float:
    weight, before = WEIGHTS[kind], text[max(0, start - NEAR):start].lower()
    score = weight.start + added
    if weight.for_it.search(before):
        score += weight.gain
    if weight.against.search(before):
        score -= weight.loss
    return round(min(1.0, max(0.0, score)), 6)


def spans_of(text: str, threshold: float = 0.5) -> list[tuple[int, int, int, float, bool]]:
    """(start, number of the kind, end, score, base) in order. Of looser spans those that
    reach the threshold and meet no other span, the best first; base spans always stay."""
    checked = {"email": 0.1, "ip": 0.2, "card": 0.4, "phone": 0.3}
    found = [(s, KINDS.index(k), e, scored(text, k, s, checked[k]), True) for k, s, e in base_spans(text)]
    looser = [(-scored(text, k, s, added), s, KINDS.index(k), e) for k, s, e, added in more_spans(text)]
    free = Free(sorted((s, e) for s, _, e, *_ in found))
    for score, s, k, e in sorted(looser):
        if -score >= threshold and free.take(s, e):
            found.append((s, k, e, -score, False))
    return sorted(found)


class Free:
    """Parts of a text that no span has taken; spans given at first may overlap."""

    def __init__(self, taken: list[tuple[int, int]]):
        self.starts, self.ends, last = [], [], -1
        for s, e in taken:
            if s < last:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)
            last = self.ends[-1]

    def take(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        if k < len(self.starts) and self.starts[k] < end:
            return False
        k = bisect_left(self.starts, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)
        return True


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                  ("base", pa.bool_())])


def find_personal_data(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", threshold: float = 0.5,
                       chunk_bytes: int = 4 << 20) -> DataFrame:
    """`docs` with the personal data in its text: an array of (kind, start, end, score,
    base), by start, then kind as in KINDS; start and end count code points, end exclusive.

    Nulls: a null text is empty; other columns are passed through. Texts without personal
    data get an empty array. Very long texts: time grows with the length, whatever stands
    in them. Ties: spans of different kinds may begin together or overlap if they are base
    ones; of looser spans that meet, the likelier stays, then the first. Repeated rows: each
    on its own. Empty table: no rows. A column called like the new one is replaced.
    """
    ship(docs)
    docs = without(docs, spans_col)
    schema = with_fields(docs, f"`{spans_col}` array<struct<kind: string, start: int, end: int, score: double, base: boolean>>")
    names = pa.array(KINDS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, chunk_bytes):
            found = [spans_of(t.decode("utf-8", "replace"), threshold) if NEEDED.search(t) else []
                     for t in text_bytes(batch.column(text_col))]
            rows = [r for f in found for r in f]
            start, kind, end, score, base = zip(*rows) if rows else ((),) * 5
            column = pa.StructArray.from_arrays([
                names.take(pa.array(kind, pa.int32())), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                pa.array(score, pa.float64()), pa.array(base, pa.bool_())], fields=list(SPAN))
            ends = np.cumsum([0, *map(len, found)])
            yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), column)],
                                  names=[*batch.schema.names, spans_col])

    return docs.mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """`docs` with each stretch of personal data in the text put as its kind in angle
    brackets; spans that overlap become one, named by the first. Same columns; a null
    text stays null. Everything else as in find_personal_data."""
    spans = fresh(docs, "__spans")
    found = find_personal_data(docs, text_col, spans, **options)
    text = f"`{text_col}`"
    # walk along the spans: (text so far, place up to which it is told)
    told = F.expr(
        f"aggregate({spans}, named_struct('told', '', 'at', 0), (t, s) -> "
        f"if(s.start >= t.at, named_struct('told', concat(t.told, substring({text}, t.at + 1, s.start - t.at), '<', s.kind, '>'), "
        f"'at', s.end), named_struct('told', t.told, 'at', greatest(t.at, s.end))), "
        f"t -> concat(t.told, substring({text}, t.at + 1)))")
    new = F.when(F.size(spans) > 0, told).otherwise(F.col(text))
    return found.select(*(new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
