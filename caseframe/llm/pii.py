"""Format-preserving pseudonyms for personal data and secrets in texts.

What is found is validated (check digits, number ranges, calendar), turned into
a number below the count of values its format allows, and moved by a keyed
permutation of those numbers, so that the result is a valid value of the same
format. A permutation gives equal values equal pseudonyms in all documents and
different values different ones; the same key takes them back.

The permutation is a Feistel network over two residue rings whose sizes are
close to the root of the count. Where their product is larger than the count,
the network is applied again until the result is below it (cycle walking).

=========  ============================================  =======================
kind       validated by                                  permuted
=========  ============================================  =======================
phone      country code or brackets, or the North        area, exchange, line
           American numbering plan
ssn        United States ranges                          all digits
ip         four numbers below 256                        the 32-bit address
date       calendar, years 1900 to 2099                  the day
card       Luhn check digit, 13 to 19 digits             all but first and check
email      address syntax                                letters, digits of name
key        access key syntax                             all after the prefix
secret     a named value (password, token, ...)          letters and digits
=========  ============================================  =======================

Separators, prefixes and the layout of what is found stay. Kinds are looked for
in the order of the table, and what one has found the next does not see. Equal
phone numbers, cards and dates are linked even where they are laid out
differently.

Digits in groups beside others (a card and its expiry, say) are tried as a card
from each group to each other, 13 to 19 digits in groups of two at least, and as
a whole: one group first, then groups of 4-4-4-4 and 4-6-5, then the longest. A
permutation leads from phones of the numbering plan to such phones and from
others to others, and keeps whether a day of the month is above 12, so that the
result is read as what it stands for was: numbers are day-month-year where that
is a date, and month-day-year where only that is one. A card whose pseudonym
would make a card of other groups is moved on until it does not; only such a
card has another pseudonym there than elsewhere. Phones, ssn and dates are taken
out before, so that they cannot become part of a card; a card in groups as of a
phone, ssn or date can still become one.

Nulls stay null, empty texts empty; each row is worked on by itself, also
repeated ones and null ids, over its whole text. Extra columns are ignored; an
empty table gives an empty result.
"""

import datetime
import hashlib
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1

_SCHEMA = (
    "doc_id long, text string, n_found long,"
    " found array<struct<kind: string, start: long, end: long>>"
)


class Permutation:
    """Keyed permutations of the numbers below any count."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, turn: int, kind: str, size: int, value: int) -> int:
        content = f"{turn}|{kind}|{size}|{value}".encode()
        digest = hashlib.blake2b(content, key=self.key, digest_size=64).digest()
        return int.from_bytes(digest, "big")

    def _once(self, value: int, size: int, kind: str, back: bool) -> int:
        left = max(2, math.isqrt(max(size - 1, 0)) + 1)
        rings = (left, -(-size // left))
        halves = list(divmod(value, rings[1]))
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            at = turn % 2
            change = self._round(turn, kind, size, halves[1 - at])
            halves[at] = (halves[at] + (-change if back else change)) % rings[at]
        return halves[0] * rings[1] + halves[1]

    def move(self, value: int, size: int, kind: str, back: bool = False) -> int:
        if size < 2:
            return value
        value = self._once(value, size, kind, back)
        while value >= size:
            value = self._once(value, size, kind, back)
        return value


def luhn_digit(digits: str) -> str:
    """Check digit that completes ``digits``."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 == 0 else 1)
        total += value - 9 if value > 9 else value
    return str(-total % 10)


def _laid_out(layout, digits: str) -> str:
    """``layout`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


_GROUP = re.compile(r"\d+")
_CARD_LAYOUTS = ((4, 4, 4, 4), (4, 6, 5))


def _luhn(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def _card_spans(sizes: list[int]) -> list[tuple[int, int]]:
    """First group and the group after the last of what may be a card, the likeliest first."""
    spans = {}
    for first in range(len(sizes)):
        n = 0
        for last in range(first, len(sizes)):
            n += sizes[last]
            if sizes[last] < 2 or n > 19:
                break
            if n >= 13:
                spans[first, last + 1] = n
    if 13 <= sum(sizes) <= 19:
        spans[0, len(sizes)] = sum(sizes)

    def rank(span):
        layout = tuple(sizes[slice(*span)])
        kind = 0 if len(layout) == 1 else 1 if layout in _CARD_LAYOUTS else 2
        return kind, -spans[span], span

    return sorted(spans, key=rank)


def _moved_card(digits: str, keyed, back) -> str:
    middle = digits[1:-1]
    moved = keyed.move(int(middle), 10 ** len(middle), "card", back)
    body = digits[0] + str(moved).zfill(len(middle))
    return body + luhn_digit(body)


def _cards(found, keyed, back):
    """Start, end and new value of each card in a run of digit groups."""
    run = list(found[0])
    groups = [group.span() for group in _GROUP.finditer(found[0])]

    def place(span):
        return slice(groups[span[0]][0], groups[span[1] - 1][1])

    def digits(span):
        return _digits("".join(run[place(span)]))

    cards, used, refused = [], set(), {}
    for span in _card_spans([end - start for start, end in groups]):
        if not used.isdisjoint(range(*span)):
            continue
        if _luhn(digits(span)):
            cards.append(span)
            used.update(range(*span))
        else:
            for group in range(*span):
                refused.setdefault(group, set()).add(span)
    # What was refused must be refused in the result too, or the way back is lost.
    for span in reversed(cards) if back else cards:
        beside = set().union(*(refused.get(group, ()) for group in range(*span)))
        while True:
            run[place(span)] = _laid_out(run[place(span)], _moved_card(digits(span), keyed, back))
            if not any(_luhn(digits(other)) for other in beside):
                break
    for span in cards:
        at = place(span)
        yield found.start() + at.start, found.start() + at.stop, "".join(run[at])


def _walked(value: int, size: int, kind: str, allowed, keyed, back):
    """The permutation among the numbers that are allowed, or among those that are not."""
    own = allowed(value)
    value = keyed.move(value, size, kind, back)
    while allowed(value) != own:
        value = keyed.move(value, size, kind, back)
    return value


def _phone_allowed(value: int) -> bool:
    digits = str(value).zfill(10)
    return digits[0] > "1" and digits[3] > "1"


def _phone(found, keyed, back):
    prefix, rest = found[1] or "", found[0][len(found[1] or "") :]
    value = int(_digits(rest))
    if not (prefix or rest[0] == "(" or _phone_allowed(value)):
        return None
    moved = _walked(value, 10**10, "phone", _phone_allowed, keyed, back)
    return prefix + _laid_out(rest, str(moved).zfill(10))


def _ssn_allowed(value: int) -> bool:
    digits = str(value).zfill(9)
    area = digits[:3]
    return area not in ("000", "666") and area < "900" and digits[3:5] != "00" and digits[5:] != "0000"


def _ssn(found, keyed, back):
    value = int(_digits(found[0]))
    if not _ssn_allowed(value):
        return None
    moved = _walked(value, 10**9, "ssn", _ssn_allowed, keyed, back)
    return _laid_out(found[0], str(moved).zfill(9))


def _ip(found, keyed, back):
    parts = [int(part) for part in found[0].split(".")]
    if max(parts) > 255 or any(part != str(int(part)) for part in found[0].split(".")):
        return None
    value = int.from_bytes(bytes(parts), "big")
    return ".".join(map(str, keyed.move(value, 1 << 32, "ip", back).to_bytes(4, "big")))


def _day(number: int) -> datetime.date:
    return datetime.date.fromordinal(number + _FIRST_DAY)


def _late(number: int) -> bool:
    """Whether the day cannot be taken for a month."""
    return _day(number).day > 12


def _date(found, keyed, back):
    groups = found.groupdict()
    year_first = groups["y1"] is not None
    orders = ("y1 m1 d1",) if year_first else ("y2 m2 d2", "y2 d2 m2")
    for order in orders:
        try:
            day = datetime.date(*(int(groups[name]) for name in order.split()))
            break
        except ValueError:
            continue
    else:
        return None
    number = day.toordinal() - _FIRST_DAY
    if not 0 <= number < _DAYS:
        return None
    moved = _day(_walked(number, _DAYS, "date", _late, keyed, back))
    if year_first:
        sign = groups["s1"]
        return f"{moved.year:04d}{sign}{moved.month:02d}{sign}{moved.day:02d}"
    sign = groups["s2"]
    first, second = (moved.day, moved.month) if order == orders[0] else (moved.month, moved.day)
    return f"{first:02d}{sign}{second:02d}{sign}{moved.year:04d}"


_HEX = "0123456789abcdef"
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _signs(text: str, kind: str, keyed, back, classes=_CLASSES) -> str:
    """Letters and digits moved within their class, all others where they were."""
    own = [next((c for c in classes if sign in c), None) for sign in text]
    value, size = 0, 1
    for sign, signs in zip(text, own, strict=True):
        if signs:
            value, size = value * len(signs) + signs.index(sign), size * len(signs)
    layout = "".join("." if not signs else str(classes.index(signs)) for signs in own)
    value = keyed.move(value, size, f"{kind}|{layout}", back)
    result = []
    for sign, signs in zip(reversed(text), reversed(own), strict=True):
        if signs:
            value, at = divmod(value, len(signs))
            sign = signs[at]
        result.append(sign)
    return "".join(reversed(result))


def _email(found, keyed, back):
    return _signs(found[1].lower(), "email", keyed, back) + found[2]


def _key(found, keyed, back):
    return found[1] + _signs(found[2], "key", keyed, back, ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",))


def _secret(found, keyed, back):
    value = found[2]
    classes = (_HEX,) if set(value) <= set(_HEX) else _CLASSES
    return found[1] + _signs(value, "secret", keyed, back, classes)


KINDS = (
    (
        "phone",
        re.compile(
            r"(?<![\w.+-])(\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]|\.\d)"
        ),
        _phone,
    ),
    ("ssn", re.compile(r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-])"), _ssn),
    ("ip", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"), _ip),
    (
        "date",
        re.compile(
            r"(?<![\w./-])(?:(?P<y1>\d{4})(?P<s1>[-/.])(?P<m1>\d{2})(?P=s1)(?P<d1>\d{2})"
            r"|(?P<d2>\d{2})(?P<s2>[-/.])(?P<m2>\d{2})(?P=s2)(?P<y2>\d{4}))(?![\w/-]|\.\d)"
        ),
        _date,
    ),
    ("card", re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,}(?![\w-]|\.\d)"), _cards),
    ("email", re.compile(r"(?<![\w.+-])([\w.+-]+)(@(?:[\w-]+\.)+[A-Za-z]{2,})", re.ASCII), _email),
    ("key", re.compile(r"(?<!\w)(AKIA|ASIA)([A-Z0-9]{16})(?!\w)"), _key),
    (
        "secret",
        re.compile(
            r"""((?i:password|passwd|pwd|token|secret|api[_-]?key)["']?\s*[=:]\s*["']?)"""
            r"""([A-Za-z0-9_+/-]{6,})"""
        ),
        _secret,
    ),
)
#: A text without any of these has nothing to find.
_HINT = re.compile(r"[0-9@=:]|AKIA|ASIA")


def pseudonymised(
    text: str, keyed: Permutation, back: bool = False
) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each in the new text."""
    if not _HINT.search(text):
        return text, []
    changes: list[tuple[int, int, str, str]] = []
    hidden = text
    for kind, pattern, replaced in KINDS:
        taken = []
        for found in pattern.finditer(hidden):
            values = replaced(found, keyed, back)
            if isinstance(values, str):
                values = [(found.start(), found.end(), values)]
            for start, end, value in values or ():
                changes.append((start, end, kind, value))
                taken.append((start, end))
        for start, end in taken:
            hidden = hidden[:start] + "\0" * (end - start) + hidden[end:]
    parts, spans, at, moved = [], [], 0, 0
    for start, end, kind, value in sorted(changes):
        parts += [text[at:start], value]
        spans.append((kind, start + moved, start + moved + len(value)))
        moved += len(value) - (end - start)
        at = end
    return "".join([*parts, text[at:]]), spans


def _applied(key: bytes, back: bool):
    def run(frames):
        keyed = Permutation(key)
        for frame in frames:
            new, found = [], []
            for text in frame["text"]:
                if text is None:
                    new.append(None)
                    found.append([])
                    continue
                changed, spans = pseudonymised(text, keyed, back)
                new.append(changed)
                found.append([{"kind": kind, "start": s, "end": e} for kind, s, e in spans])
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "text": pd.Series(new, dtype=object),
                    "n_found": pd.Series([len(spans) for spans in found], dtype="int64"),
                    "found": pd.Series(found, dtype=object),
                }
            )

    return run


def pseudonymise(documents: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``doc_id``, ``text`` with pseudonyms, ``n_found`` and ``found``: kind, start and end.

    ``back`` turns pseudonyms of the same key into what they stand for.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInPandas(_applied(key, back), _SCHEMA)
