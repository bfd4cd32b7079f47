"""Personal data in whole texts, found by growing spans around anchors.

One Aho-Corasick pass finds the anchors: at-signs, plus signs, digits, schemes and identifier
cues. At each anchor a small deterministic parser moves outwards to the borders of the span and
validates it. The kinds ``email, ip, card, phone`` are the leftmost non-overlapping matches of their
grammars; a match that fails its check (parts over 255, Luhn, number of digits) is dropped
and not tried again at another place. The method adds ``login`` (an address with user and password
in front of the host), ``iban`` (after its cue, valid by its check digits), ``ssn`` (after its
cue, in the form and the ranges that are given out) and ``secret`` (what is assigned to a name such as
token or api_key: 16 or more characters without a blank, a digit among them).

Positions count code points, ends are exclusive. A null text counts as empty; repeated rows and
null ids get a row each; an empty table has an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "ssn", "secret")

ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
DIGITS = frozenset("0123456789")
LOCAL = frozenset(ALNUM + "._%+-")
LABEL = frozenset(ALNUM + "-")
DIALLED = frozenset("0123456789 ().-")
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "ssh://")
CUES = {"iban": ("IBAN", "Iban", "iban"),
        "ssn": ("SSN", "ssn", "Social Security Number", "social security number"),
        "secret": ("token", "Token", "TOKEN", "secret", "Secret", "SECRET", "api_key", "API_KEY", "apikey",
                   "password", "Password", "PASSWORD")}
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9])")
#: The sign of assignment behind a cue, and the value.
ASSIGNED = re.compile(r"""["']?[\x20]?[:=][\x20]?["']?""")
SECRET = re.compile(r"(?=[A-Za-z0-9+/_=.-]*[0-9])[A-Za-z0-9+/_=.-]{16,}")
#: Characters that may stand between a cue and its value.
GAP = re.compile(r"[\x20:#=]{0,4}")


def run(text: str, at: int, chars: frozenset[str]) -> int:
    """The end of the longest run of ``chars`` that starts at ``at``."""
    size = len(text)
    while at < size and text[at] in chars:
        at += 1
    return at


def run_back(text: str, at: int, least: int, chars: frozenset[str]) -> int:
    """The start of the longest run of ``chars`` that ends before ``at``, not before ``least``."""
    while at > least and text[at - 1] in chars:
        at -= 1
    return at


def email_at(text: str, sign: int, least: int) -> tuple[int, int] | None:
    """The address around an at-sign: a local part, and at least two labels."""
    start = run_back(text, sign, least, LOCAL)
    end = run(text, sign + 1, LABEL)
    if start == sign or end == sign + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == "." and (more := run(text, end + 1, LABEL)) > end + 1:
        end, dots = more, dots + 1
    return (start, end) if dots else None


def four_numbers(text: str, start: int) -> tuple[int, int] | None:
    """Four runs of digits with dots between them, from the start of a run."""
    end = run(text, start, DIGITS)
    for _ in range(3):
        if end >= len(text) or text[end] != ".":
            return None
        more = run(text, end + 1, DIGITS)
        if more == end + 1:
            return None
        end = more
    return start, end


def up_to_255(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def digit_chain(text: str, start: int) -> int:
    """The end of digits that follow each other directly or after one blank or hyphen."""
    at = run(text, start, DIGITS)
    while at + 1 < len(text) and text[at] in " -" and text[at + 1] in DIGITS:
        at = run(text, at + 1, DIGITS)
    return at


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    """A plus, a digit, at least one character in between, and a digit at the end."""
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None
    end = run(text, plus + 2, DIALLED)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (plus, end) if end > plus + 3 and text[end - 1] in DIGITS else None


def login_at(text: str, scheme: int, after: int) -> tuple[int, int] | None:
    """``user:password@host`` behind a scheme; the host ends at the first other character."""
    user = run(text, after, LOCAL)
    if user == after or user >= len(text) or text[user] != ":":
        return None
    sign = user + 1
    while sign < len(text) and not text[sign].isspace() and text[sign] not in "@/":
        sign += 1
    if sign == user + 1 or sign >= len(text) or text[sign] != "@":
        return None
    end = run(text, sign + 1, frozenset(ALNUM + ".-"))
    return (scheme, end) if end > sign + 1 else None


def iban_at(text: str, at: int) -> tuple[int, int] | None:
    """The longest valid number at ``at``: letters count from 10, the rest is 1 modulo 97."""
    found = IBAN.match(text, at)
    if not found:
        return None
    for end in range(found.end(), found.start() + 14, -1):
        plain = text[found.start():end].replace(" ", "")
        if text[end - 1] != " " and len(plain) >= 15 and int(
                "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return found.start(), end
    return None


def anchors():
    """The automaton; its values are ``(kind of anchor, length)``."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for sign in "@+0123456789":
        machine.add_word(sign, (sign if sign in "@+" else "digit", 1))
    for word in SCHEMES:
        machine.add_word(word, ("scheme", len(word)))
    for kind, names in CUES.items():
        for word in names:
            machine.add_word(word, (kind, len(word)))
    machine.make_automaton()
    return machine


def spans(text: str, machine) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind and then by start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    free = dict.fromkeys((*KINDS, "digits"), 0)  # where the next match of a kind may start
    for last, (kind, length) in machine.iter(text):
        at = last + 1 - length
        if kind == "digit":
            if at >= free["digits"]:  # the first digit of a run
                free["digits"] = run(text, at, DIGITS)
            if at >= free["ip"]:
                # only the first free digit of a run starts four numbers, later ones end alike
                got = four_numbers(text, at)
                free["ip"] = got[1] if got else free["digits"]
                if got and all(map(up_to_255, text[at:got[1]].split("."))):
                    found["ip"].append(got)
            if at >= free["card"]:
                end = digit_chain(text, at)
                free["card"] = end
                digits = text[at:end].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((at, end))
        elif kind == "@":
            if at >= free["email"] and (got := email_at(text, at, free["email"])):
                free["email"] = got[1]
                found["email"].append(got)
        elif kind == "+":
            if at >= free["phone"] and (got := phone_at(text, at)):
                free["phone"] = got[1]
                if 9 <= sum(c in DIGITS for c in text[at:got[1]]) <= 15:
                    found["phone"].append(got)
        elif kind == "scheme":
            if at >= free["login"] and (got := login_at(text, at, last + 1)):
                free["login"] = got[1]
                found["login"].append(got)
        elif kind == "secret":
            sign = ASSIGNED.match(text, last + 1)
            match = SECRET.match(text, sign.end()) if sign and last + 1 >= free[kind] else None
            if match:
                free[kind] = match.end()
                found[kind].append(match.span())
        elif last + 1 >= free[kind]:
            value = GAP.match(text, last + 1).end()
            match = SSN.match(text, value) if kind == "ssn" else None
            got = match.span() if match else iban_at(text, value) if kind == "iban" else None
            if got:
                free[kind] = got[1]
                found[kind].append(got)
    return [(kind, *s) for kind in KINDS for s in sorted(found[kind])]


def written(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


COLUMNS = ("id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
           "spans string, n_spans long")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = anchors()
    for batch in batches:
        out = []
        for text in batch.column(1):
            every = spans(text.as_py() or "", machine)
            base = [s for s in every if s[0] in BASE]
            out.append((*(sum(s[0] == kind for s in base) for kind in BASE),
                        hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every)))
        columns = list(zip(*out)) or [[] for _ in range(7)]
        yield pa.record_batch([
            batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
            *(pa.array(c, pa.string()) for c in columns[4:6]), pa.array(columns[6], pa.int64())],
            ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])


def personal_data(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest, all spans as ``kind:start:end,...``, and how many these are."""
    return df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`")
                     .alias("text")).mapInArrow(_find, COLUMNS)


def _mask(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    machine = anchors()
    for batch in batches:
        out = []
        for value in batch.column(column).to_pylist():
            parts, at = [], 0
            for kind, start, end in sorted(spans(value or "", machine), key=lambda s: s[1:]):
                if start >= at:
                    parts += [value[at:start], f"[{kind}]"]
                at = max(at, end)
            out.append(value if value is None else "".join(parts) + value[at:])
        place = batch.schema.get_field_index(column)
        yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))


def masked(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets."""
    return df.mapInArrow(lambda b: _mask(b, text), df.schema)
