"""Personal data: flags, guarded redaction, and reserved replacements."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import let

# Patterns that decide what counts as personal data.
EMAIL = r"(?<![\w.+%\\-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-])"
PLACEHOLDER_EMAIL = (
    r"(?i)@(?:[\w.-]*\.)?(?:example|test|tests|domain|yourdomain|yourcompany|company|sample|foo|bar|placeholder|localhost|invalid|acme|mydomain|website|email|mail)"
    r"\.(?:com|org|net|edu|io|co|local|invalid|test)$|@localhost$|^(?:user|name|you|your|username|email|john|jane|test|foo|bar|someone|sender|recipient)@"
)
PHONE = r"(?<![\w.+-])(?:\+\d{1,3}[\s.-]\(?\d{1,4}\)?(?:[\s.-]\d{2,4}){2,4}|\(\d{3}\)\s?\d{3}[\s.-]\d{4}|\b\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])"
SECRET = (
    r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{32,}|xox[baprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}"
    r"|-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----[\s\S]*?(?:-----END (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----|$)"
    r"|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"
)
CARD = r"(?<!\d )(?<![\d.\-/=_:\\])(?:4\d{3}|5[1-5]\d{2}|3[47]\d{2}|6011|35\d{2})[ -]\d{4}[ -]\d{4}[ -]\d{2,4}(?![\d.\-/_])(?! \d)"
SSN = r"(?i)((?:ssn|social security(?: number)?)\D{0,20})(\d{3}-\d{2}-\d{4})"
IPV4 = r"(?<![\w.=<>~-])((?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?))(?!\w|\.\d|/\d)"
EMAIL_ANY = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_ANY = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
WELL_KNOWN_IPS = ["8.8.8.8", "8.8.4.4", "1.1.1.1", "1.0.0.1", "9.9.9.9", "149.112.112.112", "208.67.222.222", "208.67.220.220", "4.2.2.2"]


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def plausible_number(c: Column, least: int, most: int) -> Column:
    """Digits of a real number: so many of them, and more than three different ones."""
    d = digits(c)
    return F.length(d).between(least, most) & (F.size(F.array_distinct(F.split(d, ""))) > 3)


def emails(c: Column, guarded: bool = True) -> Column:
    found = F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))
    return F.filter(found, lambda e: ~e.rlike(PLACEHOLDER_EMAIL)) if guarded else found


def phones(c: Column) -> Column:
    found = F.regexp_extract_all(c, F.lit(PHONE), F.lit(0))
    fine = lambda p: plausible_number(p, 9, 15) & ~digits(p).rlike(r"(\d)\1{5,}") & ~digits(p).contains("1234567") & ~p.rlike(r"555[\s.-]?01\d\d")
    return F.filter(found, fine)


def cards(c: Column) -> Column:
    found = F.regexp_extract_all(c, F.lit(CARD), F.lit(0))
    return F.filter(found, lambda x: plausible_number(x, 13, 19) & F.call_function("luhn_check", digits(x)))


def is_public_ip(ip: Column) -> Column:
    """Whether a dotted address lies outside private, loopback, link-local, shared, test, multicast and reserved blocks."""
    o = F.transform(F.split(ip, r"\."), lambda x: x.cast("int"))
    a, b, c = o[0], o[1], o[2]
    closed = (
        a.isin(0, 10, 127)
        | (a >= 224)
        | ((a == 100) & b.between(64, 127))
        | ((a == 169) & (b == 254))
        | ((a == 172) & b.between(16, 31))
        | ((a == 192) & (b == 168))
        | ((a == 192) & (b == 0) & c.isin(0, 2))
        | ((a == 198) & b.isin(18, 19))
        | ((a == 198) & (b == 51) & (c == 100))
        | ((a == 203) & (b == 0) & (c == 113))
    )
    return ~closed


def public_ips(c: Column) -> Column:
    found = F.regexp_extract_all(c, F.lit(IPV4), F.lit(1))
    return F.filter(found, lambda x: is_public_ip(x) & ~x.isin(WELL_KNOWN_IPS) & ~x.endswith(".0"))


def _replaced(c: Column, found, name: str) -> Column:
    return let(c, lambda v: F.aggregate(found(v), v, lambda a, x: F.replace(a, x, F.lit(name))))


def redact(c: Column) -> Column:
    """Text with guarded matches replaced by placeholders, kinds in a fixed order."""
    c = F.regexp_replace(c, f"(?!\\w*EXAMPLE)(?:{SECRET})", "<SECRET>")
    c = _replaced(c, emails, "<EMAIL>")
    c = F.regexp_replace(_replaced(c, cards, "<CARD_NUMBER>"), SSN, "$1<SSN>")
    return _replaced(c, phones, "<PHONE>")


_EMAIL, _PLACEHOLDER = re.compile(EMAIL), re.compile(PLACEHOLDER_EMAIL)
#: Reserved replacements.
RESERVED_EMAILS = ("email@example.com", "firstname.lastname@example.org")


@F.pandas_udf(StringType())
def replace_emails(texts: pd.Series) -> pd.Series:
    """Guarded addresses replaced by a reserved one that depends on the match only."""
    import hashlib

    def other(m: re.Match) -> str:
        if _PLACEHOLDER.search(m[0]):
            return m[0]
        return RESERVED_EMAILS[hashlib.md5(m[0].encode()).digest()[0] % len(RESERVED_EMAILS)]

    return texts.map(lambda t: t if t is None or "@" not in t else _EMAIL.sub(other, t))
