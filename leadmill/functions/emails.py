"""E-mail extraction, validation and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import let, py_strip, strip_chars

#: The patterns of addresses in text, in listings, and written so that machines miss them.
PLAIN = r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"
LISTING = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
OBFUSCATED = r"(?i)\b[A-Za-z0-9._%+\-]+\s*(?:\[at\]|\(at\)|@)\s*[A-Za-z0-9.\-]+\s*(?:\[dot\]|\(dot\)|\.)\s*[A-Za-z]{2,}\b"
#: Fixed values of the validation: user prefixes, domains, last labels.
BAD_PREFIXES = ["u002f", "\\u002f", "0x", "%2f", "http", "www", "image", "asset", "icon", "logo", "npm"]
BAD_DOMAINS = [
    "sentry.io", "ingest.sentry.io", "bugsnag.com", "rollbar.com", "logrocket.com",
    "segment.io", "segment.com", "mixpanel.com", "amplitude.com", "newrelic.com",
    "datadoghq.com", "wixpress.com", "squarespace.com", "example.com", "domain.com",
    "yourdomain.com", "test.com", "mattboldt.com", "jquery.com", "bootstrap.com",
    "fontawesome.com", "videojs.com", "rive.app", "teamwork.com", "schema.org",
    "w3.org", "github.com", "unpkg.com",
]
BAD_LABELS = ["png", "jpg", "jpeg", "webp", "gif", "svg", "webm", "mp4", "avi", "mov", "css", "js", "ts"]
#: Fixed values of the listing step's junk filter.
JUNK_DOMAINS = [
    "example.com", "sentry.io", "wixpress.com", "godaddy.com",
    "schema.org", "yourdomain.com", "domain.com", "email.com",
    "wordpress.com", "gravatar.com", "w3.org", "sentry-next.wixpress.com",
]
JUNK_EXTENSIONS = [".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".css", ".js"]
MAX_LABELED = 10


def _any(words: list[str]) -> str:
    special = set(".\\+*?[]()^$|{}")
    return "|".join("".join("\\" + c if c in special else c for c in w) for w in words)


def is_valid(email: Column, bad_domains: list[str] | None = None) -> Column:
    """Strict validation of one address; the deny-list of domains is a parameter."""
    denied = _any(BAD_DOMAINS if bad_domains is None else bad_domains)

    def parts(e: Column) -> Column:
        return F.struct(F.regexp_extract(e, "(?s)^(.*)@", 1).alias("user"), F.substring_index(e, "@", -1).alias("domain"))

    def rules(p: Column) -> Column:
        user, domain = p["user"], p["domain"]
        local = F.when(user.rlike(r"^\\?u002f"), F.replace(F.replace(user, F.lit("u002f"), F.lit("")), F.lit("\\u002f"), F.lit(""))).otherwise(user)
        return (
            domain.rlike(r"\.[^.]{2,}$")
            & ~domain.rlike(rf"^[1-4]x\.(png|jpg|jpeg|webp|gif|svg|webm)$|(^|\.)({_any(BAD_LABELS)})$|(^|\.)({denied})$")
            & let(local, lambda u: F.length(u).between(2, 64) & ~u.rlike(f"^[0-9a-f]{{20,64}}$|^({_any(BAD_PREFIXES)})"))
        )

    return F.coalesce(F.contains(email, F.lit("@")) & let(let(strip_chars(F.lower(email), "."), parts), rules), F.lit(False))


def deobfuscate(c: Column) -> Column:
    s = F.replace(F.lower(c), F.lit(" "), F.lit(""))
    for mark, plain in (("[at]", "@"), ("(at)", "@"), ("[dot]", "."), ("(dot)", ".")):
        s = F.replace(s, F.lit(mark), F.lit(plain))
    return s


def from_text(text: Column, bad_domains: list[str] | None = None) -> Column:
    """Sorted distinct addresses of a text, plain and de-obfuscated, validated, in lower case."""
    plain = F.transform(F.regexp_extract_all(text, F.lit(PLAIN), F.lit(0)), lambda e: strip_chars(F.lower(e), "."))
    hidden = F.transform(F.regexp_extract_all(text, F.lit(OBFUSCATED), F.lit(0)), deobfuscate)
    return F.array_sort(F.array_distinct(F.filter(F.concat(plain, hidden), lambda e: is_valid(e, bad_domains))))


def listing_candidates(text: Column) -> Column:
    """Sorted distinct candidates of the listing step: junk files and junk domains (exact) are left out."""
    found = F.transform(F.regexp_extract_all(text, F.lit(LISTING), F.lit(0)), lambda e: strip_chars(py_strip(e), ".,;:()[]<>\"'"))
    junk = lambda e: F.lower(e).rlike(f"({_any(JUNK_EXTENSIONS)})$") | F.lower(e).rlike(f"@({_any(JUNK_DOMAINS)})$")
    return F.array_sort(F.array_distinct(F.filter(found, lambda e: ~junk(e))))


def smallest(candidates: Column) -> Column:
    return F.array_min(candidates)


def labeled(emails: Column, most: int = MAX_LABELED) -> Column:
    """``email 1: a, email 2: b`` of the first addresses; empty for none."""
    pieces = F.transform(F.slice(emails, 1, most), lambda e, i: F.concat(F.lit("email "), (i + 1).cast("string"), F.lit(": "), e))
    return F.coalesce(F.array_join(pieces, ", "), F.lit(""))


def from_labeled(text: Column) -> Column:
    """The addresses of a labelled text, in its order."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(PLAIN), F.lit(0)), F.array().cast("array<string>"))


def decode_cloudflare(hexes: Column) -> Column:
    """Hex text whose first byte is the XOR key of all others; empty where it is not hex."""
    whole = F.length(hexes) - F.length(hexes) % 2
    key = F.conv(F.substring(hexes, 1, 2), 16, 10).cast("int")
    at = F.when(whole >= 4, F.sequence(F.lit(3), whole - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    letters = F.transform(at, lambda i: F.char(F.conv(F.substr(hexes, i, F.lit(2)), 16, 10).cast("int").bitwiseXOR(key)))
    return F.when(hexes.rlike("^[0-9a-fA-F]{2,}$"), F.array_join(letters, "")).otherwise(F.lit(""))
