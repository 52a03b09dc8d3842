"""Probe results, site states and challenge pages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import py_strip

#: The notes for status codes.
NOTES = {
    200: "OK", 201: "Created", 202: "Accepted", 204: "No Content",
    301: "Moved Permanently", 302: "Found", 303: "See Other", 304: "Not Modified", 307: "Temporary Redirect", 308: "Permanent Redirect",
    400: "Bad Request", 401: "Unauthorized", 403: "Forbidden", 404: "Not Found", 405: "Method Not Allowed", 408: "Request Timeout",
    409: "Conflict", 410: "Gone", 429: "Too Many Requests",
    500: "Internal Server Error", 501: "Not Implemented", 502: "Bad Gateway", 503: "Service Unavailable", 504: "Gateway Timeout",
}
#: Exceptions and their notes, and head codes that ask for a GET.
EXCEPTION_NOTES = {"Timeout": "Timeout", "SSLError": "SSL Error", "ConnectionError": "Connection Error", "TooManyRedirects": "Too Many Redirects", "InvalidURL": "Invalid URL"}
HEAD_REFUSED = [403, 405, 501]
#: Marks of pages that check visitors.
CHALLENGE_MARKS = [
    "checking the site connection security", "checking your browser before accessing",
    "just a moment", "please enable cookies", "ddos protection by", "attention required",
    "robot challenge", "sgcaptcha", "verifying you are human", "cf-chl", "__cf_chl",
    "human verification", "security check to access", "are you a human",
    "press and hold", "unusual traffic from your computer network",
]


def status_note(code: Column) -> Column:
    """The note for a code given as text: missing, not a number, known, or ``HTTP n``."""
    number = py_strip(code).try_cast("int")
    known = F.create_map(*[x for k, v in NOTES.items() for x in (F.lit(k), F.lit(v))])
    return (
        F.when(code.isNull(), "No Response")
        .when(number.isNull(), "Error")
        .otherwise(F.coalesce(F.try_element_at(known, number), F.concat(F.lit("HTTP "), number.cast("string"))))
    )


def final_code(head: Column, get: Column) -> Column:
    """The code that counts: of the GET where the HEAD was refused."""
    return F.when(head.isin(HEAD_REFUSED), get).otherwise(head)


def probe_outcome(url: Column, head: Column, get: Column, exception: Column) -> Column:
    """(code, note, available) of a probe, as text."""
    code = final_code(head, get)
    known = F.create_map(*[F.lit(x) for kv in EXCEPTION_NOTES.items() for x in kv])
    failed = F.coalesce(F.try_element_at(known, exception), F.concat(F.lit("Error: "), exception))
    as_struct = lambda c, n, a: F.struct(c.cast("string").alias("code"), n.alias("note"), a.alias("available"))
    return (
        F.when(url == "", as_struct(F.lit(None), F.lit("No URL"), F.lit("No")))
        .when(exception.isNotNull(), as_struct(F.lit("Error"), failed, F.lit("No")))
        .otherwise(as_struct(code, status_note(code.cast("string")), F.when(code < 400, "Yes").otherwise("No")))
    )


def is_available(c: Column) -> Column:
    return F.lower(py_strip(c)) == "yes"


def site_status(has_data: Column, error: Column) -> Column:
    return F.when(has_data, "completed").when(F.coalesce(error, F.lit("")) != "", "failed").otherwise("no_data")


def is_challenge(page: Column, url: Column) -> Column:
    marks = "|".join(CHALLENGE_MARKS)
    return F.coalesce(F.lower(page).rlike(marks), F.lit(False)) | F.coalesce(F.contains(F.lower(url), F.lit("sgcaptcha")), F.lit(False))
