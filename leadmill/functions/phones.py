"""Country hints and phone formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.text import let, py_strip

#: Dummy numbers, Canadian area codes, provinces, states.
DUMMIES = ["2597462153", "26921562148", "310259121563", "1234567890", "0000000000", "9999999999", "1111111111", "1234567"]
CANADIAN_AREA_CODES = [
    "204", "226", "236", "249", "250", "289", "306", "343", "354", "365", "367", "382", "403", "416", "418", "431", "437", "438", "450", "506",
    "514", "519", "548", "579", "581", "584", "587", "604", "613", "639", "647", "672", "705", "709", "742", "753", "778", "780", "782", "807",
    "819", "825", "867", "873", "879", "902", "905",
]
PROVINCES = [
    "AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT",
]
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
INDIA = r"(?i)\bindia\b"
CANADA = rf"(?i)\bcanada\b|,\s*(?:{'|'.join(PROVINCES)})\b|\b[A-Za-z]\d[A-Za-z]\s?\d[A-Za-z]\d\b"
USA = rf"(?i)\b(?:usa|united states)\b|,\s*(?:{'|'.join(STATES)})\s*\d{{5}}"
CANDIDATE = r"(?:\+?\d{1,4}[-.\s]?)?\(?\d{2,5}\)?[-.\s]?\d{3,4}[-.\s]?\d{3,4}\b"
CODES = {"in": "91", "ca": "1", "us": "1"}


def country_hint(context: Column, domain: Column) -> Column:
    """IN, CA or US by domain or text, in this order; null without a sign."""
    text, host = F.coalesce(context, F.lit("")), F.lower(F.coalesce(domain, F.lit("")))
    return (
        F.when(host.endswith(".in") | text.rlike(INDIA), "IN")
        .when(host.endswith(".ca") | text.rlike(CANADA), "CA")
        .when(host.endswith(".us") | text.rlike(USA), "US")
    )


def clean_phone(phone: Column, hint: Column, fallback: str = "ca") -> Column:
    """A number with its country code, formatted; null for what is no number.

    The rules and their quirks are kept: dummy numbers match as parts, numbers that begin like
    a year and month are dropped, British numbers count with 11 digits only.
    """
    default = F.lit("+" + CODES.get(fallback, "91"))

    def code(number: Column) -> Column:
        area = F.left(number, F.lit(3)).isin(CANADIAN_AREA_CODES)
        return F.when(hint == "IN", "+91").when(hint.isin("CA", "US") | area, "+1")

    def zero(d: Column) -> Column:
        local = F.substr(d, F.lit(2))
        return F.when(d.startswith("0") & (F.length(d) == 11), F.concat(F.coalesce(code(local), default), local)).otherwise(d)

    def full(d: Column) -> Column:
        ten = F.coalesce(code(d), F.when(d.rlike("^[2-9]"), default))
        return (
            F.when(d.startswith("+"), d)
            .when(F.length(d) == 10, F.concat(ten, d))
            .when(d.rlike(r"(?s)^(1.{10}|91.{10}|44.{9})$"), F.concat(F.lit("+"), d))
        )

    def shown(d: Column) -> Column:
        british_or_other = F.when(d.rlike(r"(?s)^\+.{7,15}$") & ~d.rlike(rf"^\+(19|20)\d{{2}}(0[1-9]|1[0-2])|^\+.*({'|'.join(DUMMIES)})"), d)
        american = F.regexp_replace(british_or_other, r"(?s)^\+1(.{3})(.{3})(.{4})$", r"+1 ($1) $2-$3")
        return F.regexp_replace(american, r"(?s)^\+91(.{5})(.{5})$", r"+91 $1 $2")

    bare = py_strip(F.regexp_replace(py_strip(phone), "(?i)^(tel:|phone:|call:|call us:)", ""))
    digits = F.regexp_replace(F.regexp_replace(bare, r"(?U)[^\d+]", ""), "^00", "+")
    return let(digits, lambda a: let(zero(a), lambda b: let(full(b), shown)))


def with_clean_phone(df: DataFrame, phone: str, hint: str, out: str, fallback: str = "ca") -> DataFrame:
    return df.withColumn(out, clean_phone(F.col(phone), F.col(hint), fallback))


def candidates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def from_script(text: Column) -> Column:
    """Numbers under phone keys of a script."""
    return F.regexp_extract_all(text, F.lit(r'(?i)(?:phone|telephone|mobile)\s*:\s*"([^"]{5,30})"'), F.lit(1))


def recheck_table(df: DataFrame, id_col: str, phone: str, hint: str, fallback: str = "ca") -> DataFrame:
    """(id, phone, fixed): stored lists of numbers with their country codes derived anew; numbers that
    are not local stay, repeats fall away, the order is kept."""
    numbers = F.filter(F.transform(F.split(F.col(phone), ","), py_strip), lambda p: p != "")
    each = df.select(id_col, phone, hint, F.posexplode_outer(numbers).alias("__at", "__num"))
    digits = F.col("__digits")
    bare = (
        F.when(digits.startswith("91") & (F.length(digits) == 12), F.substr(digits, F.lit(3)))
        .when(digits.startswith("1") & (F.length(digits) == 11), F.substr(digits, F.lit(2)))
        .otherwise(digits)
    )
    each = each.withColumn("__digits", F.regexp_replace("__num", r"(?U)[^\d]", "")).withColumn("__bare", bare)
    each = with_clean_phone(each, "__bare", hint, "__clean", fallback)
    fixed = F.when(F.length("__bare") == 10, F.coalesce("__clean", "__num")).otherwise(F.col("__num"))
    listed = each.groupBy(id_col, phone).agg(F.array_sort(F.collect_list(F.when(F.col("__num").isNotNull(), F.struct("__at", fixed.alias("n"))))).alias("l"))
    return listed.select(id_col, phone, F.array_join(F.array_distinct(F.transform("l", lambda x: x["n"])), ", ").alias("fixed"))
