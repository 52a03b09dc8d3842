"""Split fields that hold several values into one row per value, with its place.

A finite-state tokenizer walks the text once. It tracks quoting (double or single
list quotes, doubled quotes, backslash escapes), the nesting depth of brackets and the next
number of a numbered list, and cuts only at delimiters outside of quotes and brackets. All cuts are made by it: delimiters
are characters, connective words between phone numbers, labels of sites and numbers of a list. Dress that is not
part of the value (labels, list quotes, remarks after a phone number) is taken off after
the cut, so that every value keeps its ordinal in the field. Time is linear in the text.

Defined results
---------------
* null, blank and sentinel fields (``Not available``, ``N/A``, ``-``; any case) and
  empty pieces give no rows; a value given twice gives two rows;
* an unclosed quote is an ordinary character; texts of any length are read whole;
* only the columns named are read, so other columns, whatever their names, do not matter;
* an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINELS = frozenset({"", "not available", "n/a", "-", "–", "—"})

_OPEN, _CLOSE = "([{", ")]}"


def tokenize(
    text: str,
    is_delimiter: Callable[[str, int, int], int],
    single_quotes: bool = False,
    taken: Callable[[str, int], int] | None = None,
) -> list[tuple[str, bool]]:
    """Cut ``text`` at delimiters outside quotes and brackets.

    ``is_delimiter(text, i, depth)`` gives the length of a delimiter at ``i`` or 0, ``taken(text, i)`` the length of what is
    part of a piece whatever it holds. A quote opens a quoted value only at the start of a piece, and only if its
    closing quote is followed by a delimiter or the end. Gives (piece, was quoted).
    """
    pieces: list[tuple[str, bool]] = []
    start, i, depth, n = 0, 0, 0, len(text)
    blank = True
    closing = {c: text.rfind(c) for c in _CLOSE}
    #: quotes of a kind that no closing one follows, wherever they stand from here on
    unclosed: set[str] = set()
    while i < n:
        c = text[i]
        if blank and c not in unclosed and (c == '"' or (single_quotes and c == "'")):
            value, end = _quoted(text, i, c, is_delimiter)
            if end > 0:
                pieces.append((value, True))
                i = end
                while i < n and text[i].isspace() and not is_delimiter(text, i, 0):
                    i += 1
                i += is_delimiter(text, i, 0) if i < n else 0
                start, depth, blank = i, 0, True
                continue
            if end < 0:
                unclosed.add(c)
        if taken is not None and (size := taken(text, i)):
            i += size
            blank = False
            continue
        if c in _OPEN:
            # an opening bracket without its closing one does not nest
            if closing[_CLOSE[_OPEN.index(c)]] > i:
                depth += 1
        elif c in _CLOSE:
            depth = max(0, depth - 1)
        size = is_delimiter(text, i, depth)
        if size:
            pieces.append((text[start:i], False))
            i += size
            start, depth, blank = i, 0, True
        else:
            blank = blank and c.isspace()
            i += 1
    pieces.append((text[start:], False))
    return pieces


def _quoted(text: str, i: int, quote: str, is_delimiter: Callable[[str, int, int], int]) -> tuple[str, int]:
    """The value quoted from ``i`` on and the place behind it; the place is 0 if this quote opens no value, -1 if no later one does."""
    out: list[str] = []
    j, n = i + 1, len(text)
    while j < n:
        c = text[j]
        if c == "\\" and j + 1 < n and text[j + 1] in (quote, "\\"):
            out.append(text[j + 1])
            j += 2
        elif c == quote:
            if quote == '"' and j + 1 < n and text[j + 1] == quote:
                out.append(quote)
                j += 2
                continue
            k = j + 1
            while k < n and text[k].isspace() and not is_delimiter(text, k, 0):
                k += 1
            if k >= n or is_delimiter(text, k, 0):
                return "".join(out), j + 1
            if quote == '"':
                return "", 0
            out.append(c)
            j += 1
        else:
            out.append(c)
            j += 1
    return "", -1


def _given(value: str) -> bool:
    return value.casefold() not in SENTINELS


# --- e-mail ---------------------------------------------------------------

#: Characters that no bare address holds: each ends a piece.
_EMAIL_ENDS = frozenset(" \t\n\r\x0b\x0c<>(),;:|[]\\/&")
#: A quoted local part belongs to its address.
_QUOTED_LOCAL = re.compile(r'"(?:[^"\\]|\\.)*"(?=@)')
#: A quoted display name, which may itself hold an address, in front of one in angle brackets.
_DISPLAY_NAME = re.compile(r"\s*<")


def _email_delimiter(text: str, i: int, depth: int) -> int:
    c = text[i]
    return 1 if c in _EMAIL_ENDS or c.isspace() else 0


def _quoted_local(text: str, i: int) -> int:
    m = _QUOTED_LOCAL.match(text, i) if text[i] == '"' else None
    return m.end() - i if m else 0


def split_emails(text: str) -> list[str]:
    """Bare addresses in the order written. Names, quoted or not, labels, schemes and
    angle brackets fall away: each piece between delimiters is an address or none."""
    # the place behind a quoted name tells whether an address in angle brackets follows
    bare = _NAME_AHEAD.sub(" ", text)
    values: list[str] = []
    for piece, quoted in tokenize(bare, _email_delimiter, single_quotes=True, taken=_quoted_local):
        values += split_emails(piece) if quoted and piece != text else _address(piece)
    return values


_NAME_AHEAD = re.compile(r'"(?:[^"\\]|\\.|"")*"\s*(?=<)')


def _address(piece: str) -> list[str]:
    """The address a piece is, in a list; a second @ or a question mark ends it."""
    at = piece.rfind('"@') + 1 if piece.startswith('"') and '"@' in piece else piece.find("@")
    if at <= 0:
        return []
    local, domain = piece[:at], re.split(r"[?@\"]", piece[at + 1 :], maxsplit=1)[0]
    if not local.startswith('"'):
        local = local.rpartition('"')[2]
    value = f"{local}@{domain}".strip("'`.").lstrip("-=*•")
    return [value] if local and domain and "@" in value and not value.startswith("@") else []


# --- phone ----------------------------------------------------------------

_EXTENSION = r"(?:ext(?:ension|n)?|x|durchwahl|dw|poste|anexo)"
_REMARK = re.compile(r"(?<!\s)\s*+[(\[][^()\[\]]*[^\W\d_][^()\[\]]*[)\]]\s*")
_WORD_BETWEEN = re.compile(
    rf"(?<=[\d)\]])\s*(?:&|\+(?=\s)|(?<=[\s\d)\]])(?!{_EXTENSION}\b\.?|x\d)[^\W\d_][^\W\d_.\-]*(?:[ \-][^\W\d_]+)*)"
    r"\.?(?:\s*\d{1,2}\s*(?=:))?\s*:?\s*(?=[+(\d])",
    re.IGNORECASE,
)
#: Whole numbers without inner spaces may be set apart by a space alone.
_COMPACT = re.compile(r"(?<=\d{9})\s+(?=\+?\d{9}|\+\d{1,3}[\s(.-]|\(\d)")
_LEAD, _LETTER, _ENDS_LABEL = re.compile(r"[^\d+(]*"), re.compile(r"[^\W\d_]"), re.compile(r"\d{1,2}\s*:\s*")
_PHONE_VALUE = re.compile(rf"^[+(\d].*?\d(?=[^\d]*$)|^[+(\d].*{_EXTENSION}\.?\s*\d+", re.IGNORECASE | re.DOTALL)


_REMARK_BEHIND = re.compile(r"(?<=[)\]])\s+(?=\+?\d{9}|\+\d{1,3}[\s(.-]|\(\d)")
_WHOLE = re.compile(r"\d{9}\s*$")


def _behind_remark(text: str, i: int) -> int:
    """The white space at ``i`` between a remark behind a whole number and the next number, else 0."""
    if i == 0 or text[i - 1] not in ")]":
        return 0
    m = _REMARK_BEHIND.match(text, i)
    start = max(text.rfind("(", 0, i), text.rfind("[", 0, i)) if m else -1
    if start <= 0 or not _LETTER.search(text, start, i):
        return 0
    end = start
    while end > 0 and text[end - 1].isspace():
        end -= 1
    return m.end() - i if end >= 9 and _WHOLE.match(text, end - 9, end) else 0


def _digits_about(text: str, i: int, step: int) -> int:
    """Digits from ``i`` on in one direction up to a delimiter or a word."""
    count, j = 0, i
    while 0 <= j < len(text) and text[j] not in ",;|\n\t/&" and not text[j].isalpha():
        count += text[j].isdigit()
        j += step
    return count


def _phone_delimiter(text: str, i: int, depth: int) -> int:
    c = text[i]
    if depth:
        return 0
    if c in ",;|\n\t•":
        return 1
    if (c.isspace() or c in "&+" or c.isalpha()) and (m := _WORD_BETWEEN.match(text, i) or _COMPACT.match(text, i)):
        return m.end() - i
    if c.isspace() and (size := _behind_remark(text, i)):
        return size
    if c == "/":
        if text[i : i + 2] == "//":
            return 2
        before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
        if not before or not after or before.isspace() or after.isspace():
            return 1
        if _digits_about(text, i - 1, -1) >= 7 and _digits_about(text, i + 1, 1) >= 7:
            return 1
    if c == "<" and (m := _BREAK.match(text, i)):
        return m.end() - i
    return 0


def _without_label(part: str) -> str:
    """A part without what stands in front of its number: a label up to its colon (with a number of one or two digits), else all that is no number."""
    lead = _LEAD.match(part).group()
    letter = _LETTER.search(lead)
    if letter is not None:
        colon = lead.find(":", letter.end())
        if colon >= 0:
            return part[colon + 1 :].lstrip()
        if m := _ENDS_LABEL.match(part, len(lead)):
            return part[m.end() :]
    return part[len(lead) :]


def split_phones(text: str) -> list[str]:
    """Numbers in the order written, with their extensions, without labels and remarks."""
    values: list[str] = []
    for piece, _ in tokenize(text, numbered(text, _phone_delimiter), single_quotes=True):
        part = _without_label(_REMARK.sub(" ", piece).strip())
        if m := _PHONE_VALUE.match(part):
            values.append(m.group().strip())
    return values


# --- address --------------------------------------------------------------

_BREAK = re.compile(r"<\s*br\s*/?\s*>", re.IGNORECASE)
#: What a site may be called in front of its address.
_SITE = (
    r"(?:(?:head|main|branch|registered|postal|billing|site|sales|regional)\s+)?"
    r"(?:office|showroom|warehouse|workshop|branch|yard|depot|store|shop|studio|factory|headquarters|hq|plant|"
    r"clinic|location|address|site|main|postal|mailing|billing|shipping|visit|visitors|b(?:ü|ue)ro|filiale|lager|"
    r"werkstatt|zentrale|hauptsitz|standort|adresse|oficina|taller|almac[eé]n|direcci[oó]n|bureau|atelier|entrep[oô]t|si[eè]ge)"
)
_SITE_LABEL = re.compile(rf"^\s*{_SITE}(?:\s*(?:no\.?\s*)?#?\d{{1,2}})?\s*(?::\s*|\s[-–—]\s+)", re.IGNORECASE)
_SITE_AHEAD = re.compile(
    r"(?<!head)(?<!main)(?<!branch)(?<!registered)(?<!postal)(?<!billing)(?<!site)(?<!sales)(?<!regional)"
    rf"(?:(?:,|(?<!\s)\s)\s*+(?={_SITE}(?:\s*#?\d{{1,2}})?\s*:\s)|,\s*+(?={_SITE}\s[-–—]\s))",
    re.IGNORECASE,
)
_MARK = re.compile(r"(?:^|(?<=[\s;|,]))(?:\(([1-9]\d*)\)|([1-9]\d*)\))\s+")


@lru_cache(maxsize=4)
def _edges(text: str) -> tuple[int, int]:
    """The first and the last place of a text that is no white space."""
    return len(text) - len(text.lstrip()), len(text.rstrip()) - 1


def _address_delimiter(text: str, i: int, depth: int) -> int:
    c = text[i]
    if c == "<" and (m := _BREAK.match(text, i)):
        return m.end() - i
    if depth:
        return 0
    if c in "|;•\t":
        return 1
    if (c == "," or c.isspace()) and (m := _SITE_AHEAD.match(text, i)):
        return m.end() - i
    if c == "\n":
        # a line break behind a comma is inside one address
        k = i - 1
        while k >= 0 and text[k] in " \t\r":
            k -= 1
        return 0 if k >= 0 and text[k] == "," and _edges(text)[1] > i else 1
    if c == "/":
        before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
        if not before or not after or (before.isspace() and (after.isspace() or after == "/")):
            return 1
        if after.isspace() and not before.isdigit():
            return 1
        first, last = _edges(text)
        if before == "/" or last <= i or first >= i:
            return 1
    return 0


def _comma_between_quotes(text: str, i: int, depth: int) -> int:
    return 1 if text[i] == "," else _address_delimiter(text, i, depth)


def numbered(text: str, is_delimiter: Callable[[str, int, int], int]) -> Callable[[str, int, int], int]:
    """A delimiter that also cuts at the numbers 1), 2), 3) of a list, if the text starts with the first of them."""
    first = _MARK.match(text, len(text) - len(text.lstrip(" ;|,\n\t")))
    if first is None or (first.group(1) or first.group(2)) != "1":
        return is_delimiter
    places = {first.start(): first.end()}
    expected = 2

    def cut(text: str, i: int, depth: int) -> int:
        nonlocal expected
        if i in places:
            return places[i] - i
        if text[i] in "(123456789" and (m := _MARK.match(text, i)) and int(m.group(1) or m.group(2)) == expected:
            places[i] = m.end()
            expected += 1
            return m.end() - i
        return is_delimiter(text, i, depth)

    return cut


def split_addresses(text: str) -> list[str]:
    """Addresses in the order written; remarks inside an address stay."""
    values: list[str] = []
    bare = text.strip()
    if bare[:1] in "\"'" and len(bare) > 1:
        pieces = tokenize(text, _comma_between_quotes, single_quotes=True)
        # commas cut only a list of quoted values; otherwise they belong to the address
        if any(not quoted and p.strip() for p, quoted in pieces):
            pieces = tokenize(text, _address_delimiter, single_quotes=True)
    else:
        pieces = tokenize(text, numbered(text, _address_delimiter))
    for piece, quoted in pieces:
        value = _SITE_LABEL.sub("", piece, count=1).strip()
        value = value.strip().rstrip(",").rstrip() if not quoted else value
        value = re.sub(r"^(?:[•*|]|-(?=\s))\s*", "", value)
        if value.strip("/|;,• ") and _given(value):
            values.append(value)
    return values


SPLITTERS: dict[str, Callable[[str], list[str]]] = {
    "email": split_emails,
    "phone": split_phones,
    "address": split_addresses,
}


def split_field(field: str, text: str | None) -> list[str]:
    """The values of one field."""
    if text is None or not _given(text.strip()):
        return []
    return [v for v in SPLITTERS[field](text) if _given(v)]


def unpack_fields(df: DataFrame, id_col: str = "id", fields: dict[str, str] | None = None) -> DataFrame:
    """One row (id, field, pos, value) for each value of the packed fields.

    ``fields`` maps a column to its grammar: email, phone or address. One narrow pass over
    the scan in Arrow batches, without a shuffle.
    """
    grammar = fields or {"email": "email", "phone": "phone", "address": "address"}
    names = list(grammar)
    slim = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        *[F.col(f"`{c}`").cast("string").alias(f"f{k}") for k, c in enumerate(names)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out_id, out_field, out_pos, out_value = batch.column(0).to_pylist(), [], [], [], []
            for k, name in enumerate(names):
                for i, text in zip(ids, batch.column(k + 1).to_pylist()):
                    for pos, value in enumerate(split_field(grammar[name], text), 1):
                        out_id.append(i)
                        out_field.append(name)
                        out_pos.append(pos)
                        out_value.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_id, pa.int64()),
                    pa.array(out_field, pa.string()),
                    pa.array(out_pos, pa.int64()),
                    pa.array(out_value, pa.string()),
                ],
                names=["id", "field", "pos", "value"],
            )

    return slim.mapInArrow(run, "id bigint, field string, pos bigint, value string")
