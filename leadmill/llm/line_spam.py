"""Keyword-stuffed and link-list pages: texts dominated by few non-sentence line shapes.

Each line is reduced to a shape: its word count (in powers of two), its capitals, its
separators, its links and tags, its share of function words and whether sentences end in it.
Lines of one text are grouped by shape, each shape is judged once as a group, and a text is flagged if its FEW_SHAPES
largest non-sentence shapes hold more than half of its characters. A shape of less than GROUP_ITEMS words, tags and links in the
whole text (a heading, a menu line) is no such group.

Lines that end like sentences but hold hardly a function word are doubtful: if, taken together,
they say the same few words over and over, they are keywords with full stops between.
Function words tell prose without punctuation from strings of keywords. Lines in scripts other than Latin, whose function
words are not known here, are doubtful if separators cut them into short parts without a sentence's end.
Contact lines (numbers, mail, hours) and stray runs of characters count neither way but as part of the text; the rest of a line with
a stray run is judged by itself.

Defined results
---------------
* null, empty and blank texts, and texts with fewer than MIN_ITEMS words, tags and links in these shapes, are no cases;
* every row is judged by its own text, so repeats of a case are cases and row order does not matter;
* texts of any length are read whole, in time linear in the text;
* only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.session import spread

#: A text is a case beyond this share of its characters.
CASE_SHARE = 0.5
#: The few shapes whose characters count, and the least number of items of a shape in the text.
FEW_SHAPES, GROUP_ITEMS = 3, 4
#: Least number of words, tags and links in non-sentence shapes.
MIN_ITEMS = 12
#: Doubtful lines of that many words count as keywords if under this share of their words is distinct.
DOUBT_WORDS, DOUBT_DISTINCT = 25, 0.55
#: A longer word is a stray run of characters.
STRAY = 40
#: Function-word share under which a line of several words is no prose, and over which it is.
LOW_FUNCTION, HIGH_FUNCTION = 0.1, 0.15

#: Frequent function words of the Latin-script languages read here (fixed values). Those that
#: occur within search phrases ("near me", "cerca de", "in der") are left out.
FUNCTION_WORDS = frozenset(
    """
    the and is are was were be been being to a an of our we you your they their it its he she his her this that these
    those with for from on at by as or but not so if when while which who what how than then there here has have had
    do does did will would can could should may might must i us them all any each every some only also just still
    after before because about into over under
    der die das den dem des ein eine einen einem einer und ist sind war waren wird werden wir ihr sie er es ich nicht
    auch auf aus bei bis für mit nach nur oder sich um vom von vor wenn wie zu zum zur dass durch im am als noch
    el la los las un una unos unas y o que con por para su sus se es son fue era hay más muy nos nuestro nuestra
    usted si no al del lo le les como pero desde hasta entre sin sobre
    des une et ou est sont était dans par pour sur avec nous vous ils elles leur leurs son sa ses ce cette ces qui ne
    au aux du il elle mais même plus depuis sans
    """.split()
)
_SEARCH_PHRASE = re.compile(r"\b(?:in der nähe|near me|cerca de mí|près de chez moi)\b", re.IGNORECASE)
#: Patterns stop at a second opening mark, so that texts of opening marks alone are read in linear time.
_ANCHOR = r"<a\s[^<>\n]*>[^\n<]*</a>|!?\[[^\[\]\n]*\]\([^()\s]*(?:\([^()\s]*\))?[^()\s]*\)"
_HOST = r"(?<![@\w.\\-])[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}(?![\w@])(?:/\S*)?"
_LINK = re.compile(rf"{_ANCHOR}|https?://\S+|www\.\S+|{_HOST}", re.IGNORECASE)
#: Every link has one of these.
_LINK_SIGN = re.compile(r"</a>|\]\(|://|\w\.[a-z]{2}|www\.\S", re.IGNORECASE)
_RUN = re.compile(rf"[^\s,;|]{{{STRAY},}}")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+\w*")
_SEPARATOR = re.compile(r"\s*(?:[,;|•·/»>]|\s[-–—]\s)\s*")
_CONTACT = re.compile(r"@|\d[\d ().\-/]{6,}\d|\b\d{1,2}[:.]\d\d\b|\b(?:tel|fax|phone|e-?mail)\b", re.IGNORECASE)
_END = re.compile(r"[.!?…。！？।؟][\"”»)\]*]*(?:\s|$)")
_TAG = re.compile(r"(?:^|(?<=\s))#\w")
_PART_MARK = re.compile(r"[,;|•·、，，・/#]")
_FOREIGN = re.compile(r"[^\x00-ɏḀ-ỿ]")
_NAME_AND_CALL = re.compile(r"^\W*(?:[^\W\d_][\w'&.-]*\s+){1,6}[-–—:|]\s+\S+(?:\s\S+){0,2}\W*$")


class Shape(NamedTuple):
    words: int
    capitals: str
    separator: str
    link: str
    prose: str
    ends: bool


#: The shape of all lines of plain prose.
SENTENCES = Shape(0, "-", "none", "none", "high", True)


def _capitals(words: list[str]) -> str:
    if not words:
        return "-"
    upper = sum(w[0].isupper() for w in words)
    if all(w.isupper() for w in words):
        return "all"
    return "none" if not upper else "most" if upper * 2 > len(words) else "some"


def _prose(words: list[str], foreign: int) -> str:
    n = len(words)
    if foreign >= 3 or foreign * 2 > n > 0:
        return "foreign"
    low = [w for w in map(str.lower, words) if w in FUNCTION_WORDS]
    share = len(low) / n if n else 0.0
    if n >= 5 and (share >= HIGH_FUNCTION or (share >= LOW_FUNCTION and len(set(low)) >= 3)):
        return "high"
    return "low" if share < LOW_FUNCTION else "middle"


def shape_of(line: str) -> tuple[Shape, int, list[str], int]:
    """The shape of a stripped line that is not empty, its number of words, tags and links, its words, and its characters without stray runs."""
    links = _LINK.findall(line) if _LINK_SIGN.search(line) else []
    bare = _LINK.sub(" ", line) if links else line
    size = len(line)
    if len(bare) >= STRAY and (runs := _RUN.findall(bare)):
        size -= sum(map(len, runs))
        bare = _RUN.sub(" ", bare)
        if not links:
            line = bare.strip()
    rest = _SEARCH_PHRASE.sub(" ", bare)
    words = _WORD.findall(rest)
    n = len(words)
    foreign = sum(1 for w in words if _FOREIGN.search(w)) if _FOREIGN.search(rest) else 0
    prose = _prose(words, foreign)
    tags = len(_TAG.findall(line)) if "#" in line else 0
    if prose == "high" and not links and tags < 3:
        return SENTENCES, n, words, size
    linked = sum(map(len, links))
    items = n + len(links)
    if linked * 2 > size and foreign < 3:
        link = "only"
    elif tags >= 3 and tags * 2 >= len(line.split()):
        link = "tags"
    elif links and _NAME_AND_CALL.match(bare.split("(")[0]):
        link = "name"
    elif links and len(links) * 8 >= n:
        link = "mixed"
    else:
        link = "some" if links else "none"
    parts = [p for p in (_PART_MARK if prose == "foreign" else _SEPARATOR).split(rest) if p.strip()]
    if len(parts) >= 4 and n <= 6 * len(parts):
        separator = "many"
    elif link == "none" and _NAME_AND_CALL.match(line.split("(")[0]):
        separator = "name"
    else:
        separator = "none"
    ends = bool(_END.search(rest)) and n <= 45 * len(_END.findall(rest))
    if link == "none" and _CONTACT.search(line):
        link = "contact"
    if link == "none" and sum(map(len, words)) * 4 < size or not size:
        link = "stray"
    said = [p.strip() for p in parts] if prose == "foreign" else words
    return Shape(n.bit_length(), _capitals(words), separator, link, prose, ends), items, said, size


def is_list(shape: Shape) -> bool:
    """Whether a shape is one of keywords, tags, names with links or links, and not of sentences."""
    if shape.prose == "foreign":
        return shape.link in ("only", "tags")
    if shape.link in ("only", "tags", "name"):
        return True
    if shape.prose == "high" or shape.ends or shape.link in ("contact", "stray"):
        return False
    if shape.link == "mixed" or shape.separator in ("many", "name"):
        return shape.prose == "low"
    return shape.prose == "low" and shape.words > 0


def is_doubtful(shape: Shape) -> bool:
    """Whether a shape ends like a sentence without the function words of one, or is cut up in another script."""
    if shape.link not in ("none", "some"):
        return False
    if shape.prose == "foreign":
        return shape.separator == "many" and not shape.ends
    return shape.ends and shape.prose == "low"


def judge(text: str | None) -> tuple[float, int]:
    """The share of characters in the few largest list shapes, and the number of items in them."""
    if not text:
        return 0.0, 0
    total = 0
    groups: dict[tuple, list[int]] = {}
    doubtful: dict[tuple, list[int]] = {}
    said: list[str] = []
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        total += len(line)
        shape, found, words, size = shape_of(line)
        if is_list(shape):
            group = groups.setdefault((shape.separator, shape.link), [0, 0])
        elif is_doubtful(shape):
            group = doubtful.setdefault(("doubtful", shape.prose), [0, 0])
            said += map(str.lower, words)
        else:
            continue
        group[0] += size
        group[1] += found
    if len(said) >= DOUBT_WORDS and len(set(said)) < DOUBT_DISTINCT * len(said):
        groups |= doubtful
    largest = sorted((g for g in groups.values() if g[1] >= GROUP_ITEMS), reverse=True)[:FEW_SHAPES]
    return (sum(g[0] for g in largest) / total if total else 0.0), sum(g[1] for g in largest)


def is_case(text: str | None) -> bool:
    share, items = judge(text)
    return share > CASE_SHARE and items >= MIN_ITEMS


def find_line_spam(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id) of each row whose text is a case: one narrow pass in Arrow batches, without a shuffle."""
    slim = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([is_case(t) for t in batch.column(1).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep)], names=[id_col])

    return spread(slim).mapInArrow(run, f"`{id_col}` bigint")
