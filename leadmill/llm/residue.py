"""Template residue and error-page text: unfilled slots, filler, error pages and script notices.

Records are the sentences of pages' main content and of a crawl's error messages. Their templates are mined by
a prefix tree of fixed depth over the whole corpus:

1. one narrow pass reads each page into its records; a token with digits, paths, hosts or slot marks is a wildcard
   at once, and equal records are counted within the task, then over the cluster;
2. a leaf of the tree holds the records of one number of tokens and the same first tokens. Records are taken from
   the most to the least frequent; one that agrees with a template in SIMILAR of its places joins it, and places in which
   they differ become wildcards. Leaves of more than LEAF_RECORDS distinct records are cut into parts by a hash
   of the record, and the parts' templates are merged in the leaf;
3. each merged template is classified once: by what its most frequent record says, or by where it stands: a template
   found on SPREAD_HOSTS hosts or more, hardly ever beside other content, stands in place of pages;
4. the verdicts that are not ordinary go back to the records, and from these to their pages, by joins on the records' hashes.

Slots left unresolved inside ordinary records are found separately, in the record itself.

A page is a case if its body has a slot or filler anywhere, or if its body consists of an error
page or a notice about scripts. An error message is a case if it has a slot, is filler, or is
what an error page says to visitors; a crawler's diagnosis is none.

Defined results
---------------
* null, empty and blank fields are no cases; neither is a page of chrome alone;
* texts of any length are read whole; repeated rows are judged one by one;
* records as frequent are taken in alphabetical order, so templates do not depend on partitions or on the order of rows;
* only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from leadmill.llm.gates import Gate
from leadmill.llm.joins import meet
from leadmill.llm.page_lines import CHROME, kind_of, plain
from leadmill.session import materialize, spread

# --- slots ------------------------------------------------------------------

_NAME = r"[A-Za-z_][\w.]*"
#: Real HTML elements are no slots.
_HTML = frozenset(
    "a abbr b body br button center code div em font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input "
    "li link main meta nav ol p pre script section small span strong style sub sup table tbody td th title tr u ul".split()
)
_SLOT = re.compile(
    rf"\{{\{{\s*{_NAME}(?:\s*\|\s*\w+)?\s*\}}\}}|\{{%-?\s*{_NAME}\s*-?%\}}|<%=?\s*{_NAME}\s*%>|[$#]?\{{\$?{_NAME}\}}"
    rf"|%%{_NAME}%%|@@{_NAME}@@|__[A-Za-z]\w*?__|#[A-Z][A-Z0-9_]*#|%[A-Za-z][\w.]*%|%\(\w+\)[sdrif]|\$[a-z_]\w*\b"
    rf"|\[\[\s*{_NAME}\s*\]\]|\b[A-Z]+(?:_[A-Z]+)*_(?:GOES_)?HERE\b|\*\|\w+\|\*|\[%\s*{_NAME}\s*%\]|\$\[{_NAME}\]|\(\(\s*{_NAME}\s*\)\)|~{_NAME}~"
    r"|\b(?:YOUR|INSERT|ENTER|ADD)(?: [A-Z0-9]+){1,4} HERE\b"
)
#: Quoted in guillemets, only names of what a template asks for are slots.
_GUILLEMETS = re.compile(r"[«‹]\s*([A-Za-z][\w.]*(?:[ _][\w.]+){0,2})\s*[»›]")
_SLOT_NAMES = frozenset(
    """name phone telephone email mail city suburb town state country address street postcode zip title owner tagline slogan service product company business
    site contact herotext hero year founded date url link text logo headline heading subtitle description image price category number first last reason status
    code message error host target seconds exception detail website domain brand location region""".split()
)
_PRINTF = re.compile(r"(?<![\w%])%[sdr](?!\w)")
_BRACKETS = re.compile(r"\[+([^\[\]\n]{1,60})\](?!\()")
_ANGLES = re.compile(r"<([^<>\n]{1,60})>")
_IDENTIFIER = re.compile(r"[a-z]+(?:[._][a-zA-Z0-9]+)*$|[a-z]+[A-Z]\w*$|[A-Z]+(?:_[A-Z0-9]+)+$")
_ASKED = re.compile(r"^(?:insert|your|enter|add|describe|type|name of|put|fill in|replace|ihr|ihre|su|tu|votre|hier|aquí|ici)\b.*|.*\bhere$", re.IGNORECASE)
_NO_SLOT = frozenset("sic edit note notes citation x link image video photo optional".split())
#: A slot that the sentence talks about, in place of a value.
_MENTION = re.compile(
    r"(?:\b(?:such as|like|e\.g\.|for example|named|called|tags?|placeholders?|variables?|tokens?|reads?|literally|wie|etwa|como|comme)\b[^.!?]{0,25}|[`\"“'„«])$", re.IGNORECASE
)


def has_slot(text: str) -> bool:
    """Whether a text holds a slot nobody filled."""
    if not ("{" in text or "%" in text or "[" in text or "<" in text or "@@" in text or "__" in text or "#" in text or "$" in text or "HERE" in text or "«" in text or "‹" in text or "|*" in text or "((" in text or "~" in text):
        return False
    for pattern in (_SLOT, _PRINTF):
        for m in pattern.finditer(text):
            if not _MENTION.search(text[: m.start()]):
                return True
    for m in _GUILLEMETS.finditer(text):
        if not _SLOT_NAMES.isdisjoint(re.findall(r"[a-z]+", m.group(1).lower())) and not _MENTION.search(text[: m.start()]):
            return True
    for m in _BRACKETS.finditer(text):
        inner = m.group(1).strip()
        if (_IDENTIFIER.match(inner) and inner.lower() not in _NO_SLOT) or _ASKED.match(inner):
            if not _MENTION.search(text[: m.start()]):
                return True
    for m in _ANGLES.finditer(text):
        inner = m.group(1).strip()
        if (_IDENTIFIER.match(inner) and inner.lower() not in _HTML) or _ASKED.match(inner):
            if not _MENTION.search(text[: m.start()]):
                return True
    return False


# --- verdicts on templates --------------------------------------------------

#: Words of the customary Latin dummy text (fixed values).
_LATIN = frozenset(
    """lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et
    dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute
    irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa
    qui officia deserunt mollit anim id est laborum massa lacinia eros nunc congue viverra pretium sagittis turpis vestibulum tellus
    augue ornare felis rutrum varius semper dictum porta mauris lectus metus posuere mattis ullamcorper mollis etiam venenatis malesuada
    purus euismod integer donec cras aenean ante auctor fringilla bibendum dapibus fermentum erat nec ac at vel eget vitae nibh orci
    risus justo libero pellentesque morbi tristique senectus netus fames egestas proin suspendisse phasellus curabitur praesent aliquam
    vivamus faucibus volutpat ligula leo diam urna enim neque odio sapien sem tortor ultrices ultricies""".split()
)
_FILLER_WORDS = re.compile(
    r"\bdummy (?:text|copy|content)\b|\bplaceholder (?:text|copy|content|image)\b|\b(?:sample|example|demo) (?:paragraph|text|content|testimonial|heading|page|post)\b"
    r"|\b(?:text ){2,}text\b|\b(?:bla[ ,.]+){2,}|\b(?:blah[ ,.]+){2,}|\bfoo bar\b|\basdf\b|\bqwerty\b|\b(?:test[ ,.]+){2,}(?:\S+ )?test\b|^(?:test ?){2,}$"
    r"|\b(?:sub)?title goes here\b|\bgoes here\b|\b(?:feature|service|product|section|slide|card) (?:title|heading|name) (?:one|two|three|\d|<\*>)|\bshort text that\b"
    r"|\bwaiting for (?:content|text)\b|\bdouble-?click to\b|\bclick (?:here )?to edit\b|\bedit this (?:block|text|area|section|column|paragraph|page|post)\b"
    r"|\bthis (?:block|area|section|column|paragraph|text) (?:is (?:a|for|reserved|empty|waiting)|to )|\buse this (?:block|area|section|column|space|paragraph)\b"
    r"|\bthis is (?:a|your|the) (?:very )?(?:first|sample|example|default|demo|placeholder|test)\b|\bedit or (?:remove|delete) it\b|\bstart writing\b|\b(?:hello,? )(?:world|new site)\b"
    r"|\breplace (?:it|this) with (?:a|your)\b|\breplace the (?:demo|sample|placeholder|dummy)\b|\bbefore you publish\b|\bmax\. (?:<\*>|\d+) (?:characters|words|zeichen|caracteres|caractères)\b"
    r"|^(?:please )?(?:add|enter|insert|put|write|type|place|paste) (?:a|an|the|your|some|three|two|few|<\*>)\b.*\b(?:here|(?:this|the) (?:column|block|area|section|box|field|page)|publish|characters|demo text|choose you|your (?:shop|team|company|business|visitors|customers))\b"
    r"|^(?:enter|insert|add|type) (?:error )?(?:text|title|heading|content|message|description)\b|^(?:add|enter|insert) (?:a|your) (?:sub)?(?:heading|title|text|caption|tagline|headline)\b"
    r"|^describe (?:your|the|this)\b.*\b(?:sentences?|here|words|service|business|product)\b|^keep it short\b|\btell (?:your )?visitors what you do\b|\bmake it catchy\b|^your (?:text|headline|title|subtitle|heading|logo|slogan|content|message) (?:goes )?here\b"
    r"|\b(?:hier steht (?:ihr|der|dein) text|ihr text hier|hier (?:kommt|folgt) (?:ihr|der)|blindtext|platzhalter(?:text)?|fügen sie hier|geben sie hier|beispieltext|mustertext)\b"
    r"|\b(?:escriba aquí|texto de (?:ejemplo|relleno|muestra)|su texto aquí|aquí va (?:su|el)|añada aquí|introduzca aquí|inserte aquí)\b"
    r"|\b(?:votre texte ici|texte d'exemple|texte de remplissage|insérez ici|saisissez ici|écrivez ici|ajoutez ici|ici votre texte|faux texte)\b"
    r"|^\W*(?:tbd|tba|todo|to do|n\.n\.)\W*$|\bcoming soon\b.*\btext\b|\bcontent (?:will go|goes) here\b",
    re.IGNORECASE,
)
#: One letter or word of one letter over and over.
_FILLER_LETTERS = re.compile(r"^([a-z])\1*(?:[ ,.;:]+\1+){3,}\W*$|^x{3,}\b.*\bx{3,}\b", re.IGNORECASE)
_FILLER = re.compile(f"{_FILLER_WORDS.pattern}|{_FILLER_LETTERS.pattern}", re.IGNORECASE)
#: What a page says to visitors whose browser runs no scripts or is being checked.
_SCRIPTS = r"(?:java ?scripts?|scripts?|scripting|cookies)"
_NOTICE = re.compile(
    rf"\b(?:enable|activate|allow|unblock|turn on|switch on|permit)\b[^.!?]{{0,30}}\b{_SCRIPTS}\b|\b{_SCRIPTS}\b[^.!?]{{0,40}}\b(?:must be|needs? to be|has to be|is required|are required|is needed)\b"
    rf"|\b(?:requires?|needs?|without) {_SCRIPTS}\b|^{_SCRIPTS} (?:is|are) (?:blocked|disabled|turned off)\b|\bhas (?:scripting|{_SCRIPTS}) turned off\b|\bscripting turned off\b|\bmay not support scripting\b"
    r"|\b(?:checking|verify(?:ing)?)\b[^.!?]{0,30}\b(?:your (?:browser|connection)|you are (?:a )?human|that your connection)\b|\bjust a moment\b|^loading(?:…|\.\.\.)|\byour visit was blocked\b|\bautomated visits\b|\bwhy do i see this\b"
    r"|\bswitch it on and reload\b|\bmay take (?:up to )?(?:a few|five|\d+|<\*>) seconds\b|\bhow to enable scripts\b|\ballow them for this site\b|\bdoesn['’]t work properly without\b|\bare you (?:a )?(?:human|robot)\b|\bcomplete the captcha\b|\bddos protection\b"
    rf"|\baktivieren sie\b[^.!?]{{0,20}}\b{_SCRIPTS}\b|\b{_SCRIPTS}\b[^.!?]{{0,20}}\baktivieren\b|\bactive {_SCRIPTS}\b|\b(?:active|habilite|permita)\b[^.!?]{{0,20}}\b{_SCRIPTS}\b|\b(?:activer|activez|autoriser)\b[^.!?]{{0,20}}\b{_SCRIPTS}\b",
    re.IGNORECASE,
)
#: What an error page says to visitors.
_ERROR_WORDS = re.compile(
    r"\bpage (?:was |is |could |can )?(?:not |cannot be )?(?:not found|missing|be found|no longer exists)\b|\bpage you (?:requested|are looking for|were looking for)\b|\b(?:file or directory|page) missing\b"
    r"|\bsomething went wrong\b|\baccess denied\b|\bapplication error\b|\bbandwidth limit exceeded\b|\bcould not connect to the database\b|\binvalid hostname\b|\btoo many requests\b|\bsite (?:is )?temporarily (?:offline|unavailable)\b"
    r"|\bwe can['’]t find what you\b|\bnothing lives at this address\b|\baccount has been suspended\b|\bgateway time-?out\b|\bbad gateway\b|\bservice (?:temporarily )?unavailable\b|\binternal server error\b|\bserver error\b"
    r"|^\W*(?:<\*>|\d{3})?\W*(?:not found|forbidden|unauthorized|gone)\W*(?:<\*>)?$|\bhttp error\b|^(?:error|status|fehler) (?:<\*>|\d{3})\b"
    r"|\bnothing to show\b|\bresource limit reached\b|\bthe service is busy\b|\bthe address is gone\b|\bcertificate mismatch at the origin\b|\bunexpected failure\b|\brequest refused\b|\bcould not reach the host\b|\bthe origin did not answer\b"
    r"|\byou do not have permission to\b|\bupstream server returned\b|\btry the search box\b|\bgo (?:back )?to the home page\b|\breturn to the home ?page\b|\bif you are the owner of this site\b|\bcontact (?:your hosting provider|the owner of the site)\b"
    r"|\bthe page may have moved\b|\baddress was typed wrongly\b|\bserver was unable to\b|\btry again in a few minutes\b|\bno site is configured at\b|\bunexpected condition was met\b|\brequested url was not\b|\bweb server is down\b|\bis being restarted\b"
    r"|\bseite nicht gefunden\b|\binterner serverfehler\b|\bangeforderte adresse existiert nicht\b|\bzugriff verweigert\b|\bpágina no encontrada\b|\berror interno del servidor\b|\bno se pudo completar la solicitud\b|\bacceso denegado\b"
    r"|\bpage introuvable\b|\berreur interne\b|\bserveur n['’]a pas pu traiter\b|\baccès refusé\b"
    r"|^fatal error\b|^stack trace\b|\{main\} thrown|^uncaught \w+\b|\bin /srv/|\bon line (?:<\*>|\d+)\b",
    re.IGNORECASE,
)
#: A status code alone, or a line of a stack trace.
_ERROR_CODES = re.compile(r"^\W*(?:error )?\d{3}\W*$|^#\S+ /", re.IGNORECASE)
_ERROR = re.compile(f"{_ERROR_WORDS.pattern}|{_ERROR_CODES.pattern}", re.IGNORECASE)
#: Lines that go with an error page: references, server names, rules, buttons.
_BESIDE = re.compile(r"^\W*$|^(?:error reference|request id|ref|ray(?: id)?|reference|incident|nginx|apache|openresty|lighttpd|iis)\b.{0,60}$|^server at \S+(?: port \S+)?$|^<\*>$|^(?:home|go back|back|retry|reload|try again|return|contact)\W*$", re.IGNORECASE)
#: A crawler speaks of hosts, attempts, exceptions and times.
_DIAGNOSIS = re.compile(
    r"https?://|\b[\w-]+\.(?:example|test|com|org|net)\b|\b(?:errno|exception|traceback|retry|retries|attempts?|timed out|timeout|redirects|fetching|fetch|whois|codec|json|certificate verify|connection (?:failed|refused|reset)|name or service|database is locked|content type|empty response|headless|keyerror|valueerror|typeerror|skipped)\b",
    re.IGNORECASE,
)
_QUOTED_MENTION = re.compile(r"\b(?:like|such as|called|headings?|say|says|still show|words?)\b\s*(?:[\"“„«'][^\"”“»']+[\"”“»']|lorem ipsum)", re.IGNORECASE)

_ONLY_NAMES = re.compile(r"^(?:<N>|<\*>|[^\w<>]|\s)+$")

ORDINARY, FILLER, NOTICE, ERROR, BESIDE = "ordinary", "filler", "notice", "error", "beside"


_GATE = Gate(filler=_FILLER_WORDS, notice=_NOTICE, error=_ERROR_WORDS)


def classify(template: str) -> str:
    """The verdict on one template, by what it says."""
    low = re.findall(r"[a-z]+", template.lower())
    if len(low) >= 3 and sum(w in _LATIN for w in low) >= 0.7 * len(low) and any(w in _LATIN and len(w) > 4 for w in low):
        return FILLER
    may = _GATE.may_match(template)
    if (may & _GATE.bit["filler"] and _FILLER_WORDS.search(template) or _FILLER_LETTERS.search(template)) and not _QUOTED_MENTION.search(template):
        return FILLER
    if may & _GATE.bit["notice"] and _NOTICE.search(template):
        return NOTICE
    if may & _GATE.bit["error"] and _ERROR_WORDS.search(template) or _ERROR_CODES.search(template):
        return ERROR
    return BESIDE if _BESIDE.search(template) else ORDINARY


# --- the prefix tree --------------------------------------------------------

#: First tokens of a leaf, the share of places in which records of one template agree, and distinct records of a leaf's part.
DEPTH, SIMILAR, LEAF_RECORDS = 2, 0.75, 50_000
#: A template on that many hosts at least (by a 64-bit map of host hashes), of whose pages that share has ALONE_RECORDS
#: records at most, stands in place of pages.
SPREAD_HOSTS, ALONE_SHARE, ALONE_RECORDS = 8, 0.9, 4

_VARIABLE = re.compile(r"\d|[@/\\]|\w\.[a-z]{2,}\b|[{}<>%$]")
_CODE = re.compile(r"\W*[45]\d\d\W*")
_MASK = "<*>"
#: Marks at the border of words that do not tell templates apart.
_EDGES = "\"'“”‘’«»()[]*_`"


def masked(record: str) -> str:
    """A record with a wildcard for each token that varies by its kind; a bare status code stays."""
    if len(record) < 12 and _CODE.fullmatch(record):
        return record
    words = record.split()
    return " ".join([_MASK if _VARIABLE.search(w) else w for w in words] if _VARIABLE.search(record) else words)


def is_name(record: str) -> bool:
    """Whether a record is a heading of names, numbers and marks alone."""
    words = record.split()
    return len(words) <= 8 and all(not w.lstrip(_EDGES + "#>-").strip() or not w.lstrip(_EDGES + "#>-")[0].islower() for w in words)


class PrefixTree:
    """Templates by number of tokens and first tokens; a leaf lists its templates, wildcards where their records differ.

    ``add`` puts a record (already masked) on the template it agrees with best, or starts one. Records are to be
    added from the most to the least frequent; the first of a template stands for it.
    """

    def __init__(self) -> None:
        self.leaves: dict[tuple, list[list]] = {}

    @staticmethod
    def leaf(record: str) -> tuple:
        words = record.lower().split(" ")
        return (len(words), *words[:DEPTH])

    def add(self, record: str) -> list:
        """The template [tokens, first record] a record falls on."""
        words = record.lower().split(" ")
        listed = self.leaves.setdefault((len(words), *words[:DEPTH]), [])
        best, most = None, SIMILAR * len(words)
        for found in listed:
            same = sum(map(operator.eq, found[0], words))
            if same >= most and (best is None or same > most):
                best, most = found, same
        if best is None:
            best = [words, record]
            listed.append(best)
        elif most < len(words):
            best[0] = [a if a == b else _MASK for a, b in zip(best[0], words)]
        return best

    def verdict(self, record: str) -> str:
        """The verdict on the template a record falls on now."""
        return classify(self.add(masked(record))[1])


#: Ends of sentences, and abbreviations that end none.
_STOP = re.compile(r"[.!?…][\"”’)*_]*\s+")
_ABBREVIATIONS = ("max.", "min.", "incl.", "e.g.", "approx.")


def sentences_of(text: str) -> list[str]:
    """The sentences of a line that are not blank, without what closes them behind the stop."""
    found, start = [], 0
    for m in _STOP.finditer(text):
        end = m.start() + 1
        if end >= start and not text.endswith(_ABBREVIATIONS, start, end):
            found.append(text[start:end])
            start = m.end()
    found.append(text[start:])
    return [s for s in found if s and not s.isspace()]


# --- pages and messages -----------------------------------------------------


def blocks_of(text: str) -> list[list[tuple[int, str]]]:
    """Runs of lines between blank lines, each line with its number from 1."""
    blocks: list[list[tuple[int, str]]] = []
    current: list[tuple[int, str]] = []
    for number, line in enumerate(text.split("\n"), 1):
        if line and not line.isspace():
            current.append((number, line))
        elif current:
            blocks.append(current)
            current = []
    if current:
        blocks.append(current)
    return blocks


def is_chrome(block: list[tuple[int, str]]) -> bool:
    """Whether any line of a block is chrome by itself: blocks do not mix chrome and content."""
    return any(kind_of(line) in CHROME for _, line in block)


def key_of(record: str) -> int:
    """The 63-bit hash of a masked record, as a signed number with its lowest bit free."""
    return (xxhash.xxh64_intdigest(record) >> 1 << 1) - (1 << 63)


#: A masked record, its key, and whether it can be real content (1 or 0).
Saying = tuple[str, int, int]


def saying(sentence: str, real: bool) -> Saying:
    record = masked(sentence)
    return record, key_of(record), int(real)


@lru_cache(maxsize=50_000)
def line_records(line: str) -> tuple[bool, list[Saying]]:
    """Whether a line has a slot, and its records."""
    return has_slot(line), [saying(s, not is_name(s)) for s in sentences_of(plain(line))]


def page_records(blocks: list[list[tuple[int, str]]], chrome: list[bool]) -> tuple[bool, list[Saying]]:
    """Whether the body of a page has a slot, and its records."""
    slot, found = False, []
    for block, beside in zip(blocks, chrome):
        if beside:
            # the heading of an error page may look like a counted link
            if len(block) == 1 and kind_of(block[0][1]) in ("counted", "menu"):
                found.append(saying(plain(block[0][1]), False))
            continue
        for _, line in block:
            unfilled, sayings = line_records(line)
            slot = slot or unfilled
            found += sayings
    return slot, found


def message_records(text: str) -> tuple[bool, list[Saying], bool]:
    """Whether a message has a slot, its records, and whether it may be what visitors read: not a crawler's diagnosis."""
    bare = _TAGS.sub("\n", text)
    found = [saying(s, True) for line in bare.split("\n") for s in sentences_of(plain(line))]
    return has_slot(text), found, bare != text or not _DIAGNOSIS.search(text)


def page_text_is_case(text: str | None) -> bool:
    """The verdict on one page by itself, each record its own template."""
    if not text or text.isspace():
        return False
    blocks = blocks_of(text)
    slot, found = page_records(blocks, [is_chrome(b) for b in blocks])
    said = [classify(record) for record, _, _ in found]
    return slot or FILLER in said or (not {ERROR, NOTICE}.isdisjoint(said) and not any(v == ORDINARY and r for v, (_, _, r) in zip(said, found)))


_TAGS = re.compile(r"</?(?:html|head|title|body|center|h[1-6]|p|br|div|span|hr|pre|b|i)\b[^>]*>", re.IGNORECASE)


def message_is_case(text: str | None) -> bool:
    """The verdict on one error message by itself, each record its own template."""
    if not text or text.isspace():
        return False
    slot, found, visitors = message_records(text)
    said = [classify(record) for record, _, _ in found]
    return slot or FILLER in said or (visitors and not {ERROR, NOTICE}.isdisjoint(said))


# --- records of a corpus ------------------------------------------------------

PARSED = "page_table string, id bigint, host string, page bigint, slot boolean, visitors boolean, real int, sayings array<bigint>"
COUNTED = "record string, key bigint, n bigint, pages bigint, alone bigint, hosts bigint"


class Records:
    """Counts the records of one task; a table of them is handed out when it is full and at the end."""

    FULL = 200_000

    def __init__(self) -> None:
        self.stats: dict[str, list[int]] = {}

    def count(self, found: list[Saying], page: int, alone: int, host: int) -> list[int]:
        """Count records; their keys, with the lowest bit set if they can be real content."""
        stats = self.stats
        for record, _, _ in found:
            stat = stats.get(record)
            if stat is None:
                stats[record] = [1, page, alone, host]
            else:
                stat[0] += 1
                stat[1] += page
                stat[2] += alone
                stat[3] |= host
        return [key | real for _, key, real in found]

    def page(self, blocks, chrome, host: str | None) -> tuple[bool, bool, int, list[int]]:
        slot, found = page_records(blocks, chrome)
        bit = 1 << (xxhash.xxh64_intdigest(host or "") & 63)
        return slot, True, sum([real for _, _, real in found]), self.count(found, 1, int(len(found) <= ALONE_RECORDS), bit)

    def message(self, text: str) -> tuple[bool, bool, int, list[int]]:
        slot, found, visitors = message_records(text)
        return slot, visitors, len(found), self.count(found, 0, 0, 0)

    def handed_out(self) -> list[pa.Array]:
        rows = [(r, key_of(r), *v) for r, v in self.stats.items()]
        self.stats = {}
        columns = list(zip(*rows)) or [()] * 6
        signed = [h - (1 << 64) if h >= 1 << 63 else h for h in columns[5]]
        return [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(signed, pa.int64())]


def parse(rows: DataFrame, extra: str = "", lines_of: Callable | None = None) -> DataFrame:
    """Rows (page_table, id, host, text, is_message, page) as their records' keys, and rows of counted records (``record`` given).

    ``lines_of(blocks, chrome)`` gives further columns (``extra`` names them) of a page, all arrays of one length.
    """
    counted_at = len(PARSED.split(", "))
    schema = to_arrow_schema(_parse_datatype_string(f"{PARSED}, {COUNTED}{', ' * bool(extra)}{extra}"))
    kinds = [f.type for f in schema]
    own = kinds[counted_at + 6 :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = Records()

        def counted() -> pa.RecordBatch:
            columns = records.handed_out()
            none = lambda types: [pa.nulls(len(columns[0]), t) for t in types]
            return pa.RecordBatch.from_arrays([*none(kinds[:counted_at]), *columns, *none(own)], schema=schema)

        for batch in batches:
            kept, facts, lines = [], [], []
            for row, (host, text, is_message) in enumerate(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))):
                if not text or text.isspace():
                    continue
                kept.append(row)
                if is_message:
                    facts.append(records.message(text))
                    continue
                blocks = blocks_of(text)
                chrome = [is_chrome(b) for b in blocks]
                facts.append(records.page(blocks, chrome, host))
                if lines_of is not None:
                    lines.append(lines_of(blocks, chrome))
            at = pa.array(kept, pa.int64())
            columns = [pa.array([f[k] for f in facts], kinds[4 + k]) for k in range(4)]
            more = [pa.array([x[k] for x in lines], t) for k, t in enumerate(own)]
            none = [pa.nulls(len(kept), t) for t in kinds[counted_at : counted_at + 6]]
            same = [batch.column(k).take(at) for k in (0, 1, 2, 5)]
            yield pa.RecordBatch.from_arrays([*same, *columns, *none, *more], schema=schema)
            if len(records.stats) > records.FULL:
                yield counted()
        yield counted()

    slim = rows.select("page_table", "id", "host", "text", "is_message", "page").where("text is not null")
    parsed = spread(slim).mapInArrow(run, f"{PARSED}, {COUNTED}{', ' * bool(extra)}{extra}")
    return parsed.withColumn("row", F.monotonically_increasing_id())


def _on_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, first) of records (leaf, part, record, key), sorted by leaf and part and there the most frequent first:
    each is put on a template, leaf by leaf; ``first`` is the key of the template's first record."""
    at, tree, keys, firsts = None, PrefixTree(), [], []

    def handed_out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([key_of(f[1]) for f in firsts], pa.int64())], names=["key", "first"])

    for batch in batches:
        for leaf, part, record, key in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if (leaf, part) != at:
                at, tree = (leaf, part), PrefixTree()
                if len(keys) > 10_000:
                    yield handed_out()
                    keys, firsts = [], []
            keys.append(key)
            firsts.append(tree.add(record))
    if keys:
        yield handed_out()


def templates(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, first) of each record, and (first, whole, record, pages, alone, hosts) of the merged templates.

    ``counted`` has records with their counts, several rows for one record if several tasks saw it. ``first`` is the key of the
    record that stands for a template of a leaf's part, ``whole`` and ``record`` of the one that stands for the merged template.
    """
    sums = [F.sum(c).alias(c) for c in ("n", "pages", "alone")] + [F.bit_or("hosts").alias("hosts")]
    words = F.split(F.lower("record"), " ")
    leaf = F.concat_ws(" ", F.size(words), F.slice(words, 1, DEPTH))
    records = materialize(counted.groupBy("key", "record").agg(*sums).withColumn("leaf", leaf), "records")
    large = records.groupBy("leaf").count().where(F.col("count") > LEAF_RECORDS).select("leaf", F.ceil(F.col("count") / LEAF_RECORDS).alias("parts"))
    parted = records.join(large, "leaf", "left").withColumn("part", F.pmod("key", F.coalesce("parts", F.lit(1))))

    def grown(df: DataFrame) -> DataFrame:
        placed = df.select("leaf", "part", "record", "key", "n").repartition("leaf", "part").sortWithinPartitions("leaf", "part", F.desc("n"), "record")
        return placed.select("leaf", "part", "record", "key").mapInArrow(_on_leaves, "key bigint, first bigint")

    members = materialize(grown(parted), "part-templates")
    # a part's template is represented by its most frequent record; the templates of a leaf's parts are merged by them
    parts = members.join(records.drop("record", "leaf"), "key").groupBy("first").agg(*sums)
    parts = materialize(parts.join(records.select(F.col("key").alias("first"), "record", "leaf"), "first"), "templates")
    merged = grown(parts.withColumn("part", F.lit(0)).withColumnRenamed("first", "key"))
    merged = merged.select(F.col("key").alias("first"), F.col("first").alias("whole")).join(parts, "first").drop("record", "leaf", "n")
    return members, merged.join(parts.select(F.col("first").alias("whole"), "record"), "whole")


def verdicts(counted: DataFrame) -> DataFrame:
    """(key, verdict) of the records whose template is not ordinary; each merged template is classified once."""
    members, merged = templates(counted)
    total = merged.groupBy("whole", "record").agg(F.sum("pages").alias("pages"), F.sum("alone").alias("alone"), F.bit_or("hosts").alias("hosts"))
    spread_out = (F.bit_count("hosts") >= SPREAD_HOSTS) & (F.col("alone") >= ALONE_SHARE * F.col("pages"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = []
            for record, alone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                verdict = classify(record)
                said.append(ERROR if verdict == ORDINARY and alone and not is_name(record) else verdict)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=["whole", "verdict"])

    judged = total.select("whole", "record", spread_out.alias("spread")).mapInArrow(judge, "whole bigint, verdict string").where(F.col("verdict") != ORDINARY)
    return members.join(merged.select("first", "whole").join(judged, "whole"), "first").select("key", "verdict")


def cases(parsed: DataFrame) -> DataFrame:
    """(page_table, id, row) of the rows of parse() that are cases."""
    rows = parsed.where("record is null")
    flagged = verdicts(parsed.where("record is not null").select("record", "key", "n", "pages", "alone", "hosts"))
    said = rows.where("not slot").select("row", F.explode("sayings").alias("saying"))
    said = said.withColumn("counts", F.pmod("saying", F.lit(2))).withColumn("key", F.col("saying") - F.col("counts"))
    hits = meet(said, flagged, ["key"], "inner", "flagged-records").groupBy("row").agg(
        F.count_if(F.col("verdict") == FILLER).alias("filler"),
        F.count_if(F.col("verdict").isin(ERROR, NOTICE)).alias("residue"),
        F.sum("counts").alias("unreal"),
    )
    found = meet(rows.select("page_table", "id", "row", "visitors", "real"), hits.where("filler + residue > 0"), ["row"], "inner", "rows-with-residue", 1)
    is_page = F.col("page_table") != MESSAGES
    whole = (F.col("residue") > 0) & F.col("visitors") & (~is_page | (F.col("real") <= F.col("unreal")))
    return rows.where("slot").select("page_table", "id", "row").unionByName(found.where((F.col("filler") > 0) | whole).select("page_table", "id", "row"))


#: ``page_table`` of error messages.
MESSAGES = "messages"


def find_residue(df: DataFrame, id_col: str = "id", page_col: str = "homepage_markdown", message_col: str = "error_message", url_col: str = "url") -> DataFrame:
    """(id, field) of the cases. Without a ``url_col`` all pages count as of one host."""
    i = F.col(f"`{id_col}`").cast("bigint").alias("id")
    host = host_of(F.col(f"`{url_col}`").cast("string")) if url_col in df.columns else F.lit("")
    rows = df.select(i, host.alias("host"), F.lit(0).cast("bigint").alias("page"), F.explode(F.array(
        F.struct(F.lit("pages").alias("page_table"), F.col(f"`{page_col}`").cast("string").alias("text"), F.lit(False).alias("is_message")),
        F.struct(F.lit(MESSAGES).alias("page_table"), F.col(f"`{message_col}`").cast("string").alias("text"), F.lit(True).alias("is_message")),
    )).alias("said")).select("said.page_table", "id", "host", "said.text", "said.is_message", "page")
    found = cases(materialize(parse(rows), "residue-records"))
    return found.select("id", F.when(F.col("page_table") == MESSAGES, message_col).otherwise(page_col).alias("field"))


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without www."""
    return F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.\-]*:)?/*(?:www\.)?([^/?#\s:]*)", 1)
