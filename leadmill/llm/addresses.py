"""Postal addresses written differently: which rows name the same building.

Each address value is parsed into components (unit, number, street with prefix and type, town,
region, postcode), abbreviations are expanded by locale dictionaries (English street types and prefixes; types
before or within the name in French, Spanish and German), and the components are put into one order. A street name is all words between
number and type, ordinals (``5th``) among them; a street without a known type is the words beside the number.
Keys are hierarchical:

* place: the town of the postcode, else the town named (a typing error away from a known town of
  the region given, at most); an address with neither has no place and matches nothing;
* building: place, house number, street type, street prefix and street name.

Units, floors, building names, remarks and country spellings are not part of a key. House
numbers agree exactly, and ``a/b`` before a street is unit a at number b. A post box is no building. Mistyped street names
are corrected town by town: a name takes the spelling of a name one typing error away that is RATIO times as frequent in
the corpus (deletion variants are joined; no pairs of all names), and then of a more frequent name
at the same number (if the corpus does not speak for the other way). A name that stands at STREET_NUMBERS numbers of its town is a street of its own and stays, unless the other
is RATIO times as frequent in that town.

Pairs are the last step. A building of n rows is cut into parts of PAIR_ROWS rows, and each pair of parts is one key of
the join, so no task gets more than PAIR_ROWS squared pairs of a building.

Defined results
---------------
* null, blank and sentinel addresses, and addresses without number, street or place, match nothing;
* a row with several addresses shares a building if one address each does; a pair is given once;
* repeated rows under one id are one row; ties in frequency go to the alphabetically first name;
* texts of any length are read whole; only the named columns are read; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.operators.packed_fields import split_field
from leadmill.session import materialize

#: A street name is corrected towards one that is this many times as frequent.
RATIO = 8
#: Numbers of a town at which a spelling must stand to be a street's name there.
STREET_NUMBERS = 2
#: Rows of one part of a building when pairs are made.
PAIR_ROWS = 4096
#: Localities are a fixed table; beyond this size they are no longer sent to all tasks.
MAX_LOCALITIES = 200_000

#: Street types and their abbreviations (locale dictionary).
STREET_TYPES = {
    "street": "street st str", "road": "road rd", "avenue": "avenue ave av", "lane": "lane ln la", "drive": "drive dr drv",
    "court": "court ct crt", "crescent": "crescent cres cr crs cresc", "parade": "parade pde par", "place": "place pl plc", "terrace": "terrace tce ter terr",
    "close": "close cl", "boulevard": "boulevard blvd bvd boul", "highway": "highway hwy", "way": "way wy", "square": "square sq",
    "grove": "grove gr grv", "circuit": "circuit cct", "esplanade": "esplanade esp", "alley": "alley aly", "walk": "walk wlk", "row": "row",
    "gardens": "gardens gdns", "mews": "mews", "hill": "hill", "rise": "rise", "trail": "trail trl", "parkway": "parkway pkwy", "quay": "quay qy", "circle": "circle cir",
}
TYPE_OF = {short: name for name, shorts in STREET_TYPES.items() for short in shorts.split()}
#: Words before a street name and their abbreviations.
PREFIXES = {
    "north": "north n", "south": "south s", "east": "east e", "west": "west w", "upper": "upper upr up", "lower": "lower lwr", "saint": "saint st",
    "mount": "mount mt mnt", "old": "old", "new": "new", "great": "great gt grt", "little": "little lt", "northeast": "northeast", "northwest": "northwest",
    "southeast": "southeast", "southwest": "southwest", "fort": "fort ft", "port": "port pt",
}
PREFIX_OF = {short: name for name, shorts in PREFIXES.items() for short in shorts.split()}
#: Types that stand before the name in French and Spanish, with their abbreviations.
LEADING_TYPES = {
    "rue": "rue", "avenue": "avenue av ave", "boulevard": "boulevard bd boul bvd", "place": "place pl", "chemin": "chemin ch", "impasse": "impasse imp",
    "allée": "allée all", "quai": "quai", "calle": "calle c", "avenida": "avenida avda avd", "plaza": "plaza plza pza", "paseo": "paseo pº", "camino": "camino cmno",
}
LEADING_OF = {short: name for name, shorts in LEADING_TYPES.items() for short in shorts.split()}
_GERMAN = re.compile(r"(.{3,})(?:stra(?:ß|ss)e|str)$")
_BOX = re.compile(r"\b(?:g?\.?p\.?\s?o\.?\s*box|postfach|apartado(?: de correos)?|boîte postale|b\.?p\.)\s*(?:no\.?\s*)?\d+")
_UNITS = r"(?:unit|suite|ste|apt|apartment|flat|shop|level|lvl|fl|room|rm|lot)"
_UNIT = re.compile(rf"\b{_UNITS}\b\.?\s*(?:no\.?\s*)?#?\s*(?:\d+[a-z]?|[a-z])\b[\s,]*|#\s*\d+[a-z]?\b[\s,]*")
_FLOOR = re.compile(r"\b(?:ground|first|second|third|top|\d+(?:st|nd|rd|th))\s+floor\b")
_REMARK = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\s[-–—]\s*(?:ground|first|second|top|rear|front|next|opposite|near|behind|above)\b[^,]*|[,\s](?:next to|opposite|near|behind|above|across from|beside|rear of) the\b.*?(?=,|$)")
_QUOTED = re.compile(r'"[^"]*"')
_POSTCODE = re.compile(r"\b(?:[a-z]{1,2}\d[a-z\d]?\s?\d[a-z]{2}|[a-z]\d[a-z]\s?\d[a-z]\d|\d{4,5})\b")
_TOKEN = re.compile(r"\d+\s*/\s*\d+[a-z]?|\d+(?:st|nd|rd|th)\b|\d+[a-z]?\b|[^\W\d_]+(?:['’-][^\W\d_]+)*|,|№")
_NUMBER = re.compile(r"(?:(\d+)\s*/\s*)?(\d+[a-z]?)$")
#: Postcodes of letters and digits are never house numbers, known or not.
_MIXED_CODE = re.compile(r"\b(?:[a-z]{1,2}\d[a-z\d]?\s?\d[a-z]{2}|[a-z]\d[a-z]\s?\d[a-z]\d)\b")
#: A number named as one.
_NAMED_NUMBER = re.compile(r"\b(?:no|nr|nº|№)\b\s*[.:#]?\s*(?=\d)|№\s*(?=\d)")
COUNTRIES = frozenset("australia au aus canada ca can united kingdom uk gb great britain england scotland wales states usa us of america".split())
_ORDINAL = re.compile(r"\d+(?:st|nd|rd|th)$")


class Building(NamedTuple):
    place: str
    number: str
    kind: str
    prefix: str
    name: str


def deletions(word: str) -> set[str]:
    """The word and all forms with one letter left out."""
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


def one_error(a: str, b: str) -> bool:
    """Whether two words differ by one letter left out, added, exchanged or by two neighbours swapped, at most."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return longer[i + 1 :] == shorter[i:]


class Gazetteer:
    """Known towns by postcode and by name, with one typing error."""

    def __init__(self, rows: list[tuple[str, str, str, str]]):
        """rows: (locality, region name, region code, postcode)."""
        self.by_code: dict[str, str] = {}
        self.regions: dict[str, set[str]] = defaultdict(set)
        self.variants: dict[str, set[str]] = defaultdict(set)
        self.towns: set[str] = set()
        self.region_words: set[str] = set()
        for town, region, code, postcode in rows:
            if not town:
                continue
            town = town.lower()
            self.towns.add(town)
            if postcode:
                self.by_code[re.sub(r"\s", "", postcode.lower())] = town
            for r in (region, code):
                if r:
                    self.regions[town].add(r.lower())
                    self.region_words.add(r.lower())
            for v in deletions(town):
                self.variants[v].add(town)
        self.longest = max((t.count(" ") + 1 for t in self.towns), default=1)

    def length_at(self, tokens: list[str], at: int) -> int:
        """Words of the known town (or of the region) that starts at a place; 0 if there is none."""
        for n in range(self.longest, 0, -1):
            phrase = " ".join(tokens[at : at + n])
            if len(tokens) >= at + n and (phrase in self.towns or phrase in self.region_words):
                return n
        return 0

    def starts(self, tokens: list[str], at: int) -> bool:
        return self.length_at(tokens, at) > 0

    def town_in(self, tokens: list[str]) -> str | None:
        """The town named among tokens, in one word or several."""
        for k in range(len(tokens)):
            for n in range(self.longest, 1, -1):
                if " ".join(tokens[k : k + n]) in self.towns:
                    return " ".join(tokens[k : k + n])
        words = [t for t in tokens if t[0].isalpha()]
        said = {t for t in words if t in self.region_words}
        found = self.town(words, said)
        if found is None and self.longest > 1:
            pairs = [" ".join(words[k : k + n]) for n in range(2, self.longest + 1) for k in range(len(words) - n + 1)]
            found = self.town(pairs, said)
        return found

    def town(self, words: list[str], said: set[str]) -> str | None:
        """The town named among words: exact first, else the only one a typing error away that fits the region."""
        for w in words:
            if w in self.towns:
                return w
        found: set[str] = set()
        for w in words:
            if len(w) < 5 or w in self.region_words:
                continue
            near = {t for v in deletions(w) for t in self.variants.get(v, ()) if one_error(w, t)}
            if len(near) > 1 and said:
                near = {t for t in near if self.regions[t] & said} or near
            found |= near
        return found.pop() if len(found) == 1 else None


def parse_address(value: str, places: Gazetteer) -> Building | None:
    """The building an address names, or None if number, street or place is missing."""
    text = _QUOTED.sub(" ", value.lower()).replace("’", "'")
    text = re.sub(r"\bu\.\s?s\.(?:\s?a\.)?|\bu\.\s?k\.", " , ", re.sub(r"\s+", " ", text))
    text = _REMARK.sub(" ", text)
    text = _BOX.sub(" , ", _FLOOR.sub(" ", text))
    # a number may be a postcode or a house number: the last that is a postcode is taken for one, if a house number is left then
    for m in reversed(list(_POSTCODE.finditer(text))):
        if (town := places.by_code.get(re.sub(r"\s", "", m.group()))) is not None:
            found = _building(text[: m.start()] + " , " + text[m.end() :], town, places)
            if found is not None:
                return found
    return _building(text, None, places)


def _building(text: str, town: str | None, places: Gazetteer) -> Building | None:
    text = _UNIT.sub(" ", text)
    text = _NAMED_NUMBER.sub(" № ", _MIXED_CODE.sub(" , ", text)).replace(".", " . ")
    tokens = _TOKEN.findall(text)
    found = _typed_street(tokens, places) or _untyped_street(tokens, places)
    if found is None:
        return None
    number, start, end, prefix, name, kind = found
    if town is None:
        rest = [t for k, t in enumerate(tokens) if not start <= k < end]
        town = places.town_in(rest)
    if town is None:
        return None
    return Building(town, number, kind, prefix, name)


def _is_word(token: str) -> bool:
    return token[0].isalpha() or _ORDINAL.match(token) is not None


def _number_before(tokens: list[str], at: int) -> str | None:
    """The house number in front of a place. Behind a comma, the number must be alone or named as one: else it ends a town's line."""
    low = at
    while low > 0 and tokens[low - 1] == ",":
        low -= 1
    m = _NUMBER.match(tokens[low - 1]) if low > 0 else None
    if m is None or (low < at and low >= 2 and _is_word(tokens[low - 2])):
        return None
    return m.group(2)


def _number_behind(tokens: list[str], at: int, places: Gazetteer) -> str | None:
    """The house number behind a street; a number in front of a town is no house number unless it is named as one."""
    while at < len(tokens) and tokens[at] == ",":
        at += 1
    named = at < len(tokens) and tokens[at] == "№"
    at += named
    m = _NUMBER.match(tokens[at]) if at < len(tokens) else None
    if m is None or (not named and m.group(2).isdigit() and len(m.group(2)) >= 4 and places.starts(tokens, at + 1)):
        return None
    return m.group(2)


def _typed_street(tokens: list[str], places: Gazetteer):
    """(number, start, end, prefix, name, type) of the street with a type word, the one behind a number first."""
    behind = []
    k = 0
    while k < len(tokens):
        if not _is_word(tokens[k]):
            k += 1
            continue
        # a run of words; its street ends at the first type word that no other type follows
        low = k
        while k < len(tokens) and _is_word(tokens[k]):
            k += 1
        at = low + 1
        while at < k:
            if tokens[at] not in TYPE_OF or (at + 1 < k and tokens[at + 1] in TYPE_OF and not places.starts(tokens, at + 1)):
                at += 1
                continue
            number = _number_before(tokens, low)
            start = low
            if number is None:
                # what is in front of the name may be the town, region and country
                while start < at and (n := places.length_at(tokens, start) or (tokens[start] in COUNTRIES) or (places.town([tokens[start]], set()) is not None)):
                    start += n
                if start >= at and tokens[at] in PREFIX_OF and at + 1 < k:
                    # nothing is left for a name, so this is the prefix of one
                    at += 1
                    continue
                start = min(start, at - 1)
            prefixes, first = [], start
            while start < at - 1 and tokens[start] in PREFIX_OF:
                prefixes.append(PREFIX_OF[tokens[start]])
                start += 1
            street = (first, at + 1, " ".join(prefixes), " ".join(tokens[start:at]), TYPE_OF[tokens[at]])
            if number is not None:
                return number, *street
            behind.append(street)
            low, at = at + 1, at + 2
    for street in reversed(behind):
        if (number := _number_behind(tokens, street[1], places)) is not None:
            return number, *street
    return None


def _untyped_street(tokens: list[str], places: Gazetteer):
    """(number, start, end, "", name, type) of a number and the words beside it, if they are no town; the type is empty, or one that stands before the name."""
    for at, t in enumerate(tokens):
        if _NUMBER.match(t) is None:
            continue
        end = at + 1
        while end < len(tokens) and _is_word(tokens[end]) and not places.starts(tokens, end):
            end += 1
        start = at
        while start > 0 and _is_word(tokens[start - 1]):
            start -= 1
        start += places.length_at(tokens, start)
        for low, high, number in ((at + 1, end, t), (start, at, t)):
            words = tokens[low:high]
            if not words or any(w in TYPE_OF and w not in LEADING_OF for w in words) or not any(len(w) > 2 for w in words):
                continue
            kind = ""
            if words[0] in LEADING_OF and len(words) > 1:
                kind, words = LEADING_OF[words[0]], words[1:]
            if m := _GERMAN.match(words[-1]):
                words = [*words[:-1], m.group(1) + "straße"]
            return _NUMBER.match(number).group(2), low, high, "", " ".join(words), kind
    return None


def parse_table(df: DataFrame, localities: DataFrame, id_col: str = "id", address_col: str = "address") -> DataFrame:
    """(id, place, number, kind, prefix, name) of each address value that names a building."""
    columns = [F.col(c).cast("string") for c in ("locality", "region_name", "region_code", "postcode")]
    known = localities.select(*columns).limit(MAX_LOCALITIES + 1).collect()
    if len(known) > MAX_LOCALITIES:
        raise ValueError(f"more than {MAX_LOCALITIES} localities")
    sent = df.sparkSession.sparkContext.broadcast([tuple(r) for r in known])
    slim = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{address_col}`").cast("string").alias("address")).where("address is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Gazetteer(sent.value)
        for batch in batches:
            ids, found = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for value in split_field("address", text):
                    if (b := parse_address(value, places)) is not None:
                        ids.append(i)
                        found.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array([b[k] for b in found], pa.string()) for k in range(5))],
                names=["id", "place", "number", "kind", "prefix", "name"],
            )

    return slim.mapInArrow(run, "id bigint, place string, number string, kind string, prefix string, name string")


def _variants(word: Column) -> Column:
    """The word and all forms with one letter left out."""
    left_out = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), left_out))


def _near(a: Column, b: Column) -> Column:
    """one_error() for different words, given that they share a deletion variant."""
    letters = lambda c: F.array_sort(F.split(c, ""))
    swapped = (F.length(a) == F.length(b)) & (F.levenshtein(a, b) == 2) & (letters(a) == letters(b))
    return (F.levenshtein(a, b) == 1) | swapped


def _near_names(names: DataFrame, key: list[str], ratio: int) -> DataFrame:
    """(*key, name, n, better, better_n): of names (*key, name, n) one typing error apart under one key, those ``ratio`` times as frequent."""
    forms = names.select(*key, "name", "n", F.explode(_variants(F.col("name"))).alias("form"))
    other = forms.select(*key, "form", F.col("name").alias("better"), F.col("n").alias("better_n"))
    first = F.struct(-F.col("better_n"), F.col("better")) < F.struct(-F.col("n"), F.col("name"))
    near = (F.length("name") >= 4) & _near(F.col("name"), F.col("better")) & (F.col("better_n") >= ratio * F.col("n")) & first
    return forms.join(other, [*key, "form"]).where(near).drop("form")


def corrections(names: DataFrame) -> DataFrame:
    """(name, better): names (name, n) and the most frequent spelling one typing error away that is RATIO times as frequent."""
    return _near_names(names, [], RATIO).groupBy("name").agg(F.min_by("better", F.struct(-F.col("better_n"), F.col("better"))).alias("better"))


_STREET = ["place", "kind", "prefix"]


def _corrected(rows: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Rows with the best of the corrections found (*key, name, better, better_n) that the names' own standing in the town allows."""
    towns = rows.groupBy(*_STREET, "name").agg(F.count("*").alias("town_n"), F.count_distinct("number").alias("numbers"))
    other = towns.select(*_STREET, F.col("name").alias("better"), F.col("town_n").alias("better_town_n"))
    judged = found.join(towns, [*_STREET, "name"]).join(other, [*_STREET, "better"], "left")
    allowed = (F.col("numbers") < STREET_NUMBERS) | (F.coalesce("better_town_n", F.lit(0)) >= RATIO * F.col("town_n"))
    best = judged.where(allowed).groupBy(*key, "name").agg(F.min_by("better", F.struct(-F.col("better_n"), F.col("better"))).alias("better"))
    return rows.join(best, [*key, "name"], "left").withColumn("name", F.coalesce("better", "name")).drop("better")


def buildings(df: DataFrame, localities: DataFrame, id_col: str = "id", address_col: str = "address") -> DataFrame:
    """(id, building): the buildings of each row, street names corrected; one row for each."""
    rows = materialize(parse_table(df, localities, id_col, address_col), "addresses")
    names = materialize(rows.groupBy("name").agg(F.count("*").alias("n")), "street-names")
    better = corrections(names).withColumn("better_n", F.lit(1))
    rows = _corrected(rows, rows.select(*_STREET, "name").distinct().join(better, "name"), _STREET)
    key = [*_STREET, "number"]
    local = rows.groupBy(*key, "name").agg(F.count("*").alias("n"))
    several = local.groupBy(key).agg(F.count("*").alias("k")).where("k > 1").drop("k")
    near = _near_names(local.join(several, key), key, 1).join(names.withColumnRenamed("n", "corpus_n"), "name")
    near = near.join(names.select(F.col("name").alias("better"), F.col("n").alias("better_corpus_n")), "better")
    rows = _corrected(rows, near.where(F.col("corpus_n") < RATIO * F.col("better_corpus_n")), key)
    return rows.select("id", F.concat_ws("|", "place", "number", "kind", "prefix", "name").alias("building")).distinct()


def same_building(df: DataFrame, localities: DataFrame, id_col: str = "id", address_col: str = "address") -> DataFrame:
    """(id_a, id_b): pairs of rows, id_a < id_b, that share a building."""
    rows = materialize(buildings(df, localities, id_col, address_col), "buildings")
    parts = F.ceil(F.col("n") / PAIR_ROWS)
    shared = rows.groupBy("building").agg(F.count("*").alias("n")).where("n > 1").select("building", parts.alias("parts"))
    kept = rows.join(shared, "building").withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    a = kept.select("building", F.col("id").alias("id_a"), F.col("part").alias("i"), every.alias("j"))
    b = kept.select("building", F.col("id").alias("id_b"), F.col("part").alias("j"), every.alias("i"))
    return a.join(b, ["building", "i", "j"]).where("id_a < id_b").select("id_a", "id_b").distinct()
