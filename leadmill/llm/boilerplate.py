"""Page boilerplate: keep the lines of the main body, by templates deduced from pages of one host.

1. Every page is parsed once: its records for ``residue``, its lines, the blocks of lines between blank lines, for each
   block whether a line in it looks like chrome by itself (menus, notices, sidebars, footers), and for each line
   a token: its template without numbers, names and link targets.
2. Templates of hosts. Pages are grouped by host and by section of a host (first part of the path); a group with HOST_PAGES
   different pages or more has a template, deduced from recurrence alone, whatever the words: a line is fixed if it stands, word
   for word, on RECURS of the group's pages. Fixed lines with the same occurrence vector over the pages are an equivalence
   class. The class on the most pages is the root; its lines cut the page into slots. Other classes are valid if
   their lines keep one order, and are nested in the slot they keep. What is not fixed is a slot. A block with more
   fixed lines than slots is template. Visits of one page count as one page, so its own body does not recur.
3. Hosts with fewer pages have no template of their own. Their lines, and the lines in slots, are judged by how they look,
   and by classes of a pool: a host with HOST_PAGES pages is a pool, all other hosts are one pool together. In a pool, tokens with
   the same occurrence vector (same count and same sums of page hashes) and the same role form a class, which is chrome if
   its occurrences lie in blocks that look like it; the verdict holds for its tokens wherever they stand. A token without
   support in its host's own pool has the verdict of the common pool. All bounds are fixed numbers that do not move with the crawl.
4. Blocks of template lines are dropped; what remains in the slots is the main body.

Pages whose body is template residue (see ``residue``) give no rows.

Scale: one parse in Arrow batches, two tables of arrays in the shared folder, shuffles of
pre-aggregated token counts and of the lines of hosts with a template. Nothing is collected: pools and templates
meet pages and lines by broadcast behind a check of their size, else by shuffled joins whose keys are salted.

Defined results
---------------
* null, empty and blank pages give no rows, nor do pages of chrome alone; blank lines are no rows;
* repeated pages and tied rows each give their rows; texts of any length are read whole;
* only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.joins import meet
from leadmill.llm.page_lines import template
from leadmill.llm.residue import cases, parse
from leadmill.session import materialize

#: Pages of a host for a pool of its own, and occurrences of a token for a verdict.
HOST_PAGES = 5
MIN_SUPPORT = 5
#: Share of a host's pages on which a line is fixed.
RECURS = 0.5
#: Share of a class's pages on which its lines keep one order and their slots.
AGREE = 0.9
#: Share of a class's occurrences in chrome blocks, and of a token's own.
CLASS_CHROME, TOKEN_CHROME = 0.8, 0.5

LINE_NAMES = ["numbers", "blocks", "chrome", "tokens", "lines"]
CLASS = ["pool", "n", "mix", "total", "role"]

_SAYS = re.compile(r"[^\W_]")

_keys: dict[str, tuple[int, int | None]] = {}


def keys_of(line: str) -> tuple[int, int | None]:
    """The 64-bit hashes of a line's template and of the line itself (none without letters or digits)."""
    found = _keys.get(line)
    if found is None:
        if len(_keys) > 100_000:
            _keys.clear()
        bare = line.strip()
        own = xxhash.xxh64_intdigest(bare) - (1 << 63) if _SAYS.search(bare) else None
        found = _keys[line] = xxhash.xxh64_intdigest(template(line)) - (1 << 63), own
    return found


LINES = "numbers array<int>, blocks array<int>, chrome array<boolean>, tokens array<bigint>, lines array<bigint>"


def lines_of(blocks: list[list[tuple[int, str]]], beside: list[bool]) -> tuple[list, list, list, list, list]:
    """The columns LINES of one page; a line without letters or digits has no hash in ``lines``."""
    numbers = [number for block in blocks for number, _ in block]
    block_ids = [k for k, block in enumerate(blocks) for _ in block]
    chrome = [c for block, c in zip(blocks, beside) for _ in block]
    keys = [keys_of(line) for block in blocks for _, line in block]
    return numbers, block_ids, chrome, [k[0] for k in keys], [k[1] for k in keys]


def read_pages(pages: DataFrame) -> DataFrame:
    """Pages (page_table, id, host, text and, if known, page and section) as residue.parse() gives them, with the columns LINES and ``section``.

    ``page`` tells pages of a host apart: visits of a page share it; without that column it is the text.
    """
    given = pages.columns
    page = F.xxhash64("page" if "page" in given else "text").alias("page")
    # the section goes along in the host column, behind a blank
    host = F.concat_ws(" ", F.coalesce("host", F.lit("")), "section") if "section" in given else F.col("host")
    rows = pages.select("page_table", "id", host.alias("host"), "text", F.lit(False).alias("is_message"), page)
    parsed = parse(rows, LINES, lines_of)
    return parsed.withColumn("section", F.col("host")).withColumn("host", F.split_part(F.coalesce("host", F.lit("")), F.lit(" "), F.lit(1)))


def pooled(parsed: DataFrame) -> DataFrame:
    """The parsed pages with ``pool``: the host if it has enough pages, else one pool for the rest."""
    large = parsed.where("host <> ''").groupBy("host").count().where(F.col("count") >= HOST_PAGES)
    large = large.select("host", F.col("host").alias("pool"))
    return meet(parsed, large, ["host"], "left", "large-hosts").withColumn("pool", F.coalesce("pool", F.lit("")))


def token_counts(pages: DataFrame) -> DataFrame:
    """(pool, token, n, chrome_n, mix, total, place) of every token."""
    lines = pages.select(
        "pool",
        F.xxhash64("page_table", "id").alias("page"),
        F.size("tokens").alias("length"),
        F.posexplode(F.arrays_zip("tokens", "chrome")).alias("at", "line"),
    )
    return (
        lines.groupBy("pool", F.col("line.tokens").alias("token"))
        .agg(
            F.count("*").alias("n"),
            F.count_if("line.chrome").alias("chrome_n"),
            F.bit_xor("page").alias("mix"),
            F.sum(F.pmod("page", F.lit(1 << 31))).alias("total"),
            F.avg(F.col("at") / F.col("length")).alias("place"),
        )
    )


def token_classes(counts: DataFrame) -> DataFrame:
    """(pool, token, n, chrome_n, place, class_n, class_size, class_chrome): supported tokens and the class of each."""
    tokens = counts.where(F.col("n") >= MIN_SUPPORT)
    # tokens are told apart by the role they mostly have, so that chrome and content on the same pages do not mix
    tokens = tokens.withColumn("role", F.col("chrome_n") * 2 >= F.col("n"))
    classes = tokens.groupBy(*CLASS).agg(F.count("*").alias("class_size"), (F.sum("chrome_n") / F.sum("n")).alias("class_chrome"))
    return tokens.join(classes, CLASS)


def chrome_tokens(classes: DataFrame) -> DataFrame:
    """(pool, token) of the templates' tokens."""
    return classes.where((F.col("class_chrome") >= CLASS_CHROME) & (F.col("chrome_n") >= TOKEN_CHROME * F.col("n"))).select("pool", "token")


def sought_tokens(counts: DataFrame) -> DataFrame:
    """(pool, token) of chrome tokens that also stand outside chrome blocks; for tokens without support in
    their host's pool, the common pool decides."""
    outside = F.col("chrome_n") < F.col("n")
    found = chrome_tokens(token_classes(counts))
    common = found.where("pool = ''").select("token")
    rare = counts.where((F.col("pool") != "") & (F.col("n") < MIN_SUPPORT) & outside).select("pool", "token")
    own = found.join(counts.where(outside).select("pool", "token"), ["pool", "token"], "left_semi")
    return own.unionByName(rare.join(common, "token", "left_semi").select("pool", "token"))


def templates(pages: DataFrame) -> DataFrame:
    """(pool, class_support, class_size, chrome_share, place): valid classes of chrome of the pools, widest first, in the order of the page."""
    return (
        token_classes(token_counts(pages))
        .where(F.col("class_chrome") >= CLASS_CHROME)
        .groupBy(*CLASS)
        .agg(F.count("*").alias("class_size"), F.round(F.first("class_chrome"), 6).alias("chrome_share"), F.round(F.avg("place"), 6).alias("place"))
        .select("pool", F.col("n").alias("class_support"), "class_size", "chrome_share", "place")
        .orderBy("pool", F.desc("class_support"), "place")
    )


def page_templates(pages: DataFrame) -> DataFrame:
    """templates() of pages that are no residue."""
    parsed = materialize(read_pages(pages), "parsed-pages")
    kept = meet(parsed.where("record is null"), cases(parsed).select("row"), ["row"], "left_anti", "residue-pages", 1)
    return templates(pooled(kept))


def deduced(pages: DataFrame) -> DataFrame:
    """(group, line, class, n, pages, slot, place, root, valid) of the fixed lines of each host, and of each section of a host, with enough pages.

    A line is fixed if it stands on RECURS of the group's pages. Fixed lines with one occurrence vector are a class; the one
    on the most pages is the root, and its lines cut the page into slots. A line is valid if it keeps its slot on AGREE of the pages;
    lines of other classes, which are nested in a slot of the root, also need one order within their class on AGREE of the pages. ``pages`` has (row, host, section, page, lines).
    """
    lines = _group_lines(pages)
    seen = lines.groupBy("group", "line", "page").agg(F.count("*").alias("times"), F.min("place").alias("place"), F.max("pages").alias("pages"))
    vector = lambda k: F.xxhash64(F.lit(k), "page", "times")
    counted = seen.groupBy("group", "line").agg(
        F.count("*").alias("n"), F.bit_xor(vector(0)).alias("mix"), F.sum(F.pmod(vector(1), F.lit(1 << 31))).alias("total"),
        F.avg("place").alias("place"), F.max("pages").alias("pages"),
    )
    fixed = counted.where(F.col("n") >= RECURS * F.col("pages"))
    fixed = fixed.select("group", "line", F.xxhash64("group", "n", "mix", "total").alias("class"), "n", "pages", F.round("place", 6).alias("place"))
    sizes = fixed.groupBy("group", "class").agg(F.max("n").alias("n"), F.count("*").alias("size"))
    root = sizes.groupBy("group").agg(F.max_by("class", F.struct("n", "size", "class")).alias("root_class"))
    fixed = materialize(fixed.join(root, "group").withColumn("root", F.col("class") == F.col("root_class")).drop("root_class"), "fixed-lines")
    if fixed.isEmpty():
        # no group has a line in common: there is nothing to order or nest
        return fixed.withColumns({"slot": F.lit(0), "valid": F.lit(False)})
    met = meet(lines.select("row", "group", "line", "at"), fixed.select("group", "line", "class", "root"), ["group", "line"], "inner", None)
    # the fixed lines of one page, in order; each with the number of root lines before it
    page = met.groupBy("row", "group").agg(F.array_sort(F.collect_list(F.struct("at", "line", "class", "root"))).alias("found"))
    slots = F.transform("found", lambda x: F.struct(x["line"].alias("line"), x["class"].alias("class"), F.size(F.filter("found", lambda y: y["root"] & (y["at"] < x["at"]))).alias("slot")))
    placed = materialize(page.select("row", "group", slots.alias("found")), "placed-lines")
    each = placed.select("row", "group", F.posexplode("found").alias("k", "x")).select("row", "group", "k", "x.line", "x.class", "x.slot")
    share = lambda keys, value: (
        each.groupBy(*keys, value).agg(F.count("*").alias("m")).groupBy(*keys).agg((F.max("m") / F.sum("m")).alias("agree"), F.max_by(value, F.struct("m", value)).alias(value))
    )
    kept = share(["group", "class", "line"], "slot").withColumnRenamed("agree", "slot_agrees")
    orders = each.groupBy("row", "group", "class").agg(F.hash(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"])).alias("sequence"))
    orders = orders.groupBy("group", "class", "sequence").agg(F.count("*").alias("m")).groupBy("group", "class").agg((F.max("m") / F.sum("m")).alias("order_agrees"))
    judged = fixed.join(kept, ["group", "class", "line"]).join(orders, ["group", "class"])
    # root lines out of order change each other's slots; only those that keep theirs stay
    valid = (F.col("slot_agrees") >= AGREE) & (F.col("root") | (F.col("order_agrees") >= AGREE))
    return judged.withColumn("valid", valid).drop("slot_agrees", "order_agrees")


def _group_lines(pages: DataFrame) -> DataFrame:
    """(row, page, group, pages, at, place, block, line): the lines of pages of hosts and sections with HOST_PAGES different pages or more."""
    groups = F.filter(F.array_distinct(F.array("host", "section")), lambda g: g.isNotNull() & (F.trim(g) != ""))
    own = pages.select("row", "page", F.explode(groups).alias("group"), "lines", "blocks")
    sizes = own.groupBy("group", "page").agg(F.lit(1).alias("one")).groupBy("group").agg(F.count("*").alias("pages")).where(F.col("pages") >= HOST_PAGES)
    own = meet(own, sizes, ["group"], "inner", "group-sizes")
    lines = own.select("row", "page", "group", "pages", F.size("lines").alias("length"), F.posexplode(F.arrays_zip("lines", "blocks")).alias("at", "x"))
    return lines.where("x.lines is not null").select("row", "page", "group", "pages", "at", (F.col("at") / F.col("length")).alias("place"), F.col("x.blocks").alias("block"), F.col("x.lines").alias("line"))


def fixed_blocks(pages: DataFrame) -> DataFrame:
    """(row, block): blocks that the deduced templates hold as fixed, with more fixed lines than slots."""
    valid = materialize(deduced(pages).where("valid").select("group", "line", F.lit(1).alias("fixed")), "valid-lines")
    if valid.isEmpty():
        return pages.limit(0).select("row", F.lit(0).alias("block"))
    lines = _group_lines(pages).select("row", "group", "line", "block")
    votes = meet(lines, valid, ["group", "line"], "left", None).groupBy("row", "group", "block").agg(F.count("fixed").alias("fixed"), F.count("*").alias("n"))
    return votes.where(F.col("fixed") * 2 > F.col("n")).select("row", "block").distinct()


def body_lines(pages: DataFrame) -> DataFrame:
    """(page_table, id, line_no) of the main body's lines, from pages (page_table, id, host, text and, if known, page and section)."""
    parsed = materialize(read_pages(pages), "parsed-pages")
    kept = parsed.where("record is null").select("page_table", "id", "host", "section", "page", "row", *LINE_NAMES)
    kept = meet(kept, cases(parsed).select("row"), ["row"], "left_anti", "residue-pages", 1)
    own = materialize(pooled(kept.where("exists(chrome, x -> not x)")), "pooled-pages")
    needed = (F.col("n") >= MIN_SUPPORT) | ((F.col("pool") != "") & (F.col("chrome_n") < F.col("n")))
    counts = materialize(token_counts(own).where(needed), "token-counts")
    lines = own.select("row", "pool", F.explode(F.arrays_zip("tokens", "blocks", "chrome")).alias("line")).where("not line.chrome")
    lines = lines.select("row", "pool", F.col("line.tokens").alias("token"), F.col("line.blocks").alias("block"))
    # a block with any template line is template as a whole
    classed = meet(lines, sought_tokens(counts), ["pool", "token"], "left_semi", "chrome-tokens").select("row", "block")
    hits = classed.unionByName(fixed_blocks(own.where("pool <> ''"))).groupBy("row").agg(F.collect_set("block").alias("hits"))
    open_lines = own.select("page_table", "id", "row", F.arrays_zip("numbers", "blocks", "chrome").alias("lines"))
    open_lines = meet(open_lines, hits, ["row"], "left", "template-blocks", 1)
    rest = F.filter("lines", lambda x: ~x["chrome"] & ~F.coalesce(F.array_contains("hits", x["blocks"]), F.lit(False)))
    return open_lines.select("page_table", "id", F.explode(rest).alias("line")).select("page_table", "id", F.col("line.numbers").cast("bigint").alias("line_no"))
