"""The queries of the llm subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm import addresses, boilerplate, bpe, formatting_dupes, line_spam, mixing, residue
from leadmill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find_residue(table(spark, sf_dir, "websites"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.same_building(table(spark, sf_dir, "extracted_results"), table(spark, sf_dir, "localities"))


def p3_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which building each row names: the classes behind p3_found, without pairs."""
    return addresses.buildings(table(spark, sf_dir, "extracted_results"), table(spark, sf_dir, "localities"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of both tables, each with the host of its URL and the host and path, which tell pages apart."""
    host = residue.host_of(F.col("url"))
    page = F.regexp_extract(F.lower("url"), r"^\s*(?:[a-z][a-z0-9+.\-]*:)?/*(?:www\.)?([^?#\s]*?)/*(?:[?#\s]|$)", 1)
    section = F.regexp_extract(page, r"^[^/]*/([^/]+)/", 1)
    return spark_union(
        table(spark, sf_dir, name).select(
            F.lit(name).alias("page_table"), F.col("id").cast("bigint").alias("id"), host.alias("host"), page.alias("page"),
            F.when(section != "", section).alias("section"), F.col("homepage_markdown").alias("text"),
        )
        for name in ("websites", "extracted_results")
    )


def spark_union(parts) -> DataFrame:
    first, *rest = parts
    for p in rest:
        first = first.unionByName(p)
    return first


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.body_lines(_pages(spark, sf_dir))


def p4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.page_templates(_pages(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting_dupes.copies(table(spark, sf_dir, "final_output"), "lead_id", "Website", "Mobile Number")


def p5_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = formatting_dupes.collapse_all(table(spark, sf_dir, "final_output"), "lead_id", "Website", "Mobile Number")
    return records.withColumnRenamed("id", "lead_id")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_table(table(spark, sf_dir, "documents"))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts encoded and decoded again; the SQL twin gives the texts themselves."""
    return bpe.decode_table(p6_ids(spark, sf_dir))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spam.find_line_spam(table(spark, sf_dir, "documents"))


_P5_KEYS = r"""
WITH squeezed AS (
  SELECT lead_id, "Website" AS a, "Mobile Number" AS b,
         regexp_replace(lower("Website"), '[\s\pZ\pC]+', '', 'g') AS sa,
         regexp_replace(lower("Mobile Number"), '[\s\pZ\pC]+', '', 'g') AS sb
  FROM final_output),
canon AS (
  SELECT lead_id,
    {0} AS ca, {1} AS cb
  FROM squeezed WHERE sa NOT IN ('', 'notavailable') AND sb NOT IN ('', 'notavailable')),
keyed AS (SELECT lead_id, least(ca, cb) || '|' || greatest(ca, cb) AS k FROM canon),
firsts AS (SELECT lead_id, min(lead_id) OVER (PARTITION BY k) AS first_id, count(*) OVER (PARTITION BY k) AS n FROM keyed)
"""


def _canon(c: str, s: str) -> str:
    web = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({s}, '^[^\\pL\\pN]+', ''), '^https?:/*', ''), '^www\\.', ''), '[^\\pL\\pM\\pN]+', '', 'g')"
    spaced = f"regexp_replace(regexp_replace(lower({c}), '\\p{{Cf}}+', '', 'g'), '[\\s\\pZ\\p{{Cc}}]+', ' ', 'g')"
    parts = f"list_transform(string_split_regex({spaced}, '[,;|]| /+ '), lambda x: regexp_replace(x, '[^\\pL\\pM\\pN]+', '', 'g'))"
    phone = f"array_to_string(list_sort(list_distinct(list_filter({parts}, lambda x: x <> ''))), ',')"
    return f"CASE WHEN regexp_matches({s}, '[\\pL\\pN]\\.\\pL{{2,}}') THEN {web} ELSE coalesce({phone}, '') END"


_P5 = _P5_KEYS.replace("{0}", _canon("a", "sa")).replace("{1}", _canon("b", "sb"))

QUERIES: dict[str, Query] = {
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_buildings": p3_buildings,
    "p4_found": p4_found,
    "p4_templates": p4_templates,
    "p5_found": p5_found,
    "p5_collapsed": p5_collapsed,
    "p6_ids": p6_ids,
    "p6_decoded": p6_decoded,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
}
SQL: dict[str, str] = {
    "p5_found": _P5 + "SELECT first_id, lead_id AS copy_id FROM firsts WHERE lead_id <> first_id",
    "p5_collapsed": _P5 + "SELECT lead_id, n AS n_copies FROM firsts WHERE lead_id = first_id UNION ALL SELECT lead_id, 1 FROM squeezed WHERE NOT coalesce(sa NOT IN ('', 'notavailable') AND sb NOT IN ('', 'notavailable'), false)",
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
