"""Finding the column with keywords or URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.functions.urls import looks_like_url

#: Names of keyword and URL columns, in order of precedence.
KEYWORD_NAMES = ["keywords", "keyword", "search term", "search terms", "searchterm", "searchterms", "query", "queries", "term", "terms", "search", "kw"]
URL_NAMES = ["website", "web site", "website url", "website_url", "url", "urls", "link", "links", "site", "web", "domain", "domain name", "company website", "company url"]


def keyword_column(columns: list[str], preferred: str = "Search Keyword") -> str:
    known = {c.strip().lower(): c for c in columns}
    for name in [preferred.strip().lower(), *KEYWORD_NAMES]:
        if name in known:
            return known[name]
    if len(columns) == 1:
        return columns[0]
    raise ValueError(f"no keyword column among {columns}")


def header_row(rows: list[list], names: list[str] | None = None, most: int = 20) -> int | None:
    """The first of the leading rows with a cell that is a known name."""
    known = set(names or KEYWORD_NAMES)
    for i, row in enumerate(rows[:most]):
        if any(str(v).strip().lower() in known for v in row):
            return i
    return None


def url_column_by_name(columns: list[str]) -> str | None:
    """Exact names first, then names that contain one (so ``LinkedIn`` counts as a link)."""
    for c in columns:
        if c.strip().lower() in URL_NAMES:
            return c
    return next((c for c in columns if any(n in c.strip().lower() for n in URL_NAMES)), None)


def url_scores(df: DataFrame, columns: list[str], ord_col: str, sample: int = 200) -> DataFrame:
    """(column_name, n_sampled, score): the share of URL-like values among the first values given.

    The sample of the first values is the feature: a top-k for each column, no full sort.
    """
    parts = []
    for c in columns:
        first = df.where(F.col(f"`{c}`").isNotNull()).orderBy(ord_col).limit(sample).select(F.col(f"`{c}`").cast("string").alias("v"))
        parts.append(
            first.agg(F.count("*").alias("n_sampled"), F.round(F.avg(looks_like_url(F.col("v")).cast("double")), 6).alias("score")).select(
                F.lit(c).alias("column_name"), "n_sampled", "score"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def url_column(df: DataFrame, ord_col: str, least: float = 0.30) -> str | None:
    """The URL column by name, else by values: the first with the best score, if that is enough."""
    columns = [c for c in df.columns if c != ord_col]
    if (named := url_column_by_name(columns)) is not None:
        return named
    if not columns:
        return None
    scores = {r.column_name: r.score or 0.0 for r in url_scores(df, columns, ord_col).collect()}
    best = max(columns, key=lambda c: scores[c])
    return best if scores[best] >= least else None
