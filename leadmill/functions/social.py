"""Social links by platform as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.urls import clean_social_url

#: Link patterns of the platforms, and what is no profile.
PATTERNS = {
    "linkedin": r"(?i)https?://(?:www\.)?linkedin\.com/(?:company|in|pub)/[A-Za-z0-9_\-\.%]+",
    "facebook": r"(?i)https?://(?:www\.)?facebook\.com/(?:pages/)?(?:[A-Za-z0-9_\-\.]+/)?(?:profile\.php\?id=\d+|[A-Za-z0-9_\-\.]+)",
    "instagram": r"(?i)https?://(?:www\.)?instagram\.com/[A-Za-z0-9_\-\.]+",
    "twitter": r"(?i)https?://(?:www\.)?(?:twitter\.com|x\.com)/[A-Za-z0-9_]+",
    "youtube": r"(?i)https?://(?:www\.)?youtube\.com/(?:user/|channel/|c/|@)?[A-Za-z0-9_\-\.]+",
    "github": r"(?i)https?://(?:www\.)?github\.com/[A-Za-z0-9_\-\.]+",
    "tiktok": r"(?i)https?://(?:www\.)?tiktok\.com/@[A-Za-z0-9_\-\.]+",
}
IGNORED = [
    "facebook.com/sharer", "facebook.com/share", "twitter.com/intent", "twitter.com/share",
    "x.com/intent", "x.com/share", "linkedin.com/share", "linkedin.com/sharing",
    "instagram.com/p/", "github.com/features", "github.com/pricing",
]
#: Fixed values of the listing step, in order of precedence.
LISTING_LABELS = {"instagram.com": "Instagram", "facebook.com": "Facebook", "fb.com": "Facebook", "youtube.com": "YouTube", "youtu.be": "YouTube"}
LISTING_OTHER = ["twitter.com", "x.com", "linkedin.com", "tiktok.com", "pinterest.com", "wa.me", "whatsapp.com", "snapchat.com", "threads.net"]


def kept(link: Column) -> Column:
    return ~F.lower(link).rlike("|".join(p.replace(".", r"\.") for p in IGNORED))


def from_text(text: Column, platform: str) -> Column:
    """Sorted distinct links of one platform in a text."""
    found = F.transform(F.regexp_extract_all(text, F.lit(PATTERNS[platform]), F.lit(0)), clean_social_url)
    return F.array_sort(F.array_distinct(F.filter(found, kept)))


def joined(links: Column) -> Column:
    return F.array_join(F.array_sort(links), ", ")


def listing_label(href: Column) -> Column:
    """The column a link belongs to, by the first domain contained in it; null for other links."""
    low = F.lower(href)
    out = F.when(F.lit(False), F.lit(""))
    for domain, label in LISTING_LABELS.items():
        out = out.when(F.contains(low, F.lit(domain)), F.lit(label))
    for domain in LISTING_OTHER:
        out = out.when(F.contains(low, F.lit(domain)), F.lit("Other Social Links"))
    return out
