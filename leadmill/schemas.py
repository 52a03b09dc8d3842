"""Schemas of the fixed tables."""

LISTING_COLUMNS = [
    "Scraped At", "Search Term", "Title", "Rating", "Reviews Count", "Location", "Timings", "Mobile Number", "Website",
    "Email", "Instagram", "Facebook", "YouTube", "Other Social Links", "Time Taken (sec)", "Status", "Google Maps URL",
]
LISTING = ", ".join(f"`{c}` {'double' if c == 'Time Taken (sec)' else 'string'}" for c in LISTING_COLUMNS)
STATUS_COLUMNS = {"Status Code": "string", "Status Note": "string", "Available": "string"}
PROGRESS = "keyword string, href string"
KEYWORD_STATUS = "keyword string, status string"
WEBSITES = (
    "id bigint, url string, domain string, status string, error_message string, pages_crawled int, time_taken_sec double, "
    "domain_created_at string, domain_expires_at string, domain_age_days int, homepage_markdown string, scraped_at timestamp_ntz"
)
EXTRACTED_RESULTS = (
    "id bigint, website_id bigint, url string, status string, email string, phone string, address string, domain_created_at string, "
    "domain_expires_at string, domain_age_days int, homepage_markdown string, linkedin string, facebook string, instagram string, "
    "twitter string, youtube string, github string, tiktok string, created_at timestamp_ntz"
)
SINGLE = "__SINGLE__"
