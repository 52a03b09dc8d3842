"""The core queries: name -> (spark, sf_dir) -> DataFrame, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.functions import dates, emails, html, phones, social, status, text, urls
from leadmill.operators import columns, crawl, dedupe, exports, state
from leadmill.operators.packed_fields import unpack_fields
from leadmill.plans import catalog_html, catalog_io, catalog_listings
from leadmill.plans import sql_parts as S
from leadmill.session import materialize, spread, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: The clock of all queries that need one.
NOW = "2026-01-01 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "final_output").select(
        "lead_id", F.col("Website").alias("website"), F.col("Mobile Number").alias("phone"), F.col("Title").alias("title")
    )


LEADS = '(SELECT lead_id, "Website" AS website, "Mobile Number" AS phone, "Title" AS title FROM final_output)'


# --- packed fields ------------------------------------------------------------


@query()
def p1_found(spark, sf_dir):
    return unpack_fields(table(spark, sf_dir, "extracted_results"))


# --- URLs -----------------------------------------------------------------------


@query(f"""
    WITH u AS (SELECT id, url AS original_url, {S.root_url('url')} AS website, {S.bare_domain('url')} AS domain FROM websites),
    r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY id) AS k FROM u WHERE domain <> '' AND website <> '' AND NOT {S.is_platform('domain')})
    SELECT website, domain, original_url FROM r WHERE k = 1""")
def clean_urls_by_domain(spark, sf_dir):
    return dedupe.clean_urls(table(spark, sf_dir, "websites"), "url", "id")


#: The hosts of the test data end in reserved names; the real platforms are put in their place.
_SOCIAL_UNION = " UNION ALL ".join(f"SELECT id, replace({c}, '.example/', '.com/') AS url FROM extracted_results WHERE {c} <> ''" for c in exports.SOCIAL)


def social_links(spark, sf_dir):
    real = [F.replace(c, F.lit(".example/"), F.lit(".com/")) for c in exports.SOCIAL]
    return table(spark, sf_dir, "extracted_results").select("id", F.explode(F.array(*real)).alias("url")).where("url <> ''")


@query(f"""SELECT id, url, domain FROM (SELECT id, url, {S.bare_domain('url')} AS domain FROM (SELECT id, url FROM websites UNION ALL {_SOCIAL_UNION}))
    WHERE {S.is_platform('domain')}""")
def social_platform_filter(spark, sf_dir):
    every = table(spark, sf_dir, "websites").select("id", "url").unionByName(social_links(spark, sf_dir))
    return every.withColumn("domain", urls.bare_domain(F.col("url"))).where(urls.is_platform(F.col("domain")))


@query(f"""SELECT id, {S.netloc('url')} AS netloc, {S.bare_domain('url')} AS bare_domain, {S.root_url('url')} AS root,
    CASE WHEN {S.strip('url')} IN ('', 'nan', 'none', 'null') THEN '' WHEN regexp_matches(lower({S.strip_chars(S.strip('url'), chr(34) + chr(39))}), '^https?://')
      THEN {S.strip_chars(S.strip('url'), chr(34) + chr(39))} ELSE 'https://' || {S.strip_chars(S.strip('url'), chr(34) + chr(39))} END AS probe
    FROM websites""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "websites").select(
        "id", urls.netloc(u).alias("netloc"), urls.bare_domain(u).alias("bare_domain"), urls.root_url(u).alias("root"), urls.probe_url(u).alias("probe")
    )


@query(f"""SELECT lead_id, unnest([{S.quoted(urls.CONTACT_PATHS)}]) AS path,
    regexp_replace({S.root_url('website')}, '/+$', '') || path AS contact_url FROM {LEADS} WHERE {S.root_url('website')} <> ''""")
def contact_paths(spark, sf_dir):
    root = leads(spark, sf_dir).select("lead_id", urls.root_url(F.col("website")).alias("root")).where("root <> ''")
    return root.select("lead_id", F.explode(urls.contact_urls(F.col("root"))).alias("contact_url")).select(
        "lead_id", F.regexp_extract("contact_url", r"(/[a-z\-]+)$", 1).alias("path"), "contact_url"
    )


# --- leads: filters and de-duplication ----------------------------------------------

_CONTACT = f"SELECT * FROM {LEADS} WHERE {S.has_value('website')} OR {S.has_value('phone')}"
_CASCADE = f"""
    WITH c0 AS ({_CONTACT}),
    c1 AS (SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY {S.phone_key('phone', 'lead_id')} ORDER BY lead_id) AS k FROM c0) WHERE k = 1),
    c2 AS (SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY {S.site_key('website', 'lead_id')} ORDER BY lead_id) AS k FROM c1) WHERE k = 1),
    c3 AS (SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN {S.has_value('website')} AND {S.has_value('phone')}
        THEN {S.site_key('website', 'lead_id')} || '||' || {S.phone_key('phone', 'lead_id')} ELSE '||row' || lead_id END ORDER BY lead_id) AS k FROM c2) WHERE k = 1)"""


@query(_CONTACT)
def lead_has_contact(spark, sf_dir):
    return dedupe.with_contact(leads(spark, sf_dir), "website", "phone")


@query(f"SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY {S.phone_key('phone', 'lead_id')} ORDER BY lead_id) AS k FROM {LEADS}) WHERE k = 1")
def lead_phone_dedupe(spark, sf_dir):
    return dedupe.dedupe_by_phone(leads(spark, sf_dir), "phone", "lead_id")


@query(f"SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY {S.site_key('website', 'lead_id')} ORDER BY lead_id) AS k FROM {LEADS}) WHERE k = 1")
def lead_website_dedupe(spark, sf_dir):
    return dedupe.dedupe_by_site(leads(spark, sf_dir), "website", "lead_id")


@query(_CASCADE + " SELECT * FROM c2")
def lead_cascade(spark, sf_dir):
    return dedupe.cascade(leads(spark, sf_dir), "website", "phone", "lead_id")


@query(_CASCADE + " SELECT * FROM c3")
def lead_cascade_third_pass(spark, sf_dir):
    return dedupe.dedupe_by_both(dedupe.cascade(leads(spark, sf_dir), "website", "phone", "lead_id"), "website", "phone", "lead_id")


@query(_CASCADE + f"""
    , n AS (SELECT 0 AS k, 'input' AS stage, count(*) AS n_rows FROM {LEADS} UNION ALL SELECT 1, 'has_contact', count(*) FROM c0 UNION ALL
      SELECT 2, 'phone', count(*) FROM c1 UNION ALL SELECT 3, 'website', count(*) FROM c2 UNION ALL SELECT 4, 'phone_and_website', count(*) FROM c3)
    SELECT stage, n_rows, coalesce(lag(n_rows) OVER (ORDER BY k) - n_rows, 0) AS n_removed FROM n""")
def dedupe_stage_counts(spark, sf_dir):
    return dedupe.stage_counts(leads(spark, sf_dir), "website", "phone", "lead_id")


# --- probe results -----------------------------------------------------------------

_CHECKED = '(SELECT lead_id, "Website" AS website, "Status Code" AS code, "Status Note" AS note, "Available" AS available FROM status_checked)'


def checked(spark, sf_dir):
    return table(spark, sf_dir, "status_checked").select(
        "lead_id", F.col("Website").alias("website"), F.col("Status Code").alias("code"), F.col("Status Note").alias("note"), F.col("Available").alias("available")
    )


@query(f"""SELECT lead_id, code, {S.status_note('code')} AS note, CASE WHEN try_cast({S.strip('code')} AS INT) < 400 THEN 'Yes' ELSE 'No' END AS available FROM {_CHECKED}""")
def status_classify(spark, sf_dir):
    code = F.col("code")
    number = text.py_strip(code).try_cast("int")
    return checked(spark, sf_dir).select("lead_id", "code", status.status_note(code).alias("note"), F.when(number < 400, "Yes").otherwise("No").alias("available"))


@query(f"""
    WITH p AS (SELECT lead_id, website, CASE lead_id % 6 WHEN 0 THEN 403 WHEN 1 THEN 405 WHEN 2 THEN 200 WHEN 3 THEN 399 WHEN 4 THEN 418 ELSE NULL END AS head,
        CASE WHEN lead_id % 2 = 0 THEN 200 ELSE 404 END AS get, CASE lead_id % 11 WHEN 0 THEN 'Timeout' WHEN 1 THEN 'SSLError' WHEN 2 THEN 'ChunkedEncodingError' END AS exc FROM {LEADS}),
    q AS (SELECT *, CASE WHEN head IN (403, 405, 501) THEN get ELSE head END AS c, website IS NULL OR lower({S.strip('website')}) IN ('', 'nan', 'none', 'null') AS blank FROM p)
    SELECT lead_id, CASE WHEN blank THEN NULL WHEN exc IS NOT NULL THEN 'Error' ELSE CAST(c AS VARCHAR) END AS code,
      CASE WHEN blank THEN 'No URL' WHEN exc = 'Timeout' THEN 'Timeout' WHEN exc = 'SSLError' THEN 'SSL Error' WHEN exc IS NOT NULL THEN 'Error: ' || exc ELSE {S.status_note('CAST(c AS VARCHAR)')} END AS note,
      CASE WHEN NOT blank AND exc IS NULL AND c < 400 THEN 'Yes' ELSE 'No' END AS available FROM q""")
def probe_outcomes(spark, sf_dir):
    k = F.col("lead_id")
    pick = lambda m, values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (k % m + 1).cast("int"))
    probed = leads(spark, sf_dir).select(
        "lead_id", "website",
        pick(6, [403, 405, 200, 399, 418, None]).cast("int").alias("head"),
        F.when(k % 2 == 0, 200).otherwise(404).alias("get"),
        pick(11, ["Timeout", "SSLError", "ChunkedEncodingError"] + [None] * 8).alias("exc"),
    )
    outcome = status.probe_outcome(urls.probe_url(F.col("website")), F.col("head"), F.col("get"), F.col("exc"))
    return probed.select("lead_id", outcome.alias("o")).select("lead_id", "o.code", "o.note", "o.available")


@query(f"""
    WITH a AS (SELECT lead_id, website AS original_url, {S.root_url('website')} AS website, {S.bare_domain('website')} AS domain FROM (SELECT lead_id, {S.strip('website')} AS website, available FROM {_CHECKED})
      WHERE lower({S.strip('available')}) = 'yes' AND website <> ''),
    r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY lead_id) AS k FROM a WHERE domain <> '' AND website <> '' AND NOT {S.is_platform('domain')})
    SELECT website, domain, original_url FROM r WHERE k = 1""")
def status_available_clean(spark, sf_dir):
    kept = checked(spark, sf_dir).where(status.is_available(F.col("available"))).withColumn("website", text.py_strip(F.col("website"))).where("website <> ''")
    return dedupe.clean_urls(kept, "website", "lead_id")


@query(f"SELECT lead_id, code FROM {_CHECKED} WHERE code IS NULL OR lower({S.strip('code')}) IN ('', 'nan', 'none', 'nat')")
def status_pending(spark, sf_dir):
    return checked(spark, sf_dir).where(~text.has_result(F.col("code"))).select("lead_id", "code")


@query("""
    SELECT f.lead_id, f."Website" AS website, s."Status Code" AS code, s."Available" AS available
    FROM final_output f LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY "Status Code" NULLS FIRST, "Available" NULLS FIRST) AS k FROM status_checked) WHERE k = 1) s USING (lead_id)""")
def status_reattach(spark, sf_dir):
    one = dedupe.keep_first(checked(spark, sf_dir), F.col("lead_id"), F.col("code").asc_nulls_first(), F.col("available").asc_nulls_first())
    return leads(spark, sf_dir).select("lead_id", "website").join(one.select("lead_id", "code", "available"), "lead_id", "left")


def _score_sql(c: str) -> str:
    s = S.strip("v")
    tested = f"CASE WHEN regexp_matches(lower({s}), '^(http://|https://|www\\.)') THEN {s} ELSE 'https://' || {s} END"
    return f"""SELECT '{c}' AS column_name, count(*) AS n_sampled, round(avg(CASE WHEN {s} <> '' AND contains({S.netloc(tested)}, '.') THEN 1.0 ELSE 0.0 END), 6) AS score
      FROM (SELECT "{c}" AS v FROM final_output WHERE "{c}" IS NOT NULL ORDER BY lead_id LIMIT 200)"""


@query(" UNION ALL ".join(_score_sql(c) for c in ["Title", "Website", "Mobile Number", "Location"]))
def url_column_score(spark, sf_dir):
    return columns.url_scores(table(spark, sf_dir, "final_output"), ["Title", "Website", "Mobile Number", "Location"], "lead_id")


# --- e-mail ----------------------------------------------------------------------------


@query(f"SELECT doc_id, email FROM (SELECT doc_id, unnest({S.listing_emails('text')}) AS email FROM documents)")
def email_candidates_junk_filtered(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(emails.listing_candidates(F.col("text"))).alias("email"))


@query(f"SELECT doc_id, unnest({S.emails_of('text')}) AS email FROM documents")
def email_valid_strict(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(emails.from_text(F.col("text"))).alias("email"))


@query(f"SELECT doc_id, coalesce(list_min({S.listing_emails('text')}), 'Not available') AS email FROM documents")
def email_top1(spark, sf_dir):
    best = F.coalesce(emails.smallest(emails.listing_candidates(F.col("text"))), F.lit(text.NOT_AVAILABLE))
    return table(spark, sf_dir, "documents").select("doc_id", best.alias("email"))


@query(f"SELECT DISTINCT unnest({S.from_labeled('email')}) AS email FROM extracted_results ORDER BY email")
def emails_flat_distinct(spark, sf_dir):
    return exports.flat_emails(table(spark, sf_dir, "extracted_results")).orderBy("email")


_BY_SITE = f"SELECT site, list_sort(list_distinct(flatten(list({S.emails_of('text')})))) AS found FROM documents WHERE site IS NOT NULL GROUP BY site"


@query(f"SELECT site, {S.labeled('found')} AS email, len(found) AS n_emails FROM ({_BY_SITE})")
def emails_labeled(spark, sf_dir):
    each = table(spark, sf_dir, "documents").where("site is not null").select("site", F.explode_outer(emails.from_text(F.col("text"))).alias("e"))
    pairs = materialize(each.distinct(), "site-emails")
    # only what is shown is collected, the first addresses of a site; all are counted
    place = F.row_number().over(Window.partitionBy("site").orderBy(F.col("e").asc_nulls_last()))
    shown = pairs.withColumn("place", place).where(F.col("place") <= emails.MAX_LABELED).groupBy("site").agg(F.array_sort(F.collect_list("e")).alias("found"))
    counts = pairs.groupBy("site").agg(F.count("e").alias("n_emails"))
    return shown.join(counts, "site").select("site", emails.labeled(F.col("found")).alias("email"), "n_emails")


@query(f"""SELECT site, {', '.join(f"coalesce(found[{i}], '') AS email_{i}" for i in range(1, 11))} FROM ({_BY_SITE})""")
def emails_wide(spark, sf_dir):
    back = emails.from_labeled(F.col("email"))
    return emails_labeled(spark, sf_dir).select("site", *[F.coalesce(F.get(back, F.lit(i)), F.lit("")).alias(f"email_{i + 1}") for i in range(10)])


@query(f"""
    WITH k AS (SELECT id, unnest({S.from_labeled('email')}) AS email FROM extracted_results)
    SELECT DISTINCT id, email, email AS decoded FROM k""")
def cf_email_decode(spark, sf_dir):
    found = table(spark, sf_dir, "extracted_results").select("id", F.explode(emails.from_labeled(F.col("email"))).alias("email")).distinct()
    # encode with the key 0x2a, then decode
    codes = F.transform(F.split("email", ""), lambda c: F.lower(F.lpad(F.hex(F.ascii(c).bitwiseXOR(F.lit(42))), 2, "0")))
    return found.select("id", "email", emails.decode_cloudflare(F.concat(F.lit("2a"), F.array_join(codes, ""))).alias("decoded"))


# --- phones ------------------------------------------------------------------------------


#: Letters as x: a word's border behind a digit is then the same in both engines.
_LETTERS_X = r"regexp_replace(text, '[\pL\pM\p{No}\p{Nl}]', 'x', 'g')"


@query(f"SELECT doc_id, unnest(regexp_extract_all({_LETTERS_X}, '{phones.CANDIDATE}', 0)) AS phone FROM documents")
def phones_extracted(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(phones.candidates(F.col("text"))).alias("phone"))


@query(f"SELECT id, {S.country_hint('homepage_markdown', 'domain')} AS hint FROM websites")
def country_hints(spark, sf_dir):
    return table(spark, sf_dir, "websites").select("id", phones.country_hint(F.col("homepage_markdown"), F.col("domain")).alias("hint"))


@query(f"""
    WITH c AS (SELECT doc_id, unnest(regexp_extract_all({_LETTERS_X}, '{phones.CANDIDATE}', 0)) AS p, {S.country_hint('text', 'site')} AS hint FROM documents),
    {S.phone_steps('c', 'doc_id, p')} SELECT doc_id, p AS phone, cleaned FROM ph5""")
def phones_clean(spark, sf_dir):
    each = table(spark, sf_dir, "documents").select("doc_id", F.explode(phones.candidates(F.col("text"))).alias("phone"), phones.country_hint(F.col("text"), F.col("site")).alias("hint"))
    return phones.with_clean_phone(each, "phone", "hint", "cleaned").select("doc_id", "phone", "cleaned")


@query(f"""
    WITH j AS (SELECT r.id, r.phone, {S.country_hint("concat_ws(' ', nullif(r.address, ''), nullif(r.homepage_markdown, ''))", 'w.domain')} AS hint
      FROM extracted_results r JOIN websites w ON w.id = r.website_id WHERE r.phone <> ''),
    n AS (SELECT id, phone, hint, unnest(list_filter(list_transform(string_split(phone, ','), lambda x: {S.strip('x')}), lambda x: x <> '')) AS num,
      generate_subscripts(list_filter(list_transform(string_split(phone, ','), lambda x: {S.strip('x')}), lambda x: x <> ''), 1) AS i FROM j),
    b AS (SELECT *, regexp_replace(num, '[^0-9]', '', 'g') AS dg FROM n),
    c AS (SELECT *, CASE WHEN starts_with(dg, '91') AND length(dg) = 12 THEN substr(dg, 3) WHEN starts_with(dg, '1') AND length(dg) = 11 THEN substr(dg, 2) ELSE dg END AS p FROM b),
    {S.phone_steps('c', 'id, phone, num, i, p')},
    f AS (SELECT id, phone, i, CASE WHEN length(p) = 10 THEN coalesce(cleaned, num) ELSE num END AS num FROM ph5),
    u AS (SELECT id, phone, num, min(i) AS i FROM f GROUP BY ALL),
    g AS (SELECT id, string_agg(num, ', ' ORDER BY i) AS fixed FROM u GROUP BY id)
    SELECT j.id, j.phone, coalesce(g.fixed, '') AS fixed, coalesce(g.fixed, '') <> j.phone AS changed FROM j LEFT JOIN g USING (id)""")
def phones_recheck(spark, sf_dir):
    r, w = table(spark, sf_dir, "extracted_results").alias("r"), table(spark, sf_dir, "websites").alias("w")
    context = F.concat_ws(" ", F.nullif("r.address", F.lit("")), F.nullif("r.homepage_markdown", F.lit("")))
    each = r.where("phone <> ''").select("r.id", "r.phone", "r.website_id", context.alias("context"))
    met = each.join(w.select(F.col("w.id").alias("website_id"), "w.domain"), "website_id")
    hinted = met.select("id", "phone", phones.country_hint(F.col("context"), F.col("domain")).alias("hint"))
    return phones.recheck_table(hinted, "id", "phone", "hint").withColumn("changed", F.col("fixed") != F.col("phone"))


@query(f"""
    WITH r AS (SELECT id, email, {S.labeled(S.from_labeled('email'))} AS fixed, len({S.from_labeled('email')}) AS n FROM extracted_results WHERE email <> '')
    SELECT id, CASE WHEN n > 0 THEN fixed ELSE email END AS email, n > 0 AND fixed <> email AS changed FROM r""")
def emails_recheck(spark, sf_dir):
    found = emails.from_labeled(F.col("email"))
    each = table(spark, sf_dir, "extracted_results").where("email <> ''").select("id", "email", emails.labeled(found).alias("fixed"), F.size(found).alias("n"))
    changed = (F.col("n") > 0) & (F.col("fixed") != F.col("email"))
    return each.select("id", F.when(F.col("n") > 0, F.col("fixed")).otherwise(F.col("email")).alias("email"), changed.alias("changed"))


# --- social links ---------------------------------------------------------------------------

_SOCIAL_TEXT = f"replace(concat_ws(' ', {', '.join(exports.SOCIAL)}, homepage_markdown), '.example/', '.com/')"


@query(f"""SELECT id, {', '.join(f"array_to_string({S.social_of(_SOCIAL_TEXT, p)}, ', ') AS {p}" for p in exports.SOCIAL)} FROM extracted_results""")
def social_links_text(spark, sf_dir):
    each = table(spark, sf_dir, "extracted_results").select("id", F.replace(F.concat_ws(" ", *exports.SOCIAL, "homepage_markdown"), F.lit(".example/"), F.lit(".com/")).alias("t"))
    return each.select("id", *[social.joined(social.from_text(F.col("t"), p)).alias(p) for p in exports.SOCIAL])


def _label_sql(c: str) -> str:
    known = [(d, n) for d, n in social.LISTING_LABELS.items()] + [(d, "Other Social Links") for d in social.LISTING_OTHER]
    return "CASE " + " ".join(f"WHEN contains(lower({c}), '{d}') THEN '{n}'" for d, n in known) + " END"


@query(f"""
    WITH l AS (SELECT DISTINCT id, url, {_label_sql('url')} AS label FROM ({_SOCIAL_UNION}))
    SELECT id, label, string_agg(url, ' | ' ORDER BY url) AS links FROM l WHERE label IS NOT NULL GROUP BY id, label""")
def social_links_listing(spark, sf_dir):
    labelled = social_links(spark, sf_dir).distinct().withColumn("label", social.listing_label(F.col("url"))).where("label is not null")
    return labelled.groupBy("id", "label").agg(F.array_join(F.array_sort(F.collect_list("url")), " | ").alias("links"))


# --- queue and state ------------------------------------------------------------------------


@query("SELECT " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in state.STATUSES) + ", count(*) AS total FROM websites")
def queue_stats(spark, sf_dir):
    return state.queue_stats(table(spark, sf_dir, "websites"))


_QUEUE_URL = f"CASE WHEN starts_with({S.strip('website')}, 'http') THEN {S.strip('website')} ELSE 'https://' || {S.strip('website')} END"


@query(f"""
    WITH q AS (SELECT lead_id, {_QUEUE_URL} AS url FROM {LEADS} WHERE {S.has_value('website')}),
    f AS (SELECT url, min(lead_id) AS o FROM q WHERE url NOT IN (SELECT url FROM websites WHERE url IS NOT NULL) GROUP BY url)
    SELECT (SELECT max(id) FROM websites) + row_number() OVER (ORDER BY o) AS id, url, lower({S.netloc('url')}) AS domain, 'pending' AS status FROM f""")
def queue_load_new(spark, sf_dir):
    incoming = leads(spark, sf_dir).where(text.has_value(F.col("website")))
    return state.new_urls(incoming, "website", "lead_id", table(spark, sf_dir, "websites"))


@query("SELECT id, CASE WHEN id IN (SELECT id FROM websites WHERE status = 'pending' ORDER BY id LIMIT 24) THEN 'processing' ELSE status END AS status FROM websites")
def queue_claim(spark, sf_dir):
    return state.claimed(table(spark, sf_dir, "websites"), 24).select("id", "status")


@query("SELECT id, CASE WHEN status = 'processing' THEN 'pending' ELSE status END AS status FROM websites")
def queue_reset(spark, sf_dir):
    return state.reset_interrupted(table(spark, sf_dir, "websites")).select("id", "status")


@query("SELECT id, CASE WHEN status IN ('failed', 'no_data') THEN 'pending' ELSE status END AS status, CASE WHEN status IN ('failed', 'no_data') THEN NULL ELSE error_message END AS error_message FROM websites")
def queue_requeue(spark, sf_dir):
    return state.requeue(table(spark, sf_dir, "websites"), ["failed", "no_data"]).select("id", "status", "error_message")


@query("SELECT r.id, CASE WHEN w.status IN ('failed', 'no_data') THEN 'pending' ELSE r.status END AS status FROM extracted_results r LEFT JOIN websites w ON w.id = r.website_id")
def queue_requeue_results(spark, sf_dir):
    return state.requeue_results(table(spark, sf_dir, "extracted_results"), table(spark, sf_dir, "websites"), ["failed", "no_data"]).select("id", "status")


@query("""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY website_id ORDER BY id DESC) AS k FROM extracted_results),
    up AS (SELECT website_id, id, email FROM r WHERE k = 1),
    base AS (SELECT id AS website_id, CAST(NULL AS BIGINT) AS id, CAST('' AS VARCHAR) AS email FROM websites)
    SELECT * FROM up UNION ALL SELECT * FROM base WHERE website_id NOT IN (SELECT website_id FROM up)""")
def result_upsert(spark, sf_dir):
    results = table(spark, sf_dir, "extracted_results").select("website_id", "id", "email")
    newest = dedupe.keep_first(results, F.col("website_id"), F.col("id").desc())
    base = table(spark, sf_dir, "websites").select(F.col("id").alias("website_id"), F.lit(None).cast("bigint").alias("id"), F.lit("").alias("email"))
    return state.merge(base, newest, "website_id")


@query("""SELECT DISTINCT "Search Term" AS keyword, "Google Maps URL" AS href FROM final_output f WHERE "Search Term" IS NOT NULL AND "Google Maps URL" IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM progress p WHERE p.keyword = f."Search Term" AND p.href = f."Google Maps URL")""")
def progress_resume(spark, sf_dir):
    seen = table(spark, sf_dir, "final_output").select(F.col("Search Term").alias("keyword"), F.col("Google Maps URL").alias("href")).where("keyword is not null and href is not null")
    return state.missing_keys(seen, table(spark, sf_dir, "progress").select("keyword", "href"), "keyword", "href")


@query("""
    WITH k AS (SELECT "Search Term" AS keyword, count(*) AS n_listings FROM final_output WHERE "Search Term" IS NOT NULL GROUP BY 1),
    d AS (SELECT keyword, count(DISTINCT href) AS n_done, max(CASE WHEN href = '__SINGLE__' THEN 1 ELSE 0 END) AS single FROM progress WHERE keyword IS NOT NULL GROUP BY 1)
    SELECT keyword, coalesce(n_listings, 0) AS n_listings, coalesce(n_done, 0) AS n_done,
      CASE WHEN coalesce(n_done, 0) >= coalesce(n_listings, 0) OR coalesce(single, 0) = 1 THEN 'Completed' ELSE 'Not Completed' END AS status
    FROM k FULL JOIN d USING (keyword)""")
def keyword_status_rollup(spark, sf_dir):
    k = table(spark, sf_dir, "final_output").where("`Search Term` is not null").groupBy(F.col("Search Term").alias("keyword")).agg(F.count("*").alias("n_listings"))
    d = (
        table(spark, sf_dir, "progress").where("keyword is not null").groupBy("keyword")
        .agg(F.countDistinct("href").alias("n_done"), F.max(F.when(F.col("href") == "__SINGLE__", 1).otherwise(0)).alias("single"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    done = (zero("n_done") >= zero("n_listings")) | (zero("single") == 1)
    return k.join(d, "keyword", "full").select(
        "keyword", zero("n_listings").cast("bigint").alias("n_listings"), zero("n_done").cast("bigint").alias("n_done"),
        F.when(done, "Completed").otherwise("Not Completed").alias("status"),
    )


@query("""
    WITH k AS (SELECT "Search Term" AS keyword, count(*) FILTER (lower(trim("Status")) = 'success') AS n_success, count(*) AS n FROM final_output GROUP BY 1)
    SELECT count(*) AS n_keywords, count(*) FILTER (n_success = n) AS n_complete, sum(n) AS n_records FROM k""")
def keyword_totals(spark, sf_dir):
    k = table(spark, sf_dir, "final_output").groupBy("Search Term").agg(F.count_if(F.lower(F.trim("Status")) == "success").alias("s"), F.count("*").alias("n"))
    return k.agg(F.count("*").alias("n_keywords"), F.count_if(F.col("s") == F.col("n")).alias("n_complete"), F.sum("n").alias("n_records"))


@query("""
    WITH o AS (SELECT "Search Term" AS keyword, lead_id, coalesce(nullif(regexp_replace("Title", '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g'), ''), 'Not available') AS title FROM final_output)
    SELECT keyword, lead_id, title, row_number() OVER (PARTITION BY keyword ORDER BY lead_id) AS place FROM o""")
def results_by_keyword(spark, sf_dir):
    each = table(spark, sf_dir, "final_output").select(F.col("Search Term").alias("keyword"), "lead_id", text.or_not_available(F.col("Title")).alias("title"))
    return state.numbered_within(each, "keyword", "lead_id").withColumn("place", F.col("place").cast("bigint"))


@query('SELECT "Search Term" AS keyword, arg_max(coalesce("Google Maps URL", \'\'), lead_id) AS href, count(*) AS n FROM final_output WHERE "Search Term" IS NOT NULL GROUP BY 1')
def progress_last(spark, sf_dir):
    """The last link of each keyword by the order of the rows."""
    rows = table(spark, sf_dir, "final_output").where(F.col("Search Term").isNotNull())
    return rows.groupBy(F.col("Search Term").alias("keyword")).agg(F.max_by(F.coalesce("Google Maps URL", F.lit("")), "lead_id").alias("href"), F.count("*").alias("n"))


# --- exports ---------------------------------------------------------------------------------

_JOIN = "FROM websites w LEFT JOIN extracted_results r ON w.id = r.website_id"
_WIDE_SQL = (
    "SELECT w.id, coalesce(strftime(w.scraped_at, '%Y-%m-%d %H:%M:%S'), '') AS timestamp, coalesce(w.url, '') AS website, "
    + ", ".join(f"coalesce(({S.from_labeled('r.email')})[{i}], '') AS \"email {i}\"" for i in range(1, 11))
    + ", " + ", ".join(f"coalesce(CAST(r.{c} AS VARCHAR), '') AS {c}" for c in ("phone", "address"))
    + ", " + ", ".join(f"coalesce(CAST(w.{c} AS VARCHAR), '') AS {c}" for c in ("domain_created_at", "domain_expires_at", "domain_age_days", "homepage_markdown"))
    + ", " + ", ".join(f"coalesce(r.{c}, '') AS {c}" for c in exports.SOCIAL)
    + f", coalesce(w.pages_crawled, 0) AS pages_crawled, coalesce(w.time_taken_sec, 0.0) AS time_taken_sec, coalesce(w.status, '') AS status {_JOIN}"
)


@query(_WIDE_SQL)
def export_wide(spark, sf_dir):
    return exports.wide(table(spark, sf_dir, "websites"), table(spark, sf_dir, "extracted_results"))


@query()
def export_json(spark, sf_dir):
    return exports.nested(table(spark, sf_dir, "websites"), table(spark, sf_dir, "extracted_results"))


@query("""SELECT doc_id, CASE WHEN length(c) > 32000 THEN left(c, 32000) || ' ...[truncated, see CSV for full text]' ELSE c END AS cell
    FROM (SELECT doc_id, regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS c FROM documents)""")
def excel_safe(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.excel_safe(F.col("text")).alias("cell"))


# --- scalars ---------------------------------------------------------------------------------

@query(f"""
    WITH a AS (SELECT lead_id, {S.strip('"Timings"')} AS t FROM final_output),
    b AS (SELECT lead_id, replace(replace(replace(t, ' ', ' '), ' ', ' '), ':00', '') AS t FROM a),
    c AS (SELECT lead_id, {S.strip("regexp_replace(regexp_replace(t, '[ 	-\r ]*(to|-|–|—)[ 	-\r ]*', '–', 'g'), '[ 	-\r ]+', ' ', 'g')")} AS t FROM b)
    SELECT lead_id, coalesce(regexp_replace(regexp_replace(t, '\\bAM\\b', 'am', 'g'), '\\bPM\\b', 'pm', 'g'), '') AS timings FROM c""")
def hours_normalize(spark, sf_dir):
    return table(spark, sf_dir, "final_output").select("lead_id", text.normalize_time_range(F.col("Timings")).alias("timings"))


@query("""SELECT lead_id, coalesce(nullif(regexp_replace("Reviews Count", '[^0-9]', '', 'g'), ''), nullif(regexp_replace("Rating", '[^0-9]', '', 'g'), ''), '') AS reviews FROM final_output""")
def reviews_digits(spark, sf_dir):
    return table(spark, sf_dir, "final_output").select("lead_id", text.first_digits(F.col("Reviews Count"), F.col("Rating")).alias("reviews"))


@query(f"""
    WITH t AS (SELECT lead_id, CASE WHEN lead_id % 3 <> 0 THEN "Title" END AS h1, CASE WHEN lead_id % 2 = 0 THEN "Search Term" END AS label, "Title" || ' · ' || "Location" AS card FROM final_output),
    u AS (SELECT lead_id, coalesce(nullif({S.strip('h1')}, ''), nullif({S.strip('label')}, ''), nullif({S.strip("string_split(card, ' · ')[1]")}, ''), 'Not available') AS title FROM t)
    SELECT lead_id, title, CASE WHEN title <> 'Not available' THEN 'Success' ELSE 'Partial' END AS status FROM u""")
def title_fallback(spark, sf_dir):
    k = F.col("lead_id")
    title = text.title_from(F.when(k % 3 != 0, F.col("Title")), F.when(k % 2 == 0, F.col("Search Term")), F.concat("Title", F.lit(" · "), "Location"))
    each = table(spark, sf_dir, "final_output").select("lead_id", title.alias("title"))
    return each.withColumn("status", F.when(F.col("title") != text.NOT_AVAILABLE, "Success").otherwise("Partial"))


@query("""
    WITH c AS (SELECT id, unnest(list_distinct(list_filter(string_split(address, '|'), lambda a: length(trim(a)) > 0))) AS a FROM extracted_results WHERE address <> ''),
    t AS (SELECT id, trim(a) AS a FROM c),
    r AS (SELECT DISTINCT id, a FROM t),
    k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY length(a) DESC, a) AS k FROM r)
    SELECT id, string_agg(a, ' | ' ORDER BY k) AS addresses FROM k WHERE k <= 3 GROUP BY id""")
def addresses_top3(spark, sf_dir):
    parts = F.array_distinct(F.filter(F.transform(F.split("address", r"\|"), lambda a: F.trim(a)), lambda a: F.length(a) > 0))
    # longest first, then by text: sort by a struct
    ranked = F.transform(F.array_sort(F.transform(parts, lambda a: F.struct((-F.length(a)).alias("n"), a.alias("a")))), lambda s: s["a"])
    each = table(spark, sf_dir, "extracted_results").where("address <> ''").select("id", F.slice(ranked, 1, 3).alias("top"))
    return each.where(F.size("top") > 0).select("id", F.array_join("top", " | ").alias("addresses"))


@query(f"""
    WITH d AS (SELECT domain, creation[1] AS c, expiration[1] AS e FROM whois_raw)
    SELECT regexp_replace(string_split(string_split(replace(replace(lower(domain), 'http://', ''), 'https://', ''), '/')[1], ':')[1], '^www\\.', '') AS domain,
      strftime(c, '%Y-%m-%d') AS domain_created_at, strftime(e, '%Y-%m-%d') AS domain_expires_at,
      CASE WHEN c IS NOT NULL THEN CAST(greatest(floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(c)) / 86400000000), 0) AS INT) END AS domain_age_days FROM d""")
def whois_age(spark, sf_dir):
    c, e = dates.first_date(F.col("creation")), dates.first_date(F.col("expiration"))
    age = F.when(c.isNotNull(), dates.age_days(c, F.lit(NOW).cast("timestamp")))
    return table(spark, sf_dir, "whois_raw").select(
        urls.registrable(F.col("domain")).alias("domain"), dates.as_day(c).alias("domain_created_at"), dates.as_day(e).alias("domain_expires_at"), age.alias("domain_age_days")
    )


@query("SELECT id, coalesce(CASE WHEN id % 2 = 0 THEN domain_age_days END, CASE WHEN id % 3 = 1 THEN CAST(id AS INT) END) AS domain_age_days FROM websites")
def migrate_legacy_age(spark, sf_dir):
    k = F.col("id")
    old = F.when(k % 3 == 1, F.concat(F.round(k / 365.0, 1).cast("string"), F.lit(" years ("), k.cast("string"), F.lit(" days)"))).when(k % 3 == 2, "some years")
    legacy = table(spark, sf_dir, "websites").select("id", F.when(k % 2 == 0, F.col("domain_age_days")).alias("domain_age_days"), old.alias("domain_age_years"))
    return state.migrate_age(legacy, "domain_age_days", "domain_age_years")


@query(f"""SELECT id, ({' OR '.join(f"contains(lower(coalesce(homepage_markdown, '')), '{m}')" for m in status.CHALLENGE_MARKS)}) OR contains(lower(url), 'sgcaptcha') AS challenge FROM websites""")
def challenge_pages(spark, sf_dir):
    return table(spark, sf_dir, "websites").select("id", status.is_challenge(F.col("homepage_markdown"), F.col("url")).alias("challenge"))


@query("""SELECT w.id, CASE WHEN coalesce(r.email, '') <> '' OR coalesce(r.phone, '') <> '' OR coalesce(r.address, '') <> '' THEN 'completed'
      WHEN coalesce(w.error_message, '') <> '' THEN 'failed' ELSE 'no_data' END AS status
    FROM websites w LEFT JOIN (SELECT website_id, max(email) AS email, max(phone) AS phone, max(address) AS address FROM extracted_results GROUP BY 1) r ON r.website_id = w.id""")
def site_statuses(spark, sf_dir):
    r = table(spark, sf_dir, "extracted_results").groupBy(F.col("website_id").alias("id")).agg(*[F.max(c).alias(c) for c in ("email", "phone", "address")])
    met = table(spark, sf_dir, "websites").select("id", "error_message").join(r, "id", "left")
    return met.select("id", status.site_status(state.has_any(F.col("email"), F.col("phone"), F.col("address")), F.col("error_message")).alias("status"))


@query("""SELECT CAST(lead_id AS BIGINT) AS lead_id, CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ' ELSE '' END || CASE WHEN s >= 60 THEN CAST(s % 3600 // 60 AS VARCHAR) || 'm ' ELSE '' END || CAST(s % 60 AS VARCHAR) || 's' AS duration
    FROM (SELECT lead_id, lead_id % 20000 AS s FROM final_output)""")
def run_durations(spark, sf_dir):
    return table(spark, sf_dir, "final_output").select("lead_id", dates.duration((F.col("lead_id") % 20000).cast("double")).alias("duration"))


# --- HTML ------------------------------------------------------------------------------------

#: Pages of the test data: the markdown in paragraphs, with a known mail link, phone, JSON-LD and footer put in.
_INJECTED_SQL = "'info' || w.id || '@corp' || (w.id % 9) || '.biz'"


def html_pages(spark, sf_dir):
    k = F.col("id").cast("string")
    body = F.regexp_replace(F.coalesce("homepage_markdown", F.lit("")), r"[<>&]", " ")
    mail = F.concat(F.lit("info"), k, F.lit("@corp"), (F.col("id") % 9).cast("string"), F.lit(".biz"))
    phone = F.concat(F.lit("780"), F.lpad((F.col("id") * 37 % 10_000_000).cast("string"), 7, "2"))
    place = F.concat((F.col("id") % 300 + 1).cast("string"), F.lit(" Harrow Street, Oldtown, BC V5K 0A"), (F.col("id") % 10).cast("string"))
    html = F.concat(
        F.lit("<html><head><title>t</title><script src='/static/app.js'></script><script type='application/ld+json'>{\"@type\":\"LocalBusiness\",\"telephone\":\""), phone,
        F.lit("\",\"address\":{\"@type\":\"PostalAddress\",\"streetAddress\":\""), place, F.lit("\"}}</script></head><body><h1>Home</h1><p>"),
        F.regexp_replace(body, "\n\n+", "</p><p>"),
        F.lit("<p><a href='/contact-us'>Contact us</a> <a href='/blog'>Blog</a> <a href='https://www.facebook.com/shop"), k, F.lit("?ref=1'>f</a></p><footer class='footer'><p>"),
        place, F.lit("</p><a href='mailto:"), mail, F.lit("?subject=x'>mail</a><a href='tel:+1"), phone, F.lit("'>call</a></footer>"),
    )
    return table(spark, sf_dir, "websites").select(
        "id", F.concat(F.lit("https://"), "domain", F.lit("/p/"), k).alias("site"), F.col("domain"), html.alias("html"), mail.alias("mail"), phone.alias("phone"), place.alias("place")
    )


def parsed_pages(spark, sf_dir):
    return spread(html_pages(spark, sf_dir)).withColumn("page", html.parse("html"))


_MAIL_OF_TEXT = S.emails_of("regexp_replace(coalesce(w.homepage_markdown, ''), '[<>&]', ' ', 'g')")


@query(f"""SELECT w.id, unnest(list_sort(list_distinct(list_append({_MAIL_OF_TEXT}, {_INJECTED_SQL})))) AS email FROM websites w""")
def html_emails(spark, sf_dir):
    return parsed_pages(spark, sf_dir).select("id", F.explode(html.page_emails(F.col("html"), F.col("page"))).alias("email"))


@query()
def html_phones(spark, sf_dir):
    return html.page_phones(parsed_pages(spark, sf_dir).where("domain is not null"), "id", "page", "domain")


@query()
def json_ld_addresses(spark, sf_dir):
    return parsed_pages(spark, sf_dir).select("id", F.explode(html.page_addresses(F.col("page"))).alias("address"))


@query()
def html_addresses(spark, sf_dir):
    return parsed_pages(spark, sf_dir).select("id", F.explode(html.top_addresses(html.page_addresses(F.col("page")))).alias("address"))


@query("SELECT id, CAST(1 AS INT) AS place, 'https://' || domain || '/contact-us' AS contact_url FROM websites WHERE domain IS NOT NULL AND NOT contains(coalesce(homepage_markdown, ''), '<a ')")
def contact_links(spark, sf_dir):
    return html.contact_links(parsed_pages(spark, sf_dir).where("domain is not null"), "id", "page", "site")


@query("SELECT id, 'https://www.facebook.com/shop' || id AS facebook FROM websites")
def html_social(spark, sf_dir):
    return parsed_pages(spark, sf_dir).select("id", F.explode(html.page_social(F.col("html"), F.col("page"), "facebook")).alias("facebook"))


@query("SELECT id, '/static/app.js' AS script FROM websites")
def html_scripts(spark, sf_dir):
    return parsed_pages(spark, sf_dir).select("id", F.explode(html.script_urls(F.col("page"))).alias("script"))


@query()
def html_text_markdown(spark, sf_dir):
    return spread(html_pages(spark, sf_dir)).select("id", html.markdown("html").alias("markdown"))


@query()
def crawl_assembly(spark, sf_dir):
    pages = html_pages(spark, sf_dir).where("domain is not null").select(
        F.col("domain").alias("site"), F.col("site").alias("url"), F.lit("text/html").alias("content_type"), "html", F.lit(True).alias("is_home"), F.lit(None).cast("string").alias("error")
    )
    scripts = table(spark, sf_dir, "websites").where("domain is not null").select(F.col("domain").alias("site"), F.concat(F.lit('x={phone:"(780) 2'), F.lpad((F.col("id") % 1000).cast("string"), 2, "0"), F.lit('-4421"}')).alias("body"))
    return crawl.assemble(pages, scripts)


for more in (catalog_listings, catalog_io, catalog_html):
    QUERIES.update(more.QUERIES)
    SQL.update(more.SQL)
