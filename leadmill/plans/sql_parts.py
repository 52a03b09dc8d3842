"""SQL fragments (DuckDB) shared by the twins of the queries, written apart from the Spark expressions."""

from __future__ import annotations

from leadmill.functions import emails, phones, social, status, urls


def quoted(words) -> str:
    return ", ".join("'" + str(w).replace("'", "''") + "'" for w in words)


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')"


def has_value(c: str) -> str:
    return f"({c} IS NOT NULL AND lower({strip(c)}) NOT IN ('', 'nan', 'not available'))"


def netloc(c: str) -> str:
    return f"regexp_extract({c}, '{urls.NETLOC}', 1)"


def bare_domain(c: str) -> str:
    return f"regexp_replace(lower({netloc(c)}), '^www\\.', '')"


def root_url(c: str) -> str:
    scheme = f"lower(regexp_extract({c}, '^([A-Za-z][A-Za-z0-9+.\\-]*)://', 1))"
    return f"CASE WHEN {scheme} <> '' AND {netloc(c)} <> '' THEN {scheme} || '://' || {netloc(c)} ELSE '' END"


def is_platform(d: str) -> str:
    return "(" + " OR ".join(f"{d} = '{p}' OR ends_with({d}, '.{p}')" for p in urls.PLATFORMS) + ")"


def site_key(c: str, ord_col: str) -> str:
    key = f"regexp_replace(regexp_replace(regexp_replace(lower({strip(c)}), '^https?://', ''), '^www\\.', ''), '/+$', '')"
    return f"CASE WHEN {has_value(c)} THEN {key} ELSE coalesce({key}, '') || '||row' || {ord_col} END"


def phone_key(c: str, ord_col: str) -> str:
    key = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"CASE WHEN {has_value(c)} THEN {key} ELSE coalesce({key}, '') || '||row' || {ord_col} END"


def status_note(c: str) -> str:
    number = f"try_cast({strip(c)} AS INT)"
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in status.NOTES.items())
    return f"CASE WHEN {c} IS NULL THEN 'No Response' WHEN {number} IS NULL THEN 'Error' ELSE CASE {number} {cases} ELSE 'HTTP ' || {number} END END"


def strip_chars(c: str, chars: str) -> str:
    inside = "".join("\\" + x if x in r"\]^-[" else x for x in chars).replace("'", "''")
    return f"regexp_replace({c}, '^[{inside}]+|[{inside}]+$', '', 'g')"


def email_valid(e: str) -> str:
    low = strip_chars(f"lower({e})", ".")
    user, domain = f"regexp_extract({low}, '^(.*)@([^@]*)$', 1)", f"regexp_extract({low}, '^(.*)@([^@]*)$', 2)"
    local = f"CASE WHEN starts_with({user}, 'u002f') OR starts_with({user}, '\\u002f') THEN replace(replace({user}, 'u002f', ''), '\\u002f', '') ELSE {user} END"
    label = f"string_split({domain}, '.')[-1]"
    denied = " OR ".join(f"{domain} = '{d}' OR ends_with({domain}, '.{d}')" for d in emails.BAD_DOMAINS)
    prefixed = " OR ".join(f"starts_with({local}, '{p}')" for p in emails.BAD_PREFIXES)
    return (
        f"(contains({e}, '@') AND NOT regexp_matches({domain}, '^[1-4]x\\.(png|jpg|jpeg|webp|gif|svg|webm)$') AND {label} NOT IN ({quoted(emails.BAD_LABELS)})"
        f" AND NOT regexp_matches({local}, '^[0-9a-f]{{20,64}}$') AND NOT ({prefixed}) AND NOT ({denied})"
        f" AND contains({domain}, '.') AND length({label}) >= 2 AND length({local}) BETWEEN 2 AND 64)"
    )


def emails_of(text: str) -> str:
    plain = f"list_transform(regexp_extract_all({text}, '{emails.PLAIN}', 0), lambda e: {strip_chars('lower(e)', '.')})"
    clear = "replace(lower(e), ' ', '')"
    for mark, sign in (("[at]", "@"), ("(at)", "@"), ("[dot]", "."), ("(dot)", ".")):
        clear = f"replace({clear}, '{mark}', '{sign}')"
    hidden = f"list_transform(regexp_extract_all({text}, '{emails.OBFUSCATED}', 0), lambda e: {clear})"
    return f"list_sort(list_distinct(list_filter(list_concat({plain}, {hidden}), lambda e: {email_valid('e')})))"


def listing_emails(text: str) -> str:
    found = f"list_transform(regexp_extract_all({text}, '{emails.LISTING}', 0), lambda e: {strip_chars(strip('e'), '.,;:()[]<>' + chr(34) + chr(39))})"
    junk = " OR ".join([f"ends_with(lower(e), '{x}')" for x in emails.JUNK_EXTENSIONS] + [f"ends_with(lower(e), '@{d}')" for d in emails.JUNK_DOMAINS])
    return f"list_sort(list_distinct(list_filter({found}, lambda e: NOT ({junk}))))"


def labeled(found: str) -> str:
    return f"coalesce(array_to_string(list_transform({found}[1:10], lambda e, i: 'email ' || i || ': ' || e), ', '), '')"


def from_labeled(c: str) -> str:
    return f"coalesce(regexp_extract_all({c}, '{emails.PLAIN}', 0), [])"


def country_hint(context: str, domain: str) -> str:
    t, d = f"coalesce({context}, '')", f"lower(coalesce({domain}, ''))"
    return (
        f"CASE WHEN ends_with({d}, '.in') OR regexp_matches({t}, '{phones.INDIA}') THEN 'IN'"
        f" WHEN ends_with({d}, '.ca') OR regexp_matches({t}, '{phones.CANADA}') THEN 'CA'"
        f" WHEN ends_with({d}, '.us') OR regexp_matches({t}, '{phones.USA}') THEN 'US' END"
    )


def phone_steps(source: str, keep: str) -> str:
    """CTEs that clean column p of ``source`` with column hint into column cleaned; ``keep`` lists what goes along."""
    codes = quoted(phones.CANADIAN_AREA_CODES)
    code = lambda n: f"CASE WHEN hint = 'IN' THEN '+91' WHEN hint IN ('CA', 'US') THEN '+1' WHEN left({n}, 3) IN ({codes}) THEN '+1' END"
    return f"""
    ph1 AS (SELECT {keep}, hint, regexp_replace({strip(f"regexp_replace({strip('p')}, '^(?i:tel:|phone:|call:|call us:)', '')")}, '[^0-9+]', '', 'g') AS d0 FROM {source}),
    ph2 AS (SELECT {keep}, hint, CASE WHEN starts_with(d0, '00') THEN '+' || substr(d0, 3) ELSE d0 END AS d1 FROM ph1),
    ph3 AS (SELECT {keep}, hint, CASE WHEN starts_with(d1, '0') AND length(d1) = 11 THEN coalesce({code('substr(d1, 2)')}, '+1') || substr(d1, 2) ELSE d1 END AS d FROM ph2),
    ph4 AS (SELECT {keep}, CASE WHEN starts_with(d, '+') THEN d
        WHEN length(d) = 10 THEN coalesce({code('d')}, CASE WHEN regexp_matches(d, '^[2-9]') THEN '+1' END) || d
        WHEN (length(d) = 11 AND starts_with(d, '1')) OR (length(d) = 12 AND starts_with(d, '91')) OR (length(d) = 11 AND starts_with(d, '44')) THEN '+' || d END AS f FROM ph3),
    ph5 AS (SELECT {keep}, CASE WHEN regexp_matches(substr(f, 2), '{'|'.join(phones.DUMMIES)}') OR length(substr(f, 2)) NOT BETWEEN 7 AND 15
            OR regexp_matches(substr(f, 2), '^(19|20)[0-9][0-9](0[1-9]|1[0-2])') THEN NULL
        WHEN length(f) = 12 AND starts_with(f, '+1') THEN '+1 (' || substr(f, 3, 3) || ') ' || substr(f, 6, 3) || '-' || substr(f, 9, 4)
        WHEN length(f) = 13 AND starts_with(f, '+91') THEN '+91 ' || substr(f, 4, 5) || ' ' || substr(f, 9, 5)
        WHEN starts_with(f, '+') OR f IS NULL THEN f END AS cleaned FROM ph4)"""


def social_of(text: str, platform: str) -> str:
    links = f"list_transform(regexp_extract_all({text}, '{social.PATTERNS[platform]}', 0), lambda u: string_split(regexp_replace(u, '/+$', ''), '?')[1])"
    ignored = " OR ".join(f"contains(lower(u), '{x}')" for x in social.IGNORED)
    return f"list_sort(list_distinct(list_filter({links}, lambda u: NOT ({ignored}))))"
