"""Slots, filler, error pages and notices against honest look-alikes; one verdict for a template; edge tables."""

import pytest

from leadmill.llm import residue
from leadmill.llm.residue import has_slot, message_is_case, page_text_is_case

BODY = "# Baker · Oldtown\n\nWe bake bread for the whole street, and you can order by noon.\n\nAsk for rye rolls by name."
CHROME = "[Home](/home) | [Contact](/contact)\n\n"
SLOTS = ["Welcome to {{name}}", "Call ${phone} now", "At {% city %} we", "About <%= owner %>", "%%city%% baker", "@@email@@", "__CITY__ baker", "#TAGLINE#",
         "[INSERT CITY]", "[Your Company Name]", "<your suburb>", "[owner] and sons", "{site.title}", "%(url)s failed", "%s failed after %d attempts", "[[phone]]", "MESSAGE_GOES_HERE", "Our promise: «City»", "Welcome to YOUR CITY HERE", "#SERVICE_1#", "*|CITY|*"]
NO_SLOTS = ["Prices marked [incl. tax] are final", "Some parts [see the note in the workshop] are kept", "tags such as {{first_name}} are filled", "costs $500, 9 % off",
            "[Home](/home)", "unexpected '{' at char 9", "[Errno 111] Connection refused", "C# and #sale", "a < b and c > d", "<b>bold</b>", "Il a dit « bonjour »"]


@pytest.mark.parametrize("text", SLOTS)
def test_slot(text):
    assert has_slot(text)


@pytest.mark.parametrize("text", NO_SLOTS)
def test_no_slot(text):
    assert not has_slot(text)


@pytest.mark.parametrize(
    "text",
    [
        CHROME + BODY + "\n\n" + filler
        for filler in ["Lorem ipsum dolor sit amet, consectetur elit.", "Your subtitle goes here.", "bla bla bla", "Click here to edit this text.", "Hier steht Ihr Text.", "{{city}} baker", "nnnn n nn nnnnnn nnn.", "Write your services (max. 90 characters)."]
    ]
    + [
        CHROME + "404 Not Found\n\nTry the search box or go back to the home page.",
        "Please enable JavaScript to view this website.",
        "Just a moment while we verify your browser.\n\nRay 55ab",
        "# shop.example\n\nYou must activate scripts in your browser!\n\nThis may take up to five seconds.",
        "# 404",
        "Seite nicht gefunden\n\nDie angeforderte Adresse existiert nicht mehr.",
    ],
)
def test_page_case(text):
    assert page_text_is_case(text)


@pytest.mark.parametrize(
    "text",
    [
        None, "", " \n\t", CHROME, CHROME + BODY,
        CHROME + BODY + "\n\nYou will find us at number 404, and parking is not found easily.",
        CHROME + "JavaScript is disabled in your browser. Some features of this site may not work.\n\n" + BODY,
        BODY + '\n\nWe swap stock headings like "Your title here" for words your customers use.',
        BODY + "\n\nHalf the sites we take over still show lorem ipsum on an inner page; we read every page before launch.",
        BODY + "\n\nOur pages work with JavaScript turned off, which helps slow phones and screen readers.",
    ],
)
def test_page_no_case(text):
    assert not page_text_is_case(text)


@pytest.mark.parametrize("text", ["{{ exception }}", "could not resolve {target}", "Please enable JavaScript.", "Sorry, the page you requested could not be found. Return to the home page.",
                                  "<html><head><title>502 Bad Gateway</title></head></html>", "HTTP ERROR 503. the service is busy. Go to the home page.", "asdf jkl asdf", "<describe the failure>"])
def test_message_case(text):
    assert message_is_case(text)


@pytest.mark.parametrize("text", [None, "", " ", "[Errno 111] Connection refused", "KeyError: 'addressLocality'", "JavaScript challenge on a.example did not clear within 9 s", "database is locked",
                                  "WHOIS lookup exceeded 9 s; page not found in cache", "HTTP 403 (forbidden) on home page, contact paths skipped", "Too many redirects (21) while fetching https://a.example/"])
def test_message_no_case(text):
    assert not message_is_case(text)


@pytest.mark.parametrize("text", ["max. 30 words", "max. 30 Zeichen", "máx. o max. 30 caracteres", "max. 30 caractères", "Add a subheading", "To do", "x x x x x", "aa aa aa aa", "Insérez ici", "Faux texte", "testtest"])
def test_filler_is_told_without_a_prefilter(text):
    assert residue._FILLER.search(text)
    assert residue.classify(text) == residue.FILLER
    assert page_text_is_case(CHROME + BODY + "\n\n" + text)


def test_template_verdicts_do_not_depend_on_order():
    texts = ["Please enable JavaScript to view this website.", "Error 503: the service is busy", "Acme Baking in Oldtown is open.", "Lorem ipsum dolor sit amet."]
    first, second = residue.PrefixTree(), residue.PrefixTree()
    a = {t: first.verdict(t) for t in texts}
    b = {t: second.verdict(t) for t in reversed(texts)}
    assert a == b


def test_table(spark):
    rows = [(1, "404 Not Found", "{{e}}", "x"), (2, None, None, "x"), (1, "404 Not Found", "", None), (3, CHROME + BODY, "database is locked", "x"), (None, "# 404", None, "y"), (4, "lorem ipsum dolor sit amet " * 20000, None, "z")]
    df = spark.createDataFrame(rows, "id bigint, homepage_markdown string, error_message string, field string")
    got = sorted(map(tuple, residue.find_residue(df).collect()), key=str)
    want = [(1, "error_message"), (1, "homepage_markdown"), (1, "homepage_markdown"), (4, "homepage_markdown"), (None, "homepage_markdown")]
    assert got == sorted(want, key=str)
    assert residue.find_residue(df.limit(0)).count() == 0


PAGES = "id bigint, url string, homepage_markdown string, error_message string"
#: Wordings that no list here knows.
UNLISTED = ["Sorry, we couldn't locate this one on our machines.", "La dirección pedida no existe ya.", "Dieser Inhalt wurde entfernt oder verschoben."]


def corpus(spark, hosts=20):
    honest = [(f"# Baker {k}\n\nWe bake bread number {k} for the whole street.\n\nVisitors are welcome.\n\nRolls number {k} are rye.\n\nOrder by noon.\n\nParking {k} is free.") for k in range(40)]
    rows = [(k, f"https://h{k}.example/", t, None) for k, t in enumerate(honest)]
    for n, text in enumerate(UNLISTED):
        rows += [(1000 * (n + 1) + k, f"https://e{n}-{k}.example/", f"# e{n}-{k}.example\n\n{text}\n\nRef {k}{k}a7", None) for k in range(hosts)]
    return spark.createDataFrame(rows, PAGES)


def test_wordings_no_list_knows_are_found_by_their_template(spark):
    assert not any(residue.page_text_is_case(t) for t in UNLISTED)
    got = {r.id for r in residue.find_residue(corpus(spark)).collect()}
    assert got == {1000 * (n + 1) + k for n in range(len(UNLISTED)) for k in range(20)}
    # on few hosts a template is no evidence
    assert {r.id for r in residue.find_residue(corpus(spark, 3)).collect()} == set()


def test_wildcards_come_from_what_varies():
    tree = residue.PrefixTree()
    for name in ("anna", "bert", "cleo"):
        found = tree.add(f"the page of our dear {name} is not here any more")
    assert found[0] == "the page of our dear <*> is not here any more".split()
    assert found[1] == "the page of our dear anna is not here any more"
    assert tree.add("the page of our old boat was sold long before")[1] != found[1]


def test_large_leaves_are_cut_and_merged(spark, monkeypatch):
    rows = [(k, f"https://h{k}.example/", f"the requested page {'abcdefghij'[k % 10] * 3}{'klmnopqrst'[k // 10] * 3} was not found by us", None) for k in range(100)]
    df = spark.createDataFrame(rows, PAGES)
    whole = sorted(map(tuple, residue.find_residue(df).collect()))
    monkeypatch.setattr(residue, "LEAF_RECORDS", 7)
    cut = sorted(map(tuple, residue.find_residue(df.repartition(5)).collect()))
    assert whole == cut


@pytest.mark.parametrize("words", [2, 80])
def test_an_error_page_is_a_case_at_any_length(spark, words):
    text = "The page you requested could not be found" + " here, there, or in any of our rooms" * words + "."
    df = spark.createDataFrame([(1, "https://a.example", text, None)], PAGES)
    assert [r.id for r in residue.find_residue(df).collect()] == [1]
