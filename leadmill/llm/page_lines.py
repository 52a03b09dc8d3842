"""What a single line of a page looks like: chrome of a known kind, a message, filler, or open.

Pure functions over one line, remembered for each worker; the page operators build on them.
"""

from __future__ import annotations

import re
from functools import lru_cache

from leadmill.llm.gates import Gate

#: Names of menu entries, sections and buttons of page chrome in en, de, es, fr (fixed values).
MENU = frozenset(
    """home|about|about us|our team|team|services|gallery|contact|contact us|faq|blog|news|shop|book online|careers|jobs|
    prices|pricing|areas we cover|reviews|testimonials|portfolio|projects|locations|login|log in|sign in|search|cart|menu|close|
    toggle navigation|skip to content|skip to main content|skip navigation|back to top|top|
    startseite|über uns|leistungen|kontakt|preise|aktuelles|galerie|anfahrt|karriere|warenkorb|suche|zum inhalt springen|nach oben|menü|schließen|
    inicio|nosotros|servicios|contacto|precios|galería|noticias|tienda|buscar|saltar al contenido|ir al contenido|volver arriba|menú|cerrar|
    accueil|à propos|tarifs|actualités|boutique|rechercher|aller au contenu|haut de page|fermer|équipe|réalisations""".replace("\n", "").replace("    ", "").split("|")
)
LEGAL = frozenset(
    """privacy policy|privacy|terms of use|terms|terms and conditions|terms of service|disclaimer|complaints|sitemap|site map|accessibility|
    cookie policy|legal notice|imprint|legal|datenschutz|datenschutzerklärung|impressum|agb|barrierefreiheit|widerruf|
    privacidad|aviso legal|mapa del sitio|política de privacidad|política de cookies|accesibilidad|condiciones de uso|
    confidentialité|mentions légales|plan du site|politique de confidentialité|accessibilité|cgv|cgu""".replace("\n", "").replace("    ", "").split("|")
)
BUTTONS = frozenset(
    """accept all|accept|reject all|reject|only necessary|necessary only|cookie settings|manage preferences|preferences|settings|ok, got it|ok|got it|
    i agree|agree|decline|allow all|deny|alle akzeptieren|akzeptieren|ablehnen|einstellungen|nur notwendige|aceptar|aceptar todo|aceptar todas|rechazar|
    configurar|tout accepter|accepter|refuser|tout refuser|paramètres|share|tweet|pin it|email|print|subscribe|sign up|join|join now|
    facebook|instagram|twitter|linkedin|youtube|your email address *|your email address|e-mail *|compartir|partager|teilen|suscribirse|s'abonner|anmelden|abonnieren""".replace("\n", "").replace("    ", "").split("|")
)
#: Headings of sections beside the main content.
SECTIONS = frozenset(
    """cookies on this site|cookies|cookie notice|find us|contact|contact us|get in touch|contact details|hours|opening hours|business hours|about us|who we are|about|
    info|latest news|in brief|from the blog|archives|related services|popular this month|recent posts|categories|you may also like|recent stories|
    newsletter|join our newsletter|stay in touch|advertisement|sponsored|tags|follow us|share this page|related posts|related articles|related|popular posts|
    most read|trending|recent comments|quick links|useful links|links|sidebar|our newsletter|subscribe|
    kategorien|neueste beiträge|aktuelle beiträge|archiv|anzeige|öffnungszeiten|kontakt|über uns|das könnte sie auch interessieren|
    categorías|entradas recientes|archivos|publicidad|horario|horarios|contacto|sobre nosotros|quiénes somos|también le puede interesar|
    catégories|articles récents|publicité|horaires|qui sommes-nous|à propos de nous|vous aimerez aussi|boletín|lettre d'information|infolettre""".replace("\n", "").replace("    ", "").split("|")
)

_MARK = re.compile(r"^(?:[*+•-]|\d{1,3}[.)])\s+")
_LINK = re.compile(r"!?\[([^\]\n]*)\]\([^)\n]*\)")
_IMAGE = re.compile(r"^(?:!\[[^\]\n]*\]\([^)\n]*\)|\[!\[[^\]\n]*\]\([^)\n]*\)\]\([^)\n]*\)|<img\b[^>\n]*>)$")
_BETWEEN = re.compile(r"\s*(?:[|·•/]|\s[-–—]\s|\s>\s|\s»\s|\s›\s)\s*")
_CRUMBS = re.compile(r"^(?:home|startseite|inicio|accueil)\s*(?:[>»›/→]|::)\s*\S", re.IGNORECASE)
_PHONE_STRIP = re.compile(r"^\W*[☎📞✆]")
_COPY = re.compile(r"^\W*(?:©|\(c\)|copyright\b|&copy;)|©|\(c\)\s.*\d{4}|all rights reserved|alle rechte vorbehalten|todos los derechos reservados|tous droits réservés", re.IGNORECASE)
#: A firm's name and a year alone.
_NAME_AND_YEAR = re.compile(r"^(?:[^\W\d_a-zà-ÿ][\w'’&.-]*\s+){1,7}(?:19|20)\d\d(?:\s*[-–]\s*(?:19|20)\d\d)?\.?$")
_MADE_WITH = re.compile(r"^(?:powered by|built with|made with|website by|site by|web design by|designed by|theme by|erstellt mit|hecho con|creado con|réalisé (?:par|avec)|site réalisé)\b", re.IGNORECASE)
_OWNED = re.compile(
    r"^(?:all (?:texts?|contents?|pictures|images)|everything (?:shown|on this site)|the contents? of th|logos? and (?:photo|pict|im)|texts and pictures|no part of th|alle (?:texte|inhalte)|todos los (?:textos|contenidos)|tous les (?:textes|contenus))"
    r".*\b(?:protected|copied|property|owners?|change without|publisher|reproduced|geschützt|eigentum|protegidos|propiedad|protégés|propriété)\b",
    re.IGNORECASE,
)
#: Cookie notices: who stores what, or what may be chosen. Talk of baked cookies has neither.
_COOKIES = re.compile(
    r"^(?:we|we and \S+ partners?|this (?:site|website|page|shop|store)|our (?:site|website|page|shop|store|partners?)|the (?:site|website))\b[^.!?]{0,40}"
    r"\b(?:use|uses|may set|set|sets|store|stores|rel(?:y|ies) on|place|places|keep|save)\b[^.!?]{0,40}\b(?:cookies?|text files|small files|similar tools|trackers|tracking|local storage)\b"
    r"|^(?:by (?:clicking|continuing|staying|using)\b.*\b(?:you|cookies?|device)\b)"
    r"|^some cookies are (?:needed|required|necessary)\b|^your privacy matters to us\b|^cookies (?:help|let|allow) us\b"
    r"|^wir (?:verwenden|nutzen|setzen)\b.*\bcookies\b|^diese (?:web)?(?:site|seite)\s.*\b(?:speichert|verwendet|nutzt)\b"
    r"|^(?:usamos|utilizamos)\s.*\bcookies\b|^est[ea] (?:sitio|web|página)\b.*\b(?:guarda|usa|utiliza)\b.*\b(?:cookies|archivos|dispositivo)\b"
    r"|^nous utilisons\s.*\bcookies\b|^ce site\b.*\b(?:enregistre|utilise|dépose)\b.*\b(?:cookies|fichiers)\b",
    re.IGNORECASE,
)
#: A notice about scripts within chrome: the page works in part without them.
_SOFT_SCRIPT = re.compile(
    r"^(?:javascript|scripts?|scripting) (?:is|are|seems?)(?: to be)? (?:disabled|turned off|blocked|off)\b.*\b(?:some|features|parts|may)\b"
    r"|^for the best experience\b.*\bjavascript\b|^your browser does not run scripts, so\b|^some (?:features|parts) of (?:this|the) (?:site|page)\b.*\bjavascript\b"
    r"|^javascript ist deaktiviert\b.*\b(?:einige|teile)\b|^javascript está desactivado\b.*\balgunas\b|^javascript est désactivé\b.*\bcertaines\b",
    re.IGNORECASE,
)
_SHARE = re.compile(r"^(?:share (?:this|on)|follow us|tags?|filed under|posted in|teilen|folgen sie uns|schlagwörter|compartir|síganos|etiquetas|partager|suivez-nous|mots-clés)\b[^:]{0,20}:", re.IGNORECASE)
_MORE = re.compile(r"\[(?:read more|continue reading|more|more »|read on|weiterlesen|mehr|leer más|seguir leyendo|lire la suite|en savoir plus)[^\]]{0,6}\]\([^)]*\)\W*$", re.IGNORECASE)
_SIGN_UP = re.compile(r"(?:sign up for|subscribe to|receive|get|join)\b[^.!?]*\b(?:newsletter|tips|offers|news|e-?mail|inbox|updates|spam)\b", re.IGNORECASE)
_UNSUBSCRIBE = re.compile(r"\bno spam\b|\bunsubscribe\b", re.IGNORECASE)
_CHOOSE_COOKIES = re.compile(r"\bchoose which cookies\b", re.IGNORECASE)
_MORE_TEXT = re.compile(r"[.!?]\s+\S")
_HOURS = re.compile(r"^(?:mon|tue|wed|thu|fri|sat|sun|mo|di|mi|do|fr|sa|so|lun|mar|mié|mie|jue|vie|sáb|sab|dom|mer|jeu|ven|sam|dim)[a-zäöüéá]*\.?(?:\s*(?:-|–|to|bis|a|au|and|und|y|et|,)\s*[a-zäöüéá]+\.?)*\s*:?\s*(?:\d{1,2}[:.h]\d{2}|\d{1,2}\s*(?:am|pm|uhr)|closed|geschlossen|cerrado|fermé)", re.IGNORECASE)
_PHONE_LINE = re.compile(r"^(?:phone|tel|telephone|t|fax|f|mobile|m|call|ph|telefon|teléfono|téléphone)\b\.?\s*:?\s*[+(\d][\d ().\-/+]{6,}$", re.IGNORECASE)
_ONLY_COUNT = re.compile(r"^\W*\d+\W*$")
_COUNTED = re.compile(r"\(\d+\)\s*$|\)\s*\(\d+\)$|\(\d+\)\]")


_HASH_SLOT = re.compile(r"#[A-Z_]+#")
_DIGITS = re.compile(r"\d+")


@lru_cache(maxsize=20_000)
def plain(line: str) -> str:
    """The text without list marks, heading marks, bold marks and link targets."""
    s = _MARK.sub("", line.strip())
    if s.startswith("#") and not _HASH_SLOT.match(s):
        s = s.strip("#").strip()
    if "](" in s:
        s = _LINK.sub(r"\1", s)
    if s.startswith("**") and s.endswith("**"):
        s = s[2:-2]
    return s.strip()


_CAPITALISED = re.compile(r"(?<= )[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][^ ]*")


def template(line: str) -> str:
    """The line with numbers and words with a Latin, Greek or Cyrillic capital masked, but for the first word."""
    return _CAPITALISED.sub("*", _DIGITS.sub("0", plain(line)))


_SEPARATORS = re.compile(r"[|·•/\-–—>»›]")


def _names(text: str, known: frozenset[str]) -> bool:
    """Whether a line is made of known names only, apart from separators."""
    low = text.lower().strip(" .:")
    if low in known:
        return True
    if _SEPARATORS.search(low):
        parts = [p.strip(" .:") for p in _BETWEEN.split(low) if p.strip(" .:")]
        if len(parts) > 1:
            return sum(p in known for p in parts) * 2 >= len(parts)
    return low.split(" ", 1)[0] in _FIRST and _chain(low, known)


def _chain(text: str, known: frozenset[str]) -> bool:
    """Whether words set apart by single spaces can be read as at least two known names (of four words at most)."""
    words = text.split(" ")
    reach = {0: 0}
    for end in range(1, len(words) + 1):
        for start in range(max(0, end - 4), end):
            if start in reach and " ".join(words[start:end]) in known:
                reach[end] = max(reach.get(end, 0), reach[start] + 1)
        if end >= 4 and not any(k in reach for k in range(end - 3, end + 1)):
            return False
    return reach.get(len(words), 0) >= 2


_CHAINED = MENU | LEGAL | BUTTONS
_FIRST = frozenset(n.split(" ")[0] for n in _CHAINED)


@lru_cache(maxsize=100_000)
def kind_of(line: str) -> str:
    """What a line is by itself: blank, a kind of chrome, or open."""
    s = line.strip()
    if not s:
        return "blank"
    return _kind(s, plain(s))


_GATE = Gate(copy=_COPY, made=_MADE_WITH, owned=_OWNED, cookies=_COOKIES, choose=_CHOOSE_COOKIES, script=_SOFT_SCRIPT, share=_SHARE, more=_MORE, sign=_SIGN_UP, leave=_UNSUBSCRIBE)
_BIT = _GATE.bit


def _kind(s: str, text: str) -> str:
    """The kind of a stripped line; conditions in front of patterns hold wherever the pattern can match."""
    low = text.lower().rstrip(" :")
    may = _GATE.may_match(s)
    if low in SECTIONS:
        return "section"
    if s[0] in "![<" and _IMAGE.match(s):
        return "logo"
    if low in MENU:
        return "menu"
    if low in LEGAL:
        return "legal"
    if low in BUTTONS:
        return "button"
    if _PHONE_STRIP.match(s):
        return "strip"
    if _CRUMBS.match(text):
        return "crumbs"
    if may & _BIT["copy"] and _COPY.search(s):
        return "copyright"
    if text[-1:] in "0123456789." and not s.startswith(("#", ">", "*", "-", "+")) and _NAME_AND_YEAR.match(text):
        return "copyright"
    if may & _BIT["made"] and _MADE_WITH.match(text) and not _MORE_TEXT.search(text) or may & _BIT["owned"] and _OWNED.match(text):
        return "copyright"
    if may & _BIT["cookies"] and _COOKIES.match(text) or may & _BIT["choose"] and _CHOOSE_COOKIES.search(text):
        return "cookies"
    if may & _BIT["script"] and _SOFT_SCRIPT.match(text):
        return "script"
    if may & _BIT["share"] and _SHARE.match(text):
        return "share"
    linked = "](" in s
    if linked and may & _BIT["more"] and _MORE.search(s):
        return "teaser"
    if may & _BIT["sign"] and _SIGN_UP.match(text) or may & _BIT["leave"] and _UNSUBSCRIBE.search(text):
        return "newsletter"
    if linked and _LINK.search(s):
        rest = _LINK.sub("", _MARK.sub("", s)).strip(" |·•/-–—>»›#*")
        if not rest or _ONLY_COUNT.match(rest):
            return "links"
    if _HOURS.match(text):
        return "hours"
    if _PHONE_LINE.match(text):
        return "phone"
    if ")" in s and _COUNTED.search(s) and not _MORE_TEXT.search(text):
        return "counted"
    if _names(text, _CHAINED):
        return "menu"
    return "open"


#: Kinds that are chrome wherever they stand.
CHROME = frozenset("section logo menu legal button strip crumbs copyright cookies script share teaser newsletter links hours phone counted".split())
