"""Problem 4: template residue and error-page text.

One automaton holds all patterns: what error pages, refusals and script notices say in 14 languages (parts of messages,
so that other wordings made of the same parts match too), filler, words of mock Latin, words of program messages, and
the openings of placeholders, whose forms are read on from where they open. It finds every match of a line in one pass.
In a line with a telling match, a second automaton also covers the words that such messages are made of, and tokens
that aren't words (numbers, paths, hashes, hosts) count as covered.

A record is excluded if the matches cover at least ``COVER`` of the characters that count (letters and figures) of the
document, and no paragraph of it stays uncovered. What may stand beside residue is left out of the document's length: at
most ``BESIDE`` uncovered short lines that are no sentences, such as a headline, a byline, a host name or a label.

Texts are compared in lower case after the consistent form of problem 6. Null, blank and merely short texts are no
cases, nor are articles that mention or quote such text, as their paragraphs stay uncovered.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from ._common import fragments, map_rows, texts
from .p6_lookalikes import simple

COVER = 0.6
BESIDE = 3
#: A line beside residue is at most so long, and all of them together at most half as long again.
BESIDE_CHARS = 170

#: Telling parts of messages by language: missing, refused, failed, scripts needed.
TELLING = {
    "en": "not found|can't be found|cannot be found|could not be found|couldn't be found|couldn't find|can't find|does not exist|doesn't exist|no longer exists|no longer available|access denied|access to this page|have access|permission to access|forbidden|were refused|refused to connect|went wrong|try again|error occurred|error has occurred|unexpected error|server error|timed out|timeout|can't be reached|bad gateway|bad request|service unavailable|temporarily unavailable|too many requests|rate limit|session expired|session has expired|sign in again|checking your|checking if the|verify you are|unusual traffic|javascript|support scripts|enable scripts|enable cookies|cannot be shown|under maintenance|request blocked|connection refused",
    "is": "fannst ekki|finnst ekki|er ekki til|ekki aðgang|aðgangi hafnað|fór úrskeiðis|reyndu aftur|villa kom upp|styður ekki|birtist því ekki",
    "da": "ikke fundet|findes ikke|kunne ikke findes|ikke adgang|ingen adgang|adgang nægtet|gik galt|prøv igen|opstod en fejl|understøtter ikke|kan ikke vises|ikke tilgængelig",
    "nb": "fant ikke|ikke funnet|finnes ikke|ikke tilgang|ingen tilgang|gikk galt|prøv igjen|oppstod en feil|støtter ikke|kan ikke vises|ikke tilgjengelig",
    "nn": "fann ikkje|ikkje funne|finst ikkje|ikkje tilgang|gjekk gale|oppstod ein feil|støttar ikkje|kan ikkje visast|ikkje tilgjengeleg",
    "sv": "kunde inte hittas|hittades inte|finns inte|inte tillgång|åtkomst nekad|gick fel|försök igen|fel uppstod|fel har uppstått|stöder inte|inte visas|inte tillgänglig",
    "de": "nicht gefunden|nicht finden|existiert nicht|nicht verfügbar|nicht erreichbar|keinen zugriff|zugriff verweigert|schiefgelaufen|schief gelaufen|später erneut|erneut versuchen|fehler aufgetreten|unterstützt keine|nicht angezeigt werden",
    "nl": "niet gevonden|bestaat niet|niet beschikbaar|geen toegang|toegang geweigerd|iets mis|later opnieuw|probeer het|een fout opgetreden|ondersteunt geen|niet worden getoond",
    "fr": "introuvable|n'existe pas|n'existe plus|pas été trouvée|pas accès|accès refusé|accès interdit|problème est survenu|erreur est survenue|réessayez|réessayer|ne prend pas en charge|être affiché|indisponible",
    "es": "no se ha encontrado|no encontrada|no se encontró|no existe|no está disponible|no tiene acceso|acceso denegado|algo ha fallado|salió mal|ocurrido un error|producido un error|inténtelo|inténtalo|no admite|no se puede mostrar",
    "pt": "não foi encontrada|não encontrada|não existe|não está disponível|não tem acesso|acesso negado|correu mal|deu errado|ocorreu um erro|tente mais|tente novamente|não suporta|não pode ser mostrado",
    "it": "non è stata trovata|non trovata|non esiste|non disponibile|non hai accesso|accesso negato|andato storto|verificato un errore|riprova|non supporta|non può essere mostrato",
    "cy": "ni ddaethpwyd o hyd|heb ei ganfod|ddim yn bodoli|nid oes gennych|rhywbeth o'i le|gynnig arall|yn cefnogi|ni ellir dangos",
    "ga": "níor aimsíodh|gan aimsiú|níl rochtain|rud éigin amú|tharla fadhb|tharla earráid|bain triail|ní thacaíonn|ní féidir an",
}
#: What such messages are made of besides; covers a line only beside a telling match.
BESIDES = {
    "en": "page|site|website|url|address|link|content|server|request|requested|connection|browser|error|http|oops|sorry|please|the|this|that|that's|you|your|you're|looking for|is|was|were|it|to|on|in|of|for|by|we|an|has|been|be|or|may|seconds|reload|later|again|wait|after|ms|incident|gateway|internal|on our side|something|turn on|turned on|need|needs|enable|enabled|disable|disabled|required|requires|read|view|run|app|scripts|null|at|line|reading|variable|write|insert|title|subtitle|headline|caption|teaser|text|author|body",
    "is": "síðan|síða|síðu|sem þú|leitar að|þú|hefur|að þessari|eitthvað|hjá okkur|síðar|kveiktu á|til að lesa|þessa|vafrinn|vafranum|þinn|efnið|skriftur|villa",
    "da": "siden|side|du leder efter|blev|du|har|til denne|denne|noget|hos os|senere|slå|til|for at|læse|din browser|scripts|så indholdet|desværre|fejl|der",
    "nb": "siden|side|du leter etter|du|har|til denne|denne|noe|hos oss|senere|slå på|for å|lese|nettleseren|din|skript|innholdet|beklager|dessverre|feil|det|en",
    "nn": "sida|side|du leitar etter|du|har|til denne|denne|noko|hos oss|seinare|slå på|lese|nettlesaren|din|skript|innhaldet|orsak|feil|det",
    "sv": "sidan|sida|du letar efter|du|har|till den här|den här|något|hos oss|senare|slå på|aktivera|för att|läsa|din webbläsare|skript|innehållet|kan därför|tyvärr|fel|ett",
    "de": "die|diese|der|das|ein|gesuchte|angeforderte|seite|wurde|konnte|werden|sie|haben|auf|bei uns|ist|etwas|versuchen|es|bitte|aktivieren|um|zu|lesen|ihr|ihrem|browser|skripte|daher|kann|inhalt|leider|fehler",
    "nl": "de|deze|pagina|die je zoekt|die u zoekt|is|er|ging|er ging|bij ons|je|hebt|u|heeft|tot|het|zet|aan|schakel|in|om|te lezen|browser|uw|scripts|inhoud|kan|helaas|fout|later",
    "fr": "la|le|les|page|que vous|vous|cherchez|recherchez|demandée|est|n'avez|à cette|cette|un|une|de notre côté|plus tard|veuillez|activer|activez|pour lire|pour|votre navigateur|scripts|contenu|ne peut|désolé|erreur|oups",
    "es": "la|el|página|que busca|que buscas|a esta|esta|algo|de nuevo|más tarde|active|activa|para leer|para|su navegador|scripts|contenido|lo sentimos|error|por favor|ha|se ha|un",
    "pt": "a|o|página|que procura|solicitada|esta|algo|do nosso lado|mais tarde|novamente|ative|para ler|para|seu navegador|scripts|conteúdo|desculpe|erro|por favor|um",
    "it": "la|il|pagina|che cerchi|richiesta|a questa|questa|qualcosa|è|più tardi|attiva|abilita|per leggere|per|tuo browser|gli script|contenuto|spiacenti|errore|un|si è",
    "cy": "i'r|dudalen|tudalen|mynediad|fynediad|hon|aeth|rhowch|arni|trowch|ymlaen|i ddarllen|y|nid yw|eich porwr|sgriptiau|cynnwys|gwall",
    "ga": "an|leathanach|atá á lorg|agat|ar|seo|chuaigh|eile as|as|ball|dtaobh|ár|cuir|siúl|chun|a léamh|do bhrabhsálaí|le scripteanna|t-ábhar|a thaispeáint|earráid",
}
FILLER = "sample paragraph|replace before publishing|goes here|text here|title here|dummy text|blindtext|lorem ipsum|asdf|jkl|qwerty|placeholder|[object object]|todo: write|insert text|undefined|nan|xxx"
PROGRAMS = "traceback|stack trace|null pointer|nullpointerexception|cannot read propert|undefined variable|undefined index|fatal error|parse error|sqlstate|err_|keyerror|typeerror|valueerror|referenceerror|syntaxerror|runtimeerror|template.py|uncaught exception|unhandled exception|segmentation fault"
#: Words that tell something only before a status of three figures.
CODED = "error|http|status|fehler|erreur|feil|fejl|fel|fout|errore|erro|villa|gwall|earráid"
STATUS = re.compile(r"(?: code| kode)?[ :]{0,2}[1-5]\d\d\b")
#: Placeholders by their opening; each form is read from there.
FORMS = {
    "{": re.compile(r"\{\{[^{}\n]{0,60}\}\}|\{%[^%\n]{0,60}%\}|\{[a-z_][\w.:-]{0,60}\}"),
    "${": re.compile(r"\$\{[^{}\n]{0,60}\}"),
    "#{": re.compile(r"#\{[^{}\n]{0,60}\}"),
    "<": re.compile(r"<%[^%\n]{0,60}%>|</?noscript>"),
    "%": re.compile(r"%%[\w. -]{1,60}%%|%[a-z_]{3,40}%"),
    "[": re.compile(r"\[\[[\w. -]{1,60}\]\]|\[(?:insert|your|add|enter) [\w ]{1,40}\]"),
    "@@": re.compile(r"@@[\w. -]{1,60}@@"),
    "__": re.compile(r"__[a-z][a-z_.]{0,58}[a-z]__"),
}
#: Words of mock Latin; a line is filler if most of its words are such.
MOCK_LATIN = frozenset(
    "adipiscing aliqua aliquam amet ante arbor arcu augue bibendum bonum caelum candor commodo consectetur consequat cras curabitur curat cursus dapibus diam dictum dignissim dolor dolore donec ductus efficitur egestas eget eiusmod elementum elit enim erat eros est euismod facilisis faucibus felis fermentum ferox feugiat finibus fluvis fringilla fusce gravida gravis habitant hendrerit humus iaculis id imperdiet integer interdum ipsum justo lacinia lacus laoreet lapis lectus leo libero ligula lobortis lorem luctus maecenas magna malesuada massa mattis mauris maximus mensis metus molestie mollis morbi nec neque nexus nibh nisi nisl non novum nulla nullam nunc odio orbis orci ornare pacem pellentesque pharetra phasellus placerat pontis porta porttitor posuere praesent pretium pulvinar purus quam quies quis quisque ramus rhoncus risus rutrum sagittis sapien scelerisque sed sem semper sit sodales solum sollicitudin suscipit suspendisse tantum tellus tempor tempus tincidunt tortor tristique turpis ullamcorper ultrices umbra urna ut valles varius vehicula vel velit venenatis ventus vestibulum vitae vivamus vix viverra volutpat vulputate zelus".split()
)
#: Tokens that are no words: they hold a figure, a path, an assignment, a bracket or an inner dot.
TECHNICAL = re.compile(r"\S*[\d=/\\_<>{}\[\]#@|$]\S*|\S+\.\S+|'\w+'")
COUNTED = re.compile(r"\w", re.UNICODE)
WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=1)
def automata():
    """The automaton of telling patterns, with their kinds, and the one of the words besides."""
    import ahocorasick

    telling, besides = ahocorasick.Automaton(), ahocorasick.Automaton()
    for group in BESIDES.values():
        for phrase in group.split("|"):
            phrase = simple(phrase)
            besides.add_word(phrase, len(phrase))
    for word in MOCK_LATIN:
        if len(word) > 3:
            telling.add_word(word, ("latin", len(word)))
    for word in CODED.split("|"):
        telling.add_word(word, ("coded", len(word)))
    for group in [*TELLING.values(), FILLER, PROGRAMS]:
        for phrase in group.split("|"):
            phrase = simple(phrase)
            telling.add_word(phrase, ("phrase", len(phrase)))
    for opening in FORMS:
        telling.add_word(opening, ("form", len(opening)))
    telling.make_automaton()
    besides.make_automaton()
    return telling, besides


def whole(line: str, a: int, b: int) -> bool:
    """Whether a match stands as whole words: no letter or figure goes on at either end."""
    return not (a and line[a].isalnum() and line[a - 1].isalnum()) and not (b < len(line) and line[b - 1].isalnum() and line[b].isalnum())


def matches(line: str) -> list[tuple[int, int]]:
    """Spans of a lower-case line that tell it as residue, by the automaton; [] for none."""
    telling, _ = automata()
    spans, latin = [], 0
    for end, (kind, size) in telling.iter(line):
        a, b = end + 1 - size, end + 1
        if kind == "form":
            if m := FORMS[line[a:b]].match(line, a):
                spans.append(m.span())
        elif kind == "latin":
            latin += 1
        elif line[a:b] == "xxx":
            spans.append((a, b))
        elif whole(line, a, b) or line[a:b] in ("err_", "cannot read propert"):
            if kind == "phrase":
                spans.append((a, b))
            elif m := STATUS.match(line, b):
                spans.append((a, m.end()))
    if latin >= 2:
        words = WORD.findall(line)
        if len(words) >= 3 and sum(map(MOCK_LATIN.__contains__, words)) >= 0.6 * len(words):
            return [(0, len(line))]
    return spans


def covered(line: str) -> tuple[int, int]:
    """Characters of a line that residue covers, and all that count (letters and figures)."""
    line = simple(line).lower().replace("’", "'")
    spans = matches(line)
    total = len(COUNTED.findall(line))
    if not spans:
        return 0, total
    if not total:
        return 1, 1
    _, besides = automata()
    spans += [(end + 1 - size, end + 1) for end, size in besides.iter(line) if whole(line, end + 1 - size, end + 1)]
    spans += [m.span() for m in TECHNICAL.finditer(line)]
    got = end = 0
    for a, b in sorted(spans):
        a = max(a, end)
        if b > a:
            got += len(COUNTED.findall(line[a:b]))
            end = b
    return got, total


def sentences(line: str) -> bool:
    """Whether a line reads as a paragraph: two or more sentences, or one of more than BESIDE_CHARS."""
    return len(line) > BESIDE_CHARS or len(re.findall(r"[^\W\d_]{2,}[.!?…]['’”\"»“]?(?:\s|$)", line)) >= 2


def is_residue(text: str | None) -> bool:
    """Whether a text consists of residue, beside which at most a headline, byline, host name or label stands."""
    if not text or text.isspace():
        return False
    lines = [s for x in text.split("\n") if (s := x.strip())]
    longest = max(lines, key=len)
    if len(longest) > BESIDE_CHARS:
        # A paragraph must be residue itself; most texts end here.
        got, total = covered(longest)
        if got < COVER * total:
            return False
    hit = length = 0
    others: list[tuple[int, int]] = []
    for line in lines:
        got, total = covered(line)
        if got and got >= COVER * total:
            hit, length = hit + got, length + total
        elif sentences(line):
            return False
        else:
            others.append((len(line), total))
    # The longest of the other lines may stand beside; what is left counts in the document's length.
    room = 1.5 * BESIDE_CHARS
    for place, (size, total) in enumerate(sorted(others, reverse=True)):
        room -= size
        if place >= BESIDE or room < 0:
            length += total
    return hit > 0 and hit >= COVER * length


def residue(records: DataFrame) -> DataFrame:
    """record_kind, record_id of the records to exclude. ``records`` has record_kind, record_id, text."""

    def block(rows: dict) -> dict:
        hit = [is_residue(t) for t in rows["text"]]
        return {n: [x for x, h in zip(rows[n], hit) if h] for n in ("record_kind", "record_id")}

    return map_rows(records.where("text is not null and text <> ''").select("record_kind", "record_id", "text"), "record_kind string, record_id bigint", block)


def found(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    return residue(texts(documents)).unionByName(residue(fragments(candidates))).distinct()
