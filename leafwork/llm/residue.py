"""Template residue, filler text, server messages and notices in place of content.

Placeholders are found by one grammar for each kind of delimiter, each of which ends at its closing delimiter or the
line's end.  Whether a marker is content or only shown is decided by its surroundings and by density.  Surroundings:
quoted and code spans, set-builder formulas, and sentences that speak about a marker (a tutorial, a guide, "stands
for", "is written").  Density: a span is only shown if SHOWN_WORDS words stand outside the spans of its text, and a
sentence only speaks about markers if it has TOLD_WORDS other words for each of them.  Messages and notices are
grammars too (a thing, then what failed with it, in several languages); they count only where they begin a sentence,
since a description that *mentions* one begins with the thing described.  Filler without a marker is found by
density: a lexicon of filler words is read off the sentences that carry a marker ("lorem ipsum"), and a sentence made
of such words is filler too.

Defined results: null, blank and default texts are never residue.  Texts are read whole.  Rows of one key count
once.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.runtime import broadcast_if_small

#: Names that stand in placeholders are words, dotted or spaced paths.
_NAME = r"[\p{L}_][\p{L}\d_.\- ]*+"
#: One grammar for each delimiter.
PLACEHOLDERS = {
    "mustache": r"\{\{[^{}\n]+\}\}",
    "jinja": r"\{%[^%\n]+%\}",
    "shell": r"[$#]\{[^{}\n]+\}",
    "erb": r"<%[^%\n]+%>",
    "double_bracket": rf"\[\[\s*{_NAME}\s*\]\]",
    "double_angle": rf"<<\s*{_NAME}\s*>>",
    "at": r"@@[A-Za-z_.]{2,}@@",
    "percent": r"%%[A-Za-z_.]{2,}%%|(?<![\w%])%[A-Z_]{3,}%(?!\w)",
    "printf": r"(?<![\w%])%(?:\d+\$)?[sdif](?![\w%])",
    "underscore": r"(?<!\w)__[A-Za-z](?:[A-Za-z.]|_(?!_))+__(?!\w)",
    "dollar": r"(?<![\w$])\$[A-Za-z_]{3,}\$(?!\w)",
    "brace": rf"(?<![{{$#])\{{\s*(?:{_NAME}|\d{{1,2}})\s*\}}(?!\}})",
    "angle": r"(?<![<\w])<(?!/?(?:html|head|title|body|hr|br|p|b|i|em|sub|sup|h\d|div|span)\b)[A-Za-z][A-Za-z_.]{2,}>(?!>)|(?i)<\s*(?:describe|insert|add|enter|your|write|put|type)\b[^<>\n]*>",
    "bracket_order": r"(?i)\[\s*(?:insert|add|enter|your|describe|image|caption|title|todo|tbd|placeholder|bild|texte?|texto|ins[eé]rer|insertar|hier|ici|aqu[ií])\b[^\]\n]*\]|\((?:your|insert|add|enter)\s[^()\n]+here\)",
    "blank": r"(?<!\w)_{3,}(?!\w)",
    "letters": r"(?<![\w.])(?:XXX+|YYY+|ZZZ+|NNN+|(?:XX|NN|YY)(?=\s+(?:percent|per cent|%|Prozent|pour cent|por ciento)))(?![\w])",
    "unresolved": r"\[object Object\]|^\s*undefined\b[^\n]*\b(?:null|NaN|undefined)\b|(?im:^\s*(?:title|description|caption|alt)\s*:\s*(?:undefined|null|NaN|None)\s*$)",
    "order": r"(?im)^\s*(?:TBD|TODO|FIXME)\b[^\n]*$|^\s*(?:Click|Tap) to add (?:text|title|subtitle|notes|a picture|picture)\b|^\s*Enter (?:a|the|your) (?:short |brief )?(?:summary|description|caption|title|text)\b|^\s*(?:Add|Insert|Write|Type|Put|Enter|Describe)\b[^.!?\n]*\bhere\b|^\s*(?:Description|Text|Caption|Title|Summary) goes here\b",
}
_GRAMMAR = "|".join(f"(?:{p})" for p in PLACEHOLDERS.values())
#: What any of the grammars needs; cheaper than all of them at every character.
_GATE = r"[{<\[@$#_]|(?=[%(XYZNun])(?:%[%\dA-Za-z]|\((?i:your|insert|add|enter)\s|[XYZN]{2}|undefined|null|NaN|None)|(?<![\p{L}\d])[Hh][Ee][Rr][Ee]\b|(?m:^)\s*(?i:TBD|TODO|FIXME|Click|Tap|Enter)\b"
#: Markers of filler text.
FILLER_MARK = (
    r"(?i)(?:^|[.!?\n]\s*|^\W*)(?:lorem ipsum\b|dummy text\b|placeholder text\b|platzhaltertext\b|blindtext\b|beispieltext\b|texto de (?:ejemplo|relleno|prueba)\b|texte (?:à compléter|de remplissage|d'exemple|factice)|sample text\b|this is (?:a )?(?:sample|placeholder|dummy)\b"
    r"|(?:exemple|ejemplo|beispiel|esempio|exemplo|example|sample)[ -](?:de |of (?:a )?|di |für (?:eine )?)?(?:légende|légendes|leyenda|texte?|texto|testo|bildunterschrift|beschreibung|description|descripción|didascalia|legenda|caption)\b[^.!?\n]*(?:remplacer|reemplazar|sustituir|ersetzen|sostituire|substituir|replace))"
)
#: A text that is one word over and over; the last one may be cut.
REPEATED = r"(?is)^\W*+(\w{2,})(?:[\s,;.|/\-]++\1){3,}+[\s,;.|/\-]*+\w*+\W*+$"
_START = r"(?:^|[.!?\n]\s*)"
#: Things that fail and what fails with them, by language; a message is a thing at the beginning of a sentence, then a failure.
FAILURES = (
    (r"page|file|image|picture|document|resource|content|site|website|server|service|connection|request|deployment|session|link|url|address|account",
     r"not found|no longer (?:exists?|available)|(?:does not|doesn't) exist|(?:could not|couldn't|cannot|can't) be (?:loaded|found|displayed|opened|shown|reached|fetched|processed)|(?:is|are) (?:not available|unavailable|temporarily unavailable|down for)|timed out|was (?:reset|refused|aborted|closed)|failed|(?:has|have) (?:moved|expired|ended|been (?:moved|removed|deleted|locked|suspended))"),
    (r"seite|datei|bild|dokument|ressource|inhalt|dienst|server|verbindung|anfrage|sitzung|adresse",
     r"nicht (?:gefunden|geladen|angezeigt|geöffnet|verfügbar|erreichbar|vorhanden)|existiert nicht|abgelaufen|fehlgeschlagen|unterbrochen"),
    (r"page|fichier|image|document|ressource|contenu|service|serveur|connexion|requête|session",
     r"introuvable|n'existe (?:pas|plus)|n'a pas (?:pu|été)|(?:est )?indisponible|a expiré|a échoué|non (?:trouvée?|disponible)|a rencontré"),
    (r"página|archivo|imagen|documento|recurso|contenido|servicio|servidor|conexión|solicitud|sesión",
     r"no (?:encontrad[oa]|disponible|existe|se (?:encuentra|encontró|ha podido|pudo|puede))|ha (?:caducado|expirado|fallado)|caducó|expiró"),
    (r"pagina|file|immagine|documento|risorsa|contenuto|servizio|sessione|connessione", r"non (?:trovat[oa]|disponibile|esiste|è stat[oa] trovat[oa]|è disponibile)|(?:è )?scadut[oa]|non può essere"),
    (r"página|arquivo|ficheiro|imagem|documento|recurso|conteúdo|serviço|sessão|conexão", r"não (?:encontrad[oa]|disponível|existe|foi|pôde|está disponível)|expirou"),
)
#: Names of statuses stand alone or before a mark.
_STATUS = r"Bad Request|Unauthorized|Forbidden|Not Found|Method Not Allowed|Request Time-?out|Gone|Too Many Requests|Internal Server Error|Not Implemented|Bad Gateway|Service (?:Temporarily )?Unavailable|Gateway Time-?out"
#: Messages of servers and viewers, as they begin a sentence.
ERRORS = r"(?i)" + _START + r"(?:(?:HTTP(?:/\d(?:\.\d)?)?|Error|Erreur|Fehler|Status)(?:\s+code)?[\s:]{1,3}[1-5]\d\d\b" + "|".join([
    rf"|[45]\d\d (?:{_STATUS})\b",
    rf"(?:{_STATUS})(?=\s*(?:[:.!;–-]|$))",
    r"Error: ",
    r"(?:Traceback|Exception|Stack trace)\b[^\n:]*:",
    r"Rate limit exceeded\b",
    r"The page you (?:asked for|requested|are looking for)\b",
    r"(?:Oops\W+)?(?:Sorry, (?:this|the|we|something|an error)|(?:Something|An error) (?:went wrong|occurred|has occurred))\b",
    r"No se (?:ha podido|pudo) (?:cargar|encontrar)|Impossible de (?:charger|trouver|afficher)",
]) + ")"
FAILED = r"(?i)" + _START + r"(?:" + "|".join(rf"(?:\p{{L}}+[ ]){{0,2}}(?:{thing})\b(?:[ ,]*+(?!(?:{failed}))[\p{{L}}\d'’]+){{0,5}}[ ,]+(?:{failed})\b" for thing, failed in FAILURES) + ")"
ERROR_MARKUP = r'(?is)^\s*\{\s*"?(?:error|errors|status|fault|message|code)"?\s*:.*\}\s*$|<title>\s*(?:[45]\d\d|error)\b|^\s*<(?:!doctype html|html|head|body)\b'
#: Notices that scripts, access or a sign-in are required.
NOTICES = r"(?i)" + _START + "(?:" + "|".join([
    r"(?:Please |Bitte |Veuillez |Por favor,? |Per favore,? )?(?:enable|turn on|activate|allow|accept|aktivieren Sie|erlauben Sie|activer|activez|autorisez|active|habilite|permita|attivare|abilitare|attivi|ative) (?:JavaScript|scripts?|cookies)\b",
    r"You (?:need to|must|have to) (?:turn on|enable|sign in|log in|allow)\b",
    r"(?:JavaScript|Cookies?|Scripts?) (?:is|are|must be|seems?) (?:required|disabled|enabled|needed|turned off|blocked)\b",
    r"This (?:viewer|site|page|app|website) (?:does not work|doesn't work|requires|needs)\b",
    r"Your browser (?:blocks|does not support|doesn't support|has)\b",
    r"Checking (?:your browser|if the site|the site connection)\b",
    r"(?:Access|Permission) (?:denied|is denied|forbidden)\b|Acc[eèé]so? (?:denegado|refusé|interdit|negato|negado)\b|Zugriff (?:verweigert|nicht erlaubt)\b",
    r"You (?:don't|do not) have (?:the )?(?:permissions?|access|rights?)\b|You (?:lack|need) (?:the )?(?:permissions?|access|rights?)\b|You are not (?:authori[sz]ed|allowed)\b",
    r"Your session has\b",
    r"(?:Please |You must |Bitte |Veuillez )(?:sign|log) ?in\b|(?:Sign|Log) in to (?:continue|view|see|access)\b|Bitte (?:melden Sie sich|anmelden)\b|Sie müssen sich anmelden\b|(?:Veuillez vous connecter|Vous devez vous connecter|Connectez-vous)\b|(?:Inicie|Debe iniciar) sesión\b",
    r"Loading(?:\.{2,}|…)\s*$",
    r"Verify(?:ing)? (?:that )?you are (?:a )?human\b",
]) + ")"
#: Quoted and code spans, and set-builder formulas: what a description shows, not what it is.
FORMULA = r'\{\s*\w\s*[|:∣][^{}\n]*\}'
SHOWN = r'"[^"\n]*"|“[^”\n]*”|«[^»\n]*»|„[^“\n]*“|(?<![\p{L}\d])\'[^\'\n]*\'(?![\p{L}\d])|```[\s\S]*?```|`[^`\n]+`|' + FORMULA
_QUOTES = r'["“”«»„`\']'
#: A sentence that speaks about markers: a tutorial, a source view, an explanation.
_TUTORIAL_WORDS = (
    r"(?i)\b(?:code editor|template (?:line|syntax|language|engine)|placeholder (?:box|boxes|syntax|fields?|names?|variables?)|source code|code (?:snippet|listing|sample|block)|syntax example|mock-?up|wireframe|tutorial|documentation|(?:settings|user|style|reference) guide|handbook|manual"
    r"|explain(?:s|ed|ing)?|(?:shows|illustrates|demonstrates) how|stands? for|denotes?|is (?:written|replaced|substituted|escaped)|written as|format string|regular expression|erklärt|steht für|Vorlage|explique|signifie|modèle de|explica|significa|plantilla)\b"
)
#: A span is only shown if so many words stand outside the spans of its text; a sentence speaks about markers if it has so many words for each.
SHOWN_WORDS, TOLD_WORDS = 3, 5
DEFAULT_TEXT = "(no description)"
#: A word is filler if this share of its occurrences lies in marked sentences; a sentence, if this share of its words is.
FILLER_WORD_SHARE, FILLER_SENTENCE_SHARE, FILLER_SENTENCE_WORDS = 0.3, 0.7, 5


def has_content(text: Column) -> Column:
    return text.isNotNull() & text.rlike(r"(?U)\S") & (F.trim(text) != DEFAULT_TEXT)


def _count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+"))


def bare_text(text: Column) -> Column:
    """The text without what it only shows: quoted and code spans, formulas, sentences that speak about markers.

    A text with hardly a word outside its quoted and code spans shows nothing, it is what stands in them; a sentence
    with more markers than words to tell about them is judged as any other.
    """

    def told(rest: Column) -> Column:
        about = lambda s: s.rlike(_TUTORIAL_WORDS) & (_count_words(F.regexp_replace(s, _GRAMMAR, " ")) >= TOLD_WORDS * F.greatest(F.lit(1), F.regexp_count(s, F.lit(_GRAMMAR))))
        return F.when(rest.rlike(_TUTORIAL_WORDS), F.array_join(F.filter(F.split(rest, r"(?<=[.!?]\s)"), lambda s: ~about(s)), "")).otherwise(rest)

    def outside(rest: Column) -> Column:
        return F.when(~text.rlike(_QUOTES) | (_count_words(rest) >= SHOWN_WORDS), told(rest)).otherwise(F.regexp_replace(F.regexp_replace(text, FORMULA, " "), _QUOTES, " "))

    return F.transform(F.array(F.when(text.rlike(_QUOTES[:-1] + "{]"), F.regexp_replace(text, SHOWN, " ")).otherwise(text)), outside)[0]


def residue_kinds(text: Column) -> Column:
    """The kinds of residue in a text by grammar alone: an array of placeholder, filler, error, notice."""

    def kinds(bare: Column) -> Column:
        found = [
            F.when(bare.rlike(_GATE) & bare.rlike(_GRAMMAR), F.lit("placeholder")),
            F.when(bare.rlike(FILLER_MARK) | text.rlike(REPEATED), F.lit("filler")),
            F.when(bare.rlike(ERRORS) | bare.rlike(FAILED) | text.rlike(ERROR_MARKUP), F.lit("error")),
            F.when(bare.rlike(NOTICES), F.lit("notice")),
        ]
        return F.array_compact(F.array(*found))

    return F.flatten(F.transform(F.array(bare_text(text)), kinds))  # the bare text is made once, as the lambda's variable


def _sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+|\n")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}{2,})"), F.lit(1))


def filler_lexicon(texts: DataFrame, text: str) -> DataFrame:
    """(word): words of which at least FILLER_WORD_SHARE of all occurrences lie in marked sentences.

    Both counts come out of one pass over all texts and one aggregate that combines before it shuffles.
    """
    sentences = texts.select(F.explode_outer(_sentences(F.col(text))).alias("s"))
    marked = sentences.select("s", F.when(F.col("s").rlike(FILLER_MARK) & ~F.col("s").rlike(_TUTORIAL_WORDS), 1).otherwise(0).alias("marked"))
    counts = marked.select("marked", F.explode_outer(_words(F.col("s"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("marked").alias("n_marked"))
    return counts.where((F.col("n_marked") > 0) & (F.col("n_marked") >= FILLER_WORD_SHARE * F.col("n"))).select("word")


def detect_residue(df: DataFrame, keys: list[str], text: str, within: DataFrame | None = None) -> DataFrame:
    """``keys`` and ``kinds`` (never empty) of the records that are or contain residue, one row for each key.

    A key is a case if any delivery of it is one.  The grammars run where the text is read; only counts of
    words and the cases themselves are shuffled.  With ``within`` (keys) only those records are asked about, while the
    lexicon still comes from all.
    """
    every = df.select(*keys, F.col(text).alias("_text")).where(has_content(F.col("_text")))
    some = every if within is None else every.join(within, keys, "left_semi")
    # outer, since Catalyst would put a filter below an inner explode and build the array twice
    seen = some.select(*keys, F.explode_outer(residue_kinds(F.col("_text"))).alias("kind")).where(F.col("kind").isNotNull())
    lexicon = broadcast_if_small(filler_lexicon(every, "_text"), "filler_lexicon")
    sentences = some.select(*keys, F.posexplode_outer(_sentences(F.col("_text"))).alias("_at", "_s")).where(~F.col("_s").rlike(_TUTORIAL_WORDS))
    words = sentences.select(*keys, "_at", _words(F.col("_s")).alias("_w")).select(*keys, "_at", F.size("_w").alias("_n"), F.explode_outer("_w").alias("word"))
    hits = words.join(lexicon, "word").groupBy(*keys, "_at", "_n").agg(F.count(F.lit(1)).alias("_hits"))
    filler = hits.where((F.col("_n") >= FILLER_SENTENCE_WORDS) & (F.col("_hits") >= FILLER_SENTENCE_SHARE * F.col("_n"))).select(*keys, F.lit("filler").alias("kind"))
    return seen.unionByName(filler).groupBy(*keys).agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
