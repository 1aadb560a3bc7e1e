"""Personal information inside free text: e-mail addresses, phone numbers, identity numbers, street addresses, names.

Regular expressions propose spans, validators of each kind of number (Luhn, mod 97, letters and digits of national
numbers) confirm or weaken them, and words close by raise or lower the score of every span; spans that reach the
threshold of their kind are kept. Everything is decided inside one line and the e-mail addresses and phone numbers close
to it on other lines, so a line is judged once per worker however many revisions repeat it. Only found values leave the
scan.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import ship

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
#: Judged lines a Python worker remembers, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 100_000, 1_000
#: How close, in characters, another find counts as evidence for a name, and the kinds that count across line breaks.
NEAR, CONTACTS = 90, ("email", "phone")

# ---- fixed values: words of English, German, French and Spanish that surround or make up personal data ----
ID_LABELS = r"""passport|passeport|pasaporte|reisepass(?:nummer)?|identity\ card|id\ card|national\ id(?:entity)?|identity\ number|ni\ number|national\ insurance
|social\ security|soc\.\ ?sec\.|ssn|driving\ licen[cs]e|driver['’]?s?\ licen[cs]e|taxpayer\ id|tax\ id|personalausweis(?:nummer)?|ausweis(?:nummer|-nr)?|führerschein(?:nummer)?
|steuer-?id|steuernummer|sozialversicherungs(?:nummer|-nr)|carte\ d['’]identité|sécurité\ sociale|permis\ de\ conduire|titre\ de\ séjour|numéro\ fiscal|dni|nie|nif|curp
|carn[eé]t?\ de\ (?:identidad|conducir)|permiso\ de\ conducir|cédula|seguridad\ social|residence\ permit|health\ insurance|voter\ id|student\ id"""
EN_STREETS = "street|st|road|rd|avenue|ave|lane|ln|drive|court|terrace|close|walk|hill|row|crescent|way|place|square|grove|gardens|mews|parade|boulevard|blvd"
DE_STREETS = "straße|strasse|str\\.|gasse|weg|allee|platz|ufer|damm|ring|pfad|steig|markt|graben|chaussee|wall|stieg|zeile"
DE_PREPOSITIONS = "am|an der|an den|an dem|auf der|auf dem|auf den|im|in der|in den|zum|zur|unter den|hinter der|hinter dem|vor dem|bei der|beim"
FR_STREETS = "rue|allée|allee|avenue|av\\.|place|quai|chemin|impasse|boulevard|bd|bld|cours|route|passage|sentier|square|ruelle|faubourg|venelle"
ES_STREETS = "calle|c/|avenida|avda\\.?|av\\.|plaza|pza\\.?|paseo|camino|carretera|ctra\\.?|ronda|travesía|callejón|pasaje|cuesta|glorieta|rambla|vía"
TITLES = "mrs?|ms|miss|dr|prof|sir|lady|herrn?|frau|mme|mlle|monsieur|madame|sra?|srta|señora?|señorita|don|doña"
NOT_NAMES = """the|as|in|on|at|by|and|or|but|is|was|are|were|has|had|it|its|he|she|they|we|you|my|our|his|her|their|this|that|these|until|between|before|after|since|during|when|where|see|also|here|there|now
|der|die|das|den|dem|des|ein|eine|einen|einem|einer|und|oder|zu|zum|zur|beim|im|am|auf|aus|nach|vor|bis|seit|über|unter|ist|war|wird|wurde|hat|er|sie|es|wir|ihr|wer|wo|hier|heute|jahr|zwischen
|le|la|les|un|une|du|et|ou|où|en|au|aux|dans|sur|sous|est|était|il|elle|ce|cette|ces|son|ses|depuis|entre|avant|après
|el|los|las|unos|y|e|o|del|al|desde|hasta|era|fue|su|sus|este|esta|hoy
|january|february|march|april|june|july|august|september|october|november|december|januar|februar|märz|mai|juni|juli|oktober|dezember|enero|febrero|marzo|abril|junio|julio|agosto|octubre|noviembre|diciembre|janvier|février|mars|avril|juin|juillet|août|octobre|novembre|décembre
|isbn|file|datei|category|street|road|visitors|questions|according|photo|photograph|foto|scan|text|letter|plan|route|grid|order|wrong|unsigned|auskunft|führungen|visites|visitas"""
PLACE_STARTS = "upper|lower|port|bad|saint|san|santa|new|old|north|south|east|west|mount|fort|lake|river|great|little|st"
THINGS = """bridge|mill|lock|bay|works|foundry|reservoir|station|railway|canal|tower|church|chapel|castle|park|house|hall|museum|library|school|harbour|harbor|pier|quay|dock|dockyard|market|brewery|tannery|quarry|valley|garden|orchard
|street|road|lane|avenue|court|terrace|close|walk|hill|row|crescent|drive|square|company|ltd|inc|gmbh|sons|society|club|university|island|river|lake|inn|hotel|farm|well|point|ferry|lighthouse|windmill|brücke|mühle|turm|kirche|burg|hof|schule|straße
|pont|moulin|tour|église|château|gare|puente|molino|torre|iglesia|castillo|estación"""
PHONE_WORDS = "tel|tél|telefon|téléphone|teléfono|phone|fax|mobil|mobile|cell|call|ruft|anrufen|appelez|appeler|llama|llamar|text me|ring"
MAIL_WORDS = "e-?mail|mail|courriel|correo|contact|kontakt|contacto|write|schreib(?:en|t)?|écrire|escribir|reach|ask|regards"
ADDRESS_WORDS = "address|adresse|anschrift|dirección|lives at|wohnt|habite|vive en|resides at|domiciled"
NUMBER_OF_THINGS = "isbn|issn|inventory|catalogue|catalog|shelfmark|sheet|grid|ref\\.|order|release|version|lot|population|census|oldid|diff|coord|page|vol|edition|map|berth|doi|inventar|einwohner|inventaire|población"
ROLES = r"""contact|contacto|kontakt|ansprechpartner(?:in)?|author|autor(?:in)?|auteur|owner|eigentümer(?:in)?|inhaber(?:in)?|propriétaire|propietari[oa]|caretaker|keeper|warden|hausmeister(?:in)?|gardien(?:ne)?|conserje|guard[ae]|photographer|fotograf(?:in)?
|editor|curator|secretary|treasurer|chairman|chairwoman|director|manager|teacher|nurse|engineer|architect|mayor|bürgermeister(?:in)?|maire|alcalde(?:sa)?|lehrer(?:in)?|leiter(?:in)?|name|nombre|nom|attn\.?|attention|signed|photo(?:graph)?|foto(?:grafie)?|picture"""
KIN = r"""(?:grand)?(?:father|mother|son|daughter)|uncle|aunt|brother|sister|cousin|nephew|niece|wife|husband|widow|neighbou?r|friend|colleague|vater|mutter|onkel|tante|bruder|schwester|nachbar(?:in)?|witwe|père|mère|oncle|frère|sœur|voisine?|veuve|padre|madre|tío|tía|hermano|hermana|vecin[oa]|viuda"""
CLOSINGS = r"""regards|best|yours|sincerely|thanks|cheers|grüße|gruß|salutations|cordialement|saludos|atentamente"""
BORN = r"""was\ born|born\ (?:in|on)|née?\ (?:en|le|à)|wurde\ geboren|geboren\ (?:in|am)|nació|naquit|est\ née?|died\ (?:in|on|at)|married|lives\ (?:at|in)|lived\ (?:at|in)|wohnt|wohnte|wohnhaft|habite|habitait|demeurant|vive\ en|vivía\ en|reside\ en|domiciliad[oa]|studied\ at|told\ me|told\ us|wrote\ (?:in|to|that)|noted\ (?:in|that)"""
SENT = r"""letter\ from|message\ from|note\ from|call\ from|belongs\ to|lettre\ de|brief\ von|nachricht\ von|carta\ de"""
ACTS = r"""is\ an?|was\ an?|has|had|said|says|wrote|built|keeps|kept|holds|owns|owned|moved|knows|works|worked|runs|ran|signed|ist|war|hat|sagt|schrieb|baute|besitzt|arbeitet|fragen|anrufen|est|a\ écrit|dit|possède|travaille|es|era|dice|escribió|tiene|trabaja|on\ site"""
ASKS = r"""call|ring|phone|ask|ask\ for|see|meet|contact|reach|visit|tell|keeps|holds|by|ruft?|frag(?:t|en)?|bitte|anrufen|gibt|hat|hält|verwahrt|pflegt|appelez|appeler|demandez|demander|garde|tient|llama|llamar|pregunta|preguntar|guarda|tiene|lleva"""
LEADS = "with|to|from|for|via|through|of|von|vom|mit|bei|an|für|durch|de|à|avec|chez|par|pour|a|con|por|para"
PARTICIPLES = "ed|drawn|kept|written|taken|made|held|led|given|sold|built|sent|bought|found|known|run|shot|sung|told|taught"
AT_WORDS, SPOKEN_AT_WORDS, DOT_WORDS = "at|arroba|arobase|ät|klammeraffe", "at|arroba|arobase", "dot|punkt|point|punto"
# ---- end of fixed values ----


def _texts(pattern: str, i: int = 0) -> tuple[list[tuple[str, bool]], int]:
    """The texts a verbose pattern of words, groups, classes and ``?`` begins with; whether each is the whole match; the end."""
    out, heads = [], [("", True)]
    while i < len(pattern) and pattern[i] != ")":
        c = pattern[i]
        i += 1
        if c == "|":
            out, heads = out + heads, [("", True)]
            continue
        if c in " \n":
            continue
        if pattern.startswith("(?:", i - 1):
            part, i = _texts(pattern, i + 2)
            i += 1
        elif c == "[":
            end = pattern.index("]", i)
            part, i = [(x, True) for x in pattern[i:end]], end + 1
        elif c == "\\":
            part = [("", False)] if pattern[i] == "s" else [(pattern[i], True)]
            i += 1
        else:
            part = [(c, True)]
        if pattern[i : i + 1] == "?":
            part, i = [*part, ("", True)], i + 1
        elif pattern[i : i + 1] == "*":
            part, i = [("", False)], i + 1
        heads = [h for text, whole in heads for h in ([(text + t, w) for t, w in part] if whole else [(text, False)])]
    return out + heads, i


def needed(*patterns: str) -> tuple[str, ...]:
    """The fewest texts (in lower case) of which a line holds at least one wherever one of the patterns matches."""
    texts = sorted({t.lower() for p in patterns for t, _ in _texts(p)[0]}, key=lambda t: (len(t), t))
    kept: list[str] = []
    for t in texts:
        if not any(k in t for k in kept):
            kept.append(t)
    return tuple(kept)


#: Texts without which a rule cannot match, taken from the rule's own words; they only spare the rules work.
ID_PARTS, NAME_PARTS, DOT_PARTS = needed(ID_LABELS), needed(ROLES, KIN, CLOSINGS, BORN, SENT), needed(DOT_WORDS)

_join = lambda s: "|".join(x.strip() for x in s.replace("\n", "|").split("|") if x.strip())
_X = re.X | re.I

#: Letters of every script that has capitals, as ranges of a character class.
def _letters(*kinds: str) -> str:
    points = [i for i in range(0x41, 0x2C00) if unicodedata.category(chr(i)) in kinds]
    starts = [i for i, x in enumerate(points) if not i or points[i - 1] != x - 1]
    return "".join(chr(points[a]) + (f"-{chr(points[b - 1])}" if b - a > 1 else "") for a, b in zip(starts, [*starts[1:], len(points)], strict=True))


UP, LOW = _letters("Lu", "Lt"), _letters("Ll", "Lo", "Mn")

_AT_SIGN = rf"(?:\s*[\[({{]\s*(?:{AT_WORDS})\s*[\])}}]\s*)"
_DOT_SIGN = rf"(?:\s*[\[({{]\s*(?:{DOT_WORDS})\s*[\])}}]\s*|\s(?:{DOT_WORDS})\s)"
_LOCAL = r"(?<![\w.+-])[^\W_](?:[\w.+-]*[\w+])?"
_LABEL = r"[^\W_](?:[^\W_]|-(?=[^\W_]|-))*"
_TLD = r"[^\W\d_]{2,}"
_EMAIL = re.compile(
    rf"{_LOCAL}(?:@|{_AT_SIGN}){_LABEL}(?:(?:\.|{_DOT_SIGN}){_LABEL})*(?:\.|{_DOT_SIGN}){_TLD}(?![\w])"
    rf"|{_LOCAL}\s(?:{SPOKEN_AT_WORDS})\s{_LABEL}(?:(?:\.|{_DOT_SIGN}){_LABEL})*{_DOT_SIGN}{_TLD}(?![\w])",
    re.I,
)
_AT_SEEN = re.compile(rf"[\[({{]\s*(?:{AT_WORDS})\s*[\])}}]")
_SPOKEN_AT_SEEN = re.compile(rf"\s(?:{SPOKEN_AT_WORDS})\s")
_PHONES = (
    (3, 9, 15, re.compile(r"(?<![\w@/#.+-])(?:\+|00)[1-9]\d{0,2}(?:[ ./-]?(?:\(\d{1,4}\)|\d{1,10}))(?:[ ./-]?\d{1,8}){0,6}(?![\w@])")),
    (2, 10, 11, re.compile(r"(?<![\w@/#+-])(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w@-])")),
    (2, 9, 12, re.compile(r"(?<![\w@/#.+-])(?:\(0\d{1,5}\)|0[1-9]\d{0,4})(?:[ ./-]\d{2,8}){1,4}(?![\w@])")),
    (2, 9, 9, re.compile(r"(?<![\w@/#.+-])[6789]\d{2}(?:([ .-])\d{3}\1\d{3}|(?:[ .]\d{2}){3})(?![\w@-]|[ .]\d)")),
)
_PHONE_NEAR = re.compile(rf"\b(?:{PHONE_WORDS})\b", re.I)
_MAIL_NEAR = re.compile(rf"\b(?:{MAIL_WORDS})\b", re.I)
_LIVES_NEAR = re.compile(rf"\b(?:{ADDRESS_WORDS})\b", re.I)
_THING_NEAR = re.compile(rf"(?:\b|_)(?:{NUMBER_OF_THINGS})\b[^|;\n]{{0,24}}$", re.I)
_ID_VALUE = r"(?:[A-Z]{1,5}[ -]?)?\d[0-9A-Z]*(?:[./-][0-9A-Z]*\d[0-9A-Z]*|\ \d{1,4}(?![\w]*[a-z]))*(?:[ -]?[A-Z]{1,2}(?![\w]))?"
_ID = re.compile(rf"(?<!\w)(?i:(?:{_join(ID_LABELS)}))(?i:\ (?:no|nr|num|number|nummer|número|numéro|id)\b\.?|\ n[°º]|\ \#)?\s*[:=#]?\s*(?i:is\ )?(?P<v>{_ID_VALUE})", re.X)
_MARKED = re.compile(r"(?:no|nr|num|number|nummer|número|numéro|id)\b\.?\s*[:=#]?\s*$|[°º#:=]\s*$", re.I)
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_CARD = re.compile(r"(?<![\w=.-])(?:[3-6]\d{3}([ -]?)\d{4}\1\d{4}\1\d{4}|3[47]\d{2}([ -]?)\d{6}\2\d{5})(?![\w-])")
_DNI = re.compile(r"(?<![\w.-])(?:\d{8}|[XYZ][ -]?\d{7})[ -]?[A-Z](?![\w-])")
_NIR = re.compile(r"(?<![\w.-])[12](?: ?\d{2}){3}(?: ?\d{3}){2} ?\d{2}(?![\w-])")
_NINO = re.compile(r"(?<![\w.-])[A-Z]{2}(?: ?\d{2}){3} ?[A-D](?![\w-])")

_CAP = rf"[{UP}][\w'’]*(?:-[\w'’]+)*"
_STREETS = (
    re.compile(rf"(?<![\w.,/-])\d{{1,4}}[A-Za-z]?\ (?:{_CAP}\ ){{1,3}}(?i:{EN_STREETS})(?![\w'’])\.?(?<!\.)|(?<![\w.,/-])\d{{1,4}}[a-z]?\ (?:{_CAP}\ ){{1,3}}(?i:st|rd|ave|ln|blvd)(?!\w)", re.X),
    re.compile(rf"(?<![\w-])(?:{_CAP}[ -])?[{UP}]\w*(?i:{DE_STREETS})\ ?\d{{1,3}}\ ?[a-z]?(?![\w])"),
    re.compile(rf"(?<![\w-])(?i:{DE_PREPOSITIONS.replace(' ', chr(92) + ' ')})\ (?!(?i:jahr|januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember)\b)(?:{_CAP}\ ){{1,3}}\d{{1,3}}[a-z]?(?![\w]|\ (?:m|km|t|Tonnen)\b)", re.X),
    re.compile(rf"(?<![\w.,/-])\d{{1,4}}\ ?(?:bis|ter|[a-z])?,?\ (?i:{FR_STREETS})\ (?:(?i:de\ la|de\ l['’]|du|des|de|d['’]|aux?|à\ la|la|le|les|l['’])\ ?)?{_CAP}(?:[ -](?:(?i:de\ la|du|des|de|aux?)\ )?{_CAP})*", re.X),
    re.compile(rf"(?<![\w-])(?i:{ES_STREETS})\ ?(?:(?i:de\ las?|de\ los|del|de|las?|los|el)\ )?{_CAP}(?:\ (?:(?i:de\ las?|de\ los|del|de|y)\ )?{_CAP})*,?\ (?:n\.?[º°]\ ?)?\d{{1,4}}\ ?[a-z]?(?![\w])", re.X),
)

_STREET_PARTS = (
    tuple(f" {w}" for w in EN_STREETS.split("|")),
    tuple(w.replace("\\", "") for w in DE_STREETS.split("|")),
    tuple(f"{w} " for w in DE_PREPOSITIONS.split("|")),
    tuple(f"{w} ".replace("\\", "") for w in FR_STREETS.split("|")),
    tuple(w.replace("\\", "").replace("?", "") if "?" not in w else w.split("\\")[0] for w in ES_STREETS.split("|")),
)

_STOP = rf"(?!(?i:{_join(NOT_NAMES)}|{LEADS}|{PHONE_WORDS}|e?-?mail|{_join(ROLES)}|{_join(CLOSINGS)}|{TITLES})(?![\w'’]))"
_ONE = rf"(?:(?:Mc|Mac|O['’]|D['’])?[{UP}][{LOW}'’]+|[{UP}]{{2,}})"
_NAME_WORD = rf"{_STOP}{_ONE}(?:-{_ONE})*(?![\w@])"
_NAME = re.compile(rf"(?<![\w@.-])(?:{_NAME_WORD}(?:\ [{UP}]\.)*(?:\ (?:(?:von|van)(?:\ de[rn]?)?|de(?:\ la)?|del|della|di|da))?\ {_NAME_WORD}|(?:[{UP}]\.\ ?)+{_NAME_WORD}|{_NAME_WORD},\ {_NAME_WORD}(?:\ [{UP}]\.)*)")
_TITLE_ANY = re.compile(rf"(?<!\w)(?:(?i:{TITLES})\.?|M\.)\ [{UP}]", re.X)
_TITLE_BEFORE = re.compile(rf"(?:(?<![\w])(?:(?i:{TITLES})\.?|M\.)\ )$")
_PARTICIPLES = tuple(PARTICIPLES.split("|"))
#: Cues right before a name and right behind it, and what each adds to its score.
_BEFORE = (
    (3, re.compile(rf"(?<!\w)(?i:{_join(ROLES)})\s*(?:[:=|]\s*|by\s+|\s)$", re.X)),
    (3, re.compile(rf"(?<!\w)(?i:{_join(KIN)})\s*[:,]?\s*$", re.X)),
    (3, re.compile(rf"(?<!\w)(?i:{_join(CLOSINGS)})\s*[,:—–-]+\s*$", re.X)),
    (3, re.compile(rf"(?<!\w)(?i:{_join(SENT)})\s*[:=|]?\s*$", re.X)),
    (3, re.compile(rf"\w*(?i:{PARTICIPLES})\s(?i:by|to)\s*[:=|]?\s*$")),
    (2, re.compile(rf"(?<!\w)(?i:{_join(ASKS)})\s*[:=|]?\s*$", re.X)),
    (1, re.compile(rf"(?:(?<!\w)(?i:{LEADS})|[:;=(])\s*$")),
)
_AFTER = ((3, re.compile(rf"[\s,]*(?:{BORN})\b", _X)), (2, re.compile(rf"[\s,]*(?:{ACTS})\b", _X)))
_AND_BEFORE = re.compile(r"(?:\s(?:and|und|et|y|&|e)\s)$", re.I)
_PLACE = re.compile(rf"(?:{PLACE_STARTS})(?=[ -])", re.I)
_THING = re.compile(rf"(?<![\w-])(?:{_join(THINGS)})$", re.I)
_SHIP = re.compile(r"\b(?:ferry|ship|boat|steamer|barge|schiff|fähre|bateau|navire|barco)\b[\s'\"]*$", re.I)
_DIGIT = re.compile(r"\d")


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        n = int(ch) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an international account number has the right check digits."""
    turned = iban[4:] + iban[:4]
    return turned.isalnum() and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def spanish_letter(value: str) -> bool:
    """Whether the letter of a DNI or NIE is the one its number has."""
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(value[:-1].replace("X", "0").replace("Y", "1").replace("Z", "2")) % 23] == value[-1]


def french_key(value: str) -> bool:
    """Whether the last two digits of a French social security number are its key."""
    return 97 - int(value[:13]) % 97 == int(value[13:])


def german_check(value: str) -> bool:
    """Whether the last digit of a German tax number is right (ISO 7064, mod 11, 10)."""
    product = 10
    for ch in value[:10]:
        total = (int(ch) + product) % 10 or 10
        product = total * 2 % 11
    return (11 - product) % 10 == int(value[10])


def british_shape(value: str) -> bool:
    """Whether a national insurance number has a prefix and a suffix that are given out."""
    return bool(re.fullmatch(r"(?!BG|GB|NK|KN|TN|NT|ZZ)[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z]\d{6}[A-D]", value))


def american_ranges(value: str) -> bool:
    """Whether area, group and serial of a social security number are in use."""
    return value[:3] not in ("000", "666") and value[0] != "9" and value[3:5] != "00" and value[5:] != "0000"


#: By words in the label (none: any label) and the shape of the number, the check that such a number must pass.
VALIDATORS = (
    (("dni", "nif", "nie"), re.compile(r"(?:\d{8}|[XYZ]\d{7})[A-Z]"), spanish_letter),
    (("sécurité sociale",), re.compile(r"[1-478]\d{14}"), french_key),
    (("steuer-id", "steuerid"), re.compile(r"\d{11}"), german_check),
    (("ni number", "national insurance"), re.compile(r"[A-Z]{2}\d{6}[A-Z]"), british_shape),
    (("ssn", "social security", "soc"), re.compile(r"\d{9}"), american_ranges),
)


def checked(label: str, value: str) -> bool | None:
    """Whether a labelled number passes the check of its kind; None where no check is known."""
    compact = re.sub(r"[\W_]", "", value).upper()
    low = label.lower()
    return next((check(compact) for words, shape, check in VALIDATORS if any(w in low for w in words) and shape.fullmatch(compact)), None)


#: Unlabelled numbers with their checks. Like phone numbers they have six digits with at most three signs in between.
_BY_DIGITS = ((_CARD, luhn), (_NIR, french_key), (_DNI, spanish_letter), (_NINO, british_shape))
_SIX_DIGITS = re.compile(r"\d(?:\W{0,3}\d){5}")


def _free(taken: list[Span], start: int, end: int) -> bool:
    return all(end <= s.start or start >= s.end for s in taken)


def _has(low: str, parts: tuple[str, ...]) -> bool:
    for p in parts:  # a plain loop: a generator costs as much as the searches
        if p in low:
            return True
    return False


def _by_seen(low: str) -> bool:
    """Whether a participle with "by" or "to" stands in a line, as every cue of that kind has it."""
    for word in ("by", "to"):
        at = low.find(word, 1)
        while at > 0:
            if low[at - 1].isspace() and low.endswith(_PARTICIPLES, 0, at - 1) and not (low[at + 2 : at + 3].isalnum() or low[at + 2 : at + 3] == "_"):
                return True
            at = low.find(word, at + 2)
    return False


def _folded(line: str) -> str:
    """Lower case in which also the letters stand plain that patterns without case take for i and s."""
    low = line.lower()
    return low if low.isascii() else low.replace("i\u0307", "i").replace("ı", "i").replace("ſ", "s")


def _email_like(low: str) -> bool:
    """Whether a line has what every written e-mail address has: an at-sign, or a spoken one and a spoken dot."""
    return "@" in low or bool(_AT_SEEN.search(low)) or (_has(low, DOT_PARTS) and bool(_SPOKEN_AT_SEEN.search(low)))


def _numbers(line: str, low: str, taken: list[Span]) -> None:
    for m in _ID.finditer(line) if _has(low, ID_PARTS) else ():
        value, label = m.group("v"), line[m.start() : m.start("v")]
        digits = [c for c in value if c.isdigit()]
        # a label counts 2, enough digits or a mark such as "no." 1 each; a mistyped number still names its owner
        score = 2 + (len(digits) >= 5) + (len(digits) >= 3 and bool(_MARKED.search(label)))
        score += {True: 1, False: -0.5, None: 0}[checked(label, value)] - 3 * (len(set(digits)) == 1 and len(digits) > 3)
        if score >= 2.5:
            taken.append(Span(m.start("v"), m.end("v"), "id_number", score))
    digits_seen = _SIX_DIGITS.search(line)
    for rx, check in ((_IBAN, mod97), *(_BY_DIGITS if digits_seen else ())):
        for m in rx.finditer(line):
            if _free(taken, *m.span()) and check(re.sub(r"[ -]", "", m.group())):
                score = 3 - 3 * bool(_THING_NEAR.search(line[max(0, m.start() - 40) : m.start()]))
                if score >= 2:
                    taken.append(Span(*m.span(), "id_number", score))
    for base, least, most, rx in _PHONES if digits_seen else ():
        for m in rx.finditer(line):
            start, end = m.span()
            if not least <= sum(c.isdigit() for c in m.group()) <= most or not _free(taken, start, end):
                continue
            before = line[max(0, start - 40) : start]
            score = base + 2 * bool(_PHONE_NEAR.search(before)) - 3 * bool(_THING_NEAR.search(before))
            if score >= 2:
                taken.append(Span(start, end, "phone", score))


def _names(line: str, low: str, taken: list[Span], outside: tuple[Span, ...] = ()) -> None:
    evidence = [*taken, *outside]
    if not evidence and not _has(low, NAME_PARTS) and not _by_seen(low) and not _TITLE_ANY.search(line):
        return
    found: list[Span] = []
    at = 0
    while m := _NAME.search(line, at):
        start, end = m.span()
        at = end
        value = m.group()
        if not _free(evidence, start, end):
            at = start + 1
            continue
        before, after = line[max(0, start - 40) : start], line[end : end + 40]
        titled = _TITLE_BEFORE.search(before)
        lead = before[: titled.start()] if titled else before
        near = [s for s in evidence if s.start - end < NEAR and start - s.end < NEAR]
        # a cue in capitals says nothing about a name in capitals: all words are shouted
        shouted = lambda cue: value.isupper() and cue.group().strip().isupper()
        cues = [3.0 * bool(titled)]
        cues.append(max((n for n, rx in _BEFORE if (cue := rx.search(lead)) and not shouted(cue)), default=0))
        cues.append(max((n for n, rx in _AFTER if (cue := rx.match(after)) and not shouted(cue)), default=0))
        # weak cues count only beside another find
        score = sum(n for n in cues if n >= 3 or near)
        if found and _AND_BEFORE.search(before) and 0 <= start - found[-1].end <= 6:
            score += 3
        score += 2 * bool(near)
        if any(0 <= s.start - end <= 3 and not line[end : s.start].strip(" (,;:|<") for s in near):
            score += 1
        cell = re.search(r"(?:^|\|)\s*(?:[\w ]+=\s*)?$", lead) and re.match(r"\s*(?:\||$)", after)
        score += 2 * bool(cell and near)
        opened = line.rfind("[[", 0, start)
        if opened >= 0 and "]]" not in line[opened:start] and not re.match(r"\[\[\s*(?:file|image|datei|fichier|archivo)\s*:", line[opened:], re.I):
            score -= 5
        if _PLACE.match(value) or _THING.search(value) or re.match(rf"\s(?:{_join(THINGS)})\b", after, re.I):
            score -= 5
        if re.match(r"\s*&", after) or re.search(r"&\s*$", before) or _SHIP.search(before) or (before.endswith("''") and after.startswith("''")):
            score -= 5
        # a contact alone speaks for no shouted words, no amounts ("50 Tonnen Salz") and no markup
        plain = not value.isupper() and "''" not in value and not re.search(r"\d\s*$", before)
        if score >= 3 or (score >= 2 and plain and any(s.kind in CONTACTS for s in near)):
            found.append(Span(start, end, "person_name", score))
        elif score >= -1:
            at = start + len(value.split(" ")[0]) if " " in value else end
    taken.extend(found)


def _emails(line: str, low: str, taken: list[Span]) -> None:
    for m in _EMAIL.finditer(line) if _email_like(low) else ():
        start, end = m.span()
        written = "@" in m.group() or bool(_AT_SEEN.search(m.group().lower()))
        quoted = line[max(0, start - 2) : start] == "''" and line[end : end + 2] == "''"
        score = 2 + written + bool(_MAIL_NEAR.search(line[max(0, start - 40) : start])) - 2 * (quoted and not written)
        if score >= 2:
            taken.append(Span(start, end, "email", score))


def _streets(line: str, low: str, taken: list[Span]) -> None:
    for rx, parts in zip(_STREETS, _STREET_PARTS, strict=True):
        for m in rx.finditer(line) if _has(low, parts) else ():
            start, end = m.span()
            if _free(taken, start, end):
                before = line[max(0, start - 40) : start]
                score = 3 + bool(_LIVES_NEAR.search(before)) - 2 * bool(_THING_NEAR.search(before))
                if score >= 2:
                    taken.append(Span(start, end, "street_address", score))


def line_spans(line: str, outside: tuple[Span, ...] = ()) -> tuple[Span, ...]:
    """The kept spans of one line of any length in order of place; they never overlap.

    ``outside`` are contacts on other lines, with places counted from the start of this line.
    """
    return _remembered(line, outside) if len(line) <= REMEMBERED_CHARS else _judge(line, outside)


@lru_cache(maxsize=REMEMBERED)
def _remembered(line: str, outside: tuple[Span, ...]) -> tuple[Span, ...]:
    return _judge(line, outside)


def _judge(line: str, outside: tuple[Span, ...] = ()) -> tuple[Span, ...]:
    low = _folded(line)
    taken: list[Span] = []
    _emails(line, low, taken)
    if _DIGIT.search(line):
        _streets(line, low, taken)
        _numbers(line, low, taken)
    taken = [s for i, s in enumerate(taken) if _free(taken[:i], s.start, s.end)]
    _names(line, low, taken, outside)
    return tuple(sorted(taken))


def _outside(lines: list[str], found: list[tuple[Span, ...]]) -> dict[int, list[Span]]:
    """Per line that has contacts of other lines within ``NEAR`` characters: these contacts, placed from its start."""
    out: dict[int, list[Span]] = {}
    for i, spans_here in enumerate(found):
        for s in spans_here:
            if s.kind not in CONTACTS:
                continue
            start, j = s.start, i  # how far line j starts before the contact
            while j > 0 and start + 1 < NEAR:
                j -= 1
                gap, start = start + 1, start + 1 + len(lines[j])
                if lines[j] and gap < NEAR:
                    out.setdefault(j, []).append(Span(start, start + s.end - s.start, s.kind, s.score))
            end, j = len(lines[i]) - s.end + 1, i + 1  # how far line j starts behind the contact
            while j < len(lines) and end < NEAR:
                if lines[j]:
                    out.setdefault(j, []).append(Span(-end - (s.end - s.start), -end, s.kind, s.score))
                end, j = end + len(lines[j]) + 1, j + 1
    return out


def spans(text: str) -> Iterator[Span]:
    """Spans of a whole text of any length, with places in that text."""
    lines = text.split("\n")
    found = [line_spans(line) if line else () for line in lines]
    for i, near in _outside(lines, found).items():
        found[i] = line_spans(lines[i], tuple(near))
    at = 0
    for line, kept in zip(lines, found, strict=True):
        for s in kept:
            yield Span(s.start + at, s.end + at, s.kind, s.score)
        at += len(line) + 1


def redact_text(text: str) -> str:
    """The text with every span replaced by its typed placeholder, such as ``[EMAIL]``; the rest stays as it is."""
    out, at = [], 0
    for s in spans(text):
        out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = s.end
    return "".join(out) + text[at:] if out else text


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, kind, value: every value exactly as it stands, once per document and kind.

    Null and empty texts have none; an empty table gives no rows; equal texts each have their own rows.
    """

    ship(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, *v) for d, t in zip(b["doc_id"], b["text"], strict=True) if t for v in {(s.kind, t[s.start : s.end]): 1 for s in spans(t)}]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "value"])

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(scan, "doc_id bigint, kind string, value string")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text with typed placeholders, n_spans. Null texts stay null with 0 spans."""

    ship(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [t and redact_text(t) for t in b["text"]], "n_spans": [sum(1 for _ in spans(t)) if t else 0 for t in b["text"]]})

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(scan, "doc_id bigint, text string, n_spans bigint")
