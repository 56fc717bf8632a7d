"""Personal information in free text: typed spans and redacted text.

*Generators* propose overlapping spans of each kind with high recall: patterns for e-mail
addresses, numbers and postal addresses, and runs of name-like words for persons. *Boosted trees*
judge each span by its format and its context. Thresholds calibrated on held-out examples
select, and of overlapping spans the surest stays.

Which words are name-like is learnt from the corpus itself: a pass over all documents counts how
often each word stands in a position that only names have (behind a title, in front of an e-mail
address that repeats it, behind words such as "witnessed by") and how often it stands anywhere.

The trees are trained on examples that :mod:`strataline.llm.pii_examples` writes.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.boosting import Boosted
from strataline.session import checkpoint_dir

KINDS = ("email", "phone", "id_number", "address", "person")
#: Words of the corpus lexicon that every worker holds, those of most evidence; bounds the broadcast (about 5 MB).
#: It is a cache: the evidence on all other words reaches the texts that hold them by a join.
LEXICON_WORDS = 60_000

# Words that announce an item, by kind, and words that announce other numbers.
CUES = {
    "phone": "call phone telephone tel mobile cell fax ring dial extension telefonisch telefon handy mobil rufnummer durchwahl rückruf fernsprecher téléphone tél portable appeler joignable "
    "teléfono tfno móvil celular llamar llame telefone telemóvel ligar telefono cellulare chiamare telefoon mobiel bellen телефон тел моб факс звонить 电话 手机 传真 電話 携帯",
    "id_number": "passport card identity licence license ssn insurance social personal national holder reisepass pass personalausweis ausweisnummer ausweis steuernummer steuer-id "
    "steueridentifikationsnummer versicherungsnummer sozialversicherung passeport identité sécurité carte nir pasaporte identidad documento dni nie nif passaporte identificação cpf contribuinte "
    "identità carta codice fiscale paspoort identiteitskaart bsn burgerservicenummer паспорт снилс инн удостоверение 身份证 护照 旅券 マイナンバー",
    "address": "address resides residing lives living domiciled deliver delivery invoice correspondence ship mail visit anschrift adresse wohnt wohnhaft ansässig lieferung lieferadresse zustellung "
    "demeure demeurant domicilié réside livrer dirección domicilio vive reside enviar entrega morada endereço residente indirizzo residente abita consegna adres woont wonende bezorgen адрес "
    "проживает проживающий доставка 地址 住址 住所",
    "other": "lot batch catalogue catalog docket fee code reference ref run claims claim table seq sequence compound figure fig example units order invoice-no version part model patent application "
    "publication grant filing wo ep us aktenzeichen charge bestellnummer artikelnummer anmeldung dossier référence commande demande lote expediente referencia pedido solicitud número processo "
    "encomenda lotto pratica ordine domanda partij zaaknummer bestelling aanvraag партия заявка заказ номер 批号 申请号 订单 番号 出願",
}
TITLES = (
    "mr mrs ms miss dr prof professor sir herr herrn frau fräulein monsieur madame mademoiselle mme mlle m señor señora señorita don doña sr sra srta dra doctor doctora docteur doktor senhor senhora "
    "doutor doutora signor signora signorina sig dott dottore dottoressa avv mevrouw meneer heer dhr mw господин госпожа г-н г-жа доктор профессор"
)
#: Honorifics that follow a name in East Asian texts.
HONORIFICS = "先生 女士 小姐 教授 博士 さん 様 氏"
# What stands in front of a person's name in letters, forms and minutes, in the languages of the alphabet scripts.
ROLES = (
    "inventor", "inventors", "co-inventor", "author", "applicant", "witness", "witnessed by", "signed", "signed by", "countersigned by", "contact", "contact person", "attn", "attention", "care of",
    "c/o", "cc", "bcc", "sincerely", "regards", "on behalf of", "represented by", "prepared by", "approved by", "reviewed by", "written by", "reported by", "presented by", "supervised by",
    "handed to", "spoke to", "spoke with", "met with", "statement of", "declaration of", "signature of", "name", "employee", "patient",
    "erfinder", "erfinderin", "gezeichnet", "unterzeichnet von", "unterschrieben von", "bezeugt von", "ansprechpartner", "ansprechpartnerin", "kontakt", "zu händen", "zu händen von", "z. hd",
    "im auftrag von", "vertreten durch", "erstellt von", "geprüft von", "verfasst von", "genehmigt von", "gesprochen mit", "erklärung von", "unterschrift von", "wenden sie sich an",
    "inventeur", "inventrice", "signé", "signé par", "contacter", "à l'attention de", "représenté par", "représentée par", "rédigé par", "vérifié par", "approuvé par", "déclaration de",
    "signature de", "au nom de", "inventora", "firmado", "firmado por", "contacto", "a la atención de", "representado por", "representada por", "redactado por", "revisado por", "aprobado por",
    "declaración de", "firma de", "en nombre de", "assinado por", "contato", "ao cuidado de", "redigido por", "revisto por", "aprovado por", "declaração de", "em nome de",
    "inventore", "firmato", "firmato da", "contattare", "contatto", "all'attenzione di", "rappresentato da", "rappresentata da", "redatto da", "verificato da", "approvato da", "dichiarazione di",
    "per conto di", "uitvinder", "ondertekend", "ondertekend door", "contactpersoon", "ter attentie van", "t.a.v", "vertegenwoordigd door", "opgesteld door", "goedgekeurd door", "verklaring van",
    "namens", "изобретатель", "подписал", "подписала", "контактное лицо", "вниманию", "в лице", "составил", "составила", "утвердил", "утвердила", "заявление", "от имени",
)
STREETS_EN = "street road lane avenue crescent drive close court place terrace row square gardens way grove hill mews parade walk boulevard"
STREETS_DE = "straße strasse weg gasse allee platz ring ufer damm stieg pfad"
STREETS_FR = "rue avenue boulevard impasse place allée chemin quai cours passage route square"
STREETS_ES = "calle avenida plaza paseo camino carrera travesía travesia ronda glorieta callejón"
STREETS_IT = "via viale piazza corso largo vicolo rua praça travessa alameda"
STREETS_NL = "straat laan weg plein gracht kade dijk singel"
STREETS_RU = "ул. улица проспект пр. переулок пер. площадь бульвар"
COMPANY = "ltd limited inc gmbh ag sa plc llc bv co corp university institute laboratories hospital buffer reagent"
_TITLE_SET, _COMPANY_SET = set(TITLES.split()), set(COMPANY.split())
_CUE_KINDS = {w: tuple(i for i, v in enumerate(CUES.values()) if w in v.split()) for v in CUES.values() for w in v.split()}
_TITLE_ANY = "|".join(sorted((re.escape(t) for t in TITLES.split() if len(t) > 1), key=len, reverse=True))
_ROLE_ANY = "|".join(sorted(map(re.escape, ROLES), key=len, reverse=True))

_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_EAST = "\u3005-\u3007\u3040-\u30ff\u3400-\u9fff"
#: Nothing, or a character of a script that writes no blanks between words.
_BARE = rf"(?<![^\W{_EAST}])"
_AT = r"(?:@|＠|\s?[(\[]\s?at\s?[)\]]\s?)"
_DOT = r"(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?|\sdot\s)"
EMAIL = re.compile(rf"[A-Za-zÀ-ÿ0-9_+%-][A-Za-zÀ-ÿ0-9_.+%-]*(?:{_AT}[A-Za-zÀ-ÿ0-9_-]+(?:{_DOT}[A-Za-zÀ-ÿ0-9_-]+)+|\sat\s[A-Za-z0-9_-]+(?:\sdot\s[A-Za-z0-9_-]+)+)", re.I)
#: Runs of what numbers and codes consist of; these are looked for nowhere else.
_DIGITS = re.compile(r"[A-Z\d+(][A-Z\d .,()/+-]{5,}")
NUMBER = re.compile(rf"{_BARE}(?<![.,/+-])(?:\+|\(\+?)?\d(?:[\d ()/-]|\.(?=\d)){{5,}}\d(?![^\W{_EAST}]|/|[.,-]\d)")
CODE = re.compile(
    rf"{_BARE}(?<![.,/-])(?=[A-Z\d .-]*\d)(?:[A-Z]{{1,3}}[ -]?)?\d[A-Z\d]*(?:[ .-](?:[A-Z]{{0,2}}\d[A-Z\d]*|[A-Z]{{1,2}}))*(?![^\W{_EAST}]|/|-\d)"
    rf"|{_BARE}(?<![.,/-])[A-Z]{{1,6}}\d[A-Z\d]{{5,}}(?![^\W{_EAST}]|/)"
)
_CAP = rf"[{_UPPER}][\w'’-]*"
_CITY_WORD = rf"[{_UPPER}][^\W\d_]+(?:[-'’][^\W\d_]+)*(?![\w-])"
_CITY = rf"(?:{_CITY_WORD}(?: {_CITY_WORD}){{0,2}})"
_BREAK = r"(?:, ?\n?|\s?\n)"
_TAIL = rf"(?:(?:{_BREAK}| )(?:[A-Z]{{1,2}}-)?\d{{4,5}}(?:-\d{{3}}| [A-Z]{{2}}\b)? {_CITY}|{_BREAK}{_CITY}(?:,? \d{{4,5}}(?![\w-]))?)?"


def _any(words: str) -> str:
    return "|".join(map(re.escape, dict.fromkeys(words.split())))


ADDRESS = re.compile(
    rf"(?<![\w-])(?:"
    rf"(?:(?i:flat|apartment|apt\.?|unit|suite) \d{{1,4}}[A-Za-z]?, )?\d{{1,4}}[A-Za-z]?,? (?:{_CAP} ){{1,3}}(?i:{_any(STREETS_EN)})\b{_TAIL}"
    rf"|(?:(?:(?i:am|an der|auf dem|im|in der|zum|zur|alte|alter|altes|neue|neuer|große|kleine|obere|untere|hintere|vordere) )?{_CAP}(?i:{_any(STREETS_DE + ' ' + STREETS_NL)})|(?:Am|Im|An der|Auf dem|In der|Zum|Zur|Alte|Neue|Alter|Neuer|AM|IM|ZUM|ZUR|ALTE) {_CAP}) \d{{1,4}}(?: ?[a-z]\b)?{_TAIL}"
    rf"|\d{{1,4}}(?: (?i:bis|ter|quater))?,? (?i:{_any(STREETS_FR)})(?: (?i:de la|de l'|des|de|du|d'|la|le|les))? ?{_CAP}(?: {_CAP}){{0,2}}?{_TAIL}"
    rf"|(?i:{_any(STREETS_ES + ' ' + STREETS_IT)})(?: (?i:de la|de los|de las|del|della|delle|dei|degli|di|da|das|dos|do|de))? {_CAP}(?: {_CAP})?,? (?:(?i:n\.?º|núm\.|nº|n\.) ?)?\d{{1,4}}(?:, \d{{1,2}}\.?º(?: [A-Z]\b)?)?{_TAIL}"
    rf"|(?i:{_any(STREETS_RU)}) ?{_CAP}(?: {_CAP})?, (?i:д\. ?|дом )?\d{{1,4}}[а-я]?(?:, (?i:кв\. ?|квартира )\d{{1,4}})?(?:, (?:\d{{6}}, )?(?i:г\. ?|город )?{_CITY})?"
    rf")"
)
#: Addresses of China and Japan, which blanks don't divide.
_HAN = "\u4e00-\u9fff"
_PLACE = rf"(?:(?![在于到至址为是住])[{_HAN}])"
EAST_ADDRESS = re.compile(
    rf"(?:{_PLACE}{{2,8}}?(?:省|市|区|县))*{_PLACE}{{1,8}}(?:路|街|大道|巷)\d{{1,5}}号(?:[{_HAN}]{{0,6}}\d{{1,4}}(?:室|楼|层|单元|号))?"
    rf"|(?:〒?\d{{3}}-\d{{4}}[ 　]?)?[{_HAN}]{{2,3}}[都道府県][{_EAST}]{{1,12}}?[市区町村][{_EAST}]{{0,12}}?\d{{1,4}}(?:(?:丁目|番地|番|号|-|－|−)\d{{0,4}}){{0,4}}"
)
_EAST_NAME = re.compile(rf"(?<![{_HAN}])[{_HAN}]{{2,4}}(?=(?:{'|'.join(HONORIFICS.split())}))|[\u30a1-\u30fa\u30fc]{{2,}}(?:・[\u30a1-\u30fa\u30fc]{{2,}})*(?=(?:さん|様|氏))")
_HAN_OR_KANA = re.compile(rf"[{_EAST}]")
_STREET = re.compile(
    rf"\b(?:{_any(STREETS_EN + ' ' + STREETS_FR + ' ' + STREETS_ES + ' ' + STREETS_IT + ' ' + STREETS_RU)})(?!\w)|(?:{_any(STREETS_DE + ' ' + STREETS_NL)})\b"
    rf"|\b(?:am|im|an der|auf dem|in der|zum|zur|alter?|neuer?) [{_UPPER}][\w-]+ \d",
    re.I,
)
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:['’-][^\W\d_]+)*\.?")
_ROLE = re.compile(rf"(?<!\w)(?:{_ROLE_ANY})$")


def _announced(before: str) -> bool:
    """Whether one of ROLES ends ``before``."""
    near = before.rstrip()
    if len(near) == len(before):
        return False
    near = near.rstrip(".:,").lower()
    return near.endswith(ROLES) and _ROLE.search(near) is not None


_AROUND = re.compile(r"[@＠]|\s?[(\[]\s?at\s?[)\]]", re.I)
_SPOKEN = re.compile(r"\sat\s(?=[A-Za-z0-9_-]+\sdot\s)", re.I)
_LOCAL = re.compile(r"[A-Za-zÀ-ÿ0-9_.+%-]")


def _mails(text: str) -> list[tuple[int, int]]:
    """E-mail addresses, tried only around their marks."""
    marks = [m.start() for m in _AROUND.finditer(text)]
    if " dot " in text or "dot" in text.lower():
        marks += [m.start() for m in _SPOKEN.finditer(text)]
    out: list[tuple[int, int]] = []
    for at in sorted(marks):
        start, least = at, out[-1][1] if out else 0
        while start > least and _LOCAL.match(text[start - 1]):
            start -= 1
        while start < at and text[start] == ".":
            start += 1
        if m := EMAIL.match(text, start):
            out.append(m.span())
    return out


@functools.cache
def _anchors(kind: str):
    """An Aho-Corasick automaton of the small-letter words that ``_STREET`` or ``_ANNOUNCED`` can start with."""
    import ahocorasick

    if kind == "street":
        words = [*" ".join((STREETS_EN, STREETS_FR, STREETS_ES, STREETS_IT, STREETS_RU, STREETS_DE, STREETS_NL)).split(), *"am |im |an der |auf dem |in der |zum |zur |alte |alter |neue |neuer ".split("|")]
    else:
        words = [f"{t}{end}" for t in TITLES.split() if len(t) > 1 for end in (" ", ". ")] + [f"{r}{end}" for r in ROLES for end in " \n.:,"]
    made = ahocorasick.Automaton()
    for word in words:
        made.add_word(word, len(word))
    made.make_automaton()
    return made


def _anchored(pattern: re.Pattern, kind: str, text: str) -> Iterator[re.Match]:
    """The matches of ``pattern``, tried only where one of its words stands; those of ``finditer``."""
    low = text.lower()
    if len(low) != len(text):
        yield from pattern.finditer(text)
        return
    end = 0
    for start in sorted({at - n + 1 for at, n in _anchors(kind).iter(low)}):
        if start >= end and (m := pattern.match(text, start)):
            yield m
            end = m.end()


def fold(word: str) -> str:
    if word.isascii():
        return word.lower().rstrip(".")
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c)).rstrip(".")


def _starts(text: str, at: int) -> bool:
    """Whether a sentence or line starts at ``at``."""
    i = at - 1
    while i >= 0 and text[i] in " \t\"'([":
        i -= 1
    return i < 0 or text[i] in ".!?\n。>"


_CAPITAL = re.compile(rf"(?<![\w@.+-])[{_UPPER}][^\W\d_]+(?![\w@])")
_SMALL = re.compile(rf"(?<![\w@.+-])[{_LOWER}][^\W\d_]+(?![\w@])")
_OPENING = re.compile(rf"[.!?\n。>][ \t\"'(\[]*([{_UPPER}][^\W\d_]+)")
_NAME = rf"(?:[{_UPPER}]\. )?[{_UPPER}][^\W\d_]+(?:-[{_UPPER}][^\W\d_]+)*"
_ANNOUNCED = re.compile(rf"(?<!\w)(?:(?i:{_TITLE_ANY})\.? |(?i:{_ROLE_ANY})[.:,]?\s+)(?:(?i:{_TITLE_ANY})\.? )*({_NAME})(?:(,? )(?:[{_UPPER}]\. )?({_NAME}))?")


def evidence(text: str) -> dict[str, list[int]]:
    """Per word: places that only names have, capital and small places, and starts of sentences.

    ``text`` may be several texts with line breaks between them.
    """
    counts: dict[str, list[int]] = {}

    def add(found: Counter, at: int) -> None:
        for word, n in found.items():
            key = fold(word)
            own = counts.get(key)
            if own is None:
                own = counts[key] = [0, 0, 0, 0]
            own[at] += n

    # Words don't reach over blanks, so that each different piece between blanks is looked at once.
    capital, small = Counter(), Counter()
    for piece, n in Counter(text.split()).items():
        for word in _CAPITAL.findall(piece):
            capital[word] += n
        for word in _SMALL.findall(piece):
            small[word] += n
    add(capital, 1)
    add(small, 2)
    add(Counter(_OPENING.findall("\n" + text)), 3)
    strong: Counter = Counter()

    def name(words: str) -> None:
        for part in re.split(r"[ -]", words):
            if len(part.rstrip(".")) > 1 and fold(part) not in _TITLE_SET:
                strong[part] += 1

    for m in _anchored(_ANNOUNCED, "announced", text):
        name(m.group(1))
        if m.group(3) and not (m.group(2) == ", " and " " in m.group(1)):
            name(m.group(3))
    for start, end in _mails(text):
        local = fold(re.split(_AT, text[start:end], maxsplit=1)[0])
        for low, high in ((max(0, start - 80), start), (end, end + 80)):
            window = [(w.start() + low, w.end() + low, w.group()) for w in _CAPITAL.finditer(text[low:high])]
            for i, (s, e, word) in enumerate(window):
                key = fold(word)
                if len(key) < 4 or key not in local:
                    continue
                strong[word] += 1
                for j in (i - 1, i + 1):
                    if 0 <= j < len(window):
                        s2, e2, other = window[j]
                        gap = text[e2:s] if j < i else text[e:s2]
                        if gap == " " and fold(other) not in local and fold(other) not in _TITLE_SET and not (j < i and _starts(text, s2)):
                            strong[other] += 1
    add(strong, 0)
    return counts


class Lexicon:
    """What the corpus says about words: name rate, small-letter rate and sentence-start rate."""

    def __init__(self, rows: dict[str, tuple[int, int, int, int]]):
        self.rows = rows
        #: Words beyond ``rows`` that the texts at hand hold.
        self.rest: dict[str, tuple[int, int, int, int]] = {}
        self.known: dict[str, bool] = {}
        self.pieces: dict[str, tuple[str, ...]] = {}

    def name_like(self, word: str) -> bool:
        """Whether a word may be part of a person's name; remembered, within bounds."""
        answer = self.known.get(word)
        if answer is None:
            if len(self.known) > 300_000:
                self.known.clear()
            name, small, _ = self.rates(word)
            answer = self.known[word] = fold(word) not in _TITLE_SET and (name > 0.05 if word[0].isupper() else name > 0.2) and small < 0.5
        return answer

    def names_in(self, piece: str) -> tuple[str, ...]:
        """The words of a piece of text without blanks that may be parts of names; remembered, within bounds."""
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) > 300_000:
                self.pieces.clear()
            words = [w.rstrip(".") for w in _WORD.findall(piece) if len(w) > 2]
            found = self.pieces[piece] = tuple(w for w in words if self.name_like(w))
        return found

    def rates(self, word: str) -> tuple[float, float, float]:
        """Of a hyphenated word, the least name-like part counts."""
        best = (1.0, 0.0, 0.0)
        for part in fold(word).split("-"):
            strong, capital, small, start = self.rows.get(part) or self.rest.get(part, (0, 0, 0, 0))
            mine = (strong / (capital + 1.0), small / (capital + small + 1.0), start / (capital + 1.0))
            if mine[0] <= best[0]:
                best = mine
        return best


def _trimmed(text: str, start: int, end: int, lexicon: Lexicon) -> int:
    """``end`` without capital words that open the next sentence, which may follow without a stop."""
    run = re.search(rf"{_CAP}(?: {_CAP})+$", text[start:end])
    if run:
        at = start + run.start()
        for i, w in enumerate(re.finditer(r"\S+", run.group())):
            name, _, opening = lexicon.rates(w.group())
            if i and (fold(w.group()) in _TITLE_SET or (opening > 0.6 and name < 0.2)):
                end = at + w.start() - 1
                break
    while True:
        m = re.search(r"[ \n]+([^\W\d_][\w'’-]*)$", text[start:end])
        if not m or not m.group(1)[0].isupper() or m.group(1).isupper():
            return end
        name, _, opening = lexicon.rates(m.group(1))
        goes_on = re.match(r"[ ,]+[^\W\d_]", text[end : end + 4])
        if fold(m.group(1)) in _TITLE_SET or (opening > 0.4 and name < 0.2 and goes_on) or (opening > 0.8 and name < 0.05):
            end = start + m.start()
            while text[end - 1] in ", \n":
                end -= 1
        else:
            return end


def _near(text: str, words: set[str]) -> list[tuple[int, int]]:
    """Stretches of ``text`` around the places of ``words``, as wide as a run of initials may reach."""
    places = []
    for word in words:
        at = text.find(word)
        while at >= 0:
            places.append((max(0, at - 40), at + len(word) + 40))
            at = text.find(word, at + len(word))
    out: list[list[int]] = []
    for a, b in sorted(places):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            # From a blank to a blank, so that no word is cut.
            out.append([text.rfind(" ", 0, a) + 1, b])
    return [(a, end if (end := text.find(" ", b)) >= 0 else len(text)) for a, b in out]


def _names(text: str, lexicon: Lexicon, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of name-like words: given names, initials and surnames in either order."""
    remembered = lexicon.pieces
    known = {w for piece in set(text.split()) for w in (remembered[piece] if piece in remembered else lexicon.names_in(piece))}
    if not known:
        return []
    tokens, last = [], 0
    for low, high in _near(text, known):
        for m in _WORD.finditer(text, max(low, last), high):
            w = m.group()
            s, e = m.span()
            last = e
            short = len(w) == 1 or (len(w) == 2 and w[1] == ".")
            if not short and w.rstrip(".") not in known:
                continue
            if any(a <= s < b for a, b in taken):
                continue
            if short:
                if len(w) == 2 or w.isupper():
                    tokens.append((s, e, "i"))
                continue
            tokens.append((s, e - w.endswith("."), "n"))
    runs: list[list[tuple[int, int, str]]] = []
    for t in tokens:
        if runs and text[runs[-1][-1][1] : t[0]] in (" ", "  ", "\xa0"):
            runs[-1].append(t)
        else:
            runs.append([t])
    out = []
    i = 0
    while i < len(runs):
        run = runs[i]
        words = [t for t in run if t[2] == "n"]
        if not words:
            i += 1
            continue
        s, e = run[0][0], run[-1][1]
        # "Surname, Given": one word, a comma, one given name with or without initials.
        if len(run) == 1 and i + 1 < len(runs) and text[e : runs[i + 1][0][0]] == ", ":
            nxt = runs[i + 1]
            if sum(t[2] == "n" for t in nxt) == 1 and nxt[0][2] == "n":
                out.append((s, nxt[-1][1]))
                i += 2
                continue
        out.append((s, e))
        i += 1
    return out


_START = re.compile(r"(?<![\w-])\w")
#: Words in front of a street word that an address may begin with: a flat, its number, a house number, articles and names.
WORDS_BEFORE = 9


def _addresses(text: str, lexicon: Lexicon) -> list[tuple[int, int]]:
    """Postal addresses, tried at every word from a few in front of a street word on; they may be of any length."""
    out: list[tuple[int, int]] = []
    end = 0
    for hit in _anchored(_STREET, "street", text):
        if hit.start() < end:
            continue
        low = hit.start()
        for _ in range(WORDS_BEFORE):
            low = max(text.rfind(" ", 0, max(0, low - 1)), text.rfind("\n", 0, max(0, low - 1))) + 1
            if not low:
                break
        at = max(low, end)
        while (start := _START.search(text, at)) and start.start() <= hit.end():
            m = ADDRESS.match(text, start.start())
            if not m:
                at = start.end()
                continue
            at = m.end()
            e = _trimmed(text, m.start(), m.end(), lexicon)
            if e > hit.start():
                out.append((m.start(), e))
                end = max(end, e)
    return out


def candidates(text: str, lexicon: Lexicon) -> list[tuple[int, int, int]]:
    """Overlapping ``(start, end, kind)`` proposals, kind by its number in KINDS."""
    out: list[tuple[int, int, int]] = []
    mails = _mails(text)
    out += [(s, e, 0) for s, e in mails]
    digits = False
    for run in _DIGITS.finditer(text):
        digits = True
        low, high = run.start(), min(len(text), run.end() + 2)
        for m in NUMBER.finditer(text, low, high):
            s, e = m.span()
            n = sum(c.isdigit() for c in m.group())
            if text[s] == "(" and text.count(")", s, e) < text.count("(", s, e):
                s += 1
            if n >= 7:
                out.append((s, e, 1))
                out.append((s, e, 2))
        for m in CODE.finditer(text, low, high):
            n = sum(c.isalnum() for c in m.group())
            if n >= 7 and any(c.isalpha() for c in m.group()):
                out.append((*m.span(), 2))
    east = _HAN_OR_KANA.search(text) is not None
    if digits or _DIGIT.search(text):
        out += [(s, e, 3) for s, e in _addresses(text, lexicon)]
        if east:
            out += [(*m.span(), 3) for m in EAST_ADDRESS.finditer(text)]
    if east:
        out += [(*m.span(), 4) for m in _EAST_NAME.finditer(text)]
    out += [(s, e, 4) for s, e in _names(text, lexicon, mails)]
    return sorted(set(out))


_DIGIT = re.compile(r"\d")
_GROUPS = re.compile(r"\d+")
_POSTCODE = re.compile(r"\d{4,5}")


def _cue_distances(words: list[tuple[int, str]], at: int) -> list[float]:
    """How far, in characters, the nearest cue of each kind lies in front; 99 if there is none."""
    out = [99.0] * len(CUES)
    for start, word in words:
        for k in _CUE_KINDS.get(word, ()):
            out[k] = min(out[k], float(at - start))
    return out


def features(text: str, span: tuple[int, int, int], lexicon: Lexicon, mails: list[tuple[int, int]]) -> list[float]:
    """Format and context of a proposed span; ``mails`` are the e-mail addresses of the text."""
    s, e, kind = span
    item = text[s:e]
    groups = [len(g) for g in _GROUPS.findall(item)] or [0]
    before = text[max(0, s - 70) : s]
    cut = max(before.rfind(". "), before.rfind("\n"))
    near = before[cut + 1 :] if cut >= 0 else before
    base = s - len(near)
    words = [(base + m.start(), fold(m.group())) for m in _WORD.finditer(near)]
    words += [(p, w.split("'")[-1]) for p, w in words if "'" in w]
    if not near.isascii() and _HAN_OR_KANA.search(near):
        words += [(base + i, near[i : i + n]) for i in range(len(near)) for n in (2, 3)]
    after = text[e : e + 3]
    previous = fold(near.rstrip().rsplit(None, 1)[-1]) if near.strip() else ""
    following = _WORD.match(text, e + 1) if after[:1] == " " else None
    tokens = [w for w in _WORD.findall(item) if len(w.rstrip(".")) > 1] if kind == 4 else []
    rates = [lexicon.rates(w) for w in tokens] or [(0.0, 0.0, 0.0)]
    return [
        float(kind),
        float(sum(groups)),
        float(len(groups)),
        float(groups[0]),
        float(groups[1] if len(groups) > 1 else 0),
        float(groups[-1]),
        float(max(groups)),
        float(sum(c.isalpha() for c in item)),
        float(len(item)),
        float(item[:1] == "+") + 2.0 * (item[:2] == "00") + 3.0 * (item[:1] == "0" and item[:2] != "00") + 4.0 * (item[:1] == "("),
        float("/" in item),
        float("." in item),
        float("-" in item),
        float("(" in item),
        *_cue_distances(words, s),
        float(previous in _TITLE_SET),
        float(kind == 4 and _announced(before)),
        min(r[0] for r in rates),
        max(r[0] for r in rates),
        max(r[1] for r in rates),
        float(len(tokens)),
        float(item.isupper()) + 2.0 * float(item.islower()),
        float(bool(following) and fold(following.group()) in _COMPANY_SET),
        float(kind == 3 and bool(_POSTCODE.search(item))),
        float(item.count(",")),
        float(any(a < e + 70 and b > s - 60 and (a, b) != (s, e) for a, b in mails)),
        float(kind == 4 and text.startswith(tuple(HONORIFICS.split()), e)),
    ]


def described(text: str, lexicon: Lexicon) -> tuple[list[tuple[int, int, int]], list[list[float]]]:
    """The proposed spans of a text and their features."""
    spans = candidates(text, lexicon)
    mails = [(s, e) for s, e, kind in spans if kind == 0]
    return spans, [features(text, c, lexicon, mails) for c in spans]


class Finder:
    """Finds spans with the trees of each kind, thresholds per kind and a corpus lexicon."""

    def __init__(self, trees: tuple[Boosted, ...], thresholds: list[float], lexicon: Lexicon):
        self.trees, self.thresholds, self.lexicon = trees, thresholds, lexicon

    def find(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        made = [described(t, self.lexicon) for t in texts]
        spans, rows = [m[0] for m in made], [r for m in made for r in m[1]]
        x = np.array(rows or [[]], np.float64)
        sure = np.zeros(len(rows))
        for kind, trees in enumerate(self.trees if rows else ()):
            if len(own := np.flatnonzero(x[:, 0] == kind)):
                sure[own] = trees.probability(x[own])
        out, at = [], 0
        for own in spans:
            scored = sorted(((float(p), c) for p, c in zip(sure[at : at + len(own)], own)), key=lambda x: (-round(x[0], 2), -(x[1][1] - x[1][0]), x[1]))
            at += len(own)
            kept: list[tuple[int, int, str]] = []
            for p, (s, e, kind) in scored:
                if p >= self.thresholds[kind] and not any(s < b and a < e for a, b, _ in kept):
                    kept.append((s, e, KINDS[kind]))
            out.append(sorted(kept))
        return out


def lexicon_of(df: DataFrame, text: str) -> DataFrame:
    """``word``, ``strong``, ``capital``, ``small``, ``opening``: counts over all documents of all words that matter.

    Counts are combined in each partition first. Words that never stand where only names stand and
    hardly open sentences don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list[int]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                for word, c in evidence("\n".join(batch.column(0).slice(at, 200).to_pylist())).items():
                    own = total.setdefault(word, [0, 0, 0, 0])
                    for i in range(4):
                        own[i] += c[i]
            if len(total) > 200_000:
                yield _counts(total)
                total = {}
        yield _counts(total)

    schema = "word string, strong long, capital long, small long, opening long"
    counted = df.select(F.col(f"`{text}`").alias("text")).where("length(text) > 0").mapInArrow(run, schema)
    summed = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("strong", "capital", "small", "opening")])
    return summed.where("strong > 0 OR opening > 1")


def _counts(total: dict[str, list[int]]) -> pa.RecordBatch:
    columns = list(zip(*total.values())) if total else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names=["word", "strong", "capital", "small", "opening"])


#: Bits of the filter that tells which words may have evidence beyond the cache.
FILTER_BITS = 1 << 23
_COUNTS = ("strong", "capital", "small", "opening")


def _filter_of(words: DataFrame) -> np.ndarray:
    """A filter of FILTER_BITS bits with one set for each word, by its hash."""
    bit = F.pmod(F.xxhash64("word"), F.lit(FILTER_BITS))
    # At most FILTER_BITS / 32 rows.
    rows = words.groupBy(F.floor(bit / 32).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(pmod(xxhash64(word), {FILTER_BITS}), 32) AS INT))")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out


def _may_hold(bits: np.ndarray, word: str) -> bool:
    at = (xxhash.xxh64_intdigest(word.encode(), 42) - (1 << 64)) % FILTER_BITS
    return bool(bits[at >> 5] >> (at & 31) & 1)


def _with_rest(source: DataFrame, rest: DataFrame) -> DataFrame:
    """``source`` (``k``, ``t``) with ``rest``: the evidence on those words of each text that ``rest`` has.

    Texts ask for the words that pass a filter of fixed size; the evidence is joined by word and
    brought back by the hash of the text, so that equal texts ask once. Equal hashes of different
    texts only bring a text words that it doesn't hold.
    """
    shared = source.sparkSession.sparkContext.broadcast(_filter_of(rest))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            hashes, words = [], []
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {part for w in set(_WORD.findall(t)) for part in fold(w).split("-") if _may_hold(bits, part)}
                hashes += [h] * len(own)
                words += sorted(own)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(words, pa.string())], names=["h", "word"])

    asked = source.where("length(t) > 0").select(F.xxhash64("t").alias("h"), "t").mapInArrow(ask, "h long, word string").distinct()
    answers = asked.join(rest, "word").groupBy("h").agg(F.collect_list(F.struct("word", *_COUNTS)).alias("rest"))
    return source.withColumn("h", F.xxhash64("t")).join(answers, "h", "left").drop("h")


def found(df: DataFrame, key: str, text: str, trees: tuple[Boosted, ...], thresholds: tuple[float, ...], cached: int = LEXICON_WORDS) -> DataFrame:
    """``key``, ``spans`` and ``redacted`` of every row.

    ``spans`` is an array of (start_pos, end_pos, pii_kind) in order, positions in code points;
    ``redacted`` is the text with ``[KIND]`` in place of each span and otherwise unchanged. Null
    texts have null, empty and blank ones no spans. Whole texts are searched, however long, with
    the evidence of all documents on all of their words; how many of these are ``cached`` by the
    workers changes no result.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    lexicon = lexicon_of(df, text).checkpoint()
    order = [F.desc("strong"), F.desc("opening"), F.col("word")]
    top = lexicon.orderBy(*order).limit(cached + 1).collect()
    shared = spark.sparkContext.broadcast((trees, thresholds, {r["word"]: tuple(r[c] for c in _COUNTS) for r in top[:cached]}))
    source = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    if len(top) > cached:
        last = top[cached]
        rank = F.struct(-F.col("strong"), -F.col("opening"), F.col("word"))
        source = _with_rest(source, lexicon.where(rank >= F.struct(F.lit(-last["strong"]).cast("long"), F.lit(-last["opening"]).cast("long"), F.lit(last["word"]))))
    else:
        source = source.withColumn("rest", F.lit(None).cast("array<struct<word:string,strong:bigint,capital:bigint,small:bigint,opening:bigint>>"))
    kind = pa.list_(pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32()), ("pii_kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, thresholds, rows = shared.value
        own = Finder(trees, list(thresholds), Lexicon(rows))
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                texts = part.column(1).to_pylist()
                own.lexicon.rest = {x["word"]: tuple(x[c] for c in _COUNTS) for held in part.column(2).to_pylist() for x in held or ()}
                spans = own.find([t or "" for t in texts])
                redacted = [None if t is None else redact(t, s) for t, s in zip(texts, spans)]
                lists = [None if t is None else [dict(zip(("start_pos", "end_pos", "pii_kind"), x)) for x in s] for t, s in zip(texts, spans)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, kind), pa.array(redacted, pa.string())], names=["k", "spans", "redacted"])

    schema = f"k {source.schema['k'].dataType.simpleString()}, spans array<struct<start_pos:int,end_pos:int,pii_kind:string>>, redacted string"
    return source.select("k", "t", "rest").mapInArrow(run, schema).withColumnRenamed("k", key)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with a typed placeholder in place of each span."""
    out, at = [], 0
    for s, e, kind in spans:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]
