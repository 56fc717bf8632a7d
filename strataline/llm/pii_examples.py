"""Written examples with known personal information, and the trees trained on them.

The sentences are ordinary ones of letters, forms, minutes and reports, written for this purpose in
ten languages; none is taken from a text that is searched. Names, places and numbers are invented by
rules from a seed, so the same trees come out on every run and the trees can know no real name.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np

from strataline.llm.boosting import Boosted, boost
from strataline.llm.pii import KINDS, STREETS_EN, Lexicon, described, fold

# Sentences with slots. P person, S surname alone, E e-mail, T telephone, I identity number, A address, N other number, C company or product word, K legal form, L street word, M measure.
SENTENCES = {
    "en": """Dear {P}, thank you for your letter of last week.
Dear Mr. {S}, we confirm the appointment.
Mrs {S} opened the meeting at nine.
According to Dr. {P} the result was repeated twice.
Present: {P}, {P}, {P}.
Minutes taken by {P} and approved by {P}.
{P} joined the team in spring. {P} retired a year later.
After {P} had spoken, the floor went to {P}.
My colleague {P} will take over from Monday.
The parcel was handed to {P} at the gate.
{P} ({E})
{P} <{E}>
To: {P} <{E}>; {P} <{E}>
From: {E}
You can write to {E} at any time.
Questions? {E} or {T}.
Tel. {T}, fax {T}
Our switchboard is {T}, the direct line {T}.
Mobile: {T}
{T} is the number of the porter.
{P}, phone {T}, e-mail {E}
{P} | {T} | {E}
{P} / {E} / {T}
Please ring {P} on {T} after lunch.
Home address: {A}.
We moved to {A} in May.
{P} of {A} is named as the owner.
{P}, {A}
Goods were shipped to {P}, {A} and paid for.
He lives at {A} with his family.
Return to sender: {A}
All mail for {P} goes to {A}.
The address of {P} is {A}.
Please ship the boxes and deliver the invoice to {P} at {A}.
Passport no. {I}, issued last year.
Social security number: {I}
Insurance number {I} was given by {P}.
{P}, born in the north, card {I}.
ID {I}, {P}.
The application names passport {I}; the order quotes licence {I}.
Name and number: {P}, {I}
{P} ({I})
Driving licence {I} and phone {T} were noted.
The form asks for a national number; hers is {I}.
Signed in the presence of {P}, {A}, holder of passport {I}.
Purchase order {N} was cancelled.
See application {N} and publication {N}.
Article {N} is out of stock; use {N} instead.
Sample {N} from batch {N} failed.
Model {N}, part number {N}, version {N}.
The catalogue lists {N} and {N}; order code {N}.
It was sold as lot {N}. Claim {M} cites reference {N}.
The invoice {N} covers {M} boxes at {M} each.
Sequence {N} differs in {M} positions.
{C} {K} delivered on time, {C} {C} did not.
The {C} device of {C} {K} was tested for {M} days.
{C} {L} is a brand, and so is {C}.
At {M} degrees the {C} column gave {M} units per hour.
Figure {M} shows what Table {M} says. In {M} of {M} cases nothing changed.""",
    "de": """Sehr geehrte Frau {S}, vielen Dank für Ihre Nachricht.
Sehr geehrter Herr Dr. {P}, anbei die Rechnung.
Anwesend waren {P}, {P} und {P}.
Protokoll: {P}, genehmigt von {P}.
Herr {S} leitet die Gruppe seit Mai.
Nach {P} übernahm {P} den Vorsitz.
Das Paket wurde {P} übergeben.
{P} ({E}), {T}
Ansprechpartner ist {P}, erreichbar unter {T} oder {E}.
Tel.: {T}, Fax: {T}, Mail: {E}
{P} | {T} | {E}
{P}, {E}, {T}
Schreiben Sie an {E} oder rufen Sie {T} an.
Meine Handynummer lautet {T}.
Unsere neue Anschrift: {A}.
{P}, {A}
Frau {P}, wohnhaft {A}, ist Eigentümerin.
Die Ware ging an {P}, {A}.
Rücksendung an: {A}
Bitte liefern Sie den Schrank an {P}, {A}.
Die Adresse von {P} lautet {A}.
Personalausweis {I}, ausgestellt im Mai.
Name und Nummer: {P}, {I}
Steuer-ID: {I}
Im Aktenzeichen fehlt der Ausweis {I}.
Die Sozialversicherung führt sie unter {I}.
Reisepass {I} von {P} liegt vor.
Bestellung {N} wurde storniert, Artikel {N} fehlt.
Siehe Anmeldung {N} und Anlage {N}.
Artikelnummer {N}, Charge {N}, Aktenzeichen {N}.
{C} {K} liefert, {C} {C} prüft.
Bei {M} Grad ergaben sich {M} Einheiten aus {C}.""",
    "fr": """Chère Madame {S}, je vous remercie de votre courrier.
Monsieur {P} a pris la parole.
Étaient présents : {P}, {P} et {P}.
Compte rendu rédigé par {P} et approuvé par {P}.
Après {P}, la direction est revenue à {P}.
Le colis a été remis à {P}.
{P} ({E})
{P}, tél. {T}, {E}
{P} | {T} | {E}
Écrivez à {E} ou appelez le {T}.
Mon portable : {T}, bureau : {T}
Notre nouvelle adresse : {A}.
{P}, {A}
Mme {P}, demeurant {A}, est propriétaire.
Les livres sont partis chez {P}, {A}.
L'adresse de {P} : {A}
Livrer la table à {P}, {A}.
Carte d'identité {I}, délivrée en mai.
Nom et numéro : {P}, {I}
Numéro de sécurité sociale : {I}
Dans le dossier figure la carte d'identité {I}.
La demande cite l'identité {I}.
Passeport {I} au nom de {P}.
La commande {N} est annulée ; voir le dossier {N}.
La référence {N} remplace {N}.
Lot {N}, demande {N}, dossier {N}.
{C} {K} livre, {C} {C} contrôle.
À {M} degrés, {C} donne {M} unités.""",
    "es": """Estimada señora {S}: gracias por su carta.
El señor {P} abrió la sesión.
Asistieron {P}, {P} y {P}.
Acta redactada por {P} y aprobada por {P}.
Tras {P}, la presidencia pasó a {P}.
El paquete se entregó a {P}.
{P} ({E})
{P}, tel. {T}, {E}
{P} | {T} | {E}
Escriba a {E} o llame al {T}.
Mi móvil es el {T}.
Nueva dirección: {A}.
{P}, {A}
Doña {P}, con domicilio en {A}, es la dueña.
Los libros se mandaron a {P}, {A}.
La dirección de {P} es {A}.
Hay que enviar la mesa a {P}, {A}.
Documento de identidad {I}, expedido en mayo.
Nombre y número: {P}, {I}
DNI: {I}
En el expediente consta la identidad {I}.
Pasaporte {I} a nombre de {P}.
El pedido {N} fue anulado; véase el expediente {N}.
La referencia {N} sustituye a {N}.
Lote {N}, solicitud {N}, número {N}.
{C} {K} entrega, {C} {C} revisa.
A {M} grados, {C} dio {M} unidades.""",
    "pt": """Prezada senhora {S}, obrigado pela carta.
O senhor {P} abriu a sessão. Estiveram presentes {P} e {P}.
Ata redigida por {P}.
{P}, tel. {T}, {E}
Escreva para {E} ou ligue para {T}.
Nova morada: {A}.
A senhora {P}, residente em {A}, é a dona.
Documento de identificação {I} de {P}. Contribuinte: {I}
A encomenda {N} foi anulada; ver o processo {N}.
{C} {K} entrega, {C} {C} verifica {M} caixas.""",
    "it": """Gentile signora {S}, grazie della lettera.
Il signor {P} ha aperto la seduta. Erano presenti {P} e {P}.
Verbale redatto da {P}.
{P}, tel. {T}, {E}
Scrivere a {E} o chiamare il {T}.
Nuovo indirizzo: {A}.
La signora {P}, residente in {A}, è la proprietaria.
Carta d'identità {I} di {P}. Codice fiscale: {I}
L'ordine {N} è annullato; vedi la pratica {N}.
{C} {K} consegna, {C} {C} controlla {M} scatole.""",
    "nl": """Geachte mevrouw {S}, dank voor uw brief.
De heer {P} opende de vergadering. Aanwezig waren {P} en {P}.
Verslag opgesteld door {P}.
{P}, tel. {T}, {E}
Schrijf naar {E} of bel {T}.
Nieuw adres: {A}.
Mevrouw {P}, wonende {A}, is eigenaar.
Identiteitskaart {I} van {P}. BSN: {I}
Bestelling {N} is geannuleerd; zie zaaknummer {N}.
{C} {K} levert, {C} {C} keurt {M} dozen.""",
    "ru": """Уважаемая госпожа {S}, благодарим за письмо.
Господин {P} открыл заседание. Присутствовали {P} и {P}.
Протокол составил {P}.
{P}, тел. {T}, {E}
Пишите на {E} или звоните {T}.
Новый адрес: {A}.
{P}, проживающий по адресу {A}, является владельцем.
Паспорт {I}, выдан в мае. ИНН {I}
Заказ {N} отменён, см. заявка {N}.
{C} поставляет, {C} проверяет {M} ящиков.""",
    "zh": """{P}先生您好，感谢来信。
会议由{P}教授主持，{P}女士记录。
联系电话：{T}，邮箱：{E}
请拨打手机{T}或发邮件至{E}。
新地址：{A}。
身份证{I}，护照{I}。
订单{N}已取消，见申请号{N}。
在{M}度下保持{M}小时。""",
    "ja": """{P}様、お手紙ありがとうございます。
会議は{P}さんが進めました。
電話：{T}、メール：{E}
携帯は{T}です。
新しい住所：{A}。
旅券{I}、マイナンバー{I}。
番号{N}の注文は取り消されました。
{M}度で{M}時間保ちました。""",
}
FILLERS = {
    "en": "The talks went on until evening. | No change was seen in the second group. | Rain is expected tomorrow. | Costs rose again.",
    "de": "Die Sitzung dauerte bis zum Abend. | Es gab keine Änderung. | Morgen wird Regen erwartet.",
    "fr": "La séance a duré jusqu'au soir. | Aucun changement n'est apparu.",
    "es": "La sesión duró hasta la noche. | No hubo cambios.",
    "pt": "A sessão durou até à noite. | Não houve mudanças.",
    "it": "La seduta è durata fino a sera. | Nessun cambiamento.",
    "nl": "De vergadering duurde tot de avond. | Er was geen verandering.",
    "ru": "Заседание длилось до вечера. | Изменений не было.",
    "zh": "会议持续到晚上。 | 没有变化。",
    "ja": "会議は夜まで続きました。 | 変化はありませんでした。",
}
#: How often a language is written in; the first have the most forms to learn.
WEIGHTS = {"en": 6, "de": 4, "fr": 4, "es": 4, "pt": 2, "it": 2, "nl": 2, "ru": 2, "zh": 1, "ja": 1}
_ONSETS, _NUCLEI, _CODAS = "b br d dr f g gl h j k kl l m n p pr r s st t tr v w z".split(), "a e i o u ei ou".split(), "n l r s t nd rk m ss".split()
_CYRILLIC = {"onsets": "б бр в г д др ж з к кр л м н п р с ст т тр х".split(), "nuclei": "а е и о у".split(), "codas": "н л р в ев ин ский ов".split()}
_HAN_FIRST, _HAN_NEXT = "王李张刘陈杨赵黄周吴田林森高", "明华伟芳丽军敏静强磊洋艳勇杰娟涛秀兰健一子"
_KATAKANA = "アイウエオカキクケコサシスセソタチツテトナニノハヒフホマミムメモラリルレロ"


class _Writer:
    """Writes examples from one seed."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.rates: dict[str, tuple[int, int, int, int]] = {}
        # Words that open sentences, as a corpus would show them.
        for opening in re.findall(r"(?:^|[.!?|] |\n)([^\W\d_]{2,})", "\n".join([*SENTENCES.values(), *FILLERS.values()])):
            n = self.r.randint(20, 900)
            self.rates[fold(opening)] = (0, n, int(n * self.r.uniform(0, 3)), int(n * self.r.uniform(0.7, 1)))

    def word(self, syllables: int, cyrillic: bool = False) -> str:
        r = self.r
        if cyrillic:
            return "".join(r.choice(_CYRILLIC["onsets"]) + r.choice(_CYRILLIC["nuclei"]) for _ in range(syllables)) + r.choice(_CYRILLIC["codas"])
        return "".join(r.choice(_ONSETS) + r.choice(_NUCLEI) for _ in range(syllables)) + r.choice(["", r.choice(_CODAS)])

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def shape(self, pattern: str) -> str:
        """Digits for 9, capitals for A, both for X."""
        put = {"9": "0123456789", "A": "ABCDEFGHKLMNPRSTVXYZ", "X": "0123456789ABCDEFGHKLMNPRSTVXYZ"}
        return "".join(self.r.choice(put[c]) if c in put else c for c in pattern)

    def name_word(self, syllables: int, cyrillic: bool = False) -> str:
        word = self.word(syllables, cyrillic).capitalize()
        n = self.r.randint(5, 400)
        self.rates[fold(word)] = (int(n * self.r.uniform(0.12, 0.95)), n, int(n * self.r.choice([0, 0, 0.02, 0.08])), int(n * self.r.uniform(0, 0.35)))
        return word

    def other_word(self, syllables: int, cyrillic: bool = False) -> str:
        word = self.word(syllables, cyrillic).capitalize()
        n = self.r.randint(5, 400)
        self.rates[fold(word)] = (int(n * self.r.choice([0, 0, 0, 0.01, 0.07])), n, int(n * self.r.choice([0, 0.1])), int(n * self.r.uniform(0, 0.2)))
        return word

    def person(self, lang: str) -> tuple[str, str, str]:
        r = self.r
        if lang in ("zh", "ja"):
            if lang == "ja" and r.random() < 0.3:
                text = "・".join("".join(r.choice(_KATAKANA) for _ in range(r.randint(2, 4))) for _ in range(2))
            else:
                text = r.choice(_HAN_FIRST) + "".join(r.choice(_HAN_NEXT) for _ in range(r.randint(1, 3 if lang == "ja" else 2)))
            return text, "", ""
        given, surname = self.name_word(2, lang == "ru"), self.name_word(r.choice([2, 3, 3]), lang == "ru")
        if r.random() < 0.1 and lang != "ru":
            surname += "-" + self.name_word(2)
        initial = r.choice("ABCDEFGHJKLMPRST")
        style = r.random()
        if style < 0.45:
            text = f"{given} {surname}"
        elif style < 0.6:
            text = f"{surname}, {given}"
        elif style < 0.7:
            text = f"{given[0]}. {surname}"
        elif style < 0.8:
            text = f"{given} {initial}. {surname}"
        elif style < 0.88:
            text = f"{surname.upper()} {given}"
        elif style < 0.95:
            text = (f"{given} {surname}" if r.random() < 0.6 else f"{given[0]}. {surname}").lower()
        else:
            text = surname
        return text, given, surname

    def email(self, given: str = "", surname: str = "") -> str:
        r = self.r
        given, surname = fold(given or self.word(2)), fold(surname or self.word(3)).split("-")[0]
        local = r.choice([f"{given}.{surname}", f"{given[0]}{surname}", surname, f"{surname}_{given[0]}", f"{given}{r.randint(1, 99)}", f"{given[0]}-{surname}", f"{given}.{surname}+ip"])
        parts = [*r.choice([[self.word(2)], ["mail", self.word(2)], ["dept", f"{self.word(2)}-{self.word(1)}"]]), r.choice(["com", "org", "net", "example", "test", "de", "fr", "es"])]
        style = r.random()
        if style < 0.7:
            text = f"{local}@{'.'.join(parts)}"
        elif style < 0.75:
            text = f"{local}＠{'.'.join(parts)}"
        elif style < 0.83:
            text = f"{local}(at){'.'.join(parts)}"
        elif style < 0.92:
            text = f"{local} [at] {' [dot] '.join(parts)}"
        else:
            text = f"{local} at {' dot '.join(parts)}"
        return text.upper() if r.random() < 0.06 else text

    def phone(self, lang: str) -> str:
        forms = {
            "en": "+44 (0)99 9999 9999|099 9999 9999|999.999.9999|999-999-9999|+44 9999 999 999|09999 999999|1 (999) 999 9999|+1 999 999 9999|+1-999-999-9999|(999) 999-9999|0044 99 9999 9999|+1 (999) 999-9999",
            "de": "+49 (0)99 99999-999|099 99999 999|0049 99 99999 999|099/99999999|+49 999 9999999|0999 999 99 99|(0999) 99 99 99",
            "fr": "09 99 99 99 99|09.99.99.99.99|09-99-99-99-99|+33 (0)9 99 99 99 99|+33 9 99 99 99 99|0033 9 99 99 99 99",
            "es": "+34 999 99 99 99|0034 999 99 99 99|+34-999-999999|999 99 99 99|999 999 999|(+34) 999 999 999",
            "pt": "+351 999 999 999|999 999 999|+55 99 99999-9999|(99) 9999-9999",
            "it": "+39 999 999 9999|099 9999999|999 9999999|0039 99 99999999",
            "nl": "+31 9 99 99 99 99|099-9999999|06-99999999|0031 99 999 9999",
            "ru": "+7 (999) 999-99-99|8 (999) 999-99-99|8-999-999-99-99|+7 999 999 99 99",
            "zh": "199 9999 9999|19999999999|099-99999999|+86 199 9999 9999",
            "ja": "099-9999-9999|09-9999-9999|+81-99-9999-9999|0999-99-9999",
        }
        return self.shape(self.r.choice(forms[lang].split("|")))

    def identity(self, lang: str) -> str:
        forms = {
            "en": "AA999999A|AA 99 99 99 A|A9999999|999-99-9999|999 99 9999|999999999|A99999999",
            "de": "A99A99A99|A999999999|99 99999 999 9|99999999999|AXXXXXXX9|99 999999 A 999",
            "fr": "999999999999999|9 99 99 99 999 999 99|99AA99999|9 99 99 99 999 999",
            "es": "99999999A|A-9999999-A|99.999.999-A|A9999999A|99999999-A|A-99999999",
            "pt": "999999999|999 999 999|999.999.999-99|99999999 9 AA9",
            "it": "AAAAAA99A99A999A|AA9999999|AA99999AA",
            "nl": "999999999|AAXXXXXX9|999.999.999",
            "ru": "99 99 999999|9999 999999|999999999999|999-999-999 99",
            "zh": "99999919999999999X|A99999999|999999199999999999",
            "ja": "AA9999999|9999 9999 9999|999999999999",
        }
        return self.shape(self.r.choice(forms[lang].split("|")))

    def number(self, lang: str) -> str:
        forms = {
            "en": "9999-99-9999|9999-999-999|0099-999-999|99/999,999|9999-9999|WO 9999/99999999|9999-99-99A99|AA-9999|AAA99|99.99|US 9999999 A9|EP9999999A9|99/999999",
            "de": "99 9999 999 999.9|999-99-999|AA-9999|9999/99-9|99 9999 999 999",
            "fr": "99-99-99-9|9999/9999|AA-9999|FR 9999999|99-99-99-99",
            "es": "99-99-99-9|9999/9999|AA-9999|P 999999999|99-99-99-99-9",
        }
        return self.shape(self.r.choice(forms.get(lang, forms["es"]).split("|")))

    def address(self, lang: str) -> str:
        r = self.r
        w = lambda: self.other_word(r.choice([2, 2, 3]), lang == "ru")
        han = lambda n: "".join(r.choice(_HAN_NEXT) for _ in range(n))
        if lang == "zh":
            return f"{r.choice(['', han(2) + '省'])}{han(2)}市{han(2)}区{han(2)}{r.choice('路街')}{r.randint(1, 900)}号{r.choice(['', f'{r.randint(1, 30)}室'])}"
        if lang == "ja":
            return f"{r.choice(['', '〒' + self.digits(3) + '-' + self.digits(4) + ' '])}{han(2)}{r.choice('都県府')}{han(2)}{r.choice('市区')}{han(2)}{r.randint(1, 9)}{r.choice(['丁目', '-'])}{r.randint(1, 30)}"
        city = w() + (" " + w() if r.random() < 0.35 else "")
        if lang == "en":
            text = f"{r.randint(1, 250)}{r.choice(['', '', 'A', 'B'])} {w()}{r.choice(['', ' ' + w()])} {r.choice(STREETS_EN.split()).capitalize()}"
            text = (f"Flat {r.randint(1, 40)}, " if r.random() < 0.25 else "") + text
            tail = r.choice(["", f", {city}", f", {city} {self.digits(5)}"])
        elif lang == "de":
            street = r.choice([self.other_word(2) + r.choice(["weg", "straße", "gasse", "allee"]), "Am " + w(), "Alte " + self.other_word(2) + "gasse", "Zum " + w()])
            text = f"{street} {r.randint(1, 250)}{r.choice(['', '', 'a', 'c'])}"
            tail = r.choice(["", f", {self.digits(5)} {city}", f", D-{self.digits(5)} {city}"])
        elif lang == "fr":
            text = f"{r.randint(1, 200)}{r.choice(['', ' bis'])}{r.choice(['', ','])} {r.choice(['rue des', 'rue', 'boulevard', 'impasse des', 'avenue de'])} {w()}{r.choice(['', '-' + w()])}"
            tail = r.choice([f", {self.digits(5)} {city}", f" {self.digits(5)} {city.upper()}"])
        elif lang == "ru":
            text = f"{r.choice(['ул. ', 'улица ', 'пр. '])}{w()}, {r.choice(['д. ', ''])}{r.randint(1, 200)}{r.choice(['', f', кв. {r.randint(1, 99)}'])}"
            tail = r.choice(["", f", г. {w()}", f", {self.digits(6)}, {w()}"])
        elif lang == "nl":
            text = f"{self.other_word(2)}{r.choice(['straat', 'laan', 'weg', 'plein', 'gracht'])} {r.randint(1, 250)}{r.choice(['', 'a'])}"
            tail = r.choice(["", f", {self.digits(4)} {self.shape('AA')} {w()}"])
        elif lang in ("pt", "it"):
            text = f"{r.choice(['Rua de', 'Rua', 'Avenida da', 'Travessa do'] if lang == 'pt' else ['Via', 'Via della', 'Viale', 'Piazza', 'Corso'])} {w()}{r.choice([' ', ', '])}{r.randint(1, 220)}"
            tail = r.choice(["", f", {city}", f", {self.digits(4)}-{self.digits(3)} {city}" if lang == "pt" else f", {self.digits(5)} {city}"])
        else:
            text = f"{r.choice(['Calle', 'Avenida de los', 'Plaza del', 'Paseo'])} {w()}{r.choice([' ', ' n.º ', ', '])}{r.randint(1, 220)}{r.choice(['', ', 2.º B'])}"
            tail = r.choice(["", f", {city}", f", {self.digits(5)} {city}"])
        return (text + tail).upper() if r.random() < 0.07 else text + tail

    def text(self) -> tuple[str, list[tuple[int, int, int]]]:
        """A text of a few sentences and its true spans."""
        r = self.r
        lang = r.choices(list(WEIGHTS), list(WEIGHTS.values()))[0]
        out, spans, at = [], [], 0
        for _ in range(r.randint(1, 4)):
            sentence = r.choice(SENTENCES[lang].split("\n") + FILLERS[lang].split(" | ")[:2])
            given = surname = ""
            for piece in re.split(r"(\{[A-Z]\})", sentence):
                kind = -1
                if piece == "{P}":
                    piece, given, surname = self.person(lang)
                    kind = 4
                elif piece == "{S}":
                    piece, kind = self.name_word(3, lang == "ru"), 4
                elif piece == "{E}":
                    piece, kind = self.email(given, surname) if given.isascii() and given and r.random() < 0.8 else self.email(), 0
                elif piece == "{T}":
                    piece, kind = self.phone(lang), 1
                elif piece == "{I}":
                    piece, kind = self.identity(lang), 2
                elif piece == "{A}":
                    piece, kind = self.address(lang), 3
                elif piece == "{N}":
                    piece = self.number(lang)
                elif piece == "{C}":
                    piece = self.other_word(r.choice([2, 3]), lang == "ru")
                elif piece == "{L}":
                    piece = r.choice(STREETS_EN.split()).capitalize()
                elif piece == "{K}":
                    piece = r.choice(["Ltd", "Inc.", "GmbH", "LLC"])
                elif piece == "{M}":
                    piece = str(r.choice([r.randint(2, 99), round(r.uniform(1, 99), 2)]))
                if kind >= 0:
                    spans.append((at, at + len(piece), kind))
                out.append(piece)
                at += len(piece)
            gap = r.choice([" ", "\n", "\n\n"])
            out.append(gap)
            at += len(gap)
        return "".join(out), spans


@functools.lru_cache(maxsize=2)
def trained(seed: int = 7, texts: int = 5200) -> tuple[tuple[Boosted, ...], tuple[float, ...]]:
    """Trees of each kind, and a threshold per kind that is best by F1 on the last fifth of the examples."""
    writer = _Writer(seed)
    examples = [writer.text() for _ in range(texts)]
    lexicon = Lexicon(writer.rates)
    x, y, held = [], [], []
    for i, (text, spans) in enumerate(examples):
        true = set(spans)
        for c, row in zip(*described(text, lexicon)):
            x.append(row)
            y.append(float(c in true))
            held.append(i >= texts * 4 // 5)
    x_, y_, held_ = np.array(x), np.array(y), np.array(held)
    trees, thresholds = [], []
    for k in range(len(KINDS)):
        own = x_[:, 0] == k
        trees.append(boost(x_[own & ~held_], y_[own & ~held_]))
        truth, sure = y_[own & held_], trees[-1].probability(x_[own & held_])

        def f1(t: float) -> float:
            hit = ((sure >= t) & (truth > 0)).sum()
            return 2 * hit / max(1, (sure >= t).sum() + truth.sum())

        thresholds.append(max((0.5, 0.4, 0.6, 0.3, 0.7), key=f1))
    return tuple(trees), tuple(thresholds)
