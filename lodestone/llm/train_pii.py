"""Fits models/pii.npz by pseudo-likelihood: ``python -m lodestone.llm.train_pii DIR [HELD_OUT_DIR]``.

Three kinds of labelled texts. The messages themselves, by distant supervision: mail addresses spell names, so words
that such local parts are made of are names wherever they stand outside a mail address or a street; numbers are
labelled by their form and the words right before them. The same messages with every name put in the place of
another, made of random syllables or taken from a short list, and with other digits in numbers, so that the field learns from
context and form what spelling cannot tell. And sentences of everyday life in nine languages, see ``SENTENCES``.
``unseen`` measures what names, numbers and addresses are found that no training text holds.
"""

from __future__ import annotations

import random
import re
import sys
from collections import Counter

import numpy as np
import pandas as pd

from lodestone.llm import pii

#: At most this many messages and documents are read.
SAMPLE_ROWS = 60_000
#: Messages are kept for the fit while they bring words seen fewer times than this.
WORD_COUNT = 6
#: A part of local parts must occur so often to count as a given name or a surname.
NAME_COUNT = 2
#: A word is an everyday one if it occurs so often without being a name.
EVERYDAY_COUNT = 3

PHONES = re.compile(r"^(?:\+\d[\d ()\-.]{7,}(?:,? ?ext\. ?\d+)?|00\d{2}[- ]\d[\d -]{6,}|\(\d{3}\) \d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|0\d{2} \d{4} \d{4}|0\d(?:[. ]\d\d){4}|0\d{2}/\d{5,}|1\d{6} \d{4})$")
IDS = re.compile(r"^(?:[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-Z]|\d{8}-?[A-Z]|\d{3}[ -]?\d\d[ -]?\d{4}|\d{2}(?: \d{3}){3}|(?=.*\d)(?=.*[A-Z])[A-Z0-9]{9})$")
OTHER = re.compile(r"(?:order|batch number|epoch|node|port|ratio is|prefix|section|started at|trace id|key|score|\"id\": ?|version|code=)\W*$", re.I)

#: Common names of many countries for training, and others that only ``unseen`` uses (fixed values).
GIVEN = "James Anna Peter Maria Hans Emma Wang Lukas Sophie Giulia Marco Pedro Camila Olga Dmitry Noah Chloe Fatima Omar Aisha Yusuf Hiroshi Yuki Minh Linh Ana Luis Carmen Javier Elena Pierre Camille Jan Anouk Sven Astrid Kasia Piotr Анна Сергей Мария Ольга".split()
FAMILY = "Smith Jones Müller Schmidt Garcia Lopez Rossi Bianchi Silva Santos Dupont Moreau Jansen Bakker Novak Kowalski Nguyen Tran Kim Park Tanaka Sato Khan Patel Singh Cohen Larsen Berg Петров Смирнов Jackson Meyer Fischer Costa Ferrari Visser Ivanov Popescu Horvat Haddad".split()
UNSEEN_GIVEN = "Bartholomew Wojciech Priscilla Xiulan Thandiwe Gudrun Ottavio Bénédicte Joaquín Siobhan Ekaterina Ruud Zainab Haruto Иван Татьяна".split()
UNSEEN_FAMILY = "Featherstonehaugh Szczepański Okonkwo Zhang Raghunathan Bjørnson Castellani Vasconcelos Delacroix Villalobos McAllister Vandenberghe Mbeki Yamaguchi Кузнецов Соколова".split()

#: Sentences with places for names, numbers and addresses; {g} given name, {s} surname, {w} an unknown word that is no name (fixed values).
SENTENCES = """
My name is {g} {s}.|According to {i} {s} this holds.|{i} {s} wrote it.|The owner is {g} {i} {s}.|Signed: {i} {s}|{g} {s}-{s} was here.|{g} Van {s}|{g} {s} {s} has come.|I am {g} {s} and I need help.|Dear Mr {s}, thank you for your letter.|Dear {g}, see you soon.|Hi {g}, how are you?|Mrs {s} called again.|Please ask {g} {s} about the {w} report.
I met {g} at the station.|{g} said that {s} agreed.|Regards,\n{g} {s}|Best,\n{g}|Yours sincerely,\n{g} {s}|The letter is signed by {g} {s}.|Dr {s} will see you now.|{g} {s} lives in {w}.|We talked to {s}, {g} yesterday.
{g} and {g} are on holiday.|Thanks, {g}!|Is {g} here?|According to {s}, this works.|{g}'s laptop broke.|Tell {g} that {w} is down.|my name is {lg} {ls}|this is {lg} {ls} again|From: {g} {s}|Name: {g} {s}
Ich heiße {g} {s}.|Mein Name ist {g} {s}.|Sehr geehrte Frau {s}, vielen Dank.|Sehr geehrter Herr {s},|Liebe {g}, bis bald.|Herr {s} hat angerufen.|Ich habe {g} getroffen.|Viele Grüße\n{g} {s}|{g} wohnt in {w}.|Bitte {g} {s} fragen.
Je m'appelle {g} {s}.|Bonjour {g}, merci.|Monsieur {s} est absent.|Chère {g}, à bientôt.|Cordialement,\n{g} {s}|J'ai vu {g} {s} hier.|Mon nom est {g} {s}.|Selon {g} {s}, tout va bien.
Me llamo {g} {s}.|Mi nombre es {g} {s}.|Hola {g}, gracias.|El señor {s} llamó ayer.|Estimada {g}:|Saludos,\n{g} {s}|Hablé con {g} {s}.
Mi chiamo {g} {s}.|Ciao {g}, grazie.|Il signor {s} ha chiamato.|Gentile dottoressa {s},|Cordiali saluti,\n{g} {s}|Ho visto {g} {s} ieri.|Meu nome é {g} {s}.|Olá {g}, obrigado.|O senhor {s} ligou.|Atenciosamente,\n{g} {s}|Falei com {g} {s} ontem.
Mijn naam is {g} {s}.|Beste {g}, bedankt.|Meneer {s} heeft gebeld.|Met vriendelijke groet,\n{g} {s}|Меня зовут {g} {s}.|Уважаемый {g},|Привет, {g}!|Я видел {g} {s} вчера.
The {w} server is down.|We use {w} and {w} for this.|{w} is a product of {w} {w}.|Read the {w} Guide first.|In {w}, the index is rebuilt every night.|Project {w} starts on Monday.|The {w} {w} Protocol is new.|Install {w} before {w}.|{w} supports several formats.
Die {w} ist kaputt.|Der {w} von {w} läuft.|Wir nutzen {w} für die {w}.|Das {w} braucht eine {w}.|Le {w} est en panne.|Nous utilisons {w} et {w}.|El {w} no funciona.|Usamos {w} con {w}.|Il {w} non funziona.|O {w} parou.|De {w} werkt niet.|Сервер {w} не работает.|In der {w} steht die {w}.|{w} und {w} sind Teile von {w}.
My social security number is {id}.|SSN: {id}|SSN {id}|SSN {id}, thanks|My SSN is {id}|social security no. {id}|passport {id}|Passport {id} expires soon.|passport no. {id}|National insurance number {id}|His tax id is {id}.|Meine Ausweisnummer lautet {id}.|Die Steuer-ID ist {id}.|Mon numéro de sécurité sociale est {id}.|DNI {id}|Mi pasaporte es {id}.|Codice fiscale: {id}|O meu NIF é {id}.|BSN {id}|Номер паспорта {id}
Call me on {ph}.|Phone: {ph}|Tel. {ph}|My mobile is {ph}.|Rufen Sie mich unter {ph} an.|Mon téléphone est {ph}.|Mi teléfono es {ph}.|Il mio numero è {ph}.|O meu telefone é {ph}.|Мой телефон {ph}.|Reach us at {ph} any time.|WhatsApp {ph}
Order {no} is late.|Ticket {no} was closed.|Invoice number {no}|Version {no} came out.|Build {no} failed.|The count was {no}.|Serial number {no}|tracking code {no}|Bestellung {no} fehlt.|Commande {no}|Pedido {no}|ISBN {no}|It took {no} ms.|Lot {no} was recalled.|IP {no}|Postcode {code}
I live at {ad}.|My address is {ad}.|Send it to {ad}.|Ich wohne in der {ad}.|Meine Adresse: {ad}|J'habite au {ad}.|Vivo en {ad}.|Abito in {ad}.|Moro na {ad}.|Ik woon op de {ad}.|Я живу на {ad}.|Our office: {ad}|Meet me at {ad} tomorrow.
Table {n} {w} {w} {w} {code}|Table {n} {w} {w} {w}|Section {n} {w} {w}|Figure {n} {w} Overview|Chapter {n} {w} {w}|Page {n} of the {w} Manual|We sold {n} {w} units.|Room {n}, {w} Building
""".replace("\n", "|").split("|")
#: Sentences that only ``unseen`` uses (fixed values).
UNSEEN_SENTENCES = [
    "Hello, my name is {g} {s} and I cannot log in.", "Good morning, this is {g} {s} speaking.", "Dear Ms {s}, your parcel has arrived.", "Yesterday {g} {s} asked me the same thing.", "Could you forward this to {g} {s}?", "Kind regards,\n{g} {s}",
    "Guten Tag, ich heiße {g} {s} und brauche Hilfe.", "Frau {s} ist heute nicht da.", "Je m'appelle {g} {s} et j'ai une question.", "Me llamo {g} {s} y tengo una duda.", "Mi chiamo {g} {s} e non riesco ad accedere.", "Meu nome é {g} {s} e preciso de ajuda.",
    "My passport number is {id}, is that enough?", "She gave her social security number as {id}.", "You can call me at {ph} after five.", "His phone number: {ph}", "I moved to {ad} last week.", "Please deliver everything to {ad}.",
]
CASES = re.compile(r"\{(\w+)\}")


def made_up(rng: random.Random, sounds: int | None = None) -> str:
    """A word of random syllables."""
    heads = "b br c ch d dr f fr g gr h j k kl kr l m n p pr qu r s sch sh sl st str t th tr v w wh x y z zs cz sz '".split()
    vowels = "a e i o u y ai au ea ei ia ie io oo ou ö ü é á í ó å ø ã".split()
    tails = ["", "", "", "n", "r", "s", "l", "m", "ck", "nd", "rt", "ng", "x", "sk", "wi", "ff", "th", "z", "k"]
    out = "".join(rng.choice(heads) + rng.choice(vowels) + rng.choice(tails) for _ in range(sounds or rng.choice((1, 2, 2, 2, 3, 3, 4)))).strip("'")
    return out if len(out) > 2 else out + "an"


def digits(rng: random.Random, form: str) -> str:
    """``9`` stands for any digit, ``A`` for any capital."""
    return "".join(str(rng.randrange(10)) if c == "9" else rng.choice("ABCDEFGHJKLMNPRSTUVWXYZ") if c == "A" else c for c in form)


ID_FORMS = ["999-99-9999", "999 99 9999", "AA 99 99 99 A", "AA999999A", "99999999A", "A9999999", "A99999999", "99 999 999 999", "999999999", "9 99 99 99 999 999 99", "AAAAAA99A99A999A", "999 999 999", "AA9999999", "A9AAA9999", "99 99 999999", "A99A9AA99"]
PHONE_FORMS = ["+1 999 999 9999", "+99 99 9999 9999", "(999) 999-9999", "999-999-9999", "099 9999 9999", "0999 999999", "+99 9 99 99 99 99", "09 99 99 99 99", "09.99.99.99.99", "+99 999 999 999", "0099 99 9999999", "+99 (0)99 999 9999", "099/9999999", "+9 (999) 999-99-99"]
OTHER_FORMS = ["99999999", "999999999", "9999-9999", "AA-999999", "A999999999", "9.9.9", "999.9.9.99", "9999999999", "99 999 999", "9999999", "978-9-99-999999-9", "A9A9A9A9A9", "2024-99-99", "999999-9999"]


def address(rng: random.Random, word) -> str:
    """A street address in one of the forms of many countries."""
    w, town, n = (lambda: word().capitalize()), (lambda: word().capitalize()), rng.randrange(1, 250)
    street = rng.choice(
        [
            f"{n} {w()} {rng.choice(['Street', 'Road', 'Lane', 'Drive', 'Avenue', 'Court', 'St', 'Rd', 'Ave'])}", f"{w()}{rng.choice(['straße', 'weg', 'gasse', 'platz', 'str.'])} {n}", f"{n} rue {rng.choice(['de', 'du', 'des'])} {w()}",
            f"Calle {rng.choice(['de ', ''])}{w()} {n}", f"Via {w()} {n}", f"Rua das {w()} {n}", f"Avenida {w()} {n}", f"{w()}{rng.choice(['straat', 'laan', 'gracht'])} {n}", f"Piazza {w()} {n}", f"ул. Ленина, д. {n}",
        ]
    )
    code = digits(rng, rng.choice(["99999", "9999", "9999-999", "99999"]))
    return street + rng.choice(["", "", f", {town()} {code}", f", {code} {town()}", f"\n{code} {town()}"])


def filled(template: str, rng: random.Random, given: list[str], family: list[str], word) -> tuple[str, list[tuple[int, int, int]]]:
    """The sentence, and its spans ``(start, end, label)``."""
    out, spans, at, loud = "", [], 0, rng.random() < 0.1
    for m in CASES.finditer(template):
        out += template[at : m.start()]
        at = m.end()
        kind = m[1]
        if kind == "i":
            out += rng.choice("ABCDEFGHJKLMNPRSTVWZ") + "."
            continue
        label = {"g": pii.GIVEN, "lg": pii.GIVEN, "s": pii.SURNAME, "ls": pii.SURNAME, "id": pii.ID, "ph": pii.PHONE, "ad": pii.ADDRESS}.get(kind, pii.O)
        if kind in ("g", "lg", "s", "ls"):
            pool = given if kind[-1] == "g" else family
            x = rng.choice(pool) if pool and rng.random() < 0.3 else word().capitalize()
            x = x.lower() if kind[0] == "l" else x.upper() if loud else x
        else:
            x = digits(rng, rng.choice({"id": ID_FORMS, "ph": PHONE_FORMS, "no": OTHER_FORMS, "code": ["9999-999", "99999", "AA9 9AA"], "n": ["9", "99", "999"]}[kind])) if kind in ("id", "ph", "no", "code", "n") else address(rng, word) if kind == "ad" else word().capitalize() if rng.random() < 0.8 else word()
        spans.append((len(out), len(out) + len(x), label))
        out += x
    return out + template[at:], spans


def labelled(g: pii.Graph, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Labels of nodes that lie inside a labelled span; of an address or number only those of its kind."""
    y = np.zeros(g.n, "int64")
    for i in range(g.n):
        for a, b, label in spans[g.doc[i]]:
            if a < g.b[i] and g.a[i] < b and pii.ALLOWED[g.kind[i], label] == 0:
                y[i] = label
    return y


def lexicon(texts: list[str]) -> tuple[set[str], set[str]]:
    given, sur = Counter(), Counter()
    for t in texts:
        for m in re.finditer(r"\b([a-zA-Z]{2,})[._-]([a-zA-Z]{4,})\d{0,2}(?:\+\w+)?@", t):
            given[m[1].lower()] += 1
            sur[m[2].lower()] += 1
    total = Counter(w for t in texts for w in {pii.fold(x) for x in pii.WORDS.findall(t)})
    g = {w for w, c in given.items() if c >= max(NAME_COUNT, 0.02 * total[w]) and c > sur[w]}
    s = {w for w, c in sur.items() if c > given[w] and c >= 0.02 * total[w]}
    # surnames are often compounds: what two parts of known ones make is one too
    heads, tails = Counter(), Counter()
    for w in s:
        for k in range(3, len(w) - 2):
            heads[w[:k]] += 1
            tails[w[k:]] += 1
    for w in list(total):
        if total[w] < 400 and any(heads[w[:k]] >= 5 and tails[w[k:]] >= 5 for k in range(3, len(w) - 2)):
            s.add(w)
    return g, s - g


def gold(texts: list[str], g: pii.Graph, given: set[str], sur: set[str]) -> np.ndarray:
    y = np.zeros(g.n, "int64")
    for i in range(g.n):
        t = texts[g.doc[i]]
        s = t[g.a[i] : g.b[i]]
        if g.kind[i] == pii.MAIL:
            y[i] = pii.EMAIL
        elif g.kind[i] == pii.STREET:
            y[i] = pii.ADDRESS
        elif g.kind[i] == pii.NUMBER:
            if not OTHER.search(t[max(0, g.a[i] - 24) : g.a[i]]):
                y[i] = pii.PHONE if PHONES.match(s) else pii.ID if IDS.match(s) else pii.O
        else:
            w = pii.fold(s)
            core = w.split("'")[-1].split("’")[-1] if w[:2] in ("o'", "o’") else w
            y[i] = pii.GIVEN if core in given else pii.SURNAME if core in sur else pii.O
    return y


def renamed(text: str, spans: list[tuple[int, int, int]], rng: random.Random, word) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with other names, the same for equal ones, and other digits in numbers, and where its labelled spans then lie."""
    out, moved, at, names, loud = "", [], 0, {}, rng.random() < 0.12
    for a, b, label in spans:
        old = text[a:b]
        out += text[at:a]
        at = b
        if label in (pii.GIVEN, pii.SURNAME):
            new = names.setdefault(pii.fold(old), rng.choice(GIVEN if label == pii.GIVEN else FAMILY) if rng.random() < 0.3 else word())
            new = new.upper() if loud or pii.form_of(old) == "U" else new.lower() if pii.form_of(old) == "l" else new[:1].upper() + new[1:]
        elif label in (pii.PHONE, pii.ID) and rng.random() < 0.5:
            new = digits(rng, rng.choice(PHONE_FORMS if label == pii.PHONE else ID_FORMS))
        else:
            new = old
        moved.append((len(out), len(out) + len(new), label))
        out += new
    return out + text[at:], moved


def fit(g: pii.Graph, y: np.ndarray, rounds: int = 80, rate: float = 0.35, l2: float = 2e-6) -> tuple[np.ndarray, ...]:
    """Maximises the probability of each label given its neighbours' labels (Adagrad, full batches)."""
    w, c, s = np.zeros((pii.DIMS + 1, 7)), np.zeros((pii.GAPS, 7, 7)), np.zeros((7, 7))
    gw, gc, gs = np.full_like(w, 1e-8), np.full_like(c, 1e-8), np.full_like(s, 1e-8)
    a, b, k = g.chain.T
    p, q = g.skip.T
    one = np.eye(7)[y]
    flat = g.features.ravel()
    for step in range(rounds):
        z = w[g.features].sum(axis=1) + pii.ALLOWED[g.kinds]
        np.add.at(z, b, c[k, y[a]])
        np.add.at(z, a, c[k, :, y[b]])
        np.add.at(z, q, s[y[p]])
        np.add.at(z, p, s[y[q]])
        z -= z.max(axis=1, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(axis=1, keepdims=True)
        d = one - prob
        dw = np.stack([np.bincount(flat, np.repeat(d[:, i], g.features.shape[1]), pii.DIMS + 1) for i in range(7)], axis=1)
        dw[pii.DIMS] = 0
        dc, ds = np.zeros_like(c), np.zeros_like(s)
        np.add.at(dc, (k, y[a]), d[b])
        np.add.at(dc.transpose(0, 2, 1), (k, y[b]), d[a])
        np.add.at(ds, y[p], d[q])
        np.add.at(ds, y[q], d[p])
        ds = (ds + ds.T) / 2
        for x, dx, gx in ((w, dw, gw), (c, dc, gc), (s, ds, gs)):
            dx -= l2 * len(y) * x
            gx += dx**2
            x += rate * dx / np.sqrt(gx)
        if step % 20 == 19:
            print(step + 1, "log-likelihood a node", round(float(np.log(prob[np.arange(len(y)), y] + 1e-12).mean()), 5))
    return w[: pii.DIMS], c, s


def read(root: str, table: str = "chat_messages", column: str = "content", key: str = "entry_id") -> list[str]:
    d = pd.read_parquet(f"{root}/{table}.parquet", columns=[key, column]).dropna().drop_duplicates(key)
    return d[column].head(SAMPLE_ROWS).tolist()


def everyday_words(texts: list[str], names: set[str]) -> np.ndarray:
    """The hashed set of words that occur often and are no names."""
    total = Counter(w for t in texts for w in {pii.fold(x) for x in pii.WORDS.findall(t)})
    prose = " ".join(CASES.sub(" ", x) for x in SENTENCES)
    bits = np.zeros(pii.KNOWN_BITS, bool)
    for w in {w for w, c in total.items() if c >= EVERYDAY_COUNT and w not in names} | {pii.fold(x) for x in pii.WORDS.findall(prose)}:
        bits[list(pii.known_bits(w))] = True
    return bits


def unseen(count: int = 40) -> dict[str, tuple[float, float, int]]:
    """Precision, recall and number of mentions for each kind, in sentences and with names, numbers and streets that training has not seen."""
    rng = random.Random(99)
    word = lambda: made_up(rng)
    hits, wanted, got = Counter(), Counter(), Counter()
    for _ in range(count):
        for template in UNSEEN_SENTENCES:
            place = lambda: rng.choice(["Baker", "Elmwood", "Roma", "Flores", "Linden", "Victor", "Hugo", "Kerk", "Garibaldi", "Augusta"])
            text, spans = filled(template, rng, UNSEEN_GIVEN, UNSEEN_FAMILY, lambda: rng.choice(UNSEEN_FAMILY) if "{ad}" not in template else place())
            want, name = set(), None
            for a, b, label in spans:
                if label == pii.GIVEN:
                    name = a
                elif label == pii.SURNAME:
                    want.add(("name", a if name is None else name, b))
                elif label != pii.O:
                    want.add((pii.KINDS[label], a, b))
            have = {(k, a, b) for k, a, b in pii.mentions([text])[0]}
            for k, a, _ in want:
                wanted[k] += 1
                hits[k] += any(k == k2 and a == a2 for k2, a2, _ in have)
            for k, _, _ in have:
                got[k] += 1
    return {k: (round(hits[k] / max(1, got[k]), 3), round(hits[k] / wanted[k], 3), wanted[k]) for k in wanted}


def main(root: str, held_out: str | None = None) -> None:
    rng = random.Random(7)
    word = lambda: made_up(rng)
    texts, docs = read(root), read(root, "documents", "text", "doc_id")
    given, sur = lexicon(texts)
    print(len(texts), "messages,", len(given), "given names,", len(sur), "surnames")
    bits = everyday_words(texts + docs, given | sur)
    # every distinct word a few times: prose words repeat without end
    seen: Counter = Counter()
    keep = []
    for t in texts + docs:
        fresh = [w for w in pii.WORDS.findall(t) if seen[w] < WORD_COUNT]
        if len(t) < 2000 and fresh:
            keep.append(t)
            seen.update(fresh)
    every = pii.Evidence(None, bits)
    first = pii.Graph(keep, every)
    y = gold(keep, first, given, sur)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in keep]
    for i in range(first.n):
        if y[i]:
            spans[first.doc[i]].append((first.a[i], first.b[i], int(y[i])))
    named = [(t, x) for t, x in zip(keep, spans) if x]
    others = [renamed(t, x, rng, word) for t, x in rng.sample(named, min(len(named), 6000))]
    others += [(t.upper(), x) for t, x in rng.sample(named, min(len(named), 500)) if len(t.upper()) == len(t)]
    others += [filled(t, rng, GIVEN, FAMILY, word) for _ in range(60) for t in SENTENCES if t.strip()]
    # a sentence of everyday life seldom stands alone
    others = [(t + " " + u, x + [(a + len(t) + 1, b + len(t) + 1, k) for a, b, k in z]) for (t, x), (u, z) in zip(others[::2], others[1::2])] + others[::3]
    all_texts, all_spans = keep + [t for t, _ in others], spans + [x for _, x in others]
    g = pii.Graph(all_texts, every)
    y = labelled(g, all_spans)
    print(len(keep), "messages kept,", len(others), "made up,", g.n, "nodes", dict(zip(pii.LABELS, np.bincount(y, minlength=7).tolist())))
    w, c, s = fit(g, y)
    np.savez_compressed(pii.MODEL, w=w.astype("float16"), chain=c.astype("float16"), skip=s.astype("float16"), known=np.packbits(bits))
    pii.model.cache_clear()
    for k, v in unseen().items():
        print("unseen", k, "precision, recall, mentions", v)
    if held_out:
        other = read(held_out)
        given2, sur2 = lexicon(other)
        m = pii.model()
        g2 = pii.Graph(other, pii.Evidence(m["w"], m["known"]))
        y2, z2 = gold(other, g2, given | given2, sur | sur2), pii.infer(g2, m["w"], m["chain"], m["skip"])
        for k in range(1, 7):
            hit = ((y2 == k) & (z2 == k)).sum()
            print(pii.LABELS[k], "precision", round(hit / max(1, (z2 == k).sum()), 4), "recall", round(hit / max(1, (y2 == k).sum()), 4), "of", (y2 == k).sum())


if __name__ == "__main__":
    main(*sys.argv[1:3])
