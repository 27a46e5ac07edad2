"""Problem 2: personal information inside free text.

Method: skip-chain conditional random field. The variables are the candidate words, numbers, addresses and mail
addresses of a message: every capitalised word that is not an everyday one, every word right after something that
introduces a person, every word whose spelling speaks for a name, every number and address of a plausible form.
Neighbours are linked by chain edges; words or numbers that occur again or share their stem, however far away, by
skip edges; loopy message passing over all messages of a batch at once makes the labels of a message agree.
Every kind of variable can also be none of these things, which the field decides. Weights come from ``train_pii``.
"""

from __future__ import annotations

import bisect
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labels in the order of the model's columns (fixed values).
LABELS = ["O", "GIVEN", "SURNAME", "EMAIL", "PHONE", "ID", "ADDRESS"]
O, GIVEN, SURNAME, EMAIL, PHONE, ID, ADDRESS = range(7)
#: Labels that each kind of node may take.
WORD, MAIL, NUMBER, STREET = range(4)
ALLOWED = np.full((4, 7), -1e9, "float32")
for _kind, _labels in ((WORD, (O, GIVEN, SURNAME)), (MAIL, (O, EMAIL)), (NUMBER, (O, PHONE, ID)), (STREET, (O, ADDRESS))):
    ALLOWED[_kind, list(_labels)] = 0
#: Kinds and placeholders that come out (fixed values).
KINDS = {EMAIL: "email", PHONE: "phone", ID: "id_number", ADDRESS: "address"}
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}

DIMS = 1 << 15
#: An everyday word is left out where its spelling speaks so many nats more for no name.
GATE = 1.0
#: Bits of the table of everyday words.
KNOWN_BITS = 1 << 18
ROUNDS = 6
MODEL = os.path.join(os.path.dirname(__file__), "models", "pii.npz")
KEEP = 200_000

_AT = r"(?:\s?[\[({<]\s?(?:at|AT)\s?[\])}>]\s?|\sat\s|\sAT\s|@)"
_DOT = r"(?:\s?[\[({<]\s?(?:dot|DOT)\s?[\])}>]\s?|\sdot\s|\sDOT\s|\.)"
MAILS = re.compile(rf"(?<![\w.+-])[\w][\w.+-]*{_AT}[^\W_](?:[\w-]*\w)?(?:{_DOT}[^\W_](?:[\w-]*\w)?)*{_DOT}[^\W\d_]{{2,}}(?![\w@])")
_CAP = r"[A-ZÀ-ÞŒŠŽ][\w'’-]*"
_TOWN = rf"(?:{_CAP}(?:-\w+)*)"
_CODE = r"(?:\d{4,6}(?:-\d{3})?|\d{3}-\d{4}|[A-Z]{1,2}\d[A-Z\d]?\s?\d[A-Z]{2})"
_TAIL = rf"(?:(?:,\s*|\s+)(?:Apt|Flat|Unit|App\.?|No\.?)\s*\d+\s?[A-Za-z]?)?(?:(?:\s*[,\n]\s*|\s+)(?:{_TOWN},?\s+{_CODE}\b|{_CODE}\s+{_TOWN}))?"
#: Forms of street addresses, each with what a text must hold for it to be tried.
STREETS = [
    (
        (" Street", " St", " Road", " Rd", " Lane", " Ln", " Drive", " Dr", " Close", " Ave", " Boulevard", " Blvd", " Way", " Court", " Ct", " Place", " Square", " Terrace", " Crescent", " Row", " Walk", " Hill", " Gardens"),
        re.compile(rf"(?:(?:Flat|Apt|Unit|Suite)\s+\d+\w?,\s+)?\d+\w?,?\s+(?:{_CAP}\s+){{1,3}}(?:Street|St|Road|Rd|Lane|Ln|Drive|Dr|Close|Avenue|Ave|Boulevard|Blvd|Way|Court|Ct|Place|Square|Terrace|Crescent|Row|Walk|Hill|Gardens)\b\.?{_TAIL}"),
    ),
    (("straße ", "strasse ", "str. ", "gasse ", "weg ", "platz ", "allee ", "ufer ", "damm ", "ring "), re.compile(rf"\b[A-ZÄÖÜ][\wäöüß-]*(?:straße|strasse|str\.|gasse|weg|platz|allee|ufer|damm|ring)\s+\d+\w?{_TAIL}")),
    (
        (" rue ", " avenue ", " boulevard ", " place ", " chemin ", " allée ", " quai ", " impasse ", " cours ", " route "),
        re.compile(rf"\d+(?:\s?(?:bis|ter))?,?\s+(?:rue|avenue|boulevard|place|chemin|allée|quai|impasse|cours|route)\s+(?:(?:(?:des|de|du|la|le|les)\s+|[ld]['’]|{_CAP})\s*)+{_TAIL}"),
    ),
    (
        ("Calle ", "C/ ", "C. ", "Avenida ", "Avda", "Av. ", "Plaza ", "Paseo ", "Camino ", "Carrera ", "Ronda ", "Rua ", "Travessa ", "Praça ", "Largo ", "Via ", "Viale ", "Piazza ", "Corso ", "Vicolo "),
        re.compile(rf"\b(?:Calle|C/|C\.|Avenida|Avda?\.|Av\.|Plaza|Paseo|Camino|Carrera|Ronda|Rua|Travessa|Praça|Largo|Via|Viale|Piazza|Corso|Vicolo)\s+(?:(?:de|del|dei|delle|della|di|da|das|do|dos|la|las|los|el|{_CAP}),?\s+)+\d+\w?{_TAIL}"),
    ),
    (("straat ", "laan ", "plein ", "gracht ", "kade ", "dijk "), re.compile(rf"\b[A-Z][\w-]*(?:straat|laan|plein|gracht|kade|dijk)\s+\d+\w?{_TAIL}")),
    (("ул. ", "улица ", "проспект ", "пр. ", "переулок "), re.compile(r"(?:ул\.|улица|проспект|пр\.|переулок)\s+[А-ЯЁ][\w-]*(?:\s+[А-ЯЁ][\w-]*)?,?\s+(?:д\.\s*)?\d+\w?(?:,\s*(?:кв\.\s*)?\d+)?")),
    # a house number and capitalised words before a town and its code, whatever the street is called
    ((" ",), re.compile(rf"(?<![\w.,:/-])\d{{1,4}}[A-Za-z]?,?\s+(?:{_CAP}\s+){{0,3}}{_CAP},?\s+(?:{_TOWN},?\s+{_CODE}|{_CODE}\s+{_TOWN})\b")),
]
NUMBERS = re.compile(
    r"(?<![\w.,/=#-])(?:(?<=tel:)|(?<=Tel:)|(?<!:))(?:[+(]{0,2}\d[\d().\-/ ]{5,22}\d(?:,?\s?(?:ext|x)\.?\s?\d{1,5})?(?:[ -]?[A-Z])?|(?!(?:ID|NO|NR|TEL|FAX|PIN|SSN|DNI|NIF|NIE|BSN|TIN|VAT)\b)[A-Z]{1,3}[ -]?\d(?:[ -]?\d){4,9}(?:[ -]?[A-Z])?|(?=[A-Z0-9]{8,16}\b)(?=[A-Z]*\d)(?=\d*[A-Z])[A-Z0-9]{8,16})(?![\w/:=]|[.,-]\d)"
)
DIGIT = re.compile(r"\d")
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
ELIDED = re.compile(r"(?:[dDlLjJmMnNsStTcC]|[qQ]u)['’]")
INITIAL = re.compile(r"(?<![\w.])([^\W\d_])\.\s?$")
#: Words that stand before a person: titles, greetings and ways to say a name, without accents (fixed values).
CUES = frozenset(
    "mr mrs ms miss dr prof sir madam herr herrn frau mme mlle madame monsieur senor senora senorita sra dott signor signora sig senhor senhora mevrouw meneer dhr mevr господин госпожа "
    "is named called heiße heisse es llamo llama chiamo chiama chamo chama nome nombre naam heet nom зовут appelle dear hi hello liebe lieber hallo bonjour cher chere hola estimado estimada "
    "querido querida caro cara ciao beste уважаемый уважаемая regards cheers thanks by attention gruße saludos cordialement mit and und et y e en и".split()
)
#: A word right after this is a node whatever it is.
OPENING = re.compile(r"\b(?:name is|heiße|heisse|name ist|m['’]appelle|me llamo|nombre es|mi chiamo|nome é|me chamo|naam is|ik heet|меня зовут)\s+([^\W\d_]{2,})(?:\s+([^\W\d_]{2,}))?", re.I)
PARTICLE = re.compile(r"(?:(?:van|von|de|der|den|del|di|da|zu|ter)\s)+$", re.I)

MENTIONS = "entry_id string, kind string, start_pos int, n_chars int"


def fold(word: str) -> str:
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c)).lower()


def _h(text: str) -> int:
    return zlib.crc32(text.encode()) % DIMS


def shape(text: str) -> str:
    return re.sub(r"[^\W\d_]", "A", re.sub(r"\d", "9", text))


def known_bits(word: str) -> tuple[int, int]:
    w = word.encode()
    return zlib.crc32(w) % KNOWN_BITS, zlib.crc32(w[::-1] + b"#") % KNOWN_BITS


def everyday(word: str, bits: np.ndarray) -> bool:
    """Whether the folded word is in the table of everyday words (a hashed set, so 1 of 100 others is taken for one)."""
    a, b = known_bits(word)
    return bool(bits[a] and bits[b])


def form_of(word: str) -> str:
    return "U" if word.isupper() and len(word) > 1 else "C" if word[0].isupper() else "l"


@lru_cache(maxsize=1 << 16)
def _word_features(word: str, usual: bool) -> tuple[int, ...]:
    w, form = fold(word), form_of(word)
    return tuple(_h(x) for x in (f"e={usual}{form}", "w=" + w, "p2=" + w[:2], "p3=" + w[:3], "p4=" + w[:4], "s2=" + w[-2:], "s3=" + w[-3:], "s4=" + w[-4:], "s5=" + w[-5:], "f=" + form, f"n={min(len(w), 12)}"))


def word_features(word: str, bits: np.ndarray) -> list[int]:
    return list(_word_features(word, everyday(fold(word), bits)))


def span_features(kind: int, text: str) -> list[int]:
    if kind == MAIL:
        return [_h("mail"), _h("mail@" if "@" in text else "mail-at"), _h("mail.dot" if re.search(r"\bdot\b", text, re.I) else "mail.")]
    if kind == STREET:
        typed = any(k.strip() in text for keys, _ in STREETS[:-1] for k in keys)
        return [_h(f"street{typed}"), _h("code" if re.search(rf"{_CODE}(?:\s+\D*)?$", text) else "no code"), _h(f"words={len(text.split())}")]
    s = shape(text)
    digits = sum(c.isdigit() for c in text)
    return [_h(x) for x in ("num", "sh=" + s, "sh3=" + s[:3], "sh-3=" + s[-3:], f"nd={digits}", "lead=" + text[:2], "lead3=" + re.sub(r"[^\w+(]", "", text)[:3], "set=" + "".join(sorted(set(re.sub(r"[A9]", "", s)))))]


def context_features(text: str, a: int, b: int) -> list[int]:
    left, right = text[max(0, a - 40) : a], text[b : b + 24]
    raw, after = WORDS.findall(left)[-2:], WORDS.findall(right)[:1]
    lw, rw = [fold(x) for x in raw], [fold(x) for x in after]
    lp, rp = left.rstrip()[-1:], right.lstrip()[:1]
    start = not lp or lp in ".!?…:\n" or "\n" in left[len(left.rstrip()) :]
    lp, rp = ("a" if lp.isalpha() else "9" if lp.isdigit() else lp), ("a" if rp.isalpha() else "9" if rp.isdigit() else rp)
    own, line = form_of(text[a:b]), "\n" in right[: len(right) - len(right.lstrip())] or not rp
    beside = (form_of(raw[-1]) if raw and lp == "a" else "-") + own + (form_of(after[0]) if after and rp == "a" else "-")
    made = ("l1=" + (lw[-1] if lw else ""), "l2=" + "_".join(lw), "r1=" + (rw[0] if rw else ""), "lp=" + lp, "rp=" + rp, "lc=" + left[-1:], "rc=" + right[:1], f"start={start}{own}", "beside=" + beside, f"line={start}{line}{own}", "cue=" + "".join("1" if x in CUES else "0" for x in lw) + own)
    return [_h(x) for x in made]


@lru_cache(maxsize=1)
def model() -> dict[str, np.ndarray]:
    z = np.load(MODEL)
    return {k: np.unpackbits(z[k]).astype(bool) if k == "known" else z[k].astype("float32") for k in z.files}


class Evidence:
    """Which words may be names by themselves, kept for up to ``KEEP`` words. ``w`` None: every word (training)."""

    def __init__(self, w: np.ndarray | None, bits: np.ndarray) -> None:
        self.w, self.bits, self.known = w, bits, {}

    def open(self, word: str) -> bool:
        """Whether a word is a node wherever it stands: it is capitalised and no everyday word, or is spelled like a name."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= KEEP:
                self.known.clear()
            bare = ELIDED.sub("", word) or word
            if len(bare) < 2:
                got = False
            elif self.w is None or (form_of(bare) != "l" and not everyday(fold(bare), self.bits)):
                got = True
            else:
                s = self.w[word_features(bare, self.bits)].sum(axis=0) + ALLOWED[WORD]
                got = bool(s[1:].max() - s[O] > -GATE)
            self.known[word] = got
        return got


class Taken:
    """Spans without overlap, kept in order."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, int, int]] = []

    def add(self, a: int, b: int, kind: int) -> None:
        i = bisect.bisect_left(self.spans, (a, b))
        if (i == 0 or self.spans[i - 1][1] <= a) and (i == len(self.spans) or self.spans[i][0] >= b):
            self.spans.insert(i, (a, b, kind))


def nodes(text: str, evidence: Evidence) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of what could be a mention, in order and without overlap."""
    taken = Taken()
    if "@" in text or " at " in text or "at)" in text or "at]" in text or "AT" in text:
        for m in MAILS.finditer(text):
            taken.add(m.start(), m.end(), MAIL)
    if DIGIT.search(text):
        for keys, pattern in STREETS:
            if any(map(text.__contains__, keys)):
                for m in pattern.finditer(text):
                    taken.add(m.start(), m.start() + len(m.group().rstrip(" ,\n\t")), STREET)
        for m in NUMBERS.finditer(text):
            taken.add(m.start(), m.end(), NUMBER)
    spans, out = taken.spans, []
    cued = {m.start(i) for m in OPENING.finditer(text) for i in (1, 2)}
    fixed = [x[0] for x in spans]
    for m in WORDS.finditer(text):
        w = m.group()
        if not evidence.open(w) and m.start() not in cued:
            continue
        a, b = m.span()
        e = ELIDED.match(w)
        if e and e.end() < len(w):
            a += e.end()
        if b - a < 2:
            continue
        k = bisect.bisect_right(fixed, a)
        if (k == 0 or spans[k - 1][1] <= a) and (k == len(spans) or spans[k][0] >= b):
            out.append((a, b, WORD))
    return sorted(spans + out)


def gap_type(text: str, a: int, b: int) -> int:
    """Type of the chain edge between nodes around ``text[a:b]``; -1: too far apart."""
    g = text[a:b]
    if len(g) > 8 or "\n\n" in g:
        return -1
    s = g.strip()
    if s == "":
        return 0 if g else -1
    if s == ",":
        return 1
    if s in "-'’":
        return 2
    if re.fullmatch(r"[^\W\d_]\.|\w+", s):
        return 3
    return 4


GAPS = 5


class Graph:
    """Nodes and edges of many messages, as arrays."""

    def __init__(self, texts: list[str], evidence: Evidence) -> None:
        self.doc, self.a, self.b, self.kind = [], [], [], []
        feats, width, chain, skip = [], 22, [], []
        for d, t in enumerate(texts):
            got = nodes(t, evidence) if t else []
            first, seen = len(self.doc), {}
            for k, (a, b, kind) in enumerate(got):
                i = first + k
                own = word_features(t[a:b], evidence.bits) if kind == WORD else span_features(kind, t[a:b])
                f = own + context_features(t, a, b)
                feats.append(f + [DIMS] * (width - len(f)))
                if k:
                    g = gap_type(t, got[k - 1][1], a)
                    if g >= 0:
                        chain.append((i - 1, i, g))
                # a word is the same as its possessive or plural, a number the same however it is grouped
                key = (kind, re.sub(r"['’]?s$", "", fold(t[a:b])) if kind == WORD else re.sub(r"\W", "", fold(t[a:b])))
                if key in seen:
                    skip.append((seen[key], i))
                seen[key] = i
                self.doc.append(d)
                self.a.append(a)
                self.b.append(b)
                self.kind.append(kind)
        self.n = len(self.doc)
        self.features = np.array(feats, "int32").reshape(self.n, width)
        self.chain = np.array(chain, "int64").reshape(-1, 3)
        self.skip = np.array(skip, "int64").reshape(-1, 2)
        self.kinds = np.array(self.kind, "int64")


def infer(g: Graph, w: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label of each node by loopy max-product with all messages of a round passed at once."""
    if not g.n:
        return np.zeros(0, int)
    padded = np.concatenate([w, np.zeros((1, w.shape[1]), "float32")])
    unary = padded[g.features].sum(axis=1) + ALLOWED[g.kinds]
    src = np.concatenate([g.chain[:, 0], g.skip[:, 0]])
    dst = np.concatenate([g.chain[:, 1], g.skip[:, 1]])
    if not len(src):
        return unary.argmax(axis=1)
    pot = np.concatenate([chain[g.chain[:, 2]], np.repeat(skip[None], len(g.skip), axis=0)])
    fwd, bwd = np.zeros((len(src), 7), "float32"), np.zeros((len(src), 7), "float32")
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, dst, fwd)
        np.add.at(belief, src, bwd)
        new_f = (pot + (belief[src] - bwd)[:, :, None]).max(axis=1)
        new_b = (pot + (belief[dst] - fwd)[:, None, :]).max(axis=2)
        fwd = 0.5 * fwd + 0.5 * (new_f - new_f.max(axis=1, keepdims=True))
        bwd = 0.5 * bwd + 0.5 * (new_b - new_b.max(axis=1, keepdims=True))
    belief = unary.copy()
    np.add.at(belief, dst, fwd)
    np.add.at(belief, src, bwd)
    return belief.argmax(axis=1)


def spans(text: str, found: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """Mentions ``(kind, start, end)`` from labelled nodes ``(start, end, label)``: parts of one name are put together."""
    out, k = [], 0
    while k < len(found):
        a, b, label = found[k]
        if label in KINDS:
            out.append((KINDS[label], a, b))
            k += 1
            continue
        start = a
        if label == SURNAME:
            p = PARTICLE.search(text[max(0, a - 16) : a])
            if p:
                start = a - len(p.group())
            i = INITIAL.search(text[max(0, start - 4) : start])
            while i and text[start - len(i.group())].isupper():
                start -= len(i.group())
                i = INITIAL.search(text[max(0, start - 4) : start])
        end, surname = b, label == SURNAME
        alone = surname and start == a
        k += 1
        while k < len(found):
            a2, b2, l2 = found[k]
            gap = text[end:a2]
            if l2 == SURNAME and (gap in ("-", "–") and surname or not surname and re.fullmatch(r"[ \t]+(?:[^\W\d_]\.[ \t]+)*(?:(?:van|von|de|der|den|del|di|da|zu|ter)[ \t]+)*", gap, re.I)):
                end, surname, alone = b2, True, alone and gap in ("-", "–")
                k += 1
            elif l2 == GIVEN and alone and re.fullmatch(r",[ \t]*", gap):
                nxt = found[k + 1] if k + 1 < len(found) else None
                if nxt and nxt[2] == SURNAME and re.fullmatch(r"[ \t]+(?:[^\W\d_]\.[ \t]+)*(?:(?:van|von)[ \t]+)*", text[b2 : nxt[0]], re.I):
                    break
                end = b2
                k += 1
                alone = False
                break
            else:
                break
        tail = re.match(r"(?:[ \t][^\W\d_]\.)+", text[end : end + 8])
        if tail and not surname and tail.group().strip()[0].isupper():
            end += tail.end()
        out.append(("name", start, end))
    return out


_EVIDENCE: Evidence | None = None


def mentions(texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Mentions of each text, in order."""
    global _EVIDENCE
    m = model()
    if _EVIDENCE is None or _EVIDENCE.w is not m["w"]:
        _EVIDENCE = Evidence(m["w"], m["known"])
    g = Graph(texts, _EVIDENCE)
    labels = infer(g, m["w"], m["chain"], m["skip"])
    by: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i in np.flatnonzero(labels):
        by[g.doc[i]].append((g.a[i], g.b[i], int(labels[i])))
    return [spans(t, x) if x else [] for t, x in zip(texts, by)]


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda x: x[1]):
        if a >= at:
            out += [text[at:a], PLACEHOLDERS[kind]]
            at = b
    return "".join([*out, text[at:]])


def found(chat: DataFrame) -> DataFrame:
    """``entry_id, kind, start_pos`` of each mention; ``start_pos`` counts characters from 1."""
    return located(chat).select("entry_id", "kind", "start_pos")


def located(chat: DataFrame) -> DataFrame:
    """Every mention once, with its length. Contents do not move: repeated deliveries are scanned again and
    their equal mentions merged. Null and empty contents have none; rows without entry_id are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, kind, a + 1, b - a) for key, got in zip(batch["entry_id"], mentions(batch["content"].tolist())) for kind, a, b in got]
            yield pd.DataFrame(rows, columns=["entry_id", "kind", "start_pos", "n_chars"])

    rows = chat.where(F.col("entry_id").isNotNull() & (F.length("content") > 0)).select("entry_id", "content")
    return rows.mapInPandas(run, MENTIONS).distinct()


def redacted(chat: DataFrame) -> DataFrame:
    """Each row's ``entry_id`` and ``content`` with typed placeholders for its mentions, all else unchanged; nulls stay null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch["content"]]
            done = [None if raw is None else redact(t, got) for raw, t, got in zip(batch["content"], texts, mentions(texts))]
            yield pd.DataFrame({"entry_id": batch["entry_id"], "content": done})

    return chat.select("entry_id", "content").mapInPandas(run, "entry_id string, content string")
