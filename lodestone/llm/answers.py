"""Problem 3: broken prompt and response pairs.

Method: ordered rules for emptiness, copied prompts, multilingual refusals, unclosed delimiters and abrupt
endings, and language mismatch. Every rule is tried on every pair and all triggered defects come out;
``found`` gives the first.

Texts are read once, where they lie: each message becomes a small row of facts (hashes, flags, languages),
and only these rows are put in order, see ``OrderedScan``. Whether an ending without a full stop is abrupt
is told by how often its last word ends a sentence among all its occurrences in the table, whatever its size.
"""

from __future__ import annotations

import hashlib
import html
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import langid
from lodestone.llm import messages as M
from lodestone.llm.langid import LANGS
from lodestone.plans.physical import OrderedScan, bounded_broadcast, stage_table

#: The order of the rules (fixed values).
DEFECTS = ["empty", "echo", "refusal", "truncated", "other_language"]

#: What stands for no answer, in lower case without brackets and marks (fixed values).
STAND_INS = {"", "na", "none", "null", "nil", "undefined", "tbd", "todo", "noanswer", "noresponse", "empty", "nan", "noreply", "noresult", "blank", "placeholder", "void", "keineantwort", "sansreponse", "sinrespuesta"}

#: First-person declining, by language, in lower case; each begins at a word (fixed values).
_DECLINING = (
    # English
    r"i(?: am|['’]m)(?: sorry,? but i(?: am|['’]m))? (?:not (?:able|permitted|allowed)|unable) to (?:\w+ ){0,2}(?:share|comply|help|assist|answer|discuss|talk|give|provide|say|respond)"
    r"|i (?:can(?:not|['’]t)|won['’]t be able to|could not|am not able to|will not|must not) (?:\w+ ){0,2}(?:help|assist|do that|comply|discuss|share|answer|provide|talk about)"
    r"|i (?:do not|don['’]t) have permission|(?:something|this|that) i have to decline|i(?: must|['’]d have to| have to| need to) (?:decline|refuse)"
    r"|guidelines (?:do not|don['’]t) (?:allow|permit)|falls? outside of what i may|request (?:denied|goes against)|no answer can be given"
    r"|i(?:['’]d| would) rather not (?:answer|say|discuss)|not a topic i|provid\w+ that would not be appropriate|as (?:a language model|an ai(?: \w+)?),? i (?:have no|cannot|can['’]t|do not|don['’]t|am (?:not|unable)|will not|won['’]t|must)\b|talk about something else instead"
    r"|as an assistant, i am not\b"
    # German
    r"|(?:dabei|damit) kann ich (?:\w+ ){0,2}nicht helfen|darf ich (?:\w+ ){0,3}nicht beantworten|vorgaben erlauben (?:\w+ ){0,2}nicht|kann ich keine auskunft|kann ich (?:\w+ ){0,3}nicht beantworten|muss ich (?:\w+ ){0,3}ablehnen"
    r"|ich (?:kann|darf) (?:\w+ ){0,5}nicht (?:helfen|beantworten|sprechen)"
    # French
    r"|je ne (?:peux|puis) (?:pas|malheureusement pas) (?:\w+ ){0,2}(?:aider|répondre|faire|parler)|ne suis pas (?:autorisée?|en mesure) (?:à|de)|consignes m['’]interdisent|je (?:dois|suis obligée? de) (?:décliner|refuser)"
    # Spanish
    r"|no (?:puedo|podré) (?:ayudar|responder|contestar|hacer)\w*|no me permiten|no tengo permiso|debo rechazar|no (?:estoy|se me) (?:autorizad|permite)"
    # Italian
    r"|non (?:posso|sono in grado di|mi è permesso|mi è consentito) (?:purtroppo )?(?:aiutar|rispondere|farlo|fornire|discutere|parlare)|devo (?:declinare|rifiutare)|mi dispiace,? ma non posso"
    # Dutch
    r"|(?:kan|mag|zal) ik (?:\w+ ){0,4}niet (?:helpen|beantwoorden|bespreken|delen|over praten)|ik (?:kan|mag) (?:\w+ ){0,5}niet (?:helpen|beantwoorden|bespreken|delen)|moet ik (?:\w+ ){0,3}(?:weigeren|afwijzen)"
    # Portuguese
    r"|não (?:posso|consigo|estou autorizad[oa] a|me é permitido) (?:\w+ ){0,1}(?:ajudar|responder|fazer|fornecer|discutir|falar|partilhar|compartilhar)|(?:tenho de|devo|preciso) recusar|desculpe,? mas não posso"
    # Russian
    r"|я не (?:могу|вправе|имею права|буду) (?:\w+ ){0,3}(?:помочь|помогать|отвечать|ответить|обсуждать|предоставить|делиться)|не могу (?:\w+ ){0,2}(?:помочь|ответить на)|(?:вынужден|вынуждена) отказать"
)
#: The same without spaces between words: Japanese, Chinese (fixed values).
_DECLINING_CJK = (
    r"(?:お答え|回答|お手伝い|対応|提供)(?:する(?:こと|の)は|は)?(?:でき(?:ません|かねます)|いたしかねます)|お断り(?:し|いた)|(?:我|很抱歉|抱歉).{0,8}(?:无法|不能|不可以)(?:回答|帮助|提供|协助|讨论)"
)
_REFUSAL, _REFUSAL_CJK = re.compile(rf"\b(?:{_DECLINING})"), re.compile(_DECLINING_CJK)


def refuses(text: str) -> bool:
    low = text.lower()
    return bool(_REFUSAL.search(low)) or not text.isascii() and bool(_REFUSAL_CJK.search(text))


#: Requests for a language, and the languages they name (fixed values).
ASKS = re.compile(
    r"(?i)\b(?:in|into|to|auf|ins|en|al|a|in het|em|per)\s+(english|german|french|spanish|italian|dutch|portuguese|russian|japanese|englisch|englische|deutsch|französisch|spanisch|italienisch|"
    r"anglais|allemand|français|espagnol|italien|inglés|ingles|alemán|aleman|francés|frances|español|espanol|italiano)\b"
)
ASKED = {"en": "english englisch englische anglais inglés ingles", "de": "german deutsch allemand alemán aleman", "fr": "french französisch français francés frances", "es": "spanish spanisch espagnol español espanol", "it": "italian italienisch italien italiano", "nl": "dutch", "pt": "portuguese", "ru": "russian", "ja": "japanese"}
ASKED_LANG = {w: LANGS.index(k) for k, ws in ASKED.items() for w in ws.split()}

TERMINAL = re.compile(r"[.!?…。！？][\"'”’»)\]*_`]*$|```$|[)\]}>]$|[|]$|[\"”»]$")
LIST_ITEM = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s+")
HEADING = re.compile(r"^\s*#{1,6}\s+\S")
LABELLED = re.compile(r"(?:^|[.!?…]\s+)(?:cc|From|To|Tel|Address|Customer|Contact|Cheers|Thanks|Regards|Viele Grüße|Cordialement|Saludos)\b[:.,]*\s[^.!?…]*$", re.I)
FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
#: What a copied prompt can be wrapped in (fixed values).
TAG = re.compile(r"</?(?:p|br|hr|b|i|u|q|em|strong|cite|blockquote|code|pre|div|span|ul|ol|li|h[1-6])(?:\s[^<>]*)?/?>", re.I)
FENCE_OPEN = re.compile(r"(^|\n)[ \t>]*```[\w+#.-]*(?=[ \t\r]*\n)")
LABEL = re.compile(
    r"^[^\w\n]*(?:(?:you|the user|user) (?:asked|said|wrote)|(?:your|the|original) (?:question|prompt|message|request)(?: was| is)?|question|prompt|user|human|quote|q|re"
    r"|(?:sie|du) (?:fragten|fragtest|schrieben|schriebst)|(?:ihre|deine) (?:frage|nachricht)(?: war| lautet(?:e)?)?|frage|zitat"
    r"|vous avez (?:demandé|écrit)|votre question(?: était)?|(?:usted )?(?:preguntó|preguntaste|escribió)|(?:su|tu) pregunta(?: era)?|pregunta|hai (?:chiesto|scritto)|la tua domanda(?: era)?|domanda"
    r"|(?:u vroeg|je vroeg)|(?:uw|je) vraag(?: was)?|vraag|você perguntou|(?:sua|a tua) pergunta(?: era)?|pergunta|вы спросили|ваш вопрос|вопрос|質問|ご質問|ユーザー)\b[^\w\n:：]*[:：]",
    re.I | re.M,
)
EDGE = " \u00a0\t\r\n\u2028\u2029\u200b\u200c\u200d\u2060\ufeff"

#: Words and nats from which a text has a language of its own.
LANG_WORDS, LANG_NATS = 4, 6.0
#: A sentence can end in a word if at least so many of its occurrences, out of all, stand right before a full stop.
END_SHARE = 0.02

FACTS = "entry_id string, role string, session_tag string, t double, ingested_at timestamp_ntz, empty boolean, refusal boolean, cut int, last_word string, echo array<binary>, lang int, asked array<int>"
VERDICT = "entry_id string, empty boolean, echo boolean, refusal boolean, cut int, last_word string, other_language boolean"


def bare(text: str) -> str:
    """Letters and digits only, without case and accents."""
    if text.isascii():
        text = text.lower()
    else:
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    return "".join(filter(str.isalnum, text))


#: Bytes of the digest of an echo key.
DIGEST = 16


def undressed(text: str) -> str:
    """Without what a text can be wrapped in: tags and entities, the language of a code fence, a label at the start of a line."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = TAG.sub(" ", text)
    if "```" in text:
        text = FENCE_OPEN.sub(r"\1", text)
    if ":" in text or "：" in text:
        text = LABEL.sub("", text)
    return text


def echo_keys(text: str) -> list[bytes]:
    """One key for the bare text and one for the undressed text, where they differ: a digest of the shortest text that it is a
    repetition of, and how often it says that. 128 bits of a cryptographic hash stand for the text, which is not moved.
    """
    keys, plain = [], undressed(text)
    for b in dict.fromkeys((bare(text), bare(plain))) if plain != text else (bare(text),):
        if b:
            unit = (b + b).find(b, 1)
            keys.append(hashlib.blake2b(b[:unit].encode(), digest_size=DIGEST).digest() + (len(b) // unit).to_bytes(8))
    return keys


def is_echo(prompt: Iterable[bytes], answer: Iterable[bytes]) -> bool:
    """Whether the answer is its prompt again, once or any number of times."""
    pairs = itertools.product(prompt, answer)
    return any(p[:DIGEST] == a[:DIGEST] and int.from_bytes(a[DIGEST:]) % int.from_bytes(p[DIGEST:]) == 0 for p, a in pairs)


def is_empty(text: str | None) -> bool:
    """Blank, or only a stand-in for nothing."""
    if text is None:
        return True
    # the longest stand-in has few letters; marks and what cannot be seen do not count however many they are
    letters = list(itertools.islice(filter(str.isalnum, text), 41))
    return len(letters) <= 40 and bare("".join(letters)) in STAND_INS


def cut_short(text: str) -> tuple[int, str | None]:
    """(1, None): breaks off; (0, None): complete; (2, word): it hangs on whether a sentence can end in ``word``."""
    t = text.strip(EDGE)
    if not t:
        return 0, None
    if t.count("```") % 2:
        return 1, None
    if t[0] in "[{" and t[:2] != "[[":
        try:
            json.loads(t)
            return 0, None
        except ValueError:
            if t[-1] not in "]}" or t.count("{") > t.count("}") or t.count("[") > t.count("]"):
                if '"' in t[:3] or t[1:2] in '{"[':
                    return 1, None
    prose = FENCE.sub("```", t)
    line = prose.rsplit("\n", 1)[-1].rstrip()
    if line.count("(") > line.count(")") or line.count("[") > line.count("]"):
        return 1, None
    if not LIST_ITEM.sub("", line + " ").strip() or (HEADING.match(line) and "\n" in t):
        return 1, None
    if TERMINAL.search(line) or LABELLED.search(line):
        return 0, None
    if line[-1] in ",;:-–—/&=+" and len(line) > 12:
        return 1, None
    if langid.KANA.search(line):
        return 1 if len(line) > 6 else 0, None
    item = LIST_ITEM.match(line)
    if line[-1].isdigit() or "|" in line or "@" in line.split()[-1]:
        inner = re.search(r"[.!?…]\s+[A-ZÄÖÜÀ-Þ¿¡][^.!?…]*$", line)
        return (1 if inner and not item and len(inner.group().split()) > 3 else 0), None
    words = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", line)
    if not words:
        return 0, None
    if not item and re.search(r"[.!?…][\"')\]]*\s+[A-ZÄÖÜÀ-Þ¿¡]\S*(?:\s+\S+)+$", line):
        return 1, None
    if len(words) < 4 and not item and ("\n" not in t or all(w[0].isupper() for w in words)):
        return 0, None
    return 2, words[-1].lower()


def facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t or "" for t in batch["content"]]
        answer = (batch["role"] == "assistant").to_numpy()
        code = [FENCE.sub(" ", t) if "```" in t else t for t in texts]
        sc, n = langid.text_scores(code)
        order = np.sort(sc, axis=1)
        lang = np.where((n >= LANG_WORDS) & (order[:, -1] - order[:, -2] >= LANG_NATS), sc.argmax(axis=1), -1)
        japanese = sc[:, 8] > 10
        lang = np.where(japanese & (sc.argmax(axis=1) == 8), 8, lang)
        rows = []
        for t, raw, a in zip(texts, batch["content"], answer):
            if a:
                empty = is_empty(raw)
                cut, word = (0, None) if empty else cut_short(t)
                rows.append((empty, not empty and refuses(t), cut, word, echo_keys(t), []))
            else:
                asked = sorted({ASKED_LANG[m.lower()] for m in ASKS.findall(t)})
                rows.append((False, False, 0, None, echo_keys(t), asked))
        made = pd.DataFrame(rows, columns=["empty", "refusal", "cut", "last_word", "echo", "asked"])
        keep = batch[["entry_id", "role", "session_tag", "t", "ingested_at"]].reset_index(drop=True)
        yield pd.concat([keep, made.assign(lang=lang.astype("int32"))], axis=1)[[x.split()[0] for x in FACTS.split(", ")]]


NO_RUN = {"last": None, "only": True, "echo": (), "lang": -1, "asked": frozenset()}


def _step(s: dict, user: bool, echo: np.ndarray, lang: int, asked: np.ndarray) -> dict:
    """The state after one more message: the run of prompts that is open, as far as an answer needs it."""
    if not user:
        return {**s, "last": "assistant", "only": False}
    if s["last"] == "user":
        return {**s, "echo": tuple(echo), "lang": int(lang) if lang >= 0 else s["lang"], "asked": s["asked"] | frozenset(asked)}
    return {"last": "user", "only": s["only"] and s["last"] is None, "echo": tuple(echo), "lang": int(lang), "asked": frozenset(asked)}


def _fold(state: dict | None, rows: pd.DataFrame) -> dict:
    s = state or NO_RUN
    for role, echo, lang, asked in zip(rows["role"], rows["echo"], rows["lang"], rows["asked"]):
        s = _step(s, role == "user", echo, lang, asked)
    return s


def _merge(a: dict, b: dict) -> dict:
    if b["last"] is None or a["last"] is None:
        return a if b["last"] is None else b
    if b["only"] and a["last"] == "user":
        return {**b, "only": a["only"], "lang": b["lang"] if b["lang"] >= 0 else a["lang"], "asked": a["asked"] | b["asked"]}
    return {**b, "only": False}


def _pairs(rows: pd.DataFrame, n: int, position: np.ndarray, state: dict | None) -> tuple[pd.DataFrame, dict]:
    """Verdicts of the assistant messages that directly follow a prompt."""
    at, copied, foreign, tag = [], [], [], None
    columns = zip(rows["session_tag"], rows["role"], rows["echo"], rows["lang"], rows["asked"])
    for i, (group, role, echo, lang, asked) in enumerate(columns):
        if i < n:
            continue
        if tag is not None and group != tag:
            state = None
        tag = group
        if role != "user" and state and state["last"] == "user":
            at.append(i)
            copied.append(is_echo(state["echo"], echo))
            foreign.append(state["lang"] >= 0 and lang >= 0 and lang != state["lang"] and lang not in state["asked"])
        state = _step(state or NO_RUN, role == "user", echo, lang, asked)
    out = rows.iloc[at][["entry_id", "empty", "refusal", "cut", "last_word"]]
    return out.assign(echo=np.array(copied, bool), other_language=np.array(foreign, bool))[[x.split()[0] for x in VERDICT.split(", ")]], state


def sentence_ends(chat: DataFrame, words: DataFrame) -> DataFrame:
    """``last_word, ends, all`` for each of ``words``: its occurrences right before a full stop, and all, over all rows."""
    said = F.regexp_extract_all(F.lower("content"), F.lit(r"(\p{L}+(?:['’-]\p{L}+)*(?:[.!?…](?=[\"')\]]*(?:\s|$)))?)"), 1)
    bare_ = F.rtrim(F.col("w"), F.lit(".!?…"))
    each = chat.select(F.explode(said).alias("w")).select(bare_.alias("last_word"), (F.length(bare_) < F.length("w")).alias("ended"))
    return each.join(words, "last_word", "left_semi").groupBy("last_word").agg(F.sum(F.col("ended").cast("long")).alias("ends"), F.count("*").alias("all"))


#: A table of last words of at most so many rows is broadcast.
END_WORDS = 500_000


def defects(chat: DataFrame) -> DataFrame:
    """``entry_id, defect, first`` for every defect of every pair; ``first`` marks the first in order.

    Input: entry_id, role, content, session_tag, timestamp, ingested_at; other columns are ignored. A pair is a run
    of user messages and the assistant message right after it; messages of other roles and without session
    tag are left aside. Null content is blank. Repeated rows of one entry_id count once; rows without
    entry_id are dropped. A conversation without pairs, and an empty table, give no rows.
    """
    rows = chat.select(
        "entry_id", M.clean_role(F.col("role")).alias("role"), M.clean_tag(F.col("session_tag")).alias("session_tag"),
        M.clean_time(F.col("timestamp"), F.col("entry_id")).alias("t"), F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "content",
    ).where(F.col("role").isin("user", "assistant") & F.col("session_tag").isNotNull() & F.col("entry_id").isNotNull())
    columns = ["session_tag", "t", "empty", "refusal", "cut", "last_word", "echo", "lang", "asked"]
    one = M.one_per_entry(rows.mapInPandas(facts, FACTS), columns).withColumn("rank", M.role_rank(F.col("role")))
    order = ["t", "rank", "entry_id"]
    keys = rows.select("session_tag", "t", M.role_rank(F.col("role")).alias("rank"), "entry_id")
    judged = stage_table(OrderedScan(one, "session_tag", order, keys=keys).map(_pairs, VERDICT, _fold, _merge))
    words = bounded_broadcast(judged.where("last_word IS NOT NULL").select("last_word").distinct(), END_WORDS)
    can_end = sentence_ends(chat, words).where(F.col("ends") >= END_SHARE * F.col("all")).select("last_word", F.lit(True).alias("can_end"))
    # a null join key would send all rows without a word to one task
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("entry_id"), F.lit(997)).cast("string"))
    judged = judged.withColumn("last_word", F.coalesce("last_word", spread))
    judged = judged.join(bounded_broadcast(can_end, END_WORDS), "last_word", "left")
    truncated = (F.col("cut") == 1) | ((F.col("cut") == 2) & F.col("can_end").isNull())
    flags = [F.col("empty"), F.col("echo") & ~F.col("empty"), F.col("refusal"), truncated, F.col("other_language")]
    listed = F.filter(F.array(*[F.when(f, F.lit(name)) for f, name in zip(flags, DEFECTS)]), lambda x: x.isNotNull())
    every = judged.select("entry_id", F.posexplode(listed).alias("k", "defect"))
    return every.select("entry_id", "defect", (F.col("k") == 0).alias("first"))


def found(chat: DataFrame) -> DataFrame:
    return defects(chat).where("first").select("entry_id", "defect")
