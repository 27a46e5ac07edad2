import numpy as np
import pytest

from lodestone.llm import languages

EN = "The audit log counts the stored rows. The router keeps the order of the results."
DE = "Der Router prüft die Reihenfolge der Ergebnisse. Das Protokoll zählt die gespeicherten Zeilen."
FR = "Le routeur vérifie l'ordre des résultats. Le journal compte les lignes enregistrées."
RU = "Второй узел сравнивает список кандидатов. Кэш проверяет копию схемы."
JA = "キャッシュは結果の順番を読み取ります。検索の入口は重複したキーを飛ばします。"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, parts string, scores int")


def test_found_and_labels(spark):
    rows = [
        (1, EN, "en-US", "a/b"), (2, DE, None, "a/b"), (3, FR, "de", None), (4, EN + "\n\n" + DE, "en", "a/b"), (5, RU, "rus", "c"), (6, JA, "zh", "c"),
        (7, "0.1, 0.2, 0.3\n1;2;3", "en", "c"), (8, None, "en", "c"), (9, "", None, "c"), (10, " ​ ", None, "c"),
        (11, EN + " (les réponses gardées en mémoire)\n```\nselect a, count(*) from lane group by a\n```", "English", "c"), (12, "# Notes on the stop words", "xx", "c"),
        (None, EN, "de", "c"), (13, (EN + " ") * 400, "und", "c"), (13, (EN + " ") * 400, "und", "c"),
    ]
    df = frame(spark, rows)
    got = sorted((r.doc_id, r.issue, r.lang_found) for r in languages.found(df).collect())
    assert got == [(2, "missing", "de"), (3, "wrong", "fr"), (4, "mixed", "de"), (4, "mixed", "en"), (6, "wrong", "ja"), (12, "missing", "en"), (13, "missing", "en")]
    parts = {}
    for r in languages.labels(df).collect():
        parts.setdefault(r.doc_id, []).append(r)
    assert sorted(parts) == list(range(1, 14))
    four = sorted(parts[4], key=lambda r: r.part_no)
    assert [p.lang for p in four] == ["en", "de"] and all(p.confidence > 0.9 for p in four)
    text = EN + "\n\n" + DE
    assert text[four[1].start_pos - 1 :].strip() == DE
    assert parts[7][0].lang is None and parts[8][0].confidence == 0.0
    assert languages.found(df.limit(0)).count() == 0


def test_held_out_accuracy():
    texts = {"en": EN, "de": DE, "fr": FR, "ru": RU, "ja": JA, "nl": "De router bewaart de volgorde van de resultaten. Het logboek telt de regels.", "it": "Il router conserva l'ordine dei risultati. Il registro conta le righe salvate.", "pt": "O roteador mantém a ordem dos resultados. O registro conta as linhas gravadas.", "es": "El enrutador guarda el orden de los resultados. El registro cuenta las filas guardadas."}
    spans, nats, words, bearing = languages.likelihoods(list(texts.values()))
    sizes = np.array([len(x) for x in spans])
    whole, each = languages.posteriors(nats, sizes, np.zeros((len(texts), len(languages.LANGS))))
    assert [languages.LANGS[int(k)] for k in whole.argmax(axis=1)] == list(texts)
    assert sizes.tolist() == [2] * len(texts) and bearing.all() and (each.argmax(axis=1) == np.repeat(whole.argmax(axis=1), 2)).all()


@pytest.mark.parametrize("text", ["Другий вузол порівнює список кандидатів. Кеш перевіряє копію схеми.", "缓存读取结果的顺序。搜索入口跳过重复的键。", "Router sprawdza kolejność wyników. Dziennik liczy zapisane wiersze każdego dnia.", "يقارن الموجه ترتيب النتائج. يحسب السجل الصفوف المخزنة."])
def test_languages_that_the_model_does_not_know(text):
    spans, nats, _, _ = languages.likelihoods([text])
    whole, _ = languages.posteriors(nats, np.array([len(spans[0])]), np.zeros((1, len(languages.LANGS))))
    assert languages.LANGS[int(whole.argmax())] == "other"


def test_parts_tile_a_mixed_text_and_agree_with_found(spark):
    text = "# 0.17.0\n\n" + EN + "\n\n12345\n\n" + DE + "\n\n```\nx = 1\n```\n" + EN + "\n--"
    df = frame(spark, [(1, text, "en", "a/b"), (2, "Ok.", "de", "a/b"), (3, DE, "en", "x.de/y")])
    parts = sorted((r.start_pos, r.n_chars, r.lang) for r in languages.labels(df).where("doc_id = 1").collect())
    assert [p[2] for p in parts] == ["en", "de", "en"]
    assert parts[0][0] == 1 and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][0] + parts[-1][1] == len(text) + 1
    one = {r.doc_id: r.lang for r in languages.labels(df).where("doc_id > 1").collect()}
    assert one == {2: None, 3: "de"} and [(r.issue, r.lang_found) for r in languages.found(df).where("doc_id = 3").collect()] == [("wrong", "de")]


def test_a_doubtful_segment_takes_the_language_that_the_document_speaks_for():
    nats = np.full((3, len(languages.LANGS)), -9.0)
    nats[:2, 1], nats[2, 1], nats[2, 6] = 0, -0.4, 0
    _, each = languages.posteriors(nats, np.array([3]), np.zeros((1, len(languages.LANGS))))
    assert each[2].argmax() == 1
    nats[2, 1] = -9
    assert languages.posteriors(nats, np.array([3]), np.zeros((1, len(languages.LANGS))))[1][2].argmax() == 6
