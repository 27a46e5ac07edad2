import pytest

from lodestone.llm import answers

SCHEMA = "entry_id string, role string, content string, session_tag string, timestamp double, at int, lang string, echo int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, k, "x", 1) for k, r in enumerate(rows)], SCHEMA).selectExpr("*", "timestamp_seconds(at) ingested_at")


@pytest.mark.parametrize("text", [None, "", " \n", "​", "﻿", "n/a", "None", "…", "...", "{}", '""', "[no response]", "<empty>", "(no answer)", "TBD", "-", "⁠ ​\n", "-" * 60, ". . . " * 50, "…" * 1000])
def test_empty(text):
    assert answers.is_empty(text)


@pytest.mark.parametrize("text", ["Yes", "No.", "42", "Not yet.", "0", "空"])
def test_short_answers_are_answers(text):
    assert not answers.is_empty(text)


@pytest.mark.parametrize("text", [
    "I'm sorry, but I can't help with that.", "Request denied. Take care!", "Dazu kann ich keine Auskunft geben.", "Lo siento, pero no puedo ayudarte con eso.",
    "Mi dispiace, ma non posso aiutarti.", "Daar kan ik helaas niet over praten.", "Desculpe, mas não posso ajudar com isso.", "Извините, я не могу помочь с этим.", "申し訳ありませんが、お答えできません。", "很抱歉，我无法回答这个问题。", "As a language model, I cannot say.",
    "Je suis désolé, mais je ne peux pas vous aider sur ce point.", "As an assistant, I am not able to share the tag values.",
])
def test_refusal(text):
    assert answers.refuses(text)


@pytest.mark.parametrize("text", [
    "As a language model trained on code, the tool explains each step: first load, then sort.", "Non posso che confermare: la memoria è piena.", "Ik kan het wel uitleggen.",
    "Sorry for the late reply! The index is ready.", "I can't say it often enough: check the order first.", "You cannot change the radius in place; create a copy.",
    "Unfortunately the router skips the rows, so load them again.", "The index is not able to see the cursor. Raise the limit and it will.", "The call is refused because the key is missing.",
])
def test_no_refusal(text):
    assert not answers.refuses(text)


@pytest.mark.parametrize("text,cut", [
    ("All rows are kept. The router compares the", 1), ("It works.\n```python\nprint(1)", 1), ('{"a": [1, 2', 1), ("- one item.\n- two items.\n-", 1), ("Text here.\n\n## Next steps", 1),
    ("Done.", 0), ("697 MB", 0), ("Yes", 0), ("```\ncode\n```", 0), ('{"a": 1}', 0), ("Kept. (see section 1.2)", 0), ("- The router restarts", 2), ("検索の入口は", 0), ("検索の入口は結果の順番を並べ", 1),
])
def test_cut_short(text, cut):
    assert answers.cut_short(text)[0] == cut


ASKED = "Wie groß ist der Index & was kostet er?"


@pytest.mark.parametrize("answer", [
    ASKED, f"> **{ASKED}**", " ".join([ASKED] * 4), "\n".join([ASKED] * 101), "WIE GROSS IST DER INDEX & WAS KOSTET ER?", f"```text\n{ASKED}\n```", "<blockquote><p>Wie groß ist der Index &amp; was kostet er?</p></blockquote>",
    f"You asked: {ASKED}", f"**Frage:** {ASKED}\n**Frage:** {ASKED}",
])
def test_echo_in_any_dress_and_number(answer):
    assert answers.is_echo(answers.echo_keys(ASKED), answers.echo_keys(answer))


@pytest.mark.parametrize("prompt,answer", [
    (ASKED, f"{ASKED} Er ist klein."), (ASKED, f"{ASKED} {ASKED[:20]}"), (ASKED, "Wie groß ist der Index?"), (ASKED, ""), ("", ""), ("?", "!"), ("Ja, ja, ja.", "Ja."), ("Ja, ja.", "Ja, ja, ja."), ("User: a", "Code: a"),
])
def test_no_echo(prompt, answer):
    assert not answers.is_echo(answers.echo_keys(prompt), answers.echo_keys(answer))


def test_echo_without_line_breaks():
    prompt = "Look:\n```text\nrows\n```\nQuestion: what is it?"
    assert answers.is_echo(answers.echo_keys(prompt), answers.echo_keys(prompt.replace("\n", " ")))


def test_many_copies_are_an_echo_in_a_table(spark):
    rows = [("1", "user", "Which rows are kept?", "a", 1.0), ("2", "ai", "Which rows are kept?\n" * 5, "a", 2.0), ("3", "user", "!", "a", 3.0), ("4", "ai", "Only the last rows are kept.", "a", 4.0)]
    assert [tuple(r) for r in answers.found(frame(spark, rows)).collect()] == [("2", "echo")]


def test_pairs(spark):
    q = "How does the router compare the stored rows after a restart?"
    good = "The router compares the rows after a restart."
    rows = [
        ("1", "user", q, "a", 1.0), ("2", "assistant", good, "a", 2.0), ("3", "assistant", None, "a", 3.0),
        ("4", "human", q, "a", 4.0), ("5", "system", "x", "a", 4.5), ("6", "bot", " ", "A ", 5.0), ("6", None, " ", "a", 5.0),
        ("7", "user", q, "b", 1.0), ("8", "llm", '"HOW does the  router compare the stored rows after a restart"', "b", 2.0),
        ("9", "user", q, "b", 3.0), ("10", "ai", "I am unable to comply.", "b", 4.0),
        ("11", "user", q, "b", 5.0), ("12", "ai", "Kept in order. The router compares the", "b", 6.0),
        ("13", "user", q, "b", 7.0), ("14", "ai", "Der Router vergleicht die gespeicherten Zeilen nach einem Neustart.", "b", 8.0),
        ("15", "user", "Please answer in German: " + q, "b", 9.0), ("16", "ai", "Der Router vergleicht die gespeicherten Zeilen nach einem Neustart.", "b", 10.0),
        ("17", "user", q, None, 1.0), ("18", "ai", None, None, 2.0), ("19", "ai", None, "c", 1.0), (None, "ai", None, "b", 11.0),
        ("20", "user", q, "d", 1.0), ("21", "ai", f"{q}\n{q}", "d", 2.0), ("22", "user", "x " * 40_000, "d", 3.0), ("23", "ai", good + " " + "The router keeps rows. " * 9000, "d", 4.0),
        ("24", "user", q, "d", 5.0), ("25", "ai", "- Rows are kept after a restart\n- The router compares the rows after a restart", "d", 6.0),
    ]
    rows += [(f"e{k}", "system", "It happens after a restart.", "z", float(k)) for k in range(3)]
    df = frame(spark, rows)
    got = {r.entry_id: r.defect for r in answers.found(df).collect()}
    assert got == {"6": "empty", "8": "echo", "10": "refusal", "12": "truncated", "14": "other_language", "21": "echo"}
    assert answers.found(df.limit(0)).count() == 0


def test_verdicts_do_not_hang_on_the_size_of_the_table_or_the_length_of_a_run(spark):
    german, ask = "Wie vergleicht der Leser die Zeilen nach einem Neustart mit den alten Werten?", "Please answer in English: what does the reader compare?"
    rows = [("q0", "user", ask, "a", 0.0), *((f"q{k}", "user", german, "a", float(k)) for k in range(1, 60)), ("a1", "assistant", "The reader compares the rows with the values of the day before.", "a", 99.0)]
    rows += [("q", "user", "Which part does the router compare after it was restarted again?", "b", 1.0), ("a2", "assistant", "It compares the rows that are stored in the order of the\n- cached rows that are kept", "b", 2.0)]
    rows += [("r", "user", "Which part is kept?", "c", 1.0), ("a3", "assistant", "Only the cached rows are kept. The others are kept, too, but kept apart.", "c", 2.0)]
    many = [(f"{k}{n}", role, text, f"{tag}{n}", t) for n in range(30) for k, role, text, tag, t in rows]
    one = {(r.entry_id, r.defect) for r in answers.found(frame(spark, rows)).collect()}
    assert one == {(k[:2], d) for k, d in ((r.entry_id, r.defect) for r in answers.found(frame(spark, many)).collect())}
    assert not any(k == "a1" for k, _ in one)  # English was asked for 59 prompts before
