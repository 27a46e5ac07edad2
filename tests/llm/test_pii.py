import numpy as np
import pytest

from lodestone.llm import pii


@pytest.mark.parametrize("text,want", [
    ("Send the report to henrik-lunlund@hq.invalid, thanks.", [("email", "henrik-lunlund@hq.invalid")]),
    ("Merci d'écrire à leila.quellund [at] inbox [dot] example.", [("email", "leila.quellund [at] inbox [dot] example")]),
    ("Please call Marta Ibbstad on +34 900 002 246 before noon.", [("name", "Marta Ibbstad"), ("phone", "+34 900 002 246")]),
    ("Passport number QQ 07 00 85 B was used for the check.", [("id_number", "QQ 07 00 85 B")]),
    ("The ID 00 937 688 139, phone (303) 555-0124, is new.", [("id_number", "00 937 688 139"), ("phone", "(303) 555-0124")]),
    ("Contact: mailto:ravi.galdmera@post.test / tel:+1-606-555-0107 ext. 85", [("email", "ravi.galdmera@post.test"), ("phone", "+1-606-555-0107 ext. 85")]),
    ("Madame Straquist, Nadia l'a signalé hier.", [("name", "Straquist, Nadia")]),
    ("cc: Quelanova, Ravi, Amara Perenberg", [("name", "Quelanova, Ravi"), ("name", "Amara Perenberg")]),
    ("attention priya askwick.", [("name", "priya askwick")]),
    ("Frau Bruno van Ostault hat das gestern gemeldet.", [("name", "Bruno van Ostault")]),
    ("The contract was signed by H. Fenmera, who lives at Flat 4, 32 Harrowgate Drive, Uppvik, 00946.", [("name", "H. Fenmera"), ("address", "Flat 4, 32 Harrowgate Drive, Uppvik, 00946")]),
    ("meine Adresse lautet Rosenangergasse 116, 00934 Kestermond.", [("address", "Rosenangergasse 116, 00934 Kestermond")]),
    ("Order 5606-7607 is unrelated. Epoch 1690002674 is when it broke. Batch number 42475523 was replayed.", []),
    ("Node 192.0.2.25 answers on port 3451. The client is pinned to pkg@7.1.5. Filter used: @genre:{fiction}.", []),
    ("Nearest Neighbour Search stays on. Project Silver Heron and Amber Ledger share the index.", []),
])
def test_mentions(text, want):
    got = pii.mentions([text])[0]
    assert [(k, text[a:b]) for k, a, b in got] == want


@pytest.mark.parametrize("text,want", [
    ("My name is Bartholomew Featherstonehaugh.", [("name", "Bartholomew Featherstonehaugh")]),
    ("Dear Mr Okonkwo, thank you.", [("name", "Okonkwo")]),
    ("Priya Raghunathan and Wojciech Szczepański agreed.", [("name", "Priya Raghunathan"), ("name", "Wojciech Szczepański")]),
    ("Меня зовут Иван Кузнецов.", [("name", "Иван Кузнецов")]),
    ("Her social security number is 123-45-6789.", [("id_number", "123-45-6789")]),
    ("My passport X1234567 expires.", [("id_number", "X1234567")]),
    ("Abito in Via Roma 15, 00184 Roma.", [("address", "Via Roma 15, 00184 Roma")]),
    ("Moro na Rua das Flores 22, 1200-195 Lisboa.", [("address", "Rua das Flores 22, 1200-195 Lisboa")]),
    ("They live at 12 Baker Street, and like it.", [("address", "12 Baker Street")]),
    ("We use Kubernetes and Postgres in Berlin. Order 123-45-6789 shipped.", []),
])
def test_names_numbers_and_streets_outside_the_training_texts(text, want):
    got = pii.mentions([text])[0]
    assert [(k, text[a:b]) for k, a, b in got] == want


def test_recall_on_unseen_mentions():
    from lodestone.llm import train_pii

    for kind, (precision, recall, n) in train_pii.unseen(10).items():
        assert precision >= 0.85 and recall >= 0.8 and n >= 20, kind


def test_long_texts_take_time_in_proportion():
    import time

    part = "Order 12-34-56-78 of Brandonia Wexley went to node 7 on Kelverine. "
    took = []
    for n in (500, 4000):
        start = time.process_time()
        pii.mentions([part * n])
        took.append(time.process_time() - start)
    assert took[1] < 20 * max(took[0], 0.05)


def test_skip_edges_make_labels_agree():
    """A word that context leaves open takes the label of its clear repetition."""
    w = np.zeros((pii.DIMS, 7), "float32")
    g = pii.Graph([], pii.Evidence(None, np.zeros(pii.KNOWN_BITS, bool)))
    g.n, g.kinds = 2, np.array([0, 0])
    g.features = np.array([[1] * 22, [2] * 22], "int32")
    g.chain, g.skip = np.zeros((0, 3), "int64"), np.array([[0, 1]])
    w[1, pii.GIVEN], w[2, pii.O] = 0.3, 0.05
    skip = np.eye(7, dtype="float32") * 2
    assert pii.infer(g, w, np.zeros((pii.GAPS, 7, 7), "float32"), skip).tolist() == [pii.GIVEN, pii.GIVEN]
    assert pii.infer(g, w, np.zeros((pii.GAPS, 7, 7), "float32"), 0 * skip).tolist() == [pii.GIVEN, pii.O]


def test_operator(spark):
    long = "The router counts rows. " * 20_000 + "Please call Marta Ibbstad on +34 900 002 246."
    rows = [("a", "Hi Leila, all done.", 1, "x"), ("a", "Hi Leila, all done.", 2, "x"), ("b", None, 1, "x"), ("c", "", 1, "x"), (None, "Hi Leila, all done.", 1, "x"), ("d", long, 1, "x"), ("e", "🙂é Hi Leila, bye", 1, "x")]
    df = spark.createDataFrame(rows, "entry_id string, content string, start_pos int, kind string")
    got = sorted((r.entry_id, r.kind, r.start_pos) for r in pii.found(df).collect())
    assert got == [("a", "name", 4), ("d", "name", long.index("Marta") + 1), ("d", "phone", long.index("+34") + 1), ("e", "name", 7)]
    red = [(r.entry_id, r.content) for r in pii.redacted(df).collect()]
    assert ("a", "Hi [NAME], all done.") in red and ("b", None) in red and ("c", "") in red and len(red) == 7
    assert pii.found(df.limit(0)).count() == 0
