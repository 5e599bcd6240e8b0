"""Grammar, model and redaction of personal information."""

import numpy as np
import pytest

from gleaner.llm import pii, pii_grammar, pii_train
from gleaner.llm.pii_model import KINDS, L, LABELS, Model, allowed

SHAPES = {
    "Mail: bristo.k[at]office[dot]hexmoor[dot]example now": ("email", "bristo.k@office.hexmoor.example"),
    "邮箱：LODRA-K＠saltmere.test。": ("email", "lodra-k@saltmere.test"),
    "write to x (at) mail (dot) example please": ("email", "x@mail.example"),
    "Tel: (617) 555-0176 ext. 4": ("phone", "6175550176"),
    "电话：１５４００００１７０５，": ("phone", "15400001705"),
    "+86-199-5550-4231": ("phone", "8619955504231"),
    "Telefon: 030/23125-813": ("phone", "03023125813"),
    "Tél. : 01.99.00.79.79": ("phone", "0199007979"),
    "身份证号：996885-19620402-788X。": ("id_number", "99688519620402788X"),
    "SSN on file: 970 96 1509.": ("id_number", "970961509"),
    "National insurance no. QQ 26 24 55 C.": ("id_number", "QQ262455C"),
    "Pick-up at Flat 3, 118B Harrow Bend Road, Port Lessing": ("address", "118B Harrow Bend Road"),
    "收货地址：石门南路191号5栋": ("address", "石门南路191号"),
    "Adresse : 144 bis rue des Tilleuls, 00420": ("address", "144 bis rue des Tilleuls"),
    "Dirección: Calle Alameda 210, 3.º B": ("address", "Calle Alameda 210"),
    "Abzuholen in Ahornweg 287b, 2. Stock": ("address", "Ahornweg 287b"),
}


@pytest.mark.parametrize("text", SHAPES)
def test_shapes(text):
    assert [(k, v) for _, _, k, v in pii_grammar.candidates(text)] == [SHAPES[text]]


@pytest.mark.parametrize(
    "text",
    ["user@@section", "关注 @青篱小店", "Order no. 840-53-5975 was closed", "Tracking code 20140317082241447190", "运单号 201403170822414471", "Firmware 4.15.0100", "192.0.2.69 on 2014-03-22", "Bus 47 turns near Tollgate Lane", "0001234567890000"],
)
def test_no_shapes(text):
    assert pii_grammar.candidates(text) == []


def test_names():
    at = lambda t, part: pii_grammar.name_at(t, t.index(part), t.index(part) + len(part))[2]
    assert at("Dr. BELLEMIRE, Lomund wrote", "BELLEMIRE, Lomund") == "BELLEMIRE, Lomund"
    assert at("Frau Sarik Granlemire hat", "Frau Sarik Granlem") == "Sarik Granlemire"
    assert at("Posted by Alrik H. Morshaw. We", "Alrik H. Morshaw") == "Alrik H. Morshaw"
    assert at("快递由邹望舒女士代签", "邹望舒女士") == "邹望舒"


def test_gradients():
    m = Model.new("abcdefgh", 6, 5)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 20, (7, 3)).astype(np.int16), np.zeros((7, 3), np.int8)
    y[2, 0], y[3, 0], y[4, 1] = 1, 2, 5
    for k in m.p:
        m.p[k] = m.p[k].astype(np.float64)
    _, g = m.loss_and_gradients(x, y)
    for k in m.p:
        i = (int(x[1, 0]), 2) if k == "emb" else tuple(int(rng.integers(0, s)) for s in m.p[k].shape)
        old = m.p[k][i]
        m.p[k][i] = old + 1e-3
        a, _ = m.loss_and_gradients(x, y)
        m.p[k][i] = old - 1e-3
        b, _ = m.loss_and_gradients(x, y)
        m.p[k][i] = old
        assert abs((a - b) / 2e-3 - g[k][i]) < 1e-4


def test_viterbi_is_the_best_path():
    m = Model.new("abc", 4, 3)
    rng = np.random.default_rng(1)
    m.p["trans"] = rng.normal(size=(L + 1, L)).astype(np.float32)
    e = rng.normal(size=(4, 20, L)).astype(np.float32)
    best = m.viterbi(e)
    trans = m.p["trans"] + allowed()
    import itertools

    for n in range(3):
        score = lambda p: trans[L, p[0]] + sum(e[t, n, p[t]] for t in range(4)) + sum(trans[a, b] for a, b in zip(p, p[1:]))
        assert score(best[:, n]) >= max(score(p) for p in itertools.product(range(L), repeat=4)) - 1e-4


def test_windows_agree_on_a_long_text():
    m = Model.load()
    text = "The lamp was fine. " * 40 + "Posted by Almund Mormolund. " + "The lamp was fine. " * 40 + "Tel: 212-555-0114 "
    found = pii.settle(text, m.spans([text])[0])
    assert [(k, v) for _, _, k, v in found] == [("person", "Almund Mormolund"), ("phone", "2125550114")]


def test_held_out_accuracy():
    make = pii_train.Inventor(99)
    m, hit, all_ = Model.load(), 0, 0
    sentences = [make.sentence() for _ in range(400)]
    for (text, gold), spans in zip(sentences, m.spans([t for t, _ in sentences])):
        for a, b, k in gold:
            all_ += 1
            hit += any(x < b and a < y and said == k for x, y, said in spans)
    assert hit >= 0.9 * all_


def test_forms_without_a_shape_are_found():
    make, m = pii_train.Inventor(98), Model.load()
    for kind, least in (("phone", 0.9), ("email", 0.8), ("id_number", 0.8), ("address", 0.8)):
        patterns = [p for p in pii_train.PATTERNS if p.count("{") == 1 and f"{{{kind}}}" in p]
        texts = [make.r.choice(patterns).replace(f"{{{kind}}}", make.value(kind, pii_train.HELD)) for _ in range(100)]
        assert sum(any(k == kind for _, _, k in s) for s in m.spans(texts)) >= least * 100


@pytest.mark.parametrize("kind, text, value", [
    ("email", "xenia <at> somoel <dot> com", "xenia@somoel.com"), ("phone", "+41 79 555 01 02", "41795550102"),
    ("id_number", "297.929.478-22", "29792947822"), ("address", "Rua das Flores, 67", "Rua das Flores, 67"),
])
def test_a_span_without_a_shape_keeps_its_ends(kind, text, value):
    assert pii.settle(f"So: {text}. Then", [(4, 4 + len(text), kind)])[-1][2:] == (kind, value)


def test_pieces_give_the_path_of_the_whole_text():
    m, make = Model.load(), pii_train.Inventor(5)
    text = " ".join(make.sentence()[0] for _ in range(60))
    whole = m.viterbi(m.blended([m.alphabet.ids(text)])[0][:, None, :])[:, 0]
    assert len(text) > 1500 and (m.label([text])[0] == whole).all()


def test_onnx_graph_equals_numpy():
    a, b = Model.load(), Model.load()
    b.ready = True  # no session: numpy
    x = np.random.default_rng(3).integers(0, 200, (50, 7)).astype(np.int16)
    assert np.abs(a.emissions(x) - b.emissions(x)).max() < 0.2


def test_found_and_redacted(spark):
    card = "\nContact card\nName: Torvald Granmocorth\nPhone: 07700 900674\nMail: x.y@saltmere.test\nAddress: 13 Larkspur Avenue\n"
    rows = [(1, card + card, "e"), (2, None, "e"), (3, "", "e"), (4, "no names here", "e"), (5, "中" * 50000, "e"), (1, card, "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    got = {tuple(x) for x in pii.find(df).collect()}
    assert got == {(1, "person", "Torvald Granmocorth"), (1, "phone", "07700900674"), (1, "email", "x.y@saltmere.test"), (1, "address", "13 Larkspur Avenue")}
    out = {x.doc_id: x.text for x in pii.redacted(df).filter("doc_id > 1").collect()}
    assert out == {2: None, 3: "", 4: "no names here", 5: "中" * 50000}
    one = pii.redacted(df.filter("doc_id = 1").limit(1)).first().text
    assert one == "\nContact card\nName: [PERSON]\nPhone: [PHONE]\nMail: [EMAIL]\nAddress: [ADDRESS]\n" * (one.count("card"))
    assert pii.find(df.limit(0)).collect() == []


def test_labels():
    assert len(LABELS) == 1 + 2 * len(KINDS)
