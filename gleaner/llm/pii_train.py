"""Training of the personal-information model: python -m gleaner.llm.pii_train DOCUMENTS.parquet.

Labelled spans come from two places. A bounded sample of documents (--rows, 4000 by default,
drawn by the hash of doc_id) gives contexts: values are labelled by shapes, names by plain cues
and, with --start, by an earlier model (self-training). Sentences of the patterns below are filled
with invented values. In every drawn window most values of documents are exchanged for invented
ones of the kind, in forms of many countries, more than the grammar knows, so that context and
shape are learned rather than values. The forms of HELD are never used in training; the report
gives the share of them that is found, and the figures on a tenth of the documents held out.
"""

from __future__ import annotations

import argparse
import random
import re
import time
from collections import Counter

import numpy as np

from gleaner.llm.pii_grammar import KINDS, candidates, fold, name_at
from gleaner.llm.pii_model import WEIGHTS, Model

_W = r"[A-ZÀ-ÖØ-Þ][\w'’]+(?:-[A-ZÀ-Þ][\w'’]+)*"
_N = rf"({_W}, {_W}(?: [A-Z]\.)?|{_W}(?: [A-Z]\.)?(?: {_W}))"
# Cues after which a name stands.
CUES = [
    rf"(?:Name|Nom|Nombre|Nome|Seller|Contact|Author|Vendeur|Vendedor|Autor|Autore) ?: {_N}",
    rf"(?:Frau|Herr|Dr\.|Mme|Mr\.|Mrs\.|Ms\.|Señora?) {_N}",
    r"(?:姓名：|联系人：|收件人：|卖家：|作者：)([一-鿿]{2,3}?)(?=\n|。|，|先生|女士)",
]

# Syllables and characters of invented names.
_SYLL = "al an ar be bo bri ca cor da del do el en er fa fen gal gri ha hel in is ja ka kel la len lo ma mar mo na nor ol or pa per qui ra ren ro sa sel so ta ter to ul ur va ven vi wa wen yo za zi".split()
_ENDS = "a e o an en in ik el or us ia is ard ert ulf mund rik vane shaw worth ley ton berg mann sen ski ova ez dale croft".split()
_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤闻柯祁褚纪俞"
_GIVEN = "伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂英华玉萍红娥玲芬燕彩春兰凤洁梅琳素云莲真环雪荣爱妹香月莺媛瑞凡佳嘉琼勤珍贞莉晚棠砚秋望舒清遥舟行知岸怀瑾若禾景澜予乔攸宁疏影叙白漱石栖梧昭野问渠霁岚朗"
_STREETS = "Maple Alder Birch Copper Lantern Orchard Saddler Chapel Weaver Foundry Meadow Tanner Miller Harbour Station Castle Bishop Garden".split()
_TYPES = "Street St Road Lane Avenue Terrace Row Steps Blvd Pkwy Court Way Close Drive".split()

# Patterns of sentences; {x} is filled with an invented value of the kind.
PATTERNS = """
Best regards,⏎{person}
Signed: {person}
Written by {person} for the weekly page.
My name is {person} and I live at {address}.
Please call {person} on {phone} before noon.
{person} can be reached at {email} or {phone}.
— {person}
Seller: {person} Compared with the older lamp, this one is light.
<p>Seller: {person} The page moved on Tuesday.
Contact : {person}. La lampe coûte 30 euros.
Firmado por {person}. La lámpara cuesta 30 euros.
From: {person} <{email}>
Mr. {person} left a message.
Dear {person}, your parcel has arrived.
Dr. {person} answered on Tuesday.
The flat of {person}, {address}, Upper Hill.
Send the form to {address}, Flat 4, Millbrook 40213.
Mobile {phone}, office hours only.
Fax: {phone}
Dial {phone} ext. 12 for repairs.
Mail me: {email} or ring {phone}.
Passport number {id_number} was noted.
Tax number {id_number} goes on the form.
Identity card no. {id_number}, shown at the desk.
Passeport n° {id_number}.
Carta d'identità {id_number}.
护照号{id_number}，有效。
He lives at {address} now.
We moved to {address} last spring.
Ring the bell at {address}; the side door is locked.
Deliver to: {address}
Indirizzo: {address}
Adres: {address}, 3de verdieping
WhatsApp {phone}
Hotline: {phone} (weekdays)
Тел.: {phone}
手机：{phone}
Write to {email} today.
Reply-To: {email}
{person} signed for it.
{person} was here before noon.
Thanks to {person}, it works again.
I asked {person} about it.
{zh}说这家店不错。
感谢{zh}的帮助。
{zh}女士签收了包裹。
ID {id_number} belongs to {person}.
Social security: {id_number}.
Her insurance number is {id_number}, she said.
Ihr Ansprechpartner ist {person}, Telefon {phone}.
Herr {person} wohnt {address}.
Ausweis {id_number} liegt vor.
Monsieur {person} habite {address}.
Téléphone : {phone}. Courriel : {email}.
Señora {person} vive en {address}.
Llame al {phone} o escriba a {email}.
DNI {id_number}, {person}.
我叫{zh}，电话{phone}。
（{id_number}，本人签收）
有事找我 {phone}店里的灯还剩三盏。
有事找我 {phone}The lamp works.
他的号码是{id_number}。
收件人：{zh}，{address}
作者：{zh}
{zh}先生住在{address}。
请联系{zh}，邮箱{email}。
身份证{id_number}已登记。
身份证号码为{id_number}，姓名{zh}。
我的地址是{address}5栋301室。
拨打{phone}咨询。
Order no. {digits} was shipped on 2014-05-02.
Serial number {digits} is on the back.
Tracking {digits} is on its way.
The {brand} lamp from {brand} is sold out in {brand} Bay.
订单号{digits}已完成，货号AB-{digits}。
运单号{digits}已签收。
批次{digits}共十箱。
Bus 12 stops near {brand} Lane every hour.
Follow @{handle} for news.
Version 3.14.{digits} fixed {digits} errors.
""".strip().split("\n")
PATTERNS = [p.replace("⏎", "\n") for p in PATTERNS]

_PHONES = (
    "+1 ### ### ####|(###) ###-####|###-###-####|###.###.####|+1-###-###-####|07### ######|+44 20 #### ####|020 #### ####|+44 7### ######"
    "|1##########|1## #### ####|1##-####-####|+86-1##-####-####|+86 1##########|(0###)########|0##-########|0##/#####-###|+49 30 ##### ###|030 ########"
    "|+49 1## #######|0# ## ## ## ##|0#.##.##.##.##|+33 # ## ## ## ##|###-###-###|+34 ### ### ###|### ## ## ##|+91 ##### #####|+55 (##) #####-####"
    "|+81-##-####-####|0##-####-####|+7 (9##) ###-##-##|8 (9##) ###-##-##|+39 3## #######|+31 6 ########|+61 4## ### ###|+86 (0##) ####-####"
).split("|")
_EMAILS = (
    "{l}@{l}.example|{l}.{l}@{l}.com|{l}_##@{l}.test|{l}-k@{l}.{l}.org|{l}##@{l}.net|{l}@{l}.cn|{l}.{l}@mail.{l}.example|{l} (at) {l} (dot) com"
    "|{l}[at]{l}[dot]example|{l} at {l} dot org|{l} AT {l} DOT net|{l}{at}{l}{dot}test|{l}.k (at) {l}.example|{l}＠{l}.cn|{l} @ {l}.com"
).split("|")
_IDS = (
    "######{d}###X|######{d}####|###### {d} ####|######-{d}-####|###-##-####|### ## ####|??######A|?? ## ## ## B|?########|??#######|?###########"
    "|########?|########-?|X#######?|# ## ## ## ### ### ##|##.###.###-#|##### #### ####|?#######(#)|??? ### ###"
).split("|")
_ADDRESSES = (
    "#A {s} {t}|## {s} {t}|# {w} {t}|### {s} {s} {t}|##-# {w} {t}|## rue des {w}s|# bis rue de {w}|##, avenue {w}|{w}straße #|{w}weg #b|{w}gasse ##|Am {w}platz #"
    "|Calle {w} ##|Avenida de {w} #|Plaza {w} #|Via {w} ##|Viale {w} #|{w}straat ##|{w}laan #|ul. {w} #|{w}gatan ##|{h}路##号|{h}街#号|{h}大道###号|{h}巷#号|{h}胡同##号|{h}里#号"
).split("|")
FORMS = {"phone": _PHONES, "email": _EMAILS, "id_number": _IDS, "address": _ADDRESSES}
# Never trained on; the grammar knows none of them.
HELD = {
    "phone": ["+41 ## ### ## ##", "(+351) ### ### ###", "+65 #### ####"],
    "email": ["{l} <at> {l} <dot> com", "{l}(a){l}.org"],
    "id_number": ["###.###.###-##", "?? ######## ?"],
    "address": ["Rua das {w}s, ##", "{w}vej #", "# {w} Approach"],
}


class Inventor:
    """Invented values."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        r = self.r
        return ("".join(r.choice(_SYLL) for _ in range(r.randint(1, 2))) + r.choice(_ENDS)).capitalize()

    def person(self) -> str:
        r = self.r
        first, last = self.word(), self.word()
        if r.random() < 0.1:
            last += "-" + self.word()
        if r.random() < 0.2:
            first += f" {r.choice('ABCDEFGHJKLMRST')}."
        if r.random() < 0.2:
            return f"{last.upper() if r.random() < 0.7 else last}, {first}"
        name = f"{first} {last}"
        return name.upper() if r.random() < 0.15 else name

    def zh(self) -> str:
        r = self.r
        return r.choice(_FAMILY) + "".join(r.choice(_GIVEN) for _ in range(r.choice((1, 2, 2, 2))))

    def digits(self, pattern: str) -> str:
        return "".join(str(self.r.randint(0, 9)) if c == "#" else c for c in pattern)

    def value(self, kind: str, forms: dict[str, list[str]] | None = None) -> str:
        """A value of the kind in one of its forms: # is a digit, ? a capital letter, {w} an invented word, {h} Han characters."""
        r = self.r
        if kind == "digits":
            return self.digits("#" * r.randint(7, 18))
        form = r.choice((forms or FORMS)[kind])
        if kind == "address":
            form = re.sub(r"#+[A-Za-z]?", lambda m: f"{r.randint(1, 10 ** r.randint(1, 3))}" + (r.choice("ABCabc") if len(m[0]) > m[0].count("#") else ""), form)
        form = form.replace("{s}", r.choice(_STREETS)).replace("{t}", r.choice(_TYPES)).replace("{h}", self.zh()[1:] + r.choice("安宁东南"))
        form = re.sub(r"\{w\}", lambda m: self.word(), form)
        form = re.sub(r"\{l\}", lambda m: self.word().lower(), form)
        form = re.sub(r"\?", lambda m: r.choice("ABCDEFGHJKLMNPRSTUVWXYZ"), self.digits(form))
        if kind == "id_number":
            form = form.replace("{d}", f"{r.randint(1950, 2005)}{r.randint(1, 12):02d}{r.randint(1, 28):02d}")
        return form.upper() if kind == "email" and r.random() < 0.1 else form

    def sentence(self) -> tuple[str, list[tuple[int, int, str]]]:
        text, spans = "", []
        for part in re.split(r"(\{\w+\})", self.r.choice(PATTERNS)):
            if part[:1] != "{":
                text += part
                continue
            kind = part[1:-1]
            value = {"person": self.person, "zh": self.zh, "brand": self.word, "handle": lambda: self.word().lower()}.get(kind, lambda: self.value(kind))()
            if (kind := {"zh": "person"}.get(kind, kind)) in KINDS:
                spans.append((len(text), len(text) + len(value), kind))
            text += value
        return text, spans


def label(texts: list[str], earlier: Model | None = None) -> list[list[tuple[int, int, str]]]:
    """Spans by shapes, by names found after cues (marked wherever they occur) and by an earlier model's names."""
    cues = [re.compile(c, re.M) for c in CUES]
    names: Counter[str] = Counter()
    for t in texts:
        for c in cues:
            names.update(m[1] for m in c.finditer(t))
    known = sorted((n for n in names if len(n) > 2 or names[n] > 1), key=len, reverse=True)
    han = [re.escape(n) for n in known if n[0] >= "一"]
    latin = [re.escape(n) for n in known if n[0] < "一"]
    finders = [re.compile("|".join(han))] if han else []
    if latin:
        finders.append(re.compile(rf"(?<![\w@.-])(?:{'|'.join(latin)})(?![\w@])"))
    said = earlier.spans(texts) if earlier else [[] for _ in texts]
    out = []
    for t, own in zip(texts, said):
        spans = [(a, b, k) for a, b, k, _ in candidates(t)]
        people = [got[:2] for a, b, k in own if k == "person" and (got := name_at(t, a, b))]
        for f in [*finders, *cues]:
            people += [m.span(1) if f in cues else m.span() for m in f.finditer(t)]
        for a, b in people:
            if not any(x < b and a < y for x, y, _ in spans):
                spans.append((a, b, "person"))
        out.append(sorted(spans))
    return out


def _vary(text: str, spans: list[tuple[int, int, str]], make: Inventor) -> tuple[str, np.ndarray]:
    """The text with most values exchanged for invented ones, and its labels."""
    out, y, at = "", [], 0
    for a, b, kind in [*spans, (len(text), len(text), "")]:
        if a < at:
            continue
        out += text[at:a]
        y += [0] * (a - at)
        value = text[a:b]
        if kind == "person":
            if make.r.random() < 0.7:
                value = make.zh() if value[0] >= "一" else make.person()
        elif kind and make.r.random() < 0.4 and not (text[b : b + 1].isdigit() and value[-1:].isdigit()):
            value = make.value(kind)
        if kind:
            j = 1 + 2 * KINDS.index(kind)
            y += [j] + [j + 1] * (len(value) - 1)
        out += value
        at = b
    return out, np.array(y, np.int8)


def batches(docs: list[tuple[str, list]], model: Model, width: int, n: int, seed: int):
    """Endless (T, N) ids and labels: half windows around spans, a quarter anywhere, a quarter sentences of patterns."""
    make, r = Inventor(seed), random.Random(seed)
    full = [d for d in docs if d[1]]
    people = [d for d in full if any(s[2] in ("person", "id_number") for s in d[1])]
    while True:
        x, y = np.full((width, n), 2, np.int16), np.zeros((width, n), np.int8)
        for j in range(n):
            if j % 4 == 3:
                text, lab = "", np.zeros(0, np.int8)
                while len(text) < width:
                    filler = r.choice(docs)[0][:40] if r.random() < 0.3 else ""
                    s, spans = make.sentence()
                    s, labels = _vary(s, spans, make)
                    glue = r.choice([" ", "\n", "。" if s[:1] >= "一" else ". "])
                    text, lab = text + s + glue, np.concatenate([lab, labels, np.zeros(len(glue), np.int8)])
                start = 0
            else:
                doc = r.choice(docs if j % 4 == 2 else people if j % 4 == 1 and people else full)
                text, lab = _vary(*doc, make)
                if j % 4 == 2 and make.r.random() < 0.1:  # shouting holds no more names than other text
                    text = "".join(c.upper() if len(c.upper()) == 1 else c for c in text)
                spots = np.flatnonzero(lab)
                if j % 4 < 2 and len(spots):
                    start = int(r.choice(spots.tolist())) - r.randint(0, width - 1)
                else:
                    start = r.randint(0, max(0, len(text) - width))
            start = max(0, min(start, len(text) - width))
            piece, own = text[start : start + width], lab[start : start + width]
            x[: len(piece), j] = model.alphabet.ids(piece)
            y[: len(piece), j] = own
        yield x, y


def train(docs: list[tuple[str, list]], chars: str, steps: int, width: int = 96, n: int = 96, rate: float = 6e-3, seconds: float = 1e9, model: Model | None = None, seed: int = 1) -> Model:
    model = model or Model.new(chars)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    began, mean = time.time(), None
    for step, (x, y) in enumerate(batches(docs, model, width, n, seed), 1):
        share = max(step / steps, (time.time() - began) / seconds)
        if share >= 1:
            break
        loss, g = model.loss_and_gradients(x, y)
        norm = np.sqrt(sum(float((w * w).sum()) for w in g.values()))
        lr = rate * min(1, step / 50) * (0.5 + 0.5 * np.cos(np.pi * share)) * min(1, 1 / (norm + 1e-9))
        for k in model.p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] * g[k]
            model.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        mean = loss if mean is None else 0.97 * mean + 0.03 * loss
        if step % 50 == 0:
            print(f"{step} {mean:.5f} {time.time() - began:.0f}s", flush=True)
    return model


def report(model: Model, docs: list[tuple[str, list]]) -> None:
    """Share of labelled spans that a decoded span of the kind meets, and of decoded ones that meet a label."""
    got = model.spans([t for t, _ in docs])
    for kind in KINDS:
        meets = lambda s, others: any(o[2] == kind and o[0] < s[1] and s[0] < o[1] for o in others)
        gold = [(s, found) for (_, spans), found in zip(docs, got) for s in spans if s[2] == kind]
        said = [(s, spans) for (_, spans), found in zip(docs, got) for s in found if s[2] == kind]
        print(kind, "recall", sum(meets(*a) for a in gold), len(gold), "precision", sum(meets(*a) for a in said), len(said), flush=True)


def report_held(model: Model, n: int = 400) -> None:
    """Share of values in the forms of HELD that a decoded span of the kind meets, and gives with both ends right."""
    make = Inventor(2)
    for kind, forms in HELD.items():
        cases = []
        while len(cases) < n:
            pattern = make.r.choice(PATTERNS)
            if pattern.count("{") == 1 and f"{{{kind}}}" in pattern:
                value, start = make.value(kind, HELD), pattern.index("{")
                cases.append((pattern[:start] + value + pattern[start + len(kind) + 2 :], start, start + len(value), value))
        got = model.spans([c[0] for c in cases])
        met = sum(any(k == kind and x < b and a < y for x, y, k in g) for (_, a, b, _), g in zip(cases, got))
        exact = sum((a, b, kind) in g for (_, a, b, _), g in zip(cases, got))
        shaped = sum(any(x < b and a < y and k == kind for x, y, k, _ in candidates(t)) for t, a, b, _ in cases)
        print("unseen forms", kind, len(cases), "met", met / n, "exact", exact / n, "met by shapes", shaped / n, flush=True)


def sample(at: str, rows: int) -> list[str]:
    """Texts of at most `rows` documents, those whose doc_id has the least hash."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    import xxhash

    table = pq.read_table(at, columns=["doc_id", "text"])
    hashes = np.array([xxhash.xxh64_intdigest(str(i)) for i in table["doc_id"].to_pylist()], np.uint64)
    return [t for t in table["text"].take(pa.array(np.argsort(hashes, kind="stable")[:rows])).to_pylist() if t]


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("documents")
    args.add_argument("--rows", type=int, default=4000)
    args.add_argument("--steps", type=int, default=3000)
    args.add_argument("--seconds", type=float, default=900)
    args.add_argument("--start", help="weights of an earlier model, whose names are labels too")
    args.add_argument("--resume", help="weights to go on from, at half the rate")
    args.add_argument("--out", default=str(WEIGHTS))
    a = args.parse_args()
    texts = sample(a.documents, a.rows)
    docs = list(zip(texts, label(texts, Model.load(a.start) if a.start else None)))
    held, docs = docs[::10], [d for i, d in enumerate(docs) if i % 10]
    counts = Counter(c for t, _ in docs for c in fold(t))
    chars = "".join(c for c, n in counts.most_common(900) if n >= 5 and not c.isdigit() and c not in " \t")
    if a.resume:
        model = train(docs, chars, a.steps, seconds=a.seconds, rate=3e-3, model=Model.load(a.resume), seed=2)
    else:
        model = train(docs, chars, a.steps, seconds=a.seconds)
    model.save(a.out)
    report(Model.load(a.out), held)
    report_held(Model.load(a.out))


if __name__ == "__main__":
    main()
