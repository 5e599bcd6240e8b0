"""Mojibake, residue, tokens and leaks."""

import random
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st

from gleaner.llm import leak, mojibake, residue, tokens

TEXTS = [None, "", "  \n\t ", "Hello  world 123", "中文分词测试，没有空格的长句子。", "🙂👩‍🔧 <|endoftext|> ½", "a" * 5000, "é" * 3000 + "\r\n\x00"]
VOCABULARY = Path(tokens.TOKENIZERS, "byte_bpe_50k.tiktoken")


@pytest.mark.skipif(not VOCABULARY.exists(), reason="no tokenizer files")
def test_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(VOCABULARY.with_suffix(".json")))
    library.encode_special_tokens = True
    r = random.Random(6)
    texts = TEXTS + ["".join(r.choice("ab '\n\t  é中日🙂٣1०<|>‍　\r") for _ in range(r.randint(0, 80))) for _ in range(2000)]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(0, None, 7)]
    got = tokens.encode(spark.createDataFrame(rows, "doc_id bigint, text string, ids int")).collect()
    assert len(got) == len(rows)
    own = {x.doc_id: x.ids for x in got}
    for i, t in enumerate(texts):
        assert own[i] == (library.encode(t, add_special_tokens=False).ids if t else [])
    back = [t for i, t in enumerate(texts) if t and library.decode(own[i], skip_special_tokens=False) != t]
    assert not [t for t in back if "�" not in t and t != library.decode(library.encode(t).ids, skip_special_tokens=False)]


@pytest.mark.skipif(not VOCABULARY.exists(), reason="no tokenizer files")
def test_fragments_lose_nothing():
    e = tokens.Encoder(str(VOCABULARY))
    for t in TEXTS:
        if t:
            assert b"".join(e.fragments(t.encode())) == t.encode()


CLEAN = ["折叠台灯评测：盖子有点松", "便携雨伞怎么选？店主的经验", "Étagère réglable – qualité éprouvée", "Купить тихий чайник", "軽い雨傘の写真一覧", "繡花鞋選購指南"]
DAMAGE = [("utf-8", "cp1252"), ("gb18030", "latin-1"), ("utf-8", "gb18030"), ("cp1251", "koi8-r"), ("euc_jp", "gb18030"), ("big5", "latin-1")]


def test_damage_is_found_and_undone(spark):
    rows = [(i, CLEAN[i % len(CLEAN)]) for i in range(600)] + [(600, None), (601, ""), (602, "plain ascii")]
    hurt = {}
    for text in CLEAN:
        for own, used in DAMAGE:
            try:
                bad = text.encode(own).decode(used)
            except UnicodeError:
                continue
            if bad != text:
                hurt[1000 + len(hurt)] = (bad, text)
    df = spark.createDataFrame(rows + [(i, b) for i, (b, _) in hurt.items()] + [(5000, "雨伞���评"), (5001, "锟斤拷台灯")], "rec_id bigint, title string")
    got = {x.rec_id: x for x in mojibake.damaged([("t", df)]).collect()}
    assert set(got) == set(hurt) | {5000, 5001}
    right = sum(got[i].restored == t for i, (_, t) in hurt.items())
    assert right >= 0.8 * len(hurt)
    assert got[5000].restored is None and mojibake.damaged([("t", df.limit(0))]).collect() == []


@given(st.lists(st.floats(-3, 3), max_size=40))
def test_maximal_segments(scores):
    """Against the definition: the best segment, then the same on both sides of it."""
    def best(a, b):
        options = [(sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        top = max(options, default=(0,))
        if top[0] <= 1e-9:
            return []
        i, j = top[3:]
        return [*best(a, i), (i, j), *best(j, b)]

    got = [(a, b) for a, b, s in mojibake.maximal_segments(scores) if s > 1e-9]
    assert sum(sum(scores[a:b]) for a, b in got) == pytest.approx(sum(sum(scores[a:b]) for a, b in best(0, len(scores))))


def test_damage_without_marks_and_twice(spark):
    rows = [(i, CLEAN[i % len(CLEAN)]) for i in range(600)]
    twice = "Étagère réglable".encode().decode("cp1252").encode().decode("cp1252")
    df = spark.createDataFrame([*rows, (700, twice), (701, "锟斤拷锟斤拷台灯"), (702, "é"), (703, "\ufffd")], "rec_id bigint, title string")
    got = {x.rec_id: x.restored for x in mojibake.damaged([("t", df)]).collect()}
    assert got == {700: "Étagère réglable", 701: None, 703: None}
    assert {x.rec_id for x in mojibake.damaged([("t", df)], marks=False).collect()} == {700, 701}


RESIDUE = {
    "{{ title }} - Night buses": "placeholder",
    "Dear ${name}, thank you": "placeholder",
    "欢迎来到<?php echo $price; ?>": "placeholder",
    "__TITLE___台灯": "placeholder",
    "Price: %PRICE%": "placeholder",
    "[插入标题] - 展": "placeholder",
    "Lorem ipsum dolor sit amet, orat": "filler",
    "foo bar foo bar foo bar foo bar": "filler",
    "这里是占位文字，请替换": "filler",
    "404 Not Found - the address /x does not exist on shop.example": "notice",
    "首页 > 提示\n您无权访问此页面，请联系管理员。": "notice",
    "<h1>Please enable JavaScript to view this site.</h1>": "notice",
}
CONTENT = [
    None, "", " ", "Not found for forty years: the ferry of Saltmere Bay", "为什么总是提示服务器错误？站长经验谈", "In this lesson the tag {{ name }} prints a variable.",
    "The CSS rule a { margin: 0; color: #333 } removes the gap.", "Set notation: {1, 2, 3} explained", "Typesetters used lorem ipsum long before screens.",
    "站长们常说的“请启用脚本”提示，其实可以写得更友好。", "Access denied? How the harbour gate keys work", "~!@#$%^&*() ______======", "x" * 200000,
]


def test_placeholders_after_any_script_and_of_any_length():
    why = residue.Finder().why
    name = "a_rather_long_name_of_a_value." * 5
    for text in (
        "本页由__PRICE__提供",
        "ночь__TITLE__",
        f"Dear {{{{ user | default('{name}') }}}}, hello",
        f"Dear ${{{name} + {name}}}",
        "{{% if a > b and {} %}}".format(name),
        f"<% if (a > b) {{ print('{name}') }} %>",
        f"von <?php echo $row->title . '{name}' ?> bis",
    ):
        assert why(text) == "placeholder", text
    for text in ("snake__case__name", "a {{ b", "5 <% of it", "50 % of <b>all</b> 5 %"):
        assert why(text) is None, text


# Wording of public servers, browsers and services, not consulted for the phrase lists.
HELD_OUT = """
Ошибка 404. Такой страницы нет на сайте.
La page que vous cherchez est introuvable.
요청하신 페이지를 찾을 수 없습니다.
Aradığınız sayfa bulunamadı.
This page isn't working. HTTP ERROR 500
This site can’t be reached. shop.example took too long to respond.
The requested URL /old/index.html was not found on this server.
403 Forbidden
502 Bad Gateway nginx/1.18.0
The server encountered an internal error or misconfiguration and was unable to complete your request.
Error 503: Backend fetch failed
We're sorry, but something went wrong.
The page you were looking for doesn't exist. You may have mistyped the address or the page may have moved.
Our systems have detected unusual traffic from your computer network.
Please turn JavaScript on and reload the page.
You need to enable JavaScript to run this app.
This website requires cookies. Please enable cookies in your browser.
Your browser is not supported. Please upgrade your browser.
Die angeforderte Seite wurde nicht gefunden.
Die Seite konnte nicht gefunden werden.
Bitte aktivieren Sie JavaScript in Ihrem Browser.
Cette page n’est plus disponible.
Le serveur est temporairement indisponible.
Veuillez activer JavaScript pour continuer.
La página solicitada no existe.
Error 404: página no encontrada
El servidor no está disponible en este momento.
A página que você procura não foi encontrada.
La pagina richiesta non è stata trovata.
Страница не найдена
Сервис временно недоступен, попробуйте позже.
Для работы сайта включите JavaScript.
お探しのページは見つかりませんでした。
申し訳ございません。ページが存在しません。
JavaScriptを有効にしてください。
您要访问的页面不存在或已被删除
抱歉，您访问的商品已下架
系统繁忙，请稍后再试
请开启浏览器的 JavaScript 功能后刷新页面
無法找到您要的網頁
服务器内部错误，请联系网站管理员
Strona nie została znaleziona.
De pagina die u zoekt bestaat niet.
Connection timed out. Error code 522
Too many connections
Fatal error: Call to undefined function mysql_connect() in /var/www/index.php on line 12
""".strip().splitlines()


def test_notices_in_unseen_wording():
    finder = residue.Finder()
    missed = [t for t in HELD_OUT if finder.why(t) != "notice"]
    print(missed)
    assert len(missed) <= 0.1 * len(HELD_OUT)
    for t in ("{{ user.profile.display_name | default('dear customer of ours') | upper }}", "{{#if customer.has_a_really_long_flag_name_here_and_more}}"):
        assert finder.why("Dear " + t + ", hello") == "placeholder"
    assert finder.why("说明。 测试测试测试") == "filler" and finder.why("锟斤拷锟斤拷锟斤拷锟斤拷 台灯") is None
    for t in CONTENT:
        assert finder.why(t) is None


def test_residue(spark):
    texts = [*RESIDUE, *CONTENT]
    df = spark.createDataFrame([(i, t, None, "z") for i, t in enumerate(texts)], "archive_id bigint, title string, cdoc string, title_why string")
    got = {x.archive_id: x.title_why for x in residue.residue(df).collect()}
    assert [got[i] for i in range(len(texts))] == [*RESIDUE.values(), *[None] * len(CONTENT)]
    assert residue.residue(df.limit(0)).collect() == []


ITEMS = [
    (1, "en", "The foreman at the observatory salvaged thirty granular turbines silently, since the miller of the windmill stacked only eleven chisels."),
    (2, "zh", "比较铸造厂中的摩擦与装有十四个磁石的谷仓中的侵蚀有何不同。"),
    (3, "en", "Too short."),
    (4, "fr", "une deux trois quatre cinq six sept huit neuf dix onze douze treize"),
    (5, "en", None),
]


def leaks(spark, docs, **how):
    d = spark.createDataFrame([(i, t, 3) for i, t in enumerate(docs)], "doc_id bigint, text string, item_id int")
    i = spark.createDataFrame([(*x, "B") for x in ITEMS], "item_id bigint, lang string, text string, answer string")
    return {(x.doc_id, x.item_id, x.kind) for x in leak.leaks(d, i, **how).collect()}


DOCS = [
    "xx THE FOREMAN, at the <b>obser</b>vatory&nbsp;salvaged thirty\ngranular turbines silently since the miller",  # 13 words
    "foreman at the observatory salvaged thirty granular turbines silently since the",  # 11 words
    "the foreman at the observatory salvaged fifty granular turbines silently since the miller",
    "文中：比较铸造厂中的 摩擦与装有<i>十四个</i>磁石的谷仓！！",
    "比较铸造厂中的摩擦与装有十",
    "ＴＨＥ　ｆｏｒｅｍａｎ at the observatory sal­vaged thirty granular turbines silently, since the",
    None, "", "   ", "Too short.", "w " * 50000,
    "une deux trois quatre cinq six sept huit neuf dix onze douze treize",
]


def test_leaks(spark):
    want = {(0, 1, "verbatim"), (2, 1, "reparameterised"), (3, 2, "verbatim"), (5, 1, "verbatim")}
    assert leaks(spark, DOCS) == want
    assert leaks(spark, DOCS, max_bytes=0) == want  # by a bitmap of one word instead of the arrays
    assert leaks(spark, DOCS, max_bytes=4096) == want
    assert leaks(spark, [None]) == set()
    gap = "<!-- " + "x" * 9000 + " -->"
    assert leaks(spark, [f"foreman at the observatory salvaged{gap} thirty granular turbines silently, since the miller"]) == {(0, 1, "verbatim")}


PROBLEMS = [
    (11, "en", "Yesterday Alice bought 12 crates of plums and sold 1,200 plums to Dora before the market closed, how many plums did Alice keep?"),
    (12, "zh", "小明有12个苹果，他把其中的3个苹果送给了同桌，又用5元钱买了一些铅笔，请问小明现在还剩多少个苹果？"),
    (13, "en", "A train leaves the northern harbour at 9 and covers 45 km in each hour, after twenty five minutes it stops near the mill."),
]
CHANGED = {
    "Yesterday Bruno bought 34 crates of plums and sold 950.5 plums to Edith before the market closed, how many plums did Bruno keep?": 11,
    "xx yesterday Carol Ann bought 7 crates of plums and sold 12,500 plums to Mr Finn before the market closed, how many plums did Carol Ann keep?": 11,
    "小红有345个苹果，他把其中的一百二十个苹果送给了同桌，又用8块钱买了一些铅笔，请问小红现在还剩多少个苹果？": 12,
    "王老师有6只苹果，他把其中的2只苹果送给了同桌，又用70元钱买了一些铅笔，请问王老师现在还剩多少只苹果？": 12,
    "A train leaves the northern harbour at 11 and covers 60 miles in each hour, after forty minutes it stops near the mill.": 13,
}
SIMILAR = [
    "Yesterday Bruno bought 34 crates of plums and sold 950 plums to Edith before the market closed, how many plums did Gerda keep?",  # Alice became two
    "Yesterday Bruno bought pears and some plums.",
    "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20",
    "Anna Bert Carl Dora Emil Fritz Gert Hans Ida Jan Kurt Leo Max Nora Otto",
]


def test_reparameterised_leaks(spark):
    docs = [*CHANGED, *SIMILAR]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    i = spark.createDataFrame(PROBLEMS + [(21, *PROBLEMS[0][1:]), (22, "en", "1 2 3 4 5 6 7 8 9 10 11 12 13"), (None, "en", "x " * 20)], "item_id bigint, lang string, text string")
    want = {(k, item) for k, item in enumerate(CHANGED.values())} | {(k, 21) for k in (0, 1)} | {(len(CHANGED) + 2, 22)}
    for how in ({}, {"max_bytes": 0}):
        got = {(x.doc_id, x.item_id, x.kind) for x in leak.leaks(d, i, **how).collect()}
        assert {x[:2] for x in got} == want
        assert {x[2] for x in got if x[0] < len(CHANGED)} == {"reparameterised"}


def test_leaks_match_brute_force(spark):
    r = random.Random(8)
    words = ITEMS[0][2].replace(",", "").replace(".", "").lower().split()
    docs, want = [], set()
    for i in range(60):
        n, a = r.randint(8, 16), r.randint(0, 6)
        part = words[a : a + n]
        docs.append(" ".join([*r.choices(["lamp", "tent", "bus"], k=5), *part, "kettle"]))
        if len(part) >= 12:
            want.add(i)
    assert {d for d, item, k in leaks(spark, docs) if item == 1 and k == "verbatim"} == want
