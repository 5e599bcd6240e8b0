"""Template residue, filler and error pages, found by a multi-pattern automaton.

One pass of an Aho-Corasick automaton over the folded text finds the phrases of all languages, the
parts that notices are made of and the opening marks of placeholders. Placeholders and filler
count anywhere. Error messages and requests for scripts, cookies or a browser check count only in
place of content: when the sentences they cover make up most of the text. A sentence is a notice
if it has a whole phrase, or says of a thing (page, server) what is wrong with it, or asks for a
means (scripts, cookies). Sentences that ask a question, quote the phrase or explain templates
don't count.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.session import spread

# Whole phrases of error pages, of script, cookie and browser checks.
NOTICES = """
internal error
internal server error
object reference not set
http error
bad gateway
gateway timeout
error establishing a database connection
database connection
something went wrong
oops!
403 forbidden
access denied
you don't have permission
too many requests
nullpointerexception
traceback (most recent call last)
stack trace
fatal error
parse error
expects parameter
uncaught exception
under maintenance
please try again later
checking your browser
before you continue
please wait while we verify
verify you are human
complete the captcha
loading…
loading...
enable javascript
javascript is disabled
javascript is required
requires javascript
noscript:
enable cookies
cookies are disabled
javascript and cookies
to view this site
服务器开小差了
请稍后再试
服务器错误
内部错误
错误码
系统维护中
敬请谅解
无权访问
联系管理员
访问被拒绝
禁止访问
已下架
看看别的吧
出错啦
出错了
系统提示
系统繁忙
访问过于频繁
未启用脚本
脚本无法运行
启用脚本
开启 javascript
启用 javascript
启用 cookie
浏览器版本过低
请升级后访问
无法正常显示
安全验证
完成滑块
正在验证
頁面不存在
找不到網頁
伺服器錯誤
系統維護中
請啟用 javascript
請稍後再試
ページが見つかりません
お探しのページ
javascriptを有効
メンテナンス中
страница не найдена
ошибка сервера
включите javascript
доступ запрещен
сервис недоступен
seite nicht gefunden
aktivieren sie javascript
interner serverfehler
zugriff verweigert
wartungsarbeiten
page introuvable
nécessite l’activation de javascript
nécessite l'activation de javascript
activer javascript
erreur interne
accès refusé
página no encontrada
active javascript
error interno
acceso denegado
página não encontrada
ative o javascript
pagina non trovata
attiva javascript
problem loading page
unable to connect
bad request
unauthorized
method not allowed
request timeout
that's an error
we're sorry
we are sorry for the inconvenience
sorry for the inconvenience
try refreshing
try again in a few
go back to the home
return to the home
back to the home
contact the administrator
contact the site owner
ray id
one more step
security check
are you a robot
not a robot
unusual traffic
给您造成不便
返回首页
返回上一页
联系客服
确认您是人类
人机验证
访问验证
잠시 후 다시 시도
로봇이 아닙니다
しばらくしてから
もう一度お試し
повторите попытку позже
попробуйте позже
вернуться на главную
versuchen sie es später
zurück zur startseite
réessayez plus tard
veuillez réessayer
retour à l'accueil
inténtelo más tarde
vuelva a intentarlo
volver al inicio
tente novamente
riprova più tardi
lütfen daha sonra tekrar
ana sayfaya dön
spróbuj ponownie
probeer het later
something broke
server error
try again
too many connections
traffic from your computer
slow down
check the url
check the address
check the spelling
prüfen sie die
vérifiez l'
verifique la dirección
проверьте
请检查
"""

# Status codes of error pages and the words that stand beside them.
CODES = "400 401 403 404 405 408 410 429 500 502 503 504".split()
CODE_WORDS = "error|http|http error|status|code|错误|錯誤|エラー|오류|ошибка|fehler|erreur|error de|erro|errore|hata|błąd|fout".split("|")

# Things that error pages speak of; a closing - stands for any ending.
THINGS = """
page- access area account site website address url link file resource document server- service request- content item product article gateway upstream backend connection host database browser
页面 网页 网站 站点 地址 链接 网址 文件 资源 服务器 服务 内容 商品 宝贝 文章 帖子 信息 请求 连接 主机 数据库 頁面 網頁 網站 網址 連結 檔案 伺服器 服務
ページ サイト アドレス ファイル サーバ サービス 商品 記事
페이지 사이트 주소 파일 서버 서비스 요청
страниц- сайт- адрес- ссылк- файл- сервер- сервис- служб- ресурс- запрос-
seite- adresse- datei- dienst- anfrage- inhalt-
adresse- fichier- serveur- ressource- requête-
página- sitio- dirección archivo- servidor- servicio- recurso- solicitud- enlace-
endereço- arquivo- serviço-
pagina- sito indirizzo risorsa servizio
sayfa- adres- dosya- sunucu- hizmet-
stron- plik- serwer- usług-
bestand- adres dienst
"""

# What is wrong with them.
FAILS = """
not found|can't be found|cannot be found|could not be found|couldn't be found|couldn't find|could not find|can't find|cannot find|no longer exist-|does not exist|doesn't exist|unavailable|not available|no longer available
been removed|been deleted|been moved|been blocked|taken down|isn't working|not working|cannot be displayed|can't be displayed|can't be reached|cannot be reached|refused to connect|closed the connection|reset the connection|refused the connection
timed out|too long to respond|not supported|fetch failed|took too long|is down|failed to load|couldn't load|could not load|overloaded|forbidden|denied|has expired|went wrong|an error occurred|error occurred
不存在|未找到|找不到|无法找到|没有找到|无法访问|无法显示|无法打开|打不开|已删除|已被删除|被删除|已下架|已失效|已过期|已关闭|不可用|暂停服务|暂时无法|超时|出错|错误|繁忙|维护|拒绝|禁止|受限|开小差
無法找到|無法顯示|無法開啟|已刪除|已下架|逾時|錯誤|維護|拒絕
見つかりません|見つかりませんでした|存在しません|表示できません|アクセスできません|削除され|エラー|利用できません|開けません
찾을 수 없|존재하지 않|없습니다|삭제되|이용할 수 없|접근할 수 없|오류|연결할 수 없
не найден-|не существует|нет на сайте|нет такой|удален-|недоступ-|не отвечает|запрещен-|перемещен-|не удалось|временно не работает
nicht gefunden|nicht gefunden werden|existiert nicht|nicht verfügbar|nicht erreichbar|wurde entfernt|wurde gelöscht|verweigert|nicht mehr
introuvable-|n'est plus|plus disponible|n'existe pas|n'existe plus|n’existe pas|n’existe plus|pas trouvé-|indisponible-|inaccessible-|été supprimé-|été déplacé-|refusé-|interdit-
no encontrad-|no fue encontrad-|no existe|no está disponible|ya no está|no se encuentra|no se pudo encontrar|sido eliminad-|no disponible|denegad-
não encontrad-|não foi encontrad-|não está disponível|não existe|indisponível|foi removid-|negad-
non trovat-|stata trovata|stato trovato|non esiste|non è disponibile|non disponibile|rimoss-
bulunamadı|mevcut değil|bulunmuyor|kaldırıl-|ulaşılamıyor
nie znaleziono|nie została znaleziona|nie istnieje|niedostępn-
niet gevonden|bestaat niet|niet beschikbaar
"""

# Requests, and the means they ask for.
ASKS = """
enable|need|need to|turn|turn on|turned on|turn them on|switch on|switched on|activate|allow|accept|requires|require|needs|must be enabled|is disabled|are disabled|is required|are required|blocks|blocked|upgrade|update your|without
启用|开启|打开|允许|需要|支持|升级|禁用|未启用|版本过低|啟用|開啟|升級
有効|オン|必要
활성화|사용하도록|필요|허용
включите|включить|отключен-|необходим-|разрешите
aktivieren|aktiviert|eingeschaltet|deaktiviert|erforderlich|benötigt
activer|activez|désactivé-|requis|nécessite|autoriser
active|activar|actívelo|habilite|desactivado|requiere|necesita|permita|no ejecuta
ative|ativar|desativado|requer
attiva|attivare|abilita|disattivato|richiede
etkinleştir-|açın|gerekli
włącz|włączyć|wymaga
inschakelen|vereist
"""
MEANS = """
javascript|java script|js|cookies|cookie|scripts|scripting|browser
脚本|腳本|浏览器|瀏覽器|スクリプト|ブラウザ|クッキー|자바스크립트|쿠키|브라우저|скрипт-|браузер-|куки|navigateur|navegador|tarayıcı-|przeglądark-
"""

# Filler text of page templates.
FILLERS = """
lorem ipsum dolor
dolor sit amet
your description here
your text goes here
your text here
insert your headline here
insert text here
add your text
content coming soon
dummy text
placeholder text goes
sample text
untitled document
[object object]
占位文字
请替换
待补充
请在此输入
在此输入
请输入正文
内容建设中
默认标题
默认内容
无标题文档
新建网页
这里是正文
示例文字
此处填写
請在此輸入
佔位文字
ここに本文
ここにテキスト
ダミーテキスト
здесь будет текст
введите текст
текст-заполнитель
hier könnte ihr text stehen
platzhaltertext
hier steht ihr text
votre texte ici
texte de remplacement
texto de relleno
su texto aquí
seu texto aqui
dummy copy
your content goes here
your content here
your title here
type your text
click to edit
double click to edit
asdf asdf
test test test
텍스트를 입력
metin buraya
tekst zastępczy
"""
# Who asks for text to be filled in, and what for.
INSERTS = """
insert|add|replace|enter|type|write|put|goes|go here|请输入|请填写|请替换|在此处|在这里|插入
"""
SLOTS = """
your own words|your own text|your own content|your text|your headline|your copy|this paragraph|this text|dummy copy|dummy text|placeholder|will go here|text here|headline here|description here|title here
占位|正文内容|标题文字|图片说明|您的内容|您的文字
"""

# Page furniture that stands around a notice and is no content either.
FURNITURE = """
返回首页
首页
提示
上一页
下一页
home
help
login
back
back to start
reference
request id
error id
incident
login
menu
search
contact
sitemap
上一页
下一页
登录
注册
"""

# Words without content of their own, which don't count against a notice.
FUNCTION = """
a an the this that these those it its we you your our i is are was be been being has have had do does did can could may might will would should must to of in on at for from with and or but if as by not no so
please sorry before after again now here there while when your you're we're it's
der die das ein eine ist sind sie ihr ihre wir und oder um zu im in auf für von mit bitte
le la les un une des du de ce cette est sont vous votre nous et ou pour que qui à l' d' ne pas s'il veuillez
el los las una este esta es son usted su y o para que de en por favor
o os as um uma este esta é são você seu e ou para que de em por
il lo gli un una questo questa è sono si per che di in
в на и или не вы ваш мы по для что это с к от
的 了 是 请 您 你 我们 在 或 和 与 及 也 已 可能 该 此 到 本 这 那 就 后 将 被 所 請 您 該
"""

# Words of sentences that write about templates; two of them in a sentence explain it.
ABOUT = """
template|templates|tag|tags|variable|variables|syntax|tutorial|lesson|markup|snippet|placeholder|placeholders|parser|engine|dialect|expression|selector|code|prints|renders|outputs|braces|escaped
教程|模板|变量|语法|标签|写法|写下|示例|例子|花括号|占位符|代码|表达式|输出|引擎
"""

# Titles that are nothing but the name of an error page, and names of new pages.
BARE = "error|errors|oops|错误|出错|出错了|提示|提示信息|系统提示|温馨提示|fehler|erreur|ошибка|エラー|오류|hata|page error"
NEW = "new page|page title|新建网页|untitled|无标题"

# From the opening to the closing mark, whatever the length between them; tried where the automaton finds an opening mark.
OPENING = "{ ${ #{ <% <? [[ *| @@ __ % < [".split()
PLACEHOLDER = re.compile(
    r"""
      \{\{\{?\s*[#/&>!^]?\s*[A-Za-z_$][^{}]*\}\} | \{\{\s*\}\}                 # mustache
    | [$\#]\{\s*[A-Za-z_$][^{}]*\} | \{\$[A-Za-z_$][^{}]*\}                   # dollar, hash, smarty
    | \{%-?\s*\w(?s:(?!%\}|\{%).)*%\}                                        # block tags
    | <%(?s:(?!%>|<%).)+%> | <\?(?:php|=)(?s:(?!\?>|<\?).)*\?>                 # server pages
    | \[\[\s*[\w.]+\s*\]\] | \*\|[\w:.]+\|\* | @@[\w.-]{2,}@@                     # wiki, mail, build
    | (?<![A-Za-z0-9_])__[A-Za-z][A-Za-z0-9_]*?__(?![A-Za-z0-9]) | %[A-Z][A-Z_]{2,}%     # underscores, percent
    | \{\s*(?:\d{1,2}|[A-Za-z_][\w.]*)\s*\}                                     # format strings
    | <(?!/)[A-Z][A-Z_-]{2,}>                                                     # angle brackets
    | \[(?i:insert|your|enter|company|product|city|first|last|user|shop|price|title|name|date)\b[^\[\]\n]{0,30}\]
    | \[(?:插入|填写|输入|请|您的|商品|店铺|用户|城市|标题|价格|公司|品牌|姓名|日期)[^\[\]\n]{0,10}\]
    """,
    re.X,
)
_HTML_TAGS = frozenset("HTML HEAD BODY TITLE META LINK SCRIPT STYLE DIV SPAN TABLE TBODY THEAD FONT CENTER IMG FORM INPUT PRE CODE STRONG BLOCKQUOTE".split())
# the same short word or pair of words over and over
REPEATED = re.compile(r"\b(\w{2,6}(?: \w{2,6})?)(?: \1\b){3,}")
_NEW_PAGE = re.compile(r"[\s\d]*(?:-|$)")
# a stack trace or a message of an interpreter, line by line
_TRACE = re.compile(
    r"(?<![\w$])(?:[\w$]{1,60}\.){1,8}[\w$]{0,60}(?:Exception|Error)\b(?:: [^\n]{0,200})?"
    r"|\bat (?:[\w$]{1,60}\.){1,8}[\w$<>]{1,60}\([\w.]{1,80}(?::\d+)?\)"
    r"|\b(?:Warning|Notice|Deprecated|Fatal error|Parse error): +(?:[A-Z][\w ]{2,60} )?[\w:\\>-]{2,80}\([^()\n]{0,200}\)[^\n]*"
)
_TRACED = re.compile("Exception|Error|Warning: |Notice: |Deprecated: |error: ")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_QUOTED = re.compile(r"“[^”\n]*”|‘[^’\n]{2,}’(?!\w)|(?<!\w)'[^'\n]{2,}'(?!\w)|「[^」\n]*」|\"[^\"\n]{2,}\"")
# addresses, paths, hosts, long codes and numbers inside a message are no content
_NEUTRAL = re.compile(r"https?://\S+|(?<!\w)[\w-]+(?:\.[A-Za-z][\w-]+)+|(?<!\w)/[\w./%-]+|\b[0-9a-fA-F]{8,}\b|\d+")
_FUNCTION = re.compile(
    r"(?<![^\W_])(?:" + "|".join(sorted({w for w in FUNCTION.split() if w < "⺀"})) + r")(?![^\W_])|" + "|".join(w for w in FUNCTION.split() if w > "⺀"), re.I
)
_DAMAGE = "锟斤拷烫屯嚙踝蕭"  # what replacement characters turn into; that is damage, not filler
_SENTENCE = re.compile(r"[^。！？!?\n.…]*(?:[。！？!?\n…]+|\.(?=\s|$)|\.(?=\S)|$)")
_STOPS = ("。", "！", "？", "!", "?", "\n", ". ")


def _lines(block: str) -> list[str]:
    return [x for x in block.strip().splitlines() if x]


def _parts(block: str, sep: str) -> list[str]:
    return [x for line in _lines(block) for x in line.split(sep) if x]


@lru_cache(1)
def _letters() -> np.ndarray:
    """Of each code point whether it is a letter or digit: 1, or 3 for Han and the comma between Han."""
    t = np.fromiter(((0xD800 > c or c >= 0xE000) and chr(c).isalnum() for c in range(0x30000)), bool).astype(np.uint8)
    t[0x4E00:0xA000] |= 2
    t[0xFF0C] |= 2
    return t


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0x2FFFF)


def _repeats(texts: list[str | None], least: int = 3) -> set[int]:
    """Which texts have 2 to 14 Han characters, not all the same, `least` times in a row; 2 or 3 only apart from other Han."""
    code = _codes("\0".join(t or "" for t in texts))
    han = (_letters()[code] & 2 > 0) & ~np.isin(code, [ord(c) for c in _DAMAGE])
    found: set[int] = set()
    if not han.any():
        return found
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    for k in range(2, 15):
        same = (code[:-k] == code[k:]) & han[:-k] & han[k:]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        long = np.flatnonzero(edges[1::2] - edges[::2] >= (least - 1) * k)
        for a, b in zip(edges[::2][long].tolist(), edges[1::2][long].tolist()):
            alone = not (a and han[a - 1]) and not (b + k < len(han) and han[b + k])
            if han[a : b + k].all() and (code[a : a + k] != code[a]).any() and (k > 3 or alone):
                found.add(int(np.searchsorted(ends, a, side="right")))
    return found


class Finder:
    """Why a text is residue: 'placeholder', 'filler', 'notice', or None."""

    def __init__(self, min_sentence: float = 0.34, min_text: float = 0.5, min_parts: float = 0.45):
        self.min_sentence, self.min_text, self.min_parts = min_sentence, min_text, min_parts
        phrases: dict[str, set[str]] = {}

        def add(kind: str, words: list[str]) -> None:
            for w in words:
                phrases.setdefault(w, set()).add(kind)

        add("notice", _lines(NOTICES) + [f"{w} {c}" for w in CODE_WORDS for c in CODES] + [f"{c} {w}" for w in CODE_WORDS for c in CODES])
        add("filler", _lines(FILLERS))
        add("furniture", _lines(FURNITURE))
        for kind, block, sep in (
            ("thing", THINGS, " "), ("fail", FAILS, "|"), ("ask", ASKS, "|"), ("means", MEANS, "|"), ("insert", INSERTS, "|"), ("slot", SLOTS, "|"),
            ("about", ABOUT, "|"), ("bare", BARE, "|"), ("new", NEW, "|"), ("open", " ".join(OPENING), " "),
        ):
            add(kind, _parts(block, sep))
        first = {"notice", "fail", "means", "filler", "slot", "open", "bare", "new"}
        self.first = self._automaton({p: k & first for p, k in phrases.items() if k & first})
        self.all = self._automaton(phrases)

    @staticmethod
    def _automaton(phrases: dict[str, set[str]]):
        joined: dict[str, list] = {}
        whole = lambda c: c.isalnum() and c < "⺀"
        for phrase, kinds in phrases.items():
            word = phrase[:-1] if phrase[-1] == "-" and len(phrase) > 2 else phrase
            free = kinds & {"notice", "filler", "open"} and not phrase.isalpha()  # several words need no edges
            joined.setdefault(word, []).append((tuple(kinds), len(word), whole(word[0]) and not free, whole(word[-1]) and word == phrase and not free))
        out = ahocorasick.Automaton()
        for word, values in joined.items():
            out.add_word(word, values)
        out.make_automaton()
        return out

    @staticmethod
    def _hits(automaton, folded: str) -> dict[str, list[tuple[int, int]]]:
        """Places of each kind of phrase; words stand alone, other phrases anywhere."""
        of: dict[str, list[tuple[int, int]]] = {}
        for last, values in automaton.iter(folded):
            for kinds, size, edge_before, edge_after in values:
                a, b = last - size + 1, last + 1
                if edge_before and a and folded[a - 1].isalnum() and folded[a - 1] < "⺀":
                    continue
                if edge_after and b < len(folded) and folded[b].isalnum() and folded[b] < "⺀":
                    continue
                for kind in kinds:
                    of.setdefault(kind, []).append((a, b))
        return of

    def why(self, text: str | None, repeats: bool | None = None) -> str | None:
        """The reason; repeats: whether Han characters repeat, if that is known."""
        if not text or not text.strip():
            return None
        folded = text.lower().replace("’", "'")
        if len(folded) != len(text):  # folding that changes lengths would move positions
            folded = "".join(c.lower() if len(c.lower()) == 1 else c for c in text).replace("’", "'")
        of = self._hits(self.first, folded)
        if of:
            of = self._hits(self.all, folded)

        def explained(at: int, end: int) -> bool:
            """Whether the sentence around a place writes about templates, by two of its words."""
            if "about" not in of:
                return False
            left = max(text.rfind(c, 0, at) + len(c) for c in _STOPS if c != ". ")
            left = max(left, text.rfind(". ", 0, at) + 1)
            right = min((p for c in _STOPS if (p := text.find(c, end)) >= 0), default=len(text))
            return len({folded[a:b] for a, b in of["about"] if left <= a < right and not at <= a < end}) > 1

        done = -1
        for a, _ in of.get("open", ()):
            if a <= done or not (m := PLACEHOLDER.match(text, a)):
                continue
            done = a
            word = m[0].strip("<>")
            if m[0][0] == "<" and word in _HTML_TAGS and f"</{word}" in text:
                continue
            if not explained(*m.span()):
                return "placeholder"
        if any(not explained(a, b) for a, b in of.get("filler", ())) or REPEATED.search(folded) or (_repeats([text]) if repeats is None else repeats):
            return "filler"
        if any(not text[:a].strip() and _NEW_PAGE.match(text, b) for a, b in of.get("new", ())):
            return "filler"
        traces = [m.span() for m in _TRACE.finditer(text)] if _TRACED.search(text) else []
        kinds = of.keys()
        bare = folded.strip(" \t\n!.…！。0123456789-")
        if "bare" in kinds and any(folded[a:b] == bare for a, b in of["bare"]) or folded.strip() in CODES:
            return "notice"
        asked = "insert" in kinds and "slot" in kinds
        if traces or "notice" in kinds or ("thing" in kinds and "fail" in kinds) or ("ask" in kinds and "means" in kinds) or asked:
            return self._covered(text, of, traces)
        return None

    def _covered(self, text: str, of: dict[str, list[tuple[int, int]]], traces: list[tuple[int, int]]) -> str | None:
        """'filler' if a sentence asks for text, 'notice' if notices take up most of the text, tags, numbers and page furniture left out."""
        letters = _letters()[_codes(text)] & 1
        sentences = [m.span() for m in _SENTENCE.finditer(text) if m.end() > m.start()]
        starts = [a for a, _ in sentences]
        own: dict[int, list[tuple[int, int, str]]] = {}
        kinds = np.zeros(len(text), np.uint8)  # 0 content, 1 notice, 2 left out
        for pattern in (_NEUTRAL, _FUNCTION):
            for m in pattern.finditer(text):
                kinds[m.start() : m.end()] = 2
        for a, b in of.get("furniture", ()):
            kinds[a:b] = 2
        for kind in ("notice", "thing", "fail", "ask", "means", "insert", "slot"):
            for a, b in of.get(kind, ()):
                own.setdefault(bisect_right(starts, a) - 1, []).append((a, b, kind))
        whole, notices = set(), set()
        quoted = [m.span() for m in _QUOTED.finditer(text)]
        for i, found in sorted(own.items()):
            free = [(a, b, kind) for a, b, kind in found if not any(x <= a < y for x, y in quoted)]
            has = {kind for _, _, kind in free}
            if "insert" in has and "slot" in has and sum(b - a for a, b, kind in free if kind in ("insert", "slot")) >= self.min_sentence * letters[slice(*sentences[i])].sum():
                return "filler"
            used = {"notice"} if "notice" in has else set()
            goes_on = i - 1 in notices  # what is wrong, after the thing has been named
            used |= {"thing", "fail"} if {"thing", "fail"} <= has or "notice" in has or ("fail" in has and goes_on) else set()
            used |= {"ask", "means"} if {"ask", "means"} <= has or "notice" in has else set()
            if used:
                notices.add(i)
            if "notice" in has:
                whole.add(i)
            for a, b, kind in free:
                if kind in used:
                    kinds[a:b] = 1
        for a, b in traces:
            kinds[a:b] = 1
            whole.update(range(bisect_right(starts, a) - 1, bisect_right(starts, b - 1)))
        for a, b in quoted:
            kinds[a:b] = 0
        for m in _TAG.finditer(text):
            kinds[m.start() : m.end()] = 2
        counted = np.concatenate([[0], np.cumsum(letters * (kinds != 2))])
        ones = np.concatenate([[0], np.cumsum(letters * (kinds == 1))])
        matched = total = 0
        for i, (a, b) in enumerate(sentences):
            n = counted[b] - counted[a]
            if not n:
                continue
            total += n
            least = self.min_sentence if i in whole else self.min_parts
            if ones[b] - ones[a] >= least * n and text[a:b].rstrip()[-1:] not in ("?", "？"):
                matched += n
        return "notice" if total and matched >= self.min_text * total else None


def residue(df: DataFrame, id_col: str = "archive_id", fields: tuple[str, ...] = ("title", "cdoc"), **limits: float) -> DataFrame:
    """id_col and, per field, the reason (null where the field is content): one row per row of df.

    Null, empty and blank fields are no case by themselves. Repeated rows give repeated rows.
    limits: min_sentence, the share of a sentence that phrases must cover for it to be a notice;
    min_parts, the same where only parts of notices were found; min_text, the share of the text
    that such sentences must make up.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(**limits)
        for batch in batches:
            columns = []
            for c in batch.columns[1:]:
                texts = c.to_pylist()
                again = _repeats(texts)
                columns.append(pa.array([finder.why(t, i in again) for i, t in enumerate(texts)], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *[f"{f}_why" for f in fields]])

    kind = df.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *[f"{f}_why string" for f in fields]])
    return spread(df.select(id_col, *fields)).mapInArrow(scan, schema)
