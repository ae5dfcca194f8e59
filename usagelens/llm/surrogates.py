"""Personal data: keyed surrogates that keep type, format, script and gender.

Each detected entity gets a replacement drawn by HMAC from a key, its kind, its
normal form and the number of the attempt. So one entity has one surrogate in the
whole corpus (coreference), however it is written, and none can be traced back
without the key. Two checks over all distinct entities keep them apart: no two
entities of a kind share a surrogate, and no surrogate is itself an entity of the
corpus. Whatever fails is drawn again until nothing does; only these exceptions
have to be looked up, the others' surrogates follow from the key.

Kinds: e-mail addresses, phone numbers, card numbers, IPv4 addresses, US social
security numbers, IBANs, and persons named after a title. Digits stay digits and
letters stay letters of their case and script; card numbers and IBANs that check
still check; an address keeps its last label, a phone number its country code, an
octet its number of digits; a person's title gives the gender of the new name.
Persons are replaced part by part: a part of a name has one surrogate in the whole
corpus, of the gender that all titles before it agree on (none if they differ or tell
none), and where a title names a part in a document, every other mention of it there
is replaced too. Names may have hyphens, apostrophes, inner capitals, particles and up
to three parts; initials and particles stay. In Arabic, Hebrew and Devanagari, which
have no capitals, up to two words after a title are the name, and the first is looked
for again; Chinese, Japanese and Korean names stand before their title. Gender shows
in Latin, Cyrillic and Greek names. Names that no title tells, and titles that are not
in the lists below, are not found.
Phone numbers are found with a plus sign, as North American ones (known by the
same normal form with and without the 1 in front), and with a trunk 0 and 9 to 11
digits, however grouped; other national ones without a 0 in front are not told from
plain numbers. Without a country code that of a trunk form stays open, so it is
another entity than the same number with a plus sign.
Exception: where a format has no free surrogate left, later attempts widen it, so
that drawing always ends. After ``SAME`` attempts an IP address may have octets of
any length in its range, then comes from 10.0.0.0/8 (private ones) or anywhere, then
from 240.0.0.0/4, then has octets of 256 to 999, which no address of a corpus has;
the other kinds get a letter or digit more with each attempt.

Defined cases: null stays null, a text without entities stays as it is; repeated
rows get the same result; an empty table gives no rows; extra columns are kept by
``replace``. The default key is for tests; a real one is a parameter.
"""

from __future__ import annotations

import bisect
import hmac
import itertools
import re
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import base

KEY = b"not a secret: pass your own"
SAME = 3  # attempts that keep the format

# Titles with their gender, and names to draw from by script and gender.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Lord": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Signor": "m", "Senhor": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Lady": "f", "Dame": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mademoiselle": "f", "Mlle": "f", "Señora": "f", "Señorita": "f", "Sra": "f", "Signora": "f", "Senhora": "f",
    "Dr": "n", "Doctor": "n", "Doktor": "n", "Prof": "n", "Professor": "n", "Rev": "n",
    "Господин": "m", "Г-н": "m", "г-н": "m", "Госпожа": "f", "Г-жа": "f", "г-жа": "f", "Доктор": "n", "Профессор": "n",
    "Κύριος": "m", "Κύριε": "m", "Κυρία": "f", "Δρ": "n",
}
# Scripts without capitals: titles in front, and behind the name.
BEFORE = {"السيد": "m", "السيدة": "f", "الدكتور": "m", "الدكتورة": "f", "מר": "m", "גברת": "f", "श्री": "m", "श्रीमती": "f", "डॉ": "n"}
BEHIND = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f", "博士": "n", "教授": "n", "さん": "n", "씨": "n"}
STEMS = {
    ("LATIN", "m"): ("Alb", "Bern", "Carl", "Dor", "Ed", "Fern", "Gust", "Hug", "Ism", "Jul", "Kam", "Leon", "Mart", "Nor", "Osk", "Paul", "Rom", "Seb", "Theod", "Vikt"),
    ("LATIN", "f"): ("Adel", "Berth", "Clar", "Dian", "Emm", "Flor", "Greta", "Hel", "Irm", "Joh", "Kar", "Lau", "Mari", "Nad", "Oliv", "Paul", "Rosal", "Sof", "Tere", "Vior"),
    ("CYRILLIC", "m"): ("Алекс", "Борис", "Вадим", "Глеб", "Денис", "Егор", "Иван", "Кирил", "Лев", "Максим"),
    ("CYRILLIC", "f"): ("Анн", "Верон", "Дарь", "Елен", "Ирин", "Клавди", "Лиди", "Мари", "Надежд", "Ольг"),
}
ENDS = {
    ("LATIN", "m"): ("o", "us", "in", "ert"), ("LATIN", "f"): ("a", "ia", "ine", "etta"), ("LATIN", "n"): ("el", "is", "ey", "en"),
    ("CYRILLIC", "m"): ("", "ий", "ан", "ей"), ("CYRILLIC", "f"): ("а", "я", "ина", "ия"), ("CYRILLIC", "n"): ("ко", "их"),
    ("GREEK", "m"): ("ος", "ης"), ("GREEK", "f"): ("α", "η"),
}
SURNAMES = "王李张張刘劉陈陳杨楊黄黃赵趙吴吳周徐孙孫马馬朱胡郭何高林罗羅郑鄭梁谢謝宋唐许許韩韓冯馮邓鄧曹彭曾肖田董袁潘于蒋蔣蔡余杜叶葉程苏蘇魏吕呂丁任沈姚卢盧姜崔钟鐘谭譚陆陸汪范金石廖贾賈夏韦韋付方白邹鄒孟熊秦邱江尹薛闫段雷侯龙龍史陶黎贺賀顾顧毛郝龚龔邵万萬钱錢严嚴"
LETTERS = {"CJK": "伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂英华玉萍红玲辉建文志海云春雪梅", "HANGUL": "민서준지현우하윤도예은주호영수진성재승아"}

KINDS = ("email", "phone", "card", "ip", "ssn", "iban", "person")
_W = "[0-9A-Za-z_]"
NUMBERS = re.compile(
    r"(?P<iban>\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
    r"|(?P<phone>\+\d{1,3}[\x20.-]?(?:\(0\)[\x20.-]?)?\(?\d{2,4}\)?(?:\x20?/\x20?)?(?:[\x20.-]?\d{2,4}){2,4}(?!\d))"
    rf"|(?P<us>(?:(?<!{_W})1[\x20.-]?)?(?:\(\d{{3}}\)\x20?|(?<!{_W})\d{{3}}[\x20.-])\d{{3}}[\x20.-]\d{{4}}(?!{_W}))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    # Neither a date nor an address.
    rf"|(?P<trunk>(?:\(|(?<!{_W})(?<!\d[.,/-]))(?=0[1-9])(?!\d\d(?P<sep>[\x20./-])\d\d(?P=sep)(?:19|20)\d\d(?!\d))(?!(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?!\.?\d))"
    rf"\d\d(?:(?:\)?[\x20./-]|\)|\x20/\x20)?\d){{7,9}}(?!{_W}))"
    r"|(?P<card>(?<![\d.-])\d(?:[\x20-]?\d){12,18}(?![\d-]))"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
)
DIGIT = re.compile(r"\d")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_RUN = re.compile(r"(?:[^\W\d_]|[\u0300-\u036F\u0900-\u0903\u093A-\u094F])+")
_UPPER = "".join(re.escape(c) for c in map(chr, range(0x10000)) if c.isupper() or c.istitle())
_LOW = "[^\\W\\d_]"
# No names, though capitals may follow a name in headings.
_NOT = "The|And|Or|Of|In|On|At|To|For|From|By|With|As|Is|Was|Are|Has|Had|Will|Said|Says|But|He|She|It|We|They|You|His|Her|Who|When|Und|Der|Die|Das|Er|Sie|Et|Le|La|El|Il|Elle"
PART = re.compile(
    rf"(?<![^\W_])(?!(?:{_NOT}|{'|'.join(TITLES)})\b)[{_UPPER}](?:{_LOW}|[\u0300-\u036F]|[-\u2010\u2011'\u2019](?=[{_UPPER}])|['\u2019\u02BC](?=[а-яіїєґ]{{2}}))+"
)
_LEAD = rf"(?:[{_UPPER}]\.\s?|[{_UPPER}]\s)*(?:(?:van|von|vom|zu|de|der|den|del|della|la|le|du|di|da|do|dos|das|bin|ibn|al|el|ten|ter|y)\s|d['\u2019])*"
PERSON = re.compile(rf"(?<![^\W_])(?P<titles>(?:(?:{'|'.join(TITLES)})\b\.?\s)+)(?P<name>{_LEAD}{PART.pattern}(?:\s{_LEAD}{PART.pattern}){{0,2}})")
_WORD = r"(?:[\u0620-\u065F\u0670-\u06D3]{2,}|[\u05D0-\u05EA]{2,}|[\u0900-\u0963\u0970-\u097F]{2,})"
PERSON_BEFORE = re.compile(rf"(?<![^\W_])(?P<titles>{'|'.join(sorted(BEFORE, key=len, reverse=True))})\.?\s(?P<name>{_WORD}(?:\s{_WORD})?)")
PERSON_BEHIND = re.compile(
    rf"(?P<name>[{SURNAMES}][\u4E00-\u9FFF]{{0,2}}(?=\s?(?P<titles>先生|女士|小姐|太太|博士|教授))|(?!皆|奥|娘|患者)[\u4E00-\u9FFF々]{{2,4}}(?=(?P<san>さん))|[\uAC00-\uD7A3]{{2,4}}(?=\s?(?P<ssi>씨)(?![\uAC00-\uD7A3]{{2}})))"
)


def luhn(digits: str) -> int:
    """Sum that is a multiple of ten for valid card numbers."""
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def plain_digits(text: str) -> str:
    """Digits of any script as 0 to 9."""
    return text if text.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def normal(kind: str, text: str) -> str:
    """What an entity is known by, however it is written."""
    if kind == "person":
        return unicodedata.normalize("NFC", re.sub("[\u2019\u02BC]", "'", text)).casefold()
    text = plain_digits(text)
    if kind in ("phone", "card", "ssn"):
        digits = re.sub(r"\D", "", text.replace("(0)", "") if kind == "phone" else text)
        return f"1{digits}" if kind == "phone" and len(digits) == 10 and digits[0] != "0" and "+" not in text else digits
    return text.lower() if kind == "email" else text.replace(" ", "") if kind == "iban" else text


def numbers(text: str) -> Iterator[re.Match]:
    """What NUMBERS.finditer gives: every form begins with its first digit, or with a sign or two letters before it."""
    end = 0
    for d in DIGIT.finditer(text):
        at = d.start()
        if at < end:
            continue
        before = text[max(0, at - 2) : at]
        starts = (at - 1, at) if before[-1:] in ("+", "(") else (at - 2, at) if len(before) == 2 and before.isascii() and before.isalpha() and before.isupper() else (at,)
        for start in starts:
            if start >= end and (m := NUMBERS.match(text, start)):
                yield m
                end = m.end()
                break


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and normal form of each entity, leftmost first, none inside another."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m.group()) for m in EMAIL.finditer(text)]
    for m in numbers(text):
        kind, own = {"us": "phone", "trunk": "phone"}.get(m.lastgroup, m.lastgroup), m.group()
        if kind == "ip" and any(int(x) > 255 for x in own.split(".")) or kind == "iban" and iban_rest(own.replace(" ", "")) != 1:
            continue
        found.append((m.start(), m.end(), kind, own))
    found += persons(text)
    out, end = [], 0
    for a, b, kind, own in sorted(found, key=lambda x: (x[0], -x[1])):
        if a >= end:
            out.append((a, b, kind, own if kind == "person" else normal(kind, own)))
            end = b
    return out


def name_parts(name: str) -> list[tuple[int, int]]:
    """Where the parts of a name are; initials and particles are none."""
    if "\u4E00" <= name[0] <= "\u9FFF":
        return [(0, 1), (1, len(name))] if name[0] in SURNAMES and len(name) > 1 else [(0, len(name))]
    if name[0].isalpha() and name[0].upper() == name[0].lower():
        return [m.span() for m in re.finditer(r"\S+", name)]
    return [m.span() for m in PART.finditer(name)]


def persons(text: str) -> list[tuple[int, int, str, str]]:
    """Names after or before a title, then all other mentions of their parts; gender and name as written."""
    found = []
    if any(t in text for t in TITLES):
        for m in PERSON.finditer(text):
            genders = [g for t in re.findall(r"[\w-]+", m["titles"]) if (g := TITLES[t]) != "n"]
            found.append((m.start("name"), m.end("name"), "person", f"{(genders or 'n')[0]} {m['name']}"))
    cased = {normal("person", x[3][2:][a:b]) for x in found for a, b in name_parts(x[3][2:])}
    if not text.isascii():
        words, strings = set(), set()
        if any(t in text for t in BEFORE):
            for m in PERSON_BEFORE.finditer(text):
                found.append((m.start("name"), m.end("name"), "person", f"{BEFORE[m['titles']]} {m['name']}"))
                words.add(m["name"].split()[0])
        if any(t in text for t in BEHIND):
            for m in PERSON_BEHIND.finditer(text):
                found.append((m.start("name"), m.end("name"), "person", f"{BEHIND[m['titles'] or m['san'] or m['ssi']]} {m['name']}"))
                strings |= {x for x in (m["name"], *(m["name"][a:b] for a, b in name_parts(m["name"]))) if len(x) > 1}
        either = [rf"(?<![^\W_])(?:{'|'.join(map(re.escape, words))})(?!\w)"] * bool(words) + [re.escape(x) for x in sorted(strings, key=len, reverse=True)]
        if either:
            found += [(m.start(), m.end(), "person", f"n {m.group()}") for m in re.finditer("|".join(either), text)]
    if cased:
        covered = sorted(x[:2] for x in found)
        starts = [a for a, _ in covered]
        begins, bare = set(starts), []
        for m in PART.finditer(text):
            spans = [m.span()] if normal("person", m.group()) in cased else [(m.start() + r.start(), m.start() + r.end()) for r in _RUN.finditer(m.group()) if normal("person", r.group()) in cased]
            for a, b in spans:
                if bare and bare[-1][1] + 1 == a and text[a - 1].isspace() and a not in begins:
                    bare[-1][1] = b
                else:
                    bare.append([a, b])
        for a, b in bare:
            k = bisect.bisect_right(starts, a) - 1
            if k < 0 or covered[k][1] <= a:
                found.append((a, b, "person", f"n {text[a:b]}"))
    return found


def known_as(kind: str, own: str) -> list[tuple[str, str, str]]:
    """Kind, normal form and gender of what is replaced as one: the parts of a name, or all of another entity."""
    if kind != "person":
        return [(kind, own, "")]
    name = own[2:]
    return [(kind, normal(kind, name[a:b]), own[0]) for a, b in name_parts(name)]


class Draw:
    """Numbers drawn from a key and a name, as many as asked for."""

    def __init__(self, key: bytes, name: str):
        self.key, self.name, self.count, self.left = key, name.encode(), 0, 0

    def __call__(self, below: int) -> int:
        if self.left < 1 << 32:
            self.left = int.from_bytes(hmac.digest(self.key, self.name + b"\0%d" % self.count, "sha256"), "big")
            self.count += 1
        self.left, n = divmod(self.left, below)
        return n

    def like(self, text: str) -> str:
        kinds = (("0", "9"), ("a", "z"), ("A", "Z"))
        out = []
        for c in text:
            low = next((a for a, b in kinds if a <= c <= b), None)
            out.append(c if low is None else chr(ord(low) + self(10 if low == "0" else 26)))
        return "".join(out)


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """The normal form of an entity's replacement."""
    gender, name = (entity[0], entity[2:]) if kind == "person" else ("", entity)
    draw = Draw(key, f"{kind}\0{name}\0{attempt}")
    wider = max(0, attempt - SAME + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        labels = domain.split(".")
        return f"{draw.like(local + 'a' * wider)}@{'.'.join([*map(draw.like, labels[:-1]), labels[-1]])}"
    if kind == "phone":
        more = draw.like("0" * wider)
        return f"{entity[:-10]}{2 + draw(8)}{draw.like('00')}{2 + draw(8)}{draw.like('000000')}{more}" if len(entity) > 10 else entity[:2] + draw.like(entity[2:]) + more
    if kind == "card":
        new = entity[0] + draw.like(entity[1:] + "0" * wider)
        if luhn(entity) % 10 == 0:
            new = new[:-1] + str(-luhn(new[:-1] + "0") % 10)
        return new
    if kind == "ip":
        low = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        keep = 1 if entity.startswith("10.") else 2 if entity.startswith("192.168.") else 0
        octets = entity.split(".")
        if wider == 1 or wider == 2 and keep == 0:
            return ".".join([*octets[:keep], *(str(draw(256)) for _ in octets[keep:])])
        if wider == 2:
            return ".".join(["10", *(str(draw(256)) for _ in range(3))])
        if wider == 3:
            return ".".join([str(240 + draw(16)), *(str(draw(256)) for _ in range(3))])
        if wider:
            return ".".join(str(256 + draw(744)) for _ in octets)
        return ".".join([*octets[:keep], *(str(low[len(x)][0] + draw(low[len(x)][1])).rjust(len(x), "0") for x in octets[keep:])])
    if kind == "ssn":
        return f"{100 + draw(566):03d}{1 + draw(99):02d}{1 + draw(9999):04d}{draw.like('0' * wider)}"
    if kind == "iban":
        rest = draw.like(entity[4:] + "0" * wider)
        return f"{entity[:2]}{98 - iban_rest(entity[:2] + '00' + rest):02d}{rest}"
    # Each attempt may be one letter longer, so that there is always a name that is free.
    runs = _RUN.findall(name)
    one = lambda run: run if len(run) == 1 < max(map(len, runs)) else drawn_name(draw, script(run), gender, attempt)
    return normal(kind, _RUN.sub(lambda m: one(m.group()), name))


def script(text: str) -> str:
    return unicodedata.name(text[0], "LATIN").split()[0].partition("-")[0]


def letters(of: str) -> str:
    """Letters to draw from in a script; small ones if it has capitals. A worker keeps what it has looked up."""
    if of in ("LATIN", "CYRILLIC"):
        return "abcdefghijklmnopqrstuvwxyz" if of == "LATIN" else "аеиоу"
    known = base.worker_state("letters")
    if of not in known:
        every = [c for c in map(chr, range(0x370, 0xFB00)) if c.isalpha() and not c.isupper() and re.fullmatch(rf"{of} (?:SMALL )?LETTER [A-Z]+", unicodedata.name(c, "")) and c.casefold() == c]
        known[of] = LETTERS.get(of) or "".join(every) or letters("LATIN")
    return known[of]


def drawn_name(draw: Draw, of: str, gender: str, attempt: int) -> str:
    pick = lambda x: x[draw(len(x))]
    stems = STEMS.get((of, gender)) or STEMS.get((of, "m"), ("",)) + STEMS.get((of, "f"), ())
    least = 1 if of in LETTERS else 2 if stems != ("",) else 4
    return pick(stems) + "".join(pick(letters(of)) for _ in range(least + attempt)) + pick(ENDS.get((of, gender), ("",)))


def laid_out(kind: str, written: str, new: str) -> str:
    """A new normal form in the format of what was written."""
    if kind == "person":
        if written.isupper():
            return new.upper()
        follow = iter(_RUN.findall(written))
        return _RUN.sub(lambda m: m.group().capitalize() if next(follow)[0].isupper() else m.group(), new)
    if kind in ("phone", "card", "ssn", "iban"):
        # A phone number may be written without its country code, or with a trunk 0 that its normal form lacks.
        head, zero, tail = written.partition("(0)") if kind == "phone" else ("", "", written)
        head, zero, tail = (head, zero, tail) if zero else ("", "", written)
        follow = iter(new[len(normal(kind, written)) - sum(c.isalnum() for c in head + tail) :])
        put = lambda text: "".join(next(follow) if c.isalnum() else c for c in text)
        return put(head) + zero + put(tail) + "".join(follow)
    if kind == "email":
        both = zip(written.partition("@"), new.partition("@"), strict=True)
        return "".join(n.upper() if w.isupper() else n for old, own in both for w, n in itertools.zip_longest(old, own, fillvalue=""))
    return new


def entities(docs: DataFrame) -> DataFrame:
    """Documents with entities: doc_id and a row for each distinct one."""

    def act(batch: pa.RecordBatch) -> list:
        rows = [(doc, *own) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) if text for own in sorted({y for x in detect(text) for y in known_as(*x[2:])})]
        return list(map(list, zip(*rows, strict=True))) or [[]]

    return base.map_batches(docs.select("doc_id", "text"), lambda: act, "doc_id long, kind string, entity string, gender string")


def resolved(found: DataFrame) -> DataFrame:
    """Distinct entities; a part of a name has the gender that all titles of the corpus agree on, else none (n)."""
    m, f = (F.bool_or(F.col("gender") == g) for g in "mf")
    gender = F.when(m & ~f, "m").when(f & ~m, "f").otherwise("n")
    every = found.groupBy("kind", "entity").agg(gender.alias("gender"))
    return every.withColumn("full", F.when(F.col("kind") == "person", F.concat_ws(" ", "gender", "entity")).otherwise(F.col("entity")))


def exceptions(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, entity, attempt) of the entities whose first surrogate is taken or is an entity itself."""
    every = base.saved(found.select("kind", "entity").distinct(), "entities")

    def drawn(table: DataFrame) -> DataFrame:
        def act(batch: pa.RecordBatch) -> list:
            columns = [batch.column(c).to_pylist() for c in ("kind", "entity", "attempt")]
            return [*columns, [surrogate(k, e, n, key) for k, e, n in zip(*columns, strict=True)]]

        return base.map_batches(table, lambda: act, "kind string, entity string, attempt int, surrogate string")

    given = base.saved(drawn(every.withColumn("attempt", F.lit(0))), "drawn")
    while True:
        # Of several with one surrogate the earliest attempt, then the smallest entity, keeps it.
        winner = given.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity"))["entity"].alias("winner"))
        real = every.select("kind", F.expr("if(kind = 'person', substr(entity, 3), entity)").alias("surrogate"), F.lit(True).alias("real"))
        checked = given.join(winner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        checked = base.saved(checked.withColumn("bad", (F.col("winner") != F.col("entity")) | F.coalesce("real", F.lit(False))), "checked")
        bad = checked.filter("bad")
        if bad.isEmpty():
            return given.filter("attempt > 0").select("kind", "entity", "attempt")
        again = drawn(bad.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")))
        given = base.saved(checked.filter("not bad").select("kind", "entity", "attempt", "surrogate").unionByName(again), "drawn")


def _replaced(text: str | None, odd: dict, key: bytes) -> tuple[str | None, list[tuple[int, int, str, str]]]:
    if not text:
        return text, []
    found, out, at = detect(text), [], 0
    for a, b, kind, own in found:
        spans = [(a + x, a + y) for x, y in name_parts(text[a:b])] if kind == "person" else [(a, b)]
        for (a, b), (_, entity, _) in zip(spans, known_as(kind, own), strict=True):
            gender, attempt = odd.get((kind, entity), ("n", 0))
            full = f"{gender} {entity}" if kind == "person" else entity
            out += [text[at:a], laid_out(kind, text[a:b], surrogate(kind, full, attempt, key))]
            at = b
    return "".join([*out, text[at:]]) if found else text, found


def replace(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row per document: the text with surrogates, and the number of entities of each kind."""
    found = base.saved(entities(docs), "found")
    every = base.saved(resolved(found), "resolved")
    again = exceptions(every.select("kind", F.col("full").alias("entity")), key).withColumnRenamed("entity", "full")
    told = every.join(again, ["kind", "full"], "left").filter("kind = 'person' or attempt is not null")
    odd = base.saved(told.select("kind", "entity", "gender", F.coalesce("attempt", F.lit(0)).alias("attempt")), "exceptions")
    own = found.select("doc_id", "kind", "entity").join(odd, ["kind", "entity"]).groupBy("doc_id").agg(F.collect_list(F.struct("kind", "entity", "gender", "attempt")).alias("odd"))
    own = base.saved(own, "document-exceptions").withColumnRenamed("doc_id", "odd_id")
    joined = docs.select("doc_id", "text").join(own, F.col("doc_id").eqNullSafe(F.col("odd_id")), "left").select("doc_id", "text", "odd")

    def act(batch: pa.RecordBatch) -> list:
        rows = []
        for doc, text, other in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "odd")), strict=True):
            new, found = _replaced(text, {(x["kind"], x["entity"]): (x["gender"], x["attempt"]) for x in other or ()}, key)
            kinds = [x[2] for x in found]
            rows.append((doc, len(found), *map(kinds.count, KINDS), new))
        return list(map(list, zip(*rows, strict=True)))

    schema = f"doc_id long, n_entities long, {', '.join(f'n_{k} long' for k in KINDS)}, text string"
    return base.map_batches(joined, lambda: act, schema)
