"""Personal data and secrets, replaced by keyed surrogates.

Detected: e-mail addresses, IPv4 addresses, phone numbers, payment card numbers
(those that pass the Luhn check), US social security numbers, IBANs, assigned
secrets and keys, and names: after a title, after a salutation or closing, with a
common given name in front, and further mentions of a full name that the text has
so introduced. A surrogate is of the same type and keeps the format: every digit,
letter, script and case stays one, a card still passes the Luhn check, an IBAN
keeps a valid checksum, octets stay octets, the top-level domain stays, and a
woman's name becomes a woman's name in the same script (by lists for Latin and
Cyrillic letters; in other scripts a name's letters are permuted like any
value's). Given and family names are replaced word by word, so that a family name
keeps its surrogate behind any given name or title.

Values of one format are permuted among themselves by a keyed Feistel network
over the numbers that write that format, so one value always gets one surrogate
(coreference, over all documents) and two values never share one. Names are
drawn from lists and syllables by a keyed hash, so they can collide. The
distinct entities of the corpus are checked: a surrogate used twice, or equal
to a value that occurs, is drawn again in the next round, until none is left.
From round ``NARROW`` on, when the values of a format may be used up, surrogates
are wider than their values, by one more place each round (names by a syllable,
addresses go to IPv6's 2001:db8::/32), so that rounds come to an end. Letters and
digits outside ``_ALPHABETS`` stay in their script; a secret without any letter
or digit becomes a keyed token of its length. Such exceptions travel by a join to the documents that need them, nothing about
entities is collected.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from ipaddress import IPv6Address
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .. import tables as shared

KEY = b"waymark surrogate key"
FEISTEL = 8
#: Draws in a value's own format before surrogates get wider.
NARROW = 8
#: Rows that are rewritten at a time.
ROWS = 1000

_TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m", "господин": "m", "Господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Señorita": "f", "Sra": "f", "Doña": "f", "госпожа": "f", "Госпожа": "f",
    "Dr": "n", "Prof": "n", "Professor": "n",
}
_GIVEN = {
    ("latin", "m"): "Adam Albert Anton Bruno Carl David Eduard Emil Felix Georg Henri Hugo Jonas Julian Karl Leo Lukas Marco Martin Max Nico Oscar Otto Paul Peter Simon Theo Thomas Victor Walter".split(),
    ("latin", "f"): "Ada Alice Anna Carla Clara Diana Elena Elsa Emma Eva Flora Greta Helena Ida Irene Julia Laura Lena Lucia Maria Marta Mia Nina Nora Olga Paula Rosa Sara Silvia Vera".split(),
    ("cyrillic", "m"): "Алексей Андрей Антон Борис Виктор Глеб Денис Егор Иван Игорь Кирилл Максим Николай Олег Павел Роман Сергей Тимур Фёдор Юрий".split(),
    ("cyrillic", "f"): "Алина Алла Анна Вера Галина Дарья Елена Жанна Инна Ирина Ксения Лариса Мария Нина Ольга Полина Раиса Софья Тамара Юлия".split(),
}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke la le lo ma me mi na ne ni ra re ri sa se so ta".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та".split(),
}
_ENDING = {("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова", ("cyrillic", "n"): "ко"}

#: Words that a name follows, other than titles: salutations, closings, introductions.
_BEFORE = (
    r"(?:Dear|Hello|Hi|Liebe|Lieber|Hallo|Cher|Chère|Bonjour|Estimado|Estimada|Querido|Querida|Дорогой|Дорогая|Уважаемый|Уважаемая)[ ]+"
    r"|(?:[Mm]y name is|[Ss]igned by|[Ii]ch heiße|[Jj]e m'appelle|[Mm]e llamo|[Мм]еня зовут)[ ]+"
    r"|(?:[Rr]egards|[Ss]incerely|[Yy]ours|Grüßen|Grüße|Cordialement|Atentamente|Saludos|уважением),?[ ]*\n[ ]*"
)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NAME = r"[^\W\d_a-zа-яё][^\W\d_]*(?:[-'][^\W\d_]+)?"
_FIRST = {name: gender for (_, gender), names in _GIVEN.items() for name in names}
#: What a text must have for the slow pattern of secrets to be tried.
_SECRET_WORDS = ("key", "token", "passw", "pwd", "secret")
_LONG = re.compile(r"[A-Za-z0-9_-]{14}")
_KINDS = {
    "secret": re.compile(
        r"""(?i:\b(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|passwd|password|pwd|client[_-]?secret)\b["']?\s*[:=]\s*)(["'])(?P<quoted>[^"'\n]{6,})\1"""
        r"""|(?i:\b(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|passwd|password|pwd|client[_-]?secret)\b\s*[:=]\s*)(?P<bare>(?=\S*\d)[^\s"',;]{8,})"""
        r"""|\b(?P<shape>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[abpr]-[A-Za-z0-9-]{10,}|(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,})\b"""
    ),
    "email": re.compile(r"(?P<whole>[\w.%+-]*\w@(?:[^\W_][\w-]*\.)+[^\W\d_]{2,})"),
    "iban": re.compile(r"\b(?P<whole>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b"),
    "ip": re.compile(rf"(?<![\w.])(?P<whole>(?:{_OCTET}\.){{3}}{_OCTET})(?![\w]|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])(?P<whole>\d{3}-\d{2}-\d{4})(?![\w-])"),
    "card": re.compile(r"(?<![\w-])(?P<whole>\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\w-])"),
    "phone": re.compile(r"(?<![\w+])(?P<whole>\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"),
    "name": re.compile(rf"\b(?P<title>{'|'.join(sorted(_TITLES, key=len, reverse=True))})\b\.?[ ]+(?P<whole>{_NAME}(?:[ ]{_NAME}){{0,2}})"),
}
#: The first of two words that may both be parts of a name.
_PAIR = re.compile(rf"({_NAME}) (?=[^\W\d_a-zа-яё])")
_GREETED = re.compile(rf"\b(?:{_BEFORE})(?P<whole>{_NAME}(?:[ ]{_NAME}){{1,2}})")
_CALLED = re.compile(rf"\b(?P<whole>(?:{'|'.join(sorted(_FIRST, key=len, reverse=True))})(?:[ ]{_NAME}){{1,2}})")
_MAY_GREET = (
    *(f"{w} " for w in "Dear Hello Hi Liebe Lieber Hallo Cher Chère Bonjour Estimado Estimada Querido Querida Дорогой Дорогая Уважаемый Уважаемая".split()),
    "y name is", "igned by", "ch heiße", "e m'appelle", "e llamo", "еня зовут", "egards", "incerely", "Yours", "yours", "Grüße", "Cordialement", "Atentamente", "Saludos", "уважением",
)


def _luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _gender(name: str, otherwise: str = "n") -> str:
    """By a common given name in front, else as the title says."""
    return _FIRST.get(name.split(" ")[0], otherwise) if " " in name else otherwise


def _names(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Names without a title: after a salutation or closing, with a common given name, or met before in the text."""
    pairs = _PAIR.findall(text)
    if not pairs:
        return []
    taken = {e[0] for e in found if e[2] == "name"}
    out = []
    patterns = [_GREETED] if any(w in text for w in _MAY_GREET) else []
    if not _FIRST.keys().isdisjoint(pairs):
        patterns.append(_CALLED)
    for pattern in patterns:
        for m in pattern.finditer(text):
            start, end = m.span("whole")
            if start not in taken and text[start].isupper() and not m["whole"].split(" ")[0] in _TITLES:
                taken.add(start)
                out.append((start, end, "name", _gender(m["whole"])))
    known = {text[a:b]: d for a, b, k, d in [*found, *out] if k == "name" and " " in text[a:b] and text[a].isupper()}
    for name in sorted(known, key=len, reverse=True):
        for m in re.finditer(rf"(?<!\w){re.escape(name)}(?!\w)", text):
            if m.start() not in taken:
                taken.add(m.start())
                out.append((*m.span(), "name", known[name]))
    return out


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, detail) of all entities, none overlapping; earlier kinds win."""
    digit = re.search(r"\d", text) is not None
    lower = text.lower()
    may = {
        "email": "@" in text,
        "name": any(t in text for t in _TITLES),
        "secret": any(w in lower for w in _SECRET_WORDS) or digit and _LONG.search(text) is not None,
    }
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in _KINDS.items():
        if not may.get(kind, digit):
            continue
        for m in pattern.finditer(text):
            group = next(g for g in ("whole", "quoted", "bare", "shape") if g in m.groupdict() and m[g] is not None)
            value, detail = m[group], ""
            if kind == "iban" and (not 15 <= len(value.replace(" ", "")) <= 34 or _mod97(value.replace(" ", "")) != 1):
                continue
            if kind == "card" and _luhn(re.sub(r"\D", "", value)):
                continue
            if kind == "name":
                if m["title"] in ("Sr", "Don", "Sir", "Dr", "Miss", "Prof") and not value[0].isupper():
                    continue
                detail = _gender(value, _TITLES[m["title"]])
            found.append((*m.span(group), kind, detail))
    found += _names(text, found)
    found.sort(key=lambda e: (list(_KINDS).index(e[2]), e[0], -e[1]))
    out: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for e in found:
        if all(e[1] <= a or e[0] >= b for a, b in taken):
            out.append(e)
            taken.append(e[:2])
    return sorted(out)


_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþßÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω"]


class _Alphabets(dict):
    """The alphabet of a character, "" if it stays: ``_ALPHABETS``, else the digits of its script or its like among 256 code points."""

    def __missing__(self, c: str) -> str:
        found = ""
        if c.isdecimal():
            zero = ord(c) - unicodedata.decimal(c)
            found = "".join(map(chr, range(zero, zero + 10)))
        elif c.isalnum():
            like = lambda x: (unicodedata.category(x), x.lower() == x, x.isalnum(), unicodedata.name(x, "").split(" ")[0])
            block = map(chr, range(ord(c) & ~0xFF, (ord(c) | 0xFF) + 1))
            found = "".join(x for x in block if like(x) == like(c) and x not in _COMMON)
        found = found if len(found) > 1 else ""
        self[c] = found
        return found


_COMMON = frozenset("".join(_ALPHABETS))
_OF = _Alphabets({c: a for a in _ALPHABETS for c in a})
_TOKEN = "".join(_ALPHABETS[:3])
_HEX = ("0123456789abcdef", "0123456789ABCDEF")


def _folded(value: str) -> str:
    """Lower case, character by character, so that places stay."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in value)


def _raised(value: str) -> str:
    return "".join(up if len(up := c.upper()) == 1 else c for c in value)


def _script(word: str) -> str:
    """latin or cyrillic, by the first letter; else empty."""
    name = unicodedata.name(next((c for c in word if c.isalpha()), " "), "")
    return next((x for x in ("latin", "cyrillic") if name.startswith(x.upper())), "")


class Surrogates:
    """Keyed replacements; ``attempt`` selects another permutation."""

    def __init__(self, key: bytes = KEY):
        self.key = key

    def _hash(self, *parts: object) -> int:
        return int.from_bytes(hashlib.blake2b(repr(parts).encode(), key=self.key, digest_size=32).digest(), "big")

    def _permute(self, x: int, size: int, *tweak: object) -> int:
        """A permutation of range(size): a Feistel network over a slightly larger square, walked until inside."""
        if size < 2:
            return x
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(x, b)
            for r in range(FEISTEL):
                if r % 2:
                    right = (right + self._hash(tweak, size, r, left)) % b
                else:
                    left = (left + self._hash(tweak, size, r, right)) % a
            x = left * b + right
            if x < size:
                return x

    def _shaped(self, value: str, *tweak: object) -> str:
        """Each character replaced within its alphabet; others stay and are part of the format."""
        if hexadecimal := next((h for h in _HEX if len(value) >= 16 and set(value) <= set(h)), None):
            of = dict.fromkeys(hexadecimal, hexadecimal)
        else:
            of = _OF
        sizes = [len(of[c]) for c in value if of[c]]
        shape = "".join(of[c][0] if of[c] else c for c in value)
        x = 0
        for c in value:
            if of[c]:
                x = x * len(of[c]) + of[c].index(c)
        x = self._permute(x, prod(sizes), shape, bool(hexadecimal), *tweak)
        out = list(value)
        for k in range(len(value) - 1, -1, -1):
            if alphabet := of[value[k]]:
                x, d = divmod(x, len(alphabet))
                out[k] = alphabet[d]
        return "".join(out)

    def _token(self, n: int, alphabet: str, *tweak: object) -> str:
        """``n`` characters by the keyed hash."""
        return "".join(alphabet[self._hash("token", k, *tweak) % len(alphabet)] for k in range(n))

    def _wider(self, attempt: int, alphabet: str, *tweak: object) -> str:
        """What a surrogate is longer by: nothing at first, then one more character for each attempt."""
        return self._token(max(0, attempt - NARROW + 1), alphabet, attempt, *tweak)

    def canonical(self, kind: str, value: str) -> str:
        """What mentions of one entity share."""
        if kind in ("card", "phone", "ssn"):
            return re.sub(r"\D", "", value)
        if kind == "iban":
            return value.replace(" ", "")
        return _folded(value) if kind in ("email", "name") else value

    def of(self, kind: str, canonical: str, detail: str = "", attempt: int = 0) -> str:
        """The surrogate of a canonical value, itself canonical."""
        if kind == "ip":
            if attempt >= NARROW:
                return str(IPv6Address((0x20010DB8 << 96) + self._hash(kind, canonical, attempt) % 2**96))
            x = 0
            for o in canonical.split("."):
                x = x * 256 + int(o)
            x = self._permute(x, 256**4, "ip", attempt)
            return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
        if kind == "email":
            local, domain = canonical.rsplit("@", 1)
            host, top = domain.rsplit(".", 1)
            local, host = self._shaped(f"{local}@{host}", kind, attempt).split("@")
            return f"{local}{self._wider(attempt, _ALPHABETS[1], kind, canonical)}@{host}.{top}"
        if kind == "card":
            # The check digit follows from the rest; one that was wrong stays wrong by as much.
            off, head = _luhn(canonical), canonical[:1] + self._shaped(canonical[1:-1], kind, canonical[0], _luhn(canonical), attempt)
            head += self._wider(attempt, _OF[canonical[-1]], kind, canonical)
            return head + _OF[canonical[-1]][(off - _luhn(head + "0")) % 10]
        if kind == "iban":
            body = self._shaped(canonical[4:], kind, canonical[:2], attempt) + self._wider(attempt, _ALPHABETS[0], kind, canonical)
            return canonical[:2] + f"{98 - _mod97(canonical[:2] + '00' + body):02d}" + body
        if kind == "name":
            return self._name(canonical, detail, attempt)
        if kind == "secret":
            if any(_OF[c] for c in canonical):
                return self._shaped(canonical, kind, attempt) + self._wider(attempt, _ALPHABETS[0], kind, canonical)
            return self._token(len(canonical), _TOKEN, kind, canonical, attempt) + self._wider(attempt, _TOKEN, kind, canonical)
        return self._shaped(canonical, kind, attempt) + self._wider(attempt, _OF[canonical[-1]], kind, canonical)

    def _name(self, canonical: str, detail: str, attempt: int) -> str:
        """Word by word: given names by gender, the last word a family name."""
        *given, family = canonical.split(" ")
        out = []
        for word in given:
            script, h = _script(word), self._hash("given", word, detail, attempt)
            names = _GIVEN.get((script, detail if detail != "n" else "mf"[h % 2]))
            out.append(_folded(names[(h >> 8) % len(names)]) if names else self._shaped(word, "given", attempt))
        script, h = _script(family), self._hash("family", family, attempt)
        if parts := _SYLLABLES.get(script):
            new = "".join(parts[(h >> 8 * k) % len(parts)] for k in range(4))
            new += "".join(parts[self._hash("more", family, attempt, k) % len(parts)] for k in range(attempt - NARROW + 1)) + _ENDING.get((script, detail), "")
        else:
            new = self._shaped(family, "family", attempt) + self._wider(attempt, _OF[family[-1]] or _TOKEN[10:36], "family", family)
        return " ".join([*out, new])

    def written(self, kind: str, value: str, surrogate: str) -> str:
        """``surrogate`` in the format of the mention ``value``."""
        if kind in ("card", "phone", "ssn"):
            digits = iter(surrogate)
            return re.sub(r"\d", lambda m: next(digits), value) + "".join(digits)
        if kind == "iban":
            chars = iter(surrogate)
            return "".join(c if c == " " else next(chars) for c in value) + "".join(chars)
        if kind == "email":
            return "".join(_raised(s) if c.isupper() and _folded(_raised(s)) == s else s for c, s in zip(value, surrogate)) + surrogate[len(value) :]
        if kind == "name":
            if value.isupper() and len(value) > 1:
                return _raised(surrogate)
            return " ".join(_raised(w[0]) + w[1:] for w in surrogate.split(" ")) if value[0].isupper() else surrogate
        return surrogate


def _mentions(key: bytes):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Surrogates(key)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for k, x in enumerate(b.column("text")):
                text = x.as_py() or ""
                once = {(e[2], make.canonical(e[2], text[e[0] : e[1]]), e[3]) for e in detect(text)}
                for kind, value, detail in sorted(once):
                    for column, v in zip(out, (k, kind, value, detail, make.of(kind, value, detail))):
                        column.append(v)
            row = pa.array(out[0], pa.int64())
            yield pa.record_batch(
                [b.column("doc_id").take(row), b.column("tkey").take(row), *(pa.array(c, pa.string()) for c in out[1:])],
                names=["doc_id", "tkey", "kind", "value", "detail", "surrogate"],
            )

    return of


def _again(key: bytes):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Surrogates(key)
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("kind", "value", "detail", "attempt")))
            new = [make.of(*r) for r in rows]
            yield b.set_column(b.schema.get_field_index("surrogate"), "surrogate", pa.array(new, pa.string()))

    return of


def resolve(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """``entities`` (kind, value, detail, surrogate), distinct, with attempt and collision-free surrogates.

    There are as many rounds as it takes: from ``NARROW`` on, each chooses among at
    least ten times the surrogates of the one before (addresses among 2^96).
    """
    current = shared.table(entities.distinct().withColumn("attempt", F.lit(0)), "entities")
    me = F.struct("value", "detail")
    while True:
        # The smallest user of a surrogate keeps it, unless the surrogate occurs in the corpus.
        users = current.groupBy("kind", "surrogate").agg(F.min(me).alias("first"), F.count("*").alias("n"))
        real = current.select("kind", F.col("value").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        users = users.join(real, ["kind", "surrogate"], "left").where("n > 1 or real")
        joined = current.join(users, ["kind", "surrogate"], "left")
        joined = joined.withColumn("lost", F.col("n").isNotNull() & (F.coalesce("real", F.lit(False)) | (me != F.col("first"))))
        judged = shared.table(joined.select(*current.columns, "lost"), "judged")
        if judged.where("lost").isEmpty():
            shared.discard(judged)
            return current
        lost = judged.where("lost").drop("lost").withColumn("attempt", F.col("attempt") + 1)
        renewed = lost.mapInArrow(_again(key), lost.schema)
        old, current = current, shared.table(judged.where("not lost").drop("lost").union(renewed), "entities")
        shared.discard(old)
        shared.discard(judged)


def replace(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """``docs`` with the text rewritten, and n_entities and kinds (name=count, sorted) added.

    Null text stays null and has no entities, an empty one stays empty; texts are
    searched whole, however long. Repeated rows are rewritten alike and come out
    as often as they went in. Where entities of several kinds overlap, the kind
    that is listed first wins, then the one that begins first (ties: the longer).
    An empty table gives no rows. Columns named like the two added ones give way.
    """
    docs = docs.drop(*(c for c in ("n_entities", "kinds") if c not in (id_col, text_col)))
    keyed = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.xxhash64(text_col).alias("tkey"), F.col(text_col).alias("text"))
    schema = "doc_id string, tkey long, kind string, value string, detail string, surrogate string"
    mentions = shared.table(keyed.mapInArrow(_mentions(key), schema), "mentions")
    names = ["kind", "value", "detail"]
    settled = resolve(mentions.select(*names, "surrogate"), key)
    renewed = settled.where("attempt > 0").select(*names, F.col("surrogate").alias("again"))
    odd = mentions.join(renewed, names).groupBy("doc_id", "tkey").agg(F.collect_list(F.struct(*names, "again")).alias("__again"))
    odd = shared.table(odd.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__tkey"), "__again"), "renewed")
    joined = docs.join(odd, F.col(id_col).cast("string").eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__tkey")), "left").drop("__id", "__tkey")
    out = T.StructType([*docs.schema.fields, T.StructField("n_entities", T.IntegerType()), T.StructField("kinds", T.StringType())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Surrogates(key)
        for b in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            texts, counts, kinds = [], [], []
            for x, a in zip(b.column(text_col), b.column("__again")):
                text = x.as_py()
                again = {(e["kind"], e["value"], e["detail"]): e["again"] for e in a.as_py() or ()}
                parts, at, n = [], 0, {}
                for start, end, kind, detail in detect(text or ""):
                    value = text[start:end]
                    canonical = make.canonical(kind, value)
                    surrogate = again.get((kind, canonical, detail)) or make.of(kind, canonical, detail)
                    parts += [text[at:start], make.written(kind, value, surrogate)]
                    at = end
                    n[kind] = n.get(kind, 0) + 1
                texts.append(text if text is None else "".join(parts) + text[at:])
                counts.append(sum(n.values()))
                kinds.append(",".join(f"{k}={v}" for k, v in sorted(n.items())))
            b = b.drop_columns(["__again"])
            b = b.set_column(b.schema.get_field_index(text_col), text_col, pa.array(texts, pa.string()))
            yield pa.record_batch([*b.columns, pa.array(counts, pa.int32()), pa.array(kinds, pa.string())], names=[*b.schema.names, "n_entities", "kinds"])

    return joined.mapInArrow(rewrite, out)


def rewritten(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", key: bytes = KEY) -> DataFrame:
    """``docs`` with its own columns only: the text rewritten, and ``size_col``, if there is one, its code points."""
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    new = {text_col: F.col("text")}
    if size_col in docs.columns:
        new[size_col] = F.char_length("text").cast(docs.schema[size_col].dataType)
    return replace(packed, "id", "text", key).select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
