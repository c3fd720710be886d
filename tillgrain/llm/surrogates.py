"""Personal data replaced by keyed surrogates of the same type and format.

Entities: e-mail and IP addresses (versions 4 and 6), phone, card and account numbers, IBANs, social
security numbers, secrets (keys, tokens, passwords) and names: capitalised words behind a form of
address or behind a known given name. A name found once in a text is the same person wherever one of
its words stands in that text, so all of them get the surrogate of that word. Plain digits count as
a phone or social security number behind a word that says so. A surrogate keeps what its type needs: separators, letter case, script, length, check digits (Luhn, IBAN), the
country code of a phone number or IBAN, the address block of an IP, the top-level domain, and the
gender of a given name.

Surrogates come from keyed permutations of all strings of one format: a string is a number in a
mixed radix, one digit per character of its class, and ``_shifted`` conjugates a step by one with
a keyed Feistel permutation. That is one to one, moves every string of a format with more than
one member, and depends on key and entity only: equal entities get equal surrogates in every
document and task without a shared table, and different ones never meet. Spellings of one
entity (punctuation of numbers, case of addresses) count as one. ``surrogate_table`` lists the
distinct entities of a corpus, and ``collisions`` checks the claim on them, type by type.

Defined cases: NULL stays NULL, empty stays empty; texts without entities are unchanged to the
byte; overlapping finds go to the leftmost, then to the type named first; repeated rows get equal
results; other columns are kept.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import append_columns, as_bytes, map_texts, packed

ROUNDS = 6

# Alphabets by character class and given names by gender and script.
ALPHABETS = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåèéêëìíîïòóôõöùúûü",
    "ÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜ",
    "аеиоуыэюя",
    "бвгджзклмнпрстфхцчшщ",
    "АЕИОУЫЭЮЯ",
    "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
    "ΑΕΗΙΟΥΩ",
    "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
GIVEN_NAMES = {
    ("female", "latin"): "Alice Anna Clara Diana Elena Emma Eva Julia Laura Lucy Maria Nina Olivia Paula Rosa Sara Sofia Teresa".split(),
    ("male", "latin"): "Adam Alan Bruno Carlos Daniel David Erik Felix Hugo Ivan James John Karl Leon Marco Oscar Paul Peter".split(),
    ("female", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("male", "cyrillic"): "Антон Борис Виктор Денис Иван Игорь Олег Павел Роман Сергей".split(),
    ("female", "greek"): "Άννα Ειρήνη Ελένη Κατερίνα Μαρία Σοφία".split(),
    ("male", "greek"): "Αλέξης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
FORMS_OF_ADDRESS = (
    "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Srta Sr Sra Don Doña"
    " Господин Госпожа Κύριος Κυρία"
).split()

_CLASS = {c: i for i, a in enumerate(ALPHABETS) for c in a}
_PLACE = {c: i for a in ALPHABETS for i, c in enumerate(a)}
_HEX = "0123456789abcdef"
_FORMS = frozenset(FORMS_OF_ADDRESS)
_GIVEN = {n: key for key, names in GIVEN_NAMES.items() for n in names}

_WORD = r"[^\W\d_][^\W\d_'’-]*"
_SIMPLE = (
    r"(?P<secret>(?i:\b(?:api[_-]?key|access[_-]?key|key|token|secret|password|passwd|pwd)\b[\"']?\s*"
    r"(?:[:=]\s*|is\s+(?=[^\s\"',;]*\d)))"
    r"(?:\"[^\"\n]{6,}\"|'[^'\n]{6,}'|[^\s\"',;]{8,})"
    r"|\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|(?<![0-9A-Za-z])[0-9a-f]{32,128}(?![0-9A-Za-z]))"
    r"|(?P<email>[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b)"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?=\d)(?i:(?<=\bssn )|(?<=\bssn: )|(?<=social security number ))\d{9}(?!\d))"
    r"|(?P<card>(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"
    r"|(?=\d)(?i:(?<=\bphone )|(?<=\bphone: )|(?<=\btel )|(?<=\btel: )|(?<=\btel\. )|(?<=\bcall )|(?<=\bmobile )|(?<=\bmobile: ))\d{7,15}(?!\d))"
    r"|(?P<name>\b(?:" + "|".join(FORMS_OF_ADDRESS) + r")\b\.?(?: (?=[^\W\d_])(?=\w)" + _WORD + r"){1,3})"
)
_RARE = (
    r"|(?P<ip6>(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)(?=[A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:|::)[0-9A-Fa-f:]{1,38}[0-9A-Fa-f](?![\w:]))"
    r"|(?P<given>\b(?:" + "|".join(_GIVEN) + r")(?: (?=[^\W\d_])(?=\w)" + _WORD + r"){1,2})"
)
# Most texts hold no given name and no two colons; the pattern without those is twice as fast.
_FINDER, _FINDER_OF_ALL = re.compile(_SIMPLE), re.compile(_SIMPLE + _RARE)
_HINT = re.compile(r"[0-9@=:]|\b(?:" + "|".join(FORMS_OF_ADDRESS) + r")\b")
_NUMBERED = re.compile(r"(?i)\b(?:version|ver\.?|release|v\.?) ?$")
_DIGITS = re.compile(r"\d")

ENTITIES = [
    ("kind", pa.string(), "string"),
    ("original", pa.string(), "string"),
    ("surrogate", pa.string(), "string"),
]
REPLACED = [("_text", pa.string(), "string"), ("_entities", pa.int64(), "bigint")]


class Surrogates:
    """The keyed one-to-one maps; one object serves a whole task."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, domain: bytes, i: int, half: int, value: int) -> int:
        size = (half + 7) // 8
        raw = hashlib.blake2b(
            b"%d:%s:%d" % (i, domain, value), key=self.key[:64], digest_size=max(8, min(64, size))
        ).digest()
        while len(raw) < size:
            raw += hashlib.blake2b(raw, key=self.key[:64]).digest()
        return int.from_bytes(raw, "big") & ((1 << half) - 1)

    def _feistel(self, value: int, bits: int, domain: bytes, back: bool) -> int:
        half = bits // 2
        left, right = value >> half, value & ((1 << half) - 1)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._round(domain, i, half, left), left
            else:
                left, right = right, left ^ self._round(domain, i, half, right)
        return left << half | right

    def _permuted(self, value: int, size: int, domain: bytes, back: bool = False) -> int:
        """Keyed permutation of range(size): walks the cycle until it is back inside."""
        bits = max(2, (size - 1).bit_length())
        bits += bits % 2
        while True:
            value = self._feistel(value, bits, domain, back)
            if value < size:
                return value

    def _shifted(self, value: int, size: int, domain: bytes) -> int:
        """Keyed permutation of range(size) that is one cycle, so nothing stays in place."""
        place = (self._permuted(value, size, domain) + 1) % size
        return self._permuted(place, size, domain, back=True)

    def text(self, kind: str, text: str, alphabet: str | None = None) -> str:
        """A string of the same format: every character from its own class."""
        def letters(c: str) -> str:
            if alphabet is not None:
                return alphabet
            return ALPHABETS[_CLASS[c]] if c in _CLASS else c

        number, size, shape = 0, 1, []
        for c in text:
            own = letters(c)
            number = number * len(own) + own.index(c)
            size *= len(own)
            shape.append(own)
        if size > 1:
            domain = kind.encode() + b"|" + "\x00".join(shape).encode("utf-8", "replace")
            number = self._shifted(number, size, hashlib.blake2b(domain, digest_size=12).digest())
        out = []
        for own in reversed(shape):
            number, at = divmod(number, len(own))
            out.append(own[at])
        return "".join(reversed(out))

    # One method per kind: canonical entity to canonical surrogate.

    def email(self, found: str) -> str:
        local, _, domain = found.rpartition("@")
        labels, top = domain.rsplit(".", 1)
        return f"{self.text('local', local)}@{self.text('domain', labels)}.{top}"

    def secret(self, found: str) -> str:
        vendor = re.match(r"(?:AKIA|ASIA|gh[pousr]_)", found)
        if vendor:  # the prefix says what kind of key it is
            return vendor.group() + self.text(vendor.group(), found[vendor.end() :])
        if all(c in _HEX for c in found):
            return self.text("secret", found, _HEX)
        return self.text("secret", found)

    def ip(self, found: str) -> str:
        value = 0
        for part in found.split("."):
            value = value << 8 | int(part)
        base, bits = _block(value)
        if bits < 32:
            value = base | self._shifted(value - base, 1 << bits, b"ip%d" % base)
        else:
            while True:  # public addresses only
                value = self._shifted(value, 1 << 32, b"ip")
                if _block(value)[1] == 32:
                    break
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))

    def ip6(self, found: str) -> str:
        """The first block stays, which tells public, private and link-local addresses apart."""
        whole = ipaddress.IPv6Address(found).exploded.replace(":", "")
        made = whole[:4] + self.text("ip6" + whole[:4], whole[4:], _HEX)
        return ipaddress.IPv6Address(int(made, 16)).compressed

    def card(self, found: str) -> str:
        """The distance from the Luhn digit stays, so valid numbers stay valid."""
        offset = (int(found[-1]) - _luhn(found[:-1])) % 10
        head = self.text("card", found[:-1])
        return head + str((_luhn(head) + offset) % 10)

    def ssn(self, found: str) -> str:
        return self.text("ssn", found)

    def phone(self, found: str) -> str:
        """Digits, after + and a space-ended country code where one was written."""
        code, _, rest = found.rpartition(" ")
        return f"{code} {self.text('phone' + code, rest)}" if code else self.text("phone", rest)

    def iban(self, found: str) -> str:
        """The distance from the right check number stays."""
        country, check, body = found[:2], int(found[2:4]), found[4:]
        offset = (check - _iban_check(country, body)) % 100
        body = self.text("iban" + country, body)
        return f"{country}{(_iban_check(country, body) + offset) % 100:02d}{body}"

    def name(self, found: str) -> str:
        """Words of a name: known given names by gender and script, others letter by letter."""
        return " ".join(self._name_word(w) for w in found.split(" "))

    def _name_word(self, word: str) -> str:
        if word in _GIVEN:
            names = GIVEN_NAMES[_GIVEN[word]]
            at = self._shifted(names.index(word), len(names), "/".join(_GIVEN[word]).encode())
            return names[at]
        made = self.text("name", word)
        while made in _GIVEN:  # a made-up word must not meet a given name
            made = self.text("name", made)
        return made


def _block(value: int) -> tuple[int, int]:
    """First address and free bits of the special block that holds an address; 32 if none."""
    for base, bits in (
        (0x0A000000, 24), (0xAC100000, 20), (0xC0A80000, 16), (0x7F000000, 24), (0x00000000, 24),
        (0xE0000000, 28), (0xF0000000, 28),
    ):
        if value >> bits == base >> bits:
            return base, bits
    return 0, 32


def _luhn(digits: str) -> int:
    """Check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _refill(shape: str, characters: str) -> str:
    """``characters`` in the places of the letters and digits of ``shape``."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def replaced(match: re.Match, maps: Surrogates) -> tuple[str, str, str, str] | None:
    """Kind, canonical entity, canonical surrogate and the text to put in place of a match."""
    kind, found = match.lastgroup, match.group()
    if kind == "secret":
        head = re.match(r"(?i)(?:[a-z_-]+[\"']?\s*(?:[:=]\s*|is\s+)[\"']?)?", found).group()
        tail = found[-1] if found[-1] in "\"'" and head[-1:] == found[-1] else ""
        value = found[len(head) : len(found) - len(tail)]
        made = maps.secret(value)
        return kind, value, made, head + made + tail
    if kind in ("name", "given"):
        title, _, rest = found.partition(" ")
        words = rest.split(" ")
        # The name is the leading run of capitalised words before another entity or form of address.
        own, at = 0, match.end() - len(rest)
        for word in words:
            other = _FINDER.match(match.string, at)
            if not word[:1].isupper() or word in _FORMS or other:
                break
            own, at = own + 1, at + len(word) + 1
        if not own:
            return None
        value = " ".join(words[:own] if kind == "name" else [title, *words[:own]])
        made = maps.name(value)
        return "name", value, made, f"{title} {made}" if kind == "name" else made
    if kind == "email":
        value = found.lower()
        made = maps.email(value)
        return kind, value, made, made if found == value else _recased(found, made)
    if kind == "ip6":
        try:
            value = ipaddress.IPv6Address(found).compressed
        except ValueError:
            return None
        made = maps.ip6(value)
        return "ip", value, made, made
    if kind == "ip":
        if _NUMBERED.search(match.string, max(0, match.start() - 12), match.start()):
            return None  # the number of a version
        value = ".".join(str(int(p)) for p in found.split("."))
        made = maps.ip(value)
        return kind, value, made, made
    if kind == "iban":
        value = found.replace(" ", "")
        if not 15 <= len(value) <= 34:
            return None
        made = maps.iban(value)
        return kind, value, made, _refill(found, made)
    value = "".join(c for c in found if c.isdigit())
    if not value.isascii():
        return None
    if kind == "phone":
        if not 7 <= len(value) <= 15:
            return None
        code = re.match(r"\+(\d{1,3})(?=[ .(-])", found)
        if code:
            value = f"{code[1]} {value[len(code[1]):]}"
        made = maps.phone(value)
        return kind, value, made, _refill(found, made.replace(" ", ""))
    made = maps.card(value) if kind == "card" else maps.ssn(value)
    return kind, value, made, _refill(found, made)


def _recased(shape: str, made: str) -> str:
    return "".join(m.upper() if s.isupper() else m for s, m in zip(shape, made))


@lru_cache(maxsize=4)
def _maps(key: bytes) -> Surrogates:
    return Surrogates(key)


def _named_again(text: str, names: list[str], maps: Surrogates, note: Callable[..., None]) -> str:
    """``text`` with the words of ``names`` replaced, each as in its name; capitals stay capitals."""
    words = {w for name in names for w in name.split(" ") if len(w) > 1}
    forms = {w: w for w in words} | {w.upper(): w for w in words}

    def again(match: re.Match) -> str:
        found = match.group()
        word = forms[found]
        made = maps.name(word)
        note("name", word, made)
        return made if found == word else made.upper()

    longest = sorted(forms, key=len, reverse=True)
    return re.sub(r"(?<!\w)(?:" + "|".join(map(re.escape, longest)) + r")(?!\w)", again, text)


def replace_text(text: str, key: bytes, note: Callable[..., None] = lambda *_: None) -> str:
    """``text`` with surrogates; ``note(kind, original, surrogate)`` hears of every entity."""
    rare = text.count(":") > 1 or any(n in text for n in _GIVEN)
    if not rare and not _HINT.search(text):
        return text
    finder = _FINDER_OF_ALL if rare else _FINDER
    maps, done, names = _maps(key), 0, []
    out: list[tuple[str, str]] = []  # text between entities, and what stands for the entity behind it
    match = finder.search(text)
    while match:
        found, end = replaced(match, maps), match.end()
        if match.lastgroup in ("name", "given"):  # words behind the name are searched again
            first = len(match.group().partition(" ")[0])
            behind = len(found[1]) + (1 + first if match.lastgroup == "name" else 0) if found else first
            end = match.start() + behind
            if found:
                names.append(found[1])
        if found:
            note(*found[:3])
            out.append((text[done : match.start()], found[3]))
            done = end
        match = finder.search(text, end)
    out.append((text[done:], ""))
    if names:
        out = [(_named_again(between, names, maps, note), made) for between, made in out]
    return "".join(between + made for between, made in out)


def _replace(parts: Iterator[pa.RecordBatch], key: bytes):
    for part in parts:
        rows = []
        for raw in part.column("body").to_pylist():
            text, seen = raw.decode("utf-8", "surrogateescape"), []
            made = replace_text(text, key, lambda *x: seen.append(x))
            rows.append((made.encode("utf-8", "surrogateescape") if seen else raw, len(seen)))
        yield rows


def _list(parts: Iterator[pa.RecordBatch], key: bytes):
    for part in parts:
        seen: set[tuple[str, str, str]] = set()
        for raw in part.column("body").to_pylist():
            replace_text(raw.decode("utf-8", "replace"), key, lambda *x: seen.add(x))
        yield sorted(seen)


def with_surrogates(documents: DataFrame, key: bytes) -> DataFrame:
    """``documents`` with their texts replaced, and ``_entities``, the number of replacements."""
    fields = [("_text", pa.binary(), "binary"), REPLACED[1]]
    found = append_columns(packed(documents, "text"), as_bytes(), _replace, fields, key)
    text = F.when(F.col("text").isNotNull(), F.col("_text").cast("string")).alias("text")
    columns = [text if c == "text" else F.col(f"_row.`{c}`") for c in documents.columns]
    return found.select(*columns, "_entities")


def surrogate_table(documents: DataFrame, key: bytes) -> DataFrame:
    """Distinct entities of the corpus: kind, original, surrogate."""
    bodies = documents.select(as_bytes().alias("body"))
    return map_texts(bodies, "body", _list, ENTITIES, key).distinct()


def collisions(entities: DataFrame) -> DataFrame:
    """Surrogates that stand for several entities of a kind, or that are their own entity."""
    return (
        entities.groupBy("kind", "surrogate")
        .agg(F.count(F.lit(1)).alias("originals"), F.max(F.col("original") == F.col("surrogate")).alias("unmoved"))
        .filter((F.col("originals") > 1) | F.col("unmoved"))
    )


def pseudonymised(documents: DataFrame, key: bytes) -> DataFrame:
    """``with_surrogates`` after the collision check; the entities found are few beside the texts."""
    bad = collisions(surrogate_table(documents, key)).limit(1).collect()
    if bad:
        raise ValueError(f"Surrogates of kind {bad[0]['kind']} collide; choose another key.")
    return with_surrogates(documents, key)
