"""PII: detected entities get keyed surrogates of the same type, script and format.

Machine-like entities (mail addresses, phone numbers, cards, network addresses, numbers, secrets)
are renamed by a keyed permutation of all valid strings of their own shape: each letter stays a
letter of its script and case, each digit a digit, an address in its class.  A permutation keeps
different entities different and one entity the same everywhere, without any table.

A name is found after a title; its words then count wherever they stand in that text.  Each word
is an entity of its own, so ``Mr John Smith``, ``Dr Smith`` and a later ``Smith`` agree: family
names are made of syllables, given names drawn from lists by gender, and there collisions can
occur.  Every surrogate is therefore checked over the whole corpus: one that two entities share,
or (but for given names) that is itself an entity of the corpus, is drawn again for all but one
of them, until none is left.  Where a corpus fills a shape so far that unused strings are rare
(over ``DENSE`` of them are entities, as with addresses such as 10.0.0.1), the permutation alone
decides: surrogates still differ from each other, but may be others' originals.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import math
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import batches, dispose, parts, stored

KEY = b"surrogate key; give your own"
ROUNDS = 8
#: Share of a shape's strings from which on its surrogates follow from the permutation alone.
DENSE = 1 / 40

# Titles by gender, and the names that stand in for others by script and gender.
TITLES = {
    "male": ["Mr", "Mister", "Herr", "Herrn", "Señor", "Monsieur", "Signor", "г-н", "господин", "κύριος"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "Signora", "г-жа", "госпожа", "κυρία"],
    "neutral": ["Dr", "Prof", "Professor", "Professeur", "Doctor"],
}
GIVEN = {
    ("latin", "male"): "Adam Bruno Carl Daniel Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul Robin Simon Tomas Victor".split(),
    ("latin", "female"): "Anna Beatrice Clara Diana Elena Flora Greta Helena Irene Julia Katia Laura Maria Nina Olga Petra Rosa Sofia Teresa Vera".split(),
    ("cyrillic", "male"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур".split(),
    ("cyrillic", "female"): "Алла Белла Вера Галина Дарья Елена Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса София".split(),
    ("greek", "male"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λουκάς Μάριος Νίκος Παύλος Σταύρος".split(),
    ("greek", "female"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Θάλεια Καλλιόπη Λυδία Μαρία Νεφέλη Σοφία".split(),
}
SYLLABLES = {
    "latin": "bar ben cor dal den fel gar hol ken lan mar mon nor pel ran ros sel tan tor val wen wil".split(),
    "cyrillic": "бар вол гор дан кар лан мар нов пал рос сол тар чер шел".split(),
    "greek": "βαρ γαλ δημ καλ λαμ μαρ νικ παλ ροδ σαρ ταλ φιλ".split(),
}
#: Family name endings; where they show gender, in pairs.
ENDINGS = {"latin": ["er", "man", "son", "field", "ley", "ton"], "cyrillic": ["енко", "ук"], "greek": ["άς"]}
PAIRS = {"cyrillic": [("ов", "ова"), ("ев", "ева"), ("ин", "ина"), ("ский", "ская")], "greek": [("ίδης", "ίδου"), ("άκης", "άκη"), ("όπουλος", "οπούλου")]}

UPPER = r"[A-ZÀ-ÖØ-ÞŁŚŽА-ЯЁΑ-ΩΆΈΉΊΌΎΏ]"
NAME = rf"{UPPER}(?:[^\W\d_]+|(?=['’]{UPPER}))(?:[-'’]{UPPER}[^\W\d_]*)*"
INITIAL = rf"{UPPER}\.[ \u00a0]?"
GENDER_OF = {form: g for g, ts in TITLES.items() for t in ts for form in (t.upper(), t[0].upper() + t[1:], t)}
_titles = "|".join(sorted(map(re.escape, GENDER_OF), key=len, reverse=True))
EMAIL = r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?![\w-])"
#: A key and its sign, as in code, configuration, JSON and prose.
ASSIGNED = r"(?ai:password|passwd|secret(?:[_ ](?:access[_ ])?key)?|token|api[_-]?key)[\"']?[^\S\n]*[:=]{1,2}+>?[^\S\n]*[\"']?"
#: Keys that show by themselves; their heads stay.
JWT = r"eyJ[A-Z0-9_-]{8,}\.[A-Z0-9_-]{8,}\.[A-Z0-9_-]{8,}"
TOKEN = rf"(?ai:\b(?:sk-(?:ant-|proj-)?[A-Z0-9_-]{{20,}}|gh[opusr]_[A-Z0-9]{{20,}}|AKIA[A-Z0-9]{{16}}|{JWT})(?![A-Z0-9_]))"
HEAD = re.compile(r"(?ai:sk-(?:ant-|proj-)?(?=[A-Z0-9_-]{20})|gh[opusr]_(?=[A-Z0-9]{20})|AKIA(?=[A-Z0-9]{16}\Z)|eyJ(?=[A-Z0-9_-]{8,}\.[A-Z0-9_-]{8,}\.))")
HEX = re.compile(r"[0-9a-fA-F]{32,}")
#: One pass finds all kinds; of two that begin together the first here wins.
FINDER = re.compile(
    "|".join(
        [
            rf"(?P<email>{EMAIL})",
            rf"(?P<token>{TOKEN})",
            r"(?ai:-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----)(?P<pem>[A-Za-z0-9+/=\\\r\n]{16,})",
            rf"(?ai:\bbearer[^\S\n]+)(?!{TOKEN})(?P<bearer>[A-Za-z0-9._~+/-]{{19,}}[A-Za-z0-9_~+/-]={{0,2}})",
            rf"(?:{ASSIGNED}(?!{EMAIL}|{TOKEN})|(?<=[\"'])(?=[0-9a-fA-F]{{32,}}[\"']))(?P<secret>[^\s\"',;]{{6,}})",
            r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b)",
            r"(?P<card>(?<![\w.-])\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}(?![\w-]|\.\d))",
            r"(?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))",
            r"(?P<ipv6>(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d))",
            r"(?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))",
            r"(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w]))",
            rf"(?P<name>(?<!\w)(?P<title>{_titles})\.?[ \u00a0](?P<who>(?:{INITIAL}){{0,3}}{NAME}(?:[ \u00a0](?:{INITIAL})?{NAME}){{0,2}})(?!\w))",
        ]
    )
)
#: Every text with a match of FINDER has one of MAYBE or, lower-cased, one of these marks.
MAYBE = re.compile(rf"[@\d]|[\"'][a-fA-F]{{32}}|(?<!\w)(?:{_titles})\.?[ \u00a0]")
MARKS = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key", "sk-", "gho_", "ghp_", "ghu_", "ghs_", "ghr_", "akia", "eyj", "bearer", "private key-----")
SECRETS = ("token", "pem", "bearer", "secret")
KINDS = ("email", *SECRETS, "iban", "card", "ssn", "ipv6", "ipv4", "phone", "name")
#: The parts of a name, and any word that could be one.
NAME_PART = re.compile(rf"(?P<initial>{UPPER})\.|(?P<word>{NAME})")
WORD = re.compile(rf"(?<!\w){NAME}(?!\w)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def maybe(text: str) -> bool:
    lower = text.lower()
    return any(mark in lower for mark in MARKS) or MAYBE.search(text) is not None


def found(text: str) -> list[tuple[int, int, str, str, str]]:
    """Start, end, kind, canonical entity and, of given names, gender, in order; spans don't overlap."""
    if not text or not maybe(text):
        return []
    out: list[tuple[int, int, str, str, str]] = []
    names: dict[str, tuple[str, str, str]] = {}
    later: list[int] = []  # given names whose gender is not known from their title
    for m in FINDER.finditer(text):
        kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if m[k] is not None)
        lo, hi = m.span(kind)
        if kind == "card" and not (13 <= len(digits := re.sub(r"\D", "", m[kind])) <= 19 and luhn(digits)):
            continue
        if kind == "ipv6" and not address6(m[kind]):
            continue
        if kind == "name":
            bits, base = list(NAME_PART.finditer(m["who"])), m.start("who")
            for i, bit in enumerate(bits):
                kind = "initial" if bit["initial"] else "given" if i + 1 < len(bits) else "family"
                entity = canonical(kind, bit[bit.lastgroup])
                gender = GENDER_OF[m["title"]] if kind == "given" else ""
                if kind != "initial" and (entity not in names or names[entity][2] == "neutral"):
                    names[entity] = (names[entity][0] if entity in names else kind, entity, gender)
                later.append(len(out)) if kind != "initial" else None
                out.append((base + bit.start(bit.lastgroup), base + bit.end(bit.lastgroup), kind, entity, gender))
            continue
        kind = "secret" if kind in SECRETS else kind
        out.append((lo, hi, kind, canonical(kind, text[lo:hi]), ""))
    if names:
        names = {k: (kind, entity, (gender if gender != "neutral" else likely_gender(entity)) if kind == "given" else "") for k, (kind, entity, gender) in names.items()}
        for i in later:  # a word is given or family name, of one gender, all through a text
            out[i] = (*out[i][:2], *names[out[i][3]])
        taken = sorted(x[:2] for x in out)
        at = 0
        for m in WORD.finditer(text):
            lo, hi = m.span()
            while at < len(taken) and taken[at][1] <= lo:
                at += 1
            if (at == len(taken) or hi <= taken[at][0]) and (known := names.get(canonical("family", m[0]))):
                out.append((lo, hi, *known))
        out.sort()
    return out


def likely_gender(given: str) -> str:
    """Of a given name without a gendered title: by the lists above, else by its last letter."""
    for (_, gender), some in GIVEN.items():
        if given in (x.casefold() for x in some):
            return gender
    return "female" if given[-1] in "aeаяαηά" else "male"


def address6(text: str) -> bool:
    """An IPv6 address of at least three groups, or of two of which the first is full."""
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    groups = [g for g in text.split(":") if g]
    return len(groups) > 2 or len(groups) == 2 and len(groups[0]) == 4


def canonical(kind: str, value: str) -> str:
    """What tells entities apart: mail addresses, names and long hex regardless of case, numbers by their digits."""
    value = unicodedata.normalize("NFC", value)
    if kind == "email" or kind == "secret" and HEX.fullmatch(value):
        return value.lower()
    if kind in ("card", "phone"):
        return ("+" if value.startswith("+") else "") + re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind in ("given", "family", "initial"):
        return value.casefold()
    if kind == "ipv6":
        return ipaddress.IPv6Address(value).exploded
    return value


# ------------------------------------------------------------- keyed permutation of shapes

#: Letters that stay among themselves, as code point ranges.
CLASSES = [range(48, 58), range(97, 123), range(65, 91), range(0x430, 0x450), range(0x410, 0x430), range(0x3B1, 0x3C2), range(0x391, 0x3A2)]
CLASSES += [range(0x3C3, 0x3CA), range(0x3A3, 0x3AA), range(0x5D0, 0x5EB), range(0x4E00, 0x9FA6), range(0xDF, 0xF7), range(0xF8, 0x100), range(0xC0, 0xD7), range(0xD8, 0xDF)]


#: Characters that are permuted together.
PIECE = 800


def prf(key: bytes, tweak: str, r: int, value: int, size: int) -> int:
    message = f"{tweak}|{r}|{value}".encode()
    block = hmac.new(key, message, hashlib.sha256).digest()
    while len(block) * 8 < size + 64:
        block += hmac.new(key, message + block[-32:], hashlib.sha256).digest()
    return int.from_bytes(block, "big")


def permute(key: bytes, tweak: str, value: int, domain: int) -> int:
    """A keyed permutation of range(domain): an unbalanced Feistel net on a square that holds the
    domain, walked on until the value falls into the domain."""
    if domain < 2:
        return value
    side = 1
    while side * side < domain:
        side = side * 2 if side * 4 * side < domain else side + max(1, side // 8)
    bits = side.bit_length()
    while True:
        a, b = divmod(value, side)
        for r in range(ROUNDS):
            a, b = b, (a + prf(key, f"{tweak}|{domain}", r, b, bits)) % side
        value = a * side + b
        if value < domain:
            return value


def reshape(key: bytes, tweak: str, text: str) -> str:
    """The image of ``text`` among all strings of its shape; other characters stay.

    Long texts go piece by piece, as Python writes no integer of over 4300 digits."""
    if len(text) > PIECE:
        return "".join(reshape(key, f"{tweak}|{i}", text[i : i + PIECE]) for i in range(0, len(text), PIECE))
    kinds = [next((c for c in CLASSES if ord(ch) in c), None) for ch in text]
    shape = "".join(chr(c.start) if c else ch for ch, c in zip(text, kinds))
    value, domain = 0, 1
    for ch, c in zip(text, kinds):
        if c:
            value, domain = value * len(c) + ord(ch) - c.start, domain * len(c)
    value = permute(key, f"{tweak}|{shape}", value, domain)
    out = []
    for ch, c in zip(reversed(text), reversed(kinds)):
        if c:
            value, d = divmod(value, len(c))
            ch = chr(c.start + d)
        out.append(ch)
    return "".join(reversed(out))


def walk(key: bytes, tweak: str, text: str, good) -> str:
    """``reshape`` until the image is ``good``, as ``text`` is: a permutation of the good strings.

    The cycle of a permutation comes back to where it began, so the walk ends; only for kinds of
    which a tenth or more of the shape is good, so that it is short."""
    while True:
        text = reshape(key, tweak, text)
        if good(text):
            return text


def script(text: str) -> str:
    c = ord(text[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def writing(octet: str) -> tuple[int, bool]:
    """How an octet is written: its length, and whether with leading zeros."""
    return len(octet), len(octet) > 1 and octet[0] == "0"


#: All octets of each writing; there are six.
OCTETS: dict[tuple[int, bool], list[str]] = {}


def octets(like: tuple[int, bool]) -> list[str]:
    """All octets written so."""
    if like not in OCTETS:
        OCTETS[like] = [x for v in range(256) if writing(x := f"{v:0{like[0]}d}") == like]
    return OCTETS[like]


def address_class(a: int, b: int) -> str:
    if a in (0, 10, 127):
        return str(a)
    if a == 172 and 16 <= b < 32 or (a, b) in ((192, 168), (169, 254)):
        return f"{a}.x"
    return "public" if a < 224 else "multicast" if a < 240 else "reserved"


#: First two octets of each class and writing, numbered.
HEADS: dict[tuple, dict[tuple[str, str], int]] = {}


def heads_of(kind: str, a: tuple[int, bool], b: tuple[int, bool]) -> dict[tuple[str, str], int]:
    if (kind, a, b) not in HEADS:
        found = [(x, y) for x in octets(a) for y in octets(b) if address_class(int(x), int(y)) == kind]
        HEADS[kind, a, b] = {head: i for i, head in enumerate(found)}
    return HEADS[kind, a, b]


def address_parts(text: str) -> tuple[tuple, tuple[str, ...], dict, list[str], list[str]]:
    """Name of the set of addresses like ``text`` (its class and writing), its octets, and the
    values in that set: numbered first two octets together, third, fourth."""
    octs = tuple(text.split("."))
    shape = (address_class(int(octs[0]), int(octs[1])), *map(writing, octs))
    return shape, octs, heads_of(*shape[:3]), octets(shape[3]), octets(shape[4])


def address4(key: bytes, tweak: str, text: str) -> str:
    """The image among the addresses of the same class and octet lengths, by its number among them."""
    shape, (a, b, c, d), heads, third, fourth = address_parts(text)
    size = len(heads) * len(third) * len(fourth)
    n = permute(key, f"{tweak}|{shape}", (heads[a, b] * len(third) + third.index(c)) * len(fourth) + fourth.index(d), size)
    n, x = divmod(n, len(fourth))
    n, y = divmod(n, len(third))
    return ".".join([*list(heads)[n], third[y], fourth[x]])


def groups6(entity: str) -> list[tuple[int, int]]:
    """Value and number of values of each group of an exploded IPv6 address: the first group, which
    shows the kind of address, and zero groups stay; others keep their number of hex digits."""
    out = []
    for i, g in enumerate(entity.split(":")):
        n = len(f"{int(g, 16):x}")
        out.append((int(g, 16), 1 if i == 0 or int(g, 16) == 0 else 15 * 16 ** (n - 1)))
    return out


def address_6(key: bytes, tweak: str, entity: str) -> str:
    values = groups6(entity)
    n, size, shape = 0, 1, []
    for v, room in values:
        low = (room + room // 15) // 16 if room > 1 else v
        n, size = n * room + v - low, size * room
        shape.append(f"{v if room == 1 else 'x'}{room}")
    n = permute(key, f"{tweak}|{'|'.join(shape)}", n, size)
    out = []
    for v, room in reversed(values):
        n, at = divmod(n, room)
        out.append(f"{(room + room // 15) // 16 + at if room > 1 else v:04x}")
    return ":".join(reversed(out))


#: Numbers that are given out: area, group and serial of 9 digits.
AREAS = [f"{a:03d}" for a in range(1, 900) if a != 666]


def ssn(key: bytes, tweak: str, text: str) -> str:
    a, b, c = text.split("-")
    if a not in AREAS or b == "00" or c == "0000":
        return walk(key, tweak, text, lambda s: not (s[:3] in AREAS and s[4:6] != "00" and s[7:] != "0000"))
    n = permute(key, f"{tweak}|ssn", (AREAS.index(a) * 99 + int(b) - 1) * 9999 + int(c) - 1, len(AREAS) * 99 * 9999)
    n, c = divmod(n, 9999)
    a, b = divmod(n, 99)
    return f"{AREAS[a]}-{b + 1:02d}-{c + 1:04d}"


def pick(key: bytes, tweak: str, values: list):
    return values[prf(key, tweak, 0, 0, 32) % len(values)]


def family_name(key: bytes, word: str, attempt: int) -> str:
    """Both forms of a name that shows gender get the same stem, and endings that are a pair."""
    kind, tweak = script(word), f"family|{attempt}"
    for pair in PAIRS.get(kind, ()):
        for sex, end in enumerate(pair):
            if word.endswith(end) and len(word) > len(end):
                root = word[: -len(end)]
                ends = pick(key, f"{tweak}|pair|{root}|{pair[0]}", PAIRS[kind])[sex]
                return "".join(pick(key, f"{tweak}|{root}|{pair[0]}|{i}", SYLLABLES[kind]) for i in range(2 + min(attempt, 6))) + ends
    new = "".join(pick(key, f"{tweak}|{word}|{i}", SYLLABLES[kind]) for i in range(2 + min(attempt, 6)))
    return new + pick(key, f"{tweak}|end|{word}", ENDINGS[kind])


def given_name(key: bytes, word: str, gender: str, attempt: int) -> str:
    """A name of the list; from the second draw on, double and longer names."""
    some = GIVEN[script(word), gender]
    return "-".join(pick(key, f"given|{attempt}|{word}|{i}", some) for i in range(1 + min(attempt, 6))).casefold()


def surrogate(key: bytes, kind: str, entity: str, gender: str, attempt: int) -> str:
    """The stand-in of a canonical entity, in canonical form."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        host, _, top = domain.rpartition(".")
        tail = top if top in ("com", "net", "org") else ""
        keep = f".example.{tail}" if tail and host.endswith(".example") else ""
        inner = host.removesuffix(".example") if keep else host
        new = reshape(key, tweak + "|host", inner)
        domain = new + keep if keep else f"{new}.example.{tail}" if tail else f"{new}.{top}.example"
        return f"{reshape(key, tweak, local)}@{domain}"
    if kind == "card":
        new = entity[0] + reshape(key, tweak, entity[1:-1])
        return next(new + str(d) for d in range(10) if luhn(new + str(d)))
    if kind == "ssn":
        return ssn(key, tweak, entity)
    if kind == "ipv4":
        return address4(key, tweak, entity)
    if kind == "ipv6":
        return address_6(key, tweak, entity)
    if kind == "phone":
        if entity.startswith("+1") and len(entity) == 12:
            good = lambda s: s[0] in "23456789" and s[3] in "23456789"
            return "+1" + walk(key, tweak, entity[2:], good if good(entity[2:]) else lambda s: not good(s))
        keep = 3 if entity.startswith("+") else 0
        first = lambda s: s[:1] != "0"
        rest = entity[keep:]
        return entity[:keep] + walk(key, tweak, rest, first if first(rest) else lambda s: not first(s))
    if kind == "iban":
        new = reshape(key, tweak, entity[4:])
        return entity[:2] + iban_check(entity[:2], new) + new
    if kind == "secret":
        if len(entity) <= PIECE and (re.fullmatch(r"[0-9a-f]+", entity) or re.fullmatch(r"[0-9A-F]+", entity)):
            n = permute(key, f"{tweak}|{len(entity)}", int(entity, 16), 16 ** len(entity))
            return f"{n:0{len(entity)}{'x' if entity == entity.lower() else 'X'}}"
        head = m[0] if (m := HEAD.match(entity)) else ""
        return head + reshape(key, tweak, entity[len(head) :])
    if kind == "initial":
        return reshape(key, tweak, entity)
    return family_name(key, entity, attempt) if kind == "family" else given_name(key, entity, gender, attempt)


def shape_of(kind: str, entity: str) -> tuple[str, float]:
    """Name of the set of strings that a permutation moves the entity in, and its size; names are
    drawn without one."""
    if kind in ("given", "family"):
        return "", math.inf
    if kind == "ipv4":
        shape, _, heads, third, fourth = address_parts(entity)
        return str(shape), float(len(heads) * len(third) * len(fourth))
    if kind == "ipv6":
        values = groups6(entity)
        return "|".join(f"{v if room == 1 else 'x'}{room}" for v, room in values), float(math.prod(room for _, room in values))
    kept = entity[:3] if kind == "phone" else entity[:1] if kind == "card" else ""
    # the last digit of a card and the check digits of an iban follow from the others
    free = entity[len(kept) : -1] if kind == "card" else entity[4:] if kind == "iban" else entity[len(kept) :]
    kinds = [next((c for c in CLASSES if ord(ch) in c), None) for ch in free[:PIECE]]
    size = math.prod(len(c) for c in kinds if c)
    return hashlib.md5((kept + "".join(chr(c.start) if c else ch for ch, c in zip(free, kinds))).encode()).hexdigest(), float(min(size, 10**300))


def iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


def dressed(kind: str, original: str, new: str) -> str:
    """The surrogate in the punctuation, spacing and case of this occurrence."""
    if kind == "email" or kind == "secret" and HEX.fullmatch(original):
        if original.isupper():
            return new.upper()
        out = [n.upper() if o.isupper() else n for o, n in zip(original, new)]
        return "".join(out) + new[len(original) :]
    if kind in ("card", "phone", "iban"):
        chars = iter(new.lstrip("+"))
        return "".join(next(chars) if c.isalnum() else c for c in original)
    if kind == "ipv6":
        return dressed6(original, new)
    if kind in ("given", "family", "initial"):
        return new.upper() if original.isupper() else "-".join(x[:1].upper() + x[1:] for x in new.split("-"))
    return new


def dressed6(original: str, new: str) -> str:
    """An exploded address with its groups written as those of ``original``."""
    left, gap, right = original.partition("::")
    groups = new.split(":")
    heads, tails = [g for g in left.split(":") if g], [g for g in right.split(":") if g]
    shown = [*groups[: len(heads)], *groups[8 - len(tails) :]] if gap else groups
    out = [f"{int(g, 16):0{len(o)}x}" for g, o in zip(shown, heads + tails)]
    text = ":".join(out[: len(heads)]) + gap + ":".join(out[len(heads) :])
    return text.upper() if original.upper() == original else text


# ------------------------------------------------------------- over a corpus


def entities(docs: DataFrame) -> DataFrame:
    """tie (hash of the text), kind, gender and entity of every occurrence."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(i, *x[2:5]) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in found(t)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[j] for r in rows], pa.string()) for j in (1, 3, 2))], names=["tie", "kind", "gender", "entity"])

    return batches(docs.select(tie_of(F.col("text")).alias("tie"), "text"), work, "tie long, kind string, gender string, entity string")


def tie_of(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def drawn(rows: DataFrame, key: bytes) -> DataFrame:
    """``rows`` (kind, gender, entity, dense, attempt) with their surrogate."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in ("kind", "entity", "gender", "attempt")]
        new = [surrogate(key, k, e, g, a) for k, e, g, a in zip(*columns)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=[*batch.schema.names, "surrogate"])

    # drawing is slow by design, and the table of entities small in bytes: deal it out by hash
    dealt = rows.select("kind", "gender", "entity", "dense", "attempt").repartition(max(24, parts(rows.sparkSession)), "entity")
    return batches(dealt, work, "kind string, gender string, entity string, dense boolean, attempt int, surrogate string")


def shaped(known: DataFrame) -> DataFrame:
    """``known`` with ``dense``: whether its shape is too full for unused strings."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [shape_of(k, e) for k, e in zip(batch.column("kind").to_pylist(), batch.column("entity").to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([s for s, _ in got]), pa.array([r for _, r in got], pa.float64())], names=[*batch.schema.names, "shape", "room"])

    rows = batches(known, work, "kind string, gender string, entity string, shape string, room double")
    full = rows.groupBy("kind", "shape").agg(F.count("*").alias("n"), F.min("room").alias("room")).where(F.col("n") > F.col("room") * DENSE)
    full = full.select(F.col("kind").alias("k"), F.col("shape").alias("s"), F.lit(True).alias("dense"))
    rows = rows.join(full, (F.col("kind") == F.col("k")) & (F.col("shape") == F.col("s")), "left")
    return rows.select("kind", "gender", "entity", F.coalesce("dense", F.lit(False)).alias("dense"))


def assign(docs: DataFrame, key: bytes = KEY, most_rounds: int = 30) -> DataFrame:
    """kind, gender, entity, attempt and surrogate of every different entity of the corpus.

    Checks: no two entities of a kind share a surrogate, and none is an entity found in the
    corpus (given names and dense shapes may be).  The smallest entity keeps a contested
    surrogate, the others draw again; settled ones never change, so the rounds end."""
    known = stored(entities(docs).groupBy("kind", "gender", "entity").count().select("kind", "gender", "entity"), "entities")
    real = known.where("kind <> 'given'").select("kind", F.col("entity").alias("surrogate")).distinct()
    settled, open_, before = None, shaped(known).withColumn("attempt", F.lit(0)), ()
    for _ in range(most_rounds):
        new = stored(drawn(open_, key), "drawn")
        every = new.withColumn("old", F.lit(False)) if settled is None else new.withColumn("old", F.lit(False)).unionByName(settled.withColumn("old", F.lit(True)))
        # dense ones stay whatever others draw
        rank = F.struct((~(F.col("old") | F.col("dense"))).alias("new"), "entity", "gender")
        keeper = every.groupBy("kind", "surrogate").agg(F.min(rank).alias("keeper"), F.max(F.when(F.col("old"), F.struct("entity", "gender"))).alias("owner"))
        mine = (F.col("keeper.entity") == F.col("entity")) & (F.col("keeper.gender") == F.col("gender")) & F.col("owner").isNull()
        hit = real.withColumn("real", F.lit(True))
        kept = new.join(keeper, ["kind", "surrogate"]).join(hit, ["kind", "surrogate"], "left")
        kept = stored(kept.select("kind", "gender", "entity", "dense", "attempt", "surrogate", (F.col("dense") | mine & F.col("real").isNull()).alias("wins")), "drawn")
        good = kept.where("wins").drop("wins")
        after = stored(good if settled is None else settled.unionByName(good), "settled")
        open_ = kept.where("not wins").select("kind", "gender", "entity", "dense", (F.col("attempt") + 1).alias("attempt"))
        done = open_.isEmpty()
        dispose(new, *before, *([] if settled is None else [settled]))
        settled, before = after, (kept,)
        if done:
            break
    else:
        raise RuntimeError("surrogates still collide")
    dispose(known, *before)
    return settled.drop("dense")


def replace_pii(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The columns of ``docs`` with surrogates in ``text``, and ``n_entities``.

    Null texts stay null and empty ones empty, both with 0 entities; repeated rows come out
    equal, texts of any length are read whole, and ids play no part, so they may be null or
    repeat.  Only entities that had to be drawn again are looked up, by a hash of the text; all
    others follow from the key alone.  An empty table gives no rows."""
    settled = assign(docs, key)
    again = settled.where("attempt > 0")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").alias("text"))
    if again.isEmpty():
        rows = rows.withColumn("again", F.lit(None).cast("array<struct<kind:string,gender:string,entity:string,surrogate:string>>"))
        dispose(settled)
    else:
        again = again.select(F.col("kind").alias("k"), F.col("gender").alias("g"), F.col("entity").alias("e"), "surrogate")
        where = entities(docs).distinct().join(again, (F.col("kind") == F.col("k")) & (F.col("gender") == F.col("g")) & (F.col("entity") == F.col("e")))
        # a text's own entities, so a list is no longer than the text
        where = where.groupBy("tie").agg(F.collect_set(F.struct("kind", "gender", "entity", "surrogate")).alias("again"))
        rows = rows.withColumn("t", tie_of(F.col("text"))).join(where, F.col("t") == F.col("tie"), "left").select("row", "text", "again")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, counts = [], []
        for text, special in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            spans = found(text) if text else []
            counts.append(len(spans))
            if spans:
                known = {(s["kind"], s["gender"], s["entity"]): s["surrogate"] for s in special or ()}
                bits, last = [], 0
                for lo, hi, kind, entity, gender in spans:
                    new = known.get((kind, gender, entity)) or surrogate(key, kind, entity, gender, 0)
                    bits += [text[last:lo], dressed(kind, text[lo:hi], new)]
                    last = hi
                text = "".join([*bits, text[last:]])
            out.append(text)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(counts, pa.int64())], names=["row", "new_text", "n_entities"])

    row = rows.schema["row"].dataType.simpleString()
    done = batches(rows, work, f"row {row}, new_text string, n_entities long")
    out = [F.col("new_text").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names]
    return done.select(*out, *([] if "n_entities" in names else ["n_entities"]))


def with_surrogates(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text`` and, where there is such a column, ``n_chars`` to fit."""
    rows = replace_pii(docs, key)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))) if "n_entities" not in docs.columns else rows.withColumn("n_chars", F.length("text").cast(kind))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
