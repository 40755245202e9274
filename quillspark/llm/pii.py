"""PII surrogates: keyed, type-consistent replacements.

Emails, phone numbers, IPv4 addresses, payment cards, social security numbers
and titled names are found by pattern; a name that a title told is also found without
one in the same document, whole or by surname or given name alone.  A name is up to
four words after one or more titles, taken whole with hyphens, apostrophes and inner
capitals; particles, initials' dots, hyphens and capitals stay as they are written.
The last word is the surname; words behind the first that the text also has in
lower case are none of the name.  Numbers and
mailboxes go through a keyed permutation of the strings of their own shape (a
Feistel network with cycle walking, one cycle over all strings, so that none is
its own surrogate); different entities get different surrogates, equal ones
equal surrogates wherever and however they are written, and separators, case,
country code, card validity and address class stay.  A surname has one surrogate,
a person one given name of their gender beside it; the script stays.  Gender comes
from a title in the document, else from titles that the person has elsewhere, else
from a list of given names, else from a hash.

Collision checks: surrogates are compared with every entity found in the corpus
and with each other, by joins; an entity whose surrogate is taken or is
itself somebody's entity tries the next tweak.  Surnames, given names and odd
mailboxes grow by a syllable or letter with each tweak, so they all settle.  Where
tries in a closed space (as that of x@y.com) settle nobody any more, too few of its
strings are free: the whole space then keeps the plain permutation, distinct
though its surrogates are other people's strings.  Exceptions are few; they
are broadcast only up to ``most_broadcast`` rows and joined to their documents
beyond that.

One pattern, run over whole Arrow columns, tells the few texts that have something
like an entity; only those become Python strings.

Defined cases: null text stays null, empty text empty; texts of any length are
read whole; a text without entities is unchanged; rows that repeat are rewritten
alike; overlapping finds are taken by the order of the kinds; as many titles for
either gender elsewhere count as none; a word that the text also has in lower
case is no name by itself; an empty table gives no rows; other columns pass
unread, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import takewhile
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import common

# Name pools by gender, titles by gender, letters by script.
GIVEN = {
    ("latin", "f"): ("Alice", "Anna", "Clara", "Diana", "Elena", "Emma", "Greta", "Helen", "Ines", "Julia", "Laura", "Lucia", "Maria", "Nora", "Olivia", "Paula", "Rosa", "Sara", "Sofia", "Vera"),
    ("latin", "m"): ("Adam", "Albert", "Bruno", "Carlos", "Daniel", "David", "Emil", "Felix", "Hugo", "Ivan", "James", "Jonas", "Karl", "Leo", "Marco", "Oscar", "Paul", "Peter", "Simon", "Victor"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "София", "Юлия"),
    ("cyrillic", "m"): ("Андрей", "Борис", "Виктор", "Денис", "Иван", "Кирилл", "Максим", "Олег", "Павел", "Сергей"),
}
# Further common given names by gender, known but not given out.
KNOWN = {
    "f": "Amy Angela Barbara Betty Carla Carmen Carol Catherine Charlotte Christine Claire Cristina Dolores Dorothy Elisabeth Elizabeth Emily Eva Françoise Grace Hannah Heike Ingrid Isabel Jane Jennifer Jessica Joan Katharina Karen Kate Linda Lisa Lucy Luisa Margaret Marie Marta Martha Mary Michelle Monika Monique Nancy Nathalie Patricia Petra Pilar Rachel Rebecca Ruth Sabine Sandra Sarah Sophie Susan Sylvie Teresa Ursula Valérie",
    "m": "Alain Alejandro Alexander Andrew Antonio Arthur Benjamin Bernd Brian Charles Christian Christopher Diego Dieter Edward Eric Ernst Fernando Francisco François Frank Fritz George Hans Heinrich Henry Jacques Javier Jean Jeffrey John Jorge Joseph José Juan Jürgen Kevin Klaus Lukas Luis Manuel Mark Martin Matthew Max Michael Michel Miguel Nicolas Otto Pablo Patrick Pedro Philippe Pierre Rafael Richard Robert Ronald Samuel Stefan Steven Thomas Timothy Werner William Wolfgang",
}
_GENDER = {n.lower(): g for (_, g), names in GIVEN.items() for n in names} | {n.lower(): g for g, names in KNOWN.items() for n in names.split()}
TITLES = {"mr": "m", "herr": "m", "señor": "m", "sr": "m", "monsieur": "m", "mrs": "f", "ms": "f", "miss": "f", "frau": "f", "señora": "f", "sra": "f", "madame": "f", "mme": "f", "dr": "", "prof": "", "г-н": "m", "г-жа": "f"}
_SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрстф", "аеиоу")}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
# Words between a given name and a surname.
PARTICLES = ("af", "al", "av", "bin", "da", "de", "del", "della", "den", "der", "di", "dos", "du", "el", "ibn", "la", "le", "ten", "ter", "van", "von", "zu", "zur")
_BETWEEN = rf"(?:(?:{'|'.join(PARTICLES)})[ ])*"
#: A word of a name: two letters at least, with what hyphens and apostrophes tie to it but a possessive; or an initial.
_NAME = rf"(?:[dDlL]['’])?(?=[\p{{Latin}}\p{{Cyrillic}}])(?!(?i:{_TITLE})\b)\p{{Lu}}(?=[\p{{L}}'’‐-])[\p{{L}}\p{{M}}]*(?:(?!['’]s(?!\p{{L}}))['’‐-]\p{{L}}[\p{{L}}\p{{M}}]*)*(?![\p{{L}}\p{{M}}\p{{N}}_])"
_INITIAL = r"(?=[\p{Latin}\p{Cyrillic}])\p{Lu}\.(?=[ ])"

# Patterns by kind; the order settles overlaps.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b",
    "card": r"(?<![\w.-])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![\w-])",
    "ssn": r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\w]|\.[0-9])",
    "phone": "|".join(
        (
            r"(?<![\w.+-])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?!\w)",  # North America
            r"(?<![\w.+-])\+(?:[1-9][0-9]{7,14}|[1-9][0-9]{0,2}(?:[ ./-]?\([0-9]{1,4}\)[0-9]{0,4}|[ ./-][0-9]{1,8}){1,6})(?![\w-])",  # any, with a country code
            r"(?<![\w.+/-])0[1-9](?:[ .-][0-9]{2}){4}(?![\w-])",  # France
            r"(?<![\w.+/-])\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{3,8}(?:[ -][0-9]{2,5})?(?![\w/.-])",  # Germany
            r"(?<![\w.+/-])[679][0-9]{2}(?: [0-9]{2} [0-9]{2} [0-9]{2}| [0-9]{3} [0-9]{3})(?![\w-]| [0-9])",  # Spain
            r"(?<![\w.+/-])8 ?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{2}[ -][0-9]{2}(?![\w-])",  # Russia
        )
    ),
    "name": rf"\b(?P<titles>(?i:{_TITLE})\b\.?(?:[ ](?i:{_TITLE})\b\.?)*)[ ](?P<own>{_BETWEEN}(?:{_NAME}|{_INITIAL})(?:[ ]{_BETWEEN}(?:{_NAME}|{_INITIAL})){{0,3}})",
}
_COMPILED = {k: (regex if k == "name" else re).compile(p) for k, p in PATTERNS.items()}
_PART = regex.compile(rf"{_NAME}|{_INITIAL}")
_ONE_TITLE = re.compile(rf"(?i:{_TITLE})\b")
_GAP_OF_NAME = re.compile(rf"[ ]{_BETWEEN}")
_DIGITS = re.compile(r"[0-9][0-9 .()/-]{5,}[0-9]")
_TITLED = re.compile(rf"\b(?i:{_TITLE})\b\.?[ ]")
#: RE2 pattern of what every text with an entity has; Arrow looks for it in all texts of a batch at once.
HOPEFUL = rf"[A-Za-z0-9._%+-]@[A-Za-z0-9-]|[0-9][0-9 .()/-]{{5,}}[0-9]|(?i:{_TITLE})\.? {_BETWEEN}(?:[dDlL]['’])?\p{{Lu}}"
#: Digits of a phone number with a country code, and without.
_PHONE_DIGITS = (8, 15), (9, 13)


class Found(NamedTuple):
    """An entity of a text: ``parts`` is its (kind, canonical entity)."""

    start: int
    end: int
    kind: str
    parts: tuple[tuple[str, str]]


def _phone(value: str) -> bool:
    least, most = _PHONE_DIGITS[not value.startswith("+")]
    return least <= sum(c.isdigit() for c in value) <= most


def find(text: str) -> list[Found]:
    """Entities of a text in order, without overlaps."""
    taken: list[tuple[int, int]] = []
    out: list[Found] = []
    digits, titled = _DIGITS.search(text) is not None, _TITLED.search(text) is not None
    names: list[tuple[int, int, str]] = []  # own words from and to, titles

    def free(a: int, b: int) -> bool:
        # neighbours in order of place alone can overlap
        i = bisect.bisect_left(taken, (a, b))
        if (i and taken[i - 1][1] > a) or (i < len(taken) and taken[i][0] < b):
            return False
        taken.insert(i, (a, b))
        return True

    for kind, pattern in _COMPILED.items():
        if "@" not in text if kind == "email" else not titled if kind == "name" else not digits:
            continue
        for m in pattern.finditer(text):
            if (kind != "phone" or _phone(m.group())) and free(m.start(), m.end()):
                if kind == "name":
                    names.append((*m.span("own"), m.group("titles")))
                else:
                    out.append(Found(m.start(), m.end(), kind, ((kind, canonical(kind, m.group())),)))
    if names:
        out += _named(text, names, free)
    return sorted(out)


def hopeful(texts: pa.Array) -> np.ndarray:
    """Numbers of the texts that may hold an entity."""
    return np.flatnonzero(pc.match_substring_regex(texts, HOPEFUL).fill_null(False).to_numpy(zero_copy_only=False))


def _plain(word: str) -> str:
    return word.lower().replace("’", "'").replace("‐", "-")


def _named(text: str, names: list[tuple[int, int, str]], free) -> list[Found]:
    """Titled names, and the same people without a title; given names and surnames are found apart.

    Of a person whom a title tells by several given names, the first alone is a mention too.
    """
    words = set(re.findall(r"\w+", text))
    told = []
    for a, b, titles in names:
        # what follows a word tells whether it is one, so the search may not end with the name
        own = [(m.start(), m.end(), _plain(m.group())) for m in takewhile(lambda m, b=b: m.start() < b, _PART.finditer(text, a))]
        # a name in lower case somewhere is a word of the language, and an initial is no surname
        while len(own) > 1 and (own[-1][2] in words or own[-1][2].endswith(".")):
            own.pop()
        if own[-1][2].endswith("."):
            continue
        told.append((own, "".join(TITLES.get(t.casefold(), "") for t in _ONE_TITLE.findall(titles))[:1]))
    alone = {own[0][2] for own, _ in told if len(own) == 1}
    people: dict[tuple[str, str], str] = {}
    whole = []
    for own, gender in told:
        # the surname that stands alone elsewhere ends the name here
        end = next((i for i in range(1, len(own)) if own[i][2] in alone), len(own) - 1)
        own = own[: end + 1]
        whole.append(own)
        if len(own) > 1:
            person = "_".join(w for *_, w in own[:-1]), own[-1][2]
            people[person] = people.get(person) or gender
    surnames = {own[-1][2] for own in whole}
    called: dict[tuple[str, str], tuple[str, str]] = {}
    by_given: dict[str, tuple[str, str]] = {}
    for g, s in people:
        called[g, s] = g, s
    for g, s in people:
        called.setdefault((g.partition("_")[0], s), (g, s))
        for one in (g, g.partition("_")[0]):
            by_given.setdefault(one, (g, s))
    single = {w for w in (*surnames, *by_given) if len(w) > 2 and w not in words}

    def found(own: list[tuple[int, int, str]]) -> list[Found]:
        last = Found(*own[-1][:2], "name", (("surname", own[-1][2]),))
        if len(own) == 1:
            return [last]
        g, s = called["_".join(w for *_, w in own[:-1]), own[-1][2]]
        return [Found(own[0][0], own[-2][1], "name", (("given", f"{g} {s}/{people[g, s] or '?'}"),)), last]

    out = [f for own in whole for f in found(own)]
    every = [(m.start(), m.end(), _plain(m.group())) for m in _PART.finditer(text)]
    at = 0
    while at < len(every):
        length = 1
        while length < 4 and at + length < len(every) and _GAP_OF_NAME.fullmatch(text, every[at + length - 1][1], every[at + length][0]):
            length += 1
        while length > 1 and ("_".join(w for *_, w in every[at : at + length - 1]), every[at + length - 1][2]) not in called:
            length -= 1
        own = every[at : at + length]
        word = own[0][2]
        if length > 1:
            if free(own[0][0], own[-1][1]):
                out += found(own)
        elif word in single and free(*own[0][:2]):
            g, s = by_given.get(word, ("", ""))
            out.append(Found(*own[0][:2], "name", (("surname", word) if word in surnames else ("given", f"{g} {s}/{people[g, s] or '?'}"),)))
        at += length
    return out


def canonical(kind: str, value: str) -> str:
    """One spelling for all spellings of an entity."""
    if kind == "email":
        return value.lower()
    if kind == "ip":
        return ".".join(str(int(x)) for x in value.split("."))
    digits = re.sub(r"[^0-9]", "", value)
    if kind != "phone":
        return digits
    if len(digits) == 11 and digits[0] == "1":
        return digits[1:]
    return f"+{digits}" if value.startswith("+") else digits


@lru_cache(maxsize=4096)
def _round_key(key: bytes, tweak: str) -> bytes:
    return hmac.new(key, tweak.encode(), hashlib.blake2b).digest()


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, secret = (1 << half) - 1, _round_key(key, f"{tweak}/{size}")
    while True:
        left, right = value >> half, value & mask
        for r in range(8):
            mixed = hashlib.blake2b(right.to_bytes((half + 7) // 8, "big") + bytes([r]), key=secret[:64], digest_size=min(64, (half + 7) // 8 + 8)).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def unpermute(value: int, size: int, key: bytes, tweak: str) -> int:
    """The inverse of ``permute``."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, secret = (1 << half) - 1, _round_key(key, f"{tweak}/{size}")
    while True:
        left, right = value >> half, value & mask
        for r in range(7, -1, -1):
            mixed = hashlib.blake2b(left.to_bytes((half + 7) // 8, "big") + bytes([r]), key=secret[:64], digest_size=min(64, (half + 7) // 8 + 8)).digest()
            left, right = right ^ (int.from_bytes(mixed, "big") & mask), left
        value = left << half | right
        if value < size:
            return value


def cycled(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1 that is one cycle, so that only a space of one has a fixed point."""
    return unpermute((permute(value, size, key, tweak) + 1) % size, size, key, tweak) if size > 1 else value


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def reshape(text: str, key: bytes, tweak: str) -> str:
    """Another string of the same shape: digits stay digits, letters letters of their case."""
    slots = [next((a for a in _ALPHABETS if c in a), "") for c in text]
    number, size = 0, 1
    for c, a in zip(text, slots, strict=True):
        if a:
            number, size = number * len(a) + a.index(c), size * len(a)
    shape = "".join("dlU"[_ALPHABETS.index(a)] if a else c for c, a in zip(text, slots, strict=True))
    number = cycled(number, size, key, f"{tweak}/{shape}")
    out = []
    for c, a in zip(reversed(text), reversed(slots), strict=True):
        if a:
            number, digit = divmod(number, len(a))
            c = a[digit]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _head(kind: str, canon: str) -> int:
    """Leading characters that a number keeps."""
    if kind == "card":
        return 1
    if kind == "phone":
        return 3 if canon[0] == "+" else 0 if len(canon) == 10 and canon[0] != "0" else 1
    if kind == "ip":
        # a reserved block
        a, b, *_ = canon.split(".")
        two = (a, b) == ("192", "168") or (a == "172" and 16 <= int(b) < 32)
        return len(f"{a}.{b}.") if two else len(f"{a}.") if a in ("0", "10", "127") else 0
    return 0


def _kept_class(kind: str, canon: str) -> tuple:
    """What a surrogate keeps of its entity besides the shape and the head."""
    if kind == "card":
        return (_luhn(canon),)
    if kind == "phone":
        return (len(canon) == 10 and canon[0] > "1" and canon[3] > "1",) if canon[0] != "+" else ()
    if kind == "ssn":
        return (canon[:3] not in ("000", "666") and canon[0] != "9", canon[3:5] != "00", canon[5:] != "0000")
    return (int(canon.split(".")[0]) >= 224, _head(kind, canon))


def _shape(text: str) -> str:
    return "".join(next(("dlU"[i] for i, a in enumerate(_ALPHABETS) if c in a), c) for c in text)


def _odd_mailbox(canon: str) -> bool:
    """Without a letter or digit before the last dot."""
    return not any(c in a for c in canon.rpartition(".")[0] for a in _ALPHABETS)


def space(kind: str, canon: str) -> str:
    """Name of the closed set in which all tweaks of an entity stay; empty if they may grow."""
    if kind in ("surname", "given") or (kind == "email" and _odd_mailbox(canon)):
        return ""
    if kind == "email":
        host, _, tld = canon.rpartition(".")
        return f"{_shape(host)}.{tld}"
    n = _head(kind, canon)
    return f"{canon[:n]}|{'ip' if kind == 'ip' else _shape(canon)}|{_kept_class(kind, canon)}"


def surrogate(kind: str, canon: str, key: bytes, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical entity."""
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        host, _, tld = domain.rpartition(".")
        if _odd_mailbox(canon):
            more = attempt * "-"
            return f"{_lettered(local + more, key, f'{tweak}/{canon}/local')}@{_lettered(host, key, f'{tweak}/{canon}/host')}.{tld}"
        return f"{reshape(local, key, f'{tweak}/{domain}')}@{reshape(host, key, f'{tweak}/host')}.{tld}"
    if kind == "surname":
        script = _script(canon)
        more = [_syllables(_drawn(key, f"{tweak}/{canon}/{i}"), 4, script) for i in range(canon.count("-"))]
        return "-".join([_syllables(_drawn(key, f"{tweak}/{canon}"), min(24, 5 + attempt), script), *more])
    if kind == "given":
        person, _, gender = canon.rpartition("/")
        given, surname = person.split(" ")
        first, *rest = re.split("([_-])", given)
        pool = [n.lower() for n in GIVEN[_script(first), gender] if n.lower() != first]
        out = pool[_drawn(key, f"{tweak}/{canon}") % len(pool)]
        # from the third tweak on each draws from a space 70 times as large
        out = out + _syllables(_drawn(key, f"{tweak}/{canon}/more"), min(20, attempt - 1), _script(first)) if attempt > 2 else out
        for i, (mark, more) in enumerate(zip(rest[::2], rest[1::2], strict=True)):
            number, pool = _drawn(key, f"{tweak}/{canon}/{i}"), [n.lower() for n in GIVEN[_script(more), gender] if n.lower() != more]
            father = {"вич": "ович", "вна": "овна"}.get(more[-3:])
            out += mark + (_syllables(number, 2, "cyrillic")[:-1] + father if father else pool[number % len(pool)])
        return f"{out}|{surname}"
    n, own, value = _head(kind, canon), _kept_class(kind, canon), canon
    while True:
        if kind == "ip":
            kept = canon[:n].count(".")
            size = 256 ** (4 - kept)
            number = cycled(int.from_bytes(bytes(map(int, value.split(".")[kept:])), "big"), size, key, f"{tweak}/{canon[:n]}")
            value = canon[:n] + ".".join(map(str, number.to_bytes(4 - kept, "big")))
        else:
            value = canon[:n] + reshape(value[n:], key, f"{tweak}/{canon[:n]}")
        if _kept_class(kind, value) == own:
            return value


def _drawn(key: bytes, what: str) -> int:
    return int.from_bytes(hmac.new(key, what.encode(), hashlib.sha256).digest(), "big")


def _lettered(text: str, key: bytes, what: str) -> str:
    """Letters for all but the dots of a text that has no slots to permute."""
    return "".join(c if c == "." else _ALPHABETS[1][_drawn(key, f"{what}/{i}") % 26] for i, c in enumerate(text))


def _syllables(number: int, count: int, script: str) -> str:
    consonants, vowels = _SYLLABLES[script]
    out = ""
    for _ in range(count):
        number, c = divmod(number, len(consonants))
        number, v = divmod(number, len(vowels))
        out += consonants[c] + vowels[v]
    return out


def _script(name: str) -> str:
    return "cyrillic" if any("а" <= c <= "я" or c == "ё" for c in name) else "latin"


def likely_gender(given: str, key: bytes) -> str:
    """Gender of a person whom no title tells: by a list of names, else by a hash."""
    return _GENDER.get(re.split("[_-]", given)[0]) or "fm"[_drawn(key, f"gender/{given}") & 1]


def spelled(kind: str, value: str, canon: str) -> str:
    """A canonical surrogate written in the way that ``value`` was."""
    if kind == "email":
        return "".join(c.upper() if o.isupper() else c for o, c in zip(value, canon, strict=True)) if len(value) == len(canon) else canon
    if kind == "ip":
        return canon
    canon = canon.lstrip("+")
    extra = sum(c.isdigit() for c in value) - len(canon)
    digits = iter(canon)
    seen, out = 0, []
    for c in value:
        if c.isdigit():
            seen += 1
            c = c if seen <= extra else next(digits)
        out.append(c)
    return "".join(out)


def named(value: str, canon: str) -> str:
    """The words of a surrogate in place of those of ``value``, with its particles, hyphens, initials and capitals."""
    words, out = re.split("[_-]", canon), []
    for i, own in enumerate(re.split(r"([ ‐-])", value)):
        if i % 2 or own in PARTICLES:
            out.append(own)
            continue
        new = words[0] if len(words) == 1 else words.pop(0)
        new = f"{new[0].upper()}." if own.endswith(".") else new.upper() if own.isupper() and len(own) > 1 else new.capitalize()
        out.append(new)
    return "".join(out)


def resolved(kind: str, canon: str, key: bytes, exceptions: dict[tuple[str, str], int]) -> str:
    """``canon``, a person of no known gender with the gender that the corpus or the name tells."""
    if kind != "given" or not canon.endswith("/?"):
        return canon
    told = exceptions.get(("gender", canon[:-2]))
    return canon[:-1] + (likely_gender(canon.split(" ")[0], key) if told is None else "fm"[told])


def rewrite(text: str, key: bytes, exceptions: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    """The text with its entities replaced, and their kinds."""
    found = find(text)
    if not found:
        return text, []
    out, at = [], 0
    for a, b, kind, ((k, c),) in found:
        c = resolved(k, c, key, exceptions)
        made = surrogate(k, c, key, exceptions.get((k, c), 0))
        out += [text[at:a], named(text[a:b], made.partition("|")[0]) if kind == "name" else spelled(kind, text[a:b], made)]
        at = b
    return "".join([*out, text[at:]]), [f.kind for f in found]


_ENTITY = "kind string, canon string, sur string, space string"


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def entities(docs: DataFrame, key: bytes) -> tuple[DataFrame, DataFrame]:
    """Distinct (kind, canon, sur, space) of all entities of ``docs``, sur being the first surrogate; and (canon, told) of people whose gender others' titles tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter()
            texts = batch.column("text")
            for i in hopeful(texts).tolist():
                seen.update({p for f in find(texts[i].as_py()) for p in f.parts})
            yield _batch([(k, c, n) for (k, c), n in sorted(seen.items())], ["kind", "canon", "n"], [pa.string(), pa.string(), pa.int64()])

    found = docs.select("text").mapInArrow(common.tidy(run), "kind string, canon string, n long").groupBy("kind", "canon").agg(F.sum("n").alias("n"))
    found = common.checkpointed(found)
    given = found.where("kind = 'given'").select(F.expr("left(canon, length(canon) - 2)").alias("person"), F.right("canon", F.lit(1)).alias("gender"), "n")
    side = lambda g: F.sum(F.when(F.col("gender") == g, F.col("n")).otherwise(0))
    people = given.groupBy("person").agg(F.max(F.col("gender") == "?").alias("open"), side("m").alias("m"), side("f").alias("f"))

    def settle(batches):
        for batch in batches:
            rows = []
            for person, m, f in zip(*(batch.column(c).to_pylist() for c in ("person", "m", "f")), strict=True):
                likely = likely_gender(person.split(" ")[0], key)
                told = "m" if m > f else "f" if f > m else likely
                rows.append(("given", f"{person}/{told}", None if told == likely else int(told == "m")))
            yield _batch(rows, ["kind", "canon", "told"], [pa.string(), pa.string(), pa.int32()])

    untold = common.checkpointed(people.where("open").select("person", "m", "f").mapInArrow(settle, "kind string, canon string, told int"))

    def first(batches):
        for batch in batches:
            rows = [(k, c, surrogate(k, c, key), space(k, c)) for k, c in zip(batch.column("kind").to_pylist(), batch.column("canon").to_pylist(), strict=True)]
            yield _batch(rows, ["kind", "canon", "sur", "space"], [pa.string()] * 4)

    every = found.where("kind <> 'given' or canon not like '%/?'").select("kind", "canon").union(untold.select("kind", "canon")).distinct()
    # few bytes but much arithmetic: a partition each, that adaptive execution leaves alone
    every = every.repartition(common.shuffle_partitions(docs.sparkSession))
    return every.mapInArrow(common.tidy(first), _ENTITY), untold.where("told is not null").select(F.lit("gender").alias("kind"), F.expr("left(canon, length(canon) - 2)").alias("canon"), F.col("told").alias("attempt"))


def exceptions_of(found: DataFrame, key: bytes, patience: int = 4) -> DataFrame | None:
    """(kind, canon, attempt) of the entities that need another than the first tweak; None if none does.

    A closed space that ``patience`` rounds in a row leave as it was goes back to the first tweak for all.
    """

    def again(batches):
        for batch in batches:
            rows = [(k, c, surrogate(k, c, key, a), p, a, f) for k, c, p, a, f in zip(*(batch.column(c).to_pylist() for c in ("kind", "canon", "space", "attempt", "first")), strict=True)]
            yield _batch(rows, ["kind", "canon", "sur", "space", "attempt", "first"], [*[pa.string()] * 4, pa.int32(), pa.string()])

    names = ["kind", "canon", "sur", "space", "attempt", "first"]
    schema = f"{_ENTITY}, attempt int, first string"
    originals = found.select("kind", F.col("canon").alias("sur")).withColumn("real", F.lit(True))
    settled = found.select("kind", "canon", "sur", "space", F.lit(0).alias("attempt"), F.col("sur").alias("first"))
    attempt, least, idle, parts = 0, None, 0, common.shuffle_partitions(found.sparkSession)
    while True:
        # of the entities with one surrogate, that settled first, then the first in order, keeps it; -1 is for good
        holder = settled.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "canon")).alias("own"))
        clash = settled.join(originals, ["kind", "sur"], "left").join(holder, ["kind", "sur"])
        clash = clash.withColumn("bad", (F.col("attempt") >= 0) & (F.col("real").isNotNull() | (F.struct("attempt", "canon") != F.col("own"))))
        clash = common.checkpointed(clash.select(*names, "bad"))
        left, closed = clash.agg(F.count_if("bad"), F.count_if(F.col("bad") & (F.col("space") != ""))).first()
        if not left:
            return settled.where("attempt > 0").select("kind", "canon", "attempt") if attempt else None
        attempt += 1
        if closed:
            least, idle = (closed, 0) if least is None or closed < least else (least, idle + 1)
        if closed and idle >= patience:
            # too few strings of these spaces are free: the first tweak is distinct inside them
            full = clash.where("bad and space <> ''").select("kind", "space").distinct().withColumn("full", F.lit(True))
            clash = clash.join(full, ["kind", "space"], "left").withColumn("full", F.coalesce("full", F.lit(False)))
            clash = common.checkpointed(
                clash.withColumn("bad", F.col("bad") & ~F.col("full"))
                .withColumn("sur", F.when(F.col("full"), F.col("first")).otherwise(F.col("sur")))
                .withColumn("attempt", F.when(F.col("full"), F.lit(-1)).otherwise(F.col("attempt")))
                .select(*names, "bad")
            )
            least, idle = None, 0
        moved = clash.where("bad").withColumn("attempt", F.lit(attempt)).drop("bad").repartition(parts).mapInArrow(common.tidy(again), schema)
        settled = clash.where("not bad").drop("bad").union(moved.select(*clash.drop("bad").columns))


def surrogates(docs: DataFrame, key: str, kinds: str | None = "pii_kinds", most_broadcast: int = 100_000) -> DataFrame:
    """``docs`` with text rewritten and, in a last column ``kinds``, the kinds replaced.

    A column of that name in ``docs`` gives way; with None there is none.
    """
    secret = key.encode()
    found, told = entities(docs, secret)
    special = exceptions_of(common.checkpointed(found), secret)
    special = told if special is None else special.union(told)
    fields = [f for f in docs.schema.fields if f.name != kinds]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, *([T.StructField(kinds, T.ArrayType(T.StringType()))] if kinds else [])])
    few: dict[tuple[str, str], int] = {}
    source, own = docs, common.fresh(docs, "exceptions")
    head = special.limit(most_broadcast + 1).collect()
    if len(head) <= most_broadcast:
        few = {(r["kind"], r["canon"]): r["attempt"] for r in head}
    else:
        source = _with_exceptions(source, special, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in common.slices(whole, 2048)):
            texts = batch.column("text")
            at = hopeful(texts)
            done = {}
            for i in at.tolist():
                more = few if own not in batch.schema.names else {(x["kind"], x["canon"]): x["attempt"] for x in batch.column(own)[i].as_py()}
                done[i] = rewrite(texts[i].as_py(), secret, more)
            if done:
                mask = np.zeros(len(texts), dtype=bool)
                mask[at] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([d[0] for d in done.values()], texts.type))
            columns = [texts if n == "text" else batch.column(n) for n in names]
            if kinds:
                columns.append(pa.array([done[i][1] if i in done else [] for i in range(len(texts))], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(common.tidy(run), schema)


def _with_exceptions(docs: DataFrame, special: DataFrame, name: str) -> DataFrame:
    """Each row of ``docs`` with the exceptions among its own entities, by a join on the text's digest."""

    def run(batches):
        for batch in batches:
            rows = []
            texts = batch.column("text")
            for text in (texts[i].as_py() for i in hopeful(texts).tolist()):
                own = {p for f in find(text) for p in f.parts}
                # a person of no known gender is looked up under each
                own |= {x for k, c in own if k == "given" and c.endswith("/?") for x in (("gender", c[:-2]), (k, f"{c[:-1]}m"), (k, f"{c[:-1]}f"))}
                rows += [(hashlib.sha256(text.encode()).hexdigest(), k, c) for k, c in own]
            yield _batch(rows, ["digest", "kind", "canon"], [pa.string()] * 3)

    held = docs.select("text").mapInArrow(common.tidy(run), "digest string, kind string, canon string").distinct().join(special, ["kind", "canon"])
    lists = held.groupBy("digest").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("listed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    some = F.coalesce("listed", F.array().cast("array<struct<kind: string, canon: string, attempt: int>>"))
    return rows.join(lists, "digest", "left").select("row.*", some.alias(name))
