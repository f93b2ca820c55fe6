"""Detection of personal data in one text, and keyed surrogates for it.

An entity has a kind and a canonical value (digits of a phone number, a
lower-cased address ...); its written forms share it. A surrogate is a
canonical value of the same kind and shape: a keyed permutation of all values
of that shape, so that different values never meet. It is poured back into
each written form: separators, letter case and title stay.

Kinds: email, ip, card (Luhn-valid only), iban (checksum-valid only), ssn,
phone, secret (access keys, and what is assigned to ``password``, ``token``,
``secret`` or ``api_key``) and name. A name is what follows a title that tells
a gender, and later mentions of its parts in the same text; its surrogate
keeps the gender of given names, the script and the number of parts.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass

# A text without any of these cannot hold an entity (Java and Python syntax).
_TITLES_M = ("Mr", "Herr", "Monsieur", "Sr", "Señor", "Господин")
_TITLES_F = ("Mrs", "Ms", "Frau", "Mme", "Madame", "Sra", "Señora", "Госпожа")
MAYBE = (r"[0-9@]|AKIA|(?i:password|passwd|token|secret|api.?key)|"
         + "|".join(rf"\b{t}\b" for t in (*_TITLES_M, *_TITLES_F)))

# Every text that MAYBE matches has a digit, an @ or one of these (the last: in lower case).
MAYBE_PARTS = ("AKIA", *_TITLES_M, *_TITLES_F)
MAYBE_LOWER = ("password", "passwd", "token", "secret", "api")

_PART = r"[^\W\d_a-z][^\W\d_]*(?:[-'’][^\W\d_]+)*"
# What is assigned without quotes runs to white space, a quote or a delimiter ("&" only before
# another assignment); marks that may close a sentence or bracket do not end it.
_RUN = r"(?:[!#$%()*+\-./0-9:=?@A-Z\[\\\]^_a-z{}~\u00C0-\u058F]|&(?![\w.-]{1,40}=))"
_PATTERNS = (
    # from the start of a run only: a match from inside would also match from there. A local
    # part has at most 64 characters, which bounds the search in long dotted runs
    r"(?P<email>(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@"
    r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+)",
    r"(?P<secret>(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9]))",
    r"(?P<assigned>(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3})"
    r"(?:(?P<quote>[\"'])(?P<quoted>(?:\\.|(?!(?P=quote))[^\\\n]){8,}+)(?P=quote)(?!\w)"
    rf"|[\"']?(?P<value>{_RUN}{{8,}}(?<![.:?)\]}}])))",
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]){11,30}(?![A-Za-z0-9]))",
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d))",
    r"(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.])\+\d{1,3}(?:[ .-]?\d){7,12}(?!\w))",
    rf"(?P<title>\b(?:{'|'.join((*_TITLES_M, *_TITLES_F))})\b\.?[ ])(?P<person>{_PART}(?:[ ]{_PART}){{0,2}})",
)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_FIND = re.compile("|".join(_PATTERNS))
_BARE = re.compile(rf"([mf]:(?:[^\W\d_]|[-'’ ])+)#\d+")
_EACH = [re.compile(p) for p in _PATTERNS]  # in the order in which they are tried
_AT = {k: i for i, p in enumerate(_EACH) for k in p.groupindex}

# Lengths of IBANs by country.
_IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 "
    "EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 "
    "KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 "
    "PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 "
    "VG24 XK20").split()}

# Given names by script and gender, and family-name endings (fixed values).
_GIVEN = {
    ("LATIN", "m"): ["adam", "bruno", "daniel", "erik", "felix", "hugo", "ivan", "jonas", "leo",
                     "martin", "oscar", "paul", "robin", "simon", "thomas", "victor"],
    ("LATIN", "f"): ["alma", "bianca", "clara", "diana", "elena", "flora", "greta", "helena",
                     "irma", "julia", "laura", "maria", "nora", "paula", "sara", "vera"],
    ("CYRILLIC", "m"): ["антон", "борис", "виктор", "денис", "егор", "иван", "олег", "павел"],
    ("CYRILLIC", "f"): ["алла", "вера", "дарья", "елена", "ирина", "мария", "нина", "ольга"],
}
_SYLLABLES = {
    "LATIN": ["ba", "de", "fi", "go", "ha", "ke", "lu", "mo", "na", "pe", "ri", "so", "ta", "vu",
              "wi", "za"],
    "CYRILLIC": ["ба", "ве", "го", "да", "жи", "ко", "лу", "ми", "но", "пе", "ри", "со", "та",
                 "фу", "че", "ша"],
}
_LEAST_DOMAIN = 10**7
WIDEN = 8  # draws after which a crowded shape gets a wider target, and again after as many
_BLOCK = 128  # letters of a long secret that are permuted at once


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    kind: str
    canon: str

    @property
    def entity(self) -> str:
        return base(self.canon) if self.kind == "name" else self.canon


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _is_phone(text: str) -> bool:
    return 8 <= len(_digits(text)) <= 15


def _phone(text: str) -> str:
    """One value for a number written with or without its country code 1."""
    digits = _digits(text)
    if text[0] != "+" and len(digits) == 10:
        return "+1" + digits
    return "+" + digits if text[0] == "+" or len(digits) == 11 else digits


def script(word: str) -> str:
    return unicodedata.name(word[0], "LATIN").split(" ")[0]


def _iban_end(run: str) -> int:
    """Length of the valid IBAN that a run of groups starts with, or 0."""
    ends = [i for i in range(len(run), 0, -1) if i == len(run) or run[i] == " "]
    size = {i: len(run[:i].replace(" ", "")) for i in ends}
    known = _IBAN_LENGTH.get(run[:2])
    ends = [*(i for i in ends if size[i] == known), *(i for i in ends if not known or i == len(run))]
    return next((i for i in ends if size[i] >= 15 and _iban_rest(run[:i].replace(" ", "")) == 1), 0)


def _card_end(run: str, inside: bool) -> int:
    """Length of the valid card that a run of digit groups starts with, or 0. A part of
    a run (``inside``: it starts in one) must be grouped as cards are."""
    if run[0] not in "3456" or _EACH[_AT["phone"]].match(run) or _EACH[_AT["ssn"]].match(run):
        return 0  # the latter start with groups that no card has
    for i in range(len(run), 12, -1):
        if i == len(run) or run[i] in " -":
            part = inside or i < len(run)
            groups = re.split("[ -]", run[:i])
            if len(digits := "".join(groups)) >= 13 and _luhn(digits) == 0 and not (
                    part and any(len(g) < 4 for g in groups[:-1])):
                return i
    return 0


def _mention(m: re.Match, inside: bool) -> Mention | None:
    """What a match stands for, if it passes the checks of its kind."""
    kind, (start, end) = m.lastgroup, m.span()
    if kind in ("value", "quoted"):
        for other in (_EACH[_AT["email"]], _EACH[_AT["ip"]]):  # these keep their kind
            if whole := other.fullmatch(m.string, *m.span(kind)):
                return _mention(whole, inside) or Mention(*m.span(kind), "secret", m[kind])
        return Mention(*m.span(kind), "secret", m[kind]) if any(map(str.isalnum, m[kind])) else None
    if kind == "person":
        gender = "m" if m["title"].rstrip(". ") in _TITLES_M else "f"
        return Mention(*m.span("person"), "name", gender + ":" + m["person"].lower())
    if kind == "email":  # a longer local part is taken whole, too
        while start > m.pos and m.string[start - 1] in _LOCAL:
            start -= 1
        while m.string[start] in "._%+-":
            start += 1
        return Mention(start, end, kind, m.string[start:end].lower())
    if kind == "ip":
        parts = [int(x) for x in m[0].split(".")]
        return Mention(start, end, kind, ".".join(map(str, parts))) if max(parts) < 256 else None
    if kind == "iban":
        n = _iban_end(m[0])
        return Mention(start, start + n, kind, m[0][:n].replace(" ", "")) if n else None
    if kind == "card":
        n = _card_end(m[0], inside)
        return Mention(start, start + n, kind, _digits(m[0][:n])) if n else None
    if kind == "phone":
        return Mention(start, end, kind, _phone(m[0])) if _is_phone(m[0]) else None
    return Mention(start, end, kind, _digits(m[0]) if kind == "ssn" else m[0])


def find(text: str) -> list[Mention]:
    """All mentions of a text, in order and apart from one another."""
    out, people = [], {}
    at = run = 0  # run: end of the last digits that are no card as a whole
    while m := _FIND.search(text, at):
        start = m.start()
        found = _mention(m, start < run)
        if found is None:  # the other kinds get their turn, here and further on
            if m.lastgroup == "card":
                run = max(run, m.end())
            for each in _EACH[_AT[m.lastgroup] + 1:]:
                if (other := each.match(text, start)) and (found := _mention(other, start < run)):
                    m = other
                    break
        if found is None:
            at = start + 1
            continue
        out.append(found)
        at = found.end
        if m.lastgroup == "card" and found.end < m.end():
            run = max(run, m.end())
        elif m.lastgroup == "person":
            words = m["person"].split(" ")
            people.setdefault(words[-1], (found.canon, len(words) - 1))
    if people:  # later mentions by the last part of the name alone
        taken = [(x.start, x.end) for x in out]
        again = re.compile(r"\b(?:" + "|".join(map(re.escape, people)) + r")\b")
        for m in again.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                canon, part = people[m[0]]
                out.append(Mention(*m.span(), "name", f"{canon}#{part}"))
        out.sort(key=lambda x: x.start)
    return out


def base(canon: str) -> str:
    """The entity a mention stands for (a bare family name: its person)."""
    bare = _BARE.fullmatch(canon)
    return bare[1] if bare else canon


# -- keyed permutations ------------------------------------------------------

def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size): a Feistel network walked until it
    lands inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(8):
            h = hashlib.blake2b(b"%d|" % r + right.to_bytes(width, "big") + tweak.encode(),
                                key=key, digest_size=width + 8).digest()
            left, right = right, left ^ (int.from_bytes(h, "big") & mask)
        value = (left << half) | right
        if value < size:
            return value


_LOWER, _UPPER, _NUM = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_HEX = "0123456789abcdef"


def _alphabet(c: str, whole: str) -> str | None:
    if c in _HEX and len(whole) >= 16 and not whole.isdigit() and all(x in _HEX for x in whole):
        return _HEX
    return next((a for a in (_LOWER, _UPPER, _NUM) if c in a), None)


def _permute_text(text: str, key: bytes, tweak: str, grow: int = 0) -> str:
    """Letters to letters of their case, digits to digits, the rest kept."""
    sets = [_alphabet(c, text) for c in text]
    extra = []
    size = 1
    for a in sets:
        size *= len(a) if a else 1
    if grow:  # too few texts of this shape: lead with letters
        while size < grow:
            extra.append(_LOWER)
            size *= len(_LOWER)
    value = 0
    for a, c in zip([*extra, *sets], ["a"] * len(extra) + list(text)):
        if a:
            value = value * len(a) + a.index(c)
    shape = "".join(c if a is None else str(len(a)) + a[0] for a, c in zip(sets, text))
    value = permute(value, size, key, tweak + "|" + shape)
    out = []
    for a, c in zip(reversed([*extra, *sets]), reversed(["a"] * len(extra) + list(text))):
        if a:
            value, at = divmod(value, len(a))
            out.append(a[at])
        else:
            out.append(c)
    return "".join(reversed(out))


def _family(word: str, key: bytes, tweak: str, wide: int = 0) -> str:
    name = script(word)
    if name not in _SYLLABLES:  # another script: letters of the word's own block
        word += word[-1] * wide
        value = 0
        for c in word:
            value = value * 16 + ord(c) % 16
        value = permute(value, 16 ** len(word), key, tweak)
        out = []
        for c in reversed(word):
            value, low = divmod(value, 16)
            moved = chr(ord(c) - ord(c) % 16 + low)
            out.append(moved if moved.isalpha() else c)
        return "".join(reversed(out))
    h = int.from_bytes(hashlib.blake2b((tweak + "|" + word).encode(), key=key, digest_size=8
                                       ).digest(), "big")
    syllables = _SYLLABLES[name]
    return "".join(syllables[(h >> (4 * i)) % 16] for i in range(min(16, 5 + wide)))


_PRIVATE = ((0x0A000000, 24), (0xAC100000, 20), (0xC0A80000, 16))


def _private(value: int, key: bytes, tweak: str) -> int:
    """A private address moved within all private blocks, as one range."""
    firsts = [sum(1 << bits for _, bits in _PRIVATE[:i]) for i in range(4)]
    at = next(i for i, (low, bits) in enumerate(_PRIVATE) if value >> bits == low >> bits)
    value = permute(value - _PRIVATE[at][0] + firsts[at], firsts[3], key, tweak + "|private")
    at = next(i for i in range(3) if value < firsts[i + 1])
    return _PRIVATE[at][0] + value - firsts[at]


def _ip(canon: str, key: bytes, tweak: str, wide: int = 0) -> str:
    a, b, c, d = map(int, canon.split("."))
    value = (a << 24) | (b << 16) | (c << 8) | d
    for low, bits in (*_PRIVATE, (0x7F000000, 24)):
        if value >> bits == low >> bits:  # stays in its private block, or private in a crowded one
            if wide and (low, bits) in _PRIVATE:
                value = _private(value, key, tweak)
            else:
                value = low + permute(value - low, 1 << bits, key, f"{tweak}|{bits}|{low}")
            break
    else:
        while True:  # walk past private and special blocks
            value = permute(value, 1 << 32, key, tweak)
            first = value >> 24
            if 0 < first < 224 and first not in (10, 127) and value >> 20 != 0xAC1 \
                    and value >> 16 != 0xC0A8 or a == 0 or a >= 224:
                break
    return ".".join(str((value >> s) & 255) for s in (24, 16, 8, 0))


def surrogate(kind: str, canon: str, key: bytes, attempt: int = 0) -> str:
    """The canonical surrogate of an entity; another one for every ``attempt``."""
    tweak, wide = f"{kind}|{attempt}", attempt // WIDEN
    least = _LEAST_DOMAIN << (8 * wide)
    if kind == "email":
        local, _, domain = canon.partition("@")
        host, _, top = domain.rpartition(".")
        if not re.fullmatch(r"(.*\.)?example", host):  # reserved names stay
            host = ".".join(_permute_text(x, key, "host") for x in host.split("."))
        return f"{_permute_text(local, key, tweak + '|' + domain, grow=least)}@{host}.{top}"
    if kind == "ip":
        return _ip(canon, key, tweak, wide)
    if kind == "card":  # issuer digit and validity stay
        inner = _permute_text(canon[1:-1], key, tweak + canon[0])
        return next(x for x in (canon[0] + inner + c for c in _NUM) if _luhn(x) == 0)
    if kind == "iban":
        inner = canon[:2] + "00" + _permute_text(canon[4:], key, tweak + canon[:2])
        return f"{canon[:2]}{98 - _iban_rest(inner):02d}{inner[4:]}"
    if kind == "phone":
        plus, digits = canon[:-10] if len(canon) > 10 else "", canon[-10:]
        return plus + _permute_text(digits, key, tweak + "|" + plus)
    if kind == "secret":
        if re.fullmatch("AKIA[A-Z0-9]{16}", canon):
            return "AKIA" + _permute_mixed(canon[4:], key, tweak)
        return _secret(canon, key, tweak, least)
    if kind == "name":
        gender, _, person = canon.partition(":")
        *given, last = person.split(" ")
        out = []
        for i, word in enumerate(given):
            names = _GIVEN.get((script(word), gender))
            h = hashlib.blake2b(f"{tweak}|{gender}|{i}|{word}".encode(), key=key, digest_size=8)
            out.append(names[int(h.hexdigest(), 16) % len(names)] if names
                       else _family(word, key, tweak, wide))
        return f"{gender}:" + " ".join([*out, _family(last, key, tweak + "|" + person, wide)])
    return _permute_text(canon, key, tweak)


def _secret(canon: str, key: bytes, tweak: str, least: int) -> str:
    """Any length: a long text goes by equal blocks, each drawn by the whole text. Letters
    beyond ASCII become ASCII letters."""
    blocks = -(-len(canon) // _BLOCK)
    if blocks == 1 and canon.isascii():
        return _permute_text(canon, key, tweak, grow=least)
    size = -(-len(canon) // blocks)
    tweak += "|" + hashlib.blake2b(canon.encode(), key=key, digest_size=32).hexdigest()
    out = [_permute_text(canon[i:i + size], key, f"{tweak}|{i}", grow=least if blocks == 1 else 0)
           for i in range(0, len(canon), size)]
    if canon.isascii():
        return "".join(out)
    stream = hashlib.shake_256(key + tweak.encode()).digest(len(canon) + 8)
    return "".join((_UPPER if c.isupper() else _LOWER)[stream[i] % 26] if c.isalnum() and not c.isascii()
                   else c for i, c in enumerate("".join(out)))


def _permute_mixed(text: str, key: bytes, tweak: str) -> str:
    """Upper-case letters and digits as one alphabet."""
    alphabet = _UPPER + _NUM
    value = 0
    for c in text:
        value = value * 36 + alphabet.index(c)
    value, out = permute(value, 36 ** len(text), key, tweak), []
    for _ in text:
        value, at = divmod(value, 36)
        out.append(alphabet[at])
    return "".join(reversed(out))


# -- writing back --------------------------------------------------------------

def _like(word: str, form: str) -> str:
    """``word`` in the letter case of ``form``."""
    if form.isupper() and len(form) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if form[:1].isupper() else word


def render(mention: Mention, form: str, replacement: str) -> str:
    """The surrogate in the written form of the mention."""
    if mention.kind == "name":
        words = replacement.partition(":")[2].split(" ")
        forms = form.split(" ")
        if "#" in mention.canon:
            words = [words[int(mention.canon.rpartition("#")[2])]]
        return " ".join(_like(w, f) for w, f in zip(words, forms))
    if mention.kind == "email":
        return replacement.upper() if form.isupper() else replacement
    if mention.kind in ("secret", "ip"):
        return replacement
    places = sum(c.isalnum() for c in form)  # a number's form may leave out the country code
    rest = iter(replacement.lstrip("+")[-places:])
    return "".join(next(rest) if c.isalnum() else c for c in form)


def replace(text: str, given: dict[tuple[str, str], str]) -> tuple[str, int]:
    """(text with the surrogates of ``given`` for its entities, mentions replaced)."""
    out, at, n = [], 0, 0
    for m in find(text):
        new = given.get((m.kind, m.entity))
        if new is None:
            continue
        out += [text[at:m.start], render(m, text[m.start:m.end], new)]
        at, n = m.end, n + 1
    return "".join([*out, text[at:]]), n
