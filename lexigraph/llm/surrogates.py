"""Keyed, type-consistent surrogates for personal data.

Detected: e-mail addresses, phone numbers (international, North American, and national ones that begin
with 0), IPv4 and IPv6 addresses, payment card numbers (13 to 19 digits with a valid check digit), IBANs,
US social security numbers, access keys, hexadecimal and assigned secrets, and persons: names that
follow titles, and known given names followed by a family name. In a text that names a
person so, every further occurrence of the name's parts, and known given names alone, are mentions too.
Given names are known from a list that the caller may extend.

Every mention has a kind and a canonical form that its
spellings share: the digits of a number, an address in lower case, each part of a name. A
surrogate is drawn from a keyed hash of kind and canonical form, so that equal entities get
equal surrogates in all documents and in every run with the same key, and is written in
the way the mention was: separators, letter case and lengths stay. Card numbers keep their
first digit and a valid check digit, phone numbers their country code, IBANs their country
and valid check digits; names keep gender and script. The gender of a given name that is not listed
is what all its titles in the corpus agree on; it is no part of the name's identity.

Distinctness is checked over all documents: two entities that draw the same surrogate, or a
surrogate that is itself an entity of the corpus, draw again until all differ. Only entities
that had to draw again, or got their gender from elsewhere in the corpus, are listed; texts are
rewritten in place from the key and this list.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, space, text_or_empty

#: Draws within the format; later draws lengthen what can be lengthened.
DRAWS = 16
#: Entities drawn again that are sent to every task; more of them are joined.
BROADCAST_REDRAWN = 200_000

# Titles by gender.
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "Sir", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mlle", "Doña", "Lady", "госпожа"],
    "n": ["Dr", "Prof", "Professor"],
}
# Given names by script and gender, for detection and as surrogates.
GIVEN = {
    ("latin", "m"): "James John Robert Michael David Thomas Daniel Peter Stefan Klaus Jürgen Wolfgang Pierre Jacques Antoine Julien Carlos Miguel Javier Pablo Sergio William Richard Joseph Christopher Andrew Hans Markus Andreas Luca Marco Giuseppe Paolo Ahmed Mohammed Omar Hassan Raj Arjun Wei Hiroshi Kenji Piotr Lars".split(),
    ("latin", "f"): "Mary Maria Patricia Jennifer Elizabeth Susan Sarah Anna Sabine Ursula Monika Heike Camille Isabelle Nathalie Sophie Carmen Lucía Elena Pilar Dolores Linda Barbara Karen Nancy Emily Laura Claudia Birgit Petra Marie Giulia Chiara Francesca Fatima Aisha Leila Priya Anjali Mei Yuki Keiko Agnieszka Ingrid Astrid".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Николай Михаил Павел Андрей".split(),
    ("cyrillic", "f"): "Мария Анна Елена Ольга Наталья Татьяна Ирина Светлана".split(),
}
# Syllables and endings of surrogate family names.
FAMILY = {
    "latin": ("ba be bo da de do fa ga ha ka la le lo ma me mo na no pa ra re ro sa ta te va wa".split(), "berg dorf field ford hart ley lund man mont nier rell ridge son stein ton wood".split()),
    "cyrillic": ("ба бо ва во га да до за ка ко ла ле ма мо на но па по ра ро са со та то".split(), "ров нев лин тин ков сов".split()),
}

TITLE_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
NAME_GENDER = {n: g for (_, g), names in GIVEN.items() for n in names}
#: Titles as they are looked up; most are also read in capitals.
TITLE_FORMS = TITLE_GENDER | {t.upper(): g for t, g in TITLE_GENDER.items() if t not in ("Don", "Miss", "Sir", "Lady")}
# Particles that may stand before a family name; they are no part of it.
PARTICLES = frozenset("von van der den de del della di da du la le zu".split())
# Country codes of two digits; 1 and 7 have one digit, the others three.
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)

EMAIL = re.compile(r"(?<![\w.+%-])[\w+%-]+(?:\.[\w+%-]+)*@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}")
IPV4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
SECRET = re.compile(r"(?<!\w)(?=[a-fA-F]*\d)(?=\d*[a-fA-F])[0-9a-fA-F]{24,}(?!\w)")
ACCESS_KEY = re.compile(r"(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)")
# What a password, token or key is introduced by.
ASSIGNED = ("password", "passwd", "pwd", "secret", "token", "api_key", "api-key", "apikey")
PASSWORD = re.compile(
    r"(?i)(?<![^\W_])(?:" + "|".join(ASSIGNED) + r")[\"']?[ \t]*[=:][ \t]*"
    r"(?:\"([^\"\n]{6,})\"|'([^'\n]{6,})'|[\"']?([^\s\"',;]{5,}[^\s\"',;.:!?)\]}>]))"
)
CARD = re.compile(r"(?<![\w+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
PHONE = re.compile(
    r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\w)"
    r"|(?<![\w+])(?:\(\d{3,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)|(?<![\w+])\+\d{9,15}(?!\w)"
    r"|(?<![\w+.,/-])0[1-9](?:[ .-]\d{2}){4}(?![\w-])|(?<![\w+.,/-])(?:0\d{1,4}|\(0\d{1,4}\))[ /-]\d{5,8}(?![\w-])"
)
IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
WORDS = re.compile(r"\w+")
NAME_WORDS = re.compile(r"[^\W\d_]+(?:['’-](?![sS]\b)[^\W\d_]+)*")
BETWEEN = re.compile(r"[ \t]+")
AFTER_TITLE = re.compile(r"\.?[ \t]+")


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = sum(n if k % 2 else sum(divmod(2 * n, 10)) for k, n in enumerate(map(int, reversed(digits))))
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[:1] <= "ӿ" else "latin" if word[:1] < "ɐ" else "other"


def country_code(digits: str) -> str:
    return digits[:1] if digits[:1] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def _capital(word: str) -> bool:
    return word[0].isupper() or script(word) == "other"


def _gender(word: str, names: Mapping[str, str]) -> str | None:
    """The gender of a given name, also of compounds and in capitals; None for other words."""
    if word in names:
        return names[word]
    parts = re.split("['’-]", word)
    if not all(p[0].isupper() for p in parts):
        return None
    return names.get(parts[0]) or (names.get(parts[0].title()) if len(parts[0]) > 1 and parts[0].isupper() else None)


def _given(word: str, gender: str) -> tuple[str, str]:
    return f"given:{script(word)}:{gender}", word.casefold()


def _family(word: str) -> tuple[str, str]:
    # Only in Cyrillic do family names differ by gender, and they show it themselves.
    low = word.casefold()
    return f"family:{script(word)}:{('f' if low[-1] in 'ая' else 'm') if script(word) == 'cyrillic' else 'n'}", low


def _names(text: str, names: Mapping[str, str]) -> Iterator[tuple[int, int, str, str]]:
    """The parts of persons' names: after titles, given names with a family name, then their parts anywhere."""
    seen = set(WORDS.findall(text))
    if seen.isdisjoint(TITLE_FORMS) and seen.isdisjoint(names) and not any(w.isupper() and w.title() in names for w in seen):
        return
    words = list(NAME_WORDS.finditer(text))
    persons: dict[str, tuple[str, str]] = {}

    def joined(k: int, gap: re.Pattern = BETWEEN) -> bool:
        """Whether word ``k`` follows the one before with nothing but ``gap`` between."""
        return k < len(words) and gap.fullmatch(text, words[k - 1].end(), words[k].start()) is not None

    k = 0
    while k < len(words):
        gender, at = None, k
        while at < len(words) and words[at][0] in TITLE_FORMS and joined(at + 1, AFTER_TITLE):
            gender = TITLE_FORMS[words[at][0]] if gender in (None, "n") else gender
            at += 1
        own = _gender(words[at][0], names)
        if not _capital(words[at][0]) or (gender is None and not own):
            k = max(k + 1, at)
            continue
        given, k = [at], at + 1
        # Further given names, then particles and one family name.
        while own and joined(k) and _gender(words[k][0], names):
            given.append(k)
            k += 1
        last = k
        while joined(last) and words[last][0] in PARTICLES:
            last += 1
        if joined(last) and _capital(words[last][0]):
            k = last + 1
            persons.setdefault(words[last][0].casefold(), _family(words[last][0]))
        elif len(given) > 1 or (gender is not None and not own):
            # The last name is the family's: two given names, or one unknown name after a title.
            word = words[given.pop()][0]
            persons.setdefault(word.casefold(), _family(word))
        elif gender is None:
            continue
        for g in given:
            word = words[g][0]
            persons.setdefault(word.casefold(), _given(word, _gender(word, names) or gender or "n"))
    if persons:
        for m in words:
            if _capital(m[0]):
                found = persons.get(m[0].casefold())
                if found is None and (gender := _gender(m[0], names)):
                    found = _given(m[0], gender)
                if found:
                    yield *m.span(), *found


def mentions(text: str, names: Mapping[str, str] = NAME_GENDER) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical)`` in order, none overlapping; earlier patterns win."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(*m.span(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if re.search(r"\d", text):
        for kind, pattern in (("ipv4", IPV4), ("iban", IBAN), ("secret", SECRET), ("key", ACCESS_KEY), ("card", CARD), ("ssn", SSN), ("phone", PHONE)):
            for m in pattern.finditer(text):
                plain = re.sub(r"[^0-9A-Za-z]", "", m[0])
                if kind == "ipv4":
                    plain = m[0]
                elif kind in ("secret", "key"):
                    plain = m[0].lower() if kind == "secret" else m[0]
                elif kind == "iban" and iban_check(plain[:2], plain[4:]) != plain[2:4]:
                    continue
                elif kind == "card" and luhn(plain[:-1]) != int(plain[-1]):
                    continue  # time stamps, counters, groups of years
                elif kind == "phone" and len(plain) < 9:
                    continue
                elif kind == "phone" and m[0][0] == "+":
                    whole = m[0]
                    while len(plain) > 15:  # a number of its own follows
                        whole = re.sub(r"[ .-]?\(?\d+\)?$", "", whole)
                        plain = re.sub(r"\D", "", whole)
                    if len(plain) >= 9:
                        found.append((m.start(), m.start() + len(whole), f"phone+{country_code(plain)}", plain))
                    continue
                found.append((*m.span(), kind, plain))
    if "::" in text or text.count(":") > 6:
        for m in IPV6.finditer(text):
            # A scope operator between short words is no address.
            if re.search(r"\d", m[0]) and m[0].count(":") > 2 - ("::" in m[0]) and len(m[0]) > 6:
                try:
                    found.append((*m.span(), "ipv6", str(ipaddress.IPv6Address(m[0]))))
                except ValueError:
                    pass
    low = text.lower()
    if any(word in low for word in ASSIGNED):
        found += [(*m.span(m.lastindex), "password", m[m.lastindex]) for m in PASSWORD.finditer(text)]
    found += _names(text, names)
    kept: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for one in found:
        if not any(one[0] < b and a < one[1] for a, b in taken):
            kept.append(one)
            taken.append(one[:2])
    return sorted(kept)


class Stream:
    """Numbers below a bound, drawn from a keyed hash."""

    def __init__(self, key: bytes, *parts: str | int):
        seed = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
        if len(key) > hashlib.blake2b.MAX_KEY_SIZE:
            key = hashlib.blake2b(key).digest()
        self.seed = hashlib.blake2b(seed, key=key, digest_size=64).digest()
        self.value = int.from_bytes(self.seed, "big")
        self.left, self.turn = 1 << 512, 0

    def below(self, n: int) -> int:
        if self.left < n << 64:
            self.turn += 1
            self.value = int.from_bytes(hashlib.blake2b(self.seed + self.turn.to_bytes(8, "big"), digest_size=64).digest(), "big")
            self.left = 1 << 512
        self.value, drawn = divmod(self.value, n)
        self.left //= n
        return drawn

    def like(self, text: str, hexadecimal: bool = False) -> str:
        letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
        out = []
        for c in text:
            drawn = str(self.below(10)) if c.isdecimal() else letters[self.below(len(letters))] if c.isalpha() else c
            out.append(drawn.upper() if c.isupper() else drawn)
        return "".join(out)


def identity(kind: str) -> str:
    """The kind without the gender."""
    return kind.rpartition(":")[0] if kind.startswith("given:") else kind


@lru_cache(100_000)
def surrogate(key: bytes, kind: str, canonical: str, draw: int) -> str:
    """The canonical form of an entity's surrogate at its ``draw``-th draw, never itself."""
    more = max(0, draw - DRAWS + 1)
    for again in range(64):
        # The gender of a name picks from what is drawn; it is no part of the draw.
        made = _draw(Stream(key, identity(kind), canonical, draw, again), key, kind, canonical, more)
        if made != canonical:
            break
    return made


def _draw(stream: Stream, key: bytes, kind: str, text: str, more: int) -> str:
    family, _, rest = kind.partition(":")
    if kind == "email":
        local, _, domain = text.rpartition("@")
        labels = domain.split(".")
        # The same domain has the same surrogate in all its addresses.
        host = Stream(key, "domain", domain).like(".".join(labels[:-1]))
        return stream.like(local + "a" * more) + "@" + host + "." + labels[-1]
    if kind == "ipv4":
        spans = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        octets = [(0, 256) if more else spans[len(x)] for x in text.split(".")]
        return ".".join(str(a + stream.below(n)) for a, n in octets)
    if kind == "ipv6":
        groups = stream.like(text if not more else str(ipaddress.IPv6Address(stream.value % (1 << 128))), hexadecimal=True)
        return str(ipaddress.IPv6Address(groups))
    if kind == "iban":
        body = "".join(stream.like(c).upper() for c in text[4:] + "0" * more)
        return text[:2] + iban_check(text[:2], body) + body
    if kind == "secret":
        return stream.like(text + "a" * more, hexadecimal=True)
    if kind == "key":
        return text[:4] + stream.like(text[4:] + "A" * more)
    if kind == "card":
        body = text[0] + stream.like(text[1:-1] + "0" * more)
        return body + (str(luhn(body)) if luhn(text[:-1]) == int(text[-1]) else stream.like("0"))
    if kind.startswith("phone+"):
        code = len(kind) - 6
        return text[:code] + stream.like(text[code:] + "0" * more)
    if family in ("given", "family"):
        alphabet, gender = rest.split(":")
        if alphabet == "other":
            return "".join(chr(ord(c) // 32 * 32 + stream.below(32)) if c.isalpha() else c for c in text) + "".join(text[:1] for _ in range(more))
        if family == "given":
            names = GIVEN[alphabet, gender] if gender != "n" else [n for g in "mf" for n in GIVEN[alphabet, g]]
            name = names[stream.below(len(names))].casefold()
            # Names beyond the list are compounds, which keep gender and script.
            for _ in range((stream.below(2) if len(text) > 6 else 0) + more):
                name += "-" + names[stream.below(len(names))].casefold()
            return name
        syllables, endings = FAMILY[alphabet]
        name = "".join(syllables[stream.below(len(syllables))] for _ in range(2 + more)) + endings[stream.below(len(endings))]
        return name + ("а" if alphabet == "cyrillic" and gender == "f" else "")
    return stream.like(text + "0" * more)


def written(kind: str, surface: str, made: str) -> str:
    """A surrogate in the spelling of its mention: separators and letter case stay."""
    if kind.startswith(("given", "family")):
        if len(surface) > 1 and surface.isupper():
            return made.upper()
        return "-".join(p[:1].upper() + p[1:] for p in made.split("-"))
    if kind in ("key", "password"):
        return made
    if kind == "ipv6":
        made = ipaddress.IPv6Address(made).exploded if len(surface) == 39 else made
        return made.upper() if any(c.isupper() for c in surface) else made
    if kind in ("email", "ipv4"):
        upper = surface.isupper()
        if upper or len(made) != len(surface):
            return made.upper() if upper else made
        return "".join(m.upper() if s.isupper() else m for s, m in zip(surface, made))
    out, left = [], list(made)
    for c in surface:
        if not c.isalnum():
            out.append(c)
        elif left:
            m = left.pop(0)
            # A hexadecimal secret is of one case throughout.
            out.append(m)
    text = "".join(out) + "".join(left)
    if kind == "secret":
        return text.upper() if any(c.isupper() for c in surface) else text
    return text


def rewrite(
    text: str, key: bytes, listed: Mapping[tuple[str, str], tuple[str, int]], names: Mapping[str, str] = NAME_GENDER
) -> tuple[str, list[str]]:
    """The text with all mentions replaced, and their kinds.

    ``listed`` gives the kind and draw of entities by identity and canonical form, where they are not
    the mention's kind and the first draw.
    """
    out, at, kinds = [], 0, []
    for start, end, kind, canonical in mentions(text, names):
        kind, draw = listed.get((identity(kind), canonical), (kind, 0))
        made = surrogate(key, kind, canonical, draw)
        out += [text[at:start], written(kind, text[start:end], made)]
        at = end
        kinds.append(re.split("[:+]", kind)[0])
    return "".join(out) + text[at:], kinds


def found_in(docs: DataFrame, names: Mapping[str, str] = NAME_GENDER) -> DataFrame:
    """``text_key, kind, canonical``: the entities of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            columns = ([], [], [])
            for key, text in zip(rows.column("text_key").to_pylist(), rows.column("text").to_pylist()):
                for kind, canonical in {m[2:] for m in mentions(text, names)}:
                    for column, value in zip(columns, (key, kind, canonical)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["text_key", "kind", "canonical"],
            )

    return docs.select("text_key", "text").mapInArrow(run, "text_key BINARY, kind STRING, canonical STRING")


def redraws(entities: DataFrame, key: bytes, work) -> DataFrame:
    """``kind, canonical, draw`` of the entities that need another draw than the first.

    ``entities`` are distinct. In each round the entities left draw; a draw stands if it is no
    entity of its kind, has not been drawn before, and no smaller entity draws it too.
    """

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, canonical: pd.Series, draw: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, c, d) for k, c, d in zip(kind, canonical, draw)], dtype=object)

    # Kinds whose surrogates might be mistaken for one another share one space.
    group = F.split("kind", "[:+]")[0]
    real = entities.select(group.alias("group"), F.col("canonical").alias("made")).distinct()
    left, settled, moved, draw = entities, None, None, 0
    while True:
        tried = left.withColumn("group", group).withColumn("made", drawn("kind", "canonical", F.lit(draw)))
        place = F.row_number().over(Window.partitionBy("group", "made").orderBy("canonical", "kind"))
        tried = work.write(tried.withColumn("place", place), "tried")
        clear = tried.filter("place = 1").join(real, ["group", "made"], "left_anti")
        if settled is not None:
            clear = clear.join(settled, ["group", "made"], "left_anti")
        clear = work.write(clear.select("group", "made", "kind", "canonical"), "clear")
        if draw:
            now = clear.select("kind", "canonical", F.lit(draw).alias("draw"))
            moved = now if moved is None else moved.union(now)
        used = clear.select("group", "made")
        settled = used if settled is None else settled.union(used)
        left = work.write(left.join(clear, ["kind", "canonical"], "left_anti"), "left")
        draw += 1
        if left.isEmpty():
            break
    empty = entities.select("kind", "canonical", F.lit(0).alias("draw")).filter("false")
    return empty if moved is None else moved


def resolved(found: DataFrame) -> DataFrame:
    """``identity, canonical, kind, several``: each entity once, with the gender its mentions agree on.

    ``several`` says that not all mentions are of that kind. Contradicting genders leave it open.
    """
    gender = F.when(F.col("kind").startswith("given:"), F.substring_index("kind", ":", -1))
    name = F.when(gender.isNotNull(), F.expr("left(kind, length(kind) - 2)")).otherwise(F.col("kind"))
    counted = found.groupBy(name.alias("identity"), "canonical").agg(
        F.max(gender == "m").alias("m"), F.max(gender == "f").alias("f"), F.min("kind").alias("low"), F.max("kind").alias("high")
    )
    agreed = F.when(F.col("m") == F.col("f"), "n").when(F.col("m"), "m").otherwise("f")
    kind = F.when(F.col("m").isNull(), F.col("identity")).otherwise(F.concat("identity", F.lit(":"), agreed))
    return counted.select("identity", "canonical", kind.alias("kind"), (F.col("low") != F.col("high")).alias("several"))


def replace_entities(docs: DataFrame, key: bytes, names: Mapping[str, str] | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``entities`` (count) and ``kinds`` (array, in order) added.

    ``names`` are further given names with their gender (``m``, ``f`` or ``n``). Keys may have any length.
    Null texts stay null and have no entities. Repeated rows are rewritten alike. Other columns stay as
    they are; columns named ``entities`` or ``kinds`` are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = space(spark, "surrogates")
    names = NAME_GENDER | dict(names or {})
    own = [c for c in docs.columns if c not in ("entities", "kinds")]
    rest = [c for c in own if c != "text"]
    keyed = docs.select(F.md5(text_or_empty()).cast("binary").alias("text_key"), text_or_empty().alias("text"))
    found = work.write(found_in(keyed, names), "found")
    known = work.write(resolved(found), "entities")
    moved = redraws(known.select("kind", "canonical"), key, work)
    # Entities that a text alone would not replace as the whole corpus does.
    listed = work.write(
        known.join(moved, ["kind", "canonical"], "left").filter("several OR draw IS NOT NULL")
        .select("identity", "canonical", "kind", F.coalesce("draw", F.lit(0)).alias("draw")),
        "listed",
    )
    rows = docs.select(F.struct(*rest).alias("__row"), F.col("text").alias("__text"))
    given = "array<struct<identity:string,canonical:string,kind:string,draw:int>>"
    if listed.count() <= BROADCAST_REDRAWN:
        shared = spark.sparkContext.broadcast({(r["identity"], r["canonical"]): (r["kind"], r["draw"]) for r in listed.collect()})
        rows = rows.withColumn("__moved", F.lit(None).cast(given))
    else:
        shared = spark.sparkContext.broadcast({})
        name = F.when(F.col("kind").startswith("given:"), F.expr("left(kind, length(kind) - 2)")).otherwise(F.col("kind"))
        mentioned = found.select("text_key", name.alias("identity"), "canonical")
        mine = mentioned.join(listed, ["identity", "canonical"]).groupBy("text_key").agg(
            F.collect_set(F.struct("identity", "canonical", "kind", "draw")).alias("__moved")
        )
        rows = rows.withColumn("text_key", F.md5(F.coalesce("__text", F.lit(""))).cast("binary")).join(mine, "text_key", "left")

    @F.pandas_udf("text string, kinds array<string>")
    def rewritten(texts: pd.Series, moves: pd.Series) -> pd.DataFrame:
        out = []
        for text, move in zip(texts, moves):
            mine = shared.value if move is None else {(m["identity"], m["canonical"]): (m["kind"], m["draw"]) for m in move}
            out.append((None, []) if text is None else rewrite(text, key, mine, names))
        return pd.DataFrame(out, columns=["text", "kinds"])

    done = rows.withColumn("__done", rewritten("__text", "__moved"))
    order = [F.col("__done.text").alias("text") if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in own]
    return done.select(*order, F.size("__done.kinds").alias("entities"), F.col("__done.kinds").alias("kinds"))
