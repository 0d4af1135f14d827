"""Porter's suffix stripping in built-in SQL expressions: the 1980 rules, or with the
extensions that a widely used language toolkit applies by default.

Each step maps a word ``w`` to a word. ``stem_array`` runs the steps over an array, one
``transform`` per step: no step repeats the expression of the one before it, and no Python
worker is started. (The same steps as projections over exploded words compile to methods
too large for the JIT and ran three times slower.) Whole corpora are stemmed by ``stem``, the
same rules for one word: Arrow batches of text meet each distinct word once
(``operators/analyze.py``), where an array's steps run for every occurrence.
"""

from __future__ import annotations

import re
from functools import lru_cache

# A word is [C](VC)^m[V]; y is a vowel after a consonant.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
M_POSITIVE = f"^(?:{_C})?{_V}{_C}"
M_ONE = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
M_ABOVE_ONE = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^(?:{_C})?{_V}"
SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"
DOUBLE_END = "(?:bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"

# The published rule tables, in the published order.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
EXTENDED_STEP_2 = tuple(r for r in STEP_2 if r[0] != "abli") + (("bli", "ble"), ("fulli", "ful"))
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# The words the extensions look up instead of stemming.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def _chop(n: int) -> str:
    return f"left(w, char_length(w) - {n})"


def _ends(suffix: str) -> str:
    return f"endswith(w, '{suffix}')"


def _like(text: str, pattern: str) -> str:
    return f"rlike({text}, '{pattern}')"


def _case(*branches: tuple[str, str]) -> str:
    """The value of the first condition that holds, else the word itself."""
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE w END"


def _first_match(rules, condition: str) -> str:
    """Apply the longest suffix that matches; if its stem fails the condition, stop.

    Rules are tried under their last letter, so most words see only a few of them.
    """
    by_letter: dict[str, list] = {}
    for suffix, replacement in sorted(rules, key=lambda r: -len(r[0])):
        stem = _chop(len(suffix))
        hit = f"({_ends('sion')} OR {_ends('tion')})" if suffix == "ion" else _ends(suffix)
        new = f"concat({stem}, '{replacement}')"
        by_letter.setdefault(suffix[-1], []).append((hit, _case((_like(stem, condition), new))))
    return _case(*((_ends(letter), _case(*group)) for letter, group in by_letter.items()))


_E = f"concat({_chop(1)}, 'e')"

# The 1980 rules.
STEPS = (
    # 1a: plurals
    _case(
        (f"NOT {_ends('s')} OR {_ends('ss')}", "w"),
        (f"{_ends('sses')} OR {_ends('ies')}", _chop(2)),
        ("true", _chop(1)),
    ),
    # 1b: -ed and -ing; a trailing bar marks the words the next step has to repair
    _case(
        (_ends("eed"), _case((_like(_chop(3), M_POSITIVE), _chop(1)))),
        (_ends("ed"), _case((_like(_chop(2), HAS_VOWEL), f"concat({_chop(2)}, '|')"))),
        (_ends("ing"), _case((_like(_chop(3), HAS_VOWEL), f"concat({_chop(3)}, '|')"))),
    ),
    _case(
        (f"NOT {_ends('|')}", "w"),
        (_like(_chop(1), "(?:at|bl|iz)$"), _E),
        (_like(_chop(1), DOUBLE_END), _chop(2)),
        (_like(_chop(1), SHORT_END), _E),
        ("true", _chop(1)),
    ),
    # 1c: final y
    _case((f"{_ends('y')} AND {_like(_chop(1), HAS_VOWEL)}", f"concat({_chop(1)}, 'i')")),
    _first_match(STEP_2, M_POSITIVE),
    _first_match(STEP_3, M_POSITIVE),
    _first_match([(s, "") for s in STEP_4], M_ABOVE_ONE),
    # 5a: final e
    _case(
        (f"NOT {_ends('e')}", "w"),
        (_like(_chop(1), M_ABOVE_ONE), _chop(1)),
        (f"{_like(_chop(1), M_ONE)} AND NOT {_like(_chop(1), SHORT_END)}", _chop(1)),
    ),
    # 5b: final ll
    _case((f"{_ends('ll')} AND {_like(_chop(1), M_ABOVE_ONE)}", _chop(1))),
)

_EXTENDED_SHORT_END = f"(?:{SHORT_END}|^[aeiou][^aeiou]$)"

# With the extensions: four-letter -ies and -ied keep their e, y stays after a vowel or a
# single letter, -alli is taken off before the table is read, -logi loses its i, and a
# vowel and a consonant alone count as a short end.
EXTENDED_STEPS = (
    _case((f"{_ends('ies')} AND char_length(w) = 4", _chop(1)), ("true", STEPS[0])),
    _case(
        (f"{_ends('ied')} AND char_length(w) = 4", _chop(1)),
        (_ends("ied"), _chop(2)),
        ("true", STEPS[1]),
    ),
    STEPS[2].replace(SHORT_END, _EXTENDED_SHORT_END),
    _case((_like("w", ".(?:[^aeiouy]|[aeiou]y)y$"), f"concat({_chop(1)}, 'i')")),
    _case((f"{_ends('alli')} AND {_like(_chop(4), M_POSITIVE)}", _chop(2))),
    _case(
        (_ends("logi"), _case((_like(_chop(3), M_POSITIVE), _chop(1)))),
        ("true", _first_match(EXTENDED_STEP_2, M_POSITIVE)),
    ),
    STEPS[5],
    STEPS[6],
    STEPS[7].replace(SHORT_END, _EXTENDED_SHORT_END),
    STEPS[8],
)

# Ends words that are not to be stemmed, so that no rule matches them.
_KEEP = "."


def stem_array(words: str, has_short: bool = True, extended: bool = False) -> str:
    """Stem each word of an array; words under three letters stay.

    Pass ``has_short=False`` when every word is known to have three letters or more.
    """
    kept = []
    if has_short:
        kept.append(("char_length(w) < 3", f"concat(w, '{_KEEP}')"))
    if extended:
        known: dict[str, list[str]] = {}
        for word, stem in IRREGULAR.items():
            known.setdefault(stem, []).append(f"'{word}'")
        kept += [(f"w IN ({', '.join(ws)})", f"'{stem}{_KEEP}'") for stem, ws in known.items()]
    out = f"transform({words}, w -> {_case(*kept)})" if kept else words
    for step in EXTENDED_STEPS if extended else STEPS:
        out = f"transform({out}, w -> {step})"
    return f"transform({out}, w -> {_case((_ends(_KEEP), _chop(1)))})" if kept else out


# The same rules for one word at a time.


def _rules(rules, condition: str):
    """One step: the longest suffix that matches decides, as in ``_first_match``."""
    by_letter: dict[str, list] = {}
    for suffix, replacement in sorted(rules, key=lambda r: -len(r[0])):
        by_letter.setdefault(suffix[-1], []).append((("sion", "tion") if suffix == "ion" else suffix, len(suffix), replacement))
    holds = re.compile(condition).search

    def step(w: str) -> str:
        for suffix, n, replacement in by_letter.get(w[-1:], ()):
            if w.endswith(suffix):
                return w[:-n] + replacement if holds(w[:-n]) else w
        return w

    return step


_step_2, _extended_step_2 = _rules(STEP_2, M_POSITIVE), _rules(EXTENDED_STEP_2, M_POSITIVE)
_step_3, _step_4 = _rules(STEP_3, M_POSITIVE), _rules([(s, "") for s in STEP_4], M_ABOVE_ONE)
_positive, _one, _above_one = (re.compile(p).search for p in (M_POSITIVE, M_ONE, M_ABOVE_ONE))
_vowel, _double = re.compile(HAS_VOWEL).search, re.compile(DOUBLE_END).search
_short, _extended_short = re.compile(SHORT_END).search, re.compile(_EXTENDED_SHORT_END).search
_long_y = re.compile(".(?:[^aeiouy]|[aeiou]y)y$").search


def _plural(w: str) -> str:
    if not w.endswith("s") or w.endswith("ss"):
        return w
    return w[:-2] if w.endswith(("sses", "ies")) else w[:-1]


def _participle(w: str, short) -> str:
    """Steps 1b: -eed, or -ed and -ing with the repair of what is left."""
    if w.endswith("eed"):
        return w[:-1] if _positive(w[:-3]) else w
    if w.endswith("ed") and _vowel(w[:-2]):
        w = w[:-2]
    elif w.endswith("ing") and not w.endswith("ed") and _vowel(w[:-3]):
        w = w[:-3]
    else:
        return w
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _double(w):
        return w[:-1]
    return w + "e" if short(w) else w


def _endings(w: str, short) -> str:
    """Steps 3 to 5."""
    w = _step_4(_step_3(w))
    if w.endswith("e"):
        stem = w[:-1]
        if _above_one(stem) or _one(stem) and not short(stem):
            w = stem
    return w[:-1] if w.endswith("ll") and _above_one(w[:-1]) else w


def _stem(w: str) -> str:
    w = _participle(_plural(w), _short)
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    return _endings(_step_2(w), _short)


def _stem_extended(w: str) -> str:
    if w in IRREGULAR:
        return IRREGULAR[w]
    w = w[:-1] if w.endswith("ies") and len(w) == 4 else _plural(w)
    if w.endswith("ied"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    else:
        w = _participle(w, _extended_short)
    if _long_y(w):
        w = w[:-1] + "i"
    if w.endswith("alli") and _positive(w[:-4]):
        w = w[:-2]
    if w.endswith("logi"):
        w = w[:-1] if _positive(w[:-3]) else w
    else:
        w = _extended_step_2(w)
    return _endings(w, _extended_short)


#: The last letters of words that a rule may change, as a pattern.
STEMMED_END = f"[{''.join(sorted({*'sdgyel', *(r[0][-1] for r in (*STEP_2, *EXTENDED_STEP_2, *STEP_3)), *(x[-1] for x in STEP_4)}))}]$"


# Only so many words are remembered in a worker.
@lru_cache(200_000)
def stem(word: str, extended: bool = False) -> str:
    """What ``stem_array`` makes of one word; words under three letters stay."""
    if len(word) < 3:
        return word
    return _stem_extended(word) if extended else _stem(word)
