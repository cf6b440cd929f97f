"""The Portuguese Snowball stemmer (L2), from its published description.

A stem depends on the word alone, so it is computed once per distinct word and
worker process and looked up after that."""

from __future__ import annotations

import functools

VOWELS = frozenset("aeiouáéíóúâêô")

# FIXED: the suffixes of the published algorithm. ã and õ are written a~ and o~.
STANDARD = (
    "eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos "
    "imento imentos adora ador aça~o adoras adores aço~es ante antes ância").split()
LOGIA = "logia logias".split()
UCAO = "uça~o uço~es".split()
ENCIA = "ência ências".split()
IDADE = "idade idades".split()
IVO = "iva ivo ivas ivos".split()
IRA = "ira iras".split()
VERB = (
    "ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei "
    "irei am iam ariam eriam iriam aram eram iram avam em arem erem irem assem essem issem ado ido "
    "ando endo indo ara~o era~o ira~o ar er ir as adas idas ias arias erias irias arás aras erás eras "
    "irás avas es ardes erdes irdes ares eres ires asses esses isses astes estes istes is ais eis íeis "
    "aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos "
    "ámos amos íamos aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos eremos iremos "
    "ássemos êssemos íssemos imos armos ermos irmos eu iu ou ira iras").split()
RESIDUAL = "os a i o á í ó".split()

_KIND = {s: kind for kind, group in (
    ("delete", STANDARD), ("logia", LOGIA), ("ução", UCAO), ("ência", ENCIA), ("idade", IDADE),
    ("ivo", IVO), ("ira", IRA), ("amente", ["amente"]), ("mente", ["mente"])) for s in group}


def _longest(word: str, suffixes, start: int = 0) -> str | None:
    """The longest of ``suffixes`` that ends ``word`` and begins at ``start`` or later."""
    return max((s for s in suffixes if word.endswith(s) and len(word) - len(s) >= start),
               key=len, default=None)


def _after_vowel_consonant(word: str, start: int) -> int:
    """The place after the first non-vowel that follows a vowel from ``start`` on."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _rv(word: str) -> int:
    """Where the verb region begins."""
    if len(word) < 3:
        return len(word)
    if word[1] not in VOWELS:
        wanted = VOWELS.__contains__       # after the next vowel
    elif word[0] in VOWELS:
        wanted = lambda c: c not in VOWELS  # noqa: E731 - after the next consonant
    else:
        return 3
    return next((i + 1 for i in range(2, len(word)) if wanted(word[i])), len(word))


def _standard(word: str, r1: int, r2: int, rv: int) -> str:
    suffix = _longest(word, _KIND)
    if suffix is None:
        return word
    kind, at = _KIND[suffix], len(word) - len(suffix)
    base = word[:at]

    def also(*before: str) -> str:
        """``base`` without one of ``before`` if that lies in R2."""
        s = _longest(base, before, r2)
        return base[:-len(s)] if s else base

    if kind == "ira":
        return base + "ir" if at >= rv and base.endswith("e") else word
    if kind == "amente":
        if at < r1:
            return word
        if base.endswith("iv") and len(base) - 2 >= r2:
            base = base[:-2]
            return also("at")
        return also("os", "ic", "ad")
    if at < r2:
        return word
    return {"delete": lambda: base, "logia": lambda: base + "log", "ução": lambda: base + "u",
            "ência": lambda: base + "ente", "mente": lambda: also("ante", "avel", "ível"),
            "idade": lambda: also("abil", "ic", "iv"), "ivo": lambda: also("at")}[kind]()


@functools.lru_cache(maxsize=200_000)
def portuguese(word: str) -> str:
    """The stem of a lower-cased word; words with other characters than letters
    come back as they are."""
    if not word.isalpha():
        return word
    word = word.replace("ã", "a~").replace("õ", "o~")
    r1 = _after_vowel_consonant(word, 0)
    r2 = _after_vowel_consonant(word, r1)
    rv = _rv(word)
    stem = _standard(word, r1, r2, rv)
    if stem == word:
        suffix = _longest(word, VERB, rv)
        stem = word[:-len(suffix)] if suffix else word
    if stem != word:
        if stem.endswith("ci") and len(stem) - 1 >= rv:
            stem = stem[:-1]
    else:
        suffix = _longest(word, RESIDUAL, rv)
        stem = word[:-len(suffix)] if suffix else word
    if stem[-1:] in ("e", "é", "ê") and len(stem) - 1 >= rv:
        stem = stem[:-1]
        if (stem.endswith("gu") or stem.endswith("ci")) and len(stem) - 1 >= rv:
            stem = stem[:-1]
    elif stem.endswith("ç"):
        stem = stem[:-1] + "c"
    return stem.replace("a~", "ã").replace("o~", "õ")
