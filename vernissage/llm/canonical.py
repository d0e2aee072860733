"""One consistent form for text that only looks like the usual characters.

A transducer is compiled once from one precomputed mapping: widths, ligatures
and styled letters, unusual blanks, decomposed accents (a base and its marks,
also with invisible characters between them, are one longest match), and the
look-alike letters of other scripts. The mapping is checked for conflicts: two
outputs for one input, an output that would be changed again, two ways back.

A text is read once. Grapheme clusters that are in the mapping are replaced by
the longest match. What a look-alike letter becomes depends on the word it
stands in, which is the transducer's state: a word is held back until its end,
and a word of look-alikes only until the next word that is surely in one script.

Left alone: composed accents, typographic quotes, dashes and ellipses, ASCII
blanks, emoji sequences and words truly in another script.

Defined cases: null gives null, the empty text itself; repeated rows, ties and
extra columns do not matter, since each text is mapped on its own.
"""

from __future__ import annotations

import re
import unicodedata as U
from collections.abc import Iterable
from functools import cache, lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.session import spread

#: Letters of other scripts and the Latin letters they look like.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХУаеѕіјорсухԁһԛԝ", "ABESIJKMHOPCTXYaesijopcyxdhqw", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοαικρτυχ", "ABEZHIKMNOPTYXvoaikptux", strict=True))
#: Cyrillic letters of few languages, which never bring a word of Latin look to Cyrillic.
CYRILLIC_RARE = dict(zip("ѵӏӀԌԚԜүҮ", "vlIGQWyY", strict=True))
ARMENIAN = dict(zip("ոօսհյցՕՍՏ", "nouhjgOUS", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiyAJEWMHYGhZbRWSVSLCPKdGB", strict=True))
LISU = dict(zip("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
#: Greek small letters that are only look-alikes beside Latin letters, never on their own.
_WEAK_GREEK = set("αικρτυχ")


@cache
def phonetic() -> dict[str, str]:
    """Latin letters of phonetic alphabets that look like plain ones: small capitals and two round letters."""
    out = {"ɑ": "a", "ɡ": "g"}
    for cp in (*range(0x250, 0x2B0), *range(0x1D00, 0x1D2C), *range(0xA730, 0xA732)):
        name = U.name(chr(cp), "").removeprefix("LATIN LETTER SMALL CAPITAL ")
        if len(name) == 1:
            out[chr(cp)] = name.lower()
    return out


#: Characters that print nothing. Joiners and selectors inside emoji, and joiners in scripts
#: that need them, are left alone (see ``_LEGITIMATE``).
_INVISIBLE = r"\p{Cf}\uFE00-\uFE0F\U000E0100-\U000E01EF\u034F\u115F\u1160\u17B4\u17B5\u3164\uFFA0\u0000"
_HIDDEN = regex.compile(rf"[{_INVISIBLE}]+")
_EMOJI = r"\p{Extended_Pictographic}"
_LEGITIMATE = rf"(?:{_EMOJI}\p{{EMod}}?\uFE0F?(?:\u200D{_EMOJI}\p{{EMod}}?\uFE0F?)*|[0-9#*]\uFE0F\u20E3|[\p{{Arab}}\p{{Deva}}\p{{Beng}}\p{{Taml}}\p{{Telu}}\p{{Knda}}\p{{Mlym}}\p{{Sinh}}]\p{{M}}*[\u200C\u200D](?=[\p{{L}}\p{{M}}]))"

_TAGS = ("<wide>", "<narrow>", "<font>", "<compat>")
#: Compatibility characters whose look is their own.
_OWN_LOOK = set("№…\u2025\u2024ªº™℠µ")


@cache
def character_map() -> dict[str, str]:
    """Single characters and what they look like, from Unicode's decompositions."""
    out: dict[str, str] = {}
    for cp in range(0x80, 0x30000):
        ch = chr(cp)
        cat = U.category(ch)
        if cat in ("Cn", "Co", "Cs") or ch in _OWN_LOOK:
            continue
        if cat in ("Zs", "Zl", "Zp") or ch == "\x85":
            out[ch] = "\n" if cat in ("Zl", "Zp") or ch == "\x85" else " "
            continue
        tag = U.decomposition(ch).split(" ")[0]
        if tag in _TAGS:
            to = U.normalize("NFKC", ch)
            if tag == "<compat>" and not (to.isalpha() and cat in ("Ll", "Lu", "Lt", "Lo", "Nl", "So")):
                continue
            if to != ch and " " not in to:
                out[ch] = to
        elif U.normalize("NFC", ch) != ch:
            out[ch] = U.normalize("NFC", ch)
    return out


#: Scripts whose letters look like Latin ones, by a letter for the state of a word.
LOOKS = {"C": {**CYRILLIC, **CYRILLIC_RARE}, "G": GREEK, "A": ARMENIAN, "H": CHEROKEE, "U": LISU}
_SCRIPTS = {"C": "Cyrillic", "G": "Greek", "A": "Armenian", "H": "Cherokee", "U": "Lisu"}


def _char_class(chars: Iterable[str]) -> str:
    """A character class of ranges."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in ranges) + "]"


def _mapped(word: str, to: dict[str, str]) -> str:
    return U.normalize("NFC", "".join(to.get(c, c) for c in U.normalize("NFD", word)))


class Transducer:
    """Longest-match rewriting of clusters and words by one conflict-checked mapping."""

    def __init__(self, singles: dict[str, str], looks: dict[str, dict[str, str]], phonetics: dict[str, str]):
        self.singles = singles
        self.to_latin = {k: v for table in (phonetics, *looks.values()) for k, v in table.items()}
        # Ways back, for Latin letters within words of another script.
        self.back = {
            "C": {v: k for k, v in CYRILLIC.items() if k not in "ѕіјЅІЈԁһԛԝ"},
            "G": {v: k for k, v in GREEK.items() if k not in _WEAK_GREEK},
        }
        self.check(singles, looks, phonetics)
        self.latin_like = frozenset(self.back["C"])
        for own, other in (("C", "G"), ("G", "C")):
            self.back[own] |= {f: self.back[own][latin] for f, latin in looks[other].items() if latin in self.back[own] and f not in CYRILLIC_RARE}
        self.looks, self.phonetics = looks, phonetics
        # All planes that have characters of these kinds.
        planes = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE1000))))
        hidden = regex.findall(rf"[{_INVISIBLE}]", planes)
        marks = [chr(c) for c in range(0x300, 0x1F000) if U.category(chr(c))[0] == "M"]
        #: Places where a match may begin, or the one before: everything else is copied.
        self.trigger = re.compile(_char_class({*singles, *hidden, *marks}))
        self.modifier = regex.compile(r"\p{EMod}")
        # The longest match: a legitimate sequence, then a cluster with its marks, then invisible
        # characters, then one character.
        self.longest = regex.compile(rf"({_LEGITIMATE})|([^\p{{M}}\s][{_INVISIBLE}]*(?:\p{{M}}[{_INVISIBLE}]*)+)|([{_INVISIBLE}]+)|(.)", regex.S)
        self.cjk = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\u3001-\u303F]")
        self.script = {k: regex.compile(rf"\p{{Script={v}}}") for k, v in _SCRIPTS.items()}
        self.latin = regex.compile(r"\p{Script=Latin}")
        foreign = "".join(rf"\p{{Script={s}}}" for s in _SCRIPTS.values())
        self.foreign = regex.compile(rf"[{foreign}\u0250-\u02AF\u1D00-\u1D2B\uA730\uA731]")
        lettered = "".join(regex.escape(k) for k, v in singles.items() if v.isalpha() and not k.isalpha())
        letter = rf"[\p{{L}}{lettered}]"
        self.words = regex.compile(rf"{letter}[\p{{L}}\p{{M}}{lettered}{_INVISIBLE}]*(?:['’]{letter}[\p{{L}}\p{{M}}{lettered}{_INVISIBLE}]*)*")
        self.word = lru_cache(1 << 16)(self._word)

    def check(self, singles: dict[str, str], looks: dict[str, dict[str, str]], phonetics: dict[str, str]) -> None:
        """Raises for two outputs of one input, an output that is changed again, and two ways back."""
        tables = [singles, phonetics, *looks.values()]
        sources: set[str] = set()
        for table in tables:
            for source, target in table.items():
                if source in sources:
                    raise ValueError(f"{source!r} has two outputs, one of them {target!r}")
                sources.add(source)
        for table in tables:
            for source, target in table.items():
                # Phonetic and foreign letters an output keeps are a matter of its word.
                again = [c for c in target if c in singles or (table is not singles and c in sources)]
                if again:
                    raise ValueError(f"{source!r} → {target!r} would be changed again")
        for back in (CYRILLIC, GREEK):
            if len(set(back.values())) < len(back):
                raise ValueError("two letters of one script for one Latin letter")

    def _rewrite(self, m: regex.Match) -> str:
        s = m.group()
        if m.lastindex == 1:
            return s
        if m.lastindex == 3:
            return ""
        if m.lastindex == 4:
            if "！" <= s <= "～" and not s.isalnum():
                near = m.string[m.start() - 1 : m.start()] + m.string[m.end() : m.end() + 1]
                if self.cjk.search(near):
                    return s  # the native punctuation of East Asian text
            return self.singles.get(s, s)
        return U.normalize("NFC", _HIDDEN.sub("", "".join(self.singles.get(c, c) for c in s)))

    def clusters(self, text: str, start: int = 0, end: int | None = None) -> str:
        """``text[start:end]`` with its clusters replaced; what is not in the mapping is copied."""
        end = len(text) if end is None else end
        out, last, at = [], start, start
        while (found := self.trigger.search(text, at, end)) is not None:
            p = found.start()
            # A mark or joiner belongs to the character before it, an emoji's to the one before its modifier.
            first = p - 2 if p > 1 and self.modifier.match(text[p - 1]) else p - 1
            first = max(first, last)
            m = self.longest.match(text, first, end)
            if m.end() <= p:
                m = self.longest.match(text, p, end)
            out += [text[last : m.start()], self._rewrite(m)]
            last = at = m.end()
        return "".join(out) + text[last:end] if out else text[start:end]

    def run(self, text: str) -> str:
        if not self.foreign.search(text):
            return self.clusters(text)
        # Each word with what stands before it; words of look-alikes wait for their neighbours.
        pieces: list[str] = []
        scripts: list[str] = []
        last = 0
        for m in self.words.finditer(text):
            word, script = self.word(m.group())
            pieces += [self.clusters(text, last, m.start()) if m.start() > last else "", word]
            scripts.append(script)
            last = m.end()
        pieces.append(self.clusters(text, last))
        if any(s in "cgahul" for s in scripts):
            self.settle(pieces, scripts)
        return "".join(pieces)

    def settle(self, pieces: list[str], scripts: list[str]) -> None:
        """Gives words of look-alikes only the script of the sure words before and after them."""
        before: list[str | None] = [None] * len(scripts)
        after = before.copy()
        for near, order in ((before, range(len(scripts))), (after, range(len(scripts) - 1, -1, -1))):
            seen = None
            for i in order:
                near[i] = seen
                seen = scripts[i] if scripts[i].isupper() else seen
        for i, script in enumerate(scripts):
            word, at, own = pieces[2 * i + 1], 2 * i + 1, script.upper()
            if script in ("c", "g"):
                near = {before[i], after[i]}
                foreign = any(c in "іІјЈѕЅ" for c in word)
                if "L" in near and (foreign or own not in near and not (before[i] is None and own in scripts)):
                    pieces[at] = _mapped(word, self.to_latin)
            elif script in ("a", "h", "u") and own not in scripts:
                pieces[at] = _mapped(word, self.to_latin)
            elif script == "l" and len(word) <= 2 and 0 < i < len(scripts) - 1 and scripts[i - 1] == scripts[i + 1] == "C":
                pieces[at] = _mapped(word, self.back["C"])

    def _letter(self, ch: str) -> tuple[str, bool] | None:
        """Script of a letter, and whether no other script has one of its look."""
        if ch in self.phonetics:
            return "P", False
        if self.latin.match(ch):
            if "\u0250" <= ch <= "\u02AF" or "\u1D00" <= ch <= "\u1D2B":
                return "P", True
            return "L", ch not in self.latin_like
        for k, pattern in self.script.items():
            if pattern.match(ch):
                return k, ch not in self.looks[k]
        return None

    def _word(self, raw: str) -> tuple[str, str]:
        """A word in one script and that script's letter; in lower case if all its letters are look-alikes."""
        word = self.clusters(raw)
        plain = U.normalize("NFD", word)
        found = [x for x in map(self._letter, plain) if x]
        there, sure = {k for k, _ in found}, {k for k, s in found if s}
        foreign = sure - {"L"}
        if len(there) > 1:
            if not foreign:
                return _mapped(word, self.to_latin), "L"
            if foreign == {"C"} and "L" not in sure:
                return _mapped(word, self.back["C"]), "C"
            if "G" in foreign and "C" not in foreign:
                return _mapped(word, self.back["G"]), "G"
            return word, "O"
        if not there:
            return word, "O"
        (k,) = there
        if k == "P":
            return (word, "O") if sure else (_mapped(word, self.to_latin), "L")
        if k == "G" and not sure:
            # Accents are Greek, and so are words of weak look-alikes only.
            accented = any(U.combining(c) for c in plain)
            return word, "G" if accented or all(c in _WEAK_GREEK for c in word) else "g"
        return word, k if sure else k.lower()


@cache
def transducer() -> Transducer:
    return Transducer(character_map(), LOOKS, phonetic())


def canonical(text: str | None) -> str | None:
    """The text in the one consistent form."""
    if not text or text.isascii() and "\0" not in text or not _suspect().search(text):
        return text
    return transducer().run(text)


@cache
def suspicious() -> str:
    """Pattern of texts the transducer might change, for a filter inside the JVM."""
    t = character_map()
    inert = {chr(c) for c in (*range(1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C1), *range(0x2100, 0x27C0), *range(0x2B00, 0x2C00), *range(0x3001, 0x3100), *range(0x4E00, 0xA000), *range(0x1F000, 0x1FB00))}
    inert = sorted(ord(c) for c in inert if c not in t and not U.combining(c) and U.category(c) not in ("Cf", "Cn"))
    ranges: list[list[int]] = []
    for c in inert:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    # Most characters are told by the two ranges of the look-ahead.
    return r"(?![\x{1}-\x{7F}\x{C0}-\x{FF}])[^" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


@cache
def _suspect() -> re.Pattern:
    return re.compile(regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08X}", suspicious()))


@F.pandas_udf(T.StringType())
def _canonical_udf(texts: pd.Series) -> pd.Series:
    return texts.map(canonical, na_action="ignore")


def canonical_column(c: Column | str) -> Column:
    """Canonical text; only texts with suspicious characters change, all others are returned as they are."""
    return _canonical_udf(F.col(c) if isinstance(c, str) else c)


def disguised(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text differs from its canonical form, with ``canonical``.

    The filter on single characters is exact (a text without a suspicious
    character is its own canonical form) and keeps most rows out of Python.
    """
    rows = df.filter(F.col(text).rlike(suspicious()))
    return rows.withColumn("canonical", canonical_column(text)).filter(F.col("canonical") != F.col(text))


def disguised_fields(artists: DataFrame, artworks: DataFrame) -> DataFrame:
    """``entity_type, platform_name, platform_id, field_name``, each once, of disguised names, biographies and titles."""
    from vernissage.functions.text import clean_id

    people = spread(artists.select("platform_name", "platform_artist_id", "full_name", "biography")).select(F.lit("artist").alias("entity_type"), "platform_name", F.col("platform_artist_id").alias("id"), F.inline(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("value")) for c in ("full_name", "biography")])))
    works = spread(artworks.select("platform_name", "platform_artwork_id", "title")).select(F.lit("artwork").alias("entity_type"), "platform_name", F.col("platform_artwork_id").alias("id"), F.lit("title").alias("field_name"), F.col("title").alias("value"))
    found = disguised(people, "value").drop("canonical", "value").unionByName(disguised(works, "value").drop("canonical", "value"))
    named = found.select("entity_type", "platform_name", clean_id("id").alias("platform_id"), "field_name").filter("platform_id is not null")
    return named.distinct()
