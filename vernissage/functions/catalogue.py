"""Facts in the running text of catalogues: medium, year, signature, life dates.

A text is read once as words, each of which has a role by a table of words: a
material, a support, a verb of making, a year. What is asked for is then a short
pattern over the letters of the roles. The tables are parameters.

Defined cases: null texts and texts without words state nothing; words are
compared without accents and in lower case, so that all spellings are one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from vernissage.functions.countries import is_people
from vernissage.functions.scalars import let
from vernissage.functions.text import _col, fold

#: Words of catalogues by role: materials and techniques, what carries them, words that go before a
#: material, and words of inscriptions and editions, whose part of a sentence is no medium.
MEDIUM_WORDS = {
    "material": "oil oils huile olio oleo olie ol acrylic acrylics acrylique acrilico acryl watercolor watercolour aquarelle aquarell acquerello acuarela aguarela gouache guazzo bodycolour bodycolor tempera eitempera distemper encaustic "
    "pastel pastels pastello charcoal fusain carboncino kohle graphite pencil pencils crayon crayons matita bleistift ink encre inchiostro tusche pen pluma brush wash lavis chalk chalks sanguine gesso enamel lacquer "
    "collage assemblage mixed mischtechnik mista mixte mixta lithograph lithographs lithographie litografia etching etchings radierung acquaforte eau-forte engraving gravure incisione aquatint aquatinte aquatinta drypoint mezzotint monotype "
    "screenprint screenprints silkscreen serigraph serigraphie serigrafia siebdruck woodcut holzschnitt linocut linogravure pochoir giclee offset photograph photographs photographie fotografia photogravure albumen gelatin cibachrome polaroid c-print "
    "bronze marble marmo marmor terracotta ceramic ceramique ceramica porcelain stoneware plaster wood holz bois steel iron brass glass resin tapestry embroidery neon video",
    "support": "canvas toile tela leinwand lienzo doek paper papier carta papel panel panneau tavola tafel board cardboard carton cartone karton linen lin leinen masonite copper vellum parchment silk velvet aluminium",
    "before": "a an the original vintage unique rare fine colour color coloured colored couleur couleurs farbige patinated gilt cast carved painted printed digital archival black white and with on de a la",
    "never": "signed signe signee firmato firmata signiert inscribed inscription dated date datee datato datiert titled titre stamped numbered numerote edition framed encadre provenance literature",
}
#: Verbs of making, words that may stand between them and the year, and words of dating.
YEAR_WORDS = {
    "made": "painted executed drawn cast carved printed created made realised realized conceived photographed modelled peint peinte peints realise realisee execute executee concu concue photographie dipinto eseguito realizzato gemalt ausgefuhrt entstanden pintado realizado",
    "filler": "in en nel im um circa ca c about around by vers towards verso the year annee jahr",
    "dated": "dated date datee dates datees datato datata datiert fechado",
}
SIGNED_WORDS = {
    "signed": "signed signe signee signes signees firmato firmata signiert monogrammed monogramme monogrammee monogrammiert firmado",
    "not": "not non nicht no never without",
    "unsigned": "unsigned unsigniert",
}

_WORD = r"\d+|[a-z][a-z-]*"
_YEAR = r"^(?:1[2-9]|20)\d\d$"


def _roles(words: Column, table: Mapping[str, str], letters: Mapping[str, str]) -> Column:
    """One letter for each word: that of its role, ``Y`` for a year, ``9`` for a number, ``-`` for any other."""

    def letter(w: Column) -> Column:
        out = F.when(w.rlike(_YEAR), "Y").when(w.rlike(r"^\d"), "9")
        for role, x in letters.items():
            out = out.when(w.isin(*table[role].split()), x)
        return out.otherwise("-")

    return F.array_join(F.transform(words, letter), "")


def _words(c: Column) -> Column:
    return F.regexp_extract_all(fold(c), F.lit(_WORD), 0)


def medium(c: Column | str, words: Mapping[str, str] = MEDIUM_WORDS) -> Column:
    """The first parts of a sentence, between commas, that name materials; 3 to 80 characters.

    The first part opens with a material (after words that may go before one),
    those after it name a material or a support. A part ends before a number.
    """
    letters = {"never": "X", "material": "M", "support": "S", "before": "b"}

    def judged(part: Column) -> Column:
        # What stands before the first number, and the roles of its words.
        text = F.regexp_replace(F.regexp_extract(part, r"^[^\d]*", 0), r"^[\s.;:(]+|[\s.;:,(]+$", "")
        return let(text, lambda t: F.struct(t.alias("text"), _roles(_words(t), words, letters).alias("roles"), part.rlike(r"\d").alias("cut")))

    def of_sentence(s: Column) -> Column:
        parts = F.transform(F.split(s, ","), judged)
        start = F.struct(F.lit(0).alias("state"), F.array().cast("array<string>").alias("kept"))

        def step(acc: Column, p: Column) -> Column:
            # States: 0 no medium yet, 1 within it, 2 past it.
            opens, goes_on = p["roles"].rlike("^b*M") & ~p["roles"].contains("X"), p["roles"].rlike("[MS]") & ~p["roles"].contains("X")
            takes = F.when(acc["state"] == 0, opens).otherwise((acc["state"] == 1) & goes_on)
            state = F.when(takes, F.when(p["cut"], 2).otherwise(1)).otherwise(F.when(acc["state"] == 0, 0).otherwise(2))
            return F.struct(state.alias("state"), F.when(takes, F.array_append(acc["kept"], p["text"])).otherwise(acc["kept"]).alias("kept"))

        line = F.array_join(F.aggregate(parts, start, step)["kept"], ", ")
        return F.when(F.length(line).between(3, 80), line)

    sentences = F.split(_col(c), r"[\n;]|\.\s+|\.$")
    return F.get(F.filter(F.transform(sentences, of_sentence), lambda m: m.isNotNull()), 0)


def year_made(text: Column | str, title: Column | str, born: Column | str, as_of: int, words: Mapping[str, str] = YEAR_WORDS) -> Column:
    """Year of making: after a verb of making, else after a word of dating, else at the end of the title.

    Null if it lies after ``as_of`` or before the artist's fifth year.
    """

    def found(w: Column) -> Column:
        def at(roles: Column, pattern: str) -> Column:
            # The year is the last word of the match.
            end = F.regexp_instr(roles, F.lit(pattern)) + F.length(F.regexp_extract(roles, pattern, 0)) - 1
            return F.when(roles.rlike(pattern), F.get(w, F.greatest(end, F.lit(1)) - 1))

        roles = _roles(w, words, {"made": "V", "filler": "f", "dated": "D"})
        return let(roles, lambda r: F.coalesce(at(r, "Vf*Y"), at(r, "D[^9DY]{0,6}Y")))

    titled = F.nullif(F.regexp_extract(_col(title), r",\s*(\d{4})\s*$", 1), F.lit(""))
    year = F.coalesce(let(_words(_col(text)), found), F.when(titled.rlike(_YEAR), titled)).try_cast("int")
    return let(year, lambda y: F.when(y.between(1400, as_of) & (_col(born).isNull() | (y >= _col(born) + 5)), y))


def is_signed(c: Column | str, words: Mapping[str, str] = SIGNED_WORDS) -> Column:
    """True for signed, false for unsigned works, null if the text says neither."""
    roles = _roles(_words(_col(c)), words, {"signed": "S", "not": "n", "unsigned": "U"})
    return let(roles, lambda r: F.when(r.rlike("U|nS"), False).when(r.contains("S"), True))


def nationality(c: Column | str) -> Column:
    """The text without marks around it, if its last word names the people of a country."""
    t = F.regexp_replace(_col(c), r"^[\s,.;]+|[\s,.;]+$", "")
    last = F.element_at(F.split(fold(t), r"[\s/-]+"), -1)
    return F.when(is_people(last) & (F.length(t) <= 40), t)


def life(c: Column | str) -> Column:
    """``struct(born, died, nationality)`` of the brackets that close an artist's line, or null.

    Two years are a life if 15 to 110 years lie between them; one year counts
    after a word of birth. Years of activity are no life.
    """
    inside = F.regexp_extract(_col(c), r"\(([^()]*)\)\s*$", 1)
    born_words, active = "b born ne nee geb geboren nato nata nacido", "active fl floruit tatig actif attivo"

    def read(w: Column) -> Column:
        years = F.transform(F.filter(w, lambda x: x.rlike(_YEAR)), lambda x: x.cast("int"))
        roles = _roles(w, {"born": born_words, "active": active}, {"born": "B", "active": "A"})
        first, second = F.get(years, 0), F.get(years, 1)
        span = second.isNotNull() & (second - first).between(15, 110)
        alone = second.isNull() & roles.rlike("B")
        born = F.when((span | alone) & ~roles.contains("A"), first)
        return F.struct(born.alias("born"), F.when(span, second).alias("died"))

    people = F.when(inside.contains(","), nationality(F.substring_index(inside, ",", 1)))
    return let(let(_words(inside), read), lambda s: F.when(s["born"].isNotNull(), F.struct(s["born"].alias("born"), s["died"].alias("died"), people.alias("nationality"))))
