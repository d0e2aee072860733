"""Countries: their codes and names by the platform's locale data, and the words for their people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vernissage.functions.text import fold

#: Languages in which names of countries are read.
LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "pl")

#: Other names in use, besides those of the locale data.
ALIASES = {"uk": "GB", "england": "GB", "scotland": "GB", "wales": "GB", "great britain": "GB", "usa": "US", "united states of america": "US", "holland": "NL", "czech republic": "CZ", "turkey": "TR", "burma": "MM"}

#: Words for the people of a country in English.
PEOPLE = {
    "AF": "afghan", "AL": "albanian", "DZ": "algerian", "AR": "argentine argentinian", "AM": "armenian", "AU": "australian", "AT": "austrian", "AZ": "azerbaijani", "BD": "bangladeshi", "BY": "belarusian",
    "BE": "belgian", "BO": "bolivian", "BA": "bosnian", "BR": "brazilian", "GB": "british english scottish welsh", "BG": "bulgarian", "CM": "cameroonian", "CA": "canadian", "CL": "chilean", "CN": "chinese",
    "CO": "colombian", "CD": "congolese", "HR": "croatian", "CU": "cuban", "CY": "cypriot", "CZ": "czech", "DK": "danish", "EC": "ecuadorian", "EG": "egyptian", "EE": "estonian", "ET": "ethiopian",
    "FI": "finnish", "FR": "french", "GE": "georgian", "DE": "german", "GH": "ghanaian", "GR": "greek", "GT": "guatemalan", "HT": "haitian", "HU": "hungarian", "IS": "icelandic", "IN": "indian",
    "ID": "indonesian", "IR": "iranian persian", "IQ": "iraqi", "IE": "irish", "IL": "israeli", "IT": "italian", "CI": "ivorian", "JM": "jamaican", "JP": "japanese", "KZ": "kazakh", "KE": "kenyan",
    "KR": "korean", "LV": "latvian", "LB": "lebanese", "LT": "lithuanian", "LU": "luxembourgish", "MY": "malaysian", "ML": "malian", "MX": "mexican", "MA": "moroccan", "NP": "nepali nepalese", "NL": "dutch",
    "NZ": "zealander", "NG": "nigerian", "NO": "norwegian", "PK": "pakistani", "PS": "palestinian", "PE": "peruvian", "PH": "filipino", "PL": "polish", "PT": "portuguese", "RO": "romanian", "RU": "russian",
    "SN": "senegalese", "RS": "serbian", "SG": "singaporean", "SK": "slovak", "SI": "slovenian", "ZA": "african", "ES": "spanish", "LK": "lankan", "SE": "swedish", "CH": "swiss", "SY": "syrian", "TW": "taiwanese",
    "TH": "thai", "TN": "tunisian", "TR": "turkish", "UA": "ukrainian", "US": "american", "UY": "uruguayan", "VE": "venezuelan", "VN": "vietnamese",
}

#: Words for people in other languages than English, for the countries met most.
PEOPLE_ABROAD = {
    "FR": "francais francaise franzosisch francese frances frans fransk", "DE": "deutsch deutsche allemand allemande tedesco tedesca aleman alemana duits tysk niemiecki", "IT": "italiano italiana italien italienne italienisch italiaans italiensk",
    "ES": "espanol espanola espagnol espagnole spanisch spagnolo spaans spansk", "PT": "portugues portuguesa portugais portugaise portugiesisch portoghese", "NL": "nederlands nederlandse neerlandais niederlandisch olandese hollandais",
    "PL": "polski polska polonais polonaise polnisch polacco pools", "SE": "svensk svenska suedois suedoise schwedisch svedese zweeds", "GB": "britannique anglais anglaise britisch englisch inglese ingles brits engels",
    "US": "americain americaine amerikanisch americano americana amerikaans amerikansk", "BE": "belge belgisch belga", "CH": "suisse schweizer schweizerisch svizzero", "AT": "autrichien osterreichisch austriaco", "RU": "russe russisch russo rusky",
}


#: Words read before, by languages: they are the same for every session.
_known: dict[tuple[str, ...], dict[str, str]] = {}


def country_words(spark: SparkSession, languages: tuple[str, ...] = LANGUAGES) -> dict[str, str]:
    """Folded codes, names and words for people, and the ISO code each stands for.

    Codes of two and three letters and names in several languages come from
    the locale data of the platform, about 250 countries in each language. A
    word that stands for two countries stands for none.
    """
    if languages in _known:
        return _known[languages]
    locale = spark._jvm.java.util.Locale
    tongues = [locale.forLanguageTag(x) for x in languages]
    found: dict[str, set[str]] = {}
    for code in locale.getISOCountries():
        place = locale("", code)
        for word in (code, place.getISO3Country(), *(place.getDisplayCountry(t) for t in tongues)):
            found.setdefault(fold_word(word), set()).add(code)
    own = {w: {c} for table in (PEOPLE, PEOPLE_ABROAD) for c, words in table.items() for w in words.split()}
    own |= {w: {c} for w, c in ALIASES.items()}
    _known[languages] = {w: next(iter(codes)) for w, codes in {**found, **own}.items() if w and len(codes) == 1}
    return _known[languages]


def country_names(spark: SparkSession, language: str = "en") -> dict[str, str]:
    """Names by codes of two and of three letters, and by the usual abbreviations."""
    locale = spark._jvm.java.util.Locale
    out = {}
    for code in locale.getISOCountries():
        place = locale("", code)
        out[code] = out[place.getISO3Country()] = place.getDisplayCountry(locale.forLanguageTag(language))
    return out | {"UK": out["GB"]}


def fold_word(word: str) -> str:
    """The same form as ``text.fold`` gives in a column."""
    import unicodedata

    t = word.lower().translate(str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "’": "'"}))
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).split())


def country_table(spark: SparkSession, words: dict[str, str] | None = None) -> DataFrame:
    """``word, code``: a row for each of some two thousand words, whatever the data."""
    return spark.createDataFrame(sorted((words or country_words(spark)).items()), "word string, code string")


def with_country_code(df: DataFrame, column: str, out: str, table: DataFrame) -> DataFrame:
    """Adds ``out``: the ISO code of a country or its people, in any of the table's notations; null if unknown."""
    # The table's size does not depend on the data.
    found = F.broadcast(table.select(F.col("word").alias("_word"), F.col("code").alias(out)))
    return df.withColumn("_word", fold(column)).join(found, "_word", "left").drop("_word")


def is_people(word: Column) -> Column:
    """Whether a folded word names the people of a country."""
    return word.isin(*sorted({w for table in (PEOPLE, PEOPLE_ABROAD) for words in table.values() for w in words.split()}))
