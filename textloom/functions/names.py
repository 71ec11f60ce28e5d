"""Names in clinical text: titles, gender, roles of a name's parts, surrogates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.determinism import pick

#: Fixed values of the annotation rules: parts of titles, salutations, words that start a last name.
TITLE_PARTS = ("dr", "phil", "univ", "medic", "dres", "med", "dipl", "psych", "dent", "vet", "habil", "mult", "rer", "päd", "nat")
SALUTATIONS = ("Herr", "Frau", "Hr.", "Fr.")
ARTICLES = (
    "der", "die", "das", "den", "dem", "des", "ein", "eine", "einen", "einem", "einer", "eines", "el", "la", "los", "las", "le", "les", "l",
)
PREPOSITIONS = (
    "ab", "an", "auf", "aus", "bei", "bis", "durch", "für", "gegen", "ohne", "um", "unter", "über", "vor", "hinter", "neben", "zwischen", "nach", "mit", "von", "zu", "gegenüber",
    "während", "trotz", "wegen", "statt", "gemäß", "entlang", "seit", "laut", "vom", "zur", "zum", "beim", "van", "des", "de", "del", "dos",
)
PUNCTUATION = r"^[!-/:-@\[-`{-~]+$"


def is_title(token: Column, parts: Sequence[str] = TITLE_PARTS) -> Column:
    return F.lower(token).rlike("|".join(parts))


def is_salutation(token: Column) -> Column:
    return token.isin(*SALUTATIONS)


def is_punctuation(token: Column) -> Column:
    return token.rlike(PUNCTUATION)


def is_female_suffix(token: Column) -> Column:
    return token.contains("in")


def is_particle(word: Column) -> Column:
    return F.lower(word).isin(*PREPOSITIONS, *ARTICLES)


def gender(name: Column, before: Column, known: Column | None = None) -> Column:
    """female, male or unknown, from the words before a name, last word nearest.

    Titles and punctuation are passed over; a salutation or a female suffix decides, any
    other word ends the search. Then ``known`` decides, a map from first names.
    """
    skip = lambda w: is_title(w) | is_punctuation(w)
    first = F.element_at(F.filter(F.reverse(before), lambda w: ~skip(w) | is_salutation(w)), 1)
    first = F.when(F.size(F.filter(before, lambda w: ~skip(w) | is_salutation(w))) > 0, first)
    said = F.when(first.isin("Herr", "Hr."), "male").when(first.isin("Frau", "Fr."), "female").when(is_female_suffix(first), "female")
    guess = F.lit(None).cast("string") if known is None else F.try_element_at(known, F.element_at(F.split(name, " "), 1))
    return F.coalesce(said, guess, F.lit("unknown"))


def classify(name: Column, before: Column | None = None) -> Column:
    """Array of (part, role): FN for first names, LN for the last name.

    ``Last, First ...``; a single word is LN after Herr or Frau, else FN; of two words the
    first is FN; in longer ones a preposition or article starts the LN, else the last
    word is it.
    """
    before = F.array().cast("array<string>") if before is None else before
    pair = lambda part, role: F.struct(part.alias("part"), F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"))
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    comma = F.filter(F.split(name, r"[,\s]+"), lambda w: w != "")
    listed = F.transform(comma, lambda w, i: pair(w, F.when(i == 0, "LN").otherwise("FN")))
    single = F.transform(words, lambda w: pair(w, F.when(F.exists(before, lambda b: b.isin("Herr", "Frau")), "LN").otherwise("FN")))
    n = F.size(words)
    at = F.array_position(F.transform(words, is_particle), F.lit(True))
    start = F.when(at > 0, at).otherwise(n)
    firsts = F.transform(F.slice(words, F.lit(1), F.greatest(start - 1, F.lit(0)).cast("int")), lambda w: pair(w, "FN"))
    last = F.array(pair(F.array_join(F.slice(words, start.cast("int"), n), " "), "LN"))
    return F.when(name.contains(","), listed).when(n <= 1, single).otherwise(F.concat(firsts, last))


def surrogate(parts: Column, gender_: Column, female: Column, male: Column, family: Column, seed: str) -> Column:
    """Parts replaced by names of the pools and joined by a space; a part has the same surrogate in any case and place."""
    first = lambda p: F.when(gender_ == "female", pick(female, F.lit(seed), F.lower(p))).otherwise(pick(male, F.lit(seed), F.lower(p)))
    return F.array_join(F.transform(parts, lambda x: F.when(x["role"] == "LN", pick(family, F.lit(seed), F.lower(x["part"]))).otherwise(first(x["part"]))), " ")


def title_surrogate(title: Column, groups: Sequence[Sequence[str]], seed: str) -> Column:
    """Another title of the same group; of an unknown title or one alone in its group, a title of the second group."""
    spare = F.array(*map(F.lit, groups[min(1, len(groups) - 1)]))
    out = pick(spare, F.lit(seed), title)
    for group in groups:
        others = F.filter(F.array(*map(F.lit, group)), lambda t: t != title)
        out = F.when(title.isin(*group) & (F.size(others) > 0), pick(others, F.lit(seed), title)).otherwise(out)
    return out
