"""Replacing sensitive spans: masks, categories, keyed placeholders, surrogates, and the keys to undo them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import dates, names, strings
from textloom.functions.arrays import let
from textloom.functions.determinism import key6, number
from textloom.model import fresh
from textloom.operators.spans import rewrite
from textloom.sources.scratch import durable

#: Kinds of which the keyed mode shows the text itself, and those of which it shows the quarter.
SHOWN, QUARTERED = ("PROFESSION", "AGE", "DATE"), ("DATE_BIRTH", "DATE_DEATH")


def _surrogate(kind: Column, text: Column, shown: Column) -> Column:
    return F.when(kind.isin(*QUARTERED), dates.quarter(text)).when(kind.isin(*SHOWN), text).otherwise(shown)


def assign_keys(spans: DataFrame, salt: str, key: str = "doc", mode: str = "keyed", unique: bool = True) -> DataFrame:
    """(key, mode, kind, surrogate, original): one key for each distinct (kind, text) of a document, dates aside.

    Keys are unique over all documents: the few that a hash gives twice are made anew
    with their number among the equal ones, which is in the order of document, kind, text.
    Without ``unique`` a key is the hash as it is, which depends on nothing but its own
    row; two rows then share one at times, mostly of different documents.
    """
    kind = F.coalesce("kind", F.lit("None"))
    once = spans.where(F.coalesce(F.col("kind") != "DATE", F.lit(True))).select(key, kind.alias("kind"), F.col("text").alias("original")).distinct()
    shown = key6(F.lit(salt), key, "kind", "original")
    if unique:
        again = Window.partitionBy("_key").orderBy(key, "kind", "original")
        once = once.withColumn("_key", shown).withColumn("_n", F.row_number().over(again) - 1)
        other = F.concat("_key", (F.col("_n") + 1).cast("string"))
        shown = F.when(F.col("_n") == 0, F.col("_key")).otherwise(other)
    return once.select(key, F.lit(mode).alias("mode"), "kind", _surrogate(F.col("kind"), F.col("original"), shown).alias("surrogate"), "original")


def flat_keys(keys: DataFrame, project: str, key: str = "doc") -> DataFrame:
    """(name, original): project, document, kind and surrogate joined by ``-**-``."""
    return keys.select(F.concat_ws("-**-", F.lit(project), F.col(key).cast("string"), "kind", "surrogate").alias("name"), "original")


def nested_keys(keys: DataFrame, key: str = "doc") -> DataFrame:
    """(key, keys): a document's map from kind to a map from surrogate to original, as JSON."""
    one = keys.groupBy(key, "kind").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("surrogate", "original")))).alias("m"))
    return one.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", F.to_json("m").alias("m")))))).alias("keys"))


def replacements(spans: DataFrame, mode: str, salt: str = "", key: str = "doc", surrogates: DataFrame | None = None, days: int = 0, keep_unknown: bool = False, unique: bool = True) -> DataFrame:
    """``spans`` with ``replacement``, by mode: x, entity, keyed or surrogate.

    The keyed mode shows assign_keys' keys; without ``unique`` each row's key is its own
    hash, so spans are neither gathered nor joined.

    The surrogate mode takes ``surrogates`` of (kind, text, surrogate), shifts dates by
    ``days`` (birth and death dates become their quarter without a shift), and shows what
    has no surrogate as ``[KIND]``, or as it is with ``keep_unknown``, which leaks it.
    """
    kind, text = F.col("kind"), F.col("text")
    if mode == "x":
        return spans.withColumn("replacement", strings.mask_x(text))
    if mode == "entity":
        return spans.withColumn("replacement", strings.mask_entity(kind))
    if mode == "keyed" and not unique:
        named = F.coalesce(kind, F.lit("None"))
        content = _surrogate(named, text, key6(F.lit(salt), key, named, text))
        return spans.withColumn("replacement", strings.placeholder(kind, content))
    if mode == "keyed":
        spans = durable(spans)  # they are used twice, and finding them is what costs
        keys = assign_keys(spans, salt, key).select(F.col(key).alias("_doc"), F.col("kind").alias("_kind"), F.col("original").alias("_original"), "surrogate")
        joined = spans.join(keys, (spans[key] == keys["_doc"]) & (F.coalesce(kind, F.lit("None")) == keys["_kind"]) & (text == keys["_original"]), "left")
        content = F.when(kind.isin(*SHOWN), text).otherwise(F.col("surrogate"))
        return joined.withColumn("replacement", strings.placeholder(kind, content)).drop("_doc", "_kind", "_original", "surrogate")
    if mode != "surrogate" or surrogates is None:
        raise ValueError("mode is x, entity, keyed, or surrogate with a table of surrogates")
    known = surrogates.select(F.col("kind").alias("_kind"), F.col("text").alias("_text"), "surrogate")
    joined = spans.join(known, (kind == known["_kind"]) & (text == known["_text"]), "left")
    moved = dates.shift(text, days)
    birth = F.when(F.lit(days == 0), dates.quarter(text)).otherwise(moved)
    unknown = text if keep_unknown else F.concat(F.lit("["), F.coalesce(kind, F.lit("NONE")), F.lit("]"))
    out = F.when(kind == "DATE", moved).when(kind.isin(*QUARTERED), birth).otherwise(F.coalesce("surrogate", unknown))
    return joined.withColumn("replacement", out).drop("_kind", "_text", "surrogate")


def apply(docs: DataFrame, spans: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """``docs`` with the text rewritten, and ``moved``: the new and old places of the replaced spans.

    A document's spans are gathered to it alone; documents without spans stay as they are.
    """
    doc_, spans_, new_ = (fresh(docs.columns, c) for c in ("_doc", "_spans", "_new"))
    lists = spans.groupBy(F.col(key).alias(doc_)).agg(F.collect_list(F.struct(F.col("begin").cast("int").alias("begin"), F.col("end").cast("int").alias("end"), "replacement")).alias(spans_))
    joined = docs.join(lists, docs[key] == lists[doc_], "left")
    made = joined.withColumn(new_, rewrite(F.col(text), F.col(spans_)))
    return made.select(*[F.col(f"{new_}.text").alias(text) if c == text else docs[c] for c in docs.columns], F.col(f"{new_}.spans").alias("moved"))


def name_seed(scope: str, doc: Column, run: str) -> Column:
    """Seed of a surrogate: names and dates are consistent in a document, other kinds in a run."""
    return F.concat_ws("|", F.lit(run), doc.cast("string")) if scope == "doc" else F.lit(run)


def scrambled(spans: DataFrame, run: str) -> DataFrame:
    """(kind, text, surrogate) of identifiers: characters of the same class, the same in a whole run."""
    once = spans.select("kind", "text").distinct()
    return once.withColumn("surrogate", strings.scramble(F.col("text"), run))


def shifted_days(run: str, doc: Column, most: int = 365) -> Column:
    """A shift of 1 to ``most`` days that is a document's own."""
    return (number(F.lit(run), doc.cast("string")) % most + 1).cast("int")


def fictive(spans: DataFrame, run: str, female: Column, male: Column, family: Column, titles: Sequence[Sequence[str]], entries: Column | None = None, areas: Column | None = None) -> DataFrame:
    """(kind, text, surrogate) of each distinct text of the kinds that have a rule: what the surrogate mode takes.

    Names become names of the pools, titles others of their group, identifiers a scramble,
    mail addresses and URLs their parts replaced (by ``entries``, or scrambled), phone and
    fax numbers another area (of the map ``areas``, or a mobile one) and scrambled digits.
    Other kinds, and numbers that aren't understood, have no row. Texts are collected by
    kind, so one text has one surrogate in a run. Null kinds and texts have no row.
    """
    kind, text = F.col("kind"), F.col("text")
    words = F.create_map().cast("map<string,string>") if entries is None else entries
    area = lambda parts: F.lit(None).cast("string") if areas is None else F.try_element_at(areas, parts["area"])
    phone = let(strings.split_phone(text), lambda parts: F.when(parts.isNotNull(), strings.phone_surrogate(parts, area(parts), run)))
    gender = names.gender(text, F.array().cast("array<string>"))
    person = let(names.classify(text), lambda parts: let(gender, lambda g: names.surrogate(parts, g, female, male, family, run)))
    rules = (
        (kind == "NAME_TITLE", names.title_surrogate(text, titles, run)),
        (kind == "NAME_USERNAME", strings.scramble(text, run)),
        (kind.startswith("NAME_"), person),
        (kind == "ID", strings.scramble(text, run)),
        (kind == "CONTACT_EMAIL", strings.contact_surrogate(text, words, strings.MAIL_KEPT, run)),
        (kind == "CONTACT_URL", strings.contact_surrogate(text, words, strings.URL_KEPT, run)),
        (kind.isin("CONTACT_PHONE", "CONTACT_FAX"), phone),
    )
    rule = F.coalesce(*[F.when(test, made) for test, made in rules])
    once = spans.select("kind", "text").distinct()
    return once.withColumn("surrogate", rule).where("surrogate IS NOT NULL")
