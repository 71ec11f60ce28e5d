"""Small formats: service results, requests, account numbers, structured documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def internal_concepts(names: Column, url: str) -> Column:
    """Concept URLs of names that don't start with X; exclamation marks go."""
    kept = F.filter(names, lambda n: n.isNotNull() & ~n.startswith("X"))
    return F.transform(kept, lambda n: F.concat(F.lit(url), F.replace(n, F.lit("!"), F.lit(""))))


def diagnosis(line: Column) -> Column:
    """Struct of id, label and text of a result ``id|label|text``, missing ones empty; null for ``-``."""
    parts = F.split(line, r"\|")
    at = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    return F.when(line != "-", F.struct(at(1).alias("id"), at(2).alias("label"), at(3).alias("text")))


def field(line: Column, prefix: str) -> Column:
    """The value of the first field of a ``|``-separated line that starts with ``prefix``; null without."""
    own = F.filter(F.split(line, r"\|"), lambda p: p.startswith(prefix))
    return F.substring(F.try_element_at(own, F.lit(1)), F.lit(len(prefix) + 1), F.lit(1 << 30))


REQUEST = "metadata struct<layer: string, feature: string, projectId: bigint>, document struct<xmi: string, documentId: bigint, userId: string>, typeSystem string"
TRAINING = "metadata struct<layer: string, feature: string, projectId: bigint>, documents array<struct<xmi: string, documentId: bigint, userId: string>>, typeSystem string"


def request(body: Column, training: bool = False) -> Column:
    """A service request's JSON as a struct; null parts where it lacks them."""
    return F.from_json(body, TRAINING if training else REQUEST)


def iban(text: Column) -> Column:
    """Whether an account number's check digits are right: read with its first four characters last and letters as numbers, it is 1 modulo 97."""
    plain = F.upper(F.regexp_replace(text, r"\s", ""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    digit = lambda c: F.when(c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string"))
    number = F.array_join(F.transform(F.split(turned, ""), digit), "")
    rest = F.aggregate(F.split(number, ""), F.lit(0), lambda a, d: (a * 10 + d.cast("int")) % 97)
    return F.when(plain.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), rest == 1).otherwise(F.lit(False))


def bic(text: Column) -> Column:
    return text.rlike("^[A-Z]{6}[A-Z0-9]{2}(?:[A-Z0-9]{3})?$")


def contents(xml: Column, path: str = "//content/text()") -> Column:
    """Texts of a document's content elements with single spaces, without empty ones; null where it is no XML."""
    found = F.xpath(F.when(xml.rlike(r"^\s*<"), xml), F.lit(path))
    clean = F.transform(found, lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, "pt\\?", ""), "[\\s ]+", " ")))
    return F.filter(clean, lambda t: t != "")


def prepared(docs: DataFrame, most: int = 150_000, languages: tuple[str, ...] = ("en", "de", "pt"), default: str = "de") -> DataFrame:
    """Documents of at most so many characters, with a known language or the default."""
    lang = F.when(F.col("lang").isin(*languages), F.col("lang")).otherwise(F.lit(default))
    return docs.where(F.length("text") <= most).withColumn("lang", lang)


def referenced_dates(dates: DataFrame, holders: DataFrame) -> DataFrame:
    """Dates with kind DATE_BIRTH or DATE_DEATH where a holder (doc, ann_id, kind) refers to them, else DATE."""
    known = holders.groupBy(F.col("doc").alias("_doc"), F.col("ann_id").alias("_id")).agg(F.min("kind").alias("_kind"))
    out = dates.join(known, (dates["doc"] == known["_doc"]) & (dates["ann_id"] == known["_id"]), "left")
    return out.withColumn("kind", F.coalesce("_kind", F.lit("DATE"))).drop("_doc", "_id", "_kind")


def named_in(notes: DataFrame, names: DataFrame, note: str = "note", name: str = "name") -> DataFrame:
    """Pairs of a note and a name that it contains as a run of words.

    Notes are cut into runs of as many words as names have, and joined to them by
    equality, so notes and names without a word in common never meet.
    """
    plain = lambda c: F.array_join(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""), " ")
    known = names.select(F.col(name).alias("name"), plain(F.col(name)).alias("_key")).where("_key != ''").distinct()
    longest = known.agg(F.coalesce(F.max(F.size(F.split("_key", " "))), F.lit(0))).first()[0]
    words = F.split(plain(F.col(note)), " ")

    def runs_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))

    runs = F.flatten(F.array(*[runs_of(n) for n in range(1, longest + 1)])) if longest else F.array().cast("array<string>")
    cut = notes.select(F.col(note).alias("note")).distinct().select("note", F.explode(F.array_distinct(runs)).alias("_key"))
    return cut.join(known, "_key").select("note", "name").distinct()


def collected_codes(rows: DataFrame, place: str = "place", code: str = "postcode") -> DataFrame:
    """(place, codes): the sorted distinct codes of each place."""
    return rows.where(F.col(code).isNotNull()).groupBy(F.col(place).alias("place")).agg(F.array_sort(F.collect_set(code)).alias("codes"))
