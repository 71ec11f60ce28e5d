"""Address surrogates: a document's places as a tree, and another tree of the same shape.

The gazetteer is a table (id, parent_id, name, admin_level); its sizes are those of a
country's places, which a session checks before it sends them to all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE, PHONE, CITY = 6, 8, 8
MOST_PLACES = 2_000_000


@dataclass
class Node:
    name: str
    level: int
    id: str | None = None
    children: list[Node] = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        yield self
        for c in self.children:
            yield from c.walk()


class Gazetteer:
    def __init__(self, rows: Sequence[tuple[str, str | None, str, int]]):
        self.rows = {r[0]: r for r in rows}
        self.by_name: dict[str, list[str]] = {}
        self.children: dict[str, list[str]] = {}
        for i, parent, name, _ in sorted(rows, key=lambda r: r[0]):
            self.by_name.setdefault(name, []).append(i)
            if parent is not None:
                self.children.setdefault(parent, []).append(i)

    def level(self, place: str) -> int:
        return self.rows[place][3]

    def find(self, name: str, default: int) -> tuple[str | None, int]:
        """A name's place of the lowest level number, or none at the default level."""
        found = sorted(self.by_name.get(name, ()), key=lambda i: (self.level(i), i))
        return (found[0], self.level(found[0])) if found else (None, default)

    def above(self, place: str) -> list[str]:
        out, at = [], self.rows[place][1]
        while at is not None and at in self.rows and at not in out:
            out.append(at)
            at = self.rows[at][1]
        return out

    def below(self, place: str, level: int) -> list[str]:
        """Places of a level anywhere under ``place``."""
        out, todo = [], [place]
        while todo:
            for c in self.children.get(todo.pop(), ()):
                if self.level(c) == level:
                    out.append(c)
                elif self.level(c) < level:
                    todo.append(c)
        return sorted(out)


def pick(choices: Sequence[str], *seed: str) -> str:
    return choices[int(hashlib.md5("|".join(seed).encode()).hexdigest()[:8], 16) % len(choices)]


def tree(names: Sequence[tuple[str, int]], places: Gazetteer) -> list[Node]:
    """Roots of a document's names with default levels: a place hangs under the nearest other one that holds it.

    Names without a place hang under the first node of the next lower level number.
    """
    nodes = []
    for name, default in sorted(set(names)):
        place, level = places.find(name, default)
        nodes.append(Node(name, level, place))
    nodes.sort(key=lambda n: (n.level, n.name))
    at = {n.id: n for n in nodes if n.id}
    roots = []
    for n in nodes:
        parent = next((at[a] for a in places.above(n.id) if a in at), None) if n.id else None
        if parent is None and n.id is None:
            parent = next((m for m in reversed(nodes) if m.id and m.level < n.level), None)
        (parent.children if parent else roots).append(n)
    return roots


def resampled(root: Node, places: Gazetteer, seed: str) -> dict[str, str]:
    """Name to surrogate over a tree of the same shape and levels; where the gazetteer has no choice, a name keeps its level only."""
    out: dict[str, str] = {}

    def visit(node: Node, under: str | None, taken: set[str]) -> None:
        choices = places.below(under, node.level) if under else sorted(i for i, r in places.rows.items() if r[3] == node.level)
        free = [i for i in choices if i not in taken and i != node.id] or [i for i in choices if i != node.id]
        new = pick(free, seed, node.name) if free else None
        out[node.name] = places.rows[new][2] if new else f"PLACE_{node.level}"
        used: set[str] = set()
        for c in node.children:
            visit(c, new, used)
        if new:
            taken.add(new)

    visit(root, None, set())
    return out


def by_level(rows: DataFrame, key: str = "doc") -> DataFrame:
    """(key, admin_level, names): sorted names of each level in a document."""
    return rows.groupBy(key, "admin_level").agg(F.array_sort(F.collect_set("name")).alias("names"))


def usual_postcode(addresses: DataFrame, by: Sequence[str] = ("place",)) -> DataFrame:
    """The most common postcode of each place, the least of several."""
    counted = addresses.groupBy(*by, "postcode").agg(F.count("*").alias("n"))
    return counted.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("n"), "postcode")).alias("b")).select(*by, F.col("b.postcode").alias("postcode"))


def surrogates(mentions: DataFrame, geo: DataFrame, seed: str) -> DataFrame:
    """(doc, text, surrogate) of place mentions (doc, text, level), document by document.

    The walk over a tree is sequential, so each document is a group of its own; its size
    is that of a document's distinct place names.
    """
    table = geo.select("id", "parent_id", "name", "admin_level")
    if table.limit(MOST_PLACES + 1).count() > MOST_PLACES:
        raise ValueError(f"a gazetteer of over {MOST_PLACES} places")
    shared = geo.sparkSession.sparkContext.broadcast([tuple(r) for r in table.collect()])
    held: dict[str, Gazetteer] = {}

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        if not held:
            held["g"] = Gazetteer(shared.value)
        places = held["g"]
        doc = pdf["doc"].iloc[0]
        made: dict[str, str] = {}
        for root in tree(list(zip(pdf["text"], pdf["level"].astype(int), strict=True)), places):
            made |= resampled(root, places, f"{seed}|{doc}")
        return pd.DataFrame({"doc": doc, "text": list(made), "surrogate": list(made.values())})

    once = mentions.select(F.col("doc").cast("string").alias("doc"), "text", "level").where("text IS NOT NULL").distinct()
    return once.groupBy("doc").applyInPandas(one, "doc string, text string, surrogate string")
