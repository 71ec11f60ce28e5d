"""Mapping annotations from one schema to another by declarative rules.

A mapping file has constants, default name spaces and entries. It is compiled on the
driver to one ordered CASE for each source layer.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Rule:
    """One entry for one source layer: a predicate, the label it gives, and the features it fills."""

    source: str
    target: str
    label: str
    predicate: str
    features: dict[str, str] = field(default_factory=dict)
    #: the feature of the target layer that takes the label; None maps the layer as a whole
    feature: str | None = None
    priority: int = 0


@dataclass
class MappingRules:
    rules: list[Rule]

    def sources(self) -> list[str]:
        return list(dict.fromkeys(r.source for r in self.rules))

    def targets(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for r in self.rules:
            out.setdefault(r.target, [])
            if r.source not in out[r.target]:
                out[r.target].append(r.source)
        return out

    def target_features(self) -> dict[str, list[str]]:
        """Features of each target layer, all strings."""
        out: dict[str, list[str]] = {}
        for r in self.rules:
            names = out.setdefault(r.target, [])
            names += [n for n in ([r.feature] if r.feature else []) + list(r.features) if n not in names]
        return out


def expand(name: str, constants: Mapping[str, str], default: str) -> str:
    """``#constant.rest`` with the constant's value; a leading dot takes the default name space."""
    if name.startswith("#"):
        head, _, rest = name[1:].partition(".")
        return f"{constants[head]}.{rest}" if rest else constants[head]
    return default + name if name.startswith(".") else name


def build(spec: Mapping | str) -> MappingRules:
    """Rules of a mapping file's content, in the order in which they are tried.

    An entry whose layer is an object maps whole layers: target to source, or with an
    empty one the entry's name in both default name spaces. Otherwise the layer, or else
    the entry's name, is the target, and each feature's labels tell their source layers
    and predicates.
    """
    spec = json.loads(spec) if isinstance(spec, str) else spec
    constants = spec.get("IDENTIFIER_CONSTANTS", {})
    body = spec["MAPPING"]
    given = body.get("IDENTIFIER", {})
    source_default, target_default = (expand(given.get(k, ""), constants, "") for k in ("source_default", "target_default"))
    rules: list[Rule] = []
    for key, value in body["ENTRIES"].items():
        named = [(f"{key}_{i}", e) for i, e in enumerate(value)] if isinstance(value, list) else [(key, value)]
        for name, entry in named:
            layer, features = entry.get("layer"), entry.get("features", {})
            if isinstance(layer, dict):
                for target, source in (layer or {f".{name}": f".{name}"}).items():
                    rules.append(Rule(expand(source, constants, source_default), expand(target, constants, target_default), name, "", dict(features)))
                continue
            target = expand(layer or f".{name}", constants, target_default)
            for feature, labels in features.items():
                if not isinstance(labels, dict):
                    warnings.warn(f"{name}.{feature} has no labels", stacklevel=2)
                    continue
                for label, how in labels.items():
                    sources = how.get("layer", f".{label}")
                    for source in sources if isinstance(sources, list) else [sources]:
                        rules.append(Rule(expand(source, constants, source_default), target, label, how.get("feature", ""), dict(how.get("add_feature", {})), feature, int(how.get("prio", 0))))
    return MappingRules(rules)


def validate(mapping: MappingRules) -> None:
    """Single-layer rules of several target layers compete, which is an error; no rules are as well."""
    if not mapping.rules:
        raise ValueError("the mapping has no target layer")
    single = {r.target for r in mapping.rules if r.feature}
    if len(single) > 1:
        raise ValueError(f"target layers compete: {sorted(single)}")
    if len(mapping.targets()) > 1:
        warnings.warn("the mapping has several target layers", stacklevel=2)


def predicate(text: str, features: Column, kind: Column | None = None) -> Column:
    """``@f==a|b``: the feature is one of these in any case, null and empty being ``none``; ``@f``: it isn't null; empty: true."""
    if not text:
        return F.lit(True)
    name, equals, values = text.lstrip("@").partition("==")
    value = kind if kind is not None and name == "kind" else F.try_element_at(features, F.lit(name))
    if not equals:
        return value.isNotNull()
    said = F.lower(F.when(value.isNull() | (value == ""), "none").otherwise(value))
    return F.coalesce(said.isin(*[v.strip().lower() for v in values.split("|")]), F.lit(False))


def projected(rule: Rule, features: Column) -> Column:
    """The rule's features: ``$X`` is the constant X, other values name a source feature."""
    entries = [x for k, v in rule.features.items() for x in (F.lit(k), F.lit(v[1:]) if v.startswith("$") else F.try_element_at(features, F.lit(v)))]
    return F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")


def apply(annotations: DataFrame, mapping: MappingRules, online: bool = False, ancestors: DataFrame | None = None) -> DataFrame:
    """Annotations of the target schema: type, ``label`` and features of the first rule that is true.

    ``annotations`` has type and features. Without a true rule the label is ``none``, or
    with ``online`` the row is dropped. With ``ancestors`` (type, ancestor) a source
    layer takes its subtypes too. Types without rules are dropped.
    """
    rows = annotations
    if ancestors is not None:
        known = ancestors.where(F.col("ancestor").isin(*mapping.sources())).select(F.col("type").alias("_type"), F.col("ancestor").alias("_layer"))
        rows = rows.join(known, rows["type"] == known["_type"]).drop("_type")
    else:
        rows = rows.withColumn("_layer", F.col("type"))
    features = F.col("features")
    target = label = copied = None
    for source in mapping.sources():
        own = [r for r in mapping.rules if r.source == source]
        chain_label, chain_features = F.lit(None).cast("string"), F.create_map().cast("map<string,string>")
        for r in reversed(own):
            test = predicate(r.predicate, features)
            chain_label = F.when(test, F.lit(r.label)).otherwise(chain_label)
            chain_features = F.when(test, projected(r, features)).otherwise(chain_features)
        here = F.col("_layer") == source
        target = F.when(here, own[0].target) if target is None else target.when(here, own[0].target)
        label = F.when(here, chain_label) if label is None else label.when(here, chain_label)
        copied = F.when(here, chain_features) if copied is None else copied.when(here, chain_features)
    if target is None:
        return annotations.limit(0).withColumn("label", F.lit(None).cast("string"))
    out = rows.withColumn("_target", target).where("_target IS NOT NULL").withColumn("label", label).withColumn("features", copied)
    out = out.where("label IS NOT NULL") if online else out.na.fill("none", ["label"])
    return out.withColumn("type", F.col("_target")).drop("_target", "_layer")


def most_specific(annotations: DataFrame, by: Sequence[str] = ("doc", "type", "begin", "end"), order: str = "ann_id") -> DataFrame:
    """Of annotations at one place, layer and kind, that with the fewest empty features, the first on a tie."""
    empty = F.size(F.filter(F.map_values("features"), lambda v: v.isNull()))
    kind = F.coalesce(F.try_element_at(F.col("features"), F.lit("kind")), F.col("type"))
    first = Window.partitionBy(*by, kind).orderBy(empty, order)
    return annotations.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def type_closure(types: DataFrame, most: int = 64) -> DataFrame:
    """(type, ancestor) of every type and all above it, itself included; ``types`` has (type, supertype)."""
    up = types.select(F.col("type").alias("_t"), F.col("supertype").alias("_s")).where("_s IS NOT NULL")
    reached = frontier = types.select("type", F.col("type").alias("ancestor"))
    for _ in range(most):
        frontier = frontier.join(up, frontier["ancestor"] == up["_t"]).select("type", F.col("_s").alias("ancestor"))
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached.distinct()


def merge_types(old: DataFrame, new: DataFrame) -> DataFrame:
    """Features of both type systems (type, feature, range); one feature with two ranges is an error."""
    every = old.unionByName(new).distinct()
    clash = every.groupBy("type", "feature").agg(F.countDistinct("range").alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"{clash[0]['type']}.{clash[0]['feature']} has two ranges")
    return every
