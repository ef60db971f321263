"""Rules, word lists and settings from YAML or JSON text: checked, merged, and turned into small tables."""

from __future__ import annotations

import copy
import json

from pyspark.sql import DataFrame, SparkSession

try:
    import yaml
except ImportError:
    yaml = None


def load_text(text: str) -> tuple[dict, list[str]]:
    """(mapping, keys given more than once) of a YAML or JSON text."""
    twice: list[str] = []

    def pairs(items: list[tuple[str, object]]) -> dict:
        out: dict = {}
        for k, v in items:
            if k in out:
                twice.append(str(k))
            out[k] = v
        return out

    if yaml is None or text.lstrip()[:1] in "{[":
        return json.loads(text, object_pairs_hook=pairs), twice

    class Loader(yaml.SafeLoader):
        pass

    def mapping(loader: Loader, node: object) -> dict:
        loader.flatten_mapping(node)
        return pairs([(loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value])

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return yaml.load(text, Loader) or {}, twice  # noqa: S506


def merged(defaults: dict, own: dict | None) -> dict:
    """Defaults overlaid with one's own settings, level by level; lists and scalars are replaced."""
    out = copy.deepcopy(defaults)
    for k, v in (own or {}).items():
        out[k] = merged(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else copy.deepcopy(v)
    return out


def rule_table(spark: SparkSession, rules: list[dict], columns: list[str]) -> DataFrame:
    """Ordered rules as a table with ``rule_order``; patterns in lower case."""
    rows = [(i, *[str(r.get(c)).lower() if c == "pattern" else (None if r.get(c) is None else str(r[c])) for c in columns]) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_order int, " + ", ".join(f"`{c}` string" for c in columns))


def keyword_lists(raw: dict[str, dict[str, list[str]] | list[str]]) -> dict[str, list[str]]:
    """Per category the keywords of all languages, once each, longest first."""
    out = {}
    for category, by_lang in raw.items():
        words = {w.lower() for ws in (by_lang.values() if isinstance(by_lang, dict) else [by_lang]) for w in ws}
        out[category] = sorted(words, key=lambda w: (-len(w), w))
    return out


def checked_types(lexicon: dict[str, list[str]], known: tuple[str, ...]) -> dict[str, list[str]]:
    """The lexicon; a type that isn't known is an error."""
    unknown = sorted(set(lexicon) - set(known))
    if unknown:
        raise ValueError(f"unknown types: {', '.join(unknown)}")
    return lexicon
