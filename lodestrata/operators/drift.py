"""Files whose fields change over time: one consistent table and a list of every change, by tagged-union inference.

Every file is reduced to its schema: each path with the alternative (JSON type) it has there, nested objects and arrays
included, and a print of the value. The schemas are fused: a path keeps all its alternatives side by side, each value
comes out in the branch of its own type plus one canonical conversion. Nothing is coerced away, and a conflict is never
settled by majority. Changes are differences between the schemas of neighbouring files, and alternatives that appear.

Which names stand for one field is learned from all files, without a word list. A name that goes in the file in which
another comes is a candidate; what speaks for it is that their values agree (numbers of like size, texts of one shape,
objects with the same members, whatever the alternative) and that the names share words or parts of words. What speaks
against it is that both names ever stand in one file beyond a small share. Accepted pairs are joined to fields, the
strongest first, as long as no two names of a field stand together.

Series are of very uneven length, so the files are *range*-partitioned by (series, time, id): a long series is cut into
segments that different tasks scan in order. A task keeps the last file's schema and, per field, the last known type; for
the segment's first file it emits the segment's head, for its last file the state it ends in. The heads and ends, at most
two per task, are then chained per series, and what they decide is added. Candidates are counted on the map side; what
comes to the driver is the pairs that reach ``LEAST``, at most ``MAX_PAIRS``, and the counts of their names side by side.

Defined results: a payload that is null or no JSON object is not readable: it takes no part in the comparisons and
comes out with ``readable`` false; a field that is null is present without a type; a byte order mark and white space
around the object don't matter; of a repeated key in one object the last one counts; equal times are ordered by id;
members are compared while their parent is an object in both files; an empty table gives empty results.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.lineage import cut

#: Stands between the members of a path; elements of an array are the member ``[]``.
SEP, ELEMENT = "\x1f", "[]"
#: A pair of names is one field from this sum of value agreement and likeness of names on.
LEAST = 0.75
#: Share of the rarer name's files that may hold both names of a field.
TOGETHER = 0.02
MAX_PAIRS = 200_000
#: Texts of a value that its print keeps, those with the smallest hash.
PRINTS = 64


def json_type(value: object) -> str | None:
    if value is None:
        return None
    for kind, name in ((bool, "boolean"), (int, "integer"), (float, "number"), (str, "string"), (list, "array")):
        if isinstance(value, kind):
            return name
    return "object"


def read_object(payload: str | None) -> dict | None:
    """The payload's object, or None where it isn't one."""
    try:
        value = json.loads((payload or "").strip("﻿ \t\r\n"))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


_GROUPED = re.compile(r"[+-]?\d{1,3}(?:([ '  ])\d{3}(?:\1\d{3})*|([.,])\d{3}(?:\2\d{3})+)|[+-]?\d+")
#: One group after a point or comma: a whole number or one with decimals, which only the field's other values tell.
_EITHER = re.compile(r"[+-]?\d{1,3}[.,]\d{3}")


def canonical_value(value: object, members: tuple[str, ...] = ()) -> str | None:
    """One spelling per meaning: 1904.0, "1'904" and 1904 are ``1904``, paths have forward slashes; a text such as
    ``1.904`` stays, as it may be either number. Of an object its first member named in ``members``, of an array with one
    element that element; else their JSON."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return str(int(value)) if value == value and abs(value) < 1e15 and value == int(value) else repr(value)
    if isinstance(value, str):
        text = value.strip()
        return re.sub(r"[^\d+-]", "", text) if _GROUPED.fullmatch(text) else value.replace("\\", "/")
    if isinstance(value, dict):
        for key in members:
            if key in value:
                return canonical_value(value[key], members)
    if isinstance(value, list) and len(value) == 1:
        return canonical_value(value[0], members)
    return str(value) if isinstance(value, int) else json.dumps(value, sort_keys=True, ensure_ascii=False)


@lru_cache(maxsize=100_000)
def _scalar_texts(kind: type, value: object) -> tuple[str, ...]:
    if kind is bool or kind is str and value.strip().lower() in ("true", "false"):
        return ("?",)
    text = canonical_value(value)
    if _EITHER.fullmatch(text):
        return (f"={re.sub('[.,]', '', text)}", f"={text.replace(',', '.')}")
    if re.fullmatch(r"[+-]?\d+(?:\.\d+)?(?:e[+-]?\d+)?", text):
        return (f"={text}",)
    shape = re.sub(r"\d+", "#", text.lower())
    return (shape if len(shape) <= PRINTS else f"{len(shape)}:{zlib.crc32(shape.encode('utf-8', 'surrogatepass'))}",)


def _texts(value: object) -> Iterator[str]:
    """What a value is recognised by: ``=`` and a number, ``?`` for a flag, the shape of a text, names of members."""
    if isinstance(value, dict):
        for k, v in value.items():
            if not k.isdigit():
                yield k.lower()
            yield from _texts(v)
    elif isinstance(value, list):
        if len(value) > 1 and all(isinstance(x, (int, str)) for x in value):
            yield from _texts(".".join(map(str, value)))
        for x in value:
            yield from _texts(x)
    elif value is not None:
        yield from _scalar_texts(type(value), value)


def _print(value: object) -> list[str]:
    texts = set(_texts(value))
    return list(texts) if len(texts) < 2 else sorted(texts, key=lambda t: (zlib.crc32(t.encode("utf-8", "surrogatepass")), t))[:PRINTS]


def prints_of(fields: dict) -> dict[str, list[str]]:
    """Key -> print of its value."""
    plain = lambda v: [] if v is None else list(_scalar_texts(type(v), v))
    return {k.replace(SEP, " "): _print(v) if isinstance(v, (dict, list)) else plain(v) for k, v in fields.items()}


def schema_of(fields: dict) -> dict[str, str | None]:
    """Path -> alternative of every member; elements of one array share a path and join their alternatives."""
    out: dict[str, str | None] = {}

    def walk(path: str, value: object) -> None:
        t = json_type(value)
        if path in out and (path.endswith(ELEMENT) or f"{SEP}{ELEMENT}{SEP}" in path):
            t = "|".join(sorted({x for x in (out[path] or "").split("|") + [t or ""] if x})) or None
        out[path] = t
        if isinstance(value, dict):
            for k, v in value.items():
                walk(f"{path}{SEP}{k}", v)
        elif isinstance(value, list):
            for v in value:
                walk(f"{path}{SEP}{ELEMENT}", v)

    for key, value in fields.items():
        walk(key.replace(SEP, " "), value)
    return out


@lru_cache(maxsize=100_000)
def _words(name: str) -> tuple[str, ...]:
    words = re.findall(r"[^\W\d_]+(?<![a-z])(?=[A-Z][a-z])|[A-Z]+(?![a-z])|[A-Z]?[^\W\dA-Z_]+|\d+", re.sub(r"[\W_]+", " ", name))
    return tuple(w.lower() for w in words) or (name.lower(),)


@lru_cache(maxsize=100_000)
def name_likeness(a: str, b: str) -> float:
    """Share of the words of two names that they have in common, whatever order and case, half-alike words in part."""
    x, y = _words(a), _words(b)
    scored = sorted(((SequenceMatcher(None, p, q).ratio(), i, j) for i, p in enumerate(x) for j, q in enumerate(y)), reverse=True)
    left, right, total = set(range(len(x))), set(range(len(y))), 0.0
    for r, i, j in scored:
        if r >= 0.5 and i in left and j in right:
            left.discard(i)
            right.discard(j)
            total += r
    return total / max(len(x), len(y))


def agreement(a: list[str], b: list[str]) -> float:
    """How well two prints go together, 0 to 1."""
    texts = {t for t in a if t[0:1] not in ("=", "?")} & {t for t in b if t[0:1] not in ("=", "?")}
    if any(len(t) > 1 for t in texts):
        return 1.0
    best = 0.4 if "?" in a and "?" in b else 0.0
    for x in (float(t[1:]) for t in a if t[0] == "="):
        for y in (float(t[1:]) for t in b if t[0] == "="):
            near = x == y or x * y > 0 and max(x / y, y / x) <= 1.5
            best = max(best, (0.8 if x == y else 0.6) if near else 0.0)
    return best


Schema = dict[str, str | None]


def _levels(schema: Schema) -> dict[str, dict[str, str]]:
    """Parent path -> member name -> path."""
    out: dict[str, dict[str, str]] = {}
    for path in schema:
        parent, _, name = path.rpartition(SEP)
        out.setdefault(parent, {})[name] = path
    return out


def compare(before: Schema, after: Schema, names: dict[str, str]) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """Changes (path, change) between two schemas, and old path by new path of the fields that go on.

    ``names`` maps names to the field they stand for; a name that it lacks stands for itself."""
    if before.keys() == after.keys():
        return [], dict(zip(after, after, strict=True))
    old_levels, new_levels = _levels(before), _levels(after)
    changes, onward, todo = [], {}, [("", "")]
    while todo:
        was, now = todo.pop()
        old, new = old_levels.get(was, {}), new_levels.get(now, {})
        gone = {names.get(k, k): k for k in sorted(old, reverse=True) if k not in new}
        left = {k for k in old if k not in new}
        for k, path in new.items():
            source = k if k in old else gone.pop(names.get(k, k), None)
            if source is None:
                changes.append((path, "added"))
                continue
            if source != k:
                changes.append((path, "renamed"))
                left.discard(source)
            onward[path] = old[source]
            if before[old[source]] == after[path] and after[path] in ("object", "array"):
                todo.append((old[source], path))
        changes += [(old[k], "removed") for k in sorted(left)]
    return changes, onward


def _schemas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        objects = [read_object(p) for p in batch.pop("payload")]
        batch["readable"] = [o is not None for o in objects]
        batch["schema"] = [None if o is None else json.dumps(schema_of(o)) for o in objects]
        batch["prints"] = [None if o is None else json.dumps(prints_of(o)) for o in objects]
        yield batch


def file_schemas(df: DataFrame, id_col: str, series_col: str, time_col: str, payload_col: str) -> DataFrame:
    """``series``, ``at``, ``file_id``, ``readable``, ``schema``, ``prints``: every file's alternatives by path and prints by key,
    as JSON; written once."""
    files = df.select(
        F.coalesce(df[series_col].cast("string"), F.lit("")).alias("series"), df[time_col].alias("at"), df[id_col].alias("file_id"), df[payload_col].alias("payload")
    )
    types = {f.name: f.dataType.simpleString() for f in files.schema.fields}
    return cut(files.mapInPandas(_schemas, f"series string, at {types['at']}, file_id {types['file_id']}, readable boolean, schema string, prints string"))


def _ranged(schemas: DataFrame, partitions: int | None, column: str) -> DataFrame:
    key = ["series", "at", "file_id"]
    good = schemas.filter("readable").select(*key, column)
    ranged = good.repartitionByRange(partitions, *key) if partitions else good.repartitionByRange(*key)
    return ranged.sortWithinPartitions(*key).select("series", "file_id", column)


# -- which names are one field


class _Handovers:
    """Counts pairs of a name that goes and one that comes in the same file."""

    def __init__(self) -> None:
        self.pairs: Counter = Counter()
        self.compared: Counter = Counter()
        self.agreed: Counter = Counter()

    def step(self, last: dict[str, list[str]], before: set[str], after: dict[str, list[str]]) -> None:
        for a in before - after.keys():
            for b in after.keys() - before:
                pair = (min(a, b), max(a, b))
                self.pairs[pair] += 1
                if last.get(a) and after[b]:
                    self.compared[pair] += 1
                    self.agreed[pair] += agreement(last[a], after[b])

    def rows(self) -> list[tuple]:
        return [(a, b, n, self.compared[a, b], self.agreed[a, b], name_likeness(a, b)) for (a, b), n in self.pairs.items()]


_PAIRS = "a string, b string, n bigint, compared bigint, agreed double, likeness double"
_HAND = "kind string, series string, part bigint, state string, " + _PAIRS


def _handovers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part, series, found = TaskContext.get().partitionId(), None, _Handovers()
    last: dict[str, list[str]] = {}
    before: set[str] = set()
    none = (None,) * 6
    columns = [c.split()[0] for c in _HAND.split(", ")]
    for batch in batches:
        out = []
        for s, prints in zip(batch["series"], batch["prints"], strict=True):
            now = json.loads(prints)
            if s == series:
                found.step(last, before, now)
            else:
                if series is not None:
                    out.append(("end", series, part, json.dumps([last, sorted(before)]), *none))
                out.append(("head", s, part, json.dumps(now), *none))
                series, last = s, {}
            last = {k: v or last.get(k, []) for k, v in now.items()}
            before = set(now)
        if out:
            yield pd.DataFrame(out, columns=columns)
    out = [("pair", None, None, None, *r) for r in found.rows()]
    if series is not None:
        out.append(("end", series, part, json.dumps([last, sorted(before)]), *none))
    yield pd.DataFrame(out, columns=columns)


def _handovers_at_cuts(rows: pd.DataFrame) -> pd.DataFrame:
    found, state = _Handovers(), None
    for _, segment in rows.groupby("part", sort=True):
        by_kind = dict(zip(segment["kind"], segment["state"], strict=True))
        if state is not None:
            found.step(state[0], set(state[1]), json.loads(by_kind["head"]))
        state = json.loads(by_kind["end"])
    return pd.DataFrame(found.rows(), columns=[c.split()[0] for c in _PAIRS.split(", ")])


def _several(segments: DataFrame) -> DataFrame:
    """Heads and ends of the series that were cut."""
    twice = segments.filter("kind = 'head'").groupBy("series").count().filter("count > 1").select("series")
    return segments.join(twice, "series", "left_semi")


def joined_names(pairs: list[tuple[str, str, float]], files: dict[str, int], both: dict[tuple[str, str], int]) -> dict[str, str]:
    """Name -> the field's most frequent name, from scored pairs, files per name and files with both names of a pair."""
    member = {x: {x} for a, b, _ in pairs for x in (a, b)}
    for a, b, _ in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        one, two = member[a], member[b]
        if one is two:
            continue
        if all(both.get((min(x, y), max(x, y)), 0) <= TOGETHER * min(files.get(x, 0), files.get(y, 0)) for x in one for y in two):
            one |= two
            for x in two:
                member[x] = one
    return {x: min(xs, key=lambda y: (-files.get(y, 0), y)) for x, xs in member.items() if len(xs) > 1}


def _count_pairs(sets_: Counter, together: Counter) -> None:
    """Adds the pairs of each set of names, and each name with itself, and empties the sets."""
    for own, n in sets_.items():
        for a in own:
            together[a, a] += n
        for pair in combinations(own, 2):
            together[pair] += n
    sets_.clear()


def learn_names(schemas: DataFrame, partitions: int | None = None) -> dict[str, str]:
    """Name -> field, of the names that stand for a field with several names; counted over all files of ``file_schemas``."""
    scanned = cut(_ranged(schemas, partitions, "prints").mapInPandas(_handovers, _HAND))
    at_cuts = _several(scanned.filter("kind <> 'pair'").select("kind", "series", "part", "state")).groupBy("series").applyInPandas(_handovers_at_cuts, _PAIRS)
    counted = scanned.filter("kind = 'pair'").select("a", "b", "n", "compared", "agreed", "likeness").unionByName(at_cuts)
    total = counted.groupBy("a", "b").agg(F.sum("compared").alias("c"), F.sum("agreed").alias("g"), F.max("likeness").alias("likeness"))
    score = F.col("likeness") + F.when(F.col("c") > 0, F.col("g") / F.col("c")).otherwise(F.lit(0.0))
    good = total.withColumn("score", score).filter(F.col("score") >= LEAST).select("a", "b", "score").limit(MAX_PAIRS + 1).collect()
    if len(good) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of names change places: the keys are no field names")
    if not good:
        return {}
    wanted = schemas.sparkSession.sparkContext.broadcast(frozenset(x for r in good for x in (r["a"], r["b"])))

    def side_by_side(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets_: Counter = Counter()
        together: Counter = Counter()
        for batch in batches:
            for prints in batch["prints"]:
                own = tuple(sorted(k for k in json.loads(prints) if k in wanted.value))
                sets_[own] += 1
            if len(sets_) > 10_000:
                _count_pairs(sets_, together)
        _count_pairs(sets_, together)
        yield pd.DataFrame([(*p, n) for p, n in together.items()], columns=["a", "b", "n"])

    rows = schemas.filter("readable").select("prints").mapInPandas(side_by_side, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    both = {(r["a"], r["b"]): r["n"] for r in rows}
    return joined_names([tuple(r) for r in good], {a: n for (a, b), n in both.items() if a == b}, both)


# -- changes


_SCAN = "series string, part bigint, kind string, file_id bigint, field string, change string, before string, after string, state string"


def _scan(names: dict[str, str]) -> Callable:
    """One pass over the sorted files of a partition; see the module's description for the kinds of rows.

    ``state`` maps each path to [last known type or None, the path it goes back to in the segment's head or None].
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        series, facts, state, order = None, {}, {}, 0
        for batch in batches:
            out: list[tuple] = []
            for s, file_id, schema in zip(batch["series"], batch["file_id"], batch["schema"], strict=True):
                now = json.loads(schema)
                if s != series:
                    if series is not None:
                        out.append((series, part, "end", order, None, None, None, None, json.dumps([facts, state])))
                    series, order = s, file_id
                    state = {k: [t, k] for k, t in now.items()}
                    out.append((s, part, "head", file_id, None, None, None, None, json.dumps(now)))
                else:
                    changes, onward = compare(facts, now, names)
                    out += [(s, part, "change", file_id, k, c, None, None, None) for k, c in changes]
                    fresh = {}
                    for k, t in now.items():
                        if k not in onward:
                            fresh[k] = [t, None]
                            continue
                        last, root = state[onward[k]]
                        if t is not None and last is not None and t != last:
                            out.append((s, part, "change", file_id, k, "type_changed", last, t, None))
                        elif t is not None and last is None and root is not None:
                            out.append((s, part, "pending", file_id, k, root, None, t, None))
                        fresh[k] = [t or last, root]
                    state = fresh
                facts = now
            if out:
                yield _rows(out)
        if series is not None:
            yield _rows([(series, part, "end", order, None, None, None, None, json.dumps([facts, state]))])

    return run


def _rows(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["series", "part", "kind", "file_id", "field", "change", "before", "after", "state"])


_CHANGES = "file_id bigint, series string, field string, change string, before string, after string"


def _chain(names: dict[str, str]) -> Callable:
    """Links the segments of one series in order: changes at the cuts, and types that were pending."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        state: dict | None = None
        facts: dict = {}
        for _, segment in rows.groupby("part", sort=True):
            head = segment[segment["kind"] == "head"].iloc[0]
            now = json.loads(head["state"])
            types: dict[str, str | None] = {}
            if state is None:
                types = {k: None for k in now}
            else:
                changes, onward = compare(facts, now, names)
                out += [(head["file_id"], head["series"], k, c, None, None) for k, c in changes]
                for k, t in now.items():
                    types[k] = state[onward[k]] if k in onward else None
                    if t is not None and types[k] is not None and t != types[k]:
                        out.append((head["file_id"], head["series"], k, "type_changed", types[k], t))
            for x in segment[segment["kind"] == "pending"].itertuples():
                last = types.get(x.change)
                if last is not None and now[x.change] is None and last != x.after:
                    out.append((x.file_id, x.series, x.field, "type_changed", last, x.after))
            facts, own = json.loads(segment[segment["kind"] == "end"].iloc[0]["state"])
            state = {k: t if t is not None else types.get(root) if root is not None else None for k, (t, root) in own.items()}
        return pd.DataFrame(out, columns=["file_id", "series", "field", "change", "before", "after"])

    return run


def _shown(path: Column) -> Column:
    return F.replace(path, F.lit(SEP), F.lit("."))


def field_changes(schemas: DataFrame, names: dict[str, str], partitions: int | None = None) -> DataFrame:
    """``file_id``, ``series``, ``field``, ``level``, ``change``, ``before``, ``after``: every change between a file and the one
    before it, from the schemas of ``file_schemas``.

    ``change`` is added, removed, renamed or type_changed; ``before`` and ``after`` are the types of a changed type;
    ``level`` is 1 for a key of the file's object and more for members, whose ``field`` is their path with points.
    """
    scanned = cut(_ranged(schemas, partitions, "schema").mapInPandas(_scan(names), _SCAN))
    inside = scanned.filter("kind = 'change'").select("file_id", "series", "field", "change", "before", "after")
    linked = _several(scanned.filter("kind <> 'change'")).groupBy("series").applyInPandas(_chain(names), _CHANGES)
    return inside.unionByName(linked).select("file_id", "series", _shown(F.col("field")).alias("field"), F.size(F.split("field", SEP)).alias("level"), "change", "before", "after")


# -- the union


_LONG = "file_id bigint, series string, at timestamp, readable boolean, field string, level int, concept string, type string, canonical string, v_string string, v_integer bigint, v_number double, v_boolean boolean, v_array string, v_object string"


def _members(fields: dict) -> Iterator[tuple[str, int, object]]:
    """(path, level, value) of every member, parents first; elements of arrays once per alternative, without value."""
    todo = [(k.replace(SEP, " "), 1, v) for k, v in reversed(fields.items())]
    while todo:
        path, level, value = todo.pop()
        yield path, level, value
        if isinstance(value, dict):
            todo += [(f"{path}{SEP}{k}", level + 1, v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            for t in sorted({json_type(v) or "" for v in value}):
                yield f"{path}{SEP}{ELEMENT}", level + 1, _Element(t or None)


class _Element:
    def __init__(self, kind: str | None) -> None:
        self.kind = kind


def union_fields(df: DataFrame, id_col: str, series_col: str, time_col: str, payload_col: str, names: dict[str, str], members: tuple[str, ...] = ()) -> DataFrame:
    """One row per file and path: its field, its type as the tag, the value in that type's branch and a canonical text.

    ``members``: names of the member that states an object's value where the same field is a plain value elsewhere."""
    files = df.select(df[series_col].cast("string").alias("series"), df[time_col].cast("timestamp").alias("at"), df[id_col].alias("file_id"), df[payload_col].alias("payload"))
    columns = [c.split()[0] for c in _LONG.split(", ")]

    def branches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for s, at, file_id, payload in zip(batch["series"], batch["at"], batch["file_id"], batch["payload"], strict=True):
                fields = read_object(payload)
                if fields is None:
                    out.append((file_id, s, at, False) + (None,) * 11)
                    continue
                for path, level, v in _members(fields):
                    top, _, rest = path.partition(SEP)
                    concept = (names.get(top, top) + SEP + rest if rest else names.get(top, top)).replace(SEP, ".")
                    if isinstance(v, _Element):
                        out.append((file_id, s, at, True, path.replace(SEP, "."), level, concept, v.kind) + (None,) * 7)
                        continue
                    t = json_type(v)
                    big = t == "integer" and not -(1 << 63) <= v < 1 << 63
                    out.append((
                        file_id, s, at, True, path.replace(SEP, "."), level, concept, t, canonical_value(v, members),
                        v if t == "string" else None, v if t == "integer" and not big else None,
                        float(v) if t == "number" or big and abs(v) < 1 << 1000 else None, v if t == "boolean" else None,
                        json.dumps(v, ensure_ascii=False) if t == "array" else None, json.dumps(v, ensure_ascii=False) if t == "object" else None,
                    ))
            table = pd.DataFrame(out, columns=columns)
            table["v_integer"] = table["v_integer"].astype("Int64")
            table["level"] = table["level"].astype("Int32")
            table["v_boolean"] = table["v_boolean"].astype("boolean")
            table["v_number"] = table["v_number"].astype("Float64")
            table["readable"] = table["readable"].astype("boolean")
            yield table

    return files.mapInPandas(branches, _LONG)


def union_schema(fields: DataFrame) -> DataFrame:
    """The fused schema: per path and alternative, the names it goes by, the number of files, the first and last file."""
    return fields.filter("readable").groupBy("concept", F.coalesce("type", F.lit("null")).alias("type")).agg(
        F.array_join(F.sort_array(F.collect_set("field")), ", ").alias("names"),
        F.count(F.lit(1)).alias("n_files"), F.min("file_id").alias("first_file"), F.max("file_id").alias("last_file"),
    )


def appearing_alternatives(fields: DataFrame) -> DataFrame:
    """Per series and path each alternative after the first, with the file in which it appears, by time and id, the
    alternatives that were there before it, and in how many files it stands. Nulls are no alternative."""
    order = F.struct("at", "file_id")
    each = fields.filter("readable and type is not null").groupBy("series", "concept", "type").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("n_files"))
    all_ = each.groupBy("series", "concept").agg(F.array_sort(F.collect_list(F.struct("o", "type", "n_files"))).alias("l")).filter("size(l) > 1")
    rows = all_.select("series", "concept", "l", F.posexplode("l").alias("p", "x")).filter("p > 0")
    earlier = F.array_join(F.transform(F.slice("l", 1, F.col("p")), lambda y: y["type"]), "|")
    return rows.select("series", "concept", F.col("x.type").alias("type"), F.col("x.o.file_id").alias("first_file"), earlier.alias("earlier"), F.col("x.n_files").alias("n_files"))


def consistent_table(fields: DataFrame, max_columns: int = 500) -> DataFrame:
    """One row per file, one column per field and its tag beside it; more fields than ``max_columns`` is an error,
    as then the long form is the table to use. The list of fields is all that comes to the driver.

    A text such as ``1.904`` is the whole number where the field has whole numbers and none with decimals. Where one file
    has several keys of a field, value and tag are those of one key, the first by name that isn't null; ``further_keys``
    holds the others with their values and tags."""
    top = fields.filter("not readable or level = 1")
    whole = F.bool_or(F.col("type") == "integer") & ~F.coalesce(F.bool_or(F.col("v_number") != F.floor("v_number")), F.lit(False))
    found = top.filter("readable").groupBy("concept").agg(whole.alias("whole")).limit(max_columns + 1).collect()
    if len(found) > max_columns:
        raise ValueError(f"more than {max_columns} fields; use union_fields")
    tag = F.coalesce("type", F.lit("null"))
    numbers = [r["concept"] for r in found if r["whole"]]
    grouped = F.col("concept").isin(*numbers) & F.col("canonical").rlike(rf"^{_EITHER.pattern}\z")
    top = top.withColumn("canonical", F.when(grouped, F.regexp_replace("canonical", "[.,]", "")).otherwise(F.col("canonical")))
    key = F.struct(F.col("canonical").isNull().alias("missing"), "concept", "field", tag.alias("type"), F.coalesce("canonical", F.lit("")).alias("text"))
    cells, used = [], Counter({"file_id": 1, "series": 1, "readable": 1, "further_keys": 1})
    for c in sorted(r["concept"] for r in found):
        name = re.sub(r"\W+", "_", c)
        while used[name.lower()] or used[f"{name}__type".lower()]:
            name += "_"
        used.update((name.lower(), f"{name}__type".lower()))
        first = F.min_by(F.struct("canonical", tag.alias("type")), F.when(F.col("concept") == c, key))
        cells += [first["canonical"].alias(name), first["type"].alias(f"{name}__type")]
    keys = F.collect_list(F.when(F.col("concept").isNotNull(), key))
    wide = top.groupBy("file_id", "series").agg(F.max("readable").alias("readable"), *cells, F.array_sort(keys).alias("further_keys"))
    later = F.filter("further_keys", lambda x: F.exists("further_keys", lambda y: (y["concept"] == x["concept"]) & (y < x)))
    shown = F.transform(later, lambda x: F.struct(x["concept"].alias("concept"), x["field"].alias("field"), x["type"].alias("type"), F.when(~x["missing"], x["text"]).alias("canonical")))
    return wide.withColumn("further_keys", shown)
