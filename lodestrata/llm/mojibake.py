"""Text that was decoded with the wrong character set: finding and restoring it.

A smoothed character trigram model is trained on the clean values of the table itself. For a value with characters
outside ASCII every encode-decode chain is scored: up to ``MAX_DEPTH`` readings as UTF-8 from any of the character sets,
each of any result of the ones before, and after each of these, or without, one reading from one single-byte set to
another. The likeliest text is taken if it beats the value as it stands by a margin. The margin is validated on all clean
values, as they are and damaged on purpose by a chain that the value's hash chooses out of all. What no chain restores
still counts as damaged where it holds characters that only decoding errors leave (replacement characters, C1 controls).

Nothing is cut by a beam. Left out is only what can't win: a chain changes no trigram without a character outside ASCII
and no trigram is likelier than certain, so a value whose other trigrams cost less than the cheapest chain and the margin
is sound; chains that map a value's characters alike are scored once; a result with a symbol, a control character or two
scripts in one word is no reading.

A chain reads: the text's characters are bytes of ``wrong``, meant as ``right``. For ``right`` = UTF-8 only whole
multi-byte sequences are decoded, wherever they stand, so partly damaged text is restored in part.

Shape of the job: values are judged once per *distinct* value. The model is a table of hashed n-gram counts of at most
``BUCKETS`` entries in all, whatever the size of the data; only that comes to the driver and goes to the executors.
The margin comes from a histogram of gains of fixed size. Verdicts of damaged values are joined back to the rows by
value, salted.

Defined results: null, empty and plain-ASCII values are never damaged; invisible characters, odd spaces, capitals,
genuine accents and other scripts are no damage; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.lineage import cut
from lodestrata.skew import salted_join

#: Buckets of hashed n-grams; the bound of what is collected and broadcast.
BUCKETS = 1 << 20
#: Log-likelihood that a chain must make up for: one that decodes UTF-8, and one from single-byte to single-byte set.
UTF8_COST, SINGLE_COST = 2.0, 4.0
MIN_MARGIN, MAX_DEPTH = 0.5, 4
#: Margins that are tried: so many, so far apart.
MARGIN_STEPS, MARGIN_STEP = 15, 0.5
#: Character sets that text is mistaken for, and single-byte ones it may have been in.
WRONG = ("cp1252", "cp1250", "cp1253", "iso8859_7", "iso8859_2", "mac_roman", "cp437", "cp850", "cp852", "cp737", "cp1251")
RIGHT = ("cp1252", "cp1250", "cp1253", "iso8859_7", "iso8859_2", "mac_roman", "cp850", "cp1251")
_LEFT_OVER = re.compile("[\x80-\x84\x86-\x9f\ufffd]")
#: What text in European languages is made of; a decoding that yields anything else is none.
_PLAUSIBLE = "\x80-\u024f\u0370-\u03ff\u0400-\u045f\u1e00-\u1fff\u2010-\u2044\u20ac\u2116\u2122"
_IMPLAUSIBLE = re.compile(f"[^\x00-\x7f{_PLAUSIBLE}]")
_SYMBOL = re.compile("[\xa1-\xa9\xac-\xb9\xbc-\xbf\xd7\xf7\u0131\u02b0-\u036f\u0384\u0385\u2016\u2017\u201a\u201e-\u2044\u20a0-\u2bff\ufb00-\ufb06]")
#: A letter a with grave accent whose second byte, a no-break space, has become a space.
_LOST_NBSP = re.compile("Ã (?= |$)")
_WORD = re.compile(r"[^\W\d_]+")
_NOT_ASCII = re.compile("[^\x00-\x7f]")
_MIXED = re.compile("[A-Za-z\xc0-\u024f][\u0370-\u052f]|[\u0370-\u052f][A-Za-z\xc0-\u024f]|[\u0370-\u03ff][\u0400-\u052f]|[\u0400-\u052f][\u0370-\u03ff]")


def _bytes_of(charset: str) -> dict[str, int]:
    """Character -> byte over 0x80-0xFF; undefined bytes, and those of Windows sets, also as C1 controls."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(charset)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if charset.startswith("cp125"):
        out |= {chr(b): b for b in range(0x80, 0xA0)}
    return out


class _Chains:
    def __init__(self) -> None:
        self.utf8, self.single, self.shown = [], [], {}
        self._viable: dict[frozenset[str], list[tuple[str, dict[int, str]]]] = {}
        for wrong in WRONG:
            byte = _bytes_of(wrong)
            pick = lambda lo, hi, byte=byte: "[" + "".join(re.escape(c) for c, b in byte.items() if lo <= b <= hi) + "]"
            tail = pick(0x80, 0xBF)
            sequence = re.compile(f"{pick(0xC2, 0xDF)}{tail}|{pick(0xE0, 0xEF)}{tail}{{2}}|{pick(0xF0, 0xF4)}{tail}{{3}}")
            self.utf8.append((wrong, sequence, byte))
            self.shown[wrong] = {b: c for c, b in reversed(byte.items())}
            for right in RIGHT:
                if right != wrong:
                    good, bad = {}, set()
                    for c, b in byte.items():
                        try:
                            new = bytes([b]).decode(right)
                        except UnicodeDecodeError:
                            continue
                        if _SYMBOL.search(new) or _LEFT_OVER.search(new):
                            bad.add(c)
                        elif new != c:
                            good[c] = new
                    self.single.append((f"{wrong}>{right}", good, frozenset(bad)))

    def sequences(self, text: str) -> bool:
        """Whether some part of the text decodes as UTF-8 to something plausible."""
        for _, rx, byte in self.utf8:
            for m in rx.finditer(text):
                try:
                    if not _IMPLAUSIBLE.search(bytes(byte[c] for c in m[0]).decode()):
                        return True
                except UnicodeDecodeError:
                    continue
        return False

    def utf8_steps(self, text: str) -> Iterator[tuple[str, str]]:
        """(chain, text after it) for every way of reading parts of the text as UTF-8."""
        for wrong, rx, byte in self.utf8:
            def decode(m: re.Match, byte: dict = byte) -> str:
                try:
                    new = bytes(byte[c] for c in m[0]).decode()
                except UnicodeDecodeError:
                    return m[0]
                return m[0] if _IMPLAUSIBLE.search(new) else new

            new = rx.sub(decode, text)
            if wrong == "cp1252":
                new = _LOST_NBSP.sub("à", new)
            if new != text:
                yield f"{wrong}>utf_8", new

    def viable(self, chars: frozenset[str]) -> list[tuple[str, dict[int, str]]]:
        """(chain, table) of the single-byte chains that read these characters as plausible ones, one of each result."""
        got = self._viable.get(chars)
        if got is None:
            got, seen = [], set()
            odd = {c for c in chars if _SYMBOL.search(c) or _LEFT_OVER.search(c)}
            for name, good, bad in self.single:
                if chars & bad or odd - good.keys():
                    continue
                own = {ord(c): good[c] for c in chars if c in good}
                result = frozenset(own.items())
                if own and result not in seen:
                    seen.add(result)
                    got.append((name, own))
            if len(self._viable) > 100_000:
                self._viable.clear()
            self._viable[chars] = got
        return got

    def single_steps(self, text: str) -> Iterator[tuple[str, str]]:
        """(chain, text after it) for every single-byte chain that changes the text into something plausible."""
        for name, table in self.viable(frozenset(c for c in text if not c.isascii())):
            new = text.translate(table)
            if not _MIXED.search(new):
                yield name, new

    def hurt(self, text: str, choice: int) -> str:
        """The text damaged by one of all chains: read as another set's bytes, of UTF-8 or of a single-byte set."""
        wrong, choice = WRONG[choice % len(WRONG)], choice // len(WRONG)
        raw = None
        if choice % 2:
            for k in range(len(RIGHT)):
                try:
                    raw = text.encode(RIGHT[(choice // 2 + k) % len(RIGHT)])
                    break
                except UnicodeEncodeError:
                    continue
        raw = text.encode("utf-8", "surrogatepass") if raw is None else raw
        shown = self.shown[wrong]
        return "".join(chr(b) if b < 0x80 else shown.get(b, chr(b)) for b in raw)


_chains: _Chains | None = None


def chains() -> _Chains:
    global _chains
    if _chains is None:
        _chains = _Chains()
    return _chains


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class Model:
    """Hashed counts of 1- to 3-grams of lower-cased text, and the margin a restoration must win by."""

    counts: dict[int, int]
    total: int
    margin: float = MIN_MARGIN
    _memo: dict[str, float] = field(default_factory=dict, repr=False)

    def gram(self, g: str) -> float:
        """log P(last character | the two before it), each order smoothed with the one below."""
        got = self._memo.get(g)
        if got is None:
            n = lambda s: self.counts.get(_bucket(s), 0)
            p1 = (n(g[2]) + 0.05) / (self.total + 0.05 * 0x10000)
            p2 = (n(g[1:]) + 0.5 * p1) / (n(g[1]) + 0.5)
            p3 = (n(g) + 0.5 * p2) / (n(g[:2]) + 0.5)
            got = log(min(1.0, 0.8 * p3 + 0.15 * p2 + 0.05 * p1))
            if len(self._memo) > 300_000:
                self._memo.clear()
            self._memo[g] = got
        return got

    def cost(self, text: str) -> float:
        """What the text's trigrams with a character outside ASCII cost, and capitals of these inside words."""
        t = f"\x03\x03{text.lower()}\x03".replace("\u200b", "")
        total, done = 0.0, 0
        for m in _NOT_ASCII.finditer(t):
            at = m.start()
            for i in range(max(at, done), min(at + 3, len(t))):
                total -= self.gram(t[i - 2 : i + 1])
            done = at + 3
        for m in _NOT_ASCII.finditer(text):
            at = m.start()
            if at and m[0].isupper() and text[at - 1].islower() or at + 1 < len(text) and m[0].islower() and text[at + 1].isupper() and text[at + 1].isascii():
                total += 3.0
        return total

    def restore(self, text: str) -> tuple[str, str, float]:
        """The likeliest text, the chains that lead to it, and what it wins by; the text itself where none wins.

        Trigrams of ASCII characters are the same before and after, so only the others are counted."""
        best = (text, "", 0.0)
        if text.isascii():
            return best
        base = self.cost(text)
        if base < UTF8_COST or base < SINGLE_COST and not (_LOST_NBSP.search(text) or chains().sequences(text)):
            return best
        seen, level = {text}, [(text, "", 0.0)]
        for depth in range(MAX_DEPTH + 1):
            onward = []
            for now, path, paid in level:
                for name, new in chains().single_steps(now):
                    if new not in seen:
                        seen.add(new)
                        gain = base - self.cost(new) - paid - SINGLE_COST
                        if gain > best[2]:
                            best = (new, f"{path} {name}".strip(), gain)
                for name, new in chains().utf8_steps(now) if depth < MAX_DEPTH else ():
                    if new not in seen:
                        seen.add(new)
                        onward.append((new, f"{path} {name}".strip(), paid + UTF8_COST))
                        gain = base - self.cost(new) - paid - UTF8_COST
                        if gain > best[2]:
                            best = (new, onward[-1][1], gain)
            level = onward
        return best

    def judge(self, text: str) -> tuple[str | None, str, float] | None:
        """None for sound text, else (restored text or None, chains, gain)."""
        return judged(text, *self.restore(text), self.margin)


def judged(text: str, new: str, path: str, gain: float, margin: float) -> tuple[str | None, str, float] | None:
    if gain >= margin:
        return (None if _LEFT_OVER.search(new) else new), path, gain
    return (None, "", 0.0) if _LEFT_OVER.search(text) else None


def _grams(texts: Iterable[str]) -> Counter:
    out: Counter = Counter()
    for text in texts:
        t = f"\x03\x03{text.lower()}\x03"
        out.update(t[i:j] for j in range(3, len(t) + 1) for i in (j - 3, j - 2, j - 1))
        out.update(("\x03\x03", "\x03"))
    return out


def _clean(text: str) -> bool:
    """Whether nothing in the text hints at damage: what the model may learn from."""
    if text.isascii():
        return True
    if _LEFT_OVER.search(text) or _SYMBOL.search(text) or _MIXED.search(text):
        return False
    words = _WORD.findall(text)
    return not any(w[1:] != w[1:].lower() for w in words if not w.isascii()) and not chains().sequences(text)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter = Counter()
    for batch in batches:
        for g, n in _grams(t for t in batch["value"] if _clean(t)).items():
            total[_bucket(g)] += n
            if len(g) == 1:
                total[-1] += n
        if len(total) > BUCKETS // 4:
            yield pd.DataFrame(list(total.items()), columns=["bucket", "n"])
            total.clear()
    yield pd.DataFrame(list(total.items()), columns=["bucket", "n"])


def train(values: DataFrame) -> Model:
    """The model of a column ``value`` of distinct values, over all of them; its margin is still to be validated."""
    counted = values.mapInPandas(_count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    counts = dict(zip(rows["bucket"].to_pylist(), rows["n"].to_pylist(), strict=True))
    return Model(counts, counts.pop(-1, 0))


def damaged_by_hash(value: str) -> str:
    """A clean value damaged by the chain that its hash chooses; itself where that changes nothing."""
    return chains().hurt(value, zlib.crc32(value.encode("utf-8", "surrogatepass")))


_JUDGED = "value string, restored string, chain string, gain double, damaged boolean, step int, n bigint"


def _judge(shared: object) -> Callable:
    """Rows of values that may be damaged, with ``n`` null, and the histogram of gains of clean values, with ``n``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, total = Model(*shared.value), Counter()
        step = lambda gain: max(-1, min(MARGIN_STEPS - 1, int((gain - MIN_MARGIN) // MARGIN_STEP)))
        columns = [c.split()[0] for c in _JUDGED.split(", ")]
        for batch in batches:
            rows = []
            for value in batch["value"]:
                found = own.restore(value)
                if found[2] >= MIN_MARGIN or _LEFT_OVER.search(value):
                    rows.append((value, *found, None, None, None))
                if _clean(value):
                    total[False, step(found[2])] += 1
                    hurt = damaged_by_hash(value)
                    if hurt != value:
                        total[True, step(own.restore(hurt)[2])] += 1
            if rows:
                yield pd.DataFrame(rows, columns=columns).astype({"damaged": "boolean", "step": "Int32", "n": "Int64"})
        yield pd.DataFrame([(None, None, None, None, d, s, n) for (d, s), n in total.items()], columns=columns).astype({"damaged": "boolean", "step": "Int32", "n": "Int64"})

    return run


def damaged_values(values: DataFrame, model: Model) -> DataFrame:
    """``value``, ``restored`` (null where it can't be), ``chain``, ``gain`` of the damaged ones among ``values``, by the
    margin with the fewest errors on all clean values as they are and damaged."""
    shared = values.sparkSession.sparkContext.broadcast((model.counts, model.total))
    found = cut(values.filter(r"value rlike '[^\\x00-\\x7F]'").mapInPandas(_judge(shared), _JUDGED))
    steps = found.filter("n is not null").groupBy("damaged", "step").agg(F.sum("n").alias("n")).collect()
    errors = lambda k: sum(r["n"] for r in steps if (r["step"] >= k) != r["damaged"])
    model.margin = MIN_MARGIN + MARGIN_STEP * min(range(MARGIN_STEPS), key=lambda k: (errors(k), k))
    won = F.col("gain") >= F.lit(model.margin)
    left = lambda c: F.col(c).rlike("[\\x{80}-\\x{84}\\x{86}-\\x{9f}\\x{fffd}]")
    return found.filter(F.col("n").isNull() & (won | left("value"))).select(
        "value", F.when(won & ~left("restored"), F.col("restored")).alias("restored"), F.when(won, F.col("chain")).otherwise(F.lit("")).alias("chain"), F.when(won, F.col("gain")).otherwise(F.lit(0.0)).alias("gain")
    )


def repair(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``row_id``, ``field``, ``value``, ``restored``, ``chain``, ``gain``: every damaged field of every row."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), df[f].alias("value")) for f in fields]))
    cells = df.select(df[id_col].alias("row_id"), pairs.alias("p")).select("row_id", "p.*")
    # distinct values are few bytes and much work: as many parts as there are tasks, where the planner would make one; by
    # the value itself it would take the shuffle of the distinct step for it
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    values = cut(cells.filter("value <> ''").select("value").distinct().repartition(parts, F.xxhash64("value")))
    bad = damaged_values(values, train(values))
    return salted_join(cells.filter(r"value rlike '[^\\x00-\\x7F]'"), bad, ["value"], "row_id").select(
        "row_id", "field", "value", "restored", "chain", "gain"
    )
