"""Languages of documents and of the stretches inside them.

A linear-chain conditional random field labels every word with a language. Its emissions come from affixes, character
trigrams and a lexicon; its transitions are learned, so that one odd word doesn't end a stretch; labels and their
confidence are posterior marginals of forward-backward.

The lexicon is counted over all rows: how often a word stands in rows declared to be in each language. Declared
languages are often wrong, so it is only one feature. The weights are trained on a bounded sample of
``SAMPLE_ROWS`` rows whose declared language the lexicon confirms, and on code-switched texts put together from them.

Shape of the job: two passes of narrow work. The lexicon is hashed to ``BUCKETS`` entries a language, so that what is
collected and broadcast has a fixed bound; no row is ever shuffled. Texts are labelled in blocks of at most
``BLOCK_WORDS`` words. A text of more than ``CHUNK`` words is cut into chunks that are scanned side by side: each chunk's
transfer matrix is multiplied out, the matrices are chained in both directions, and what they carry over the cuts makes
the marginals those of the whole text.

What is no running text depends on the corpus: ``Noise`` names its fields, marks and hosts.

Defined results: a null or empty text, and one of marks, numbers and hosts only, has no stretch; the language of a
document is the one with the largest share of its words, its confidence that share weighted by the posteriors; texts
and words of any length are labelled whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The languages told apart.
LANGS = ("it", "fr", "de", "es", "en", "nl", "pt", "pl", "sv", "el")
#: Further spellings of each, besides the code itself; regions are cut off before.
SPELLINGS = {
    "it": "ita italiano italian italien italienisch italiana",
    "fr": "fra fre français francais french francese französisch francés",
    "de": "deu ger deutsch german tedesco allemand alemán aleman",
    "es": "spa español espanol spanish castellano spagnolo espagnol",
    "en": "eng english inglese anglais englisch inglés",
    "nl": "nld dut nederlands dutch vlaams olandese néerlandais",
    "pt": "por português portugues portuguese portoghese portugais",
    "pl": "pol polski polish polacco polonais polnisch",
    "sv": "swe svenska swedish svedese suédois schwedisch",
    "el": "ell gre ελληνικά ελληνικα greek greco grec gr ellinika",
}
_CODE = {s: k for k, v in SPELLINGS.items() for s in (k, *v.split())}
BUCKETS, FEATURES = 1 << 17, 1 << 15
#: Rows that the weights are fitted on, and characters taken of each, at most.
SAMPLE_ROWS, SAMPLE_CHARS, EPOCHS = 2000, 8000, 5
MIN_WORDS, MIN_CONFIDENCE = 3, 0.9
BLOCK_WORDS, CHUNK = 1 << 17, 4096
#: Distinct words whose emissions a worker keeps.
MAX_WORDS = 200_000
#: Names of page fields that may stand before a text.
FIELD_NAMES = tuple("title meta description body footer header main h1 h2 h3 h4 h5 h6 nav legal site_name og".split())
#: Top-level domains by which a bare host is known.
HOST_TLDS = tuple("com org net eu gov it fr de es nl pt pl se gr ie uk".split())


@dataclass(frozen=True)
class Noise:
    """What stands in a text and is no running text: ``fields``, names before a text with a colon or equals sign; ``marks``,
    names that stand so before a value, which goes with them; ``tlds`` of hosts. URLs, e-mail addresses and words with
    underscores never count. ``cut_names``: names that a column's cut may leave in part after a final bar."""

    fields: tuple[str, ...] = FIELD_NAMES
    marks: tuple[str, ...] = ()
    tlds: tuple[str, ...] = HOST_TLDS
    cut_names: tuple[str, ...] = ()


@lru_cache(maxsize=8)
def _patterns(noise: Noise) -> tuple[re.Pattern | None, re.Pattern]:
    either = lambda names: "|".join(map(re.escape, names))
    marks = [rf"(?:{either(noise.marks)})[:=](?:\S+|\s*$)"] * bool(noise.marks) + [rf"(?:{either(noise.fields)})\s?[:=](?!\S*\d\b)"] * bool(noise.fields)
    hosts = re.compile(rf"\b[\w-]+(?:\.[\w-]+)*\.(?:{either(noise.tlds or ('com',))})\b\S*", re.I)
    return re.compile(rf"\b(?:{'|'.join(marks)})", re.I) if marks else None, hosts


#: What else is no running text, each with a sign without which it needn't be looked for.
_OTHER = (
    ("_", re.compile(r"\S*\w_\w\S*")), ("@", re.compile(r"\S+@\S+")), ("://", re.compile(r"https?://\S+", re.I)), ("www.", re.compile(r"www\.\S+", re.I)),
)
_DOTTED = re.compile(r"\w\.[A-Za-z]{2}")
_TAIL = re.compile(r"(?<=\|)\s*([a-z0-9]{1,11})[:=]?\s*$")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def declared_code(lang: str | None) -> str | None:
    """The code of a declared language in any usual spelling, or None: ``it_CH``, ``ITA`` and ``Italiano`` are ``it``."""
    s = (lang or "").strip().lower()
    return _CODE.get(s) or _CODE.get(re.split(r"[-_ (]", s)[0])


def _spaces(m: re.Match) -> str:
    return " " * len(m[0])


def running_text(text: str | None, noise: Noise = Noise()) -> str:
    """The text with blanks, as many, in place of all that is no running text."""
    if not text:
        return ""
    bare = text
    marks, hosts = _patterns(noise)
    if marks and (":" in bare or "=" in bare):
        bare = marks.sub(_spaces, bare)
    for sign, pattern in _OTHER:
        if sign in bare:
            bare = pattern.sub(_spaces, bare)
    if _DOTTED.search(bare):
        bare = hosts.sub(_spaces, bare)
    if noise.cut_names and "|" in bare:
        tail = _TAIL.search(bare, bare.rindex("|"))
        if tail and any(n.startswith(tail[1]) for n in noise.cut_names):
            bare = bare[: tail.start()]
    return bare


def plain_words(text: str | None, noise: Noise = Noise()) -> list[str]:
    """The lower-cased words of the running text."""
    return _lower_words(running_text(text, noise))


def _lower_words(bare: str) -> list[str]:
    low = bare.lower()
    # a letter whose lower case is several characters would move or part words
    return _WORD.findall(low) if len(low) == len(bare) else [w.lower() for w in _WORD.findall(bare)]


def running_words(text: str | None, cut_at: int | None = None, noise: Noise = Noise()) -> list[tuple[str, int, int]]:
    """(lower-cased word, start, end) of the running text, without field names, marks and hosts.

    Of a text as long as ``cut_at``, at which its column is cut, a last word that reaches the end is left out.
    """
    words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(running_text(text, noise))]
    if words and len(text) == cut_at == words[-1][2]:
        words.pop()
    return words


def _hash(s: str, size: int) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) % size


def _features(word: str) -> list[int]:
    """Hashed affixes and character trigrams of a word."""
    w = f"<{word}>"
    grams = {f"p{w[:k]}" for k in (3, 4)} | {f"s{w[-k:]}" for k in (2, 3, 4, 5)} | {f"g{w[i : i + 3]}" for i in range(len(w) - 2)}
    return [_hash(g, FEATURES) for g in sorted(grams)]


@dataclass
class Crf:
    """``lexicon`` (buckets x languages, counts), ``weights`` (features x languages), ``lex`` (weights of the lexicon),
    ``bias``, ``trans`` (log potentials between neighbours), ``prior`` (share of each language)."""

    lexicon: np.ndarray
    weights: np.ndarray
    lex: np.ndarray
    bias: np.ndarray
    trans: np.ndarray
    prior: np.ndarray
    _ids: dict[str, int] = field(default_factory=dict, repr=False)
    _table: np.ndarray = field(default_factory=lambda: np.zeros((1024, len(LANGS)), np.float32), repr=False)

    def lexical(self, word: str) -> np.ndarray:
        """Log-odds of the languages for a word, zero for an unknown one."""
        n = self.lexicon[_hash(word, BUCKETS)] / self.prior
        p = (n + 0.5) / (n.sum() + 0.5 * len(LANGS))
        return np.log(p) - np.log(p).mean()

    def emission(self, word: str) -> np.ndarray:
        return (self.weights[_features(word)].sum(0) + self.lex * self.lexical(word) + self.bias).astype(np.float32)

    def _id(self, word: str) -> int:
        n = len(self._ids)
        if n == len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
        self._table[n] = self.emission(word)
        self._ids[word] = n
        return n

    def emissions(self, words: list[str]) -> np.ndarray:
        """The emissions of words, each worked out once while it is kept."""
        ids = self._ids
        try:
            return self._table[[ids[w] for w in words]]
        except KeyError:
            if len(ids) > MAX_WORDS:
                ids.clear()
            at = []
            for lo in range(0, len(words), MAX_WORDS):
                part = [ids[w] if w in ids else self._id(w) for w in words[lo : lo + MAX_WORDS]]
                at.append(self._table[part])
                if len(ids) > 2 * MAX_WORDS:
                    ids.clear()
            return np.concatenate(at)

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Posterior of every language for every word of every text."""
        out: list = [np.zeros((0, len(LANGS)), np.float32)] * len(texts)
        order = sorted((i for i in range(len(texts)) if texts[i]), key=lambda i: len(texts[i]))
        a = np.exp(self.trans).astype(np.float32)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(texts[order[end]]) <= CHUNK and len(texts[order[end]]) * (end + 1 - at) <= BLOCK_WORDS:
                end += 1
            block = order[at:end]
            at = end
            if len(texts[block[0]]) > CHUNK:
                out[block[0]] = _long_marginals(self.emissions(texts[block[0]]), a)
                continue
            sizes = np.array([len(texts[i]) for i in block])
            flat = self.emissions([w for i in block for w in texts[i]])
            e = np.zeros((sizes.max(), len(block), len(LANGS)), np.float32)
            on = np.arange(sizes.max()) < sizes[:, None]
            rows, steps = np.nonzero(on)
            e[steps, rows] = np.exp(flat - flat.max(1, keepdims=True))
            post = _marginals(e, np.ascontiguousarray(on.T), a, None, np.ones(len(LANGS), np.float32))
            for k, i in enumerate(block):
                out[i] = post[: sizes[k], k]
        return out


def _marginals(x: np.ndarray, on: np.ndarray, a: np.ndarray, first: np.ndarray | None, last: np.ndarray) -> np.ndarray:
    """Marginals (steps x rows x languages) of potentials ``x``, rows of different length being on from the start.

    ``first``: what comes into each row from before it, None at the beginning of a text; ``last``: what comes from behind."""
    steps, n, _ = x.shape
    alpha = np.empty_like(x)
    now = x[0] if first is None else (first @ a) * x[0]
    if first is not None:
        now = np.where(np.isnan(first[:, :1]), x[0], now)
    alpha[0] = now / now.sum(1, keepdims=True)
    for t in range(1, steps):
        now = (alpha[t - 1] @ a) * x[t]
        alpha[t] = now / np.maximum(now.sum(1, keepdims=True), 1e-30)
    beta = np.broadcast_to(last, x[0].shape).copy()
    out = alpha
    b = a.T.copy()
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            before = (x[t + 1] * beta) @ b
            beta = np.where(on[t + 1][:, None], before / np.maximum(before.sum(1, keepdims=True), 1e-30), beta)
        out[t] *= beta
    out /= np.maximum(out.sum(2, keepdims=True), 1e-30)
    return out


def _long_marginals(e: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Marginals of one text of any number of words, its chunks scanned side by side."""
    n, k = e.shape
    chunks = -(-n // CHUNK)
    x = np.zeros((chunks * CHUNK, k), np.float32)
    x[:n] = np.exp(e - e.max(1, keepdims=True))
    x = np.ascontiguousarray(x.reshape(chunks, CHUNK, k).transpose(1, 0, 2))
    on = (np.arange(chunks * CHUNK) < n).reshape(chunks, CHUNK).T
    through = np.tile(np.eye(k, dtype=np.float32), (chunks, 1, 1))
    for t in range(CHUNK):
        step = (through @ a) * x[t][:, None, :]
        step /= np.maximum(step.sum((1, 2), keepdims=True), 1e-30)
        through = np.where(on[t][:, None, None], step, through)
    first = np.full((chunks, k), np.nan, np.float32)
    now = x[0, 0] / x[0, 0].sum()
    for t in range(1, CHUNK):
        now = (now @ a) * x[t, 0]
        now /= now.sum()
    for j in range(1, chunks):
        first[j] = now
        now = now @ through[j]
        now /= now.sum()
    last = np.ones((chunks, k), np.float32)
    for j in range(chunks - 1, 0, -1):
        back = through[j] @ last[j]
        last[j - 1] = back / back.sum()
    return _marginals(x, on, a, first, last).transpose(1, 0, 2).reshape(-1, k)[:n]


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, rows))
    e = np.zeros((len(rows), longest, len(LANGS)))
    mask = np.zeros((len(rows), longest), bool)
    for k, r in enumerate(rows):
        e[k, : len(r)] = r
        mask[k, : len(r)] = True
    return e, mask


def forward_backward(e: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals (texts x words x languages), expected transitions and log-likelihood normaliser of padded texts."""
    n, length, _ = e.shape
    top = e.max(2, keepdims=True)
    x, a = np.exp(e - top), np.exp(trans)
    alpha, beta, scale = np.zeros_like(x), np.ones_like(x), np.ones((n, length))
    alpha[:, 0] = x[:, 0]
    for t in range(length):
        if t:
            alpha[:, t] = (alpha[:, t - 1] @ a) * x[:, t]
        scale[:, t] = np.where(mask[:, t], alpha[:, t].sum(1), 1.0)
        alpha[:, t] /= scale[:, t, None]
        if t:
            alpha[:, t] = np.where(mask[:, t, None], alpha[:, t], alpha[:, t - 1])
    pairs = np.zeros_like(trans)
    for t in range(length - 2, -1, -1):
        on = mask[:, t + 1, None]
        weighted = x[:, t + 1] * beta[:, t + 1] / scale[:, t + 1, None]
        pairs += a * ((alpha[:, t] * on).T @ (weighted * on))
        beta[:, t] = np.where(on, weighted @ a.T, 1.0)
    post = alpha * beta
    post /= post.sum(2, keepdims=True)
    return post, pairs, float((np.log(scale) * mask).sum() + (top[:, :, 0] * mask).sum())


def lexicon(texts: DataFrame, noise: Noise = Noise()) -> np.ndarray:
    """Counts of hashed words by declared language over all rows of ``lang``, ``text``; at most ``BUCKETS`` x languages."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            words: dict[int, Counter] = {}
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                code = declared_code(lang)
                if code is not None and text:
                    words.setdefault(LANGS.index(code), Counter()).update(plain_words(text, noise))
            for k, counts in words.items():
                for word, n in counts.items():
                    total[_hash(word, BUCKETS) * len(LANGS) + k] += n
        yield pd.DataFrame(list(total.items()), columns=["slot", "n"])

    counted = texts.mapInPandas(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS * len(LANGS))
    rows = counted.toArrow()
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(BUCKETS, len(LANGS))


def _sum_by(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by their index."""
    k = values.shape[1]
    cells = (index.reshape(-1, 1) * k + np.arange(k)).ravel()
    return np.bincount(cells, values.ravel(), size * k).reshape(size, k)


def blank_model(counts: np.ndarray) -> Crf:
    k = len(LANGS)
    share = counts.sum(0) + 1
    return Crf(counts, np.zeros((FEATURES, k)), np.ones(k), np.zeros(k), np.where(np.eye(k, dtype=bool), 0.0, -3.0), share / share.mean())


def train(counts: np.ndarray, sample: list[tuple[str | None, str | None]], noise: Noise = Noise(), seed: int = 7) -> Crf:
    """Fits the weights on a sample of (declared language, text) by stochastic gradient steps on the likelihood."""
    model, rng = blank_model(counts), np.random.default_rng(seed)
    parts: list[tuple[list[str], int]] = []
    for lang, text in sample:
        code, words = declared_code(lang), plain_words(text, noise)
        if code is None or len(words) < 4:
            continue
        votes = np.stack([model.lexical(w) for w in words])
        k = LANGS.index(code)
        if votes.sum(0).argmax() == k and (votes.argmax(1) == k).mean() > 0.6:
            parts.append((words, k))
    if not parts:
        return model
    texts = [(w, [k] * len(w)) for w, k in parts]
    for _ in range(len(parts)):
        words, labels = [], []
        for i in rng.integers(len(parts), size=rng.integers(2, 5)):
            w, k = parts[i]
            lo = int(rng.integers(len(w)))
            piece = w[lo : lo + int(rng.integers(2, 14))]
            words += piece
            labels += [k] * len(piece)
        texts.append((words, labels))
    vocab = {w: i for i, w in enumerate(sorted({w for words, _ in texts for w in words}))}
    feats = [np.array(_features(w)) for w in vocab]
    lexical = np.stack([model.lexical(w) for w in vocab])
    coded = [(np.array([vocab[w] for w in words]), np.array(labels)) for words, labels in texts]
    rate, size = 0.15, 64
    grad2 = {n: np.full_like(getattr(model, n), 1e-2) for n in ("weights", "lex", "bias", "trans")}
    for _ in range(EPOCHS):
        order = sorted(rng.permutation(len(coded)), key=lambda i: len(coded[i][0]) + rng.random() * 8)
        blocks = [order[i : i + size] for i in range(0, len(order), size)]
        for b in rng.permutation(len(blocks)):
            block = [coded[i] for i in blocks[b]]
            own, where = np.unique(np.concatenate([w for w, _ in block]), return_inverse=True)
            flat = np.concatenate([feats[i] for i in own])
            seg = np.repeat(np.arange(len(own)), [len(feats[i]) for i in own])
            emit = _sum_by(seg, model.weights[flat], len(own))
            emit += model.lex * lexical[own] + model.bias
            ends = np.cumsum([len(w) for w, _ in block])[:-1]
            e, mask = _pad(np.split(emit[where], ends))
            post, pairs, _ = forward_backward(e, mask, model.trans)
            gold_pairs = np.zeros_like(model.trans)
            diff = -post[mask]
            gold = np.concatenate([k for _, k in block])
            diff[np.arange(len(gold)), gold] += 1
            for _, k in block:
                np.add.at(gold_pairs, (k[:-1], k[1:]), 1)
            by_word = _sum_by(where, diff, len(own))
            rows, back = np.unique(flat, return_inverse=True)
            sparse = _sum_by(back, by_word[seg], len(rows))
            g = sparse / len(block) - 1e-4 * model.weights[rows]
            grad2["weights"][rows] += g * g
            model.weights[rows] += rate * g / np.sqrt(grad2["weights"][rows])
            for name, g in (("trans", gold_pairs - pairs), ("bias", diff.sum(0)), ("lex", (by_word * lexical[own]).sum(0))):
                g = g / len(block) - 1e-4 * getattr(model, name)
                grad2[name] += g * g
                setattr(model, name, getattr(model, name) + rate * g / np.sqrt(grad2[name]))
    model._ids.clear()
    return model


@dataclass(frozen=True)
class Stretch:
    position: int
    lang: str
    confidence: float
    start: int
    end: int
    n_words: int


def runs_of(post: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, word behind the last, language) of each stretch of neighbouring words of one likeliest language.

    Fewer than ``MIN_WORDS`` words that the model is less than ``MIN_CONFIDENCE`` sure of go to the stretch before.
    """
    best = post.argmax(1)
    n = len(best)
    if (best == best[0]).all():
        return [(0, n, int(best[0]))]
    ends = np.flatnonzero(np.diff(best, prepend=-1, append=-1)).tolist()
    for i, j in sorted(zip(ends[:-1], ends[1:], strict=True), key=lambda r: r[1] - r[0]):
        if j - i < MIN_WORDS and post[i:j, best[i]].mean() < MIN_CONFIDENCE and (i or j < n):
            best[i:j] = best[i - 1] if i else best[j]
    ends = np.flatnonzero(np.diff(best, prepend=-1, append=-1)).tolist()
    return [(i, j, int(best[i])) for i, j in zip(ends[:-1], ends[1:], strict=True)]


def stretches(words: list[tuple[str, int, int]], post: np.ndarray) -> list[Stretch]:
    """The stretches of a text with their confidence and place."""
    return [
        Stretch(p, LANGS[k], round(float(post[i:j, k].mean()), 4), words[i][1], words[j - 1][2], j - i)
        for p, (i, j, k) in enumerate(runs_of(post) if len(words) else [], 1)
    ]


_OUT = "row_id bigint, lang string, confidence double, declared string, agrees boolean, n_langs int, stretches array<struct<position:int,lang:string,confidence:double,start:int,end:int,n_words:int>>"
_STRETCH = pa.struct([("position", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("start", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32())])
_SHAPE = pa.schema([("row_id", pa.int64()), ("lang", pa.string()), ("confidence", pa.float64()), ("declared", pa.string()), ("agrees", pa.bool_()), ("n_langs", pa.int32()), ("stretches", pa.list_(_STRETCH))])


def fit(texts: DataFrame, sample_by: Column, noise: Noise = Noise()) -> Crf:
    """Lexicon over all rows of ``lang``, ``text``; weights on ``SAMPLE_ROWS`` rows, about as many of each language.

    The rows are those with the smallest -ln(u) * (words of their language), u being a hash of ``sample_by``; of a longer
    one ``SAMPLE_CHARS`` characters from a place that the hash gives are used.
    """
    counts = lexicon(texts, noise)
    size = counts.sum(0) / counts.sum().clip(1)
    per_spelling = F.create_map(*[F.lit(x) for s, k in _CODE.items() for x in (s, float(size[LANGS.index(k)]))])
    h = F.pmod(F.xxhash64(sample_by), F.lit(1 << 40))
    key = -F.ln((h + 1) / float(1 << 40)) * F.try_element_at(per_spelling, F.regexp_extract(F.lower(F.trim("lang")), r"^[^-_ (]+", 0))
    piece = F.substring("text", (F.pmod(h, F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    chosen = texts.withColumn("__key", key).filter("text <> '' and __key is not null").select("lang", piece.alias("text"), "__key").orderBy("__key").limit(SAMPLE_ROWS).collect()
    return train(counts, [(r["lang"], r["text"]) for r in chosen], noise)


def identify(df: DataFrame, id_col: str, lang_col: str, text_col: str, cut_at: int | None = None, every_row: bool = False, noise: Noise = Noise()) -> DataFrame:
    """Per row with running text: its language, the confidence, the declared code, whether they agree, its stretches.

    ``cut_at``: the length that the text column is cut at, if it is. ``every_row``: rows without running text come out
    too, with no language, no agreement, confidence 0 and no stretches.
    """
    texts = df.select(df[id_col].cast("bigint").alias("row_id"), df[lang_col].alias("lang"), df[text_col].alias("text"))
    model = fit(texts, F.struct("row_id", "text"), noise)
    shared = df.sparkSession.sparkContext.broadcast((model.lexicon.astype(np.float32), model.weights.astype(np.float32), model.lex, model.bias, model.trans, model.prior))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Crf(*shared.value)
        for batch in batches:
            texts_ = batch.column("text").to_pylist()
            bare = [running_text(t, noise) for t in texts_]
            words = [_lower_words(b) for b in bare]
            for i, (t, b, ws) in enumerate(zip(texts_, bare, words, strict=True)):
                if ws and cut_at == len(t) == len(b) and b[-1].isalpha():
                    words[i] = ws[:-1]
            posts = own.posteriors(words)
            out: list[list] = [[] for _ in _SHAPE]
            for row_id, declared, b, ws, post in zip(batch.column("row_id").to_pylist(), batch.column("lang").to_pylist(), bare, words, posts, strict=True):
                code = declared_code(declared)
                if not ws:
                    if every_row:
                        for column, value in zip(out, (row_id, None, 0.0, code, None, 0, []), strict=True):
                            column.append(value)
                    continue
                runs = runs_of(post)
                spans = _spans(b, len(ws), len(runs) > 1)
                share: Counter = Counter()
                for i, j, k in runs:
                    share[k] += j - i
                best = max(share, key=lambda k: (share[k], -k))
                means = post.mean(0) if len(runs) == 1 else None
                found = [
                    {"position": p, "lang": LANGS[k], "confidence": round(float(post[i:j, k].mean() if means is None else means[k]), 4), "start": spans[i][0], "end": spans[j - 1][1], "n_words": j - i}
                    for p, (i, j, k) in enumerate(runs, 1)
                ]
                confidence = round(float(post[:, best].mean() if means is None else means[best]), 4)
                for column, value in zip(out, (row_id, LANGS[best], confidence, code, code == LANGS[best], len(share), found), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SHAPE, strict=True)], schema=_SHAPE)

    return texts.mapInArrow(label, _OUT)


def _spans(bare: str, n: int, every: bool) -> list | dict:
    """Places of the first ``n`` words of a running text; without ``every`` at least those of the first and the last."""
    if every or len(bare) > 100_000:
        return [m.span() for m in _WORD.finditer(bare)][:n]
    first = _WORD.search(bare)
    if n == 1:
        return {0: first.span()}
    last = [m.end() for m in _WORD.finditer(bare)][n - 1]
    return {0: first.span(), n - 1: (0, last)}
