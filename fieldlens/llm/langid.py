"""Language identification by a linear-chain conditional random field over words.

Every word has a state, its language. Emissions add hashed affixes and character n-grams (learned weights) and
lexicon log-odds (one learned weight a language); learned transitions and starts tie neighbours together.
Forward-backward gives each word's posterior, so words of code-switched text are labelled one by one; a document's
language is the one with the largest posterior mass over its words, its score that share.

What is learned from what:
* The lexicon counts every word of every training document. A word enters if it makes at least ``min_share`` of a
  language's words, so a language has at most ``1 / min_share`` of them, however large the corpus.
* The field is fitted on a bounded sample of labelled rows: ``fit_rows`` distinct texts a language, an excerpt of
  ``fit_chars`` characters each, joined into sequences that switch language so that transitions are learned.

A word over ``PIECE`` bytes, such as a line of a script without spaces, is cut into consecutive pieces; each is an element of the
sequence and counts as a word, so every character counts. Long documents are cut into blocks of ``BLOCK`` words that see ``CONTEXT`` words on either side; a word's posterior
is taken from its own block only. Defined cases: null text or text without a letter is ``und`` with score 0; without any
labelled training row every text is ``und``; a null doc_id counts as not held out and is not learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm import crf
from fieldlens.llm.shared import batches_of, text_key, words_of, written

UNDETERMINED = "und"
HASHED = 1 << 15
BLOCK, CONTEXT = 512, 32
PIECE = 48
CHUNK_WORDS = 150_000
CACHE_WORDS = 150_000
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def elements(text: str | None) -> list[bytes]:
    """The words of the text, long ones in pieces of at most ``PIECE`` bytes that end where characters end."""
    out = []
    for w in words_of(text):
        a = 0
        while len(w) - a > PIECE:
            b = a + PIECE
            while w[b] & 0xC0 == 0x80:
                b -= 1
            out.append(w[a:b])
            a = b
        out.append(w[a:])
    return out


def core(word: bytes) -> str:
    """The word's letters, lower-cased."""
    return _NOT_LETTERS.sub("", word.decode("utf-8", "replace").lower())


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, where each word's begin): every 2- and 3-gram of the word with its ends marked, and the 4- and 5-grams at its
    ends, so that affixes of up to four bytes are among them. A word too short for one of the latter has feature ``HASHED``."""
    raw = [b"^" + w.encode() + b"$" for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    owner = np.repeat(np.arange(len(raw)), size)
    place = np.arange(len(data)) - start[owner]
    begin = np.concatenate(([0], np.cumsum(2 * size + 1)[:-1]))
    flat = np.full(int((2 * size + 1).sum()), HASHED, np.int64)

    def gram(at: np.ndarray, k: int) -> np.ndarray:
        h = np.full(len(at), k, np.uint64) * _MIX[5]
        for j in range(k):
            h = (h ^ data[at + j]) * _MIX[j]
            h ^= h >> np.uint64(29)
        return (h & np.uint64(HASHED - 1)).astype(np.int64)

    for k, shift in ((2, 0), (3, -1)):
        at = np.flatnonzero(place + k <= size[owner])
        flat[begin[owner[at]] + (size[owner[at]] + shift if k == 3 else 0) + place[at]] = gram(at, k)
    for n, (k, last) in enumerate(((4, False), (5, False), (4, True), (5, True))):
        w = np.flatnonzero(size >= k)
        flat[begin[w] + 2 * size[w] - 3 + n] = gram(start[w] + (size[w] - k if last else 0), k)
    return flat, begin


@dataclass
class Model:
    """Weights of the field; ``lexicon`` maps letters to a row of ``odds``."""

    labels: list[str]
    lexicon: dict[str, int]
    odds: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((HASHED + 1, 0)))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steps: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log potential of every label for every word."""
        flat, begin = features(words)
        known = np.fromiter((self.lexicon.get(w, 0) for w in words), np.int64, len(words))
        return np.add.reduceat(self.weights[flat], begin, axis=0) + self.odds[known] * self.trust


def fit(samples: list[tuple[str, str] | tuple[str, str, bool, bool]], counts: list[tuple[str, str, int]], seed: int = 7, sequences: int = 1600, length: int = 48,
        rounds: int = 8) -> Model | None:
    """Trains on (language, excerpt, whether its first and its last word may be cut; a pair is a whole text) and (language, letters, count) rows of the lexicon; None without samples."""
    labels = sorted({lang for lang, *_ in samples})
    if not labels:
        return None
    at = {lang: i for i, lang in enumerate(labels)}
    lexicon = {w: i + 1 for i, w in enumerate(sorted({w for _, w, _ in counts}))}
    tally = np.zeros((len(lexicon) + 1, len(labels)))
    for lang, w, n in counts:
        if lang in at:
            tally[lexicon[w], at[lang]] += n
    share = np.log((tally + 0.5) / (tally.sum(axis=0) + 0.5 * len(tally)))
    odds = share - share.mean(axis=1, keepdims=True)
    odds[0] = 0
    rng = np.random.default_rng(seed)
    pool = [[] for _ in labels]
    for lang, text, *cut in sorted(samples):
        head, tail = cut or (False, False)
        parts = elements(text)
        if words := [c for w in parts[head:len(parts) - tail] if (c := core(w))]:
            pool[at[lang]].append(words)
    filled = [k for k in range(len(labels)) if pool[k]]
    if not filled:
        return None
    words: dict[str, int] = {}
    seqs, gold = np.zeros((sequences, length), np.int64), np.zeros((sequences, length), np.int64)
    for s in range(sequences):
        got = 0
        while got < length:
            k = filled[rng.integers(len(filled))]
            src = pool[k][rng.integers(len(pool[k]))]
            n = min(length - got, len(src), length if s % 3 else int(rng.integers(4, 24)))
            off = int(rng.integers(len(src) - n + 1))
            seqs[s, got:got + n] = [words.setdefault(w, len(words)) for w in src[off:off + n]]
            gold[s, got:got + n] = k
            got += n
    names = list(words)
    flat, begin = features(names)
    begin = np.append(begin, len(flat))
    lex = odds[[lexicon.get(w, 0) for w in names]]
    k = len(labels)
    model = Model(labels, lexicon, odds, np.zeros((HASHED + 1, k)), np.full(k, 0.3), np.eye(k) * 2.0, np.zeros(k))
    params = [model.weights, model.trust, model.steps, model.start]
    first_m, second_m, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    size = 64
    for _ in range(rounds):
        for part in np.array_split(rng.permutation(sequences), max(1, sequences // size)):
            w, y = seqs[part].ravel(), gold[part]
            spread = np.concatenate([flat[begin[i]:begin[i + 1]] for i in w])
            owner = np.repeat(np.arange(len(w)), begin[w + 1] - begin[w])
            ends = np.concatenate(([0], np.cumsum(begin[w + 1] - begin[w])))[:-1]
            em = np.add.reduceat(model.weights[spread], ends, axis=0) + lex[w] * model.trust
            slope, pairs, starts = crf.slopes(em.reshape(len(part), length, k), y, model.steps, model.start)
            d_em = slope.reshape(-1, k)
            d_w = np.zeros_like(model.weights)
            for j in range(k):
                d_w[:, j] = np.bincount(spread, d_em[owner, j], HASHED + 1)
            grads = [d_w + 1e-3 * model.weights, (d_em * lex[w]).sum(axis=0), pairs, starts]
            step += 1
            for p, g, m, v in zip(params, grads, first_m, second_m, strict=True):
                g = g / len(part)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return model


class Labeller:
    """Applies a model; words seen before keep their emissions in a bounded cache."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.em = np.zeros((1, len(self.model.labels)))

    def _ids(self, words: list[bytes]) -> np.ndarray:
        """Row of each word's emissions; -1 for words without letters."""
        new = list({w for w in words if w not in self.ids})
        if len(self.ids) + len(new) > CACHE_WORDS:
            self._forget()
            new = list(set(words))
        letters = [core(w) for w in new]
        if have := [c for c in letters if c]:
            rows = iter(range(len(self.em), len(self.em) + len(have)))
            self.em = np.concatenate([self.em, self.model.emissions(have)])
            self.ids.update((w, next(rows) if c else -1) for w, c in zip(new, letters, strict=True))
        else:
            self.ids.update((w, -1) for w in new)
        get = self.ids.__getitem__
        return np.fromiter(map(get, words), np.int64, len(words))

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, posterior) of each word with letters, in order."""
        words, owner = [], []
        for i, t in enumerate(texts):
            w = elements(t)
            words += w
            owner.append(np.full(len(w), i))
        rows = self._ids(words)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        rows, owner = rows[rows >= 0], owner[rows >= 0]
        if not len(rows):
            return owner, np.zeros((0, len(self.model.labels)))
        em = self.em[rows]
        n = np.bincount(owner, minlength=len(texts))
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        own_a, own_b, see_a, see_b = [], [], [], []
        for a, size in zip(first.tolist(), n.tolist(), strict=True):
            for at in range(a, a + size, BLOCK):
                own_a.append(at)
                own_b.append(min(at + BLOCK, a + size))
                see_a.append(max(a, at - CONTEXT))
                see_b.append(min(a + size, at + BLOCK + CONTEXT))
        see_a, see_b = np.array(see_a), np.array(see_b)
        length = see_b - see_a
        starts = np.concatenate(([0], np.cumsum(length)[:-1]))
        spread = np.repeat(see_a - starts, length) + np.arange(int(length.sum()))
        post = crf.forward_backward(em[spread], starts, length, self.model.steps, self.model.start)
        mine = (spread >= np.repeat(own_a, length)) & (spread < np.repeat(own_b, length))
        return owner, post[mine]

    def label(self, texts: list[str | None]) -> list[tuple[str, float, int, int]]:
        """(language, score, words, switches of language between neighbouring words) of each text."""
        owner, post = self.posteriors(texts)
        k = len(self.model.labels)
        mass = np.stack([np.bincount(owner, post[:, j], len(texts)) for j in range(k)], axis=1)
        n = np.bincount(owner, minlength=len(texts))
        best = post.argmax(axis=1)
        moved = (best[1:] != best[:-1]) & (owner[1:] == owner[:-1])
        switches = np.bincount(owner[1:][moved], minlength=len(texts))
        top = mass.argmax(axis=1)
        return [(self.model.labels[top[i]], float(min(1.0, mass[i, top[i]] / n[i])), int(n[i]), int(switches[i])) if n[i] else (UNDETERMINED, 0.0, 0, 0) for i in range(len(texts))]


def lexicon_counts(labelled: DataFrame, lang: str, text: str, min_share: float) -> DataFrame:
    """``(lang, word, n)`` over all labelled rows, for words that make ``min_share`` of some language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang_, c in tally.items():
                merged: Counter = Counter()
                for w, n in c.items():
                    if x := core(w):
                        merged[x] += n
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang_] * len(merged), pa.string()), "word": pa.array(list(merged), pa.string()), "n": pa.array(list(merged.values()), pa.int64())})
            tally.clear()

        for b in batches_of(batches, 2000):
            for lang_, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tally.setdefault(lang_, Counter()).update(elements(t))
            if sum(map(len, tally.values())) > CACHE_WORDS:
                yield from out()
        yield from out()

    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = written(rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "lexicon")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.join(totals, "lang").where(F.col("n") >= F.col("total") * min_share).select("word").distinct()
    return counts.join(frequent, "word", "left_semi")


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", fit_rows: int = 400, fit_chars: int = 1500,
          min_share: float = 1e-4) -> Model | None:
    """Fits a model on the rows of ``docs`` where ``learn`` holds and ``lang`` is not null."""
    labelled = docs.where(learn & F.col(lang).isNotNull())
    mix = F.pmod(F.xxhash64(text_key(text), F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    sizes = labelled.groupBy(F.col(lang).cast("string").alias("lang")).agg(F.countDistinct(F.when(F.col(text).isNotNull(), text_key(text))).alias("n"))
    per_lang = {r["lang"]: r["n"] for r in sizes.collect()}
    if not per_lang:
        return None
    keep = F.lit(False)
    for name, n in sorted(per_lang.items()):
        keep = keep | ((F.col(lang).cast("string") == name) & (mix < min(1.0, 1.5 * fit_rows / max(1, n))))
    where = (F.length(text) * F.pmod(F.xxhash64(text_key(text), F.lit("at")), F.lit(1000)) / 1000).cast("int")
    start = F.greatest(F.lit(1), F.least(where, F.length(text) - fit_chars))
    rows = (labelled.where(keep).select(F.col(lang).cast("string").alias("lang"), F.substring(F.col(text), start, F.lit(fit_chars)).alias("part"), (start > 1).alias("head"),
                                        (start + fit_chars - 1 < F.length(text)).alias("tail"), mix.alias("mix"), text_key(text).alias("key")).distinct()
            .orderBy("mix", "lang", "part").limit(2 * fit_rows * len(per_lang)).collect())
    taken: Counter = Counter()
    samples = []
    for r in rows:
        taken[r["lang"]] += 1
        if taken[r["lang"]] <= fit_rows:
            samples.append((r["lang"], r["part"] or "", bool(r["head"]), bool(r["tail"])))
    counts = [(r["lang"], r["word"], r["n"]) for r in lexicon_counts(labelled, lang, text, min_share).collect()]
    return fit(samples, counts)


PREDICTED = ("lang_pred", "score", "n_words", "n_switches")


def predict(docs: DataFrame, model: Model | None, carry: list[str], text: str = "text", names: tuple[str, ...] = PREDICTED) -> DataFrame:
    """The ``carry`` columns of every row with the predicted language, its score, the words and the switches under ``names``."""
    if model is None:
        none = (F.lit(UNDETERMINED), F.lit(0.0), F.lit(0).cast("long"), F.lit(0).cast("long"))
        return docs.select(*carry, *[c.alias(n) for c, n in zip(none, names, strict=True)])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    has_text = text in carry and dict(docs.dtypes)[text] == "string"
    place = carry.index(text) if has_text else len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(shared.value)
        for b in batches_of(batches, 1000):
            done: list[tuple[str, float, int, int]] = []
            part: list[str | None] = []
            size = 0
            for t in b.column(place).to_pylist():
                part.append(t)
                size += len(t or "") // 6
                if size > CHUNK_WORDS:
                    done += own.label(part)
                    part, size = [], 0
            done += own.label(part) if part else []
            cols = list(zip(*done, strict=True)) if done else [[], [], [], []]
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(carry)], *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], [*carry, *names])

    rows = docs.select(*carry) if has_text else docs.select(*carry, F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    new = ", ".join(f"`{n}` {k}" for n, k in zip(names, ("string", "double", "long", "long"), strict=True))
    return rows.mapInArrow(run, f"{kinds}, {new}")


def recognised(docs: DataFrame, model: Model | None, least: float = 0.4, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has letters and one language that holds at least ``least`` of its words; same columns.
    Without a model nothing is rejected for its score, and nothing goes."""
    if model is None:
        return docs
    names = PREDICTED
    while set(names) & set(docs.columns):
        names = tuple("_" + n for n in names)
    return predict(docs, model, docs.columns, text, names).where((F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least)).select(*docs.columns)
