"""Log-likelihood of whole documents under a gated recurrent language model with a class-factored softmax.

Words that make at least ``WORD_SHARE`` of the training tokens (so at most ``1 / WORD_SHARE`` of them) are the network's
own; they and the end of a text are dealt by frequency into classes of about the square root of their number. Every other word
belongs to one of ``RARE`` classes by its last letters. A token's probability is that of its class given the state, times
that of the word in its class: given the state for the network's own words, by corpus counts for the others,
``(c + 0.5) / (N_class + 0.5 * (V_class + 1))``, which leaves room for words never seen.

Counts cover every training text; class and word biases start from them. The recurrent weights are fitted in numpy by truncated
backpropagation: they start on the driver from ``FIT_ROWS`` excerpts of distinct texts, then every training text is read whole in one of
``ROUNDS`` rounds. In a round each task goes on from the weights so far over its texts, cut into windows; the tasks' changes, weighted
by their tokens, are averaged in Spark and stored. So training grows with the input. The texts of a round are dealt to shards by their keys, one for about
``SHARD_TOKENS`` tokens, and stand there in order of their keys, so the result does not follow the way the input is split. Scoring runs all
documents of a batch in step and carries each state from window to window of ``SCORE_STEPS`` tokens, so a document is scored whole.

Counts of words below ``HEAD_SHARE`` are not sent to the tasks: such tokens leave the scan as rows (document, word, number),
and their part of the sums is joined in.

Defined cases: null and empty texts are one end token; a null doc_id is not held out and not learned from; without training
tokens every probability is one; rows that repeat give a row each; other columns are not read.
"""

from __future__ import annotations

import copy
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.shared import batches_of, text_key, words_of, written

END = ""
WORD_SHARE, HEAD_SHARE = 2.5e-5, 1.5e-6
HIDDEN, RARE = 24, 32
FIT_ROWS, FIT_CHARS = 900, 2400
STREAMS, STEPS = 48, 24
ROUNDS, RATES = 3, (0.004, 0.003, 0.0015)
LEAST_STREAMS, MOST_STREAMS, CHUNK_TOKENS, SLOT = 4, 512, 1_000_000, 65_536
SCORE_STEPS, SCORE_WORDS, SCORE_ROWS = 64, 1_500_000, 4000
#: Words counted together in a task, and states whose probabilities are found together.
COUNT_WORDS, SCORE_STATES = 4_000_000, 65_536
#: Rows of a softmax at a time, so that its numbers stay in the processor's cache.
BLOCK = 1024


def rare_class(word: str) -> int:
    """Class of a word outside the network, by its last two characters."""
    return zlib.crc32(word[-2:].encode()) % RARE


def rare_class_column(word: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.substring(word, -2, 2), "UTF-8")), F.lit(RARE)).cast("int")


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts in a row, as ``words_of`` finds them; text of each)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words = pc.list_flatten(lists)
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty word
    return words.filter(some), owner[some.to_numpy(zero_copy_only=False)]


def _parts(batches: Iterator[pa.RecordBatch], rows: int, column: int = 0) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, and of about ``SCORE_WORDS`` words in texts of ``column``."""
    for b in batches_of(batches, rows):
        size = np.cumsum(pc.fill_null(pc.utf8_length(b.column(column)), 0).to_numpy() // 5, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            to = min(b.num_rows, int(np.searchsorted(size, (size[at - 1] if at else 0) + SCORE_WORDS, side="right")) + 1)
            yield b.slice(at, to - at)
            at = to


@dataclass
class Vocabulary:
    """What the corpus says: the network's words by frequency, counts of frequent words, totals of the rare classes."""

    words: list[str]
    head: dict[str, int]
    tokens: int
    distinct: int
    rare_tokens: np.ndarray
    rare_distinct: np.ndarray

    def __post_init__(self) -> None:
        self.size = max(1, math.isqrt(max(1, len(self.words) - 1)) + 1)
        self.own = -(-len(self.words) // self.size)
        self.classes = self.own + RARE
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.base_room = self.tokens + 0.5 * (self.distinct + 1)
        self.rare_room = self.rare_tokens + 0.5 * (self.rare_distinct + 1)
        self._places: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_places": None}

    @property
    def places(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(the frequent words; for each its input of the network, log10 of its count, log10 of its share in its class), made once a task."""
        if self._places is None:
            ids = np.fromiter(map(self.id_of, self.head), np.int32, len(self.head))
            logs = np.log10(np.fromiter(self.head.values(), float, len(self.head)) + 0.5)
            rare = ids - len(self.words)
            shares = np.where(rare < 0, 0.0, logs - np.log10(self.rare_room)[np.maximum(rare, 0)])
            self._places = pa.array(self.head, pa.string()), ids, logs, shares
        return self._places

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(``id_of`` of all words, place of each among the frequent words or -1)."""
        frequent, of_place, *_ = self.places
        at = pc.fill_null(pc.index_in(words, value_set=frequent), -1).to_numpy()
        ids, others = of_place[at], at < 0
        ends = pc.utf8_slice_codeunits(words.filter(pa.array(others)), -2, 1 << 30).dictionary_encode()
        of_end = np.array([len(self.words) + rare_class(e) for e in ends.dictionary.to_pylist()], np.int32)
        if len(of_end):
            ids[others] = of_end[ends.indices.to_numpy()]
        return ids, at

    def id_of(self, word: str) -> int:
        """Input of the network: a word of its own, or the number of those plus the rare class."""
        i = self.ids.get(word)
        return len(self.words) + rare_class(word) if i is None else i

    def classes_of(self, ids: np.ndarray) -> np.ndarray:
        """Classes of inputs, at most ``1 / WORD_SHARE`` words and the rare classes, as small numbers that sort fast."""
        return np.where(ids < len(self.words), ids // self.size, ids - len(self.words) + self.own).astype(np.min_scalar_type(self.classes))


class Network:
    """Gated recurrent unit with an input table and a two-level output."""

    def __init__(self, v: Vocabulary, rng: np.random.Generator):
        n, h = len(v.words) + RARE + 1, HIDDEN  # the last input is the start of a text
        self.size, self.own = v.size, v.own
        self.table = rng.normal(0, 0.1, (n, 3 * h))
        self.inner = rng.normal(0, 0.2, (h, 3 * h))
        self.to_class = np.zeros((h, v.classes))
        self.to_word = np.zeros((v.own, h, v.size))
        counts = np.array([v.head[w] for w in v.words], float)
        mass = np.concatenate((np.add.reduceat(counts, np.arange(0, len(counts), v.size)), v.rare_tokens + 0.5 * (v.rare_distinct + 1)))
        self.class_bias = np.log(mass / mass.sum())
        self.word_bias = np.full(v.own * v.size, -1e9)
        self.word_bias[:len(counts)] = np.log(counts)
        self.word_bias = self.word_bias.reshape(v.own, v.size)

    def params(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.to_class, self.to_word, self.class_bias, self.word_bias]

    def as_float32(self) -> Network:
        for name in ("table", "inner", "to_class", "to_word", "class_bias", "word_bias"):
            setattr(self, name, getattr(self, name).astype(np.float32))
        return self

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """(state, update gate, reset gate, candidate, its recurrent part) after inputs ``x``."""
        k = HIDDEN
        # one column to a text, so that each gate's numbers stand together
        a = np.ascontiguousarray(self.table.take(x, axis=0).T)
        b = self.inner.T @ h.T
        gates, r_h, h = a[:2 * k], b[2 * k:], h.T
        gates += b[:2 * k]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:k], gates[k:]
        g = r * r_h
        g += a[2 * k:]
        np.tanh(g, out=g)
        new = h - g
        new *= z
        new += g
        return new.T, z.T, r.T, g.T, r_h.T

    def log_probabilities(self, h: np.ndarray, classes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural log of the class's probability, times the word's where it is the network's own (``words`` >= 0)."""
        out = np.empty(len(h))
        order = np.argsort(classes, kind="stable")
        h, classes, words = h[order], classes[order], words[order]
        for a in range(0, len(h), BLOCK):
            out[order[a:a + BLOCK]] = _log_share(h[a:a + BLOCK], self.to_class, self.class_bias, classes[a:a + BLOCK])
        for c, a, b in _runs(classes, self.own):
            out[order[a:b]] += _log_share(h[a:b], self.to_word[c], self.word_bias[c], words[a:b])
        return out


def _exponentials(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials of the outputs for each row of ``h``, their sums, the target's output). A row's largest output is taken off only where sums would leave the range of numbers."""
    z = h @ weights
    z += bias
    rows, ones = np.arange(len(z)), np.ones(z.shape[1], z.dtype)
    own = z[rows, target]
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(z, out=z)
        total = z @ ones
    if not (total.min() > 1e-30 and total.max() < 1e30):
        z = h @ weights + bias
        z -= z.max(axis=1)[:, None]
        own = z[rows, target]
        np.exp(z, out=z)
        total = z @ ones
    return z, total, own


def _log_share(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logarithm of the target's softmax for each row of ``h``."""
    _, total, own = _exponentials(h, weights, bias, target)
    return own - np.log(total)


def _runs(classes: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(class, first, end) of parts of at most ``BLOCK`` rows of sorted ``classes``, of those below ``n``."""
    cuts = np.searchsorted(classes, np.arange(n + 1))
    for c in np.flatnonzero(np.diff(cuts)).tolist():
        for a in range(int(cuts[c]), int(cuts[c + 1]), BLOCK):
            yield c, a, min(a + BLOCK, int(cuts[c + 1]))


def fit(v: Vocabulary, texts: list[tuple[str, bool]], seed: int = 3, rounds: int = 3) -> Network:
    """Truncated backpropagation through ``STEPS`` tokens at a time, states carried along ``STREAMS`` streams of (text, whole?)."""
    rng = np.random.default_rng(seed)
    net = Network(v, rng)
    start, end = len(v.words) + RARE, v.ids[END]
    streams: list[list[int]] = [[] for _ in range(STREAMS)]
    for i in rng.permutation(len(texts)).tolist():
        text, whole = texts[i]
        ids = [start] + [v.id_of(w.decode("utf-8", "replace")) for w in words_of(text)] + [end] * whole
        min(streams, key=len).extend(ids)
    length = min(map(len, streams))
    if length < 2:
        return net.as_float32()
    data = np.array([s[:length] for s in streams])
    state = _State(net)
    for turn in range(rounds):
        _pass(v, net, data, state, 0.01 if turn < rounds - 1 else 0.003)
    return net.as_float32()


class _State:
    """Running means of gradients and of their squares."""

    def __init__(self, net: Network):
        self.mean, self.square, self.step = [np.zeros_like(p) for p in net.params()], [np.zeros_like(p) for p in net.params()], 0


def _pass(v: Vocabulary, net: Network, data: np.ndarray, state: _State, rate: float) -> None:
    """One pass over streams of tokens, one to a row; inputs that start a text are no targets."""
    start, k = len(v.words) + RARE, HIDDEN
    n, length = data.shape
    kind = net.table.dtype
    h = np.zeros((n, k), kind)
    for at in range(0, length - 1, STEPS):
        x = np.ascontiguousarray(data[:, at:at + STEPS + 1][:, :-1].T)
        y = data[:, at + 1:at + STEPS + 1].T.ravel()
        fresh = [np.flatnonzero(row == start) for row in x]
        # a column to a stream, as in ``step``
        h0, hs, z, r, g, u = np.empty((6, len(x), k, n), kind)
        for t in range(len(x)):
            h0[t] = h.T
            h0[t][:, fresh[t]] = 0
            h, *rest = net.step(x[t], h0[t].T)
            for kept, new in zip((hs, z, r, g, u), (h, *rest), strict=True):
                kept[t] = new.T
        used = np.flatnonzero(y != start)
        if not len(used):
            continue
        # in order of classes, so that the rows of each stand together
        classes = v.classes_of(y[used])
        order = np.argsort(classes, kind="stable")
        classes, order = classes[order], used[order]
        words, ordered = y[order] % v.size, hs.transpose(0, 2, 1).reshape(-1, k)[order]
        grads = [np.zeros_like(p) for p in net.params()]
        d_table, d_inner, d_to_class, d_to_word, d_class_bias, d_word_bias = grads
        d_ordered = np.empty_like(ordered)
        for a in range(0, len(order), BLOCK):
            d_ordered[a:a + BLOCK] = _softmax_back(ordered[a:a + BLOCK], net.to_class, net.class_bias, classes[a:a + BLOCK], d_to_class, d_class_bias)
        for c, a, e in _runs(classes, v.own):
            d_ordered[a:e] += _softmax_back(ordered[a:e], net.to_word[c], net.word_bias[c], words[a:e], d_to_word[c], d_word_bias[c])
        d_h = np.zeros((x.size, k), kind)
        d_h[order] = d_ordered
        d_h = np.ascontiguousarray(d_h.reshape(len(x), n, k).transpose(0, 2, 1))
        by_z, by_g, by_r = (h0 - g) * z * (1 - z), (1 - z) * (1 - g * g), u * r * (1 - r)
        into, d_g = np.empty((len(x), 3 * k, n), kind), np.empty_like(g)
        back = np.zeros((k, n), kind)
        for t in range(len(x) - 1, -1, -1):
            d = d_h[t]
            d += back
            np.multiply(d, by_g[t], out=d_g[t])
            np.multiply(d, by_z[t], out=into[t, :k])
            np.multiply(d_g[t], by_r[t], out=into[t, k:2 * k])
            np.multiply(d_g[t], r[t], out=into[t, 2 * k:])
            back = net.inner @ into[t]
            d *= z[t]
            back += d
            back[:, fresh[t]] = 0
            d_inner += h0[t] @ into[t].T
        into[:, 2 * k:] = d_g
        inputs, owner = np.unique(x, return_inverse=True)
        owner = owner.ravel()
        for i in range(3 * k):
            d_table[inputs, i] = np.bincount(owner, into[:, i].ravel(), len(inputs))
        state.step += 1
        norm = math.sqrt(sum(float(np.vdot(d, d)) for d in grads)) / len(used)
        scale = float(1 / len(used) / max(1.0, norm))
        for param, d, m, s in zip(net.params(), grads, state.mean, state.square, strict=True):
            # m += 0.1 * (d - m), s += 0.01 * (d * d - s), without arrays in between
            d *= scale
            m *= 0.9
            m += 0.1 * d
            d *= d
            d *= 0.01
            s *= 0.99
            s += d
            np.multiply(s, 1 / (1 - 0.99 ** state.step), out=d)
            np.sqrt(d, out=d)
            d += 1e-6
            np.divide(m, d, out=d)
            d *= rate / (1 - 0.9 ** state.step)
            param -= d
        net.word_bias.reshape(-1)[len(v.words):] = -1e9


def _softmax_back(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, target: np.ndarray, d_weights: np.ndarray, d_bias: np.ndarray) -> np.ndarray:
    """Gradient of minus the target's log softmax by ``h``; those by weights and bias are added to ``d_weights`` and ``d_bias``."""
    p, total, _ = _exponentials(h, weights, bias, target)
    p /= total[:, None]
    p[np.arange(len(p)), target] -= 1
    d_weights += h.T @ p
    d_bias += np.ones(len(p), p.dtype) @ p
    return p @ weights.T


def _learn_chunk(v: Vocabulary, net: Network, ids: list[np.ndarray], state: _State, rate: float) -> None:
    """A pass over all tokens of ``ids``: streams meet in one token, so each is a target once; the last is filled up with starts."""
    flat = np.concatenate(ids)
    n = int(np.clip(len(flat) // (STEPS * 32), LEAST_STREAMS, MOST_STREAMS))
    length = -(-len(flat) // n)
    flat = np.concatenate((flat, np.full(n * length + 1 - len(flat), len(v.words) + RARE)))
    _pass(v, net, flat[np.arange(n)[:, None] * length + np.arange(length + 1)], state, rate)


def _stream(v: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs of all texts in a row, each between its start and its end; where each text begins, and the last ends; tokens of each)."""
    words, owner = tokens_of(texts)
    lengths = np.bincount(owner, minlength=len(texts)) + 1
    ends = np.concatenate(([0], np.cumsum(lengths + 1)))
    flat = np.empty(ends[-1], np.int32)
    flat[ends[:-1]], flat[ends[1:] - 1] = len(v.words) + RARE, v.ids[END]
    flat[np.arange(len(owner)) + 2 * owner + 1] = v.ids_of(words)[0]
    return flat, ends, lengths


#: Tokens that a shard of a round learns from, about.
SHARD_TOKENS = 1_500_000


def learn_all(v: Vocabulary, net: Network, texts: DataFrame) -> Network:
    """The network after ``ROUNDS`` rounds over all rows of ``texts(key, text)``, each of them in the round and the shard that its key gives."""
    shards = max(1, -(-v.tokens // (ROUNDS * SHARD_TOKENS)))
    for number, rate in zip(range(ROUNDS), RATES, strict=True):
        shared = texts.sparkSession.sparkContext.broadcast((v, net))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate) -> Iterator[pa.RecordBatch]:
            vocab, before = shared.value
            own, tokens, size, ids = copy.deepcopy(before), 0, 0, []
            state = _State(own)
            for b in _parts(batches, 2000):
                flat, ends, lengths = _stream(vocab, b.column(0))
                row, sums = 0, np.cumsum(lengths)
                while row < len(sums):
                    # up to the text that fills the chunk
                    before_row = int(sums[row - 1]) if row else 0
                    to = min(len(sums), int(np.searchsorted(sums, before_row + CHUNK_TOKENS - size)) + 1)
                    ids.append(flat[ends[row]:ends[to]])
                    size += int(sums[to - 1]) - before_row
                    row = to
                    if size >= CHUNK_TOKENS:
                        _learn_chunk(vocab, own, ids, state, rate)
                        tokens, size, ids = tokens + size, 0, []
            if ids:
                _learn_chunk(vocab, own, ids, state, rate)
                tokens += size
            if tokens:
                change = np.concatenate([(a - b).ravel() for a, b in zip(own.params(), before.params(), strict=True)])
                change = change.astype(np.float64) * tokens
                for slot, at in enumerate(range(0, len(change), SLOT)):
                    yield pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int32()), "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "tokens": pa.array([tokens], pa.int64()), "change": pa.array([change[at:at + SLOT].tobytes()], pa.binary())})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("part")
            total = np.zeros(len(pdf["change"].iloc[0]) // 8)
            for c in pdf["change"]:
                total += np.frombuffer(c)
            return pdf.iloc[:1].assign(part=pdf["part"].iloc[0] // 64, tokens=int(pdf["tokens"].sum()), change=total.tobytes())[["slot", "part", "tokens", "change"]]

        schema = "slot int, part int, tokens long, change binary"
        dealt = texts.where(F.pmod("key", F.lit(ROUNDS)) == number).repartition(shards, F.xxhash64("key")).sortWithinPartitions("key", "text")
        rows = dealt.select("text").mapInArrow(run, schema)
        salted = rows.groupBy("slot", F.expr("part div 64")).applyInPandas(add, schema)
        sums = sorted(written(salted.groupBy("slot").applyInPandas(add, schema), "lm-weights").collect(), key=lambda r: r["slot"])
        shared.unpersist()
        if sums:
            change, at = np.concatenate([np.frombuffer(r["change"]) / r["tokens"] for r in sums]), 0
            for param in net.params():
                param += change[at:at + param.size].reshape(param.shape).astype(param.dtype)
                at += param.size
    return net


def score_texts(v: Vocabulary, net: Network, texts: pa.Array) -> list[pa.Array]:
    """(tokens, known tokens, base score, score, words whose counts are elsewhere) of each text; the last are missing in the others."""
    words, owner = tokens_of(texts)
    n, end = len(texts), v.ids[END]
    ids, at = v.ids_of(words)
    _, of_place, logs, shares = v.places
    here = at >= 0
    last = int(np.flatnonzero(of_place == end)[0])
    known = np.bincount(owner[here], minlength=n) + 1
    base = np.bincount(owner[here], logs[at[here]], n) + logs[last] - known * math.log10(v.base_room)
    lengths = np.bincount(owner, minlength=n) + 1
    firsts = np.cumsum(lengths) - lengths
    flat = np.full(len(ids) + n, end, np.int32)
    flat[np.arange(len(ids)) + owner] = ids
    own = np.bincount(owner[here], shares[at[here]], n) + _network_scores(v, net, [flat[a:a + m] for a, m in zip(firsts.tolist(), lengths.tolist(), strict=True)])
    tail = words.filter(pa.array(~here)).dictionary_encode()
    pairs, times = np.unique(owner[~here] * max(1, len(tail.dictionary)) + tail.indices.to_numpy(), return_counts=True)
    in_text, word = np.divmod(pairs, max(1, len(tail.dictionary)))
    tails = pa.MapArray.from_arrays(pa.array(np.searchsorted(in_text, np.arange(n + 1)), pa.int32()), tail.dictionary.take(pa.array(word)), pa.array(times, pa.int64()))
    return [pa.array(lengths, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(own), tails]


def _network_scores(v: Vocabulary, net: Network, ids: list[np.ndarray]) -> np.ndarray:
    """log10 of the network's part of each text's probability."""
    length = np.array([len(x) for x in ids])
    order = np.argsort(-length, kind="stable")
    total = np.zeros(len(ids))
    h = np.zeros((len(ids), HIDDEN), np.float32, order="F")
    previous = np.full(len(ids), len(v.words) + RARE)
    numbers = np.arange(len(ids))
    longest = int(length.max()) if len(ids) else 0
    sorted_len = length[order]
    flat = np.concatenate([ids[i] for i in order.tolist()]) if len(ids) else np.zeros(0, np.int32)
    first = np.cumsum(sorted_len) - sorted_len
    states, owners, targets, size = [], [], [], 0
    for at in range(0, longest, SCORE_STEPS):
        n = int(np.searchsorted(-sorted_len, -at, side="left"))
        span = np.minimum(sorted_len[:n] - at, SCORE_STEPS)
        for t in range(int(span[0])):
            m = int(np.searchsorted(-span, -t, side="left")) if t else n
            # texts are in order of length, so those that still have a token are the first m
            states.append(net.step(previous[:m], h[:m])[0])
            targets.append(flat[first[:m] + (at + t)])
            owners.append(numbers[:m])
            h[:m], previous[:m] = states[-1], targets[-1]
            size += m
        if size >= SCORE_STATES or at + SCORE_STEPS >= longest:
            target = np.concatenate(targets)
            logs = net.log_probabilities(np.concatenate(states), v.classes_of(target), np.where(target < len(v.words), target % v.size, -1))
            total[order] += np.bincount(np.concatenate(owners), logs, len(ids))
            states, owners, targets, size = [], [], [], 0
    return total / math.log(10)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``(word, c)`` over all texts; the end of a text counts under the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, ends = [], 0, 0
        for b in _parts(batches, 2000):
            words, _ = tokens_of(b.column(0))
            parts.append(words)
            size, ends = size + len(words), ends + b.num_rows
            if size >= COUNT_WORDS:
                yield _counted(parts)
                parts, size = [], 0
        if parts:
            yield _counted(parts)
        yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends], pa.int64())], ["word", "c"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")).where("c > 0")


def _counted(words: list[pa.Array]) -> pa.RecordBatch:
    counts = pa.chunked_array(words, pa.string()).value_counts()
    return pa.RecordBatch.from_arrays(counts.flatten(), ["word", "c"])


def vocabulary(counts: DataFrame) -> Vocabulary | None:
    """Totals and the frequent words of ``counts(word, c)``; None if there are no tokens."""
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    if not totals["n"]:
        return None
    n = totals["n"]
    head = {r["word"]: r["c"] for r in counts.where((F.col("c") >= n * HEAD_SHARE) | (F.col("word") == END)).collect()}
    words = sorted((w for w, c in head.items() if c >= n * WORD_SHARE or w == END), key=lambda w: (-head[w], w))
    rare_n, rare_v = np.zeros(RARE), np.zeros(RARE)
    for r in counts.groupBy(rare_class_column(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        rare_n[r["k"]], rare_v[r["k"]] = r["n"], r["v"]
    for w in words:
        rare_n[rare_class(w)] -= head[w]
        rare_v[rare_class(w)] -= 1
    return Vocabulary(words, head, n, totals["v"], rare_n, rare_v)


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row; learns where ``held_out`` is false."""
    learn = docs.where(~held_out)
    counts = written(word_counts(learn, text), "lm-counts")
    v = vocabulary(counts)
    flat = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text"))
    if v is None:
        n = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1
        zero = F.lit(0).cast("long")
        return flat.select("doc_id", "held_out", n.alias("n_tokens"), zero.alias("n_known"), zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    net = learn_all(v, fit(v, _excerpts(learn, text)), learn.select(F.xxhash64(F.col(doc_id), text_key(text), F.lit("round")).alias("key"), F.col(text).cast("string").alias("text")))
    shared = docs.sparkSession.sparkContext.broadcast((v, net))
    kind = flat.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, network = shared.value
        row = TaskContext.get().partitionId() << 36
        for b in _parts(batches, SCORE_ROWS, 2):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + b.num_rows)), b.column(0), b.column(1), *score_texts(vocab, network, b.column(2))], ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "own", "tail"])
            row += b.num_rows

    scored = written(flat.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, own double, tail map<string,long>"), "lm-scored")
    rare_room = F.array(*[F.lit(float(math.log10(x))) for x in v.rare_room])
    tail = scored.select("row", F.explode("tail").alias("w", "n"))
    log = F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.5))
    parts = (tail.join(counts, F.col("w") == F.col("word"), "left").groupBy(F.col("row").alias("at"))
             .agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * (log - F.lit(math.log10(v.base_room)))).alias("base_more"),
                  F.sum(F.col("n") * (log - rare_room[rare_class_column(F.col("w"))])).alias("own_more")))
    none = F.lit(0)
    return (scored.drop("tail").join(parts, F.col("row") == F.col("at"), "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", none)).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"), (F.col("own") + F.coalesce("own_more", F.lit(0.0))).alias("score")))


def _excerpts(learn: DataFrame, text: str) -> list[tuple[str, bool]]:
    """(excerpt, whether it is the whole text) of a bounded sample of distinct texts, chosen by a hash of the text."""
    key = text_key(text)
    n = learn.agg(F.countDistinct(key)).first()[0]
    mix = F.pmod(F.xxhash64(key, F.lit("lm")), F.lit(1 << 30)) / float(1 << 30)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # the excerpt starts anywhere in the text, at a word
    start = F.pmod(F.xxhash64(key, F.lit("at")), F.greatest(F.lit(1), F.length(whole) - FIT_CHARS + 1)).cast("int") + 1
    cut = F.substring(whole, start, F.lit(FIT_CHARS))
    cut = F.when(start > 1, F.regexp_replace(cut, r"^[^\x20\x09-\x0D]+", "")).otherwise(cut)
    part = (learn.where(mix < min(1.0, 1.5 * FIT_ROWS / max(1, n)))
            .select(key.alias("key"), mix.alias("mix"), cut.alias("part"), (F.length(whole) <= FIT_CHARS).alias("whole")).distinct())
    return [(r["part"], r["whole"]) for r in part.orderBy("mix", "part").limit(FIT_ROWS).collect()]
