"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The patterns give the base spans of every text. The network reads windows of ``WINDOW`` characters that overlap by
``WINDOW - STRIDE``; each window is decoded by Viterbi, a span is taken from the window that owns its first character (the
one in whose middle it lies), and over the whole text spans that collide are settled by score. Base spans always stay;
a span of the network is added where it touches no base span.

A span of the network must hold a digit or ``@`` (as all labelled spans do), so windows without either cannot
give one and are not run: the result is the same as with them.

The network is trained in numpy from labelled spans: a bounded sample of ``FIT_ROWS`` texts' excerpts labelled by the patterns,
and generated spans of every kind set into them. Defined cases: null and empty texts have no spans;
null ids stay; rows that repeat give a row each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm import crf
from fieldlens.llm.shared import batches_of, text_key

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
HIDDEN = 16
FIT_ROWS, FIT_WINDOWS = 500, 1200
RUN_WINDOWS = 4096
#: A span of the network needs this mean posterior of its tags, and this many digits by kind.
SURE, DIGITS = 0.9, (0, 4, 13, 8)

Span = tuple[int, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Digits match as whole runs: a match that fails at a run's first digit fails at its others too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# -- the network ---------------------------------------------------------------------------------------------

_TAGS = 1 + 2 * len(KINDS)  # outside; first and further characters of each kind
#: Character inputs: padding, ASCII one by one, other letters, all else.
_OTHER_LETTER, _OTHER, _INPUTS = 129, 130, 131


def _inputs(points: np.ndarray) -> np.ndarray:
    """Network inputs of code points."""
    x = np.where(points < 128, points + 1, _OTHER)
    return np.where((points >= 0xC0) & (points < 0x2000), _OTHER_LETTER, x).astype(np.int16)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Per direction an input table, recurrent weights and output weights; shared output bias and CRF transitions."""

    table: list[np.ndarray]
    inner: list[np.ndarray]
    out: list[np.ndarray]
    bias: np.ndarray
    steps: np.ndarray
    start: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [*self.table, *self.inner, *self.out, self.bias, self.steps, self.start]

    def emissions(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(n, length, tags) scores of windows ``x`` (n, length); ``keep`` gets what backpropagation needs."""
        n, length = x.shape
        total = np.broadcast_to(self.bias, (n, length, _TAGS)).copy()
        for way in (0, 1):
            h = np.zeros((n, HIDDEN), self.bias.dtype)
            c = np.zeros_like(h)
            for t in range(length) if way == 0 else range(length - 1, -1, -1):
                z = self.table[way][x[:, t]] + h @ self.inner[way]
                gates = _sigmoid(z[:, :3 * HIDDEN])
                g = np.tanh(z[:, 3 * HIDDEN:])
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
                before = (h, c)
                c = f * c + i * g
                th = np.tanh(c)
                h = o * th
                total[:, t] += h @ self.out[way]
                if keep is not None:
                    keep.append((way, t, before, i, f, o, g, th, h))
        return total

    def backward(self, x: np.ndarray, slope: np.ndarray, kept: list) -> list[np.ndarray]:
        """Gradients of table, inner, out and bias for the emissions' ``slope``."""
        d_table, d_inner, d_out = ([np.zeros_like(p) for p in ps] for ps in (self.table, self.inner, self.out))
        n = len(x)
        dh, dc, last = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), None
        for way, t, (h0, c0), i, f, o, g, th, h in reversed(kept):
            if way != last:
                dh, dc, last = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), way
            d_out[way] += h.T @ slope[:, t]
            dh = dh + slope[:, t] @ self.out[way].T
            dc = dc + dh * o * (1 - th * th)
            dz = np.concatenate((dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)), axis=1)
            np.add.at(d_table[way], x[:, t], dz)
            d_inner[way] += h0.T @ dz
            dh, dc = dz @ self.inner[way].T, dc * f
        return [*d_table, *d_inner, *d_out, slope.sum(axis=(0, 1))]


def _new(rng: np.random.Generator) -> Network:
    table = [rng.normal(0, 0.3, (_INPUTS, 4 * HIDDEN)) for _ in range(2)]
    for t in table:
        t[:, HIDDEN:2 * HIDDEN] += 1  # remember at first
    return Network(table, [rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)) for _ in range(2)], [rng.normal(0, 0.2, (HIDDEN, _TAGS)) for _ in range(2)], np.zeros(_TAGS), np.zeros((_TAGS, _TAGS)), np.zeros(_TAGS))


def _made(rng: np.random.Generator, kind: int) -> str:
    """A generated span; forms that the patterns miss are among them."""
    some = lambda chars, a, b: "".join(rng.choice(list(chars), int(rng.integers(a, b + 1))))
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    if kind == 0:
        return some(letters, 3, 9) + rng.choice([".", "_", "-", ""]) + some(letters + digits, 1, 5) + "@" + some(letters + digits, 3, 9) + "." + rng.choice(["com", "org", "net", "example.com", "co.uk", "io"])
    if kind == 1:
        return ".".join(str(rng.integers(256)) for _ in range(4))
    if kind == 2:
        body = rng.choice(["4", "5", "37", "6"]) + some(digits, 14, 14)
        body = (body + "0" * 15)[:15]
        last = next(str(d) for d in range(10) if _luhn(body + str(d)))
        gap = rng.choice(["", "", " ", "-"])
        return gap.join((body + last)[i:i + 4] for i in range(0, 16, 4))
    a, b, c = some(digits, 3, 3), some(digits, 3, 3), some(digits, 4, 4)
    return str(rng.choice([f"+{rng.integers(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"+{rng.integers(1, 99)}{a}{b}{c}", f"+{rng.integers(1, 99)} {a} {b} {c}", f"00{rng.integers(10, 99)} {a} {b}{c}"]))


def _decoy(rng: np.random.Generator) -> str:
    """Numbers and codes that are no personal data."""
    n = lambda a, b: int(rng.integers(a, b))
    return str(rng.choice([f"{n(1900, 2100)}", f"{n(1, 32)}.{n(1, 13)}.{n(1900, 2100)}", f"{n(1, 99)}.{n(0, 99)}", f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(0, 24):02}:{n(0, 60):02}", f"v{n(0, 9)}.{n(0, 20)}.{n(0, 20)}", f"{n(1, 999)},{n(100, 999)}", "%032x" % n(0, 1 << 62), f"#{n(1, 99999)}", f"{n(1, 100)}%", "@" + "abcdefghij"[n(0, 5):n(6, 10)]]))


def train(excerpts: list[str], seed: int = 5, rounds: int = 10) -> Network:
    """Fits the network on excerpts labelled by the patterns, most with a generated span or a decoy set in."""
    rng = np.random.default_rng(seed)
    excerpts = sorted(excerpts) or ["the text has no rows to learn from"]
    xs, ys = np.zeros((FIT_WINDOWS, WINDOW), np.int16), np.zeros((FIT_WINDOWS, WINDOW), np.int64)
    for r in range(FIT_WINDOWS):
        text = excerpts[r % len(excerpts)]
        extra: Span | None = None
        if r % 4:
            kind = int(rng.integers(len(KINDS)))
            piece = _made(rng, kind) if r % 4 < 3 else _decoy(rng)
            gaps = [m.end() for m in re.finditer(r"\s", text)] or [0]
            at = gaps[int(rng.integers(len(gaps)))]
            piece_end = at + len(piece)
            text = text[:at] + piece + " " + text[at:]
            if r % 4 < 3:
                extra = (kind, at, piece_end)
            middle = at + int(rng.integers(-20, 20))
        else:
            found = [m.start() for m in re.finditer(r"[0-9@]", text)] or [0]
            middle = found[int(rng.integers(len(found)))]
        a = max(0, min(len(text) - WINDOW, middle - WINDOW // 2))
        tags = np.zeros(len(text), np.int64)
        clash = lambda k, x, y: extra and (k, x, y) != extra and x < extra[2] and y > extra[1]
        for k, x, y in [s for s in base_spans(text) if not clash(*s)] + ([extra] if extra else []):
            tags[x:y] = 2 + 2 * k
            tags[x] = 1 + 2 * k
        part = _inputs(_points(text[a:a + WINDOW]))
        xs[r, :len(part)] = part
        ys[r, :len(part)] = tags[a:a + WINDOW]
    net = _new(rng)
    params = net.params()
    mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(rounds):
        for part in np.array_split(rng.permutation(FIT_WINDOWS), FIT_WINDOWS // 48):
            kept: list = []
            em = net.emissions(xs[part], kept)
            slope, pairs, starts = crf.slopes(em, ys[part], net.steps, net.start)
            grads = [*net.backward(xs[part], slope, kept), pairs, starts]
            size = max(1.0, np.sqrt(sum(float((g * g).sum()) for g in grads)) / (5 * len(part)))
            step += 1
            for p, g, m, v in zip(params, grads, mean, square, strict=True):
                g = g / len(part) / size
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    small = lambda ps: [p.astype(np.float32) for p in ps]
    return Network(small(net.table), small(net.inner), small(net.out), *small([net.bias, net.steps, net.start]))


def _window_starts(n: int) -> np.ndarray:
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)


def network_spans(texts: list[str], net: Network, every: bool = False) -> list[list[tuple[float, Span]]]:
    """Scored spans of the network for each text, reconciled over its windows. ``every``: also run windows that cannot give any."""
    wins: list[tuple[int, int]] = []
    blocks: list[np.ndarray] = []
    for i, text in enumerate(texts):
        if not every and not _DIGIT.search(text) and "@" not in text:
            continue
        points = _points(text)
        marked = np.concatenate(([0], np.cumsum(((points >= 48) & (points <= 57)) | (points == 64))))
        starts = _window_starts(len(points))
        if not every:
            starts = starts[marked[np.minimum(starts + WINDOW, len(points))] > marked[starts]]
        padded = np.concatenate((_inputs(points), np.zeros(WINDOW, np.int16)))
        blocks.append(padded[starts[:, None] + np.arange(WINDOW)])
        wins += [(i, int(a)) for a in starts]
    out: list[list[tuple[float, Span]]] = [[] for _ in texts]
    if not wins:
        return out
    windows = np.concatenate(blocks)
    for at in range(0, len(windows), RUN_WINDOWS):
        x = windows[at:at + RUN_WINDOWS]
        em = net.emissions(x)
        path = crf.viterbi(em, net.steps, net.start)
        path[x == 0] = 0
        flat = crf.forward_backward(em.reshape(-1, _TAGS), np.arange(len(x)) * WINDOW, np.full(len(x), WINDOW), net.steps, net.start)
        prob = np.take_along_axis(flat.reshape(em.shape), path[:, :, None].astype(np.int64), 2)[:, :, 0]
        for w in np.flatnonzero(path.any(axis=1)).tolist():
            i, a = wins[at + w]
            n = len(texts[i])
            edge = (WINDOW - STRIDE) // 2
            low, high = (0 if a == 0 else edge), (WINDOW if a + WINDOW >= n else edge + STRIDE)
            tags, t = path[w], 0
            while t < WINDOW:
                if not tags[t]:
                    t += 1
                    continue
                kind, end = (int(tags[t]) - 1) // 2, t + 1
                while end < WINDOW and tags[end] == 2 + 2 * kind:
                    end += 1
                if low <= t < high:
                    out[i].append((float(prob[w, t:end].mean()), (kind, a + t, a + end)))
                t = end
    return out


def all_spans(texts: list[str | None], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    plain = [t or "" for t in texts]
    more = network_spans(plain, net) if net else [[] for _ in plain]
    out = []
    for text, scored in zip(plain, more, strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        added: list[Span] = []
        for score, (kind, a, b) in sorted(scored, key=lambda s: (-s[0], s[1][1], s[1][0])):
            piece = text[a:b]
            digits = len(_NOT_DIGIT.sub("", piece))
            if score < SURE or digits < DIGITS[kind] or (kind == 0 and not re.search(r"[^@\s]@[^@\s]+\.", piece)) or piece != piece.strip():
                continue
            if all(b <= x or a >= y for x, y in taken):
                added.append((kind, a, b))
                taken.append((a, b))
        out.append((base, sorted(base + added)))
    return out


def fit(docs: DataFrame, text: str = "text") -> Network:
    """Trains on excerpts of at most ``FIT_ROWS`` distinct texts that hold a digit or ``@``, chosen by a hash of the text."""
    held = docs.where(F.col(text).rlike("[0-9@]")).select(text_key(text).alias("k"), F.col(text).cast("string").alias("t"))
    n = held.agg(F.countDistinct("k")).first()[0]
    mix = F.pmod(F.xxhash64("k", F.lit("pii")), F.lit(1 << 30)) / float(1 << 30)
    at = F.greatest(F.lit(1), F.regexp_instr("t", F.lit("[0-9@]")) - 120)
    part = held.where(mix < min(1.0, 2 * FIT_ROWS / max(1, n))).select(mix.alias("mix"), F.substring(F.col("t"), at, F.lit(300)).alias("part"), "k").distinct()
    return train([r["part"] for r in part.orderBy("mix", "part").limit(FIT_ROWS).collect()])


def find(docs: DataFrame, net: Network | None, carry: list[str], text: str = "text") -> DataFrame:
    """The ``carry`` columns of every row with n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 500):
            done = all_spans(b.column(b.num_columns - 1).to_pylist(), shared.value)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in done], pa.int64()) for k in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(spans_text(base).encode()).hexdigest() for base, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *counts, sha, pa.array([spans_text(s) for _, s in done], pa.string())], [*b.schema.names[:-1], *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = docs.select(*carry, F.col(text).cast("string").alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, kinds + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in square brackets; of spans that overlap, the earliest and longest stands."""
    out, done = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
            done = b
        elif b > done:
            done = b
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with all spans redacted in ``text``; other columns and rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 500):
            texts = b.column(place).to_pylist()
            new = [t if t is None or not s else redacted(t, s) for t, (_, s) in zip(texts, all_spans(texts, shared.value), strict=True)]
            cols = list(b.columns)
            cols[place] = pa.array(new, b.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
