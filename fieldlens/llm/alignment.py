"""Alignment of two tokenisations of the same text: groups of tokens between common ends, and how often token pairs are linked.

Tokens of A and B are spans of the text's bytes. Merging walks both lists of ends: the token that ends first is passed, both are passed where they
end together, and that place is a cut. One NumPy state holds the pointers of every document of a batch, and each step advances all of them at
once; those that are through leave the state. A long document enters the state in lanes of ``LANE_BYTES`` bytes, each starting where the merge
would stand at that byte (a binary search in each list of ends), so that no document is left to walk alone; its cuts are the same.

Every step emits the overlapping pairs it stands on, and its cuts. Between two cuts each token of A is linked with each token of B: the
emitted pairs are all links of groups with one token on a side; the few other groups are multiplied out, in blocks.

How many documents hold a pair is counted over the corpus, with partial counts in each task. Counts go back to the documents in two ways: pairs that
have more than 1 / ``HEAD`` of all counts, at most ``HEAD`` of them, are broadcast and looked up where the document's pairs lie; the others are
joined by shuffling. The highest count of each token of A has at most as many rows as A has entries, and is broadcast.

Defined cases: a text that is null, empty, or that a tokeniser does not give back byte for byte has no tokens (zeros, an empty digest); rows that repeat
count as documents of their own; a null doc_id takes part; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.shared import batches_of, written

#: Bytes of a lane of the merge.
LANE_BYTES = 1024
#: Bytes of text that are merged at once, about; a longer text makes a batch of its own.
BATCH_BYTES = 1 << 20
#: Products of tokens that are held at once while groups are multiplied out.
BLOCK = 1 << 21
#: At most so many pairs are broadcast with their counts.
HEAD = 1 << 19
#: Pair code: id of A times this, plus id of B.
PAIR = 1 << 20
#: Within a batch, the number of the document times this, plus the pair code.
DOC = 1 << 40


# -- tokenisers ----------------------------------------------------------------------------------------------

def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Entries:
    """A tokeniser's entries by id: their bytes, lengths and decimal ids."""

    spans: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(s) for s in self.spans], np.int64)


class ByteLevel:
    """Byte-level BPE of a ``tokenizers`` file. Where merges rank as their ids do (checked), its entries are encoded by ``tiktoken``, which
    gives the same ids several times faster; otherwise by ``tokenizers`` itself. Special tokens have no meaning in texts."""

    #: The word pattern of the byte-level pre-tokeniser, a fixed value.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: Longer runs without a word end are left to ``tokenizers``, whose time does not grow with their square.
    LONG_WORD = 10_000

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        char = _byte_of_char()
        vocab, special = spec["model"]["vocab"], {t["id"] for t in spec.get("added_tokens", [])}
        spans = [b""] * (1 + max([*vocab.values(), *special]))
        for word, i in vocab.items():
            if i not in special:
                spans[i] = bytes(char[c] for c in word)
        self.entries = Entries(spans)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merged = [vocab[a + b] for a, b in pairs]
        before, words = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        alike = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and words is None
                 and all(a < b for a, b in zip(merged, merged[1:])))
        ranks = {s: i for i, s in enumerate(spans) if s}
        self.quick = tiktoken.Encoding("entries", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}) if alike else None

    def encode(self, text: str) -> np.ndarray:
        if self.quick is None or (len(text) > self.LONG_WORD and max(map(len, text.split(" "))) > self.LONG_WORD):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.quick.encode_ordinary(text), np.int64)


class Pieces:
    """A SentencePiece model with byte fallback. It puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spans = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            silent = self.model.is_control(i) or self.model.is_unknown(i)
            spans.append(b"" if silent else bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.entries = Entries(spans)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


@lru_cache(2)
def _loaded(byte_level: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(byte_level), Pieces(pieces)


def public_file(name: str) -> str:
    """Place of one of the installed public tokeniser files."""
    import public_tokenizers

    return public_tokenizers.path(name)


# -- the merge -----------------------------------------------------------------------------------------------

@dataclass
class Merged:
    """Of a batch, with tokens numbered through all its documents: overlapping pairs, the last tokens of each group, in order, and steps taken."""

    a_link: np.ndarray
    b_link: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    steps: int


def merge(a_ends: list[np.ndarray], b_ends: list[np.ndarray], lane_bytes: int = LANE_BYTES) -> Merged:
    """Ends of the tokens of each document by A and by B; the last ends of a document are equal."""
    a_start, b_start = np.cumsum([0, *map(len, a_ends)]), np.cumsum([0, *map(len, b_ends)])
    lanes = []
    for d, (a, b) in enumerate(zip(a_ends, b_ends)):
        if len(a):
            marks = np.append(np.arange(0, a[-1], lane_bytes), a[-1])
            # a lane covers the tokens that end after its mark, up to the next mark
            i, j = np.searchsorted(a, marks, "right") + a_start[d], np.searchsorted(b, marks, "right") + b_start[d]
            lanes.append((i[:-1], i[1:], j[:-1], j[1:]))
    if not lanes:
        none = np.zeros(0, np.int64)
        return Merged(none, none, none, none, 0)
    i, stop_i, j, stop_j = (np.concatenate(x) for x in zip(*lanes))
    a_all, b_all = np.concatenate(a_ends), np.concatenate(b_ends)
    links, cuts, steps = [], [], 0
    while True:
        live = (i < stop_i) | (j < stop_j)
        if not live.all():  # lanes that are through leave
            i, j, stop_i, stop_j = i[live], j[live], stop_i[live], stop_j[live]
        if not len(i):
            break
        x, y = a_all[i], b_all[j]
        links.append((i, j))
        cut = x == y
        cuts.append((i[cut], j[cut]))
        i = i + (x <= y)
        j = j + (y <= x)
        steps += 1
    a_link, b_link = (np.concatenate(x) for x in zip(*links))
    a_cut, b_cut = (np.sort(np.concatenate(x)) for x in zip(*cuts))
    return Merged(a_link, b_link, a_cut, b_cut, steps)


def _counted(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, in order, and their times added up."""
    keys, place = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, np.concatenate(times))
    return keys, total


def linked(m: Merged, a: np.ndarray, b: np.ndarray, doc: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``a``, ``b``: ids of all tokens; ``doc``: the document of each A token -> keys (document, pair), in order, and the links of each."""
    a_size, b_size = np.diff(m.a_cut, prepend=-1), np.diff(m.b_cut, prepend=-1)
    a_at, b_at = m.a_cut - a_size + 1, m.b_cut - b_size + 1
    crossed = (a_size > 1) & (b_size > 1)  # here tokens that do not overlap are linked, too
    plain = ~crossed[np.searchsorted(m.a_cut, m.a_link)]
    keys, n = np.unique(doc[m.a_link[plain]] * DOC + a[m.a_link[plain]] * PAIR + b[m.b_link[plain]], return_counts=True)
    codes, times = [keys], [n]
    per = a_size * b_size
    few = np.flatnonzero(crossed & (per <= block))
    upto = np.cumsum(per[few])
    at = 0
    while at < len(few):
        g = few[at:max(at + 1, np.searchsorted(upto, (upto[at - 1] if at else 0) + block, "right"))]
        at += len(g)
        of = np.repeat(g, per[g])
        k = np.arange(len(of)) - np.repeat(np.cumsum(per[g]) - per[g], per[g])
        i, j = a_at[of] + k // b_size[of], b_at[of] + k % b_size[of]
        keys, n = np.unique(doc[i] * DOC + a[i] * PAIR + b[j], return_counts=True)
        codes.append(keys)
        times.append(n)
    for g in np.flatnonzero(crossed & (per > block)):  # very many products: distinct ids, a few of A at a time
        ua, ca = np.unique(a[a_at[g]:a_at[g] + a_size[g]], return_counts=True)
        ub, cb = np.unique(b[b_at[g]:b_at[g] + b_size[g]], return_counts=True)
        some = max(1, block // len(ub))
        for lo in range(0, len(ua), some):
            codes.append((doc[a_at[g]] * DOC + ua[lo:lo + some, None] * PAIR + ub).ravel())
            times.append((ca[lo:lo + some, None] * cb).ravel())
    return (codes[0], times[0].astype(np.int64)) if len(codes) == 1 else _counted(codes, times)


_ENDINGS = (b",", b"|", b";")


@lru_cache(2)
def _names(entries: int) -> list[bytes]:
    """``id`` with each ending, three for an id."""
    return [b"%d%s" % (i, e) for i in range(entries) for e in _ENDINGS]


def groups_text(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, entries: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: ids of each group of a document; ``entries``: more than the largest id."""
    a_name, b_name = a * 3, b * 3
    a_name[np.cumsum(a_size) - 1] += 1
    b_name[np.cumsum(b_size) - 1] += 2
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.repeat(np.cumsum(b_size) - b_size, a_size)] = a_name
    out[np.arange(len(b)) + np.repeat(np.cumsum(a_size), b_size)] = b_name
    names = _names(entries)
    return b"".join([names[k] for k in out.tolist()])[:-1]


# -- over the corpus -----------------------------------------------------------------------------------------

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
_ALIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                      ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def _tokens(text: str | None, first: ByteLevel, second: Pieces) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids by both, or nothing if one of them does not give the text back."""
    if not text:
        return None
    whole = f" {text}".encode()
    a = first.encode(f" {text}")
    spans = first.entries.spans
    if b"".join([spans[k] for k in a.tolist()]) != whole:
        return None
    b = second.encode(text)
    spans = second.entries.spans
    return (a, b) if b"".join([spans[k] for k in b.tolist()]) == whole else None


def _align_texts(rows: list[tuple[int, int | None, str | None]], first: ByteLevel, second: Pieces) -> pa.RecordBatch:
    ids = [_tokens(t, first, second) for _, _, t in rows]
    none = np.zeros(0, np.int64)
    a_ids, b_ids = [x[0] if x else none for x in ids], [x[1] if x else none for x in ids]
    n_a, n_b = [len(x) for x in a_ids], [len(x) for x in b_ids]
    m = merge([np.cumsum(first.entries.lengths[x]) for x in a_ids], [np.cumsum(second.entries.lengths[x]) for x in b_ids])
    keys, times = linked(m, np.concatenate(a_ids), np.concatenate(b_ids), np.repeat(np.arange(len(rows)), n_a))
    offsets = np.searchsorted(keys, np.arange(len(rows) + 1) * DOC)
    n_links = np.diff(np.append(0, np.cumsum(times))[offsets])
    a_size, b_size = np.diff(m.a_cut, prepend=-1), np.diff(m.b_cut, prepend=-1)
    cuts = np.searchsorted(m.a_cut, np.append(0, np.cumsum(n_a)))
    entries = max(len(first.entries.spans), len(second.entries.spans))
    digests = []
    for d, (a, b) in enumerate(zip(a_ids, b_ids)):
        mine = slice(cuts[d], cuts[d + 1])
        digests.append(hashlib.sha256(groups_text(a, b, a_size[mine], b_size[mine], entries)).hexdigest() if len(a) else "")
    lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(v)) for v in (keys % DOC, times)]
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
               pa.array(np.diff(cuts)), pa.array(n_links), pa.array(digests, pa.string()), *lists]
    return pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)


def _align(batches: Iterator[pa.RecordBatch], files: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    first, second = _loaded(*files)
    held, size = [], 0
    for batch in batches_of(batches, 256):
        for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            held.append((row, doc_id, text))
            size += 4 * len(text or "") + 64
            if size >= 4 * BATCH_BYTES:
                yield _align_texts(held, first, second)
                held, size = [], 0
    if held:
        yield _align_texts(held, first, second)


def aligned(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: its numbers of tokens, groups and links, the digest of its groups, and its distinct linked pairs with their links."""
    files = (byte_level, pieces)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda batches: _align(batches, files), ALIGNED)


def pair_counts(found: DataFrame) -> DataFrame:
    """``(pair, docs)``: how many documents hold each linked pair."""
    return found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))


_SUMS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<long>"
_SUMMED = pa.schema([*list(_ALIGNED)[:7], ("n_best", pa.int64()), ("count_sum", pa.int64()), *list(_ALIGNED)[7:]])


def _look_up(batches: Iterator[pa.RecordBatch], head) -> Iterator[pa.RecordBatch]:
    """Adds up what the broadcast pairs give; pairs that are not among them stay listed."""
    codes, counts, best = head.value
    for batch in batches_of(batches, 2000):
        pairs, times = batch.column("pairs"), batch.column("times")
        flat, links = pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(pairs.offsets.to_numpy())
        of = np.repeat(np.arange(batch.num_rows), sizes)
        if len(codes):
            at = np.minimum(np.searchsorted(codes, flat), len(codes) - 1)
            known = codes[at] == flat
        else:
            at, known = np.zeros(len(flat), np.int64), np.zeros(len(flat), bool)
        sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        np.add.at(sums, of[known], links[known] * counts[at[known]])
        np.add.at(bests, of[known], links[known] * best[at[known]])
        left = np.append(0, np.cumsum(np.bincount(of[~known], minlength=batch.num_rows))).astype(np.int32)
        rest = [pa.ListArray.from_arrays(pa.array(left), pa.array(v[~known])) for v in (flat, links)]
        plain = [batch.column(n) for n in _SUMMED.names[:7]]
        yield pa.RecordBatch.from_arrays([*plain, pa.array(bests), pa.array(sums), *rest], schema=_SUMMED)


def align(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of ``docs``. Of a document's links, ``n_best`` have
    the highest count of their A token, and ``count_sum`` adds up the counts of all."""
    spark = docs.sparkSession
    found = written(aligned(docs, byte_level, pieces, doc_id, text), "aligned")
    counts = written(pair_counts(found), "aligned-pairs")
    top = written(counts.groupBy(F.expr(f"pair div {PAIR}").alias("a")).agg(F.max("docs").alias("most")), "aligned-best")
    ranked = written(counts.join(F.broadcast(top), F.expr(f"pair div {PAIR}") == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "aligned-ranked")
    total = ranked.agg(F.sum("docs")).first()[0] or 0
    # at most ``head`` pairs can have more than this share of all counts
    kept = ranked.where(F.col("docs") * F.lit(head) > F.lit(total)).orderBy("pair").toPandas()
    shared = spark.sparkContext.broadcast((kept["pair"].to_numpy(np.int64), kept["docs"].to_numpy(np.int64), kept["best"].to_numpy(np.int64)))
    summed = written(found.mapInArrow(lambda batches: _look_up(batches, shared), _SUMS), "aligned-sums")
    # each of these pairs has at most 1 / ``head`` of all counts, so there is no hot key among them
    rest = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    more = (rest.join(ranked.where(F.col("docs") * F.lit(head) <= F.lit(total)), "pair")
            .groupBy(F.col("row").alias("of")).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum")))
    return summed.join(more, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
