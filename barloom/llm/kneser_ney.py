"""Language-model scores: interpolated modified Kneser-Ney over word pairs, counted in Spark.

1. Training texts are cut into tokens (words, then one end). Each slice of a task counts its
   pairs (token before, token) and sends them, packed, to shards by the hash of the pair, so
   that a hot word is spread over all shards.
2. A shard adds up its pairs and writes them as one file: sorted 64-bit pair hashes, counts
   beside them. It also sends on, per word, what its pairs tell about it: count, number of
   distinct tokens before it, and as a context the sum and how many followers have count 1,
   2, 3 and more. These are added up by word and written as sorted arrays in the same way.
3. Workers map the files into memory. Per slice of texts each distinct pair is looked up
   once, in ascending order of its hash, so that the pages are read from front to back.

Files lie in a new folder below ``spark.checkpoint.dir``, which must be a mounted folder
(``file:`` or a plain path) on each executor. Each is written under another name and renamed,
so a lost or repeated task leaves a whole file or none. Orders above two are not offered.

A probability is ``(c - D(c)) / c(h) + g(h) * p(w)``; ``p(w)`` is the same from the numbers of
distinct tokens before a word, and what it leaves goes to all V training tokens and one unknown
alike. So the probabilities of the V known tokens and the unknown one add up to 1 for any context.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import scratch_dir

from .bpe import slices
from .common import read_table

FOLDS = 10  # one of these is held out
SLICE_BYTES = 16_000_000  # text that a task counts at once
SCORE_BYTES = 4_000_000  # text that a task scores at once
SHARD_BYTES = 8_000_000  # training text for each shard of pairs
BATCH_BYTES = "16m"  # of packed rows, which may be large, on their way to a worker
END, BEGIN = np.uint64(1), np.uint64(2)
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_WORD_FIELDS = ["count", "before", "total", "ones", "twos", "more"]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes in ascending order, code of each token, bounds of each text).

    A-Z are lower-cased, words end at ASCII white space; each text ends with ``END``.
    Null is empty.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = pc.list_flatten(parts).dictionary_encode()
    # Lower-casing bytes changes A-Z only.
    table = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) for w in table), np.uint64, len(table))
    real = np.fromiter(map(len, table), np.int64, len(table)) > 0
    known, code = np.unique(np.append(hashes, END), return_inverse=True)
    at = coded.indices.to_numpy(zero_copy_only=False)
    kept = real[at]
    bounds = np.concatenate([[0], np.cumsum(kept)])[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    flat = np.insert(code[at[kept]], bounds[1:], code[-1])
    return known, flat, bounds + np.arange(len(bounds))


def _pairs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with ``BEGIN`` last, pair codes ``before << 32 | token`` of each token, bounds)."""
    known, flat, bounds = tokens(texts)
    before = np.empty(len(flat), np.int64)
    before[1:] = flat[:-1]
    before[bounds[:-1]] = len(known)
    return np.append(known, BEGIN), before << 32 | flat, bounds


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    mixed = (before ^ (before >> np.uint64(31))) * _ODD[0] + token
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[1]
    return mixed ^ (mixed >> np.uint64(32))


def _word_key(words: np.ndarray) -> np.ndarray:
    """The markers too are spread evenly."""
    return words * _ODD[0]


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _sums(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in ascending order and the sums of each column."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], [np.add.reduceat(c[order].astype(np.int64), first) if len(first) else c.astype(np.int64) for c in columns]


def _packed_rows(shard: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per shard: the values of each column that belong to it, as bytes in few bytes each."""
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    out = {"shard": pa.array(numbers, pa.int64())}
    for name, values in columns.items():
        moved = values[order]
        # Planes of bytes: high bytes of small values are zeros next to each other, which the shuffle's codec removes.
        cells = [np.ascontiguousarray(moved[a:b].view(np.uint8).reshape(b - a, -1).T).tobytes() for a, b in zip(starts, ends)]
        out[name] = pa.array(cells, pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _unpacked(column: pa.Array, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    cells = [np.frombuffer(c.as_buffer(), np.uint8).reshape(width, -1).T for c in column if c.is_valid]
    if not cells:
        return np.zeros(0, dtype)
    return np.ascontiguousarray(np.concatenate(cells)).view(dtype).ravel()


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of one shard at a time, from batches sorted by shard."""
    held, number = [], None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else []
        for start, end in zip(cuts, cuts[1:]):
            if held and shard[start] != number:
                yield number, pa.Table.from_batches(held)
                held = []
            number = int(shard[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield number, pa.Table.from_batches(held)


def _write(folder: str, name: str, arrays: list[np.ndarray]) -> list[tuple[str, int]]:
    """One file with the arrays one after the other; (type, length) of each."""
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(temporary, "wb") as file:
        for array in arrays:
            file.write(np.ascontiguousarray(array).data)
            file.write(bytes(-file.tell() % 8))
    os.replace(temporary, f"{folder}/{name}")
    return [(a.dtype.str, len(a)) for a in arrays]


@lru_cache(maxsize=4096)
def _mapped(path: str, types: str) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory. One per worker process and file."""
    arrays, at = [], 0
    data = np.memmap(path, np.uint8, "r")
    for part in types.split(","):
        kind, n = part.split(":")
        size = np.dtype(kind).itemsize * int(n)
        arrays.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return arrays


@dataclass(frozen=True)
class Sorted:
    """Sorted hash arrays in files, by shard: hash to values, zeros for what is absent."""

    folder: str
    name: str
    shards: int
    types: dict[int, str]  # per shard, of its arrays
    width: int

    def look_up(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Values of hashes given in ascending order."""
        found = [np.zeros(len(hashes), np.int64) for _ in range(self.width)]
        shard = _shard(hashes, self.shards)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(shard) else []
        for start, end in zip(cuts, cuts[1:]):
            types = self.types.get(int(shard[start]))
            if types is None:
                continue
            keys, *columns = _mapped(f"{self.folder}/{self.name}-{int(shard[start])}", types)
            wanted = hashes[start:end]
            at = np.searchsorted(keys, wanted)
            at[at == len(keys)] = 0
            hit = keys[at] == wanted
            places = start + np.flatnonzero(hit)
            for values, column in zip(found, columns):
                values[places] = column[at[hit]]
        return found


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from how many n-grams have count 1, 2, 3, 4; 0.5, 1 and 1.5 where these say nothing."""
    n1, n2, n3, n4 = counts
    if min(n1, n2, n3) == 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    fit = all(0 < d < k for d, k in zip(found, (1, 2, 3)))
    return found if fit else (0.5, 1.0, 1.5)


@dataclass(frozen=True)
class Model:
    pairs: Sorted
    words: Sorted
    n_tokens: int  # N
    n_distinct: int  # V
    n_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    rest: float  # what the words leave for all tokens alike

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Per text: n_tokens, n_known, base_score and score (log10)."""
        hashes, codes, bounds = _pairs(texts)
        mixed = _word_key(hashes)
        order = np.argsort(mixed)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        count, before, total, ones, twos, more = (v[back].astype(np.float64) for v in self.words.look_up(mixed[order]))
        vocabulary = self.n_distinct + 1
        distinct = max(self.n_pairs, 1)
        d = (0.0, *self.word_discounts)
        alone = np.maximum(before - np.choose(np.minimum(before, 3).astype(int), d), 0) / distinct + self.rest / vocabulary
        base = np.log10((count + 0.1) / (self.n_tokens + 0.1 * vocabulary))
        d = (0.0, *self.pair_discounts)
        left = np.where(total > 0, (d[1] * ones + d[2] * twos + d[3] * more) / np.maximum(total, 1), 1.0)
        distinct_codes, place = np.unique(codes, return_inverse=True)
        h, w = distinct_codes >> 32, distinct_codes & 0xFFFFFFFF
        keys = pair_hash(hashes[h], hashes[w])
        order = np.argsort(keys)
        c = np.empty(len(keys))
        c[order] = self.pairs.look_up(keys[order])[0]
        own = np.maximum(c - np.choose(np.minimum(c, 3).astype(int), d), 0) / np.maximum(total[h], 1)
        logs = np.log10(own + left[h] * alone[w])
        token = codes & 0xFFFFFFFF
        starts = bounds[:-1]
        if not len(starts):
            return {"n_tokens": np.diff(bounds), "n_known": np.diff(bounds), "base_score": np.zeros(0), "score": np.zeros(0)}
        return {
            "n_tokens": np.diff(bounds),
            "n_known": np.add.reduceat((count > 0).astype(np.int64)[token], starts),
            "base_score": np.add.reduceat(base[token], starts),
            "score": np.add.reduceat(logs[place], starts),
        }


def _local(path: str) -> str:
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"spark.checkpoint.dir must be a mounted folder to be mapped into memory, not {path}")
    return unquote(parsed.path)


def _files(rows: list, name: str, shards: int, width: int, folder: str) -> tuple[Sorted, list[int]]:
    """The arrays that the rows tell of, and the sums of their ``told`` numbers."""
    types, told = {}, None
    for row in rows:
        if row["name"] == name:
            types[row.shard] = row.types
            told = list(row.told) if told is None else [a + b for a, b in zip(told, row.told)]
    return Sorted(folder, name, shards, types, width), told


def _collected(rows: DataFrame) -> list:
    """The rows, with small batches on the way; the session's own setting is put back."""
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(name, None)
    conf.set(name, BATCH_BYTES)
    try:
        return rows.collect()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def train(texts: DataFrame, text: str = "text", slice_bytes: int = SLICE_BYTES, shard_bytes: int = SHARD_BYTES) -> Model:
    """The model of all texts of a column; a null text is empty, repeated rows count each.

    The driver holds one line per shard and a few sums. Without rows every token has
    probability 1, as the one unknown token.
    """
    folder = _local(scratch_dir(texts.sparkSession))
    os.makedirs(folder, exist_ok=True)
    bodies = texts.select(F.col(f"`{text}`").alias("body"))
    size = bodies.agg(F.sum(F.octet_length("body").cast("bigint"))).first()[0] or 0
    shards = max(16, int(size) // shard_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "body", slice_bytes):
                hashes, codes, _ = _pairs(rows.column("body"))
                codes.sort()
                first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
                n = np.diff(np.append(first, len(codes))).astype(np.uint32)
                codes = codes[first]
                before, token = hashes[codes >> 32], hashes[codes & 0xFFFFFFFF]
                shard = _shard(pair_hash(before, token), shards)
                # Contexts as runs: sorted by shard (a stable sort keeps the order by context).
                order = np.argsort(shard.astype(np.uint16) if shards < 65536 else shard, kind="stable")
                shard, before, token, n = shard[order], before[order], token[order], n[order]
                run = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (shard[1:] != shard[:-1])]))
                length = np.diff(np.append(run, len(before))).astype(np.uint32)
                contexts = _packed_rows(shard[run], {"before": before[run], "run": length})
                found = _packed_rows(shard, {"token": token, "n": n})
                del hashes, codes, shard, before, token, n, order
                yield pa.RecordBatch.from_arrays([*contexts.columns, *found.columns[1:]], ["shard", "before", "run", "token", "n"])
                pa.default_memory_pool().release_unused()

    def add_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            before = np.repeat(_unpacked(rows["before"].combine_chunks(), "<u8"), _unpacked(rows["run"].combine_chunks(), "<u4"))
            token, n = _unpacked(rows["token"].combine_chunks(), "<u8"), _unpacked(rows["n"].combine_chunks(), "<u4")
            del rows
            keys = pair_hash(before, token)
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            c = np.add.reduceat(n[order].astype(np.int64), first)
            keys, before, token = keys[first], before[order[first]], token[order[first]]
            types = _write(folder, f"pairs-{shard}", [keys, _narrow(c)])
            told = [len(keys), *(int((c == k).sum()) for k in (1, 2, 3, 4))]
            zero = np.zeros(len(c), np.int64)
            right, (count_, before_) = _sums(token, [c, zero + 1])
            left, sums = _sums(before, [c, c == 1, c == 2, c >= 3])
            known, back = np.unique(np.concatenate([right, left]), return_inverse=True)
            fields = [np.zeros(len(known), np.uint32 if int(c.sum()) < 1 << 32 else np.uint64) for _ in _WORD_FIELDS]
            for field, values in zip(fields[:2], (count_, before_)):
                field[back[: len(right)]] = values
            for field, values in zip(fields[2:], sums):
                field[back[len(right) :]] = values
            wide = {name: f.astype(np.uint64) for name, f in zip(_WORD_FIELDS, fields)}
            out = _packed_rows(_shard(_word_key(known), word_shards), {"word": known, **wide})
            n_out = out.num_rows
            line = ",".join(f"{k}:{m}" for k, m in types)
            lists = [pa.array([line] + [None] * n_out, pa.string()), pa.array([told] + [None] * n_out, pa.list_(pa.int64()))]
            head = [pa.array([shard], pa.int64()), *(pa.nulls(1, pa.binary()) for _ in out.columns[1:])]
            body = [pa.concat_arrays([h, o]) for h, o in zip(head, out.columns)]
            yield pa.RecordBatch.from_arrays([*body, *lists], [*out.schema.names, "types", "told"])

    def add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            pairs = rows.filter(pc.is_valid(rows["types"])).select(["shard", "types", "told"])
            names = pa.array(["pairs"] * len(pairs), pa.string())
            yield from pairs.append_column("name", names).combine_chunks().to_batches()
            if len(pairs) == len(rows):
                continue
            keys = _word_key(_unpacked(rows["word"].combine_chunks(), "<u8"))
            keys, sums = _sums(keys, [_unpacked(rows[f].combine_chunks(), "<u8") for f in _WORD_FIELDS])
            types = _write(folder, f"words-{shard}", [keys, *map(_narrow, sums)])
            n, before = sums[0], sums[1]
            told = [int(n.sum()), int((n > 0).sum()), *(int((before == k).sum()) for k in (1, 2, 3, 4)), int((before >= 3).sum())]
            line = ",".join(f"{k}:{m}" for k, m in types)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "types": [line], "told": pa.array([told], pa.list_(pa.int64())), "name": ["words"]})

    word_shards = max(16, shards // 2)
    told_schema = "types string, told array<bigint>"
    pieces = bodies.mapInArrow(count, "shard bigint, before binary, run binary, token binary, n binary")
    sorted_ = pieces.repartition(shards, "shard").sortWithinPartitions("shard")
    fields = ", ".join(f"{f} binary" for f in ["word", *_WORD_FIELDS])
    parts = sorted_.mapInArrow(add_pairs, f"shard bigint, {fields}, {told_schema}")
    parts = parts.repartition(word_shards, "shard").sortWithinPartitions("shard")
    # One small row per file: all that the driver needs to know.
    rows = _collected(parts.mapInArrow(add_words, f"shard bigint, {told_schema}, name string"))
    pairs, told = _files(rows, "pairs", shards, 1, folder)
    n_pairs, *pair_counts = told or [0] * 5
    words, told = _files(rows, "words", word_shards, len(_WORD_FIELDS), folder)
    n_tokens, n_distinct, m1, m2, m3, m4, m_more = told or [0] * 7
    d = discounts([m1, m2, m3, m4])
    rest = (d[0] * m1 + d[1] * m2 + d[2] * m_more) / n_pairs if n_pairs else 1.0
    return Model(pairs, words, n_tokens, n_distinct, n_pairs, discounts(pair_counts), d, rest)


def scored(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", slice_bytes: int = SCORE_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of each row, null texts as empty ones; no shuffle."""
    kind = documents.schema[doc_id].dataType.simpleString()
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "_text", slice_bytes):
                found = held.value.score(rows.column("_text"))
                yield pa.RecordBatch.from_pydict({"doc_id": rows.column("_id")} | {k: pa.array(v) for k, v in found.items()})
                pa.default_memory_pool().release_unused()

    rows = documents.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out(doc_id: str, folds: int = FOLDS):
    """Whether a row is kept out of training: by the checksum of its id as text, the empty text for null."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % folds == 0


def cross_scored(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, **options) -> DataFrame:
    """All rows scored by a model of those not held out.

    doc_id, held_out, n_tokens (with the end), n_known, train_tokens, base_score (unigrams,
    0.1 added), score: log10 of the probability of the whole text; perplexity is
    ``10 ** (-score / n_tokens)``. Null texts are empty and have one token, the end; rows
    without an id are held out; repeated rows train and are scored one by one. Columns of
    other names play no part.
    """
    model = train(documents.where(~held_out(doc_id, folds)), text, **options)
    found = scored(documents, model, doc_id, text)
    return found.select(
        "doc_id",
        held_out("doc_id", folds).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return cross_scored(read_table(spark, sf_dir, "documents"))
