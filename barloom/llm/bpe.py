"""BPE encoding and decoding of whole texts, exact and in linear time.

Encoding a word: an Aho-Corasick automaton over the vocabulary gives the longest
token at each place. Tokens are taken from the left, longest first; two neighbours
may stand side by side only if the merges would have left that border alone, which a
pair table answers (filled as pairs occur). If none fits, the last token is taken
back and a shorter one tried; a place that was given up is never tried again, so the
work is linear. The tokenisation whose borders all hold is the one the merges give.

Decoding: an Arrow string array of the vocabulary is the offset table; ids are
gathered from it and joined.

Per task a text is split at white space into chunks, the different chunks of a slice of
documents into words by Arrow, where their letters are plain; equal words are encoded
once, and the ids are laid out with numpy. Memory is bounded by
``SLICE_BYTES`` (or the longest single text) and the size of the caches.

The vocabulary file is JSON of the tokenizers library: NFC and lower case, a split
pattern, byte-level letters, a word-end suffix, no continuing prefix. Its path must
exist on each executor.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

SLICE_BYTES = 4_000_000
CACHE_ENTRIES = 150_000
_END = "\ue000"  # stands for the word-end suffix, so that each symbol is one letter
_NEVER = 1 << 60

# Printable ASCII and Latin letters whose NFC form and lower case are one letter each.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]*")
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Backtracking:
    """Words (byte-level letters, without suffix) to ids."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        def plain(token: str) -> str:
            return token[: -len(suffix)] + _END if token.endswith(suffix) else token

        self.ids = {plain(t): i for t, i in vocab.items()}
        self.rank, self.parts = {}, {}
        for n, merge in enumerate(merges):
            left, right = map(plain, merge.split(" ") if isinstance(merge, str) else merge)
            self.rank[left, right] = n
            self.parts.setdefault(left + right, (left, right, n))
        self.automaton = ahocorasick.Automaton()
        known = {t for t in self.ids if t in self.parts or len(t.removesuffix(_END)) == 1}
        for token in known:
            self.automaton.add_word(token, len(token))
        self.automaton.make_automaton()
        self.shorter = {}  # the longest token that a token begins with, besides itself
        for token in known:
            cut = len(token) - 1
            while cut and token[:cut] not in known:
                cut -= 1
            self.shorter[token] = token[:cut]
        self.spines: dict[tuple[str, int], list[tuple[str, int]]] = {}  # two per token at most
        self.fits: dict[tuple[str, str], bool] = {}

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The symbols at one edge of a token as its merges build it, each with the rank that absorbs it."""
        known = self.spines.get((token, side))
        if known is not None:
            return known
        whole, found, above = token, [], _NEVER
        while token in self.parts:
            found.append((token, above))
            left, right, above = self.parts[token]
            token = (left, right)[side]
        found.append((token, above))
        self.spines[whole, side] = found[::-1]
        return self.spines[whole, side]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges keep these two tokens apart: no pair at the border ever wins."""
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        apart = True
        while apart:
            (x, x_until), (y, y_until) = a[i], b[j]
            n = self.rank.get((x, y), _NEVER)
            # At equal rank the leftmost pair goes first: the border loses to the left, wins to the right.
            apart = n == _NEVER or n >= x_until or n > y_until
            if x_until == y_until == _NEVER:
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        if len(self.fits) > CACHE_ENTRIES:
            self.fits.clear()
        self.fits[left, right] = apart
        return apart

    def encode(self, word: str) -> list[int]:
        word += _END
        whole = self.ids.get(word)
        end = len(word)
        longest = [0] * end
        for last, size in self.automaton.iter(word):
            start = last - size + 1
            if size > longest[start]:
                longest[start] = size
        if whole is not None and longest[0] == end:
            return [whole]
        open_, taken, at = [True] * (end + 1), [], 0
        token = word[: longest[0]]
        while True:
            while token and not (open_[at + len(token)] and (not taken or self.compatible(taken[-1], token))):
                token = self.shorter[token]
            if token:
                taken.append(token)
                at += len(token)
                if at == end:
                    return [self.ids[t] for t in taken]
                token = word[at : at + longest[at]]
            else:
                open_[at] = False
                if not taken:
                    raise ValueError(f"the vocabulary lacks a letter of {word!r}")
                token = taken.pop()
                at -= len(token)
                token = self.shorter[token]


class Vocabulary:
    """Chunks of text without white space to ids, as the vocabulary file says."""

    def __init__(self, path: str, method: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = spec["model"]
        vocab = dict(model["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (max(vocab.values()) + 1)
        for token, n in vocab.items():
            tokens[n] = token
        self.table = pa.array(tokens, pa.large_string())
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = str.maketrans({chr(c): "".join(_byte_letters()[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)})
        if method == "backtracking":
            self.encode_word = Backtracking(model["vocab"], model["merges"], model["end_of_word_suffix"]).encode
        else:
            tokenize = self.tokenizer.model.tokenize
            self.encode_word = lambda word: [t.id for t in tokenize(word)]
        # Words met since the last turn of the cache, and those of the turn before.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > CACHE_ENTRIES:
                self.words, self.older = {}, self.words
            ids = self.older.get(word)
            if ids is None:
                ids = np.array(self.encode_word(word), "<u4").tobytes()
            self.words[word] = ids
        return ids

    def _ordinary(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            words = _PLAIN_WORDS.findall(text.lower())
            if not text.isascii():
                words = [w.translate(self.letters) for w in words]
        else:
            text = self.tokenizer.normalizer.normalize_str(text)
            words = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return b"".join(map(self._word, words))

    def chunk(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        ids = self.chunks.get(text)
        if ids is None:
            if "<" in text and self.special.search(text):
                ids, at = b"", 0
                for m in self.special.finditer(text):
                    ids += self._ordinary(text[at : m.start()]) + np.uint32(self.special_ids[m[0]]).astype("<u4").tobytes()
                    at = m.end()
                ids += self._ordinary(text[at:])
            else:
                ids = self._ordinary(text)
            if len(self.chunks) > CACHE_ENTRIES:
                self.chunks.clear()
            if len(text) < 64:
                self.chunks[text] = ids
        return ids

    def _plain_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in a row, number of ids of each); for chunks of ``_PLAIN`` letters without special tokens."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(chunks), f"({_PLAIN_WORDS.pattern})", r"\1 ")
        parts = pc.ascii_split_whitespace(pc.ascii_rtrim(spaced, " "))
        coded = pc.list_flatten(parts).dictionary_encode()
        words = (w if w.isascii() else w.translate(self.letters) for w in coded.dictionary.to_pylist())
        flat, ends = _laid_out([self._word(w) if w else b"" for w in words], coded.indices)
        return flat, np.diff(np.concatenate([[0], ends])[parts.offsets.to_numpy() - parts.offsets[0].as_py()])

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each chunk start, how many it has)."""
        plain = pc.match_substring_regex(chunks, f"^{_PLAIN.pattern}$")
        plain = pc.and_not(plain, pc.match_substring_regex(chunks, self.special.pattern)) if self.special_ids else plain
        found = list(map(self.chunk, chunks.filter(pc.invert(plain)).to_pylist()))
        flat, sizes_of_plain = self._plain_chunks(chunks.filter(plain))
        plain = plain.to_numpy(zero_copy_only=False)
        sizes = np.empty(len(chunks), np.int64)
        sizes[plain] = sizes_of_plain
        sizes[~plain] = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.empty(len(chunks), np.int64)
        starts[plain] = np.cumsum(sizes_of_plain) - sizes_of_plain
        starts[~plain] = len(flat) + np.cumsum(sizes[~plain]) - sizes[~plain]
        return np.concatenate([flat, np.frombuffer(b"".join(found), "<u4")]), starts, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text and the end); null is empty."""
        parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = pc.list_flatten(parts).dictionary_encode()
        flat, ends = _gathered(*self._chunks(coded.dictionary), coded.indices)
        bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return flat, np.concatenate([[0], ends])[bounds]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Tokens of each text joined by blanks, as the library does without a decoder."""
        tokens = self.table.take(pa.array(ids))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), tokens), pa.scalar(" ", pa.large_string()))


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, indices: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the items numbered in ``indices``, in their order; where those of each end)."""
    codes = indices.to_numpy(zero_copy_only=False)
    each = sizes[codes]
    ends = np.cumsum(each)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - each), each)
    return flat[places], ends


def _laid_out(found: list[bytes], indices: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    return _gathered(np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes, sizes, indices)


def _byte_letters() -> list[str]:
    """The printable letter of each byte: itself, or the next free one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


@lru_cache(maxsize=4)
def vocabulary(path: str, method: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path, method)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows with about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(run, prepend=-1, append=-1)) if len(run) else []
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def encoded(
    df: DataFrame,
    per_slice: Callable[[Vocabulary, pa.RecordBatch, np.ndarray, np.ndarray], dict],
    schema: str,
    text: str = "text",
    path: str = WORD_BPE,
    method: str = "backtracking",
) -> DataFrame:
    """Apply ``per_slice(vocabulary, rows, ids, offsets)`` to slices of ``df``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, method)
        for batch in batches:
            for rows in slices(batch, text):
                ids, offsets = words.encode(rows.column(text))
                yield pa.RecordBatch.from_pydict(per_slice(words, rows, ids, offsets))

    return df.mapInArrow(run, schema)


def encode(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = WORD_BPE) -> DataFrame:
    """doc_id, ``ids`` (array of int): one row per row, empty for null and empty texts."""

    def ids_of(words, rows, ids, offsets):
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
        return {"doc_id": rows.column(0), "ids": lists}

    kind = documents.schema[doc_id].dataType.simpleString()
    return encoded(_two(documents, doc_id, text), ids_of, f"doc_id {kind}, ids array<int>", "_text", path)


def decode(encoded_docs: DataFrame, ids: str = "ids", path: str = WORD_BPE) -> DataFrame:
    """Replace an ``ids`` column by ``decoded``; null ids give null."""
    rest = [c for c in encoded_docs.columns if c != ids]
    schema = ", ".join(f"`{c}` {encoded_docs.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches):
        words = vocabulary(path, "backtracking")
        for batch in batches:
            lists = batch.column(ids)
            offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
            texts = words.decode(pc.list_flatten(lists).to_numpy(zero_copy_only=False), offsets).cast(pa.string())
            texts = pc.if_else(pc.is_valid(lists), texts, None)
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in rest}, "decoded": texts})

    return encoded_docs.mapInArrow(run, f"{schema}{', ' if rest else ''}decoded string")


def _two(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = WORD_BPE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: a round trip of whole texts."""

    def per_slice(words, rows, ids, offsets):
        raw = memoryview(ids).cast("B") if len(ids) else memoryview(b"")
        decoded = words.decode(ids, offsets)
        at = np.frombuffer(decoded.buffers()[1], np.int64)[decoded.offset :]
        data = memoryview(decoded.buffers()[2] or b"")
        n = len(offsets) - 1
        return {
            "doc_id": rows.column(0),
            "n_tokens": pa.array(np.diff(offsets)),
            "ids_sha256": [hashlib.sha256(raw[4 * offsets[i] : 4 * offsets[i + 1]]).hexdigest() for i in range(n)],
            "decoded_sha256": [hashlib.sha256(data[at[i] : at[i + 1]]).hexdigest() for i in range(n)],
        }

    kind = documents.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return encoded(_two(documents, doc_id, text), per_slice, schema, "_text", path)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
