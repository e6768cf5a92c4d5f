"""Quality rules: clean lines first, then reject documents that lost too much.

Each line is judged by itself: runs of marks (``!!``, ``###``), navigation (many
separators among few words), stock phrases of web pages, one word over and over.
Lines that fail are removed. A document is rejected if it has few words, if much of it
repeats, or if the failed lines held too large a share of its words' letters.

Rows are worked on in slices of whole texts by Arrow and numpy inside the tasks; there
is no shuffle, so no key can be hot. Memory follows the slice or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .bpe import slices

# Text worked on at once; its words take some thirty times as much in arrays.
QUALITY_BYTES = 1_000_000
WINDOW = 8
_SYMBOLS = r"[#*$%&|<>]"
_MARKS = r"[!?#*$%&<>~=^]{2,}"
_SEPARATORS = "[|»›•·]"
_STOCK = (
    r"(?i)\b(cookie (policy|settings)|accept (all )?cookies|enable javascript|javascript is (disabled|required)"
    r"|all rights reserved|privacy policy|terms (of use|of service|and conditions)|lorem ipsum"
    r"|sign (in|up) (to|for)|click here|read more|skip to (main )?content|share (this|on))\b"
)


@dataclass(frozen=True)
class Rules:
    """Shares are of the words of the line or document; percentages are compared exactly."""

    min_words: int = 20
    max_repeat_percent: int = 30
    marks_percent: int = 20  # words with a run of marks, from which a line fails
    min_separators: int = 3
    separators_percent: int = 15
    stock_words: int = 20  # a line with a stock phrase fails if it has no more words
    stutter_percent: int = 50  # words equal to the one before, in lines of four and more
    max_lost_percent: int = 30


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the runs between neighbouring bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _repeated(codes: np.ndarray, starts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each word whether it lies in a window of its text that occurs there twice or more.

    ``starts`` are the bounds of the texts in ``codes``. Equal windows are found by
    hash and compared; windows that share a hash but differ are told apart exactly.
    """
    n = len(codes)
    covered = np.zeros(n + 1, np.int64)
    if n < width:
        return covered[:n] > 0
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.flatnonzero(text_of[: n - width + 1] == text_of[width - 1 :])
    if not len(at):
        return covered[:n] > 0
    odd = np.random.default_rng(7).integers(1 << 62, size=width + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = codes.astype(np.uint64) * odd[width]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * odd[width + 1]
    hashes = text_of[at].astype(np.uint64) * odd[width]
    for j in range(width):
        hashes += mixed[at + j] * odd[j]
    order = np.argsort(hashes, kind="stable")
    hashes, at = hashes[order], at[order]
    twin = np.flatnonzero(hashes[1:] == hashes[:-1])
    a, b = at[twin], at[twin + 1]
    same = text_of[a] == text_of[b]
    for j in range(width):
        same &= codes[a + j] == codes[b + j]
    found = np.zeros(len(at), bool)
    found[twin[same]] = found[twin[same] + 1] = True
    if not same.all():
        for value in np.unique(hashes[twin[~same]]):
            places = np.flatnonzero(hashes == value)
            seen: dict = {}
            for p in places:
                seen.setdefault((text_of[at[p]], *codes[at[p] : at[p] + width]), []).append(p)
            for group in seen.values():
                found[group] = len(group) > 1
    np.add.at(covered, at[found], 1)
    np.subtract.at(covered, at[found] + width, 1)
    return np.cumsum(covered)[:n] > 0


def _per_text(texts: pa.Array, rules: Rules, with_text: bool) -> dict[str, pa.Array | np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    by_text = pc.split_pattern(texts, "\n")
    lines = pc.list_flatten(by_text)
    line_bounds = by_text.offsets.to_numpy() - by_text.offsets[0].as_py()
    by_line = pc.ascii_split_whitespace(lines)
    words = pc.list_flatten(by_line)
    bounds = by_line.offsets.to_numpy() - (by_line.offsets[0].as_py() if len(by_line) else 0)
    letters = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    real = letters > 0  # a line that begins or ends with white space has empty pieces
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
    words, letters = words.filter(pa.array(real)), letters[real]
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    n_line_words, line_letters = np.diff(bounds), _sums(letters, bounds)
    text_bounds = bounds[line_bounds]

    def count(values: pa.Array, pattern: str) -> np.ndarray:
        return pc.count_substring_regex(values, pattern).to_numpy(zero_copy_only=False)

    line_codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = n_line_words > 0
    line_of = np.repeat(np.arange(n), np.diff(line_bounds))
    pairs = np.unique(np.stack([line_of[filled], line_codes[filled]]), axis=1) if filled.any() else np.zeros((2, 0), np.int64)
    n_dup_lines = _sums(filled, line_bounds) - np.bincount(pairs[0], minlength=n)

    same = np.zeros(len(codes), bool)
    same[1:] = codes[1:] == codes[:-1]
    firsts = bounds[:-1][filled]
    same[firsts] = False
    stutter = _sums(same, bounds)
    separators = count(lines, _SEPARATORS)
    stock = pc.match_substring_regex(lines, _STOCK).to_numpy(zero_copy_only=False)
    failed = filled & (
        (100 * count(lines, _MARKS) >= rules.marks_percent * n_line_words)
        | ((separators >= rules.min_separators) & (100 * separators >= rules.separators_percent * n_line_words))
        | (stock & (n_line_words <= rules.stock_words))
        | ((n_line_words >= 4) & (100 * stutter >= rules.stutter_percent * n_line_words))
    )
    n_words, word_chars = np.diff(text_bounds), _sums(line_letters, line_bounds)
    n_repeat = _sums(_repeated(codes, text_bounds), text_bounds)
    base_failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    lost = _sums(np.where(failed, line_letters, 0), line_bounds)
    found = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": count(texts, _SYMBOLS),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "n_failed_lines": _sums(failed, line_bounds),
        "lost_chars": lost,
        "base_failed": base_failed,
        "kept": ~base_failed & (100 * lost <= rules.max_lost_percent * word_chars),
    }
    found = {k: pa.array(v.astype(bool if v.dtype == bool else np.int64)) for k, v in found.items()}
    if with_text:
        left = lines.filter(pa.array(~failed))
        ends = np.concatenate([[0], np.cumsum(~failed)])[line_bounds]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), left), pa.scalar("\n", pa.large_string()))
        found["cleaned"] = joined.cast(pa.string())
    return found


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "lost_chars"]
_SCHEMA = ", ".join(f"{c} bigint" for c in _COUNTS) + ", base_failed boolean, kept boolean"


def assess(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row: doc_id, counts, ``base_failed``, ``kept`` and the ``cleaned`` text.

    Null and empty texts have no words and fail; repeated rows are judged alike. Lines
    without a word never fail. Columns of other names play no part.
    """
    return _assessed(documents.select(f"`{doc_id}`", f"`{text}`"), doc_id, text, rules, True)


def _assessed(rows: DataFrame, doc_id: str, text: str, rules: Rules, with_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, QUALITY_BYTES):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(doc_id), **_per_text(part.column(text), rules, with_text)})

    kind = rows.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_SCHEMA}" + ", cleaned string" * with_text)


def clean(documents: DataFrame, text: str = "text", n_chars: str | None = "n_chars", rules: Rules = Rules()) -> DataFrame:
    """``documents`` that are kept, with failed lines removed; same columns.

    ``n_chars`` (if there is such a column) is counted anew where lines were removed.
    """
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text, QUALITY_BYTES):
                found = _per_text(rows.column(text), rules, True)
                changed = pc.greater(found["n_failed_lines"], 0)
                columns = dict(zip(schema.names, rows.columns))
                columns[text] = pc.if_else(changed, found["cleaned"], columns[text].cast(pa.string()))
                if n_chars in columns:
                    size = pc.utf8_length(found["cleaned"]).cast(columns[n_chars].type)
                    columns[n_chars] = pc.if_else(changed, size, columns[n_chars])
                yield pa.RecordBatch.from_pydict(columns).filter(found["kept"])

    return documents.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _assessed(rows, "doc_id", "text", Rules(), False).drop("n_failed_lines", "lost_chars")
