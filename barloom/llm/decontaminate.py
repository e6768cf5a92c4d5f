"""Benchmark decontamination by winnowing, with column expressions only.

A passage that a document shares with a benchmark item matters from ``SPAN`` words
on. Of the ``K``-gram hashes inside each span the smallest is the fingerprint. Equal
spans have equal fingerprints, so a join on fingerprints finds every shared span;
the spans behind a hit are then compared as text, which leaves no false ones.

1. Benchmark: the spans of each item, their texts and fingerprints.
2. Documents: the fingerprint of each span, matched against the benchmark's.
   What remains is a list of span positions per document that has any.
3. Those documents are read once more, the spans at these positions are cut out and
   joined with the benchmark's spans by text.
4. Overlapping spans are merged, so each word counts once.

An item shorter than ``SPAN`` words is one span of its own length; for each such
length (nine at most) the fingerprint is the hash of the whole span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, broadcast_if_small, keyed, lower_ascii, packed, sha256_hex, sliding, stored, temporary, unpacked, with_once, words_of

SPAN = 10
K = 5
HITS = "array<struct<start:int,end:int>>"


def span_fingerprints(df: DataFrame, lengths: list[int], span: int = SPAN, k: int = K) -> DataFrame:
    """One row per span: the other columns of ``df``, ``length``, ``start``, ``fingerprint``.

    ``df`` has an array column ``words``. A row without a span of some length has one
    row for it with ``start`` null. All work on words stays inside their row.
    """
    keep = [c for c in df.columns if c != "words"]
    hashed = with_once(df, _grams=F.transform("words", lambda w: F.xxhash64(w)))
    found = None
    for length in lengths:
        gram = k if length == span else length
        part = hashed.select(*keep, F.greatest(F.size("words") - (length - 1), F.lit(0)).alias("_spans"), "_grams")
        part = sliding(part, "_grams", gram, lambda a, b: F.xxhash64(a, b))
        part = sliding(part, "_grams", length - gram + 1, lambda a, b: F.least(a, b))
        part = part.select(*keep, F.lit(length).alias("length"), F.posexplode_outer(F.slice("_grams", 1, F.col("_spans"))))
        found = part if found is None else found.union(part)
    return found.withColumnsRenamed({"pos": "start", "col": "fingerprint"})


def _spans(words: str, starts: Column, length: Column) -> Column:
    """Texts of the spans that begin at ``starts`` (from 0)."""
    return F.transform(
        starts,
        lambda s: F.struct(s.alias("start"), F.array_join(F.slice(words, s + 1, length), " ").alias("span")),
    )


def benchmark_spans(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", span: int = SPAN, k: int = K
) -> tuple[DataFrame, DataFrame, list[int]]:
    """(item, length, span) rows, distinct fingerprints, and the span lengths that occur."""
    items = with_once(
        benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("body")),
        words=words_of(lower_ascii(F.col("body"))),
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(span))
    items = items.select("item", "words", length.alias("length"))
    # At most one value for each length up to ``span``.
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    spans = stored(
        items.select("item", "length", F.inline(_spans("words", starts, F.col("length"))))
        .select("item", "length", "span")
        .distinct()
    )
    each = spans.select("length", "span").distinct().select("length", F.split("span", " ").alias("words"))
    found = None
    for n in lengths:
        part = span_fingerprints(each.where(F.col("length") == n).select("words"), [n], span, k).select("fingerprint")
        found = part if found is None else found.union(part)
    return spans, None if found is None else stored(found.distinct()), lengths


def _contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    k: int = K,
) -> DataFrame:
    """Per distinct row: doc_id, key, n_words, copies, and for hits n_hit, hits and items."""
    spans, prints, lengths = benchmark_spans(benchmark, item_id, item_text, span, k)
    if not lengths:  # an empty benchmark: fingerprints of the usual length, none of them known
        lengths = [span]
        prints = documents.sparkSession.createDataFrame([], "fingerprint bigint")
    docs = keyed(documents, doc_id, text)

    def with_words(df: DataFrame) -> DataFrame:
        return with_once(df, words=words_of(lower_ascii(F.col("body"))))

    # Positions of spans whose fingerprint the benchmark has; bounded by the document's own length.
    # The first span of each row stays as well, to count rows and carry the number of words.
    prints = broadcast_if_small(prints, prints.count()).withColumn("known", F.lit(True))
    first = (F.coalesce("start", F.lit(0)) == 0) & (F.col("length") == lengths[-1])
    base = with_words(docs).select("doc_id", *KEY, F.size("words").cast("bigint").alias("n_words"), "words")
    candidates = stored(
        span_fingerprints(base, lengths, span, k)
        .join(prints, "fingerprint", "left")
        .where(first | F.col("known"))
        .groupBy("doc_id", *KEY, "n_words", "length")
        .agg(F.sort_array(F.collect_set(F.when(F.col("known"), F.col("start")))).alias("starts"), F.count_if(first).alias("copies"))
    )
    hits = candidates.where(F.size("starts") > 0).select(*KEY, "length", "starts")
    places = with_words(docs.join(broadcast_if_small(hits, hits.count()), KEY)).select(
        *KEY, "length", F.inline(_spans("words", F.col("starts"), F.col("length")))
    )
    known = spans.select("length", "span").distinct()
    found = stored(
        places.join(broadcast_if_small(known, known.count()), ["length", "span"])
        .groupBy(*KEY, "length", "span")
        .agg(F.collect_set("start").alias("starts"))
    )
    stretches = (
        found.select(*KEY, F.explode("starts").alias("start"), "length")
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("hits"))
        .select(*KEY, _merged(F.col("hits")).alias("hits"))
    )
    items = (
        found.select(*KEY, "length", "span")
        .join(broadcast_if_small(spans, spans.count()), ["length", "span"])
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])
    found = stretches.join(items, KEY).select(*KEY, n_hit.alias("n_hit"), "hits", "items")
    return candidates.where(F.col("copies") > 0).join(found, KEY, "left")


def _merged(sorted_hits: Column) -> Column:
    """Overlapping or touching (start, end) pairs joined; the input is sorted."""
    kind = HITS

    def step(done: Column, hit: Column) -> Column:
        last = F.element_at(done, -1)
        touching = (F.size(done) > 0) & (hit["start"] <= F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(-1)))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], hit["end"]).alias("end"))
        return F.when(
            touching, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)).cast(kind)
        ).otherwise(F.concat(done, F.array(hit)).cast(kind))

    return F.aggregate(sorted_hits, F.array().cast(kind), step)


def mark_contaminated(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_words, n_hit, n_items, items, hits, contaminated.

    ``hits`` are the merged stretches (start, end) in words, ``items`` the ids of the
    items found there, sorted as strings. Null and empty texts have no words and so no
    hit; without a benchmark nothing hits. An item with a null id hits but has no id to
    report. Repeated rows keep one result each. Columns of other names play no part.
    """
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    found = _contamination(documents, benchmark, doc_id, text, **names)
    return found.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        items.alias("items"),
        F.coalesce("hits", F.array().cast(HITS)).alias("hits"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``documents`` without those that share a span with the benchmark; same columns."""
    with temporary(documents.sparkSession) as keep:
        found = keep(stored(_contamination(documents, benchmark, doc_id, text, **names).where("n_hit > 0").select(*KEY)))
    left = packed(documents, doc_id, text).join(broadcast_if_small(found, found.count()), KEY, "left_anti")
    return left.select(*unpacked(documents.columns))


def query(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = mark_contaminated(documents, benchmark)
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        sha256_hex(F.concat_ws(",", "items")).alias("items_sha256"),
        "contaminated",
    )
