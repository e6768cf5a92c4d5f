"""N-gram Jaccard join: all pairs of documents whose shingle sets are alike, as components.

1. Each text becomes its set of word shingles, as sorted hashes, and a hashed bitmap of it. Equal
   sets are one class from here on, so copies cost nothing further.
2. Rare shingles first, a set has so many that two alike sets share one of the first
   quarter (prefix filter). Any order does; rarity is read from a table of counts over
   all documents by hash bucket, whose size is fixed. Classes that share such a shingle
   are a group; shingles shared by the same classes make one group only.
3. A group is a tile; a large one is cut into size bands, and large bands into slices, and two
   parts whose sizes allow a link make a tile, so a tile has a bounded number of rows.
4. In a tile bitmaps are compared first: bits in which two differ bound the overlap from above.
   Each class proposes the best partner the bitmaps leave it. These pairs are decided by
   intersecting the sorted hashes, and links make components.
5. Of all other pairs that the bitmaps leave, only those between different components are decided,
   tile by tile. No pair that may be a link is left out; sets move only for what the bitmaps leave.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import slices
from .common import KEY, broadcast_if_small, keyed, packed, release, stored, temporary, unpacked
from .graph import components

WORDS = 5
PERCENT = 75
BUCKET_BITS = 20
# Shingles of a chunk of sets, 16 MB of hashes; a longer set is a chunk of its own.
CHUNK = 2_000_000
# Classes of a part of a tile, and partners that are decided together with one class.
TILE, PARTNERS = 1024, 128
# Shingles of a bucket from which on its groups are counted by aggregation, not by a window.
HOT_ROWS = 20_000
MAP_BITS = (9, 16)  # least and most bits of a bitmap, as powers of two
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _ODD[0]
    values = (values ^ (values >> np.uint64(29))) * _ODD[1]
    return values ^ (values >> np.uint64(32))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts in a row, bounds of each text).

    Words are split at ASCII white space and A-Z lower-cased; a text with fewer words is
    one shingle, one without words has none.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = pc.list_flatten(parts).dictionary_encode()
    # Lower-casing bytes changes A-Z only.
    table = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.lower()) for w in table), np.uint64, len(table))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter(map(len, table), np.int64, len(table))[codes] > 0
    bounds = np.concatenate([[0], np.cumsum(real)])[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    flat = hashes[codes[real]]
    sizes = np.diff(bounds)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - bounds[text_of] if len(flat) else np.zeros(0, np.int64)
    # A shingle starts where enough words follow, or at the first word of a shorter text.
    width = np.minimum(sizes, words)[text_of]
    start = np.flatnonzero(place + width <= sizes[text_of])
    grams = np.zeros(len(start), np.uint64)
    for j in range(words):
        inside = j < width[start]
        grams[inside] = _mix(grams[inside] + flat[start[inside] + j] + np.uint64(j + 1))
    owner = text_of[start]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[keep], owner[keep]
    return grams, np.searchsorted(owner, np.arange(len(sizes) + 1))


def _bucket(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def _bitmap(grams: np.ndarray) -> bytes:
    """Two to four bits for each shingle, within ``MAP_BITS``."""
    least, most = MAP_BITS
    bits = 1 << min(max(least, (2 * len(grams)).bit_length()), most)
    hit = np.zeros(bits, np.uint8)
    hit[(grams & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(hit).tobytes()


def _signatures(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """Per row its key, set size, 128-bit set digest and bitmap; per task one row of bucket counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for rows in slices(batch, "body"):
                grams, bounds = shingle_sets(rows.column("body"), words)
                counts += np.bincount(_bucket(grams, bits), minlength=1 << bits)
                data = memoryview(grams).cast("B") if len(grams) else memoryview(b"")
                digest = [xxhash.xxh3_128_digest(data[8 * a : 8 * b]) for a, b in zip(bounds, bounds[1:])]
                columns = {c: rows.column(c) for c in ("doc_id", *KEY)}
                maps = [_bitmap(grams[a:b]) for a, b in zip(bounds, bounds[1:])]
                columns |= {"n": pa.array(np.diff(bounds)), "digest": pa.array(digest, pa.binary()), "map": pa.array(maps, pa.binary())}
                empty = pa.nulls(len(digest), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns | {"buckets": empty, "counts": empty})
        used = np.flatnonzero(counts)
        if len(used):
            row = {c: pa.nulls(1, t) for c, t in zip(("doc_id", *KEY, "n", "digest", "map"), types)}
            for name, values in (("buckets", used), ("counts", counts[used])):
                row[name] = pa.ListArray.from_arrays(pa.array([0, len(used)], pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_pydict(row)

    kind = docs.schema["doc_id"].dataType
    types = [to_arrow_type(kind), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    schema = f"doc_id {kind.simpleString()}, key_id string, key_hash bigint, n bigint, digest binary, map binary"
    return docs.mapInArrow(run, f"{schema}, buckets array<bigint>, counts array<bigint>")


def _candidates(docs: DataFrame, counts: np.ndarray, words: int, percent: int, bits: int) -> DataFrame:
    """token, node, n, salt: the rarest shingles of each class, so many that alike sets share one; salts from 1 on for hot buckets.

    A bucket is hot from ``HOT_ROWS`` shingles and eight times the mean on: a token in it may be that of very many documents.
    """
    limit = max(HOT_ROWS, 8 * int(counts.mean()))
    table = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for batch in batches:
            for rows in slices(batch, "body"):
                grams, bounds = shingle_sets(rows.column("body"), words)
                sizes = np.diff(bounds)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                bucket = _bucket(grams, bits)
                order = np.lexsort((grams, counts[bucket], owner))
                rank = np.arange(len(grams)) - bounds[owner]
                prefix = sizes - -(-sizes * percent // 100) + 1
                chosen = order[rank < prefix[owner]]
                node = rows.column("node").to_numpy()[owner[chosen]]
                often = counts[bucket[chosen]]
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(grams[chosen].view(np.int64)),
                    "node": pa.array(node),
                    "n": pa.array(sizes[owner[chosen]]),
                    "salt": pa.array(np.where(often > limit, 1 + node % (often // limit + 1), 0)),
                })

    return docs.mapInArrow(run, "token bigint, node bigint, n bigint, salt bigint")


def _groups(tokens: DataFrame) -> DataFrame:
    """gid, node, n, size: the classes that share a token, once for all tokens shared by the same ones.

    ``gid`` is made of the number, the least and the mixed hashes of the members. Should two sets of
    members ever get the same one, they are one larger group, which loses no pair.
    """
    over = Window.partitionBy("token", "salt")
    members = {"size": F.count("*"), "least": F.min("node"), "mix": F.bit_xor(F.xxhash64("node"))}
    gid = F.xxhash64(*members).alias("gid")
    hot = F.col("salt") > 0
    rows = tokens.select("*", *[m.over(over).alias(name) for name, m in members.items()]).where(hot | (F.col("size") > 1))
    rows = stored(rows.select(F.when(hot, F.col("token")).alias("token"), F.when(~hot, gid).alias("gid"), "node", "n", F.when(~hot, F.col("size")).alias("size")).distinct())
    # Tokens of hot buckets have been dealt over salts; here partial sums meet, and Spark may split the join back where it is skewed.
    salted = rows.where("token is not null").select("token", "node", "n")
    shared = salted.groupBy("token").agg(*[m.alias(name) for name, m in members.items()]).where("size > 1")
    salted = salted.join(shared, "token").select(gid, "node", "n", "size")
    return rows.where("token is null").select("gid", "node", "n", "size").union(salted).distinct()


def _tiles(groups: DataFrame, percent: int, rows: int) -> DataFrame:
    """gid, low, high, part, node: the tiles of each class; in one of two different parts only pairs across count."""
    small = groups.where(F.col("size") <= rows).select("gid", *[F.lit(0).cast("bigint").alias(c) for c in ("low", "high", "part")], "node")
    # Sizes of alike sets are at most one band apart.
    width = float(np.log(100 / percent) * 1.000001) if percent < 100 else 1e-6
    large = groups.where(F.col("size") > rows).select("gid", "node", F.floor(F.log(F.col("n").cast("double")) / width).cast("bigint").alias("band"))
    bands = large.groupBy("gid", "band").agg(F.ceil(F.count("*") / rows).cast("bigint").alias("parts"))
    # There are as many bands as the logarithm of the longest set.
    maps = bands.groupBy("gid").agg(F.map_from_entries(F.collect_list(F.struct("band", "parts"))).alias("bands"))
    large = large.join(maps, "gid").withColumn("slice", F.pmod(F.xxhash64("node"), F.try_element_at("bands", F.col("band"))))

    def others(step: int) -> Column:
        band = F.col("band") + step
        parts = F.coalesce(F.try_element_at("bands", band), F.lit(0))
        numbers = F.when(parts > 0, F.sequence(F.lit(0).cast("bigint"), parts - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda i: F.shiftleft(band, 24) + i)

    own = F.shiftleft("band", 24) + F.col("slice")
    large = large.select("gid", "node", own.alias("part"), F.explode(F.concat(others(-1), others(0), others(1))).alias("other"))
    large = large.select("gid", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node")
    return small.union(large)


def _by_tile(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(tile, its rows) of rows that are sorted by tile."""
    tile, held = None, []
    for batch in batches:
        for *key, row in zip(*[batch.column(c).to_pylist() for c in ("gid", "low", "high")], zip(*[batch.column(c).to_pylist() for c in columns])):
            if key != tile:
                if len(held) > 1:
                    yield tile, held
                tile, held = key, []
            held.append(row)
    if len(held) > 1:
        yield tile, held


def _left_by_bitmaps(sizes: np.ndarray, parts: np.ndarray, roots: np.ndarray, maps: list[bytes], cross: bool, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each place in the order of size: later places it may be linked to, and how far the overlap may go beyond what it takes."""
    lengths = np.fromiter(map(len, maps), np.int64, len(maps))
    folded = {}
    for length in np.unique(lengths):
        # A longer bitmap folded on itself is the shorter one of the same set.
        matrix = np.zeros((len(maps), length), np.uint8)
        for i in np.flatnonzero(lengths >= length):
            np.bitwise_or.reduce(np.frombuffer(maps[i], np.uint8).reshape(-1, length), axis=0, out=matrix[i])
        folded[int(length)] = matrix.view(np.uint64)
    reach = np.searchsorted(sizes * percent, sizes * 100, side="right")
    for q in range(len(sizes)):
        others = np.arange(q + 1, reach[q])
        others = others[roots[others] != roots[q]]
        if cross:
            others = others[parts[others] != parts[q]]
        if len(others):
            rows = folded[int(lengths[q])]
            total = sizes[q] + sizes[others]
            most = (total - np.bitwise_count(rows[others] ^ rows[q]).sum(axis=1, dtype=np.int64)) // 2
            spare = (100 + percent) * most - percent * total
            left = spare >= 0
            if left.any():
                yield q, others[left], spare[left] / total[left]


def _with_maps(tiles: DataFrame, classes: DataFrame) -> DataFrame:
    joined = tiles.join(classes.select("node", "n", "map"), "node")
    return joined.repartition("gid", "low", "high").sortWithinPartitions("gid", "low", "high", "n", "node")


def _proposed(tiles: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs to decide first; or gid, low, high, part, node: the classes of a tile that are in other pairs left by bitmaps."""
    types = {c: pa.int64() for c in ("a", "b", "gid", "low", "high", "part", "node")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, held in _by_tile(batches, ["node", "part", "n", "map"]):
            ids, parts, sizes, maps = zip(*held)
            ids, parts, sizes = np.array(ids), np.array(parts), np.array(sizes)
            pairs, more = [], np.zeros(len(ids), bool)
            for q, others, spare in _left_by_bitmaps(sizes, parts, ids, maps, tile[1] != tile[2], percent):
                pairs.append((int(ids[q]), int(ids[others[np.argmax(spare)]])))
                if len(others) > 1:
                    more[others] = True
                    more[q] = True
            rows = [(a, b, None, None, None, None, None) for a, b in pairs]
            rows += [(None, None, *tile, int(parts[i]), int(ids[i])) for i in np.flatnonzero(more)]
            if rows:
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(types, zip(*rows))})

    return tiles.mapInArrow(run, ", ".join(f"{c} bigint" for c in types))


def _apart(tiles: DataFrame, percent: int, chunk: int) -> DataFrame:
    """gid, low, high, part, node, root: chunks of sets that hold the pairs left by bitmaps between different components."""
    names = ["gid", "low", "high", "part", "node", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, held in _by_tile(batches, ["node", "part", "n", "map", "root"]):
            ids, parts, sizes, maps, roots = zip(*held)
            ids, parts, sizes, roots = map(np.array, (ids, parts, sizes, roots))
            used = np.zeros(len(ids), bool)
            for q, others, _ in _left_by_bitmaps(sizes, parts, roots, maps, tile[1] != tile[2], percent):
                used[others] = True
                used[q] = True
            at = np.flatnonzero(used)
            if not len(at):
                continue
            number = np.cumsum(sizes[at]) // chunk
            runs = [at[number == k] for k in np.unique(number)]
            rows = []
            for i, low in enumerate(runs):
                for j, high in enumerate(runs[i:], i):
                    if 100 * sizes[low[-1]] < percent * sizes[high[0]]:
                        break
                    both = [(0, low)] if i == j else [(0, low), (1, high)]
                    # Tiles of the same sets are one, wherever they come from.
                    key = xxhash.xxh3_64_intdigest(b"|".join(np.sort(ids[x]).tobytes() for _, x in both))
                    key -= 1 << 63
                    rows += [(key, 0, int(i != j), part, int(ids[x]), int(roots[x])) for part, xs in both for x in xs]
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(names, zip(*rows))})

    return tiles.mapInArrow(run, ", ".join(f"{c} bigint" for c in names)).distinct()


def _links_in_tile(ids: np.ndarray, parts: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], cross: bool, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is alike and has different roots in one tile; ``cross``: only pairs of different parts are tested."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.lexsort((ids, sizes))
    ids, parts, roots, sizes, sets = ids[order], parts[order], roots[order], sizes[order], [sets[i] for i in order]
    bits = int(min(max(512, 1 << int(sizes[-1] * 2).bit_length()), 16384))
    maps = np.zeros((len(sets), bits // 8), np.uint8)
    for row, grams in zip(maps, sets):
        hit = np.zeros(bits, np.uint8)
        hit[(grams & np.uint64(bits - 1)).astype(np.int64)] = 1
        row[:] = np.packbits(hit)
    maps = maps.view(np.uint64)
    group, links = roots.copy(), []
    # The last set that a set of this size can be like.
    reach = np.searchsorted(sizes * percent, sizes * 100, side="right")
    for q in range(len(sets)):
        others = np.arange(q + 1, reach[q])
        others = others[group[others] != group[q]]
        if cross:
            others = others[parts[others] != parts[q]]
        if not len(others):
            continue
        total = sizes[q] + sizes[others]
        most = (total - np.bitwise_count(maps[others] ^ maps[q]).sum(axis=1, dtype=np.int64)) // 2
        # percent * union <= 100 * overlap, with union = total - overlap
        others = others[(100 + percent) * most >= percent * total]
        for r in others:
            if group[r] == group[q]:
                continue
            at = np.searchsorted(sets[r], sets[q])
            at[at == len(sets[r])] = 0
            overlap = int(np.count_nonzero(sets[r][at] == sets[q]))
            if (100 + percent) * overlap >= percent * int(sizes[q] + sizes[r]):
                links.append((int(ids[q]), int(ids[r])))
                group[group == group[r]] = group[q]
    return links


def _verified(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows (body, node, tiles) to links a, b; one tile at a time is in memory."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                grams, bounds = shingle_sets(part.column("body"), words)
                data = pa.py_buffer(grams.tobytes())
                packed = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 8).astype("<i4").tobytes()), data])
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "tiles": part.column("tiles"), "grams": packed})

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, held in _by_tile(batches, ["node", "part", "root", "grams"]):
            ids, parts, roots, grams = zip(*held)
            held = [np.frombuffer(g, "<u8") for g in grams]
            found = _links_in_tile(np.array(ids), np.array(parts), np.array(roots), held, tile[1] != tile[2], percent)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    packed = rows.mapInArrow(sets, "node bigint, tiles array<struct<gid:bigint,low:bigint,high:bigint,part:bigint,root:bigint>>, grams binary")
    spread = packed.select("node", "grams", F.inline("tiles"))
    tiles = spread.repartition("gid", "low", "high").sortWithinPartitions("gid", "low", "high")
    return tiles.mapInArrow(link, "a bigint, b bigint")


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    bucket_bits: int = BUCKET_BITS,
    chunk: int = CHUNK,
    tile: int = TILE,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, key, n_shingles, component_id.

    ``component_id`` is the least id reachable over links (Jaccard of ``percent`` and
    more), the document's own included. Null texts and texts without words link with
    nothing. Repeated rows and ids are nodes of their own; a null id counts as larger
    than any other, and a component of null ids only has a null id. Columns of other
    names play no part.
    """
    docs = keyed(documents, doc_id, text)
    found = stored(_signatures(docs, words, bucket_bits))
    # At most one row per bucket: a table of fixed size, whatever the input.
    buckets = found.where("buckets is not null").select(F.inline(F.arrays_zip("buckets", "counts")))
    table = np.zeros(1 << bucket_bits, np.int64)
    for row in buckets.groupBy("buckets").agg(F.sum("counts").alias("n")).toArrow().to_batches():
        table[row.column(0).to_numpy()] = row.column(1).to_numpy()
    members = found.where("buckets is null").select("doc_id", *KEY, "n", "digest", "map")
    # One node per distinct set; its text stands for all.
    classes = stored(
        members.where("n > 0")
        .groupBy("n", "digest")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct(*KEY)).alias("key"), F.first("map").alias("map"))
        .select("n", "digest", "least_id", "key.*", "map", F.monotonically_increasing_id().alias("node"))
    )
    members = members.drop("map")
    n_classes = classes.count()
    chosen = docs.select(*KEY, "body").join(broadcast_if_small(classes.select(*KEY, "node"), n_classes), KEY).select("body", "node")
    tokens = _candidates(chosen, table, words, percent, bucket_bits)
    with temporary(docs.sparkSession) as keep:
        tiles = keep(stored(_tiles(stored(_groups(tokens)), percent, tile)))

    def decided(rows: DataFrame) -> DataFrame:
        """Links within tiles of sets: rows gid, low, high, part, node, root."""
        lists = rows.groupBy("node").agg(F.collect_list(F.struct("gid", "low", "high", "part", "root")).alias("tiles"))
        lists = stored(lists.join(classes.select("node", *KEY), "node"))
        texts = docs.select(*KEY, "body").join(broadcast_if_small(lists, lists.count()), KEY)
        # Repeated rows have the same key.
        links = stored(_verified(texts.select("body", "node", "tiles"), words, percent).distinct())
        release(lists)
        return links

    proposed = stored(_proposed(_with_maps(tiles, classes), percent))
    release(tiles)
    pairs = proposed.where("a is not null").select("a", "b").distinct()
    heads = pairs.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).cast("bigint").alias("runs"))
    pairs = stored(pairs.join(heads, "b").select("a", "b", F.pmod(F.xxhash64("a"), "runs").alias("low")))
    stars = pairs.select(F.col("b").alias("gid"), "low", F.explode(F.array("a", "b")).alias("node")).distinct()
    zero = F.lit(0).cast("bigint")
    links = decided(stars.select("gid", "low", F.col("low").alias("high"), zero.alias("part"), "node", F.col("node").alias("root")))
    roots = stored(components(links))
    left = proposed.where("a is null").drop("a", "b").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = left.groupBy("gid", "low", "high").agg(F.min("root").alias("one"), F.max("root").alias("two")).where("one <> two")
    left = stored(left.join(mixed.select("gid", "low", "high"), ["gid", "low", "high"]))
    release(pairs, proposed)
    more = decided(stored(_apart(_with_maps(left, classes), percent, chunk)))
    if not more.isEmpty():
        roots = stored(components(links.union(more)))
    labelled = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labelled = labelled.join(least, "root").select("n", "digest", "component_id")
    joined = members.join(labelled, ["n", "digest"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", *KEY, F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``documents`` with one of each component: the least id, and of equal ids the least text hash.

    Same columns. Documents without words link with nothing and stay; of repeated rows
    one stays.
    """
    with temporary(documents.sparkSession) as keep:
        found = keep(stored(near_duplicates(documents, doc_id, text, **options)))
    least = F.min(F.struct("doc_id", *KEY))
    kept = found.where("n_shingles > 0 and component_id is not null").groupBy("component_id").agg(least.alias("kept")).select("kept.*")
    rest = found.where("n_shingles = 0 or component_id is null").select("doc_id", *KEY).distinct()
    kept = stored(kept.union(rest).select(*KEY))
    stays = packed(documents, doc_id, text).join(broadcast_if_small(kept, kept.count()), KEY, "left_semi")
    # Only keys that occur more than once, if any, are worth a shuffle of texts.
    repeated = stored(found.groupBy(*KEY).count().where("count > 1").select(*KEY))
    n = repeated.count()
    if n:
        repeated = broadcast_if_small(repeated, n)
        once = stays.join(repeated, KEY, "left_anti")
        stays = once.union(stays.join(repeated, KEY, "left_semi").select(*once.columns).dropDuplicates(KEY))
    return stays.select(*unpacked(documents.columns))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop(*KEY)
