"""Secrets in whole texts, and who else has them; column expressions only.

1. Patterns give candidates with their places. A text is split at the matches of a
   pattern, so the pieces and matches together give each match its offset.
2. Candidates are hashed and counted over the corpus by distinct repository and
   distinct owner. Pairs are made distinct before they are counted, so a value that
   a third of all documents hold moves once per repository and task.
3. What several owners have is a copied example; what one or two have, if it looks
   random, is taken for a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, broadcast_if_small, keyed, sha256_hex, stored

# Kind, pattern, group that holds the value, least length of that group.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", r"([0-9a-f]{16,})", 1, 16),
]
# Formats of well-known issuers, and key blocks.
MORE = [
    ("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 40),
    ("slack", r"(xox[abeprs]-[A-Za-z0-9-]{10,})", 1, 15),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,})", 1, 25),
    ("pem", r"(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)", 1, 20),
]
SHARED_OWNERS = 3
LEAST_LETTERS = 8


def _matches(text: Column, pattern: str) -> Column:
    """(length of the text before each match since the one before, match)."""
    before = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.arrays_zip(before.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    # The piece after the last match has none.
    return F.when(text.rlike(pattern), F.slice(pairs, 1, F.size(pairs) - 1))


def find_candidates(docs: DataFrame, kinds: list[tuple[str, str, int, int]], keep: list[str]) -> DataFrame:
    """Rows of ``docs`` (columns ``KEY``, ``body`` and ``keep``) to kind, order, start, end, value.

    Offsets count code points; ``end`` is exclusive. Matches of one kind do not overlap;
    one whose value is too short is used up all the same.
    """
    found = None
    for order, (kind, pattern, group, least) in enumerate(kinds):
        part = docs.select(*KEY, *keep, F.posexplode(_matches(F.col("body"), pattern))).select(
            *KEY, *keep, F.lit(kind).alias("kind"), F.lit(order).alias("order"), "pos",
            F.col("col.gap").alias("gap"), F.col("col.found").alias("found"),
            F.regexp_extract(F.col("col.found"), pattern, group).alias("value"), F.lit(least).alias("least"),
        )
        found = part if found is None else found.union(part)
    # Repeated rows have equal matches; the window then sees each once.
    found = found.distinct()
    upto = Window.partitionBy(*KEY, *keep, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("found")).over(upto)
    found = found.withColumn("end", end).where(F.length("value") >= F.col("least"))
    return found.select(*KEY, *keep, "kind", "order", (F.col("end") - F.length("found")).alias("start"), "end", "value")


def ownership(candidates: DataFrame) -> DataFrame:
    """value_hash, n_owners, n_repos: over the whole corpus; null owners count as one."""
    pairs = candidates.select("value_hash", "repo", "owner").distinct()
    owners = pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def find_secrets(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repo: list[str] | None = None,
    kinds: list[tuple[str, str, int, int]] | None = None,
    shared_owners: int = SHARED_OWNERS,
) -> DataFrame:
    """One row per secret and distinct document: key, kind, start, end, value_hash, n_owners, n_repos, verdict.

    ``verdict`` is ``example`` (several owners), ``live`` or ``weak`` (few distinct
    letters or a placeholder). Null and empty texts have none. Values leave the
    function as hashes only. ``repo`` names the columns that tell repositories apart.
    """
    repo = [owner] if repo is None else repo
    docs = documents.select(
        *[c.alias(n) for n, c in _key(doc_id, text)],
        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("owner"),
        F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(repo)])).alias("repo"),
    )
    found = find_candidates(docs, BASE + MORE if kinds is None else kinds, ["owner", "repo"])
    letters = F.size(F.array_distinct(F.split(F.lower("value"), "")))
    placeholder = F.col("value").rlike(r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0{8}|12345678")
    found = stored(
        found.select(
            *KEY, "owner", "repo", "kind", "order", "start", "end",
            sha256_hex(F.col("value")).alias("value_hash"),
            ((letters < LEAST_LETTERS) | placeholder).alias("weak"),
        )
    )
    counts = stored(ownership(found))
    verdict = F.when(F.col("n_owners") >= shared_owners, "example").when(F.col("weak"), "weak").otherwise("live")
    joined = found.join(broadcast_if_small(counts, counts.count()), "value_hash")
    return joined.select(*KEY, "kind", "order", "start", "end", "value_hash", "n_owners", "n_repos", verdict.alias("verdict"))


def _key(doc_id: str, text: str) -> list[tuple[str, Column]]:
    body = F.col(f"`{text}`")
    key_id = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return [("key_id", key_id), ("key_hash", F.xxhash64(body)), ("body", body)]


def summarise(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``documents``: counts by base kind, base and all spans, counts by verdict.

    ``base_sha256`` digests the base spans; ``spans`` lists all as kind:start:end, by
    start and then by kind. Documents without secrets have zeros and empty strings.
    """
    found = find_secrets(documents, doc_id, text, **options)
    # A document may stand under several owners: its spans are the same, its verdicts too.
    spans = found.groupBy(*KEY).agg(F.collect_set(F.struct("start", "order", "kind", "end", "verdict")).alias("found"))
    base = [k for k, *_ in BASE]

    def listed(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(field: str, value: str) -> Column:
        return F.size(F.filter("found", lambda s: s[field] == value)).cast("bigint")

    spans = spans.withColumn("found", F.sort_array("found"))
    rows = keyed(documents, doc_id, text).drop("body").join(spans, KEY, "left")
    found = F.coalesce("found", F.array().cast(spans.schema["found"].dataType))
    rows = rows.withColumn("found", found)
    return rows.select(
        "doc_id",
        *[number("kind", k).alias(f"n_{k}") for k in base],
        sha256_hex(listed(F.filter("found", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        *[number("verdict", v).alias(f"n_{v}") for v in ("live", "example", "weak")],
    )


def query(spark, sf_dir: str) -> DataFrame:
    """``source`` is the owner, source and language the repository."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return summarise(documents, repo=["source", "lang"])
