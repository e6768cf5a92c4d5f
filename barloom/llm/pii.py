"""Personal data replaced by surrogates of the same type, with column expressions only.

1. One pattern finds entities; card numbers must pass their check digit, addresses
   their ranges. What fails stays as it is.
2. Entities are brought to one form (letter case, separators, title removed) and made
   distinct over the corpus, so that all mentions of one share one surrogate.
3. A surrogate comes from a keyed digest of that form: letters for letters and digits
   for digits, a valid check digit, a reserved domain or address range, a name of
   the same gender and script.
4. Collision checks: no two entities get one surrogate and no surrogate is an entity of
   the corpus; who loses draws again, until nobody does.
5. Surrogates return to the texts in the format of each mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, broadcast_if_small, keyed, original, packed, stored, unpacked, with_once

_W = r"\p{L}\p{N}"
_TITLES = (
    r"Mrs|Mr|Ms|Miss|Dr|Prof|Herr|Frau|Fräulein|Monsieur|Madame|Mademoiselle|Mme|Mlle|M\."
    r"|Señorita|Señora|Señor|Srta|Sra|Sr|г-н|г-жа"
)
# A capitalised word (McDonald, O'Brien, SMITH) or an initial, but no title.
_PART = rf"(?!(?:{_TITLES})\.? )\p{{Lu}}(?:\.(?= \p{{Lu}})|[\p{{L}}\p{{M}}]*+(?:['’]\p{{Lu}}[\p{{L}}\p{{M}}]*+)*+)"
_PARTICLE = r"(?:(?:von|van|der|den|zu|de|del|della|di|da|du|dos|la|le|y) )"
# Kind and pattern, in the order in which they are tried at a place. No capturing groups. What may
# repeat without bound is possessive: other groups cost the JVM a stack frame for each repetition.
PATTERNS = {
    "email": rf"(?<![{_W}._%+-])[{_W}._%+-]+@[{_W}-]++(?:\.[{_W}-]++(?=\.[{_W}-]*+\.|\.\p{{L}}{{2}}))*+\.\p{{L}}{{2,}}",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": (
        r"(?<![\p{L}\d])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
        r"|(?<![\p{L}\d])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)"
    ),
    "card": r"(?<!\d)(?:\d{13,19}|(?:\d{4}[ -]){3}\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
    "name": (
        rf"(?<![\p{{L}}\d])(?:{_TITLES})\.? {_PARTICLE}*+{_PART}(?:[ -]{_PARTICLE}*+{_PART}){{0,3}}"
    ),
}
KINDS = list(PATTERNS)
_ANY = "|".join(PATTERNS.values())
_TITLE = rf"^({_TITLES})\.? "
_FEMALE = r"^(Mrs|Ms|Miss|Frau|Fräulein|Madame|Mademoiselle|Mme|Mlle|Señorita|Señora|Srta|Sra|г-жа)[. ]"
_EITHER = r"^(Dr|Prof)[. ]"

# Country calling codes of one and two digits; all others have three.
_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()

# Given names by gender and script, and syllables of surnames by script.
_GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Niklas Oscar Paul".split(),
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Klara Laura Maria Nora Olga Paula".split(),
    ("x", "latin"): "Alex Andrea Billie Charlie Chris Dominique Jamie Jean Kim Luca Maxime Robin Sam Sascha Toni Vivian".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Семён Юрий".split(),
    ("x", "cyrillic"): "Валя Женя Слава Саша Паша Тоня Шура Вася Мила Лера Стася Рена Юля Ника Миша Лёля".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Нина Ольга Полина Раиса София Юлия".split(),
}
_SYLLABLES = {
    "latin": "ba do fe gi ko lu ma ne po ri sa te vo wi za mo".split(),
    "cyrillic": "ба до фе ги ко лу ма не по ри са те во ви за мо".split(),
}
MAX_DRAWS = 50


def _digits(value: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(value, r"\D", ""), ""), lambda d: d.cast("int"))


def _luhn(digits: Column) -> Column:
    """Sum that the check digit brings to a multiple of ten."""
    weighted = F.transform(
        F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    )
    return F.aggregate(weighted, F.lit(0), lambda total, d: total + d)


def _kind(found: Column) -> Column:
    """The kind of a match, null if it does not hold."""
    octets = F.transform(F.split(found, r"\."), lambda o: F.try_to_number(o, F.lit("999")).cast("int"))
    holds = {
        "ip": F.forall(octets, lambda o: o <= 255),
        "card": _luhn(_digits(found)) % 10 == 0,
    }
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        whole = found.rlike(f"^(?:{PATTERNS[name]})$")
        kind = F.when(whole, F.when(holds[name], name) if name in holds else F.lit(name)).otherwise(kind)
    return kind


def entities(docs: DataFrame) -> DataFrame:
    """Rows with ``KEY`` and ``body`` to pos (of the match in its text), found, kind."""
    matches = F.when(F.col("body").rlike(_ANY), F.regexp_extract_all("body", F.lit(_ANY), F.lit(0)))
    rows = docs.select(*KEY, F.posexplode(matches)).withColumnRenamed("col", "found")
    return with_once(rows, kind=_kind(F.col("found"))).where("kind is not null")


def _canonical(rows: DataFrame) -> DataFrame:
    """Adds ``form``: what all mentions of one entity have in common."""
    name = F.concat(
        F.when(F.col("found").rlike(_FEMALE), "f").when(F.col("found").rlike(_EITHER), "x").otherwise("m"),
        F.when(F.col("found").rlike(r"\p{IsCyrillic}"), "|cyrillic|").otherwise("|latin|"),
        F.regexp_replace(F.regexp_replace("found", _TITLE, ""), "-", " "),
    )
    form = (
        F.when(F.col("kind") == "email", F.lower("found"))
        .when(F.col("kind").isin("phone", "card", "ssn"), F.regexp_replace("found", r"[^\d+]", ""))
        .when(F.col("kind") == "name", name)
        .otherwise(F.col("found"))
    )
    return rows.withColumn("form", form)


def _bytes(*parts: Column) -> Column:
    """32 numbers from 0 to 255: the digest of the parts."""
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)
    return F.transform(
        F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    )


def _alike(text: Column, numbers: Column) -> Column:
    """Letters for letters and digits for digits, the rest as it is; ``text`` is lower case."""
    letters = F.array(*[F.lit(chr(c)) for c in range(ord("a"), ord("z") + 1)])

    def change(c: Column, i: Column) -> Column:
        n = F.get(numbers, i % 32)
        return F.when(c.rlike(r"\d"), (n % 10).cast("string")).when(c.rlike(r"\p{L}"), F.get(letters, n % 26)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), change), "")


def _surrogates(distinct: DataFrame, key: str) -> DataFrame:
    """Adds ``surrogate`` to kind, form, draw."""
    secret, form, kind = F.lit(key), F.col("form"), F.col("kind")
    rows = with_once(
        distinct,
        _b=_bytes(secret, kind, form, F.col("draw").cast("string")),
        _d=_bytes(secret, F.lit("domain"), F.regexp_extract(form, "@(.*)", 1)),
        _s=_bytes(secret, F.lit("surname"), F.element_at(F.split(form, "[ |]"), -1), F.col("draw").cast("string")),
        _g=_bytes(secret, F.lit("given"), form),
    )
    b = F.col("_b")

    # More letters once the short forms have been tried.
    def extra(syllables: Column) -> Column:
        more = F.transform(F.sequence(F.lit(0), F.col("draw")), lambda i: F.get(syllables, F.get(b, (i + 20) % 32) % 16))
        return F.when(F.col("draw") > 2, F.array_join(more, "")).otherwise("")

    def names(words: list[str]) -> Column:
        return F.array(*map(F.lit, words))

    latin, cyrillic = names(_SYLLABLES["latin"]), names(_SYLLABLES["cyrillic"])
    domain = F.concat(
        _alike(F.regexp_extract("form", r"@([^.]*)", 1), F.col("_d")),
        F.lit(".example."),
        F.coalesce(F.nullif(F.regexp_extract("form", r"\.(com|net|org)$", 1), F.lit("")), F.lit("org")),
    )
    email = F.concat(_alike(F.regexp_extract("form", "^(.*)@", 1), b), extra(latin), F.lit("@"), domain)

    plain = _digits(form)
    # The country stays, or the first digit.
    code = F.coalesce(
        *[F.when(F.substring(form, 2, n).isin(*[c for c in _CODES if len(c) == n]), n) for n in (1, 2)],
        F.when(form.startswith("+"), 3),
        F.lit(1),
    )
    drawn = F.transform(F.sequence(F.lit(1), F.size(plain)), lambda i: (F.get(b, i) % 10).cast("string"))
    phone = F.concat(
        F.when(form.startswith("+"), "+").otherwise(""),
        F.array_join(F.transform(F.slice(plain, 1, code), lambda d: d.cast("string")), ""),
        F.array_join(F.slice(drawn, 1, F.size(plain) - code), ""),
    )
    body = F.concat(F.array(F.get(plain, F.lit(0))), F.transform(F.slice(drawn, 1, F.size(plain) - 2), lambda d: d.cast("int")))
    check = (10 - _luhn(F.concat(body, F.array(F.lit(0)))) % 10) % 10
    card = F.concat(F.array_join(F.transform(body, lambda d: d.cast("string")), ""), check.cast("string"))
    ssn = F.concat(F.lit("9"), F.array_join(F.slice(drawn, 1, 8), ""))
    own = form.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)")
    first = F.when(own, F.lit(10)).otherwise(240 + F.get(b, F.lit(0)) % 15)
    ip = F.concat_ws(".", first.cast("string"), *[F.get(b, F.lit(i)).cast("string") for i in (1, 2, 3)])

    script = F.regexp_extract("form", r"^.\|(\w+)\|", 1)
    given = F.lit(None).cast("string")
    for (gender, kind_of), words in _GIVEN.items():
        here = form.startswith(f"{gender}|{kind_of}|")
        given = F.when(here, F.get(names(words), F.get("_g", F.lit(0)) % 16)).otherwise(given)
    syllables = F.when(script == "cyrillic", cyrillic).otherwise(latin)
    surname = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.get(syllables, F.get("_s", i) % 16))
    surname = F.initcap(F.concat(F.array_join(surname, ""), extra(syllables)))
    name = F.concat(
        F.regexp_extract("form", r"^(.\|\w+\|)", 1),
        F.when(form.contains(" "), F.concat(given, F.lit(" "))).otherwise(""),
        surname,
    )
    made = {"email": email, "phone": phone, "card": card, "ssn": ssn, "ip": ip, "name": name}
    surrogate = F.lit(None).cast("string")
    for name_of, expr in made.items():
        surrogate = F.when(kind == name_of, expr).otherwise(surrogate)
    return with_once(rows, surrogate=surrogate).select("kind", "form", "draw", "surrogate")


def assign(distinct: DataFrame, key: str) -> DataFrame:
    """kind, form, surrogate for distinct (kind, form): one to one, and none is a form itself.

    Each round every loser draws again; winners keep theirs. Rounds are needed where
    draws collide, so their number does not grow with the documents.
    """
    forms = stored(distinct)
    rows = stored(_surrogates(forms.withColumn("draw", F.lit(0)), key))
    known = forms.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("taken"))
    for _ in range(MAX_DRAWS):
        order = Window.partitionBy("kind", "surrogate").orderBy("draw", "form")
        ranked = rows.withColumn("place", F.row_number().over(order)).join(known, ["kind", "surrogate"], "left")
        lost = (F.col("place") > 1) | F.coalesce("taken", F.lit(False))
        ranked = stored(ranked.select("kind", "form", "draw", "surrogate", lost.alias("lost")))
        if ranked.where("lost").isEmpty():
            return ranked.select("kind", "form", "surrogate")
        again = _surrogates(ranked.where("lost").select("kind", "form", (F.col("draw") + 1).alias("draw")), key)
        rows = stored(ranked.where("not lost").select("kind", "form", "draw", "surrogate").union(again))
    raise ValueError(f"no distinct surrogates after {MAX_DRAWS} draws")


def _formatted(found: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention."""
    digits = F.split(F.regexp_replace(surrogate, r"\D", ""), "")
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"))

    def put(acc: Column, c: Column) -> Column:
        digit = c.rlike(r"\d")
        return F.struct(
            (acc["i"] + digit.cast("int")).alias("i"),
            F.concat(acc["out"], F.when(digit, F.get(digits, acc["i"])).otherwise(c)).alias("out"),
        )

    def cased(c: Column, i: Column) -> Column:
        there = F.substring(found, i + 1, F.lit(1))
        return F.when((there == F.upper(there)) & (there != F.lower(there)), F.upper(c)).otherwise(c)

    before = F.array_join(F.transform(F.split(F.substring_index(surrogate, "@", 1), ""), cased), "")
    email = F.concat(before, F.regexp_extract(surrogate, "@.*", 0))
    title = F.regexp_extract(found, _TITLE, 0)
    sign = F.when(F.regexp_replace(found, _TITLE, "").rlike(r"^\S+-\S+$"), "-").otherwise(" ")
    name = F.concat(title, F.replace(F.regexp_replace(surrogate, r"^.\|\w+\|", ""), F.lit(" "), sign))
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.aggregate(F.split(found, ""), start, put)["out"])
        .when(kind == "name", name)
        .when((kind == "email") & (found == F.upper(found)) & (found != F.lower(found)), F.upper(surrogate))
        .when(kind == "email", email)
        .otherwise(surrogate)
    )


def pseudonymise(
    documents: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars"
) -> DataFrame:
    """``documents`` with entities replaced, and ``pii_counts``, a map of kind to mentions.

    The same key gives the same surrogates for the same corpus. Null and empty texts stay
    as they are; repeated rows are treated alike. ``n_chars`` (if there is such a column)
    is counted anew where something was replaced.
    """
    docs = keyed(documents, doc_id, text)
    found = stored(_canonical(entities(docs).distinct()))
    table = assign(found.select("kind", "form").distinct(), key)
    mentions = stored(found.select("kind", "form", "found").distinct().join(table, ["kind", "form"]))
    mentions = with_once(mentions, new=_formatted(F.col("found"), F.col("kind"), F.col("surrogate"))).select("found", "kind", "new")
    placed = found.select(*KEY, "pos", "found", "kind").join(broadcast_if_small(mentions, mentions.count()), ["found", "kind"])
    # A document's own mentions; bounded by its length.
    placed = stored(placed.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("pos", "new", "kind"))).alias("new")))
    joined = packed(documents, doc_id, text).join(broadcast_if_small(placed, placed.count()), KEY, "left")
    changed = F.col("new").isNotNull()
    joined = with_once(
        joined,
        gaps=F.when(changed, F.split("body", _ANY, -1)),
        found=F.when(changed, F.regexp_extract_all("body", F.lit(_ANY), F.lit(0))),
        by_pos=F.map_from_arrays(F.col("new.pos"), F.col("new.new")),
        counts=F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*[_number(k) for k in KINDS])),
    )
    # Gaps and matches take turns; a match without a surrogate stays. There is one gap more.
    pieces = F.transform("gaps", lambda g, i: F.concat(g, _piece(i)))
    joined = with_once(joined, left=F.when(changed, F.array_join(pieces, "")).otherwise(F.col("body")))
    columns = {text: F.col("left")}
    if n_chars in documents.columns:
        size = F.length("left").cast(documents.schema[n_chars].dataType)
        columns[n_chars] = F.when(changed, size).otherwise(original(documents.columns, n_chars))
    return joined.select(*unpacked(documents.columns, **columns), F.col("counts").alias("pii_counts"))


def _piece(i: Column) -> Column:
    old = F.get("found", i)
    return F.coalesce(F.try_element_at("by_pos", i), old, F.lit(""))


def _number(kind: str) -> Column:
    return F.when(F.col("new").isNull(), F.lit(0).cast("bigint")).otherwise(
        F.size(F.filter("new", lambda n: n["kind"] == kind)).cast("bigint")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """The key belongs to whoever runs the pipeline; here it is a fixed word."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = pseudonymise(documents, key="surrogates")
    return done.select("doc_id", *[F.coalesce(F.col("pii_counts")[k], F.lit(0)).alias(f"n_{k}") for k in KINDS], "text")
