"""Secret scan: fixed patterns, and tokens that read like random strings.

Two character Markov models, one of random strings and one of ordinary identifiers, are
compared by the log-likelihood ratio of a token's characters. Random strings are what the
fixed patterns find. Ordinary are the words that a sample of texts holds beside it, in their
own case and in capitals; identifiers that are made of such words and of ``NAMING``, joined
in the usual ways (camel case, underscores, dashes, paths, numbers at the end); and times
and dates as they stand in names of files. The samples are bounded by documented parameters
(``RANDOM_TOKENS``, ``ORDINARY_TEXTS``, ``IDENTIFIERS``). The model is one table over pairs
of symbols, so its size does not depend on the corpus.

Everything on the main path is a DataFrame expression: matches come from
``regexp_extract_all``, their places from the lengths of the gaps that ``split`` leaves,
the ratio from a fold over the characters. Work grows with a text's length and the number
of its matches (times its logarithm, for sorting them). No shuffle touches the texts.

Defined results: null text reads as empty; a text without spans has the hash of the empty
string; without a single random sample the model finds nothing; spans of the model never
touch spans of the patterns; repeated rows give repeated results; an empty table gives an
empty result; other columns of the documents are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import some_texts

#: The patterns, and the least length of what they find.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
RANDOM_TOKENS = 20_000
ORDINARY_TEXTS = 2_000
IDENTIFIERS = 20_000
BLOCK = 64
LEAST_RATIO = 12.0  # nats for the whole token
LEAST_MEAN = 0.25  # nats per character


#: Words that names of programs, files and settings are often made of; a labelled sample.
NAMING = """
    get set is has add new old make create build find load save read write open close start
    stop run init update delete remove insert append count size length index item items list
    map table row column key value name type kind id code data date time day month year user
    admin account client server service request response error message event handler listener
    factory builder manager provider context session config option default property attribute
    element identifier node tree path file folder directory source target input output buffer
    stream reader writer parser format string number integer boolean array object class method
    function module package project example test mock abstract base common util helper core
    controller model view page form field button image script
    version release backup archive temp cache store record query result filter order group
    join merge split first last next previous left right top bottom max min total average
    over the and with for from into
""".split()


def _matches(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named inside."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _running(values: Column, start: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Each whole number combined with all before it.

    In blocks of BLOCK: a fold that adds to an array would copy the array at each step.
    """

    def folded(part: Column) -> Column:
        return F.aggregate(part, F.lit(start), combine)

    def upto(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.expr("cast(array() as array<int>)"))

    def block(all_: Column, before: Column, k: Column) -> Column:
        both = F.struct(
            folded(F.slice(before, F.lit(1), k - 1)).alias("before"),
            F.slice(all_, (k - 1) * BLOCK + 1, F.lit(BLOCK)).alias("part"),
        )
        return _let(both, lambda b: F.transform(
            upto(F.size(b["part"])),
            lambda i: combine(b["before"], folded(F.slice(b["part"], F.lit(1), i))),
        ))

    def blocks(all_: Column) -> Column:
        numbers = upto(F.ceil(F.size(all_) / BLOCK).cast("int"))
        whole = F.transform(numbers, lambda k: folded(F.slice(all_, (k - 1) * BLOCK + 1, F.lit(BLOCK))))
        return _let(whole, lambda before: F.flatten(F.transform(numbers, lambda k: block(all_, before, k))))

    return _let(values, blocks)


def _places(text: Column, pattern: str, found: Column) -> Column:
    """(start, end) of each match, from the lengths of gaps and matches."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.arrays_zip(gaps.alias("gap"), F.transform(found, F.length).alias("size"))
    steps = F.filter(steps, lambda s: s["size"].isNotNull())
    ends = _running(F.flatten(F.transform(steps, lambda s: F.array(s["gap"], s["size"]))), 0, lambda a, x: a + x)
    places = _let(ends, lambda e: F.transform(
        F.sequence(F.lit(0), F.size(e) - 2, F.lit(2)),
        lambda k: F.struct(F.get(e, k).alias("start"), F.get(e, k + 1).alias("end")),
    ))
    return F.when(F.size(found) > 0, places).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)"))


def _spans(kind: int, places: Column) -> Column:
    """Spans sort by start, then by the order of the kinds."""
    return F.transform(
        places,
        lambda p: F.struct(
            p["start"].alias("start"),
            F.lit(kind).alias("rank"),
            p["end"].alias("end"),
        ),
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """Add ``_text`` (no nulls), ``_assign``, ``_access``, ``_hex`` and ``_base`` to the rows."""
    text = F.col("_text")
    rows = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumns(
        {
            "_found0": _matches(text, ASSIGN),
            "_value0": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
            "_found1": _matches(text, ACCESS),
            "_found2": _matches(text, HEX),
        }
    )
    rows = rows.withColumns(
        {
            "_place0": _places(text, ASSIGN, F.col("_found0")),
            "_place1": _places(text, ACCESS, F.col("_found1")),
            "_place2": _places(text, HEX, F.col("_found2")),
        }
    )
    long_value = F.filter(
        F.arrays_zip(F.col("_place0").alias("p"), F.col("_value0").alias("v")),
        lambda z: F.length(z["v"]) >= ASSIGN_LEAST,
    )
    rows = rows.withColumns(
        {
            "_assign": _spans(0, F.transform(long_value, lambda z: z["p"])),
            "_access": _spans(
                1, F.filter("_place1", lambda p: p["end"] - p["start"] >= ACCESS_LEAST)
            ),
            "_hex": _spans(2, F.col("_place2")),
        }
    )
    rows = rows.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    return rows.drop(
        *[f"_found{k}" for k in range(3)], *[f"_place{k}" for k in range(3)], "_value0"
    )


def _pairs(tokens: DataFrame) -> dict[str, int]:
    """Counts of neighbouring symbols over a column ``token``; at most SYMBOLS squared rows."""
    chars = F.split("token", "")
    rest = F.length("token") - 1
    each = F.zip_with(F.slice(chars, 1, rest), F.slice(chars, 2, rest), lambda a, b: F.concat(a, b))
    known = f"^[{SYMBOLS[:62]}+/_=.-]{{2}}$"
    rows = (
        tokens.where(F.length("token") > 1)
        .select(F.explode(each).alias("pair"))
        .where(F.col("pair").rlike(known))
        .groupBy("pair")
        .count()
    )
    return {r["pair"]: r["count"] for r in rows.collect()}


def log_ratios(random: dict[str, int], ordinary: dict[str, int]) -> list[float]:
    """log P(random) - log P(ordinary) of each ordered pair of symbols, add-one smoothed."""
    out = []
    for first in SYMBOLS:
        sums = [sum(m.get(first + c, 0) for c in SYMBOLS) + len(SYMBOLS) for m in (random, ordinary)]
        for second in SYMBOLS:
            p, q = ((m.get(first + second, 0) + 1) / s for m, s in zip((random, ordinary), sums))
            out.append(math.log(p / q))
    return out


def train(docs: DataFrame) -> list[float] | None:
    """The table of log ratios, or None without a random sample.

    Random: the bodies that the patterns find, at most ``RANDOM_TOKENS`` different ones,
    the first by hash. Ordinary: words of at most about ``ORDINARY_TEXTS`` whole texts, chosen
    by the hash of the text, equal texts once, without words that mix digits with letters.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    body = F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    random = (
        docs.select(F.explode(body).alias("token"))
        .where(F.length("token") >= ACCESS_LEAST)
        .distinct()
        .orderBy(F.xxhash64("token"), "token")
        .limit(RANDOM_TOKENS)
    )
    pairs = _pairs(random)
    if not pairs:
        return None
    words = some_texts(docs, ORDINARY_TEXTS, 17).select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=.-]+"), F.lit(0))).alias("token")
    ).where(~(F.col("token").rlike("[0-9]") & F.col("token").rlike("[A-Za-z]")))
    both = words.select(F.explode(F.array("token", F.upper("token"))).alias("token"))
    ordinary, named = _pairs(both), _pairs(identifiers(words))
    weight = max(1, sum(ordinary.values()) // sum(named.values()))  # as much as the words
    for pair, count in named.items():
        ordinary[pair] = ordinary.get(pair, 0) + weight * count
    return log_ratios(pairs, ordinary)


def identifiers(words: DataFrame) -> DataFrame:
    """(token) names as programs and files have them, joined of the words of ``words``
    (token) and of NAMING, and times and dates: 2 * IDENTIFIERS numbers choose the parts."""
    spark = words.sparkSession
    plain = words.where(F.col("token").rlike("^[A-Za-z]{2,12}$")).select(F.lower("token").alias("word"))
    some = plain.distinct().orderBy(F.xxhash64("word"), "word").limit(2 * len(NAMING))
    vocabulary = sorted(r["word"] for r in some.collect())
    choice = F.lit(NAMING + vocabulary)
    drawn = [
        F.get(choice, F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(NAMING) + len(vocabulary))).cast("int"))
        for k in range(4)
    ]
    parts = F.slice(F.array(*drawn), 1, (2 + F.pmod(F.xxhash64("id", F.lit(9)), F.lit(3))).cast("int"))
    upper, title = F.transform(parts, F.upper), F.transform(parts, F.initcap)
    number = F.pmod(F.xxhash64("id", F.lit(10)), F.lit(1000)).cast("string")
    lower = F.array_join(parts, "_")
    styles = [
        F.array_join(title, ""), F.concat(F.get(parts, F.lit(0)), F.array_join(F.slice(title, 2, 3), "")),
        lower, F.array_join(upper, "_"), F.array_join(parts, "-"), F.array_join(parts, "/"),
        F.array_join(title, "/"), F.concat(lower, F.lit("_"), number), F.concat(F.array_join(parts, "-"), F.lit("-"), number),
        F.concat(F.lit("/"), F.array_join(parts, "/"), F.lit("/")), F.concat(F.array_join(title, ""), number),
        F.concat(F.lit("__"), lower, F.lit("__")),
    ]
    style = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(len(styles))).cast("int")
    names = spark.range(IDENTIFIERS).select(F.get(F.array(*styles), style).alias("token"))
    moment = F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(2_000_000_000)))
    shapes = ["yyyy-MM-dd", "yyyy-MM-dd-HH-mm-ss", "yyyyMMdd", "yyyy_MM_dd", "yyyy/MM/dd", "HH-mm-ss", "yyyyMMddHHmmss"]
    shape = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(len(shapes))).cast("int")
    dated = F.get(F.array(*[F.date_format(moment, x) for x in shapes]), shape)
    times = spark.range(IDENTIFIERS // 4).select(F.concat_ws("-", dated, drawn[0]).alias("token"))
    return names.unionByName(times)


def _ratio(token: Column, ratios: list[float]) -> Column:
    """Sum of the pair ratios of a token whose characters are all symbols."""
    size = len(SYMBOLS)
    codes = [size + 1] * 128
    for k, c in enumerate(SYMBOLS):
        codes[ord(c)] = k
    code_of, table = F.lit(codes), F.lit(ratios)
    chars = F.transform(F.split(token, ""), lambda c: F.get(code_of, F.ascii(c)))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        chars,
        start,
        lambda a, c: F.struct(
            c.alias("last"),
            (
                a["sum"]
                + F.when(a["last"] < 0, F.lit(0.0)).otherwise(F.get(table, a["last"] * size + c))
            ).alias("sum"),
        ),
    )["sum"]


def scan(docs: DataFrame, ratios: list[float] | None) -> DataFrame:
    """Base spans and ``_spans``: base spans and those the model adds, by start and kind."""
    rows = base_spans(docs)
    if ratios is None:
        return rows.withColumn("_spans", F.col("_base"))
    text = F.col("_text")
    rows = rows.withColumn("_token", _matches(text, CANDIDATE))
    rows = rows.withColumn("_place", _places(text, CANDIDATE, F.col("_token")))
    scored = F.transform(
        F.arrays_zip(F.col("_place").alias("p"), F.col("_token").alias("t")),
        lambda z: F.struct(z["p"].alias("p"), F.length(z["t"]).alias("n"), _ratio(z["t"], ratios).alias("r")),
    )
    rows = rows.withColumn("_scored", scored)
    likely = F.filter("_scored", lambda z: (z["r"] >= LEAST_RATIO) & (z["r"] >= LEAST_MEAN * z["n"]))
    kept = _apart(F.transform(likely, lambda z: z["p"]), F.col("_base"))
    added = _spans(3, kept)
    return rows.withColumn("_spans", F.array_sort(F.concat("_base", added))).drop(
        "_token", "_place", "_scored"
    )


def _apart(places: Column, base: Column) -> Column:
    """The places (which do not overlap one another) that touch no span of ``base``.

    Both are sorted by start; a place is kept when the base spans before it end before it,
    and those behind it start behind its end.
    """
    far = (1 << 31) - 1

    def item(start: Column, token: int, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(token).alias("token"), end.alias("end"))

    items = F.array_sort(
        F.concat(
            F.transform(base, lambda b: item(b["start"], 0, b["end"])),
            F.transform(places, lambda p: item(p["start"], 1, p["end"])),
        )
    )

    def free(items: Column) -> Column:
        ends = F.transform(items, lambda x: F.when(x["token"] == 0, x["end"]).otherwise(0))
        starts = F.transform(F.reverse(items), lambda x: F.when(x["token"] == 0, -x["start"]).otherwise(-far))
        around = F.struct(
            _running(ends, 0, larger).alias("before"),
            F.reverse(_running(starts, -far, larger)).alias("behind"),
        )
        kept = _let(around, lambda r: F.filter(
            items,
            lambda x, i: (x["token"] == 1) & (F.get(r["before"], i) <= x["start"]) & (-F.get(r["behind"], i) >= x["end"]),
        ))
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    return _let(items, free)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.lit(list(KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the patterns, hash of their spans, all spans."""
    found = scan(docs.select("doc_id", "text"), train(docs.select("doc_id", "text")))
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.col("_spans")).alias("spans"),
        (F.size("_spans") - F.size("_base")).cast("long").alias("n_markov"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span replaced by ``mark``; null texts stay null.

    Overlapping spans share one mark. ``n_chars``, where present, is counted anew.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), "text")
    found = scan(rows, train(docs.select("doc_id", "text")))
    def cut(wide: Column, gap: Column) -> Column:
        # Four bytes a character: a cut does not count its way through the text. A letter in
        # front keeps the decoder from taking a first U+FEFF for a byte order mark.
        size = gap["end"] - gap["start"]
        part = F.concat(F.lit(b"\0\0\0x"), F.substring(wide, 4 * gap["start"] + 1, 4 * size))
        return F.substring(F.decode(part, "UTF-32"), F.lit(2), size)

    end = F.length("_text")
    close = F.struct(end.alias("start"), F.lit(len(KINDS)).alias("rank"), end.alias("end"))

    def between(spans: Column) -> Column:
        """The stretches before, between and behind spans; spans that overlap have none."""
        ends = _running(F.transform(spans, lambda s: s["end"]), 0, larger)
        gaps = _let(ends, lambda e: F.transform(spans, lambda s, k: F.struct(
            F.coalesce(F.get(e, k - 1), F.lit(0)).alias("start"), s["start"].alias("end")
        )))
        return F.filter(gaps, lambda g: g["start"] <= g["end"])

    gaps = _let(F.concat("_spans", F.array(close)), between)
    wide = F.encode(F.col("_text"), "UTF-32")
    pieces = _let(wide, lambda w: F.transform(gaps, lambda g: cut(w, g)))
    found = found.withColumn(
        "_clean", F.when(F.size("_spans") > 0, F.array_join(pieces, mark)).otherwise(F.col("text"))
    )
    new = {"text": F.col("_clean")}
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.size("_spans") > 0, F.length("_clean").cast(kind)).otherwise(
            F.col("_row.n_chars")
        )
    return found.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns])
