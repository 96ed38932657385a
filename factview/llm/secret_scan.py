"""Secrets by exact patterns and by character Markov models.

Two first-order character models, of random strings and of ordinary words and
identifiers, are trained from labelled samples and from the words of all
documents; a token whose log-likelihood ratio, summed over its characters,
favours the random model is a secret, too. The sum allows for a token's
length: a short one must look random at every character.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factview.llm.common import packed, text_of, unpacked
from factview.llm.spans import apart, located

#: Exact patterns; see ``holds`` for what else a match must meet.
BASE = {
    # Letters in either case; the look ahead is a quick test of the first two.
    "assign": (
        r"(?=[aApPsStT][aAeEoOpP])(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"""["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=\-]+"""
    ),
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"[0-9a-f]{16,}+",
}
#: Tokens that the models judge: runs of so many or more of these characters.
LEAST = 12
TOKEN = rf"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{{{LEAST},}}+"
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)$"""
#: Log-likelihood ratio (nats, over the whole token) from which a token is random.
THRESHOLD = 14.0
#: Words of documents that teach the ordinary model: the longer ones, as only those are judged.
WORD = r"(?<![A-Za-z0-9+/_=\-])[A-Za-z][A-Za-z0-9_\-]{7,}+"
#: Tokens of documents that do not teach it: long ones with digits may be secrets themselves.
DOUBTFUL = r"^(?=.*[0-9]).{16,}$|^AKIA"
#: Labelled random strings, and labelled identifiers, made for training.
SAMPLE_STRINGS = 3_000
SAMPLE_IDENTIFIERS = 3_000
#: Share of the labelled identifiers in the ordinary model; the words of the documents have the rest.
IDENTIFIER_SHARE = 0.3
#: Characters of the models: U+0020 to U+007F.
FIRST, SIZE = 32, 96
# Parts that labelled identifiers are made of.
NAME_PARTS = ["app", "backup", "build", "cache", "client", "config", "data", "draft", "export", "image", "index", "item", "log", "model", "order", "page", "report", "server", "table", "user"]
SEPARATORS = ["", "-", "_", "/"]


def random_strings(spark: SparkSession, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Labelled random strings: digests written in hexadecimal, base 64, and letters with digits."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.base64(F.unhex(digest))
    kind = F.col("id") % 3
    letters = F.regexp_replace(base64, "[+/=]", "")
    return spark.range(n).select(F.when(kind == 0, F.substring(digest, 1, 40)).when(kind == 1, base64).otherwise(letters).alias("token"))


def identifiers(spark: SparkSession, n: int = SAMPLE_IDENTIFIERS) -> DataFrame:
    """Labelled ordinary identifiers with digits: dated, numbered and versioned names, and UUIDs."""
    digit = lambda salt, most: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(most)).cast("int")
    part = lambda salt: F.element_at(F.array(*map(F.lit, NAME_PARTS)), digit(salt, len(NAME_PARTS)) + 1)
    sep = F.element_at(F.array(*map(F.lit, SEPARATORS)), digit("s", len(SEPARATORS)) + 1)
    date = F.format_string("%04d%s%02d%s%02d", 1990 + digit("y", 40), sep, 1 + digit("m", 12), sep, 1 + digit("d", 28))
    digest = F.md5(F.col("id").cast("string"))
    uuid = F.concat_ws("-", *[F.substring(digest, a, k) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    kinds = [
        F.concat(part("a"), sep, part("b"), sep, date),
        F.concat(F.initcap(part("a")), F.initcap(part("b")), digit("k", 1000).cast("string")),
        F.concat(F.upper(part("a")), sep, F.format_string("%06d", digit("k", 1000000))),
        F.concat(part("a"), sep, F.lit("v"), digit("k", 20).cast("string"), sep, digit("l", 10).cast("string"), sep, part("b")),
        F.when(digit("u", 5) == 0, uuid).otherwise(F.concat(part("a"), sep, part("b"), sep, part("c"), digit("l", 10).cast("string"))),
    ]
    return spark.range(n).select(F.element_at(F.array(*kinds), (F.col("id") % len(kinds)).cast("int") + 1).alias("token"))


def ordinary_words(docs: DataFrame) -> DataFrame:
    """(token, n) of the words of all documents: counted before they are shuffled, so that frequent ones are rows of a task each."""
    found = docs.select(F.explode(F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))).alias("token"))
    return found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(~F.col("token").rlike(DOUBTFUL))


def bigrams(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of neighbouring characters of (token[, n]); at most SIZE squared rows reach the driver."""
    weight = F.col("n") if "n" in tokens.columns else F.lit(1)
    pairs = tokens.select(F.explode(F.regexp_extract_all("token", F.lit(r"(?=([\x20-\x7F]{2}))"), F.lit(1))).alias("xy"), weight.alias("n"))
    rows = pairs.groupBy("xy").agg(F.sum("n").alias("n")).collect()
    return {(ord(r["xy"][0]), ord(r["xy"][1])): r["n"] for r in rows}


Chance = Callable[[int, int], float]


def _model(counts: dict[tuple[int, int], int], alphabet: int, pseudo: float = 0.5, weight: float = 5.0) -> Chance:
    """P(y | x), smoothed towards the frequency of y alone, as a function of the pair."""
    after, single, total = {}, {}, sum(counts.values())
    for (x, y), n in counts.items():
        after[x] = after.get(x, 0) + n
        single[y] = single.get(y, 0) + n

    def chance(x: int, y: int) -> float:
        alone = (single.get(y, 0) + pseudo) / (total + pseudo * alphabet)
        return (counts.get((x, y), 0) + weight * alone) / (after.get(x, 0) + weight)

    return chance


def ratios(random: dict[tuple[int, int], int], words: dict[tuple[int, int], int], named: dict[tuple[int, int], int]) -> list[float]:
    """log P(y | x, random) - log P(y | x, ordinary) for each pair of characters, row by row."""
    codes = range(FIRST, FIRST + SIZE)
    seen = len({c for pair in (*random, *words, *named) for c in pair}) or 1
    one, two, three = (_model(x, seen) for x in (random, words, named))
    share = IDENTIFIER_SHARE if words else 1.0
    ordinary = lambda x, y: (1 - share) * two(x, y) + share * three(x, y)
    return [math.log(one(x, y) / ordinary(x, y)) for x in codes for y in codes]


def ratio(token: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token, in one walk over its characters."""
    values = F.split(F.lit(",".join(f"{x:.4f}" for x in table)), ",").cast("array<double>")

    def step(held: Column, c: Column) -> Column:
        code = F.ascii(c) - FIRST
        gain = F.when(held["last"] < 0, F.lit(0.0)).otherwise(F.get(values, held["last"] * SIZE + code))
        return F.struct((held["sum"] + gain).alias("sum"), code.alias("last"))

    return F.aggregate(F.split(token, ""), F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last")), step)["sum"]


def holds(kind: str, value: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(value, VALUE, 1)) >= 12
    return F.length(value) >= {"access": 18, "hex": 16}[kind]


def _held(kind: str, span: Column) -> Column:
    return holds(kind, span["value"])


def _named(order: int, kind: str, span: Column) -> Column:
    return F.struct(span["start"].alias("s"), F.lit(order).alias("o"), F.lit(kind).alias("k"), span["end"].alias("e"))


def train(docs: DataFrame) -> list[float]:
    spark = docs.sparkSession
    return ratios(bigrams(random_strings(spark)), bigrams(ordinary_words(docs)), bigrams(identifiers(spark)))


def scan(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """``docs``, without ``text``, with n_assign, n_access, n_hex, base_sha256, spans, n_random and n_found.

    Offsets count code points, ends are exclusive. ``spans`` lists by start,
    then kind, the exact spans and those of kind ``random`` that the models
    add (never over an exact one); ``n_found`` counts them all. The models
    judge runs of 12 or more ASCII letters, digits and ``+/_=-`` with a letter
    in them; anything else is not judged. A null text counts as empty: no spans and the digest
    of the empty text. Two passes over the texts, of which the first counts
    words; only counts of pairs of characters reach the driver. Equally named
    columns are replaced; an empty table gives no rows.
    """
    added = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random", "n_found"]
    table = train(docs) if table is None else table
    rows = packed(docs, "text").withColumn("_text", text_of())
    # Where the tokens are matters only in texts that have a random one.
    random = lambda token: token.rlike("[A-Za-z]") & (ratio(token, table) >= THRESHOLD)
    suspect = F.exists(F.regexp_extract_all("_text", F.lit(TOKEN), F.lit(0)), random)
    rows = rows.withColumn("_suspect", F.when(suspect, F.col("_text")).otherwise(""))
    rows = located(located(rows, "_text", {f"_{k}": p for k, p in BASE.items()}), "_suspect", {"_random": TOKEN})
    likely = F.filter("_random", lambda x: random(x["value"]))
    rows = rows.withColumns({f"_{k}": F.filter(f"_{k}", partial(_held, k)) for k in BASE} | {"_random": likely})
    rows = apart(rows, ["_random"], [f"_{k}" for k in BASE])

    def listed(kinds: list[str]) -> Column:
        parts = [F.transform(f"_{k}", partial(_named, o, k)) for o, k in enumerate(kinds)]
        ordered = F.array_sort(F.concat(*parts))
        return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")

    kinds = [*BASE, "random"]
    rows = rows.withColumns(
        {
            **{f"n_{k}": F.size(f"_{k}").cast("bigint") for k in kinds},
            "base_sha256": F.sha2(listed(list(BASE)).cast("binary"), 256),
            "spans": listed(kinds),
        }
    ).withColumn("n_found", sum((F.col(f"n_{k}") for k in kinds), F.lit(0).cast("bigint")))
    return unpacked(rows, [c for c in docs.columns if c != "text"], (), added)
