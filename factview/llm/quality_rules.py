"""Quality rules: counting rules and distance from a language's distributions.

A document's character-class histogram and its histogram of common words are
compared, by the Jensen-Shannon distance, to references of its language summed
over all documents. Texts under the length guards are not judged by distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factview.llm.common import NOT_SPACE, packed, stored, text_of, unpacked, words

# The common words that make up a language's word histogram.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "ein"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "con"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "est", "que"],
}
#: Classes of characters; what is in none of them nor white space counts as a letter.
CHARACTER_CLASSES = {"upper": r"A-Z", "digit": r"0-9", "point": r".,;:!?'\"()\-", "symbol": r"#*$%&|<>"}
#: Texts with fewer words are not judged by distance.
MIN_WORDS = 30
#: Allowed distance: the first figure plus the second over the root of the number of words (sampling noise).
MAX_CHARACTER_DISTANCE = (0.14, 1.0)
MAX_WORD_DISTANCE = (0.115, 1.2)
MIN_RULE_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Columns that ``judge`` adds.
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "js_characters", "js_words", "base_failed", "kept"]


def class_count(text: Column, members: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{members}]+", "")).cast("bigint")


def language() -> Column:
    return F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(F.lit("other"))


def ordered_windows(hashes: Column) -> Column:
    return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def repeated_starts(ordered: Column) -> Column:
    """In order, the starts of windows whose hash occurs twice or more; ``ordered`` must be a plain column."""
    at = F.transform(
        ordered,
        lambda x, k: F.when((F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]), x["i"]),
    )
    return F.array_sort(F.filter(at, lambda i: i.isNotNull()))


def covered_words(starts: Column) -> Column:
    """Words that windows at ``starts`` cover together."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("to"))
    step = lambda a, i: F.struct(
        (a["covered"] + i + WINDOW - F.greatest(a["to"], i)).alias("covered"), (i + WINDOW).alias("to")
    )
    return F.aggregate(starts, start, step)["covered"].cast("bigint")


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with the rules' counts and both histograms, ``_classes`` and ``_common`` (the rest last). The one pass over the texts."""
    lang = language() if "lang" in docs.columns else F.lit("other")
    rows = docs.withColumn("_text", text_of()).withColumns({"_words": words(F.col("_text")), "_lang": lang})
    w = F.col("_words")
    run = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    rows = rows.withColumns(
        {
            "n_words": F.size(w).cast("bigint"),
            "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
            **{f"_{k}": class_count(F.col("_text"), v) for k, v in CHARACTER_CLASSES.items()},
            # Words of the document's language that are listed, in a string to look through.
            "_listed": F.lower(F.array_join(F.filter(w, lambda x: F.lower(x).isin(*sorted({x for v in COMMON_WORDS.values() for x in v}))), "  ")),
            "_windows": F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), run)),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(NOT_SPACE)),
        }
    )
    listed = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    rows = rows.withColumns(
        {
            "_again": F.size(F.array_distinct("_windows")) < F.size("_windows"),
            "_named": F.transform(F.get(F.map_values(F.map_filter(listed, lambda k, v: k == F.col("_lang"))), F.lit(0)), _occurrences),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        }
    )
    rows = rows.withColumn("_ordered", F.when(F.col("_again"), ordered_windows(F.col("_windows"))))
    rows = rows.withColumn("_starts", repeated_starts(F.col("_ordered")))
    others = [f"_{k}" for k in CHARACTER_CLASSES]
    rows = rows.withColumns(
        {
            "n_symbols": F.col("_symbol"),
            "n_repeat_words": F.coalesce(covered_words(F.col("_starts")), F.lit(0).cast("bigint")),
            "_classes": F.array(F.length("_text") - F.col("word_chars"), *others, F.col("word_chars") - sum((F.col(c) for c in others), F.lit(0))),
            "_common": F.concat("_named", F.array(F.col("n_words") - F.aggregate("_named", F.lit(0).cast("bigint"), lambda a, x: a + x))),
        }
    )
    return rows.select(*docs.columns, "_lang", "_classes", "_common", *ADDED[:5])


def _occurrences(word: Column) -> Column:
    """How often a word occurs in the listed ones, which double spaces part."""
    enclosed = F.concat(F.lit(" "), F.col("_listed"), F.lit(" "))
    return ((F.length(enclosed) - F.length(F.replace(enclosed, F.concat(F.lit(" "), word, F.lit(" ")), F.lit("")))) / (F.length(word) + 2)).cast("bigint")


def references(rows: DataFrame) -> DataFrame:
    """(_lang, _r_classes, _r_common): summed histograms for each listed language and ``other``, over all counted rows above the guard.

    At most five rows, whatever the input.
    """
    n_classes, n_words = len(CHARACTER_CLASSES) + 2, max(map(len, COMMON_WORDS.values())) + 1
    sums = rows.where(F.col("n_words") >= MIN_WORDS).groupBy("_lang").agg(
        *[F.sum(F.get("_classes", F.lit(k))).alias(f"c{k}") for k in range(n_classes)],
        *[F.sum(F.get("_common", F.lit(k))).alias(f"w{k}") for k in range(n_words)],
    )
    named = F.when(F.col("w0").isNotNull(), F.array(*[f"w{k}" for k in range(n_words)]))
    return sums.select("_lang", F.array(*[f"c{k}" for k in range(n_classes)]).alias("_r_classes"), named.alias("_r_common"))


def js_distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance (base 2) of two columns of counts; 0 if either has no mass."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double")
    start = F.struct(F.lit(0.0).alias("sum"), total(F.col(counts)).alias("n"), total(F.col(reference)).alias("m"))

    def part(x: Column, mean: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(0.0)

    def step(held: Column, pair: Column) -> Column:
        p, q = pair["x"] / held["n"], pair["y"] / held["m"]
        return F.struct((held["sum"] + part(p, (p + q) / 2) + part(q, (p + q) / 2)).alias("sum"), held["n"].alias("n"), held["m"].alias("m"))

    pairs = F.zip_with(counts, reference, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    pairs = F.when((total(F.col(counts)) > 0) & (total(F.col(reference)) > 0), pairs)
    return F.coalesce(F.sqrt(F.greatest(F.aggregate(pairs, start, step)["sum"] / 2, F.lit(0.0))), F.lit(0.0))


def allowed(limit: tuple[float, float]) -> Column:
    return limit[0] + limit[1] / F.sqrt(F.greatest("n_words", F.lit(1)))


def verdicts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Counted rows with distances, ``base_failed`` and ``kept``; the references, at most five rows, are broadcast."""
    rows = rows.join(F.broadcast(found), "_lang", "left")
    long = F.col("n_words") >= MIN_WORDS
    rows = rows.withColumns(
        {
            "js_characters": F.round(F.when(long, js_distance("_classes", "_r_classes")).otherwise(0.0), 9),
            "js_words": F.round(F.when(long, js_distance("_common", "_r_common")).otherwise(0.0), 9),
            "base_failed": (F.col("n_words") < MIN_RULE_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        }
    )
    near = (F.col("js_characters") <= allowed(MAX_CHARACTER_DISTANCE)) & (F.col("js_words") <= allowed(MAX_WORD_DISTANCE))
    return rows.withColumn("kept", ~F.col("base_failed") & near).drop("_lang", "_classes", "_common", "_r_classes", "_r_common")


def judge(docs: DataFrame, texts: bool = True) -> DataFrame:
    """``docs``, without ``text`` unless ``texts``, with the columns ADDED; equally named columns of ``docs`` are replaced.

    Reads the documents once. Counts and histograms are written beside the
    columns that are passed on; references (a few sums) and verdicts come from
    there. A null text counts as empty and fails by its length; a null or
    unlisted ``lang`` is held against the documents of no listed language, by
    characters alone. Repeated rows get the same verdict each; an empty table
    gives no rows. Distances are rounded to nine digits.
    """
    needed = ("text", "lang")
    rows = counted(packed(docs, *needed))
    rows = stored(rows if texts else rows.drop("text"))
    return unpacked(verdicts(rows, references(rows)), [c for c in docs.columns if texts or c != "text"], needed, ADDED)
