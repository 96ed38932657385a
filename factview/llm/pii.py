"""Personal data by weak supervision.

Spans of exact patterns always stay. Looser candidates are voted on by
labelers (pattern, gazetteer, context, surroundings); expectation-maximisation
over the votes of all documents estimates how far each labeler can be trusted.
Its posteriors train a logistic span classifier on features of the spans (kind,
length, share of digits, separators, words and characters around), which
decides.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factview.llm.common import packed, stored, text_of, unpacked
from factview.llm.spans import apart, located, written
from factview.llm.weak_labels import classifier, posteriors

#: Exact patterns. Possessive runs and the place where a run may begin keep them linear; they match what
#: the plain forms match from left to right.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # Runs of fewer digits cannot be cards; no other run begins within one.
    "card": r"(?<![0-9])[0-9](?:[\x20\-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
#: Looser candidates, each of a kind of its own.
LOOSE = {
    "email_written": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{2,}+\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9\-]{2,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,10})++",
    "phone_local": r"(?<![0-9+.\-])\(?[0-9]{3}\)?[\x20.\-][0-9]{3}[\x20.\-][0-9]{4}(?![0-9.\-])",
    "national_id": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
KINDS = [*BASE, *LOOSE]
#: Characters before a span in which context words are looked for.
CONTEXT = 48
# Words that speak for and against personal data close before a span.
WORDS_FOR = ["address", "call", "card", "contact", "email", "fax", "iban", "mail", "mobile", "person", "phone", "ssn", "tel", "write"]
WORDS_AGAINST = ["build", "chapter", "figure", "isbn", "item", "order", "page", "part", "release", "section", "serial", "table", "version"]
# Endings of names of hosts, and the first letters of account numbers, that are in use.
HOST_ENDINGS = ["com", "de", "edu", "es", "eu", "fr", "gov", "info", "io", "net", "org", "uk"]
ACCOUNT_COUNTRIES = ["AT", "BE", "CH", "DE", "ES", "FR", "GB", "IE", "IT", "LU", "NL", "PL", "PT", "SE"]
LABELERS = ("pattern", "gazetteer", "context", "surroundings")
#: Log-odds from which a looser candidate is accepted.
ODDS = 0.0


def luhn(digits: Column) -> Column:
    """For up to 19 digits, which are what is asked."""
    def step(held: Column, k: Column) -> Column:
        d = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return held + F.when(k % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def holds(kind: str, value: Column) -> Column:
    """Whether a match of an exact pattern is one."""
    if kind == "ip":
        part = r"0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _gazetteer(kind: str, value: Column) -> Column:
    """1 for what the lists know, -1 for what they exclude, else 0."""
    if kind.startswith("email"):
        return F.when(F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1)).isin(*HOST_ENDINGS), 1).otherwise(0)
    if kind == "ip":
        return F.when(value.rlike(r"^0*(?:0|127|2[3-5][0-9])\."), -1).otherwise(0)
    if kind == "card":
        return F.when(value.rlike(r"^[2-6]"), 1).otherwise(-1)
    if kind == "iban":
        return F.when(F.substring(value, 1, 2).isin(*ACCOUNT_COUNTRIES), 1).otherwise(-1)
    if kind == "national_id":
        return F.when(value.rlike(r"^(?:000|666|9)|-00-|-0000$"), -1).otherwise(0)
    return F.when(value.rlike(r"^\(?[01]"), -1).otherwise(0)


#: Features of a span and the number of classes of each.
FEATURES = {"kind": len(KINDS), "length": 4, "digits": 4, "separators": 3, "words": 3, "begin": 3, "end": 3, "known": 3}


def _signals(kind: str, span: Column) -> Column:
    """The labelers' votes (1 for, -1 against, 0 none) and the classes of the span's features."""
    value, before = span["value"], F.lower(span["before"])
    words = F.when(before.rlike(rf"\b(?:{'|'.join(WORDS_FOR)})"), 1).when(before.rlike(rf"\b(?:{'|'.join(WORDS_AGAINST)})"), -1).otherwise(0)
    begin = F.when(before.rlike(r"[\s(:\[,;]$"), 1).when(before == "", 0).otherwise(-1)
    end = F.when(span["after"].rlike(r"[\s).,;:!?\]]"), 1).when(span["after"] == "", 0).otherwise(-1)
    around = F.when((begin < 0) | (end < 0), -1).when((begin > 0) & (end > 0), 1).otherwise(0)
    known, digits = _gazetteer(kind, value), F.length(_digits(value))
    votes = F.array(F.lit(1 if kind in BASE else 0), known, words, around)
    size = F.when(F.length(value) < 12, 0).when(F.length(value) < 16, 1).when(F.length(value) < 24, 2).otherwise(3)
    separators = F.least(F.size(F.split(value, r"[\x20.()\-]+")) - 1, F.lit(4))
    classes = [F.lit(KINDS.index(kind)), size, F.least((4 * digits / F.length(value)).cast("int"), F.lit(3)), ((separators + 1) / 2).cast("int"), words + 1, begin + 1, end + 1, known + 1]
    return F.struct(votes.alias("votes"), F.array(*classes).alias("classes"))


def _held(kind: str, span: Column) -> Column:
    return holds(kind, span["value"])


def _judged(kind: str, span: Column) -> Column:
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), _signals(kind, span).alias("signals"))


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` without its text but with a column of (start, end, signals) for each of KINDS.

    The one pass over the texts; no row moves.
    """
    rows = located(docs.withColumn("_text", text_of()), "_text", {f"_{k}": p for k, p in (BASE | LOOSE).items()}, CONTEXT)
    rows = rows.withColumns({f"_{k}": F.filter(f"_{k}", partial(_held, k)) for k in BASE})
    rows = apart(rows, [f"_{k}" for k in LOOSE], [f"_{k}" for k in BASE])
    return rows.withColumns({f"_{k}": F.transform(f"_{k}", partial(_judged, k)) for k in KINDS}).drop("_text", "text")


def trained(rows: DataFrame) -> list[list[float]]:
    """The span classifier's weights; counts of patterns, bounded by votes and classes, reach the driver."""
    found = rows.select(F.explode(F.flatten(F.array(*[F.transform(f"_{k}", lambda x: x["signals"]) for k in KINDS]))).alias("s"))
    counts = [(tuple(r["s"]["votes"]), tuple(r["s"]["classes"]), float(r["n"])) for r in found.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()]
    votes: dict[tuple[int, ...], float] = {}
    for v, _, n in sorted(counts):
        votes[v] = votes.get(v, 0.0) + n
    real = posteriors(votes)
    return classifier([(c, n, real[v]) for v, c, n in counts], list(FEATURES.values()))


def detect(docs: DataFrame) -> DataFrame:
    """``docs``, without ``text``, with n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and n_found.

    Offsets count code points, ends are exclusive. ``spans`` lists the exact
    spans and the accepted looser ones (kinds as in KINDS, then by start), of
    which there are ``n_found``. A null text counts as empty: no spans, and the
    digest of the empty text. Equally named columns are replaced; an empty
    table gives no rows. Only counts of patterns of votes and features reach
    the driver.
    """
    added = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_found"]
    rows = stored(spans(packed(docs, "text")))
    weights = trained(rows)

    def accepted(x: Column) -> Column:
        classes = x["signals"]["classes"]
        return sum((F.get(F.array(*map(F.lit, w)), F.get(classes, F.lit(k))) for k, w in enumerate(weights)), F.lit(0.0)) >= ODDS

    rows = rows.withColumns({f"_{k}": F.filter(f"_{k}", accepted) for k in LOOSE})
    base = F.concat(*[written(k, F.col(f"_{k}")) for k in BASE])
    more = F.concat(*[written(k, F.col(f"_{k}")) for k in LOOSE])
    rows = rows.withColumns(
        {
            **{f"n_{k}": F.size(f"_{k}").cast("bigint") for k in BASE},
            "base_sha256": F.sha2(F.array_join(base, ",").cast("binary"), 256),
            "spans": F.array_join(F.concat(base, more), ","),
            "n_added": F.size(more).cast("bigint"),
            "n_found": F.size(F.concat(base, more)).cast("bigint"),
        }
    )
    return unpacked(rows, [c for c in docs.columns if c != "text"], (), added)
