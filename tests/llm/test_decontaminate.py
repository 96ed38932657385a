"""Decontamination against all windows of all documents."""

import random
import re

import pytest

from factview.llm import decontaminate


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def grams(w):
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else [])


def plain(docs, bench, percent=75):
    """{(doc_id, item_id): best weighted similarity} over every window of an item's size."""
    sets, share = {}, {}
    for item, text in bench:
        w = tokens(text)
        if w:
            sets[item] = (len(w), set(grams(w)))
            for g in set(grams(w)):
                share[g] = share.get(g, 0) + 1
    out = {}
    for doc, text in docs:
        w = grams(tokens(text))
        for item, (n, g) in sets.items():
            if not g & set(w):
                continue
            for s in range(max(1, len(w) - max(n - 5, 0))):
                v = set(w[s : s + max(n - 4, 1)])
                both = sum(1 / share[x] for x in v & g)
                union = sum(1 / share[x] for x in g) + len(v - g)
                if both / union >= percent / 100 - 1e-9:
                    out[doc, item] = max(out.get((doc, item), 0), both / union)
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "the", "or", "in", "st", "re", "ö", "ou"]) for _ in range(rng.randint(1, 4)))
    some = lambda n: [word() for _ in range(n)]
    bench = [(k, " ".join(some(rng.randint(12, 60)))) for k in range(25)]
    bench += [(None, " ".join(some(30))), (25, "too short"), (26, None), (27, ""), (28, bench[3][1]), (29, bench[4][1] + " and a little more of it")]
    docs = []
    for k in range(240):
        w = some(rng.randint(20, 300))
        if k % 3 == 0:
            passage = tokens(rng.choice(bench[:25])[1])
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                passage[rng.randrange(len(passage))] = word()
            if k % 2:
                passage = [x.upper() for x in passage]
            at = rng.randrange(len(w))
            w[at:at] = passage
        docs.append((k, (" ", "\n", "\t ")[k % 3].join(w)))
    docs += [(240, None), (241, ""), (242, bench[0][1]), (242, bench[0][1]), (243, " ".join(tokens(bench[1][1])[:30])), (244, "Too\nshort"), (246, "this is too short to matter"), (247, bench[25][1])]
    docs += [(245, " ".join(some(3000) + tokens(bench[2][1]) + some(20)))]
    return docs, bench


def test_same_as_all_windows(spark, data):
    docs, bench = data
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = decontaminate.matches(frame, spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    want = plain(docs, bench)
    assert len(rows) == len(got)
    assert got.keys() == want.keys()
    assert len(want) > 40
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_clean_keeps_everything_else(spark, data):
    docs, bench = data
    rows = [(d, t, "x", "y") for d, t in docs] + [(None, bench[0][1], "x", "y"), (None, "nothing of it", "x", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item_id string, h string")
    out = decontaminate.clean(frame, spark.createDataFrame(bench, "item_id long, text string"))
    assert out.columns == frame.columns
    bad = {d for d, _ in plain(docs, bench)}
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == sorted([(False, d) for d, _ in docs if d not in bad] + [(True, 0)])


def test_ids_of_text(spark, data):
    docs, bench = data
    frame = spark.createDataFrame([(f"d{d}", t) for d, t in docs[:60]], "doc_id string, text string")
    rows = decontaminate.matches(frame, spark.createDataFrame([(f"i{i}", t) for i, t in bench], "item_id string, text string")).collect()
    want = plain([(f"d{d}", t) for d, t in docs[:60]], [(f"i{i}", t) for i, t in bench])
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want.keys() != set()


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(docs, none).count() == 0
    assert decontaminate.clean(docs, none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.matches(docs.where("false"), some).count() == 0
