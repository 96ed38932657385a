"""Quality rules and quality ranking."""

import math
import random
import re
import zlib

import numpy as np

from factview.llm import quality_rank, quality_rules


def plain_counts(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    windows = {}
    for k in range(len(w) - 4):
        windows.setdefault(tuple(w[k : k + 5]), []).append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 10 or 100 * len(covered) > 20 * len(w),
    }


def plain_classes(text):
    some = [len(re.findall(f"[{c}]", text)) for c in quality_rules.CHARACTER_CLASSES.values()]
    words = len(re.sub(r"[\x20\x09-\x0D]", "", text))
    return [len(text) - words, *some, words - sum(some)]


def good_text(rng, n=120):
    return " ".join(rng.choice(["the", "of", "and", "to", "in", "is"]) if rng.random() < 0.4 else "".join(rng.choice("abcdefghilmnoprstu") for _ in range(6)) for _ in range(n)).capitalize() + "."


def documents():
    rng = random.Random(4)
    docs = [(k, good_text(rng, rng.randint(40, 300)), "en") for k in range(80)]
    docs += [(100, None, "en"), (101, "", None), (102, "\n \n", "xx"), (103, "too short a text", "en"), (104, "a b c d e\n" * 30, "en"), (105, "x y z", None)]
    docs += [(106, " ".join(f"{c * 3}#$%" for c in "abcdefghij" * 12), "en"), (107, good_text(rng).upper().replace(" ", "!! "), "en")]
    docs += [(108, good_text(rng, 20_000), "en"), (0, docs[0][1], "en"), (109, "one two three four five six one two three four five six seven eight", "de"), (110, good_text(rng), None), (None, good_text(rng), "en")]
    docs += [(111, "a b a b a b a b a b a b a b", "fr"), (112, "ä b ünï 😀 " * 3 + "Ende der die und in den von zu das mit", "de"), (113, "line one here\n\nline one here\n \nline two here\nline one here", "en")]
    return docs


def js(p, q):
    p, q = np.array(p, float) / sum(p), np.array(q, float) / sum(q)
    m = (p + q) / 2
    half = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return math.sqrt(max(0, (half(p) + half(q)) / 2))


def test_counts_and_distances(spark):
    docs = documents()
    frame = spark.createDataFrame([(*d, "x", True) for d in docs], "doc_id long, text string, lang string, source string, kept boolean")
    out = quality_rules.judge(frame)
    rows = out.collect()
    assert len(rows) == len(docs) and set(frame.columns) <= set(out.columns)
    sums = quality_rules.references(quality_rules.counted(frame.drop("source", "kept"))).collect()
    found = {r["_lang"]: (r["_r_classes"], r["_r_common"]) for r in sums}
    for r in rows:
        want = plain_counts(r["text"])
        assert {k: r[k] for k in want} == want, r["doc_id"]
        if r["lang"] == "en" and r["n_words"] >= quality_rules.MIN_WORDS:
            listed = [sum(w.lower() == x for w in re.split(r"[\x20\x09-\x0D]+", r["text"])) for x in quality_rules.COMMON_WORDS["en"]]
            assert abs(r["js_words"] - js([*listed, r["n_words"] - sum(listed)], found["en"][1])) < 1e-8
        lang = r["lang"] if r["lang"] in quality_rules.COMMON_WORDS else "other"
        near = True
        if r["n_words"] >= quality_rules.MIN_WORDS:
            distance = js(plain_classes(r["text"]), found[lang][0])
            assert abs(r["js_characters"] - distance) < 1e-8
            root = math.sqrt(r["n_words"])
            near = distance <= 0.14 + 1.0 / root and r["js_words"] <= 0.115 + 1.2 / root
        assert r["kept"] == (not want["base_failed"] and near)
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert set(range(80)) <= kept and {108, 110, None} <= kept
    assert not kept & {100, 101, 102, 103, 104, 105, 106, 107, 111}


def test_rules_without_rows_or_language(spark):
    assert quality_rules.judge(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    one = spark.createDataFrame([(1, "a text without any language column that has more than ten words in it")], "doc_id long, text string")
    assert quality_rules.judge(one).first()["kept"]


def labelled(spark, n=300):
    rng = random.Random(9)
    docs, labels = [], []
    for k in range(n):
        bad = k % 3 == 0
        text = good_text(rng, rng.randint(20, 100))
        if bad:
            text = rng.choice([text.upper(), text.replace(" ", "### "), " ".join([text.split()[0]] * 80), text.replace(" ", " | ")])
        docs.append((k, text, "x"))
        labels.append((k, int(not bad), 0))
    docs += [(n, None, "x"), (n + 1, "", "x"), (None, "no id here", "x")]
    labels += [(n + 1, 7, 0), (None, 1, 0), (5, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_ranking_holds_out_and_tells_good_from_bad(spark):
    docs, labels = labelled(spark)
    ranking = quality_rank.train(docs, labels)
    rows = quality_rank.scored(docs, ranking).collect()
    assert len(rows) == 303
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(key.encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert len(held) > 40 and np.mean([r["predicted"] == int(r["doc_id"] % 3 != 0) for r in held]) > 0.95
    # What is held out cannot change the ranking.
    flipped = labels.selectExpr("doc_id", "IF(crc32(string(doc_id)) % 4 = 2, 1 - quality, quality) AS quality", "toxic")
    assert np.array_equal(quality_rank.train(docs, flipped).weights, ranking.weights)


def test_ranking_without_a_class(spark):
    docs, labels = labelled(spark, 30)
    for some in (labels.where("false"), labels.where("quality = 1")):
        ranking = quality_rank.train(docs, some)
        assert quality_rank.scored(docs, ranking).where("score IS NULL").count() == 0
    assert quality_rank.scored(docs.where("false"), ranking).count() == 0
    assert all(0 <= x <= 1 for t in ("", "a", "#" * 50, "😀 " * 3) for x in quality_rank.features(t))


def test_pairs_teach_the_order():
    rng = np.random.default_rng(0)
    rows = rng.random((400, len(quality_rank.features(""))))
    good = rows[:, 1] + 0.05 * rng.standard_normal(400) < 0.6
    ranking = quality_rank.fit(rows, good)
    score = ranking.score(rows)
    assert (score[good][:, None] > score[~good][None, :]).mean() > 0.97
    assert abs((score < quality_rank.PARTING).mean() - (~good).mean()) < 0.02


def test_every_labelled_row_is_learned_from(spark):
    """Rows labelled bad only where a sample of 20,000 by the digest of doc_id would not reach."""
    ids = spark.range(28_000).selectExpr("id AS doc_id", "row_number() OVER (ORDER BY xxhash64(id)) AS place", "crc32(string(id)) % 4 = 2 AS held")
    learned = ids.where("NOT held").selectExpr("doc_id", "held", "row_number() OVER (ORDER BY place) > 20000 AS bad")
    docs = learned.selectExpr("doc_id", "concat(IF(bad, 'WORDS OF UPPER CASE ', 'words of lower case '), doc_id) AS text").repartition(5).cache()
    labels = learned.selectExpr("doc_id", "IF(bad, 0, 1) AS quality")
    assert 500 < learned.where("bad").count() < 2000
    wrong = quality_rank.scored(docs, quality_rank.train(docs, labels)).where("predicted = CAST(text LIKE 'WORDS%' AS INT)")
    assert wrong.count() == 0
    docs.unpersist()


def test_all_pairs_count():
    """The gradient over every pair vanishes at the weights."""
    rng = np.random.default_rng(1)
    rows = rng.random((300, len(quality_rank.features(""))))
    good = rows[:, 1] + 0.3 * rng.standard_normal(300) < 0.7
    ranking = quality_rank.fit(rows, good)
    x = ranking.standard(rows)
    gap = x[good][:, None, :] - x[~good][None, :, :]
    doubt = 1 / (1 + np.exp(gap @ ranking.weights))
    gradient = (gap * doubt[:, :, None]).mean(axis=(0, 1)) - 1e-3 * ranking.weights
    assert np.abs(gradient).max() < 1e-3
    # In two parts the sums are the same.
    parts = [(rows[:130], good[:130]), (rows[130:], good[130:])]
    again = quality_rank.learned(lambda size, tally: sum(tally(*p) for p in parts))
    assert np.allclose(again.weights, ranking.weights, atol=1e-6) and abs(again.parting - ranking.parting) < 1e-5
