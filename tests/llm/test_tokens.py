"""Token counts and byte-level encoding against the libraries' whole encodings."""

import hashlib
import random
import struct
import time

import public_tokenizers
import pytest
import regex

from factview.llm import byte_bpe, sharding, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def texts():
    rng = random.Random(11)
    bits = ["the", " ", "  ", "\n", "\t", "don't", "1234", "é", "😀", "▁", "über", "....", "\x00", "x" * 40, "   \n", "<s>", "中文字"]
    out = ["", " ", "a", "▁▁ a", "\n\n", "a" * 3000, " " * 3000, "中" * 2000, "word " * 900, " lead and trail "]
    return out + ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 900))) for _ in range(60)]


def test_resynchronised_chunks_equal_the_whole():
    own = token_counts.model(PIECES)
    for text in texts():
        whole = own.encode(text)
        for chunk, overlap in ((50, 5), (200, 20), (1000, 300)):
            assert token_counts.encode(text, PIECES, chunk, overlap, huge=60) == whole, text[:50]
    assert token_counts.counts(texts(), PIECES) == [len(own.encode(t)) for t in texts()]
    assert token_counts.splits_at_spaces(PIECES)


def test_counts_of_rows(spark):
    rows = [(k, t, 5) for k, t in enumerate(texts())] + [(None, None, 5), (0, "", 5), (900, "word " * 60_000, 5)]
    out = token_counts.with_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), PIECES).collect()
    own = token_counts.model(PIECES)
    assert len(out) == len(rows)
    want = sorted((len((t or "").encode()), len(own.encode(t or ""))) for _, t, _ in rows)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in out)


def test_parts_encode_as_the_whole():
    own = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for text in texts():
        whole = own.encode_ordinary(text)
        for most in (1, 10, 300):
            pieces = list(byte_bpe.parts(text, most))
            assert "".join(pieces) == text
            assert [i for p in pieces for i in own.encode_ordinary(p)] == whole, text[:50]
        single = [i for m in regex.finditer(public_tokenizers.PATTERN, text) for i in own._encode_single_piece(m[0].encode())]
        assert single == whole
        assert byte_bpe.decode(whole, RANKS, public_tokenizers.PATTERN) == text.encode()


@pytest.mark.parametrize("text", ["a" * 700_000, " " * 700_000, "ab1 " * 200_000, "\n" * 100_000 + "x"])
def test_very_long_texts_take_linear_time(text):
    began = time.time()
    ids = byte_bpe.encode(text, RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN) == text.encode()
    assert time.time() - began < 20


def test_digests_of_rows(spark):
    rows = [(k, t, "own") for k, t in enumerate(texts())] + [(None, None, "own"), (1, " ", "own")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    own = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    out = byte_bpe.with_tokens(frame, RANKS, public_tokenizers.PATTERN).collect()
    assert len(out) == len(rows)
    for r in out:
        want = own.encode_ordinary(r["text"] or "")
        assert list(r["ids"]) == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    short = byte_bpe.with_tokens(frame.where("false"), RANKS, public_tokenizers.PATTERN, ids=False)
    assert short.count() == 0 and "ids" in short.columns  # the column of the input


def plain_table(names, size):
    """Every shard's whole order of preference, then one claim after another."""
    digest = lambda name, salt: int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)
    order = [[(digest(n, "offset") % size + j * (digest(n, "skip") % (size - 1) + 1)) % size for j in range(size)] for n in names]
    owner, turn = {}, 0
    while len(owner) < size:
        k = turn % len(names)
        slot = next(s for s in order[k] if s not in owner)
        owner[slot] = k
        turn += 1
    return [owner[s] for s in range(size)]


def test_lookup_table():
    names = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(names, 211)
    assert table == plain_table(names, 211)
    counts = [table.count(k) for k in range(7)]
    assert max(counts) - min(counts) <= 1
    more = sharding.lookup_table([*names, "s7"], 211)
    moved = sum(a != b for a, b in zip(table, more, strict=True))
    assert moved < 211 * 2.5 / 8  # an eighth must move, little else does
    for bad in ([], ["a", "a"], names):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 210)


def test_placement(spark):
    frame = spark.createDataFrame([(k, "src0", 9) for k in range(20_000)] + [(None, "src0", 9)] * 3, "doc_id long, source string, shard int")
    out = sharding.place(frame, frame["doc_id"], [f"s{k}" for k in range(8)], 2039)
    rows = out.collect()
    assert len(rows) == 20_003 and len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    table = sharding.lookup_table([f"s{k}" for k in range(8)], 2039)
    for r in rows[:200]:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == table[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 2039]
    shares = [sum(r["shard"] == k for r in rows) for k in range(8)]
    assert max(shares) < 1.15 * min(shares)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert sharding.place(frame.where("false"), frame["doc_id"]).count() == 0


def test_long_texts_of_a_batch_go_through_chunks(monkeypatch):
    """Texts above the switch are spliced, also among others in one call; the longest of the tables are five times as long."""
    rng, spliced = random.Random(6), []
    own = token_counts._common
    monkeypatch.setattr(token_counts, "_common", lambda *a: spliced.append(1) or own(*a))
    texts = [" ".join("".join(rng.choice("abcdefghij 	é") for _ in range(rng.randint(1, 12))) for _ in range(n)) for n in (10, 6000, 0, 40, 9000)]
    whole = [len(x) for x in token_counts.model(PIECES).encode(texts)]
    assert sum(len(t) > token_counts.HUGE for t in texts) == 2
    assert token_counts.counts(texts, PIECES) == whole and len(spliced) >= 2
