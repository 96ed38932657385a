"""Token counts by a piece model, with overlap resynchronisation of huge texts.

A huge text is encoded in overlapping chunks with offsets. Two neighbouring
encodings are spliced at a boundary that both have in their overlap and that
is proven stable: it lies between a visible character and white space, and no
piece of the vocabulary continues across such a place (checked when the model
is loaded). Where the overlap holds no such boundary it is widened, at last to
both chunks as one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factview.llm.common import packed, slices, text_of, unpacked

#: Characters of a chunk, of the first overlap, and from which on a text is encoded in chunks.
CHUNK = 10_000
OVERLAP = 500
HUGE = 20_000
#: Characters encoded in one call, which bounds the memory of an Arrow batch's ids.
CALL = 500_000
#: The model's mark for a space; a text may also contain it.
SPACES = " ▁"


@functools.lru_cache(maxsize=4)
def model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=4)
def splits_at_spaces(path: str) -> bool:
    """Whether no piece has a space mark after a visible character."""
    own = model(path)
    return all(SPACES[1] not in own.id_to_piece(k).lstrip(SPACES[1]) for k in range(own.get_piece_size()))


def _spans(own: sentencepiece.SentencePieceProcessor, text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """(begin, id) of each piece; the library counts bytes, here they are characters of the whole text."""
    part = text[begin:end]
    data = np.frombuffer(part.encode(), dtype=np.uint8)
    characters = np.append(np.cumsum((data & 0xC0) != 0x80) - 1, len(part))
    return [(begin + int(characters[p.begin]), p.id) for p in own.encode(part, return_type="proto").pieces]


def _from(own: sentencepiece.SentencePieceProcessor, text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """The pieces from the text's begin or a stable place on, as they are within the whole.

    At a stable place a space stands; the space that the library puts before
    every text takes its part.
    """
    if not begin:
        return _spans(own, text, 0, end)
    if begin + 1 == end:
        return [(begin, own.piece_to_id(SPACES[1]))]
    found = _spans(own, text, begin + 1, end)
    return [(begin, found[0][1]), *found[1:]]


def _common(text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], low: int, high: int) -> int | None:
    """The last stable place after ``low`` and before ``high`` where both have a boundary."""
    here = {b for b, _ in left if low < b < high}
    there = {b for b, _ in right if low < b < high}
    found = [p for p in here & there if text[p] in SPACES and text[p - 1] not in SPACES]
    return max(found, default=None)


def encode(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, huge: int = HUGE) -> list[int]:
    """The ids that the model gives for the whole text."""
    own = model(path)
    if len(text) <= huge or not splits_at_spaces(path):
        return own.encode(text)
    begin, end = 0, min(chunk, len(text))
    done: list[int] = []
    held = _spans(own, text, begin, end)
    while end < len(text):
        further, wide, at = min(end + chunk, len(text)), overlap, None
        while at is None:
            low = max(begin, end - wide)
            if low == begin:  # the overlap is the whole chunk: both are encoded as one
                held, at = _from(own, text, begin, further), begin
                break
            following = _spans(own, text, low, further)
            at = _common(text, held, following, low, end)
            if at is not None:
                done += [x for b, x in held if b < at]
                held = [s for s in following if s[0] >= at]
                begin = at
            wide *= 2
        end = further
    return done + [x for _, x in held]


def counts(texts: list[str], path: str) -> list[int]:
    """Each text's number of ids: huge ones by chunks, one by one, the others together."""
    out = [len(encode(t, path)) if len(t) > HUGE else 0 for t in texts]
    short = [k for k, t in enumerate(texts) if len(t) <= HUGE]
    for a, b in slices([len(texts[k]) for k in short], CALL):
        for k, ids in zip(short[a:b], model(path).encode([texts[k] for k in short[a:b]], num_threads=1), strict=True):
            out[k] = len(ids)
    return out


def with_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``, row by row.

    A null text counts as empty: no bytes, no tokens. Equally named columns
    are replaced. The model's path must hold on every executor.
    """

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(counts(texts.tolist(), path), dtype="int64")

    text = text_of()
    rows = packed(docs, "text").withColumns({"n_bytes": F.octet_length(text).cast("bigint"), "n_tokens": run(text)})
    return unpacked(rows.withColumn("over_limit", F.col("n_tokens") > limit), docs.columns, ("text",), ("n_bytes", "n_tokens", "over_limit"))
