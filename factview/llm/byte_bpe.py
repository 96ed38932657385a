"""Byte-level BPE encoding and decoding with a local rank file.

Texts of any length are cut before a single space between two visible
characters: the split pattern always starts a match there, so the parts encode
to the same ids as the whole. A part that stays long (a run without such a
place) is split by the pattern itself and each match encoded alone.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factview.llm.common import packed, text_of, unpacked

#: Characters of a part, and of a part from which on matches are encoded one by one.
PART = 1 << 16
LONG = 1 << 19
SAFE = regex.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, most: int = PART) -> Iterator[str]:
    """``text`` in pieces cut at safe places, each about ``most`` characters where such places exist."""
    begin, n = 0, len(text)
    while n - begin > most:
        found = SAFE.search(text, begin + most)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def encode(text: str, path: str, pattern: str) -> list[int]:
    """The ids of the whole text, without special tokens."""
    own = encoding(path, pattern)
    if len(text) <= PART:
        return own.encode_ordinary(text)
    ids: list[int] = []
    for part in parts(text):
        if len(part) < LONG:
            ids += own.encode_ordinary(part)
        else:
            for match in regex.finditer(pattern, part):
                ids += own._encode_single_piece(match[0].encode())
    return ids


def decode(ids: list[int], path: str, pattern: str) -> bytes:
    """The bytes of the ids, which need not be valid UTF-8."""
    return encoding(path, pattern).decode_bytes(ids)


def with_tokens(docs: DataFrame, path: str, pattern: str, ids: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked, ``ids``.

    A null text is encoded as the empty text (no ids). Row by row: no shuffle,
    and memory holds one Arrow batch. Equally named columns are replaced.
    The rank file's path must hold on every executor.
    """
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")

    @F.pandas_udf(fields)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoding(path, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                got = encode(text, path, pattern)
                row = (len(got), hashlib.sha256(np.array(got, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(own.decode_bytes(got)).hexdigest())
                rows.append((*row, got) if ids else row)
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in fields.split(", ")])

    names = [x.split()[0] for x in fields.split(", ")]
    out = packed(docs, "text").withColumn("bpe", run(text_of()))
    return unpacked(out.select("*", *[F.col("bpe")[c].alias(c) for c in names]), docs.columns, ("text",), names)
