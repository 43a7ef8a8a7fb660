"""Ids of the byte-level BPE vocabulary, whole texts, inside Arrow batches."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken

#: Fixed value: the pattern that splits text before the merges.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
END = 0  # the id that closes a document


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the vocabulary file's spelling of bytes: printable
    Latin-1 characters stand for themselves, the other bytes, in order, for
    the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}


@lru_cache(maxsize=2)
def encoding(path: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """The vocabulary of a tokenizers JSON file, whose ids are merge ranks,
    and its added tokens, which stand for themselves wherever a text holds
    their strings."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    added = {x["content"]: x["id"] for x in j["added_tokens"]}
    byte = byte_alphabet()
    ranks = {bytes(byte[c] for c in w): i for w, i in j["model"]["vocab"].items() if i not in added.values()}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), added


def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids, as the tokenizers library gives them without a post-processor."""
    own, added = encoding(path)
    ordinary = own.encode_ordinary
    if not added:
        return ordinary
    borders = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode(text: str) -> list[int]:
        if not any(a in text for a in added):
            return ordinary(text)
        return [i for part in borders.split(text) for i in ([added[part]] if part in added else ordinary(part))]

    return encode


def document_ids(path: str, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    """Little-endian unsigned 32-bit ids of each text, END last."""
    encode = encoder(path)
    for text in texts:
        yield np.array([*encode(text or ""), END], dtype="<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids))


def count_ids(batches: Iterator[pa.RecordBatch], path: str, text: int) -> Iterator[pa.RecordBatch]:
    """The batches with column ``text`` replaced by n_tokens (without END)."""
    encode = encoder(path)
    for batch in batches:
        n = pa.array([len(encode(x or "")) for x in batch.column(text).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([n if i == text else c for i, c in enumerate(batch.columns)],
                                         names=["n_tokens" if i == text else c for i, c in enumerate(batch.schema.names)])
