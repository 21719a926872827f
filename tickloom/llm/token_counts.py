"""Token counts of whole texts by a two-tier lookup on the map side.

A byte-level BPE encodes each pre-token for itself, so a text's count is the sum over its
pre-tokens. The lengths of frequent pre-tokens are broadcast: the tokenizer's own vocabulary,
learned from frequencies, names them, so the table has as many entries as the vocabulary and
does not grow with the data. A worker encodes a pre-token it misses once and remembers it in a
bounded cache. Nothing is shuffled.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
import uuid
from pathlib import Path

import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import held_by_worker, with_struct

# The pre-token pattern and the byte alphabet of this tokenizer family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: A worker's cache of missed pre-tokens: entries, and characters of the longest it keeps.
CACHE_ENTRIES = 500_000
LONGEST_CACHED = 256
#: Stands for the length of a pre-token that the library must see in its whole text; no sum outweighs it.
_WHOLE_TEXT = -(1 << 60)


def byte_alphabet() -> dict[str, int]:
    """Character used for each byte in the vocabulary."""
    spare = iter(range(256, 512))
    return {chr(b if b in PRINTABLE else next(spare)): b for b in range(256)}


def unassigned_characters() -> str:
    """A pattern of the characters without a class in Python's Unicode tables: others may know a newer version."""
    ranges: list[list[int]] = []
    for code in range(128, sys.maxunicode + 1):
        if unicodedata.category(chr(code)) == "Cn":
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in ranges) + "]"


def frequent_lengths(tokenizer, vocabulary: dict[str, int], unassigned: str) -> dict[str, int]:
    """Token count of every vocabulary entry that is one whole pre-token of assigned characters."""
    letters, pattern, unsure = byte_alphabet(), regex.compile(PRE_TOKEN), re.compile(unassigned)
    texts = []
    for entry in vocabulary:
        try:
            text = bytes(letters[c] for c in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if pattern.findall(text) == [text] and not unsure.search(text):
            texts.append(text)
    made = tokenizer.encode_batch(texts, add_special_tokens=False)
    return {t: len(e.ids) for t, e in zip(texts, made, strict=True)}


class _Lengths(dict):
    """Pre-token lengths of one worker; a miss is judged and encoded once and kept, up to ``most`` entries."""

    def __init__(self, frequent: dict[str, int], tokenizer, unassigned: str, most: int):
        super().__init__(frequent)
        self.frequent, self.tokenizer, self.most = frequent, tokenizer, most
        self.unassigned = re.compile(unassigned)

    def __missing__(self, text: str) -> int:
        if not text.isascii() and self.unassigned.search(text):
            n = _WHOLE_TEXT
        else:
            n = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(text) <= LONGEST_CACHED:
            if len(self) >= len(self.frequent) + self.most:
                self.clear()
                self.update(self.frequent)
            self[text] = n
        return n


class TokenCounter:
    """Counts as the tokenizer itself would; built once per worker."""

    def __init__(self, tokenizer, frequent: dict[str, int], special: list[str], unassigned: str, most: int = CACHE_ENTRIES):
        self.tokenizer = tokenizer
        self.pattern = regex.compile(PRE_TOKEN)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.lengths = _Lengths(frequent, tokenizer, unassigned, most)

    def count(self, text: str) -> int:
        # Strings of added tokens inside a text, and characters whose class depends on the
        # Unicode version, are left to the library, which then encodes the whole text. Every
        # character lies in some pre-token, and each different pre-token is tested once.
        if not (self.special and self.special.search(text)):
            n = sum(map(self.lengths.__getitem__, self.pattern.findall(text)))
            if n >= 0:
                return n
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def is_plain_byte_bpe(config: dict) -> bool:
    """True for tokenizers whose pre-tokens are independent and cut by ``PRE_TOKEN``."""
    pre = config.get("pre_tokenizer") or {}
    added = config.get("added_tokens") or []
    return (
        config["model"]["type"] == "BPE"
        and not config.get("normalizer")
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
    )


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    name: str = "tokens",
    keep: list[str] | None = None,
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """Add the struct ``name`` (n_bytes, n_tokens) for whole texts.

    Begin, end and other added tokens are not counted, unless their strings stand in the text,
    which the library turns into added tokens by default. Nothing is cut off or padded. A null or
    empty text has 0 bytes and 0 tokens. Repeated rows are each counted.

    ``tokenizer_path`` is a byte-level BPE file in the tokenizers library's JSON format; it goes
    to the executors with the job.
    """
    from tokenizers import Tokenizer

    config = json.loads(Path(tokenizer_path).read_text())
    if not is_plain_byte_bpe(config):
        raise ValueError(f"{tokenizer_path}: not a byte-level BPE with independent pre-tokens")
    spark = docs.sparkSession
    vocabulary = config["model"]["vocab"]
    unassigned = unassigned_characters()
    frequent = spark.sparkContext.broadcast(frequent_lengths(Tokenizer.from_file(tokenizer_path), vocabulary, unassigned))
    special = [t["content"] for t in config.get("added_tokens") or []]
    spark.sparkContext.addFile(tokenizer_path)
    file, key = os.path.basename(tokenizer_path), f"tokens-{uuid.uuid4()}"

    def counter() -> TokenCounter:
        return TokenCounter(Tokenizer.from_file(SparkFiles.get(file)), frequent.value, special, unassigned, cache_entries)

    def compute(texts: list[bytes | None]) -> list:
        count = held_by_worker(key, counter).count
        return [[len(t or b"") for t in texts], [count(t.decode()) if t else 0 for t in texts]]

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return with_struct(docs, "text", fields, compute, name, keep)
