"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding by the byte table.

A ranks file (base64 token, rank) becomes a tokenizers model: every byte is
written as a printable character, every way to put a token together from two
others becomes a merge in the order of ranks, and a match that is a token
already is taken whole. Ids travel as packed little-endian unsigned 32-bit
integers. Decoding joins the bytes of all tokens before anything is read as
UTF-8, so characters that are split over tokens come back whole.

Cases: null counts as the empty text, which has no tokens; other columns are
kept; an empty table gives an empty result; equal rows give equal ids, and null
ids of rows are ids like others; a very long text is encoded by itself, chunk by
chunk, in some 60 bytes a byte of text.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm import common
from strata.llm.chunks import ChunkCache


def byte_characters() -> list[str]:
    """A printable character per byte: itself where it prints, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def token_table(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


@lru_cache(maxsize=2)
def chunk_cache(path: str, pattern: str) -> ChunkCache:
    """The tokenizer of a ranks file behind a cache, one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = read_ranks(path), byte_characters()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in ranks and right in ranks:
                merges.append((rank, ranks[left], ranks[right], shown[left], shown[right]))
    merges.sort()
    model = models.BPE({shown[t]: r for t, r in ranks.items()}, [m[3:] for m in merges], ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "removed", invert=True),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return ChunkCache(lambda part: [x.ids for x in tokenizer.encode_batch_fast(part, add_special_tokens=False)])


# The white space of the pattern; Python's own class has four control characters more.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = re.compile(f"([{_SPACE}][{_SPACE}]+|[{_SPACE.replace(' ', '')}])")


def split_chunks(text: str) -> list[str]:
    """Cut a text where no match of the pattern can cross.

    Words between single spaces keep the space before them. A run of white
    space gives its last space to the word after it; without one its last
    character is a match of its own, as the pattern's backtracking has it.
    """
    out: list[str] = []
    bits = _SPACES.split(text)
    lead = ""
    for i in range(0, len(bits), 2):
        words = bits[i]
        if words:
            first, *rest = words.split(" ")
            if lead or first:
                out.append(lead + first)
            out.extend([" " + w for w in rest])
            lead = ""
        if i + 1 < len(bits):
            run = bits[i + 1]
            if i + 2 == len(bits) - 1 and not bits[i + 2]:
                out.append(run)
                break
            if len(run) > 1:
                out.append(run[:-1])
            if run[-1] == " ":
                lead = " "
            else:
                out.append(run[-1])
    return out


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", offsets: str | None = None, decoded: str | None = None) -> DataFrame:
    """Add a binary column of packed ids and, where ``offsets`` names one, the
    packed character positions at which the tokens start (a token that starts
    inside a character gets that character's position). ``decoded`` names a
    column for the bytes that the ids decode to, in the same pass. Where the
    input has one of these names, the added column gets underscores in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, table = chunk_cache(ranks, pattern), token_table(ranks)
        lengths = np.array([len(t) for t in table], np.int64)
        for batch in common.pieces(batches, at):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            packed = cache.ids([split_chunks(t) for t in texts])
            added = [common.binary_array(packed)]
            if offsets:
                added.append(common.binary_array([_starts(t, np.frombuffer(p, "<u4"), lengths) for t, p in zip(texts, packed)]))
            if decoded:
                added.append(common.binary_array([token_bytes(p, table) for p in packed]))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    at = df.columns.index(text)
    ids, offsets, decoded = (c and common.own_name(df, c) for c in (ids, offsets, decoded))
    names = [*df.columns, ids, *(c for c in (offsets, decoded) if c)]
    schema = StructType([*df.schema.fields])
    for name in names[len(df.columns) :]:
        schema = schema.add(name, "binary")
    return df.mapInArrow(common.tidy(run), schema)


def token_bytes(packed: bytes, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _starts(text: str, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of every byte
    ends = np.cumsum(lengths[ids])
    return character[ends - lengths[ids]].astype("<u4").tobytes()


def decode(df: DataFrame, ranks: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for."""

    @F.pandas_udf("binary")
    def join(packed: pd.Series) -> pd.Series:
        table = token_table(ranks)
        return packed.map(lambda p: token_bytes(p, table))

    return df.withColumn(decoded, join(ids))


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document; counts and digests of both."""
    import public_tokenizers

    common.small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return coded.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
