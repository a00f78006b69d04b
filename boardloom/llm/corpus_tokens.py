"""Encoding of the whole corpus with a public tokenizer (problem 7).

Texts are cut into overlapping chunks of CHUNK characters that are pre-tokenised in parallel (a text of one chunk is
one piece and goes straight to the encoder); neighbours are stitched at the first pre-token boundary of the overlap that both
found, which no start could have changed, and the pieces between such boundaries are encoded independently.
Where a chunk and its predecessor never resynchronise (one pre-token longer than the overlap) the two stay
one piece, so the ids are exactly those of the whole text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardloom.plans.work import spread

#: Where the tokenizer files lie; a parameter of every function below.
VOCABULARIES = os.environ.get("BOARDLOOM_TOKENIZERS", "/opt/tokenizers")
#: Characters of a chunk, and of the next one that it also holds.
CHUNK, OVERLAP = 2_048, 256
#: Fixed value: the pre-token pattern of the byte_bpe_50k vocabulary, as its public description gives it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_encoders: dict = {}


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoder(name: str, folder: str):
    """The encoder of a rank file; made once per worker process."""
    if (folder, name) not in _encoders:
        import tiktoken

        ranks = vocabulary(os.path.join(folder, f"{name}.tiktoken"))
        _encoders[folder, name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[folder, name]


def _encode(name: str, folder: str, counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            ids = [enc.encode_ordinary(t) if t else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
            out = pa.array([len(x) for x in ids], pa.int64()) if counts else pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*batch.schema.names[:-1], "n_tokens" if counts else "ids"])

    return run


def _cut(chunk: int, overlap: int):
    """Cut long texts into chunk rows; the overlap belongs to the next chunk and is carried twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, number, parts = [], [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                for i, start in enumerate(range(0, len(text), chunk)):
                    owner.append(n)
                    number.append(i)
                    parts.append(text[start : start + chunk + overlap])
                if len(parts) > 4_096:
                    yield _rows(batch, owner, number, parts)
                    owner, number, parts = [], [], []
            yield _rows(batch, owner, number, parts)

    return run


def _rows(batch: pa.RecordBatch, owner: list[int], number: list[int], parts: list[str]) -> pa.RecordBatch:
    ids = batch.column(0).take(pa.array(owner, pa.int64()))
    return pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(parts, pa.string())], names=["id", "chunk", "text"])


def _bounds(chunk: int, overlap: int):
    """Resynchronisation points of each chunk: near its start, and in its overlap relative to the end of its base.

    A pre-token boundary counts if it holds wherever pre-tokenising began: no pre-token spans a change of
    character class, but for white space before a word and an apostrophe before letters. Such a boundary shortly before
    the overlap is therefore as good a start for the overlap's pre-tokens as the chunk's own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(PATTERN)
        firm = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}\s])|(?<=\p{N})(?=[^\p{N}\s])|(?<=[^\s\p{L}\p{N}])(?=\p{N})")

        def starts(text: str, first: int, last: int) -> list[int]:
            """Firm boundaries that are starts of pre-tokens, from `first` on and before `last`."""
            sure = [m.start() for m in firm.finditer(text, max(0, first - overlap), min(len(text), last + 1))]
            begin = next((s for s in sure if s <= first), 0)
            found = set()
            for m in pattern.finditer(text, begin):
                if m.start() >= last:
                    break
                found.add(m.start())
            return [s for s in sure if first <= s < last and s in found]

        for batch in batches:
            texts = batch.column("text").to_pylist()
            heads = [starts(t, 1, overlap) for t in texts]
            tails = [[s - chunk for s in starts(t, chunk, chunk + overlap)] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], names=[*batch.schema.names, "heads", "tails"])

    return run


def pieces(long_texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(id, piece, text): independently encodable pieces of long texts, of which `id` and `text` are the columns."""
    kind = dict(long_texts.dtypes)["id"]
    cut = long_texts.mapInArrow(_cut(chunk, overlap), f"id {kind}, chunk int, text string").repartition("id", "chunk")
    marked = cut.mapInArrow(_bounds(chunk, overlap), f"id {kind}, chunk int, text string, heads array<int>, tails array<int>")
    order = Window.partitionBy("id").orderBy("chunk")
    joint = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.get(F.array_intersect(F.lag("tails").over(order), F.col("heads")), F.lit(0)))
    joined = marked.withColumn("at", joint)
    joined = joined.withColumn("piece", F.sum(F.col("at").isNotNull().cast("int")).over(order)).withColumn("next", F.lead("at").over(order))
    end = F.when(F.lead("chunk").over(order).isNull(), F.length("text")).otherwise(F.lit(chunk) + F.coalesce("next", F.lit(0)))
    start = F.coalesce("at", F.lit(0))
    part = joined.select("id", "piece", "chunk", F.substring("text", start + 1, end - start).alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "part")))
    return part.groupBy("id", "piece").agg(F.array_join(F.transform(parts, lambda x: x["part"]), "").alias("text"))


def encode(df: DataFrame, id_col: str, text: Column, name: str = "byte_bpe_50k", folder: str = VOCABULARIES, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, ids array<int>) of every row, without special tokens.

    Defined cases: NULL and empty text give an empty list; strings of special tokens are ordinary text;
    an empty table gives no rows; texts of any length are encoded whole.
    """
    source = df.select(F.col(id_col).alias("id"), text.alias("text"))
    kind = dict(source.dtypes)["id"]
    size = F.coalesce(F.length("text"), F.lit(0))
    short = source.where(size <= chunk).mapInArrow(_encode(name, folder, False), f"id {kind}, ids array<int>")
    cut = pieces(source.where(size > chunk), chunk, overlap).repartition("id", "piece")
    encoded = cut.mapInArrow(_encode(name, folder, False), f"id {kind}, piece bigint, ids array<int>")
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"]))
    return short.unionByName(encoded.groupBy("id").agg(whole.alias("ids")))


def token_counts(df: DataFrame, keep: list[str], text: Column, name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """The columns `keep` and n_tokens of every row; NULL and empty text count 0."""
    source = df.select(*keep, text.alias("text"))
    fields = ", ".join(f"{c} {t}" for c, t in source.dtypes if c != "text")
    return source.mapInArrow(_encode(name, folder, True), f"{fields}, n_tokens bigint")


def decode(df: DataFrame, ids: str, name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """The rows of df with text: the raw bytes of all ids joined and read as UTF-8 (an unknown id raises)."""
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            raw = [b"".join(map(enc.decode_single_token_bytes, x or [])).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.string())], names=[*batch.schema.names, "text"])

    return df.mapInArrow(run, f"{fields}, text string")


def document_ids(documents: DataFrame) -> DataFrame:
    """(doc_id, ids) of documents by byte_bpe_50k."""
    return encode(spread(documents.select("doc_id", "text")), "doc_id", F.col("text")).select(F.col("id").alias("doc_id"), "ids")
