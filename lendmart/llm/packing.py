"""Packing by concatenating and cutting.

Pass one encodes the documents, writes their ids and, with each, its offset inside its
partition. The partitions' token totals are then summed up, which gives every document its
place in one endless stream; pass two cuts that stream at multiples of the sequence length.
Each cut leaves a boundary record: the pieces on its two sides carry the same document, and
pieces of one sequence may come from different partitions. Only the last sequence can be
short.

The ids come from the ``tiktoken`` library's merging by rank of the joined bytes. That is
the merging by rank of the pair that the tokenizer file asks for if every token comes from
one merge, in order of its id, and its own bytes merge to it (``_by_rank`` checks the file).
Other files, and texts with special tokens or words over ``LONGEST_WORD``, for which that
merging is quadratic, are encoded by ``bpe``.

Defined results: a null text counts as empty and packs as its end token alone. Repeated rows
are packed each. An empty table gives no pieces. The order of the stream is the order of
the files read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lendmart.llm.bpe import WORDS, Bpe, tokenizer
from lendmart.llm.common import SLICE_ROWS, map_rows, ship, stored

LENGTH = 2048
END_ID = 1
LONGEST_WORD = 2000


def _by_rank(bpe: Bpe) -> bool:
    """Whether joined bytes rank as the merges do: each token of several bytes has one merge,
    ids follow the merges' order, and no token's own bytes merge to something else."""
    several = sum(len(token) > 1 for token in bpe.ids) - sum(s.encode() in bpe.ids for s in bpe.specials)
    return several == len(bpe.made) and bool((np.diff(bpe.made) > 0).all()) and not bpe.odd.any()


def _short(text: str) -> bool:
    """Whether no run of blanks, and none of other characters, is over ``LONGEST_WORD``."""
    sizes = [len(word) for word in text.split()]
    return max(sizes, default=0) <= LONGEST_WORD and len(text) - sum(sizes) - len(sizes) <= LONGEST_WORD


@lru_cache(maxsize=2)
def id_encoder(path: str) -> Callable[[list[str | None]], list[np.ndarray]]:
    """A function from texts to their ids, made once in each worker."""
    bpe = tokenizer(path)
    exact = lambda texts: [np.frombuffer(ids, "<u4") for ids in bpe.encode(texts)]
    if not _by_rank(bpe):
        return exact
    ranks = {token: i for token, i in bpe.ids.items() if i not in bpe.specials.values()}
    fast = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(texts):
        return [
            fast.encode_to_numpy(text, disallowed_special=())
            if _short(text) and not any(s in text for s in bpe.specials)
            else exact([text])[0]
            for text in (t or "" for t in texts)
        ]

    return encode


def _encoded(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, at, n_tokens, id, ids): ids in 16 bits if the vocabulary allows."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = _parse_datatype_string(f"part int, at long, n_tokens long, `{id_col}` {kind}, ids binary")
    out = to_arrow_schema(schema)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = id_encoder(path), TaskContext.get().partitionId(), 0
        kept = _id_type(tokenizer(path).size)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(start, SLICE_ROWS)
                rows = []
                for key, ids in zip(piece.column(0).to_pylist(), encode(piece.column(1).to_pylist())):
                    all_ids = np.append(ids, end_id).astype(kept)
                    rows.append((part, at, len(all_ids), key, all_ids.tobytes()))
                    at += len(all_ids)
                arrays = [pa.array(v, f.type) for v, f in zip(zip(*rows), out)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    ship(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(step, schema)


def _id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def pack(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: (id, start, length, doc_tokens, sequence_id, offset, ids), the
    piece's ids as little-endian unsigned 32-bit integers."""
    encoded = stored(_encoded(docs, path, end_id, id_col, text_col), "packing")
    totals = encoded.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row of 12 bytes per partition of pass one: 100 TB read in pieces of 128 MB make
    # 800,000 rows, 10 MB.
    placed = encoded.join(F.broadcast(bases), "part").withColumn("place", F.col("base") + F.col("at"))

    def make():
        kept = _id_type(tokenizer(path).size)

        def work(keys, places, packed):
            rows = []
            for key, place, ids in zip(keys, places, packed):
                tokens = np.frombuffer(ids, kept).astype("<u4")
                at = 0
                while at < len(tokens):
                    sequence, offset = divmod(place + at, length)
                    stop = min(len(tokens), at + length - offset)
                    rows.append((key, at, stop - at, len(tokens), sequence, offset, tokens[at:stop].tobytes()))
                    at = stop
            return rows

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return map_rows(placed, [id_col, "place", "ids"], make, schema)
