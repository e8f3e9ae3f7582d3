"""Texts packed into containers of a fixed number of tokens."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How byte-level tokenizers of this kind cut a text before they merge bytes, where the tokenizers' own package is absent.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    try:
        from public_tokenizers import PATTERN as pattern
    except ImportError:
        pattern = PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_id: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """`doc_id, row, n_tokens`, of whole texts; null texts have 0. `row` tells rows with one id apart: a hash of the text and of the
    number of the copy, which doesn't depend on how the table is stored."""

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "digest", "n_tokens"])

    rows = documents.select(F.col(doc_id).cast("long"), F.md5(F.col(text).cast("string")), F.col(text).cast("string"))
    copies = rows.mapInArrow(run, "doc_id long, digest string, n_tokens long").groupBy("doc_id", "digest", "n_tokens").agg(F.count("*").alias("copies"))
    each = copies.select("doc_id", "digest", "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return each.select("doc_id", F.xxhash64("digest", "copy").alias("row"), "n_tokens")


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """Container of each size, in the given order, the first that has room: found from the root of a tournament tree that
    holds the most room of any container below each node."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room, out = [capacity] * (2 * leaves), []
    for size in sizes:
        if not 0 < size <= capacity:
            raise ValueError(f"size {size} with capacity {capacity}")
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        out.append(node - leaves)
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return out


def pack(counts: DataFrame, capacity: int = 2048, group_rows: int = 8192, seed: int = 42) -> DataFrame:
    """`doc_id, piece_no, first_token, n_tokens, container_id`, from rows of `doc_id, row, n_tokens`.

    A text of up to `capacity` tokens is one piece; a longer one gives full containers and its rest. First fit in order
    of decreasing size runs apart in hashed groups of about `group_rows` texts, which are the most that a task holds.
    Texts without tokens get no container; ties go by id, then piece.
    """
    counts = counts.where("n_tokens > 0")
    groups = max(1, -(-counts.count() // group_rows))
    rest = counts.withColumn("n_full", F.floor(F.col("n_tokens") / capacity)).withColumn("tail", F.col("n_tokens") % capacity)
    rest = rest.withColumn("group_no", F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(groups)))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tail", "doc_id", "row"], ascending=[False, True, True])
        full = frame[frame["n_full"] > 0]
        last = frame[frame["tail"] > 0]
        bins = first_fit(last["tail"].tolist(), capacity)
        base = int(frame["group_no"].iloc[0]) << 32
        used = max(bins, default=-1) + 1
        pieces = [(d, int(n), int(n) * capacity, int(t), base + b) for d, n, t, b in zip(last["doc_id"], last["n_full"], last["tail"], bins, strict=True)]
        for d, n in zip(full["doc_id"], full["n_full"], strict=True):
            pieces += [(d, k, k * capacity, capacity, base + used + k) for k in range(int(n))]
            used += int(n)
        return pd.DataFrame(pieces, columns=["doc_id", "piece_no", "first_token", "n_tokens", "container_id"])

    return rest.groupBy("group_no").applyInPandas(fit, "doc_id long, piece_no long, first_token long, n_tokens long, container_id long")
