"""Token counts: an exact histogram of encoded lengths, from which suffix sums answer every context limit.

Each text is encoded once, in Arrow batches; what is shuffled is one row per length and task. The counts are stored,
as they are read twice and encoding is what costs time. The suffix sums go over the histogram in blocks of lengths, so
no task sees more than one block or the list of blocks.

Texts may be of any length and hold runs of any length of one kind of character. A NULL or empty text has 0 tokens and counts as a document. Special token strings are ordinary text. Repeated rows count
each. An empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, texts_for_python

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY_BYTES = 64 << 20
# The split into pieces that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 4096
# White space as the pattern understands it, in runs that its matcher, which goes back step by step, might not survive.
_WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_WHITE = re.compile(_WHITE + "{256,}")


def count_tokens(encoding, text: str) -> int:
    """Tokens of a whole text under ``PATTERN``, whatever runs of white space it holds.

    The pattern takes a run of white space that something follows as one piece but for its last character, which
    belongs to what follows, and a run at the end as one piece. So a long run is cut there and encoded as a piece.
    """
    total, start = 0, 0
    for run in _LONG_WHITE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[start : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        start = end
    return total + len(encoding.encode_ordinary(text[start:]))


def _shared_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file, read once by the driver and sent to the executors; its size is checked."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def token_lengths(documents: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id and n_tokens of every document. Long runs of white space are cut only under the pattern of this module."""
    count = count_tokens if pattern == PATTERN else lambda encoding, text: len(encoding.encode_ordinary(text))
    shared = _shared_vocabulary(documents.sparkSession, vocabulary)

    def encode(batches):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, shared.value.splitlines()) if token}
        encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            lengths = [count(encoding, text) if (text := value.as_py()) else 0 for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return texts_for_python(documents.select("doc_id", "text")).mapInArrow(encode, f"doc_id {kind}, n_tokens long")


def length_histogram(lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per encoded length L, with the answers for the context limit L.

    n_docs have this length; docs_at_least and tokens_at_least are the suffix sums over lengths >= L; truncated_tokens is
    what remains of the corpus if every document is cut after L tokens; docs_below is the rank of L among the documents.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = stored(counts, "length-counts")
    counts = counts.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.expr(f"n_tokens div {block}"))
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("total_docs"),
        F.sum("block_tokens").over(everything).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("docs", F.sum("n_docs").over(inside)).withColumn("sum_tokens", F.sum("tokens").over(inside))
    table = counts.join(blocks, "block")
    docs_at_least, tokens_at_least = F.col("docs") + F.col("later_docs"), F.col("sum_tokens") + F.col("later_tokens")
    return table.select(
        "n_tokens",
        "n_docs",
        docs_at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        (F.col("total_docs") - docs_at_least).alias("docs_below"),
        (F.col("total_tokens") - tokens_at_least + F.col("n_tokens") * docs_at_least).alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """One row per context limit, also for limits that are no document's length."""
    wanted = F.explode(F.array(*[F.lit(limit).cast("long") for limit in limits])).alias("context")
    table = histogram.select("n_tokens", "n_docs", wanted)
    return table.groupBy("context").agg(
        F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
        F.sum(F.least("n_tokens", "context") * F.col("n_docs")).alias("truncated_tokens"),
        F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total_tokens"),
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """For each share q the smallest length that at least q of all documents do not exceed."""
    wanted = F.explode(F.array(*[F.lit(float(share)) for share in shares])).alias("share")
    table = histogram.select("n_tokens", "n_docs", "docs_below", "total_docs", wanted)
    table = table.filter(F.col("docs_below") + F.col("n_docs") >= F.ceil(F.col("share") * F.col("total_docs")))
    return table.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
