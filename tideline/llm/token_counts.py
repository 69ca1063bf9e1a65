"""Exact histogram of encoded lengths, and what its suffix sums answer.

Documents are counted by their number of tokens. The histogram is small (a row for each length that
occurs), and sums over its longer lengths answer, for every context limit at once: how many documents
exceed it, how many tokens there are in all, and how many remain if each document is truncated to it.
Suffix sums are taken in two levels, within blocks of lengths and over the blocks, so that no task
sorts more than one block's rows. The histogram is kept at a checkpoint, so that texts are encoded once.

Edge cases: null and empty texts have length 0; the string of an added token, such as <|endoftext|>, is ordinary
text here, while op7 encodes it as one token; very long texts are encoded whole; repeated documents count each time; an empty table has
an empty histogram, no quantiles, and totals of 0; further columns are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.tables import checkpointed, table

#: Lengths in a block of the two-level sums.
BLOCK = 256
_tokenizers: dict[str, tiktoken.Encoding] = {}


def tokenizer_of(path: str | None) -> tiktoken.Encoding:
    """The worker's tokenizer from a file of ranks, by default the public byte-level BPE."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _tokenizers:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _tokenizers[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _tokenizers[path]


def token_counts(docs: DataFrame, *, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens) of every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer_of(ranks)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(own.encode_ordinary(x.as_py() or "")) for x in batch.column(1)], pa.int64())], ["id", "n_tokens"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(count, "id long, n_tokens long")


def histogram(counts: DataFrame, length: str = "n_tokens") -> DataFrame:
    """For each length that occurs: docs, and suffix sums for a context limit of that length.

    docs_over and tokens_over count the longer documents; tokens_truncated is the total if every document
    is cut to the limit, tokens_total the total without one, docs_total the number of documents.
    """
    by = checkpointed(counts.groupBy(F.col(length).alias("n_tokens")).agg(F.count("*").alias("docs"))).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = by.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum(F.col("docs") * F.col("n_tokens")).alias("block_tokens"))
    after, everything = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0).cast("long")
    above = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(after), zero).alias("docs_after"),
        F.coalesce(F.sum("block_tokens").over(after), zero).alias("tokens_after"),
        F.sum("block_docs").over(everything).alias("docs_total"),
        F.sum("block_tokens").over(everything).alias("tokens_total"),
    )
    longer = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    docs_over = F.coalesce(F.sum("docs").over(longer), zero) + F.col("docs_after")
    tokens_over = F.coalesce(F.sum(F.col("docs") * F.col("n_tokens")).over(longer), zero) + F.col("tokens_after")
    return (
        by.join(above, "block")
        .select("n_tokens", "docs", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"), "docs_total", "tokens_total")
        .withColumn("tokens_truncated", F.col("tokens_total") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over"))
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit, present in the histogram or not: docs_over, tokens_total, tokens_truncated."""
    asked = [int(x) for x in limits]
    each = hist.select("n_tokens", "docs", F.explode(F.array(*[F.lit(x).cast("long") for x in asked])).alias("context"))
    sums = each.groupBy("context").agg(
        F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.col("docs") * F.col("n_tokens")).alias("tokens_total"),
        F.sum(F.col("docs") * F.least("n_tokens", "context")).alias("tokens_truncated"),
    )
    rows = hist.sparkSession.createDataFrame([(x,) for x in asked], "context long")
    return rows.join(sums, "context", "left").na.fill(0)


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """For each share q: the least length that at least q of the documents don't exceed."""
    asked = F.explode(F.array(*[F.lit(float(q)) for q in shares])).alias("share")
    upto = F.col("docs_total") - F.col("docs_over")
    return hist.select("n_tokens", upto.alias("upto"), "docs_total", asked).where("upto >= share * docs_total").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    return histogram(token_counts(table(spark, sf_dir, "documents")))
