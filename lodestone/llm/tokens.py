"""Problem 6: encoding the corpus with a public byte-level BPE tokenizer.

Method: distinct-word table. Spark splits texts into the words of the tokenizer's pattern and counts them; each distinct
word is encoded once; ids are joined back by position. The most frequent words, a table of bounded size, are sent to all executors
and joined where the texts lie; only the occurrences of other words are shuffled to the rest of the table, so texts never
move and no hot word does. Decoding joins ids with the table of pieces.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.plans.physical import parallelism, stage_table

#: Folder of the public vocabulary files; never copied into this repository.
TOKENIZERS = os.environ.get("LODESTONE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"

#: The published word pattern of the tokenizer, with Unicode white space (fixed value).
WORDS = r"(?U)('(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"

#: So many of the most frequent words, none longer than this, are sent to all executors: at most 200 MB, in practice 10.
BROADCAST_WORDS, BROADCAST_CHARS = 400_000, 128

#: Two hashes of key and content name a row when it is decoded: 128 bits do not collide at any number of rows.
ROW_ID = ["_id", "_id2"]


def with_row_id(rows: DataFrame, content: str) -> DataFrame:
    return rows.withColumn("_id", F.xxhash64("_key", content)).withColumn("_id2", F.xxhash64(F.lit(1), content, "_key"))


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """An encoder that takes its whole input as one word: the split has been made in Spark."""
    import tiktoken

    return tiktoken.Encoding("lodestone", pat_str=r"(?s:.+)", mergeable_ranks=ranks(path), special_tokens={})


def vocabulary_path(folder: str | None = None, name: str = VOCABULARY) -> str:
    return os.path.join(folder or TOKENIZERS, f"{name}.tiktoken")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), 1)


def word_table(texts: DataFrame, path: str) -> DataFrame:
    """``word, n, ids``: every distinct word of ``_text``, its occurrences and its ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            yield batch.assign(ids=enc.encode_ordinary_batch(batch["word"].tolist(), num_threads=1))

    counted = texts.select(F.explode(words(F.col("_text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return stage_table(counted.mapInPandas(run, "word string, n long, ids array<int>"))


def least_count(table: DataFrame) -> int:
    """The least number of occurrences from which words are at most ``BROADCAST_WORDS``; 0 if that holds for all."""
    octave = F.floor(F.log2("n") * 8).cast("int")
    rows = sorted(((r[0], r[1], r[2]) for r in table.groupBy(octave.alias("o")).agg(F.min("n"), F.count("*")).collect()), reverse=True)
    least, held = 0, 0
    for _, n, count in rows:
        held += count
        if held > BROADCAST_WORDS:
            return max(least, 1) if least else rows[0][1] + 1
        least = n
    return 0


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of runs that begin at ``starts`` and are ``sizes`` long, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _located(frequent) -> object:
    """Rows of ``_key, words`` become ``_key, ids, rare``: a word that is not among the frequent ones leaves ``-k`` in its place,
    and is the k-th of ``rare``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids, offsets = frequent.value
        size_of = np.append(np.diff(offsets), 1)
        for batch in batches:
            column = batch.column("words")
            flat, per_row = column.flatten(), np.asarray(column.value_lengths().fill_null(0))
            at = pc.index_in(flat, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
            missing = at < 0
            row = np.repeat(np.arange(len(per_row)), per_row)
            rare_per_row = np.bincount(row[missing], minlength=len(per_row))
            # place of each missing word among those of its row, from 1
            nth = np.cumsum(missing) - np.repeat(np.cumsum(rare_per_row) - rare_per_row, per_row)
            sizes = size_of[at]
            value = np.zeros(int(sizes.sum()), "int32")
            begin = np.cumsum(sizes) - sizes
            value[_gather(begin[~missing], sizes[~missing])] = ids[_gather(offsets[:-1][at[~missing]], sizes[~missing])]
            value[begin[missing]] = -nth[missing]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, sizes, len(per_row)).astype("int64"))]).astype("int32")
            rare_ends = np.concatenate([[0], np.cumsum(rare_per_row)]).astype("int32")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(value)), pa.ListArray.from_arrays(pa.array(rare_ends), flat.filter(pa.array(missing)))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *lists], names=["_key", "ids", "rare"])

    return run


def _joined(docs: DataFrame, key: str, text: str, folder: str | None) -> DataFrame:
    """``_key, ids, found``: ids with ``-k`` for the k-th word of a row that is not frequent, whose ids are ``found[k - 1]``."""
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    table = word_table(rows, vocabulary_path(folder))
    least = least_count(table)
    often = (F.col("n") >= least) & (F.length("word") <= BROADCAST_CHARS)
    got = table.where(often).select("word", "ids").toArrow().combine_chunks()
    lists = got.column("ids").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    known = got.column("word").combine_chunks() if got.num_rows else pa.array([], pa.string())
    offsets = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype("int64")
    frequent = docs.sparkSession.sparkContext.broadcast((known.cast(pa.string()), lists.flatten().to_numpy(zero_copy_only=False).astype("int32"), offsets))
    kind = rows.schema["_key"].dataType.simpleString()
    placed = rows.select("_key", words(F.col("_text")).alias("words")).mapInArrow(_located(frequent), f"_key {kind}, ids array<int>, rare array<string>")
    rest = table.where(~often)
    none = F.lit(None).cast("array<array<int>>").alias("found")
    if rest.isEmpty():
        return placed.select("_key", "ids", none)
    staged = stage_table(placed.withColumn("_row", F.monotonically_increasing_id()))
    rare = staged.where(F.size("rare") > 0).select("_row", F.posexplode("rare").alias("k", "word")).join(rest.select("word", F.col("ids").alias("own")), "word")
    found = rare.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "own"))), lambda x: x["own"]).alias("found"))
    return staged.join(found, "_row", "left").select("_key", "ids", "found")


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """``key, ids`` for each row of ``docs``: the ids of ``text`` without special tokens.

    Null and empty texts have the empty list of ids. A repeated row gives its result again for each
    repetition; a null key is kept. Strings of special tokens are ordinary text. Other columns are ignored.
    """
    whole = F.flatten(F.transform("ids", lambda x: F.when(x < 0, F.element_at("found", -x)).otherwise(F.array(x))))
    return _joined(docs, key, text, folder).select(F.col("_key").alias(key), F.when(F.col("found").isNull(), F.col("ids")).otherwise(whole).alias("ids"))


def count(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """``key, n_tokens`` for each row of ``docs``. Null and empty texts have 0."""
    known = F.size(F.filter("ids", lambda x: x >= 0))
    rest = F.aggregate("found", F.lit(0), lambda n, x: n + F.size(x))
    n = F.when(F.col("found").isNull(), F.size("ids")).otherwise(known + rest)
    return _joined(docs, key, text, folder).select(F.col("_key").alias(key), n.cast("long").alias("n_tokens"))


def pieces(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """The vocabulary as ``id, piece`` with the bytes of each piece in hex."""
    data = [(i, b.hex()) for b, i in ranks(vocabulary_path(folder)).items()]
    return spark.createDataFrame(pd.DataFrame(data, columns=["id", "piece"]), "id int, piece string")


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", folder: str | None = None) -> DataFrame:
    """``key, text`` from ``key, ids``; the empty list gives the empty text, null ids null, an unknown id an error.
    Rows that repeat a key with the same ids give the text again for each repetition."""
    rows = encoded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))
    rows = with_row_id(rows, "_ids")
    placed = rows.repartition(parallelism(encoded.sparkSession), *ROW_ID)
    at = placed.select(*ROW_ID, F.posexplode("_ids").alias("pos", "id")).join(F.broadcast(pieces(encoded.sparkSession, folder)), "id", "left")
    at = at.withColumn("piece", F.coalesce("piece", F.raise_error(F.concat(F.lit("unknown id "), F.col("id").cast("string"))).cast("string")))
    text = at.groupBy(*ROW_ID).agg(F.collect_set(F.struct("pos", "piece")).alias("_at"))
    text = text.select(*ROW_ID, F.decode(F.unhex(F.array_join(F.transform(F.array_sort("_at"), lambda x: x["piece"]), "")), "UTF-8").alias("text"))
    done = placed.join(text, ROW_ID, "left")
    return done.select(F.col("_key").alias(key), F.when(F.col("_ids").isNotNull(), F.coalesce("text", F.lit(""))).alias("text"))
