"""Harmonic packing of tokenized documents into sequences of one capacity.

A piece of length at most capacity / n belongs to class n, and every sequence of class n takes exactly n
pieces of that class. Which sequence a piece goes to therefore depends only on its number within its
class, so workers fill their sequences without knowing of each other.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segwatch.functions.storage import cut
from segwatch.llm.pieces import END, Splitter, learn, portions, worker_memory

CAPACITY = 4096
END_ID = 2
SLACK = 16  # a piece may leave 1/16 of its share of a sequence empty before it is cut further


def classes(capacity: int) -> list[int]:
    """Numbers of pieces in a sequence: 1 to 16 and then in steps of about an eighth, up to ``capacity``."""
    counts = list(range(1, min(17, capacity + 1)))
    while counts[-1] < capacity:
        counts.append(min(capacity, counts[-1] + max(1, counts[-1] // 8)))
    return counts


def cut_lengths(tokens: int, capacity: int, counts: list[int]) -> list[tuple[int, int]]:
    """``length, class`` of the pieces of a document, in order.

    A rest that nearly fills its share of a sequence stays whole. Otherwise a piece that fills the next
    smaller share exactly is cut off it, and the same is asked of what is left.
    """
    pieces = [(capacity, 1)] * (tokens // capacity)
    rest, at = tokens % capacity, 0
    while rest:
        while at + 1 < len(counts) and rest <= capacity // counts[at + 1]:
            at += 1
        share = capacity // counts[at]
        if share - rest <= share // SLACK or at + 1 == len(counts):
            pieces.append((rest, counts[at]))
            break
        at += 1
        share = capacity // counts[at]
        pieces.append((share, counts[at]))
        rest -= share
    return pieces


def _load(path: str):
    from tokenizers import Tokenizer

    memory = worker_memory(f"ids {path}")
    if not memory:
        tokenizer = Tokenizer.from_file(path)
        vocab = tokenizer.get_vocab()
        memory["tokenizer"], memory["splitter"], memory["words"] = tokenizer, Splitter(tokenizer), {}
        memory["ends"] = frozenset(i for token, i in vocab.items() if token.endswith(END))
    return memory["tokenizer"], memory["splitter"], memory["ends"], memory["words"]


def _encode_pieces(pieces: list[str], tokenizer, ends: frozenset[int]) -> dict[str, list[int]]:
    """Ids of distinct pieces, encoded together as one text: each piece's last id carries the word end."""
    if not pieces:
        return {}
    found: list[list[int]] = [[]]
    for i in tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids:
        found[-1].append(i)
        if i in ends:
            found.append([])
    found.pop()
    if len(found) != len(pieces):  # a piece that the tokenizer parts further on its own
        return {p: e.ids for p, e in zip(pieces, tokenizer.encode_batch(pieces, add_special_tokens=False))}
    return dict(zip(pieces, found))


def harmonic_packing(
    df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset, class``: one row for each piece.

    Each document is its token ids and ``end_id``, cut into pieces whose lengths fill a class's share of
    the capacity nearly or exactly. The pieces of a class are numbered in the whole table by a number within
    their task and the totals of the tasks before it (a row for each task and class). ``sequence_id`` runs on over the
    classes from 0; ``offset`` adds up the pieces before it in the sequence. Only the last sequence of a class can be short of pieces.

    NULL and empty texts are the end id alone. Long texts are cut as often as needed. Repeated rows and
    keys are documents of their own, NULL keys stay NULL, an empty table gives no rows, and other
    columns are not read. Nothing is grouped by document, source or text, so none of them can be hot.
    """
    counts = classes(capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, splitter, ends, known = _load(vocabulary)
        last = array("I", [end_id]).tobytes()
        taken = dict.fromkeys(counts, 0)
        for batch in batches:
            rows, n = [], 0
            for texts in portions(batch.column(1).to_pylist()):
                cut_up = [splitter.words(t) for t in texts]
                learn(known, cut_up, splitter, lambda fresh: _encode_pieces(fresh, tokenizer, ends).items())
                for words in cut_up:
                    raw = b"".join([known[w] for w in words]) + last
                    start, total = 0, len(raw) // 4
                    for length, kind in cut_lengths(total, capacity, counts):
                        crc = zlib.crc32(raw[4 * start:4 * (start + length)])
                        rows.append((n, start, length, crc, total, kind, taken[kind]))
                        taken[kind] += 1
                        start += length
                    n += 1
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(columns[0]), *columns[1:]], names=["key", "start", "length", "crc", "tokens", "class", "number"]
            )

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, start bigint, length bigint, crc bigint, tokens bigint, class bigint, number bigint"
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # Written once, so that the tasks' numbers belong to the rows that later steps see.
    rows = cut(source.mapInArrow(run, schema).withColumn("task", F.spark_partition_id()), "pieces")
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("class", "task").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "pieces_before", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    sequences = totals.groupBy("class").agg(F.expr("(sum(n) + class - 1) div class").alias("sequences"))
    earlier = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)  # a row for each class
    first = sequences.select("class", F.coalesce(F.sum("sequences").over(earlier), F.lit(0)).alias("first"))
    starts = totals.join(F.broadcast(first), "class").select("class", "task", "pieces_before", "first")
    numbered = rows.join(starts, ["class", "task"]).withColumn("place", F.col("pieces_before") + F.col("number"))
    within = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return numbered.withColumn("sequence_id", F.col("first") + F.expr("place div class")).select(
        F.col("key").alias(key), "start", "length", F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        "sequence_id", (F.sum("length").over(within) - F.col("length")).alias("offset"), "class",
    )
