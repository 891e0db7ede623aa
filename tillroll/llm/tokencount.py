"""Token counts of documents in flat token files, found by their end-of-document identifiers (operator 10).

A flat token file is nothing but little-endian unsigned identifiers; documents end with the identifier
``end`` and there is no index.  ``count_tokens`` works on any such files.  ``write_flat`` makes them from
documents: text ids are stored ``SHIFT`` higher, so the low identifiers are free for control (``END``),
and each document opens with HEADER identifiers above the vocabulary that spell its doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.jobs import scratch_path
from tillroll.llm.tokens import word_ids
from tillroll.llm.words import chunks

END = 1
SHIFT = 256
# a doc_id takes 5 identifiers of 13 bits, counted up from the first identifier that no text id reaches
HEADER, HEADER_BITS, HEADER_BASE = 5, 13, 65_536 - (1 << 13)
BLOCK_TOKENS = 1 << 20
# documents of one written file: bounds the bytes that a reader of whole files holds
FILE_DOCUMENTS = 4_096
TOKEN_CHUNK = 4 << 20


def write_flat(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the documents' token files (16-bit identifiers) under ``path`` with Spark's own writer.

    Each row's bytes are its header and ids; the line separator of the text writer is the two bytes of
    END, so the files hold identifiers and nothing else.  A null doc_id gets no header.
    """
    def run(batches):
        encode = word_ids(tokenizer).encode
        for batch in batches:
            for part in chunks(batch, limit=TOKEN_CHUNK):
                ids, bounds = encode(part.column(1))
                if len(ids) and int(ids.max()) + SHIFT >= HEADER_BASE:
                    raise ValueError("the tokenizer's identifiers don't fit below the header's")
                wide = (ids + SHIFT).astype("<u2")
                out = []
                for d, a, b in zip(part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    u = None if d is None else d & (1 << 64) - 1
                    head = [] if u is None else [HEADER_BASE + (u >> HEADER_BITS * i & (1 << HEADER_BITS) - 1)
                                                 for i in range(HEADER)]
                    out.append(np.array(head, "<u2").tobytes() + wide[a:b].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["raw"])

    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "raw binary")
    (raw.select(F.col("raw").cast("string").alias("value")).write.option("lineSep", END.to_bytes(2, "little").decode())
     .option("compression", "none").option("maxRecordsPerFile", FILE_DOCUMENTS).text(path))


def count_tokens(spark: SparkSession, path: str, end: int = END, width: int = 2, header: int = 0,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(path, document, start, n_tokens, header, closed)``, one row per document of the flat files.

    ``document`` counts from 0 within its file, ``start`` is the place of its first identifier,
    ``n_tokens`` leaves out ``end`` and up to ``header`` identifiers at the front, which come back as
    ``header``.  Files are cut into blocks of ``block_tokens``; a vectorised comparison finds the ends
    in a block.  A running maximum of the last end over the blocks before it and a running count of
    ends tell each block where its first document began and which number it has, so documents may
    span any number of blocks.  Identifiers after a file's last end are an open document
    (``closed`` false); an empty file has none.  A file of a length that ``width`` does not divide
    raises an error.
    """
    if block_tokens < max(1, header):
        raise ValueError("a block must hold a header")
    size = width * block_tokens
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    blocks = (files.select("path", "content", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block"))
        .select("path", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias("raw")))
    dtype = {2: "<u2", 4: "<u4"}[width]
    fields = ["path", "block", "tokens", "place", "ends", "head", "tail"]

    def scan(batches):
        for batch in batches:
            for path_, block, raw in zip(*(batch.column(i) for i in range(3))):
                view = memoryview(raw.as_buffer())
                if len(view) % width:
                    raise ValueError(f"{path_}: the length is no multiple of {width}")
                ids = np.frombuffer(view, dtype)
                at = np.flatnonzero(ids == end).astype(np.int64)
                first = block.as_py() * block_tokens
                openings = [ids[p + 1:p + 1 + header].tolist() for p in at.tolist()] if header else [[]] * len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path_.as_py()]), pa.array([block.as_py()]), pa.array([len(ids)], pa.int64()),
                     pa.array([(at + first).tolist()], pa.list_(pa.int64())), pa.array([len(at)], pa.int64()),
                     pa.array([ids[:header].tolist()], pa.list_(pa.int32())),
                     pa.array([openings], pa.list_(pa.list_(pa.int32())))], names=fields)

    found = blocks.mapInArrow(scan, "path string, block long, tokens long, place array<long>, ends long, "
                                    "head array<int>, tail array<array<int>>")
    ahead = Window.partitionBy("path").orderBy("block")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    # per block: where the document that is open at its first identifier began, and its first identifiers
    begun = (found
             .withColumn("next", F.lead("head").over(ahead))
             .withColumn("opened", F.when(F.col("ends") > 0, F.struct(
                 (F.element_at("place", -1) + 1).alias("start"),
                 F.slice(F.concat(F.element_at("tail", -1), F.coalesce("next", F.array().cast("array<int>"))), 1,
                         max(1, header)).alias("header"))))
             .withColumn("opened", F.last("opened", ignorenulls=True).over(before))
             .withColumn("opening", F.first("head").over(before))
             .withColumn("number", F.coalesce(F.sum("ends").over(before), F.lit(0)))
             .withColumn("last", F.col("next").isNull())
             .withColumn("start", F.coalesce("opened.start", F.lit(0).cast("long")))
             .withColumn("front", F.coalesce("opened.header", "opening", "head"))
             .withColumn("stop", F.col("block") * block_tokens + F.col("tokens")))
    # starts and headers of the documents that end in this block, then of the one left open at the file's end
    starts = F.concat(F.array("start"), F.transform("place", lambda p: p + 1))
    fronts = F.concat(F.array("front"), F.col("tail"))
    stops = F.concat("place", F.when(F.col("last"), F.array("stop")).otherwise(F.array().cast("array<long>")))
    docs = begun.select("path", "number", "ends", F.posexplode(F.arrays_zip(
        stops.alias("stop"), F.slice(starts, F.lit(1), F.size(stops)).alias("start"),
        F.slice(fronts, F.lit(1), F.size(stops)).alias("header"))).alias("i", "d"))
    # a header ends where its document ends
    own = F.when(F.lit(header) > 0, F.slice("d.header", F.lit(1), F.least(
        F.lit(max(1, header)).cast("long"), F.col("d.stop") - F.col("d.start")).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    return (docs.select("path", (F.col("number") + F.col("i")).alias("document"), F.col("d.start").alias("start"),
                        (F.col("d.stop") - F.col("d.start")).alias("length"), own.alias("header"),
                        (F.col("i") < F.col("ends")).alias("closed"))
            .where("closed or length > 0")
            .select("path", "document", "start", (F.col("length") - F.size("header")).alias("n_tokens"), "header", "closed"))


def document_tokens(docs: DataFrame, tokenizer: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(doc_id, n_tokens, file, document)`` per row of ``docs``: written as flat files, then counted there.

    Null and empty texts have 0 tokens; a null doc_id comes back null; repeated rows come back as often;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "flat")
    write_flat(docs, path, tokenizer)
    counted = count_tokens(spark, path, header=HEADER, block_tokens=block_tokens)
    # a document without a doc_id has no header: its first identifiers lie below the header's range
    is_head = F.expr(f"size(header) = {HEADER} and forall(header, x -> x >= {HEADER_BASE})")
    digits = [F.shiftleft((F.col("header")[i] - HEADER_BASE).cast("long"), HEADER_BITS * i) for i in range(HEADER)]
    doc_id = digits[0]
    for d in digits[1:]:
        doc_id = doc_id.bitwiseOR(d)
    return counted.select(
        F.when(is_head, doc_id).alias("doc_id"),
        F.when(is_head, F.col("n_tokens")).otherwise(F.col("n_tokens") + F.size("header")).alias("n_tokens"),
        F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "document")
