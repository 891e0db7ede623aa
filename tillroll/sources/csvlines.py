"""CSV files read in parallel: records with line breaks inside quotes, and column types found in the data.

A line break ends a record only outside quotes, which takes all quotes before it to know.  Spark deals a
file out in blocks of lines; each block's number of quotes, odd or even, comes from one pass, and a running
exclusive or over a file's blocks says which blocks begin inside quotes.  A second pass then cuts every
block into records by itself.  Records that cross block borders are put together from their pieces, at
most two a block.  No task reads more than its blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.casts import NUMBER_TEXT
from tillroll.session import stage as stage_table

# RFC 4180: quotes are doubled inside quoted values; a row that doesn't fit the header raises
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST"}
_WHOLE, _PIECE = 0, 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, file, start, block)``: the lines of the files, with the block that each begins in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    place = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return place.withColumn("block", F.xxhash64("file", "start"))


def _odd_quotes() -> Column:
    return F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))


def block_states(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, block, odd, broken, inside, unclosed)``, one row per block of the files.

    ``odd`` is the block's number of quotes modulo 2, ``broken`` whether a line of it has an odd number,
    ``inside`` whether it begins inside quotes, ``unclosed`` whether its file ends inside quotes.
    """
    per_block = (_lines(spark, path).groupBy("file", "start", "block")
                 .agg(F.bit_xor(_odd_quotes()).alias("odd"), (F.max(_odd_quotes()) > 0).alias("broken")))
    per_block = stage_table(per_block, "csv-blocks")
    of_file = Window.partitionBy("file")
    before = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(
        "*", (F.coalesce(F.bit_xor("odd").over(before), F.lit(0)) > 0).alias("inside"),
        (F.bit_xor("odd").over(of_file) > 0).alias("unclosed"))


def _text(value) -> str:
    return value.as_py() or ""


class _Cutter:
    """Cuts the lines of one block into records; lines come in file order, some at a time."""

    def __init__(self, block: int, inside: bool, first: bool):
        self.block, self.inside, self.header = block, inside, first
        self.open: list[pa.Array] = []  # lines of the record that is open
        self.continued = inside  # whether the open record began in an earlier block
        self.piece: str | None = None  # the end of such a record

    def _held(self) -> str:
        return "\n".join(_text(x) for part in self.open for x in part)

    def lines(self, values: pa.Array) -> pa.Array:
        """The records that end among these lines; a piece of an earlier block's record is kept apart."""
        odd = (pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1).astype(np.int64)
        after = (int(self.inside) + np.cumsum(odd)) & 1
        before = np.concatenate(([int(self.inside)], after[:-1]))
        self.inside = bool(after[-1])
        starts = np.flatnonzero(before == 0)
        out: list[pa.Array] = []
        front = int(starts[0]) if len(starts) else len(values)
        if front:
            self.open.append(values.slice(0, front))
            if len(starts) or not self.inside:
                out += self._close()
        if len(starts):
            stops = np.append(starts[1:], len(values))
            if self.inside:  # the last record goes on
                self.open, self.continued = [values.slice(int(starts[-1]))], False
                starts, stops = starts[:-1], stops[:-1]
            if len(starts):
                if len(starts) == int(stops[-1] - starts[0]):
                    out.append(values.slice(int(starts[0]), len(starts)))
                else:
                    cut = values.slice(0, int(stops[-1]))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, stops[-1]).astype(np.int32)), cut)
                    out.append(pc.binary_join(lists, "\n"))
        records = pa.concat_arrays(out) if out else pa.array([], pa.string())
        return self._without_header(records.filter(pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(records)), 0)))

    def _close(self) -> list[pa.Array]:
        if self.continued:
            self.piece = self._held()
            self.open, self.continued = [], False
            return []
        out = [pa.array([self._held()])]
        self.open = []
        return out

    def _without_header(self, records: pa.Array) -> pa.Array:
        if self.header and len(records):
            self.header = False
            return records.slice(1)
        return records

    def pieces(self) -> list[tuple[str, bool, bool]]:
        """(text, begins inside quotes, is the header) of the parts of records that cross the block's borders."""
        out = [] if self.piece is None else [(self.piece, True, False)]
        if self.open:
            out.append((self._held(), self.continued, self.header))
        return out


def quoted_records(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """``(value)``: the records of the files without their headers; ``states`` is from ``block_states``.

    The driver holds nine bytes per block of lines (7 MB for 100 TB in blocks of 128 MB).  A file that ends
    inside quotes raises, as does a scan whose blocks aren't those of ``states``.  Blank lines are dropped; a
    carriage return before the line's end goes with it.
    """
    states = stage_table(states, "csv-states")
    bad = states.where("unclosed").select("file").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['file']}: a quoted value doesn't end")
    table = states.select("block", "inside").toArrow()
    order = np.argsort(table.column("block").to_numpy())
    known = spark.sparkContext.broadcast((table.column("block").to_numpy()[order],
                                          table.column("inside").to_numpy(zero_copy_only=False)[order]))

    def cut(batches):
        blocks, inside = known.value
        cutter = None

        def rows(records, pieces, block):
            n, m = len(records), len(pieces)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([records.cast(pa.string()), pa.array([p[0] for p in pieces], pa.string())]),
                 pa.array([_WHOLE] * n + [_PIECE] * m, pa.int32()), pa.array([None] * n + [block] * m, pa.int64()),
                 pa.array([None] * n + [p[1] for p in pieces], pa.bool_()),
                 pa.array([None] * n + [p[2] for p in pieces], pa.bool_())],
                names=["value", "kind", "block", "continued", "header"])

        for batch in batches:
            key = batch.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))).tolist() if len(key) else []
            for a, b in zip(edges, [*edges[1:], len(key)]):
                block = int(key[a])
                if cutter is None or cutter.block != block:
                    if cutter is not None:
                        yield rows(pa.array([], pa.string()), cutter.pieces(), cutter.block)
                    at = int(np.searchsorted(blocks, block))
                    if at == len(blocks) or blocks[at] != block:
                        raise RuntimeError("the files are dealt out otherwise than when their quotes were counted; read again")
                    cutter = _Cutter(block, bool(inside[at]), batch.column(2)[a].as_py() == 0)
                records = cutter.lines(batch.column(0).slice(a, b - a))
                if len(records):
                    yield rows(records, [], block)
        if cutter is not None:
            yield rows(pa.array([], pa.string()), cutter.pieces(), cutter.block)

    found = stage_table(_lines(spark, path).select("value", "block", "start").mapInArrow(
        cut, "value string, kind int, block long, continued boolean, header boolean"), "csv-records")
    # pieces, at most two a block, in file order; a record is a piece that begins outside quotes and what goes on
    over = Window.partitionBy("file").orderBy("start", F.desc("continued"))
    pieces = (found.where(F.col("kind") == _PIECE).join(states.select("block", "file", "start"), "block")
              .withColumn("record", F.count_if(~F.col("continued")).over(over))
              .withColumn("place", F.row_number().over(over)))
    joined = (pieces.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"), F.max("header").alias("header"))
        .where("not header").select(F.array_join("parts.value", "\n").alias("value")))
    every = found.where(F.col("kind") == _WHOLE).select("value").unionByName(joined)
    return every.select(F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)"))
                        .otherwise(F.col("value")).alias("value"))


def read_text_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """The CSV files with all columns as text, named by the header of the first file.

    ``multiline`` None looks for lines with an odd number of quotes first (one more pass over the files) and
    cuts records by quotes where there are any; True always does, False never: a line break inside quotes
    then raises.  Quotes may stand only around values, and doubled inside them.  Empty values are NULL.
    """
    if multiline is False:
        return spark.read.options(**CSV_OPTIONS).csv(path)
    names = spark.read.options(**CSV_OPTIONS, multiLine=True).csv(path).columns  # reads the header alone
    states = block_states(spark, path)
    if multiline is None and states.where("broken").isEmpty():
        return spark.read.options(**CSV_OPTIONS).csv(path)
    parsed = F.from_csv("value", _ddl(names),
                        {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "maxCharsPerColumn": "-1"})
    return quoted_records(spark, path, states).select(parsed.alias("r")).select("r.*")


def _ddl(names: list[str]) -> str:
    return ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)


# types from the narrowest to the widest; a column has the first whose bit all its values have
TYPES = ("boolean", "bigint", "double", "date", "timestamp_ntz")
_DATE, _TIME = r"\d{4}-\d{2}-\d{2}", r"[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"


def possible_types(value: Column) -> Column:
    """The bit set of TYPES that a text may be; NULL may be all.  Whole numbers are doubles, dates timestamps too."""
    text = F.trim(value)
    bit = {t: 1 << i for i, t in enumerate(TYPES)}
    return (F.when(value.isNull(), F.lit(sum(bit.values())))
            .when(F.lower(text).isin("true", "false"), F.lit(bit["boolean"]))
            .when(text.rlike(r"^[+-]?\d+$") & text.try_cast("bigint").isNotNull(), F.lit(bit["bigint"] | bit["double"]))
            .when(text.rlike(NUMBER_TEXT), F.lit(bit["double"]))
            .when(text.rlike(f"^{_DATE}$") & text.try_cast("date").isNotNull(), F.lit(bit["date"] | bit["timestamp_ntz"]))
            .when(text.rlike(f"^{_DATE}{_TIME}$") & text.try_cast("timestamp_ntz").isNotNull(), F.lit(bit["timestamp_ntz"]))
            .otherwise(F.lit(0)))


def found_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Each text column's type: the narrowest that every value has, over all rows.

    One bit set per column and partition, joined by ``bit_and``: one row reaches the driver.  Columns
    without any value are text.
    """
    names = list(columns if columns is not None else df.columns)
    if not names:
        return {}
    col = lambda n: F.col("`{}`".format(n.replace("`", "``")))
    row = df.agg(*[f for i, n in enumerate(names) for f in (
        F.bit_and(possible_types(col(n))).alias(f"b{i}"), F.count(col(n)).alias(f"n{i}"))]).first()
    return {n: next((t for j, t in enumerate(TYPES) if row[f"n{i}"] and row[f"b{i}"] >> j & 1), "string")
            for i, n in enumerate(names)}


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The text columns cast to the types; columns that aren't named stay text."""
    col = lambda n: F.col("`{}`".format(n.replace("`", "``")))
    return df.select([F.trim(col(n)).cast(types[n]).alias(n) if types.get(n, "string") != "string" else col(n) for n in df.columns])


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """CSV files with a header, records cut by quotes and column types found from all rows (one more pass)."""
    text = read_text_csv(spark, path, multiline)
    return with_types(text, found_types(text))
