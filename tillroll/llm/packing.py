"""Best-fit packing of token sequences: length patterns fitted by non-negative least squares (operator 9)."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.jobs import write_stage
from tillroll.llm.tokens import word_ids
from tillroll.llm.words import chunks

# length bins of the pattern fit: patterns are enumerated over bins, so their number stays fixed
BINS = 256
# pieces of one length that are numbered together
RANK_ROWS = 512
# text handled at once; its words, their codes and their ids take many times its bytes, smaller chunks more time
TOKEN_CHUNK = 4 << 20


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 1, chunk: int = TOKEN_CHUNK) -> DataFrame:
    """``(doc_id, copy, piece, start, length, ids_crc32)``: token sequences cut at ``capacity``."""
    def run(batches):
        encode = word_ids(tokenizer).encode
        for batch in batches:
            for part in chunks(batch, limit=chunk):
                ids, bounds = encode(part.column(1))
                doc, copy, piece, start, length, crc = [], [], [], [], [], []
                end = np.array([end_id], "<u4").tobytes()
                for d, c, a, b in zip(part.column(0).to_pylist(), part.column(2).to_pylist(),
                                      bounds[:-1].tolist(), bounds[1:].tolist()):
                    raw = ids[a:b].astype("<u4").tobytes() + end
                    for s in range(0, b - a + 1, capacity):
                        cut = raw[4 * s:4 * (s + capacity)]
                        doc.append(d)
                        copy.append(c)
                        piece.append(s // capacity)
                        start.append(s)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(copy, pa.int64()), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "copy", "piece", "start", "length", "ids_crc32"])
                del part, ids, bounds
            del batch  # a batch's texts are not held while the next one is read

    # rows may repeat a doc_id; the copy number only keeps them apart and is fixed by the stored result
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("copy")).mapInArrow(
        run, "doc_id long, copy long, piece int, start long, length long, ids_crc32 long")


def non_negative_fit(columns: np.ndarray, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
    """x >= 0 minimising ||W (A x - target)||, by the active-set method on the normal equations.

    Column j of A counts the bins in ``columns[j]`` (entries of -1 are unused).
    """
    n_bins, n = len(target), len(columns)
    x, active = np.zeros(n), []
    free = np.zeros(n, bool)
    dense = np.zeros((n_bins, 0))
    scale = weights ** 2
    residual = target.astype(float).copy()
    valid = columns >= 0
    for _ in range(4 * n_bins):
        slope = np.where(valid, (scale * residual)[columns], 0.0).sum(axis=1)
        slope[free] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= 1e-7 * max(1.0, float((scale * target).max(initial=0))):
            break
        col = np.bincount(columns[j][valid[j]], minlength=n_bins).astype(float)
        active.append(j)
        free[j] = True
        dense = np.hstack([dense, col[:, None]])
        while active:
            weighted = dense * weights[:, None]
            gram = weighted.T @ weighted + 1e-9 * np.eye(len(active))
            s = np.linalg.solve(gram, weighted.T @ (weights * target))
            if s.min() > 0:
                x[active] = s
                break
            cur = x[active]
            low = s <= 0
            step = float(np.min(cur[low] / np.maximum(cur[low] - s[low], 1e-300)))
            cur = cur + step * (s - cur)
            keep = cur > 1e-9
            keep[low & (cur <= 1e-9)] = False
            if keep.all():
                keep[int(np.argmin(cur))] = False
            x[active] = np.where(keep, cur, 0.0)
            free[[a for a, k in zip(active, keep) if not k]] = False
            active = [a for a, k in zip(active, keep) if k]
            dense = dense[:, keep]
        residual = target - (dense @ x[active] if active else 0.0)
    return x


def patterns(present: np.ndarray, total: int) -> np.ndarray:
    """All bin patterns of one to three documents that sum to ``total``, among the bins present."""
    bins = np.flatnonzero(present)
    out = [(total, -1, -1)] if total < len(present) and present[total] else []
    for a in bins[bins > 0].tolist():
        for b in bins[(bins > 0) & (bins <= a)].tolist():
            rest = total - a - b
            if rest == 0:
                out.append((a, b, -1))
            elif 0 < rest <= b and present[rest]:
                out.append((a, b, rest))
    return np.array(out, np.int64).reshape(-1, 3)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups ``(repeats, [(length, times), ...])`` that hold every counted length exactly once.

    Patterns of one to three documents over length bins are fitted to the histogram by non-negative
    least squares, their repeat counts rounded and cut to what is there.  Within a bin the longest of
    one part meet the shortest of the next, which evens out the sums.  What is left goes, longest
    first, into the fullest group it fits, then into new sequences.  The work depends on the number
    of lengths, not of documents.
    """
    width = -(-capacity // BINS)
    bins: dict[int, list[list[int]]] = {}
    for length in sorted(histogram):
        if histogram[length] > 0:
            bins.setdefault(-(-length // width), []).append([length, histogram[length]])
    count = np.zeros(capacity // width + 2, np.int64)
    for b, runs in bins.items():
        count[b] = sum(n for _, n in runs)
    spaces: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    order: list[int] = []

    def put(repeats: int, runs: list[tuple[int, int]]) -> None:
        space = capacity - sum(length * times for length, times in runs)
        if space not in spaces:
            spaces[space] = []
        if not spaces[space]:
            bisect.insort(order, space)
        spaces[space].append((repeats, runs))

    def take(b: int, n: int, longest: bool) -> list[list[int]]:
        got = []
        while n:
            run = bins[b][-1 if longest else 0]
            part = min(n, run[1])
            got.append([run[0], part])
            run[1] -= part
            n -= part
            if not run[1]:
                bins[b].pop(-1 if longest else 0)
        return got

    columns = patterns(count > 0, capacity // width) if capacity % width == 0 else np.zeros((0, 3), np.int64)
    if len(columns):
        fit = non_negative_fit(columns, np.arange(len(count), dtype=float), count)
        for j in np.argsort(-fit, kind="stable").tolist():
            parts = [int(b) for b in columns[j] if b >= 0]
            repeats = min([int(fit[j] + 0.5)] + [int(count[b]) // parts.count(b) for b in parts])
            if repeats <= 0:
                continue
            runs = []
            for i, b in enumerate(parts):
                count[b] -= repeats
                runs.append(take(b, repeats, longest=i % 2 == 0))
            at = [0] * len(runs)
            while repeats:
                n = min(r[i][1] for r, i in zip(runs, at))
                put(n, [(r[i][0], 1) for r, i in zip(runs, at)])
                repeats -= n
                for k, r in enumerate(runs):
                    r[at[k]][1] -= n
                    at[k] += not r[at[k]][1]
    left = sorted(((length, n) for runs in bins.values() for length, n in runs if n), reverse=True)
    for length, n in left:
        while n:
            i = bisect.bisect_left(order, length)
            if i == len(order):
                fit_in = capacity // length
                if n >= fit_in:
                    put(n // fit_in, [(length, fit_in)])
                    n %= fit_in
                else:
                    put(1, [(length, n)])
                    n = 0
                continue
            space = order[i]
            repeats, runs = spaces[space].pop()
            if not spaces[space]:
                order.pop(i)
            times = min(n, space // length)
            full = min(repeats, n // times)
            if repeats > full:
                put(repeats - full, runs)
            put(full, [*runs, (length, times)])
            n -= full * times
    return [g for s in sorted(spaces) for g in spaces[s]]


def _intervals(groups: Iterable[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, times, offset), sorted by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, runs in groups:
        offset = 0
        for length, times in runs:
            rows.append((length, used.get(length, 0), sequence, times, offset))
            used[length] = used.get(length, 0) + repeats * times
            offset += length * times
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, chunk: int = TOKEN_CHUNK) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    A document's tokens are its text's ids and then ``end_id``; longer documents are cut into pieces
    of ``capacity``.  Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the
    driver, which plans the patterns; every piece then finds its place from its length and its number
    among the pieces of that length.  Pieces of a common length are numbered in small blocks whose
    counts are summed up first, so no length is sorted in one task.

    Null and empty texts are one piece of the end token.  Repeated rows are packed once per row; a null
    doc_id stays null.  An empty table gives an empty result.  Other columns are ignored.

    A worker handles about ``chunk`` bytes of text at once; smaller chunks take less memory and more time.
    """
    spark = docs.sparkSession
    cut = write_stage(pieces(docs, tokenizer, capacity, end_id, chunk), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    intervals = _intervals(plan(histogram, capacity))
    table = spark.sparkContext.broadcast((intervals, intervals[:, 0] << 42 | intervals[:, 1]))
    blocks = F.array(*[F.lit(max(1, -(-histogram.get(i, 0) // RANK_ROWS))) for i in range(capacity + 1)])
    numbered = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "copy", "piece"),
                                              F.element_at(blocks, F.col("length").cast("int") + 1).cast("long")))
    sizes = write_stage(numbered.groupBy("length", "block").agg(F.count("*").alias("n")), "sizes")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = write_stage(sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
                         "firsts")
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "copy")
    ranked = (numbered.withColumn("r", F.row_number().over(inside)).join(firsts, ["length", "block"])
              .withColumn("rank", F.col("first") + F.col("r") - 1)
              .select("doc_id", "piece", "start", "length", "ids_crc32", "rank"))

    def place(batches):
        rows, keys = table.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            got = rows[np.searchsorted(keys, length << 42 | rank, side="right") - 1]
            inner = rank - got[:, 1]
            sequence = got[:, 2] + inner // got[:, 3]
            offset = got[:, 4] + inner % got[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32",
                                                    "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
