"""Helpers shared by the operators: batches of text in tasks, reliable intermediate tables."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pinwheel.session import checkpoint_dir

# A word is a run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
# A task works on slices of at most this many text bytes (one row at least).
SLICE_BYTES = 4 << 20


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id):
    """crc32 of the id as text leaves remainder 2 by 4 (null ids: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: its lineage ends there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES):
    """Consecutive slices of a batch with at most ``limit`` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Return freed memory to the system. Python workers live on between tasks, and what one
    operator's tasks have freed would otherwise count beside what the next one's take."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_text(df: DataFrame, schema: str, start, text: str = "text") -> DataFrame:
    """``mapInArrow`` over bounded slices.

    ``start()`` runs once per task and returns ``work(slice) -> list of Arrow arrays or
    lists``, one per column of ``schema``. ``text`` names the column that bounds a slice.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = start()
        for batch in batches:
            for piece in slices(batch, text):
                cols = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
                        for c, f in zip(work(piece), out)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c
                                                  for c, f in zip(cols, out)], schema=out)
        batch = piece = cols = work = None
        give_back()

    return df.mapInArrow(run, schema)


def texts_of(piece: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a slice; null counts as empty."""
    return [t or "" for t in piece.column(piece.schema.get_field_index(name)).to_pylist()]


def column(piece: pa.RecordBatch, name: str) -> pa.Array:
    return piece.column(piece.schema.get_field_index(name))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)


def lowest_ids(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """``doc``, ``by`` and ``rank`` (md5 of the id) of the ``limit`` distinct ids of lowest rank
    for every value of ``by``, a classifier's label (so there are few values).

    Ranks are uniform, so a cut at four times the share asked for leaves about ``4 * limit``
    ids of each label, however many there are; only those are sorted.
    """
    ranked = rows.select("doc", by, F.md5(F.col("doc").cast("string").cast("binary")).alias("rank"))
    sizes = ranked.groupBy(by).agg(F.approx_count_distinct("rank").alias("n")).collect()
    if not sizes:
        return ranked
    cuts = F.create_map(*[x for r in sizes for x in (F.lit(r[by]), F.lit(min(1.0, 4 * limit / max(r.n, 1))))])
    place = F.conv(F.substring("rank", 1, 8), 16, 10).cast("double") / float(1 << 32)
    low = ranked.where(place <= cuts[F.col(by)]).distinct()
    order = W.partitionBy(by).orderBy("rank", "doc")
    return low.withColumn("n", F.row_number().over(order)).where(F.col("n") <= limit).drop("n")
