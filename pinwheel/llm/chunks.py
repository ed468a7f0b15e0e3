"""Document fingerprints by content-defined chunking.

A gear hash (each byte shifts the hash left by one and adds a random word of its own) of 32
bits depends on the last 32 bytes only, so all of a text's hashes come from five doubling
steps on arrays. A chunk ends at the first hash with ``STRICT`` zero bits from ``SMALLEST``
bytes on, from ``NORMAL`` bytes on with ``LOOSE`` ones (normalised chunking), at the latest
after ``LARGEST``. An edit moves the boundaries near it only. The fingerprint is the set of
chunk digests with their lengths in bytes; the likeness of A to B is the share of A's bytes,
each digest counted once, whose digest B has (containment).

``edited_neighbours`` compares every text with its edited form and with its successor in
descending id order. Rows are sorted by range in one shuffle: cut points come from a pass
over ids alone and are constants from then on, and the first row of every range goes to the
end of the range before it as well, so each task finds all successors it needs.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pinwheel.llm.common import column, map_text, slices, texts_of

SMALLEST, NORMAL, LARGEST = 32, 48, 192
STRICT, LOOSE = 6, 4
DIGEST_DIGITS = 12
#: One random 32-bit word per byte value.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "big") for b in range(256)], np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """The gear hash after every byte: the sum of gear[b] << age over the last 32 bytes."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < 32 and step < len(h):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """Chunk ends, the last one at the end of the data."""
    size = len(data)
    if size <= SMALLEST:
        return [size] if size else []
    top = gear_hashes(data) >> np.uint32(32 - STRICT)
    strict = (np.flatnonzero(top == 0) + 1).tolist()
    loose = (np.flatnonzero(top < 1 << (STRICT - LOOSE)) + 1).tolist()
    ends, start, i, j, ns, nl = [], 0, 0, 0, len(strict), len(loose)
    while size - start > SMALLEST:
        end = 0
        i = bisect.bisect_left(strict, start + SMALLEST, i)
        if i < ns and strict[i] < start + NORMAL:
            end = strict[i]
        else:
            j = bisect.bisect_left(loose, start + NORMAL, j)
            end = loose[j] if j < nl and loose[j] <= start + LARGEST else start + LARGEST
        if end >= size:
            break
        ends.append(end)
        start = end
    ends.append(size)
    return ends


def chunk_set(text: str) -> dict[str, int]:
    """Digest -> length in bytes of the chunks of a text."""
    import xxhash
    data = text.encode("utf-8", "surrogatepass")
    out, start, digest = {}, 0, xxhash.xxh3_64_hexdigest
    for end in boundaries(data):
        out[digest(data[start:end])[:DIGEST_DIGITS]] = end - start
        start = end
    return out


def fingerprint_string(chunks: dict[str, int]) -> str:
    """Equal for equal sets: ``digest:length`` in digest order."""
    return " ".join([f"{d}:{n}" for d, n in sorted(chunks.items())])


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of the bytes of ``a`` whose digest ``b`` has; nothing is only contained in nothing."""
    if not a:
        return 0.0 if b else 1.0
    return sum([n for d, n in a.items() if d in b]) / sum(a.values())


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``chunks`` array<struct<digest, length>> of every row, by digest. A null
    text counts as empty and has no chunks. No shuffle."""
    id_type = dict(df.dtypes)[id_col]
    source = df.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))

    def start():
        def work(piece):
            sets = [sorted(chunk_set(t).items()) for t in texts_of(piece)]
            kind = pa.list_(pa.struct([("digest", pa.string()), ("length", pa.int32())]))
            return [column(piece, "doc"), pa.array([[{"digest": d, "length": n} for d, n in s] for s in sets], kind)]
        return work

    return map_text(source, f"doc {id_type}, chunks array<struct<digest:string,length:int>>", start).withColumnRenamed("doc", id_col)


def edited(text: str, successor: str) -> str:
    """The last third (rounded down) replaced by as many first code points of the successor."""
    third = len(text) // 3
    return text[:len(text) - third] + successor[:third]


RESULT = ("doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(doc, text: str, chunks: dict, successor: str, next_chunks: dict) -> tuple:
    new = edited(text, successor)
    new_chunks = chunk_set(new)
    return (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint_string(chunks),
            fingerprint_string(new_chunks), containment(chunks, new_chunks), containment(chunks, next_chunks))


def _paired(batches):
    """Rows of whole ranges in order, each with its successor: the next row of its range; the
    range's last row takes the first guest (a copy of the row that begins the next range)."""
    schema = pa.schema([("doc", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held = None  # (range, id, text, chunks) that waits for its successor
    for batch in batches:
        for piece in slices(batch, "text"):
            done = []
            ranges, docs, guests = (column(piece, c).to_pylist() for c in ("range", "doc", "guest"))
            for rng, doc, guest, text in zip(ranges, docs, guests, texts_of(piece)):
                if guest and held is None:
                    continue  # a further copy of a successor already used
                chunks = chunk_set(text)
                if held is not None:
                    done.append(_compare(*held[1:], text, chunks))
                held = None if guest else (rng, doc, text, chunks)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with n_chars, the digest of its edited text, both fingerprints, near_edited
    and near_next.

    The successor is the next row by id in descending order, nulls last, equal ids by md5 of
    the text; the last row's successor is the first row (a single row is its own). A null text
    counts as empty. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc = F.col(id_col).cast("long")
    order = F.struct(doc.isNull().alias("no_id"), F.negative(F.coalesce(doc, F.lit(0))).alias("down"), F.md5(text.cast("binary")).alias("md5"))
    # Cut points: the first key of every part of the sorted ids, one row per partition.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(order.alias("k")).repartitionByRange(parts, "k")
    firsts = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min("k").alias("k")).select("k").collect()
    cuts = sorted((r.k.no_id, r.k.down, r.k.md5) for r in firsts)
    if not cuts:
        return spark.createDataFrame([], RESULT).withColumnRenamed("doc", id_col)

    def dealt(batches):
        schema = pa.schema([("range", pa.int32()), ("guest", pa.bool_()), ("no_id", pa.bool_()), ("down", pa.int64()), ("md5", pa.string()),
                            ("doc", pa.int64()), ("text", pa.string())])
        guests = {}  # of this task: at most one per cut point
        for batch in batches:
            no_id, down, md5 = (column(batch, c).to_pylist() for c in ("no_id", "down", "md5"))
            rows = list(zip(no_id, down, md5))
            for k, key in enumerate(rows):
                at = bisect.bisect_left(cuts, key)
                if at < len(cuts) and cuts[at] == key and at not in guests:
                    guests[at] = (column(batch, "doc")[k].as_py(), column(batch, "text")[k].as_py())
            place = pa.array([bisect.bisect_right(cuts, key) - 1 for key in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([place, pa.array([False] * len(rows)), *(column(batch, c) for c in schema.names[2:])], schema=schema)
        if guests:
            at = sorted(guests)
            ranges = [(k - 1) % len(cuts) for k in at]
            cols = [ranges, [True] * len(at), *(list(c) for c in zip(*(cuts[k] for k in at))), *(list(c) for c in zip(*(guests[k] for k in at)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    rows = docs.select(order.alias("k"), doc.alias("doc"), text.alias("text")).select("k.*", "doc", "text")
    ranged = rows.mapInArrow(dealt, "range int, guest boolean, no_id boolean, down long, md5 string, doc long, text string") \
        .repartitionById(len(cuts), F.col("range")).sortWithinPartitions("range", "guest", "no_id", "down", "md5")
    return ranged.mapInArrow(_paired, RESULT).withColumnRenamed("doc", id_col)
