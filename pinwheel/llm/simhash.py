"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: A-Z are lowered, words are runs without ASCII white space, and each shingle of
``SHINGLE`` words (repeats included, joined by one blank; a shorter text is one shingle) is
hashed by XXH64. A bit is set if more than half of the hashes have it. No word: zero.

Links: texts whose fingerprints differ in at most ``MAX_BITS`` bits. Equal fingerprints are
one vertex from the start. The 64 bits are divided into m partitions, correlated bits
together, and partition i gets a threshold t_i >= -1 with sum(t_i) = MAX_BITS - m + 1: two
linked fingerprints differ in at most t_i bits of some partition i, or else they would
differ in more bits altogether. Dynamic programming picks the thresholds (and m) of least
estimated cost, from statistics of all fingerprints: pairs that agree in a partition are
counted, and the bits' odds to differ extend the count to larger thresholds. Every
fingerprint is indexed by its bits in each partition, probes the values within t_i bits, and
candidates are verified on all 64 bits.

An index entry with more than ``CROWDED`` fingerprints isn't paired up: a probe that meets it
instead names every fingerprint that is still close enough (at most 1 + r + r(r-1)/2 for r
other bits) and looks those up, which loses nothing and costs the same however full it is.

Components: alternating large-star and small-star steps on the links, each step saved to the
shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pinwheel.llm.common import column, map_text, saved, texts_of

SHINGLE, SEED, MAX_BITS, BITS = 3, 42, 2, 64
PARTITION_COUNTS = (2, 3, 4)
CROWDED = 512
# Characters whose shingles are hashed together (one text at least): bounds the memory of one pass.
HASHED_CHARS = 1 << 19
_LOWER = bytes(range(256)).lower()


def fingerprints(texts: list[str], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Signed 64-bit fingerprints of whole texts, some texts at a time."""
    ends = np.cumsum([len(t) for t in texts])
    cuts = np.flatnonzero(np.diff(ends // HASHED_CHARS)) + 1
    parts = np.split(np.arange(len(texts)), cuts) if texts else []
    return np.concatenate([np.zeros(0, np.int64), *[_fingerprints([texts[i] for i in p], shingle, seed) for p in parts]])


def _fingerprints(texts: list[str], shingle: int, seed: int) -> np.ndarray:
    import xxhash
    digest = xxhash.xxh64_digest
    hashes, counts = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if len(words) <= shingle:
            hashes += [digest(b" ".join(words), seed)] if words else []
            counts.append(min(len(words), 1))
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - shingle + 1].tolist()
        hashes += [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:].tolist())]
        counts.append(len(starts))
    counts = np.array(counts, np.int64)
    out = np.zeros((len(texts), 8), np.uint8)
    has = np.flatnonzero(counts)
    if len(has):
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, (np.cumsum(counts) - counts)[has], axis=0, dtype=np.int32)
        out[has] = np.packbits(2 * ones > counts[has, None], axis=1)
    return out.view(">u8").ravel().astype(np.uint64).view(np.int64)


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc``, ``text_md5`` and ``fingerprint`` (long) of every row. A null text counts as empty."""
    id_type = dict(df.dtypes)[id_col]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.col(id_col).alias("doc"), F.md5(text.cast("binary")).alias("text_md5"), text.alias("text"))

    def start():
        def work(piece):
            return [column(piece, "doc"), column(piece, "text_md5"), fingerprints(texts_of(piece), shingle, seed)]
        return work

    return map_text(source, f"doc {id_type}, text_md5 string, fingerprint long", start)


# ---- partitions and thresholds ----

@dataclass
class Plan:
    """Bits of each partition (0 is the lowest) and its threshold."""
    parts: list[list[int]]
    thresholds: list[int]


def bit_sums(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each pair of bits how many have both set."""
    def run(batches):
        total, both = 0, np.zeros((BITS, BITS), np.int64)
        for b in batches:
            f = column(b, "fingerprint").to_numpy(zero_copy_only=False).astype(np.int64)
            for k in range(0, len(f), 1 << 16):
                x = (f[k:k + (1 << 16), None] >> np.arange(BITS) & 1).astype(np.float32)
                both += (x.T @ x).astype(np.int64)
                total += len(x)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.append(i, -1), pa.int32()), "j": pa.array(np.append(j, -1), pa.int32()),
                                          "n": pa.array(np.append(both[i, j], total), pa.int64())})

    rows = prints.select("fingerprint").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, total = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r.i < 0:
            total = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    return total, both


def grouped_bits(total: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m equal groups of bits: each starts from the free bit most correlated with the other
    free ones and takes the free bit most correlated with its members; ties: the lowest bit."""
    p = np.diag(both) / max(total, 1)
    cov = both / max(total, 1) - np.outer(p, p)
    scale = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    near = np.abs(cov / scale).round(6)
    np.fill_diagonal(near, 0)
    free, parts = list(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        part = [max(free, key=lambda b: (near[b, free].sum().round(6), -b))]
        free.remove(part[0])
        while len(part) < size:
            nxt = max(free, key=lambda b: (near[b, part].sum().round(6), -b))
            part.append(nxt)
            free.remove(nxt)
        parts.append(sorted(part))
    return parts


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def mask_of(bits) -> int:
    return signed(sum(1 << b for b in bits))


def agreeing_pairs(prints: DataFrame, groups: list[list[int]]) -> list[int]:
    """For each group of bits, how many pairs of fingerprints agree in it."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fingerprint").bitwiseAND(F.lit(mask_of(g)).cast("long")).alias("v"))
                                 for k, g in enumerate(groups)]))
    rows = prints.select(values.alias("x")).groupBy("x.k", "x.v").count() \
        .groupBy("k").agg(F.sum(F.col("count").cast("decimal(38,0)") * (F.col("count") - 1) / 2).cast("double").alias("pairs")).collect()
    found = {r.k: r.pairs for r in rows}
    return [found.get(k, 0.0) for k in range(len(groups))]


def estimates(pairs: float, part: list[int], p: np.ndarray, top: int) -> list[float]:
    """Estimated cost of thresholds 0 to ``top`` (candidates): a pair that agrees in the other
    bits differs in bit b with odds q/(1-q), q = 2p(1-p)."""
    q = np.clip(2 * p[part] * (1 - p[part]), 1e-6, 0.5)
    odds, sums = q / (1 - q), [1.0] + [0.0] * top
    for o in odds:  # elementary symmetric polynomials
        for k in range(top, 0, -1):
            sums[k] += sums[k - 1] * o
    return [pairs * sum(sums[:t + 1]) for t in range(top + 1)]


def variants(bits: int, t: int) -> int:
    """How many values lie within t bits of a value of ``bits`` bits."""
    return sum(len(list(combinations(range(bits), k))) for k in range(t + 1))


def allocated(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of the partitions, each from -1 on, that add up to ``total`` at least cost;
    ``costs[i][t + 1]`` is partition i's cost at t. Dynamic programming over partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for have, (cost, chosen) in best.items():
            for t in range(-1, len(row) - 1):
                entry = (cost + row[t + 1], [*chosen, t])
                if have + t not in step or entry < step[have + t]:
                    step[have + t] = entry
        best = step
    return best[total]


def choose_plan(prints: DataFrame, max_bits: int = MAX_BITS) -> Plan:
    """Partitions and thresholds of least cost: probes of all fingerprints plus candidates."""
    total, both = bit_sums(prints)
    p = np.diag(both) / max(total, 1)
    options = [grouped_bits(total, both, m) for m in PARTITION_COUNTS if m <= max_bits + 2]
    counted = iter(agreeing_pairs(prints, [g for parts in options for g in parts]))
    best = None
    for parts in options:
        costs = []
        for part in parts:
            guess = estimates(next(counted), part, p, max_bits)
            costs.append([0.0] + [guess[t] + total * (1 + variants(len(part), t)) for t in range(max_bits + 1)])
        cost, thresholds = allocated(costs, max_bits - len(parts) + 1)
        if best is None or cost < best[0]:
            best = (cost, Plan(parts, thresholds))
    return best[1]


# ---- probing and verifying ----

def _flips(bits: list[int], t: int) -> list[tuple[int, int]]:
    """(mask, bits in it) of all changes of at most t of the bits."""
    return [(mask_of(c), k) for k in range(t + 1) for c in combinations(bits, k)]


def _flip_array(flips) -> F.Column:
    return F.array(*[F.struct(F.lit(m).cast("long").alias("flip"), F.lit(k).alias("used")) for m, k in flips])


def links(prints: DataFrame, plan: Plan, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most ``max_bits`` bits.

    ``prints``: one row per distinct ``fingerprint``. A pair may come more than once.
    """
    active = [(k, part, t) for k, (part, t) in enumerate(zip(plan.parts, plan.thresholds)) if t >= 0]
    f = F.col("fingerprint")

    def value(part):
        return f.bitwiseAND(F.lit(mask_of(part)).cast("long"))

    index = prints.select(f, F.explode(F.array(*[F.struct(F.lit(k).alias("part"), value(p).alias("value")) for k, p, _ in active])).alias("x")) \
        .select(f.alias("b"), "x.part", "x.value")
    probes = None
    for k, part, t in active:
        rows = prints.select(f.alias("a"), F.lit(k).alias("part"), value(part).alias("own"), F.explode(_flip_array(_flips(part, t))).alias("x")) \
            .select("a", "part", F.col("own").bitwiseXOR(F.col("x.flip")).alias("value"), F.col("x.used").alias("used"))
        probes = rows if probes is None else probes.unionByName(rows)
    full = saved(index.groupBy("part", "value").count().where(F.col("count") > crowded).select("part", "value"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    if full.isEmpty():
        return probes.join(index, ["part", "value"]).where((F.col("a") < F.col("b")) & close).select("a", "b")
    plain = probes.join(index.join(full, ["part", "value"], "left_anti"), ["part", "value"]) \
        .where((F.col("a") < F.col("b")) & close).select("a", "b")
    met, found = probes.join(full, ["part", "value"], "left_semi"), plain
    for k, part, t in active:
        rest = [b for b in range(BITS) if b not in set(part)]
        for used in range(t + 1):
            named = met.where((F.col("part") == k) & (F.col("used") == used)) \
                .select("a", F.col("value").bitwiseOR(F.col("a").bitwiseAND(F.lit(mask_of(rest)).cast("long"))).alias("base"),
                        F.explode(_flip_array(_flips(rest, max_bits - used))).alias("x")) \
                .select("a", F.col("base").bitwiseXOR(F.col("x.flip")).alias("b")).where(F.col("a") < F.col("b"))
            found = found.unionByName(named.join(prints.select(f.alias("b")), "b", "left_semi").select("a", "b"))
    return found


# ---- components ----

def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex`` and ``root`` (the smallest vertex it reaches) for every vertex of an edge."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    state = saved(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _signature(state)
    while mark[0]:
        # Large star: every larger neighbour of u is tied to the smallest of u and its neighbours.
        ways = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Saved, so that the join has two exchanges and a crowded u can be split between tasks.
        low = saved(ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")))
        large = ways.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        large = saved(large)
        low = saved(large.groupBy("u").agg(F.min("v").alias("low")))
        tied = large.join(low, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        state = saved(tied.unionByName(low.select("u", F.col("low").alias("v"))).distinct())
        now = _signature(state)
        if now == mark:
            break
        mark = now
    leaves = state.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return leaves.unionByName(state.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())


def _signature(edges: DataFrame) -> tuple:
    """Tells edge sets apart: their number and two sums of hashes."""
    h = F.xxhash64("u", "v")
    r = edges.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"),
                  F.sum(F.xxhash64(h, F.lit(1)).cast("decimal(20,0)")).alias("t")).first()
    return r.n, r.s, r.t


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """``doc``, ``text_md5``, ``fingerprint`` (long) and ``root`` (long) of every row: rows with
    the same root are linked, directly or through others.

    Null or wordless texts have fingerprint 0 and are linked like any other. Repeated rows are
    returned as often as they come. An empty table gives an empty result.
    """
    marked = saved(simhash(df, id_col, text_col, shingle, seed))
    prints = saved(marked.select("fingerprint").distinct())
    found = saved(links(prints, choose_plan(prints, max_bits), max_bits))
    roots = components(found).withColumnsRenamed({"vertex": "fingerprint"})
    return marked.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def simhash_components(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable (null
    ids don't count; null if a component has no other)."""
    linked = saved(near_duplicates(df))
    lowest = saved(linked.groupBy("root").agg(F.min("doc").alias("component_id")))
    out = linked.join(lowest, "root")
    return out.select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the lowest id (nulls last), then of the
    lowest md5 of the text; of equal such rows the lowest by the other columns as JSON. Columns
    unchanged; they may have any type. An empty table gives no rows.
    """
    linked = near_duplicates(docs, id_col, text_col)
    order = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_md5")
    winners = linked.groupBy("root").agg(F.min(order).alias("w")).select(F.col("w.doc").alias("w_doc"), F.col("w.text_md5").alias("w_md5"))
    names = docs.columns
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c not in (id_col, text_col)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("doc"),
                       F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("text_md5"),
                       (F.to_json(F.struct(*others)) if others else F.lit("")).alias("tie"))
    kept = rows.join(winners, rows.doc.eqNullSafe(winners.w_doc) & (rows.text_md5 == winners.w_md5), "left_semi")
    return kept.groupBy("doc", "text_md5").agg(F.min_by("row", "tie").alias("row")).select(*[F.col(f"row.`{c}`") for c in names])
