"""Operators that relate rows: near-duplicates, mixing, pseudonyms, quality; and the pipeline."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pinwheel.llm import mixing, pii, quality, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


# ---- SimHash ----

def brute_fingerprint(text):
    import xxhash
    words = [w for w in re.split("[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_fingerprints_equal_brute_force_and_spark(spark):
    texts = ["", None, "one", "One two", "a b c", "É É\x0bx\x1cy Z " * 40, "w " * 5000, "the quick brown fox\njumps over the lazy dog"]
    got = simhash.fingerprints([t or "" for t in texts]).view(np.uint64).tolist()
    assert got == [brute_fingerprint(t) for t in texts]
    # One shingle: the fingerprint is Spark's own hash with its default seed 42.
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == simhash.fingerprints(["A b  c"])[0]


def brute_roots(prints, max_bits=2):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(prints, 2):
        if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= max_bits:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {f: find(f) for f in prints}


def clustered_prints(seed=3):
    rng = np.random.default_rng(seed)
    out = {0, -1, 1, 3, 7}
    for _ in range(25):
        x = int(rng.integers(-2 ** 63, 2 ** 63))
        out.add(x)
        for _ in range(12):
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                x ^= simhash.signed(1 << int(b))
            out.add(x)
    out |= {int(x) for x in rng.integers(-2 ** 63, 2 ** 63, 150)}
    return sorted(out)


def test_fingerprints_hash_some_texts_at_a_time():
    """Memory follows the texts that are hashed together, not the slice; results don't."""
    import tracemalloc
    rng = np.random.default_rng(3)
    texts = ["", *[" ".join(map(str, rng.integers(0, 10_000, 10_000))) for _ in range(40)], "a"]
    one_by_one = np.concatenate([simhash.fingerprints([t]) for t in texts])
    tracemalloc.start()
    got = simhash.fingerprints(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == one_by_one).all() and not len(simhash.fingerprints([]))
    assert peak < 60e6


@pytest.mark.parametrize("crowded", [512, 2])
def test_links_are_all_close_pairs(spark, crowded):
    prints = clustered_prints()
    want = {(a, b) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2}
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    plans = [simhash.choose_plan(df)] if crowded > 2 else \
        [simhash.Plan([list(range(32)), list(range(32, 64))], [1, 0]), simhash.Plan([list(range(50)), list(range(50, 64))], [-1, 2])]
    for plan in plans:
        got = {(r.a, r.b) for r in simhash.links(df, plan, crowded=crowded).collect()}
        assert got == want, plan


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (260, 2))] + [(k, k + 1) for k in range(1000, 1040)]
    root = {v: v for e in edges for v in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.vertex: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for v in root if any(v in e and e[0] != e[1] for e in edges)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(8)
    for m in (2, 3, 4):
        costs = [[0.0, *np.cumsum(rng.integers(1, 100, 3)).tolist()] for _ in range(m)]
        best, chosen = simhash.allocated(costs, 2 - m + 1)
        every = [sum(c[t + 1] for c, t in zip(costs, ts)) for ts in itertools.product(range(-1, 3), repeat=m) if sum(ts) == 3 - m]
        assert best == pytest.approx(min(every)) and sum(chosen) == 3 - m


def test_bits_are_grouped_by_correlation():
    rng = np.random.default_rng(10)
    x = rng.integers(0, 2, (4000, 64))
    x[:, 40:] = x[:, 40:41] ^ (rng.random((4000, 24)) < 0.1)
    parts = simhash.grouped_bits(4000, (x.T @ x).astype(float), 3)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert set(parts[0]) <= set(range(40, 64))


def test_components_of_documents(spark):
    base = " ".join(f"word{k}" for k in range(400))
    rows = [doc(10, base), doc(11, base), doc(5, base.upper()), doc(12, base.replace("word7 ", "other ")), doc(13, "something else entirely here"),
            doc(20, None), doc(21, ""), doc(22, "  \n"), doc(13, "something else entirely here"), (None, base, None, None, None)]
    df = docs(spark, rows).withColumn("root", F.lit(1)).withColumn("fingerprint", F.lit("x"))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_components(df).collect()]
    prints = {r[0]: brute_fingerprint(r[1]) for r in rows}
    roots = brute_roots(sorted(set(prints.values())))
    low = {}
    for i, p in prints.items():
        if i is not None:
            low[roots[p]] = min(low.get(roots[p], i), i)
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(got, key=key) == sorted([(r[0], f"{prints[r[0]]:016x}", low[roots[prints[r[0]]]]) for r in rows], key=key)
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: x) == sorted(set(low.values()))
    assert simhash.simhash_components(df.limit(0)).count() == 0 and simhash.one_per_group(df.limit(0)).count() == 0


def test_groups_with_columns_that_have_no_order(spark):
    df = docs(spark, [doc(1, "one two three four"), doc(1, "one two three four"), doc(2, "One two three four")])
    df = df.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("a b", F.lit(1))
    got = simhash.one_per_group(df)
    assert got.columns == df.columns and [(r.doc_id, r.m) for r in got.collect()] == [(1, {"k": 1})]


def test_group_without_ids_keeps_one(spark):
    df = docs(spark, [(None, "same text here", "en", s, 1) for s in "abca"])
    assert [r.source for r in simhash.one_per_group(df).collect()] == ["a"]


# ---- mixing ----

def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    capped, total = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: 2.0 * sizes[s] for s in over}


def mixing_rows():
    rng = np.random.default_rng(12)
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "B", "é", "z", "", "tiny"], p=[.3, .2, .2, .2, .09, .01])
        rows.append(doc(i, " ".join(["w"] * int(rng.integers(1, 60))), source=str(source)))
    return rows + [doc(3000, "repeated row", source="a"), doc(3000, "repeated row", source="a"), doc(2000, None), doc(2001, "", source=None),
                   doc(2002, "null source text " * 30, source=None), (None, "no id at all", "en", "B", 1), doc(2003, "x " * 9000, source="z")]


def test_targets_and_taken(spark):
    rows = mixing_rows()
    df = docs(spark, rows).withColumn("size", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("digest", F.lit(1))
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = brute_targets(sizes)
    by_id = {r[0]: r for r in rows}
    taken, biggest = {}, {}
    for r in out:
        source = by_id[r.doc_id][3]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken in (0, r.size, 2 * r.size) and r.size == len((by_id[r.doc_id][1] or "").split())
        taken[source] = taken.get(source, 0) + r.taken
        biggest[source] = max(biggest.get(source, 0), r.size)
    assert all(abs(taken[s] - want[s]) <= biggest[s] for s in sizes)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    assert mixing.mix(df.limit(0)).count() == 0


def test_sources_without_words(spark):
    out = mixing.mix(docs(spark, [doc(1, ""), doc(2, None, source=None)])).collect()
    assert [(r.target, r.taken) for r in out] == [(0.0, 0), (0.0, 0)]


def test_training_order_follows_the_schedules(spark):
    rows = [doc(i, "five words in each text", source="abc"[i % 3]) for i in range(3000)]
    df = docs(spark, rows)
    plan = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    order = mixing.training_order(df)
    assert order.columns == df.columns
    got = [(r.doc_id, r.source) for r in order.collect()]
    counts = {}
    for i, _ in got:
        counts[i] = counts.get(i, 0) + 1
    assert counts == {i: n for i, n in plan.items() if n}
    half = got[:len(got) // 2]
    share = {s: sum(x == s for _, x in half) / sum(x == s for _, x in got) for s in "abc"}
    # a is steady, b rises from 1/2 to 3/2 (3/8 of it in the first half), c falls.
    assert share["a"] == pytest.approx(0.5, abs=0.03) and share["b"] < 0.42 and share["c"] > 0.58


def test_positions_invert_the_demand(spark):
    for place, (a, m, b) in enumerate(mixing.SHAPES):
        times = np.linspace(0, 1, 21)
        demand = np.where(times < 0.5, a * times + (m - a) * times ** 2, (a + m) / 4 + m * (times - 0.5) + (b - m) * (times - 0.5) ** 2)
        df = spark.createDataFrame([(k, float(d / demand[-1]), place) for k, d in enumerate(demand)], "k int, spent double, place int")
        got = {r.k: r.t for r in df.select("k", F.expr(mixing.position_sql("spent", "place")).alias("t")).collect()}
        assert [got[k] for k in range(21)] == pytest.approx(times.tolist(), abs=1e-9)


# ---- pseudonyms ----

def test_feistel_is_a_permutation(spark):
    for a, b in ((7, 9), (229, 13), (1, 5)):
        got = [r.y for r in spark.range(a * b).select(F.expr(pii.feistel("id", a, b, "k", "key")).alias("y")).collect()]
        assert sorted(got) == list(range(a * b))
        other = [r.y for r in spark.range(a * b).select(F.expr(pii.feistel("id", a, b, "k", "other")).alias("y")).collect()]
        assert a == 1 or got != other


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def iban_ok(text):
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


CASES = [("card 4111111111111111.", r"card (\d{16})\.", lambda x: luhn(x)), ("c 5500-0055-5555-5559!", r"c (\d{4}-\d{4}-\d{4}-\d{4})!", lambda x: luhn(x.replace("-", ""))),
         ("call +1 (017) 555-7713 now", r"call \+1 \((\d{3}\) \d{3}-\d{4}) now", bool), ("at 97.51.17.173,", r"at (\d+\.\d+\.\d+\.\d+),", lambda x: all(int(o) < 256 for o in x.split("."))),
         ("ssn 123-45-6789", r"ssn (\d{3}-\d\d-\d{4})", lambda x: x[:3] not in ("000", "666") and x[0] != "9"), ("on 2020-02-29", r"on (\d{4}-\d\d-\d\d)", bool),
         ("on 31.12.1999", r"on (\d\d\.\d\d\.\d{4})", bool), ("on 12/31/2001", r"on (\d\d/\d\d/\d{4})", bool),
         ("DE89 3704 0044 0532 0130 00", r"(DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d)", iban_ok), ("GB82WEST12345698765432", r"(GB\d\dWEST\d{14})", iban_ok),
         ("éa.34@mail7.example.com geht", r"(\S+@\S+)\.com geht", bool)]
LEFT = ["4111111111111112", "999.1.1.1", "1.2.3.4.5", "000-12-3456", "2021-02-29", "GB82WEST12345698765433", "12345", "abc4111111111111111", "a@b", "", None]


def test_pseudonyms_keep_formats_and_links(spark):
    texts = [t for t, _, _ in CASES] + LEFT + ["twice 4111111111111111 and 4111111111111111 and 4111-1111-1111-1111"]
    df = docs(spark, [doc(i, t) for i, t in enumerate(texts)] * 2).withColumn("found", F.lit(1)).withColumn("row", F.lit(2)).withColumn("m", F.lit(3))
    out = pii.pseudonymise(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "m", "found"]
    rows = out.collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 2 * len(texts)
    for i, (t, shape, valid) in enumerate(CASES):
        m = re.search(shape, got[i].text)
        assert m and valid(m[1]) and m[1] != re.search(shape, t)[1], (t, got[i].text)
        assert len(got[i].found) == 1 and (got[i].found[0].kind == "ip" or len(got[i].text) == len(t))
    for i, t in enumerate(LEFT, len(CASES)):
        assert got[i].text == t and not got[i].found
    twice = re.findall(r"[\d-]{16,}", got[len(texts) - 1].text)
    assert twice[0] == twice[1] == twice[2].replace("-", "") == re.search(r"\d{16}", got[0].text)[0]
    counted = {r.doc_id: r for r in pii.pii_documents(df).collect()}
    assert counted[0].n_card == 1 and counted[0].n_replaced == 1 and counted[3].n_ip == 1
    assert pii.without_pii(docs(spark, [])).count() == 0
    assert pii.without_pii(df).columns == df.columns and pii.without_pii(df).first().found == 1


def make_iban(country, bban):
    return country + f"{98 - int(''.join(str(int(c, 36)) for c in bban + country + '00')) % 97:02d}" + bban


def test_ibans_before_other_words(spark):
    """A word of capitals or digits after the number isn't part of it."""
    grouped = lambda s: " ".join(s[k:k + 4] for k in range(0, len(s), 4))
    bbans = {"ES": "21000418450200051332", "AT": "1904300234573201", "BE": "539007547034", "SE": "50000000058398257466", "NO": "86011117947",
             "HU": "117730161111101800000000", "PL": "109010140000071219812874", "MT": "MALT011000012345MTLCAST001S", "DE": "370400440532013000"}
    numbers = [make_iban(c, b) for c, b in bbans.items()]
    texts = [f"pay {n}{after}" for s in numbers for n in (s, grouped(s)) for after in (" SWIFT", " EUR 5", " 1201 2024", " A", ".", "")]
    got = {r.doc_id: r for r in pii.pseudonymise(docs(spark, [doc(i, t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        s, after = numbers[i // 12], (" SWIFT", " EUR 5", " 1201 2024", " A", ".", "")[i % 6]
        assert [x.kind for x in got[i].found] == ["iban"] and got[i].text == f"pay {got[i].found[0].value}{after}", t
        fresh = got[i].found[0].value.replace(" ", "")
        assert iban_ok(fresh) and fresh != s and len(fresh) == len(s) and fresh[:2] == s[:2]


def test_cards_and_phones_in_other_groupings(spark):
    cards = ["3782 822463 10005", "3782-822463-10005", "3056 930902 5904"]
    # Number, and how many leading digits are its country code.
    phones = [("555-123-4567", 0), ("555 123 4567", 0), ("1-800-555-0199", 1), ("+44 20 7946 0958", 2), ("+49 30 123456", 2), ("+49 (0)30 123456", 2),
              ("+33 1 23 45 67 89", 2), ("+33.1.23.45.67.89", 2), ("+4512345678", 2), ("+45 12 34 56 78", 2), ("+49 1512 3456789", 2),
              ("+353 1 234 5678", 3), ("+1 555 123 4567", 1), ("+390612345678901", 2)]
    texts = [f"x {t}, y" for t in cards + [p for p, _ in phones]]
    after = ["+45 12345678 4111 1111 1111 1111", "+45 12345678 555-123-4567", "+45 12 34 56 78 123-45-6789", "+44 20 7946 0958: 2020-02-29", "+44 20 7946 0958 2020-02-29", "+45 12345678 10.1.2.3"]
    left = ["978-3-16-148410-0", "3782 822463 10006", "+1234567", "12-555-123-4567-8", "10 000 000"]
    rows = {r.doc_id: r for r in pii.pseudonymise(docs(spark, [doc(i, t) for i, t in enumerate(texts + after + left)])).collect()}
    for i, t in enumerate(texts):
        assert [x.kind for x in rows[i].found] == ["card" if i < len(cards) else "phone"], t
        new = rows[i].found[0].value
        assert rows[i].text == f"x {new}, y" and re.sub(r"\d", "0", rows[i].text) == re.sub(r"\d", "0", t)
        old, digits = re.sub(r"\D", "", t), re.sub(r"\D", "", new)
        if i < len(cards):
            assert luhn(digits) and digits != old
        else:
            kept = phones[i - len(cards)][1]
            assert digits[:kept] == old[:kept] and digits[kept:] != old[kept:]
    values = [rows[i].found[0].value for i in range(len(texts))]
    assert re.sub(r"\D", "", values[3]) == re.sub(r"\D", "", values[4]) == re.sub(r"\D", "", values[15])[1:]  # one number in three forms
    for i, kind in enumerate(("card", "phone", "ssn", "date", "date", "ip"), len(texts)):
        assert [x.kind for x in rows[i].found] == ["phone", kind], (rows[i].text, kind)
    for i, t in enumerate(left, len(texts) + len(after)):
        assert rows[i].text == t and not rows[i].found


def test_text_without_findings_is_untouched(spark):
    text = "Numbers 12, 3.5 and 1999 stay | $%& too\n\n" * 3000
    assert pii.without_pii(docs(spark, [doc(1, text)])).first().text == text


# ---- quality ----

def brute_statistics(text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    marked = {i for ks in windows.values() if len(ks) > 1 for k in ks for i in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(marked),
            sum(a == b for a, b in zip(words, words[1:])), failed)


def quality_rows():
    rng = np.random.default_rng(13)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnoé"), int(rng.integers(2, 9)))) for _ in range(400)]
    rows = []
    for i in range(420):
        words = rng.choice(vocabulary, int(np.exp(rng.normal(5, 0.6))) + 22)
        text = "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))
        if i % 20 == 0:
            text = " ".join(w + "###" for w in words)
        if i % 20 == 1:
            text += "\n" + "\n".join([" ".join(words[:12])] * 3)
        rows.append(doc(i, text, ["en", "de", None][i % 7 % 3], ["hot", "s1", None][i % 5 % 3] if i % 9 else f"small{i % 4}"))
    rows += [doc(1000 + i, rows[20 * i + 2][1], "xx", "alone") for i in range(3)]
    return rows + [doc(900, None), doc(901, ""), doc(902, "a b c " * 500), doc(903, "x\x0by\x0cz\t" * 30), doc(904, "tiny text"), doc(3, rows[3][1])]


def test_base_statistics_equal_brute_force(spark):
    rows = quality_rows()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echoes", "base_failed")
    df = docs(spark, rows).withColumn("n_words", F.lit("clash")).withColumn("words", F.lit(1)).withColumn("row", F.lit(1))
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality.base_statistics(df).collect()}
    assert got == {r[0]: brute_statistics(r[1]) for r in rows}


def brute_floors(vectors):
    ordered = np.sort(np.array(vectors, float), axis=0)
    lo, mid, hi = (ordered[-(-len(vectors) * q // 4) - 1] / quality.UNIT for q in (1, 2, 3))
    word = np.sqrt(quality.FEW) * np.exp(-mid[0] / 2)
    return np.array([*np.maximum((hi - lo)[:2] / 1.349, 1 / quality.UNIT), np.sqrt(quality.FEW) * np.exp(-(mid[0] + mid[1]) / 2), word, word, word])


def brute_mcd(vectors, floor):
    """Mean and covariance of least determinant over the starts, each until nothing changes."""
    v = np.array(vectors, float)
    n, x = len(v), v / quality.UNIT
    ordered = np.sort(x, axis=0)
    lo, mid, hi = (ordered[-(-n * q // 4) - 1] for q in (1, 2, 3))
    floored = lambda c: c + np.diag(np.maximum(floor ** 2 - np.diag(c), 0))
    ends = []
    for mean, scale in ((mid, (hi - lo) / 1.349), (mid, 0 * mid), (x.mean(0), x.std(0))):
        cov, last = floored(np.diag(scale ** 2)), None
        for _ in range(quality.MOST_STEPS):
            d = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
            bins = np.minimum(np.floor(np.sqrt(d) * quality.BIN), quality.LAST_BIN)
            near = np.array([(bins < b).sum() < quality.SHARE * n for b in bins])
            if last is not None and (near == last).all():
                break
            last, mean = near, x[near].mean(0)
            cov = floored(np.cov(x[near].T, bias=True) * quality.CONSISTENCY)
        ends.append((np.linalg.slogdet(cov)[1], mean, cov))
    return min(ends, key=lambda e: e[0])[1:]


def distance2(vector, mean, cov):
    x = np.array(vector, float) / quality.UNIT - mean
    return x @ np.linalg.inv(cov) @ x


def test_distances_equal_brute_force(spark):
    rows = quality_rows()
    out = quality.quality_rules(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    passing = [r for r in rows if not brute_statistics(r[1])[-1]]

    def vector(r):
        n, chars, symbols, dup, rep, echo, _ = brute_statistics(r[1])
        raw = (np.log(n), np.log(chars / n), np.sqrt(symbols / chars), np.sqrt(dup / n), np.sqrt(rep / n), np.sqrt(echo / n))
        return [int(np.floor(x * quality.UNIT + 0.5)) for x in raw]

    floor = brute_floors([vector(r) for r in passing])
    members = {}
    for r in passing:
        for g in ((r[2], r[3]), (r[2],), ()):
            members.setdefault(g, []).append(vector(r))
    group = lambda r: next(g for g in ((r[2], r[3]), (r[2],), ()) if len(members[g]) >= quality.MIN_ROWS or not g)
    judged_by = {group(r) for r in passing}
    assert len(judged_by) > 3 and {len(g) for g in judged_by} == {0, 1, 2}
    models = {g: brute_mcd(members[g], floor) for g in judged_by}
    want = {r[0]: distance2(vector(r), *models[group(r)]) for r in passing}
    got = {r.doc_id: r for r in out}
    for i, r in got.items():
        if r.base_failed:
            assert r.distance2 is None and not r.kept
        else:
            assert r.distance2 == pytest.approx(want[i], rel=1e-6) and r.kept == (r.distance2 <= quality.CUTOFF)
    assert not any(got[i].kept for i in range(0, 420, 20))
    clean = [i for i in range(420) if i % 20 > 1]
    assert np.mean([got[i].kept for i in clean]) > 0.99
    assert quality.quality_rules(docs(spark, [])).count() == 0


def brute_feistel(n, a, b, kind, key):
    left, right = divmod(n, b)
    for i in range(1, pii.ROUNDS + 1):
        half = right if i % 2 else left
        h = int(hashlib.sha256(f"{key}|{kind}|{i}|{a}|{b}|{half}".encode()).hexdigest()[:15], 16)
        left, right = ((left + h % a) % a, right) if i % 2 else (left, (right + h % b) % b)
    return left * b + right


def test_all_dates_stay_different(spark):
    import datetime
    start = datetime.date(1900, 1, 1)
    days = [start + datetime.timedelta(k) for k in range((datetime.date(2100, 1, 1) - start).days)]
    new = [brute_feistel(k, 229, 319, "date", "k") for k in range(229 * 319)]
    assert sorted(new) == list(range(229 * 319)) and len(days) == pii.DAYS
    want = {}
    for form in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y"):
        for k, day in enumerate(days):
            if form == "%m/%d/%Y" and day.day < 13:
                continue  # reads as dd/mm
            j = new[k]
            while j >= len(days) or (form == "%m/%d/%Y" and days[j].day < 13):
                j = new[j]
            want[day.strftime(form)] = days[j].strftime(form)
    assert len(set(want.values())) == len(want) == 3 * 73_049 + 44_249
    rows = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.text for r in pii.pseudonymise(rows, key="k").collect()}
    assert [got[k] for k in range(len(want))] == list(want.values())


def ordinary(rng, n=None):
    words = [f"{w}{k}" for w, k in zip(rng.choice(["alpha", "be", "gammas", "delta", "epsi"], n or int(rng.integers(120, 500))), itertools.count())]
    return "\n".join(" ".join(words[k:k + 10]) for k in range(0, len(words), 10))


def test_small_groups_are_judged_by_the_enclosing_one(spark):
    rng = np.random.default_rng(21)
    rows = [doc(i, ordinary(rng), "en", "A") for i in range(301)]
    garbage = " ".join(["x" + "#" * 210] * 30)
    garbage = " ".join(f"{w}{k}" for k, w in enumerate(garbage.split()))
    rows += [doc(500, garbage, "en", "A"), doc(501, garbage, "en", "B"), doc(502, garbage, "xx", "C"), doc(503, ordinary(rng), "xx", "C")]
    got = {r.doc_id: r.kept for r in quality.quality_rules(docs(spark, rows)).collect()}
    assert not got[500] and not got[501] and not got[502] and got[503]
    assert np.mean([got[i] for i in range(301)]) > 0.98


def test_every_statistic_can_reject(spark):
    rng = np.random.default_rng(22)
    rows = [doc(i, ordinary(rng), "en", "A") for i in range(300)]
    lines = ordinary(rng, 300).split("\n")
    words = ordinary(rng, 300).split()
    odd = {"ln_words": ordinary(rng, 40_000), "ln_length": " ".join(w * 12 for w in words),
           "symbols": " ".join(w + "&" * (k % 3) for k, w in enumerate(words)),
           "lines": "\n".join(x for k, w in enumerate(words) for x in (w, "one")[:1 + (k % 2)]),
           "repeats": "\n".join(lines + [" ".join([*lines[k].split(), f"new{k}"]) for k in range(4)]),
           "echoes": " ".join(x for k, w in enumerate(words) for x in [w] * (1 + (k % 3 == 0)))}
    assert list(odd) == list(quality.STATS)
    rows += [doc(900 + k, t, "en", "A") for k, t in enumerate(odd.values())]
    got = {r.doc_id: r for r in quality.quality_rules(docs(spark, rows)).collect()}
    assert not any(got[900 + k].base_failed for k in range(len(odd)))
    assert [name for k, name in enumerate(odd) if got[900 + k].kept] == []
    assert np.mean([got[i].kept for i in range(300)]) > 0.98


def test_normal_model_constants():
    # Table values of the chi-square distribution.
    assert quality.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality.chi2_cdf(18.4753, 7) == pytest.approx(0.99, abs=1e-5)


def test_quality_uses_no_python(spark):
    import io
    from contextlib import redirect_stdout
    df = docs(spark, [doc(1, "word " * 30), doc(2, "4111111111111111")])
    for out in (quality.quality_rules(df), pii.pii_documents(df)):
        text = io.StringIO()
        with redirect_stdout(text):
            out.explain()
        assert not re.search("Python|Pandas|Arrow", text.getvalue())


# ---- pipeline ----

def test_pipeline_stages_on_the_smallest_tables(spark, tmp_path):
    import corpus_pipeline
    from pinwheel.llm import bpe, toxicity
    from pinwheel.llm.queries import tokenizer_path
    from pinwheel.sources.tables import load
    start = load(spark, SF_SMALL, "documents")
    kept = [start]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF_SMALL).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert kept[-1].dtypes == start.dtypes
    clean, single, safe, mixed, coded = ({r.doc_id: r for r in x.collect()} for x in kept[1:])
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(start, load(spark, SF_SMALL, "labels")).collect()}
    assert set(clean) == {i for i, p in scores.items() if not p}
    prints = {i: brute_fingerprint(r.text) for i, r in clean.items()}
    roots = brute_roots(sorted(set(prints.values())))
    low = {}
    for i, p in prints.items():
        low[roots[p]] = min(low.get(roots[p], i), i)
    assert set(single) == set(low.values())
    expected = {r.doc_id: r.text for r in pii.pseudonymise(kept[2]).collect()}
    assert {i: r.text for i, r in safe.items()} == expected and all(r.n_chars == len(r.text) for r in safe.values())
    plan = {r.doc_id: r.copies for r in mixing.mix(kept[3]).collect()}
    counts = {r.doc_id: r["count"] for r in kept[4].groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in plan.items() if n and (safe[i].text or "").split()}
    ids = {r.doc_id: r.ids for r in bpe.bpe_encode(kept[4], tokenizer_path("word_bpe_49k.json")).collect()}
    assert kept[5].count() == kept[4].count()
    for i, r in coded.items():
        assert r.ids == ids[i] and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    total = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r.doc_id, r.ids_sha256) for r in total.collect()) == sorted((r.doc_id, r.ids_sha256) for r in kept[5].collect())


def test_registered_queries():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
