"""Conversation repair, phrase collocations and language-model scores against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pinwheel.llm import collocations as co
from pinwheel.llm import lmscore as lm
from pinwheel.llm import repair

# ---- conversation repair ----

PATTERN = re.compile("(s?(ua)+)?")


def faults_of(rows):
    out, seen = [], set()
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    return out


def brute_edits(rows):
    """(cost, audit, repaired rows): every choice per row, with 0 to 2 insertions in each gap."""
    faults, best = faults_of(rows), None
    inserts = [()] + [c for n in (1, 2) for c in itertools.product(("user", "assistant"), repeat=n)]
    choices = []
    for (role, text), fault in zip(rows, faults):
        extra = 5 if fault == "truncated" else 0
        mine = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            mine += [(extra, "K", (role, text)), (1 + extra, "R", ("user", text)), (1 + extra, "R", ("assistant", text))]
        choices.append(mine)
    for picks in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for k, gap in enumerate(gaps):
                for role in gap:
                    cost, audit = cost + 5, audit + "I"
                    out.append((role, ""))
                if k < len(picks):
                    cost, audit = cost + picks[k][0], audit + picks[k][1]
                    if picks[k][2]:
                        out.append(picks[k][2])
            if PATTERN.fullmatch("".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


def decoded(rows):
    got = []
    d = repair.Decoder(lambda initial, turn: got.append((initial, turn)))
    for (role, text), fault in zip(rows, faults_of(rows)):
        d.row(role, text, fault)
    cost = d.finish()
    return cost, "".join(i for i, _ in got), [t for _, t in got if t is not None]


def plain_viterbi(rows):
    """The same recursion with whole strings and no pruning."""
    def insertions(v):
        for q in (0, 1, 3):
            if q in v:
                c, a, o = v[q]
                v[2] = min(v.get(2, (1e9,)), (c + 5, a + "I", [*o, ("user", "")]))
        if 2 in v:
            c, a, o = v[2]
            v[3] = min(v.get(3, (1e9,)), (c + 5, a + "I", [*o, ("assistant", "")]))
        return v
    goes = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    v = insertions({0: (0, "", [])})
    for (role, text), fault in zip(rows, faults_of(rows)):
        to, extra = {}, 5 * (fault == "truncated")
        for q, (c, a, o) in v.items():
            ways = [(q, c + 2, "D", o)]
            if fault not in ("blank", "duplicate"):
                if (q, role[:1]) in goes:
                    ways.append((goes[q, role[:1]], c + extra, "K", [*o, (role, text)]))
                n = 3 if q == 2 else 2
                ways.append((n, c + 1 + extra, "R", [*o, ("assistant" if n == 3 else "user", text)]))
            for n, cost, i, out in ways:
                to[n] = min(to.get(n, (1e9,)), (cost, a + i, out))
        v = insertions(to)
    return min(v[q] for q in (0, 3) if q in v)


def random_rows(rng, n):
    roles, texts = ["user", "assistant", "system", "tool", " ", "u", ""], ["Fine.", "cut", "", "What?\n", "x. y", "z!"]
    return [(rng.choice(roles[:rng.choice((2, 3, 7))]), rng.choice(texts) + rng.choice(("", str(rng.randrange(50)) + "."))) for _ in range(n)]


def test_repairs_are_the_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        rows = random_rows(rng, rng.randrange(4))
        assert decoded(rows) == brute_edits(rows), rows
    for _ in range(400):
        rows = random_rows(rng, rng.randrange(1, 40))
        assert decoded(rows) == plain_viterbi(rows), rows


def test_unresolved_edits_stay_few():
    rng, longest, depth = random.Random(5), 0, 0
    d = repair.Decoder(lambda initial, turn: None)
    for k in range(20_000):
        role = rng.choice(("user", "assistant", "user", "assistant", "system"))
        d.row(role, f"{k}.", rng.choice((None, None, None, "blank", "truncated")))
        longest = max(longest, max(len(d._unresolved(n)) for _, n in d.survivors.values()))
    assert longest < 200


CONV = "conv_id long, turn long, role string, text string"


def damaged(rows):
    """The rows of each conversation after damage, in order."""
    out = {}
    blank = lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = ("user" if kind == 4 else blank(role)), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def brute_report(rows):
    out = []
    for conv, mine in damaged(rows).items():
        turns = [t for t, _, _ in mine if t is not None]
        plain = [(r, t) for _, r, t in mine]
        faults = faults_of(plain)
        initials = [r[:1] for r, _ in plain]
        cost, audit, left = plain_viterbi(plain)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_repair_report_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [(c, rng.choice((k, k, k, k + 3, None)), *r) for c in range(150) for k, r in enumerate(random_rows(rng, rng.randrange(1, 12)))]
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (7, 3, "user", "É.\x0b"), (7, 3, "user", "É.\x0b"), (900, None, None, "x")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    df = spark.createDataFrame(rows, CONV).withColumn("conv", F.lit(1)).withColumn("fault", F.lit("x")).withColumn("copy", F.lit(2))
    got = by_id(tuple(r) for r in repair.repair_report(repair.damage(df)).collect())
    assert got == by_id(brute_report(rows))
    gone = next(r for r in got if r[0] == dropped)
    assert gone[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair_report(repair.damage(df.limit(0))).count() == 0


def test_repaired_rows(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("system", "S."), ("assistant", "A."), ("assistant", "B."), ("user", ""), ("user", "C.")])]
    got = repair.repair_edits(repair.whole(spark.createDataFrame(rows, CONV))).orderBy("place").collect()
    cost, audit, left = plain_viterbi([r[2:] for r in rows])
    assert "".join(r.edit for r in got) == audit and [(r.role, r.text) for r in got if r.role is not None] == left
    assert [r.place for r in got] == list(range(len(audit)))


def test_long_conversation_is_streamed(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                      F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                      F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    r = repair.repair_report(repair.whole(rows)).first()
    want = "\n".join(f"{'assistant' if k % 2 else 'user'}:{k}." for k in range(20_000))
    assert r.audit == "K" * 20_000 and r.cost == 0 and r.repaired_sha256 == hashlib.sha256(want.encode()).hexdigest()


# ---- phrase collocations ----

def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def brute_collocations(rows, least, top, depth=5):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, depth + 1):
                for k in range(len(words) - m + 1):
                    f[lang][tuple(words[k:k + m])] += 1
    out = []
    for lang, count in f.items():
        many = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in many.items():
            inner = any(len(q) > len(p) and any(q[k:k + len(p)] == p for k in range(len(q))) and many[q] >= a for q in many)
            if not inner:
                score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def invented(rng, n):
    vocabulary = ["the", "The", "a", "b", "ab", "é", "ß", "\xa0", "\x1c", "x\x00", "zz"]
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary[:rng.choice((3, 6, 11))]) + rng.choice([""] * 6 + [".", ", ", "\n", "\t"]) for _ in range(rng.randrange(60))]
        out.append((" ".join(words), rng.choice(["en", "en", "de", None, "und", ""])))
    return out + [(None, "en"), ("", "fr"), (" \t\n", None), ("a b a b " * 3000, "long"), ("the a b. " * 50, "en")]


@pytest.mark.parametrize("budget,coded", [(1 << 21, co.CODED), (200, 4), (3, 1)])
def test_collocations_equal_brute_force(spark, budget, coded, monkeypatch):
    monkeypatch.setattr(co, "CODED", coded)
    rows = invented(random.Random(11), 150)
    rows += rows[:40]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("f", F.lit(1)).withColumn("phrase", F.lit("x")).withColumn("slot", F.lit(0))
    got = sorted(tuple(r) for r in co.collocations(df.repartition(5), least=6, top=40, budget=budget).collect())
    assert got == brute_collocations(rows, 6, 40)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert co.collocations(df.limit(0)).count() == 0 and co.collocations(df).count() == 0
    assert co.collocations(df, least=1, top=None).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_pass_64_bits(spark):
    # a * n * 1000 is beyond a long for these counts; the score itself is not.
    a, n = 3_000_000_000, 4_000_000_000_000
    e = "(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    df = spark.createDataFrame([(a, n, a + 7, a + 1)], "a long, n long, l long, r long")
    assert df.select(F.expr(e)).first()[0] == 1000 * a * n // ((a + 7) * (a + 1))


def test_long_texts_come_in_several_lists():
    text = "one two, three four. " * 500 + "five " * 400 + "; six seven"
    whole = [w for part in co.tokens(text) for w in part]
    cut = [w for part in co.tokens(text, 100) for w in part]
    squeeze = lambda t: [p for p in b" ".join(t).split(b" .")]
    assert [p.strip() for p in squeeze(whole) if p.strip()] == [p.strip() for p in squeeze(cut) if p.strip()]
    assert len(list(co.tokens(text, 100))) > 50


def test_slots_are_packed_within_the_budget():
    loads = np.random.default_rng(2).integers(0, 120, co.SLOTS)
    table, end = co.packed(loads, 100, 5)
    assert (table[loads == 0] == co.ABSENT).all() and (table[loads > 100] == co.LONGER).all()
    fits = (loads > 0) & (loads <= 100)
    sums = np.bincount(table[fits], weights=loads[fits])
    assert sums.max() <= 100 and (sums[:5] == 0).all() and len(sums) == end


# ---- language-model scores ----

def brute_scores(rows, order, constants=lm.SMOOTHING):
    token = lambda t: [w for w in re.split("[\x20\x09-\x0D]+", ascii_lower(t or "")) if w] + [""]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count, n = collections.Counter(), 0
    for i, text in rows:
        if not held(i):
            s = [""] + token(text)
            n += len(s) - 1
            for k in range(1, len(s)):
                for m in range(1, order + 1):
                    if m == 1 or k - m + 1 >= 0:
                        count[tuple(s[k - m + 1:k + 1])] += 1
    v = sum(len(g) == 1 for g in count)

    def p(context, w):
        if not context:
            return (count[(w,)] + 1) / (n + v + 1)
        k = lm.smoothing(len(context) + 1, constants)
        return (count[(*context, w)] + k * p(context[1:], w)) / (count[context] + k)
    out = []
    for i, text in rows:
        s = [""] + token(text)
        out.append((i, held(i), len(s) - 1, sum(count[(w,)] > 0 for w in s[1:]), n,
                    sum(math.log10((count[(w,)] + 1) / (n + v + 1)) for w in s[1:]),
                    sum(math.log10(p(tuple(s[max(0, k - order + 1):k]), s[k])) for k in range(1, len(s)))))
    return out


def lm_rows():
    rng = random.Random(12)
    vocabulary = ["the", "The", "a", "é", "\xa0", "x\x00", "."] + [f"w{k}" for k in range(40)]
    rows = [(k, " ".join(rng.choice(vocabulary[:rng.choice((5, 47))]) for _ in range(rng.randrange(80)))) for k in range(200)]
    return rows + [(None, "a the a"), (3, None), (4, " \n"), (4, " \n"), (5, "w1 w2\x0bw3 " * 4000), (9, "unheard " * 3)]


@pytest.mark.parametrize("order,limits", [(2, {}), (3, {"slice_bytes": 300, "range_keys": 100}), (1, {}), (4, {"slice_bytes": 2000, "range_keys": 1000})])
def test_scores_equal_brute_force(spark, order, limits):
    rows = lm_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("slice", F.lit("x")).withColumn("n", F.lit(0))
    got = [tuple(r) for r in lm.lm_scores(df.repartition(3), order=order, **limits).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=key), sorted(brute_scores(rows, order), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


def test_probabilities_add_up_to_one():
    rows = lm_rows()[:60]
    words = {w for _, t in rows for w in ascii_lower(t).split()} | {""}
    order, n = 3, 0
    count = collections.Counter()
    for _, text in rows:
        s = [""] + ascii_lower(text).split() + [""]
        n += len(s) - 1
        for k in range(1, len(s)):
            for m in range(1, order + 1):
                if m == 1 or k - m + 1 >= 0:
                    count[tuple(s[k - m + 1:k + 1])] += 1

    def p(context, w):
        if not context:
            return (count[(w,)] + 1) / (n + len(words) + 1)
        k = lm.smoothing(len(context) + 1)
        return (count[(*context, w)] + k * p(context[1:], w)) / (count[context] + k)
    for context in ((), ("a",), ("", "the"), ("a", "a"), ("never",)):
        assert sum(p(context, w) for w in words) + p(context, None) == pytest.approx(1.0)


def test_no_rows_and_no_training_rows(spark):
    df = spark.createDataFrame([(9, "a b")], "doc_id long, text string")
    assert lm.lm_scores(df.limit(0)).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    r = lm.lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0.0 and r.score == 0.0
