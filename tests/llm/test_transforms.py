"""Fill-in-the-middle, fingerprints and periodic runs against brute force, and over nulls, empty and long texts, ties and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from bidlake.llm import fim, fingerprints, queries, runs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, h long, h1 long, print string, form string, output string, words string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "do", "ki", "lu", "me", "é", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts():
    base, long_ = prose(1, 300), prose(2, 40_000)
    return [
        None, "", " \t\n", "One", "one two", "ONE TWO", "a b c d e f", "x" * 3000, " lead and trail \n", "a <P> mark", "no mark < P>", "q<M>", "z  é \U0001f600 q",
        base, base, base.replace(" ", "  \n"), base + " tail", long_, "so " * 30, "ab cd " * 9 + "ab", prose(3, 40) + " " + " ".join(["x y z"] * 5), prose(4, 90),
        *[prose(k, 20 + 11 * k) for k in range(20, 45)],
    ]


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, 4, "p", "f", "o", "w") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    listed = [(i * 7, t) for i, t in enumerate(texts())]
    return listed + [listed[13], listed[3], (None, prose(1, 300)), (None, None), (91, "another text of an id that is there")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table_of(spark, rows).cache()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_fim(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    n, d = len(u), sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(d[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    spm = h4 % 100 < 80
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark, docs, rows):
    got = fim.restore(fim.fill_in_middle(docs)).collect()
    want = [(*brute_fim(i, t), t or "") for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    few = fim.restore(fim.fill_in_middle(docs, plain_percent=100, rows=3)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.restored) for r in few) == sorted((i is None, i or 0, t or "") for i, t in rows)
    assert {r.form for r in few if "<" not in r.restored and r.restored} <= {"spm", "psm"}
    assert fim.restore(fim.fill_in_middle(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        fim.restore(docs.withColumn("restored", F.lit("")))


# ---- fingerprints -------------------------------------------------------------------------------


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def spark_hash(*values):
    """xxhash64 as the SQL function has it: of the values in turn, each seeded by the last."""
    seed = 42
    for v in values:
        data = v if isinstance(v, bytes) else int(v[0]).to_bytes(v[1], "little", signed=True)
        seed = xxh64_intdigest(data, seed)
    return signed(seed)


def shingles_of(text, size=5):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [spark_hash(x.encode()) for x in WORD.findall(text)]
    if not w:
        return set()
    return {spark_hash((size, 4), *((x, 8) for x in w[i : i + size])) for i in range(max(1, len(w) - size + 1))}


def brute_print(text):
    hashes = shingles_of(text)
    if not hashes:
        return []
    least = {}
    for h in hashes:
        b = (h >> 56) + 128
        least[b] = min(least.get(b, h), h)
    out = []
    for b in range(256):
        if b not in least:
            group = min({c // 16 for c in least}, key=lambda g: (spark_hash((b, 4), (g, 4)) >> 16, g))
            ranked = min((c for c in least if c // 16 == group), key=lambda c: (spark_hash((c, 4), (b, 4)) >> 16, c))
            out.append(least[ranked] & 15)
        else:
            out.append(least[b] & 15)
    return out


def brute_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    equal = sum(x == y for x, y in zip(a, b)) / 256
    return max(0.0, (equal - 1 / 16) / (15 / 16))


def order_of(row):
    text = (row[1] or "").encode()
    return row[0], len(row[1] or ""), spark_hash(text), spark_hash((1, 4), text)


def brute_fingerprints(rows):
    known = {}
    print_of = lambda t: known.setdefault(t, brute_print(t))
    placed = sorted((r for r in rows if r[0] is not None), key=order_of)
    after = [(r, n) for r, n in zip(placed, placed[1:] + placed[:1])] + [(r, r) for r in rows if r[0] is None]
    for (doc_id, text), (_, following) in after:
        text, following = text or "", following or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        a, b, c = print_of(text), print_of(edited), print_of(following)
        yield doc_id, len(text), edited, "".join("%x" % x for x in a), "".join("%x" % x for x in b), brute_likeness(a, b), brute_likeness(a, c)


def test_fingerprints(spark, docs, rows):
    got = fingerprints.fingerprints(docs).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, brute_fingerprints(rows)))
    assert fingerprints.fingerprints(docs.limit(0)).count() == 0
    one = fingerprints.fingerprints(table_of(spark, [(5, "abcdefgh")])).first()
    assert one.edited == "abcdefab" and one.near_next == 1.0


def test_fingerprints_next_over_ranges(spark, rows):
    """The next document is the same whatever the ranges, also with ids far apart and most of one id."""
    listed = rows + [(1 << 40, "far"), (-5, "before")] + [(91, f"again {k}") for k in range(60)]
    df = table_of(spark, listed).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = sorted(((i, t or "") for i, t in listed if i is not None), key=order_of)
    want = sorted([(r, n[1]) for r, n in zip(placed, placed[1:] + placed[:1])] + [((None, t or ""), t or "") for i, t in listed if i is None], key=repr)
    for size, most in ((1, 1000), (3, 1000), (10, 4), (10_000, 10)):
        got = fingerprints.with_next(df, ["text"], size, most).collect()
        assert sorted([((r.doc_id, r.text), r.next_text) for r in got], key=repr) == want


def test_fingerprints_estimate_similarity(docs, rows):
    """Likeness is near the share of common shingles, and equal texts have equal fingerprints."""
    got = fingerprints.fingerprints(docs).filter(F.length("edited") > 0).collect()
    by_id = {r[0]: r[1] for r in rows if r[0] != 91}
    errors = []
    for r in got:
        if r.doc_id in by_id:
            a, b = shingles_of(by_id[r.doc_id]), shingles_of(r.edited)
            if len(a) > 100:  # the fewer shingles, the fewer bins have one of their own
                errors.append(r.near_edited - len(a & b) / len(a | b))
    assert len(errors) > 20 and max(map(abs, errors)) < 0.17 and abs(np.mean(errors)) < 0.03
    prints = {}
    for r in got:
        prints.setdefault(by_id.get(r.doc_id), set()).add(r.fingerprint)
    assert all(len(p) == 1 for t, p in prints.items() if t is not None)


def test_fingerprints_stay_in_the_jvm(docs):
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- periodic runs ------------------------------------------------------------------------------


def brute_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_periodic(doc_id, text, least=12):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w, least)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return doc_id, len(found), *longest, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in dropped))


def test_runs_of_numbers():
    rng = random.Random(5)
    for _ in range(300):
        laid, want = [], []
        for _ in range(rng.randint(0, 6)):
            n, k = rng.randint(0, 90), rng.choice([1, 2, 3, 5, 40])
            w = [rng.randrange(k) for _ in range(n)]
            if n > 5 and rng.random() < 0.5:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 2))
                w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            for least in (2, 12):
                want.append([(s + len(laid), length, q) for s, length, q in brute_runs(w, least)])
            base = 1000 * len(want)
            laid += [x + base for x in w] + [base + 999]
        for k, least in enumerate((2, 12)):
            got = list(zip(*(x.tolist() for x in runs.find_runs(np.array(laid, dtype=np.int64), least))))
            assert got == [r for found in want[k::2] for r in found]


def test_periodic_runs(spark, tmp_path, sf_dir):
    """The registered query over all documents of the smallest set, whole, and over the awkward rows."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    awkward = [(1000 + i, t) for i, t in enumerate(texts()) if t is None or len(t) < 50_000] + [(None, "a b c"), (None, None), (1003, "One")]
    extra = spark.createDataFrame(awkward, "doc_id long, text string")
    documents.union(extra).withColumn("runs", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    listed = [(r.doc_id, r.text) for r in documents.collect()] + awkward
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(brute_periodic(i, t)) for i, t in listed)


def test_periodic_runs_edges(spark, docs, rows):
    got = runs.periodic_runs(docs, most_words=50).collect()  # a long text is a batch of its own
    assert len(got) == len(rows) and runs.periodic_runs(docs.limit(0)).count() == 0
    by_text = {r.collapsed: r for r in got}
    so = by_text["so"]
    assert [(x.start, x.length, x.period) for x in so.runs] == [(0, 30, 1)] and so.longest.exponent_milli == 30_000
    assert by_text["ab cd"].longest.asDict() == {"start": 0, "length": 19, "period": 2, "exponent_milli": 9500}
    assert by_text[""].longest is None and by_text[""].runs_sha256 == sha("")
