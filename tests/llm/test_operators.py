"""Each operator against a brute-force version, and over nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import pickle
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from bidlake.llm import cascade, common, cuckoo, lbl, mixing, oddsketch, packing, queries, suffixes, tokens, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, row long, hash long, class string, taken long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "do", "ki", "lu", "me", "é", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts():
    base = prose(1, 300)
    near = base.split(" ")
    near[150] = "other"
    long_ = prose(2, 6000)
    return [
        None, "", " \t\n", "One", "one two", "ONE TWO", "x" * 3000, "don't <|endoftext|> stop<|STARTOFTEXT|>, ÉTÉ İstanbul é a b",
        base, base, base.replace(" ", "  \n"), " ".join(near), long_, long_[: len(long_) // 2], prose(3, 90) + " " + base[:700], "a b c d e f",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", [None, "b", "a", "é", "Z"][i % 5], None, 7, "k", 1, 2, "c", 3) for i, t in enumerate(texts())]
    rows += [rows[8], rows[3], (None, texts()[8], None, None, None, 0, None, 0, 0, None, 0), (None, None, None, "b", None, 0, None, 0, 0, None, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_token_counts(spark, docs, empty):
    t = tokens.open_tokenizer(queries.vocabulary())
    want = sorted(((d is None, d or 0), len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for d, x in pairs(docs))
    for chunk, overlap in ((65536, 1024), (200, 30), (40, 4)):  # the last must widen its overlaps
        got = tokens.count_tokens(docs, queries.vocabulary(), chunk=chunk, overlap=overlap).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert tokens.count_tokens(empty, queries.vocabulary()).count() == 0


def test_word_memory_is_bounded():
    encoder = tokens.WordEncoder(queries.vocabulary(), memory=50)
    t = tokens.open_tokenizer(queries.vocabulary())
    for seed in range(20):
        text = prose(seed, 200)
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 50 + 201


def test_word_memory_fits_beside_other_workers():
    """Both generations, at some 175 bytes a word (135 MB were measured for 770,000 words), stay within 80 MB a worker."""
    assert 2 * tokens.WordEncoder(queries.vocabulary()).memory * 175 <= 80e6


def test_a_worker_keeps_the_words_of_one_kind_of_task():
    """The encoder stays from task to task of packing, and goes when another operator's task comes to the worker process."""
    def task(fn, keeps):
        return list(cloudpickle.loads(cloudpickle.dumps(common._lean(fn, keeps)))(iter([pa.RecordBatch.from_pydict({"doc_id": [1]})])))

    encoder = tokens.WordEncoder.at(queries.vocabulary())
    assert len(task(lambda batches: batches, True)) == 1
    assert tokens.WordEncoder.at(queries.vocabulary()) is encoder
    assert len(task(lambda batches: batches, False)) == 1
    assert tokens.WordEncoder.at(queries.vocabulary()) is not encoder


def test_words_of_letters_are_encoded_together():
    """Punctuation behind a word is learned by itself, and words of letters go to the tokenizer as one text; odd words keep their ids."""
    asked = []

    class Counted:
        def encode_batch_fast(self, lines, **options):
            asked.extend(lines)
            return tokenizer.encode_batch_fast(lines, **options)

    encoder = tokens.WordEncoder(queries.vocabulary())
    tokenizer, encoder.tokenizer = encoder.tokenizer, Counted()
    plain = [f"{a}{b}ra" for a in "abcdefgh" for b in "aeiou"]
    text = " ".join(w + end for w in plain for end in ("", ".", ",", "!!"))
    assert encoder.encode([text.encode()]) == [np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert len(asked) == 1 + 3
    odd = [
        "\u0130stanbul", "\u0130", "e\u0301t\u00e9.", "\u0301a", "don't", "don't.", "it's", "'s", "a's'", "\ufb01n,", "\u017f\u017f!", "\u01c4\u01c5", "\ud55c\uad6d\uc5b4.", "x2", "2x.", "\u00b2", "\u00aa\u00ba?",
        "<|endoftext|>", "a<|endoftext|>.", "a<|", "|>", "\u0e01\u0e33.", "\u0915\u094d\u0937", "\u00a0", "a\u00a0b,", "a\u2028b", "\u0345", "\u03c2\u03a3.", "\U0001d400", "\U0001f600.", "</w>", "w</w>", "a_b_", "_", "caf\u00c9.",
    ]
    for own in (odd, [w + " " + w + "." for w in odd], [w + v for w in odd for v in plain[:3]]):
        text = " ".join(own)
        got = tokens.WordEncoder(queries.vocabulary()).encode([text.encode(), *[w.encode() for w in own]])
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in (text, *own)]
        assert got == want


def test_small_latin_words_go_to_the_model_alone():
    """The whole tokenizer is asked for nothing it would change; a full stop or comma is learned once, not with each word."""
    asked = []

    class Counted:
        model = tokens.open_tokenizer(queries.vocabulary()).model

        def encode_batch_fast(self, lines, **options):
            asked.extend(lines)
            return tokenizer.encode_batch_fast(lines, **options)

    encoder = tokens.WordEncoder(queries.vocabulary())
    tokenizer, encoder.tokenizer = encoder.tokenizer, Counted()
    latin = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    text = "One, two. b\u00e9n\u00e9, stra\u00dfe. Three\nfour,five. \u00c9cole, x2. 3. ). !. a,. ,a . \u0915. e\u0301. d\u0323, end. "
    whole = [text, text + text, " ".join(latin), *(f"{c}, {c}a. a{c}, {c}{d}." for c in latin for d in ("\u00e9", "Z"))]
    for t in (*whole, "a. b<|endoftext|>, c.", ". , a, ", "a,", "a. "):
        assert encoder.encode([t.encode()]) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()]
    assert b"two" in encoder.known and b"two." not in encoder.known and b"four,five" in encoder.known
    asked.clear()
    words = [f"{a}{b}q\u00f8" + ("" if i % 2 else "r") for i, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "aeiou")]
    assert encoder.encode([", ".join(words).encode()]) == [np.array(tokenizer.encode(", ".join(words), add_special_tokens=False).ids, "<u4").tobytes()]
    assert asked == []


def test_capitals_that_compose():
    """Letters compose before they are lower-cased; some have no lower-case twin that composes alike."""
    t = tokens.open_tokenizer(queries.vocabulary())
    encoder = tokens.WordEncoder(queries.vocabulary())
    words = ["J\u030c", "T\u0308", "H\u0331", "W\u030a", "Y\u030a"]
    for text in (*words, " ".join(words), "AJ\u030cB ÉT\u0323\u0308É One Zürich x\u030c", *(w.lower() for w in words)):
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def mixed_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        w = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / w >= 2 * sizes[s]]
        if not full:
            return target | {s: left * weight[s] / w for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in full)
        open_ -= set(full)
    return target


def test_mix(spark, docs, empty):
    got = mixing.mix(docs).collect()
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    assert sorted(r.size for r in got) == sorted(len(WORD.findall(t)) for _, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    target, taken = mixed_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(target[s] + 1e-6) for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def check_packing(rows, want, size=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and (at == size or at & (at - 1) == 0)
    for doc, ids in want:
        if len([d for d, _ in want if d == doc]) == 1:
            at = 0
            for r in sorted(by_doc[doc], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids)) and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
                at += r.length
            assert at == len(ids)
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in want)


def test_pack(docs, empty):
    t = tokens.open_tokenizer(queries.vocabulary())
    want = [(d, np.array([*t.encode(x, add_special_tokens=False).ids, 1], dtype="<u4")) for d, x in pairs(docs)]
    check_packing(packing.pack(docs, queries.vocabulary()).collect(), want)
    check_packing(packing.pack(docs, queries.vocabulary(), most_open=2).collect(), want)
    assert packing.pack(empty, queries.vocabulary()).count() == 0


def test_packer_follows_the_rule():
    packer, rng = packing.Packer(64), random.Random(4)
    for _ in range(500):
        s, n = rng.randint(1, 63), packer.levels.copy()

        def squares(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + s < 64:
                m[h + s] += 1
            return int((m[1:64] ** 2).sum())

        options = [0, *(h for h in range(1, 64 - s + 1) if n[h])]
        assert squares(packer.level(s)) == min(map(squares, options))
        list(packer.add(1, bytes(4 * s)))


def near_components(rows, k=4, percent=80):
    """{row number: smallest id reachable} by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def as_rows(found):
    return sorted(((d is None, d or 0), n, (c is None, c or 0)) for d, n, c in found)


def test_near_groups(spark, docs, empty):
    got = oddsketch.near_groups(docs).collect()
    assert as_rows((r.doc_id, r.n_shingles, r.component_id) for r in got) == as_rows(near_components(pairs(docs)))
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    assert oddsketch.near_groups(empty).count() == 0
    left = oddsketch.deduplicate(docs, 5, 80)
    assert left.columns == docs.columns and left.filter("doc_id = 8").count() == 1 and left.filter("doc_id = 11").count() == 0


def test_links_inside_blocks(spark, monkeypatch):
    """All links of one bucket of variants, most of them below the threshold, over several blocks and bands."""
    base = prose(1, 120).split(" ")
    rng = random.Random(3)
    texts_ = []
    for k in range(90):
        words = list(base)
        for at in rng.sample(range(len(base)), rng.randint(1, 8)):
            words[at] = f"w{rng.randrange(40)}" if k % 2 else f"only{k}x{at}"
        texts_.append(" ".join(words).encode())
    shingler = oddsketch.Shingler(4)
    sets = [shingler(t) for t in texts_]
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    parent = list(range(90))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(90):
        for j in range(i):
            if alike(sets[i], sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = [root(i) for i in range(90)]
    assert 10 < len(set(want)) < 90
    samples = [oddsketch.min_hashes(s) for s in sets]
    classes = spark.createDataFrame(
        [(i, oddsketch.bands_of(m).tolist(), oddsketch.sketch_of(m).tolist()) for i, m in enumerate(samples)], "cid long, bands array<long>, sketch array<long>"
    )
    members = classes.select("cid", F.posexplode("bands").alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.count("*").alias("n"), (F.count("*") * 117).alias("weight")).filter("n > 1")
    met = members.join(buckets, "bucket")
    table_ = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "cid long, shingles array<long>")
    near = oddsketch.most_differing(0.8)
    for block, some in ((1024, 0), (20, 0), (20, 30)):  # `some` classes are in their components already
        monkeypatch.setattr(oddsketch, "BLOCK", block)
        roots = spark.createDataFrame([(i, want[i]) for i in range(some)], "cid long, root long")
        links = oddsketch.joined(met, roots, classes, table_, near, 80)
        assert links.count() < 90 * 12 and all(alike(sets[r.u], sets[r.v]) for r in links.collect())
        found = {r.cid: r.root for r in oddsketch.further(roots, links).collect()}
        groups = defaultdict(set)
        for i in range(90):
            groups[found.get(i, i)].add(want[i])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Chains of edits, many of them not linked with the group's first member; buckets are split into blocks."""
    monkeypatch.setattr(oddsketch, "BLOCK", 16)
    rng, base, rows = random.Random(9), prose(5, 150).split(" "), []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = oddsketch.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert as_rows((r.doc_id, r.n_shingles, r.component_id) for r in got) == as_rows(near_components(rows))


def test_odd_sketch_estimates():
    rng = np.random.default_rng(1)
    for shared in (300, 350, 400):
        a, b = (rng.integers(0, 2**64, 450 - shared, dtype=np.uint64) for _ in "ab")
        c = rng.integers(0, 2**64, shared, dtype=np.uint64)
        x, y = (oddsketch.sketch_of(oddsketch.min_hashes(np.concatenate([c, z]))).view(np.uint64) for z in (a, b))
        estimate = oddsketch.similar(np.bitwise_count(x ^ y).sum())
        assert abs(estimate - shared / (900 - shared)) < oddsketch.MARGIN


def exact_groups(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), d is None, d or 0))
    out = []
    for d, t in rows:
        name = re.sub(r"[\x20\x09-\x0D]", "", t)
        best = min(groups[name])
        keep = None if best[1] else best[2]
        out.append((d, keep, len(groups[name]), d == keep and -len(t) == best[0], hashlib.sha256(name.encode()).hexdigest()))
    return out


def test_exact_groups(docs, empty):
    got = [tuple(r) for r in cuckoo.exact_groups(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, exact_groups(pairs(docs))))
    assert cuckoo.exact_groups(empty).count() == 0
    left = cuckoo.deduplicate(docs)
    assert left.columns == docs.columns and left.count() == len({r[4] for r in got})


def test_cuckoo_index():
    index, rng, live = cuckoo.CuckooIndex(buckets=4, most_kicks=8), random.Random(2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for _ in range(12000):
        key = rng.choice(keys)
        assert index.get(key) == live.get(key)
        if key in live:
            assert index.delete(key)
            del live[key]
        else:
            index.insert(key, (rng.random(),))
            live[key] = index.get(key)
    assert dict(index.items()) == live and index.live == len(live) and index.resizes and not index.delete(b"0" * 32)


def test_toxicity_on_held_out_labels(spark, docs, empty):
    at = "/root/testdata/sf0.01"
    all_docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(all_docs, labels)
    got = toxicity.score(all_docs, model).join(labels, "doc_id").filter("held_out").toPandas()
    assert ((got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3)) == 1).all()
    caught = got[got.toxic == 1].predicted.mean()
    assert got[got.toxic == 0].predicted.mean() < 0.02 and caught > 0.6
    scores = model.scores([b"what an idiot", b"what an i d i o t.", b"what an id-iot", b"what an idiots", b"", b"what a day"])
    assert (scores[:4] > 0.5).all() and (scores[4:] < 0.2).all()
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.learn(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    left = toxicity.keep_civil(docs, model)
    assert left.columns == docs.columns and left.count() == sum(not r.predicted for r in got)


@pytest.mark.parametrize("text", [b"what an idiiot. Good day", b"Good day\nyou idiiot!\n", b"a\ni d i o t again"])
def test_toxic_word_at_a_sentence_edge_by_a_fresh_model(text):
    model = toxicity.Model([b"^idiot"], np.ones(1), -0.8, 4.0, 0.0)
    fresh, used = pickle.loads(pickle.dumps(model)), pickle.loads(pickle.dumps(model))
    used.margins([b"idiiot idiot"])
    assert fresh.margins([text])[0] == used.margins([text])[0] > model.bias


def test_longest_training_text_is_a_parameter(spark, monkeypatch):
    sizes = {7: 20_000, 8: 20_001, 9: 9, 10: 10, 11: 30_000}  # no held-out ids
    rows = spark.createDataFrame([(d, "x" * n) for d, n in sizes.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in sizes], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic: sorted(map(len, texts)))
    assert toxicity.learn(rows, labels) == [9, 10, 20_000]
    assert toxicity.learn(rows, labels, longest=30_000) == [9, 10, 20_000, 20_001, 30_000]


def test_subsequence_kernel():
    def plain(s, t, decay=0.6):
        from itertools import combinations

        total = 0
        for i in combinations(range(len(s)), 3):
            for j in combinations(range(len(t)), 3):
                if all(s[a] == t[b] for a, b in zip(i, j)):
                    total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
        return total

    words, marks = [b"^idiot", b"^iddio", b"abcabc"], [b"^idiot", b"^idot", b"cab"]
    got = toxicity.kernel(toxicity._matrix(words, 8), toxicity._matrix(marks, 8), 0.6)
    assert np.allclose(got, [plain(a, b) for a, b in zip(words, marks)], rtol=1e-4)


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/en/", "http://example.com", "http://example.com/fr/2",
    "https://a.b.net/es/", "https://net/fr/x", "https://a.net/en/", "https://planet/es/", "http://ads-track.example.org/x", "http://x.org/a?u=://example.com/en/",
    "http://m.adult-x.org", "http://İ.net/es/#", "http://a..net/fr/",
    "http://a.b.net/de/", "http://net/de/", "http://www.example.com/x", "http://b.net/es/", "http://b.net/fr/", "http://b.net/x",
]


def test_url_filter(spark):
    rows = [(i if i != 3 else None, u, "h") for i, u in enumerate(URLS)] + [(4, URLS[4], "h")]
    # Clashing names: of the page's parts, of the lists and of what comes out.
    clash = "host string, path string, row long, keys string, allow string, block string, best string, bad string, hosts string, rule string"
    pages = spark.createDataFrame([(*r, "p", 1, "k", "a", "b", "c", "d", "e", "f") for r in rows], f"page_id long, url string, {clash}")

    def ruled(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in cascade.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *max(fits, default=(0, None, None))[1:]

    votes = Counter()
    for _, u, _ in rows:
        host, _, _, verdict = ruled(u)
        votes[host] += {"block": 1, "allow": -1, None: 0}[verdict]
    listed = {h for h, n in votes.items() if h and n > 0}
    assert {"a.b.net", "net", "a..net"} <= listed
    for hosts in (None, {"x.org", "a.net"}):
        given = None if hosts is None else spark.createDataFrame([(h,) for h in hosts for _ in "ab"], "name string")
        got = sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in cascade.judge(pages, hosts=given).collect())))
        want = []
        for i, u, _ in rows:
            host, path, rule, verdict = ruled(u)
            want.append((i, host, path, rule, verdict or ("block" if host in (listed if hosts is None else hosts) else "allow")))
        assert got == sorted(map(str, want)) and any(w[3] is None and w[4] == "block" for w in want)
    assert cascade.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact_for_every_key(spark, monkeypatch):
    keys = spark.range(5000).select(F.xxhash64("id").alias("a"), F.xxhash64(F.lit(1), "id").alias("b"), (F.col("id") % 17 == 0).alias("is_listed")).cache()
    levels = cascade.build(keys)
    rows = keys.toPandas()
    assert len(levels) > 1 and (cascade.listed(levels, rows.a.to_numpy(), rows.b.to_numpy()) == rows.is_listed).all()
    pages = spark.createDataFrame([(1, "http://example.com/en/"), (2, "http://q.net/es/")], "page_id long, url string")
    want = sorted(map(str, cascade.judge(pages).collect()))
    monkeypatch.setattr(cascade, "MOST_BITS", 1)  # lists beyond the bound are joined
    assert sorted(map(str, cascade.judge(pages).collect())) == want


def struck(rows, span):
    seen, out = Counter(), []
    for _, t in rows:
        seen.update(t[i : i + span] for i in range(len(t) - span + 1))
    for d, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        out.append((d, len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(map(str, out))


def test_strike_repeats(spark, docs, empty):
    shared = prose(7, 160)
    rows = [(100 + i, prose(50 + i, 40 * i) + shared[i : 700 + 9 * i] + prose(80 + i, 60)) for i in range(9)] + [(200, "ab" * 900), (201, "z" * 399), (202, "z" * 400)]
    more = docs.select("doc_id", "text", "hash", "class").unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    want = struck([(d, t.encode()) for d, t in pairs(more)], 400)
    for most in (4000, 1):  # with 1, every mixed anchor is counted start by start
        assert sorted(map(str, (tuple(r) for r in suffixes.strike_repeats(more, most=most).collect()))) == want
    assert suffixes.strike_repeats(empty).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(0)
    for trial in range(60):
        n = int(rng.integers(0, 300))
        t = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        if n > 100:
            t[50:100] = t[:50]
        b = t.tobytes()
        order = suffixes.suffix_order(t, 1000)
        assert order.tolist() == sorted(range(n), key=lambda i: b[i:])
        shared = suffixes.common_prefixes(t, order, 16)
        assert all(shared[i] == (b[order[i] :][:16] == b[order[i - 1] :][:16] and len(b) - max(order[i], order[i - 1]) >= 16) for i in range(1, n))


def test_lm_scores(docs, empty):
    rows = [(d, [*WORD.findall(lower(t)), ""]) for d, t in pairs(docs)]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, ws in rows if not out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), out(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in rows)
    got = lbl.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lbl.score(empty).count() == 0


def test_lm_learns_and_is_normalised():
    rng = np.random.default_rng(3)
    cells = np.zeros((lbl.CLASSES,) * 3, dtype=np.int64)
    for one in range(8):  # each class is followed by the next one nine times of ten
        for two in range(8):
            cells[two, one, :8] += 1 + rng.integers(0, 3, 8)
            cells[two, one, (one + 1) % 8] += 200
    p = 10 ** lbl.train_model(cells).log_probabilities()
    assert np.allclose(p.sum(axis=1), 1)
    assert all(p[two * lbl.CLASSES + one].argmax() == (one + 1) % 8 for one in range(8) for two in range(8))
    assert np.allclose(lbl.train_model(np.zeros_like(cells)).log_probabilities(), -math.log10(lbl.CLASSES), atol=0.2)


def test_lm_tells_words_of_an_ending_apart(spark):
    """Two words equally common and with the same ending, each behind a word of its own: their order counts."""
    singles = [f"w{i:03d}" for i in range(62)]
    filler = " ".join(w for w in singles for _ in range(300))
    pairs_ = " ".join(["red talking blue walking"] * 200)
    docs = spark.createDataFrame([(0, filler), (1, pairs_), (3, pairs_), (4, "red talking " * 40), (5, "red walking " * 40), (6, filler)], "doc_id long, text string")
    assert lbl.shape_of(b"talking") == lbl.shape_of(b"walking")
    got = {r.doc_id: r for r in lbl.score(docs.union(docs.filter("doc_id < 4"))).collect()}
    assert not got[4].held_out and got[4].n_tokens == got[5].n_tokens
    assert got[4].score > got[5].score + 20


def test_lm_words_of_a_class_add_up_to_one():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 4, (lbl.CLASSES,) * 3)
    own = np.append(np.arange(lbl.SINGLES), lbl.SINGLES + np.arange(70) % lbl.SHAPES)
    classes, v = lbl.leaf_classes(own), lbl.context_vectors(lbl.train_model(cells, steps=20), cells)
    behind = cells.reshape(lbl.CONTEXTS, lbl.CLASSES).T.astype(np.float32)
    mine = np.flatnonzero(classes == lbl.SINGLES + 3)
    # One word stands behind the first half of the contexts only, the others share what is left.
    seen = np.zeros((lbl.CONTEXTS, len(mine)))
    seen[:, 1:] = (behind[lbl.SINGLES + 3] / (len(mine) - 1))[:, None]
    half = v[:, 0] < np.median(v[:, 0])
    seen[half, 0], seen[half, 1:] = behind[lbl.SINGLES + 3][half] / 2, seen[half, 1:] / 2
    vectors, heads = np.zeros((len(classes), v.shape[1]), np.float32), np.zeros(len(classes))
    vectors[mine], heads[mine] = lbl.fit_leaves(v, seen, classes[mine], behind), seen.sum(axis=0)
    words = lbl.Inside(v, vectors, classes, heads)
    for context in (0, 17, 95, 5000, lbl.CONTEXTS - 1):
        for c in range(lbl.SINGLES, lbl.CLASSES):
            leaves = np.flatnonzero(classes == c)
            assert abs((10 ** words.log_probabilities(np.full(len(leaves), context), leaves)).sum() - 1) < 1e-4
    p = 10 ** words.log_probabilities(np.arange(lbl.CONTEXTS), np.full(lbl.CONTEXTS, mine[0]))
    assert p[half].mean() > 3 * p[~half].mean()


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # ties beyond k
    rows += [(0, rows[7][1]), (600, None), (601, [1.0, None] * 3), (602, [float("nan")] * 6), (603, [float("inf")] * 6), (None, [1.0] * 6), (650, [0.5, 1.0]), (700, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, part long, ids string").repartition(4)
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect() if r.query_id != 0}
    want = {}
    for q, v in fine:
        if q % 50 == 0 and q != 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(found)}
    assert got == want
    # Blocks of few vectors make many ranges of candidates.
    small = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, most=3).collect() if r.query_id != 0}
    assert small == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, name):
    at = "/root/testdata/sf0.001"
    assert oracle.compare(spark, oracle.connect(at), at, queries.QUERIES[name], queries.SQL[name]) == ""


def test_pipeline_stages(spark, docs):
    """Each stage against the brute-force version of its operator, on what the stage before it kept."""
    at = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{at}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    model = toxicity.learn(rows, spark.read.parquet(f"{at}/labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    civil = stage["toxicity"](spark, rows, at).cache()
    assert set(pairs(civil)) == {(d, t) for d, t in pairs(rows) if model.scores([t.encode()])[0] < 0.7}
    once = stage["exact_dedup"](spark, civil, at).cache()
    assert sorted(d for d, _ in pairs(once)) == sorted(r[0] for r in exact_groups(pairs(civil)) if r[3])
    apart = stage["near_dedup"](spark, once, at).cache()
    assert sorted(d for d, _ in pairs(apart)) == sorted(d for d, _, c in near_components(pairs(once), 5) if d == c)
    mixed = stage["mixing"](spark, apart, at).cache()
    assert all(f.columns == rows.columns for f in (civil, once, apart, mixed))
    assert sum(len(WORD.findall(t)) for _, t in pairs(mixed)) == pytest.approx(1.5 * sum(len(WORD.findall(t)) for _, t in pairs(apart)), rel=0.2)
    t = tokens.open_tokenizer(queries.vocabulary())
    want = sum(len(t.encode(x, add_special_tokens=False).ids) + 1 for _, x in pairs(mixed))
    assert sum(r.length for r in stage["packing"](spark, mixed, at).collect()) == want
    # Ids that stand for several texts, and rows without ids, go through as well.
    odd = docs.select(*rows.columns)
    for name in names[1:]:
        odd = stage[name](spark, odd, at)
    assert odd.count() > 0


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "a b c", "en", "s", 3), (1, "a b c", "en", "s", 3)]])
def test_pipeline_of_few_rows_without_labels(spark, tmp_path, rows):
    """Empty documents give nothing; without labels no document is rejected, whatever is null in it."""
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts_ = {r[1] or "" for r in rows}
    assert len({(r.doc_id, r.doc_tokens) for r in got}) == len(texts_)
    assert sum(r.length for r in got) >= len(texts_)
