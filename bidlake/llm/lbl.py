"""Log-bilinear language model over words in classes, trained by noise-contrastive estimation.

The commonest words are classes of their own; all other words fall into classes by their ending. A token's
probability is that of its class, given the two classes before it, times that of the word within its class, given
the same two. Both are log-bilinear: the vectors of the two context classes, each through a matrix, predict a vector
whose products with the class vectors, plus biases, are the scores of the classes, and whose products with the vectors of
the words of a class, plus biases, are the scores of those words. Every word of the head has a vector; the
others of a class share those of `GROUPS` groups by hash, within which a word has an add-one share of the training tokens.

The class model is trained in numpy on the class trigrams of all training documents, which are counted on the cluster and
are at most CLASSES^3 numbers however large the corpus is. The vectors of words are trained on the cluster, in blocks, on
how often each stands behind each pair of classes in all training documents: with the context vectors given, the
estimation of one word does not touch that of another, and the noise is taken by its expectation instead of drawn.
Scores are normalised over all classes, and over all words and groups of each class.

Word counts are exact. The head, the `HEAD` commonest words and all that are seen `OWN` times, at most `MOST`, fits on every
task; each task picks its candidates over its whole share. Every other word of every document goes to a bucket of its
hash, where it is counted and from where its logarithms go back to the document, packed in arrays, so that no vocabulary
is ever in one place.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from bidlake.llm.common import lower_words, map_batches, text_or_empty
from bidlake.sources.writers import written

HEAD, OWN, MOST = 8192, 128, 131_072
SINGLES, SHAPES, GROUPS, WIDTH = 64, 32, 16, 24
CLASSES = SINGLES + SHAPES
CONTEXTS = CLASSES**2
#: Entry 0 of the head, and class 0, is the end of a text.
END = b""
TOKENS_PER_BUCKET, FLUSH = 2_000_000, 400_000
#: Words trained together, tokens whose contexts a task counts at a time; noise words for each seen one, and the weight of the prior.
BLOCK, PLACES = 256, 4_000_000
NOISE, RIDGE, ROUNDS = 4, 10.0, 8


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def shape_of(word: bytes) -> int:
    """The class of a word that has none of its own: closing mark or ending."""
    if word[-1:] in b".!?":
        return SINGLES + zlib.crc32(word[-3:-1]) % 6
    if word[-1:] in b",;:":
        return SINGLES + 6 + zlib.crc32(word[-3:-1]) % 6
    return SINGLES + 12 + zlib.crc32(word[-2:]) % 20


def group_of(key: np.ndarray) -> np.ndarray:
    """The group of a word beyond the head, of all groups of all classes, from its key."""
    key = key.astype(np.int64)
    return ((key & 127) - SINGLES) * GROUPS + (key >> 7) % GROUPS


def leaf_classes(own: np.ndarray) -> np.ndarray:
    """Class of each leaf, from the classes of the words of the head."""
    return np.append(own, SINGLES + np.arange(SHAPES * GROUPS) // GROUPS)


class Lexicon:
    """Numbers of words: those of the head first. By number: class, leaf and, beyond the head, a 64-bit key.

    The low bits of a key are the class and, above it, the group. Leaves are the words of the head and, behind them, the groups.
    """

    def __init__(self, head: list[bytes], memory: int = 200_000):
        self.head, self.memory = head, memory + len(head)
        self._begin()

    def _begin(self) -> None:
        self.place = {w: i for i, w in enumerate(self.head)}
        self.class_array = np.array([i if i < SINGLES else shape_of(w) for i, w in enumerate(self.head)], dtype=np.int64)
        self.key_array, self.leaf_array = np.zeros(len(self.head), dtype=np.uint64), np.arange(len(self.head))

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each token of all texts in a row, each with its end; tokens of each text)."""
        split = [lower_words(t) for t in texts]
        if len(self.place) > self.memory:
            self._begin()
        new = set().union(*split).difference(self.place)
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            c = np.array([shape_of(w) for w in new], dtype=np.int64)
            key = np.array([xxh64_intdigest(w) & ~127 for w in new], dtype=np.uint64) | c.astype(np.uint64)
            self.class_array, self.key_array = np.append(self.class_array, c), np.append(self.key_array, key)
            self.leaf_array = np.append(self.leaf_array, len(self.head) + group_of(key))
        lengths = np.array([len(s) + 1 for s in split], dtype=np.int64)
        flat = (self.place[w] for s in split for w in (*s, END))
        return np.fromiter(flat, dtype=np.int64, count=int(lengths.sum())), lengths


def contexts(classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of the two classes before each token; before a text stand ends."""
    one, two = np.zeros_like(classes), np.zeros_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    starts = np.cumsum(lengths) - lengths
    one[starts], two[starts] = 0, 0
    second = starts[lengths > 1] + 1
    two[second] = 0
    return two * CLASSES + one


# ---- what is gathered from the corpus ----------------------------------------------------------


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words most common in this task's share; rare ones are dropped as the count fills up."""
    count: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            count.update(lower_words(text))
        if len(count) > 400_000:
            least = 2
            while len(count) > 200_000:
                count = Counter({w: n for w, n in count.items() if n >= least})
                least *= 2
    top = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:MOST]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])


def head_words(train: DataFrame) -> list[bytes]:
    """The end and the common words of train(text): HEAD - 1 of them, and up to MOST - 1 that are seen OWN times."""
    found = map_batches(train.select("text"), _common, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "word").limit(MOST - 1).toArrow()
    words, n = top.column("word").to_pylist(), top.column("n").to_numpy()
    return [END, *words[: max(HEAD - 1, int((n >= OWN).sum()))]]


def blocks_of(leaves: int) -> int:
    return -(-leaves // BLOCK)


def _count(head: list[bytes]):
    leaves = len(head) + SHAPES * GROUPS
    blocks = blocks_of(leaves)
    area = BLOCK * CONTEXTS

    def placed(found: list[np.ndarray]) -> pa.RecordBatch:
        """How often each leaf stood in each context, by block: steps from one filled cell to the next, and counts."""
        cell = np.sort(np.concatenate(found))
        at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        cell, n = cell[at], np.diff(np.append(at, len(cell)))
        cuts = np.append(np.flatnonzero(np.append(True, cell[1:] // area != cell[:-1] // area)), len(cell))
        block = cell[cuts[:-1]] // area
        data = [np.diff(cell[i:j] % area, prepend=0).astype("<u4").tobytes() + n[i:j].astype("<u4").tobytes() for i, j in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.nulls(len(data), pa.int64()), pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["part", "block", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(head)
        cells, heads = np.zeros(CLASSES**3, dtype=np.int64), np.zeros(leaves, dtype=np.int64)
        found: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            n, lengths = lexicon.numbers(batch.column("text").cast(pa.binary()).to_pylist())
            c, leaf = lexicon.class_array[n], lexicon.leaf_array[n]
            context = contexts(c, lengths)
            cells += np.bincount(context * CLASSES + c, minlength=CLASSES**3)
            heads += np.bincount(leaf, minlength=leaves)
            inside = c >= SINGLES
            leaf = leaf[inside]
            found.append((leaf % blocks * BLOCK + leaf // blocks) * CONTEXTS + context[inside])
            if sum(map(len, found)) >= PLACES:
                yield placed(found)
                found = []
        if sum(map(len, found)):
            yield placed(found)
        parts = [(i, x) for i, x in enumerate(cells.reshape(CLASSES, -1)) if x.any()] + [(CLASSES, heads)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in parts], pa.int64()), pa.nulls(len(parts), pa.int64()), pa.array([zlib.compress(x.tobytes(), 1) for _, x in parts], pa.binary())],
            names=["part", "block", "counts"],
        )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
            x = np.frombuffer(zlib.decompress(counts), dtype=np.int64)
            total[part] = total[part] + x if part in total else x
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "counts"]
    )


def gather(train: DataFrame, head: list[bytes]) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(class trigram counts, counts of the leaves, counts of leaves by context in blocks) of all of train(text)."""
    stored = written(map_batches(train.select("text"), _count(head), "part long, block long, counts binary"), "lm_counts")
    rows = stored.filter("part is not null").select("part", "counts").repartition("part").mapInArrow(_add, "part long, counts binary").collect()  # CLASSES + 1 rows
    cells, heads = np.zeros((CLASSES, CLASSES**2), dtype=np.int64), np.zeros(len(head) + SHAPES * GROUPS, dtype=np.int64)
    for r in rows:
        x = np.frombuffer(bytes(r.counts), dtype=np.int64)
        if r.part < CLASSES:
            cells[r.part] = x
        else:
            heads = x
    return cells.reshape(CLASSES, CLASSES, CLASSES), heads, stored.filter("part is null").select("block", "counts")


# ---- the model --------------------------------------------------------------------------------


class Model:
    """Class vectors, two context matrices, biases."""

    def __init__(self, unigram: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.p = {
            "target": rng.normal(0, 0.1, (CLASSES, WIDTH)), "context": rng.normal(0, 0.1, (CLASSES, WIDTH)),
            "near": np.eye(WIDTH), "far": 0.5 * np.eye(WIDTH), "bias": np.log(unigram),
        }

    def predict(self, context: np.ndarray) -> np.ndarray:
        p = self.p
        return p["context"][context % CLASSES] @ p["near"] + p["context"][context // CLASSES] @ p["far"]

    def log_probabilities(self) -> np.ndarray:
        """log10 P(class | context) for every context, normalised over the classes, block by block."""
        out = np.empty((CLASSES**2, CLASSES), dtype=np.float64)
        for i in range(0, CLASSES**2, 1024):
            s = self.predict(np.arange(i, min(i + 1024, CLASSES**2))) @ self.p["target"].T + self.p["bias"]
            top = s.max(axis=1, keepdims=True)
            out[i : i + 1024] = s - top - np.log(np.exp(s - top).sum(axis=1, keepdims=True))
        return out / np.log(10)


def train_model(cells: np.ndarray, steps: int = 1500, batch: int = 1024, noise: int = 48, rate: float = 0.02, seed: int = 11) -> Model:
    """Noise-contrastive estimation: tell the class that came from `noise` classes drawn by their frequency."""
    unigram = (cells.sum(axis=(0, 1)) + 0.5) / (cells.sum() + 0.5 * CLASSES)
    model, rng = Model(unigram), np.random.default_rng(seed)
    flat = np.flatnonzero(cells)
    if not len(flat):
        return model
    chance = np.cumsum(cells.ravel()[flat].astype(float))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    log_noise, unit = np.log(noise * unigram), np.eye(CLASSES)
    for step in range(1, steps + 1):
        cell = flat[np.searchsorted(chance, rng.random(batch) * chance[-1], side="right").clip(max=len(flat) - 1)]
        context, seen = cell // CLASSES, cell % CLASSES
        drawn = rng.choice(CLASSES, noise, p=unigram / unigram.sum())
        p = model.p
        v = model.predict(context)
        delta = lambda s, c: s + p["bias"][c] - log_noise[c]
        good = 1 / (1 + np.exp(delta((v * p["target"][seen]).sum(axis=1), seen)))  # 1 - P(true)
        bad = 1 / (1 + np.exp(-delta(v @ p["target"][drawn].T, drawn)))  # P(true) of the noise
        dv = good[:, None] * p["target"][seen] - bad @ p["target"][drawn]
        one, two = context % CLASSES, context // CLASSES
        # Rows are summed by class through products with unit vectors.
        to_seen, to_drawn, to_one, to_two = (unit[i].T for i in (seen, drawn, one, two))
        grad = {
            "target": to_seen @ (good[:, None] * v) - to_drawn @ (bad.T @ v),
            "bias": to_seen @ good - to_drawn @ bad.sum(axis=0),
            "context": to_one @ (dv @ p["near"].T) + to_two @ (dv @ p["far"].T),
            "near": p["context"][one].T @ dv, "far": p["context"][two].T @ dv,
        }
        now = rate * (1 - step / (steps + 1))
        for k, g in grad.items():
            g = g / batch
            m, s = moments[k]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p[k] += now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def context_vectors(model: Model, cells: np.ndarray) -> np.ndarray:
    """The vector that each context predicts, and a 1; turned so that its entries are independent over the training tokens."""
    v = model.predict(np.arange(CONTEXTS))
    weight = cells.reshape(CONTEXTS, CLASSES).sum(axis=1) + 1e-3
    v = v - np.average(v, axis=0, weights=weight)
    size, axes = np.linalg.eigh((v * weight[:, None]).T @ v / weight.sum())
    return np.append(v @ axes / np.sqrt(size + 1e-6), np.ones((CONTEXTS, 1)), axis=1).astype(np.float32)


def fit_leaves(v: np.ndarray, seen: np.ndarray, classes: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Vectors of leaves, one a row: what a context adds to the logarithm of a leaf's share of its class.

    seen: how often each leaf (column) stood in each context (row); behind: the same of each class. Noise: NOISE words of the
    class for each seen one, by their share, in the contexts of the class. The prior draws a vector to 0.
    """
    out = np.zeros((len(classes), v.shape[1]), dtype=np.float32)
    total = seen.sum(axis=0)
    for c in np.unique(classes[total > 0]):
        mine = np.flatnonzero((classes == c) & (total > 0))
        rows = np.flatnonzero(behind[c])
        n, x = seen[np.ix_(rows, mine)].astype(np.float32), v[rows]
        weight = behind[c][rows].astype(np.float64)
        noise = (NOISE / weight.sum() * weight[:, None] * total[mine]).astype(np.float32)
        size, axes = np.linalg.eigh((x * (weight / weight.sum())[:, None]).T.astype(np.float64) @ x)
        # Steps by the curvature at 0, which is little less than the largest one.
        step = 0.6 / (total[mine] * NOISE / (1 + NOISE) * size.clip(min=0)[:, None] + RIDGE)
        theta = np.zeros((v.shape[1], len(mine)))
        both = n + noise
        for _ in range(ROUNDS):
            z = x @ theta.astype(np.float32) - np.float32(np.log(NOISE))
            np.clip(z, -30, 30, out=z)
            slope = (x.T @ (n - both / (1 + np.exp(-z)))).astype(np.float64) - RIDGE * theta
            theta += axes @ (step * (axes.T @ slope))
        out[mine] = theta.T
    return out


def _fit(v: np.ndarray, classes: np.ndarray, behind: np.ndarray):
    blocks = blocks_of(len(classes))

    def fitted(block: int, parts: np.ndarray) -> tuple[int, bytes]:
        mine = np.arange(block, len(classes), blocks)
        return block, fit_leaves(v, parts.reshape(BLOCK, CONTEXTS).T[:, : len(mine)], classes[mine], behind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their blocks."""
        now, total, out = None, np.zeros(0), []
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                if block != now:
                    if now is not None:
                        out.append(fitted(now, total))
                    now, total = block, np.zeros(BLOCK * CONTEXTS)
                k = len(counts) // 8
                total[np.cumsum(np.frombuffer(counts, "<u4", k), dtype=np.int64)] += np.frombuffer(counts, "<u4", k, 4 * k)
        if now is not None:
            out.append(fitted(now, total))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], names=["block", "vectors"])

    return run


class Inside:
    """Probability of a leaf within its class, given the context."""

    def __init__(self, v: np.ndarray, vectors: np.ndarray, classes: np.ndarray, heads: np.ndarray):
        self.v, self.vectors, self.classes = v, vectors, classes
        size = np.bincount(classes, minlength=CLASSES) + np.bincount(classes, weights=heads, minlength=CLASSES)
        self.share = np.log((heads + 1) / size[classes])
        self.norm = np.zeros((CONTEXTS, SHAPES), dtype=np.float32)
        for c in range(SINGLES, CLASSES):
            mine = np.flatnonzero(classes == c)
            for i in range(0, CONTEXTS, 1024):
                total = np.zeros(len(v[i : i + 1024]))
                for j in range(0, len(mine), 1024):
                    m = mine[j : j + 1024]
                    total += np.exp(v[i : i + 1024] @ vectors[m].T + self.share[m].astype(np.float32)).sum(axis=1)
                self.norm[i : i + 1024, c - SINGLES] = np.log(total)

    def log_probabilities(self, context: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """log10 P(leaf | class of it, context)."""
        out = np.empty(len(leaf))
        for i in range(0, len(leaf), 8192):
            x, y = context[i : i + 8192], leaf[i : i + 8192]
            out[i : i + 8192] = np.einsum("ij,ij->i", self.v[x], self.vectors[y]) + self.share[y] - self.norm[x, self.classes[y] - SINGLES]
        return out / np.log(10)


def train_inside(model: Model, cells: np.ndarray, heads: np.ndarray, places: DataFrame, own: np.ndarray) -> Inside:
    """The vectors of all leaves. own: the classes of the words of the head."""
    v, classes = context_vectors(model, cells), leaf_classes(own)
    behind, blocks = cells.reshape(CONTEXTS, CLASSES).T.astype(np.float32), blocks_of(len(classes))
    rows = places.repartition(-(-blocks // 4), "block").sortWithinPartitions("block")
    vectors = np.zeros((len(classes), v.shape[1]), dtype=np.float32)
    for r in map_batches(rows, _fit(v, classes, behind), "block long, vectors binary").collect():  # 100 bytes a leaf
        vectors[r.block :: blocks] = np.frombuffer(bytes(r.vectors), np.float32).reshape(-1, v.shape[1])
    return Inside(v, vectors, classes, heads)


# ---- scoring ----------------------------------------------------------------------------------


def _score(head: list[bytes], heads: np.ndarray, model: Model, words: Inside, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, task, first = Lexicon(head), TaskContext.get().partitionId(), 0
        table, logs = model.log_probabilities().ravel(), np.log10(heads[: len(head)] + 1.0)
        rare: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def rows(kind: list[int], bucket: list[int], data: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array([task] * len(kind), pa.int64()), pa.array(bucket, pa.int64()), pa.array(data, pa.binary())],
                names=["kind", "task", "bucket", "data"],
            )

        def flush() -> pa.RecordBatch:
            key, doc, n = (np.concatenate(x) for x in zip(*rare))
            rare.clear()
            bucket = ((key >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            parts = np.split(order, cuts)
            return rows([0] * len(parts), [int(bucket[p[0]]) for p in parts], [key[p].tobytes() + doc[p].tobytes() + n[p].tobytes() for p in parts])

        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n, lengths = lexicon.numbers(batch.column("text").cast(pa.binary()).to_pylist())
            doc = np.repeat(np.arange(len(lengths)), lengths)
            c = lexicon.class_array[n]
            common = n < len(head)
            add = lambda mask, x: np.bincount(doc[mask], weights=x, minlength=len(lengths))
            every = np.ones(len(n), dtype=bool)
            context, leaf = contexts(c, lengths), lexicon.leaf_array[n]
            class_log = add(every, table[context * CLASSES + c])
            head_log = add(common, logs[n[common]])
            inside = c >= SINGLES
            inside_log = add(inside, words.log_probabilities(context[inside], leaf[inside]))
            known = add(common, heads[n[common]] > 0).astype(np.int64)
            groups, times = np.unique(doc[~common] * (SHAPES * GROUPS) + leaf[~common] - len(head), return_counts=True)
            out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("doc_id")
            whole = np.stack([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), out, lengths, known]).astype("<i8")
            parts = (np.int64([first, len(lengths)]), whole, np.stack([class_log, head_log, inside_log]), groups.astype("<u4"), times.astype("<u4"))
            yield rows([1], [-1], [zlib.compress(b"".join(x.tobytes() for x in parts), 1)])
            if not common.all():
                # A rare word of a document, once with how often: bit 0 says whether it counts as training.
                pair = np.stack([lexicon.key_array[n[~common]], (doc[~common] + first).astype(np.uint64)])
                order = np.lexsort(pair)
                pair = pair[:, order]
                new = np.append(True, (pair[:, 1:] != pair[:, :-1]).any(axis=0))
                times = np.diff(np.append(np.flatnonzero(new), len(new)))
                docs = pair[1, new].astype(np.int64)
                rare.append((pair[0, new], docs.astype("<u4"), (2 * times + (1 - out[docs - first])).astype("<u4")))
                held += int(new.sum())
            first += len(lengths)
            if held >= FLUSH:
                yield flush()
                held = 0
        if rare:
            yield flush()

    return run


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count the words of each bucket; give each task its documents' logarithms, and the number of words of each group."""
    held: dict[int, list] = {}
    for batch in batches:
        for task, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("task", "bucket", "data"))):
            held.setdefault(bucket, []).append((task, data))
    kinds, tasks, out = [], [], []
    distinct = np.zeros(SHAPES * GROUPS, dtype=np.int64)
    for bucket in list(held):
        parts = held.pop(bucket)
        sizes = [len(d) // 16 for _, d in parts]
        key = np.concatenate([np.frombuffer(d, "<u8", n) for (_, d), n in zip(parts, sizes)])
        doc = np.concatenate([np.frombuffer(d, "<u4", n, 8 * n) for (_, d), n in zip(parts, sizes)]).astype(np.int64)
        n = np.concatenate([np.frombuffer(d, "<u4", k, 12 * k) for (_, d), k in zip(parts, sizes)]).astype(np.int64)
        task = np.repeat([t for t, _ in parts], sizes)
        times, train = n >> 1, n & 1
        words, place = np.unique(key, return_inverse=True)
        c = np.bincount(place, weights=times * train, minlength=len(words))
        distinct += np.bincount(group_of(words[c > 0]), minlength=len(distinct))
        logs, known = times * np.log10(c[place] + 1), times * (c[place] > 0)
        order = np.lexsort((doc, task))
        start = np.flatnonzero(np.append(True, (np.diff(task[order]) != 0) | (np.diff(doc[order]) != 0)))
        logs, known = np.add.reduceat(logs[order], start), np.add.reduceat(known[order], start)
        task, doc = task[order][start], doc[order][start]
        for p in np.split(np.arange(len(task)), np.flatnonzero(np.diff(task)) + 1):
            kinds.append(2), tasks.append(int(task[p[0]]))
            out.append(logs[p].tobytes() + doc[p].astype("<u4").tobytes() + known[p].astype("<u4").tobytes())
    kinds.append(3), tasks.append(-1), out.append(distinct.astype("<i8").tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(tasks, pa.int64()), pa.array(out, pa.binary())], names=["kind", "task", "data"])


def _finish(n_train: int, v_train: int, inside: np.ndarray):
    """All parts of a task's documents to their rows. inside: log10 of the shares' divisor, per group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for kind, task, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "task", "data"))):
                held.setdefault(task, ([], []))[kind - 1].append(data)
        for task in list(held):
            own, rare = held.pop(task)
            own = sorted((zlib.decompress(d) for d in own), key=lambda d: np.frombuffer(d, "<i8", 1)[0])
            total = sum(int(np.frombuffer(d, "<i8", 1, 8)[0]) for d in own)
            logs, known = np.zeros(total), np.zeros(total)
            for d in rare:
                k = len(d) // 16
                at = np.frombuffer(d, "<u4", k, 8 * k)
                np.add.at(logs, at, np.frombuffer(d, "<f8", k))
                np.add.at(known, at, np.frombuffer(d, "<u4", k, 12 * k))
            for d in own:
                first, k = np.frombuffer(d, "<i8", 2)
                ids, null, out, tokens, seen = np.frombuffer(d, "<i8", 5 * k, 16).reshape(5, k)
                class_log, head_log, inside_log = np.frombuffer(d, "<f8", 3 * k, 16 + 40 * k).reshape(3, k)
                groups, times = np.frombuffer(d, "<u4", -1, 16 + 64 * k).reshape(2, -1)
                divisor = np.bincount(groups // len(inside), weights=times * inside[groups % len(inside)], minlength=k)
                mine = slice(int(first), int(first + k))
                base = head_log + logs[mine] - tokens * np.log10(n_train + v_train + 1)
                score = class_log + inside_log + logs[mine] - divisor
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(out.astype(bool)), pa.array(tokens), pa.array(seen + known[mine].astype(np.int64)),
                     pa.array(np.full(k, n_train)), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs(doc_id, text).

    A null text counts as empty: its end alone. Repeated rows count and score each; a null doc_id stays null and
    counts as training; other columns are not read. Without training documents all classes are as likely.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_or_empty().alias("text"))
    train = rows.filter(~F.col("held_out"))
    head = head_words(train)
    cells, heads, places = gather(train, head)
    model, own = train_model(cells), Lexicon(head).class_array
    words = train_inside(model, cells, heads, places, own)
    n_train = int(cells.sum())
    buckets = max(16, n_train // TOKENS_PER_BUCKET)
    scored = written(map_batches(rows.select("doc_id", "held_out", "text"), _score(head, heads, model, words, buckets), "kind int, task long, bucket long, data binary"), "scored")
    rare = scored.filter("kind = 0").select("task", "bucket", "data").repartition(buckets, "bucket")
    counted = written(map_batches(rare, _bucket, "kind int, task long, data binary"), "counted")
    distinct = np.zeros(SHAPES * GROUPS, dtype=np.int64)
    for r in counted.filter("kind = 3").select("data").toLocalIterator():  # 4 KB a task, one by one
        distinct += np.frombuffer(bytes(r.data), dtype="<i8")
    v_train = int((heads[: len(head)] > 0).sum() + distinct.sum())
    shares = heads[len(head) :] + distinct + 1
    parts = scored.filter("kind = 1").select("kind", "task", "data").union(counted.filter("kind = 2").select("kind", "task", "data"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return map_batches(parts.repartition("task"), _finish(n_train, v_train, np.log10(shares.astype(float))), schema, 4096)
