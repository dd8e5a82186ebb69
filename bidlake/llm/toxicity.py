"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

The kernel of two strings adds up, over common subsequences of three characters, the decay to the power
of the lengths they span, so `id.iot` and `idiiot` stay near `idiot`. It is taken between words and landmarks, short
strings mined from labelled documents: word beginnings that tell toxic documents from others (each occurs in
documents that hold few of the earlier ones). A sentence is the largest value of its words per landmark,
mapped by the inverse root of the landmarks' own kernel matrix. A linear machine is fitted to sentences; a
toxic document gives the sentences the current machine finds worst, the others give sentences that are all clean.
The worst sentence of a document is its margin, which a logistic fit turns into a score.

Training takes at most `SAMPLE` labelled documents of each class, those of smallest hash, if not over `SAMPLE_CHARS`
characters long. Scoring reads whole texts:
each task remembers the words it has met, so a word is compared with the landmarks once.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from bidlake.llm.common import LOWER, SPACES, UPPER, map_batches, text_or_empty
from bidlake.llm.oddsketch import min_hashes

SAMPLE, SAMPLE_CHARS, LANDMARKS, LONGEST, COVER = 2000, 20_000, 32, 24, 4
DECAY, FLOOR, CUTOFF = 0.6, 0.4, 0.7

_LOWER = bytes.maketrans((SPACES + UPPER).encode(), (" " * len(SPACES) + LOWER).encode())
_MARKS = b".,;:!?\"'()[]{}<>|*_-/"
#: A sentence ends at a mark before white space, or at a line's end.
_SENTENCE = re.compile(rb"[.!?]+(?=[ \t\n\x0b\x0c\r])|\n")
_SPELLED = re.compile(rb"(?<![^ ])(?:[a-z0-9@$] ){2,}[a-z0-9@$](?=[ .,;:!?]|$)")
_BIT = np.array([b - 97 if 97 <= b < 123 else 26 + b % 6 for b in range(256)], dtype=np.uint32)


def kernel(words: np.ndarray, marks: np.ndarray, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of three characters of pairs of rows of two byte matrices, padded with 0."""
    n, l1, l2 = len(words), words.shape[1], marks.shape[1]
    same = (words[:, :, None] == marks[:, None, :]) & (words[:, :, None] > 0)
    own = same.transpose(1, 2, 0).astype(np.float32) * decay**2
    total = np.zeros(n, dtype=np.float32)
    for step in range(2):
        held = np.zeros((l1 + 1, l2 + 1, n), dtype=np.float32)
        after = np.zeros_like(own)
        for i in range(l1):
            for j in range(l2):
                after[i, j] = same[:, i, j] * held[i, j] * decay**2
                held[i + 1, j + 1] = own[i, j] + decay * (held[i, j + 1] + held[i + 1, j]) - decay**2 * held[i, j]
        own = after
    return total + own.sum(axis=(0, 1))


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(s[:width].ljust(width, b"\0") for s in strings), dtype=np.uint8).reshape(len(strings), width)


def _masks(strings: list[bytes]) -> np.ndarray:
    """The letters of each string, a bit each."""
    flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
    starts = np.cumsum([0, *map(len, strings[:-1])])
    return np.bitwise_or.reduceat(np.uint32(1) << _BIT[flat], starts)


def spellings(piece: bytes) -> list[bytes]:
    """A word as it is compared: `^` and the word without punctuation; a long one in overlapping parts."""
    word = b"^" + piece.translate(None, _MARKS)
    if len(word) <= LONGEST:
        return [word] if len(word) > 3 else []
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


@dataclass
class Model:
    """Landmarks, what each is worth, and the logistic fit; `weights` holds the map and the machine in one."""

    marks: list[bytes]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    decay: float = DECAY
    memory: int = 300_000
    seen: set = field(default_factory=set, repr=False)
    near: dict = field(default_factory=dict, repr=False)
    near_words: set = field(default_factory=set, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"seen": set(), "near": {}, "near_words": set()}

    def learn_words(self, pieces: set[bytes]) -> None:
        """Compare new words with the landmarks; words near none of them are only remembered as seen."""
        if len(self.seen) > self.memory:
            self.seen, self.near, self.near_words = set(), {}, set()
        new = list(pieces - self.seen)
        self.seen.update(new)
        if not new or not self.marks:
            return
        parts = [(i, s) for i, p in enumerate(new) for s in spellings(p)]
        if not parts:
            return
        marks = _matrix(self.marks, max(map(len, self.marks)))
        own = kernel(marks, marks, self.decay)
        mark_bits = _masks(self.marks)
        # A word short of more than one letter of a landmark cannot reach the floor.
        need = np.maximum(2, np.bitwise_count(mark_bits).astype(int) - 1)
        bits = _masks([s for _, s in parts])
        where, mark = np.nonzero(np.bitwise_count(bits[:, None] & mark_bits[None, :]) >= need[None, :])
        values: dict[int, np.ndarray] = {}
        text = _matrix([s for _, s in parts], LONGEST)
        for i in range(0, len(where), 4096):
            w, m = where[i : i + 4096], mark[i : i + 4096]
            longest = int((text[w] > 0).sum(axis=1).max())
            v = np.minimum(1, kernel(text[w, :longest], marks[m], self.decay) / own[m])
            for a, b, x in zip(w[v >= FLOOR].tolist(), m[v >= FLOOR].tolist(), v[v >= FLOOR].tolist()):
                row = values.setdefault(parts[a][0], np.zeros(len(self.marks), dtype=np.float32))
                row[b] = max(row[b], x)
        self.near.update((new[i], row) for i, row in values.items())
        self.near_words.update(new[i] for i in values)

    def sentences(self, text: bytes) -> list[np.ndarray]:
        """The pooled values of the sentences that have a word near a landmark."""
        out = []
        for words in sentence_words(text):
            hits = words.intersection(self.near_words)
            if hits:
                out.append(np.max([self.near[w] for w in hits], axis=0))
        return out

    def features(self, texts: list[bytes]) -> list[list[np.ndarray]]:
        out = []
        for i in range(0, len(texts), 256):
            part = texts[i : i + 256]
            # What is learned must be what `sentences` looks up: a mark that ends a sentence belongs to no word.
            pieces = [set().union(*sentence_words(t)) for t in part]
            self.learn_words(set().union(*pieces))
            out += [self.sentences(t) if not p.isdisjoint(self.near_words) else [] for t, p in zip(part, pieces)]
        return out

    def margins(self, texts: list[bytes]) -> np.ndarray:
        return np.array([max([self.bias, *(self.bias + float(self.weights @ s) for s in x)]) for x in self.features(texts)])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * flattened(self.margins(texts)) + self.shift)))


def flattened(margin: np.ndarray) -> np.ndarray:
    """Beyond 1, where the machine is content, a margin says little more."""
    return np.minimum(margin, 1 + 0.1 * (margin - 1))


def words_of(text: bytes) -> set[bytes]:
    """Distinct words, lower-cased, and words spelled out letter by letter."""
    text = text.translate(_LOWER)
    words = set(text.split(b" "))
    for m in _SPELLED.findall(text):
        words.add(m.replace(b" ", b""))
    return words


def sentence_words(text: bytes) -> Iterator[set[bytes]]:
    """The words of each sentence."""
    return map(words_of, _SENTENCE.split(text))


def starts_of(text: bytes) -> Iterator[bytes]:
    """The beginnings, of four to nine letters, of the words of a text."""
    return (s[:n] for w in words_of(text) for s in spellings(w)[:1] for n in range(5, min(len(s), 10) + 1))


def hashed_starts(text: bytes) -> np.ndarray:
    """Distinct hashes of them; the strings themselves would fill the driver."""
    return np.unique(np.array([xxh64_intdigest(s) for s in starts_of(text)], dtype=np.uint64))


def one_of_each(hashes: list[np.ndarray]) -> list[int]:
    """The first text of each family of near copies, which would else pass for many witnesses."""
    seen: set[tuple[int, bytes]] = set()
    first = []
    for i, h in enumerate(hashes):
        m = min_hashes(h)
        bands = {(k, m[k : k + 6].tobytes()) for k in range(0, len(m) - 5, 6)} if len(h) else set()
        if bands.isdisjoint(seen):
            first.append(i)
        seen |= bands
    return first


def likelihood_ratio(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Twice the log likelihood ratio of a of n1 against b of n0."""
    fit = lambda k, n, p: k * np.log(np.maximum(p, 1e-300)) + (n - k) * np.log(np.maximum(1 - p, 1e-300))
    p = (a + b) / (n1 + n0)
    return 2 * (fit(a, n1, a / n1) + fit(b, n0, b / n0) - fit(a, n1, p) - fit(b, n0, p))


def mine_landmarks(texts: list[bytes], hashes: list[np.ndarray], toxic: np.ndarray) -> list[bytes]:
    """Word beginnings of toxic documents, each the best for those that hold few of the earlier ones.

    A beginning must be so much commoner among toxic documents that chance would not show one such among all that
    are tried (likelihood ratio).
    """
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    seen, a = np.unique(np.concatenate([h for h, t in zip(hashes, toxic) if t]), return_counts=True)
    seen, a = seen[a >= 3], a[a >= 3]
    b = np.zeros(len(seen), dtype=np.int64)
    for h, t in zip(hashes, toxic):
        if not t:
            b += np.isin(seen, h, assume_unique=True)
    good = (a * n0 > 4 * b * n1) & (likelihood_ratio(a, b, n1, n0) > 2 * np.log(20 * max(1, len(seen))))
    wanted = dict(zip(seen[good].tolist(), b[good].tolist()))
    held: dict[bytes, set[int]] = {}
    clean: dict[bytes, int] = {}
    for i in np.flatnonzero(toxic):
        for s in set(starts_of(texts[i])):
            if (h := xxh64_intdigest(s)) in wanted:
                held.setdefault(s, set()).add(int(i))
                clean[s] = wanted[h]
    # A document stays open until `COVER` landmarks occur in it; longer forms of a landmark add nothing.
    marks, times, open_ = [], Counter(), set(np.flatnonzero(toxic).tolist())
    while held and len(marks) < LANDMARKS:
        worth = {s: len(d & open_) / (1 + 20 * clean[s] * n1 / n0 / len(d)) for s, d in held.items()}
        best = max(held, key=lambda s: (worth[s], len(s), s))
        if worth[best] < 2:
            break
        marks.append(best)
        times.update(held[best])
        open_ = {i for i in open_ if times[i] < COVER}
        held = {s: d for s, d in held.items() if not s.startswith(best) and not best.startswith(s)}
    return marks


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 100.0, steps: int = 500) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, both classes of equal weight, by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y, 1.0, -1.0)
    weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum())) * cost
    rate = 1 / (1 + 2 * cost * (x1**2).sum(axis=1).max())
    w = z = np.zeros(x1.shape[1])
    for t in range(steps):
        gap = np.maximum(0, 1 - sign * (x1 @ z))
        step = z - rate * (np.append(z[:-1], 0) - 2 * x1.T @ (weight * gap * sign))
        z = step + t / (t + 3) * (step - w)
        w = step
    return w[:-1], float(w[-1])


def fit_logistic(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the chance of label 1, with targets kept off 0 and 1 (Platt)."""
    n1, n0 = y.sum(), (~y).sum()
    target = np.where(y, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x1, w = np.stack([margin, np.ones(len(margin))], axis=1), np.zeros(2)
    loss = lambda w: float((np.logaddexp(0, x1 @ w) - target * (x1 @ w)).sum())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + 1e-6 * np.eye(2)
        move = np.linalg.solve(h, x1.T @ (p - target))
        while loss(w - move) > loss(w) and np.abs(move).max() > 1e-9:
            move = move / 2
        w = w - move
    return float(max(w[0], 0)), float(w[1])


def train(texts: list[bytes], toxic: np.ndarray) -> Model:
    """The model of labelled texts. Without both classes every text scores their share of toxic ones."""
    share = float(np.clip(toxic.mean() if len(toxic) else 0.0, 1e-6, 1 - 1e-6))
    flat = Model([], np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    if not len(toxic) or toxic.all() or not toxic.any():
        return flat
    hashes = [hashed_starts(t) for t in texts]
    first = one_of_each(hashes)
    texts, toxic, hashes = [texts[i] for i in first], toxic[first], [hashes[i] for i in first]
    if toxic.all() or not toxic.any():
        return flat
    marks = mine_landmarks(texts, hashes, toxic)
    if not marks:
        return flat
    model = Model(marks, np.ones(len(marks)), 0.0, 1.0, 0.0)
    m = _matrix(marks, max(map(len, marks)))
    pairs = kernel(np.repeat(m, len(m), axis=0), np.tile(m, (len(m), 1))).reshape(len(m), len(m)).astype(float)
    scale = np.sqrt(np.diag(pairs))
    values, vectors = np.linalg.eigh(pairs / scale[:, None] / scale[None, :])
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    sentences = model.features(texts)
    none = np.zeros(len(marks), dtype=np.float32)
    for turn in range(3):
        # Of a toxic document the sentences that are bad by now, of another the three worst.
        x, y = [], []
        for s, t in zip(sentences, toxic):
            worst = sorted(s, key=lambda v: -float(model.weights @ v))[: None if t else 3]
            if t:
                worst = [v for v in worst if (v.max() > 0.9 if turn == 0 else model.bias + model.weights @ v > 0)]
            if t and not worst:
                continue
            x += [*worst] if t else [*worst, none]
            y += [t] * (len(worst) + (not t))
        if not any(y):
            return flat
        w, model.bias = fit_machine(np.array(x) @ root, np.array(y, dtype=bool))
        model.weights = root @ w
    model.slope, model.shift = fit_logistic(flattened(model.margins(texts)), toxic)
    return model


def held_out(doc_id: Column) -> Column:
    """Labels of these rows are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = SAMPLE_CHARS) -> Model:
    """The model of docs(doc_id, text) and labels(doc_id, toxic), from rows that are not held out.

    At most `sample` documents of each class, of smallest hash of their id, less those over `longest` characters; of
    several labels the highest holds. Labels or ids that are null say nothing; without any labelled document, as with empty tables, the model
    rejects nothing.
    """
    own = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    drawn = [own.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in ("toxic", "NOT toxic")]
    chosen = F.broadcast(drawn[0].union(drawn[1]))  # at most twice `sample` rows
    rows = docs.select("doc_id", text_or_empty().alias("text")).filter(F.char_length("text") <= longest).join(chosen, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    rows = rows.limit(2 * sample).toArrow()
    return train(rows.column("text").cast(pa.binary()).to_pylist(), np.array(rows.column("toxic").to_pylist(), dtype=bool))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text").cast(pa.binary()).to_pylist()) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"]
            )

    return run


def score(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs(doc_id, text).

    A null text is scored as empty, which is the score of a text without a word near a landmark. Repeated rows score
    alike; a null doc_id stays null and counts as not held out; other columns are not read. An empty table gives an empty one. A task holds
    256 texts at a time, and of a long one its words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_or_empty().alias("text"))
    rows = map_batches(rows, _score(model), "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def keep_civil(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of docs, with all their columns, that score below the cut-off; null texts score as empty ones. An empty table stays empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array(model.scores(texts) < cutoff)) if texts else batch

    return map_batches(docs, run, docs.schema)
