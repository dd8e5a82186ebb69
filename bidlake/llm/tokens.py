"""Token counts of whole texts by a public tokenizer.

A huge document is cut into overlapping chunks that different tasks encode with offsets. Two
neighbours are spliced at a stable common boundary: a place before ASCII white space, where the
tokenizer starts afresh whatever stood before (white space separates its words, composes with no
letter and is part of no special token). Both neighbours must give the same tokens between the first
and the last such place of their overlap; if they do not, or if there are not two such places, the
document is encoded again with chunks and overlaps eight times as wide.

Ordinary documents are encoded word by word, which the same argument makes exact, and each task
remembers the words it has met.
"""

import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import cached_property, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import LOWER, SPACES, UPPER, kept, map_batches, text_key, text_or_empty
from bidlake.sources.writers import written

CHUNK, OVERLAP, WIDER = 65536, 1024, 8


def open_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def model_alone(tokenizer):
    """The tokenizer's model on words between blanks, without what comes before it; the tokenizer itself if it shows no model."""
    from tokenizers import Tokenizer, pre_tokenizers

    if not hasattr(tokenizer, "model"):
        return tokenizer
    alone = Tokenizer(tokenizer.model)
    alone.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return alone


class WordEncoder:
    """Ids of a text, joined from the ids of its words.

    Remembers the words of late: two generations of up to `memory` short words. The tokenizer composes letters
    (NFC), then lower-cases, so A-Z are lower-cased first, except before a character that is not ASCII, with which one
    may compose, and unless the text may hold a special token, whose case counts.

    The tokenizer parts letters from ASCII punctuation, so a word with some behind it has the ids of its letters, then those of its end. That
    is so of Latin letters; others may lower-case or compose to end in a mark, which goes with the punctuation. A full stop or comma between a-z
    and a blank, as most are, becomes a word of its own in the text. Words of letters alone are one unit each, whose last token is marked as
    such: many are encoded as one text and told apart by the marks. Composing, lower-casing and parting change nothing in small Latin letters,
    so these go to the tokenizer's model without.
    """

    _blank = bytes.maketrans(SPACES.encode(), b" " * len(SPACES))
    _lower = bytes.maketrans((SPACES + UPPER).encode(), (" " * len(SPACES) + LOWER).encode())
    _composing = re.compile(rb"[A-Z](?=[\x80-\xff])")
    _ends = ((b". ", b" . "), (b", ", b" , "))
    _joined = 64

    def __init__(self, path: str, memory: int = 200_000, longest: int = 64):
        self.tokenizer, self.memory, self.longest = open_tokenizer(path), memory, longest
        self.known: dict[bytes, bytes] = {b"": b""}
        self.before: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    @classmethod
    def at(cls, path: str) -> "WordEncoder":
        """One encoder per worker process, as long as its tasks encode."""
        return kept((cls, path), lambda: cls(path))

    @cached_property
    def plain(self):
        return model_alone(self.tokenizer)

    def words(self, text: bytes) -> list[bytes]:
        """The words of a text, lower-cased and parted from a full stop or comma where that changes no id."""
        if b"<|" in text:
            return text.translate(self._blank).split(b" ")
        lowered = text.translate(self._lower)
        if not text.isascii() and (kept := [m.start() for m in self._composing.finditer(text)]):
            lowered = bytearray(lowered)
            for i in kept:
                lowered[i] = text[i]
            lowered = bytes(lowered)
        for end, parted in self._ends:
            *parts, last = lowered.split(end)
            # islower() of bytes is true of a-z alone.
            lowered = b"".join([part + (parted if part[-1:].islower() else end) for part in parts]) + last
        return lowered.split(b" ")

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, encoded by itself."""
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_letters(self, tokenizer, words: list[str]) -> list[bytes]:
        """Ids of each word of letters; encoded by themselves where a text of many has another number of last tokens than of words."""
        lines = [words[i : i + self._joined] for i in range(0, len(words), self._joined)]
        out: list[bytes] = []
        for line, e in zip(lines, tokenizer.encode_batch_fast([" ".join(line) for line in lines], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.is_last[ids]) + 4).tolist()
            if len(ends) == len(line) and ends[-1] == 4 * len(ids):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *ends], ends)]
            else:
                out += self._encode_words(line)
        return out

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of new words."""
        known, before = self.known, self.before
        ended, letters, others = [], {}, {}
        for word, w in zip(words, b" ".join(words).decode().split(" ")):
            if w.isalpha():
                letters[word] = w
                continue
            core = w.rstrip(string.punctuation)
            if not core.isalpha() or (not core.isascii() and (max(core) > "\u024f" or "\u0130" in core)):
                others[word] = w
            else:
                own = core.encode()
                end = word[len(own) :]
                ended.append((word, own, end))
                if own in before:
                    known[own] = before[own]
                elif own not in known:
                    letters[own] = core
                if end not in known:
                    others[end] = end.decode()
        small = {word: w for word, w in letters.items() if w.islower() and (w.isascii() or max(w) <= "\u024f")}
        rest = {word: w for word, w in letters.items() if word not in small}
        for new, encode in ((small, partial(self._encode_letters, self.plain)), (rest, partial(self._encode_letters, self.tokenizer)), (others, self._encode_words)):
            keys, texts = list(new), list(new.values())
            for i in range(0, len(keys), 4096):
                known.update(zip(keys[i : i + 4096], encode(texts[i : i + 4096])))
        known.update((word, known[own] + known[end]) for word, own, end in ended)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        pieces = [self.words(t) for t in texts]
        wanted = set().union(*pieces)
        if len(self.known) > self.memory:
            self.known, self.before = {b"": b""}, self.known
        unknown = list(wanted.difference(self.known))
        old = list(map(self.before.get, unknown))
        self.known.update((w, ids) for w, ids in zip(unknown, old) if ids is not None)
        new = [w for w, ids in zip(unknown, old) if ids is None]
        self.learn(new)
        out = [b"".join(map(self.known.__getitem__, p)) for p in pieces]
        for w in new:
            if len(w) > self.longest:
                del self.known[w]
        return out


def _spaces(text: str, lo: int, hi: int) -> list[int]:
    """First and last place of white space in text[lo:hi], if there are two."""
    first = next((i for i in range(lo, hi) if text[i] in SPACES), None)
    last = next((i for i in range(hi - 1, lo - 1, -1) if text[i] in SPACES), None)
    return [first, last] if first is not None and first < last else []


def _edge(ids: np.ndarray, starts: np.ndarray, text: str, lo: int, hi: int, side: str) -> tuple[int, int | None]:
    """Tokens of this side that the splice takes away, and a checksum of those both sides must share."""
    marks = _spaces(text, lo, hi)
    if not marks:
        return 0, None
    a, b = np.searchsorted(starts, marks)
    shared = np.stack([ids[a:b], starts[a:b] - marks[0]]).astype("<i8").tobytes()
    return int(a if side == "right" else len(ids) - a), zlib.crc32(shared)


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(0, n, 64):
                    part = range(k, min(k + 64, n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([a] * len(part), pa.int64()), pa.array([b] * len(part), pa.int64()),
                         pa.array(part, pa.int64()), pa.array([n] * len(part), pa.int64()),
                         pa.array([text[i * chunk : (i + 1) * chunk + overlap] for i in part], pa.string())],
                        names=["a", "b", "k", "chunks", "text"],
                    )

    return run


EDGES = pa.list_(pa.struct([("edge", pa.int64()), ("away", pa.int64()), ("check", pa.int64())]))


def _encode_chunks(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordEncoder.at(path).tokenizer
        for batch in batches:
            counts, edges = [], []
            for k, chunks, text in zip(*(batch.column(c).to_pylist() for c in ("k", "chunks", "text"))):
                e = tokenizer.encode(text, add_special_tokens=False)
                ids = np.asarray(e.ids, dtype=np.int64)
                starts = np.asarray([o[0] for o in e.offsets], dtype=np.int64)
                # The overlap of two chunks: the first characters of the right one, all that the left one has from `chunk` on.
                sides = [(k - 1, *_edge(ids, starts, text, 0, min(overlap, len(text)), "right"))] if k > 0 else []
                sides += [(k, *_edge(ids, starts, text, chunk, len(text), "left"))] if k + 1 < chunks else []
                counts.append(len(ids))
                edges.append([dict(zip(("edge", "away", "check"), x)) for x in sides])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(counts, pa.int64()), pa.array(edges, EDGES)],
                names=["a", "b", "n", "edges"],
            )

    return run


def _splice(chunks: DataFrame) -> DataFrame:
    """Per text (a, b): its tokens, and whether all its edges align."""
    edges = chunks.select("a", "b", F.explode("edges").alias("e")).groupBy("a", "b", "e.edge").agg(
        F.sum("e.away").alias("away"),
        ((F.count("e.check") == 2) & (F.min("e.check") == F.max("e.check"))).alias("ok"),
    )
    parts = chunks.select("a", "b", F.col("n"), F.lit(True).alias("ok")).unionByName(
        edges.select("a", "b", (-F.col("away")).alias("n"), "ok")
    )
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n_tokens"), F.every("ok").alias("ok"))


def _count_small(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.at(path)
        for batch in batches:
            ids = encoder.encode(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array([len(x) // 4 for x in ids], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def count_huge(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(a, b, n_tokens) of the distinct texts of texts(a, b, text), by overlapping chunks."""
    done = []
    while True:
        chunks = map_batches(texts, _cut(chunk, overlap), "a long, b long, k long, chunks long, text string", 64, keeps=True)
        # Equal texts are encoded once, and the chunks of one text by different tasks.
        chunks = chunks.dropDuplicates(["a", "b", "k"])
        encoded = map_batches(
            chunks, _encode_chunks(path, chunk, overlap),
            "a long, b long, n long, edges array<struct<edge:long,away:long,check:long>>", 64, keeps=True,
        )
        # Counts and edges are few bytes a chunk; written, they are not encoded once for each use.
        spliced = written(_splice(written(encoded, "encoded")), "spliced")
        done.append(spliced.filter("ok").select("a", "b", "n_tokens"))
        failed = spliced.filter("NOT ok").select("a", "b")
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        # A text as long as one chunk has no edge, so this ends.
        texts, chunk, overlap = texts.join(failed, ["a", "b"], "left_semi"), chunk * WIDER, overlap * WIDER


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of docs(doc_id, text).

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated results, a null doc_id
    stays null, other columns are not read. Texts over `chunk + overlap` characters go the chunked way.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    is_huge = F.char_length("text") > chunk + overlap
    small = map_batches(docs.filter(~is_huge), _count_small(path), "doc_id long, n_bytes long, n_tokens long", keeps=True)
    huge = docs.filter(is_huge).withColumn("key", text_key()).select("doc_id", "n_bytes", "key.a", "key.b", "text")
    counts = count_huge(huge.select("a", "b", "text"), path, chunk, overlap)
    spliced = huge.drop("text").join(counts, ["a", "b"]).select("doc_id", "n_bytes", "n_tokens")
    return small.unionByName(spliced).withColumn("over_limit", F.col("n_tokens") > limit)
