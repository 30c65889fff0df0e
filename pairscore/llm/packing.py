"""Packing by lexical retrieval.

1. Texts are encoded once, into a table of token ids. With them come, from every task, the number of documents that have
   each term, so document frequencies, the number of documents and their mean length are those of the whole corpus. They
   are as large as the vocabulary and no larger.
2. Documents are routed by a lexical sketch: a few weighted min-hashes of their terms, in which a term counts by its
   inverse document frequency. Two documents agree in one with about the share of such weight that they have in common,
   so those nearest in BM25 are the likeliest to be neighbours in the order by sketch, however large the corpus is. The
   order is cut into ranges, by splitters from a sample, and these into shards of a bounded number of tokens; a hash of
   the row's number breaks ties, so a sketch shared by very many documents (copies) is spread over the ranges it fills.
3. Each shard has a BM25 inverted index over token ids, with the corpus's statistics. A seed document opens a window; the
   index returns the unused documents nearest to it, which fill the window in that order. The one that overruns is cut
   at the window's end, and its rest is the next seed. So only a shard's last window can be short, and that one is laid
   out in sequences of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import gc
import math
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .bpe import encoder, forget_strings
from .common import Staged, give_back, spread
from .near_dup import mix

WINDOW = 4096
END_ID = 2
#: Tokens of a shard; with it the cost of a retrieval is bounded whatever the corpus.
SHARD_TOKENS = 250_000
#: Bytes of ids in a range, as long as there are at most so many ranges; rows sampled for each to find its bounds. A range
#: is read shard by shard, so its size only matters for the balance of the tasks.
RANGE_BYTES, MOST_RANGES, SAMPLED = 8_000_000, 100_000, 100
#: Min-hashes of a sketch, fewer for a vocabulary beyond 2^17; the power of the inverse document frequency by which they
#: choose terms; and the bits of a key that are left, at least, for a hash of the row's number.
SKETCH, POWER, TIE_BITS = 3, 2.0, 12
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass
class Statistics:
    """Of a whole corpus: documents that have each term, documents, and their mean length in tokens."""

    df: np.ndarray
    n: int
    mean: float

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Statistics:
        own = np.concatenate([np.unique(d) for d in docs])
        return cls(np.bincount(own), len(docs), sum(map(len, docs)) / len(docs))

    def idf(self) -> np.ndarray:
        """Terms that at least half of the documents have tell nothing: theirs is 0 or less and counts as 0."""
        return np.maximum(0.0, np.log((self.n - self.df + 0.5) / (self.df + 0.5)))

    def ranks(self) -> np.ndarray:
        """For each min-hash the rank of every term: the smallest among a document's terms is its value. Drawn by
        exponential races, so that a term wins with a chance in proportion to its weight. Terms of one document, and those
        that tell nothing, come last and count as one."""
        weight = np.where(self.df > 1, self.idf() ** POWER, 0.0)
        hashes = max(1, min(SKETCH, (63 - TIE_BITS) // len(self.df).bit_length()))
        terms, out = np.arange(len(self.df), dtype=np.uint64), np.empty((hashes, len(self.df)), dtype=np.int32)
        for j in range(hashes):
            uniform = ((mix(terms + np.uint64(1), 31 + j) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
            race = np.where(weight > 0, -np.log(uniform) / np.where(weight > 0, weight, 1.0), np.inf)
            out[j, np.lexsort((terms, race))] = np.arange(len(terms))
            out[j, weight <= 0] = len(terms)
        return out


class Index:
    """BM25 over one shard, of arrays of token ids, with the statistics of the corpus."""

    def __init__(self, docs: list[np.ndarray], corpus: Statistics | None = None):
        corpus = corpus or Statistics.of(docs)
        self.n = len(docs)
        sizes = np.array([len(d) for d in docs])
        keys = (np.repeat(np.arange(self.n, dtype=np.uint64), sizes) << np.uint64(20)) | np.concatenate(docs)
        if self.n <= 4096:
            keys = keys.astype(np.uint32)
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        tf = np.diff(np.append(first, len(keys)))
        owner, term = (keys[first] >> keys.dtype.type(20)).astype(np.int64), (keys[first] & keys.dtype.type(0xFFFFF)).astype(np.int64)
        here, idf = np.bincount(term, minlength=len(corpus.df)), corpus.idf()
        telling = (here[term] > 1) & (idf[term] > 0)  # a term of one document of the shard leads nowhere
        owner, term, tf = owner[telling], term[telling], tf[telling]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[owner] / corpus.mean))
        order = np.argsort(term, kind="stable")
        self.docs, self.weight = owner[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange(len(here) + 1))
        self.terms, self.term_at = term, np.searchsorted(owner, np.arange(self.n + 1))

    def scores(self, doc: int) -> np.ndarray:
        """The score of every document for the distinct terms of one."""
        terms = self.terms[self.term_at[doc] : self.term_at[doc + 1]]
        at = self.at[terms]
        sizes = self.at[terms + 1] - at
        ends = np.cumsum(sizes)
        spans = np.repeat(at - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.docs[spans], self.weight[spans], self.n)


def fill_windows(docs: list[np.ndarray], window: int = WINDOW, corpus: Statistics | None = None) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard; each token lies in exactly one piece. Seeds come
    in the order of ``docs``; ties of the retrieval go to the earlier document."""
    index, unused = Index(docs, corpus), np.ones(len(docs), dtype=bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, room, fresh = 0, window, 0
    doc, start = -1, 0  # the seed and how much of it is placed
    while True:
        if doc < 0:
            while fresh < len(docs) and not unused[fresh]:
                fresh += 1
            if fresh == len(docs):
                break
            doc, start = fresh, 0
            unused[doc] = False
        while len(docs[doc]) - start >= window:  # whole windows of a long document
            pieces.append((doc, start, window, sequence, 0))
            sequence, start = sequence + 1, start + window
        seed, room = doc, window - (len(docs[doc]) - start)
        if room < window:
            pieces.append((doc, start, len(docs[doc]) - start, sequence, 0))
        doc = -1
        if room == window or not unused.any():
            continue
        scores = np.where(unused, index.scores(seed), -1.0)
        for near in np.argsort(-scores, kind="stable")[: int(unused.sum())].tolist():
            take = min(room, len(docs[near]))
            pieces.append((near, 0, take, sequence, window - room))
            unused[near] = False
            room -= take
            if take < len(docs[near]):
                doc, start = near, take
            if not room:
                break
        if not room:
            sequence += 1
    return _halve(pieces, sequence, window)


def _halve(pieces, last: int, window: int):
    """Lay the short last window out in sequences of falling powers of two."""
    done = [p for p in pieces if p[3] < last]
    left = sum(p[2] for p in pieces if p[3] == last)
    if left == window:
        return pieces
    sequence, room, offset = last, 0, 0
    for doc, start, length, _, _ in (p for p in pieces if p[3] == last):
        while length:
            if not room:
                room, offset = 1 << (left.bit_length() - 1), 0
            take = min(room, length)
            done.append((doc, start, take, sequence, offset))
            start, length, left, room, offset = start + take, length - take, left - take, room - take, offset + take
            if not room:
                sequence += 1
    return done


def sliced(batches, rows: int = 1_000):
    """Batches of fewer rows, so that what is made of one at a time is small."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


_TOKENS = "row long, doc_id long, n long, ids binary, df binary"


def tokens(docs: DataFrame, path: str, staged: Staged) -> DataFrame:
    """``row, doc_id, n, ids, df``: a row per document, numbered, with its ids (little-endian, of 16 bits where the
    vocabulary allows it, else 32) and their number, END_ID the last; and from each task a row with ``df`` only."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_TOKENS))

    def run(batches):
        from pyspark import TaskContext

        give_back(forget_strings)
        enc, row = encoder(path), TaskContext.get().partitionId() << 40
        end, size = END_ID.to_bytes(4, "little"), len(enc.tokens)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        df, last, places = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int32), np.arange(1 << 16, dtype=np.int32)

        def batch(rows, ids, sizes, coded, counts=None):
            values = [rows, ids, sizes, coded, counts or [None] * len(rows)]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for b in sliced(batches):
            sizes, coded = [], []
            gc.disable()  # encoding makes very many small objects and no cycles
            try:
                for text in b.column(1).to_pylist():
                    own = np.frombuffer(enc.encode(text) + end, "<u4").astype(np.intp)
                    at = places[: len(own)] if len(own) <= len(places) else np.arange(len(own), dtype=np.int32)
                    last[own] = at  # of repeated ids one place is left
                    df[own[last[own] == at]] += 1
                    sizes.append(len(own))
                    coded.append(own.astype(kind).tobytes())
            finally:
                gc.enable()
            yield batch(range(row, row + len(sizes)), b.column(0), sizes, coded)
            row += len(sizes)
        yield batch([None], [None], [None], [None], [df.tobytes()])
        del df, last
        give_back(forget_strings)

    return staged.keep(spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, _TOKENS), "lz4", dictionary=False)


def corpus_statistics(found: DataFrame) -> Statistics:
    """From the table of ``tokens``. What reaches the driver is as long as the vocabulary."""
    import pyarrow as pa

    def counts(batches):
        for b in batches:
            for packed in b.column(0).to_pylist():
                df = np.frombuffer(packed, "<i8")
                used = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array([len(df)] * len(used), pa.int64()), pa.array(used, pa.int64()), pa.array(df[used], pa.int64())], ["size", "term", "n"])

    parts = found.where(F.col("df").isNotNull()).select("df").mapInArrow(counts, "size long, term long, n long")
    got = parts.groupBy("term").agg(F.sum("n").alias("n"), F.max("size").alias("size")).toPandas()
    total = found.agg(F.count("n"), F.sum("n")).first()
    df = np.zeros(int(got["size"].max()) if len(got) else 1, dtype=np.int64)
    df[got["term"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return Statistics(df, total[0], (total[1] or 0) / max(1, total[0]))


def pack(docs: DataFrame, path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's tokens are its text's ids (null text: none) and END_ID; so an empty text still has one. Sequences hold
    at most ``window`` tokens, without gaps. Rows that repeat a doc_id, or have none, are documents of their own. Texts
    of any length are taken whole. Other columns are ignored; an empty table gives an empty result. The bits of
    ``sequence_id`` from the 20th on number the shard.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    found = tokens(docs, path, Staged(spark))
    corpus = corpus_statistics(found)
    kind, bits = "<u2" if len(corpus.df) <= 1 << 16 else "<u4", len(corpus.df).bit_length()
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_RANGES, math.ceil(corpus.n * corpus.mean * np.dtype(kind).itemsize / RANGE_BYTES)))
    shared = spark.sparkContext.broadcast((corpus, corpus.ranks()))  # as large as the vocabulary
    rows = found.where(F.col("n").isNotNull()).select("row", "doc_id", "n", "ids")

    def keyed(b) -> np.ndarray:
        """A key for each row of a batch: its sketch, first value first, and a hash of its number."""
        sizes, ids = b.column("n").to_numpy(), np.frombuffer(b"".join(b.column("ids").to_pylist()), kind)
        starts, key = np.cumsum(sizes) - sizes, np.zeros(len(sizes), dtype=np.uint64)
        for ranks in shared.value[1]:
            key = key << np.uint64(bits) | np.minimum.reduceat(ranks[ids], starts).astype(np.uint64)
        left = 63 - bits * len(shared.value[1])
        return (key << np.uint64(left) | mix(b.column("row").to_numpy().astype(np.uint64), 41) >> np.uint64(64 - left)).astype(np.int64)

    def weigh(batches):
        give_back()
        for b in sliced(batches):
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array(keyed(b)), b.column("n")], ["key", "n"])

    sample = rows.where(F.col("row") % max(1, corpus.n // (SAMPLED * ranges)) == 0).mapInArrow(weigh, "key long, n long").toPandas().sort_values("key")
    share = sample["n"].cumsum().to_numpy() / max(1, sample["n"].sum())
    splitters = sample["key"].to_numpy()[np.searchsorted(share, np.arange(1, ranges) / ranges)] if len(sample) else np.zeros(0, np.int64)
    bounds = spark.sparkContext.broadcast(splitters)  # 8 bytes a range

    def sketch(batches):
        give_back()
        for b in sliced(batches):
            if len(b):
                key = keyed(b)
                place = np.searchsorted(bounds.value, key, side="right").astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "doc_id", "n", "ids")), pa.array(key), pa.array(place)], ["row", "doc_id", "n", "ids", "key", "place"])

    schema = StructType.fromDDL(PIECES)
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        give_back()
        base, held, size = TaskContext.get().partitionId() << 20, [], 0

        def shard():
            own = [np.frombuffer(ids, kind).astype("<u4") for _, ids in held]
            pieces = fill_windows(own, window, shared.value[0])
            out = [(held[d][0], s, n, zlib.crc32(own[d][s : s + n]), len(own[d]), base << 20 | q, o) for d, s, n, q, o in pieces]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow_schema, strict=True)], schema=arrow_schema)

        for b in batches:
            for doc_id, ids, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                held.append((doc_id, ids))
                size += n
                if size >= shard_tokens:
                    yield shard()
                    base, held, size = base + 1, [], 0
        if held:
            yield shard()
        del held
        give_back()

    routed = rows.mapInArrow(sketch, "row long, doc_id long, n long, ids binary, key long, place int")
    return routed.repartitionById(ranges, "place").sortWithinPartitions("key", "row").select("doc_id", "ids", "n").mapInArrow(run, schema)
