"""Language-model scoring by deleted interpolation.

A word bigram, a word unigram and a uniform estimate are mixed. The weights belong to buckets of the context's frequency
and are learned by expectation-maximisation on counts held out of training: of the training documents a fold is deleted
from the estimates while the weights are fitted, and joins them again for the scores.

Counts of all documents are kept in shards. Each task turns its documents into chunks; the n-grams of a chunk go, sorted
and packed as arrays, to the shard of their word (of word and context, for the few words that make up a large share of
all tokens), with the chunk's rows they stand in. Of an n-gram so frequent in its chunk that all of its kind would fill a
shard, only the chunk's counts go there; its rows stay with the chunk, which is told the n-gram's score. The shards ask the unigram shards for the counts they need, give the
held-out statistics (a histogram of bounded size) to one fitting task, score every n-gram once, and send each chunk the
sums for its rows. Nothing that grows with the corpus is broadcast or sent to the driver, and it is one plan, so the
exchange of n-grams is made once and read by all three steps.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Staged, give_back, spread
from .near_dup import _Hashes, mix

FOLDS, HELD_OUT, DELETED = 5, 1, 2
#: Tokens of a chunk, and on average of a shard; rows of a chunk.
CHUNK, SHARD, ROWS = 800_000, 1_600_000, 60_000
#: The least occurrences in a chunk of which only counts leave it: fewer cost less one by one.
LEAST_NEAR = 4
#: Bytes of text for each shard of the words' counts.
WORDS = 60_000_000
#: The most frequent words, a list of fixed bound whose counts all tasks know. As contexts they are coded by their place.
FREQUENT = 65_535
#: Context buckets are octaves of the context's count; estimates are binned by quarter octaves in the histogram.
BUCKETS, STEPS = 24, 4
END = np.uint64(0x5DEECE66D1234567)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _PAIR + mix(w, 11), 13)


def _u(b: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(b or b"", kind)


def _folded(docs: DataFrame) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return docs.select("doc_id", "text", F.coalesce(fold.cast("int"), F.lit(0)).alias("fold"))


def _unigrams(rows: DataFrame, shards: int, staged: Staged) -> DataFrame:
    """(q, words, train, fit, n_train, n_fit, types): sorted word hashes of each shard and their counts."""

    def count(batches):
        give_back()
        fit, deleted, size = Counter(), Counter(), 0

        def packed():
            words = [*fit, *(w for w in deleted if w not in fit)]
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            a, b = (np.fromiter(map(c.__getitem__, words), np.int64, len(words)) for c in (fit, deleted))
            h = np.append(h, END)
            a, b = np.append(a, ends[0]), np.append(b, ends[1])
            q = (mix(h, 5) % np.uint64(shards)).astype(np.int64)
            by = np.lexsort((h, q))
            h, a, b, q = h[by], a[by], b[by], q[by]
            at = np.searchsorted(q, np.arange(shards + 1))
            used = np.flatnonzero(np.diff(at))
            cut = lambda x, kind: pa.array([x[at[i] : at[i + 1]].astype(kind).tobytes() for i in used], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), cut(h, "<u8"), cut(a + b, "<i8"), cut(a, "<i8")], ["q", "words", "train", "fit"])

        ends = [0, 0]
        for b in batches:
            for text, fold in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if fold == HELD_OUT:
                    continue
                words = (text or "").encode("utf-8", "replace").lower().split()
                (deleted if fold == DELETED else fit).update(words)
                ends[fold == DELETED] += 1
                size += len(words) + 1
                if size >= 2 * CHUNK:
                    yield packed()
                    fit, deleted, size, ends = Counter(), Counter(), 0, [0, 0]
                    give_back()
        if size:
            yield packed()
        del fit, deleted
        give_back()

    def merge(key, rows):
        h, train, fit = (np.concatenate([_u(x.as_py(), k) for x in rows.column(c)]) for c, k in (("words", "<u8"), ("train", "<i8"), ("fit", "<i8")))
        words, at = np.unique(h, return_inverse=True)
        train, fit = (np.bincount(at, x, len(words)).astype("<i8") for x in (train, fit))
        return pa.table({"q": pa.array([key[0].as_py()], pa.int32()), "words": [words.tobytes()], "train": [train.tobytes()], "fit": [fit.tobytes()], "n_train": [int(train.sum())], "n_fit": [int(fit.sum())], "types": [int((train > 0).sum())]})

    parts = spread(rows.select("text", "fold")).mapInArrow(count, "q int, words binary, train binary, fit binary")
    return staged.keep(parts.groupBy("q").applyInArrow(merge, "q int, words binary, train binary, fit binary, n_train long, n_fit long, types long"))


_X = "p int, chunk long, ids array<long>, held array<boolean>, sizes binary, bounds array<long>, words binary, runs binary, contexts binary, rare binary, times binary, rows binary, far binary, near binary, near_times binary, near_rows binary"

_NEAR = ("near", "near_times", "near_rows")


def _place(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Places of words in a sorted list; FREQUENT for those not in it."""
    if not len(of):
        return np.full(len(words), FREQUENT)
    at = np.minimum(np.searchsorted(of, words), len(of) - 1)
    return np.where(of[at] == words, at, FREQUENT)


def _bigrams(rows: DataFrame, shards: int, frequent: np.ndarray, widest: np.ndarray) -> DataFrame:
    """Chunks: for each shard the words of its n-grams, how many contexts each has (runs), the contexts (as places among
    the frequent words, the others in ``rare``), how often each n-gram stands (times) and in which rows; and one row with
    the chunk's doc_ids, kept apart from ``words``. Words in ``widest``, sorted, are dealt by context too.

    N-grams that are more than a shard's part of the chunk have 0 for times and no rows there but, in ``far``, their numbers
    in estimates' and in deleted rows; ``near``, ``near_times`` and ``near_rows`` of the row with the doc_ids hold the rest."""
    shared = rows.sparkSession.sparkContext.broadcast((frequent, widest))

    def run(batches):
        from pyspark import TaskContext

        hashes, (often, wide), part, n = _Hashes(), shared.value, TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def packed():
            rows_ = sorted(held, key=lambda x: x[0])  # estimates' rows first, then the deleted ones, then the held-out
            sizes = np.array([len(x[2]) for x in rows_], dtype="<u4")
            bounds = [sum(x[0] < c for x in rows_) for c in (1, 2)]
            w = np.concatenate([x[2] for x in rows_])
            v = np.append(END, w[:-1])  # the first word of a row follows the end of the row before
            d = np.repeat(np.arange(len(rows_), dtype=np.uint16), sizes)
            pair = _pair(v, w)
            p = np.where(_place(w, wide) != FREQUENT, pair, mix(w, 5)) % np.uint64(shards)
            # by shard, then word, then pair, as far as their hashes go in the bits that the shard leaves
            b_p = (shards - 1).bit_length()
            b_w = (64 - b_p) // 2
            b_v = 64 - b_p - b_w
            by = np.argsort((p << np.uint64(b_w + b_v) if b_p else p) | (mix(w, 7) >> np.uint64(64 - b_w)) << np.uint64(b_v) | pair >> np.uint64(64 - b_v), kind="stable")
            del pair
            w, v, d, p = w[by], v[by], d[by], p[by].astype(np.int64)
            run_at = np.append(True, (w[1:] != w[:-1]) | (p[1:] != p[:-1]))
            g = np.flatnonzero(run_at | np.append(True, v[1:] != v[:-1]))
            times, v, r = np.diff(np.append(g, len(w))).astype("<u4"), v[g], np.flatnonzero(run_at[g])
            runs, words, contexts = np.diff(np.append(r, len(g))).astype("<u4"), w[g][r], _place(v, often)
            starts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            used, token_at = p[starts], np.append(starts, len(p))
            gram_to, run_to = np.searchsorted(g, token_at), np.searchsorted(g[r], token_at)
            rare, rare_to = v[contexts == FREQUENT], np.append(0, np.cumsum(contexts == FREQUENT))[gram_to]
            often_here = times >= max(LEAST_NEAR, -(-len(w) // shards))
            stays, near = np.repeat(often_here, times), np.flatnonzero(often_here)
            near_pairs, near_times, near_rows = _pair(v[near], w[g[near]]), times[near], d[stays]
            ends = np.append(0, np.cumsum(near_times, dtype=np.int64))
            fits, learned = (np.append(0, np.cumsum(near_rows < b, dtype=np.int64))[ends] for b in bounds)
            far, far_to = np.stack([np.diff(fits), np.diff(learned - fits)], axis=1).astype("<u4"), np.searchsorted(near, gram_to)
            d, token_at = d[~stays], token_at - np.append(0, np.cumsum(stays))[token_at]
            times[near] = 0
            cut = lambda x, at: [None, *(x[at[i] : at[i + 1]].tobytes() for i in range(len(used)))]
            m = len(used) + 1
            arrays = [
                [int(chunk % shards), *used.tolist()], [chunk] * m,
                [[x[1] for x in rows_]] + [None] * (m - 1), [[x[0] == 2 for x in rows_]] + [None] * (m - 1), [sizes.tobytes()] + [None] * (m - 1), [bounds] * m,
                cut(words, run_to), cut(runs, run_to), cut(contexts.astype("<u2"), gram_to), cut(rare, rare_to), cut(times, gram_to), cut(d, token_at), cut(far, far_to),
                *([x.tobytes()] + [None] * (m - 1) for x in (near_pairs, near_times, near_rows)),
            ]
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types, strict=True)], names)

        types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.list_(pa.int64())] + [pa.binary()] * 10
        names = [x.split()[0] for x in _X.split(", ")]
        for b in batches:
            for doc_id, text, fold in zip(*(c.to_pylist() for c in b.columns)):
                words = (text or "").encode("utf-8", "replace").lower().split()
                h = np.empty(len(words) + 1, dtype=np.uint64)
                h[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                h[-1] = END
                held.append((2 if fold == HELD_OUT else 1 if fold == DELETED else 0, doc_id, h))
                size += len(h)
                if size >= CHUNK or len(held) >= ROWS:
                    chunk = part << 24 | n
                    yield packed()
                    held, size, n = [], 0, n + 1
                    give_back()
        if held:
            chunk = part << 24 | n
            yield packed()
        del held
        hashes.clear()
        give_back()

    return spread(rows.select("doc_id", "text", "fold")).mapInArrow(run, _X)


class _Shard:
    """The n-grams of a shard over all chunks."""

    def __init__(self, rows, frequent: np.ndarray):
        own = [r for r in rows.select(["chunk", "bounds", "words", "runs", "contexts", "rare", "times", "rows", "far"]).to_pylist() if r["words"] is not None]
        own.sort(key=lambda r: r["chunk"])
        join = lambda c, kind: np.concatenate([np.zeros(0, kind), *(_u(r[c], kind) for r in own)])
        self.w = np.repeat(join("words", "<u8"), join("runs", "<u4"))
        places, times = join("contexts", "<u2"), join("times", "<u4")
        self.v = np.append(frequent, np.zeros(FREQUENT + 1 - len(frequent), np.uint64))[places]
        self.v[places == FREQUENT] = join("rare", "<u8")
        self.row = join("rows", "<u2")
        self.gram = np.repeat(np.arange(len(self.w)), times)  # of each token
        self.chunks = [r["chunk"] for r in own]
        self.far, self.far_gram = join("far", "<u4").reshape(-1, 2).astype(np.int64), np.flatnonzero(times == 0)
        self.far_at = np.append(0, np.cumsum([len(r["far"]) // 8 for r in own])).astype(np.int64)
        n = [len(r["rows"]) // 2 for r in own]
        self.at = np.append(0, np.cumsum(n)).astype(np.int64)
        bounds = np.array([r["bounds"] for r in own], dtype=np.int64).reshape(-1, 2)
        self.kind = (self.row >= np.repeat(bounds[:, 0], n)).astype(np.int8) + (self.row >= np.repeat(bounds[:, 1], n))

    def count(self) -> None:
        """n-grams of all chunks as one list: counts among the estimates' and the deleted rows, and each token's n-gram."""
        _, first, same = np.unique(_pair(self.v, self.w), return_index=True, return_inverse=True)
        self.w, self.v, self.gram, self.far_gram = self.w[first], self.v[first], same[self.gram], same[self.far_gram]
        m = len(first)
        self.fit, self.deleted = (np.bincount(self.gram[self.kind == k], minlength=m) for k in (0, 1))
        np.add.at(self.fit, self.far_gram, self.far[:, 0])
        np.add.at(self.deleted, self.far_gram, self.far[:, 1])


def _needed(shard: _Shard, frequent: np.ndarray, parts: int) -> list[np.ndarray]:
    """The words whose counts a shard has to ask for, by the unigram shard that has them."""
    need = np.unique(np.concatenate([shard.v, shard.w]))
    need = need[_place(need, frequent) == FREQUENT]
    q = (mix(need, 5) % np.uint64(parts)).astype(np.int64)
    by = np.argsort(q, kind="stable")
    return np.split(need[by], np.searchsorted(q[by], np.arange(1, parts)))


class _Counts:
    """Counts (train, fit) of the words a shard needs, from the answers and the frequent words."""

    def __init__(self, shard: _Shard, answers, frequent: np.ndarray, counts: np.ndarray, parts: int):
        import zstandard

        need, unzip = _needed(shard, frequent, parts), zstandard.ZstdDecompressor()
        given = [(frequent, counts)] + [(need[a["q"]], _u(unzip.decompress(a["counts"]), "<i8").reshape(2, -1)) for a in answers if a["counts"] is not None]
        h = np.concatenate([g[0] for g in given])
        by = np.argsort(h)
        self.h, self.both = h[by], np.concatenate([g[1] for g in given], axis=1)[:, by]

    def of(self, words: np.ndarray) -> np.ndarray:
        """Two rows: counts in training, and among the estimates' part of it."""
        return self.both[:, np.searchsorted(self.h, words)]


def _bucket(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def fit_weights(bucket, bigram, unigram, uniform, weight, rounds: int = 60) -> np.ndarray:
    """Mixture weights (bucket x bigram, unigram, uniform) by expectation-maximisation. A bucket without held-out tokens
    takes the weights of the next lower one that has some."""
    parts = np.stack([bigram, unigram, np.full(len(bigram), uniform)], axis=1)
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]  # contexts never met have no bigram estimate
    for _ in range(rounds):
        share = parts * weights[bucket]
        total = share.sum(axis=1, keepdims=True)
        share = np.divide(share, total, out=np.zeros_like(share), where=total > 0) * weight[:, None]
        sums = np.stack([np.bincount(bucket, share[:, i], BUCKETS) for i in range(3)], axis=1)
        seen = sums.sum(axis=1)
        for b in range(BUCKETS):
            if seen[b] > 0:  # the uniform part never vanishes, so that every text has a probability
                weights[b] = (sums[b] + [0, 1e-3, 1e-3]) / (seen[b] + 2e-3)
            elif b > 1:
                weights[b] = weights[b - 1]
    return weights


def lm_score(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end; null and empty texts have the end only.
    Documents whose crc32(doc_id as text) modulo 5 is 1 are held out, the others are learned from (a null doc_id too).
    ``base_score`` is the add-a-half unigram log10 probability and ``score`` the interpolated model's, both over all
    tokens. Repeated rows are learned from and scored each. Other columns are ignored; an empty table gives an empty
    result. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    staged = Staged(spark)
    rows = _folded(docs)
    n_tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(n_tasks, -(-size // WORDS))
    unigrams = _unigrams(rows, parts, staged)
    n_train, n_fit, types = (int(x or 0) for x in unigrams.agg(F.sum("n_train"), F.sum("n_fit"), F.sum("types")).first())
    shards = max(n_tasks, -(-n_train // SHARD))

    def counted(batches):
        for b in batches:
            for r in b.to_pylist():
                h, train, fit = _u(r["words"], "<u8"), _u(r["train"], "<i8"), _u(r["fit"], "<i8")
                few = train >= max(1, n_train // (64 * FREQUENT))
                yield pa.RecordBatch.from_arrays([pa.array(h[few].view("<i8")), pa.array(train[few]), pa.array(fit[few])], ["word", "train", "fit"])

    top = unigrams.select("words", "train", "fit").mapInArrow(counted, "word long, train long, fit long").orderBy(F.desc("train"), "word").limit(FREQUENT).toPandas()
    frequent = top["word"].to_numpy(dtype=np.int64).view(np.uint64)
    by = np.argsort(frequent)
    frequent, counts = frequent[by], np.stack([top["train"].to_numpy(dtype=np.int64)[by], top["fit"].to_numpy(dtype=np.int64)[by]])
    shared = spark.sparkContext.broadcast((frequent, counts))
    uniform = 1.0 / (types + 1)
    # a word that would fill a quarter of a shard is spread over all of them
    grams = _bigrams(rows, shards, frequent, frequent[counts[0] >= max(2.0, n_train / (4 * shards))])

    def request(key, rows):
        words = _needed(_Shard(rows, shared.value[0]), shared.value[0], parts)
        used = [q for q, w in enumerate(words) if len(w)]
        out = pa.table({"q": pa.array(used, pa.int32()), "p": pa.array([key[0].as_py()] * len(used), pa.int32()), "words": pa.array([words[q].tobytes() for q in used], pa.binary())})
        give_back()
        return out

    def answer(counts, asked):
        import zstandard

        pack, out, held = zstandard.ZstdCompressor(level=1), [], counts.to_pylist()
        h, train, fit = (np.concatenate([np.zeros(0, k), *(_u(c[n], k) for c in held)]) for n, k in (("words", "<u8"), ("train", "<i8"), ("fit", "<i8")))
        for a in asked.to_pylist():
            words = _u(a["words"], "<u8")
            at = np.minimum(np.searchsorted(h, words), max(0, len(h) - 1))
            known = h[at] == words if len(h) else np.zeros(len(words), bool)
            told = np.stack([np.where(known, train[at], 0), np.where(known, fit[at], 0)]) if len(h) else np.zeros((2, len(words)), "<i8")
            out.append((a["p"], a["q"], pack.compress(told.astype("<i8").tobytes()), None))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, reply_types)], reply_names)

    reply_names, reply_types = ["p", "q", "counts", "weights"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    reply = "p int, q int, counts binary, weights binary"
    asked = grams.groupBy("p").applyInArrow(request, "q int, p int, words binary")
    answers = unigrams.select("q", "words", "train", "fit").groupBy("q").cogroup(asked.groupBy("q")).applyInArrow(answer, reply)

    def held_out_statistics(rows, replies):
        shard = _Shard(rows, shared.value[0])
        counts = _Counts(shard, replies.to_pylist(), *shared.value, parts)
        shard.count()
        seen = shard.deleted > 0
        context, word = counts.of(shard.v[seen])[1], counts.of(shard.w[seen])[1]
        bins = lambda x: np.where(x > 0, np.rint(STEPS * np.log2(np.maximum(x, 1e-300))), -(10**6)).astype(np.int64)
        cells, at = np.unique(np.stack([_bucket(context), bins(shard.fit[seen] / np.maximum(context, 1)), bins(word / max(n_fit, 1))], axis=1), axis=0, return_inverse=True)
        weight = np.bincount(at.reshape(-1), shard.deleted[seen], len(cells))
        del shard, counts, at
        give_back()
        return pa.table({"bucket": pa.array(cells[:, 0]), "bigram": pa.array(cells[:, 1]), "unigram": pa.array(cells[:, 2]), "weight": pa.array(weight, pa.float64())})

    statistics = grams.groupBy("p").cogroup(answers.groupBy("p")).applyInArrow(held_out_statistics, "bucket long, bigram long, unigram long, weight double")

    def learn(key, rows):
        c = {n: rows.column(n).to_numpy() for n in ("bucket", "bigram", "unigram", "weight")}
        by = np.lexsort((c["unigram"], c["bigram"], c["bucket"]))
        bucket, bigram, unigram, weight = (c[n][by] for n in ("bucket", "bigram", "unigram", "weight"))
        value = lambda x: np.where(x > -(10**6), 2.0 ** (np.maximum(x, -4000) / STEPS), 0.0)
        weights = fit_weights(bucket, value(bigram), value(unigram), uniform, weight).tobytes()
        return pa.Table.from_arrays([pa.array(np.arange(shards), pa.int32()), pa.nulls(shards, pa.int32()), pa.nulls(shards, pa.binary()), pa.array([weights] * shards, pa.binary())], reply_names)

    merged = statistics.groupBy("bucket", "bigram", "unigram").agg(F.sum("weight").alias("weight"))
    weights = merged.groupBy(F.lit(0).alias("all")).applyInArrow(learn, reply)  # a histogram: bounded by its bins

    def score(rows, replies):
        shard, replies = _Shard(rows, shared.value[0]), replies.to_pylist()
        counts = _Counts(shard, replies, *shared.value, parts)
        shard.count()
        given = [r["weights"] for r in replies if r["weights"] is not None]
        # without a deleted document there is nothing to learn weights from
        mixture = _u(given[0], "<f8").reshape(BUCKETS, 3) if given else np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
        context, word = counts.of(shard.v)[0], counts.of(shard.w)[0]
        lam = mixture[_bucket(context)]
        p = lam[:, 0] * ((shard.fit + shard.deleted) / np.maximum(context, 1)) + lam[:, 1] * (word / max(n_train, 1)) + lam[:, 2] * uniform
        log_p, base = np.log10(p), np.log10((word + 0.5) / (n_train + 0.5 * (types + 1)))
        out = {"chunk": [], "rows": [], "pairs": [], "known": [], "base": [], "score": []}
        values = (("known", word > 0, "<u4"), ("base", base, "<f8"), ("score", log_p, "<f8"))
        for i, chunk in enumerate(shard.chunks):
            part = slice(shard.at[i], shard.at[i + 1])
            row, gram = shard.row[part].astype(np.int64), shard.gram[part]
            there = np.flatnonzero(np.bincount(row))
            for name, value, kind in values:
                out[name].append(np.bincount(row, value[gram])[there].astype(kind).tobytes())
            out["chunk"].append(chunk)
            out["rows"].append(there.astype("<u2").tobytes())
            out["pairs"].append(None)
            told = shard.far_gram[shard.far_at[i] : shard.far_at[i + 1]]
            if len(told):
                for name, value, kind in values:
                    out[name].append(value[told].astype(kind).tobytes())
                out["chunk"].append(chunk)
                out["rows"].append(None)
                out["pairs"].append(_pair(shard.v[told], shard.w[told]).tobytes())
        del shard, counts, lam, p, log_p, base, values
        give_back()
        kept = (*_NEAR, "sizes")
        tables = [r for r in rows.select(["chunk", "ids", "held", *kept]).to_pylist() if r["sizes"] is not None]
        n, m = len(out["chunk"]), len(tables)
        return pa.table({
            "chunk": pa.array(out["chunk"] + [t["chunk"] for t in tables], pa.int64()),
            **{c: pa.array([None] * n + [t[c] for t in tables], k) for c, k in (("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), *((c, pa.binary()) for c in kept))},
            **{c: pa.array(out[c] + [None] * m, pa.binary()) for c in ("rows", "pairs", "known", "base", "score")},
        })

    given = answers.unionByName(weights)
    sums = grams.groupBy("p").cogroup(given.groupBy("p")).applyInArrow(score, "chunk long, ids array<long>, held array<boolean>, near binary, near_times binary, near_rows binary, sizes binary, rows binary, pairs binary, known binary, base binary, score binary")

    def gather(key, rows):
        rows = rows.to_pylist()
        ids = next(r for r in rows if r["sizes"] is not None)
        n = len(ids["ids"])
        known, base, total = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for r in sorted((r for r in rows if r["rows"] is not None), key=lambda r: (r["rows"], r["score"])):  # in a fixed order
            at = _u(r["rows"], "<u2")
            known[at] += _u(r["known"], "<u4")
            base[at] += _u(r["base"], "<f8")
            total[at] += _u(r["score"], "<f8")
        near, times, at = _u(ids["near"], "<u8"), _u(ids["near_times"], "<u4"), _u(ids["near_rows"], "<u2")
        if len(near):
            told = [r for r in rows if r["pairs"] is not None]
            pairs = np.concatenate([_u(r["pairs"], "<u8") for r in told])
            by = np.argsort(pairs)
            which = np.repeat(by[np.searchsorted(pairs[by], near)], times)
            add = lambda c, kind: np.bincount(at, np.concatenate([_u(r[c], kind) for r in told])[which], n)
            known += add("known", "<u4").astype(np.int64)
            base += add("base", "<f8")
            total += add("score", "<f8")
        return pa.table({
            "doc_id": pa.array(ids["ids"], pa.int64()), "held_out": pa.array(ids["held"], pa.bool_()), "n_tokens": pa.array(_u(ids["sizes"], "<u4").astype(np.int64)),
            "n_known": pa.array(known), "train_tokens": pa.array([n_train] * n, pa.int64()), "base_score": pa.array(base), "score": pa.array(total),
        })

    return sums.groupBy("chunk").applyInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
