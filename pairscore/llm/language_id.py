"""Language identification by mixture inference: a document may be in several languages at once.

Every letter n-gram of one to three letters (with word boundaries) is taken to be drawn from one of the learned languages.
Expectation-maximisation estimates in what proportions the languages make up a document; then those of the largest
proportions are kept as long as each pays for itself by a penalised likelihood. N-grams are counted in ``BUCKETS`` hash
buckets, so that the model is of a fixed size whatever the corpus.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.shared import spread
from .common import give_back, map_text

BUCKETS = 1 << 15
#: The bound on the languages of a model: the commonest labels, ties by name.
MAX_LANGUAGES = 512
#: Languages whose sums a counting task holds at once; it hands them on before it takes up more.
HELD_AT_ONCE = 64
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Log-likelihood that one more language must add, as a multiple of the logarithm of the n-grams: half for its proportion,
#: as by the Bayesian criterion, for each of six, since n-grams of three lengths overlap and each letter is in up to six.
PENALTY = 3.0
_BLOCK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _bucket(x: np.ndarray) -> np.ndarray:
    return ((x * _MIX) >> _SHIFT).astype(np.int64)


def gram_counts(text: str | None) -> np.ndarray:
    """How often n-grams of each bucket occur in the whole lower-cased text; anything but a letter bounds words. Long texts
    are counted in blocks."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    letters, tail = _letters(), np.zeros(1, dtype=np.uint64)
    text = text or ""
    blocks = (text[at : at + _BLOCK].lower() for at in range(0, len(text), _BLOCK))
    for block in (*blocks, "\n"):  # the end bounds a word too
        code = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        code = np.where(letters[code], code, 0).astype(np.uint64)
        before = np.concatenate([tail[-1:], code[:-1]])
        code = code[(code != 0) | (before != 0)]  # one boundary between words
        if not len(code):
            continue
        seq = np.concatenate([tail, code])
        last, middle = seq[len(tail) :], seq[len(tail) - 1 : -1]
        pair = (middle << np.uint64(21)) | last
        grams = [_bucket(last[last != 0]), _bucket(pair | np.uint64(1 << 62))]
        first = seq[len(tail) - 2 : -2] if len(tail) > 1 else np.concatenate([np.zeros(1, np.uint64), seq[:-2]])
        grams.append(_bucket(((first << np.uint64(42)) | pair | np.uint64(1 << 63))[middle != 0]))
        counts += np.bincount(np.concatenate(grams), minlength=BUCKETS)
        tail = seq[-2:]
    return counts


@dataclass
class Model:
    """``chance[g, i]``: the probability of bucket g in ``languages[i]``."""

    languages: list[str]
    chance: np.ndarray


def mixture(chance: np.ndarray, counts: np.ndarray, share: np.ndarray, rounds: int = 60, settled: float = 1e-5) -> np.ndarray:
    """The proportions of greatest likelihood, by expectation-maximisation from ``share``."""
    n = counts.sum()
    for _ in range(rounds):
        new = share * ((counts / (chance @ share)) @ chance) / n
        if np.abs(new - share).max() < settled:
            return new
        share = new
    return share


def languages_of(model: Model, counts: np.ndarray) -> tuple[list[int], list[float]]:
    """The languages selected for a document, by index, and their proportions, largest first; none without n-grams."""
    at = np.flatnonzero(counts)
    if not len(at) or not model.languages:
        return [], []
    c, p = counts[at].astype(float), model.chance[at]
    k = p.shape[1]
    share = mixture(p, c, np.full(k, 1 / k))
    order = np.argsort(-share, kind="stable")
    cost = PENALTY * np.log(c.sum() + 1)
    single = c @ np.log(p)
    chosen = [int(order[0])]
    parts, best = np.ones(1), float(single[order[0]])
    for m in range(2, k + 1):
        some = order[:m]
        if share[some[-1]] <= 0:
            break
        own = mixture(p[:, some], c, share[some] / share[some].sum())
        gained = float(c @ np.log(p[:, some] @ own))
        if gained - (m - 1) * cost <= best:
            break
        chosen, parts, best = some.tolist(), own, gained - (m - 1) * cost
    ranked = sorted(zip(chosen, parts.tolist()), key=lambda x: -x[1])
    return [i for i, _ in ranked], [s for _, s in ranked]


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo FOLDS; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit_languages(docs: DataFrame, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learned from text and lang of all documents that have both and are outside fold HELD_OUT: n-gram counts of every
    text are summed up by task, then by language and bucket. Only those sums, at most BUCKETS for each of
    ``max_languages``, reach the driver. Documents with a null doc_id are in no fold and not learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).select("lang", "text")
    common = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    languages = sorted(r["lang"] for r in common.collect())
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        give_back()
        sums: dict[int, np.ndarray] = {}

        def handed_on():
            for i, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(own[at])], ["language", "bucket", "n"])
            sums.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang in place:
                    own = gram_counts(text)
                    if place[lang] not in sums and len(sums) >= HELD_AT_ONCE:
                        yield from handed_on()
                    sums[place[lang]] = sums[place[lang]] + own if place[lang] in sums else own
        yield from handed_on()

    sums = spread(known).mapInArrow(count, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((BUCKETS, len(languages)))
    seen[sums["bucket"].to_numpy(dtype=int), sums["language"].to_numpy(dtype=int)] = sums["n"].to_numpy(dtype=float)
    little = 0.05
    return Model(languages, (seen + little) / (seen.sum(axis=0) + little * BUCKETS))


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of each row (doc_id, if not given), ``lang_pred``, ``score`` and ``languages``, all that were selected
    with their proportions, largest first. The largest is predicted, ties to the smaller name, and its proportion is the
    score. A null text, or one without any letter, is ``und`` with score 0; so is every text if nothing was learned.
    Repeated rows are alike; an empty table gives an empty result."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = held.value

        def fn(texts):
            names, scores, all_ = [], [], []
            for t in texts:
                which, parts = languages_of(own, gram_counts(t))
                names.append(own.languages[which[0]] if which else UNKNOWN)
                scores.append(min(1.0, parts[0]) if which else 0.0)
                all_.append([{"lang": own.languages[i], "share": s} for i, s in zip(which, parts)])
            return names, scores, all_

        return fn

    return map_text(docs, "text", columns or ["doc_id"], "lang_pred string, score double, languages array<struct<lang:string,share:double>>", make)
