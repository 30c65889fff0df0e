"""N-gram Jaccard join with several global orders.

Documents become sets of 64-bit hashes of word n-grams; texts with the same words are one node. Under any total order of
the n-grams, two sets with Jaccard similarity t or more share an n-gram among the ``n - ceil(t n) + 1`` first of each: so
they must do so under every order.

1. First order: rarest in the corpus first. Chunks of rows send their n-grams, sorted and packed, to the shards
   that count them; the shards send back only those that stand in more than one text, with their counts. As n-grams of
   one text come first in the order, most texts have none but such in their prefix and are done with. The nodes that
   share a prefix n-gram are brought together by stars, one edge a node and n-gram, so no pairs within a group are
   listed: the stars' components only say which sets are to meet in a task.
2. Second and third order: two fixed permutations of all n-grams, by hash. They are the same in every task and need no
   counts.
3. The sets of a component go to one task (a large one in blocks, and each two blocks to one task). There a pair is a
   candidate only if it shares a prefix n-gram under the first, the second and the third order, and fits in length: the
   filters are intersected before anything is verified on the whole sets. Pairs already connected need no look, since
   what is returned are the connected classes.
4. The verified links' components are the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Staged, give_back, spread
from .components import components

N = 5
#: Bits of the filter that tells which nodes' sets are wanted again: 16 a node within these bounds. False positives are
#: dropped by a join.
LEAST_BITS, MOST_BITS = 1 << 24, 1 << 27
#: Seeds of the second and the third order.
ORDERS = (3, 5)
#: n-grams of a chunk of rows, of a shard of the counts (on average) and of a verification task; rows of a chunk.
CHUNK, SHARD, TASK, ROWS = 500_000, 2_000_000, 1_000_000, 60_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, which is what bytes.lower and bytes.split do."""

    def __init__(self, n: int = N):
        self.n, self.hashes = n, _Hashes()

    def words(self, text: str | None) -> tuple[int, list[bytes]]:
        """The node, a hash of the word sequence (0 if there is none), and the words."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        return xxhash.xxh3_64_intdigest(b" ".join(words), 17) if words else 0, words

    def hashed(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))

    def grams(self, nodes: list[int], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The n-gram hashes of all texts, given as their words' hashes, sorted, and whose they are; each once a text. A
        text of fewer than n words has its node as its only one."""
        sizes = np.array([len(w) for w in texts], dtype=np.int64)
        h = np.concatenate([np.zeros(0, np.uint64), *texts])
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        m = max(0, len(h) - self.n + 1)
        g = np.zeros(m, dtype=np.uint64)
        for i in range(self.n):
            g += h[i : i + m] * _MULTIPLIERS[i % len(_MULTIPLIERS)]
        own = owner[:m]
        whole = own == owner[self.n - 1 :] if m else np.zeros(0, bool)
        short = np.flatnonzero((sizes > 0) & (sizes < self.n))
        g = np.concatenate([mix(g[whole]), np.array([nodes[i] for i in short], dtype=np.uint64)])
        own = np.concatenate([own[whole], short])
        by = np.lexsort((own, g)) if len(texts) > 1 else np.argsort(g, kind="stable")
        g, own = g[by], own[by]
        first = np.append(True, (g[1:] != g[:-1]) | (own[1:] != own[:-1]))[: len(g)]
        return g[first], own[first]


def prefix_size(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


_CHUNK_COLUMNS = "part int, chunk long, ids array<{id}>, nodes binary, sizes binary, grams binary, rows binary, seen binary"


def _chunks(docs: DataFrame, n: int, shards: int) -> DataFrame:
    """A row per chunk and shard with the shard's n-grams (their low halves, sorted) and the rows they stand in; and a row
    per chunk with its documents. A text met again in a chunk is not given again."""
    ids = docs.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in _CHUNK_COLUMNS.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        give_back()
        shingler, part, chunks = Shingler(n), TaskContext.get().partitionId(), 0
        own_ids, nodes, at, texts, first_row, where, size, id_type = [], [], [], [], [], {}, 0, None

        def packed():
            g, own = shingler.grams([nodes[i] for i in first_row], texts)
            sizes = np.bincount(own, minlength=len(texts))[at]
            row = np.array(first_row, dtype=np.uint16)[own]  # the first row with the text stands for all
            place = (g >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)  # the upper halves, in equal ranges
            starts = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(g)])
            used, cuts = place[starts].astype(np.int64), np.append(starts, len(g))
            low, nothing = g.astype("<u4"), [None] * len(used)
            cut = lambda x: [None, *(x[cuts[i] : cuts[i + 1]].tobytes() for i in range(len(used)))]
            chunk = part << 24 | chunks
            values = [
                [chunk % shards, *used.tolist()], [chunk] * (len(used) + 1), [own_ids, *nothing],
                [np.array(nodes, dtype="<u8").tobytes(), *nothing], [sizes.astype("<i8").tobytes(), *nothing], cut(low), cut(row), [None] * (len(used) + 1),
            ]
            types = [pa.int32(), pa.int64(), pa.list_(id_type)] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

        for b in batches:
            id_type = b.column(0).type
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                node, words = shingler.words(text)
                if node not in where:
                    where[node] = len(texts)
                    texts.append(shingler.hashed(words))
                    first_row.append(len(nodes))
                    size += len(words)
                at.append(where[node])
                own_ids.append(doc_id)
                nodes.append(node)
                if size >= CHUNK or len(nodes) >= ROWS:
                    yield packed()
                    give_back()
                    own_ids, nodes, at, texts, first_row, where, size, chunks = [], [], [], [], [], {}, 0, chunks + 1
        if nodes:
            yield packed()
        del own_ids, nodes, at, texts, first_row, where
        shingler.hashes.clear()
        give_back()

    return spread(docs.select("doc_id", "text")).mapInArrow(run, _CHUNK_COLUMNS.format(id=ids))


def _shared(key, rows):
    """A shard: of each chunk the n-grams that more than one text has, with the number of texts. Rows of documents pass."""
    rows = rows.sort_by("chunk").to_pylist()
    own = [r for r in rows if r["grams"] is not None]
    grams = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(r["grams"], "<u4") for r in own)])
    _, same, counts = np.unique(grams, return_inverse=True, return_counts=True)
    seen, at = counts[same], 0
    for r in own:
        n = len(r["grams"]) // 4
        often = seen[at : at + n] > 1
        r["grams"], r["rows"] = grams[at : at + n][often].tobytes(), np.frombuffer(r["rows"], "<u2")[often].tobytes()
        r["seen"] = seen[at : at + n][often].astype("<u4").tobytes()
        at += n
    del grams, same, counts, seen
    give_back()
    return rows


def _prefixes(rows, percent: int):
    """A chunk: its documents, and the n-grams in their prefixes that are not theirs alone."""
    table = next(r for r in rows if r["nodes"] is not None)
    own = sorted((r for r in rows if r["grams"] is not None), key=lambda r: r["part"])
    join = lambda c, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[c], kind) for r in own)])
    nodes, sizes = np.frombuffer(table["nodes"], "<i8"), np.frombuffer(table["sizes"], "<i8")
    gram = join("grams", "<u4").astype(np.int64) | np.repeat(np.array([r["part"] for r in own], dtype=np.int64), [len(r["grams"]) // 4 for r in own]) << 32
    row, seen = join("rows", "<u2").astype(np.int64), join("seen", "<u4")
    by = np.lexsort((mix(gram.view(np.uint64)), seen, row))
    row, gram = row[by], gram[by]
    several = np.bincount(row, minlength=len(nodes))
    # those of one text only come first, so so many are left for the others
    left = np.maximum(0, prefix_size(sizes, percent) - (sizes - several))
    nth = np.arange(len(row)) - (np.cumsum(several) - several)[row]
    chosen = nth < left[row]
    return table["ids"], nodes, sizes, gram[chosen], nodes[row[chosen]]


def _read(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Rows of documents (doc_id, node, size), and rows (gram, node) for the first order's prefixes."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // (6 * SHARD)))
    ids = docs.schema["doc_id"].dataType.simpleString()
    chunks = _chunks(docs, n, shards)
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("ids", pa.list_(to_arrow_type(docs.schema["doc_id"].dataType))), *((c, pa.binary()) for c in ("nodes", "sizes", "grams", "rows", "seen"))])
    counted = chunks.groupBy("part").applyInArrow(lambda key, rows: pa.Table.from_pylist(_shared(key, rows), schema), _CHUNK_COLUMNS.format(id=ids))

    def select(key, rows):
        own, nodes, sizes, gram, of = _prefixes(rows.to_pylist(), percent)
        a, b = len(own), len(gram)
        return pa.table({
            "doc_id": pa.array(own + [None] * b, schema.field("ids").type.value_type),
            "node": pa.array(np.concatenate([nodes, of])), "size": pa.array(sizes.tolist() + [None] * b, pa.int64()),
            "gram": pa.array([None] * a + gram.tolist(), pa.int64()),
        })

    return counted.groupBy("chunk").applyInArrow(select, f"doc_id {ids}, node long, size long, gram long")


def _sets(docs: DataFrame, n: int, wanted: np.ndarray) -> DataFrame:
    """(node, grams as bytes) of the nodes that the filter, of 64 bits a word, passes, once a task."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        give_back()
        shingler, seen, bits = Shingler(n), set(), shared.value
        for b in batches:
            nodes, texts = [], []
            for text in b.column(0).to_pylist():
                node, words = shingler.words(text)
                bit = node % (64 * len(bits))
                if words and node not in seen and int(bits[bit >> 6]) >> (bit & 63) & 1:
                    seen.add(node)
                    nodes.append(node)
                    texts.append(shingler.hashed(words))
            if nodes:
                sets = [shingler.grams([node], [words])[0].tobytes() for node, words in zip(nodes, texts)]
                yield pa.RecordBatch.from_arrays([_long(nodes), pa.array(sets, pa.binary())], ["node", "grams"])

    return spread(docs.select("text")).mapInArrow(run, "node long, grams binary")


def _postings(prefixes: list[np.ndarray]):
    """The prefixes with their n-grams numbered and, for each n-gram, who has it there."""
    sizes = list(map(len, prefixes))
    _, at = np.unique(np.concatenate(prefixes), return_inverse=True)
    owner, by = np.repeat(np.arange(len(prefixes)), sizes), np.argsort(at, kind="stable")
    return np.split(at, np.cumsum(sizes)[:-1]), owner[by], np.append(0, np.cumsum(np.bincount(at)))


def hashed_prefix(grams: np.ndarray, seed: int, percent: int) -> np.ndarray:
    """The first n-grams of a set under a fixed permutation of all n-grams."""
    n = prefix_size(len(grams), percent)
    return grams[np.argpartition(mix(grams, seed), n - 1)[:n]] if n < len(grams) else grams


def links_within(sets: list[np.ndarray], firsts: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Verified links that connect what is connected among some sets (a spanning forest). ``firsts`` are the sets'
    prefixes under the first order, without the n-grams that no other text has."""
    m, sizes = len(sets), np.array([len(s) for s in sets])
    by_size = np.argsort(sizes, kind="stable")
    sets, firsts, sizes = [sets[i] for i in by_size], [firsts[i] for i in by_size], sizes[by_size]
    orders = [_postings(firsts), *(_postings([hashed_prefix(s, seed, percent) for s in sets]) for seed in ORDERS)]
    label, degree, found = np.arange(m), np.zeros(m, dtype=np.int64), []
    for x in range(1, m):
        share = np.ones(x, dtype=bool)
        for prefixes, owner, start in orders:
            g = prefixes[x]
            n = start[g + 1] - start[g]
            spans = np.repeat(start[g] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            met = np.zeros(m, dtype=bool)
            met[owner[spans]] = True
            share &= met[:x]  # the filters intersect
        maybe = np.flatnonzero(share & (100 * sizes[:x] >= percent * sizes[x]))
        step = 1
        while len(maybe := maybe[label[maybe] != label[x]]):
            # a few of each class first, best connected ones first; more if they fail
            by = maybe[np.lexsort((-degree[maybe], label[maybe]))]
            first = np.flatnonzero(np.append(True, label[by[1:]] != label[by[:-1]]))
            nth = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
            tried = by[nth < step]
            several = np.concatenate([sets[y] for y in tried])
            place = np.minimum(np.searchsorted(sets[x], several), sizes[x] - 1)
            both = np.add.reduceat((sets[x][place] == several).astype(np.int64), np.append(0, np.cumsum(sizes[tried])[:-1]))
            for y in tried[100 * both >= percent * (sizes[x] + sizes[tried] - both)].tolist():
                degree[[x, y]] += 1
                if label[x] != label[y]:
                    found.append((int(by_size[x]), int(by_size[y])))
                    label[label == label[y]] = label[x]
            maybe = by[nth >= step]
            step *= 4
    return found


def near_duplicates(docs: DataFrame, n: int = N, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Two texts link when ``100 * shared >= percent * union`` of their n-gram sets. Fewer than n words make one n-gram of
    all; no words make none, and such a row (null text too) is linked with nothing, so its component_id is its own
    doc_id. ``component_id`` is the smallest doc_id reachable by links; rows with equal texts are linked, rows with a null
    doc_id link too but name no component unless no other row does. Other columns are ignored; an empty table gives an
    empty result.
    """
    staged = Staged(docs.sparkSession)
    read = staged.keep(_read(docs, n, percent))
    nodes = read.where(F.col("gram").isNull()).select("doc_id", "node", "size")
    pairs = read.where(F.col("gram").isNotNull()).select("gram", "node")
    least = pairs.groupBy("gram").agg(F.min("node").alias("v"), F.max("node").alias("most")).where("v <> most")
    stars = pairs.join(least, "gram").select(F.col("node").alias("u"), "v")
    candidate = components(stars, staged)
    # written before it is thinned: two Python operators in one stage would keep two workers a core
    linked = components(staged.keep(_verified(docs, nodes, pairs, candidate, n, percent, staged)), staged)

    rooted = nodes.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.where("size > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    out = rooted.join(named, "root", "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"))


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, candidate: DataFrame, n: int, percent: int, staged: Staged) -> DataFrame:
    spark = docs.sparkSession
    classes = candidate.union(candidate.select(F.col("root").alias("node"), "root").distinct())
    sized = classes.join(nodes.where("size > 0").groupBy("node").agg(F.first("size").alias("size")), "node")
    members = staged.keep(sized)
    size = LEAST_BITS
    while size < min(MOST_BITS, 16 * members.count()):
        size *= 2
    bit = F.col("node").bitwiseAND(F.lit(size - 1))
    bits = members.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(node & 63 as int)))").alias("bits")).toPandas()
    wanted = np.zeros(size >> 6, dtype=np.uint64)
    wanted[bits["word"].to_numpy(dtype=np.int64)] = bits["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    sets = _sets(docs, n, wanted).dropDuplicates(["node"])

    totals = members.groupBy("root").agg(F.sum("size").alias("tokens"))
    tokens = totals.agg(F.sum("tokens")).first()[0] or 0
    units = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // TASK))
    placed = members.join(totals, "root").select("node", "root", F.ceil(F.col("tokens") / TASK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # classes of one block share tasks; two blocks of a larger class have a task
    unit = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(units))).otherwise(F.col("root"))
    dealt = placed.select("node", "root", unit.alias("unit"), F.when(F.col("blocks") == 1, -1).otherwise(F.least("own", "other")).alias("a"), F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("own", "other")).alias("b"))

    def verify(key, rows):
        root = rows.column("root").to_numpy()
        order = np.lexsort((rows.column("node").to_numpy(), root))
        node, sets = rows.column("node").to_numpy()[order], rows.column("grams").take(pa.array(order)).to_pylist()
        firsts = [np.asarray(v, dtype=np.int64) for v in rows.column("first").take(pa.array(order)).to_pylist()]
        ends = np.append(np.flatnonzero(np.diff(root[order])) + 1, len(order))
        u, v, at = [], [], 0
        for end in ends.tolist():
            if end - at > 1:
                for x, y in links_within([np.frombuffer(s, dtype=np.uint64) for s in sets[at:end]], firsts[at:end], percent):
                    u.append(node[at + x])
                    v.append(node[at + y])
            at = end
        del sets, firsts
        give_back()
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    # a node's n-grams in the first order's prefix, at most as many as its text has
    firsts = pairs.groupBy("node").agg(F.collect_set("gram").alias("first"))
    return dealt.join(sets, "node").join(firsts, "node").groupBy("unit", "a", "b").applyInArrow(verify, "u long, v long")
