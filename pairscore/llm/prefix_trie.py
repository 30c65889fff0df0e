"""Tries over conversations: which beginnings they share, and what a cache of prefixes would save.

Equal conversations are one sequence with a count, and turns are told apart by a 128-bit digest, so that no text is in the
trie. Sequences are dealt by their first turn. A first turn whose sequences are too many for one group is a node that the
plan sums up itself; its sequences are dealt again by their next turn, and so on. Every other subtrie is built whole in an
``applyInPandas`` call, as dictionaries by turn, and folded up by an iterative postorder.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Staged, give_back

DIGEST = 16
#: Turns of all sequences of a group from which on it is dealt again.
GROUP_TURNS = 100_000
#: Groups to be dealt again up to which they are broadcast.
FEW = 10_000
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_ROOT = b""
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(turns: DataFrame) -> DataFrame:
    """conv_id, digests, chars: each conversation's turns in order (a null turn first; equal ones by role, the beginning of
    the text and its digest), as joined digests of role and text, and the texts' code points. Null roles and texts are as
    empty ones. Rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, DIGEST)
    told = turns.where("conv_id is not null").select("conv_id", F.struct(F.col("turn"), role.alias("role"), F.left(text, F.lit(32)).alias("text"), digest.alias("digest"), F.length(text).alias("chars")).alias("t"))
    listed = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return listed.select(F.col("conv_id").cast("long").alias("conv_id"), joined(F.col("ts.digest")).alias("digests"), F.col("ts.chars").alias("chars"))


def rebuilt(convs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of another one: of conversation c, the first h turns come from
    conversation ``c - c % every``, as far as there are any, with h the CRC-32 of c in decimal modulo ``most``."""
    heads = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_head"), F.substring(F.col("digests"), F.lit(1), F.lit((most - 1) * DIGEST)).alias("_digests"), F.slice("chars", 1, most - 1).alias("_chars"))
    told = convs.withColumn("_head", F.col("conv_id") - F.col("conv_id") % every).join(heads, "_head", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    digests = F.concat(F.coalesce(F.substring(F.col("_digests"), F.lit(1), h * DIGEST), F.lit(b"")), F.substring(F.col("digests"), h * DIGEST + 1, F.octet_length("digests")))
    chars = F.concat(F.coalesce(F.slice("_chars", F.lit(1), h), F.array().cast("array<int>")), F.slice("chars", h + 1, F.size("chars")))
    return told.select("conv_id", digests.alias("digests"), chars.alias("chars"))


def joined(digests: Column) -> Column:
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def _digests(n: Column) -> Column:
    """The n-th turn's digest, from 1."""
    return F.substring(F.col("digests"), (n - 1) * DIGEST + 1, F.lit(DIGEST))


def _ends(batches):
    """(seq, sha256 of its conv_ids, ascending, joined by commas) from rows sorted by both: ids go into the digest one by
    one, so that any number of equal conversations takes the same memory."""
    now, digest, out = None, None, []

    def written():
        return pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.binary()), pa.array([h for _, h in out], pa.string())], ["seq", "ends"])

    for b in batches:
        for seq, ids in zip(b.column(0).to_pylist(), map(str, b.column(1).to_pylist())):
            if seq == now:
                digest.update(b"," + ids.encode())
            else:
                if digest:
                    out.append((now, digest.hexdigest()))
                now, digest = seq, hashlib.sha256(ids.encode())
        if len(out) >= 10_000:
            yield written()
            out = []
    if digest:
        out.append((now, digest.hexdigest()))
    yield written()


def sequences(convs: DataFrame) -> DataFrame:
    """One row per distinct sequence: ``digests, chars``, ``n`` conversations that are it, the smallest ``conv_id`` and
    ``ends``, the digest of all their ids. Copies are counted before they are shuffled; only ids that have copies are sorted."""
    keyed = convs.withColumn("seq", F.substring(F.unhex(F.sha2("digests", 256)), 1, DIGEST))
    own = keyed.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.any_value("digests").alias("digests"), F.any_value("chars").alias("chars"))
    sorted_ids = keyed.select("seq", "conv_id").repartition("seq").sortWithinPartitions("seq", "conv_id")
    return own.join(sorted_ids.mapInArrow(_ends, "seq binary, ends string"), "seq")


def subtrie(rows) -> list[tuple]:
    """(turn number within the group from 1, conv_id, parent's conv_id, n_convs, n_children, n_leaves, saved, ends) of each
    node but the place that the group hangs from, whose conv_id is that of the parents of depth 1. ``rows`` are (digests,
    chars, n, conv_id, ends) of at least one turn."""
    top: dict[bytes, list] = {}
    for digests, chars, n, conv_id, ends in rows:
        children, node = top, None
        for i, at in enumerate(range(0, len(digests), DIGEST)):
            turn = digests[at : at + DIGEST]
            node = children.get(turn)
            if node is None:
                node = children[turn] = [{}, conv_id, 0, int(chars[i]), _NO_ENDS]
            elif conv_id < node[1]:
                node[1] = conv_id
            node[2] += n
            children = node[0]
        node[4] = ends
    # postorder without recursion: a node comes a second time once all below it are done
    out, done = [], {}
    stack = [(node, None, 1, False) for node in top.values()]
    while stack:
        node, above, depth, below = stack.pop()
        children, conv_id, n, size, ends = node
        if not below:
            stack.append((node, above, depth, True))
            stack += [(c, conv_id, depth + 1, False) for c in children.values()]
            continue
        leaves, saved = 0, (n - 1) * size
        for c in children.values():
            c_leaves, c_saved = done.pop(id(c))
            leaves += c_leaves
            saved += c_saved
        leaves = leaves or 1
        done[id(node)] = leaves, saved
        out.append((depth, conv_id, above, n, len(children), leaves, saved, ends))
    return out


_BUILT = f"{NODE}, path array<binary>"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket of groups: all nodes of their subtries. ``path`` of the topmost ones tells what they hang from."""
    out = []
    for _, group in pdf.groupby("key", sort=False):
        skip = int(group["level"].iloc[0]) - 1
        parent, path = int(group["parent_conv_id"].iloc[0]), list(group["path"].iloc[0])
        rows = ((d[skip * DIGEST :], c[skip:], int(n), int(i), e) for d, c, n, i, e in zip(group["digests"], group["chars"], group["n"], group["conv_id"], group["ends"]))
        for depth, conv_id, above, *rest in subtrie(rows):
            out.append((conv_id, depth + skip, parent if depth == 1 else above, *rest, path if depth == 1 else None))
    return pd.DataFrame(out, columns=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "path"])


def prefix_trie(convs: DataFrame, group_turns: int = GROUP_TURNS, few: int = FEW) -> DataFrame:
    """All nodes of the trie over ``convs`` (conv_id, digests, chars; see ``turn_lists``), as ``NODE``.

    A node is a distinct sequence of first turns, the root the empty one; its conv_id is the smallest of those that begin
    with it. ``n_leaves`` and ``saved_tokens`` are over its subtree, with itself; ``saved_tokens`` sums (n_convs - 1) times
    the code points of each node's last text. ``ends_sha256`` is the SHA-256 of the ids, ascending and joined by commas,
    of conversations that end at the node. Conversations without turns end at the root. Without any conversation there
    are no nodes. Only a conversation itself is held whole; one sequence alone is never dealt again."""
    staged = Staged(convs.sparkSession)
    all_ = staged.keep(sequences(convs))
    size = (F.octet_length("digests") / DIGEST).cast("int")
    total = all_.agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum(size).alias("turns")).first()
    if not total["n"]:
        return convs.sparkSession.createDataFrame([], NODE)
    none = F.lit(None).cast("long")
    columns = ["key", "level", "path", "parent_conv_id", "digests", "chars", "n", "conv_id", "ends"]
    root = all_.agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max(F.when(size == 0, F.col("ends"))).alias("ends"))
    spine = [root.select(F.lit(_ROOT).alias("key"), F.array().cast("array<binary>").alias("path"), none.alias("parent_conv_id"), "conv_id", "n_convs", F.lit(0).cast("long").alias("own"), "ends", F.lit(0).alias("level"))]
    rest = all_.where(size > 0).select(_digests(F.lit(1)).alias("key"), F.lit(1).alias("level"), F.array(F.lit(_ROOT)).alias("path"), F.lit(total["conv_id"]).alias("parent_conv_id"), "digests", "chars", "n", "conv_id", "ends")
    ready, level = [], 1
    while True:
        large = rest.groupBy("key").agg(F.count("*").alias("rows"), F.sum(size - (level - 1)).alias("turns")).where((F.col("rows") > 1) & (F.col("turns") > group_turns))
        large = staged.keep(large.select("key", F.lit(True).alias("_large")))
        n_large = large.count()
        if not n_large:
            ready.append(rest)
            break
        # all rows of a large group meet one row of this side: it is sent to them while it is small, else the join's skew is split
        told = rest.join(F.broadcast(large) if n_large <= few else large, "key", "left")
        told = staged.keep(told)
        ready.append(told.where("_large is null").select(*columns))
        here = told.where("_large")
        ended = F.max(F.when(size == level, F.col("ends")))
        node = staged.keep(here.groupBy("key", "path").agg(F.min("parent_conv_id").alias("parent_conv_id"), F.min("conv_id").alias("top"), F.sum("n").alias("n_convs"), F.max(F.get("chars", F.lit(level - 1))).cast("long").alias("chars"), ended.alias("ends")))
        spine.append(node.select("key", "path", "parent_conv_id", F.col("top").alias("conv_id"), "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("own"), "ends", F.lit(level).alias("level")))
        tops = node.select("key", "top")
        onward = here.where(size > level).join(F.broadcast(tops) if n_large <= few else tops, "key")
        following = F.substring(F.unhex(F.sha2(F.concat("key", _digests(F.lit(level + 1))), 256)), 1, DIGEST)
        rest = onward.select(following.alias("key"), F.lit(level + 1).alias("level"), F.concat("path", F.array("key")).alias("path"), F.col("top").alias("parent_conv_id"), "digests", "chars", "n", "conv_id", "ends")
        level += 1
    groups = ready[0]
    for more in ready[1:]:
        groups = groups.unionByName(more)
    buckets = max(1, -(-int(total["turns"] or 0) // group_turns), int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        give_back()
        return _build(pdf)

    built = staged.keep(groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(build, _BUILT))
    nodes = spine[0]
    for more in spine[1:]:
        nodes = nodes.unionByName(more)
    # what hangs below a node that was dealt again, near or far: subtries by their topmost nodes, and other such nodes by themselves
    below = built.where("path is not null").select("path", "n_leaves", F.col("saved_tokens").alias("saved")).unionByName(nodes.where("level > 0").select("path", F.lit(0).cast("long").alias("n_leaves"), F.col("own").alias("saved")))
    below = below.select("n_leaves", "saved", F.size("path").alias("far"), F.posexplode("path").alias("at", "key"))
    below = below.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.sum((F.col("at") == F.col("far") - 1).cast("long")).alias("n_children"))
    summed = nodes.join(below, "key", "left").select(
        "conv_id", F.col("level").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), (F.col("own") + F.coalesce("saved", F.lit(0).cast("long"))).alias("saved_tokens"), F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
    return built.drop("path").unionByName(summed)
