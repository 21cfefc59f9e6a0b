"""The trie of conversations' prefixes, from vertical bitmaps.

A conversation is cut into blocks of depth; a shard holds a run of conversations, in the
order of their ids, at one block. Each shard indexes (position, turn) to the bitset of its
conversations that have that turn there. From the bitset of a node, the posting of its
least member's next turn gives that member's child by intersection; what is left gives
the next child, until none is. The population count of a child is its members, its
least bit its smallest conversation, and its part of those that end there its end list.
A node of one member is the rest of that conversation and needs no intersection.

Nodes are named by 128 bits, the combined hashes of (position, turn) on their path, so
the nodes of shards meet by name; a node that very many conversations share comes once
from each shard. Members, subtree leaves and saved tokens are sums over members:

* the smallest member of a node owns it. A conversation owns the end of its path, from
  some depth on, and the subtree's distinct nodes are those its members own;
* so a subtree saves the words that its members have on nodes they don't own, and its
  leaves are the childless end nodes that they own.

Only turns on shared nodes are looked at for that. Ids of end lists arrive in ranges and
are hashed as a stream. Positions are counted in a range-sorted table, so that no
conversation, however long, is one task's.

Turns without a conv_id belong to no conversation. Null role or text is empty. Equal turn
numbers go by role, then the digest of the text; repeated rows are turns of their own.
Other columns aren't read. An empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import stored
from tidemark.llm.minhash import mixed
from tidemark.llm.skew import left_join
from tidemark.llm.text import bounded, word_array

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_SEEDS = (_U(0x243F6A8885A308D3), _U(0x13198A2E03707344))
_ARRAYS = ("ta", "tb", "words")


def turn_table(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, digest of the text and its words; no text from here on."""
    text = F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.unhex(F.md5(text)).alias("digest"),
        F.size(word_array(text)).alias("words"),
    )


def _pieces(turns: DataFrame, block: int) -> DataFrame:
    """Runs of at most `block` turns of a conversation, as arrays.

    `slice` and `rank` say where: the number of the range, and the turns of the same
    conversation in that range before it.
    """
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest"]

    def run(batches):
        here = TaskContext.get().partitionId()
        before, rank = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            turn = zip(batch.column("role").to_pylist(), batch.column("digest").to_pylist())
            codes = np.frombuffer(
                b"".join(xxhash.xxh3_128_digest(r.encode() + b"\0" + d) for r, d in turn), "<i8"
            ).reshape(-1, 2)
            words = batch.column("words").to_numpy()
            cuts = np.flatnonzero(np.diff(conv)) + 1
            rows = []
            for a, b in zip([0, *cuts], [*cuts, len(conv)], strict=True):
                if conv[a] != before:
                    before, rank = conv[a], 0
                for i in range(a, b, block):
                    j = min(i + block, b)
                    rows.append((before, here, rank, codes[i:j, 0], codes[i:j, 1], words[i:j]))
                    rank += j - i
            yield _batch(rows, pieces)

    pieces = "conv long, slice int, rank long, ta array<long>, tb array<long>, words array<int>"
    spread = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return spread.select("conv", "role", "digest", "words").mapInArrow(run, pieces)


_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(part.split() for part in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else ((),) * len(names)
    arrays = [pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def _cut(start: Column | int, length: Column) -> list[Column]:
    return [F.slice(c, F.lit(start) + 1 if isinstance(start, int) else start + 1, length).alias(c)
            for c in _ARRAYS]


def _rebuilt(pieces: DataFrame, family: int, heads: int, block: int) -> DataFrame:
    """conv, block, n and arrays of the rebuilt turns, the root in front.

    The first h turns come from the family's first conversation; h is below `heads`.
    """
    size = F.size("words")
    counts = pieces.groupBy("conv", "slice").agg(F.sum(size).alias("own"))
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    skips = counts.select(
        "conv", "slice", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("skip")
    )
    placed = stored(
        pieces.join(skips, ["conv", "slice"])
        .withColumn("begin", F.col("skip") + F.col("rank"))
        .drop("skip", "rank", "slice")
    )
    firsts = (
        placed.where((F.col("conv") % family == 0) & (F.col("begin") < heads - 1))
        .select("conv", "begin", *_cut(0, (heads - 1 - F.col("begin")).cast("int")))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("begin", *_ARRAYS))).alias("f"))
        .select("base", *(F.flatten(F.col("f")[c]).alias(c) for c in _ARRAYS))
    )
    h = (F.crc32(F.col("conv").cast("string")) % heads).cast("int")
    nothing = {c: F.array().cast("array<int>" if c == "words" else "array<long>") for c in _ARRAYS}
    convs = stored(
        placed.groupBy("conv")
        .agg(F.sum(size).alias("own"))
        .withColumns({"base": F.col("conv") - F.col("conv") % family, "h": h})
        .join(firsts, "base", "left")
        .withColumns({c: F.slice(F.coalesce(c, nothing[c]), 1, F.col("h")) for c in _ARRAYS})
        .withColumn("hb", size)
        .withColumn("n", F.col("hb") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    root = {c: F.concat(F.array(F.lit(0).cast("int" if c == "words" else "long")), c)
            for c in _ARRAYS}
    top = convs.select("conv", "n", F.lit(0).cast("long").alias("start"),
                       *(root[c].alias(c) for c in _ARRAYS))
    drop = F.greatest(F.col("h") - F.col("begin"), F.lit(0)).cast("int")
    rest = (
        left_join(placed, convs.select("conv", "n", "h", "hb"), "conv")
        .where(size > drop)
        .select(
            "conv",
            "n",
            (1 + F.col("hb") + F.greatest("begin", "h") - F.col("h")).alias("start"),
            *_cut(drop, size - drop),
        )
    )
    lo = F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).cast("int")
    hi = F.least((F.col("block") + 1) * block - F.col("start"), size).cast("int")
    return (
        top.unionByName(rest)
        .withColumn("block", F.explode(F.expr(
            f"sequence(start div {block}, (start + size(words) - 1) div {block})")))
        .select("conv", "n", "block", (F.col("start") + lo).alias("start"), *_cut(lo, hi - lo))
        .groupBy("conv", "block")
        .agg(
            F.first("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("start", *_ARRAYS))).alias("f"),
        )
        .select("conv", "block", "n", *(F.flatten(F.col("f")[c]).alias(c) for c in _ARRAYS))
    )


def _positioned(strands: DataFrame, block: int) -> DataFrame:
    """Arrays a and b, hashes of (depth, turn), instead of the turns'; and their sums."""
    schema = (
        "conv long, block long, n long, a array<long>, b array<long>, words array<int>, "
        "xa long, xb long, sum long"
    )

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                depth = np.arange(len(row["ta"]), dtype=_U) + _U(row["block"] * block + 1)
                a, b = (
                    mixed(mixed(depth * _STEP + seed) ^ np.array(row[c], np.int64).view(_U))
                    .view(np.int64)
                    for c, seed in zip(("ta", "tb"), _SEEDS, strict=True)
                )
                sums = np.bitwise_xor.reduce(a), np.bitwise_xor.reduce(b), sum(row["words"])
                rows.append((row["conv"], row["block"], row["n"], a, b, row["words"], *sums))
            yield _batch(rows, schema)

    return strands.mapInArrow(run, schema)


def _names(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    raw = np.column_stack([a, b]).astype("<i8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


class Bitmaps:
    """The vertical index of one shard's conversations at one block of depth."""

    def __init__(self, convs: list[int], paths: list[tuple[np.ndarray, np.ndarray]]):
        self.convs, self.paths = convs, paths
        self.lengths = np.array([len(a) for a, _ in paths])
        at = np.concatenate([np.arange(n) for n in self.lengths])
        who = np.repeat(np.arange(len(convs)), self.lengths)
        a, b = (np.concatenate([p[i] for p in paths]) for i in (0, 1))
        order = np.lexsort((b, a, at))
        at, a, b, who = at[order], a[order], b[order], who[order]
        new = (np.diff(at) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
        cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(at)]])
        #: Turns of two conversations at least; others' postings are one bit.
        self.postings = {
            (int(at[i]), int(a[i]), int(b[i])): self._bits(who[i:j])
            for i, j in zip(cuts, cuts[1:], strict=False)
            if j - i > 1
        }
        self._longer: dict[int, int] = {}

    def _bits(self, members: np.ndarray) -> int:
        mask = np.zeros(len(self.convs), bool)
        mask[members] = True
        return int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little")

    def longer(self, length: int) -> int:
        """Conversations that have more than `length` turns here."""
        if length not in self._longer:
            self._longer[length] = self._bits(np.flatnonzero(self.lengths > length))
        return self._longer[length]

    def members(self, bits: int) -> list[int]:
        raw = np.frombuffer(bits.to_bytes(len(self.convs) // 8 + 1, "little"), np.uint8)
        return [self.convs[i] for i in np.flatnonzero(np.unpackbits(raw, bitorder="little"))]

    def groups(self, starts: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
        """Conversations by the node that they come from."""
        found: dict[tuple[int, int], list[int]] = {}
        for i, start in enumerate(starts):
            found.setdefault(start, []).append(i)
        return {start: self._bits(np.array(m)) for start, m in found.items()}

    def walk(self, starts: list[tuple[int, int]]):
        """Depth first: (a, b, position, bits) of nodes of many members, as found, and
        (a, b, position, number) of the node from which a conversation goes alone."""
        todo = [(bits, 0, *start) for start, bits in self.groups(starts).items()]
        while todo:
            left, k, a, b = todo.pop()
            while left:
                low = left & -left
                i = low.bit_length() - 1
                turn = int(self.paths[i][0][k]), int(self.paths[i][1][k])
                child = left & self.postings.get((k, *turn), low)
                left ^= child
                if child == low:
                    yield a, b, k, None, i
                    continue
                yield a, b, k, child, i
                if more := child & self.longer(k + 1):
                    todo.append((more, k + 1, a ^ turn[0], b ^ turn[1]))


_NODES = "key binary, up binary, depth long, conv long, n long, n_ends long, ends string"


def _shard_nodes(rows: list[dict], block: int) -> pa.RecordBatch:
    """Nodes of a shard; rows are in the order of their ids."""
    paths = [(np.array(r["a"], np.int64), np.array(r["b"], np.int64)) for r in rows]
    index = Bitmaps([r["conv"] for r in rows], paths)
    top = rows[0]["block"] * block
    closed = index._bits(
        np.array([i for i, r in enumerate(rows) if top + len(r["a"]) == r["n"] + 1], int)
    )
    out = []
    for a, b, k, bits, i in index.walk([(r["sa"], r["sb"]) for r in rows]):
        path = paths[i]
        end = k + 1 if bits else None
        pa_, pb = (
            np.bitwise_xor.accumulate(np.concatenate([[np.int64(x)], p[k:end]]))
            for x, p in zip((a, b), path, strict=True)
        )
        names = _names(pa_, pb)
        if top + k == 0:
            names[0] = None
        conv = rows[i]["conv"]
        if bits:
            ended = index.members(bits & closed & ~index.longer(k + 1))
            text = ",".join(map(str, ended)) if ended else None
            out.append((names[1], names[0], top + k, conv, bits.bit_count(), len(ended), text))
            continue
        for step in range(1, len(names)):
            out.append((names[step], names[step - 1], top + k + step - 1, conv, 1, 0, None))
        if closed >> i & 1:
            out[-1] = (*out[-1][:5], 1, str(conv))
    return _batch(out, _NODES)


def _local(strands: DataFrame, block: int, shard_turns: int) -> DataFrame:
    """The nodes of all shards. A task cuts its range of conversations into shards."""

    def run(batches):
        rows, turns = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if rows and (turns >= shard_turns or row["block"] != rows[0]["block"]):
                    yield _shard_nodes(rows, block)
                    rows, turns = [], 0
                rows.append(row)
                turns += len(row["a"])
        if rows:
            yield _shard_nodes(rows, block)

    order = ["block", "conv"]
    return (
        strands.select("block", "conv", "n", "a", "b", "sa", "sb")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, _NODES)
    )


def _end_hashes(local: DataFrame) -> DataFrame:
    """key and SHA-256 of the end list, whose parts come in ascending ranges of ids."""

    def run(batches):
        key, digest = None, None
        for batch in batches:
            rows = []
            for name, text in zip(
                batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True
            ):
                if name != key:
                    if digest:
                        rows.append((key, digest.hexdigest()))
                    key, digest = name, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield _batch(rows, "key binary, sha string")
        if digest:
            yield _batch([(key, digest.hexdigest())], "key binary, sha string")

    return (
        local.where("n_ends > 0")
        .select("key", "conv", "ends")
        .repartition("key")
        .sortWithinPartitions("key", "conv")
        .select("key", "ends")
        .mapInArrow(run, "key binary, sha string")
    )


def _subtree_parts(strands: DataFrame, block: int) -> DataFrame:
    """key, saved and leaves: what each member adds to its shared nodes."""
    schema = "key binary, saved long, leaves long"

    def run(batches):
        for batch in batches:
            names, saved, leaves = [], [], []
            for row in batch.to_pylist():
                top = row["block"] * block
                count = min(len(row["a"]), row["last"] - top + 1)
                a, b = (
                    np.bitwise_xor.accumulate(
                        np.concatenate([[np.int64(row[s])], np.array(row[c], np.int64)[:count]])
                    )[1:]
                    for c, s in (("a", "sa"), ("b", "sb"))
                )
                words = np.array(row["words"], np.int64)
                before = row["w0"] + np.cumsum(words) - words
                foreign = row["foreign"]
                if foreign is None:
                    foreign = int(words[: max(0, row["owned"] - top)].sum())
                depth = top + np.arange(count)
                names += _names(a, b)
                saved.append(np.where(depth < row["owned"], foreign - before[:count], 0))
                leaves.append(np.full(count, int(row["leaf"])))
            if names:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.binary()),
                        pa.array(np.concatenate(saved), pa.int64()),
                        pa.array(np.concatenate(leaves), pa.int64()),
                    ],
                    names=["key", "saved", "leaves"],
                )

    parts = strands.where(F.col("last") >= F.col("block") * block).mapInArrow(run, schema)
    return parts.groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def prefix_nodes(
    conversations: DataFrame,
    family: int = 20,
    heads: int = 4,
    block: int = 1024,
    shard_turns: int = 1 << 14,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Conversation c gets its first crc32(c) % heads turns from c - c % family. `block` is
    the depth of a block, `shard_turns` the turns that close a shard; neither changes
    the result. Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    bounded(conversations.sparkSession)
    turns = stored(turn_table(conversations))
    pieces = stored(_pieces(turns, block))
    strands = stored(_positioned(_rebuilt(pieces, family, heads, block), block))

    # What lies in the blocks before one; the arrays stay where they are meanwhile.
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    started = {
        "sa": F.coalesce(F.bit_xor("xa").over(before), zero),
        "sb": F.coalesce(F.bit_xor("xb").over(before), zero),
        "w0": F.coalesce(F.sum("sum").over(before), zero),
    }
    deep = F.col("n") >= block
    starts = strands.where(deep).select("conv", "block", "xa", "xb", "sum").withColumns(started)
    strands = (
        strands.where(~deep)
        .withColumns(dict.fromkeys(started, zero))
        .unionByName(
            strands.where(deep).join(starts.select("conv", "block", *started), ["conv", "block"])
        )
        .drop("xa", "xb", "sum")
    )
    local = stored(_local(strands, block, shard_turns))
    nodes = stored(
        local.groupBy("key").agg(
            F.first("up").alias("up"),
            F.first("depth").alias("depth"),
            F.min("conv").alias("conv"),
            F.sum("n").alias("n"),
            F.sum("n_ends").alias("n_ends"),
        )
    )
    owners = stored(
        nodes.groupBy("conv").agg(
            F.min("depth").alias("owned"),
            F.max(F.when(F.col("n") > 1, F.col("depth"))).alias("shared"),
            F.max_by(F.col("n") == F.col("n_ends"), "depth").alias("leaf"),
            F.min_by("up", "depth").alias("up"),
        )
    )
    beyond = F.lit((1 << 62)).cast("long")
    known = left_join(strands, owners.drop("up"), "conv").select(
        *strands.columns,
        F.coalesce("owned", beyond).alias("owned"),
        F.greatest(F.coalesce("owned", beyond) - 1, F.coalesce("shared", F.lit(-1))).alias("last"),
        F.coalesce("leaf", F.lit(False)).alias("leaf"),
    )
    inside = F.greatest(zero, F.least(F.size("words"), F.col("owned") - F.col("block") * block))
    foreign = F.aggregate(
        F.slice("words", 1, inside.cast("int")), zero, lambda total, x: total + x
    )
    long_ = stored(known.where(deep))
    sums = stored(long_.groupBy("conv").agg(F.sum(foreign).alias("foreign")))
    known = known.where(~deep).withColumn("foreign", F.lit(None).cast("long")).unionByName(
        left_join(long_, sums, "conv")
    )
    facts = (
        nodes.select("key", "depth", "conv", "n")
        .unionByName(_subtree_parts(known, block), allowMissingColumns=True)
        .unionByName(
            nodes.where("up is not null").groupBy(F.col("up").alias("key")).agg(
                F.count("*").alias("children")
            ),
            allowMissingColumns=True,
        )
        .unionByName(_end_hashes(local), allowMissingColumns=True)
    )
    merged = stored(
        facts.groupBy("key").agg(
            F.max("depth").alias("depth"),
            F.max("conv").alias("conv"),
            F.max("n").alias("n_convs"),
            F.coalesce(F.sum("children"), zero).alias("n_children"),
            F.coalesce(F.sum("leaves"), F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce(F.sum("saved"), zero).alias("saved_tokens"),
            F.coalesce(F.max("sha"), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
    # The parent of a node that isn't the first its conversation owns has the same owner.
    parents = nodes.select(F.col("key").alias("up"), F.col("conv").alias("above"))
    tops = stored(
        left_join(owners.select("conv", "owned", "up"), parents, "up").select(
            "conv", "owned", "above"
        )
    )
    above = F.when(F.col("depth") == F.col("owned"), F.col("above")).otherwise(F.col("conv"))
    return left_join(merged, tops, "conv").select(
        F.col("conv").alias("conv_id"),
        "depth",
        above.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
