"""Near-duplicates by SuperMinHash signatures, banding, exact checks and components.

A text's set is its distinct shingles of `words` consecutive words (A-Z lower-cased);
a text with fewer words has the whole sequence as one, a text without words or a null
has none and is linked with nothing. Every shingle is a 64-bit hash.

SuperMinHash deals each element's values to the places of the signature in the order
of a random permutation of its own; rank k of the permutation adds k to the value, so
once every place holds a value below k + 1 the later ranks can't matter and a document
stops there. All elements of a batch go through a rank together.

Texts with equal sets are one class from there on. Classes that share a band form a
bucket. First each bucket links its members to its least one, its leader, checked on full
sets. Where the members that a leader has in all its buckets are still in different
components then, they are compared across components by signature, in blocks of bounded
size. Members that are near one of another component, with an estimate not below the
threshold by more than `margin` (over five standard deviations), have their full sets
compared, in blocks too; sets travel there as their difference to the leader's. A block
puts out a forest of the links it finds, not the pairs, so a large group of copies,
linked or just not, makes no more rows than it has members. No link between different
texts is lost but for the banding: at 32 bands of 4 a pair at 0.85 is missed once in
2e10, at 0.8 once in 2e7. The work within a group whose members are all near one another
but not linked grows with its square, as each pair there has to be told from a link.

Repeated rows are copies like others; rows that share a doc_id but not the text are
texts of their own. A null doc_id can be the id of a component only if no other is in it.
Other columns aren't read. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components, stored
from tidemark.llm.text import LOWER, UPPER, blobs, bounded, runs

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_U = np.uint64
_STEP, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_RANK = _U(48)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), len(parts))], np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = len(ids) - words + 1
    out = np.full(n, words, np.uint64)
    for i in range(words):
        out = mixed(out * _STEP + ids[i : i + n])
    return np.unique(out)


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """A row of `places` values per set; empty sets keep the largest value."""
    out = np.full((len(sets), places), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order: np.ndarray | None = None  # what the shuffles have left of each permutation
    for rank in range(places):
        drawn = mixed(elements + _U(((rank + 1) * int(_STEP)) & (2**64 - 1)))
        pick = rank + (((drawn & _U(0xFFFF)) * _U(places - rank)) >> _U(16)).astype(np.int64)
        if rank:
            if order is None:
                order = np.tile(np.arange(places, dtype=np.uint8), (len(elements), 1))
                rows = np.arange(len(elements))
                order[rows, first] = 0
            rows = np.arange(len(elements))
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        else:
            place = first = pick
        np.minimum.at(flat, owner * places + place, (_U(rank) << _RANK) | (drawn >> _U(16)))
        open_ = out.max(axis=1) >= (_U(rank + 1) << _RANK)
        keep = open_[owner]
        if not keep.any():
            break
        elements, owner = elements[keep], owner[keep]
        if order is None:
            first = first[keep]
        else:
            order = order[keep]
    return out


def _bands(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.shape[1] // bands
    cut = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), cut.shape[:2]).copy()
    for i in range(rows):
        out = mixed(out * _STEP + cut[:, :, i])
    return out.view(np.int64)


def _profiles(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """id, n_shingles, node (digest of the set), sketch (16 bits a place), bands."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in runs(batches, "text", 1 << 20):
            sets = [shingles(t, words) for t in blobs(batch.column("text"))]
            signature = signatures(sets, bands * rows)
            keys = _bands(signature, bands)
            low = (signature & _U(0xFFFF)).astype("<u2")
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [
                            xxhash.xxh3_128_digest(s.tobytes()) if f else None
                            for s, f in zip(sets, full, strict=True)
                        ],
                        pa.binary(),
                    ),
                    pa.array([x.tobytes() for x in low], pa.binary()),
                    pa.array(
                        [x if f else [] for x, f in zip(keys, full, strict=True)],
                        pa.list_(pa.int64()),
                    ),
                ],
                names=["id", "n_shingles", "node", "sketch", "bands"],
            )

    return docs.mapInArrow(
        run, f"id {kind}, n_shingles long, node binary, sketch binary, bands array<long>"
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """node and shingles of each text."""

    def run(batches):
        for batch in runs(batches, "text", 1 << 20):
            packed = [shingles(t, words).tobytes() for t in blobs(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(p) for p in packed], pa.binary()),
                    pa.array(packed, pa.binary()),
                ],
                names=["node", "shingles"],
            )

    return docs.select("text").mapInArrow(run, "node binary, shingles binary")


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets are similar."""
    joined = pairs.join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("one")), "a"
    ).join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("other")), "b")

    def run(batches):
        for batch in batches:
            good = []
            for one, other in zip(
                batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True
            ):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.select("a", "b", "one", "other").mapInArrow(run, "a binary, b binary")


def _dealt(members: DataFrame, parts: Column, keep: list[str]) -> DataFrame:
    """Members of a leader by pairs of parts, so that any two meet, and no task gets a
    group whole; `mine` is a member's own part."""
    mine = F.pmod(F.xxhash64("node"), parts).cast("int")
    return (
        members.withColumns({"mine": mine, "parts": parts})
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
        .select(
            "leader",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            "mine",
            *keep,
        )
    )


def _numbered(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Nodes, their components as numbers, and which pairs are this task's to judge."""
    nodes = table.column("node").to_pylist()
    known: dict[bytes, int] = {}
    inside = np.array([known.setdefault(c, len(known)) for c in table.column("component").to_pylist()])
    mine = table.column("mine").to_numpy()
    if len(mine) and table.column("low")[0].as_py() != table.column("high")[0].as_py():
        ours = mine[:, None] != mine[None, :]
    else:
        ours = np.ones((len(nodes), len(nodes)), bool)
    return nodes, inside, ours


def _alike(members: DataFrame, least: float, block: int) -> DataFrame:
    """Of each leader, the members that are like one of another component by sketch: at
    most one row a member and part, however many are alike."""

    def run(table: pa.Table) -> pa.Table:
        nodes, inside, ours = _numbered(table)
        sketch = np.array([np.frombuffer(x, "<u2") for x in table.column("sketch").to_pylist()])
        found = np.zeros(len(nodes), bool)
        for i in range(len(nodes) - 1):
            near = (sketch[i + 1 :] == sketch[i]).mean(axis=1) >= least
            near &= (inside[i + 1 :] != inside[i]) & ours[i, i + 1 :]
            found[i] |= near.any()
            found[i + 1 :] |= near
        return table.select(["leader", "node", "component"]).filter(pa.array(found))

    dealt = _dealt(members, F.ceil(F.col("size") / block), ["node", "component", "sketch"])
    return (
        dealt.groupBy("leader", "low", "high")
        .applyInArrow(run, "leader binary, node binary, component binary")
        .distinct()
    )


def _coded(found: DataFrame, sets: DataFrame) -> DataFrame:
    """Each member's set as the difference to its leader's, which near copies have little
    of: bits of the leader's elements that are kept, and the other elements."""
    joined = found.join(
        sets.select(F.col("node").alias("leader"), F.col("shingles").alias("one")), "leader"
    ).join(sets.select("node", F.col("shingles").alias("other")), "node")

    def run(batches):
        for batch in batches:
            kept, extra, sizes = [], [], []
            for one, other in zip(
                batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True
            ):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                kept.append(np.packbits(np.isin(x, y, assume_unique=True)).tobytes())
                extra.append(y[~np.isin(y, x, assume_unique=True)].tobytes())
                sizes.append(len(y))
            names = ["leader", "node", "component"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(kept, pa.binary()),
                    pa.array(extra, pa.binary()),
                    pa.array(sizes, pa.int64()),
                ],
                names=[*names, "kept", "extra", "n"],
            )

    return joined.mapInArrow(
        run, "leader binary, node binary, component binary, kept binary, extra binary, n long"
    )


def common_sizes(kept: list[bytes], extra: list[bytes], width: int = 1 << 13) -> np.ndarray:
    """The sizes of the intersections of all pairs of coded sets, by products of 0/1
    matrices of at most `width` elements at a time."""
    out = np.zeros((len(kept), len(kept)), np.float32)
    bits = np.array([np.frombuffer(k, np.uint8) for k in kept])
    for at in range(0, bits.shape[1], width // 8):
        part = np.unpackbits(bits[:, at : at + width // 8], axis=1).astype(np.float32)
        out += part @ part.T
    owner = np.repeat(np.arange(len(extra)), [len(e) // 8 for e in extra])
    values, element, times = np.unique(
        np.frombuffer(b"".join(extra), np.uint64), return_inverse=True, return_counts=True
    )
    shared = np.cumsum(times > 1) - 1  # elements of one set alone are in no intersection
    inside = times[element] > 1
    owner, element = owner[inside], shared[element[inside]]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    for at in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(element, (at, at + width))
        part = np.zeros((len(kept), width), np.float32)
        part[owner[a:b], element[a:b] - at] = 1
        out += part @ part.T
    return out


def _across(coded: DataFrame, percent: int, block: int, block_bytes: int) -> DataFrame:
    """Links (a, b) between components, found on full sets: of each pair of parts a forest
    at most, so fewer rows than members."""
    sizes = coded.groupBy("leader").agg(
        F.count("*").alias("size"), F.sum(F.octet_length("kept") + F.octet_length("extra")).alias("bytes")
    )
    parts = F.ceil(F.greatest(F.col("size") / block, F.col("bytes") / block_bytes))
    dealt = _dealt(coded.join(sizes, "leader"), parts, ["node", "component", "kept", "extra", "n"])

    def run(table: pa.Table) -> pa.Table:
        nodes, inside, ours = _numbered(table)
        n = table.column("n").to_numpy().astype(np.float64)
        common = common_sizes(table.column("kept").to_pylist(), table.column("extra").to_pylist())
        linked = ours & (100.0 * common >= percent * (n[:, None] + n[None, :] - common))
        found = []
        for i in range(len(nodes)):
            near = np.flatnonzero(linked[i])
            for k in near[inside[near] != inside[i]]:
                if inside[k] != inside[i]:  # not by a link found just now
                    found.append((nodes[i], nodes[k]))
                    inside[inside == inside[k]] = inside[i]
        first, second = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(first, pa.binary()), "b": pa.array(second, pa.binary())})

    return dealt.groupBy("leader", "low", "high").applyInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    percent: int = 85,
    bands: int = 32,
    rows: int = 4,
    margin: float = 0.2,
    block: int = 512,
    block_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_shingles, component_id and kept (it is the component's id)."""
    bounded(docs.sparkSession)
    # In a struct, so that null ids join too.
    docs = docs.select(F.struct(F.col(id_col).alias("v")).alias("id"), F.col(text_col).alias("text"))
    profiles = stored(_profiles(docs, words, bands, rows))
    classes = (
        profiles.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("id").alias("least"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
    )
    places = classes.select("node", F.explode("bands").alias("band"))
    buckets = (
        places.groupBy("band")
        .agg(F.min("node").alias("leader"), F.count("*").alias("size"))
        .where("size > 1")
    )
    pairs = stored(
        places.join(buckets, "band")
        .where("node != leader")
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    # One text of each class in a bucket; the others have the same set.
    texts = profiles.join(asked, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"))
    sets = stored(
        _sets(docs.join(texts.select("id").distinct().hint("shuffle_hash"), "id", "left_semi"), words)
        .join(asked, "node", "left_semi")
        .dropDuplicates(["node"])
    )
    inside = components(_checked(pairs, sets, percent))
    placed = (
        pairs.select(F.col("a").alias("leader"), F.col("b").alias("node"))
        .join(inside, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    mixed_up = (
        placed.groupBy("leader")
        .agg(
            F.count("*").alias("size"),
            F.min("component").alias("one"),
            F.max("component").alias("other"),
        )
        .where("one != other")
        .select("leader", "size")
    )
    unsure = placed.join(mixed_up, "leader").join(classes.select("node", "sketch"), "node")
    found = stored(_alike(unsure, percent / 100 - margin, block))
    more = _across(stored(_coded(found, sets)), percent, block, block_bytes)
    # Links to the least node of a component tie together what the links found before do.
    final = components(inside.union(more))
    named = profiles.join(final, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = (
        named.where("node is not null").groupBy("component").agg(F.min("id.v").alias("smallest"))
    )
    alone = F.col("node").isNull()
    return named.join(least, "component", "left").select(
        F.col("id.v").alias(id_col),
        "n_shingles",
        F.when(alone, F.col("id.v")).otherwise(F.col("smallest")).alias("component_id"),
        (alone | F.col("id.v").eqNullSafe(F.col("smallest"))).alias("kept"),
    )


def one_of_each(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents, one of each group: the one with the smallest id.

    Of equal ids with different texts a hash of the text decides, and of rows equal
    in both any one stays. Texts without words all stay, repeated rows too.
    """
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    keyed = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row"))
    found = near_duplicates(
        docs.select(key.alias("key"), F.col(text_col).alias("text")),
        words, percent, id_col="key", text_col="text", **options,
    ).where("kept")
    chosen = found.groupBy("key").agg(F.max("n_shingles").alias("n_shingles"))
    rows = keyed.join(chosen.hint("shuffle_hash"), "key")
    rows = rows.where("n_shingles = 0").union(
        rows.where("n_shingles > 0").dropDuplicates(["key"])
    )
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns))
