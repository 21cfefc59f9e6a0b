"""Packs tokenised examples into sequences, as vector bin packing with cuts.

An example has three sizes: tokens, segments (1) and loss-bearing tokens. A sequence
has a limit on each. Sequences are filled from a bounded pool: of the examples that
fit in every dimension the one with the largest dot product of its sizes and the
room left, both as shares of the limits, goes in. Where none fits, one is cut so that
the tokens come out exactly, and its rest goes back to the pool. Where examples are so
short that the segment limit comes first, and for the last ones of a partition, sequences
are filled to a power of two of tokens, which needs no padding. A sequence that hits the
loss limit first is left short and padded.

Every partition packs for itself, in one pass and without a shuffle; memory is the
pool's. Lost tasks are redone from the same rows in the same order, so give it a table.
Sequence ids are the partition's number times 2^33 plus a count.

Null and empty texts have the end id only. Repeated rows are packed each.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import blobs, bounded, runs

_ID = np.dtype("<u4")


class Encoder:
    """Token ids of words, remembered; the vocabulary drops white space between words.

    Texts are split at ASCII white space. A word not met before is cut by the
    vocabulary's own pattern into pre-tokens, where it is sure that this is what the
    vocabulary does; those are fewer than words, as marks and digits stand alone. Pre-tokens
    not met before are encoded together, and the tokens that end one tell whose each id
    is. The other words are encoded as they are, and offsets tell. The memory is bounded:
    it keeps what was used among the last `size` to twice as many new bytes.
    """

    def __init__(self, path: str, size: int = 64 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        count = self.tokenizer.get_vocab_size()
        tokens = map(self.tokenizer.id_to_token, range(count))
        self.ends = np.array([t is not None and t.endswith("</w>") for t in tokens])
        self.pattern = _split_pattern(json.loads(self.tokenizer.to_str()))
        self.size = size
        self.used = 0
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _parts(self, word: str) -> list[str] | None:
        """The pre-tokens of a word, if its characters leave no doubt about them."""
        if self.pattern is None or "<|" in word or not word.isprintable() or max(word) > _SURE:
            return None
        if _DOTTED in word or "\u03a3" in word or not unicodedata.is_normalized("NFC", word):
            return None
        return self.pattern.findall(word.lower())

    def _learn(self, words: list[bytes], whole: bool) -> None:
        """`whole`: each word is one pre-token, if nothing says otherwise."""
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            texts = [w.decode() for w in part]
            # Each token that ends a pre-token says so, and no word has none. So equal
            # counts prove one for each word.
            if whole:
                code = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)
                ids = np.array(code[0].ids, _ID)
                cut = np.flatnonzero(self.ends[ids]) + 1
                if len(cut) == len(part):
                    self._keep(part, ids, np.append(0, cut))
                    continue
            starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
            code = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            first = np.array([a for a, _ in code.offsets], np.int64)
            owner = np.searchsorted(starts, first, "right") - 1
            cut = np.searchsorted(owner, np.arange(len(part) + 1))
            self._keep(part, np.array(code.ids, _ID), cut)

    def _keep(self, words: list[bytes], ids: np.ndarray, cut: np.ndarray) -> None:
        raw, cut = ids.tobytes(), (4 * cut).tolist()
        self._remember({w: raw[a:b] for w, a, b in zip(words, cut, cut[1:], strict=False)})

    def _remember(self, found: dict[bytes, bytes]) -> None:
        self.young.update(found)
        self.used += len(found) * _ENTRY + sum(map(len, found)) + sum(map(len, found.values()))

    def _recall(self, words: set[bytes]) -> list[bytes]:
        """Those that aren't remembered; the others are made young again."""
        known = {w: self.old[w] for w in words if w in self.old}
        self._remember(known)
        return [w for w in words if w not in known]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if self.used > self.size:
            self.old, self.young, self.used = self.young, {}, 0
        # Lower case would turn other text into special tokens' strings.
        lowered = [t if b"<|" in t else t.lower() for t in texts]
        split = pc.ascii_split_whitespace(pa.array(lowered, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        found = list(map(self.young.get, words))
        if None in found:
            self._meet({w for w, ids in zip(words, found, strict=True) if ids is None})
            found = list(map(self.young.get, words))
        ids = np.frombuffer(b"".join(found), _ID)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(sizes) - sizes
        # Each word's ids, in the order of the texts.
        word = coded.indices.to_numpy()
        ends = np.cumsum(sizes[word])
        at = np.repeat(first[word] - ends + sizes[word], sizes[word])
        ids = ids[at + np.arange(len(at))].tobytes()
        cuts = (4 * np.append(0, ends)[split.offsets.to_numpy()]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _meet(self, words: set[bytes]) -> None:
        """Remembers words that aren't young."""
        letters, cut, odd = [], {}, []
        if b"" in words:
            self._remember({b"": b""})
        for word in self._recall(words - {b""}):
            text = word.decode()
            if text.isalpha():
                letters.append(word)
                continue
            stem = text.rstrip(_MARKS)
            if stem.isalpha() and _DOTTED not in stem:  # a run of marks is one pre-token
                head = stem.encode()
                cut[word] = [head, word[len(head) :]]
            elif (parts := self._parts(text)) is not None:
                cut[word] = [p.encode() for p in parts]
            else:
                odd.append(word)
        pieces = set().union(*cut.values()).difference(self.young, letters)
        self._learn(letters + self._recall(pieces), True)
        self._learn(odd, False)
        get = self.young.__getitem__
        self._remember({word: b"".join(map(get, parts)) for word, parts in cut.items()})


#: Its lower case has a mark in it.
_DOTTED = "\u0130"

#: Marks that no word has within it.
_MARKS = ".,;:!?#$%&*+=|()[]{}/\\\"~^@_`-"

#: Bytes that an entry takes beside its contents.
_ENTRY = 180

#: Up to here, what is a letter, a digit or a mark has long been settled.
_SURE = "\u058f"


def _split_pattern(vocabulary: dict) -> regex.Pattern | None:
    """The pattern whose matches are a vocabulary's pre-tokens, if it has such a one."""
    steps = (vocabulary.get("pre_tokenizer") or {}).get("pretokenizers") or []
    for step in steps[:1]:
        if step["type"] == "Split" and step["behavior"] == "Removed" and step["invert"]:
            return regex.compile(step["pattern"]["Regex"])
    return None


@functools.lru_cache(1)
def encoder_of(path: str, memory: int) -> Encoder:
    """One for each worker process, so that tasks after the first start with its memory."""
    return Encoder(path, memory)


class Packer:
    """Takes examples, gives pieces; see the module's text."""

    def __init__(self, limits: tuple[int, int, int], pool: int, first_id: int):
        self.limits = np.array(limits, float)
        self.max_pool = pool
        self.sequence = first_id
        self.pool: list[list] = []  # [key, ids, start, loss prefix or None]
        self.tokens = 0

    def add(self, key, ids: bytes, loss: bytes | None = None) -> Iterator[tuple]:
        """`loss`: a byte for each token, 1 if it bears loss; None if all do.

        Sequences are filled once the pool has many examples, and tokens for several.
        """
        self.pool.append([key, ids, 0, loss])
        self.tokens += len(ids) // 4
        size = int(self.limits[0])
        if len(self.pool) >= self.max_pool and self.tokens >= 8 * size:
            while len(self.pool) > self.max_pool // 2 and self.tokens >= 4 * size:
                yield from self._fill(self._target())

    def finish(self) -> Iterator[tuple]:
        while self.tokens > 0:
            yield from self._fill(self._target())

    def _target(self) -> int:
        """The most tokens that the segments allow, a power of two if that isn't all."""
        tokens = np.array([len(x[1]) // 4 - x[2] for x in self.pool])
        most = int(self.limits[1])
        if len(tokens) > most:
            tokens = np.partition(tokens, len(tokens) - most)[-most:]
        total, size = int(tokens.sum()), int(self.limits[0])
        return size if total >= size else 1 << (total.bit_length() - 1)

    def _sizes(self) -> np.ndarray:
        rows = []
        for _, ids, start, loss in self.pool:
            tokens = len(ids) // 4 - start
            rows.append((tokens, 1, tokens if loss is None else sum(loss[start:])))
        return np.array(rows, float)

    def _fill(self, tokens: int) -> Iterator[tuple]:
        room = np.minimum(self.limits, [tokens, self.limits[1], self.limits[2]])
        sizes, scale = self._sizes(), 1 / self.limits
        taken = np.zeros(len(sizes), bool)
        pieces, offset = [], 0
        while room[0] >= 1 and room[1] >= 1 and not taken.all():
            fits = ~taken & (sizes <= room).all(axis=1)
            if room[1] == 1:  # the last segment has to fill the rest
                fits &= sizes[:, 0] == room[0]
            weight = (sizes * scale) @ (room * scale)
            if fits.any():
                i = int(np.argmax(np.where(fits, weight, -1.0)))
                length = int(sizes[i, 0])
            else:
                i = int(np.argmax(np.where(taken, -1.0, weight)))
                length = self._cut(self.pool[i], int(min(room[0], sizes[i, 0])), int(room[2]))
                if length < 1:
                    break
            key, ids, start, loss = self.pool[i]
            part = ids[4 * start : 4 * (start + length)]
            pieces.append((key, start, length, zlib.crc32(part), len(ids) // 4, offset))
            bears = length if loss is None else sum(loss[start : start + length])
            offset += length
            self.tokens -= length
            room -= (length, 1, bears)
            if length == sizes[i, 0]:
                taken[i] = True
            else:
                self.pool[i][2] += length
                sizes[i, 0] -= length
                sizes[i, 2] -= bears
        if not pieces:
            raise ValueError("an example can't meet the limits")
        self.pool = [x for x, gone in zip(self.pool, taken, strict=True) if not gone]
        for key, start, length, crc, total, at in pieces:
            yield key, start, length, crc, total, self.sequence, at
        self.sequence += 1

    @staticmethod
    def _cut(item: list, most: int, loss_room: int) -> int:
        _, _, start, loss = item
        if loss is None:
            return min(most, loss_room)
        bears = np.cumsum(np.frombuffer(loss[start : start + most], np.uint8))
        return int(np.searchsorted(bears, loss_room, "right"))


_PIECES = (
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int = 4096,
    max_segments: int = 256,
    max_loss: int | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_pattern: str | None = None,
    pool: int = 256,
    memory: int = 64 << 20,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `tokenizer` is the vocabulary file's path, the same on every machine. With
    `loss_pattern`, only tokens of parts of the text that match bear loss (and the
    end id); parts are tokenised apart then. `max_loss` defaults to `max_tokens`. A worker
    remembers words for `memory` bytes to twice as many.
    """
    bounded(docs.sparkSession)
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end = np.array([end_id], _ID).tobytes()
    pattern = re.compile(loss_pattern.encode()) if loss_pattern else None

    def coded(encoder: Encoder, texts: list[bytes]) -> Iterator[tuple[bytes, bytes | None]]:
        if pattern is None:
            for ids in encoder.encode(texts):
                yield ids + end, None
            return
        for text in texts:
            parts, flags, at = [], [], 0
            for m in pattern.finditer(text):
                parts += [text[at : m.start()], m.group()]
                flags += [0, 1]
                at = m.end()
            parts.append(text[at:])
            flags.append(0)
            ids = encoder.encode(parts)
            loss = b"".join(bytes([f]) * (len(x) // 4) for f, x in zip(flags, ids, strict=True))
            yield b"".join(ids) + end, loss + b"\x01"

    def batch_of(keys: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
        ids, *rest = zip(*rows, strict=True)
        arrays = [pa.array(ids, keys)]
        arrays += [pa.array(v, t) for v, (_, t) in zip(rest, _PIECES, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", *(n for n, _ in _PIECES)])

    def run(batches):
        encoder = encoder_of(tokenizer, memory)
        packer = Packer(limits, pool, TaskContext.get().partitionId() << 33)
        out, keys = [], None
        for batch in runs(batches, "text", max(1 << 20, memory >> 4)):
            keys = batch.column("id").type
            for key, (ids, loss) in zip(
                batch.column("id").to_pylist(),
                coded(encoder, blobs(batch.column("text"))),
                strict=True,
            ):
                out.extend(packer.add(key, ids, loss))
            if len(out) >= 5000:
                yield batch_of(keys, out)
                out = []
        out.extend(packer.finish())
        if out:
            yield batch_of(keys, out)

    schema = f"id {kind}, " + ", ".join(f"{n} long" for n, _ in _PIECES)
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
