"""Byte-level BPE by merge replay with an inverted index, and decoding.

Texts are cut by the tokenizer's pattern; each part of the corpus that a task reads is reduced to its distinct words. An inverted
index leads from a token pair (by the rank of its union) to the word positions where the pair stands. Merges are applied in rank
order, each word taking its lowest rank at all its positions at once, and only the two touched neighbours of a position are
looked up again. Words already replayed stay in a bounded cache of the worker, so that a part replays what it adds.

The words of a part, not of the whole corpus, share an index: merges in one word don't depend on other words, so that ids are the
same, and neither texts nor words are shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.llm.memory import release

#: Words that a worker remembers; beyond that it forgets all and goes on.
CACHE_WORDS = 200_000
#: Characters of text whose new words are replayed together.
PART_CHARS = 2 << 20
#: Positions that are looked up together.
CHUNK = 1 << 18
#: Bytes of new words that are replayed together.
BLOCK_BYTES = 1 << 20
#: Ranks that share an entry of the index; each word still takes its merges one rank after the other.
RANGE = 1024
SLOT_BITS = 20


def load_ranks(spark, path: str) -> bytes:
    """The vocabulary file, a few hundred kB. A path with a scheme is read through Spark, from any store it knows; a plain path is
    a file of the driver's machine, read there and sent along with the tasks."""
    if ":" not in path:
        with open(path, "rb") as f:
            return f.read()
    return spark.read.format("binaryFile").load(path).select("content").first()["content"]


class Vocabulary:
    """Ranks, the table of token pairs with a union, and the words replayed so far."""

    def __init__(self, content: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        top = max(self.rank.values()) + 1
        pairs = array("q")
        for t, r in self.rank.items():
            for i in range(1, len(t)):
                if (a := self.rank.get(t[:i])) is not None and (b := self.rank.get(t[i:])) is not None:
                    pairs.extend((a << 32 | b, r))
        table = np.frombuffer(pairs, np.int64).reshape(-1, 2)
        table = table[np.argsort(table[:, 0], kind="stable")]
        # a hash table of pairs; those whose slot another one has are looked up in a sorted list
        self.slot, self.union = np.full(1 << SLOT_BITS, -1, np.int64), np.full(1 << SLOT_BITS, -1, np.int32)
        _, first = np.unique(self._slot_of(table[:, 0]), return_index=True)
        self.slot[self._slot_of(table[first, 0])], self.union[self._slot_of(table[first, 0])] = table[first].T
        more = np.delete(table, first, axis=0)
        self.shared = np.zeros(1 << SLOT_BITS, bool)
        self.shared[self._slot_of(more[:, 0])] = True
        self.more, self.more_union = np.append(more[:, 0], np.iinfo(np.int64).max), np.append(more[:, 1], -1)
        # of the pairs that a token is part of, the least rank: is it lower than the token's, its merges go one by one
        self.least = np.full(top, np.iinfo(np.int64).max)
        np.minimum.at(self.least, table[:, 0] >> 32, table[:, 1])
        np.minimum.at(self.least, table[:, 0] & 0xFFFFFFFF, table[:, 1])
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, int] = _Numbered()
        self.packed: list[bytes] = []

    @staticmethod
    def _slot_of(pairs: np.ndarray) -> np.ndarray:
        return (pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).view(np.int64)

    def unions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the union of each two tokens, -1 where there is none."""
        pair = np.asarray(a, np.int64) << 32 | b
        slot = self._slot_of(pair)
        same = self.slot[slot] == pair
        out = np.where(same, self.union[slot], -1)
        again = np.flatnonzero(self.shared[slot] & ~same)
        if len(again):
            at = np.searchsorted(self.more, pair[again])
            out[again] = np.where(self.more[at] == pair[again], self.more_union[at], -1)
        return out

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word, all words at once; words are not empty."""
        out = [b"" if (r := self.rank.get(w)) is None else r.to_bytes(4, "little") for w in words]
        todo = [i for i, x in enumerate(out) if not x]
        if not todo:
            return out
        data = np.frombuffer(b"".join([words[i] for i in todo]), np.uint8)
        starts = np.cumsum([0, *(len(words[i]) for i in todo)])
        tok, n = self.byte[data].astype(np.int32), len(data)
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[starts[1:] - 1] = prv[starts[:-1]] = -1
        word = np.repeat(np.arange(len(todo), dtype=np.int32), np.diff(starts))

        index: dict[int, list[np.ndarray]] = {}
        ranges: list[int] = []

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            """Positions enter the index under the range of their pair's rank."""
            at, ranks = at[ranks >= 0], ranks[ranks >= 0] // RANGE
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            first = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else []
            for x, some in zip(ranks[first].tolist() if len(ranks) else [], np.split(at, first[1:]) if len(ranks) else [], strict=True):
                if x not in index:
                    index[x] = []
                    heapq.heappush(ranges, x)
                index[x].append(some)

        rank = np.full(n, -1, np.int32)  # of the pair that begins at each position

        def look_up(at: np.ndarray) -> None:
            right = nxt[at]
            rank[at] = np.where(right >= 0, self.unions(tok[at], tok[right]), -1)
            enter(at, rank[at])

        for x in range(0, n, CHUNK):
            look_up(np.arange(x, min(n, x + CHUNK), dtype=np.int32))
        while ranges:
            now = heapq.heappop(ranges)
            at = np.sort(np.concatenate(index.pop(now)))
            at = at[np.append(True, at[1:] != at[:-1])]
            ranks = rank[at]
            here = ranks // RANGE == now  # others were changed by a merge beside them, and entered anew where that made a pair
            at, ranks = at[here], ranks[here]
            if not len(at):
                continue
            # each word takes its lowest rank; its others of this range wait
            first = np.flatnonzero(np.append(True, word[at[1:]] != word[at[:-1]]))
            lowest = ranks == np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, len(at))))
            wait, wait_ranks = at[~lowest], ranks[~lowest]
            at, ranks = at[lowest], ranks[lowest]
            right = nxt[at]
            # of pairs that overlap in a row, every other one
            i = np.arange(len(at))
            alone = (i - np.maximum.accumulate(np.where(np.append(True, right[:-1] != at[1:]), i, 0))) % 2 == 0
            if (self.least[ranks] < ranks).any():
                # where a merge makes a pair of lower rank, that one goes before the word's other merges of this rank
                x, y, r = at[alone], right[alone], ranks[alone]
                near = np.stack((np.where(nxt[y] >= 0, self.unions(r, tok[nxt[y]]), -1), np.where(prv[x] >= 0, self.unions(tok[prv[x]], r), -1), self.unions(r, r)))
                low = ((near >= 0) & (near < r)).any(0)
                leads = np.append(True, word[at[1:]] != word[at[:-1]])
                later = np.isin(word[at], word[x[low]]) & ~leads
                wait, wait_ranks = np.concatenate((wait, at[later])), np.concatenate((wait_ranks, ranks[later]))
                alone &= ~later
            enter(wait, wait_ranks)
            at, right, ranks = at[alone], right[alone], ranks[alone]
            after, before = nxt[right], prv[at]
            tok[at], tok[right], nxt[at], rank[right] = ranks, -1, after, -1
            prv[after[after >= 0]] = at[after >= 0]
            # only the two touched neighbours; one that was merged in the same step has its start at that of its left part
            touched = np.concatenate((at, before[before >= 0]))
            look_up(np.where(tok[touched] >= 0, touched, prv[touched]))
        left = tok >= 0
        ends = np.concatenate(([0], np.cumsum(left)))[starts] * 4
        packed = tok[left].astype("<u4").tobytes()
        for i, a, b in zip(todo, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = packed[a:b]
        return out

    def learn(self) -> None:
        """Replay the words numbered since the last time, in blocks of bounded size."""
        words = [w.encode() for w in islice(self.ids, len(self.packed), None)]
        sizes = np.cumsum([len(w) for w in words]) // BLOCK_BYTES if words else np.zeros(0, int)
        for k in range(int(sizes[-1]) + 1 if words else 0):
            a, b = np.searchsorted(sizes, [k, k + 1])
            self.packed += self.replay(words[a:b])


class _Numbered(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _gathered(flat: np.ndarray, offset: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The stretches flat[offset[i] : offset[i + 1]] of all items, one after the other."""
    start = offset[items]
    size = offset[items + 1] - start
    end = np.cumsum(size)
    return flat[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


@lru_cache(2)
def token_bytes(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens by rank, and their offsets."""
    token = {int(b): base64.b64decode(a) for a, b in (line.split() for line in content.splitlines() if line)}
    listed = [token.get(i, b"") for i in range(max(token) + 1)]
    return np.frombuffer(b"".join(listed), np.uint8), np.cumsum([0, *map(len, listed)])


@lru_cache(2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def encoded(texts: Iterable[str | None], content: bytes, pattern: regex.Pattern) -> Iterator[bytes]:
    """The ids of each text in turn, as little-endian unsigned 32-bit integers; a part of the texts is held at a time."""
    v = vocabulary(content)
    part: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[bytes]:
        v.learn()
        flat, offset = np.frombuffer(b"".join(v.packed), "<u4"), np.cumsum([0, *map(len, v.packed)]) // 4
        for words in part:
            pieces = [_gathered(flat, offset, words[i : i + CHUNK]).tobytes() for i in range(0, len(words), CHUNK)]
            yield pieces[0] if len(pieces) == 1 else b"".join(pieces)
        if len(v.packed) > CACHE_WORDS:
            v.forget()

    for t in texts:
        words = pattern.findall(t or "")
        part.append(np.fromiter(map(v.ids.__getitem__, words), np.int32, len(words)))
        size += len(t or "")
        if size >= PART_CHARS:
            yield from flush()
            part, size = [], 0
    yield from flush()


def encode_column(text: Column, content: bytes, pattern: str) -> Column:
    """Ids of each text as little-endian unsigned 32-bit integers; null is taken as empty."""
    cut_words = regex.compile(pattern)

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        out = list(encoded(texts, content, cut_words))
        release()
        return pd.Series(out, dtype=object)

    return encode(text)


def decode_column(ids: Column, content: bytes) -> Column:
    """The bytes that the ids stand for; none for null."""

    @F.pandas_udf("binary")
    def decode(series: pd.Series) -> pd.Series:
        flat, offset = token_bytes(content)
        rows = (np.frombuffer(x or b"", "<u4").astype(np.int64) for x in series)
        return pd.Series([b"".join(_gathered(flat, offset, x[i : i + CHUNK]).tobytes() for i in range(0, len(x), CHUNK)) for x in rows], dtype=object)

    return decode(ids)


def encode_documents(docs: DataFrame, content: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (binary, little-endian uint32) and n_tokens; columns of these names are replaced.

    A null or empty text has no ids. Rows are encoded one by one, so ties and repeated rows agree.
    """
    kept = docs.drop("ids", "n_tokens")
    return kept.withColumn("ids", encode_column(F.col(text), content, pattern)).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def round_trip(docs: DataFrame, content: bytes, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them. Ids and bytes of a text are hashed where they
    are made, and only digests leave the worker."""
    cut_words = regex.compile(pattern)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offset = token_bytes(content)
            n, ids, back = [], [], []
            for x in encoded((t.as_py() for t in b.column(1)), content, cut_words):
                listed, decoded = np.frombuffer(x, "<u4").astype(np.int64), hashlib.sha256()
                for i in range(0, len(listed), CHUNK):
                    decoded.update(_gathered(flat, offset, listed[i : i + CHUNK]).tobytes())
                n.append(len(listed))
                ids.append(hashlib.sha256(x).hexdigest())
                back.append(decoded.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        vocabulary(content).forget()  # the worker lives on beside other stages
        release()

    return docs.select("doc_id", "text").mapInArrow(digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
