"""Packing of documents into windows of tokens by non-negative least squares.

Each document's ids are cut into full windows and a rest. The rests' histogram by length is approximated by non-negative counts
of shallow combinations (up to DEPTH lengths that fill a window exactly), by coordinate descent on the squares; the counts are
rounded to what the histogram holds. A piece finds its place from its rank among the pieces of its length alone: ranks
are dealt to the combinations in stretches. Pieces beyond all stretches form one stream, longest first, packed greedily: a
window takes what comes next and cuts the piece that crosses its end. The stream's last window ends in sequences of powers of
two, so that nothing is padded.

Histogram and combinations have a fixed size (WINDOW lengths, some WINDOW squared / 12 combinations), whatever the input.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from taxaloom.operators.numbering import numbered
from taxaloom.session import cut

WINDOW = 1024
DEPTH = 3
#: Sweeps of the descent, at most; the share of the histogram below which a sweep's change ends it.
SWEEPS, LEAST_CHANGE = 25, 1e-3
#: Id that ends a document.
END = 0
#: UTF-8 bytes of texts that are cut into words together.
PART_BYTES = 16 << 20
#: Words encoded in one call; ids gathered in one step.
CALL_WORDS, GATHER = 4096, 1 << 20
#: Cut pieces up to which they are broadcast to their ids.
BROADCAST_ROWS = 50_000
#: Where white space stands before a space, a text isn't cut at its spaces.
ODD_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


def _alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 ones themselves, others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids of texts as ``tokenizers`` gives them, each followed by END.

    Texts are cut before their spaces, where tokens of such a vocabulary always begin. The distinct words of a part are encoded
    together by tiktoken with the ranks of the same file, and looked up for each text. Where that isn't sure to agree, the
    text goes whole to ``tokenizers``: white space before a space, added tokens, merges not in the order of their ids.
    """

    def __init__(self, content: bytes):
        self.whole = Tokenizer.from_str(content.decode())
        said, byte = json.loads(content), _alphabet()
        vocab, self.added = said["model"]["vocab"], [t["content"] for t in said.get("added_tokens") or []]
        rank = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.added}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in said["model"]["merges"]]
        plain = said["normalizer"] is None and all(bytes([b]) in rank for b in range(256))
        self.quick = None
        if plain and made == sorted(set(made)):
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.quick = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=rank, special_tokens={})
            self.size = np.zeros(max(rank.values()) + 1, np.int64)
            self.size[list(rank.values())] = [len(t) for t in rank]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, a space before each, one after the other, and where each word's begin."""
        ends = pc.binary_length(words.cast("binary")).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        listed, ids, counts = words.to_pylist(), [], []
        for i in range(0, len(listed), CALL_WORDS):
            found = np.array(self.quick.encode_ordinary(" " + " ".join(listed[i : i + CALL_WORDS])), np.uint32)
            bounds = np.searchsorted(np.cumsum(self.size[found]), np.cumsum(ends[i : i + CALL_WORDS])) + 1
            ids.append(found)
            counts.append(np.diff(bounds, prepend=0))
        return np.concatenate(ids or [np.zeros(0, np.uint32)]), np.cumsum(np.concatenate([[0], *counts])).astype(np.int64)

    def part(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; texts without nulls."""
        odd = np.ones(len(texts), bool)
        if self.quick:
            odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
            for t in self.added:
                odd = odd | pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        whole = iter([e.ids for e in self.whole.encode_batch_fast(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)]) if odd.any() else iter(())
        if not odd.all():
            lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
            words, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
            at = at - at[0]
            coded = words.dictionary_encode()
            code, listed = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            empty = pc.equal(listed, "").to_numpy(zero_copy_only=False)
            ids, begin = self._words(listed.filter(pa.array(~empty)))
            # an empty word is a space alone; the first word of a text has no space before it
            place = np.cumsum(~empty) - 1
            alone = np.array(self.quick.encode_ordinary(" "), np.uint32)
            table = np.concatenate([ids, alone])
            start = np.where(empty, len(ids), begin[np.maximum(place, 0)])
            count = np.where(empty, len(alone), begin[np.minimum(np.maximum(place, 0) + 1, len(begin) - 1)] - begin[np.maximum(place, 0)])
            first = [np.array(self.quick.encode_ordinary(w), np.uint32) for w in words.take(pa.array(at[:-1])).to_pylist()]
        k = 0
        for is_odd in odd:
            if is_odd:
                yield np.array([*next(whole), END], np.uint32)
                continue
            rest, pieces = code[at[k] + 1 : at[k + 1]], [first[k]]
            for i in range(0, len(rest), GATHER):
                n = count[rest[i : i + GATHER]]
                last = np.cumsum(n)
                pieces.append(table[np.repeat(start[rest[i : i + GATHER]] - (last - n), n) + np.arange(last[-1])])
            yield np.concatenate([*pieces, np.array([END], np.uint32)])
            k += 1


@lru_cache(1)
def encoder(content: bytes) -> Encoder:
    return Encoder(content)


def cut_into_pieces(docs: DataFrame, content: bytes, keep_all: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32 and ids (binary, little-endian uint32) of each document's full windows and its rest,
    and uid, a row's own number. Full windows are never cut again; without ``keep_all`` their ids are null."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(content)
        for b in batches:
            ids_of, texts = b.column(0), pc.fill_null(b.column(1).cast("large_string"), "")
            part = np.cumsum(pc.binary_length(texts.cast("large_binary")).to_numpy(zero_copy_only=False)) // PART_BYTES
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=part[-1] + 1 if len(part) else 0)) if len(part) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True) if len(part) else ():
                row, start, length, whole, crc, ids = [], [], [], [], [], []
                for i, x in enumerate(e.part(texts.slice(lo, hi - lo))):
                    data = x.astype("<u4").tobytes()
                    for a in range(0, len(x), WINDOW):
                        one = data[4 * a : 4 * (a + WINDOW)]
                        row.append(lo + i)
                        start.append(a)
                        length.append(len(one) // 4)
                        whole.append(len(x))
                        crc.append(zlib.crc32(one))
                        ids.append(one if keep_all or len(one) < 4 * WINDOW else None)
                yield pa.RecordBatch.from_arrays([ids_of.take(pa.array(row, pa.int64())), *[pa.array(c, pa.int64()) for c in (start, length, whole, crc)], pa.array(ids, pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long, ids binary")
    return found.withColumn("uid", F.monotonically_increasing_id())


def combinations(present: np.ndarray) -> list[tuple[int, ...]]:
    """All of two or three of the lengths present (flags by length) that fill a window, shortest lists and longest pieces first."""
    some, out = np.flatnonzero(present[:WINDOW]), []
    some = some[some > 0]
    out += [(int(a), int(WINDOW - a)) for a in some[some <= WINDOW // 2] if present[WINDOW - a]]
    for a in some[some <= WINDOW // DEPTH] if DEPTH > 2 else []:
        b = some[(some >= a) & (some <= (WINDOW - a) // 2)]
        out += [(int(a), int(x), int(WINDOW - a - x)) for x in b if present[WINDOW - a - x]]
    return sorted(out, key=lambda c: (len(c), -c[-1], c))


def least_squares(counts: np.ndarray, columns: list[tuple[int, ...]]) -> np.ndarray:
    """Repeats of each column, none negative, whose pieces come nearest the counts by length: coordinate descent from zero, each
    column set in turn to where the squares are least. It leaves most columns at zero."""
    x, left = [0.0] * len(columns), counts.astype(float).tolist()
    total = float(counts.sum()) or 1.0
    norm = [sum(c.count(v) ** 2 for v in set(c)) for c in columns]
    for _ in range(SWEEPS):
        moved = 0.0
        for j, c in enumerate(columns):
            step = sum([left[v] for v in c]) / norm[j]
            if step <= 0 and x[j] == 0:
                continue
            step = max(step, -x[j])
            x[j] += step
            for v in c:
                left[v] -= step
            moved += abs(step)
        if moved < LEAST_CHANGE * total:
            break
    return np.array(x)


def repeats(counts: np.ndarray, columns: list[tuple[int, ...]], x: np.ndarray) -> np.ndarray:
    """Whole repeats within the counts: the largest are rounded first, then all are raised while their pieces last."""
    left, out = counts.astype(np.int64).tolist(), np.zeros(len(columns), np.int64)
    for want in (np.round(x).astype(np.int64).tolist(), None):
        for j in np.argsort(-x, kind="stable").tolist():
            c = columns[j]
            most = min(left[v] // c.count(v) for v in c)
            n = most if want is None else min(most, want[j])
            if n > 0:
                out[j] += n
                for v in c:
                    left[v] -= n
    return out


class Layout:
    """Where the piece of a length and a rank lies."""

    def __init__(self, counts: np.ndarray):
        columns = combinations(counts > 0)
        times = repeats(counts, columns, least_squares(counts, columns))
        used = [((WINDOW,), int(counts[WINDOW]))] + [(columns[j], int(times[j])) for j in np.flatnonzero(times)]
        dealt, self.sequences = np.zeros(WINDOW + 1, np.int64), 0
        rows = []
        for c, n in used:
            offset = 0
            for v in c:
                rows.append((v, dealt[v], n, self.sequences, offset))
                dealt[v] += n
                offset += v
            self.sequences += n
        rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.key, self.n, self.first, self.offset = rows[:, 0] << 48 | rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4]
        self.dealt = dealt
        lengths = np.arange(WINDOW + 1)
        over = (counts - dealt) * lengths
        self.base = np.cumsum(over[::-1])[::-1] - over  # longer pieces come before
        self.stream = int(over.sum())
        rest = self.stream % WINDOW
        parts = [1 << b for b in range(WINDOW.bit_length() - 1, -1, -1) if rest >> b & 1]
        self.tail = self.stream - rest + np.cumsum([0, *parts])  # where the last window's sequences begin, and the end
        self.share = 1 - self.stream / max(1, int((counts * lengths).sum()))

    def parts(self, length: np.ndarray, rank: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """(from, length, sequence, offset) of each part of each piece."""
        at = np.searchsorted(self.key, length << 48 | rank, "right") - 1
        within = rank - (self.key[at] & ((1 << 48) - 1)) if len(self.key) else rank
        fixed = rank < self.dealt[length]
        out = []
        for v, r, i, w, f in zip(length.tolist(), rank.tolist(), at.tolist(), within.tolist(), fixed.tolist(), strict=True):
            if f:
                out.append([(0, v, int(self.first[i] + w), int(self.offset[i]))])
                continue
            begin = int(self.base[v]) + (r - int(self.dealt[v])) * v
            end, here, own = begin + v, begin, []
            while here < end:
                if here < self.tail[0]:
                    k, opens = here // WINDOW, here // WINDOW * WINDOW
                    closes = opens + WINDOW
                else:
                    j = int(np.searchsorted(self.tail, here, "right")) - 1
                    k, opens, closes = self.tail[0] // WINDOW + j, self.tail[j], self.tail[j + 1]
                until = min(end, int(closes))
                own.append((here - begin, until - here, int(self.sequences + k), int(here - opens)))
                here = until
            out.append(own)
        return out


PARTS = "array<struct<part_from: long, part: long, sequence_id: long, offset: long>>"


def layout(pieces: DataFrame) -> Layout:
    """The layout for a table of pieces, from its histogram by length."""
    counts = np.zeros(WINDOW + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most WINDOW rows
        counts[r["length"]] = r["count"]
    return Layout(counts)


def place(pieces: DataFrame) -> DataFrame:
    """uid, doc_id, start, length, doc_tokens, ids_crc32 and parts (where each part of the piece lies) of every piece."""
    found = layout(pieces)

    @F.pandas_udf(PARTS)
    def parts(length: pd.Series, rank: pd.Series) -> pd.Series:
        names = ("part_from", "part", "sequence_id", "offset")
        return pd.Series([[dict(zip(names, p, strict=True)) for p in own] for own in found.parts(length.to_numpy(np.int64), rank.to_numpy(np.int64))], dtype=object)

    ranked = numbered(pieces.drop("ids"), ["length"], ["uid"], "rank")
    return ranked.withColumn("parts", parts("length", "rank")).drop("rank")


def pack(docs: DataFrame, content: bytes) -> tuple[DataFrame, DataFrame]:
    """The parts (uid, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) and the pieces that they are cut from.

    A null text is empty: its one id is END. Repeated rows are documents of their own. Very long texts are as many windows as
    they fill. Other columns are left out, so their names can't clash. An empty table gives no part.
    """
    pieces = cut(cut_into_pieces(docs, content))
    placed = cut(place(pieces))
    one = F.size("parts") == 1
    p = F.col("parts")[0]
    columns = ["uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = placed.where(one).select("uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"))
    several = placed.where(~one).select("uid", "doc_id", "start", "doc_tokens", "parts")

    @F.pandas_udf("long")
    def crc(ids: pd.Series, start: pd.Series, length: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(x[4 * a : 4 * (a + n)]) for x, a, n in zip(ids, start, length, strict=True)], dtype="int64")

    near = F.broadcast(several) if several.count() <= BROADCAST_ROWS else several
    again = pieces.select("uid", "ids").join(near, "uid").select("uid", "ids", "doc_id", "start", "doc_tokens", F.inline("parts"))
    again = again.select("uid", "doc_id", (F.col("start") + F.col("part_from")).alias("start"), F.col("part").alias("length"), crc("ids", "part_from", "part").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return whole.select(*columns).unionByName(again), pieces


def sequences(docs: DataFrame, content: bytes) -> DataFrame:
    """sequence_id, ids (binary, little-endian uint32) and documents (array of doc_id, start, length in order) of each packed sequence."""
    pieces = cut(cut_into_pieces(docs, content, keep_all=True))
    parts = place(pieces).select("uid", "doc_id", "start", F.inline("parts"))
    own = pieces.select("uid", "ids").join(parts, "uid")
    data = F.substring("ids", (F.col("part_from") * 4 + 1).cast("int"), (F.col("part") * 4).cast("int"))
    one = F.struct("offset", data.alias("ids"), "doc_id", (F.col("start") + F.col("part_from")).alias("start"), F.col("part").alias("length"))
    grouped = own.groupBy("sequence_id").agg(F.array_sort(F.collect_list(one)).alias("p"))
    document = F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length")))
    return grouped.select("sequence_id", F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"), document.alias("documents"))


def digest(docs: DataFrame, content: bytes) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every part."""
    return pack(docs, content)[0].drop("uid")
