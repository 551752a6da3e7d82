"""Spelling variants by permuterm rotations.

A word is marked with a terminator and rotated to begin at each of its places. A rotation without its last character is a range
of rotations that differ in that character alone: words that have it replaced, and, where the range itself is a whole rotation,
the word that lacks it. Rotations are sorted over the cluster, and each range is scanned once: a word's neighbours in it are
counted, and the most frequent of them named. No pair is written down; a range holds at most one word for each letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from taxaloom.llm import oracle
from taxaloom.operators.numbering import numbered
from taxaloom.session import cut

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One in so many runs of a document, by check sum, loses a letter.
NOISE = 31
#: A form is at least so many times as frequent.
RATIO = 10
TERMINATOR = "$"
#: Code points up to which a rotation is written out; longer ones are told apart by two polynomial sums of 61 bits.
LONGEST_KEY = 200
PRIMES, BASES = ((1 << 61) - 1, (1 << 61) - 31), (1_000_003, 998_244_353)
#: Different words that a task holds before it passes their counts on.
HELD_WORDS = 200_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def occurrences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, n: runs of at least LEAST_LENGTH letters, A-Z lower-cased, one in NOISE of a document's different runs without one letter,
    counted by task. A null text has none; a null doc_id counts as an empty one."""
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")  # greedy from the left, so each match is a maximal run

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for b in batches:
            for one, t in zip(b["doc_id"], b["text"], strict=True):
                prefix = zlib.crc32(f"{one or ''}:".encode())
                for run, n in Counter(runs.findall(t or "")).items():
                    low = run.translate(_LOWER)
                    h = zlib.crc32(low.encode(), prefix)
                    if h % NOISE == 0:
                        at = h % len(low)
                        low = low[:at] + low[at + 1 :]
                        if len(low) < LEAST_LENGTH:
                            continue
                    total[low] += n
                if len(total) > HELD_WORDS:
                    yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                    total.clear()
        yield pd.DataFrame({"word": list(total), "n": list(total.values())}, columns=["word", "n"]).astype({"word": object, "n": "int64"})

    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInPandas(count, "word string, n long")


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, n of the words that occur at least LEAST_COUNT times."""
    return occurrences(docs, text, doc_id).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class _Sums:
    """Names of the rotations of a long marked word, each in constant time from sums over its prefixes."""

    def __init__(self, marked: str):
        codes = [ord(c) + 1 for c in marked] * 2
        self.sums, self.powers = [], []
        for p, b in zip(PRIMES, BASES, strict=True):
            s, w = [0], [1]
            for c in codes:
                s.append((s[-1] * b + c) % p)
                w.append(w[-1] * b % p)
            self.sums.append(s)
            self.powers.append(w)

    def name(self, at: int, length: int) -> str:
        both = [(s[at + length] - s[at] * w[length]) % p for p, s, w in zip(PRIMES, self.sums, self.powers, strict=True)]
        return f"{length}:{both[0]:x}:{both[1]:x}"


def rotations(words: DataFrame) -> DataFrame:
    """key, id, n, whole, first of (id, word, n): each whole rotation, and each without its last character (a place at which the
    word may be changed).

    first: that character differs from the one before it. A word that lacks it lacks any one of its run of equal characters,
    and is met at the first. Rows carry no words, so that a word of any length has as many rows of bounded size.
    """

    def rotate(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = []
            for own, word, n in zip(b["id"], b["word"], b["n"], strict=True):
                marked = word + TERMINATOR
                size, twice = len(marked), marked * 2
                sums = _Sums(marked) if size > LONGEST_KEY else None
                name = lambda at, length, sums=sums, twice=twice: twice[at : at + length] if length <= LONGEST_KEY else sums.name(at, length)
                for at in range(size):
                    rows.append((name(at, size), own, n, True, False))
                    if at < size - 1:
                        rows.append((name(at + 1, size - 1), own, n, False, at == 0 or word[at] != word[at - 1]))
                    if len(rows) > 50_000:
                        yield pd.DataFrame(rows, columns=["key", "id", "n", "whole", "first"])
                        rows = []
            yield pd.DataFrame(rows, columns=["key", "id", "n", "whole", "first"]).astype({"id": "int64", "n": "int64", "whole": bool, "first": bool})

    return words.select("id", "word", "n").mapInPandas(rotate, "key string, id long, n long, whole boolean, first boolean")


def nearest(words: DataFrame) -> DataFrame:
    """id, n_near, near, near_n of (id, word, n), ids in code-point order: how many words differ from each by exactly one character
    inserted, deleted or replaced, and the id of the most frequent of them, the least of equals. Words without any give no row."""
    sorted_ = rotations(words).repartitionByRange("key").sortWithinPartitions("key")
    one = F.struct((-F.col("n")).alias("minus"), "id", "whole", "first")
    ranges = sorted_.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("m")).where(F.size("m") > 1)

    def seen(own):
        near = F.filter("m", lambda x: (x["id"] != own["id"]) & F.when(own["whole"], x["first"]).otherwise(~x["whole"] | own["first"]))
        return F.struct(own["id"].alias("id"), F.size(near).alias("n_near"), F.get(near, F.lit(0)).alias("best"))

    each = ranges.select(F.inline(F.transform("m", seen))).where("n_near > 0")
    all_ = each.groupBy("id").agg(F.sum("n_near").cast("long").alias("n_near"), F.min(F.struct("best.minus", "best.id")).alias("b"))
    return all_.select("id", "n_near", F.col("b.id").alias("near"), (-F.col("b.minus")).alias("near_n"))


def group(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of (word, n). form: the most frequent near word, if RATIO times as frequent; root: the end of
    the forms. Forms grow by RATIO, so that few steps lead to a root; pointers are doubled until none moves.

    Words are distinct and not null; an empty table gives an empty one.
    """
    words = cut(numbered(words.select("word", "n"), [], ["word"], "id"))
    is_form = F.col("near_n") >= RATIO * F.col("n")
    found = words.join(nearest(words), "id", "left")
    found = cut(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form_id"), F.when(is_form, F.col("near_n")).alias("form_n")))
    up = cut(found.where("form_id is not null").select("id", F.col("form_id").alias("to")))
    while True:
        further = up.select(F.col("id").alias("to"), F.col("to").alias("next"))
        both = cut(up.join(further, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        up = both.drop("moved")
        if both.where("moved").isEmpty():
            break
    name = lambda c, w: words.select(F.col("id").alias(c), F.col("word").alias(w))
    ends = found.where("form_id is not null").join(up, "id").join(name("form_id", "form"), "form_id").join(name("to", "root"), "to")
    rooted = ends.select("word", "form", "root", "n", "n_near", "form_n")
    none = F.lit(None).cast("string")
    return rooted.unionByName(found.where("form_id is null").select("word", none.alias("form"), F.col("word").alias("root"), "n", "n_near", F.lit(None).cast("long").alias("form_n")))


def report(docs: DataFrame) -> DataFrame:
    """The words of whole texts, grouped. Repeated rows count each time, very long texts are read whole, other columns left out."""
    return group(vocabulary(docs))


_CODES = "list_transform(generate_series(1, octet_length(encode(doc_id || ':' || low))), lambda i: ('0x' || hex(encode(doc_id || ':' || low))[2 * i - 1 : 2 * i])::BIGINT)"
#: The words as stated, and neighbours by what is left when one code point is taken away.
SQL = f"""WITH {oracle.CRC_TABLE},
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}]+')) AS run FROM documents) WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
summed AS (SELECT low, n, {oracle.crc32(_CODES)} AS h FROM runs, crc_table),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % {NOISE} = 0 THEN low[1 : h % length(low)] || low[h % length(low) + 2 :] ELSE low END AS word, n FROM summed) WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
gone AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gone g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word, g.n FROM gone g JOIN words w ON g.rest = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form, CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
ends AS (WITH RECURSIVE walk(word, root, steps) AS (SELECT word, form, 1 FROM formed WHERE form IS NOT NULL UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN formed f ON f.word = walk.root WHERE f.form IS NOT NULL) SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)"""
