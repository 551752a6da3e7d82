"""Personal data by bootstrapped contextual extraction.

Seeds are validated matches of four base patterns. They induce lexical patterns of two kinds: the words before a seed (the last
word, the last two words), which extract whatever identifier-like filler follows them, and the seed's own shape (digits, letters
and marks in order), which extracts groups of words of the same shape that no base pattern covers, such as a number that a base
match ran past. Spark then scores the bipartite graph of patterns and fillers: a pattern's trust is the share of the
identifier-like fillers in its slots that are believed to be of its kind, with one imagined miss; a filler's belief is the
noisy-or of the trust of its other patterns. After a few rounds the patterns with high trust extract further identifiers. Base spans stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from taxaloom.llm.memory import release
from taxaloom.session import cut, free_name

# Kinds in the order in which spans are listed, and the base patterns (of e-mail the part from the @ on).
KINDS = ["email", "ip", "card", "phone"]
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# A filler is an identifier if it has a digit or an @ and at least this many characters.
# After its first word it takes any number of digit groups, whole ones only.
FILLER = re.compile(r"[A-Za-z0-9._%+()@-]++(?: [0-9()][0-9().-]*+(?![A-Za-z0-9_%+@]))*+")
FILLER_START = re.compile(r"[A-Za-z0-9._%+()@-]")
LEAST_FILLER = 5

#: A pattern needs seeds in two distinct values and this many places, however large the corpus. Patterns are looked up in
#: blocks of about PATTERN_BLOCK, so that what is sent to every task while they are learned is bounded.
MIN_SUPPORT = 3
PATTERN_BLOCK = 200_000
ROUNDS = 3
#: Trust from which a pattern extracts.
CONFIDENT = 0.8
DIGITS, WORD_END = re.compile("[0-9@]+"), re.compile(r"[A-Za-z0-9._%+()@-]*+")
FILLER_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+()@-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by kind as listed, then start. Linear in the text: every search starts at
    a character that can end a failed attempt, so long runs are not tried again from each of their characters."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        end = 0
        for m in EMAIL_DOMAIN.finditer(text):
            s = m.start()
            while s > end and text[s - 1] in EMAIL_LOCAL:
                s -= 1
            if s < m.start():
                out.append(("email", s, m.end()))
                end = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _before(text: str, at: int) -> list[str]:
    """The last word and the last two words before a position, lower case. Words end at white space; of a word that the position
    lies in, the part after the last digit counts."""
    ends, words = at, []
    while len(words) < 2 and ends:
        if words or text[ends - 1].isspace():
            while ends and text[ends - 1].isspace():
                ends -= 1
            start = ends
            while start and not text[start - 1].isspace():
                start -= 1
        else:
            start = ends
            while start and not text[start - 1].isspace() and not "0" <= text[start - 1] <= "9":
                start -= 1
            if start == ends or (start and not text[start - 1].isspace()):
                return [text[start:ends].lower()] if start < ends else []
        if start < ends:
            words.insert(0, text[start:ends].lower())
        ends = start
    return [] if not words else [words[-1]] if len(words) == 1 else [words[-1], " ".join(words)]


def _shape(text: str) -> str:
    """The pattern of a text's shape: each digit 9, each run of letters a, marks as they are."""
    return "\t" + re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "9", text))


def _value(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum() or c == "@")


def seeds(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, pattern, value, n): what base matches stand behind which words and have which shape, summed before the shuffle."""

    def found(batches):
        for batch in batches:
            tally: Counter = Counter()
            for t in batch["text"]:
                for kind, s, e in base_spans(t):
                    for p in (*_before(t, s), _shape(t[s:e])):
                        tally[kind, p, _value(t[s:e])] += 1
            yield pd.DataFrame([(*k, n) for k, n in tally.items()], columns=["kind", "pattern", "value", "n"])

    return docs.select(F.col(text).alias("text")).mapInPandas(found, "kind string, pattern string, value string, n long").groupBy("kind", "pattern", "value").agg(F.sum("n").alias("n"))


def _slots(text: str, patterns: dict[str, list[str]]):
    """(pattern, start, filler or None) wherever a pattern's words stand before another word."""
    if all(p.startswith("\t") for p in patterns):  # shapes only
        return
    words = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)] if len(text) < 1 << 16 else re.finditer(r"\S+", text)
    last, last2 = None, None
    run = (0, 0)  # the last filler: a digit group within it ends where it ends, and isn't read to the end again
    for w in words:
        s, e = w if isinstance(w, tuple) else w.span()
        if last is not None:
            for p in (last, last2):
                if p is not None and p in patterns:
                    if not run[0] <= s < run[1]:
                        first = FILLER_START.search(text, s, e)
                        run = FILLER.match(text, first.start()).span() if first else (s, s)
                    a, b = max(s, run[0]), run[1]
                    good = b - a >= LEAST_FILLER and any(text[i] == "@" or "0" <= text[i] <= "9" for i in range(a, b))
                    yield p, (a, b) if good else None
        word = text[s:e].lower()
        last2 = None if last is None else f"{last} {word}"
        last = word


def _reach(patterns: Iterable[str]) -> tuple[int, int]:
    """Words of the learned shape that has most, and characters of the longest: no group beyond these can have a learned shape."""
    shapes = [p for p in patterns if p.startswith("\t")]
    return max((p.count(" ") + 1 for p in shapes), default=0), max(map(len, shapes), default=0)


def _shaped(text: str, patterns: dict[str, list[str]], reach: tuple[int, int]):
    """(pattern, span) of groups of words with digits or @, one blank apart, whose shape is a pattern; reach is that of the patterns.
    Marks around a group are no part of it."""
    most, longest = reach
    words: list[tuple[int, str, str]] = []  # where a word begins without marks before it, its shape from there, and its whole shape
    end = 0
    for m in DIGITS.finditer(text) if most else ():
        if m.start() < end:
            continue
        s = m.start()
        while s > end and text[s - 1] in FILLER_CHARS:
            s -= 1
        last, end = end, WORD_END.match(text, m.end()).end()
        if words and not (last + 1 == s and text[s - 1] == " "):
            words = []
        e, a = end, s
        while not text[e - 1].isalnum():
            e -= 1
        while not (text[a].isalnum() or text[a] in "+("):
            a += 1
        found = [(_shape(text[a:e]), a)]
        tail = _shape(text[s:e])[1:]
        for begin, first, whole in reversed(words):
            if len(first) + 1 + len(tail) <= longest:
                found.append((f"{first} {tail}", begin))
            tail = f"{whole} {tail}"
            if len(tail) > longest:
                break
        for p, begin in reversed(found):  # the longest first
            if p in patterns:
                yield p, (begin, e)
        words = [*words[max(0, len(words) + 2 - most) :], (a, _shape(text[a:end]), _shape(text[s:end])[1:])] if most > 1 else []


def learn(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, confident: float = CONFIDENT) -> dict[str, str]:
    """Patterns with high confidence and the kind each extracts; empty where the seeds share no words."""
    spark = docs.sparkSession
    edges = cut(seeds(docs, text))
    frequent = cut(edges.groupBy("kind", "pattern").agg(F.sum("n").alias("support"), F.countDistinct("value").alias("values")).where((F.col("support") >= MIN_SUPPORT) & (F.col("values") >= 2)))
    names = cut(frequent.select("pattern").distinct())
    blocks = -(-names.count() // PATTERN_BLOCK)
    if not blocks:
        return {}

    def filled(wanted, batches):
        reach = _reach(wanted.value)
        for batch in batches:
            tally: Counter = Counter()
            for t in batch["text"]:
                for p, at in (*_slots(t or "", wanted.value), *_shaped(t or "", wanted.value, reach)):
                    if at is not None:
                        tally[p, _value(t[at[0] : at[1]])] += 1
            yield pd.DataFrame([(*k, n) for k, n in tally.items()], columns=["pattern", "value", "n"])

    slots = None
    for i in range(blocks):
        rows = names.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == i).collect()
        wanted = spark.sparkContext.broadcast({r["pattern"]: [] for r in rows})
        some = cut(docs.select(F.col(text).alias("text")).mapInPandas(partial(filled, wanted), "pattern string, value string, n long").groupBy("pattern", "value").agg(F.sum("n").alias("n")))
        wanted.unpersist()
        slots = some if slots is None else slots.unionByName(some)
    uses = slots.groupBy("pattern").agg(F.sum("n").alias("uses"))
    known = edges.select("kind", "value").distinct().withColumn("seed", F.lit(1.0))
    graph = cut(frequent.select("kind", "pattern").join(slots, "pattern").join(uses, "pattern"))
    edges_now = graph.join(known, ["kind", "value"], "left").withColumn("belief", F.coalesce("seed", F.lit(0.0)))
    for _ in range(rounds):
        trust = cut(edges_now.groupBy("kind", "pattern").agg((F.sum(F.col("n") * F.col("belief")) / (F.max("uses") + 1)).alias("trust")))
        doubt = F.log(1 - F.least("trust", F.lit(0.999)))
        judged = edges_now.drop("belief").join(trust.select("kind", "pattern", doubt.alias("doubt")), ["kind", "pattern"])
        all_doubt = judged.groupBy("kind", "value").agg(F.sum("doubt").alias("all"))
        # what a pattern itself says of a filler is no support of the pattern
        others = F.greatest(F.lit(0.0), 1 - F.exp(F.col("all") - F.col("doubt")))
        edges_now = cut(judged.join(all_doubt, ["kind", "value"]).withColumn("belief", F.coalesce("seed", others)).drop("doubt", "all"))
    best = trust.where(F.col("trust") >= confident).groupBy("pattern").agg(F.max_by("kind", F.struct("trust", "kind")).alias("kind"))
    return {r["pattern"]: r["kind"] for r in best.collect()}


def all_spans(text: str | None, patterns: dict[str, str], base: list[tuple[str, int, int]] | None = None, reach: tuple[int, int] | None = None) -> list[tuple[str, int, int]]:
    """Base spans and, where they leave room, the fillers of learned patterns; the leftmost first, of those the longest, whatever their
    trust. base and reach may be given, where they are known."""
    base = base_spans(text) if base is None else base
    if not patterns or not text:
        return base
    taken = sorted((s, e) for _, s, e in base)
    # the leftmost first, of those the longest
    slots = {at: p for p, at in (*_slots(text, patterns), *_shaped(text, patterns, reach or _reach(patterns))) if at is not None}
    more, i, end = [], 0, 0
    for at in sorted(slots, key=lambda x: (x[0], -x[1])):
        if at[0] < end:
            continue
        while i < len(taken) and taken[i][1] <= at[0]:
            i += 1
        if i < len(taken) and taken[i][0] < at[1]:
            continue
        more.append((patterns[slots[at]], *at))
        end = at[1]
    return sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))


def mark(docs: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """``docs`` with base and spans, arrays of (kind, start, end). Null and empty texts have none. Rows are judged one by one, so repeated rows agree;
    texts are read whole, in time that grows with their length. Columns of these names are replaced."""
    held = docs.sparkSession.sparkContext.broadcast(patterns)

    @F.pandas_udf("base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>")
    def spans(texts: pd.Series) -> pd.DataFrame:
        reach = _reach(held.value)
        rows = [(base, all_spans(t, held.value, base, reach)) for t, base in ((t, base_spans(t)) for t in texts)]
        named = lambda xs: [{"kind": k, "start": s, "end": e} for k, s, e in xs]
        release()
        return pd.DataFrame({"base": [named(a) for a, _ in rows], "spans": [named(b) for _, b in rows]})

    kept = docs.drop("base", "spans")
    found = free_name(kept)
    return kept.withColumn(found, spans(F.col(text))).select(*[F.col(f"`{c}`") for c in kept.columns], f"{found}.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base matches by kind, the digest of the base spans and the list of all spans."""
    found = mark(docs.select("doc_id", "text"), learn(docs.select("text")))
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [F.size(F.expr(f"filter(base, x -> x.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every span becomes its kind in brackets; overlapping spans merge under the first one's kind, and
    n_chars is counted anew where the text changed. All rows stay."""
    held = docs.sparkSession.sparkContext.broadcast(learn(docs.select("text")))

    @F.pandas_udf("string")
    def hide(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            spans = sorted((s, e, k) for k, s, e in all_spans(t, held.value))
            if not spans:
                out.append(t)
                continue
            parts, at, i = [], 0, 0
            while i < len(spans):
                s, e, k = spans[i]
                i += 1
                while i < len(spans) and spans[i][0] < e:
                    e = max(e, spans[i][1])
                    i += 1
                parts += [t[at:s], f"[{k.upper()}]"]
                at = e
            out.append("".join([*parts, t[at:]]))
        release()
        return pd.Series(out, dtype=object)

    hidden = free_name(docs)
    changed = F.length(hidden).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    named = {"text": F.col(hidden), "n_chars": F.when(F.col("text").eqNullSafe(F.col(hidden)), F.col("n_chars")).otherwise(changed) if changed is not None else None}
    return docs.withColumn(hidden, hide(F.col("text"))).select(*[named[c].alias(c) if c in named else F.col(f"`{c}`") for c in docs.columns])
