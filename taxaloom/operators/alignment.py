"""Sequences and alignments: statistics, gates, coverage, columns.

An alignment is a table of (group columns, taxon_id, row, ord); many alignments are handled in one job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from taxaloom.operators import blocks
from taxaloom.operators.rounds import greedy_representatives
from taxaloom.session import cut

#: Limits of the gates.
MIN_LENGTH, MIN_LENGTH_FRAC = 50, 0.4
SET_MAX_GAP, SET_MAX_EXPANSION = 0.50, 1.5
SPLIT_MAX_GAP, SPLIT_MAX_EXPANSION = 0.65, 3.0
#: Columns of a word of a residue mask; words up to which each is a column of its own; shares of a group in which its rows meet.
WORD, FEW_WORDS, SPREAD = 63, 16, 8
#: Rows of a block that meet another at once; columns up to which shares are read from a table.
STRIP, TABLED = 50, 1_000
#: Rows of counts (by, col, ch; some 100 bytes each) that a task adds up before it passes them on.
COUNTS = 400_000


def ungap(row: str | Column, gaps: str = "-") -> Column:
    return F.translate(F.col(row) if isinstance(row, str) else row, gaps, "")


def upper_median(x: str) -> Column:
    """The middle value, of two the upper one."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {x} DESC)")


def qc_filter(seqs: DataFrame, min_length: int = MIN_LENGTH, frac: float = MIN_LENGTH_FRAC) -> DataFrame:
    """taxon_id, length, kept, reason; the floor is set once, over the whole input."""
    sized = seqs.select("dataset", "taxon_id", F.length(ungap("seq")).alias("length"))
    floor = sized.agg(upper_median("length").alias("median")).select("median", F.greatest(F.lit(min_length), F.floor(F.col("median") * frac)).cast("int").alias("floor"))
    judged = sized.crossJoin(F.broadcast(floor))  # one row
    why = F.format_string(f"length %d < floor %d (max of min_length={min_length}, {frac:g} x median %d)", F.col("length").cast("long"), F.col("floor").cast("long"), F.col("median").cast("long"))
    return judged.select("dataset", "taxon_id", "length", (F.col("length") >= F.col("floor")).alias("kept"), F.when(F.col("length") < F.col("floor"), why).alias("reason"))


def gap_stats(aln: DataFrame, by: list[str]) -> DataFrame:
    """taxa, columns (width of the first row), gap_fraction, median_ungapped_length (1 if 0), expansion."""
    rows = aln.select(*by, "ord", F.length("row").alias("w"), F.length(ungap("row")).alias("n"))
    stats = rows.groupBy(*by).agg(F.count("*").alias("taxa"), F.min_by("w", "ord").alias("columns"), F.sum(F.col("w") - F.col("n")).alias("gaps"), upper_median("n").alias("m"))
    median = F.when(F.col("m") == 0, 1).otherwise(F.col("m")).cast("int")
    share = F.when(F.col("columns") > 0, F.round(F.col("gaps") / (F.col("taxa") * F.col("columns")), 4)).otherwise(0.0)
    return stats.select(*by, "taxa", "columns", share.alias("gap_fraction"), median.alias("median_ungapped_length"), F.round(F.col("columns") / median, 2).alias("expansion"))


def full_set_gate(stats: DataFrame, max_gap: float = SET_MAX_GAP, max_expansion: float = SET_MAX_EXPANSION) -> DataFrame:
    """usable, and over which limits an alignment of the whole set lies."""
    gap, wide = F.col("gap_fraction") >= max_gap, F.col("expansion") > max_expansion
    return stats.withColumn("usable", ~(gap | wide)).withColumn("reason", F.concat_ws("; ", F.when(gap, f"gap fraction >= {max_gap:.0%}"), F.when(wide, f"expansion > {max_expansion:g}x")))


def needs_split(stats: DataFrame, key: list[str], both: bool = False, max_gap: float = SPLIT_MAX_GAP, max_expansion: float = SPLIT_MAX_EXPANSION) -> DataFrame:
    """split and reason of each alignment from its 3di statistics, and from the aa ones too if ``both``."""
    over = F.concat_ws(", ", F.when(F.col("gap_fraction") >= max_gap, "gaps"), F.when(F.col("expansion") > max_expansion, "expansion"))
    wide = stats.withColumn("over", over).groupBy(*key).agg(*[F.max(F.when(F.col("alphabet") == a, F.col("over"))).alias(n) for a, n in (("3di", "o3"), ("aa", "oa"))])
    three, aa = F.coalesce("o3", F.lit("")) != "", (F.coalesce("oa", F.lit("")) != "") & F.lit(both)
    reason = F.concat_ws("; ", F.when(three, F.concat(F.lit("3Di: "), "o3")), F.when(aa, F.concat(F.lit("AA: "), "oa")))
    return wide.select(*key, (three | aa).alias("split"), F.when(three | aa, reason).otherwise("alignment quality acceptable").alias("reason"))


def strip_gap_columns(aln: DataFrame, by: list[str], gaps: str = "-") -> DataFrame:
    """Rows without the columns in which every row of the alignment has a gap."""
    used = column_counts(aln, by).where(~F.lit(gaps).contains(F.col("ch"))).select(*by, (F.col("col") + 1).alias("c")).distinct()
    keep = used.groupBy(*by).agg(F.array_sort(F.collect_list("c")).alias("keep"))
    return aln.join(keep, by, "left").withColumn("row", F.coalesce(F.expr("array_join(transform(keep, c -> substr(row, c, 1)), '')"), F.lit(""))).drop("keep")


def sequence_coverage(aln: DataFrame, by: list[str]) -> DataFrame:
    """non_gaps, sequence_coverage (of the width) and domain_coverage (of the longest row)."""
    longest = F.max("non_gaps").over(Window.partitionBy(*by))
    share = lambda of: F.when(of > 0, F.round(F.col("non_gaps") / of, 4)).otherwise(0.0)
    sized = aln.select(*by, "taxon_id", F.length("row").alias("width"), F.length(ungap("row")).alias("non_gaps"))
    return sized.select(*by, "taxon_id", "non_gaps", share(F.col("width")).alias("sequence_coverage"), share(longest).alias("domain_coverage"))


def _counted(rows: list[str], ords: np.ndarray) -> pd.DataFrame:
    """col, ch, n, first of some rows of an alignment."""
    width = max(1, max(map(len, rows)))
    points = np.array(rows, f"<U{width}").view("<u4").reshape(len(rows), width)[np.argsort(-ords, kind="stable")]
    codes, at = np.unique(points, return_inverse=True)
    place = at.reshape(points.shape) * width + np.arange(width)
    n = np.bincount(place.ravel(), minlength=len(codes) * width)
    first = np.zeros(len(codes) * width, np.int64)
    first[place.ravel()] = np.repeat(np.sort(ords)[::-1], width)  # of equal places the last, so the least, stays
    some = np.flatnonzero((n > 0) & (np.repeat(codes, width) > 0))
    return pd.DataFrame({"col": (some % width).astype(np.int32), "ch": [chr(codes[i]) for i in some // width], "n": n[some], "first": first[some]})


def column_counts(aln: DataFrame, by: list[str]) -> DataFrame:
    """by, col, ch, n, first: how often each symbol stands in each column of an alignment, and the least ord of its rows. Rows are counted
    in arrays where they lie, and only counts are shuffled; a task holds those of COUNTS rows before it passes them on."""
    ord_ = F.coalesce(F.col("ord").cast("long"), F.lit(2**63 - 1)) if "ord" in aln.columns else F.lit(0).cast("long")
    kinds = "".join(f"`{c}` {aln.schema[c].dataType.simpleString()}, " for c in by)
    keys = [*by, "col", "ch"]

    def count(batches):
        held, size = [], 0
        for b in batches:
            for key, g in b.groupby(by, dropna=False, sort=False):
                one = _counted(g["row"].tolist(), g["ord"].to_numpy(np.int64))
                for i, (c, v) in enumerate(zip(by, key, strict=True)):
                    one.insert(i, c, pd.Series([None if pd.isna(v) else v] * len(one), dtype=b[c].dtype))
                held.append(one)
                size += len(one)
            if size > COUNTS:
                yield pd.concat(held).groupby(keys, dropna=False, sort=False, as_index=False).agg({"n": "sum", "first": "min"})
                held, size = [], 0
        if held:
            yield pd.concat(held).groupby(keys, dropna=False, sort=False, as_index=False).agg({"n": "sum", "first": "min"})

    rows = aln.where("row <> ''").select(*by, "row", ord_.alias("ord"))
    return rows.mapInPandas(count, f"{kinds}col int, ch string, n long, first long").groupBy(*keys).agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def column_occupancy(aln: DataFrame, by: list[str]) -> DataFrame:
    return column_counts(aln, by).groupBy(*by, "col").agg(F.round(F.sum(F.when(F.col("ch") != "-", F.col("n")).otherwise(0)) / F.sum("n"), 4).alias("occupancy"))


def _block_coverage(aln: DataFrame, by: list[str]) -> DataFrame:
    """mutual_coverage of all pairs: blocks of residue masks meet as matrix products, a strip of rows at a time."""
    width = aln.agg(F.max(F.length("row"))).first()[0] or 1
    mask = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.when(F.substr(F.col("row"), i, F.lit(1)).isin("", "-"), 0.0).otherwise(1.0))
    rows = aln.where("row is not null").select(*by, "taxon_id", "ord", F.length(ungap("row")).alias("n"), mask.alias("vec"))
    points = blocks.in_order(rows, by, ["ord", "taxon_id"])

    def share(mutual: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Four digits, halves up, in whole numbers."""
        return (20_000 * mutual + of) // np.maximum(2 * of, 1) / 10_000

    def meet(x: dict, y: dict, same: bool) -> Iterator[pa.RecordBatch]:
        # what shares there are is told by a row's residues and those in common: read from a table where it is small
        side = np.arange(width + 1 if width <= TABLED else 0, dtype=np.int64)
        table = share(side[:, None], side[None]).ravel()
        of = (lambda mutual, n: table[mutual * (width + 1) + n]) if len(side) else share
        m, others, n = x["m"].astype(np.float32), np.ascontiguousarray(y["m"].T.astype(np.float32)), [z["n"].astype(np.int64) for z in (x, y)]  # whole numbers
        one, whole = {c: x[c] for c in by}, {}
        for r in (slice(i, min(i + STRIP, x["rows"])) for i in range(0, x["rows"], STRIP)):
            both, k = (m[r] @ others).astype(np.int64), r.stop - r.start
            if x["ord"][r].max() < y["ord"].min():  # all pairs of a strip, as most are
                if k not in whole:
                    whole[k] = {"b": pa.concat_arrays([y["taxon_id"]] * k), **{c: pa.array([v]).take(pa.array(np.zeros(k * y["rows"], np.int32))) for c, v in one.items()}}
                mutual, i = both.ravel(), np.repeat(np.arange(r.start, r.stop), y["rows"])
                columns, a, b = whole[k], np.repeat(n[0][r], y["rows"]), np.tile(n[1], k)
            else:
                i, j = np.nonzero(x["ord"][r][:, None] < y["ord"])
                if not len(i):
                    continue
                mutual, a, b = both[i, j], n[0][r][i], n[1][j]
                columns, i = {"b": y["taxon_id"].take(pa.array(j)), **{c: pa.array([v]).take(pa.array(np.zeros(len(i), np.int32))) for c, v in one.items()}}, i + r.start
            yield pa.RecordBatch.from_pydict({**columns, "a": x["taxon_id"].take(pa.array(i)), "mutual": pa.array(mutual.astype(np.int32)), "cov_min": pa.array(of(mutual, np.minimum(a, b))), "cov_max": pa.array(of(mutual, np.maximum(a, b)))})

    packed = cut(blocks.packed(points, by, ["pos", "ord", "taxon_id", "n"]))
    return blocks.met(packed, by, meet, f"{blocks.kinds(points, by)}{', ' if by else ''}a string, b string, mutual int, cov_min double, cov_max double", blocks.meetings(packed, by))


def mutual_coverage(aln: DataFrame, by: list[str], at_least: float | None = None) -> DataFrame:
    """mutual, cov_min, cov_max of each pair of rows; of all pairs by blocks. With a limit residue masks are packed into 64-bit words, compared
    by bit counts, and a group's rows meet in SPREAD shares of it, each in a task of its own. With a limit on cov_max only rows of like length meet: the
    shorter must have that share of the longer."""
    bits = f"transform(sequence(0, (length(row) - 1) div {WORD}), w -> aggregate(sequence(0, {WORD - 1}), 0L, (a, b) -> a | if(coalesce(substr(row, w * {WORD} + b + 1, 1), '') in ('', '-'), 0L, shiftleft(1L, b))))"
    if at_least is None:
        return _block_coverage(aln, by)
    words = ((aln.agg(F.max(F.length("row"))).first()[0] or 1) - 1) // WORD + 1
    masks = aln.select(*by, "taxon_id", "ord", F.length(ungap("row")).alias("n"), F.expr(bits).alias("m"))
    # a column for each word where they are few: counted by generated code, not by a function for each element
    parts = [F.coalesce(F.get("m", F.lit(w)), F.lit(0).cast("long")).alias(f"m{w}") for w in range(words)] if words <= FEW_WORDS else ["m"]
    masks = masks.select(*by, "taxon_id", "ord", "n", *parts)
    held = [c for c in masks.columns if c not in by]
    a, b = (masks.select(*by, *[F.col(c).alias(f"{c}_{s}") for c in held]) for s in "ab")
    if at_least is not None and 0 < at_least < 1:
        # lengths of one ratio share a band or are in bands side by side; a row meets those of three bands, not its whole group
        band = lambda n: F.floor(F.log(F.greatest(F.col(n), F.lit(1)).cast("double")) / -math.log(at_least))
        a = a.withColumn("band", band("n_a"))
        b = b.withColumn("band", F.explode(F.array(*[band("n_b") + i for i in (-1, 0, 1)])))
        pairs = a.join(b, [*by, "band"]).where("ord_a < ord_b").drop("band")
    else:
        a = a.withColumn("share", F.pmod(F.xxhash64("taxon_id_a"), F.lit(SPREAD)))
        b = b.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
        pairs = a.join(b, [*by, "share"]).where("ord_a < ord_b").drop("share")
    if at_least is not None:
        pairs = pairs.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * at_least)
    if words <= FEW_WORDS:
        common = sum((F.bit_count(F.col(f"m{w}_a").bitwiseAND(F.col(f"m{w}_b"))) for w in range(words)), F.lit(0))
    else:
        common = F.aggregate(F.zip_with("m_a", "m_b", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)
    share = lambda of: F.when(of > 0, F.round(F.col("mutual") / of, 4)).otherwise(0.0)
    out = pairs.withColumn("mutual", common).select(*by, F.col("taxon_id_a").alias("a"), F.col("taxon_id_b").alias("b"), "mutual", share(F.least("n_a", "n_b")).alias("cov_min"), share(F.greatest("n_a", "n_b")).alias("cov_max"))
    return out if at_least is None else out.where(F.col("cov_max") >= at_least)


def filter_by_coverage(aln: DataFrame, by: list[str], alphabet: str = "3di", least: float = 0.70, domain: bool = False) -> DataFrame:
    """The rows, in all alphabets, of taxa whose row in one alphabet passes; all-gap columns removed."""
    cov = sequence_coverage(aln.where(F.col("alphabet") == alphabet), by)
    passed = cov.where(F.col("domain_coverage" if domain else "sequence_coverage") >= least).select(*by, "taxon_id")
    return strip_gap_columns(aln.join(passed, [*by, "taxon_id"], "left_semi"), [*by, "alphabet"])


def greedy_partition(aln: DataFrame, by: list[str], least: float = 0.70) -> DataFrame:
    """taxon_id, rep: rows by length (longest first, then taxon) become representatives unless an earlier one covers them.

    Rows with residues in the same columns cover each other in full and have the same neighbours, so that only the first of them
    meets other rows and the rest go where it goes; rows without residues cover nothing and stand alone.
    """
    text = F.rtrim(F.regexp_replace("row", "[^-]", "x"), F.lit("-"))
    rows = aln.select(*by, "taxon_id", "ord", text.alias("row"), F.length(ungap("row")).alias("n")).withColumn("alone", F.when(F.col("n") == 0, F.col("taxon_id")).otherwise(""))
    key = [*by, "row", "alone"]
    first = cut(rows.groupBy(*key).agg(F.min("taxon_id").alias("taxon_id"), F.min_by("ord", "taxon_id").alias("ord"), F.max("n").alias("n")))
    ranked = first.withColumn("rank", F.struct((-F.col("n")).alias("n"), "taxon_id"))  # an order, not a number: no sort of a group
    pairs = mutual_coverage(first, by, least).select(*by, "a", "b")
    found = greedy_representatives(ranked.select(*by, "taxon_id", "rank"), pairs, by)
    of = first.join(found, [*by, "taxon_id"]).select(*key, "rep")
    return rows.join(of, key).select(*by, "taxon_id", "rep")


def consensus(aln: DataFrame, by: list[str]) -> DataFrame:
    """sequence of most frequent symbols and each column's share of all rows (gaps included)."""
    rows = aln.groupBy(*by).agg(F.count("*").alias("taxa"))
    most = column_counts(aln, by).groupBy(*by, "col").agg(F.max_by(F.struct("ch", "n"), F.struct("n", (-F.col("first")).alias("f"), "ch")).alias("x"))
    return most.join(rows, by).select(*by, "col", F.col("x.ch").alias("symbol"), F.round(F.col("x.n") / F.col("taxa"), 4).alias("conservation"))


def alphabet_lengths(aln: DataFrame, by: list[str]) -> DataFrame:
    return aln.groupBy(*by).pivot("alphabet", ["3di", "aa"]).agg(F.max(F.length("row")))


def roster(aln: DataFrame, min_size: int = 1) -> DataFrame:
    """The full set and each partition: taxa, length, mean coverage; major if at least min_size; by size."""
    cov = sequence_coverage(aln, ["partition"])
    parts = cov.groupBy("partition").agg(F.count("*").alias("taxa"), F.max(F.col("non_gaps")).alias("longest"), F.round(F.avg("sequence_coverage"), 4).alias("mean_coverage"))
    whole = cov.agg(F.lit("(all)").alias("partition"), F.count("*").alias("taxa"), F.max("non_gaps").alias("longest"), F.round(F.avg("sequence_coverage"), 4).alias("mean_coverage"))
    return whole.unionByName(parts).withColumn("major", F.col("taxa") >= min_size).orderBy(F.desc("taxa"), "partition")


def msa_rows(aln: DataFrame, by: list[str], order: DataFrame, least: float = 0.0) -> DataFrame:
    """taxon_id and place: rows with enough coverage, in the tree's leaf order (leaf_ord), those not in it last."""
    cov = sequence_coverage(aln, by).where(F.col("sequence_coverage") >= least)
    return cov.join(order, "taxon_id", "left").select(*by, "taxon_id", "leaf_ord").withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("leaf_ord").asc_nulls_last(), "taxon_id")))


def comparability(a: DataFrame, b: DataFrame, least: int = 50, overlap: float = 0.80, identical: float = 0.99) -> DataFrame:
    """Whether two data sets of (taxon_id, seq) can be compared, and the first rule that says no."""
    x, y = a.select("taxon_id", ungap("seq").alias("sa"), F.lit(1).alias("ia")), b.select("taxon_id", ungap("seq").alias("sb"), F.lit(1).alias("ib"))
    both = F.col("ia").isNotNull() & F.col("ib").isNotNull()
    s = x.join(y, "taxon_id", "full").agg(F.count("ia").alias("n_a"), F.count("ib").alias("n_b"), F.count_if(both).alias("shared"), F.count_if(both & (F.col("sa") == F.col("sb"))).alias("same"))
    return s.transform(_comparable, least, overlap, identical)


def _comparable(s: DataFrame, least: int, overlap: float, identical: float) -> DataFrame:
    why = F.when(F.col("shared") < least, "too few shared taxa").when(F.col("shared") < F.least("n_a", "n_b") * overlap, "too little overlap").when(F.col("same") < F.col("shared") * identical, "sequences differ").otherwise("comparable")
    return s.withColumn("reason", why).withColumn("comparable", F.col("reason") == "comparable")


def comparable_pairs(seqs: DataFrame, least: int = 50, overlap: float = 0.80, identical: float = 0.99) -> DataFrame:
    """comparability of every pair of data sets that share a taxon: one join on taxon, not a run for each pair."""
    rows = seqs.select("dataset", "taxon_id", F.xxhash64(ungap("seq")).alias("h"))
    size = rows.groupBy("dataset").agg(F.count("*").alias("n"))
    a, b = (rows.select(F.col("dataset").alias(f"dataset_{s}"), "taxon_id", F.col("h").alias(f"h_{s}")) for s in "ab")
    shared = a.join(b, "taxon_id").where("dataset_a < dataset_b").groupBy("dataset_a", "dataset_b").agg(F.count("*").alias("shared"), F.count_if(F.col("h_a") == F.col("h_b")).alias("same"))
    sized = shared.join(size.select(F.col("dataset").alias("dataset_a"), F.col("n").alias("n_a")), "dataset_a").join(size.select(F.col("dataset").alias("dataset_b"), F.col("n").alias("n_b")), "dataset_b")
    return _comparable(sized, least, overlap, identical)


def alphabet_validity(aln: DataFrame, allowed: str = "acdefghiklmnpqrstvwy-") -> DataFrame:
    """Rows with symbols outside the alphabet, and those symbols' number."""
    return aln.select("partition", "alphabet", "taxon_id", F.length(F.translate("row", allowed, "")).alias("invalid")).where("invalid > 0")


def mean_conservation(aln: DataFrame, by: list[str]) -> DataFrame:
    return consensus(aln, by).groupBy(*by).agg(F.round(100 * F.avg("conservation"), 1).alias("mean_conservation"))
