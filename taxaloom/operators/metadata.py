"""Metadata tables: inference of columns, matching to tree tips, filters and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Limits, and column names that are tried in order.
ID_OVERLAP, ID_UNIQUE, MAX_CATEGORIES, MIN_NUMERIC = 0.30, 0.70, 65, 8
ID_NAMES = ["record_id", "recordid", "id", "taxon_id", "taxon", "name", "structure_id", "sequence_id", "seq_id", "genbank", "accession", "filename", "file", "design_id"]
COLOUR_GROUPS = [["family", "taxon", "lineage", "clade"], ["class", "fold", "struct", "cluster"], ["bind", "affinity", "host", "phenotype"]]
COLOUR_CATEGORIES = (2, 30)
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def melt(rows: DataFrame, key: str) -> DataFrame:
    """(key, column, ord, value): blank text is null."""
    others = [c for c in rows.columns if c != key]
    cell = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"), F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias("value")) for i, c in enumerate(others)]
    return rows.select(key, F.explode(F.array(*cell)).alias("x")).select(key, "x.column", "x.ord", "x.value")


def number(x: Column) -> Column:
    """Text as a number, if it is written as one."""
    return F.when(x.rlike(NUMBER), x.try_cast("double"))


def find_id_column(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """The column whose values meet most candidates (name), if over 30 % of the records do; else by name, without regard to case, _ and
    -; else the first of which 70 % of the values are distinct; else the first. One pass over the unpivoted table."""
    cell = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(rows.columns)]
    cells = rows.select(F.explode(F.array(*cell)).alias("x")).select("x.column", "x.ord", "x.value", F.lower(F.trim("x.value")).alias("low"))
    known = candidates.select(F.lower(F.trim("name")).alias("low")).distinct().withColumn("hit", F.lit(1))
    g = cells.join(known, "low", "left").groupBy("column", "ord").agg(F.count("*").alias("records"), F.count("hit").alias("hits"), F.count("value").alias("present"), F.count_distinct("value").alias("distinct"))
    plain = lambda x: F.regexp_replace(x, "[_-]", "")
    met = F.col("hits") > F.col("records") * ID_OVERLAP
    by_name = F.array_position(F.array(*[plain(F.lit(x)) for x in ID_NAMES]), F.trim(plain(F.lower("column"))))
    rank = F.when(met, 0).when(by_name > 0, by_name).otherwise(99)
    # of columns that are alike by name the last counts
    order = [F.when(met, F.col("hits")).otherwise(0).desc(), rank, F.when((rank > 0) & (rank < 99), -F.col("ord")).otherwise(0), F.when(F.col("distinct") >= F.col("present") * ID_UNIQUE, 0).otherwise(1), F.col("ord")]
    # columns that meet equally many are in their own order, unique or not
    order[3] = F.when(met, 0).otherwise(order[3])
    return g.orderBy(*order).limit(1).select("column", "records", "hits", "distinct")


def classify_columns(rows: DataFrame, key: str) -> DataFrame:
    """kind, cardinality, min, max of each column that has values."""
    c = melt(rows, key).where("value is not null").withColumn("x", number(F.col("value")))
    g = c.groupBy("column").agg(F.count("*").alias("n"), F.count("x").alias("numeric"), F.count_distinct("value").alias("cardinality"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    continuous = (F.col("n") == F.col("numeric")) & (F.col("cardinality") > MIN_NUMERIC)
    kind = F.when(continuous, "continuous").when(F.col("cardinality") <= MAX_CATEGORIES, "categorical").otherwise("text")
    return g.select("column", kind.alias("kind"), "cardinality", F.when(continuous, F.col("lo")).alias("min"), F.when(continuous, F.col("hi")).alias("max"))


def assign_palette(values: DataFrame, fixed: DataFrame, size: int = 40) -> DataFrame:
    """slot of each (column, value): fixed slots where known, the others in sorted order, cycling; only unknown values move the
    counter."""
    known = values.join(fixed, ["column", "value"], "left")
    k = F.row_number().over(Window.partitionBy("column", F.col("fixed_slot").isNull()).orderBy("value")) - 1
    return known.select("column", "value", F.coalesce("fixed_slot", F.pmod(k, F.lit(size))).alias("slot"))


def default_colour_column(specs: DataFrame) -> DataFrame:
    """The column to colour by, from (column, kind, cardinality, ord): of the categorical ones the first whose name has a word of
    the first group of words (families and the like), else of the second, else of the third, else the first of 2 to 30 values,
    else the first; without categorical ones the first continuous one."""
    name, rule = F.lower("column"), F.when(F.col("kind") == "continuous", 9)
    has = lambda words: F.greatest(*[F.contains(name, F.lit(w)) for w in words])
    category = F.when(F.lit(False), 0)
    for i, words in enumerate(COLOUR_GROUPS):
        category = category.when(has(words), i)
    category = category.when(F.col("cardinality").between(*COLOUR_CATEGORIES), 7).otherwise(8)
    ruled = specs.withColumn("rule", F.when(F.col("kind") == "categorical", category).otherwise(rule)).where("rule is not null")
    return ruled.agg(F.min_by("column", F.struct("rule", "ord")).alias("column"))


def normalise_values(cells: DataFrame) -> DataFrame:
    """Text of numbers as whole numbers or with three places, other text trimmed; blank cells go."""
    x = number(F.col("value"))
    whole = x == F.floor(x)
    return cells.withColumn("value", F.trim("value")).where("value <> ''").withColumn("number", F.when(whole, x).otherwise(F.round(x, 3))).withColumn("text", F.when(x.isNull(), F.col("value")))


def enrich_missing(rows: DataFrame, extra: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields that rows lack are filled from extra; what they have wins."""
    e = extra.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    return rows.join(e, key, "left").select(*[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in fields else F.col(c) for c in rows.columns])


def from_structures(residues: DataFrame) -> DataFrame:
    """length (300 if unknown) and mean confidence (75.0 if unknown) of each taxon."""
    return residues.groupBy("taxon").agg(F.coalesce(F.nullif(F.count("idx"), F.lit(0)), F.lit(300)).alias("length"), F.coalesce(F.round(F.avg("confidence"), 2), F.lit(75.0)).alias("mean_confidence"))


def match_to_leaves(meta: DataFrame, leaves: DataFrame) -> DataFrame:
    """(leaf, meta_id, rule): exact, lower case, blanks as underscores, letters and digits only, then the longest id of at least
    three characters that the leaf starts with before another character. All rules are equi joins."""
    low = lambda c: F.lower(c)
    meta, leaves = meta.select("meta_id").distinct(), leaves.select("leaf").distinct()  # of equal ones each pair would meet
    forms = [lambda c: c, low, lambda c: F.replace(low(c), F.lit(" "), F.lit("_")), lambda c: F.regexp_replace(low(c), "[^a-z0-9]", "")]
    offers = lambda df, c: df.select(F.col(c).alias("x"), F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), f(F.col(c)).alias("form")) for i, f in enumerate(forms)])).alias("o")).select("x", "o.rule", "o.form").where("form <> ''")
    equal = offers(leaves, "leaf").withColumnRenamed("x", "leaf").join(offers(meta, "meta_id").withColumnRenamed("x", "meta_id"), ["rule", "form"]).select("leaf", "meta_id", "rule", F.length("meta_id").alias("n"))
    ends = F.filter(F.sequence(F.lit(3), F.greatest(F.length("leaf") - 1, F.lit(3))), lambda i: F.substr(F.col("leaf"), i + 1, F.lit(1)).rlike("[^A-Za-z0-9]"))
    heads = leaves.select("leaf", F.explode(ends).alias("n")).select("leaf", "n", F.lower(F.substr(F.col("leaf"), F.lit(1), F.col("n"))).alias("form"))
    prefix = heads.join(meta.where(F.length("meta_id") >= 3).select("meta_id", F.lower("meta_id").alias("form")), "form").select("leaf", "meta_id", F.lit(4).alias("rule"), "n")
    first = F.min(F.struct("rule", (-F.col("n")).alias("n"), "meta_id")).alias("x")
    return equal.unionByName(prefix).groupBy("leaf").agg(first).select("leaf", "x.meta_id", "x.rule")


def leaf_metadata(leaves: DataFrame, match: DataFrame, meta: DataFrame, column: str, missing: str = "Unclassified") -> DataFrame:
    return leaves.join(match, "leaf", "left").join(meta.select("meta_id", column), "meta_id", "left").select("leaf", F.coalesce(F.col(column), F.lit(missing)).alias(column), F.col("meta_id").isNotNull().alias("matched"))


def filter_taxa(rows: DataFrame, column: str, categories: list | None = None, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows in the chosen categories (null counts as Unclassified) or range; no choice is no filter."""
    if categories is not None:
        return rows.where(F.coalesce(F.col(column), F.lit("Unclassified")).isin(categories))
    return rows.where(F.col(column).between(low, high)) if low is not None else rows


def search_taxa(rows: DataFrame, text: str) -> DataFrame:
    """Rows with the text in any column, whatever the case."""
    return rows.where(F.lower(F.concat_ws("\n", *[F.col(c).cast("string") for c in rows.columns])).contains(text.lower()))


def coverage_column(rows: DataFrame, coverage: DataFrame, key: str) -> DataFrame:
    return rows.join(coverage.select(key, F.round(100 * F.col("sequence_coverage"), 1).alias("coverage_pct")), key, "left")


def project(rows: DataFrame, mapping: dict[str, tuple[list[str], str]]) -> DataFrame:
    """Canonical columns from the first of several source columns that isn't blank, else a default."""
    return rows.select(*[F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in sources], F.lit(default)).alias(name) for name, (sources, default) in mapping.items()])


def category_summary(rows: DataFrame, column: str, confidence: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("taxa"), F.round(F.avg(F.coalesce(F.col(confidence), F.lit(0.0))), 4).alias("mean_confidence"))


def scale(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """scaled: 0 to 1 between the least and greatest value of a group (a range of 0 counts as 1)."""
    w = Window.partitionBy(*by)
    lo, hi = F.min(column).over(w), F.max(column).over(w)
    return rows.withColumn("scaled", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(column) - lo) / F.when(hi > lo, hi - lo).otherwise(1.0))))


def filter_report(rows: DataFrame, ok: Column, by: list[str]) -> DataFrame:
    g = rows.groupBy(*by).agg(F.count_if(ok).alias("matching"), F.count("*").alias("total"))
    return g.withColumn("percent", F.when(F.col("total") == 0, 100.0).otherwise(F.round(100 * F.col("matching") / F.col("total"), 1)))
