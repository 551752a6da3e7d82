"""Search cohorts: gating, naming and pooling of hits, taxonomy, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Limits, databases by kind of structure, ranks kept of a lineage.
MAX_EVALUE = 1e-3
PREDICTED = [
    "bfvd_v3", "BFVD_folddisco", "afdb50", "afdb50_folddisco", "afdb-swissprot", "afdb-proteome", "afdb-proteome_folddisco",
    "esm30_folddisco", "mgnify_esm30", "cath50", "bfmd",
]
NATIVE_CONFIDENCE = ["bfvd", "afdb"]
RANKS = ["superkingdom", "kingdom", "phylum", "class", "order", "suborder", "family", "subfamily", "genus", "subgenus", "species"]
#: Least value of the upper three bands of each scale; of B-factors, where low is good, the greatest.
BANDS = {"plddt": (90, 70, 50), "lddt": (0.8, 0.6, 0.4), "bfactor": (20, 40, 60)}
BAND_NAMES = ("very high", "high", "low", "very low")
PLDDT_CATEGORIES = ("Very high (>90)", "Confident (70-90)", "Low (50-70)", "Disordered (<50)")


def coverage(aln: str = "aln_length", q: str = "q_len") -> Column:
    return F.when(F.col(q) > 0, F.col(aln) / F.col(q)).otherwise(0.0)


def gate(hits: DataFrame, max_evalue: float = MAX_EVALUE, min_length: int = 0, min_coverage: float = 0.0) -> DataFrame:
    """Hits within the limits; a null e-value fails."""
    return hits.where((F.col("evalue") <= max_evalue) & (F.coalesce("aln_length", F.lit(0)) >= min_length) & (coverage() >= min_coverage))


def accession(target: Column, db: Column) -> Column:
    """In PDB databases ID_CHAIN in upper case, if the name is four letters or digits before - or _; of AlphaFold names (AF-) the
    accession, of CATH domains (af_) accession_start-end, whatever the database; else the first word."""
    head = F.regexp_extract(target, r"^\s*(\S+)", 1)
    entry, chain = F.regexp_extract(head, "^([0-9a-zA-Z]{4})[-_]", 1), F.regexp_extract(head, "^.{5}.*?_([A-Za-z0-9]+)$", 1)
    pdb = F.upper(F.concat_ws("_", entry, F.nullif(chain, F.lit(""))))
    return (
        F.when(db.startswith("pdb") & (entry != ""), pdb)
        .when(head.rlike(r"^AF-[A-Z0-9]+-F\d+"), F.regexp_extract(head, r"^AF-([A-Z0-9]+)-F", 1))
        .when(head.rlike(r"^af_[A-Z0-9]+_\d+_\d+_"), F.regexp_replace(head, r"^af_([A-Z0-9]+)_(\d+)_(\d+)_.*$", "$1_$2-$3"))
        .otherwise(head)
    )


def cath_parent(name: Column) -> list[Column]:
    part = lambda i: F.regexp_extract(name, r"^([A-Z0-9]+)_(\d+)-(\d+)$", i)
    return [F.nullif(part(1), F.lit("")).alias("parent"), part(2).try_cast("int").alias("start"), part(3).try_cast("int").alias("end")]


def best_per_accession(hits: DataFrame, tie: list[str]) -> DataFrame:
    """The hit with the lowest e-value of each query and accession; the first of ties."""
    k = F.row_number().over(Window.partitionBy("query", "accession").orderBy("evalue", *tie))
    return hits.withColumn("k", k).where("k = 1").drop("k")


def exclude_self(hits: DataFrame, limit: float = 99.9) -> DataFrame:
    return hits.where(F.coalesce("seq_id", F.lit(0.0)) < limit)


def cap(hits: DataFrame, most: int, tie: list[str]) -> DataFrame:
    """At most ``most`` hits of each query (0: all), the best ones; short says that there were fewer."""
    n = F.count("*").over(Window.partitionBy("query"))
    k = F.row_number().over(Window.partitionBy("query").orderBy("evalue", *tie))
    out = hits.withColumn("short", n < most)
    return out if most <= 0 else out.withColumn("k", k).where(F.col("k") <= most).drop("k")


def per_db(hits: DataFrame, passed: DataFrame) -> DataFrame:
    return hits.groupBy("db").agg(F.count("*").alias("returned")).join(passed.groupBy("db").agg(F.count("*").alias("passed")), "db", "left").fillna(0, ["passed"])


def structure_kind(db: Column) -> Column:
    return F.when(db.isin(PREDICTED), "predicted").otherwise("experimental")


def confidence_plan(db: Column) -> Column:
    native = F.lit(False)
    for p in NATIVE_CONFIDENCE:
        native = native | db.startswith(p)
    return F.when(native, "plddt").otherwise("none")


def cohort_counts(hits: DataFrame) -> DataFrame:
    """written, failed and with_confidence by source from (db, ok, confidence)."""
    return hits.groupBy("db").agg(F.count_if("ok").alias("written"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("ok") & (F.col("confidence") != "none")).alias("with_confidence"))


def lddt_track(values: Column, start: Column, length: Column) -> Column:
    """Aligned values (from a start counted from 1) laid out over the whole chain, null outside."""
    return F.transform(F.sequence(F.lit(1), length), lambda i: F.when((i >= start) & (i < start + F.size(values)), F.get(values, (i - start).cast("int"))))


def normalise_taxonomy(tax: DataFrame) -> DataFrame:
    """tax_id, ranks (first name of each allowed rank), lineage string from the root down, hosts from
    (tax_id, lineage array<struct<rank,name>> from the leaf up, hosts array<string>)."""
    kept = F.filter("lineage", lambda x: x["rank"].isin(RANKS) & x["name"].isNotNull())
    ranks = F.array_distinct(F.transform(kept, lambda x: x["rank"]))
    first = lambda r: F.get(F.filter(kept, lambda x: x["rank"] == r), 0)["name"]
    out = tax.where("tax_id is not null").dropDuplicates(["tax_id"])
    return out.select("tax_id", F.map_from_arrays(ranks, F.transform(ranks, first)).alias("ranks"), F.array_join(F.reverse(F.transform(kept, lambda x: x["name"])), " > ").alias("lineage_text"), F.array_distinct("hosts").alias("hosts"))


def enrich_taxonomy(rows: DataFrame, tax: DataFrame, ranks: list[str]) -> DataFrame:
    """rows with lineage_text, tax_<rank>, hosts joined by '; ', primary host and their number."""
    out = rows.join(tax, "tax_id", "left")
    columns = [F.col("ranks")[r].alias(f"tax_{r}") for r in ranks]
    return out.select(*[F.col(c) for c in rows.columns], "lineage_text", *columns, F.array_join("hosts", "; ").alias("host_names"), F.get("hosts", F.lit(0)).alias("primary_host"), F.coalesce(F.size("hosts"), F.lit(0)).alias("n_hosts"))


def sidecar(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One JSON object a row of the named fields, without nulls; rows with an error are dropped."""
    kept = rows.where("error is null") if "error" in rows.columns else rows
    return kept.select(key, F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("sidecar"))


def classify_query(q: Column, files: Column | None = None) -> Column:
    """file where ``files`` (by default: the name ends like a structure file) holds, ncbi for a versioned protein accession of
    NCBI (two letters and _, or three letters and five digits), else uniprot: what it is, the lookup there will tell."""
    t = F.trim(q)
    is_file = t.rlike(r"\.(pdb|cif|mmcif)(\.gz)?$") if files is None else files
    return F.when(is_file, "file").when(t.rlike(r"^([A-Z]{2}_[0-9]+|[A-Z]{3}[0-9]{5})\.[0-9]+$"), "ncbi").otherwise("uniprot")


def accession_list(lines: DataFrame, most: int = 0) -> DataFrame:
    """Accessions of (ord, line): split at commas, trimmed, upper case, each once in order of first mention; # lines skipped."""
    each = lines.where(~F.ltrim("line").startswith("#")).select("ord", F.posexplode(F.split("line", ",")).alias("pos", "a")).withColumn("a", F.upper(F.trim("a"))).where("a <> ''")
    out = each.groupBy("a").agg(F.min(F.struct("ord", "pos")).alias("at")).orderBy("at").select(F.col("a").alias("accession"), "at.ord", "at.pos")
    return out.limit(most) if most else out


def canonical_entry(entries: DataFrame) -> DataFrame:
    """Of each query's entries (query, entry, start, end) the one named like the query, else the longest."""
    exact = F.col("entry") == F.col("query")
    return entries.groupBy("query").agg(F.max_by("entry", F.struct(exact.alias("x"), F.col("end"), F.col("entry"))).alias("entry"))


def plddt_category(x: Column) -> Column:
    best, good, low, none = PLDDT_CATEGORIES
    return F.when(x.isNull(), "Unknown").when(x >= 90, best).when(x >= 70, good).when(x >= 50, low).otherwise(none)


def entry_metadata(rows: DataFrame) -> DataFrame:
    """Provider records in canonical columns, defaults in place of nulls."""
    return rows.select("accession", F.coalesce(F.nullif(F.trim("description"), F.lit("")), F.lit("Unknown")).alias("protein"), F.coalesce("organism", F.lit("Unknown")).alias("organism"), F.coalesce("plddt", F.lit(0.0)).alias("plddt"), plddt_category(F.col("plddt")).alias("category"))


def residue_mode(want: Column, has_lddt: Column, kind: Column) -> Column:
    """The scale that a structure is coloured by: the one asked for (lddt, native or auto: LDDT where there is some, else native).
    kind is the native one, none if there is none, plddt where it isn't told."""
    native, lddt = F.coalesce(kind, F.lit("plddt")), F.coalesce(has_lddt, F.lit(False))
    return F.when(want == "lddt", F.when(lddt, "lddt").otherwise("none")).when(want == "native", native).otherwise(F.when(lddt, "lddt").otherwise(native))


def residue_band(x: Column, mode: Column) -> Column:
    """Band of a residue's value on the scale ``mode``; none for null and for other scales."""
    out = F.lit("none")
    for name, (a, b, c) in BANDS.items():
        reached = (lambda t: x <= t) if name == "bfactor" else (lambda t: x >= t)
        band = F.when(reached(a), BAND_NAMES[0]).when(reached(b), BAND_NAMES[1]).when(reached(c), BAND_NAMES[2]).otherwise(BAND_NAMES[3])
        out = F.when(mode == name, band).otherwise(out)
    return F.when(x.isNull(), "none").otherwise(out)
