"""Sinks: FASTA, clusters, subsets of a cohort, in folders by group."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from taxaloom.operators.alignment import ungap
from taxaloom.operators.trees import prune, tips, write_newick
from taxaloom.session import cut


def write_fasta(seqs: DataFrame, path: str, by: list[str] | None = None, wrap: int = 60, strip_gaps: bool = True) -> None:
    """One record a row of (taxon_id, seq), lines of ``wrap`` characters (0: one line), a folder for each group."""
    seq = ungap("seq") if strip_gaps else F.col("seq")
    if wrap:
        seq = F.regexp_replace(F.regexp_replace(seq, f"(.{{{wrap}}})", "$1\n"), "\n$", "")
    rows = seqs.select(*(by or []), F.concat(F.lit(">"), "taxon_id", F.lit("\n"), seq).alias("value"))
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).text(path)


def save_partition(members: DataFrame, path: str) -> None:
    """A JSON object a cluster: representative, sorted members, size."""
    members.groupBy("rep").agg(F.array_sort(F.collect_list("taxon_id")).alias("members"), F.count("*").alias("size")).write.mode("overwrite").json(path)


def export_subset(path: str, taxa: DataFrame, alignment: DataFrame, nodes: DataFrame, metadata: DataFrame, residues: DataFrame) -> str:
    """Alignment rows (as they are), pruned trees, metadata (TSV and JSON) and residues of the taxa (taxon_id), as one version, whose
    name is returned.

    The parts go into a folder of the version, and a row that names it into the manifest only when all are written: readers see
    whole exports, whatever becomes of a run. Tabs and line breaks in cells become blanks.
    """
    version = uuid4().hex
    at, taxa = f"{path}/{version}", cut(taxa.select("taxon_id").distinct())
    keep = lambda df: df.join(taxa, "taxon_id", "left_semi")
    write_fasta(keep(alignment).withColumnRenamed("row", "seq"), f"{at}/alignment", ["alphabet"], wrap=0, strip_gaps=False)
    of_trees = tips(nodes).join(taxa.withColumnRenamed("taxon_id", "name"), "name", "left_semi").select("tree_id", "name")
    write_newick(prune(nodes, of_trees)).write.json(f"{at}/trees")
    rows = keep(metadata)
    rows.select(*[F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]", " ").alias(c) for c in rows.columns]).write.csv(f"{at}/metadata_tsv", sep="\t", header=True)
    rows.write.json(f"{at}/metadata_json")
    keep(residues).write.parquet(f"{at}/residues")
    done = taxa.agg(F.lit(version).alias("version"), F.current_timestamp().alias("at"), F.count("*").alias("taxa"))
    done.coalesce(1).write.mode("append").json(f"{path}/manifest")
    return version


def exported(spark: SparkSession, path: str) -> str:
    """The folder of the latest whole export; an error if there is none."""
    versions = spark.read.schema("version string, at timestamp, taxa long").json(f"{path}/manifest").orderBy(F.desc("at"), "version").head(1)
    if not versions:
        raise FileNotFoundError(f"no whole export in {path}")
    return f"{path}/{versions[0]['version']}"
