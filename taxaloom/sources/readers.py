"""Sources: sequence, structure, table, hit and tree files, many files a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from taxaloom.operators import trees

# Three-letter residue names and their letters; suffixes of structure files.
RESIDUES = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I", "LEU": "L", "LYS": "K", "MET": "M", "MSE": "M",
    "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}
STRUCTURE_SUFFIX = r"\.(pdb|cif|mmcif)(\.gz)?$"


def file_stem(path: str = "path") -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), STRUCTURE_SUFFIX, "")


def read_fasta(spark: SparkSession, path: str, corrupt: bool = False) -> DataFrame:
    """path, taxon_id, seq: records end where a line starts with >, so that large files are read by several tasks. Lines are
    trimmed and joined; of repeated headers in a file the last one counts. Records without a header token are the corrupt
    ones, asked for with ``corrupt``."""
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    text = F.regexp_replace(F.regexp_replace("value", r"^>", ""), "\r", "")
    head = F.split_part(text, F.lit("\n"), F.lit(1))
    rec = raw.select("path", "block", "place", F.regexp_extract(head, r"^\s*(\S+)", 1).alias("taxon_id"), F.regexp_replace(F.regexp_replace(text, r"^[^\n]*(\n|$)", ""), r"\s", "").alias("seq"), "value")
    if corrupt:
        return rec.where("taxon_id = '' and trim(value) <> ''").select("path", "value")
    k = F.row_number().over(Window.partitionBy("path", "taxon_id").orderBy(F.desc("block"), F.desc("place")))
    return rec.where("taxon_id <> ''").withColumn("k", k).where("k = 1").select("path", "taxon_id", "seq")


def read_plm_sequences(spark: SparkSession, path: str) -> DataFrame:
    return read_fasta(spark, path).withColumn("seq", F.upper(F.translate("seq", "-.", ""))).where("seq <> ''")


def count_fasta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count_if(F.col("value").startswith(">")).alias("records"))


#: What is read to choose a table's delimiter: lines, and characters of them.
SNIFFED_LINES, SNIFFED = 200, 8192


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def parse_pdb(files: DataFrame) -> DataFrame:
    """path, idx, resnum, resname, x, y, z, occupancy, bfactor of the CA atoms; rows whose numbers can't be read go."""
    lines = files.select("path", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line")).where("line like 'ATOM%' and trim(substr(line, 13, 4)) = 'CA'")
    num = lambda a, n: F.trim(F.substring("line", a, n)).try_cast("double")
    out = lines.select("path", "pos", F.trim(F.substring("line", 23, 4)).try_cast("int").alias("resnum"), F.trim(F.substring("line", 18, 3)).alias("resname"), *[F.round(num(a, 8), 1).alias(c) for a, c in ((31, "x"), (39, "y"), (47, "z"))], num(55, 6).alias("occupancy"), num(61, 6).alias("bfactor"))
    return _numbered(out.where("x is not null and y is not null and z is not null"))


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("idx", F.row_number().over(Window.partitionBy("path").orderBy("pos"))).drop("pos")


def parse_mmcif(files: DataFrame) -> DataFrame:
    """The same from mmCIF: the _atom_site header gives the columns, label names before auth ones; short rows go."""
    lines = files.select("path", F.transform(F.split("text", r"\r?\n"), lambda x: F.trim(x)).alias("lines"))
    head = F.transform(F.filter("lines", lambda x: x.startswith("_atom_site.")), lambda x: F.split_part(x, F.lit("."), F.lit(2)))
    rows = F.filter("lines", lambda x: x.startswith("ATOM") | x.startswith("HETATM"))
    # where each column stands is found once a file
    wanted = {"label_atom_id": "auth_atom_id", "label_seq_id": "auth_seq_id", "label_comp_id": "auth_comp_id", "Cartn_x": None, "Cartn_y": None, "Cartn_z": None, "occupancy": None, "B_iso_or_equiv": None}
    stands = lambda n: F.nullif(F.array_position("head", n), F.lit(0).cast("long"))
    places = [(F.coalesce(*[stands(n) for n in (name, other) if n]) - 1).cast("int").alias(f"at_{name}") for name, other in wanted.items()]
    headed = lines.select("path", "lines", head.alias("head")).select("path", "lines", F.size("head").alias("width"), *places)
    each = headed.select("path", "width", *[f"at_{n}" for n in wanted], F.posexplode(rows).alias("pos", "line")).withColumn("t", F.split("line", r"\s+")).where("size(t) >= width")
    at = lambda name, other=None: F.get("t", F.col(f"at_{name}"))
    num = lambda *names: at(*names).try_cast("double")
    atoms = each.where(at("label_atom_id", "auth_atom_id") == "CA").select("path", "pos", at("label_seq_id", "auth_seq_id").try_cast("int").alias("resnum"), at("label_comp_id", "auth_comp_id").alias("resname"), *[F.round(num(f"Cartn_{c}"), 1).alias(c) for c in "xyz"], num("occupancy").alias("occupancy"), num("B_iso_or_equiv").alias("bfactor"))
    out = _numbered(atoms.where("x is not null and y is not null and z is not null"))
    return out.withColumn("resnum", F.coalesce("resnum", "idx"))


def select_confidence(residues: DataFrame, key: str = "path") -> DataFrame:
    """residues with confidence: the B-factor of a structure if it varies, else the occupancy if that varies, else the B-factor."""
    w = Window.partitionBy(key)
    b, o = F.min("bfactor").over(w) != F.max("bfactor").over(w), F.min("occupancy").over(w) != F.max("occupancy").over(w)
    return residues.withColumn("confidence", F.when(F.coalesce(b, F.lit(False)), F.col("bfactor")).when(F.coalesce(o, F.lit(False)), F.col("occupancy")).otherwise(F.col("bfactor")))


def structure_yield(files: DataFrame, residues: DataFrame, key: str = "path") -> DataFrame:
    """Each structure and whether it gave a trace."""
    return files.select(key).join(residues.select(key).distinct().withColumn("parsed", F.lit(True)), key, "left").fillna(False, ["parsed"])


def structure_sequences(residues: DataFrame, key: str = "path") -> DataFrame:
    letters = F.create_map(*[F.lit(x) for pair in RESIDUES.items() for x in pair])
    one = residues.select(key, "idx", F.coalesce(letters[F.upper("resname")], F.lit("X")).alias("a"))
    return one.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "a"))), lambda x: x["a"]), "").alias("seq"))


def ca_string_to_residues(hits: DataFrame, key: str) -> DataFrame:
    """Residues from a comma list of coordinates (t_ca) and letters (t_seq); unknown and missing letters are GLY."""
    back = F.create_map(*[F.lit(x) for k, v in RESIDUES.items() if k != "MSE" for x in (v, k)])
    n = F.transform(F.split("t_ca", ","), lambda x: F.trim(x).try_cast("double"))
    rows = hits.select(key, "t_seq", n.alias("n")).where("size(n) >= 3")
    each = rows.select(key, "t_seq", "n", F.explode(F.expr("sequence(1, cast(size(n) div 3 as int))")).alias("idx"))
    at = lambda k: F.get("n", ((F.col("idx") - 1) * 3 + k).cast("int"))
    return each.select(key, "idx", at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), F.coalesce(back[F.upper(F.substr("t_seq", F.col("idx"), F.lit(1)))], F.lit("GLY")).alias("resname"))


def bfactor_profile(residues: DataFrame, key: str = "path") -> DataFrame:
    return residues.groupBy(key).agg(F.count("*").alias("n"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY bfactor DESC)").alias("median_bfactor"))


def read_metadata_delimited(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A table of strings; the delimiter is the one of , tab ; | that is most frequent in the first SNIFFED characters, a comma if there is
    none. Files are split among tasks, unless cells hold line breaks (multi_line)."""
    head, size = [], 0
    for r in spark.read.text(path).limit(SNIFFED_LINES).collect():
        head.append(r["value"][: SNIFFED - size])
        size += len(head[-1])
    text = "\n".join(head)
    sep = max(",\t;|", key=lambda c: (text.count(c), c == ","))
    return spark.read.csv(path, sep=sep, header=True, multiLine=multi_line)


def read_metadata_json(spark: SparkSession, path: str) -> DataFrame:
    """id and fields (map) from a list of objects, an object of objects or scalars by id, or one under taxa."""
    text = whole_files(spark, path).select(F.trim("text").alias("text"))
    is_list = F.col("text").startswith("[")
    listed = text.where(is_list).select(F.explode(F.from_json("text", "array<map<string,string>>")).alias("fields")).select(F.coalesce(F.col("fields")["id"], F.col("fields")["taxon_id"]).alias("id"), "fields")
    top = text.where(~is_list).select(F.from_json("text", "map<string,string>").alias("m")).select(F.explode(F.coalesce(F.from_json(F.col("m")["taxa"], "map<string,string>"), F.col("m"))).alias("id", "v"))
    keyed = top.select("id", F.when(F.col("v").startswith("{"), F.from_json("v", "map<string,string>")).otherwise(F.create_map(F.lit("value"), F.col("v"))).alias("fields"))
    return listed.unionByName(keyed)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hits from result files: one block a database, with a list of alignments, of which some have the list inside another.

    Files are parsed once, as variants, and fields read from them where they are; a field that is missing or of another kind is
    null. Files that hold no JSON give no hits and are told by unread_hits.
    """
    parsed = whole_files(spark, path).select("path", F.try_parse_json("text").alias("v"))
    listed = lambda v, at: F.try_variant_get(v, at, "array<variant>")
    block = parsed.select("path", F.explode(listed(F.col("v"), "$.results")).alias("b"))
    found = block.select("path", F.try_variant_get("b", "$.db", "string").alias("db"), listed(F.col("b"), "$.alignments").alias("rows"))
    inner = F.try_variant_get(F.get("rows", F.lit(0)), "$", "array<variant>")
    h = found.select("path", "db", F.posexplode(F.coalesce(inner, F.col("rows"))).alias("pos", "h"))
    fields = {"target": ("target", "string"), "evalue": ("eval", "double"), "prob": ("prob", "double"), "seq_id": ("seqId", "double"), "aln_length": ("alnLength", "int"), "q_len": ("qLen", "int"), "db_len": ("dbLen", "int"), "tax_id": ("taxId", "int"), "tax_name": ("taxName", "string"), "t_seq": ("tSeq", "string"), "t_ca": ("tCa", "string")}
    return h.select("path", "db", "pos", *[F.try_variant_get("h", f"$.{at}", kind).alias(name) for name, (at, kind) in fields.items()])


def unread_hits(spark: SparkSession, path: str) -> DataFrame:
    """path of the files that read_hits can't parse."""
    return whole_files(spark, path).where(F.try_parse_json("text").isNull()).select("path")


def read_cluster_tsv(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", schema="rep string, taxon_id string")
    return rows.select(*[F.regexp_replace(F.trim(c), STRUCTURE_SUFFIX, "").alias(c) for c in ("rep", "taxon_id")]).where("rep is not null and taxon_id is not null")


def read_pair_scores(spark: SparkSession, path: str, taxa: DataFrame) -> DataFrame:
    """a, b, score; rows that can't be read or name unknown taxa go."""
    rows = spark.read.csv(path, sep="\t", schema="a string, b string, score string").withColumn("score", F.col("score").try_cast("double")).where("score is not null")
    known = taxa.select("taxon_id")
    return rows.join(known.withColumnRenamed("taxon_id", "a"), "a", "left_semi").join(known.withColumnRenamed("taxon_id", "b"), "b", "left_semi")


def read_lddt_hits(spark: SparkSession, path: str) -> DataFrame:
    """target (name without folder and suffix), tm_to_query, lddt_to_query, lddt_aligned, t_start, t_end, q_start, q_end and track (values
    over the whole chain, null outside what is aligned) of rows of ten columns. Rows that can't be read go; of a target's rows in a file the last stays."""
    names = ["query", "target", "tm", "lddt", "values", "t_start", "t_end", "q_start", "q_end", "t_len"]
    rows = spark.read.csv(path, sep="\t", schema=", ".join(f"{n} string" for n in names)).select("*", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    number = lambda c, kind="int": F.trim(c).try_cast(kind)
    texts = F.filter(F.split("values", ","), lambda x: F.trim(x) != "")
    values = F.transform(texts, lambda x: number(x, "double"))
    length = F.coalesce(number("t_len"), number("t_end"))
    r = rows.select("path", "at", F.regexp_replace(F.regexp_extract("target", r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "").alias("target"), number("tm", "double").alias("tm_to_query"), number("lddt", "double").alias("lddt_to_query"), values.alias("lddt_aligned"), number("t_start").alias("t_start"), number("t_end").alias("t_end"), number("q_start").alias("q_start"), number("q_end").alias("q_end"), length.alias("length"))
    ok = r.where("tm_to_query is not null and lddt_to_query is not null and t_start is not null and t_end is not null and lddt_aligned is not null").where(~F.exists("lddt_aligned", F.isnull))
    last = ok.withColumn("k", F.row_number().over(Window.partitionBy("path", "target").orderBy(F.desc("at")))).where("k = 1")
    track = F.transform(F.when(F.col("length") > 0, F.sequence(F.lit(1), "length")).otherwise(F.array()), lambda i: F.when(i >= F.col("t_start"), F.get("lddt_aligned", i - F.col("t_start"))))
    return last.select("target", "tm_to_query", "lddt_to_query", "lddt_aligned", "t_start", "t_end", "q_start", "q_end", track.alias("track"))


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """tree_id, newick, one row a tree: Newick files hold one a line, NEXUS files trees with a translation of tip names. Patterns give
    nothing back that they took: else each character of a long tree takes a frame of the stack."""
    text = whole_files(spark, path)
    nexus = F.upper(F.ltrim("text")).startswith("#NEXUS")
    plain = text.where(~nexus).select("path", F.posexplode(F.regexp_extract_all("text", F.lit(r"((?:'[^']*+'|[^;']++)++;)"), F.lit(1))).alias("n", "newick"))
    listed = F.regexp_extract("text", r"(?is)translate\s+(.*?);", 1)
    pairs = F.filter(F.transform(F.split(listed, ","), lambda x: F.split(F.regexp_replace(x, r"^\s+|\s+$", ""), r"\s+", 2)), lambda x: F.size(x) == 2)
    found = text.where(nexus).select("path", F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.get(x, F.lit(0)), F.get(x, F.lit(1))))).alias("names"), F.posexplode(F.regexp_extract_all("text", F.lit(r"(?im)^\s*tree\s+[^=]*=\s*(?:\[[^\]]*\]\s*)*([^;]*;)"), F.lit(1))).alias("n", "newick"))
    tokens = F.regexp_extract_all("newick", F.lit(r"('(?:[^']++|'')*+'|[(),;:]|[^(),;:']+)"), F.lit(1))
    named = found.withColumn("newick", F.array_join(F.transform(tokens, lambda x: F.coalesce(F.try_element_at("names", F.trim(x)), x)), ""))
    every = plain.unionByName(named.select("path", "n", "newick"))
    return every.select(F.concat_ws("#", "path", "n").alias("tree_id"), F.regexp_replace("newick", r"^\s+", "").alias("newick"))


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    return trees.parse_newick(read_trees(spark, path))


def read_embeddings(spark: SparkSession, path: str, taxa: DataFrame | None = None) -> DataFrame:
    """taxon_id, vec, restricted to the taxa (taxon_id, ord) and in their order."""
    v = spark.read.parquet(path)
    return v if taxa is None else v.join(taxa, "taxon_id").orderBy("ord")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes and time of files below a folder, without their content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def dataset_catalog(files: DataFrame) -> DataFrame:
    """run, cluster, kind and alphabet of result files, the preferred one of each: foldmason before mafft."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    kind = F.when(name.rlike(r"\.(nwk|treefile|tree|nex)$"), "tree").when(name.rlike(r"\.(fa|fasta|aln)$"), "alignment").when(name.rlike(r"cluster.*\.tsv$"), "partition").when(name.rlike("silhouette"), "silhouette")
    known = files.withColumn("kind", kind).where("kind is not null").withColumn("run", F.regexp_extract("path", r"([^/]+)/(?:clusters/[^/]+/)?[^/]+$", 1)).withColumn("cluster", F.nullif(F.regexp_extract("path", r"/clusters/([^/]+)/", 1), F.lit(""))).withColumn("alphabet", F.when(name.contains("3di"), "3di").otherwise("aa"))
    rank = F.when(name.startswith("foldmason"), 0).when(name.startswith("mafft"), 1).otherwise(2)
    k = F.row_number().over(Window.partitionBy("run", "cluster", "kind", "alphabet").orderBy(rank, "path"))
    return known.withColumn("k", k).where("k = 1").drop("k")


#: Names of an aa alignment beside a 3di one, the first that is there counts.
PAIRED = ("mafft.fasta_aa.fa", "foldmason.fasta_aa.fa", "foldmason_aa.fa")


def paired_alignment(files: DataFrame) -> DataFrame:
    """path and aa_path of each 3di alignment: the first of PAIRED in its folder, or its own name with _aa for _3di, and never the file itself;
    null if there is none."""
    name, folder = F.element_at(F.split("path", "/"), -1), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    a = files.select("path", name.alias("name"), folder.alias("folder"))
    three = a.where("name like '%3di%'").withColumn("own", F.regexp_replace("name", r"_3di\.fa", "_aa.fa"))
    other = a.select("folder", F.col("path").alias("aa_path"), F.col("name").alias("aa_name"))
    rank = F.array_position(F.array(*map(F.lit, PAIRED), F.col("own")), F.col("aa_name"))
    met = three.join(other, "folder").where((rank > 0) & (F.col("aa_path") != F.col("path")))
    best = met.groupBy("path").agg(F.min_by("aa_path", rank).alias("aa_path"))
    return three.select("path").join(best, "path", "left")


def input_inventory(spark: SparkSession, path: str, with_content: bool = True) -> DataFrame:
    """files, bytes, extensions and a digest of contents, or of names and sizes for large inputs (contents aren't read then)."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    one = F.sha2("content", 256) if with_content else F.sha2(F.concat_ws(":", name, F.col("length").cast("string")), 256)
    each = b.select(name.alias("name"), "length", F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("ext"), one.alias("digest"))
    return each.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.array_sort(F.collect_set("ext")).alias("extensions"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "name", "digest"))), "\n"), 256).alias("digest"))


def artifact_inventory(declared: DataFrame, path: str) -> DataFrame:
    """declared outputs (path, and columns of their own) that exist below ``path``, with absolute path and bytes; contents aren't
    read. Paths are absolute, with or without the scheme of local files; missing and null ones give no row."""
    bare = F.regexp_replace("path", "^file:/+", "/")
    found = declared.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(bare.alias("path"), F.col("length").alias("bytes"))
    return declared.withColumn("path", bare).join(found, "path")


def provenance(files: DataFrame) -> DataFrame:
    """dataset (organisation/name), revision and subdir of files in a snapshot of a hub's cache; other paths give nulls."""
    pattern = r"^.*/huggingface/hub/datasets--([^/]+)--([^/]+)/snapshots/([0-9a-f]+)(?:/(.*))?/[^/]*$"
    part = lambda i: F.nullif(F.regexp_extract("path", pattern, i), F.lit(""))
    return files.select("path", F.when(part(1).isNotNull(), F.concat(part(1), F.lit("/"), part(2))).alias("dataset"), part(3).alias("revision"), part(4).alias("subdir"))


def residue_bundle(residues: DataFrame, tracks: DataFrame) -> DataFrame:
    """Residues with lddt by place, null outside; keyed by (dataset, taxon), so equal taxa of two runs stay apart."""
    t = tracks.select("dataset", "taxon", F.posexplode_outer("track").alias("p", "lddt")).select("dataset", "taxon", (F.col("p") + 1).alias("idx"), "lddt")
    return residues.join(t, ["dataset", "taxon", "idx"], "left")
