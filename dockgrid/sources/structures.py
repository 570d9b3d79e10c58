"""Structure files as tables: parsing fixed-width records, ensembles, sequences, numbering files, force fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dockgrid.sources.files import checked_files, hashed_files, list_files
from dockgrid.storage import settle

C = F.col


def discover(spark: SparkSession, root: str, suffix: str = "pdb", exclude: tuple[str, ...] = ("manifest", "_xray_tidy"), prefix: str | None = None, start: int = 0, limit: int | None = None, in_tasks: bool = False) -> DataFrame:
    """path, name, length, mtime of files below root, largest first; suffix in any case. in_tasks: folders are listed by list_files."""
    if in_tasks:
        files = list_files(spark, root, f".{suffix}", prefix).filter("error IS NULL").drop("error")
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", C("modificationTime").alias("mtime"))
        files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).filter(F.lower("name").endswith(f".{suffix.lower()}"))
    for x in exclude:
        files = files.filter(~C("name").contains(x))
    if prefix:
        files = files.filter(C("name").startswith(prefix))
    ordered = files.orderBy(C("length").desc(), "path")
    return ordered.offset(start).limit(limit) if limit is not None else ordered.offset(start) if start else ordered


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no, line of text files, read whole so that the order holds."""
    return lines_of(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value"))


def lines_of(whole: DataFrame) -> DataFrame:
    """path, line_no, line of files (path, value) held whole."""
    return whole.select("path", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def split_models(lines: DataFrame, always_number: bool = False) -> DataFrame:
    """Adds graph_id: the file's name, with _model_<k> for ensembles (or always)."""
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    is_model = C("line").startswith("MODEL ")
    numbered = lines.withColumn("model", F.sum(is_model.cast("int")).over(w)).withColumn("n_models", F.sum(is_model.cast("int")).over(Window.partitionBy("path")))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.(pdb|ent)$", "")
    k = F.greatest(C("model") - 1, F.lit(0)).cast("string")
    name = F.concat(stem, F.lit("_model_"), k)
    return numbered.withColumn("graph_id", name if always_number else F.when(C("n_models") > 1, name).otherwise(stem)).drop("n_models")


def _field(a: int, b: int) -> Column:
    return F.substring("line", a, b - a + 1)


def parse_atoms(lines: DataFrame) -> DataFrame:
    """ATOM and HETATM records of lines with graph_id; unparsable numbers are null."""
    t = lambda a, b: F.trim(_field(a, b))
    return lines.filter(F.substring("line", 1, 6).isin("ATOM  ", "HETATM")).select(
        "graph_id", "line_no", t(22, 22).alias("chain"), t(23, 26).try_cast("int").alias("res_seq"), t(18, 20).alias("res_name"), F.nullif(t(27, 27), F.lit("")).alias("icode"),
        (F.substring("line", 1, 6) == "HETATM").alias("het"), t(7, 11).try_cast("int").alias("serial"), t(13, 16).alias("atom_name"), t(77, 78).alias("element"),
        t(31, 38).try_cast("double").alias("x"), t(39, 46).try_cast("double").alias("y"), t(47, 54).try_cast("double").alias("z"),
    )


def cure_lines(lines: DataFrame) -> DataFrame:
    """Without terminal oxygens and hydrogens; other records pass."""
    atom = F.substring("line", 1, 6).isin("ATOM  ", "HETATM")
    return lines.filter(~(atom & ((_field(13, 16) == " OXT") | (F.trim(_field(77, 78)) == "H"))))


def read_pdb(spark: SparkSession, path: str, cure: bool = True) -> DataFrame:
    lines = split_models(read_lines(spark, path))
    return parse_atoms(cure_lines(lines) if cure else lines)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """label, mol, role, sequence; empty sequences are skipped, role is the label's last character."""
    rec = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    label = F.trim(F.regexp_extract("value", r"^([^\r\n]*)", 1))
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", "")
    return rec.select(label.alias("label"), F.regexp_replace(label, r"\.[^.]*$", "").alias("mol"), F.right(label, F.lit(1)).alias("role"), seq.alias("sequence")).filter("sequence <> ''")


def write_fasta(sequences: DataFrame, path: str) -> None:
    """sequences: mol, chain, sequence; empty ones are skipped."""
    sequences.filter("sequence <> ''").select(F.concat(F.lit(">"), "mol", F.lit("."), "chain", F.lit("\n"), "sequence").alias("value")).write.text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """label, mol, chain, length, sequence from tab-separated files with a header; label and sequence are required."""
    df = spark.read.csv(path, sep="\t", header=True)
    if missing := [c for c in ("label", "sequence") if c not in df.columns]:
        raise ValueError(f"manifest without {', '.join(missing)}")
    length = F.coalesce(C("length").try_cast("int"), F.length("sequence")) if "length" in df.columns else F.length("sequence")
    mol, chain = F.regexp_extract("label", r"^(.*)\.([^.]*)$", 1), F.regexp_extract("label", r"^(.*)\.([^.]*)$", 2)
    return df.filter(F.trim(F.coalesce("label", F.lit(""))) != "").select("label", mol.alias("mol"), chain.alias("chain"), length.alias("length"), "sequence")


def write_manifest(sequences: DataFrame, path: str) -> None:
    sequences.select("label", "mol", "chain", F.length("sequence").alias("length"), "sequence").write.csv(path, sep="\t", header=True, compression="gzip")


def _values(words: Column, key: str) -> Column:
    """What follows 'key =' among words (the '=' stands for itself); null if the key is not there."""
    at = F.array_position(F.transform(words, F.lower), key)
    return F.when((at > 0) & (F.try_element_at(words, (at + 1).cast("int")) == "="), F.try_element_at(words, (at + 2).cast("int")))


def read_topology(spark: SparkSession, path: str) -> DataFrame:
    """res_name, atom_name, type, charge of lines '<res> atom <name> key = value ... end'; other lines and comments are left out."""
    words = F.split(F.trim(F.regexp_replace("value", "=", " = ")), " +|\t+")
    line = spark.read.text(path).select(words.alias("w")).filter((F.size("w") > 4) & (C("w")[1] == "atom") & F.array_contains(F.transform("w", F.lower), "end"))
    named = line.filter((F.length(C("w")[0]) == 3) & (F.length(C("w")[2]) <= 4) & ~F.left(C("w")[0], F.lit(1)).isin("#", "!") & (F.upper(C("w")[0]) == C("w")[0]))
    return named.select(C("w")[0].alias("res_name"), C("w")[2].alias("atom_name"), _values(C("w"), "type").alias("type"), _values(C("w"), "charge").try_cast("double").alias("charge"))


def _strict(line: Column, pattern: str, what: str) -> Column:
    """line, or an error naming the line that does not match."""
    return F.when(line.rlike(pattern), line).otherwise(F.raise_error(F.concat(F.lit(f"unparsable {what} line: "), line)))


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """line_no, class, action, atom_name, type, charge of lines '<class> <modify|add> atom <name> [key = value ...] end'; others are errors."""
    p = r"(?i)^([A-Z0-9]{3,4})\s+(modify|add)\s+atom\s+([A-Z0-9]{1,4})\b(.*)$"
    line = read_lines(spark, path).select("line_no", F.trim("line").alias("line")).filter((C("line") != "") & ~C("line").rlike("^[#!]")).select("line_no", _strict(C("line"), p, "patch").alias("line"))
    value = lambda key: F.nullif(F.regexp_extract("rest", rf"(?i)\b{key}\s*=\s*([^\s()]+)", 1), F.lit(""))
    got = line.select("line_no", F.regexp_extract("line", p, 1).alias("class"), F.lower(F.regexp_extract("line", p, 2)).alias("action"), F.regexp_extract("line", p, 3).alias("atom_name"), F.regexp_extract("line", p, 4).alias("rest"))
    return got.select("line_no", "class", "action", "atom_name", value("type").alias("type"), value("charge").try_cast("double").alias("charge"))


def read_residue_classes(spark: SparkSession, path: str) -> DataFrame:
    """rule_no, class, res_name (or all), present, absent of lines '<class>: name=<res> present(A, B) absent(C)'."""
    head, body = F.trim(F.substring_index("line", ":", 1)), F.trim(F.substring_index("line", ":", -1))
    res = F.trim(F.substring_index(F.split(body, "present|absent")[0], "=", -1))

    def names(kind: str) -> Column:
        lists = F.transform(F.slice(F.split(body, kind), 2, 1000), lambda x: F.split(F.substring_index(F.substring_index(x, ")", 1), "(", -1), ","))
        return F.filter(F.transform(F.flatten(lists), lambda x: F.trim(x)), lambda x: x != "")

    rules = read_lines(spark, path).filter(C("line").contains(":") & F.startswith(body, F.lit("name")) & F.length(head).between(3, 4) & (F.upper(head) == head) & (F.length(res) == 3))
    return rules.select(C("line_no").alias("rule_no"), head.alias("class"), res.alias("res_name"), names("present").alias("present"), names("absent").alias("absent"))


def read_lj_params(spark: SparkSession, path: str) -> DataFrame:
    """type, eps, sigma, eps14, sigma14 of lines 'NONBonded <type> <four numbers>'; other lines are errors."""
    p = r"^NONBonded\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)$"
    line = spark.read.text(path).select(F.trim("value").alias("line")).filter((C("line") != "") & ~C("line").startswith("#")).select(_strict(C("line"), p, "parameter").alias("line"))
    return line.select(F.regexp_extract("line", p, 1).alias("type"), *[F.regexp_extract("line", p, k + 2).cast("double").alias(n) for k, n in enumerate(("eps", "sigma", "eps14", "sigma14"))])


def read_region_json(spark: SparkSession, path: str) -> DataFrame:
    """graph_id, ord (from 1), aa, label of JSON {model: [[aa, label], ...]}; .pdb goes from names."""
    m = F.from_json("value", "map<string, array<array<string>>>")
    # Files hold one object over several lines, or objects that each begin a line.
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n(?=\{)")).alias("value"))
    rows = whole.select(F.explode(m).alias("name", "marks")).select("name", F.posexplode("marks").alias("pos", "mark"))
    return rows.select(F.regexp_replace("name", r"\.pdb$", "").alias("graph_id"), (C("pos") + 1).alias("ord"), C("mark")[0].alias("aa"), C("mark")[1].alias("label"))


def write_region_json(regions: DataFrame, path: str) -> None:
    """One JSON object a line and model, as read_region_json reads them."""
    marks = F.transform(F.array_sort(F.collect_list(F.struct("ord", "aa", "label"))), lambda x: F.array(x["aa"], x["label"]))
    regions.groupBy("graph_id").agg(marks.alias("m")).select(F.to_json(F.create_map("graph_id", "m")).alias("value")).write.text(path)


def verify_checksums(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """expected: name, sha256. name, sha256, found, ok for each expected file, one row each.

    ok: some file of the name below path has the hash, and found is that; otherwise found is the smallest hash of the name, if any. Files
    are listed and hashed in tasks. Names that many files share are never paired with each other.
    """
    got = settle(hashed_files(list_files(spark, path)).filter("sha256 IS NOT NULL").select("name", C("sha256").alias("found")).distinct(), "hashes")
    first = got.groupBy("name").agg(F.min("found").alias("_first"))
    both = expected.join(got.withColumn("sha256", C("found")), ["name", "sha256"], "left").join(first, "name", "left")
    return both.select("name", "sha256", F.coalesce("found", "_first").alias("found"), C("found").isNotNull().alias("ok"))


def drop_bad_sources(spark: SparkSession, path: str, suffix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Files below path that can be read (path, length), and the others (path, length, error): empty, damaged, or links to nothing.

    Folders are listed and files are opened in tasks; what is found is a table, so no path goes through the driver.
    """
    found = settle(checked_files(list_files(spark, path, suffix)), "checked")
    return found.filter("error IS NULL").select("path", "length"), found.filter("error IS NOT NULL")
