"""Contact-based binding affinity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dockgrid.functions import fixed
from dockgrid.functions.scalars import lookup
from dockgrid.operators.spatial import radius_join, relative_accessibility
from dockgrid.storage import stay_dealt

C = F.col
CHARACTER = {name: kind[0].upper() for kind, names in fixed.CHARACTER.items() for name in names}


def sided(atoms: DataFrame, side_a: str, side_b: str) -> DataFrame:
    """atoms of the chains named in two comma-separated lists, with side A or B."""
    a, b = ([x.strip() for x in s.split(",") if x.strip()] for s in (side_a, side_b))
    return atoms.withColumn("side", F.when(C("chain").isin(*a), "A").when(C("chain").isin(*b), "B")).filter(C("side").isNotNull())


def contact_class_counts(atoms: DataFrame, cutoff: float = 5.5) -> DataFrame:
    """Residue contacts across sides by character: CC, CP, CA, PP, PA, AA (P polar, A apolar, C charged) and total; atoms carry side."""
    cols = ["graph_id", "chain", "res_seq", "res_name", "x", "y", "z"]
    known = atoms.withColumn("kind", lookup(CHARACTER, "res_name"))
    a, b = (known.filter(C("side") == s).select(*cols, "kind") for s in "AB")
    res = [f"{p}_{c}" for p in "lr" for c in ("chain", "res_seq", "res_name")]
    pairs = radius_join(a, b, cutoff).select(C("l_graph_id").alias("graph_id"), *res, "l_kind", "r_kind").distinct()
    kind = F.array_join(F.array_sort(F.array("l_kind", "r_kind")), "")
    named = {"CC": "CC", "CP": "CP", "AC": "CA", "PP": "PP", "AP": "PA", "AA": "AA"}
    return pairs.groupBy("graph_id").agg(*[F.count_if(kind == k).alias(n) for k, n in named.items()], F.count("*").alias("total"))


def nis_percentages(residues: DataFrame, interface: DataFrame, least: float = 0.05) -> DataFrame:
    """Shares (percent) of apolar, charged and polar residues among exposed ones outside the interface.

    residues: graph_id, chain, res_seq, res_name, rel (relative accessibility); interface: graph_id, chain, res_seq.
    """
    free = residues.filter(C("rel") >= least).join(interface.select("graph_id", "chain", "res_seq").distinct(), ["graph_id", "chain", "res_seq"], "left_anti").withColumn("kind", lookup(CHARACTER, "res_name"))
    share = lambda k: (100 * F.avg(F.when(C("kind") == k, 1.0).otherwise(0.0)))
    return free.groupBy("graph_id").agg(share("A").alias("nis_apolar"), share("C").alias("nis_charged"), share("P").alias("nis_polar"))


def binding_affinity(df: DataFrame, celsius: float = 25.0) -> DataFrame:
    """delta_g (kcal/mol) of the counts and surface shares, and kd (mol/l)."""
    w = fixed.AFFINITY
    g: Column = F.lit(w["constant"]) + w["CC"] * C("CC") + w["CA"] * C("CA") + w["PP"] * C("PP") + w["PA"] * C("PA") + w["apolar"] * C("nis_apolar") + w["charged"] * C("nis_charged")
    return df.withColumn("delta_g", g).withColumn("kd", F.exp(C("delta_g") / F.lit(fixed.GAS * (celsius + 273.15))))


def affinity_batch(atoms: DataFrame, exposure: DataFrame | None, side_a: str, side_b: str, cutoff: float = 5.5, celsius: float = 25.0) -> DataFrame:
    """One row a structure, with status: ok, or fail and why (no atoms on a side, no contacts). exposure: residues with rel; without
    it the accessible areas of both sides together are computed and taken relative to the largest of each residue kind."""
    # Dealt by molecule before it is copied into cells: nothing here needs a serial, so a view's own dealing may be pruned away.
    stay_dealt(atoms.sparkSession)
    atoms = atoms.repartition("graph_id")
    both = sided(atoms, side_a, side_b)
    if exposure is None:
        exposure = relative_accessibility(both.drop("side"))
    here = atoms.select("graph_id").distinct().join(both.groupBy("graph_id").agg(F.size(F.collect_set("side")).alias("sides")), "graph_id", "left")
    counts = contact_class_counts(both, cutoff)
    cols = ["graph_id", "chain", "res_seq", "x", "y", "z"]
    a, b = (both.filter(C("side") == s).select(*cols) for s in "AB")
    near = radius_join(a, b, cutoff)
    inter = near.select(C("l_graph_id").alias("graph_id"), C("l_chain").alias("chain"), C("l_res_seq").alias("res_seq")).union(near.select("r_graph_id", "r_chain", "r_res_seq"))
    out = here.join(counts, "graph_id", "left").join(nis_percentages(exposure, inter), "graph_id", "left").fillna(0.0, ["nis_apolar", "nis_charged", "nis_polar"])
    error = F.when(F.coalesce("sides", F.lit(0)) < 2, "a side has no atoms").when(C("total").isNull(), "no contacts")
    return binding_affinity(out, celsius).withColumns({"status": F.when(error.isNull(), "ok").otherwise("fail"), "error": error}).drop("sides")
