"""Force-field lookups and pair energies as broadcast joins and column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockgrid.functions import fixed
from dockgrid.functions.scalars import coulomb, covalent_flag, lennard_jones
from dockgrid.storage import if_small, settle

C = F.col
RES = ("graph_id", "chain", "res_seq", "res_name")


def lookup_forcefield(atoms: DataFrame, topology: DataFrame, classes: DataFrame, patches: DataFrame, params: DataFrame) -> DataFrame:
    """atoms with type, charge, eps, sigma, eps14, sigma14.

    topology: res_name, atom_name, type, charge. classes: rule_no, class, res_name (or all), present, absent: the first rule that a residue's
    own atom names meet gives its class. patches: line_no, class, action, atom_name, type, charge: the last line for an atom wins;
    null fields leave the topology's value. params: type, eps, sigma, eps14, sigma14. Unknown atoms get charge and parameters 0.
    The four tables are dimensions of a force field (one row for an atom name of a residue kind).
    """
    residues = atoms.groupBy(*RES).agg(F.array_sort(F.collect_set("atom_name")).alias("names"))
    classed = residues.join(if_small(residue_classes(residues, classes)), ["res_name", "names"], "left").drop("names")
    last = patches.groupBy("class", "atom_name").agg(F.max_by("type", F.when(C("type").isNotNull(), C("line_no"))).alias("p_type"), F.max_by("charge", F.when(C("charge").isNotNull(), C("line_no"))).alias("p_charge"))
    out = atoms.join(if_small(topology.select("res_name", "atom_name", C("type").alias("t_type"), C("charge").alias("t_charge"))), ["res_name", "atom_name"], "left")
    out = out.join(classed, list(RES), "left").join(if_small(last), ["class", "atom_name"], "left").withColumn("type", F.coalesce("p_type", "t_type"))
    out = out.join(if_small(params), "type", "left").withColumn("charge", F.coalesce("p_charge", "t_charge", F.lit(0.0)))
    zero = {k: F.coalesce(C(k), F.lit(0.0)) for k in ("eps", "sigma", "eps14", "sigma14")}
    return out.withColumns(zero).select(*atoms.columns, "type", "charge", *zero)


def residue_classes(residues: DataFrame, classes: DataFrame) -> DataFrame:
    """res_name, names, class: of each kind of residue (res_name, sorted names) the class of the first rule that it meets, if any.

    A set-containment join: a rule is looked for under its rarest required name only (among the kinds), and verified there; rules without
    required names under none. So kinds are compared with rules that share their rarest name, not with all of them. Rules that ask the
    same count once. A rule for a residue or for all; null name lists are empty.
    """
    kinds = settle(residues.select("res_name", "names").distinct(), "kinds")
    empty = F.array().cast("array<string>")
    sorted_ = lambda c: F.array_sort(F.array_distinct(F.coalesce(C(c), empty)))
    rules = classes.select("rule_no", "class", C("res_name").alias("rule_res"), sorted_("present").alias("present"), sorted_("absent").alias("absent"))
    rules = settle(rules.groupBy("rule_res", "present", "absent").agg(F.min(F.struct("rule_no", "class")).alias("first")).select("rule_res", "present", "absent", "first"), "rules")
    often = kinds.select(F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    asked = rules.select("rule_res", "present", "absent", F.explode("present").alias("name")).join(if_small(often), "name", "left")
    rarest = asked.groupBy("rule_res", "present", "absent").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "name")).alias("key")).select("rule_res", "present", "absent", C("key")["name"].alias("key"))
    keyed = rules.filter(F.size("present") > 0).join(rarest, ["rule_res", "present", "absent"]).unionByName(rules.filter(F.size("present") == 0).withColumn("key", F.lit("")))
    found_under = kinds.select("res_name", "names", F.explode(F.concat("names", F.array(F.lit("")))).alias("key")).select("*", F.explode(F.array_distinct(F.array(F.coalesce("res_name", F.lit("all")), F.lit("all")))).alias("rule_res"))
    met = (F.size(F.array_intersect("present", "names")) == F.size("present")) & ~F.arrays_overlap("absent", "names")
    return found_under.join(if_small(keyed), ["key", "rule_res"]).filter(met).groupBy("res_name", "names").agg(F.min("first")["class"].alias("class"))


def nonbonded(pairs: DataFrame, same_chain: str = "l_chain = r_chain") -> DataFrame:
    """pairs with l_/r_ charge, eps, sigma, eps14, sigma14 and d: adds elec, vdw, covalent.

    Within a chain: 1-4 parameters below 4.2, no energy below 3.6. Both energies are null at distance 0.
    """
    same, d = F.expr(same_chain), C("d")
    main = lennard_jones(C("l_sigma"), C("l_eps"), C("r_sigma"), C("r_eps"), d)
    near = lennard_jones(C("l_sigma14"), C("l_eps14"), C("r_sigma14"), C("r_eps14"), d)
    gone = same & (d < fixed.SAME_13)
    return pairs.withColumns({"elec": F.when(gone, 0.0).otherwise(coulomb(C("l_charge"), C("r_charge"), d)), "vdw": F.when(gone, 0.0).when(same & (d < fixed.SAME_14), near).otherwise(main), "covalent": covalent_flag(d)})


def _side(atoms: DataFrame, p: str) -> DataFrame:
    return atoms.select("graph_id", *[C(c).alias(f"{p}_{c}") for c in ("chain", "res_seq", "res_name", "serial", "atom_name", "x", "y", "z", "charge", "eps", "sigma", "eps14", "sigma14")])


def _distance() -> Column:
    return F.sqrt(sum(((C(f"l_{k}") - C(f"r_{k}")) * (C(f"l_{k}") - C(f"r_{k}")) for k in "xyz"), F.lit(0.0)))


def edge_energy_atom(edges: DataFrame, atoms: DataFrame) -> DataFrame:
    """edges (graph_id, l_serial, r_serial) with d, elec, vdw, covalent; null energies where an end has no atom.

    Of atoms with equal (chain, residue, name) the last serial's values count. Self pairs keep null energies.
    """
    w = Window.partitionBy("graph_id", "chain", "res_seq", "res_name", "atom_name")
    vals = ("x", "y", "z", "charge", "eps", "sigma", "eps14", "sigma14")
    last = w.orderBy("serial").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    a = atoms.withColumns({k: F.last(k).over(last) for k in vals})
    both = edges.join(_side(a, "l"), ["graph_id", "l_serial"], "left").join(_side(a, "r"), ["graph_id", "r_serial"], "left").withColumn("d", F.when(C("l_serial") != C("r_serial"), _distance()))
    return nonbonded(both).select(*edges.columns, "d", "elec", "vdw", "covalent")


def edge_energy_residue(edges: DataFrame, atoms: DataFrame) -> DataFrame:
    """edges (graph_id, l_/r_ chain, res_seq, res_name) with dist (smallest), elec and vdw (sums over all atom pairs), covalent."""
    key = [f"{p}_{c}" for p in "lr" for c in ("chain", "res_seq", "res_name")]
    both = edges.join(_side(atoms, "l"), ["graph_id", *key[:3]]).join(_side(atoms, "r"), ["graph_id", *key[3:]]).withColumn("d", _distance())
    return nonbonded(both).groupBy("graph_id", *key).agg(F.min("d").alias("dist"), F.sum("elec").alias("elec"), F.sum("vdw").alias("vdw"), (F.min("d") < fixed.COVALENT).cast("double").alias("covalent"))
