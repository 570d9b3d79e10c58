"""The flagship plan: interface graphs of all molecules in one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockgrid.functions.scalars import atom_index, hydropathy, polarity_index, residue_index
from dockgrid.operators.energy import edge_energy_residue, lookup_forcefield, nonbonded
from dockgrid.operators.graph import attach_contact_areas, attach_regions, backbone, edge_orientation, index_edges, index_nodes, inject_embeddings, symmetrise, valid_nodes, valid_residues
from dockgrid.operators.spatial import areas as areas_of, bsa, contact_pairs, half_sphere_exposure, internal_pairs, own_pairs, residue_centroid, residue_depth
from dockgrid.storage import settle_dealt

C = F.col
FIELD = ("charge", "eps", "sigma", "eps14", "sigma14")
RESIDUE = ("graph_id", "chain", "res_seq", "res_name")


def build_graphs(
    atoms: DataFrame,
    cutoff: float = 5.0,
    internal: float = 3.0,
    *,
    grain: str = "atom",
    forcefield: tuple[DataFrame, DataFrame, DataFrame, DataFrame] | None = None,
    annotations: DataFrame | None = None,
    embeddings: DataFrame | None = None,
    areas: DataFrame | None = None,
    orientation: bool = False,
    exposure: float | None = None,
    surface: bool = False,
    with_edges: bool = True,
) -> dict[str, DataFrame]:
    """nodes and edges of every molecule, and failed (graph_id, error): molecules left out for a bad annotation.

    Contacts across chains (<= cutoff) give the nodes; interface edges join nodes across chains, internal edges nodes of one
    chain nearer than `internal`; both are stored in both directions with distance, energies and a covalent flag.
    grain 'atom': one node an atom (key: serial). grain 'residue': one node a residue (key: residue, chain.res_seq.res_name) at its
    centroid; distances are the smallest between atoms, energies sums over all atom pairs.

    forcefield: (topology, classes, patches, params) of lookup_forcefield; without it atoms carry charge, eps, sigma, eps14, sigma14
    (0 for unknown ones). annotations, embeddings, areas: tables of attach_regions, inject_embeddings (label graph_id.chain) and
    attach_contact_areas (u, v: node keys); each adds its columns if given. orientation: adds edge_orientation. exposure: the radius
    within which residue nodes get up and down counts. surface: adds bsa (the buried area of the node's residue) and, to residue nodes, depth
    (from the surface of the whole molecule); atoms carry radius or get it by element. with_edges: False leaves edges out of
    the result, for which nothing is done then but to find the contacts that make nodes. Atoms without a place or with a null key have no contacts, so are no nodes.
    """
    if grain not in ("atom", "residue"):
        raise ValueError(f"unknown grain: {grain}")
    if forcefield:
        atoms = settle_dealt(lookup_forcefield(atoms.drop("type", *FIELD), *forcefield), "atoms", by="graph_id")
    elif surface:
        # Read by contacts, pairs within chains and surfaces: dealt once.
        atoms = settle_dealt(atoms if with_edges or grain == "atom" else atoms.drop(*FIELD), "atoms", by="graph_id")
    failed = atoms.select("graph_id", F.lit(None).cast("string").alias("error")).limit(0)
    regions = None
    if annotations is not None:
        regions, failed = attach_regions(atoms.select("graph_id", "chain", "res_seq").distinct(), annotations)
        failed = settle_dealt(failed, "failed", by="graph_id")
        atoms = atoms.join(failed, "graph_id", "left_anti")
    nodes, found = (_atom_grain if grain == "atom" else _residue_grain)(atoms, cutoff, internal)
    edges = found() if with_edges else None
    if regions is not None:
        nodes = nodes.join(regions, ["graph_id", "chain", "res_seq"], "left")
    if embeddings is not None:
        nodes = inject_embeddings(nodes.withColumn("mol", C("graph_id").cast("string")), embeddings).drop("mol")
    if exposure is not None:
        # Places in the chain are by residue number; residues that share one go by name.
        placed = residue_centroid(atoms).withColumn("ord", F.row_number().over(Window.partitionBy("graph_id", "chain").orderBy("res_seq", "res_name")))
        counts = half_sphere_exposure(placed, exposure).join(placed.select(*RESIDUE, "ord"), ["graph_id", "chain", "ord"]).drop("ord")
        nodes = nodes.join(counts, list(RESIDUE), "left")
    if surface:
        # Nodes are what is in contact, and both read one surface.
        shown = areas_of(atoms)
        buried = bsa(atoms, cutoff=cutoff, touching=nodes.select(*RESIDUE).distinct(), surface=shown)
        nodes = nodes.join(buried, list(RESIDUE), "left").withColumn("bsa", F.coalesce("bsa", F.lit(0.0)))
        if grain == "residue":
            nodes = nodes.join(residue_depth(atoms, surface=shown), list(RESIDUE), "left")
    if edges is None:
        return {"nodes": nodes, "failed": failed}
    if areas is not None:
        # Joined in both directions: found once, and dealt by graph like the edges.
        areas = settle_dealt(areas, "areas", by="graph_id")
        edges = attach_contact_areas(edges, areas)
    if orientation:
        edges = edge_orientation(edges, backbone(atoms))
    return {"nodes": nodes, "edges": edges.drop("src", "dst", "s_chain", "s_res", "d_chain", "d_res"), "failed": failed}


def _encoded() -> dict:
    return {"res_type": residue_index("res_name"), "hydropathy": hydropathy("res_name"), "polarity": polarity_index("res_name")}


def _atom_grain(atoms: DataFrame, cutoff: float, internal: float) -> tuple[DataFrame, Callable[[], DataFrame]]:
    # Both are read by several branches below: written once, each branch scans the columns that it needs.
    contacts = settle_dealt(contact_pairs(atoms, cutoff), "contacts", by="graph_id")
    nodes = settle_dealt(index_nodes(valid_nodes(atoms, contacts)).withColumns({"atom_type": atom_index("atom_name"), **_encoded()}), "nodes", by="graph_id")

    def edges() -> DataFrame:
        within = internal_pairs(nodes.select("graph_id", "chain", "serial", "x", "y", "z"), internal)
        pairs = contacts.select("graph_id", C("l_serial").alias("src"), C("r_serial").alias("dst"), F.lit("interface").alias("edge_type"), "d2").unionByName(within.select("graph_id", C("l_serial").alias("src"), C("r_serial").alias("dst"), F.lit("internal").alias("edge_type"), "d2"))
        pairs = pairs.repartition("graph_id")  # a union hides how its parts are dealt
        # index_edges with what the energies need of the ends, in the same two joins. Edges of which an end is no node go.
        side = lambda p, end: nodes.select("graph_id", C("serial").alias(end), C("node_idx").alias(f"{end}_idx"), *[C(k).alias(f"{p}_{k}") for k in ("chain", "res_seq", *FIELD)])
        both = symmetrise(pairs, keys=("graph_id", "edge_type"))
        full = both.join(side("l", "src"), ["graph_id", "src"]).join(side("r", "dst"), ["graph_id", "dst"]).withColumn("d", F.sqrt("d2"))
        ends = [C("l_chain").alias("s_chain"), C("l_res_seq").alias("s_res"), C("r_chain").alias("d_chain"), C("r_res_seq").alias("d_res")]
        return nonbonded(full).select("graph_id", "src", "dst", "src_idx", "dst_idx", "edge_type", C("d").alias("dist"), "elec", "vdw", "covalent", *ends)

    return nodes, edges


def _residue_grain(atoms: DataFrame, cutoff: float, internal: float) -> tuple[DataFrame, Callable[[], DataFrame]]:
    atoms = atoms.withColumn("residue", F.concat_ws(".", "chain", "res_seq", "res_name"))
    ends = ("l_residue", "r_residue")
    contacts = settle_dealt(contact_pairs(atoms, cutoff, ident="residue").select("graph_id", *ends).distinct(), "contacts", by="graph_id")
    places = residue_centroid(atoms).withColumn("residue", F.concat_ws(".", "chain", "res_seq", "res_name"))
    nodes = settle_dealt(index_nodes(valid_residues(places, contacts), "residue").withColumns(_encoded()), "nodes", by="graph_id")

    def edges() -> DataFrame:
        own = atoms.join(nodes.select("graph_id", "residue"), ["graph_id", "residue"], "left_semi").select("graph_id", "chain", "residue", "x", "y", "z")
        within = own_pairs(own, internal, ("residue",), on=("graph_id", "chain"), strict=True).select(C("l_graph_id").alias("graph_id"), *ends).distinct()
        pairs = contacts.withColumn("edge_type", F.lit("interface")).unionByName(within.withColumn("edge_type", F.lit("internal")))
        pairs = pairs.select("graph_id", C("l_residue").alias("src"), C("r_residue").alias("dst"), "edge_type").repartition("graph_id")  # a union hides how its parts are dealt
        found = settle_dealt(index_edges(symmetrise(pairs, keys=("graph_id", "edge_type")), nodes, "residue"), "edges", by="graph_id")
        side = lambda p, end: nodes.select("graph_id", C("node_idx").alias(end), *[C(k).alias(f"{p}_{k}") for k in RESIDUE[1:]])
        named = found.join(side("l", "src_idx"), ["graph_id", "src_idx"]).join(side("r", "dst_idx"), ["graph_id", "dst_idx"])
        key = ["graph_id", *[f"{p}_{k}" for p in "lr" for k in RESIDUE[1:]]]
        scored = named.join(edge_energy_residue(named.select(*key), atoms), key)
        return scored.select("graph_id", "src", "dst", "src_idx", "dst_idx", "edge_type", "dist", "elec", "vdw", "covalent", C("l_chain").alias("s_chain"), C("l_res_seq").alias("s_res"), C("r_chain").alias("d_chain"), C("r_res_seq").alias("d_res"))

    return nodes, edges


def graph_summary(graphs: dict[str, DataFrame], of_nodes: list[Column] | None = None, of_edges: list[Column] | None = None) -> DataFrame:
    """One row a molecule: nodes, edges by type, smallest distance, sum of elec, edges with negative vdw; then more aggregates of nodes and of edges.

    Nodes and edges are read once, whatever is asked for."""
    e = graphs["edges"].groupBy("graph_id").agg(
        F.count_if(C("edge_type") == "interface").alias("n_interface"), F.count_if(C("edge_type") == "internal").alias("n_internal"), F.round(F.min("dist"), 4).alias("min_dist"), F.round(F.sum("elec"), 2).alias("sum_elec"), F.count_if(C("vdw") < 0).alias("n_attractive"), *(of_edges or [])
    )
    n = graphs["nodes"].groupBy("graph_id").agg(F.count("*").alias("n_nodes"), *(of_nodes or []))
    own, more = n.columns[:2], n.columns[2:]
    main, rest = e.columns[1:6], e.columns[6:]
    return n.join(e, "graph_id", "left").select(*own, *main, *more, *rest).fillna(0, ["n_interface", "n_internal", "n_attractive"])


def feature_summary(graphs: dict[str, DataFrame]) -> DataFrame:
    """graph_summary of whole graphs beside sums of what the optional tables gave: regions, embeddings, areas, orientation, exposure."""
    of_nodes = [F.count_if(C("region") == "AG").alias("n_antigen"), F.countDistinct("region").alias("n_regions"), F.round(F.sum("embedding"), 4).alias("sum_embedding")]
    of_nodes += [F.sum(k).alias(k) for k in ("up", "down") if k in graphs["nodes"].columns]
    o = C("orientation")
    of_edges = [F.round(F.sum("voro_area"), 2).alias("sum_area"), F.round(F.sum(o[0] + 2 * o[1] + 3 * o[2]), 1).alias("sum_orientation")]
    return graph_summary(graphs, of_nodes, of_edges)
