"""Radius joins over all molecules at once, and what is computed from neighbours.

A radius join is an equi-join on (molecule, grid cell): cells are twice as wide as the cutoff, the left side is copied into the cells
that its neighbourhood touches (eight at most), every right point has one cell. So no pair appears twice, a dense molecule spreads
over its cells, and the exact test on squared distances is a residual of the join.

Surfaces are sliced (Lee and Richards): each atom's extended sphere is cut by planes, and on the circles the arcs that lie in other
spheres are merged as intervals. What is left are the exposed arcs, from which areas and depths follow; no points are made.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from dockgrid.functions import fixed
from dockgrid.storage import settle, settle_dealt, stay_dealt

C = F.col


def _touched(column: str, cutoff: float) -> Column:
    """Numbers of the cells, twice as wide as the cutoff, that the neighbourhood of a coordinate touches: one or two."""
    return F.expr(f"sequence(floor(({column} - {cutoff}D) / {2 * cutoff}D), floor(({column} + {cutoff}D) / {2 * cutoff}D))")


def _cell(column: str, cutoff: float) -> Column:
    return F.expr(f"floor({column} / {2 * cutoff}D)")


def radius_join(left: DataFrame, right: DataFrame, cutoff: float, on: tuple[str, ...] = ("graph_id",), strict: bool = False, where: str | None = None) -> DataFrame:
    """Pairs of points (x, y, z) with equal keys `on` within the cutoff (strict: nearer than it): all columns, as l_* and r_*, and d2.

    Rows with a null key or coordinate have no neighbours. Molecules without rows give none.
    """
    a = left.select(*[C(c).alias(f"l_{c}") for c in left.columns])
    for k in "xyz":
        a = a.withColumn(f"cell_{k}", F.explode(_touched(f"l_{k}", cutoff)))
    b = right.select(*[C(c).alias(f"r_{c}") for c in right.columns]).select("*", *[_cell(f"r_{k}", cutoff).alias(f"at_{k}") for k in "xyz"])
    match = [C(f"l_{k}") == C(f"r_{k}") for k in on] + [C(f"cell_{k}") == C(f"at_{k}") for k in "xyz"]
    d = [C(f"l_{k}") - C(f"r_{k}") for k in "xyz"]
    d2 = d[0] * d[0] + d[1] * d[1] + d[2] * d[2]
    limit = cutoff * cutoff
    match.append(d2 < limit if strict else d2 <= limit)
    if where:
        match.append(F.expr(where))
    # The copied side has up to eight rows a point, which size estimates don't see: never broadcast it.
    both = a.hint("merge").join(b, match).withColumn("d2", d2)
    return both.drop(*[f"cell_{k}" for k in "xyz"], *[f"at_{k}" for k in "xyz"])


def own_pairs(points: DataFrame, cutoff: float, order: tuple[str, ...], on: tuple[str, ...] = ("graph_id",), strict: bool = False) -> DataFrame:
    """radius_join of points with themselves, each pair once: the one that comes first by `order` is left; points that are alike there are no pair.

    Points are copied only into the touched cells from their own on, which is half of them: of two points in different cells one
    meets the other, and the sides are set right afterwards.
    """
    a = points.select(*[C(c).alias(f"l_{c}") for c in points.columns]).select("*", *[_cell(f"l_{k}", cutoff).alias(f"own_{k}") for k in "xyz"])
    a = a.withColumn("cell_x", F.explode(F.expr(f"sequence(own_x, floor((l_x + {cutoff}D) / {2 * cutoff}D))")))
    for k in "yz":
        a = a.withColumn(f"cell_{k}", F.explode(_touched(f"l_{k}", cutoff)))
    a = a.filter("cell_x > own_x OR cell_y > own_y OR (cell_y = own_y AND cell_z >= own_z)")
    a = a.withColumn("_home", F.expr("cell_x = own_x AND cell_y = own_y AND cell_z = own_z")).drop(*[f"own_{k}" for k in "xyz"])
    b = points.select(*[C(c).alias(f"r_{c}") for c in points.columns]).select("*", *[_cell(f"r_{k}", cutoff).alias(f"at_{k}") for k in "xyz"])
    match = [C(f"l_{k}") == C(f"r_{k}") for k in on] + [C(f"cell_{k}") == C(f"at_{k}") for k in "xyz"]
    d = [C(f"l_{k}") - C(f"r_{k}") for k in "xyz"]
    d2 = d[0] * d[0] + d[1] * d[1] + d[2] * d[2]
    match.append(d2 < cutoff * cutoff if strict else d2 <= cutoff * cutoff)
    left, right = (C(f"{p}_{order[0]}") if len(order) == 1 else F.struct(*[C(f"{p}_{c}").alias(c) for c in order]) for p in "lr")
    match.append((left < right) | (~C("_home") & (left > right)))
    both = a.hint("merge").join(b, match)
    # Keys are equal on both sides; turned, they would hide how the rows are dealt.
    turned = [C(f"{p}_{c}") if c in on else F.when(left < right, C(f"{p}_{c}")).otherwise(C(f"{q}_{c}")).alias(f"{p}_{c}") for p, q in ("lr", "rl") for c in points.columns]
    return both.select(*turned, d2.alias("d2"))


def _dealt(atoms: DataFrame) -> DataFrame:
    """atoms dealt by molecule before they are copied into cells: what needs no serial prunes a view's own dealing away."""
    stay_dealt(atoms.sparkSession)
    return atoms.repartition("graph_id")


def contact_pairs(atoms: DataFrame, cutoff: float = 5.0, side: str = "chain", first: str = "A", second: str = "B", ident: str = "serial", keep: tuple[str, ...] = ()) -> DataFrame:
    """Cross-chain contacts of heavy atoms, distance <= cutoff: graph_id, l_/r_ of ident and keep, d2."""
    cols = ["graph_id", ident, *keep, "x", "y", "z"]
    heavy = atoms.filter(~C("atom_name").startswith("H")) if "atom_name" in atoms.columns else atoms
    a, b = (heavy.filter(C(side) == v).select(*cols) for v in (first, second))
    return radius_join(a, b, cutoff).select(C("l_graph_id").alias("graph_id"), *[C(f"{p}_{c}") for p in "lr" for c in (ident, *keep)], "d2")


def internal_pairs(nodes: DataFrame, cutoff: float = 3.0, ident: str = "serial", keep: tuple[str, ...] = ()) -> DataFrame:
    """Same-chain pairs nearer than cutoff, each once (smaller ident left)."""
    cols = ["graph_id", "chain", ident, *keep, "x", "y", "z"]
    n = nodes.select(*cols)
    return own_pairs(n, cutoff, (ident,), on=("graph_id", "chain"), strict=True).select(
        C("l_graph_id").alias("graph_id"), C("l_chain").alias("chain"), *[C(f"{p}_{c}") for p in "lr" for c in (ident, *keep)], "d2"
    )


def residue_contacts(atoms: DataFrame, cutoff: float = 5.0) -> DataFrame:
    """Residue pairs across chains of which some atoms are in contact: graph_id, l_/r_ of res_seq and res_name, d (the smallest distance)."""
    # The same columns on both sides, so that they are dealt once.
    keys = ("graph_id", "chain", "res_seq", "res_name", "x", "y", "z")
    dealt = _dealt(atoms.select(*keys, *[c for c in ("atom_name",) if c in atoms.columns]))
    pairs = contact_pairs(dealt, cutoff, ident="res_seq", keep=("res_name",))
    return pairs.groupBy("graph_id", "l_res_seq", "l_res_name", "r_res_seq", "r_res_name").agg(F.sqrt(F.min("d2")).alias("d"))


def residue_internal_pairs(atoms: DataFrame, cutoff: float = 3.0) -> DataFrame:
    """Residue pairs of one chain of which some atoms are nearer than cutoff, each once; d is the smallest distance."""
    cols = ["graph_id", "chain", "res_seq", "res_name", "x", "y", "z"]
    a = _dealt(atoms.select(*cols))
    pairs = own_pairs(a, cutoff, ("res_seq", "res_name"), on=("graph_id", "chain"), strict=True)
    return pairs.groupBy(C("l_graph_id").alias("graph_id"), C("l_chain").alias("chain"), "l_res_seq", "l_res_name", "r_res_seq", "r_res_name").agg(F.sqrt(F.min("d2")).alias("d"))


def residue_centroid(atoms: DataFrame) -> DataFrame:
    return atoms.groupBy("graph_id", "chain", "res_seq", "res_name").agg(*[F.avg(k).alias(k) for k in "xyz"], F.count("*").alias("n_atoms"))


def half_sphere_exposure(residues: DataFrame, radius: float = 12.0) -> DataFrame:
    """residues: graph_id, chain, ord, x, y, z (one point a residue). up, down: neighbours within radius above and below the
    plane whose normal is the sum of the directions from the residue's chain neighbours; (0, 0) where one is missing."""
    w = Window.partitionBy("graph_id", "chain").orderBy("ord")
    r = residues
    for k in "xyz":
        r = r.withColumn(f"n{k}", 2 * C(k) - F.lag(k).over(w) - F.lead(k).over(w))
    full = r.filter("nx IS NOT NULL")
    pairs = radius_join(full.select("graph_id", "chain", "ord", "x", "y", "z", "nx", "ny", "nz"), residues.select("graph_id", "chain", "ord", "x", "y", "z"), radius, strict=True, where="NOT (l_chain = r_chain AND l_ord = r_ord)")
    side = F.expr("l_nx * (r_x - l_x) + l_ny * (r_y - l_y) + l_nz * (r_z - l_z)")
    counts = pairs.groupBy(C("l_graph_id").alias("graph_id"), C("l_chain").alias("chain"), C("l_ord").alias("ord")).agg(F.count_if(side > 0).alias("up"), F.count_if(side <= 0).alias("down"))
    return residues.select("graph_id", "chain", "ord").join(counts, ["graph_id", "chain", "ord"], "left").fillna(0, ["up", "down"])


def element_radius(atoms: DataFrame, radii: dict[str, float] = fixed.RADII) -> DataFrame:
    """atoms with radius: that of the element, which is the first letter of the atom's name; of carbon for unknown ones."""
    names = [x for k, r in radii.items() for x in (F.lit(k), F.lit(r))]
    return atoms.withColumn("radius", F.coalesce(F.element_at(F.create_map(*names), F.upper(F.left(F.trim("atom_name"), F.lit(1)))), F.lit(radii["C"])))


#: Gaps of a circle that are narrower are none (radians).
_NARROW = 1e-9
_ARC = pa.struct([(c, pa.float64()) for c in ("dz", "rho", "s", "e")])


def _gaps(circle: np.ndarray, s: np.ndarray, e: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What hidden intervals s to e leave of -pi to pi on each circle: circles, starts and ends. whole: which circles are hidden altogether."""
    # Circles get stretches of 8 of one line, so that one sort and one running maximum serve all of them.
    line = s + 8 * circle
    order = np.argsort(line)
    circle, s, e = circle[order], line[order], (e + 8 * circle)[order]
    reached = np.maximum.accumulate(np.concatenate(([-np.inf], e)))[:-1] if len(e) else e
    before = np.maximum(reached, 8 * circle - np.pi)
    last = np.flatnonzero(circle != np.concatenate((circle[1:], [-1])))
    end = np.full(len(whole), -np.pi)  # how far each circle is hidden at least
    end[circle[last]] = np.maximum(before[last], e[last]) - 8 * circle[last]
    mid, rest = (s - before > _NARROW) & ~whole[circle], (np.pi - end > _NARROW) & ~whole
    at = circle[mid]
    return np.concatenate((at, np.flatnonzero(rest))), np.concatenate((before[mid] - 8 * at, end[rest])), np.concatenate((s[mid] - 8 * at, np.full(rest.sum(), np.pi)))


def _hidden(r: np.ndarray, owner: np.ndarray, dx: np.ndarray, dy: np.ndarray, dz: np.ndarray, other: np.ndarray, slices: int) -> tuple[np.ndarray, ...]:
    """Where spheres `other`, with centres (dx, dy, dz) away, hide circles of spheres of radius r.

    Circles hidden altogether and by which pair; circles hidden from an angle to an angle, and by which pair.
    """
    h = r[:, None] * ((2 * np.arange(slices) + 1) / slices - 1)
    # Only circles whose plane meets the other sphere.
    q = other[:, None] ** 2 - (dz[:, None] - h[owner]) ** 2
    pair, k = np.nonzero(q > 0)
    q, own = q[pair, k], owner[pair]
    d, rho, root = np.hypot(dx, dy)[pair], np.sqrt(r[own] ** 2 - h[own, k] ** 2), np.sqrt(q)
    circle = own * slices + k
    hides = d + rho <= root
    cuts = np.flatnonzero(~hides & (d < rho + root) & (d + root > rho))
    by, d, rho = pair[cuts], d[cuts], rho[cuts]
    half = np.arccos(np.clip((rho**2 + d**2 - q[cuts]) / (2 * rho * d), -1, 1))
    mid = np.arctan2(dy, dx)[by]
    at, s, e = circle[cuts], mid - half, mid + half
    low, high = s < -np.pi, e > np.pi  # these go on at the other end
    at, by = (np.concatenate((x, x[low], x[high])) for x in (at, by))
    starts = np.concatenate((np.maximum(s, -np.pi), s[low] + 2 * np.pi, np.full(high.sum(), -np.pi)))
    ends = np.concatenate((np.minimum(e, np.pi), np.full(low.sum(), np.pi), e[high] - 2 * np.pi))
    return circle[hides], pair[hides], at, starts, ends, by


def _meeting(cell: np.ndarray, mine: np.ndarray, graph: np.ndarray, serial: np.ndarray, x: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a row of mine, another row of its graph) of spheres that meet. cell: slab and place across it, as whole numbers of cells that are as wide as the reach."""
    # Cells of a column follow each other. Columns are hashed: those that fall together are told apart by the distance below.
    odd = np.array([[0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]], np.uint64)
    base = graph.astype(np.uint64) * odd[0, 2]

    def column(dx: int, dy: int, rows) -> np.ndarray:
        u = (cell[rows, 0] + dx).astype(np.uint64) * odd[0, 0] + (cell[rows, 1] + dy).astype(np.uint64) * odd[0, 1] + base[rows]
        u = (u ^ (u >> np.uint64(31))) * odd[0, 0]
        return (u >> np.uint64(2)).astype(np.int64) + cell[rows, 2]

    every = column(0, 0, slice(None))
    order = np.argsort(every, kind="stable")
    every = every[order]
    found = []
    for dx in (-1, 0, 1):
        for dy in (-1, 0, 1):
            at = column(dx, dy, mine)
            first = np.searchsorted(every, at - 1)
            n = np.searchsorted(every, at + 1, "right") - first
            i = np.repeat(mine, n)
            j = order[np.arange(len(i)) + np.repeat(first - np.cumsum(n) + n, n)]
            gap = x[j] - x[i]
            d2 = np.einsum("ij,ij->i", gap, gap)
            # Of spheres that are alike the one with the smallest serial hides the others.
            near = np.flatnonzero((d2 < (r[i] + r[j]) ** 2) & (graph[i] == graph[j]))
            i, j, d2 = i[near], j[near], d2[near]
            near = (serial[i] != serial[j]) & ~((d2 == 0) & (r[i] == r[j]) & (serial[j] > serial[i]))
            found.append((i[near], j[near]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


def _sliced(slices: int, width: float, alone: bool, whole: bool, with_arcs: bool, least: int = 20_000, most_rows: int = 2000):
    """Areas and arcs of spheres that come sorted by graph and slab (width of x each). Three slabs are held, and at least so many rows."""

    def of(part: pa.Table, mine: np.ndarray) -> pa.Table:
        """The rows mine of part, which holds all that may meet them."""
        get = lambda c: part.column(c).to_numpy()
        if "asked" in part.column_names:
            mine = mine[get("asked")[mine]]
            if not len(mine):
                return pa.table({})
        graph, chain = (np.asarray(part.column(c).combine_chunks().dictionary_encode().indices) for c in ("graph_id", "chain"))
        xyz, r = np.stack([get(k) for k in "xyz"], 1), get("r")
        cell = np.concatenate((get("slab")[:, None], np.clip(np.floor(xyz[:, 1:] / width), -(2.0**60), 2.0**60).astype(np.int64)), 1)
        i, j = _meeting(cell, mine, graph, get("serial"), xyz, r)
        areas, arcs = {n: [] for n, on in (("alone", alone), ("area", whole)) if on}, []
        for k in range(0, len(mine), most_rows):
            rows = mine[k : k + most_rows]
            a, b = np.searchsorted(i, rows[0]), np.searchsorted(i, rows[-1], "right")
            own, other, here = i[a:b], j[a:b], r[rows]
            gone, gone_by, at, s, e, by = _hidden(here, np.searchsorted(rows, own), *(xyz[other] - xyz[own]).T, r[other], slices)
            same = chain[own] == chain[other]
            for name, found in areas.items():
                all_ = np.zeros(len(rows) * slices, bool)
                if name == "alone":
                    all_[gone[same[gone_by]]] = True
                    kept = same[by]
                    shown, begin, end = _gaps(at[kept], s[kept], e[kept], all_)
                else:
                    all_[gone] = True
                    shown, begin, end = _gaps(at, s, e, all_)
                found.append(np.bincount(shown // slices, end - begin, len(rows)) * here * here * 2 / slices)
            if with_arcs:  # of the last kind asked for
                order = np.lexsort((begin, shown))
                shown, begin, end = shown[order], begin[order], end[order]
                h = (here[:, None] * ((2 * np.arange(slices) + 1) / slices - 1)).reshape(-1)[shown]
                fields = [pa.array(x) for x in (h, np.sqrt(here[shown // slices] ** 2 - h**2), begin, end)]
                places = pa.array(np.concatenate(([0], np.cumsum(np.bincount(shown // slices, minlength=len(rows))))), pa.int32())
                arcs.append(pa.ListArray.from_arrays(places, pa.StructArray.from_arrays(fields, fields=list(_ARC))))
        out = part.drop_columns([c for c in ("slab", "place", "asked") if c in part.column_names]).take(pa.array(mine))
        for name, found in areas.items():
            out = out.append_column(name, pa.array(np.concatenate(found)))
        return out.append_column("arcs", pa.chunked_array(arcs)) if with_arcs else out

    def run(batches):
        held, done, fresh = None, 0, 0  # rows held, how many of them are dealt with, how many came since the last turn
        for batch in batches:
            if not batch.num_rows:
                continue
            came = pa.Table.from_batches([batch])
            held = came if held is None else pa.concat_tables([held, came])
            fresh += batch.num_rows
            if fresh < least:
                continue
            held = held.combine_chunks()
            graph, slab = np.asarray(held.column("graph_id").combine_chunks().dictionary_encode().indices), held.column("slab").to_numpy()
            place, new = held.column("place").to_numpy(), graph[1:] != graph[:-1]
            if (place[1:] != np.where(new, 1, place[:-1] + 1)).any():
                raise RuntimeError("a molecule's atoms did not come in one sequence")
            starts = np.flatnonzero(new | (slab[1:] != slab[:-1])) + 1
            # The last slab may go on and the one before it meets what is to come.
            if len(starts) < 2 or starts[-2] <= done:
                fresh = 0
                continue
            until = int(starts[-2])
            yield from of(held, np.arange(done, until)).to_batches(max_chunksize=10_000)
            keep = int(starts[-3]) if len(starts) > 2 else 0
            held, done, fresh = held.slice(keep), until - keep, 0
        if held is not None and done < held.num_rows:
            yield from of(held.combine_chunks(), np.arange(done, held.num_rows)).to_batches(max_chunksize=10_000)

    return run


def _surfaces(atoms: DataFrame, probe: float, slices: int, kinds: tuple[str, ...], with_arcs: bool = False, of: DataFrame | None = None) -> DataFrame:
    """As exposed_arcs, with an area for each of kinds: 'area' in the graph, 'alone' in the chain; arcs are the last kind's.

    of: graph_id, serial (each once) of the atoms that get rows; all with a place or without one by default.
    """
    if "radius" not in atoms.columns:
        atoms = element_radius(atoms)
    real = F.expr(" AND ".join([f"abs({k}) < double('Infinity')" for k in (*"xyz", "radius")] + [f"{k} IS NOT NULL" for k in ("graph_id", *(["chain"] if "alone" in kinds else []), "serial")]))
    xyz = [C(k).cast("double").alias(k) for k in "xyz"]
    all_ = atoms.select("graph_id", "chain", "serial", "res_seq", "res_name", *xyz, (C("radius") + probe).cast("double").alias("r"), F.coalesce(real, F.lit(False)).alias("real"))
    placed = all_.filter("real").drop("real")
    width = 2 * (placed.agg(F.max("r")).first()[0] or 1.0) * (1 + 1e-9)
    fields = {f.name: f for f in placed.schema.fields}
    schema = T.StructType([*fields.values(), *[T.StructField(k, T.DoubleType()) for k in kinds]])
    if with_arcs:
        schema.add("arcs", T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("dz", "rho", "s", "e")])))
    dealt = placed.withColumn("slab", F.floor(C("x") / width))
    if of is not None:
        dealt = dealt.join(of.select("graph_id", "serial", F.lit(True).alias("asked")), ["graph_id", "serial"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    # The number makes Spark bring molecules whole to a task (they stay where they are dealt), slab by slab: no more than slabs are held.
    dealt = dealt.withColumn("place", F.row_number().over(Window.partitionBy("graph_id").orderBy("slab")))
    found = dealt.select(*fields, "slab", "place", *(["asked"] if of is not None else [])).mapInArrow(_sliced(slices, width, "alone" in kinds, "area" in kinds, with_arcs), schema)
    if of is not None:
        return found
    return found.unionByName(all_.filter(~C("real")).select(*fields, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[len(fields) :]]))


def exposed_arcs(atoms: DataFrame, probe: float = 1.4, slices: int = 20, by_chain: bool = False, with_arcs: bool = True) -> DataFrame:
    """graph_id, chain, serial, res_seq, res_name, x, y, z, r (extended radius), area and, with_arcs, arcs: array of (dz, rho, s, e); one row for each atom.

    Each sphere of radius + probe is cut by slices planes across z in equal steps; an arc is a stretch of angles s to e of the circle of
    radius rho at height dz above the centre that lies in no other sphere of the graph (by_chain: of its chain). Of spheres that
    are alike the one with the smallest serial hides the others. area: a slice of a sphere has that of its angle times the radius times
    its thickness. atoms carry radius, or get it by element. Atoms without a place, radius or key have null area and arcs and hide nothing.
    """
    found = _surfaces(atoms, probe, slices, ("alone" if by_chain else "area",), with_arcs)
    return found.withColumnRenamed("alone", "area")


def sasa(atoms: DataFrame, probe: float = 1.4, slices: int = 20, by_chain: bool = False) -> DataFrame:
    """Solvent-accessible area of each atom; null where it has no place or radius."""
    return exposed_arcs(atoms, probe, slices, by_chain, with_arcs=False).select("graph_id", "chain", "serial", "res_seq", "res_name", "area")


def areas(atoms: DataFrame, probe: float = 1.4, slices: int = 20) -> DataFrame:
    """What bsa and residue_depth read as their surface, found in one pass and written: atoms with r, alone and area, dealt by molecule."""
    return settle_dealt(_surfaces(atoms, probe, slices, ("alone", "area")), "areas", by="graph_id")


def bsa(atoms: DataFrame, probe: float = 1.4, slices: int = 20, cutoff: float = 5.0, touching: DataFrame | None = None, surface: DataFrame | None = None) -> DataFrame:
    """Buried area of contact residues: chain alone minus complex.

    touching: the contact residues (graph_id, chain, res_seq, res_name), if they are known; surface: areas of the atoms, if they are.
    """
    res = ["graph_id", "chain", "res_seq", "res_name"]
    if touching is None or surface is None:
        atoms = _dealt(atoms)
    if touching is None:
        # Both ends of a pair in one pass over the pairs.
        pairs = contact_pairs(atoms, cutoff, ident="res_seq", keep=("res_name",))
        ends = F.explode(F.array(*[F.struct(F.lit(side).alias("chain"), C(f"{p}_res_seq").alias("res_seq"), C(f"{p}_res_name").alias("res_name")) for p, side in (("l", "A"), ("r", "B"))]))
        touching = settle(pairs.select("graph_id", ends.alias("end")).select("graph_id", "end.*").distinct(), "touching", by="graph_id")
    both = (surface if surface is not None else _surfaces(atoms, probe, slices, ("alone", "area"))).join(touching.select(*res), res, "left_semi")
    return both.groupBy(*res).agg((F.sum("alone") - F.sum("area")).alias("bsa"))


def relative_accessibility(atoms: DataFrame, probe: float = 1.4, slices: int = 20, by_chain: bool = False, largest: dict[str, float] = fixed.LARGEST_AREA) -> DataFrame:
    """graph_id, chain, res_seq, res_name, area, rel: a residue's area over the largest of its kind; rel is null for unknown kinds."""
    names = [x for k, a in largest.items() for x in (F.lit(k), F.lit(a))]
    res = sasa(atoms, probe, slices, by_chain).groupBy("graph_id", "chain", "res_seq", "res_name").agg(F.sum("area").alias("area"))
    return res.withColumn("rel", C("area") / F.element_at(F.create_map(*names), C("res_name")))


def _to_arc(a: Column) -> Column:
    """Distance from (l_x, l_y, l_z) to an arc around (r_x, r_y, r_z): to the circle where the point's angle is on the arc, else to an end."""
    dx, dy, dz = (C(f"l_{k}") - C(f"r_{k}") for k in "xyz")
    rise = dz - a["dz"]
    angle = F.atan2(dy, dx)
    on = (angle >= a["s"]) & (angle <= a["e"])
    end = lambda t: F.sqrt(F.pow(dx - a["rho"] * F.cos(t), 2) + F.pow(dy - a["rho"] * F.sin(t), 2) + rise * rise)
    return F.when(on, F.sqrt(F.pow(F.hypot(dx, dy) - a["rho"], 2) + rise * rise)).otherwise(F.least(end(a["s"]), end(a["e"])))


def residue_depth(atoms: DataFrame, reach: float = 8.0, probe: float = 1.4, slices: int = 20, surface: DataFrame | None = None) -> DataFrame:
    """Mean over a residue's atoms of the distance to the graph's nearest exposed arc, however far; null where a graph has none.

    surface: areas of the atoms, if they are known.

    The surface lies in no sphere, so an atom with an arc of its own is as deep as its extended radius. For the buried ones the
    spheres within reach are asked, and within twice the reach as long as something nearer could be beyond it. Only spheres that are
    asked have their arcs made, and these are not written.
    """
    key = ["graph_id", "serial"]
    kept = (*key, "chain", "res_seq", "res_name", "x", "y", "z", "r", (C("area") > 0).alias("shown"))
    surface = surface.select(*kept) if surface is not None else settle_dealt(_surfaces(atoms, probe, slices, ("area",)).select(*kept), "surface", by="graph_id")
    buried = surface.filter("NOT shown").select(*key, "x", "y", "z")
    left = settle_dealt(buried.join(surface.filter("shown").select("graph_id").distinct(), "graph_id", "left_semi"), "buried", by="graph_id")
    depths = [surface.select(*key, C("r").alias("d")).limit(0)]
    if not left.isEmpty():
        widest = surface.agg(F.max(F.when(C("shown").isNotNull(), C("r")))).first()[0]
        reach = max(reach, 2 * widest)
        while not left.isEmpty():
            # r is the extended radius already.
            near = surface.filter("shown IS NOT NULL").join(left.select("graph_id").distinct(), "graph_id", "left_semi").withColumn("radius", C("r"))
            asked = radius_join(left, near.filter("shown").select(*key, "x", "y", "z"), reach).select(C("r_graph_id").alias("graph_id"), C("r_serial").alias("serial")).distinct()
            arcs = _surfaces(near, 0.0, slices, ("area",), True, asked).select("graph_id", "x", "y", "z", "r", "arcs")
            pairs = radius_join(left, arcs, reach)
            found = pairs.groupBy(C("l_graph_id").alias("graph_id"), C("l_serial").alias("serial")).agg(F.min(F.array_min(F.transform("r_arcs", _to_arc))).alias("d"))
            depths.append(settle(found.filter(C("d") <= reach - widest), "depth"))
            left = settle_dealt(left.join(depths[-1], key, "left_anti"), "deeper", by="graph_id")
            reach *= 2
    # Shown atoms need no join: their depth is in their row.
    deep = reduce(DataFrame.unionByName, depths)
    depth = surface.join(deep, key, "left").withColumn("d", F.when(C("shown"), C("r")).otherwise(C("d")))
    return depth.groupBy("graph_id", "chain", "res_seq", "res_name").agg(F.avg("d").alias("depth"))


def fnat(model: DataFrame, reference: DataFrame, on: tuple[str, ...] = ("graph_id",)) -> DataFrame:
    """Share of the reference's residue contacts that the model has; both: on, l_res_seq, r_res_seq."""
    keys = [*on, "l_res_seq", "r_res_seq"]
    hit = reference.select(*keys).distinct().join(model.select(*keys).distinct().withColumn("hit", F.lit(1.0)), keys, "left")
    return hit.groupBy(*on).agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("fnat"), F.count("*").alias("n_reference"))


def contact_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def superposed_rmsd(pairs: DataFrame, group: str = "graph_id") -> DataFrame:
    """RMSD after optimal superposition of points (x, y, z) on (rx, ry, rz), by group.

    Sums and cross-products are one aggregate; only the 3 x 3 decompositions run in a vectorised function.
    """
    sums = [F.sum(C(k)).alias(f"s_{k}") for k in ("x", "y", "z", "rx", "ry", "rz")]
    crossed = [F.sum(C(a) * C(b)).alias(f"c_{a}_{b}") for a in "xyz" for b in ("rx", "ry", "rz")]
    squares = F.sum(sum((C(k) * C(k) for k in ("x", "y", "z", "rx", "ry", "rz")), F.lit(0.0))).alias("squares")
    agg = pairs.groupBy(group).agg(F.count("*").alias("n"), *sums, *crossed, squares)

    @F.pandas_udf("double")
    def rmsd(f: pd.DataFrame) -> pd.Series:
        n = f["n"].to_numpy()[:, None].astype(float)
        a, b = (f[[f"s_{p}{k}" for k in "xyz"]].to_numpy() / n for p in ("", "r"))
        m = f[[f"c_{x}_{y}" for x in "xyz" for y in ("rx", "ry", "rz")]].to_numpy().reshape(-1, 3, 3) - n[:, :, None] * a[:, :, None] * b[:, None, :]
        u, s, vt = np.linalg.svd(m)
        sign = np.sign(np.linalg.det(u) * np.linalg.det(vt))
        total = f["squares"].to_numpy() - n[:, 0] * ((a**2).sum(1) + (b**2).sum(1))
        best = s[:, 0] + s[:, 1] + sign * s[:, 2]
        return pd.Series(np.sqrt(np.maximum(0.0, total - 2 * best) / n[:, 0]))

    return agg.select(group, "n", rmsd(F.struct(*[c for c in agg.columns if c != group])).alias("rmsd"))
