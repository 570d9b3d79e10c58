"""Scalar functions, all as native column expressions."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain as flat

from pyspark.sql import Column, functions as F

from dockgrid.functions import fixed

C = F.col


def _column(x: Column | str) -> Column:
    return C(x) if isinstance(x, str) else x


def lookup(values: dict, key: Column | str) -> Column:
    """values[key], null for other keys."""
    return F.try_element_at(F.create_map(*flat.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items())), _column(key))


def one_hot(index: Column | str, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == _column(index)).cast("double"))


def residue_index(name: Column | str) -> Column:
    return lookup({x: k for k, x in enumerate(fixed.RESIDUES)}, name)


def hydropathy(name: Column | str) -> Column:
    return lookup(fixed.HYDROPATHY, name)


def polarity_index(name: Column | str) -> Column:
    groups = (fixed.APOLAR, fixed.POLAR, fixed.NEGATIVE, fixed.POSITIVE)
    return lookup({x: k for k, names in enumerate(groups) for x in names}, name)


def atom_index(name: Column | str) -> Column:
    return lookup({x: k for k, x in enumerate(fixed.ATOMS)}, name)


def region_index(label: Column | str) -> Column:
    return lookup({x: k for k, x in enumerate(fixed.REGIONS)}, label)


def three_to_one(name: Column | str, unknown: str = "X") -> Column:
    return F.coalesce(lookup(fixed.ONE_LETTER, name), F.lit(unknown))


def distance2(a: str, b: str) -> Column:
    """Squared distance of the points a_x, a_y, a_z and b_x, b_y, b_z."""
    d = [C(f"{a}{k}") - C(f"{b}{k}") for k in "xyz"]
    return d[0] * d[0] + d[1] * d[1] + d[2] * d[2]


def distance(a: str, b: str) -> Column:
    return F.sqrt(distance2(a, b))


def coulomb(q1: Column, q2: Column, d: Column) -> Column:
    """Null at distance 0."""
    return F.lit(fixed.COULOMB) * q1 * q2 / F.nullif(d, F.lit(0.0))


def lennard_jones(s1: Column, e1: Column, s2: Column, e2: Column, d: Column) -> Column:
    """Mean sigma, geometric mean of epsilon; null at distance 0."""
    r6 = F.pow((s1 + s2) / 2 / F.nullif(d, F.lit(0.0)), 6)
    return 4 * F.sqrt(e1 * e2) * (r6 * r6 - r6)


def covalent_flag(d: Column | str) -> Column:
    return (_column(d) < fixed.COVALENT).cast("double")


def dist_transform(d: Column | str) -> Column:
    return F.tanh(-_column(d) / 2 + 2) + 1


def unit_vector(v: Column | str) -> Column:
    """v over its length plus 1e-6."""
    v = _column(v)
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)) + 1e-6
    return F.transform(v, lambda x: x / length)


def gaussian_rbf(d: Column | str, n: int = 18, low: float = 0.0, high: float = 30.0) -> Column:
    width, gap = (high - low) / n, (high - low) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.exp(-F.pow((_column(d) - (low + k * gap)) / (width + 1e-8), 2)))


def dockq(fnat: Column | str, lrmsd: Column | str, irmsd: Column | str) -> Column:
    return (_column(fnat) + 1 / (1 + F.pow(_column(irmsd) / 1.5, 2)) + 1 / (1 + F.pow(_column(lrmsd) / 8.5, 2))) / 3


def bin_class(irmsd: Column | str) -> Column:
    return _column(irmsd) < 4


def capri_class(irmsd: Column | str) -> Column:
    i = _column(irmsd)
    return F.when(i < 1, 1).when(i < 2, 2).when(i < 4, 3).when(i < 6, 4).when(i.isNotNull(), 5)


def quality_bin(score: Column | str) -> Column:
    s = _column(score)
    return F.when(s >= 0.49, "high").when(s >= 0.23, "med").when(s.isNotNull(), "low")


def higher_is_better(target: str) -> bool:
    return target.lower() in ("fnat", "bin_class", "dockq")


def binarize(value: Column | str, threshold: float, target: str) -> Column:
    """1 where the value is beyond the threshold on the good side of the target."""
    v = _column(value)
    return (v > threshold if higher_is_better(target) else v < threshold).cast("int")


def safe_div(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(_column(a).cast("double"), _column(b).cast("double"))


def imgt_region(position: Column | str, chain: str) -> Column:
    """chain: H or L; CONST outside the loops."""
    p, out = _column(position), F.lit("CONST")
    for k, (a, b) in fixed.LOOPS.items():
        out = F.when(p.between(a, b), f"{chain}{k}").otherwise(out)
    return out


def parse_job(prefix: Column | str) -> dict[str, Column]:
    """Job number, array index and the rest (node) of names like stage_12345_3_host; null where the pattern is missing."""
    p, pattern = _column(prefix), r"^(.*?)_(\d{5,})_(\d+)(?:_(.*))?$"
    get = lambda k: F.nullif(F.regexp_extract(p, pattern, k), F.lit(""))
    return {"job": get(2).cast("long"), "index": get(3).cast("int"), "node": get(4)}


def job_label(prefix: Column | str, strip: str = "") -> Column:
    """'idx=<index>  node=<node>' of names that end in _<job of five digits or more>_<index>_<node>; other names as they are. strip: what goes from nodes."""
    p, pattern = _column(prefix), r"_(\d{5,})_(\d+)_([^_]+)$"
    node = F.regexp_extract(p, pattern, 3)
    node = F.replace(node, F.lit(strip), F.lit("")) if strip else node
    return F.when(p.rlike(pattern), F.concat(F.lit("idx="), F.regexp_extract(p, pattern, 2), F.lit("  node="), node)).otherwise(p)


def slug(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_column(text), r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def elapsed_str(seconds: Column | str) -> Column:
    """5m07s below an hour, 2h05m from there."""
    s = F.floor(_column(seconds)).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h, m = F.floor(s / 3600), F.floor(s / 60)
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), two(F.floor(s % 3600 / 60)), F.lit("m"))).otherwise(F.concat(m.cast("string"), F.lit("m"), two(s % 60), F.lit("s")))


def short_host(host: Column | str, most: int = 16) -> Column:
    h = F.substring_index(_column(host), ".", 1)
    return F.when(F.length(h) > most, F.concat(F.substring(h, 1, most - 1), F.lit("~"))).otherwise(h)


def sigmoid(x: Column | str) -> Column:
    return 1 / (1 + F.exp(-_column(x)))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, with x computed once however often f uses it."""
    return F.transform(F.array(x), f)[0]


def softmax(values: Column | str) -> Column:
    v = _column(values)
    e = _bound(F.struct(v.alias("v"), F.array_max(v).alias("top")), lambda s: F.transform(s["v"], lambda x: F.exp(x - s["top"])))
    total = lambda e: F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda a, x: a + x).alias("total"))
    return _bound(e, lambda e: _bound(total(e), lambda s: F.transform(s["e"], lambda x: x / s["total"])))


def argmax(values: Column | str) -> Column:
    v = _column(values)
    return F.array_position(v, F.array_max(v)) - 1


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cross(a: Column, b: Column) -> Column:
    return F.array(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def project(v: Column, onto: Column) -> Column:
    """The part of v along the unit vector onto."""
    along = dot(v, onto)
    return F.transform(onto, lambda x: x * along)


def norm_chain(chain: Column | str, missing: tuple[str, ...] = ("", "none", "null", "-", "na")) -> Column:
    c = F.trim(_column(chain))
    return F.when(F.lower(c).isin(*missing), None).otherwise(c)


def clean_mol_id(name: Column | str) -> Column:
    return F.regexp_replace(_column(name), r"_model_\d+$", "")
