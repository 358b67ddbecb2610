"""Surface geometry over vertex arrays (``ARRAY<STRUCT<x,y,z:DOUBLE>>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypercube.functions._cols import col


def rectangle(w, d, z) -> Column:
    """Horizontal w x d rectangle at height z, counter-clockwise from the origin."""
    zero = F.lit(0.0)
    w, d, z = col(w).cast("double"), col(d).cast("double"), col(z).cast("double")
    vertex = lambda x, y: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    return F.array(vertex(zero, zero), vertex(w, zero), vertex(w, d), vertex(zero, d))


def polygon_area(vertices) -> Column:
    """Area of a planar 3-D polygon by Newell's method: |sum v_i x v_{i+1}| / 2."""
    v = col(vertices)
    n = F.size(v)
    rotated = F.concat(F.slice(v, 2, n - 1), F.slice(v, 1, 1))
    cross = F.zip_with(v, rotated, lambda a, b: F.struct(
        (a["y"] * b["z"] - a["z"] * b["y"]).alias("nx"),
        (a["z"] * b["x"] - a["x"] * b["z"]).alias("ny"),
        (a["x"] * b["y"] - a["y"] * b["x"]).alias("nz")))
    zero = F.struct(F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(0.0).alias("nz"))
    total = F.aggregate(cross, zero, lambda acc, c: F.struct(
        (acc["nx"] + c["nx"]).alias("nx"), (acc["ny"] + c["ny"]).alias("ny"),
        (acc["nz"] + c["nz"]).alias("nz")))
    norm = F.sqrt(total["nx"] * total["nx"] + total["ny"] * total["ny"] + total["nz"] * total["nz"])
    return F.when(n >= 3, norm / F.lit(2.0)).otherwise(F.lit(0.0))


def mean_z(vertices) -> Column:
    """Mean of the vertex heights."""
    v = col(vertices)
    s = F.aggregate(v, F.lit(0.0), lambda acc, p: acc + p["z"].cast("double"))
    return F.when(F.size(v) > 0, s / F.size(v))
