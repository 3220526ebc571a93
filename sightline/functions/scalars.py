"""Column expressions: coercion, keys, ordering, quantiles, losses, geometry. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# coercion -------------------------------------------------------------------------------------


def int_or(x: Column | str, default: int) -> Column:
    """Integer text, else the default."""
    return F.coalesce(c(x).try_cast("bigint"), F.lit(default).cast("bigint"))


def finite(x: Column | str) -> Column:
    """Number, null if unparsable, NaN or infinite."""
    v = c(x).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def truthy(x: Column | str, with_ok: bool = True) -> Column:
    """1, true, yes, y (and ok): the two vocabularies stay separate."""
    return F.coalesce(F.lower(F.trim(c(x))).isin(["1", "true", "yes", "y", *(["ok"] if with_ok else [])]), F.lit(False))


def first_filled(*names: Column | str) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c(n).cast("string"), F.lit("")) for n in names))


def split_values(x: Column | str) -> Column:
    return F.filter(F.transform(F.split(c(x), "[,\r\n]+"), lambda v: F.trim(v)), lambda v: v != "")


def canonical_number(x: Column | str) -> Column:
    """'0007' becomes '7'; other text stays."""
    return F.coalesce(c(x).try_cast("bigint").cast("string"), c(x))


def basename(x: Column | str) -> Column:
    return F.regexp_extract(F.replace(c(x), F.lit("\\"), F.lit("/")), r"([^/]*)$", 1)


def frame_id(x: Column | str, position: Column | str) -> Column:
    """Trailing digits of a file name's stem, else the position; as struct(id, source)."""
    digits = F.nullif(F.regexp_extract(basename(x), r"(\d+)(?:\.[A-Za-z0-9]+)?$", 1), F.lit(""))
    return F.struct(F.coalesce(digits.try_cast("bigint"), c(position).cast("bigint")).alias("id"), F.when(digits.isNotNull(), "name").otherwise("position").alias("source"))


def floor_div(a: Column | str, b: int) -> Column:
    """Floored division of whole numbers, exact over the whole bigint range."""
    x = c(a).cast("bigint")
    return F.call_function("div", x - F.pmod(x, F.lit(b)), F.lit(b)).cast("bigint")


def remap_corner(feature_id: Column | str, offset: int) -> Column:
    """tag * 4 + (corner + offset) mod 4, with floored division."""
    return floor_div(feature_id, 4) * 4 + F.pmod(c(feature_id) + offset, F.lit(4))


# ordering -------------------------------------------------------------------------------------


def natural_key(x: Column | str) -> Column:
    """Sort key that compares runs of digits as numbers of any length, digits before text."""
    runs = F.regexp_extract_all(c(x), F.lit(r"(\d+|\D+)"), 1)

    def key(t: Column) -> Column:
        number = F.regexp_like(t, F.lit(r"^\d"))
        digits = F.regexp_replace(t, "^0+(?=.)", "")
        return F.struct((~number).alias("text"), F.when(number, F.length(digits)).otherwise(0).alias("n"), F.when(number, digits).otherwise(t).alias("s"))

    return F.struct(F.transform(runs, key).alias("runs"), c(x).alias("raw"))


def numeric_first(x: Column | str) -> list[Column]:
    n = c(x).try_cast("bigint")
    return [n.isNull(), n, c(x)]


# losses and geometry --------------------------------------------------------------------------


def huber(r: Column | str, k: float) -> Column:
    a = F.abs(c(r))
    return F.when(a < k, 0.5 * a * a).otherwise(k * (a - 0.5 * k))


def tukey(r: Column | str, k: float) -> Column:
    a = F.abs(c(r))
    q = 1 - (a / k) * (a / k)
    return F.when(a < k, k * k / 6 * (1 - q * q * q)).otherwise(F.lit(k * k / 6))


def cauchy(r: Column | str, k: float) -> Column:
    q = c(r) / k
    return 0.5 * k * k * F.log1p(q * q)


def clip_norm(x: Column | str, y: Column | str, most: float) -> tuple[Column, Column]:
    n = F.sqrt(c(x) * c(x) + c(y) * c(y))
    f = F.when(n > most, most / n).otherwise(1.0)
    return c(x) * f, c(y) * f


def rotation_angle(trace: Column | str) -> Column:
    """Degrees, from a rotation matrix' trace."""
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (c(trace) - 1) / 2))))


def quaternion_trace(x, y, z, w) -> Column:
    """Trace of the matrix of a (not normalised) quaternion."""
    n = c(x) * c(x) + c(y) * c(y) + c(z) * c(z) + c(w) * c(w)
    return 4 * c(w) * c(w) / n - 1


def project(x: Column, y: Column, z: Column, p: dict[str, float]) -> tuple[Column, Column]:
    """Pinhole projection with rational radial (k1..k6) and tangential (p1, p2) distortion; null behind the camera."""
    g = lambda k: p.get(k, 0.0)
    u, v = F.when(z > 0, x / z), F.when(z > 0, y / z)
    r2 = u * u + v * v
    radial = (1 + r2 * (g("k1") + r2 * (g("k2") + r2 * g("k3")))) / (1 + r2 * (g("k4") + r2 * (g("k5") + r2 * g("k6"))))
    du = u * radial + 2 * g("p1") * u * v + g("p2") * (r2 + 2 * u * u)
    dv = v * radial + g("p1") * (r2 + 2 * v * v) + 2 * g("p2") * u * v
    return g("fx") * du + g("cx"), g("fy") * dv + g("cy")


def project_equidistant(x: Column, y: Column, z: Column, p: dict[str, float]) -> tuple[Column, Column]:
    """Fisheye projection with an odd polynomial of the angle (k1..k4)."""
    r = F.sqrt(x * x + y * y)
    t = F.atan2(r, z)
    t2 = t * t
    d = t * (1 + t2 * (p.get("k1", 0.0) + t2 * (p.get("k2", 0.0) + t2 * (p.get("k3", 0.0) + t2 * p.get("k4", 0.0)))))
    s = F.when(r > 1e-12, d / r).otherwise(1.0)
    return p["fx"] * s * x + p["cx"], p["fy"] * s * y + p["cy"]


def box_ratio(x: Column | str, y: Column | str, area: float) -> Column:
    """Bounding-box area of a group over the image's."""
    return (F.max(c(x)) - F.min(c(x))) * (F.max(c(y)) - F.min(c(y))) / area


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(cond, name) for cond, name in pairs)))


def range_list(x: Column | str) -> Column:
    """'0-3,7' as distinct integers in order of appearance; a descending range is an error."""

    def one(part: Column) -> Column:
        ends = F.split(part, "-")
        lo, hi = F.get(ends, F.lit(0)).cast("int"), F.coalesce(F.get(ends, F.lit(1)), F.get(ends, F.lit(0))).cast("int")
        return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi))).otherwise(F.raise_error(F.lit("descending range")).cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform(split_values(x), one)))
