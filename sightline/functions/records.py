"""Column expressions on names, times, numbers and layouts of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Residual columns by precedence, and the suffixes that also mark one.
RESIDUAL_KEYS = ("residual_px", "after_residual_px", "residual_norm_px", "reprojection_error_px", "reprojection_residual_px", "error_px", "norm_px", "after_error_px")
RESIDUAL_SUFFIXES = ("_residual_px", "_error_px", "_norm_px")
WORKERS = ("w1", "w2", "w3", "w4")


def padded(x: Column, width: int) -> Column:
    """A number with leading zeros; a longer one keeps all its digits."""
    s = x.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def first_suffix(*names: Column, default: str) -> Column:
    """The first suffix (with its dot) that one of the file names has; a leading dot makes none."""
    suffix = lambda n: F.nullif(F.regexp_extract(n, r"[^/\\.][^/\\]*?(\.[^./\\]+)$", 1), F.lit(""))
    return F.coalesce(*(suffix(n) for n in names), F.lit(default))


def machine(worker: Column, fallback: Column) -> Column:
    """The machine of a worker id: as it is if it ends in _D, its prefix if that is a known worker, else the id, with _D."""
    w = F.trim(F.coalesce(worker, F.lit("")))
    known = F.regexp_extract(w, f"^({'|'.join(WORKERS)})(?:_.*)?$", 1)
    return F.when(w == "", F.coalesce(fallback, F.lit(""))).when(w.endswith("_D"), w).when(known != "", F.concat(known, F.lit("_D"))).otherwise(F.concat(w, F.lit("_D")))


def side_level(label: Column) -> Column:
    """struct(side, level) of a label like 4-1; null for others."""
    part = lambda k: F.nullif(F.regexp_extract(label, r"^(\d+)-(\d+)$", k), F.lit("")).cast("int")
    return F.when(F.regexp_like(label, F.lit(r"^(\d+)-(\d+)$")), F.struct(part(1).alias("side"), part(2).alias("level")))


def label_map(text: Column) -> Column:
    """'4-1:8, 4-2:9' as a map of label to number; a later entry of a label wins."""
    entries = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    split = F.transform(entries, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).cast("int").alias("v")))
    keys = F.array_distinct(F.transform(split, lambda s: s["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(split, lambda s: s["k"] == k), -1)["v"]))


def every_third(xs: Column, first: int = 2) -> Column:
    return F.filter(xs, lambda _, i: i % 3 == first)


def points_of(flat: Column) -> Column:
    """A flat array as points of three; a length that three doesn't divide drops the rest."""
    n = F.floor(F.size(flat) / 3).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.slice(flat, k * 3 + 1, 3))).otherwise(F.array().cast("array<array<bigint>>"))


def fixed(x: Column, digits: int) -> Column:
    """With a fixed number of decimals; null is empty."""
    return F.when(x.isNull(), "").otherwise(F.format_string(f"%.{digits}f", x))


def stamp_ns(seconds: Column, nanos: Column) -> Column:
    return seconds.cast("bigint") * 1_000_000_000 + nanos.cast("bigint")


def capture_time(capture: Column) -> Column:
    """The time of a capture id like 2026_05_31-14_08_40; null for others."""
    return F.when(F.regexp_like(capture, F.lit(r"^\d{4}_\d{2}_\d{2}-\d{2}_\d{2}_\d{2}$")), F.try_to_timestamp(capture, F.lit("yyyy_MM_dd-HH_mm_ss")))


def direction_colour(x: Column, y: Column) -> tuple[Column, Column]:
    """Red and green of an error's direction (blue is 127)."""
    a = F.atan2(y, x)
    return 127 + 127 * F.sin(a), 127 + 127 * F.cos(a)


def magnitude_factor(x: Column, y: Column, most: float) -> Column:
    """An error's length over most, 1 at the most."""
    return F.least(F.lit(1.0), F.hypot(x, y) / most)


def residual_colour(residual: Column) -> Column:
    """0 to 1, logarithmic, 1 from ten pixels on; null and NaN are 0."""
    v = F.when(residual.isNull() | F.isnan(residual), 0.0).otherwise(residual)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.log1p(v) / F.log1p(F.lit(10.0))))


def luma(red: Column, green: Column, blue: Column) -> Column:
    return F.shiftright((77 * red + 150 * green + 29 * blue).cast("bigint"), 8)


def board_motion(now: tuple[Column, Column, Column], before: tuple[Column, Column, Column], width: int, height: int) -> Column:
    """Pixels between two views of a board (centre x, y, area): its centre's way and its change of scale; infinite without a board."""
    centre = F.hypot(now[0] - before[0], now[1] - before[1])
    scale = F.when((now[2] > 0) & (before[2] > 0), F.abs(F.log(now[2] / before[2])) * (0.25 * min(width, height))).otherwise(0.0)
    return F.when(now[0].isNull() | before[0].isNull(), float("inf")).otherwise(F.hypot(centre, scale))


def layout(width: Column, height: Column, cameras: int = 4) -> Column:
    """How a packed frame of four cameras is laid out, by its shape; other counts are single."""
    if cameras != 4:
        return F.lit("single")
    return F.when(height >= width * 3, "vertical4").when(width >= height * 3, "horizontal4").otherwise("grid2x2")


def tiles(name: Column, width: Column, height: Column) -> Column:
    """The tiles (left, top, right, bottom) of a layout, in camera order."""
    w, h = width.cast("int"), height.cast("int")
    box = lambda a, b, c, d: F.struct(*(x.cast("int").alias(n) for n, x in zip(("left", "top", "right", "bottom"), (a, b, c, d), strict=True)))
    o, tw, th, hw, hh = F.lit(0), F.floor(w / 4), F.floor(h / 4), F.floor(w / 2), F.floor(h / 2)
    vertical = F.array(*(box(o, th * k, w, th * (k + 1)) for k in range(4)))
    horizontal = F.array(*(box(tw * k, o, tw * (k + 1), h) for k in range(4)))
    grid = F.array(box(o, o, hw, hh), box(hw, o, w, hh), box(o, hh, hw, h), box(hw, hh, w, h))
    return F.when(name == "vertical4", vertical).when(name == "horizontal4", horizontal).when(name == "grid2x2", grid).otherwise(F.array(box(o, o, w, h)))


def feature_fields(feature: Column, faces: int, rows: int, columns: int, first_tag: int, stride: int) -> Column:
    """struct(tag, corner, face, row, column) of a target's feature id; null fields for ids outside it."""
    f = feature.cast("bigint")
    tag = F.floor(f / 4).cast("bigint")
    local = tag - first_tag
    face = F.floor(local / stride).cast("bigint")
    place = local - face * stride
    ok = (local >= 0) & (place < rows * columns) & (face < faces)
    named = {"tag": tag, "corner": F.pmod(f, F.lit(4)).cast("bigint"), "face": face, "row": F.floor(place / columns).cast("bigint"), "column": (place % columns).cast("bigint")}
    return F.struct(*(F.when(ok, v).alias(k) for k, v in named.items()))


def residual_column(columns: list[str]) -> str | None:
    """The first residual column that the table has."""
    return next((k for k in RESIDUAL_KEYS if k in columns), None)


def residual_value(columns: list[str]) -> Column:
    """struct(column, value): per row the first residual column with a finite number, named ones before those known by their suffix; nulls if none."""
    named = [k for k in RESIDUAL_KEYS if k in columns]
    known = [*named, *(k for k in columns if k not in named and k.lower().endswith(RESIDUAL_SUFFIXES))]
    value = lambda k: F.col(k).try_cast("double")
    good = lambda k: value(k).isNotNull() & ~F.isnan(value(k)) & (F.abs(value(k)) != float("inf"))
    none = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("value"))
    return F.coalesce(*(F.when(good(k), F.struct(F.lit(k).alias("column"), value(k).alias("value"))) for k in known), none)


def size_or(pair: Column, width: Column, height: Column, default_width: float, default_height: float) -> Column:
    """struct(width, height) from an array of two, else from two columns, else the default."""
    struct = lambda w, h: F.struct(w.alias("width"), h.alias("height"))
    a, b = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
    return F.when((a > 0) & (b > 0), struct(a, b)).when((width > 0) & (height > 0), struct(width, height)).otherwise(struct(F.lit(default_width), F.lit(default_height)))


def accepted_parameters(mode: Column, pose_accepted: Column, focal: Column, principal: Column, distortion: Column, limits: tuple[float, float, float]) -> Column:
    """struct(decision, reason): refined parameters are kept if the pose was accepted and no delta exceeds its limit; a limit that is not positive is off, that of distortion counts in mode per_camera_opencv5 only, and a null delta exceeds."""
    within = [F.coalesce(value <= most, F.lit(False)) if most > 0 else F.lit(True) for value, most in zip((focal, principal, distortion), limits, strict=True)]
    kept = within[0] & within[1] & ((mode != "per_camera_opencv5") | within[2])
    said = lambda decision, reason: F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))
    return (
        F.when(mode == "fixed", said("fixed_prior", "intrinsics_refine_mode_fixed"))
        .when(~F.coalesce(pose_accepted, F.lit(False)), said("pose_prior_intrinsics_prior", "pose_not_accepted"))
        .when(kept, said("accepted_refined", "passes_acceptance_gate"))
        .otherwise(said("rejected_to_prior", "intrinsic_delta_exceeds_acceptance_gate"))
    )


def session_reason(exists: Column, count: Column, contiguous: Column, short: Column, most_short: int) -> Column:
    """Why a session's camera is usable (ok, tail_trim_k) or not, by precedence."""
    return (
        F.when(~exists, "image_dir_missing")
        .when(count == 0, "no_images")
        .when(~F.coalesce(contiguous, F.lit(False)), "non_contiguous_or_missing_interior_frames")
        .when(short == 0, "ok")
        .when(short <= most_short, F.concat(F.lit("tail_trim_"), short.cast("string")))
        .otherwise("short_sequence_not_tail_trim")
    )


def tier(n: Column, strong: int, usable: int) -> Column:
    return F.when(n >= strong, "strong").when(n >= usable, "usable").when(n > 0, "weak").otherwise("inactive")
