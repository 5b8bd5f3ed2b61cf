"""Spectral, thermal and radar indices: Columns in, Column out.

Every quotient is a ``try_divide`` so that a zero denominator gives NULL in
ANSI mode, and everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def norm_diff(a: ColumnLike, b: ColumnLike, eps: float = 0.0) -> Column:
    """(a - b) / (a + b [+ eps])."""
    a, b = _c(a), _c(b)
    den = a + b
    return F.try_divide(a - b, den + F.lit(eps) if eps else den)


def ndvi(nir: ColumnLike, red: ColumnLike, eps: float = 0.0) -> Column:
    return norm_diff(nir, red, eps)


def nbr(nir: ColumnLike, swir22: ColumnLike) -> Column:
    return norm_diff(nir, swir22)


def evi(
    nir: ColumnLike,
    red: ColumnLike,
    blue: ColumnLike,
    G: float = 2.5,
    C1: float = 6.0,
    C2: float = 7.5,
    L: float = 1.0,
    eps: float = 0.0,
) -> Column:
    nir, red, blue = _c(nir), _c(red), _c(blue)
    den = nir + F.lit(C1) * red - F.lit(C2) * blue + F.lit(L)
    if eps:
        den = den + F.lit(eps)
    return F.try_divide(F.lit(G) * (nir - red), den)


def savi(nir: ColumnLike, red: ColumnLike, L: float = 0.5) -> Column:
    nir, red = _c(nir), _c(red)
    return F.try_divide(F.lit(1.0 + L) * (nir - red), nir + red + F.lit(L))


def msavi(nir: ColumnLike, red: ColumnLike) -> Column:
    n, r = _c(nir), _c(red)
    b = F.lit(2.0) * n + F.lit(1.0)
    disc = b * b - F.lit(8.0) * (n - r)
    return F.when(disc >= 0, (b - F.sqrt(disc)) / F.lit(2.0))


def rvi(vv: ColumnLike, vh: ColumnLike) -> Column:
    """Radar vegetation index 4*VH / (VV + VH)."""
    vv, vh = _c(vv), _c(vh)
    return F.try_divide(F.lit(4.0) * vh, vv + vh)


def dprvi_vv(vv: ColumnLike, vh: ColumnLike) -> Column:
    """Dual-polarised radar vegetation index for VV/VH: the same quotient as RVI."""
    return rvi(vv, vh)


# Scale, offset and Kelvin-to-Celsius constants of the thermal product.
LST_SCALE, LST_OFFSET, KELVIN_ZERO = 0.00341802, 149.0, 273.15


def lst_celsius(lwir11: ColumnLike) -> Column:
    return _c(lwir11) * F.lit(LST_SCALE) + F.lit(LST_OFFSET) - F.lit(KELVIN_ZERO)


def to_db(v: ColumnLike) -> Column:
    """10*log10(v); NULL for non-positive power."""
    v = _c(v)
    return F.when(v > 0, F.lit(10.0) * F.log10(v))


def scale_int16(v: ColumnLike, k: float = 10000.0) -> Column:
    """Round v*k to a 16-bit integer, clamped to -32767..32767; -32768 stays free for nodata, NULL stays NULL."""
    scaled = F.round(_c(v) * F.lit(k))
    return F.when(scaled.isNotNull(), F.least(F.greatest(scaled, F.lit(-32767.0)), F.lit(32767.0))).cast("smallint")


def unscale(v: ColumnLike, k: float = 10000.0) -> Column:
    return _c(v).cast("double") / F.lit(k)


def reflectance(dn: ColumnLike, norm_factor: ColumnLike | float) -> Column:
    f = F.lit(norm_factor) if isinstance(norm_factor, (int, float)) else _c(norm_factor)
    return _c(dn).cast("double") * f


def threshold_class(v: ColumnLike, threshold: float) -> Column:
    return _c(v) > F.lit(threshold)


def gain_clip(v: ColumnLike, gain: float) -> Column:
    """Display stretch: v*gain clipped to 0..1."""
    scaled = _c(v) * F.lit(gain)
    return F.when(scaled.isNotNull(), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
