"""Plane coordinates of a reference system to longitude and latitude.

Closed-form inverse projections on the ellipsoid, as column arithmetic. The
parameters of a system are numbers known to the driver and end up as literals.
Series are in the third flattening n up to n**4, good to well below 1e-9
degrees. Datum shifts are not applied.

Formulas: J. P. Snyder, Map Projections: A Working Manual (1987), and
C. F. F. Karney, Transverse Mercator with an accuracy of a few nanometers (2011).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

US_FOOT = 1200 / 3937
INTERNATIONAL_FOOT = 0.3048


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    f: float

    @property
    def n(self) -> float:
        return self.f / (2 - self.f)

    @property
    def e(self) -> float:
        return math.sqrt(self.f * (2 - self.f))

    @property
    def rectifying_radius(self) -> float:
        n = self.n
        return self.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)


GRS80 = Ellipsoid(6378137.0, 1 / 298.257222101)
WGS84 = Ellipsoid(6378137.0, 1 / 298.257223563)


def _conformal_latitude(ell: Ellipsoid, phi: float) -> float:
    s = math.sin(phi)
    return math.atan(math.sinh(math.atanh(s) - ell.e * math.atanh(ell.e * s)))


def _geodetic_latitude(ell: Ellipsoid, chi: Column) -> Column:
    n = ell.n
    series = [
        2 * n - 2 / 3 * n**2 - 2 * n**3 + 116 / 45 * n**4,
        7 / 3 * n**2 - 8 / 5 * n**3 - 227 / 45 * n**4,
        56 / 15 * n**3 - 136 / 35 * n**4,
        4279 / 630 * n**4,
    ]
    total = chi
    for j, d in enumerate(series, 1):
        total = total + F.sin(chi * (2.0 * j)) * d
    return total


@dataclass(frozen=True)
class Geographic:
    """Coordinates are degrees already."""

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        return x, y


@dataclass(frozen=True)
class WebMercator:
    radius: float = 6378137.0

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        lat = F.atan(F.exp(y / self.radius)) * 2 - math.pi / 2
        return F.degrees(x / self.radius), F.degrees(lat)


@dataclass(frozen=True)
class TransverseMercator:
    lon0: float
    lat0: float = 0.0
    k0: float = 0.9996
    x0: float = 500000.0
    y0: float = 0.0
    unit: float = 1.0
    ellipsoid: Ellipsoid = GRS80

    def _origin(self) -> float:
        n = self.ellipsoid.n
        alpha = [
            n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4,
            13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
            61 / 240 * n**3 - 103 / 140 * n**4,
            49561 / 161280 * n**4,
        ]
        chi = _conformal_latitude(self.ellipsoid, math.radians(self.lat0))
        return chi + sum(c * math.sin(2 * (j + 1) * chi) for j, c in enumerate(alpha))

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        n = self.ellipsoid.n
        beta = [
            n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - 1 / 360 * n**4,
            1 / 48 * n**2 + 1 / 15 * n**3 - 437 / 1440 * n**4,
            17 / 480 * n**3 - 37 / 840 * n**4,
            4397 / 161280 * n**4,
        ]
        scale = self.k0 * self.ellipsoid.rectifying_radius
        xi = (y * self.unit - self.y0) / scale + self._origin()
        eta = (x * self.unit - self.x0) / scale
        xi1, eta1 = xi, eta
        for j, b in enumerate(beta, 1):
            xi1 = xi1 - F.sin(xi * (2.0 * j)) * F.cosh(eta * (2.0 * j)) * b
            eta1 = eta1 - F.cos(xi * (2.0 * j)) * F.sinh(eta * (2.0 * j)) * b
        chi = F.asin(F.sin(xi1) / F.cosh(eta1))
        lon = F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + self.lon0
        return lon, F.degrees(_geodetic_latitude(self.ellipsoid, chi))


@dataclass(frozen=True)
class LambertConic:
    lat1: float
    lat2: float
    lat0: float
    lon0: float
    x0: float
    y0: float
    unit: float = 1.0
    ellipsoid: Ellipsoid = GRS80

    def _t(self, degrees: float) -> float:
        return math.tan(math.pi / 4 - _conformal_latitude(self.ellipsoid, math.radians(degrees)) / 2)

    def _m(self, degrees: float) -> float:
        s = math.sin(math.radians(degrees))
        return math.cos(math.radians(degrees)) / math.sqrt(1 - self.ellipsoid.e**2 * s * s)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        if self.lat1 == self.lat2:
            n = math.sin(math.radians(self.lat1))
        else:
            n = math.log(self._m(self.lat1) / self._m(self.lat2)) / math.log(
                self._t(self.lat1) / self._t(self.lat2)
            )
        radius = self.ellipsoid.a * self._m(self.lat1) / (n * self._t(self.lat1) ** n)
        rho0 = radius * self._t(self.lat0) ** n
        east = x * self.unit - self.x0
        north = F.lit(rho0) - (y * self.unit - self.y0)
        sign = math.copysign(1.0, n)
        rho = F.hypot(east, north)
        chi = F.lit(math.pi / 2) - F.atan(F.pow(rho / abs(radius), F.lit(1 / n))) * 2
        theta = F.atan2(east * sign, north * sign)
        return F.degrees(theta / n) + self.lon0, F.degrees(_geodetic_latitude(self.ellipsoid, chi))


Projection = Geographic | WebMercator | TransverseMercator | LambertConic

_REGISTERED: dict[int, Projection] = {}


def register_srs(code: int, projection: Projection) -> None:
    """Add a reference system by its EPSG code."""
    _REGISTERED[code] = projection


# Parameters of single systems.
for _code in (4019, 4258, 4269, 4326, 4612):
    register_srs(_code, Geographic())
for _code in (3785, 3857, 900913, 102100, 102113):
    register_srs(_code, WebMercator())
register_srs(2913, LambertConic(46.0, 44 + 20 / 60, 43 + 40 / 60, -120.5, 2500000.0001424, 0.0, INTERNATIONAL_FOOT))
register_srs(26943, LambertConic(38 + 26 / 60, 37 + 4 / 60, 36.5, -120.5, 2000000.0, 500000.0))
register_srs(3740, TransverseMercator(-123.0))
register_srs(3006, TransverseMercator(15.0))


def projection_for(srs: str | int) -> Projection:
    """Projection of ``EPSG:n`` or plain ``n``.

    Universal Transverse Mercator codes follow from their zone: WGS 84 north
    326zz and south 327zz, NAD83 269zz and ETRS89 258zz.
    """
    text = str(srs).strip()
    try:
        code = int(text[5:] if text.upper().startswith("EPSG:") else text)
    except ValueError:
        raise ValueError(f"bad reference system {srs!r}: only EPSG codes are understood") from None
    if code in _REGISTERED:
        return _REGISTERED[code]
    family, zone = divmod(code, 100)
    central = zone * 6.0 - 183.0
    if family == 326 and 1 <= zone <= 60:
        return TransverseMercator(central, ellipsoid=WGS84)
    if family == 327 and 1 <= zone <= 60:
        return TransverseMercator(central, y0=10000000.0, ellipsoid=WGS84)
    if (family == 269 and 1 <= zone <= 23) or (family == 258 and 28 <= zone <= 38):
        return TransverseMercator(central)
    raise ValueError(f"reference system {srs!r} is not known; add it with register_srs()")


def reproject(x: Column, y: Column, srs: str | int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees for plane coordinates."""
    return projection_for(srs).inverse(x, y)
