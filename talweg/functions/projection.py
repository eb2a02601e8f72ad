"""Ellipsoidal polyconic projection (Snyder 1987, USGS Professional Paper 1395, section 18)."""

from __future__ import annotations

import numpy as np

# The reference systems in use and the parameters of EPSG:5880.
WGS84, SIRGAS2000, BRAZIL_POLYCONIC = 4326, 4674, 5880
GEOGRAPHIC = (WGS84, SIRGAS2000)
SEMI_MAJOR, INVERSE_FLATTENING = 6378137.0, 298.257222101
CENTRAL_MERIDIAN, FALSE_EASTING, FALSE_NORTHING = -54.0, 5000000.0, 10000000.0

_F = 1 / INVERSE_FLATTENING
_E2 = _F * (2 - _F)


def _meridian(phi):
    e4, e6 = _E2 * _E2, _E2**3
    return SEMI_MAJOR * (
        (1 - _E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * _E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * np.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * np.sin(4 * phi)
        - (35 * e6 / 3072) * np.sin(6 * phi)
    )


def polyconic(lonlat: np.ndarray) -> np.ndarray:
    lam = np.radians(lonlat[:, 0] - CENTRAL_MERIDIAN)
    phi = np.radians(lonlat[:, 1])
    sin = np.sin(phi)
    flat = np.abs(phi) < 1e-12
    safe = np.where(flat, 1.0, phi)
    radius = SEMI_MAJOR / np.sqrt(1 - _E2 * sin**2) / np.tan(safe)
    arc = lam * sin
    x = np.where(flat, SEMI_MAJOR * lam, radius * np.sin(arc))
    y = np.where(flat, 0.0, _meridian(phi) + radius * 2 * np.sin(arc / 2) ** 2)
    return np.stack([x + FALSE_EASTING, y + FALSE_NORTHING], axis=1)


def inverse_polyconic(xy: np.ndarray) -> np.ndarray:
    """Newton iteration on both coordinates of the forward projection."""
    x, y = xy[:, 0] - FALSE_EASTING, xy[:, 1] - FALSE_NORTHING
    phi = y / SEMI_MAJOR
    lam = x / (SEMI_MAJOR * np.maximum(np.cos(phi), 0.1))
    target = xy
    step = 1e-7
    for _ in range(12):
        here = np.stack([np.degrees(lam) + CENTRAL_MERIDIAN, np.degrees(phi)], axis=1)
        east, north = here.copy(), here.copy()
        east[:, 0] += np.degrees(step)
        north[:, 1] += np.degrees(step)
        base = polyconic(here)
        de, dn = (polyconic(east) - base) / step, (polyconic(north) - base) / step
        miss = target - base
        det = de[:, 0] * dn[:, 1] - dn[:, 0] * de[:, 1]
        lam = lam + (miss[:, 0] * dn[:, 1] - miss[:, 1] * dn[:, 0]) / det
        phi = phi + (miss[:, 1] * de[:, 0] - miss[:, 0] * de[:, 1]) / det
    return np.stack([np.degrees(lam) + CENTRAL_MERIDIAN, np.degrees(phi)], axis=1)
