"""Escape counts where neighbouring points are closer than double precision tells apart.

One orbit per view, that of its centre, is followed in whole numbers of fixed point. Every cell is followed by its
difference from that orbit alone, in double precision: with z = Z + d and c = C + e, d becomes (2 Z + d) d + e. When the difference outgrows
the sum, the cell starts along the orbit again from its beginning, with all of z as its difference, so no digit is lost.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np

#: Bits behind those that the width of a view asks for.
GUARD_BITS = 64


def fixed_bits(width: float) -> int:
    """Bits behind the point for a view of this width, and so many more that rounding stays out of sight."""
    return GUARD_BITS + max(0, -int(np.frexp(width)[1]))


def fixed(number: str, bits: int) -> int:
    """A decimal number as a multiple of 2^-bits, rounded down."""
    return int(Fraction(number) * (1 << bits) // 1)


def reference_orbit(center_re: str, center_im: str, width: float, max_iter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orbit points of the centre from 0 on, until one lies outside the circle of radius 2 or ``max_iter`` are known, as doubles, and how far
    their squared distances from 0 exceed 4: close to the circle, the points as doubles do not tell."""
    bits = fixed_bits(width)
    cr, ci = fixed(center_re, bits), fixed(center_im, bits)
    four = 4 << (2 * bits)
    zr = zi = 0
    re, im, over = [0.0], [0.0], [-4.0]
    for _ in range(max_iter):
        zr, zi = ((zr * zr - zi * zi) >> bits) + cr, ((zr * zi) >> (bits - 1)) + ci
        beyond = zr * zr + zi * zi - four
        re.append(zr / (1 << bits))  # whole numbers of any size are divided exactly, then rounded
        im.append(zi / (1 << bits))
        over.append(beyond / (1 << (2 * bits)))
        if beyond > 0:
            break
    return np.array(re), np.array(im), np.array(over)


def deep_steps(orbit_re: np.ndarray, orbit_im: np.ndarray, over: np.ndarray, away_re: np.ndarray, away_im: np.ndarray,
               max_iter: int) -> np.ndarray:
    """Escape counts of the points at these distances from the centre whose orbit is given; ``max_iter`` means "in the set"."""
    out = np.full(len(away_re), max_iter, np.int32)
    where, er, ei = np.arange(len(away_re)), away_re, away_im
    dr, di = np.zeros(len(where)), np.zeros(len(where))
    at = np.zeros(len(where), np.int64)
    last = len(orbit_re) - 1
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        for step in range(max_iter):
            sr, si = 2 * orbit_re[at] + dr, 2 * orbit_im[at] + di
            dr, di = sr * dr - si * di + er, sr * di + si * dr + ei
            at += 1
            pr, pi = orbit_re[at], orbit_im[at]
            zr, zi = pr + dr, pi + di
            apart = dr * dr + di * di
            gone = over[at] + (2 * (pr * dr + pi * di) + apart) > 0
            again = (zr * zr + zi * zi < apart) | (at == last)
            dr, di, at = np.where(again, zr, dr), np.where(again, zi, di), np.where(again, 0, at)
            if gone.any():
                out[where[gone]] = step
                live = ~gone
                where, er, ei, dr, di, at = where[live], er[live], ei[live], dr[live], di[live], at[live]
                if not len(where):
                    break
    return out
