"""Tiles as byte images: the array forms of the pixel operators, for writers that hold a tile."""

from __future__ import annotations

import numpy as np


def _limits(band: np.ndarray, low: float, high: float) -> tuple[float, float] | None:
    values = band[np.isfinite(band)]
    return None if values.size == 0 else tuple(float(v) for v in np.percentile(values, [low, high]))


def stretch(bands: np.ndarray, low: float = 2.0, high: float = 98.0) -> np.ndarray:
    """(bands, height, width) to bytes by percentiles, truncated; a constant band is 255 if positive, else 0."""
    out = np.zeros(bands.shape, np.uint8)
    for n, band in enumerate(bands.astype(np.float64)):
        limits = _limits(band, low, high)
        if limits is None:
            continue
        lo, hi = limits
        if hi <= lo:
            out[n] = 255 if band[np.isfinite(band)][0] > 0 else 0
        else:
            out[n] = np.nan_to_num(np.clip((band - lo) * 255.0 / (hi - lo), 0, 255), nan=0.0).astype(np.uint8)
    return out


def rgb(bands: np.ndarray, chosen: tuple[int, int, int] = (0, 1, 2), low: float = 2.0, high: float = 98.0) -> np.ndarray:
    """Three display bands; under three bands the first one as grey. A band that is not there is an error."""
    bands = bands[np.newaxis] if bands.ndim == 2 else bands
    if bands.ndim != 3:
        raise ValueError(f"expected (bands, height, width), got {bands.shape}")
    if bands.shape[0] < 3:
        return np.repeat(stretch(bands[:1], low, high), 3, axis=0)
    if any(not 0 <= b < bands.shape[0] for b in chosen):
        raise ValueError(f"display bands {chosen} of {bands.shape[0]}")
    return stretch(bands[list(chosen)], low, high)


def rgba(bands: np.ndarray, alpha: int = 3, chosen: tuple[int, int, int] = (0, 1, 2), low: float = 2.0, high: float = 98.0) -> np.ndarray:
    """Display bands stretched, alpha as it is; a constant positive alpha is opaque."""
    if bands.ndim != 3 or bands.shape[0] < 4 or not 0 <= alpha < bands.shape[0]:
        raise ValueError(f"no alpha band {alpha} in {bands.shape}")
    plane = np.clip(np.nan_to_num(bands[alpha].astype(float)), 0, 255).astype(np.uint8)
    if plane.size and plane.min() == plane.max() > 0:
        plane[:] = 255
    return np.concatenate([rgb(bands, chosen, low, high), plane[np.newaxis]])


def skip_reason(
    bands: np.ndarray, valid: np.ndarray | None = None, min_content: float = 0.05, max_black: float = 0.75, max_white: float = 0.75, min_std: float = 2.0, min_band_std: float = 1.5
) -> str:
    """Why a tile is not worth keeping, or ''; the checks of ``pixels.skip_decisions`` on one array."""
    if bands.size == 0:
        return "empty_array"
    data = bands[:3].astype(float)
    good = np.isfinite(data) if valid is None else valid[:3] & np.isfinite(data)
    if not good.any():
        return "mostly_invalid"
    top = float(data[good].max())
    if top <= 1.5:
        black, white, scale = 0.02, 0.98, 255.0
    elif top <= 255:
        black, white, scale = 5.0, 250.0, 1.0
    else:
        black, white, scale = top * 5 / 255, top * 250 / 255, 255 / top
    filled = np.where(good, data, np.nan)
    with np.errstate(invalid="ignore"):
        is_valid, is_black, is_white = good.all(axis=0), (filled <= black).all(axis=0), (filled >= white).all(axis=0)
    checks = [
        ("mostly_invalid", is_valid.mean() <= 0.05),
        ("low_content", (is_valid & ~is_black & ~is_white).mean() < min_content),
        ("mostly_black", is_black.mean() > max_black),
        ("mostly_white", is_white.mean() > max_white),
        ("too_flat_global", float(np.nanstd(filled)) * scale < min_std),
        ("too_flat_channels", float(np.mean([np.std(b[g]) if g.any() else 0.0 for b, g in zip(data, good, strict=True)])) * scale < min_band_std),
    ]
    return next((name for name, hit in checks if hit), "")


def content(bands: np.ndarray, valid: np.ndarray, min_content: float, max_black: float = 0.40, max_white: float = 0.40) -> dict:
    """Valid, non-zero, content, black and white shares of the first three bands; the rules of ``pixels.content_stats`` on one array."""
    data, good = bands[:3], valid[:3]
    if data.size == 0:
        return {"valid_fraction": 0.0, "nonzero_fraction": 0.0, "content_fraction": 0.0, "black_fraction": 1.0, "white_fraction": 0.0, "mostly_empty": True}
    safe = np.where(good, np.nan_to_num(data.astype(float), nan=0.0, posinf=0.0, neginf=0.0), 0.0)
    full = float(np.iinfo(data.dtype).max) if data.dtype.kind in "ui" else 1.0 if safe.max() <= 1.5 else 255.0
    margin = 2.0 * full / 255.0 if full <= 255 else 2.0
    ok, black, white = (good & np.isfinite(data.astype(float))).all(axis=0), (np.abs(safe) <= margin).all(axis=0), (safe >= full - margin).all(axis=0)
    shares = {"valid_fraction": ok, "nonzero_fraction": ~black, "content_fraction": ok & ~black & ~white, "black_fraction": black, "white_fraction": white}
    out = {name: float(share.mean()) for name, share in shares.items()}
    return out | {"mostly_empty": bool(out["content_fraction"] < min_content or out["black_fraction"] > max_black or out["white_fraction"] > max_white)}
