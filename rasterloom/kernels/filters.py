"""Filters of one tile."""

from __future__ import annotations

import numpy as np

from rasterloom.operators.raster import derivative_taps, gaussian_taps


def convolve1d(image: np.ndarray, taps: np.ndarray, axis: int) -> np.ndarray:
    """Convolution with mirrored borders (the edge pixel is repeated)."""
    half = len(taps) // 2
    pad = [(half, half) if a == axis else (0, 0) for a in range(image.ndim)]
    wide = np.pad(image, pad, mode="symmetric")
    n = image.shape[axis]
    return sum(t * np.take(wide, np.arange(2 * half - i, 2 * half - i + n), axis=axis) for i, t in enumerate(taps))


def smooth(image: np.ndarray, sigma: float, truncate: float = 4.0) -> np.ndarray:
    """Gaussian smoothing with sampled, normalised taps."""
    half = int(truncate * sigma + 0.5)
    t = np.arange(-half, half + 1)
    taps = np.exp(-t * t / (2 * sigma * sigma))
    taps /= taps.sum()
    return convolve1d(convolve1d(image, taps, 1), taps, 0)


def gradient(bands: list[np.ndarray], mask: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Multi-band gradient, 1 at its largest inside the mask."""
    g, d = np.array(gaussian_taps(sigma)), np.array(derivative_taps(sigma))
    dx = [convolve1d(convolve1d(b, d, 1), g, 0) for b in bands]
    dy = [convolve1d(convolve1d(b, d, 0), g, 1) for b in bands]
    p, q, t = sum(x * x for x in dx), sum(y * y for y in dy), sum(x * y for x, y in zip(dx, dy, strict=True))
    out = np.nan_to_num(np.sqrt(0.5 * (p + q + np.sqrt((p - q) ** 2 + 4 * t * t))))
    top = out[mask].max(initial=0)
    return out / top if top > 0 else out


def gabor_bank(image: np.ndarray, frequencies=(0.1, 0.2, 0.3), orientations: int = 4, bandwidth: float = 1.0) -> np.ndarray:
    """Magnitudes of Gabor responses [filters, rows, cols], computed in the frequency domain."""
    rows, cols = image.shape
    v, u = np.meshgrid(np.fft.fftfreq(rows), np.fft.fftfreq(cols), indexing="ij")
    spectrum, out = np.fft.fft2(image), []
    for f in frequencies:
        spread = f * (2**bandwidth - 1) / (2**bandwidth + 1) / np.sqrt(2 * np.log(2))
        for k in range(orientations):
            angle = np.pi * k / orientations
            a, b = u * np.cos(angle) + v * np.sin(angle) - f, -u * np.sin(angle) + v * np.cos(angle)
            out.append(np.abs(np.fft.ifft2(spectrum * np.exp(-(a * a + b * b) / (2 * spread * spread)))))
    return np.array(out)


def epx(image: np.ndarray) -> np.ndarray:
    """Edge-preserving doubling: a quarter takes a side neighbour's value where exactly its two sides agree."""
    up, down = np.roll(image, 1, 0), np.roll(image, -1, 0)
    left, right = np.roll(image, 1, 1), np.roll(image, -1, 1)
    up[0], down[-1], left[:, 0], right[:, -1] = image[0], image[-1], image[:, 0], image[:, -1]
    out = np.repeat(np.repeat(image, 2, 0), 2, 1)
    for (r, c), (a, b, x, y) in {(0, 0): (left, up, down, right), (0, 1): (up, right, left, down), (1, 0): (down, left, right, up), (1, 1): (right, down, up, left)}.items():
        out[r::2, c::2] = np.where((a == b) & (a != x) & (b != y), a, image)
    return out
