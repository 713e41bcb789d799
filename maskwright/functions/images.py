"""Pixel kernels in numpy; images are arrays of height x width (x channels)."""

from __future__ import annotations

import numpy as np

PATCH = (64, 128)  # rows, columns of a compared region
ROWS, COLUMNS = 16, 32  # of a projection signature


def kernel(size: int, sigma: float = 0.0) -> np.ndarray:
    """Gaussian weights; without a sigma it follows from the size."""
    sigma = sigma if sigma > 0 else 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - (size - 1) / 2
    w = np.exp(-(x * x) / (2 * sigma * sigma))
    return w / w.sum()


def _filtered(img: np.ndarray, weights: np.ndarray, axis: int) -> np.ndarray:
    """Weighted sums along an axis, mirrored at the borders without repeating the border pixel."""
    half, n = len(weights) // 2, img.shape[axis]
    at = np.abs(np.arange(-half, n + half))
    period = max(1, 2 * (n - 1))
    at = at % period
    at = np.where(at >= n, period - at, at)
    padded = np.take(img.astype(np.float64), at, axis=axis)
    out = np.zeros(img.shape, np.float64)
    for k, w in enumerate(weights):
        out += w * np.take(padded, np.arange(k, k + n), axis=axis)
    return out


def gaussian(img: np.ndarray, size: int, sigma: float = 0.0) -> np.ndarray:
    w = kernel(size, sigma)
    return np.clip(np.rint(_filtered(_filtered(img, w, 1), w, 0)), 0, 255).astype(np.uint8)


def blur_in_place(img: np.ndarray, rectangles, size: int) -> np.ndarray:
    """Gaussian blur of rectangles one after the other: where they overlap it's applied twice."""
    img = img.copy()
    for x1, y1, x2, y2 in rectangles:
        x1, y1, x2, y2 = max(0, x1), max(0, y1), min(img.shape[1], x2), min(img.shape[0], y2)
        if x1 < x2 and y1 < y2:
            img[y1:y2, x1:x2] = gaussian(img[y1:y2, x1:x2], size)
    return img


def box_blur(img: np.ndarray, radius: int, power: int) -> np.ndarray:
    """Mean over (2r+1)^2 pixels, repeated; by running sums."""
    out = img.astype(np.float64)
    for _ in range(max(1, power)):
        for axis in (0, 1):
            n = out.shape[axis]
            at = np.clip(np.arange(-radius - 1, n + radius), 0, n - 1)
            total = np.cumsum(np.take(out, at, axis=axis), axis=axis)
            total = np.take(total, np.arange(2 * radius + 1, 2 * radius + 1 + n), axis=axis) - np.take(total, np.arange(n), axis=axis)
            out = total / (2 * radius + 1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def mask_boxes(img: np.ndarray, boxes, radius: int, power: int) -> np.ndarray:
    """Box blur of boxes cropped from the original, later ones on top."""
    out = img.copy()
    for x1, y1, x2, y2 in boxes:
        r = max(1, min(radius, max(1, min(x2 - x1, y2 - y1) // 2)))
        out[y1:y2, x1:x2] = box_blur(img[y1:y2, x1:x2], r, power)
    return out


def draw_boxes(img: np.ndarray, boxes, color=(0, 0, 255), thickness: int = 2) -> np.ndarray:
    out = img.copy()
    for x1, y1, x2, y2 in boxes:
        for k in range(thickness):
            out[max(0, y1 + k) : y1 + k + 1, max(0, x1) : x2] = color
            out[max(0, y2 - 1 - k) : y2 - k, max(0, x1) : x2] = color
            out[max(0, y1) : y2, max(0, x1 + k) : x1 + k + 1] = color
            out[max(0, y1) : y2, max(0, x2 - 1 - k) : x2 - k] = color
    return out


def gray(img: np.ndarray) -> np.ndarray:
    """Luma of a BGR image."""
    if img.ndim == 2:
        return img
    return np.rint(img[..., 0] * 0.114 + img[..., 1] * 0.587 + img[..., 2] * 0.299).astype(np.uint8)


def resize(img: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    def at(n, m):
        p = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        a = np.floor(p).astype(int)
        return a, np.minimum(a + 1, n - 1), p - a

    y0, y1, ty = at(img.shape[0], rows)
    x0, x1, tx = at(img.shape[1], columns)
    f = img.astype(np.float64)
    top = f[y0][:, x0] * (1 - tx) + f[y0][:, x1] * tx
    low = f[y1][:, x0] * (1 - tx) + f[y1][:, x1] * tx
    return top * (1 - ty)[:, None] + low * ty[:, None]


def region(img: np.ndarray, box) -> np.ndarray | None:
    """Clipped crop as a patch; None below 2 pixels."""
    x1, y1, x2, y2 = max(0, box[0]), max(0, box[1]), min(img.shape[1], box[2]), min(img.shape[0], box[3])
    return resize(gray(img[y1:y2, x1:x2]), *PATCH) if x2 - x1 >= 2 and y2 - y1 >= 2 else None


def ncc(a: np.ndarray, b: np.ndarray) -> float:
    a, b = (x.astype(np.float32) - np.float32(x.mean()) for x in (a, b))
    na, nb = float(np.linalg.norm(a)), float(np.linalg.norm(b))
    return 0.0 if na < 1e-6 or nb < 1e-6 else float((a * b).sum() / (na * nb))


def otsu(img: np.ndarray) -> int:
    """Threshold that separates the histogram best."""
    h = np.bincount(img.reshape(-1).astype(np.int64), minlength=256).astype(np.float64)
    below, mass = np.cumsum(h), np.cumsum(h * np.arange(256))
    above = below[-1] - below
    ok = (below > 0) & (above > 0)
    spread = np.zeros(256)
    spread[ok] = below[ok] * above[ok] * (mass[ok] / below[ok] - (mass[-1] - mass[ok]) / above[ok]) ** 2
    return int(spread.argmax())


def resample(v: np.ndarray, n: int) -> np.ndarray:
    return v if len(v) == n else np.interp(np.linspace(0, 1, n), np.linspace(0, 1, len(v)), v).astype(np.float32)


def signature(img: np.ndarray, boxes) -> np.ndarray | None:
    """Projections of bright or dark detail in each box, joined, of norm 1."""
    parts = []
    for b in boxes:
        patch = region(img, b)
        if patch is None:
            continue
        g = np.rint(patch).astype(np.uint8)
        detail = np.abs(g.astype(np.int16) - gaussian(g, 25, 3.0).astype(np.int16)).astype(np.uint8)
        mask = ((g > 200) | (g <= 70)) & (detail > otsu(detail))
        v = np.concatenate([resample(mask.sum(1).astype(np.float32), ROWS), resample(mask.sum(0).astype(np.float32), COLUMNS)])
        if np.linalg.norm(v) > 1e-6:
            parts.append(v / np.linalg.norm(v))
    whole = np.concatenate(parts) if parts else np.zeros(1, np.float32)
    return whole / np.linalg.norm(whole) if np.linalg.norm(whole) > 1e-6 else None
