"""Pixel operations on numpy images (height, width[, 3], uint8), for readers that prepare their own input."""

from __future__ import annotations

import re

import numpy as np

#: sRGB to XYZ (D65), and the white point.
_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
_WHITE = np.array([0.950456, 1.0, 1.088754])


def gray(rgb: np.ndarray) -> np.ndarray:
    """Luma as a float image."""
    return rgb.astype(np.float64) @ np.array([0.299, 0.587, 0.114]) if rgb.ndim == 3 else rgb.astype(np.float64)


def laplacian_variance(rgb: np.ndarray) -> float:
    """Sharpness: the variance of the four-neighbour Laplacian; 0 for an empty image."""
    if rgb is None or rgb.size == 0:
        return 0.0
    g = np.round(gray(rgb))
    g = np.pad(g, 1, mode="reflect" if min(g.shape) > 1 else "edge")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())


def equalized(plane: np.ndarray, clip: float = 2.0, grid: tuple[int, int] = (8, 8)) -> np.ndarray:
    """Contrast-limited adaptive histogram equalisation of a uint8 plane.

    Each tile's histogram is cut at clip times its mean, and what is cut is spread over all values; a pixel blends the
    mappings of the four tiles around it.
    """
    rows, cols = grid
    h, w = plane.shape
    wide = np.pad(plane, ((0, -h % rows), (0, -w % cols)), mode="reflect" if min(h, w) > max(rows, cols) else "edge")
    th, tw = wide.shape[0] // rows, wide.shape[1] // cols
    tiles = wide.reshape(rows, th, cols, tw).swapaxes(1, 2).reshape(rows * cols, -1)
    hist = np.zeros((rows * cols, 256), np.int64)
    np.add.at(hist, (np.repeat(np.arange(rows * cols), th * tw), tiles.ravel()), 1)
    limit = max(1, int(clip * th * tw / 256))
    cut = np.maximum(hist - limit, 0).sum(1)
    hist = np.minimum(hist, limit) + (cut // 256)[:, None]
    rest, value = (cut % 256)[:, None], np.arange(256)[None, :]
    step = np.maximum(1, 256 // np.maximum(rest, 1))
    hist += (value % step == 0) & (value // step < rest)
    table = np.clip(np.round(np.cumsum(hist, axis=1) * (255.0 / (th * tw))), 0, 255).reshape(rows, cols, 256)
    y, x = np.arange(h) / th - 0.5, np.arange(w) / tw - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    near = lambda i, n: np.clip(i, 0, n - 1)
    at = lambda a, b: table[near(a, rows)[:, None], near(b, cols)[None, :], plane]
    top, bottom = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx, at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return np.clip(np.round(top * (1 - fy) + bottom * fy), 0, 255).astype(np.uint8)


def to_lab(rgb: np.ndarray) -> np.ndarray:
    """CIE L*a*b* scaled to bytes: L 0 to 255, a and b around 128."""
    c = rgb.astype(np.float64) / 255
    c = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    t = (c @ _XYZ.T) / _WHITE
    f = np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16 / 116)
    light = 116 * f[..., 1] - 16
    lab = np.stack([light * 255 / 100, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128], axis=-1)
    return np.clip(np.round(lab), 0, 255).astype(np.uint8)


def from_lab(lab: np.ndarray) -> np.ndarray:
    light, a, b = (lab[..., i].astype(np.float64) for i in range(3))
    fy = (light * 100 / 255 + 16) / 116
    f = np.stack([fy + (a - 128) / 500, fy, fy - (b - 128) / 200], axis=-1)
    t = np.where(f > 6 / 29, f**3, (f - 16 / 116) / 7.787) * _WHITE
    c = np.clip(t @ np.linalg.inv(_XYZ).T, 0, 1)
    c = np.where(c <= 0.0031308, c * 12.92, 1.055 * c ** (1 / 2.4) - 0.055)
    return np.clip(np.round(c * 255), 0, 255).astype(np.uint8)


def contrasted(rgb: np.ndarray, clip: float = 2.0, grid: tuple[int, int] = (8, 8)) -> np.ndarray:
    """The image with its lightness equalised; colours stay."""
    if rgb.ndim == 2:
        return equalized(rgb, clip, grid)
    lab = to_lab(rgb)
    lab[..., 0] = equalized(lab[..., 0], clip, grid)
    return from_lab(lab)


def _weights(size: int, to: int) -> np.ndarray:
    """(to, size): the part that each old pixel has in each new one; by area if it shrinks, else linear."""
    out = np.zeros((to, size))
    ratio = size / to
    for i in range(to):
        if ratio >= 1:
            a, b = i * ratio, min((i + 1) * ratio, size)
            for j in range(int(a), min(int(np.ceil(b)), size)):
                out[i, j] = min(b, j + 1) - max(a, j)
        else:
            at = min(max((i + 0.5) * ratio - 0.5, 0), size - 1)
            j = int(at)
            out[i, j] += 1 - (at - j)
            if at > j:
                out[i, j + 1] += at - j
    return out / out.sum(1, keepdims=True)


def resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    out = np.tensordot(_weights(image.shape[0], height), image.astype(np.float64), (1, 0))
    out = np.moveaxis(np.tensordot(_weights(image.shape[1], width), out, (1, 1)), 0, 1)
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def sized_for_detection(image: np.ndarray, most: int = 1600, least: int = 640) -> tuple[np.ndarray, float]:
    """The image with its longer side at `most`, and the scale; as it is if it is not larger and its shorter side has `least`."""
    h, w = image.shape[:2]
    if max(h, w) <= most and min(h, w) >= least:
        return image, 1.0
    scale = most / max(h, w)
    return resized(image, max(1, int(w * scale)), max(1, int(h * scale))), scale


def ordered_corners(points: np.ndarray) -> np.ndarray:
    """Top left, top right, bottom right, bottom left of four points, by sums and differences of their coordinates."""
    total, turn = points.sum(1), points[:, 1] - points[:, 0]
    return points[[total.argmin(), turn.argmin(), total.argmax(), turn.argmax()]].astype(np.float64)


def rectified(image: np.ndarray, polygon: np.ndarray) -> np.ndarray:
    """A quadrilateral of the image as an upright rectangle of at least 8 by 8, by a perspective map with linear sampling; black outside."""
    tl, tr, br, bl = corner = ordered_corners(np.asarray(polygon, np.float64))
    dist = lambda p, q: int(np.hypot(*(p - q)))
    w, h = max(dist(br, bl), dist(tr, tl), 8), max(dist(tr, br), dist(tl, bl), 8)
    target = np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], np.float64)
    rows, want = [], []
    for (x, y), (u, v) in zip(target, corner, strict=True):  # from the rectangle to the image
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        want += [u, v]
    m = np.append(np.linalg.lstsq(np.array(rows), np.array(want), rcond=None)[0], 1).reshape(3, 3)
    gx, gy = np.meshgrid(np.arange(w), np.arange(h))
    p = np.stack([gx, gy, np.ones_like(gx)], -1) @ m.T
    x, y = p[..., 0] / p[..., 2], p[..., 1] / p[..., 2]
    wide = np.pad(image.astype(np.float64), ((1, 1), (1, 1)) + ((0, 0),) * (image.ndim - 2))
    x, y = np.clip(x + 1, 0, wide.shape[1] - 1.001), np.clip(y + 1, 0, wide.shape[0] - 1.001)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    fx, fy = ((x - x0), (y - y0)) if image.ndim == 2 else ((x - x0)[..., None], (y - y0)[..., None])
    out = (wide[y0, x0] * (1 - fx) + wide[y0, x0 + 1] * fx) * (1 - fy) + (wide[y0 + 1, x0] * (1 - fx) + wide[y0 + 1, x0 + 1] * fx) * fy
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def netpbm(content: bytes) -> np.ndarray:
    """A binary gray (P5) or colour (P6) map of 8-bit samples. ValueError if the bytes are none, or too few."""
    head = re.match(rb"P([56])\s+(\d+)\s+(\d+)\s+255\s", content)
    if head is None:
        raise ValueError("no 8-bit binary map")
    kind, w, h = (int(x) for x in head.groups())
    shape = (h, w) if kind == 5 else (h, w, 3)
    if not w or not h or len(content) - head.end() < np.prod(shape):
        raise ValueError("a map of too few bytes")
    return np.frombuffer(content, np.uint8, int(np.prod(shape)), head.end()).reshape(shape)


def prepared(rgb: np.ndarray, most: int = 1600, least: int = 640, blurry_below: float = 40.0, contrast: bool = True) -> dict:
    """image, scale, blur_score, is_blurry: sharpness is that of the input; then contrast, then size."""
    score = laplacian_variance(rgb)
    image, scale = sized_for_detection(contrasted(rgb) if contrast else rgb, most, least)
    return {"image": image, "scale": scale, "blur_score": round(score, 2), "is_blurry": score < blurry_below}
